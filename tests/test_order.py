"""Order statistics by ranges against numpy and counting of all pairs."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandloom.operators import order, stats


def points(spark, n=600, seed=3):
    """Two keys (one null, with two thirds of the rows), few distinct values, a third of them 0."""
    rng = np.random.default_rng(seed)
    rows = [("k" if i % 3 == 0 else None, float(rng.integers(0, 40)) * float(rng.random() > 0.3), float(rng.integers(0, 25))) for i in range(n)]
    return rows, spark.createDataFrame(rows, "k string, x double, y double")


def tau_b(pairs):
    s = tx = ty = 0
    for (a, b), (c, d) in combinations(pairs, 2):
        s += np.sign(a - c) * np.sign(b - d)
        tx += a != c
        ty += b != d
    return s / math.sqrt(tx * ty) if tx and ty else None


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 18])
def test_kendall_counts_every_pair(spark, block):
    rows, df = points(spark)
    got = {r.k: r for r in order.kendall(df, ["k"], "x", "y", block).collect()}
    for k in ("k", None):
        mine = [(x, y) for q, x, y in rows if q == k]
        assert got[k].points == len(mine)
        assert got[k].tau == pytest.approx(tau_b(mine), abs=1e-12)


def test_kendall_edges(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 1.0, 3.0), ("b", 1.0, 1.0), ("c", 1.0, 2.0), ("c", 2.0, 1.0), ("c", None, 5.0), ("c", float("nan"), 5.0)], "k string, x double, y double")
    got = {r.k: (r.points, r.tau) for r in order.kendall(df, ["k"], "x", "y").collect()}
    assert got == {"a": (2, None), "b": (1, None), "c": (2, -1.0)}
    assert order.kendall(df.where("k = 'z'"), ["k"], "x", "y").count() == 0


def test_quantiles_are_exact(spark):
    rows, df = points(spark, 500)
    shares = {"lo": 0.0, "q1": 0.25, "m": 0.5, "u": 0.9, "hi": 1.0}
    got = {r.k: r for r in order.quantiles(df, ["k"], "x", shares).collect()}
    for k in ("k", None):
        mine = [x for q, x, _ in rows if q == k]
        for name, share in shares.items():
            assert got[k][name] == pytest.approx(np.quantile(mine, share), abs=1e-12)
    assert order.quantiles(df.where("x is null"), ["k"], "x", shares).count() == 0


def test_ranks_of_ties(spark):
    df = spark.createDataFrame([("a", 5), ("a", 5), ("a", 1), ("a", None), ("b", 9)], "k string, v int")
    assert {tuple(r) for r in order.ranked(df, ["k"], "v").collect()} == {("a", 1, 1, 0, 3), ("a", 5, 2, 1, 3), ("b", 9, 1, 0, 1)}


def test_density_sums_to_one_and_follows_the_kernel(spark):
    rng = np.random.default_rng(5)
    values = {"a": rng.normal(0, 1, 400), "b": rng.normal(3, 0.5, 200)}
    df = spark.createDataFrame([(k, float(v)) for k, vs in values.items() for v in vs], "k string, v double")
    got = order.density(df, "k", "v", 512).toPandas()
    for k, vs in values.items():
        g = got[got.k == k].sort_values("point")
        q1, q3 = np.quantile(vs, [0.25, 0.75])
        h = 0.9 * min(np.std(vs, ddof=1), (q3 - q1) / 1.34) * len(vs) ** -0.2
        exact = np.exp(-0.5 * ((g.x.to_numpy()[:, None] - vs) / h) ** 2).sum(axis=1) / (len(vs) * h * math.sqrt(2 * math.pi))
        assert np.abs(g.density - exact).max() < 2e-3 * exact.max()


def test_density_of_equal_values(spark):
    df = spark.createDataFrame([("a", 2.0)] * 5, "k string, v double")
    got = order.density(df, "k", "v", 8).collect()
    assert len(got) == 8 and all(r.x == 2.0 and math.isfinite(r.density) for r in got)


def test_sample_statistics_by_ranges(spark):
    """Factors and correlations over more rows than ranges, against numpy."""
    rng = np.random.default_rng(9)
    x = rng.integers(1, 60, (300, 3))
    long = spark.createDataFrame([(i, "abc"[j], int(x[i, j])) for i in range(300) for j in range(3)], "id int, sample string, value long")
    mean = np.log(x).mean(axis=1, keepdims=True)
    want = np.median(np.exp(np.log(x) - mean), axis=0)
    assert {r.sample: r.factor for r in stats.size_factors(long).collect()} == pytest.approx({"abc"[j]: round(float(want[j]), 6) for j in range(3)}, abs=1e-6)
    rank = lambda v: np.array([(v < q).sum() + ((v == q).sum() + 1) / 2 for q in v])
    got = {(r.a, r.b): r for r in stats.sample_correlation(long).collect()}
    tau = {(r.a, r.b): r.tau for r in stats.sample_kendall(long).collect()}
    for i, j in ((0, 1), (0, 2), (1, 2)):
        at = ("abc"[i], "abc"[j])
        assert got[at].spearman == pytest.approx(np.corrcoef(rank(x[:, i]), rank(x[:, j]))[0, 1], abs=1e-4)
        assert tau[at] == pytest.approx(tau_b(list(zip(x[:, i], x[:, j], strict=True))), abs=1e-6)


def test_hairpin_loci_by_hand(spark):
    """Two loci on one chromosome: four alignments in a chain, of which two are apart; and one alone, of a read that is also elsewhere."""
    from strandloom.operators import records

    aln = spark.createDataFrame(
        [
            ("c", "+", 0, 20, "a", 5), ("c", "+", 15, 36, "b", 2), ("c", "-", 30, 50, "d", 1), ("c", "+", 40, 60, "e", 9),
            ("c", "-", 500, 520, "f", 3), ("d", "+", 7, 27, "f", 3), ("c", "+", 100, 130, "long", 50), (None, "+", 0, 20, "g", 1),
        ],
        "chrom string, strand string, beg int, end int, read string, n int",
    )
    genome = spark.createDataFrame([("c", "A" * 45 + "GC" * 5 + "A" * 600)], "chrom string, seq string")
    got = {tuple(r) for r in records.hairpin_loci(aln, genome).collect()}
    assert got == {
        ("c", 0, 60, "+", 17, 1, 16 / 17, 2, 60, 0.5),
        ("c", 500, 520, "-", 3, 2, 1.0, 1, 20, 0.0),
        ("d", 7, 27, "+", 3, 2, 1.0, 1, 20, None),
    }
    assert records.hairpin_loci(aln.where("n > 99"), genome).count() == 0


def test_most_alignments_apart_by_brute_force(spark):
    from strandloom.operators import records

    rng = np.random.default_rng(2)
    rows = [(int(c), "+", int(b), int(b) + int(rng.integers(20, 23)), f"r{i}", 1) for i, (c, b) in enumerate(zip(rng.integers(0, 30, 240), rng.integers(0, 120, 240), strict=True))]
    aln = spark.createDataFrame(rows, "chrom int, strand string, beg int, end int, read string, n int")
    genome = spark.createDataFrame([(c, "ACGT" * 60) for c in range(30)], "chrom int, seq string")
    got = {r.chrom: r.islands for r in records.hairpin_loci(aln, genome, most=9).collect()}
    for c in {r[0] for r in rows}:
        spans = [(b, e) for q, _, b, e, _, _ in rows if q == c]
        best = max(k for k in range(1, 8) for pick in combinations(spans, k) if all(x[1] <= y[0] for x, y in zip(sorted(pick), sorted(pick)[1:], strict=False)))
        assert got[c] == best


def plain_loci(rows, seqs, sizes, distance, most):
    """Loci of (chrom, strand, beg, end, read, n) by reading them one by one."""
    from collections import Counter

    hits, out = Counter(r[4] for r in rows), []
    fit = sorted((r for r in rows if r[0] is not None and sizes[0] <= r[3] - r[2] <= sizes[1]), key=lambda r: (r[0], r[2], r[3]))
    groups = []
    for r in fit:
        if not groups or groups[-1][0][0] != r[0] or r[2] - max(x[3] for x in groups[-1]) > distance:
            groups.append([])
        groups[-1].append(r)
    for g in groups:
        runs, picks, end = [], 0, None
        for _, _, b, e, _, _ in g:
            if runs and b < runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], e)
            else:
                runs.append([b, e])
        for _, _, b, e, _, _ in sorted(g, key=lambda r: r[3]):
            if end is None or b >= end:
                picks, end = picks + 1, e
        total, plus = sum(r[5] for r in g), sum(r[5] for r in g if r[1] == "+")
        c = min(g, key=lambda r: (-r[5], r[4], r[1] or "", r[2], r[3]))
        piece = seqs.get(c[0], "")[max(c[2], 0) : max(c[3], 0)]
        gc = sum(x in "GCgc" for x in piece) / len(piece) if piece else None
        out.append((c[0], g[0][2], max(r[3] for r in g), "+" if 2 * plus >= total else "-", total, hits[c[4]], max(plus, total - plus) / total, min(picks, most + 1), max(b - a for a, b in runs), gc))
    return sorted(out)


def some_alignments(seed, n=400, wide=900):
    rng = np.random.default_rng(seed)
    rows = [("abcd"[rng.integers(0, 4) // (1 + i % 3)], [None, "+", "-"][rng.integers(0, 3)], int(b), int(b) + int(rng.integers(17, 24)), f"r{rng.integers(0, n // 2 + 1)}", int(rng.integers(1, 5))) for i, b in enumerate(rng.integers(-30, wide, n))]
    seqs = {c: "".join(rng.choice(list("ACGTn"), k)) for c, k in (("a", 1100), ("b", 600), ("c", 513))}
    return rows, seqs


@pytest.mark.parametrize(("distance", "most", "batch"), [(4, 3, 1000), (60, 9, 7), (0, 1, 1)])
def test_loci_over_edges_of_ranges_and_batches(spark, monkeypatch, distance, most, batch):
    """One pass over the dealt alignments: nothing but the ranges' bounds and the loci is written."""
    from strandloom.operators import records

    rows, seqs = some_alignments(distance, 200)
    aln = spark.createDataFrame(rows + [(None, "+", 0, 20, "r1", 1)], "chrom string, strand string, beg int, end int, read string, n int")
    genome = spark.createDataFrame([*seqs.items(), ("z", "ACGT"), ("none", None)], "chrom string, seq string")
    written = []
    for name in ("table", "result"):
        monkeypatch.setattr(records, name, lambda df, label, f=getattr(records, name): written.append(label) or f(df, label))
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = sorted(tuple(r) for r in records.hairpin_loci(aln, genome, (18, 22), distance, most).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
    assert got == plain_loci(rows + [(None, "+", 0, 20, "r1", 1)], seqs, (18, 22), distance, most)
    assert written == ["bounds", "loci"]


@pytest.mark.parametrize("seed", [*range(12), 56])
def test_portions_of_any_ranges_and_batches(seed):
    import pyarrow as pa

    from strandloom.functions import locusarrays as la

    rng = np.random.default_rng(seed)
    rows, seqs = some_alignments(seed, int(rng.integers(1, 200)), int(rng.integers(1, 700)))
    distance, most, tile = int(rng.integers(0, 30)), int(rng.integers(0, 6)), int(rng.integers(1, 40))
    want = plain_loci(rows, seqs, (17, 23), distance, most)
    fit = sorted(((r, sum(x[4] == r[4] for x in rows)) for r in rows), key=lambda x: (x[0][0], x[0][2], x[0][3]))
    cuts = np.sort(rng.integers(0, len(fit) + 1, int(rng.integers(0, 9))))
    part = np.searchsorted(cuts, np.arange(len(fit)), side="right")
    spread = {}
    for (r, _), p in zip(fit, part.tolist(), strict=True):
        b, e = spread.get((r[0], p), (r[2], r[3]))
        spread[r[0], p] = min(b, r[2]), max(e, r[3])
    from pyspark.sql import Row

    from strandloom.operators.records import _edges

    spots = [Row(**{"chrom": c, "__part": p, "beg": b, "end": e}) for (c, p), (b, e) in spread.items()]
    edges = _edges([r for r in spots if sum(x.chrom == r.chrom for x in spots) > 1])
    lines = [(p, r[0], r[2], r[3], r[5], r[1], r[4], h, None) for (r, h), p in zip(fit, part.tolist(), strict=True)]
    for c, s in seqs.items():
        for no in range(-(-len(s) // tile)):
            lines += [(p, c, -la.FAR // 2 if no == 0 else no * tile, None, no, None, None, None, s[no * tile : (no + 1) * tile + 23]) for p in range(10)]
    lines.sort(key=lambda x: (x[0], x[1], x[2], x[3] is not None, x[3] or 0))
    names = ["part", "chrom", "beg", "end", "n", "strand", "read", "hits", "tile"]
    kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    table = pa.table([pa.array(x, k) for x, k in zip(zip(*lines, strict=True), kinds, strict=True)], names=names)
    ints = dict.fromkeys(("less", "at", "to", "head", "tail"), pa.int64())
    edge = pa.struct([(c, ints.get(c, {"part": pa.int32(), "counts": pa.list_(pa.int32()), "ends": pa.list_(pa.int64()), "read": pa.string(), "strand": pa.string()}.get(c, pa.bool_()))) for c in la.EDGE])
    schema = pa.schema([("chrom", pa.string()), *[(c, pa.float64() if c == "gc" else pa.int64()) for c in la.LOCUS[1:]], ("edge", edge)])
    # ranges come in tasks of several, or each alone
    for size in (1, int(rng.integers(2, 30)), 10_000) if len(rows) < 100 else (3, 10_000):
        found = []
        for task in ([table] if size % 2 else [table.filter(pa.compute.equal(table["part"], p)) for p in range(10)]):
            for b in la.portions(iter(task.to_batches(max_chunksize=size)), schema, edges, distance, most, 23, tile):
                found += b.to_pylist()
        open_ = [Row(**{**r, "edge": Row(**r["edge"])}) for r in found if r["edge"]]
        whole = [tuple(r[c] for c in la.LOCUS) for r in found if not r["edge"]] + la.joined(open_, most)
        shown = sorted((c, b, e, "+" if 2 * plus >= n else "-", n, h, max(plus, n - plus) / n, k, o, gc) for c, b, e, n, plus, h, gc, k, o in whole)
        assert shown == want


def test_candidates_among_loci_of_one_pass(spark, monkeypatch):
    """What the filter keeps of the loci, each with its energy and paired bases; no alignments are written for it."""
    from strandloom.operators import records

    rows, seqs = some_alignments(8, 150)
    aln = spark.createDataFrame(rows, "chrom string, strand string, beg int, end int, read string, n int")
    written = []
    for name in ("table", "result"):
        monkeypatch.setattr(records, name, lambda df, label, f=getattr(records, name): written.append(label) or f(df, label))
    folds = spark.createDataFrame([("a", -30, 18), ("b", -25, 17), ("c", -40, 16)], "chrom string, energy int, paired int")
    loci = records.hairpin_loci(aln, spark.createDataFrame(list(seqs.items()), "chrom string, seq string"), (18, 22), 4).join(folds, "chrom")
    got = sorted(tuple(r)[:10] for r in records.hairpin_candidate_filter(loci, oriented=0.6, hits=4).collect())
    assert got == [x for x in plain_loci(rows, seqs, (18, 22), 4, 3) if x[0] in "ab" and x[4] >= 5 and x[5] <= 4 and x[6] >= 0.6 and x[7] <= 3 and x[8] <= 70 and x[9] is not None and x[9] >= 0.1]
    assert len(got) > 5 and written == ["bounds", "loci"]
