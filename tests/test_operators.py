"""Quirks and invariants of the operators on literal rows."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandloom.functions.seq import half_up, kmers, pieces, reverse_complement
from strandloom.operators import align, qc, quant, reads, records, stats, table, targets, vectors

A3, A5 = "TGGAATTCTCGG", "GTTCAGAGTTCT"


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_n_before_low_quality(spark):
    d = frame(spark, [("r", "NNACGTACGT", "!!!!!!!!!!"), ("s", "ACGTACGTAC", "!!!!!IIIII"), ("t", "ACGTACGTAC", "!!!!IIIIII")], "read_id string, seq string, qual string")
    assert {r.read_id for r in d.where(qc.n_rich()).collect()} == {"r"}
    assert {r.read_id for r in d.where(qc.low_quality()).collect()} == {"r", "s"}


@pytest.mark.parametrize(
    ("seq", "want"),
    [
        ("ACACACACACACAC" + A3, "ACACACACACACAC"),
        ("AC" + A3 + "AC" + A3, "AC"),  # the leftmost of two
        (A3 + "ACAC", ""),  # at the start
        ("ACACACACACACACAC" + A3[:8], "ACACACACACACACAC"),  # a part at the end
        ("ACACACACACACACAC" + A3[:7], ""),  # too short a part
        ("ACACACACACACACA" + "AAGAATTCTCGG", "ACACACACACACACA"),  # two mismatches
        ("ACACACACACACACA" + "AAAAATTCTCGG", ""),  # three
        ("ACG", ""),
    ],
)
def test_adapter3(spark, seq, want):
    assert qc.adapter3_trim(frame(spark, [(seq,)], "seq string"), A3).first()["insert"] == want


def test_adapter5(spark):
    d = frame(spark, [(A5[4:] + "ACACACAC",), (A5[5:] + "ACACACAC",), ("AC" + A5 + "AC",), ("ACGT",)], "seq string")
    assert [r.has5 for r in qc.adapter5_detect(d, A5).collect()] == [True, False, True, False]


def test_lengths_are_filled_and_shares_sum(spark):
    d = frame(spark, [("s", "A" * 18, 3), ("s", "C" * 20, 1)], "sample string, seq string, n long")
    got = reads.length_distribution(d, 18, 21).orderBy("len").collect()
    assert [(r.len, r.n) for r in got] == [(18, 3), (19, 0), (20, 1), (21, 0)] and sum(r.percent for r in got) == 100


def test_reverse_complement_twice(spark):
    d = frame(spark, [("ACGTRYKMBVDHN",)], "s string")
    assert d.select(reverse_complement(reverse_complement(F.col("s"), True), True).alias("x")).first().x == "ACGTRYKMBVDHN"


def test_last_row_wins_and_missing(spark):
    left, right = frame(spark, [(1,), (2,)], "k int"), frame(spark, [(1, 1, "a"), (1, 2, "b")], "k int, o int, v string")
    assert [r.v for r in table.table_join(left, right, ["k"], ["o"]).collect()] == ["b"]
    assert {r.k: r.v for r in table.table_join_outer(left, right, ["k"], ["o"], fill="-").collect()} == {1: "b", 2: "-"}


def test_numbering_is_gapless_for_any_partitioning(spark):
    d = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k")).repartition(7)
    got = table.line_number(d, ["k"]).collect()
    assert all(r.line == r.k + 1 for r in got) and len(got) == 1000
    sums = table.cumulative_sum(d, "k", ["k"]).collect()
    assert all(r.cumul == r.k * (r.k + 1) // 2 for r in sums)
    assert table.line_number(d.limit(0), ["k"]).count() == 0


def test_synonyms_are_transitive(spark):
    syn = frame(spark, [("a", "b"), ("b", "c"), ("x", "y")], "a string, b string")
    got = table.table_join_synonyms(frame(spark, [("a",), ("x",), ("z",)], "n string"), frame(spark, [("c", 1, 7), ("z", 1, 8)], "n string, o int, v int"), "n", syn, ["o"])
    assert {(r.n, r.v) for r in got.collect()} == {("a", 7), ("z", 8)}


def test_half_up(spark):
    assert [r.x for r in frame(spark, [(0.5,), (1.5,), (2.4,)], "v double").select(half_up(F.col("v")).alias("x")).collect()] == [1, 2, 2]


def test_zero_references_stay_and_cpm_sums(spark):
    aln = frame(spark, [("s", "r1", "+", 1, 0, 3), ("s", "r2", "-", 1, 5, 1)], "sample string, read_id string, strand string, ref long, pos int, n long")
    got = {r.ref: (r.n, r.cpm) for r in quant.feature_counts(aln, frame(spark, [(1,), (2,)], "ref long")).collect()}
    assert got == {1: (4, 1e6), 2: (0, 0.0)}


def test_window_clamp_and_double_count(spark):
    w = quant.mature_windows(frame(spark, [("p", "m1", 1, 22), ("p", "m2", 3, 22)], "precursor string, mature string, pos int, len int"))
    assert {(r.mature, r.beg, r.end) for r in w.collect()} == {("m1", 0, 27), ("m2", 1, 29)}
    r = frame(spark, [("p", 2, 20, 5), ("p", 0, 9, 1), ("p", 40, 60, 2)], "precursor string, beg int, end int, n long")
    assert {(x.mature, x.n) for x in quant.read_in_window(r, w).collect()} == {("m1", 6), ("m2", 5)}
    assert quant.remaining_count(r, w).first().remaining == 2


def test_many_equal_reads_and_windows_meet_once(spark):
    """10^11 pairs of rows, but one pair of spans."""
    n = 10**6
    r = spark.range(n).select(F.lit("p").alias("precursor"), F.lit(3).alias("beg"), F.lit(9).alias("end"), F.lit(2).alias("n"))
    w = spark.range(10**5).select(F.lit("p").alias("precursor"), (F.col("id") % 2).alias("mature"), F.lit(1).alias("beg"), F.lit(9).alias("end"))
    assert {tuple(x) for x in quant.read_in_window(r, w).collect()} == {("p", m, n * 50_000, 2 * n * 50_000) for m in (0, 1)}
    assert quant.remaining_count(r, w).first().remaining == 0


def test_category_other_closes_the_total(spark):
    c = frame(spark, [("a", "s", 1.5), ("b", "s", 2.5)], "class string, sample string, n double")
    got = {r["class"]: r.n for r in quant.category_table(c, frame(spark, [("s", 9)], "sample string, total long")).collect()}
    assert got == {"a": 2, "b": 3, "other": 4, "total": 9}


def test_mismatch_alignment_by_brute_force(spark):
    refs = frame(spark, [(1, "ACGTTGCAACGGTCATTGCAGGA"), (2, "TTTTTTTTTTTTTTTT")], "ref long, seq string")
    r = frame(spark, [("ACGTTGCA", 1), ("ACGATGCA", 1), ("TCCTGCAA", 1), ("GGGGGGGG", 1)], "seq string, n long")
    rc = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    want = set()
    for ref, s in ((1, "ACGTTGCAACGGTCATTGCAGGA"), (2, "T" * 16)):
        for q in ("ACGTTGCA", "ACGATGCA", "TCCTGCAA", "GGGGGGGG"):
            for p in range(len(s) - 7):
                for strand, w in (("+", s[p : p + 8]), ("-", rc(s[p : p + 8]))):
                    k = sum(a != b for a, b in zip(q, w, strict=True))
                    if k <= 1:
                        want.add((q, ref, p, strand, k))
    got = align.mismatch_align(r, refs, [8], 1)
    assert {(x.seq, x.ref, x.pos, x.strand, x.mism) for x in got.collect()} == want
    assert {x.seq for x in align.unmapped(r, got).collect()} == {"GGGGGGGG"}


def test_cis_pairs_at_the_border(spark):
    g = frame(spark, [("1", 100, 500, "+", "a"), ("1", 450, 900, "-", "b"), ("1", 600, 700, "-", "c"), ("1", 601, 700, "-", "d"), ("1", 100, 500, "-", "e")], "chrom string, start long, end long, strand string, id string")
    got = {r.m_id: (r.kind, r.overlap) for r in align.cis_nat(g, width=50).collect()}
    assert got == {"b": ("Tail to tail", 51), "c": ("Nearby tail", 0), "e": ("Containing plus", 401)}


def test_seeds(spark):
    utr = frame(spark, [("u", "GGTTTTACGACCCC"), ("s", "ACG")], "utr string, seq string")
    mir = frame(spark, [("m", "ATCGTAAAAC")], "mirna string, seq string")  # seed TCGTAAAA: TTTTACGA
    assert [(r.target, r.seed, r.end, r.start) for r in targets.target_sites(utr, mir, min_len=8).collect()] == [("u", 8, 3, 11)]
    loop = frame(spark, [("u", "GGTTTTCACGACC")], "utr string, seq string")
    got = targets.target_sites(loop, mir, lengths=(8,), wobbles={}, mismatches={}, loops=(8,), min_len=8).collect()
    assert {(r.loop, r.target_seq, tuple(r.target_pairing)) for r in got} == {(1, "GTCGTGAAA", (0, 2, 3, 4, 5, 0, 6, 7, 8))}


def test_t_tail_and_normal_tail(spark):
    d = frame(spark, [(2.0, 10.0), (0.0, 5.0), (1.0, 1.0)], "t double, dof double").select(stats.t_tail("t", "dof").alias("p"), stats.normal_tail(F.col("t")).alias("q"))
    got = d.collect()
    assert [round(r.p, 5) for r in got] == [0.07339, 1.0, 0.5]
    assert all(abs(r.q - 0.5 * math.erfc(t / math.sqrt(2))) < 2e-7 for r, t in zip(got, (2.0, 0.0, 1.0), strict=True))


def test_adjustments(spark):
    d = frame(spark, [(i, p) for i, p in enumerate((0.01, 0.04, 0.03, 0.5))], "i int, p double")
    q = lambda m: [round(r.q, 6) for r in stats.padjust(d, "p", m, tie=["i"]).orderBy("i").collect()]
    assert q("BH") == [0.04, 0.053333, 0.053333, 0.5]
    assert q("holm") == [0.04, 0.09, 0.09, 0.5] and q("hochberg") == [0.04, 0.08, 0.08, 0.5]
    assert q("bonferroni") == [0.04, 0.16, 0.12, 1.0] and q("none") == [0.01, 0.04, 0.03, 0.5]
    assert q("BY") == [round(min(1.0, x * 25 / 12), 6) for x in (0.04, 0.16 / 3, 0.16 / 3, 0.5)]


def test_vectors_ignore_empty_entries(spark):
    d = frame(spark, [(1, [1.0, None, 3.0]), (2, [])], "k int, v array<double>")
    got = {r.k: (r["mean"], r.n_full) for r in vectors.vec_basic(d, "k", "v", 2.0).collect()}
    assert got == {1: (2.0, 2), 2: (None, 0)}


def test_islands_cover_their_members(spark):
    d = frame(spark, [("c", 0, 10), ("c", 2, 4), ("c", 9, 12), ("c", 13, 20), ("d", 0, 1)], "chrom string, beg int, end int")
    got = {(r.chrom, r.beg, r.end, r.hits) for r in quant.hit_windows_merge(d, ["chrom"]).collect()}
    assert got == {("c", 0, 12, 3), ("c", 13, 20, 1), ("d", 0, 1, 1)}


def test_expr_pattern_pairs_by_brute_force(spark):
    rng = np.random.default_rng(3)
    base = np.repeat(rng.normal(size=(20, 6)) * 5, 6, axis=0)
    x = [[round(v, 3) for v in s] for s in (base + rng.normal(size=base.shape) * 0.7).tolist()]
    x += [[0.0, 5.0, 5.0, 9.0, 2.0, 7.0], [0.0, 5.0, 5.1, 9.0, 2.0, 7.0], [0.0, 5.0, 4.9, 9.0, None, 7.0], [3.0] * 6, [1.0, 7.0, 8.0, 20.0], [1.0, 7.0, 7.0, 20.0], None]
    want = {}
    for i, p in enumerate(x):
        for j, q in enumerate(x):
            if i != j and p and q and len(p) == len(q) and all(max(v for v in s if v is not None) - min(v for v in s if v is not None) >= 5 for s in (p, q)):
                both = np.array([(u, v) for u, v in zip(p, q, strict=True) if u is not None and v is not None])
                r = round(float(np.corrcoef(both.T)[0, 1]), 4)
                if r >= 0.95:
                    want[i, j] = r
    d = spark.createDataFrame(list(enumerate(x)), "id long, x array<double>").repartition(3)
    rows = stats.expr_pattern_pairs(d, d, 5.0, 0.95).collect()
    assert len(rows) == len(want) > 100 and (120, 121) in want and (121, 122) in want
    assert {(r.a, r.b): r.r for r in rows} == pytest.approx(want, abs=1e-4)


def test_phase_windows_by_brute_force(spark):
    rng = np.random.default_rng(8)
    rows = [("x", 200 + 21 * i, 21, 3) for i in range(10)]  # phased across position 252
    rows += [("x", 5000 + 21 * i, 21, 1) for i in range(10)] + [("x", 9000 + 21 * i, 30, 9) for i in range(10)]  # too few reads; too long
    rows += [("y", int(k), int(rng.integers(18, 29)), int(rng.integers(1, 5))) for k in rng.integers(0, 1500, 400)] + [("y", 210, 24, 1), ("y", 210, 20, 1)]
    n = Counter()
    for c, pos, size, k in rows:
        n[c, pos] += k if 20 <= size <= 26 else 0
    held = [k for k, v in n.items() if v >= 2]
    want = {}
    for c, start in held:
        at = [p - start for d, p in held if d == c and 0 <= p - start < 252]
        k = sum(x % 21 == 0 for x in at)
        tail = sum(math.comb(12, i) * math.comb(240, len(at) - i) for i in range(k, min(12, len(at)) + 1)) / math.comb(252, len(at))
        p = 1.0 if k * 252 < len(at) * 12 else tail
        if p <= 0.05:
            want[c, start] = (len(at), k, p)
    got = align.phase_windows(spark.createDataFrame(rows, "chrom string, pos long, len int, n long"), most_p=0.05).collect()
    assert ("x", 200) in want and want["x", 200][:2] == (10, 10)
    assert {(r.chrom, r.start): (r.positions, r.phased) for r in got} == {k: v[:2] for k, v in want.items()}
    assert {(r.chrom, r.start): r.p for r in got} == pytest.approx({k: v[2] for k, v in want.items()}, abs=1e-9)


def test_hypergeom_tail_of_small_and_huge_counts(spark):
    rows = [(k, n, 40, 100) for n in (1, 17, 60) for k in (0, 1, 8, 15, 30) if k <= n] + [(3, 5, 10**9, 3 * 10**9)]
    tail = lambda k, n, g, t: sum(math.comb(g, i) * math.comb(t - g, n - i) for i in range(k, min(n, g) + 1)) / math.comb(t, n)
    got = {(r.k, r.n, r.g, r.t): r.p for r in stats.hypergeom_tail(frame(spark, rows, "k long, n long, g long, t long"), "k", "n", "g", "t").collect()}
    for r in rows:
        assert got[r] == pytest.approx(1.0 if r[0] * r[3] < r[1] * r[2] else tail(*r), rel=1e-4 if r[3] > 100 else 1e-9)


def test_pieces_are_cut_across_tiles_and_at_the_ends(spark):
    text = "ACGTTGCANNACGT" * 3
    seqs = spark.createDataFrame([("a", text), ("b", ""), ("c", None)], "chrom string, seq string")
    spans = [(1, 1), (3, 12), (0, 4), (40, 60), (50, 60), (9, 8), (3, 12), (1, 42)]
    rows = [("a", s, e) for s, e in spans] + [("b", 1, 3), ("none", 1, 3), (None, 1, 2)]
    out = pieces(spark.createDataFrame(rows, "chrom string, start int, end int"), seqs, "chrom", F.col("start"), F.col("end"), tile=5)
    got = sorted((r["chrom"], r["start"], r["end"], r["__piece"]) for r in out.collect())
    assert got == sorted([("a", s, e, text[max(s, 1) - 1 : max(e, 0)] if s <= e else "") for s, e in spans] + [("b", 1, 3, "")])


def test_kmers_of_tiles_are_those_of_the_whole(spark):
    text = "".join("ACGTN"[(i * i + i // 7) % 5] for i in range(1100))
    df = spark.createDataFrame([(1, text), (2, text[:9]), (3, text[:5]), (4, ""), (5, None)], "id int, s string")
    for k in (6, 9):
        got = sorted((r["id"], r["pos"], r["kmer"]) for r in kmers(df, "s", k, ["id"], tile=16).collect())
        assert got == sorted((n, i + 1, t[i : i + k]) for n, t in ((1, text), (2, text[:9]), (3, text[:5])) for i in range(len(t) - k + 1))


def test_enrichment_tests_against_sums(spark):
    genes = [(g, t) for g in range(40) for t in ("all", f"t{g % 3}")]
    fore = [(g,) for g in range(0, 30, 2)] + [(99,)]
    closure, fg = frame(spark, genes, "gene int, term string"), frame(spark, fore, "gene int")
    n, big_n = 15, 40
    members = {t: [g for g, x in genes if x == t] for t in ("all", "t0", "t1", "t2")}
    hits = {t: sum((g,) in fore for g in m) for t, m in members.items()}
    rate = lambda t: len(members[t]) / big_n
    want = {t: sum(math.comb(n, i) * rate(t) ** i * (1 - rate(t)) ** (n - i) for i in range(hits[t], n + 1)) for t in members}
    got = {r["term"]: (r["k"], r["p"]) for r in stats.enrich(closure, fg, test="b").collect()}
    assert {t: v[0] for t, v in got.items()} == hits and all(v[1] == pytest.approx(want[t], rel=1e-9) for t, v in got.items())
    chi = {r["term"]: r["p"] for r in stats.enrich(closure, fg, test="c").collect()}
    for t in ("t0", "t1", "t2"):
        k, m = hits[t], len(members[t])
        x = (k * (big_n - n - m + k) - (n - k) * (m - k)) ** 2 * big_n / (n * (big_n - n) * m * (big_n - m))
        assert chi[t] == pytest.approx(math.erfc(math.sqrt(x / 2)), abs=1e-6)
    assert chi["all"] == 1.0  # no gene outside the term
    assert {r["term"]: r["share"] for r in stats.frequency_list(closure, fg).collect()} == {t: hits[t] / n for t in members}
    assert stats.term_genes(closure, fg).where("term = 'all'").count() == n
    with pytest.raises(ValueError):
        stats.enrich(closure, fg, test="z")


def test_q_values_with_the_share_of_true_nulls(spark):
    p = [0.001, 0.01, 0.2, 0.6, 0.9, 0.02, 0.03, 0.3]
    share = min(1, (1 + sum(x > 0.5 for x in p)) / (len(p) / 2))
    got = {r["p"]: r["q"] for r in stats.padjust(frame(spark, [(x,) for x in p], "p double"), "p", "QVALUE").collect()}
    order = sorted(p)
    assert got == pytest.approx({x: min(1, min(share * order[j] * len(p) / (j + 1) for j in range(i, len(p)))) for i, x in enumerate(order)})


def test_scopes_of_threads_are_apart(spark):
    """Each thread deletes its own tables only, and leaves none but its results."""
    import os
    from concurrent.futures import ThreadPoolExecutor

    from strandloom.functions import scratch

    folder = scratch.shared_dir(spark).removeprefix("file://") + "/strandloom"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()  # the folder may be one that the cluster names

    def work(n):
        with scratch.scope(spark):
            with scratch.scope(spark):
                kept = scratch.result(scratch.table(spark.range(n), "inner").where("id % 2 = 0"), "kept")
            out = scratch.result(kept.union(kept), f"threads-{n}")
        return out.count()

    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(work, range(100, 112))) == [2 * (n // 2 + n % 2) for n in range(100, 112)]
    left = [x for x in set(os.listdir(folder)) - before if x.startswith(("inner-", "kept-", "threads-"))]
    assert len(left) == 12 and all(x.startswith("threads-") for x in left)


def test_binomial_tail_of_counts_too_many_to_list(spark):
    rows = frame(spark, [(3000, 3 * 10**9), (30_000, 3 * 10**9)], "r long, n long")
    got = [r.p for r in stats.binomial_tail(rows, "n", "r", 1e-6).orderBy("r").collect()]
    assert got == [pytest.approx(0.5024, abs=1e-3), 0.0]


def test_ranges_are_found_by_halving(spark):
    rows = frame(spark, [(i * 7919 % 1000, None if i % 9 == 0 else f"v{i % 5}") for i in range(1000)], "a int, b string")
    dealt = table._ranges(rows, ["b", "a"])
    assert "filter(__bounds" not in dealt._jdf.queryExecution().analyzed().toString()
    got = sorted(dealt.collect(), key=lambda r: ((r.b is not None), r.b or "", r.a))
    assert [r["__part"] for r in got] == sorted(r["__part"] for r in got)
    assert {r["__part"] for r in got} == set(range(5))  # four bounds


def test_near_genes_of_unlike_lengths_by_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(int(c), int(b), int(b) + int(length), "+-"[i % 2], i) for i, (c, b, length) in enumerate(zip(rng.integers(0, 2, 200), rng.integers(1, 9000, 200), rng.choice([0, 20, 300, 7000], 200), strict=True))]
    want = sorted((c, i, k) for c, a, b, s, i in rows if s == "+" for d, e, f, t, k in rows if t == "-" and c == d and min(b, f) - max(a, e) + 1 > -100)
    genes = frame(spark, rows, "chrom int, start int, end int, strand string, id int")
    for width in (None, 50):
        assert sorted((r.chrom, r.p_id, r.m_id) for r in align.cis_nat(genes, width=width).collect()) == want
