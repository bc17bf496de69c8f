"""Alignment joins against comparing every read with every place."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from strandloom.operators import align

COMPLEMENT = str.maketrans("ACGTN", "TGCAN")


def every_hit(reads, refs, lengths, v, both=True):
    out = Counter()
    for seq, n in reads:
        if seq is None or len(seq) not in lengths:
            continue
        for ref, text in refs:
            for pos in range(len(text or "") - len(seq) + 1):
                w = text[pos : pos + len(seq)]
                for strand, x in (("+", w), ("-", w.translate(COMPLEMENT)[::-1]))[: 1 + both]:
                    mism = sum(a != b for a, b in zip(x, seq, strict=True))
                    if mism <= v:
                        out[(seq, n, ref, pos, strand, mism)] += 1
    return out


def tables(spark, rnd, lengths):
    say = lambda n, abc="ACGT": "".join(rnd.choice(abc) for _ in range(n))
    refs = [(i, say(rnd.randint(15, 220))) for i in range(12)] + [(20, "A" * 80), (21, "ACGTN" * 12), (22, ""), (23, None), (24, say(18)), (25, "ACACACACACACACACACACAC")]
    reads = {"A" * 20, "ACACACACACACACACACAC", None, "", say(60)}
    for _ in range(120):
        text = rnd.choice(refs[:12])[1]
        n = rnd.choice([*lengths, 17])
        if len(text) >= n:
            at = rnd.choice([0, len(text) - n, rnd.randint(0, len(text) - n)])
            w = list(text[at : at + n])
            for _ in range(rnd.randint(0, 4)):
                w[rnd.randrange(n)] = rnd.choice("ACGTN")
            w = "".join(w)
            reads.add(w if rnd.random() < 0.5 else w.translate(COMPLEMENT)[::-1])
    reads = [(x, i) for i, x in enumerate(sorted(reads, key=str))]
    return reads, refs, spark.createDataFrame(reads, "seq string, n long"), spark.createDataFrame(refs, "ref long, seq string")


@pytest.mark.parametrize("v,lengths,both", [(0, range(18, 37), True), (1, range(18, 37), False), (2, range(18, 26), True), (3, range(18, 45), True), (2, [4, 5], True)])
def test_mismatch_align_by_every_place(spark, v, lengths, both):
    reads, refs, r, f = tables(spark, random.Random(v), list(lengths))
    got = Counter((x.seq, x.n, x.ref, x.pos, x.strand, x.mism) for x in align.mismatch_align(r, f, list(lengths), v, both).collect())
    want = every_hit(reads, refs, list(lengths), v, both)
    assert got == want and sum(want.values()) > 10
    assert align.mismatch_align(r, f.limit(0), list(lengths), v).count() == 0


@pytest.mark.parametrize("tile,overlap", [(1, 44), (32, 44), (50, 60)])
def test_tiles_give_the_rows_of_whole_references(spark, tile, overlap):
    lengths = list(range(18, 46))
    reads, refs, r, _ = tables(spark, random.Random(11), lengths)
    rows = [(k, at, min(tile, len(s) - at), s[at : at + tile + overlap]) for k, s in refs for at in range(0, len(s or ""), tile)]
    tiles = spark.createDataFrame(rows, "ref long, at long, own int, seq string")
    got = Counter((x.seq, x.n, x.ref, x.pos, x.strand, x.mism) for x in align.mismatch_align(r, tiles, lengths, 1).collect())
    assert got == every_hit(reads, refs, lengths, 1)


def test_exact_align_takes_the_first_hit(spark):
    reads, refs, r, f = tables(spark, random.Random(7), list(range(18, 37)))
    first = {}
    for seq, n, ref, pos, strand, _ in sorted(every_hit(reads, refs, list(range(18, 37)), 0), key=lambda h: h[2:5]):
        first.setdefault(seq, (n, ref, pos, strand))
    assert {x.seq: (x.n, x.ref, x.pos, x.strand) for x in align.exact_align(r, f, list(range(18, 37))).collect()} == first


def test_profile_counts_a_read_once_a_reference(spark):
    refs = spark.createDataFrame([("r", "ACGTTGCAAGGCTTAACCGGT" * 2), ("q", "T" * 30)], "ref string, seq string")
    reads = spark.createDataFrame([("ACGTTGCAAGGCTTAACCGGT", 5), ("ACGTTGCAAGGCTTAACCGGA", 3), ("T" * 26, 9)], "seq string, n long")
    sets = spark.createDataFrame([("plant", "r"), ("all", "r"), ("all", "r"), ("all", "q")], "set string, ref string")
    got = {(x.set, x.ref, x.mism): (x.n, x.uniq) for x in align.mirna_profile(reads, refs, sets, 1).collect()}
    assert got == {(s, "r", m): (n, 1) for s in ("plant", "all") for m, n in ((0, 5), (1, 3))}


@pytest.mark.parametrize("lengths,broadcast", [(range(18, 37), "10MB"), (range(18, 37), "-1"), ([4, 5], "10MB")])
def test_unaligned_are_the_reads_without_a_hit(spark, lengths, broadcast):
    """by comparing all places; null, empty, short and long reads stay; one way through the reads, which are shuffled to collapse them and, without broadcast, to meet."""
    reads, refs, r, f = tables(spark, random.Random(8), list(lengths))
    hit = {x[0] for x in every_hit(reads, refs, list(lengths), 0)}
    rows = Counter((x, n) for x, n in reads if x not in hit)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = align.unaligned(r, f, list(lengths))
        assert got.columns == r.columns and Counter(map(tuple, got.collect())) == rows and 0 < len(rows) < len(reads)
        assert align.unaligned(r, f.limit(0), list(lengths)).count() == len(reads)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("query", ["unmapped", "size_filter_genome"])
def test_unmapped_reads_the_texts_once(spark, query, tmp_path):
    """the reads were made twice, to be aligned and to be told from the aligned ones."""
    from strandloom.plans.align import QUERIES

    text = "the quick brown fox jumps over the lazy dog and the other fox " * 3
    spark.createDataFrame([(i, text[i:], "web") for i in range(30)], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, text[:80])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = QUERIES[query][0](spark, str(tmp_path))
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet [doc_id") == 1
    assert 0 < df.count() and df.columns == ["seq", "n"]


def test_reads_are_packed_once_and_met_by_one_long(spark):
    """no base conversion in the plan (a filter repeated it for every read, before and after the collapse), and the key is no struct."""
    _, _, r, f = tables(spark, random.Random(3), list(range(18, 26)))
    plan = align.mismatch_align(r.groupBy("seq").agg({"n": "sum"}), f, list(range(18, 26)), 3)._jdf.queryExecution().executedPlan().toString()
    assert "conv(" not in plan and "key#" in plan and "struct<k" not in plan and "bits" not in plan


@pytest.mark.parametrize("gear", [3, 40, 10_000])
def test_read_stacks_by_comparing_all_places(spark, gear):
    from strandloom.operators import records

    rnd = random.Random(gear)
    rows = [(rnd.choice("ab"), rnd.choice("+-"), b := rnd.randint(0, 900), b + rnd.randint(18, 25), f"r{rnd.randint(0, 120)}", rnd.randint(1, 4)) for _ in range(400)]
    hits = Counter(r[4] for r in rows)
    places = {}
    for c, s, b, e, read, n in rows:
        if hits[read] <= 5:
            h, end, most = places.get((c, s, b), (0, 0, 0))
            places[(c, s, b)] = (h + n, max(end, e), max(most, hits[read]))
    peaks = set()
    for (c, s, b), (h, e, most) in places.items():
        near = [(x, v[0]) for (c2, s2, x), v in places.items() if (c2, s2) == (c, s) and x != b and abs(x - b) <= 70]
        if all(v < h or (v == h and x > b) for x, v in near):
            peaks.add((c, s, b, e, h, most))
    count = Counter(p[4] for p in peaks)
    least = min((h for h in count if sum(k for x, k in count.items() if x >= h) <= gear), default=None)
    want = {p for p in peaks if least is not None and p[4] >= least}
    aln = spark.createDataFrame(rows, "chrom string, strand string, beg int, end int, read string, n int")
    got = records.read_stacks(aln, 5, 70, gear)
    assert {(r.chrom, r.strand, r.beg, r.end, r.height, r.hits) for r in got.collect()} == want and got.count() == len(want) <= gear
    assert records.read_stacks(aln.limit(0)).count() == 0
