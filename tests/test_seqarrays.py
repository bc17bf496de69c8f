"""Adapters, cuts and counts over Arrow buffers against letter-by-letter definitions, and what they must not do."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from strandloom.functions import seqarrays
from strandloom.operators import qc


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _ham(a, b):
    return sum(x != y for x, y in zip(a, b, strict=True))


def _insert(seq, a3, least, most):
    for p in range(len(seq or "") - least + 1):
        k = min(len(seq) - p, len(a3))
        if _ham(seq[p : p + k], a3[:k]) <= most:
            return seq[:p]
    return ""


def _has5(seq, a5, least, most):
    return any(_ham(seq[e - min(e, len(a5)) : e], a5[len(a5) - min(e, len(a5)) :]) <= most for e in range(least, len(seq or "")))


def test_adapters_by_places(spark, monkeypatch):
    """F12, F16: no pattern is tried at every letter of a read; other letters, nulls and empty reads as before."""
    rng = random.Random(5)
    seqs = ["".join(rng.choice("ACGé\U0001d11e\n") for _ in range(rng.randrange(0, 30))) for _ in range(400)] + [None, "", "GATTACCA", "ACGTGATTACCA", "GATTACGG"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "i int, seq string")
    for a3, a5, most in (("GCCAGA", "CAGGAC", 2), ("GATTACCA", "GATTACCAGG", 1), ("AC", "AC", 0)):
        got = qc.adapter5_detect(qc.adapter3_trim(df, a3, 4, most), a5, 4, most)
        assert "rlike" not in _plan(got).lower() and "regexp" not in _plan(got).lower()
        for r in got.collect():
            assert (r.insert, r.has5) == (_insert(r.seq, a3, 4, most), _has5(r.seq, a5, 4, most)), r


def test_parts_and_slices(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(seqarrays, "PART", 7)
    texts = pa.array(["xx", "ACGTACGT", None, "", "AC", "GTACG"]).slice(1)
    assert list(seqarrays._by_parts(texts, lambda c, o: seqarrays.leftmost_place(c, o, "AC", 0, 2), int)) == [1, 0, 0, 1, 3]


def test_spelled_and_cut(spark):
    df = spark.createDataFrame([("aXé-b", 2), (None, 2), ("", 3), ("bbbab", 2), ("ab", None)], "t string, n int")
    s = seqarrays.spelled(F.col("t"), {"a": "A", "b": "T", "X": "N"})
    got = df.select(s.alias("s"), seqarrays.cut(s, F.col("n")).alias("c")).collect()
    assert [(r.s, r.c) for r in got] == [("ANT", ["AN", "T"]), (None, []), ("", []), ("TTTAT", ["TT", "TA", "T"]), ("AT", [])]


def test_packed_by_letters(spark, monkeypatch):
    """words of three bits a letter, whole batches at once; nulls, blanks, other letters and what is longer than the words."""
    import pyarrow as pa

    rng = random.Random(6)
    texts = ["".join(rng.choice("ACGTN aé\U0001d11e") for _ in range(rng.randrange(0, 50))) for _ in range(300)] + [None, "", "A" * 42, "T" * 43]
    digit = lambda x: " ACGT".find(x) if x in " ACGT" else 5
    want = [[int("".join(str(digit(x)) for x in (s or "").ljust(42)[21 * k : 21 * k + 21]), 8) for s in texts] for k in range(2)]
    for part in (9, 1 << 20):
        monkeypatch.setattr(seqarrays, "PART", part)
        assert [x.tolist() for x in seqarrays.packed(pa.array(["x", *texts]).slice(1), 2)] == want
    assert [x.tolist() for x in seqarrays.packed(pa.array([], pa.string()), 2)] == [[], []]
    df = seqarrays.pack(spark.createDataFrame([(i, s) for i, s in enumerate(texts)], "i int, s string"), "s", 2, "w")
    assert df.columns == ["i", "w0", "w1"] and sorted(map(tuple, df.collect())) == sorted(zip(range(len(texts)), *want, strict=True))


def test_tally(spark):
    df = spark.createDataFrame([("x", 1, "ab"), ("x", 1, "aé"), (None, 1, "a"), ("x", 2, ""), ("x", 2, None)], "k string, m int, t string")
    got = {tuple(r) for r in seqarrays.tally(df, ["k", "m"], ["t"]).collect()}
    assert got == {("x", 1, "t", 1, 97, 2), ("x", 1, "t", 2, 98, 1), ("x", 1, "t", 2, 233, 1), (None, 1, "t", 1, 97, 1)}


def test_mrd_records(spark):
    """reads are shown beside their precursor's sequence, no read is cut out of tiles of it by itself."""
    from strandloom.operators import records

    p = spark.createDataFrame([(1, "ACGTACGT"), (2, "AéGG"), (3, "ACGT")], "precursor int, seq string")
    w = spark.createDataFrame([(1, "S", 5, 6), (1, "M", 1, 2), (1, "M", 6, 6)], "precursor int, kind string, beg int, end int")
    x = spark.createDataFrame([(1, 2, "GTT", 1), (1, 0, "ACC", 2), (1, 6, "GTA", 3), (1, 0, "ACC", 2), (2, 0, "aéG", 1)], "precursor int, beg int, seq string, n bigint")
    out = records.mrd_assemble(p, w, x)
    assert "__tile" not in _plan(out)
    got = {r.precursor: (r.total, r["mask"], r.pri_seq, [tuple(q) for q in r.reads]) for r in out.collect()}
    assert got == {
        1: (8, "fMMllSMf", "ACGTACGT", [(0, 2, "acC", 2), (0, 2, "acC", 2), (2, 4, "gtT", 1), (6, 8, "gtA", 3)]),
        2: (1, "ffff", "AéGG", [(0, 2, "Aég", 1)]),
    }


def test_no_row_a_letter(spark):
    """letters are counted in batches; tables by letter make no row a letter."""
    from strandloom.operators import records

    d = spark.createDataFrame([("a", "ACGN", "I!5I"), ("a", "ACGN", "IIII"), ("b", "AA", "II"), ("b", "é", "5")], "sample string, seq string, qual string")
    report = qc.fastq_report(d, d.where("qual <> '5'"))
    assert "explode" not in _plan(report).lower()
    got = {(r.sample, r.stage): (r.reads, r.bases, r.n_percent, r.low_percent, r.q20, r.gc_percent, r.duplication, r.discarded) for r in report.collect()}
    assert got[("a", "raw")] == (2, 8, 25.0, 12.5, 87.5, 66.6667, 50.0, 0)
    assert got[("b", "raw")][:5] == (2, 3, 0.0, 0.0, 100.0) and got[("b", "clean")][-1] == 1
    assert {(r.q, r.n) for r in qc.quality_histogram(d).collect()} == {(40, 8), (20, 2), (0, 1)}

    e = spark.createDataFrame([("p", "m", 0, "AG", "ACG", 2), ("p", "m", 1, "CC", "ACG", 3), ("p", "m", 2, "GG", "ACG", 9), ("q", "m", 0, "TCG", "ACG", 1), (None, "m", 0, "T", "ACG", 1)], "precursor string, mature string, beg int, seq string, ref string, n bigint")
    sites = records.nt_edit_sites(e)
    assert "explode" not in _plan(sites).lower()
    assert {tuple(r) for r in sites.collect()} == {("p", "m", 1, "C->G", 2, 5, 40.0), ("p", "m", 2, "G->C", 3, 3, 100.0), ("q", "m", 0, "A->T", 1, 1, 100.0)}


def test_reads_are_dealt_by_parts_of_the_input(spark):
    """rows are sorted by read in as many tasks as the input asks for, and go through one shuffle of all rows."""
    from strandloom.operators import quant

    a = spark.createDataFrame([("r1", "x", "s"), ("r1", "x", "s"), ("r1", "y", "s"), ("r2", "x", "s"), ("r2", "x", "t"), (None, "x", "s")], "read_id string, ref string, sample string")
    got = quant.feature_uniq_counts(a)
    assert "REPARTITION_BY_NUM" in _plan(got)
    assert {tuple(r) for r in got.collect()} == {("x", "s", 2, 2.1667), ("y", "s", 1, 0.3333), ("x", "t", 1, 0.5)}
