"""Readers and sinks on small literal files."""

from __future__ import annotations

import gzip
import random

import pytest

from strandloom.sources import readers, sinks
from strandloom.streaming.upsert import read_upserted, upsert_qc, upsert_stream


def put(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_fasta(spark, tmp_path):
    p = put(tmp_path, "a.fa", ">s1 first one\nacgt\nAC\n>s2\nNNA\n>s3 x\n\n")
    got = [tuple(r) for r in readers.read_fasta(spark, p).orderBy("id").collect()]
    assert got == [("s1", "first one", "ACGTAC"), ("s2", "", "NNA"), ("s3", "x", "")]
    assert readers.read_fasta(spark, p, upper=False, drop_n=True, line=2).orderBy("id").first().seq == "AC"


def test_fastq(spark, tmp_path):
    a = put(tmp_path, "a.fq", "@r1#x\nACGT\n+\nIIII\n@r2\n@@\n+\n@I\n")
    b = str(tmp_path / "b.fq.gz")
    with gzip.open(b, "wt") as f:
        f.write("@r3\nA\n+\nh\n")
    got = {(r.read_id, r.seq, r.qual) for r in readers.read_fastq(spark, [a, b]).collect()}
    assert got == {("r1#x", "ACGT", "IIII"), ("r2", "@@", "@I"), ("r3", "A", "h")}
    assert readers.read_fastq(spark, [b], phred=64).first().qual == "I"


@pytest.fixture
def ranges(spark):
    """Sets the size of the ranges that files are cut into, and puts it back."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(k) for k in keys]

    def cut(size):
        for k in keys:
            spark.conf.set(k, str(size))

    yield cut
    for k, v in zip(keys, old, strict=True):
        spark.conf.set(k, v)


def test_fastq_is_cut_anywhere_without_loss(spark, tmp_path, ranges):
    # quality lines that look like headers or separators, records without bases, a quality of one @, a blank end
    rows = [(f"r{i}", "ACGT"[: i % 5], "@+@@"[: i % 5]) for i in range(40)]
    p = put(tmp_path, "a.fq", "".join(f"@{a}\n{b}\n+\n{c}\n" for a, b, c in rows) + "\n")
    put(tmp_path, "b.fq", "\n@x\nAC\n+x\n@@\n@y\r\nA\r\n+\r\n@\r\n@z\nACG\n+")
    for size in (11, 13, 50, 200, 1 << 20):
        ranges(size)
        got = readers.read_fastq(spark, [str(tmp_path)]).orderBy("file", "offset").collect()
        assert [(r.read_id, r.seq, r.qual) for r in got] == [*rows, ("x", "AC", "@@"), ("y", "A", "@"), ("z", "ACG", "")], size
        assert len({(r.file, r.offset) for r in got}) == len(got)
    assert readers.read_fastq(spark, [p]).count() == 40


def test_fastq_batches_of_any_size(spark, tmp_path):
    rows = [(f"r{i}", "ACG", "@" * 3 if i % 3 else "III") for i in range(50)]
    p = put(tmp_path, "a.fq", "".join(f"@{a}\n{b}\n+\n{c}\n" for a, b, c in rows))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    try:
        for size in (1, 2, 7):
            spark.conf.set(key, str(size))
            got = readers.read_fastq(spark, [p]).orderBy("offset").collect()
            assert [(r.read_id, r.seq, r.qual) for r in got] == rows, size
            assert [r.offset for r in got] == sorted({r.offset for r in got})
    finally:
        spark.conf.set(key, old)


def test_fasta_tiles_whatever_the_ranges(spark, tmp_path, ranges):
    rnd = random.Random(5)
    refs = [(f"s{i}", "".join(rnd.choice("acgt") for _ in range(n))) for i, n in enumerate((0, 1, 63, 64, 65, 300, 0, 7, 128))]
    wrap = lambda s: "\n".join(s[i : i + 10] for i in range(0, len(s), 10))
    put(tmp_path, "a.fa", "".join(f">{k} about {k}\n{wrap(s)}\n" for k, s in refs[:5]) + "\n")
    put(tmp_path, "b.fa", "".join(f">{k}\r\n{wrap(s)}\r\n\r\n" for k, s in refs[5:]))
    for tile, overlap in ((64, 0), (64, 35), (16, 40), (1 << 20, 9)):
        want = {(k, at, min(tile, len(s) - at), s.upper()[at : at + tile + overlap]) for k, s in refs for at in range(0, len(s), tile)}
        for size in (12, 40, 1 << 20):
            ranges(size)
            got = readers.fasta_tiles(spark, str(tmp_path), tile, overlap).collect()
            assert len(got) == len(want) and {(r.ref, r.at, r.own, r.seq) for r in got} == want, (tile, overlap, size)


def test_tables(spark, tmp_path):
    aln = readers.read_alignments(spark, put(tmp_path, "a.bwt", "r_x1\t+\tm\t102\tACG\tIII\t0\t\n"))
    assert aln.first().pos == 102
    gtf = readers.read_gtf(spark, put(tmp_path, "a.gtf", '1\tx\texon\t101\t200\t.\t+\t.\tgene_id "g1"; transcript_id "t1";\n1\tx\tCDS\t1\t2\t.\t+\t.\tgene_id "g2";\n'), "exon")
    assert [(r.gene_id, r.transcript_id, r.start) for r in gtf.collect()] == [("g1", "t1", 101)]
    gff = readers.read_gff(spark, put(tmp_path, "a.gff", "1\tx\tgene\t1\t9\t.\t-\t.\tID=gA;Name=n\n"))
    assert gff.first().id == "gA"
    go = readers.read_gene2go(spark, put(tmp_path, "go", "g1\tGO:1\tGO:2\ng2\n"))
    assert {tuple(r) for r in go.collect()} == {("g1", "GO:1"), ("g1", "GO:2")}
    blast = readers.read_blast_tab(spark, put(tmp_path, "b", "q\ts\t99.5\t100\t1\t0\t1\t100\t5\t104\t1e-20\t180\n"))
    assert blast.first().evalue == 1e-20
    wide = readers.read_matrix_long(spark, put(tmp_path, "m", "id\tA\tB\nx\t1\t0\n"))
    assert {tuple(r) for r in wide.collect()} == {("x", "A", 1.0), ("x", "B", 0.0)}
    sheet = readers.sample_sheet(spark, put(tmp_path, "s", "f1\tS1\tg\n\nf2\tS2\n"))
    assert {r.sample for r in sheet.collect()} == {"S1", "S2"}


def test_reports(spark, tmp_path):
    xml = put(tmp_path, "x.xml", "<BlastOutput><Iteration><Iteration_query-def>q1</Iteration_query-def><n>1</n></Iteration><Iteration><Iteration_query-def>q2</Iteration_query-def><n>2</n></Iteration></BlastOutput>")
    assert [r["n"] for r in readers.blast_xml_semi(spark, xml, spark.createDataFrame([("q2",)], "id string")).collect()] == [2]
    mrd = put(tmp_path, "a.mrd", ">p1\ntotal read count 5\npri_seq   acgt\nS_1_x3  acg. 0\nS_2_x2  .cgt 1\n>p2\ntotal read count 0\npri_seq gg\n")
    got = readers.read_mrd(spark, mrd).collect()
    assert [(r.precursor, r.total, r.pri_seq, [x.n for x in r.reads]) for r in got] == [("p1", 5, "acgt", [3, 2])]
    duplex = put(tmp_path, "d", "target: t1\nlength: 9\nmiRNA : m1\n\ntarget: t2\nmiRNA : m2\n")
    assert {tuple(r) for r in readers.read_duplex_text(spark, duplex).collect()} == {("t1", "m1"), ("t2", "m2")}
    fold = readers.read_structures(spark, put(tmp_path, "f", ">h1\nACGU\n(..) (-3.40)\n>h2\nAA\n.. ( 0.00)\n"))
    assert {(r.id, r.structure, r.mfe) for r in fold.collect()} == {("h1", "(..)", -3.4), ("h2", "..", 0.0)}
    lines = readers.read_sections(spark, put(tmp_path, "r", "# head\n\na\nb\n////\nc\n"))
    assert [r.value for r in lines.orderBy("line").collect()] == ["a", "b"]
    blocks = spark.createDataFrame([("No Hits Found above Threshold",), ("hit",)], "value string")
    assert readers.drop_nohit_blocks(blocks).count() == 1


def test_sinks(spark, tmp_path):
    d = spark.createDataFrame([("ath-1", "AC"), ("xx-2", "GG"), ("none", "T")], "id string, seq string")
    sinks.write_fasta(d, str(tmp_path / "fa"))
    assert readers.read_fasta(spark, str(tmp_path / "fa")).count() == 3
    taxa = spark.createDataFrame([("ath", "plant")], "prefix string, taxon string")
    assert {(r.id, r.taxon, r.seq) for r in sinks.shard_by_taxon(d, taxa, True).collect()} == {("ath-1", "plant", "XXACXX"), ("xx-2", "all", "XXGGXX"), ("none", "all", "XXTXX")}
    long = spark.createDataFrame([("x", "B", 2), ("x", "A", 1), ("y", "A", 3)], "id string, sample string, value long")
    sinks.write_matrix(long, ["B", "A"], str(tmp_path / "m"))
    assert spark.read.csv(str(tmp_path / "m"), sep="\t", header=True).columns == ["id", "A", "B"]


def test_upsert_in_batch_and_stream(spark, tmp_path):
    rows = spark.createDataFrame([("s", 1, "5%"), ("s", 2, "6%"), ("t", 1, "7%")], "sample string, at int, pct_n string")
    assert {(r.sample, r.at, r.pct_n) for r in upsert_qc(None, rows, ["sample"], ["at"]).collect()} == {("s", 2, 0.06), ("t", 1, 0.07)}
    src = str(tmp_path / "in")
    rows.drop("pct_n").write.parquet(src)
    q = upsert_stream(spark.readStream.schema("sample string, at int").parquet(src), ["sample"], ["at"], str(tmp_path / "out"), str(tmp_path / "cp"))
    q.processAllAvailable()
    q.stop()
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "out" / "v=0")).select("sample", "at").collect()} == {("s", 2), ("t", 1)}


def test_upsert_touches_only_buckets_of_the_batch(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def put(rows):
        spark.createDataFrame(rows, "k int, at int, v string").coalesce(1).write.mode("append").parquet(src)
        q = upsert_stream(spark.readStream.schema("k int, at int, v string").parquet(src), ["k"], ["at"], out, cp, 8)
        q.processAllAvailable()
        q.stop()

    def shown(before=float("inf")):
        return {tuple(r) for r in read_upserted(spark, out, before).collect()}

    assert read_upserted(spark, out) is None
    first = [(k, 1, "a") for k in range(40)]
    put(first)
    assert shown() == set(first) and (tmp_path / "out" / "v=0").is_dir()
    put([(3, 2, "b"), (5, 0, "late")])
    want = {(k, 2, "b") if k == 3 else (k, 1, "a") for k in range(40)}
    assert shown() == want
    assert 1 <= len(list((tmp_path / "out" / "v=1").glob("upsert_bucket=*"))) <= 2
    assert shown(1) == set(first)  # what the batch started from is still there, should it run again
    put([(3, 3, "c")])
    assert shown() == {(k, 3, "c") if k == 3 else (k, 1, "a") for k in range(40)}
    # key 3's bucket had been replaced by v=1 before this batch began
    assert len(list((tmp_path / "out").glob("v=*/upsert_bucket=*"))) <= 8 + 2
    # a version without its mark does not count
    (tmp_path / "out" / "v=2" / "_SUCCESS").unlink()
    assert shown() == want
