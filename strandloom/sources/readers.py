"""Readers of sequence files and reports: Spark's own sources with the right separators, then expressions.

FASTQ has four lines a record and no separator that a quality line cannot hold, and a wrapped FASTA sequence has no bound; both
follow the lines of a range of a file in their order, as Arrow columns.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_fasta(spark: SparkSession, path, upper: bool = True, drop_n: bool = False, line: int | None = None) -> DataFrame:
    """id (first word), description, seq; wrapped sequences are joined. ``line``: only that line of a sequence (from 1)."""
    raw = spark.read.option("lineSep", "\n>").text(path).where(F.length(F.trim("value")) > 0)
    lines = F.transform(F.split(F.regexp_replace("value", r"^>", ""), "\n"), lambda x: F.rtrim(F.regexp_replace(x, "\r", "")))
    head = F.get(lines, 0)
    body = F.slice(lines, 2, 1 << 30)
    seq = F.coalesce(F.get(body, line - 1), F.lit("")) if line else F.array_join(body, "")
    out = raw.select(F.regexp_extract(head, r"^(\S*)", 1).alias("id"), F.trim(F.regexp_extract(head, r"^\S*\s*(.*)$", 1)).alias("description"), (F.upper(seq) if upper else seq).alias("seq"))
    return out.where(~F.upper("seq").contains("N")) if drop_n else out


def text_lines(spark: SparkSession, paths) -> DataFrame:
    """value, file, block: lines in the file's order within the range (which begins at byte ``block``) that they begin in."""
    return spark.read.text(paths).selectExpr("value", "_metadata.file_path AS file", "_metadata.file_block_start AS block")


def _by_range(batches):
    """(file, block, lines): the lines of a range, in as many parts as batches hold some of them."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = batch.column("file"), batch.column("block").to_numpy()
        other = np.asarray(pc.not_equal(file.slice(1), file.slice(0, len(file) - 1))).astype(bool) | (block[1:] != block[:-1])
        cuts = [0, *(np.flatnonzero(other) + 1), len(file)]
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            yield file[i].as_py(), int(block[i]), batch.column("value").slice(i, j - i)


def _starts(lines: pa.Array) -> np.ndarray:
    """Bytes before each line, and of all; what a range has of the line before it is not counted, so a line's start stays inside its range."""
    return np.concatenate([[0], np.cumsum(np.asarray(pc.binary_length(lines)) + 1)]).astype(np.int64)


def _without_blank_heads(lines: pa.Array) -> pa.Array:
    while True:
        blank = np.flatnonzero(np.asarray(pc.equal(pc.utf8_trim_whitespace(lines.take(pa.array(range(0, len(lines), 4)))), "")))
        if not len(blank):
            return lines
        at = 4 * int(blank[0])
        lines = pa.concat_arrays([lines.slice(0, at), lines.slice(at + 1)])


def _fastq_records(batches):
    """Records that lie in one range: file, offset, read_id, seq, qual; of a gz file also a last one that is cut off."""
    for kind, file, offset, lines in _fastq_parts(batches):
        if kind == "edge" and file.endswith(".gz"):
            lines, offset = pa.concat_arrays([lines, pa.array([""] * (4 - len(lines)), pa.string())]), offset[:1]
        elif kind == "edge":
            continue
        else:
            offset = offset[::4]
        line = lambda k: lines.take(pa.array(np.arange(k, len(lines), 4)))  # noqa: E731, B023
        yield pa.RecordBatch.from_pydict({"file": pa.array([file] * len(offset)), "offset": pa.array(offset), "read_id": pc.utf8_slice_codeunits(line(0), 1), "seq": line(1), "qual": line(3)})


def _fastq_edges(batches):
    """Lines of records that begin in one range and end in another: file, offset, line."""
    for kind, file, offset, lines in _fastq_parts(batches):
        if kind == "edge":
            yield pa.RecordBatch.from_pydict({"file": pa.array([file] * len(lines)), "offset": pa.array(offset), "line": lines})


def _fastq_parts(batches):
    """(kind, file, offsets, lines): ``whole`` has lines of whole records, four each; ``edge`` up to three lines before or after them.

    Inside a file a record begins at a line with ``@`` whose next line but one has ``+``: a quality line may begin with ``@`` too, but
    is followed by a header and a sequence. From there on every fourth line is one.
    """
    none = pa.array([], pa.string())
    key, held, place, found = None, none, 0, False
    for file, block, lines in _by_range(batches):
        if (file, block) != key:
            if len(held):
                yield "edge", key[0], place + _starts(held)[:-1], held
            key, held, place, found = (file, block), none, block, block == 0
        lines = pa.concat_arrays([held, lines])
        if not found:
            starts = np.asarray(pc.starts_with(lines, "@"))[:-2] & np.asarray(pc.starts_with(lines, "+"))[2:]
            if not starts.any():
                held = lines
                continue
            found, skip = True, int(np.argmax(starts))
            if skip:
                at = place + _starts(lines.slice(0, skip))
                yield "edge", file, at[:-1], lines.slice(0, skip)
                place, lines = int(at[-1]), lines.slice(skip)
        lines = _without_blank_heads(lines)
        whole = lines.slice(0, len(lines) // 4 * 4)
        if len(whole):
            at = place + _starts(whole)
            yield "whole", file, at[:-1], whole
            place = int(at[-1])
        held = lines.slice(len(whole))
    if len(held):
        yield "edge", key[0], place + _starts(held)[:-1], held


#: Letters of a sequence that travel to their tiles at once.
PIECE = 4096


def _fasta_pieces(batches):
    """Consecutive lines of one sequence, joined: file, block, no (in the range), ref (null: of a sequence that began before the range), at, seq."""
    key, no, ref, at = None, 0, None, 0
    for file, block, lines in _by_range(batches):
        if (file, block) != key:
            key, no, ref, at = (file, block), 0, None, 0
        heads = np.flatnonzero(np.asarray(pc.starts_with(lines, ">")))
        cuts = heads if len(heads) and heads[0] == 0 else np.concatenate([[0], heads])
        text = pc.if_else(pc.starts_with(lines, ">"), "", pc.utf8_trim_whitespace(lines))
        seq = pc.binary_join(pa.ListArray.from_arrays(pa.array([*cuts, len(lines)], pa.int32()), text), "")
        names = pc.replace_substring_regex(lines.take(pa.array(heads)), r"^>(\S*).*$", r"\1")
        goes_on = len(cuts) > len(heads)
        refs = pa.concat_arrays([pa.array([ref], pa.string()), names]) if goes_on else names
        begins = np.zeros(len(cuts), np.int64)
        begins[0] = at if goes_on else 0
        yield pa.RecordBatch.from_pydict({"file": pa.array([file] * len(cuts)), "block": pa.array([block] * len(cuts)), "no": pa.array(no + np.arange(len(cuts))), "ref": refs, "at": pa.array(begins), "seq": seq})
        no, ref, at = no + len(cuts), refs[-1].as_py(), int(begins[-1]) + len(seq[-1].as_py())


def fasta_tiles(spark: SparkSession, paths, tile: int = 1 << 20, overlap: int = 0, upper: bool = True) -> DataFrame:
    """ref, at, own, seq: sequences in tiles of ``tile`` letters from place ``at`` (0-based), each followed by ``overlap`` letters of the next ones.

    ``own``: letters of the tile without the overlap. Files are read in byte ranges and no row holds a whole sequence, however long, as long as its lines are wrapped; where
    a range begins inside a sequence, its name and place follow from one row a range. A sequence without letters has no tile. Names (the
    first word of a header) are unique within a file.
    """
    pieces_ = text_lines(spark, paths).mapInArrow(_fasta_pieces, "file string, block bigint, no bigint, ref string, at bigint, seq string")
    size = F.length("seq")
    last = F.max(F.struct("no", "ref", (F.col("at") + size).alias("after")))
    ranges = pieces_.groupBy("file", "block").agg(last.alias("last"), F.sum(size).alias("all"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("file", "block", "last", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("upto"), "all")
    # where the sequence that a range ends in began, in letters of the file
    named = F.when(F.col("last.ref").isNotNull(), F.struct(F.col("last.ref").alias("ref"), (F.col("upto") + F.col("all") - F.col("last.after")).alias("begin")))
    ranges = ranges.select("file", "block", "upto", F.last(named, ignorenulls=True).over(before).alias("open"))
    p = pieces_.where(size > 0).join(ranges, ["file", "block"])
    goes_on = F.col("ref").isNull()
    place = F.when(goes_on, F.col("upto") - F.col("open.begin")).otherwise(0) + F.col("at")
    # short pieces first: a letter's place in a string is found by walking to it
    short = F.posexplode(F.regexp_extract_all("seq", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))).alias("i", "piece")
    p = p.select("file", F.when(goes_on, F.col("open.ref")).otherwise(F.col("ref")).alias("ref"), place.alias("begin"), short).where("ref is not null")
    p = p.select("file", "ref", (F.col("begin") + F.col("i").cast("long") * PIECE).alias("place"), F.upper("piece").alias("piece") if upper else "piece")
    size = F.length("piece")
    first, final = F.greatest(F.lit(0), F.floor((F.col("place") - overlap) / tile)), F.floor((F.col("place") + size - 1) / tile)

    def cut(no: Column) -> Column:
        start, stop = F.greatest(F.col("place"), no * tile), F.least(F.col("place") + size, (no + 1) * tile + overlap)
        return F.struct(no.alias("tile_no"), start.alias("start"), F.substr("piece", (start - F.col("place") + 1).cast("int"), (stop - start).cast("int")).alias("part"))

    p = p.select("file", "ref", F.explode(F.transform(F.sequence(first, final), cut)).alias("x")).select("file", "ref", "x.*")
    parts = p.groupBy("file", "ref", "tile_no").agg(F.array_sort(F.collect_list(F.struct("start", "part"))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda x: x["part"]), "")
    tiles = parts.select("ref", (F.col("tile_no") * tile).alias("at"), text.alias("seq"))
    return tiles.select("ref", "at", F.least(F.lit(tile), F.length("seq")).alias("own"), "seq")


def read_fastq(spark: SparkSession, paths: list[str], phred: int = 33) -> DataFrame:
    """read_id, seq, qual (as Phred + 33), file, offset (grows with the place in the file).

    Spark's text source cuts plain files into byte ranges (``spark.sql.files.maxPartitionBytes``), wherever Spark can read; a gz file is one.
    Records that lie in one range are put together there, as Arrow columns; those that reach into the next one, at most one a range,
    by the order of their lines, for which plain files are read twice. Blank lines before the first and after the last record are
    skipped; what a last record that is cut off lacks is empty.
    """
    lines = text_lines(spark, paths)
    whole = lines.mapInArrow(_fastq_records, "file string, offset bigint, read_id string, seq string, qual string")
    edges = lines.where(~F.col("file").endswith(".gz")).mapInArrow(_fastq_edges, "file string, offset bigint, line string")
    k = F.row_number().over(Window.partitionBy("file").orderBy("offset")) - 1
    four = edges.withColumn("k", k).groupBy("file", F.floor(F.col("k") / 4)).agg(F.min("offset").alias("offset"), *[F.max(F.when(F.col("k") % 4 == i, F.col("line"))).alias(f"x{i}") for i in range(4)])
    text = lambda i: F.coalesce(f"x{i}", F.lit(""))
    crossing = four.where(F.trim("x0") != "").select("file", "offset", F.expr("substr(x0, 2)").alias("read_id"), text(1).alias("seq"), text(3).alias("qual"))
    out = whole.unionByName(crossing)
    if phred != 33:
        old = "".join(chr(i) for i in range(phred, 127))
        out = out.withColumn("qual", F.translate("qual", old, "".join(chr(ord(c) - phred + 33) for c in old)))
    return out.select("read_id", "seq", "qual", "file", "offset")


def fastq_to_fasta(df: DataFrame) -> DataFrame:
    """The lines of a FASTA file."""
    return df.select(F.concat(F.lit(">"), "read_id", F.lit("\n"), "seq").alias("value"))


ALIGNMENT = "read_id string, strand string, ref string, pos int, seq string, qual string, ceil int, mism string"
GTF = "chrom string, source string, feature string, start int, end int, score string, strand string, frame string, attributes string"
BLAST12 = "qid string, sid string, identity double, len int, mis int, gapopen int, qstart int, qend int, sstart int, send int, evalue double, score double"
BLAST14 = "qid string, qlen int, sid string, slen int, alen int, qstart int, qend int, sstart int, send int, evalue double, score double, pident double, mismatch int, gaps int"


def _tab(spark: SparkSession, path, schema: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=schema, comment="#", quote="")  # quality strings may hold quotes


def read_alignments(spark: SparkSession, path) -> DataFrame:
    return _tab(spark, path, ALIGNMENT)


def read_gtf(spark: SparkSession, path, feature: str | None = None) -> DataFrame:
    value = lambda k: F.regexp_extract("attributes", rf'{k} "?([^";]+)"?', 1)
    out = spark.read.csv(path, sep="\t", schema=GTF, comment="#", quote="").select("*", value("gene_id").alias("gene_id"), value("transcript_id").alias("transcript_id"))
    return out.where(F.col("feature") == feature) if feature else out


def read_gff(spark: SparkSession, path, feature: str | None = None) -> DataFrame:
    out = spark.read.csv(path, sep="\t", schema=GTF, comment="#", quote="").withColumn("attr", F.str_to_map("attributes", F.lit(";"), F.lit("="))).withColumn("id", F.col("attr")["ID"])
    return out.where(F.col("feature") == feature) if feature else out


def read_gene2go(spark: SparkSession, path) -> DataFrame:
    """Ragged lines ``gene term term ...`` to (gene, term)."""
    parts = F.split("value", "\t")
    return spark.read.text(path).select(parts[0].alias("gene"), F.explode(F.slice(parts, 2, 1 << 20)).alias("term")).where("term <> ''")


def read_blast_tab(spark: SparkSession, path, layout: int = 12) -> DataFrame:
    return _tab(spark, path, BLAST12 if layout == 12 else BLAST14)


def blast_xml_semi(spark: SparkSession, path, ids: DataFrame) -> DataFrame:
    """Iterations of a search report whose query is in ids (id)."""
    x = spark.read.format("xml").option("rowTag", "Iteration").load(path)
    return x.join(ids.select(F.col("id").alias("Iteration_query-def")), "Iteration_query-def", "left_semi")


def read_mrd(spark: SparkSession, path) -> DataFrame:
    """Blocks of precursors to precursor, total, pri_seq and reads; those with a total above 0."""
    lines = F.split(F.regexp_replace("value", r"^>", ""), "\n")
    field = lambda name: F.regexp_extract(F.get(F.filter(lines, lambda x: x.startswith(name)), 0), r"(\S+)\s*$", 1)
    reads = F.transform(F.filter(lines, lambda x: x.rlike(r"^\S+_x\d+\s")), lambda x: F.struct(F.regexp_extract(x, r"^(\S+)", 1).alias("id"), F.regexp_extract(x, r"^\S+\s+(\S+)", 1).alias("aligned"), F.regexp_extract(x, r"_x(\d+)\s", 1).cast("long").alias("n")))
    out = spark.read.option("lineSep", "\n>").text(path).select(F.trim(F.get(lines, 0)).alias("precursor"), field("total read count").cast("long").alias("total"), field("pri_seq").alias("pri_seq"), reads.alias("reads"))
    return out.where("total > 0")


def read_duplex_text(spark: SparkSession, path) -> DataFrame:
    raw = spark.read.option("lineSep", "target:").text(path)
    pair = raw.select(F.regexp_extract("value", r"^\s*(\S+)", 1).alias("target"), F.regexp_extract("value", r"miRNA\s*:\s*(\S+)", 1).alias("mirna"))
    return pair.where("mirna <> ''").distinct()


def read_structures(spark: SparkSession, path) -> DataFrame:
    """Three-line records: id, seq, structure and its energy from ``(x)`` at the end."""
    lines = F.split(F.regexp_replace("value", r"^>", ""), "\n")
    return spark.read.option("lineSep", "\n>").text(path).select(F.regexp_extract(F.get(lines, 0), r"^(\S+)", 1).alias("id"), F.get(lines, 1).alias("seq"), F.regexp_extract(F.get(lines, 2), r"^([.()]+)", 1).alias("structure"), F.regexp_extract(F.get(lines, 2), r"\(\s*(-?[\d.]+)\)\s*$", 1).cast("double").alias("mfe"))


def read_hit_blocks(spark: SparkSession, path) -> DataFrame:
    """Blocks of a search report, each ended by ``Complete``, that have hits."""
    blocks = spark.read.option("lineSep", "Complete").text(path).select(F.trim(F.regexp_replace("value", r"^\s+|\s+$", "")).alias("block"))
    return drop_nohit_blocks(blocks.where("block <> ''"), "block")


def drop_nohit_blocks(df: DataFrame, col: str = "value") -> DataFrame:
    return df.where(~F.col(col).contains("No Hits Found above Threshold"))


def read_matrix_long(spark: SparkSession, path, key: str = "id") -> DataFrame:
    wide = spark.read.csv(path, sep="\t", header=True)
    return melt(wide, key)


def melt(wide: DataFrame, key: str) -> DataFrame:
    values = [c for c in wide.columns if c != key]
    return wide.select(key, *[F.col(c).cast("double").alias(c) for c in values]).unpivot(key, values, "sample", "value")


def read_sections(spark: SparkSession, path: str, skip: str = r"^[#@]|^\s*$", stop: str = r"^(////|----)") -> DataFrame:
    """Lines of report files up to a marker, without comments and blanks; each file is one record, so its order holds."""
    whole = spark.read.text(path, wholetext=True)
    lines = F.split("value", "\r?\n")
    end = F.array_min(F.transform(F.filter(F.transform(lines, lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda t: t["x"].rlike(stop)), lambda t: t["i"]))
    kept = F.slice(lines, F.lit(1), F.coalesce(end, F.size(lines)))
    return whole.select(F.posexplode(kept).alias("line", "value")).where(~F.col("value").rlike(skip))


def sample_sheet(spark: SparkSession, path) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema="file string, sample string, grp string").where("file is not null and sample is not null")


def merge_sample_files(dfs: list[DataFrame]) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out
