"""Nested records, reports and id look-ups: precursor records, edit sites, term tables, packed lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from strandloom.functions.keys import marked
from strandloom.functions.locusarrays import FAR, joined, portions
from strandloom.functions.scratch import result, scope, table
from strandloom.functions.seq import pieces, reverse_complement
from strandloom.functions.seqarrays import aligned, mask, site_counts
from strandloom.operators.table import cumulative_sum, dealt_by, range_bounds

#: Letters of a chromosome that candidates meet at once.
_TILE = 512


def rfam_compose(hits: DataFrame, total: int | None = None) -> DataFrame:
    """hits (ref, n): reads by class (second field of ``a;class;...``) and species (after the last colon), percent of all and of mapped."""
    by = hits.groupBy(F.split_part("ref", F.lit(";"), F.lit(2)).alias("class"), F.element_at(F.split("ref", ":"), -1).alias("species")).agg(F.sum("n").alias("n"))
    mapped = by.agg(F.sum("n").alias("mapped"))
    all_ = F.lit(total) if total else F.col("mapped")
    return by.crossJoin(F.broadcast(mapped)).select("class", "species", "n", F.round(100 * F.col("n") / all_, 4).alias("of_total"), F.round(100 * F.col("n") / F.col("mapped"), 4).alias("of_mapped"))


def nt_edit_sites(reads: DataFrame) -> DataFrame:
    """reads (precursor, mature, beg, seq, ref, n; ref is the mature's sequence, beg the read's place in it): per site coverage,
    edited reads and their percent by substitution X->Y. Only reads wholly inside the mature count."""
    inside = reads.where((F.col("beg") >= 0) & (F.col("beg") + F.length("seq") <= F.length("ref")))
    key = ["precursor", "mature"]
    site = site_counts(inside.dropna(subset=key), key).withColumn("coverage", F.sum("n").over(Window.partitionBy(*key, "pos")))
    return site.where("x <> y").select(*key, "pos", F.concat("x", F.lit("->"), "y").alias("sub"), F.col("n").alias("edited"), "coverage", F.round(100 * F.col("n") / F.col("coverage"), 4).alias("percent"))


def mrd_assemble(precursors: DataFrame, windows: DataFrame, reads: DataFrame) -> DataFrame:
    """One nested record per precursor: total, mask (M in a mature, S in a star, l between, f outside) and reads in order.

    precursors: precursor, seq; windows: precursor, kind (M or S), beg, end (0-based closed); reads: precursor, beg, seq, n.
    Mismatching letters of a read are upper case, the others lower. A precursor's reads are brought together once, as its record holds
    them, and shown beside its sequence a batch of precursors at a time.
    """
    p = precursors.join(windows.groupBy("precursor").agg(F.collect_list(F.struct("kind", "beg", "end")).alias("w")), "precursor", "left")
    given = dict(reads.dtypes)
    g = reads.groupBy("precursor").agg(F.sum("n").alias("total"), F.collect_list(F.struct("beg", "seq", "n")).alias("given"))
    shown = p.join(g, "precursor").select("precursor", "total", mask(F.length("seq"), F.col("w")).alias("mask"), F.col("seq").alias("pri_seq"), aligned(F.col("seq"), F.col("given"), (given["beg"], given["n"])).alias("reads"))
    return shown.withColumn("reads", F.sort_array("reads"))


def go_class_table(gene2go: DataFrame, terms: DataFrame, spaces: list[str]) -> DataFrame:
    """Per gene and namespace: ids and names joined by //, -- for none; ``unknown``: its terms that have no entry."""
    j = gene2go.join(terms, "term", "left")
    own = lambda s, c: F.array_join(F.array_sort(F.collect_set(F.when(F.col("namespace") == s, F.col(c)))), "//")
    cols = [F.when(own(s, c) == "", "--").otherwise(own(s, c)).alias(f"{s}_{n}") for s in spaces for c, n in (("term", "ids"), ("name", "names"))]
    return j.groupBy("gene").agg(*cols, F.count_if(F.col("namespace").isNull()).alias("unknown"))


def nat_table_split(table: DataFrame, seqs: DataFrame) -> DataFrame:
    """Sequences of either partner of cis and trans pairs. table: kind, a, b; seqs: id, seq."""
    ids = table.select("kind", F.explode(F.array("a", "b")).alias("id")).distinct()
    return ids.join(seqs, "id")


def phased_loci(loci: DataFrame, genome: DataFrame, p: float = 1e-5, n: int = 5) -> DataFrame:
    """Loci (chrom, start, end, phased, p) that are significant, cut at the sequence's end, with their sequence."""
    j = pieces(loci.where((F.col("p") < p) & (F.col("phased") > n)), genome, "chrom", F.col("start"), F.least("end", "__size"))
    return j.where("__to >= start").select("chrom", "start", F.col("__to").alias("end"), F.col("__piece").alias("seq"))


def term_ids(enrich: DataFrame, annot: DataFrame, drop: list[str]) -> DataFrame:
    """enrich (id, genes packed by |) with the ids of annot (gene, ko, symbol), packed in the same order, NA for none."""
    e = enrich.where(~F.col("id").isin(drop)).select("id", F.posexplode(F.split("genes", r"\|")).alias("i", "gene"))
    j = e.join(annot, "gene", "left")
    packed = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", F.coalesce(c, F.lit("NA")).alias("v")))), lambda x: x["v"]), "|")
    return j.groupBy("id").agg(*[packed(c).alias(c) for c in ("gene", "ko", "symbol")])


def ko_gene_groups(enrich: DataFrame) -> DataFrame:
    """Parallel lists genes and kos (packed by |) to each KO's genes; NA left out."""
    z = enrich.select("id", F.explode(F.arrays_zip(F.split("genes", r"\|").alias("g"), F.split("kos", r"\|").alias("k"))).alias("z"))
    return z.where("z.k is not null and z.k <> 'NA'").groupBy("id", F.col("z.k").alias("ko")).agg(F.array_join(F.array_sort(F.collect_set("z.g")), ",").alias("genes"))


def hairpin_mature_report(counts: DataFrame, pairs: DataFrame, hairpins: DataFrame, matures: DataFrame, structures: DataFrame | None = None) -> DataFrame:
    """counts (mature, n) with pair, both sequences, and energy and place where structures (hairpin, mfe, pos) are given, else --."""
    out = counts.join(pairs, "mature", "left").join(hairpins.select("hairpin", F.col("seq").alias("hairpin_seq")), "hairpin", "left").join(matures.select("mature", F.col("seq").alias("mature_seq")), "mature", "left")
    if structures is not None:
        out = out.join(structures.select("hairpin", F.col("mfe").cast("string").alias("mfe"), F.col("pos").cast("string").alias("pos")), "hairpin", "left")
    else:
        out = out.withColumn("mfe", F.lit(None).cast("string")).withColumn("pos", F.lit(None).cast("string"))
    return out.na.fill("--", ["mfe", "pos", "hairpin_seq", "mature_seq", "hairpin"])


def novel_dedup(pred: DataFrame) -> DataFrame:
    """Predictions (seq, star, score, id): the best per mature sequence, numbered, as mature and star rows."""
    first = pred.withColumn("k", F.row_number().over(Window.partitionBy("seq").orderBy(F.desc("score"), "id"))).where("k = 1")
    return first.select("id", F.explode(F.array(F.struct(F.lit("mature").alias("kind"), F.col("seq").alias("s")), F.struct(F.lit("star").alias("kind"), F.col("star").alias("s")))).alias("x")).select("id", "x.kind", F.col("x.s").alias("seq"))


def hairpin_candidate_filter(loci: DataFrame, abundance: int = 5, hits: int = 16, oriented: float = 0.9, islands: int = 3, overlap: int = 70, gc: float = 0.1, energy: float = -25, paired: int = 17) -> DataFrame:
    """Loci (of ``hairpin_loci``) that pass the finder's limits; energy and paired bases are input columns, since they need folding."""
    c = F.col
    return loci.where((c("abundance") >= abundance) & (c("hits") <= hits) & (c("oriented") >= oriented) & (c("islands") <= islands) & (c("overlap") <= overlap) & (c("gc") >= gc) & (c("energy") <= energy) & (c("paired") >= paired))


def hairpin_loci(aln: DataFrame, genome: DataFrame, sizes: tuple[int, int] = (20, 22), distance: int = 200, most: int = 3) -> DataFrame:
    """Loci of small RNAs and what the finder asks of them, a row each:
    chrom, beg, end, strand, abundance, hits, oriented, islands, overlap, gc.

    aln: chrom, strand, beg, end (half-open), read, n: an alignment of n equal reads a row; genome: chrom, seq. Alignments whose
    length is in ``sizes`` form a locus with those at most ``distance`` bases on. Its strand is that of most reads (+ where
    equal) and ``oriented`` their share; ``abundance`` the reads; ``hits`` the alignments (of any length, everywhere) of its candidate, which is the
    alignment of most reads (ties: the least read, strand, place), and ``gc`` the candidate's share of G and C (null off the sequence);
    ``islands`` the largest number of alignments of which no two share a base, where more than ``most`` count as most + 1;
    ``overlap`` the bases that the longest run of overlapping alignments covers.

    Alignments are dealt once, by ranges of their order, and with them the tiles of the genome that they may begin in. A range is read in order, a batch at a
    time: loci inside it are whole; those over an edge leave a portion with its sums, and what it adds to the alignments apart for every place
    where the last one before it may end (as many as the longest alignment has bases). So no task holds a locus, and at most two portions a range
    are put together at the end.
    """
    spark, size, given = aln.sparkSession, F.col("end") - F.col("beg"), dict(aln.dtypes)
    span = aln.select((F.col("end") - F.col("beg")).alias("span")).dtypes[0][1]
    with scope(spark):
        fits = size.between(max(sizes[0], 1), sizes[1]) & F.col("chrom").isNotNull()
        rows = aln.where(F.col("read").isNotNull()).select("read", *[F.when(fits, F.col(c).cast(t) if t else F.col(c)).alias(c) for c, t in (("chrom", None), ("beg", "long"), ("end", "long"), ("n", "long"), ("strand", None))])
        fit = rows.where(F.col("chrom").isNotNull())
        order = ["chrom", "beg", "end", "read"]
        bounds = table(range_bounds(fit, order), "bounds")
        key = F.struct(*order)
        few = bounds.select(F.explode("__bounds").alias("b")).select("b.chrom").distinct()
        # only a chromosome that holds a bound is in several ranges
        spread = dealt_by(fit.join(F.broadcast(few), "chrom", "left_semi"), bounds, key).groupBy("chrom", "__part").agg(F.min("beg").alias("beg"), F.max("end").alias("end"))
        edges = _edges(spread.collect())
        hits = rows.withColumn("hits", F.count("*").over(Window.partitionBy("read"))).where(F.col("chrom").isNotNull())
        columns = ["chrom", "beg", "end", "n", "strand", "read", "hits"]
        dealt = dealt_by(hits, bounds, key).select(F.col("__part").alias("part"), *columns, F.lit(None).cast("string").alias("tile"))
        letters = marked(genome.select(F.col("chrom").cast(given["chrom"]).alias("chrom"), "seq"), "chrom", fit.select("chrom"), "__met").where("__met")
        tiles = letters.select("chrom", F.posexplode(F.regexp_extract_all("seq", F.lit(f"(?s)(?=(.{{1,{_TILE + sizes[1]}}})).{{1,{_TILE}}}"), F.lit(1))).alias("no", "tile"))
        tiles = tiles.withColumn("beg", F.when(F.col("no") == 0, -FAR // 2).otherwise(F.col("no").cast("long") * _TILE))  # before what begins off the sequence
        place = lambda beg: F.struct("chrom", beg.alias("beg"), F.lit(None).cast("long").alias("end"), F.lit(None).cast(given["read"]).alias("read"))
        tiles = dealt_by(dealt_by(tiles, bounds, place(F.col("beg")), "__low"), bounds, place((F.col("no").cast("long") + 1) * _TILE), "__high")
        empty = {"end": "long", "strand": given["strand"], "read": given["read"], "hits": "long"}
        tiles = tiles.withColumns({"n": F.col("no").cast("long"), **{c: F.lit(None).cast(t) for c, t in empty.items()}}).select(F.explode(F.sequence("__low", "__high")).alias("part"), *columns, "tile")
        ranges = int(spark.conf.get("spark.sql.shuffle.partitions")) + 1
        sorted_ = dealt.union(tiles).repartitionById(ranges, F.col("part")).sortWithinPartitions("part", "chrom", "beg", F.asc_nulls_first("end"))
        made = (
            f"chrom {given['chrom']}, beg long, end long, abundance long, plus long, hits long, gc double, islands long, overlap long, edge struct<part: int, left: boolean, right: boolean, less: long, read: {given['read']}, "
            f"strand: {given['strand']}, at: long, to: long, head: long, tail: long, single: boolean, counts: array<int>, ends: array<long>>"
        )
        kind = StructType.fromDDL(made)
        schema = to_arrow_schema(kind)
        found = result(sorted_.mapInArrow(lambda batches: portions(batches, schema, edges, distance, most, sizes[1], _TILE), kind), "loci")
        over = joined(found.where("edge is not null").collect(), most)
        loci = found.where("edge is null").drop("edge")
        loci = loci.union(spark.createDataFrame(over, loci.schema)) if over else loci
        minus = F.col("abundance") - F.col("plus")
        return loci.select(
            "chrom", F.col("beg").cast(given["beg"]).alias("beg"), F.col("end").cast(given["end"]).alias("end"), F.when(F.col("plus") >= minus, "+").otherwise("-").alias("strand"), "abundance", "hits",
            F.try_divide(F.greatest("plus", minus), "abundance").alias("oriented"), "islands", F.col("overlap").cast(span).alias("overlap"), "gc",
        )


def _edges(rows: list) -> dict[int, tuple[int | None, int | None]]:
    """Of chromosomes in several ranges (chrom, __part, beg, end), by range: where what lies in the ranges before ends, where the next one begins."""
    out: dict[int, tuple[int | None, int | None]] = {}
    by: dict = {}
    for r in rows:
        by.setdefault(r.chrom, []).append((r["__part"], r.beg, r.end))
    for own in by.values():
        own.sort()
        upto = None
        for (part, _, end), (after, beg, _) in zip(own, own[1:], strict=False):
            upto = end if upto is None else max(upto, end)
            out[part] = (out.get(part, (None, None))[0], beg)
            out[after] = (upto, out.get(after, (None, None))[1])
    return out


def read_stacks(aln: DataFrame, max_hits: int = 5, reach: int = 70, gear: int = 50_000) -> DataFrame:
    """Stacks of reads that stand out: chrom, strand, beg, end, height, hits; at most ``gear`` of them.

    aln: chrom, strand, beg, end (half-open), read, n: an alignment of n equal reads a row. Reads with more than max_hits
    alignments are left out. The height of a place is the number of reads that begin there; a stack is a place than which none within
    ``reach`` bases of its strand is higher, nor as high and before it; it ends where the longest read of its place does, and has as
    many hits as the most scattered of them. Of all stacks those of the least height stay that leaves no more than ``gear``:
    equal heights stay or go together.

    Places meet their neighbours in bins as wide as the reach (each place in its own and the two beside it), so no task holds a
    chromosome; the height to keep comes from running sums over the distinct heights, by ranges.
    """
    few = aln.groupBy("read").agg(F.count("*").alias("hits")).where(F.col("hits") <= max_hits)
    places = aln.join(few, "read").groupBy("chrom", "strand", "beg").agg(F.sum("n").cast("long").alias("height"), F.max("end").alias("end"), F.max("hits").alias("hits"))
    own = F.floor(F.col("beg") / reach)
    binned = places.withColumn("bin", F.explode(F.array(own - 1, own, own + 1)))
    around = Window.partitionBy("chrom", "strand", "bin").orderBy("beg")
    higher = F.max("height").over(around.rangeBetween(-reach, reach))
    before = F.max("height").over(around.rangeBetween(-reach, -1))
    peaks = binned.withColumns({"top": higher, "before": before}).where((F.col("bin") == own) & (F.col("height") == F.col("top")) & (F.coalesce("before", F.lit(0)) < F.col("height")))
    peaks = peaks.select("chrom", "strand", "beg", "end", "height", "hits")
    counts = peaks.groupBy((-F.col("height")).alias("low")).agg(F.count("*").alias("k"))
    kept = cumulative_sum(counts, "k", ["low"], "upto").where(F.col("upto") <= gear).agg(F.max("low").alias("low"))
    return peaks.join(F.broadcast(kept), -F.col("height") <= F.col("low")).drop("low")


def precursor_stack_excise(stacks: DataFrame, genome: DataFrame, max_hits: int = 5, flank: int = 70) -> DataFrame:
    """Windows around stacks (chrom, beg, end half-open, strand, hits) of at most max_hits hits, with their sequence."""
    j = pieces(stacks.where(F.col("hits") <= max_hits), genome, "chrom", F.greatest(F.lit(1), F.col("beg") - flank + 1), F.least("__size", F.col("end") + flank))
    s = F.col("__piece")
    return j.where(F.col("beg") < F.col("__size")).select("chrom", (F.col("__from") - 1).alias("from"), F.col("__to").alias("to"), "strand", F.when(F.col("strand") == "-", reverse_complement(s)).otherwise(s).alias("seq"))
