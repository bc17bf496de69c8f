"""Counts of features, classes and expression matrices over alignments (sample, read_id, strand, ref, pos, n)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions.seq import half_up
from strandloom.operators.order import density, quantiles
from strandloom.operators.table import cumulative_sum, islands, numbered

#: Tasks for each part of the input where rows are sorted by read.
SHARE = 8


def zero(c) -> Column:
    return F.coalesce(c, F.lit(0).cast("long"))


def feature_counts(aln: DataFrame, refs: DataFrame, strands: bool = False, weighted: bool = False) -> DataFrame:
    """Per reference and sample: reads and counts per million of the sample; references without hits stay with 0."""
    if weighted:
        aln = aln.withColumn("n", F.col("n") / F.count("*").over(Window.partitionBy("read_id")))
    by = ["ref", "sample", *(["strand"] if strands else [])]
    got = aln.groupBy(*by).agg(F.sum("n").alias("n"))
    every = refs.select("ref").crossJoin(F.broadcast(aln.select(*by[1:]).distinct()))
    total = got.groupBy("sample").agg(F.sum("n").alias("t"))
    out = every.join(got, by, "left").join(F.broadcast(total), "sample", "left")
    n = F.coalesce("n", F.lit(0))
    return out.select(*by, n.alias("n"), F.round(F.coalesce(1e6 * n / F.col("t"), F.lit(0.0)), 4).alias("cpm"))


def feature_uniq_counts(aln: DataFrame) -> DataFrame:
    """Per reference and sample: distinct reads, and their weights one over the hits of the read.

    Rows are dealt by read once, to ``SHARE`` tasks for each part of the input, so what a task sorts does not grow with the table; only
    sums go further.
    """
    rows = aln.select("read_id", "ref", "sample")
    parts = max(int(aln.sparkSession.conf.get("spark.sql.shuffle.partitions")), SHARE * rows.rdd.getNumPartitions())
    once = rows.repartition(parts, "read_id").groupBy("read_id", "ref", "sample").agg(F.count("*").alias("k"))
    m = once.withColumn("w", F.col("k") / F.sum("k").over(Window.partitionBy("read_id")))
    return m.groupBy("ref", "sample").agg(F.count("read_id").alias("uniq"), F.round(F.sum("w"), 4).alias("weight"))


def class_totals(aln: DataFrame, kind: str) -> DataFrame:
    """Reads by class and sample, and by class, strand and sample (strand ``all`` for both)."""
    both = aln.groupBy(kind, "sample").agg(F.sum("n").alias("n")).select(kind, F.lit("all").alias("strand"), "sample", "n")
    return aln.groupBy(kind, "strand", "sample").agg(F.sum("n").alias("n")).unionByName(both)


def mapped_refs(aln: DataFrame) -> DataFrame:
    """References that are hit, overall (sample ``all``) and by sample."""
    return aln.select("ref", "sample").distinct().rollup("sample").agg(F.countDistinct("ref").alias("refs")).select(F.coalesce("sample", F.lit("all")).alias("sample"), "refs")


def mapping_stat(aln: DataFrame) -> DataFrame:
    """Reads and unique reads by sample, for both strands and each; a read counts once at its first place."""
    first = aln.withColumn("k", F.row_number().over(Window.partitionBy("sample", "read_id").orderBy("pos", "ref", "strand", "n"))).withColumn("u", (F.col("k") == 1).cast("int"))
    g = first.groupBy("sample", "strand").agg(F.sum("n").alias("reads"), F.sum("u").alias("uniq"))
    return g.groupBy("sample").agg(F.sum("reads").alias("reads"), F.sum("uniq").alias("uniq")).withColumn("strand", F.lit("all")).unionByName(g)


def mapping_percent(stat: DataFrame, total: DataFrame) -> DataFrame:
    """``x (p%)`` of a sample's reads."""
    p = F.format_string("%.2f", 100.0 * F.col("reads") / F.col("total"))
    return stat.join(total, "sample").select("sample", "strand", F.concat(F.col("reads").cast("string"), F.lit(" ("), p, F.lit("%)")).alias("mapped"))


def round_totals(df: DataFrame, key: str, col: str) -> DataFrame:
    return df.groupBy(key).agg(half_up(F.sum(col)).alias("total"))


def strand_suffix_sum(df: DataFrame, name: str, col: str) -> DataFrame:
    """Sums by the sign at a name's end: +, -, or none."""
    s = F.right(F.col(name), F.lit(1))
    return df.groupBy(F.when(s.isin("+", "-"), s).otherwise("").alias("suffix")).agg(F.sum(col).alias("n"))


def repeat_rollup(stat: DataFrame) -> DataFrame:
    """stat (type ``Class:Sub``, strand, n) by class; names with ? or Unknown are ``ambi``; ``total`` rows; percent of all."""
    c = F.when(F.col("type").rlike(r"\?|Unknown"), "ambi").otherwise(F.split_part(F.col("type"), F.lit(":"), F.lit(1)))
    by = stat.select(c.alias("class"), "strand", "n").groupBy("class", "strand").agg(F.sum("n").alias("n"))
    total = by.groupBy("strand").agg(F.sum("n").alias("t"))
    rows = by.unionByName(total.select(F.lit("total").alias("class"), "strand", F.col("t").alias("n")))
    return rows.join(F.broadcast(total), "strand").select("class", "strand", "n", F.round(100 * F.col("n") / F.col("t"), 4).alias("percent"))


def category_table(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Classes by sample, rounded half up, with ``other`` as the total less their sum, and ``total``; percent of the total."""
    r = counts.select("class", "sample", half_up(F.col("n")).alias("n"))
    other = r.groupBy("sample").agg(F.sum("n").alias("s")).join(totals, "sample").select(F.lit("other").alias("class"), "sample", (F.col("total") - F.col("s")).alias("n"))
    rows = r.unionByName(other).unionByName(totals.select(F.lit("total").alias("class"), "sample", F.col("total").alias("n")))
    return rows.join(totals, "sample").select("class", "sample", "n", F.round(100 * F.col("n") / F.col("total"), 4).alias("percent"))


def expression_matrix(hits: DataFrame, samples: list[str]) -> DataFrame:
    """(mature, precursor): reads, the precursor's total, and per sample reads and counts per million."""
    t = hits.groupBy("sample").agg(F.sum("n").alias("t"))
    long = hits.groupBy("mature", "precursor", "sample").agg(F.sum("n").alias("n")).join(F.broadcast(t), "sample")
    wide = long.groupBy("mature", "precursor").agg(F.sum("n").alias("reads"), *[zero(F.sum(F.when(F.col("sample") == s, F.col("n")))).alias(f"n_{s}") for s in samples], *[F.round(F.coalesce(F.sum(F.when(F.col("sample") == s, 1e6 * F.col("n") / F.col("t"))), F.lit(0.0)), 2).alias(f"cpm_{s}") for s in samples])
    return wide.join(hits.groupBy("precursor").agg(F.sum("n").alias("total")), "precursor")


def expressed_split(expr: DataFrame, col: str = "reads") -> DataFrame:
    return expr.withColumn("expressed", F.col(col) > 0)


def expressed_pairs(expr: DataFrame) -> DataFrame:
    return expr.where("total > 0").select("mature", "precursor").distinct()


def mature_windows(hits: DataFrame, up: int = 2, down: int = 5) -> DataFrame:
    """Windows around matures: hits (precursor, mature, pos, len) to beg and end, the begin not below 0."""
    return hits.select("precursor", "mature", F.greatest(F.lit(0), F.col("pos") - up).alias("beg"), (F.col("pos") + F.col("len") - 1 + down).alias("end"))


def _inside(reads: DataFrame, windows: DataFrame, width: int, how: str) -> DataFrame:
    """Reads joined with the windows that hold them; windows are entered in all bins that they touch, a read in that of its begin."""
    w = windows.withColumn("__bin", F.explode(F.sequence(F.floor(F.col("beg") / width), F.greatest(F.floor(F.col("beg") / width), F.floor(F.col("end") / width))))).alias("w")
    r = reads.withColumn("__bin", F.floor(F.col("beg") / width)).alias("r")
    same = (F.col("r.precursor") == F.col("w.precursor")) & (F.col("r.__bin") == F.col("w.__bin"))
    return r.join(w, same & (F.col("r.beg") >= F.col("w.beg")) & (F.col("r.end") <= F.col("w.end")), how)


def _spans(reads: DataFrame) -> DataFrame:
    """Equal spans (precursor, beg, end) of reads as one row: their number (reads) and the sum of n."""
    return reads.groupBy("precursor", "beg", "end").agg(F.count("*").alias("reads"), F.sum("n").alias("n"))


def read_in_window(reads: DataFrame, windows: DataFrame, width: int = 32) -> DataFrame:
    """Reads (precursor, beg, end, n) inside windows of their precursor; a read in two windows counts in both.

    Only distinct spans of reads meet distinct spans of windows, so the pairs are bounded by the places and lengths that there are,
    however many reads and matures lie on them.
    """
    span = ["precursor", "beg", "end"]
    met = _inside(_spans(reads), windows.select(*span).distinct(), width, "inner")
    sums = met.groupBy(*[f"w.{c}" for c in span]).agg(F.sum("r.reads").alias("reads"), F.sum("r.n").alias("n"))
    return windows.select(*span, "mature").join(sums, span).groupBy("precursor", "mature").agg(F.sum("reads").alias("reads"), F.sum("n").alias("n"))


def remaining_count(reads: DataFrame, windows: DataFrame, width: int = 32) -> DataFrame:
    """Per precursor: reads outside all windows. Of the windows that begin at one place only the longest matters."""
    spans = _spans(reads)
    out = _inside(spans, windows.groupBy("precursor", "beg").agg(F.max("end").alias("end")), width, "left_anti")
    return spans.select("precursor").distinct().join(out.groupBy("precursor").agg(F.sum("n").alias("n")), "precursor", "left").select("precursor", zero("n").alias("remaining"))


def precursor_coverage(reads: DataFrame) -> DataFrame:
    """Depth per base of each precursor; reads (precursor, beg, end half-open, n): sums of starts and ends, not of bases.

    Starts and ends of a precursor cancel out, so one running sum over all precursors, by ranges, gives every depth.
    """
    steps = reads.select("precursor", F.col("beg").alias("at"), F.col("n").alias("d")).unionByName(reads.select("precursor", F.col("end").alias("at"), (-F.col("n")).alias("d"))).groupBy("precursor", "at").agg(F.sum("d").alias("d"))
    runs = cumulative_sum(numbered(steps, ["precursor", "at"]), "d", ["line"], "depth")
    following = runs.select((F.col("line") - 1).alias("line"), F.col("precursor").alias("__p"), F.col("at").alias("next"))
    runs = runs.join(following, "line").where((F.col("precursor") == F.col("__p")) & (F.col("depth") > 0))
    return runs.select("precursor", F.explode(F.sequence("at", F.col("next") - 1)).alias("pos"), "depth")


def mapped_mature(expr: DataFrame, star: bool = False) -> DataFrame:
    """Distinct matures (or stars, ids that end in *) with reads, overall and by sample."""
    own = expr.where((F.col("n") > 0) & (F.col("mature").endswith("*") == star)).select("mature", "sample").distinct()
    return own.rollup("sample").agg(F.countDistinct("mature").alias("matures")).select(F.coalesce("sample", F.lit("all")).alias("sample"), "matures")


def family_matrix(members: DataFrame, families: list[str]) -> DataFrame:
    """species by family: members as a list, their number and a sign."""
    g = members.groupBy("species")
    own = lambda f: F.when(F.col("family") == f, F.col("member"))
    cols = []
    for i, f in enumerate(families):
        cols += [F.array_join(F.array_sort(F.collect_set(own(f))), ",").alias(f"f{i}_members"), F.countDistinct(own(f)).alias(f"f{i}_n"), F.when(F.countDistinct(own(f)) > 0, "+").otherwise("-").alias(f"f{i}_sign")]
    return g.agg(*cols)


def merge_counts_tpm(parts: list[DataFrame]) -> DataFrame:
    """Matrices (id, sample, value) of several files: of equal id and sample the later file counts; value per million of a sample."""
    rows = None
    for i, p in enumerate(parts):
        one = p.select("id", "sample", "value").withColumn("file", F.lit(i))
        rows = one if rows is None else rows.unionByName(one)
    last = rows.groupBy("id", "sample").agg(F.max_by("value", "file").alias("value"))
    t = last.groupBy("sample").agg(F.sum("value").alias("t"))
    return last.join(F.broadcast(t), "sample").select("id", "sample", "value", F.round(1e6 * F.col("value") / F.col("t"), 4).alias("tpm"))


def group_means(long: DataFrame, groups: DataFrame) -> DataFrame:
    return long.join(F.broadcast(groups), "sample").groupBy("id", "grp").agg(F.round(F.avg("value"), 4).alias("mean"))


def tpm_intervals(long: DataFrame) -> DataFrame:
    """Ids by sample in fixed intervals of TPM, with percent."""
    v = F.col("tpm")
    label = F.when(v <= 0.1, "0-0.1").when(v <= 0.3, "0.1-0.3").when(v <= 3.57, "0.3-3.57").when(v <= 15, "3.57-15").when(v <= 60, "15-60").otherwise(">60")
    by = long.groupBy("sample", label.alias("interval")).agg(F.count("*").alias("n"))
    return by.join(F.broadcast(by.groupBy("sample").agg(F.sum("n").alias("t"))), "sample").select("sample", "interval", "n", F.round(100 * F.col("n") / F.col("t"), 4).alias("percent"))


def expr_density_box(long: DataFrame) -> DataFrame:
    """Quartiles and range of log10(tpm + 1) by sample; exact, and no task holds a sample."""
    v = long.select("sample", F.log10(F.col("tpm") + 1).alias("v"))
    box = quantiles(v, ["sample"], "v", {"lo": 0.0, "q1": 0.25, "q2": 0.5, "q3": 0.75, "hi": 1.0})
    return box.select("sample", *[F.round(c, 6).alias(c) for c in ("q1", "q2", "q3", "lo", "hi")])


def expr_density(long: DataFrame, points: int = 512) -> DataFrame:
    """Density of log10(tpm + 1) by sample at equal steps of the range of all samples: sample, point, x, density."""
    return density(long.select("sample", F.log10(F.col("tpm") + 1).alias("v")), "sample", "v", points)


def venn_members(sets: DataFrame, direction: str | None = None) -> DataFrame:
    """sets (id, comparison[, direction]): each id with its region, the exact set of comparisons that hold it; with ``direction``
    (up or down) only of those where it goes that way. The rows of a region are its list."""
    chosen = sets if direction is None else sets.where(F.col("direction") == direction)
    return chosen.groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("comparison")), "&").alias("region"))


def venn_regions(sets: DataFrame, direction: str | None = None) -> DataFrame:
    """Number of ids by region, with the first and the last of them."""
    own = venn_members(sets, direction)
    return own.groupBy("region").agg(F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


def logsumexp_score(sites: DataFrame) -> DataFrame:
    """Per (utr, mirna): sites and -log of the sum of exp(-ddg), without overflow."""
    top = sites.groupBy("utr", "mirna").agg(F.max(-F.col("ddg")).alias("m"))
    return sites.join(top, ["utr", "mirna"]).groupBy("utr", "mirna").agg(F.count("*").alias("sites"), F.round(-(F.max("m") + F.log(F.sum(F.exp(-F.col("ddg") - F.col("m"))))), 6).alias("score"))


def pairs_to_list(pairs: DataFrame, key: str, value: str) -> DataFrame:
    return pairs.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(value)), ",").alias("list"))


def two_way_lists(pairs: DataFrame, a: str, b: str) -> DataFrame:
    x = pairs_to_list(pairs, a, b).select(F.lit(a).alias("side"), F.col(a).cast("string").alias("name"), "list")
    return x.unionByName(pairs_to_list(pairs, b, a).select(F.lit(b).alias("side"), F.col(b).cast("string").alias("name"), "list"))


def dedup_max(df: DataFrame, key: str, by: str, tie: list[str]) -> DataFrame:
    return df.withColumn("__k", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(by), *tie))).where("__k = 1").drop("__k")


def coverage_windows(aln: DataFrame, sizes: DataFrame, width: int) -> DataFrame:
    """Mean depth per strand in tiled windows (the last may be shorter; empty windows stay). aln (chrom, strand, beg, end half-open)."""
    hit = aln.withColumn("w", F.explode(F.sequence(F.floor(F.col("beg") / width), F.floor((F.col("end") - 1) / width))))
    over = F.least(F.col("end"), (F.col("w") + 1) * width) - F.greatest(F.col("beg"), F.col("w") * width)
    got = hit.groupBy("chrom", "strand", "w").agg(F.sum(over).alias("bases"))
    every = sizes.withColumn("w", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / width)))).crossJoin(F.broadcast(aln.select("strand").distinct()))
    length = F.least(F.col("size"), (F.col("w") + 1) * width) - F.col("w") * width
    return every.join(got, ["chrom", "strand", "w"], "left").select("chrom", "strand", (F.col("w") * width).alias("start"), F.round(F.coalesce("bases", F.lit(0)) / length, 6).alias("depth"))


def outlier_cut(cov: DataFrame, k: float = 3.0) -> DataFrame:
    """Windows below mean + k standard deviations of their strand."""
    s = cov.groupBy("strand").agg((F.avg("depth") + k * F.stddev_samp("depth")).alias("top"))
    return cov.join(F.broadcast(s), "strand").where("depth < top").drop("top")


def sample_reads(aln: DataFrame, r: int, key: list[str], seed: int = 1) -> DataFrame:
    """``r`` rows in a fixed pseudo-random order."""
    h = F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in key], F.lit(str(seed))).cast("binary"))
    return aln.withColumn("__h", h).orderBy("__h", *key).limit(r).drop("__h")


def exclusive_sets(long: DataFrame, a: str, b: str, cutoff: float = 0.1) -> DataFrame:
    """Ids above a cutoff in either group: yes/yes, yes/no or no/yes."""
    g = long.groupBy("id").agg(F.max(F.when(F.col("grp") == a, F.col("value") > cutoff)).alias("a"), F.max(F.when(F.col("grp") == b, F.col("value") > cutoff)).alias("b"))
    yes = lambda c: F.when(F.coalesce(c, F.lit(False)), "yes").otherwise("no")
    return g.select("id", F.concat_ws("/", yes("a"), yes("b")).alias("set")).where("set <> 'no/no'")


def signature_matrix(de: DataFrame, comparisons: list[str]) -> DataFrame:
    return de.groupBy("id").agg(*[F.coalesce(F.max(F.when(F.col("comparison") == c, F.col("significant").cast("int"))), F.lit(0)).alias(f"c_{c}") for c in comparisons])


def classify_cascade(hits: DataFrame, key: str, priority: str, name: str) -> DataFrame:
    """Each read's class of the highest priority: one shuffle for what was a chain of anti-joins."""
    return hits.groupBy(key).agg(F.min_by(name, priority).alias(name), F.min(priority).alias(priority))


def best_strata(hits: DataFrame, most: int | None = None) -> DataFrame:
    """All hits of a read with its least mismatches; reads with more than ``most`` hits go."""
    w = Window.partitionBy("read_id")
    out = hits.withColumn("__r", F.rank().over(w.orderBy("mism"))).withColumn("__c", F.count("*").over(w)).where("__r = 1")
    return (out if most is None else out.where(F.col("__c") <= most)).drop("__r", "__c")


def hit_windows_merge(hits: DataFrame, key: list[str]) -> DataFrame:
    """Overlapping intervals (beg, end half-open) of a key merged: gaps and islands."""
    return islands(hits, key, "beg", "end", name="__i").groupBy(*key, "__i").agg(F.min("beg").alias("beg"), F.max("end").alias("end"), F.count("*").alias("hits")).drop("__i")


def locus_cluster(reads: DataFrame, a: str, b: str, gap: int = 300, least: int = 3, pseudo: float = 0.1) -> DataFrame:
    """Reads (chrom, beg, end, sample, n) at most ``gap`` apart form a locus; loci of ``least`` hits, with the log ratio of two samples."""
    island = islands(reads, ["chrom"], "beg", "end", gap, "locus")
    g = island.groupBy("chrom", "locus").agg(F.min("beg").alias("beg"), F.max("end").alias("end"), F.count("*").alias("hits"), *[F.coalesce(F.sum(F.when(F.col("sample") == s, F.col("n"))), F.lit(0).cast("long")).alias(c) for s, c in ((a, "a"), (b, "b"))])
    return g.where(F.col("hits") >= least).withColumn("ratio", F.round(F.log2((F.col("a") + pseudo) / (F.col("b") + pseudo)), 6)).drop("locus")


def hit_ordinal(hits: DataFrame, chrom: str, order: list) -> DataFrame:
    """Each hit's place among those of its chromosome and its name, chromosome.place; numbered by ranges of the whole order."""
    named = {f"__o{i}": c if isinstance(c, Column) else F.col(c) for i, c in enumerate(order)}
    n = numbered(hits.withColumns(named), [chrom, *named], "__line").drop(*named)
    first = n.groupBy(chrom).agg(F.min("__line").alias("__first"))
    n = n.join(first, chrom).withColumn("ordinal", F.col("__line") - F.col("__first") + 1).drop("__line", "__first")
    return n.withColumn("name", F.concat_ws(".", chrom, "ordinal"))
