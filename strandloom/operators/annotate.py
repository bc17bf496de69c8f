"""Selections, checks and joins that annotate ids, genes and transcripts: each with its own arguments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.operators.align import cdna_from_exons
from strandloom.operators.table import take_first_n
from strandloom.sources.sinks import wide_matrix


def ids_subset(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is listed in ``ids`` (column ``key``)."""
    return df.join(ids.select(key), key, "left_semi")


def species_prefix_filter(df: DataFrame, col: str, prefixes: list[str], delim: str = "-") -> DataFrame:
    """Rows whose id begins with one of the species prefixes before the delimiter."""
    return df.where(F.split_part(F.col(col), F.lit(delim), F.lit(1)).isin(prefixes))


def fasta_tag_select(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """Records whose header or text holds the pattern."""
    return df.where(F.col(col).rlike(pattern))


def fraction_filter(df: DataFrame, value: Column, least: float, order: list, most_rows: int | None = None) -> DataFrame:
    """Rows above a limit, in order; ``most_rows`` of them where that is asked."""
    kept = df.where(value > least)
    return kept if most_rows is None else kept.orderBy(*order).limit(most_rows)


def validate_ids(ids: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Ids that ``known`` lacks."""
    return ids.select(key).join(known.select(key), key, "left_anti")


def completeness_check(df: DataFrame, group: str, part: str, expected: int) -> DataFrame:
    """Per group: rows, and whether all of the expected parts (samples, outputs) are there."""
    g = df.groupBy(group).agg(F.count("*").alias("rows"), F.countDistinct(part).alias("__n"))
    return g.select(group, "rows", (F.col("__n") == expected).alias("complete"))


def completeness_report(tables: dict[str, DataFrame | None], expected: list[str], sample: str = "sample") -> DataFrame:
    """What each table (None: it was not written) holds: table, present, rows, missing (expected samples without a row, by commas), complete."""
    rows = []
    for name, df in tables.items():
        if df is None:
            df = next(x for x in tables.values() if x is not None).where(F.lit(False))
        found = F.coalesce(F.collect_set(F.when(F.col(sample).isin(expected), F.col(sample))), F.array())
        lacks = F.array_join(F.array_sort(F.array_except(F.array(*[F.lit(x) for x in expected]), found)), ",")
        rows.append(df.agg(F.lit(name).alias("table"), F.lit(tables[name] is not None).alias("present"), F.count("*").alias("rows"), lacks.alias("missing")))
    return reduce(DataFrame.union, rows).withColumn("complete", F.col("present") & (F.col("rows") > 0) & (F.col("missing") == ""))


def topn_example(df: DataFrame, key: str, order: list, n: int = 15) -> DataFrame:
    """The first row of each key, for the first n keys: a report of fixed size."""
    return take_first_n(df, [key], 1, order).orderBy(key).limit(n)


def transcript_to_gene(targets: DataFrame, genes: DataFrame, transcript: str, mirna: str) -> DataFrame:
    """Targets (transcript, mirna) with their gene; genes: transcript, gene. One row for each gene, mirna and transcript."""
    return targets.select(transcript, mirna).distinct().join(genes.select(transcript, "gene").distinct(), transcript).select("gene", mirna, transcript)


def gene_target_counts(mapped: DataFrame, mirna: str) -> DataFrame:
    """Per gene: distinct small RNAs that target it."""
    return mapped.groupBy("gene").agg(F.countDistinct(mirna).alias("targets"))


def annotate_genes(ids: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """Distinct ids that have an annotation, with it."""
    return ids.select(key).distinct().join(names, key)


def add_description(df: DataFrame, descriptions: DataFrame, key: str, missing: str = "") -> DataFrame:
    """All rows, with their description or ``missing``. descriptions: key, description."""
    return df.join(descriptions.select(key, "description"), key, "left").na.fill(missing, ["description"])


def ko_extract(genes: DataFrame, kos: DataFrame, key: str, missing: str = "None") -> DataFrame:
    """All genes, with their orthology id or ``missing``. kos: key, ko."""
    return genes.join(kos.select(key, "ko"), key, "left").withColumn("ko", F.coalesce("ko", F.lit(missing)))


def top_terms_per_class(terms: DataFrame, cls: str, p: str, tie: list[str], most_p: float, n: int = 20) -> DataFrame:
    """The n best terms of each class with p below ``most_p``."""
    return take_first_n(terms.where(F.col(p) < most_p), [cls], n, [p, *tie])


def with_percent(terms: DataFrame, hits: str, hit_total: str, background: str, background_total: str) -> DataFrame:
    """Shares of the foreground and of the background that a term takes, in percent."""
    share = lambda a, b: F.round(100 * F.col(a) / F.col(b), 4)
    return terms.withColumns({"percent": share(hits, hit_total), "background_percent": share(background, background_total)})


def top20_pathways(pathways: DataFrame, hits: str, background: str, name: str, n: int = 20) -> DataFrame:
    """The n pathways of the highest share of hits (``rich``)."""
    return pathways.withColumn("rich", F.round(F.col(hits) / F.col(background), 6)).orderBy(F.desc("rich"), name).limit(n)


def genome_sizes(seqs: DataFrame, n: int = 10, pattern: str | None = None) -> DataFrame:
    """(id, size) of the n longest sequences; with a pattern (such as ``^chr\\d+$``) of ids that match it, if there are any."""
    sizes = seqs.select("id", F.length("seq").alias("size"))
    if pattern is not None:
        match = F.col("id").cast("string").rlike(pattern)
        named = sizes.agg(F.coalesce(F.bool_or(match), F.lit(False)).alias("__named"))
        sizes = sizes.crossJoin(F.broadcast(named)).where(match | ~F.col("__named")).drop("__named")
    return sizes.orderBy(F.desc("size"), "id").limit(n)


def gene_length(exons: DataFrame) -> DataFrame:
    """Mean spliced length of a gene's transcripts (rounded down) and its span; exons: gene, tid, b, e (closed)."""
    size = F.col("e") - F.col("b") + 1
    return exons.groupBy("gene").agg(F.floor(F.sum(size) / F.countDistinct("tid")).alias("len"), F.min("b").alias("beg"), F.max("e").alias("end"))


def longest_transcript(exons: DataFrame) -> DataFrame:
    """Each gene's transcript of the greatest spliced length, of equal ones the greatest id."""
    by = exons.groupBy("gene", "tid").agg(F.sum(F.col("e") - F.col("b") + 1).alias("len"))
    return by.groupBy("gene").agg(F.max(F.struct("len", "tid")).alias("m")).select("gene", "m.tid", "m.len")


def longest_cdna(exons: DataFrame, genome: DataFrame) -> DataFrame:
    """Each gene's longest transcript and its cDNA: gene, tid, len, seq.

    exons: gene, tid, chrom, strand, start, end (1-based, closed); genome: chrom, seq. Only the longest transcripts' exons are cut.
    """
    best = longest_transcript(exons.select("gene", "tid", F.col("start").alias("b"), F.col("end").alias("e")))
    chosen = exons.join(best, ["gene", "tid"], "left_semi").select("tid", "chrom", "strand", "start", "end")
    return best.join(cdna_from_exons(chosen, genome), "tid").select("gene", "tid", "len", "seq")


def gtf_to_gff(exons: DataFrame) -> DataFrame:
    """Exons (gene, tid, b, e) to a hierarchy of gene, mRNA and exon rows: feature, id, parent, beg, end.

    Exons are numbered in order of their begin inside a transcript, as ``tid.number``.
    """
    text = lambda c: F.col(c).cast("string")
    gene = exons.groupBy("gene").agg(F.min("b").alias("beg"), F.max("e").alias("end"))
    mrna = exons.groupBy("gene", "tid").agg(F.min("b").alias("beg"), F.max("e").alias("end"))
    each = exons.groupBy("tid").agg(F.array_sort(F.collect_list(F.struct("b", "e"))).alias("x")).select("tid", F.posexplode("x").alias("i", "x"))
    rows = [
        gene.select(F.lit("gene").alias("feature"), text("gene").alias("id"), F.lit(None).cast("string").alias("parent"), "beg", "end"),
        mrna.select(F.lit("mRNA"), text("tid"), text("gene"), "beg", "end"),
        each.select(F.lit("exon"), F.concat_ws(".", "tid", F.col("i") + 1), text("tid"), F.col("x.b"), F.col("x.e")),
    ]
    return reduce(DataFrame.union, rows)


def tool_consensus(tools: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Pairs that any tool reports: 1 or 0 for each tool, and whether all report them."""
    rows = [df.select(*keys).distinct().withColumn("__tool", F.lit(name)) for name, df in tools.items()]
    flag = lambda name: F.max((F.col("__tool") == name).cast("int")).alias(name)
    out = reduce(DataFrame.union, rows).groupBy(*keys).agg(*[flag(name) for name in tools])
    return out.withColumn("all_tools", F.least(*tools) == 1 if len(tools) > 1 else F.col(next(iter(tools))) == 1)


def union_ids(sets: DataFrame) -> DataFrame:
    """All ids of the sets (id, comparison)."""
    return sets.select("id").distinct()


def union_matrix(sets: DataFrame, long: DataFrame, samples: list[str]) -> DataFrame:
    """The rows of a matrix, from long (id, sample, value), of all ids of the sets; ids without values are left out."""
    return wide_matrix(long.join(sets.select("id"), "id", "left_semi"), samples)


def rc_tpm_join(counts: DataFrame, tpm: DataFrame, keys: list[str]) -> DataFrame:
    return counts.join(tpm, keys)


def paste_union(tables: list[DataFrame], key: str, columns: list[str]) -> DataFrame:
    """Tables of counts by id, side by side; what a table lacks is 0."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return rows.na.fill(0).groupBy(key).agg(*[F.sum(c).alias(c) for c in columns])


def diff_summary(de: DataFrame, few: int = 10) -> DataFrame:
    """Counts of differing ids, up and down, and whether any of them is below ``few``. de: significant, class."""
    n = de.agg(F.count_if("significant").alias("de"), F.count_if(F.col("class") == "up").alias("up"), F.count_if(F.col("class") == "down").alias("down"))
    return n.withColumn("few", F.least("de", "up", "down") < few)


def de_call_pval_fc(de: DataFrame, most_p: float, least_lfc: float) -> DataFrame:
    """Ids with p and fold change beyond the limits, and their direction."""
    called = de.where((F.col("p") < most_p) & (F.abs("lfc") > least_lfc))
    return called.select("id", "lfc", F.when(F.col("lfc") > 0, "up").otherwise("down").alias("direction"))
