"""Queries on counts, classes, coverage and sets, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from strandloom.operators import annotate as n
from strandloom.operators import quant as q
from strandloom.plans.views import ALN, alignments, read

_S = ["A", "N", "R"]


def refs(s, d):
    return read(s, d, "supplier").select(F.col("s_suppkey").alias("ref"))


def hits(s, d):
    """mature, precursor, sample, n: supplier and part class over lineitem."""
    return alignments(s, d).select(F.concat(F.lit("m"), F.col("pos") % 50, F.when(F.col("pos") % 3 == 0, "*").otherwise("")).alias("mature"), (F.col("ref") % 20).alias("precursor"), "sample", "n")


HITS = f"{ALN}, h AS (SELECT 'm' || (pos % 50) || CASE WHEN pos % 3 = 0 THEN '*' ELSE '' END AS mature, ref % 20 AS precursor, sample, n FROM a)"


def typed(s, d):
    p = read(s, d, "part")
    return p.select(F.when(F.col("p_size") % 9 == 0, F.concat("p_type", F.lit("?"))).otherwise(F.regexp_replace("p_type", " ", ":")).alias("type"), F.when(F.col("p_partkey") % 2 == 0, "+").otherwise("-").alias("strand"), F.col("p_size").cast("long").alias("n"))


TYPED = "ty AS (SELECT CASE WHEN p_size % 9 = 0 THEN p_type || '?' ELSE replace(p_type, ' ', ':') END AS type, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand, p_size::BIGINT AS n FROM part)"


def spans(s, d):
    """chrom, strand, beg, end, sample, n: intervals of 1 to 50 bases."""
    return alignments(s, d).select((F.col("ref") % 10).alias("chrom"), "strand", (F.col("pos") * 7 % 5000).alias("beg"), "sample", "n").withColumn("end", F.col("beg") + F.col("n").cast("int"))


SPANS = f"{ALN}, sp AS (SELECT ref % 10 AS chrom, strand, pos * 7 % 5000 AS beg, pos * 7 % 5000 + n AS end_, sample, n FROM a)"


def inside(s, d):
    r = spans(s, d).select(F.col("chrom").alias("precursor"), "beg", (F.col("end") - 1).alias("end"), "n")
    w = q.mature_windows(read(s, d, "part").select((F.col("p_partkey") % 10).alias("precursor"), F.concat(F.lit("m"), F.col("p_partkey")).alias("mature"), (F.col("p_partkey") * 13 % 5000).cast("int").alias("pos"), F.col("p_size").alias("len")))
    return r, w


WIN = "w AS (SELECT p_partkey % 10 AS precursor, 'm' || p_partkey AS mature, greatest(0, p_partkey * 13 % 5000 - 2) AS beg, p_partkey * 13 % 5000 + p_size - 1 + 5 AS end_ FROM part)"


def longs(s, d, value="value"):
    return alignments(s, d).groupBy(F.col("ref").alias("id"), "sample").agg(F.sum("n").alias(value))


LONG = f"{ALN}, lo AS (SELECT ref AS id, sample, CAST(sum(n) AS BIGINT) AS value FROM a GROUP BY 1, 2)"


def tpm(s, d):
    return longs(s, d).select("id", "sample", (F.pow(F.col("id") % 7, F.lit(2.0)) * F.col("value") / 1000).alias("tpm"))


TPM = f"{LONG}, tp AS (SELECT id, sample, pow(id % 7, 2.0) * value / 1000 AS tpm FROM lo)"


def mirna_pairs(s, d):
    return read(s, d, "lineitem").select(F.col("l_suppkey").alias("mirna"), (F.col("l_partkey") % 100).alias("target"))


def sets(s, d):
    return alignments(s, d).select(F.col("pos").alias("id"), F.concat("sample", "strand").alias("comparison"), "n")


def _directed(s, d):
    return sets(s, d).withColumn("direction", F.when(F.col("n") > 25, "up").otherwise("down"))


def _merged(s, d):
    a = alignments(s, d)
    one = lambda k: a.where(F.col("k") % 2 == k).groupBy(F.col("ref").alias("id"), "sample").agg(F.sum("n").alias("value"))
    return q.merge_counts_tpm([one(0), one(1).where("value > 600")])


def _totals(s, d):
    return alignments(s, d).groupBy("sample").agg((F.sum("n") * 2).alias("total"))


_CASE = "CASE WHEN tpm <= 0.1 THEN '0-0.1' WHEN tpm <= 0.3 THEN '0.1-0.3' WHEN tpm <= 3.57 THEN '0.3-3.57' WHEN tpm <= 15 THEN '3.57-15' WHEN tpm <= 60 THEN '15-60' ELSE '>60' END"
_EXPR = ", ".join(f"CAST(coalesce(sum(n) FILTER (sample = '{x}'), 0) AS BIGINT) AS n_{x}, round(coalesce(sum(n) FILTER (sample = '{x}') * 1e6::DOUBLE / (SELECT sum(n) FROM h WHERE sample = '{x}'), 0.0), 2) AS cpm_{x}" for x in _S)
_FAM = ["Brand#11", "Brand#12", "Brand#13"]

def _side(s, d, samples):
    """A table of counts by id with some of the samples."""
    return longs(s, d).where(F.col("sample").isin(samples)).groupBy("id").pivot("sample", samples).agg(F.sum("value"))


QUERIES = {
    "feature_counts": (lambda s, d: q.feature_counts(alignments(s, d), refs(s, d)), f"WITH {ALN}, g AS (SELECT ref, sample, sum(n) AS n FROM a GROUP BY 1, 2), t AS (SELECT sample, sum(n) AS t FROM a GROUP BY 1) SELECT s_suppkey AS ref, t.sample, CAST(coalesce(n, 0) AS BIGINT) AS n, round(coalesce(1e6::DOUBLE * n / t, 0.0), 4) AS cpm FROM supplier CROSS JOIN t LEFT JOIN g ON g.ref = s_suppkey AND g.sample = t.sample"),
    "feature_uniq_counts": (lambda s, d: q.feature_uniq_counts(alignments(s, d)), f"WITH {ALN}, m AS (SELECT *, 1.0::DOUBLE / count(*) OVER (PARTITION BY read_id) AS w FROM a) SELECT ref, sample, count(DISTINCT read_id) AS uniq, round(sum(w), 4) AS weight FROM m GROUP BY 1, 2"),
    "class_totals": (lambda s, d: q.class_totals(alignments(s, d).withColumn("type", F.col("ref") % 5), "type"), f"WITH {ALN} SELECT ref % 5 AS type, CASE WHEN grouping(strand) = 1 THEN 'all' ELSE strand END AS strand, sample, CAST(sum(n) AS BIGINT) AS n FROM a GROUP BY GROUPING SETS ((type, sample), (type, strand, sample))"),
    "mapped_refs": (lambda s, d: q.mapped_refs(alignments(s, d)), f"WITH {ALN} SELECT coalesce(sample, 'all') AS sample, count(DISTINCT ref) AS refs FROM a GROUP BY ROLLUP (sample)"),
    "mapped_precursors": (lambda s, d: q.mapped_refs(hits(s, d).withColumnRenamed("precursor", "ref")).withColumnRenamed("refs", "precursors"), f"WITH {HITS} SELECT coalesce(sample, 'all') AS sample, count(DISTINCT precursor) AS precursors FROM h GROUP BY ROLLUP (sample)"),
    "mapped_mature": (lambda s, d: q.mapped_mature(hits(s, d)), f"WITH {HITS} SELECT coalesce(sample, 'all') AS sample, count(DISTINCT mature) AS matures FROM h WHERE n > 0 AND NOT ends_with(mature, '*') GROUP BY ROLLUP (sample)"),
    "mapping_stat": (lambda s, d: q.mapping_stat(alignments(s, d)), f"WITH {ALN}, f AS (SELECT *, row_number() OVER (PARTITION BY sample, read_id ORDER BY pos, ref, strand, n) AS r FROM a) SELECT sample, coalesce(strand, 'all') AS strand, CAST(sum(n) AS BIGINT) AS reads, count(*) FILTER (r = 1) AS uniq FROM f GROUP BY GROUPING SETS ((sample), (sample, strand))"),
    "mapping_percent": (lambda s, d: q.mapping_percent(q.mapping_stat(alignments(s, d)), _totals(s, d)), f"WITH {ALN}, t AS (SELECT sample, sum(n) * 2 AS total FROM a GROUP BY 1), m AS (SELECT sample, coalesce(strand, 'all') AS strand, sum(n) AS reads FROM a GROUP BY GROUPING SETS ((sample), (sample, strand))) SELECT sample, strand, reads || ' (' || printf('%.2f', 100.0::DOUBLE * reads / total) || '%)' AS mapped FROM m JOIN t USING (sample)"),
    "round_totals": (lambda s, d: q.round_totals(alignments(s, d).withColumn("h", F.col("n") / 4), "sample", "h"), f"WITH {ALN} SELECT sample, CAST(floor(sum(n / 4.0::DOUBLE) + 0.5) AS BIGINT) AS total FROM a GROUP BY 1"),
    "strand_suffix_sum": (lambda s, d: q.strand_suffix_sum(alignments(s, d).withColumn("name", F.concat(F.col("ref").cast("string"), F.when(F.col("k") > 5, "").otherwise(F.col("strand")))), "name", "n"), f"WITH {ALN} SELECT CASE WHEN k > 5 THEN '' ELSE strand END AS suffix, CAST(sum(n) AS BIGINT) AS n FROM a GROUP BY 1"),
    "repeat_rollup": (lambda s, d: q.repeat_rollup(typed(s, d)), f"WITH {TYPED}, b AS (SELECT CASE WHEN type LIKE '%?%' OR type LIKE '%Unknown%' THEN 'ambi' ELSE split_part(type, ':', 1) END AS class, strand, sum(n) AS n FROM ty GROUP BY 1, 2), t AS (SELECT strand, sum(n) AS t FROM b GROUP BY 1), u AS (SELECT * FROM b UNION ALL SELECT 'total', strand, t FROM t) SELECT class, strand, CAST(n AS BIGINT) AS n, round(100.0::DOUBLE * n / t, 4) AS percent FROM u JOIN t USING (strand)"),
    "category_table": (lambda s, d: q.category_table(alignments(s, d).groupBy((F.col("ref") % 4).cast("string").alias("class"), "sample").agg((F.sum("n") / 4).alias("n")), _totals(s, d)), f"WITH {ALN}, r AS (SELECT (ref % 4)::VARCHAR AS class, sample, CAST(floor(sum(n) / 4.0::DOUBLE + 0.5) AS BIGINT) AS n FROM a GROUP BY 1, 2), t AS (SELECT sample, CAST(sum(n) * 2 AS BIGINT) AS total FROM a GROUP BY 1), u AS (SELECT * FROM r UNION ALL SELECT 'other', sample, total - (SELECT sum(n) FROM r WHERE r.sample = t.sample) FROM t UNION ALL SELECT 'total', sample, total FROM t) SELECT class, sample, CAST(n AS BIGINT) AS n, round(100.0::DOUBLE * n / total, 4) AS percent FROM u JOIN t USING (sample)"),
    "expression_matrix": (lambda s, d: q.expression_matrix(hits(s, d), _S), f"WITH {HITS} SELECT precursor, mature, CAST(sum(n) AS BIGINT) AS reads, {_EXPR}, CAST((SELECT sum(n) FROM h x WHERE x.precursor = h.precursor) AS BIGINT) AS total FROM h GROUP BY precursor, mature"),
    "expressed_split": (lambda s, d: q.expressed_split(hits(s, d).groupBy("mature").agg((F.sum("n") - 20000).alias("reads"))), f"WITH {HITS} SELECT mature, CAST(sum(n) - 20000 AS BIGINT) AS reads, sum(n) > 20000 AS expressed FROM h GROUP BY 1"),
    "expressed_pairs": (lambda s, d: q.expressed_pairs(hits(s, d).groupBy("mature", "precursor").agg((F.sum("n") - 1500).alias("total"))), f"WITH {HITS} SELECT mature, precursor FROM h GROUP BY 1, 2 HAVING sum(n) > 1500"),
    "mature_windows": (lambda s, d: inside(s, d)[1], f"WITH {WIN} SELECT precursor, mature, CAST(beg AS INT) AS beg, CAST(end_ AS INT) AS \"end\" FROM w"),
    "read_in_window": (lambda s, d: q.read_in_window(*inside(s, d)), f"WITH {SPANS}, {WIN} SELECT w.precursor, mature, count(*) AS reads, CAST(sum(n) AS BIGINT) AS n FROM sp JOIN w ON sp.chrom = w.precursor AND sp.beg >= w.beg AND sp.end_ - 1 <= w.end_ GROUP BY 1, 2"),
    "remaining_count": (lambda s, d: q.remaining_count(*inside(s, d)), f"WITH {SPANS}, {WIN} SELECT chrom AS precursor, CAST(coalesce(sum(n) FILTER (NOT EXISTS (SELECT 1 FROM w WHERE sp.chrom = w.precursor AND sp.beg >= w.beg AND sp.end_ - 1 <= w.end_)), 0) AS BIGINT) AS remaining FROM sp GROUP BY 1"),
    "precursor_coverage": (lambda s, d: q.precursor_coverage(spans(s, d).select(F.col("chrom").alias("precursor"), "beg", "end", "n")), f"WITH {SPANS}, e AS (SELECT chrom, unnest(range(beg, end_)) AS pos, n FROM sp) SELECT chrom AS precursor, CAST(pos AS INT) AS pos, CAST(sum(n) AS BIGINT) AS depth FROM e GROUP BY 1, 2"),
    "family_matrix": (lambda s, d: q.family_matrix(read(s, d, "part").select(F.split_part(F.col("p_type"), F.lit(" "), F.lit(1)).alias("species"), F.col("p_brand").alias("family"), F.col("p_size").cast("string").alias("member")), _FAM), "SELECT split_part(p_type, ' ', 1) AS species, {} FROM part GROUP BY 1".format(", ".join(f"coalesce(string_agg(DISTINCT p_size::VARCHAR, ',' ORDER BY p_size::VARCHAR) FILTER (p_brand = '{f}'), '') AS f{i}_members, count(DISTINCT p_size) FILTER (p_brand = '{f}') AS f{i}_n, CASE WHEN count(*) FILTER (p_brand = '{f}') > 0 THEN '+' ELSE '-' END AS f{i}_sign" for i, f in enumerate(_FAM)))),
    "merge_counts_tpm": (_merged, f"WITH {ALN}, x AS (SELECT ref AS id, sample, k % 2 AS f, sum(n) AS v FROM a GROUP BY ALL), m AS (SELECT id, sample, arg_max(v, f) AS value FROM x WHERE f = 0 OR v > 600 GROUP BY 1, 2) SELECT id, sample, CAST(value AS BIGINT) AS value, round(1e6::DOUBLE * value / sum(value) OVER (PARTITION BY sample), 4) AS tpm FROM m"),
    "group_means": (lambda s, d: q.group_means(longs(s, d), s.createDataFrame([("A", "g1"), ("N", "g1"), ("R", "g2")], "sample string, grp string")), f"WITH {LONG} SELECT id, CASE WHEN sample = 'R' THEN 'g2' ELSE 'g1' END AS grp, round(avg(value), 4) AS mean FROM lo GROUP BY 1, 2"),
    "tpm_intervals": (lambda s, d: q.tpm_intervals(tpm(s, d)), f"WITH {TPM}, b AS (SELECT sample, {_CASE} AS interval_, count(*) AS n FROM tp GROUP BY 1, 2) SELECT sample, interval_ AS \"interval\", n, round(100.0::DOUBLE * n / sum(n) OVER (PARTITION BY sample), 4) AS percent FROM b"),
    "expr_density_box": (lambda s, d: q.expr_density_box(tpm(s, d)), f"WITH {TPM}, v AS (SELECT sample, log10(tpm + 1) AS v FROM tp) SELECT sample, round(quantile_cont(v, 0.25), 6) AS q1, round(quantile_cont(v, 0.5), 6) AS q2, round(quantile_cont(v, 0.75), 6) AS q3, round(min(v), 6) AS lo, round(max(v), 6) AS hi FROM v GROUP BY 1"),
    "expr_density": (
        lambda s, d: q.expr_density(tpm(s, d), 64).select("sample", "point", F.round("x", 6).alias("x"), F.round("density", 6).alias("density")),
        f"""WITH {TPM}, v AS (SELECT sample, log10(tpm + 1) AS v FROM tp),
  span AS (SELECT min(v) AS lo, (max(v) - min(v)) / 63 AS step FROM v),
  b AS (SELECT sample, count(*) AS n, 0.9::DOUBLE * least(stddev_samp(v), (quantile_cont(v, 0.75) - quantile_cont(v, 0.25)) / 1.34::DOUBLE) / pow(count(*), 0.2::DOUBLE) AS h FROM v GROUP BY 1),
  dealt AS (SELECT sample, (v - lo) / step AS x FROM v, span),
  cut AS (SELECT sample, least(floor(x), 63) AS bin, 1 - (x - least(floor(x), 63)) AS w FROM dealt UNION ALL SELECT sample, least(floor(x) + 1, 63), x - least(floor(x), 63) FROM dealt),
  bins AS (SELECT sample, bin, sum(w) AS w FROM cut GROUP BY 1, 2),
  p AS (SELECT unnest(range(0, 64)) AS point)
SELECT sample, CAST(point AS INT) AS point, round(any_value(lo + point * step), 6) AS x,
  round(sum(w * exp(-0.5::DOUBLE * pow((point - bin) * step / h, 2))) / any_value(n * h * sqrt(2 * pi())), 6) AS density
FROM bins JOIN b USING (sample), span, p GROUP BY 1, 2""",
    ),
    "venn_regions": (lambda s, d: q.venn_regions(sets(s, d)), f"WITH {ALN}, o AS (SELECT pos AS id, string_agg(DISTINCT sample || strand, '&' ORDER BY sample || strand) AS region FROM a GROUP BY 1) SELECT region, count(*) AS n, min(id) AS first_id, max(id) AS last_id FROM o GROUP BY 1"),
    "exclusive_sets": (lambda s, d: q.exclusive_sets(longs(s, d).withColumnRenamed("sample", "grp"), "A", "R", 4000), f"WITH {LONG}, g AS (SELECT id, coalesce(bool_or(value > 4000) FILTER (sample = 'A'), false) AS a, coalesce(bool_or(value > 4000) FILTER (sample = 'R'), false) AS b FROM lo GROUP BY 1) SELECT id, CASE WHEN a THEN 'yes' ELSE 'no' END || '/' || CASE WHEN b THEN 'yes' ELSE 'no' END AS set FROM g WHERE a OR b"),
    "venn_members": (
        lambda s, d: q.venn_members(_directed(s, d), "up"),
        f"WITH {ALN} SELECT pos AS id, string_agg(DISTINCT sample || strand, '&' ORDER BY sample || strand) AS region FROM a WHERE n > 25 GROUP BY 1",
    ),
    "venn_regions_down": (
        lambda s, d: q.venn_regions(_directed(s, d), "down"),
        f"WITH {ALN}, o AS (SELECT pos AS id, string_agg(DISTINCT sample || strand, '&' ORDER BY sample || strand) AS region FROM a WHERE n <= 25 GROUP BY 1) SELECT region, count(*) AS n, min(id) AS first_id, max(id) AS last_id FROM o GROUP BY 1",
    ),
    "union_matrix": (
        lambda s, d: n.union_matrix(alignments(s, d).where("n = 50").select(F.col("ref").alias("id"), F.col("sample").alias("comparison")), longs(s, d), list(_S)),
        f"WITH {LONG} SELECT id, {', '.join(f'CAST(coalesce(sum(value) FILTER (sample = {chr(39)}{x}{chr(39)}), 0) AS BIGINT) AS {chr(34)}{x}{chr(34)}' for x in _S)} FROM lo WHERE id IN (SELECT l_suppkey FROM lineitem WHERE l_quantity = 50) GROUP BY 1",
    ),
    "union_ids": (
        lambda s, d: n.union_ids(sets(s, d)),
        f"WITH {ALN} SELECT DISTINCT pos AS id FROM a",
    ),
    "signature_matrix": (lambda s, d: q.signature_matrix(sets(s, d).withColumn("significant", F.lit(True)), ["A+", "N+", "R-"]).select("id", F.col("c_A+").alias("a"), F.col("c_N+").alias("n"), F.col("c_R-").alias("r")), f"WITH {ALN} SELECT pos AS id, CAST(max(CASE WHEN sample || strand = 'A+' THEN 1 ELSE 0 END) AS INT) AS a, CAST(max(CASE WHEN sample || strand = 'N+' THEN 1 ELSE 0 END) AS INT) AS n, CAST(max(CASE WHEN sample || strand = 'R-' THEN 1 ELSE 0 END) AS INT) AS r FROM a GROUP BY 1"),
    "logsumexp_score": (lambda s, d: q.logsumexp_score(read(s, d, "lineitem").select(F.col("l_suppkey").alias("utr"), F.col("l_linenumber").alias("mirna"), (-F.col("l_quantity")).alias("ddg"))), "WITH x AS (SELECT l_suppkey AS utr, l_linenumber AS mirna, l_quantity AS g FROM lineitem), m AS (SELECT utr, mirna, max(g) AS m FROM x GROUP BY 1, 2) SELECT utr, mirna, count(*) AS sites, round(-(any_value(m) + ln(sum(exp(g - m)))), 6) AS score FROM x JOIN m USING (utr, mirna) GROUP BY 1, 2"),
    "pairs_to_list": (lambda s, d: q.pairs_to_list(mirna_pairs(s, d), "target", "mirna"), "SELECT l_partkey % 100 AS target, array_to_string(list_sort(list_distinct(list(l_suppkey))), ',') AS list FROM lineitem GROUP BY 1"),
    "two_way_lists": (lambda s, d: q.two_way_lists(mirna_pairs(s, d), "target", "mirna"), "WITH p AS (SELECT l_suppkey AS mirna, l_partkey % 100 AS target FROM lineitem) SELECT 'target' AS side, target::VARCHAR AS name, array_to_string(list_sort(list_distinct(list(mirna))), ',') AS list FROM p GROUP BY 2 UNION ALL SELECT 'mirna', mirna::VARCHAR, array_to_string(list_sort(list_distinct(list(target))), ',') FROM p GROUP BY 2"),
    "distinct_pairs": (
        lambda s, d: n.union_ids(mirna_pairs(s, d).select(F.struct("mirna", "target").alias("id"))).select("id.*"),
        "SELECT DISTINCT l_suppkey AS mirna, l_partkey % 100 AS target FROM lineitem",
    ),
    "tool_consensus": (
        lambda s, d: n.tool_consensus({f"tool{i}": mirna_pairs(s, d).where(F.col("mirna") % 3 >= i) for i in (0, 1, 2)}, ["target", "mirna"]),
        """SELECT l_partkey % 100 AS target, l_suppkey AS mirna, 1 AS tool0, CAST(l_suppkey % 3 >= 1 AS INT) AS tool1, CAST(l_suppkey % 3 >= 2 AS INT) AS tool2,
          l_suppkey % 3 >= 2 AS all_tools FROM lineitem GROUP BY 1, 2""",
    ),
    "dedup_max": (lambda s, d: q.dedup_max(hits(s, d).groupBy("mature", "precursor").agg(F.sum("n").alias("n")), "mature", "n", ["precursor"]), f"WITH {HITS} SELECT mature, precursor, CAST(sum(n) AS BIGINT) AS n FROM h GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY mature ORDER BY sum(n) DESC, precursor) = 1"),
    "coverage_windows": (lambda s, d: q.coverage_windows(spans(s, d), s.range(10).select(F.col("id").alias("chrom"), F.lit(5060).cast("long").alias("size")), 100), f"WITH {SPANS}, e AS (SELECT chrom, strand, unnest(range(beg, end_)) // 100 AS w FROM sp), g AS (SELECT chrom, strand, w, count(*) AS b FROM e GROUP BY ALL) SELECT c AS chrom, x.strand, w.w * 100 AS start, round(coalesce(b, 0)::DOUBLE / least(100, 5060 - w.w * 100), 6) AS depth FROM range(0, 10) t(c) CROSS JOIN range(0, 51) w(w) CROSS JOIN (SELECT DISTINCT strand FROM sp) x LEFT JOIN g ON g.chrom = c AND g.strand = x.strand AND g.w = w.w"),
    "outlier_cut": (lambda s, d: q.outlier_cut(spans(s, d).groupBy("chrom", "strand", "beg").agg(F.sum("n").cast("double").alias("depth")), 1.0), f"WITH {SPANS}, c AS (SELECT chrom, strand, CAST(beg AS INT) AS beg, sum(n)::DOUBLE AS depth FROM sp GROUP BY ALL) SELECT chrom, strand, beg, depth FROM c JOIN (SELECT strand, avg(depth) + stddev_samp(depth) AS top FROM c GROUP BY 1) USING (strand) WHERE depth < top"),
    "sample_reads": (lambda s, d: q.sample_reads(alignments(s, d).select("read_id", "k", "pos", "ref"), 1000, ["read_id", "k", "pos", "ref"]), f"WITH {ALN} SELECT read_id, k, pos, ref FROM a ORDER BY md5(read_id || ':' || k || ':' || pos || ':' || ref || ':1'), read_id, k, pos, ref LIMIT 1000"),
    "classify_cascade": (lambda s, d: q.classify_cascade(alignments(s, d).select("read_id", (F.col("ref") % 12).alias("priority"), F.concat(F.lit("class"), F.col("ref") % 12).alias("class")), "read_id", "priority", "class"), f"WITH {ALN} SELECT read_id, 'class' || min(ref % 12) AS class, min(ref % 12) AS priority FROM a GROUP BY 1"),
    "best_strata": (lambda s, d: q.best_strata(alignments(s, d).select("read_id", "k", "pos", "ref", (F.col("pos") % 4).alias("mism")), 6), f"WITH {ALN} SELECT read_id, k, pos, ref, pos % 4 AS mism FROM a QUALIFY rank() OVER (PARTITION BY read_id ORDER BY pos % 4) = 1 AND count(*) OVER (PARTITION BY read_id) <= 6"),
    "hit_windows_merge": (lambda s, d: q.hit_windows_merge(spans(s, d), ["chrom", "strand"]), f"WITH {SPANS}, m AS (SELECT *, CASE WHEN beg > max(end_) OVER (PARTITION BY chrom, strand ORDER BY beg, end_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS x FROM sp), i AS (SELECT *, sum(x) OVER (PARTITION BY chrom, strand ORDER BY beg, end_ ROWS UNBOUNDED PRECEDING) AS i FROM m) SELECT chrom, strand, CAST(min(beg) AS INT) AS beg, CAST(max(end_) AS INT) AS \"end\", count(*) AS hits FROM i GROUP BY chrom, strand, i"),
    "locus_cluster": (lambda s, d: q.locus_cluster(spans(s, d), "A", "R", 5, 3), f"WITH {SPANS}, m AS (SELECT *, CASE WHEN beg - max(end_) OVER (PARTITION BY chrom ORDER BY beg, end_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 5 THEN 1 ELSE 0 END AS x FROM sp), i AS (SELECT *, sum(x) OVER (PARTITION BY chrom ORDER BY beg, end_ ROWS UNBOUNDED PRECEDING) AS i FROM m) SELECT chrom, CAST(min(beg) AS INT) AS beg, CAST(max(end_) AS INT) AS \"end\", count(*) AS hits, CAST(coalesce(sum(n) FILTER (sample = 'A'), 0) AS BIGINT) AS a, CAST(coalesce(sum(n) FILTER (sample = 'R'), 0) AS BIGINT) AS b, round(log2((coalesce(sum(n) FILTER (sample = 'A'), 0) + 0.1::DOUBLE) / (coalesce(sum(n) FILTER (sample = 'R'), 0) + 0.1::DOUBLE)), 6) AS ratio FROM i GROUP BY chrom, i HAVING count(*) >= 3"),
    "hit_ordinal": (
        lambda s, d: q.hit_ordinal(spans(s, d), "chrom", [-F.col("n"), "beg", "strand", "sample"]).select("chrom", "n", "beg", "ordinal", "name"),
        f"WITH {SPANS}, o AS (SELECT chrom, n, CAST(beg AS INT) AS beg, row_number() OVER (PARTITION BY chrom ORDER BY n DESC, beg, strand, sample) AS ordinal FROM sp) SELECT *, chrom || '.' || ordinal AS name FROM o",
    ),
    "paste_union": (
        lambda s, d: n.paste_union([_side(s, d, ["A"]), _side(s, d, ["N", "R"])], "id", list(_S)),
        f"WITH {LONG} SELECT id, {', '.join(f'CAST(coalesce(sum(value) FILTER (sample = {chr(39)}{x}{chr(39)}), 0) AS BIGINT) AS {chr(34)}{x}{chr(34)}' for x in _S)} FROM lo GROUP BY 1",
    ),
    "rc_tpm_join": (
        lambda s, d: n.rc_tpm_join(longs(s, d, "rc"), tpm(s, d), ["id", "sample"]).select("id", "sample", "rc", F.round("tpm", 6).alias("tpm")),
        f"WITH {TPM} SELECT id, sample, value AS rc, round(tpm, 6) AS tpm FROM lo JOIN tp USING (id, sample)",
    ),
    "gtf_to_gff": (
        lambda s, d: n.gtf_to_gff(_exons(s, d)),
        "WITH e AS (SELECT l_suppkey % 50 AS gene, l_suppkey AS tid, l_partkey AS b, l_partkey + CAST(l_quantity AS BIGINT) AS e FROM lineitem) "
        "SELECT 'gene' AS feature, gene::VARCHAR AS id, NULL AS parent, min(b) AS beg, max(e) AS \"end\" FROM e GROUP BY gene "
        "UNION ALL SELECT 'mRNA', tid::VARCHAR, gene::VARCHAR, min(b), max(e) FROM e GROUP BY gene, tid "
        "UNION ALL SELECT 'exon', tid || '.' || row_number() OVER (PARTITION BY tid ORDER BY b, e), tid::VARCHAR, b, e FROM e",
    ),
    "gene_length_from_gtf": (
        lambda s, d: n.gene_length(_exons(s, d)),
        "WITH e AS (SELECT l_suppkey % 50 AS gene, l_suppkey AS tid, l_partkey AS b, l_partkey + CAST(l_quantity AS BIGINT) AS e FROM lineitem) SELECT gene, CAST(floor(sum(e - b + 1)::DOUBLE / count(DISTINCT tid)) AS BIGINT) AS len, min(b) AS beg, max(e) AS \"end\" FROM e GROUP BY 1",
    ),
    "longest_transcript": (
        lambda s, d: n.longest_transcript(_exons(s, d)),
        "WITH e AS (SELECT l_suppkey % 50 AS gene, l_suppkey AS tid, sum(CAST(l_quantity AS BIGINT) + 1) AS len FROM lineitem GROUP BY 1, 2) SELECT gene, tid, CAST(len AS BIGINT) AS len FROM e QUALIFY row_number() OVER (PARTITION BY gene ORDER BY len DESC, tid DESC) = 1",
    ),
}


def _exons(s, d):
    return read(s, d, "lineitem").select((F.col("l_suppkey") % 50).alias("gene"), F.col("l_suppkey").alias("tid"), F.col("l_partkey").alias("b"), (F.col("l_partkey") + F.col("l_quantity").cast("long")).alias("e"))
