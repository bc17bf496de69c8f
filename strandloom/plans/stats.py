"""Queries on tests, differential expression and enrichment, each with its SQL where SQL has one."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.operators import annotate as n
from strandloom.operators import bias
from strandloom.operators import stats as st
from strandloom.plans.quant import LONG, longs
from strandloom.plans.views import read


def line(s, d):
    return read(s, d, "lineitem").select(F.col("l_suppkey").alias("key"), F.col("l_returnflag").alias("grp"), F.col("l_quantity").alias("v"))


def pvals(s, d):
    return read(s, d, "part").select("p_partkey", "p_brand", (F.col("p_retailprice") * 7919 % 1000 / 1000).alias("p0")).select("p_partkey", "p_brand", F.round("p0", 3).alias("p"))


PV = "pv AS (SELECT p_partkey, p_brand, round(p_retailprice * 7919 % 1000 / 1000, 3) AS p FROM part)"


def counts(s, d):
    return read(s, d, "lineitem").groupBy(F.col("l_suppkey").alias("key")).agg(F.count("*").cast("int").alias("n"), F.count_if(F.col("l_quantity") > 44).cast("int").alias("r"))


CNT = "c AS (SELECT l_suppkey AS key, CAST(count(*) AS INT) AS n, CAST(count(*) FILTER (l_quantity > 44) AS INT) AS r FROM lineitem GROUP BY 1)"
_LC = "(lgamma({0} + 1) - lgamma({1} + 1) - lgamma({0} - {1} + 1))"


def _tail(z: str) -> str:
    t = f"(1.0::DOUBLE / (1.0::DOUBLE + 0.3275911::DOUBLE * (abs({z}) / sqrt(2.0))))"
    return f"(0.5::DOUBLE * (((((1.061405429::DOUBLE * {t} - 1.453152027::DOUBLE) * {t} + 1.421413741::DOUBLE) * {t} - 0.284496736::DOUBLE) * {t} + 0.254829592::DOUBLE) * {t}) * exp(-(abs({z}) / sqrt(2.0)) * (abs({z}) / sqrt(2.0))))"


def _go(s, d):
    """Parts as genes, types as terms with their words as ancestors."""
    p = read(s, d, "part")
    pre = lambda n: F.substring_index("p_type", " ", n)
    g = p.select(F.col("p_partkey").alias("gene"), F.col("p_type").alias("term"))
    e = p.select(F.explode(F.array(F.struct(F.col("p_type").alias("child"), pre(1).alias("parent")), F.struct(pre(1).alias("child"), F.lit("all").alias("parent")))).alias("e")).select("e.*").where("child <> parent").distinct()
    return g, e


GO = "g AS (SELECT p_partkey AS gene, p_type AS term FROM part), cl AS (SELECT DISTINCT gene, unnest([term, split_part(term, ' ', 1), 'all']) AS term FROM g)"


def _closure(s, d):
    return st.go_closure(*_go(s, d))


def _fg(s, d):
    return read(s, d, "part").where("p_size > 40").select(F.col("p_partkey").alias("gene"))


def _pathways(s, d):
    return read(s, d, "part").select(F.col("p_partkey").alias("gene"), F.col("p_brand").alias("term"))


def _rounded(df, digits=8):
    return df.withColumn("p", F.round("p", digits)).withColumn("q", F.round("q", digits))


def wide(s, d):
    """id, x: six counts of orders of a customer's orders by priority and status."""
    o = read(s, d, "orders")
    return o.groupBy((F.col("o_custkey") % 300).alias("id")).pivot("o_orderpriority").agg(F.round(F.sum("o_totalprice") / 1e5).cast("double")).na.fill(0.0)


def series(s, d):
    w = wide(s, d)
    return w.select("id", F.array(*[F.col(c) for c in w.columns if c != "id"]).alias("x"))


def _de(s, d):
    return st.de_no_replicates(longs(s, d), "A", "R", 0.2, 1.05)


def _biased(s, d, **how):
    """Enrichment of the parts by the length of their names; p and q as the tests of exact sums see them, to 8 digits."""
    lengths = read(s, d, "part").select(F.col("p_partkey").alias("gene"), F.length("p_name").alias("len"))
    return _rounded(bias.go_enrich_length_bias(_closure(s, d), _fg(s, d), lengths, **how)).withColumn("odds", F.round("odds", 6))


_PATH = "cl AS (SELECT p_partkey AS gene, p_brand AS term FROM part)"
_HY = "x AS (SELECT term, count(*) FILTER (gene IN (SELECT p_partkey FROM part WHERE p_size > 40)) AS k, count(*) AS big_k, (SELECT count(*) FROM part WHERE p_size > 40) AS n, (SELECT count(DISTINCT gene) FROM cl) AS big_n FROM cl GROUP BY 1)"
_P = f"CASE WHEN k * big_n < n * big_k THEN 1.0::DOUBLE ELSE least(1.0, list_sum(list_transform(range(k, least(n, big_k) + 1), lambda i: exp({_LC.format('big_k', 'i')} + {_LC.format('(big_n - big_k)', '(n - i)')} - {_LC.format('big_n', 'n')})))) END"
_BH = "least(1.0, min({0} * m / i) OVER ({1} ORDER BY i DESC ROWS UNBOUNDED PRECEDING))"

_REP = f"""WITH {LONG}, g AS (SELECT id, avg(ln(value)) AS g FROM lo WHERE value > 0 GROUP BY 1 HAVING count(DISTINCT sample) = 3),
f AS (SELECT sample, round(median(exp(ln(value) - g)), 6) AS factor FROM lo JOIN g USING (id) GROUP BY 1),
d AS (SELECT id, avg(value / factor) FILTER (sample IN ('A', 'N')) AS mt, avg(value / factor) FILTER (sample = 'R') AS mc, avg(value / factor) AS m, var_samp(value / factor) AS var FROM lo JOIN f USING (sample) GROUP BY 1),
v AS (SELECT *, greatest((var - m) / (m * m), 1e-8::DOUBLE) AS disp, log2((mt + 0.5) / (mc + 0.5)) AS l FROM d WHERE mt > 0 AND mc > 0),
u AS (SELECT *, l / (sqrt((1 / mt + disp) / 2 + (1 / mc + disp) / 1) / ln(2)) AS z FROM v),
w AS (SELECT id, mt, mc, round(l, 4) AS lfc, disp, round(2 * {_tail('z')}, 6) AS p FROM u)"""
_DE = f"WITH {LONG}, g AS (SELECT id, coalesce(sum(value) FILTER (sample = 'A'), 0)::DOUBLE AS x, coalesce(sum(value) FILTER (sample = 'R'), 0)::DOUBLE AS y FROM lo GROUP BY 1 HAVING x > 0 AND y > 0), t AS (SELECT *, sum(x) OVER () AS nx, sum(y) OVER () AS ny FROM g), z AS (SELECT id, round(log2(x / nx) - log2(y / ny), 6) AS m, round((log2(x) + log2(y)) / 2, 6) AS a, round((x - (x + y) * (nx / (nx + ny))) / sqrt((x + y) * (nx / (nx + ny)) * (1 - nx / (nx + ny))), 6) AS z FROM t), p AS (SELECT *, round(2 * {_tail('z')}, 6) AS p FROM z), r AS (SELECT id, m AS mm, a, z, p, row_number() OVER (ORDER BY p, id) AS i, count(*) OVER () AS m FROM p), q AS (SELECT *, round({_BH.format('p', '')}, 6) AS q FROM r), s AS (SELECT CASE WHEN abs(mm) > log2(1.05) AND q < 0.2 THEN CASE WHEN mm > 0 THEN 'up' WHEN mm < 0 THEN 'down' END END AS class FROM q)"

QUERIES = {
    "binomial_tail": (lambda s, d: st.binomial_tail(counts(s, d), "n", "r", 0.12).select("key", "n", "r", F.round("p", 8).alias("p")), f"WITH {CNT} SELECT key, n, r, round(CASE WHEN r <= 0 THEN 1.0::DOUBLE ELSE least(1.0, list_sum(list_transform(range(r, n + 1), lambda i: exp({_LC.format('n', 'i')} + i * ln(0.12) + (n - i) * ln(1 - 0.12))))) END, 8) AS p FROM c"),
    "hypergeom_tail": (lambda s, d: st.enrich(_closure(s, d), _fg(s, d)).select("term", "k", "n", "big_k", "big_n", F.round("p", 8).alias("p")), f"WITH {GO}, {_HY} SELECT term, k, n, big_k, big_n, round({_P}, 8) AS p FROM x WHERE k >= 1"),
    "t_test": (lambda s, d: st.t_test(line(s, d), "key", "grp", "A", "R", "v"), None),
    "rank_sum": (lambda s, d: st.rank_sum(line(s, d), "key", "grp", "A", "R", "v"), f"WITH l AS (SELECT l_suppkey AS key, l_returnflag AS g, l_quantity AS v FROM lineitem WHERE l_returnflag IN ('A', 'R')), r AS (SELECT key, g, rank() OVER (PARTITION BY key ORDER BY v) + (count(*) OVER (PARTITION BY key, v) - 1) / 2.0::DOUBLE AS r FROM l), s AS (SELECT key, sum(r) FILTER (g = 'A') AS w, count(*) FILTER (g = 'A') AS n, count(*) FILTER (g = 'R') AS m FROM r GROUP BY 1), z AS (SELECT *, (w - n * (n + m + 1) / 2.0::DOUBLE) / sqrt(n * m * (n + m + 1) / 12.0::DOUBLE) AS z FROM s) SELECT key, w, round((w - n * (n + 1) / 2.0::DOUBLE) / (n * m), 6) AS u, round(z, 6) AS z, round(2 * {_tail('z')}, 6) AS p FROM z"),
    "ks_test": (lambda s, d: st.ks_test(line(s, d), "key", "grp", "A", "R", "v").select("key", "d"), "WITH l AS (SELECT l_suppkey AS key, l_quantity AS v, count(*) FILTER (l_returnflag = 'A') AS x, count(*) FILTER (l_returnflag = 'R') AS y FROM lineitem GROUP BY 1, 2), f AS (SELECT key, sum(x) OVER w / sum(x) OVER (PARTITION BY key) AS fx, sum(y) OVER w / sum(y) OVER (PARTITION BY key) AS fy FROM l WINDOW w AS (PARTITION BY key ORDER BY v)) SELECT key, round(max(abs(fx - fy)), 6) AS d FROM f GROUP BY 1"),
    "fisher_z": (lambda s, d: st.fisher_z(read(s, d, "lineitem").groupBy(F.col("l_suppkey").alias("key")).agg(F.corr("l_quantity", "l_extendedprice").alias("r"), F.count("*").alias("n")), "r", "n").select("key", F.round("z", 5).alias("z"), F.round("score", 4).alias("score")), "WITH c AS (SELECT l_suppkey AS key, corr(l_quantity, l_extendedprice) AS r, count(*) AS n FROM lineitem GROUP BY 1) SELECT key, round(0.5 * (ln(1 + r) - ln(1 - r)), 5) AS z, round(0.5 * (ln(1 + r) - ln(1 - r)) * sqrt(n - 3), 4) AS score FROM c"),
    "padjust": (lambda s, d: st.padjust(pvals(s, d), "p", "BH", ["p_brand"], ["p_partkey"]).select("p_partkey", F.round("q", 6).alias("bh")).join(st.padjust(pvals(s, d), "p", "holm", ["p_brand"], ["p_partkey"]).select("p_partkey", F.round("q", 6).alias("holm")), "p_partkey").join(st.padjust(pvals(s, d), "p", "bonferroni", ["p_brand"], ["p_partkey"]).select("p_partkey", F.round("q", 6).alias("bonferroni")), "p_partkey"), f"WITH {PV}, r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p, p_partkey) AS i, count(*) OVER (PARTITION BY p_brand) AS m FROM pv) SELECT p_partkey, round({_BH.format('p', 'PARTITION BY p_brand')}, 6) AS bh, round(least(1.0, max(p * (m - i + 1)) OVER (PARTITION BY p_brand ORDER BY i ROWS UNBOUNDED PRECEDING)), 6) AS holm, round(least(1.0, p * m), 6) AS bonferroni FROM r"),
    "fdr_threshold": (lambda s, d: st.fdr_threshold(pvals(s, d), "p", 0.9, ["p_brand"]), f"WITH {PV}, r AS (SELECT *, rank() OVER (PARTITION BY p_brand ORDER BY p) AS i, count(*) OVER (PARTITION BY p_brand) AS m FROM pv) SELECT p_brand, coalesce(max(p) FILTER (p * m / i <= 0.9), 0.0) AS threshold FROM r GROUP BY 1"),
    "size_factors": (lambda s, d: st.size_factors(longs(s, d)), f"WITH {LONG}, g AS (SELECT id, avg(ln(value)) AS g FROM lo WHERE value > 0 GROUP BY 1 HAVING count(DISTINCT sample) = 3) SELECT sample, round(median(exp(ln(value) - g)), 6) AS factor FROM lo JOIN g USING (id) GROUP BY 1"),
    "tmm_factors": (lambda s, d: st.tmm_factors(longs(s, d), "A"), f"WITH {LONG}, l AS (SELECT *, sum(value) OVER (PARTITION BY sample) AS lib FROM lo), j AS (SELECT x.id, x.sample, log2((x.value / x.lib::DOUBLE) / (r.value / r.lib::DOUBLE)) AS m, 1 / ((x.lib - x.value) / (x.lib::DOUBLE * x.value) + (r.lib - r.value) / (r.lib::DOUBLE * r.value)) AS w FROM l x JOIN l r ON r.id = x.id AND r.sample = 'A'), k AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY m, id) AS r, count(*) OVER (PARTITION BY sample) AS c FROM j) SELECT sample, round(pow(2.0, sum(w * m) / sum(w)), 6) AS factor FROM k WHERE r > floor(c * 0.3) AND r <= c - floor(c * 0.3) GROUP BY 1"),
    "de_no_replicates": (_de, f"WITH {LONG}, g AS (SELECT id, coalesce(sum(value) FILTER (sample = 'A'), 0)::DOUBLE AS x, coalesce(sum(value) FILTER (sample = 'R'), 0)::DOUBLE AS y FROM lo GROUP BY 1 HAVING x > 0 AND y > 0), t AS (SELECT *, sum(x) OVER () AS nx, sum(y) OVER () AS ny FROM g), z AS (SELECT id, round(log2(x / nx) - log2(y / ny), 6) AS m, round((log2(x) + log2(y)) / 2, 6) AS a, round((x - (x + y) * (nx / (nx + ny))) / sqrt((x + y) * (nx / (nx + ny)) * (1 - nx / (nx + ny))), 6) AS z FROM t), p AS (SELECT *, round(2 * {_tail('z')}, 6) AS p FROM z), r AS (SELECT id, m AS mm, a, z, p, row_number() OVER (ORDER BY p, id) AS i, count(*) OVER () AS m FROM p), q AS (SELECT *, round({_BH.format('p', '')}, 6) AS q FROM r) SELECT id, mm AS m, a, z, p, q, abs(mm) > log2(1.05) AND q < 0.2 AS significant FROM q"),
    "volcano_class": (lambda s, d: st.volcano_class(_de(s, d)).groupBy("class").agg(F.count("*").alias("n")), f"{_DE} SELECT coalesce(class, 'false') AS class, count(*) AS n FROM s GROUP BY 1"),
    "diff_summary": (
        lambda s, d: n.diff_summary(st.volcano_class(_de(s, d))),
        f"{_DE} SELECT count(class) AS de, count(*) FILTER (class = 'up') AS up, count(*) FILTER (class = 'down') AS down, least(de, up, down) < 10 AS few FROM s",
    ),
    "de_replicates": (
        lambda s, d: st.de_replicates(longs(s, d), ["A", "N"], ["R"]),
        f"{_REP} SELECT id, round(mt, 4) AS treat, round(mc, 4) AS control, lfc, round(disp, 6) AS dispersion, p FROM w",
    ),
    "de_call_pval_fc": (
        lambda s, d: n.de_call_pval_fc(st.de_replicates(longs(s, d), ["A", "N"], ["R"]), 0.5, 0.1),
        f"{_REP} SELECT id, lfc, CASE WHEN lfc > 0 THEN 'up' ELSE 'down' END AS direction FROM w WHERE p < 0.5 AND abs(lfc) > 0.1",
    ),
    "de_call_padj": (
        lambda s, d: st.de_call_padj(st.de_replicates(longs(s, d), ["A", "N"], ["R"]), 0.9).select("id", "lfc", "p", F.round("q", 6).alias("q"), "direction"),
        f"{_REP}, r AS (SELECT *, row_number() OVER (ORDER BY p, id) AS i, count(*) OVER () AS m FROM w), q AS (SELECT id, lfc, p, {_BH.format('p', '')} AS q FROM r) SELECT id, lfc, p, round(q, 6) AS q, CASE WHEN lfc > 0 THEN 'up' ELSE 'down' END AS direction FROM q WHERE q < 0.9",
    ),
    "sample_correlation": (lambda s, d: st.sample_correlation(longs(s, d)), f"WITH {LONG}, x AS (SELECT *, log10(value + 1) AS l, rank() OVER (PARTITION BY sample ORDER BY value) + (count(*) OVER (PARTITION BY sample, value) - 1) / 2.0::DOUBLE AS r FROM lo) SELECT a.sample AS a, b.sample AS b, round(pow(corr(a.l, b.l), 2), 4) AS r2, round(corr(a.r, b.r), 4) AS spearman, round(regr_slope(b.l, a.l), 4) AS slope, round(regr_intercept(b.l, a.l), 4) AS intercept FROM x a JOIN x b ON a.id = b.id AND a.sample < b.sample GROUP BY 1, 2"),
    "sample_kendall": (
        lambda s, d: st.sample_kendall(longs(s, d)),
        f"""WITH {LONG}, j AS (SELECT a.sample AS a, b.sample AS b, a.value AS x, b.value AS y FROM lo a JOIN lo b ON a.id = b.id AND a.sample < b.sample),
  o AS (SELECT p.a, p.b, sum(sign(p.x - q.x) * sign(p.y - q.y)) AS s, count(*) FILTER (p.x <> q.x) AS nx, count(*) FILTER (p.y <> q.y) AS ny FROM j p JOIN j q USING (a, b) GROUP BY 1, 2)
SELECT a, b, (SELECT count(*) FROM j WHERE j.a = o.a AND j.b = o.b) AS points, round(s / sqrt(nx::DOUBLE * ny), 6) AS tau FROM o""",
    ),
    "zscale_rows": (lambda s, d: st.zscale_rows(longs(s, d), "id", "value"), f"WITH {LONG} SELECT id, sample, value, round((value - avg(value) OVER w) / stddev_samp(value) OVER w, 6) AS z FROM lo WINDOW w AS (PARTITION BY id)"),
    "cluster_expression": (lambda s, d: st.cluster_expression(read(s, d, "embeddings"), "vec_id", "embedding"), None),
    "go_closure": (_closure, f"WITH {GO} SELECT gene, term FROM cl"),
    "go_enrich": (
        lambda s, d: _rounded(st.enrich(_closure(s, d), _fg(s, d))),
        f"WITH {GO}, {_HY}, p AS (SELECT term, k, n, big_k, big_n, {_P} AS p FROM x WHERE k >= 1), r AS (SELECT *, row_number() OVER (ORDER BY p, term) AS i, count(*) OVER () AS m FROM p) SELECT term, k, n, big_k, big_n, round(p, 8) AS p, round({_BH.format('p', '')}, 8) AS q FROM r",
    ),
    "go_enrich_genes": (lambda s, d: st.term_genes(_closure(s, d), _fg(s, d)), f"WITH {GO} SELECT term, gene FROM cl WHERE gene IN (SELECT p_partkey FROM part WHERE p_size > 40)"),
    "kegg_enrich": (
        lambda s, d: _rounded(st.enrich(_pathways(s, d), _fg(s, d), method="bonferroni", cutoff=5)),
        f"WITH {_PATH}, {_HY}, p AS (SELECT term, k, n, big_k, big_n, {_P} AS p FROM x WHERE k >= 1 AND big_k >= 5) SELECT term, k, n, big_k, big_n, round(p, 8) AS p, round(least(1.0, p * count(*) OVER ()), 8) AS q FROM p",
    ),
    "kegg_enrich_binomial": (
        lambda s, d: _rounded(st.enrich(_pathways(s, d), _fg(s, d), method="QVALUE", test="b", cutoff=5)),
        f"WITH {_PATH}, {_HY}, p AS (SELECT term, k, n, big_k, big_n, least(1.0, list_sum(list_transform(range(k, n + 1), lambda i: exp({_LC.format('n', 'i')} + i * ln(big_k::DOUBLE / big_n) + (n - i) * ln(1 - big_k::DOUBLE / big_n))))) AS p FROM x WHERE k >= 1 AND big_k >= 5), r AS (SELECT *, row_number() OVER (ORDER BY p, term) AS i, count(*) OVER () AS m, count(*) FILTER (p > 0.5) OVER () AS h FROM p) SELECT term, k, n, big_k, big_n, round(p, 8) AS p, round({_BH.format('least(1.0, (1 + h) / (m / 2::DOUBLE)) * p', '')}, 8) AS q FROM r",
    ),
    "kegg_enrich_chi": (
        lambda s, d: _rounded(st.enrich(_pathways(s, d), _fg(s, d), test="c", cutoff=5), 6),
        f"WITH {_PATH}, {_HY}, z AS (SELECT *, abs(k * (big_n - n - big_k + k) - (n - k) * (big_k - k)) * sqrt(big_n / (n::DOUBLE * (big_n - n) * big_k * (big_n - big_k))) AS z FROM x WHERE k >= 1 AND big_k >= 5), p AS (SELECT term, k, n, big_k, big_n, 2 * {_tail('z')} AS p FROM z), r AS (SELECT *, row_number() OVER (ORDER BY p, term) AS i, count(*) OVER () AS m FROM p) SELECT term, k, n, big_k, big_n, round(p, 6) AS p, round({_BH.format('p', '')}, 6) AS q FROM r",
    ),
    "kegg_frequency": (
        lambda s, d: st.frequency_list(_pathways(s, d), _fg(s, d)).select("term", "k", F.round("share", 8).alias("share")),
        f"WITH {_PATH}, {_HY} SELECT term, k, round(k::DOUBLE / n, 8) AS share FROM x WHERE k > 0",
    ),
    "go_enrich_length_bias": (lambda s, d: _biased(s, d), None),
    "go_enrich_length_sampling": (lambda s, d: _biased(s, d, method="Sampling", draws=500), None),
    "expr_pattern_pairs": (lambda s, d: st.expr_pattern_pairs(series(s, d), series(s, d), 5.0, 0.95), None),
}
