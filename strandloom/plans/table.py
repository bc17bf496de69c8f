"""Queries on the table toolkit and on vectors, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.operators import table as t
from strandloom.operators import vectors as v
from strandloom.plans.views import read



def o(s, d):
    return read(s, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


def line(s, d):
    return read(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")


def part(s, d):
    return read(s, d, "part")


def emb(s, d):
    return read(s, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.floor(x * 1000).cast("double")).alias("x")).withColumn("y", F.reverse("x"))


KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LAST = "last_ AS (SELECT l_orderkey AS o_orderkey, arg_max(l_partkey, (l_linenumber::BIGINT * 1000000000 + l_partkey) * 100000 + l_suppkey) AS l_partkey, arg_max(l_quantity, (l_linenumber::BIGINT * 1000000000 + l_partkey) * 100000 + l_suppkey) AS l_quantity FROM lineitem WHERE l_quantity > 25 GROUP BY 1)"
EMB = "e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 1000)) AS x FROM embeddings), m AS (SELECT vec_id, x, list_reverse(x) AS y FROM e)"


def right(s, d):
    return read(s, d, "lineitem").where("l_quantity > 25").select(F.col("l_orderkey").alias("o_orderkey"), ((F.col("l_linenumber").cast("long") * 1000000000 + F.col("l_partkey")) * 100000 + F.col("l_suppkey")).alias("l_linenumber"), "l_partkey", "l_quantity")


def _arith(s, d):
    x = line(s, d).select(*KEY, "l_extendedprice", "l_discount", "l_quantity")
    ops = [("add", 2.5), ("subtract", 2.5), ("multiply", 2.0), ("divide", 0.0), ("mod", 7.0), ("floor",), ("ceil",), ("round",), ("sign",), ("clamp", 5000.0, 40000.0), ("resolution", 100.0), ("ln",), ("log2",), ("log10",)]
    return x.select(*KEY, *[F.round(t.arith(F.col("l_extendedprice"), *a), 4).cast("double").alias(f"r_{a[0]}") for a in ops], F.round(t.arith(F.col("l_discount"), "inverse"), 4).alias("r_inverse"), F.round(t.arith(F.col("l_discount"), "exp"), 4).alias("r_exp"), F.round(t.arith(F.col("l_quantity"), "pow", 2.0), 4).alias("r_pow"), F.round(t.arith(F.col("l_discount"), "power_of", 10.0), 4).alias("r_power_of"), F.round(t.arith(-F.col("l_quantity"), "abs"), 4).alias("r_abs"))


def _scale(s, d):
    x = line(s, d).select(*KEY, "l_extendedprice")
    for op, *a in (("range", 0.0, 1.0), ("z",), ("centre",), ("by_mean",), ("probability",), ("bins", 10), ("pivot", 30000.0)):
        y = t.modify_scale(line(s, d).select(*KEY, "l_extendedprice"), "l_extendedprice", op, *a).select(*KEY, (F.round(F.col("l_extendedprice").cast("double"), 4) + 0.0).alias(f"s_{op}"))
        x = y if op == "range" else x.join(y, KEY)
    return x


def _average(s, d):
    x = line(s, d).withColumn("k", F.col("l_orderkey") * 1000000000 + F.col("l_linenumber").cast("long") * 100000000 + F.col("l_partkey")).withColumn("q", F.col("l_quantity").cast("long"))
    out = None
    for mode in ("mean", "max", "min", "sum", "std", "median", "last", "list", "weighted", "count"):
        y = t.average_rows(x, ["l_suppkey"], "q", mode, order="k", weight="l_linenumber")
        c = F.col("q") if mode in ("list", "count", "max", "min", "sum", "last") else F.round("q", 6)
        y = y.select("l_suppkey", c.alias(mode))
        out = y if out is None else out.join(y, "l_suppkey")
    return out.join(t.average_rows(x.withColumn("z", F.col("l_discount")), ["l_suppkey"], "z", "logsumexp").select("l_suppkey", F.round("z", 6).alias("logsumexp")), "l_suppkey")


def _strings(s, d):
    p = part(s, d).select("p_partkey", "p_name", "p_type")
    for op, *a in (("substr", 2, 5), ("length",), ("reverse",), ("remove", "[aeiou]"), ("replace", "a", "_"), ("prefix", ">"), ("suffix", "<"), ("quote",), ("set", "x"), ("letters", "-")):
        p = t.modify_string(p.withColumn(f"n_{op}", F.col("p_name")), f"n_{op}", op, *a)
    return t.modify_string(p, "p_type", "split", " ", 3).drop("p_name")


def _synonyms(s, d):
    """Names of parts joined with types through classes of brands that share a size."""
    pairs = part(s, d).select(F.col("p_brand").alias("a"), F.concat(F.lit("size"), "p_size").alias("b")).distinct()
    left = part(s, d).groupBy(F.col("p_brand").alias("name")).agg(F.count("*").alias("n"))
    right_ = part(s, d).groupBy(F.col("p_brand").alias("name")).agg(F.max("p_partkey").alias("top"))
    return t.table_join_synonyms(left, right_, "name", pairs, ["top"])


def _sequential(s, d):
    c = read(s, d, "customer").select(F.col("c_custkey").alias("k"), "c_name")
    return t.sequential_join([c, o(s, d).groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("orders")), o(s, d).where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("done"))], ["k"])


_ROUNDA = ", ".join(f"CAST(round({e}, 4) AS DOUBLE) AS r_{n}" for n, e in (("add", "l_extendedprice + 2.5"), ("subtract", "l_extendedprice - 2.5"), ("multiply", "l_extendedprice * 2.0"), ("divide", "999999.0"), ("mod", "l_extendedprice % 7.0"), ("floor", "floor(l_extendedprice)"), ("ceil", "ceil(l_extendedprice)"), ("round", "ceil(l_extendedprice - 0.5)"), ("sign", "sign(l_extendedprice)"), ("clamp", "greatest(least(l_extendedprice, 40000.0), 5000.0)"), ("resolution", "floor(l_extendedprice / 100.0) * 100.0"), ("ln", "ln(l_extendedprice)"), ("log2", "log2(l_extendedprice)"), ("log10", "log10(l_extendedprice)"), ("inverse", "CASE WHEN l_discount = 0 THEN 999999.0 ELSE 1.0 / l_discount END"), ("exp", "exp(l_discount)"), ("pow", "pow(l_quantity, 2.0)"), ("power_of", "pow(10.0, l_discount)"), ("abs", "abs(l_quantity)")))
_W = "OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)"

QUERIES = {
    "table_join": (lambda s, d: t.table_join(o(s, d), right(s, d), ["o_orderkey"], ["l_linenumber"]).select("o_orderkey", "o_custkey", "l_partkey", "l_quantity"), f"WITH {LAST} SELECT o_orderkey, o_custkey, l_partkey, l_quantity FROM orders JOIN last_ USING (o_orderkey)"),
    "table_join_outer": (lambda s, d: t.table_join_outer(t.table_join_outer(o(s, d), right(s, d).drop("l_quantity"), ["o_orderkey"], ["l_linenumber"], fill=-1), right(s, d).select("o_orderkey", F.col("l_linenumber").alias("o"), F.col("l_partkey").alias("p2")), ["o_orderkey"], ["o"], key_as_fill=True).select("o_orderkey", "l_partkey", "p2"), f"WITH {LAST} SELECT o_orderkey, coalesce(l_partkey, -1) AS l_partkey, coalesce(l_partkey, o_orderkey) AS p2 FROM orders LEFT JOIN last_ USING (o_orderkey)"),
    "table_join_anti": (lambda s, d: t.table_join_anti(o(s, d), right(s, d), ["o_orderkey"]).select("o_orderkey", "o_custkey"), "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 25)"),
    "table_join_merge": (lambda s, d: t.table_join_merge(o(s, d).select("o_orderkey", F.col("o_custkey").alias("v")), right(s, d).select("o_orderkey", "l_linenumber", F.col("l_partkey").alias("v")), ["o_orderkey"], "v", ["l_linenumber"]), f"WITH {LAST} SELECT o_orderkey, coalesce(l_partkey, o_custkey) AS v FROM orders LEFT JOIN last_ USING (o_orderkey)"),
    "table_join_keynorm": (lambda s, d: t.table_join_keynorm(part(s, d).select(F.concat(F.col("p_size").cast("string"), F.lit(".7")).alias("k"), "p_partkey"), part(s, d).groupBy(F.concat(F.col("p_size").cast("string"), F.lit(".2")).alias("k")).agg(F.count("*").alias("n")), "k", "num", ["n"]).join(t.table_join_keynorm(part(s, d).select(F.lower("p_brand").alias("k"), "p_partkey"), part(s, d).groupBy(F.col("p_brand").alias("k")).agg(F.count("*").alias("b")), "k", "upper", ["b"]).withColumnRenamed("k", "brand"), "p_partkey"), "SELECT p.p_partkey, CAST(p_size AS BIGINT) AS k, n, upper(p_brand) AS brand, b FROM part p JOIN (SELECT p_size, count(*) AS n FROM part GROUP BY 1) USING (p_size) JOIN (SELECT p_brand, count(*) AS b FROM part GROUP BY 1) USING (p_brand)"),
    "table_join_synonyms": (_synonyms, "WITH RECURSIVE e AS (SELECT DISTINCT p_brand AS a, 'size' || p_size AS b FROM part), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r(n, m) AS (SELECT a, a FROM u UNION SELECT u.a, r.m FROM r JOIN u ON u.b = r.n), k AS (SELECT n, min(m) AS c FROM r GROUP BY 1), l AS (SELECT p_brand AS name, count(*) AS n, max(p_partkey) AS top, coalesce(any_value(c), p_brand) AS c FROM part LEFT JOIN k ON k.n = p_brand GROUP BY p_brand) SELECT name, n, (SELECT max(top) FROM l x WHERE x.c = l.c) AS top FROM l"),
    "join_project": (lambda s, d: t.join_project(t.table_join(o(s, d), right(s, d), ["o_orderkey"], ["l_linenumber"]), ["o_totalprice", "o_orderstatus", "l_linenumber", "o_orderpriority"], True), f"WITH {LAST} SELECT o_orderkey, o_custkey, l_partkey, l_quantity FROM orders JOIN last_ USING (o_orderkey)"),
    "sequential_join": (_sequential, "SELECT c_custkey AS k, c_name, count(*) AS orders, count(*) FILTER (o_orderstatus = 'F') AS done FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2 HAVING count(*) FILTER (o_orderstatus = 'F') > 0"),
    "sort_merge_join": (lambda s, d: t.sort_merge_join(o(s, d).select(F.col("o_orderkey").alias("k"), "o_custkey"), line(s, d).select(F.col("l_orderkey").alias("k"), "l_suppkey"), ["k"]), "SELECT DISTINCT o_orderkey AS k, o_custkey, l_suppkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey"),
    "best_hit": (lambda s, d: t.best_hit(line(s, d).withColumn("evalue", F.col("l_discount")), "l_partkey", ["evalue", F.desc("l_quantity"), *KEY], 0.05).select(*KEY, "evalue"), "SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, l_discount AS evalue FROM lineitem WHERE l_discount <= 0.05 QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_discount, l_quantity DESC, l_orderkey, l_linenumber, l_suppkey) = 1"),
    "line_number": (lambda s, d: t.line_number(o(s, d).select("o_orderkey"), ["o_orderkey"], 10, -3), "SELECT o_orderkey, 10 - 3 * (row_number() OVER (ORDER BY o_orderkey) - 1) AS line FROM orders"),
    "uniquify": (lambda s, d: t.uniquify(t.uniquify(part(s, d).select("p_partkey", "p_brand", "p_type"), ["p_brand"], ["p_partkey"]), ["p_type"], ["p_partkey"], "_", force=True), "SELECT p_partkey, CASE WHEN b > 1 THEN p_brand || '-' || (b - 1) ELSE p_brand END AS p_brand, p_type || '_' || k AS p_type FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS b, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS k FROM part)"),
    "take_first_n": (lambda s, d: t.take_first_n(o(s, d).select("o_custkey", "o_orderkey"), ["o_custkey"], 2, ["o_orderkey"]), "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) <= 2"),
    "cumulative_sum": (lambda s, d: t.cumulative_sum(line(s, d).select(*KEY, F.col("l_quantity").cast("long").alias("q")), "q", [*KEY, "q"]), "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) AS q, CAST(sum(CAST(l_quantity AS BIGINT)) OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, q ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumul FROM lineitem"),
    "moving_window": (lambda s, d: t.moving_window(read(s, d, "events").select("user_id", "event_id", "ts", F.floor("value").alias("v")), "v", 2, ["ts", "event_id"], ["user_id"]).select("event_id", F.round("avg_v", 6).alias("avg_v"), "max_v", "min_v"), f"SELECT event_id, round(avg(v) {_W}, 6) AS avg_v, max(v) {_W} AS max_v, min(v) {_W} AS min_v FROM (SELECT *, CAST(floor(value) AS BIGINT) AS v FROM events)"),
    "body_range": (lambda s, d: t.body_range(o(s, d).select("o_orderkey"), 0.25, -100, ["o_orderkey"]), "SELECT o_orderkey, n AS line FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n, count(*) OVER () AS t FROM orders) WHERE n BETWEEN floor(t * 0.25) + 1 AND t + 1 - 100"),
    "table_transpose": (lambda s, d: t.table_transpose(read(s, d, "nation").select("n_nationkey", "n_name", "n_regionkey").where("n_nationkey < 30"), "n_nationkey"), None),
    "sort_report": (lambda s, d: t.sort_report(o(s, d).select("o_orderkey", F.col("o_totalprice").cast("string").alias("p")), "p").select("o_orderkey", F.col("p").cast("double").alias("p")), "SELECT o_orderkey, o_totalprice AS p FROM orders"),
    "add_const_or_counter": (lambda s, d: t.add_const_or_counter(t.add_const_or_counter(o(s, d).select("o_orderkey"), "c", "x"), "n", order=["o_orderkey"]), "SELECT o_orderkey, 'x' AS c, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders"),
    "add_arith": (lambda s, d: t.add_arith(t.add_arith(t.add_arith(t.add_arith(t.add_arith(line(s, d).select(*KEY, F.floor(F.col("l_discount") * 100).alias("z")), "ratio", "l_partkey", "z", "ratio"), "difference", "l_partkey", "l_suppkey", "diff"), "product", "l_partkey", "l_suppkey", "prod"), "sum", "l_partkey", "l_suppkey", "total"), "concat", "l_partkey", "l_suppkey", "cat").select(*KEY, F.round("ratio", 6).alias("ratio"), "diff", "prod", "total", "cat"), "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(CASE WHEN floor(l_discount * 100) <> 0 THEN l_partkey / CAST(floor(l_discount * 100) AS DOUBLE) END, 6) AS ratio, l_partkey - l_suppkey AS diff, l_partkey * l_suppkey AS prod, l_partkey + l_suppkey AS total, l_partkey::VARCHAR || l_suppkey::VARCHAR AS cat FROM lineitem"),
    "add_rowwise_agg": (lambda s, d: t.add_rowwise_agg(t.add_rowwise_agg(t.add_rowwise_agg(t.add_rowwise_agg(t.add_rowwise_agg(line(s, d).select(*KEY, F.when(F.col("l_quantity") > 10, F.col("l_quantity")).alias("q")), "min", ["l_partkey", "l_suppkey", "q"], "lo"), "max", ["l_partkey", "l_suppkey", "q"], "hi"), "count", ["l_partkey", "l_suppkey", "q"], "n"), "ave", ["l_partkey", "l_suppkey", "q"], "mean"), "quant", ["l_partkey", "l_suppkey", "q"], "trimmed", (0.34, 0.67)).select(*KEY, "lo", "hi", "n", F.round("mean", 6).alias("mean"), F.round("trimmed", 6).alias("trimmed")), "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, list_min(x) AS lo, list_max(x) AS hi, CAST(len(x) AS INT) AS n, round(list_avg(x), 6) AS mean, round(list_avg(x[CAST(floor(len(x) * 0.34) AS INT) + 1:CAST(ceil(len(x) * 0.67) AS INT)]), 6) AS trimmed FROM (SELECT *, list_sort(list_filter([l_partkey::DOUBLE, l_suppkey::DOUBLE, CASE WHEN l_quantity > 10 THEN l_quantity END], lambda v: v IS NOT NULL)) AS x FROM lineitem)"),
    "modify_where": (lambda s, d: t.modify_where(line(s, d).select(*KEY, "l_quantity", "l_tax"), ["l_quantity", "l_tax"], lambda c: c.between(0.03, 30), lambda c: c * 0), "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_quantity BETWEEN 0.03 AND 30 THEN 0.0::DOUBLE ELSE l_quantity END AS l_quantity, CASE WHEN l_tax BETWEEN 0.03 AND 30 THEN 0.0::DOUBLE ELSE l_tax END AS l_tax FROM lineitem"),
    "modify_arith": (_arith, f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_ROUNDA} FROM lineitem"),
    "modify_by_column": (lambda s, d: line(s, d).select(*KEY, F.round(F.when(F.col("l_discount") == 0, 999999.0).otherwise(F.col("l_quantity") / F.col("l_discount")), 4).alias("q")).join(t.modify_by_column(line(s, d).select(*KEY, "l_quantity", "l_discount"), "l_quantity", "max", "l_discount").select(*KEY, F.col("l_quantity").alias("m")), KEY), "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(CASE WHEN l_discount = 0 THEN 999999.0 ELSE l_quantity / l_discount END, 4) AS q, greatest(l_quantity, l_discount) AS m FROM lineitem"),
    "modify_string": (_strings, "SELECT p_partkey, substr(p_name, 2, 5) AS n_substr, CAST(len(p_name) AS INT) AS n_length, reverse(p_name) AS n_reverse, regexp_replace(p_name, '[aeiou]', '', 'g') AS n_remove, replace(p_name, 'a', '_') AS n_replace, '>' || p_name AS n_prefix, p_name || '<' AS n_suffix, '\"' || p_name || '\"' AS n_quote, 'x' AS n_set, array_to_string(string_split(p_name, ''), '-') AS n_letters, nullif(split_part(p_type, ' ', 1), '') AS p_type_1, nullif(split_part(p_type, ' ', 2), '') AS p_type_2, nullif(split_part(p_type, ' ', 3), '') AS p_type_3 FROM part"),
    "modify_scale": (_scale, "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round((x - lo) / (hi - lo), 4) + 0.0 AS s_range, round((x - m) / sd, 4) + 0.0 AS s_z, round(x - m, 4) + 0.0 AS s_centre, round(x / m, 4) + 0.0 AS s_by_mean, round(greatest(x, 0) / t, 4) + 0.0 AS s_probability, round(lo + (least(floor((x - lo) / ((hi - lo) / 10)), 9) + 0.5) * ((hi - lo) / 10), 4) + 0.0 AS s_bins, CASE WHEN x >= 30000 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS s_pivot FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS x FROM lineitem), (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS sd, sum(greatest(l_extendedprice, 0)) AS t FROM lineitem)"),
    "average_rows": (_average, "SELECT l_suppkey, round(avg(q), 6) AS mean, max(q) AS max, min(q) AS min, CAST(sum(q) AS BIGINT) AS sum, round(stddev_pop(q), 6) AS std, round(median(q), 6) AS median, arg_max(q, k) AS last, string_agg(q::VARCHAR, ';' ORDER BY k) AS list, round(sum(q * l_linenumber)::DOUBLE / sum(l_linenumber), 6) AS weighted, count(*) AS count, round(ln(sum(exp(l_discount))), 6) AS logsumexp FROM (SELECT *, l_orderkey * 1000000000 + l_linenumber::BIGINT * 100000000 + l_partkey AS k, CAST(l_quantity AS BIGINT) AS q FROM lineitem) GROUP BY 1"),
    "cut_columns": (lambda s, d: t.cut_columns(t.cut_columns(o(s, d), "3,1-2,1"), names=["o_custkey"], invert=True), "SELECT o_orderstatus, o_orderkey, o_orderkey AS o_orderkey_2 FROM orders"),
    "merge_columns": (lambda s, d: t.merge_columns(t.merge_columns(part(s, d).select("p_partkey", "p_name", "p_brand", F.col("p_size").alias("a"), (F.col("p_size") % 7).alias("b")), "a", "b", "ab", ":", "numeric", True), "p_name", "p_brand", "nb", "|", "reversed"), "SELECT p_partkey, CASE WHEN p_size = p_size % 7 THEN p_size::VARCHAR ELSE least(p_size, p_size % 7) || ':' || greatest(p_size, p_size % 7) END AS ab, p_brand || '|' || p_name AS nb FROM part"),
    "permuted_labels": (lambda s, d: t.permuted_labels(line(s, d).select(*KEY, "l_returnflag"), KEY, "l_returnflag", 5), "WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS i FROM lineitem), b AS (SELECT l_returnflag, row_number() OVER (ORDER BY md5(l_orderkey || ':' || l_linenumber || ':' || l_partkey || ':' || l_suppkey || ':5'), l_orderkey, l_linenumber, l_partkey, l_suppkey) AS i FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM a JOIN b USING (i)"),
    "vec_basic": (lambda s, d: v.vec_basic(emb(s, d), "vec_id", "x", 50.0), f"WITH {EMB}, z AS (SELECT vec_id, x AS v FROM m) SELECT vec_id, round(list_sum(v), 6) AS sum, round(list_reduce(list_concat([1.0::DOUBLE], v), lambda a, b: a * b / 100), 6) + 0.0 AS product, round(list_avg(v), 6) AS mean, list_min(v) AS min, list_max(v) AS max, CAST(list_position(v, list_min(v)) AS BIGINT) AS argmin, CAST(list_position(v, list_max(v)) AS BIGINT) AS argmax, CAST(len(v) AS INT) AS n_full, v[1] AS first, list_filter(v, lambda q: q >= 50)[1] AS first_ge, list_filter(v, lambda q: q <= -50)[1] AS first_le, CAST(len(list_filter(v, lambda q: q >= 50)) AS INT) AS n_ge, CAST(len(list_filter(v, lambda q: q <= -50)) AS INT) AS n_le, list_sort(v)[3] AS kth FROM z"),
    "vec_spread": (lambda s, d: v.vec_spread(emb(s, d), "vec_id", "x"), f"WITH {EMB}, z AS (SELECT vec_id, x AS v, list_sort(x) AS s, len(x) AS n, list_avg(x) AS a FROM m), y AS (SELECT *, sqrt(list_sum(list_transform(v, lambda q: (q - a) * (q - a))) / n) AS d, s[CAST(n // 2 + 1 AS BIGINT)] AS u FROM z) SELECT vec_id, round(d, 6) AS sd, round(d / sqrt(n), 6) AS se, round(list_sort(list_transform(v, lambda q: abs(q - u)))[CAST(n // 2 + 1 AS BIGINT)], 6) AS mad, u AS upper_median, round((u + s[CAST((n - 1) // 2 + 1 AS BIGINT)]) / 2, 6) AS median, s[CAST(floor(0.25 * (n - 1)) + 1 AS BIGINT)] AS quantile FROM y"),
    "vec_center": (lambda s, d: v.vec_center(emb(s, d), "vec_id", "x").select("vec_id", F.posexplode("z")).select("vec_id", "pos", F.round("col", 6).alias("z")), f"WITH {EMB}, z AS (SELECT vec_id, x AS v, list_avg(x) AS a FROM m), y AS (SELECT *, sqrt(list_sum(list_transform(v, lambda q: (q - a) * (q - a))) / len(v)) AS d FROM z), w AS (SELECT vec_id, a, d, unnest(v) AS q, unnest(range(0, len(v))) AS pos FROM y) SELECT vec_id, CAST(pos AS INT) AS pos, round((q - a) / d, 6) AS z FROM w"),
    "vec_similarity": (lambda s, d: v.vec_similarity(emb(s, d), "vec_id", "x", "y"), f"WITH {EMB}, z AS (SELECT vec_id, unnest(x) AS a, unnest(y) AS b, unnest(range(0, len(x))) AS i, y, len(x) AS n FROM m) SELECT vec_id, round(corr(a, b), 6) AS pearson, round(sum(a * b), 6) AS dot, round(sum(a * b) / sum(abs(a)), 6) AS dot_l1, round(sum(a * b) / any_value(n), 6) AS mean_product, round(greatest(sum(a * b), sum(a * coalesce(y[i + 2], 0)), sum(a * coalesce(y[i + 3], 0)), sum(a * coalesce(y[i + 4], 0))), 6) AS best_dot FROM z GROUP BY 1"),
    "vec_information": (lambda s, d: v.vec_information(line(s, d).select("l_suppkey", (F.col("l_quantity") % 5).cast("int").alias("x"), (F.col("l_partkey") % 4).cast("int").alias("y")), "l_suppkey", "x", "y"), "WITH l AS (SELECT l_suppkey, CAST(l_quantity AS INT) % 5 AS x, l_partkey % 4 AS y FROM lineitem), t AS (SELECT l_suppkey, count(*) AS t FROM l GROUP BY 1), j AS (SELECT l_suppkey, x, y, count(*) AS n FROM l GROUP BY ALL), px AS (SELECT l_suppkey, x, sum(n) AS m FROM j GROUP BY ALL), py AS (SELECT l_suppkey, y, sum(n) AS m FROM j GROUP BY ALL) SELECT l_suppkey, (SELECT round(-sum(m::DOUBLE / t * log2(m::DOUBLE / t)), 6) FROM px WHERE px.l_suppkey = t.l_suppkey) AS entropy, (SELECT round(sum(n::DOUBLE / t * ln(n::DOUBLE * t / (px.m * py.m))), 6) FROM j JOIN px USING (l_suppkey, x) JOIN py USING (l_suppkey, y) WHERE j.l_suppkey = t.l_suppkey) AS mutual, (SELECT round(sum((px.m::DOUBLE / t - py.m::DOUBLE / t) * ln(px.m::DOUBLE / py.m)), 6) FROM px JOIN py ON px.l_suppkey = py.l_suppkey AND px.x = py.y WHERE px.l_suppkey = t.l_suppkey) AS kl FROM t"),
    "vec_sets": (lambda s, d: v.vec_sets(read(s, d, "part").select("p_partkey", F.split("p_type", "").alias("x"), F.split("p_brand", "").alias("y")).select("p_partkey", F.filter("x", lambda q: q != "").alias("x"), F.filter("y", lambda q: q != "").alias("y")), "p_partkey", "x", "y"), "WITH z AS (SELECT p_partkey, string_split(p_type, '') AS x, string_split(p_brand, '') AS y FROM part) SELECT p_partkey, array_to_string(list_sort(list_distinct(list_intersect(x, y))), ',') AS common, array_to_string(list_sort(list_distinct(list_concat(x, y))), ',') AS \"all\", array_to_string(list_transform(list_sort(list_distinct(x)), lambda a: a || ':' || len(list_filter(x, lambda b: b = a))), ',') AS counts, CAST(list_max(list_transform(x, lambda a: len(list_filter(x, lambda b: b = a)))) AS INT) AS most FROM z"),
    "ratio_to_first": (lambda s, d: v.ratio_to_first(emb(s, d).withColumn("x", F.transform("x", lambda q: F.abs(q))), "vec_id", "x").select("vec_id", F.posexplode("ratio")).select("vec_id", "pos", F.round("col", 6).alias("r")), f"WITH {EMB}, w AS (SELECT vec_id, abs(x[1]) AS f, unnest(x) AS q, unnest(range(0, len(x))) AS pos FROM m) SELECT vec_id, CAST(pos AS INT) AS pos, round(log2((abs(q) + 1) / (f + 1)), 6) AS r FROM w"),
}
