"""Operations on array columns; empty entries (null) do not count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.functions.seq import let


def full(v: Column) -> Column:
    return F.filter(v, lambda x: x.isNotNull())


def total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda s, x: s + x)


def mean(v: Column) -> Column:
    return F.try_divide(total(v), F.size(v))


def vec_basic(df: DataFrame, key: str, col: str, level: float, k: int = 3) -> DataFrame:
    """sum, product, mean, min, max, their places (from 1), full entries, first entries and counts beyond a level, k-th least."""
    v = full(F.col(col).cast("array<double>"))
    return df.select(
        key, F.round(total(v), 6).alias("sum"), (F.round(F.aggregate(v, F.lit(1.0), lambda s, x: s * x / 100), 6) + 0.0).alias("product"), F.round(mean(v), 6).alias("mean"),
        F.array_min(v).alias("min"), F.array_max(v).alias("max"), F.array_position(v, F.array_min(v)).alias("argmin"), F.array_position(v, F.array_max(v)).alias("argmax"),
        F.size(v).alias("n_full"), F.get(v, 0).alias("first"), F.get(F.filter(v, lambda x: x >= level), 0).alias("first_ge"), F.get(F.filter(v, lambda x: x <= -level), 0).alias("first_le"),
        F.size(F.filter(v, lambda x: x >= level)).alias("n_ge"), F.size(F.filter(v, lambda x: x <= -level)).alias("n_le"), F.get(F.array_sort(v), k - 1).alias("kth"),
    )


def _sd(v: Column) -> Column:
    """Population standard deviation of full entries."""
    return let(mean(v), lambda m: F.sqrt(mean(F.transform(v, lambda x: (x - m) * (x - m)))))


def vec_spread(df: DataFrame, key: str, col: str, q: float = 0.25) -> DataFrame:
    """Population standard deviation, standard error, median absolute deviation, upper and true median, quantile by index."""
    v = full(F.col(col).cast("array<double>"))
    s, n = F.array_sort(v), F.size(v)
    upper = lambda a: F.get(a, F.floor(F.size(a) / 2).cast("int"))
    mad = let(upper(s), lambda u: upper(F.array_sort(F.transform(v, lambda x: F.abs(x - u)))))
    lower = F.get(s, F.floor((n - 1) / 2).cast("int"))
    return df.select(key, F.round(_sd(v), 6).alias("sd"), F.round(_sd(v) / F.sqrt(n), 6).alias("se"), F.round(mad, 6).alias("mad"), upper(s).alias("upper_median"), F.round((upper(s) + lower) / 2, 6).alias("median"), F.get(s, F.floor(q * (n - 1)).cast("int")).alias("quantile"))


def zscores(v: Column) -> Column:
    v = v.cast("array<double>")
    moments = F.struct(mean(full(v)).alias("m"), _sd(full(v)).alias("sd"))
    return let(moments, lambda t: F.transform(v, lambda x: F.when(t["sd"] > 0, (x - t["m"]) / t["sd"])))


def vec_center(df: DataFrame, key: str, col: str) -> DataFrame:
    return df.select(key, zscores(F.col(col)).alias("z"))


def pearson(x: Column, y: Column) -> Column:
    pairs = F.filter(F.zip_with(x.cast("array<double>"), y.cast("array<double>"), lambda a, b: F.when(a.isNotNull() & b.isNotNull(), F.struct(a.alias("a"), b.alias("b")))), lambda p: p.isNotNull())
    s = F.aggregate(
        pairs,
        F.struct(*[F.lit(0.0).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")]),
        lambda s, p: F.struct((s["n"] + 1).alias("n"), (s["x"] + p["a"]).alias("x"), (s["y"] + p["b"]).alias("y"), (s["xx"] + p["a"] * p["a"]).alias("xx"), (s["yy"] + p["b"] * p["b"]).alias("yy"), (s["xy"] + p["a"] * p["b"]).alias("xy")),
    )
    one = F.array(s)
    return F.transform(one, lambda t: F.try_divide(t["n"] * t["xy"] - t["x"] * t["y"], F.sqrt((t["n"] * t["xx"] - t["x"] * t["x"]) * (t["n"] * t["yy"] - t["y"] * t["y"]))))[0]


def dot(x: Column, y: Column) -> Column:
    return total(F.zip_with(x.cast("array<double>"), y.cast("array<double>"), lambda a, b: F.coalesce(a * b, F.lit(0.0))))


def vec_similarity(df: DataFrame, key: str, x: str, y: str, offsets: int = 3) -> DataFrame:
    """Pearson over complete pairs, dot product, dot over the sum of |x|, mean product, best dot over small shifts of y."""
    a, b = F.col(x).cast("array<double>"), F.col(y).cast("array<double>")
    d = dot(a, b)
    shifts = [dot(a, F.slice(b, k + 1, F.size(b))) for k in range(offsets + 1)]
    return df.select(key, F.round(pearson(a, b), 6).alias("pearson"), F.round(d, 6).alias("dot"), F.round(F.try_divide(d, total(F.transform(a, lambda v: F.abs(v)))), 6).alias("dot_l1"), F.round(F.try_divide(d, F.size(a)), 6).alias("mean_product"), F.round(F.greatest(*shifts), 6).alias("best_dot"))


def vec_information(df: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """Per key: entropy of x (bits), mutual information of x and y (nats), symmetric Kullback-Leibler of their values."""
    joint = df.groupBy(key, x, y).agg(F.count("*").alias("n"))
    marg = lambda c: joint.groupBy(key, F.col(c).cast("string").alias("value")).agg(F.sum("n").alias("m"))
    total_ = joint.groupBy(key).agg(F.sum("n").alias("t"))
    h = marg(x).join(total_, key).groupBy(key).agg(F.round(-F.sum(F.col("m") / F.col("t") * F.log2(F.col("m") / F.col("t"))), 6).alias("entropy"))
    px, py = marg(x).select(key, F.col("value").alias("vx"), F.col("m").alias("mx")), marg(y).select(key, F.col("value").alias("vy"), F.col("m").alias("my"))
    j = joint.select(key, F.col(x).cast("string").alias("vx"), F.col(y).cast("string").alias("vy"), "n").join(px, [key, "vx"]).join(py, [key, "vy"]).join(total_, key)
    mi = j.groupBy(key).agg(F.round(F.sum(F.col("n") / F.col("t") * F.ln(F.col("n") * F.col("t") / (F.col("mx") * F.col("my")))), 6).alias("mutual"))
    both = marg(x).withColumnRenamed("m", "a").join(marg(y).withColumnRenamed("m", "b"), [key, "value"]).join(total_, key)
    p, q = F.col("a") / F.col("t"), F.col("b") / F.col("t")
    kl = both.groupBy(key).agg(F.round(F.sum((p - q) * F.ln(p / q)), 6).alias("kl"))
    return h.join(mi, key).join(kl, key, "left")


def vec_sets(df: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """Common and all values of two arrays (sorted), how often each value of x stands there (``value:count``), and the most common one."""
    each = lambda v: F.size(F.filter(x, lambda w: w == v))
    counts = F.transform(F.array_distinct(x), each)
    listed = F.array_join(F.transform(F.array_sort(F.array_distinct(x)), lambda v: F.concat_ws(":", v, each(v))), ",")
    return df.select(key, F.array_join(F.array_sort(F.array_intersect(x, y)), ",").alias("common"), F.array_join(F.array_sort(F.array_union(x, y)), ",").alias("all"), listed.alias("counts"), F.coalesce(F.array_max(counts), F.lit(0)).alias("most"))


def ratio_to_first(df: DataFrame, key: str, col: str, c: float = 1.0) -> DataFrame:
    """log2((x + c) / (first + c)) of every entry."""
    v = F.col(col).cast("array<double>")
    return df.select(key, F.transform(v, lambda x: F.log2((x + c) / (F.get(v, 0) + c))).alias("ratio"))
