"""Tests, corrections, differential expression and enrichment as column expressions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from strandloom.functions.scratch import result, scope, table
from strandloom.functions.seq import let
from strandloom.operators.order import kendall, placed, quantiles, ranked
from strandloom.operators.table import numbered


def ln_factorial(i: Column) -> Column:
    """ln(i!) of a whole number: exact below 16, then Stirling's series of ln(gamma(i + 1))."""
    x = i.cast("double") + 1
    few = F.get(F.array(*[F.lit(math.lgamma(k + 1)) for k in range(16)]), F.least(i, F.lit(15)).cast("int"))
    return F.when(i < 16, few).otherwise((x - 0.5) * F.ln(x) - x + math.log(2 * math.pi) / 2 + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x) - 1 / (1680 * x * x * x * x * x * x * x))


def _tail(terms: Column) -> Column:
    """Sum of exp over an array of logarithms, without overflow; at most 1."""
    return F.when(F.size(terms) == 0, 0.0).otherwise(let(F.array_max(terms), lambda m: F.least(F.lit(1.0), F.exp(m) * F.aggregate(F.transform(terms, lambda t: F.exp(t - m)), F.lit(0.0), lambda s, x: s + x))))


def _choose(n: Column, k: Column) -> Column:
    return ln_factorial(n) - ln_factorial(k) - ln_factorial(n - k)


def _near(first: Column, last: Column, n: Column, rate: Column) -> Column:
    """The whole numbers from ``first`` to ``last`` whose chance among n draws at a rate, with or without replacement, can differ from 0 in doubles.

    By Bernstein's bound a number further than d from the mean m has less than exp(-d^2 / (2 (m (1 - rate) + d / 3))), which is under
    the least double (exp(-745)) for this d; so the sum of them all is the same, and there are about sqrt(m) of them.
    """
    mean, third = n * rate, 760 / 3
    d = third + F.sqrt(F.greatest(F.lit(0.0), mean * (1 - rate)) * (2 * 760.0) + third * third)
    low, high = F.greatest(first, F.floor(mean - d)), F.least(last, F.ceil(mean + d))
    return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))


def binomial_tail(df: DataFrame, n: str, r: str, p: float | Column) -> DataFrame:
    """P(X >= r) of n trials at rate p, a number or a column between 0 and 1 (neither)."""
    rate = F.lit(p)
    term = lambda i: _choose(F.col(n), i) + i * F.ln(rate) + (F.col(n) - i) * F.ln(1 - rate)
    terms = F.when(F.col(r) <= F.col(n), F.transform(_near(F.col(r).cast("long"), F.col(n).cast("long"), F.col(n), rate), term)).otherwise(F.array().cast("array<double>"))
    return df.withColumn("p", F.when(F.col(r) <= 0, 1.0).otherwise(_tail(terms)))


def hypergeom_tail(df: DataFrame, k: str, n: str, big_k: str, big_n: str) -> DataFrame:
    """P(X >= k) drawing n of big_n with big_k good ones; 1 where k is below expectation."""
    c = F.col
    term = lambda i: _choose(c(big_k), i) + _choose(c(big_n) - c(big_k), c(n) - i) - _choose(c(big_n), c(n))
    top = F.least(c(n), c(big_k))
    terms = F.when(c(k) <= top, F.transform(_near(F.greatest(c(k), c(n) - (c(big_n) - c(big_k))).cast("long"), top.cast("long"), c(n), c(big_k) / c(big_n)), term)).otherwise(F.array().cast("array<double>"))
    return df.withColumn("p", F.when(c(k) * c(big_n) < c(n) * c(big_k), 1.0).otherwise(_tail(terms)))


def normal_tail(z: Column) -> Column:
    """P(Z > |z|) by the rational approximation with an error below 1.5e-7."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    # fixed values: coefficients of the approximation
    t = 1.0 / (1.0 + 0.3275911 * x)
    poly = ((((1.061405429 * t - 1.453152027) * t + 1.421413741) * t - 0.284496736) * t + 0.254829592) * t
    return 0.5 * poly * F.exp(-x * x)


def _beta_tail(t: np.ndarray, dof: np.ndarray) -> np.ndarray:
    """Two-sided p of Student's t: the incomplete beta function by its continued fraction."""
    x = dof / (dof + t * t)
    a, b = dof / 2, np.full_like(dof, 0.5)
    from math import lgamma

    lg = np.vectorize(lgamma)
    front = np.exp(lg(a + b) - lg(a) - lg(b) + a * np.log(np.maximum(x, 1e-300)) + b * np.log(np.maximum(1 - x, 1e-300)))
    flip = x >= (a + 1) / (a + b + 2)
    u, v, y = np.where(flip, b, a), np.where(flip, a, b), np.where(flip, 1 - x, x)
    c, d = np.ones_like(y), 1 / np.where(np.abs(1 - (u + v) * y / (u + 1)) < 1e-30, 1e-30, 1 - (u + v) * y / (u + 1))
    h = d.copy()
    for m in range(1, 300):
        for num in (m * (v - m) * y / ((u + 2 * m - 1) * (u + 2 * m)), -(u + m) * (u + v + m) * y / ((u + 2 * m) * (u + 2 * m + 1))):
            d = 1 / np.where(np.abs(1 + num * d) < 1e-30, 1e-30, 1 + num * d)
            c = np.where(np.abs(1 + num / c) < 1e-30, 1e-30, 1 + num / c)
            h = h * d * c
    got = front * h / u
    return np.where(flip, 1 - got, got)


@F.pandas_udf(DoubleType())
def t_tail(t: pd.Series, dof: pd.Series) -> pd.Series:
    ok = t.notna() & dof.notna()
    out = np.full(len(t), np.nan)
    if ok.any():
        out[ok] = _beta_tail(t[ok].to_numpy(float), dof[ok].to_numpy(float))
    return pd.Series(out)


def t_test(df: DataFrame, key: str, group: str, a: str, b: str, value: str) -> DataFrame:
    """Welch's statistic, its degrees of freedom and two-sided p per key."""
    g = lambda x: F.when(F.col(group) == x, F.col(value))
    m = df.groupBy(key).agg(*[f(g(x)).alias(n + str(i)) for i, x in enumerate((a, b)) for f, n in ((F.count, "n"), (F.avg, "m"), (F.var_samp, "v"))])
    s0, s1 = F.col("v0") / F.col("n0"), F.col("v1") / F.col("n1")
    m = m.where("n0 > 1 and n1 > 1").withColumn("t", F.try_divide(F.col("m0") - F.col("m1"), F.sqrt(s0 + s1)))
    m = m.withColumn("dof", F.try_divide((s0 + s1) * (s0 + s1), s0 * s0 / (F.col("n0") - 1) + s1 * s1 / (F.col("n1") - 1)))
    return m.select(key, F.round("t", 6).alias("t"), F.round("dof", 6).alias("dof"), F.round(t_tail("t", "dof"), 6).alias("p"))


def rank_sum(df: DataFrame, key: str, group: str, a: str, b: str, value: str) -> DataFrame:
    """Mean ranks of ties, the rank sum of group a, U / (n m), z and two-sided p of the normal approximation."""
    d = df.where(F.col(group).isin(a, b))
    w = Window.partitionBy(key)
    r = F.rank().over(w.orderBy(value)) + (F.count("*").over(Window.partitionBy(key, value)) - 1) / 2
    s = d.withColumn("r", r).groupBy(key).agg(F.sum(F.when(F.col(group) == a, F.col("r"))).alias("w"), F.count_if(F.col(group) == a).alias("n"), F.count_if(F.col(group) == b).alias("m")).where("n > 0 and m > 0")
    n, m = F.col("n"), F.col("m")
    z = (F.col("w") - n * (n + m + 1) / 2) / F.sqrt(n * m * (n + m + 1) / 12.0)
    return s.select(key, F.col("w").alias("w"), F.round((F.col("w") - n * (n + 1) / 2) / (n * m), 6).alias("u"), F.round(z, 6).alias("z"), F.round(2 * normal_tail(z), 6).alias("p"))


def ks_test(df: DataFrame, key: str, group: str, a: str, b: str, value: str, terms: int = 20) -> DataFrame:
    """Largest distance of two cumulative distributions per key, and its probability."""
    d = df.where(F.col(group).isin(a, b)).groupBy(key, value).agg(F.count_if(F.col(group) == a).alias("x"), F.count_if(F.col(group) == b).alias("y"))
    up, all_ = Window.partitionBy(key).orderBy(value), Window.partitionBy(key)
    d = d.select(key, (F.sum("x").over(up) / F.sum("x").over(all_)).alias("fx"), (F.sum("y").over(up) / F.sum("y").over(all_)).alias("fy"), F.sum("x").over(all_).alias("n"), F.sum("y").over(all_).alias("m"))
    s = d.where("n > 0 and m > 0").groupBy(key).agg(F.max(F.abs(F.col("fx") - F.col("fy"))).alias("d"), F.first("n").alias("n"), F.first("m").alias("m"))
    en = F.sqrt(F.col("n") * F.col("m") / (F.col("n") + F.col("m")))
    lam = (en + 0.12 + 0.11 / en) * F.col("d")
    series = sum((((-1.0) ** (j - 1)) * F.exp(-2.0 * j * j * lam * lam) for j in range(1, terms + 1)), F.lit(0.0))
    return s.select(key, F.round("d", 6).alias("d"), F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * series)), 6).alias("p"))


def fisher_z(df: DataFrame, r: str, n: str) -> DataFrame:
    z = 0.5 * (F.ln(1 + F.col(r)) - F.ln(1 - F.col(r)))
    return df.withColumn("z", z).withColumn("score", z * F.sqrt(F.col(n) - 3))


def _harmonic(m: Column) -> Column:
    """1 + 1/2 + ... + 1/m: summed up to 64, then by its asymptotic series (error below 1e-15)."""
    few = F.aggregate(F.sequence(F.lit(1), F.least(m, F.lit(64)).cast("int")), F.lit(0.0), lambda s, k: s + 1.0 / k)
    x = m.cast("double")
    return F.when(m <= 64, few).otherwise(F.ln(x) + 0.5772156649015329 + 1 / (2 * x) - 1 / (12 * x * x) + 1 / (120 * x * x * x * x))


def padjust(df: DataFrame, p: str, method: str = "BH", key: list[str] = (), tie: list[str] = ()) -> DataFrame:
    """Adjusted p (``q``) per key: BH, BY, bonferroni, holm, hochberg, QVALUE or none.

    QVALUE is BH times the share of true nulls, (1 + number of p over 0.5) / (m / 2), at most 1.
    Without a key rows are ranked by ranges of p (see ``numbered``); a range's running extreme begins with that of the ranges
    beyond it, so no task sees all rows.
    """
    x, m, i = F.col(p), F.col("__m"), F.col("__i")
    value, fold = {
        "BH": (x * m / i, "min"), "QVALUE": (x * m / i * F.least(F.lit(1.0), (1 + F.col("__high")) / (m / 2)), "min"), "BY": (x * m / i * _harmonic(m), "min"), "bonferroni": (x * m, None),
        "holm": (x * (m - i + 1), "max"), "hochberg": (x * (m - i + 1), "min"), "none": (x, None),
    }[method]
    high = F.count_if(x > 0.5)
    if key:
        w = Window.partitionBy(*key)
        d, part = df.withColumn("__m", F.count("*").over(w)).withColumn("__high", high.over(w)).withColumn("__i", F.row_number().over(w.orderBy(p, *tie))), list(key)
    else:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        d = numbered(df, [p, *tie], "__i").crossJoin(F.broadcast(df.agg(F.count("*").alias("__m"), high.alias("__high")))).withColumn("__part", F.floor((i - 1) * parts / m))
        part = ["__part"]
    d = d.withColumn("__v", value)
    if fold is None:
        return d.withColumn("q", F.least(F.lit(1.0), F.col("__v"))).drop("__m", "__high", "__i", "__v", *(part if not key else []))
    f, order = (F.min, F.desc) if fold == "min" else (F.max, F.asc)
    q = f("__v").over(Window.partitionBy(*part).orderBy(order("__i")).rowsBetween(Window.unboundedPreceding, 0))
    d = d.withColumn("q", q)
    if not key:
        w = Window.orderBy(order("__part")).rowsBetween(Window.unboundedPreceding, -1)
        beyond = d.groupBy("__part").agg(f("__v").alias("__t")).select("__part", f("__t").over(w).alias("__beyond"))
        d = d.join(F.broadcast(beyond), "__part").withColumn("q", (F.least if fold == "min" else F.greatest)("q", "__beyond")).drop("__part", "__beyond")
    return d.withColumn("q", F.least(F.lit(1.0), F.col("q"))).drop("__m", "__high", "__i", "__v")


def fdr_threshold(df: DataFrame, p: str, alpha: float, key: list[str]) -> DataFrame:
    """The largest p with p m / rank at most alpha (0 if none)."""
    w = Window.partitionBy(*key)
    d = df.withColumn("__m", F.count("*").over(w)).withColumn("__i", F.rank().over(w.orderBy(p)))
    return d.groupBy(*key).agg(F.coalesce(F.max(F.when(F.col(p) * F.col("__m") / F.col("__i") <= alpha, F.col(p))), F.lit(0.0)).alias("threshold"))


def size_factors(long: DataFrame) -> DataFrame:
    """Median-of-ratios factor of each sample, over ids with counts in all samples. long: id, sample, value.

    The median is exact, by ranges of the order of all ratios: no task holds a sample.
    """
    samples = long.agg(F.countDistinct("sample").alias("s"))
    logs = long.where("value > 0").groupBy("id").agg(F.avg(F.ln("value")).alias("g"), F.countDistinct("sample").alias("k"))
    ok = logs.crossJoin(F.broadcast(samples)).where("k = s").select("id", "g")
    ratios = long.join(ok, "id").select("sample", F.exp(F.ln("value") - F.col("g")).alias("ratio"))
    return quantiles(ratios, ["sample"], "ratio", {"factor": 0.5}).select("sample", F.round("factor", 6).alias("factor"))


def tmm_factors(long: DataFrame, reference: str, trim: float = 0.3) -> DataFrame:
    """Trimmed weighted mean of log ratios to a reference sample, as factors of the library sizes."""
    lib = long.groupBy("sample").agg(F.sum("value").alias("lib"))
    x = long.join(F.broadcast(lib), "sample").where("value > 0")
    ref = x.where(F.col("sample") == reference).select("id", F.col("value").alias("rv"), F.col("lib").alias("rl"))
    j = x.join(ref, "id").withColumn("m", F.log2((F.col("value") / F.col("lib")) / (F.col("rv") / F.col("rl"))))
    j = j.withColumn("w", 1 / ((F.col("lib") - F.col("value")) / (F.col("lib") * F.col("value")) + (F.col("rl") - F.col("rv")) / (F.col("rl") * F.col("rv"))))
    with scope(long.sparkSession):
        j = placed(table(j.select("id", "sample", "m", "w"), "ratios"), ["sample"], ["m", "id"], "r", "c")
        kept = j.where((F.col("r") > F.floor(F.col("c") * trim)) & (F.col("r") <= F.col("c") - F.floor(F.col("c") * trim)))
        mean = F.sum(F.col("w") * F.col("m")) / F.sum("w")
        return result(kept.groupBy("sample").agg(F.round(F.pow(F.lit(2.0), mean), 6).alias("factor")), "factors")


def de_no_replicates(long: DataFrame, a: str, b: str, q: float = 0.01, fc: float = 2.0) -> DataFrame:
    """Two samples: M and A, the z of M given A under binomial sampling, p, and BH-adjusted p (in place of Storey's)."""
    g = long.groupBy("id").agg(*[F.coalesce(F.sum(F.when(F.col("sample") == s, F.col("value"))), F.lit(0)).alias(n) for s, n in ((a, "x"), (b, "y"))]).where("x > 0 and y > 0")
    t = g.agg(F.sum("x").alias("nx"), F.sum("y").alias("ny"))
    g = g.crossJoin(F.broadcast(t))
    m = F.log2(F.col("x") / F.col("nx")) - F.log2(F.col("y") / F.col("ny"))
    total = F.col("x") + F.col("y")
    share = F.col("nx") / (F.col("nx") + F.col("ny"))
    z = (F.col("x") - total * share) / F.sqrt(total * share * (1 - share))
    g = g.select("id", F.round(m, 6).alias("m"), F.round((F.log2("x") + F.log2("y")) / 2, 6).alias("a"), F.round(z, 6).alias("z")).withColumn("p", F.round(2 * normal_tail(F.col("z")), 6))
    with scope(long.sparkSession):
        out = padjust(table(g, "tested"), "p", "BH", tie=["id"])  # it reads them several times
        called = (F.abs("m") > float(np.log2(fc))) & (F.col("q") < q)
        return result(out.withColumn("q", F.round("q", 6)).withColumn("significant", called), "de")


def volcano_class(de: DataFrame, fc: float = 1.0) -> DataFrame:
    return de.withColumn("class", F.when(F.col("significant") & (F.col("m") > 0), "up").when(F.col("significant") & (F.col("m") < 0), "down").otherwise("false"))


def de_replicates(long: DataFrame, treat: list[str], control: list[str]) -> DataFrame:
    """Normalised group means, log2 fold change, a moment estimate of dispersion and Wald's p (no shrinkage)."""
    f = long.join(F.broadcast(size_factors(long)), "sample").withColumn("v", F.col("value") / F.col("factor"))
    g = lambda s: F.when(F.col("sample").isin(s), F.col("v"))
    d = f.groupBy("id").agg(F.avg(g(treat)).alias("mt"), F.avg(g(control)).alias("mc"), F.avg("v").alias("m"), F.var_samp("v").alias("var"))
    disp = F.greatest((F.col("var") - F.col("m")) / (F.col("m") * F.col("m")), F.lit(1e-8))
    lfc = F.log2((F.col("mt") + 0.5) / (F.col("mc") + 0.5))
    se = F.sqrt((1 / F.col("mt") + disp) / len(treat) + (1 / F.col("mc") + disp) / len(control)) / float(np.log(2))
    return d.where("mt > 0 and mc > 0").select("id", F.round("mt", 4).alias("treat"), F.round("mc", 4).alias("control"), F.round(lfc, 4).alias("lfc"), F.round(disp, 6).alias("dispersion"), F.round(2 * normal_tail(lfc / se), 6).alias("p"))


def de_call_padj(de: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Rows of ``de_replicates`` with adjusted p (BH) below alpha, and their direction."""
    return padjust(de, "p", "BH", tie=["id"]).where(F.col("q") < alpha).withColumn("direction", F.when(F.col("lfc") > 0, "up").otherwise("down"))


def _sample_pairs(long: DataFrame, *cols: str) -> DataFrame:
    """Ids that two samples share: a < b, and each column of either sample with its letter."""
    side = lambda n: long.select("id", F.col("sample").alias(n), *[F.col(c).alias(c + n) for c in cols])
    return side("a").join(side("b"), "id").where("a < b")


def sample_correlation(long: DataFrame) -> DataFrame:
    """All sample pairs on log10(x + 1): squared Pearson, Spearman, intercept and slope.

    Mean ranks come from ranges of the order of all values: no task holds a sample.
    """
    with scope(long.sparkSession):
        ranks = ranked(long, ["sample"], "value").select("sample", "value", (F.col("below") + (F.col("n") + 1) / 2).alias("r"))
        x = table(long.join(ranks, ["sample", "value"], "left").select("id", "sample", "r", F.log10(F.col("value") + 1).alias("l")), "ranks")
        r2, spearman = F.pow(F.corr("la", "lb"), F.lit(2)), F.corr("ra", "rb")
        lines = F.regr_slope("lb", "la"), F.regr_intercept("lb", "la")
        named = zip((r2, spearman, *lines), ("r2", "spearman", "slope", "intercept"), strict=True)
        return result(_sample_pairs(x, "l", "r").groupBy("a", "b").agg(*[F.round(c, 4).alias(n) for c, n in named]), "correlations")


def sample_kendall(long: DataFrame) -> DataFrame:
    """Kendall's tau-b of all sample pairs over the ids that both have: a, b, points, tau."""
    return kendall(_sample_pairs(long, "value"), ["a", "b"], "valuea", "valueb").withColumn("tau", F.round("tau", 6))


def zscale_rows(long: DataFrame, key: str, value: str) -> DataFrame:
    w = Window.partitionBy(key)
    return long.withColumn("z", F.round(F.try_divide(F.col(value) - F.avg(value).over(w), F.stddev_samp(value).over(w)), 6))


def cluster_expression(vectors: DataFrame, key: str, col: str, ks: tuple[int, ...] = (4, 8), seed: int = 1) -> DataFrame:
    """Clusters of profiles by k-means, the k with the best silhouette."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector

    data = vectors.select(key, array_to_vector(F.col(col).cast("array<double>")).alias("features")).persist()
    fits = [KMeans(k=k, seed=seed, maxIter=10).fit(data) for k in ks]
    rated = [(ClusteringEvaluator().evaluate(f.transform(data)), -i, f) for i, f in enumerate(fits)]
    best = max(rated, key=lambda x: x[:2])[2]
    data.unpersist()
    return best.transform(data).select(key, F.col("prediction").alias("cluster"))


def go_closure(gene2go: DataFrame, edges: DataFrame) -> DataFrame:
    """gene with all its terms and their ancestors. gene2go: gene, term; edges: child, parent.

    Ancestors one step further up are joined until there is no new one, however deep (or circular) the edges are.
    """
    with scope(gene2go.sparkSession):
        up = table(edges.select("child", "parent").distinct(), "edges")
        step = table(up.select(F.col("child").alias("term"), F.col("child").alias("anc")).union(up.select("parent", "parent")).distinct(), "closure")
        known = step
        while True:
            more = step.join(up, step.anc == up.child).select("term", F.col("parent").alias("anc")).distinct()
            step = table(more.join(known, ["term", "anc"], "left_anti"), "closure")
            if step.isEmpty():
                break
            known = known.union(step)
        j = gene2go.join(known, "term", "left")
        return result(j.select("gene", F.coalesce("anc", "term").alias("term")).distinct(), "closure")


def _hits(closure: DataFrame, foreground: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per term its genes of the foreground (k) and all (big_k); one row with n, the foreground's genes that have a term."""
    fg = foreground.select("gene").distinct().join(closure.select("gene").distinct(), "gene", "left_semi").withColumn("fg", F.lit(1))
    by = closure.select("gene", "term").distinct().join(fg, "gene", "left").groupBy("term").agg(F.count("fg").alias("k"), F.count("*").alias("big_k"))
    return by, fg.agg(F.count("*").alias("n"))


def enrich(closure: DataFrame, foreground: DataFrame, least: int = 1, method: str = "BH", test: str = "h", cutoff: int = 1) -> DataFrame:
    """Per term: foreground hits, foreground, background hits, background, p and adjusted p.

    closure: gene, term; foreground: gene. ``test``: h, the hypergeometric tail; b, the binomial tail at the background's rate;
    c, chi-square of the foreground against the rest of the background, one degree of freedom and no continuity correction (1
    where a margin is empty). Terms count with ``least`` genes in the foreground and ``cutoff`` in the background. A p of zero
    becomes the least positive one / 10000.
    """
    by, n = _hits(closure, foreground)
    bg = closure.agg(F.countDistinct("gene").alias("big_n"))
    d = by.where((F.col("k") >= least) & (F.col("big_k") >= cutoff)).crossJoin(F.broadcast(bg)).crossJoin(F.broadcast(n))
    k, n_, big_k, big_n = (F.col(c) for c in ("k", "n", "big_k", "big_n"))
    if test == "h":
        p = hypergeom_tail(d, "k", "n", "big_k", "big_n")
    elif test == "b":
        p = binomial_tail(d, "n", "k", big_k / big_n).withColumn("p", F.when(big_k == big_n, 1.0).otherwise(F.col("p")))
    elif test == "c":
        apart = (k * (big_n - n_ - big_k + k) - (n_ - k) * (big_k - k)).cast("double")
        chi = F.try_divide(apart * apart * big_n, n_.cast("double") * (big_n - n_) * big_k * (big_n - big_k))
        p = d.withColumn("p", F.coalesce(2 * normal_tail(F.sqrt(chi)), F.lit(1.0)))
    else:
        raise ValueError(f"test {test!r} is none of h, b, c")
    with scope(closure.sparkSession):
        p = table(p, "tested")  # ranks, their sums and the least p all read it
        floor = p.agg((F.min(F.when(F.col("p") > 0, F.col("p"))) / 10000).alias("__floor"))
        p = p.crossJoin(F.broadcast(floor)).withColumn("p", F.when(F.col("p") == 0, F.coalesce("__floor", F.lit(0.0))).otherwise(F.col("p"))).drop("__floor")
        return result(padjust(p, "p", method, tie=["term"]).select("term", "k", "n", "big_k", "big_n", "p", "q"), "enriched")


def frequency_list(closure: DataFrame, foreground: DataFrame) -> DataFrame:
    """Per term of the foreground: its genes there and their share of the foreground's genes with a term; no test."""
    by, n = _hits(closure, foreground)
    return by.where("k > 0").crossJoin(F.broadcast(n)).select("term", "k", (F.col("k") / F.col("n")).alias("share"))


def term_genes(closure: DataFrame, foreground: DataFrame) -> DataFrame:
    """The foreground's genes of every term, a row each: term, gene."""
    return closure.select("term", "gene").distinct().join(foreground.select("gene").distinct(), "gene", "left_semi").select("term", "gene")


def expr_pattern_pairs(a: DataFrame, b: DataFrame, least_change: float, least_r: float) -> DataFrame:
    """Pairs of series (id, x) of one length that change enough and correlate.

    Of series scaled to mean 0 and norm 1, those with r >= t lie within sqrt(2 (1 - t)), and so do their first three cosine
    coefficients: series meet in grid cells of that width and the cells around. Series with gaps (null) have no such bound
    and meet all of their length.
    """
    from strandloom.operators.vectors import pearson

    x, n = F.col("x"), F.size("x")
    wide = math.sqrt(2 * max(0.0, 1 - least_r + 5e-5)) * (1 + 1e-6) + 1e-6  # r is rounded to 4 digits
    add = lambda c: F.aggregate(c, F.lit(0.0), lambda s, q: s + q)

    def ready(df, p):
        moved = df.select("id", x.cast("array<double>").alias("x")).where(F.array_max(x) - F.array_min(x) >= least_change)
        moved = moved.withColumn("gaps", F.exists(x, lambda q: q.isNull())).withColumn("norm", let(add(x) / n, lambda m: F.sqrt(add(F.transform(x, lambda q: (q - m) * (q - m))))))
        wave = lambda k: F.sqrt(2 / n) * add(F.transform(x, lambda q, i: q * F.cos(math.pi * k * (i + 0.5) / n)))
        cell = lambda k: F.floor(F.try_divide(wave(k), F.col("norm")) / wide)
        return moved.select(F.col("id").alias(p), x.alias("x" + p), n.alias("n"), "gaps", *[cell(k).alias(f"c{k}") for k in (1, 2, 3)])

    def near(df):
        for k in (1, 2, 3):
            df = df.withColumn(f"c{k}", F.explode(F.sequence(F.col(f"c{k}") - 1, F.col(f"c{k}") + 1)))
        return df

    def against_all(gaps, rest, p, deal=64):
        """Pairs of few series and all of a length, dealt out by the rest's ids."""
        q = rest.withColumn("deal", F.pmod(F.xxhash64(p), F.lit(deal)).cast("int"))
        return gaps.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(deal - 1)))).join(q, ["n", "deal"]).select("a", "xa", "b", "xb")

    cols = ["n", "c1", "c2", "c3"]
    l, r = ready(a, "a"), ready(b, "b")
    whole = l.where("not gaps").drop("gaps").join(near(r.where("not gaps").drop("gaps")), cols).select("a", "xa", "b", "xb")
    bare = lambda df: df.drop("gaps", *cols[1:])
    j = whole.union(against_all(bare(l.where("gaps")), bare(r), "b")).union(against_all(bare(r.where("gaps")), bare(l.where("not gaps")), "a")).where("a <> b")
    return j.withColumn("r", F.round(pearson(F.col("xa"), F.col("xb")), 4)).where((F.col("r") >= least_r) & ~F.isnan("r")).select("a", "b", "r")
