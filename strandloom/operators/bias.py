"""Enrichment with odds by gene length: monotone weights, then Wallenius' non-central tail or seeded resampling."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from strandloom.functions.scratch import result, scope, table
from strandloom.operators.order import placed
from strandloom.operators.stats import padjust


def monotone(bins: DataFrame, order: str, n: str, hits: str, name: str = "rate") -> DataFrame:
    """bins with the hit rate that least squares allow if rates must not fall (or not rise) along ``order``.

    The fit that pooling neighbours gives, written as its formula: the largest, over starts at or before a bin, of the least
    mean over ends at or after it. Rates rise where the upper half of the bins has the higher rate, else they fall. A rate of 0
    becomes the least one above 0. The bins go into one row of arrays, so their number must be bounded by a parameter.
    """
    rows = bins.groupBy().agg(F.sort_array(F.collect_list(F.struct(order, n, hits))).alias("__b"))

    def sums(c: str):
        plus = F.transform("__b", lambda b: b[c].cast("double"))
        return F.transform(F.sequence(F.lit(0), F.size("__b")), lambda i: F.aggregate(F.slice(plus, 1, i), F.lit(0.0), lambda s, v: s + v))

    rows = rows.where(F.size("__b") > 0).withColumns({"__n": sums(n), "__h": sums(hits), "__m": F.size("__b")})
    mean = lambda a, b: (F.get("__h", b + 1) - F.get("__h", a)) / (F.get("__n", b + 1) - F.get("__n", a))
    half = F.floor(F.col("__m") / 2).cast("int")
    rises = F.when(half > 0, mean(half, F.col("__m") - 1) >= mean(F.lit(0), half - 1)).otherwise(True)
    to, end = lambda i: F.sequence(F.lit(0), i), lambda i: F.sequence(i, F.col("__m") - 1)
    up = F.transform(to(F.col("__m") - 1), lambda i: F.array_max(F.transform(to(i), lambda a: F.array_min(F.transform(end(i), lambda b: mean(a, b))))))
    down = F.transform(to(F.col("__m") - 1), lambda i: F.array_min(F.transform(to(i), lambda a: F.array_max(F.transform(end(i), lambda b: mean(a, b))))))
    fitted = rows.select("__b", F.when(rises, up).otherwise(down).alias("__r"))
    fitted = fitted.withColumn("__least", F.array_min(F.filter("__r", lambda r: r > 0)))
    each = fitted.select(F.posexplode("__b").alias("__i", "__e"), "__r", "__least")
    rate = F.get("__r", F.col("__i"))
    return each.select(F.col("__e")[order].alias(order), F.col("__e")[n].alias(n), F.col("__e")[hits].alias(hits), F.when(rate > 0, rate).otherwise(F.col("__least")).alias(name))


def _wallenius_log(x: np.ndarray, m1: float, m2: float, n: float, odds: float, nodes: int = 256) -> np.ndarray:
    """ln P(X = x) for x of m1 good and n - x of m2 other ones taken one by one at the given odds.

    The integral runs over v = ln(-ln r) of the usual variable r. There its logarithm is concave, falls at least exponentially
    on either side and is smooth, so the trapezoidal rule around the peak (found by halving) needs few nodes.
    """
    ln_choose = lambda a, b: math.lgamma(a + 1) - math.lgamma(b + 1) - math.lgamma(a - b + 1)
    front = np.array([ln_choose(m1, k) + ln_choose(m2, n - k) for k in x])
    d = odds * (m1 - x) + (m2 - n + x)
    whole = d <= 0  # everything is taken
    d = np.where(whole, 1.0, d)
    part = lambda s: np.where(s < 1e-12, 1.0, s / np.expm1(np.minimum(s, 700)))
    slope = lambda v: 1 - d * np.exp(v) + x * part(odds * np.exp(v)) + (n - x) * part(np.exp(v))
    lo, hi = np.full(len(x), -60.0), np.full(len(x), 60.0)
    for _ in range(70):
        mid = (lo + hi) / 2
        rising = slope(mid) > 0
        lo, hi = np.where(rising, mid, lo), np.where(rising, hi, mid)
    peak = (lo + hi) / 2
    bend = np.maximum((slope(peak - 1e-4) - slope(peak + 1e-4)) / 2e-4, 1e-12)
    wide = 1 / np.sqrt(bend)
    v = peak[:, None] + wide[:, None] * np.linspace(-26, 9, nodes)
    s = np.exp(v)
    ln1m = lambda q: np.log(-np.expm1(-np.maximum(q, 1e-300)))
    g = v - d[:, None] * s + x[:, None] * ln1m(odds * s) + (n - x)[:, None] * ln1m(s)
    top = g.max(axis=1)
    area = np.log(np.exp(g - top[:, None]).sum(axis=1) * wide * 35 / (nodes - 1)) + top
    return np.where(whole, 0.0, front + np.log(d) + area)


def wallenius_tail(k: int, m1: int, m2: int, n: int, odds: float, step: int = 512) -> float:
    """P(X >= k); summed upwards until the terms, past their largest, no longer count."""
    low, high = max(0, n - m2), min(n, m1)
    if k <= low:
        return 1.0
    total = 0.0
    for start in range(k, high + 1, step):
        x = np.arange(start, min(start + step, high + 1), dtype=float)
        p = np.exp(_wallenius_log(x, float(m1), float(m2), float(n), odds))
        total += float(p.sum())
        if len(p) > 1 and p[-1] < p[-2] and p[-1] < 1e-18 * max(total, 1e-290):
            break
    return min(1.0, total)


@F.pandas_udf(DoubleType())
def _tails(k: pd.Series, m1: pd.Series, m2: pd.Series, n: pd.Series, odds: pd.Series) -> pd.Series:
    return pd.Series([wallenius_tail(int(a), int(b), int(c), int(d), float(e)) for a, b, c, d, e in zip(k, m1, m2, n, odds, strict=True)], dtype=float)


#: Steps of a draw's order, coarse and fine: so many for each power of e (powers of two, so that fine ones divide coarse ones).
STEPS = (8, 512)


def _drawn_terms(links: DataFrame, genes: DataFrame, all_: DataFrame, draws: int, u: Column) -> DataFrame:
    """term, draw, c: the term's genes among the first n (of ``all_``) of each draw's order by -ln(u) / w, then gene. genes: gene, w.

    The orders are cut into steps by the logarithm of that value and the genes of each coarse step counted, then those of the fine steps of
    the coarse one that n falls into. Steps wholly within the first n need no order; only the genes of the fine step that n falls into are
    sorted. A gene's values are made anew from its hash in each pass, and its terms travel with it: no row for a gene and draw is
    written or shuffled but those sorted.
    """
    parts = int(genes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = links.groupBy("gene").agg(F.collect_list("term").alias("terms"))
    rows = table(genes.select("gene", "w").join(packed, "gene").repartition(parts, "gene"), "weighted")
    late = rows.repartition(parts, "gene").withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws)))).withColumn("late", -F.ln(u) / F.col("w"))
    near = late.crossJoin(F.broadcast(all_.select(F.col("n").alias("left"))))
    for k, steps in enumerate(STEPS):
        near = near.withColumn(f"step{k}", F.floor(F.ln("late") * steps))
        counts = near.groupBy("draw", f"step{k}", "left").agg(F.count("*").alias("m"))
        counts = counts.withColumn("upto", F.sum("m").over(Window.partitionBy("draw").orderBy(f"step{k}")))
        last = counts.where((F.col("upto") >= F.col("left")) & (F.col("upto") - F.col("m") < F.col("left")))
        last = table(last.select("draw", F.col(f"step{k}").alias("last"), (F.col("left") - F.col("upto") + F.col("m")).alias("left")), "steps")
        near = late.join(F.broadcast(last), "draw")  # a row a draw
        if k + 1 < len(STEPS):
            near = near.where(F.floor(F.ln("late") * steps) == F.col("last")).drop("last")
    near = near.withColumn("step", F.floor(F.ln("late") * STEPS[-1]))
    within = near.where(F.col("step") < F.col("last")).select("draw", "terms")
    edge = table(near.where(F.col("step") == F.col("last")).select("draw", "late", "gene", "terms", "left"), "edge")
    edge = placed(edge, ["draw"], ["late", "gene"], "place", "of").where(F.col("place") <= F.col("left")).select("draw", "terms")
    return within.unionByName(edge).select("draw", F.explode("terms").alias("term")).groupBy("term", "draw").agg(F.count("*").alias("c"))


def go_enrich_length_bias(closure: DataFrame, foreground: DataFrame, lengths: DataFrame, method: str = "Wallenius", bins: int = 50, draws: int = 2000, seed: int = 1, least: int = 0, adjust: str = "BH") -> DataFrame:
    """Per term: k of its genes in the foreground, big_k genes, odds, p of at least k, and adjusted p.

    closure: gene, term; foreground: gene; lengths: gene, len. The genes are those with a term and a length. They fall into bins of
    equal numbers by length (cuts by an approximate percentile); the monotone rate of foreground genes in a bin is the weight of its
    genes. ``Wallenius``: the non-central tail at the odds of the term's mean weight to the mean weight of the other genes (1 where a term
    has all genes). ``Sampling``: as many genes as the foreground has are drawn ``draws`` times without replacement by weight, and
    p = (1 + draws with at least k) / (draws + 1). A draw is an order of all genes by -ln(u) / weight, u a hash of gene,
    draw and seed, so it is the same on each run; only the genes around the last one drawn are sorted. A p of 0 becomes the least above / 10000.
    Without a foreground gene every p is 1. Terms with fewer than ``least`` genes in the foreground are left out.
    """
    if method not in ("Wallenius", "Sampling"):
        raise ValueError(f"method {method!r} is neither Wallenius nor Sampling")
    with scope(closure.sparkSession):
        links = table(closure.select("gene", "term").where("gene is not null and term is not null").distinct(), "links")
        fg = foreground.select("gene").distinct().withColumn("fg", F.lit(1))
        lens = lengths.where("len is not null").groupBy("gene").agg(F.max("len").alias("len"))
        g = links.select("gene").distinct().join(lens, "gene").join(fg, "gene", "left").withColumn("fg", F.coalesce("fg", F.lit(0)))
        g = table(g, "genes")
        cuts = g.agg(F.percentile_approx("len", [i / bins for i in range(1, bins)], 10000).alias("cuts"))
        g = g.crossJoin(F.broadcast(cuts)).withColumn("bin", F.size(F.filter("cuts", lambda c: c < F.col("len"))))
        rate = monotone(g.groupBy("bin").agg(F.count("*").alias("n"), F.sum("fg").alias("hits")), "bin", "n", "hits", "w")
        g = table(g.join(F.broadcast(rate.select("bin", F.coalesce("w", F.lit(1.0)).alias("w"))), "bin").select("gene", "fg", "w"), "weights")
        all_ = g.agg(F.count("*").alias("big_n"), F.sum("fg").cast("long").alias("n"), F.sum("w").alias("total"))
        t = links.join(g, "gene").groupBy("term").agg(F.sum("fg").cast("long").alias("k"), F.count("*").alias("big_k"), F.avg("w").alias("mean"))
        t = t.where(F.col("k") >= least).crossJoin(F.broadcast(all_))
        rest = F.col("big_n") - F.col("big_k")
        odds = F.coalesce(F.when(rest > 0, F.try_divide(F.col("mean") * rest, F.col("total") - F.col("big_k") * F.col("mean"))), F.lit(1.0))
        t = t.withColumn("odds", odds)
        if method == "Wallenius":
            t = t.withColumn("p", _tails("k", "big_k", rest, "n", "odds"))
        else:
            u = (F.pmod(F.xxhash64("gene", "draw", F.lit(seed)), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
            counts = _drawn_terms(links, g, all_, draws, u)
            least_k = t.select("term", "k")
            as_many = counts.join(least_k, "term").where(F.col("c") >= F.col("k")).groupBy("term").agg(F.count("*").alias("m"))
            m = F.when(F.col("k") == 0, draws).otherwise(F.coalesce("m", F.lit(0)))
            t = t.join(as_many, "term", "left").withColumn("p", (1 + m) / (draws + 1))
        t = table(t.select("term", "k", "big_k", "odds", "p"), "tested")
        floor = t.agg((F.min(F.when(F.col("p") > 0, F.col("p"))) / 10000).alias("__floor"))
        t = t.crossJoin(F.broadcast(floor)).withColumn("p", F.when(F.col("p") == 0, F.coalesce("__floor", F.lit(0.0))).otherwise(F.col("p"))).drop("__floor")
        return result(padjust(t, "p", adjust, tie=["term"]).select("term", "k", "big_k", "odds", "p", "q"), "biased")
