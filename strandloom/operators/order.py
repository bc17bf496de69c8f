"""Order statistics by key for which no task holds a key: ranks, quantiles, densities and Kendall's tau.

Everything rests on places in a total order, which ranges of the order count for themselves (``table.numbered``). Null values
and NaN do not count; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from strandloom.functions.scratch import result, scope, table
from strandloom.operators.table import cumulative_sum, numbered


def _beside(df: DataFrame, by_key: DataFrame, key: list[str]) -> DataFrame:
    """df with the columns of its key's row in ``by_key``; null keys meet too."""
    other = by_key.select(F.struct(*key).alias("__match"), *[c for c in by_key.columns if c not in key])
    same = F.lit(True)
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col("__match").getField(c))
    return df.join(other, same).drop("__match")


def _known(*cols: str) -> Column:
    """The columns are numbers (or other values), neither null nor NaN."""
    ok = F.lit(True)
    for c in cols:
        ok = ok & F.col(c).isNotNull() & (F.col(c).cast("string") != "NaN")
    return ok


def placed(df: DataFrame, key: list[str], order: list[str], place: str, size: str) -> DataFrame:
    """df with its place (from 1) in the order of its key, and the key's number of rows. The order must be total.

    Writes tables of the innermost ``scope``.
    """
    run = table(numbered(df, [*key, *order], "__line"), "numbered")
    keys = run.groupBy(*key).agg(F.min("__line").alias("__first"), F.count("*").alias(size))
    return _beside(run, keys, key).withColumn(place, F.col("__line") - F.col("__first") + 1).drop("__line", "__first")


def ranked(df: DataFrame, key: list[str], value: str) -> DataFrame:
    """One row for each distinct value of a key: the rows that have it (n), the key's rows below it, and all of the key's (total).

    A value of its key has the mean rank below + (n + 1) / 2. Equal values are added up before they travel.
    """
    with scope(df.sparkSession):
        counts = table(df.where(_known(value)).groupBy(*key, value).agg(F.count("*").alias("n")), "values")
        run = table(cumulative_sum(counts, "n", [*key, value], "__upto"), "running")
        keys = run.groupBy(*key).agg(F.sum("n").alias("total"), F.min(F.col("__upto") - F.col("n")).alias("__before"))
        below = F.col("__upto") - F.col("n") - F.col("__before")
        return result(_beside(run, keys, key).select(*key, value, "n", below.alias("below"), "total"), "ranked")


def quantiles(df: DataFrame, key: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Exact quantiles of each key, a column for each name of ``shares``, linear between neighbours.

    Reads the two values that stand at the places around (n - 1) * share, so it holds as many numbers a key as it returns.
    """
    with scope(df.sparkSession):
        r = ranked(df, key, value)
        picks = []
        for name, share in shares.items():
            at = (F.col("total") - 1) * float(share)
            for side, place in (("lo", F.floor(at)), ("hi", F.ceil(at))):
                here = (F.col("below") <= place) & (place < F.col("below") + F.col("n"))
                picks.append(F.max(F.when(here, F.col(value))).cast("double").alias(f"__{side}_{name}"))
        got = r.groupBy(*key).agg(F.max("total").alias("__total"), *picks)
        out = []
        for name, share in shares.items():
            at = (F.col("__total") - 1) * float(share)
            low, high = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
            out.append((low + (high - low) * (at - F.floor(at))).alias(name))
        return result(got.select(*key, *out), "quantiles")


def density(df: DataFrame, key: str, value: str, points: int = 512) -> DataFrame:
    """Gaussian kernel density of each key at ``points`` equal steps over the range of all keys: key, point (from 0), x, density.

    The bandwidth of a key of n values is 0.9 * min(sd, IQR / 1.34) / n^0.2 (where one of the two is 0, the other; where both
    are, or a key has one value, the step). Values are dealt to the two steps beside them by their distance, so that each key
    is at most ``points`` weights, whatever its size; the kernel then runs over those.
    """
    with scope(df.sparkSession):
        v = table(df.where(_known(value)).select(F.col(key).alias("__k"), F.col(value).cast("double").alias("__v")), "values")
        box = quantiles(v, ["__k"], "__v", {"q1": 0.25, "q3": 0.75})
        spread = v.groupBy("__k").agg(F.count("*").alias("n"), F.stddev_samp("__v").alias("sd"))
        span = v.agg(F.min("__v").alias("lo"), ((F.max("__v") - F.min("__v")) / (points - 1)).alias("step"))
        x = F.try_divide(F.col("__v") - F.col("lo"), F.col("step"))
        at = v.crossJoin(F.broadcast(span)).withColumn("x", F.coalesce(x, F.lit(0.0)))
        left = F.least(F.floor("x"), F.lit(points - 1)).cast("int")
        share = F.col("x") - left
        two = F.array(F.struct(left.alias("bin"), (1 - share).alias("w")), F.struct(F.least(left + 1, F.lit(points - 1)).alias("bin"), share.alias("w")))
        bins = at.select("__k", F.inline(two)).groupBy("__k", "bin").agg(F.sum("w").alias("w"))
        bins = bins.groupBy("__k").agg(F.sort_array(F.collect_list(F.struct("bin", "w"))).alias("bins"))
        keys = _beside(_beside(bins, box, ["__k"]), spread, ["__k"]).crossJoin(F.broadcast(span))
        iqr = F.nullif((F.col("q3") - F.col("q1")) / 1.34, F.lit(0.0))
        wide = 0.9 * F.least(F.nullif(F.col("sd"), F.lit(0.0)), iqr) / F.pow(F.col("n"), F.lit(0.2))
        some = F.when(F.col("step") > 0, F.col("step")).otherwise(1.0)
        keys = keys.withColumn("h", F.coalesce(wide, some))
        p = keys.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))

        def kernel(total: Column, b: Column) -> Column:
            z = (F.col("point") - b["bin"]) * F.col("step") / F.col("h")
            return total + b["w"] * F.exp(-0.5 * z * z)

        height = F.aggregate("bins", F.lit(0.0), kernel) / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))
        return result(p.select(F.col("__k").alias(key), "point", (F.col("lo") + F.col("point") * F.col("step")).alias("x"), height.alias("density")), "density")


def _inversions(first: np.ndarray, second: np.ndarray, weight: np.ndarray) -> int:
    """Sum of weight products over pairs with first_i < first_j and second_i > second_j; ``second`` without ties.

    Bit by bit of the second rank, from the top: in a group of equal upper bits, a row whose bit is 0 comes after the rows
    before it whose bit is 1.
    """
    rank = np.empty(len(second), np.int64)
    rank[np.argsort(second)] = np.arange(len(second))
    order = np.lexsort((second, first))
    rank, weight = rank[order], weight[order].astype(np.int64)
    found = 0
    for b in reversed(range(max(1, int(len(rank) - 1).bit_length()))):
        group, bit = rank >> (b + 1), (rank >> b) & 1
        ones = np.concatenate([[0], np.cumsum(weight * bit)])
        start = np.searchsorted(group, group)
        found += int((weight * (1 - bit) * (ones[:-1] - ones[start])).sum())
        keep = np.argsort(rank >> b, kind="stable")
        rank, weight = rank[keep], weight[keep]
    return found


@F.pandas_udf(LongType())
def _inverted(first: pd.Series, second: pd.Series, weight: pd.Series) -> int:
    return _inversions(first.to_numpy(), second.to_numpy(), weight.to_numpy())


def kendall(df: DataFrame, key: list[str], x: str, y: str, block: int = 1 << 18) -> DataFrame:
    """Kendall's tau-b of the points of each key: key, points (long), tau (null where all x or all y are equal).

    Points are placed in the orders (x, y) and (y, x); discordant pairs are those placed one way by the first and the other way
    by the second, and equal values, however many, never count as one. Both orders are cut into blocks of ``block`` places. Pairs
    of one block of the first order are counted inside it, pairs of unlike blocks there but one block of the second order inside
    that, and the rest from the numbers of points in the cells (block, block). A task holds one block, or one row of cells; there
    are (points / block)^2 cells. Equal points travel once, with a weight.
    """
    with scope(df.sparkSession):
        c = table(df.where(_known(x, y)).select(*key, F.col(x).alias("__x"), F.col(y).alias("__y")).groupBy(*key, "__x", "__y").agg(F.count("*").alias("w")), "points")
        both = placed(table(placed(c, key, ["__x", "__y"], "s", "m"), "first"), key, ["__y", "__x"], "t", "m2")
        cell = lambda i: F.floor((F.col(i) - 1) / block).cast("int")
        both = table(both.select(*key, "s", "t", "m", "w", cell("s").alias("p"), cell("t").alias("q")), "placed")
        inside = both.groupBy(*key, "p").agg(_inverted("s", "t", "w").alias("d")).select(*key, "d")
        across = both.groupBy(*key, "q").agg(_inverted("p", "t", "w").alias("d")).select(*key, "d")
        full = both.groupBy(*key, "p", "q").agg(F.sum("w").alias("w"))
        last = both.groupBy(*key).agg(F.floor((F.max("m") - 1) / block).cast("int").alias("last"))
        grid = last.select(*key, F.explode(F.sequence(F.lit(0), "last")).alias("p"), "last").select(*key, "p", F.explode(F.sequence(F.lit(0), "last")).alias("q"))
        grid = grid.withColumn("w", F.lit(0).cast("long")).unionByName(full).groupBy(*key, "p", "q").agg(F.sum("w").alias("w"))
        up = Window.partitionBy(*key, "q").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
        right = Window.partitionBy(*key, "p").orderBy(F.desc("q")).rowsBetween(Window.unboundedPreceding, -1)
        cells = grid.withColumn("before", F.coalesce(F.sum("w").over(up), F.lit(0))).withColumn("over", F.coalesce(F.sum("before").over(right), F.lit(0)))
        apart = cells.groupBy(*key).agg(F.sum(F.col("w") * F.col("over")).alias("d"))
        discordant = inside.unionByName(across).unionByName(apart).groupBy(*key).agg(F.sum("d").alias("d"))

        def pairs(by: list[str], name: str) -> DataFrame:
            """Pairs of points that agree in ``by``."""
            k = c.groupBy(*key, *by).agg(F.sum("w").alias("w")) if by else c.groupBy(*key).agg(F.sum("w").alias("w"))
            return k.groupBy(*key).agg(F.sum((F.col("w") * (F.col("w") - 1) / 2).cast("long")).alias(name), F.sum("w").alias("points"))

        out = discordant
        for by, name in (([], "n0"), (["__x"], "n1"), (["__y"], "n2"), (["__x", "__y"], "n3")):
            got = pairs(by, name)
            out = _beside(out, got if name == "n0" else got.drop("points"), key)
        n0, n1, n2, n3 = (F.col(n).cast("double") for n in ("n0", "n1", "n2", "n3"))
        tau = F.try_divide(n0 - n1 - n2 + n3 - 2 * F.col("d").cast("double"), F.sqrt((n0 - n1) * (n0 - n2)))
        return result(out.select(*key, "points", tau.alias("tau")), "tau")
