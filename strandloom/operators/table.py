"""Column, row and key operations on plain tables.

Files have an order and DataFrames have none, so whatever depends on order takes an ``order`` argument.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions.components import components


def range_bounds(df: DataFrame, order: list[str]) -> DataFrame:
    """One row, __bounds: keys of the order that cut df into about equal ranges, from a bounded sample (fixed by hash)."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sample = df.select(F.struct(*order).alias("k")).orderBy(F.xxhash64(*order), *order).limit(50 * parts)
    cuts = F.transform(F.sequence(F.lit(1), F.lit(parts)), lambda i: F.get("a", F.floor(F.size("a") * i / (parts + 1)).cast("int")))
    return sample.agg(F.sort_array(F.collect_list("k")).alias("a")).select(cuts.alias("__bounds"))


def dealt_by(df: DataFrame, bounds: DataFrame, key: Column, name: str = "__part") -> DataFrame:
    """df with ``name``: the range of ``range_bounds`` that a key (a struct of the order) is in, from 0.

    A row finds its range by halving: as many comparisons as the number of ranges has binary digits.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.crossJoin(F.broadcast(bounds)).withColumns({"__key": key, name: F.lit(0)})
    for step in (1 << k for k in reversed(range(parts.bit_length()))):
        part = F.col(name)
        dealt = dealt.withColumn(name, F.when(F.get("__bounds", part + (step - 1)) <= F.col("__key"), part + step).otherwise(part))
    return dealt.drop("__bounds", "__key")


def _ranges(df: DataFrame, order: list[str]) -> DataFrame:
    """df with __part: the range of the order that a row is in."""
    return dealt_by(df, range_bounds(df, order), F.struct(*order))


def numbered(df: DataFrame, order: list[str], name: str = "line") -> DataFrame:
    """A gapless number from 1 in a total order, without one task for all rows.

    Each range of the order numbers its own rows and adds the sizes of the ranges before it (one row per range).
    """
    dealt = _ranges(df, order)
    inside = dealt.withColumn("__n", F.row_number().over(Window.partitionBy("__part").orderBy(*order)))
    sizes = dealt.groupBy("__part").agg(F.count("*").alias("__m"))
    before = sizes.withColumn("__before", F.sum("__m").over(Window.orderBy("__part")) - F.col("__m")).drop("__m")
    return inside.join(F.broadcast(before), "__part").withColumn(name, F.col("__n") + F.col("__before")).drop("__part", "__n", "__before")


def line_number(df: DataFrame, order: list, start: int = 1, step: int = 1) -> DataFrame:
    return numbered(df, order).withColumn("line", (F.col("line") - 1) * step + start)


def islands(df: DataFrame, key: list[str], beg: str, end: str, gap: int | None = None, name: str = "island", also: dict[str, int] | None = None) -> DataFrame:
    """A number for each island of intervals of a key: those that begin at most ``gap`` after all before them have ended (no gap:
    before or where they end). ``also``: further numbers by name, each with a gap of its own, from the same pass.

    Works by ranges of the order as ``numbered`` does: a range begins with the furthest end of its key in the ranges before it.
    """
    dealt = _ranges(df, [*key, beg, end])
    w = Window.partitionBy("__part", *key).orderBy(beg, end)
    inside = dealt.withColumn("__upto", F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    w = Window.partitionBy(*[F.col("__k").getField(k) for k in key]).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    ends = dealt.groupBy(*key, "__part").agg(F.max(end).alias("__e")).select(F.struct(*key).alias("__k"), F.col("__part").alias("__p"), "__e")
    ends = ends.select("__k", "__p", F.max("__e").over(w).alias("__carry")).where("__carry is not null")
    same = F.col("__part") == F.col("__p")
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col("__k").getField(k))
    joined = inside.join(ends, same, "left")
    upto = F.greatest("__upto", "__carry")
    tests = {name: F.col(beg) > upto if gap is None else F.col(beg) - upto > gap, **{k: F.col(beg) - upto > g for k, g in (also or {}).items()}}
    first = joined.withColumns({f"__new_{k}": F.coalesce(x, F.lit(True)).cast("int") for k, x in tests.items()}).drop("__upto", "__carry", "__k", "__p")
    w = Window.partitionBy("__part").orderBy(*key, beg, end).rowsBetween(Window.unboundedPreceding, 0)
    counted = first.withColumns({f"__n_{k}": F.sum(f"__new_{k}").over(w) for k in tests})
    sums = first.groupBy("__part").agg(*[F.sum(f"__new_{k}").alias(f"__m_{k}") for k in tests])
    past = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("__part", *[F.coalesce(F.sum(f"__m_{k}").over(past), F.lit(0)).alias(f"__before_{k}") for k in tests])
    done = counted.join(F.broadcast(before), "__part").withColumns({k: F.col(f"__n_{k}") + F.col(f"__before_{k}") for k in tests})
    return done.drop("__part", *[f"__{c}_{k}" for c in ("n", "new", "before") for k in tests])


def cumulative_sum(df: DataFrame, col: str, order: list[str], name: str = "cumul") -> DataFrame:
    """Running sum in a total order, by ranges as in ``numbered``."""
    dealt = _ranges(df, order)
    inside = dealt.withColumn("__s", F.sum(col).over(Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    sums = dealt.groupBy("__part").agg(F.sum(col).alias("__m"))
    before = sums.withColumn("__before", F.coalesce(F.sum("__m").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__m")
    return inside.join(F.broadcast(before), "__part").withColumn(name, F.col("__s") + F.col("__before")).drop("__part", "__s", "__before")


def body_range(df: DataFrame, beg: float, end: float, order: list) -> DataFrame:
    """Rows beg to end; negative bounds count from the end, bounds between 0 and 1 are shares of all rows."""
    n = numbered(df, order)
    total = F.col("__total")

    def bound(x: float, up: bool) -> Column:
        if x < 0:
            return total + 1 + int(x)
        if 0 < x < 1:
            return F.floor(total * x) if up else F.floor(total * x) + 1
        return F.lit(int(x))

    n = n.crossJoin(F.broadcast(df.agg(F.count("*").alias("__total"))))
    return n.where(F.col("line").between(bound(beg, False), bound(end, True))).drop("__total")


def uniquify(df: DataFrame, cols: list[str], order: list, delim: str = "-", grouped: bool = False, force: bool = False) -> DataFrame:
    """Repeated values get a number behind a delimiter, the first stays (with ``force`` it is numbered too).

    With ``grouped`` the columns count together; else each for itself.
    """
    for group in [cols] if grouped else [[c] for c in cols]:
        k = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        df = df.withColumn("__k", k if force else k - 1)
        df = df.withColumns({c: F.when(F.col("__k") > 0, F.concat(F.col(c), F.lit(delim), F.col("__k").cast("string"))).otherwise(F.col(c)) for c in group}).drop("__k")
    return df


def take_first_n(df: DataFrame, key: list[str], n: int, order: list) -> DataFrame:
    return df.withColumn("__k", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col("__k") <= n).drop("__k")


def moving_window(df: DataFrame, col: str, w: int, order: list, key: list[str]) -> DataFrame:
    """Centred mean, largest and least over 2w + 1 rows of a key, cut at the ends; empty values do not count."""
    over = Window.partitionBy(*key).orderBy(*order).rowsBetween(-w, w)
    return df.withColumns({f"{f}_{col}": g(col).over(over) for f, g in (("avg", F.avg), ("max", F.max), ("min", F.min))})


def table_transpose(df: DataFrame, index: str) -> DataFrame:
    """Rows and columns change places; values become text. For tables of few rows (they become columns)."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]).transpose(index)


def sort_report(df: DataFrame, col: str, numeric: bool = True, descending: bool = False) -> DataFrame:
    key = F.col(col).cast("double") if numeric else F.col(col)
    return df.orderBy(key.desc() if descending else key.asc())


# --- joins: in a table with repeated keys the last row counts ---


def last_rows(df: DataFrame, on: list[str], order: list[str]) -> DataFrame:
    values = [c for c in df.columns if c not in on]
    last = F.max_by(F.struct(*values), F.struct(*order)).alias("__v")
    return df.groupBy(*on).agg(last).select(*on, "__v.*")


def table_join(left: DataFrame, right: DataFrame, on: list[str], order: list[str]) -> DataFrame:
    return left.join(last_rows(right, on, order), on)


def table_join_outer(left: DataFrame, right: DataFrame, on: list[str], order: list[str], fill=None, key_as_fill: bool = False) -> DataFrame:
    """Left rows without a partner get a constant, or with ``key_as_fill`` their (first) key."""
    right = last_rows(right, on, order).withColumn("__hit", F.lit(True))
    values = [c for c in right.columns if c not in on and c != "__hit"]
    out = left.join(right, on, "left")
    other = lambda c: F.col(on[0]).cast(right.schema[c].dataType) if key_as_fill else F.lit(fill).try_cast(right.schema[c].dataType)
    return out.withColumns({c: F.when(F.col("__hit"), F.col(c)).otherwise(other(c)) for c in values}).drop("__hit")


def table_join_anti(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(right, on, "left_anti")


def table_join_merge(left: DataFrame, right: DataFrame, on: list[str], col: str, order: list[str]) -> DataFrame:
    """``col`` from the right where the key exists there, else from the left."""
    r = last_rows(right, on, order).select(*on, F.col(col).alias("__r"))
    return left.join(r, on, "left").withColumn(col, F.coalesce("__r", col)).drop("__r")


def table_join_keynorm(left: DataFrame, right: DataFrame, on: str, how: str, order: list[str]) -> DataFrame:
    """Keys made whole numbers (``num``) or upper case (``upper``) on both sides."""
    norm = F.floor(F.col(on).cast("double")).cast("long") if how == "num" else F.upper(on)
    return table_join(left.withColumn(on, norm), right.withColumn(on, norm), [on], order)


def synonym_classes(pairs: DataFrame) -> DataFrame:
    """pairs (a, b) of equal names to (name, canon): the least name that each one reaches."""
    return components(pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))).select(F.col("id").alias("name"), F.col("component_id").alias("canon"))


def table_join_synonyms(left: DataFrame, right: DataFrame, on: str, synonyms: DataFrame, order: list[str]) -> DataFrame:
    """Join on names or any of their synonyms (transitively)."""
    classes = synonym_classes(synonyms).withColumnRenamed("name", on)
    named = lambda df: df.join(classes, on, "left").withColumn("__key", F.coalesce("canon", on)).drop("canon")
    r = last_rows(named(right).drop(on), ["__key"], order)
    return named(left).join(r, "__key").drop("__key")


def join_project(df: DataFrame, hide: list[str] = (), reverse: bool = False) -> DataFrame:
    cols = [c for c in df.columns if c not in hide]
    return df.select(*(cols[::-1] if reverse else cols))


def sequential_join(dfs: list[DataFrame], on: list[str]) -> DataFrame:
    return reduce(lambda a, b: a.join(b, on), dfs)


def sort_merge_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(right.hint("merge"), on).distinct()


def best_hit(hits: DataFrame, query: str, order: list, max_e: float = 1e-5, by: str = "evalue", n: int = 1) -> DataFrame:
    return take_first_n(hits.where(F.col(by) <= max_e), [query], n, order)


# --- columns ---


def add_const_or_counter(df: DataFrame, name: str, const=None, order: list | None = None) -> DataFrame:
    return df.withColumn(name, F.lit(const)) if order is None else numbered(df, order, name)


def add_arith(df: DataFrame, op: str, a: str, b: str, name: str) -> DataFrame:
    """ratio (null where the divisor is 0), difference, product, sum or concat of two columns."""
    x, y = F.col(a), F.col(b)
    made = {"ratio": F.try_divide(x.cast("double"), y.cast("double")), "difference": x - y, "product": x * y, "sum": x + y, "concat": F.concat(x.cast("string"), y.cast("string"))}
    return df.withColumn(name, made[op])


def add_rowwise_agg(df: DataFrame, fn: str, cols: list[str], name: str, quant: tuple[float, float] = (0.0, 1.0)) -> DataFrame:
    """min, max, count of non-empty, ave, or the mean between two quantiles of a row's values."""
    row = F.array_sort(F.filter(F.array(*[F.col(c).cast("double") for c in cols]), lambda x: x.isNotNull()))
    n = F.size(row)
    lo, hi = F.floor(n * quant[0]).cast("int"), F.ceil(n * quant[1]).cast("int")
    part = F.slice(row, lo + 1, F.greatest(hi - lo, F.lit(0))) if fn == "quant" else row
    mean = F.try_divide(F.aggregate(part, F.lit(0.0), lambda s, x: s + x), F.size(part))
    return df.withColumn(name, {"min": F.array_min(row), "max": F.array_max(row), "count": n, "ave": mean, "quant": mean}[fn])


def modify_where(df: DataFrame, cols: list[str], cond: Callable[[Column], Column], fn: Callable[[Column], Column]) -> DataFrame:
    """Change the cells of ``cols`` for which a condition holds."""
    return df.withColumns({c: F.when(cond(F.col(c)), fn(F.col(c))).otherwise(F.col(c)) for c in cols})


def arith(c: Column, op: str, x: float = 0.0, y: float = 0.0) -> Column:
    """One of the column operations, with the guards of the tool: a zero divisor gives 999999, no log of x <= 0 but 0."""
    log = lambda f: F.when(c > 0, f(c)).otherwise(0.0)
    ops = {
        "add": lambda: c + x, "subtract": lambda: c - x, "multiply": lambda: c * x, "divide": lambda: F.lit(999999.0) if x == 0 else c / x,
        "mod": lambda: c % x, "abs": lambda: F.abs(c), "floor": lambda: F.floor(c), "ceil": lambda: F.ceil(c), "round": lambda: F.ceil(c - 0.5),
        "sign": lambda: F.signum(c), "ln": lambda: log(F.ln), "log2": lambda: log(F.log2), "log10": lambda: log(F.log10), "exp": lambda: F.exp(c),
        "power_of": lambda: F.pow(F.lit(x), c), "pow": lambda: F.pow(c, F.lit(x)), "clamp": lambda: F.greatest(F.least(c, F.lit(y)), F.lit(x)),
        "resolution": lambda: F.floor(c / x) * x, "inverse": lambda: F.when(c == 0, 999999.0).otherwise(1.0 / c),
    }
    return ops[op]()


def modify_arith(df: DataFrame, col: str, op: str, x: float = 0.0, y: float = 0.0) -> DataFrame:
    return df.withColumn(col, arith(F.col(col), op, x, y))


def modify_by_column(df: DataFrame, col: str, op: str, other: str) -> DataFrame:
    a, b = F.col(col), F.col(other)
    return df.withColumn(col, {"divide": F.when(b == 0, 999999.0).otherwise(a / b), "multiply": a * b, "subtract": a - b, "add": a + b, "min": F.least(a, b), "max": F.greatest(a, b)}[op])


def modify_string(df: DataFrame, col: str, op: str, *args) -> DataFrame:
    c = F.col(col)
    ops = {
        "substr": lambda: F.substring(c, *args), "length": lambda: F.length(c), "reverse": lambda: F.reverse(c), "remove": lambda: F.regexp_replace(c, args[0], ""),
        "replace": lambda: F.regexp_replace(c, *args), "prefix": lambda: F.concat(F.lit(args[0]), c), "suffix": lambda: F.concat(c, F.lit(args[0])),
        "quote": lambda: F.concat(F.lit('"'), c, F.lit('"')), "set": lambda: F.lit(args[0]), "letters": lambda: F.array_join(F.filter(F.split(c, ""), lambda x: x != ""), args[0]),
    }
    if op == "split":
        pieces = F.split(c, args[0])
        return df.withColumns({f"{col}_{i + 1}": F.get(pieces, i) for i in range(args[1])}).drop(col)
    return df.withColumn(col, ops[op]())


def modify_scale(df: DataFrame, col: str, op: str, *args) -> DataFrame:
    """range (lo, hi), z, centre, by_mean, probability, bins (n) or pivot (threshold): one pass for the column's statistics."""
    c = F.col(col)
    s = df.agg(F.min(c).alias("__lo"), F.max(c).alias("__hi"), F.avg(c).alias("__mean"), F.stddev_pop(c).alias("__sd"), F.sum(F.greatest(c, F.lit(0))).alias("__sum"))
    lo, hi, mean = F.col("__lo"), F.col("__hi"), F.col("__mean")
    if op == "range":
        new = args[0] + (c - lo) / (hi - lo) * (args[1] - args[0])
    elif op == "bins":
        width = (hi - lo) / args[0]
        new = lo + (F.least(F.floor((c - lo) / width), F.lit(args[0] - 1)) + 0.5) * width
    else:
        new = {"z": (c - mean) / F.col("__sd"), "centre": c - mean, "by_mean": c / mean, "probability": F.greatest(c, F.lit(0)) / F.col("__sum"), "pivot": (c >= F.lit(args[0] if args else 0)).cast("int")}[op]
    return df.crossJoin(F.broadcast(s)).withColumn(col, new).drop("__lo", "__hi", "__mean", "__sd", "__sum")


def average_rows(df: DataFrame, keys: list[str], col: str, mode: str = "mean", order: str | None = None, weight: str | None = None, delim: str = ";") -> DataFrame:
    """One row per key: mean, max, min, sum, std (population), median, last, list, weighted, logsumexp or count."""
    c = F.col(col)
    if mode == "logsumexp":
        top = df.groupBy(*keys).agg(F.max(c).alias("__m"))
        return df.join(top, keys).groupBy(*keys).agg((F.max("__m") + F.log(F.sum(F.exp(c - F.col("__m"))))).alias(col))
    made = {
        "mean": lambda: F.avg(c), "max": lambda: F.max(c), "min": lambda: F.min(c), "sum": lambda: F.sum(c), "std": lambda: F.stddev_pop(c), "median": lambda: F.median(c),
        "last": lambda: F.max_by(c, F.col(order)), "list": lambda: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order or col), c.alias("__c")))), lambda x: x["__c"].cast("string")), delim),
        "weighted": lambda: F.sum(c * F.col(weight)) / F.sum(F.col(weight)), "count": lambda: F.count(c),
    }
    return df.groupBy(*keys).agg(made[mode]().alias(col))


def cut_columns(df: DataFrame, ranges: str | None = None, names: list[str] | None = None, invert: bool = False) -> DataFrame:
    """Columns by ranges such as ``3,1-2,5-`` (order and repeats kept; repeats get a number) or by names, or all others."""
    cols = df.columns
    picked = list(names or [])
    for part in (ranges or "").split(",") if ranges else []:
        a, dash, b = part.partition("-")
        first, last = int(a or 1), int(b or len(cols)) if dash else int(a)
        picked += cols[first - 1 : last]
    if invert:
        return df.select(*[c for c in cols if c not in picked])
    seen: dict[str, int] = {}
    out = []
    for c in picked:
        seen[c] = seen.get(c, 0) + 1
        out.append(F.col(c) if seen[c] == 1 else F.col(c).alias(f"{c}_{seen[c]}"))
    return df.select(*out)


def merge_columns(df: DataFrame, a: str, b: str, name: str, delim: str = "", how: str = "plain", once: bool = False) -> DataFrame:
    """Two columns as one: plain, reversed, sorted as text or as number; with ``once`` equal values stand once."""
    x, y = F.col(a).cast("string"), F.col(b).cast("string")
    swap = {"plain": F.lit(False), "reversed": F.lit(True), "sorted": x > y, "numeric": F.col(a).cast("double") > F.col(b).cast("double")}[how]
    both = F.when(swap, F.concat_ws(delim, y, x)).otherwise(F.concat_ws(delim, x, y))
    return df.withColumn(name, F.when(x == y, x).otherwise(both) if once else both).drop(a, b)


def permuted_labels(df: DataFrame, key: list[str], col: str, seed: int = 1) -> DataFrame:
    """``col`` dealt anew over the rows in a fixed pseudo-random order, as a null control."""
    salted = F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in key], F.lit(str(seed))).cast("binary"))
    home = numbered(df.drop(col), key, "__i")
    away = numbered(df.select(*key, col).withColumn("__h", salted), ["__h", *key], "__i").select("__i", col)
    return home.join(away, "__i").drop("__i")
