"""Target sites of small RNAs: seeds with mismatches, G:U wobbles and one looped-out base on either side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.functions.keys import fresh, matching, without
from strandloom.functions.scratch import result, scope, table
from strandloom.functions.seq import kmers, reverse_complement
from strandloom.functions.seqarrays import distinct_windows, window_sums

#: G:U pairs as (complemented target base, small RNA base): a fixed rule.
WOBBLE = ("CT", "AG")
BASES = "ACGTN"
WOBBLES, MISMATCHES = {6: 0, 7: 1, 8: 1}, {6: 0, 7: 0, 8: 1}
#: Matches of windows that a task holds at once.
HELD = 1 << 21


def _variants(pattern: Column, size: int, mismatches: int, wobbles: int) -> Column:
    """All strings of ``size`` bases that pair with ``pattern`` up to the limits: (key, mism, wob, last); last: whether the last base differs."""

    def step(have: Column, i: Column) -> Column:
        base = F.substr(pattern, i, F.lit(1))

        def put(a: Column, c: Column) -> Column:
            wobble = F.concat(c, base).isin(*WOBBLE)
            differs = c != base
            return F.struct(
                F.concat(a["key"], c).alias("key"), (a["mism"] + (differs & ~wobble).cast("int")).alias("mism"), (a["wob"] + wobble.cast("int")).alias("wob"), differs.alias("last"),
            )

        grown = F.flatten(F.transform(have, lambda a: F.transform(F.array(*map(F.lit, BASES)), lambda c: put(a, c))))
        return F.filter(grown, lambda x: (x["mism"] <= mismatches) & (x["wob"] <= wobbles))

    none = F.array(F.struct(F.lit("").alias("key"), F.lit(0).alias("mism"), F.lit(0).alias("wob"), F.lit(False).alias("last")))
    return F.aggregate(F.sequence(F.lit(1), F.lit(size)), none, step)


def seed_neighbourhood(mir: DataFrame, lengths: Sequence[int], wobbles: Mapping[int, int], mismatches: Mapping[int, int], loops: Sequence[int] = (), start: int = 2) -> DataFrame:
    """What a complemented target may read at a seed of mir (mirna, seq): mirna, seq, size, kind, at, key, mism, wob, last.

    kind: seed, target (its base ``at``, from 0, is looped out) or mirna (the small RNA's is). A base missing in a short small RNA
    pairs with nothing.
    """
    m = mir.select("mirna", F.translate("seq", "U", "T").alias("seq"))
    spread = lambda rows, value: rows.withColumn("v", F.explode(value)).select("mirna", "seq", "size", "kind", "at", "v.*")
    part = lambda c, a, n: F.substr(F.col(c), F.lit(a) if isinstance(a, int) else a, F.lit(n) if isinstance(n, int) else n)
    out = []
    for n in lengths:
        rows = m.withColumns({"size": F.lit(n), "kind": F.lit("seed"), "at": F.lit(-1)})
        out.append(spread(rows, _variants(part("seq", start, n), n, mismatches.get(n, 0), wobbles.get(n, 0))))
    for n in (x for x in loops if x <= max(lengths)):  # a window holds no more than the longest seed
        rows = m.withColumns({"size": F.lit(n), "at": F.explode(F.sequence(F.lit(1), F.lit(n - 2)))}) if n > 2 else None
        if rows is None:
            continue
        limits = mismatches.get(n, 0), wobbles.get(n, 0)
        short = _variants(part("seq", start, n - 1), n - 1, *limits)
        looped = spread(rows.withColumn("kind", F.lit("target")), short).withColumn("loose", F.explode(F.array(*map(F.lit, BASES))))
        key = F.concat(part("key", 1, F.col("at")), "loose", part("key", F.col("at") + 1, n))
        out.append(looped.withColumn("key", key).drop("loose"))
        skipped = F.concat(part("seq", start, F.col("at")), part("seq", F.col("at") + start + 1, n))
        out.append(spread(rows.withColumn("kind", F.lit("mirna")), _variants(skipped, n, *limits)))
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole


def _trimmed(pairing: Column) -> Column:
    """Without the zeros behind the last pair."""
    last = F.array_max(F.transform(pairing, lambda x, i: F.when(x > 0, i + 1).otherwise(0)))
    return F.slice(pairing, 1, last)


def _pairings(window: Column, start: int) -> tuple[Column, Column]:
    """(small RNA's, target's) partners of each base, from 1, with 0 for none, of columns seq, size, kind, at."""
    at, size = F.col("at"), F.col("size")
    shift = lambda k: F.when((F.col("kind") == "mirna") & (k >= at), 1).when((F.col("kind") == "target") & (k > at), -1).otherwise(0)

    def pairs(k: Column) -> Column:  # place k of the window, from 0
        mate = F.substr("seq", k + shift(k) + start, F.lit(1))
        own = F.substr(window, k + 1, F.lit(1))
        return ((own == mate) | F.concat(own, mate).isin(*WOBBLE)) & ~((F.col("kind") == "target") & (k == at))

    before = F.array_repeat(F.lit(0), start - 1)
    target = F.transform(F.sequence(F.lit(0), size - 1), lambda k: F.when(pairs(k), k + shift(k) + start).otherwise(0))
    # place k of the small RNA's seed pairs with this place of the window
    window_place = lambda k: F.when((F.col("kind") == "mirna") & (k > at), k - 1).when((F.col("kind") == "target") & (k >= at), k + 1).otherwise(k)
    count = size + F.when(F.col("kind") == "mirna", 1).when(F.col("kind") == "target", -1).otherwise(0)
    loose = lambda k: (F.col("kind") == "mirna") & (k == at)
    mirna = F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.when(~loose(k) & pairs(window_place(k)), window_place(k) + start).otherwise(0))
    return _trimmed(F.concat(before, mirna)), _trimmed(F.concat(before, target))


def window_matches(windows: DataFrame, mir: DataFrame, lengths: Sequence[int], wobbles: Mapping[int, int], mismatches: Mapping[int, int], loops: Sequence[int], start: int, prefer_long: bool) -> DataFrame:
    """What each distinct window (window: complemented target bases, ``-`` past the end) may be to each small RNA.

    One equi-join of the seeds' neighbourhood with the windows' beginnings of each length; of the seeds of one window and small RNA
    the longest counts, one that ends in a mismatch only if it is of the least length or with ``prefer_long``.
    """
    near = seed_neighbourhood(mir, lengths, wobbles, mismatches, loops, start)
    near = near.where((F.col("kind") != "seed") | ~F.col("last") | F.lit(prefer_long) | (F.col("size") == min(lengths)))
    sizes = sorted({*lengths, *(x for x in loops if x <= max(lengths))})
    begins = windows.withColumn("size", F.explode(F.array(*map(F.lit, sizes)))).withColumn("key", F.substr("window", F.lit(1), F.col("size")))
    met = begins.join(near, ["size", "key"])
    longest = F.max(F.when(F.col("kind") == "seed", F.col("size")))
    best = met.groupBy("window", "mirna", "seq").agg(longest.alias("longest"), F.collect_list(F.struct("size", "kind", "at", "mism", "wob")).alias("x"))
    rows = best.select("window", "mirna", "seq", "longest", F.explode("x").alias("x")).select("window", "mirna", "seq", "longest", "x.*")
    rows = rows.where((F.col("kind") != "seed") | (F.col("size") == F.col("longest"))).drop("longest")
    mirna, target = _pairings(F.col("window"), start)
    return rows.withColumns({"mirna_pairing": mirna, "target_pairing": target})


def target_sites(
    utr: DataFrame, mir: DataFrame, lengths: Sequence[int] = (6, 7, 8), wobbles: Mapping[int, int] = WOBBLES, mismatches: Mapping[int, int] = MISMATCHES, loops: Sequence[int] = (), start: int = 2,
    min_len: int = 22, prefer_long: bool = False,
) -> DataFrame:
    """mirna, target, start, end, seed, mismatches, wobbles, loop, mirna_seq, target_seq, mirna_pairing, target_pairing.

    utr: utr, seq; mir: mirna, seq. Places count from 1 on the target and run backwards (start >= end), as its complement is read.
    A site needs ``min_len`` bases from its seed on; the small RNA pairs from its base ``start``. Wobbles and mismatches are
    limited by seed length; lengths in ``loops`` also come with one base looped out, of the target or of the small RNA, one
    row for each. Bases other than ACGT (U is T) count as N.

    The windows of all targets are first made distinct (at most 6 ** longest seed of them), matched with the small RNAs' neighbourhood
    once, and met again by the places with one equi-join; so a place costs what it reports, whatever the number of small RNAs. The sites are not
    written: what reads them takes the columns that it needs.
    """
    with scope(utr.sparkSession):
        most = max(lengths)
        clean = F.regexp_replace(F.translate("seq", "U", "T"), "[^ACGT]", "N")
        back = utr.where(F.length("seq") >= max(min_len, start - 1 + min(lengths))).select("utr", F.length("seq").alias("n"), F.concat(reverse_complement(clean), F.lit("-" * most)).alias("rc"))
        reach = start - 1 + most  # the bases before the seed belong to the site
        places = kmers(back, "rc", reach, ["utr", "n"]).where(F.col("pos") <= F.col("n") - max(min_len, min(lengths)) - start + 2)
        places = places.select("utr", "n", "pos", "kmer", F.substr("kmer", F.lit(start), F.lit(most)).alias("window"))
        windows = table(places.select("window").distinct(), "windows")
        found = result(window_matches(windows, mir, lengths, wobbles, mismatches, loops, start, prefer_long), "matches")
        j = places.join(found, "window")
        first = F.col("n") - F.col("pos") + 1
        columns = {
            "mirna": F.col("mirna"), "target": F.col("utr"), "start": first, "end": first - F.col("size") - start + 2, "seed": F.col("size"), "mismatches": F.col("mism"), "wobbles": F.col("wob"),
            "loop": (F.col("kind") != "seed").cast("int"), "mirna_seq": F.col("seq"), "target_seq": F.substr("kmer", F.lit(1), F.col("size") + start - 1), "mirna_pairing": F.col("mirna_pairing"),
            "target_pairing": F.col("target_pairing"),
        }
        return j.select(*[v.alias(k) for k, v in columns.items()])


def target_site_sums(
    utr: DataFrame, mir: DataFrame, by: Sequence[str] = ("seed", "mismatches", "wobbles"), lengths: Sequence[int] = (6, 7, 8), wobbles: Mapping[int, int] = WOBBLES,
    mismatches: Mapping[int, int] = MISMATCHES, loops: Sequence[int] = (), start: int = 2, min_len: int = 22, prefer_long: bool = False,
) -> DataFrame:
    """The sites of ``target_sites`` counted: mirna, target, the columns ``by`` (of seed, mismatches, wobbles, loop), sites, starts, ends (sums of their places).

    No row a place or site is made: batches of targets are read as numbers, first for the distinct windows, which are matched
    as in ``target_sites``, then for the sums by target, which are whole in their batch. So only rows of targets that occur more than
    once are shuffled. Matches beyond ``HELD`` are dealt by small RNA to several passes over the targets. Seeds have at most 24 bases.
    """
    most, least, by = max(lengths), max(min_len, min(lengths)), list(by)
    if most > 24:
        raise ValueError("seeds of more than 24 bases have no number")
    spark, keys = utr.sparkSession, ["target", "mirna", *by]
    with scope(spark):
        windows = table(distinct_windows(utr, "seq", most, start, least), "windows")
        found = window_matches(windows, mir, lengths, wobbles, mismatches, loops, start, prefer_long)
        named = {"mirna": F.col("mirna"), "seed": F.col("size"), "mismatches": F.col("mism"), "wobbles": F.col("wob"), "loop": (F.col("kind") != "seed").cast("int"), "back": F.col("size") + start - 2}
        found = found.select("window", *[v.alias(k) for k, v in named.items()]).groupBy("window", "mirna", *by).agg(F.count("*").alias("times"), F.sum("back").cast("long").alias("back"))
        found = table(found, "matches")
        passes = -(-found.count() // HELD) or 1
        given = utr.select(F.col("utr").alias("target"), "seq")
        sums = lambda rows, part: window_sums(rows, "target", "seq", found.where(F.pmod(F.xxhash64("mirna"), F.lit(passes)) == part), ["mirna", *by], most, start, least)
        k = fresh("key", given)
        marks = given.select(F.xxhash64("target").alias(k))
        again = marks.groupBy(k).count().where("count > 1").select(k)
        if again.isEmpty():
            once, more = given, None
        else:
            again, marked = result(again, "again"), given.withColumn(k, F.xxhash64("target"))
            once, more = without(marked, k, again), matching(marked, k, again)
        out = None
        for part in range(passes):
            rows = sums(once, part)
            if more is not None:
                rows = rows.unionByName(sums(more, part).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("sites", "starts", "backs")]))
            out = rows if out is None else out.unionByName(rows)
        return out.select("mirna", "target", *by, "sites", "starts", (F.col("starts") - F.col("backs")).alias("ends"))
