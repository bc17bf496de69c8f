"""Column expressions on nucleotide strings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A column that later filters and projections read instead of computing it again (a generator bars the merge)."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def letters(seq: Column) -> Column:
    """The letters of a string as an array (empty for an empty string)."""
    return F.filter(F.split(seq, ""), lambda x: x != "")


def kmers(df: DataFrame, seq: str, k: int, keep: list[str], tile: int = 512) -> DataFrame:
    """``keep`` columns, pos (from 1) and kmer for every place of a sequence.

    Sequences are cut into overlapping tiles first, by one pass of a pattern: taking a piece by its place walks from the
    start of the string, which is square in the length.
    """
    s = F.col(seq)
    cut = F.regexp_extract_all(s, F.lit(f"(?s)(?=(.{{1,{tile + k - 1}}})).{{1,{tile}}}"), F.lit(1))
    tiles = df.where(F.length(s) >= k).select(*keep, F.posexplode(cut).alias("__no", "__tile")).where(F.length("__tile") >= k)
    cut = F.transform(F.sequence(F.lit(1), F.length("__tile") - k + 1), lambda i: F.substr("__tile", i, F.lit(k)))
    return tiles.select(*keep, "__no", F.posexplode(cut).alias("__i", "kmer")).select(*keep, (F.col("__no") * tile + F.col("__i") + 1).alias("pos"), "kmer")


def pieces(df: DataFrame, seqs: DataFrame, key: str, start: Column, end: Column, tile: int = 1 << 14) -> DataFrame:
    """Rows of df whose key has a sequence, with __size, __from, __to and __piece: the letters start to end (1-based, closed)
    of that sequence, as far as it reaches; empty where it has none there.

    seqs: the key (once each), seq. ``start`` and ``end`` may use __size, the sequence's length. Only the tiles that a row touches
    travel to it, never a whole sequence, so many rows on one long sequence are spread. Equal rows stay as many as they are.
    """
    given = df.columns
    rows = df.join(once(seqs, "__size", F.length("seq")).select(key, "__size"), key).select(*given, "__size", start.cast("int").alias("__from"), end.cast("int").alias("__to"))
    lo, hi = F.greatest("__from", F.lit(1)), F.least("__to", "__size")
    number = lambda place: F.floor((place - 1) / tile).cast("int")
    touched = rows.select("*", F.explode_outer(F.when(lo <= hi, F.sequence(number(lo), number(hi)))).alias("__no"))
    tiles = seqs.select(key, F.posexplode(F.regexp_extract_all("seq", F.lit(f"(?s).{{1,{tile}}}"), F.lit(0))).alias("__no", "__tile"))
    off = F.col("__no") * tile
    a, b = F.greatest(lo - off, F.lit(1)), F.least(hi - off, F.lit(tile))
    met = touched.join(tiles, [key, "__no"], "left").select(*given, "__size", "__from", "__to", F.struct("__no", F.substr("__tile", a, b - a + 1).alias("text")).alias("__part"))
    whole = met.groupBy(*given, "__size", "__from", "__to").agg(F.collect_set("__part").alias("__parts"), F.count("*").alias("__n"))
    text = F.array_join(F.transform(F.array_sort("__parts"), lambda x: x["text"]), "")
    return whole.select(*given, "__size", "__from", "__to", F.explode(F.array_repeat(text, (F.col("__n") / F.size("__parts")).cast("int"))).alias("__piece"))


def reverse_complement(seq: Column, iupac: bool = False) -> Column:
    """Complement of the reversed string, U as A's partner; with ``iupac`` for the ambiguity codes too."""
    if iupac:
        return F.reverse(F.translate(seq, "ACGTURYKMBVDHacgturykmbvdh", "TGCAAYRMKVBHDtgcaayrmkvbhd"))
    return F.reverse(F.translate(seq, "ACGTU", "TGCAA"))


def hamming(a: Column, b: Column) -> Column:
    """Unlike letters of two strings of one length (the shorter one bounds the comparison)."""
    return F.aggregate(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(x.isNotNull() & y.isNotNull() & (x != y), 1).otherwise(0)), F.lit(0), lambda s, x: s + x)


def phred(qual: Column, offset: int = 33) -> Column:
    """Quality values of a quality string."""
    return F.transform(letters(qual), lambda c: F.ascii(c) - offset)


def normalised(seq: Column) -> Column:
    """Upper case, U as T, other letters than ACGTN as N."""
    return F.regexp_replace(F.translate(F.upper(seq), "U", "T"), "[^ACGTN]", "N")


def half_up(x: Column) -> Column:
    """Nearest integer of a value that is not negative; halves go up."""
    return F.floor(x + 0.5)
