"""Spelling variant grouping: words that differ by one letter, found by sorted permuterm rotations.

1. Words are counted per task, then over all documents; a word counts if it is long and frequent enough.
2. A word marked with the terminator ``$`` has one rotation for each of its places. Rotated so that an edited letter comes last,
   ``b$a`` + letter, all words that have another letter there share the prefix ``b$a``; the word without that letter has ``b$a`` as a
   whole rotation. So replacements and indels are rows with one prefix, the edited letter skipped.
3. Rotations are sorted by that prefix; a prefix holds at most one whole rotation and one for each letter of the alphabet, so
   its rows are scanned together without a bound on the vocabulary mattering. Each row gets the number and the best of its neighbours
   in it (never all pairs); a letter doubled in a word stands for its run once. Each pair of near words shares exactly one such row.
4. A word's form is the near word of largest count (ties: the smaller word) if that is ``times`` as frequent; roots follow forms by
   doubling, as many rounds as the logarithm of the longest chain.

Words longer than ``LONG`` letters have fingerprints (93 bits) of their rotations in place of the rotations, so that their cost is
linear in their length. Null and empty texts have no words; null ids count as empty ones for ``damage``. Repeated rows count as often
as they come. Empty tables give no rows. Extra columns of any name are ignored. A text is held whole by the task that reads it,
with its words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.scratch import result, scope, table
from strandloom.operators.table import numbered
from .textarrays import slices

LETTERS, TIMES, OFTEN = 6, 5, 5
LONG = 48
SLICE = 1 << 20
#: Distinct words that a task holds before it passes its counts on.
HELD = 500_000
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_PRIMES, _BASES = (2147483647, 2147483629, 2147483587), (1103515245, 1220703125, 1566083941)


def damage(word: str, base: int) -> str:
    """Delete the letter at h % length if 199 divides h, the CRC-32 of ``<doc_id>:<word>`` (base: that of ``<doc_id>:``)."""
    h = zlib.crc32(word.encode(), base)
    if h % 199:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def _counted(least: int, damaged: bool):
    run_of = re.compile(f"[a-z\\u00C0-\\u00FF]{{{least},}}")

    def run(batches):
        total: Counter[str] = Counter()
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    if not text:
                        continue
                    words = Counter(run_of.findall(text.encode().translate(_LOWER).decode()))
                    if damaged:
                        base = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                        for word, n in words.items():
                            total[damage(word, base)] += n
                    else:
                        total.update(words)
                if len(total) > HELD:
                    yield _counts(total)
                    total = Counter()
        yield _counts(total)

    return run


def _counts(total: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])


def vocabulary(docs: DataFrame, letters: int = LETTERS, often: int = OFTEN, damaged: bool = False) -> DataFrame:
    """(word, n): runs of letters, A-Z lowered, of at least ``letters`` letters and ``often`` occurrences in all texts."""
    counted = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(_counted(letters, damaged), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where((F.col("n") >= often) & (F.char_length("word") >= letters))


def _powers(base: int, n: int, p: int) -> np.ndarray:
    out = np.ones(n, np.int64)
    have = 1
    while have < n:
        step = min(have, n - have)
        out[have : have + step] = out[:step] * pow(base, have, p) % p
        have += step
    return out


def rotation_prints(word: str, edited: bool) -> list[str]:
    """Fingerprints of the rotations of word + $: without the letter at each place, or (not edited) whole, cut before each place."""
    cp = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.int64)
    n, prints = len(cp), []
    for p, base in zip(_PRIMES, _BASES, strict=True):
        up, down = _powers(base, n + 2, p), _powers(pow(base, -1, p), n + 2, p)
        prefix = np.append(0, np.cumsum(cp * up[:n] % p)) % p
        i = np.arange(n) if edited else np.arange(n + 1)
        skip = i + 1 if edited else i  # b begins here, a ends at i
        b = (prefix[n] - prefix[skip]) % p * down[skip] % p
        prints.append((b + 36 * up[n - skip] + prefix[i] * up[n - skip + 1]) % p)
    size = n - 1 if edited else n
    return [f"#{size}:{x}:{y}:{z}" for x, y, z in zip(*(q.tolist() for q in prints), strict=True)]


def _long_rotations(batches):
    for batch in batches:
        for part in slices(batch, "word", 1 << 16):
            for rank, word, n in zip(*(part.column(c).to_pylist() for c in ("id", "word", "n")), strict=True):
                keys, single, whole = [], [], []
                if len(word) > LONG + 1:
                    keys += rotation_prints(word, True)
                    single += [i == 0 or word[i - 1] != word[i] for i in range(len(word))]
                    whole += [False] * len(word)
                keys += rotation_prints(word, False)
                single += [True] * (len(word) + 1)
                whole += [True] * (len(word) + 1)
                m = len(keys)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array([rank] * m, pa.int64()), pa.array([n] * m, pa.int64()), pa.array(whole), pa.array(single)], ["key", "id", "n", "whole", "single"])


def _rotations(words: DataFrame) -> DataFrame:
    """words (id, word, n): (key, id, n, whole, single); single: the first letter of its run, so that an indel counts once."""
    i = F.col("i")
    a = F.expr("substring(word, 1, i)")
    short = words.where(F.char_length("word") <= LONG + 1)
    places = short.select("id", "word", "n", F.explode(F.sequence(F.lit(0), F.char_length("word") - 1)).alias("i"))
    single = (i == 0) | (F.expr("substring(word, i, 1)") != F.expr("substring(word, i + 1, 1)"))
    edited = places.select(F.concat(F.expr("substring(word, i + 2)"), F.lit("$"), a).alias("key"), "id", "n", F.lit(False).alias("whole"), single.alias("single"))
    places = short.where(F.char_length("word") <= LONG).select("id", "word", "n", F.explode(F.sequence(F.lit(0), F.char_length("word"))).alias("i"))
    whole = places.select(F.concat(F.expr("substring(word, i + 1)"), F.lit("$"), a).alias("key"), "id", "n", F.lit(True).alias("whole"), F.lit(True).alias("single"))
    long = words.where(F.char_length("word") > LONG).select("id", "word", "n").mapInArrow(_long_rotations, "key string, id long, n long, whole boolean, single boolean")
    return edited.union(whole).union(long)


def neighbours(words: DataFrame) -> DataFrame:
    """words (id, word, n; ids in the words' order): (id, n_near, best: struct<n, id>) of all words with near words."""
    row = F.struct((-F.col("n")).alias("m"), "id", "whole", "single")
    groups = _rotations(words).groupBy("key").agg(F.array_sort(F.collect_list(row)).alias("rows")).where(F.size("rows") > 1)
    near = lambda x, y: (x["id"] != y["id"]) & ~(x["whole"] & y["whole"]) & (~(x["whole"] | y["whole"]) | (x["single"] & y["single"]))
    found = groups.select(F.explode(F.transform("rows", lambda x: F.struct(x["id"].alias("id"), F.filter("rows", lambda y: near(x, y)).alias("others")))).alias("g"))
    found = found.where(F.size("g.others") > 0).select("g.id", F.size("g.others").alias("k"), F.col("g.others")[0].alias("first"))
    return found.groupBy("id").agg(F.sum("k").cast("long").alias("n_near"), F.min(F.struct("first.m", "first.id")).alias("least")).select("id", "n_near", F.struct((-F.col("least.m")).alias("n"), F.col("least.id").alias("id")).alias("best"))


def variants(vocab: DataFrame, times: int = TIMES) -> DataFrame:
    """vocab (word, n; distinct words): word, form, root, n, n_near, form_n."""
    with scope(vocab.sparkSession):
        words = table(numbered(table(vocab.select("word", "n"), "words"), ["word"], "id"), "numbered")
        near = table(words.join(neighbours(words), "id", "left"), "neighbours")
        has_form = F.col("best.n") >= times * F.col("n")
        near = near.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has_form, F.col("best.id")).alias("form_id"), F.when(has_form, F.col("best.n")).alias("form_n"))
        roots = table(near.select("id", F.coalesce("form_id", "id").alias("root")), "roots")
        while True:
            onward = roots.select(F.col("id").alias("at"), F.col("root").alias("next"))
            now = table(roots.join(onward, F.col("root") == F.col("at")).select("id", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "roots")
            roots = now.select("id", "root")
            if now.where("moved").isEmpty():
                break
        named = lambda c: words.select(F.col("id").alias(f"{c}_id"), F.col("word").alias(c))
        out = near.join(named("form"), "form_id", "left").join(roots.withColumnRenamed("root", "root_id"), "id").join(named("root"), "root_id")
        return result(out.select("word", "form", "root", "n", "n_near", "form_n"), "variants")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return variants(vocabulary(docs, damaged=True))


ORACLE = """
WITH RECURSIVE t AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)), lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS tab
), r AS (
  SELECT doc_id, w, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{00C0}-\\x{00FF}]+')) AS w FROM documents
  ) GROUP BY 1, 2
), x AS (SELECT w, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)) AS z FROM r WHERE length(w) >= 6),
c AS (
  SELECT w, n, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(length(z) // 2), lambda i: CAST('0x' || substr(z, 2 * i + 1, 2) AS BIGINT))),
    lambda s, b: xor(s >> 8, tab[1 + (xor(s, b) & 255)]))) AS h FROM x, t
), v AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM c
  ) GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5
), d AS (SELECT word, n, i, substr(word, 1, i) AS a, substr(word, i + 2) AS b FROM v, LATERAL (SELECT unnest(range(0, length(word))) AS i)),
near AS (
  SELECT DISTINCT x.word AS u, y.word AS v FROM d x JOIN d y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT x.word, v.word FROM d x JOIN v ON v.word = x.a || x.b UNION SELECT v.word, x.word FROM d x JOIN v ON v.word = x.a || x.b
), f AS (
  SELECT u, count(*) AS n_near, arg_min(near.v, (-y.n, near.v)) AS best, max(y.n) AS most FROM near JOIN v y ON y.word = near.v GROUP BY 1
), g AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * n THEN best END AS form, CASE WHEN most >= 5 * n THEN most END AS form_n FROM v LEFT JOIN f ON f.u = v.word
), k AS (
  SELECT word, word AS root, 0 AS depth FROM g UNION ALL SELECT k.word, g.form, depth + 1 FROM k JOIN g ON g.word = k.root WHERE g.form IS NOT NULL
)
SELECT g.word, g.form, m.root, g.n, CAST(g.n_near AS BIGINT) AS n_near, g.form_n FROM g JOIN (SELECT word, arg_max(root, depth) AS root FROM k GROUP BY 1) m USING (word)
"""
