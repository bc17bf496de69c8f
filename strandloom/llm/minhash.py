"""Near-duplicate documents: banded MinHash candidates, odd sketches as a filter, full shingle sets as the judge.

* Every document gets ``SAMPLES`` MinHash samples. Groups of ``ROWS`` samples form ``BANDS`` band keys; all samples
  are folded into a parity bitmap (odd sketch) of ``BITS`` bits, whose XOR population count estimates the Jaccard
  similarity: -(n/2) ln(1 - 2d/n) samples differ.
* Documents with equal sets share a digest and become one representative before anything is paired.
* In each band bucket, members are paired with one hub only (the member that shares most buckets), which makes m - 1
  pairs of m members. What passes the sketch is confirmed on the full sets of both texts.
* The rest is exact: in every bucket that still holds several components, the members outside its largest one are compared
  with the bucket's members of other components, in blocks of both sides, by finer odd sketches; two members meet in the
  first bucket that they share only. Members that are near another one there come again with their full sets, which decide.

A pair at the threshold shares no band with probability under 1e-5. Null and empty texts have an empty set and link
with nothing; a text under five words is one shingle. Repeated rows are copies of each other. A null doc_id never
represents a group unless all its ids are null. Extra columns are ignored. A very long text is one set, held whole by the task
that reads it (about 15 bytes a byte, see textarrays). Ties between hubs go to the least id. Empty tables give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.components import components
from strandloom.functions.keys import fresh, matching, without
from strandloom.functions.scratch import result, scope, table
from strandloom.operators.table import numbered
from .textarrays import Words, mix, slices

SAMPLES, ROWS, BANDS, BITS = 128, 4, 25, 512
FINE_SAMPLES, FINE_BITS = 512, 2048
#: Shingles of one side of a block of the exact search, and of a task of small blocks.
BLOCK = 250_000
SLICE = 1 << 18


def _sets(texts: pa.Array, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, shingle hash), ordered by text and hash; what confirms takes another seed than what finds."""
    text, h = Words(texts, lower=True, seed=seed).shingles(5)
    order = np.argsort(h)
    order = order[np.argsort(text[order].astype(np.uint32), kind="stable")]
    text, h = text[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return text[new], h[new]


def _samples(h: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """MinHash samples, k rows by texts; ``first``: where each text's hashes begin."""
    rng = np.random.default_rng(7)
    out = np.empty((k, len(first)), np.uint64)
    for j, a in enumerate(rng.integers(1, 2**63, k, dtype=np.uint64) | np.uint64(1)):
        out[j] = np.minimum.reduceat(h * a, first)
    return out


def _odd(samples: np.ndarray, bits: int) -> np.ndarray:
    """Parity bitmaps of the numbered samples, texts by bits / 64 words."""
    k, n = samples.shape
    salted = mix(samples + (np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None])
    bit = (salted >> np.uint64(64 - int(math.log2(bits)))).astype(np.int64)
    count = np.bincount((bit + np.arange(n) * bits).ravel(), minlength=n * bits)
    return np.packbits((count & 1).astype(np.uint8).reshape(n, bits), axis=1).view(np.int64)


def _list(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, rows.shape[1]), pa.int32()), pa.array(rows.ravel(), kind))


def _features(batches):
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            text, h = _sets(part.column("text"))
            n = np.bincount(text, minlength=part.num_rows)
            full = np.flatnonzero(n)
            at = np.full(part.num_rows, -1)
            at[full] = np.arange(len(full))
            if len(full):
                first = np.searchsorted(text, full)
                samples = _samples(h, first, SAMPLES)
                grouped = samples[: ROWS * BANDS].reshape(BANDS, ROWS, -1)
                odd = np.arange(3, 2 * ROWS + 3, 2, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
                keys = mix((mix(grouped) * (odd | np.uint64(1))[None, :, None]).sum(axis=1, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)[:, None])
                sums = [np.add.reduceat(mix(h ^ np.uint64(c)), first) for c in (0x1234567, 0xFEDCBA987)]
                digest = np.stack([*sums, n[full].astype(np.uint64)], axis=1).astype(">u8")
            pick = pa.array(np.where(at < 0, None, at) if len(full) < part.num_rows else at, pa.int64())
            cols = [
                part.column("doc_id"), pa.array(n, pa.int64()),
                pa.array([r.tobytes() for r in digest], pa.binary()).take(pick) if len(full) else pa.nulls(part.num_rows, pa.binary()),
                _list(keys.T.view(np.int64), pa.int64()).take(pick) if len(full) else pa.nulls(part.num_rows, pa.list_(pa.int64())),
                _list(_odd(samples, BITS), pa.int64()).take(pick) if len(full) else pa.nulls(part.num_rows, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_shingles", "digest", "bands", "sketch"])


def _fine(batches):
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            text, h = _sets(part.column("text"), 1)
            if len(h):  # only texts with shingles come here
                full = np.unique(text)
                cut = np.append(np.searchsorted(text, full), len(h))
                odd = _odd(_samples(h, cut[:-1], FINE_SAMPLES), FINE_BITS)
                values = {
                    "id": part.column("id").take(pa.array(full)),
                    "n": pa.array(np.bincount(text)[full], pa.int64()),
                    "fine": pa.array([r.tobytes() for r in odd], pa.binary()),
                    "set": pa.array([h[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
                }
                yield pa.RecordBatch.from_arrays(list(values.values()), list(values))


def _confirm(percent: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text_u", SLICE):
                sides = []
                for c in ("text_u", "text_v"):
                    pair, h = _sets(part.column(c), 1)
                    sides.append((pair, h ^ mix(pair.astype(np.uint64) + np.uint64(1))))
                (pu, ku), (pv, kv) = sides
                m = part.num_rows
                both = np.bincount(pu[np.isin(ku, kv)], minlength=m)
                union = np.bincount(pu, minlength=m) + np.bincount(pv, minlength=m) - both
                ok = pa.array((100 * both >= percent * union) & (both > 0))
                yield pa.RecordBatch.from_arrays([part.column(c).filter(ok) for c in ("u", "v")], ["u", "v"])

    return run


def _furthest(percent: int, samples: int, bits: int, sigmas: float) -> int:
    """Most differing bits of odd sketches at which the similarity may still reach the threshold."""
    t = percent / 100
    low = max(0.05, t - sigmas * math.sqrt(t * (1 - t) / samples))
    return math.floor(bits / 2 * (1 - math.exp(-4 * samples * (1 - low) / bits)))


def _differ(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) of ids whose full shingle sets reach the threshold; texts: id, text."""
    side = lambda c: texts.select(F.col("id").alias(c), F.col("text").alias(f"text_{c}"))
    rows = pairs.join(side("u"), "u").join(side("v"), "v")
    return rows.select("u", "v", "text_u", "text_v").mapInArrow(_confirm(percent), "u long, v long").distinct()


def _cells(rows: pd.DataFrame):
    """The blocks among rows of a task: (first row, row after the last)."""
    place = rows[["key", "i", "j"]].to_numpy()
    cut = np.flatnonzero(np.append(True, (place[1:] != place[:-1]).any(axis=1)))
    return zip(cut, np.append(cut[1:], len(rows)), strict=True)


class _Members:
    """Members of blocks as arrays; ``near``: whom an asked member may link with and meets nowhere before."""

    def __init__(self, rows: pd.DataFrame, most: int, percent: int):
        self.sketch = np.frombuffer(b"".join(rows.fine), np.uint64).reshape(len(rows), -1)
        self.bands = np.stack(rows.bands.to_list())
        self.key, self.id, self.comp, self.n, self.asked = (rows[c].to_numpy() for c in ("key", "id", "comp", "n", "asked"))
        self.most, self.percent = most, percent

    def near(self, i: int, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``base`` near row i, and by how many bits they differ."""
        n, m = self.n[base], self.n[i]
        rest = base[(self.comp[base] != self.comp[i]) & (100 * np.minimum(n, m) >= self.percent * np.maximum(n, m))]
        differ = np.bitwise_count(self.sketch[i] ^ self.sketch[rest]).sum(axis=1, dtype=np.int64)
        hit = differ <= self.most
        rest, differ = rest[hit], differ[hit]
        shared = self.bands[rest] == self.bands[i]
        first = self.bands[i][shared.argmax(axis=1)] == self.key[i]
        return rest[first], differ[first]


def _near(most: int, percent: int):
    """The members of blocks that are near another one in it: (key, i, j, asked, id)."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["key", "i", "j"], kind="stable").reset_index(drop=True)
        members, flag = _Members(rows, most, percent), np.zeros(len(rows), bool)
        for a, b in _cells(rows):
            base = a + np.flatnonzero(~members.asked[a:b])
            for i in a + np.flatnonzero(members.asked[a:b]):
                hit, _ = members.near(i, base)
                flag[hit] = True
                flag[i] |= len(hit) > 0
        return rows.loc[flag, ["key", "i", "j", "asked", "id"]]

    return run


def _links(most: int, percent: int):
    """Of the near members of blocks and their sets: links, nearest first, one for each two components."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["key", "i", "j"], kind="stable").reset_index(drop=True)
        members, root, out = _Members(rows, most, percent), {}, []

        def find(c: int) -> int:
            while root.get(c, c) != c:
                c = root[c]
            return c

        for a, b in _cells(rows):
            base = a + np.flatnonzero(~members.asked[a:b])
            for i in a + np.flatnonzero(members.asked[a:b]):
                x = np.frombuffer(rows.set[i], np.uint64)
                hit, differ = members.near(i, base)
                for j in hit[np.argsort(differ, kind="stable")]:
                    u, v = find(members.comp[i]), find(members.comp[j])
                    if u != v:
                        y = np.frombuffer(rows.set[j], np.uint64)
                        at = np.searchsorted(y, x)
                        both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                        if 100 * both >= percent * (len(x) + len(y) - both):
                            root[max(u, v)] = min(u, v)
                            out.append((min(members.id[i], members.id[j]), max(members.id[i], members.id[j])))
        return pd.DataFrame(out, columns=["u", "v"]).astype("int64")

    return run


def _dealt(rows: DataFrame, size: str) -> DataFrame:
    """rows (key, i, j, ...) with ``task``: small blocks are packed so that a task takes about BLOCK of the sum of ``size``."""
    total = rows.agg(F.sum(size)).first()[0] or 0
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // BLOCK))
    return rows.withColumn("task", F.pmod(F.xxhash64("key", "i", "j"), F.lit(tasks)))


def _rest(shared: DataFrame, comp: DataFrame, reps: DataFrame, texts: DataFrame, percent: int) -> DataFrame | None:
    """Links between components that share a bucket (None: no bucket has two components)."""
    own = comp.select(F.col("id").alias("cid"), "component_id")
    member = shared.join(own, shared.id == own.cid, "left").select("key", "id", "n", F.coalesce("component_id", "id").alias("comp"))
    sizes = member.groupBy("key", "comp").agg(F.sum("n").alias("m"))
    mixed = sizes.groupBy("key").agg(F.max(F.struct("m", "comp"))["comp"].alias("most"), F.sum("m").alias("all"), F.max("m").alias("top"), F.count("*").alias("k")).where("k > 1")
    blocks = mixed.select("key", "most", F.ceil(F.col("all") / BLOCK).cast("int").alias("across"), F.ceil((F.col("all") - F.col("top")) / BLOCK).cast("int").alias("down"))
    member = table(member.join(blocks, "key"), "mixed")
    if member.isEmpty():
        return None
    ids = member.select("id").distinct()
    fine = matching(texts, "id", ids).mapInArrow(_fine, "id long, n long, fine binary, set binary").dropDuplicates(["id"]).drop("n")
    fine = table(fine.join(reps.select("id", "bands"), "id"), "fine")
    part = lambda c, n: F.pmod(F.xxhash64(c), n).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    base = member.withColumn("i", part("id", F.col("across"))).withColumn("j", every("down")).withColumn("asked", F.lit(False))
    asked = member.where("comp <> most").withColumn("j", part("id", F.col("down"))).withColumn("i", every("across")).withColumn("asked", F.lit(True))
    place = ["key", "i", "j", "asked", "id"]
    both = table(base.select(*place, "comp", "n").unionByName(asked.select(*place, "comp", "n")), "blocks")
    most = _furthest(percent, FINE_SAMPLES, FINE_BITS, 4.2)
    near = _dealt(both, "n").join(fine.select("id", "fine", "bands"), "id").groupBy("task")
    near = table(both.join(near.applyInPandas(_near(most, percent), "key long, i int, j int, asked boolean, id long"), place, "left_semi"), "near")
    sets = _dealt(near, "n").join(fine, "id").groupBy("task")
    return sets.applyInPandas(_links(most, percent), "u long, v long").distinct()


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row; links have 100 * intersection >= percent * union."""
    with scope(docs.sparkSession):
        return result(_near_duplicates(docs.select("doc_id", "text"), percent), "near-duplicates")


def _near_duplicates(docs: DataFrame, percent: int) -> DataFrame:
    feats = table(docs.mapInArrow(_features, "doc_id long, n_shingles long, digest binary, bands array<long>, sketch array<long>"), "minhash")
    firsts = [F.first(c).alias(n) for c, n in (("n_shingles", "n"), ("bands", "bands"), ("sketch", "sketch"))]
    reps = table(feats.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("id"), *firsts).where("id is not null"), "sets")
    keys = reps.select("id", "n", F.explode("bands").alias("key"))
    shared = table(keys.join(keys.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "key"), "buckets")
    ranked = shared.join(shared.groupBy("id").agg(F.sum("m").alias("degree")), "id")
    hubs = ranked.groupBy("key").agg(F.max(F.struct("degree", (-F.col("id")).alias("i")))["i"].alias("i")).select("key", (-F.col("i")).alias("hub"))
    pairs = shared.join(hubs, "key").where("id <> hub").select(F.least("id", "hub").alias("u"), F.greatest("id", "hub").alias("v")).distinct()
    size = F.col("nu") * 100 >= percent * F.col("nv"), F.col("nv") * 100 >= percent * F.col("nu")
    near = _differ(F.col("su"), F.col("sv")) <= _furthest(percent, SAMPLES, BITS, 4.75)
    side = lambda c: reps.select(F.col("id").alias(c), F.col("n").alias("n" + c), F.col("sketch").alias("s" + c))
    tested = table(pairs.join(side("u"), "u").join(side("v"), "v").where(size[0] & size[1] & near).select("u", "v"), "pairs")
    # the texts of all that shares a bucket, fetched once
    texts = docs.select(F.col("doc_id").alias("id"), "text").where("text is not null")
    texts = table(matching(texts, "id", shared.select("id")), "texts")
    links = table(confirm(tested, texts, percent), "links")
    comp = components(links)
    found = _rest(shared.select("key", "id", "n"), comp, reps, texts, percent)
    if found is not None:
        found = table(found, "links")
        if not found.isEmpty():
            comp = components(links.union(found))
    # repeated ids with unlike texts: each row follows its own text's representative
    group = reps.select("digest", "id").join(comp, "id", "left").select("digest", F.coalesce("component_id", "id").alias("component_id"))
    out = feats.select("doc_id", "n_shingles", "digest").join(group, "digest", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), 85)


def row_key(docs: DataFrame) -> Column:
    """128 bits that tell rows with unlike id or text apart."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.when(F.col("text").isNull(), "0").otherwise(F.concat(F.lit("1"), "text"))).cast("binary")))


def _repeated_ids(docs: DataFrame, percent: int) -> DataFrame:
    """Documents whose ids repeat or are null: one row of each id and text, numbered, is judged under its number."""
    key = fresh("row_key", docs)
    rows = table(docs.withColumn(key, row_key(docs)).dropDuplicates([key]), "rows")
    order = rows.select(F.col("doc_id").isNull().alias("lost"), "doc_id", F.col(key).alias("key"))
    numbers = table(numbered(order, ["lost", "doc_id", "key"], "number").select("key", "number"), "numbers")
    named = table(rows.select(F.col(key).alias("key"), "text").join(numbers, "key").select(F.col("number").alias("doc_id"), "text"), "named")
    gone = near_duplicates(named, percent).where("not kept").select(F.col("doc_id").alias("number"))
    return without(rows, key, table(numbers.join(gone, "number", "left_semi").select("key"), "near-copies")).drop(key)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline: one document of each group of near copies (similarity 0.8 or more) stays, that with the least id.

    Null and empty texts stay. Of repeated rows of one id and text one stays; rows of one id with unlike texts are documents of their
    own; a null id stands behind all others. Columns of any name go through untouched.
    """
    with scope(spark):
        odd = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null")
        if not odd.isEmpty():
            return result(_repeated_ids(docs, 80), "unlike")
        gone = result(near_duplicates(docs, 80).where("not kept").select("doc_id"), "near-copies")
    return without(docs, "doc_id", gone)


ORACLE = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * k >= 85 * (x.n + y.n - k)),
c(id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.u, c.r FROM c JOIN l ON l.v = c.id WHERE c.r < l.u)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.r AS component_id, d.doc_id = m.r AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT id, min(r) AS r FROM c GROUP BY 1) m ON m.id = d.doc_id
"""
