"""Substring dedup with a log-structured fingerprint index.

The index holds hashes of half-width word windows, thinned by winnowing: of all half windows inside a full window the
least hash is always taken, so two equal full windows share an indexed hash for certain. It is a list of immutable
runs (hash, times seen), each bucketed and sorted by hash, written once and never changed. A new batch

1. is hashed and counted by hash, and becomes a run of its own,
2. is merge-joined with every older run, bucket by bucket and without shuffling it: a hash is *repeated* if the batch holds
   it twice or an older run holds it too,
3. joins the runs; ``FANOUT`` runs of one level are merged into one of the next (compaction).

Repeated hashes say where to look: a Bloom bitmap (sized by their number, ``MOST_BITS`` at most) carries them to a scan of the
texts, of the batch and of the history that the index was built from. Every full window whose least half window may be
repeated is verified: it starts more than once if a second, independent hash of all its words occurs more than once beside the
same half-window hash (128 bits together). A fuller bitmap sends more windows to verification; it never loses one.

Null texts have no words. A text shorter than the window loses nothing. Rows are told apart by doc_id and text (a 64-bit
hash of both), so repeated ids, null ids and repeated rows (which are copies of each other) all get a result; ties are equal
rows with equal results. Empty tables give no rows. Extra columns of any name are ignored or go through untouched. A very long
text is held whole by the task that reads it (about 15 bytes a byte, see textarrays).
"""

from __future__ import annotations

import hashlib
import math
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.keys import marked
from strandloom.functions.scratch import new_path, result, scope, table
from .textarrays import Words, slices

WIDTH = 35
FANOUT = 4
SLICE = 1 << 18
#: Least and most bits (as powers of two) of the bitmap of repeated hashes; 32 bits for each hash as long as they last.
LEAST_BITS, MOST_BITS = 20, 28


def _slide(x: np.ndarray, n: int, fold) -> np.ndarray:
    """fold (minimum or maximum) of x[i:i+n] for every i (fewer at the end), by doubling."""
    have, out = 1, x
    while have < n:
        step = min(have, n - have)
        nxt = out.copy()
        fold(out[:-step], out[step:], out=nxt[:-step]) if step < len(out) else None
        out, have = nxt, have + step
    return out


def _winnowed(words: Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word positions chosen, their hashes, and for every word the least hash of the full window it starts, else 0)."""
    half = (width + 1) // 2
    span = width - half + 1
    n = len(words.hash)
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(n, np.uint64)
    last = np.repeat(words.first[1:], words.counts())
    full = np.arange(n) + width <= last
    h = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    at, hashes = words.windows(half)
    h[at] = hashes
    least = np.where(full, _slide(h, span, np.minimum), np.uint64(0))
    cover = _slide(least[::-1], span, np.maximum)[::-1]  # the largest minimum of the windows over each position
    chosen = np.flatnonzero((h == cover) & (cover > 0))
    return chosen, h[chosen], least


def _fingerprints(width: int, batches: int):
    def run(rows):
        for batch in rows:
            for part in slices(batch, "text", SLICE):
                words = Words(part.column("text"))
                at, h, _ = _winnowed(words, width)
                deal = (part.column("rid").to_numpy() % batches)[words.owner()[at]]
                for k in range(batches):
                    fp, n = np.unique(h[deal == k], return_counts=True)
                    if len(fp):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), k, np.int32)), pa.array(fp.view(np.int64)), pa.array(n.astype(np.int64))], ["batch", "fp", "n"])

    return run


class FingerprintIndex:
    """Immutable runs (fp, n) under ``path``, bucketed and sorted by fp; n: how often the hash was seen."""

    def __init__(self, spark: SparkSession, path: str, width: int = WIDTH, buckets: int | None = None):
        self.spark, self.path, self.width = spark, path, width
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.runs: list[tuple[int, str]] = []
        self.made = 0
        self._names: dict[str, str] = {}

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> FingerprintIndex:
        index = cls(spark, path)
        for r in spark.read.parquet(f"{path}/manifest").orderBy("version", "place").collect():
            index.made, index.width, index.buckets = max(index.made, r.version), r.width, r.buckets
            index.runs = [*(index.runs if r.place else []), (r.level, r.run)]
        return index

    def save(self) -> None:
        """Write the list of runs as a new version, so that ``open`` finds them."""
        self.made += 1
        rows = [(self.made, i, level, run, self.width, self.buckets) for i, (level, run) in enumerate(self.runs)]
        kind = "version int, place int, level int, run string, width int, buckets int"
        self.spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")

    def close(self) -> None:
        """Take the runs' names out of the session's catalog; the files stay."""
        for name in self._names.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._names.clear()

    def _read(self, run: str) -> DataFrame:
        if run not in self._names:
            self._names[run] = f"strandloom_run_{uuid.uuid4().hex}"
            how = f"USING parquet CLUSTERED BY (fp) SORTED BY (fp) INTO {self.buckets} BUCKETS LOCATION '{run}'"
            self.spark.sql(f"CREATE TABLE {self._names[run]} (fp BIGINT, n BIGINT) {how}")
        return self.spark.table(self._names[run])

    def _write(self, rows: DataFrame, level: int) -> str:
        self.made += 1
        run = f"{self.path}/run-{self.made:06d}-level-{level}"
        self._names[run] = f"strandloom_run_{uuid.uuid4().hex}"
        dealt = rows.select("fp", "n").repartition(self.buckets, "fp")
        dealt.write.bucketBy(self.buckets, "fp").sortBy("fp").format("parquet").option("path", run).saveAsTable(self._names[run])
        return run

    def compact(self) -> None:
        """Merge FANOUT runs of one level into one run of the next, as long as there are so many."""
        while True:
            levels = [level for level, _ in self.runs]
            full = next((x for x in sorted(set(levels)) if levels.count(x) >= FANOUT), None)
            if full is None:
                return
            run = self._write(self._merged([run for level, run in self.runs if level == full]), full + 1)
            self.runs = [x for x in self.runs if x[0] != full] + [(full + 1, run)]

    def add(self, fingerprints: DataFrame) -> DataFrame:
        """Add the hashes (fp, n) of a batch as a run; returns (fp): those that it holds twice or an older run holds too."""
        older = [run for _, run in self.runs]
        new = self._write(fingerprints.groupBy("fp").agg(F.sum("n").alias("n")), 0)
        own = self._read(new)
        hits = own.where("n > 1").select("fp")
        for run in older:
            hits = hits.union(own.join(self._read(run), "fp", "left_semi").select("fp"))
        hits = table(hits, "hits")
        self.runs.append((0, new))
        self.compact()
        return hits

    def hashes(self) -> DataFrame:
        """(fp, n) of all runs."""
        return self._merged([run for _, run in self.runs]) if self.runs else self.spark.createDataFrame([], "fp long, n long")

    def _merged(self, runs: list[str]) -> DataFrame:
        # read as plain files: Spark 4.1 takes a union of bucketed scans as dealt by bucket, which it is not
        return self.spark.read.schema("fp long, n long").parquet(*runs).groupBy("fp").agg(F.sum("n").alias("n"))


def _probes(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    return (h & mask).astype(np.int64), ((h >> np.uint64(64 - bits)) & mask).astype(np.int64)


def _bitmap(fps: DataFrame) -> np.ndarray:
    """Bloom bitmap of (fp), of at most 2**MOST_BITS bits."""
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(32 * max(1, fps.count())))))

    def run(batches):
        for batch in batches:
            at = np.unique(np.concatenate(_probes(np.asarray(batch.column("fp"), np.int64).view(np.uint64), bits)))
            word, first = np.unique(at >> 6, return_index=True)
            value = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first) if len(at) else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(value.view(np.int64))], ["word", "bits"])

    rows = fps.mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros((1 << bits) >> 6, np.int64)
    out[np.asarray(rows.column("word"), np.int64)] = np.asarray(rows.column("bits"), np.int64)
    return out


def _suspects(width: int, shared):
    """(rid, place, least, hash) of the full windows that may repeat.

    A window that starts twice within the slice is repeated for sure (``hash`` null); its first start goes on with its hash too.
    """

    def run(batches):
        bitmap = shared.value
        bits = len(bitmap).bit_length() + 5
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                words = Words(part.column("text"))
                least = _winnowed(words, width)[2]
                at = np.flatnonzero(least)
                x, y = _probes(least[at], bits)
                at = at[((bitmap[x >> 6] >> (x & 63)) & (bitmap[y >> 6] >> (y & 63)) & 1).astype(bool)]
                if not len(at):
                    continue
                starts, hashes = words.rehash(1).windows(width)
                a, v = hashes[np.searchsorted(starts, at)], least[at]
                row = words.owner()[at]
                order = np.lexsort((at, a, v))
                new = np.ones(len(order), bool)
                p, q = a[order], v[order]
                new[1:] = (p[1:] != p[:-1]) | (q[1:] != q[:-1])
                group = np.cumsum(new) - 1
                twice = np.zeros(len(at), bool)
                twice[order] = np.bincount(group)[group] > 1
                first = np.zeros(len(at), bool)
                first[order[new]] = True
                rid, place = part.column("rid").to_numpy()[row], (at - words.first[row]).astype(np.int32)
                sure, some = np.flatnonzero(twice), np.flatnonzero(first)
                pick = np.concatenate([sure, some])
                lone = np.zeros(len(pick), bool)
                lone[: len(sure)] = True
                values = [pa.array(rid[pick]), pa.array(place[pick]), *(pa.array(c[pick].view(np.int64), mask=lone) for c in (v, a))]
                yield pa.RecordBatch.from_arrays(values, ["rid", "place", "least", "hash"])

    return run


def _cut(width: int, texts: bool):
    """``row``, n_words, n_removed, and the kept words' digest (or text)."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                words = Words(part.column("text"))
                total = len(words.hash)
                places = part.column("places")
                at = np.asarray(places.flatten(), np.int64)
                at = at + np.repeat(words.first[:-1], pc.fill_null(pc.list_value_length(places), 0).to_numpy())
                cover = np.bincount(at, minlength=total + 1) - np.bincount(at + width, minlength=total + 1)[: total + 1]
                gone = np.cumsum(cover)[:total] > 0
                owner = words.owner()
                removed = np.bincount(owner[gone], minlength=part.num_rows)
                start, end = words.start[~gone], words.end[~gone]
                size = len(words.buf)
                step = np.zeros(size + 1, np.int8)
                step[start] += 1
                step[end] -= 1
                inside = np.cumsum(step[:size], dtype=np.int8) > 0 if size else np.zeros(0, bool)
                buf = np.array(words.buf)
                gap = end[end < words.offsets[1:][owner[~gone]]]  # the byte after a kept word, inside the same text
                inside[gap], buf[gap] = True, 0x20
                kept = buf[inside].tobytes()
                cut = np.concatenate([[0], np.cumsum(inside)])[words.offsets]
                values = [kept[i : j - 1] if j > i and kept[j - 1] == 0x20 else kept[i:j] for i, j in zip(cut[:-1], cut[1:], strict=True)]
                if texts:  # a text that loses nothing stays as it is
                    last = pc.if_else(pa.array(removed > 0), pa.array([v.decode("utf-8", "replace") for v in values], pa.string()), part.column("text"))
                else:
                    last = pa.array([hashlib.sha256(v).hexdigest() for v in values], pa.string())
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(words.counts(), pa.int64()), pa.array(removed, pa.int64()), last], ["row", "n_words", "n_removed", "kept"])

    return run


def _covered(base: DataFrame, hits: DataFrame, width: int) -> DataFrame:
    """(rid, places): where windows that start more than once among base (rid, text) begin."""
    shared = base.sparkSession.sparkContext.broadcast(_bitmap(hits))
    with scope(base.sparkSession):
        found = table(base.mapInArrow(_suspects(width, shared), "rid long, place int, least long, hash long"), "suspects")
        # one 64-bit hash of both finds nearly all that start once; the rest is compared in full
        found = found.withColumn("both", F.when(F.col("hash").isNotNull(), F.xxhash64("least", "hash")))
        often = found.where("both is not null").groupBy("both").agg(F.count("*").alias("n")).where("n > 1").select("both")
        kept = marked(found, "both", often, "often", 1 << 24).where("often or hash is null")
        maybe = result(kept.select("rid", "place", "least", "hash"), "maybe")  # the suspects go before the join
    open_ = maybe.where("hash is not null")
    twice = open_.groupBy("least", "hash").agg(F.count("*").alias("n")).where("n > 1").select("least", "hash")
    places = maybe.where("hash is null").select("rid", "place").union(open_.join(twice, ["least", "hash"], "left_semi").select("rid", "place"))
    return table(places.groupBy("rid").agg(F.collect_set("place").alias("places")), "covered")


def _enter(base: DataFrame, index: FingerprintIndex, batches: int) -> DataFrame:
    """Add base (rid, text) to the index in parts; (fp): the hashes that repeat."""
    marks = table(base.mapInArrow(_fingerprints(index.width, batches), "batch int, fp long, n long"), "fingerprints")
    hits = None
    for k in range(batches):
        more = index.add(marks.where(F.col("batch") == k).select("fp", "n"))
        hits = more if hits is None else hits.union(more)
    return hits.distinct()


def remove_repeats(docs: DataFrame, keep: list[str], width: int = WIDTH, batches: int = FANOUT, texts: bool = False, index: FingerprintIndex | None = None, history: DataFrame | None = None) -> DataFrame:
    """(row, n_words, n_removed, kept): row is a struct of the ``keep`` columns of docs (doc_id, text, ...), kept the kept words'
    SHA-256, or with ``texts`` the text without the removed words.

    docs enter the index in ``batches`` parts, by a hash of the row. Given an ``index`` with runs, docs are judged against what
    it has seen too; ``history`` are those documents (doc_id, text). Only docs come back.
    """
    spark = docs.sparkSession
    old = index is not None and bool(index.runs)
    if old and history is None:
        raise ValueError("an index with runs verifies against the documents it has seen: give them as history")
    width = index.width if index else width
    base = docs.select(F.xxhash64("doc_id", "text").alias("rid"), "text")
    with scope(spark):
        with scope(spark):
            own = index or FingerprintIndex(spark, new_path(spark, "index"), width)
            hits = result(_enter(base, own, batches), "repeated")
            if index is None:
                own.close()
        seen = base.union(history.select(F.xxhash64("doc_id", "text"), "text")) if old else base
        covered = result(_covered(seen, hits, width), "covered")
    wide = docs.select(F.xxhash64("doc_id", "text").alias("rid"), "text", F.struct(*keep).alias("row"))
    split = marked(wide, "rid", covered.select("rid"), "hit")
    touched = split.where("hit").join(covered, "rid", "left").select("row", "text", "places")
    rest = split.where("not hit").select("row", "text", F.lit(None).cast("array<int>").alias("places"))
    kind = wide.select("row").schema.add("n_words", "long").add("n_removed", "long").add("kept", "string")
    return touched.union(rest).mapInArrow(_cut(width, texts), kind)


def op3_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs, ["doc_id"]).select("row.doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline: repeated windows of 35 words are cut out; a document left without words goes; n_chars follows the text.

    Null and empty texts stay as they are. Columns of any other name go through untouched.
    """
    out = remove_repeats(docs, [c for c in docs.columns if c != "text"], texts=True).where("n_removed = 0 or n_words > n_removed")
    value = {c: F.col("row").getField(c) for c in docs.columns if c != "text"} | {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        value["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept").cast(docs.schema["n_chars"].dataType)).otherwise(value["n_chars"])
    return out.select(*[value[c].alias(c) for c in docs.columns])


ORACLE = """
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT doc_id, unnest(range(1, len(ws) - 33)) AS p, unnest(list_transform(range(1, len(ws) - 33), lambda i: md5(array_to_string(ws[i:i + 34], ' ')))) AS g FROM w WHERE len(ws) >= 35
), r AS (SELECT g FROM s GROUP BY 1 HAVING count(*) > 1),
c AS (SELECT DISTINCT doc_id, p + o AS p FROM s JOIN r USING (g), (SELECT unnest(range(0, 35)) AS o)),
t AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM w),
k AS (SELECT t.doc_id, count(c.p) AS n_removed, coalesce(string_agg(CASE WHEN c.p IS NULL THEN x END, ' ' ORDER BY t.p), '') AS kept FROM t LEFT JOIN c ON c.doc_id = t.doc_id AND c.p = t.p GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN k USING (doc_id)
"""
