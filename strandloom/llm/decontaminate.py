"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, weighted-shingle similarity.

For every length of a benchmark item, the windows of so many words of a document are candidates if enough of their
shingles can be benchmark shingles (a Bloom bitmap of fixed size, which never misses one; a window with fewer cannot
reach the threshold). A window's SimHash is the sign of the summed bits of its shingles' hashes. Items are entered in an
index under their length and every value of each of ``BLOCKS`` bit blocks that is at most RADIUS // BLOCKS bits away, so any
two fingerprints of one length within RADIUS meet in a block for certain. Pairs that meet are verified: the sum of the least weights over
the sum of the largest weights of their shingles (five words, weighted by number of occurrences) must reach 0.8.

Words are lower-cased (A-Z). A text of fewer than five words is one shingle; a document shorter than an item is a
window of its own, for each length of items that it can match. Null or empty texts and items match nothing. Repeated rows are
judged alike; ties of similarity go to the least start and then the least window. Empty tables give no rows. Extra columns of any
name are ignored. A very long text is held whole by the task that reads it (see textarrays); its windows leave it in blocks.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.keys import fresh, without
from strandloom.functions.scratch import result, scope, table
from .textarrays import Words, mix, slices

SHINGLE, PERCENT = 5, 80
RADIUS, BLOCKS, BLOCK_BITS = 19, 4, 16
BLOOM_BITS = 23
SLICE = 1 << 19


def _bits(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 64 bits of every hash."""
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int8) * 2 - 1


def _sign(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view(np.uint64).ravel()


def _items(batches):
    for batch in batches:
        text, h = Words(batch.column("text"), lower=True).shingles(SHINGLE)
        words = Words(batch.column("text"), lower=True).counts()
        first = np.searchsorted(text, np.arange(batch.num_rows + 1))
        rows = []
        for i in np.flatnonzero(words):
            own = h[first[i] : first[i + 1]]
            rows.append({"item_id": batch.column("item_id")[int(i)].as_py(), "n_words": int(words[i]), "item_print": int(_sign(_bits(own).astype(np.int64).sum(axis=0)[None]).view(np.int64)[0]), "item_shingles": np.sort(own).tobytes()})
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("item_id", pa.int64()), ("n_words", pa.int32()), ("item_print", pa.int64()), ("item_shingles", pa.binary())]))


def _probes(hashes: np.ndarray) -> list[np.ndarray]:
    return [((hashes >> np.uint64(s)) & np.uint64((1 << BLOOM_BITS) - 1)).astype(np.int64) for s in (0, 31)]


def _windows(bloom, lengths):
    """Candidate windows: doc_id, start, words, the length of the items to compare with, print, and the window's shingles."""

    def run(batches):
        bitmap = np.unpackbits(np.frombuffer(bloom.value, np.uint8)).astype(bool)
        sizes = np.array(lengths.value, np.int64)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                words = Words(part.column("text"), lower=True)
                n = len(words.hash)
                counts, first = words.counts(), words.first
                at, h = words.windows(SHINGLE)
                hash_at, hit = np.zeros(n, np.uint64), np.zeros(n, bool)
                hash_at[at] = h
                x, y = _probes(h)
                hit[at[bitmap[x] & bitmap[y]]] = True
                before = np.concatenate([[0], np.cumsum(hit)])
                owner = words.owner()
                last = first[1:][owner]
                out = {"doc_id": [], "start": [], "words": [], "n_words": [], "print": [], "shingles": []}
                ids = part.column("doc_id")

                def put(starts, size, matrix, item=None, ids=ids, owner=owner, first=first, out=out):
                    """Add windows; matrix: a row of shingle hashes for each; item: the items' length, if another."""
                    for i in range(0, len(starts), 1024):
                        s, m = starts[i : i + 1024], np.sort(matrix[i : i + 1024], axis=1)
                        sums = (np.unpackbits(m.view(np.uint8).reshape(*m.shape, 8), axis=2, bitorder="little").sum(axis=1, dtype=np.int32) * 2 - m.shape[1])
                        out["doc_id"] += ids.take(pa.array(owner[s])).to_pylist()
                        out["start"] += (s - first[owner[s]]).tolist()
                        out["words"] += [int(size)] * len(s)
                        out["n_words"] += [int(item or size)] * len(s)
                        out["print"] += _sign(sums).view(np.int64).tolist()
                        out["shingles"] += [r.tobytes() for r in m]

                touched = np.flatnonzero(hit)
                for size in sizes:
                    if size < SHINGLE:
                        w, hw = words.windows(int(size))
                        hw = mix(hw + np.uint64(size)) if len(hw) else hw
                        x, y = _probes(hw)
                        ok = bitmap[x] & bitmap[y]
                        put(w[ok], size, hw[ok][:, None])
                        continue
                    if not len(touched):
                        continue
                    k = int(size) - SHINGLE + 1
                    need = -(-PERCENT * k // 100)
                    near = np.zeros(n + 1, np.int64)
                    np.add.at(near, np.maximum(touched - k + 1, 0), 1)
                    np.add.at(near, touched + 1, -1)
                    starts = np.flatnonzero(np.cumsum(near)[:n] > 0)
                    starts = starts[(starts + size <= last[starts])]
                    starts = starts[before[starts + k] - before[starts] >= need]
                    put(starts, size, hash_at[starts[:, None] + np.arange(k)])
                for i in np.flatnonzero((counts > 0) & (counts < sizes.max(initial=0))):  # shorter than some item: itself a window
                    s, c = int(first[i]), int(counts[i])
                    if c >= SHINGLE:
                        held = before[s + c - SHINGLE + 1] - before[s]
                        for size in sizes[sizes > c]:
                            if 100 * held >= PERCENT * (size - SHINGLE + 1):  # its shingles can reach the share
                                put(np.array([s]), c, hash_at[None, s : s + c - SHINGLE + 1], size)
                if out["doc_id"]:
                    yield pa.RecordBatch.from_pydict(out, schema=_WINDOW.insert(0, pa.field("doc_id", ids.type)))

    return run


_WINDOW = pa.schema([("start", pa.int32()), ("words", pa.int32()), ("n_words", pa.int32()), ("print", pa.int64()), ("shingles", pa.binary())])


def _counted(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle salted by its row, occurrences), sorted by the salted shingle."""
    h = np.frombuffer(b"".join(rows), np.uint64)
    row = np.repeat(np.arange(len(rows)), [len(r) // 8 for r in rows])
    key, at, n = np.unique(h ^ mix(row.astype(np.uint64) + np.uint64(1)), return_index=True, return_counts=True)
    return row[at], key, n


def _similar(batches):
    keep = ["doc_id", "start", "words", "item_id"]
    for whole in batches:
        for i in range(0, whole.num_rows, 2000):
            batch = whole.slice(i, 2000)
            m = batch.num_rows
            (rx, x, nx), (ry, y, ny) = (_counted(batch.column(c).to_pylist()) for c in ("shingles", "item_shingles"))
            at = np.minimum(np.searchsorted(y, x), max(0, len(y) - 1))
            both = y[at] == x
            least = np.bincount(rx[both], np.minimum(nx[both], ny[at[both]]), minlength=m)
            sims = least / np.maximum(1, np.bincount(rx, nx, minlength=m) + np.bincount(ry, ny, minlength=m) - least)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(sims, pa.float64())], [*keep, "similarity"])


def _masks() -> list[int]:
    """All values of a block with at most RADIUS // BLOCKS bits set."""
    return [sum(1 << i for i in c) for r in range(RADIUS // BLOCKS + 1) for c in combinations(range(BLOCK_BITS), r)]


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, words, similarity): the best window of every document and item with 0.8 or more."""
    with scope(docs.sparkSession):
        return result(_matches(docs.select("doc_id", "text"), benchmark.select("item_id", "text")), "matches")


def _matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    items = table(benchmark.mapInArrow(_items, "item_id long, n_words int, item_print long, item_shingles binary"), "items")
    bloom = _bloom(items)
    lengths = sorted(r.n_words for r in items.select("n_words").distinct().collect())
    sc = docs.sparkSession.sparkContext
    own = docs.schema["doc_id"].dataType.simpleString()
    kind = f"doc_id {own}, start int, words int, n_words int, print long, shingles binary"
    found = table(docs.mapInArrow(_windows(sc.broadcast(bloom), sc.broadcast(lengths)), kind), "windows")
    block = lambda c, k: F.shiftrightunsigned(c, k * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int")
    keys = lambda c: F.explode(F.array(*[F.struct(F.lit(k).alias("k"), block(F.col(c), k).alias("v")) for k in range(BLOCKS)])).alias("b")
    near = F.explode(F.from_json(F.lit(str(_masks())), "array<int>")).alias("m")
    entered = items.select("item_id", "n_words", "item_print", keys("item_print")).select("*", near)
    entered = entered.select("item_id", "n_words", "item_print", F.col("b.k").alias("k"), F.col("b.v").bitwiseXOR(F.col("m")).alias("v"))
    # equal windows (copies of a passage) meet the index once
    prints = found.select("print", "n_words").distinct().select("print", "n_words", keys("print")).select("print", "n_words", F.col("b.k").alias("k"), F.col("b.v").alias("v"))
    # the entered rows are thousands for each item: merged, never broadcast
    met = prints.join(entered.hint("merge"), ["n_words", "k", "v"]).where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS).select("print", "n_words", "item_id").distinct()
    pairs = found.join(met, ["print", "n_words"]).join(items.select("item_id", "item_shingles"), "item_id")
    sims = pairs.select("doc_id", "start", "words", "item_id", "shingles", "item_shingles").mapInArrow(_similar, f"doc_id {own}, start int, words int, item_id long, similarity double")
    best = F.max(F.struct("similarity", (-F.col("start")).alias("s"), (-F.col("words")).alias("w")))
    got = sims.where(F.col("similarity") >= PERCENT / 100).groupBy("doc_id", "item_id").agg(best.alias("b"))
    return got.select("doc_id", "item_id", (-F.col("b.s")).alias("start"), (-F.col("b.w")).alias("words"), F.col("b.similarity").alias("similarity"))


def _bloom(items: DataFrame) -> bytes:
    """Bitmap of the items' shingles: 2**BLOOM_BITS bits, whatever their number."""

    def run(batches):
        bits = np.zeros(1 << BLOOM_BITS, bool)
        for batch in batches:
            for s in batch.column("item_shingles").to_pylist():
                for p in _probes(np.frombuffer(s, np.uint64)):
                    bits[p] = True
        at = np.flatnonzero(np.packbits(bits))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.packbits(bits)[at].astype(np.int64))], ["at", "byte"])

    rows = items.select("item_shingles").mapInArrow(run, "at long, byte long").groupBy("at").agg(F.bit_or("byte").alias("byte")).toArrow()
    out = np.zeros((1 << BLOOM_BITS) // 8, np.uint8)
    out[np.asarray(rows.column("at"), np.int64)] = np.asarray(rows.column("byte"), np.int64).astype(np.uint8)
    return out.tobytes()


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline: documents that hold a benchmark item go; null and empty texts stay, columns of any name go through.

    Whether one goes depends on its text alone, whatever other texts share its id.
    """
    text = fresh("text_key", docs)
    keyed = docs.withColumn(text, F.unhex(F.md5(F.col("text").cast("binary"))))
    found = matches(keyed.select(F.col(text).alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without(keyed, text, found.select("doc_id")).drop(text)
