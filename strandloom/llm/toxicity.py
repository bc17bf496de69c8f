"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

1. At most ``MAX_LABELLED`` labelled rows are the sample to fit on. Document counts of every hashed n-gram by class over
   all of them, summed per task and then by bucket.
2. The log-count ratio r of each bucket; the buckets with most evidence become features.
3. Logistic weights over r-scaled binary features, fitted on at most ``MAX_FIT`` rows of the sample (chosen by hash).
4. Every whole text is scored in one scan without a shuffle, in blocks of at most ``BLOCK`` letters that end at a blank (or in a word
   longer than that); the largest block's score is the text's. So a text's length alone neither raises its score nor hides a passage.
   The model's size is fixed by ``BUCKETS`` and ``FEATURES``.

Null and empty texts have no n-gram and get the intercept's score. A document with several labels is toxic if one
label says so; null labels are left out. With labels of one class only, or none, the score is the (smoothed) share of
toxic labels. Repeated rows are scored alike; ties between buckets go to the lower one; empty tables give no rows. Extra columns
of any name go through untouched. A very long text is scored whole, block by block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.scratch import scope, table
from .textarrays import slices

ORDERS = (3, 4, 5, 6)
BITS = 21
BUCKETS = 1 << BITS
FEATURES = 4096
#: Letters of a block; most documents are one.
BLOCK = 8192
#: Bytes of text hashed at a time, so that the arrays stay in the cache.
SLICE = 1 << 17
#: Most labelled rows that the classifier is fitted on, and most of them for the logistic weights.
MAX_LABELLED, MAX_FIT = 20_000, 4000


def _grams(texts: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Code points of all texts, one blank before and after each, and for each text its n-gram buckets."""
    padded = [f" {' '.join(t.lower().split())} " if t else "" for t in texts]
    ends = np.cumsum([0, *map(len, padded)])
    cp = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n, h, out = len(cp), np.zeros(len(cp), np.uint32), []
    for k in range(1, max(ORDERS) + 1):
        m = max(0, n - k + 1)
        h = h[:m] * np.uint32(0x01000193) + cp[k - 1 :] if k > 1 else cp + np.uint32(1)
        if k in ORDERS:
            x = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * k)
            out.append((x >> np.uint32(32 - BITS)).view(np.int32))
    return ends, out


def _each(texts: list[str]):
    """Per text, its n-gram buckets (with repeats)."""
    ends, orders = _grams(texts)
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        yield np.concatenate([h[a : max(a, b - k + 1)] for k, h in zip(ORDERS, orders, strict=True)])


def _count(batches):
    acc, n = np.zeros((2, BUCKETS), np.int32), [0, 0]
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            for label, b in zip(part.column("label").to_pylist(), _each(part.column("text").to_pylist()), strict=True):
                acc[label][b] += 1  # once for each distinct bucket
                n[label] += 1
    at = np.flatnonzero(acc[0] + acc[1])
    at = np.append(at, BUCKETS)
    neg, pos = np.append(acc[0], n[0])[at], np.append(acc[1], n[1])[at]
    for i in range(0, len(at), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(x[i : i + (1 << 16)]) for x in (at.astype(np.int64), neg, pos)], ["bucket", "neg", "pos"])


def _present(texts: list[str], mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, bucket) pairs, by text, of the buckets that ``mask`` holds."""
    ends, orders = _grams(texts)
    pairs = []
    for k, h in zip(ORDERS, orders, strict=True):
        hit = np.flatnonzero(mask[h])
        text = np.searchsorted(ends, hit, side="right") - 1
        inside = hit + k <= ends[text + 1]
        pairs.append((text[inside] << BITS) | h[hit[inside]])
    pairs = np.unique(np.concatenate(pairs))
    return pairs >> BITS, pairs & (BUCKETS - 1)


def _features(select: np.ndarray):
    """select: for each bucket its feature number or -1."""

    def run(batches):
        mask = select >= 0
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                text, bucket = _present(part.column("text").to_pylist(), mask)
                f, cut = select[bucket], np.searchsorted(text, np.arange(part.num_rows + 1))
                rows = [f[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("label").cast(pa.int32()), pa.array(rows, pa.binary())], ["label", "features"])

    return run


def _logistic(rows: list[tuple[int, np.ndarray]], scale: np.ndarray, l2: float = 0.01, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights of the features and the intercept: Nesterov's gradient method on the r-scaled binary rows (kept sparse)."""
    y = np.array([r[0] for r in rows], np.float64)
    feature = np.concatenate([r[1] for r in rows]).astype(np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    value = scale[feature].astype(np.float64)
    norm = max(1e-6, float(np.sqrt(np.bincount(row, value * value, minlength=len(rows))).mean()))
    value /= norm
    times = lambda z: np.bincount(row, value * z[feature], minlength=len(rows))
    back = lambda e: np.bincount(feature, value * e[row], minlength=len(scale))
    p0 = (y.sum() + 0.5) / (len(y) + 1)
    w, b = np.zeros(len(scale)), float(np.log(p0 / (1 - p0)))
    v, top = np.ones(len(scale)) / np.sqrt(len(scale)), 0.0
    for _ in range(12):  # the curvature's largest eigenvalue sets the step
        v = back(times(v))
        top = float(np.linalg.norm(v))
        v /= max(top, 1e-12)
    rate = 1.0 / (0.25 * (top + len(y)) + l2)
    zw, zb = w.copy(), b
    for k in range(steps):
        e = 1 / (1 + np.exp(-(times(zw) + zb))) - y
        nw, nb = zw - rate * (back(e) + l2 * zw), zb - rate * float(e.sum())
        m = k / (k + 3)
        zw, zb = nw + m * (nw - w), nb + m * (nb - b)
        w, b = nw, nb
    return (w * scale / norm).astype(np.float32), b


def blocks(text: str) -> list[str]:
    """The text in parts of at most BLOCK letters, cut at blanks where there are any."""
    out, at = [], 0
    while len(text) - at > BLOCK:
        cut = text.rfind(" ", at + 1, at + BLOCK)
        cut = cut if cut > at else at + BLOCK
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


def _grouped(texts: list[str]):
    """(text of each block, blocks) in groups of about SLICE letters."""
    owner, parts, held = [], [], 0
    for i, t in enumerate(texts):
        for b in blocks(t):
            owner.append(i)
            parts.append(b)
            held += len(b)
            if held >= SLICE:
                yield np.array(owner), parts
                owner, parts, held = [], [], 0
    if parts:
        yield np.array(owner), parts


class Model:
    """weights: one per bucket (zero where the bucket is no feature)."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def scores(self, texts: list[str]) -> np.ndarray:
        x, mask = np.full(len(texts), -np.inf), self.weights != 0
        for owner, parts in _grouped(texts):
            text, bucket = _present(parts, mask)
            np.maximum.at(x, owner, self.bias + np.bincount(text, self.weights[bucket], minlength=len(parts)))
        return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def labelled(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, text, label) of at most ``most`` labelled documents, chosen by a hash of the id.

    The bound makes the label table fit for a broadcast, so no text is shuffled.
    """
    one = labels.where(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("label"))
    chosen = table(one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most), "labels")
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where(F.col("text").isNotNull())


def fit(rows: DataFrame, max_fit: int = MAX_FIT) -> Model:
    """rows: doc_id, text, label (0 or 1)."""
    counts = table(rows.select("label", "text").mapInArrow(_count, "bucket long, neg long, pos long").groupBy("bucket").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos")), "counts")
    last = counts.where(F.col("bucket") == BUCKETS).agg(F.sum("neg"), F.sum("pos")).first()
    n0, n1 = last[0] or 0, last[1] or 0
    prior = float(np.log((n1 + 0.5) / (n0 + 0.5))) if n0 + n1 else 0.0
    weights = np.zeros(BUCKETS, np.float32)
    if not n0 or not n1:
        return Model(weights, prior)
    p = (F.col("pos") + F.col("neg")) / (n0 + n1)
    z = (F.col("pos") / n1 - F.col("neg") / n0) / F.sqrt(F.greatest(p * (1 - p), F.lit(1e-9)))
    best = counts.where(F.col("bucket") < BUCKETS).orderBy(F.abs(z).desc(), "bucket").limit(FEATURES).collect()
    at, neg, pos = (np.array([r[c] for r in best]) for c in ("bucket", "neg", "pos"))
    scale = (np.log((pos + 0.5) / (n1 + 1)) - np.log((neg + 0.5) / (n0 + 1))).astype(np.float32)
    select = np.full(BUCKETS, -1, np.int32)
    select[at] = np.arange(len(at))
    share = min(1.0, max_fit / (n0 + n1))
    chosen = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000)) if share < 1 else rows
    got = chosen.select("label", "text").mapInArrow(_features(select), "label int, features binary").toArrow()
    data = list(zip(got.column("label").to_pylist(), (np.frombuffer(f, np.int32) for f in got.column("features").to_pylist()), strict=True))
    if len({y for y, _ in data}) < 2:
        weights[at] = scale * 0.1
        return Model(weights, prior)
    w, bias = _logistic(data, scale)
    weights[at] = w
    return Model(weights, bias)


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """(row, score): a struct of the ``keep`` columns of docs, and the score of ``text``."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((np.flatnonzero(model.weights).astype(np.int32), model.weights[model.weights != 0], model.bias))
    wide = docs.select(F.struct(*keep).alias("row"), *([] if "text" in keep else ["text"]))

    def run(batches):
        at, w, bias = shared.value
        weights = np.zeros(BUCKETS, np.float32)
        weights[at] = w
        own = Model(weights, bias)
        for batch in batches:
            if "text" in keep:  # the text travels once
                batch = batch.append_column("text", pc.struct_field(batch.column("row"), "text"))
            for part in slices(batch, "text", SLICE):
                s = own.scores([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(s, pa.float64())], ["row", "score"])

    return wide.mapInArrow(run, wide.select("row").schema.add("score", "double"))


def in_fold(doc_id: Column) -> Column:
    """True for held-out documents: crc32 of doc_id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of the labels outside the held-out fold."""
    with scope(docs.sparkSession):
        return fit(labelled(docs, labels.where(~in_fold(F.col("doc_id")))))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), ["doc_id"]).select("row.doc_id", "score")
    return scored.select("doc_id", in_fold(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline: documents that the classifier rejects (score 0.5 or more) go; all columns of any name stay as they are."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model, docs.columns).where(F.col("score") < 0.5).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
