"""Near-duplicate vectors by product quantisation: inverted lists, residual codes, table look-ups, exact rerank.

* Equal vectors are one representative with a multiplicity.
* A coarse quantiser (about ``LIST`` vectors a list) and residual codebooks (``PARTS`` subspaces of ``CODES`` centroids)
  are fitted on at most ``TRAIN`` vectors chosen by hash; every vector is indexed: list, codes, and how far its code is
  from it. Each number of dimensions is a group of its own; one of at most ``CODES`` vectors is compared without codes.
* Every vector is a query. It visits its nearest lists: ``PROBES``, or as many more as it takes until a visit joins the
  share ``REACH`` of pairs made at cosine ``least`` from held-out vectors, and of the held-out vectors' own pairs.
* A pair is found if either end visits the other's list. If only one does, that visit counts the link for both ends.
* In a visited list a table of distances between the query's residual and
  all subspace centroids gives the distance to each code by ``PARTS`` look-ups. A vector can only be within the radius
  if its code is within radius plus the code's own error, so the filter loses nothing in a visited list.
* What passes is reranked by exact cosine in double precision; a link needs ``least`` or more.

Each task returns counts of links per query and a spanning set of links, never all pairs of a group. Large lists are cut
into blocks of both sides.

Vectors that are null, zero, or hold null or non-finite components link with nothing, nor do rows without vec_id. Repeated rows are links of each other. Rows of one vec_id with
unlike vectors are one vertex. Empty tables give no rows. Extra columns, labels too, are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.components import components
from strandloom.functions.scratch import table

TRAIN, LIST, PARTS, CODES, PROBES, REACH = 20_000, 512, 16, 64, 12, 0.98
INDEXED, ASKED = 4096, 16_384


def _means(x: np.ndarray, k: int, rng: np.random.Generator, steps: int = 8, unit: bool = False) -> np.ndarray:
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(steps):
        near = _nearest(x, c)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=len(c))[:, None]
        c = np.where(n > 0, total / np.maximum(n, 1), c)
        if unit:
            c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    half = (c * c).sum(axis=1) / 2
    return np.concatenate([(x[i : i + 4096] @ c.T - half).argmax(axis=1) for i in range(0, len(x), 4096)]) if len(x) else np.zeros(0, int)


class Quantiser:
    """centroids: lists by dimensions; books: for each part its subspace centroids; cuts: where the parts begin."""

    def __init__(self, sample: np.ndarray, lists: int, parts: int = PARTS, codes: int = CODES):
        rng = np.random.default_rng(11)
        x = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        self.centroids = _means(x, lists, rng, unit=True)
        rest = x - self.centroids[_nearest(x, self.centroids)]
        self.cuts = np.linspace(0, x.shape[1], min(parts, x.shape[1]) + 1).astype(int)
        self.books = [_means(rest[:, a:b], codes, rng) for a, b in zip(self.cuts[:-1], self.cuts[1:], strict=True)]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lists, codes and code errors of unit vectors."""
        near = _nearest(x, self.centroids)
        rest = x - self.centroids[near]
        parts = list(zip(self.cuts[:-1], self.cuts[1:], strict=True))
        codes = np.stack([_nearest(rest[:, a:b], book) for (a, b), book in zip(parts, self.books, strict=True)], axis=1)
        made = np.concatenate([book[codes[:, k]] for k, book in enumerate(self.books)], axis=1)
        return near, codes.astype(np.uint8), np.linalg.norm(rest - made, axis=1)

    def probes(self, x: np.ndarray, n: int) -> np.ndarray:
        away = -(x @ self.centroids.T) + (self.centroids**2).sum(axis=1) / 2
        n = min(n, len(self.centroids))
        return np.argpartition(away, n - 1, axis=1)[:, :n]

    def enough(self, held: np.ndarray, others: np.ndarray, least: float, reach: float) -> int:
        """The fewest probes that join the share ``reach`` of pairs of held-out unit vectors: with others at cosine ``least`` or more, and at just ``least`` from them in random directions and in those of others."""
        rng, most = np.random.default_rng(12), 1
        a, b = [], []
        for i in range(0, len(held), 256):
            u, v = np.nonzero(held[i : i + 256] @ others.T >= least)
            u, first = np.unique(u, return_index=True)
            a.append(held[i + u])
            b.append(others[v[first]])
        pairs = [(np.concatenate(a), np.concatenate(b))] if a else []
        for to in (rng.normal(size=held.shape), others[rng.integers(0, len(others), len(held))]):
            to = to - (to * held).sum(axis=1, keepdims=True) * held
            size = np.linalg.norm(to, axis=1, keepdims=True)
            some = size[:, 0] > 1e-9
            pairs.append((held[some], least * held[some] + np.sqrt(max(0.0, 1 - least * least)) * to[some] / size[some]))
        for x, y in pairs:
            if len(x):
                need = np.minimum(self._rank(x, y), self._rank(y, x))
                most = max(most, int(np.quantile(need, reach, method="higher")))
        return most

    def _rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many lists x visits until it comes to y's."""
        away = (self.centroids**2).sum(axis=1) / 2 - x @ self.centroids.T
        return (away <= away[np.arange(len(x)), _nearest(y, self.centroids)][:, None]).sum(axis=1)

    def distances(self, x: np.ndarray, which: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances of queries to the codes of one list, by table look-ups."""
        rest = x - self.centroids[which]
        out = np.zeros((len(x), len(codes)), np.float32)
        for k, (a, b) in enumerate(zip(self.cuts[:-1], self.cuts[1:], strict=True)):
            lookup = ((rest[:, None, a:b] - self.books[k][None]) ** 2).sum(axis=2).astype(np.float32)
            out += lookup[:, codes[:, k]]
        return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    x = vectors.astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _encode(shared):
    def run(batches):
        for mixed in batches:
            sizes = mixed.column("d").to_numpy()
            for d in np.unique(sizes):
                batch = mixed.filter(pa.array(sizes == d))
                raw = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
                if d in shared.value:
                    quantiser, probes = shared.value[d]
                    x = _unit(raw)
                    near, codes, error = quantiser.encode(x)
                    visit = quantiser.probes(x, probes)
                else:  # few vectors: one list without codes
                    near, codes, error, visit = np.zeros(len(raw), int), np.zeros((len(raw), 0), np.uint8), np.zeros(len(raw)), np.zeros((len(raw), 1), int)
                kind = pa.ListArray.from_arrays(pa.array(np.arange(0, visit.size + 1, visit.shape[1]), pa.int32()), pa.array(visit.ravel().astype(np.int32)))
                rows = lambda m: pa.array([r.tobytes() for r in m], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("d"), batch.column("rep"), batch.column("copies"), pa.array(near.astype(np.int32)), rows(codes), pa.array(error), rows(raw), kind], ["d", "rep", "copies", "own", "codes", "error", "vector", "probes"])

    return run


def _least_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least vertex that each vertex reaches."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _search(shared, least: float):
    radius = float(np.sqrt(max(0.0, 2 - 2 * least)))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        asked, held = rows[rows.asked], rows[~rows.asked]
        out = []
        if len(asked) and len(held):
            (quantiser, _), which = shared.value.get(int(rows.d.iloc[0]), (None, 1)), int(rows.list.iloc[0])
            codes = np.frombuffer(b"".join(held.codes), np.uint8).reshape(len(held), -1)
            y, q = (np.frombuffer(b"".join(s.vector), np.float64).reshape(len(s), -1) for s in (held, asked))
            y, q = _unit(y), _unit(q)
            limit = ((radius + held.error.to_numpy() + 1e-5) ** 2).astype(np.float32)
            ids, copies, own, times, home = held.rep.to_numpy(), held.copies.to_numpy(), asked.rep.to_numpy(), asked.copies.to_numpy(), asked.own.to_numpy()
            # whether a held vector, for its part, visits a list
            visit = np.stack(held.probes.to_list())
            back = np.zeros((len(held), max(visit.max(), home.max()) + 1), bool)
            back[np.arange(len(held))[:, None], visit] = True
            # vertices by id, so that a component's least label is its least id
            names, place = np.unique(np.concatenate([own, ids]), return_inverse=True)
            found = np.zeros(len(names), np.int64)
            ends = []
            for i in range(0, len(q), 256):
                part = q[i : i + 256]
                a, b = np.nonzero(quantiser.distances(part, which, codes) <= limit if quantiser else part @ y.T >= least - 1e-9)
                other = own[i + a] != ids[b]
                a, b = a[other], b[other]
                ok = np.einsum("ij,ij->i", part[a], y[b]) >= least
                a, b = a[ok], b[ok]
                if len(a):
                    at = place[: len(own)][i + a]
                    to = place[len(own) :][b]
                    np.add.at(found, at, copies[b])
                    lone = ~back[b, home[i + a]]
                    np.add.at(found, to[lone], times[i + a[lone]])
                    ends.append((at, to))
            if ends:
                label = _least_labels(len(names), np.concatenate([e[0] for e in ends]), np.concatenate([e[1] for e in ends]))
                some = np.flatnonzero((found > 0) | (label != np.arange(len(names))))
                out = np.stack([names[some], names[label[some]], found[some]], axis=1)
        return pd.DataFrame(out if len(out) else np.zeros((0, 3), np.int64), columns=["u", "v", "n"])

    return run


def near_vectors(vectors: DataFrame, least: float = 0.9, probes: int = PROBES, train: int = TRAIN) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of vectors (vec_id, embedding)."""
    spark = vectors.sparkSession
    e = F.col("embedding")
    sound = F.col("vec_id").isNotNull() & e.isNotNull() & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(e, lambda x: x != 0)
    rows = vectors.select("vec_id", e.cast("array<double>").alias("embedding")).withColumn("sound", F.coalesce(sound, F.lit(False)))
    loose = rows.where(~F.col("sound")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    reps = table(rows.where("sound").groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")).withColumn("d", F.size("embedding")), "vectors")
    sizes = {r.d: r["count"] for r in reps.groupBy("d").count().collect()}
    if not sizes:
        return loose
    trained = {}
    for d, n in sizes.items():
        if n > CODES:
            sample = reps.where(F.col("d") == d).orderBy(F.xxhash64("rep"), "rep").limit(train).select("embedding").toArrow().column("embedding").combine_chunks().flatten().to_numpy()
            sample = _unit(np.asarray(sample, np.float64).reshape(-1, d))
            held, others = np.split(sample, [len(sample) // 10])
            quantiser = Quantiser(others, max(1, min(n // LIST, len(sample) // 16)))
            trained[d] = (quantiser, max(probes, quantiser.enough(held, others, least, REACH)))
    shared = spark.sparkContext.broadcast(trained)
    index = table(reps.mapInArrow(_encode(shared), "d int, rep long, copies long, own int, codes binary, error double, vector binary, probes array<int>"), "index")
    asked = index.select("d", "rep", "copies", "own", "vector", F.explode("probes").alias("list"))
    index = index.withColumn("list", F.col("own"))
    held = index.groupBy("d", "list").agg(F.ceil(F.count("*") / INDEXED).cast("int").alias("across"))
    visits = asked.groupBy("d", "list").agg(F.ceil(F.count("*") / ASKED).cast("int").alias("down"))
    blocks = held.join(visits, ["d", "list"])
    part = lambda c: F.pmod(F.xxhash64("rep"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    columns = ["d", "list", "i", "j", "asked", "rep", "copies", "own", "codes", "error", "vector", "probes"]
    nothing = {"codes": F.lit(None).cast("binary"), "error": F.lit(None).cast("double"), "probes": F.lit(None).cast("array<int>")}
    left = index.join(blocks, ["d", "list"]).withColumn("i", part("across")).withColumn("j", every("down")).withColumn("asked", F.lit(False)).select(*columns)
    right = asked.join(blocks, ["d", "list"]).withColumn("j", part("down")).withColumn("i", every("across")).withColumn("asked", F.lit(True)).withColumns(nothing).select(*columns)
    found = table(left.unionByName(right).groupBy("d", "list", "i", "j").applyInPandas(_search(shared, least), "u long, v long, n long"), "found")
    comp = components(found.select("u", "v"))
    links = found.groupBy(F.col("u").alias("rep")).agg(F.sum("n").alias("n"))
    whole = reps.join(links, "rep", "left").join(comp.withColumnRenamed("id", "rep"), "rep", "left")
    whole = whole.select("embedding", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id"))
    joined = rows.where("sound").join(whole, "embedding").select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    return joined.union(loose)


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
c(id, r) AS (SELECT vec_id, vec_id FROM v UNION SELECT l.u, c.r FROM c JOIN l ON l.v = c.id WHERE c.r < l.u)
SELECT v.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, m.r AS component_id, v.vec_id = m.r AS kept
FROM v LEFT JOIN (SELECT u, count(*) AS n FROM l GROUP BY 1) n ON n.u = v.vec_id JOIN (SELECT id, min(r) AS r FROM c GROUP BY 1) m ON m.id = v.vec_id
"""
