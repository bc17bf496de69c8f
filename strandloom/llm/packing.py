"""Best-fit packing of token pieces by a grouping genetic algorithm on islands.

Pieces are dealt by hash into blocks of about ``BLOCK`` pieces. On every block several islands evolve their own
populations, which start from unlike packings: best fit in orders of length disturbed by ``NOISE`` of each member, so from
longest-first to nearly random. A crossover injects whole well-filled bins of one parent into the other, removes the bins
that hold their pieces a second time, and best-fits the displaced pieces, longest first but for a little noise; a mutation
then breaks up the emptiest bins and a few others and best-fits their pieces. A child replaces its receiving parent if it is
fitter (fewer bins, then mean square fill). Every epoch does all its ``CROSSOVERS``. Between epochs each island's elite goes to
the next island of its block. The best packing of a block wins; the pieces of bins that are not well filled are dealt again
into fewer blocks and evolve once more. ``report`` tells how many bins the evolution saved.

Null texts are empty; every document has at least its end mark, so an empty one is a piece of one token. Only documents
longer than a sequence are cut: full pieces, the first may be shorter. Rows that are equal in all columns used are
counted first and each gets its own place. Ties of fitness go to the older packing, ties of room to the lower bin. Null ids are
kept. Empty tables give no pieces. Extra columns of any name are ignored. A very long text is tokenised whole by one task.
"""

from __future__ import annotations

import base64
import zlib
from array import array
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.scratch import result, scope, table
from .textarrays import slices

CAPACITY, BLOCK, ISLANDS, EPOCHS, CROSSOVERS = 2048, 4096, 2, 2, 20
#: How much the order of length is disturbed for each member of a population.
NOISE = (0.0, 0.05, 0.1, 0.2, 0.5, 2.0)
#: Bins filled to this share stay as they are after the first round.
WELL = 0.99
_WORKER: dict = {}


class _Encoder:
    """Token ids (little-endian unsigned 32 bit) of whole texts.

    ``ranks`` names a file with the same vocabulary as byte-pair ranks; it gives the tokenizer's ids several times as
    fast. Texts that spell a special token, and all texts where no ranks are given, go through the tokenizer itself.
    """

    def __init__(self, path: str, ranks: str | None):
        from tokenizers import Tokenizer

        self.tokenizer, self.fast = Tokenizer.from_file(path), None
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if ranks:
            import public_tokenizers
            import tiktoken

            pairs = (line.split() for line in open(ranks, "rb"))
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for t in texts:
            if self.fast is None or any(x in t for x in self.special):
                out.append(np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes())
            else:
                out.append(array("I", self.fast.encode_ordinary(t)).tobytes())
        return out


def _pieces(path: str, ranks: str | None, capacity: int):
    def run(batches):
        if path not in _WORKER:
            _WORKER[path] = _Encoder(path, ranks)
        encoder = _WORKER[path]
        for batch in batches:
            for part in slices(batch, "text", 1 << 19):
                out = []
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder.encode([t or "" for t in part.column("text").to_pylist()]), strict=True):
                    ids += b"\0\0\0\0"
                    n = len(ids) // 4
                    first = n % capacity or min(n, capacity)
                    edges = [0, *range(first, n + 1, capacity)]
                    out += [(doc_id, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))]
                yield pa.RecordBatch.from_pylist([dict(zip(("doc_id", "piece", "start", "length", "ids_crc32"), o, strict=True)) for o in out], schema=_PIECE)

    return run


_PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


_STATE = pa.schema([("block", pa.int64()), ("island", pa.int32()), ("elite", pa.binary()), ("bins", pa.int64()), ("square", pa.float64()), ("began", pa.int64()), ("crossed", pa.int64()), ("used", pa.int64())])


def _best_fit(lengths: np.ndarray, order: np.ndarray, bins: np.ndarray, room: list[int], capacity: int) -> None:
    """Place the pieces of ``order`` into the fullest bin that still takes them; bins: piece to bin, room: per bin."""
    free = sorted((r, b) for b, r in enumerate(room) if r > 0)
    for i in order:
        n = int(lengths[i])
        at = bisect_left(free, (n, -1))
        if at < len(free):
            r, b = free.pop(at)
        else:
            b, r = len(room), capacity
            room.append(capacity)
        bins[i] = b
        room[b] = r - n
        if r > n:
            insort(free, (r - n, b))


def _fitness(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> tuple[int, float]:
    fill = np.bincount(bins, lengths)
    return -len(fill), float(((fill / capacity) ** 2).mean())


def _compact(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1].astype(np.int32)


def _refit(lengths: np.ndarray, bins: np.ndarray, displaced: np.ndarray, rng: np.random.Generator, capacity: int) -> np.ndarray:
    """Best-fit the displaced pieces into what is left, longest first but for a little noise."""
    out = np.full(len(lengths), -1, np.int32)
    kept = _compact(bins[~displaced])
    out[~displaced] = kept
    room = (capacity - np.bincount(kept, lengths[~displaced]).astype(np.int64)).tolist()
    left = np.flatnonzero(displaced)
    noisy = lengths[left] * (1 + rng.normal(0, 0.05, len(left)))
    _best_fit(lengths, left[np.argsort(-noisy, kind="stable")], out, room, capacity)
    return out


def _cross(lengths: np.ndarray, a: np.ndarray, b: np.ndarray, rng: np.random.Generator, capacity: int) -> np.ndarray:
    """Whole well-filled bins of ``a`` go into ``b``."""
    fill = np.bincount(a, lengths)
    good = np.flatnonzero(fill >= np.quantile(fill, 0.5))
    chosen = rng.choice(good, max(1, len(good) // 20), replace=False)
    brought = np.isin(a, chosen)
    gone = np.unique(b[brought])  # bins that would hold a piece twice
    displaced = np.isin(b, gone) & ~brought
    return _refit(lengths, np.where(brought, a + int(b.max()) + 1, b), displaced, rng, capacity)


def _mutate(lengths: np.ndarray, bins: np.ndarray, rng: np.random.Generator, capacity: int) -> np.ndarray:
    """Break up the emptiest bins and about one in a hundred of the others."""
    fill = np.bincount(bins, lengths)
    worst = np.argsort(fill, kind="stable")[: rng.integers(1, 4)]
    some = rng.choice(len(fill), max(1, len(fill) // 100), replace=False)
    return _refit(lengths, bins, np.isin(bins, np.concatenate([worst, some])), rng, capacity)


def _seeded(lengths: np.ndarray, rng: np.random.Generator, capacity: int, noise: float) -> np.ndarray:
    """Best fit in order of length, disturbed by ``noise``."""
    out, room = np.full(len(lengths), -1, np.int32), []
    _best_fit(lengths, np.argsort(-lengths * (1 + rng.normal(0, noise, len(lengths))), kind="stable"), out, room, capacity)
    return out


def _evolve(lengths: np.ndarray, people: list[np.ndarray], rng: np.random.Generator, capacity: int, crossovers: int = CROSSOVERS) -> tuple[list, int]:
    """The population after so many crossovers, rated and best first, and how many children replaced their parent."""
    rated = sorted(((_fitness(lengths, p, capacity), -i, p) for i, p in enumerate(people)), key=lambda r: r[:2], reverse=True)
    used = 0
    for k in range(crossovers if len(lengths) > 1 else 0):
        i, j = rng.choice(len(rated), 2, replace=False)
        child = _mutate(lengths, _cross(lengths, rated[i][2], rated[j][2], rng, capacity), rng, capacity)
        fit = _fitness(lengths, child, capacity)
        if fit > rated[j][0]:
            rated[j], used = (fit, -len(people) - k, child), used + 1
            rated.sort(key=lambda r: r[:2], reverse=True)
    return rated, used


def _epoch(capacity: int):
    """One epoch of an island: (block, island, epoch, lengths, elite, migrant) to the same with a new elite."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.frombuffer(row["lengths"], np.int32).astype(np.int64)
                rng = np.random.default_rng([row["block"], row["island"], row["epoch"]])
                people = [np.frombuffer(x, np.int32) for x in (row["elite"], row["migrant"]) if x]
                people += [_seeded(lengths, rng, capacity, x) for x in NOISE[len(people) :]]
                rated, used = _evolve(lengths, people, rng, capacity)
                (bins, square), _, best = rated[0]
                began = min(int(p.max()) + 1 for p in people)
                values = (row["block"], row["island"], best.tobytes(), bins, square, began, CROSSOVERS, used)
                yield pa.RecordBatch.from_pylist([dict(zip(_STATE.names, values, strict=True))], schema=_STATE)

    return run


def _pack_blocks(pieces: DataFrame, blocks: int, capacity: int, report: list | None) -> DataFrame:
    """pieces (with ``copy``) to the same with block, bin and fill."""
    names = [c for c in pieces.columns]
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "copy", F.lit(blocks)), F.lit(blocks)))
    own = F.sort_array(F.collect_list(F.struct("length", *[c for c in names if c != "length"])), asc=False)
    items = table(dealt.groupBy("block").agg(own.alias("items")), "blocks")
    lengths = F.transform("items", lambda x: x["length"].cast("int"))
    packed = items.select("block", lengths.alias("l")).mapInArrow(_as_bytes, "block long, lengths binary")
    state = packed.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1)))).withColumn("elite", F.lit(None).cast("binary")).withColumn("migrant", F.lit(None).cast("binary"))
    kind = "block long, island int, elite binary, bins long, square double, began long, crossed long, used long"
    epochs = []
    # these rows are small but dear, so their number of tasks follows the blocks and not the bytes
    tasks = min(blocks * ISLANDS, max(int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")), blocks * ISLANDS // 64))
    for epoch in range(EPOCHS):
        evolved = table(state.withColumn("epoch", F.lit(epoch)).repartition(tasks, "block", "island").mapInArrow(_epoch(capacity), kind), "islands")
        epochs.append(evolved)
        if epoch + 1 < EPOCHS:
            moved = evolved.select("block", ((F.col("island") + 1) % ISLANDS).alias("island"), F.col("elite").alias("migrant"))
            state = packed.join(evolved.select("block", "island", "elite"), "block").join(moved, ["block", "island"])
    best = evolved.groupBy("block").agg(F.max_by("elite", F.struct("bins", "square", "island")).alias("elite"))
    if report is not None:
        began = epochs[0].groupBy("block").agg(F.min("began").alias("began")).agg(F.sum("began")).first()[0]
        ended = evolved.groupBy("block").agg((-F.max("bins")).alias("ended")).agg(F.sum("ended")).first()[0]
        tried = [e.agg(F.sum("crossed"), F.sum("used")).first() for e in epochs]
        report.append({"blocks": blocks, "bins_before": began, "bins_after": ended, "crossovers": sum(t[0] for t in tried), "used": sum(t[1] for t in tried)})
    return items.join(best, "block").mapInArrow(_unpack(capacity, names), _kind(pieces, names))


def _as_bytes(batches):
    for batch in batches:
        rows = [np.array(x, np.int32).tobytes() for x in batch.column("l").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(rows, pa.binary())], ["block", "lengths"])


def _kind(pieces: DataFrame, names: list[str]):
    return pieces.select(*names).schema.add("block", "long").add("bin", "long").add("offset", "long").add("fill", "long")


def _unpack(capacity: int, names: list[str]):
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                items = batch.column("items").slice(row, 1).flatten()
                bins = np.frombuffer(batch.column("elite")[row].as_py(), np.int32)
                length = np.asarray(items.field("length"), np.int64)
                order = np.argsort(bins, kind="stable")
                ends = np.cumsum(length[order])
                fill = np.bincount(bins, length).astype(np.int64)
                offset = np.empty(len(bins), np.int64)
                offset[order] = ends - length[order] - (np.cumsum(fill) - fill)[bins[order]]
                block = np.full(len(bins), batch.column("block")[row].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([*(items.field(c) for c in names), pa.array(block), pa.array(bins.astype(np.int64)), pa.array(offset), pa.array(fill[bins])], [*names, "block", "bin", "offset", "fill"])

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, report: list | None = None) -> DataFrame:
    """pieces (doc_id, piece, start, length, ids_crc32) with sequence_id and offset.

    A sequence's number is made of its round, block and bin, so no two share one. ``report`` gets, for each of the two rounds,
    blocks, bins before and after, crossovers and how many of them were used.
    """
    with scope(pieces.sparkSession):
        return result(_pack(pieces, capacity, report), "packing")


def _number(turn: int, low: Column) -> Column:
    return F.lit(turn << 60).cast("long").bitwiseOR(low).alias("sequence_id")


def _pack(pieces: DataFrame, capacity: int, report: list | None) -> DataFrame:
    names = pieces.columns
    counted = pieces.groupBy(*names).agg(F.count("*").alias("copies"))
    single = table(counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies"), "pieces")
    rest = single.where(F.col("length") < capacity)
    n = rest.count()
    # full pieces by partition and row of the written table
    done = single.where(F.col("length") == capacity).select(*names, _number(0, F.monotonically_increasing_id()), F.lit(0).cast("long").alias("offset"))
    if n:
        placed = lambda df, turn: df.select(*names, _number(turn, F.shiftleft("block", 24).bitwiseOR(F.col("bin"))), "offset")
        first = table(_pack_blocks(rest, max(1, -(-n // BLOCK)), capacity, report), "packed")
        loose = first.where(F.col("fill") < F.lit(WELL * capacity))
        m = loose.count()
        done = done.union(placed(first.where(F.col("fill") >= F.lit(WELL * capacity)), 1))
        if m:
            done = done.union(placed(_pack_blocks(loose.select(*names, "copy"), max(1, -(-m // BLOCK)), capacity, report), 2))
    return done


def pack_documents(docs: DataFrame, tokenizer: str | None = None, ranks: str | None = None, capacity: int = CAPACITY, report: list | None = None) -> DataFrame:
    """Tokenise whole texts, add id 0, cut what is longer than a sequence, pack."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer, ranks = (str(public_tokenizers.path(f"byte_bpe_50k.{x}")) for x in ("json", "tiktoken"))
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return pack(docs.select("doc_id", "text").mapInArrow(_pieces(tokenizer, ranks, capacity), kind), capacity, report)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline: the packed pieces of all documents."""
    return pack_documents(docs)
