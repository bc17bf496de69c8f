"""Suffix-array dedup: the difference-cover algorithm over every byte that can belong to a repeat.

Two equal strings of ``width`` bytes hold the same least hash of a ``GRAM``-byte string at the same place, their anchor. So

1. every text is scanned for its anchors; each anchor owns the run of starts whose string it is the anchor of. Anchors whose hash
   turns up once own nothing that could repeat (they are counted by hash, in part before the shuffle);
2. what the others own is dealt to buckets by the anchor's hash: equal strings meet, and no string needs a second bucket. Equal
   pieces enter a bucket as one, with a weight; a text with copies weighs as many;
3. in every bucket the difference-cover algorithm (residues 1 and 2 modulo 3) sorts all suffixes: triples at sampled places are
   sorted and named, the names are sorted by recursion, the remaining suffixes are merged in;
4. neighbours in that order that share ``width`` bytes, and all of a piece that weighs more than one, are repeated;
5. each text drops the bytes that a repeated string covers.

Anchors with more than ``HOT`` occurrences deal their starts, by distance from the anchor, to buckets of their own. What repeats is
decided by the bytes alone; hashes only say what meets. Texts are known by a digest of 128 bits.

Null texts are empty; a text shorter than ``width`` loses nothing. Equal texts, whether or not their ids are equal, lose everything
(of ``width`` bytes or more) alike, so ties and repeated rows have one result, and null ids are ids like others. An empty table gives
no rows. Extra columns of any name are ignored. A text is held whole by the task that reads it (about 60 bytes for each byte of a
stretch of ``STRETCH``); a bucket holds about ``BUCKET`` bytes of pieces.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.keys import marked
from strandloom.functions.scratch import result, scope, table
from .textarrays import mix, powers, slices

WIDTH, GRAM = 200, 64
#: Anchors with more occurrences deal their starts to buckets of their own, STEP distances each.
HOT, STEP = 2000, 16
BUCKET = 1 << 20
STRETCH = 1 << 22
SLICE = 1 << 18
_MUL = 0x9E6C63D0676A9A99
_LETTER = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _order(key: np.ndarray) -> np.ndarray:
    """The places of integers in ascending order; ties by place."""
    bits = max(1, len(key) - 1).bit_length()
    if int(key.max(initial=0)).bit_length() + bits > 62:
        return np.argsort(key, kind="stable")
    packed = (key << bits) | np.arange(len(key))
    packed.sort()
    return packed & ((1 << bits) - 1)


def _ranked(key: np.ndarray) -> np.ndarray:
    """Dense ranks (from 1) of integers."""
    order = _order(key)
    new = np.empty(len(key), bool)
    new[:1] = True
    sorted_ = key[order]
    new[1:] = sorted_[1:] != sorted_[:-1]
    out = np.empty(len(key), np.int64)
    out[order] = np.cumsum(new)
    return out


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integers that order as the pairs (a, b) do."""
    bits, place = int(b.max(initial=0)).bit_length(), len(a).bit_length()
    if int(a.max(initial=0)).bit_length() + bits + place > 62:
        a = _ranked(a)
    return (a << bits) | b


def suffix_array(s: np.ndarray) -> np.ndarray:
    """The starts of all suffixes of s (integers from 1) in lexicographic order, by the difference cover {1, 2} modulo 3."""
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    t = np.append(s.astype(np.int64), [0, 0, 0])
    ones = np.arange(1, n + (n % 3 == 1), 3)  # with one place past the end if n is 1 modulo 3, so that the names' two halves part
    sample = np.concatenate([ones, np.arange(2, n, 3)])
    names = _ranked(_pair(_pair(t[sample], t[sample + 1]), t[sample + 2]))
    if names.max() < len(sample):
        order = suffix_array(names)
        names[order] = np.arange(1, len(sample) + 1)
    else:
        order = _order(names)
    rank = np.zeros(n + 3, np.int64)
    rank[sample] = names
    sampled = sample[order]
    sampled = sampled[sampled < n]
    rest = np.arange(0, n, 3)
    rest = rest[_order(_pair(t[rest], rank[rest + 1]))]
    # how many of the rest precede each sampled suffix: by one letter and a rank, or by two letters and a rank
    bits = int(rank.max()).bit_length()
    one = sampled % 3 == 1
    before = np.empty(len(sampled), np.int64)
    a = sampled[one]
    before[one] = np.searchsorted((t[rest] << bits) | rank[rest + 1], (t[a] << bits) | rank[a + 1])
    b = sampled[~one]
    two = _pair(t[np.concatenate([rest, b])], t[np.concatenate([rest, b]) + 1])
    two = _pair(two, rank[np.concatenate([rest, b]) + 2])
    before[~one] = np.searchsorted(two[: len(rest)], two[len(rest) :])
    out, free = np.empty(n, np.int64), np.ones(n, bool)
    at = np.arange(len(sampled)) + before
    out[at], free[at] = sampled, False
    out[free] = rest
    return out


def _slide_least(x: np.ndarray, n: int) -> np.ndarray:
    """The least of x[i : i + n] for every i at which so many are left."""
    have, out = 1, x
    while have < n:
        step = min(have, n - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def _anchors(buf: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(hash, anchor, first, last) of the runs of starts with one anchor; ends: where each text ends in buf."""
    n = len(buf)
    if n < width:
        return (np.zeros(0, np.int64),) * 4
    up, down = powers(_MUL, n + 1)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(_LETTER[buf] * up[:n], out=prefix[1:])
    h = mix((prefix[GRAM:] - prefix[:-GRAM]) * down[: n - GRAM + 1])
    low = np.uint64((1 << 24) - 1)
    least = _slide_least((h & ~low) | np.arange(len(h), dtype=np.uint64), width - GRAM + 1)  # ties: the leftmost
    inside = np.ones(n + width, bool)
    for k in ends:
        inside[max(0, k - width + 1) : k] = False
    at = np.flatnonzero(inside[: len(least)])
    anchor = (least[at] & low).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(at)) - 1
    return h[anchor[head]].view(np.int64), anchor[head], at[head[: len(at)]], at[tail[: len(at)]]


def _bytes(part: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes as one array and the offsets of each."""
    texts = pc.fill_null(part.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def _find(width: int, stretch: int):
    """(fp, digest, anchor, first, last) of every text, places within it."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                buf, offsets = _bytes(part.column("text"))
                for i in range(0, max(1, len(buf)), stretch):
                    stop = min(len(buf), i + stretch + width - 1)
                    ends = offsets[1:][(offsets[1:] > i) & (offsets[1:] < stop)] - i
                    fp, anchor, first, last = _anchors(buf[i:stop], np.append(ends, stop - i), width)
                    if not len(fp):
                        continue
                    row = np.searchsorted(offsets, first + i, side="right") - 1
                    base = (offsets[row] - i)[:, None]
                    places = (np.stack([anchor, first, last], axis=1) - base).astype(np.int32)
                    values = [pa.array(fp), part.column("digest").take(pa.array(row)), *(pa.array(np.ascontiguousarray(p)) for p in places.T)]
                    yield pa.RecordBatch.from_arrays(values, ["fp", "digest", "anchor", "first", "last"])

    return run


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0] .. start[0] + size[0] - 1, start[1] .. and so on."""
    return np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)


def _pieces(width: int, most: int):
    """Of texts and their spots: the bytes of what each anchor owns, and the bucket's key."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                buf, offsets = _bytes(part.column("text"))
                whole = buf.tobytes()
                spots = part.column("spots")
                flat = spots.flatten()
                row = np.repeat(np.arange(part.num_rows), pc.list_value_length(spots).to_numpy())
                fp, n, anchor, first, last = (pc.struct_field(flat, k).to_numpy() for k in range(5))
                # hot anchors: cut at distances of STEP from the anchor
                low, high = (anchor - last) // STEP, (anchor - first) // STEP
                cuts = np.where(n > most, high - low + 1, 1)
                pick = np.repeat(np.arange(len(fp)), cuts)
                k = _ranges(np.zeros(len(fp), np.int64), cuts) + low[pick]
                hot = n[pick] > most
                a = np.where(hot, np.maximum(first[pick], anchor[pick] - (k + 1) * STEP + 1), first[pick]).astype(np.int64)
                b = np.where(hot, np.minimum(last[pick], anchor[pick] - k * STEP), last[pick]).astype(np.int64)
                size = b - a + width
                row = row[pick]
                for i in range(0, len(a), 1 << 14):
                    s = slice(i, i + (1 << 14))
                    begin = offsets[row[s]] + a[s]
                    kinds: dict[bytes, int] = {}  # equal pieces of a slice go as one
                    kind = np.array([kinds.setdefault(whole[x : x + y], len(kinds)) for x, y in zip(begin.tolist(), size[s].tolist(), strict=True)], np.int64)
                    members = np.argsort(kind, kind="stable")
                    one = members[np.searchsorted(kind[members], np.arange(len(kinds)))]
                    key = mix(fp[pick[s]][one].view(np.uint64) + np.where(hot[s], k[s] + 1, 0)[one].astype(np.uint64) * np.uint64(_MUL)).view(np.int64)
                    owner = pa.array(row[s][members])
                    member = pa.StructArray.from_arrays([part.column("digest").take(owner), part.column("copies").take(owner), pa.array(a[s][members].astype(np.int32))], ["digest", "copies", "first"])
                    cut = pa.array(np.append(0, np.cumsum(np.bincount(kind, minlength=len(kinds)))).astype(np.int32))
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(list(kinds), pa.binary()), pa.ListArray.from_arrays(cut, member)], ["key", "piece", "members"])

    return run


def _sorted_runs(width: int):
    """(digest, start, n) of the runs of repeated starts among the pieces of a bucket."""

    def run(rows: pa.Table) -> pa.Table:
        kinds: dict[bytes, dict[tuple, int]] = {}
        for p, members in zip(rows.column("piece").to_pylist(), rows.column("members").to_pylist(), strict=True):
            kinds.setdefault(p, {}).update({(m["digest"], m["first"]): m["copies"] for m in members})  # a row that came twice counts once
        pieces = list(kinds)
        weight = np.array([sum(kinds[p].values()) for p in pieces])
        size = np.array([len(p) for p in pieces])
        text = np.frombuffer(b"".join(p + b"\0" for p in pieces), np.uint8)
        at = np.cumsum(size + 1) - size - 1
        letters = text.astype(np.int64) + 2
        letters[at + size] = 1  # below all bytes, at the end of every piece
        starts = size - width + 1
        is_start = np.zeros(len(text) + 1, bool)
        is_start[_ranges(at, starts)] = True
        order = suffix_array(letters)
        order = order[is_start[order]]
        same = np.zeros(len(order) + 1, bool)
        left, right = order[:-1], order[1:]
        alive = np.arange(len(left))
        eight = np.lib.stride_tricks.as_strided(text[:8].view(np.uint64), (max(0, len(text) - 7),), (1,))
        for x in [*range(0, width - 8, 8), width - 8]:  # eight bytes at once
            alive = alive[eight[left[alive] + x] == eight[right[alive] + x]]
        same[alive + 1] = True
        again = np.zeros(len(text) + 1, bool)
        again[order] = same[:-1] | same[1:]
        again[_ranges(at[weight > 1], starts[weight > 1])] = True
        edge = np.diff(again.astype(np.int8), prepend=np.int8(0))
        up, down = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        piece = np.searchsorted(at, up, side="right") - 1
        out = [(d, f + int(u - at[k]), int(v - u)) for u, v, k in zip(up, down, piece, strict=True) for d, f in kinds[pieces[k]]]
        return pa.table({"digest": pa.array([r[0] for r in out], pa.binary()), "start": pa.array([r[1] for r in out], pa.int32()), "n": pa.array([r[2] for r in out], pa.int32())})

    return run


def _digest():
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def repeated_starts(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(digest, runs): of every text with repeats, the runs (start, n) of starts of ``width`` bytes that occur elsewhere too.

    digest: the MD5 of the text; docs: doc_id, text.
    """
    if width <= GRAM:
        raise ValueError(f"width must be over {GRAM}")
    with scope(docs.sparkSession):
        return result(_repeated_starts(docs, width), "repeated-starts")


def _repeated_starts(docs: DataFrame, width: int) -> DataFrame:
    spark = docs.sparkSession
    base = docs.where(F.octet_length("text") >= width).select("doc_id", "text", _digest().alias("digest"))
    anchors = table(base.select("digest", "text").mapInArrow(_find(width, STRETCH), "fp long, digest binary, anchor int, first int, last int"), "anchors")
    often = table(anchors.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1"), "often")
    copies = table(base.groupBy("digest").agg(F.count("*").alias("copies"), F.min("doc_id").alias("who")), "copies")
    maybe = marked(anchors, "fp", often.select("fp"), "often", 1 << 24).where("often").drop("often").distinct()
    spots = maybe.join(often, "fp").groupBy("digest").agg(F.collect_list(F.struct("fp", "n", "anchor", "first", "last")).alias("spots"))
    spots = table(spots.join(copies, "digest"), "spots")
    some = marked(base, "digest", spots.select("digest"), "some").where("some")
    texts = some.join(spots, "digest").where(F.col("doc_id").eqNullSafe(F.col("who"))).select("digest", "copies", "text", "spots")
    pieces = table(texts.mapInArrow(_pieces(width, HOT), "key long, piece binary, members array<struct<digest: binary, copies: long, first: int>>"), "pieces")
    total = pieces.agg(F.sum(F.octet_length("piece"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET))
    dealt = pieces.withColumn("bucket", F.pmod("key", F.lit(buckets))).groupBy("bucket")
    runs = dealt.applyInArrow(_sorted_runs(width), "digest binary, start int, n int")
    return runs.groupBy("digest").agg(F.collect_list(F.struct("start", "n")).alias("runs"))


def _cut(width: int):
    """n_bytes, n_removed, n_spans and the bytes that are left, of rows (row, text, runs)."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                buf, offsets = _bytes(part.column("text"))
                runs = part.column("runs")
                flat = runs.flatten()
                row = np.repeat(np.arange(part.num_rows), pc.list_value_length(runs).to_numpy())
                start, n = (pc.struct_field(flat, k).to_numpy().astype(np.int64) for k in (0, 1))
                start = start + offsets[row]
                step = np.bincount(start, minlength=len(buf) + 1) - np.bincount(start + n + width - 1, minlength=len(buf) + 1)
                gone = np.cumsum(step)[: len(buf)] > 0
                total = np.append(0, np.cumsum(gone))
                head = gone.copy()
                head[1:] &= ~gone[:-1]
                head[offsets[:-1][offsets[:-1] < len(buf)]] = gone[offsets[:-1][offsets[:-1] < len(buf)]]
                spans = np.append(0, np.cumsum(head))
                kept = [buf[a:b][~gone[a:b]].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                values = [part.column("row"), pa.array(np.diff(offsets)), pa.array(np.diff(total[offsets])), pa.array(np.diff(spans[offsets])), pa.array(kept, pa.binary()), pa.array([hashlib.sha256(k).hexdigest() for k in kept])]
                yield pa.RecordBatch.from_arrays(values, ["row", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return run


def remove_repeats(docs: DataFrame, keep: list[str], width: int = WIDTH) -> DataFrame:
    """(row, n_bytes, n_removed, n_spans, kept, kept_sha256) of every row of docs (doc_id, text, ...).

    row: a struct of the ``keep`` columns; kept: the bytes left (a cut may fall inside a character).
    """
    runs = repeated_starts(docs.select("doc_id", "text"), width)
    wide = docs.select(F.struct(*keep).alias("row"), "text", _digest().alias("digest"))
    split = marked(wide, "digest", runs.select("digest"), "hit")
    touched = split.where("hit").drop("hit").join(runs, "digest", "left")
    whole = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    plain = [F.octet_length(whole).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), whole.alias("kept"), F.sha2(whole, 256).alias("kept_sha256")]
    kind = wide.select("row").schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept", "binary").add("kept_sha256", "string")
    cut = touched.where("runs is not null").select("row", "text", "runs").mapInArrow(_cut(width), kind)
    return cut.union(touched.where("runs is null").select("row", *plain)).union(split.where("not hit").select("row", *plain))


def op11_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs, ["doc_id"]).select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


ORACLE = """
WITH b AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS g FROM b, LATERAL (SELECT unnest(range(0, n - 199)) AS i) WHERE n >= 200),
r AS (SELECT doc_id, i FROM s WHERE g IN (SELECT g FROM s GROUP BY g HAVING count(*) > 1)),
m AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 200 THEN 0 ELSE 1 END AS new FROM r),
p AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM m),
c AS (SELECT doc_id, span, min(i) AS a, max(i) + 200 AS z FROM p GROUP BY 1, 2),
k AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS y FROM c),
l AS (SELECT k.doc_id, count(*) AS n_spans, sum(z - a) AS n_removed, string_agg(substr(h, 2 * y + 1, 2 * (a - y)), '' ORDER BY a) AS head, max(z) AS last FROM k JOIN b USING (doc_id) GROUP BY 1)
SELECT b.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN last IS NULL THEN h ELSE head || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM b LEFT JOIN l USING (doc_id)
"""
