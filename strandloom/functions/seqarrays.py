"""Letters of many short texts as one numpy array, straight from Arrow buffers: adapters, cuts and counts of a batch at once.

Places and lengths are in letters (code points), as in Spark. Nulls stand for empty texts where nothing else is said. A batch is
worked on in parts of about ``PART`` letters (a longer text stands alone), so that the arrays stay small.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

PART = 1 << 20
#: Letters of a packed word: three bits each.
WORD = 21
#: Digits of a window: its complemented bases, and ``-`` past the end; up to ``DENSE`` windows are looked up by their number.
BASES, DENSE = "ACGTN-", 6**8


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The letters of all texts one after another (bytes if all are ASCII, else code points), and where each text begins; one entry more."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset) if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    codes = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    if len(codes) and codes.max() > 127:
        offsets = np.concatenate([[0], np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)])
        return np.frombuffer(codes.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32), offsets
    return codes, offsets - offsets[0]


def strings(codes: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """ASCII letters as texts."""
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(codes, np.uint8))).cast(pa.string())


def parts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Rows from and to, so that a part holds about ``PART`` bytes."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + PART, side="right")))
        yield start, stop
        start = stop


def _by_parts(texts: pa.Array, work: Callable[[np.ndarray, np.ndarray], np.ndarray], empty: np.dtype) -> np.ndarray:
    return np.concatenate([np.zeros(0, empty), *[work(*flat(texts.slice(a, b - a))) for a, b in parts(texts)]])


def leftmost_place(codes: np.ndarray, offsets: np.ndarray, adapter: str, most: int, least: int) -> np.ndarray:
    """Of each text the first place (from 1; 0: none) where the adapter, or what the text's end leaves of it, at least ``least`` letters, begins with at most so many unlike letters."""
    n = len(codes)
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(n)
    unlike = np.zeros(n, np.int16)
    for k, letter in enumerate(adapter[:n]):
        unlike[: n - k] += (codes[k:] != ord(letter)) & (left[: n - k] > k)
    at = np.flatnonzero((unlike <= most) & (left >= least))
    owner, first = np.unique(np.searchsorted(offsets, at, side="right") - 1, return_index=True)
    out = np.zeros(len(offsets) - 1, np.int32)
    out[owner] = at[first] - offsets[owner] + 1
    return out


def ends_inside(codes: np.ndarray, offsets: np.ndarray, adapter: str, most: int, least: int) -> np.ndarray:
    """Whether the adapter, or a suffix of it from the text's begin on, ends before some letter that has at least ``least`` before it."""
    n = len(codes)
    place = np.arange(n) - np.repeat(offsets[:-1], np.diff(offsets))
    unlike = np.zeros(n, np.int16)
    for k, letter in enumerate(reversed(adapter[-n:] if n else ""), 1):
        unlike[k:] += (codes[: n - k] != ord(letter)) & (place[k:] >= k)
    out = np.zeros(len(offsets) - 1, bool)
    out[np.searchsorted(offsets, np.flatnonzero((unlike <= most) & (place >= least)), side="right") - 1] = True
    return out


def adapter_place(seq: Column, adapter: str, most: int, least: int) -> Column:
    """``leftmost_place`` of a column of texts."""

    @F.arrow_udf("int")
    def place(texts: pa.Array) -> pa.Array:
        return pa.array(_by_parts(texts, lambda c, o: leftmost_place(c, o, adapter, most, least), np.int32))

    return place(seq)


def adapter_ends(seq: Column, adapter: str, most: int, least: int) -> Column:
    """``ends_inside`` of a column of texts."""

    @F.arrow_udf("boolean")
    def ends(texts: pa.Array) -> pa.Array:
        return pa.array(_by_parts(texts, lambda c, o: ends_inside(c, o, adapter, most, least), np.bool_))

    return ends(seq)


def spelled(text: Column, spelling: dict[str, str]) -> Column:
    """Texts with every letter replaced by its ASCII spelling (one letter); letters without one go. Null stays null."""
    table = np.zeros(256, np.uint8)
    for letter, other in spelling.items():
        table[ord(letter)] = ord(other)

    def work(texts: pa.Array) -> pa.Array:
        raw = pc.fill_null(texts, "").cast(pa.large_binary())
        offsets = np.frombuffer(raw.buffers()[1], np.int64, len(raw) + 1, 8 * raw.offset)
        data = raw.buffers()[2]
        new = table[np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]] if data is not None else np.zeros(0, np.uint8)
        kept = new != 0
        return strings(new[kept], np.concatenate([[0], np.cumsum(kept)])[offsets - offsets[0]])

    @F.arrow_udf("string")
    def spell(texts: pa.Array) -> pa.Array:
        done = [work(texts.slice(a, b - a)) for a, b in parts(texts)]
        out = pa.concat_arrays(done) if done else pa.array([], pa.string())
        return pc.if_else(pc.is_valid(texts), out, pa.scalar(None, pa.string())) if texts.null_count else out

    return spell(text)


def cut(seq: Column, size: Column) -> Column:
    """ASCII texts cut into pieces of ``size`` letters, the last one of what is left, as an array (empty where either is null)."""

    @F.arrow_udf("array<string>")
    def pieces(texts: pa.Array, sizes: pa.Array) -> pa.Array:
        if sizes.null_count:
            texts, sizes = pc.if_else(pc.is_valid(sizes), texts, ""), pc.fill_null(sizes, 1)
        codes, offsets = flat(texts)
        size_ = sizes.to_numpy(zero_copy_only=False).astype(np.int64)
        counts = -(-np.diff(offsets) // size_)
        first = np.concatenate([[0], np.cumsum(counts)])
        number = np.arange(first[-1]) - np.repeat(first[:-1], counts)
        starts = np.repeat(offsets[:-1], counts) + number * np.repeat(size_, counts)
        return pa.ListArray.from_arrays(pa.array(first, pa.int32()), strings(codes, np.append(starts, offsets[-1])))

    return pieces(seq, size)


def packed(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Texts as longs of three bits a letter, the first letter highest: ACGT as 1 to 4, others 5, blanks and none 0. What is longer than the words is cut."""
    table = np.full(128, 5, np.int64)
    table[[ord(x) for x in " ACGT"]] = range(5)

    def work(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        place = np.arange(len(codes)) - offsets[row]
        kept = place < WORD * words
        grid = np.zeros((len(offsets) - 1, WORD * words), np.int64)
        grid[row[kept], place[kept]] = table[np.minimum(codes[kept], 127)]
        return grid.reshape(-1, words, WORD) @ (8 ** np.arange(WORD - 1, -1, -1, dtype=np.int64))

    done = [work(*flat(texts.slice(a, b - a))) for a, b in parts(texts)]
    return list(np.concatenate([np.zeros((0, words), np.int64), *done]).T)


def pack(df: DataFrame, text: str, words: int, names: str) -> DataFrame:
    """df with ``packed`` longs (``names`` and a number from 0) in place of its column ``text``; no filter is moved before them, so they are made once a row."""
    rest = [f for f in df.schema.fields if f.name != text]
    new = [f"{names}{k}" for k in range(words)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            made = packed(columns.pop(text), words)
            yield pa.RecordBatch.from_arrays([*columns.values(), *[pa.array(x) for x in made]], names=[*columns, *new])

    return df.mapInArrow(work, StructType([*rest, *[StructField(x, LongType()) for x in new]]))


def counted(text: Column, low: int, high: int) -> Column:
    """How many letters of a text have code points from low to high; null for null."""

    def work(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum((codes >= low) & (codes <= high))])
        return np.diff(upto[offsets]).astype(np.int32)

    @F.arrow_udf("int")
    def count(texts: pa.Array) -> pa.Array:
        return pa.array(_by_parts(texts, work, np.int32), mask=texts.is_null().to_numpy(zero_copy_only=False))

    return count(text)


def tally(df: DataFrame, keys: list[str], texts: list[str]) -> DataFrame:
    """Rows by keys, place (from 1) and letter: keys, text (the column's name), pos, code (the letter's code point), n.

    Letters are counted in each batch; only its counts are shuffled, so no row a letter is made.
    """
    rows = df.select(*keys, *texts)
    fields = ", ".join([f"`{k}` {t}" for k, t in df.select(*keys).dtypes] + ["text string, pos int, code int, n bigint"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in texts:
                column = batch.column(name)
                for a, b in parts(column):
                    codes, offsets = flat(column.slice(a, b - a))
                    if not len(codes):
                        continue
                    group, values = _groups([batch.column(k).slice(a, b - a) for k in keys], b - a)
                    size = np.diff(offsets)
                    wide, deep = int(size.max()), int(codes.max()) + 1
                    each = (np.repeat(group, size) * wide + np.arange(len(codes)) - np.repeat(offsets[:-1], size)) * deep + codes
                    bins = len(values[0]) * wide * deep if values else wide * deep
                    if bins <= 4 * PART:
                        n = np.bincount(each, minlength=bins)
                        found = np.flatnonzero(n)
                        n = n[found]
                    else:
                        found, n = np.unique(each, return_counts=True)
                    spot, code = np.divmod(found, deep)
                    own, pos = np.divmod(spot, wide)
                    cols = [v.take(pa.array(own)) for v in values] + [pa.array([name] * len(n), pa.string()), pa.array(pos + 1, pa.int32()), pa.array(code, pa.int32()), pa.array(n, pa.int64())]
                    yield pa.RecordBatch.from_arrays(cols, names=[*keys, "text", "pos", "code", "n"])

    counts = rows.mapInArrow(count, fields)
    return counts.groupBy(*keys, "text", "pos", "code").agg(F.sum("n").alias("n"))


def _groups(keys: list[pa.Array], n: int) -> tuple[np.ndarray, list[pa.Array]]:
    """A number for each row's keys, and the keys by number."""
    group, values = np.zeros(n, np.int64), []
    for k in keys:
        coded = pc.dictionary_encode(k, null_encoding="encode")
        both = group * len(coded.dictionary) + coded.indices.to_numpy(zero_copy_only=False)
        seen, group = np.unique(both, return_inverse=True)
        old, new = np.divmod(seen, len(coded.dictionary))
        values = [v.take(pa.array(old)) for v in values] + [coded.dictionary.take(pa.array(new))]
    return group.reshape(-1), values


def mask(size: Column, windows: Column) -> Column:
    """A letter for each of ``size`` places: M in a window (kind, beg, end; closed, from 0) of kind M, S in one of kind S, l between the first begin and the last end, f outside."""

    @F.arrow_udf("string")
    def draw(sizes: pa.Array, windows_: pa.Array) -> pa.Array:
        out = []
        for n, ws in zip(sizes.to_pylist(), windows_, strict=True):
            text, ws = bytearray(b"f" * (n or 0)), ws.as_py() or []
            spans = [(b"l", min(w["beg"] for w in ws) + 1, max(w["end"] for w in ws) - 1)] if ws else []
            for letter, beg, end in [*spans, *((k.encode(), w["beg"], w["end"]) for k in "SM" for w in ws if w["kind"] == k)]:
                beg, end = max(beg, 0), min(end + 1, len(text))
                text[beg:end] = letter * max(0, end - beg) if end > beg else text[beg:end]
            out.append(None if n is None else text.decode())
        return pa.array(out, pa.string())

    return draw(size, windows)


_LOWER, _UPPER = np.arange(256, dtype=np.uint8), np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_UPPER[97:123] -= 32


def aligned(seq: Column, reads: Column, types: tuple[str, str]) -> Column:
    """reads, a list of (beg, seq, n) on seq, as a list of (beg, end, aligned, n): end closed, letters unlike seq's in upper case, the others lower.

    types: of beg and n.
    """

    def show(whole: pa.Array, begs: pa.Array, owner: np.ndarray, texts: pa.Array) -> pa.Array:
        here, at = flat(whole)
        codes, offsets = flat(texts)
        size = np.diff(offsets)
        beg = begs.to_numpy(zero_copy_only=False).astype(np.int64)
        place = np.repeat(beg - offsets[:-1], size) + np.arange(len(codes))
        on = (place >= 0) & (place < np.repeat(np.diff(at)[owner], size))
        equal = on.copy()
        equal[on] = here[(place + np.repeat(at[owner], size))[on]] == codes[on]
        if codes.dtype == np.uint8:
            return strings(np.where(equal, _LOWER[codes], _UPPER[codes]), offsets)
        return pa.array(["".join(chr(c).lower() if e else chr(c).upper() for c, e in zip(codes[a:b].tolist(), equal[a:b].tolist(), strict=True)) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.string())

    @F.arrow_udf(f"array<struct<beg:{types[0]},end:{types[0]},aligned:string,n:{types[1]}>>")
    def align(whole: pa.Array, lists: pa.Array) -> pa.Array:
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        rows = lists.flatten()
        beg, text, n = (pc.struct_field(rows, i) for i in range(3))
        shown = show(whole, pc.fill_null(beg, -1), np.repeat(np.arange(len(counts)), counts), text)
        if text.null_count:
            shown = pc.if_else(pc.is_valid(text), shown, pa.scalar(None, pa.string()))
        end = pc.subtract(pc.add(beg, pc.cast(pc.utf8_length(text), beg.type)), pa.scalar(1, beg.type))
        made = pa.StructArray.from_arrays([beg, end, shown, n], names=["beg", "end", "aligned", "n"])
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), made)

    return align(seq, reads)


def site_counts(df: DataFrame, keys: list[str], held: int = 8) -> DataFrame:
    """df: keys, beg (from 0), seq, ref, n; seq lies inside ref at beg. By keys, place in ref (from 0), its letter x and the read's y: the sum of n.

    Letters are counted over ``held`` batches at a time, so only sums are shuffled and no row a letter is made.
    """
    rows = df.select(*keys, F.col("beg").cast("long").alias("beg"), "seq", "ref", F.col("n").cast("long").alias("n"))
    fields = ", ".join([f"`{k}` {t}" for k, t in df.select(*keys).dtypes] + ["pos int, x string, y string, n bigint"])

    def count(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = pa.Table.from_batches(batches).combine_chunks().to_batches()
        for batch in every:
            (codes, offsets), (other, at) = flat(batch.column("seq")), flat(batch.column("ref"))
            if not len(codes):
                continue
            size = np.diff(offsets)
            pos = np.repeat(batch.column("beg").to_numpy(zero_copy_only=False) - offsets[:-1], size) + np.arange(len(codes))
            letters, y = np.unique(codes, return_inverse=True)
            names, x = np.unique(other[pos + np.repeat(at[:-1], size)], return_inverse=True)
            group, values = _groups([batch.column(k) for k in keys], batch.num_rows)
            wide = int(pos.max()) + 1
            each = ((np.repeat(group, size) * wide + pos) * len(names) + x) * len(letters) + y
            order = np.argsort(each, kind="stable")
            found, first = np.unique(each[order], return_index=True)
            n = np.add.reduceat(np.repeat(pc.fill_null(batch.column("n"), 0).to_numpy(zero_copy_only=False), size)[order], first)
            rest, b = np.divmod(found, len(letters))
            rest, a = np.divmod(rest, len(names))
            own, place = np.divmod(rest, wide)
            spell = lambda table, index: pa.array([chr(c) for c in table]).take(pa.array(index))
            cols = [v.take(pa.array(own)) for v in values] + [pa.array(place, pa.int32()), spell(names, a), spell(letters, b), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=[*keys, "pos", "x", "y", "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            kept.append(batch)
            if len(kept) == held or sum(b.nbytes for b in kept) > 16 * PART:
                yield from count(kept)
                kept = []
        if kept:
            yield from count(kept)

    return rows.mapInArrow(work, fields).groupBy(*keys, "pos", "x", "y").agg(F.sum("n").alias("n"))


def _windows(codes: np.ndarray, offsets: np.ndarray, most: int, start: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Every place of the texts, at most ``PART`` at a time: the text's number, the place (from 1) and the window as a number of base 6.

    A window is the ``most`` complemented bases read backwards from ``start`` - 1 bases before the place; the text has ``least`` bases there at least.
    """
    table = np.full(128, 4, np.int32 if 6**most < 1 << 31 else np.int64)
    table[[ord(x) for x in "TUGCA"]] = 0, 0, 1, 2, 3
    for a in range(0, len(codes), PART):
        b, low = min(a + PART, len(codes)), max(0, a - most + 1)
        digits = table[np.minimum(codes[low:b], 127)]
        first, last = int(np.searchsorted(offsets, a, side="right")) - 1, int(np.searchsorted(offsets, b))
        row = np.repeat(np.arange(first, last), np.diff(np.clip(offsets[first : last + 1], a, b)))
        at = np.arange(a, b)
        place, left = at - offsets[row], offsets[row + 1] - at
        window = np.zeros(b - a, table.dtype)
        for k in range(most):
            window *= 6
            gone = min(max(0, low + k - a), b - a)
            window[:gone] += 5
            window[gone:] += digits[a + gone - k - low : b - k - low] if least >= most else np.where(place[gone:] >= k, digits[a + gone - k - low : b - k - low], 5)
        kept = (place >= least - 1) & (left >= start)
        yield row[kept], place[kept] + start, window[kept]


def distinct_windows(df: DataFrame, text: str, most: int, start: int, least: int) -> DataFrame:
    """window: what the places of the texts (see ``_windows``) read, each once."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(6**most, bool) if 6**most <= DENSE else None
        made = lambda x: pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64))], names=["number"])
        for batch in batches:
            for a, b in parts(batch.column(0)):
                for _, _, window in _windows(*flat(batch.column(0).slice(a, b - a)), most, start, least):
                    if seen is None:
                        yield made(np.unique(window))
                    else:
                        seen[window] = True
        if seen is not None:
            yield made(np.flatnonzero(seen))

    letter = lambda k: F.substr(F.lit(BASES), (F.floor(F.col("number") / F.lit(6**k)) % 6 + 1).cast("int"), F.lit(1))
    return df.select(text).mapInArrow(find, "number long").distinct().select(F.concat(*[letter(k) for k in reversed(range(most))]).alias("window"))


def _summed(key: np.ndarray, values: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The distinct keys in order, and each one's sums; whole numbers stay exact."""
    if not len(key):
        return key, values
    low, bins = int(key.min()), int(key.max()) - int(key.min()) + 1
    if bins <= 4 * PART and all(int(v.max()) * len(v) < 1 << 53 for v in values):
        found = np.flatnonzero(np.bincount(key - low))
        return found + low, [np.bincount(key - low, v)[found].astype(np.int64) for v in values]
    order = np.argsort(key, kind="stable")
    found, first = np.unique(key[order], return_index=True)
    return found, [np.add.reduceat(v[order], first) for v in values]


def window_sums(df: DataFrame, key: str, text: str, matches: DataFrame, by: list[str], most: int, start: int, least: int) -> DataFrame:
    """What the places (see ``_windows``) of each row's text match: key, the columns ``by`` of matches, sites, starts, backs.

    matches: window, by, times (how often the window matches), back; sites sums times, starts times and place, backs back. The matches go
    to every task. Texts are read a part at a time and nothing is shuffled, so keys must be distinct or the sums summed again.
    """
    rows, table = df.select(key, text), matches.toArrow().combine_chunks()
    column = {c: table.column(c).combine_chunks() for c in table.column_names}
    letters, _ = flat(column["window"])
    digit = np.zeros(128, np.int64)
    digit[[ord(x) for x in BASES]] = range(len(BASES))
    number = digit[letters].reshape(-1, most) @ (6 ** np.arange(most - 1, -1, -1, dtype=np.int64))
    order = np.argsort(number, kind="stable")
    group, values = _groups([column[c] for c in by], len(table))
    number, group, times, back = (x[order] for x in (number, group, column["times"].to_numpy(), column["back"].to_numpy()))
    wide = int(group.max(initial=0)) + 1
    fields = ", ".join(f"`{k}` {t}" for k, t in [*df.select(key).dtypes, *matches.select(*by).dtypes, *[(c, "bigint") for c in ("sites", "starts", "backs")]])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = 6**most <= DENSE
        known, counts = (np.arange(6**most), np.bincount(number, minlength=6**most)) if dense else np.unique(number, return_counts=True)
        upto = np.concatenate([[0], np.cumsum(counts), [len(number)]])

        def met(window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:  # where its matches begin, and how many there are
            at = window if dense else np.searchsorted(known, window)
            n = upto[at + 1] - upto[at]
            if not dense:
                n[at == len(known)] = 0
                n[at < len(known)] *= known[at[at < len(known)]] == window[at < len(known)]
            return upto[at], n

        def sums(codes: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
            for row, place, window in _windows(codes, offsets, most, start, least):
                begin, n = met(window)
                hit = np.flatnonzero(n)
                ends, at = np.cumsum(n[hit]), 0
                while at < len(hit):
                    to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 4 * PART, side="right")))
                    h = hit[at:to]
                    c = n[h]
                    entry = np.repeat(begin[h] - (np.cumsum(c) - c), c) + np.arange(c.sum())
                    yield _summed(np.repeat(row[h], c) * wide + group[entry], [times[entry], times[entry] * np.repeat(place[h], c), back[entry]])
                    at = to

        for batch in batches:
            texts = batch.column(1)
            for a, b in parts(texts):
                some = list(sums(*flat(texts.slice(a, b - a))))
                if not some:
                    continue
                found, kept = some[0] if len(some) == 1 else _summed(np.concatenate([x for x, _ in some]), [np.concatenate(v) for v in zip(*[v for _, v in some], strict=True)])
                own, g = np.divmod(found, wide)
                cols = [batch.column(0).take(pa.array(own + a)), *[v.take(pa.array(g)) for v in values], *map(pa.array, kept)]
                yield pa.RecordBatch.from_arrays(cols, names=[key, *by, "sites", "starts", "backs"])

    return rows.mapInArrow(read, fields)
