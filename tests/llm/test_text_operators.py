"""Suffix-array dedup, conversation repair and spelling variants against brute force: nulls, empties, ties, copies, extra columns, empty tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandloom.llm import decontaminate, minhash, repair, spelling, suffixes, toxicity

CLASH = ["row", "digest", "hit", "runs", "kept", "n_bytes", "key", "id", "word", "n", "conv", "place", "script", "g", "fault", "letter", "said", "bits", "marked"]


def clashing(df):
    return df.withColumns({c: F.lit(7) for c in CLASH if c not in df.columns})


# suffix arrays


def test_suffix_array_by_sorting():
    rng = np.random.default_rng(0)
    for _ in range(2000):
        s = rng.integers(1, int(rng.integers(2, 6)), int(rng.integers(0, 50)))
        assert suffixes.suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())


def test_suffix_array_of_periodic_and_wide_letters():
    for s in (np.ones(500, np.int64), np.tile([3, 1, 2], 200), np.random.default_rng(1).integers(1, 1 << 40, 700)):
        assert suffixes.suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())


def texts(seed=5):
    rnd = random.Random(seed)
    say = lambda n: "".join(rnd.choice("abcdefgh é漢") for _ in range(n))
    a, b = say(400), say(230)
    out = [say(rnd.randint(0, 900)) for _ in range(12)]
    out += [say(50) + a + say(70), a + say(10), say(300) + a[37:320], b, b, say(5) + b[:198] + say(5), a[:199], a[:160] + "x" + a[161:], None, "", "x" * 1500, "ab" * 700, "x" * 199, "y" * 200, (say(31) * 30)]
    return [(i, t) for i, t in enumerate(out)] + [(3, out[3]), (None, out[0]), (None, None)]


def uncovered(rows, width=200):
    seen = Counter()
    raw = [(r[1] or "").encode() for r in rows]
    for t in raw:
        seen.update(t[i : i + width] for i in range(len(t) - width + 1))
    out = Counter()
    for r, t in zip(rows, raw, strict=True):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - width + 1):
            if seen[t[i : i + width]] > 1:
                gone[i : i + width] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        out[(r[0], len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.mark.parametrize("hot,stretch", [(2000, 1 << 22), (1, 256)])
def test_repeated_bytes_by_brute_force(spark, monkeypatch, hot, stretch):
    """Also with every anchor dealt by distance, and with texts scanned in short stretches."""
    monkeypatch.setattr(suffixes, "HOT", hot)
    monkeypatch.setattr(suffixes, "STRETCH", stretch)
    rows = texts()
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string")).repartition(3)
    got = suffixes.remove_repeats(docs, ["doc_id"]).collect()
    assert Counter((r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == uncovered(rows)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


def test_repeated_bytes_of_long_and_no_texts(spark):
    docs = spark.createDataFrame(texts(), "doc_id long, text string")
    assert suffixes.remove_repeats(docs.limit(0), ["doc_id"]).count() == 0
    rnd = random.Random(9)
    long = "".join(rnd.choice("abcdefghijklmnop ") for _ in range(5_000_000))
    part = long[1_234_567:1_235_000]
    got = suffixes.remove_repeats(spark.createDataFrame([(1, long), (2, "z" * 40 + part + "z"), (3, "q" * 1_000_000)], "doc_id long, text string"), ["doc_id"]).collect()
    assert {r.row.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in got} == {1: (5_000_000, 433, 1), 2: (474, 433, 1), 3: (1_000_000, 1_000_000, 1)}
    with pytest.raises(ValueError):
        suffixes.repeated_starts(docs, 20)


# conversations

BLACK = re.compile(r"[^\x20\x09-\x0D]")


def edits_of(rows):
    """(cost, audit, repaired lines) of (role, text, fault) by trying all edits."""
    need = {"0": "user", "s": "user", "u": "assistant", "a": "user"}

    @cache
    def go(i, q, inserted):
        ways = [(0, "")] if i == len(rows) and q in "0a" else []
        if inserted < 2:
            c, a = go(i, need[q][0], inserted + 1)
            ways.append((c + 3, "I" + a))
        if i < len(rows):
            role, _, fault = rows[i]
            c, a = go(i + 1, q, 0)
            ways.append((c + 4, "D" + a))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if role[:1] == need[q][0] or (q == "0" and role[:1] == "s"):
                    c, a = go(i + 1, role[0], 0)
                    ways.append((c + more, "K" + a))
                c, a = go(i + 1, need[q][0], 0)
                ways.append((c + more + 3, "R" + a))
        return min(ways, default=(10**9, ""))

    cost, audit = go(0, "0", 0)
    lines, i, q = [], 0, "0"
    for e in audit:
        if e == "I":
            lines.append(need[q] + ":")
        elif e != "D":
            lines.append((need[q] if e == "R" else rows[i][0]) + ":" + rows[i][1])
        if e != "D":
            q = lines[-1][0]
        i += e != "I"
    assert i == len(rows)
    return cost, audit, lines


def judged(rows):
    """rows (turn, role, text) in order."""
    seen, out = set(), []
    for _, role, text in rows:
        last = BLACK.findall(text)
        fault = "blank" if not last else "duplicate" if (role, text) in seen else None if last[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    cost, audit, lines = edits_of(tuple(out))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    count = Counter(f for _, _, f in out)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(out[:-1], out[1:], strict=True))
    return (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()), lines


def talks(seed=3):
    rnd = random.Random(seed)
    rows = []
    for c in range(60):
        n = rnd.choice([0, 1, 2, 3, 5, 8])
        for t in range(n):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rnd.choice(["Yes.", "No", " ", "", None, f"text {t}!", "what?\n", "...\t x ", "ü\x85", "same."])
            rows.append((c, rnd.choice([t, t + 1, 2 * t, None]), role, text))
    return rows + [(None, 0, "user", "hi."), (None, 1, "assistant", "so."), (70, 5, "assistant", "alone"), (71, None, "system", "only.")]


def in_order(rows):
    said = lambda r, t: hashlib.md5(f"{len(r)}:{r}{t}".encode()).hexdigest()
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t, " " if r is None else r, " " if x is None else x))
    return {c: sorted(v, key=lambda k: (k[0] is not None, k[0] or 0, k[1], said(k[1], k[2]))) for c, v in by.items()}


@pytest.mark.parametrize("block", [4096, 2])
def test_repair_by_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rows = talks()
    d = clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).repartition(3)
    ids = d.select("conv_id").union(spark.createDataFrame([(99,)], "conv_id long"))
    got = {r.conv_id: tuple(r)[1:] for r in repair.repair(d, ids).collect()}
    want = {c: judged(v) for c, v in in_order(rows).items()} | {99: judged([])}
    assert got == {c: w[0] for c, w in want.items()}
    assert got[99] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    back = defaultdict(list)
    for r in sorted(repair.repaired_turns(d).collect(), key=lambda r: r.turn):
        back[r.conv_id].append(f"{r.role}:{r.text}")
    assert back == {c: w[1] for c, w in want.items() if w[1]}


def test_damage_by_brute_force(spark):
    rows = [(c, t, ("system", "user", "assistant", None)[(c + t) % 4], f"a.b! c? {c}") for c in range(40) for t in range(6)] + [(1, None, "user", None), (None, 2, "user", "x.")]
    want = Counter()
    for c, t, role, text in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        want[(c, t, "user" if k == 4 else role, text)] += (0, 1, 1, 2)[k] if k < 4 else 1
    got = Counter(tuple(r) for r in repair.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect())
    assert got == +want


def test_repair_of_a_long_conversation(spark):
    n = 30_000
    d = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("turn "), F.col("id"), F.lit(".")).alias("text"))
    r = repair.repair(d).first()
    assert (r.gaps, r.cost, r.audit, r.illegal) == (0, 0, "K" * n, 0)
    long = spark.createDataFrame([(1, 0, "user", "x" * 3_000_000), (1, 1, "assistant", " " * 2_000_000)], "conv_id long, turn long, role string, text string")
    assert repair.repair(long).first().audit == "DD" and repair.repair(long.limit(0)).count() == 0


def test_repair_makes_each_suffix_once(spark):
    d = spark.createDataFrame([("abcd",), ("bcd",), ("xd".replace("x", "a"),), ("cd",), ("abcd",)], "signature string").coalesce(1)
    got = repair.solved(d).collect()
    assert sum(r.nodes for r in got) <= len({s[i:] for s in ("abcd", "bcd", "ad", "cd") for i in range(len(s))}) + 3 * (len(got) - 1)
    batch = pa.RecordBatch.from_pydict({"signature": ["ad", "abcd", "bcd"]})
    nodes = [r for out in repair._solve(iter([batch])) for r in out.to_pylist()]
    assert [r["nodes"] for r in nodes] == [2, 3, 0]


# spelling


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def families(vocab, times=5):
    """word: (form, root, n, n_near, form_n) by comparing all words."""
    out = {}
    for w, n in vocab.items():
        own = [x for x in vocab if near(w, x)]
        best = min(own, key=lambda x: (-vocab[x], x), default=None)
        form = best if best and vocab[best] >= times * n else None
        out[w] = [form, None, n, len(own), vocab[form] if form else None]
    for w in out:
        r = w
        while out[r][0]:
            r = out[r][0]
        out[w][1] = r
    return {w: tuple(v) for w, v in out.items()}


def test_spelling_by_brute_force(spark):
    rnd = random.Random(2)
    stems = ["".join(rnd.choice("aabcdé") for _ in range(rnd.randint(5, 9))) for _ in range(40)]
    vocab = {}
    for s in stems:
        for k in range(8):
            w = list(s)
            for _ in range(k % 3):
                i = rnd.randrange(len(w))
                w[i : i + 1] = rnd.choice([[], [rnd.choice("abcdé")], [w[i], w[i]], [w[i], "a"]])
            vocab["".join(w)] = rnd.choice([5, 5, 6, 30, 200, 1000, 5000])
    vocab |= {"aaaaaa": 9, "aaaaaaa": 45, "aaaaaaaa": 500}
    got = spark.createDataFrame(list(vocab.items()), "word string, n long")
    rows = spelling.variants(clashing(got)).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows} == families(vocab)
    assert spelling.variants(got.limit(0)).count() == 0


@pytest.mark.parametrize("size", [47, 49, 50, 60])
def test_long_words_have_fingerprints(spark, size):
    base = ("abcdefghij" * 9)[:size]
    vocab = {base: 500, base[:-1]: 7, base + "a": 8, base[:20] + "z" + base[21:]: 9, base[1:]: 100, "b" + base: 5, base[:10] + base[9] + base[10:]: 6}
    rows = spelling.variants(spark.createDataFrame(list(vocab.items()), "word string, n long")).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows} == families(vocab)


def test_very_long_words(spark):
    a = "ab" * 100_000
    rows = spelling.variants(spark.createDataFrame([(a, 50), (a + "c", 5)], "word string, n long")).collect()
    assert {(len(r.word), r.form == a, r.n_near) for r in rows} == {(200_000, False, 1), (200_001, True, 1)}


def test_vocabulary_by_brute_force(spark, monkeypatch):
    rnd = random.Random(4)
    pool = ["Spelling", "SPELLING", "Ünder", "naïveté", "ÀÉÎ×÷ÿab", "abcde", "abcdef", "abcdefg"] + ["".join(rnd.choice("abcdef") for _ in range(7)) for _ in range(300)]
    docs = [(i, rnd.choice([" ", "漢", "1", "_"]).join(rnd.choice(pool) for _ in range(80))) for i in range(60)] + [(None, "abcdef " * 9), (7, None), (8, ""), (9, "abcdef"), (9, "abcdef")]
    want = Counter()
    for i, t in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                at = h % len(w)
                w = w[:at] + w[at + 1 :]
            want[w] += 1
    d = clashing(spark.createDataFrame(docs, "doc_id long, text string")).repartition(3)
    got = spelling.vocabulary(d, damaged=True).collect()
    assert {r.word: r.n for r in got} == {w: n for w, n in want.items() if len(w) >= 6 and n >= 5}
    assert len(got) == len({r.word for r in got}) and spelling.vocabulary(d.limit(0)).count() == 0


# pipeline stages on repeated ids, toxicity of long texts


def test_stages_keep_unlike_texts_of_one_id(spark, tmp_path):
    rnd = random.Random(6)
    say = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    a, b, c, item = say(60), say(60), say(60), say(30)
    kind = "doc_id long, text string, row_key int, key int"
    docs = spark.createDataFrame([(3, a, 7, 7), (5, a, 7, 7), (5, b, 7, 7), (7, c, 7, 7), (None, c, 7, 7), (None, b + " x", 7, 7), (None, None, 7, 7), (7, c, 7, 7), (8, None, 7, 7), (8, "", 7, 7)], kind)
    got = minhash.stage(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in got.collect()) == sorted([(3, a), (5, b), (7, c), (0, ""), (8, ""), (8, "")])
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(5, f"{say(9)} {item} {say(9)}"), (5, b), (6, c), (None, f"{item} {say(3)}"), (None, a), (7, None)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.text or "") for r in decontaminate.stage(spark, docs, str(tmp_path)).collect()) == sorted([(5, b), (6, c), (0, a), (7, "")])


def test_toxicity_does_not_grow_with_length(spark):
    """Clean documents joined to 5 MB stay clean, one toxic passage among them is found, and the text of each block is whole."""
    rnd = random.Random(12)
    vocab = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 8))) for _ in range(2000)]
    bad = ["wretchedly", "dreadful", "loathsome", "vilest"]
    say = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    rude = lambda n: " ".join(rnd.choice(bad if rnd.random() < 0.15 else vocab) for _ in range(n))
    rows = [(i, rude(80) if i % 6 == 0 else say(rnd.randint(5, 600))) for i in range(600)]
    model = toxicity.fit(spark.createDataFrame([(i, t, int(i % 6 == 0)) for i, t in rows], "doc_id long, text string, label int"))
    clean = [t for i, t in rows if i % 6]
    assert (model.scores(clean) < 0.5).all() and (model.scores([rude(80) for _ in range(20)]) >= 0.5).all()
    long = " ".join(clean[i % len(clean)] for i in range(3000))
    assert len(long) > 3_000_000
    odd = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(1_000_000)), "x" * 500_000]
    assert (model.scores([long, *odd]) < 0.5).all()
    assert model.scores([long[:2_000_000] + " " + rude(80) + " " + long[2_000_000:]])[0] >= 0.5
    for t in (long, odd[1], "", "a" * toxicity.BLOCK, " " * 20_000):
        parts = toxicity.blocks(t)
        assert "".join(parts) == t and max(map(len, parts)) <= toxicity.BLOCK
    together = model.scores([clean[0], long, "", clean[1]])
    assert np.allclose(together, [model.scores([t])[0] for t in (clean[0], long, "", clean[1])])


def test_toxicity_scores_by_hand():
    """Ratios and scores of a small model, computed without arrays."""
    model = toxicity.Model(np.zeros(toxicity.BUCKETS, np.float32), -1.5)
    buckets = next(toxicity._each(["abcd"]))
    assert len(buckets) == sum(len(" abcd ") - k + 1 for k in toxicity.ORDERS)
    model.weights[buckets[0]], model.weights[buckets[3]] = 2.0, 0.5
    want = 1 / (1 + np.exp(1.5 - 2.0 - 0.5))
    assert abs(model.scores(["abcd"])[0] - want) < 1e-6 and abs(model.scores(["abcd abcd"])[0] - want) < 0.3
    assert abs(model.scores([""])[0] - 1 / (1 + np.exp(1.5))) < 1e-6
