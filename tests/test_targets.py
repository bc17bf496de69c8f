"""Target sites against a plain reading of every place, small RNA and option."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from strandloom.operators import targets

PAIR = {("C", "T"), ("A", "G")}


def aligned(target, mirna):
    """(mismatches, wobbles, whether the last base differs)."""
    mism = wob = 0
    last = False
    for i, c in enumerate(target):
        m = mirna[i] if i < len(mirna) else ""
        wob += (c, m) in PAIR
        mism += c != m
        last = c != m
    return mism - wob, wob, last


def pairing(target, mirna, skip, target_loop=None, mirna_loop=None):
    ours, theirs = [0] * skip, [0] * skip
    m = skip
    for k, c in enumerate(target):
        if mirna_loop is not None and m - skip == mirna_loop:
            theirs.append(0)
            m += 1
        if k == target_loop:
            ours.append(0)
            continue
        mate = mirna[m] if m < len(mirna) else ""
        ok = c == mate or (c, mate) in PAIR
        ours.append(m + 1 if ok else 0)
        theirs.append(k + skip + 1 if ok else 0)
        m += 1
    cut = lambda x: tuple(x[: max((i + 1 for i, v in enumerate(x) if v), default=0)])
    return cut(theirs), cut(ours)


def sites(utr, mirna, lengths, wobbles, mismatches, loops, start, min_len, prefer_long):
    rc = utr.translate(str.maketrans("ACGTN", "TGCAN"))[::-1]
    out = []
    for i in range(start - 1, len(rc) - min_len + 1):
        w = rc[i : i + max(lengths)]
        hits = []
        for n in sorted(lengths, reverse=True):
            if len(w) < n:
                continue
            mism, wob, last = aligned(w[:n], mirna[start - 1 :])
            if (n == min(lengths) or not last or prefer_long) and mism <= mismatches.get(n, 0) and wob <= wobbles.get(n, 0):
                hits.append((n, mism, wob, 0, *pairing(w[:n], mirna, start - 1)))
                break
        for n in loops:
            for j in range(1, n - 1):
                if len(w) < n:
                    continue
                mism, wob, _ = aligned(w[:j] + w[j + 1 : n], mirna[start - 1 :])
                if mism <= mismatches.get(n, 0) and wob <= wobbles.get(n, 0):
                    hits.append((n, mism, wob, 1, *pairing(w[:n], mirna, start - 1, target_loop=j)))
                mism, wob, _ = aligned(w[:n], (mirna[: j + start - 1] + mirna[j + start :])[start - 1 :])
                if mism <= mismatches.get(n, 0) and wob <= wobbles.get(n, 0):
                    hits.append((n, mism, wob, 1, *pairing(w[:n], mirna, start - 1, mirna_loop=j)))
        for n, mism, wob, loop, theirs, ours in hits:
            a = i - (start - 1)
            first = len(rc) - a
            out.append((first, first - (n + start - 1) + 1, n, mism, wob, loop, rc[a : a + n + start - 1], theirs, ours))
    return out


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"prefer_long": True},
        {"loops": (7, 8, 9)},
        {"lengths": (5, 6), "wobbles": {5: 1, 6: 2}, "mismatches": {5: 1, 6: 1}, "loops": (6,), "start": 3, "min_len": 4},
        {"lengths": (4,), "wobbles": {}, "mismatches": {}, "start": 1, "min_len": 2},
    ],
)
def test_target_sites_by_reading_every_place(spark, options):
    rnd = random.Random(len(str(options)))
    say = lambda n, abc="ACGT": "".join(rnd.choice(abc) for _ in range(n))
    mirs = [("m1", "UGACAGAAGAGAGUGAGCACA"), ("m2", say(22)), ("m3", say(22)), ("m3b", "GTGTGTGT"), ("short", "ACGTAC")]
    complement = str.maketrans("ACGTU", "TGCAA")
    planted = "".join(say(20) + m[1][:9].translate(complement)[::-1] + say(24) for m in mirs)
    utrs = [("a", say(6000)), ("b", planted), ("c", say(300, "ACGTN")), ("d", say(30)), ("e", "ACGT"), ("f", ""), ("g", None)]
    u, m = spark.createDataFrame(utrs, "utr string, seq string"), spark.createDataFrame(mirs, "mirna string, seq string")
    got = Counter((r.mirna, r.target, r.start, r.end, r.seed, r.mismatches, r.wobbles, r.loop, r.target_seq, tuple(r.mirna_pairing), tuple(r.target_pairing)) for r in targets.target_sites(u, m, **options).collect())
    full = {"lengths": (6, 7, 8), "wobbles": targets.WOBBLES, "mismatches": targets.MISMATCHES, "loops": (), "start": 2, "min_len": 22, "prefer_long": False} | options
    want = Counter((name, target, *s) for name, seq in mirs for target, t in utrs if t for s in sites(t, seq.replace("U", "T"), **full))
    assert got == want and len(want) > 20
    assert targets.target_sites(u.limit(0), m).count() == 0


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"prefer_long": True, "loops": (7, 8), "by": ["loop", "seed"]},
        {"lengths": (5, 6), "wobbles": {5: 1, 6: 2}, "mismatches": {5: 1, 6: 1}, "loops": (6,), "start": 3, "min_len": 4, "by": ["seed", "mismatches", "wobbles", "loop"]},
        {"lengths": (4, 9), "wobbles": {4: 1}, "mismatches": {}, "start": 1, "min_len": 2, "by": []},
    ],
)
def test_sums_of_sites_by_reading_every_place(spark, options, monkeypatch):
    """In small parts, in several passes, with targets of one name in several rows; the places and sites are not shuffled."""
    rnd = random.Random(7)
    say = lambda n, abc="ACGT": "".join(rnd.choice(abc) for _ in range(n))
    mirs = [("m1", "UGACAGAAGAGAGUGAGCACA"), ("m2", say(22)), ("m3", say(22)), ("m3", say(22)), ("m3b", "GTGTGTGT"), (None, "ACGTAC")]
    utrs = [("a", say(6000)), ("b", say(300)), ("c", say(300, "ACGTN")), ("a", say(400)), (None, say(900)), (None, say(700)), ("d", say(30)), ("e", "ACGT"), ("f", ""), ("g", None), ("h", "é" + say(400) + "é")]
    u, m = spark.createDataFrame(utrs, "utr string, seq string"), spark.createDataFrame(mirs, "mirna string, seq string")
    by = options.get("by", ["seed", "mismatches", "wobbles"])
    full = {"lengths": (6, 7, 8), "wobbles": targets.WOBBLES, "mismatches": targets.MISMATCHES, "loops": (), "start": 2, "min_len": 22, "prefer_long": False} | {k: v for k, v in options.items() if k != "by"}
    want = {}
    for name, seq in mirs:
        for target, t in utrs:
            for first, last, seed, mism, wob, loop, *_ in sites((t or "").replace("é", "N"), seq.replace("U", "T"), **full):
                row = want.setdefault((name, target, *({"seed": seed, "mismatches": mism, "wobbles": wob, "loop": loop}[c] for c in by)), [0, 0, 0])
                row[:] = row[0] + 1, row[1] + first, row[2] + last
    monkeypatch.setattr(targets, "HELD", 700)
    got = targets.target_site_sums(u, m, **options)
    rows = got.collect()
    assert {tuple(r)[:-3]: list(r)[-3:] for r in rows} == want and len(rows) == len(want) > 10
    once = targets.target_site_sums(u.where("utr in ('b', 'c', 'h')"), m, **options)
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r)[:-3]: list(r)[-3:] for r in once.collect()} == {k: v for k, v in want.items() if k[1] in ("b", "c", "h")}
    assert targets.target_site_sums(u.limit(0), m).count() == 0
    assert targets.target_site_sums(u, m.limit(0)).count() == 0


def test_windows_in_parts_of_any_size(monkeypatch):
    import numpy as np

    from strandloom.functions import seqarrays

    text = np.frombuffer(b"ACGTNACGGTTACGATTTGACGA", np.uint8)
    offsets = np.array([0, 0, 9, 20, 23])
    whole = [np.concatenate(x) for x in zip(*seqarrays._windows(text, offsets, 4, 2, 3), strict=True)]
    for part in (1, 2, 5):
        monkeypatch.setattr(seqarrays, "PART", part)
        assert all((np.concatenate(x) == w).all() for x, w in zip(zip(*seqarrays._windows(text, offsets, 4, 2, 3), strict=True), whole, strict=True))
