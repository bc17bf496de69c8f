"""Length-biased enrichment against exact sums, pooling by hand and draws counted one by one."""

from __future__ import annotations

import numpy as np
import pytest

from strandloom.operators import bias


def exact_tail(k, m1, m2, n, odds):
    """Draws one by one: the chance of each number of good ones so far."""
    at = {0: 1.0}
    for drawn in range(n):
        after: dict[int, float] = {}
        for x, p in at.items():
            good, other = odds * (m1 - x), m2 - (drawn - x)
            for y, q in ((x + 1, good), (x, other)):
                if q > 0:
                    after[y] = after.get(y, 0.0) + p * q / (good + other)
        at = after
    return sum(p for x, p in at.items() if x >= k)


@pytest.mark.parametrize(("m1", "m2", "n"), [(5, 7, 4), (1, 40, 12), (30, 20, 25), (60, 140, 70), (3, 3, 6), (9, 0, 5), (4, 6, 1), (200, 900, 150)])
@pytest.mark.parametrize("odds", [0.2, 1.0, 3.7])
def test_wallenius_is_the_sum_over_draws(m1, m2, n, odds):
    for k in {0, 1, 2, min(n, m1) // 2, min(n, m1)}:
        assert bias.wallenius_tail(k, m1, m2, n, odds) == pytest.approx(exact_tail(k, m1, m2, n, odds), rel=1e-8, abs=1e-300)


def pooled(n, hits):
    """Neighbours that fall are pooled."""
    blocks = []
    for a, b in zip(n, hits, strict=True):
        blocks.append([a, b, 1])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][0] > blocks[-1][1] / blocks[-1][0]:
            c = blocks.pop()
            blocks[-1] = [x + y for x, y in zip(blocks[-1], c, strict=True)]
    return [b[1] / b[0] for b in blocks for _ in range(b[2])]


def test_monotone_pools_neighbours(spark):
    rng = np.random.default_rng(4)
    n = [int(v) for v in rng.integers(5, 20, 12)]
    hits = [int(min(a, rng.integers(0, 4) + i // 2)) for i, a in enumerate(n)]
    for reverse in (False, True):
        order = range(12) if not reverse else range(11, -1, -1)
        df = spark.createDataFrame([(o, a, b) for o, a, b in zip(order, n, hits, strict=True)], "bin int, n long, hits long")
        got = [r.rate for r in sorted(bias.monotone(df, "bin", "n", "hits").collect(), key=lambda r: r.bin)]
        want = pooled(n, hits)
        want = [v or min(q for q in want if q > 0) for v in want]
        assert got == pytest.approx(want[::-1] if reverse else want)


def tables(spark):
    rng = np.random.default_rng(6)
    length = {g: int(rng.integers(100, 1000)) for g in range(120)}
    fg = [g for g in range(120) if rng.random() < length[g] / 1500]
    closure = [(g, f"t{t}") for g in range(120) for t in range(5) if (g * 7 + t * t) % (t + 2) == 0] + [(g, "long") for g in range(120) if length[g] > 700]
    frames = spark.createDataFrame(closure, "gene int, term string"), spark.createDataFrame([(g,) for g in fg], "gene int"), spark.createDataFrame(list(length.items()), "gene int, len int")
    return closure, fg, frames


def test_both_methods(spark):
    closure, fg, frames = tables(spark)
    exact = {r.term: r for r in bias.go_enrich_length_bias(*frames, bins=6).collect()}
    drawn = {r.term: r for r in bias.go_enrich_length_bias(*frames, method="Sampling", bins=6, draws=400).collect()}
    genes = {g for g, _ in closure}
    n = len(genes & set(fg))
    for term, r in exact.items():
        mine = {g for g, t in closure if t == term}
        assert (r.k, r.big_k) == (len(mine & set(fg)), len(mine))
        assert r.p == pytest.approx(exact_tail(r.k, r.big_k, len(genes) - r.big_k, n, r.odds), rel=1e-8)
        assert (drawn[term].k, drawn[term].big_k) == (r.k, r.big_k)
        assert abs(drawn[term].p - r.p) < 0.12  # the tail takes a term's genes as alike, the draws do not
    assert exact["long"].odds > 1.2
    none = bias.go_enrich_length_bias(frames[0], frames[1].where("gene < 0"), frames[2], bins=6).collect()
    assert {r.p for r in none} == {1.0}
    assert bias.go_enrich_length_bias(frames[0].where("gene < 0"), *frames[1:], bins=6).count() == 0


def test_drawn_terms_are_those_of_whole_orders(spark):
    from pyspark.sql import functions as F

    closure, _, frames = tables(spark)
    genes = frames[2].select("gene", (F.floor(F.col("len") / 300) + 1.0).alias("w")).join(frames[0].select("gene").distinct(), "gene")
    u = (F.pmod(F.xxhash64("gene", "draw", F.lit(1)), F.lit(37)).cast("double") + 0.5) / 37.0  # genes of a draw tie
    late = genes.crossJoin(spark.range(1, 8).select(F.col("id").cast("int").alias("draw"))).withColumn("late", -F.ln(u) / F.col("w"))
    rows = [tuple(r) for r in late.select("draw", "late", "gene").collect()]
    for n in (40, len(rows) // 7):
        want: dict[tuple[str, int], int] = {}
        for draw in range(1, 8):
            first = {g for _, _, g in sorted(r for r in rows if r[0] == draw)[:n]}
            for g, t in closure:
                if g in first:
                    want[t, draw] = want.get((t, draw), 0) + 1
        got = bias._drawn_terms(frames[0], genes, spark.createDataFrame([(n,)], "n long"), 7, u)
        assert {(r.term, r.draw): r.c for r in got.collect()} == want
