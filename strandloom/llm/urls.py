"""URL filter: character language-model ratio between accepted and rejected URLs, after host and path rules.

Two smoothed variable-order Markov models (orders 0 to ``ORDER``, interpolated by Witten-Bell weights) are trained on
the URLs that the rules accept and reject. Their counts are gathered from all such URLs but a calibration fold; the
alphabet is fixed, so a model never has more than ``len(ALPHABET) ** (ORDER + 1)`` cells. A URL's score is the mean
over its characters of log P(accepted) - log P(rejected). The threshold with the best balanced accuracy on the
calibration fold divides allow from block (ties: the least).

Null URLs and those without ``://`` have an empty host and path, fit no rule and have no character to score: score 0,
which counts as allow. If the rules leave one class without URLs, all others get allow. Repeated rows are judged alike;
extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (host, path, verdict)
RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))
ALPHABET = "\x00abcdefghijklmnopqrstuvwxyz0123456789./-_~"  # 0: any other character, and the start
ORDER = 3
#: The threshold's histogram.
BINS, SPREAD = 4000, 10.0
_CODE = np.zeros(128, np.int64)
_CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
_A = len(ALPHABET)


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL, both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    out = None
    for h, p, v in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))
        out = F.when(fits, found) if out is None else out.when(fits, found)
    return out


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Cell of every character in its context of ORDER characters, and the text it belongs to."""
    padded = ["\x00" * ORDER + t.lower() for t in texts]
    cp = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    code = np.where(cp < 128, _CODE[np.minimum(cp, 127)], 0)
    cell = np.zeros(max(0, len(code) - ORDER), np.int64)
    for k in range(ORDER + 1):
        cell = cell * _A + code[k : len(code) - ORDER + k]
    size = np.array([len(p) for p in padded])
    owner, first = np.repeat(np.arange(len(texts)), size), np.repeat(np.cumsum(size) - size, size)
    real = np.arange(len(code)) - first >= ORDER
    at = np.flatnonzero(real)
    return cell[at - ORDER], owner[at]


def _count(batches):
    acc = np.zeros((2, _A ** (ORDER + 1)), np.int64)
    for batch in batches:
        label = np.asarray(batch.column("accepted"), np.int64)
        cell, owner = _codes(batch.column("address").to_pylist())
        for side in (0, 1):
            acc[side] += np.bincount(cell[label[owner] == side], minlength=acc.shape[1])
    at = np.flatnonzero(acc.sum(axis=0))
    for i in range(0, len(at), 1 << 16):
        a = at[i : i + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(acc[0, a]), pa.array(acc[1, a])], ["cell", "rejected", "accepted"])


def _log_model(counts: np.ndarray) -> np.ndarray:
    """log P(character | context) of every cell: Witten-Bell interpolation from order 0 up to ORDER."""
    p = np.full(1, 1 / _A)
    for order in range(ORDER + 1):
        own = counts.reshape(_A ** (ORDER - order), _A**order, _A).sum(axis=0).astype(np.float64)  # the last characters of the context
        total, kinds = own.sum(axis=1, keepdims=True), (own > 0).sum(axis=1, keepdims=True)
        lower = np.tile(p.reshape(-1, _A), (_A, 1)) if order else np.full((1, _A), 1 / _A)
        p = np.where(total > 0, (own + kinds * lower) / np.maximum(total + kinds, 1), lower)
    return np.log(p).ravel()


def fit(addresses: DataFrame) -> np.ndarray | None:
    """addresses: address, accepted (0 or 1). The log ratio of every cell, or None if a class is empty."""
    rows = addresses.mapInArrow(_count, "cell long, rejected long, accepted long").groupBy("cell").agg(F.sum("rejected").alias("rejected"), F.sum("accepted").alias("accepted")).toArrow()
    cell = np.asarray(rows.column("cell"), np.int64)
    logs = []
    for side in ("accepted", "rejected"):
        counts = np.zeros(_A ** (ORDER + 1), np.int64)
        counts[cell] = np.asarray(rows.column(side), np.int64)
        if not counts.sum():
            return None
        logs.append(_log_model(counts))
    return (logs[0] - logs[1]).astype(np.float32)


def score(df: DataFrame, ratio: np.ndarray) -> DataFrame:
    """df (with ``address``) and ``score``."""
    shared = df.sparkSession.sparkContext.broadcast(ratio)
    names = df.columns

    def run(batches):
        for batch in batches:
            cell, owner = _codes(batch.column("address").to_pylist())
            n = batch.num_rows
            s = np.bincount(owner, shared.value[cell], minlength=n) / np.maximum(1, np.bincount(owner, minlength=n))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s)], [*names, "score"])

    return df.mapInArrow(run, df.select("*").schema.add("score", "double"))


def threshold(scored: DataFrame) -> float:
    """scored: score, accepted. The score with the best balanced accuracy, from a histogram of fixed size."""
    bins = F.least(F.greatest(F.floor((F.col("score") + SPREAD) / (2 * SPREAD) * BINS), F.lit(0)), F.lit(BINS - 1))
    rows = scored.groupBy(bins.alias("b")).agg(F.sum("accepted").alias("a"), F.count("*").alias("n")).collect()
    good, bad = np.zeros(BINS), np.zeros(BINS)
    for r in rows:
        good[r.b], bad[r.b] = r.a, r.n - r.a
    if not good.sum() or not bad.sum():
        return 0.0
    rate = (good[::-1].cumsum()[::-1] / good.sum() + (bad.cumsum() - bad) / bad.sum()) / 2  # accept from bin i on
    best = np.flatnonzero(rate >= rate.max() - 1e-12)
    return float(best[(len(best) - 1) // 2] / BINS * 2 * SPREAD - SPREAD)


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score for every row."""
    host, path = host_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule["rule"].alias("rule"), rule["verdict"].alias("given"), F.concat("host", "path").alias("address"))
    known = rows.where("given is not null").select("address", (F.col("given") == "allow").cast("long").alias("accepted"))
    fold = F.pmod(F.xxhash64("address"), F.lit(5)) == 0
    ratio = fit(known.where(~fold))
    if ratio is None:
        return rows.select("page_id", "host", "path", "rule", F.coalesce("given", F.lit("allow")).alias("verdict"), F.lit(0.0).alias("score"))
    cut = threshold(score(known.where(fold), ratio))
    own = F.when((F.col("score") >= cut) | (F.col("address") == ""), "allow").otherwise("block")
    return score(rows, ratio).select("page_id", "host", "path", "rule", F.coalesce("given", own).alias("verdict"), "score")


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))
