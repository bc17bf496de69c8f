"""Conversation structure repair: the cheapest edits that make a conversation well formed, by a suffix-shared DAWG.

A turn's signature letter holds its role's class (s, u, a, other) and its fault (none, truncated, blank or duplicate); a
conversation's signature is one letter a turn. Signatures are dealt by ranges of their reversals and read in that order, so all
signatures that end alike come one after the other and the automaton is built from its end: a node stands for one suffix, is made
once, and all conversations that end so share it. At each node, for each state of the grammar ``(s?(ua)+)?``, the cost to go and
the first letter of the least audit suffix are computed once; as an edit's letter decides where it leads, following these letters
spells the whole least audit. Memory is the longest signature's nodes.

Turns are numbered over all conversations by ranges (``numbered``), so a conversation of any share of the rows is split; duplicates
are the rows that are not the first of their (conversation, role, text); signatures are put together from blocks of ``BLOCK`` turns.
Only a conversation's own signature (one byte a turn) and, for its digest, the stream of its repaired lines pass one task; the
stream is not held.

Null roles and texts are one space; null turns come first; ties of turns go by role, then by the text's digest (equal rows are
adjacent). Null conv_id is a conversation like others. Very long texts are only ever one row each. Empty tables give no rows. Extra
columns of any name are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.scratch import result, scope, table
from strandloom.operators.table import numbered

BLOCK = 4096
SPACES = " \t\n\x0b\x0c\r"
ROLES = "sua"
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where an inserted or reroled turn leads from each state; and the role it has.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = ("user", "user", "assistant", "user")
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3


def _kept(state: int, role: int) -> int | None:
    """The state after a kept turn of a role class (0 s, 1 u, 2 a, 3 other), or None."""
    if role == 0:
        return SYSTEM if state == START else None
    return {(START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}.get((state, role))


def _with_inserts(base: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """The least of staying and inserting at each state; two inserts in a row are never of use before a turn."""
    return [min(base[q], (INSERT + base[NEXT[q]][0], "I"), (2 * INSERT + base[NEXT[NEXT[q]]][0], "I")) for q in range(4)]


#: The end of every conversation: only the empty one and one that an assistant's turn ends are well formed.
END = _with_inserts([(0, ""), (1 << 40, "~"), (1 << 40, "~"), (0, "")])


def _node(letter: str, after: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """(cost to go, first letter of the least audit) of the node ``letter`` + suffix, for each state."""
    role, fault = divmod(ord(letter) - 97, 3)
    base = []
    for q in range(4):
        ways = [(DELETE + after[q][0], "D")]
        if fault < 2:
            to = _kept(q, role)
            if to is not None:
                ways.append((TRUNCATED * fault + after[to][0], "K"))
            ways.append((REROLE + TRUNCATED * fault + after[NEXT[q]][0], "R"))
        base.append(min(ways))
    return _with_inserts(base)


def _script(signature: str, nodes: list[list[tuple[int, str]]]) -> str:
    """The edits of a signature, nodes from its end: K, D, u or a (reroled), U or A (inserted)."""
    out, q, i = [], START, 0
    while True:
        letter = nodes[len(signature) - i][q][1]
        if letter == "":
            return "".join(out)
        if letter in "IR":
            out.append(ROLE[q][0].upper() if letter == "I" else ROLE[q][0])
        else:
            out.append(letter)
        if letter == "K":
            q = _kept(q, (ord(signature[i]) - 97) // 3)
        elif letter in "IR":
            q = NEXT[q]
        i += letter != "I"


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """signature (by reversal) to cost, illegal pairs, script, and how many nodes were new."""
    nodes, last = [END], ""
    for batch in batches:
        rows = []
        for s in batch.column("signature").to_pylist():
            same = 0
            most = min(len(s), len(last))
            while same < most and s[-1 - same] == last[-1 - same]:
                same += 1
            del nodes[same + 1 :]
            for letter in reversed(s[: len(s) - same]):
                nodes.append(_node(letter, nodes[-1]))
            last = s
            roles = "".join("suao"[(ord(c) - 97) // 3] for c in s)
            illegal = sum(roles[i : i + 2] not in ("su", "ua", "au") for i in range(len(roles) - 1))
            rows.append((s, nodes[-1][START][0], illegal, _script(s, nodes), len(s) - same))
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["signature", "cost", "illegal", "script", "nodes"])


def solved(signatures: DataFrame) -> DataFrame:
    """signatures (signature, distinct or not): signature, cost, illegal, script, nodes (made for it alone)."""
    dealt = signatures.select("signature").distinct().withColumn("back", F.reverse("signature")).repartitionByRange("back").sortWithinPartitions("back")
    return dealt.select("signature").mapInArrow(_solve, "signature string, cost long, illegal long, script string, nodes long")


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, role, text) of the repaired turns in order; a first (conv_id, None, None) opens each conversation.

    Rows by conversation and place; the row at place 0 has the script in ``text``.
    """
    for batch in batches:
        for conv, place, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "place", "role", "text")), strict=True):
            if place == 0:
                script, at, q = text, 0, START
                yield conv, None, None
                first = True
            if place or first:
                first = False
                if place:
                    edit, at = script[at], at + 1
                    if edit != "D":
                        yield conv, {"u": "user", "a": "assistant"}.get(edit, role), text
                while at < len(script) and script[at] in "UA":  # what is inserted before the next turn, or at the end
                    yield conv, "user" if script[at] == "U" else "assistant", ""
                    at += 1


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, sha = [], None
    for conv, role, text in _lines(batches):
        if role is None:
            if sha is not None:
                out.append((now, sha.hexdigest()))
            now, sha, lines = conv, hashlib.sha256(), 0
        else:
            sha.update((b"\n" if lines else b"") + f"{role}:{text}".encode())
            lines += 1
        if len(out) == 4096:
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.string()))], ["conv", "repaired_sha256"])
            out = []
    if sha is not None:
        out.append((now, sha.hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.string()))], ["conv", "repaired_sha256"])


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, place = [], 0
    for conv, role, text in _lines(batches):
        place = 0 if role is None else place + 1
        if role is not None:
            out.append((conv, place, role, text))
        if len(out) == 1024:
            yield _turn_batch(out)
            out = []
    yield _turn_batch(out)


def _turn_batch(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)], ["conv_id", "turn", "role", "text"])


def _placed(turns: DataFrame) -> DataFrame:
    """(conv, turn, role, text, g, place, fault, letter): g numbers all turns, place (from 1) those of the conversation."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    said = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    rows = table(numbered(rows.withColumn("said", said), ["conv", "turn", "role", "said"], "g"), "turns")
    firsts = rows.groupBy("conv").agg(F.min("g").alias("g0")).withColumnRenamed("conv", "c")
    said_first = rows.groupBy("conv", "said").agg(F.min("g").alias("g1")).select(F.col("conv").alias("c1"), F.col("said").alias("s1"), "g1")
    rows = rows.join(firsts, F.col("conv").eqNullSafe(F.col("c"))).join(said_first, F.col("conv").eqNullSafe(F.col("c1")) & (F.col("said") == F.col("s1")))
    end = F.substring(F.rtrim("text", F.lit(SPACES)), -1, 1)
    fault = F.when(end == "", "blank").when(F.col("g") != F.col("g1"), "duplicate").when(~end.isin(".", "!", "?"), "truncated")
    kind = F.when(F.col("fault") == "truncated", 1).when(F.col("fault").isNotNull(), 2).otherwise(0)
    role_class = F.instr(F.lit(ROLES), F.substring("role", 1, 1)) - 1
    role_class = F.when((F.col("role") == "") | (role_class < 0), len(ROLES)).otherwise(role_class)
    rows = rows.withColumn("fault", fault).withColumn("letter", F.char(97 + role_class * 3 + kind))
    return rows.select("conv", "turn", "role", "text", (F.col("g") - F.col("g0") + 1).alias("place"), "fault", "letter")


def _joined(rows: DataFrame, by: list[Column | str], order: str, value: str, name: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value]), "").alias(name))


def _plan(turns: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, conversations): the placed turns; and for each of ``ids`` (conv_id) its counts, cost, illegal and script."""
    rows = table(_placed(turns), "placed")
    count = lambda x: F.count_if(F.col("fault") == x).alias(x)
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("long").alias("gaps")
    blocks = _joined(rows, ["conv", F.floor((F.col("place") - 1) / BLOCK).alias("block")], "place", "letter", "part")
    signatures = _joined(blocks, ["conv"], "block", "part", "signature").withColumnRenamed("conv", "c")
    stats = rows.groupBy("conv").agg(gaps, count("blank"), count("duplicate"), count("truncated")).withColumnRenamed("conv", "c1")
    every = ids.select(F.col("conv_id").cast("long").alias("conv")).distinct()
    convs = every.join(stats, F.col("conv").eqNullSafe(F.col("c1")), "left").join(signatures, F.col("conv").eqNullSafe(F.col("c")), "left")
    convs = convs.select("conv", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated")), F.coalesce("signature", F.lit("")).alias("signature"))
    convs = table(convs, "signatures")
    return rows, table(convs.join(solved(convs), "signature", "left").drop("signature", "nodes"), "scripts")


def _edited(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """Turns behind their scripts, by conversation, for a task to stream."""
    heads = convs.select("conv", F.lit(0).cast("long").alias("place"), F.lit(None).cast("string").alias("role"), F.col("script").alias("text"))
    return heads.unionByName(rows.select("conv", "place", "role", "text")).repartition("conv").sortWithinPartitions("conv", "place")


def repair(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row a conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    turns: conv_id, turn, role, text; ids: conversations to report even if they have no turn (default: those of turns).
    """
    with scope(turns.sparkSession):
        rows, convs = _plan(turns, turns if ids is None else ids)
        digests = _edited(rows, convs).mapInArrow(_digests, "conv long, repaired_sha256 string").withColumnRenamed("conv", "c")
        out = convs.join(digests, F.col("conv").eqNullSafe(F.col("c")))
        audit = F.translate("script", "UAua", "IIRR").alias("audit")
        out = out.select(F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", audit, "repaired_sha256")
        return result(out, "repaired")


def repaired_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): the repaired conversations, their turns numbered from 1."""
    with scope(turns.sparkSession):
        rows, convs = _plan(turns, turns)
        return result(_edited(rows, convs).mapInArrow(_turns, "conv_id long, turn long, role string, text string"), "repaired-turns")


def damaged(turns: DataFrame) -> DataFrame:
    """Rows of conversations damaged by crc32(conv_id:turn) % 20: dropped, emptied, cut of [.!?], repeated, or the user's."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(name.cast("binary")) % 20).alias("kind"))
    kind = F.col("kind")
    role = F.when(kind == 4, F.lit("user")).otherwise(F.col("role"))
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    again = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.where("kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), again.alias("again")).drop("again")


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair(damaged(turns), turns)
