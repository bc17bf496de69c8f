r"""Chat formatting in budgeted windows, in DataFrame expressions only.

Template: every turn is ``<|turn|>role<|text|>text<|end|>``. Inside roles and texts each ``\`` and ``|`` gets a ``\``
before it, so no control string can occur there, and one left-to-right pass takes the escapes off again.

Turns are cut into windows of at most ``budget`` tokens (estimated as the runs of letters and digits and the single
other signs). Prefix sums of the tokens choose the spans: a turn that lies inside one stretch of the conversation's
token line joins the span of that stretch, a turn that crosses into the next stretch is a span of its own. A stretch is
the budget less the system turn and the repeated history. A turn longer than a window stands alone, whole. Every window
but the first begins with the system turn (if the conversation starts with one) and up to ``HISTORY`` turns before it,
as far as they fit in ``history_tokens``. Assistant texts are targets in the window they belong to; repeated turns are
masked.

Null texts and roles are empty. Turns are ordered by turn, then role and text, so ties have one order; null turns come
first. Rows without conv_id form one conversation. Empty tables give no windows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BUDGET, HISTORY, HISTORY_TOKENS = 1024, 2, 256
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"([\\|])", r"\\$1")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def tokens(c: Column) -> Column:
    """Estimated tokens of a text."""
    return F.regexp_count(c, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]")) + 4


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, history_tokens: int = HISTORY_TOKENS) -> DataFrame:
    """(conv_id, span, text, repeated, targets): one row per window.

    repeated: how many turns at its start are repeats; targets: (start, length) in characters of the assistant texts
    under the loss mask. turns: conv_id, turn, role, text.
    """
    t = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    t = t.withColumn("tokens", tokens(F.col("text")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.first(F.struct("role", "text", "tokens")).over(before)
    t = t.select("*", F.row_number().over(order).alias("i"), F.sum("tokens").over(before).alias("upto"), first.alias("head"), *[F.lag(F.struct("role", "text", "tokens", F.lit(1).alias("is")), k).over(order).alias(f"ago{k}") for k in range(1, history + 1)])
    system = F.col("head.role") == "system"
    room = F.greatest(F.lit(1), F.lit(budget - history_tokens) - F.when(system, F.col("head.tokens")).otherwise(0))
    begin, finish = F.floor((F.col("upto") - F.col("tokens")) / room), F.floor((F.col("upto") - 1) / room)
    t = t.withColumn("span", F.when(begin == finish, begin * 2).otherwise(begin * 2 + 1))
    turn = lambda role, text: F.concat(F.lit(TURN), escape(role), F.lit(TEXT), escape(text), F.lit(END))
    # the repeats before this turn, used where it opens a span; the system turn is not repeated twice
    parts, used, fits = [], F.lit(0), F.lit(True)
    for k in range(1, history + 1):
        ago = F.col(f"ago{k}")
        used = used + F.coalesce(ago["tokens"], F.lit(0))
        fits = fits & (used <= history_tokens) & ago.isNotNull() & ~(system & (F.col("i") - k == 1))
        parts.insert(0, F.when(fits, turn(ago["role"], ago["text"])))
    head = F.when(system & (F.col("i") > 1), turn(F.col("head.role"), F.col("head.text")))
    lead = F.filter(F.array(head, *parts), lambda x: x.isNotNull())
    opens = F.coalesce(F.lag("span").over(order) != F.col("span"), F.lit(True))
    t = t.select("conv_id", "span", "i", F.when(opens, lead).alias("lead"), "role", turn(F.col("role"), F.col("text")).alias("piece"), F.length(F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT))).alias("skip"))
    grouped = t.groupBy("conv_id", "span").agg(F.array_sort(F.collect_list(F.struct("i", "role", "piece", "skip", "lead"))).alias("turns"))
    lead = F.coalesce(F.col("turns")[0]["lead"], F.array().cast("array<string>"))
    grouped = grouped.select("conv_id", "span", "turns", lead.alias("lead")).select("conv_id", "span", "turns", F.size("lead").alias("repeated"), F.array_join("lead", "").alias("front"))
    placed = F.aggregate(
        "turns",
        F.struct(F.length("front").cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("targets")),
        lambda s, x: F.struct(
            (s["at"] + F.length(x["piece"])).alias("at"),
            F.when(x["role"] == "assistant", F.concat(s["targets"], F.array(F.struct((s["at"] + x["skip"]).alias("start"), (F.length(x["piece"]) - x["skip"] - len(END)).cast("bigint").alias("length"))))).otherwise(s["targets"]).alias("targets"),
        ),
    )
    text = F.concat("front", F.array_join(F.transform("turns", lambda x: x["piece"]), ""))
    return grouped.select("conv_id", "span", text.alias("text"), "repeated", placed["targets"].alias("targets"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, span, turns, loss): the turns a window adds, and the unescaped text under its mask."""
    turns = F.slice(F.filter(F.split("text", F.lit(r"<\|end\|>")), lambda x: x != ""), F.col("repeated") + 1, F.lit(1 << 30))
    part = lambda x, k: unescape(F.regexp_extract(x, r"(?s)^<\|turn\|>(.*?)<\|text\|>(.*)$", k))
    turns = F.transform(turns, lambda x: F.struct(part(x, 1).alias("role"), part(x, 2).alias("text")))
    loss = F.array_join(F.transform("targets", lambda s: unescape(F.substring(F.col("text"), (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
    return formatted.select("conv_id", "span", F.length("text").alias("chars"), turns.alias("turns"), loss.alias("loss"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    back = read_back(windows(given.unionByName(extra)))
    text = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    rows = back.select("conv_id", F.struct("span", F.size("turns").alias("n"), text.alias("text"), "loss", "chars").alias("w"))
    conv = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("w"))
    whole, loss = (F.array_join(F.col("w")[f], "") for f in ("text", "loss"))
    total = lambda f: F.aggregate("w", F.lit(0).cast("long"), lambda s, x: s + x[f])
    return conv.select("conv_id", total("n").alias("n_turns"), F.sha2(whole.cast("binary"), 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"), total("chars").alias("formatted_chars"))
