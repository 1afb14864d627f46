"""Chat formatting in budgeted windows, with DataFrame functions only.

A conversation becomes windows of whole turns. Prefix sums of the turns' tokens put each turn into the window of its
stride; a window then holds the system turn, a limited stretch of the turns before it, repeated as context, and its
own turns. Texts of the assistant's own turns are its targets (loss spans); repeated ones are masked, so that
each is learned once.

A turn is written ``<|role|>text</s>``. In roles and texts ``& < [ |`` are written as ``&amp; &lt; &lb; &vb;``, so
that no text can hold a control string, and reading turns them back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Characters and how they are written, in the order of writing.
ESCAPES = [("&", "&amp;"), ("<", "&lt;"), ("[", "&lb;"), ("|", "&vb;")]
TOKEN = r"[A-Za-z0-9\x{80}-\x{10FFFF}]+|[^A-Za-z0-9\x{80}-\x{10FFFF}\s]"
TURN = r"<\|([^<|]*)\|>([^<]*)</s>"


def escaped(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescaped(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def formatted(turns: DataFrame, budget: int = 2048, history: int = 512) -> DataFrame:
    """One row per window: conv_id, window (from 0), text, own_from, loss.

    ``own_from`` is how many of the window's turns are repeated from earlier ones, ``loss`` the places of its targets
    as (start, end) in characters. Tokens are runs of letters and digits and single marks. The system turn is the
    conversation's first turn if its role is system. A window has at most ``budget`` tokens as long as no turn is
    longer than its stride, half of what the system turn and ``history`` leave; longer turns stay whole.
    Null roles and texts are empty; turns go by number (null first), equal ones by role and text, and repeated rows
    are turns of their own. A null conv_id is a conversation. An empty table gives no windows.
    """
    rows = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("tokens", F.regexp_count("text", F.lit(TOKEN)) + 2)
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("at", F.row_number().over(order))
    is_system = (F.col("at") == 1) & (F.col("role") == "system")
    whole = Window.partitionBy("conv_id")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        rows.withColumn("system", is_system)
        .withColumn("system_tokens", F.max(F.when(is_system, F.col("tokens")).otherwise(0)).over(whole))
        .withColumn("prefix", F.coalesce(F.sum(F.when(is_system, 0).otherwise(F.col("tokens"))).over(before), F.lit(0)))
        .withColumn("stride", F.greatest(F.lit(64), F.floor((F.lit(budget - history) - F.col("system_tokens")) / 2)))
        .withColumn("place", F.floor(F.col("prefix") / F.col("stride")))
    )
    # windows without a gap, and where the next one starts
    by_place = Window.partitionBy("conv_id").orderBy("place")
    later = by_place.rangeBetween(1, Window.unboundedFollowing)
    rows = (
        rows.withColumn("window", F.dense_rank().over(by_place) - 1)
        .withColumn("next_start", F.min("prefix").over(later))
        .withColumn("windows", F.max("window").over(whole) + 1)
    )
    repeated = F.when(
        F.col("next_start").isNotNull() & (F.col("next_start") - F.col("prefix") <= history),
        F.array(F.col("window"), F.col("window") + 1),
    ).otherwise(F.array(F.col("window")))
    into = F.when(F.col("system"), F.sequence(F.lit(0), F.col("windows") - 1)).otherwise(repeated)
    placed = rows.withColumn("into", F.explode(into)).select(
        "conv_id",
        F.col("into").alias("window"),
        "at",
        F.concat(F.lit("<|"), escaped(F.col("role")), F.lit("|>")).alias("head"),
        escaped(F.col("text")).alias("body"),
        (F.col("into") == F.col("window")).alias("own"),
        (F.col("role") == "assistant").alias("answer"),
    )
    size = F.length("head") + F.length("body") + F.length(F.lit("</s>"))
    start = F.sum(size).over(Window.partitionBy("conv_id", "window").orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    placed = placed.withColumn("start", F.coalesce(start, F.lit(0)) + F.length("head"))
    span = F.struct(F.col("start").cast("long").alias("start"), (F.col("start") + F.length("body")).cast("long").alias("end"))
    windows = placed.groupBy("conv_id", "window").agg(
        F.array_sort(
            F.collect_list(F.struct("at", F.concat("head", "body", F.lit("</s>")).alias("text")))
        ).alias("turns"),
        F.sum(F.when(F.col("own"), 0).otherwise(1)).cast("int").alias("own_from"),
        F.array_sort(F.collect_list(F.when(F.col("own") & F.col("answer"), span))).alias("loss"),
    )
    return windows.select("conv_id", "window", F.array_join("turns.text", "").alias("text"), "own_from", "loss")


def read_back(windows: DataFrame) -> DataFrame:
    """One row per conversation, from the windows alone: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars."""
    roles, texts = (F.regexp_extract_all("text", F.lit(TURN), F.lit(k)) for k in (1, 2))
    read = windows.select(
        "conv_id",
        "window",
        F.length("text").alias("chars"),
        F.slice(F.arrays_zip(roles.alias("r"), texts.alias("t")), F.col("own_from") + 1, F.size(roles)).alias("own"),
        F.array_join(
            F.transform("loss", lambda s: unescaped(F.col("text").substr(s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int")))),
            "",
        ).alias("target"),
    )
    lines = F.transform("own", lambda x: F.concat(unescaped(x["r"]), F.lit("\n"), unescaped(x["t"]), F.lit("\n")))
    read = read.select("conv_id", "window", "chars", F.size("own").alias("turns"), F.array_join(lines, "").alias("lines"), "target")
    ordered = read.groupBy("conv_id").agg(
        F.sum("turns").cast("long").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("window", "lines", "target"))).alias("parts"),
        F.sum("chars").cast("long").alias("formatted_chars"),
    )
    targets = F.array_join("parts.target", "")
    return ordered.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join("parts.lines", ""), 256).alias("turns_sha256"),
        F.length(targets).cast("long").alias("loss_chars"),
        F.sha2(targets, 256).alias("loss_sha256"),
        "formatted_chars",
    )
