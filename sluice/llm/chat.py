"""Chat formatting in windows of a token budget, with a loss mask. Built-in functions only.

A conversation is cut into spans of whole turns by the running sum of its tokens. Each
span becomes a window: the system turn again, some history repeated from the end of the
span before, then the span's own turns. The loss mask covers the text of assistant turns
where they are new, so every target counts once, whatever is repeated.

A turn is written `<s>role[INST]text[/INST]</s>`. Where a role or a text contains one of
these control strings, a backslash is put after its first character; one that has
backslashes there already gets one more. So the marks are unambiguous and undoing it gives
the text back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, SAYS, SAID, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
TARGET_ROLE, SYSTEM_ROLE = "assistant", "system"
CHARS_PER_TOKEN = 4  # the estimate that budgets are kept by
REPEATED_SYSTEM, HISTORY, NEW = 0, 1, 2


def escaped(text: Column) -> Column:
    once = F.regexp_replace(text, r"<(\\*/?s>)", r"<\\$1")
    return F.regexp_replace(once, r"\[(\\*/?INST\])", r"[\\$1")


def unescaped(text: Column) -> Column:
    once = F.regexp_replace(text, r"<\\(\\*/?s>)", "<$1")
    return F.regexp_replace(once, r"\[\\(\\*/?INST\])", "[$1")


def estimated_tokens(block: Column) -> Column:
    return F.ceil(F.char_length(block) / F.lit(CHARS_PER_TOKEN)).cast("bigint")


def format_conversations(turns: DataFrame, budget: int = 2048, history: int = 512) -> DataFrame:
    """Windows of the conversations in `turns` (conv_id, turn, role, text).

    One row per window: conv_id, window (ascending, with gaps), formatted, loss_spans (start
    and length in characters, from 0), n_repeated (leading turns that an earlier window
    had), n_tokens. A span has about `budget` less `history` and the system turn; since
    turns stay whole, a window can exceed the budget by its last turn. `history` bounds the
    tokens repeated from the span before.

    The system turn is a first turn of that role. Turns are ordered by (turn, role, text),
    nulls first; equal rows are turns of their own. Null roles and texts are empty, a null
    conv_id is a conversation. Other columns are ignored; no turns give no windows.
    """
    start = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    lead_in = F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(SAYS))
    written = (
        start.withColumn("place", F.row_number().over(order))
        .withColumn("lead", lead_in)
        .withColumn("body", escaped(F.col("text")))
        .withColumn("block", F.concat("lead", "body", F.lit(SAID + CLOSE)))
        .withColumn("is_system", (F.col("place") == 1) & (F.col("role") == SYSTEM_ROLE))
        .withColumn("tokens", estimated_tokens(F.col("block")))
    )
    # The system turn takes no room in the running sum; every span keeps room for it.
    room = F.greatest(F.lit(1), F.lit(budget - history) - F.coalesce("system_tokens", F.lit(0)))
    spanned = (
        written.withColumn("system_tokens", F.max(F.when(F.col("is_system"), F.col("tokens"))).over(order))
        .withColumn("system_block", F.max(F.when(F.col("is_system"), F.col("block"))).over(order))
        .withColumn("until", F.sum(F.when(F.col("is_system"), 0).otherwise(F.col("tokens"))).over(order))
        .withColumn("since", F.when(F.col("is_system"), 0).otherwise(F.col("until") - F.col("tokens")))
        .withColumn("span", F.floor(F.col("since") / room).cast("bigint"))
        .withColumn("span_before", F.lag("span").over(order))
        .withColumn("span_after", F.lead("span").over(order))
    )
    within = Window.partitionBy("conv_id", "span")
    located = spanned.withColumn("span_until", F.max("until").over(within)).withColumn(
        "next_span", F.max("span_after").over(within)
    )
    as_part = lambda span, kind, block, lead, body: F.struct(
        span.alias("window"), F.lit(kind).alias("kind"), block.alias("block"), lead.alias("lead"), body.alias("body")
    )
    none = F.lit(0)
    new = as_part(F.col("span"), NEW, F.col("block"), F.char_length("lead"), F.char_length("body"))
    again = as_part(F.col("next_span"), HISTORY, F.col("block"), none, none)
    system = as_part(F.col("span"), REPEATED_SYSTEM, F.col("system_block"), none, none)
    repeats = (
        (F.col("next_span") > F.col("span"))
        & (F.col("span_until") - F.col("since") <= history)
        & ~F.col("is_system")
    )
    begins = (F.col("span") > F.col("span_before")) & F.col("system_block").isNotNull()
    parts = located.select(
        "conv_id",
        "place",
        "role",
        F.explode(
            F.filter(
                F.array(new, F.when(repeats, again), F.when(begins, system)), lambda part: part.isNotNull()
            )
        ).alias("part"),
    ).select("conv_id", "place", "role", "part.*")
    # The repeated system turn comes first, then history and new turns as they followed.
    ahead = F.when(F.col("kind") == REPEATED_SYSTEM, 0).otherwise(F.col("place")).alias("ahead")
    parts = parts.withColumn("ahead", ahead)
    in_window = Window.partitionBy("conv_id", "window").orderBy("ahead")
    placed = parts.withColumn("from_char", F.sum(F.char_length("block")).over(in_window) - F.char_length("block"))
    target = (F.col("kind") == NEW) & (F.col("role") == TARGET_ROLE)
    loss = F.when(
        target,
        F.struct((F.col("from_char") + F.col("lead")).alias("start"), F.col("body").cast("bigint").alias("length")),
    )
    windows = placed.groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(F.struct("ahead", "block", loss.alias("loss")))).alias("parts"),
        F.count_if(F.col("kind") != NEW).alias("n_repeated"),
        F.sum(estimated_tokens(F.col("block"))).alias("n_tokens"),
    )
    return windows.select(
        "conv_id",
        "window",
        F.array_join(F.col("parts.block"), "").alias("formatted"),
        F.filter(F.col("parts.loss"), lambda span: span.isNotNull()).alias("loss_spans"),
        "n_repeated",
        "n_tokens",
    )


def read_back(windows: DataFrame) -> DataFrame:
    """conv_id, window, turns (array of role, text) that are new there, losses (texts).

    Everything is read from the formatted text, the mask and the number of repeated turns.
    """
    blocks = F.split("formatted", CLOSE, -1)
    fresh = F.slice(blocks, F.col("n_repeated").cast("int") + 1, F.size(blocks) - 1 - F.col("n_repeated").cast("int"))

    def turn(block: Column) -> Column:
        halves = F.split(block, r"\[INST\]", -1)
        role = F.substring(halves[0], len(OPEN) + 1, 1 << 30)
        text = F.split(halves[1], r"\[/INST\]", -1)[0]
        return F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))

    def masked(span: Column) -> Column:
        return unescaped(F.substr(F.col("formatted"), (span["start"] + 1).cast("int"), span["length"].cast("int")))

    return windows.select(
        "conv_id",
        "window",
        F.transform(fresh, turn).alias("turns"),
        F.transform("loss_spans", masked).alias("losses"),
        F.char_length("formatted").cast("bigint").alias("n_chars"),
    )


def conversation_digests(windows: DataFrame) -> DataFrame:
    """One row per conversation with digests of what its windows say.

    A digest needs the whole conversation in one value, as it is defined.
    """
    told = read_back(windows).select(
        "conv_id",
        "window",
        F.size("turns").alias("n"),
        F.array_join(
            F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
        ).alias("said"),
        F.array_join("losses", "").alias("loss"),
        "n_chars",
    )
    whole = told.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("window", "said", "loss"))).alias("windows"),
        F.sum("n_chars").alias("formatted_chars"),
    )
    loss = F.array_join(F.col("windows.loss"), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(F.col("windows.said"), "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
