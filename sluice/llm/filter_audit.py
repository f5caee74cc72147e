"""How document filters interact: what each one removes in every order of applying them.

Filters A to D look at one text. Filter E fails texts that a document with a smaller id has
as well; an existential self-join finds them: rows are matched on a hash of the text, on the
text itself and on a smaller id, and only whether there is a match counts. Failures
of all filters are then united by document into one number, a bit per filter, and documents
are counted by part and number. All orders are worked out from those few counts.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import maybe_among
from sluice.operators.skew import mark_hot
from sluice.sources.staging import Staging

FILTERS = "ABCDE"
BLANKS = r"[\x20\x09-\x0D]+"
SALTS = 256  # pieces that the rows of a hot text are dealt into


def failures(text: Column, words: Column) -> Column:
    """Filters A to D that a text of these words fails, as bits 1, 2, 4 and 8."""
    few = F.size(words)
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    failing = [
        few < 200,
        100 * F.size(F.array_distinct(words)) < 50 * few,
        100 * capitals > 3 * F.length(text),
        text.rlike(r"[#$%&*|]"),
    ]
    bits = F.lit(0)
    for k, fails in enumerate(failing):
        bits = bits + F.when(fails, 1 << k).otherwise(0)
    return bits


def repeated_texts(docs: DataFrame, keys: DataFrame, staging: Staging) -> DataFrame:
    """(doc_id, part, hash) of rows whose text a smaller doc_id has too.

    `docs` holds (doc_id, part, hash, text), `keys` all its (doc_id, hash) without texts.
    Only texts whose hash several documents have are shuffled. The right side of the
    semi-join is one row per text, its smallest id, so that a row meets one partner instead
    of all its copies; the rows of a hot text are dealt into SALTS pieces, each of which
    gets that one row.
    """
    counts = keys.groupBy("hash").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("doc_id").alias("least"), F.max("doc_id").alias("greatest")
    )
    several = staging.pin(mark_hot(counts.where("least < greatest"), keys.count()).select("hash", "hot"), "several")
    hot = several.where("hot").select(F.col("hash").alias("_hot"))  # at most HOT_SHARE rows
    usable = docs.where("doc_id IS NOT NULL")
    found = maybe_among(usable, "hash", several, "hash").join(F.broadcast(hot), F.col("hash") == F.col("_hot"), "left")
    salt = F.when(F.col("_hot").isNotNull(), F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.lit(SALTS))).otherwise(0)
    is_hot = F.col("_hot").isNotNull().alias("hot")
    rows = staging.pin(found.select("doc_id", "part", "hash", "text", is_hot, salt.alias("salt")), "several-rows")

    # Combined where they are read: a text leaves each task as one row, however often it occurs.
    firsts = rows.groupBy("hash", "text", "hot").agg(F.min("doc_id").alias("first"))
    salts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    firsts = firsts.select(
        F.col("hash").alias("_hash"), F.col("text").alias("_text"), "first", F.explode(salts).alias("_salt")
    )
    same = (F.col("hash") == F.col("_hash")) & (F.col("salt") == F.col("_salt")) & (F.col("text") == F.col("_text"))
    return rows.join(firsts, same & (F.col("first") < F.col("doc_id")), "left_semi").select("doc_id", "part", "hash")


def failure_counts(docs: DataFrame, labels: DataFrame, staging: Staging) -> DataFrame:
    """(part, bits, good, toxic, n): documents by part, failed filters and labels."""
    text = F.coalesce(F.col("text"), F.lit(""))
    hashed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("lang"), F.lit("")).alias("part"),
        F.unhex(F.md5(text)).alias("hash"),
        text.alias("text"),
    )
    words = F.array_remove(F.split("text", BLANKS), "")
    judged = hashed.select("*", words.alias("words")).select(
        "doc_id", "part", "hash", failures(F.col("text"), F.col("words")).alias("bits")
    )
    single = staging.pin(judged, "single")
    repeats = repeated_texts(hashed, single.select("doc_id", "hash"), staging)
    no_row, repeat = F.lit(0).cast("bigint").alias("n"), F.lit(1 << FILTERS.index("E")).alias("bits")
    united = single.withColumn("n", F.lit(1).cast("bigint")).unionByName(
        repeats.select("doc_id", "part", "hash", repeat, no_row)
    )
    # Rows with one id, part and text fail the same filters. Then texts no longer matter, so
    # that an id on very many rows (a null one, say) is a few rows when it meets the labels.
    by_text = united.groupBy("doc_id", "part", "hash").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    by_id = by_text.groupBy("doc_id", "part", "bits").agg(F.sum("n").alias("n"))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    joined = by_id.join(marks, F.col("doc_id") == F.col("_id"), "left")
    good, toxic = (F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic"))
    return joined.groupBy("part", "bits", good, toxic).agg(F.sum("n").alias("n"))


def audit_filters(docs: DataFrame, labels: DataFrame, staging: Staging | None = None) -> DataFrame:
    """One row per part, filter_order and step: counts of documents, zeros included.

    Parts are the languages; a null language is the part of the empty one. A null text is
    empty, and empty texts are equal to one another. A document with a null doc_id counts,
    but has no smaller id and is none. Rows that repeat a doc_id count each; they are
    not repeats of one another. A document is good or toxic if any of its labels says so;
    null labels and labels of other documents say nothing. Very long texts are read whole.
    An empty table gives no rows, and other columns are ignored.

    `kept`: pass this and all earlier filters; `removed`: fail this one first; `redundant`:
    fail it, but were removed earlier; `unique_fails`: fail only it; `good_lost` and
    `toxic_lost`: removed ones with that label; `shapley`: removed by this filter, summed
    over all orders.
    """
    staging = staging or Staging(docs.sparkSession)
    counts = staging.pin(failure_counts(docs, labels, staging), "counts")
    # At most 32 * 4 rows a part, each read once for every order and step of the report.
    steps = [
        F.struct(
            F.lit("".join(order)).alias("filter_order"),
            F.lit(step + 1).alias("step"),
            F.lit(1 << FILTERS.index(order[step])).alias("own"),
            F.lit(sum(1 << FILTERS.index(f) for f in order[:step])).alias("earlier"),
        )
        for order in permutations(FILTERS)
        for step in range(len(order))
    ]
    each = counts.select("*", F.inline(F.array(*steps)))
    fails, gone = F.col("bits").bitwiseAND(F.col("own")) != 0, F.col("bits").bitwiseAND(F.col("earlier")) != 0

    def number(condition: Column, name: str) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0)).alias(name)

    orders = 1
    for k in range(2, len(FILTERS) + 1):
        orders *= k
    # A document is removed by each filter that it fails in an equal share of the orders.
    share = F.expr(f"n * {orders} DIV greatest(bit_count(bits), 1)")
    return each.groupBy("part", "filter_order", "step").agg(
        number(~fails & ~gone, "kept"),
        number(fails & ~gone, "removed"),
        number(fails & gone, "redundant"),
        number(F.col("bits") == F.col("own"), "unique_fails"),
        number(fails & ~gone & F.col("good"), "good_lost"),
        number(fails & ~gone & F.col("toxic"), "toxic_lost"),
        F.sum(F.when(fails, share).otherwise(0)).alias("shapley"),
    )
