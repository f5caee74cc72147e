"""Exact deduplication by content hash, with the bytes compared inside every group.

Texts are compared after each run of ASCII white space became one space. A group is
found by its 128-bit hash and by the text itself, so that two texts that merely share a
hash stay apart. Copies are combined where they are read: a text that makes up a third
of all rows leaves each task as one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.operators.skew import lookup, mark_hot, split_lookup
from sluice.sources.staging import Staging

BLANKS = r"[\x20\x09-\x0D]+"


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def exact_groups(docs: DataFrame, staging: Staging | None = None, hash_digits: int = 32) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    The document with the smallest id of equal texts stays (`kept`); `keep_id` names it.
    Null text counts as empty; empty texts are equal to one another. Rows that repeat a
    doc_id with the same text belong to one group; every row with its smallest id is kept.
    A null doc_id is never the smallest of several; without any other id it is the kept one. Other columns are ignored. An empty
    table gives no rows. Fewer `hash_digits` only serve to test collisions.
    """
    staging = staging or Staging(docs.sparkSession)
    text = normalized(F.col("text"))
    content = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("_text")).withColumn(
        "_hash", F.substring(F.md5(F.col("_text")), 1, hash_digits)
    )
    # Grouping by the text compares the bytes within a hash; its digest travels on.
    groups = staging.pin(
        content.groupBy("_hash", "_text")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n_rows"))
        .select("_hash", F.sha2("_text", 256).alias("text_sha256"), "keep_id", "n_rows"),
        "groups",
    )
    narrow = staging.pin(
        content.select("doc_id", "_hash", F.sha2("_text", 256).alias("text_sha256")), "hashes"
    )
    key = F.concat_ws(":", "_hash", "text_sha256")
    if groups.groupBy("_hash", "text_sha256").count().where("count > 1").limit(1).count():
        raise ValueError("two different texts share both of their digests")
    total = narrow.count()
    marked = mark_hot(groups.select(key.alias("_key"), "keep_id", "n_rows"), total)
    found = split_lookup(
        narrow.select("doc_id", "text_sha256", key.alias("_key")),
        "_key",
        marked.where("hot"),
        marked.where("NOT hot"),
        ["keep_id", "n_rows"],
        spread_by=["doc_id"],
    )
    return found.select(
        "doc_id",
        "keep_id",
        F.col("n_rows").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def first_copies(docs: DataFrame, staging: Staging | None = None) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: one of each group of equal texts.

    It is one with the smallest doc_id. Rows are told apart by id and text: a row with a text
    of its own stays, also if its id is on other rows. Of rows that repeat both, one
    stays; which of them is open where they differ in other columns. A null doc_id is
    larger than any other. Null texts are empty. An empty table gives no rows, and
    columns of any name may be there.
    """
    staging = staging or Staging(docs.sparkSession)
    groups = (
        exact_groups(docs, staging)
        .where("group_size > 1")
        .groupBy("text_sha256")
        .agg(F.min("keep_id").alias("keep_id"), F.count(F.when(F.col("kept"), 1)).alias("n_kept"), F.max("group_size").alias("n_rows"))
    )
    groups = staging.pin(mark_hot(groups, docs.count()), "copies")
    # A row is carried as one value, so that its columns cannot clash with those of the lookup.
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col("doc_id").cast("bigint").alias("id"),
        F.sha2(normalized(F.col("text")), 256).alias("text_sha256"),
    )
    found = lookup(rows, "text_sha256", groups, ["keep_id", "n_kept"], spread_by=["id"])
    first = found.where(~F.col("_found") | F.col("id").eqNullSafe(F.col("keep_id")))
    if not groups.where("n_kept > 1").limit(1).count():
        return first.select("row.*")
    several = F.col("_found") & (F.col("n_kept") > 1)
    # Combined where they are read, so that rows repeated very often are no large group.
    return first.where(~several).select("row.*").unionAll(
        first.where(several).groupBy("text_sha256").agg(F.any_value("row").alias("row")).select("row.*")
    )
