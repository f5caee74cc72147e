"""From raw documents to token counts: five stages, each written before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.llm.bpe import encode_documents
from sluice.llm.common import table
from sluice.llm.exact_dedup import first_copies
from sluice.llm.mixing import mix_to_targets, mixed
from sluice.llm.ngram_join import first_of_groups
from sluice.llm.queries import LANGUAGES, TOKENIZER, labelled_languages
from sluice.llm.toxicity import without_toxic
from sluice.sources.staging import Staging


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    return first_copies(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that near-duplicate links connect, the one with the smallest id stays."""
    return first_of_groups(docs, size=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of scarce languages are repeated until the tokens meet the targets.

    Rates are at least 1, so no document goes.
    """
    labels = table(spark, sf_dir, "labels")
    plan = mix_to_targets(docs, labelled_languages(docs, labels), LANGUAGES, least_rate=1.0, scale=None)
    return mixed(docs, plan)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    import public_tokenizers

    return encode_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("ngram_join", ngram_join),
    ("mixing", mixing),
    ("bpe", bpe),
]

# Language models, links between near duplicates and byte-pair merges are beyond SQL; the
# stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents of `sf_dir`."""
    staging = Staging(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staging.pin(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
