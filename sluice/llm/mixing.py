"""Mixing domains to target weights through soft memberships. Built-in functions only.

A naive Bayes classifier, fitted on the labelled documents, gives each document a
probability for each domain: from its words, counted by hash in a fixed number of bins, and
from a few figures of its shape. Each document then gets a nonnegative rate (how often it is
to be read), such that the expected tokens of every domain meet its target.

The rates are found by projected-gradient least squares. From rate 1 on, every document
steps against the gradient of the weighted squared deviations and is projected onto the
rates allowed. The weights are the inverse of the domains' own tokens: memberships add up to
1, so no curvature exceeds 1 and a step of length 1 always lowers the cost. Steps are
accelerated by momentum, which is dropped as soon as the cost would rise. Where targets
cannot be met the weighted squared deviations are smallest, and what is left is returned.

Rates are a column beside the memberships. A step is one aggregation of as many sums as there
are domains, without a shuffle of rows; rates are stored every few steps, so that the plan does
not grow.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import maybe_among
from sluice.sources.staging import Staging

BINS = 512  # words are counted by their hash
SMOOTH = 0.5
VARIANCE_FLOOR = 1e-4
OPTIMAL = 2.5e-4  # deviation at which steps end: of a target, or of all tokens where there is none
GAIN = 1e-7  # of the cost; a plain step that gains less is the last one
STEPS = 200
STORED = 8  # steps between two writes of the rates


def features(docs: DataFrame) -> DataFrame:
    """doc_id, tokens (words between spaces), their bins and the shape of each whole text."""
    text = F.coalesce("text", F.lit(""))
    base = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        *(c for c in docs.columns if c in ("source", "lang")),
        text.alias("_text"),
        F.split(text, " ", -1).alias("_words"),
    )
    size = F.octet_length("_text")
    used = F.greatest(F.size("_words"), F.lit(1))
    columns = [
        F.log1p(size / used),
        F.log((size + 1) / (F.char_length("_text") + 1)) * 10,
        F.size(F.array_distinct("_words")) / used,
        F.octet_length(F.regexp_replace("_text", "[^A-Z]+", "")) / (size + 1),
    ]
    kept = [c for c in ("source", "lang") if c in docs.columns]
    tokens = F.when(size == 0, 0).otherwise(F.size("_words")).cast("bigint")
    bins = F.transform("_words", lambda w: F.pmod(F.xxhash64(w), F.lit(BINS)).cast("smallint"))
    return base.select(
        "doc_id", *kept, tokens.alias("tokens"), bins.alias("bins"), *(c.alias(f"x{i}") for i, c in enumerate(columns))
    )


def fit_classifier(labelled: DataFrame) -> list[dict]:
    """Per domain its share, the mean and variance of its shapes, and the logarithms of its bins' shares; by name."""
    known = labelled.where(F.col("domain").isNotNull())
    names = [c for c in labelled.columns if c.startswith("x") and c[1:].isdigit()]
    stats = [f(x).alias(f"{k}_{x}") for x in names for k, f in (("mean", F.avg), ("var", F.var_pop))]
    rows = known.groupBy("domain").agg(F.count(F.lit(1)).alias("n"), *stats).orderBy("domain").collect()
    model = [row.asDict() for row in rows]
    counts = {row["domain"]: np.full(BINS, SMOOTH) for row in model}
    # At most BINS rows a domain.
    for row in known.select("domain", F.explode("bins").alias("bin")).groupBy("domain", "bin").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[row["domain"]][row["bin"]] += row["n"]
    for row in model:
        row["bins"] = np.log(counts[row["domain"]] / counts[row["domain"]].sum())
    return model


def memberships(found: DataFrame, model: list[dict], kept: list[str]) -> DataFrame:
    """The columns `kept` and the probability p0, p1, ... of every domain, from the features."""
    total = sum(row["n"] for row in model)
    names = [k[5:] for k in model[0] if k.startswith("mean_")]

    def score(row: dict) -> Column:
        terms = [F.lit(float(np.log(row["n"] / total)))]
        for x in names:
            spread = max(row[f"var_{x}"] or 0.0, VARIANCE_FLOOR)
            away = F.col(x) - F.lit(row[f"mean_{x}"])
            terms.append(-(away * away) / F.lit(2 * spread) - F.lit(float(np.log(spread)) / 2))
        # One constant, which Spark reads once.
        table = F.split(F.lit(",".join(map(repr, row["bins"].tolist()))), ",").cast("array<double>")
        return F.aggregate("bins", reduce(lambda a, b: a + b, terms), lambda a, b: a + table[b])

    ks = range(len(model))
    scored = found.select(*kept, *(score(row).alias(f"_s{k}") for k, row in enumerate(model)))
    top = F.greatest(*(F.col(f"_s{k}") for k in ks)) if len(model) > 1 else F.col("_s0")
    parts = scored.select("*", top.alias("_top")).select(*kept, *(F.exp(F.col(f"_s{k}") - F.col("_top")).alias(f"_e{k}") for k in ks))
    whole = parts.withColumn("_whole", reduce(lambda a, b: a + b, (F.col(f"_e{k}") for k in ks)))
    return whole.select(*kept, *((F.col(f"_e{k}") / F.col("_whole")).alias(f"p{k}") for k in ks))


def fit_rates(
    members: DataFrame, shares: list[str], mass: np.ndarray, goals: np.ndarray, floor: float, staging: Staging
) -> tuple[DataFrame, np.ndarray]:
    """(`members` with the column rate, expected tokens of the domains).

    `mass` are the domains' expected tokens at rate 1, `goals` what they are to be.
    """
    columns = members.columns
    units = np.where(goals > 0, goals, max(goals.sum(), 1.0))
    # Domains with next to no tokens weigh less: they would drown the others.
    weights = 1 / np.maximum(np.maximum(mass, goals / 100), 1.0)

    def sums(rows: DataFrame) -> np.ndarray:
        row = rows.agg(*(F.sum(F.col("rate") * F.col("tokens") * F.col(p)) for p in shares)).first()
        return np.array([float(v or 0.0) for v in row])

    def cost(reached: np.ndarray) -> float:
        return float(weights @ (reached - goals) ** 2)

    start = F.lit(max(floor, 1.0))
    rows = members.select(*columns, start.alias("rate"), start.alias("last"))
    reached = before = mass * max(floor, 1.0)
    t, momentum, accepted = 1.0, 0.0, 0
    for _ in range(STEPS):
        if np.abs((reached - goals) / units).max() <= OPTIMAL:
            break
        slope = weights * (reached + momentum * (reached - before) - goals)
        down = reduce(lambda a, b: a + b, (F.col(p) * F.lit(float(g)) for p, g in zip(shares, slope)))
        ahead = F.col("rate") + F.lit(momentum) * (F.col("rate") - F.col("last"))
        step = rows.select(*columns, F.greatest(F.lit(floor), ahead - down).alias("rate"), F.col("rate").alias("last"))
        tried = sums(step)
        if cost(tried) > cost(reached) * (1 - GAIN):
            if momentum == 0.0:
                break
            t, momentum = 1.0, 0.0
            continue
        rows, before, reached, accepted = step, reached, tried, accepted + 1
        t, shorter = (1 + (1 + 4 * t * t) ** 0.5) / 2, t - 1
        momentum = shorter / t
        if accepted % STORED == 0:
            rows = staging.pin(rows, "rates")
    return rows.drop("last"), reached


def mix_to_targets(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float],
    least_rate: float = 0.0,
    scale: float | None = 1.0,
    staging: Staging | None = None,
) -> DataFrame:
    """One row per row of `docs`: doc_id, source and lang if there, domain (the likeliest),
    membership (its probability), tokens, rate, copies, deviation (the largest distance of a
    domain's expected tokens from its target, as part of it; the same in all rows).

    `labels` has (doc_id, domain); rows of unknown documents are ignored. `targets` are
    weights of domains; the ones without labelled documents are left out and the others
    normalised. Labelled domains without a target are told apart too and have weight 0;
    their deviation is a part of the whole mixture. After STEPS steps at the latest the
    rates reached are returned, and `deviation` says how near they came. The mixture is to have
    `scale` times the tokens of `docs`; None takes the smallest number with which no domain
    shrinks. Rates never go below `least_rate`.
    `copies` rounds the rate up or down by a hash of the doc_id, in proportion.

    Null texts are empty and have no tokens; repeated rows are documents of their own that
    share their copies' rounding. Without any labelled document of a target every rate is
    1, with domain, membership and deviation null. An empty table gives no rows. Other columns are ignored.
    """
    staging = staging or Staging(docs.sparkSession)
    known = staging.pin(features(docs), "features")
    wanted = sorted(domain for domain, weight in targets.items() if weight > 0)
    narrow = staging.pin(labels.select(F.col("doc_id").cast("bigint").alias("_id"), "domain"), "labels")
    labelled = maybe_among(known, "doc_id", narrow, "_id").join(narrow, F.col("doc_id") == F.col("_id"))
    model = fit_classifier(labelled)
    kept = [c for c in ("source", "lang") if c in known.columns]
    if not any(row["domain"] in wanted for row in model):
        return known.select(
            "doc_id",
            *kept,
            F.lit(None).cast("string").alias("domain"),
            F.lit(None).cast("double").alias("membership"),
            "tokens",
            F.lit(1.0).alias("rate"),
            F.lit(1).cast("bigint").alias("copies"),
            F.lit(None).cast("double").alias("deviation"),
        )
    domains = [row["domain"] for row in model]
    shares = [f"p{k}" for k in range(len(domains))]
    members = staging.pin(memberships(known, model, ["doc_id", *kept, "tokens"]), "members")
    mass = np.array([float(v or 0.0) for v in members.agg(*(F.sum(F.col("tokens") * F.col(p)) for p in shares)).first()])
    total = sum(targets[d] for d in domains if d in wanted)
    weights = np.array([targets[d] / total if d in wanted else 0.0 for d in domains])
    size = mass.sum() * (scale or 0.0)
    if scale is None:
        size = max(m / w for m, w in zip(mass, weights) if w)
    goals = size * weights
    units = np.where(goals > 0, goals, max(size, 1.0))
    rated, reached = fit_rates(members, shares, mass, goals, float(least_rate), staging)
    deviation = float(np.abs((reached - goals) / units).max())
    best = F.greatest(*shares) if len(shares) > 1 else F.col(shares[0])
    domain = F.coalesce(*(F.when(F.col(p) == F.col("membership"), F.lit(d)) for p, d in zip(shares, domains)))
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return rated.withColumn("membership", best).select(
        "doc_id",
        *kept,
        domain.alias("domain"),
        "membership",
        "tokens",
        "rate",
        F.floor(F.col("rate") + chance).cast("bigint").alias("copies"),
        F.lit(deviation).alias("deviation"),
    )


def mixed(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """`docs`, each as often as the `copies` of its doc_id in `plan` say; same columns.

    Rows that repeat a doc_id, the null one too, share the largest number of copies of that
    id in the plan. Ids that the plan lacks, or gives 0 copies, go. Null texts and empty
    tables need no care here, and columns of any name may be there.
    """
    times = plan.groupBy(F.col("doc_id").alias("known")).agg(F.max("copies").cast("int").alias("copies"))
    # A row is carried as one value, so that its columns cannot clash with the plan's.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("bigint").alias("id"))
    joined = rows.join(times.where("copies > 0"), F.col("id").eqNullSafe(F.col("known")))
    return joined.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*")
