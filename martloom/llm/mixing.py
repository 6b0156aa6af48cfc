"""Mixing sources to target weights: iterative proportional fitting, then calibrated sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import Scratch

KEYS = ("k0", "k1", "k2")


def topic_of(text: Column) -> Column:
    """A coarse topic from marks in the text; null and empty texts are prose."""
    return (
        F.when(text.contains(" | "), "table")
        .when(text.contains("icense"), "legal")
        .when(text.contains("@"), "contact")
        .when(text.contains("***") | text.contains("$$$") | text.contains("!!"), "noisy")
        .otherwise("prose")
    )


def n_tokens(text: Column) -> Column:
    """Words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def tempered_targets(cells: DataFrame, key: str, power: float) -> DataFrame:
    """(key, goal): the margin's token totals raised to ``power``, as shares of one."""
    margin = cells.groupBy(key).agg(F.sum("tokens").alias("t"))
    raised = margin.select(key, F.pow(F.col("t").cast("double"), F.lit(power)).alias("r"))
    total = raised.agg(F.sum("r")).first()[0]
    return raised.select(key, (F.col("r") / F.lit(total)).alias("goal"))


def rake(cells: DataFrame, rounds: int) -> DataFrame:
    """Column ``w``: token weights whose margins meet the goals g0, g1, g2 (shares of the total).

    Each step multiplies the weights of a category by goal / current share. ``cells`` has a row
    per combination of categories. Goals of categories without tokens are not there, so the
    goals of the others need not add up to one; they are met in proportion.
    """
    out = cells.withColumn("w", F.col("tokens").cast("double"))
    for _ in range(rounds):
        for i, key in enumerate(KEYS):
            now = F.sum("w").over(Window.partitionBy(key))
            out = out.withColumn("w", F.col("w") * F.col(f"g{i}") / now)
    return out


def rake_bounded(cells: DataFrame, rounds: int, keep_share: float) -> DataFrame:
    """Column ``w`` as of ``rake``, but no weight exceeds its cell's tokens and the goals are tokens to keep.

    Each step multiplies the weights of a category by goal / current total and cuts them to the cell's
    tokens; the next round gives what was cut to the category's other cells.
    """
    out = cells.withColumn("w", F.col("tokens") * F.lit(keep_share))
    for _ in range(rounds):
        for i, key in enumerate(KEYS):
            now = F.sum("w").over(Window.partitionBy(key))
            out = out.withColumn("w", F.least(F.col("tokens").cast("double"), F.col("w") * F.col(f"g{i}") / now))
    return out


def calibrate(cells: DataFrame, keep_share: float, most_steps: int = 100) -> float:
    """Factor c such that sum(tokens * min(1, c * w / tokens)) = keep_share * sum(tokens).

    Cells that reach probability 1 stay there as c grows, so the steps end with the last change;
    each is one aggregate over the cells and only its three sums come to the driver.
    """
    rate = F.col("w") / F.col("tokens")
    total = cells.agg(F.sum("tokens").alias("t"), F.sum("w").alias("w")).first()
    if not total["t"]:
        return 0.0
    budget = keep_share * total["t"]
    c, full = budget / total["w"], 0
    for _ in range(most_steps):
        capped = rate * F.lit(c) >= 1
        s = cells.agg(
            F.sum(F.when(capped, F.col("tokens"))).alias("full"),
            F.sum(F.when(~capped, F.col("w"))).alias("rest"),
        ).first()
        if (s["full"] or 0) == full or not s["rest"]:
            break
        full = s["full"] or 0
        c = (budget - full) / s["rest"]
    return c


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    *,
    topic: Column | None = None,
    power: float = 0.7,
    keep_share: float = 0.8,
    rounds: int = 12,
    seed: str = "mix",
    bounded: bool = False,
) -> DataFrame:
    """``docs`` with topic, n_tokens, probability and kept.

    Token totals per (source, language, topic) cell are raked to the three margins' targets, which
    are the margins' totals raised to ``power`` (1 keeps them, 0 makes them equal). A document's
    probability is its cell's weight per token, scaled so that ``keep_share`` of all tokens is expected
    to stay; none exceeds 1. It stays if a hash of its id, uniform from 0 to 1, is below the
    probability: the same id always falls alike, and repeated ids together. A null source, language or
    topic is a category of its own; a null id counts as the text "null". Documents without tokens
    are in no target and always stay. Existing columns of the four names are replaced.

    Cutting probabilities to 1 after raking moves the margins away from their targets. If ``bounded``, the
    bound is kept while raking: a category that has fewer tokens than its target asks for keeps them
    all, and the others of its margin share the rest in proportion to their targets.
    """
    text = F.col(text_col).cast("string")
    new = ("topic", "n_tokens", "probability", "kept")
    if topic is None:
        topic = topic_of(F.coalesce(text, F.lit("")))
    cast = [F.col(source_col).cast("string"), F.col(lang_col).cast("string"), topic]
    keyed = [c.alias(k) for c, k in zip(cast, KEYS)]
    scratch = Scratch(docs.sparkSession, "mixing")
    # one row per combination of categories from here on
    cells = docs.select(*keyed, n_tokens(text).alias("tokens")).groupBy(*KEYS)
    cells = scratch.write(cells.agg(F.sum("tokens").alias("tokens")).where("tokens > 0"))
    goals = cells
    for i, key in enumerate(KEYS):
        goal = tempered_targets(cells, key, power).select(
            F.col(key).alias("__k"), F.col("goal").alias(f"g{i}")
        )
        if bounded:
            own = cells.groupBy(F.col(key).alias("__c")).agg(F.sum("tokens").alias("tokens"))
            own = goal.join(own, F.col("__k").eqNullSafe(F.col("__c")))
            own = scratch.write(own.withColumnRenamed(f"g{i}", "w"))
            most = F.least(F.col("tokens").cast("double"), F.lit(calibrate(own, keep_share)) * F.col("w"))
            goal = own.select("__k", most.alias(f"g{i}"))
        goals = goals.join(goal, F.col(key).eqNullSafe(F.col("__k"))).drop("__k")
    goals = scratch.write(goals)
    raked = scratch.write(rake_bounded(goals, rounds, keep_share) if bounded else rake(goals, rounds))
    c = calibrate(raked, keep_share)
    rate = F.least(F.lit(1.0), F.lit(c) * F.col("w") / F.col("tokens"))
    chances = raked.select(
        *[F.col(k).alias(f"__{k}") for k in KEYS], F.round(rate, 9).alias("__p")
    )
    rows = docs.select(*[x for x in docs.columns if x not in new])
    match = [a.eqNullSafe(F.col(f"__{k}")) for a, k in zip(cast, KEYS)]
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    draw = F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(1 << 48)
    p = F.coalesce(F.col("__p"), F.lit(1.0))
    return (
        rows.join(chances, match[0] & match[1] & match[2], "left")
        .withColumn("topic", topic)
        .withColumn("n_tokens", n_tokens(text))
        .withColumn("probability", p)
        .withColumn("kept", (draw < p) | (p >= 1))
        .drop("__p", *[f"__{k}" for k in KEYS])
    )
