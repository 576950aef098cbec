"""Mixing to target weights by iterative proportional fitting; DataFrame functions only.

Documents are counted into cells of (source, language, topic). The token mass of the cells is raked: in turn
the mass of every topic, every language and every source is scaled to its target, for ``SWEEPS`` rounds and from there on
until no marginal is off by more than ``TOLERANCE`` of its target; sources come last, so their marginal is exact. Targets that raking
cannot reach, as where no cells can have both, are named in a warning. A cell's mass over its tokens is the weight that its tokens
should have. A document is drawn with probability min(1, c * weight), where c makes the expected tokens of
the sample ``fraction`` of all; ``mix_weight`` carries what a probability capped at 1 leaves over, so
that the sample weighed by it keeps the targets.

Targets: for each marginal either a power, 1 for the natural shares and 0 for equal ones, or a dictionary of weights
by value; values that it does not name keep their natural share of its total.

Rules for odd input: null counts as '' in source and language; null and empty texts have no tokens; a cell without
tokens has probability 0; equal rows share one draw; an empty table gives an empty result; a column of the input named like an
added one is replaced by it.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE_CLASS, as_row, staged

#: Sweeps before the marginals are looked at for the first time.
SWEEPS = 12
#: Sweeps in one query plan; what they give is written before the next ones start.
SWEEPS_A_PLAN = 4
#: The largest error of a marginal, as a share of its target.
TOLERANCE = 1e-6
#: Raking ends without reaching the targets if so many plans have taken less than this share off the largest error.
STALLED_PLANS, STALLED_SHARE = 10, 0.01
#: Marginals that the warning names.
NAMED = 10
#: Cells are broadcast to the documents up to this size; beyond it they are joined by a shuffle.
BROADCAST_BYTES = 64 << 20
MARGINS = ("topic", "lang", "source")
SEED = 20

Target = float | dict[str, float]


def topic_of(text: Column) -> Column:
    """A coarse topic by what a text contains; the first rule that fits."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return (
        F.when(lowered.contains("license") | lowered.contains("all rights reserved"), "legal")
        .when(lowered.contains("http"), "web")
        .when(lowered.contains("@"), "contact")
        .when(F.length(lowered) < 500, "short")
        .otherwise("prose")
    )


def tokens_of(text: Column) -> Column:
    words = SPACE_CLASS.replace("[", "[^", 1) + "+"
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(words)).cast("long")


def _cell_columns(topic: Column) -> tuple[Column, ...]:
    return (
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        topic.alias("topic"),
        tokens_of(F.col("text")).alias("tokens"),
    )


def cells_of(docs: DataFrame, topic: Column | None = None) -> DataFrame:
    """Documents and tokens per source, language and topic."""
    topic = topic_of(F.col("text")) if topic is None else topic
    return (
        docs.select(*_cell_columns(topic))
        .groupBy(*MARGINS)
        .agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("documents"))
    )


def _unscaled_target(margin: str, target: Target) -> Column:
    """What a value of ``margin`` should weigh, up to a factor, from ``{margin}_tokens``."""
    natural = F.col(f"{margin}_tokens").cast("double")
    if not isinstance(target, dict):
        return F.when(natural > 0, F.pow(natural, F.lit(float(target)))).otherwise(0.0)
    named = F.lit(None).cast("double")
    for value, weight in target.items():
        named = F.when(F.col(margin) == value, F.lit(float(weight))).otherwise(named)
    return F.when(natural > 0, F.coalesce(named, F.col(f"{margin}_share"))).otherwise(0.0)


def with_targets(cells: DataFrame, targets: dict[str, Target], total: int) -> DataFrame:
    """The mass that each marginal of a cell should have; the masses of a marginal add up to ``total``."""
    for margin in MARGINS:
        of_value = Window.partitionBy(margin)
        target = targets.get(margin, 1.0)
        cells = cells.withColumn(f"{margin}_tokens", F.sum("tokens").over(of_value))
        if isinstance(target, dict):
            scale = sum(target.values())
            cells = cells.withColumn(f"{margin}_share", F.col(f"{margin}_tokens") / total * scale)
        cells = cells.withColumn(f"{margin}_target", _unscaled_target(margin, target))
    cells = staged(cells, "cells-with-targets")
    # A value's target spread over its cells by their tokens adds up to the target, so this sums each value once.
    spread = lambda m: F.sum(F.try_divide(F.col(f"{m}_target") * F.col("tokens"), F.col(f"{m}_tokens")))
    sums = cells.agg(*(spread(m).alias(m) for m in MARGINS)).first()
    for margin in MARGINS:
        scaled = F.col(f"{margin}_target") * (total / (sums[margin] or 1.0))
        cells = cells.withColumn(f"{margin}_target", scaled)
    return cells.select(
        *MARGINS, "tokens", "documents", *(f"{m}_target" for m in MARGINS), F.col("tokens").cast("double").alias("mass")
    )


def marginals(cells: DataFrame) -> DataFrame:
    """margin, value, mass, target, and error as a share of the target, of every value that has one."""
    sums = None
    for margin in MARGINS:
        one = cells.groupBy(F.lit(margin).alias("margin"), F.col(margin).alias("value")).agg(
            F.sum("mass").alias("mass"), F.max(f"{margin}_target").alias("target")
        )
        sums = one if sums is None else sums.unionByName(one)
    return sums.filter("target > 0").withColumn("error", F.abs(F.col("mass") / F.col("target") - 1))


def rake(cells: DataFrame, sweeps: int = SWEEPS) -> DataFrame:
    """``mass`` scaled to the targets of topic, language and source in turn, until they are reached."""
    errors: list[float] = []
    done = 0
    while True:
        for _ in range(SWEEPS_A_PLAN):
            for margin in MARGINS:
                now = F.sum("mass").over(Window.partitionBy(margin))
                cells = cells.withColumn(
                    "mass", F.coalesce(F.try_divide(F.col("mass") * F.col(f"{margin}_target"), now), F.lit(0.0))
                )
        cells = staged(cells, "raked")
        done += SWEEPS_A_PLAN
        if done < sweeps:
            continue
        errors.append(marginals(cells).agg(F.max("error")).first()[0] or 0.0)
        if errors[-1] <= TOLERANCE:
            return cells
        if len(errors) > STALLED_PLANS and errors[-1] > (1 - STALLED_SHARE) * errors[-1 - STALLED_PLANS]:
            off = marginals(cells).filter(F.col("error") > TOLERANCE).orderBy(F.desc("error"), "margin", "value").limit(NAMED)
            named = "; ".join(f"{r.margin} {r.value!r}: {r.mass:.6g} for {r.target:.6g}" for r in off.collect())
            warnings.warn(f"mixing targets not reached after {done} sweeps, infeasible or nearly so: {named}", stacklevel=2)
            return cells


def _rate(cells: DataFrame, budget: float) -> float:
    """c, so that the tokens times min(1, c * weight) add up to ``budget``; each step caps more cells, until none is capped anew."""
    rate = 0.0
    while True:
        capped = F.col("weight") * rate >= 1
        free, full = cells.agg(
            F.sum(F.when(~capped, F.col("tokens") * F.col("weight"))),
            F.sum(F.when(capped, F.col("tokens"))),
        ).first()
        if not free:
            break
        raised = max(rate, (budget - (full or 0)) / free)
        if raised <= rate * (1 + 1e-12):
            break
        rate = raised
    return rate


def probabilities(
    docs: DataFrame, targets: dict[str, Target], fraction: float, topic: Column | None = None
) -> DataFrame:
    """Per cell: ``probability`` of its documents, and the weight left over."""
    cells = staged(cells_of(docs, topic), "cells")
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    raked = rake(with_targets(cells, targets, max(total, 1)))
    weighed = raked.withColumn("weight", F.coalesce(F.try_divide("mass", "tokens"), F.lit(0.0)))
    rate = _rate(weighed, fraction * total)
    probability = F.least(F.lit(1.0), F.col("weight") * rate)
    return weighed.withColumn("probability", probability).withColumn(
        "left_over", F.coalesce(F.try_divide(F.col("weight") * rate, "probability"), F.lit(0.0))
    )


def sample(
    docs: DataFrame,
    targets: dict[str, Target],
    fraction: float,
    topic: Column | None = None,
    seed: int = SEED,
) -> DataFrame:
    """The drawn rows of ``docs`` with mix_topic, mix_tokens, mix_probability and mix_weight."""
    cells = staged(probabilities(docs, targets, fraction, topic), "probabilities").select(
        *(F.col(m).alias(f"cell_{m}") for m in MARGINS), "probability", "left_over"
    )
    if cells.count() * 100 <= BROADCAST_BYTES:
        cells = F.broadcast(cells)
    topic = topic_of(F.col("text")) if topic is None else topic
    draw = F.xxhash64("doc_id", "text", F.lit(seed)).bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53)
    rows = docs.select(as_row(docs), *_cell_columns(topic), draw.alias("draw"))
    same = [F.col(m) == F.col(f"cell_{m}") for m in MARGINS]
    drawn = rows.join(cells, same).filter(F.col("draw") < F.col("probability"))
    added = {
        "mix_topic": F.col("topic"),
        "mix_tokens": F.col("tokens"),
        "mix_probability": F.col("probability"),
        "mix_weight": F.col("left_over"),
    }
    kept = [name for name in docs.columns if name not in added]
    return drawn.select(
        *(F.col(f"doc.`{name}`") for name in kept), *(c.alias(name) for name, c in added.items())
    )
