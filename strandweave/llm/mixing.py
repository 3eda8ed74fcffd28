"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic. Each cell's expected tokens are raked in turn to the
targets of the three marginals, ``rounds`` times, under the bound that no cell can give more tokens than it has:
a cell that is full stays full while its marginal is short, and the others share what is missing. A document is
kept with the probability of its cell, its expected tokens over its tokens. The draw is a fixed hash of the id,
so a run repeats itself and tasks may be retried. ``residual`` reports what is left: the largest difference of a
marginal's expected share from its target.

Targets are shares by value. Where they are given, ``budget`` (the share of all tokens to keep) is lowered to
what the scarcest value allows. Where not, a marginal's targets are its observed shares to the power ``temper``,
which damps what is large, but no value is asked for more than (3 + budget) / 4 of what it has.

A topic is the seed word (as it is spelt) that a text holds most often (the first in order on ties), or ``other``. Seed words are
taken from the corpus: the ``topics`` words of at least ``SEED_LENGTH`` characters that stand in the most
documents but in at most ``SEED_SHARE`` of them.

Only the cells' sums and word counts are shuffled (map-side combined), never texts; a hot source is one row.

Null source, language or text count as ''. A null id draws as ''. Repeated rows share one draw. Values that a
given target lacks get weight 0. Empty tables give empty results. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from strandweave.llm.common import SPACE, let, whole_text, words
from strandweave.plans.cut import cut, release

MARGINALS = ("source", "lang", "topic")
SEED_LENGTH, SEED_SHARE = 5, 0.05
FULL = 1 - 1e-12


def seed_words(texts: DataFrame, topics: int) -> list[str]:
    """At most ``topics`` words of (text): a list whose length is a parameter."""
    long = F.filter(F.split("text", SPACE), lambda w: F.length(w) >= SEED_LENGTH)
    seen = texts.select(F.explode(F.array_distinct(long)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return [r["word"] for r in seen.where(F.col("n") <= SEED_SHARE * texts.count()).orderBy(F.desc("n"), "word").limit(topics).collect()]


def _celled(rows: DataFrame, seeds: list[str]) -> DataFrame:
    """``rows`` (text, source, lang and others) with topic and tokens."""
    found = words(F.col("text"))

    def topic(hits: Column) -> Column:
        counts = F.array(*[F.struct((F.size(F.array_remove(hits, s)) - F.size(hits)).alias("n"), F.lit(s).alias("word")) for s in seeds])
        return F.when(F.size(hits) == 0, "other").otherwise(F.array_min(counts)["word"])

    told = (lambda w: let(F.filter(w, lambda x: x.isin(seeds)), topic)) if seeds else (lambda w: F.lit("other"))
    both = let(found, lambda w: F.struct(F.size(w).cast("long").alias("tokens"), told(w).alias("topic")))
    return rows.withColumn("said", both).select(*[c for c in rows.columns if c != "text"], "said.topic", "said.tokens")


def feasible_budget(cells: DataFrame, given: dict[str, dict[str, float] | None], budget: float) -> float:
    """The budget, or what the scarcest value of the given targets allows."""
    total = cells.agg(F.sum("tokens")).first()[0]
    for marginal, target in given.items():
        if target is not None and total:
            wanted = _shares(target, marginal)
            seen = cells.groupBy(marginal).agg(F.sum("tokens").alias("t")).where("t > 0").withColumn("share", wanted)
            whole = seen.agg(F.sum("share")).first()[0]
            least = seen.where("share > 0").agg(F.min(F.col("t") / F.col("share"))).first()[0]
            budget = min(budget, (least or 0.0) * (whole or 0.0) / total)
    return budget


def _shares(target: dict[str, float], marginal: str) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in target.items() for x in kv]), F.col(marginal)), F.lit(0.0)).cast("double")


def _targets(cells: DataFrame, marginal: str, given: dict[str, float] | None, temper: float, budget: float, fills: int = 8) -> DataFrame:
    """(value, target): expected tokens, ``budget`` of all in sum, over the values that occur."""
    seen = cells.groupBy(marginal).agg(F.sum("tokens").cast("double").alias("t")).where("t > 0")
    raw = cut(seen.select(marginal, "t", (F.pow("t", F.lit(temper)) if given is None else _shares(given, marginal)).alias("raw")), "raw")
    first = raw.agg(F.sum("t").alias("t"), F.sum("raw").alias("raw")).first()
    want = budget * (first["t"] or 0.0)
    rate = want / first["raw"] if first["raw"] else 0.0
    most = F.col("t") * ((3 + budget) / 4)
    if given is not None:
        return raw.select(marginal, (F.col("raw") * rate).alias("target"))
    for _ in range(fills):
        over = F.col("raw") * rate >= most
        row = raw.agg(F.sum(F.when(over, most).otherwise(0.0)).alias("held"), F.sum(F.when(over, 0.0).otherwise(F.col("raw"))).alias("rest")).first()
        following = (want - row["held"]) / row["rest"] if row["rest"] else rate
        if following <= rate:
            break
        rate = following
    return raw.select(marginal, F.least(F.col("raw") * rate, most).alias("target"))


def _scaled(cells: DataFrame, marginal: str) -> DataFrame:
    """One marginal raked: down by one factor; up by a factor for the cells that are not full yet."""
    target = F.max(f"{marginal}_target").alias("target")  # one a value
    sums = cells.groupBy(marginal).agg(F.sum("weight").alias("sum"), F.sum(F.when(F.col("weight") >= F.col("tokens") * FULL, F.col("weight")).otherwise(0.0)).alias("full"), target)
    scale = sums.select(marginal, F.expr("CASE WHEN sum > 0 AND target <= sum THEN target / sum END").alias("down"), F.expr("CASE WHEN target > sum AND sum > full THEN (target - full) / (sum - full) END").alias("up"))
    raised = F.when(F.col("weight") < F.col("tokens") * FULL, F.least(F.col("tokens").cast("double"), F.col("weight") * F.col("up"))).otherwise(F.col("weight"))
    weight = F.when(F.col("down").isNotNull(), F.col("weight") * F.col("down")).when(F.col("up").isNotNull(), raised).otherwise(F.col("weight"))
    return cells.join(scale, marginal, "left").withColumn("weight", weight).drop("down", "up")


def rake(cells: DataFrame, targets: dict[str, DataFrame], budget: float, rounds: int = 16) -> DataFrame:
    """``cells`` (marginals, tokens) with ``weight``: expected tokens, at most the tokens there are.

    A cell carries its values' targets, and the state is written after every marginal: a step names the state twice
    (sums and cells), so steps in one plan would double it each time, and the driver keeps the plans."""
    aimed = cells
    for marginal, target in targets.items():
        aimed = aimed.join(target.select(marginal, F.col("target").alias(f"{marginal}_target")), marginal, "left")
    state = cut(aimed.withColumn("weight", F.col("tokens") * F.lit(float(budget))), "cells")
    for marginal in list(targets) * rounds:
        following = cut(_scaled(state, marginal), "cells")
        release(state)
        state = following
    return state.drop(*[f"{m}_target" for m in targets])


def residual(raked: DataFrame, targets: dict[str, DataFrame]) -> float:
    """The largest difference of a marginal's share of the mix from its target."""
    total, worst = raked.agg(F.sum("weight")).first()[0], 0.0
    for marginal, target in targets.items():
        away = raked.groupBy(marginal).agg(F.sum("weight").alias("sum")).join(target, marginal).agg(F.max(F.abs(F.col("sum") - F.col("target")))).first()[0]
        worst = max(worst, (away or 0.0) / total if total else 0.0)
    return worst


def draw(id_col: str, seed: int) -> Column:
    """A number in [0, 1) that the id fixes."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def mix(
    docs: DataFrame,
    budget: float = 0.8,
    temper: float = 0.85,
    rounds: int = 16,
    topics: int = 12,
    seed: int = 3,
    source_target: dict[str, float] | None = None,
    lang_target: dict[str, float] | None = None,
    topic_target: dict[str, float] | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """row (struct of the columns of ``docs``), source, lang, topic, tokens, probability, residual and kept."""
    named = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        docs[f"`{id_col}`"].alias("id"),
        whole_text(f"`{text_col}`").alias("text"),
        F.coalesce(docs[f"`{source_col}`"], F.lit("")).alias("source"),
        F.coalesce(docs[f"`{lang_col}`"], F.lit("")).alias("lang"),
    )
    seeds = seed_words(named.select("text"), topics)
    rows = _celled(named, seeds)
    cells = cut(rows.groupBy(*MARGINALS).agg(F.sum("tokens").alias("tokens")), "cells")
    given = dict(zip(MARGINALS, (source_target, lang_target, topic_target), strict=True))
    budget = feasible_budget(cells, given, budget)
    targets = {m: cut(_targets(cells, m, given[m], temper, budget), "target") for m in MARGINALS}
    raked = rake(cells, targets, budget, rounds)
    share = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(F.lit(0.0))
    judged = cut(raked.select(*MARGINALS, share.alias("probability")), "probabilities")
    left = residual(raked, targets)
    release(cells, raked, *targets.values())
    joined = rows.join(judged, list(MARGINALS), "left")
    return joined.select("row", *MARGINALS, "tokens", "probability", F.lit(left).alias("residual"), (draw("id", seed) < F.coalesce("probability", F.lit(0.0))).alias("kept"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the draw keeps, with their own columns."""
    return mix(docs, **options).where("kept").select("row.*")
