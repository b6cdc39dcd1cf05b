"""Counts, levels and rollups kept up to date from changes of the facts: only what a change touches is made again."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..sources.scratch import kept
from . import promote, stats

#: Tiers whose members are counted, and their keys.
TIERS = {"reefs": "reef_id", "towns": "town_id", "islands": "island_id"}


class Model(NamedTuple):
    """Facts, one row a reef and word, and what is counted from them; words without facts aren't in it."""

    facts: DataFrame
    spread: DataFrame  # word_id, reef_count, town_count, island_count, best_sim, specificity, level
    reefs: DataFrame
    towns: DataFrame
    islands: DataFrame


class Change(NamedTuple):
    """Of one table the keys whose rows go, and the rows that take their place."""

    keys: DataFrame
    rows: DataFrame


def _spread(facts: DataFrame) -> DataFrame:
    counts = stats.word_spread(facts).withColumn("specificity", S.specificity(F.col("reef_count")).cast("int"))
    return counts.join(promote.export_level(facts, counts).select("word_id", "level"), "word_id")


def _rollup(facts: DataFrame, words: DataFrame, spread: DataFrame, key: str) -> DataFrame:
    profile = spread.select("word_id", "specificity").join(words.select("word_id", "pos"), "word_id")
    return stats.reef_rollup(facts, profile) if key == "reef_id" else stats.tier_rollup(facts, profile, key)


def build(words: DataFrame, facts: DataFrame) -> Model:
    """The whole model of the facts; what `refresh` gives is equal to it."""
    spread = kept(_spread(facts))
    return Model(facts, spread, *[_rollup(facts, words, spread, key) for key in TIERS.values()])


def merged(table: DataFrame, change: Change) -> DataFrame:
    """The table after a change; rows of other keys are as they were."""
    return table.join(change.keys, change.keys.columns, "left_anti").unionByName(change.rows.select(*table.columns))


def changes(words: DataFrame, old: Model, gone: DataFrame, put: DataFrame | None = None) -> dict[str, Change]:
    """What each table of the model loses and gets if the facts `gone` (reef_id, word_id) go and those of `put` come, or replace their like.

    The changed facts and their words' other facts are all that is looked at: counts and levels of those
    words are made again, then rollups of the groups that a changed fact is in, and of those with a word
    whose specificity isn't what it was.  Keys that the facts don't have change nothing, repeated ones
    count once; a fact that goes and comes stays as it comes.  The four kinds of keys are
    tables, so none has to fit a task; nothing is collected.
    """
    key, tiers = ["reef_id", "word_id"], list(TIERS.values())
    put = old.facts.limit(0) if put is None else kept(put.select(*old.facts.columns).dropDuplicates(key))
    out = kept(gone.select(*key).unionByName(put.select(*key)).distinct())
    facts = Change(out, put)
    lost = old.facts.join(out, key, "left_semi")
    moved = kept(lost.select(*tiers, "word_id").unionByName(put.select(*tiers, "word_id")).distinct())
    touched = kept(moved.select("word_id").distinct())
    now = merged(old.facts, facts)

    spread = Change(touched, kept(_spread(now.join(touched, "word_id", "left_semi"))))
    before = old.spread.join(touched, "word_id", "left_semi").select("word_id", F.col("specificity").alias("was"))
    after = spread.rows.select("word_id", "specificity")
    other = before.join(after, "word_id", "full").where("not (was <=> specificity)").select("word_id")
    near = now.join(other, "word_id", "left_semi").select(*tiers).unionByName(moved.select(*tiers))
    near = kept(near.distinct())
    result = {"facts": facts, "spread": spread}
    profile = merged(old.spread, spread)
    for name, tier in TIERS.items():
        groups = kept(near.select(tier).distinct())
        result[name] = Change(groups, _rollup(now.join(groups, tier, "left_semi"), words, profile, tier))
    return result


def refresh(words: DataFrame, old: Model, gone: DataFrame, put: DataFrame | None = None) -> Model:
    """The model after a change of the facts; see `changes`.  Tables are made anew from the old ones, which may be deleted only when the new ones are written."""
    made = changes(words, old, gone, put)
    return Model(*[merged(getattr(old, name), made[name]) for name in Model._fields])


def word_rows(words: DataFrame, model: Model) -> DataFrame:
    """Every word with its counts, level and idf.  idf depends on the number of all reefs, so it is made when it is read, from the reefs' table."""
    total = model.reefs.agg(F.count(F.lit(1)).alias("reefs"))
    rows = words.select("word_id").join(model.spread, "word_id", "left").crossJoin(F.broadcast(total))  # one row
    n = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return rows.select("word_id", n("reef_count"), n("town_count"), n("island_count"), "specificity", "level", S.floored_idf(F.col("reefs"), F.coalesce("reef_count", F.lit(0))).alias("idf"))
