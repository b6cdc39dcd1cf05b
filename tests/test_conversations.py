"""Streams of turns: state by conversation, restarts, closing, and the batch query's result."""

import pytest
from pyspark.sql import functions as F

from tierlex.streaming import conversations


@pytest.fixture
def weights(spark):
    return spark.createDataFrame([("sea", "water", 10), ("boat", "water", 20), ("boat", "wood", 20), ("oak", "wood", 5), ("oak", "tree", 7), ("leaf", "tree", 1), ("tin", "metal", 1), ("sea", None, 9)], "token string, grp string, weight int")


def add(spark, folder, rows):
    spark.createDataFrame(rows, conversations.TURNS).coalesce(1).write.mode("append").parquet(folder)


def last(spark, out):
    got = {}
    for r in conversations.latest(spark, out).collect():
        got.setdefault(r.conv_id, []).append((r.turns, r.nth, r.grp, r.score, r.closed))
    return {k: sorted(v, key=lambda r: r[1] or 0) for k, v in got.items()}


def test_state_goes_on_after_a_restart(spark, weights, tmp_path):
    """Turns out of order, a word twice in a turn and in two turns, null and empty texts, ties, words that nothing weighs."""
    folder, out, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "out", "cp"))
    add(spark, folder, [(1, 1, "user", "Boat boat, sea!"), (2, 0, "user", None), (3, 0, "user", "xyz")])
    run = lambda idle: conversations.run(conversations.read_turns(spark, folder, 1), weights, out, checkpoint, idle_ms=idle).awaitTermination(60)
    assert run(10**9)
    assert last(spark, out) == {1: [(1, 1, "water", 30, False), (1, 2, "wood", 20, False)], 2: [(1, None, None, None, False)], 3: [(1, None, None, None, False)]}
    add(spark, folder, [(1, 0, "user", "oak leaf tin boat"), (2, 1, "user", "")])
    add(spark, folder, [(1, 2, "assistant", "oak"), (4, 0, "user", "leaf tin")])
    assert run(10**9)
    got = last(spark, out)
    assert got[1] == [(3, 1, "water", 50, False), (3, 2, "wood", 50, False), (3, 3, "tree", 15, False)]
    assert got[2] == [(2, None, None, None, False)] and got[4] == [(1, 1, "metal", 1, False), (1, 2, "tree", 1, False)]
    batch = spark.read.parquet(folder)
    whole = conversations.turn_hits(batch, weights).where("grp is not null").groupBy("conv_id", "grp").agg(F.sum("weight").alias("score")).collect()
    for conv, rows in got.items():
        best = sorted(((-r.score, r.grp) for r in whole if r.conv_id == conv))[:3]
        assert [(r[2], r[3]) for r in rows if r[2]] == [(g, -s) for s, g in best]


def test_idle_conversations_are_closed(spark, weights, tmp_path):
    folder, out, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "out", "cp"))
    add(spark, folder, [(1, 0, "user", "sea")])
    run = lambda: conversations.run(conversations.read_turns(spark, folder, 1), weights, out, checkpoint, idle_ms=1).awaitTermination(60)
    assert run()
    add(spark, folder, [(2, 0, "user", "oak")])
    assert run()
    assert last(spark, out)[1] == [(1, 1, "water", 10, True)]
    add(spark, folder, [(1, 1, "user", "leaf")])
    assert run()
    assert last(spark, out)[1] == [(1, 1, "tree", 1, False)]  # begun anew


def test_a_word_comes_once_however_many_groups_weigh_it(spark):
    """Rows that reach the state grow with the turns' words, not with words times groups."""
    weights = spark.createDataFrame([("sea", f"g{i:03}", i) for i in range(200)] + [("oak", "g000", 1)], "token string, grp string, weight int")
    turns = spark.createDataFrame([(1, 0, "user", "sea oak sea"), (1, 1, "user", "sea"), (2, 0, "user", None)], conversations.TURNS)
    assert conversations.turn_lists(turns, weights).count() == 6
    sums = conversations.turn_hits(turns, weights).where("conv_id = 1 and grp = 'g199'").agg(F.sum("weight")).first()[0]
    assert sums == 2 * 199
