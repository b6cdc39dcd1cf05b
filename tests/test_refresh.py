"""Refreshed models equal ones that are built anew, and leave alone what a change doesn't touch."""

import random

import pytest

from tierlex.operators import refresh

FACTS = "reef_id string, town_id long, island_id long, word_id long, cosine_sim double, is_core int, source string"


def facts_of(spark, seed, n):
    rng = random.Random(seed)
    found = {}
    for _ in range(n):
        town, word = rng.randrange(12), rng.randrange(40)
        reef = f"{town}/{rng.randrange(3)}"
        found[reef, word] = (reef, town, town % 4, word, rng.randrange(100) / 100, rng.randrange(2), "xgboost")
    return spark.createDataFrame(sorted(found.values()), FACTS)


@pytest.fixture(scope="module")
def words(spark):
    return spark.createDataFrame([(i, f"w{i}", ("noun", "verb", "adj", None)[i % 4]) for i in range(45)], "word_id long, word string, pos string")


def rows(table):
    cols = sorted(table.columns)
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in table.select(*cols).collect())


def same(words, got, wanted):
    for name in refresh.Model._fields:
        assert rows(getattr(got, name)) == rows(getattr(wanted, name)), name
    assert sorted(map(str, refresh.word_rows(words, got).collect())) == sorted(map(str, refresh.word_rows(words, wanted).collect()))


def test_random_changes(spark, words):
    """Facts go, come and are replaced; some that go aren't there, one goes twice, a reef loses all, a new one comes."""
    facts = facts_of(spark, 1, 220).cache()
    put = facts_of(spark, 2, 12).unionByName(spark.createDataFrame([("99/0", 99, 3, 44, 0.5, 1, "curated")], FACTS))
    whole = facts.where("reef_id = '3/1'").select("reef_id", "word_id")
    gone = facts.where("word_id % 9 = 1").select("reef_id", "word_id").unionByName(whole).unionByName(whole).unionByName(spark.createDataFrame([("none", 1), (None, None)], "reef_id string, word_id long"))
    got = refresh.refresh(words, refresh.build(words, facts), gone, put)
    left = facts.join(gone, ["reef_id", "word_id"], "left_anti").join(put, ["reef_id", "word_id"], "left_anti").unionByName(put)
    same(words, got, refresh.build(words, left))


def test_only_what_is_touched(spark, words):
    """One fact of one word: its own groups, and groups of that word if its specificity changes, and no others."""
    facts = spark.createDataFrame([("1/a", 1, 1, 1, 0.5, 1, "x"), ("1/b", 1, 1, 1, 0.5, 1, "x"), ("2/a", 2, 2, 1, 0.5, 1, "x"), ("2/a", 2, 2, 2, 0.5, 1, "x"), ("3/a", 3, 3, 3, 0.5, 1, "x")], FACTS)
    old = refresh.build(words, facts)
    gone = spark.createDataFrame([("1/b", 1)], "reef_id string, word_id long")
    made = refresh.changes(words, old, gone)  # three reefs to two: the specificity stays
    assert [[r[0] for r in made[n].keys.collect()] for n in ("spread", "reefs", "towns", "islands")] == [[1], ["1/b"], [1], [1]]
    assert made["reefs"].rows.count() == 0
    both = gone.unionByName(spark.createDataFrame([("1/a", 1)], "reef_id string, word_id long"))
    made = refresh.changes(words, old, both)
    assert sorted(r[0] for r in made["reefs"].keys.collect()) == ["1/a", "1/b", "2/a"]


def test_nothing_and_everything(spark, words):
    facts = facts_of(spark, 3, 40)
    old = refresh.build(words, facts)
    same(words, refresh.refresh(words, old, facts.select("reef_id", "word_id").limit(0)), old)
    empty = refresh.refresh(words, old, facts.select("reef_id", "word_id"))
    assert [getattr(empty, n).count() for n in refresh.Model._fields] == [0] * 5
    same(words, refresh.refresh(words, empty, facts.select("reef_id", "word_id").limit(0), facts), old)


def test_refreshed_words_make_no_rollups_that_they_dont_read(spark):
    """Predictions are made once, the facts written once, and of the old model's tiers the reefs alone."""
    from tierlex.plans import membership
    from tierlex.sources.proxy import Tables

    written = []

    class Seen(Tables):
        def kept(self, df):
            written.append(set(df.columns))
            return super().kept(df)

    membership.refreshed(Seen(spark, "/root/testdata/sf0.001"), "reefs")
    assert sum("noun_frac" in c for c in written) == 1 and {"town_id", "word_id", "score"} in written
    assert sum({"cosine_sim", "reef_id"} <= c for c in written) == 1
