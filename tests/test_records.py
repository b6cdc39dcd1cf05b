"""The assembled exports, their checks, and the readers and sinks of round files."""

import hashlib
import io
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierlex.operators import export, records
from tierlex.plans import records as plans
from tierlex.sources import files, packed, sinks
from tierlex.sources.proxy import Tables

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")


@needs_data
def test_export_has_eleven_files(spark, tmp_path):
    t, out = Tables(spark, DATA), f"{tmp_path}/v3"
    manifest = plans.write_export(t, out)
    assert sorted(os.listdir(out)) == sorted([*(f"{x}.bin" for x in sinks.FILES), "index.json", "manifest.json", *(f for f in os.listdir(out) if f.endswith(".crc"))])
    limits = {"n_islands": sinks.U16, "n_archs": sinks.U16, "n_reefs": sinks.U16}
    assert packed.verify(spark, out, sinks.FILES, sinks.REQUIRED, limits).count() == 0
    read = lambda name: sinks.unpack(sinks.Folder(spark, out).read(f"{name}.bin"))
    words = {r.word_id: r for r in t.words.collect()}
    assert len(read("word_islands")) == max(words) + 1 and manifest["stats"]["n_words"] == manifest["stats"]["n_lookup_entries"] == len(words)
    index = {(r.word_id, r.island_id): r.weight for r in plans.export.word_islands(plans.index_of(t), t.islands).collect()}
    numbers = {r.island_id: r.island_no for r in plans.ids_of(t)[1].collect()}
    assert {(w, i): x for w, e in enumerate(read("word_islands")) for i, x in e} == {(w, numbers[i]): x for (w, i), x in index.items()}
    constants, record = read("constants"), plans.constants_of(t).first().asDict()
    assert constants["N_ISLANDS"] == len(read("island_meta")) and constants["FNV1A_OFFSET"] == 14695981039346656037
    assert {k: v for k, v in constants.items() if not k.startswith("FNV")} == {k: v for k, v in record.items() if not k.startswith("FNV")}
    background = read("background")
    assert len(background["bg_std"]) == constants["N_ISLANDS"] and len(background["town_bg_mean"]) == constants["N_TOWNS"]
    lookup = read("word_lookup")
    assert len(lookup) == len(words) and list(lookup) == sorted(lookup)
    assert read("compounds") == sorted(([r.word, r.word_id] for r in plans.export_compounds(t).collect()), key=lambda x: x[1])
    problems = lambda **k: {tuple(r) for r in packed.verify(spark, out, **k).collect()}
    sinks.Folder(spark, out).write("compounds.bin", b"\x91")
    sinks.Folder(spark, out).write("island_meta.bin", sinks.pack([{"name": "x"}, {"name": "y", "iqf": 1}]))
    wrong = {("compounds", "checksum"), ("compounds", "can't be read"), ("island_meta", "checksum")}
    assert problems() == wrong
    assert problems(required={"island_meta": ("name", "iqf", "n_words")}) == wrong | {("island_meta", "no iqf"), ("island_meta", "no n_words")}
    os.remove(f"{out}/town_meta.bin")
    assert problems(limits={"n_words": 1}) == wrong | {("town_meta", "missing"), ("n_words", f"{len(words)} of 1 to 1")}
    assert [tuple(r) for r in packed.verify(spark, f"{tmp_path}/none").collect()] == [("manifest", "missing")]


@needs_data
def test_older_export_has_ten_files(spark, tmp_path):
    t, out = Tables(spark, DATA), f"{tmp_path}/v2"
    plans.write_legacy_export(t, out)
    assert packed.verify(spark, out, sinks.LEGACY_FILES, sinks.LEGACY_REQUIRED, {"n_reefs": sinks.U16, "n_archs": sinks.U16}).count() == 0
    read = lambda name: sinks.unpack(sinks.Folder(spark, out).read(f"{name}.bin"))
    constants, reefs = read("constants"), read("word_reefs")
    empty = [i for i, e in enumerate(reefs) if not e]
    assert constants["domainless_word_ids"] == empty
    assert all(e == read_ for e, read_ in zip([sorted(x) for x in reefs[:50]], reefs[:50], strict=True))
    assert sum(constants["reef_n_words"]) == sum(map(len, reefs)) and constants["avg_reef_words"] == pytest.approx(sum(constants["reef_n_words"]) / len(read("reef_meta")))
    assert list(constants) == sorted(constants)


@pytest.mark.parametrize("tasks", [1, 5])
def test_packed_files_round_trip(spark, tmp_path, tasks, monkeypatch):
    """Values of every size through parts, one file, and rows; read by parts and from the start alike."""
    monkeypatch.setattr(packed, "BLOCK", 7)
    out = f"{tmp_path}/x"
    rows = [(k, [k, -k * 1000, 1 << k], "é" * k if k else None, k / 7, k % 2 == 0) for k in range(60)]
    df = spark.createDataFrame(rows, "k long, a array<long>, s string, d double, b boolean").repartition(tasks)
    big = spark.createDataFrame([(str(1 << 63), "x" * 70_000), ("18446744073709551615", "")], "h string, s string").selectExpr("cast(h as decimal(20, 0)) h", "s")
    files = {
        "list": packed.spread(df, packed.LIST, "k"), "map": packed.spread(df, packed.MAP, "k"), "records": packed.spread(df, packed.RECORDS, "k"), "one": packed.spread(df.select("k", "s"), packed.LIST, "k"),
        "big": packed.spread(big, packed.MAP, "h"), "none": packed.spread(df.limit(0), packed.LIST, "k"), "tree": {"z": packed.spread(df.select("k", "d"), packed.LIST, "k"), "a": 5, "m": packed.spread(df.select("s", "k").where("k > 0"), packed.MAP, "s")}, "plain": [1, [None, True]],
    }
    manifest = packed.export(spark, files, out, stats={"entries": "list"})
    assert manifest["stats"] == {"entries": 60} and packed.verify(spark, out).count() == 0
    raw = lambda name: sinks.unpack((tmp_path / "x" / f"{name}.bin").read_bytes())
    assert raw("list") == [list(r[1:]) for r in rows] and raw("one") == [r[2] for r in rows] and raw("none") == []
    assert raw("map") == {r[0]: list(r[1:]) for r in rows} and raw("records") == [dict(zip("asdb", r[1:], strict=True)) for r in rows]
    assert raw("tree") == {"a": 5, "m": {r[2]: [r[0]] for r in rows[1:]}, "z": [r[3] for r in rows]} and raw("plain") == [1, [None, True]]
    for _ in range(2):
        back = lambda name, kind, schema: sorted(map(tuple, packed.read(spark, f"{out}/{name}.bin", kind, schema).collect()))
        assert back("list", packed.LIST, "k long, a array<long>, s string, d double, b boolean") == rows
        assert back("map", packed.MAP, "k long, a array<long>, s string, d double, b boolean") == rows
        assert back("records", packed.RECORDS, "place long, d double, missing string, s string") == [(r[0], r[3], None, r[2]) for r in rows]
        assert back("one", packed.LIST, "k long, s string") == [(r[0], r[2]) for r in rows]
        assert back("big", packed.MAP, "h decimal(20,0), s string") == sorted((r.h, r.s) for r in big.collect())
        assert back("tree", packed.OBJECT, "a long, z array<double>") == [(5, [r[3] for r in rows])]
        assert back("none", packed.LIST, "k long, s string") == []
        assert [tuple(r) for r in packed.read(spark, f"{out}/tree.bin", packed.KEYS).collect()] == [(0, ["a", "m", "z"])]
        os.remove(f"{out}/index.json") if os.path.exists(f"{out}/index.json") else None  # the second time every file is read from its start
    packed.patch(spark, out, "tree", {"b": packed.spread(df.select("k", "b"), packed.LIST, "k"), "a": 6})
    assert raw("tree") == {"a": 6, "b": [r[4] for r in rows], "m": {r[2]: [r[0]] for r in rows[1:]}, "z": [r[3] for r in rows]}
    assert packed.verify(spark, out).count() == 0


def test_meta_of_empty_groups(spark):
    ids = spark.createDataFrame([(7, 0, 0, None), (9, 1, 0, "b")], "island_id int, island_no int, arch int, island string")
    roll = spark.createDataFrame([(9, 3, 1.23456, 0.5, 0.25, 0.25, 0.0)], "island_id int, word_count long, avg_specificity double, noun_frac double, verb_frac double, adj_frac double, adv_frac double")
    rows = sorted(map(tuple, records.meta(ids, roll, "island_id", "island_no", "arch", F.col("island"), "iqf", True).collect()))
    assert rows == [(0, 0, "", 0, 128, 0.0, 0.0, 0.0, 0.0, 0.0), (1, 0, "b", 3, 128, 1.2346, 0.5, 0.25, 0.25, 0.0)]


def test_snowball_variants_keep_the_first(spark):
    words = spark.createDataFrame([(1, "runs"), (2, "run"), (3, "two words"), (4, "runsx")], "word_id long, word string")
    variants = spark.createDataFrame([("run", 2, "base"), ("walks", 2, "morphy"), ("runs", 1, "base")], "variant string, word_id long, source string")
    stem = lambda c: F.regexp_replace(c, "sx?$", "")
    got = sorted(map(tuple, records.snowball_variants(words, variants, stem, lambda c: c).collect()))
    assert got == [("walk", 2, "snowball")]
    lookup = records.word_lookup(spark.createDataFrame([(1, "a", 2, 1.0), (2, "b", None, 20.0)], "word_id long, word_hash string, specificity int, idf double"), spark.createDataFrame([("a", 2, "morphy"), ("x", 2, "snowball"), ("x", 1, "snowball"), ("y", 1, "snowball"), ("y", 2, "morphy")], "hash string, word_id long, source string"))
    assert sorted(map(tuple, lookup.collect())) == [("a", "a", 1, 2, 21), ("b", "b", 2, 0, 255), ("x", "a", 1, 2, 21), ("y", "b", 2, 0, 255)]


def test_replaced_partitions(spark, tmp_path):
    rows = lambda *x: spark.createDataFrame(x, "town int, word string")
    sinks.replace_partitions(rows((1, "a"), (2, "b")), f"{tmp_path}/t", "town")
    for _ in range(2):
        sinks.replace_partitions(rows((2, "c"), (3, "d")), f"{tmp_path}/t", "town")
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/t").select("town", "word").collect()) == [(1, "a"), (2, "c"), (3, "d")]


def test_xml_tree(spark, tmp_path):
    rows = spark.createDataFrame([("B", "y"), ("A", None), ("B", "x & z")], "island string, town string")
    sinks.write_tree_xml(spark, rows, str(tmp_path), "tree.xml", "island", "town")
    text = (tmp_path / "tree.xml").read_text()
    assert text.index('name="A"') < text.index('name="B"') < text.index("x &amp; z") < text.index('name="y"')


def test_checkpoints(spark, tmp_path):
    for k, n in ((0, 2), (1, 3)):
        raw = io.BytesIO()
        np.save(raw, np.arange(n * 4, dtype=np.float32).reshape(n, 4) + 100 * k)
        (tmp_path / f"batch_{k:05d}.npy").write_bytes(raw.getvalue())
    rows = files.npy_batches(spark, str(tmp_path))
    assert [(r.file, r.row, r.v[0]) for r in rows.orderBy("file", "row").collect()] == [("batch_00000.npy", 0, 0.0), ("batch_00000.npy", 1, 4.0), ("batch_00001.npy", 0, 100.0), ("batch_00001.npy", 1, 104.0), ("batch_00001.npy", 2, 108.0)]
    assert tuple(files.resume_index(rows).first()) == (2, 5, 2)
    assert tuple(files.resume_index(rows.limit(0)).first()) == (0, 0, 0)


def test_lemmas_and_lists(spark):
    senses = [("Look_up", "v"), ("look_up", "n"), ("look_up", "v"), ("dog", "n"), ("dog", "v"), ("well", "s"), ("well", "r"), ("well", "a"), ("odd", "x")]
    got = sorted(map(tuple, files.lemma_words(spark.createDataFrame(senses, "lemma string, pos string")).collect()))
    assert got == [("dog", "noun", 2, "single"), ("look up", "verb", 3, "phrasal_verb"), ("well", "adj", 3, "single")]
    words = spark.createDataFrame([(w,) for w in ("a", "b", "i", "x2", "ok", "ok", "")], "word string")
    assert sorted(r.word for r in files.listed_words(words).collect()) == ["", "a", "i", "ok"]


def test_wiki_files(spark, tmp_path):
    pages = [{"category": "Art", "query": {"categorymembers": [{"title": "Category:Branches of art"}, {"title": "Category:Art by year"}]}}, {"category": "Art", "query": {"categorymembers": [{"title": "Category:Painting"}]}}]
    (tmp_path / "replies.json").write_text("\n".join(map(json.dumps, pages)))
    members = files.category_members(spark, f"{tmp_path}/replies.json")
    assert {(r.title, r.drill) for r in files.topical(members, "title").collect()} == {("Branches of art", True), ("Painting", False)}
    text = """## Summary

| Metric | Count |
|--------|-------|
| Domains queried | 4 |
| Wikipedia match found | 2 |
| No match found | 1 |
| Skipped (non-topical) | 1 |
| Total subcategories found | 4 |

## Domains With No Wikipedia Category Match (1)

- **alchemy** (tried: `Alchemy`)

## Skipped Domains \u2014 Non-Topical (1)

- euphemism

## Domain \u2192 Wikipedia Subcategories

### art
**Wikipedia:** `Category:Arts` \u2014 5 raw \u2192 2 filtered subcategories

- **Branches**
  - Music
  - Dance
- Crafts

"""
    art = [("Branches", ["Music", "Dance"]), ("Crafts", [])]
    rows = [("art", "Arts", "found", 5, art), ("zen", "Zen", "found", 0, []), ("alchemy", "Alchemy", "not_found", 0, None), ("euphemism", "E", "skipped", 0, None)]
    found = spark.createDataFrame(rows, "domain string, wiki_category string, status string, raw_count long, subcats array<struct<name: string, children: array<string>>>")
    lines = files.wiki_report(found.repartition(3))
    assert "".join(r.line + "\n" for r in lines.orderBy("place").collect()) == text
    files.write_report(lines, f"{tmp_path}/report")
    more = "# x\n- **no**\n## Domains With No Wikipedia Category Match (3)\n- **chess**\n- plain\n### No Wikipedia page\n- **polo** (tried: `Polo sports`)\n## Rest\n- **yes**\n"
    (tmp_path / "report" / "more.txt").write_text(more)
    assert {tuple(r) for r in files.failed_domains(spark, f"{tmp_path}/report/*.txt").collect()} == {("alchemy", "Alchemy"), ("chess", "chess"), ("polo", "Polo sports")}
    empty = files.wiki_report(found.limit(0)).orderBy("place").collect()
    assert empty[4].line == "| Domains queried | 0 |" and len(empty) == 12


def test_classifier_results(spark, tmp_path):
    m = {"precision": 1.0, "recall": 0.5, "f1": 0.66, "auc_pr": 0.9}
    body = {"domain": "a", "metrics": m, "fold_metrics": [m], "n_positive": 5, "n_negative": 25, "n_folds": 1, "top_features": [{"dim_id": 3, "importance": 0.5, "reef_name": "r"}]}
    (tmp_path / "a.json").write_text(json.dumps(body, indent=1))
    assert tuple(files.summary_json(spark, str(tmp_path)).first()) == ("a", 1.0, 0.5, 0.66, 0.9, 5, 25, 1)
    assert tuple(files.features_json(spark, str(tmp_path)).first()) == ("a", 0, 3, 0.5, "r")


def test_towns_background_without_repeated_rows(spark):
    """An island's words count for each of its towns: nothing changes if they aren't repeated, even where a word is in a town by itself too."""
    index = [(w, 1, 10 + w % 3, w % 250) for w in range(300)] + [(w, 2, 20 + w % 2, 100) for w in range(50)] + [(w, i, None, 3 * w % 256) for w in range(40, 90) for i in (1, 2, 3)]
    rows = spark.createDataFrame(index, "word_id long, island_id long, town_id long, weight int")
    towns = spark.createDataFrame([(10, 1), (11, 1), (12, 1), (20, 2), (21, 2), (22, 2)], "town_id long, island_id long")
    islands = spark.createDataFrame([(1, 0), (2, 0), (3, 0)], "island_id long, is_bucket int")
    whole, at = {}, {}
    for t, i in ((r.town_id, r.island_id) for r in towns.collect()):
        at.setdefault(i, []).append(t)
    for w, i, t, x in index:
        for town in [t] if t else at.get(i, []):
            whole[w, town] = max(whole.get((w, town), 0), x)
    expanded = spark.createDataFrame([(w, t, x) for (w, t), x in whole.items()], "word_id long, grp long, weight int")
    direct, fan = plans.export.town_parts(rows, towns, islands)
    assert not {(r.word_id, t) for r in fan.collect() for t in at.get(r.island_id, [])} & {(r.word_id, r.town_id) for r in direct.collect()}
    assert fan.where("island_id = 2 and word_id < 50").count() == 0 and fan.where("island_id = 2").count() == 40
    assert {(r.word_id, r.town_id): r.weight for r in plans.export.word_towns(rows, towns, islands).collect()} == whole
    groups = plans.export.Groups(direct.withColumnRenamed("town_id", "grp"), fan.withColumnRenamed("island_id", "upper"), towns.select(F.col("island_id").alias("upper"), F.col("town_id").alias("grp")))
    words = spark.range(300).select(F.col("id").alias("word_id"), F.when(F.col("id") % 4 == 0, 2).otherwise(1).alias("word_count"), F.when(F.col("id") % 5 > 0, F.col("id") % 4).alias("specificity"))
    for of in (lambda g: plans.export.background(g, words, 50, 6), lambda g: plans.export.profile(g, words), lambda g: plans.export.single_words(g, words)):
        a, b = ({r[0]: tuple(r)[1:] for r in of(g).collect()} for g in (groups, plans.export.Groups(expanded)))
        assert a.keys() == b.keys() and all(x == pytest.approx(b[k]) for k, x in a.items())
    # by hand: draws pick entries in the order of the words' ranges, words and groups
    single = sorted({(w % 256, w, t) for w, t in whole if w % 4})
    want = {}
    for s in range(50):
        drawn = []
        for j in range(64):
            w = single[int(int(hashlib.md5(f"{s}:{j}".encode()).hexdigest()[:8], 16) / 2**32 * len(single))][1]
            drawn += [w] if w not in drawn else []
        for w in drawn[:6]:
            for t in at[1] + at[2]:
                want[t] = want.get(t, 0) + whole.get((w, t), 0) / 255 / 50
    assert {r.grp: r["mean"] for r in plans.export.background(groups, words, 50, 6).collect()} == pytest.approx(want)


@needs_data
def test_queries_write_only_the_files_that_they_read(spark):
    t = Tables(spark, DATA)
    folder = plans.exported(t, plans.write_export, "island_meta")
    assert plans.exported(t, plans.write_export, "island_meta") == folder
    assert [f for f in os.listdir(folder) if f.endswith(".bin")] == ["island_meta.bin"]
    assert plans.exported_islands(t).count() == plans.ids_of(t)[1].count()


def test_checks_decode_part_by_part(spark, tmp_path):
    """A file of several parts is decoded by as many tasks, and damage inside one is found."""
    out, df = f"{tmp_path}/x", spark.range(4000).selectExpr("id", "array(id, id * 1000) as a")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        packed.export(spark, {"list": packed.spread(df, packed.LIST, "id"), "map": packed.spread(df, packed.MAP, "id"), "plain": [1, 2]}, out)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    parts = packed._stretches(spark, out, ["list"])
    assert len(parts) > 2
    found = packed.scanned(spark, out)
    assert {r.file: r.entries for r in found.collect()} == {"list": 4000, "map": 4000, "plain": 2} and packed.verify(spark, out, files=found).count() == 0
    raw = bytearray((tmp_path / "x/list.bin").read_bytes())
    raw[parts[2][1]] = 0xC1  # no value begins so
    (tmp_path / "x/list.bin").write_bytes(raw)
    for crc in (tmp_path / "x").glob(".*.crc"):
        crc.unlink()
    assert {tuple(r) for r in packed.verify(spark, out).collect()} == {("list", "can't be read"), ("list", "checksum")}


@needs_data
def test_towns_of_words_are_unfolded_as_they_are_written(spark, tmp_path):
    """word_towns is shuffled as islands and own towns, its parts are compressed, and the file has every entry."""
    t = Tables(spark, DATA)
    words, towns = t.words.agg(F.max("word_id")).first()[0], plans.ids_of(t)[2]
    folded = plans.word_entries(t)["word_towns"]
    want = {(r.word_id, r.town_no): r.weight for r in export.word_towns(plans.index_of(t), t.towns, t.islands).join(towns, "town_id").collect()}
    some = spark.createDataFrame([(1, n % 2, n) for n in range(6)], "island long, island_id long, town_no int").select("island_id", "town_no")
    groups = export.Groups(spark.createDataFrame([(5, 70, 9)], "word_id long, grp long, weight int"), spark.createDataFrame([(5, 1, 8), (6, 0, 7)], "word_id long, upper long, weight int"))
    small = export.folded_towns(groups, spark.createDataFrame([(70, 4)], "town_id long, town_no int"))
    assert sorted((r.word_id, len(r.entries), len(r.fans)) for r in small.collect()) == [(5, 1, 1), (6, 0, 1)]
    assert {r.word_id: [tuple(e) for e in r.entries] for r in export.unfolded(small, some).collect()} == {5: [(1, 8), (3, 8), (4, 9), (5, 8)], 6: [(0, 7), (2, 7), (4, 7)]}
    parts = packed.spread(packed.filled(folded, words), packed.LIST, "word_id", lambda rows: export.unfolded(rows, towns))
    packed.export(spark, {"word_towns": parts}, f"{tmp_path}/x")
    found = sinks.unpack(sinks.Folder(spark, f"{tmp_path}/x").read("word_towns.bin"))
    assert len(found) == words + 1 and all(e == sorted(e) for e in found)
    assert {(w, no): x for w, e in enumerate(found) for no, x in e} == want
    first = next(f for f in sorted(os.listdir(parts.folder)) if f.startswith("part-"))
    with open(f"{parts.folder}/{first}", "rb") as f:
        assert f.read(4) == b"\x28\xb5\x2f\xfd"  # zstd
