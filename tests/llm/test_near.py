"""Near and exact copies, repeated strings and lines, against brute force."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tierlex.llm import exact_dedup, jaccard_join, line_dedup, queries, suffix_dedup
from tierlex.llm.shared import components

SCHEMA = "doc_id long, text string, lang string, source string, kept string, group_size int, ID string"


def frame(spark, texts):
    """Documents with ids from 0, in several partitions, with columns whose names clash."""
    rows = [(i, t, "en", "s0", "x", 1, "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    texts = []
    for _ in range(40):
        texts.append("\n".join(" ".join(word() for _ in range(rng.randint(3, 30))) for _ in range(rng.randint(1, 6))))
    shared = " ".join(word() for _ in range(70))
    for k in range(30):
        base = texts[rng.randrange(10)].split(" ")
        for _ in range(rng.randint(0, 2)):
            base[rng.randrange(len(base))] = word()
        texts.append(" ".join(base))
        texts.append(texts[k] + "\n" + shared[rng.randint(0, 20) :] + "\n" + word())
    return texts + texts[:12] + [None, "", "", " \n ", "one", "one", "a b c", "a" * 450, "a" * 450 + "b", "😀é" * 120, "x 😀é" + "😀é" * 119, shared * 40]


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(140)] + [(1000, k) for k in range(1001, 1200)] + [(5, 5)]
    label = {}
    find = lambda x: x if label.setdefault(x, x) == x else find(label[x])
    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            label[max(a, b)] = min(a, b)
    want = {x: find(x) for x in list(label)}
    df = spark.createDataFrame(edges, "a long, b long")
    for few in (0, 10_000):
        assert dict(map(tuple, components(df, few=few).collect())) == want
    assert components(df.limit(0), few=0).count() == 0


def brute_repeats(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(t)) if gone[i] and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def removed(spark, docs, **options):
    """The operator's rows as brute force gives them."""
    out = []
    for r in suffix_dedup.deduplicate(docs, **options).collect():
        lost = sum(s.b - s.a for s in r.spans)
        out.append((r.doc_id, (len(r.kept) + lost, lost, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest())))
    return out


@pytest.mark.parametrize(("length", "gram", "group"), [(200, 40, 20_000), (30, 7, 20_000), (30, 7, 1), (8, 8, 20_000)])
def test_suffix_dedup(spark, length, gram, group):
    texts = corpus()
    assert dict(removed(spark, frame(spark, texts), length=length, gram=gram, group=group)) == dict(enumerate(brute_repeats(texts, length)))


def test_suffix_dedup_of_long_runs_and_long_texts(spark):
    """Runs of few bytes are cut into few contexts; tiles' borders, repeated rows and null ids don't matter."""
    rng = random.Random(17)
    some = "".join(rng.choice("abcdefgh ") for _ in range(1_300_000))
    base = (1 << 20) - 150  # a repeat over the border of two tiles
    rows = [(1, " " * 5000), (2, "ab" * 900 + "x" * 700), (3, some), (4, "q" + some[base : base + 400] + "r"), (5, "abcdefghijklmnopqrst" * 30 + "!"), (None, "tail " + some[-260:]), (6, "z" * 210), (6, "z" * 210), (7, "u" * 199 + "v")]
    got = sorted(removed(spark, spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1)).repartition(3)), key=str)
    assert got == sorted(((i, x) for (i, _), x in zip(rows, brute_repeats([t for _, t in rows], 200), strict=True)), key=str)
    for t in (b" " * 100_000, b"ab" * 50_000, b"abcdefghijklmnopqrst" * 5_000):
        _, _, start, n, _ = suffix_dedup.contexts(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        assert (n + 199).sum() < 4 * len(t)
        assert sorted(x for s, k in zip(start, n, strict=True) for x in range(s, s + k)) == list(range(len(t) - 199))


def test_repeats_inside_one_context(spark):
    """Periodic texts, each alone with its anchors: repeats closer to each other than they are long."""
    words = "The of lorem ipsum Straße naïve one a".split()
    texts = ["The " + "x" * 230, ("a phrase of forty-one bytes, said again; " * 6)[:241], "y" * 200, "z" * 201, "-" * 199]
    texts += [f"{i} " + f"{w}{i} " * 20 * (1 + i) + f" end{i}" for i, w in enumerate(words)] + ["".join(chr(97 + i) * 30 + f"{i}" for i in range(20))]
    want = dict(enumerate(brute_repeats(texts, 200)))
    assert want[0][1] == 230 and want[1][1] == 241 and want[2][1] == 0 and want[3][1] == 201
    for group in (20_000, 0):
        assert dict(removed(spark, frame(spark, texts), group=group)) == want
    length, groups = 30, {}
    for r in suffix_dedup.repeat_groups(frame(spark, texts), length=length, gram=7).collect():
        groups.setdefault((r.r1, r.r2), []).append((r.doc_id, r.start, r.length))
    covered = {(i, s + k) for places in groups.values() for i, s, n in places for k in range(n - length + 1)}
    raw = [t.encode() for t in texts]
    seen = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    assert covered == {(d, i) for d, t in enumerate(raw) for i in range(len(t) - length + 1) if seen[t[i : i + length]] > 1}


def test_suffix_dedup_query_on_a_whole_table(spark):
    texts = dict(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect())
    want = dict(zip(texts, brute_repeats(list(texts.values()), 200), strict=True))
    found = {r[0]: tuple(r[1:]) for r in queries.op2_suffix_dedup(spark, "/root/testdata/sf0.01").collect()}
    assert found == want


def test_repeat_groups_have_all_occurrences(spark):
    """Every window that occurs twice is in a repeat at each of its places, and a repeat's string stands at all places given."""
    texts = [t or "" for t in corpus()]
    length = 30
    groups = {}
    for r in suffix_dedup.repeat_groups(frame(spark, texts), length=length, gram=7).collect():
        groups.setdefault((r.r1, r.r2), []).append((r.doc_id, r.start, r.length))
    raw = [t.encode() for t in texts]
    covered = set()
    for places in groups.values():
        assert len(places) > 1 and len({raw[i][s : s + n] for i, s, n in places}) == 1
        covered.update((i, s + k) for i, s, n in places for k in range(n - length + 1))
    seen = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    assert covered == {(d, i) for d, t in enumerate(raw) for i in range(len(t) - length + 1) if seen[t[i : i + length]] > 1}


def test_maximal_repeats_have_all_occurrences():
    texts = [b"xabcdey", b"zabcdew", b"qabcdfr", b"abcde"]
    starts = [len(t) - 2 for t in texts]
    joined = b"".join(texts)
    found = {joined[p[0] : p[0] + n]: len(p) for n, p in suffix_dedup.maximal_repeats(texts, starts, 3)}
    assert found == {b"abcd": 4, b"abcde": 3}
    assert suffix_dedup.maximal_repeats([b"abc"], [1], 3) == []


def test_suffix_dedup_empty(spark):
    assert suffix_dedup.deduplicate(frame(spark, ["x"]).limit(0)).count() == 0


@pytest.mark.parametrize("capacity", [2, 1024])
def test_exact_dedup(spark, capacity):
    texts = corpus() + ["hot"] * 90
    docs = frame(spark, texts)
    got = {r.doc_id: r for r in exact_dedup.decisions(docs, capacity=capacity).collect()}
    groups = {}
    for i, t in enumerate(texts):
        groups.setdefault(t or "", []).append(i)
    assert len(got) == len(texts)
    for t, ids in groups.items():
        for i in ids:
            assert (got[i].keep_id, got[i].group_size, got[i].kept, got[i].text_sha256) == (max(ids), len(ids), i == max(ids), hashlib.sha256(t.encode()).hexdigest())
    kept = exact_dedup.deduplicate(docs.union(docs.limit(20)), capacity=capacity)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(max(ids) for ids in groups.values())


def test_exact_dedup_odd_rows(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (3, "a"), (3, "a"), (None, None), (4, "")], "doc_id long, text string")
    rows = exact_dedup.decisions(df).collect()
    assert sorted((r.doc_id or -1, r.keep_id, r.group_size, r.kept) for r in rows) == [(-1, 3, 4, False), (-1, 3, 4, False), (-1, 4, 2, False), (3, 3, 4, False), (3, 3, 4, True), (4, 4, 2, True)]
    assert exact_dedup.deduplicate(df).count() == 2
    assert exact_dedup.decisions(df.limit(0)).count() == 0
    assert exact_dedup.deduplicate(df.limit(0)).count() == 0
    marked = df.withColumn("Keep_id", F.monotonically_increasing_id()).withColumn("nth", F.lit("x")).unionByName(df.withColumn("Keep_id", F.lit(99)).withColumn("nth", F.lit("y")))
    for capacity in (1, 1024):
        kept = [exact_dedup.deduplicate(marked.repartition(n), capacity=capacity) for n in (1, 4)]
        assert kept[0].columns == marked.columns
        assert len({tuple(sorted(map(tuple, k.select("doc_id", "nth").collect()))) for k in kept}) == 1


def test_misra_gries_keeps_frequent():
    counts = {}
    for i in range(0, 3000, 10):
        block = [b"hot" if k % 3 == 0 else b"%d" % (i + k) for k in range(10)]
        counts = exact_dedup.fold(counts, block, [1] * 10, 4)
        assert len(counts) <= 4
    assert b"hot" in counts


def brute_links(texts):
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    similar = lambda a, b: len(a & b) * 5 >= 4 * len(a | b) if a and b else a == b
    return sets, similar


@pytest.mark.parametrize(("block", "set_block"), [(1024, 256), (2, 3)])
def test_jaccard_join(spark, monkeypatch, block, set_block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "SET_BLOCK", set_block)
    texts = corpus() + [" ".join(f"w{i}" for i in range(120)) + f" end{k}" for k in range(12)]
    docs = frame(spark, texts)
    got = {r.doc_id: r for r in jaccard_join.join(docs).collect()}
    sets, similar = brute_links(texts)
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        links = {b for b in sets if b != a and similar(a, b)}
        assert got[i].n_links == len(links)
        assert got[i].n_linked_docs == sum(similar(a, b) for b in sets) - 1
        for j, b in enumerate(sets[:i]):
            if similar(a, b):
                low, high = sorted((root[i], root[j]))
                root = [low if x == high else x for x in root]
    assert [got[i].class_id for i in range(len(texts))] == root
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root))


def test_jaccard_join_empty(spark):
    assert jaccard_join.join(frame(spark, ["x"]).limit(0)).count() == 0
    assert jaccard_join.one_of_each(frame(spark, ["x"]).limit(0)).count() == 0


def test_one_of_each_tells_rows_with_equal_ids_apart(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(1, a, 1), (2, a, 2), (2, b, 3), (3, b + " end", 4), (None, c, 5), (None, c, 6), (None, a, 7), (2, c, 8), (4, None, 9), (5, "", 10), (2, b, 11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, BODY long").repartition(3)
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(1, a), (2, b), (2, c), (4, None)], key=str)
    joined = sorted((str(r.doc_id), r.n_copies, r.n_linked_docs) for r in jaccard_join.join(docs).collect())
    assert joined == sorted([("1", 3, 2), ("2", 3, 2), ("None", 3, 2), ("2", 2, 2), ("2", 2, 2), ("3", 1, 2), ("2", 3, 2), ("None", 3, 2), ("None", 3, 2), ("4", 2, 1), ("5", 2, 1)])


@pytest.mark.parametrize(("block", "set_block"), [(1024, 256), (5, 4)])
def test_jaccard_join_of_a_large_near_cluster(spark, monkeypatch, block, set_block):
    """Sure links and verified ones add up to those of brute force in one group of many near copies."""
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "SET_BLOCK", set_block)
    rng = random.Random(31)
    base = [f"w{i}" for i in range(300)]
    texts = []
    for k in range(160):
        words = base[: rng.choice([300, 290, 250])]
        for _ in range(rng.choice([0, 1, 2, 6, 9, 14])):
            words[rng.randrange(len(words))] = f"v{rng.randrange(40)}"
        texts.append(" ".join(words))
    got = {r.doc_id: r for r in jaccard_join.join(frame(spark, texts)).collect()}
    sets, similar = brute_links(texts)
    for i, a in enumerate(sets):
        assert got[i].n_links == len({b for b in sets if b != a and similar(a, b)})
        assert got[i].n_linked_docs == sum(similar(a, b) for b in sets) - 1


def test_bands_reach_the_recall():
    for t in (0.5, 0.8, 0.9):
        bands, rows = jaccard_join.bands_for(t)
        assert bands * rows <= jaccard_join.VALUES
        assert 1 - (1 - t**rows) ** bands >= jaccard_join.RECALL or rows == 1


def brute_lines(rows, run, words=50):
    """rows: (doc_id, text); places of rows with equal ids are the same."""
    order, windows = {}, []
    for k, (i, t) in enumerate(rows):
        lines = [x.strip(" \t\r") for x in (t or "").split("\n")]
        lines = [x for x in lines if x]
        n = len(lines)
        place = lambda s: (i is not None, i or 0, s)  # noqa: B023, E731
        if 0 < n < run:
            windows.append((place(0), k, 0, n, (n, *lines)))
        windows += [(place(s), k, s, run, (run, *lines[s : s + run])) for s in range(n - run + 1)]
        windows += [(place(s), k, s, 1, ("long", lines[s])) for s in range(n) if len([x for x in re.split("[ \t]+", lines[s])]) >= words]
    gone = {}
    for at, _, _, _, w in windows:
        order[w] = min(order.get(w, at), at)
    for at, k, s, size, w in windows:
        if order[w] != at:
            gone.setdefault(k, set()).update(range(s, s + size))
    out = []
    for k, (i, t) in enumerate(rows):
        kept, n, removed, runs = [], 0, 0, 0
        for x in (t or "").split("\n"):
            if x.strip(" \t\r"):
                lost = n in gone.get(k, ())
                removed += lost
                runs += lost and n - 1 not in gone[k]
                if not lost:
                    kept.append(x)
                n += 1
            else:
                kept.append(x)
        out.append((i, "\n".join(kept), n, removed, runs))
    return out


LONG = " ".join(f"word{k}" for k in range(60))
LINES = ["a\nb\nc\n", "x\na\nb\nc", "b\n\n c\t\nz", "a\na\na\na", "q", "q", None, "", "\n\n", "l\n" * 50 + "m", "c\nz\nl\nl", "a\nb", LONG, f"n1\n  {LONG}\nn2", f"n3\n{LONG}\nn2\nn4", LONG + "\n" + LONG, " ".join(["w"] * 49), "y\n" + " ".join(["w"] * 49)]


@pytest.mark.parametrize(("gram", "window", "words"), [(1, 2, 50), (2, 3, 10**6), (1, 1, 50), (1, 4, 10**6), (1, 2, 3)])
def test_line_dedup(spark, gram, window, words):
    texts = LINES + corpus()
    got = {r[0]: tuple(r) for r in line_dedup.deduplicate_lines(frame(spark, texts), gram=gram, window=window, words=words).collect()}
    assert got == {r[0]: r for r in brute_lines(list(enumerate(texts)), gram + window - 1, words)}
    assert line_dedup.deduplicate_lines(frame(spark, ["x"]).limit(0)).count() == 0


def test_line_dedup_odd_rows(spark):
    """Null and repeated ids, repeated rows, and a text beyond one slice."""
    rng = random.Random(9)
    long = "\n".join(f"{rng.randrange(90_000)} some words of a line" for _ in range(60_000))
    rows = [(1, "a\nb\nc"), (1, "a\nb\nc"), (1, "z\na\nb"), (None, "b\nc\nd"), (None, "b\nc"), (5, "q\nc\nd"), (7, long), (8, "k\n" + long[-500:]), (2, long[1000:2000])]
    got = [tuple(r) for r in line_dedup.deduplicate_lines(spark.createDataFrame(rows, "doc_id long, text string").withColumn("S", F.lit(1)).repartition(3)).collect()]
    key = lambda r: (str(r[0]), r[1])
    assert sorted(got, key=key) == sorted(brute_lines(rows, 2), key=key)


def test_matches_are_extended_both_ways():
    line = lambda x: bytes([x]) * 16
    mine, others = b"".join(map(line, [9, 1, 2, 3, 4, 8, 5, 6])), b"".join(map(line, [7, 7, 1, 2, 3, 4, 0, 5, 6, 9]))
    assert line_dedup.extend(mine, others, -1, [2, 3]) == [(1, 5)]
    assert line_dedup.extend(mine, others, -1, [2, 6]) == [(1, 5), (6, 8)]


def test_line_sql():
    texts = LINES + corpus()
    con = duckdb.connect()
    con.execute("create table t (doc_id bigint, text varchar)")
    con.executemany("insert into t values (?, ?)", list(enumerate(texts)))
    want = {i: (n, removed, runs, hashlib.sha256(t.encode()).hexdigest()) for i, t, n, removed, runs in brute_lines(list(enumerate(texts)), 2)}
    columns = "doc_id, n_lines, n_removed, n_runs, kept_sha256"
    assert {r[0]: r[1:] for r in con.sql(f"select {columns} from ({line_dedup.SQL.format(docs='t')})").fetchall()} == want
