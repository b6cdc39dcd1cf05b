"""Mixing, toxicity, token counts, decontamination, language models, language id and the pipeline."""

import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tierlex.llm import decontamination, language_id, lm_scoring, mixing, token_counts, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, score string, LABEL int"
ODD = [None, "", "  \n ", "12 34", "x", "x", "\x00a", "Á é ñ", "😀 ok", "<s>a</s>"]


def frame(spark, texts, langs=None, sources=None):
    n = len(texts)
    langs, sources = langs or ["en"] * n, sources or ["s1"] * n
    return spark.createDataFrame([(i, *x, "clash", 1) for i, x in enumerate(zip(texts, langs, sources, strict=True))], SCHEMA).repartition(3)


def prose(seed, n, words):
    rng = random.Random(seed)
    return [" ".join(rng.choice(words) for _ in range(rng.randint(5, 60))) for _ in range(n)]


EN = "the of and that with from which have this tion ing through would".split()
DE = "der die und nicht mit ein über zwischen würde schön straße".split()


def mix_rows(seed):
    rng = random.Random(seed)
    texts = prose(seed, 300, EN) + ODD
    n = len(texts)
    return texts, [rng.choice(["en", "en", "en", "de", "xx", None]) for _ in range(n)], [rng.choice(["src0"] * 6 + ["src1", "src2", "src3", "src17", "other", None]) for _ in range(n)]


@pytest.mark.parametrize("leaves", [10_000, 0])
def test_mixing_is_its_sql(spark, monkeypatch, leaves):
    monkeypatch.setattr(mixing, "BROADCAST_LEAVES", leaves)
    rows = mix_rows(leaves)
    got = sorted(map(tuple, mixing.mix(frame(spark, *rows)).collect()))
    con = duckdb.connect()
    con.execute("create table t (doc_id bigint, text varchar, lang varchar, source varchar)")
    con.executemany("insert into t values (?, ?, ?, ?)", [(i, None if t is None else t.replace("\x00", ""), x, s) for i, (t, x, s) in enumerate(zip(*rows, strict=True))])
    assert got == sorted(con.sql(f"select doc_id, domain, lang, source, n_tokens, leaf_budget, copies from ({mixing.SQL.format(docs='t')})").fetchall())


def test_mixing_shares_shortages(spark):
    """A source that runs short leaves its part to its siblings; budgets add up to the whole."""
    texts = ["w " * 10] * 2 + ["w " * 10] * 40 + ["w " * 10] * 20
    sources = ["src0"] * 2 + ["src4"] * 40 + ["src1"] * 20
    rows = mixing.mix(frame(spark, texts, sources=sources), weights={}, budget=300, epochs=2).collect()
    budgets = {r.source: r.leaf_budget for r in rows}
    assert budgets == {"src0": 40, "src4": 110, "src1": 150}
    used = Counter()
    for r in rows:
        used[r.source] += r.n_tokens * r.copies
    assert used == {"src0": 40, "src4": 110, "src1": 150}


def test_mixing_odd(spark):
    df = frame(spark, ["a b"] * 3)
    assert mixing.mix(df.limit(0)).count() == 0
    out = mixing.mixed(df.withColumnRenamed("score", "copies"))
    assert {"copies", "copies_"} <= set(out.columns)
    assert {r.copies for r in mixing.mix(frame(spark, [None, ""])).collect()} == {0}


def test_token_counts(spark):
    public = pytest.importorskip("public_tokenizers")
    import sentencepiece

    path = public.path("piece_bpe_32k.model")
    rng = random.Random(2)
    texts = ODD + prose(3, 30, EN + DE) + ["".join(rng.choice("ab \t\n▁é😀.,1") for _ in range(rng.randint(0, 80))) for _ in range(200)] + [" " * 50 + "x", "word " * 6000, "a" * 3000]
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    got = {r.doc_id: r for r in token_counts.token_counts(frame(spark, texts), path).collect()}
    for i, t in enumerate(texts):
        n = len(sp.encode(t or ""))
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 4096)
    assert token_counts.token_counts(frame(spark, ["x"]).limit(0), path).count() == 0


def test_toxicity(spark):
    rng = random.Random(4)
    texts, labels = [], []
    for i in range(1500):
        bad = i % 5 == 0
        words = [rng.choice(EN) + rng.choice("abc") for _ in range(rng.randint(8, 60))]
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["scumbag", "scumbags", "vile"])
        texts.append(" ".join(words))
        labels.append((i, int(bad)))
    docs = frame(spark, texts + ODD)
    marks = spark.createDataFrame([*labels, (None, 1), (3, None), (10**9, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, marks)
    assert 0 < len(model[0]) < 1 << toxicity.BITS
    rows = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert len(rows) == len(docs.collect())
    held = [r for r in rows.values() if r.held_out and r.doc_id < 1500]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows.values())
    assert np.mean([r.predicted == (r.doc_id % 5 == 0) for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    assert toxicity.train(docs, marks.limit(0))[0].size == 0
    assert toxicity.score(docs.limit(0), model).count() == 0


def plain_ftrl(texts, labels):
    """The same updates, one feature at a time."""
    import pyarrow as pa

    from tierlex.llm.textarrays import Words, flat

    examples = []
    for t in texts:
        _, places = toxicity.features(Words(*flat(pa.array([t]))))
        examples.append([*sorted(set(places.tolist())), -1])
    z, n = Counter(), Counter()

    def weight(i):
        over = abs(z[i]) - (0 if i == -1 else toxicity.L1)
        return -math.copysign(over, z[i]) / ((toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2) if over > 0 else 0.0

    order = np.random.default_rng(7)
    for _ in range(toxicity.EPOCHS):
        for k in order.permutation(len(examples)):
            w = {i: weight(i) for i in examples[k]}
            g = 1 / (1 + math.exp(-sum(w.values()))) - labels[k]
            for i in examples[k]:
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / toxicity.ALPHA * w[i]
                n[i] += g * g
    return {i: w for i in z if (w := weight(i))}


def test_toxicity_is_plain_ftrl(spark):
    """Weights and scores of the query's path against a plain loop, with repeated rows and a very long text."""
    rng = random.Random(14)
    texts = [" ".join(rng.choice(EN) for _ in range(12)) + (" vile scum" if k % 3 == 0 else "") for k in range(120)]
    texts += [" ".join(EN) * 20_000, texts[0], None, ""]
    labels = [float(k % 3 == 0) for k in range(120)] + [0.0, 1.0]
    docs = frame(spark, texts)
    marks = spark.createDataFrame([(k, int(y)) for k, y in enumerate(labels)], "doc_id long, toxic int")
    places, values, bias = toxicity.train(docs, marks)
    place = {i: r for i, r in spark.range(len(labels)).select("id", toxicity.hash_place("id")).collect()}
    mine = sorted((k for k in range(len(labels)) if zlib.crc32(str(k).encode()) % 5), key=lambda k: (place[k], k))
    want = plain_ftrl([texts[k] for k in mine], [labels[k] for k in mine])
    assert dict(zip([*places.tolist(), -1], [*values.tolist(), bias], strict=True)) == pytest.approx({-1: 0.0} | want)
    both = docs.union(docs.where("doc_id = 0"))
    rows = [(r.doc_id, r.score) for r in toxicity.score(both, (places, values, bias)).collect()]
    assert len(rows) == len(texts) + 1 and len({x for i, x in rows if i in (0, 121)}) == 1
    assert [x for i, x in rows if i >= 122] == pytest.approx([1 / (1 + math.exp(-bias))] * 2)


def brute_align(item, text):
    best, h = 0.0, np.zeros((len(item) + 1, len(text) + 1))
    for i in range(1, len(item) + 1):
        for j in range(1, len(text) + 1):
            same = decontamination.MATCH if item[i - 1] == text[j - 1] else decontamination.MISMATCH
            h[i, j] = max(0, h[i - 1, j - 1] + same, h[i - 1, j] + decontamination.GAP, h[i, j - 1] + decontamination.GAP)
            best = max(best, h[i, j])
    return best


def test_alignment_is_smith_waterman():
    rng = random.Random(5)
    for _ in range(60):
        item = np.array([rng.randrange(5) for _ in range(rng.randint(1, 12))])
        text = np.array([rng.randrange(5) for _ in range(rng.randint(1, 25))])
        score, a, b = decontamination.align(item, text)
        assert score == pytest.approx(brute_align(item, text))
        if score:
            assert brute_align(item, text[a:b]) == pytest.approx(score)


def test_decontamination(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    items = [" ".join(word() for _ in range(30)) for _ in range(8)]
    filler = lambda n: " ".join(rng.choice(EN) for _ in range(n))
    edited = items[1].split()
    for k in (4, 11, 19, 26):
        edited[k] = word()
    del edited[15]
    texts = [filler(40) + " " + items[0].upper() + ", " + filler(30), filler(9) + " " + " ".join(edited), filler(200), " ".join(items[2].split()[:8]) + " " + filler(50), *ODD]
    bench = spark.createDataFrame([*enumerate(items), (20, None), (None, "x"), (21, "a b"), (22, items[0]), (22, items[0])], "item_id long, text string")
    docs = frame(spark, texts).withColumn("words", F.lit(1)).withColumn("BODY", F.lit("x"))
    rows = {(r.doc_id, r.item_id): r for r in decontamination.contaminated(docs, bench).collect()}
    assert set(rows) == {(0, 0), (0, 22), (1, 1)}
    assert rows[0, 0].score == 1 and (rows[0, 0].start_word, rows[0, 0].end_word) == (40, 70)
    kept = decontamination.clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == list(range(2, len(texts)))
    twice = docs.union(docs.where("doc_id < 2")).union(docs.where("doc_id = 0").withColumn("doc_id", F.lit(None).cast("long")))
    assert sorted((r.doc_id is None, r.item_id) for r in decontamination.contaminated(twice, bench).collect()) == sorted([(False, 0), (False, 22), (False, 1)] * 2 + [(True, 0), (True, 22)])
    assert decontamination.clean(twice, bench).count() == len(texts) - 2
    assert decontamination.contaminated(docs, bench.limit(0)).count() == 0
    assert decontamination.contaminated(docs.limit(0), bench).count() == 0
    assert decontamination.clean(docs, bench.limit(0)).count() == len(texts)


@pytest.mark.parametrize("slots", [22, 4])
def test_decontamination_is_brute_force(spark, monkeypatch, slots):
    """The whole query at production values: items of common words alone, edits, insertions, several copies in one long text, and few slots."""
    monkeypatch.setattr(decontamination, "SLOTS", slots)
    rng = random.Random(26)
    some = [f"{a}{b}" for a in EN for b in "xyz"]
    text = lambda n: [rng.choice(some) for _ in range(n)]
    items = [text(rng.choice([5, 12, 30, 45])) for _ in range(12)]
    docs = []
    for _ in range(90):
        words = text(rng.randint(0, 80))
        for _ in range(rng.randint(0, 3)):
            copy = [x for x in rng.choice(items) if rng.random() > 0.08]
            for _ in range(rng.randint(0, 6)):
                copy.insert(rng.randrange(len(copy) + 1), rng.choice(some))
            at = rng.randint(0, len(words))
            words[at:at] = copy
        docs.append(" ".join(words))
    docs.append(" ".join(text(30_000) + items[2]))
    grams = lambda w: {tuple(w[k : k + 3]) for k in range(len(w) - 2)}
    want = {}
    for k, t in enumerate(docs):
        for i, x in enumerate(items):
            words = t.split()[-200:] if k == 90 else t.split()
            if grams(x) & grams(words) and (score := brute_align(x, words) / len(x)) >= decontamination.LEAST:
                want[k, i] = score
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    rows = {(r.doc_id, r.item_id): r.score for r in decontamination.contaminated(frame(spark, docs), bench).collect()}
    assert len(want) > 60 and set(want) <= set(rows)
    assert {k: v for k, v in rows.items() if k[0] < 90} == pytest.approx({k: v for k, v in want.items() if k[0] < 90})


def test_decontamination_of_an_item_leaked_into_a_third_of_the_rows(spark):
    rng = random.Random(16)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    items = [" ".join(word() for _ in range(38)) for _ in range(4)]
    texts = [" ".join(word() for _ in range(44)) for _ in range(300)]
    for k in range(0, 300, 3):
        copy = items[0].split()
        for place in rng.sample(range(38), k % 5):
            copy[place] = word()
        texts[k] = word() + " " + " ".join(copy)
    texts[1] = items[1]
    bench = spark.createDataFrame([*enumerate(items)], "item_id long, text string")
    docs = frame(spark, texts)
    expected = {(k, i) for k, t in enumerate(texts) for i, x in enumerate(items) if brute_align_words(x, t) >= decontamination.LEAST}
    assert expected == {(k, 0) for k in range(0, 300, 3)} | {(1, 1)}
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, bench).collect()} == expected
    assert {r.doc_id for r in decontamination.clean(docs, bench).collect()} == set(range(300)) - {k for k, _ in expected}


def brute_align_words(item, text):
    return brute_align(item.split(), text.split()) / len(item.split()) if set(item.split()) & set(text.split()) else 0.0


def lm_tokens(t):
    return re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())) + [b"\x20"]


@pytest.mark.parametrize(("own", "broad"), [(5, 40), (0, 0), (60_000, 400_000)])
def test_lm_scoring(spark, own, broad):
    texts = prose(7, 250, EN + DE + [f"rare{i}" for i in range(300)]) + [*ODD, " ".join(EN) * 3000]
    docs = frame(spark, texts).withColumn("body", F.lit(1)).withColumn("N_TOKENS", F.lit("x"))
    rows = {r.doc_id: r for r in lm_scoring.score(docs.union(docs.where("doc_id = 3")), own=own, broad=broad).collect()}
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, t in [*enumerate(texts), (3, texts[3])] for w in lm_tokens(t) if not held(i))
    n, v = sum(c.values()), len(c)
    for i, t in enumerate(texts):
        r, w = rows[i], lm_tokens(t)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(w), sum(x in c for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
        assert math.isfinite(r.score) and r.score < 0


def words_of(texts):
    import pyarrow as pa

    from tierlex.llm.textarrays import Words, flat

    return lm_scoring.sequence(Words(*flat(pa.array(texts, pa.string()))))


def test_lm_scores_are_plain_log_probabilities(spark):
    """The query's scores against a plain softmax over all words and the share of a word in its class."""
    rng = random.Random(21)
    texts = [" ".join(f"{rng.choice(EN)}{rng.choice('abcd')}" if rng.random() < 0.3 else rng.choice(EN) for _ in range(rng.randint(1, 30))) for _ in range(120)]
    docs = frame(spark, texts)
    got = {r.doc_id: r.score for r in lm_scoring.score(docs, own=6, broad=30).collect()}
    train = docs.where("pmod(crc32(cast(doc_id as string)), 7) <> 2").select("doc_id", "text")
    counts = lm_scoring.count_tokens(train)
    vocab = lm_scoring.vocabulary(counts, 6, 30)
    assert 0 < len(vocab.hash) <= 30 and vocab.size == 1 + lm_scoring.TAILS + 6
    model = lm_scoring.fit(train, vocab)
    c = Counter(w for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 7 != 2 for w in lm_tokens(t))
    hashes, tails, _ = words_of([" ".join(x.decode() for x in c if x != b" ")])
    row = {x: (0, 0) if x == b" " else (int(vocab.rows(vocab.find(h[None]), t[None])[0]), int(t)) for x, h, t in zip([x for x in c if x != b" "] + [b" "], hashes, tails, strict=True)}
    mass = Counter()
    for x, (r, t) in row.items():
        if 0 < r <= lm_scoring.TAILS:
            mass[r] += c[x] + 1

    def plain(text):
        total, before = 0.0, [0, 0]
        for x in lm_tokens(text):
            if x not in row:
                (h,), (t,), _ = [y[:1] for y in words_of([x.decode()])]
                r = int(t)
            else:
                r = row[x][0]
            s = (model.P[before[1]] + model.Q[before[0]]) @ model.R.T + model.b[:, 0]
            s = s.astype(np.float64)
            p = s[r] - np.log(np.exp(s).sum())
            if 0 < r <= lm_scoring.TAILS:
                p += math.log((c[x] + 1) / (mass[r] + 1))
            total += p / math.log(10)
            before = [before[1], int(vocab.context[r])]
        return total

    for i in range(0, 120, 7):
        assert got[i] == pytest.approx(plain(texts[i]), rel=1e-3)
    assert sum((n + 1) / (mass[row[x][0]] + 1) for x, n in c.items() if 0 < row[x][0] <= lm_scoring.TAILS) + sum(1 / (m + 1) for m in mass.values()) == pytest.approx(len(mass))


def test_lm_learns_and_shards_by_hash(spark):
    """Held-out texts of a chain of words score far above the base; partitions of the input don't matter."""
    rng = random.Random(22)
    after = {w: rng.sample(EN + DE, 2) for w in EN + DE}
    texts = []
    for _ in range(1200):
        words = [rng.choice(EN)]
        for _ in range(40):
            words.append(rng.choice(after[words[-1]]))
        texts.append(" ".join(words))
    docs = frame(spark, texts)
    total = lambda d: lm_scoring.score(d).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    a, b = total(docs), total(docs.repartition(7))
    assert a[0] == pytest.approx(b[0], rel=1e-5)
    assert (a[0] - a[1]) / a[2] > 0.1


def test_lm_is_normalised_and_learns():
    rng = np.random.default_rng(1)
    share = np.array([0.1, 0.1, 0.2, 0.2, 0.2, 0.2])
    w = np.array([2, 3, 4, 5] * 3000)
    c1, c2 = np.roll(w, 1), np.roll(w, 2)
    m = lm_scoring.Model(share, 6, 4)
    for _ in range(40):
        for i in range(0, len(w), 512):
            k = rng.permutation(len(w))[:512]
            m.learn(w[k], c1[k], c2[k])
    z = m.normalisers(block=4)
    every = np.arange(6)
    p = np.array([[10.0 ** m.log10(z, every, np.full(6, a), np.full(6, b)) for b in range(6)] for a in range(6)])
    assert np.allclose(p.sum(2), 1, atol=1e-4)
    assert p[2, 5, 3] > 0.5


def test_lm_odd(spark):
    assert lm_scoring.score(frame(spark, ["x"]).limit(0)).count() == 0


def brute_bits(samples, text, order):
    """Code length by walking contexts, one byte after another."""
    seen = {}
    for t in samples:
        s = t.encode()
        for i, x in enumerate(s):
            for k in range(order + 1):
                seen.setdefault((b"\0" * k + s[:i])[-k:] if k else b"", Counter())[x] += 1

    def cost(ctx, x):
        bits = 0.0
        while True:
            if c := seen.get(ctx):
                d, n = len(c), sum(c.values())
                if x in c:
                    return bits + math.log2((n + d) / c[x])
                bits += math.log2((n + d) / d)
            if not ctx:
                return bits + 8
            ctx = ctx[1:]

    s = text.encode()
    return sum(cost((b"\0" * order + s[:i])[-order:], x) for i, x in enumerate(s))


def test_language_codes_are_exact():
    import pyarrow as pa

    from tierlex.llm.textarrays import flat

    samples = {"de": prose(8, 12, DE), "en": prose(9, 12, EN), "ru": prose(18, 9, "что это для как они только было".split()), "zh": ["我们在这里学习语言", "他们的书在这里"], "xx": ["\0a\0", "q"]}
    for order in (2, 4):
        trees = language_id.train(samples, order)
        texts = ["the und", "würde schön", "Q?", "", "это было", "这里的语言", "\0\0a", *prose(10, 3, EN + DE)]
        got = trees.bits(*flat(pa.array(texts)))
        want = [[brute_bits(samples[x], t, order) for x in trees.langs] for t in texts]
        assert np.allclose(got, want, rtol=1e-4)


def test_language_groups_hold_all_scripts():
    """Every byte value of several scripts is its own symbol, and languages of different groups compare."""
    import pyarrow as pa

    words = {"en": EN, "de": DE, "ru": "что это для как они только было".split(), "el": "και το να με που από για".split(), "zh": [chr(0x4E00 + k) for k in range(300)], "ar": "في من على هذا كان".split()}
    trees = language_id.train({x: prose(20 + i, 40, w) for i, (x, w) in enumerate(words.items())})
    for i, (x, w) in enumerate(words.items()):
        langs, scores = language_id.judge(trees, pa.array(prose(40 + i, 10, w)))
        assert set(langs) == {x} and scores.min() > 0.9


def test_language_id(spark):
    texts = prose(11, 150, EN) + prose(12, 150, DE) + ODD
    langs = ["en"] * 150 + ["de"] * 150 + [None] * len(ODD)
    docs = frame(spark, texts, langs)
    trees = language_id.learn(docs)
    rows = {r.doc_id: r for r in language_id.identify(docs, trees).collect()}
    assert all(rows[i].lang_pred == langs[i] and rows[i].score > 0.5 for i in range(300))
    assert [rows[300 + i].lang_pred == "und" for i in range(4)] == [True] * 4
    assert rows[300].score == 0 and rows[304].lang_pred in ("en", "de")
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows.values())
    kept = language_id.accepted(docs, trees)
    assert kept.columns == docs.columns and kept.count() >= 302
    nothing = language_id.learn(docs.where("lang is null"))
    assert {r.lang_pred for r in language_id.identify(docs, nothing).collect()} == {"und"}
    assert language_id.identify(docs.limit(0), trees).count() == 0


def test_pipeline(spark, tmp_path):
    """The stages' rows against plain versions of them."""
    import corpus_pipeline

    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [" ".join(word() for _ in range(60)) for _ in range(40)]
    item = " ".join(word() for _ in range(30))
    near = [" ".join([*base[k].split()[:-1], word()]) for k in range(10)]
    texts = base + base[:7] + near + [base[20] + " " + item] + ODD[:4]
    n = len(texts)
    frame(spark, texts, sources=[f"src{i % 8}" for i in range(n)]).drop("score", "LABEL").withColumnRenamed("text", "text").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, left = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = stage(spark, docs, str(tmp_path)).cache()
        assert docs.columns == columns
        left.append({r.doc_id for r in docs.collect()})
    assert left[0] == set(range(n - 4))
    assert left[1] == left[0] - set(range(7))
    near_ids = {47 + k: (40 + k if k < 7 else k) for k in range(10)}
    assert left[2] == left[1] - set(near_ids)
    assert left[3] == left[2] - {57}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # the last stage on what the fourth left, by its SQL
    con = duckdb.connect()
    con.execute("create table t (doc_id bigint, text varchar, lang varchar, source varchar)")
    con.executemany("insert into t values (?, ?, ?, ?)", [(i, texts[i], "en", f"src{i % 8}") for i in sorted(left[3])])
    want = con.sql(f"select doc_id, copies from ({mixing.SQL.format(docs='t')}) where copies > 0").fetchall()
    assert sorted((r.doc_id, r.copies) for r in got) == sorted(want)


def test_pipeline_odd_tables(spark, tmp_path):
    """An empty table, and one with null and repeated ids, equal rows, empty and very long texts."""
    import corpus_pipeline

    rng = random.Random(23)
    long = " ".join(rng.choice(EN) + rng.choice("abcdefghij") for _ in range(60_000))
    other = " ".join(rng.choice(EN) + rng.choice("klmnopq") for _ in range(60))
    spark.createDataFrame([(0, "x y"), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/a/benchmark.parquet")
    rows = [(1, long), (1, long), (1, other), (None, other + " end"), (None, None), (2, ""), (3, None), (4, long + " tail"), (5, "12 34")]
    df = spark.createDataFrame([(i, t, "en", None, 7, "k") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, COPIES string")
    df.write.parquet(f"{tmp_path}/a/documents.parquet")
    kept = {(r.doc_id, len(r.text)) for r in corpus_pipeline.run(spark, f"{tmp_path}/a").collect()}
    assert kept <= {(1, len(long)), (1, len(other)), (None, len(other) + 4), (4, len(long) + 5)}
    docs = df
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, f"{tmp_path}/a").cache()
        assert docs.columns == df.columns
    assert sorted(len(r.text) for r in docs.collect()) == sorted([len(long), len(other)])  # one of each group of near copies
    spark.createDataFrame([], df.schema).write.parquet(f"{tmp_path}/b/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/b/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").count() == 0


def test_repeated_rows_and_null_ids(spark):
    """Mixing, token counts, scores and languages of rows that come twice or have no id."""
    public = pytest.importorskip("public_tokenizers")
    text = "the of and that with " * 3
    docs = spark.createDataFrame([(1, text, "en", "src1"), (1, text, "en", "src1"), (None, text, "en", "src1"), (None, None, None, None), (2, "würde schön straße " * 4, "de", "src2")], "doc_id long, text string, lang string, source string")
    mixed = mixing.mix(docs).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in mixed) == [("1", 15), ("1", 15), ("2", 12), ("None", 0), ("None", 15)]
    counts = token_counts.token_counts(docs, public.path("piece_bpe_32k.model")).collect()
    assert len(counts) == 5 and len({r.n_tokens for r in counts if r.n_bytes == len(text)}) == 1
    scores = [r for r in lm_scoring.score(docs).collect() if r.n_tokens == 16]
    assert len(scores) == 3 and not any(r.held_out for r in scores if r.doc_id is None)
    assert len({round(r.base_score, 9) for r in scores}) == 1
    trees = language_id.learn(docs)
    found = language_id.identify(docs, trees).collect()
    assert sorted((str(r.doc_id), r.lang_pred) for r in found) == [("1", "en"), ("1", "en"), ("2", "de"), ("None", "en"), ("None", "und")]
