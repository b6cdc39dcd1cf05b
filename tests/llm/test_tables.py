"""Whitening, packing and the source audit."""

import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tierlex.llm import bytepairs, divergence, packing, queries, whitening

VECTORS = "vec_id long, embedding array<double>, label int, X string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "clash") for i, v in rows], VECTORS).repartition(3)


def exact(vectors_, k=32):
    """Eigenpairs of the covariance, whitened rows and deviations, by plain numpy and whole numbers."""
    x = np.floor(64 * np.array(vectors_)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    c = (n * x - s) / n
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return e, np.trace(v), (c @ u) / np.sqrt(e), ((n * x - s) ** 2).sum(1)


def collected(df, k):
    rows = sorted(df.collect(), key=lambda r: (r.vec_id, r.component))
    return rows, np.array([r.whitened for r in rows]).reshape(-1, k)


def held(found, wanted):
    return found * np.sign((found * wanted).sum(0))


@pytest.mark.parametrize(("dims", "rank"), [(8, 8), (50, 50)])
def test_whitened_rows_are_those_of_the_whole_covariance(spark, dims, rank):
    rng = np.random.default_rng(dims)
    v = (rng.standard_normal((400, rank)) * np.linspace(1, 9, rank)).tolist()
    bad = [(900, None), (901, [1.0, None] + [0.0] * (dims - 2)), (902, [float("nan")] * dims), (903, [float("inf")] * dims), (904, [1e300] * dims)]
    k = min(32, dims)
    rows, found = collected(whitening.whiten(vectors(spark, [*enumerate(v), *bad])), k)
    e, trace, wanted, deviations = exact(v, k)
    assert [r.vec_id for r in rows[::k]] == list(range(400)) and rows[0].n == 400
    np.testing.assert_allclose(held(found, wanted), wanted, atol=1e-9)
    assert [r.deviation for r in rows[::k]] == deviations.tolist()
    np.testing.assert_allclose([r.explained for r in rows[:k]], e / trace, rtol=1e-10)
    assert all(r.identity_error < 1e-9 for r in rows)


def test_range_finder_ends_where_the_rest_is_proven_to_be_nothing(spark):
    rng = np.random.default_rng(3)
    low = rng.integers(-40, 40, (300, 6)) @ np.eye(6, 80)  # 80 dimensions, six of them in use
    rows = whitening.whole_vectors(vectors(spark, enumerate((low / 64).tolist())))
    model = whitening.fit(rows, components=6)
    assert model.width == 16 < 80
    np.testing.assert_allclose(model.variances, exact(low[:, :6] / 64, 6)[0], rtol=1e-9)
    full = whitening.fit(whitening.whole_vectors(vectors(spark, enumerate(rng.standard_normal((300, 80)).tolist()))), components=6)
    assert full.width == 80


def test_odd_vectors(spark):
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, []), (2, None)])).count() == 0
    one = whitening.whiten(vectors(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened) for r in sorted(one, key=lambda r: r.component)] == [(1, 1, 0, None), (2, 1, 0, None)]
    twins = whitening.whiten(vectors(spark, [(None, [1.0, 0.0]), (None, [1.0, 0.0]), (7, [2.0])])).where("component = 1").collect()
    assert sorted(abs(round(r.whitened, 9)) for r in twins) == [0.707106781, 0.707106781, 1.414213562]  # the short one is padded
    huge = whitening.whiten(vectors(spark, [(1, [1e15]), (2, [-1e15])])).collect()
    assert {r.deviation for r in huge} == {None} and {abs(r.whitened) for r in huge} == {1.0}


def simulated(histogram, size, n_windows):
    """Best fit, one piece at a time, while no piece has to be cut."""
    open_, out = [size] * n_windows, 0
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fits = [c for c in open_ if c >= length]
            if not fits:
                return None
            best = min(fits)
            open_[open_.index(best)] -= length
            out += 1
    return sorted(open_)


@pytest.mark.parametrize("seed", range(30))
def test_plan_places_every_identifier_once_and_fits_best(seed):
    rng = random.Random(seed)
    size = rng.choice([8, 64, 1024])
    histogram = Counter(rng.randint(1, size) if rng.random() < 0.8 else rng.randint(1, 3) for _ in range(rng.randint(1, 400)))
    spare = rng.choice([0, 1, 1000])
    plan = packing.best_fit(histogram, size, spare)
    seen, windows = {}, {}
    for r in plan:
        for i in range(r.count):
            seen.setdefault((r.length, r.first + i), []).append((r.shift, r.take))
            windows.setdefault(r.window + i, []).append((r.offset, r.take))
    assert set(seen) == {(length, i) for length, n in histogram.items() for i in range(n)}
    for (length, _), parts in seen.items():
        assert sum(t for _, t in parts) == length and all(a + t == b for (a, t), (b, _) in zip(sorted(parts), sorted(parts)[1:], strict=False))
    total = sum(length * n for length, n in histogram.items())
    fills = [sum(t for _, t in w) for w in windows.values()]
    for w in windows.values():
        w.sort()
        assert w[0][0] == 0 and all(a + t == b for (a, t), (b, _) in zip(w, w[1:], strict=False))
    assert max(fills) <= size and sum(fills) == total
    if spare == 0:
        assert all(f == size or f & (f - 1) == 0 for f in fills)
    if spare == 1000 and total % size == 0 and (left := simulated(histogram, size, 2 * (total // size))) is not None:
        assert sorted([size - f for f in fills] + [size] * (2 * (total // size) - len(fills))) == left


PIECES = ["the", " quick", "'s", "'re", "'ll", "''s", " 's", "\n's", "\n\n", "   ", " \n x", "12", "a1b2", "ñandú", " über", "÷", "×", "²", "日本", "😀", " ", "\u0085", "\x1c", "\x00", "_", "--", "Straße", "ǅ", "<|endoftext|>", "É", "'S", "'t'd", "."]


def test_identifiers_are_the_library_s(spark):
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, own, rng = Tokenizer.from_file(path), bytepairs.Encoder(*bytepairs.load(path)), random.Random(5)
    for _ in range(40):
        texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 12))) for _ in range(50)] + ["", "x", " "]
        found = own.many(pa.array(texts, pa.string()))
        assert [x.tolist() for x in found] == [library.encode(t, add_special_tokens=False).ids for t in texts]


DOCS = "doc_id long, text string, lang string, source string, IDS string, task int, length long"


def docs(spark, texts, langs=None, sources=None):
    n = len(texts)
    return spark.createDataFrame([(i, *x, "clash", 1, 2) for i, x in enumerate(zip(texts, langs or ["en"] * n, sources or ["a"] * n, strict=True))], DOCS).repartition(3)


def test_packed_documents_can_be_put_together_again(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, rng = Tokenizer.from_file(path), random.Random(9)
    texts = [None, "", "same", "same", "word " * 30_000, "x" * 20_000] + [" ".join(rng.choice(["ein", "longer", "Wörter", "12", "?"]) for _ in range(rng.randint(1, 900))) for _ in range(200)]
    packed = packing.pack(docs(spark, texts), path)
    rows = packed.collect()
    for i, t in enumerate(texts):
        mine = sorted((r.start, r.ids, r.doc_tokens) for r in rows if r.doc_id == i)
        ids = np.frombuffer(b"".join(x for _, x, _ in mine), "<u4").tolist()
        assert ids == [*library.encode(t or "", add_special_tokens=False).ids, 0] and {n for *_, n in mine} == {len(ids)}
        assert [s for s, *_ in mine] == np.cumsum([0, *(len(x) // 4 for _, x, _ in mine)])[:-1].tolist()
    for s in packing.sequences(packed).collect():
        parts = sorted((r.offset, r.ids) for r in rows if r.sequence_id == s.sequence_id)
        whole = b"".join(x for _, x in parts)
        assert [o for o, _ in parts] == np.cumsum([0, *(len(x) // 4 for _, x in parts)])[:-1].tolist()
        assert bytes(s.ids[: len(whole)]) == whole and len(whole) == 4 * s.n_tokens <= 4096
        assert len(s.ids) == (len(whole) if s.n_tokens & (s.n_tokens - 1) == 0 else 4096) and not any(s.ids[len(whole) :])


def test_packing_without_broadcast_of_numbers_and_of_odd_tables(spark, monkeypatch):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    monkeypatch.setattr(packing, "BROADCAST_COUNTS", 0)
    twice = docs(spark, ["a b c"] * 50 + [None] * 50).withColumn("doc_id", F.lit(None).cast("long"))
    rows = packing.pack(twice, path).collect()
    assert sum(r.length for r in rows) == 50 * 4 + 50 and len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert packing.pack(docs(spark, ["x"]).limit(0), path).count() == 0


def test_digests_of_the_packing_query(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = dict(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    rows = queries.op12_packing(spark, "/root/testdata/sf0.001").collect()
    whole = {i: np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for i, t in texts.items()}
    assert all(r.ids_crc32 == zlib.crc32(whole[r.doc_id][r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(whole[r.doc_id]) for r in rows)
    assert sum(r.length for r in rows) == sum(map(len, whole.values()))


def audited(spark, texts, langs, sources):
    df = docs(spark, texts, langs, sources)
    found = sorted(map(tuple, divergence.audit(df).collect()), key=repr)
    con = duckdb.connect()
    con.register("d", df.toPandas())
    return found, sorted(con.execute(divergence.SQL.format(docs="d")).fetchall(), key=repr)


def test_audit_equals_its_sql_on_odd_rows(spark):
    rng = random.Random(2)
    words = ["the", "The", "é", "É", "日本", "a'b", "x1y", "\x00z", "o\x7fp", "ß", "don't", *(f"w{chr(97 + i)}" for i in range(26))]
    n = 900
    texts = [" ".join(rng.choices(words, weights=range(len(words), 0, -1), k=rng.randint(0, 20))) if rng.random() > 0.1 else rng.choice([None, "", " \n", "12"]) for _ in range(n)]
    langs = [rng.choice(["en", "en", "en", "de", None, "", "rare"] if i % 50 == 0 else ["en", "en", "de", None]) for i in range(n)]
    sources = [rng.choice(["hot"] * 5 + ["s1", "s2", "s3", None, ""]) if i % 90 else "empty" for i in range(n)]
    texts = [None if s == "empty" else t for t, s in zip(texts, sources, strict=True)]
    found, wanted = audited(spark, texts, langs, sources)
    assert found == wanted
    assert {r[0] for r in found} >= {"en", "de", "", "rare"} and any(r[1] == "empty" for r in found)
    assert {r[4] for r in found if r[0] == "rare"} == {0}


def test_audit_of_long_and_repeated_texts_and_of_nothing(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BROADCAST_GROUPS", 0)
    texts = ["long " * 50_000] + ["same words here"] * 40 + ["other words there"] * 40
    found, wanted = audited(spark, texts, None, ["a"] * 41 + ["b"] * 40)
    assert found == wanted and len(found) == 2 + 2 + 2
    assert divergence.audit(docs(spark, ["x"]).limit(0)).count() == 0
