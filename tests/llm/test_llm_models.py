"""Quality, language and token files."""

import random
import zlib

import numpy as np
import pytest
from tests_llm_brute import prose
from pyspark.sql import functions as F

from tidemark.llm import language, quality, token_codes


# ------------------------------------------------------------------ quality


def junk(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(["BUY!!", "###", "w%%%", "$$$", "NOW&&&"]) for _ in range(n))


@pytest.fixture(scope="module")
def labelled(spark):
    texts = [(i, prose(i, 20 + i % 90) if i % 4 else junk(i, 20 + i % 90)) for i in range(400)]
    labels = [(i, int(bool(i % 4)), 0, "extra") for i, _ in texts] + [(1, None, 0, ""), (None, 1, 0, ""), (9999, 0, 0, "")]
    return texts, spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")


def test_scores_separate_held_out_documents(spark, make_docs, labelled):
    texts, labels = labelled
    docs = make_docs(texts + [(1000, None), (1001, ""), (None, "x"), (1002, "word " * 30_000)])
    stats = quality.document_statistics(docs)
    model = quality.train(stats, quality.learnable(labels))
    rows = quality.score_statistics(stats, model).collect()
    assert len(rows) == len(texts) + 4 and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.doc_id is not None and r.doc_id < 400 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    right = [(r.score >= quality.ACCEPT) == bool(r.doc_id % 4) for r in held]
    assert len(held) > 40 and np.mean(right) > 0.95
    passed = quality.score_documents(docs, model)
    assert passed.columns == [c for c in docs.columns if c != "score"] + ["score"]
    direct = {r.doc_id: r.score for r in passed.collect()}
    assert all(direct[r.doc_id] == pytest.approx(r.score) for r in rows)
    kept = quality.score_documents(docs, model, least=quality.ACCEPT).count()
    assert kept == sum(r.score >= quality.ACCEPT for r in rows)


def test_partial_sums_give_the_direct_solution(spark, make_docs, labelled):
    texts, labels = labelled
    stats = quality.document_statistics(make_docs(texts))
    model = quality.train(stats, labels)
    rows = {r.doc_id: r.stats for r in stats.collect()}
    y = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None and r.doc_id in rows}
    z = quality.fourier(np.array([rows[i] for i in y]), model)
    a = z.T @ z + np.diag([quality.RIDGE * len(y)] * quality.FOURIER + [1e-9])
    want = z @ np.linalg.solve(a, z.T @ np.array(list(y.values()), float))
    assert np.abs(model.raw(np.array([rows[i] for i in y])) - want).max() < 1e-6


def test_without_labels(spark, make_docs):
    docs = make_docs([(1, "a b"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int")
    stats = quality.document_statistics(docs)
    assert {r.score for r in quality.score_statistics(stats, quality.train(stats, none)).collect()} == {0.5}
    assert quality.document_statistics(make_docs([])).count() == 0


def test_isotonic():
    x, y = quality.isotonic(np.array([0.0, 1, 2, 3]), np.array([0.0, 0.8, 0.4, 1]), np.array([1.0, 1, 3, 2]))
    assert x.tolist() == [0, 1.75, 3] and y.tolist() == [0, 0.5, 1]


# ------------------------------------------------------------------ language


def sentences(seed, lang, n):
    known = {"en": "the house and water is cold by of with", "de": "das haus und wasser ist kalt bei von mit", "fr": "la maison et eau est froide par des avec"}[lang]
    rng = random.Random(seed)
    return " ".join(rng.choice(known.split()) for _ in range(n))


def test_languages(spark, make_docs):
    langs = ["en", "de", "fr"]
    rows = [(i, sentences(i, langs[i % 3], 8), langs[i % 3]) for i in range(150)] + [(900, None, "en"), (901, "nobody", None)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ("de", "en", "fr")
    pairs = [(i, sentences(1000 + i, langs[i % 3], 1 + i % 9)) for i in range(60)]
    pairs += [(100, None), (101, ""), (102, "12 !? ²"), (103, "WASSERHAUS"), (None, "und"), (104, "the " * 50_000), (105, "東京")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(make_docs(pairs), model).collect()}
    assert np.mean([got[i][0] == langs[i % 3] for i in range(60)]) > 0.95
    assert got[100] == got[101] == got[102] == ("und", 0.0)
    assert got[103][0] == "de" and got[104][0] == "en" and got[105][0] in langs
    assert all(0 <= s <= 1 for _, s in got.values())
    assert language.predict(make_docs([]), model).count() == 0


def test_small_languages_are_learned_beside_a_large_one(spark):
    rows = [(i, sentences(i, "en", 8), "en") for i in range(400)] + [(1000 + i, sentences(i, "fr", 8), "fr") for i in range(2)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = {w for i, t, _ in rows if i >= 1000 for w in t.split()}
    model = language.train(labelled, train_docs=20)
    assert model.languages == ("en", "fr") and learned <= set(model.words)
    model = language.train(labelled, model_words=9, model_grams=1000)
    assert learned <= set(model.words)


def test_ties_fill_the_room_that_is_left(spark):
    rows = [("en", f"w{i}", 2 + (i < 10)) for i in range(1000)] + [("fr", "w7", 1), ("fr", "x", 1)]
    got = language._frequent(spark.createDataFrame(rows, "lang string, unit string, count long"), 300)
    kept = {u for lang, u, _ in got if lang == "en"}
    assert {f"w{i}" for i in range(10)} <= kept and 200 < len(kept) < 400
    assert ("fr", "w7", 1) in got and ("fr", "x", 1) in got


def test_nothing_learned(spark, make_docs):
    model = language.train(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert [tuple(r) for r in language.predict(make_docs([(1, "abc")]), model).collect()] == [(1, "und", 0.0)]


def test_backoff_takes_the_longest_known_grams():
    model = language.build([("a", "xy", 3), ("b", "zz", 3)], [("a", " x", 3), ("a", "x", 3), ("b", "z", 3), ("b", "zz", 3), ("b", " zz ", 9)])
    scorer = language.Scorer(model)
    assert scorer.predict(["xq"])[0] == "a" and scorer.predict(["qz"])[0] == "b"
    assert np.array_equal(scorer._backoff("xq"), model.logs[model.grams[" x"]])
    assert scorer.predict(["qq"]) == ("a", 0.5)  # nothing known: the language that sorts first


# ------------------------------------------------------------------ token files


@pytest.mark.parametrize("most", [1, 255, 256, 49_407, 2**24 + 5, 2**32 - 1])
def test_codes_round_trip(tmp_path, most):
    rng = np.random.default_rng(most % 1000)
    ids = rng.integers(0, most + 1, 3000, dtype=np.uint64).astype(np.uint32)
    ids[:3] = [0, most, 0]
    path = tmp_path / "x.dac"
    path.write_bytes(token_codes.file_bytes(np.array([4, 7]), np.array([0, 1000, 3000]), ids))
    with path.open("rb") as f:
        opened = token_codes.TokenFile(f)
        assert np.array_equal(opened.tokens(), ids)
        assert [opened.token(i) for i in (0, 1, 511, 512, 513, 2999)] == ids[[0, 1, 511, 512, 513, 2999]].tolist()
        assert [x.tolist() for x in opened.documents()] == [[4, 7], [0, 1000, 3000]]
        with pytest.raises(IndexError):
            opened.token(3000)


def test_code_of_nothing(tmp_path):
    path = tmp_path / "x.dac"
    path.write_bytes(token_codes.file_bytes(np.zeros(0), np.zeros(1), np.zeros(0, np.uint32)))
    with path.open("rb") as f:
        assert len(token_codes.TokenFile(f).tokens()) == 0


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(token_codes.TOKENIZER))


@pytest.mark.parametrize("file_tokens", [token_codes.FILE_TOKENS, 50])
def test_files_hold_what_the_tokenizer_says(spark, make_docs, odd_pairs, tokenizer, tmp_path, file_tokens):
    pairs = odd_pairs + [(50, "don't <|endoftext|> 'S it''ll\x0bİSTANBUL é ́x  y\x85z 12x3"), (51, "\x01\x02")]
    manifest = token_codes.write_token_files(make_docs(pairs), str(tmp_path / "out"), file_tokens=file_tokens)
    got = [tuple(r) for r in token_codes.read_digests(manifest).orderBy("start").collect()]
    named = sorted(((i, t or "") for i, t in pairs if i is not None))
    want, every = [], []
    for i, t in named:
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [2]
        want.append((i, len(every), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        every += ids
    assert got == want
    files = manifest.collect()
    assert sum(f.n_tokens for f in files) == len(every) and sum(f.n_docs for f in files) == len(named)
    assert len({f.file for f in files}) == len(files)
    assert [token_codes.random_token(manifest, i) for i in (0, 7, len(every) - 1)] == [every[0], every[7], every[-1]]


def test_forgetting_changes_nothing(tokenizer):
    small = token_codes.WordEncoder(tokenizer.to_str(), known_words=20)
    for seed in range(30):
        words = prose(seed, 40).encode().split() + ([b"a\x01b"] if seed % 5 == 0 else [])
        ids, counts = small.encode(words)
        each = [tokenizer.encode(w.decode(), add_special_tokens=False).ids for w in words]
        assert counts.tolist() == [len(x) for x in each] and ids.tolist() == [i for x in each for i in x]


def test_pieces_of_words_are_those_of_whole_texts(tokenizer):
    marked = ["river, canal. don't 'tis it''ll we're' x's,y a<|endoftext|>b, (AB) 12,3 ab'c ab''s,", "İst. İ Zoë, né… né, 東京, ﬁn Å ́a \u0130x a\x85b"]
    encoder = token_codes.WordEncoder(tokenizer.to_str(), known_words=30)
    for seed in range(20):
        texts = [t.encode() for t in (*marked, prose(seed, 30), "", prose(seed, 20) + " Ünder, " + prose(seed, 5))]
        data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
        ids, lengths = token_codes.encode_texts(encoder, data, offsets, 2)
        want = [tokenizer.encode(t.decode(), add_special_tokens=False).ids + [2] for t in texts]
        assert lengths.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


def test_what_a_worker_holds_is_bounded(tokenizer):
    """long words were all remembered, up to a million of any length."""
    import tracemalloc

    import pyarrow as pa

    encoder = token_codes.WordEncoder(tokenizer.to_str())
    tracemalloc.start()
    before = pa.total_allocated_bytes()
    for k in range(30):
        encoder.encode([prose(100 * k + i, 400).replace(" ", "").encode() for i in range(40)])
    held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert held < 500_000


def test_words_of_letters_are_encoded_once_with_nothing_between(tokenizer):
    """the tokenizer was given a mark for each distinct word, and a word anew for each mark behind it."""
    given = []

    class Counting:
        def __getattr__(self, name):
            return getattr(tokenizer, name)

        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return tokenizer.encode_batch_fast(texts, **options)

    encoder = token_codes.WordEncoder(tokenizer.to_str())
    encoder.tokenizer = Counting()
    words = sorted({a + b for a in prose(1, 200).split() for b in prose(2, 200).split() if (a + b).isalpha()})
    data = " ".join(w + end for w in words for end in ("", ",", ".")).encode()
    token_codes.encode_texts(encoder, np.frombuffer(data, np.uint8), np.array([0, len(data)]), 2)
    assert sum(map(len, given)) < 1.1 * sum(len(w) + 1 for w in words)


def test_no_files(make_docs, tmp_path):
    manifest = token_codes.write_token_files(make_docs([]), str(tmp_path / "none"))
    assert manifest.count() == 0 and token_codes.read_digests(manifest).count() == 0
