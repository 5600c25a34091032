"""The registered queries and the pipeline, beside SQL or plain versions, on a small scale factor."""

import os
import zlib

import numpy as np
import pytest
from oracle_check import compare, connect
from tests_llm_brute import brute_near

import __spark_entry__ as entry
import corpus_pipeline
from tidemark.llm import decontamination, fingerprints, mixing, pii, quality, queries, secrets

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_as_sql(spark, db, name):
    assert compare(spark, db, name, queries.QUERIES[name], queries.ORACLES[name], SF_DIR) == ""


def test_all_are_registered():
    names = set(entry.queries())
    assert {n for n in names if n.startswith("op")} >= set(queries.QUERIES) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def run(spark, name):
    return {r.doc_id: r for r in queries.QUERIES[name](spark, SF_DIR).collect()}


def test_quality(spark, docs):
    rows = run(spark, "op1_quality")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    assert rows.keys() == docs.keys()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) for i, r in rows.items())
    assert np.mean([rows[i].predicted == q for i, q in labels.items()]) > 0.9


def test_language(spark, docs):
    rows = run(spark, "op5_language")
    assert rows.keys() == docs.keys()
    held = [i for i in docs if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(rows[i].held_out == (i in held) for i in rows)
    assert np.mean([rows[i].lang_pred == docs[i].lang for i in held]) > 0.9


def test_near_duplicates(spark, docs):
    got = {i: (r.class_id, r.links, r.copy_of) for i, r in run(spark, "op3_jaccard_join").items()}
    assert got == brute_near({i: r.text for i, r in docs.items()})


@pytest.mark.parametrize("name, module", [("op2_secrets", secrets), ("op6_pii", pii)])
def test_spans(spark, docs, name, module):
    from test_llm_spans import personal_base, secret_base, sha

    base = secret_base if module is secrets else personal_base
    rows = run(spark, name)
    assert {i: r.base_sha256 for i, r in rows.items()} == {i: sha(base(r.text or "")) for i, r in docs.items()}


def test_fingerprints(spark, docs):
    from test_llm_groups import edited

    rows = run(spark, "op10_fingerprints")
    order = sorted(docs)
    texts = [docs[i].text or "" for i in order]
    from test_llm_spans import sha

    assert [rows[i].edited_sha256 for i in order] == [sha(t) for t in edited(texts)]
    assert np.mean([rows[i].near_edited > rows[i].near_next for i in order]) > 0.95


def test_token_codes(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows, at = run(spark, "op7_token_codes"), 0
    for i in sorted(docs):
        ids = tokenizer.encode(docs[i].text or "", add_special_tokens=False).ids + [2]
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_pipeline_stages(spark, make_docs, tmp_path):
    """Each stage against a plain version on what the one before kept."""
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame([(10_001, None, None, None, None), (10_002, "", "en", "zz", 0)], table.schema)
    kept, columns = table.unionByName(odd), table.columns
    for name, stage in corpus_pipeline.STAGES:
        before = kept.collect()
        result = stage(spark, kept, SF_DIR)
        path = str(tmp_path / name)
        result.write.parquet(path)
        kept = spark.read.parquet(path)
        after = kept.collect()
        ids = sorted(r.doc_id for r in after)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert kept.columns == columns
        if name == "quality_classifier":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
            assert np.mean([(i in set(ids)) == bool(q) for i, q in labels.items()]) > 0.95
        elif name == "ngram_jaccard_join":
            near = brute_near({r.doc_id: r.text for r in before})
            assert ids == sorted(i for i in near if near[i][0] == i)
        elif name == "benchmark_decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
            grams = set(decontamination.windows(items))
            assert all(len(g.split()) == 10 for g in grams)

            def clean(text):
                w = decontamination.normal_words(text)
                return not any(" ".join(w[i : i + 10]) in grams for i in range(len(w) - 9))

            assert ids == sorted(r.doc_id for r in before if clean(r.text))
        elif name == "mixing":
            copies = {r.doc_id: r.copies for r in mixing.mix(spark.createDataFrame(before, table.schema)).collect()}
            assert ids == sorted(i for i, n in copies.items() for _ in range(n))
        else:
            assert ids == sorted(r.doc_id for r in before)
            starts = sorted((r.start, r.n_tokens) for r in after)
            assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


def test_native_plans(spark):
    """No Python in the plans of the operators that must do without."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for df in (secrets.find_secrets(docs), pii.find_personal_data(docs), mixing.mix(docs), fingerprints.compare_with_edited(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_quality_constants():
    assert quality.ACCEPT == 0.3
