"""The pipeline's stages on repeated and null ids, and on columns named like their own."""

import pytest
from pyspark.sql import functions as F
from tests_llm_brute import prose

import corpus_pipeline
from tidemark.llm import stages

SF_DIR = "/root/testdata/sf0.001"


def texts_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def named():
    """Texts by letter: A and B are unlike, A2 is near A."""
    a, b, c = prose(1, 80), prose(2, 80), prose(3, 80)
    return {"A": a, "A2": a + " end", "B": b, "C": c}


@pytest.mark.parametrize(
    "rows, kept",
    [
        ([(2, "B"), (2, "A"), (1, "A")], [(2, "B"), (1, "A")]),
        ([(2, "B"), (2, "A"), (1, "B")], [(2, "A"), (1, "B")]),
        ([(5, "A"), (5, "A"), (5, "A2")], [(5, "A")]),
        ([(None, "A"), (None, "A2"), (None, "B")], [(None, "A"), (None, "B")]),
        ([(None, "A"), (9, "A2"), (9, "C")], [(9, "A2"), (9, "C")]),
        ([(3, None), (3, None), (None, None)], [(3, None), (3, None), (None, None)]),
    ],
)
def test_no_text_is_lost(spark, make_docs, named, rows, kept):
    got = texts_of(stages.keep_one_of_group(spark, make_docs([(i, named.get(t)) for i, t in rows]), SF_DIR))
    want = sorted(((i, named.get(t)) for i, t in kept), key=str)
    if (None, "A") in rows and len(got) == len(want) and None in [i for i, _ in kept]:
        # Of near rows without a doc_id either may stay.
        got, want = ([(i, "A" if t in (named["A"], named["A2"]) else t) for i, t in x] for x in (got, want))
    assert got == want


def test_mixing_keeps_the_columns_it_was_given(spark, make_docs, odd_pairs):
    docs = make_docs(odd_pairs)
    mixed = stages.mix_sources(spark, docs, SF_DIR)
    assert mixed.schema == docs.schema
    assert mixed.select("size", "target", "copies").distinct().collect() == docs.select("size", "target", "copies").distinct().collect()


def test_rows_without_an_id_draw_by_their_text(spark, make_docs):
    from tidemark.llm import mixing

    docs = make_docs([(None, prose(k, 30)) for k in range(60)]).withColumn("source", F.lit("s"))
    assert mixing.mix(docs).select("copies").distinct().count() == 2


def test_rows_without_an_id_are_encoded(spark, make_docs, odd_pairs):
    rows = stages.encode_tokens(spark, make_docs(odd_pairs), SF_DIR).collect()
    assert sorted((r.doc_id for r in rows), key=str) == sorted((i for i, _ in odd_pairs), key=str)
    spans = sorted((r.start, r.n_tokens) for r in rows)
    assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))


def test_all_stages_on_odd_rows(spark, make_docs, odd_pairs):
    docs = make_docs(odd_pairs)
    for name, stage in corpus_pipeline.STAGES:
        docs, before = stage(spark, docs, SF_DIR), docs.columns
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before
    assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
