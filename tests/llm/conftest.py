import pytest
from tests_llm_brute import prose

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "score double, size string, target string, copies long, base string, spans string, items string, bucket int, kind int, links int"
)
EXTRA = (0.5, "s", "t", 7, "b", "p", "i", 3, 4, 5)
@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents of (doc_id, text) pairs, with the other columns of the table and some that clash with results."""

    def make(pairs):
        rows = [(i, t, ["en", "de", None][k % 3], ["s1", "s0", None][k % 3], len(t or ""), *EXTRA) for k, (i, t) in enumerate(pairs)]
        return spark.createDataFrame(rows, SCHEMA).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_pairs():
    """Null, empty and blank texts, null and repeated ids, repeated texts, a very long one, characters of all widths."""
    shared = prose(1, 60)
    return [
        (5, shared),
        (3, shared),
        (3, shared),
        (9, prose(2, 30) + " " + shared),
        (None, shared),
        (None, None),
        (7, None),
        (8, ""),
        (10, " \t\n\x0b\x0c\r "),
        (11, prose(3, 20_000)),
        (12, "é ü 東京 𝒳𝒴 word word ßtraße"),
        (13, "x"),
        (14, shared + " end"),
        (15, shared.replace("river", "canal", 1)),
        (16, "\x01 a\x01b \x01"),
        (-4, prose(4, 12)),
    ]
