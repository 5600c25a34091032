import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import words as w

TEXTS = st.lists(st.text(alphabet="ab \t\n\x0b\x1c é東", max_size=30) | st.none(), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_bounds_are_those_of_the_pattern(texts, limit):
    got, rows = [], 0
    for a, b, data, offsets in w.text_slices(pa.array(texts, pa.string()), limit):
        assert a == rows and b > a
        rows = b
        starts, ends, doc = w.word_bounds(data, offsets)
        got += [(a + int(d), data[s:e].tobytes().decode()) for s, e, d in zip(starts, ends, doc)]
    assert rows == len(texts)
    assert got == [(i, x) for i, t in enumerate(texts) for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")]


def test_hashes_depend_on_the_word_only():
    texts = ["aa bb aa", "xx aa bb", "b" * 2000 + " aa", "b" * 2000]
    (_, _, data, offsets), *_ = w.text_slices(pa.array(texts))
    starts, ends, _ = w.word_bounds(data, offsets)
    h = w.word_hashes(data, starts, ends).tolist()
    assert h[0] == h[2] == h[4] == h[7] and h[1] == h[5] and h[6] == h[8] and len(set(h)) == 4
    runs = w.sequence_hashes(np.array(h, np.uint64), 2).tolist()
    assert runs[0] == runs[4] and len(set(runs)) == len(runs) - 1


def test_a_slice_of_an_array():
    part = pa.array(["zz", None, "a b", "c"]).slice(1)
    (a, b, data, offsets), *_ = w.text_slices(part)
    assert (a, b, data.tobytes(), offsets.tolist()) == (0, 3, b"a bc", [0, 0, 3, 4])
