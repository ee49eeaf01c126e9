"""Words, lines and hashes over byte buffers against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import arrays

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_text = st.one_of(st.none(), st.text(alphabet="aB z9é€\n\t.- 😀_", max_size=40))


def lower(t: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


@settings(max_examples=150, deadline=None)
@given(st.lists(_text, max_size=8), st.integers(1, 60))
def test_words_are_those_of_the_pattern(texts, limit):
    column = pa.array(texts, pa.string())
    got, seen = [], 0
    for lo, hi, data, at in arrays.chunks(column, limit):
        assert lo == seen
        seen = hi
        w = arrays.Words(data, at)
        for d in range(hi - lo):
            got.append([w.text(i).decode() for i in range(w.first[d], w.first[d + 1])])
    assert got == [WORD.findall(lower(t or "")) for t in texts]


def test_a_sliced_column_reads_its_own_rows():
    column = pa.array(["zero", None, "two two", "", "four"]).slice(1, 3)
    data, at = arrays.texts(column)
    assert data.tobytes() == b"two two" and at.tolist() == [0, 0, 7, 7]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(min_size=0, max_size=12), min_size=1, max_size=20))
def test_a_segments_hash_depends_on_its_bytes_alone(parts):
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    starts = ends - [len(p) for p in parts]
    h = arrays.segment_hash(data, starts, ends)
    alone = [arrays.segment_hash(np.frombuffer(p, dtype=np.uint8), np.array([0]), np.array([len(p)]))[0] for p in parts]
    assert h.tolist() == alone
    assert len(set(alone)) == len(set(parts))


def test_windows_hash_alike_where_their_words_agree():
    h = np.array([5, 6, 7, 5, 6, 7, 5], dtype=np.uint64)
    r = arrays.roll(h, 3)
    assert r[0] == r[3] and r[1] == r[4] and len(set(r[:3].tolist())) == 3
    assert arrays.in_one_text(np.array([0, 0, 0, 1, 1, 1, 1]), 3).tolist() == [True, False, False, True, True]
