"""Passages inside lines, against a brute-force pass over all windows of words in order."""

import random
import re

import corpus_pipeline
import numpy as np
import pytest
from llm_fixtures import SCHEMA, nothing, odd, prose, rows_from  # noqa: F401

from strata.llm import passages

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(rows, n):
    """rows: (doc_id, text). What is left of each."""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        places = [m.span() for m in WORD.finditer(lower)]
        words, gone = [lower[s:e] for s, e in places], set()
        for i in range(len(words) - n + 1):
            w = tuple(words[i : i + n])
            if w in seen:
                gone.update(range(i, i + n))
            seen.add(w)
        kept, at = [], 0
        for i in sorted(gone):
            if i - 1 not in gone:
                kept.append(text[at : places[i][0]])
            at = places[i][1]
        out[doc] = None if text is None else "".join([*kept, text[at:]])
    return out


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("n", [6, 7])
def test_equals_brute_force(spark, seed, n):
    rng = random.Random(seed)
    pool = [prose(rng, k) for k in (3, 5, 6, 9, 15)] + ["Été, NAÏF; x", "same same"]
    rows = [(k, rng.choice([" ", "\n", " - "]).join(rng.choice(pool) for _ in range(rng.randint(0, 6)))) for k in range(40)]
    rows += [(100, None), (101, " ".join(["same"] * 60)), (None, pool[4] + "!")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute(rows, n)
    assert {r.doc_id: r.text for r in passages.cut_passages(df, n).collect()} == want
    assert want != dict(rows)


def test_smallest_is_the_first_of_equals():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 26):
        h = rng.integers(0, 5, 80).astype(np.uint64)
        assert passages.smallest(h, n).tolist() == [i + int(h[i : i + n].argmin()) for i in range(80 - n + 1)]


def test_the_pipeline_cuts_a_passage_inside_lines(spark, tmp_path):
    rng = random.Random(7)
    vocabulary = [f"word{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}" for k in range(600)]
    passage = prose(rng, 70, vocabulary)
    texts = [prose(rng, 150, vocabulary) + " " + passage + " " + prose(rng, 150, vocabulary) for _ in range(3)]
    docs = spark.createDataFrame(rows_from(texts), SCHEMA)
    spark.createDataFrame([(1, "none of these words")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
    rows = {r.doc_id: r for r in docs.collect()}
    assert rows[0].text == texts[0] and not any(passage in rows[k].text for k in (1, 2))
    assert {k: r.text for k, r in rows.items()} == brute(list(enumerate(texts)), passages.WORDS)
    assert all(r.n_chars == len(r.text) for r in rows.values())


def test_odd_rows_and_an_empty_table(spark, odd, nothing):
    out = passages.cut_passages(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    # Two rows are one document, and a later one has its text; the others share no passage but the long one with itself.
    assert {r.doc_id: r.text for r in out.where("doc_id IN (6, 7)").collect()}[7] == ""
    assert passages.cut_passages(nothing).count() == 0
