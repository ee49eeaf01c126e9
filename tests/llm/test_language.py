"""Code lengths against a plain PPM, and accuracy on the held-out fold."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import pyarrow as pa
from conftest import TESTDATA
from llm_fixtures import SCHEMA, nothing, odd, odd_rows, prose, rows_from  # noqa: F401

from strata.llm import arrays, language


class PlainPPM:
    """Escape method C with exclusion, over byte contexts of length 3 to 0."""

    def __init__(self, texts):
        self.counts = defaultdict(Counter)
        for t in texts:
            b = b"\0\0\0" + t
            for i in range(3, len(b)):
                for k in range(4):
                    self.counts[b[i - k : i]][b[i]] += 1

    def distribution(self, context):
        p = [1 / 256] * 256
        for k in range(len(context) + 1):
            seen = self.counts.get(context[len(context) - k :])
            if not seen:
                continue
            total, kinds = sum(seen.values()), len(seen) if len(seen) < 256 else 0
            rest = sum(x for b, x in enumerate(p) if b not in seen)
            p = [seen[b] / (total + kinds) if b in seen else kinds / (total + kinds) * p[b] / rest for b in range(256)]
        return p

    def bits(self, text):
        b = b"\0\0\0" + text
        return -sum(math.log2(self.distribution(b[i - 3 : i])[b[i]]) for i in range(3, len(b)))


def counts_of(texts):
    data, at = arrays.texts(pa.array(texts))
    u, n = np.unique(language.grams(data, at), return_counts=True)
    return u, n.astype(float)


def test_code_lengths_are_those_of_the_context_trees():
    rng = random.Random(1)
    train = {"a": [prose(rng, 40) for _ in range(4)], "b": [prose(rng, 30, ["ça", "été", "où", "naïf"]) for _ in range(3)], "c": ["\x00\x00x"]}
    model = language.Model({k: counts_of(v) for k, v in train.items()})
    texts = [prose(rng, 10), "été où", "", "zzz \U0001f600 qqq", "\x00\x00\x00", "a"]
    data, at = arrays.texts(pa.array(texts))
    got = model.code_lengths(data, at)
    for j, lang in enumerate(model.languages):
        plain = PlainPPM([t.encode() for t in train[lang]])
        for i, t in enumerate(texts):
            assert abs(got[i, j] - plain.bits(t.encode())) < 1e-3 * (1 + len(t)), (lang, t)
        for context in (b"\0\0\0", b"alp", b"xyz", b" be"):
            assert abs(sum(plain.distribution(context)) - 1) < 1e-9


@pytest.mark.parametrize("text, letter", [("\u00bd", False), ("\u00b2", False), ("\u2167", False), ("12 _ 3", False), ("\u0301", False), ("\U0001f600", False), ("\u00aa", True), ("\u02b0", True), ("\u8a9e", True), ("\u00bd x", True), ("\u00e9", True)])
def test_what_a_letter_is(spark, text, letter):
    """A character of the categories L; a fraction, a superscript, a Roman numeral sign or a mark is none."""
    import unicodedata

    assert any(unicodedata.category(c).startswith("L") for c in text) == letter
    assert language.has_letter(text.encode()) == letter


def test_texts_without_letters_are_undetermined(spark):
    texts = ["the cat and the dog"] * 9 + ["\u00bd \u00b2", "\u2167", "\u00e9t\u00e9"]
    got = {r.doc_id: r.lang_pred for r in language.op4_language_id(spark.createDataFrame(rows_from(texts), SCHEMA)).collect()}
    assert (got[9], got[10], got[11]) == ("und", "und", "en")


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(str(TESTDATA / "sf0.01" / "documents.parquet"))
    rows = language.op4_language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert len(held) > 150 and np.mean([r.lang_pred == r.lang for r in held]) >= 0.99
    assert all(0 <= r.score <= 1 for r in rows)


def test_lang_and_doc_id_are_not_inputs_of_a_prediction(spark):
    docs = spark.read.parquet(str(TESTDATA / "sf0.001" / "documents.parquet"))
    model = language.train(docs.where(language.fold() != 0))
    a = language.predict(docs, model).orderBy("doc_id").select("lang_pred", "score").collect()
    hidden = docs.selectExpr("-doc_id AS doc_id", "text", "CAST(NULL AS STRING) AS lang")
    b = language.predict(hidden, model).orderBy("doc_id").select("lang_pred", "score").collect()
    assert a == b[::-1]


def test_odd_rows_and_empty_tables(spark, odd, nothing):
    rows = language.op4_language_id(odd).collect()
    assert len(rows) == len(odd_rows())
    by_id = {r.doc_id: r for r in rows}
    for doc in (1, 2, 3, 4):
        assert (by_id[doc].lang_pred, by_id[doc].score) == ("und", 0.0)
    assert by_id[10].lang_pred in ("en", "de", "fr") and not by_id[None].held_out
    assert language.op4_language_id(nothing).count() == 0
    unlabelled = odd.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert {r.lang_pred for r in language.op4_language_id(unlabelled).collect()} == {"und"}


def test_no_counted_context_is_left_out(spark):
    rng = random.Random(4)
    signs = "".join(map(chr, range(33, 127)))
    texts = ["".join(rng.choices(signs, k=5000)) for _ in range(50)]
    docs = spark.createDataFrame([*rows_from(texts), (99, "été où", "fr", "s", 6)], SCHEMA)
    u, n = counts_of(texts)
    assert len(u) > 200_000
    blocks = language.Blocks(docs)
    grams, counts = language._by_language(blocks.counts)["en"]
    assert dict(zip(grams.tolist(), counts)) == dict(zip(u.tolist(), n))
    [model] = list(blocks)
    assert set(model.u4.tolist()) == set(u.tolist()) | set(counts_of(["été où"])[0].tolist())


def test_blocks_of_the_tree_give_what_the_whole_tree_gives(spark, odd):
    docs = spark.read.parquet(str(TESTDATA / "sf0.001" / "documents.parquet"))
    docs = docs.unionByName(odd.select(*docs.columns))
    assert len(language.Blocks(docs, 30_000).spans) > 3

    def rows(**kw):
        return sorted((repr(r.doc_id), r.held_out, r.lang_pred, round(r.score, 6), r.bits_per_byte and round(r.bits_per_byte, 6)) for r in language.op4_language_id(docs, **kw).collect())

    assert rows(block_cells=30_000) == rows()
