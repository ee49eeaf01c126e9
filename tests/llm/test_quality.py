"""Expectation-maximisation on known accuracies, and agreement with the labels table, which training never sees."""

import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import TESTDATA
from llm_fixtures import SCHEMA, nothing, odd, odd_rows, prose, rows_from  # noqa: F401
from pyspark.sql import functions as F

from strata.llm import arrays, quality


def test_em_recovers_accuracies_without_gold_labels():
    rng = np.random.default_rng(1)
    n, m = 40_000, len(quality.LABELLERS)
    good = rng.random(n) < 0.8
    objects = np.linspace(0.5, 0.9, m)  # P(bad vote | bad)
    approves = np.linspace(0.6, 0.95, m)  # P(good vote | good)
    draw = rng.random((n, m))
    votes = np.where(good[:, None], np.where(draw < approves, 1, np.where(draw < approves + 0.03, 2, 0)), np.where(draw < objects, 2, np.where(draw < objects + 0.05, 1, 0)))
    patterns, counts = np.unique(quality.pattern(votes), return_counts=True)
    prior, table, posterior = quality.expectation_maximisation(patterns, counts.astype(float))
    assert abs(prior - 0.8) < 0.01
    assert np.abs(table[:, 0, 2] - objects).max() < 0.03
    assert np.abs(table[:, 1, 1] - approves).max() < 0.03
    where = np.searchsorted(patterns, quality.pattern(votes))
    assert ((posterior[where] > 0.5) == good).mean() > 0.99


def test_patterns_round_trip():
    rng = np.random.default_rng(2)
    v = rng.integers(0, 3, (200, len(quality.LABELLERS)))
    assert (quality.unpacked(quality.pattern(v)) == v).all()


def measured(text):
    data, at = arrays.texts(pa.array([text]))
    return {k: float(x[0]) for k, x in quality.measures(quality.Tokens(data, at)).items()}


def test_measures_by_hand():
    m = measured("One one TWO | x9# done!")
    assert m["tokens"] == 6
    assert m["repeat_share"] == pytest.approx(1 / 6)
    assert m["separator_share"] == pytest.approx(1 / 6)
    assert m["exclamation_share"] == pytest.approx(1 / 6)
    assert m["symbol_share"] == pytest.approx(2 / 18)
    assert m["capital_share"] == pytest.approx(4 / 14)
    assert m["plain_share"] == pytest.approx(4 / 6)


def test_scores_do_not_depend_on_the_batch():
    rng = random.Random(3)
    texts = [prose(rng, 50), "A A A A", None, "", "$$$ ### x"]
    w = np.random.default_rng(0).normal(size=quality.DIMENSIONS + 1)
    post = np.linspace(0, 1, quality.PATTERNS)
    score, weak, votes = quality._judged(pa.array(texts), post, w)
    for i, t in enumerate(texts):
        s, p, v = quality._judged(pa.array([t], pa.string()), post, w)
        assert s[0] == pytest.approx(score[i]) and p[0] == weak[i] and (v[0] == votes[i]).all()


def test_agrees_with_the_labels(spark):
    root = TESTDATA / "sf0.1"
    docs, labels = (spark.read.parquet(f"{root}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.op1_quality_classifier(docs).join(labels, "doc_id").select("quality", "kept").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) >= 0.999
    assert 1 - np.mean(bad) >= 0.97


def test_the_sample_is_bounded(spark):
    texts = [prose(random.Random(k), 20) for k in range(400)]
    docs = spark.createDataFrame(rows_from(texts), SCHEMA)
    assert (quality.train(docs, train_docs=40).weights != 0).any()


def test_odd_rows_and_an_empty_table(spark, odd, nothing):
    rows = quality.op1_quality_classifier(odd).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r.score <= 1 for r in rows)
    by_id = [r.score for r in rows if r.doc_id == 6]
    assert len(by_id) == 2 and by_id[0] == by_id[1]
    assert quality.good_documents(odd).schema == odd.schema
    assert quality.op1_quality_classifier(nothing).count() == 0 == quality.good_documents(nothing).count()


# An independent version of the whole query: plain Python over single texts.

MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15 | 1


def mixed(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def hashed(b):
    code = [mixed((v + 1 + 1000) * BASE & MASK) for v in b]
    return mixed((sum(c * pow(BASE, k, 1 << 64) for k, c in enumerate(code)) + len(b) * 0xD6E8FEB86659FD93) & MASK)


def plain_measures(text):
    raw = text.encode()
    tokens = raw.split()  # bytes.split cuts at the six ASCII white-space bytes
    letter = lambda c: 65 <= c <= 90 or 97 <= c <= 122 or c >= 128
    solid = [c for c in raw if c not in b" \t\n\x0b\x0c\r"]
    letters, capitals = sum(map(letter, raw)), sum(65 <= c <= 90 for c in raw)
    n = max(len(tokens), 1)
    lower = [t.lower() for t in tokens]
    symbols = sum(not letter(c) and not 48 <= c <= 57 and c not in b".,;:'\"-()?!" for c in solid)
    return {
        "tokens": len(tokens),
        "letter_share": letters / max(len(solid), 1),
        "symbol_share": symbols / max(len(solid), 1),
        "capital_share": capitals / max(letters, 1),
        "repeat_share": sum(a == b for a, b in zip(lower, lower[1:])) / n,
        "separator_share": sum(not any(map(letter, t)) for t in tokens) / n,
        "exclamation_share": sum(t.endswith(b"!") for t in tokens) / n,
        "distinct_share": len(set(lower)) / n * (max(len(tokens), 100) / 100) ** 0.5,
        "plain_share": sum(0 < sum(map(letter, t)) >= len(t) - 1 for t in tokens) / n,
    }


def plain_votes(m):
    short, few = m["tokens"] < 30, m["repeat_share"] * m["tokens"] <= max(1, 0.05 * m["tokens"])
    said = {
        "symbols": 2 * (m["symbol_share"] >= 0.10),
        "capitals": 2 * (m["capital_share"] >= 0.50 and m["tokens"] >= 5),
        "repeats": 2 * (m["repeat_share"] >= 0.20),
        "separators": 2 * (m["separator_share"] >= 0.10),
        "exclamations": 2 * (m["exclamation_share"] >= 0.20),
        "empty": 2 * (m["tokens"] < 2),
        "variety": 2 if m["distinct_share"] < 0.20 else int(m["distinct_share"] >= 0.45 and few),
        "prose": 2 if m["plain_share"] < 0.40 and not short else int(m["plain_share"] >= (0.45 if short else 0.85) and few),
        "letters": 2 if m["letter_share"] < 0.50 and not short else int(m["letter_share"] >= (0.35 if short else 0.90) and m["capital_share"] <= 0.30 and few),
    }
    if not m["tokens"]:
        said = {k: v if k == "empty" else 0 for k, v in said.items()}
    return tuple(said.values())


def plain_posteriors(votes):
    """Expectation-maximisation over single documents instead of counted patterns."""
    p = [0.1 if 2 in v else 0.9 for v in votes]
    for _ in range(200):
        log = []
        for k in (0, 1):
            mass = [x if k else 1 - x for x in p]
            total = sum(mass)
            table = [[(sum(x for x, v in zip(mass, votes) if v[j] == said) + 1) / (total + 3) for said in range(3)] for j in range(9)]
            prior = (total + 1) / (len(votes) + 2)
            log.append([np.log(prior) + sum(np.log(table[j][v[j]]) for j in range(9)) for v in votes])
        new = [1 / (1 + np.exp(a - b)) for a, b in zip(*log)]
        if max(abs(a - b) for a, b in zip(new, p)) < 1e-9:
            break
        p = new
    return p


def plain_features(text, m):
    shape = lambda c: 65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 57 if 48 <= c <= 57 else c
    tokens = text.encode().split()
    names = []
    shapes = []
    for t in tokens:
        s = [shape(c) for c in t]
        shapes.append(hashed(bytes(c for k, c in enumerate(s) if k == 0 or s[k - 1] != c)))
    names += [mixed(h) >> 52 for h in shapes]
    names += [mixed(mixed((a * BASE + b) & MASK)) >> 52 for a, b in zip(shapes, shapes[1:])]
    names += [mixed(0xA11CE) >> 52] * sum(a.lower() == b.lower() for a, b in zip(tokens, tokens[1:]))
    value = {d: np.log1p(names.count(d)) for d in set(names)}
    norm = sum(v * v for v in value.values()) ** 0.5
    out = [(d, v / norm) for d, v in value.items()]
    flags = (int(10 * m["repeat_share"]), int(10 * min(m["distinct_share"], 1)), int(np.log2(len(tokens) + 1)))
    return out + [(mixed(x + 1000 * (k + 1)) >> 52, 0.5) for k, x in enumerate(flags)]


def test_equals_a_plain_version(spark):
    rng = random.Random(31)
    texts = [r["text"] for r in spark.read.parquet(str(TESTDATA / "sf0.001" / "documents.parquet")).select("text").collect() if len(r["text"]) < 4000]
    texts += ["", None, "!!! *** !!!", "BUY NOW " * 30, prose(rng, 25), prose(rng, 200), "a " * 80, "x"]
    measured_ = [plain_measures(t or "") for t in texts]
    votes = [plain_votes(m) for m in measured_]
    weak = plain_posteriors(votes)
    dense = np.zeros((len(texts), quality.DIMENSIONS))
    for i, (t, m) in enumerate(zip(texts, measured_)):
        for d, v in plain_features(t or "", m):
            dense[i, d] += v
    w, bias = np.zeros(quality.DIMENSIONS), 0.0
    seen, seen_bias = np.full(quality.DIMENSIONS, 1e-8), 1e-8
    for _ in range(300):
        miss = (1 / (1 + np.exp(-(dense @ w + bias))) - weak) / len(texts)
        g, g_bias = dense.T @ miss + 1e-5 * w, miss.sum() + 1e-5 * bias
        seen, seen_bias = seen + g * g, seen_bias + g_bias * g_bias
        w, bias = w - 0.5 * g / np.sqrt(seen), bias - 0.5 * g_bias / np.sqrt(seen_bias)
    score = 1 / (1 + np.exp(-(dense @ w + bias)))
    rows = {r.doc_id: r for r in quality.op1_quality_classifier(spark.createDataFrame(rows_from(texts), SCHEMA).repartition(3)).collect()}
    assert len(rows) == len(texts)
    assert max(abs(rows[k].weak_label - weak[k]) for k in rows) < 1e-6
    assert max(abs(rows[k].score - score[k]) for k in rows) < 1e-4
    assert all(rows[k].kept == (score[k] >= 0.5) for k in rows if abs(score[k] - 0.5) > 1e-4)


def test_the_bounded_sample_does_not_depend_on_partitions(spark):
    """Equal rows beyond the bound: what is learned from is the same however the rows are dealt."""
    rng = random.Random(32)
    texts = [prose(rng, 40) for _ in range(60)] + ["SPAM! " * 50] * 60
    rows = rows_from(texts)
    df = spark.createDataFrame(rows, SCHEMA)
    same = [quality.train(df.repartition(n), train_docs=10).weights for n in (1, 5)] + [quality.train(df.orderBy(F.desc("doc_id")).coalesce(2), train_docs=10).weights]
    assert all(np.allclose(same[0], x, atol=1e-9) for x in same[1:])
