import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import TESTDATA, duck, rows_of, sorted_rows
from llm_fixtures import SCHEMA, nothing, odd, odd_rows, prose, rows_from  # noqa: F401

from strata.llm import arrays, fill_middle
from strata.llm.session import documents

UNIT = re.compile(r"[^\n]*\n|[^\n]+")


def by_hand(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 50 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return n, form, len(p), len(m), out


def texts(rng):
    """Texts with shared passages, many kinds of line ends, and sentinels whole, broken and across chunks."""
    shared = [prose(rng, 300).replace(" ", "\n", 40) for _ in range(3)]
    out = ["", "\n", "\n\n\n", "a", "a\n", "\na", "é\n\U0001f600\r\nz", "<P", "P>", "<P>", "x<S>y", "<<M>>", "<\nM>", "<X>"]
    out += ["\n" * 9000, "a" * 9000, "ab\n" * 5000, ("z" * 4095) + "<P>" + "z" * 50, ("z" * 4094) + "<P>", ("z" * 4096) + "<M>\n"]
    for k in range(200):
        parts = [rng.choice(shared) if rng.random() < 0.4 else prose(rng, rng.randrange(1, 60)) for _ in range(rng.randrange(1, 5))]
        t = rng.choice(["\n", "\n\n", " "]).join(parts) + rng.choice(["", "\n"])
        if k % 10 == 0:
            at = rng.randrange(len(t))
            t = t[:at] + rng.choice(["<P>", "<S>", "<M>"]) + t[at:]
        out.append(t)
    return out


@pytest.mark.parametrize("slots,limit", [(17, 16 << 20), (4, 1 << 12)])  # the small cache collides and starts anew
def test_lines_of_chunks_equal_the_pattern(slots, limit):
    given = texts(random.Random(1))
    cache = fill_middle.ChunkCache(slots, limit)
    for _ in range(2):
        for lo, hi, data, at in arrays.chunks(pa.array(given), 1 << 14):
            lines = fill_middle.Lines(data, at, cache)
            for i, t in enumerate(given[lo:hi]):
                units = UNIT.findall(t)
                assert lines.count[i] == len(units) and lines.length[i] == len(t)
                assert lines.marked[i] == any(x in t for x in ("<P>", "<S>", "<M>"))
            for k in (0, 1, 2, 7, 10**9):
                in_bytes, in_chars = lines.cut(np.minimum(k, lines.count))
                for i, t in enumerate(given[lo:hi]):
                    head = "".join(UNIT.findall(t)[:k])
                    assert (in_bytes[i], in_chars[i]) == (len(head.encode()), len(head))


def test_shared_passages_are_shared_chunks():
    rng = random.Random(5)
    passage = prose(rng, 4000)
    data, at = arrays.texts(pa.array([passage, "x y z " + passage + " end"]))
    cache = fill_middle.ChunkCache()
    ends = fill_middle.chunk_ends(data, at)
    starts = np.concatenate([[0], ends[:-1]])
    chunks = [data[s:e].tobytes() for s, e in zip(starts, ends)]
    first = [c for c, e in zip(chunks, ends) if e <= at[1]]
    second = {c for c, e in zip(chunks, ends) if e > at[1]}
    assert len(first) > 20 and sum(c in second for c in first) >= len(first) - 3
    fill_middle.Lines(data, at, cache)
    fill_middle.Lines(data, at, cache)
    assert cache.hits > cache.misses


def test_equal_hashes_of_different_chunks_are_told_apart():
    a, b = b"one\ntwo\nthree", b"one two three"
    data = np.frombuffer(a + b, dtype=np.uint8)
    start, end = np.array([0, len(a)]), np.array([len(a), len(a) + len(b)])
    s = fill_middle.ChunkCache().summaries(data, start, end, h=np.array([77, 77], dtype=np.uint64))
    assert s["lines"].tolist() == [2, 0]
    again = fill_middle.ChunkCache()
    again.summaries(data, start[:1], end[:1], h=np.array([77], dtype=np.uint64))
    assert again.summaries(data, start[1:], end[1:], h=np.array([77], dtype=np.uint64))["lines"].tolist() == [0]


def test_equals_the_definition_and_restores(spark):
    given = texts(random.Random(2))
    docs = spark.createDataFrame(rows_from(given), SCHEMA).repartition(3)
    made = fill_middle.fill_in_middle(docs)
    got = made.withColumn("back", fill_middle.restore(made["output"], made["form"])).collect()
    assert len(got) == len(given)
    forms = set()
    for r in got:
        forms.add(r["form"])
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == by_hand(r["doc_id"], given[r["doc_id"]])
        assert r["back"] == given[r["doc_id"]]
    assert forms == {"plain", "psm", "spm"}


def test_odd_rows(odd):
    got = fill_middle.op11_fill_in_middle(odd)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for doc_id, text, *_ in odd_rows():
        n, form, p, m, out = by_hand(doc_id, text)
        want.append((doc_id, n, form, p, m, sha(out), sha(text or "")))
    assert rows_of(got) == sorted_rows(want)


def test_rate_and_share(spark):
    docs = spark.createDataFrame(rows_from([f"{k}\nb\nc" for k in range(400)]), SCHEMA)
    assert {r["form"] for r in fill_middle.fill_in_middle(docs, rate=0).collect()} == {"plain"}
    assert {r["form"] for r in fill_middle.fill_in_middle(docs, spm=100).collect()} == {"spm"}
    assert 100 < fill_middle.fill_in_middle(docs, rate=50).where("form = 'plain'").count() < 300


def test_empty_table(nothing):
    assert fill_middle.op11_fill_in_middle(nothing).collect() == []


def test_sql_agrees(spark):
    d = str(TESTDATA / "sf0.001")
    got = fill_middle.op11_fill_in_middle(documents(spark, d))
    assert rows_of(got.select(sorted(got.columns))) == sorted_rows(
        duck(d).sql(f"SELECT {', '.join(sorted(got.columns))} FROM ({fill_middle.ORACLE_SQL})").fetchall()
    )
