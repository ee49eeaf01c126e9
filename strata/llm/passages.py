"""Passage dedup: repeated windows of fifty consecutive words, removed after their first occurrence.

Where line dedup sees whole, equal lines only, this finds passages anywhere in a
text. Words are those of ``arrays.Words``; what stands between them does not
count. A window that occurs more than once anywhere keeps its first occurrence
(smallest doc_id, then earliest word); the words of any later occurrence are cut
out, from the first word to the end of the last one of each merged span.

How it scales: no window leaves a task unless something in it repeats. Of the
shorter windows (half as long) inside a window, the one with the smallest hash is
its anchor. Equal windows have equal anchors at the same place, and neighbouring
windows mostly share theirs, so one row for about thirteen words is shuffled to
find the anchors that repeat. The windows with such an anchor then travel as a
128-bit hash with their place and are grouped and joined back as in line dedup:
partial counts in the tasks, the repeated windows one row each, written down, and broadcast while
they are measured to be small; else a Bloom filter keeps most others in their tasks (``bloom.joined``), and both sides are
dealt for the join, so that AQE can
split a hot window. Only the starts of cut windows are grouped, per document. Texts
are reached the same way, so texts without a repeat mostly cross no shuffle.

Defined cases: a null text stays null and a text of fewer words than a window is
never changed; a very long text is handled whole; an empty table stays one; a null doc_id orders after all others; rows that agree in doc_id
and text are one document and share one result; other columns pass through
unchanged, whatever their names, but n_chars follows the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import arrays
from strata.llm.bloom import joined
from strata.llm.decontaminate import PAIRS, _cutter, _given
from strata.llm.session import ENTRY_BYTES, checkpointed, same_columns, ship_code

WORDS = 50


def smallest(h: np.ndarray, n: int) -> np.ndarray:
    """The place of the smallest of each n consecutive entries, the first one of equals."""
    at, size = np.arange(len(h)), 1
    while size < n and len(at):
        step = min(size, n - size)
        a, b = at[: len(at) - step], at[step:]
        at = np.where(h[b] < h[a], b, a)
        size += step
    return at


def _runs(words: int):
    """Consecutive windows with one anchor: the document, the anchor's hash, the first and last window's start."""
    short = words // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, data, at in arrays.chunks(batch["text"]):
                w = arrays.Words(data, at)
                start = np.flatnonzero(arrays.in_one_text(w.doc, words))
                if not len(start):
                    continue
                h = arrays.roll(w.hashes(), short)
                anchor = smallest(h, words - short + 1)[start]
                edge = np.flatnonzero(np.diff(anchor, prepend=-1))
                first, last = start[edge], start[np.append(edge[1:], len(start)) - 1]
                doc = w.doc[first]
                rows = pa.array(lo + doc)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].take(rows),
                        batch["k"].take(rows),
                        pa.array(arrays.signed(h[anchor[edge]]), pa.int64()),
                        pa.array(first - w.first[doc], pa.int32()),
                        pa.array(last - w.first[doc], pa.int32()),
                    ],
                    ["doc_id", "k", "a", "first", "last"],
                )

    return run


def _windows(words: int):
    """The windows of the given runs of each text: the document, the start, the window's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = batch["runs"]
            for lo, hi, data, at in arrays.chunks(batch["text"]):
                w = arrays.Words(data, at)
                mine = runs.slice(lo, hi - lo)
                doc = np.repeat(np.arange(hi - lo), mine.value_lengths().to_numpy())
                flat = mine.flatten()
                first, last = flat.field("first").to_numpy(), flat.field("last").to_numpy()
                count = last - first + 1
                doc = np.repeat(doc, count)
                start = np.repeat(first, count) + arrays.spread(count)
                place = w.first[doc] + start
                pair = [arrays.signed(arrays.roll(w.hashes(k), words)[place]) for k in (0, 1)]
                rows = pa.array(lo + doc)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].take(rows), batch["k"].take(rows), pa.array(start, pa.int32()), *(pa.array(x, pa.int64()) for x in pair)],
                    ["doc_id", "k", "start", "w1", "w2"],
                )

    return run


def _merged(words: int):
    """Windows' starts as word spans that do not touch each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
        for batch in batches:
            spans = []
            for starts in batch["starts"].to_pylist():
                x = np.sort(np.array(starts, dtype=np.int64))
                new = np.flatnonzero(np.append(True, np.diff(x) > words))
                ends = x[np.append(new[1:], len(x)) - 1] + words
                spans.append([{"s": s, "e": e} for s, e in zip(x[new].tolist(), ends.tolist())])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["k"], pa.array(spans, kind)], ["doc_id", "k", "spans"])

    return run


def repeats(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, k (hash of the text), spans (of words, merged, end exclusive): the later occurrences of repeated windows."""
    ship_code(documents.sparkSession)
    slim = documents.select("doc_id", F.xxhash64("text").alias("k"), "text")
    kind = slim.schema["doc_id"].dataType.simpleString()
    runs = slim.mapInArrow(_runs(words), f"doc_id {kind}, k long, a long, first int, last int")
    again = runs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a")
    open_ = joined(runs, again, ["a"], "inner", F.col("a"), F.col("a")).groupBy("doc_id", "k").agg(F.collect_set(F.struct("first", "last")).alias("runs"))
    open_ = open_.select(F.col("doc_id").alias("id"), F.col("k").alias("hash"), "runs")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("k") == F.col("hash"))
    hashes = F.xxhash64("doc_id", "k"), F.xxhash64("id", "hash")
    texts = joined(slim, open_, same, "inner", *hashes, ENTRY_BYTES * F.size("runs")).select("doc_id", "k", "text", "runs")
    w = checkpointed(texts.mapInArrow(_windows(words), f"doc_id {kind}, k long, start int, w1 long, w2 long"))
    place = F.struct(F.isnull("doc_id").alias("n"), F.col("doc_id"), F.col("k"), F.col("start"))
    repeated = (
        w.groupBy("w1", "w2")
        .agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("earliest"))
        .where("n > 1")
        .select("w1", "w2", "earliest")
    )
    return (
        joined(w, repeated, ["w1", "w2"], "inner", F.col("w1"), F.col("w1"))
        .where(place > F.col("earliest"))
        .groupBy("doc_id", "k")
        .agg(F.collect_set("start").alias("starts"))
        .mapInArrow(_merged(words), f"doc_id {kind}, k long, spans {PAIRS}")
    )


def cut_passages(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """``documents`` without the later occurrences, all rows and columns kept; reads ``documents`` several times."""
    found = repeats(documents, words)
    names = documents.columns
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_strata_row"), F.xxhash64("text").alias("_strata_k"))
    same = F.col("_strata_row.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("_strata_k") == F.col("k"))
    hashes = F.xxhash64(F.col("_strata_row.doc_id"), F.col("_strata_k")), F.xxhash64("doc_id", "k")
    both = joined(rows, found, same, "left", *hashes, ENTRY_BYTES * F.size("spans"))
    spans = F.coalesce("spans", F.expr(f"cast(array() as {PAIRS})")).alias("_strata_spans")
    out = both.select(*[F.col(f"_strata_row.`{c}`").alias(c) for c in names], spans)
    find = lambda batch: _given(batch, names.index("text"))
    return same_columns(out, _cutter([*names, "_strata_spans"], "spans", find)).drop("_strata_spans")
