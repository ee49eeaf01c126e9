"""Benchmark decontamination: a broadcast hash set of the test items' word windows.

The items are normalised to words (A-Z lower-cased, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``)
and cut into windows of ``window`` consecutive words; an item with fewer words
is one window of its own length. Every document's words are hashed in windows
of the same lengths and looked up; each hit is verified against the item's
words themselves, so a hash collision changes nothing.

The set is broadcast only within a proven bound: equal items are folded and their total size is
measured first. Items beyond ``block_bytes`` are dealt over several blocks, each measured too;
each is read, broadcast (about six bytes for a byte of text) and scanned for in
a pass of its own, whose hits are written before the next block is read; then
they are merged per document. The driver holds one block at a time.

Beyond ``max_blocks`` blocks, or if a block is larger than its bound (one huge item), the
items stay distributed: their windows are written as hashes with their words, and the documents'
windows are joined to them, words compared. A broadcast Bloom filter of bounded size (``bloom``)
keeps most other windows in their tasks; a window in a third of all documents is
a skewed join whose sides are both dealt for it, so AQE can split it.

Defined cases: a null or wordless document has no words and no hits; a null or
wordless item has no windows; an item without id counts as item ``""``; items
that share an id count as one item, equal items as one; repeated documents are handled one by one;
a very long document or item is never cut; a document word in several windows is hit once; an
empty table of items gives no hits, one of documents no rows; all further columns of
the inputs are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import arrays
from strata.llm.bloom import bloom
from strata.llm.session import ENTRY_BYTES, checkpointed, same_columns, ship_code, sized

WINDOW = 10
BLOCK_BYTES = 8 << 20
MAX_BLOCKS = 4
FILTER_BITS = 22


class WindowSet:
    """The windows of some items: the items' words, and per window length their hashes, sorted, with their places."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.ids = [i for i, _ in items]
        self.words = arrays.Words(*arrays.texts(pa.array([t for _, t in items], pa.string())))
        h, count = self.words.hashes(), self.words.count
        self.tables = {}
        for n in sorted({min(window, c) for c in count.tolist()} - {0}):
            rolled = arrays.roll(h, n)
            if n == window:
                at = np.flatnonzero(arrays.in_one_text(self.words.doc, n))
            else:
                at = self.words.first[:-1][count == n]
            at = at[np.argsort(rolled[at], kind="stable")]
            known = rolled[at]
            bits = np.zeros(1 << FILTER_BITS, dtype=bool)
            bits[(known >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
            self.tables[n] = (known, at, bits)


def hits(w: arrays.Words, windows: WindowSet) -> Iterator[tuple[int, int, int, set[str]]]:
    """(document, first word, number of words, items) of each verified occurrence."""
    words = w.hashes()
    for n, (known, places, bits) in windows.tables.items():
        h = arrays.roll(words, n)
        maybe = np.flatnonzero(bits[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] & arrays.in_one_text(w.doc, n))
        lo, hi = (np.searchsorted(known, h[maybe], side=side) for side in ("left", "right"))
        found: dict[bytes, set[str]] = {}  # by the words themselves
        for k in np.flatnonzero(hi > lo).tolist():
            i = int(maybe[k])
            text = w.text(i, n)
            if text not in found:
                same = [p for p in places[lo[k] : hi[k]].tolist() if windows.words.text(p, n) == text]
                found[text] = {windows.ids[windows.words.doc[p]] for p in same}
            if found[text]:
                yield int(w.doc[i]), i - int(w.first[w.doc[i]]), n, found[text]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, disjoint spans that cover what ``spans`` cover."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def scan(column: pa.Array, windows: WindowSet) -> Iterator[tuple[int, list[tuple[int, int]], list[str], arrays.Words, int]]:
    """For each text: its word count, hit word spans, hit items; and where its words are."""
    for lo, hi, data, at in arrays.chunks(column):
        w = arrays.Words(data, at)
        spans: dict[int, list[tuple[int, int]]] = {}
        items: dict[int, set[str]] = {}
        for doc, first, n, who in hits(w, windows):
            spans.setdefault(doc, []).append((first, first + n))
            items.setdefault(doc, set()).update(who)
        for doc in range(hi - lo):
            yield int(w.count[doc]), merged(spans.get(doc, [])), sorted(items.get(doc, ())), w, doc


class Blocks:
    """The items' windows in sets made from about ``block_bytes`` of text each, read one at a time.

    Different items are dealt over the blocks by a hash. ``bounded`` says whether every
    block was measured to be within the bound.
    """

    def __init__(self, benchmark: DataFrame, window: int, block_bytes: int):
        self.window = window
        self.items = (
            benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").alias("words"))
            .where("words IS NOT NULL")
            .distinct()
        )
        size = F.octet_length("words") + F.octet_length("item") + 64
        whole = self.items.agg(F.sum(size)).first()[0] or 0
        self.count, self.bounded = 1, True
        if whole > block_bytes:
            self.count = -(-whole // max(1, block_bytes // 2))
            largest = self.items.groupBy(self._number()).agg(F.sum(size).alias("s")).agg(F.max("s")).first()[0]
            self.bounded = largest <= block_bytes

    def _number(self):
        return F.pmod(F.xxhash64("item", "words"), F.lit(self.count))

    def __iter__(self) -> Iterator[WindowSet]:
        for k in range(self.count):
            part = self.items.where(self._number() == k) if self.count > 1 else self.items
            yield WindowSet([tuple(r) for r in part.collect()], self.window)


PAIRS = "array<struct<s:long,e:long>>"
# Sorted spans to disjoint ones that cover the same words.
UNION = (
    f"aggregate(array_sort(flatten(collect_list(spans))), cast(array() as {PAIRS}), (a, x) -> "
    "CASE WHEN size(a) > 0 AND element_at(a, -1).e >= x.s THEN concat(slice(a, 1, size(a) - 1), "
    "array(named_struct('s', element_at(a, -1).s, 'e', greatest(element_at(a, -1).e, x.e)))) ELSE concat(a, array(x)) END)"
)


def _hits(documents: DataFrame, sets: Blocks, max_blocks: int) -> DataFrame:
    """doc_id, k (hash of the text), spans, items of the documents with a hit, written down."""
    small = sets.bounded and sets.count <= max_blocks
    found = _hits_of_blocks(documents, sets) if small else _hits_by_join(documents, sets)
    return sized(found, ENTRY_BYTES * (F.size("spans") + F.size("items")) + F.octet_length(F.array_join("items", ",")))


def _hits_of_blocks(documents: DataFrame, sets: Blocks) -> DataFrame:
    """The hits of one pass per block; each pass is written down."""
    spark = documents.sparkSession
    slim = documents.select("doc_id", "text", F.xxhash64("text").alias("k"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    found = None
    for windows in sets:
        run, shared = _scanner(spark, windows, ("doc_id", "k"))
        part = checkpointed(slim.mapInArrow(run, f"doc_id {kind}, k long, {FOUND}").where("size(spans) > 0"))
        shared.destroy()
        found = part if found is None else found.unionByName(part)
    # Rows that agree in id and text have the same hits: merging makes them one.
    items = F.array_sort(F.array_distinct(F.flatten(F.collect_list("items"))))
    return found.groupBy("doc_id", "k").agg(F.expr(UNION).alias("spans"), items.alias("items"))


def _item_windows(window: int):
    """Every window of each item: its number of words, its hash, its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, at in arrays.chunks(batch["words"]):
                w = arrays.Words(data, at)
                h = w.hashes()
                for n in sorted({min(window, c) for c in w.count.tolist()} - {0}):
                    ok = np.flatnonzero(arrays.in_one_text(w.doc, n))
                    ok = ok if n == window else ok[w.count[w.doc[ok]] == n]
                    rows = pa.array(lo + w.doc[ok])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch["item"].take(rows),
                            pa.array(np.full(len(ok), n), pa.int32()),
                            pa.array(arrays.signed(arrays.roll(h, n)[ok]), pa.int64()),
                            pa.array([w.text(i, n) for i in ok.tolist()], pa.binary()),
                        ],
                        ["item", "n", "h", "win"],
                    )

    return run


def _maybe(lengths: list[int], shared):
    """The documents' windows that the filter lets pass: the first word's number, the window's size, hash and words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, at in arrays.chunks(batch["text"]):
                w = arrays.Words(data, at)
                words = w.hashes()
                for n in lengths:
                    h = arrays.roll(words, n)
                    ok = np.flatnonzero(shared.value.passes(h) & arrays.in_one_text(w.doc, n))
                    rows = pa.array(lo + w.doc[ok])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch["doc_id"].take(rows),
                            batch["k"].take(rows),
                            pa.array(ok - w.first[w.doc[ok]], pa.int64()),
                            pa.array(np.full(len(ok), n), pa.int32()),
                            pa.array(arrays.signed(h[ok]), pa.int64()),
                            pa.array([w.text(i, n) for i in ok.tolist()], pa.binary()),
                        ],
                        ["doc_id", "k", "s", "n", "h", "win"],
                    )

    return run


def _hits_by_join(documents: DataFrame, sets: Blocks) -> DataFrame:
    """The hits of items of any number and size, by a join on window hashes; the windows' words are compared."""
    spark = documents.sparkSession
    slim = documents.select("doc_id", "text", F.xxhash64("text").alias("k"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    windows = checkpointed(sets.items.mapInArrow(_item_windows(sets.window), "item string, n int, h long, win binary").distinct())
    known = checkpointed(windows.select("n", "h", "win").distinct())
    lengths = sorted(r["n"] for r in known.select("n").distinct().collect())  # at most ``window``
    shared = spark.sparkContext.broadcast(bloom(known.select("h")))
    maybe = slim.mapInArrow(_maybe(lengths, shared), f"doc_id {kind}, k long, s long, n int, h long, win binary")
    hit = checkpointed(maybe.join(known, ["n", "h", "win"]))
    span = F.struct(F.col("s"), (F.col("s") + F.col("n")).alias("e"))
    spans = hit.groupBy("doc_id", "k").agg(F.collect_set(span).alias("all")).withColumn("spans", F.expr(UNION.replace("flatten(collect_list(spans))", "all")))
    who = hit.select("doc_id", "k", "n", "h", "win").distinct().join(windows, ["n", "h", "win"]).select("doc_id", "k", "item").distinct()
    items = who.groupBy("doc_id", "k").agg(F.array_sort(F.collect_list("item")).alias("items"))
    a, b = spans.select("doc_id", "k", "spans").alias("a"), items.alias("b")
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.k").eqNullSafe(F.col("b.k")))
    return a.join(b, same).select("a.doc_id", "a.k", "spans", "items")


FOUND = f"n_words long, spans {PAIRS}, items array<string>"


def contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, max_blocks: int = MAX_BLOCKS
) -> DataFrame:
    """doc_id, n_words, spans (merged word spans hit, end exclusive), items (ids, sorted).

    One block of items (the usual case): one narrow pass over the documents, no
    shuffle. Several: a pass each, or a join, and the hits joined to the documents.
    """
    spark = documents.sparkSession
    ship_code(spark)
    slim = documents.select("doc_id", "text")
    kind = slim.schema["doc_id"].dataType.simpleString()
    sets = Blocks(benchmark, window, block_bytes)
    if sets.count == 1:  # within the bound
        return slim.mapInArrow(_scanner(spark, next(iter(sets)))[0], f"doc_id {kind}, {FOUND}")
    found = _hits(documents, sets, max_blocks)
    counted = slim.withColumn("k", F.xxhash64("text")).mapInArrow(
        _scanner(spark, WindowSet([], window), ("doc_id", "k"))[0], f"doc_id {kind}, k long, {FOUND}"
    )
    same = counted["doc_id"].eqNullSafe(found["doc_id"]) & (counted["k"] == found["k"])
    return counted.join(found, same, "left").select(
        counted["doc_id"],
        "n_words",
        F.coalesce(found["spans"], counted["spans"]).alias("spans"),
        F.coalesce(found["items"], counted["items"]).alias("items"),
    )


def _scanner(spark: SparkSession, windows: WindowSet, keep: tuple[str, ...] = ("doc_id",)):
    """(the function for mapInArrow, the broadcast it reads)."""
    shared = spark.sparkContext.broadcast(windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
        for batch in batches:
            found = [(n, [{"s": s, "e": e} for s, e in spans], items) for n, spans, items, _, _ in scan(batch["text"], shared.value)]
            n, spans, items = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in keep), pa.array(n, pa.int64()), pa.array(spans, pair), pa.array(items, pa.list_(pa.string()))],
                [*keep, "n_words", "spans", "items"],
            )

    return run, shared


def decontaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    remove: str = "documents",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    max_blocks: int = MAX_BLOCKS,
) -> DataFrame:
    """``documents`` without contamination, all columns kept.

    remove="documents" drops each document with a hit; "spans" cuts the hit
    words (from the first hit word to the end of the last one) out of the text
    and sets n_chars anew where there is such a column. With one block of items
    this is one narrow pass; with several, the hits are joined to the documents.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove must be 'documents' or 'spans'")
    spark = documents.sparkSession
    ship_code(spark)
    sets = Blocks(benchmark, window, block_bytes)
    names = documents.columns
    if sets.count == 1:
        shared = spark.sparkContext.broadcast(next(iter(sets)))
        return same_columns(documents, _cutter(names, remove, lambda batch: scan(batch.column(names.index("text")), shared.value)))
    found = _hits(documents, sets, max_blocks)
    row, k = F.struct(*[F.col(f"`{c}`") for c in names]), F.xxhash64("text")
    rows = documents.select(row.alias("_strata_row"), k.alias("_strata_k"))
    same = rows["_strata_row"]["doc_id"].eqNullSafe(found["doc_id"]) & (rows["_strata_k"] == found["k"])
    if remove == "documents":
        out = rows.join(found, same, "left_anti")
        return out.select(*[F.col(f"_strata_row.`{c}`").alias(c) for c in names])
    spans = F.coalesce("spans", F.expr(f"cast(array() as {PAIRS})")).alias("_strata_spans")
    out = rows.join(found, same, "left").select(*[F.col(f"_strata_row.`{c}`").alias(c) for c in names], spans)
    return same_columns(out, _cutter([*names, "_strata_spans"], remove, lambda batch: _given(batch, names.index("text")))).drop("_strata_spans")


def _given(batch: pa.RecordBatch, text_at: int) -> Iterator[tuple[int, list[tuple[int, int]], list[str], arrays.Words, int]]:
    """Like ``scan``, with the spans of the batch's last column."""
    spans = batch.column(batch.num_columns - 1).to_pylist()
    for lo, hi, data, at in arrays.chunks(batch.column(text_at)):
        w = arrays.Words(data, at)
        for doc in range(hi - lo):
            yield int(w.count[doc]), [(x["s"], x["e"]) for x in spans[lo + doc]], [], w, doc


def _cutter(columns: list[str], remove: str, find):
    """The function that drops hit documents, or cuts hit words; ``find`` yields each row's hits as ``scan`` does."""
    text_at = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean, cut = [], {}
            for row, (_, spans, _, w, doc) in enumerate(find(batch)):
                clean.append(not spans)
                if spans and remove == "spans":
                    text, base, first = batch.column(text_at)[row].as_py().encode(), int(w.at[doc]), int(w.first[doc])
                    kept, at = [], 0
                    for s, e in spans:
                        kept.append(text[at : int(w.start[first + s]) - base])
                        at = int(w.end[first + e - 1]) - base
                    cut[row] = b"".join([*kept, text[at:]]).decode()
            if remove == "documents":
                yield batch.filter(pa.array(clean, pa.bool_()))
                continue
            for name, value in (("text", lambda t: t), ("n_chars", len)):
                if cut and name in columns:
                    at = columns.index(name)
                    old = batch.column(at)
                    new = pa.array([value(cut[i]) if i in cut else x for i, x in enumerate(old.to_pylist())], old.type)
                    batch = batch.set_column(at, batch.schema.field(at), new)
            yield batch

    return run


def op10_decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's digest: how much of each document stands in the benchmark."""
    n_hit = F.expr("aggregate(spans, 0L, (a, x) -> a + x.e - x.s)")
    return contamination(documents, benchmark).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


ORACLE_SQL = r"""
WITH items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark WHERE text IS NOT NULL
),
item_windows AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[i : i + least(10, len(ws)) - 1], ' ') AS win
  FROM (SELECT item_id, ws, unnest(generate_series(1, len(ws) - least(10, len(ws)) + 1)) AS i FROM items WHERE len(ws) > 0)
),
docs AS (
  SELECT doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
),
lengths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(ws[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS i FROM docs, lengths WHERE len(ws) >= n)
),
found AS (SELECT d.doc_id, d.i, d.n, w.item_id FROM doc_windows d JOIN item_windows w ON d.n = w.n AND d.win = w.win),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM found) GROUP BY doc_id),
who AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit USING (doc_id) LEFT JOIN who USING (doc_id)
"""
