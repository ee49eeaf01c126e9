"""Best-fit packing: hierarchical residual packing of token sequences.

A document's ids (its text's, then an end id) are cut into pieces of at most
``capacity`` ids, the first piece of a longer document taking what the full
ones leave. Each partition packs its own pieces by best fit, longest first, and
bins with at most ``slack`` ids left are done. The other bins become items
themselves (a bin's contents stay together): rounds of a tree deal them into
fewer and fewer groups, each packed by best fit again, until one group is left
or a round saves less than one bin in a hundred.

How it scales: tokenising and the first packing are one narrow pass whose rows
are written to the checkpoint folder. Only the underfull bins (id and fill) are
shuffled afterwards, at most ``group_rows`` to a task, and one join on the bin
id moves their pieces. No text and no ids are shuffled.

Defined cases: a null text is empty and gives one piece that holds the end id
alone; a long text is cut into pieces, never shortened; pieces of one size are packed in the order in
which they stand; repeated rows are packed one by one; an empty table gives no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import arrays, tokens
from strata.llm.session import checkpointed, ship_code

CAPACITY = 1024
END_ID = 2
SLACK = 8
FAN_IN = 8
GROUP_ROWS = 50_000


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit, longest first: (bin of each item, its offset there, fill of each bin)."""
    order = np.argsort(-sizes, kind="stable")
    bins = np.empty(len(sizes), dtype=np.int64)
    offsets = np.empty(len(sizes), dtype=np.int64)
    fill: list[int] = []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by space left
    some = 0  # bit r: there is a bin with r left
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        fit = some >> size
        if fit:
            left = size + (fit & -fit).bit_length() - 1
            b = open_bins[left].pop()
            if not open_bins[left]:
                some &= ~(1 << left)
        else:
            left, b = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += size
        if left > size:
            open_bins[left - size].append(b)
            some |= 1 << (left - size)
    return bins, offsets, np.array(fill, dtype=np.int64)


def cut(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, piece, start, length) of the pieces of documents with so many ids."""
    count = -(-lengths // capacity)
    doc = np.repeat(np.arange(len(lengths)), count)
    piece = arrays.spread(count)
    head = lengths - (count - 1) * capacity
    start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
    return doc, piece, start, np.where(piece == 0, head[doc], capacity)


def _binary(numbers: np.ndarray, at: np.ndarray) -> pa.Array:
    """The bytes of numbers[at[i]:at[i+1]], as views of one buffer: no object for each."""
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at * numbers.itemsize), pa.py_buffer(numbers)])


def _local(vocabulary, capacity: int, end_id: int, kind: str | None):
    """Pieces packed per partition; with their ids as bytes if ``kind`` says of what width."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.Encoder.of(vocabulary.value)
        docs, rows, ids_out = [], [], []
        for batch in batches:
            for lo, ids, at in encoder.encode_column(batch["text"]):
                n = len(at) - 1
                lengths = np.diff(at) + 1
                ends = np.cumsum(lengths)
                full = np.full(len(ids) + n, end_id, dtype="<u4")
                full[np.arange(len(ids)) + np.repeat(np.arange(n), lengths - 1)] = ids
                doc, piece, start, length = cut(lengths, capacity)
                first = (ends - lengths)[doc] + start
                crc = [zlib.crc32(full[s:e]) for s, e in zip(first.tolist(), (first + length).tolist())]
                docs.append(batch["doc_id"].take(pa.array(lo + doc)))
                rows.append(np.stack([piece, start, length, np.array(crc, dtype=np.int64)]))
                if kind:
                    ids_out.append(_binary(full.astype(kind), np.append(first, len(full))))
        if not rows:
            return
        doc_id = pa.chunked_array(docs).combine_chunks()
        ids_of = pa.chunked_array(ids_out, pa.large_binary())
        table = np.concatenate(rows, axis=1)
        bins, offsets, fill = best_fit(table[2], capacity)
        place = (TaskContext.get().partitionId() << 32) + bins
        step = 1 << (10 if kind else 16)
        for lo in range(0, len(bins), step):
            s = slice(lo, lo + step)
            columns = [
                doc_id[s], pa.array(table[0, s], pa.int32()), pa.array(table[1, s]), pa.array(table[2, s]), pa.array(table[3, s]),
                pa.array(place[s]), pa.array(offsets[s]), pa.array(fill[bins[s]]),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "fill"]
            if kind:
                columns.append(ids_of[s].combine_chunks().cast(pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _unpacked(kind: str):
    """The same rows with the ids as numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 1 << 10):
                part = batch.slice(lo, 1 << 10)
                raw = part["ids"].to_pylist()
                size = np.array([len(x) for x in raw], dtype=np.int64) // np.dtype(kind).itemsize
                ids = np.frombuffer(b"".join(raw), dtype=kind).astype(np.int32)
                at = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
                yield part.set_column(part.schema.get_field_index("ids"), "ids", pa.ListArray.from_arrays(at, pa.array(ids)))

    return run


def _merge(capacity: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("bin", kind="stable", ignore_index=True)  # whatever order the rows arrived in
        bins, offsets, fill = best_fit(group["fill"].to_numpy(), capacity)
        names = np.zeros(len(fill), dtype=np.int64)
        head = offsets == 0
        names[bins[head]] = group["bin"].to_numpy()[head]
        return pd.DataFrame({"bin": group["bin"], "into": names[bins], "shift": offsets, "fill": fill[bins]})

    return run


def pack(
    documents: DataFrame,
    vocabulary_path: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    slack: int = SLACK,
    with_ids: bool = False,
    as_bytes: bool = False,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    ids: an array of int, or with ``as_bytes`` the little-endian unsigned numbers themselves, of 16 bits where
    the vocabulary has at most 65,536 ids, else of 32.
    """
    spark = documents.sparkSession
    ship_code(spark)
    vocabulary = tokens.vocabulary(vocabulary_path)
    shared = spark.sparkContext.broadcast(vocabulary)
    # Kept narrow until the end: a row's ids are moved at most once.
    size = max(tokens.Encoder.of(vocabulary).tokenizer.get_vocab_size(), end_id + 1) if with_ids else 0
    width = None if not with_ids else "<u2" if size <= 1 << 16 else "<u4"
    slim = documents.select("doc_id", "text")
    kind = slim.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, fill long"
    local = checkpointed(slim.mapInArrow(_local(shared, capacity, end_id, width), schema + (", ids binary" if with_ids else "")))

    under = local.where(F.col("fill") < capacity - slack)
    moved = under.where("offset = 0").select(F.col("sequence_id").alias("old"), F.col("sequence_id").alias("bin"), "fill", F.lit(0).cast("long").alias("shift"))
    moved = checkpointed(moved)
    groups, left = max(1, local.rdd.getNumPartitions()), moved.count()
    while left > 1:
        groups = max(1, -(-groups // FAN_IN), -(-left // group_rows))
        bins = moved.groupBy("bin").agg(F.max("fill").alias("fill"))
        merged = (
            bins.withColumn("g", F.pmod(F.xxhash64("bin"), F.lit(groups)))
            .groupBy("g")
            .applyInPandas(_merge(capacity), "bin long, into long, shift long, fill long")
        )
        moved = checkpointed(
            moved.select("old", "bin", F.col("shift").alias("s"))
            .join(merged, "bin")
            .select("old", F.col("into").alias("bin"), "fill", (F.col("s") + F.col("shift")).alias("shift"))
        )
        before, left = left, moved.select("bin").distinct().count()
        if groups == 1 or before - left < before // 100 and groups == -(-left // group_rows):
            break
    places = moved.select(F.col("old").alias("sequence_id"), "bin", "shift")
    out = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    done = local.where(F.col("fill") >= capacity - slack).select(*out, "sequence_id", "offset")
    rest = under.join(places, "sequence_id").select(*out, F.col("bin").alias("sequence_id"), (F.col("offset") + F.col("shift")).alias("offset"))
    packed = done.unionByName(rest)
    if with_ids and not as_bytes:
        names = [f"{c} {packed.schema[c].dataType.simpleString()}" for c in packed.columns]
        packed = packed.mapInArrow(_unpacked(width), ", ".join(names).replace("ids binary", "ids array<int>"))
    return packed


def op6_best_fit_packing(documents: DataFrame) -> DataFrame:
    return pack(documents).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
