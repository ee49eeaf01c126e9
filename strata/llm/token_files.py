"""Token files: ids of documents in order, coded by a static range asymmetric numeral system (rANS).

``write_token_files`` writes three tables under a path:

- ``table``: the shared frequencies, one row per id: whole numbers that sum to
  ``2**PROB``, at least one for each id that occurs, made from the counts of all ids;
- ``blocks``: of ``BLOCK`` ids each (a file's last one may be shorter), every one coded by itself: ``LANES``
  interleaved states that share one stream of 32-bit words. A payload holds the
  states and the place in the stream at every ``SEGMENT`` ids, a checkpoint from which
  decoding can start, and checksums of itself and of its ids. Beside it
  stand the documents with ids in the block, and where;
- ``files``: each file's number of ids and of ids before it.

``read_token_files`` decodes blocks in parallel, all of a block's segments side by side,
verifies the checksums, and returns the documents' ids.
Payload, little endian: ``RNS1``, crc32 of what follows, crc32 of the ids as 32-bit numbers, number of ids,
number of segments, number of words (u32 each), then per segment the place in the stream (u32)
and the states (u64 each), then the words (u32).

How it scales: texts are tokenised in one narrow pass into compressed ids, written to the
checkpoint folder. Counting them is a second narrow pass; the table is bounded by the
vocabulary. The compressed ids are range-partitioned and sorted by doc_id (a doc_id
that many rows share is split by text and row), and each task writes one file. No text is
shuffled. Reading is narrow: a document's checksum is the XOR of its parts' checksums,
each shifted by the bytes behind it, so only documents cut by a block's end are grouped, map-side first.

Defined cases: a null text is empty, and an empty text has the end id alone; a null
doc_id comes first; rows that share a doc_id are ordered by a hash of their text, then
by place in the input, and all are written; a long text spans many blocks; an empty table gives empty tables; a
string such as ``<|endoftext|>`` in a text is the vocabulary's own id for it, as in a plain call of
the library; a payload that fails a checksum raises; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm import tokens
from strata.llm.session import checkpointed, shared_folder, ship_code

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
# Fixed values of the format.
PROB, LANES, SEGMENT, BLOCK = 20, 32, 8192, 65536
LOW = np.uint64(1 << 31)  # a state is at least this between symbols
STEPS = SEGMENT // LANES
AT_ONCE = 16  # blocks coded side by side
U64, W32 = np.uint64, np.uint64(32)


class BadChecksum(ValueError):
    pass


def frequencies(counts: np.ndarray, prob: int = PROB) -> np.ndarray:
    """Counts scaled to whole numbers with the sum ``2**prob``, at least one for each count above zero."""
    total, whole = int(counts.sum()), 1 << prob
    if not total:
        return np.zeros(len(counts), dtype=np.int64)
    some = np.flatnonzero(counts)
    if len(some) > whole // 2:
        raise ValueError("too many different ids for the table")
    share = counts[some].astype(np.float64) * (whole / total)
    f = np.maximum(1, np.floor(share)).astype(np.int64)
    left = whole - int(f.sum())
    order = np.argsort(f - share, kind="stable")  # most short-changed first
    if left > 0:
        f[order[: left % len(some)]] += 1
        f += left // len(some)
    while left < 0:  # too many ones: taken back from the largest
        big = np.argsort(-f, kind="stable")[: max(1, len(some) // 8)]
        take = np.minimum(f[big] - 1, -(-(-left) // len(big)))
        take = np.minimum(take, np.maximum(0, -left - (np.cumsum(take) - take)))
        f[big] -= take
        left += int(take.sum())
    out = np.zeros(len(counts), dtype=np.int64)
    out[some] = f
    return out


class Table:
    """Frequencies ready for coding."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.cum = (np.cumsum(freq) - freq).astype(np.uint64)
        self.most = self.freq << U64(31 - PROB + 32)  # a state from here on gives up a word first
        self._symbol: np.ndarray | None = None

    @property
    def symbol(self) -> np.ndarray:
        if self._symbol is None:
            self._symbol = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._symbol


def encode_blocks(ids: np.ndarray, table: Table, size: int = BLOCK) -> list[bytes]:
    """Payloads of the consecutive blocks of ``size`` ids (a multiple of SEGMENT)."""
    out = []
    for lo in range(0, len(ids), size * AT_ONCE):
        out += _encode(ids[lo : lo + size * AT_ONCE], table, size)
    return out


def _encode(ids: np.ndarray, table: Table, size: int) -> list[bytes]:
    blocks = -(-len(ids) // size)
    steps = min(size, -(-len(ids) // LANES) * LANES) // LANES
    padded = np.zeros(blocks * size, dtype=np.int64)
    padded[: len(ids)] = ids
    symbols = padded.reshape(blocks, size // LANES, LANES)
    length = np.minimum(size, len(ids) - size * np.arange(blocks))
    x = np.full((blocks, LANES), LOW, dtype=U64)
    words = np.zeros((steps, blocks, LANES), dtype=np.uint32)
    given = np.zeros((steps, blocks, LANES), dtype=bool)
    states = np.zeros((-(-steps // STEPS), blocks, LANES), dtype=U64)
    lane = np.arange(LANES)
    ragged = int(length.min()) // LANES  # from this step on some block may have ended
    for t in range(steps - 1, -1, -1):
        s = symbols[:, t]
        f = table.freq[s]
        give = x >= table.most[s]
        if t >= ragged:
            live = t * LANES + lane < length[:, None]
            give &= live
            f = np.where(live, f, U64(1))
        words[t] = np.where(give, x, U64(0)).astype(np.uint32)
        given[t] = give
        y = np.where(give, x >> W32, x)
        high = y // f
        y = (high << U64(PROB)) + (y - high * f) + table.cum[s]
        x = np.where(live, y, x) if t >= ragged else y
        if t % STEPS == 0:
            states[t // STEPS] = x
    per_step = given.sum(axis=2)
    out = []
    for b in range(blocks):
        n = int(length[b])
        segments = -(-n // SEGMENT)
        stream = words[:, b][given[:, b]].astype("<u4").tobytes()
        before = np.concatenate([[0], np.cumsum(per_step[:, b])])[: segments * STEPS : STEPS]
        marks = np.zeros(segments, dtype=[("at", "<u4"), ("state", "<u8", LANES)])
        marks["at"], marks["state"] = before, states[:segments, b]
        own = zlib.crc32(ids[b * size : b * size + n].astype("<u4").tobytes())
        body = struct.pack("<IIII", own, n, segments, len(stream) // 4) + marks.tobytes() + stream
        out.append(b"RNS1" + struct.pack("<I", zlib.crc32(body)) + body)
    return out


def decode_blocks(payloads: list[bytes], table: Table) -> list[np.ndarray]:
    """The ids of each payload; all segments of all payloads are decoded side by side."""
    sizes, crcs, segments, marks, streams, shift = [], [], [], [], [], 0
    for p in payloads:
        if p[:4] != b"RNS1" or zlib.crc32(p[8:]) != struct.unpack_from("<I", p, 4)[0]:
            raise BadChecksum("a block's payload does not match its checksum")
        crc, n, k, w = struct.unpack_from("<IIII", p, 8)
        m = np.frombuffer(p, dtype=[("at", "<u4"), ("state", "<u8", LANES)], count=k, offset=24)
        streams.append(np.frombuffer(p, dtype="<u4", count=w, offset=24 + m.nbytes))
        marks.append((m["at"].astype(np.int64) + shift, m["state"]))
        shift += w
        sizes.append(n)
        crcs.append(crc)
        segments.append(np.minimum(SEGMENT, n - SEGMENT * np.arange(k)))
    if not payloads:
        return []
    stream = np.append(np.concatenate(streams), np.uint32(0)).astype(U64)
    at = np.concatenate([a for a, _ in marks])
    x = np.concatenate([s for _, s in marks]).astype(U64)
    ids = _decode(x, at, np.concatenate(segments), stream, table)
    out, lo = [], 0
    for n, crc in zip(sizes, crcs):
        k = -(-n // SEGMENT)
        got = ids[lo : lo + k].reshape(-1)[:n]
        if zlib.crc32(got.astype("<u4").tobytes()) != crc:
            raise BadChecksum("a block's ids do not match their checksum")
        out.append(got)
        lo += k
    return out


def decode_segment(payload: bytes, segment: int, table: Table) -> np.ndarray:
    """The ids of one segment alone, from its checkpoint."""
    _, n, k, w = struct.unpack_from("<IIII", payload, 8)
    m = np.frombuffer(payload, dtype=[("at", "<u4"), ("state", "<u8", LANES)], count=k, offset=24)[segment : segment + 1]
    stream = np.append(np.frombuffer(payload, dtype="<u4", count=w, offset=len(payload) - 4 * w), np.uint32(0)).astype(U64)
    size = min(SEGMENT, n - SEGMENT * segment)
    return _decode(m["state"].astype(U64), m["at"].astype(np.int64), np.array([size]), stream, table)[0, :size]


def _decode(x: np.ndarray, at: np.ndarray, length: np.ndarray, stream: np.ndarray, table: Table) -> np.ndarray:
    """(segments, SEGMENT) ids from states, places in the stream and numbers of ids."""
    out = np.zeros((len(x), STEPS, LANES), dtype=np.uint32)
    symbol, freq, cum = table.symbol, table.freq, table.cum
    lane, mask = np.arange(LANES), U64((1 << PROB) - 1)
    ragged = int(length.min()) // LANES
    for t in range(-(-int(length.max()) // LANES)):
        slot = x & mask
        s = symbol[slot]
        y = freq[s] * (x >> U64(PROB)) + slot - cum[s]
        need = y < LOW
        if t >= ragged:
            live = t * LANES + lane < length[:, None]
            need &= live
        rank = np.cumsum(need, axis=1)
        # Nothing is read past the end, however wrong the table may be: the checksum tells.
        word = stream[np.where(need, np.minimum(at[:, None] + rank, len(stream)) - 1, len(stream) - 1)]
        y = np.where(need, (y << W32) | word, y)
        at = at + rank[:, -1]
        x = np.where(live, y, x) if t >= ragged else y
        out[:, t] = s
    return out.reshape(len(x), STEPS * LANES)


# Checksums of parts: a crc32 shifted by the bytes that follow it.


def _square(m: list[int]) -> list[int]:
    return [_times(m, v) for v in m]


def _times(m: list[int], v: int) -> int:
    out = 0
    for row in m:
        if v & 1:
            out ^= row
        v >>= 1
    return out


_zeros: list[list[int]] = []


def shifted(crc: int, n_bytes: int) -> int:
    """What ``crc`` adds to the crc32 of a text in which ``n_bytes`` follow."""
    if not _zeros:
        bit = [0xEDB88320, *(1 << i for i in range(31))]  # one zero bit
        for _ in range(3):
            bit = _square(bit)
        _zeros.append(bit)  # one zero byte
    k = 0
    while n_bytes >> k:
        if k == len(_zeros):
            _zeros.append(_square(_zeros[-1]))
        if n_bytes >> k & 1:
            crc = _times(_zeros[k], crc)
        k += 1
    return crc


# Tokenising, counting, writing.


def _tokenise(vocabulary, end_id: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.LowerCasing.of(vocabulary.value)
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for lo, ids, at in encoder.encode_column(batch["text"]):
                n = len(at) - 1
                full = np.insert(ids, at[1:], end_id).astype(kind)
                ends = at + np.arange(n + 1)
                packed = [pack.compress(full[s:e].tobytes()) for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [*(batch[c].slice(lo, n) for c in ("doc_id", "k", "row")), pa.array(packed, pa.binary())], ["doc_id", "k", "row", "ids"]
                )

    return run


def _unpacked(column: pa.Array, kind: str) -> Iterator[np.ndarray]:
    unpack = zstandard.ZstdDecompressor()
    for x in column:
        yield np.frombuffer(unpack.decompress(x.as_py()), dtype=kind)


def _count(kind: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for ids in _unpacked(batch["ids"], kind):
                np.add.at(counts, ids, 1)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["id", "n"])

    return run


def _write(shared, kind: str, id_type):
    """The blocks of one file; documents come in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(shared.value)
        file = TaskContext.get().partitionId()
        batch_ids = BLOCK * AT_ONCE
        pending: list[np.ndarray] = []  # ids not written yet
        open_docs: list[tuple] = []  # documents with ids among them: doc_id, start, end
        done = held = 0

        def flush(all_: bool) -> Iterator[pa.RecordBatch]:
            nonlocal pending, open_docs, done, held
            ids = np.concatenate(pending) if pending else np.zeros(0, dtype=kind)
            n = len(ids) if all_ else len(ids) // BLOCK * BLOCK
            starts = np.array([s for _, s, _ in open_docs], dtype=np.int64)
            ends = np.array([e for _, _, e in open_docs], dtype=np.int64)
            for b, payload in enumerate(encode_blocks(ids[:n], table)):
                lo, hi = done + b * BLOCK, done + min(n, (b + 1) * BLOCK)
                first, last = int(np.searchsorted(ends, lo, side="right")), int(np.searchsorted(starts, hi, side="left"))
                s, e = starts[first:last], ends[first:last]
                at = np.maximum(s, lo)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([file], pa.int32()),
                        pa.array([lo], pa.int64()),
                        pa.array([hi - lo], pa.int64()),
                        pa.array([payload], pa.binary()),
                        pa.array([[d for d, _, _ in open_docs[first:last]]], pa.list_(id_type)),
                        *(pa.array([x.tolist()], pa.list_(pa.int64())) for x in (s, e - s, at - s, np.minimum(e, hi) - at)),
                    ],
                    ["file", "first", "n_ids", "payload", "docs", "starts", "totals", "places", "lengths"],
                )
            done += n
            pending, held = [ids[n:]], len(ids) - n
            open_docs = [d for d in open_docs if d[2] > done]

        for batch in batches:
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), _unpacked(batch["ids"], kind)):
                start = done + held
                open_docs.append((doc_id, start, start + len(ids)))
                pending.append(ids)
                held += len(ids)
                if held >= batch_ids:
                    yield from flush(False)
        if held:
            yield from flush(True)

    return run


def write_token_files(documents: DataFrame, path: str, vocabulary_path: str | None = None, end_id: int = END_ID) -> None:
    """Writes the ids of all documents in ascending doc_id order under ``path`` (which must not exist)."""
    spark = documents.sparkSession
    ship_code(spark)
    text = tokens.vocabulary(vocabulary_path or tokens.public(VOCABULARY))
    size = max(tokens.Encoder.of(text).tokenizer.get_vocab_size(), end_id + 1)
    kind = "<u2" if size <= 1 << 16 else "<u4"
    shared = spark.sparkContext.broadcast(text)
    slim = documents.select("doc_id", "text", F.xxhash64("text").alias("k"), F.monotonically_increasing_id().alias("row"))
    id_kind = slim.schema["doc_id"].dataType.simpleString()
    ids = checkpointed(slim.mapInArrow(_tokenise(shared, end_id, kind), f"doc_id {id_kind}, k long, row long, ids binary"))

    # At most as many rows as the vocabulary has ids.
    counted = ids.select("ids").mapInArrow(_count(kind, size), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(size, dtype=np.int64)
    counts[counted["id"].to_numpy(dtype=np.int64)] = counted["n"].to_numpy(dtype=np.int64)
    freq = frequencies(counts)
    some = np.flatnonzero(freq)
    rows = [(int(i), int(freq[i])) for i in some]
    spark.createDataFrame(rows, "id long, freq long").coalesce(1).write.parquet(f"{path}/table")

    table = spark.sparkContext.broadcast(freq)
    longs = ", ".join(f"{c} array<long>" for c in ("starts", "totals", "places", "lengths"))
    schema = f"file int, first long, n_ids long, payload binary, docs array<{id_kind}>, {longs}"
    id_type = spark.createDataFrame([], f"d {id_kind}").toArrow().schema.field("d").type
    order = ["doc_id", "k", "row"]
    dealt = ids.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids")
    dealt.mapInArrow(_write(table, kind, id_type), schema).write.option("compression", "none").parquet(f"{path}/blocks")

    per_file = spark.read.parquet(f"{path}/blocks").groupBy("file").agg(F.sum("n_ids").alias("n_ids"))
    before = F.sum("n_ids").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))  # a row a file
    per_file.select("file", "n_ids", F.coalesce(before, F.lit(0)).alias("base")).write.parquet(f"{path}/files")


def _read(shared, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(shared.value)
        names = ("starts", "totals", "places", "lengths")
        for batch in batches:
            for lo in range(0, len(batch), AT_ONCE):
                part = batch.slice(lo, AT_ONCE)
                decoded = decode_blocks(part["payload"].to_pylist(), table)
                for b, ids in enumerate(decoded):
                    start, total, place, length = (part[c][b].values.to_numpy() for c in names)
                    raw = ids.astype("<u4")
                    first = start + place - part["first"][b].as_py()
                    crc = [zlib.crc32(raw[s:e].data) for s, e in zip(first.tolist(), (first + length).tolist())]
                    behind = 4 * (total - place - length)
                    cut = np.flatnonzero(behind)
                    for i in cut.tolist():
                        crc[i] = shifted(crc[i], int(behind[i]))
                    columns = [
                        part["docs"][b].values,
                        pa.array(np.full(len(start), part["file"][b].as_py()), pa.int32()),
                        pa.array(start), pa.array(total), pa.array(place), pa.array(length), pa.array(crc, pa.int64()),
                    ]
                    out = ["doc_id", "file", "start", "total", "place", "length", "crc"]
                    if with_ids:
                        columns.append(pa.array([raw[s:e].astype(np.int64) for s, e in zip(first.tolist(), (first + length).tolist())], pa.list_(pa.int64())))
                        out.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, out)

    return run


def read_parts(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """The documents' ids as decoded, one row per document and block.

    doc_id, file, start (ids before the document in its file), total (its ids),
    place (ids of it in earlier blocks), length, crc (its share of the document's crc32), ids.
    """
    ship_code(spark)
    rows = spark.read.parquet(f"{path}/table").toPandas()  # at most the vocabulary
    freq = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 1, dtype=np.int64)
    freq[rows["id"].to_numpy(dtype=np.int64)] = rows["freq"].to_numpy(dtype=np.int64)
    shared = spark.sparkContext.broadcast(freq)
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["docs"].dataType.elementType.simpleString()
    schema = f"doc_id {kind}, file int, start long, total long, place long, length long, crc long" + (", ids array<long>" if with_ids else "")
    return blocks.mapInArrow(_read(shared, with_ids), schema)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (and ids)."""
    parts = read_parts(spark, path, with_ids)
    parts = parts if with_ids else checkpointed(parts)  # a few numbers a document: decoded once, read twice
    more = {"ids": F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("place", "ids"))), lambda x: x["ids"]))} if with_ids else {}
    names = ["doc_id", "file", "start", F.col("total").alias("n_tokens"), F.col("crc").alias("ids_crc32"), *more]
    whole = parts.where("length = total").select(names)
    cut = (
        parts.where("length < total")
        .groupBy("file", "start")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("total").alias("n_tokens"),
            F.bit_xor("crc").alias("ids_crc32"),
            *[x.alias(c) for c, x in more.items()],
        )
    )
    base = spark.read.parquet(f"{path}/files").select("file", "base")  # a row a file
    return (
        whole.unionByName(cut)
        .join(base, "file")
        .select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32", *more)
    )


def op12_token_files(documents: DataFrame) -> DataFrame:
    """The contract's digest, read back from files in the shared folder."""
    spark = documents.sparkSession
    path = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    write_token_files(documents, path)
    return read_token_files(spark, path)
