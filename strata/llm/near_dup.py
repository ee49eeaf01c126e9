"""MinHash near-dedup with DartMinHash signatures of weighted word shingles.

A document is the weighted set of its shingles of five consecutive words
(A-Z lower-cased, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``); a shingle's weight is the number of times it occurs,
and a text of one to four words is one shingle. Two documents are linked when
their weighted Jaccard similarity, sum of minima over sum of maxima, is 0.8 or
more; documents reachable over links are one class.

DartMinHash (Christiani, 2020): every element throws the same pseudo-random
darts for all documents, a Poisson process over (weight, rank) of rate one, cut
into dyadic regions so that only those a document can hit are generated. A dart
hits if it lies below the element's weight; each of the ``K`` coordinates keeps
its dart of lowest rank. Enough ranks are searched (about K ln K + 2K darts a
document, whatever its length) for every coordinate to be filled; the few
documents with an empty one search twice as far. Two documents agree in a
coordinate with exactly their weighted Jaccard similarity.

From signatures to classes, without emitting all pairs of a group:

1. Copies (equal word sequences; texts without words only if equal) are folded
   into one node before anything is compared.
2. The signature is cut into bands of rows, as many as a pair at the threshold needs
   to meet in one but for ``MISS`` (``settings``). Band keys are counted (map-side partial
   sums); only those that several nodes share go on, and of buckets with the same nodes only one.
3. Stars: every node of a bucket is compared with the bucket's smallest one. Most
   groups of near copies are connected by that, at one exact comparison a node.
4. What stays open: only buckets whose nodes are in several components go on, and only pairs
   across components are compared there, again exactly. The bucket's largest component is
   dealt over tasks in blocks and is not paired with itself; the other nodes
   meet each of its blocks and one another. No candidate is ruled out by an estimate.
5. Components of the verified edges are the classes.

Names of 16 bytes travel until step 3 ships each weighted set once per star, and step 4
once per block it must meet: a large group of near copies costs in proportion to its size. A
bucket of n nodes that are alike in a band but in nothing else needs its n^2/2 comparisons.
The texts of nodes in shared buckets are reached by a broadcast of their (doc_id, hash) if
these are measured to be small, else behind a Bloom filter of them (``bloom.joined``), so few other texts are shuffled.

Defined cases: a null text counts as empty; empty and wordless texts form a
class only with equal texts; a class is named by its smallest doc_id (null if
all are null), and rows that share a doc_id keep their own texts' classes; the
kept row of a class is the one with the smallest (doc_id, text) and, of fully
equal rows, one. A very long text is one long weighted set, never cut; pairs of exactly
the threshold are linked; an empty table gives an empty one. Other columns pass through
unchanged, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import arrays
from strata.llm.bloom import joined
from strata.llm.components import components
from strata.llm.session import checkpointed, ship_code, sized

SHINGLE = 5
SIMILARITY = 0.8
MISS = 1e-4  # a pair at the threshold meets in no band with at most this probability
BLOCK, BLOCK_BYTES = 1024, 8 << 20
U64 = np.uint64


class Settings(NamedTuple):
    similarity: float
    k: int
    bands: int
    rows: int


def settings(similarity: float = SIMILARITY, miss: float = MISS) -> Settings:
    """The fewest coordinates, and of these the longest bands (of three rows at least), that keep the miss."""
    for k in (128, 256, 512, 1024, 2048):
        for rows in range(16, 2, -1):
            if (1 - similarity**rows) ** (k // rows) <= miss:
                return Settings(similarity, k, k // rows, rows)
    raise ValueError("no bands for so low a similarity")


def shingles(w: arrays.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, element hash, weight, first entry of each document) of the weighted sets, by document and hash."""
    words = w.hashes()
    full = arrays.roll(words, SHINGLE)
    at = np.flatnonzero(arrays.in_one_text(w.doc, SHINGLE))
    doc, h = w.doc[at], full[at]
    for n in range(1, SHINGLE):
        short = np.flatnonzero(w.count == n)
        if len(short):
            doc = np.concatenate([doc, short])
            h = np.concatenate([h, arrays.roll(words, n)[w.first[short]]])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    weight = np.diff(np.append(first, len(h)))
    doc, h = doc[first], h[first]
    return doc, h, weight.astype(np.float64), np.searchsorted(doc, np.arange(len(w.count) + 1))


def _poisson_table(area: float) -> np.ndarray:
    terms, p, k = [], math.exp(-area), 0
    while k < area or p > 1e-18:
        terms.append(p)
        k += 1
        p *= area / k
    return np.cumsum(terms)


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> U64(11)).astype(np.float64) * (1.0 / (1 << 53))


def dart_signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, k: int = 128) -> np.ndarray:
    """One row of ``k`` 32-bit dart names per document; rows without elements are zeros.

    Weights are positive reals. A row's darts come from its own elements only,
    so equal weighted sets give equal rows in any batch.
    """
    out = np.full(n_docs * k, np.iinfo(np.uint64).max, dtype=U64)
    total = np.bincount(doc, weights=weight, minlength=n_docs)
    open_docs = np.flatnonzero(total > 0)
    darts = k * math.log(k) + 2 * k
    while len(open_docs):
        reach = np.zeros(n_docs)
        reach[open_docs] = darts / total[open_docs]
        _throw(doc, element, weight, reach, k, out)
        empty = (out.reshape(n_docs, k)[open_docs] == np.iinfo(np.uint64).max).any(axis=1)
        open_docs = open_docs[empty]
        out.reshape(n_docs, k)[open_docs] = np.iinfo(np.uint64).max
        darts *= 2
    name = (out & U64(0xFFFFFFFF)).astype(np.uint32).reshape(n_docs, k)
    name[total == 0] = 0
    return name


def _throw(doc, element, weight, reach, k, out) -> None:
    """Lower ``out`` (rank and name of the best dart per document and coordinate) by all darts up to each document's reach."""
    limit = reach[doc]
    w_low, w_high = 0.0, 1.0
    while True:
        heavy = np.flatnonzero((weight > w_low) & (limit > 0))
        if not len(heavy):
            return
        r_low, r_high = 0.0, 1.0 / 32
        live = heavy
        while True:
            live = live[limit[live] > r_low]
            if not len(live):
                break
            region = U64((hash_region(w_low, r_low)))
            seed = arrays.mix(element[live] ^ region)
            count = np.searchsorted(_table((w_high - w_low) * (r_high - r_low)), _unit(seed), side="right")
            some = np.flatnonzero(count)
            n = count[some]
            e = live[np.repeat(some, n)]
            h = arrays.mix(np.repeat(seed[some], n) + (arrays.spread(n).astype(U64) + U64(1)) * arrays.BASE)
            h2 = arrays.mix(h + U64(0x632BE59BD9B4E019))
            rank = r_low + (r_high - r_low) * ((h >> U64(32)).astype(np.float64) / (1 << 32))
            hit = rank < limit[e]
            if w_low > 0 or (weight[e] < w_high).any():
                hit &= w_low + (w_high - w_low) * ((h2 >> U64(32)).astype(np.float64) / (1 << 32)) < weight[e]
            hit = np.flatnonzero(hit)
            e, h, h2, rank = e[hit], h[hit], h2[hit], rank[hit]
            coordinate = ((h2 & U64(0xFFFFFFFF)) * U64(k)) >> U64(32)
            packed = (rank.astype(np.float32).view(np.uint32).astype(U64) << U64(32)) | (h & U64(0xFFFFFFFF))
            np.minimum.at(out, doc[e] * k + coordinate.astype(np.int64), packed)
            r_low, r_high = r_high, 2 * r_high
        w_low, w_high = w_high, 2 * w_high


def hash_region(w_low: float, r_low: float) -> int:
    bits = np.array([w_low, r_low]).view(np.uint64)
    return int(arrays.mix(arrays.mix(bits[:1] + U64(1)) ^ bits[1:])[0])


_tables: dict[float, np.ndarray] = {}


def _table(area: float) -> np.ndarray:
    if area not in _tables:
        _tables[area] = _poisson_table(area)
    return _tables[area]


def node_names(w: arrays.Words, data: np.ndarray, at: np.ndarray) -> list[bytes]:
    """16 bytes per document: equal for equal word sequences, or, without words, for equal texts."""
    out = np.zeros((len(at) - 1, 2), dtype=U64)
    for which in (0, 1):
        h = w.hashes(which)
        out[:, which] = _sequence_hash(h, w.first)
        none = np.flatnonzero(w.count == 0)
        if len(none):
            out[none, which] = arrays.segment_hash(data, at[none], at[none + 1], which) ^ U64(0x5DEECE66D)
    raw = out.tobytes()
    return [raw[i : i + 16] for i in range(0, len(raw), 16)]


def _sequence_hash(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each run h[first[i]:first[i+1]]; the order counts."""
    up, down = arrays.powers(len(h))
    sums = np.zeros(len(h) + 1, dtype=U64)
    np.cumsum(h * up[: len(h)], out=sums[1:])
    return arrays.mix((sums[first[1:]] - sums[first[:-1]]) * down[first[:-1]] + np.diff(first).astype(U64) * U64(0xD6E8FEB86659FD93))


def _base(s: Settings):
    """Every row's node; the signature with the first row of a node in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[bytes] = set()
            for lo, hi, data, at in arrays.chunks(batch["text"]):
                w = arrays.Words(data, at)
                nodes = node_names(w, data, at)
                mine = []
                for i, (x, c) in enumerate(zip(nodes, w.count.tolist())):
                    if c and x not in seen:
                        seen.add(x)
                        mine.append(i)
                sig: list[bytes | None] = [None] * len(nodes)
                sizes = [0] * len(nodes)
                if mine:
                    doc, h, weight, first = shingles(w)
                    sizes = np.diff(first).tolist()
                    keep = np.zeros(len(nodes), dtype=bool)
                    keep[mine] = True
                    live = keep[doc]
                    made = dart_signatures(doc[live], h[live], weight[live], len(nodes), s.k)
                    for i in mine:
                        sig[i] = made[i].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(lo, hi - lo), batch["k"].slice(lo, hi - lo), pa.array(nodes, pa.binary()), pa.array(sig, pa.binary()), pa.array(sizes, pa.int32())],
                    ["doc_id", "k", "node", "sig", "size"],
                )

    return run


def band_keys(sig: np.ndarray, s: Settings) -> np.ndarray:
    """(documents, bands) 64-bit keys of 32-bit signatures."""
    out = np.empty((len(sig), s.bands), dtype=U64)
    for b in range(s.bands):
        acc = np.full(len(sig), b + 1, dtype=U64)
        for r in range(s.rows):
            acc = arrays.mix(acc * arrays.BASE + sig[:, b * s.rows + r].astype(U64))
        out[:, b] = acc
    return out


def _bands(s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            sig = np.frombuffer(b"".join(batch["sig"].to_pylist()), dtype=np.uint32).reshape(-1, s.k)
            rows = pa.array(np.repeat(np.arange(len(sig)), s.bands))
            yield pa.RecordBatch.from_arrays(
                [pa.array(arrays.signed(band_keys(sig, s).ravel())), batch["node"].take(rows), batch["size"].take(rows)], ["key", "node", "size"]
            )

    return run


def _groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """The rows of each group of a partition that is sorted by the columns ``by``."""
    rest: pa.Table | None = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        now = pa.concat_tables([rest, now]).combine_chunks() if rest is not None else now
        keys = np.stack([now[c].to_numpy() for c in by]) if len(now) else np.zeros((len(by), 0), dtype=np.int64)
        starts = np.append(0, np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1) if len(now) else np.zeros(1, dtype=np.int64)
        for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
            yield now.slice(s, e - s)
        rest = now.slice(int(starts[-1]))
    if rest is not None and len(rest):
        yield rest


def _by_head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The groups of a partition in which each group starts with a row marked ``head``."""
    rest: pa.Table | None = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        now = pa.concat_tables([rest, now]).combine_chunks() if rest is not None else now
        starts = np.flatnonzero(now["head"].to_numpy())
        for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
            yield now.slice(s, e - s)
        rest = now.slice(int(starts[-1])) if len(starts) else now
    if rest is not None and len(rest):
        yield rest


def _pairs(found: Iterator[tuple[list[bytes], list[bytes]]]) -> Iterator[pa.RecordBatch]:
    """Batches of pairs, each pair's smaller name first."""
    a: list[bytes] = []
    b: list[bytes] = []
    for x, y in found:
        a += [min(p) for p in zip(x, y)]
        b += [max(p) for p in zip(x, y)]
        if len(a) >= 1 << 15:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])
            a, b = [], []
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


class Sets:
    """The weighted sets of a group's rows, one after another."""

    def __init__(self, group: pa.Table):
        h, w = group["h"].to_pylist(), group["w"].to_pylist()
        self.nodes = group["node"].to_pylist()
        self.size = np.array([len(x) // 8 for x in h], dtype=np.int64)
        self.end = np.cumsum(self.size)
        self.first = self.end - self.size
        self.h = np.frombuffer(b"".join(h), dtype=U64)
        self.w = np.frombuffer(b"".join(y or np.ones(n, np.uint32).tobytes() for y, n in zip(w, self.size.tolist())), dtype=np.uint32).astype(np.int64)
        self.total = np.add.reduceat(self.w, self.first)

    def alike(self, common: np.ndarray, i: int, similarity: float) -> np.ndarray:
        """Which rows are linked to row i, from the sums of minima: common / (a + b - common) >= similarity, in whole numbers."""
        return round(similarity * 1000) * (self.total + self.total[i] - common) <= 1000 * common


def _stars(s: Settings):
    """The verified links of each group's first row to the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges() -> Iterator[tuple[list[bytes], list[bytes]]]:
            for group in _by_head(batches):
                sets = Sets(group)
                x, p = sets.h[: sets.size[0]], sets.w[: sets.size[0]]
                at = np.minimum(np.searchsorted(x, sets.h), len(x) - 1)
                common = np.add.reduceat(np.where(x[at] == sets.h, np.minimum(sets.w, p[at]), 0), sets.first)
                hit = np.flatnonzero(sets.alike(common, 0, s.similarity))
                hit = hit[hit > 0]
                yield [sets.nodes[0]] * len(hit), [sets.nodes[j] for j in hit.tolist()]

        return _pairs(edges())

    return run


def _across(s: Settings):
    """Per pair of blocks, verified edges that join what its pairs join; pairs within a component are passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges() -> Iterator[tuple[list[bytes], list[bytes]]]:
            for group in _groups(batches, ["key", "x", "y"]):
                block, x, y = group["block"].to_numpy(), group["x"][0].as_py(), group["y"][0].as_py()
                left, right = np.flatnonzero(block == x), np.flatnonzero(block == y)
                _, part = np.unique(group["c"].to_pylist(), return_inverse=True)
                if not len(left) or not len(right) or len(np.unique(part)) < 2:
                    continue
                sets = Sets(group)
                few, many = (left, right) if len(left) < len(right) else (right, left)
                _, element = np.unique(sets.h, return_inverse=True)
                weight = np.zeros(int(element.max()) + 1, dtype=np.int64)
                of_many = np.zeros(len(block), dtype=bool)
                of_many[many] = True
                a, b = [], []
                for i in few.tolist():
                    open_ = of_many & (part != part[i])
                    if x == y:
                        open_[: i + 1] = False
                    if not open_.any():
                        continue
                    mine = slice(sets.first[i], sets.end[i])
                    weight[element[mine]] = sets.w[mine]
                    common = np.add.reduceat(np.minimum(sets.w, weight[element]), sets.first)
                    weight[element[mine]] = 0
                    for j in np.flatnonzero(open_ & sets.alike(common, i, s.similarity)).tolist():
                        if part[j] != part[i]:
                            part[part == part[j]] = part[i]
                            a.append(sets.nodes[i])
                            b.append(sets.nodes[j])
                yield a, b

        return _pairs(edges())

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, at in arrays.chunks(batch["text"]):
            w = arrays.Words(data, at)
            _, h, weight, first = shingles(w)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["node"].slice(lo, hi - lo),
                    pa.array([h[s:e].tobytes() for s, e in zip(first[:-1], first[1:])], pa.binary()),
                    pa.array([weight[s:e].astype(np.uint32).tobytes() if (weight[s:e] > 1).any() else b"" for s, e in zip(first[:-1], first[1:])], pa.binary()),
                ],
                ["node", "h", "w"],
            )


def _blocks(count: Column, elements: Column) -> Column:
    return F.greatest(F.ceil(count / F.lit(BLOCK)), F.ceil(elements * 12 / F.lit(BLOCK_BYTES)), F.lit(1)).cast("int")


def _number(blocks: Column) -> Column:
    return F.pmod(F.xxhash64("node"), blocks).cast("int")


def _in_stars(pairs: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """The links among ``pairs`` (rep, node, blocks); each block of a star holds its centre once."""
    heads = pairs.select("rep", "blocks").distinct().withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = (
        pairs.withColumns({"block": _number(F.col("blocks")), "head": F.lit(False)})
        .select("rep", "blocks", "block", "head", "node")
        .unionByName(heads.select("rep", "blocks", "block", F.lit(True).alias("head"), F.col("rep").alias("node")))
    )
    return (
        dealt.join(sets, "node")
        .repartition("rep", "blocks", "block")
        .sortWithinPartitions("rep", "blocks", "block", F.col("head").desc(), "node")
        .select("head", "node", "h", "w")
        .mapInArrow(_stars(s), "a binary, b binary")
    )


def _open_buckets(members: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members with their component c; the buckets whose members, without the star's centre, are in several components)."""
    placed = members.join(found, "node", "left").select("key", "node", "size", F.coalesce("component", "node").alias("c"))
    parts = placed.groupBy("key", "c").agg(
        F.count(F.lit(1)).alias("m"),
        F.sum(F.col("size").cast("long")).alias("e"),
        F.bit_xor(F.xxhash64("node")).alias("f1"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("f2"),
    )
    several = (
        parts.groupBy("key")
        .agg(
            F.max(F.struct("m", "e", "c")).alias("top"),
            F.sum("m").alias("n"),
            F.sum("e").alias("elements"),
            F.bit_xor("f1").alias("f1"),
            F.bit_xor("f2").alias("f2"),
            F.count(F.lit(1)).alias("parts"),
        )
        .where("parts > 1")
        .groupBy("n", "f1", "f2")
        .agg(F.min(F.struct("key", "top", "n", "elements")).alias("one"))
        .select("one.*")
    )
    many = _blocks(F.col("top.m"), F.col("top.e"))
    rest = _blocks(F.col("n") - F.col("top.m"), F.col("elements") - F.col("top.e"))
    return placed, checkpointed(several.select("key", F.col("top.c").alias("most"), many.alias("many"), rest.alias("rest")))


def _in_blocks(placed: DataFrame, buckets: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """Links across components. Blocks 0..many-1 hold the largest component, the next ``rest`` all others;
    x <= y are the two blocks a task compares, at least one of them of the others."""
    last = F.col("many") + F.col("rest") - 1
    stray = F.col("c") != F.col("most")
    return (
        placed.join(buckets, "key")
        .withColumn("block", F.when(stray, F.col("many") + _number(F.col("rest"))).otherwise(_number(F.col("many"))))
        .withColumn("other", F.explode(F.sequence(F.when(stray, F.lit(0)).otherwise(F.col("many")), last)))
        .select("key", "node", "c", "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))
        .join(sets, "node")
        .repartition("key", "x", "y")
        .sortWithinPartitions("key", "x", "y", "node")
        .mapInArrow(_across(s), "a binary, b binary")
    )


def linked(documents: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(doc_id, k, node) of every row; (node, component) of the nodes linked to another one."""
    ship_code(documents.sparkSession)
    s = settings(similarity)
    keyed = documents.select("doc_id", "text", F.xxhash64("text").alias("k"))
    kind = keyed.schema["doc_id"].dataType.simpleString()
    base = checkpointed(keyed.mapInArrow(_base(s), f"doc_id {kind}, k long, node binary, sig binary, size int"))
    rows = base.select("doc_id", "k", "node")
    signatures = base.where("sig IS NOT NULL").groupBy("node").agg(F.first("sig").alias("sig"), F.first("size").alias("size"))

    # Keys that one node alone has go no further than a partial count; of buckets with the same nodes one stays.
    banded = signatures.mapInArrow(_bands(s), "key long, node binary, size int")
    buckets = (
        banded.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("size").cast("long")).alias("elements"),
            F.min("node").alias("rep"),
            F.bit_xor(F.xxhash64("node")).alias("f1"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("f2"),
        )
        .where("n > 1")
        .groupBy("n", "elements", "rep", "f1", "f2")
        .agg(F.min("key").alias("key"))
        .select("key", "rep", _blocks(F.col("n"), F.col("elements")).alias("blocks"))
    )
    members = checkpointed(banded.join(buckets, "key").where("node <> rep"))
    pairs = checkpointed(members.groupBy("rep", "node").agg(F.max("blocks").alias("blocks")))
    involved = pairs.select("node").unionByName(pairs.select(F.col("rep").alias("node"))).distinct()
    # One text of each node in a shared bucket, as a weighted set.
    one = rows.groupBy("node").agg(F.min(F.struct("doc_id", "k")).alias("r")).join(involved, "node")
    one = one.select("node", F.col("r.doc_id").alias("id"), F.col("r.k").alias("hash"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("k") == F.col("hash"))
    text = joined(keyed, one, same, "inner", F.xxhash64("doc_id", "k"), F.xxhash64("id", "hash"))
    sets = checkpointed(text.select("node", "text").mapInArrow(_sets, "node binary, h binary, w binary").dropDuplicates(["node"]))

    found = components(_in_stars(pairs, sets, s))
    placed, open_ = _open_buckets(members, found)
    if open_.isEmpty():
        return rows, found
    more = _in_blocks(placed, open_, sets, s)
    return rows, components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))


def classes(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``documents``: doc_id, k (hash of the text), class_id, n_class (rows), kept."""
    rows, found = linked(documents, similarity)
    place = F.struct(F.isnull("doc_id").alias("n"), F.col("doc_id"), F.col("k"))
    # Copies are folded into their node before anything is joined.
    nodes = rows.groupBy("node").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("copies"))
    named = nodes.join(found, "node", "left").withColumn("class", F.coalesce("component", "node"))
    heads = named.groupBy("class").agg(F.min("first").alias("head"), F.sum("copies").alias("n_class"))
    return (
        rows.join(named.join(heads, "class").select("node", "head", "n_class"), "node")
        .select("doc_id", "k", F.col("head.doc_id").alias("class_id"), "n_class", (place == F.col("head")).alias("kept"))
    )


def deduplicated(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The kept row of each class, with all columns of ``documents``."""
    names = documents.columns
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_strata_row")).withColumn(
        "_strata_k", F.xxhash64("_strata_row.text")
    )
    # Rows that share doc_id and text share their class; what is looked up is the rows that go.
    each = classes(documents, similarity).groupBy("doc_id", "k").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("copies"))
    each = checkpointed(each.where("NOT kept OR copies > 1"))
    gone = each.where("NOT kept").select("doc_id", "k")
    same = F.col("_strata_row.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("_strata_k") == F.col("k"))
    hashes = F.xxhash64(F.col("_strata_row.doc_id"), F.col("_strata_k")), F.xxhash64("doc_id", "k")
    out = joined(rows, gone, same, "left_anti", *hashes)
    again = each.where("kept").select("doc_id", "k")
    if not again.isEmpty():  # of rows that share doc_id and text one stays
        again = sized(again)
        same = out["_strata_row"]["doc_id"].eqNullSafe(again["doc_id"]) & (out["_strata_k"] == again["k"])
        order = Window.partitionBy("_strata_row.doc_id", "_strata_k").orderBy(F.xxhash64(F.to_json("_strata_row")))
        first = out.join(again, same, "left_semi").withColumn("_strata_n", F.row_number().over(order)).where("_strata_n = 1").drop("_strata_n")
        out = out.join(again, same, "left_anti").unionByName(first)
    return out.select(*[F.col(f"_strata_row.`{c}`").alias(c) for c in names])


def op9_minhash_near_dedup(documents: DataFrame) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the class), n_class (documents in it), kept."""
    return classes(documents).select("doc_id", "class_id", "n_class", "kept")
