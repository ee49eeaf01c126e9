"""Embedding near-dedup by lattice hashing: E8 points of random projections, verified cosines.

A vector of length one is projected on 16 random orthonormal directions per
table, scaled, and decoded to the nearest point of the E8 lattice in each block
of eight; the pair of points is its cell. Cells close to a vector's projection
are probed as well: of those that differ in one block by one of the 240 shortest lattice
vectors the ``PROBES`` nearest. Two vectors meet in a table if one's cell is the
other's cell or among its probes. Cells are the finer the more
vectors the largest label has (``cell_scale``), so that the
number of chance meetings of a vector stays the same; the number of tables
follows from the share of pairs at the threshold that meet in one, which is measured
on made-up pairs (``tables_for``): all tables together miss at most ``MISS`` of them.

From cells to links, without emitting the pairs of a group:

1. Probed cells that are nobody's own are dropped by a broadcast Bloom filter while that is small.
2. A vector stays in a cell if it has a mate there, one of the two being at home, whose
   128 projection signs differ in at most ``SIGNS`` places (8 are expected at a cosine of 0.98, 64 by
   chance; over 36 have a probability of 1e-13). That is two semi-joins, which stop at the first mate.
3. The few that stay are compared in their cell's task: cosines by matrix products in double precision.
   Of cells that hold the same vectors, all at home, one is looked at.
   A pair that meets in several cells counts in the first of them, which both
   vectors' lists of cells tell. A task emits a count for each vector and edges that connect
   what is linked, not the links. A cell of over ``BLOCK`` vectors is dealt over tasks as pairs of blocks.
4. Components of the edges.

Equal vectors of a label are folded into one node before hashing, so a vector
that a third of all rows share is hashed once and its copies are counted, not
joined. The number of a vector's links is asked for, so n near copies that all differ cost n^2/2
cosines, and n/BLOCK shipments of each; rows written grow with n.

Defined cases: a vector that is null, empty, zero, or has a null or non-finite
component, and a row without label, link with nothing and are their own
component; only vectors of equal length are compared; a cosine of exactly 0.98, as doubles give it, is a
link; very long vectors are handled whole; rows are counted one by
one even if they share a vec_id; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import arrays
from strata.llm.bloom import bloom
from strata.llm.components import components
from strata.llm.session import checkpointed, ship_code, sized

COSINE = 0.98
MISS = 1e-6
BLOCKS = 2
PROBES = 8
SIGNS = 36
SEED = 20240
BLOCK = 2048


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of size one, or eight halves with an even number of minus signs."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


ROOTS = _roots()


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """The nearest points with whole coordinates of even sum."""
    p = np.rint(x)
    odd = np.flatnonzero(p.sum(axis=1) % 2)
    worst = np.abs(x[odd] - p[odd]).argmax(axis=1)
    p[odd, worst] += np.where(x[odd, worst] >= p[odd, worst], 1, -1)
    return p


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The E8 points nearest to the rows of x (n, 8): the better of D8 and D8 shifted by one half."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    nearer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(nearer[:, None], a, b)


@lru_cache(maxsize=16)
def projections(dimension: int, tables: int) -> np.ndarray:
    """(tables, dimension, 8 * BLOCKS) directions, orthonormal within a table as far as the dimension allows, of unit spread."""
    rng = np.random.default_rng([SEED, dimension])
    out = []
    for _ in range(tables):
        g = rng.normal(size=(dimension, 8 * BLOCKS))
        q = np.linalg.qr(g)[0] if dimension >= 8 * BLOCKS else g / np.linalg.norm(g, axis=0)
        out.append(q * np.sqrt(dimension))
    return np.array(out)


# A point's hash is linear in its coordinates, so a neighbour's is the point's plus the step's.
_MULTIPLIERS = arrays.mix((np.arange(8 * BLOCKS, dtype=np.uint64) + np.uint64(5)) * arrays.BASE).reshape(BLOCKS, 8) | np.uint64(1)
_STEPS = (np.rint(2 * ROOTS).astype(np.int64).astype(np.uint64)[None] * _MULTIPLIERS[:, None, :]).sum(axis=2, dtype=np.uint64)


def cells(unit: np.ndarray, tables: int, scale: float, probes: int = PROBES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per table the hash of each vector's cell (n) and of the cells it probes (n, probes)."""
    n = len(unit)
    for q in projections(unit.shape[1], tables):
        y = (unit @ q).reshape(n * BLOCKS, 8) / scale
        point = nearest_e8(y)
        far = (2 - 2 * (y - point) @ ROOTS.T).reshape(n, -1)  # how much further each neighbour is
        near = np.argpartition(far, probes, axis=1)[:, :probes]
        whole = np.rint(2 * point).astype(np.int64).astype(np.uint64).reshape(n, BLOCKS, 8)
        home = (whole * _MULTIPLIERS).sum(axis=(1, 2), dtype=np.uint64)
        yield home, home[:, None] + _STEPS.reshape(-1)[near]


def cell_scale(largest_label: int) -> float:
    """The cell's size against the projections' spread.

    The probability of a chance meeting goes with the cell's volume, its sixteenth power; the root is
    the fourteenth, since finer cells need more tables.
    """
    return float(np.clip(1.5 * (1e6 / max(1, largest_label)) ** (1 / 14), 0.8, 2.4))


@lru_cache(maxsize=64)
def recall(dimension: int, scale: float, probes: int = PROBES) -> float:
    """The share of pairs of exactly the threshold that meet in one table, measured on made-up pairs."""
    rng = np.random.default_rng([SEED, dimension, 1])
    a = rng.normal(size=(1000, dimension))
    a /= np.linalg.norm(a, axis=1)[:, None]
    if dimension == 1:
        return 1.0
    side = rng.normal(size=a.shape)
    side -= (side * a).sum(axis=1)[:, None] * a
    b = COSINE * a + np.sqrt(1 - COSINE**2) * side / np.linalg.norm(side, axis=1)[:, None]
    found = []
    for (ha, pa_), (hb, pb) in zip(cells(a, 2, scale, probes), cells(b, 2, scale, probes)):
        found.append((ha == hb) | (pa_ == hb[:, None]).any(axis=1) | (pb == ha[:, None]).any(axis=1))
    return float(np.mean(found))


def tables_for(dimension: int, scale: float, miss: float = MISS) -> int:
    """As many tables as let at most ``miss`` of the pairs at the threshold meet in none."""
    q = min(recall(dimension, scale), 0.995)  # two thousand pairs do not measure more
    return max(1, math.ceil(math.log(miss) / math.log(1 - q)))


@lru_cache(maxsize=16)
def _sign_directions(dimension: int) -> np.ndarray:
    return np.random.default_rng([SEED, dimension, 2]).normal(size=(dimension, 128))


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's node (16 bytes of label and vector; null if it can't link) and its vector's bytes."""
    for batch in batches:
        lists, labels = batch["vector"], batch["label"].to_pylist()
        size = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        flat = lists.flatten()
        holes = flat.is_null().to_numpy(zero_copy_only=False)
        values = flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=True)
        values[holes] = np.nan
        values += 0.0  # one zero
        end = np.cumsum(size)
        some = np.flatnonzero(size > 0)
        good = np.zeros(len(size), dtype=bool)
        if len(some):
            first = (end - size)[some]
            with np.errstate(over="ignore", invalid="ignore"):
                most = np.maximum.reduceat(np.abs(values), first)
                square = np.add.reduceat(values * values, first)
            good[some] = np.isfinite(most) & (most > 0)
            # Very large or small: the same direction, whose square neither overflows nor vanishes.
            for k in np.flatnonzero(good[some] & ~((square > 1e-200) & (square < 1e200))).tolist():
                values[first[k] : end[some[k]]] /= most[k]
        raw = values.tobytes()
        nodes: list[bytes | None] = [None] * len(size)
        vectors: list[bytes | None] = [None] * len(size)
        for i in np.flatnonzero(good).tolist():
            if labels[i] is not None:
                vectors[i] = raw[8 * (end[i] - size[i]) : 8 * end[i]]
                nodes[i] = hashlib.blake2b(labels[i].encode() + b"\0" + vectors[i], digest_size=16).digest()
        yield pa.RecordBatch.from_arrays(
            [batch["vec_id"], batch["label"], pa.array(nodes, pa.binary()), pa.array(vectors, pa.binary())], ["vec_id", "label", "node", "vector"]
        )


def _hashed(scale: float):
    """Each node's cells, own and probed, and its signs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch["vector"].to_pylist()
            group = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "big") for x in batch["label"].to_pylist()], dtype=np.uint64)
            sizes = np.array([len(x) // 8 for x in raw], dtype=np.int64)
            for size in np.unique(sizes).tolist():
                mine = np.flatnonzero(sizes == size)
                tables = tables_for(size, scale)
                for lo in range(0, len(mine), 1024):
                    rows = mine[lo : lo + 1024]
                    v = np.frombuffer(b"".join(raw[i] for i in rows), dtype=np.float64).reshape(len(rows), size)
                    unit = v / np.linalg.norm(v, axis=1)[:, None]
                    homes, probed = [], []
                    for table, (home, near) in enumerate(cells(unit, tables, scale)):
                        seed = arrays.mix(group[rows] + np.uint64(size * 4096 + table))
                        homes.append(arrays.mix(home + seed))
                        probed.append(arrays.mix(near + seed[:, None]))
                    homes, probed = np.stack(homes, axis=1), np.concatenate(probed, axis=1)
                    signs = np.packbits(unit @ _sign_directions(size) > 0, axis=1).view(np.int64)
                    lists = [pa.FixedSizeListArray.from_arrays(pa.array(arrays.signed(np.ascontiguousarray(x).ravel())), x.shape[1]) for x in (homes, probed)]
                    yield pa.RecordBatch.from_arrays(
                        [batch["node"].take(pa.array(rows)), pa.array(signs[:, 0]), pa.array(signs[:, 1]), *(x.cast(pa.list_(pa.int64())) for x in lists)],
                        ["node", "s1", "s2", "homes", "probed"],
                    )

    return run


def _placed(shared):
    """A row for each node and cell: its own, and the probed ones that may be some vector's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in ("homes", "probed"):
                cell = batch[name].flatten().to_numpy()
                row = np.repeat(np.arange(len(batch)), batch[name].value_lengths().to_numpy())
                if name == "probed":
                    keep = shared.value.passes(cell.view(np.uint64))
                    cell, row = cell[keep], row[keep]
                rows = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell), pa.array(np.full(len(row), name == "homes")), *(batch[c].take(rows) for c in ("node", "s1", "s2"))],
                    ["cell", "home", "node", "s1", "s2"],
                )

    return run


def _mates(some: DataFrame, others: DataFrame) -> DataFrame:
    """The rows of ``some`` with a mate of like signs among ``others`` in their cell."""
    o = others.select(F.col("cell").alias("c2"), F.col("node").alias("n2"), F.col("s1").alias("t1"), F.col("s2").alias("t2"))
    differ = F.bit_count(F.col("s1").bitwiseXOR(F.col("t1"))) + F.bit_count(F.col("s2").bitwiseXOR(F.col("t2")))
    return some.join(o, (F.col("cell") == F.col("c2")) & (F.col("node") != F.col("n2")) & (differ <= SIGNS), "left_semi")


class _Rows:
    """A batch's columns as arrays and lists, made once for all of its groups."""

    def __init__(self, table: pa.Table):
        self.key = [table[c].to_numpy() for c in ("cell", "x", "y")]
        self.block, self.copies = table["block"].to_numpy(), table["copies"].to_numpy()
        self.node, self.raw = table["node"].to_pylist(), table["vector"].to_pylist()
        lists = table["cells"].combine_chunks()
        self.end = np.cumsum(lists.value_lengths().to_numpy())
        entry = lists.flatten()
        self.where, self.home = entry.field("cell").to_numpy(), entry.field("home").to_numpy(zero_copy_only=False)

    def starts(self) -> np.ndarray:
        """Where a new (cell, x, y) begins."""
        change = np.zeros(len(self.node), dtype=bool)
        change[:1] = True
        for k in self.key:
            change[1:] |= k[1:] != k[:-1]
        return np.flatnonzero(change)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per cell or pair of its blocks: (node, null, links that count here) and (a, b, null) edges that connect what is linked."""
    out: list[tuple] = []

    def batch() -> pa.RecordBatch:
        a, b, n = zip(*out) if out else ((), (), ())
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(n, pa.int64())], ["a", "b", "n"])

    def groups(rows: _Rows, starts: list[int], end: int) -> None:
        for s, e in zip(starts, [*starts[1:], end]):
            sizes = {len(x) for x in rows.raw[s:e]}
            for size in sizes:  # one, but for a collision of hashes
                out.extend(_within(rows, [k for k in range(s, e) if len(sizes) == 1 or len(rows.raw[k]) == size]))

    rest: pa.Table | None = None
    for given in batches:
        now = pa.Table.from_batches([given])
        now = pa.concat_tables([rest, now]).combine_chunks() if rest is not None else now
        rows = _Rows(now)
        starts = rows.starts()
        if len(starts) > 1:
            groups(rows, starts[:-1].tolist(), int(starts[-1]))
        rest = now.slice(int(starts[-1])) if len(starts) else None
        if len(out) > 1 << 15:
            yield batch()
    if rest is not None and len(rest):
        groups(_Rows(rest.combine_chunks()), [0], len(rest))
    yield batch()


def _within(rows: _Rows, mine: list[int]) -> list[tuple]:
    at = np.array(mine)
    cell, x, y = (int(k[mine[0]]) for k in rows.key)
    block, copies, nodes = rows.block[at], rows.copies[at], [rows.node[k] for k in mine]
    left, right = np.flatnonzero(block == x), np.flatnonzero(block == y)
    if len(mine) < 2 or not len(left) or not len(right):
        return []
    # Which of the cells before this one each vector is in, and at home in.
    first = np.where(at > 0, rows.end[at - 1], 0)
    length = rows.end[at] - first
    flat = np.repeat(first, length) + arrays.spread(length)
    row, where, home = np.repeat(np.arange(len(at)), length), rows.where[flat], rows.home[flat]
    here = np.zeros(len(at), dtype=bool)
    here[row[(where == cell) & home]] = True
    v = np.frombuffer(b"".join([rows.raw[k] for k in mine]), dtype=np.float64).reshape(len(mine), -1)
    norm = np.sqrt(np.einsum("ij,ij->i", v, v))
    early = where < cell
    used, number = np.unique(where[early], return_inverse=True)
    member = np.zeros((len(at), max(1, len(used))), dtype=np.float32)
    at_home = np.zeros_like(member)
    member[row[early], number] = 1
    at_home[row[early], number] = home[early]
    links = np.zeros(len(at), dtype=np.int64)
    part = np.arange(len(at))
    out: list[tuple] = []
    for lo in range(0, len(left), 256):
        i = left[lo : lo + 256]
        close = (v[i] @ v[right].T) / (norm[i][:, None] * norm[right]) >= COSINE
        close &= here[i][:, None] | here[right]
        if x == y:
            close &= i[:, None] < right
        if not close.any():
            continue
        # Connected here, whichever cell counts the pair.
        for k in np.flatnonzero(close.any(axis=1)).tolist():
            for p in set(part[right[close[k]]].tolist()):
                if p != part[i[k]]:
                    out.append((nodes[i[k]], nodes[p], None))
                    part[part == p] = part[i[k]]
        close &= ~((member[i] @ at_home[right].T + at_home[i] @ member[right].T) > 0)
        links[i] += close @ copies[right]
        links[right] += copies[i] @ close
    return out + [(nodes[k], None, int(links[k])) for k in np.flatnonzero(links).tolist()]


def _needed(members: DataFrame) -> DataFrame:
    """``members`` without cells that see nothing new: of cells with the same vectors one in which all are at home is enough."""
    cell = members.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("node")).alias("f1"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("f2"),
        F.min("home").alias("all_home"),
    )
    best = cell.groupBy("n", "f1", "f2").agg(
        F.min(F.when(F.col("all_home"), F.col("cell"))).alias("one"), F.collect_list("cell").alias("cells"), F.first("n").alias("size")
    )
    # Cells with the same vectors are at most tables * (1 + PROBES).
    keep = best.select(F.explode(F.when(F.col("one").isNotNull(), F.array("one")).otherwise(F.col("cells"))).alias("cell"), F.col("size").alias("crowd"))
    return checkpointed(members.join(sized(keep), "cell"))


def linked(embeddings: DataFrame, scale: float | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows: vec_id, node), (nodes: node, copies, first id), (a, b, n: edges, and counts of links where b is null)."""
    ship_code(embeddings.sparkSession)
    slim = embeddings.select(
        "vec_id", F.col("embedding").cast("array<double>").alias("vector"), F.col("label").cast("string").alias("label")
    )
    kind = slim.schema["vec_id"].dataType.simpleString()
    rows = checkpointed(slim.mapInArrow(_nodes, f"vec_id {kind}, label string, node binary, vector binary"))
    nodes = checkpointed(
        rows.where("node IS NOT NULL")
        .groupBy("node")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first_id"), F.first("label").alias("label"), F.first("vector").alias("vector"))
    )
    if scale is None:
        scale = cell_scale(nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0)
    hashed = checkpointed(
        nodes.select("node", "label", "vector").mapInArrow(_hashed(scale), "node binary, s1 long, s2 long, homes array<long>, probed array<long>")
    )
    shared = embeddings.sparkSession.sparkContext.broadcast(bloom(hashed.select(F.explode("homes").alias("h"))))
    placed = hashed.mapInArrow(_placed(shared), "cell long, home boolean, node binary, s1 long, s2 long")
    home, probe = placed.where("home"), placed.where("NOT home")
    stay = _mates(placed, home).unionByName(_mates(home, probe)).groupBy("cell", "node").agg(F.max("home").alias("home"))
    members = _needed(checkpointed(stay))

    number = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (
        members.select("cell", "node", F.ceil(F.col("crowd") / F.lit(BLOCK)).cast("int").alias("blocks"))
        .withColumn("block", number)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("cell", "node", "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))
    )
    # At most tables * (1 + PROBES) cells a node.
    info = members.groupBy("node").agg(F.collect_list(F.struct("cell", "home")).alias("cells")).join(nodes.select("node", "copies", "vector"), "node")
    found = (
        dealt.join(info, "node")
        .repartition("cell", "x", "y")
        .sortWithinPartitions("cell", "x", "y", "node")
        .mapInArrow(_linked, "a binary, b binary, n long")
        .groupBy("a", "b")
        .agg(F.sum("n").alias("n"))
    )
    return rows, nodes, checkpointed(found)


def near_duplicate_vectors(embeddings: DataFrame, scale: float | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept, one row per row of ``embeddings``."""
    rows, nodes, found = linked(embeddings, scale)
    near = found.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("near"))
    parts = components(found.where("b IS NOT NULL").select("a", "b"))
    named = nodes.select("node", "copies", "first_id").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    per_node = (
        named.join(lowest, "component")
        .join(near.withColumnRenamed("a", "node"), "node", "left")
        .select("node", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"), "component_id")
    )
    own = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return (
        rows.select("vec_id", "node")
        .join(per_node, "node", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"))
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )


def op2_lattice_near_dedup(embeddings: DataFrame) -> DataFrame:
    return near_duplicate_vectors(embeddings)


ORACLE_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
),
ok AS (
  SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS n FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND NOT list_contains([x IS NULL OR NOT isfinite(x) FOR x IN e], true)
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
  ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE a.n > 0 AND b.n > 0 AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.98
),
reach AS (
  SELECT a, b FROM links
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
),
lowest AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(degree.n, 0) AS n_links, least(v.vec_id, coalesce(lowest.b, v.vec_id)) AS component_id,
       v.vec_id = least(v.vec_id, coalesce(lowest.b, v.vec_id)) AS kept
FROM v LEFT JOIN degree ON v.vec_id = degree.a LEFT JOIN lowest ON v.vec_id = lowest.a
"""
