"""E8 decoding against exhaustive search, and classes against brute-force cosines."""

import itertools
import random

import numpy as np
import pytest
from conftest import TESTDATA, duck, rows_of, sorted_rows

from strata.llm import vector_dedup as vd

SCHEMA = "vec_id long, embedding array<float>, label int"


def test_the_nearest_lattice_point_is_found():
    rng = np.random.default_rng(1)
    x = rng.uniform(-1.5, 1.5, (300, 8))
    got = vd.nearest_e8(x)
    near = np.array(list(itertools.product((-2, -1, 0, 1, 2), repeat=4)), dtype=float)
    halves = 2 * got
    assert (np.abs(halves - np.rint(halves)) < 1e-9).all()
    whole = np.abs(got - np.rint(got)).max(axis=1) < 1e-9
    half = np.abs(got + 0.5 - np.rint(got + 0.5)).max(axis=1) < 1e-9
    assert (whole | half).all() and (got.sum(axis=1) % 2 == 0).all()
    assert (((x - got) ** 2).sum(axis=1) <= 1 + 1e-9).all()  # the covering radius of E8 is one
    # No lattice neighbour is nearer; the Voronoi cell is bounded by 240 + 2160 of them.
    second = [2 * np.eye(8)[i] * s for i in range(8) for s in (1, -1)]
    second += [np.array([*a, *b]) for a in near[np.abs(near).max(axis=1) <= 1] for b in near[np.abs(near).max(axis=1) <= 1] if (np.abs(a).sum() + np.abs(b).sum()) == 4]
    for v in [*vd.ROOTS, *second]:
        assert (((x - got) ** 2).sum(axis=1) <= ((x - got - v) ** 2).sum(axis=1) + 1e-9).all()


def test_the_shortest_vectors():
    assert len({tuple(v) for v in vd.ROOTS}) == 240
    assert np.allclose((vd.ROOTS**2).sum(axis=1), 2) and (vd.ROOTS.sum(axis=1) % 2 == 0).all()
    inner = vd.ROOTS @ vd.ROOTS.T
    assert set(np.unique(np.rint(inner))) == {-2, -1, 0, 1, 2} and np.allclose(inner, np.rint(inner))


def pairs_at_the_threshold(n, dim=64, seed=0):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(n, dim))
    a /= np.linalg.norm(a, axis=1)[:, None]
    side = rng.normal(size=a.shape)
    side -= (side * a).sum(axis=1)[:, None] * a
    return a, 0.98 * a + np.sqrt(1 - 0.98**2) * side / np.linalg.norm(side, axis=1)[:, None]


@pytest.mark.parametrize("largest", [10, 5000, 999_999, 1_000_001, 10**9])
def test_recall_at_the_threshold(largest):
    """Of all tables together, on pairs other than those that set their number; the same at every size."""
    a, b = pairs_at_the_threshold(1500)
    scale = vd.cell_scale(largest)
    tables = vd.tables_for(64, scale)
    found = []
    for (ha, pa), (hb, pb) in zip(vd.cells(a, tables, scale), vd.cells(b, tables, scale)):
        found.append((ha == hb) | (pa == hb[:, None]).any(axis=1) | (pb == ha[:, None]).any(axis=1))
    assert np.any(found, axis=0).all()
    assert abs(np.mean(found) - vd.recall(64, scale)) < 0.06  # the tables are alike
    signs = [np.packbits(x @ vd._sign_directions(64) > 0, axis=1) for x in (a, b)]
    assert np.unpackbits(signs[0] ^ signs[1], axis=1).sum(axis=1).max() <= vd.SIGNS


def test_settings_follow_the_size_without_a_step():
    sizes = [10**k for k in range(1, 11)] + [999_999, 1_000_000, 1_000_001]
    scales = [vd.cell_scale(n) for n in sorted(sizes)]
    assert scales == sorted(scales, reverse=True)
    assert abs(vd.cell_scale(999_999) - vd.cell_scale(1_000_001)) < 1e-6


def test_chance_meetings_follow_the_number_of_vectors(spark):
    """Candidates of random vectors of one label: in proportion, and few of them outlive the signs."""
    meetings, left = [], []
    for n in (4000, 8000, 16000):
        v = np.random.default_rng(n).normal(size=(n, 64))
        v /= np.linalg.norm(v, axis=1)[:, None]
        scale = vd.cell_scale(n)
        tables = vd.tables_for(64, scale)
        total = 0
        for home, near in vd.cells(v, tables, scale):
            own, times = np.unique(home, return_counts=True)
            at = np.minimum(np.searchsorted(own, near), len(own) - 1)
            total += (times * (times - 1) // 2).sum() + times[at][own[at] == near].sum()
        meetings.append(total)
        rows = spark.createDataFrame([(k, x.tolist(), 0) for k, x in enumerate(v.astype(np.float32))], SCHEMA)
        left.append(vd.linked(rows)[2].count())
    assert meetings[1] < 2.3 * meetings[0] and meetings[2] < 2.3 * meetings[1]
    assert max(left) == 0


def brute(rows):
    """vec_id -> (n_links, component_id, kept) for rows of distinct ids."""
    usable = {}
    for i, v, label in rows:
        if v and label is not None and None not in v and np.isfinite(v).all() and np.any(v):
            x = np.array(v, dtype=np.float64)
            x = x / np.abs(x).max()
            usable[i] = (label, x / np.linalg.norm(x))
    links = {i: set() for i, _, _ in rows}
    for a, b in itertools.combinations(usable, 2):
        (p, x), (q, y) = usable[a], usable[b]
        if p == q and len(x) == len(y) and x @ y >= 0.98:
            links[a].add(b)
            links[b].add(a)
    out = {}
    for i in links:
        reach, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - reach
            reach |= new
            todo += new
        out[i] = (len(links[i]), min(reach), i == min(reach))
    return out


def corpus(seed, dim=64):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(60):
        centre = rng.normal(size=dim)
        for _ in range(rng.integers(1, 6)):
            noise = rng.normal(size=dim)
            v = centre + noise * rng.choice([0.0, 0.02, 0.08, 0.12, 0.17]) * rng.choice([1, 1, 3])
            rows.append((v * rng.choice([1, 1, 2, 0.001])).astype(np.float32).tolist())
    label = [int(x) if x < 3 else None for x in rng.integers(0, 4, len(rows))]
    label = [0 if rng.random() < 0.7 else x for x in label]
    rows = [(k, v, x) for k, (v, x) in enumerate(zip(rows, label))]
    n = len(rows)
    extra = [
        None, [], [0.0] * dim, [None] * dim, [float("nan")] * dim, [float("inf")] + [1.0] * (dim - 1), [1.0, 2.0, 3.0], [1.0, 2.0, 3.01], rows[0][1], rows[0][1], [1e30] * dim, [1e30] * dim, [1e-40] * dim,
    ]
    return rows + [(n + k, v, 0) for k, v in enumerate(extra)] + [(n + 100, rows[0][1], None)]


@pytest.mark.parametrize("seed, scale, dim, block", [(1, None, 64, 2048), (2, 1.0, 64, 2048), (3, None, 64, 3), (4, None, 5, 2), (5, None, 1, 2048)])
def test_equals_brute_force(spark, monkeypatch, seed, scale, dim, block):
    monkeypatch.setattr(vd, "BLOCK", block)
    rows = corpus(seed, dim)
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS node", "1 AS n_links", "2 AS cell", "'c' AS cells").repartition(4)
    got = vd.near_duplicate_vectors(df, scale)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got.collect()} == brute(rows)


def test_a_large_group_emits_rows_in_proportion(spark, monkeypatch):
    """Near copies that all differ: every link is counted, in cells dealt over many tasks, and none is emitted."""
    monkeypatch.setattr(vd, "BLOCK", 50)
    rng = np.random.default_rng(8)
    v = rng.normal(size=64)
    emitted = {}
    for n in (200, 400):
        rows = [(k, (v + rng.normal(size=64) * 0.03).tolist(), 1) for k in range(n)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
        got = {r.vec_id: tuple(r)[1:] for r in vd.op2_lattice_near_dedup(df).collect()}
        assert got == {k: (n - 1, 0, k == 0) for k in range(n)}
        emitted[n] = vd.linked(df)[2].count()
    assert emitted[400] < 400 * 399 / 8


def test_a_vector_that_most_rows_share(spark):
    rng = np.random.default_rng(7)
    v = rng.normal(size=64)
    rows = [(k, v.tolist(), 1) for k in range(2000)] + [(2000 + k, (v + rng.normal(size=64) * 0.02).tolist(), 1) for k in range(5)]
    got = {r.vec_id: tuple(r)[1:] for r in vd.op2_lattice_near_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {k: (2004, 0, k == 0) for k in range(2005)}


def test_matches_the_oracle_on_test_data(spark):
    for sf in ("sf0.001", "sf0.1"):
        root = TESTDATA / sf
        got = rows_of(vd.op2_lattice_near_dedup(spark.read.parquet(f"{root}/embeddings.parquet")))
        want = duck(root).execute(vd.ORACLE_SQL)
        assert got == sorted_rows(want.fetchall())


def test_repeated_ids_and_an_empty_table(spark):
    rows = [(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (None, [1.0, 2.01], 0), (None, None, None)]
    got = [tuple(r) for r in vd.op2_lattice_near_dedup(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got, key=repr) == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 0, None, True)], key=repr)
    assert vd.op2_lattice_near_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
