"""One key in a third of all rows: the join that meets it is split, and results hold with and without broadcasts."""

import random

import pytest
from conftest import rows_of, spark_conf
from llm_fixtures import SCHEMA, prose, rows_from

from strata.llm import bloom, components, decontaminate, line_dedup, passages, session

# Small partitions count as skewed; nothing is broadcast.
SPLIT = {
    "spark.sql.shuffle.partitions": "40",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(session, "BROADCAST_BYTES", -1)
    with spark_conf(spark, SPLIT):
        yield


def hot_lines(rng, n=3000):
    """A third of all documents hold the same three lines."""
    hot = "the first hot line\nthe second hot line\nthe third hot line"
    return [(hot + "\n" if k % 3 == 0 else "") + "\n".join(f"{prose(rng, 3)} {k} {j}" for j in range(4)) for k in range(n)]


def test_a_hot_window_of_lines(spark, no_broadcast):
    texts = hot_lines(random.Random(1))
    docs = spark.createDataFrame(rows_from(texts), SCHEMA).repartition(8)
    gone = line_dedup.removals(docs)
    assert "skew=true" in final_plan(gone)
    assert gone.count() == 999  # all but the first
    left = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert left[0] == texts[0] and all(left[k] == texts[k][len("the first hot line\nthe second hot line\nthe third hot line\n") :] for k in range(3, 3000, 3))


def test_a_hot_passage(spark, no_broadcast):
    rng = random.Random(2)
    hot = prose(rng, 60, [f"h{k}" for k in range(500)])
    texts = [prose(rng, 8, [f"w{k}" for k in range(5000)]) + (" " + hot if k % 3 == 0 else "") + " " + prose(rng, 60, [f"v{k}" for k in range(5000)]) for k in range(900)]
    docs = spark.createDataFrame(rows_from(texts), SCHEMA).repartition(8)
    found = passages.repeats(docs)
    assert "skew=true" in final_plan(found)
    assert found.count() == 299


def test_a_hub(spark, no_broadcast):
    edges = spark.createDataFrame([(0, k) for k in range(1, 6000)] + [(k, k + 1) for k in range(10_000, 16_000, 2)], "a long, b long").repartition(8)
    assert "skew=true" in final_plan(components._large_star(edges))
    low = {r.node: r.component for r in components.components(edges).collect()}
    assert all(low[k] == 0 for k in range(6000)) and all(low[k] == low[k + 1] == k for k in range(10_000, 16_000, 2))


def test_a_hot_window_of_items(spark, no_broadcast):
    rng = random.Random(3)
    hot = prose(rng, 14)
    texts = [prose(rng, 20, [f"w{k}" for k in range(5000)]) + (" " + hot if k % 3 == 0 else "") for k in range(1500)]
    docs = spark.createDataFrame(rows_from(texts), SCHEMA).repartition(8)
    items = spark.createDataFrame([(1, hot), (2, hot), (3, "nothing of this stands in any of the texts at all")], "item_id long, text string")
    got = decontaminate.contamination(docs, items, block_bytes=1, max_blocks=0).collect()
    assert all((r["items"] == ["1", "2"]) == (r.doc_id % 3 == 0) and bool(r.spans) == (r.doc_id % 3 == 0) for r in got)


def test_broadcasts_change_no_result(spark, monkeypatch):
    rng = random.Random(4)
    texts = hot_lines(rng, 200) + [prose(rng, 120)] * 3 + ["x " + prose(random.Random(9), 90)] * 2
    docs = spark.createDataFrame(rows_from(texts), SCHEMA).repartition(5)
    both = []
    for limit, keys in ((-1, -1), (1 << 30, 0), (-1, 10**6)):  # a Bloom filter, a broadcast, a table of hashes
        monkeypatch.setattr(session, "BROADCAST_BYTES", limit)
        monkeypatch.setattr(bloom, "KEY_ROWS", keys)
        both.append((rows_of(line_dedup.op3_line_dedup(docs)), rows_of(passages.cut_passages(docs))))
    assert both[0] == both[1] == both[2]


def test_sized_measures(spark):
    df = spark.range(1000).toDF("x")
    from pyspark.sql import functions as F

    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    other = spark.range(5000).toDF("x").repartition(3)
    assert "strategy=broadcast" in plan(other.join(session.sized(df), "x"))
    assert "strategy=broadcast" not in plan(other.join(session.sized(df, limit=95_999), "x"))
    assert "strategy=broadcast" not in plan(other.join(session.sized(df, F.lit(1000), limit=1_095_999), "x"))
    assert "strategy=broadcast" in plan(other.join(session.sized(df, F.lit(1000), limit=1_096_000), "x"))
