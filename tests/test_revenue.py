"""revenue_by_region against DuckDB running the plain SQL specification."""

import contextlib
import datetime as dt
import json
import random
import re
import subprocess
import sys
import uuid

import pytest
from conftest import ROOT, TESTDATA, duck, explain, rows_of, sorted_rows, spark_conf, write_tables
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.plans.revenue import COLUMNS, NARROW_RANGE_SETTINGS, oracle_sql, revenue_by_region, revenue_by_region_from
from strata.sources import SCHEMAS, read_table


@contextlib.contextmanager
def jobs_of(spark):
    """Counts the Spark jobs that the block starts."""
    sc, group = spark.sparkContext, uuid.uuid4().hex
    sc.setJobGroup(group, "counted")
    try:
        yield lambda: len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)


def oracle_rows(root, **kwargs):
    return sorted_rows(duck(root).execute(oracle_sql(**kwargs)).fetchall())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_matches_oracle_on_test_data(spark, sf):
    root = TESTDATA / sf
    got = rows_of(revenue_by_region_from(spark, str(root)))
    assert len(got) == 25
    assert got == oracle_rows(root)


def test_other_ranges_match_oracle(spark):
    root = TESTDATA / "sf0.01"
    for start, end in [("1995-01-01", "2002-01-01"), ("1999-03-15", "1999-03-16"), ("2030-01-01", "2031-01-01")]:
        got = rows_of(revenue_by_region_from(spark, str(root), start=start, end=end))
        assert got == oracle_rows(root, start=start, end=end), (start, end)


def test_schema(spark):
    df = revenue_by_region_from(spark, str(TESTDATA / "sf0.001"))
    assert tuple(df.columns) == COLUMNS
    assert [f.dataType.simpleString() for f in df.schema] == ["string", "string", "bigint", "double"]


def test_same_result_as_spark_sql_of_the_specification(spark):
    """The hand-shaped plan (pre-aggregation per customer) equals Catalyst's own plan of the spec."""
    root = str(TESTDATA / "sf0.01")
    for name in ("lineitem", "orders", "customer", "nation", "region"):
        read_table(spark, root, name).createOrReplaceTempView(name)
    spec = spark.sql(oracle_sql())
    assert rows_of(spec) == rows_of(revenue_by_region_from(spark, root))


def test_dates_may_be_given_as_python_dates(spark):
    root = TESTDATA / "sf0.01"
    with spark_conf(spark, {"spark.sql.session.timeZone": "Pacific/Auckland"}):
        by_date = rows_of(revenue_by_region_from(spark, str(root), start=dt.date(1998, 2, 1), end=dt.datetime(1998, 3, 1, 12)))
    assert by_date == oracle_rows(root, start="1998-02-01", end="1998-03-01 12:00:00")
    with pytest.raises(ValueError, match="zone-less"):
        revenue_by_region_from(spark, str(root), start=dt.datetime(1998, 2, 1, tzinfo=dt.timezone.utc))


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "start, end",
    [
        ("1996-13-45", "1997-01-01"),
        ("1996", "1997-01-01"),
        ("", "1997-01-01"),
        ("next week", "1997-01-01"),
        ("1996-01-01T12:00:00+12:00", "1997-01-01"),
        ("1996-01-01", "1997-01-01T00:00:00Z"),
        ("1997-01-01", "1996-01-01"),
        ("1996-01-01", "1996-01-01"),
    ],
)
def test_a_bad_range_fails_before_any_job_starts(spark, ansi, start, end):
    tables = {n: spark.read.schema(ddl).parquet(f"{TESTDATA}/sf0.001/{n}.parquet") for n, ddl in SCHEMAS.items()}
    with spark_conf(spark, {"spark.sql.ansi.enabled": ansi}), jobs_of(spark) as jobs:
        with pytest.raises(ValueError):
            revenue_by_region(**tables, start=start, end=end)
    assert jobs() == 0


def test_building_the_query_starts_no_job(spark):
    tables = {n: spark.read.schema(ddl).parquet(f"{TESTDATA}/sf0.001/{n}.parquet") for n, ddl in SCHEMAS.items()}
    with jobs_of(spark) as jobs:
        df = revenue_by_region(**tables)
    assert jobs() == 0
    assert df.count() == 25


@pytest.mark.parametrize(
    "settings",
    [
        {"spark.sql.session.timeZone": "America/Los_Angeles"},
        {"spark.sql.session.timeZone": "Asia/Kolkata"},
        {"spark.sql.ansi.enabled": "false"},
        {"spark.sql.adaptive.enabled": "false"},
        {"spark.sql.shuffle.partitions": "1"},
        {"spark.sql.shuffle.partitions": "200", "spark.sql.autoBroadcastJoinThreshold": "-1"},
        {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0"},
        {"spark.sql.cbo.enabled": "true", "spark.sql.cbo.joinReorder.enabled": "true"},
        {"spark.sql.codegen.wholeStage": "false", "spark.sql.parquet.enableVectorizedReader": "false"},
        {"spark.sql.ansi.enforceReservedKeywords": "true"},
    ],
    ids=lambda d: ",".join(f"{k.rsplit('.', 1)[-1]}={v}" for k, v in d.items()),
)
def test_result_does_not_depend_on_session_settings(spark, settings):
    """The caller's session decides these; dates are TIMESTAMP_NTZ, amounts decimal."""
    root = TESTDATA / "sf0.01"
    with spark_conf(spark, settings):
        got = rows_of(revenue_by_region_from(spark, str(root)))
    assert got == oracle_rows(root)


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("price, discount", [(2e10, 0.0), (100.125, 0.055), (100.13, 0.055), (100.125, 0.05)])
def test_an_amount_outside_the_declared_type_fails_instead_of_summing_wrong(spark, tmp_path, ansi, price, discount):
    """Too large, or with a third place: an error in either ANSI mode, never a rounded or missing amount."""
    tables = {
        "region": [{"r_regionkey": 0, "r_name": "R"}],
        "nation": [{"n_nationkey": 0, "n_name": "N", "n_regionkey": 0}],
        "customer": [{"c_custkey": 1, "c_nationkey": 0}],
        "orders": [{"o_orderkey": 1, "o_custkey": 1, "o_orderdate": _ts(1996, 5, 5)}],
        "lineitem": [{"l_orderkey": 1, "l_extendedprice": price, "l_discount": discount}],
    }
    root = write_tables(tmp_path / "big", tables)
    with spark_conf(spark, {"spark.sql.ansi.enabled": ansi}):
        with pytest.raises(Exception, match="is not a DECIMAL"):
            revenue_by_region_from(spark, str(root)).collect()


# --------------------------------------------------------------------------
# Edge cases on a small hand-made fixture


def _ts(*args):
    return dt.datetime(*args)


EDGE = {
    # Two regions share the name EAST; grouping is by name, as in the SQL.
    "region": [
        {"r_regionkey": 0, "r_name": "EAST"},
        {"r_regionkey": 1, "r_name": "WEST"},
        {"r_regionkey": 2, "r_name": "EAST"},
    ],
    "nation": [
        {"n_nationkey": 0, "n_name": "N0", "n_regionkey": 0},
        {"n_nationkey": 1, "n_name": "N1", "n_regionkey": 1},
        {"n_nationkey": 2, "n_name": "N0", "n_regionkey": 2},  # same name, other EAST
        {"n_nationkey": 3, "n_name": "N3", "n_regionkey": 9},  # no such region
        {"n_nationkey": 4, "n_name": None, "n_regionkey": 1},  # null name is a group
    ],
    "customer": [
        {"c_custkey": 1, "c_nationkey": 0},
        {"c_custkey": 2, "c_nationkey": 1},
        {"c_custkey": 3, "c_nationkey": 2},
        {"c_custkey": 4, "c_nationkey": 3},
        {"c_custkey": 5, "c_nationkey": 7},  # no such nation
        {"c_custkey": 6, "c_nationkey": 4},
        {"c_custkey": 7, "c_nationkey": None},
    ],
    "orders": [
        {"o_orderkey": 1, "o_custkey": 1, "o_orderdate": _ts(1996, 1, 1)},  # first instant: in
        {"o_orderkey": 2, "o_custkey": 1, "o_orderdate": _ts(1996, 12, 31, 23, 59, 59, 999999)},
        {"o_orderkey": 3, "o_custkey": 1, "o_orderdate": _ts(1997, 1, 1)},  # end is exclusive
        {"o_orderkey": 4, "o_custkey": 1, "o_orderdate": _ts(1995, 12, 31, 23, 59, 59, 999999)},
        {"o_orderkey": 5, "o_custkey": 2, "o_orderdate": _ts(1996, 6, 1)},
        {"o_orderkey": 6, "o_custkey": 3, "o_orderdate": _ts(1996, 6, 2)},
        {"o_orderkey": 7, "o_custkey": 4, "o_orderdate": _ts(1996, 6, 3)},
        {"o_orderkey": 8, "o_custkey": 5, "o_orderdate": _ts(1996, 6, 4)},
        {"o_orderkey": 9, "o_custkey": 99, "o_orderdate": _ts(1996, 6, 5)},  # no such customer
        {"o_orderkey": 10, "o_custkey": 6, "o_orderdate": _ts(1996, 7, 1)},
        {"o_orderkey": 11, "o_custkey": None, "o_orderdate": _ts(1996, 7, 1)},
        {"o_orderkey": 12, "o_custkey": 7, "o_orderdate": _ts(1996, 7, 2)},
        {"o_orderkey": 13, "o_custkey": 2, "o_orderdate": None},
        {"o_orderkey": 14, "o_custkey": 2, "o_orderdate": _ts(1996, 3, 3)},
    ],
    "lineitem": [
        {"l_orderkey": 1, "l_extendedprice": 1234.56, "l_discount": 0.00},
        {"l_orderkey": 1, "l_extendedprice": 999.99, "l_discount": 0.05},
        {"l_orderkey": 1, "l_extendedprice": 0.01, "l_discount": 0.10},
        {"l_orderkey": 2, "l_extendedprice": 104997.88, "l_discount": 0.07},
        {"l_orderkey": 3, "l_extendedprice": 50.00, "l_discount": 0.00},
        {"l_orderkey": 4, "l_extendedprice": 60.00, "l_discount": 0.00},
        {"l_orderkey": 5, "l_extendedprice": 10.10, "l_discount": 0.03},
        {"l_orderkey": 5, "l_extendedprice": 20.20, "l_discount": 0.04},
        # 0.10 * 0.95 = 0.095 exactly: rounds half up to 0.10
        {"l_orderkey": 6, "l_extendedprice": 0.10, "l_discount": 0.05},
        {"l_orderkey": 7, "l_extendedprice": 70.00, "l_discount": 0.00},
        {"l_orderkey": 8, "l_extendedprice": 80.00, "l_discount": 0.00},
        {"l_orderkey": 9, "l_extendedprice": 90.00, "l_discount": 0.00},
        # null discount: the line counts, its revenue is null, the group's sum is null
        {"l_orderkey": 10, "l_extendedprice": 100.00, "l_discount": None},
        {"l_orderkey": 11, "l_extendedprice": 110.00, "l_discount": 0.00},
        {"l_orderkey": 12, "l_extendedprice": 120.00, "l_discount": 0.00},
        {"l_orderkey": 13, "l_extendedprice": 130.00, "l_discount": 0.00},
        {"l_orderkey": 14, "l_extendedprice": None, "l_discount": 0.01},
        {"l_orderkey": 14, "l_extendedprice": None, "l_discount": 0.02},
        {"l_orderkey": 1000, "l_extendedprice": 1.00, "l_discount": 0.00},  # no such order
        {"l_orderkey": None, "l_extendedprice": 1.00, "l_discount": 0.00},
    ],
}


def test_edge_cases_match_oracle(spark, tmp_path):
    root = write_tables(tmp_path / "edge", EDGE)
    got = rows_of(revenue_by_region_from(spark, str(root)))
    assert got == oracle_rows(root)
    # Spelled out, so a shared mistake in both engines would still show.
    assert got == sorted_rows(
        [
            ("EAST", "N0", 5, 99832.68),  # 2184.5595 + 97648.0284 + 0.095
            ("WEST", "N1", 4, 29.19),  # 9.797 + 19.392 + two null prices
            ("WEST", None, 1, None),
        ]
    )


def test_hot_keys_match_oracle(spark, tmp_path):
    """One customer with most orders and one order with thousands of lines."""
    orders, lines = [], []
    for k in range(1, 401):
        orders.append({"o_orderkey": k, "o_custkey": 1 if k <= 300 else k, "o_orderdate": _ts(1996, 1 + k % 12, 1)})
        for n in range(3):
            lines.append({"l_orderkey": k, "l_extendedprice": 100 + k + n / 100, "l_discount": (k + n) % 11 / 100})
    for n in range(5000):
        lines.append({"l_orderkey": 7, "l_extendedprice": 1 + n / 100, "l_discount": n % 11 / 100})
    tables = {
        "region": [{"r_regionkey": 0, "r_name": "R"}],
        "nation": [{"n_nationkey": i, "n_name": f"N{i}", "n_regionkey": 0} for i in range(3)],
        "customer": [{"c_custkey": k, "c_nationkey": k % 3} for k in range(1, 401)],
        "orders": orders,
        "lineitem": lines,
    }
    root = write_tables(tmp_path / "hot", tables)
    got = rows_of(revenue_by_region_from(spark, str(root)))
    assert got == oracle_rows(root)
    assert sum(r[2] for r in got) == len(lines)


def test_the_planner_broadcasts_small_dimensions_and_shuffles_wide_ones(spark, tmp_path):
    """By the size of their files in bytes, under Spark's own threshold."""
    plan = explain(revenue_by_region_from(spark, str(TESTDATA / "sf0.01")), "simple")
    broadcast = r"BroadcastHashJoin \[%s#\d+\], \[%s#\d+\], Inner, BuildRight"
    assert re.search(broadcast % ("c_nationkey", "n_nationkey"), plan) and re.search(broadcast % ("n_regionkey", "r_regionkey"), plan), plan
    rng = random.Random(5)
    wide = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(4_000_000))
    tables = EDGE | {
        "nation": [{"n_nationkey": k, "n_name": wide[k * 2000 : (k + 1) * 2000], "n_regionkey": k % 3} for k in range(2000)],
    }
    root = write_tables(tmp_path / "wide", tables)
    with spark_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "1MB", "spark.sql.adaptive.enabled": "false"}):
        df = revenue_by_region_from(spark, str(root))
        plan = explain(df, "simple")
        got = rows_of(df)
    assert not re.search(broadcast % ("c_nationkey", "n_nationkey"), plan), plan
    assert re.search(broadcast % ("n_regionkey", "r_regionkey"), plan), plan
    assert got == oracle_rows(root) and got


# --------------------------------------------------------------------------
# Random fixtures

_cents = st.integers(min_value=0, max_value=10_000_000).map(lambda c: c / 100)
_rate = st.integers(min_value=0, max_value=10).map(lambda c: c / 100)
_date = st.sampled_from(
    [
        _ts(1996, 1, 1),
        _ts(1996, 8, 8, 8),
        _ts(1996, 12, 31, 23, 59, 59, 999999),
        _ts(1996, 3, 3),
        _ts(1995, 12, 31, 23, 59, 59, 999999),
        _ts(1997, 1, 1),
        None,
    ]
)


@st.composite
def _tables(draw):
    """Random star schemas. Half the time a table's keys are unique; otherwise
    they repeat and may be null. Foreign keys mostly point at existing keys,
    sometimes at none (orphans) or are null."""

    def keys(n):
        if draw(st.booleans()):
            return list(range(n))
        return [draw(st.sampled_from([0, 1, 2, None])) for _ in range(n)]

    def ref(parent_keys):
        present = [k for k in parent_keys if k is not None]
        return draw(st.sampled_from(present * 4 + [None, 99]))

    rk = keys(draw(st.integers(1, 3)))
    nk = keys(draw(st.integers(1, 5)))
    ck = keys(draw(st.integers(1, 6)))
    ok = keys(draw(st.integers(1, 8)))
    return {
        "region": [{"r_regionkey": k, "r_name": draw(st.sampled_from(["A", "B", None]))} for k in rk],
        "nation": [
            {"n_nationkey": k, "n_name": draw(st.sampled_from(["X", "Y", "Z"])), "n_regionkey": ref(rk)}
            for k in nk
        ],
        "customer": [{"c_custkey": k, "c_nationkey": ref(nk)} for k in ck],
        "orders": [{"o_orderkey": k, "o_custkey": ref(ck), "o_orderdate": draw(_date)} for k in ok],
        "lineitem": [
            {
                "l_orderkey": ref(ok),
                "l_extendedprice": draw(st.one_of(_cents, _cents, st.none())),
                "l_discount": draw(st.one_of(_rate, _rate, st.none())),
            }
            for _ in range(draw(st.integers(1, 30)))
        ],
    }


_counter = iter(range(10**9))


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(tables=_tables())
def test_random_fixtures_match_oracle(spark, tmp_path, tables):
    root = write_tables(tmp_path / f"r{next(_counter)}", tables)
    assert rows_of(revenue_by_region_from(spark, str(root))) == oracle_rows(root)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(tables=_tables())
def test_random_fixtures_match_oracle_through_shuffle_joins(spark, tmp_path, tables):
    """As above, with broadcasts off so the joins run as they would on large
    tables (AQE hash joins under the local session's settings), and lineitem
    split into part files."""
    root = write_tables(tmp_path / f"s{next(_counter)}", tables, parts={"lineitem": 3})
    with spark_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        got = rows_of(revenue_by_region_from(spark, str(root)))
    assert got == oracle_rows(root)


# --------------------------------------------------------------------------
# Plan shape


def test_scans_are_pruned_and_filtered(spark):
    plan = explain(revenue_by_region_from(spark, str(TESTDATA / "sf0.01")))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in plan
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)" in plan
    assert "LessThan(o_orderdate,1997-01-01T00:00)" in plan
    for python_node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas"):
        assert python_node not in plan


def _static_plan(spark, df):
    """Physical plan as planned for tables too big to broadcast by statistics."""
    with spark_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "4kB", "spark.sql.adaptive.enabled": "false"}):
        return explain(df, "simple")


def test_large_table_plan_shuffles_each_big_input_once(spark):
    df = revenue_by_region_from(spark, str(TESTDATA / "sf0.01"))
    plan = _static_plan(spark, df)
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    keys = sorted(re.sub(r"#\d+L?", "", e).rsplit(",", 1)[0] for e in exchanges)
    # lineitem and the filtered orders by order key; the per-customer partial
    # aggregate and customer by customer key; the final partial aggregate by
    # (region, nation). Nation and region are under the threshold of 4 kB
    # (their files' sizes), orders and customer over it.
    assert keys == ["c_custkey", "l_orderkey", "o_custkey", "o_orderkey", "r_name, n_name"], plan
    assert plan.count("BroadcastExchange") == 2, plan
    assert plan.count("SortMergeJoin") == 2, plan
    # Both aggregates before a shuffle are partial (map-side) ones.
    assert plan.count("partial_sum(rev") == 2, plan


@pytest.mark.parametrize(
    "hash_join_threshold, join",
    [("0", "SortMergeJoin"), ("64MB", "ShuffledHashJoin")],
    ids=["sort-merge", "shuffled-hash"],
)
def test_hot_order_key_is_split_when_joins_shuffle(spark, tmp_path, hash_join_threshold, join):
    """Half of all lines on one order: with the order join forced to shuffle,
    AQE splits the hot partition across tasks and the result stays exact,
    whether the join sorts both sides or hashes the order side.

    The skew thresholds are scaled down to fixture size; on a cluster the
    defaults (256 MB, 5x the median) apply. lineitem is a folder of part files
    because a skewed partition is split by groups of map outputs.
    """
    orders, lines = [], []
    for k in range(1, 2001):
        orders.append({"o_orderkey": k, "o_custkey": k % 300 + 1, "o_orderdate": _ts(1996, 1 + k % 12, 1)})
        lines.append({"l_orderkey": k, "l_extendedprice": 100 + k / 100, "l_discount": k % 11 / 100})
        lines.append({"l_orderkey": k, "l_extendedprice": 200 + k / 100, "l_discount": k % 7 / 100})
    for n in range(4000):
        lines.append({"l_orderkey": 7, "l_extendedprice": 1 + n / 100, "l_discount": n % 11 / 100})
    tables = {
        "region": [{"r_regionkey": 0, "r_name": "R"}],
        "nation": [{"n_nationkey": i, "n_name": f"N{i}", "n_regionkey": 0} for i in range(3)],
        "customer": [{"c_custkey": k, "c_nationkey": k % 3} for k in range(1, 301)],
        "orders": orders,
        "lineitem": lines,
    }
    root = write_tables(tmp_path / "skew", tables, parts={"lineitem": 8})
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": hash_join_threshold,
    }
    with spark_conf(spark, conf):
        df = revenue_by_region_from(spark, str(root))
        got = rows_of(df)
        final_plan = explain(df, "simple").split("== Initial Plan ==")[0]
    assert got == oracle_rows(root)
    assert sum(r[2] for r in got) == len(lines)
    assert f"{join}(skew=true) [l_orderkey" in final_plan, final_plan


def test_with_recommended_settings_large_joins_hash_instead_of_sort(spark):
    """Under the recommended AQE settings and tables too big to broadcast, both
    shuffle joins become shuffled hash joins at runtime: lineitem is streamed,
    not sorted."""
    root = TESTDATA / "sf0.01"
    with spark_conf(
        spark,
        {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
        },
    ):
        df = revenue_by_region_from(spark, str(root))
        got = rows_of(df)
        final_plan = explain(df, "simple").split("== Initial Plan ==")[0]
    assert got == oracle_rows(root)
    assert "ShuffledHashJoin [o_custkey" in final_plan, final_plan
    assert re.search(r"ShuffledHashJoin \[l_orderkey", final_plan), final_plan
    assert "SortMergeJoin" not in final_plan, final_plan


NARROW = r"""
import json, re, sys
from pathlib import Path
sys.path[:0] = [sys.argv[1], sys.argv[1] + "/tests"]
from pyspark.sql import SparkSession
from conftest import explain, rows_of
from strata.plans.revenue import revenue_by_region_from

out = {}
for name, extra in (("plain", {"spark.sql.optimizer.runtime.bloomFilter.enabled": "false"}), ("filtered", json.loads(sys.argv[4]))):
    events = Path(sys.argv[3]) / name
    events.mkdir()
    spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").config("spark.sql.autoBroadcastJoinThreshold", "-1")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.rolling.enabled", "false")
             .config("spark.eventLog.compress", "false").config("spark.eventLog.dir", events.as_uri()).config(map=extra).getOrCreate())
    df = revenue_by_region_from(spark, sys.argv[2], start="1996-03-05", end="1996-03-06")
    plan, rows = explain(df), rows_of(df)
    spark.stop()
    written = {}
    for line in next(p for p in events.iterdir() if p.is_file()).open():
        e = json.loads(line)
        if e["Event"] == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            written.setdefault(e["Stage ID"], [0, 0])
            written[e["Stage ID"]][0] += m.get("Shuffle Write Metrics", {}).get("Shuffle Records Written", 0)
            written[e["Stage ID"]][1] += m.get("Input Metrics", {}).get("Records Read", 0)
    lines = max(written.values(), key=lambda x: x[1])  # the stage that scans lineitem
    out[name] = {"rows": rows, "might_contain": "might_contain" in plan, "shuffled": lines[0], "read": lines[1]}
print(json.dumps(out))
"""


def test_a_narrow_range_does_not_shuffle_all_of_lineitem(tmp_path):
    """With the documented settings a runtime Bloom filter drops other lines before their shuffle.

    Only the scan-size threshold is lowered, since the test table is small.
    """
    root = TESTDATA / "sf0.1"
    conf = NARROW_RANGE_SETTINGS | {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    script = tmp_path / "run.py"
    script.write_text(NARROW)
    proc = subprocess.run(
        [sys.executable, str(script), str(ROOT), str(root), str(tmp_path), json.dumps(conf)], capture_output=True, text=True, timeout=300
    )
    assert proc.returncode == 0, proc.stderr[-2000:]
    got = json.loads(proc.stdout.strip().splitlines()[-1])
    expected = json.loads(json.dumps(oracle_rows(root, start="1996-03-05", end="1996-03-06")))
    matching = sum(r[2] for r in expected)
    assert got["plain"]["rows"] == got["filtered"]["rows"] == expected and matching > 0
    assert not got["plain"]["might_contain"] and got["filtered"]["might_contain"]
    assert got["plain"]["shuffled"] == got["plain"]["read"] == 600_000
    assert matching <= got["filtered"]["shuffled"] <= matching + 0.04 * 600_000
