"""Typed Parquet readers for the input tables.

Each table lives at ``<root>/<name>.parquet``, which may be one file (the test
data) or a directory of part files (a cluster data set); ``spark.read.parquet``
takes either. The files' own schemas are checked against the declared one
before a table is used: a missing column or any other type (a zoned timestamp,
a 32-bit integer, a float) raises ``SchemaMismatch``. Spark itself would read a
missing column as nulls and widen or reinterpret many types without a word.

The check reads footers only (``mergeSchema``: one distributed job over all part
files), so part files of differing types are refused too, whichever they are.
Not covered: a column missing from only some part files, which Spark's merged
schema cannot show; it reads as null there.

No data are read here: the DataFrames are lazy, so Catalyst still prunes columns
and pushes filters into each scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType
from pyspark.util import inheritable_thread_target

# Column names and types of the input tables, as their Parquet files declare
# them.
SCHEMAS: dict[str, str] = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": (
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
        "c_mktsegment STRING"
    ),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
        "o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
        "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
}


class SchemaMismatch(ValueError):
    """The files of a table do not hold the declared columns and types."""


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Lazily read table ``name`` from the folder ``root``, its schema checked."""
    try:
        schema = SCHEMAS[name]
    except KeyError:
        raise ValueError(f"unknown table {name!r}; known: {sorted(SCHEMAS)}") from None
    path = f"{root.rstrip('/')}/{name}.parquet"
    declared = StructType.fromDDL(schema)
    try:
        found = spark.read.option("mergeSchema", "true").parquet(path).schema
    except Exception as exc:
        if "CANNOT_MERGE" in str(exc) or "FAILED_MERGING" in str(exc):
            raise SchemaMismatch(f"{path}: part files differ in their types: {str(exc).splitlines()[0]}") from exc
        raise
    types = {f.name: f.dataType for f in found}
    wrong = [
        f"{f.name} is {types[f.name].simpleString() if f.name in types else 'missing'}, not {f.dataType.simpleString()}"
        for f in declared
        if types.get(f.name) != f.dataType
    ]
    if wrong:
        raise SchemaMismatch(f"{path}: " + "; ".join(wrong))
    return spark.read.schema(declared).parquet(path)


def read_tables(spark: SparkSession, root: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """``read_table`` for several tables, their footer checks side by side.

    Each check is a small job of mostly fixed cost. The threads inherit the
    caller's job group and tags; with pinned-thread mode off, PySpark hands the
    session back and there is nothing to inherit.
    """

    def read(name: str) -> DataFrame:
        return read_table(spark, root, name)

    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=max(1, len(names))) as pool:
        return dict(zip(names, pool.map(read if inherit is spark else inherit(read), names)))
