import contextlib
import io
import sys
from pathlib import Path

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from strata.session import local_session  # noqa: E402

TESTDATA = Path("/root/testdata")

# Arrow types matching strata.sources.SCHEMAS, for writing small fixtures.
ARROW_SCHEMAS = {
    "region": pa.schema([("r_regionkey", pa.int32()), ("r_name", pa.string())]),
    "nation": pa.schema(
        [("n_nationkey", pa.int32()), ("n_name", pa.string()), ("n_regionkey", pa.int32())]
    ),
    "customer": pa.schema(
        [
            ("c_custkey", pa.int64()),
            ("c_name", pa.string()),
            ("c_nationkey", pa.int32()),
            ("c_acctbal", pa.float64()),
            ("c_mktsegment", pa.string()),
        ]
    ),
    "orders": pa.schema(
        [
            ("o_orderkey", pa.int64()),
            ("o_custkey", pa.int64()),
            ("o_orderstatus", pa.string()),
            ("o_totalprice", pa.float64()),
            ("o_orderdate", pa.timestamp("us")),
            ("o_orderpriority", pa.string()),
        ]
    ),
    "lineitem": pa.schema(
        [
            ("l_orderkey", pa.int64()),
            ("l_partkey", pa.int64()),
            ("l_suppkey", pa.int64()),
            ("l_linenumber", pa.int32()),
            ("l_quantity", pa.float64()),
            ("l_extendedprice", pa.float64()),
            ("l_discount", pa.float64()),
            ("l_tax", pa.float64()),
            ("l_returnflag", pa.string()),
            ("l_linestatus", pa.string()),
            ("l_shipdate", pa.timestamp("us")),
        ]
    ),
}


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, shuffle_partitions=8)
    yield session
    session.stop()


def duck(root) -> duckdb.DuckDBPyConnection:
    """DuckDB connection with one view per Parquet file under ``root``."""
    con = duckdb.connect()
    for path in sorted(Path(root).glob("*.parquet")):
        source = f"{path}/*.parquet" if path.is_dir() else str(path)
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{source}')")
    return con


def write_tables(root: Path, rows: dict[str, list[dict]], parts: dict[str, int] | None = None) -> Path:
    """Write each table in ``rows`` (missing columns become null) as <root>/<name>.parquet.

    A table named in ``parts`` is written as a folder of that many part files
    (rows dealt round-robin), the layout of a large data set.
    """
    root.mkdir(parents=True, exist_ok=True)
    for name, schema in ARROW_SCHEMAS.items():
        table_rows = rows.get(name, [])
        n_parts = (parts or {}).get(name, 0)
        if not n_parts:
            pq.write_table(_arrow(table_rows, schema), root / f"{name}.parquet")
            continue
        folder = root / f"{name}.parquet"
        folder.mkdir()
        for i in range(n_parts):
            pq.write_table(_arrow(table_rows[i::n_parts], schema), folder / f"part-{i:05d}.parquet")
    return root


def _arrow(table_rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.table({f.name: [r.get(f.name) for r in table_rows] for f in schema}, schema=schema)


@contextlib.contextmanager
def spark_conf(spark, settings: dict[str, str]):
    """Apply session settings for the block, then restore (or unset) them."""
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def explain(df, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def _null_safe(row: tuple) -> tuple:
    return tuple((v is None, v) for v in row)


def sorted_rows(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=_null_safe)


def rows_of(df) -> list[tuple]:
    return sorted_rows(df.collect())
