"""What the operators need from the session: code on the workers, a checkpoint folder."""

from __future__ import annotations

import atexit
import io
import os
import re
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PACKAGE = Path(__file__).resolve().parent
_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors once per application.

    The functions that run inside tasks are imported there by name, so the
    operators also work where the repository is not installed on the workers.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("strata/__init__.py", "")
        for p in sorted(PACKAGE.rglob("*.py")):
            z.write(p, f"strata/llm/{p.relative_to(PACKAGE)}")
    folder = tempfile.mkdtemp(prefix="strata-code-")  # read by the driver only, which serves it
    path = os.path.join(folder, "strata_llm.zip")
    Path(path).write_bytes(packed.getvalue())
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python in Arrow batches of about ``BATCH_BYTES``, unless the session names a size itself.

    Spark's own bound is 10,000 rows or 64 MB, which the executor and each of its Python workers hold
    several times. A setting of the session, since a DataFrame is only run after it was returned.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session may leave it unset; a temporary folder is made then, and
    goes with the process.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isEmpty():
        if named is None:
            if not re.fullmatch(r"local(\[.*\])?", sc.master):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            named = tempfile.mkdtemp(prefix="strata-checkpoint-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        sc.setCheckpointDir(named)
        current = sc._jsc.sc().getCheckpointDir()
    return named or current.get()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder by ``checkpoint()``, its lineage cut."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


#: A side of a join is broadcast up to this measured size; the session's ``spark.strata.broadcastBytes`` overrides it.
BROADCAST_BYTES = 1 << 20
ROW_BYTES, ENTRY_BYTES = 96, 32  # of a row of a few numbers in a hash table; of an entry of an array of pairs


def measured(df: DataFrame, more: Column | None = None, limit: int | None = None) -> tuple[DataFrame, bool]:
    """``df`` written down, and whether it is small enough to broadcast: a row counts as ``ROW_BYTES`` and ``more``."""
    kept = checkpointed(df)
    size = kept.agg(F.sum(F.lit(ROW_BYTES) + (F.lit(0) if more is None else F.coalesce(more, F.lit(0))))).first()[0] or 0
    if limit is None:
        limit = int(df.sparkSession.conf.get("spark.strata.broadcastBytes", str(BROADCAST_BYTES)))
    return kept, size <= limit


def sized(df: DataFrame, more: Column | None = None, limit: int | None = None) -> DataFrame:
    """``df`` written down, and marked for broadcast if it is measured to be small.

    Beyond the limit the join is Spark's to
    choose: it shuffles, and since the written rows are dealt anew for it, AQE can split
    a hot key of the other side (it can't where an aggregate already dealt them).
    """
    kept, small = measured(df, more, limit)
    return F.broadcast(kept) if small else kept


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def same_columns(df: DataFrame, run) -> DataFrame:
    """``df.mapInArrow(run)`` for a function that keeps the columns, whatever their names.

    ``run`` sees column i as ``c<i>`` (PySpark can't resolve a name with a dot
    there), and the result has the old names again.
    """
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.mapInArrow(run, plain.schema).toDF(*names)
