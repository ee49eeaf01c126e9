"""The training-data pipeline: documents in, packed token sequences out.

STAGES are applied in order, each on all that the one before it kept:

1. quality classifier: documents that it rejects go;
2. line dedup: later occurrences of repeated three-line windows are cut out;
3. MinHash near-dedup: one document of each group of near copies stays;
4. benchmark decontamination: documents that hold a test item's words go; then
   later occurrences of repeated windows of fifty words are cut out, which need
   not be whole lines (after near-dedup, so that near copies are still alike there);
5. best-fit packing: the token sequences.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``documents``. Between stages the rows are written
as Parquet into the checkpoint folder and read again, so a lost executor never
repeats an earlier stage; what ``run`` has written there is deleted when the last stage has read it.

Each stage bounds the Arrow batches of the session (``session.small_batches``), since the memory of an
executor and its Python workers must do for all stages one after another.

The result has one row per piece: doc_id, piece, start, length, ids_crc32, ids (the
token ids as little-endian unsigned 16-bit numbers, one after another), sequence_id, offset.

Defined cases: a null or empty text is rejected by the first stage; so are rows that the classifier
gives less than 0.5 (a tie at 0.5 stays); rows that share doc_id and text are one document from
the third stage on; very long texts are handled whole and cut into pieces by the last stage; nulls in
other columns, and further columns whatever their names, pass through to the last stage, which
ignores them; an empty table gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontaminate, line_dedup, near_dup, packing, passages, quality
from strata.llm.session import documents, shared_folder, small_batches, table


_folders: list[str] = []  # written since the last ``run`` began


def _written(spark: SparkSession, docs: DataFrame, name: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}-{name}"
    docs.write.parquet(folder)
    _folders.append(folder)
    return spark.read.parquet(folder)


def _delete(spark: SparkSession) -> None:
    while _folders:
        folder = spark._jvm.org.apache.hadoop.fs.Path(_folders.pop())
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return quality.good_documents(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return line_dedup.dedup_lines(docs).drop(line_dedup.GONE)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return near_dup.deduplicated(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    clean = decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))
    # Written, since the search for passages reads its input several times.
    return passages.cut_passages(_written(spark, clean, "clean"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pack(docs, with_ids=True, as_bytes=True)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Tokenising, EM and hashed signatures are not expressible in SQL; see the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    _folders.clear()
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = _written(spark, docs, f"{k}-{name}")
    _delete(spark)  # packing has written its rows down and reads no stage any more
    return docs
