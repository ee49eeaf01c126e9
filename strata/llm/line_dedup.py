"""Line dedup: repeated windows of three consecutive lines, removed after their first occurrence.

A line's key is its text without spaces, tabs and carriage returns at either
end; lines with an empty key are left out of the windows. Each three
consecutive keys of a document are one window. A window that occurs more than
once anywhere keeps its first occurrence (smallest doc_id, then earliest line);
every line inside any later occurrence is removed, together with the blank
lines between two removed ones. Since the earliest place of a line is never
inside a later occurrence, each distinct line stays somewhere.

How it scales: a window travels as a 128-bit hash with its place. Occurrences
are counted with a map-side partial aggregate, so a window that stands in a
third of all documents sends one row per task. The repeated windows (one row
each) are written down and joined back (``bloom.joined``): by a broadcast while they are measured to be
small, else behind a Bloom filter of bounded size, so that few other windows leave their tasks, in a join for
which both sides are dealt, so that AQE can split a hot window. Only the removed line numbers are
grouped, per document; they reach the texts in the same way, so texts without a removed line mostly cross
no shuffle.

Defined cases: a null text stays null and a text of fewer than three non-blank
lines is never changed; a very long text is handled whole; an empty table stays one; a null doc_id orders after all others; rows that agree
in doc_id and text are one document and share one result; other columns pass
through unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import arrays
from strata.llm.bloom import joined
from strata.llm.session import ENTRY_BYTES, ship_code

LINES = 3
# Names of the columns added while it runs; the input's own are set aside.
KEY, ROW, GONE = "_strata_k", "_strata_row", "_strata_gone"


def line_places(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, number of the line in it, start, end) of each non-blank trimmed line."""
    brk = np.flatnonzero(data == 10)
    start = np.concatenate([at[:-1], brk + 1])
    end = np.concatenate([brk, at[1:]])
    start.sort()
    end.sort()
    lines = 1 + np.diff(np.searchsorted(brk, at))
    doc, number = np.repeat(np.arange(len(at) - 1), lines), arrays.spread(lines)
    solid = np.flatnonzero(~(arrays.IS_BLANK | (np.arange(256) == 10))[data])
    a = np.searchsorted(solid, start)
    b = np.searchsorted(solid, end)
    full = b > a
    a, b = a[full], b[full]
    return doc[full], number[full], solid[a], solid[b - 1] + 1


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, at in arrays.chunks(batch["text"]):
            doc, number, start, end = line_places(data, at)
            ok = np.flatnonzero(arrays.in_one_text(doc, LINES))
            pair = [arrays.signed(arrays.roll(arrays.segment_hash(data, start, end, k), LINES)[ok]) for k in (0, 1)]
            rows = pa.array(lo + doc[ok])
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].take(rows),
                    batch["k"].take(rows),
                    pa.array(number[ok], pa.int32()),
                    pa.array(number[ok + LINES - 1] if len(ok) else number[:0], pa.int32()),
                    pa.array(pair[0], pa.int64()),
                    pa.array(pair[1], pa.int64()),
                ],
                ["doc_id", "k", "line", "last", "w1", "w2"],
            )


def windows(documents: DataFrame) -> DataFrame:
    """doc_id, k (hash of the text), line (first line's number), last, w1, w2 (the window's hash)."""
    ship_code(documents.sparkSession)
    slim = documents.select("doc_id", "text", F.xxhash64("text").alias("k"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(_windows, f"doc_id {kind}, k long, line int, last int, w1 long, w2 long")


def removals(documents: DataFrame) -> DataFrame:
    """doc_id, k, spans: the later occurrences (first and last line) of repeated windows."""
    w = windows(documents)
    place = F.struct(F.isnull("doc_id").alias("n"), F.col("doc_id"), F.col("k"), F.col("line"))
    repeated = (
        w.groupBy("w1", "w2")
        .agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
        .where("n > 1")
        .select("w1", "w2", "first")
    )
    return (
        joined(w, repeated, ["w1", "w2"], "inner", F.col("w1"), F.col("w1"))
        .where(place > F.col("first"))
        .groupBy("doc_id", "k")
        .agg(F.collect_set(F.struct("line", "last")).alias("spans"))
    )


def _cut(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
    kept, gone = [], []
    for t, s in zip(text, spans):
        if t is None or s is None:
            kept.append(None)
            gone.append(0)
            continue
        lines = t.split("\n")
        out = np.zeros(len(lines) + 1, dtype=np.int64)
        for x in s:
            out[x["line"]] += 1
            out[x["last"] + 1] -= 1
        covered = np.cumsum(out)[:-1] > 0
        # Blank lines between two windows that meet are covered by neither: they go with them.
        for a, b in _gaps(covered):
            if not any(x.strip(" \t\r") for x in lines[a:b]):
                covered[a:b] = True
        kept.append("\n".join(x for x, c in zip(lines, covered) if not c))
        gone.append(int(covered.sum()))
    return pd.DataFrame({"text": pd.Series(kept, dtype=object), "n": pd.Series(gone, dtype="int32")})


def _gaps(covered: np.ndarray) -> list[tuple[int, int]]:
    """The uncovered runs that have covered lines on both sides."""
    change = np.flatnonzero(np.diff(covered.astype(np.int8)))
    return [(a + 1, b + 1) for a, b in zip(change[:-1], change[1:]) if covered[a]]


def dedup_lines(documents: DataFrame) -> DataFrame:
    """All columns of ``documents`` with the repeated lines gone, and ``_strata_gone``, their number."""
    gone = removals(documents)
    names = documents.columns
    left = documents.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias(ROW)).withColumn(KEY, F.xxhash64(F.col(f"{ROW}.text")))
    same = F.col(f"{ROW}.doc_id").eqNullSafe(F.col("doc_id")) & (F.col(KEY) == F.col("k"))
    hashes = F.xxhash64(F.col(f"{ROW}.doc_id"), F.col(KEY)), F.xxhash64("doc_id", "k")
    both = joined(left, gone, same, "left", *hashes, ENTRY_BYTES * F.size("spans"))
    cutter = F.pandas_udf(_cut, "struct<text:string,n:int>")
    cut = both.select(
        ROW, cutter(F.when(F.col("spans").isNotNull(), F.col(f"{ROW}.text")), F.col("spans")).alias("cut"), "spans"
    )
    text = F.when(F.col("spans").isNull(), F.col(f"{ROW}.text")).otherwise(F.col("cut.text"))
    kept = {"text": text, "n_chars": F.char_length(text).cast(documents.schema["n_chars"].dataType) if "n_chars" in names else None}
    if "n_chars" in names:
        kept["n_chars"] = F.when(F.col("spans").isNull(), F.col(f"{ROW}.n_chars")).otherwise(kept["n_chars"])
    return cut.select(
        *[(kept[c] if c in kept else F.col(f"{ROW}.`{c}`")).alias(c) for c in names], F.coalesce(F.col("cut.n"), F.lit(0)).alias(GONE)
    )


def op3_line_dedup(documents: DataFrame) -> DataFrame:
    """doc_id, text (what is left), n_removed (lines), n_chars (code points left)."""
    return dedup_lines(documents.select("doc_id", "text")).select(
        "doc_id", "text", F.col(GONE).cast("long").alias("n_removed"), F.char_length("text").cast("long").alias("n_chars")
    )


ORACLE_SQL = r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS no
  FROM documents
),
keyed AS (
  SELECT doc_id, no, trim(line, ' ' || chr(9) || chr(13)) AS key FROM split
),
wins AS (
  SELECT doc_id, no, lead(no, 2) OVER w AS last, [key, lead(key, 1) OVER w, lead(key, 2) OVER w] AS win
  FROM keyed WHERE key <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY no)
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY win ORDER BY doc_id, no) AS r FROM wins WHERE last IS NOT NULL
),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(no, last)) AS no FROM ranked WHERE r > 1
),
marked AS (
  SELECT s.doc_id, s.no, s.line, trim(s.line, ' ' || chr(9) || chr(13)) = '' AS blank, g.no IS NOT NULL AS hit
  FROM split s LEFT JOIN gone g ON s.doc_id = g.doc_id AND s.no = g.no
),
near AS (
  SELECT *,
    last_value(CASE WHEN hit THEN 1 WHEN NOT blank THEN 0 END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY no ROWS UNBOUNDED PRECEDING) AS before,
    first_value(CASE WHEN hit THEN 1 WHEN NOT blank THEN 0 END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after
  FROM marked
),
decided AS (SELECT doc_id, no, line, hit OR (blank AND before = 1 AND after = 1) AS out FROM near)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (WHERE NOT out), '') AS text,
       count(*) FILTER (WHERE out) AS n_removed,
       CAST(length(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (WHERE NOT out), '')) AS BIGINT) AS n_chars
FROM decided GROUP BY doc_id
"""

__all__ = ["LINES", "ORACLE_SQL", "dedup_lines", "op3_line_dedup", "removals", "windows"]
