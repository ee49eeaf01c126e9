"""Run the revenue report as a batch job.

    python -m strata --root /data/sales --start 1996-01-01 --end 1997-01-01 \
        --out /shared/reports/revenue_1996

    spark-submit --master <cluster> --py-files strata.zip strata/__main__.py \
        --root ... --out ...

The session is the one the launcher provides (``getOrCreate``), so cluster
settings apply unchanged. Without ``--out`` every row is printed. An existing
``--out`` is refused unless ``--overwrite`` is given, and one that equals,
contains or lies inside ``--root`` always is.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from strata.plans.revenue import revenue_by_region_from


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="strata", description=__doc__.splitlines()[0])
    parser.add_argument("--root", required=True, help="folder holding <table>.parquet inputs")
    parser.add_argument("--start", default="1996-01-01", help="first order date, inclusive")
    parser.add_argument("--end", default="1997-01-01", help="last order date, exclusive")
    parser.add_argument("--out", help="write the report here as Parquet; must not exist yet")
    parser.add_argument("--overwrite", action="store_true", help="replace an existing --out")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("strata-revenue").getOrCreate()
    if args.out and overlaps(spark, args.out, args.root):
        parser.error("--out must not equal, contain or lie inside --root")
    report = revenue_by_region_from(spark, args.root, start=args.start, end=args.end)
    if args.out:
        report.write.mode("overwrite" if args.overwrite else "errorifexists").parquet(args.out)
        return
    print("\t".join(report.columns))
    for row in report.orderBy("r_name", "n_name").toLocalIterator():
        print("\t".join("NULL" if x is None else str(x) for x in row))


def overlaps(spark: SparkSession, a: str, b: str) -> bool:
    """Whether one of two folders is, or lies inside, the other (whatever form their paths take)."""
    first, second = _parts(spark, a), _parts(spark, b)
    n = min(len(first), len(second))
    return first[:n] == second[:n]


def _parts(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    uri = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hadoop_path).toUri()
    plain = uri.getPath()
    # Links and ".." are resolved where the driver can see them.
    plain = os.path.realpath(plain) if uri.getScheme() == "file" else os.path.normpath(plain)
    return [uri.getScheme(), uri.getAuthority() or "", *[x for x in plain.split("/") if x]]


if __name__ == "__main__":
    main()
