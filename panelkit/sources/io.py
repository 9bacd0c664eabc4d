"""Sources and sinks (S01-S05): typed CSV, Parquet, the read-through cache.

Paths may be any Hadoop URI (``s3a://``, ``hdfs://``, ``abfss://``); nothing
here touches the local file system directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_CSV_TEXT = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType,
                   date_format: str = "yyyy-MM-dd", mode: str = "FAILFAST") -> DataFrame:
    """CSV with a declared schema; the header line is skipped and the
    schema's names replace it by position (``enforceSchema``), which is the
    reference's ``header=0, names=...`` rename. Padded text stays padded. A malformed
    record fails the read; ``mode="PERMISSIVE"`` turns its bad cells into NULL instead."""
    return (spark.read.schema(schema).option("header", "true").option("enforceSchema", "true")
                 .option("dateFormat", date_format).option("mode", mode)
                 .options(**_CSV_TEXT).csv(path))


def write_csv(df: DataFrame, path: str, header_names: list[str] | None = None,
              date_format: str = "yyyy-MM-dd") -> None:
    """CSV sink with an optional header of other (source) names."""
    out = df.toDF(*header_names) if header_names else df
    (out.write.mode("overwrite").option("header", "true").option("dateFormat", date_format)
        .options(**_CSV_TEXT).csv(path))


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  spread_by: list[str] | None = None) -> None:
    """Parquet sink, overwrite; partitioned by period for pruning.

    With ``partition_by``, rows are first rebalanced by the partition columns: Spark
    merges small periods and splits a period holding a third of the rows, by size, so
    the number of files follows the data. ``spread_by`` rebalances by more columns.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by, *[c for c in (spread_by or []) if c in df.columns])
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan (filters / projections above it reach the scan)."""
    return spark.read.parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS"))


def csv_to_parquet(spark: SparkSession, csv_path: str, parquet_path: str,
                   schema: T.StructType, partition_by: list[str] | None = ("fetch_date",),
                   date_format: str = "yyyy-MM-dd", post=None) -> DataFrame:
    """Typed CSV scan, then a Parquet table partitioned by period.

    ``post`` is applied between the scan and the write (e.g.
    ``schema.cast_products`` after a ``snapshot_schema(raw=True)`` read).
    """
    df = read_csv_typed(spark, csv_path, schema, date_format)
    if post is not None:
        df = post(df)
    write_parquet(df, parquet_path, list(partition_by) if partition_by else None)
    return read_parquet(spark, parquet_path)


def cached_table(spark: SparkSession, parquet_path: str, csv_path: str, schema: T.StructType,
                 partition_by: list[str] | None = ("fetch_date",)) -> DataFrame:
    """Read-through cache: use the Parquet table if it was written
    completely (``_SUCCESS``), else parse the CSV once and write it."""
    if _exists(spark, parquet_path):
        return read_parquet(spark, parquet_path)
    return csv_to_parquet(spark, csv_path, parquet_path, schema, partition_by)


def write_bucketed(df: DataFrame, table: str, path: str, by: str = "id",
                   buckets: int | None = None, sort_by: list[str] | None = ("id", "fetch_date")
                   ) -> DataFrame:
    """Panel table bucketed (and sorted) by client, registered in the catalog.

    Windows over ``partitionBy(id)`` and joins on ``id`` against another table
    with the same bucketing then read co-located data: the label build runs
    with no exchange at all. A bucket holds many clients; a client has one row
    per period, so no bucket is dominated by one key.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    w = df.repartition(n, by).write.mode("overwrite").option("path", path).bucketBy(n, by)
    if sort_by:
        w = w.sortBy(*sort_by)
    w.saveAsTable(table)
    return spark.table(table)
