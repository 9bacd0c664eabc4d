"""Bad records set aside instead of stopping a load or turning into NULLs.

Every input record ends up in one of two tables: the typed rows, or the rejects with the file,
the record's text and a reason. Reasons are ``fields`` (wrong number of fields), ``json`` (not a JSON
object) or the first column, in schema order, whose text does not fit its type. An empty
field is NULL, not an error; an empty file gives two empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .io import _CSV_TEXT

_BAD = "_bad_record"


def _does_not_fit(text: Column, kind: T.DataType, date_format: str) -> Column:
    if isinstance(kind, T.StringType):
        return F.lit(False)
    value = F.try_to_timestamp(text, F.lit(date_format)) if isinstance(kind, T.DateType) else text.try_cast(kind)
    return text.isNotNull() & value.isNull()


def _first_misfit(schema: T.StructType, of, date_format: str) -> Column:
    return F.coalesce(*[F.when(_does_not_fit(of(f.name), f.dataType, date_format), F.lit(f.name)) for f in schema.fields],
                      F.lit(None).cast("string"))


def read_csv_split(spark: SparkSession, path: str, schema: T.StructType, date_format: str = "yyyy-MM-dd",
                   header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of CSV files under a declared schema. Rejects: file, record, reason.

    Both are filters over the same scan of all columns: with fewer columns the parser would not see
    the bad ones. Only rejects pay for the second look that finds their reason.
    """
    full = T.StructType(schema.fields + [T.StructField(_BAD, T.StringType())])
    options = {"header": str(header).lower(), "enforceSchema": "true", "dateFormat": date_format, "mode": "PERMISSIVE",
               "columnNameOfCorruptRecord": _BAD, "columnPruning": "false", **_CSV_TEXT}
    read = spark.read.schema(full).options(**options).csv(path)
    # the columns' own text, with the parser's word on the number of fields
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(_BAD, T.StringType())])
    again = F.from_csv(F.col("record"), texts.simpleString()[7:-1].replace(":", " "), {"columnNameOfCorruptRecord": _BAD, **_CSV_TEXT})
    # Spark refuses a scan of the record's text alone and checks only the cells that a query reads, so the
    # test names every column: all its parts but the first are NULL
    every = [F.when(F.col(f"`{c}`") != F.col(f"`{c}`"), F.lit(0)) for c in schema.fieldNames()]
    is_bad = F.greatest(F.length(_BAD), *every).isNotNull()
    bad = read.where(is_bad).withColumn("record", F.col(_BAD)).withColumn("_t", again)
    # a cell with a text that the parser left NULL does not fit its type
    misfits = [F.when(F.col(f"_t.`{f.name}`").isNotNull() & F.col(f"`{f.name}`").isNull(), F.lit(f.name)) for f in schema.fields]
    reason = F.when(F.col(f"_t.{_BAD}").isNotNull(), "fields").otherwise(F.coalesce(*misfits, F.lit("fields")))
    bad = bad.select(F.col("_metadata.file_path").alias("file"), "record", reason.alias("reason"))
    return read.where(~is_bad).drop(_BAD), bad


def json_split(df: DataFrame, schema: T.StructType, date_format: str = "dd-MM-yyyy",
               value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of request strings. Rejects keep the columns of ``df`` and add reason; a NULL
    string is rejected as ``json``."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(_BAD, T.StringType())])
    parsed = df.withColumn("_t", F.from_json(F.col(value), texts, {"columnNameOfCorruptRecord": _BAD}))
    broken = F.col(f"_t.{_BAD}").isNotNull() | F.col("_t").isNull()
    parsed = parsed.withColumn("reason", F.when(broken, "json").otherwise(_first_misfit(schema, lambda c: F.col(f"_t.`{c}`"), date_format)))
    rows = parsed.where(F.col("reason").isNull()).select(*[
        (F.try_to_timestamp(F.col(f"_t.`{f.name}`"), F.lit(date_format)).cast("date") if isinstance(f.dataType, T.DateType)
         else F.col(f"_t.`{f.name}`").cast(f.dataType)).alias(f.name) for f in schema.fields])
    return rows, parsed.where(F.col("reason").isNotNull()).select(*df.columns, "reason")
