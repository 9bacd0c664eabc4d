"""JSON row boundary (S06, S07): request strings to typed rows and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scalars import parse_date


def rows_to_json(df: DataFrame, date_format: str = "dd-MM-yyyy",
                 bad_date: tuple[str, Column, str] | None = None,
                 out: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """One JSON object per row; dates as text, NULL fields kept as null.

    ``bad_date`` = (column, condition, text) writes ``text`` instead of the date
    where ``condition`` holds; used to make malformed requests.
    """
    fields = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(F.col(f.name), date_format)
            if bad_date is not None and bad_date[0] == f.name:
                c = F.when(bad_date[1], F.lit(bad_date[2])).otherwise(c)
            fields.append(c.alias(f.name))
        else:
            fields.append(F.col(f.name))
    return df.select(*keep, F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias(out))


def json_to_rows(df: DataFrame, schema: T.StructType, date_format: str = "dd-MM-yyyy",
                 value: str = "value") -> DataFrame:
    """Parse request strings with an explicit schema.

    Dates are read as text and parsed with ``try_to_date`` so a bad date becomes
    NULL without touching the other fields (F12).
    """
    text_schema = T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.DateType)
                      else f.dataType, True) for f in schema.fields])
    parsed = df.select(F.from_json(F.col(value), text_schema).alias("r")).select("r.*")
    return parsed.select(*[
        parse_date(f.name, date_format).alias(f.name) if isinstance(f.dataType, T.DateType)
        else F.col(f.name) for f in schema.fields])
