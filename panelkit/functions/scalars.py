"""Column expressions (F01-F16). All are built-in Spark functions, so they stay
inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number_of_products(products: Iterable[str]) -> Column:
    """row total of product flags, nulls skipped (counted as 0)."""
    terms = [F.coalesce(F.col(p).cast("int"), F.lit(0)) for p in products]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def year_of(c) -> Column:
    """F02."""
    return F.year(col(c))


def month_of(c) -> Column:
    """F02."""
    return F.month(col(c))


def whole_month_diff(later, earlier) -> Column:
    """(y2 - y1) * 12 + (m2 - m1); the day of month is ignored."""
    return ((F.year(col(later)) - F.year(col(earlier))) * 12
            + (F.month(col(later)) - F.month(col(earlier))))


def log_or_null(c) -> Column:
    """natural log; 0 and negatives give NULL (numpy gives -inf / NaN)."""
    x = col(c)
    return F.when(x > 0, F.ln(x))


def to_numeric(c) -> Column:
    """numeric parse of text, bad text to NULL."""
    return F.expr(f"try_cast(trim(cast({_sql(c)} as string)) as double)")


def replace_value(c, old, new) -> Column:
    """replace one value by another, everything else unchanged."""
    x = col(c)
    return F.when(x == F.lit(old), F.lit(new)).otherwise(x)


def to_int(c) -> Column:
    """integer cast of padded / float text; bad text to NULL; truncates."""
    return F.expr(f"try_cast(try_cast(trim(cast({_sql(c)} as string)) as double) as int)")


def positive_or_zero(c) -> Column:
    """Keep positive values, everything else (and NULL) becomes 0."""
    x = col(c)
    return F.when(x > 0, x).otherwise(F.lit(0))


def is_null(c) -> Column:
    """F10."""
    return col(c).isNull()


def eq_zero(c) -> Column:
    """equality to zero (NULL stays NULL)."""
    return col(c) == 0


def format_date(c, fmt: str = "dd-MM-yyyy") -> Column:
    """date to text, NULL-safe."""
    return F.date_format(col(c), fmt)


def parse_date(c, fmt: str = "dd-MM-yyyy") -> Column:
    """text to date, invalid text to NULL."""
    return F.expr(f"try_to_date({_sql(c)}, '{fmt}')")


def fill_with(c, value) -> Column:
    """NULL to a stored constant (e.g. the train mean income)."""
    return F.coalesce(col(c), F.lit(value))


def round_to(c, places: int = 4) -> Column:
    """scale by 10^places, round half away from zero, scale back; DuckDB's ``round`` gives the same.

    The product is a double already: where it falls on a half, the result can differ in the last
    place from Python's ``round`` (0.15455 gives 0.1546, Python 0.1545) and from ``F.round``, which
    rounds the shortest decimal text (0.01775 gives 0.0177 here and 0.0178 there).
    """
    x = col(c).cast("double")
    p = float(10 ** places)
    return F.signum(x) * F.floor(F.abs(x) * p + F.lit(0.5)) / F.lit(p)


def strip_prefix(c, prefix: str) -> Column:
    """substring after a known prefix."""
    return F.substring(col(c), len(prefix) + 1, 1 << 20)


def underscore_blanks(c) -> Column:
    """replace blanks by underscores."""
    return F.regexp_replace(col(c), " ", "_")


def null_count(columns: Iterable[str]) -> Column:
    """Number of NULL cells in a row."""
    terms = [F.col(c).isNull().cast("int") for c in columns]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def _sql(c) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("SQL-text helpers take column names")
