"""Date parsing, clean-up and column selection on typed rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the pattern of dates in the exports.
DATE_PATTERN = "yyyy-MM-dd'T'HH:mm:ss"


def parsed_date(text: Column, pattern: str = DATE_PATTERN) -> Column:
    return F.try_to_date(text, pattern)


def date_failed(text: Column, pattern: str = DATE_PATTERN) -> Column:
    """True where there is a value but it does not follow the pattern."""
    return text.isNotNull() & parsed_date(text, pattern).isNull()


def parse_dates(df: DataFrame, columns: Iterable[str], pattern: str = DATE_PATTERN) -> DataFrame:
    """Add ``<column>_parsed`` for each of ``columns`` that exists; the others are passed over."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    return df.withColumns({f"{c}_parsed": parsed_date(F.col(quoted(c)), pattern) for c in present})


def count_date_failures(df: DataFrame, column: str, pattern: str = DATE_PATTERN) -> DataFrame:
    """One row, ``<column>_failures``."""
    return df.agg(F.count_if(date_failed(F.col(quoted(column)), pattern)).alias(f"{column}_failures"))


def trim_strings(df: DataFrame) -> DataFrame:
    """Cut spaces, and only spaces, off both ends of every string column."""
    return df.select(
        *(
            F.trim(F.col(quoted(f.name))).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(quoted(f.name))
            for f in df.schema.fields
        )
    )


def drop_missing(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Keep rows that have every required value; NaN counts as missing, an empty string does not.

    Written as plain IS NOT NULL filters, which a columnar scan can evaluate.
    """
    require_columns(df, required)
    for name in required:
        column = F.col(quoted(name))
        df = df.where(column.isNotNull())
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            df = df.where(~F.isnan(column))
    return df


def clean(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Drop rows without their required values, then trim.

    Trimming keeps NULLs, so filtering first gives the same rows and lets the
    filter reach the scan.
    """
    return trim_strings(drop_missing(df, required))


def allowed_columns(columns: Sequence[str], allowed: Sequence[str]) -> list[str]:
    """The allowed names that exist, in the order of ``allowed``, exact case, repeats kept."""
    selected = [c for c in allowed if c in columns]
    if not selected:
        raise ValueError("none of the allowed columns exists, so there is nothing to select")
    return selected


def select_allowed_columns(df: DataFrame, allowed: Sequence[str]) -> DataFrame:
    return df.select(*(quoted(c) for c in allowed_columns(df.columns, allowed)))


def name_drift(names: DataFrame, allowed: DataFrame) -> DataFrame:
    """Compare two one-column tables of names: ``column, status``, one row per differing name.

    One pass over each table; the rows come in no order. NULL names are left out of neither:
    a NULL equals no other name.

    ``dropped`` names occur but are not allowed; ``missing`` ones are allowed but do not occur.
    """
    found = names.select(F.col(names.columns[0]).alias("column")).distinct().withColumn("occurs", F.lit(True))
    wanted = allowed.select(F.col(allowed.columns[0]).alias("column")).distinct().withColumn("allowed", F.lit(True))
    status = F.when(F.col("allowed").isNull(), "dropped").when(F.col("occurs").isNull(), "missing")
    both = found.join(wanted, "column", "full_outer").select("column", status.alias("status"))
    return both.where("status IS NOT NULL")


def column_drift(spark: SparkSession, columns: Sequence[str], allowed: Sequence[str]) -> DataFrame:
    """``name_drift`` for the columns of one table."""
    return name_drift(
        spark.createDataFrame([(c,) for c in columns], "column string"),
        spark.createDataFrame([(c,) for c in allowed], "column string"),
    )


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    absent = sorted({n for n in names if n not in df.columns})
    if absent:
        raise ValueError(f"columns not in the table: {', '.join(absent)}")
