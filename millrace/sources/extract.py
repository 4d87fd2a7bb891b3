"""What to read of one table: fields, filter and change window, as a DataFrame or as source SQL."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.cdc import Window, changed_rows


@dataclass(frozen=True)
class Extract:
    """``fields`` is a SQL select list and ``where`` a SQL condition, both in the source's dialect."""

    fields: str | None = None
    where: str | None = None
    window: Window | None = None


def typed(df: DataFrame, ddl: str) -> DataFrame:
    """The columns that the DDL text names, read as its types; the others as they are.

    This is what ``customSchema`` does in a JDBC scan. A value that does not fit is an error.
    """
    wanted = {field.name.lower(): field.dataType for field in T.StructType.fromDDL(ddl).fields}
    return df.select(
        *[F.col(f"`{c}`").cast(wanted[c.lower()]).alias(c) if c.lower() in wanted else F.col(f"`{c}`")
          for c in df.columns]
    )


def extract_from(df: DataFrame, extract: Extract) -> DataFrame:
    """The extract of a relation that Spark reads itself.

    Filters come before the select list, so that a window may use a column that is not selected;
    Catalyst pushes both into the scan.
    """
    if extract.window is not None:
        df = changed_rows(df, extract.window)
    if extract.where:
        df = df.where(F.expr(f"({extract.where})"))
    if extract.fields:
        fields = extract.fields.replace("{", "{{").replace("}", "}}")
        df = df.sparkSession.sql(f"SELECT {fields} FROM {{extracted}}", extracted=df)
    return df
