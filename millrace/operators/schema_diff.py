"""What changed between two column lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NO_CHANGE = "No schema changes detected."


def schema_diff(previous: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """ADDED, DROPPED, TYPE_CHANGED or SAME for every column of either list.

    Both lists have the key columns and ``data_type``, one row per column.
    """
    old = previous.select(*keys, F.col("data_type").alias("old_type"), F.lit(True).alias("_had"))
    new = current.select(*keys, F.col("data_type").alias("new_type"), F.lit(True).alias("_has"))
    change = (
        F.when(F.col("_had").isNull(), "ADDED")
        .when(F.col("_has").isNull(), "DROPPED")
        .when(~F.col("old_type").eqNullSafe(F.col("new_type")), "TYPE_CHANGED")
        .otherwise("SAME")
    )
    return old.join(new, keys, "full_outer").withColumn("change", change).drop("_had", "_has")


def _sentence(changes: list[tuple[str, str, str | None, str | None]]) -> str:
    """Of (name, change, old type, new type), in the order of names."""
    parts = [f"{change} {name}" + (f" ({old} -> {new})" if change == "TYPE_CHANGED" else "")
             for name, change, old, new in sorted(changes) if change != "SAME"]
    return "; ".join(parts) or NO_CHANGE


def change_text(diff: DataFrame) -> str:
    """The changes of one table as a sentence for the ledger."""
    rows = diff.where("change <> 'SAME'").collect()
    return _sentence([(row.column_name, row.change, row.old_type, row.new_type) for row in rows])


def change_list(old: dict[str, str], new: dict[str, str]) -> str:
    """The same for two column lists (name and type) that the driver holds already."""
    changes = [(name, "DROPPED", kind, None) for name, kind in old.items() if name not in new]
    changes += [(name, "ADDED", None, kind) for name, kind in new.items() if name not in old]
    changes += [(name, "TYPE_CHANGED", old[name], kind) for name, kind in new.items() if name in old and old[name] != kind]
    return _sentence(changes)


def column_list(df: DataFrame) -> DataFrame:
    """The columns of a frame as column_name and data_type; names in lower case, as Spark matches them."""
    rows = [(f.name.lower(), f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column_name string, data_type string")
