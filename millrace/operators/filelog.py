"""Small tables that grow by whole files: additions that commit alone, and compaction into generations.

An addition is written in a folder of its own and its one file then moved into the table, so several writers do not disturb
each other. Compaction writes a new file from the files that it has read and removes just these; an addition made meanwhile
is in none of them. Rows may so be there twice for a moment, or after a crash; readers must not mind. Rows that hold each by
itself may be added as several files, so that none passes one task whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

T_ = TypeVar("T_")

ADDED = "_added"
#: Formats whose tables are folders of files, without a commit log of their own.
FILE_FORMATS = {"parquet", "orc", "avro", "json"}


def place(spark: SparkSession, table: str) -> tuple[str, str]:
    """Folder and format of a table."""
    told = {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return told.get("Location", ""), told.get("Provider", "").lower()


def location(spark: SparkSession, table: str) -> str:
    return place(spark, table)[0]


def file_system(spark: SparkSession, folder: str):
    """Hadoop's file system of a folder, and what makes its paths."""
    new_path = spark._jvm.org.apache.hadoop.fs.Path
    return new_path(folder).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), new_path


def matching_files(spark: SparkSession, pattern: str) -> list[str]:
    """The visible files that a glob pattern matches."""
    fs, new_path = file_system(spark, pattern.split("*")[0])
    found = fs.globStatus(new_path(pattern)) or []
    return [f.getPath().toString() for f in found if f.isFile() and f.getPath().getName()[0] not in "._"]


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Removes files or folders; those that are gone are left aside."""
    for path in paths:
        fs, new_path = file_system(spark, path)
        fs.delete(new_path(path), True)


def typed_as(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a schema, in its types; missing ones are null."""
    given = {name.lower(): name for name in rows.columns}
    return rows.select(*[
        (F.col(given[f.name.lower()]) if f.name.lower() in given else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def add(rows: DataFrame, table: str, whole: bool = True) -> None:
    """Adds a few rows to a file table without partitions, as one file: all of them or none.

    Without ``whole`` any number of rows: each of their partitions is a file, and the files come one after the other.
    """
    spark = rows.sparkSession
    (folder, fmt), name = place(spark, table), uuid.uuid4().hex
    if fmt not in FILE_FORMATS:
        raise ValueError(f"{table} is no table of files")
    own = f"{folder}/{ADDED}/{name}"
    typed = typed_as(rows, spark.table(table).schema)
    (typed.coalesce(1) if whole else typed).write.format(fmt).save(own)
    fs, new_path = file_system(spark, folder)
    for i, path in enumerate(matching_files(spark, f"{own}/*")):
        if not fs.rename(new_path(path), new_path(f"{folder}/add-{name}-{i}.{fmt}")):
            raise OSError(f"{path} could not be moved into {table}")
    remove(spark, [own])
    spark.catalog.refreshTable(table)


def compact(spark: SparkSession, table: str, most: int, merge: Callable[[DataFrame], DataFrame],
            progress: Callable[[str], None] = lambda step: None, whole: bool = True) -> bool:
    """Writes the rows of a table of more than ``most`` additions as one new addition, and removes the files that it has read.

    ``merge`` says which rows go on, ``whole`` whether as one file. ``progress`` is told the steps: read, written, removed.
    """
    folder, fmt = place(spark, table)
    files = matching_files(spark, f"{folder}/*") if fmt in FILE_FORMATS else []
    if len({path.rsplit("-", 1)[0] for path in files}) <= most:
        return False
    rows = spark.read.schema(spark.table(table).schema).format(fmt).load(files)
    progress("read")
    add(merge(rows), table, whole)
    progress("written")
    remove(spark, files)
    spark.catalog.refreshTable(table)
    progress("removed")
    return True


def steady(spark: SparkSession, table: str, read: Callable[[DataFrame], T_], tries: int = 3) -> T_:
    """What ``read`` makes of a table, done again where a compaction removed a file under it."""
    for attempt in range(1, tries + 1):
        try:
            return read(spark.table(table))
        except Exception as error:  # the class depends on where the reader noticed it
            if attempt == tries or "FILE_NOT_EXIST" not in str(error):
                raise
            spark.catalog.refreshTable(table)
    raise AssertionError
