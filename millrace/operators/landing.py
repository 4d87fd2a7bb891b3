"""Landing: append, replace, truncate-and-load and partition overwrite into catalog tables.

A load writes its rows once and takes its counts from that write. Replacing loads write beside the
target first, so a failing read leaves the old rows in place.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import and_, or_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.filelog import location, matching_files, remove
from millrace.operators.partitions import partitioned
from millrace.sources.dialects import text_literal

# Formats whose tables commit atomically and evolve their schema by name.
ATOMIC_FORMATS = {"iceberg", "delta"}
# Fixed value: the table property that lets a write bring new columns.
ANY_SCHEMA = {"iceberg": ("write.spark.accept-any-schema", "true")}
# Table properties of a staged table: that it holds all of its rows, and where its target lay.
COMPLETE = "millrace.complete"
LOCATION = "millrace.location"
# Table property: the last load whose rows came in by a replacement of the table.
LOAD = "millrace.load"
# Option of a job that allows a load to rewrite its table with wider types.
WIDEN = "millrace.widen"
# Option of a job with a change window: the key columns, comma-separated, by which its rows replace older ones.
MERGE_KEY = "millrace.merge_key"
PARTITION_HEADING = "# Partition Information"
DYNAMIC = "'partitionOverwriteMode'='dynamic'"
STATIC = "'partitionOverwriteMode'='static'"
# Fixed value: the setting of a write that names its files.
BASENAME = "mapreduce.output.basename"


@dataclass(frozen=True)
class Landed:
    """Rows written, columns read (a derived partition column not counted), day of the snapshot."""

    rows: int
    columns: int
    load_date: str | None


class SchemaConflict(ValueError):
    """An incoming column does not fit the type that the target holds."""


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    """From the part of DESCRIBE that follows the columns; listing them by the catalog API is slow."""
    lines = [row.col_name for row in spark.sql(f"DESCRIBE TABLE {table}").collect()]
    if PARTITION_HEADING not in lines:
        return []
    return [line for line in lines[lines.index(PARTITION_HEADING) + 1 :] if line and not line.startswith("#")]


# Integers and the digits that each may have.
INTEGERS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}


def _digits(dtype: T.DataType) -> tuple[int, int] | None:
    """Digits before and after the point of an exact number."""
    if dtype in INTEGERS:
        return INTEGERS[dtype], 0
    return (dtype.precision - dtype.scale, dtype.scale) if isinstance(dtype, T.DecimalType) else None


def _fits(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of ``new`` can be stored as ``old`` unchanged; of nested types, part by part."""
    if old == new or isinstance(new, T.NullType):
        return True
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        held = {f.name.lower(): f.dataType for f in old.fields}
        return all(f.name.lower() in held and _fits(held[f.name.lower()], f.dataType) for f in new.fields)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return _fits(old.elementType, new.elementType)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return _fits(old.keyType, new.keyType) and _fits(old.valueType, new.valueType)
    if isinstance(old, (T.TimestampType, T.TimestampNTZType)):
        return isinstance(new, T.DateType)
    if old in INTEGERS:
        return new in INTEGERS and INTEGERS[new] <= INTEGERS[old]
    if isinstance(old, T.DecimalType):
        given, held = _digits(new), _digits(old)
        return given is not None and given[0] <= held[0] and given[1] <= held[1]
    if isinstance(old, T.DoubleType):
        return isinstance(new, T.FloatType) or (new in INTEGERS and INTEGERS[new] <= 10)
    return False


def _wider(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """The smallest type that holds both, None where there is none.

    A decimal of 38 digits is the type of a number whose digits are not declared: it takes the longer fraction, and the insert
    checks that the digits before the point still fit.
    """
    if _fits(old, new):
        return old
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        fields = _merged_fields(old, new)
        return None if any(f.dataType is None for f in fields) else T.StructType(
            [T.StructField(f.name, f.dataType, metadata=f.metadata) for f in fields])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        element = _wider(old.elementType, new.elementType)
        return None if element is None else T.ArrayType(element)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        key, value = _wider(old.keyType, new.keyType), _wider(old.valueType, new.valueType)
        return None if key is None or value is None else T.MapType(key, value)
    if _fits(new, old):
        return new
    one, other = _digits(old), _digits(new)
    if one and other:
        whole, scale = (max(pair) for pair in zip(one, other, strict=True))
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
        if any(isinstance(t, T.DecimalType) and t.precision == 38 for t in (old, new)):
            return T.DecimalType(38, scale)
    return None


@dataclass(frozen=True)
class _Merged:
    """A field of two schemas; no type where none holds both."""

    name: str
    dataType: T.DataType | None
    metadata: dict
    comes: T.DataType


def _merged_fields(old: T.StructType, new: T.StructType) -> list[_Merged]:
    """The old fields by name, then those that only the new schema has."""
    given = {f.name.lower(): f for f in new.fields}
    fields = []
    for have in old.fields:
        comes = given.pop(have.name.lower(), have)
        fields.append(_Merged(have.name, _wider(have.dataType, comes.dataType), have.metadata, comes.dataType))
    return fields + [_Merged(f.name, f.dataType, f.metadata, f.dataType) for f in given.values()]


def merged_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """The old columns, widened where the new type needs it, then the added ones; structs, arrays and maps part by part."""
    fields = _merged_fields(old, new)
    for had, found in zip(old.fields, fields, strict=False):
        if found.dataType is None:
            raise SchemaConflict(
                f"column {had.name}: {found.comes.simpleString()} does not fit the target's {had.dataType.simpleString()}"
            )
    return T.StructType([T.StructField(f.name, f.dataType, metadata=f.metadata) for f in fields])


def _nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StructType, T.ArrayType, T.MapType))


def rebuilt(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value in a nested type that was merged with its own: struct fields by name, missing ones null, parts cast."""
    if have == want:
        return value
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        given = {f.name.lower(): f for f in have.fields}
        parts = [
            rebuilt(value[given[f.name.lower()].name], given[f.name.lower()].dataType, f.dataType).alias(f.name)
            if f.name.lower() in given else F.lit(None).cast(f.dataType).alias(f.name) for f in want.fields
        ]
        return F.when(value.isNotNull(), F.struct(*parts)).cast(want)
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: rebuilt(x, have.elementType, want.elementType)).cast(want)
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        keyed = value if have.keyType == want.keyType else F.transform_keys(value, lambda k, v: rebuilt(k, have.keyType, want.keyType))
        return F.transform_values(keyed, lambda k, v: rebuilt(v, have.valueType, want.valueType)).cast(want)
    return value.cast(want)


def aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` by name and in its order; missing ones are null, nested ones rebuilt.

    Plain types are left to the insert, which checks ranges.
    """
    given = {f.name.lower(): f for f in df.schema.fields}

    def column(f: T.StructField) -> Column:
        have = given.get(f.name.lower())
        if have is None:
            return F.lit(None).cast(f.dataType)
        value = F.col(quoted(have.name))
        return rebuilt(value, have.dataType, f.dataType) if _nested(have.dataType) and _nested(f.dataType) else value

    return df.select(*[column(f).alias(f.name) for f in schema.fields])


def add_columns(spark: SparkSession, table: str, fields: list[T.StructField]) -> None:
    if fields:
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")


def spread(df: DataFrame, columns: list[str]) -> DataFrame:
    """Gathers the rows of a partition value before the write, so that files stay few and large.

    Rebalancing splits a value that holds very many rows over several tasks.
    """
    return df.hint("rebalance", *[F.col(quoted(c)) for c in columns]) if columns else df


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Counts in the writing stage, after any shuffle, whose tasks are counted once."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


@dataclass(frozen=True)
class Definition:
    """What a replacement keeps of a table besides its columns."""

    comment: str | None = None
    location: str | None = None
    properties: Mapping[str, str] = field(default_factory=dict)
    options: Mapping[str, str] = field(default_factory=dict)


def definition(spark: SparkSession, table: str) -> Definition:
    """From the catalog; the location only of an external table, whose files are not the catalog's own."""
    lines = [(row.col_name, row.data_type) for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()]
    start = next((i for i, line in enumerate(lines) if line[0].startswith("# Detailed Table")), len(lines))
    told = dict(lines[start:])
    given = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    ours = {key: value for key, value in given.items()
            if key not in (COMPLETE, LOCATION, LOAD) and not key.startswith(("spark.sql.", "transient_", "option."))}
    storage = told.get("Storage Properties", "").strip("[]")
    options = dict(pair.split("=", 1) for pair in storage.split(", ") if "=" in pair)
    options.pop("serialization.format", None)
    options.pop("path", None)
    external = told.get("Type", "").upper() == "EXTERNAL"
    return Definition(told.get("Comment"), told.get("Location") if external else None, ours, options)


def create_table(spark: SparkSession, table: str, schema: T.StructType, fmt: str, by: list[str],
                 options: Mapping[str, str] | None = None, kept: Definition | None = None) -> None:
    """An empty table, so that a broken first load leaves a table that the next one can fill."""
    def column(f: T.StructField) -> str:
        comment = (f.metadata or {}).get("comment")
        return f"{quoted(f.name)} {f.dataType.simpleString()}" + (f" COMMENT {text_literal(comment)}" if comment else "")

    def pairs(given: Mapping[str, str]) -> str:
        return ", ".join(f"{text_literal(k)} = {text_literal(v)}" for k, v in given.items())

    kept = kept or Definition()
    options = {**kept.options, **(options or {})}
    clauses = [f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(map(column, schema.fields))}) USING {fmt}"]
    if options:
        clauses.append(f"OPTIONS ({pairs(options)})")
    if by:
        clauses.append(f"PARTITIONED BY ({', '.join(map(quoted, by))})")
    if kept.location:
        clauses.append(f"LOCATION {text_literal(kept.location)}")
    if kept.comment:
        clauses.append(f"COMMENT {text_literal(kept.comment)}")
    if kept.properties:
        clauses.append(f"TBLPROPERTIES ({pairs(kept.properties)})")
    spark.sql(" ".join(clauses))


def _files_of(load_id: str) -> str:
    """How the names of a load's files begin."""
    return f"load-{load_id}"


def insert(df: DataFrame, table: str, overwrite: list[str] | None = None, load_id: str | None = None) -> None:
    """Adds rows by column name, or replaces the partitions of the given columns that occur in them.

    The names of the files begin with the load's id, where one is given.
    """
    spark = df.sparkSession
    rows = aligned(df, spark.table(table).schema)
    into = f"INTO {table}" + (f" WITH ('{BASENAME}'='{_files_of(load_id)}')" if load_id else "")
    if overwrite:
        # Spark would replace all rows of a table that is not partitioned.
        missing = set(overwrite) - set(partition_columns(spark, table))
        if missing:
            raise ValueError(f"{table} is not partitioned by {', '.join(sorted(missing))}")
        into = f"OVERWRITE {table} WITH ({DYNAMIC})"
    spark.sql(f"INSERT {into} SELECT * FROM {{rows}}", rows=rows)


def _rename(spark: SparkSession, staged: str, table: str) -> None:
    # The new name must not name the catalog.
    spark.sql(f"ALTER TABLE {staged} RENAME TO {'.'.join(table.split('.')[-2:])}")
    if partition_columns(spark, table):
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{COMPLETE}', '{LOCATION}')")


def _property(spark: SparkSession, table: str, name: str) -> str | None:
    given = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return given.get(name)


def _refill(spark: SparkSession, staged: str, table: str) -> None:
    """Replaces all rows of a table by those of the staged one; the table itself stays as it is."""
    rows = aligned(spark.table(staged), spark.table(table).schema)
    rows = spread(rows, partition_columns(spark, table))
    spark.sql(f"INSERT OVERWRITE {table} WITH ({STATIC}) SELECT * FROM {{rows}}", rows=rows)
    load_id = _property(spark, staged, LOAD)
    if load_id:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{LOAD}' = {text_literal(load_id)})")
    spark.sql(f"DROP TABLE {staged}")


def _swap(spark: SparkSession, staged: str, table: str, fmt: str, kept: Definition, replace: str | None,
          load_id: str | None = None) -> None:
    """Puts the rows of a staged table in the place of the target's, marking it complete before.

    The staged table takes the target's name, which moves no row. A target with its own location is filled again from it, as
    its files must lie there.
    """
    marks = {COMPLETE: replace or "table"}
    if kept.location:
        marks[LOCATION] = kept.location
    if load_id:
        marks[LOAD] = load_id
    pairs = ", ".join(f"'{key}' = {text_literal(value)}" for key, value in marks.items())
    spark.sql(f"ALTER TABLE {staged} SET TBLPROPERTIES ({pairs})")
    if replace == "rows" and kept.location:
        _refill(spark, staged, table)
        return
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    _place(spark, staged, table, fmt, kept)


def _place(spark: SparkSession, staged: str, table: str, fmt: str, kept: Definition) -> None:
    if kept.location is None:
        _rename(spark, staged, table)
        return
    schema, by = spark.table(staged).schema, partition_columns(spark, staged)
    create_table(spark, table, schema, fmt, by, kept=kept)
    _refill(spark, staged, table)


def _recover(spark: SparkSession, staged: str, table: str, fmt: str) -> None:
    """Ends what a broken replacement left: takes a complete staged table, drops any other."""
    if not spark.catalog.tableExists(staged):
        return
    marks = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {staged}").collect()}
    if marks.get(COMPLETE) == "rows" and spark.catalog.tableExists(table):
        _refill(spark, staged, table)
    elif COMPLETE in marks and not spark.catalog.tableExists(table):
        _place(spark, staged, table, fmt, replace(definition(spark, staged), location=marks.get(LOCATION)))
    elif COMPLETE in marks and LOCATION in marks:
        _refill(spark, staged, table)
    else:
        spark.sql(f"DROP TABLE {staged}")


def undo_load(spark: SparkSession, table: str, load_id: str, fmt: str = "parquet") -> bool:
    """Ends an appending load of a file table that broke off: removes its files, also half-written ones.

    True where its rows came in whole by a replacement of the table, which holds the older rows too; they stay.
    """
    _recover(spark, f"{table}__staged", table, fmt)
    if not spark.catalog.tableExists(table):
        return False
    if _property(spark, table, LOAD) == load_id:
        return True
    depth = "*/" * len(partition_columns(spark, table))
    folder = location(spark, table)
    # What a broken write has left beside the table would be taken along by the next one.
    remove(spark, [f"{folder}/_temporary", *matching_files(spark, f"{folder}/{depth}{_files_of(load_id)}-*")])
    spark.catalog.refreshTable(table)
    return False


def _land_files(df: DataFrame, table: str, fmt: str, column: str | None, options: Mapping[str, str],
                mode: str | None, widen: bool, load_id: str | None) -> None:
    """File formats such as parquet and ORC.

    A type that must be widened rewrites the table, old rows and new, beside itself; only if allowed.
    """
    spark = df.sparkSession
    staged = f"{table}__staged"
    _recover(spark, staged, table, fmt)
    by = [column] if column else []
    overwrite = by if mode == "partitions" else None
    if not spark.catalog.tableExists(table):
        create_table(spark, table, df.schema, fmt, by, options)
        insert(df, table, load_id=load_id)
        return
    schema, kept = df.schema, definition(spark, table)
    if mode != "table":
        old = spark.table(table).schema
        schema = merged_schema(old, schema)
        by = partition_columns(spark, table)
        widened = [f.name for f, had in zip(schema.fields, old.fields) if f.dataType != had.dataType]
        if not widened:
            add_columns(spark, table, schema.fields[len(old):])
            if mode != "rows":
                insert(df, table, overwrite, load_id)
                return
        elif not widen:
            raise SchemaConflict(
                f"{table} must be rewritten to hold wider values in {', '.join(widened)}; "
                f"set the table option {WIDEN} to allow it"
            )
        elif mode == "rows":
            mode = "table"
    create_table(spark, staged, schema, fmt, by, options, replace(kept, location=None))
    if mode in (None, "partitions"):
        insert(spread(spark.table(table), by), staged)
    insert(df, staged, overwrite)
    _swap(spark, staged, table, fmt, kept, mode, load_id)


def _land_atomic(df: DataFrame, table: str, fmt: str, column: str | None, options: Mapping[str, str],
                 mode: str | None, widen: bool = True, load_id: str | None = None) -> None:
    """Table formats with atomic commits; they are given by the cluster's catalog."""
    spark = df.sparkSession
    writer = df.writeTo(table).using(fmt).options(**{"mergeSchema": "true", **options})
    if mode == "table" or not spark.catalog.tableExists(table):
        if column:
            writer = writer.partitionedBy(F.col(quoted(column)))
        writer.createOrReplace()
        return
    if fmt in ANY_SCHEMA:
        name, value = map(text_literal, ANY_SCHEMA[fmt])
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({name} = {value})")
    if mode == "rows":
        writer.overwrite(F.lit(True))
    elif mode == "partitions":
        if column not in partition_columns(spark, table):
            raise ValueError(f"{table} is not partitioned by {column}")
        writer.overwritePartitions()
    else:
        writer.append()


def _allowed(option: str | None) -> bool:
    return (option or "").lower() in ("y", "yes", "true")


def land(
    df: DataFrame,
    table: str,
    *,
    load_date: str,
    partition_by: str | None = None,
    recreate: bool = False,
    truncate: bool = False,
    partition_overwrite: bool = False,
    widen: bool = False,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    load_id: str | None = None,
) -> Landed:
    """Lands a frame in a table and returns the counts of the write.

    Default is append. ``recreate`` replaces table and schema, ``truncate`` replaces the rows,
    ``partition_overwrite`` replaces only the partitions that occur in the frame, which makes a repeat
    harmless. ``widen``, or the option of that name, lets a load rewrite a table of a file format whose types are too
    narrow. A table keeps its location, comments, properties and options. ``load_id`` marks what an append adds, so that
    ``undo_load`` can take it back if the process dies before the load has ended.
    """
    shaped = partitioned(df, partition_by, load_date)
    names = {name.lower(): name for name in shaped.df.columns}
    column = names.get(shaped.column.lower()) if shaped.column else None
    if shaped.column and column is None:
        raise ValueError(f"partition column {shaped.column} is not among the columns of {table}")
    by = [column] if column else []
    if not recreate and df.sparkSession.catalog.tableExists(table):
        by = [names[c.lower()] for c in partition_columns(df.sparkSession, table) if c.lower() in names]
    # A column with one value needs no shuffle: every task writes its rows where they are.
    varied = [c for c in by if not (shaped.constant and c == column)]
    rows, seen = _counted(spread(shaped.df, varied))
    mode = "table" if recreate else "rows" if truncate else None
    if mode is None and partition_overwrite and column:
        mode = "partitions"
    given = dict(options or {})
    given.pop(MERGE_KEY, None)
    widen = _allowed(given.pop(WIDEN, "")) or widen
    write = _land_atomic if fmt in ATOMIC_FORMATS else _land_files
    write(rows, table, fmt, column, given, mode, widen, load_id if mode is None else None)
    return Landed(seen.get["rows"], len(df.columns), shaped.load_date)


def _in_partitions(by: list[str], rows: list[Row]) -> Column:
    """Whether a row lies in one of the given partitions; plain comparisons, which prune the scan."""
    if len(by) == 1:
        values = [row[0] for row in rows if row[0] is not None]
        found = F.col(quoted(by[0])).isin(values) if values else F.lit(False)
        return F.coalesce(found, F.lit(False)) | F.col(quoted(by[0])).isNull() if len(values) < len(rows) else F.coalesce(found, F.lit(False))
    one = [reduce(and_, (F.col(quoted(c)).eqNullSafe(F.lit(v)) for c, v in zip(by, row, strict=True))) for row in rows]
    return reduce(or_, one, F.lit(False))


def merge(
    df: DataFrame,
    table: str,
    keys: list[str],
    *,
    load_date: str,
    partition_by: str | None = None,
    widen: bool = False,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> Landed:
    """Lands rows in the place of those with the same key, in a file table; returns the counts of the rows that came.

    Only partitions that hold an older version are written anew; rows for others are added to them, and a partition whose
    rows have all moved is emptied. A table without partitions is replaced. Null is a key like any other; all rows that
    come are kept, also several of one key. A repeat of a broken merge gives the same rows.
    """
    spark = df.sparkSession
    if fmt in ATOMIC_FORMATS:
        raise ValueError(f"{fmt} merges by its own MERGE")
    shaped = partitioned(df, partition_by, load_date)
    given = {name.lower(): name for name in shaped.df.columns}
    missing = [key for key in keys if key.lower() not in given]
    if missing or not keys:
        raise ValueError(f"merge key {', '.join(missing)} is not among the columns of {table}")
    changes = f"{table}__changes"
    spark.sql(f"DROP TABLE IF EXISTS {changes}")
    _recover(spark, f"{table}__staged", table, fmt)
    if not spark.catalog.tableExists(table):
        return land(df, table, load_date=load_date, partition_by=partition_by, widen=widen, fmt=fmt, options=options)
    by = partition_columns(spark, table)
    _evolve(spark, shaped.df, table, fmt, widen or _allowed((options or {}).get(WIDEN)))
    target = spark.table(table)
    create_table(spark, changes, target.schema, fmt, by)
    rows, seen = _counted(spread(shaped.df, [c for c in by if c.lower() in given]))
    insert(rows, changes)
    new, old = spark.table(changes), spark.table(table)
    changed = new.select(*[F.col(quoted(key)).alias(f"_key{i}") for i, key in enumerate(keys)]).distinct()
    same = reduce(and_, (old[quoted(key)].eqNullSafe(changed[f"_key{i}"]) for i, key in enumerate(keys)))
    if not by:
        both = old.join(changed, same, "left_anti").unionByName(new)
        _land_files(both, table, fmt, None, {}, "rows", widen, None)
    else:
        columns = [F.col(quoted(c)) for c in by]
        touched = old.join(changed, same, "left_semi").select(*columns).distinct().collect()
        inside = _in_partitions(by, touched)
        if touched:
            kept = old.where(inside).join(changed, same, "left_anti").unionByName(new.where(inside))
            filled = {tuple(row) for row in kept.select(*columns).distinct().collect()}
            if filled:
                insert(spread(kept, by), table, overwrite=by)
            for row in touched:
                if tuple(row) not in filled:
                    _empty(spark, table, by, row)
        insert(spread(new.where(~inside), by), table)
    spark.sql(f"DROP TABLE {changes}")
    return Landed(seen.get["rows"], len(df.columns), shaped.load_date)


def _empty(spark: SparkSession, table: str, by: list[str], partition: Row) -> None:
    """Removes the files that hold the rows of one partition, whoever owns them."""
    where = reduce(and_, (F.col(quoted(c)).eqNullSafe(F.lit(v)) for c, v in zip(by, partition, strict=True)))
    files = spark.table(table).where(where).select(F.col("_metadata.file_path").alias("path")).distinct().collect()
    remove(spark, [unquote(row.path) for row in files])
    spark.catalog.refreshTable(table)


def _evolve(spark: SparkSession, df: DataFrame, table: str, fmt: str, widen: bool) -> None:
    """Gives a file table the columns and, if allowed, the wider types that a frame needs."""
    old = spark.table(table).schema
    schema = merged_schema(old, df.schema)
    if all(f.dataType == had.dataType for f, had in zip(schema.fields, old.fields)):
        add_columns(spark, table, schema.fields[len(old):])
    else:
        _land_files(df.limit(0), table, fmt, None, {}, None, widen, None)
