"""Tables of a JDBC database: catalogue, probes and split scans."""

from __future__ import annotations

import math
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from millrace.functions.names import select_list
from millrace.functions.typemap import PROFILE_COLUMNS, schema_ddl, schema_map
from millrace.model import DECLARED_SCHEMA, TableJob
from millrace.operators.cdc import HourWindow, Key, KeyRange
from millrace.operators.profiles import ProfileStore
from millrace.sources.dialects import Dialect, Oracle, SqlServer
from millrace.sources.extract import Extract
from millrace.sources.splits import ROW_COLUMN, SPLIT_COLUMN, Histogram, Parts, even_parts

# Fixed values: (largest row count of the tier, fetch size); above the last tier LARGEST_FETCH.
FETCH_TIERS = [(0, 20), (100, 50), (500, 100), (5000, 200), (20000, 500), (50000, 1000), (100000, 5000)]
LARGEST_FETCH = 10000

TIME_PER_CONNECTION = timedelta(days=1)
# A select list that makes its own groups; a split column beside it would change them.
GROUPING = re.compile(r"^\s*DISTINCT\b|\b(COUNT|SUM|MIN|MAX|AVG|LISTAGG|STRING_AGG)\s*\(", re.IGNORECASE)


def fetch_size(row_count: Column) -> Column:
    """The JDBC fetch size for a table of that many rows; an unknown count is taken as none."""
    rows = F.coalesce(row_count, F.lit(0))
    chain = F.when(rows <= FETCH_TIERS[0][0], FETCH_TIERS[0][1])
    for limit, size in FETCH_TIERS[1:]:
        chain = chain.when(rows <= limit, size)
    return chain.otherwise(LARGEST_FETCH)


def fetch_size_of(row_count: int | None) -> int:
    """``fetch_size`` for a single table."""
    return next((size for limit, size in FETCH_TIERS if (row_count or 0) <= limit), LARGEST_FETCH)


@dataclass(frozen=True)
class JdbcConnection:
    url: str
    user: str
    driver: str
    password: str = field(default="", repr=False)
    properties: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def oracle(cls, config: Mapping[str, str], password: str) -> JdbcConnection:
        return cls(config["url"], config["db_user"], config["driver"], password)

    @classmethod
    def sql_server(cls, config: Mapping[str, str], password: str) -> JdbcConnection:
        host, port, name = config["db_host"], config["db_port"], config["db_name"]
        return cls(
            # Fixed value: the form of the address.
            f"jdbc:sqlserver://{host}.database.windows.net:{port};database={name}",
            config["db_user"],
            config["driver"],
            password,
            {
                "Encrypt": config.get("encrypt") or "true",
                "TrustServerCertificate": config.get("trustservercertificate") or "false",
            },
        )

    def options(self, query: str) -> dict[str, str]:
        """Reader options; the query is a ``dbtable`` subquery, which unlike ``query`` can be split."""
        return {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "dbtable": f"({query}) q",
            **self.properties,
        }


@dataclass(frozen=True)
class SplitSettings:
    """How scans are split: connections that one may open, rows worth one of them, and columns for full loads.

    ``columns`` names the split column of a table (``schema.table``) whose job has no change column.
    """

    connections: int = 16
    rows: int = 1_000_000
    columns: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def of(cls, config: Mapping[str, str]) -> SplitSettings:
        """From a pipeline's source settings; split columns are given as ``split_column.<schema>.<table>``."""
        start = "split_column."
        columns = {key[len(start):].lower(): value for key, value in config.items() if key.lower().startswith(start)}
        base = cls()
        return cls(int(config.get("max_connections") or base.connections),
                   int(config.get("rows_per_connection") or base.rows), columns)


class JdbcSource:
    """One database, read through Spark's JDBC reader."""

    def __init__(self, spark: SparkSession, connection: JdbcConnection, dialect: Dialect,
                 splits: SplitSettings | None = None, profiles: ProfileStore | None = None):
        self.profiles = profiles
        self.spark = spark
        self.connection = connection
        self.dialect = dialect
        self.splits = splits or SplitSettings()

    def scan(self, query: str, **options: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.connection.options(query), **options).load()

    def scan_parts(self, query: str, predicates: tuple[str, ...], **options: str) -> DataFrame:
        """A scan of one task per condition."""
        given = {**self.connection.options(query), **options}
        url, table = given.pop("url"), given.pop("dbtable")
        return self.spark.read.jdbc(url, table, predicates=list(predicates), properties=given)

    def catalogue(self, schema: str, table: str) -> DataFrame:
        """column_name, data_type, ordinal_position and the declared digits of one table."""
        found = self.scan(self.dialect.columns_query(schema, table))
        return found.select(
            F.col("COLUMN_NAME").alias("column_name"),
            F.col("DATA_TYPE").alias("data_type"),
            F.col("ORDINAL_POSITION").cast("int").alias("ordinal_position"),
            F.col("DATA_PRECISION").cast("int").alias("data_precision"),
            F.col("DATA_SCALE").cast("int").alias("data_scale"),
        ).orderBy("ordinal_position")

    def object_type(self, schema: str, table: str) -> str:
        rows = self.scan(self.dialect.object_types_query(schema, table)).collect()
        kinds = {row.OBJECT_TYPE.strip() for row in rows}
        if not kinds:
            raise ValueError(f"{schema}.{table} is not in the source's catalogue, so its type is unknown")
        return next((kind for kind in ("TABLE", "VIEW") if kind in kinds), min(kinds))

    def row_count(self, schema: str, table: str, kind: str | None = None) -> int | None:
        """Statistics for a table, a count for a view; None where the source does not know."""
        kind = kind or self.object_type(schema, table)
        if kind == "TABLE":
            query = self.dialect.statistics_query(schema, table)
        elif kind == "VIEW":
            query = self.dialect.count_query(schema, table)
        else:
            return None
        row = self.scan(query).first()
        return None if row is None or row.NUM_ROWS is None else int(row.NUM_ROWS)

    def key_max(self, job: TableJob) -> Key | None:
        query = self.dialect.key_max_query(job.source_schema, job.source_table, job.cdc_append_key_column)
        return self.scan(query).first().MAX_VALUE

    def scale_profile(self, schema: str, table: str, numbers: list[str], extract: Extract | None = None) -> DataFrame:
        """The profile of NUMBER columns by one aggregate inside the source, over the rows to read."""
        if not numbers:
            return self.spark.createDataFrame([], PROFILE_COLUMNS)
        totals = self.scan(self.dialect.scale_profile_query(schema, table, numbers, extract)).first()
        rows = [
            (name, int(totals[f"N{i}"]), int(totals[f"S{i}"] or 0), float(2**64) if totals[f"W{i}"] else 0.0)
            for i, name in enumerate(numbers)
        ]
        return self.spark.createDataFrame(rows, PROFILE_COLUMNS)

    def schema_text(self, schema: str, table: str, extract: Extract | None = None,
                    catalogue: list[Row] | None = None) -> str | None:
        """``customSchema`` for the scan; SQL Server keeps the connector's own types.

        Only NUMBER columns without declared digits are profiled, and of a select list those it names. Where profiles are kept, the
        rows to read are merged with what earlier loads saw, so a type never shrinks to that of one window.
        """
        if not isinstance(self.dialect, Oracle):
            return None
        rows = self.catalogue(schema, table).collect() if catalogue is None else catalogue
        read = extract.fields.lower() if extract and extract.fields else "*"
        rows = [row for row in rows if "*" in read or row.column_name.lower() in read]
        numbers = [row.column_name for row in rows if row.data_type == "NUMBER" and row.data_precision is None]
        if not rows:
            return None
        known = self.spark.createDataFrame(rows, DECLARED_SCHEMA)
        profile = self.scale_profile(schema, table, numbers, extract)
        if self.profiles is not None and numbers:
            profile = self.profiles.extend(schema, table, profile)
        return schema_ddl(schema_map(known, profile))

    def split(self, job: TableJob, extract: Extract, row_count: int | None, columns: list[str],
              kind: str = "TABLE") -> Parts | None:
        """A split of a scan that is worth several readers; an unknown row count is.

        A window splits on its own columns, a read without lower bound on the key or change column of the job, else on the
        one set for the table: into parts of even size, by a histogram of the rows to read. A table that has no such column is dealt by
        the place of its rows.
        """
        if extract.fields and GROUPING.search(extract.fields):
            return None
        most, window = self.splits.connections, extract.window
        parts = most if row_count is None else min(most, math.ceil(row_count / self.splits.rows))
        if isinstance(window, KeyRange) and isinstance(window.lo, int) and isinstance(window.hi, int):
            parts = min(most, math.ceil((window.hi - window.lo) / self.splits.rows))  # whole keys are no more than that
        elif isinstance(window, HourWindow) and window.lo is not None:
            parts = min(parts, math.ceil((window.hi - window.lo) / TIME_PER_CONNECTION))
        if parts <= 1:
            return None
        names = {raw.lower(): raw for raw in columns}
        if isinstance(window, KeyRange):
            wanted = [window.column]
        elif isinstance(window, HourWindow):
            wanted = list(window.columns)
        else:
            set_for = self.splits.columns.get(f"{job.source_schema}.{job.source_table}".lower())
            wanted = [set_for, job.cdc_append_key_column, job.cdc_modified_date_column, job.cdc_created_date_column]
        column = next((names[c.lower()] for c in wanted if c and c.lower() in names), None)
        if column is not None:
            expression = self.dialect.quoted(column)
            if isinstance(window, HourWindow):
                expression = self.dialect.window_value(window)
            relation = self.dialect.relation(job.source_schema, job.source_table, extract)
            histogram = Histogram(lambda query: self.scan(query).collect(), self.dialect.literal, relation, expression)
            found = even_parts(histogram, expression, parts, kind == "TABLE")
            if found is not None:
                return found
        if kind != "TABLE":
            return None
        return Parts(self.dialect.row_part(parts), tuple(f"{SPLIT_COLUMN} = {i}" for i in range(parts)), False)

    def columns(self, job: TableJob) -> list[str]:
        rows = self.catalogue(job.source_schema, job.source_table).collect()
        return [row.column_name for row in rows]

    def extract(self, job: TableJob, extract: Extract) -> DataFrame:
        """The rows of the job, typed, with a fetch size for the table and split where it is large.

        The catalogue is read once. The split column joins the select list and is dropped after the scan.
        """
        schema, table = job.source_schema, job.source_table
        catalogue = self.catalogue(schema, table).collect()
        columns = [row.column_name for row in catalogue]
        all_columns = select_list(columns) if isinstance(self.dialect, SqlServer) else "*"
        kind = self.object_type(schema, table)
        rows = self.row_count(schema, table, kind)
        options = {"fetchsize": str(fetch_size_of(rows))}
        types = self.schema_text(schema, table, extract, catalogue)
        if types:
            options["customSchema"] = types
        split = self.split(job, extract, rows, columns, kind)
        if split is None:
            return self.scan(self.dialect.extract_query(schema, table, extract, all_columns), **options)
        query = self.dialect.extract_query(schema, table, extract, all_columns, split.expression, split.dealt)
        return self.scan_parts(query, split.predicates, **options).drop(SPLIT_COLUMN, ROW_COLUMN)
