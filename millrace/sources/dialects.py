"""What differs between the source databases: catalogue queries, literals and hints.

All of it is text for the source; Spark runs it as the ``dbtable`` subquery of a JDBC scan.
"""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from millrace.functions.typemap import LONG_MAX
from millrace.operators.cdc import HourWindow, Key, KeyRange, Window
from millrace.sources.extract import Extract
from millrace.sources.splits import DEALT, ROW_COLUMN, SPLIT_COLUMN, Value


def number_literal(value: Key) -> str:
    return format(value, "f") if isinstance(value, Decimal) else repr(value)


def text_literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


class Dialect:
    """Shared SQL; a subclass gives the parts of one database."""

    name = ""
    plain_hint = ""

    def quoted(self, name: str) -> str:
        """A name as the catalogue gives it."""
        raise NotImplementedError

    def row_part(self, parts: int) -> str:
        """A number from 0 to ``parts`` - 1 that deals a table's rows evenly, from where they are stored."""
        raise NotImplementedError

    def table(self, schema: str, table: str) -> str:
        return f"{schema}.{table}"

    def timestamp(self, ts: datetime) -> str:
        raise NotImplementedError

    def columns_query(self, schema: str, table: str) -> str:
        raise NotImplementedError

    def object_types_query(self, schema: str, table: str) -> str:
        raise NotImplementedError

    def statistics_query(self, schema: str, table: str) -> str:
        raise NotImplementedError

    def count_query(self, schema: str, table: str) -> str:
        return f"SELECT COUNT(*) AS NUM_ROWS FROM {self.table(schema, table)}"

    def key_max_query(self, schema: str, table: str, column: str) -> str:
        return f"SELECT MAX({column}) AS MAX_VALUE FROM {self.table(schema, table)}"

    def window_condition(self, window: Window) -> str:
        """The window on the plain columns, so that the source can use an index on them."""
        if isinstance(window, KeyRange):
            upper = f"{window.column} <= {number_literal(window.hi)}"
            return upper if window.lo is None else f"{window.column} > {number_literal(window.lo)} AND {upper}"
        return " OR ".join(f"({self._hours(window, column)})" for column in window.columns)

    def _hours(self, window: HourWindow, column: str) -> str:
        upper = f"{column} < {self.timestamp(window.hi)}"
        return upper if window.lo is None else f"{column} >= {self.timestamp(window.lo)} AND {upper}"

    def condition(self, extract: Extract) -> str | None:
        """Window and user condition, each in parentheses so that an OR in one stays in it."""
        parts = [] if extract.window is None else [f"({self.window_condition(extract.window)})"]
        if extract.where:
            parts.append(f"({extract.where})")
        return " AND ".join(parts) or None

    def literal(self, value: Value) -> str:
        """A bound of a split."""
        return self.timestamp(value) if isinstance(value, datetime) else number_literal(value)

    def relation(self, schema: str, table: str, extract: Extract) -> str:
        """The rows to read, as what follows FROM."""
        condition = self.condition(extract)
        return self.table(schema, table) + (f" WHERE {condition}" if condition else "")

    def extract_query(self, schema: str, table: str, extract: Extract, all_columns: str = "*",
                      split: str | None = None, dealt: bool = False) -> str:
        """``split`` is an expression to add as the split column; ``dealt`` adds the place of a row.

        The table has no alias, so the fields and conditions of a job mean the same with and without a split.
        """
        plain = extract.window is None and not extract.where and not extract.fields
        hint = f"{self.plain_hint} " if plain and self.plain_hint else ""
        chosen = extract.fields or all_columns
        if split:
            # A bare star takes no further column beside it.
            chosen = f"{self.table(schema, table)}.*" if chosen.strip() == "*" else chosen
            chosen = f"{chosen}, {split} AS {SPLIT_COLUMN}"
            chosen += f", {self.row_part(DEALT)} AS {ROW_COLUMN}" if dealt else ""
        return f"SELECT {hint}{chosen} FROM {self.relation(schema, table, extract)}"

    def window_value(self, window: HourWindow) -> str:
        """Of several change columns the first whose value lies in the window, so that it is within its bounds."""
        *others, last = window.columns
        cases = " ".join(f"WHEN {self._hours(window, column)} THEN {column}" for column in others)
        return f"CASE {cases} ELSE {last} END" if others else last


class Oracle(Dialect):
    name = "ORACLE"
    # Fixed value: the parallel hint of an unfiltered read.
    plain_hint = "/*+ PARALLEL(16) */"

    def quoted(self, name: str) -> str:
        return '"' + name.replace('"', '""') + '"'

    def row_part(self, parts: int) -> str:
        return f"ORA_HASH(ROWID, {parts - 1})"

    def timestamp(self, ts: datetime) -> str:
        # A DATE literal fits DATE and TIMESTAMP columns without converting the column.
        return f"TO_DATE('{ts:%Y-%m-%d %H:%M:%S}', 'YYYY-MM-DD HH24:MI:SS')"

    def _owned(self, name_column: str, schema: str, table: str) -> str:
        owner, name = text_literal(schema.upper()), text_literal(table.upper())
        return f"OWNER = {owner} AND {name_column} = {name}"

    def columns_query(self, schema: str, table: str) -> str:
        owned = self._owned("TABLE_NAME", schema, table)
        return (
            "SELECT COLUMN_NAME, DATA_TYPE, COLUMN_ID AS ORDINAL_POSITION, DATA_PRECISION, DATA_SCALE "
            f"FROM ALL_TAB_COLUMNS WHERE {owned}"
        )

    def object_types_query(self, schema: str, table: str) -> str:
        owned = self._owned("OBJECT_NAME", schema, table)
        return f"SELECT DISTINCT OBJECT_TYPE FROM ALL_OBJECTS WHERE {owned} AND SUBOBJECT_NAME IS NULL"

    def statistics_query(self, schema: str, table: str) -> str:
        owned = self._owned("TABLE_NAME", schema, table)
        return f"SELECT NUM_ROWS FROM ALL_TABLES WHERE {owned}"

    def scale_profile_query(self, schema: str, table: str, numbers: list[str], extract: Extract | None = None) -> str:
        """Counts of fractional values and longest fractions of NUMBER columns among the rows to read, in one scan."""
        parts = []
        for i, column in enumerate(map(self.quoted, numbers)):
            fractional = f"CASE WHEN {column} <> TRUNC({column})"
            text = f"TO_CHAR({column}, 'TM9', 'NLS_NUMERIC_CHARACTERS=''.,''')"
            digits = f"LENGTH(SUBSTR({text}, INSTR({text}, '.') + 1))"
            parts.append(f"COUNT({fractional} THEN 1 END) AS N{i}")
            parts.append(f"MAX({fractional} THEN {digits} END) AS S{i}")
            parts.append(f"MAX(CASE WHEN ABS({column}) > {LONG_MAX} THEN 1 ELSE 0 END) AS W{i}")
        condition = self.condition(extract) if extract else None
        tail = f" WHERE {condition}" if condition else ""
        return f"SELECT {', '.join(parts)} FROM {self.table(schema, table)}{tail}"


class SqlServer(Dialect):
    name = "MSSQL"

    def quoted(self, name: str) -> str:
        return "[" + name.replace("]", "]]") + "]"

    def row_part(self, parts: int) -> str:
        # Fixed value: the pseudo column of a row's place.
        return f"ABS(CHECKSUM(%%physloc%%) % {parts})"

    def timestamp(self, ts: datetime) -> str:
        # Text takes the type of the column it is compared with, so the column is not converted.
        return f"'{ts:%Y-%m-%dT%H:%M:%S}'"

    def columns_query(self, schema: str, table: str) -> str:
        return (
            "SELECT COLUMN_NAME, DATA_TYPE, ORDINAL_POSITION, NUMERIC_PRECISION AS DATA_PRECISION, "
            "NUMERIC_SCALE AS DATA_SCALE FROM INFORMATION_SCHEMA.COLUMNS "
            f"WHERE TABLE_SCHEMA = {text_literal(schema)} AND TABLE_NAME = {text_literal(table)}"
        )

    def object_types_query(self, schema: str, table: str) -> str:
        kind = "CASE TABLE_TYPE WHEN 'BASE TABLE' THEN 'TABLE' ELSE TABLE_TYPE END"
        return (
            f"SELECT DISTINCT {kind} AS OBJECT_TYPE FROM INFORMATION_SCHEMA.TABLES "
            f"WHERE TABLE_SCHEMA = {text_literal(schema)} AND TABLE_NAME = {text_literal(table)}"
        )

    def statistics_query(self, schema: str, table: str) -> str:
        name = text_literal(f"{schema}.{table}")
        return (
            "SELECT SUM(rows) AS NUM_ROWS FROM sys.partitions "
            f"WHERE object_id = OBJECT_ID({name}) AND index_id IN (0, 1)"
        )
