"""Rows of a Spark query against rows of DuckDB SQL over the same Parquet files."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb
import pyarrow as pa


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """An in-memory database with one view per table of ``sf_dir``."""
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return db


def plain(value):
    """Times without a zone, dates as their midnight, whole decimals as integers, NaN as itself; lists and structs element by element."""
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    if isinstance(value, Decimal):
        return int(value) if value == value.to_integral_value() else value
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return value


def same(a, b) -> bool:
    """Whether two values agree: floats to a relative 1e-7, if both are or one is a decimal; integers, booleans, decimals, times and strings exactly."""
    if isinstance(a, float) and isinstance(b, (float, Decimal)) or isinstance(a, Decimal) and isinstance(b, float):
        a, b = float(a), float(b)
        return a == b or (math.isnan(a) and math.isnan(b)) or math.isclose(a, b, rel_tol=1e-7, abs_tol=1e-9)
    if isinstance(a, bool) != isinstance(b, bool):
        return False
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(same, a, b))
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(same(a[k], b[k]) for k in a)
    return a == b


def _rough(value) -> str:
    """A text to sort by that small differences of floats seldom change."""
    if isinstance(value, float):
        return f"{value:.6g}"
    if isinstance(value, list):
        return "[" + ",".join(map(_rough, value)) + "]"
    if isinstance(value, dict):
        return "{" + ",".join(f"{k}:{_rough(value[k])}" for k in sorted(value)) + "}"
    return repr(value)


def _inexact(kind: pa.DataType) -> bool:
    return pa.types.is_floating(kind) or pa.types.is_decimal(kind) or pa.types.is_nested(kind)


def difference(got: pa.Table, want: pa.Table) -> str | None:
    """What differs, or nothing. Rows are set side by side in the order of their exact columns, then of the others."""
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns {sorted(got.column_names)} and {sorted(want.column_names)}"
    if got.num_rows != want.num_rows:
        return f"{got.num_rows} rows and {want.num_rows} rows"
    names = sorted(got.column_names, key=lambda c: (_inexact(got.schema.field(c).type) or _inexact(want.schema.field(c).type), c))
    sides = []
    for table in (got, want):
        rows = zip(*([plain(v) for v in table.column(c).to_pylist()] for c in names))
        sides.append(sorted(rows, key=lambda r: tuple(map(_rough, r))))
    for a, b in zip(*sides):
        for name, x, y in zip(names, a, b):
            if not same(x, y):
                return f"{name}: {x!r} and {y!r} in {dict(zip(names, a))}"
    return None


def against_sql(frame, sf_dir: str, sql: str) -> str | None:
    """What differs between a Spark frame and the SQL over the tables of ``sf_dir``."""
    return difference(frame.toArrow(), database(sf_dir).execute(sql).to_arrow_table())
