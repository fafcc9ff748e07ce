"""Record layouts: which field starts where, and how long it is."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from filedrop import constants as C

MAX_FIELDS = 10_000


@dataclass(frozen=True)
class Field:
    name: str
    start: int
    length: int


class LayoutError(ValueError):
    """The layout sheet cannot be used."""


class Layout(tuple):
    """Checked fields in sheet order."""

    def __new__(cls, fields):
        fields = tuple(f if isinstance(f, Field) else Field(*f) for f in fields)
        _check(fields)
        return super().__new__(cls, fields)

    @property
    def names(self) -> list[str]:
        return [f.name for f in self]

    @property
    def schema(self) -> T.StructType:
        """Every field is nullable text."""
        return T.StructType([T.StructField(f.name, T.StringType(), True) for f in self])

    @property
    def table_schema(self) -> T.StructType:
        """The parsed table: fields, then run date and hour as text."""
        return self.schema.add("date", T.StringType(), True).add("hour", T.StringType(), True)


def _check(fields) -> None:
    if not fields:
        raise LayoutError("the layout has no fields")
    for f in fields:
        if not f.name or f.start is None or f.length is None:
            raise LayoutError(f"incomplete layout row: {f}")
        if f.start < 1 or f.length < 1:
            raise LayoutError(f"start and length must be 1 or more: {f}")
        if f.name.lower() in C.RESERVED_COLUMNS:
            raise LayoutError(f"reserved field name: {f.name}")
    counts = Counter(f.name.lower() for f in fields)
    twice = sorted(n for n, k in counts.items() if k > 1)
    if twice:
        raise LayoutError(f"duplicate field names: {twice}")


def layout_from_frame(df: DataFrame, max_fields: int = MAX_FIELDS) -> Layout:
    """Check a layout table and turn its few rows into a :class:`Layout`.

    ``max_fields`` guards the driver against a table that is no layout; a larger sheet is refused, never cut.
    """
    missing = [c for c in C.LAYOUT_COLUMNS if c not in df.columns]
    if missing:
        raise LayoutError(f"layout columns missing: {missing}")
    name, start, length = C.LAYOUT_COLUMNS
    rows = df.selectExpr(
        f"`{name}` as name", f"try_cast(`{start}` as int) as start", f"try_cast(`{length}` as int) as length"
    ).take(max_fields + 1)
    if len(rows) > max_fields:
        raise LayoutError(f"more than {max_fields} fields; this is no layout sheet")
    return Layout(Field(r["name"], r["start"], r["length"]) for r in rows)


def load_layout(spark: SparkSession, path: str) -> Layout:
    """Read a layout from CSV with a header, JSON lines or Parquet."""
    kind = path.rsplit(".", 1)[-1].lower()
    if kind == "json":
        df = spark.read.json(path)
    elif kind == "parquet":
        df = spark.read.parquet(path)
    else:
        # One partition keeps the sheet's row order.
        df = spark.read.option("header", True).csv(path).coalesce(1)
    return layout_from_frame(df)

