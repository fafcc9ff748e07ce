"""Fixed-width records: lossy decoding, native cutting and field slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from filedrop import constants as C
from filedrop.functions.names import _col

REPLACEMENT = "\ufffd"
# A private-use character used as an escape; doubled up while decoding, so real occurrences survive.
ESCAPE = "\ue000"


def decode_lossy(data) -> Column:
    """UTF-8 text of a binary column with undecodable bytes dropped.

    Valid text, the usual case, is passed through. Otherwise Spark marks the bad bytes with U+FFFD and these
    marks are removed; real U+FFFD characters are escaped first and restored afterwards.
    """
    raw = _col(data).cast("string")

    def swap(text, old, new):
        return F.replace(text, F.lit(old), F.lit(new))

    escaped = swap(swap(raw, ESCAPE, ESCAPE + "0"), REPLACEMENT, ESCAPE + "1")
    dropped = swap(F.make_valid_utf8(escaped), REPLACEMENT, "")
    restored = swap(swap(dropped, ESCAPE + "1", REPLACEMENT), ESCAPE + "0", ESCAPE)
    return F.when(F.is_valid_utf8(raw), raw).otherwise(restored)


def cut_records(df: DataFrame, content: str, size: int = C.RECORD_BYTES) -> DataFrame:
    """One row per ``size`` bytes of a binary column: adds ``ord`` (from 0) and ``rec``, drops the column.

    All native. An empty or NULL content gives no rows; the last record may be short.
    """
    n = F.ceil(F.octet_length(content) / F.lit(size))
    starts = F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), n - 1))
    piece = lambda i: F.substring(F.col(content), (i * size + 1).cast("int"), F.lit(size))
    keep = [c for c in df.columns if c != content]
    return df.select(*keep, F.posexplode(F.transform(starts, piece)).alias("ord", "rec")).select(
        *keep, F.col("ord").cast("bigint").alias("ord"), "rec"
    )


def slice_fields(df: DataFrame, layout, rec: str = "rec", mode: str = "chars", keep=()) -> DataFrame:
    """Cut every layout field out of a record column, as text, untrimmed.

    ``mode="chars"`` counts characters of the decoded record, so multibyte text shifts later fields.
    ``mode="bytes"`` counts bytes. Positions start at 1; a start past the end gives empty text.

    Character slicing walks the text from its start for each field. As long as the bytes up to the last field's end
    are plain ASCII, characters are bytes, and the record is sliced by position without being decoded at all.
    """
    if mode not in ("chars", "bytes"):
        raise ValueError(f"mode must be 'chars' or 'bytes', not {mode!r}")
    used = F.substring(rec, 1, max(f.start + f.length - 1 for f in layout)).cast("string")
    plain = F.is_valid_utf8(used) & (F.char_length(used) == F.octet_length(used))
    sliced = df.select(*keep, F.col(rec).alias("_rec"), plain.alias("_plain"))
    if mode == "chars":
        sliced = sliced.withColumn("_text", F.when(~F.col("_plain"), decode_lossy("_rec")))

    def field(f) -> Column:
        piece = F.substring("_rec", f.start, f.length)
        other = decode_lossy(piece) if mode == "bytes" else F.substring("_text", f.start, f.length)
        return F.when(F.col("_plain"), piece.cast("string")).otherwise(other).alias(f.name)

    return sliced.select(*keep, *[field(f) for f in layout])


def trim_fields(df: DataFrame, layout) -> DataFrame:
    """Optional: strip blanks of every layout field."""
    names = set(layout.names)
    return df.select(*[F.trim(c).alias(c) if c in names else F.col(c) for c in df.columns])


def cast_fields(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Optional: cast named fields; text that does not convert becomes NULL."""
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])
