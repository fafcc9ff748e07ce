"""File names: checks, keys and the fields a name carries. All are native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from filedrop import constants as C


def basename(path) -> Column:
    """Text after the last slash."""
    return F.substring_index(path, "/", -1)


def strip(text) -> Column:
    """Drop all leading and trailing whitespace (SQL ``trim`` alone drops spaces only)."""
    return F.btrim(text, F.lit(C.WHITESPACE))


def is_valid_name(filename) -> Column:
    """True when a basename is a data file or an end marker of the contract."""
    return F.rlike(filename, F.lit(C.VALID_NAME))


def is_file_key(path) -> Column:
    """False for folder keys and blank keys."""
    path = _col(path)
    return ~path.endswith("/") & (strip(path) != "")


def is_drop_file(path) -> Column:
    """True when the key ends like a data file or a marker."""
    path = _col(path)
    return path.endswith(C.GZ_SUFFIX) | path.endswith(C.END_SUFFIX)


def file_kind(path) -> Column:
    """``gz`` for a data file, ``end`` for anything else that passed :func:`is_drop_file`."""
    return F.when(_col(path).endswith(C.GZ_SUFFIX), F.lit("gz")).otherwise(F.lit("end"))


def base_key(filename, replace_all: bool = False) -> Column:
    """Name shared by a data file and its marker.

    By default only the suffix goes; ``replace_all`` removes every occurrence of either suffix.
    """
    name = _col(filename)
    if replace_all:
        return F.replace(F.replace(name, F.lit(C.GZ_SUFFIX), F.lit("")), F.lit(C.END_SUFFIX), F.lit(""))
    return F.when(
        name.endswith(C.GZ_SUFFIX), F.left(name, F.length(name) - len(C.GZ_SUFFIX))
    ).when(
        name.endswith(C.END_SUFFIX), F.left(name, F.length(name) - len(C.END_SUFFIX))
    ).otherwise(name)


def with_name_parts(df: DataFrame, path: str = "path") -> DataFrame:
    """Adds ``store_code``, ``transaction_date`` and ``transaction_hour`` of well-formed names; NULL otherwise.

    The stripped name is a projection of its own, so each name is cut out and matched once and the parts are plain
    slices at fixed positions.
    """
    named = df.select("*", basename(strip(path)).alias("_name"))
    readable = F.rlike("_name", F.lit(C.READABLE_NAME))
    return named.select(
        *df.columns,
        F.when(readable, F.substring("_name", 5, 4)).alias("store_code"),
        F.when(readable, F.substring("_name", 9, 8)).alias("transaction_date"),
        F.when(readable, F.substring("_name", 17, 2)).alias("transaction_hour"),
    )


def with_position_parts(df: DataFrame, path: str = "path") -> DataFrame:
    """Adds ``base_filename`` and the ``transaction_date`` and ``transaction_hour`` cut from it by position.

    Digits are not checked: short names give empty text. Names with neither suffix give NULL.
    """
    key = F.col(path)
    base = F.when(
        key.endswith(C.GZ_SUFFIX), F.substring_index(basename(key), ".", 1)
    ).when(
        key.endswith(C.END_SUFFIX), F.substring_index(basename(key), C.END_SUFFIX, 1)
    )
    return df.select("*", base.alias("base_filename")).select(
        "*",
        F.substring("base_filename", 9, 8).alias("transaction_date"),
        F.substring("base_filename", 17, 2).alias("transaction_hour"),
    )


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
