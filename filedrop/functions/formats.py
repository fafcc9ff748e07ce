"""Sizes, elapsed time, run slots and the folder names built from them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from filedrop import constants as C
from filedrop.functions.names import _col, basename


def format_size(size) -> Column:
    """Readable size with two decimals, rounding ties to the even digit.

    Decimal division and ``bround`` keep the ties exact; ``format_string`` would round them up.
    """
    n = _col(size).cast("decimal(20,0)")

    def rung(k: int) -> Column:
        scaled = n / F.lit(1024**k).cast("decimal(16,0)")
        text = F.bround(scaled, 2).cast("decimal(20,2)").cast("string")
        return F.concat(text, F.lit(" " + C.SIZE_UNITS[k]))

    out = F.when(n < 1024, rung(0))
    for k in range(1, len(C.SIZE_UNITS) - 1):
        out = out.when(n < 1024 ** (k + 1), rung(k))
    return F.when(n.isNotNull(), out.otherwise(rung(len(C.SIZE_UNITS) - 1)))


def format_elapsed(seconds) -> Column:
    """``HH:MM:SS``, starting again at 24 hours."""
    s = F.pmod(F.floor(_col(seconds)).cast("bigint"), F.lit(86400).cast("bigint"))

    def two(c: Column) -> Column:
        return F.lpad(c.cast("string"), 2, "0")

    return F.concat_ws(":", two(F.floor(s / 3600)), two(F.floor(s / 60) % 60), two(s % 60))


def run_slot(as_of: dt.datetime) -> tuple[str, str]:
    """UTC date ``YYYYMMDD`` and hour ``HH`` of a run."""
    utc = to_utc(as_of)
    return utc.strftime("%Y%m%d"), utc.strftime("%H")


def to_utc(as_of: dt.datetime) -> dt.datetime:
    """Aware UTC time; a naive time is taken as UTC already."""
    if as_of.tzinfo is None:
        return as_of.replace(tzinfo=dt.timezone.utc)
    return as_of.astimezone(dt.timezone.utc)


def slot_columns(time) -> dict[str, Column]:
    """Run date and hour of a timestamp column (the session time zone must be UTC)."""
    return {
        "date": F.date_format(time, "yyyyMMdd"),
        "hour": F.date_format(time, "HH"),
    }


def output_location(root: str, date, hour) -> Column:
    """Folder that the partitioned writer fills for one run slot."""
    return F.concat(F.lit(root + "date="), _col(date), F.lit("/hour="), _col(hour), F.lit("/"))


def log_path(zone, stamp, root: str = C.LOG_ROOT) -> Column:
    """Log folder of a zone; colons, blanks and dashes leave the stamp."""
    return F.concat(F.lit(root), _col(zone), F.lit("/"), F.translate(_col(stamp), ": -", ""), F.lit("/"))


def dated_destination(root: str, path, date, hour) -> Column:
    """``root/YYYY/YYYYMMDD/HH/name``, used by archive and quarantine."""
    date = _col(date)
    return F.concat(
        F.lit(root), F.left(date, F.lit(4)), F.lit("/"), date, F.lit("/"), _col(hour), F.lit("/"), basename(path)
    )


def hive_destination(root: str, path, date, hour) -> Column:
    """``root/year=/month=/day=/hour=/name``."""
    date = _col(date)
    return F.concat(
        F.lit(root + "year="), F.substring(date, 1, 4),
        F.lit("/month="), F.substring(date, 5, 2),
        F.lit("/day="), F.substring(date, 7, 2),
        F.lit("/hour="), _col(hour), F.lit("/"), basename(path),
    )


def flat_destination(root: str, path) -> Column:
    """``root/name``."""
    return F.concat(F.lit(root), basename(path))
