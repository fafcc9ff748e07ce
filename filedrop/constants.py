"""Fixed values of the file-drop contract.

These must equal the delivering system's values for right results; nothing here is derived.
"""

# Fixed value: names that pass the name check, data files and end markers (ASCII digits).
VALID_NAME = r"^R520\d{4}\d{8}\d{6}(\.gz|_END)$"

# Fixed value: pattern for reading store, date and hour. Any Unicode decimal digit counts here, so a name can
# fail the check above and still be read.
READABLE_NAME = r"^R520\p{Nd}{4}\p{Nd}{8}\p{Nd}{2}\p{Nd}{4}(_END|\.gz)$"

# Suffixes of the data file and of its end marker.
GZ_SUFFIX = ".gz"
END_SUFFIX = "_END"

# Fixed value: the characters that whitespace stripping removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: bytes per record.
RECORD_BYTES = 520

# Zone folders.
RAW_ROOT = "RDZ/Raw-Data/"
ARCHIVE_ROOT = "RDZ/backup/"
QUARANTINE_ROOT = "RDZ/error-files/"
TABLE_ROOT = "TDZ/"
LOG_ROOT = "LOGS/"

# Columns of the layout sheet.
LAYOUT_COLUMNS = ("Column", "Starting_Index", "Length")

# Size units, each 1024 times the one before.
SIZE_UNITS = ("Bytes", "KB", "MB", "GB", "TB", "PB")

# Columns that the parsed table adds to the layout's own; a layout may not use these names.
RESERVED_COLUMNS = (
    "chunk", "date", "hour", "drop_kind", "drop_run", "drop_file", "drop_status", "drop_records",
)
