"""Parquet tables: parsed records with file outcomes, and the audit log."""
