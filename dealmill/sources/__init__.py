"""Readers and writers: text extracts in, Parquet tables in and out, JSON reports out."""
