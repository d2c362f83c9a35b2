"""Readers. Every reader takes an explicit schema; nothing is inferred from data."""

from adjudika.sources.readers import (
    archived_pages, jsonl_records, new_arrivals, page_files, recent_runs, stored_keys, table, table_jdbc,
)

__all__ = [name for name in dir() if not name.startswith("_")]
