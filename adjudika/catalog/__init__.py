"""Registered queries over a data folder, each with the SQL that computes the same rows where SQL can express it."""

from importlib import import_module

from adjudika.catalog.registry import QUERIES, SQL

for _name in ("reports", "listings", "scalars", "quality", "joins", "merging", "pages", "monitoring", "streams", "ingesting",
              "exports"):
    import_module(f"adjudika.catalog.{_name}")

__all__ = ["QUERIES", "SQL"]
