"""Query plans built from the operators: reports, listings, monitoring, ingest, retention and backfill."""
