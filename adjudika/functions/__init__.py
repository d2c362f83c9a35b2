"""Scalar column expressions. Everything here is a built-in Spark expression; no Python runs per row."""

from adjudika.functions.amounts import clean_amount, double_or_null, money, parse_amount, zero_as_null
from adjudika.functions.dates import (
    casablanca_today, deadline_from_cells, iso_deadline, iso_or_blank, month_bucket, parse_date, parse_datetime,
    utc_iso_seconds,
)
from adjudika.functions.keys import archive_name, content_hash, record_uid
from adjudika.functions.labels import normalize_statut, normalize_type_marche, procedure_label
from adjudika.functions.text import blank_to_null, clean_text, collapse, normalize_strings, preview
from adjudika.functions.urls import (
    build_detail_url, canonical_detail_url, detail_url_chain, drop_fragment, query_param, reject_javascript,
    site_absolute, strip_mailto, to_desktop, url_join, with_mobile_out,
)

__all__ = [name for name in dir() if not name.startswith("_")]
