"""Identity keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def record_uid(entity: Column, ref: Column, deadline: Column) -> Column:
    """Stable id of a detail record: sha256 of the three parts, a missing part counting as empty."""
    return F.sha2(F.concat_ws("|", *(F.coalesce(c, F.lit("")) for c in (entity, ref, deadline))), 256)


def content_hash(html: Column) -> Column:
    return F.substring(F.md5(html), 1, 8)


def archive_name(ref: Column, stamp: Column, html: Column) -> Column:
    """``ref_yyyyMMdd_HHmmss_hash.html``."""
    return F.concat(
        F.concat_ws("_", F.coalesce(ref, F.lit("unknown")), F.date_format(stamp, "yyyyMMdd_HHmmss"),
                    content_hash(html)),
        F.lit(".html"),
    )
