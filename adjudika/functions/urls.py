"""URL handling as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adjudika.functions.text import blank_to_null

# Addresses and parameter names of the portal whose pages are archived.
BASE_URL = "https://www.marchespublics.gov.ma"
DETAIL_PATH = "/index.php?page=entreprise.EntrepriseDetailsConsultation"
REF_PARAM = "refConsultation"
ORG_PARAM = "orgAcronyme"

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"


def _lit(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def drop_fragment(url: Column) -> Column:
    return F.substring_index(url, "#", 1)


def _remove_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""
    segments = F.split(path, "/")

    def step(kept: Column, seg: Column) -> Column:
        parent = F.when(F.size(kept) > 1, F.slice(kept, F.lit(1), F.size(kept) - 1)).otherwise(kept)
        return F.when(seg == "..", parent).when(seg == ".", kept).otherwise(F.array_append(kept, seg))

    folded = F.aggregate(segments, F.array().cast("array<string>"), step)
    directory = F.element_at(segments, -1).isin(".", "..")
    joined = F.array_join(F.when(directory, F.array_append(folded, F.lit(""))).otherwise(folded), "/")
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), joined).otherwise(path)


def url_join(base, href: Column) -> Column:
    """Resolve ``href`` against ``base``; an empty ``href`` gives the base, an absolute one is returned as it is."""
    # One evaluation of each, however many branches name them.
    return F.get(F.transform(F.array(F.struct(_lit(base).alias("base"), href.alias("href"))), lambda x: _joined(x.base, x.href)), F.lit(0))


def _joined(base: Column, href: Column) -> Column:
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    base_path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    href_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    href_tail = F.substring(href, F.length(href_path) + 1, F.length(href))
    folder = F.regexp_replace(base_path, r"[^/]*$", "")
    return (
        F.when(href == "", base)
        .when(href.rlike(_SCHEME), href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, F.lit(":"), href))
        .when(F.startswith(href, F.lit("/")), F.concat(origin, _remove_dots(href_path), href_tail))
        .when(F.startswith(href, F.lit("?")), F.concat(origin, base_path, href))
        .when(F.startswith(href, F.lit("#")), F.concat(drop_fragment(base), href))
        .otherwise(F.concat(
            origin,
            _remove_dots(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), href_path)),
            href_tail,
        ))
    )


def query_param(url: Column, name: str) -> Column:
    """First non-blank value of a query parameter, decoded; NULL if absent. Tolerates malformed and relative URLs."""
    raw = blank_to_null(F.regexp_extract(url, rf"^[^?#]*\?(?:[^#]*?&)?{name}=([^&#]+)", 1))
    return F.coalesce(F.try_url_decode(raw), raw)


def build_detail_url(ref: Column, org: Column, base: str = BASE_URL) -> Column:
    """Detail address from reference and body; nothing is percent-encoded."""
    return F.concat(F.lit(f"{base}{DETAIL_PATH}&{REF_PARAM}="), ref, F.lit(f"&{ORG_PARAM}="), org)


def canonical_detail_url(url: Column, base: str = BASE_URL) -> Column:
    """Only reference and body are kept; a URL that lacks one of them is returned as it is."""
    return F.coalesce(build_detail_url(query_param(url, REF_PARAM), query_param(url, ORG_PARAM), base), url)


def detail_url_chain(page_url: Column, specific: Column, first: Column, keyword: Column, ref: Column, org: Column,
                     base: str = BASE_URL) -> Column:
    """Specific link, else first link, else keyword link, else built from reference and body, else ``''``."""
    link = F.coalesce(blank_to_null(specific), blank_to_null(first), blank_to_null(keyword))
    return F.coalesce(
        url_join(page_url, link),
        build_detail_url(blank_to_null(ref), blank_to_null(org), base),
        F.lit(""),
    )


def to_desktop(url: Column) -> Column:
    """``/mobile/`` in the path becomes ``/``; query and fragment are left alone."""
    path = F.regexp_extract(url, r"^([^?#]*)", 1)
    tail = F.substring(url, F.length(path) + 1, F.length(url))
    return F.concat(F.replace(path, F.lit("/mobile/"), F.lit("/")), tail)


def with_mobile_out(action: Column) -> Column:
    """Mobile form address to the full version: the path is fixed and ``mobile=out`` added when it is missing."""
    desktop = F.replace(action, F.lit("/mobile/"), F.lit("/"))
    joined = F.concat(
        desktop, F.when(F.contains(desktop, F.lit("?")), F.lit("&")).otherwise(F.lit("?")), F.lit("mobile=out"))
    fixed = F.when(F.contains(desktop, F.lit("mobile=out")), desktop).otherwise(joined)
    return F.when(F.startswith(action, F.lit("/mobile/")), fixed).otherwise(action)


def reject_javascript(href: Column, replacement=None) -> Column:
    """Script links carry no address: they become ``replacement`` (``''`` for minutes, NULL for the form list)."""
    return F.when(F.startswith(href, F.lit("javascript:")), F.lit(replacement).cast("string")).otherwise(href)


def strip_mailto(href: Column) -> Column:
    return F.replace(href, F.lit("mailto:"), F.lit(""))


def site_absolute(href: Column, base: str = BASE_URL) -> Column:
    """``/x`` and ``x`` are both put under the site root; anything that starts with ``http`` is kept."""
    return (
        F.when(F.startswith(href, F.lit("/")), F.concat(F.lit(base), href))
        .when(~F.startswith(href, F.lit("http")), F.concat(F.lit(f"{base}/"), href))
        .otherwise(href)
    )
