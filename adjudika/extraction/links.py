"""Links and page structure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudika import functions as fn
from adjudika.extraction.picking import Field, is_raw, with_records
from adjudika.extraction.rows import any_match, blocks, let, says
from adjudika.extraction.selectors import (
    DETAIL_LINK_WORDS, DETAIL_PAGE_NAMES, EMPTY_TEXT, MINUTES_LINK_WORDS, SELECTORS, TENDER_LINK_WORDS,
)


def has_word(text: Column, words) -> Column:
    out = F.contains(text, F.lit(words[0]))
    for w in words[1:]:
        out = out | F.contains(text, F.lit(w))
    return out


def page_links(pages: DataFrame) -> DataFrame:
    """All links of all pages, duplicates kept: ``(page_id, url, pos, href, cls)``."""
    anchors = F.filter("elements", lambda e: (e.tag == "a") & e.href.isNotNull())
    compact = F.transform(anchors, lambda e: F.struct(e.i.alias("pos"), e.href.alias("href"), e.cls.alias("cls")))
    return pages.select("page_id", "url", F.explode(compact).alias("_a")).select("page_id", "url", "_a.*")


def classify(links: DataFrame) -> DataFrame:
    """Which kinds of target each link may lead to, by words in its address."""
    href = F.lower("href")
    return links.withColumns({
        "detail_like": has_word(href, DETAIL_LINK_WORDS),
        "tender_like": has_word(href, TENDER_LINK_WORDS),
        "minutes_like": has_word(href, MINUTES_LINK_WORDS),
    })


def detail_links(links: DataFrame, names=DETAIL_PAGE_NAMES, base: str | None = None) -> DataFrame:
    """Links to tender detail pages as absolute, canonical URLs; the link text plays no part."""
    start = F.lit(base) if base else F.col("url")
    hits = links.filter(has_word(F.col("href"), names))
    return hits.select("page_id", "pos", fn.canonical_detail_url(fn.url_join(start, F.col("href"))).alias("url"))


def next_pages(pages: DataFrame) -> DataFrame:
    """Pagination target of every page, NULL on the last one: ``rel=next``, else the first link that says so or that
    names a page number. ``pages`` have ``html`` or ``elements``."""
    if is_raw(pages):
        anchor = [{"tag": "a"}]
        raw = with_records(pages.select("page_id", "url", "html"), [
            Field("_declared", [{"tag": "a", "rel": "next"}], "first_href"),
            Field("_worded", anchor, "href", says=("suivant", "next"), either="currentPage=", lowered=True)])
        href = F.coalesce(fn.blank_to_null(F.col("_declared")), F.col("_worded"))
        return raw.select("page_id", "url", let(href, lambda h: fn.url_join(F.col("url"), h)).alias("next_url"))
    declared = F.filter("elements", lambda e: (e.tag == "a") & (e.rel == "next"))
    worded = F.filter("elements", lambda e: (e.tag == "a") & e.href.isNotNull() & (
        says(e, ("suivant", "next"), lowered=True) | F.contains(e.href, F.lit("currentPage="))))
    href = F.coalesce(fn.blank_to_null(F.get(declared, F.lit(0)).href), F.get(worded, F.lit(0)).href)
    return pages.select("page_id", "url", let(href, lambda h: fn.url_join(F.col("url"), h)).alias("next_url"))


def _first(tag: str) -> Column:
    return F.get(F.filter("elements", lambda e: e.tag == tag), F.lit(0))


def profile(pages: DataFrame) -> DataFrame:
    """Structure counts per page; columns are the cells of the second row of the first table."""
    def count(tag: str) -> Column:
        return F.size(F.filter("elements", lambda e: e.tag == tag)).cast("bigint")

    def inside(outer: Column, tags) -> Column:
        return F.filter("elements", lambda e: e.tag.isin(*tags) & (e.i > outer.i) & (e.i <= outer["last"]))

    second_row = let(_first("table"), lambda table: F.get(inside(table, ["tr"]), F.lit(1)))
    cells = let(second_row, lambda row: inside(row, ["td", "th"]))
    return pages.select(
        "page_id", count("table").alias("tables"), count("tr").alias("rows"), count("th").alias("headers"),
        F.size(cells).cast("bigint").alias("columns"),
        F.size(F.filter("elements", lambda e: (e.tag == "a") & e.href.isNotNull())).cast("bigint").alias("links"),
        any_match(SELECTORS["markers"]["error"]).alias("error_banner"),
        (any_match(SELECTORS["markers"]["empty"]) | F.exists("elements", lambda e: (e.tag == "p") & says(
            e, (EMPTY_TEXT,)))).alias("empty_result"),
        any_match(SELECTORS["markers"]["captcha"]).alias("captcha"),
    )


def profile_totals(profiles: DataFrame) -> DataFrame:
    names = ("tables", "rows", "headers", "links")
    return profiles.agg(
        F.count(F.lit(1)).alias("pages"), *(F.sum(n).alias(n) for n in names), F.max("columns").alias("max_columns"),
        *(F.count_if(n).alias(n) for n in ("error_banner", "empty_result", "captcha")))


def link_patterns(pages: DataFrame, first: int | None = None, ordered: bool = False) -> DataFrame:
    """Distinct detail-like addresses before ``?`` with their link counts. ``first`` looks at that many links of each
    page only, as the report on a single page does; the default takes all. ``ordered`` sorts them by address. ``pages`` have ``html``, of which the
    kernel then takes the addresses alone, or ``elements``; with ``first`` they need ``elements``."""
    if is_raw(pages):
        if first:
            raise ValueError("the first links of a page are counted on its elements")
        anchor = [{"tag": "a"}]
        links = with_records(pages.select("html"), [Field("href", anchor, "row_href")], rows=anchor).filter(has_word(F.lower("href"), DETAIL_LINK_WORDS))
    else:
        hits = F.filter("elements", lambda e: (e.tag == "a") & has_word(F.lower(e.href), DETAIL_LINK_WORDS))
        hrefs = F.transform(hits, lambda e: e.href)
        links = pages.select(F.explode(F.slice(hrefs, 1, first) if first else hrefs).alias("href"))
    counts = links.groupBy(F.substring_index("href", "?", 1).alias("pattern")).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy("pattern") if ordered else counts


def suggest_selectors(pages: DataFrame) -> DataFrame:
    """Most frequent way to address the first table and the first detail-like link of a page: id, else first class."""
    table = _first("table")
    link = F.get(F.filter("elements", lambda e: (e.tag == "a") & has_word(F.lower(e.href), DETAIL_LINK_WORDS)), F.lit(0))
    by_table = F.coalesce(
        F.concat(F.lit("table#"), fn.blank_to_null(table.id)),
        F.concat(F.lit("table."), F.get(table.cls, F.lit(0))),
        F.when(table.isNotNull(), "table"))
    by_link = F.coalesce(
        F.concat(F.lit("a."), F.get(link.cls, F.lit(0))),
        F.when(F.contains(F.lower(link.href), F.lit("detail")), 'a[href*="detail"]'),
        F.when(F.contains(F.lower(link.href), F.lit("consultation")), 'a[href*="consultation"]'),
        F.when(link.isNotNull(), "a"))
    votes = pages.select(F.explode(F.array(
        F.struct(F.lit("table").alias("cible"), by_table.alias("selecteur")),
        F.struct(F.lit("lien").alias("cible"), by_link.alias("selecteur")))).alias("_v")).select("_v.*")
    counts = votes.filter(F.col("selecteur").isNotNull()).groupBy("cible", "selecteur").agg(F.count(F.lit(1)).alias("n"))
    best = F.max_by("selecteur", F.struct("n", "selecteur"))
    return counts.groupBy("cible").agg(best.alias("selecteur"), F.max("n").alias("pages"))


def sample_tenders(pages: DataFrame) -> DataFrame:
    """Rows of the first table of each page by position, header row left out. Of the first link of each cell, the last
    one wins; it is rooted at the site."""
    rows = let(_first("table"), lambda table: F.filter(
        "elements", lambda e: (e.tag == "tr") & (e.i > table.i) & (e.i <= table["last"])))
    data = blocks(pages, let(rows, lambda r: F.slice(r, F.lit(2), F.greatest(F.size(r), F.lit(0)))))
    cells = F.filter("parts", lambda e: e.tag.isin("td", "th"))

    def text(n: int) -> Column:
        cell = F.get(cells, F.lit(n))
        return fn.blank_to_null(F.array_join(F.slice("texts", cell.t0 - F.col("t0") + 1, cell.t1 - cell.t0), ""))

    cell_links = F.filter(F.transform(cells, lambda c: F.get(F.filter("parts", lambda e: (
        (e.tag == "a") & e.href.isNotNull() & (e.i > c.i) & (e.i <= c["last"]))), F.lit(0)).href), lambda h: h.isNotNull())
    last_link = F.get(cell_links, F.size(cell_links) - 1)
    names = ("ref_consultation", "titre", "organisme", "type_marche", "date_publication", "date_limite")
    return data.filter(F.size(cells) > 0).select(
        "page_id", "no", *((fn.preview(text(i), 80) if n == "titre" else text(i)).alias(n) for i, n in enumerate(names)),
        fn.site_absolute(last_link).alias("url_detail"))
