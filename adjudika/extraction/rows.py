"""Row-wise extraction. Each function takes pages with ``elements`` and ``texts`` and returns typed or text rows; those whose fields the
kernel can pick itself also take raw pages with ``html``, which is the faster way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudika import functions as fn
from adjudika.extraction.picking import Field, is_raw, with_records
from adjudika.extraction.selectors import SELECTORS, matches

# White space at either end of a text.
_ENDS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def found(selectors: list[dict]) -> Column:
    """All elements of the page that match."""
    return F.filter("elements", lambda e: matches(e, selectors))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, not once per element of an array that ``body`` walks."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blocks(pages: DataFrame, chosen: Column) -> DataFrame:
    """One row per chosen element: ``no``, its own subtree ``parts`` and its text pieces.

    The subtrees are cut out before the explode, so a page's whole element array is never copied per row.
    """
    cut = F.transform(chosen, lambda r: F.struct(
        r.i.alias("no"),
        F.slice(F.col("elements"), r.i + 1, r["last"] - r.i + 1).alias("parts"),
        F.slice(F.col("texts"), r.t0 + 1, r.t1 - r.t0).alias("texts"),
        r.t0.alias("t0")))
    other = [c for c in pages.columns if c not in ("elements", "texts")]
    return pages.select(*other, F.explode(cut).alias("_b")).select(*other, "_b.*")


def first_own(selectors: list[dict], parts="parts", inside: bool = True) -> Column:
    """First direct text of the first matching part that has one. With ``inside`` the block itself is not a candidate."""
    pool = F.slice(parts, F.lit(2), F.size(parts)) if inside else F.col(parts)
    own = F.transform(F.filter(pool, lambda e: matches(e, selectors)), lambda e: e.own)
    return F.get(F.filter(own, lambda t: t.isNotNull()), F.lit(0))


def first_href(selectors: list[dict], parts="parts") -> Column:
    hits = F.filter(parts, lambda e: matches(e, selectors) & e.href.isNotNull())
    return F.get(hits, F.lit(0)).href


def any_match(selectors: list[dict], parts="elements") -> Column:
    return F.exists(parts, lambda e: matches(e, selectors))


def cell_text(n: int, separator: str = " ") -> Column:
    """Text of the n-th ``td`` of the block: stripped non-blank pieces joined; ``''`` when there is no such cell."""
    cell = F.get(F.filter("parts", lambda e: e.tag == "td"), F.lit(n))
    pieces = F.slice("texts", cell.t0 - F.col("t0") + 1, cell.t1 - cell.t0)
    return F.coalesce(F.array_join(pieces, separator), F.lit(""))


def tender_rows(pages: DataFrame, stamp: Column, sel: dict = SELECTORS["list"]) -> DataFrame:
    """List page to tender records. Rows count only on pages that hold a result table; a row needs a reference.

    ``pages`` have their ``html``, of which the kernel then takes the fields alone, or ``elements`` and ``texts``.
    """
    if is_raw(pages):
        return _tenders(with_records(pages, _tender_picks(sel), rows=sel["row"], needs=sel["table"]), stamp)
    rows = blocks(pages, F.when(any_match(sel["table"]), found(sel["row"])))
    keyword = F.get(F.filter("parts", lambda e: (e.tag == "a") & (
        F.contains(F.lower(e.href), F.lit("detail")) | F.contains(F.lower(e.href), F.lit("consultation")))), F.lit(0)).href
    return _tenders(rows.select(
        "page_id", "url", "no", *(first_own(sel[n]).alias(f"_{n}") for n in _TENDER), first_href(sel["detail_link"]).alias("_specific"),
        first_href([{"tag": "a"}]).alias("_first"), keyword.alias("_keyword")), stamp)


def tenders_and_empty_pages(pages: DataFrame, stamp: Column, path: str, sel: dict = SELECTORS["list"]) -> tuple[DataFrame, DataFrame]:
    """``tender_rows`` of raw pages, and the pages that gave none, whole, for inspection: one pass and one write under ``path``.

    The kernel marks the pages without a row itself, so nothing is joined and no page is shuffled; the two kinds lie in folders of their own.
    """
    picked = with_records(pages.select("page_id", "url", "html"), _tender_picks(sel), rows=sel["row"], needs=sel["table"],
                          required="_ref_consultation", empty_pages=True)
    tagged = picked.withColumn("sorte", F.when(F.col("no").isNull(), "vide").otherwise("ligne"))
    tagged.write.mode("overwrite").partitionBy("sorte").parquet(path)
    back = pages.sparkSession.read.schema(tagged.schema).parquet(path)
    return _tenders(back.filter("sorte = 'ligne'"), stamp), back.filter("sorte = 'vide'").select("page_id", "url", "html")


_TENDER = ("ref_consultation", "titre", "organisme_acronyme", "type_marche", "date_publication", "date_limite", "statut")


def _tender_picks(sel: dict) -> list[Field]:
    anchor = [{"tag": "a"}]
    return [*(Field(f"_{n}", sel[n]) for n in _TENDER), Field("_specific", sel["detail_link"], "href"), Field("_first", anchor, "href"),
            Field("_keyword", anchor, "href", href_words=("detail", "consultation"), lowered=True)]


def _tenders(raw: DataFrame, stamp: Column) -> DataFrame:
    """Typed records from the texts of list rows."""
    fields = raw.select(
        "page_id", F.col("url").alias("_page_url"), F.col("no").alias("_no"),
        *(fn.clean_text(F.col(f"_{n}")).alias(n) for n in _TENDER[:3]),
        fn.normalize_type_marche(F.col("_type_marche")).alias("type_marche"),
        fn.parse_datetime(F.col("_date_publication")).alias("date_publication"),
        fn.parse_datetime(F.col("_date_limite")).alias("date_limite"),
        fn.normalize_statut(F.col("_statut")).alias("statut"), "_specific", "_first", "_keyword")
    url = fn.detail_url_chain(F.col("_page_url"), F.col("_specific"), F.col("_first"), F.col("_keyword"),
                              F.col("ref_consultation"), F.col("organisme_acronyme"))
    return (
        fields.withColumns({"url_detail": url, "date_extraction": stamp, "suivre_detail": fn.blank_to_null(
            F.col("_specific")).isNotNull()})
        .filter(F.coalesce("ref_consultation", F.lit("")) != "")
        .drop("_page_url", "_specific", "_first", "_keyword")
    )


def detail_fields(pages: DataFrame, sel: dict = SELECTORS["detail"]) -> DataFrame:
    """Detail page to its enrichment fields, keyed by the page URL; pages as for ``tender_rows``."""
    texts = ("objet", "organisme_nom_complet", "organisme_ville", "organisme_telephone", "secteur", "code_cpv")
    amounts, links = ("montant_estime", "cautionnement_provisoire"), {"url_avis": ("Avis", "avis"), "url_dce": ("DCE", "dce")}
    anchor = [{"tag": "a"}]
    if is_raw(pages):
        raw = with_records(pages, [
            *(Field(f"_{n}", sel[n]) for n in (*texts, *amounts)), Field("_organisme_email", sel["organisme_email"], "href"),
            *(Field(f"_{n}", sel[n], "href") for n in links), *(Field(f"_{n}_text", anchor, "href", says=words) for n, words in links.items())],
            inside=False)
    else:
        def by_text(words):
            return F.get(F.filter("elements", lambda e: (e.tag == "a") & e.href.isNotNull() & says(e, words)), F.lit(0)).href

        raw = pages.select(
            "url", *(first_own(sel[n], "elements", inside=False).alias(f"_{n}") for n in (*texts, *amounts)),
            *(first_href(sel[n], "elements").alias(f"_{n}") for n in ("organisme_email", *links)),
            *(by_text(words).alias(f"_{n}_text") for n, words in links.items()))

    def link(name: str) -> Column:
        href = F.coalesce(fn.blank_to_null(F.col(f"_{name}")), F.col(f"_{name}_text"), F.lit(""))
        return let(href, lambda h: fn.url_join(F.col("url"), h))

    return raw.select(
        F.col("url").alias("url_detail"), *(fn.clean_text(F.col(f"_{n}")).alias(n) for n in texts),
        fn.strip_mailto(F.col("_organisme_email")).alias("organisme_email"),
        *(fn.parse_amount(F.col(f"_{n}")).alias(n) for n in amounts), *(link(n).alias(n) for n in links))


def says(e: Column, words: tuple[str, ...], lowered: bool = False) -> Column:
    """Whether an element's text contains one of the words."""
    text = F.array_join(F.slice(F.col("texts"), e.t0 + 1, e.t1 - e.t0), " ")
    text = F.lower(text) if lowered else text
    out = F.contains(text, F.lit(words[0]))
    for w in words[1:]:
        out = out | F.contains(text, F.lit(w))
    return out


def lot_rows(pages: DataFrame, ref: Column, stamp: Column, sel: dict = SELECTORS["detail"]) -> DataFrame:
    """Lots on a detail page; ``ref`` is the tender reference of the page."""
    rows = blocks(pages.withColumn("_ref", ref), found(sel["lot_row"]))
    cell = [[{"tag": "td", "nth": n}] for n in (1, 2, 3)]
    return rows.select(
        F.col("_ref").alias("ref_consultation"), F.col("no").alias("_no"),
        fn.clean_text(first_own(cell[0])).alias("numero_lot"),
        fn.clean_text(first_own(cell[1])).alias("designation"),
        fn.parse_amount(first_own(cell[2])).alias("montant_estime"),
        stamp.alias("date_extraction"),
    )


def minutes_rows(pages: DataFrame, stamp: Column, sel: dict = SELECTORS["pv"], containers: bool = False) -> DataFrame:
    """Minutes table to rows. ``containers`` also yields the record that a result table as a whole gives, which repeats
    its first row: the portal crawler's combined selector reads the table element itself as one more row. Pages as for ``tender_rows``."""
    row = sel["container"] + sel["row"] if containers else sel["row"]
    if is_raw(pages):
        picks = [*(Field(f"_{n}", sel[n]) for n in _MINUTES), Field("_link", sel["link"], "href")]
        raw = with_records(pages.select("page_id", "url", "html"), picks, rows=row)
    else:
        raw = blocks(pages, found(row)).select("page_id", "url", "no", *(first_own(sel[n]).alias(f"_{n}") for n in _MINUTES), first_href(sel["link"]).alias("_link"))
    link = fn.reject_javascript(F.coalesce("_link", F.lit("")), "")
    return raw.select(
        "page_id", F.col("no").alias("_no"),
        *(F.col(f"_{n}").alias(n) for n in _MINUTES[:3]),
        *(fn.parse_datetime(F.col(f"_{n}")).alias(n) for n in _MINUTES[3:]),
        F.when(link == "", "").otherwise(fn.url_join(F.col("url"), link)).alias("url_pv"),
        stamp.alias("date_extraction"),
    )


_MINUTES = ("ref_consultation", "organisme_acronyme", "type_pv", "date_seance", "date_publication_pv")


def award_rows(pages: DataFrame, stamp: Column, sel: dict = SELECTORS["award"]) -> DataFrame:
    """Awards table to rows; pages without that table give none."""
    rows = blocks(pages, F.when(any_match(sel["table"]), found(sel["row"])))
    return rows.select(
        "page_id", F.col("no").alias("_no"),
        first_own(sel["ref_consultation"]).alias("ref_consultation"),
        first_own(sel["organisme_acronyme"]).alias("organisme_acronyme"),
        first_own(sel["entreprise_nom"]).alias("entreprise_nom"),
        fn.parse_amount(first_own(sel["montant_ttc"])).alias("montant_ttc"),
        fn.parse_date(first_own(sel["date_attribution"])).alias("date_attribution"),
        fn.url_join(F.col("url"), F.coalesce(first_href(sel["link"]), F.lit(""))).alias("url_resultat"),
        stamp.alias("date_extraction"),
    )


def form_rows(pages: DataFrame, sel: dict = SELECTORS["form"]) -> DataFrame:
    """Form-search page to rows: rows of the result tables, else of any table, else cards. One pass over the pages."""
    in_result = let(found(sel["table"]), lambda tables: F.filter("elements", lambda e: matches(e, sel["row"]) & F.exists(
        tables, lambda t: (e.i > t.i) & (e.i <= t["last"]))))
    layered = pages.withColumn("_inner", in_result)
    layered = layered.withColumn("_any", F.when(F.size("_inner") > 0, F.col("_inner")).otherwise(found(sel["row"])))
    layered = layered.withColumn("_is_card", F.size("_any") == 0).withColumn(
        "_chosen", F.when(F.col("_is_card"), found(sel["card"])).otherwise(F.col("_any"))).drop("_inner", "_any")
    cut = blocks(layered, F.col("_chosen"))
    card = F.col("_is_card")
    link = first_href([{"tag": "a"}])

    def own(name: str) -> Column:
        return F.regexp_replace(F.coalesce(first_own(sel[name]), F.lit("")), _ENDS, "")

    def either(of_card: Column, of_row: Column) -> Column:
        return F.when(card, of_card).otherwise(of_row)

    href = fn.blank_to_null(either(link, fn.reject_javascript(link, "")))
    rows = cut.select(
        "page_id", F.col("no").alias("_no"), card.alias("_is_card"),
        either(own("card_ref"), cell_text(0)).alias("ref"),
        either(own("card_objet"), cell_text(1)).alias("objet"),
        either(own("card_acheteur"), cell_text(2)).alias("acheteur"),
        either(fn.iso_deadline(own("card_date"), ("d/m/Y", "Y-m-d")),
               fn.deadline_from_cells([cell_text(n) for n in (3, 4, 5, 6)])).alias("date_limite"),
        fn.url_join(F.col("url"), href).alias("url_detail"), F.col("url").alias("source_list_url"),
    )
    filled = (F.col("ref") != "") | (F.col("objet") != "") | (F.col("acheteur") != "") | F.col("url_detail").isNotNull()
    return rows.filter(F.col("_is_card") | filled).drop("_is_card")


def recap_records(pages: DataFrame, scraped_at: Column, sel: dict = SELECTORS["recap"]) -> DataFrame:
    """Detail record from the recap block. A page without the block gives a record of NULLs, whose id is shared."""
    names = ("date_limite", "ref", "objet", "entite_publique", "categorie", "lieu_execution", "estimation_ttc",
             "caution_provisoire", "lieu_ouverture_plis", "adresse_retrait_dossiers", "adresse_depot_offres",
             "variante_autorisee", "type_procedure", "mode_passation", "visites_lieux")
    separator = {"visites_lieux": " "}
    if is_raw(pages):
        raw = with_records(pages, [Field(f"_{n}", sel[n], "text", separator.get(n, "")) for n in names], scope=sel["block"]).withColumn(
            "sans_recap", F.col("no").isNull())
    else:
        block = F.get(F.filter("elements", lambda e: matches(e, sel["block"])), F.lit(0))
        scoped = pages.withColumn("_block", block).withColumn(
            "parts", F.slice("elements", F.col("_block.i") + 1, F.col("_block.last") - F.col("_block.i") + 1))

        def text(name: str) -> Column:
            hit = F.get(F.filter("parts", lambda e: matches(e, sel[name])), F.lit(0))
            return F.array_join(F.slice("texts", hit.t0 + 1, hit.t1 - hit.t0), separator.get(name, ""))

        raw = scoped.select("url", F.col("_block").isNull().alias("sans_recap"), *(text(n).alias(f"_{n}") for n in names))
    fields = {n: fn.collapse(F.col(f"_{n}")) for n in names if n not in ("type_procedure", "mode_passation")}
    fields["type_procedure"] = F.when(~F.col("sans_recap"), fn.procedure_label(fn.collapse(F.col("_type_procedure")), fn.collapse(F.col("_mode_passation"))))
    records = raw.select("url", "sans_recap", *(c.alias(n) for n, c in fields.items()))
    return records.select(
        *fields, "sans_recap",
        fn.query_param(F.col("url"), "refConsultation").alias("refConsultation"),
        fn.query_param(F.col("url"), "orgAcronyme").alias("orgAcronyme"),
        fn.record_uid(F.col("entite_publique"), F.col("ref"), F.col("date_limite")).alias("id"),
        scraped_at.alias("scraped_at"), F.col("url").alias("url_detail"))
