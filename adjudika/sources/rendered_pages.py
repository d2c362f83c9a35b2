"""Portal pages rendered from the order tables, one page per order, to drive and check the extraction end to end.

Rendering is a per-row expression: no rows are gathered, so a page never outgrows its order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudika.extraction.selectors import _RECAP
from adjudika.functions import build_detail_url
from adjudika.sources import driver_tables as D

SITE = "https://www.marchespublics.gov.ma"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.read(spark, sf_dir, "orders").withColumn("k", F.col("o_orderkey").cast("string"))


def _lines(count: Column, line) -> Column:
    """``count`` rendered lines, numbered from 1."""
    return F.array_join(F.transform(F.sequence(F.lit(1), count.cast("int")), lambda i: line(i.cast("string"))), "\n")


def _html(*body) -> Column:
    parts = (F.lit(p) if isinstance(p, str) else p for p in body)
    return F.concat(F.lit('<!DOCTYPE html><html><head><title>P</title><script>var t="</td>";</script></head><body>'),
                    *parts, F.lit("</body></html>"))


def _day() -> Column:
    return F.date_format("o_orderdate", "dd/MM/yyyy")


def detail_url() -> Column:
    return build_detail_url(F.col("k"), F.lit("org"))


def _escaped(url: Column) -> Column:
    return F.replace(url, F.lit("&"), F.lit("&amp;"))


def list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result lists of 1 to 3 rows; every tenth page has no table; all but the last key of ten link to the next page."""
    key = F.col("o_orderkey")
    row = lambda i: F.concat(
        F.lit('<tr class="row"><td>AO-'), "k", F.lit("-"), i, F.lit("<td>  Marche\n <b>gras</b>  no "), "k",
        F.lit(" &amp; co</td><td>ORG"), i, F.lit("</td><td>"), D.type_label(F.col("o_orderpriority")), F.lit("</td><td>"),
        _day(), F.lit("</td><td>"), F.when(i == "2", "").otherwise(F.date_format(F.col("o_orderdate") + F.make_dt_interval(F.lit(30)), "dd/MM/yyyy")),
        F.lit("</td><td>"), D.status_label(F.col("o_orderstatus")), F.lit('</td><td><a href="'),
        F.when(i == "3", "").otherwise(_escaped(F.concat(F.lit("/index.php?page=entreprise.EntrepriseDetailsConsultation"
                                                               "&refConsultation="), "k", F.lit("&orgAcronyme=O"), i))),
        F.lit('"><img src="v.png"></a></td></tr>'))
    table = F.concat(F.lit('<table id="t" class="x data-table"><thead><tr><th>Ref</th><th>Objet</th></tr></thead><tbody>'),
                     _lines(key % 3 + 1, row), F.lit("</tbody></table>"))
    following = F.when(key % 10 != 9, F.concat(
        F.lit('<a href="liste?p='), (key + 1).cast("string"), F.lit('"><span>Page</span> Suivante</a>'))).otherwise("")
    return _orders(spark, sf_dir).select(
        key.alias("page_id"), F.concat(F.lit(f"{SITE}/cherche/liste?p="), "k").alias("url"),
        _html('<div class="menu"><a href="/aide">Aide</a></div><!-- <tr class="row"><td>non</td></tr> -->',
              F.when(key % 10 == 5, '<p>Aucun résultat</p>').otherwise(table), following).alias("html"))


def link_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with links of every kind, both other forms of a next link, page markers and small tables, by remainders of the key."""
    key = F.col("o_orderkey")

    def on(test: Column, *parts) -> Column:
        return F.when(test, F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))).otherwise("")

    after = (key + 1).cast("string")
    return _orders(spark, sf_dir).select(
        key.alias("page_id"), F.concat(F.lit(f"{SITE}/l?p="), "k").alias("url"),
        _html('<a href="/aide">h</a>', on(key % 2 == 0, '<a href="/avis/detail?id=', F.col("k"), '">d</a>'),
              on(key % 3 == 0, '<a href="/marche/pp?x=', F.col("k"), '">p</a>'), on(key % 5 == 0, '<a href="/Annonce/', F.col("k"), '">a</a>'),
              on(key % 7 == 0, '<a href="/doc/pv-', F.col("k"), '.pdf">v</a>'), on(key % 11 == 0, '<a href="/consultation/', F.col("k"), '?a=1">c</a>'),
              on(key % 4 == 0, '<a rel="next" href="/l?p=', after, '">&raquo;</a>'), on(key % 4 == 1, '<a href="/l?currentPage=', after, '">&raquo;</a>'),
              on(key % 6 == 1, '<div class="x error">e</div>'), on(key % 6 == 2, '<div class="captcha"></div>'),
              on(key % 6 == 3, '<div class="no-results"></div>'), on(key % 6 == 4, '<span class="error-message">e</span>'),
              on(key % 3 == 1, '<table><tr><th>H</th></tr><tr><td>1</td><td>2</td></tr></table>')).alias("html"))


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail pages with 1 to 4 lots; some fields are missing for some keys."""
    key = F.col("o_orderkey")
    price = F.replace(F.col("o_totalprice").cast("decimal(15,2)").cast("string"), F.lit("."), F.lit(","))
    lot = lambda i: F.concat(F.lit("<tr><td>"), i, F.lit("</td><td>Lot  "), i, F.lit(" de "), "k", F.lit("</td><td>"),
                             price, F.lit(" DH</td></tr>"))
    return _orders(spark, sf_dir).select(
        key.alias("page_id"), detail_url().alias("url"),
        _html(F.lit('<h1 class="titre">T</h1>'),
              F.when(key % 5 != 0, F.concat(F.lit('<div class="box objet">\n Objet  de<br> '), "k", F.lit("</div>"))).otherwise(""),
              F.concat(F.lit('<div class="organisme-nom">Nom '), "o_custkey", F.lit('</div><span class="organisme-ville">'),
                       "o_orderpriority", F.lit('</span><a href="mailto:c'), F.col("o_custkey").cast("string"),
                       F.lit('@example.org">ecrire</a>')),
              F.concat(F.lit('<span class="montant-estime">'), price, F.lit(' DH</span><span class="cautionnement">')),
              F.when(key % 3 == 0, F.concat("k", F.lit(" 000,50 DH"))).otherwise("12 000,00 Dhs."), '</span><span class="secteur">',
              F.when(key % 4 != 0, F.concat(F.lit(" Secteur\t"), (key % 4).cast("string"))).otherwise(""), "</span>",
              F.when(key % 3 != 1, F.concat(F.lit('<span class="organisme-tel">05 22 '), "o_custkey", F.lit("</span>"))).otherwise(""),
              F.when(key % 7 != 0, F.concat(F.lit('<p>CPV <span class="code-cpv">4500'), (key % 7).cast("string"), F.lit("</span></p>"))).otherwise(""),
              F.when(key % 2 == 0, '<a href="/doc/avis-1.pdf">x</a>').otherwise('<a href="doc.php?n=1">Avis de marche</a>'),
              '<table class="lots"><tbody>', _lines(key % 4 + 1, lot), "</tbody></table>").alias("html"))


def minutes_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    row = lambda i: F.concat(
        F.lit("<tr><td>AO-"), "k", F.lit("</td><td>ORG</td><td>PV "), i, F.lit("</td><td>"), _day(), F.lit("</td><td>"),
        F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("</td><td>"),
        F.when(i == "2", '<a href="javascript:pv()">').otherwise(F.concat(F.lit('<a href="../pv/'), "k", F.lit('.pdf">'))),
        F.lit("PV</a></td></tr>"))
    return _orders(spark, sf_dir).select(
        key.alias("page_id"), F.concat(F.lit(f"{SITE}/a/b?p="), "k").alias("url"),
        _html('<table class="pv-table"><tbody>', _lines(key % 2 + 1, row), "</tbody></table>").alias("html"))


def award_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    row = lambda i: F.concat(
        F.lit("<tr><td>AO-"), "k", F.lit("</td><td>ORG</td><td>Entreprise "), i, F.lit("</td><td>"),
        F.replace(F.col("o_totalprice").cast("decimal(15,2)").cast("string"), F.lit("."), F.lit(",")),
        F.lit(" DH</td><td>"), _day(), F.lit('</td><td><a href="?attribution='), i, F.lit('">R</a></td></tr>'))
    kind = F.when(key % 7 == 0, "autre").otherwise("attribution-table")
    return _orders(spark, sf_dir).select(
        key.alias("page_id"), F.concat(F.lit(f"{SITE}/r/liste.php?p="), "k").alias("url"),
        _html(F.concat(F.lit('<table class="'), kind, F.lit('"><tbody>')), _lines(key % 2 + 1, row),
              "</tbody></table>").alias("html"))


def form_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table rows on two pages of three, cards on the third."""
    key = F.col("o_orderkey")
    later = F.date_format(F.col("o_orderdate") + F.make_dt_interval(F.lit(9131)), "dd/MM/yyyy")
    row = lambda i: F.concat(
        F.lit("<tr><td> R-"), "k", F.lit("<br> b "), i, F.lit("</td><td><p>Objet<p>suite</td><td>Acheteur</td><td>Lieu</td><td>"),
        later, F.lit('</td><td><a href="d?r='), i, F.lit('">voir</a></td></tr>'))
    card = lambda i: F.concat(
        F.lit('<li class="consultation-item"><h3> Carte '), i, F.lit('</h3><span class="ref"> C-'), "k",
        F.lit('</span><span class="deadline">'), later, F.lit("</span></li>"))
    body = F.when(key % 3 == 2, F.concat(F.lit("<ul>"), _lines(key % 2 + 1, card), F.lit("</ul>"))).otherwise(
        F.concat(F.lit('<table class="consultation-table"><tbody>'), _lines(key % 2 + 1, row), F.lit("<tr><td></td></tr></tbody></table>")))
    return _orders(spark, sf_dir).select(
        key.alias("page_id"), F.concat(F.lit(f"{SITE}/f/liste?p="), "k").alias("url"), _html(body).alias("html"))


def recap_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail pages with the recap block; every sixth page lacks it."""
    key = F.col("o_orderkey")

    def field(name: str, *content) -> Column:
        return F.concat(F.lit(f'<span id="{_RECAP}{name}">'), *(F.lit(c) if isinstance(c, str) else c for c in content),
                        F.lit("</span>"))

    block = F.concat(
        F.lit('<div id="recap-consultation">'), field("reference", " ", F.col("k"), "<b>/</b>2025 "),
        field("dateHeureLimiteRemisePlis", _day(), " 10:00"), field("objet", "Objet A<br>B"),
        field("entiteAchat", "Entite  ", F.col("o_orderpriority")), field("typeProcedure", "Appel"),
        F.when(key % 2 == 0, field("modePassation", "ouvert")).otherwise(""),
        F.when(key % 4 != 1, F.concat(
            field("categoriePrincipale", "Cat ", (key % 4).cast("string")), field("lieuxExecutions", "Lieu ", F.col("k"), "<br>, R"),
            field("idReferentielZoneText_RepeaterReferentielZoneText_ctl0_labelReferentielZoneText", F.col("k"), ",00"),
            field("cautionProvisoire", "C ", F.col("k")), field("lieuOuverturePlis", "Salle ", F.col("k")))).otherwise(""),
        F.when(key % 5 != 1, F.concat(field("adresseRetraitDossiers", "Retrait ", F.col("k")), field("adresseDepotOffres", "Depot <i>", F.col("k"), "</i>"),
                                      field("varianteValeur", "Oui"))).otherwise(""),
        F.lit(f'<div id="{_RECAP}panelRepeaterVisitesLieux"><ul><li>Site 1<li>Site 2</ul></div></div>'))
    return _orders(spark, sf_dir).select(
        key.alias("page_id"), detail_url().alias("url"),
        _html(F.when(key % 6 != 0, block).otherwise("<p>rien</p>")).alias("html"))
