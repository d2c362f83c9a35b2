"""The element kernel and the extraction rules on hand-written pages."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adjudika.extraction import links as K
from adjudika.extraction import rows as X
from adjudika.extraction.elements import PageBatch, with_elements

SITE = "https://www.marchespublics.gov.ma"


def elements(html):
    batch = PageBatch()
    batch.add(html)
    found, texts = batch.arrays()
    return found.to_pylist()[0], texts.to_pylist()[0]


def pages(spark, *bodies):
    rows = [(i, f"{SITE}/l/p?n={i}", b) for i, b in enumerate(bodies)]
    return with_elements(spark.createDataFrame(rows, "page_id bigint, url string, html string"))


def raw_pages(spark, *bodies):
    return spark.createDataFrame([(i, f"{SITE}/l/p?n={i}", b) for i, b in enumerate(bodies)], "page_id bigint, url string, html string")


AWKWARD = [
    "<p>x</p>", "", None, "<table class=data-table></table>", '<div id="recap-consultation"></div>', "</td></tr><a>", "<a rel=next>", '<a href="" rel="next">x',
    '<table class="data-table"><tr class="row odd"><td> <td class=ref>R1<td>O<td>Travaux<td>01/02/2025<td><td>En cours<td><a href="?x=DetailsConsultation">',
    '<table id="my-results"><tbody><tr><td>A1<td>t<tr><td><b>no</b>own<td><a>n</a><a href="/k">k</a><a href="/Consultation">c</a>',
    '<table class="consultation-table"><tbody><tr><td>A1<td><table><tbody><tr><td class="titre">inner<td>x</table><td>y<tr class=row><td>A2',
    '<div class="x objet"></div><div class="objet">own<b>b</b></div><a href="mailto:a@b">m</a><a href="/x">les Avis</a><a href="dce.zip">z</a>',
    '<span class="montant-estime"> </span><span class="montant-estime">5 DH</span><a href="/n">avis dce</a>',
    '<a href="/p2"><i>Page</i> SUIVANTE</a>', '<a>next</a><a href="/l?currentPage=3">3</a><a href="/p">next</a>', '<a rel="next"></a><a href="/p">Suivant</a>',
    '<div id="recap-consultation"><span id="ctl0_CONTENU_PAGE_idEntrepriseConsultationSummary_reference"> 1 <b>/ 2</b></span>'
    '<span id="ctl0_CONTENU_PAGE_idEntrepriseConsultationSummary_reference">second</span><p id="ctl0_CONTENU_PAGE_idEntrepriseConsultationSummary_objet"></p></div>'
    '<span id="ctl0_CONTENU_PAGE_idEntrepriseConsultationSummary_categoriePrincipale">outside</span>',
]


def test_picking_in_the_kernel_equals_selecting_over_elements(spark):
    raw, listed = raw_pages(spark, *AWKWARD), pages(spark, *AWKWARD)
    for rule in (lambda p: X.tender_rows(p, stamp()), X.detail_fields, lambda p: X.recap_records(p, F.lit("t")), K.next_pages):
        one, two = (sorted(map(repr, rule(p).collect())) for p in (raw, listed))
        assert one == two and one
    assert rule(raw.limit(0)).collect() == []


def stamp():
    return F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")


def test_tree_of_malformed_html():
    found, texts = elements('<p>a<p>b<script>var t="</p><td>";</script><!-- <a href=x> --><ul><li>1<li>2</ul></b><br>c')
    assert [(e["tag"], e["above"], e["nth"]) for e in found] == [
        ("p", "/", 1), ("p", "/", 2), ("script", "/", 1), ("ul", "/", 2), ("li", "/", 1), ("li", "/", 2), ("br", "/", 3)]
    assert texts == ["a", "b", "1", "2", "c"]
    assert (found[1]["last"], found[1]["t0"], found[1]["t1"]) == (6, 1, 5)


def test_table_cells_without_end_tags_and_nested_tables():
    found, _ = elements("<table><tbody><tr><td>1<td><b>2<table><tr><td>x</table><td>3<tr><td>4</table>")
    cells = [(e["above"], e["nth"], e["own"]) for e in found if e["tag"] == "td"]
    outer, inner = "/table/tbody/", "/table/tbody/table/"
    assert cells == [(outer, 1, "1"), (outer, 2, None), (inner, 1, "x"), (outer, 3, "3"), (outer, 1, "4")]


def test_end_tags_that_match_nothing_cost_nothing():
    import time

    for html in ("<b>" * 130_000 + "</i>" * 130_000, "<i><table>" + "<b>" * 130_000 + "</i>" * 130_000, "<table>" * 60_000 + "</b><td></i>" * 60_000):
        start = time.process_time()
        PageBatch().add(html)
        assert time.process_time() - start < 3
    found, _ = elements("<i>1<table><b>2</i></table>3</i>4<u>")
    assert [(e["tag"], e["last"]) for e in found] == [("i", 2), ("table", 2), ("b", 2), ("u", 3)]


@pytest.mark.parametrize("piece", ["<a ", "<a x='", "<a x=\"'>", "<span>", "<table>", "<table><tbody>", "<script ", "<!-- ", "</b", "<td><a href=x>", "<a \"'> '", "<"])
def test_hostile_pages_take_linear_time_and_memory(piece):
    import time
    import tracemalloc

    html = piece * (1_000_000 // len(piece))
    start = time.process_time()
    batch = PageBatch()
    batch.add(html)
    assert time.process_time() - start < 4
    small = html[:200_000]
    tracemalloc.start()
    batch = PageBatch()
    batch.add(small)
    batch.arrays()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60_000_000


def test_open_quotes_end_at_the_first_bracket():
    found, texts = elements("<a href='x'>1</a><b title='open>2<i>3")
    assert [e["tag"] for e in found] == ["a", "b", "i"] and texts == ["1", "2", "3"]
    assert elements("x < y <!-- never closed <b>")[0] == [] and elements("<p>a <b")[1] == ["a <b"]


def test_attributes_and_entities():
    found, texts = elements("<a HREF='/x?a=1&amp;b=2' rel=next class=\"u  v\" title=\"a > b\">&eacute;t&eacute; &lt;</a><a href=>")
    assert found[0]["href"] == "/x?a=1&b=2" and found[0]["rel"] == "next" and found[0]["cls"] == ["u", "v"]
    assert texts == ["été <"] and len(found) == 2


def test_batches_keep_pages_apart():
    batch = PageBatch()
    for html in ("<p>a</p>", None, "", "<b>x<i>y"):
        batch.add(html)
    found, texts = batch.arrays()
    assert [len(e) for e in found.to_pylist()] == [1, 0, 0, 2]
    assert texts.to_pylist() == [["a"], [], [], ["x", "y"]]
    assert [e["last"] for e in found.to_pylist()[3]] == [1, 1]


def test_tender_rows(spark):
    good = ('<table class="data-table"><thead><tr><td>Ref</td></tr></thead><tbody>'
            '<tr><td> R1 </td><td>T\n 1</td><td>ONEE</td><td>Travaux</td><td>1/2/2025</td><td>x</td><td></td>'
            '<td><a href="../d?DetailsConsultation">v</a></td></tr>'
            '<tr><td>R2</td><td>T2</td><td>ONEE</td></tr><tr><td></td></tr></tbody></table>')
    no_table = "<table><tbody><tr><td>R3</td></tr></tbody></table>"
    got = X.tender_rows(pages(spark, good, no_table), stamp()).orderBy("ref_consultation").collect()
    assert [r.ref_consultation for r in got] == ["R1", "R2"]
    assert got[0].titre == "T 1" and got[0].date_publication == dt.datetime(2025, 2, 1) and got[0].date_limite is None
    assert got[0].url_detail == f"{SITE}/d?DetailsConsultation" and got[0].statut == "en_cours" and got[0].suivre_detail
    assert got[1].url_detail.endswith("&refConsultation=R2&orgAcronyme=ONEE") and not got[1].suivre_detail


def test_minutes_rows_and_container(spark):
    body = ('<table class="pv-table"><tbody><tr><td>A</td><td>O</td><td>T</td><td>1/1/2025</td><td>2/1/2025</td>'
            '<td><a href="javascript:x()" class="pv-link">p</a></td></tr><tr><td>B</td></tr></tbody></table>')
    rows = X.minutes_rows(pages(spark, body), stamp()).orderBy("_no").collect()
    assert [(r.ref_consultation, r.url_pv) for r in rows] == [("A", ""), ("B", "")]
    assert [r.ref_consultation for r in X.minutes_rows(pages(spark, body), stamp(), containers=True).orderBy("_no").collect()] == [
        "A", "A", "B"]


def test_form_rows_prefer_result_table_then_any_table_then_cards(spark):
    row = "<tr><td>{0}</td><td>o</td></tr>"
    both = f'<table><tbody>{row.format("no")}</tbody></table><table id="my-result"><tbody>{row.format("yes")}</tbody></table>'
    plain = f'<table><tbody>{row.format("any")}<tr><td> </td></tr></tbody></table><div class="consultation"><h3>c</h3></div>'
    cards = '<div class="consultation"><h3> c1 </h3><a href="d/1">x</a><p class="date">1/2/2025</p></div><div class="card-consultation"></div>'
    got = X.form_rows(pages(spark, both, plain, cards)).orderBy("page_id", "_no").collect()
    assert [(r.page_id, r.ref, r.objet) for r in got] == [(0, "yes", "o"), (1, "any", "o"), (2, "", "c1"), (2, "", "")]
    assert got[2].url_detail == f"{SITE}/l/d/1" and got[2].date_limite == "2025-02-01" and got[3].url_detail is None


def test_recap_without_block_is_an_empty_record(spark):
    got = X.recap_records(pages(spark, "<p>x</p>", '<div id="recap-consultation"></div>'), F.lit("t")).orderBy("url_detail").collect()
    assert got[0].sans_recap and got[0].type_procedure is None and not got[1].sans_recap and got[1].type_procedure == ""
    assert got[0].id == got[1].id and got[0].ref is None


def test_next_page_rules(spark):
    got = K.next_pages(pages(
        spark, '<a href="/a?currentPage=3">1</a><a rel="next" href="/n">x</a>', '<a href="/z">z</a><a href="/a?currentPage=3">3</a>',
        '<a href="/s">Page <b>SUIVANTE</b></a>', '<a href="/q">q</a>')).orderBy("page_id").collect()
    assert [r.next_url for r in got] == [f"{SITE}/n", f"{SITE}/a?currentPage=3", f"{SITE}/s", None]


def test_markers_and_profile(spark):
    got = K.profile(pages(
        spark, '<div class="x alert-danger">e</div><p>Aucun résultat ici</p><img alt="mon captcha">',
        "<table><tr><th>h</th></tr><tr><td>1</td><th>2</th><td>3</td></tr></table>")).orderBy("page_id").collect()
    assert got[0].error_banner and got[0].empty_result and got[0].captcha
    assert (got[1].tables, got[1].rows, got[1].headers, got[1].columns) == (1, 2, 2, 3) and not got[1].captcha


def test_link_patterns_and_kinds(spark):
    body = '<a href="/Detail?x=1">a</a><a href="/detail?x=2">b</a><a href="/autre">c</a><a href="/PV/1">p</a>'
    got = {r.pattern: r.n for r in K.link_patterns(pages(spark, body, body)).collect()}
    assert got == {"/Detail": 2, "/detail": 2}
    assert [r.pattern for r in K.link_patterns(pages(spark, body), first=1).collect()] == ["/Detail"]
    kinds = K.classify(K.page_links(pages(spark, body))).agg(F.count_if("minutes_like").alias("m")).first()
    assert kinds.m == 1


def test_sample_rows_take_the_first_link_of_the_last_linked_cell(spark):
    body = ('<table><tr><th>h</th></tr><tr><td>R<br>1</td><td><a href="/1">a</a></td>'
            '<td><a href="2">b</a><a href="/3">c</a></td><td></td></tr></table><table><tr><td>x</td></tr><tr><td>y</td></tr></table>')
    got = K.sample_tenders(pages(spark, body, "<p>none</p>")).collect()
    assert [(r.ref_consultation, r.url_detail) for r in got] == [("R1", f"{SITE}/2")]


def test_tasks_grow_with_the_pages(spark, monkeypatch):
    from adjudika.catalog import pages as C

    df = spark.range(1000).selectExpr("id AS page_id", "'u' AS url", "'<p>x</p>' AS html")
    few = spark.sparkContext.defaultParallelism
    assert C.raw(df).rdd.getNumPartitions() == C.with_elements(df).rdd.getNumPartitions() == few
    monkeypatch.setattr(C, "PAGES_A_TASK", 100 // few)
    assert C.raw(df).rdd.getNumPartitions() == C.with_elements(df).rdd.getNumPartitions() == -(-1000 // (100 // few))


def test_fields_meet_only_the_selectors_of_their_tag():
    from adjudika.extraction.picking import Field, Picker

    fields = [Field("a", [{"tag": "td", "nth": 1}, {"cls": "ref"}]), Field("b", [{"tag": "a"}], "href"), Field("c", [{"tag": "span"}], "text", " ")]
    picker = Picker(fields, rows=[{"tag": "tr"}])
    assert set(picker.by_tag) == {"td", "a", "span"} and [(x[0], len(x[3])) for x in picker.by_tag["td"]] == [(0, 2)]
    assert [x[0] for x in picker.others] == [0]
    html = '<table><tr><td>1<td><a href="u">x</a><tr><th class="ref">2<span>p <b>q</b></span></table>'
    assert [r for _, r in picker.records(html)] == [["1", "u", None], ["2", None, "p q"]]


_RAW_BODIES = ['<table class="pv-table"><tbody><tr><td>R<td>O<td> PV <td>1/2/2025<td>2025-02-01<td><a href=" pv/1.pdf">x</a>'
               '<tr><td><td><table><tbody><tr><td>in</table><a>pv</a></table>', '<a href="/Detail?x=1"><a href="/marche/PP">i</a></a><a>n</a><a href="">e</a>',
               '<A HREF="/annonce?a&amp;b">1</A><a href="/autre">', "", None, '<table class="data-table"><tr><td>1</td></tr></table>']


def test_minutes_of_raw_pages_equal_those_of_elements(spark, monkeypatch):
    """Neither elements nor pages come back from the kernel, and the rows are the same, also of broken pages."""
    minutes = lambda got, **k: sorted(map(repr, X.minutes_rows(got, stamp(), **k).collect()))
    for containers in (False, True):
        assert minutes(raw_pages(spark, *_RAW_BODIES), containers=containers) == minutes(pages(spark, *_RAW_BODIES), containers=containers) != []
    from adjudika.catalog import QUERIES

    monkeypatch.setattr("adjudika.catalog.pages.with_elements", None)  # the query takes the raw way
    assert QUERIES["ext_pv"](spark, "/root/testdata/sf0.001").count()


def test_a_tag_read_before_is_the_same_tag_whatever_follows_it():
    assert [e["tag"] for e in elements('<a"b c"><p>1')[0]] == ["a", "p"]
    assert [e["tag"] for e in elements('<a"b c"><p>1<a"b>')[0]] == ['a"b']  # here the quotes in the names are a pair
    again = [elements(f"<td class='a b' id={k}>x<td class='a b' id={k}>y")[0] for k in (1, 1, 2)]
    assert again[0] == again[1] and [e["id"] for e in again[2]] == ["2", "2"] and again[0][1]["nth"] == 2


def test_link_patterns_of_raw_pages_equal_those_of_elements(spark, monkeypatch):
    patterns = lambda got: {r.pattern: r.n for r in K.link_patterns(got).collect()}
    assert patterns(raw_pages(spark, *_RAW_BODIES)) == patterns(pages(spark, *_RAW_BODIES)) == {"/Detail": 1, "/marche/PP": 1, "/annonce": 1}
    with pytest.raises(ValueError):
        K.link_patterns(raw_pages(spark, *_RAW_BODIES), first=1)
    from adjudika.catalog import QUERIES

    monkeypatch.setattr("adjudika.catalog.pages.with_elements", None)  # the queries take the raw way
    assert all(QUERIES[name](spark, "/root/testdata/sf0.001").count() for name in ("ext_patterns_all", "ext_patterns_first"))
