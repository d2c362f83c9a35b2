"""Selection in the page kernel: what a record needs of a page is taken while the page is at hand, and only that leaves the Python worker.

A ``Picker`` is compiled once per task from selector settings: which elements are records, and which text or address each field takes. The
kernel yields one row per record, with the page's other columns, so neither elements nor pages reach the JVM. The rules that read a
field (amounts, dates, labels, addresses) stay column expressions. ``with_elements`` serves everything that looks at whole pages.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from adjudika.extraction.elements import PageBatch
from adjudika.session import ship_package

# Places in an element's record, in the order in which the parser gives them.
_I, _TAG, _ABOVE, _NTH, _T0, _ID, _CLS, _HREF, _REL, _ALT = range(10)


@dataclass(frozen=True)
class Field:
    """What a record takes: ``own`` (the first direct text) or ``href`` of the first matching element that has one; or, of the first matching
    element whether it has any or not, ``first_href`` (``''`` without) or ``text``, all its text pieces joined by ``separator``. ``row_href`` is
    the address of the record's own element, whatever lies in it.

    ``says``: words of which the text has to contain one, unless the address contains ``either``; ``href_words``: words of which the address
    has to contain one; both in lower case if ``lowered``.
    """
    name: str
    selectors: list
    take: str = "own"
    separator: str = ""
    says: tuple[str, ...] = ()
    href_words: tuple[str, ...] = ()
    either: str = ""
    lowered: bool = False


def _test(sel: dict, tagged: bool = False) -> Callable:
    """One selector as a test of an element's record; ``tagged``: the element is known to have the tag."""
    tests: list[Callable] = []
    if sel.get("tag") and not tagged:
        tests.append(lambda e, v=sel["tag"]: e[_TAG] == v)
    if sel.get("nth"):
        tests.append(lambda e, v=sel["nth"]: e[_NTH] == v)
    if sel.get("cls"):
        tests.append(lambda e, v=sel["cls"]: v in e[_CLS])
    if sel.get("cls_has"):
        tests.append(lambda e, v=sel["cls_has"]: v in " ".join(e[_CLS]))
    if sel.get("under"):
        def under(e, first=f"/{sel['under'][0]}/", rest=[f"{u}/" for u in sel["under"][1:]]):
            at = e[_ABOVE].find(first)
            end = at + len(first)
            for step in rest:
                if at < 0:
                    return False
                at = e[_ABOVE].find(step, end)
                end = at + len(step)
            return at >= 0
        tests.append(under)
    for key, part in (("id", _ID), ("rel", _REL)):
        if sel.get(key):
            tests.append(lambda e, v=sel[key], p=part: e[p] == v)
    for key, part in (("id_has", _ID), ("href_has", _HREF), ("alt_has", _ALT)):
        if sel.get(key):
            tests.append(lambda e, v=sel[key], p=part: e[p] is not None and v in e[p])
    if sel.get("href_starts"):
        tests.append(lambda e, v=sel["href_starts"]: e[_HREF] is not None and e[_HREF].startswith(v))
    if not tests:
        return lambda e: True
    if len(tests) == 1:
        return tests[0]
    if len(tests) == 2:
        return lambda e, a=tests[0], b=tests[1]: a(e) and b(e)
    return lambda e: all(t(e) for t in tests)


class _Matcher:
    """Selectors by tag: an element only meets the tests that its tag can pass."""

    def __init__(self, selectors: list[dict]):
        self.by_tag: dict[str, list] = {}
        self.any_tag = [_test(sel) for sel in selectors if not sel.get("tag")]
        for sel in selectors:
            if sel.get("tag"):
                self.by_tag.setdefault(sel["tag"], []).append(_test(sel, True))

    def __call__(self, e) -> bool:
        for t in self.by_tag.get(e[_TAG], ()):
            if t(e):
                return True
        for t in self.any_tag:
            if t(e):
                return True
        return False


class Picker:
    """``rows``: selectors of the elements that are records; None makes the page one record. ``needs``: a page without such an element
    has no records. ``scope``: the first such element is the record's scope, and a page without it gives one record of NULLs. ``inside``: a
    record's own element is no candidate for ``own`` fields. ``required``: a field without which a record does not count; white space is none.
    """

    def __init__(self, fields: list[Field], rows=None, needs=None, scope=None, inside: bool = True, required: str | None = None):
        self.fields, self.inside = fields, inside
        # Records that only give their own address: nothing in them is looked at.
        self.own_href = bool(fields) and all(f.take == "row_href" for f in fields)
        self.required = next((k for k, f in enumerate(fields) if f.name == required), None)
        self.rows, self.needs, self.scope = (None if x is None else _Matcher(x) for x in (rows, needs, scope))
        tags = {sel["tag"] for f in fields for sel in f.selectors if sel.get("tag")}
        # By tag, the fields that an element of it may fill, and their tests; elements of all other tags meet ``others``.
        self.by_tag, self.others = {tag: self._tests(tag) for tag in tags}, self._tests(None)

    def _tests(self, tag: str | None) -> list[tuple]:
        each = ((k, f, f.take == "own", [_test(s, True) for s in f.selectors if s.get("tag") in (None, tag)]) for k, f in enumerate(self.fields))
        return [x for x in each if x[3]]

    def _value(self, f: Field, e, page: PageBatch, at: int, first: int):
        """The field's value of a matching element, or None if the next one is to be tried; text of None counts as found."""
        if f.take == "first_href":
            return e[_HREF] or ""
        if f.take == "row_href":
            return e[_HREF] if at == first else None
        if f.take == "href":
            href = e[_HREF]
            if href is None:
                return None
            if f.href_words and not any(w in (href.lower() if f.lowered else href) for w in f.href_words):
                return None
            if f.says:
                text = " ".join(page.texts[e[_T0]:page.later["t1"][at]])
                text = text.lower() if f.lowered else text
                if not any(w in text for w in f.says) and not (f.either and f.either in href):
                    return None
            return href
        return f.separator.join(page.texts[e[_T0]:page.later["t1"][at]])

    def _record(self, page: PageBatch, first: int, last: int) -> list:
        values: list = [None] * len(self.fields)
        left, started, own_texts = len(values), page.started, page.later["own"]
        by_tag, others, skipped = self.by_tag, self.others, first if self.inside else -1
        for at in range(first, last + 1):
            e = started[at]
            for k, f, own, tests in by_tag.get(e[_TAG], others):
                if values[k] is None and not (own and at == skipped):
                    for test in tests:
                        if test(e):
                            value = values[k] = own_texts[at] if own else self._value(f, e, page, at, first)
                            left -= value is not None
                            break
            if not left:
                break
        return values

    def records(self, html: str | None) -> list[tuple[int | None, list]]:
        """(place of the record's element, field values) of every record of the page."""
        page = PageBatch()
        page.add(html)
        started, last = page.started, page.later["last"]
        if self.needs and not any(self.needs(e) for e in started):
            return []
        if self.rows and self.own_href:
            return [(at, [e[_HREF]] * len(self.fields)) for at, e in enumerate(started) if self.rows(e)]
        if self.rows:
            made = [(at, self._record(page, at, last[at])) for at, e in enumerate(started) if self.rows(e)]
            return made if self.required is None else [r for r in made if (r[1][self.required] or "").strip()]
        if self.scope:
            at = next((at for at, e in enumerate(started) if self.scope(e)), None)
            return [(None, [None] * len(self.fields))] if at is None else [(at, self._record(page, at, last[at]))]
        return [(0, self._record(page, 0, len(started) - 1))]


def with_records(pages: DataFrame, fields: list[Field], rows=None, needs=None, scope=None, inside: bool = True, chunk: int = 64,
                 required: str | None = None, empty_pages: bool = False) -> DataFrame:
    """One row per record: the columns of ``pages`` but ``html``, ``no`` (NULL for a page without its scope) and one text per field.

    ``empty_pages`` adds the column ``html`` and one row for each page without a record, the only rows that carry it; their ``no`` is NULL.
    """
    kept = [f for f in pages.schema if f.name != "html"]
    tail = [T.StructField("html", T.StringType())] if empty_pages else []
    schema = T.StructType([*kept, T.StructField("no", T.IntegerType()), *(T.StructField(f.name, T.StringType()) for f in fields), *tail])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        picker = Picker(fields, rows, needs, scope, inside, required)
        for batch in batches:
            for begin in range(0, batch.num_rows, chunk):
                part = batch.slice(begin, chunk)
                owner, places, values, whole = [], [], [], []
                for k, html in enumerate(part.column("html")):
                    found = picker.records(html.as_py())
                    empty = empty_pages and not found
                    for place, record in [(None, [None] * len(fields))] if empty else found:
                        owner.append(k)
                        places.append(place)
                        values.append(record)
                        whole.append(k if empty else None)
                columns = list(zip(*values)) if values else [()] * len(fields)
                own = pa.array(owner, pa.int32())
                last = [part.column("html").take(pa.array(whole, pa.int32()))] if empty_pages else []
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n).take(own) for n in names), pa.array(places, pa.int32()), *(pa.array(c, pa.string()) for c in columns), *last],
                    names=[*names, "no", *(f.name for f in fields), *(["html"] if empty_pages else [])])

    ship_package(pages.sparkSession)
    return pages.mapInArrow(run, schema)


def dealt(pages: DataFrame, partitions: int | None) -> DataFrame:
    """Pages dealt out, for inputs that a scan puts into fewer partitions than there are cores."""
    return pages.repartition(partitions, "page_id") if partitions else pages


def is_raw(pages: DataFrame) -> bool:
    """Whether the pages still have their HTML: then the kernel selects; otherwise they have elements."""
    return "html" in pages.columns

