"""The page parser: lists the elements and text pieces of each archived page.

``with_elements`` adds two arrays to a page row. ``elements`` is in document order, and an element's descendants are the
slots that follow it up to ``last``; ``texts`` holds the stripped non-blank text pieces, and an element owns the slice
``[t0, t1)``. ``above`` holds of the enclosing tags only what selectors ask for (see ``_below``), so it stays short however deep a
page nests. Time and memory are linear in the page, also if tags, quotes or comments never close or end tags match nothing. Selection and
field rules are column expressions over these arrays; ``picking`` selects within the kernel instead.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from adjudika.extraction.selectors import SELECTORS
from adjudika.session import ship_package

# Fixed values of HTML: elements without content, and which open elements a start tag closes within which scope.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CLOSES = {
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
    "li": ({"li"}, {"ul", "ol", "table"}),
    "option": ({"option"}, {"select", "table"}),
    "p": ({"p"}, {"td", "th", "li", "div", "table"}),
}

# What starts at a "<": a comment, a declaration, a script or style with its content, or a tag. Quoted attribute values may hold ">";
# where quotes never close, a tag ends at the first ">".
_ASIDE = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?", re.DOTALL)
_RAW = re.compile(r"<(?P<raw>script|style)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)", re.IGNORECASE | re.DOTALL)
# The letters of ``[a-z]`` in either case, as ``re.IGNORECASE`` takes them; without the flag a match is faster.
_LETTER = "[a-zA-Z\u0130\u0131\u017f\u212a]"
_TAG = re.compile(rf"<(/?)({_LETTER}[^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>")
_TAG_UNQUOTED = re.compile(rf"<(/?)({_LETTER}[^\s/>]*)([^>]*)>")
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")

_INTS, _WORDS = ("i", "last", "nth", "t0", "t1"), ("cls",)
_FIELDS = ("i", "last", "tag", "above", "nth", "id", "cls", "href", "rel", "alt", "own", "t0", "t1")
ELEMENT = T.StructType([
    T.StructField(f, T.IntegerType() if f in _INTS else T.ArrayType(T.StringType()) if f in _WORDS else T.StringType())
    for f in _FIELDS
])


def _arrow_type(field: str) -> pa.DataType:
    return pa.int32() if field in _INTS else pa.list_(pa.string()) if field in _WORDS else pa.string()


#: Attributes that an element's record keeps.
_KEPT = frozenset(("id", "class", "href", "rel", "alt"))


def _attributes(source: str) -> dict[str, str]:
    """The kept attributes; of a repeated one the first."""
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTR.findall(source):
        name = name.lower()
        if name in _KEPT and name not in found:
            value = double or single or bare
            found[name] = unescape(value) if "&" in value else value
    return found


#: Tags that a selector may ask for above an element, in chains of up to two.
_ASKED = frozenset(tag for group in SELECTORS.values() for options in group.values() for sel in options for tag in sel.get("under") or ())


@lru_cache(maxsize=4096)
def _below(path: str, tag: str) -> str:
    """The path of a child: ``tag`` joins it if it is asked for and tells something new, a first tag or a first pair in this order."""
    if tag not in _ASKED:
        return path
    held = path.strip("/").split("/") if path != "/" else []
    pairs = {(a, b) for i, a in enumerate(held) for b in held[i + 1:]}
    return path if tag in held and all((a, tag) in pairs for a in held) else f"{path}{tag}/"


# What is known when an element starts, and what only its content and end tell.
_AT_START = ("i", "tag", "above", "nth", "t0", "id", "cls", "href", "rel", "alt")
_LATER = ("last", "own", "t1")
_NO_ATTRIBUTES = (None, (), None, None, None)
_HREF = 2  # the place of the address among an element's attributes

# What a piece of source is: nothing to list, or an element without or with content.
_SKIP, _EMPTY, _OPENS = range(3)
#: A tag whose name has no quote: it is the same tag whatever follows it on the page.
_ALONE = re.compile(r"""</?[^\s/>"']+[\s/>]""")
#: Tags by their source, read once per worker: short ones without an address, of which pages repeat a few. It never holds more than ``_MOST``.
_SEEN: dict[str, tuple] = {}
_SHORT, _MOST = 64, 4096


def _tag(end: str, tag: str, source: str) -> tuple:
    """What a tag is, its name, the open elements it closes within which scope, and its attributes."""
    tag = tag.lower()
    if end:
        wanted = None if tag in VOID else (tag,)
        return _SKIP, tag, wanted, () if tag in ("table", "body", "html") else ("table",), _NO_ATTRIBUTES
    attributes = _NO_ATTRIBUTES
    if "=" in source:
        get = _attributes(source).get
        attributes = (get("id"), get("class", "").split(), get("href"), get("rel"), get("alt"))
    return _EMPTY if tag in VOID else _OPENS, tag, *CLOSES.get(tag, (None, None)), attributes


class PageBatch:
    """Elements and texts of several pages, with one offset per page."""

    def __init__(self):
        self.started: list[tuple] = []
        self.later = {f: [] for f in _LATER}
        self.texts: list[str] = []
        self.offsets, self.text_offsets = [0], [0]

    def add(self, html: str | None) -> None:
        started, texts, base, text_base = self.started, self.texts, self.offsets[-1], self.text_offsets[-1]
        last, own, t1 = (self.later[f] for f in _LATER)
        opened: list[list] = []  # of each open element its slot, tag, the asked-for tags above a child, and children seen so far
        root = [None, None, "/", 0]
        depths: dict[str, list[int]] = {}  # of the open elements of each tag, the nearest one last

        def pop_to(depth: int) -> None:
            end, place = len(started) - 1 - base, len(texts) - text_base
            for slot, name, _, _ in opened[depth:]:
                last[slot], t1[slot] = end, place
                depths[name].pop()
            del opened[depth:]

        def close(wanted, scope) -> None:
            """Close the nearest open element of these names, unless a scope element is nearer."""
            depth = -1
            for t in wanted:
                at = depths.get(t)
                if at and at[-1] > depth:
                    depth = at[-1]
            if depth >= 0:
                for t in scope:
                    at = depths.get(t)
                    if at and at[-1] > depth:
                        return
                pop_to(depth)

        html, at = html or "", 0
        find, seen = html.find, _SEEN
        limit, quoted, begin = html.rfind(">"), True, find("<")
        while begin >= 0:
            known = seen.get(html[begin:find(">", begin, begin + _SHORT) + 1]) if quoted else None
            if known:
                stop, kind, tag, wanted, scope, attributes = known
                stop += begin
            else:
                token, lead, tag, wanted = None, html[begin + 1:begin + 2], None, None
                if lead == "!" or lead == "?":
                    token, kind = _ASIDE.match(html, begin), _SKIP
                elif begin < limit and (lead == "/" or lead.isalpha()):
                    if lead in "sS" and (token := _RAW.match(html, begin)):  # listed as an element, its content is not text
                        kind, tag, attributes = _EMPTY, token["raw"].lower(), _NO_ATTRIBUTES
                    else:
                        token = _TAG.match(html, begin) if quoted else None
                        if token is None and (token := _TAG_UNQUOTED.match(html, begin)):
                            quoted = False  # some quotes run to the end of the page: do not look for their end again
                        if token:
                            kind, tag, wanted, scope, attributes = known = _tag(*token.groups())
                            if quoted and token.end() - begin <= _SHORT and len(seen) < _MOST and not attributes[_HREF] and _ALONE.match(token[0]):
                                seen[token[0]] = (token.end() - begin, *known)
                if token is None:
                    begin = find("<", begin + 1)
                    continue
                stop = token.end()
            if begin > at and opened:
                piece = html[at:begin]
                if "&" in piece:
                    piece = unescape(piece)
                slot = opened[-1][0]
                if own[slot] is None:
                    own[slot] = piece
                if piece := piece.strip():
                    texts.append(piece)
            at = stop
            begin = find("<", at)
            if wanted:
                if opened and opened[-1][1] in wanted:  # nothing is nearer
                    slot, name, _, _ = opened.pop()
                    last[slot], t1[slot] = len(started) - 1 - base, len(texts) - text_base
                    depths[name].pop()
                else:
                    close(wanted, scope)
            if kind >= _EMPTY:
                parent = opened[-1] if opened else root
                parent[3] += 1
                slot, place = len(started), len(texts) - text_base
                started.append((slot - base, tag, parent[2], parent[3], place, *attributes))
                last.append(slot - base)
                own.append(None)
                t1.append(place)
                if kind == _OPENS:
                    if tag in depths:
                        depths[tag].append(len(opened))
                    else:
                        depths[tag] = [len(opened)]
                    opened.append([slot, tag, _below(parent[2], tag) if tag in _ASKED else parent[2], 0])
        if at < len(html) and opened:
            piece, slot = unescape(html[at:]), opened[-1][0]
            if own[slot] is None:
                own[slot] = piece
            if piece := piece.strip():
                texts.append(piece)
        pop_to(0)
        self.offsets.append(len(started))
        self.text_offsets.append(len(texts))

    def arrays(self) -> tuple[pa.Array, pa.Array]:
        columns = dict(zip(_AT_START, zip(*self.started))) if self.started else {f: () for f in _AT_START}
        columns.update(self.later)
        fields = [pa.array(columns[f], _arrow_type(f)) for f in _FIELDS]
        structs = pa.StructArray.from_arrays(fields, names=list(_FIELDS))
        return (pa.ListArray.from_arrays(pa.array(self.offsets, pa.int32()), structs),
                pa.ListArray.from_arrays(pa.array(self.text_offsets, pa.int32()), pa.array(self.texts, pa.string())))


def _kernel(chunk: int):
    def run(batches):
        for batch in batches:
            html_at = batch.schema.get_field_index("html")
            for begin in range(0, batch.num_rows, chunk):
                part = batch.slice(begin, chunk)
                found = PageBatch()
                for html in part.column(html_at):
                    found.add(html.as_py())
                kept = [c for i, c in enumerate(part.columns) if i != html_at]
                names = [n for n in part.schema.names if n != "html"]
                yield pa.RecordBatch.from_arrays([*kept, *found.arrays()], names=[*names, "elements", "texts"])
    return run


def with_elements(pages: DataFrame, chunk: int = 64, partitions: int | None = None) -> DataFrame:
    """Replace ``html`` by ``elements`` and ``texts``; other columns stay. Output leaves in chunks of ``chunk`` pages.

    ``partitions`` deals the pages out first, for inputs that a scan puts into fewer partitions than there are cores; without it no page moves.
    """
    schema = T.StructType([f for f in pages.schema if f.name != "html"])
    schema = schema.add("elements", T.ArrayType(ELEMENT)).add("texts", T.ArrayType(T.StringType()))
    dealt = pages.repartition(partitions, "page_id") if partitions else pages
    ship_package(pages.sparkSession)
    return dealt.mapInArrow(_kernel(chunk), schema)
