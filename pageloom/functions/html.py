"""HTML → text and attributes with built-in string functions only.

``mark_tags`` reads the markup once, like a tokenizer: comments, scripts, styles and
quoted attribute values are consumed as wholes, so nothing inside them is mistaken for
a tag. Every tag comes out as ``OPEN name attributes CLOSE`` with two Unicode
noncharacters as brackets, which makes all later patterns short and unambiguous. All
patterns use possessive quantifiers: linear time, no deep recursion on long pages.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import decode_entities, let, strip

OPEN, CLOSE, BORDER = "\ufdd0", "\ufdd1", "\ufdd2"

# --- Fixed values ---------------------------------------------------------------
HEADING_LEVELS = ("h1", "h2", "h3", "h4", "h5", "h6")
# Tags (start or end) that end an open paragraph.
BLOCK_TAGS = (
    "address article aside blockquote body caption center dd details dialog dir div dl "
    "dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html "
    "li listing main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul"
).split()
# Tags that end an open heading; blocks such as div may stand inside one.
HEADING_STOPS = (
    [*HEADING_LEVELS, *(f"/{h}" for h in HEADING_LEVELS)]
    + "p form li td th tr dt dd".split()
    + "/li /td /th /tr /table /form /article /section /main /nav /body /html".split()
)
SKIPPED_HREF_PREFIXES = ("javascript:", "mailto:", "tel:", "#")
# --------------------------------------------------------------------------------

_ATTRS = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""


def _raw_element(name: str) -> str:
    return rf"<(?i:{name})(?=[\s/>]){_ATTRS}>(?s:.*?)(?:</(?i:{name})(?=[\s/>]){_ATTRS}>|\z)"


_TOKEN = "|".join(
    [
        r"<!--(?s:.*?)(?:-->|\z)",
        _raw_element("script"),
        _raw_element("style"),
        r"<[!?][^>]*+(?:>|\z)",
        rf"<(/?[A-Za-z]{_ATTRS})>",
        rf"</?[A-Za-z]{_ATTRS}\z",  # cut off inside a tag
    ]
)
_NAME_END = rf"(?=[\s/{CLOSE}])"
_REST = rf"[^{CLOSE}]*+{CLOSE}"
_INLINE = rf"{OPEN}(?!/?(?i:{'|'.join(BLOCK_TAGS)}){_NAME_END}){_REST}"
_TITLE = rf"{OPEN}(?i:title){_NAME_END}{_REST}([^{OPEN}]*+)"
_PARAGRAPH = rf"{OPEN}(?i:p){_NAME_END}{_REST}([^{OPEN}]*+)"
_HEADING = (
    rf"{OPEN}(?i:h[1-6]){_NAME_END}{_REST}"
    rf"(?:[^{OPEN}]++|{OPEN}(?!(?i:{'|'.join(HEADING_STOPS)}){_NAME_END}){_REST})*+"
)
_ANY_TAG = rf"{OPEN}{_REST}"


def mark_tags(body: Column) -> Column:
    """Markup with tags in brackets; comments, scripts and styles become empty tags.

    Where the body itself holds one of the noncharacters used as marks, it becomes a
    numeric reference and is a character again when the extracted text is decoded.
    """
    for mark in (OPEN, CLOSE, BORDER):
        body = F.replace(body, F.lit(mark), F.lit(f"&#{ord(mark)};"))
    return F.regexp_replace(body, _TOKEN, f"{OPEN}$1{CLOSE}")


def block_text(marked: Column) -> Column:
    """Block tags kept, inline tags turned into borders; references are not decoded yet."""
    return F.regexp_replace(marked, _INLINE, BORDER)


def _node(text: Column) -> Column:
    """A text node: decoded, then stripped, as references may stand for white space."""
    return strip(decode_entities(text))


def text_of(segment: Column) -> Column:
    """Text nodes decoded and stripped one by one and run together
    (``Hello <b>world</b>`` → ``Helloworld``)."""
    nodes = F.transform(F.split(segment, BORDER, -1), _node)
    return F.when(segment.contains(BORDER), F.array_join(nodes, "")).otherwise(_node(segment))


def page_title(marked: Column) -> Column:
    return strip(decode_entities(F.regexp_extract(marked, _TITLE, 1)))


def paragraphs(blocks: Column) -> Column:
    texts = F.regexp_extract_all(blocks, F.lit(_PARAGRAPH), F.lit(1))
    return F.filter(F.transform(texts, text_of), lambda t: t != "")


def heading_elements(blocks: Column) -> Column:
    """``array<struct<level, text>>`` of the non-empty headings in document order."""
    found = F.regexp_extract_all(blocks, F.lit(_HEADING), F.lit(0))

    def element(raw: Column) -> Column:
        inner = F.regexp_replace(F.regexp_replace(raw, rf"\A{_ANY_TAG}", ""), _ANY_TAG, BORDER)
        return F.struct(
            F.lower(raw.substr(2, 2)).alias("level"), let(inner, text_of).alias("text")
        )

    return F.filter(F.transform(found, element), lambda h: h["text"] != "")


def headings(elements: Column) -> Column:
    """Heading elements as map level → texts; levels without text are absent."""
    levels = F.filter(
        F.array(*map(F.lit, HEADING_LEVELS)),
        lambda level: F.exists(elements, lambda e: e["level"] == level),
    )
    texts = F.transform(
        levels,
        lambda level: F.transform(
            F.filter(elements, lambda e: e["level"] == level), lambda e: e["text"]
        ),
    )
    return F.map_from_arrays(levels, texts)


def _attribute(name: str) -> str:
    """Pattern from inside a tag up to the value of ``name``; the value is group 1."""
    value = rf"""("[^"{CLOSE}]*+"|'[^'{CLOSE}]*+'|[^\s"'{CLOSE}][^\s{CLOSE}]*+)"""
    other = (
        rf"[\s/]*+(?!(?i:{name})(?=[\s=/{CLOSE}]|\z))[^\s=/{CLOSE}]++"
        rf"(?:\s*+=\s*+{value.replace('(', '(?:', 1)}?+)?+"
    )
    return rf"(?:{other})*+[\s/]*+(?i:{name})\s*+=\s*+{value}"


def _value(raw: Column) -> Column:
    unquoted = F.when(
        raw.startswith('"') | raw.startswith("'"), raw.substr(F.lit(2), F.length(raw) - 2)
    ).otherwise(raw)
    return decode_entities(unquoted, in_attribute=True)


def _address(raw: Column) -> Column:
    """A stripped address; the noncharacters used as marks cannot be part of one."""
    return strip(F.translate(raw, OPEN + CLOSE + BORDER, ""))


def attribute_values(marked: Column, tag: str, name: str) -> Column:
    """Value of attribute ``name`` for each ``<tag>`` that has it, in document order."""
    pattern = rf"{OPEN}(?i:{tag})(?=[\s/]){_attribute(name)}"
    return F.transform(F.regexp_extract_all(marked, F.lit(pattern), F.lit(1)), _value)


def meta_elements(marked: Column) -> Column:
    """``array<struct<name, content>>`` of all ``<meta>`` tags."""
    tags = F.regexp_extract_all(
        marked, F.lit(rf"{OPEN}(?i:meta)([\s/][^{CLOSE}]*+){CLOSE}"), F.lit(1)
    )

    def pair(tag: Column) -> Column:
        return F.struct(
            *(
                _value(F.regexp_extract(tag, r"\A" + _attribute(name), 1)).alias(name)
                for name in ("name", "content")
            )
        )

    return F.transform(tags, pair)


def meta_content(metas: Column, name: str) -> Column:
    """Content of the first ``<meta>`` called exactly ``name``, else empty."""
    first = F.try_element_at(F.filter(metas, lambda m: m["name"] == name), F.lit(1))
    return F.coalesce(strip(first["content"]), F.lit(""))


def href_values(marked: Column) -> Column:
    """Stripped ``href`` of anchors, without blanks and the skipped prefixes."""
    hrefs = F.transform(attribute_values(marked, "a", "href"), _address)

    def wanted(href: Column) -> Column:
        keep = href != ""
        for prefix in SKIPPED_HREF_PREFIXES:
            keep = keep & ~href.startswith(prefix)
        return keep

    return F.filter(hrefs, wanted)


def src_values(marked: Column) -> Column:
    """Stripped, non-empty ``src`` of images."""
    sources = F.transform(attribute_values(marked, "img", "src"), _address)
    return F.filter(sources, lambda s: s != "")
