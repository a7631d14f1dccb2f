"""Text helpers as Column expressions: white space, entities, words, snippets."""

from __future__ import annotations

import json
import re
from html.entities import html5

from pyspark.sql import Column, functions as F

# --- Fixed values: results depend on them exactly -------------------------------
# White space as Python's str.strip() / str.split() understand it.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WS_CLASS = (
    r"\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
# Words left out of the keyword frequency.
STOP_WORDS = (
    "the a an and or but is are was were be been being to of in on at for with as "
    "by this that it its from we you your our i he she they them his her their not "
    "have has had do does did will would can could should may might if so up out "
    "about into"
).split()
# The complement of WS_CLASS, the commonest ranges first: alternatives of a class are
# tried in order, so ordinary letters are decided by the first comparison.
NON_WS_CLASS = (
    r"\x{21}-\x{84}\x{A1}-\x{167F}\x{3001}-\x{10FFFF}\x{2030}-\x{205E}\x{200B}-\x{2027}"
    r"\x{202A}-\x{202E}\x{2060}-\x{2FFF}\x{1681}-\x{1FFF}\x{86}-\x{9F}\x{0}-\x{8}"
    r"\x{E}-\x{1B}"
)
TOKEN_PATTERN = "[a-z0-9']+"  # applied to lower-cased text
MIN_TOKEN_LENGTH = 3
SNIPPET_CONTEXT = 60
SNIPPET_FALLBACK = 120
ELLIPSIS = "..."
# --------------------------------------------------------------------------------

WORD_CHAR = r"[\p{L}\p{N}_]"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    Inside lambdas Spark does no common-subexpression elimination, so a value that is
    used several times is bound to a lambda variable instead of being repeated.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[{NON_WS_CLASS}]++"))


def _entity_table() -> Column:
    """``name;`` → text for all names of HTML 5, the everyday ones first.

    One JSON literal instead of thousands of map arguments; Catalyst folds it to a
    constant map. It is searched from its beginning.
    """
    usual = ["copy;", "middot;", "nbsp;", "hellip;", "mdash;", "ndash;", "rsquo;", "eacute;"]
    full = [n for n in html5 if n.endswith(";")]
    table = {name: html5[name] for name in [*usual, *sorted(full)]}
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


def _short_names() -> list[str]:
    """Names that count without a semicolon too, longer ones before their beginnings."""
    return sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))


def _short_table() -> Column:
    table = {name: html5[name] for name in sorted(_short_names())}
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


# References that are replaced one by one, the ampersand last, so that what it brings
# about is not read again.
_PLAIN = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))
_OTHER = "&(?!(?:lt|gt|quot|#39|amp);)[#A-Za-z]"


def _code_point(hex_or_dec: Column) -> Column:
    def char(n: Column) -> Column:
        valid = (
            n.isin(9, 10, 13)
            | n.between(0x20, 0xD7FF)
            | n.between(0xE000, 0xFFFD)
            | n.between(0x10000, 0x10FFFF)
        )
        return F.when(
            valid, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        ).otherwise("")

    def number(digits: Column) -> Column:
        return (
            F.when((digits == "") | (F.length(digits) > 7), F.lit(0).cast("bigint"))
            .when(
                hex_or_dec.substr(3, 1).isin("x", "X"),
                F.conv(digits, 16, 10).cast("bigint"),
            )
            .otherwise(digits.try_cast("bigint"))
        )

    digits = F.regexp_extract(hex_or_dec, "^&#[xX]?0*([0-9A-Fa-f]*)", 1)
    return let(let(digits, number), char)


def decode_entities(text: Column, in_attribute: bool = False) -> Column:
    """Named (``&amp;``) and numeric (``&#233;``, ``&#xE9;``) references.

    All names of HTML 5; those that it allows without a semicolon are found at the
    beginning of a longer word too, the longest first (``&notit;`` is ``¬it;``), but in an
    attribute only where no letter, digit or ``=`` follows. Unknown names stay as they are;
    numbers that are no character vanish.

    Most texts have no reference, and most others only the five of everyday markup: these
    are replaced without cutting the text into pieces.
    """
    pieces = F.regexp_extract_all(
        text,
        F.lit("&(?:#[0-9]+;?|#[xX][0-9A-Fa-f]+;?|[A-Za-z][A-Za-z0-9]*+[;=]?)|[^&]++|&"),
        F.lit(0),
    )
    table, short = _entity_table(), _short_table()
    first = rf"\A&({'|'.join(_short_names())})"

    def shorter(piece: Column) -> Column:
        def replaced(name: Column) -> Column:
            rest = piece.substr(F.length(name) + 2, F.length(piece))
            known = name != ""
            if in_attribute:
                known = known & (rest == "")
            value = F.concat(F.try_element_at(short, name), rest)
            return F.when(known, value).otherwise(piece)

        return let(F.regexp_extract(piece, first, 1), replaced)

    def decode(piece: Column) -> Column:
        return (
            F.when(~piece.startswith("&"), piece)
            .when(piece.startswith("&#"), F.when(F.length(piece) > 2, _code_point(piece)))
            .otherwise(
                F.coalesce(F.try_element_at(table, piece.substr(F.lit(2), F.length(piece))), shorter(piece))
            )
        )

    plain = text
    for reference, char in _PLAIN:
        plain = F.replace(plain, F.lit(reference), F.lit(char))
    return (
        F.when(~text.contains("&"), text)
        .when(~text.rlike(_OTHER), plain)
        .otherwise(F.array_join(F.transform(pieces, decode), ""))
    )


def full_text(title: Column, headings: Column, paragraphs: Column) -> Column:
    """Title, heading texts and paragraphs, always with both joining blanks."""
    return F.concat(
        F.coalesce(title, F.lit("")),
        F.lit(" "),
        F.coalesce(F.array_join(F.flatten(F.map_values(headings)), " "), F.lit("")),
        F.lit(" "),
        F.coalesce(F.array_join(paragraphs, " "), F.lit("")),
    )


def tokenize(text: Column) -> Column:
    """Lower-cased ASCII tokens without stop words and words of one or two letters."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))
    return F.filter(
        tokens,
        lambda t: (F.length(t) >= MIN_TOKEN_LENGTH) & ~t.isin(STOP_WORDS),
    )


def _is_word_char(char: str) -> bool:
    return char.isalnum() or char == "_"


def whole_word_pattern(keyword: str) -> str:
    r"""Java pattern for ``\b keyword \b`` with Python's notion of a word character.

    The keyword is known when the plan is built, so each ``\b`` becomes the one
    look-around that can hold at that end of it.
    """
    inside, outside = f"(?<={WORD_CHAR})", f"(?<!{WORD_CHAR})"
    next_in, next_out = f"(?={WORD_CHAR})", f"(?!{WORD_CHAR})"
    if not keyword:
        return f"(?:{inside}{next_out}|{outside}{next_in})"
    literal = re.sub(r"([^\w\s])", r"\\\1", keyword)
    before = outside if _is_word_char(keyword[0]) else inside
    after = next_out if _is_word_char(keyword[-1]) else next_in
    return f"{before}{literal}{after}"


def whole_word_count(lower_text: Column, keyword: str) -> Column:
    """How often the lower-case ``keyword`` stands as a whole word; 64-bit."""
    count = F.regexp_count(lower_text, F.lit(whole_word_pattern(keyword)))
    if keyword:
        count = F.when(lower_text.contains(keyword), count).otherwise(F.lit(0))
    return count.cast("bigint")


def snippet(text: Column, keyword: Column, context: int = SNIPPET_CONTEXT) -> Column:
    """Text around the first (sub-string) occurrence of the lower-case ``keyword``."""
    size = F.length(text)

    def around(found: Column) -> Column:
        start = F.greatest(F.lit(0), found - 1 - context)
        end = F.least(size, found - 1 + F.length(keyword) + context)
        return F.concat(
            F.when(start > 0, ELLIPSIS).otherwise(""),
            strip(F.substring(text, start + 1, end - start)),
            F.when(end < size, ELLIPSIS).otherwise(""),
        )

    head = F.concat(
        strip(F.substring(text, 1, SNIPPET_FALLBACK)),
        F.when(size > SNIPPET_FALLBACK, ELLIPSIS).otherwise(""),
    )
    position = F.position(keyword, F.lower(text))
    return let(position, lambda p: F.when(p == 0, head).otherwise(around(p)))
