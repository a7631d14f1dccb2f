"""Main text of pages by the templates that pages of one host share."""

from __future__ import annotations

import html as markup
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import mixed, slices
from .stages import ship_package, stored

# A class must be found on so many pages, and on this share of the host's pages.
LEAST_PAGES = 5
LEAST_SHARE = 0.9
# HTML that is parsed at once.
SLICE_BYTES = 4 << 20
# Characters of a fixed text that its template shows.
SHOWN = 40

# --- Fixed values: HTML's own lists, and words that sites use in class names ----------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main"
    " menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead"
    " tr ul".split()
)
# What holds sentences; a link may be most of one.
SENTENCES = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
# A start tag here ends an open element of those on the right, up to the border.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
APART = frozenset(
    "nav footer aside form head button select menu dialog svg math object canvas audio video"
    " datalist fieldset search".split()
)
APART_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert menu menubar"
    " toolbar".split()
)
APART_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner"
    " sidebar nav navbar navigation menu breadcrumb breadcrumbs footer comment comments disqus"
    " reply replies respond notice notices alert cookie cookies consent gdpr popup modal"
    " newsletter subscribe share sharing social related recommended widget pagination pager"
    " toolbar masthead login signup skip".split()
)
ARTICLE_WORDS = frozenset("comment comments reply ad ads advert sponsored promo related".split())
# --------------------------------------------------------------------------------------

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|iframe|noembed|noframes|xmp|title)\b"
    r"""(?:[^<>"']|"[^"]*"|'[^']*')*+>.*?(?:</\1\b[^>]*>|\Z)"""
    r"""|<(/?)([a-z][^\s/<>"']*)((?:[^<>"']|"[^"]*"|'[^']*')*+)>"""
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_MASK = (1 << 64) - 1


@dataclass
class _Role:
    """A tag by its path from the root: what makes two tags of a host the same token."""

    name: str
    token: int
    parent: int
    tag: str
    apart: bool  # in a menu, footer, advert, comment...
    inside: int  # 2 in an article, 1 in the main element
    link: bool
    block: int  # the nearest block element's role
    depth: int


def _token(*parts: int) -> int:
    value = 0
    for part in parts:
        value = ((value ^ part) * 0x9E3779B97F4A7C15 + 0xD6E8FEB86659FD93) & _MASK
        value ^= value >> 29
    return value


class _Roles:
    """Roles that the pages of one slice have met."""

    def __init__(self):
        self.all = [_Role("", 1, -1, "", False, 0, False, 0, 0)]
        self.known: dict[tuple[int, str, str], int] = {}
        self.named: dict[tuple[int, str, str], int] = {}

    def child(self, parent: int, tag: str, attributes: str) -> int:
        key = parent, tag, attributes
        number = self.known.get(key)
        if number is None:
            number = self.known[key] = self._new(parent, tag, attributes)
        return number

    def _new(self, parent: int, tag: str, attributes: str) -> int:
        import xxhash

        found = {k.lower(): v.strip("\"'") for k, v in reversed(_ATTRIBUTE.findall(attributes))}
        words = [w.lower() for k in ("class", "id") for w in _WORD.findall(found.get(k, ""))]
        role = found.get("role", "").lower()
        key = parent, tag, " ".join([*words, "@" + role])
        if key in self.named:
            return self.named[key]
        up, number = self.all[parent], len(self.all)
        apart = up.apart or tag in APART or (tag == "header" and not up.inside)
        if tag not in ("html", "body", "main"):
            apart = apart or role in APART_ROLES
            apart = apart or not (ARTICLE_WORDS if tag == "article" else APART_WORDS).isdisjoint(words)
            apart = apart or (not up.inside and tag != "article" and "header" in words)
        inside = max(up.inside, 2 if tag == "article" else 1 if tag == "main" or role == "main" else 0)
        name = ".".join([tag, *words])
        own = xxhash.xxh3_64_intdigest(f"{name}@{role}")
        block = number if tag in BLOCKS else up.block
        link = up.link or tag == "a"
        token, depth = _token(up.token, own), up.depth + 1
        self.all.append(_Role(name, token, parent, tag, apart, inside, link, block, depth))
        self.named[key] = number
        return number


@dataclass
class _Page:
    roles: dict[int, int] = field(default_factory=dict)  # how often each is opened
    # Texts between two tags: role, the tag event before it, block, decoded text.
    texts: list[tuple[int, int, int, str]] = field(default_factory=list)


def _parse(html: str, roles: _Roles) -> _Page:
    """One pass over a page's tags, tolerant of what is not closed."""
    page, counts = _Page(), {}
    stack: list[int] = [0]
    open_tags: dict[str, int] = {}
    all_roles, texts = roles.all, page.texts
    block = event = at = 0

    def text(until: int) -> None:
        run = html[at:until]
        if run and not run.isspace():
            role = stack[-1]
            if not all_roles[role].apart:
                texts.append((role, event, block, markup.unescape(run) if "&" in run else run))
        elif run and texts and not all_roles[stack[-1]].apart:
            texts.append((stack[-1], -1, block, " "))

    def pop() -> int:
        role = stack.pop()
        open_tags[all_roles[role].tag] -= 1
        return role

    def end(names, border) -> None:
        """Close the nearest open element of ``names`` above the border."""
        for depth in range(len(stack) - 1, 0, -1):
            tag = all_roles[stack[depth]].tag
            if tag in names:
                while len(stack) > depth:
                    pop()
                return
            if tag in border:
                return

    for match in _TAG.finditer(html):
        if match.start() > at:
            text(match.start())
        at = match.end()
        tag = match.group(3)
        if tag is None:
            continue
        tag = tag.lower()
        is_block = tag in BLOCKS
        if match.group(2):
            if not open_tags.get(tag):
                block += is_block
                continue
            for depth in range(len(stack) - 1, 0, -1):
                own = all_roles[stack[depth]].tag
                if own == tag:
                    role = 0
                    while len(stack) > depth:
                        role = pop()
                    event = 2 * role + 1
                    break
                if own in BLOCKS and not is_block:
                    break  # an inline end tag ends nothing outside its block
            block += is_block
            continue
        if is_block:
            if open_tags.get("p"):
                end({"p"}, {"button", "table", "td", "th", "caption", "object", "body", "html"})
            if tag in ENDS and any(open_tags.get(t) for t in ENDS[tag][0]):
                end(*ENDS[tag])
            block += 1
        role = roles.child(stack[-1], tag, match.group(4))
        counts[role] = counts.get(role, 0) + 1
        event = 2 * role
        if tag in VOID:
            if tag == "br" and not all_roles[role].apart:
                texts.append((stack[-1], -1, block, " "))
        else:
            stack.append(role)
            open_tags[tag] = open_tags.get(tag, 0) + 1
    if at < len(html):
        text(len(html))
    page.roles = counts
    return page


def _text_token(roles: _Roles, role: int, event: int, text: str) -> int:
    """A text between two tags, by the tag before it, its element and its words."""
    import xxhash

    before = roles.all[event >> 1].token
    words = xxhash.xxh3_64_intdigest(" ".join(text.split()))
    return _token(roles.all[role].token, before, event & 1, words)


_TOKENS = (
    "host string, token long, is_tag boolean, parent long, depth long, name string, high long,"
    " low long, pages long, occurrences long, chars long, link_chars long"
)


def _host(url: Column) -> Column:
    return F.coalesce(
        F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit("")
    )


def _signed(values) -> np.ndarray:
    return np.asarray(values, np.uint64).view(np.int64)


def page_tokens(pages: DataFrame) -> DataFrame:
    """Tokens of hosts with fingerprints of their occurrence vectors, summed per slice.

    A token is a tag by its path from the root, or a text between two tags by its element,
    the tag before it and its words. Its vector is how often it occurs on each page of the
    host; the fingerprint is a sum over the pages of a 64-bit scramble of page and count,
    kept as two sums of 32 bits. Sums need no order, so no host's pages are gathered.
    """

    def tokens(batches):
        for batch, texts in slices(batches, "html", SLICE_BYTES):
            roles = _Roles()
            hosts = batch.column(batch.schema.get_field_index("host")).to_pylist()
            keys = np.array(batch.column(batch.schema.get_field_index("page_key")).to_pylist(), np.int64)
            shown: dict[int, tuple[bool, int, int, str]] = {}
            page_of, token_of, count_of = [], [], []
            chars: dict[tuple[str, int], list[int]] = {}
            for number, html in enumerate(texts.to_pylist()):
                page = _parse(html, roles)
                counts = {roles.all[r].token: n for r, n in page.roles.items()}
                for r in page.roles:
                    role = roles.all[r]
                    if role.token not in shown:
                        shown[role.token] = True, roles.all[role.parent].token, role.depth, role.name
                for r, event, _, text in page.texts:
                    if event < 0:
                        continue
                    token = _text_token(roles, r, event, text)
                    counts[token] = counts.get(token, 0) + 1
                    role = roles.all[r]
                    if token not in shown:
                        shown[token] = False, role.token, role.depth, " ".join(text.split())[:SHOWN]
                    sums = chars.setdefault((hosts[number], roles.all[role.block].token), [0, 0])
                    sums[0] += len(text)
                    sums[1] += len(text) if role.link else 0
                page_of += [number] * len(counts)
                token_of += counts.keys()
                count_of += counts.values()
            if not page_of:
                continue
            row, count = np.array(page_of), np.array(count_of, np.int64)
            token = np.array(token_of, np.uint64)
            mark = mixed(keys.view(np.uint64)[row] ^ mixed(count.astype(np.uint64)))
            names, host = np.unique(np.array(hosts, object), return_inverse=True)
            order = np.lexsort((token, host[row]))
            host, token = host[row][order], token[order]
            first = np.flatnonzero(np.r_[True, (host[1:] != host[:-1]) | (token[1:] != token[:-1])])
            own_host = names[host[first]]
            own = token[first].tolist()
            about = [shown[t] for t in own]
            sizes = [chars.get((h, t), (None, None)) for h, t in zip(own_host, own)]

            def total(values):
                return pa.array(np.add.reduceat(values[order], first), pa.int64())

            columns = [
                pa.array(own_host, pa.string()),
                pa.array(_signed(own)),
                pa.array([a[0] for a in about]),
                pa.array(_signed([a[1] for a in about])),
                pa.array([a[2] for a in about], pa.int64()),
                pa.array([a[3] for a in about]),
                total((mark >> np.uint64(32)).astype(np.int64)),
                total((mark & np.uint64(0xFFFFFFFF)).astype(np.int64)),
                total(np.ones(len(row), np.int64)),
                total(count),
                pa.array([s[0] for s in sizes], pa.int64()),
                pa.array([s[1] for s in sizes], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _TOKENS.split(", ")])

    return pages.select("host", "page_key", "html").mapInArrow(tokens, _TOKENS)


_CLASS = ("host", "high", "low", "pages", "occurrences")


def deduce_templates(
    pages: DataFrame, *, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE
) -> DataFrame:
    """Equivalence classes of every host's tokens, nested into its template.

    ``pages`` has ``host``, ``page_key`` and ``html`` (:func:`keyed_pages`). Tokens with one
    occurrence vector are a class. A class is valid if it has a tag, is found on
    ``least_pages`` pages and on ``least_share`` of the host's, and its tags lie in tags of one
    class that reaches higher up, its ``parent``, or of its own, or of lower ones. Order within a class follows
    from the tokens, which name the path to them and the tag before them. Hosts without an
    address and those of fewer pages have no template.

    One row per valid class: ``host``, ``class_id``, ``parent_id``, ``n_pages``,
    ``n_occurrences``, ``tags``, ``texts`` (the beginnings of its fixed texts), ``fixed``
    (their tokens) and ``menus`` (tags whose text is mostly links). A class is no larger
    than the smallest page it is on.
    """
    sums = [F.sum(c).alias(c) for c in ("high", "low", "pages", "occurrences", "chars", "link_chars")]
    about = [F.first(c).alias(c) for c in ("is_tag", "parent", "depth", "name")]
    found = page_tokens(pages.filter("host <> '' AND html IS NOT NULL"))
    frequent = found.groupBy("host", "token").agg(*about, *sums).filter(F.col("pages") >= least_pages)
    frequent = stored(frequent, "page-tokens")
    counts = (
        pages.filter("host <> '' AND html IS NOT NULL").groupBy("host").agg(F.count("*").alias("host_pages"))
    )
    key = F.struct(*_CLASS[1:])
    tags = frequent.filter("is_tag").withColumn("key", key)
    tops = tags.groupBy("host", "key").agg(F.min("depth").alias("top"))
    tags = tags.join(tops, ["host", "key"])
    above = tags.select(
        "host", F.col("token").alias("parent"), F.col("key").alias("above"), F.col("top").alias("above_top")
    )
    inside = tags.join(above, ["host", "parent"], "left")
    outer = (F.col("above") != F.col("key")) & (F.col("above_top") < F.col("top"))
    other = F.collect_set(F.when(outer, F.col("above")))
    classes = inside.groupBy("host", "key").agg(
        F.sort_array(F.collect_set("name")).alias("tags"),
        other.alias("parents"),
        F.sort_array(
            F.collect_list(F.when(F.col("link_chars") * 2 > F.col("chars"), F.col("token")))
        ).alias("menus"),
    )
    classes = classes.join(counts, "host").filter(
        (F.size("parents") <= 1) & (F.col("key.pages") >= F.lit(least_share) * F.col("host_pages"))
    )
    texts = (
        frequent.filter("NOT is_tag")
        .groupBy("host", key.alias("key"))
        .agg(
            F.sort_array(F.collect_list("name")).alias("texts"),
            F.sort_array(F.collect_list("token")).alias("fixed"),
        )
    )

    def name(key: Column) -> Column:
        return F.sha2(F.concat_ws(",", *(key[c] for c in _CLASS[1:])), 256).substr(1, 16)

    none = F.array().cast("array<bigint>")
    return classes.join(texts, ["host", "key"], "left").select(
        "host",
        name(F.col("key")).alias("class_id"),
        F.when(F.size("parents") == 1, name(F.get("parents", F.lit(0)))).alias("parent_id"),
        F.col("key.pages").alias("n_pages"),
        F.col("key.occurrences").alias("n_occurrences"),
        "tags",
        F.coalesce("texts", F.array().cast("array<string>")).alias("texts"),
        F.coalesce("fixed", none).alias("fixed"),
        "menus",
    )


def keyed_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, html`` with the page's ``host`` (lower case) and a ``page_key``."""
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
        _host(F.col("url")).alias("host"),
        F.xxhash64("page_id", "url").alias("page_key"),
    )


def _main_text(html: str, roles: _Roles, fixed: set[int], menus: set[int] | None) -> str:
    page = _parse(html, roles)
    visible = [t for t in page.texts if t[1] >= 0]
    depth = max((roles.all[t[0]].inside for t in visible), default=0)
    kept = [t for t in page.texts if roles.all[t[0]].inside == depth or depth == 0]
    if not depth:
        by_tag: dict[int, list[int]] = {}
        by_block: dict[int, list[int]] = {}
        for role, _, block, text in visible:
            linked = len(text) if roles.all[role].link else 0
            tag = roles.all[roles.all[role].block]
            pairs = [(by_tag, tag.token)]
            if tag.tag not in SENTENCES:
                pairs.append((by_block, block))
            for sums, key in pairs:
                own = sums.setdefault(key, [0, 0])
                own[0] += len(text)
                own[1] += linked
        if menus is None:
            menus = {token for token, (size, linked) in by_tag.items() if 2 * linked > size}
        lists = {block for block, (size, linked) in by_block.items() if 2 * linked > size}
        kept = [
            t for t in kept
            if t[2] not in lists and roles.all[roles.all[t[0]].block].token not in menus
        ]
    if fixed:
        constant = [t[1] >= 0 and _text_token(roles, t[0], t[1], t[3]) in fixed for t in kept]
        size = sum(len(t[3]) for t in kept)
        if 2 * sum(len(t[3]) for t, c in zip(kept, constant) if c) < size:
            kept = [t for t, c in zip(kept, constant) if not c]
    blocks: list[str] = []
    parts: list[str] = []
    last = None
    for _, _, block, text in kept:
        if block != last and parts:
            blocks.append(" ".join("".join(parts).split()))
            parts = []
        last = block
        parts.append(text)
    blocks.append(" ".join("".join(parts).split()))
    return " ".join(filter(None, blocks))


_TEXT = "page_id long, url string, text string, n_chars long"


def extract_text(pages: DataFrame, templates: DataFrame) -> DataFrame:
    """Main text of ``pages`` (:func:`keyed_pages`): slots of the host's template.

    Taken out are a template's fixed texts and everything in menus, headers, footers,
    sidebars, notices, adverts, forms, scripts and reader comments (by tag, ARIA role and
    words of class or id). Of what is left, the slots in ``article`` count, else those in
    ``main``, else all but tags that hold mostly links over the host (for hosts without a
    template: over the page) and single blocks of mostly links, sentences and headings aside. Fixed texts stay where they are half of a page's text or more:
    a host of copies, not a template. Inline tags join without a space; white space within
    a block becomes one space; blocks are joined by one.

    The join carries one row per host; Spark broadcasts it while it is small and splits a
    host with very many pages otherwise. Null or empty html gives empty text; null ids and
    equal rows are kept; a null url has no host. Columns: ``page_id``, ``url``, ``text``,
    ``n_chars``.
    """
    hosts = templates.groupBy("host").agg(
        F.flatten(F.collect_list("fixed")).alias("fixed"),
        F.flatten(F.collect_list("menus")).alias("menus"),
    )
    joined = pages.join(stored(hosts, "page-templates"), "host", "left")

    def texts(batches):
        sets: dict = {}
        for batch, html in slices(batches, "html", SLICE_BYTES):
            roles, out = _Roles(), []
            columns = (batch.column(batch.schema.get_field_index(c)) for c in ("host", "fixed", "menus"))
            hosts, fixed, menus = columns
            hosts = hosts.to_pylist()
            for i, page in enumerate(html.to_pylist()):
                if hosts[i] not in sets:
                    if len(sets) >= 1_000:
                        sets.clear()
                    own = fixed[i].as_py()
                    sets[hosts[i]] = (
                        {t & _MASK for t in own or ()},
                        None if own is None else {t & _MASK for t in menus[i].as_py()},
                    )
                out.append(_main_text(page, roles, *sets[hosts[i]]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("page_id")),
                    batch.column(batch.schema.get_field_index("url")),
                    pa.array(out, pa.string()),
                    pa.array(list(map(len, out)), pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    return joined.select("page_id", "url", "html", "host", "fixed", "menus").mapInArrow(texts, _TEXT)


def main_text(pages: DataFrame, **limits) -> DataFrame:
    """Templates of all hosts deduced, then applied to every page (:func:`extract_text`)."""
    ship_package(pages.sparkSession)
    keyed = keyed_pages(pages)
    return extract_text(keyed, deduce_templates(keyed, **limits))
