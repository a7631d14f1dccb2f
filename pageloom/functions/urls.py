"""URL algebra as Column expressions, after RFC 3986 and the WHATWG clean-up rules.

A URL is taken apart by one regular expression into an array
``[scheme, netloc, path, query, fragment]``; an absent part is the empty string.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import let, strip

# --- Fixed values ---------------------------------------------------------------
CRAWLABLE_SCHEMES = ("http", "https")
# Schemes with hierarchical paths that take relative references.
RELATIVE_SCHEMES = (
    "", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https", "shttp",
    "mms", "prospero", "rtsp", "rtsps", "rtspu", "sftp", "svn", "svn+ssh", "ws", "wss",
)
# Schemes written with `//` even if the host is empty.
NETLOC_SCHEMES = (
    "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file", "mms", "https",
    "shttp", "snews", "prospero", "rtsp", "rtsps", "rtspu", "rsync", "svn", "svn+ssh",
    "sftp", "nfs", "git", "git+ssh", "ws", "wss", "itms-services",
)
INVALID_NETLOC = "Invalid IPv6 URL"
# --------------------------------------------------------------------------------

_SCHEME = r"(?:([A-Za-z][A-Za-z0-9+.\-]*+):)?+"
_SPLIT = r"(?s)\A" + _SCHEME + r"(?://([^/?#]*+))?+([^?#]*+)(?:\?([^#]*+))?+(?:#(.*+))?+\z"
_SEP = "\ufdd0"  # a noncharacter: never part of a URL
_LEAD = r"\A[\x00-\x20]++"
_DOTS = r"(?:\A|/)\.\.?(?:/|\z)"


def _clean(url: Column) -> Column:
    """Leading controls and blanks go, tabs and line ends go anywhere."""
    return F.regexp_replace(F.translate(url, "\t\r\n", ""), _LEAD, "")


def _split(url: Column) -> Column:
    joined = F.regexp_replace(_clean(url), _SPLIT, _SEP.join(f"${i}" for i in range(1, 6)))
    return F.split(joined, _SEP, -1)


def url_parts(url: Column) -> Column:
    """``struct(scheme, netloc, path, query, fragment)``; scheme in lower case."""
    return let(
        _split(url),
        lambda p: F.struct(
            F.lower(p[0]).alias("scheme"),
            p[1].alias("netloc"),
            p[2].alias("path"),
            p[3].alias("query"),
            p[4].alias("fragment"),
        ),
    )


def get_domain(url: Column) -> Column:
    """Lower-cased network location, port and user info included."""
    pattern = r"\A(?:[A-Za-z][A-Za-z0-9+.\-]*+:)?+//([^/?#]*+)"
    return F.lower(F.regexp_extract(_clean(url), pattern, 1))


def get_scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(_clean(url), r"\A([A-Za-z][A-Za-z0-9+.\-]*+):", 1))


def is_same_domain(url: Column, root: Column) -> Column:
    """The host itself or a subdomain of ``root``."""
    domain, root = get_domain(url), F.lower(root)
    return (domain == root) | domain.endswith(F.concat(F.lit("."), root))


def is_crawlable_scheme(url: Column) -> Column:
    return get_scheme(url).isin(*CRAWLABLE_SCHEMES)


def domain_suffixes(domain: Column) -> Column:
    """``a.b.c`` → ``[a.b.c, b.c, c]``: every root that ``domain`` may belong to."""
    labels = F.split(domain, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


def _bad_netloc(netloc: Column) -> Column:
    return netloc.contains("[") != netloc.contains("]")


def _assemble(scheme: Column, netloc: Column, path: Column, query: Column) -> Column:
    rooted = F.when((path != "") & ~path.startswith("/"), F.concat(F.lit("/"), path))
    authority = (
        F.when(netloc != "", F.concat(F.lit("//"), netloc, rooted.otherwise(path)))
        .when(
            path.startswith("//")
            | (scheme.isin(*NETLOC_SCHEMES) & ((path == "") | path.startswith("/"))),
            F.concat(F.lit("//"), path),
        )
        .otherwise(path)
    )
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""),
        authority,
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
    )


def _fold_dots(path: Column) -> Column:
    segments = F.split(path, "/", -1)

    def step(done: Column, segment: Column) -> Column:
        return (
            F.when(segment == ".", done)
            .when(
                segment == "..",
                F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))),
            )
            .otherwise(F.concat(done, F.array(segment)))
        )

    folded = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        step,
        lambda done: F.array_join(
            F.when(
                F.element_at(segments, -1).isin(".", ".."),
                F.concat(done, F.array(F.lit(""))),
            ).otherwise(done),
            "/",
        ),
    )
    return let(folded, lambda p: F.when(p == "", "/").otherwise(p))


def _without_dots(path: Column) -> Column:
    return F.when(path.rlike(_DOTS), _fold_dots(path)).otherwise(path)


def base_parts(base: Column) -> Column:
    """What resolving against ``base`` needs, computed once per page.

    ``struct(scheme, netloc, path, query, folder, self)``: ``folder`` is the path up to
    its last slash, ``self`` the base without fragment, null if its host is malformed.
    """

    def build(p: Column) -> Column:
        scheme, netloc, path, query = F.lower(p[0]), p[1], p[2], p[3]
        own = (
            F.when(_bad_netloc(netloc), F.lit(None).cast("string"))
            .when(base.contains("#"), _assemble(scheme, netloc, path, query))
            .otherwise(base)
        )
        folder = F.regexp_extract(path, r"(?s)\A(.*/)", 1)
        return F.struct(
            scheme.alias("scheme"),
            netloc.alias("netloc"),
            path.alias("path"),
            query.alias("query"),
            F.when((folder == "") & (netloc != ""), "/").otherwise(folder).alias("folder"),
            own.alias("self"),
        )

    return let(_split(base), build)


def resolve(base: Column, link: Column) -> Column:
    """``link`` seen from a page, without fragment; ``base`` comes from ``base_parts``.

    Null if a host has unbalanced brackets.
    """

    def absolute(raw: Column, p: Column) -> Column:
        scheme, netloc, path, query = F.lower(p[0]), p[1], p[2], p[3]
        foreign = (scheme != "") & (
            (scheme != base["scheme"]) | ~scheme.isin(*RELATIVE_SCHEMES)
        )
        inside = ~foreign & (netloc == "")
        joined = F.when(path.startswith("/"), path).otherwise(
            F.regexp_replace(F.concat(base["folder"], path), "/{2,}", "/")
        )
        target = F.struct(
            F.when(foreign, scheme).otherwise(base["scheme"]).alias("scheme"),
            F.when(inside, base["netloc"]).otherwise(netloc).alias("netloc"),
            F.when(~inside, path)
            .when(path == "", base["path"])
            .otherwise(let(joined, _without_dots))
            .alias("path"),
            F.when(inside & (path == "") & (query == ""), base["query"])
            .otherwise(query)
            .alias("query"),
        )
        return (
            F.when(base["self"].isNull() | _bad_netloc(netloc), F.lit(None).cast("string"))
            .when(raw == "", base["self"])
            .when(foreign & ~raw.contains("#"), raw)
            .otherwise(
                let(
                    target,
                    lambda t: _assemble(t["scheme"], t["netloc"], t["path"], t["query"]),
                )
            )
        )

    return let(strip(link), lambda raw: let(_split(raw), lambda p: absolute(raw, p)))


def normalize_url(base: Column, link: Column) -> Column:
    """Resolve ``link`` against ``base`` and drop the fragment."""
    return let(base_parts(base), lambda b: resolve(b, link))
