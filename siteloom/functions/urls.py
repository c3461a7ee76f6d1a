"""URL rules as Column expressions.

Every rule is a composition of built-in functions, so it stays on the JVM side
and inside code generation. A URL is split by one anchored pattern (RFC 3986,
appendix B), because ``parse_url`` rejects texts that crawled pages do hold,
such as a blank inside the query.

Pass plain columns: a rule refers to its input several times.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# RFC 3986 appendix B, and the path depth of the canonical form.
SPLIT = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
MAX_DEPTH = 10


@dataclass(frozen=True)
class Parts:
    """The five parts of a URL; a missing part is the empty string."""

    scheme: Column
    authority: Column
    path: Column
    query: Column
    fragment: Column


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def split(url: Column | str) -> Parts:
    """Parts of a URL; control characters that browsers ignore are dropped first."""
    text = F.regexp_replace(_column(url), r"^[\x00-\x20]+|[\t\r\n]", "")
    part = [F.regexp_extract(text, SPLIT, k) for k in range(1, 6)]
    return Parts(F.lower(part[0]), *part[1:])


def _prefixed(mark: str, text: Column) -> Column:
    return F.when(text == "", "").otherwise(F.concat(F.lit(mark), text))


def join(parts: Parts) -> Column:
    """The URL text of the parts; empty query and fragment leave no mark."""
    scheme = F.when(parts.scheme == "", "").otherwise(F.concat(parts.scheme, F.lit(":")))
    return F.concat(
        scheme,
        _prefixed("//", parts.authority),
        parts.path,
        _prefixed("?", parts.query),
        _prefixed("#", parts.fragment),
    )


def scheme(url: Column | str) -> Column:
    return split(url).scheme


def authority(url: Column | str) -> Column:
    """Host with port and user, in the case it was written in."""
    return split(url).authority


def path(url: Column | str) -> Column:
    return split(url).path


def query(url: Column | str) -> Column:
    return split(url).query


def fragment(url: Column | str) -> Column:
    return split(url).fragment


def bare_path(url: Column | str) -> Column:
    """Path without the ``;parameters`` of its last segment."""
    return F.regexp_replace(path(url), r";[^/]*$", "")


def sanitise(url: Column | str) -> Column:
    """Lower-case scheme, no empty ``?`` or ``#``, one trailing slash dropped; blank is NULL."""
    return F.nullif(F.regexp_replace(join(split(url)), "/$", ""), F.lit(""))


def _pruned_path(whole: Column, depth: int) -> Column:
    return F.concat(F.lit("/"), F.array_join(F.slice(F.split(whole, "/"), 2, depth), "/"))


def prune(url: Column | str, depth: int = MAX_DEPTH) -> Column:
    """Keep the first ``depth`` path segments; query and fragment stay."""
    parts = split(url)
    return F.concat(
        parts.scheme,
        F.lit("://"),
        parts.authority,
        _pruned_path(parts.path, depth),
        _prefixed("?", parts.query),
        _prefixed("#", parts.fragment),
    )


def percent_encode(text: Column) -> Column:
    """Percent-encode all but letters, digits and ``_.-~=&``."""
    out = F.url_encode(text)
    # url_encode writes a blank as '+' and keeps '*'; a literal '%' is '%25' by now.
    for written, wanted in (("+", "%20"), ("*", "%2A"), ("%3D", "="), ("%26", "&"), ("%7E", "~")):
        out = F.replace(out, F.lit(written), F.lit(wanted))
    return out


def encode_query(url: Column | str) -> Column:
    """Percent-encode query and fragment; the path is left as it is."""
    parts = split(url)
    return F.concat(
        parts.scheme,
        F.lit("://"),
        parts.authority,
        parts.path,
        _prefixed("?", percent_encode(parts.query)),
        _prefixed("#", percent_encode(parts.fragment)),
    )


def drop_www(url: Column | str) -> Column:
    """Drop ``www.`` behind ``http://`` and ``https://``, wherever it occurs."""
    out = F.replace(_column(url), F.lit("http://www."), F.lit("http://"))
    return F.replace(out, F.lit("https://www."), F.lit("https://"))


def canonical(
    url: Column | str,
    depth: int = MAX_DEPTH,
    *,
    encode: bool = False,
    drop_fragment: bool = False,
    fixpoint: bool = False,
) -> Column:
    """Canonical form: sanitised, pruned to ``depth`` segments, without ``www.``.

    ``encode`` percent-encodes query and fragment and ``drop_fragment`` removes
    the fragment; both are off by default. ``fixpoint`` strips all trailing
    slashes and all ``www.`` prefixes, which makes the form idempotent.
    """
    parts = split(url)
    ending = "/+$" if fixpoint else "/$"
    last_fragment = F.lit("") if drop_fragment else parts.fragment
    bare = last_fragment == ""

    # The slash to drop is the last character of the whole text, so it belongs to
    # the last part that is not empty.
    def ended(text: Column, is_last: Column) -> Column:
        return F.when(is_last, F.regexp_replace(text, ending, "")).otherwise(text)

    whole_path = ended(parts.path, bare & (parts.query == ""))
    whole_query = ended(parts.query, bare)
    whole_fragment = F.regexp_replace(last_fragment, ending, "")
    if fixpoint:
        # Dropping a slash may empty the fragment or the query and so bare the
        # part before it; drop the slashes there as well.
        whole_query = ended(whole_query, whole_fragment == "")
        whole_path = ended(whole_path, (whole_fragment == "") & (whole_query == ""))
    if encode:
        whole_query = percent_encode(whole_query)
        whole_fragment = percent_encode(whole_fragment)
    pruned = _pruned_path(whole_path, depth)
    if fixpoint:
        # Pruning may cut the path behind an empty segment.
        pruned = F.when(
            (whole_query == "") & (whole_fragment == ""),
            F.concat(F.lit("/"), F.regexp_replace(F.substring(pruned, 2, 2**31 - 1), "/+$", "")),
        ).otherwise(pruned)
    text = F.concat(
        parts.scheme,
        F.lit("://"),
        parts.authority,
        pruned,
        _prefixed("?", whole_query),
        _prefixed("#", whole_fragment),
    )
    if fixpoint:
        return F.regexp_replace(text, r"(https?://)(?:www\.)+", "$1")
    return drop_www(text)


def remove_dots(whole: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""

    def step(done: Column, segment: Column) -> Column:
        kept = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return (
            F.when(segment == "..", kept)
            .when(segment == ".", done)
            .otherwise(F.concat(done, F.array(segment)))
        )

    # A last '.' or '..' leaves a trailing slash.
    segments = F.split(F.regexp_replace(whole, r"/(\.\.?)$", "/$1/"), "/")
    folded = F.aggregate(segments, F.array().cast("array<string>"), step)
    absolute = F.concat(F.lit("/"), F.regexp_replace(F.array_join(folded, "/"), "^/", ""))
    return F.when(whole.rlike(r"(?:^|/)\.\.?(?:/|$)"), absolute).otherwise(whole)


def resolve(base: Column | str, link: Column | str, mode: str = "rooted") -> Column:
    """Absolute form of ``link`` on ``base``; NULL for fragment-only and empty links.

    ``rooted`` resolves links that start with ``/`` or ``?`` and passes all
    others as they are. ``all`` resolves every relative link by RFC 3986.
    """
    if mode not in ("rooted", "all"):
        raise ValueError(f"resolve mode must be 'rooted' or 'all', not {mode!r}")
    link = _column(link)
    on, to = split(base), split(link)
    authority_text = F.concat(on.scheme, F.lit("://"), on.authority)
    tail = F.concat(_prefixed("?", to.query), _prefixed("#", to.fragment))
    # An empty query ('?' alone) keeps the query of the base.
    same_page = F.concat(
        authority_text,
        on.path,
        F.when(to.query == "", _prefixed("?", on.query)).otherwise(_prefixed("?", to.query)),
        _prefixed("#", to.fragment),
    )
    out = (
        F.when(
            link.startswith("//") & (to.authority != ""),
            F.concat(on.scheme, F.lit("://"), to.authority, to.path, tail),
        )
        .when(link.startswith("/"), F.concat(authority_text, remove_dots(to.path), tail))
        .when(link.startswith("?"), same_page)
    )
    rule = F.when((link == "") | link.startswith("#"), F.lit(None).cast("string"))
    if mode == "all":
        folder = F.regexp_replace(on.path, r"[^/]*$", "")
        merged = F.regexp_replace(F.concat(F.lit("/"), folder, to.path), "/{2,}", "/")
        out = out.when(to.scheme == "", F.concat(authority_text, remove_dots(merged), tail))
    return rule.otherwise(out.otherwise(link))


def extension(url: Column | str) -> Column:
    """File extension of the path without its dot, case kept; empty if there is none."""
    return F.regexp_extract(bare_path(url), r"[^/.][^/]*\.([^./]*)$", 1)


def host_key(url: Column | str) -> Column:
    """The authority without a leading ``www.``; groups the pages of one host."""
    return authority(drop_www(url))


def file_name(url: Column | str) -> Column:
    """All text behind the last slash, query included."""
    return F.substring_index(_column(url), "/", -1)


def _site_file(url: Column | str, name: str) -> Column:
    parts = split(url)
    return F.concat(parts.scheme, F.lit("://"), parts.authority, F.lit(name))


def robots_url(url: Column | str) -> Column:
    return _site_file(url, "/robots.txt")


def default_sitemap_url(url: Column | str) -> Column:
    return _site_file(url, "/sitemap.xml")


def image_path(base: Column | str, name: Column | str) -> Column:
    """Where the image store keeps a file: ``files/images/<authority>/<name>``."""
    return F.concat_ws("/", F.lit("files/images"), authority(base), _column(name))


def document_path(data_type: Column | str, site: Column | str, url: Column | str) -> Column:
    """Where the document store keeps a file: ``files/<TYPE>/<site>/<name>``."""
    return F.concat_ws("/", F.lit("files"), _column(data_type), _column(site), file_name(url))
