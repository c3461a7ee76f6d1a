"""Links, script redirects, images and classes of stored pages.

Two engines give the same table of start tags
``(page_id, url, base_href, pos, tag, href, onclick, src)``: ``native`` uses
regular expressions on the JVM side, ``parser`` runs the standard library's HTML
parser on Arrow batches and so follows odd markup more closely. All rules are
column expressions on that table. The HTML text itself never enters a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteloom.functions import html as H
from siteloom.functions import urls

TAGS = "page_id long, url string, base_href string, pos int, tag string, href string, onclick string, src string"


def _base_tag(body: Column) -> Column:
    return F.try_element_at(H.tags(body, ("base",)), F.lit(1))


def _native_tags(pages: DataFrame, names: tuple[str, ...], attributes: tuple[str, ...]) -> DataFrame:
    def parsed(tag: Column) -> Column:
        return F.struct(
            H.tag_name(tag).alias("tag"),
            *[H.attribute(tag, name).alias(name) for name in attributes],
        )

    body = pages.select("page_id", "url", H.visible(F.col("html")).alias("_body"))
    based = body.select("page_id", "url", "_body", _base_tag(F.col("_body")).alias("_base"))
    # The attributes are read inside the generator: filters on them then stay
    # above it and are not copied into every expression below.
    listed = based.select(
        "page_id",
        "url",
        F.coalesce(H.attribute(F.col("_base"), "href"), "url").alias("base_href"),
        F.posexplode(F.transform(H.tags(F.col("_body"), names), parsed)).alias("pos", "_tag"),
    )
    return listed.select("page_id", "url", "base_href", "pos", "_tag.*")


def _parser_tags(pages: DataFrame, names: tuple[str, ...], attributes: tuple[str, ...]) -> DataFrame:
    # Nested, so that the function travels to the workers by value.
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from html.parser import HTMLParser

        class StartTags(HTMLParser):
            def __init__(self):
                super().__init__(convert_charrefs=True)
                self.base, self.found = None, []

            def handle_starttag(self, tag, attrs):
                given = {}
                for name, value in attrs:
                    given.setdefault(name, value)
                if tag == "base" and self.base is None:
                    self.base = given.get("href")
                if tag in names:
                    self.found.append((tag, given.get("href"), given.get("onclick"), given.get("src")))

        for batch in batches:
            rows = []
            for page_id, url, text in zip(batch["page_id"], batch["url"], batch["html"]):
                parser = StartTags()
                parser.feed(text or "")
                parser.close()
                base = parser.base or url
                rows += [(page_id, url, base, pos, *row) for pos, row in enumerate(parser.found)]
            yield pd.DataFrame(
                rows, columns=["page_id", "url", "base_href", "pos", "tag", "href", "onclick", "src"]
            ).astype({"page_id": "int64", "pos": "int32"})

    rows = pages.select("page_id", "url", "html").mapInPandas(parse, TAGS)
    given = [F.nullif(name, F.lit("")).alias(name) for name in attributes]
    return rows.select("page_id", "url", "base_href", "pos", "tag", *given)


def start_tags(
    pages: DataFrame,
    names: tuple[str, ...],
    engine: str = "native",
    attributes: tuple[str, ...] = ("href", "onclick", "src"),
) -> DataFrame:
    """Start tags of the named kinds with some of their attributes, numbered in document order."""
    engines = {"native": _native_tags, "parser": _parser_tags}
    if engine not in engines:
        raise ValueError(f"engine must be one of {sorted(engines)}, not {engine!r}")
    return engines[engine](pages, names, attributes)


def base_hrefs(pages: DataFrame) -> DataFrame:
    """``(page_id, url, base_href)``: the base URL that a page names, else its own URL."""
    found = pages.select("page_id", "url", _base_tag(H.visible(F.col("html"))).alias("_base"))
    return found.select(
        "page_id", "url", F.coalesce(H.attribute(F.col("_base"), "href"), "url").alias("base_href")
    )


def _is_web(base: Column, link: Column, mode: str) -> Column:
    """Will the link be an http or https URL once it is resolved?"""
    web, relative = r"(?i)^\s*https?:", "^[/?]" if mode == "rooted" else r"^(?![A-Za-z][A-Za-z0-9+.-]*:|#)."
    return link.rlike(web) | (link.rlike(relative) & base.rlike(web))


def links(
    pages: DataFrame,
    *,
    engine: str = "native",
    base: str = "document",
    resolve: str = "rooted",
    scripts: bool = False,
    **canonical,
) -> DataFrame:
    """All links of the pages, duplicates kept: ``(page_id, pos, kind, raw, resolved, canonical_url)``.

    ``base`` chooses what relative links resolve on: the ``document``'s base URL
    or always the ``page``'s own. ``scripts`` adds the script redirects in the
    ``onclick`` texts of anchors and buttons, which are taken as they are.
    ``canonical`` goes to :func:`siteloom.functions.urls.canonical`. Rows that
    are no http or https URL after resolving are dropped.
    """
    if base not in ("document", "page"):
        raise ValueError(f"base must be 'document' or 'page', not {base!r}")
    on = "base_href" if base == "document" else "url"
    if scripts:
        tags = start_tags(pages, ("a", "button"), engine, ("href", "onclick"))
        # An anchor gives its link first, then its redirects; buttons only redirects.
        href = F.when(F.col("tag") == "a", F.col("href"))
        listed = F.concat(
            F.array(F.struct(F.lit("anchor").alias("kind"), href.alias("raw"))),
            F.transform(
                F.coalesce(H.redirects(F.col("onclick")), F.array().cast("array<string>")),
                lambda target: F.struct(F.lit("script").alias("kind"), target.alias("raw")),
            ),
        )
        found = tags.select("page_id", "pos", F.col(on).alias("_on"), F.inline(listed))
    else:
        tags = start_tags(pages, ("a",), engine, ("href",))
        found = tags.select(
            "page_id", "pos", F.col(on).alias("_on"), F.lit("anchor").alias("kind"), F.col("href").alias("raw")
        )
    web = F.when(F.col("kind") == "anchor", _is_web(F.col("_on"), F.col("raw"), resolve)).otherwise(
        _is_web(F.lit(""), F.col("raw"), resolve)
    )
    target = F.when(F.col("kind") == "anchor", urls.resolve("_on", "raw", resolve)).otherwise(F.col("raw"))
    resolved = found.where(web).select("page_id", "pos", "kind", "raw", target.alias("resolved"))
    return resolved.withColumn("canonical_url", urls.canonical("resolved", **canonical))


def images(pages: DataFrame, *, engine: str = "native", resolve: str = "rooted") -> DataFrame:
    """PNG and JPEG images of the pages with file name, type and place in the image store."""
    tags = start_tags(pages, ("img",), engine, ("src",))
    # Resolving does not change the extension, except that '?…' alone has that of the base.
    named = F.when(F.col("src").startswith("?"), F.col("base_href")).otherwise(F.col("src"))
    kept = tags.where(
        F.col("src").isNotNull() & ~F.col("src").startswith("#") & urls.extension(named).isin(*H.IMAGE_EXTENSIONS)
    )
    sources = kept.select("page_id", "url", "base_href", "pos", urls.resolve("base_href", "src", resolve).alias("src"))
    typed = sources.withColumn("content_type", urls.extension("src"))
    return typed.select(
        "page_id",
        F.col("url").alias("page_url"),
        "pos",
        "src",
        urls.file_name("src").alias("filename"),
        "content_type",
        urls.image_path("base_href", urls.file_name("src")).alias("path"),
    )


def allowed(links: DataFrame, domains: list[str], *, strict: bool = True, url: str = "canonical_url") -> DataFrame:
    """Links to the given domains.

    ``strict`` compares the host: equal to a domain or below it. Otherwise a
    link passes if its text contains a domain anywhere.
    """
    if not domains:
        raise ValueError("give at least one domain")
    host = F.lower(F.regexp_replace(urls.authority(url), r"^.*@|:\d*$", ""))

    def passes(domain: str) -> Column:
        if strict:
            return (host == domain) | host.endswith("." + domain)
        return F.contains(F.col(url), F.lit(domain))

    test = passes(domains[0])
    for domain in domains[1:]:
        test = test | passes(domain)
    return links.where(test)


def classify(responses: DataFrame) -> DataFrame:
    """Add ``page_type_code``, ``data_type_code`` and the content that is stored.

    Needs ``html, content_type, http_status_code, is_duplicate``. HTML pages
    with another status than the good ones and files of unknown type get a NULL
    class: they are not stored. Only HTML pages keep their content.
    """
    html = H.is_html("content_type")
    good = F.col("http_status_code").isin(*H.GOOD_STATUS)
    data_type = F.when(~html, H.document_type("content_type"))
    code = (
        F.when(html & good & F.col("is_duplicate"), "DUPLICATE")
        .when(html & good, "HTML")
        .when(data_type.isNotNull(), "BINARY")
    )
    coded = responses.withColumns({"page_type_code": code, "data_type_code": data_type})
    return coded.withColumn("html_content", F.when(F.col("page_type_code") == "HTML", F.col("html")))


def frontier_pages(links: DataFrame, pages: DataFrame, *, link: str = "canonical_url", url: str = "url") -> DataFrame:
    """``(url, page_type_code)``: linked URLs that no stored page has, as FRONTIER rows."""
    targets = links.select(F.col(link).alias("url")).distinct()
    known = pages.select(F.col(url).alias("url"))
    return targets.join(known, "url", "left_anti").withColumn("page_type_code", F.lit("FRONTIER"))
