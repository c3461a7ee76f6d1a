"""Patterns and Column helpers for HTML texts."""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three script redirects; group 2 is the target.
REDIRECTS = (
    r"window.location(\.href|\.assign)?\s*=\s*'(.+)'",
    r"(self|top)\.location\s*=\s*'(.+)'",
    r"window.location(\.assign|\.replace)\('(.+)'",
)

# MIME types of the documents that are kept.
DOCUMENT_TYPES = {
    "application/vnd.openxmlformats-officedocument.presentationml.presentation": "PPTX",
    "application/pdf": "PDF",
    "application/msword": "DOC",
    "application/vnd.ms-powerpoint": "PPT",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": "DOCX",
}

# Frequent entities, image extensions and good response codes.
COMMON = ("amp", "lt", "gt", "quot", "apos", "nbsp")
IMAGE_EXTENSIONS = ("png", "jpeg", "jpg")
GOOD_STATUS = (200, 203, 302)

# What has no end runs to the end of the text; so no pattern looks at a text's rest more than once.
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b[^>]*+>.*?(?:</\1\s*+>|\z)"
QUOTED = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
OPEN_QUOTE = r"""(?:[^>"']++|"[^"]*+(?:"|\z)|'[^']*+(?:'|\z))*+\z"""
ATTRIBUTE = r"""\s++[^\s=>"'/]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"']++))?+"""


def visible(html: Column) -> Column:
    """HTML without comments and without the bodies of scripts and styles."""
    return F.regexp_replace(html, HIDDEN, "")


def tags(html: Column, names: tuple[str, ...]) -> Column:
    """The start tags with one of the names, in document order.

    A tag with an open quote takes the rest of the text, and is none.
    """
    start = rf"<(?:{'|'.join(names)})"
    pattern = rf"(?i)({start}(?:[\s/]{QUOTED})?>)|{start}[\s/]{OPEN_QUOTE}"
    found = F.regexp_extract_all(html, F.lit(pattern), F.lit(1))
    return F.filter(found, lambda tag: tag != "")


def tag_name(tag: Column) -> Column:
    return F.lower(F.regexp_extract(tag, r"^<([A-Za-z]+)", 1))


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a start tag: quoted or bare, entities decoded; NULL if absent or empty."""
    named = F.filter(
        F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(0)), lambda a: a.rlike(rf"(?i)^\s+{name}\s*=")
    )
    pattern = rf"""(?i)^\s+{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""

    def value(first: Column) -> Column:
        return F.coalesce(F.concat(*[F.regexp_extract(first, pattern, k) for k in (1, 2, 3)]), F.lit(""))

    decoded = _once(_once(F.try_element_at(named, F.lit(1)), value), decode_entities)
    return _once(decoded, lambda text: F.when(text != "", text))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, where the value is worked out once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _letter(number: Column) -> Column:
    """The character of a code point; U+FFFD for numbers that are none."""
    valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    code = F.lpad(F.hex(F.when(valid, number).otherwise(0xFFFD)), 8, "0")
    return F.decode(F.unhex(code), "UTF-32")


def decode_entities(text: Column) -> Column:
    """Decode numeric entities and the named ones of HTML 5 that end in a semicolon, each once.

    The text is cut at ``&``; a part that starts with an entity gets its letters in place of it.
    """
    names = {name[:-1]: letters for name, letters in html5.items() if name.endswith(";")}
    table = F.from_json(F.lit(json.dumps(names)), "map<string,string>")

    def letters(entity: Column) -> Column:
        decimal = F.coalesce(F.regexp_extract(entity, r"^#([0-9]+)$", 1).try_cast("long"), F.lit(0))
        digits = F.regexp_extract(entity, r"^#[xX]0*([0-9A-Fa-f]{1,8})$", 1)
        hexadecimal = F.coalesce(F.conv(F.nullif(digits, F.lit("")), 16, 10).try_cast("long"), F.lit(0))
        found = F.when(entity.rlike("^#[0-9]"), _letter(decimal)).when(entity.rlike("^#"), _letter(hexadecimal))
        for name in COMMON:  # the table is searched entry by entry
            found = found.when(entity == name, F.lit(names[name]))
        return found.otherwise(F.try_element_at(table, entity))

    def decoded(part: Column) -> Column:
        def replaced(entity: Column) -> Column:
            rest = F.substr(part, F.length(entity) + 2)
            # NULL joins no texts, so an unknown name leaves the part as it was.
            return F.when(entity != "", F.concat(letters(entity), rest))

        entity = F.regexp_extract(part, r"^(#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);", 1)
        return F.coalesce(_once(entity, replaced), F.concat(F.lit("&"), part))

    def joined(parts: Column) -> Column:
        return F.concat(F.element_at(parts, 1), F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), decoded), ""))

    return F.when(F.contains(text, F.lit("&")), _once(F.split(text, "&"), joined)).otherwise(text)


def redirects(onclick: Column) -> Column:
    """Targets of the script redirects in an ``onclick`` text."""
    # (?d): only a line feed ends a line for '.', as in the stored patterns' home dialect.
    found = [F.regexp_extract_all(onclick, F.lit("(?d)" + pattern), F.lit(2)) for pattern in REDIRECTS]
    return F.concat(*found)


def document_type(content_type: Column | str) -> Column:
    """PDF, DOC, DOCX, PPT or PPTX for an exactly matching MIME type, else NULL."""
    content_type = F.col(content_type) if isinstance(content_type, str) else content_type
    pairs = [F.lit(text) for pair in DOCUMENT_TYPES.items() for text in pair]
    return F.create_map(*pairs)[content_type]


def is_html(content_type: Column | str) -> Column:
    """True for ``text/html`` with any suffix; a missing type counts as HTML."""
    content_type = F.col(content_type) if isinstance(content_type, str) else content_type
    return F.coalesce(F.contains(content_type, F.lit("text/html")), F.lit(True))
