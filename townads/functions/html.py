"""Attribute and text lookup in stored pages, as regular expressions that stay in the JVM.

Covers start tags with double-quoted, single-quoted or bare attribute values. Comments, scripts
and styles are skipped. Text is what stands between a start tag and the next tag.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
# The names of characters that occur in addresses and class names.
_NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0"}
# Possessive throughout: a tag that never closes must not backtrack over the rest of the page.
_ATTRIBUTE = r"""[^\s"'<>/=]++\s*+=\s*+(?:"[^"]*"|'[^']*'|[^\s"'>]++)"""
_INSIDE_TAG = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""


def visible(html: Column) -> Column:
    return F.regexp_replace(html, _HIDDEN, "")


def start_tags(html: Column, names: str) -> Column:
    """All start tags whose name matches ``names`` (``a``, ``a|area``), in page order."""
    return F.regexp_extract_all(html, F.lit(rf"(?i)<(?:{names})\s{_INSIDE_TAG}>"), 0)


def _values(tag: Column, name: str) -> Column:
    """Values of one attribute of a tag, in quotes if they were written so. The attributes are taken one
    after the other, so what looks like one inside another's value is none."""
    every = F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), 0)
    own = F.filter(every, lambda a: a.rlike(rf"(?i)^{name}\s*="))
    return F.transform(own, lambda a: F.regexp_replace(a, r"^[^=]*=\s*", ""))


def attributes(tags: Column, name: str) -> Column:
    """Values of one attribute on those of ``tags`` that carry it."""
    first = F.transform(tags, lambda t: F.get(_values(t, name), F.lit(0)))
    return F.transform(F.filter(first, lambda v: v.isNotNull()), _unquoted)


def _unquoted(value: Column) -> Column:
    bare = F.regexp_replace(value, r"""(?s)^(["'])(.*)\1$""", "$2")
    return F.when(bare.contains("&"), decoded(bare)).otherwise(bare)


def decoded(text: Column) -> Column:
    """Text with its character references, by number or by one of the names in ``_NAMED``, as characters.
    What is no reference, or names no character, stays as it is."""
    names = F.create_map(*(F.lit(x) for pair in _NAMED.items() for x in pair))

    def piece(part: Column, place: Column) -> Column:
        named = F.try_element_at(names, F.regexp_extract(part, r"^([A-Za-z]+);", 1))
        digits = F.regexp_extract(part, r"^#(?:[xX]([0-9A-Fa-f]{1,6})|[0-9]{1,7});", 1)
        number = F.regexp_extract(part, r"^#([0-9]{1,7});", 1)
        code = F.when(digits != "", F.conv(digits, 16, 10)).otherwise(number).try_cast("long")
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        # A code point is its own four bytes of UTF-32.
        numbered = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        char = F.coalesce(numbered, named)
        rest = F.regexp_replace(part, r"^[^;]*;", "")
        return F.when(place == 0, part).when(char.isNotNull(), F.concat(char, rest)).otherwise(F.concat(F.lit("&"), part))

    return F.array_join(F.transform(F.split(text, "&"), piece), "")


def has_class(tag: Column, token: str) -> Column:
    return F.exists(_values(tag, "class"), lambda v: F.array_contains(F.split(_unquoted(v), r"\s+"), token))


def first_attribute(html: Column, tag: str, token: str, name: str) -> Column:
    """Value of ``name`` on the first ``tag`` of class ``token`` that carries the attribute."""
    tags = F.filter(start_tags(html, tag), lambda t: has_class(t, token))
    return F.get(attributes(tags, name), F.lit(0))


def first_text(html: Column, tag: str, token: str) -> Column:
    """Text right after the first start tag of class ``token`` that is followed by text."""
    start = rf"(?i)<{tag}\s{_INSIDE_TAG}>"
    pieces = F.regexp_extract_all(html, F.lit(start + "[^<]+"), 0)
    matching = F.filter(pieces, lambda p: has_class(F.regexp_extract(p, start, 0), token))
    return F.regexp_replace(F.get(matching, F.lit(0)), start, "")


def base(html: Column) -> Column:
    """The address that a page wants its relative links to start from, as written; NULL without one."""
    return F.get(attributes(start_tags(html, "base"), "href"), F.lit(0))


def links(html: Column) -> Column:
    """Distinct link targets of a page as written, surrounding blanks removed."""
    targets = attributes(start_tags(html, "a|area"), "href")
    return F.array_distinct(F.transform(targets, lambda v: F.regexp_replace(v, r"^\s+|\s+$", "")))
