"""URL predicates and parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_AD_MARK = "/ad/"
# Endings of files that are no pages.
_NO_PAGES = (
    "7z", "avi", "bmp", "css", "doc", "docx", "exe", "gif", "gz", "ico", "iso", "jpeg", "jpg", "js", "m4a", "mov", "mp3",
    "mp4", "ogg", "pdf", "png", "ppt", "pptx", "rar", "svg", "tar", "tif", "tiff", "wav", "webm", "webp", "xls", "xlsx", "zip",
)
_ORIGIN = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def is_ad_url(url: Column) -> Column:
    return url.contains(_AD_MARK)


def ad_id_from_url(url: Column) -> Column:
    """Text after the last ad marker; the whole URL when there is none."""
    return F.substring_index(url, _AD_MARK, -1)


def city_from_link(link: Column) -> Column:
    """Last path segment of a city link; empty for a trailing slash, NULL for NULL."""
    return F.substring_index(link, "/", -1)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _HOST, 1))


def in_domain(url: Column, domain: str) -> Column:
    """TRUE for the domain itself and its sub-domains."""
    name = host(url)
    return (name == domain) | name.endswith("." + domain)


def page_parts(page_url: Column) -> list[Column]:
    """What the links on a page are put together from: ``origin``, ``path`` and ``whole``, for ``resolved``."""
    return [
        F.regexp_extract(page_url, _ORIGIN, 1).alias("origin"),
        F.regexp_replace(page_url, r"[?#].*$", "").alias("path"),
        F.regexp_replace(page_url, r"#.*$", "").alias("whole"),
    ]


def resolved(link: Column, origin: Column, path: Column, whole: Column) -> Column:
    """A link as written on a page of these parts, made absolute. Dot segments are left as they are."""
    folder = F.when(path == origin, F.concat(origin, F.lit("/"))).otherwise(
        F.regexp_replace(path, r"[^/]*$", "")
    )
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(F.substring_index(whole, "//", 1), link))
        .when(link.startswith("/"), F.concat(origin, link))
        .when(link.startswith("?"), F.concat(path, link))
        .when((link == "") | link.startswith("#"), F.concat(whole, link))
        .otherwise(F.concat(folder, link))
    )


def absolute(link: Column, page_url: Column) -> Column:
    """``resolved`` for a single link of a page."""
    return resolved(link, *page_parts(page_url))


def is_fetchable(url: Column) -> Column:
    return url.rlike(r"^(?i)https?://")


def is_page(url: Column) -> Column:
    """FALSE for files that hold no markup, by the ending of the path."""
    path = F.regexp_extract(url, r"^[^?#]*", 0)
    return ~path.rlike(rf"(?i)://[^/]+/.*[.](?:{'|'.join(_NO_PAGES)})$")


def _without_dots(path: Column) -> Column:
    """A path with its ``.`` and ``..`` segments resolved; at least ``/``."""

    def step(done: Column, part: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1)))
        return F.when(part == ".", done).when(part == "..", up).otherwise(F.concat(done, F.array(part)))

    parts = F.split(F.regexp_replace(path, r"/[.]{1,2}$", "$0/"), "/")
    joined = F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/")
    return F.when(joined == "", F.lit("/")).otherwise(joined)


def key_parts(url: Column) -> list[Column]:
    """What ``joined_key`` is put together from: ``bare``, ``query``, ``origin`` and ``path`` of an address."""
    bare = F.regexp_replace(url, r"#.*$", "")
    return [
        bare.alias("bare"),
        F.regexp_extract(bare, r"\?(.*)$", 1).alias("query"),
        F.lower(F.regexp_extract(bare, _ORIGIN, 1)).alias("origin"),
        F.regexp_extract(bare, r"^[^:]*://[^/?]*([^?]*)", 1).alias("path"),
    ]


def joined_key(bare: Column, query: Column, origin: Column, path: Column) -> Column:
    ordered = F.array_join(F.array_sort(F.split(query, "&")), "&")
    site = F.regexp_replace(origin, r"^(http://.*):80$|^(https://.*):443$", "$1$2")
    page = F.when(origin == "", F.regexp_replace(bare, r"\?.*$", "")).otherwise(F.concat(site, _without_dots(path)))
    return F.when(query == "", page).otherwise(F.concat(page, F.lit("?"), ordered))


def request_key(url: Column) -> Column:
    """One spelling of all URLs that ask for the same page: scheme and host in lower case, no default port
    and no fragment, dot segments resolved, query arguments sorted."""
    return joined_key(*key_parts(url))
