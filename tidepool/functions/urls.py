"""URL parts, reference resolution, crawl filters and query strings as Column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidepool.config import CRAWL_EXTENSIONS
from tidepool.functions.text import without_hidden

# The parts of a URI as RFC 3986, appendix B, separates them.
_PARTS = {
    "scheme": r"^([^:/?#]+):",
    "authority": r"^(?:[^:/?#]+:)?//([^/?#]*)",
    "path": r"^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)",
    "query": r"^[^?#]*\?([^#]*)",
    "fragment": r"#(.*)",
}
HREF = r"""(?is)<a\s(?:[^>]*?[\s"'/])?href\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""
BASE = HREF.replace("<a", "<base")
_HREF_VALUE = r"""(?is)[\s"'/]href\s*=\s*["']?(.*?)["']?$"""


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def url_part(url: Column | str, part: str) -> Column:
    """scheme, authority, path, query or fragment; '' where the URL has none."""
    return F.regexp_extract(_col(url), _PARTS[part], 1)


def host(url: Column | str) -> Column:
    """Lower-case host without user info and port."""
    authority = F.lower(url_part(url, "authority"))
    return F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":\d*$", "")


def _href_value(tag: Column) -> Column:
    return F.trim(F.replace(F.regexp_extract(tag, _HREF_VALUE, 1), F.lit("&amp;"), F.lit("&")))


def hrefs(html: Column | str) -> Column:
    """The href values of all anchors, in order, duplicates kept.  Comments, scripts and style
    sheets hold no anchors."""
    shown = without_hidden(_col(html))
    return F.transform(F.regexp_extract_all(shown, F.lit(HREF), F.lit(0)), _href_value)


def document_base(url: Column | str, html: Column | str) -> Column:
    """What references of a page are relative to: its first ``base`` element, or its own URL."""
    html, url = _col(html), _col(url)
    tag = F.regexp_extract(without_hidden(html), BASE, 0)
    base = resolve_url(url, _href_value(tag))
    return F.when(html.rlike(r"(?i)<base\s"), F.when(tag != "", base).otherwise(url)).otherwise(url)


def fetchable(url: Column | str) -> Column:
    """An absolute URL that a crawler can ask for."""
    return _col(url).rlike(r"(?i)^https?://[^/?#]")


def remove_dot_segments(path: Column) -> Column:
    """Fold ``.`` and ``..`` of an absolute path."""
    segments = F.slice(F.split(path, "/"), 2, 1 << 30)
    last = F.element_at(segments, -1)

    def step(done: Column, segment: Column) -> Column:
        shorter = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return (F.when(segment == ".", done).when(segment == "..", shorter)
                .otherwise(F.array_append(done, segment)))

    folded = F.aggregate(segments, F.array().cast("array<string>"), step)
    closed = F.when(last.isin(".", ".."), F.array_append(folded, F.lit(""))).otherwise(folded)
    whole = F.concat(F.lit("/"), F.array_join(closed, "/"))
    return F.when(path.contains("/."), whole).otherwise(path)


def base_parts(base: Column | str) -> Column:
    """What resolving needs of a page's URL; null when the URL is not absolute."""
    base = _col(base)
    scheme, authority, path = (url_part(base, p) for p in ("scheme", "authority", "path"))
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, r"[^/]*$", ""))
    parts = F.struct(
        scheme.alias("scheme"), F.concat(scheme, F.lit("://"), authority).alias("root"),
        path.alias("path"), folder.alias("folder"),
        F.regexp_extract(base, r"^[^#?]*(\?[^#]*)", 1).alias("query"))
    return F.when((scheme != "") & (authority != ""), parts)


def resolve_ref(parts: Column, ref: Column) -> Column:
    """Absolute form of ``ref``; the common root-relative reference needs no pattern at all."""
    path = F.substring_index(F.substring_index(ref, "#", 1), "?", 1)
    rest = F.regexp_extract(ref, r"^[^?#]*(.*)$", 1)
    joined = F.when(path.startswith("/"), path).otherwise(F.concat(parts["folder"], path))
    return (
        F.when(ref.startswith("//"), F.concat(parts["scheme"], F.lit(":"), ref))
        .when(ref.startswith("/") & ~ref.contains("/."), F.concat(parts["root"], ref))
        .when(ref.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), ref)
        .when(ref == "", F.concat(parts["root"], parts["path"], parts["query"]))
        .when(ref.startswith("?"), F.concat(parts["root"], parts["path"], ref))
        .when(ref.startswith("#"), F.concat(parts["root"], parts["path"], parts["query"], ref))
        .otherwise(F.concat(parts["root"], remove_dot_segments(joined), rest)))


def resolve_url(base: Column | str, ref: Column | str) -> Column:
    """Absolute form of ``ref`` found on page ``base``; null when the base is not absolute."""
    parts = base_parts(base)
    return F.when(parts.isNotNull(), resolve_ref(parts, _col(ref)))


def acceptable_path(url: Column | str, extensions: Sequence[str] = CRAWL_EXTENSIONS) -> Column:
    """No fragment, and the text after the last dot behind the last slash is a listed extension."""
    url = _col(url)
    extension = F.regexp_extract(url, r"\.([^./\\]*)$", 1)
    return ~url.contains("#") & extension.isin(list(extensions))


def in_scope(url: Column | str, roots: Sequence[str], mode: str = "contains") -> Column:
    """``contains``: some root is part of the URL.  ``host``: the host is a root or below one."""
    out = F.lit(False)
    for root in roots:
        if mode == "contains":
            out = out | _col(url).contains(root)
        elif mode == "host":
            out = out | _col(url).rlike(
                rf"(?i)^[^:/?#]+://(?:[^/?#]*@)?(?:[^/?#@]*\.)?{re.escape(root)}(?::\d*)?(?:[/?#]|$)")
        else:
            raise ValueError(f"unknown scope mode {mode}")
    return out


def query_pairs(url: Column | str) -> Column:
    """Decoded (key, value) pairs of the query string, in order; a missing ``=`` gives ''."""
    parts = F.filter(F.split(url_part(url, "query"), "&"), lambda p: p != "")

    def pair(part: Column) -> Column:
        cut = F.instr(part, "=")
        key = F.when(cut > 0, F.substr(part, F.lit(1), cut - 1)).otherwise(part)
        value = F.when(cut > 0, F.substr(part, cut + 1)).otherwise(F.lit(""))
        return F.struct(F.try_url_decode(key).alias("key"), F.try_url_decode(value).alias("value"))

    return F.transform(parts, pair)


def query_map(url: Column | str) -> Column:
    """map<key, array<value>>, a repeated key keeping all its values in order."""
    pairs = query_pairs(url)
    keys = F.array_distinct(F.transform(pairs, lambda p: p["key"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.transform(
        F.filter(pairs, lambda p: p["key"] == k), lambda p: p["value"])))
