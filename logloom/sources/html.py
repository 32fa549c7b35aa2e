"""Fields and links out of fetched pages, by built-in regular expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.plans.rows import elements, numbered_elements

#: An anchor with its address in double, single or no quotes (groups 1 to 3) and its label.
LINK_PATTERN = r"""(?is)<a\s[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))[^>]*>(.*?)</a>"""
#: Character references that occur in addresses; the ampersand last.
REFERENCES = {"&quot;": '"', "&#39;": "'", "&lt;": "<", "&gt;": ">", "&amp;": "&"}


def strip_tags(html: Column) -> Column:
    return F.trim(F.regexp_replace(html, r"(?s)<[^>]*>", ""))


def absolute_url(prefix: Column, href: Column) -> Column:
    """A host prefix is put before site-relative links only."""
    return F.when(href.startswith("/"), F.concat(prefix, href)).otherwise(href)


def extract_links(
    pages: DataFrame, html: str = "html", prefix: Column | None = None
) -> DataFrame:
    """One row per anchor: other columns, ``link_no``, ``href``, ``label``."""
    anchors = F.regexp_extract_all(F.col(html), F.lit(LINK_PATTERN), F.lit(0))
    keep = [c for c in pages.columns if c != html]
    rows = numbered_elements(pages, keep, anchors, "link_no", "_anchor")
    href = F.concat(*[F.regexp_extract("_anchor", LINK_PATTERN, i) for i in (1, 2, 3)])
    for reference, character in REFERENCES.items():
        href = F.replace(href, F.lit(reference), F.lit(character))
    return rows.select(
        *keep,
        "link_no",
        (absolute_url(prefix, href) if prefix is not None else href).alias("href"),
        strip_tags(F.regexp_extract("_anchor", LINK_PATTERN, 4)).alias("label"),
    )


def extract_fields(pages: DataFrame, rules: dict[str, str], html: str = "html") -> DataFrame:
    """One column per rule: the tag-free first group of its first match, else null."""
    columns = {}
    for name, pattern in rules.items():
        found = F.col(html).rlike(pattern)
        columns[name] = F.when(found, strip_tags(F.regexp_extract(html, pattern, 1)))
    return pages.withColumns(columns)


def after_colon(label: str) -> str:
    """Rule for a paragraph holding ``label: value``; takes the value."""
    return rf"(?is)<p[^>]*>[^<]*\Q{label}\E: ([^<:]*)"


# --- fixed values: what is read from a photo page ---
PHOTO_RULES = {
    "ImageURL": r'(?is)<img\b(?=[^>]*\bclass="main-image")[^>]*?\bsrc="([^"]*)"',
    "AircraftModel": after_colon("Aircraft"),
    "Airline": after_colon("Airline"),
    "Photographer": r'(?is)<section class="additional-info photographer".*?<p[^>]*>(.*?)</p>',
}
# --- fixed values: what is read from one alert of a list page ---
ALERT_RULES = {
    "Date": r"(?is)<a[^>]*>(.*?)</a>",
    "URL": r'(?is)<a[^>]*?href="([^"]*)"',
    "Headline": r"(?is)<span[^>]*>(.*?)</span>",
}


def extract_photo_fields(pages: DataFrame, url: str = "url") -> DataFrame:
    fields = extract_fields(pages, PHOTO_RULES)
    return fields.select(
        "Airline",
        F.col(url).alias("PageURL"),
        "ImageURL",
        "AircraftModel",
        F.lit("").alias("Size"),
        F.lit("No").alias("Permission"),
        "Photographer",
    )


def extract_alerts(pages: DataFrame, prefix: str, html: str = "html") -> DataFrame:
    """Date, URL, Headline of every list item that holds a link."""
    items = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<li\b[^>]*>(.*?)</li>"), F.lit(1))
    rows = elements(pages, [], items, "html").where(F.col("html").rlike("(?i)<a[^>]*href="))
    fields = extract_fields(rows, ALERT_RULES)
    return fields.select("Date", F.concat(F.lit(prefix), "URL").alias("URL"), "Headline")
