"""Column functions for web-server logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the combined log format, one blank between fields ---
FIELDS = {
    "ip": r"(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})?",
    "client": r"(\S+)",
    "user": r"(\S+)",
    "time": r"(\[.+?\])",
    "request": r'"(.*?)"',
    "status": r"(\d{3})",
    "bytes": r"(\S+)",
    "referer": r'"(.*?)"',
    "agent": r'"(.*?)"',
}
SESSION_FIELD = r"(\S+)"
# --- fixed values: slash-led path segments; assets that are not pages ---
REQUEST_URI = r".*?((?:/[\w.\-]+)+)"
ASSET_SUFFIXES = (".jpg", ".json", ".js", ".css")


def line_pattern(session: bool = False) -> str:
    parts = list(FIELDS.values()) + ([SESSION_FIELD] if session else [])
    return " ".join(parts)


def request_uri(request: Column, strict: bool = False) -> Column:
    """The path of a request line, without the query string.

    The default keeps the established pattern, under which the root path is not
    seen and ``GET / HTTP/1.1`` yields ``/1.1``; ``strict`` takes the second
    token of the request line instead.
    """
    if not strict:
        return F.regexp_extract(request, REQUEST_URI, 1)
    target = F.coalesce(F.get(F.split(request, " ", -1), F.lit(1)), F.lit(""))
    return F.substring_index(target, "?", 1)


def is_page(uri: Column, suffixes: Sequence[str] = ASSET_SUFFIXES) -> Column:
    """True unless the path ends with an asset suffix (case-sensitive)."""
    page = F.lit(True)
    for suffix in suffixes:
        page = page & ~uri.endswith(suffix)
    return page


def visitor_key(ip: Column, agent: Column, parity: bool = False) -> Column:
    """``ip_agent``; ``parity`` spells a missing address as the word null."""
    address = F.coalesce(ip, F.lit("null" if parity else ""))
    return F.concat(address, F.lit("_"), agent)


def session_value(raw: Column) -> Column:
    """A session cell without its quotes; ``-`` means none."""
    bare = F.regexp_replace(raw, '^"|"$', "")
    return F.when((bare != "-") & (bare != ""), bare)


def cookie_pair(name: Column, value: Column) -> Column:
    return F.coalesce(F.concat(name, F.lit("="), value), F.lit("-"))


def cookie_names(cookies: Column) -> Column:
    """Names of a cookie map joined by ``;``, or ``-`` without cookies."""
    names = F.concat_ws(";", F.map_keys(cookies))
    return F.when(F.coalesce(F.size(cookies), F.lit(0)) > 0, names).otherwise("-")
