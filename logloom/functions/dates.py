"""Column functions for dates and timestamps; a bad value gives null, not an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: month names (en is what the parser reads) ---
MONTHS = {
    "en": "january february march april may june july august september october november december",
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "de": "januar februar märz april mai juni juli august september oktober november dezember",
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
    "it": "gennaio febbraio marzo aprile maggio giugno luglio agosto settembre ottobre novembre dicembre",
    "pt": "janeiro fevereiro março abril maio junho julho agosto setembro outubro novembro dezembro",
    "nl": "januari februari maart april mei juni juli augustus september oktober november december",
}


def parse_timestamp(text: Column, fmt: str = "yyyy-MM-dd'T'HH:mm:ss") -> Column:
    return F.try_to_timestamp(text, F.lit(fmt))


def day_and_hour(ts: Column) -> tuple[Column, Column]:
    """(ISO date, hour) of a timestamp; ("", -1) where there is none."""
    day = F.coalesce(F.date_format(ts, "yyyy-MM-dd"), F.lit(""))
    return day, F.coalesce(F.hour(ts), F.lit(-1))


def _month_number(name: Column) -> Column:
    table = {}
    for names in MONTHS.values():
        for number, month in enumerate(names.split(), start=1):
            table[month] = number
    cells = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*cells), name)


def parse_post_date(text: Column) -> Column:
    """A ``day,month name,year`` date in one of several languages, else null."""
    low = F.lower(F.trim(text))
    day = F.regexp_extract(low, r"^(\d{1,2})\W", 1)
    month = _month_number(F.regexp_extract(low, r"(\p{L}{3,})", 1))
    year = F.regexp_extract(low, r"(\d{4})$", 1)
    built = F.concat_ws("-", year, month.cast("string"), day)
    named = F.when(month.isNotNull(), F.try_to_timestamp(built, F.lit("yyyy-M-d")))
    iso = F.try_to_timestamp(low, F.lit("yyyy-MM-dd"))
    return F.coalesce(named, iso).cast("date")


def iso_or_empty(date: Column) -> Column:
    return F.coalesce(F.date_format(date, "yyyy-MM-dd"), F.lit(""))


def parse_alert_date(text: Column) -> Column:
    """``18-JUN-2014`` (any letter case) to a date, null when unreadable."""
    return F.try_to_timestamp(F.initcap(F.lower(text)), F.lit("d-MMM-yyyy")).cast("date")


def alert_label(date: Column) -> Column:
    return F.date_format(date, "dd MMM yyyy")


def parse_log_time(text: Column) -> Column:
    """``[07/Feb/2014:17:59:07 +0000]`` to a timestamp, null when unreadable."""
    return F.try_to_timestamp(text, F.lit("'['dd/MMM/yyyy:HH:mm:ss Z']'"))
