"""Column helpers for times. All times are UTC in TIMESTAMP_NTZ columns."""

from pyspark.sql import Column, functions as F

# Month names and zone names of mail dates, in minutes east of UTC.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
ZONES = {
    "ut": 0, "utc": 0, "gmt": 0, "z": 0,
    "ast": -240, "adt": -180, "est": -300, "edt": -240,
    "cst": -360, "cdt": -300, "mst": -420, "mdt": -360,
    "pst": -480, "pdt": -420,
}

# The two date forms, each after an optional weekday.
#   feed: Sep 27 19:32:11 +0000 2025      mail: 27 Sep 2025 19:32:11 +0000
_WEEKDAY = r"(?:[A-Za-z]+,\s*|(?:mon|tue|wed|thu|fri|sat|sun)\s+)?"
_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2}))?"
_ZONE = r"([+-]\d{4}|[A-Za-z]+)?"
FEED_FORM = rf"(?i)^\s*{_WEEKDAY}([A-Za-z]{{3}})[A-Za-z]*\s+(\d{{1,2}})\s+{_CLOCK}\s*{_ZONE}\s*(\d{{4}})\s*$"
MAIL_FORM = rf"(?i)^\s*{_WEEKDAY}(\d{{1,2}})\s+([A-Za-z]{{3}})[A-Za-z]*\s+(\d{{4}})\s+{_CLOCK}\s*{_ZONE}\s*$"

# Both forms are brought into this order: year, month, day, hour, minute, second, zone.
_FEED_ORDER = "$7|$1|$2|$3|$4|$5|$6"
_MAIL_ORDER = "$3|$2|$1|$4|$5|$6|$7"


def _offset_minutes(zone: Column) -> Column:
    digits = F.substring(zone, 2, 4).try_cast("int")
    east = F.floor(digits / 100) * 60 + digits % 100
    signed = F.when(zone.startswith("-"), -east).otherwise(east)
    named = F.create_map(*[F.lit(x) for pair in ZONES.items() for x in pair])
    return F.coalesce(signed, F.try_element_at(named, zone), F.lit(0)).cast("int")


def parse_post_time(text: Column) -> Column:
    """Feed or mail date to UTC; a date without a zone is UTC; unreadable text gives null."""
    in_order = F.regexp_replace(F.regexp_replace(text, FEED_FORM, _FEED_ORDER), MAIL_FORM, _MAIL_ORDER)
    parts = F.split(F.lower(in_order), r"\|")

    def number(i):
        return F.get(parts, i).try_cast("int")

    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.get(parts, 1)).cast("int")
    second = F.coalesce(number(5), F.lit(0)).cast("decimal(16,6)")
    local = F.try_make_timestamp_ntz(number(0), month, number(2), number(3), number(4), second)
    return local - F.make_dt_interval(F.lit(0), F.lit(0), _offset_minutes(F.get(parts, 6)))


def _text(time: Column) -> Column:
    """The wall-clock text; unlike date_format, a cast does not pass through a time zone."""
    return F.translate(time.cast("string"), " ", "T")


def time_text(time: Column) -> Column:
    """ISO-8601 text with the UTC offset; a missing time is the empty text."""
    text = _text(time)
    fraction = F.when(F.length(text) > 19, F.concat(F.lit("."), F.rpad(F.substring(text, 21, 6), 6, "0")))
    whole = F.substring(text, 1, 19)
    return F.coalesce(F.concat(whole, F.coalesce(fraction, F.lit("")), F.lit("+00:00")), F.lit(""))


def day_text(time: Column) -> Column:
    return F.coalesce(F.substring(_text(time), 1, 10), F.lit(""))


def minute_text(time: Column) -> Column:
    return F.coalesce(F.substring(_text(time), 1, 16), F.lit(""))


def month_text(time: Column) -> Column:
    return F.coalesce(F.substring(_text(time), 1, 7), F.lit(""))
