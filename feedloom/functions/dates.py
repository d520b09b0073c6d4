"""Feed dates to instants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions import chain

# RFC-822 shapes behind the weekday: with or without seconds, short year, day only.
# A text is parsed by the one shape it has: a failing parse costs an exception.
_RFC822 = {
    r"^[0-9]{1,2} [A-Za-z]{3} [0-9]{4} [0-9]{1,2}:[0-9]{2}:[0-9]{2} ": "d MMM yyyy H:mm:ss Z",
    r"^[0-9]{1,2} [A-Za-z]{3} [0-9]{4} [0-9]{1,2}:[0-9]{2} ": "d MMM yyyy H:mm Z",
    r"^[0-9]{1,2} [A-Za-z]{3} [0-9]{2} [0-9]{1,2}:[0-9]{2}:[0-9]{2} ": "d MMM yy H:mm:ss Z",
    r"^[0-9]{1,2} [A-Za-z]{3} [0-9]{2} [0-9]{1,2}:[0-9]{2} ": "d MMM yy H:mm Z",
    r"^[0-9]{1,2} [A-Za-z]{3} [0-9]{4} [+-]": "d MMM yyyy Z",
}

# Zone names of RFC-822. They mean one offset all year, unlike
# the regions Java reads into them; any other name counts as UTC.
_ZONES = {
    "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500",
    "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
}
_ZONE = r"\s*([A-Za-z]+|[+-][0-9]{2}:?[0-9]{2})$"


# "Mon Jan  6 10:00:00 2025": the form of the C library, always UTC.
_C_TIME = r"^[A-Za-z]{3,9},? ([A-Za-z]{3})[a-z]* +([0-9]{1,2}) ([0-9:]{4,8}) ([0-9]{4})$"
_COMMENT = r"\s*\([^()]*\)$"
_LONG_MONTH = r"^([0-9]{1,2}) +([A-Za-z]{3})[A-Za-z]*\.? +"


def _offset(zone: Column) -> Column:
    named = F.create_map(*[F.lit(part) for pair in _ZONES.items() for part in pair])
    return F.when(zone.rlike("^[+-]"), F.replace(zone, F.lit(":"), F.lit(""))).otherwise(
        F.coalesce(F.try_element_at(named, F.upper(zone)), F.lit("+0000"))
    )


def _zoned(bare: Column) -> Column:
    offset = chain(F.regexp_extract(bare, _ZONE, 1), _offset)
    return F.concat(F.regexp_replace(bare, _ZONE, ""), F.lit(" "), offset)


def _rfc822(zoned: Column) -> Column:
    parsed = None
    for pattern, shape in _RFC822.items():
        moment = F.try_to_timestamp(zoned, F.lit(shape))
        parsed = F.when(zoned.rlike(pattern), moment) if parsed is None else parsed.when(zoned.rlike(pattern), moment)
    return parsed


def _parsed(given: Column) -> Column:
    in_order = F.regexp_replace(F.regexp_replace(given, _COMMENT, ""), _C_TIME, "$2 $1 $4 $3 +0000")
    without_weekday = F.regexp_replace(in_order, r"^[A-Za-z]{3,9},\s*", "")
    short = F.regexp_replace(without_weekday, _LONG_MONTH, "$1 $2 ")
    return (
        F.when(given.rlike(r"^[0-9]{4}(?:-|$)"), F.try_to_timestamp(given))
        .when(given.rlike(r"^[0-9]{8}$"), F.try_to_timestamp(given, F.lit("yyyyMMdd")))
        .otherwise(chain(short, _zoned, _rfc822))
    )


def parse_pubdate(value: Column) -> Column:
    """RFC-822 or ISO-8601 text to a UTC instant; NULL when it is neither."""
    return chain(F.trim(value), _parsed)
