"""Date and time expressions.  Parsing never raises: bad text becomes null."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import extract, strip_marks, trim_blanks

# --- fixed values -----------------------------------------------------------
WEEKDAYS = ["LUNES", "MARTES", "MIERCOLES", "JUEVES", "VIERNES", "SABADO", "DOMINGO"]
MONTHS = {
    "ENERO": 1, "FEBRERO": 2, "MARZO": 3, "ABRIL": 4, "MAYO": 5, "JUNIO": 6, "JULIO": 7,
    "AGOSTO": 8, "SEPTIEMBRE": 9, "SETIEMBRE": 9, "OCTUBRE": 10, "NOVIEMBRE": 11, "DICIEMBRE": 12, "JUNIA": 6,
}
TIMESTAMP_NOISE = r"\b(EN CLINICA|EN CLÍNICA|NPO|STRING|null)\b"
LOCAL_ZONE = "America/Lima"
READING_FORMAT = "dd/MM/yyyyHH:mm:"
# --- end of fixed values ----------------------------------------------------


# Written dates as day, month and year: in words, with slashes, or ISO; a weekday before and a clock after are skipped.
_OF = r"(?:\s*\.DE\s*|\s+(?:DEL?\s+)?)"
_WRITTEN_DATE = (rf"(?s)^\s*(?:(?:{'|'.join(WEEKDAYS)}),\s*)?"
                 rf"(?:(\d{{1,2}}){_OF}([A-Z]+){_OF}(\d{{4}})|(\d{{1,2}})/(\d{{1,2}})/(\d{{4}}|\d{{2}})|(\d{{4}})-(\d{{2}})-(\d{{2}}))"
                 r"\s*[.:]?(?:\s*,?\s*\d{1,2}:\d{2}.*)?\s*$")
# Day, month, year and clock of a sheet's time: with slashes or dashes, or in one run of digits.
_SHEET_TIME = (r"^\s*(?:(\d{1,2})[-/](\d{1,2})[-/](\d{4}|\d{2})(?:[.\s]\s*(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?)?"
               r"|(\d{2})(\d{2})(\d{4})[.\s]?\s*(\d{2})\s+(\d{2})\s+(\d{2}))\s*$")


_FOUND = "\u0001"


def _with_fields(text: Column, pattern: str, groups: list[str], body: Callable[..., Column]) -> Column:
    """``body`` of the named groups of a text that has the pattern, each null where it is empty; null otherwise.

    The pattern holds for the whole text, so one replacement both tells whether it does and takes the text apart;
    ``body`` is applied to the one array this makes, however often it names a group.
    """
    parted = F.regexp_replace(text, pattern, "|".join([_FOUND, *groups]))
    found = F.when(parted.startswith(_FOUND) & ~text.startswith(_FOUND), F.split(parted, r"\|"))
    bound = F.transform(F.array(found), lambda fields: body(*[F.nullif(F.get(fields, F.lit(n + 1)), F.lit("")) for n in range(len(groups))]))
    return F.get(bound, F.lit(0))


def _full_year(year: Column) -> Column:
    number = year.cast("int")
    return F.when(F.length(year) == 2, number + 2000).otherwise(number)


def spanish_date(col: Column) -> Column:
    """DATE from Spanish prose, d/m/y with two- or four-digit year, or ISO text."""
    def made(day: Column, month: Column, year: Column) -> Column:
        named = F.try_element_at(F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair]), month)
        return date_from_parts(_full_year(year), F.when(month.rlike("^[A-Z]"), named).otherwise(month.try_cast("int")), day)

    return _with_fields(F.upper(strip_marks(col)), _WRITTEN_DATE, ["$1$4$9", "$2$5$8", "$3$6$7"], made)


def date_parts(col: Column, prefix: str = "") -> list[Column]:
    """Unparsed flag, year, month, month name and weekday name of a date."""
    return [
        col.isNull().alias(f"{prefix}unparsed"),
        F.year(col).alias(f"{prefix}year"),
        F.month(col).alias(f"{prefix}month"),
        F.date_format(col, "MMMM").alias(f"{prefix}month_name"),
        F.date_format(col, "EEEE").alias(f"{prefix}weekday_name"),
    ]


# Shape of a text per field of a pattern.  Spark reads more than four digits as a year
# and then overflows, so a text is parsed only when it has the shape of its pattern.
_SHAPES = {"dd": r"\d{2}", "MM": r"\d{2}", "yyyy": r"\d{4}", "HH": r"\d{2}", "mm": r"\d{2}", "ss": r"\d{2}",
           "d": r"\d{1,2}", "M": r"\d{1,2}", "y": r"\d{1,4}", "H": r"\d{1,2}", "m": r"\d{1,2}", "s": r"\d{1,2}"}


def _shape(pattern: str) -> str:
    return "^" + re.sub(r"([a-zA-Z])\1*", lambda field: _SHAPES[field.group(0)], pattern) + "$"


def _ntz(col: Column, pattern: str) -> Column:
    return F.when(col.rlike(_shape(pattern)), F.try_to_timestamp(col, F.lit(pattern)).cast("timestamp_ntz"))


def _date(col: Column, pattern: str) -> Column:
    return F.when(col.rlike(_shape(pattern)), F.try_to_date(col, pattern))


def mixed_timestamp(col: Column) -> Column:
    """Local wall time from the formats seen on authorisation sheets."""
    text = F.translate(F.regexp_replace(col, f"(?i){TIMESTAMP_NOISE}", ""), '"', " ")

    def made(day: Column, month: Column, year: Column, *clock: Column) -> Column:
        hour, minute, second = (F.coalesce(part.cast("int"), F.lit(0)) for part in clock)
        at = date_from_parts(_full_year(year), month, day).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hour, minute, second)
        return F.when((hour < 24) & (minute < 60) & (second < 60), at)

    return _with_fields(text, _SHEET_TIME, ["$1$7", "$2$8", "$3$9", "$4$10", "$5$11", "$6$12"], made)


def ddmmyyyy_hhmm(col: Column) -> Column:
    """First 'dd/mm/yyyy hh:mm' found anywhere in the text."""
    return _ntz(extract(col, r"\d{2}/\d{2}/\d{4} \d{2}:\d{2}"), "dd/MM/yyyy HH:mm")


def ddmmyyyy_hhmm_state(col: Column) -> Column:
    return F.when(ddmmyyyy_hhmm(col).isNull(), "Formato inválido").otherwise("Válido")


def strict_ddmmyyyy(col: Column) -> Column:
    """'dd/mm/yyyy' and nothing else; '00/00/0000' is null."""
    text = trim_blanks(col)
    return F.when(text.rlike(r"^\d{2}/\d{2}/\d{4}$") & (text != "00/00/0000"),
                  F.try_to_date(text, "dd/MM/yyyy"))


def digits_and_slashes_date(col: Column) -> Column:
    bare = F.regexp_replace(col, r"[^0-9/]", "")
    return F.when(bare != "", _date(bare, "d/M/y"))


def feed_date(col: Column) -> Column:
    """'yyyymmdd' of the flat feed."""
    return _date(col, "yyyyMMdd")


def reading_time(col: Column) -> Column:
    """'dd/mm/yyyyhh:mm:' of the hourly readings."""
    return _ntz(col, READING_FORMAT)


def instant(value) -> Column:
    """Literal wall time without a zone; keeps filters on such columns pushable."""
    return F.lit(str(value)).cast("timestamp_ntz")


def floor_to(unit: str, col: Column) -> Column:
    return F.date_trunc(unit, col).cast("timestamp_ntz")


def month_start(col: Column) -> Column:
    return F.trunc(col, "MM")


def years_crossed(later: Column, earlier: Column) -> Column:
    """Calendar year boundaries between two dates: 31 Dec to 1 Jan is one."""
    return F.year(later) - F.year(earlier)


def months_crossed(later: Column, earlier: Column) -> Column:
    return years_crossed(later, earlier) * 12 + F.month(later) - F.month(earlier)


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """DATE from numbers, null for an impossible one."""
    text = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"),
                       F.lpad(day.cast("string"), 2, "0"))
    known = year.isNotNull() & month.isNotNull() & day.isNotNull()
    return F.when(known, F.try_to_date(text, "yyyy-MM-dd"))


def resolve_period(period: str | None, now_utc: dt.datetime | None = None) -> str:
    """The run's period as ISO date: the parameter, or yesterday in Lima (UTC-5, no DST)."""
    if period:
        return period
    now = now_utc or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return ((now - dt.timedelta(hours=5)).date() - dt.timedelta(days=1)).isoformat()


def default_period_column(now: Column) -> Column:
    """Column form of the default: yesterday in Lima for a UTC instant."""
    return F.date_sub(F.convert_timezone(F.lit("UTC"), F.lit(LOCAL_ZONE), now).cast("date"), 1)
