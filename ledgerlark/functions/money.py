"""Numbers written as text, amounts and rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import extract, trim_blanks

# --- fixed values -----------------------------------------------------------
SCALES = {"M": 1_000, "MM": 1_000_000}
NUMERIC_SCALE = 9
NUMERIC = f"decimal(38,{NUMERIC_SCALE})"
MECHANISMS = {
    "PAGO POR SERVICIOS": "PPS",
    "CPM": "CPM",
    "AMBULATORIO CPM": "CPM",
    "PAQUETE QUIRURGICO": "PQ",
    "PACIENTE MES CRONICO": "PMC",
}
CURRENCIES = {"1": "soles", "2": "dolares"}
# --- end of fixed values ----------------------------------------------------


def quantise(col: Column) -> Column:
    """Nine decimals, half up."""
    return col.cast(NUMERIC)


def number_or_null(col: Column, kind: str = "double") -> Column:
    return col.try_cast(kind)


def percent_share(col: Column) -> Column:
    """'CUBIERTO AL 65%' -> 0.65"""
    return F.regexp_substr(col, F.lit(r"\d+(?=%)")).try_cast("double") / 100


def first_number(col: Column) -> Column:
    return extract(col, r"\d+(?:\.\d+)?").try_cast("double")


def fixed_copay(col: Column) -> Column:
    """First number of the text; a copay stated in room days has no amount."""
    return F.when(~F.lower(col).contains("cuarto"), first_number(col))


def money_text(col: Column) -> Column:
    """'S/. 10,000.00' -> 10000.00; a share, a cap or a balance has no amount."""
    low = F.lower(F.coalesce(col, F.lit("")))
    bare = F.regexp_replace(F.coalesce(col, F.lit("")), r"S/\. ?|s/\. |[Ss]/|,", "")
    return F.when(~low.rlike(r"%|tope|saldo"), extract(bare, r"\d+(?:\.\d+)?").try_cast(NUMERIC))


def letter_amount(accumulated: Column, total: Column) -> Column:
    """Accumulated amount unless it is null, zero or below the total."""
    return F.when(accumulated.isNull() | (accumulated == 0) | (accumulated < total), total).otherwise(accumulated)


def payment_mechanism(col: Column) -> Column:
    return F.try_element_at(
        F.create_map(*[F.lit(x) for pair in MECHANISMS.items() for x in pair]), F.upper(col))


def coinsurance_percent(col: Column) -> Column:
    """A whole percentage divisible by five, else null."""
    value = trim_blanks(F.replace(col, F.lit("%"), F.lit(""))).try_cast("bigint")
    return F.when(~col.rlike(r"[.,]") & (value % 5 == 0), value)


def amount_with_fallback(amount: Column, feed: Column) -> Column:
    """The feed amount when the scanned one is null or zero."""
    return F.when(feed.isNotNull() & (amount.isNull() | (amount == 0)), feed).otherwise(amount)


def truncate(col: Column) -> Column:
    """Drop the decimals, toward zero."""
    return col.cast("bigint")


def same_whole(a: Column, b: Column) -> Column:
    return truncate(a) == truncate(b)


def within(a: Column, b: Column, tolerance: float) -> Column:
    """b within the tolerance of a, both without decimals."""
    return truncate(b).between(truncate(a) - tolerance, truncate(a) + tolerance)


def scaled(value: Column, scale: str = "MM", digits: int = 2) -> Column:
    """Number in thousands or millions, rounded."""
    return F.round(value / F.lit(SCALES[scale]), digits)


def scaled_text(value: Column, scale: str = "MM", digits: int = 2) -> Column:
    text = scaled(value, scale, digits).cast(f"decimal(38,{digits})").cast("string")
    return F.concat(text, F.lit(f" {scale}"))


def document_number(col: Column) -> Column:
    """All-digit document numbers lose leading zeros, then get them back up to eight."""
    padded = F.lpad(col.try_cast("bigint").cast("string"), 8, "0")
    return F.when(col.rlike(r"^[0-9]+$"), padded).otherwise(col)


def settlement_document(col: Column) -> Column:
    """Null for a blank or the word 'null', else the text as it is."""
    return F.when((trim_blanks(col) != "") & (col != "null"), col)


def number_text(col: Column) -> Column:
    """Amount inside a message: two decimals at most, no trailing zeros."""
    return F.regexp_replace(col.cast("decimal(38,2)").cast("string"), r"\.?0+$", "")
