"""Text cleaning expressions.  Everything here is a plain Column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Accent map of the diagnosis normal form (lower case goes to upper case).
DX_ACCENTED = "ÁÉÍÓÚÜÑáéíóúüñ"
DX_PLAIN = "AEIOUUNAEIOUUN"
# Greek capitals that look like Latin ones.
GREEK_LOOKALIKES = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ"
LATIN_LOOKALIKES = "ABEZHIKMNOPTYX"
# Precomposed Latin letters and the letters left once their marks are removed.
MARKED = "ÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇÝáàâäãåéèêëíìîïóòôöõúùûüñçýÿ"
UNMARKED = "AAAAAAEEEEIIIIOOOOOUUUUNCYaaaaaaeeeeiiiiooooouuuuncyy"
# Product codes by family.
PRODUCT_FAMILIES = {
    "AMC": ["1", "62", "59"],
    "EPS": ["S"],
    "AMI": ["4", "11", "12", "38", "50", "52", "53", "95", "E1", "7", "49", "54",
            "93", "2", "15", "28", "34", "16", "20"],
}
# Coverage by feed code: the authorisation cleaner and the consolidation use
# different maps for codes 1, 5 and 6.
COVERAGE_CODES_AUTHORISATION = {4: "AMBULATORIO"}
COVERAGE_CODES_CONSOLIDATION = {4: "AMBULATORIO", 1: "HOSPITALARIO", 5: "HOSPITALARIO", 6: "EMERGENCIA"}
# Coverage by keyword, first hit wins.
COVERAGE_KEYWORDS = [
    ("ambulato", "AMBULATORIO"), ("onco", "ONCOLOGIA"), ("preve", "PREVENCION"),
    ("mater", "MATERNIDAD"), ("hospit", "HOSPITALARIO"), ("emerg", "EMERGENCIA"),
]
# Affiliation by keyword, first hit wins.
AFFILIATION_KEYWORDS = [("REG", "REGULAR"), ("POTEST", "POTESTATIVO"), ("SCT", "SCTR"), ("SOA", "SOAT")]
MEDIA_TYPES = {
    "pdf": "application/pdf",
    "jpg": "image/jpeg",
    "png": "image/png",
    "jpeg": "image/jpeg",
    "pptx": "application/octet-stream",
    "docx": "application/octet-stream",
    "txt": "application/octet-stream",
}
# --- end of fixed values ----------------------------------------------------


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def trim_blanks(col: Column) -> Column:
    """Trim every kind of blank, not only the space character."""
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def squeeze(col: Column) -> Column:
    return F.regexp_replace(col, r"\s+", " ")


def digits(col: Column) -> Column:
    return F.regexp_replace(col, r"[^0-9]", "")


def extract(col: Column, pattern: str) -> Column:
    """First match of the whole pattern, null when there is none."""
    return F.regexp_substr(col, F.lit(pattern))


def strip_marks(col: Column) -> Column:
    return F.regexp_replace(F.translate(col, MARKED, UNMARKED), r"\p{M}", "")


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def label_map(col: Column, labels: dict, default: Column | None = None) -> Column:
    out = None
    for key, value in labels.items():
        out = F.when(col == F.lit(key), value) if out is None else out.when(col == F.lit(key), value)
    return out.otherwise(default) if default is not None else out


def keyword_ladder(col: Column, ladder: list[tuple[str, str]], default: Column) -> Column:
    out = None
    for word, value in ladder:
        hit = col.contains(word)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(default)


def text_normal_form(col: Column) -> Column:
    """Upper case, accents and look-alike letters mapped, blanks collapsed."""
    plain = squeeze(trim_blanks(F.translate(col, DX_ACCENTED, DX_PLAIN)))
    return F.upper(squeeze(F.translate(plain, GREEK_LOOKALIKES, LATIN_LOOKALIKES)))


def tax_id(col: Column) -> Column:
    """First run of eleven digits."""
    return extract(col, r"\d{11}")


def tax_id_exact(col: Column) -> Column:
    """The digits, when there are exactly eleven of them."""
    only = digits(col)
    return F.when(F.length(only) == 11, only)


def tax_id_compact(col: Column) -> Column:
    """Receiver tax id: punctuation and spaces removed, empty or 'null' becomes null."""
    bare = trim_blanks(F.regexp_replace(col, r"[.,: ]", ""))
    return F.when(~bare.isin("", "null"), bare)


def authorisation_code(scanned: Column, feed: Column) -> Column:
    """Ten scanned digits, else the feed value when its length is *not* ten.

    The inequality looks inverted but is what the audit has always applied.
    """
    only = digits(F.coalesce(scanned, F.lit("")))
    return F.when(F.length(only) == 10, only).when(F.length(feed) != 10, feed)


def policy_core(col: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.coalesce(col, F.lit("")), r"\s+", ""), r"[:.,]", "")


def invoice_policy(col: Column) -> Column:
    core = policy_core(col)
    return F.when(~F.upper(core).rlike(r"[A-Z]{2}"), blank_to_null(core))


def invoice_policy_invalid(col: Column) -> Column:
    core = policy_core(col)
    return (F.when(F.upper(core).rlike(r"[A-Z]{2}"), 1)
            .when(core.rlike(r"^[A-Z0-9-]{3,15}$"), 0).otherwise(1))


def authorisation_policy(col: Column) -> Column:
    core = policy_core(col)
    return F.when(core.rlike(r"^[E0-9]"), core)


def authorisation_policy_invalid(col: Column) -> Column:
    return F.when(policy_core(col).rlike(r"^[A-Z0-9-]{3,15}$"), 0).otherwise(1)


def identity_number(scanned: Column, feed: Column) -> Column:
    """Eight scanned digits, else the raw feed value."""
    only = digits(F.coalesce(scanned, F.lit("")))
    return F.when(only.rlike(r"^[0-9]{8}$"), only).otherwise(blank_to_null(trim_blanks(feed)))


def identity_number_invalid(scanned: Column, feed: Column) -> Column:
    return F.when(identity_number(scanned, feed).rlike(r"^[0-9]{8}$"), 0).otherwise(1)


def invoice_number(col: Column) -> Column:
    """Blanks removed and a dash after the fourth character when there is none."""
    bare = F.regexp_replace(F.coalesce(col, F.lit("")), r"\s+", "")
    return (F.when(bare == "", None)
            .when(F.instr(bare, "-") > 0, bare)
            .otherwise(F.concat(F.substring(bare, 1, 4), F.lit("-"), F.substr(bare, F.lit(5)))))


def invoice_numbers_match(first: Column, second: Column) -> Column:
    """1 when either normal form contains the other."""
    a, b = invoice_number(first), invoice_number(second)
    return flag(a.isNotNull() & b.isNotNull() & (a.contains(b) | b.contains(a)))


def bare_number(col: Column) -> Column:
    """Key used against the feed: the invoice number without dashes."""
    return F.replace(col, F.lit("-"), F.lit(""))


def company_name(col: Column, exact: dict[str, str] | None = None,
                 containing: dict[str, str] | None = None) -> Column:
    bare = trim_blanks(F.regexp_replace(col, r"[.,]", ""))
    out = F.when(bare.isin("", "null"), None)
    for name, alias in (exact or {}).items():
        out = out.when(bare == name, alias)
    for part, alias in (containing or {}).items():
        out = out.when(bare.contains(part), alias)
    return out.otherwise(bare)


def document_type(col: Column) -> Column:
    """Lower-case letters are dropped before the upper-casing, as they always were."""
    bare = F.upper(F.regexp_replace(F.coalesce(col, F.lit("")), r"[^A-Z0-9]", ""))
    return F.when(~bare.isin("", "STRING", "NA", "N/A"), bare)


def licence_code(col: Column) -> Column:
    only = digits(F.coalesce(col, F.lit("")))
    sentinel = F.upper(F.coalesce(col, F.lit(""))).rlike(r"STRING|NULL|N/A|NA")
    return F.when((only != "") & ~sentinel, only)


def affiliation(col: Column) -> Column:
    bare = F.regexp_replace(F.upper(F.coalesce(col, F.lit(""))), r"[^A-Z]", "")
    usable = (F.length(bare) > 1) & ~bare.rlike(r"STRING|N/A|NA")
    return F.when(usable, keyword_ladder(bare, AFFILIATION_KEYWORDS, bare))


def coverage(col: Column, feed_code: Column, codes: dict[int, str] | None = None) -> Column:
    """Coverage class by keyword; only a sentinel text falls back to the feed code."""
    low = F.lower(trim_blanks(col))
    fallback = coverage_from_code(feed_code, codes or COVERAGE_CODES_AUTHORISATION)
    return (F.when(low.isin("n/a", "na", "string", ""), fallback)
            .otherwise(keyword_ladder(low, COVERAGE_KEYWORDS, F.lit("OTROS"))))


def coverage_from_code(code: Column, codes: dict[int, str]) -> Column:
    return label_map(code.try_cast("bigint"), codes, F.lit("OTROS"))


def product_family(code: Column) -> Column:
    out = None
    for family, members in PRODUCT_FAMILIES.items():
        hit = code.isin(members)
        out = F.when(hit, family) if out is None else out.when(hit, family)
    return out.otherwise("OTROS")


def diagnosis_code(col: Column) -> Column:
    """Punctuation off; a leading 1 or 0 before three digits was a letter I or O."""
    bare = trim_blanks(F.regexp_replace(col, r"[.,]", ""))
    return (F.when(bare.rlike(r"CIE10|N/A"), None)
            .when(bare.rlike(r"^1\d{3}$"), F.concat(F.lit("I"), F.substr(bare, F.lit(2))))
            .when(bare.rlike(r"^0\d{3}$"), F.concat(F.lit("O"), F.substr(bare, F.lit(2))))
            .otherwise(bare))


SENTINEL_ID = r"STRING|N/A|NA|^$"


def field_with_fallback(scanned: Column, feed: Column) -> Column:
    """Scanned digits unless the text is a sentinel; the feed value when nothing was scanned."""
    cleaned = F.when(~F.upper(scanned).rlike(SENTINEL_ID), digits(scanned))
    return F.when(scanned.isNull(), feed).otherwise(cleaned)


def field_with_fallback_invalid(scanned: Column, feed: Column) -> Column:
    seen = F.coalesce(scanned, feed)
    return F.when(seen.isNull() | F.upper(seen).rlike(SENTINEL_ID) | (digits(seen) == ""), 1).otherwise(0)


def reference_number(col: Column) -> Column:
    """Series with its dash, then the rest padded to eight digits."""
    rebuilt = F.concat(F.substring(col, 1, 5), F.lpad(F.substr(col, F.lit(6)), 8, "0"))
    return F.when(F.lower(col) != "null", rebuilt)


def series_number(series: Column, number: Column) -> Column:
    return F.concat(series, F.lpad(number, 8, "0"))


def invoice_from_file_name(col: Column) -> Column:
    """'20102756364_01_F135_00022092.pdf' -> 'F135-00022092', '' when it does not fit."""
    pattern = r"(\d+)_(\d+)_([A-Z]\d+)_(\d+)\.pdf"
    return F.when(col.rlike(pattern),
                  F.concat(F.regexp_extract(col, pattern, 3), F.lit("-"), F.regexp_extract(col, pattern, 4))
                  ).otherwise("")


def url_extension(url: Column) -> Column:
    path = F.try_parse_url(url, F.lit("PATH"))
    return F.regexp_extract(path, r"[^/.][^/]*\.([^./]+)$", 1)


def media_type(url: Column) -> Column:
    """Media type of the file a URL points to; null for an unknown extension."""
    return label_map(url_extension(url), MEDIA_TYPES)


def comma_list(col: Column) -> Column:
    """Elements of a comma separated list; null when the list is malformed."""
    parts = F.transform(F.split(col, ","), trim_blanks)
    return F.when(col.rlike(r"^[^,]+(,[^,]+)*$") & ~F.exists(parts, lambda part: part == ""), parts)
