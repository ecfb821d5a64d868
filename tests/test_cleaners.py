"""Row-level cleaners on the values that reach every branch."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlark.functions import dates, money, text
from ledgerlark.plans.documents import map_diagnosis
from ledgerlark.sources import lookups

DAY = dt.date(2025, 6, 5)
CASES = [
    (dates.spanish_date, "Lunes, 5 de Junía del 2025 10:30", DAY),
    (dates.spanish_date, "05/06/25", DAY),
    (dates.spanish_date, "2025-06-05", DAY),
    (dates.spanish_date, "5 SETIEMBRE 2025", dt.date(2025, 9, 5)),
    (dates.spanish_date, "Miércoles, 5 de setiembre de 2025.", dt.date(2025, 9, 5)),
    (dates.spanish_date, "5 FOO 2025", None),
    (dates.spanish_date, "31/02/2025", None),
    (dates.spanish_date, "31 FEBRERO 2025", None),
    (dates.spanish_date, "", None),
    (dates.mixed_timestamp, "17-02-2023 04:28:01", dt.datetime(2023, 2, 17, 4, 28, 1)),
    (dates.mixed_timestamp, "17/02/23 04:28", dt.datetime(2023, 2, 17, 4, 28)),
    (dates.mixed_timestamp, "17/02/2023", dt.datetime(2023, 2, 17)),
    (dates.mixed_timestamp, "1702202304 28 01", dt.datetime(2023, 2, 17, 4, 28, 1)),
    (dates.mixed_timestamp, "EN CLINICA", None),
    (dates.strict_ddmmyyyy, "00/00/0000", None),
    (dates.strict_ddmmyyyy, "05/06/2025", DAY),
    (dates.ddmmyyyy_hhmm, "Ingreso 05/06/2025 09:15 hrs", dt.datetime(2025, 6, 5, 9, 15)),
    (dates.digits_and_slashes_date, "Lima, 05/06/2025", DAY),
    (dates.reading_time, "01/03/202502:00:", dt.datetime(2025, 3, 1, 2)),
    (text.tax_id, "RUC 20546292658 X", "20546292658"),
    (text.tax_id, "2054629265", None),
    (text.invoice_policy, " 12.34,5 ", "12345"),
    (text.invoice_policy, "ABC-1", None),
    (text.invoice_policy, "", None),
    (text.authorisation_policy, "E123", "E123"),
    (text.authorisation_policy, "A123", None),
    (text.reference_number, "F135-22092", "F135-00022092"),
    (text.reference_number, "null", None),
    (text.diagnosis_code, "1209", "I209"),
    (text.diagnosis_code, "0800", "O800"),
    (text.diagnosis_code, "J06.9", "J069"),
    (text.diagnosis_code, "CIE10", None),
    (text.affiliation, "1. Regular", "REGULAR"),
    (text.affiliation, "nacional", None),
    (text.document_type, "D.N.I ", "DNI"),
    (text.document_type, "dni", None),
    (text.media_type, "https://a.b/c/file.pdf?x=1", "application/pdf"),
    (text.media_type, "https://a.b/c/file.exe", None),
    (text.comma_list, "a, b ,c", ["a", "b", "c"]),
    (text.comma_list, "a,,b", None),
    (text.invoice_from_file_name, "20102756364_01_F135_00022092.pdf", "F135-00022092"),
    (money.percent_share, "CUBIERTO AL 65%", 0.65),
    (money.percent_share, "NINGUNO", None),
    (money.fixed_copay, "35.00 SOLES POR", 35.0),
    (money.fixed_copay, "1 DIA DE CUARTO", None),
    (money.fixed_copay, "Ninguna", None),
    (money.money_text, "S/. 10,000.00", Decimal("10000.000000000")),
    (money.money_text, "80%", None),
    (money.money_text, "TOPE", None),
    (money.money_text, None, None),
    (money.coinsurance_percent, "45%", 45),
    (money.coinsurance_percent, "0 %", 0),
    (money.coinsurance_percent, "1626.97", None),
    (money.coinsurance_percent, "7", None),
    (money.payment_mechanism, "Ambulatorio cpm", "CPM"),
    (money.document_number, "001234", "00001234"),
    (money.document_number, "CE12", "CE12"),
]


def test_cleaners(spark):
    rows = spark.createDataFrame([(i, value) for i, (_, value, _) in enumerate(CASES)], "i int, v string")
    done = rows.select("i", *[make(F.col("v")).alias(f"c{i}") for i, (make, _, _) in enumerate(CASES)])
    got = {r["i"]: r[f"c{r['i']}"] for r in done.collect()}
    wrong = [(make.__name__, value, expected, got[i]) for i, (make, value, expected) in enumerate(CASES) if got[i] != expected]
    assert not wrong


@pytest.mark.parametrize("accumulated,total,expected", [(0.0, 50.0, 50.0), (40.0, 50.0, 50.0), (60.0, 50.0, 60.0), (None, 50.0, 50.0)])
def test_letter_amount(spark, accumulated, total, expected):
    df = spark.createDataFrame([(accumulated, total)], "a double, t double")
    assert df.select(money.letter_amount(F.col("a"), F.col("t"))).first()[0] == expected


def test_number_in_messages(spark):
    df = spark.createDataFrame([(40000.0,), (4175.59,), (2172.9,), (55.0,)], "v double")
    assert [r[0] for r in df.select(money.number_text(F.col("v"))).collect()] == ["40000", "4175.59", "2172.9", "55"]


def test_invoice_number_match(spark):
    df = spark.createDataFrame([("F13500022092", "F135-00022092"), ("F1", None)], "a string, b string")
    assert [r[0] for r in df.select(text.invoice_numbers_match(F.col("a"), F.col("b"))).collect()] == [1, 0]


def test_unreachable_diagnosis_keeps_its_text(spark):
    original = "RUPTURA TRAUMATICA DE LIGAMENTOS DE LA MUÑECA Y DEL CARPO"
    df = spark.createDataFrame([(original,), (" tumor  maligno de la próstata",)], "v string")
    mapped = map_diagnosis(df, F.col("v"), lookups.diagnosis_equivalences(spark), "dx")
    assert {r["dx"] for r in mapped.collect()} == {original, "HIPERPLASIA DE LA PROSTATA"}


def test_calendar_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, 1), dt.date(2024, 12, 31))], "a date, b date")
    row = df.select(dates.years_crossed(F.col("a"), F.col("b")).alias("y"), dates.months_crossed(F.col("a"), F.col("b")).alias("m")).first()
    assert (row["y"], row["m"]) == (1, 1)


def test_period_default():
    assert dates.resolve_period("2024-01-01") == "2024-01-01"
    assert dates.resolve_period("", dt.datetime(2024, 3, 1, 4, 0)) == "2024-02-28"
    assert dates.resolve_period("", dt.datetime(2024, 3, 1, 5, 0)) == "2024-02-29"
