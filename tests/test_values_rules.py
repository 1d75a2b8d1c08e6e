"""Numbers, dates, contacts and business rules (SC-07..09, SC-11, SC-13, SC-19..30, SC-35/36), traps T-06..T-09, T-17."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import one_col
from tejado.functions import contacts, dates, numbers, rules


def test_to_number_guard(spark):
    got = one_col(spark, [" 12 ", "1e3", "12d", "1,234", "nan", "", None, "-0.5"], numbers.to_number)
    assert got == [12.0, 1000.0, None, None, None, None, None, -0.5]


def test_to_percent(spark):
    got = one_col(spark, ["8%", "8", "0,08", "1", "-5", "x"], numbers.to_percent)
    assert got == [0.08, 0.08, 0.08, 1.0, -0.05, None]


def test_parse_timestamp_every_row_every_format(spark):
    got = one_col(spark, ["2024-05-01", "01/06/2024", "2024-13-01", "x"], lambda c: dates.parse_timestamp(c, dayfirst=True))
    assert got == [dt.datetime(2024, 5, 1), dt.datetime(2024, 6, 1), None, None]
    assert one_col(spark, ["01/06/2024"], dates.parse_timestamp) == [dt.datetime(2024, 1, 6)]


def test_money_text_and_consistency(spark):
    assert one_col(spark, [1234.4, None], numbers.money_text, "double") == ["S/ 1,234", "S/ 0"]
    df = spark.createDataFrame([(8.0, 100.0, 0.08), (9.0, 100.0, 0.08), (None, 100.0, 0.08)], "a double, b double, p double")
    assert [r[0] for r in df.select(numbers.inconsistent_amount("a", "b", "p")).collect()] == [False, True, False]


def test_phones(spark):
    vals = ["+51 912 345 678", "0051912345678", "81234567", None]
    assert one_col(spark, vals, lambda c: contacts.phone_key(c, drop_0051=True, empty_as_null=True)) == \
        ["912345678", "912345678", "81234567", None]
    assert one_col(spark, vals, contacts.is_mobile) == [True, False, False, False]


def test_emails(spark):
    assert one_col(spark, [" A@b.co ", "a b@c.d", None, "x@y"], contacts.is_email) == [True, False, False, False]
    df = spark.createDataFrame([(1, " Ana, Z@gmai.com"), (2, "a@gmil.com"), (3, "a@outlook.es"), (4, "sin-arroba"),
                                (5, None), (6, "b@live.co")], "i int, email string")
    got = [r[0] for r in contacts.clean_emails(df, "email").orderBy("i").select("email_clean").collect()]
    assert got == ["ana.z@gmail.com", "a@gmail.com", "a@outlook.es", "sin-arroba", None, "b@live.com"]


def test_anonymise(spark):
    got = one_col(spark, [" abc ", "abc", None, "  "], contacts.anonymise)
    assert got[0] == got[1] and got[0].startswith("anon_") and len(got[0]) == 15
    assert got[2:] == [None, ""]


def test_client_name(spark):
    df = spark.createDataFrame([("  ", "Ana", "Paz"), (None, "Ana", None), ("Sra X", "a", "b")], "c string, n string, a string")
    assert [r[0] for r in df.select(contacts.client_name("c", "n", "a")).collect()] == ["Ana Paz", "Ana", "Sra X"]
    assert [r[0] for r in df.select(contacts.client_name("c", "n", "a", blank_falls_back=False)).collect()] == \
        ["  ", "Ana", "Sra X"]


def test_unit_types(spark):
    vals = ["Departamento Flat", "FLAT", "Cochera doble", "Depósito", "Local Comercial", None]
    assert one_col(spark, vals, rules.unit_type_stock) == \
        ["departamento", "departamento flat", "estacionamiento", "depósito", "local comercial", None]
    assert one_col(spark, vals, rules.unit_type_sales) == \
        ["DEPARTAMENTO", "DEPARTAMENTO", "ESTACIONAMIENTO", "DEPÓSITO", "LOCAL COMERCIAL", None]
    assert one_col(spark, vals, rules.unit_type_process) == \
        ["departamento", "otro", "estacionamiento", "deposito", "local comercial", "otro"]
    assert one_col(spark, ["DEPARTAMENTO DUPLEX", "ESTACIONAMIENTO SIMPLE", "DEPOSITO", None], rules.receivable_category) == \
        ["DEPA", "ESTAC", "DEPO", "OTRO"]


def test_unit_number(spark):
    df = spark.createDataFrame([("D-1201", "U", "Departamento"), ("E-12 B07", "U", "Estacionamiento"),
                                ("SIN", "U", "Deposito"), (None, "U-77", "Deposito")], "n string, c string, t string")
    got = [r[0] for r in df.select(rules.unit_number("n", "c", "t")).collect()]
    assert got == ["D-1201", "07", "SIN", "77"]


def test_exclusion_reason_and_state(spark):
    df = spark.createDataFrame([(None, "no califica"), ("No perfil", "NO CALIFICA"), ("Contactado", None),
                                ("no respondió", "")], "e string, o string")
    got = [r[0] for r in df.select(rules.exclusion_reason("e", "o")).collect()]
    assert got == ["No alcanza cuota", "NO perfil", None, "No respondió"]
    df = spark.createDataFrame([(True, True), (False, True), (True, False), (False, False)], "e boolean, p boolean")
    assert [r[0] for r in df.select(rules.contact_state("e", "p")).collect()] == \
        [rules.CONTACT_OK, rules.CONTACT_NO_EMAIL, rules.CONTACT_NO_PHONE, rules.CONTACT_NONE]


def test_commercial_status_rule_order(spark):
    df = spark.createDataFrame([(True, "Disponible"), (False, "En separación"), (False, "No disponible"),
                                (False, None), (False, "VENDIDO DISP")], "o boolean, r string")
    got = [r[0] for r in df.select(rules.commercial_status(F.col("o"), F.col("r"))).collect()]
    assert got == ["Vendido", "Vendido", "Disponible", "Disponible", "Disponible"]


def test_discount_waterfall(spark):
    df = spark.createDataFrame([(None, 5.0, 100.0, "departamento"), (None, None, 100.0, "departamento"),
                                (None, None, 100.0, "estacionamiento"), (0.1, None, None, "departamento"),
                                (None, 5.0, 0.0, "departamento")], "p double, a double, l double, t string")
    pct = rules.discount_pct(F.col("p"), F.col("a"), F.col("l"), F.col("t"))
    got = [(r[0], r[1]) for r in df.select(pct.alias("x"), rules.discount_amount(F.col("a"), F.col("l"), pct)).collect()]
    assert got == [(0.05, 5.0), (0.08, 8.0), (0.0, 0.0), (None, None), (0.08, 5.0)]


def test_date_spellings(spark):
    import datetime as dt
    from tejado.functions.dates import parse_timestamp
    good = {
        "1/5/2024": dt.datetime(2024, 1, 5), "1-5-2024": dt.datetime(2024, 5, 1), "2024-05-01 10:11": dt.datetime(2024, 5, 1, 10, 11),
        "2024-05-01 10:11:12.123": dt.datetime(2024, 5, 1, 10, 11, 12, 123000), "2024-05-01T10:11:12Z": dt.datetime(2024, 5, 1, 10, 11, 12),
        "2024-05-01T10:11:12.123456": dt.datetime(2024, 5, 1, 10, 11, 12, 123456), "20240501": dt.datetime(2024, 5, 1),
        "01/05/2024 10:11": dt.datetime(2024, 1, 5, 10, 11), "2024/5/1": dt.datetime(2024, 5, 1), " 2024-05-01 ": dt.datetime(2024, 5, 1),
        "2024-05-01T10:11:12+05:00": dt.datetime(2024, 5, 1, 10, 11, 12),
    }
    assert one_col(spark, list(good), parse_timestamp) == list(good.values())
    assert one_col(spark, ["1/5/2024", "31/12/2024"], lambda c: parse_timestamp(c, dayfirst=True)) == [dt.datetime(2024, 5, 1), dt.datetime(2024, 12, 31)]
    bad = ["", None, "x", "2024-13-01", "2024-02-30", "13/13/2024", "12345678901", "2024-05-01 25:00", "1/2/2024 13:00 PM", "30 Feb 2024", "5 Mayo 2024", "2024-5-"]
    assert one_col(spark, bad, parse_timestamp) == [None] * len(bad)


def test_dates_of_either_order_names_and_halves(spark):
    from tejado.functions.dates import parse_timestamp
    day = dt.datetime(2024, 12, 31)
    for text in ["31/12/2024", "12/31/2024", "31/12/24", "31-12-2024", "12-31-2024", "31 Dec 2024", "31-dec-2024", "December 31, 2024", "dec. 31 2024", "20241231"]:
        for first in (True, False):
            assert one_col(spark, [text], lambda c: parse_timestamp(c, dayfirst=first)) == [day], text
    good = {"2024-05": dt.datetime(2024, 5, 1), "1/5/69": dt.datetime(1969, 1, 5), "1/5/68": dt.datetime(2068, 1, 5), "1/5/2024 12:07 am": dt.datetime(2024, 1, 5, 0, 7),
            "1/5/2024 12:07:09 P.M.": dt.datetime(2024, 1, 5, 12, 7, 9), "5 Sept 2024, 3:04pm": dt.datetime(2024, 9, 5, 15, 4), "May 5, 2024 23:59": dt.datetime(2024, 5, 5, 23, 59)}
    assert one_col(spark, list(good), parse_timestamp) == list(good.values())


def test_the_column_tells_its_date_order(spark):
    for texts, want in ((["1/5/2024", "31/12/2024"], (5, 1)), (["1/5/2024", "12/31/2024"], (1, 5)), (["1/5/2024"], (1, 5)),
                        (["1/5/2024", "31/1/24", "25/1/24", "1/31/24"], (5, 1)), (["1/5/2024", None, "x", "99/99/2024"], (1, 5))):
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        got = [r[0] for r in df.select(dates.as_timestamp(df, "t")).collect()]
        assert (got[0].month, got[0].day) == want
