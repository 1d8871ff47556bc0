"""Literal-row edge cases of the column functions."""

import datetime as dt

from pyspark.sql import functions as F

from orrery.functions import dates as D
from orrery.functions import numeric as N
from orrery.functions import text as T
from orrery.functions.common import round_half_even, round_half_up


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_normalize_text_accents_dashes_spaces(spark):
    s = "  Ávila – Segovia\tÑandú  Straße "
    # long dash becomes '-' before non-ASCII is dropped; ß has no decomposition
    assert one(spark, T.normalize_text("x"), s) == "avila-segovia nandu strae"


def test_normalize_text_null_modes(spark):
    assert one(spark, T.normalize_text("x"), None) == ""
    assert one(spark, T.normalize_text("x", null_as_empty=False), None) is None


def test_remove_accents_keeps_case_and_other_letters(spark):
    assert one(spark, T.remove_accents("x"), "Ávila ß Ñ") == "Avila ß N"


def test_rare_multi_character_expansion(spark):
    assert one(spark, T.normalize_text("x"), "½ Ĳssel") == "12 ijssel"


def test_zfill_does_not_truncate(spark):
    assert one(spark, T.zfill("x", 2), "123") == "123"
    assert one(spark, T.zfill("x", 5), "123") == "00123"


def test_canonical_key_rules_then_comma(spark):
    assert one(spark, T.canonical_key("x"), "Comunidad Foral de Navarra") == "navarra"
    assert one(spark, T.canonical_key("x"), "Illes Balears") == "balears"
    assert one(spark, T.canonical_key("x"), "Valencia, Comunitat") == "valencia"


def test_sentinels_and_lead_time(spark):
    assert one(spark, T.nullify_sentinels("x"), " <NA> ") is None
    assert one(spark, T.nullify_sentinels("x"), " ok ") == "ok"
    assert one(spark, T.normalize_lead_time("x"), " 2 - 3  Meses") == "2-3 meses"
    assert one(spark, T.normalize_lead_time("x"), "2 – 3 meses") == "2-3 meses"


def test_split_pair_and_title(spark):
    o, d = T.split_pair("x")
    row = spark.createDataFrame([("Madrid – Sevilla - x",)], "x string").select(o.alias("o"), d.alias("d")).first()
    assert (row.o, row.d) == ("Madrid", "Sevilla - x")
    assert one(spark, T.title_case("x"), "o'neil de la VEGA") == "O'Neil De La Vega"


def test_query_variants_order_and_dedupe(spark):
    df = spark.createDataFrame([("Ávila", "Ávila", "Castilla")], "n string, p string, r string")
    got = df.select(T.query_variants("n", "p", "r").alias("v")).first().v
    assert got[0] == "Ávila, Ávila, Castilla, España"
    assert got[1] == "Avila, Avila, Castilla, Espana"
    assert got[-1] == "Avila" and len(got) == len(set(got))


def test_parse_spanish_number(spark):
    assert one(spark, N.parse_spanish_number("x"), "1.234,56") == 1234.56
    assert one(spark, N.parse_spanish_number("x"), "12,5%") == 12.5
    assert one(spark, N.parse_spanish_number("x"), " - ") is None
    assert one(spark, N.parse_spanish_number("x"), "abc") is None


def test_parse_number_auto_and_currency(spark):
    assert one(spark, N.parse_number_auto("x"), "1.234,5") == 1234.5
    assert one(spark, N.parse_number_auto("x"), "4,5") == 4.5
    assert one(spark, N.parse_number_auto("x"), "4.5") == 4.5
    assert one(spark, N.parse_currency("x"), "9.550 €") == 95.5


def test_booleans(spark):
    assert one(spark, N.to_boolean("x"), " Sí ") is True
    assert one(spark, N.to_boolean("x"), "n") is False
    assert one(spark, N.to_boolean("x"), "maybe") is None


def test_rounding_modes(spark):
    assert one(spark, round_half_up("x"), 2.675, "x double") == 2.68
    assert one(spark, round_half_even("x", 0), 2.5, "x double") == 2.0
    assert one(spark, round_half_up("x", 0), 2.5, "x double") == 3.0


def test_fixed_bins_right_closed(spark):
    e = N.fixed_bins("x", [0, 10, 20], ["a", "b"])
    assert one(spark, e, 0.0, "x double") is None  # lowest edge excluded (pd.cut)
    assert one(spark, e, 10.0, "x double") == "a"
    assert one(spark, e, 10.5, "x double") == "b"
    assert one(spark, N.fixed_bins("x", [0, 10, 20], ["a", "b"], include_lowest=True), 0.0, "x double") == "a"


def test_row_mean_modes(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    r = df.select(N.row_mean("a", "b").alias("m"), N.row_mean("a", "b", ignore_nulls=False).alias("s")).first()
    assert r.m == 1.0 and r.s is None


def test_night_series_same_day_and_weekend(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 5), dt.date(2024, 1, 5)), (dt.date(2024, 1, 5), dt.date(2024, 1, 8))],
                               "s date, e date")
    rows = df.select(F.explode_outer(D.night_dates("s", "e")).alias("n")).collect()
    nights = [r.n for r in rows]
    assert nights[0] is None  # same-day trip: no night
    got = [n for n in nights if n is not None]
    assert got == [dt.date(2024, 1, 5), dt.date(2024, 1, 6), dt.date(2024, 1, 7)]
    flags = df.select(F.explode(D.night_dates("s", "e")).alias("n")).select(D.is_weekend_night("n").alias("w")).collect()
    assert [f.w for f in flags] == [True, True, False]  # Friday, Saturday nights; Sunday night is weekday


def test_months_until_banker_rounding(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 16), dt.date(2024, 1, 1))], "d date, a date")
    r = df.select(D.days_until("d", "a").alias("days"), D.months_until("d", "a").alias("m")).first()
    assert r.days == 75 and r.m == 2  # 75 / 30 = 2.5 -> 2 (half to even)


def test_season_and_lead_time(spark):
    assert one(spark, D.season_of_month("x"), 7, "x int") == "alta"
    assert one(spark, D.season_of_month("x"), 6, "x int") == "media"
    assert one(spark, D.lead_time_for_month("x"), 6, "x int") == "2-3 meses"
    assert one(spark, D.lead_time_for_month("x"), None, "x int") is None
