import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldmart.functions import calendar, casts, risk, text

NAIVE = dt.datetime(2025, 3, 10, 14, 5, 9)


def one(spark, *columns):
    return tuple(spark.range(1).select(*[c.alias(f"c{n}") for n, c in enumerate(columns)]).first())


def test_lenient_casts(spark):
    lit = F.lit
    assert one(spark, casts.try_date(lit("2025-02-30")), casts.try_date(lit("2025-02-03")),
               casts.try_day_first(lit("03-02-2025")), casts.try_day_first(lit("2025-02-03"))) == (
        None, dt.date(2025, 2, 3), dt.date(2025, 2, 3), None)
    assert one(spark, casts.try_bigint(lit(" 12 ")), casts.try_bigint(lit("12a")), casts.cents(lit("1250")),
               casts.cents(lit("x")), casts.cents(lit(None).cast("string"))) == (12, None, 12.5, None, None)
    assert one(spark, casts.try_stamp(lit("2025-03-10T14:05:09")), casts.try_stamp(lit("later")),
               casts.minute_text(lit("2025-03-10T14:05:09.123")), casts.minute_text(lit(""))) == (
        NAIVE, None, "2025-03-10 14:05", None)


@pytest.mark.parametrize("given,expected", [
    ("2025-08-01", dt.date(2025, 8, 1)), ("08/01/2025", dt.date(2025, 8, 1)), ("25/12/2025", dt.date(2025, 12, 25)),
    ("2025-08-01T10:11:12", dt.date(2025, 8, 1)), ("20250801", dt.date(2025, 8, 1)), ("soon", None),
])
def test_mixed_date(spark, given, expected):
    assert one(spark, casts.mixed_date(F.lit(given))) == (expected,)


def test_as_of_forms(spark):
    aware = dt.datetime(2025, 3, 10, 23, 0, tzinfo=dt.timezone(dt.timedelta(hours=-3)))
    assert one(spark, casts.day(aware), casts.moment(aware), casts.day("2025-03-10"), casts.day(dt.date(2025, 3, 10)),
               casts.day(NAIVE)) == (dt.date(2025, 3, 11), dt.datetime(2025, 3, 11, 2), *[dt.date(2025, 3, 10)] * 3)


def test_zone_helpers(spark):
    aware = F.lit("2025-03-10 12:00:00-03:00").cast("timestamp")
    assert one(spark, casts.drop_zone(aware), casts.drop_zone(casts.attach_utc(casts.moment(NAIVE))),
               casts.shift_hours(casts.moment(NAIVE), -15)) == (
        dt.datetime(2025, 3, 10, 15), NAIVE, dt.datetime(2025, 3, 9, 23, 5, 9))


def test_text(spark):
    lit, null = F.lit, F.lit(None).cast("string")
    assert one(spark, text.digits_only(lit("OS-12.3")), text.digits_only(null), text.postal_key(lit(" 12345-678 ")),
               text.protocol_text(lit("#A#1")), text.protocol_text(null)) == ("123", "", "12345678", "A1", None)
    assert one(spark, text.first_filled(lit(" "), lit("x")), text.first_filled(null, lit("")),
               text.first_filled(lit("a"), lit("x")), text.concat_key(lit("a"), null)) == ("x", None, "a", None)
    assert one(spark, text.sql_literal(lit("d'Ávila")), text.sql_literal(lit("")), text.sql_literal(lit(7)),
               text.sql_literal(casts.moment(NAIVE), "timestamp_ntz"), text.sql_literal(lit(True), "boolean")) == (
        "'d''Ávila'", "NULL", "'7'", "'2025-03-10 14:05:09'", "'True'")
    assert one(spark, text.full_address(lit("Rua"), null, lit("c"), lit("d"), lit("1"), null, lit("PE"))) == (
        "Rua, None - c - d - 1 , None-PE",)


def test_listed_text(spark):
    flags, odd = F.array(F.lit(True), F.lit(None), F.lit(False)), F.array(F.lit("['a']"), F.lit(None))
    assert one(spark, text.listed_text(flags), text.listed_text(odd), text.listed_text(F.array().cast("array<string>")),
               text.listed_text(odd, strict=False)) == ("True, None, False", "a, None", "", "['a']")


def test_token_sort_ratio(spark):
    pairs = [("São Paulo", "Paulo  São", 100.0), ("", "", 100.0), ("a", "", 0.0), ("abc", "abd", 200 * 2 / 6),
             ("kitten sitting", "sitting kitten", 100.0), ("ab", "ba", 50.0)]
    for a, b, expected in pairs:
        assert one(spark, text.token_sort_ratio(F.lit(a), F.lit(b)))[0] == pytest.approx(expected)


def test_growth_and_ratio(spark):
    lit = F.lit
    assert one(spark, risk.growth(lit(10), lit(60)), risk.growth(lit(10), lit(61)), risk.growth(lit(0), lit(51)),
               risk.safe_ratio(lit(1), lit(0)), risk.safe_ratio(lit(1), lit(None).cast("int"))) == (0.0, 5.1, 1.0, 0.0, 0.0)


@pytest.mark.parametrize("months,curve", [(9, "Long Tail"), (8, "Decrescente"), (3, "Decrescente"), (2, "Crescente"),
                                          (0, "Crescente"), (-1, None), (None, "Crescente")])
def test_curve(spark, months, curve):
    assert one(spark, risk.lifecycle_curve(F.lit(months).cast("int"))) == (curve,)


def test_months_crossed_counts_boundaries(spark):
    assert one(spark, risk.months_crossed(F.lit(dt.date(2025, 1, 31)), F.lit(dt.date(2025, 2, 1))),
               risk.months_crossed(F.lit(dt.date(2024, 11, 1)), F.lit(dt.date(2025, 2, 28)))) == (1, 3)


def ladder(change, before, now, limit):
    """The rungs as a table of bounds."""
    if not change > limit:
        return None
    table = [("Comunicado - Verde", before < .5, now < .5), ("Alerta - Amarelo", before < .5, now < .8),
             ("Comunicado - Amarelo", before < .8, now < .8), ("Alerta - Vermelho", before < .8, now > .8),
             ("Alerta - Vermelho Crítico", before > .8, now > .8)]
    return next((name for name, a, b in table if a and b), None)


def test_colour_ladder_on_a_grid(spark):
    grid = [0.0, 0.3, 0.5, 0.6, 0.8, 0.9]
    cases = [(c, a, b) for c in (0.0, 0.4, 0.41) for a in grid for b in grid]
    df = spark.createDataFrame(cases, "change double, before double, now double")
    colour = risk.alert_colour("change", "before", "now", 0.4)
    got = {tuple(r)[:3]: (r["colour"], r["level"]) for r in
           df.select("*", colour.alias("colour"), risk.colour_level(colour).alias("level")).collect()}
    names = [None, *risk.COLOURS]
    for case in cases:
        expected = ladder(*case, 0.4)
        assert got[case] == (expected, names.index(expected)), case


def test_declining_cities_alert_only_when_fixed(spark):
    args = (F.lit("Decrescente"), F.lit(0.5), F.lit(0.1), F.lit(0.6))
    assert one(spark, risk.colour_by_curve(*args), risk.colour_by_curve(*args, fix_declining=True),
               risk.colour_by_curve(F.lit(None).cast("string"), *args[1:])) == (None, "Alerta - Amarelo", None)


def test_calendar_columns(spark):
    names = ("Ano NomeMes MesAbre MesAno MesNum AnoMesINT InicioMes Trimestre TrimestreAbreviado Bimestre Semestre "
             "Semana DiaSemana NomeDia").split()
    row = spark.range(1).select(*calendar.calendar_columns(F.lit(dt.date(2025, 5, 10)))).first()
    assert row.asDict() == dict(zip(names, (
        2025, "Maio", "Mai", "mai/25", 5, 202505, "2025-05-01 00:00:00", 2, "2º Trim", "3º Bim", "1º Sem", 19, 6, "sábado")))
    new_year = spark.range(1).select(*calendar.calendar_columns(F.lit(dt.date(2027, 1, 1)))).first()
    assert (new_year["Semana"], new_year["Ano"], new_year["NomeDia"]) == (53, 2027, "sexta-feira")


def test_whole_days_round_down(spark):
    start = casts.moment(dt.datetime(2025, 1, 1, 12))
    assert one(spark, calendar.whole_days(start, casts.moment("2025-01-03 11:59:59")),
               calendar.whole_days(start, casts.moment("2025-01-03 12:00:00"))) == (1, 2)
