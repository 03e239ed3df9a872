"""Calendar attributes with Portuguese names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casts import as_col

# Portuguese month names (January first) and weekday names (Monday first).
MONTHS = ("Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho", "Julho",
          "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro")
WEEKDAYS = ("segunda-feira", "terça-feira", "quarta-feira", "quinta-feira",
            "sexta-feira", "sábado", "domingo")


def _pick(names: tuple[str, ...], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


def calendar_columns(c: Column | str) -> list[Column]:
    """The fourteen attribute columns of one date, in table order."""
    d = as_col(c)
    month_name = _pick(MONTHS, F.month(d))
    short = F.substring(month_name, 1, 3)
    bimester = F.ceil(F.month(d) / 2).cast("int")
    semester = F.ceil(F.month(d) / 6).cast("int")
    return [
        F.year(d).alias("Ano"),
        month_name.alias("NomeMes"),
        short.alias("MesAbre"),
        F.concat(F.lower(short), F.lit("/"), F.date_format(d, "yy")).alias("MesAno"),
        F.month(d).alias("MesNum"),
        (F.year(d) * 100 + F.month(d)).alias("AnoMesINT"),
        F.concat(F.date_format(F.trunc(d, "month"), "yyyy-MM-dd"), F.lit(" 00:00:00")).alias("InicioMes"),
        F.quarter(d).alias("Trimestre"),
        F.concat(F.quarter(d), F.lit("º Trim")).alias("TrimestreAbreviado"),
        F.concat(bimester, F.lit("º Bim")).alias("Bimestre"),
        F.concat(semester, F.lit("º Sem")).alias("Semestre"),
        F.weekofyear(d).alias("Semana"),
        (F.weekday(d) + 1).alias("DiaSemana"),
        _pick(WEEKDAYS, F.weekday(d) + 1).alias("NomeDia"),
    ]


def whole_days(start: Column | str, end: Column | str) -> Column:
    """Whole days elapsed between two timestamps, rounded down."""
    seconds = F.timestamp_diff("SECOND", as_col(start), as_col(end))
    return F.floor(seconds / F.lit(86400)).cast("bigint")
