"""Telephone call records with their nested parts as text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import day_text, moment, try_stamp
from ..functions.text import listed_text
from ..operators.aggregates import freshness
from ..operators.quality import require_complete
from ..sources.pages import read_pages, records
from ..sources.schemas import CALL

# The flattened attributes, and the two that are renamed in the table.
ATTENDANCE = ("tipo", "tempoEspera", "tempoAtendimento", "atendidaAte60Seg", "desistenciaAte60Seg",
              "atendidaPos60Seg", "desistenciaPos60Seg")
CALLER = ("origem", "cadastroLocalizadoEAF", "uf", "ddd", "codigoCidadeIBGE", "cpf", "cep", "telefone")
RENAMED = {"tempoEspera": "tempoEspera_ms", "tempoAtendimento": "tempoAtendimento_ms"}
NESTED = ("atendimento", "interlocutor", "csv")


def call_records(spark: SparkSession, path: str, one_per_line: bool = False, record: T.StructType = CALL) -> DataFrame:
    """The call records of all landed pages; refused when a page is damaged or one of the declared pages is missing."""
    return records(require_complete(read_pages(spark, path, record, "content", one_per_line), "calls"))


def call_log(calls: DataFrame, as_of, fix_cpf: bool = False) -> DataFrame:
    """Header fields, seven attendance lists, eight caller fields and the load date.

    A record without a usable nested part gets nulls there and stays. The caller's ``cpf`` column
    holds the city code, as in the established table, unless ``fix_cpf``.
    """
    header = [try_stamp(c).alias(c) if c in ("dataHoraInicio", "dataHoraFim") else F.col(c)
              for c in calls.columns if c not in NESTED]
    visits = [listed_text(F.col("atendimento")[a]).alias(RENAMED.get(a, a)) for a in ATTENDANCE]
    caller = F.col("interlocutor")
    person = []
    for name in CALLER:
        source = "codigoCidadeIBGE" if name == "cpf" and not fix_cpf else name
        text = listed_text(F.array(caller[source]))
        person.append(F.when(caller.isNotNull(), text).alias(name))
    return calls.select(*header, day_text(moment(as_of)).alias("data_atualizacao"), *visits, *person)


def call_freshness(table: DataFrame, as_of, limit: int = 2) -> DataFrame:
    return freshness(table, "dataHoraInicio", as_of, limit)
