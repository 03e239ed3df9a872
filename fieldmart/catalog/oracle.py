"""Equivalent SQL per registered query, for an independent engine on the same tables.

``PARTS`` are named subqueries for the derived inputs; each query lists the ones it uses.
"""

from __future__ import annotations

import re


PARTS: dict[str, str] = {}
SQL: dict[str, str] = {}


def part(name: str, body: str) -> None:
    PARTS[name] = body.strip()


def query(name: str, uses: str, body: str) -> None:
    listed = ",\n".join(f"{p} AS (\n{PARTS[p]}\n)" for p in uses.split())
    SQL[name] = f"WITH RECURSIVE {listed}\n{body.strip()}" if listed else body.strip()


# --- city demand alerts -------------------------------------------------------------------------

part("aged", """
SELECT *, DATE '2001-11-04' - CAST(
         (date_diff('day', CAST(l_shipdate AS DATE), DATE '2001-11-04')
          * date_diff('day', CAST(l_shipdate AS DATE), DATE '2001-11-04')) // 300000 AS INTEGER) AS created
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
""")
part("tickets", """
SELECT CAST(s_nationkey AS VARCHAR) AS IBGE,
       CAST(l_orderkey AS VARCHAR) AS IDdoticket,
       CASE WHEN l_tax > 0.075 THEN 'Question' ELSE 'Service Task' END AS Tipo,
       CASE WHEN l_linestatus = 'O' THEN 'IN_PROGRESS' WHEN l_returnflag IN ('R', 'A') THEN 'INSTALLED'
            WHEN l_linenumber = 1 THEN 'BACKOFFICE' WHEN l_linenumber = 2 THEN 'IN_CORRECTION'
            WHEN l_linenumber = 3 THEN 'IN_AUDITING' WHEN l_linenumber = 4 THEN 'CANCELLED'
            WHEN l_linenumber = 5 THEN 'VALIDATION' ELSE 'INSTALLED' END AS Status,
       CASE WHEN l_linestatus = 'O' THEN NULL WHEN l_returnflag = 'R' THEN 'Instalada'
            WHEN l_returnflag = 'A' THEN 'Executado - Procedente' END AS StatusdaInstalacao,
       CASE WHEN l_discount < 0.065 THEN 'Agendamento' WHEN l_discount < 0.085 THEN 'Interferência'
            WHEN l_discount < 0.095 THEN 'Contestação' ELSE 'Manutenção' END AS Motivo,
       created AS Horadacriacao,
       CASE WHEN l_linenumber < 7 THEN created + (l_linenumber * 4 - 8) END AS DataHoraAgendamento,
       CAST(l_partkey AS VARCHAR) AS CPF,
       CASE WHEN l_linenumber = 1 THEN 'F-' || l_suppkey ELSE CAST(l_suppkey AS VARCHAR) END AS CodFamilia,
       s_name AS Instaladora, s_nationkey
FROM aged
""")
part("people", "SELECT c_nationkey, count(*) AS people FROM customer GROUP BY c_nationkey")
part("cities", """
SELECT CAST(n_nationkey AS VARCHAR) AS cIBGE, r_name AS regiao, 'R' || n_regionkey AS uf, n_name AS nome_cidade,
       'Fase ' || n_regionkey AS fase, people * (n_nationkey * 3 + 20) AS domicilios_particulares
FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN people ON c_nationkey = n_nationkey
""")
part("families", """
SELECT CAST(n_nationkey AS VARCHAR) AS ibge, people * (n_nationkey * 2 + 25) AS qtd_cadunico
FROM nation LEFT JOIN people ON c_nationkey = n_nationkey
""")
part("starts", """
SELECT CAST(n_nationkey AS VARCHAR) AS ibge,
       CAST(DATE '2001-11-04' + to_months(2 - n_nationkey) AS DATE) AS start FROM nation
""")
part("curves", """
SELECT ibge, curva FROM (
  SELECT ibge, CASE WHEN m >= 9 THEN 'Long Tail' WHEN m >= 3 THEN 'Decrescente' WHEN m >= 0 THEN 'Crescente' END AS curva
  FROM (SELECT ibge, (2001 - year(start)) * 12 + 11 - month(start) AS m FROM starts))
WHERE curva IS NOT NULL
""")
_open = "Tipo = 'Service Task' AND Status = 'IN_PROGRESS' AND StatusdaInstalacao IS NULL"
_inst = ("Tipo = 'Service Task' AND Status = 'INSTALLED' AND StatusdaInstalacao = 'Instalada' "
         "AND Motivo IN ('Agendamento', 'Interferência')")
_book = ("Motivo IN ('Agendamento', 'Interferência') AND Status NOT IN ('CANCELLED', 'CANCELLED_NOT_DELIVERED', "
         "'INSTALLER_INTEGRATION_ERROR', 'VALIDATION') AND DataHoraAgendamento IS NOT NULL")
_now, _then = "Horadacriacao <= DATE '2001-11-04'", "Horadacriacao <= DATE '2001-10-25'"
_future, _late = "DataHoraAgendamento >= DATE '2001-11-04'", "DataHoraAgendamento < DATE '2001-11-04'"
part("counts", f"""
SELECT IBGE AS ibge,
  count(*) FILTER (WHERE {_open} AND {_future} AND {_then}) AS backlog_futuro_semana_anterior,
  count(*) FILTER (WHERE {_open} AND {_future} AND {_now}) AS backlog_futuro_semana_atual,
  count(*) FILTER (WHERE {_open} AND {_late} AND {_then}) AS backlog_semana_anterior,
  count(*) FILTER (WHERE {_open} AND {_late} AND {_now}) AS backlog_semana_atual,
  count(*) FILTER (WHERE {_inst} AND {_then}) AS instalados_semana_anterior,
  count(*) FILTER (WHERE {_inst} AND {_now}) AS instalados_semana_atual,
  count(IDdoticket) FILTER (WHERE {_book} AND IBGE <> ''
        AND Horadacriacao BETWEEN DATE '2001-10-19' AND DATE '2001-10-25') AS new_agendados_semana_anterior,
  count(IDdoticket) FILTER (WHERE {_book}
        AND Horadacriacao BETWEEN DATE '2001-10-26' AND DATE '2001-11-01') AS new_agendados_semana_atual
FROM tickets GROUP BY IBGE
""")
part("wide", """
SELECT cIBGE AS ibge, regiao, uf, nome_cidade, fase,
  coalesce(instalados_semana_anterior, 0) + coalesce(backlog_semana_anterior, 0)
    + coalesce(backlog_futuro_semana_anterior, 0) AS iba_semana_anterior,
  coalesce(instalados_semana_atual, 0) + coalesce(backlog_semana_atual, 0)
    + coalesce(backlog_futuro_semana_atual, 0) AS iba_semana_atual,
  coalesce(qtd_cadunico, 0) AS qtd_cadunico, curva,
  coalesce(new_agendados_semana_anterior, 0) AS new_agendados_semana_anterior,
  CASE WHEN new_agendados_semana_atual > 0 THEN coalesce(domicilios_particulares, 0) ELSE 0 END AS qtd_domicilios,
  coalesce(new_agendados_semana_atual, 0) AS new_agendados_semana_atual
FROM cities LEFT JOIN counts ON counts.ibge = cIBGE LEFT JOIN families ON families.ibge = cIBGE
LEFT JOIN curves ON curves.ibge = cIBGE
""")
part("ratios", """
SELECT *,
  CASE WHEN new_agendados_semana_atual - new_agendados_semana_anterior <= 50 THEN 0.0::DOUBLE
       WHEN new_agendados_semana_anterior = 0 THEN 1.0::DOUBLE
       ELSE (new_agendados_semana_atual - new_agendados_semana_anterior)::DOUBLE / new_agendados_semana_anterior
  END AS variacao_agendamentos_semana,
  CASE WHEN qtd_cadunico <> 0 THEN iba_semana_anterior::DOUBLE / qtd_cadunico ELSE 0 END AS porcentagem_iba_cadunico_semana_anterior,
  CASE WHEN qtd_domicilios <> 0 THEN iba_semana_anterior::DOUBLE / qtd_domicilios ELSE 0 END AS porcentagem_iba_domicilios_semana_anterior,
  CASE WHEN qtd_cadunico <> 0 THEN iba_semana_atual::DOUBLE / qtd_cadunico ELSE 0 END AS porcentagem_iba_cadunico_semana_atual,
  CASE WHEN qtd_domicilios <> 0 THEN iba_semana_atual::DOUBLE / qtd_domicilios ELSE 0 END AS porcentagem_iba_domicilios_semana_atual
FROM wide
""")
part("risks", """
SELECT *, porcentagem_iba_domicilios_semana_anterior * 0.5::DOUBLE + porcentagem_iba_cadunico_semana_anterior * 0.5::DOUBLE
            AS porcentagem_de_risco_semana_anterior,
          porcentagem_iba_domicilios_semana_atual * 0.5::DOUBLE + porcentagem_iba_cadunico_semana_atual * 0.5::DOUBLE
            AS porcentagem_de_risco_semana_atual,
          CASE curva WHEN 'Crescente' THEN 0.4 WHEN 'Decrescente' THEN 0.2 WHEN 'Long Tail' THEN 0.3 END AS lim
FROM ratios
""")
part("colours", """
SELECT * EXCLUDE (lim), CASE WHEN variacao_agendamentos_semana > lim THEN
    CASE WHEN a < 0.5 AND b < 0.5 THEN 'Comunicado - Verde'
         WHEN a < 0.5 AND b < 0.8 THEN 'Alerta - Amarelo'
         WHEN a < 0.8 AND b < 0.8 THEN 'Comunicado - Amarelo'
         WHEN a < 0.8 AND b > 0.8 THEN 'Alerta - Vermelho'
         WHEN a > 0.8 AND b > 0.8 THEN 'Alerta - Vermelho Crítico' END END AS calculo_prevencao
FROM (SELECT *, porcentagem_de_risco_semana_anterior AS a, porcentagem_de_risco_semana_atual AS b FROM risks)
""")
part("levels", """
SELECT * EXCLUDE (a, b), CASE calculo_prevencao WHEN 'Comunicado - Verde' THEN 1 WHEN 'Alerta - Amarelo' THEN 2
    WHEN 'Comunicado - Amarelo' THEN 3 WHEN 'Alerta - Vermelho' THEN 4 WHEN 'Alerta - Vermelho Crítico' THEN 5
    ELSE 0 END AS nivel_calculo_prevencao
FROM colours
""")
part("alerts", """
SELECT * FROM levels
WHERE nivel_calculo_prevencao >= 2 AND curva <> 'Decrescente'
  AND NOT (regiao = 'ASIA' AND calculo_prevencao = 'Alerta - Amarelo')
""")
_city = "aged tickets people cities families starts curves counts wide"
_risk = _city + " ratios risks colours levels"

query("kpi_conditional_sums", "aged tickets counts", """
SELECT * FROM counts WHERE backlog_futuro_semana_anterior + backlog_futuro_semana_atual + backlog_semana_anterior
  + backlog_semana_atual + instalados_semana_anterior + instalados_semana_atual + new_agendados_semana_anterior
  + new_agendados_semana_atual > 0
""")
query("campaign_curves", "starts curves", "SELECT * FROM curves")
query("dim_left_chain", _city, "SELECT * FROM wide")
query("risk_and_alert", _risk, """
SELECT * EXCLUDE (regiao, uf, fase) REPLACE (
  round(variacao_agendamentos_semana, 9) AS variacao_agendamentos_semana,
  round(porcentagem_iba_cadunico_semana_anterior, 9) AS porcentagem_iba_cadunico_semana_anterior,
  round(porcentagem_iba_domicilios_semana_anterior, 9) AS porcentagem_iba_domicilios_semana_anterior,
  round(porcentagem_iba_cadunico_semana_atual, 9) AS porcentagem_iba_cadunico_semana_atual,
  round(porcentagem_iba_domicilios_semana_atual, 9) AS porcentagem_iba_domicilios_semana_atual,
  round(porcentagem_de_risco_semana_anterior, 9) AS porcentagem_de_risco_semana_anterior,
  round(porcentagem_de_risco_semana_atual, 9) AS porcentagem_de_risco_semana_atual)
FROM levels
""")
query("demand_alert_batch", _risk + " alerts", """
SELECT ibge AS "IBGE", regiao AS "Região", uf AS "UF", nome_cidade AS "Município", fase AS "Fase", curva AS "Curva",
  new_agendados_semana_anterior AS "Agendamentos Semana Anterior",
  new_agendados_semana_atual AS "Agendamentos Semana Atual",
  round(variacao_agendamentos_semana, 9) AS "% Variação Agendamentos Semana",
  round(porcentagem_de_risco_semana_anterior, 9) AS "% Risco Semana Anterior",
  round(porcentagem_de_risco_semana_atual, 9) AS "% Risco Semana Atual", calculo_prevencao AS "Cor do alerta"
FROM alerts
""")
query("demand_alert_ledger", _risk + " alerts", """
SELECT ibge, nome_cidade, calculo_prevencao, nivel_calculo_prevencao AS nivel_alerta, '04-11-2001' AS data_alerta
FROM alerts
""")
query("demand_alert_run", _risk + " alerts", """
SELECT '2001-11-03 21:00:00.000000' AS "dataHora_disparo", count(*) AS qtd_cidades FROM alerts HAVING count(*) > 0
""")

# --- indicator history --------------------------------------------------------------------------

part("phase", """
SELECT IBGE AS ibge, 'R' || n_regionkey AS uf, n_name AS municipio, 'Fase ' || n_regionkey AS fase,
       Instaladora AS instaladora, Motivo AS motivo_contato, Status, StatusdaInstalacao, Horadacriacao,
       DataHoraAgendamento, IDdoticket
FROM tickets JOIN nation ON s_nationkey = n_nationkey
""")
_keys = "instaladora, ibge, uf, municipio, fase, motivo_contato"


def _rule(label: str, where: str, hidden: str = "") -> str:
    return (f"SELECT {_keys}, '{label}' AS regra, count(*) AS quantidade, '04-11-2001' AS data_registro "
            f"FROM phase WHERE {where} GROUP BY {_keys}{hidden}")


query("kpi_union_snapshot", "aged tickets phase", "\nUNION ALL\n".join([
    _rule("Criados", "Horadacriacao = DATE '2001-11-04'"),
    _rule("Em aberto", "Status = 'IN_PROGRESS'", ", Horadacriacao"),
    _rule("Backlog", "Status = 'IN_PROGRESS' AND DataHoraAgendamento < DATE '2001-11-04'"),
    _rule("Instalados", "Status = 'INSTALLED' AND StatusdaInstalacao = 'Instalada' "
                        "AND motivo_contato IN ('Agendamento', 'Interferência')"),
]))
query("kpi_distinct_by_status", "aged tickets phase", """
SELECT count(DISTINCT IDdoticket) FILTER (WHERE Status = 'IN_CORRECTION') AS qtd_correcao,
       count(DISTINCT IDdoticket) FILTER (WHERE Status = 'IN_AUDITING') AS qtd_auditoria,
       count(DISTINCT IDdoticket) FILTER (WHERE Status = 'INSTALLED' AND StatusdaInstalacao <> 'Instalada') AS qtd_improdutiva,
       count(DISTINCT IDdoticket) FILTER (WHERE Status = 'BACKOFFICE') AS qtd_backoffice,
       '04-11-2001' AS data_registro
FROM phase
""")

query("kpi_distinct_sketch", "aged tickets phase", """
SELECT count(DISTINCT IDdoticket) > 0 AS qtd_correcao, count(DISTINCT IDdoticket) > 0 AS qtd_auditoria,
  count(DISTINCT IDdoticket) > 0 AS qtd_improdutiva, count(DISTINCT IDdoticket) > 0 AS qtd_backoffice FROM phase
""")
query("kpi_distinct_over_days", "aged tickets phase", """
SELECT desde, Status, count(DISTINCT IDdoticket) AS quantidade
FROM phase JOIN (VALUES ('1990-01-01'), ('1999-01-01'), ('2001-01-01')) AS d(desde) ON Horadacriacao >= CAST(desde AS DATE) GROUP BY desde, Status
""")

# --- duplicates ---------------------------------------------------------------------------------

part("pairs", """
SELECT 'F' || c_custkey AS "OsFresh", 'Instalada' AS "StatusInstalacaoFresh", CAST(c_nationkey AS VARCHAR) AS "IBGE_Fresh",
  DATE '2000-01-01' + CAST(floor(c_acctbal / 30) AS INTEGER) AS "DataInstalacaoFresh",
  CASE WHEN g.n_regionkey > 0 THEN 'Crew ' || g.n_name END AS "InstaladoraFresh", c_name AS "NomeFresh",
  CAST(c_custkey AS VARCHAR) AS "CPF_Fresh",
  year(o_orderdate) || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS "OsCRM_EAF",
  CASE WHEN o_orderstatus = 'O' THEN 'OPEN' ELSE 'PENDING' END AS "StatusCRM_EAF",
  o_orderpriority AS "StatusInstalacaoCRM_EAF", CAST(o_orderdate AS DATE) AS "CriacaoCRM_EAF",
  CAST(o_orderdate AS DATE) + 2 AS "DataAgendamentoCRM_EAF", 'Name ' || o_custkey AS "NomeCRM_EAF",
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN CASE WHEN c_acctbal > 0 THEN CAST(c_nationkey AS VARCHAR) END
       ELSE 'B' || o_custkey END AS "IBGE_CRM_EAF",
  'crew' AS "InstaladoraCRM_EAF", CAST(c_custkey AS VARCHAR) AS "CPF_CRM_EAF", 'Fase ' || g.n_regionkey AS "FaseCidade"
FROM customer JOIN orders ON c_custkey = o_custkey LEFT JOIN nation g ON g.n_nationkey = c_nationkey
WHERE c_mktsegment NOT IN ('BUILDING', 'FURNITURE') AND c_acctbal >= 0
  AND year(o_orderdate) BETWEEN 1990 AND 1999 AND o_orderstatus <> 'F' AND o_orderpriority <> '5-LOW'
""")
part("newpairs", """
SELECT * FROM pairs WHERE NOT ("StatusInstalacaoCRM_EAF" = '1-URGENT' AND year("CriacaoCRM_EAF") = 1998)
""")
query("duplicate_order_pairs", "pairs", "SELECT * FROM pairs")
query("crowded_people", "pairs", """
SELECT "CPF_Fresh" AS person, CAST(count(DISTINCT "OsFresh") AS BIGINT) AS n_legacy, count(DISTINCT "OsCRM_EAF") AS n_orders
FROM pairs GROUP BY 1 HAVING count(DISTINCT "OsFresh") * count(DISTINCT "OsCRM_EAF") > 8
""")
query("new_duplicate_pairs", "pairs newpairs", "SELECT * FROM newpairs")
query("pair_once_capped", "pairs newpairs", 'SELECT * FROM newpairs ORDER BY "OsFresh", "OsCRM_EAF" LIMIT 11')
query("duplicate_run", "pairs newpairs", """
SELECT '2001-11-03 21:00:00.000000' AS "dataHora_disparo", count(*) AS qtd_alertas FROM newpairs HAVING count(*) > 0
""")

# --- documents ----------------------------------------------------------------------------------

part("services", """
SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority, 0 AS pos, o_orderkey AS number,
  CASE o_orderstatus WHEN 'O' THEN 'OPEN' WHEN 'P' THEN 'PENDING' ELSE 'DONE' END AS status,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'Manutenção - Problema técnico' ELSE 'Agendamento' END AS type,
  o_orderdate + INTERVAL 9 HOUR AS registered,
  CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 75 HOUR END AS ended, o_totalprice
FROM orders
UNION ALL
SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority, 1, o_orderkey + 1000000000000, 'IN_VALIDATION',
  CASE WHEN o_orderpriority = '2-HIGH' THEN 'Manutenção - Problema técnico' ELSE 'Agendamento' END,
  o_orderdate + INTERVAL 30 DAY, o_orderdate + INTERVAL 31 DAY, o_totalprice
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
""")
part("firstline", """
SELECT l_orderkey, status FROM (
  SELECT l_orderkey, CASE WHEN l_linestatus = 'O' THEN 'OPEN' ELSE 'DONE' END AS status,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey,
                       CASE WHEN l_linestatus = 'O' THEN 'OPEN' ELSE 'DONE' END) AS rn
  FROM lineitem) WHERE rn = 1
""")
part("compared", """
SELECT CAST(number AS VARCHAR) AS nro_os, s.status AS status_mongo,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS created_at, f.status AS status_sql,
  CASE WHEN f.l_orderkey IS NULL THEN 'missing' WHEN s.status <> f.status THEN 'diverges' ELSE 'equal' END AS outcome
FROM services s LEFT JOIN firstline f ON f.l_orderkey = s.number
""")
_rec = "services firstline compared"
query("reconcile_status", _rec, "SELECT * FROM compared")
query("reconcile_recent", _rec, "SELECT * FROM compared WHERE created_at >= '1999-08-02 00:00:00'")
query("reconcile_diverging", _rec, """
SELECT nro_os, status_mongo, status_sql, created_at FROM compared WHERE outcome = 'diverges'
""")
query("reconcile_missing", _rec, "SELECT nro_os, status_mongo, created_at FROM compared WHERE outcome = 'missing'")
query("reconcile_counters", _rec, """
SELECT count(*) AS analysed, count(*) FILTER (WHERE outcome = 'diverges') AS diverges,
       count(*) FILTER (WHERE outcome = 'missing') AS missing FROM compared
""")
query("analysed_order_listing", "services", """
SELECT CASE WHEN length(id) > 3 THEN left(id, length(id) - 3) ELSE '' END || repeat('?', least(3, length(id))) AS block,
  string_agg(id, ', ' ORDER BY id) AS ids
FROM (SELECT DISTINCT unnest([n, '00' || n, 'A-' || n, n || repeat('9', 40)]) AS id FROM (SELECT CAST(number AS VARCHAR) AS n FROM services))
GROUP BY length(id), 1
""")
_pending = """
SELECT CAST(number AS VARCHAR) AS "nro OS", type, status, strftime(registered, '%Y-%m-%d %H:%M:%S') AS "registeredAt",
  CASE WHEN pos = 0 AND o_orderpriority <> '5-LOW' THEN 'I' || o_custkey END AS installer,
  CASE WHEN pos = 0 AND o_orderpriority = '2-HIGH' THEN 'client''s absence' ELSE 'NULL' END AS "failureReason",
  CASE WHEN o_orderpriority = '5-LOW' THEN 'NULL' ELSE 'agent' || o_custkey END AS "createdBy"
FROM services
WHERE status IN ('OPEN', 'PENDING', 'IN_VALIDATION') AND registered <= TIMESTAMP '2001-07-31 19:00:00'
"""
query("pending_order_report", "services", _pending)
query("csv_report_rows", "services", _pending)
query("csv_comma_rows", "services", _pending)
query("csv_plain_rows", "services", _pending)
query("sibling_lookup", "services", """
SELECT CAST(m.number AS VARCHAR) AS nro_os_manutencao,
  strftime(m.registered, '%Y-%m-%d %H:%M:%S') AS registered_at_manutencao,
  CASE WHEN m.o_orderpriority = '3-MEDIUM' THEN 'NULL' ELSE CAST(m.o_custkey AS VARCHAR) END AS customer_cpf,
  CAST(v.number AS VARCHAR) AS os_vizinha_number, v.type AS os_vizinha_type,
  strftime(v.ended, '%Y-%m-%d %H:%M:%S') AS appointment_end_time,
  CAST(floor(epoch(TIMESTAMP '2001-08-01' - v.ended) / 86400) AS BIGINT) AS dias_desde_appointment
FROM services m JOIN (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY pos) AS rn FROM services
  WHERE ended < TIMESTAMP '2001-08-01' - INTERVAL 90 DAY) v ON v.o_orderkey = m.o_orderkey AND v.rn = 1
WHERE m.type = 'Manutenção - Problema técnico'
""")
part("asked", "SELECT DISTINCT l_orderkey FROM lineitem WHERE l_quantity > 40")
part("exported", """
SELECT CAST(number AS VARCHAR) AS number, 'P-' || number AS proto, * EXCLUDE (number)
FROM services JOIN asked ON l_orderkey = number
""")
_stamp = "'%Y-%m-%d %H:%M:%S.%f'"
_nulls = ("installer_response_equipment_serial_number customer_family_code customer_nis customer_email "
          "customer_postal_code customer_address_reference installer_response_appointment_start_time notation "
          "installer_response_representant_cpf installer_response_representant_name installer_response_evidence "
          "installer_response_technician_id isntaller_response_caid_equipment installer_response_scid_equipment "
          "installer_response_lat_long_installation").split()
_visit = "CASE WHEN o_orderpriority <> '5-LOW' THEN 'I' || o_custkey END"
_reason = "CASE WHEN o_orderpriority = '2-HIGH' THEN 'client''s absence' ELSE 'N/A' END"
query("order_export_rows", "services asked exported", f"""
SELECT number AS protocol_number, strftime(o_orderdate, {_stamp}) AS protocol_created_at, 'phone' AS protocol_channel,
  status AS service_order_status, type AS service_order_type, strftime(registered, {_stamp}) AS service_order_created_at,
  CASE WHEN o_orderpriority <> '5-LOW' THEN strftime(o_orderdate + INTERVAL 2 DAY, {_stamp}) END AS schedule_date_time,
  {_visit} AS installer, {_visit} AS schedule_installer,
  strftime(ended, {_stamp}) AS installer_response_appointment_end_time,
  CASE WHEN ended IS NOT NULL THEN 'it''s done' END AS installer_response_classification,
  strftime(o_orderdate, {_stamp}) AS last_modified_date, 'Name ' || o_custkey AS customer_name,
  CASE WHEN o_orderpriority <> '3-MEDIUM' THEN CAST(o_custkey AS VARCHAR) END AS customer_cpf,
  CAST(o_custkey AS VARCHAR) AS customer_phone, CAST(o_custkey AS VARCHAR) AS customer_ibge,
  'Rua, ' || o_custkey || ' - None - None - None , Cidade-None' AS customer_full_address,
  o_orderpriority AS tabulation, {_reason} AS failure_reason, '2001-08-01 00:00:00.000000' AS synched_at,
  CASE WHEN ended IS NOT NULL THEN CAST(o_totalprice > 250000 AS VARCHAR) END AS installer_response_pta,
  {", ".join(f"CAST(NULL AS VARCHAR) AS {n}" for n in _nulls)}
FROM exported
""")


def _set(name: str, value: str) -> str:
    return f"'[{name}] = ' || {value}"


def _q(value: str) -> str:
    return f"coalesce('''' || replace({value}, '''', '''''') || '''', 'NULL')"


_sec = "'%Y-%m-%d %H:%M:%S'"
_updates = [
    ("protocol_number", _q("number")), ("protocol_created_at", _q(f"strftime(o_orderdate, {_sec})")),
    ("protocol_channel", "'''phone'''"), ("notation", "'NULL'"), ("service_order_status", _q("status")),
    ("service_order_type", _q("type")), ("service_order_created_at", _q(f"strftime(registered, {_sec})")),
    ("schedule_date_time", _q(f"CASE WHEN o_orderpriority <> '5-LOW' THEN strftime(o_orderdate + INTERVAL 2 DAY, {_sec}) END")),
    ("installer", _q(_visit)), ("schedule_installer", _q(_visit)),
    ("installer_response_appointment_end_time", _q(f"strftime(ended, {_sec})")),
    ("installer_response_equipment_serial_number", "'NULL'"),
    ("installer_response_classification", _q("CASE WHEN ended IS NOT NULL THEN 'it''s done' END")),
    ("last_modified_date", _q(f"strftime(o_orderdate, {_sec})")), ("customer_name", _q("'Name ' || o_custkey")),
    ("customer_cpf", _q("CASE WHEN o_orderpriority <> '3-MEDIUM' THEN CAST(o_custkey AS VARCHAR) END")),
    ("customer_phone", _q("CAST(o_custkey AS VARCHAR)")), ("customer_family_code", "'NULL'"), ("customer_nis", "'NULL'"),
    ("customer_email", "'NULL'"), ("customer_ibge", _q("CAST(o_custkey AS VARCHAR)")),
    ("customer_postal_code", "'NULL'"),
    ("customer_full_address", _q("'Rua, ' || o_custkey || ' - None - None - None , Cidade-None'")),
    ("customer_address_reference", "'NULL'"), ("tabulation", _q("o_orderpriority")), ("failure_reason", _q(_reason)),
    ("synched_at", "'''2001-08-01 00:00:00'''"), ("installer_response_appointment_start_time", "'NULL'"),
    ("installer_response_representant_cpf", "'NULL'"), ("installer_response_representant_name", "'NULL'"),
    ("installer_response_evidence", "'NULL'"), ("installer_response_technician_id", "'NULL'"),
    ("isntaller_response_caid_equipment", "'NULL'"), ("installer_response_scid_equipment", "'NULL'"),
    ("installer_response_lat_long_installation", "'NULL'"),
    ("installer_response_pta", _q("CASE WHEN ended IS NOT NULL THEN CAST(o_totalprice > 250000 AS VARCHAR) END")),
]
_statement = ("SELECT 'UPDATE crm_ticket_data SET ' || "
              + " || ', ' || ".join(_set(n, v) for n, v in _updates)
              + " || ' WHERE [service_order_number] = ''' || number || ''';' AS value FROM exported")
query("sql_text_export", "services asked exported", _statement)
query("text_report_lines", "services asked exported", _statement)
query("orders_not_found", "asked", "SELECT CAST(l_orderkey + 2000000000000 AS VARCHAR) AS number FROM asked")
query("titled_list_lines", "asked", """
SELECT CAST(l_orderkey + 2000000000000 AS VARCHAR) AS value FROM asked UNION ALL SELECT 'OSs não encontradas:'
""")
query("parameter_list_rows", "", """
SELECT CAST(p_partkey AS VARCHAR) AS number FROM part UNION ALL SELECT CAST(p_size AS VARCHAR) FROM part
""")

# --- sessions -----------------------------------------------------------------------------------

part("logins", """
SELECT 'User ' || user_id AS "user", user_id, ts, event_id, event_type = 'error' AS is_stop, CAST(ts AS DATE) AS day
FROM events WHERE event_type IN ('signup', 'error')
""")


def _paired(keys: str) -> str:
    return f"""
SELECT * FROM (
  SELECT *, lag(is_stop) OVER w AS prev_stop,
    min(CASE WHEN is_stop THEN ts END) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS stopped
  FROM logins WINDOW w AS (PARTITION BY {keys} ORDER BY ts, event_id))
WHERE NOT is_stop AND (stopped IS NULL OR coalesce(prev_stop, true))
"""


part("paired", _paired("user_id"))
part("pairedbyday", _paired("user_id, day"))
query("session_pairing", "logins paired", f"""
SELECT "user", strftime(ts, {_stamp}) AS started, strftime(stopped, {_stamp}) AS stopped FROM paired
""")
query("login_logout_report", "logins paired", """
SELECT "user" AS usuario, strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d') AS data,
  strftime(ts - INTERVAL 3 HOUR, '%H:%M:%S') AS "horario entrada",
  coalesce(strftime(stopped - INTERVAL 3 HOUR, '%H:%M:%S'), 'N/A') AS "horario saida"
FROM paired WHERE user_id NOT IN (7, 11)
""")
query("stream_session_pairing", "logins pairedbyday", f"""
SELECT "user", day, strftime(ts, {_stamp}) AS started, strftime(stopped, {_stamp}) AS stopped FROM pairedbyday
""")

query("stream_once_within", "", "SELECT DISTINCT user_id, event_type FROM events")
query("stream_open_sessions", "logins pairedbyday", f"""
SELECT "user", day, strftime(ts, {_stamp}) AS started, strftime(stopped, {_stamp}) AS stopped FROM pairedbyday
WHERE day < (SELECT CAST(max(ts) - INTERVAL 1 HOUR AS DATE) FROM logins)
""")

# --- calendar and rates -------------------------------------------------------------------------

part("quotes", """
SELECT CAST(CAST(max(o_totalprice) AS DECIMAL(18, 2)) AS DOUBLE) AS "CotacaoUSD",
       CAST(CAST(min(o_totalprice) AS DECIMAL(18, 2)) AS DOUBLE) AS "CotacaoEUR",
       CAST(CAST(max(o_totalprice) / 2 AS DECIMAL(18, 2)) AS DOUBLE) AS "CotacaoGBP" FROM orders
""")
part("fx", """
SELECT CAST(o_orderdate AS DATE) AS "Data", max(o_totalprice) / 1000 AS "CotacaoUSD",
       min(o_totalprice) / 1000 AS "CotacaoEUR", max(o_totalprice) / 2000 AS "CotacaoGBP"
FROM orders GROUP BY CAST(o_orderdate AS DATE)
""")
_months = "['Janeiro','Fevereiro','Março','Abril','Maio','Junho','Julho','Agosto','Setembro','Outubro','Novembro','Dezembro']"
_days = "['segunda-feira','terça-feira','quarta-feira','quinta-feira','sexta-feira','sábado','domingo']"


def _calendar(d: str) -> str:
    return f"""CAST(year({d}) AS INTEGER) AS "Ano", {_months}[month({d})] AS "NomeMes",
  left({_months}[month({d})], 3) AS "MesAbre",
  lower(left({_months}[month({d})], 3)) || '/' || strftime({d}, '%y') AS "MesAno",
  CAST(month({d}) AS INTEGER) AS "MesNum", CAST(year({d}) * 100 + month({d}) AS INTEGER) AS "AnoMesINT",
  strftime(date_trunc('month', {d}), '%Y-%m-%d') || ' 00:00:00' AS "InicioMes",
  CAST(quarter({d}) AS INTEGER) AS "Trimestre", quarter({d}) || 'º Trim' AS "TrimestreAbreviado",
  (month({d}) + 1) // 2 || 'º Bim' AS "Bimestre", CASE WHEN month({d}) <= 6 THEN '1º Sem' ELSE '2º Sem' END AS "Semestre",
  CAST(weekofyear({d}) AS INTEGER) AS "Semana", CAST(isodow({d}) AS INTEGER) AS "DiaSemana",
  {_days}[isodow({d})] AS "NomeDia\""""


part("gaps", """
SELECT CAST(unnest(generate_series((SELECT max("Data") + 1 FROM fx), DATE '2001-09-30', INTERVAL 1 DAY)) AS DATE) AS "Data"
""")
part("filled", f"""
SELECT "Data", {_calendar('"Data"')}, "CotacaoUSD", "CotacaoEUR", "CotacaoGBP" FROM gaps, quotes
""")
part("repaired", f"""
SELECT * FROM filled UNION ALL SELECT "Data", {_calendar('"Data"')}, "CotacaoUSD", "CotacaoEUR", "CotacaoGBP" FROM fx
""")
query("latest_quotes", "quotes", "SELECT * FROM quotes")
query("calendar_gap_fill", "quotes fx gaps filled", "SELECT * FROM filled")
query("calendar_repair", "quotes fx gaps filled repaired", "SELECT * FROM repaired")
query("upsert_by_join", "quotes fx gaps filled repaired", """
SELECT * REPLACE ("CotacaoGBP" * 2 AS "CotacaoGBP"), CAST(NULL AS VARCHAR) AS "DataAtualizacao" FROM repaired
""")
query("insert_if_absent", "quotes fx", """
SELECT DATE '2001-09-30' AS "Data", "CotacaoUSD", "CotacaoEUR", "CotacaoGBP",
       '2001-09-30 00:00:00.000000' AS "DataAtualizacao"
FROM quotes WHERE NOT EXISTS (SELECT 1 FROM fx WHERE "Data" = DATE '2001-09-30')
""")
query("calendar_attributes", "", f"""
SELECT "Data", {_calendar('"Data"')} FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS "Data" FROM orders)
""")

# --- channel metrics, chatbot, campaigns, calls ----------------------------------------------------

part("metrics", """
SELECT a.d AS data, a.n AS ativos, e.n AS engajados
FROM (SELECT CAST(ts AS DATE) AS d, count(DISTINCT user_id) AS n FROM events GROUP BY 1) a
LEFT JOIN (SELECT CAST(ts AS DATE) AS d, count(DISTINCT user_id) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1) e
  ON a.d = e.d
""")
query("metric_series_join", "metrics", "SELECT * FROM metrics")
query("window_replace", "metrics", """
SELECT CAST(ts AS DATE) AS data, count(*) AS ativos, count(*) FILTER (WHERE event_type = 'error') AS engajados
FROM events WHERE CAST(ts AS DATE) < DATE '2024-01-29' GROUP BY 1
UNION ALL SELECT * FROM metrics WHERE data >= DATE '2024-01-29'
""")
part("chat", """
SELECT DISTINCT '55' || user_id AS phone, CASE WHEN value < 90 THEN strftime(ts, '%Y-%m-%d %H:%M') END AS date,
  'chat' AS channel, event_type AS category, CASE WHEN event_type = 'error' THEN 'user ' || user_id END AS name
FROM events
""")
query("chatbot_event_table", "chat", "SELECT * FROM chat WHERE date IS NULL OR date >= '2024-01-01'")
query("top_categories", "chat", """
SELECT category, count(*) AS quantidade FROM chat GROUP BY category ORDER BY quantidade DESC, category LIMIT 10
""")
part("sent", """
SELECT '55' || p_size AS phone,
  CASE WHEN p_size < 20 THEN '2025-08-' || lpad(CAST(p_size + 1 AS VARCHAR), 2, '0')
       WHEN p_size < 40 THEN '09/' || lpad(CAST(p_size - 10 AS VARCHAR), 2, '0') || '/2025'
       ELSE '2025-10-01T08:30:00' END AS date,
  CASE WHEN p_size < 20 THEN DATE '2025-08-01' + p_size WHEN p_size < 40 THEN DATE '2025-09-01' + (p_size - 11)
       ELSE DATE '2025-10-01' END AS day,
  p_brand AS "campaignName", p_type AS status, 'parts' AS origin, 'c' || p_size AS id,
  CASE WHEN p_size = 50 THEN NULL
       WHEN p_type = 'STANDARD' THEN split_part(p_name, ' ', 2) || '  ' || split_part(p_name, ' ', 1)
       WHEN p_type = 'SMALL' THEN p_name[1:length(p_name) - 2]
       WHEN p_type = 'LARGE' THEN translate(p_name, 'aeiou', '')
       WHEN p_type = 'PROMO' THEN upper(p_name) WHEN p_type = 'MEDIUM' THEN p_name || ' ' || lower(p_brand)
       ELSE p_name END AS city
FROM part
""")
part("official", """
SELECT DISTINCT p_type || ':' || p_name AS ibge, p_name AS nome_cidade FROM part
WHERE p_type IN ('SMALL', 'LARGE') AND p_size > 10
""")
# Longest common subsequence: one table row per letter of the left text; the running maximum of a row
# is a prefix maximum, because entries of a row differ by at most one.
_sorted = "array_to_string(list_sort(list_filter(regexp_split_to_array({0}, '\\s+'), lambda w: w <> '')), ' ')"
part("candidates", f"""
SELECT DISTINCT {_sorted.format("n.city")} AS a, {_sorted.format("o.nome_cidade")} AS b
FROM (SELECT DISTINCT city FROM sent WHERE city IS NOT NULL) n, (SELECT DISTINCT nome_cidade FROM official) o
""")


def _lcs(source: str) -> str:
    return f"""
SELECT a, b, 0 AS i, list_transform(range(length(b) + 1), lambda j: 0) AS best FROM {source}
UNION ALL
SELECT a, b, i + 1, list_transform(range(length(b) + 1), lambda j: list_max(list_transform(range(j + 1), lambda k:
    CASE WHEN k > 0 AND a[i + 1] = b[k] THEN best[k] + 1 ELSE best[k + 1] END)))
FROM {{0}} WHERE i < length(a)
"""


part("steps", _lcs("candidates").format("steps"))
part("scores", """
SELECT a, b, 200.0::DOUBLE * best[-1] / (length(a) + length(b)) AS score FROM steps WHERE i = length(a)
""")
part("matched", f"""
SELECT name, matched, score FROM (
  SELECT n.city AS name, o.nome_cidade AS matched, score,
    row_number() OVER (PARTITION BY n.city ORDER BY score DESC, o.nome_cidade) AS rn
  FROM (SELECT DISTINCT city FROM sent WHERE city IS NOT NULL) n
  JOIN scores ON a = {_sorted.format("n.city")}
  JOIN (SELECT DISTINCT nome_cidade FROM official) o ON b = {_sorted.format("o.nome_cidade")})
WHERE rn = 1
""")
_match = "sent official candidates steps scores matched"
query("best_match_names", _match, "SELECT name, matched, round(score, 9) AS score FROM matched")
query("campaign_city_rows", _match, """
SELECT DISTINCT phone, day AS date, "campaignName", status, origin, id, matched AS city, o.ibge
FROM sent JOIN matched ON name = city LEFT JOIN official o ON o.nome_cidade = matched WHERE score >= 50
""")
query("campaign_quarantine", _match, """
SELECT phone, date, "campaignName", city, status, origin, id, matched AS city_normalizado, round(score, 9) AS similaridade
FROM sent JOIN matched ON name = city WHERE score < 50
""")
part("variants", f"""
SELECT DISTINCT p_name, reverse(p_name) AS mirrored, lower(p_brand) AS brand,
  split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1) AS swapped FROM part
""")
part("vpairs", f"""
SELECT DISTINCT {_sorted.format("p_name")} AS a, {_sorted.format("v")} AS b
FROM (SELECT p_name, unnest([mirrored, brand, swapped]) AS v FROM variants)
""")
part("vsteps", _lcs("vpairs").format("vsteps"))
part("vscores", """
SELECT a, b, 200.0::DOUBLE * best[-1] / (length(a) + length(b)) AS score FROM vsteps WHERE i = length(a)
""")


def _vscore(c: str) -> str:
    return (f"(SELECT round(score, 9) FROM vscores WHERE a = {_sorted.format('p_name')} "
            f"AND b = {_sorted.format(c)}) AS score_{c}")


query("token_similarity", "variants vpairs vsteps vscores", f"""
SELECT p_name, mirrored, brand, {_vscore("mirrored")}, {_vscore("brand")}, {_vscore("swapped")} FROM variants
""")
part("calls", """
SELECT *, string_split(text, chr(10)) AS lines,
  CASE WHEN lang <> 'fr' THEN '2024-01-' || lpad(CAST(n_chars % 28 + 1 AS VARCHAR), 2, '0') END AS day
FROM documents
""")


def _list(expr: str) -> str:
    return f"array_to_string(list_transform(lines, lambda x, i: {expr}), ', ')"


query("call_log_rows", "calls", f"""
SELECT CAST(doc_id AS VARCHAR) AS id, day || ' 08:15:30.000000' AS "dataHoraInicio",
  '2024-02-01 10:00:00.000000' AS "dataHoraFim", '31-01-2024' AS data_atualizacao,
  {_list("translate(x, '[]''', '')")} AS tipo, {_list("CAST(length(x) AS VARCHAR)")} AS "tempoEspera_ms",
  {_list("CAST((i - 1) * 1000 AS VARCHAR)")} AS "tempoAtendimento_ms",
  {_list("CASE WHEN length(x) > 60 THEN 'True' ELSE 'False' END")} AS "atendidaAte60Seg",
  {_list("CASE WHEN length(x) < 10 THEN 'True' ELSE 'False' END")} AS "desistenciaAte60Seg",
  {_list("CASE WHEN i - 1 > 5 THEN 'True' ELSE 'False' END")} AS "atendidaPos60Seg",
  {_list("'None'")} AS "desistenciaPos60Seg",
  CASE WHEN lang <> 'de' THEN source END AS origem,
  CASE WHEN lang <> 'de' THEN CASE WHEN n_chars > 500 THEN 'True' ELSE 'False' END END AS "cadastroLocalizadoEAF",
  CASE WHEN lang <> 'de' THEN upper(lang) END AS uf, CASE WHEN lang <> 'de' THEN 'None' END AS ddd,
  CASE WHEN lang <> 'de' THEN CAST(n_chars AS VARCHAR) END AS "codigoCidadeIBGE",
  CASE WHEN lang <> 'de' THEN CAST(n_chars AS VARCHAR) END AS cpf, CASE WHEN lang <> 'de' THEN 'x' END AS cep,
  CASE WHEN lang <> 'de' THEN '55' || doc_id END AS telefone
FROM calls
""")
query("call_freshness", "calls", """
SELECT max(CAST(day AS DATE)) AS newest, CAST(DATE '2024-01-31' - max(CAST(day AS DATE)) AS INTEGER) AS age_days,
       DATE '2024-01-31' - max(CAST(day AS DATE)) >= 2 AS is_stale FROM calls
""")

# --- capacity and registry ------------------------------------------------------------------------

part("capacity", """
SELECT CAST(s_nationkey AS VARCHAR) AS ibge, CASE WHEN s_acctbal > 0 THEN s_name END AS instaladora,
  CAST(CAST(floor(abs(s_acctbal)) AS INTEGER) AS VARCHAR) AS instalacoes_dia,
  CASE WHEN s_acctbal > 0 THEN s_nationkey || s_name || CAST(floor(abs(s_acctbal)) AS INTEGER) END AS concat,
  DATE '2001-11-04' AS data_informacao, n_regionkey
FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
query("capacity_chain", "capacity", "SELECT * EXCLUDE (n_regionkey) FROM capacity")
query("null_safe_anti", "capacity", """
SELECT * EXCLUDE (n_regionkey) FROM capacity c
WHERE NOT EXISTS (SELECT 1 FROM capacity s WHERE s.n_regionkey = 1 AND s.concat IS NOT DISTINCT FROM c.concat)
""")
_done = ("Status = 'INSTALLED' AND StatusdaInstalacao IN ('Executada procedente', 'Executado - Procedente', 'Instalada') "
         "AND Motivo IN ('Agendamento', 'Interferência', 'Contestação')")
part("registry", """
SELECT CAST(p_partkey AS VARCHAR) AS cpf, CAST(p_size AS BIGINT) AS cod_familia,
  CASE WHEN p_type = 'STANDARD' THEN NULL WHEN p_type = 'PROMO' THEN 'Instalado' ELSE 'Pendente' END AS status
FROM part
""")
query("installed_people", "aged tickets", f"SELECT DISTINCT CPF FROM tickets WHERE {_done}")
query("mark_installed", "aged tickets registry", f"""
SELECT cpf, cod_familia,
  CASE WHEN cpf IN (SELECT cpf FROM registry WHERE status <> 'Instalado' AND cpf IN (SELECT CPF FROM tickets WHERE {_done}))
       THEN 'Instalado' ELSE status END AS status_cpf,
  CASE WHEN cod_familia IN (SELECT cod_familia FROM registry WHERE status <> 'Instalado' AND cod_familia IN (
         SELECT TRY_CAST(CodFamilia AS BIGINT) FROM tickets WHERE {_done} AND TRY_CAST(CodFamilia AS BIGINT) IS NOT NULL))
       THEN 'Instalado' ELSE status END AS status_codfamilia
FROM registry
""")

# --- travel -----------------------------------------------------------------------------------------

_v = "CAST({0} AS VARCHAR)".format
_date = "strftime(o_orderdate, '%Y-%m-%d')"
_order = (f"id={_v('o_orderkey')}|protocol={_v('o_orderkey')}|amount=o_totalprice / 100|refunds=CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 50 / 100 END|"
          f"createdAt={_date}|tagsIds=o_custkey || ', ' || o_orderkey")


def _feed(feed: str, table: str, key: str, columns: str, values: str) -> None:
    """A feed's columns in their order ($: held in cents) with the given values; the others have a value in every fourth row."""
    given = dict(v.strip().split("=", 1) for v in re.split(r"(?<![|])[|](?![|])", values))
    cells = []
    for number, marked in enumerate(columns.split()):
        name = marked.rstrip("$")
        value = f"'{number}/' || ({key})"
        if re.search(r"(^|_)(is|has)[A-Z][A-Za-z]*$", name):
            value = f"({key}) % 8 < 4"
        elif marked != name:
            value = f"(({key}) % 977 + {number}) / 100"
        cells.append(f'{given.get(name) or f"CASE WHEN (({key}) + {number}) % 4 = 0 THEN {value} END"} AS "{name}"')
    query(f"travel_{feed}", "", f"SELECT {', '.join(cells)} FROM {table}")


_feed("colaboradores", "customer", "c_custkey", """
id name username email gender role position_id position_label firstLogin groupId language permission birthday costCenterId integrationMetadata
onVacation hasPin active parentEmail phoneNumber avatar isPasswordTemporary hasPhysicalBlueCard hasLoginRestriction hasApp createdAt updatedAt typeKey
keyPix acceptedTermLgpd costCenter_id costCenter_name costCenter_customFieldMsSelectOptionId costCenter_integrationMetadata costCenter_deletedAt
costCenter_createdAt costCenter_updatedAt document_id document_number document_label document_type_id document_type_label document_createdAt
document_updatedAt allDocuments
""", f"""
id={_v('c_custkey')}|name=c_name|email=CASE WHEN c_acctbal > 0 THEN lower(c_name) || '@example.com' END|position_id={_v('c_nationkey')}|
position_label=c_mktsegment|active={_v('c_acctbal > 0')}|hasApp=c_acctbal > 5000|allDocuments='RG:' || c_name || '; ' || c_mktsegment || ':'
""")
_feed("centro_custo", "nation", "n_nationkey", """
id v3Id name integrationMetadata deletedAt invoicing_email invoicing_cnpj createdAt updatedAt
""", f"""
id={_v('n_nationkey')}|v3Id={_v('n_regionkey')}|name=n_name
""")
_feed("grupo", "part", "p_partkey", """
id name employeesIds amountEmployees createdAt updatedAt
""", f"""
id={_v('p_partkey')}|name=p_brand|amountEmployees={_v('p_size')}|
employeesIds=unnest(CASE WHEN p_type <> 'PROMO' THEN string_split(p_name, ' ') ELSE [NULL] END)
""")
_feed("despesa", "lineitem", "l_orderkey * 8 + l_linenumber", """
id protocol description date amount$ currency originalCurrencyAmount defaultCurrencyCompany isReimbursable receipts rdvId costCenterId isValid userId
expenditureTypeId pixId isNFe accessKey category mcc postalCode commerce_lat commerce_lng commerce_document updatedByBlue quoteHasModified nfeUri
nfeUF establishmentAddress merchant afterUpdateBlueValue$ beforeUpdateBlueValue$ integrationMetadata quantity blueMsId isAnnexRequired tagsIds
createdAt updatedAt
""", f"""
id={_v('l_orderkey')}|protocol={_v('l_orderkey')}|amount=l_extendedprice / 100|isReimbursable=l_tax > 0.045|
receipts=l_returnflag || ', ' || l_linestatus|tagsIds=l_partkey || ', ' || l_suppkey|afterUpdateBlueValue=CASE WHEN (l_orderkey * 8 + l_linenumber) % 3 <> 0 THEN (l_orderkey * 8 + l_linenumber) % 50 / 100 END|
beforeUpdateBlueValue=l_quantity / 100|quantity={_v('l_linenumber')}
""")
_feed("automovel", "orders", "o_orderkey", """
id oldId protocol bookingId bookingType status labelStatus reason costCenterId tagsIds cancelReason consumer discount refunds$ additionalCharge
antecedence paymentMethod amount$ netAmount$ consumersQuantity integrationMetadata reprovedReason approvalExpirationDate withinPolitics noHasInvoice
createdAt updatedAt reservedBy slug orderCreatedByReqOffline withdraw_date withdraw_city withdraw_address deposit_date deposit_city deposit_address
depositInAnotherLocation group description renter allowanceDescription amountPerDay$ totalDays dailyAmount$ rateDepositAnotherPlace
withdrawObservation depositObservation usedAgreement corporateNameOfAgreement reserveCode bookingDays client_id client_name client_email
client_username client_birthday client_costCenterId client_groupId client_permission client_active client_language client_createdAt client_updatedAt
drivers_nomes drivers_emails drivers_documentos drivers_userIds
""", f"""
{_order}|drivers_nomes='Driver ' || o_custkey || '; Guest'|drivers_emails='; g@example.com'|drivers_documentos='D1; '|
drivers_userIds=o_custkey || '; 7'
""")
_feed("aereo", "orders", "o_orderkey", """
id oldId protocol bookingId bookingType status labelStatus reason costCenterId tagsIds cancelReason consumer discount$ refunds$ additionalCharge$
antecedence paymentMethod amount$ netAmount$ consumersQuantity integrationMetadata reprovedReason approvalExpirationDate withinPolitics noHasInvoice
createdAt updatedAt reservedBy slug orderCreatedByReqOffline type isRoundTrip creditRefunds hasBag bagAmount$ hasComfortSeat comfortSeatAmount$
hasInsurance insuranceAmount$ hasAutoCheckin autoCheckinAmount$ isInternational totalEmissionGrams ticketOutbound ticketInbound outbound_from
outbound_to outbound_departureDate outbound_arrivalDate outbound_tax$ outbound_flightNumber outbound_cabinType outbound_hasStops outbound_duration
outbound_cabinBusinessClass outbound_emissionGrams outbound_cia_id outbound_cia_name outbound_cia_iata outbound_cia_callSign outbound_cia_status
inbound_from inbound_to inbound_departureDate inbound_arrivalDate inbound_tax$ inbound_flightNumber inbound_cabinType inbound_hasStops
inbound_duration inbound_cabinBusinessClass inbound_emissionGrams inbound_cia_id inbound_cia_name inbound_cia_iata inbound_cia_callSign
inbound_cia_status travellers_nomes travellers_emails travellers_documentos travellers_userIds travellers_bestPrice travellers_nationalities
""", f"""
{_order}|ticketOutbound=o_orderkey || '; '|ticketInbound={_v('o_custkey')}|travellers_nomes='Traveller ' || o_custkey || '; Guest'|
travellers_emails='; g@example.com'|travellers_documentos='D1; '|travellers_userIds=o_custkey || '; 7'|travellers_bestPrice='100; 100'|
travellers_nationalities='BR; BR'
""")
_feed("onibus", "orders", "o_orderkey", """
id oldId protocol bookingId bookingType status labelStatus reason costCenterId tagsIds cancelReason consumer discount$ refunds$ additionalCharge$
antecedence paymentMethod amount$ netAmount$ consumersQuantity integrationMetadata reprovedReason approvalExpirationDate withinPolitics noHasInvoice
createdAt updatedAt reservedBy slug orderCreatedByReqOffline isRoundTrip hasInsurance client_id client_name client_email client_username
client_birthday client_costCenterId client_groupId client_permission client_active client_language client_createdAt client_updatedAt outbound_type
outbound_seatClass outbound_departureDate outbound_arrivalDate outbound_price$ outbound_tax$ outbound_insurancePrice$ outbound_refundable
outbound_from_id outbound_from_name outbound_from_city outbound_from_station outbound_from_address outbound_to_id outbound_to_name outbound_to_city
outbound_to_station outbound_to_address outbound_cia_id outbound_cia_name outbound_cia_displayName inbound_type inbound_seatClass
inbound_departureDate inbound_arrivalDate inbound_price$ inbound_tax$ inbound_insurancePrice$ inbound_refundable inbound_from_id inbound_from_name
inbound_from_city inbound_from_station inbound_from_address inbound_to_id inbound_to_name inbound_to_city inbound_to_station inbound_to_address
inbound_cia_id inbound_cia_name inbound_cia_displayName
""", f"""
{_order}|outbound_price=o_totalprice / 100|inbound_insurancePrice=CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 50 / 100 END
""")
_feed("hotel", "orders", "o_orderkey", """
id oldId protocol bookingId bookingType status labelStatus reason costCenterId tagsIds cancelReason consumer discount$ refunds$ additionalCharge$
antecedence paymentMethod amount$ netAmount$ consumersQuantity integrationMetadata reprovedReason approvalExpirationDate withinPolitics noHasInvoice
createdAt updatedAt reservedBy slug orderCreatedByReqOffline checkin checkout hotelName city roomDescription allowancesDescription thumbnail
isRefundable refundDeadline dailyAmount$ bookingDays daysHosted bestPrice$ isBestPrice costCenter_id costCenter_name costCenter_v3Id
costCenter_integrationMetadata costCenter_deletedAt client_id client_name client_email client_username client_birthday client_costCenterId
client_groupId client_permission client_active client_language client_createdAt client_updatedAt address_streetName address_streetNumber
address_postCode address_region address_district address_countryName address_placeId address_description address_name address_type address_lat
address_lng address_cityName tags_nomes nextApprovers_nomes nextApprovers_emails approvalFlowHistory guests_nomes guests_emails guests_documentos
guests_userIds guests_nationalities
""", f"""
{_order}|isRefundable=o_orderstatus = 'P'|dailyAmount=o_totalprice / 100|tags_nomes='a; ; ' || o_orderstatus|nextApprovers_nomes='Boss'|
nextApprovers_emails='b@example.com'|approvalFlowHistory='Asked(' || {_date} || '); ()'|guests_nomes='Guest ' || o_custkey || '; Guest'|
guests_emails='; g@example.com'|guests_documentos='D1; '|guests_userIds=o_custkey || '; 7'|guests_nationalities='BR; BR'
""")
query("travel_fatura", "", f"""
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice / 100 END AS amount,
  CASE WHEN o_orderkey % 5 = 0 THEN o_orderstatus ELSE {_v("(o_orderstatus = 'F')")} END AS closed,
  CASE WHEN o_orderkey % 13 = 0 THEN '{{"customer":' || o_custkey || ',"note":"' || o_orderpriority || '"}}' END AS rare,
  '[{{"line":' || o_orderkey || ',"note":"' || CASE WHEN o_orderkey % 11 = 0 THEN {_v('o_custkey')} ELSE o_orderpriority END
    || '"}},{{"line":2,"note":null}}]' AS details FROM orders
""")
query("travel_creditos", "", f"""
SELECT s_suppkey AS id, s_name AS name, '2024-01-01' AS "createdAt", '2024-01-02' AS "updatedAt", c.id AS "credit.id",
  CASE WHEN c.id IS NOT NULL THEN CASE WHEN s_suppkey % 3 = 0 THEN 'R$ ' || s_acctbal ELSE regexp_replace({_v('s_acctbal')}, '[.]0$', '') END END AS "credit.totalAmount", c.d AS "credit.description",
  CASE WHEN c.id IS NOT NULL THEN CASE WHEN s_suppkey % 3 = 0 THEN '{{"name":"' || s_name || '","team":' || s_nationkey || '}}' ELSE s_name END END AS "credit.user"
FROM (SELECT *, unnest(CASE WHEN s_acctbal > 0 THEN
        [{{'id': {_v('s_suppkey')}, 'd': 'first'}}, {{'id': {_v('s_suppkey')}, 'd': 'first'}},
         {{'id': 'b' || s_suppkey, 'd': NULL}}] ELSE [{{'id': NULL, 'd': NULL}}] END) AS c FROM supplier)
""")
query("page_row_totals", "", "SELECT count(*) AS declared, count(o_orderkey) AS read FROM orders")
query("damaged_page_rows", "", """
SELECT style, kind, id FROM (
  SELECT 'read' AS kind, c_custkey AS id FROM customer WHERE c_custkey // 20 % 7 <> 3
  UNION ALL SELECT 'quarantine', min(c_custkey) FROM customer WHERE c_custkey // 20 % 7 = 3 GROUP BY c_custkey // 20),
  (VALUES ('offset'), ('numbered'), ('content')) AS s(style)
""")

# --- functions ----------------------------------------------------------------------------------------

query("lenient_casts", "", """
SELECT event_id,
  TRY_CAST(CASE WHEN value < 20 THEN '2024-13-45' ELSE strftime(ts, '%Y-%m-%d') END AS DATE) AS d,
  CAST(try_strptime(CASE WHEN value < 20 THEN strftime(ts, '%Y-%m-%d') ELSE strftime(ts, '%d-%m-%Y') END, '%d-%m-%Y') AS DATE) AS d105,
  TRY_CAST(CASE WHEN value < 20 THEN 'x1' ELSE CAST(user_id AS VARCHAR) END AS BIGINT) AS n,
  TRY_CAST(CASE WHEN value < 20 THEN '' ELSE CAST(user_id AS VARCHAR) END AS DOUBLE) / 100 AS units,
  CASE WHEN value < 20 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS stamp,
  strftime(ts, '%Y-%m-%d %H:%M') AS minute,
  regexp_replace(CASE WHEN value < 20 THEN 'n/a' ELSE props END, '[^0-9]', '', 'g') AS digits,
  CAST(user_id AS VARCHAR) AS user_text
FROM events
""")
query("mixed_dates", "", """
SELECT event_id, CASE WHEN event_type = 'error' THEN CAST(date_trunc('month', ts) AS DATE) + 24
                      WHEN event_type IN ('click', 'view', 'signup') THEN CAST(ts AS DATE) END AS d FROM events
""")
query("time_formats", "", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, strftime(ts, '%d-%m-%Y') AS day,
  strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') AS shifted,
  CAST(floor(epoch(TIMESTAMP '2024-01-31' - ts) / 86400) AS BIGINT) AS days, strftime(ts, '%Y-%m-%d %H:%M:%S') AS same
FROM events
""")
query("text_cleanup", "", f"""
SELECT page_id, regexp_replace(url, '[^0-9]', '', 'g') AS digits, translate(html, '[]''#', '') AS stripped,
  replace(url, '-', '') AS postal, CASE WHEN contains(html, '***') THEN NULL ELSE url END AS filled,
  CASE WHEN contains(url, '?') THEN page_id || url END AS key, {_sorted.format("html")} AS sorted_words
FROM pages
""")
query("sql_literals", "", """
SELECT doc_id, CASE WHEN text = '' THEN 'NULL' ELSE '''' || replace(text, '''', '''''') || '''' END AS quoted,
  CASE WHEN lang = 'fr' THEN 'NULL' ELSE '''' || source || '''' END AS maybe,
  source || ', ' || n_chars || ' - ' || CASE WHEN lang = 'en' THEN lang ELSE 'None' END || ' - ' || lang || ' - None , '
    || doc_id || '-' || lang AS address,
  CASE WHEN lang = 'de' THEN source ELSE 'N/A' END AS defaulted
FROM documents
""")
query("growth_and_ratio", "", """
SELECT o_orderkey, round(change, 9) AS change, round(ratio, 9) AS ratio, round(blend, 9) AS blend, months,
  CASE WHEN months >= 9 THEN 'Long Tail' WHEN months >= 3 THEN 'Decrescente' WHEN months >= 0 THEN 'Crescente' END AS curve,
  colour, CASE colour WHEN 'Comunicado - Verde' THEN 1 WHEN 'Alerta - Amarelo' THEN 2 WHEN 'Comunicado - Amarelo' THEN 3
    WHEN 'Alerta - Vermelho' THEN 4 WHEN 'Alerta - Vermelho Crítico' THEN 5 ELSE 0 END AS level
FROM (
  SELECT *, CASE WHEN change > 0.3 THEN CASE WHEN blend < 0.5 AND ratio < 0.5 THEN 'Comunicado - Verde'
      WHEN blend < 0.5 AND ratio < 0.8 THEN 'Alerta - Amarelo' WHEN blend < 0.8 AND ratio < 0.8 THEN 'Comunicado - Amarelo'
      WHEN blend < 0.8 AND ratio > 0.8 THEN 'Alerta - Vermelho'
      WHEN blend > 0.8 AND ratio > 0.8 THEN 'Alerta - Vermelho Crítico' END END AS colour
  FROM (SELECT *, ratio * 0.5::DOUBLE + 0.125::DOUBLE AS blend FROM (
    SELECT o_orderkey, CASE WHEN a - b <= 50 THEN 0 WHEN b = 0 THEN 1 ELSE (a - b)::DOUBLE / b END AS change,
      CASE WHEN b <> 0 THEN a::DOUBLE / b ELSE 0 END AS ratio,
      CAST((2001 - year(o_orderdate)) * 12 + 8 - month(o_orderdate) AS INTEGER) AS months
    FROM (SELECT *, o_custkey AS a, o_orderkey % 997 AS b FROM orders))))
""")

# --- filters, sets, limits ----------------------------------------------------------------------------

query("predicate_flags", "", """
SELECT o_orderstatus,
  count(*) FILTER (WHERE d BETWEEN DATE '2001-07-16' AND DATE '2001-07-22') AS band_previous,
  count(*) FILTER (WHERE d BETWEEN DATE '2001-07-23' AND DATE '2001-07-29') AS band_current,
  count(*) FILTER (WHERE o_orderpriority NOT IN ('5-LOW', '1-URGENT')) AS not_listed,
  count(*) FILTER (WHERE o_orderpriority LIKE '1-%') AS prefixed,
  count(*) FILTER (WHERE o_orderpriority NOT LIKE '4-NOT%') AS not_prefixed,
  count(*) FILTER (WHERE o_custkey <> o_orderkey) AS unequal,
  count(*) FILTER (WHERE d = DATE '2001-08-01') AS today, count(*) FILTER (WHERE d < DATE '2001-08-01') AS before_today,
  count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '2001-07-22') AS last_hours,
  count(*) FILTER (WHERE o_orderdate <= TIMESTAMP '2001-07-22') AS older_hours,
  count(*) FILTER (WHERE d = DATE '2000-02-29') AS one_day,
  count(*) FILTER (WHERE lower(o_orderpriority) NOT IN ('5-low', '2-high')) AS not_ignored,
  count(*) FILTER (WHERE o_orderstatus <> 'F') AS filled
FROM (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders) GROUP BY o_orderstatus
""")
query("threshold_split", "", """
SELECT c_mktsegment, CASE WHEN c_acctbal >= 50 THEN 'kept' ELSE 'low' END AS side, count(*) AS n
FROM customer WHERE c_acctbal > -500 GROUP BY ALL
""")
query("union_missing_columns", "", """
SELECT c_name AS name, c_nationkey, CAST(NULL AS INTEGER) AS other FROM customer
UNION ALL SELECT s_name, NULL, s_nationkey FROM supplier
""")
query("union_distinct_keys", "", "SELECT o_custkey AS key FROM orders UNION SELECT c_custkey FROM customer")
query("order_preview", "", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10")
query("distinct_minutes", "", "SELECT DISTINCT user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M') AS minute FROM events")
query("kpi_hidden_key", "", """
SELECT o_orderpriority, 'open' AS regra, count(*) AS quantidade FROM orders WHERE o_orderstatus = 'O'
GROUP BY o_orderpriority, CAST(o_orderdate AS DATE)
UNION ALL SELECT o_orderpriority, 'all', count(*) FROM orders GROUP BY o_orderpriority
""")
query("kpi_band_counts", "people", """
SELECT c.c_nationkey, count(*) FILTER (WHERE o_orderdate BETWEEN DATE '2001-02-22' AND DATE '2001-04-23') AS previous,
  count(*) FILTER (WHERE o_orderdate BETWEEN DATE '2001-05-03' AND DATE '2001-07-02') AS current, max(people) AS people
FROM orders JOIN customer c ON o_custkey = c_custkey LEFT JOIN people ON people.c_nationkey = c.c_nationkey
GROUP BY c.c_nationkey HAVING previous + current > 0
""")
query("first_row_per_key", "", f"""
SELECT l_orderkey, l_linenumber, strftime(l_shipdate, {_stamp}) AS l_shipdate, l_partkey, l_suppkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity) AS rn FROM lineitem) WHERE rn = 1
""")
query("semi_join_keys", "", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
""")

# --- nested ---------------------------------------------------------------------------------------------

query("explode_turn_lines", "", """
SELECT conv_id, turn, CAST(p - 1 AS INTEGER) AS pos, lines[p] AS line FROM (
  SELECT conv_id, turn, lines, unnest(range(1, len(lines) + 1)) AS p
  FROM (SELECT *, string_split(text, chr(10)) AS lines FROM conversations))
""")
query("explode_outer_ids", "", """
SELECT doc_id, unnest(CASE WHEN len(ids) = 0 THEN [NULL] ELSE ids END) AS ids FROM (
  SELECT doc_id, list_filter(string_split(text, ' '), lambda w: w <> '') AS ids FROM documents)
""")
part("turns", "SELECT conv_id, turn, string_split(text, chr(10)) AS lines FROM conversations")


def _join(expr: str, sep: str) -> str:
    return f"array_to_string(list_transform(lines, lambda x, n: {expr}), '{sep}')"


_size = "CASE WHEN length(x) > 30 THEN CAST(length(x) AS VARCHAR) ELSE '' END"
query("join_list_fields", "turns", f"""
SELECT conv_id, turn, {_join("CAST(n - 1 AS VARCHAR)", ", ")} AS ids, {_join("x", "; ")} AS names,
  {_join(_size, "; ")} AS sizes, {_join(f"x || '(' || {_size} || ')'", "; ")} AS pairs,
  len(list_filter(lines, lambda x: length(x) > 100)) > 0 AS has_long,
  list_filter(lines, lambda x: length(x) > 50)[1] AS first_long, lines[1] AS first
FROM turns
""")
query("json_expand", "", """
SELECT event_id, value AS amount, CAST(json_extract(props, '$.k') AS BIGINT) AS "props.k" FROM events
""")
query("plain_cells", "", """
SELECT conv_id, turn, CAST(to_json(string_split(text, chr(10))) AS VARCHAR) AS lines,
  '{"role":"' || role || '","size":' || length(text) || ',"note":null}' AS info FROM conversations
""")
query("parquet_hand_over", "", """
SELECT conv_id, turn, CAST(to_json(string_split(text, chr(10))) AS VARCHAR) AS lines FROM conversations
""")

# --- checks, sinks, streams -----------------------------------------------------------------------------

query("freshness_days", "", """
SELECT max(CAST(ts AS DATE)) AS newest, CAST(DATE '2024-01-31' - max(CAST(ts AS DATE)) AS INTEGER) AS age_days,
       DATE '2024-01-31' - max(CAST(ts AS DATE)) >= 2 AS is_stale FROM events
""")
query("missing_pages", "", """
SELECT page FROM (SELECT unnest(range(1, (SELECT max(l_orderkey) + 2 FROM lineitem))) AS page)
WHERE page NOT IN (SELECT l_orderkey + 1 FROM lineitem)
""")
query("guarded_rows", "", "SELECT * FROM region")
query("replaced_days", "", """
SELECT data, CASE WHEN engajados > 0 THEN ativos * 10 ELSE ativos END AS ativos, engajados FROM (
  SELECT CAST(ts AS DATE) AS data, count(*) AS ativos, count(*) FILTER (WHERE event_type = 'error') AS engajados
  FROM events GROUP BY 1)
""")
query("appended_rows", "people cities", "SELECT * FROM cities UNION ALL SELECT * FROM cities WHERE regiao = 'ASIA'")
query("stream_created_per_day", "", """
SELECT CAST(ts AS DATE) AS dia, event_type, count(*) AS quantidade FROM events GROUP BY 1, 2
""")
query("stream_alert_once", "", "SELECT DISTINCT user_id, event_type FROM events")
query("stream_reconcile_status", _rec, "SELECT * FROM compared")

# --- the write side ---------------------------------------------------------------------------------

query("committed_alerts", _risk + " alerts", """
SELECT ibge, nome_cidade, calculo_prevencao, nivel_calculo_prevencao AS nivel_alerta, '04-11-2001' AS data_alerta,
  0 AS second_run, (SELECT count(*) FROM alerts) AS alerted FROM alerts
""")
SQL["upserted_table"] = SQL["upsert_by_join"]
query("appended_absent", "", """
SELECT c_custkey AS number, c_name AS name FROM customer
UNION ALL SELECT DISTINCT o_orderkey, NULL FROM orders WHERE o_orderkey NOT IN (SELECT c_custkey FROM customer)
""")
SQL["replaced_trailing"] = SQL["window_replace"]
