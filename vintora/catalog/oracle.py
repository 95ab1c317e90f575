"""ANSI SQL for the registered queries, over the same test tables.

Each query states the expected result directly from the base tables: text parsing is
checked against the numeric columns the text was made from, interval rewrites against
the plain inequality joins, and closed forms against step-by-step recursion.
"""

from __future__ import annotations

import re

SNAPSHOT = "DATE '2001-01-01'"


def r(expr: str, decimals: int = 2) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), {decimals}) AS DOUBLE)"


def money(expr: str) -> str:
    return f"CAST(coalesce(sum(CAST({expr} AS DECIMAL(18,2))), 0) AS DOUBLE)"


def money_if(expr: str, cond: str) -> str:
    return f"CAST(coalesce(sum(CAST({expr} AS DECIMAL(18,2))) FILTER (WHERE {cond}), 0) AS DOUBLE)"


def pct(num: str, den: str) -> str:
    return f"(CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / {den} ELSE 0.0e0 END * 100)"


def text(expr: str, decimals: int) -> str:
    return f"CAST(CAST(round(CAST({expr} AS DECIMAL(38,10)), {decimals}) AS DECIMAL(38,{decimals})) AS VARCHAR)"


OVER60 = "count(*) FILTER (WHERE dias_maior_atraso > 60)"
OVER90 = "count(*) FILTER (WHERE dias_maior_atraso > 90)"
WEIGHTED = "CASE WHEN sum(principal) > 0 THEN sum(taxa_cliente * principal) / sum(principal) ELSE 0 END"

CTES: dict[str, str] = {}

# --- the loan book ---------------------------------------------------------

CTES["b_loans"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS id_contrato, o_orderkey AS k, o_totalprice AS principal,
  CAST(1 + o_orderkey % 80 AS INTEGER) AS num_parcelas,
  CAST(floor(o_totalprice / 40) AS DOUBLE) AS pmt,
  CAST(o_orderdate AS DATE) AS data_aquisicao,
  CASE WHEN o_orderkey % 7 = 0 THEN (1.5e0 + o_custkey % 5) / 100
       ELSE 0.01e0 + (o_custkey % 5) * 0.005e0 END AS taxa_cliente,
  CAST(CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 3 = 0 THEN 0
            ELSE (o_orderkey * 37) % 200 END AS DOUBLE) AS dias_maior_atraso,
  strftime(o_orderdate, '%Y-%m') AS safra,
  CASE WHEN o_orderkey % 13 = 0 THEN 'N/I' ELSE substr(o_orderpriority, 1, 1) END AS rating_concessao,
  o_orderstatus AS situacao_beneficio, c_mktsegment AS bhv_m, c_mktsegment AS especie_beneficio,
  n_name AS uf, r_name AS canal_originacao
FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""
CTES["b_line"] = """
SELECT *, l_orderkey AS k, CAST(o_orderdate + to_months(CAST(n AS INTEGER)) AS DATE) AS venc
FROM (SELECT *, CAST(l_linenumber + 7 * (l_suppkey % 4) AS INTEGER) AS n
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""
CTES["b_inst"] = f"""
SELECT CAST(k AS VARCHAR) AS id_contrato, k, concat(l_orderkey, '-', l_linenumber) AS id_parcela,
  n AS num_parcela, venc AS data_vencimento, pago AS data_pagamento,
  l_extendedprice AS valor_parcela,
  CASE WHEN pago IS NOT NULL THEN CAST(floor(l_extendedprice * (1 - l_discount)) AS DOUBLE) END AS valor_pago,
  CASE WHEN l_partkey % 19 = 0 THEN NULL
       ELSE CAST(greatest(coalesce(pago, {SNAPSHOT}) - venc, 0) AS DOUBLE) END AS dias_atraso
FROM (SELECT *, CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN NULL
                     WHEN l_returnflag = 'N' THEN venc
                     ELSE venc + CAST(l_partkey % 260 - 30 AS INTEGER) END AS pago
      FROM b_line)
"""
CTES["b_inst_orphans"] = """
SELECT * FROM b_inst
UNION ALL SELECT * REPLACE ('X' || id_contrato AS id_contrato) FROM b_inst WHERE k % 101 = 0
"""
CTES["b_reneg"] = """
SELECT o_orderkey AS k, 'R' || o_orderkey AS novo, unnest(
    CASE WHEN o_orderkey % 170 = 0 THEN [o_orderkey, o_orderkey + 10000000] ELSE [o_orderkey] END) AS origem,
  CASE WHEN o_orderkey % 51 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS d,
  CASE WHEN o_orderkey % 85 = 0 THEN -o_totalprice ELSE o_totalprice END AS valor
FROM orders WHERE o_orderkey % 17 = 0
"""

# --- text layer ------------------------------------------------------------


def styled(value: str, style: str) -> str:
    """Number the text style stands for; style 4 is unparseable and reads as 0."""
    return f"CASE WHEN {style} = 4 THEN 0.0e0 ELSE CAST({value} AS DOUBLE) END"


def money_text(value: str, style: str) -> str:
    plain = f"CAST(CAST({value} AS DECIMAL(18,2)) AS VARCHAR)"
    grouped = f"format('{{:,.2f}}', {value})"
    return (
        f"CASE {style} WHEN 0 THEN {plain} WHEN 1 THEN translate({grouped}, ',.', '.,') "
        f"WHEN 2 THEN replace({plain}, '.', ',') WHEN 3 THEN {grouped} ELSE 'garbage' END"
    )


def date_text(value: str, style: str) -> str:
    return (
        f"CASE {style} WHEN 0 THEN strftime({value}, '%d/%m/%Y') WHEN 1 THEN strftime({value}, '%Y-%m-%d') "
        f"WHEN 2 THEN strftime({value}, '%Y-%m-%d') || ' 12:30:45' END"
    )


# --- portfolio cuts --------------------------------------------------------


def cut(keys: str, columns: str) -> str:
    return f"""
SELECT {keys}, count(*) AS contratos_n, {money('principal')} AS principal,
  {r(pct(money('principal'), "(SELECT " + money('principal') + " FROM b_loans)"))} AS part_pct,
  {OVER60} AS over60_n, {r(pct(OVER60, 'count(*)'))} AS over60_pct{columns}
FROM b_loans GROUP BY ALL"""


def bands(labels: list[tuple[str, str]], tail: str) -> str:
    values = ", ".join(f"({i}, '{label}')" for i, (label, _) in enumerate(labels))
    cases = " ".join(f"WHEN {cond} THEN {i}" for i, (_, cond) in enumerate(labels))
    return f"""
SELECT {tail} FROM (VALUES {values}) AS b(ordem, faixa)
LEFT JOIN (SELECT CASE {cases} END AS ordem, count(*) AS n, {money('principal')} AS p, {OVER60} AS o
           FROM b_loans GROUP BY 1) c USING (ordem)"""


D = "dias_maior_atraso"
DELINQUENCY = [
    ("Corrente (0 dias)", f"{D} <= 0"),
    ("1 a 30 dias", f"{D} BETWEEN 1 AND 30"),
    ("31 a 60 dias", f"{D} BETWEEN 31 AND 60"),
    ("61 a 90 dias", f"{D} BETWEEN 61 AND 90"),
    ("Acima de 90 dias", f"{D} BETWEEN 91 AND 999999"),
]
TERMS = [
    ("1-12 meses", "num_parcelas BETWEEN 1 AND 12"),
    ("13-24 meses", "num_parcelas BETWEEN 13 AND 24"),
    ("25-36 meses", "num_parcelas BETWEEN 25 AND 36"),
    ("37-48 meses", "num_parcelas BETWEEN 37 AND 48"),
    ("49-60 meses", "num_parcelas BETWEEN 49 AND 60"),
    ("61-72 meses", "num_parcelas BETWEEN 61 AND 72"),
    (">72 meses", "num_parcelas BETWEEN 73 AND 9999"),
]
CTES["b_bands"] = bands(
    DELINQUENCY,
    "ordem, faixa, coalesce(n, 0) AS contratos_n, coalesce(n, 0) * 100.0e0 / (SELECT count(*) FROM b_loans) AS pct_raw, "
    "CAST(sum(coalesce(n, 0)) OVER (ORDER BY ordem) AS DOUBLE) / (SELECT count(*) FROM b_loans) * 100 AS acum_raw",
)
CTES["b_rating"] = cut("rating_concessao AS rating", f", {r('(' + WEIGHTED + ') * 100', 4)} AS taxa_pond_pct")
CTES["b_uf"] = cut("uf", "")
CTES["b_kpis"] = f"""
SELECT count(*) AS contratos, {money('principal')} AS principal_total,
  {money('principal')} / count(*) AS ticket_medio, {WEIGHTED} AS taxa_media, avg(num_parcelas) AS prazo_medio,
  count(*) FILTER (WHERE {D} > 30) AS over30_n, {OVER60} AS over60_n, {OVER90} AS over90_n,
  count(*) FILTER (WHERE {D} > 30) / CAST(count(*) AS DOUBLE) AS over30_pct,
  {OVER60} / CAST(count(*) AS DOUBLE) AS over60_pct, {OVER90} / CAST(count(*) AS DOUBLE) AS over90_pct,
  min(safra) AS safra_min, max(safra) AS safra_max, CAST(0 AS BIGINT) AS safra_ni_n,
  (SELECT count(DISTINCT origem) FROM b_reneg) AS renegociacoes
FROM b_loans"""
CTES["b_flow"] = f"""
SELECT safra, venc, pmt,
  CAST((year(venc) - year({SNAPSHOT})) * 12 + month(venc) - month({SNAPSHOT}) AS INTEGER) AS dp
FROM (SELECT safra, pmt, CAST(data_aquisicao + to_months(CAST(p AS INTEGER)) AS DATE) AS venc
      FROM (SELECT *, unnest(range(1, num_parcelas + 1)) AS p FROM b_loans))
WHERE venc > {SNAPSHOT}"""
CTES["b_ead"] = f"""
SELECT {money('pmt * num_parcelas')} AS ead_total,
  {money_if('pmt * num_parcelas', D + ' > 60')} AS ead_inadimplente FROM b_loans"""

# --- cohorts ---------------------------------------------------------------

CTES["b_fpd_raw"] = f"""
SELECT safra, count(*) AS contratos_n, count(*) FILTER (WHERE fpd) AS fpd_n,
  100.0e0 * count(*) FILTER (WHERE fpd) / count(*) AS q,
  {money_if('principal', 'fpd')} / {money('principal')} * 100 AS v,
  count(*) FILTER (WHERE p1 IS NULL) AS sem_parcela1
FROM (SELECT l.safra, l.principal, p.id_contrato AS p1, coalesce(p.aberta OR p.dias > 30, false) AS fpd
      FROM b_loans l LEFT JOIN (
        SELECT id_contrato, bool_or(data_pagamento IS NULL) AS aberta, max(dias_atraso) AS dias
        FROM b_inst WHERE num_parcela = 1 GROUP BY 1) p USING (id_contrato))
GROUP BY safra"""
SIGNAL = (
    "CASE WHEN {q} > 80 THEN 'Dado incompleto' WHEN {q} > 20 THEN 'Alto' WHEN {q} > 10 THEN 'Elevado' "
    "WHEN {q} > 5 THEN 'Moderado' ELSE 'Adequado' END"
)
CTES["b_fpd"] = f"""
SELECT safra, contratos_n, fpd_n, {r('q')} AS fpd_qtd_pct, {r('v')} AS fpd_val_pct, sem_parcela1,
  {SIGNAL.format(q='q')} AS sinalizacao FROM b_fpd_raw"""
CTES["b_joined"] = f"""
SELECT l.safra, (year(i.data_vencimento) - year(l.data_aquisicao)) * 12
    + month(i.data_vencimento) - month(l.data_aquisicao) AS mob, i.data_vencimento AS venc, i.data_pagamento AS pago,
  i.valor_parcela, i.valor_pago, i.dias_atraso, l.principal, l.num_parcelas
FROM b_inst i JOIN b_loans l USING (id_contrato)"""
CTES["b_vp"] = f"SELECT safra, {money('principal')} AS principal FROM b_loans GROUP BY safra"
CTES["b_behaviour"] = f"""
SELECT v.safra, {', '.join(f"{r(f'coalesce({c}, 0) / principal * 100')} AS {c}" for c in ('antecipado', 'no_dia', 'em_atraso', 'a_receber', 'perda'))}
FROM b_vp v LEFT JOIN (SELECT safra,
  {money_if('valor_parcela', f'venc <= {SNAPSHOT} AND pago < venc')} AS antecipado,
  {money_if('valor_parcela', f'venc <= {SNAPSHOT} AND pago = venc')} AS no_dia,
  {money_if('valor_parcela', f'venc <= {SNAPSHOT} AND pago > venc')} AS em_atraso,
  {money_if('valor_parcela', f'venc > {SNAPSHOT}')} AS a_receber,
  {money_if('valor_parcela', f'venc <= {SNAPSHOT} AND pago IS NULL')} AS perda
  FROM b_joined GROUP BY safra) c USING (safra)"""
CTES["b_mob"] = f"""
SELECT safra, CAST(mob AS INTEGER) AS mob, {money_if('valor_parcela', 'dias_atraso > 60 AND pago IS NULL')} AS perda,
  sum(CASE WHEN pago IS NOT NULL AND valor_pago > 0 THEN greatest(0.0e0, valor_pago - principal / num_parcelas)
      ELSE 0.0e0 END) AS receita
FROM b_joined WHERE venc <= {SNAPSHOT} AND mob > 0 GROUP BY safra, mob"""
CTES["b_obs"] = """
SELECT v.safra, v.principal, CAST(coalesce(max(mob), 0) AS INTEGER) AS max_mob,
  CAST(greatest(coalesce(max(mob), 0) - 2, 1) AS INTEGER) AS mob_limpo
FROM b_vp v LEFT JOIN b_mob USING (safra) GROUP BY v.safra, v.principal"""

# --- roll rates ------------------------------------------------------------

CTES["b_spine"] = f"""
SELECT CAST(unnest(generate_series(date_trunc('month', min(data_aquisicao)), {SNAPSHOT}, INTERVAL 1 MONTH)) AS DATE) AS cal
FROM b_loans"""
# A contract's own months, numbered from the first month of the book: the month of its first event starts them.
CTES["b_first"] = """
SELECT *, date_diff('month', (SELECT min(cal) FROM b_spine), min_event) AS m0 FROM (
  SELECT id_contrato, min(data_vencimento) AS min_venc,
    min(CASE WHEN data_pagamento < data_vencimento THEN data_pagamento ELSE data_vencimento END) AS min_event
  FROM b_inst GROUP BY id_contrato)"""
CTES["b_month"] = "SELECT cal, row_number() OVER (ORDER BY cal) - 1 AS m FROM b_spine"
CTES["b_grid"] = """
SELECT id_contrato, cal, pmt, num_parcelas, min_venc
FROM (SELECT *, unnest(range(greatest(m0, 0), (SELECT count(*) FROM b_month))) AS m FROM b_first JOIN b_loans USING (id_contrato))
JOIN b_month USING (m)"""
# A payment counts from the first month that starts on its day or later, so months from then on hold it.
CTES["b_pay"] = """
SELECT id_contrato, cal, count(*) AS n
FROM (SELECT id_contrato, CAST(last_day(data_pagamento - 1) + 1 AS DATE) AS cal FROM b_inst WHERE data_pagamento IS NOT NULL)
GROUP BY ALL"""
CTES["b_held"] = """
SELECT id_contrato, cal, CAST(0 AS BIGINT) AS n, true AS asked FROM b_grid
UNION ALL SELECT id_contrato, cal, n, false FROM b_pay WHERE id_contrato IN (SELECT id_contrato FROM b_first)"""
CTES["b_cum"] = """
SELECT id_contrato, cal, pagas FROM (
  SELECT id_contrato, cal, asked, CAST(sum(n) OVER (PARTITION BY id_contrato ORDER BY cal) AS BIGINT) AS pagas FROM b_held)
WHERE asked"""
# Month starts at which an instalment is due and not yet paid, listed for each instalment by itself.
CTES["b_oldest"] = f"""
SELECT id_contrato, CAST(aberta AS DATE) AS cal, min(data_vencimento) AS min_unpaid_due FROM (
  SELECT id_contrato, data_vencimento, unnest(generate_series(
    CAST(last_day(data_vencimento - 1) + 1 AS TIMESTAMP),
    CAST(least(coalesce(data_pagamento - 1, {SNAPSHOT}), {SNAPSHOT}) AS TIMESTAMP), INTERVAL 1 MONTH)) AS aberta FROM b_inst)
WHERE aberta >= (SELECT min(cal) FROM b_spine) GROUP BY ALL"""
BUCKET = (
    "CASE WHEN {d} <= 5 THEN 'corrente' WHEN {d} <= 30 THEN 'f5_30' WHEN {d} <= 60 THEN 'f31_60' "
    "WHEN {d} <= 90 THEN 'f61_90' WHEN {d} <= 120 THEN 'f91_120' WHEN {d} <= 150 THEN 'f121_150' "
    "WHEN {d} <= 180 THEN 'f151_180' ELSE 'f180p' END"
)
CTES["b_state"] = f"""
SELECT id_contrato, cal, CAST(pmt * CASE WHEN pagas < num_parcelas THEN num_parcelas - pagas ELSE 0 END AS DOUBLE) AS saldo,
  coalesce({BUCKET.format(d='date_diff(\'day\', min_unpaid_due, cal)').replace("ELSE 'f180p'", "WHEN min_unpaid_due < cal THEN 'f180p'")}, 'corrente') AS bucket
FROM b_cum JOIN (SELECT * FROM b_grid WHERE cal >= min_venc) USING (id_contrato, cal) LEFT JOIN b_oldest USING (id_contrato, cal)"""
BUCKETS = ("corrente", "f5_30", "f31_60", "f61_90", "f91_120", "f121_150", "f151_180", "f180p")
CTES["b_aging"] = f"""
SELECT cal, strftime(cal, '%Y-%m') AS mes, {', '.join(money_if('saldo', f"bucket = '{b}'") + f' AS {b}' for b in BUCKETS)}
FROM b_spine LEFT JOIN b_state USING (cal) GROUP BY cal"""
PAIRS = (
    ("r5_30", "f5_30", "corrente"),
    ("r31_60", "f31_60", "f5_30"),
    ("r61_90", "f61_90", "f31_60"),
    ("r91_120", "f91_120", "f61_90"),
    ("r121_150", "f121_150", "f91_120"),
    ("r151_180", "f151_180", "f121_150"),
)
CTES["b_rolls"] = f"""
SELECT cal, mes, {', '.join(f'CASE WHEN l_{den} > 0 THEN {num} / l_{den} END AS {n}' for n, num, den in PAIRS)},
  CASE WHEN l_f151_180 > 0 THEN (f180p - l_f180p) / l_f151_180 END AS r180p
FROM (SELECT *, {', '.join(f'lag({b}) OVER (ORDER BY cal) AS l_{b}' for b in BUCKETS)}, lag(cal) OVER (ORDER BY cal) AS antes
      FROM b_aging) WHERE antes IS NOT NULL"""
CTES["b_chain"] = """
SELECT *, r61_90 * r91_120 * r121_150 * r151_180 * r180p AS effic60,
  r91_120 * r121_150 * r151_180 * r180p AS effic90 FROM b_rolls"""
CTES["b_ltm"] = f"""
SELECT {', '.join(f'avg({r(n + " * 100", 5)}) AS {n}_pct' for n, _, _ in PAIRS)},
  coalesce(avg(effic60), 0) AS effic60, coalesce(avg(effic90), 0) AS effic90, count(*) AS meses
FROM (SELECT * FROM b_chain ORDER BY cal DESC LIMIT 12) WHERE effic60 IS NOT NULL AND effic90 IS NOT NULL"""

# --- curves ----------------------------------------------------------------

CTES["b_term"] = "SELECT max(num_parcelas) AS t FROM b_loans"
CTES["b_vm"] = """
SELECT s.safra, s.mob, s.principal, s.mob_limpo, s.mob <= s.mob_limpo AS limpo, s.mob <= s.t AS no_prazo,
  coalesce(m.perda, 0) / s.principal * 100 AS ip, coalesce(m.receita, 0) / s.principal * 100 AS ir,
  sum(coalesce(m.perda, 0)) OVER (PARTITION BY s.safra ORDER BY s.mob) / s.principal * 100 AS acum
FROM (SELECT *, CAST(unnest(range(1, greatest(t, mob_limpo) + 1)) AS INTEGER) AS mob FROM b_obs, b_term WHERE principal > 0) s
LEFT JOIN b_mob m USING (safra, mob)"""
CTES["b_final"] = "SELECT safra, mob_limpo, acum AS perda_realizada FROM b_vm WHERE mob = mob_limpo AND mob_limpo >= 6"
CTES["b_groups"] = """
SELECT v.safra, v.principal, v.mob_limpo, f.perda_realizada, CASE WHEN n < 3 THEN 'alto'
    WHEN f.perda_realizada IS NULL THEN 'medio' WHEN f.perda_realizada >= q66 THEN 'alto'
    WHEN f.perda_realizada >= q33 THEN 'medio' ELSE 'baixo' END AS grupo, n
FROM b_obs v LEFT JOIN b_final f USING (safra), (SELECT count(*) AS n, quantile_cont(perda_realizada, 0.3333) AS q33,
  quantile_cont(perda_realizada, 0.6666) AS q66 FROM b_final) WHERE v.principal > 0"""
CTES["b_fed"] = """
SELECT safra, grupo, perda_realizada FROM b_groups WHERE n >= 3 AND perda_realizada IS NOT NULL
UNION ALL SELECT safra, g, perda_realizada FROM b_groups, (VALUES ('alto'), ('medio'), ('baixo')) t(g) WHERE n < 3"""
CTES["b_decay"] = """
SELECT t.g AS grupo, CASE WHEN media IS NULL THEN 0.92e0
    ELSE pow(0.92e0, pow(CASE WHEN geral > 0 THEN media / geral ELSE 1 END, 1.2e0)) END AS decay_receita
FROM (VALUES ('alto'), ('medio'), ('baixo')) t(g)
LEFT JOIN (SELECT grupo, avg(perda_realizada) AS media FROM b_fed GROUP BY 1) m ON m.grupo = t.g,
(SELECT avg(perda_realizada) AS geral FROM b_final)"""
CTES["b_raw"] = """
SELECT t.g AS grupo, s.mob,
  CASE WHEN mp > 0 THEN mp WHEN ap > 0 THEN ap WHEN mp IS NOT NULL THEN 0.001e0 END AS perda,
  CASE WHEN mr > 0 THEN mr WHEN ar > 0 THEN ar WHEN mr IS NOT NULL THEN 0.001e0 END AS receita
FROM (VALUES ('alto'), ('medio'), ('baixo')) t(g), (SELECT CAST(unnest(range(1, t + 1)) AS INTEGER) AS mob FROM b_term) s
LEFT JOIN (SELECT f.grupo, m.mob, median(ip) AS mp, avg(ip) AS ap,
    median(ir * greatest(1 - acum / 100, 0.001e0)) AS mr, avg(ir * greatest(1 - acum / 100, 0.001e0)) AS ar
  FROM b_vm m JOIN b_fed f USING (safra) WHERE limpo GROUP BY 1, 2) x ON x.grupo = t.g AND x.mob = s.mob"""
CTES["b_shape"] = """
SELECT grupo, mob, p AS perda, r AS receita FROM b_steps"""
CTES["b_steps"] = """
SELECT grupo, mob, CASE WHEN perda > 0.001e0 THEN perda ELSE 0.001e0 END AS p,
  CASE WHEN receita > 0.001e0 THEN receita ELSE 0.001e0 END AS r FROM b_raw WHERE mob = 1
UNION ALL
SELECT x.grupo, x.mob, CASE WHEN x.perda > 0.001e0 THEN x.perda ELSE greatest(s.p * 0.85e0, 0.001e0) END,
  CASE WHEN x.receita > 0.001e0 THEN x.receita ELSE greatest(s.r * d.decay_receita, 0.001e0) END
FROM b_steps s JOIN b_raw x ON x.grupo = s.grupo AND x.mob = s.mob + 1 JOIN b_decay d ON d.grupo = s.grupo"""
CTES["b_scale"] = """
SELECT m.safra, greatest(CASE WHEN any_value(m.mob_limpo) >= 4 AND sum(coalesce(s.perda, 0)) > 0
    THEN sum(ip) / sum(coalesce(s.perda, 0)) ELSE 1 END, 0.2e0) AS ep,
  greatest(CASE WHEN any_value(m.mob_limpo) >= 4 AND sum(coalesce(s.receita, 0)) > 0
    THEN sum(ir * greatest(1 - acum / 100, 0.001e0)) / sum(coalesce(s.receita, 0)) ELSE 1 END, 0.2e0) AS er
FROM b_vm m JOIN b_groups g USING (safra) LEFT JOIN b_shape s ON s.grupo = g.grupo AND s.mob = m.mob
WHERE limpo GROUP BY m.safra"""
CTES["b_curve"] = """
SELECT safra, mob, sum(xp) OVER w AS p, sum(xr) OVER w AS r, CASE WHEN limpo THEN 'realizado' ELSE 'projetado' END AS tipo
FROM (SELECT m.safra, m.mob, limpo, CASE WHEN limpo THEN ip ELSE greatest(s.perda * ep, 0.001e0) END AS xp,
    CASE WHEN limpo THEN ir ELSE greatest(s.receita * er, 0.0001e0) END AS xr
  FROM b_vm m JOIN b_groups g USING (safra) JOIN b_scale c USING (safra)
  LEFT JOIN b_shape s ON s.grupo = g.grupo AND s.mob = m.mob WHERE no_prazo)
WINDOW w AS (PARTITION BY safra ORDER BY mob)"""

# --- valuation -------------------------------------------------------------

CTES["b_pd"] = f"SELECT safra, {OVER60} / CAST(count(*) AS DOUBLE) AS pd FROM b_loans GROUP BY safra"
CTES["b_risky"] = """
SELECT safra, dp, sum(pmt) AS v, any_value(pd) * (SELECT effic90 FROM b_ltm) AS tp
FROM b_flow JOIN b_pd USING (safra) GROUP BY safra, dp"""
CTES["b_npv"] = f"""
SELECT taxa * 100 AS taxa_am_pct, cenario, sum(v * (1 - tp * fator) / pow(1 + taxa, dp)) AS vpl
FROM b_risky, (VALUES (0.01e0), (0.015e0)) t(taxa),
  (VALUES ('otimista', 0.8e0), ('base', 1.0e0), ('pessimista', 1.2e0)) c(cenario, fator) GROUP BY taxa, cenario"""
CTES["b_net"] = "SELECT sum(v) AS bruto, sum(v * tp) AS perda, sum(v) - sum(v * tp) AS liquido FROM b_risky"
CTES["b_pe"] = """
SELECT ead_total, ead_inadimplente, over60_pct AS pd, effic90 AS lgd, principal_total,
  ead_total * over60_pct * effic90 AS pe FROM b_ead, b_kpis, b_ltm"""


def sql(select: str) -> str:
    """Prefix a query with the tables of the loan book it uses, in definition order."""
    needed: set[str] = set()
    todo = [select]
    while todo:
        words = set(re.findall(r"\bb_\w+", todo.pop()))
        new = (words & CTES.keys()) - needed
        needed |= new
        todo += [CTES[n] for n in new]
    if not needed:
        return select
    order = sorted(needed, key=_rank)
    keyword = "WITH RECURSIVE" if "b_steps" in needed else "WITH"
    once = {n: "MATERIALIZED " if n in ("b_spine", "b_month", "b_grid", "b_oldest") else "" for n in order}
    return f"{keyword} " + ",\n".join(f"{n} AS {once[n]}({CTES[n]})" for n in order) + f"\n{select}"


def _rank(name: str) -> int:
    """Dependencies first; a table that reads itself does not count."""
    own = {n for n in re.findall(r"\bb_\w+", CTES[name]) if n in CTES and n != name}
    return 1 + max((_rank(n) for n in own), default=0)
