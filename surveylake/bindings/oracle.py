"""The queries of `queries.py` as SQL for DuckDB, written independently of the Spark plans.

Percentages are rounded half up in integers and weights are summed as decimals, so both engines agree to
the last digit.
"""

from __future__ import annotations

BRONZE = """
SELECT
  '2020' AS ano,
  CAST(CASE WHEN k < 7 THEN 11 + k WHEN k < 16 THEN 14 + k WHEN k < 19 THEN 15 + k WHEN k = 19 THEN 35
            WHEN k < 23 THEN 21 + k WHEN k < 27 THEN 27 + k WHEN k = 27 THEN 34 ELSE 99 END AS VARCHAR) AS uf,
  CAST(9 + l_orderkey % 3 AS VARCHAR) AS v1013,
  CAST(1 + l_partkey % 3 AS VARCHAR) AS v1022,
  '1' AS v1023,
  CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) END AS v1032,
  CAST(CAST(2 * l_quantity AS INTEGER) AS VARCHAR) AS a002,
  CAST(1 + l_linenumber % 2 AS VARCHAR) AS a003,
  CASE WHEN l_partkey % 11 = 10 THEN NULL ELSE CAST(1 + l_partkey % 6 AS VARCHAR) END AS a004,
  '1' AS a005,
  CASE l_orderkey % 29 WHEN 0 THEN '1' WHEN 1 THEN '9' ELSE '2' END AS b0011,
  CASE WHEN l_orderkey % 31 = 0 THEN '1' ELSE '2' END AS b0012,
  CASE WHEN l_orderkey % 37 = 0 THEN '1' ELSE '2' END AS b0014,
  CASE WHEN l_orderkey % 41 = 0 THEN '1' ELSE '2' END AS b00111,
  CASE WHEN l_partkey % 7 = 0 THEN '1' ELSE '2' END AS b002,
  CASE WHEN l_partkey % 53 = 0 THEN '1' ELSE '2' END AS b006,
  CAST(1 + l_suppkey % 3 AS VARCHAR) AS b007,
  CASE l_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '1' ELSE '2' END AS b009b,
  CASE WHEN l_orderkey % 5 <> 1 THEN NULL WHEN l_linenumber % 3 = 0 THEN '1' ELSE '2' END AS b011,
  CASE l_partkey % 13 WHEN 0 THEN '1' WHEN 1 THEN NULL ELSE '2' END AS c001
FROM (SELECT *, l_partkey % 29 AS k FROM lineitem)
"""

# State codes and names.
STATE_ROWS = """
(11, 'Rondonia'), (12, 'Acre'), (13, 'Amazonas'), (14, 'Roraima'), (15, 'Para'), (16, 'Amapa'),
(17, 'Tocantins'), (21, 'Maranhao'), (22, 'Piaui'), (23, 'Ceara'), (24, 'Rio Grande do Norte'),
(25, 'Paraiba'), (26, 'Pernambuco'), (27, 'Alagoas'), (28, 'Sergipe'), (29, 'Bahia'),
(31, 'Minas Gerais'), (32, 'Espirito Santo'), (33, 'Rio de Janeiro'), (35, 'Sao Paulo'), (41, 'Parana'),
(42, 'Santa Catarina'), (43, 'Rio Grande do Sul'), (50, 'Mato Grosso do Sul'), (51, 'Mato Grosso'),
(52, 'Goias'), (53, 'Distrito Federal')
"""

# Accented names of the states that have accents.
ACCENTED_ROWS = """
(11, 'RONDÔNIA'), (15, 'PARÁ'), (16, 'AMAPÁ'), (21, 'MARANHÃO'), (22, 'PIAUÍ'), (23, 'CEARÁ'),
(25, 'PARAÍBA'), (32, 'ESPÍRITO SANTO'), (35, 'SÃO PAULO'), (41, 'PARANÁ'), (52, 'GOIÁS')
"""

COMMON = f"""
states(code, nome) AS (VALUES {STATE_ROWS}),
bronze AS ({BRONZE}),
typed AS (
  SELECT *,
    TRY_CAST(ano AS INTEGER) AS ano_int, TRY_CAST(uf AS INTEGER) AS uf_int, TRY_CAST(v1013 AS INTEGER) AS mes_int,
    TRY_CAST(a002 AS INTEGER) AS idade, TRY_CAST(a003 AS INTEGER) AS sexo, TRY_CAST(a004 AS INTEGER) AS cor_raca,
    TRY_CAST(b0011 AS INTEGER) AS febre, TRY_CAST(b0012 AS INTEGER) AS tosse,
    TRY_CAST(b0014 AS INTEGER) AS dif_respirar, TRY_CAST(b00111 AS INTEGER) AS perda_cheiro,
    TRY_CAST(b002 AS INTEGER) AS procurou_atendimento, TRY_CAST(b006 AS INTEGER) AS internado,
    TRY_CAST(b007 AS INTEGER) AS plano_saude, TRY_CAST(b009b AS INTEGER) AS fez_teste,
    TRY_CAST(b011 AS INTEGER) AS resultado_teste, TRY_CAST(c001 AS INTEGER) AS afastou_trabalho,
    TRY_CAST(v1032 AS DOUBLE) AS peso
  FROM (SELECT DISTINCT * FROM bronze)
),
silver AS (
  SELECT typed.*,
    COALESCE(states.nome, 'Desconhecido') AS uf_nome,
    CASE WHEN uf_int BETWEEN 11 AND 17 THEN 'Norte' WHEN uf_int BETWEEN 21 AND 29 THEN 'Nordeste'
         WHEN uf_int BETWEEN 31 AND 35 THEN 'Sudeste' WHEN uf_int BETWEEN 41 AND 43 THEN 'Sul'
         WHEN uf_int BETWEEN 50 AND 53 THEN 'Centro-Oeste' ELSE 'Desconhecido' END AS regiao,
    CASE WHEN febre = 1 OR tosse = 1 OR dif_respirar = 1 OR perda_cheiro = 1 THEN 1 ELSE 0 END AS teve_sintomas_covid
  FROM typed LEFT JOIN states ON typed.uf_int = states.code
)
"""


def count(condition: str) -> str:
    return f"CAST(COUNT(*) FILTER (WHERE {condition}) AS BIGINT)"


def rounded(part: str, whole: str, digits: int = 2) -> str:
    """`part` percent of `whole`, rounded half up without leaving integers."""
    unit = 10**digits
    part, whole = f"CAST({part} AS BIGINT)", f"CAST({whole} AS BIGINT)"
    return f"CAST((({part} * {200 * unit} + {whole}) // (2 * {whole})) / {unit}.0 AS DOUBLE)"


def pct(condition: str) -> str:
    return rounded(count(condition), "COUNT(*)")


def total(column: str) -> str:
    return f"CAST(SUM({column}) AS BIGINT)"


def ratio(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) * 100"


def mean_rate(column: str) -> str:
    return f"CAST(SUM(CAST({column} AS DECIMAL(18,2))) AS DOUBLE) / COUNT({column})"


def share_text(part: str, whole: str, digits: int) -> str:
    """The rounded percent as text with a fixed number of decimals."""
    unit = 10**digits
    scaled = f"((CAST({part} AS BIGINT) * {200 * unit} + CAST({whole} AS BIGINT)) // (2 * CAST({whole} AS BIGINT)))"
    return f"(CAST({scaled} // {unit} AS VARCHAR) || '.' || LPAD(CAST({scaled} % {unit} AS VARCHAR), {digits}, '0'))"


POPULATION = "CAST(SUM(COALESCE(CAST(peso AS DECIMAL(18,2)), 0)) AS DOUBLE) AS populacao_estimada"

GOLD = {
    "sintomas_uf_mes": f"""
SELECT uf, uf_nome, regiao, mes_int AS mes, COUNT(*) AS total_entrevistados,
  {count("febre = 1")} AS total_com_febre, {count("tosse = 1")} AS total_com_tosse,
  {count("dif_respirar = 1")} AS total_dificuldade_respirar, {count("perda_cheiro = 1")} AS total_perda_cheiro,
  {count("teve_sintomas_covid = 1")} AS total_com_sintomas_covid,
  {count("procurou_atendimento = 1")} AS total_procurou_atendimento,
  {count("internado = 1")} AS total_internados, {POPULATION},
  {pct("teve_sintomas_covid = 1")} AS pct_sintomas_covid,
  {pct("procurou_atendimento = 1")} AS pct_procurou_atendimento, {pct("internado = 1")} AS pct_internados
FROM silver GROUP BY uf, uf_nome, regiao, mes_int""",
    "trabalho_regiao_mes": f"""
SELECT regiao, mes_int AS mes, COUNT(*) AS total_entrevistados,
  {count("afastou_trabalho = 1")} AS total_afastados, {count("afastou_trabalho = 2")} AS total_nao_afastados,
  {POPULATION}, {pct("afastou_trabalho = 1")} AS pct_afastados
FROM silver GROUP BY regiao, mes_int""",
    "perfil_sintomaticos": f"""
SELECT sexo, cor_raca, COUNT(*) AS total_sintomaticos, AVG(idade) AS idade_media,
  {count("plano_saude = 1")} AS com_plano_saude, {count("silver.procurou_atendimento = 1")} AS procurou_atendimento,
  {POPULATION},
  CASE sexo WHEN 1 THEN 'Masculino' WHEN 2 THEN 'Feminino' ELSE 'Nao informado' END AS sexo_desc,
  CASE cor_raca WHEN 1 THEN 'Branca' WHEN 2 THEN 'Preta' WHEN 3 THEN 'Amarela' WHEN 4 THEN 'Parda'
                WHEN 5 THEN 'Indigena' ELSE 'Nao informado' END AS cor_raca_desc
FROM silver WHERE teve_sintomas_covid = 1 GROUP BY sexo, cor_raca""",
    "testes_uf": f"""
SELECT uf, uf_nome, regiao, COUNT(*) AS total_entrevistados,
  {count("fez_teste = 1")} AS total_testados, {count("resultado_teste = 1")} AS total_positivos,
  {count("resultado_teste = 2")} AS total_negativos, {POPULATION}, {pct("fez_teste = 1")} AS pct_testados,
  CASE WHEN {count("fez_teste = 1")} > 0 THEN {rounded(count("resultado_teste = 1"), count("fez_teste = 1"))}
       ELSE CAST(0 AS DOUBLE) END AS taxa_positividade
FROM silver WHERE fez_teste IS NOT NULL GROUP BY uf, uf_nome, regiao""",
    "evolucao_nacional": f"""
SELECT mes_int AS mes, COUNT(*) AS total_entrevistados, {count("teve_sintomas_covid = 1")} AS total_com_sintomas,
  {count("fez_teste = 1")} AS total_testados, {count("resultado_teste = 1")} AS total_positivos,
  {count("internado = 1")} AS total_internados, {count("afastou_trabalho = 1")} AS total_afastados_trabalho,
  {POPULATION}, {pct("teve_sintomas_covid = 1")} AS pct_sintomaticos, {pct("fez_teste = 1")} AS pct_testados
FROM silver GROUP BY mes_int""",
    "acesso_saude": f"""
SELECT plano_saude, v1022 AS situacao_domicilio, COUNT(*) AS total_sintomaticos,
  {count("silver.procurou_atendimento = 1")} AS procurou_atendimento, {count("internado = 1")} AS internados,
  {count("silver.fez_teste = 1")} AS fez_teste, AVG(idade) AS idade_media, {POPULATION},
  CASE plano_saude WHEN 1 THEN 'Com plano de saude' WHEN 2 THEN 'Sem plano de saude'
                   ELSE 'Nao informado' END AS plano_saude_desc,
  CASE v1022 WHEN '1' THEN 'Urbano' WHEN '2' THEN 'Rural' ELSE 'Nao informado' END AS situacao_desc,
  {pct("silver.procurou_atendimento = 1")} AS pct_procurou_atendimento, {pct("internado = 1")} AS pct_internados,
  {pct("silver.fez_teste = 1")} AS pct_testados
FROM silver WHERE teve_sintomas_covid = 1 GROUP BY plano_saude, v1022""",
}

SIX_TABLES = " UNION ALL BY NAME ".join(f"SELECT '{name}' AS tabela, * FROM {name}" for name in GOLD)

GOLD_WIDTHS = {
    "sintomas_uf_mes": 16,
    "trabalho_regiao_mes": 7,
    "perfil_sintomaticos": 9,
    "testes_uf": 10,
    "evolucao_nacional": 10,
    "acesso_saude": 13,
}


def survey(select: str) -> str:
    """A query over the common table expressions and all six gold tables."""
    tables = ", ".join(f"{name} AS ({sql})" for name, sql in GOLD.items())
    return f"WITH {COMMON}, {tables} {select}"


def checks(*rows: tuple[str, str, str, str, str]) -> str:
    """Check rows as a UNION ALL; each row is (name, passed, expected, actual, message) of SQL expressions."""
    names = "check_name", "passed", "expected", "actual", "message"
    return " UNION ALL ".join(
        "SELECT " + ", ".join(f"{value} AS {name}" for name, value in zip(names, row[:5])) + f" FROM {row[5]}"
        for row in rows
    )


def duplicates(keys: str) -> str:
    """The duplicate check of the rows that a SELECT of the keys alone gives."""
    return f"""
        SELECT 'no_duplicates' AS check_name, d = 0 AS passed, '0 duplicates' AS expected,
          d || ' duplicates' AS actual,
          'Encontradas ' || d || ' linhas duplicadas (' || {share_text("d", "n", 2)} || '%)' AS message
        FROM (SELECT n - k AS d, n FROM (
          SELECT (SELECT COUNT(*) FROM ({keys})) AS n, (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM ({keys}))) AS k))"""


def completeness(column: str) -> tuple[str, ...]:
    share = share_text(f"COUNT({column})", "COUNT(*)", 1)
    return (
        f"'completeness_{column}'",
        f"COUNT({column}) * 100 >= COUNT(*) * 95",
        "'>=95%'",
        f"{share} || '%'",
        f"'Completude de {column}: ' || {share} || '%'",
        "silver",
    )


def outside(column: str, low: int, high: int, source: str) -> tuple[str, ...]:
    bad = f"COUNT(*) FILTER (WHERE {column} < {low} OR {column} > {high})"
    return (
        f"'range_{column}'",
        f"{bad} = 0",
        f"'[{low}, {high}]'",
        f"{bad} || ' out of range'",
        f"'Valores fora do range: ' || {bad}",
        source,
    )


UF_VALIDITY = (
    "'uf_validity'",
    "COUNT(*) = 0",
    "'all UFs valid'",
    "COUNT(*) || ' invalid UFs'",
    "CASE WHEN COUNT(*) = 0 THEN 'Todas UFs válidas' ELSE 'UFs inválidas encontradas: [' ||"
    " array_to_string(list_slice(list(code ORDER BY code), 1, 5), ', ') || ']' END",
    "(SELECT DISTINCT uf_int AS code FROM silver"
    " WHERE uf_int NOT IN (SELECT code FROM states) OR uf_int IS NULL) AS bad",
)

ABSENT = (
    "'completeness_renda'",
    "false",
    "'column exists'",
    "'column missing'",
    "'Coluna renda não encontrada'",
    "(SELECT 1)",
)

SUITE = checks(
    completeness("uf_int"),
    completeness("idade"),
    completeness("sexo"),
    completeness("peso"),
    outside("idade", 0, 120, "silver"),
    UF_VALIDITY,
)

CORE = """ano, uf, v1013, v1022, v1023, v1032, a002, a003, a004, a005, b0011, b0012, b0014, b00111,
b002, b006, b007, b009b, b011, c001"""
PERIOD = "ano AS year, LPAD(v1013, 2, '0') AS month"
ORDER_PERIOD = "strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month"
KNOWN = "sexo_desc <> 'Nao informado' AND cor_raca_desc <> 'Nao informado'"
WEIGHTS = "CAST(SUM(COALESCE(CAST(peso AS DECIMAL(18,2)), 0)) AS DOUBLE)"
DRIFTED = "CASE WHEN v1013 = '11' THEN NULL ELSE {0} END AS {0}"

ORACLE_SQL: dict[str, str] = {f"gold_{name}": survey(f"SELECT * FROM {name}") for name in GOLD}

ORACLE_SQL |= {
    # Sources, ingest and catalog
    "ingest_archives": f"SELECT {CORE}, {PERIOD} FROM ({BRONZE})",
    "period_from_path": """
        SELECT o_orderkey, '/drop/MICRODADOS_' || strftime(o_orderdate, '%m%Y') || '.zip' AS path,
          strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month FROM orders""",
    "period_allowlist": f"""
        SELECT o_orderkey, {ORDER_PERIOD} FROM orders WHERE month(o_orderdate) BETWEEN 9 AND 11""",
    "land_partitioned": f"SELECT {CORE}, {PERIOD} FROM ({BRONZE})",
    "scan_csv": f"""
        SELECT ano, uf, v1013, v1022, v1023, v1032, a002, a003, a004, {DRIFTED.format("a005")}, b0011, b0012, b0014,
          b00111, b002, b006, b007, b009b, {DRIFTED.format("b011")}, c001,
          CASE WHEN v1013 = '10' THEN '7' END AS f001, {PERIOD}
        FROM ({BRONZE})""",
    "conform_union": """
        SELECT l_orderkey, l_linenumber, l_quantity, CAST(NULL AS DOUBLE) AS l_tax FROM lineitem
        UNION ALL SELECT l_orderkey, NULL, l_quantity, l_tax FROM lineitem""",
    "register_bronze": f"""
        SELECT ano AS year, LPAD(v1013, 2, '0') AS month, COUNT(*) AS n_rows, {count("c001 IS NULL")} AS n_unknown,
          CAST(SUM(COALESCE(CAST(v1032 AS DECIMAL(18,2)), 0)) AS DOUBLE) AS populacao
        FROM ({BRONZE}) GROUP BY ALL""",
    "discover_partitions": f"SELECT DISTINCT {ORDER_PERIOD} FROM orders",
    "missing_partitions": f"""
        SELECT year, month, CASE WHEN bool_or(known) THEN 'existing' ELSE 'added' END AS status
        FROM (SELECT {ORDER_PERIOD}, o_orderpriority = '1-URGENT' AND o_totalprice > 495000 AS known FROM orders)
        GROUP BY year, month""",
    "register_gold": survey(
        " UNION ALL ".join(
            f"SELECT 'gold_{name}' AS tabela, COUNT(*) AS linhas, {width} AS colunas FROM {name}"
            for name, width in GOLD_WIDTHS.items()
        )
    ),
    "run_sql": survey(f"""
        SELECT uf_nome, regiao, {total("total_com_sintomas_covid")} AS total_sintomaticos
        FROM sintomas_uf_mes GROUP BY uf_nome, regiao"""),
    # Sinks
    "silver_roundtrip": survey("SELECT * FROM silver"),
    "gold_roundtrip": survey(SIX_TABLES),
    "lake_refresh": survey("SELECT * FROM silver"),
    "lake_gold": survey(SIX_TABLES),
    "lake_published": survey(SIX_TABLES),
    "refresh_periods": survey(f"""
        SELECT ano, v1013, CASE WHEN v1013 = '9' THEN 'earlier' ELSE v1023 END AS v1023, COUNT(*) AS n_rows,
          {WEIGHTS} AS populacao
        FROM silver GROUP BY ALL"""),
    # Projections and scalar expressions
    "normalize_columns": "SELECT * EXCLUDE (o_orderdate) FROM orders",
    "missing_columns": f"""
        SELECT ano AS year, LPAD(v1013, 2, '0') AS month, column_name, COUNT(*) AS n_rows
        FROM ({BRONZE}) CROSS JOIN (VALUES ('a005'), ('b011')) AS absent(column_name)
        WHERE v1013 = '11' GROUP BY ALL""",
    "fill_missing_columns": """
        SELECT l_orderkey, l_linenumber, l_quantity, CAST(NULL AS VARCHAR) AS b011, CAST(NULL AS VARCHAR) AS c001
        FROM lineitem""",
    "silver_build": survey("SELECT * FROM silver"),
    "code_label": f"""
        WITH states(code, nome) AS (VALUES {STATE_ROWS})
        SELECT c_custkey, c_nationkey, COALESCE(n_name, 'Desconhecido') AS nation,
          COALESCE(nome, 'Desconhecido') AS state
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN states ON c_nationkey = code""",
    "label_from_ranges": """
        SELECT l.*, coalesce(o.o_orderpriority, 'none') AS priority
        FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_orderkey * 1000 + l_partkey % 1000 AS code FROM lineitem) l
        LEFT JOIN orders o ON code >= o_orderkey * 1000 AND code <= o_orderkey * 1000 + o_custkey % 990""",
    "range_label": """
        SELECT p_partkey, p_size, CASE WHEN p_size BETWEEN 1 AND 10 THEN 'pequeno'
          WHEN p_size BETWEEN 11 AND 20 THEN 'medio' WHEN p_size BETWEEN 31 AND 50 THEN 'grande'
          ELSE 'Desconhecido' END AS size_range
        FROM part""",
    "any_flag": """
        SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = CAST(0.1 AS DOUBLE) OR l_tax = 0 OR l_quantity = 50
          THEN 1 ELSE 0 END AS flag
        FROM lineitem""",
    "typed_columns": """
        SELECT l_orderkey, l_linenumber, CAST(l_partkey AS INTEGER) AS padded_int, CAST(NULL AS INTEGER) AS price_int,
          l_extendedprice AS price_double, CAST(NULL AS INTEGER) AS flag_int
        FROM lineitem""",
    "domain_label": """
        SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 'Fechado' WHEN 'O' THEN 'Aberto'
          ELSE 'Nao informado' END AS status_desc
        FROM orders""",
    "reverse_label": f"""
        WITH states(code, nome) AS (VALUES {STATE_ROWS}), accented(acode, anome) AS (VALUES {ACCENTED_ROWS})
        SELECT c_custkey, COALESCE(anome, upper(nome), 'DESCONHECIDO') AS name, code
        FROM customer LEFT JOIN states ON c_nationkey = code LEFT JOIN accented ON c_nationkey = acode""",
    "month_label": """
        SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS mes, CASE month(o_orderdate) WHEN 9 THEN 'Set'
          WHEN 10 THEN 'Out' WHEN 11 THEN 'Nov' ELSE CAST(month(o_orderdate) AS VARCHAR) END AS mes_nome
        FROM orders""",
    "predicates": """
        SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
        WHERE l_returnflag = 'R' AND l_linenumber IN (1, 3, 5) AND l_quantity BETWEEN 10 AND 30
          AND (l_discount = CAST(0.05 AS DOUBLE) OR l_tax = CAST(0.02 AS DOUBLE))
          AND l_shipdate IS NOT NULL AND l_linestatus <> 'O'""",
    # Filters
    "filter_months": """
        SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS mes FROM orders
        WHERE month(o_orderdate) IN (9, 10, 11)""",
    "filter_known_labels": survey(f"SELECT * FROM perfil_sintomaticos WHERE {KNOWN}"),
    "series_by_region": survey("SELECT regiao, mes, pct_afastados FROM trabalho_regiao_mes"),
    # Aggregations and distinct
    "group_count": "SELECT event_type, COUNT(*) AS n FROM events GROUP BY event_type",
    "count_where": f"""
        SELECT l_returnflag, l_linestatus, {count("l_quantity = 50")} AS n_full, {count("l_tax = 0")} AS n_untaxed
        FROM lineitem GROUP BY ALL""",
    "flag_total": f"""
        SELECT quality, {total("CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END")} AS n_flagged
        FROM labels GROUP BY quality""",
    "weighted_total": """
        SELECT l_returnflag, l_linestatus, CAST(SUM(CASE WHEN l_partkey % 17 = 0 THEN 0
          ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS total
        FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "group_mean": """
        SELECT c_mktsegment, AVG(CAST(round(c_acctbal * 100) AS BIGINT)) AS mean_cents
        FROM customer GROUP BY c_mktsegment""",
    "pct_of_group": f"""
        SELECT l_returnflag, l_linestatus, {pct("l_quantity > 25")} AS pct_large,
          {pct("l_discount = 0")} AS pct_full_price
        FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "safe_ratio": f"""
        SELECT quality, toxic, CASE WHEN {count("quality = 1")} > 0
          THEN {rounded(count("toxic = 1"), count("quality = 1"))} ELSE CAST(0 AS DOUBLE) END AS toxic_per_good
        FROM labels GROUP BY quality, toxic""",
    "dedup_rows": "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem",
    "dedup_rows_by_hash": "SELECT DISTINCT * REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM lineitem",
    "distinct_values": "SELECT DISTINCT o_orderpriority FROM orders",
    "period_totals": survey(f"""
        SELECT *, {ratio("total_com_sintomas", "total_entrevistados")} AS pct_sintomaticos,
          {ratio("total_testados", "total_entrevistados")} AS pct_testados,
          {ratio("total_positivos", "total_testados")} AS taxa_positividade
        FROM (SELECT {total("total_entrevistados")} AS total_entrevistados,
                {total("total_com_sintomas")} AS total_com_sintomas, {total("total_testados")} AS total_testados,
                {total("total_positivos")} AS total_positivos, {total("total_internados")} AS total_internados
              FROM evolucao_nacional WHERE mes IN (9, 10, 11))"""),
    "symptoms_by_state": survey(f"""
        SELECT uf_nome, regiao, {total("total_com_sintomas_covid")} AS total_com_sintomas_covid,
          {total("total_entrevistados")} AS total_entrevistados,
          {mean_rate("pct_sintomas_covid")} AS pct_sintomas_covid
        FROM sintomas_uf_mes WHERE mes IN (9, 10, 11) GROUP BY uf_nome, regiao"""),
    "absence_by_region": survey(f"""
        SELECT *, {ratio("total_afastados", "total_entrevistados")} AS pct_afastados
        FROM (SELECT regiao, {total("total_afastados")} AS total_afastados,
                {total("total_entrevistados")} AS total_entrevistados FROM trabalho_regiao_mes
              WHERE mes IN (9, 10, 11) GROUP BY regiao)"""),
    "positivity_by_region": survey(f"""
        SELECT *, {ratio("total_positivos", "total_testados")} AS taxa
        FROM (SELECT regiao, {total("total_testados")} AS total_testados,
                {total("total_positivos")} AS total_positivos FROM testes_uf GROUP BY regiao)"""),
    "symptomatic_by_sex": survey(f"""
        SELECT sexo_desc, {total("total_sintomaticos")} AS total_sintomaticos
        FROM perfil_sintomaticos WHERE {KNOWN} GROUP BY sexo_desc"""),
    "symptomatic_by_race": survey(f"""
        SELECT cor_raca_desc, {total("total_sintomaticos")} AS total_sintomaticos
        FROM perfil_sintomaticos WHERE {KNOWN} GROUP BY cor_raca_desc"""),
    "share_by_sex": survey(f"""
        SELECT sexo_desc, total_sintomaticos,
          {rounded("total_sintomaticos", "(SUM(total_sintomaticos) OVER ())", 1)} AS pct_total
        FROM (SELECT sexo_desc, {total("total_sintomaticos")} AS total_sintomaticos
              FROM perfil_sintomaticos WHERE {KNOWN} GROUP BY sexo_desc)"""),
    "mean_of_rates": survey(f"SELECT {mean_rate('taxa_positividade')} AS media_nacional FROM testes_uf"),
    "table_count": "SELECT COUNT(*) AS cnt FROM lineitem",
    "table_shapes": survey(
        " UNION ALL ".join(
            f"SELECT '{name}' AS tabela, COUNT(*) AS linhas, {width} AS colunas FROM {name}"
            for name, width in GOLD_WIDTHS.items()
        )
    ),
    # Report queries
    "report_evolution": survey("""
        SELECT mes, total_entrevistados, total_com_sintomas, pct_sintomaticos, total_testados, total_positivos
        FROM evolucao_nacional ORDER BY mes LIMIT 20"""),
    "report_top_states": survey(f"""
        SELECT uf_nome, regiao, {total("total_com_sintomas_covid")} AS total_sintomaticos,
          CAST((2 * SUM(CAST(round(pct_sintomas_covid * 100) AS BIGINT)) + COUNT(*)) // (2 * COUNT(*)) / 100.0
            AS DOUBLE) AS media_pct_sintomas
        FROM sintomas_uf_mes GROUP BY uf_nome, regiao
        ORDER BY total_sintomaticos DESC, uf_nome, regiao LIMIT 10"""),
    "report_evolution_months": survey("""
        SELECT *, CASE mes WHEN 9 THEN 'Set' WHEN 10 THEN 'Out' WHEN 11 THEN 'Nov' END AS mes_nome
        FROM evolucao_nacional WHERE mes IN (9, 10, 11) ORDER BY mes"""),
    "sample_rows": survey("SELECT * FROM sintomas_uf_mes ORDER BY mes, uf LIMIT 5"),
    "positivity_ranked": survey("SELECT uf_nome, regiao, taxa_positividade FROM testes_uf"),
    "mean_pct_by_region": survey(f"""
        SELECT regiao, {mean_rate("pct_sintomas_covid")} AS pct_sintomas_covid
        FROM sintomas_uf_mes WHERE mes IN (9, 10, 11) GROUP BY regiao"""),
    # Data quality
    "check_completeness": survey(
        checks(
            completeness("uf_int"),
            completeness("cor_raca"),
            completeness("fez_teste"),
            completeness("peso"),
            ABSENT,
        )
    ),
    "check_domain": survey(checks(UF_VALIDITY)),
    "check_duplicates": duplicates("SELECT l_orderkey, l_linenumber FROM lineitem"),
    "check_duplicates_by_period": duplicates("SELECT l_partkey, l_suppkey FROM lineitem")
    + " UNION ALL "
    + duplicates("SELECT l_orderkey, year(l_shipdate), month(l_shipdate) FROM lineitem"),
    "lake_duplicates": survey(duplicates("SELECT uf, a002, v1032 FROM silver")),
    "noted_partitions": survey("SELECT ano, v1013, COUNT(*) AS n_rows FROM silver WHERE v1013 <> '9' GROUP BY ALL"),
    "check_range": checks(outside("p_size", 1, 40, "part"), outside("l_quantity", 1, 50, "lineitem")),
    "check_expected_set": """
        WITH found AS (SELECT DISTINCT CAST(month(ts) AS INTEGER) AS value FROM events),
             wanted(value) AS (VALUES (9), (10), (11))
        SELECT value, 'unexpected' AS status FROM found WHERE value NOT IN (SELECT value FROM wanted)
        UNION ALL SELECT value, 'missing' FROM wanted WHERE value NOT IN (SELECT value FROM found)""",
    "quality_results": survey(f"SELECT *, 'run-1' AS run_id FROM ({SUITE})"),
    "quality_summary": survey(f"""
        SELECT COUNT(*) AS total, {count("passed")} AS passed, {count("NOT passed")} AS failed,
          {rounded(count("passed"), "COUNT(*)", 1)} AS pct_passed
        FROM ({SUITE})"""),
    "gold_validation": survey("""
        SELECT name AS check_name, n IS NOT NULL AS passed, 'query succeeds' AS expected,
          COALESCE(n || ' rows', 'error') AS actual
        FROM (
          SELECT 'Count gold_evolucao_nacional' AS name, COUNT(*) AS n FROM (SELECT COUNT(*) FROM evolucao_nacional)
          UNION ALL
          SELECT 'Count gold_sintomas_uf_mes', COUNT(*) FROM (SELECT COUNT(*) FROM sintomas_uf_mes)
          UNION ALL
          SELECT 'Sample gold_evolucao_nacional', COUNT(*) FROM (SELECT * FROM evolucao_nacional LIMIT 5)
          UNION ALL
          SELECT 'Many rows', COUNT(*) FROM lineitem
          UNION ALL
          SELECT 'Absent table', NULL
        )"""),
}
