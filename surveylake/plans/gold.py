"""Silver to gold: six aggregate tables, each from its own scan or all from one shared aggregate.

Every gold figure is a count, an exact sum, or a quotient of two such figures, so it can be computed from
the silver rows or from partial results of any finer grouping. A table is therefore described by its keys,
its filter and the measures it adds up; both paths end in the same final projection.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.functions import labels
from surveylake.functions.codes import try_int
from surveylake.functions.metrics import count_where, percent, row_count, safe_ratio, weighted_sum
from surveylake.sources.layers import write_table

# Sums over silver rows, by measure name.
MEASURES: dict[str, Callable[[], Column]] = {
    "rows": row_count,
    "fever": lambda: count_where(F.col("febre") == 1),
    "cough": lambda: count_where(F.col("tosse") == 1),
    "breathing": lambda: count_where(F.col("dif_respirar") == 1),
    "smell": lambda: count_where(F.col("perda_cheiro") == 1),
    "symptoms": lambda: F.sum("teve_sintomas_covid"),
    "sought_care": lambda: count_where(F.col("procurou_atendimento") == 1),
    "hospital": lambda: count_where(F.col("internado") == 1),
    "with_plan": lambda: count_where(F.col("plano_saude") == 1),
    "away": lambda: count_where(F.col("afastou_trabalho") == 1),
    "not_away": lambda: count_where(F.col("afastou_trabalho") == 2),
    "tested": lambda: count_where(F.col("fez_teste") == 1),
    "positive": lambda: count_where(F.col("resultado_teste") == 1),
    "negative": lambda: count_where(F.col("resultado_teste") == 2),
    "weight": lambda: weighted_sum(F.col("peso")),
    "age_sum": lambda: F.sum("idade"),
    "age_known": lambda: F.count("idade"),
}

# Grain of the shared aggregate: raw state and area codes and typed codes, so its size follows the distinct codes.
SHARED_KEYS = ("uf", "mes_int", "sexo", "cor_raca", "plano_saude", "v1022", "teve_sintomas_covid", "teste_informado")


def _count(measure: str) -> Column:
    return F.col(f"m_{measure}")


def _share(measure: str, of: str = "rows") -> Column:
    return percent(_count(measure), _count(of))


def _population() -> Column:
    return _count("weight").cast("double")


def _mean_age() -> Column:
    return F.try_divide(_count("age_sum"), _count("age_known"))


@dataclass(frozen=True)
class GoldTable:
    """One aggregate table: group keys (output name -> silver column), row filter, and output columns.

    Output columns are built on the keys and on measure sums. `labels` are functions of the keys, so they
    are computed for the few result rows and never take part in the grouping.
    """

    keys: Mapping[str, str]
    measures: tuple[str, ...]
    columns: Mapping[str, Callable[[], Column]]
    where: Callable[[], Column] | None = None
    order_by: str | None = None


def _key(name: str) -> Callable[[], Column]:
    return lambda: F.col(name)


def _state() -> Column:
    return labels.state_name(try_int("uf"))


def _state_region() -> Column:
    return labels.region_name(try_int("uf"))


def _domain(key: str, book: Mapping, typed: bool = True) -> Callable[[], Column]:
    return lambda: labels.code_label(F.col(key) if typed else try_int(key), book, labels.NOT_INFORMED)


def _m(measure: str) -> Callable[[], Column]:
    return partial(_count, measure)


def _pct(measure: str) -> Callable[[], Column]:
    return partial(_share, measure)


GOLD_TABLES: dict[str, GoldTable] = {
    "sintomas_uf_mes": GoldTable(
        keys={"uf": "uf", "mes": "mes_int"},
        measures=(
            "rows", "fever", "cough", "breathing", "smell", "symptoms", "sought_care", "hospital", "weight",
        ),
        columns={
            "uf": _key("uf"),
            "uf_nome": _state,
            "regiao": _state_region,
            "mes": _key("mes"),
            "total_entrevistados": _m("rows"),
            "total_com_febre": _m("fever"),
            "total_com_tosse": _m("cough"),
            "total_dificuldade_respirar": _m("breathing"),
            "total_perda_cheiro": _m("smell"),
            "total_com_sintomas_covid": _m("symptoms"),
            "total_procurou_atendimento": _m("sought_care"),
            "total_internados": _m("hospital"),
            "populacao_estimada": _population,
            "pct_sintomas_covid": _pct("symptoms"),
            "pct_procurou_atendimento": _pct("sought_care"),
            "pct_internados": _pct("hospital"),
        },
    ),
    "trabalho_regiao_mes": GoldTable(
        keys={"regiao": "regiao", "mes": "mes_int"},
        measures=("rows", "away", "not_away", "weight"),
        columns={
            "regiao": _key("regiao"),
            "mes": _key("mes"),
            "total_entrevistados": _m("rows"),
            "total_afastados": _m("away"),
            "total_nao_afastados": _m("not_away"),
            "populacao_estimada": _population,
            "pct_afastados": _pct("away"),
        },
    ),
    "perfil_sintomaticos": GoldTable(
        keys={"sexo": "sexo", "cor_raca": "cor_raca"},
        where=lambda: F.col("teve_sintomas_covid") == 1,
        measures=("rows", "age_sum", "age_known", "with_plan", "sought_care", "weight"),
        columns={
            "sexo": _key("sexo"),
            "cor_raca": _key("cor_raca"),
            "total_sintomaticos": _m("rows"),
            "idade_media": _mean_age,
            "com_plano_saude": _m("with_plan"),
            "procurou_atendimento": _m("sought_care"),
            "populacao_estimada": _population,
            "sexo_desc": _domain("sexo", labels.SEX),
            "cor_raca_desc": _domain("cor_raca", labels.RACE),
        },
    ),
    "testes_uf": GoldTable(
        keys={"uf": "uf"},
        where=lambda: F.col("teste_informado"),
        measures=("rows", "tested", "positive", "negative", "weight"),
        columns={
            "uf": _key("uf"),
            "uf_nome": _state,
            "regiao": _state_region,
            "total_entrevistados": _m("rows"),
            "total_testados": _m("tested"),
            "total_positivos": _m("positive"),
            "total_negativos": _m("negative"),
            "populacao_estimada": _population,
            "pct_testados": _pct("tested"),
            "taxa_positividade": lambda: safe_ratio(_count("positive"), _count("tested")),
        },
    ),
    "evolucao_nacional": GoldTable(
        keys={"mes": "mes_int"},
        order_by="mes",
        measures=("rows", "symptoms", "tested", "positive", "hospital", "away", "weight"),
        columns={
            "mes": _key("mes"),
            "total_entrevistados": _m("rows"),
            "total_com_sintomas": _m("symptoms"),
            "total_testados": _m("tested"),
            "total_positivos": _m("positive"),
            "total_internados": _m("hospital"),
            "total_afastados_trabalho": _m("away"),
            "populacao_estimada": _population,
            "pct_sintomaticos": _pct("symptoms"),
            "pct_testados": _pct("tested"),
        },
    ),
    "acesso_saude": GoldTable(
        keys={"plano_saude": "plano_saude", "situacao_domicilio": "v1022"},
        where=lambda: F.col("teve_sintomas_covid") == 1,
        measures=("rows", "sought_care", "hospital", "tested", "age_sum", "age_known", "weight"),
        columns={
            "plano_saude": _key("plano_saude"),
            "situacao_domicilio": _key("situacao_domicilio"),
            "total_sintomaticos": _m("rows"),
            "procurou_atendimento": _m("sought_care"),
            "internados": _m("hospital"),
            "fez_teste": _m("tested"),
            "idade_media": _mean_age,
            "populacao_estimada": _population,
            "plano_saude_desc": _domain("plano_saude", labels.HEALTH_PLAN),
            "situacao_desc": _domain("situacao_domicilio", labels.HOUSEHOLD, typed=False),
            "pct_procurou_atendimento": _pct("sought_care"),
            "pct_internados": _pct("hospital"),
            "pct_testados": _pct("tested"),
        },
    ),
}


def gold_table(silver: DataFrame, name: str) -> DataFrame:
    """One gold table straight from silver rows: a single scan of the columns it needs."""
    table = GOLD_TABLES[name]
    sums = {measure: MEASURES[measure]() for measure in table.measures}
    return _aggregate(_with_test_known(silver), table, sums)


def shared_aggregate(silver: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """All measures at a grain that every gold table can be added up from, and by `keys` too."""
    sums = [build().alias(f"m_{measure}") for measure, build in MEASURES.items()]
    grouped = _with_test_known(silver).groupBy(*keys, *SHARED_KEYS).agg(*sums)
    return grouped.withColumn("regiao", _state_region())


def gold_from_shared(shared: DataFrame, name: str) -> DataFrame:
    """One gold table from the shared aggregate; equal to `gold_table` on the same silver rows."""
    table = GOLD_TABLES[name]
    return _aggregate(shared, table, {measure: F.sum(f"m_{measure}") for measure in table.measures})


def all_gold(silver: DataFrame) -> dict[str, DataFrame]:
    """The six tables over one shared aggregate, lazily. Write the aggregate first to scan silver only once."""
    shared = shared_aggregate(silver)
    return {name: gold_from_shared(shared, name) for name in GOLD_TABLES}


def write_gold(spark: SparkSession, silver: DataFrame, root: str) -> dict[str, str]:
    """Writes the six tables below `root` from a single scan of silver; returns their paths.

    The shared aggregate goes through a written table beside them, so a lost executor costs a re-read of a small
    file and not another scan.
    """
    stage = f"{root.rstrip('/')}-shared-aggregate"
    write_table(shared_aggregate(silver), stage)
    return write_gold_from_shared(spark.read.parquet(stage), root)


def write_gold_from_shared(shared: DataFrame, root: str) -> dict[str, str]:
    """Writes the six tables below `root`, added up from the shared aggregate at whatever grain; returns their paths.

    The jobs are small and independent, so they are submitted side by side; if one fails, so does the call.
    """
    paths = {name: f"{root}/{name}" for name in GOLD_TABLES}
    with ThreadPoolExecutor(len(paths)) as jobs:
        list(jobs.map(lambda name: write_table(gold_from_shared(shared, name), paths[name]), paths))
    return paths


def _with_test_known(silver: DataFrame) -> DataFrame:
    return silver.withColumn("teste_informado", F.col("fez_teste").isNotNull())


def _aggregate(rows: DataFrame, table: GoldTable, sums: Mapping[str, Column]) -> DataFrame:
    kept = rows if table.where is None else rows.where(table.where())
    keys = [F.col(source).alias(name) for name, source in table.keys.items()]
    grouped = kept.groupBy(*keys).agg(*[column.alias(f"m_{measure}") for measure, column in sums.items()])
    result = grouped.select(*[build().alias(name) for name, build in table.columns.items()])
    return result.orderBy(table.order_by) if table.order_by else result
