import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveylake.contract import CORE_COLUMNS, SILVER_SCHEMA, strings
from surveylake.fixtures import microdata, table
from surveylake.operators import periods
from surveylake.operators.dedup import dedup_rows_by_hash
from surveylake.plans import gold, reports
from surveylake.plans.silver import build_silver, filter_months
from surveylake.session import scratch_path
from surveylake.sources import catalog, layers

SF_DIR = "/root/testdata/sf0.001"


def person(**codes):
    values = dict.fromkeys(CORE_COLUMNS) | {"ano": "2020", "uf": "11", "v1013": "9", "v1022": "1"} | codes
    return tuple(values[c] for c in CORE_COLUMNS)


def people(spark, *rows):
    return spark.createDataFrame(list(rows), strings(CORE_COLUMNS))


@pytest.fixture(scope="module")
def survey(spark):
    """Silver rows of the whole derived survey, kept on disk."""
    path = scratch_path(spark, "survey")
    layers.write_silver(build_silver(microdata(table(spark, SF_DIR, "lineitem"))), path)
    return layers.read_silver(spark, path, SILVER_SCHEMA)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_silver_columns_and_types(spark):
    silver = build_silver(people(spark, person()))
    assert [(f.name, f.dataType) for f in silver.schema] == [(f.name, f.dataType) for f in SILVER_SCHEMA]


def test_malformed_codes_become_defaults(spark):
    silver = build_silver(people(spark, person(uf="zz", b0011="x", a003="", v1032="n/a"))).first()
    assert (silver.uf_int, silver.uf_nome, silver.regiao) == (None, "Desconhecido", "Desconhecido")
    assert (silver.febre, silver.teve_sintomas_covid, silver.sexo, silver.peso) == (None, 0, None, None)


def test_code_without_a_state_still_has_a_region(spark):
    silver = build_silver(people(spark, person(uf="34"))).first()
    assert (silver.uf_nome, silver.regiao) == ("Desconhecido", "Sudeste")


def test_padded_code_is_read(spark):
    assert build_silver(people(spark, person(uf=" 11 "))).first().uf_nome == "Rondonia"


def test_repeats_go_within_a_month_only(spark):
    same = person(a002="30")
    silver = build_silver(people(spark, same, same, person(a002="30", v1013="10")))
    assert sorted(r.v1013 for r in silver.collect()) == ["10", "9"]


def test_missing_core_column_is_null_in_silver(spark):
    silver = build_silver(people(spark, person(b011="1")).drop("b011"))
    assert silver.first().resultado_teste is None


def test_extra_columns_pass_through(spark):
    silver = build_silver(people(spark, person()).withColumn("F001", F.lit("3")))
    assert silver.first().f001 == "3"


def test_dedup_strategy_does_not_change_silver(spark, rows):
    bronze = microdata(table(spark, SF_DIR, "lineitem"))
    bronze = bronze.unionAll(bronze.where("uf = '35'"))
    assert rows(build_silver(bronze)) == rows(build_silver(bronze, dedup_rows_by_hash))


def test_silver_period_filter_prunes_directories(spark, survey):
    september = filter_months(survey, [9])
    assert "v1013" in plan(september).split("PartitionFilters: [")[1].split("]")[0]
    assert {r.mes_int for r in september.select("mes_int").distinct().collect()} == {9}


def test_period_columns_stay_text(spark, survey):
    assert survey.schema["v1013"].dataType == T.StringType()


def test_gold_reads_only_its_columns(spark, survey):
    schema = plan(gold.gold_table(survey, "trabalho_regiao_mes")).split("ReadSchema: ")[1].split(">")[0]
    assert schema == "struct<regiao:string,mes_int:int,afastou_trabalho:int,peso:double"


def test_gold_filter_reaches_the_scan(spark, survey):
    assert "EqualTo(teve_sintomas_covid,1)" in plan(gold.gold_table(survey, "perfil_sintomaticos"))
    assert "IsNotNull(fez_teste)" in plan(gold.gold_table(survey, "testes_uf"))


@pytest.mark.parametrize("name", gold.GOLD_TABLES)
def test_gold_shuffles_once_and_only_aggregates(spark, survey, name):
    found = plan(gold.gold_table(survey, name))
    assert found.count("Exchange hashpartitioning") == 1
    assert not any(word in found for word in ("Python", "Cartesian", "NestedLoop", "Window"))


@pytest.mark.parametrize("name", gold.GOLD_TABLES)
def test_shared_path_equals_direct_path(spark, survey, rows, name):
    shared = gold.gold_from_shared(gold.shared_aggregate(survey), name)
    direct = gold.gold_table(survey, name)
    assert shared.schema.simpleString() == direct.schema.simpleString()
    assert rows(shared) == rows(direct)


def test_gold_does_not_depend_on_partitioning(spark, survey, rows):
    expected = rows(gold.gold_table(survey, "sintomas_uf_mes"))
    assert rows(gold.gold_table(survey.repartition(13), "sintomas_uf_mes")) == expected
    assert rows(gold.gold_table(survey.coalesce(1).sort(F.desc("peso")), "sintomas_uf_mes")) == expected


def test_states_and_regions_add_up_to_the_nation(spark, survey, rows):
    nation = gold.gold_table(survey, "evolucao_nacional")
    states = gold.gold_table(survey, "sintomas_uf_mes")
    regions = gold.gold_table(survey, "trabalho_regiao_mes")
    expected = rows(nation, "mes", "total_entrevistados", "total_com_sintomas", "total_internados")
    by_state = states.groupBy("mes").agg(
        F.sum("total_entrevistados"), F.sum("total_com_sintomas_covid"), F.sum("total_internados")
    )
    assert rows(by_state) == expected
    by_region = regions.groupBy("mes").agg(F.sum("total_entrevistados"), F.sum("total_afastados"))
    assert rows(by_region) == rows(nation, "mes", "total_entrevistados", "total_afastados_trabalho")


def test_nobody_tested_has_positivity_zero(spark):
    silver = build_silver(people(spark, person(b009b="2"), person(b009b="2", a002="9")))
    found = gold.gold_table(silver, "testes_uf").first()
    assert (found.total_entrevistados, found.total_testados, found.taxa_positividade) == (2, 0, 0.0)


def test_positive_without_a_test_is_counted(spark):
    silver = build_silver(people(spark, person(b009b="2", b011="1"), person(b009b="1", b011="1")))
    found = gold.gold_table(silver, "testes_uf").first()
    assert (found.total_testados, found.total_positivos, found.taxa_positividade) == (1, 2, 200.0)


def test_unknown_test_answer_leaves_the_denominator(spark):
    silver = build_silver(people(spark, person(b009b="1"), person(b009b=None), person(b009b="9")))
    found = gold.gold_table(silver, "testes_uf").first()
    assert (found.total_entrevistados, found.pct_testados) == (2, 50.0)


def test_two_codes_may_share_the_default_label(spark, rows):
    sick = {"b0011": "1", "a003": "1"}
    silver = build_silver(people(spark, person(a004="6", **sick), person(a004=None, **sick), person(a004="1", **sick)))
    found = gold.gold_table(silver, "perfil_sintomaticos")
    assert rows(found, "cor_raca", "cor_raca_desc") == [
        (1, "Branca"),
        (6, "Nao informado"),
        (None, "Nao informado"),
    ]
    assert rows(reports.known_profiles(found), "cor_raca") == [(1,)]


def test_household_label_comes_from_the_raw_code(spark, rows):
    silver = build_silver(people(spark, *[person(b0011="1", v1022=c) for c in ("1", "2", "3", None)]))
    found = gold.gold_table(silver, "acesso_saude")
    assert rows(found, "situacao_domicilio", "situacao_desc") == [
        ("1", "Urbano"),
        ("2", "Rural"),
        ("3", "Nao informado"),
        (None, "Nao informado"),
    ]


def test_gold_of_an_empty_silver(spark):
    silver = build_silver(people(spark))
    assert all(df.count() == 0 for df in gold.all_gold(silver).values())
    assert reports.period_totals(gold.gold_table(silver, "evolucao_nacional")).first().pct_testados is None


def test_mean_age_ignores_unknown_ages(spark):
    silver = build_silver(
        people(spark, *[person(b0011="1", a003="1", a004="1", a002=age) for age in ("20", "40", None)])
    )
    found = gold.gold_table(silver, "perfil_sintomaticos").first()
    assert (found.total_sintomaticos, found.idade_media) == (3, 30.0)


def test_refresh_writes_missing_periods_only(spark, tmp_path, rows):
    target = str(tmp_path / "silver")
    layers.write_silver(build_silver(people(spark, person(a002="1", v1013="9"))), target)
    source = people(
        spark,
        person(a002="50", v1013="9"),
        person(a002="60", v1013="10"),
        person(a002="70", v1013="10"),
        person(a002="80", v1013=None),
    )
    assert periods.refresh_periods(spark, source, target, build_silver) == [("2020", "10"), ("2020", None)]
    kept = layers.read_silver(spark, target, SILVER_SCHEMA)
    assert rows(kept, "v1013", "idade") == [("10", 60), ("10", 70), ("9", 1), (None, 80)]
    assert periods.refresh_periods(spark, source, target, build_silver) == []
    assert kept.count() == 4


def test_refresh_of_a_new_target(spark, tmp_path):
    target = str(tmp_path / "silver")
    source = people(spark, person(v1013="9"), person(v1013="10"))
    assert periods.refresh_periods(spark, source, target, build_silver) == [("2020", "10"), ("2020", "9")]


def test_full_write_replaces_the_layer(spark, tmp_path):
    target = str(tmp_path / "silver")
    layers.write_silver(build_silver(people(spark, person(v1013="9"))), target)
    layers.write_silver(build_silver(people(spark, person(v1013="10"))), target)
    assert periods.discover_periods(spark, target, ["ano", "v1013"]).collect() == [("2020", "10")]


def test_large_period_is_written_by_many_tasks(spark, tmp_path):
    """Nearly all rows in one month; the rebalance must not leave them to a single task."""
    wide = spark.range(200_000).select(
        *[
            {"ano": F.lit("2020"), "v1013": F.lit("9")}.get(c, F.sha2(F.concat(F.lit(c), "id"), 256)).alias(c)
            for c in CORE_COLUMNS
        ]
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m")
    try:
        layers.write_silver(build_silver(wide), str(tmp_path / "silver"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = list((tmp_path / "silver/ano=2020/v1013=9").glob("*.parquet"))
    # A period is split between map outputs, of which there are four here.
    assert len(files) >= 4


def test_allow_list_defaults_and_years(spark, rows):
    df = spark.createDataFrame([("2020", "05"), ("2020", "09"), ("2021", "11")], "year string, month string")
    assert rows(periods.period_allowlist(df)) == rows(periods.period_allowlist(df, None)) == [
        ("2020", "09"),
        ("2021", "11"),
    ]
    assert rows(periods.period_allowlist(df, ["05", "11"], ["2020"])) == [("2020", "05")]
    assert periods.ALLOWED_MONTHS == ("09", "10", "11")


def test_register_layers_and_partitions_is_idempotent(spark, tmp_path, rows):
    database, root = "layers_db", str(tmp_path / "bronze")
    assert catalog.ensure_database(spark, database, str(tmp_path / "db"))
    assert not catalog.ensure_database(spark, database)
    schema = strings(["UF", "V1013"])
    bronze = spark.createDataFrame(
        [("11", "9", "2020", "09"), ("12", "10", "2020", "10")], "UF string, V1013 string, year string, month string"
    )
    layers.write_bronze(bronze, root, delimiter=";")
    assert catalog.register_text_table(spark, database, "bronze", schema, root, delimiter=";")
    assert not catalog.register_text_table(spark, database, "bronze", schema, root, delimiter=";")
    name = f"{database}.bronze"
    assert spark.table(name).count() == 0
    assert catalog.register_partitions(spark, name, root) == [("2020", "09", "added"), ("2020", "10", "added")]
    assert catalog.register_partitions(spark, name, root) == [("2020", "09", "existing"), ("2020", "10", "existing")]
    assert rows(spark.table(name)) == [("11", "9", "2020", "09"), ("12", "10", "2020", "10")]


def test_register_layer_prefixes_and_finds_partitions(spark, tmp_path, rows):
    database, root = "gold_db", str(tmp_path / "layer")
    catalog.ensure_database(spark, database, str(tmp_path / "db"))
    layers.write_silver(build_silver(people(spark, person(), person(v1013="10"))), f"{root}/silver")
    layers.write_table(spark.range(3), f"{root}/plain")
    assert catalog.register_layer(spark, database, root, "gold_") == ["gold_plain", "gold_silver"]
    assert catalog.register_layer(spark, database, root, "gold_") == []
    assert catalog.list_tables(spark, database) == ["gold_plain", "gold_silver"]
    assert spark.table(f"{database}.gold_silver").count() == 2
    before = spark.catalog.currentDatabase()
    assert catalog.run_sql(spark, "SELECT * FROM gold_plain", database, limit=2).count() == 2
    assert spark.catalog.currentDatabase() == before
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        catalog.run_sql(spark, "SELECT * FROM gold_absent", database)
    assert spark.catalog.currentDatabase() == before


def test_write_gold_is_readable_by_name(spark, survey, tmp_path, rows):
    paths = gold.write_gold(spark, survey, str(tmp_path / "gold"))
    for name, path in paths.items():
        assert rows(spark.read.parquet(path)) == rows(gold.gold_table(survey, name))


def test_scratch_needs_a_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(f"{folder}/surveylake/x-")
