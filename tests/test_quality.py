import pytest
from pyspark.sql import functions as F

from surveylake.contract import CORE_COLUMNS, strings
from surveylake.operators import quality
from surveylake.plans.silver import build_silver


def frame(spark, schema, *values):
    return spark.createDataFrame([(v,) if not isinstance(v, tuple) else v for v in values], schema)


def test_completeness_all_present(spark):
    df = frame(spark, "col1 int, col2 string", (1, "a"), (2, "b"), (3, "c"))
    assert all(r.passed for r in quality.check_completeness(df, ["col1", "col2"]).collect())


def test_completeness_missing_column(spark):
    first, second = quality.check_completeness(frame(spark, "col1 int", 1, 2, 3), ["col1", "col2"]).collect()
    assert first.passed and not second.passed
    assert second.actual == "column missing" and "não encontrada" in second.message


def test_completeness_counts_null_and_nan_as_unknown(spark):
    df = frame(spark, "col1 double", 1.0, None, None, None, float("nan"))
    found = quality.check_completeness(df, ["col1"]).first()
    assert (found.passed, found.actual) == (False, "20.0%")


def test_completeness_passes_at_exactly_95_percent(spark):
    df = spark.range(100).select(F.when(F.col("id") >= 5, 1).alias("x"), F.when(F.col("id") >= 6, 1).alias("y"))
    x, y = quality.check_completeness(df, ["x", "y"]).collect()
    assert (x.passed, x.actual, y.passed, y.actual) == (True, "95.0%", False, "94.0%")


def test_empty_frame(spark):
    empty = frame(spark, "x int")
    assert not quality.check_completeness(empty, ["x"]).first().passed
    assert quality.check_range(empty, "x", 0, 1).first().passed
    duplicates = quality.check_duplicates(empty, ["x"]).first()
    assert (duplicates.passed, duplicates.message) == (True, "Encontradas 0 linhas duplicadas (0.00%)")
    assert quality.check_domain(empty, "x").first().passed


def test_domain_valid(spark):
    found = quality.check_domain(frame(spark, "uf_codigo int", 11, 35, 53), "uf_codigo").first()
    assert (found.passed, found.actual, found.message) == (True, "0 invalid UFs", "Todas UFs válidas")


def test_domain_counts_distinct_values_and_null(spark):
    found = quality.check_domain(frame(spark, "uf_codigo int", 99, 100, 99, None, 11, None), "uf_codigo").first()
    assert (found.passed, found.actual) == (False, "3 invalid UFs")
    assert found.message == "UFs inválidas encontradas: [99, 100, nan]"


def test_domain_shows_five_values_and_counts_all(spark):
    found = quality.check_domain(spark.range(1000, 3000).repartition(7), "id").first()
    assert found.actual == "2000 invalid UFs"
    assert found.message == "UFs inválidas encontradas: [1000, 1001, 1002, 1003, 1004]"


def test_domain_of_an_absent_column(spark):
    found = quality.check_domain(frame(spark, "x int", 1), "uf").first()
    assert (found.passed, found.actual) == (False, "column missing")


@pytest.mark.parametrize("ages, passed, n", [((25, 30, 45), True, 0), ((25, 150), False, 1), ((0, 120, -1), False, 1)])
def test_range(spark, ages, passed, n):
    found = quality.check_range(frame(spark, "idade int", *ages), "idade", 0, 120).first()
    assert (found.passed, found.expected, found.actual) == (passed, "[0, 120]", f"{n} out of range")


def test_range_lets_null_and_nan_pass(spark):
    found = quality.check_range(frame(spark, "x double", None, float("nan"), 150.0), "x", 0, 120).first()
    assert found.actual == "1 out of range"


def test_range_of_an_absent_column(spark):
    assert not quality.check_range(frame(spark, "x int", 1), "idade", 0, 120).first().passed


def test_unique_and_duplicate_keys(spark):
    assert quality.check_duplicates(frame(spark, "id int", 1, 2, 3), ["id"]).first().passed
    found = quality.check_duplicates(frame(spark, "id int", 1, 1, 2), ["id"]).first()
    assert (found.passed, found.actual) == (False, "1 duplicates")
    assert found.message == "Encontradas 1 linhas duplicadas (33.33%)"


def test_null_keys_are_equal(spark):
    assert quality.check_duplicates(frame(spark, "id int", None, None), ["id"]).first().actual == "1 duplicates"


def test_duplicates_of_an_absent_key_are_an_error(spark):
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        quality.check_duplicates(frame(spark, "id int", 1), ["other"])


def test_expected_set_reports_both_directions(spark, rows):
    df = frame(spark, "mes int", 9, 10, 10, 12, None)
    assert rows(quality.check_expected_set(df, "mes", [9, 10, 11])) == [
        (11, "missing"),
        (12, "unexpected"),
        (None, "unexpected"),
    ]
    assert quality.check_expected_set(frame(spark, "mes int", 9, 10), "mes", [9, 10]).count() == 0


def test_suite_on_silver(spark):
    good = dict.fromkeys(CORE_COLUMNS, "1") | {"uf": "35", "a002": "40", "v1032": "10.5"}
    bad = good | {"uf": "99", "a002": "130"}
    silver = build_silver(
        spark.createDataFrame([tuple(p[c] for c in CORE_COLUMNS) for p in (good, bad)], strings(CORE_COLUMNS))
    )
    found = {r.check_name: r for r in quality.silver_suite(silver).collect()}
    assert [n for n, r in found.items() if not r.passed] == ["range_idade", "uf_validity"]
    assert set(found) == {
        "completeness_uf_int",
        "completeness_idade",
        "completeness_sexo",
        "completeness_peso",
        "range_idade",
        "uf_validity",
    }


def test_completeness_and_range_share_one_scan(spark):
    df = frame(spark, "x int, y double", (1, 1.0))
    plan = quality.column_checks(df, ["x", "y"], {"x": (0, 1)})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") == 1


def test_suite_scans_silver_once(spark):
    core = dict.fromkeys(CORE_COLUMNS, "1")
    silver = build_silver(spark.createDataFrame([tuple(core.values())], strings(CORE_COLUMNS)))
    assert not set(quality.silver_suite(silver).columns) - set(quality.CHECK_SCHEMA.replace(",", "").split()[::2])
    plan = quality.silver_suite(silver)._jdf.queryExecution().executedPlan().toString()
    assert "suite-counts" in plan and "ExistingRDD" not in plan


def results(spark, *rows):
    return spark.createDataFrame(list(rows), quality.CHECK_SCHEMA)


def test_summary_and_report(spark):
    checks = results(spark, ("test1", True, "a", "a", "OK"), ("test2", False, "b", "c", "Failed"))
    assert tuple(quality.summarize(checks).first()) == (2, 1, 1, 50.0)
    report = quality.render_report(checks)
    for line in (
        "RELATÓRIO DE QUALIDADE DE DADOS",
        "Total de verificações: 2",
        "Aprovadas: 1 (50.0%)",
        "Reprovadas: 1",
        "✓ test1: OK",
        "✗ test2: Failed",
    ):
        assert line in report.splitlines()


def test_summary_of_no_checks(spark):
    assert tuple(quality.summarize(results(spark)).first()) == (0, 0, 0, 0.0)
    assert "Aprovadas: 0" in quality.render_report(results(spark)).splitlines()


def test_results_are_appended_per_run(spark, tmp_path):
    path = str(tmp_path / "results")
    for run in ("a", "b"):
        quality.save_results(results(spark, ("t", True, "", "", "")), path, run)
    assert sorted(r.run_id for r in spark.read.parquet(path).collect()) == ["a", "b"]


def test_columns_are_checked_per_period(spark):
    absent = spark.createDataFrame(
        [("2020", "09", []), ("2020", "11", ["b011", "c001"])], "year string, month string, absent array<string>"
    )
    found = quality.check_columns(absent).orderBy("check_name").collect()
    assert [(r.check_name, r.passed, r.actual) for r in found] == [
        ("columns_2020_09", True, "0 missing"),
        ("columns_2020_11", False, "2 missing"),
    ]
    assert found[1].message == "Colunas essenciais ausentes: b011, c001"


def test_failing_query_does_not_stop_the_others(spark):
    found = quality.validate_queries(
        spark,
        [
            ("bad table", "SELECT * FROM no_such_table"),
            ("fails when run", "SELECT CAST('x' AS INT)"),
            ("good", "SELECT 1 AS a UNION ALL SELECT 2"),
            ("many", "SELECT id FROM range(5000)"),
        ],
    ).collect()
    assert [(r.check_name, r.passed, r.actual) for r in found] == [
        ("bad table", False, "error"),
        ("fails when run", False, "error"),
        ("good", True, "2 rows"),
        ("many", True, "5000 rows"),
    ]
