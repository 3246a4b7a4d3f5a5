"""One query per operator: callables of (spark, folder of Parquet tables)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import suppress
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.contract import BRONZE_COLUMNS, BRONZE_SCHEMA, CORE_COLUMNS, SILVER_SCHEMA
from surveylake.fixtures import microdata, table, with_bronze_period, write_archives
from surveylake.functions import labels, metrics
from surveylake.functions.codes import any_flag, try_double, try_int
from surveylake.operators import conform, dedup, periods, quality
from surveylake.plans import gold, reports
from surveylake.plans.lake import refresh_lake
from surveylake.plans.silver import build_silver, filter_months
from surveylake.session import remove_paths, scratch_path
from surveylake.sources import archives, catalog, delimited, layers, manifest
from surveylake.sources.published import publish, published

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__.rstrip("_")] = function
    return function


def bronze(spark: SparkSession, d: str) -> DataFrame:
    return microdata(table(spark, d, "lineitem"))


def silver(spark: SparkSession, d: str) -> DataFrame:
    return build_silver(bronze(spark, d))


def gold_frame(name: str, spark: SparkSession, d: str) -> DataFrame:
    return gold.gold_table(silver(spark, d), name)


for _name in gold.GOLD_TABLES:
    QUERIES[f"gold_{_name}"] = partial(gold_frame, _name)

national = partial(gold_frame, "evolucao_nacional")
symptoms = partial(gold_frame, "sintomas_uf_mes")
work = partial(gold_frame, "trabalho_regiao_mes")
profile = partial(gold_frame, "perfil_sintomaticos")
tests = partial(gold_frame, "testes_uf")


def longer_silver(spark: SparkSession, d: str) -> DataFrame:
    """Silver with a month, of the groups of September, that the reports on the analysis months have to leave out."""
    rows = bronze(spark, d)
    return build_silver(rows.unionByName(rows.where("v1013 = '9'").withColumn("v1013", F.lit("8"))))


def longer(name: str, spark: SparkSession, d: str) -> DataFrame:
    return gold.gold_table(longer_silver(spark, d), name)


# Sources, ingest and catalog


@query
def ingest_archives(spark: SparkSession, d: str) -> DataFrame:
    zipped, landed = scratch_path(spark, "archives"), scratch_path(spark, "landed")
    write_archives(bronze(spark, d), zipped)
    archives.land_archives(archives.list_archives(spark, zipped), landed)
    return archives.scan_landed(spark, landed, CORE_COLUMNS)


@query
def period_from_path(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.lit("/drop/MICRODADOS_"), F.date_format("o_orderdate", "MMyyyy"), F.lit(".zip"))
    named = table(spark, d, "orders").select("o_orderkey", name.alias("path"))
    return archives.with_period(named)


@query
def period_allowlist(spark: SparkSession, d: str) -> DataFrame:
    return periods.period_allowlist(_order_periods(spark, d))


@query
def land_partitioned(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "bronze")
    layers.write_bronze(with_bronze_period(bronze(spark, d)), path)
    return layers.read_strings(spark, path, CORE_COLUMNS)


@query
def scan_csv(spark: SparkSession, d: str) -> DataFrame:
    return delimited.scan_csv(spark, _drifting_months(spark, d), CORE_COLUMNS)


@query
def conform_union(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "lineitem")
    first = items.select("l_orderkey", "l_linenumber", "l_quantity")
    second = items.select("l_tax", "l_quantity", "l_orderkey").toDF("L_TAX", " L_Quantity ", "L_OrderKey")
    return conform.conform_union([first, second])


@query
def register_bronze(spark: SparkSession, d: str) -> DataFrame:
    path, database = scratch_path(spark, "bronze-table"), _database(spark)
    filled = conform.fill_missing_columns(with_bronze_period(bronze(spark, d)), [c.lower() for c in BRONZE_COLUMNS])
    named = filled.select(*[F.col(c.lower()).alias(c) for c in BRONZE_COLUMNS], "year", "month")
    layers.write_bronze(named, path)
    catalog.register_text_table(spark, database, "bronze", BRONZE_SCHEMA, path)
    catalog.register_partitions(spark, f"{database}.bronze", path)
    return (
        spark.table(f"{database}.bronze")
        .groupBy("year", "month")
        .agg(
            metrics.row_count().alias("n_rows"),
            metrics.count_where(F.col("C001").isNull()).alias("n_unknown"),
            metrics.weighted_total(try_double("V1032")).alias("populacao"),
        )
    )


@query
def discover_partitions(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "periods")
    layers.write_bronze(_order_periods(spark, d), path)
    return periods.discover_periods(spark, path)


@query
def missing_partitions(spark: SparkSession, d: str) -> DataFrame:
    orders = _order_periods(spark, d, "o_orderpriority", "o_totalprice")
    registered = orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 495000))
    keys = ["year", "month"]
    return periods.period_status(periods.periods_of(orders, keys), periods.periods_of(registered, keys))


@query
def register_gold(spark: SparkSession, d: str) -> DataFrame:
    database = _gold_database(spark, d)
    names = catalog.list_tables(spark, database)
    return reports.table_shapes({name: spark.table(f"{database}.{name}") for name in names})


@query
def run_sql(spark: SparkSession, d: str) -> DataFrame:
    ad_hoc = """
        SELECT uf_nome, regiao, SUM(total_com_sintomas_covid) AS total_sintomaticos
        FROM gold_sintomas_uf_mes GROUP BY uf_nome, regiao
        ORDER BY total_sintomaticos DESC, uf_nome, regiao
    """
    return catalog.run_sql(spark, ad_hoc, _gold_database(spark, d))


# Sinks


@query
def silver_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "silver")
    layers.write_silver(silver(spark, d), path)
    return layers.read_silver(spark, path, SILVER_SCHEMA)


@query
def gold_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    paths = gold.write_gold(spark, silver(spark, d), scratch_path(spark, "gold"))
    return _six_tables(spark, paths)


@query
def lake_refresh(spark: SparkSession, d: str) -> DataFrame:
    """Silver rows after three refreshes, of which the last two also replace and withdraw archives.

    First most of two periods, with wrong rows of the first in archives that are replaced later, and rows of the third
    that are withdrawn; then late archives of the first; then the third period.
    """
    drops, lake = scratch_path(spark, "drops"), scratch_path(spark, "lake")
    rows = bronze(spark, d)
    late = (F.col("v1013") == "9") & (F.col("a003") == "1")
    wrong = rows.where("v1013 = '9'").withColumn("a002", F.lit("999"))
    write_archives(rows.where((F.col("v1013") == "10") & ~late), f"{drops}/first")
    write_archives(wrong, f"{drops}/second")
    write_archives(rows.where("v1013 = '11'").withColumn("uf", F.lit("99")), f"{drops}/withdrawn")
    refresh_lake(spark, f"{drops}/*", lake)
    remove_paths(spark, [f"{drops}/withdrawn", f"{drops}/second"])
    write_archives(rows.where((F.col("v1013") == "9") & ~late), f"{drops}/second")
    write_archives(rows.where(late), f"{drops}/third")
    refresh_lake(spark, f"{drops}/*", lake)
    write_archives(rows.where("v1013 = '11'"), f"{drops}/fourth")
    refresh_lake(spark, f"{drops}/*", lake)
    return layers.read_silver(spark, f"{lake}/silver", SILVER_SCHEMA)


@query
def lake_gold(spark: SparkSession, d: str) -> DataFrame:
    """The gold tables of a lake that grew by two refreshes, every column."""
    drops, lake = scratch_path(spark, "drops"), scratch_path(spark, "lake")
    for name, months in (("first", ["9", "10"]), ("second", ["11"])):
        write_archives(bronze(spark, d).where(F.col("v1013").isin(months)), f"{drops}/{name}")
        done = refresh_lake(spark, f"{drops}/*", lake)
    return _six_tables(spark, done.gold)


@query
def lake_published(spark: SparkSession, d: str) -> DataFrame:
    """What readers of a lake's gold find after a refresh, a correction, and a writer that stopped between two tables."""
    drops, lake = scratch_path(spark, "drops"), scratch_path(spark, "lake")
    rows = bronze(spark, d)
    write_archives(rows.withColumn("uf", F.lit("99")).where("v1013 = '9'"), f"{drops}/first")
    write_archives(rows.where("v1013 <> '9'"), f"{drops}/second")
    refresh_lake(spark, f"{drops}/*", lake)
    remove_paths(spark, [f"{drops}/first"])
    write_archives(rows.where("v1013 = '9'"), f"{drops}/first")
    refresh_lake(spark, f"{drops}/*", lake)

    def stops(folder: str) -> dict[str, str]:
        layers.write_table(rows.select("uf"), f"{folder}/{min(gold.GOLD_TABLES)}")
        raise InterruptedError

    with suppress(InterruptedError):
        publish(spark, f"{lake}/gold", stops)
    return _six_tables(spark, published(spark, f"{lake}/gold"))


@query
def refresh_periods(spark: SparkSession, d: str) -> DataFrame:
    path, rows = scratch_path(spark, "refreshed"), bronze(spark, d)
    earlier = filter_months(rows, [9]).withColumn("v1023", F.lit("earlier"))
    layers.write_silver(build_silver(earlier), path)
    periods.refresh_periods(spark, rows, path, build_silver)
    refreshed = layers.read_silver(spark, path, SILVER_SCHEMA)
    return refreshed.groupBy("ano", "v1013", "v1023").agg(
        metrics.row_count().alias("n_rows"), metrics.weighted_total(F.col("peso")).alias("populacao")
    )


# Projections and scalar expressions


@query
def normalize_columns(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").drop("o_orderdate")
    return conform.normalize_columns(orders.toDF(*[f" {name.title()} " for name in orders.columns]))


@query
def missing_columns(spark: SparkSession, d: str) -> DataFrame:
    groups = delimited.scan_groups(spark, _drifting_months(spark, d))
    return conform.missing_by_period(groups, ["year", "month"])


@query
def fill_missing_columns(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return conform.fill_missing_columns(items, ["l_orderkey", "b011", "c001"])


@query
def silver_build(spark: SparkSession, d: str) -> DataFrame:
    return silver(spark, d)


@query
def code_label(spark: SparkSession, d: str) -> DataFrame:
    customers = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    named = labels.label_from_table(
        customers, "c_nationkey", table(spark, d, "nation"), "n_nationkey", "n_name", "nation", labels.UNKNOWN
    )
    return named.withColumn("state", labels.state_name(F.col("c_nationkey")))


@query
def label_from_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Priorities by ranges of codes, one an order and of any length up to 990."""
    low = F.col("o_orderkey") * 1000
    ranges = table(spark, d, "orders").select(low.alias("low"), (low + F.col("o_custkey") % 990).alias("high"), "o_orderpriority")
    code = F.col("l_orderkey") * 1000 + F.col("l_partkey") % 1000
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", code.alias("code"))
    return labels.label_from_ranges(rows, "code", ranges, "low", "high", "o_orderpriority", "priority", "none")


@query
def range_label(spark: SparkSession, d: str) -> DataFrame:
    sizes = [(1, 10, "pequeno"), (11, 20, "medio"), (31, 50, "grande")]
    size = labels.range_label(F.col("p_size"), sizes, labels.UNKNOWN)
    return table(spark, d, "part").select("p_partkey", "p_size", size.alias("size_range"))


@query
def any_flag_(spark: SparkSession, d: str) -> DataFrame:
    flag = any_flag(F.col("l_discount") == 0.1, F.col("l_tax") == 0, F.col("l_quantity") == 50)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", flag.alias("flag"))


@query
def typed_columns(spark: SparkSession, d: str) -> DataFrame:
    text = table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.concat(F.lit(" "), F.col("l_partkey"), F.lit(" ")).alias("padded"),
        F.col("l_extendedprice").cast("string").alias("price"),
        "l_returnflag",
    )
    return text.select(
        "l_orderkey",
        "l_linenumber",
        try_int("padded").alias("padded_int"),
        try_int("price").alias("price_int"),
        try_double("price").alias("price_double"),
        try_int("l_returnflag").alias("flag_int"),
    )


@query
def domain_label(spark: SparkSession, d: str) -> DataFrame:
    status = labels.code_label(F.col("o_orderstatus"), {"F": "Fechado", "O": "Aberto"}, labels.NOT_INFORMED)
    return table(spark, d, "orders").select("o_orderkey", "o_orderstatus", status.alias("status_desc"))


@query
def reverse_label(spark: SparkSession, d: str) -> DataFrame:
    accented = labels.code_label(F.col("c_nationkey"), labels.STATE_NAMES_ACCENTED, labels.UNKNOWN)
    shouted = table(spark, d, "customer").select("c_custkey", F.upper(accented).alias("name"))
    return shouted.withColumn("code", labels.code_of_name(F.col("name"), labels.STATE_NAMES))


@query
def month_label(spark: SparkSession, d: str) -> DataFrame:
    months = table(spark, d, "orders").select("o_orderkey", F.month("o_orderdate").alias("mes"))
    return months.withColumn("mes_nome", labels.month_name(F.col("mes")))


@query
def predicates(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    return (
        table(spark, d, "lineitem")
        .where(
            (c("l_returnflag") == "R")
            & c("l_linenumber").isin(1, 3, 5)
            & c("l_quantity").between(10, 30)
            & ((c("l_discount") == 0.05) | (c("l_tax") == 0.02))
            & c("l_shipdate").isNotNull()
            & (c("l_linestatus") != "O")
        )
        .select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    )


# Filters


@query
def filter_months_(spark: SparkSession, d: str) -> DataFrame:
    months = table(spark, d, "orders").select("o_orderkey", F.month("o_orderdate").alias("mes"))
    return filter_months(months, reports.ANALYSIS_MONTHS, "mes")


@query
def filter_known_labels(spark: SparkSession, d: str) -> DataFrame:
    return reports.known_profiles(profile(spark, d))


@query
def series_by_region(spark: SparkSession, d: str) -> DataFrame:
    return reports.series_by_region(work(spark, d))


# Aggregations and distinct


def _by_flags(spark: SparkSession, d: str):
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus")


@query
def group_count(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type").agg(metrics.row_count().alias("n"))


@query
def count_where(spark: SparkSession, d: str) -> DataFrame:
    return _by_flags(spark, d).agg(
        metrics.count_where(F.col("l_quantity") == 50).alias("n_full"),
        metrics.count_where(F.col("l_tax") == 0).alias("n_untaxed"),
    )


@query
def flag_total(spark: SparkSession, d: str) -> DataFrame:
    flagged = table(spark, d, "labels").withColumn("flag", any_flag(F.col("toxic") == 1, F.col("quality") == 0))
    return flagged.groupBy("quality").agg(metrics.flag_total(F.col("flag")).alias("n_flagged"))


@query
def weighted_total(spark: SparkSession, d: str) -> DataFrame:
    weight = F.when(F.col("l_partkey") % 17 != 0, F.col("l_extendedprice"))
    return _by_flags(spark, d).agg(metrics.weighted_total(weight).alias("total"))


@query
def group_mean(spark: SparkSession, d: str) -> DataFrame:
    cents = F.round(F.col("c_acctbal") * 100).cast("long")
    return table(spark, d, "customer").groupBy("c_mktsegment").agg(metrics.group_mean(cents).alias("mean_cents"))


@query
def pct_of_group(spark: SparkSession, d: str) -> DataFrame:
    return _by_flags(spark, d).agg(
        metrics.pct_of_group(F.col("l_quantity") > 25).alias("pct_large"),
        metrics.pct_of_group(F.col("l_discount") == 0).alias("pct_full_price"),
    )


@query
def safe_ratio(spark: SparkSession, d: str) -> DataFrame:
    toxic, good = metrics.count_where(F.col("toxic") == 1), metrics.count_where(F.col("quality") == 1)
    grouped = table(spark, d, "labels").groupBy("quality", "toxic")
    return grouped.agg(metrics.safe_ratio(toxic, good).alias("toxic_per_good"))


@query
def dedup_rows(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    return dedup.dedup_rows(items)


@query
def dedup_rows_by_hash(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "lineitem").withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))
    return dedup.dedup_rows_by_hash(items.unionByName(items))


@query
def distinct_values(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderpriority").distinct()


@query
def period_totals(spark: SparkSession, d: str) -> DataFrame:
    return reports.period_totals(reports.of_months(longer("evolucao_nacional", spark, d)))


@query
def symptoms_by_state(spark: SparkSession, d: str) -> DataFrame:
    return reports.symptoms_by_state(reports.of_months(longer("sintomas_uf_mes", spark, d)))


@query
def absence_by_region(spark: SparkSession, d: str) -> DataFrame:
    return reports.absence_by_region(reports.of_months(longer("trabalho_regiao_mes", spark, d)))


@query
def positivity_by_region(spark: SparkSession, d: str) -> DataFrame:
    return reports.positivity_by_region(tests(spark, d))


@query
def symptomatic_by_sex(spark: SparkSession, d: str) -> DataFrame:
    return reports.symptomatic_by(profile(spark, d), "sexo_desc")


@query
def symptomatic_by_race(spark: SparkSession, d: str) -> DataFrame:
    return reports.symptomatic_by(profile(spark, d), "cor_raca_desc")


@query
def share_by_sex(spark: SparkSession, d: str) -> DataFrame:
    return reports.share_by_sex(profile(spark, d))


@query
def mean_of_rates(spark: SparkSession, d: str) -> DataFrame:
    return reports.mean_positivity(tests(spark, d))


@query
def table_count(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").agg(metrics.row_count().alias("cnt"))


@query
def table_shapes(spark: SparkSession, d: str) -> DataFrame:
    paths = gold.write_gold(spark, longer_silver(spark, d), scratch_path(spark, "shapes"))
    tables = {name: spark.read.parquet(path) for name, path in paths.items()}
    monthly = ("sintomas_uf_mes", "trabalho_regiao_mes", "evolucao_nacional")
    return reports.table_shapes({n: reports.of_months(df) if n in monthly else df for n, df in tables.items()})


# Report queries


@query
def report_evolution(spark: SparkSession, d: str) -> DataFrame:
    return reports.evolution(national(spark, d))


@query
def report_top_states(spark: SparkSession, d: str) -> DataFrame:
    return reports.top_states(symptoms(spark, d))


@query
def report_evolution_months(spark: SparkSession, d: str) -> DataFrame:
    return reports.evolution_of_months(longer("evolucao_nacional", spark, d))


@query
def sample_rows(spark: SparkSession, d: str) -> DataFrame:
    return reports.sample_rows(symptoms(spark, d), 5, "mes", "uf")


@query
def positivity_ranked(spark: SparkSession, d: str) -> DataFrame:
    return reports.positivity_ranked(tests(spark, d))


@query
def mean_pct_by_region(spark: SparkSession, d: str) -> DataFrame:
    return reports.mean_pct_by_region(reports.of_months(longer("sintomas_uf_mes", spark, d)))


# Data quality


@query
def check_completeness(spark: SparkSession, d: str) -> DataFrame:
    return quality.check_completeness(silver(spark, d), ["uf_int", "cor_raca", "fez_teste", "peso", "renda"])


@query
def check_domain(spark: SparkSession, d: str) -> DataFrame:
    return quality.check_domain(silver(spark, d), "uf_int")


@query
def check_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return quality.check_duplicates(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def check_duplicates_by_period(spark: SparkSession, d: str) -> DataFrame:
    """Repeats among all rows from counts kept per shipping month, with keys that months share and with the month itself."""
    period = ["ano", "v1013"]
    rows = table(spark, d, "lineitem").select(
        "*", F.year("l_shipdate").cast("string").alias("ano"), F.month("l_shipdate").cast("string").alias("v1013")
    )
    checks = []
    for keys in (["l_partkey", "l_suppkey"], ["l_orderkey", "v1013", "ano"]):
        path = scratch_path(spark, "key-counts")
        counts = quality.key_counts(rows, keys, period)
        layers.write_silver(counts, path)
        checks.append(quality.duplicates_of_counts(spark.read.schema(counts.schema).parquet(path), keys, period))
    return quality.union_checks(*checks)


@query
def lake_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """The duplicate check of a lake that grew and had a period corrected, as its last refresh wrote it."""
    drops, lake = scratch_path(spark, "drops"), scratch_path(spark, "lake")
    rows, keys = bronze(spark, d), ["uf", "a002", "v1032"]
    write_archives(rows.withColumn("uf", F.lit("99")).where("v1013 = '9'"), f"{drops}/first")
    write_archives(rows.where("v1013 = '10'"), f"{drops}/second")
    refresh_lake(spark, f"{drops}/*", lake, unique=keys)
    remove_paths(spark, [f"{drops}/first"])
    write_archives(rows.where("v1013 = '9'"), f"{drops}/first")
    write_archives(rows.where("v1013 = '11'"), f"{drops}/third")
    refresh_lake(spark, f"{drops}/*", lake, unique=keys)
    runs = spark.read.parquet(f"{lake}/quality").where("check_name = 'no_duplicates'")
    last = spark.read.parquet(f"{lake}/quality").where("check_name = 'columns_2020_11'").select("run_id")
    return runs.join(last, "run_id", "left_semi").drop("run_id")


@query
def noted_partitions(spark: SparkSession, d: str) -> DataFrame:
    """Rows per partition of a table that is registered from the notes of a layer, after months came, changed and went."""
    root, database = scratch_path(spark, "noted"), _database(spark)
    rows = silver(spark, d)
    layers.write_silver(rows.where("v1013 <> '11'"), f"{root}/silver")
    manifest.repair_notes(spark, root, "silver")
    catalog.register_noted(spark, database, root, {"silver": SILVER_SCHEMA})
    layers.write_silver(rows.where("v1013 = '11'"), f"{root}/silver", existing="replace_periods")
    remove_paths(spark, [layers.period_directory(spark, f"{root}/silver", ("2020", "9"))])
    manifest.note_periods(spark, root, {"silver": [("2020", "11")]}, {"silver": [("2020", "9")]})
    catalog.register_noted(spark, database, root, {"silver": SILVER_SCHEMA})
    return spark.table(f"{database}.silver").groupBy("ano", "v1013").agg(metrics.row_count().alias("n_rows"))


@query
def check_range(spark: SparkSession, d: str) -> DataFrame:
    parts = quality.check_range(table(spark, d, "part"), "p_size", 1, 40)
    return quality.union_checks(parts, quality.check_range(table(spark, d, "lineitem"), "l_quantity", 1, 50))


@query
def check_expected_set(spark: SparkSession, d: str) -> DataFrame:
    months = table(spark, d, "events").select(F.month("ts").alias("mes"))
    return quality.check_expected_set(months, "mes", reports.ANALYSIS_MONTHS)


@query
def quality_results(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "quality")
    quality.save_results(quality.silver_suite(silver(spark, d)), path, "run-1")
    return spark.read.parquet(path)


@query
def quality_summary(spark: SparkSession, d: str) -> DataFrame:
    return quality.summarize(quality.silver_suite(silver(spark, d)))


@query
def gold_validation(spark: SparkSession, d: str) -> DataFrame:
    database = _gold_database(spark, d)
    checks = quality.validate_queries(
        spark,
        [
            ("Count gold_evolucao_nacional", f"SELECT COUNT(*) AS cnt FROM {database}.gold_evolucao_nacional"),
            ("Count gold_sintomas_uf_mes", f"SELECT COUNT(*) AS cnt FROM {database}.gold_sintomas_uf_mes"),
            ("Sample gold_evolucao_nacional", f"SELECT * FROM {database}.gold_evolucao_nacional LIMIT 5"),
            ("Many rows", f"SELECT * FROM parquet.`{d}/lineitem.parquet`"),
            ("Absent table", f"SELECT * FROM {database}.gold_absent"),
        ],
    )
    return checks.drop("message")


def _six_tables(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """All columns of all gold tables; a table has NULL in those of the others."""
    tables = [spark.read.parquet(path).withColumn("tabela", F.lit(name)) for name, path in paths.items()]
    return reduce(partial(DataFrame.unionByName, allowMissingColumns=True), tables)


def _order_periods(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    date = F.col("o_orderdate")
    return table(spark, d, "orders").select(
        "o_orderkey", *columns, F.date_format(date, "yyyy").alias("year"), F.date_format(date, "MM").alias("month")
    )


def _drifting_months(spark: SparkSession, d: str) -> str:
    """Lands three months whose files differ in order, case and number of columns."""
    path, rows = scratch_path(spark, "drifting"), with_bronze_period(bronze(spark, d))
    core, period = list(CORE_COLUMNS), ["year", "month"]
    extra = [*core[:2], F.lit("7").alias("f001"), *core[2:], *period]
    shouted = [F.col(c).alias(f" {c.upper()}") for c in core if c not in ("a005", "b011")]
    for month, columns in (("09", [*core, *period]), ("10", extra), ("11", [*shouted, *period])):
        layers.write_bronze(rows.where(F.col("month") == month).select(*columns), path, mode="append")
    return path


def _database(spark: SparkSession) -> str:
    name = f"surveylake_{uuid.uuid4().hex}"
    catalog.ensure_database(spark, name, scratch_path(spark, "database"))
    return name


def _gold_database(spark: SparkSession, d: str) -> str:
    root, database = scratch_path(spark, "gold"), _database(spark)
    gold.write_gold(spark, silver(spark, d), root)
    catalog.register_layer(spark, database, root, "gold_")
    return database
