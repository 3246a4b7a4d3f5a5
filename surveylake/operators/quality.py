"""Data-quality checks. Every check is a frame of check rows: check_name, passed, expected, actual, message."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveylake.contract import BRONZE_PERIOD
from surveylake.functions.labels import STATE_NAMES
from surveylake.functions.metrics import count_where, percent, row_count
from surveylake.session import scratch_path
from surveylake.sources.layers import write_table

CHECK_SCHEMA = "check_name string, passed boolean, expected string, actual string, message string"

MIN_COMPLETENESS = "0.95"
SHOWN_VALUES = 5

# Columns and bounds of the silver suite.
STATE_COLUMN = "uf_int"
REQUIRED_COLUMNS = (STATE_COLUMN, "idade", "sexo", "peso")
AGE_RANGE = (0, 120)


def check_completeness(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """At least 95 % of each required column is known; an absent column or an empty frame fails."""
    return column_checks(df, required, {})


def check_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """No value outside the inclusive bounds; NULL and NaN pass, an absent column fails."""
    return column_checks(df, [], {column: (low, high)})


def column_checks(df: DataFrame, required: Sequence[str], ranges: Mapping[str, tuple]) -> DataFrame:
    """Completeness and range checks together, from one scan and one aggregate row."""
    return _checks_of(df.agg(*_counts(df, required, ranges)), required, ranges)


def _counts(df: DataFrame, required: Sequence[str], ranges: Mapping[str, tuple]) -> list[Column]:
    """What the checks count: `n_rows`, and `known_` and `outside_` of the columns that are there."""
    counts = {f"known_{c}": count_where(_known(df, c)) for c in required if c in df.columns}
    counts |= {f"outside_{c}": count_where(_outside(df, c, *r)) for c, r in ranges.items() if c in df.columns}
    return [row_count().alias("n_rows"), *[count.alias(name) for name, count in counts.items()]]


def _checks_of(totals: DataFrame, required: Sequence[str], ranges: Mapping[str, tuple]) -> DataFrame:
    """Check rows from one row of counts; a column that has no count is absent."""
    names = set(totals.columns)
    rows = [_completeness_row(c) if f"known_{c}" in names else _absent_row(f"completeness_{c}", c) for c in required]
    rows += [_range_row(c, *r) if f"outside_{c}" in names else _absent_row(f"range_{c}", c) for c, r in ranges.items()]
    return totals.select(F.inline(F.array(*rows)))


def check_domain(
    df: DataFrame,
    column: str,
    valid: Iterable = tuple(STATE_NAMES),
    check_name: str = "uf_validity",
    noun: str = "UFs",
) -> DataFrame:
    """No value outside the valid codes. NULL is one invalid value; up to five values are shown, NULL last."""
    if column not in df.columns:
        return df.agg(row_count().alias("n_rows")).select(F.inline(F.array(_absent_row(check_name, column))))
    is_valid = F.coalesce(F.col(column).isin(*valid), F.lit(False))
    invalid = df.where(~is_valid).select(F.col(column).alias("code")).distinct()
    shown = invalid.orderBy(F.col("code").asc_nulls_last()).limit(SHOWN_VALUES)
    # One row holds the count, at most five hold values; only these meet in the last aggregate.
    counted = invalid.agg(row_count().alias("n")).select("n", F.lit(None).alias("entry"))
    entry = F.struct(F.col("code").isNull().alias("last"), "code")
    parts = shown.select(F.lit(None).alias("n"), entry.alias("entry")).unionByName(counted)
    found = parts.agg(F.max("n").alias("n"), F.sort_array(F.collect_list("entry")).alias("entries"))
    texts = F.transform("entries", lambda e: F.coalesce(e["code"].cast("string"), F.lit("nan")))
    listed = F.concat(F.lit(f"{noun} inválidas encontradas: ["), F.array_join(texts, ", "), F.lit("]"))
    message = F.when(F.col("n") == 0, f"Todas {noun} válidas").otherwise(listed)
    actual = F.concat(F.col("n").cast("string"), F.lit(f" invalid {noun}"))
    row = _row(check_name, F.col("n") == 0, f"all {noun} valid", actual, message)
    return found.select(F.inline(F.array(row)))


def check_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """No two rows share the keys; NULL keys are equal. Rows are counted per key before they are shuffled."""
    per_key = df.groupBy(*keys).agg(row_count().alias("n"))
    return _duplicates_row(per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), row_count().alias("n_keys")))


def key_counts(df: DataFrame, keys: Sequence[str], by: Sequence[str] = (), rebalance: bool = False) -> DataFrame:
    """Rows per distinct keys within each group of `by`: these columns, `_hash` of the keys, and `_n`.

    Kept per period, such counts take the place of the rows when repeats are looked for across periods. `rebalance`
    groups them by `by` before they get their hashes, which do not compress, for a writer that need not do it.
    """
    columns = [*by, *[key for key in keys if key not in by]]
    counted = df.groupBy(*columns).agg(row_count().alias("_n"))
    counted = counted.hint("rebalance", *by) if rebalance else counted
    return counted.select(*columns, F.xxhash64(*keys).alias("_hash"), "_n")


def duplicates_of_counts(counts: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """What `check_duplicates` gives for the rows behind `key_counts`, exactly.

    Groups whose columns are among the keys share none, so their counts add up without a shuffle. Otherwise hashes
    alone are shuffled; the keys themselves are compared only where a hash is found more than once, be it by the same
    keys in two groups or by other keys of equal hash.
    """
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), row_count().alias("n_keys"))
    if set(by) <= set(keys):
        return _duplicates_row(total)
    # No hash is NULL; said here, it need not be inferred for the join, and hashes are shuffled once for both uses.
    per_hash = counts.where("_hash is not null").groupBy("_hash").agg(row_count().alias("_entries"))
    alone = per_hash.agg(count_where(F.col("_entries") == 1).alias("n"))
    again = counts.join(per_hash.where("_entries > 1").select("_hash"), "_hash", "left_semi")
    compared = again.groupBy(*keys).agg(row_count().alias("_entries")).agg(row_count().alias("n"))
    distinct = alone.unionByName(compared).agg(F.sum("n").alias("n_keys"))
    rows = total.select("n_rows", F.lit(None).cast("bigint").alias("n_keys"))
    both = rows.unionByName(distinct.select(F.lit(None).cast("bigint").alias("n_rows"), "n_keys"))
    return _duplicates_row(both.agg(F.max("n_rows").alias("n_rows"), F.max("n_keys").alias("n_keys")))


def _duplicates_row(totals: DataFrame) -> DataFrame:
    """The check row from one row of `n_rows` and `n_keys`."""
    totals = totals.withColumn("n", F.col("n_rows") - F.col("n_keys"))
    count = F.col("n").cast("string")
    share = F.coalesce(_percent_text(F.col("n"), F.col("n_rows"), 2), F.lit("0.00"))
    message = F.concat(F.lit("Encontradas "), count, F.lit(" linhas duplicadas ("), share, F.lit("%)"))
    row = _row("no_duplicates", F.col("n") == 0, "0 duplicates", F.concat(count, F.lit(" duplicates")), message)
    return totals.select(F.inline(F.array(row)))


def check_expected_set(df: DataFrame, column: str, expected: Iterable) -> DataFrame:
    """Values that break the expected set: value, status `missing` or `unexpected`. Empty when the sets agree."""
    kind = T.StructType([T.StructField("value", df.schema[column].dataType)])
    wanted = df.sparkSession.createDataFrame([(v,) for v in expected], kind).distinct()
    found = df.select(F.col(column).alias("value")).distinct()
    sides = found.withColumn("side", F.lit(1)).unionByName(wanted.withColumn("side", F.lit(2)))
    # A value on both sides adds up to 3. Grouping, unlike a join, also matches NULL with NULL.
    alone = sides.groupBy("value").agg(F.sum("side").alias("sides")).where("sides < 3")
    return alone.select("value", F.when(F.col("sides") == 1, "unexpected").otherwise("missing").alias("status"))


def check_columns(absent: DataFrame, keys: Sequence[str] = BRONZE_PERIOD) -> DataFrame:
    """One check row per period, failed if `absent` (an array) names required columns that its files lack."""
    n = F.size("absent")
    listed = F.concat(F.lit("Colunas essenciais ausentes: "), F.array_join("absent", ", "))
    message = F.when(n == 0, "Todas as colunas essenciais presentes").otherwise(listed)
    actual = F.concat(n.cast("string"), F.lit(" missing"))
    return absent.select(
        F.concat_ws("_", F.lit("columns"), *keys).alias("check_name"),
        (n == 0).alias("passed"),
        F.lit("0 missing").alias("expected"),
        actual.alias("actual"),
        message.alias("message"),
    )


def suite_counts(silver: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """What the standard checks count, by state code and `keys`: one scan, one shuffle of a row per group and task."""
    return silver.groupBy(*keys, STATE_COLUMN).agg(*_counts(silver, REQUIRED_COLUMNS, {"idade": AGE_RANGE}))


def suite_of_counts(counts: DataFrame) -> DataFrame:
    """The standard checks from their counts, at whatever grain: completeness, age range, state codes."""
    summed = [c for c in counts.columns if c.startswith(("n_rows", "known_", "outside_"))]
    totals = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in summed])
    checks = _checks_of(totals, REQUIRED_COLUMNS, {"idade": AGE_RANGE})
    return checks.unionByName(check_domain(counts, STATE_COLUMN))


def silver_suite(silver: DataFrame) -> DataFrame:
    """The standard checks of the silver layer. Its counts go through a table, so silver is scanned once."""
    path = scratch_path(silver.sparkSession, "suite-counts")
    counts = suite_counts(silver)
    write_table(counts, path)
    return suite_of_counts(silver.sparkSession.read.schema(counts.schema).parquet(path))


def validate_queries(spark: SparkSession, named_queries: Iterable[tuple[str, str]]) -> DataFrame:
    """Runs each SQL query; one check row per query, failed if it raises. Overall success is `bool_and(passed)`.

    Every row and column of a result is computed and counted by the tasks; no row comes back.
    """
    rows = []
    for name, query in named_queries:
        try:
            counted = Observation()
            result = spark.sql(query).observe(counted, F.count(F.lit(1)).alias("n"))
            result.write.format("noop").mode("overwrite").save()
            n = counted.get["n"]
        except PySparkException as error:
            rows.append((name, False, "query succeeds", "error", str(error).splitlines()[0]))
        else:
            rows.append((name, True, "query succeeds", f"{n} rows", f"Query executada: {n} linhas"))
    return spark.createDataFrame(rows, CHECK_SCHEMA)


def union_checks(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def summarize(results: DataFrame) -> DataFrame:
    """Totals of a set of check rows: total, passed, failed, pct_passed (one decimal; 0 without checks)."""
    total, passed = row_count(), count_where(F.col("passed"))
    share = F.coalesce(percent(passed, total, 1), F.lit(0.0))
    return results.agg(
        total.alias("total"),
        passed.alias("passed"),
        (total - passed).alias("failed"),
        share.alias("pct_passed"),
    )


def save_results(results: DataFrame, path: str, run_id: str) -> None:
    """Appends check rows under a run id."""
    results.withColumn("run_id", F.lit(run_id)).write.mode("append").parquet(path)


def render_report(results: DataFrame) -> str:
    """The check rows as a text report. Check rows are as few as the checks that were asked for."""
    totals = summarize(results).first()
    rule = "=" * 60
    lines = [
        rule,
        "RELATÓRIO DE QUALIDADE DE DADOS",
        rule,
        f"Total de verificações: {totals.total}",
        f"Aprovadas: {totals.passed} ({totals.pct_passed:.1f}%)" if totals.total else "Aprovadas: 0",
        f"Reprovadas: {totals.failed}",
        "-" * 60,
    ]
    lines += [f"{'✓' if r.passed else '✗'} {r.check_name}: {r.message}" for r in results.collect()]
    return "\n".join([*lines, rule])


def _row(name: str, passed: Column, expected: str, actual: Column, message: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        passed.alias("passed"),
        F.lit(expected).alias("expected"),
        actual.alias("actual"),
        message.alias("message"),
    )


def _absent_row(name: str, column: str) -> Column:
    return _row(
        name, F.lit(False), "column exists", F.lit("column missing"), F.lit(f"Coluna {column} não encontrada")
    )


def _completeness_row(column: str) -> Column:
    known, total = F.col(f"known_{column}"), F.col("n_rows")
    enough = (total > 0) & (known >= total * F.lit(MIN_COMPLETENESS).cast("decimal(3,2)"))
    share = F.concat(F.coalesce(_percent_text(known, total, 1), F.lit("0.0")), F.lit("%"))
    return _row(
        f"completeness_{column}", enough, ">=95%", share, F.concat(F.lit(f"Completude de {column}: "), share)
    )


def _range_row(column: str, low, high) -> Column:
    outside = F.col(f"outside_{column}")
    count = outside.cast("string")
    return _row(
        f"range_{column}",
        outside == 0,
        f"[{low}, {high}]",
        F.concat(count, F.lit(" out of range")),
        F.concat(F.lit("Valores fora do range: "), count),
    )


def _percent_text(part: Column, whole: Column, digits: int) -> Column:
    share = F.round(F.try_divide(part * F.lit(100).cast("decimal(4,1)"), whole), digits)
    return share.cast(f"decimal(20,{digits})").cast("string")


def _is_float(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.FloatType | T.DoubleType)


def _known(df: DataFrame, column: str) -> Column:
    known = F.col(column).isNotNull()
    return known & ~F.isnan(column) if _is_float(df, column) else known


def _outside(df: DataFrame, column: str, low, high) -> Column:
    value = F.col(column)
    outside = (value < low) | (value > high)
    # NaN sorts above every number, so it has to be let through by name.
    return outside & ~F.isnan(value) if _is_float(df, column) else outside
