"""Report queries over the gold tables. Inputs are gold tables, so all of them are small and stay distributed."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveylake.functions.labels import NOT_INFORMED, month_name
from surveylake.functions.metrics import RATE_TYPE, mean_of_rates, percent, ratio_of_sums, row_count

# The months under analysis.
ANALYSIS_MONTHS = (9, 10, 11)


def evolution(national: DataFrame, limit: int = 20) -> DataFrame:
    """Monthly evolution in month order."""
    chosen = national.select(
        "mes", "total_entrevistados", "total_com_sintomas", "pct_sintomaticos", "total_testados", "total_positivos"
    )
    return chosen.orderBy("mes").limit(limit)


def of_months(table: DataFrame, months: Iterable[int] = ANALYSIS_MONTHS) -> DataFrame:
    """Rows of a monthly gold table that the analysis covers; the totals and shares by region are built on these."""
    return table.where(F.col("mes").isin(*months))


def evolution_of_months(national: DataFrame, months: Iterable[int] = ANALYSIS_MONTHS) -> DataFrame:
    """The given months with their short names, in month order."""
    return (
        of_months(national, months).withColumn("mes_nome", month_name(F.col("mes"))).orderBy("mes")
    )


def top_states(symptoms: DataFrame, limit: int = 10) -> DataFrame:
    """States with most symptomatic people and their mean monthly percentage; ties go by name."""
    mean = F.try_divide(F.sum(F.col("pct_sintomas_covid").cast(RATE_TYPE)), F.count("pct_sintomas_covid"))
    per_state = symptoms.groupBy("uf_nome", "regiao").agg(
        F.sum("total_com_sintomas_covid").alias("total_sintomaticos"),
        F.round(mean, 2).cast("double").alias("media_pct_sintomas"),
    )
    return per_state.orderBy(F.desc("total_sintomaticos"), "uf_nome", "regiao").limit(limit)


def sample_rows(df: DataFrame, limit: int, *order_by: str) -> DataFrame:
    """A repeatable sample: the first rows in the given order."""
    return df.orderBy(*order_by).limit(limit)


def table_shapes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table."""
    shapes = [
        df.agg(row_count().alias("linhas")).select(
            F.lit(name).alias("tabela"), "linhas", F.lit(len(df.columns)).alias("colunas")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, shapes)


def symptoms_by_state(symptoms: DataFrame) -> DataFrame:
    """Totals per state over the months, with the mean of the monthly percentages; fewest symptomatic first."""
    per_state = symptoms.groupBy("uf_nome", "regiao").agg(
        F.sum("total_com_sintomas_covid").alias("total_com_sintomas_covid"),
        F.sum("total_entrevistados").alias("total_entrevistados"),
        mean_of_rates(F.col("pct_sintomas_covid")).alias("pct_sintomas_covid"),
    )
    return per_state.orderBy("total_com_sintomas_covid", "uf_nome")


def absence_by_region(work: DataFrame) -> DataFrame:
    """Percent away from work per region: total away over total interviewed."""
    totals = work.groupBy("regiao").agg(
        F.sum("total_afastados").alias("total_afastados"), F.sum("total_entrevistados").alias("total_entrevistados")
    )
    share = ratio_of_sums(F.col("total_afastados"), F.col("total_entrevistados"))
    return totals.withColumn("pct_afastados", share)


def series_by_region(work: DataFrame) -> DataFrame:
    """Each region's monthly percentage away from work, all regions in one pass."""
    return work.select("regiao", "mes", "pct_afastados").orderBy("regiao", "mes")


def known_profiles(profile: DataFrame) -> DataFrame:
    """Profiles whose sex and race are both informed."""
    return profile.where((F.col("sexo_desc") != NOT_INFORMED) & (F.col("cor_raca_desc") != NOT_INFORMED))


def symptomatic_by(profile: DataFrame, label: str) -> DataFrame:
    """Symptomatic people per label among known profiles, fewest first."""
    totals = known_profiles(profile).groupBy(label).agg(F.sum("total_sintomaticos").alias("total_sintomaticos"))
    return totals.orderBy("total_sintomaticos", label)


def share_of_total(df: DataFrame, label: str, value: str, digits: int = 1) -> DataFrame:
    """Each label's percent of the whole.

    The total is a scalar subquery over the label totals: the input is aggregated once, and no task sees
    all labels.
    """
    per_label = df.groupBy(label).agg(F.sum(value).alias(value))
    total = per_label.agg(F.sum(value)).scalar()
    return per_label.withColumn("pct_total", percent(F.col(value), total, digits))


def share_by_sex(profile: DataFrame) -> DataFrame:
    return share_of_total(known_profiles(profile), "sexo_desc", "total_sintomaticos")


def positivity_ranked(tests: DataFrame) -> DataFrame:
    """States by positivity, lowest first."""
    return tests.select("uf_nome", "regiao", "taxa_positividade").orderBy("taxa_positividade", "uf_nome")


def mean_positivity(tests: DataFrame) -> DataFrame:
    """Unweighted mean of the state rates."""
    return tests.agg(mean_of_rates(F.col("taxa_positividade")).alias("media_nacional"))


def period_totals(national: DataFrame) -> DataFrame:
    """Totals of the whole period and their overall percentages."""
    totals = national.agg(
        *[
            F.sum(c).alias(c)
            for c in (
                "total_entrevistados",
                "total_com_sintomas",
                "total_testados",
                "total_positivos",
                "total_internados",
            )
        ]
    )
    return totals.withColumns(
        {
            "pct_sintomaticos": ratio_of_sums(F.col("total_com_sintomas"), F.col("total_entrevistados")),
            "pct_testados": ratio_of_sums(F.col("total_testados"), F.col("total_entrevistados")),
            "taxa_positividade": ratio_of_sums(F.col("total_positivos"), F.col("total_testados")),
        }
    )


def mean_pct_by_region(symptoms: DataFrame) -> DataFrame:
    """Mean of the state and month percentages per region, highest first; not a ratio of sums."""
    means = symptoms.groupBy("regiao").agg(mean_of_rates(F.col("pct_sintomas_covid")).alias("pct_sintomas_covid"))
    return means.orderBy(F.desc("pct_sintomas_covid"), "regiao")


def positivity_by_region(tests: DataFrame) -> DataFrame:
    """Positives over tested per region, highest first; not a mean of rates."""
    totals = tests.groupBy("regiao").agg(
        F.sum("total_testados").alias("total_testados"), F.sum("total_positivos").alias("total_positivos")
    )
    rate = ratio_of_sums(F.col("total_positivos"), F.col("total_testados"))
    return totals.withColumn("taxa", rate).orderBy(F.desc("taxa"), "regiao")
