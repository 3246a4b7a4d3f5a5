"""Bronze to silver: typed, labelled, de-duplicated rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveylake.contract import INT_COLUMNS, SYMPTOM_COLUMNS, WEIGHT_COLUMN, WEIGHT_SOURCE
from surveylake.functions.codes import any_flag, try_double, try_int
from surveylake.functions.labels import region_name, state_name
from surveylake.operators.conform import fill_missing_columns, normalize_columns
from surveylake.operators.dedup import dedup_rows

#: The columns that `derive` adds.
DERIVED = ("uf_nome", "regiao", "teve_sintomas_covid", *INT_COLUMNS, WEIGHT_COLUMN)


def derive(bronze: DataFrame) -> DataFrame:
    """All bronze columns, then labels, the symptom flag, 16 typed codes and the weight.

    Codes are typed first and compared as integers, so malformed text becomes NULL, default labels and flag
    0. It is one projection on purpose: Spark computes a repeated cast once, and a second projection would
    copy the wide row again.
    """
    if clashing := sorted(set(bronze.columns) & set(DERIVED)):
        raise ValueError(f"raw columns are named like derived ones: {', '.join(clashing)}")
    typed = {name: try_int(source) for name, source in INT_COLUMNS.items()}
    state = typed["uf_int"]
    return bronze.select(
        "*",
        state_name(state).alias("uf_nome"),
        region_name(state).alias("regiao"),
        any_flag(*[typed[c] == 1 for c in SYMPTOM_COLUMNS]).alias("teve_sintomas_covid"),
        *[column.alias(name) for name, column in typed.items()],
        try_double(WEIGHT_SOURCE).alias(WEIGHT_COLUMN),
    )


def build_silver(bronze: DataFrame, dedup: Callable[[DataFrame], DataFrame] = dedup_rows) -> DataFrame:
    """Conformed bronze rows without repeats, with the derived columns.

    Repeats go before the columns are derived: derived values follow from raw ones, so the result is the
    same and the shuffle carries the raw columns only.
    """
    conformed = fill_missing_columns(normalize_columns(bronze))
    return derive(dedup(conformed))


def filter_months(df: DataFrame, months, column: str = "v1013") -> DataFrame:
    """Rows of the given month numbers; on the silver layer's directory column this prunes the scan."""
    kind = dict(df.dtypes)[column]
    return df.where(F.col(column).isin(*[str(m) if kind == "string" else int(m) for m in months]))
