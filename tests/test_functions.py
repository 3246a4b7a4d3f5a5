import random

import pytest
from pyspark.sql import functions as F

from surveylake.functions import labels, metrics
from surveylake.functions.codes import any_flag, try_double, try_int
from surveylake.plans.silver import filter_months


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


@pytest.mark.parametrize(
    "text, value",
    [("11", 11), ("1.5", None), (" 11 ", 11), ("", None), ("zz", None), (None, None), ("99999999999", None)],
)
def test_try_int(spark, text, value):
    assert one(spark, try_int(F.lit(text).cast("string")))[0] == value


def test_try_double(spark):
    found = one(spark, *[try_double(F.lit(t).cast("string")) for t in ("1.25", " 3 ", "x", "", None)])
    assert tuple(found) == (1.25, 3.0, None, None, None)


def test_casts_do_not_depend_on_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert tuple(one(spark, try_int(F.lit("zz")), try_int(F.lit("11")))) == (None, 11)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_any_flag_treats_null_as_no(spark, rows):
    df = spark.createDataFrame([(1, None), (None, None), (2, 9), (None, 1)], "a int, b int")
    assert [r.f for r in df.select(any_flag(F.col("a") == 1, F.col("b") == 1).alias("f")).collect()] == [1, 0, 0, 1]


def test_state_name_is_exact_and_region_is_a_range(spark):
    df = spark.createDataFrame([(34,), (35,), (11,), (99,), (-1,), (None,), (40,)], "uf int")
    found = df.select("uf", labels.state_name(F.col("uf")), labels.region_name(F.col("uf"))).collect()
    assert [tuple(r) for r in found] == [
        (34, "Desconhecido", "Sudeste"),
        (35, "Sao Paulo", "Sudeste"),
        (11, "Rondonia", "Norte"),
        (99, "Desconhecido", "Desconhecido"),
        (-1, "Desconhecido", "Desconhecido"),
        (None, "Desconhecido", "Desconhecido"),
        (40, "Desconhecido", "Desconhecido"),
    ]


def test_every_state_has_a_region_and_folds_to_its_code(spark):
    assert len(labels.STATES) == 27
    for code, plain, accented in labels.STATES:
        assert labels.lookup_state(code) == accented
        assert labels.lookup_region(code) != labels.UNKNOWN
        assert labels.lookup_state_code(plain) == labels.lookup_state_code(accented.upper()) == code
    assert labels.lookup_state(99) == labels.lookup_region(99) == "Desconhecido"
    assert labels.lookup_state_code("Atlantis") is None


def test_code_of_name_ignores_case_and_accents(spark, rows):
    names = [(n,) for _, plain, accented in labels.STATES for n in (plain, accented, accented.upper())]
    df = spark.createDataFrame([*names, ("nowhere",), (None,)], "name string")
    found = df.select(labels.code_of_name(F.col("name"), labels.STATE_NAMES).alias("code")).collect()
    assert [r.code for r in found] == [c for c, _, _ in labels.STATES for _ in range(3)] + [None, None]


def test_text_codes_and_wide_codes_use_the_map(spark):
    df = spark.createDataFrame([("F", 5000), ("X", 1), (None, None)], "s string, n int")
    found = df.select(
        labels.code_label(F.col("s"), {"F": "Fechado"}, "?"), labels.code_label(F.col("n"), {5000: "big"}, "?")
    ).collect()
    assert [tuple(r) for r in found] == [("Fechado", "big"), ("?", "?"), ("?", "?")]


def test_codes_match_as_whole_numbers_whatever_their_type_or_the_book(spark):
    df = spark.createDataFrame([("11", 11, 11.0), ("zz", 2**32 + 11, 11.7), (None, None, None)], "s string, n bigint, d double")
    for book in ({11: "x"}, {11: "x", 5000: "y"}):
        found = df.select(*[labels.code_label(F.col(c), book, "?") for c in "snd"]).collect()
        assert [tuple(r) for r in found] == [("x",) * 3, ("?",) * 3, ("?",) * 3]


def test_label_from_table_keeps_rows_without_a_match(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    book = spark.createDataFrame([(1, "one")], "k int, v string")
    assert rows(labels.label_from_table(df, "k", book, "k", "v", "label", "?")) == [(1, "one"), (2, "?"), (None, "?")]


def test_month_name_falls_back_to_the_number(spark):
    df = spark.createDataFrame([(9,), (10,), (11,), (12,), (None,)], "m int")
    assert [r[0] for r in df.select(labels.month_name(F.col("m"))).collect()] == ["Set", "Out", "Nov", "12", None]


def test_counts_and_ratios_of_an_empty_frame(spark):
    empty = spark.createDataFrame([], "x int, w double")
    found = empty.agg(
        metrics.count_where(F.col("x") == 1),
        metrics.pct_of_group(F.col("x") == 1),
        metrics.safe_ratio(metrics.count_where(F.col("x") == 1), metrics.row_count()),
        metrics.mean_of_rates(F.col("w")),
    ).first()
    assert tuple(found) == (0, None, 0.0, None)


def test_weighted_total_counts_missing_and_unusable_weights_as_zero(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,), (float("nan"),)], "w double")
    assert df.agg(metrics.weighted_total(F.col("w"))).first()[0] == 0.3


def test_weighted_total_does_not_depend_on_row_order(spark):
    df = spark.range(20000).select((F.col("id") * 0.37 + 0.01).alias("w"), F.col("id"))
    totals = {
        df.repartition(n, "id").agg(metrics.weighted_total(F.col("w"))).first()[0] for n in (1, 3, 16)
    }
    assert len(totals) == 1


def test_percent_rounds_half_up(spark):
    # 46 of 8000 is exactly 0.575 %.
    found = one(spark, metrics.percent(F.lit(46).cast("long"), F.lit(8000).cast("long")))
    assert found[0] == 0.58


def test_mean_of_rates_is_not_ratio_of_sums(spark):
    df = spark.createDataFrame([(1, 2, 50.0), (0, 8, 0.0)], "part long, whole long, rate double")
    found = df.agg(
        metrics.mean_of_rates(F.col("rate")), metrics.ratio_of_sums(F.sum("part"), F.sum("whole"))
    ).first()
    assert tuple(found) == (25.0, 10.0)


def test_filter_months_on_text_and_numbers(spark):
    df = spark.createDataFrame([("9", 9), ("10", 10), ("12", 12)], "v1013 string, mes int")
    assert filter_months(df, [9, 10]).count() == filter_months(df, [9, 10], "mes").count() == 2


@pytest.mark.parametrize("code", ["11.9999999", "12.0000001", "11.999999999999999999"])
def test_codes_are_not_rounded(spark, code):
    frame = spark.createDataFrame([(code, float(code))], "text string, number double")
    found = frame.select(labels.code_label(F.col("text"), {11: "a", 12: "b"}, "none")).first()[0]
    assert found == "none"
    if len(code) < 12:
        assert frame.select(labels.code_label(F.col("number"), {11: "a", 12: "b"}, "none")).first()[0] == "none"


def test_label_from_ranges(spark):
    rnd, at, ranges = random.Random(1), -5000, []
    for n in range(300):
        at += rnd.choice([0, 0, 1, 7, 900])
        end = at + rnd.choice([0, 1, 5, 60, 3000, 1 << 30 if n == 299 else 2])
        ranges.append((at, end, f"r{n}"))
        at = end + 1
    table = spark.createDataFrame(ranges + [(9, 8, "empty"), (None, 5, "no low"), (5, None, "no high")], "low bigint, high bigint, name string")
    codes = [None, -(1 << 62), (1 << 62)] + [e + k for a, b, _ in ranges for e in (a, b) for k in (-1, 0, 1)] * 2
    rows = spark.createDataFrame([(c,) for c in codes], "code bigint")
    found = labels.label_from_ranges(rows, "code", table, "low", "high", "name", "label", "none")
    want = [(c, next((n for a, b, n in ranges if c is not None and a <= c <= b), "none")) for c in codes]
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, want))
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    none = labels.label_from_ranges(rows, "code", table.limit(0), "low", "high", "name", "label", "none")
    assert none.where("label = 'none'").count() == len(codes)


@pytest.mark.parametrize("ranges", [[(1, 5), (5, 9)], [(0, 1 << 40), (77, 78)], [(3, 3), (3, 3)]])
def test_overlapping_ranges_are_an_error(spark, ranges):
    table = spark.createDataFrame([(a, b, "x") for a, b in ranges], "low bigint, high bigint, name string")
    with pytest.raises(ValueError, match="overlap"):
        labels.label_from_ranges(spark.createDataFrame([(1,)], "code bigint"), "code", table, "low", "high", "name", "label", "none")


def test_range_lookup_meets_a_code_once_whatever_the_lengths_of_the_ranges(spark):
    rnd, at, ranges = random.Random(2), -(1 << 62), []
    for bits in [*range(61), 3, 13, 25]:
        end = at + rnd.randrange(1 << bits)
        ranges.append((at, end, f"r{bits}"))
        at = end + 1 + rnd.choice([0, 5000])
    table = spark.createDataFrame(ranges, "low bigint, high bigint, name string")
    codes = [c for a, b, _ in ranges for c in (a - 1, a, (a + b) // 2, b, b + 1, rnd.randint(a, b))]
    rows = spark.createDataFrame([(c,) for c in codes], "code bigint")
    found = labels.label_from_ranges(rows, "code", table, "low", "high", "name", "label", "none")
    want = [(c, next((n for a, b, n in ranges if a <= c <= b), "none")) for c in codes]
    assert sorted(map(tuple, found.collect())) == sorted(want)
    # A row per code and size class is what the lookup must not shuffle.
    assert "explode(" not in found._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("ranges, smallest", [([(0, 1 << 40), (9000, 9001), (1 << 39, 1 << 41)], 9000), ([(-9, 1 << 30), (8192, 1 << 29), (1 << 30, 1 << 31)], 8192)])
def test_the_smallest_number_that_ranges_share_is_named(spark, ranges, smallest):
    table = spark.createDataFrame([(a, b, "x") for a, b in ranges], "low bigint, high bigint, name string")
    with pytest.raises(ValueError, match=f"overlap at {smallest}$"):
        labels.label_from_ranges(spark.createDataFrame([(1,)], "code bigint"), "code", table, "low", "high", "name", "label", "none")
