import zipfile

import pytest
from pyspark.sql import functions as F

from surveylake.contract import BRONZE_COLUMNS, CORE_COLUMNS
from surveylake.operators import conform, dedup
from surveylake.sources import archives, delimited


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


def test_contract_sizes():
    assert len(CORE_COLUMNS) == len(set(CORE_COLUMNS)) == 20
    assert len(BRONZE_COLUMNS) == len(set(BRONZE_COLUMNS)) == 138


def test_header_names_fold_case_space_and_quotes():
    assert conform.header_names('" Uf ",ANO,"a,b"') == ["uf", "ano", "a,b"]


def test_colliding_names_are_an_error(spark):
    with pytest.raises(ValueError, match="collide"):
        conform.normalize_columns(spark.createDataFrame([(1, 2)], "`A ` int, a int"))


def test_missing_columns_keep_their_order_and_fill_as_strings(spark):
    df = spark.createDataFrame([(1,)], "uf int")
    assert conform.missing_columns(df.columns, ["ano", "uf", "b011"]) == ["ano", "b011"]
    filled = conform.fill_missing_columns(df, ["ano", "uf", "b011"])
    assert dict(filled.dtypes) == {"uf": "int", "ano": "string", "b011": "string"}
    assert filled.first().asDict() == {"uf": 1, "ano": None, "b011": None}


def test_union_of_nothing_is_an_error():
    with pytest.raises(ValueError):
        conform.conform_union([])


def test_shifted_headers_land_by_name(spark, tmp_path, rows):
    write(tmp_path / "year=2020/month=09/a.csv", "Ano,UF,V1013,A", "2020,11,9,x")
    write(tmp_path / "year=2020/month=10/b.csv", "Ano,UF,NEW,V1013,A", "2020,35,n,10,y")
    df = delimited.scan_csv(spark, str(tmp_path))
    assert rows(df, "ano", "uf", "v1013", "a", "new", "year", "month") == [
        ("2020", "11", "9", "x", None, "2020", "09"),
        ("2020", "35", "10", "y", "n", "2020", "10"),
    ]


def test_files_of_one_directory_may_differ(spark, tmp_path, rows):
    folder = tmp_path / "month=09"
    write(folder / "a.csv", "A,B", "1,2")
    write(folder / "b.csv", "B,A", "4,3", "6,5")
    write(folder / "c.csv", "A,B", "7,8")
    (folder / "empty.csv").write_text("")
    (folder / "notes.txt").write_text("A,B\n9,9\n")
    df = delimited.scan_csv(spark, str(tmp_path))
    assert rows(df, "a", "b", "month") == [("1", "2", "09"), ("3", "4", "09"), ("5", "6", "09"), ("7", "8", "09")]


def test_nested_directories_are_read_once(spark, tmp_path, rows):
    write(tmp_path / "a.csv", "A", "1")
    write(tmp_path / "more/b.csv", "A", "2")
    write(tmp_path / "more/deep/c.csv", "A", "3")
    assert rows(delimited.scan_csv(spark, str(tmp_path)), "a") == [("1",), ("2",), ("3",)]


def test_header_locations_name_uniform_directories(spark, tmp_path):
    for i in range(3):
        write(tmp_path / f"month=09/{i}.csv", "A,B", "1,2")
    write(tmp_path / "month=10/x.csv", "A", "1")
    write(tmp_path / "month=10/y.csv", "B", "1")
    found = delimited.header_locations(delimited.file_headers(spark, str(tmp_path))).collect()
    assert sorted((r.header, r.location.rsplit("/", 1)[-1]) for r in found) == [
        ("A", "x.csv"),
        ("A,B", "month=09"),
        ("B", "y.csv"),
    ]


def test_headers_by_scan_agree_with_headers_in_place(spark, tmp_path, rows):
    for i in range(5):
        write(tmp_path / f"d{i}/f.csv", f"H{i},B", *[f"{n},{i}" for n in range(2000)])
    by_scan = delimited._headers_by_scan(spark, str(tmp_path), "*.csv").select(
        F.regexp_extract("path", "/(d.)/", 1), "header"
    )
    in_place = delimited._headers_in_place(spark, str(tmp_path), "*.csv").select(
        F.regexp_extract("path", "/(d.)/", 1), "header"
    )
    assert rows(by_scan) == rows(in_place) == [(f"d{i}", f"H{i},B") for i in range(5)]


def test_missing_column_is_reported_for_its_month_only(spark, tmp_path, rows):
    write(tmp_path / "year=2020/month=09/a.csv", "uf,b011", "11,1")
    write(tmp_path / "year=2020/month=10/b.csv", "uf", "11", "12")
    groups = delimited.scan_groups(spark, str(tmp_path))
    report = conform.missing_by_period(groups, ["year", "month"], ["uf", "b011"])
    assert rows(report) == [("2020", "10", "b011", 2)]
    assert rows(delimited.scan_csv(spark, str(tmp_path), ["uf", "b011"]), "uf", "b011", "month") == [
        ("11", "1", "09"),
        ("11", None, "10"),
        ("12", None, "10"),
    ]


def test_delimiter_is_a_parameter(spark, tmp_path, rows):
    write(tmp_path / "a.csv", "A;B", '1;"x;y"', "2")
    assert rows(delimited.scan_csv(spark, str(tmp_path), delimiter=";"), "a", "b") == [("1", "x;y"), ("2", None)]


def test_dedup_variants_agree(spark, rows):
    df = spark.createDataFrame(
        [("a", None), (None, "a"), ("a", None), ("b", "b"), ("b", "b"), ("b", "b"), (None, None), (None, None)],
        "x string, y string",
    )
    expected = [("a", None), ("b", "b"), (None, "a"), (None, None)]
    assert rows(dedup.dedup_rows(df)) == rows(dedup.dedup_rows_by_hash(df)) == sorted(
        expected, key=lambda r: tuple((v is None, str(v)) for v in r)
    )


def test_dedup_of_a_row_that_is_a_third_of_the_data(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert dedup.dedup_rows(df).count() == dedup.dedup_rows_by_hash(df).count() == 20001


def test_packed_rows_come_back_as_they_were(spark):
    values = [None, "", "a", "\x00", "\x1f", "a\x1f", "\x00\x1f", "é"]
    found = [(x, y, z, "same", n) for x in values for y in values for z in values for n in (1, None)]
    kind = "x string, y string, `z.z` string, w string, n int"
    distinct = dedup.dedup_rows(spark.createDataFrame(found * 2, kind))
    assert sorted(map(repr, map(tuple, distinct.collect()))) == sorted(map(repr, found))
    assert distinct.columns == ["x", "y", "z.z", "w", "n"]
    broken = spark.range(6).select(*[F.expr(f"cast(unhex(element_at(array('ff', 'fe', '41'), cast(id % 3 as int) + 1)) as string) AS c{i}") for i in range(5)])
    assert sorted(bytes(r[0]) for r in dedup.dedup_rows(broken).select(F.col("c4").cast("binary")).collect()) == [b"A", b"\xfe", b"\xff"]
    halves = spark.range(1).selectExpr("cast(unhex('C3') as string) a", "cast(unhex('A9') as string) b", "'' c", "'' d")
    assert bytes(dedup.dedup_rows(halves).select(F.col("b").cast("binary")).first()[0]) == b"\xa9"


def test_rows_of_many_short_texts_are_compared_as_one_text(spark):
    df = spark.range(10).select(*[F.col("id").cast("string").alias(f"c{i}") for i in range(20)])
    plan = dedup.dedup_rows(df)._jdf.queryExecution().executedPlan().toString()
    partial = next(line for line in plan.splitlines() if "HashAggregate(keys=[" in line)
    assert partial.count("c1") == 0 and partial.split("keys=[")[1].split("]")[0].count(",") == 1


def make_archive(path, members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in members.items():
            archive.writestr(name, text)


@pytest.fixture
def drops(tmp_path):
    root = tmp_path / "drops"
    make_archive(root / "DADOS_052020.zip", {"a.csv": "A\n5\n"})
    make_archive(
        root / "DADOS_092020.zip",
        {
            "inner/deep/sep.csv": "A,B\r\n1,2\r\n\r\n3,\r\n",
            "inner/readme.txt": "A,B\n8,8\n",
            "second.csv": "B,A\n20,10",
        },
    )
    make_archive(root / "DADOS_112020.zip", {"nov.csv": 'A,C\n"7,5",ç\n'})
    make_archive(root / "DADOS_112021.zip", {"nov.csv": "A,C\n99,z\n"})
    make_archive(root / "other.zip", {"x.csv": "A\n0\n"})
    return str(root)


@pytest.mark.parametrize("in_place", [True, False])
def test_archives_land_by_name(spark, drops, tmp_path, rows, monkeypatch, in_place):
    """The same rows whether archives are read whole or opened in place member by member."""
    blocks = archives.read_blocks(archives.list_archives(spark, drops, years=["2020"]), in_place)
    target = str(tmp_path / "landed")
    archives.block_lines(blocks).write.partitionBy("kind", "year", "month", "layout").text(target)
    df = archives.scan_landed(spark, target, ["a", "b", "c", "d"])
    assert rows(df, "a", "b", "c", "d", "year", "month") == [
        ("1", "2", None, None, "2020", "09"),
        ("10", "20", None, None, "2020", "09"),
        ("3", None, None, None, "2020", "09"),
        ("7,5", None, "ç", None, "2020", "11"),
    ]


def test_land_archives_filters_months_and_years(spark, drops, tmp_path, rows):
    target = str(tmp_path / "landed")
    archives.land_archives(archives.list_archives(spark, drops), target)
    assert rows(archives.landed_layouts(spark, target), "year", "month", "header") == [
        ("2020", "09", "A,B"),
        ("2020", "09", "B,A"),
        ("2020", "11", "A,C"),
        ("2021", "11", "A,C"),
    ]


def test_archives_of_other_periods_are_not_listed(spark, drops):
    def names(**wanted):
        return sorted(r.path.rsplit("/", 1)[-1] for r in archives.list_archives(spark, drops, **wanted).collect())

    assert names() == ["DADOS_092020.zip", "DADOS_112020.zip", "DADOS_112021.zip"]
    assert names(months=["05", "09"]) == ["DADOS_052020.zip", "DADOS_092020.zip"]
    assert names(months=None, years=["2021"]) == ["DADOS_112021.zip"]
    assert names(periods=[("2020", "05"), ("2021", "11")]) == ["DADOS_052020.zip", "DADOS_112021.zip"]
    assert names(name="OTHER") == []


def test_members_are_csv_only(spark, drops, rows):
    found = archives.members_of(archives.list_archives(spark, drops, months=["09"]))
    assert rows(found, "member") == [("inner/deep/sep.csv",), ("second.csv",)]


def test_block_boundaries_do_not_split_lines(spark, tmp_path, rows, monkeypatch):
    lines = [f"{i},{'v' * (i % 50)}" for i in range(50000)]
    make_archive(tmp_path / "drops/X_092020.zip", {"big.csv": "A,B\n" + "\n".join(lines)})
    blocks = archives.read_blocks(archives.list_archives(spark, str(tmp_path / "drops")))
    assert blocks.where("block is not null").count() > 1
    values = archives.block_lines(blocks).where("kind = 'data'").select("value")
    assert sorted(r.value for r in values.collect()) == sorted(lines)


def test_empty_drop_folder_has_no_archives(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert archives.list_archives(spark, str(tmp_path / "none")).count() == 0


def test_directories_of_different_depth_are_read_together(spark, tmp_path, rows):
    for folder, line in (("year=2020/month=09", "1,2"), ("plain", "3,4"), ("year=2020/month=10", "5,6")):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "a.csv").write_text(f"a,b\n{line}\n")
    found = delimited.scan_csv(spark, str(tmp_path))
    assert rows(found, "a", "b", "year", "month") == [
        ("1", "2", "2020", "09"), ("3", "4", None, None), ("5", "6", "2020", "10"),
    ]
