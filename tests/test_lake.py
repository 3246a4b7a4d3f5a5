import shutil
import zipfile
from functools import partial
from pathlib import Path

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from surveylake.contract import SILVER_SCHEMA
from surveylake.operators.periods import ALL_MONTHS
from surveylake.fixtures import microdata, table, write_archives
from surveylake.plans.gold import GOLD_TABLES, gold_table
from surveylake.operators.dedup import dedup_rows
from surveylake.plans.lake import batches, refresh_lake, version_bytes
from surveylake.plans.silver import build_silver
from surveylake.session import open_files, sized_for, task_settings
from surveylake.sources.archives import block_lines, block_texts, land_archives, list_archives, scan_landed
from surveylake.sources.catalog import ensure_database, register_published
from surveylake.sources.layers import read_silver
from surveylake.sources.published import published

SF_DIR = "/root/testdata/sf0.001"


def test_lake_grows_period_by_period(spark, tmp_path, rows):
    bronze = microdata(table(spark, SF_DIR, "lineitem"))
    drops, lake, late = str(tmp_path / "drops"), str(tmp_path / "lake"), tmp_path / "late"
    write_archives(bronze, drops)
    late.mkdir()
    for archive in (tmp_path / "drops").glob("*_112020.zip"):
        shutil.copy(archive, late)
        archive.unlink()

    first = refresh_lake(spark, drops, lake)
    assert first.landed == first.silver == [("2020", "09"), ("2020", "10")]
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "lake/silver/ano=2020/v1013=9").glob("*.parquet")}
    assert files

    again = refresh_lake(spark, drops, lake)
    assert (again.landed, again.silver, again.gold) == ([], [], {})

    for archive in late.iterdir():
        shutil.copy(archive, drops)
    second = refresh_lake(spark, drops, lake)
    assert second.landed == second.silver == [("2020", "11")]
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "lake/silver/ano=2020/v1013=9").glob("*.parquet")} == files

    expected = build_silver(bronze)
    assert rows(read_silver(spark, f"{lake}/silver", SILVER_SCHEMA).select(*expected.columns)) == rows(expected)
    for name in GOLD_TABLES:
        assert rows(spark.read.parquet(second.gold[name])) == rows(gold_table(expected, name))
    runs = spark.read.parquet(f"{lake}/quality")
    assert runs.select("run_id").distinct().count() == 2
    assert runs.where("check_name LIKE 'columns_%' AND passed").count() == 2 + 3


def archive(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(folder / name, "w") as packed:
        packed.writestr("dados.csv", "\n".join(["Ano,V1013,UF,A002", *lines]))


def stamps(folder):
    return {p: p.stat().st_mtime_ns for p in folder.glob("*.parquet")}


def test_late_archives_of_a_landed_period_arrive(spark, tmp_path, rows):
    drops, lake = tmp_path / "drops", str(tmp_path / "lake")
    archive(drops, "A_092020.zip", "2020,9,11,1")
    refresh_lake(spark, str(drops), lake)
    archive(drops, "B_092020.zip", "2020,9,11,2", "2020,9,11,1")
    late = refresh_lake(spark, str(drops), lake)
    assert [p.rsplit("/", 1)[1] for p in late.archives] == ["B_092020.zip"] and late.silver == [("2020", "09")]
    assert rows(read_silver(spark, f"{lake}/silver", SILVER_SCHEMA), "idade") == [(1,), (2,)]


def test_a_landing_that_stopped_half_way_is_made_good(spark, tmp_path, rows):
    drops, lake = tmp_path / "drops", str(tmp_path / "lake")
    archive(drops, "A_092020.zip", "2020,9,11,1")
    land_archives(list_archives(spark, str(drops)), f"{lake}/landed")
    archive(drops, "B_092020.zip", "2020,9,11,2")
    assert len(refresh_lake(spark, str(drops), lake).archives) == 2
    assert rows(read_silver(spark, f"{lake}/silver", SILVER_SCHEMA), "idade") == [(1,), (2,)]


def test_a_file_with_a_header_only_has_no_rows(spark, tmp_path, rows):
    drops, lake = tmp_path / "drops", str(tmp_path / "lake")
    archive(drops, "A_092020.zip", "2020,9,11,1")
    with zipfile.ZipFile(drops / "B_102020.zip", "w") as packed:
        packed.writestr("dados.csv", "Ano,V1013,UF,A003\n")
    archive(drops, "C_052020.zip", "2020,5,11,1")
    done = refresh_lake(spark, str(drops), lake)
    assert [p.rsplit("/", 1)[1] for p in done.skipped] == ["C_052020.zip"]
    assert rows(read_silver(spark, f"{lake}/silver", SILVER_SCHEMA), "idade") == [(1,)]


def test_misfiled_rows_are_neither_lost_nor_doubled(spark, tmp_path, rows):
    drops, lake = tmp_path / "drops", str(tmp_path / "lake")
    archive(drops, "X_102020.zip", "2020,10,11,1", "2020,11,11,2", "2020,,11,3")
    assert refresh_lake(spark, str(drops), lake).silver == [("2020", "10")]
    checked = spark.read.parquet(f"{lake}/quality").where("check_name = 'columns_2020_10'").first()
    assert (checked.passed, checked.actual) == (False, "16 missing")
    assert refresh_lake(spark, str(drops), lake).silver == []
    archive(drops, "X_112020.zip", "2020,11,11,2", "2020,11,11,4")
    untouched = stamps(tmp_path / "lake/silver/ano=2020/v1013=10")
    assert refresh_lake(spark, str(drops), lake).silver == [("2020", "11")]
    assert untouched and stamps(tmp_path / "lake/silver/ano=2020/v1013=10") == untouched
    silver = read_silver(spark, f"{lake}/silver", SILVER_SCHEMA)
    assert rows(silver, "v1013", "idade") == [("10", 1), ("11", 2), ("11", 4), (None, 3)]


def test_a_run_that_stopped_early_is_made_good(spark, tmp_path, rows):
    drops, lake = tmp_path / "drops", str(tmp_path / "lake")
    archive(drops, "X_092020.zip", "2020,9,11,1", "2020,9,11,2")
    refresh_lake(spark, str(drops), lake)
    shutil.rmtree(f"{lake}/silver-archives")
    assert refresh_lake(spark, str(drops), lake).silver == [("2020", "09")]
    assert rows(read_silver(spark, f"{lake}/silver", SILVER_SCHEMA), "idade") == [(1,), (2,)]


def test_a_run_that_stopped_before_gold_is_made_good(spark, tmp_path, rows):
    drops, lake = tmp_path / "drops", str(tmp_path / "lake")
    archive(drops, "X_092020.zip", "2020,9,11,1", "2020,9,11,2")
    refresh_lake(spark, str(drops), lake)
    shutil.rmtree(f"{lake}/gold-archives")
    shutil.rmtree(f"{lake}/gold")
    again = refresh_lake(spark, str(drops), lake)
    assert again.silver == []
    assert rows(spark.read.parquet(again.gold["evolucao_nacional"]), "mes", "total_entrevistados") == [(9, 2)]


def test_summaries_of_untouched_periods_are_kept(spark, tmp_path, rows):
    drops, lake = tmp_path / "drops", str(tmp_path / "lake")
    archive(drops, "X_092020.zip", "2020,9,11,1", "2020,9,99,200")
    refresh_lake(spark, str(drops), lake)
    kept = [tmp_path / "lake" / name / "ano=2020/v1013=9" for name in ("shared-aggregate", "suite-counts")]
    before = [stamps(folder) for folder in kept]
    archive(drops, "X_102020.zip", "2020,10,11,3")
    done = refresh_lake(spark, str(drops), lake)
    assert all(before) and [stamps(folder) for folder in kept] == before
    silver = read_silver(spark, f"{lake}/silver", SILVER_SCHEMA)
    for name in GOLD_TABLES:
        assert rows(spark.read.parquet(done.gold[name])) == rows(gold_table(silver, name))
    (last,) = spark.read.parquet(f"{lake}/quality").where("check_name = 'range_idade' and actual = '1 out of range'").groupBy("check_name").count().collect()
    assert last["count"] == 2


def test_gold_tables_are_shown_together(spark, tmp_path, rows, monkeypatch):
    from surveylake.plans import gold

    drops, lake = tmp_path / "drops", str(tmp_path / "lake")
    assert published(spark, f"{lake}/gold") == {}
    archive(drops, "X_092020.zip", "2020,9,11,1")
    first = refresh_lake(spark, str(drops), lake).gold
    assert published(spark, f"{lake}/gold") == first and first.keys() == GOLD_TABLES.keys()
    total = lambda path: rows(spark.read.parquet(path), "mes", "total_entrevistados")

    # A writer that stops between two tables changes nothing for readers, and the next one makes it good.
    write, count = gold.write_table, []

    def stops(df, path, mode="overwrite"):
        count.append(path)
        if len(count) == 3:
            raise InterruptedError
        write(df, path, mode)

    monkeypatch.setattr(gold, "write_table", stops)
    archive(drops, "X_102020.zip", "2020,10,11,1")
    with pytest.raises(InterruptedError):
        refresh_lake(spark, str(drops), lake)
    assert len(count) >= 3 and published(spark, f"{lake}/gold") == first and total(first["evolucao_nacional"]) == [(9, 1)]
    monkeypatch.undo()
    second = refresh_lake(spark, str(drops), lake).gold
    assert published(spark, f"{lake}/gold") == second and total(second["evolucao_nacional"]) == [(10, 1), (9, 1)]

    # Who reads the version before may go on; what the stopped writer left is gone, and so are older versions later.
    assert total(first["evolucao_nacional"]) == [(9, 1)]
    versions = lambda: {p.name for p in (tmp_path / "lake/gold").iterdir()}
    assert versions() == {Path(p).parent.name for p in [*first.values(), *second.values()]}
    archive(drops, "X_112020.zip", "2020,11,11,1")
    third = refresh_lake(spark, str(drops), lake).gold
    assert versions() == {Path(p).parent.name for p in [*second.values(), *third.values()]}


def test_registered_gold_follows_the_published_version(spark, tmp_path):
    drops, lake = tmp_path / "drops", str(tmp_path / "lake")
    ensure_database(spark, "followed", str(tmp_path / "database"))
    archive(drops, "X_092020.zip", "2020,9,11,1")
    refresh_lake(spark, str(drops), lake)
    register = lambda: register_published(spark, "followed", f"{lake}/gold", "gold_")
    months = lambda: spark.table("followed.gold_evolucao_nacional").count()
    assert len(register()) == len(GOLD_TABLES) and register() == [] and months() == 1
    archive(drops, "X_102020.zip", "2020,10,11,1")
    refresh_lake(spark, str(drops), lake)
    assert months() == 1
    assert len(register()) == len(GOLD_TABLES) and months() == 2
    spark.sql("DROP DATABASE followed CASCADE")


def silver_rows(spark, lake, rows, *columns):
    return rows(read_silver(spark, f"{lake}/silver", SILVER_SCHEMA), *columns)


def test_a_corrected_archive_takes_its_old_rows_out(spark, tmp_path, rows):
    drops, lake = tmp_path / "drops", str(tmp_path / "lake")
    archive(drops, "P_092020.zip", "2020,9,11,20", "2020,9,12,30", "2020,10,13,7")
    archive(drops, "Q_092020.zip", "2020,9,12,30")
    archive(drops, "R_112020.zip", "2020,11,14,1")
    refresh_lake(spark, str(drops), lake)
    untouched = stamps(tmp_path / "lake/silver/ano=2020/v1013=11")
    archive(drops, "P_092020.zip", "2020,9,11,21")
    done = refresh_lake(spark, str(drops), lake)
    assert [p.rsplit("/", 1)[1] for p in done.retracted] == [p.rsplit("/", 1)[1] for p in done.archives] == ["P_092020.zip"]
    # The row that another archive holds too stays; the misfiled one goes, and with it the only row of its period.
    assert silver_rows(spark, lake, rows, "v1013", "uf", "idade") == [("11", "14", 1), ("9", "11", 21), ("9", "12", 30)]
    assert untouched and stamps(tmp_path / "lake/silver/ano=2020/v1013=11") == untouched
    assert rows(spark.read.parquet(done.gold["evolucao_nacional"]), "mes", "total_entrevistados") == [(11, 1), (9, 2)]
    assert refresh_lake(spark, str(drops), lake).retracted == []


def test_a_withdrawn_archive_takes_its_rows_out(spark, tmp_path, rows):
    drops, other, lake = tmp_path / "drops", tmp_path / "other", str(tmp_path / "lake")
    archive(drops, "P_092020.zip", "2020,9,11,20")
    archive(drops, "Q_092020.zip", "2020,9,12,30")
    archive(other, "S_102020.zip", "2020,10,12,40")
    refresh_lake(spark, str(drops), lake)
    # Archives of other drops, and of months not asked for, are not withdrawn.
    assert refresh_lake(spark, str(other), lake, months=["10"]).retracted == []
    assert refresh_lake(spark, str(drops), lake, months=["11"]).retracted == []
    (drops / "Q_092020.zip").unlink()
    assert refresh_lake(spark, str(drops), lake, withdraw=False).retracted == []
    done = refresh_lake(spark, str(drops), lake)
    assert [p.rsplit("/", 1)[1] for p in done.retracted] == ["Q_092020.zip"] and done.silver == [("2020", "09")]
    assert silver_rows(spark, lake, rows, "uf", "idade") == [("11", 20), ("12", 40)]
    (drops / "P_092020.zip").unlink()
    (other / "S_102020.zip").unlink()
    refresh_lake(spark, str(drops), lake)
    gold = refresh_lake(spark, str(other), lake).gold
    assert all(spark.read.parquet(path).count() == 0 for path in gold.values())
    # The same archive may come back.
    archive(drops, "P_092020.zip", "2020,9,11,20")
    refresh_lake(spark, str(drops), lake)
    assert silver_rows(spark, lake, rows, "uf", "idade") == [("11", 20)]


def test_drops_without_data_lines(spark, tmp_path, rows):
    drops, lake = tmp_path / "drops", str(tmp_path / "lake")
    drops.mkdir()
    assert refresh_lake(spark, str(drops), lake).archives == []
    with zipfile.ZipFile(drops / "A_092020.zip", "w") as packed:
        packed.writestr("leia-me.txt", "no data")
    assert refresh_lake(spark, str(drops), lake).landed == [("2020", "09")]
    archive(drops, "B_102020.zip")
    done = refresh_lake(spark, str(drops), lake)
    assert done.silver == [("2020", "10")] and all(spark.read.parquet(path).count() == 0 for path in done.gold.values())
    checks = spark.read.parquet(f"{lake}/quality").where("check_name = 'columns_2020_10'")
    assert checks.count() == 1
    archive(drops, "C_102020.zip", "2020,10,11,1")
    refresh_lake(spark, str(drops), lake)
    assert silver_rows(spark, lake, rows, "idade") == [(1,)]


def test_all_months_and_periods_of_any_text(spark, tmp_path, rows):
    drops, lake = tmp_path / "drops", str(tmp_path / "lake")
    archive(drops, "A_052020.zip", "2020,5,11,1", '2020,"",11,2', "2020,,11,3", "2020,a/b =c%,11,4")
    archive(drops, "A_122021.zip", "2021,12,11,5")
    (drops / "other.zip").write_bytes((drops / "A_052020.zip").read_bytes())
    done = refresh_lake(spark, str(drops), lake, ALL_MONTHS)
    assert [p.rsplit("/", 1)[1] for p in done.skipped] == ["other.zip"] and len(done.archives) == 2
    assert silver_rows(spark, lake, rows, "v1013", "idade") == [("12", 5), ("5", 1), ("a/b =c%", 4), (None, 2), (None, 3)]
    archive(drops, "A_052020.zip", "2020,a/b =c%,11,6")
    refresh_lake(spark, str(drops), lake, ALL_MONTHS)
    assert silver_rows(spark, lake, rows, "v1013", "idade") == [("12", 5), ("a/b =c%", 6)]


def test_a_run_that_stopped_after_landing_a_correction_is_made_good(spark, tmp_path, rows):
    drops, lake = tmp_path / "drops", str(tmp_path / "lake")
    archive(drops, "P_092020.zip", "2020,9,11,20")
    refresh_lake(spark, str(drops), lake)
    archive(drops, "P_092020.zip", "2020,9,11,21", "2020,9,11,22")
    kept = tmp_path / "kept"
    shutil.copytree(f"{lake}/silver-archives", kept)
    refresh_lake(spark, str(drops), lake)
    for name in ("silver-archives", "gold-archives"):
        shutil.rmtree(f"{lake}/{name}")
    shutil.copytree(kept, f"{lake}/silver-archives")
    assert refresh_lake(spark, str(drops), lake).silver == [("2020", "09")]
    assert silver_rows(spark, lake, rows, "idade") == [(21,), (22,)]


def test_a_refresh_reads_only_the_versions_that_carry_touched_periods(spark, tmp_path):
    drops, lake = tmp_path / "drops", str(tmp_path / "lake")
    for month in ("09", "10"):
        archive(drops, f"P_{month}2020.zip", f"2020,{int(month)},11,20")
    refresh_lake(spark, str(drops), lake)
    # Neither the landed lines nor the silver rows of the other periods can be read any more.
    for folder in [*(tmp_path / "lake/landed").rglob("month=*"), *(tmp_path / "lake/silver").rglob("v1013=*")]:
        for file in folder.rglob("part-*"):
            file.write_bytes(b"broken")
        for file in folder.rglob(".part-*"):
            file.unlink()
    archive(drops, "P_112020.zip", "2020,11,11,30")
    done = refresh_lake(spark, str(drops), lake)
    assert spark.read.parquet(done.gold["evolucao_nacional"]).count() == 3


def test_batches_hold_every_period():
    sizes = {("2020", "09"): 6, ("2020", "10"): 5, ("2020", "11"): 5, ("2021", "09"): 20, ("2021", "10"): 0}
    found = batches(sizes, 10)
    assert found == [[("2020", "09")], [("2020", "10"), ("2020", "11")], [("2021", "09")], [("2021", "10")]]
    assert batches({}) == []


def test_task_settings_grow_with_the_input():
    small = task_settings(5, 200, 128 << 20)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert small["spark.sql.files.maxPartitionBytes"] == str(128 << 20)
    assert task_settings(1 << 40, 200, 128 << 20)["spark.sql.shuffle.partitions"] == "4096"
    huge = task_settings(100 << 40, 200, 128 << 20)
    assert huge["spark.sql.shuffle.partitions"] == "20000"
    assert huge["spark.sql.files.maxPartitionBytes"] == str(1 << 30)


def test_scans_of_few_large_splits_are_split_finer():
    for total, scan in ((1 << 30, 8 << 20), (4 << 30, 32 << 20), (64 << 30, 128 << 20)):
        assert task_settings(total, 200, 128 << 20)["spark.sql.files.maxPartitionBytes"] == str(scan)
    assert task_settings(1 << 30, 200, 4 << 20)["spark.sql.files.maxPartitionBytes"] == str(4 << 20)


def test_few_periods_are_shuffled_once(spark, tmp_path, monkeypatch):
    from surveylake.contract import CORE_COLUMNS
    from surveylake.plans import lake

    written = []
    monkeypatch.setattr(lake, "scan_pieces", lambda *_: held)
    monkeypatch.setattr(lake, "write_silver", lambda rows, *_, **__: written.append(rows))
    held = spark.createDataFrame([("2020", str(month)) for month in range(1, 13)] * 2, "ano string, v1013 string")
    held = held.withColumns({name: F.lit("1") for name in (*CORE_COLUMNS, "archive_version") if name not in held.columns})
    for most in (3, 12):
        lake.refresh_silver(spark, "landed", str(tmp_path), [("2020", str(month)) for month in range(1, most + 1)], [])
        assert written[-1].count() == most
    few, many = (rows._jdf.queryExecution().optimizedPlan().toString() for rows in written)
    assert "Rebalance" not in few and "Rebalance" in many


def test_task_sizes_are_restored(spark):
    keys = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    before = [spark.conf.get(key) for key in keys]
    with sized_for(spark, spark.createDataFrame([(10 << 30,), (5,)], "length long")):
        assert spark.conf.get(keys[0]) == "41"
    assert [spark.conf.get(key) for key in keys] == before


def test_bytes_of_versions_take_one_pass():
    pieces = [Row(archive_version=v, bytes=n) for v, n in (("a", 1), ("b", 2), ("a", 4), ("c", 0))]
    assert version_bytes(iter(pieces)) == {"a": 5, "b": 2, "c": 0}


def test_a_task_packs_its_rows_into_one_archive_a_period(spark, tmp_path, rows, monkeypatch):
    from surveylake import fixtures

    names = ("ano", "v1013", "a002", "a003")
    odd = F.when(F.col("id") % 7 == 0, 'a "b", c').when(F.col("id") % 7 == 1, "").when(F.col("id") % 7 != 2, "x")
    values = [F.lit("2020"), (9 + F.col("id") % 2).cast("string"), F.col("id").cast("string"), odd]
    many = spark.range(0, 25_000, 1, 1).select(*[value.alias(name) for name, value in zip(names, values)])
    write_archives(many.unionByName(many.limit(1).withColumn("v1013", F.lit(None).cast("string"))).coalesce(1), str(tmp_path / "few"))
    assert len(list((tmp_path / "few").iterdir())) == 2  # rows without a period are in no archive
    monkeypatch.setattr(fixtures, "ARCHIVE_BYTES", 1)
    write_archives(many, str(tmp_path / "many"))
    assert len(list((tmp_path / "many").iterdir())) > 2
    for folder in ("few", "many"):
        land_archives(list_archives(spark, str(tmp_path / folder)), f"{tmp_path}/landed-{folder}")
        found = scan_landed(spark, f"{tmp_path}/landed-{folder}")
        assert rows(found, "v1013", "a002", "a003") == rows(many, "v1013", "a002", F.when(F.col("a003") != "", F.col("a003")))


def test_blocks_land_the_lines_that_are_not_blank(spark, tmp_path, rows):
    texts = [None, "1,2", "", "   ", "\n1,2\n\n", " 1,2\n 3,4", "1,2\n  \n3,4\n", "1,2\n\t\n3,4", "1,2\n3,4", "1\r\n \r\n2"]
    blocks = spark.createDataFrame([("2020", "09", h, t) for h in ("A,B", " ", "") for t in texts], "year string, month string, header string, block string")
    lines, landed = str(tmp_path / "lines"), str(tmp_path / "texts")
    block_lines(blocks).write.partitionBy("kind", "year", "month", "layout").text(lines)
    block_texts(blocks).write.partitionBy("kind", "year", "month", "layout").text(landed)
    assert rows(spark.read.text(landed)) == rows(spark.read.text(lines))


def test_landing_does_not_sort(spark, tmp_path):
    blocks = spark.createDataFrame([("2020", "09", "A,B", "1,2")], "year string, month string, header string, block string")
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    with open_files(spark, 50):
        assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "50"
        block_texts(blocks).write.partitionBy("kind", "year", "month", "layout").text(str(tmp_path / "landed"))
        with open_files(spark, 3):
            assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "50"
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


def test_rows_are_rebalanced_while_they_are_packed(spark, rows):
    bronze = microdata(table(spark, SF_DIR, "lineitem"))
    odd = bronze.limit(40).withColumns({"ano": F.lit(None).cast("string"), "uf": F.lit("a\x1fb")})
    bronze = bronze.unionByName(odd).unionByName(bronze.limit(100))
    by = build_silver(bronze, partial(dedup_rows, by=("ano", "v1013")))
    expected = build_silver(bronze)
    assert by.schema == expected.schema and rows(by) == rows(expected)
    plan = by._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("uf_nome") < plan.index("RebalancePartitions")
