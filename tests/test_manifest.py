"""Periods noted as layers are written, and duplicate checks from counts kept per period."""

import shutil
import zipfile

import pytest

from surveylake.contract import SILVER_SCHEMA
from surveylake.operators import quality
from surveylake.plans.lake import refresh_lake
from surveylake.plans.silver import build_silver
from surveylake.sources import catalog, manifest
from surveylake.sources.layers import read_silver, write_silver, write_table

KEYS = ["uf", "a002"]


def archive(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(folder / name, "w") as packed:
        packed.writestr("dados.csv", "\n".join(["Ano,V1013,UF,A002,V1032", *lines]))


def stamps(folder):
    return {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def last_duplicates(spark, lake, before=()):
    found = spark.read.parquet(f"{lake}/quality").where("check_name = 'no_duplicates'").collect()
    (new,) = [row for row in found if row.run_id not in before]
    return new.run_id, new.actual


def noted(spark, root, layer="silver"):
    return sorted(((r.ano, r.v1013) for r in manifest.noted_periods(spark, root, layer).collect()), key=str)


def test_notes_tell_what_a_layer_holds(spark, tmp_path):
    root = str(tmp_path / "lake")
    assert noted(spark, root) == [] and manifest.noted_layers(spark, root) == []
    manifest.note_periods(spark, root, {"silver": [("2020", "9"), ("2020", None)], "other": [("2020", "9")]})
    manifest.note_periods(spark, root, {"silver": [("2020", "10"), ("2020", "9")]}, {"silver": [("2020", None)]})
    manifest.note_periods(spark, root, {}, {})
    assert noted(spark, root) == [("2020", "10"), ("2020", "9")]
    assert manifest.noted_layers(spark, root) == [("other", ["ano", "v1013"]), ("silver", ["ano", "v1013"])]
    assert manifest.stale_periods(spark, root, "silver", "other") == ([("2020", "10"), ("2020", "9")], [])
    manifest.note_periods(spark, root, {"other": [("2020", "9"), ("2020", "8")]})
    assert manifest.stale_periods(spark, root, "silver", "other") == ([("2020", "10")], [("2020", "8")])


def test_a_refresh_notes_periods_and_tables_follow_without_a_listing(spark, tmp_path, monkeypatch):
    drops, root = tmp_path / "drops", str(tmp_path / "lake")
    archive(drops, "A_092020.zip", "2020,9,11,1,2.5", "2020,,11,3,1")
    archive(drops, "B_102020.zip", "2020,10,12,2,1")
    catalog.ensure_database(spark, "noted_lake")
    schemas = {"silver": SILVER_SCHEMA}
    listing = manifest.discover_periods
    for module in (manifest, catalog):
        monkeypatch.setattr(module, "discover_periods", None)
    refresh_lake(spark, str(drops), root)
    assert noted(spark, root) == noted(spark, root, "suite-counts") == [("2020", "10"), ("2020", "9"), ("2020", None)]
    assert catalog.register_noted(spark, "noted_lake", root, schemas, "l_") == {"l_silver": [("2020", "10"), ("2020", "9"), ("2020", None)]}
    assert catalog.register_noted(spark, "noted_lake", root, schemas, "l_") == {"l_silver": []}
    shown = lambda: sorted(((r.v1013, r.uf, r.idade) for r in spark.table("noted_lake.l_silver").collect()), key=str)
    assert shown() == [("10", "12", 2), ("9", "11", 1), (None, "11", 3)]

    stray = tmp_path / "lake/silver/ano=2020/v1013=12"
    shutil.copytree(tmp_path / "lake/silver/ano=2020/v1013=10", stray)
    (drops / "B_102020.zip").unlink()
    archive(drops, "C_112020.zip", "2020,11,13,4,1")
    refresh_lake(spark, str(drops), root)
    assert catalog.register_noted(spark, "noted_lake", root, schemas, "l_") == {"l_silver": [("2020", "11")]}
    assert shown() == [("11", "13", 4), ("9", "11", 1), (None, "11", 3)]
    rows = manifest.read_noted(spark, root, "silver", SILVER_SCHEMA).collect()
    assert sorted((r.v1013 or "", r.idade) for r in rows) == [("", 3), ("11", 4), ("9", 1)]

    monkeypatch.setattr(manifest, "discover_periods", listing)
    assert manifest.repair_notes(spark, root, "silver") == ([("2020", "12")], [])
    assert manifest.repair_notes(spark, root, "silver") == ([], [])


@pytest.mark.parametrize("by", [["part"], ["part", "a"]])
@pytest.mark.parametrize("keys", [["a", "b"], ["a", "part", "b"], ["b", "part"]])
def test_duplicates_of_counts_equal_those_of_rows(spark, keys, by):
    # 64-bit hashes leave NULLs out, so (1, NULL) and (NULL, 1) share one.
    rows = [(a, b, p) for a in (None, 1, 2, 3) for b in (None, 1, 5) for p in ("x", "y", None) for _ in range((a or 2) % 3)]
    df = spark.createDataFrame(rows + [(None, 1, "z"), (1, None, "w"), (9, 9, "z")], "a int, b int, part string")
    counts = quality.key_counts(df, keys, by)
    assert quality.duplicates_of_counts(counts, keys, by).collect() == quality.check_duplicates(df, keys).collect()
    none = quality.key_counts(df.where("a > 100"), keys, by)
    assert quality.duplicates_of_counts(none, keys, by).collect() == quality.check_duplicates(df.where("a > 100"), keys).collect()


def test_keys_are_compared_only_where_a_hash_is_repeated(spark):
    df = spark.createDataFrame([(n, n % 7, str(n % 3)) for n in range(50)], "a int, b int, part string")
    plan = quality.duplicates_of_counts(quality.key_counts(df, ["a", "b"], ["a"]), ["a", "b"], ["a"])
    assert "Join" not in plan._jdf.queryExecution().optimizedPlan().toString()
    crossing = quality.duplicates_of_counts(quality.key_counts(df, ["a", "b"], ["part"]), ["a", "b"], ["part"])
    assert "LeftSemi" in crossing._jdf.queryExecution().optimizedPlan().toString()


def test_a_lake_counts_repeats_from_the_periods_that_changed(spark, tmp_path):
    drops, root = tmp_path / "drops", str(tmp_path / "lake")
    archive(drops, "A_092020.zip", "2020,9,11,1,1", "2020,9,11,2,1")
    archive(drops, "B_102020.zip", "2020,10,11,1,1", "2020,10,11,3,1")
    refresh_lake(spark, str(drops), root)  # not counted yet
    assert spark.read.parquet(f"{root}/quality").where("check_name = 'no_duplicates'").isEmpty()
    archive(drops, "C_112020.zip", "2020,11,11,1,1", "2020,11,11,3,2", "2020,11,11,3,3")
    refresh_lake(spark, str(drops), root, unique=KEYS)
    first, actual = last_duplicates(spark, root)
    assert actual == "4 duplicates"  # 7 rows of 3 keys
    counts = tmp_path / "lake/key-counts-uf-a002"
    kept = stamps(counts / "ano=2020/v1013=9")

    archive(drops, "B_102020.zip", "2020,10,11,7,1", "2020,10,11,8,1", "2020,10,11,9,12")  # corrected
    refresh_lake(spark, str(drops), root, unique=KEYS)
    second, actual = last_duplicates(spark, root, {first})  # 8 rows of 6 keys
    assert actual == "2 duplicates" and kept and stamps(counts / "ano=2020/v1013=9") == kept

    (drops / "C_112020.zip").unlink()
    refresh_lake(spark, str(drops), root)  # changed without being counted
    archive(drops, "D_112020.zip", "2020,11,11,1,1")
    refresh_lake(spark, str(drops), root, unique=KEYS)
    third, actual = last_duplicates(spark, root, {first, second})
    assert actual == "1 duplicates"
    (drops / "D_112020.zip").unlink()
    refresh_lake(spark, str(drops), root, unique=KEYS)
    _, actual = last_duplicates(spark, root, {first, second, third})
    assert actual == "0 duplicates" and not (counts / "ano=2020/v1013=11").exists()
    silver = read_silver(spark, f"{root}/silver", SILVER_SCHEMA)
    assert quality.check_duplicates(silver, KEYS).first().actual == actual


def test_a_lake_from_before_the_notes_is_noted_from_its_ledger(spark, tmp_path):
    drops, root = tmp_path / "drops", str(tmp_path / "lake")
    archive(drops, "A_092020.zip", "2020,9,11,1,1", "2020,9,11,1,2")
    refresh_lake(spark, str(drops), root)
    shutil.rmtree(f"{root}/period-notes")
    shutil.rmtree(f"{root}/gold-archives")
    refresh_lake(spark, str(drops), root, unique=KEYS)
    assert last_duplicates(spark, root)[1] == "1 duplicates" and noted(spark, root) == [("2020", "9")]


def test_only_noted_periods_are_shown(spark, tmp_path):
    root = str(tmp_path)
    frame = spark.createDataFrame([("2020", m, "11") for m in ("9", "10")], "ano string, v1013 string, uf string")
    rows = build_silver(frame)
    write_silver(rows, f"{root}/silver")
    assert manifest.read_noted(spark, root, "silver", SILVER_SCHEMA).isEmpty()
    manifest.note_periods(spark, root, {"silver": [("2020", "9")]})
    assert [r.v1013 for r in manifest.read_noted(spark, root, "silver", SILVER_SCHEMA).collect()] == ["9"]


def test_hashes_are_shuffled_once(spark, tmp_path):
    df = spark.createDataFrame([(n % 5, n % 7, str(n % 3)) for n in range(99)], "a int, b int, part string")
    counts = quality.key_counts(df, ["a", "b"], ["part"], rebalance=True)
    write_table(counts, str(tmp_path / "counts"))
    found = quality.duplicates_of_counts(spark.read.schema(counts.schema).parquet(str(tmp_path / "counts")), ["a", "b"], ["part"])
    assert found.collect() == quality.check_duplicates(df, ["a", "b"]).collect()
    assert "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString()
