import json

import pytest

from regista import schemas, workspace
from regista.sources import catalogs, tables
from regista.sources.landing import PARTITION
from regista.streaming.landing import append_new_landing, landing_stream


def test_partition_overwrite_touches_one_partition(spark, tmp_path, rows):
    base = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "20250101"), (2, "20250108"), (3, "007")], "v int, downloaded_date string")
    tables.write_partition(df, base, "downloaded_date")
    again = spark.createDataFrame([(9,)], "v int")
    tables.write_partition(again, base, "downloaded_date", "20250108")
    tables.write_partition(again, base, "downloaded_date", "20250108")
    assert rows(tables.read_partition(spark, base, "downloaded_date", "20250108")) == [(9, "20250108")]
    assert rows(tables.read_partition(spark, base, "downloaded_date", "20250101")) == [(1, "20250101")]
    assert rows(tables.read_partition(spark, base, "downloaded_date", "007")) == [(3, "007")]


def test_partition_read_is_pruned(spark, tmp_path, capsys):
    base = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "20250101"), (2, "20250108")], "v int, downloaded_date string")
    tables.write_partition(df, base, "downloaded_date")
    tables.read_partition(spark, base, "downloaded_date", "20250108").explain()
    plan = capsys.readouterr().out
    assert "(downloaded_date" in plan.split("PartitionFilters: ")[1].split("]")[0]


def test_publish_serving_csv_and_audit(spark, tmp_path, rows):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 2)], "k string, v int")
    tables.write_parquet_snappy(df, f"{tmp_path}/staging")
    tables.publish_mart(spark, f"{tmp_path}/staging", f"{tmp_path}/marts")
    assert rows(tables.read_table(spark, f"{tmp_path}/marts")) == rows(df)
    tables.write_serving_json({"t": df}, f"{tmp_path}/serving")
    assert rows(tables.read_serving_json(spark, f"{tmp_path}/serving", "t", df.schema)) == rows(df)
    tables.write_csv_distinct(df, "k", f"{tmp_path}/csv")
    assert rows(spark.read.option("header", True).csv(f"{tmp_path}/csv")) == [("a",), ("b",)]
    for dataset in ("marts", "again"):
        tables.append_audit(tables.read_table(spark, f"{tmp_path}/marts"), dataset, f"{tmp_path}/audit")
    audit = spark.read.parquet(f"{tmp_path}/audit")
    assert rows(audit, "dataset", "row_count", "columns") == [("again", 3, "k,v"), ("marts", 3, "k,v")]
    assert audit.where("processed_at is null").count() == 0


def test_catalog_sources(spark, tmp_path, rows):
    with pytest.raises(ValueError):
        catalogs.literal_catalog(spark, {}, "id", "text")
    built = catalogs.literal_catalog(spark, {"A-1": "one"}, "id", "text")
    assert built.columns == ["id", "text", "created_at"]
    odd = spark.createDataFrame([(1, 2)], "x int, y int")
    assert catalogs.catalog_from_records(odd, created_at="t").columns == ["x", "y", "created_at"]
    for i, page in enumerate(([{"codi": "1"}], [{"codi": "2"}, {"codi": "3"}])):
        (tmp_path / f"{i}.json").write_text(json.dumps(page))
    pages = catalogs.read_record_pages(
        spark, [f"{tmp_path}/0.json", f"{tmp_path}/1.json"], schemas.MUNICIPALS
    )
    assert rows(pages, "codi") == [("1",), ("2",), ("3",)]


def test_snapshots(spark, tmp_path, rows):
    for stamp, name in (("20250101_000000", "old"), ("20250809_152821", "new")):
        df = spark.createDataFrame([("1", name)], "codi string, nom string")
        catalogs.write_snapshot(df, str(tmp_path / "m"), stamp)
    schema = df.schema
    assert rows(catalogs.read_latest_snapshot(spark, str(tmp_path / "m"), schema)) == [("1", "new")]
    assert catalogs.read_all_snapshots(spark, str(tmp_path / "m"), schema).count() == 2


def test_broadcast_needs_a_measured_size(spark, capsys):
    small = workspace.settle(spark.range(10))
    assert workspace.measured_bytes(small) == sum(len('{"id":%d}' % i) for i in range(10))
    workspace.broadcast_if_small(small).explain("extended")
    assert "ResolvedHint" in capsys.readouterr().out
    workspace.broadcast_if_small(small, max_bytes=10).explain("extended")
    assert "ResolvedHint" not in capsys.readouterr().out


def test_settle_cuts_lineage(spark, capsys):
    settled = workspace.settle(spark.range(100).groupBy().count())
    settled.explain()
    plan = capsys.readouterr().out
    assert "FileScan" in plan and "Aggregate" not in plan
    assert settled.first()[0] == 100


def test_stream_reads_each_page_once(spark, tmp_path, rows):
    landing, target, progress = (str(tmp_path / n) for n in ("landing", "clean", "progress"))

    def land(date, page, *records):
        folder = tmp_path / "landing" / f"downloaded_date={date}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{page}.json").write_text(json.dumps(list(records)))

    def run():
        append_new_landing(landing_stream(spark, landing), target, progress).awaitTermination()
        found = spark.read.option("basePath", target).parquet(target)
        return rows(found.select("registre", "comarca", "qualificacio",
                                 found[PARTITION].cast("string")))

    first = {"registre": "S1", "comarca": "Val d'Aran", "qualificacio": "null"}
    land("20250801", "00000000", first)
    land("20250801", "notes", {"registre": "S9"})
    expected = [("S1", "Aran", None, "20250801")]
    assert run() == expected
    assert run() == expected
    land("20250808", "00000000", {"registre": "S2", "comarca": "Osona", "qualificacio": "q"})
    assert run() == [*expected, ("S2", "Osona", "q", "20250808")]


def test_an_empty_partition_replaces_the_old_rows(spark, tmp_path):
    base = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "n int, day string")
    tables.write_partition(rows, base, "day")
    tables.write_partition(rows.limit(0).drop("day"), base, "day", "a")
    left = tables.read_table(spark, base, rows.schema, "day")
    assert [tuple(r) for r in left.collect()] == [(2, "b")]
    tables.write_partition(rows.limit(1).drop("day"), base, "day", "a")
    assert tables.read_table(spark, base, rows.schema, "day").count() == 2


def test_serving_files_are_in_serving_order(spark, tmp_path):
    import glob

    many = spark.range(5000).selectExpr("CAST(id * 7919 % 5000 AS STRING) AS municipal_id", "CAST(id % 40 AS INT) AS year", "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_serving_json({"municipal_coverage": many}, f"{tmp_path}/serving")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = sorted(glob.glob(f"{tmp_path}/serving/data/*/municipal_coverage/part-*.json"))
    found = [json.loads(line) for f in files for line in open(f, encoding="utf-8")]
    keys = [(r["municipal_id"], r["year"]) for r in found]
    assert len(files) >= 3 and len(keys) == 5000
    assert keys == sorted(keys)


def test_a_sink_is_counted_while_written(spark, tmp_path, rows):
    df = spark.range(1000).repartition(5)
    assert tables.write_audited(df, "n", f"{tmp_path}/audit", lambda d, seen: tables.replace_table(d, f"{tmp_path}/t", seen)) == 1000
    assert tables.write_audited(df.limit(0), "none", f"{tmp_path}/audit", lambda d, seen: tables.replace_table(d, f"{tmp_path}/t", seen)) == 0
    assert rows(spark.read.parquet(f"{tmp_path}/audit"), "dataset", "row_count", "columns") == [("n", 1000, "id"), ("none", 0, "id")]


def test_a_failed_write_is_not_recorded(spark, tmp_path):
    def failing(df, seen):
        raise OSError("disk full")

    with pytest.raises(OSError):
        tables.write_audited(spark.range(3), "n", f"{tmp_path}/audit", failing)
    assert not (tmp_path / "audit").exists()


def test_a_partitioned_sink_is_counted_by_the_tasks_that_write(spark, tmp_path):
    df = spark.range(500).selectExpr("id", "CAST(id % 7 AS STRING) AS day")
    seen = tables.Observation()
    tables.write_partition(df, f"{tmp_path}/t", "day", seen=seen)
    assert seen.get == {"row_count": 500}
    assert tables.read_table(spark, f"{tmp_path}/t").count() == 500
