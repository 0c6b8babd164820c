import os
import threading

import pytest
from pyspark.sql import functions as F

from regista.sources import generations


def failing(df, message="killed"):
    """The same rows, but the last partition's task fails."""
    return df.withColumn("v", F.when(F.col("v") < 0, F.raise_error(F.lit(message)).cast("int")).otherwise(F.col("v")))


def table(spark, rows):
    return spark.createDataFrame(rows, "v int, day string")


def test_a_failed_write_leaves_the_old_table(spark, tmp_path, rows):
    base = str(tmp_path / "t")
    generations.replace(table(spark, [(1, "a"), (2, "b")]), base)
    broken = failing(table(spark, [(i, "a") for i in range(50)] + [(-1, "z")]).repartition(4))
    with pytest.raises(Exception, match="killed"):
        generations.replace(broken, base)
    assert rows(generations.read(spark, base)) == [(1, "a"), (2, "b")]
    assert len(os.listdir(f"{base}/data")) == 2          # the unfinished generation is there, but no record names it
    generations.replace(table(spark, [(3, "c")]), base)
    assert rows(generations.read(spark, base)) == [(3, "c")]


def test_a_failed_partition_leaves_all_partitions(spark, tmp_path, rows):
    base = str(tmp_path / "t")
    generations.write_partitions(table(spark, [(1, "a"), (2, "b"), (3, "007")]), base, "day")
    with pytest.raises(Exception, match="killed"):
        generations.write_partitions(failing(table(spark, [(9, "a"), (-1, "b")]).repartition(2)), base, "day")
    assert rows(generations.read(spark, base)) == [(1, "a"), (2, "b"), (3, "007")]
    generations.write_partitions(table(spark, [(9, "b"), (8, "x y/z=é")]), base, "day")
    assert rows(generations.read(spark, base, key="day")) == [(1, "a"), (3, "007"), (8, "x y/z=é"), (9, "b")]
    generations.write_partitions(table(spark, []), base, "day", gone=("b", "x y/z=é"))
    assert rows(generations.read(spark, base)) == [(1, "a"), (3, "007")]


def test_a_killed_commit_changes_nothing(spark, tmp_path, rows, monkeypatch):
    base = str(tmp_path / "t")
    generations.replace(table(spark, [(1, "a")]), base)

    def killed(record):
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        generations.commit(spark, base, killed)
    assert generations.current(spark, base)[0] == 1
    assert rows(generations.read(spark, base)) == [(1, "a")]


def test_a_table_may_be_its_own_source(spark, tmp_path, rows):
    base = str(tmp_path / "t")
    generations.replace(table(spark, [(1, "a")]), base)
    generations.replace(generations.read(spark, base).withColumn("v", F.col("v") + 1), base)
    assert rows(generations.read(spark, base)) == [(2, "a")]


def test_concurrent_commits_are_all_kept(spark, tmp_path):
    base = str(tmp_path / "t")

    def add(name):
        generations.commit(spark, base, lambda record: record | {"seen": record.get("seen", {}) | {name: name}})

    threads = [threading.Thread(target=add, args=(f"n{i}",)) for i in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    number, record = generations.current(spark, base)
    assert number == 6 and len(record["seen"]) == 6


def test_old_generations_go_and_readers_keep_theirs(spark, tmp_path, rows):
    base = str(tmp_path / "t")
    for i in range(6):
        generations.replace(table(spark, [(i, "a")]), base)
        if i == 3:
            begun = generations.read(spark, base)
    assert rows(begun) == [(3, "a")]
    assert len(os.listdir(f"{base}/data")) == generations.KEPT
    assert rows(generations.read(spark, base)) == [(5, "a")]


def test_a_partition_several_commits_old_stays(spark, tmp_path, rows):
    base = str(tmp_path / "t")
    generations.write_partitions(table(spark, [(0, "old")]), base, "day")
    for i in range(6):
        generations.write_partitions(table(spark, [(i, "new")]), base, "day")
    assert rows(generations.read(spark, base)) == [(0, "old"), (5, "new")]


def test_tables_of_one_run_change_together(spark, tmp_path, rows):
    base = str(tmp_path / "serving")

    def publish(v, broken=False):
        first = table(spark, [(v, "a")])
        second = failing(table(spark, [(-1 if broken else v, "b")]))
        generations.publish_together({"first": first, "second": second}, base, lambda name, df, path: df.write.json(path))

    def read(version):
        return [r["v"] for name in ("first", "second") for r in spark.read.json(version.path(name)).collect()]

    publish(1)
    begun = generations.Version(spark, base)
    with pytest.raises(Exception, match="killed"):
        publish(2, broken=True)
    assert read(generations.Version(spark, base)) == [1, 1]
    publish(3)
    assert read(begun) == [1, 1]
    assert read(generations.Version(spark, base)) == [3, 3]
    with pytest.raises(KeyError):
        generations.Version(spark, base).path("third")


def test_empty_and_plain_tables(spark, tmp_path, rows):
    base = str(tmp_path / "t")
    generations.write_partitions(table(spark, []), base, "day")
    assert generations.read(spark, base, table(spark, []).schema, "day").collect() == []
    table(spark, [(1, "a")]).write.parquet(f"{tmp_path}/plain")
    assert rows(generations.read(spark, f"{tmp_path}/plain")) == [(1, "a")]
