import json
import os

import pytest

from regista.operators.project import clean_register
from regista.sources import generations
from regista.sources.landing import PARTITION
from regista.streaming.landing import follow_landing, landing_stream, refresh_landing


class Landing:
    def __init__(self, spark, folder):
        self.spark, self.path = spark, str(folder / "landing")
        self.target, self.progress = str(folder / "clean"), str(folder / "progress")

    def land(self, date, page, *records, at=None):
        folder = f"{self.path}/{PARTITION}={date}"
        os.makedirs(folder, exist_ok=True)
        path = f"{folder}/{page:08d}.json"
        with open(path, "w", encoding="utf-8") as out:
            json.dump([{"registre": r, "capacitat": c, "comarca": "Osona"} for r, c in records], out)
        if at:
            os.utime(path, (at, at))

    def rows(self):
        found = generations.read(self.spark, self.target, key=PARTITION)
        return sorted(tuple(r) for r in found.select(PARTITION, "registre", "capacitat").collect())

    def refresh(self):
        return refresh_landing(self.spark, self.path, self.target)

    def follow(self, progress=None):
        follow_landing(landing_stream(self.spark, self.path), self.path, self.target, progress or self.progress).awaitTermination()


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path)


def test_a_corrected_page_of_the_same_name_replaces_its_rows(landing):
    landing.land("20250801", 0, ("S1", "10"), ("S2", "5"), at=1_750_000_000)
    landing.land("20250808", 0, ("S3", "1"), at=1_750_000_000)
    assert landing.refresh() == ["20250801", "20250808"]
    assert landing.refresh() == []
    landing.land("20250801", 0, ("S1", "12"), at=1_760_000_000)
    assert landing.refresh() == ["20250801"]
    assert landing.rows() == [("20250801", "S1", "12"), ("20250808", "S3", "1")]


def test_rows_that_land_again_under_another_name_are_kept_once(landing):
    landing.land("20250801", 0, ("S1", "10"))
    landing.refresh()
    landing.land("20250801", 1000, ("S1", "10"), ("S2", "5"))
    assert landing.refresh() == ["20250801"]
    assert landing.rows() == [("20250801", "S1", "10"), ("20250801", "S2", "5")]


def test_a_date_that_is_gone_loses_its_partition(landing):
    landing.land("20250801", 0, ("S1", "10"))
    landing.land("20250808", 0, ("S2", "5"))
    landing.refresh()
    os.remove(f"{landing.path}/{PARTITION}=20250801/00000000.json")
    assert landing.refresh() == ["20250801"]
    assert landing.rows() == [("20250808", "S2", "5")]


def test_a_killed_run_changes_nothing_and_is_run_again(spark, landing, monkeypatch):
    landing.land("20250801", 0, ("S1", "10"))
    landing.refresh()
    landing.land("20250801", 1000, ("S2", "5"))
    monkeypatch.setattr(generations, "commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        landing.refresh()
    monkeypatch.undo()
    assert landing.rows() == [("20250801", "S1", "10")]
    assert landing.refresh() == ["20250801"]
    assert landing.rows() == [("20250801", "S1", "10"), ("20250801", "S2", "5")]


def test_a_broken_page_leaves_the_old_partition(landing):
    landing.land("20250801", 0, ("S1", "10"))
    landing.refresh()
    with open(f"{landing.path}/{PARTITION}=20250801/00001000.json", "w", encoding="utf-8") as out:
        out.write('[{"registre": "S2", ')
    with pytest.raises(Exception):
        landing.refresh()
    assert landing.rows() == [("20250801", "S1", "10")]


def test_a_stream_follows_and_a_replayed_batch_gives_the_same_table(spark, landing, tmp_path):
    landing.land("20250801", 0, ("S1", "10"), at=1_750_000_000)
    landing.follow()
    landing.land("20250808", 0, ("S2", "5"), at=1_750_000_100)
    landing.land("20250801", 0, ("S1", "11"), at=1_750_000_200)
    landing.follow()
    expected = [("20250801", "S1", "11"), ("20250808", "S2", "5")]
    assert landing.rows() == expected
    number, record = generations.current(spark, landing.target)
    (stream_id, last), = record["epochs"].items()
    assert last == 1
    # killed after the commit, before the stream wrote its own: the batch is replayed
    assert refresh_landing(spark, landing.path, landing.target, clean_register, epoch=(stream_id, 1)) == []
    assert generations.current(spark, landing.target)[0] == number
    landing.follow(str(tmp_path / "new progress"))           # the checkpoint is lost: batch 0 comes again
    assert landing.rows() == expected
    landing.land("20250815", 0, ("S4", "9"))
    landing.follow(str(tmp_path / "new progress"))
    assert landing.rows() == [*expected, ("20250815", "S4", "9")]


def test_an_empty_landing_folder(spark, landing):
    os.makedirs(landing.path)
    assert landing.refresh() == []
    assert generations.current(spark, landing.target) == (0, {})


def test_pages_landed_again_take_no_page_name_of_the_first_date(spark, tmp_path):
    from regista.workload.registry import Tables
    from regista.workload.storage import incremental_landing

    # pages 00000000 and 90000000 of one date, and a later date for the second wave
    spark.createDataFrame(
        [(1, 7, "F", "1992-01-02", "1-URGENT"), (90_000_001, 8, "O", "1992-03-04", "2-HIGH"),
         (2, 9, "O", "1993-05-06", "3-MEDIUM")],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate string, o_orderpriority string",
    ).selectExpr("*", "CAST(o_orderdate AS DATE) AS day").drop("o_orderdate").withColumnRenamed("day", "o_orderdate") \
        .write.parquet(str(tmp_path / "orders.parquet"))
    landed = incremental_landing(Tables(spark, str(tmp_path)))
    assert sorted(r.registre for r in landed.select("registre").collect()) == ["S00000001", "S00000002", "S90000001"]
