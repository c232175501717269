import os

import pytest

from conftest import rows
from lodestar.sources import ledger
from lodestar.sources.ledger import current_rows, ingest_ledger, read_ledger


def put(spark, folder, name, ids, text="x"):
    """One Parquet file of a given name."""
    import pandas

    pandas.DataFrame({"id": list(ids), "a": text}).to_parquet(f"{folder}/{name}.parquet", index=False)


def dated(folder, name, seconds):
    path = f"{folder}/{name}.parquet"
    at = os.path.getmtime(path) + seconds
    os.utime(path, (at, at))


@pytest.fixture
def places(tmp_path):
    (tmp_path / "source").mkdir()
    return [str(tmp_path / p) for p in ("source", "bronze", "checkpoint")]


def test_new_files_once(spark, places):
    source, bronze, checkpoint = places
    assert ingest_ledger(spark, *places).count() == 0
    put(spark, source, "first [batch] 100%", range(600))
    assert ingest_ledger(spark, *places).count() == 600
    put(spark, source, "second", range(600, 1000))
    for _ in range(2):
        got = ingest_ledger(spark, *places)
        assert got.count() == 1000 and got.select("id").distinct().count() == 1000
    assert rows(got.select("_batch_id").distinct()) == [(0,), (1,)]
    assert read_ledger(spark, checkpoint).where("ingested AND checksum IS NOT NULL").count() == 2


def test_a_file_written_again_is_read_again(spark, places):
    source, bronze, checkpoint = places
    put(spark, source, "a b%", range(10))
    put(spark, source, "kept", range(100, 105))
    ingest_ledger(spark, *places)
    put(spark, source, "a b%", range(5, 12), "y")
    dated(source, "a b%", 5)
    got = ingest_ledger(spark, *places)
    assert got.count() == 22
    expected = [(i, "y") for i in range(5, 12)] + [(i, "x") for i in range(100, 105)]
    assert rows(current_rows(spark, got, checkpoint), "id", "a") == expected
    # the same content under a new time is noted, not read
    dated(source, "kept", 60)
    dated(source, "a b%", 60)
    assert ingest_ledger(spark, *places).count() == 22
    entries = read_ledger(spark, checkpoint)
    assert entries.count() == 5 and entries.where("NOT ingested").count() == 2
    assert rows(current_rows(spark, ingest_ledger(spark, *places), checkpoint), "id", "a") == expected


def test_without_checksums_length_and_time_decide(spark, places):
    source, bronze, checkpoint = places
    put(spark, source, "one", range(3))
    ingest_ledger(spark, *places, checksum_bytes=0)
    dated(source, "one", 9)
    got = ingest_ledger(spark, *places, checksum_bytes=0)
    assert got.count() == 6 and current_rows(spark, got, checkpoint).count() == 3


def test_batches_follow_the_age_of_files(spark, places):
    source = places[0]
    for i in range(5):
        put(spark, source, f"f{i}", [i])
        dated(source, f"f{i}", -100 * i)
    got = ingest_ledger(spark, *places, max_files=2)
    assert rows(got, "_batch_id", "id") == [(0, 3), (0, 4), (1, 1), (1, 2), (2, 0)]


@pytest.mark.parametrize("lost", ["rename_folder", "_move"])
def test_a_run_that_dies_is_finished_by_the_next(spark, places, monkeypatch, lost):
    source, bronze, checkpoint = places
    put(spark, source, "one", range(7))

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(ledger, lost, dies)
        with pytest.raises(RuntimeError):
            ingest_ledger(spark, *places)
    put(spark, source, "two", range(7, 9))
    for _ in range(2):
        assert rows(ingest_ledger(spark, *places), "id") == [(i,) for i in range(9)]


def test_ledger_is_compacted(spark, places, monkeypatch):
    source, _, checkpoint = places
    monkeypatch.setattr(ledger, "COMPACT_AFTER", 2)
    for i in range(5):
        put(spark, source, f"f{i}", [i])
        assert ingest_ledger(spark, *places).count() == i + 1
    assert len([f for f in os.listdir(f"{checkpoint}/ledger") if not f.startswith(".")]) <= 3
    assert ingest_ledger(spark, *places).count() == 5 and read_ledger(spark, checkpoint).count() == 5


def test_a_million_known_names_stay_on_the_executors(spark, places):
    """The names of a long ledger are joined, and the driver's Python gets only new ones."""
    source, bronze, checkpoint = places
    put(spark, source, "new", range(4))
    known = spark.range(1_000_000).selectExpr(
        f"concat('file:{source}/', id, '.parquet') path", "path file", "id length", "timestamp_micros(id) time",
        "cast(NULL AS string) checksum", "0L batch", "true ingested",
    )
    known.write.parquet(f"{checkpoint}/ledger/batch-0")
    listing = ledger.listed_files(spark, source)
    assert ledger.unseen(listing, read_ledger(spark, checkpoint)).count() == 1
    assert ingest_ledger(spark, *places).count() == 4
    assert ledger.unseen(listing, read_ledger(spark, checkpoint)).isEmpty()
