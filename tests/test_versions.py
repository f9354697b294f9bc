"""Tables replaced while they are read, jobs stopped at any step, and batches loaded again."""

from __future__ import annotations

import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lamina.model import RAW_SCHEMAS, Layers
from lamina.operators import bronze
from lamina.sources import (
    files,
    read_table,
    remove_old_versions,
    versions,
    write_csv,
    write_files,
    write_table,
)
from lamina.workload import feeds

FOLDER = "/root/testdata/sf0.001"


def numbered(spark, table, rows):
    """Rows that all name the table they belong to."""
    return spark.range(rows, numPartitions=2).withColumn("table", F.lit(table))


def test_a_reader_never_sees_a_half_replaced_table(spark, tmp_path):
    path = str(tmp_path / "table")
    write_table(numbered(spark, 0, 100), path)
    seen, failures, done = [], [], threading.Event()

    def read():
        while not done.is_set():
            try:
                rows = read_table(spark, path).groupBy("table").count().collect()
                seen.append([(row.table, row["count"]) for row in rows])
            except Exception as error:
                failures.append(error)
                return

    reader = threading.Thread(target=read)
    reader.start()
    for number in range(1, 7):
        assert write_table(numbered(spark, number, 100 + number), path) == 100 + number
    done.set()
    reader.join()
    assert not failures
    assert all(len(rows) == 1 and rows[0][1] == 100 + rows[0][0] for rows in seen)
    assert [rows[0][0] for rows in seen] == sorted(rows[0][0] for rows in seen)


@pytest.mark.parametrize("step", ["new_version", "write_files", "publish"])
@pytest.mark.parametrize("stop", [OSError, KeyboardInterrupt])
def test_a_job_stopped_at_any_step_leaves_the_old_table(spark, tmp_path, monkeypatch, step, stop):
    path = str(tmp_path / "table")
    write_table(numbered(spark, 1, 10), path)
    with monkeypatch.context() as patched:

        def stopped(*args, **kwargs):
            if step == "write_files":
                write_files(*args, **kwargs)
            raise stop

        patched.setattr(files, step, stopped)
        with pytest.raises(stop):
            write_table(numbered(spark, 2, 20), path)
    assert read_table(spark, path).count() == 10
    assert [version.number for version in versions(spark, path)] == [1]
    assert write_table(numbered(spark, 3, 30), path) == 30
    assert read_table(spark, path).count() == 30


def test_old_versions_stay_for_their_readers_until_they_are_removed(spark, tmp_path):
    path = str(tmp_path / "table")
    write_table(numbered(spark, 1, 10), path)
    early = read_table(spark, path)
    write_table(numbered(spark, 2, 20), path)
    assert remove_old_versions(spark, path) == 0
    assert early.count() == 10
    unfinished = Path(path) / "_versions" / "0000000001-left"
    unfinished.mkdir()
    assert remove_old_versions(spark, path, retain_seconds=-1) == 2
    assert not unfinished.exists()
    assert [version.number for version in versions(spark, path)] == [2]
    assert read_table(spark, path).count() == 20
    assert remove_old_versions(spark, path, retain_seconds=-1) == 0


def test_plain_files_become_a_table_of_versions(spark, tmp_path):
    path = str(tmp_path / "table")
    numbered(spark, 0, 5).write.parquet(path)
    assert read_table(spark, path).count() == 5
    assert remove_old_versions(spark, path) == 0
    assert write_table(read_table(spark, path).where("id < 2"), path) == 2
    assert read_table(spark, path).count() == 2


def test_two_writers_at_once_both_leave_a_whole_table(spark, tmp_path):
    path = str(tmp_path / "table")
    write_table(numbered(spark, 0, 1), path)
    writers = [
        threading.Thread(target=write_table, args=(numbered(spark, n, 10 + n), path)) for n in (1, 2)
    ]
    for writer in writers:
        writer.start()
    for writer in writers:
        writer.join()
    assert len(versions(spark, path)) == 3
    rows = read_table(spark, path).groupBy("table").count().collect()
    assert len(rows) == 1 and rows[0]["count"] == 10 + rows[0].table


def test_a_batch_loaded_again_replaces_itself_alone(spark, tmp_path):
    layers = Layers.under(str(tmp_path / "layers"))
    items = feeds.raw_order_items(spark, FOLDER)
    odd = F.col("order_item_id") % 2 == 1

    def load(batch, rows):
        raw = str(tmp_path / f"raw-{batch}-{rows.count()}")
        write_csv(rows, raw)
        return bronze.load_batch(spark, "order_items", layers, batch, raw)

    first, second = load("01", items.where(~odd)), load("2024-05-02", items.where(odd))
    untouched = {p: p.stat().st_mtime_ns for p in Path(tmp_path).rglob("loaded_batch=01/*.parquet")}
    for _ in range(2):
        assert load("2024-05-02", items.where(odd)) == second
    fewer = load("2024-05-02", items.where(odd & (F.col("unit_price") > 0)))
    loaded = bronze.read_batches(spark, "order_items", layers)
    counts = {row.batch_id: row["count"] for row in loaded.groupBy("batch_id").count().collect()}
    assert counts == {"01": first, "2024-05-02": fewer} and fewer < second
    assert {p: p.stat().st_mtime_ns for p in untouched} == untouched
    declared = [part.split()[0] for part in RAW_SCHEMAS["order_items"].split(", ")]
    assert loaded.columns[: len(declared)] == declared
    assert "loaded_batch" not in loaded.columns
