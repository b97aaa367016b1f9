import json

import pytest
from fixtures import rows
from pyspark.sql import functions as F

from tallymart.operators.staging import stage_events
from tallymart.sources.files import read_events
from tallymart.streaming import events as stream


def write(folder, name, items):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(e) + "\n" for e in items))


def event(i, time, kind="page_view"):
    return {
        "event_id": f"e{i}",
        "customer_id": "c1",
        "product_id": "p1",
        "event_type": kind,
        "event_time": time,
        "page": "/",
        "session_id": "s",
    }


@pytest.fixture
def load(spark, tmp_path):
    """Runs the stream over the files so far; gives events and counts with their batch twins."""

    def run():
        raw = stream.read_event_stream(spark, str(tmp_path / "in"))
        out, counts = str(tmp_path / "out"), str(tmp_path / "counts")
        stream.load_available(raw, out, str(tmp_path / "state"), counts)
        batch = stream.first_per_event(stage_events(read_events(spark, str(tmp_path / "in"))))
        got = stream.read_events_table(spark, raw, out)
        assert rows(got) == rows(batch)
        found = stream.read_daily_counts(spark, counts)
        assert rows(found) == rows(stream.daily_counts(batch).select(*found.columns))
        return got.count()

    return run


def test_new_files_are_added_and_repeats_dropped(tmp_path, load):
    first = [event(i, f"2024-01-01 0{i}:00:00") for i in range(5)]
    write(tmp_path / "in", "a.jsonl", first + first[:2])
    assert load() == 5
    # a second start takes the new file alone; its copy of an old event is dropped
    write(tmp_path / "in", "b.jsonl", [first[4], event(9, "2024-01-01 09:00:00")])
    assert load() == 6
    assert load() == 6


def test_late_events_are_kept(tmp_path, load):
    write(tmp_path / "in", "a.jsonl", [event(1, "2024-01-10 00:00:00")])
    load()
    write(tmp_path / "in", "b.jsonl", [event(2, "2024-01-05 10:00:00"), event(3, "2024-01-11 10:00:00")])
    assert load() == 3


def test_days_do_not_depend_on_the_time_zone(spark, tmp_path, load):
    held = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        items = [event(1, "2024-01-02 01:00:00"), event(2, "2024-01-02 23:00:00"), event(3, "2024-03-10 02:30:00")]
        write(tmp_path / "in", "a.jsonl", items)
        assert load() == 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", held)


def test_one_row_per_event_id_and_day(spark, tmp_path):
    """Within a batch the least row stays, across batches the stored one; another day is another event."""
    folder, out, counts, state = (str(tmp_path / n) for n in ("in", "out", "counts", "state"))

    def run():
        raw = stream.read_event_stream(spark, folder)
        stream.load_available(raw, out, state, counts)
        got = stream.read_events_table(spark, raw, out)
        found = stream.read_daily_counts(spark, counts)
        assert rows(found) == rows(stream.daily_counts(got).select(*found.columns))
        return {(r["event_id"], str(r["event_time"]), r["event_type"]) for r in got.collect()}

    late, early = event(1, "2024-01-01 10:00:00", "purchase"), event(1, "2024-01-01 09:00:00", "purchase")
    write(tmp_path / "in", "a.jsonl", [late, early, event(1, "2024-01-01 09:00:00", "page_view")])
    first = {("e1", "2024-01-01 09:00:00", "page_view")}
    assert run() == first
    write(tmp_path / "in", "b.jsonl", [event(1, "2024-01-01 01:00:00", "purchase"), event(1, "2024-01-02 01:00:00")])
    assert run() == first | {("e1", "2024-01-02 01:00:00", "page_view")}


def test_a_batch_run_again_changes_nothing(spark, tmp_path):
    out, counts = str(tmp_path / "out"), str(tmp_path / "counts")
    write(tmp_path / "in", "a.jsonl", [event(i, f"2024-01-0{1 + i % 3} 10:00:00") for i in range(9)])
    staged = stage_events(read_events(spark, str(tmp_path / "in")))
    spark.createDataFrame([], staged.withColumn("batch", F.lit(0).cast("long")).schema).write.parquet(out)
    for number in (0, 1, 0, 1):
        stream.load_batch(staged, number, out, counts)
        stored = stream.stored_events(spark, staged.schema, out)
        assert stored.count() == 9 and stored.select("batch").distinct().count() == 1
        assert stream.read_daily_counts(spark, counts).agg(F.sum("events")).first()[0] == 9


def test_events_without_a_day(spark, tmp_path, load):
    timeless = {k: v for k, v in event(1, "").items() if k != "event_time"}
    write(tmp_path / "in", "a.jsonl", [timeless, event(1, "2024-01-01 00:00:00")])
    assert load() == 2
    write(tmp_path / "in", "b.jsonl", [timeless, event(2, "2024-01-01 00:00:00")])
    assert load() == 3


def test_only_touched_days_are_read(spark, tmp_path):
    out = str(tmp_path / "out")
    write(tmp_path / "in", "a.jsonl", [event(i, f"2024-01-{1 + i:02d} 10:00:00") for i in range(20)])
    staged = stage_events(read_events(spark, str(tmp_path / "in")))
    staged.withColumn("batch", F.lit(0).cast("long")).write.partitionBy("event_date", "batch").parquet(out)
    batch = staged.where("event_id = 'e4'")
    found = stream.new_events(batch, stream.stored_events(spark, staged.schema, out), 1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    (scan,) = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert "PartitionFilters: [" in scan and "event_date" in scan.split("PartitionFilters")[1]
    assert "customer_id" not in scan.split("ReadSchema")[1]
    assert found.count() == 0
    files = found._jdf.queryExecution().executedPlan().toString()
    assert "2024-01-05" in files or "19727" in files  # the one day of the batch
