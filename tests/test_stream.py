import datetime as dt

from floorlens.plans.mart import build_mart
from floorlens.sources import schemas, sinks
from floorlens.streaming import ingest
from tests.test_tables import raw

D = dt.date


def test_stream_replay_equals_batch(spark, tmp_path):
    base = str(tmp_path)
    later = dt.datetime(2024, 3, 1)
    one = raw(spark, [(D(2024, 1, i), h, "m", u, i * u - 9, 100) for i in range(1, 20) for h in "AB" for u in (1, 2)])
    two = raw(spark, [(D(2024, 1, 3), "A", "m", 1, 500, 100), (D(2024, 2, 1), "A", "m", 1, 7, 100)], ts=later)
    args = (f"{base}/raw", f"{base}/state", f"{base}/mart")
    for part in (one, two, two):
        part.write.mode("append").parquet(f"{base}/in")
        ingest.ingest(ingest.read_stream(spark, f"{base}/in", files_per_trigger=3), *args).awaitTermination()
    stored = spark.read.schema(schemas.RAW).parquet(args[0])
    assert stored.count() == 19 * 4 + 1
    want = build_mart(stored)
    got = spark.read.schema(schemas.MART).parquet(args[2]).select(want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_intervals_of_a_batch_with_a_late_day(spark):
    rows = raw(spark, [(D(2024, 1, 1), "A", "m", 1, 1, 1), (D(2024, 1, 20), "A", "m", 1, 1, 1), (D(2021, 5, 1), "A", "m", 1, 1, 1)])
    assert ingest.affected_intervals(rows) == [(D(2021, 5, 1), D(2021, 6, 1)), (D(2024, 1, 1), D(2024, 2, 20))]
    assert ingest.affected_intervals(rows.where("false")) == []


def test_refresh_keeps_or_replaces_stale_units(spark, tmp_path):
    base, d = str(tmp_path), D(2024, 1, 5)
    sinks.replace_slice(raw(spark, [(d, "A", "m", 1, 1, 1), (d, "A", "m", 2, 1, 1)]), f"{base}/raw")
    run = lambda **k: ingest.refresh_mart(spark, f"{base}/raw", f"{base}/mart", d, d, **k)
    assert run() == sinks.UpsertResult(2, 0)
    sinks.replace_slice(raw(spark, [(d, "A", "m", 1, 4, 1)]), f"{base}/raw")
    assert run() == sinks.UpsertResult(0, 1)
    units = lambda: sorted(r[0] for r in spark.read.parquet(f"{base}/mart").select("machine_number").collect())
    assert units() == [1, 2]
    run(replace=True)
    assert units() == [1]


def test_repeats_are_dropped_within_the_watermark(spark, tmp_path):
    rows = raw(spark, [(D(2024, 1, 1), "A", "m", 1, 1, 1)])
    rows.unionByName(rows).write.parquet(str(tmp_path / "in"))
    stream = ingest.drop_repeats(ingest.read_stream(spark, str(tmp_path / "in")), ["id"])
    q = stream.writeStream.format("memory").queryName("repeats").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("repeats").count() == 1


def test_repeats_across_batches_and_a_restart_are_dropped_and_forgotten(spark, tmp_path):
    """The state holds keys of the delay only: older ones are removed as the watermark passes them."""
    base = str(tmp_path)
    days = [raw(spark, [(D(2024, 1, i), "A", "m", u, i, 1) for u in range(5)], ts=dt.datetime(2024, 1, i, 12)) for i in range(1, 21)]

    def run():
        q = ingest.ingest(ingest.read_stream(spark, f"{base}/in", files_per_trigger=1), f"{base}/raw", f"{base}/state", repeat_delay="2 days", ledger=f"{base}/ledger")
        q.awaitTermination()
        return q

    for day in days:
        day.coalesce(1).write.mode("append").parquet(f"{base}/in")
    last = run()
    states = [p["stateOperators"][0] for p in last.recentProgress if p["stateOperators"]]
    assert sum(x["numRowsRemoved"] for x in states) > 0 and states[-1]["numRowsTotal"] < 100
    for day in (days[19], days[18], days[0]):  # in the state, in the state, long before the watermark
        day.coalesce(1).write.mode("append").parquet(f"{base}/in")
    run()
    ledger = spark.read.parquet(f"{base}/ledger").groupBy("date").sum("rows").collect()
    assert sorted(tuple(x) for x in ledger) == [(D(2024, 1, i), 5) for i in range(1, 21)]
    assert spark.read.schema(schemas.RAW).parquet(f"{base}/raw").count() == 100
