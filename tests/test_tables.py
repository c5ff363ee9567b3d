import datetime as dt

import pytest
from pyspark.sql import functions as F

from floorlens.operators import reconcile
from floorlens.sources import clean, readers, schemas, sinks

D = dt.date
T0 = dt.datetime(2024, 1, 5)


def raw(spark, rows, source="s", ts=T0):
    df = spark.createDataFrame(rows, "date date, hole string, machine string, machine_number bigint, diff bigint, game bigint")
    return clean.evolve(clean.stamp(clean.with_win(df), source, ts), schemas.RAW)


def content(spark, path):
    return sorted((r.date, r.hole, r.machine_number, r.diff) for r in spark.read.schema(schemas.RAW).parquet(path).collect())


def test_replace_slice_leaves_other_venues(spark, tmp_path):
    p = str(tmp_path / "raw")
    d = D(2024, 1, 1)
    sinks.replace_slice(raw(spark, [(d, "A", "m", 1, 1, 1), (d, "A", "m", 2, 2, 1), (d, "B", "m", 1, 3, 1)]), p)
    sinks.replace_slice(raw(spark, [(d, "A", "m", 1, 9, 1)]), p)
    assert content(spark, p) == [(d, "A", 1, 9), (d, "B", 1, 3)]
    sinks.replace_day(spark, raw(spark, [(d, "A", "m", 5, 5, 1)]), p)
    assert content(spark, p) == [(d, "A", 5, 5)]


def test_delete_slice(spark, tmp_path):
    p = str(tmp_path / "raw")
    days = [D(2024, 1, i) for i in (1, 2, 3)]
    sinks.replace_slice(raw(spark, [(d, h, "m", 1, 1, 1) for d in days for h in "AB"]), p)
    assert sinks.delete_slice(spark, p, days[0], days[1], "A") == 2
    assert sinks.delete_slice(spark, p, days[2], days[2]) == 2
    assert content(spark, p) == [(days[0], "B", 1, 1), (days[1], "B", 1, 1)]


def test_upsert_is_idempotent_and_keeps_stale_units(spark, tmp_path):
    p = str(tmp_path / "raw")
    d, key = D(2024, 1, 1), ["date", "hole", "machine_number"]
    args = (p, key, ["date", "hole"], schemas.RAW)
    first = raw(spark, [(d, "A", "m", 1, 1, 1), (d, "A", "m", 2, 2, 1)])
    second = raw(spark, [(d, "A", "m", 2, 7, 1), (d, "A", "m", 3, 3, 1), (D(2024, 1, 2), "A", "m", 1, 4, 1)])
    assert sinks.upsert(spark, first, *args) == sinks.UpsertResult(2, 0)
    assert sinks.upsert(spark, second, *args) == sinks.UpsertResult(2, 1)
    once = content(spark, p)
    assert once == [(d, "A", 1, 1), (d, "A", 2, 7), (d, "A", 3, 3), (D(2024, 1, 2), "A", 1, 4)]
    assert sinks.upsert(spark, second, *args) == sinks.UpsertResult(0, 3)
    assert content(spark, p) == once


def test_insert_ignore_keeps_the_first(spark, tmp_path):
    p = str(tmp_path / "raw")
    d, key = D(2024, 1, 1), ["id"]
    for diff in (1, 2):
        sinks.insert_ignore(spark, raw(spark, [(d, "A", "m", 1, diff, 1)]), p, key, ["date", "hole"], schemas.RAW)
    assert content(spark, p) == [(d, "A", 1, 1)]


def test_apply_changes(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (None, "c", "z")], "k int, v string, w string")
    changes = spark.createDataFrame(
        [(1, "update", "a2", None, 1), (1, "update", None, "x3", 2), (2, "delete", None, None, 1), (None, "update", "c2", None, 1),
         (3, "add", "n", "m", 1), (4, "update", "lost", None, 1)],
        "k int, op string, v string, w string, seq int",
    )
    got = {tuple(r) for r in sinks.apply_changes(target, changes, ["k"]).collect()}
    assert got == {(1, "a2", "x3"), (None, "c2", "z"), (3, "n", "m")}


def test_apply_changes_in_order(spark):
    """An update after an add counts, a delete takes the old values, NULL can be set."""
    target = spark.createDataFrame([(1, 5, "x"), (2, 6, "y"), (5, 7, "z")], "k int, v int, w string")
    changes = spark.createDataFrame(
        [(3, "add", 1, None, None, 1), (3, "update", 2, None, None, 2), (1, "delete", None, None, None, 1),
         (1, "update", 8, None, None, 2), (1, "add", None, "new", None, 3), (2, "update", None, None, ["v"], 1),
         (4, "update", 9, None, None, 1), (4, "add", None, "w", None, 2), (5, "add", 1, None, None, 1), (5, "delete", None, None, None, 2)],
        "k int, op string, v int, w string, set_null array<string>, seq int",
    )
    got = {tuple(r) for r in sinks.apply_changes(target, changes, ["k"]).collect()}
    assert got == {(3, 2, None), (1, None, "new"), (2, None, "y"), (4, None, "w")}


def test_delete_slice_with_special_characters(spark, tmp_path):
    p = str(tmp_path / "t")
    rows = spark.createDataFrame([(D(2024, 1, 1), h, n) for h in ("A:B", "C/D", None) for n in (1, 2)], "date date, hole string, n int")
    sinks.overwrite_partitions(rows, p, ["date", "hole"])
    assert sinks.delete_slice(spark, p, D(2024, 1, 1), D(2024, 1, 1), "A:B", schema=rows.schema) == 2
    left = spark.read.schema(rows.schema).parquet(p)
    assert {r.hole for r in left.collect()} == {"C/D", None}
    assert sinks.delete_slice(spark, p, D(2024, 1, 1), D(2024, 1, 1), schema=rows.schema) == 4
    assert spark.read.schema(rows.schema).parquet(p).count() == 0


def test_merge_reads_the_touched_partitions_only(spark, tmp_path):
    p = str(tmp_path / "t")
    rows = spark.range(40).selectExpr("date_add(date'2024-01-01', cast(id % 20 as int)) as date", "concat('H', id % 2) as hole", "id")
    sinks.overwrite_partitions(rows, p, ["date", "hole"])
    batch = rows.where("date = date'2024-01-03'")
    plan = sinks.touched_partitions(spark, batch, p, ["date", "hole"], rows.schema)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "2024" in plan.split("PartitionFilters: [")[1].split("]")[0] or "19725" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_lost_exchange_is_finished_from_its_copy(spark, tmp_path):
    p = str(tmp_path / "raw")
    d = D(2024, 1, 1)
    sinks.replace_slice(raw(spark, [(d, "A", "m", 1, 1, 1)]), p)
    merged = raw(spark, [(d, "A", "m", 1, 1, 1), (d, "A", "m", 2, 2, 1)])
    merged.write.partitionBy("date", "hole").parquet(f"{p}__merged/whole")  # the driver stopped here
    (tmp_path / "raw__merged" / "part").mkdir()  # and here before the copy was complete
    sinks._drop(spark, sinks.partition_folder(spark, p, ["date", "hole"], {"date": d, "hole": "A"}))
    assert sinks.recover(spark, p, ["date", "hole"], schemas.RAW) == 1
    assert content(spark, p) == [(d, "A", 1, 1), (d, "A", 2, 2)]
    assert sinks.recover(spark, p, ["date", "hole"], schemas.RAW) == 0


def test_rewrite_deduped(spark, tmp_path):
    p = str(tmp_path / "raw")
    days = [D(2024, 1, i) for i in (1, 2, 3)]
    rows = raw(spark, [(d, "A", "m", u, u, 1) for d in days for u in (1, 2)])
    sinks.replace_slice(rows.unionByName(rows.where("machine_number = 1")), p)
    report = sinks.rewrite_deduped(spark, p, days[0], days[1])
    assert sorted((r.date, r.duplicate_count) for r in report.collect()) == [(days[0], 1), (days[1], 1)]
    assert content(spark, p) == [(d, "A", u, u) for d in days[:2] for u in (1, 2)] + [(days[2], "A", u, u) for u in (1, 1, 2)]
    assert sinks.rewrite_deduped(spark, p, days[0], days[1]).count() == 0


def test_export_refuses_bad_batches_and_csv_reads_back(spark, tmp_path):
    p = str(tmp_path / "csv")
    rows = raw(spark, [(D(2024, 1, 1), "A", 'm"1, x', 1, 1, 1)])
    sinks.export_csv(rows, p)
    assert readers.read_csv(spark, p, schemas.RAW).first().machine == 'm"1, x'
    assert readers.read_csv(spark, str(tmp_path / "none"), schemas.RAW).count() == 0
    with pytest.raises(ValueError):
        sinks.export_csv(rows.where("false"), p)
    with pytest.raises(ValueError):
        sinks.export_csv(rows.withColumn("game", F.lit(None).cast("bigint")), p)


def test_ndjson_fails_on_malformed_lines(spark, tmp_path):
    good = tmp_path / "a.json"
    good.write_text('{"holiday_date": "2024-01-01"}\n')
    assert readers.load_ndjson(spark, str(good), schemas.HOLIDAY).first()[0] == D(2024, 1, 1)
    bad = tmp_path / "b.json"
    bad.write_text("{oops\n")
    with pytest.raises(Exception):
        readers.load_ndjson(spark, str(bad), schemas.HOLIDAY).collect()


def test_scan_prunes_partitions(spark, tmp_path):
    p = str(tmp_path / "raw")
    sinks.replace_slice(raw(spark, [(D(2024, 1, i), "A", "m", 1, i, 1) for i in range(1, 9)]), p)
    df = readers.scan_raw(spark, p, D(2024, 1, 3), D(2024, 1, 4), "A").select("diff")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "ReadSchema: struct<diff:bigint>" in plan
    assert sorted(r[0] for r in df.collect()) == [3, 4]


def test_evolve_adds_columns_with_defaults(spark):
    df = spark.createDataFrame([(1, None), (2, "q")], "game bigint, source string")
    got = clean.evolve(df, schemas.RAW, {"source": "slot"})
    assert got.columns == schemas.RAW.fieldNames()
    assert sorted(r.source for r in got.collect()) == ["q", "slot"]


def test_fallback_prefers_backup_then_correction(spark):
    cols = "date date, hole string, machine string, machine_number bigint, diff bigint, game bigint, win bigint, source string"
    d = D(2024, 1, 1)
    failed = spark.createDataFrame([(d, "A", m) for m in "xyz"], "date date, hole string, machine string")
    backup = spark.createDataFrame([(d, "A", "x", 1, 1, 1, 1, "s")], cols)
    fix = spark.createDataFrame([(d, "A", "x", 1, 2, 1, 1, "s"), (d, "A", "y", 2, 3, 1, 1, "s"), (d, "A", "z", 3, 4, 1, 1, "t")], cols)
    used, left = reconcile.fallback(failed, backup, fix, source="s")
    assert sorted((r.machine, r.origin) for r in used.collect()) == [("x", "backup"), ("y", "correction")]
    assert [r.machine for r in left.collect()] == ["z"]


def test_register_and_resolve(spark):
    rows = spark.createDataFrame([(1, 101, 5, 10, 1, 2, "1/9")], "correction_id int, machine_number bigint, diff bigint, game bigint, big bigint, reg bigint, combined_rate string")
    meta = spark.createDataFrame([(1, D(2024, 1, 1), "A", "m", "s", "f1", "note")], "correction_id int, date date, hole string, machine string, source string, failure_id string, notes string")
    got = reconcile.register_corrections(rows, meta, T0).first()
    assert got.id == "2024-01-01_A_101_s" and got.win == 1 and got.failure_id == "f1"
    failures = spark.createDataFrame([("f1", "pending", None, None), ("f2", "pending", None, None)], "id string, status string, resolved_at timestamp, resolved_method string")
    after = {r.id: r.status for r in sinks.apply_changes(failures, reconcile.resolutions(meta, T0), ["id"]).collect()}
    assert after == {"f1": "resolved", "f2": "pending"}


def test_insert_ignore_finds_keys_in_other_partitions(spark, tmp_path):
    path, by, keys = str(tmp_path / "t"), ["date", "hole"], ["id"]

    def add(rows):
        sinks.insert_ignore(spark, raw(spark, rows), path, keys, by, schemas.RAW)
        return sorted((x["date"], x["machine_number"], x["diff"]) for x in spark.read.schema(schemas.RAW).parquet(path).collect())

    first = [(D(2024, 1, 1), "A", "m", u, 10 + u, 1) for u in range(20)]
    add(first)
    moved = raw(spark, first).withColumns({"date": F.lit(D(2024, 2, 2)), "diff": F.lit(99).cast("bigint")})
    sinks.insert_ignore(spark, moved, path, keys, by, schemas.RAW)
    assert add([]) == [(D(2024, 1, 1), u, 10 + u) for u in range(20)]
    assert (D(2024, 1, 3), 1, 5) in add([(D(2024, 1, 3), "A", "m", 1, 5, 1)])
    # a driver lost between table and index: rows are there, the index is open and lacks them
    late = raw(spark, [(D(2024, 1, 4), "A", "m", 1, 6, 1)])
    late.write.mode("append").partitionBy(*by).parquet(path)
    sinks._drop(spark, f"{path}__keys/_SUCCESS")
    sinks.insert_ignore(spark, late.withColumn("date", F.lit(D(2024, 5, 5))), path, keys, by, schemas.RAW)
    assert sum(x[2] == 6 for x in add([])) == 1


def test_shards_of_a_span_only_are_read(spark, tmp_path):
    root = str(tmp_path / "shards")
    rows = raw(spark, [(D(2024, m, 1), "A", "m", u, u, 1) for m in range(1, 7) for u in (1, 2)])
    sinks.write_shards(spark, rows, root)
    sinks.write_shards(spark, raw(spark, [(D(2024, 3, 1), "A", "m", 9, 9, 1)]), root)  # a day is replaced
    (tmp_path / "shards" / "data_other").mkdir()
    found = readers.scan_shards(spark, root, D(2024, 2, 15), D(2024, 5, 1))
    assert sorted((x["date"], x["machine_number"]) for x in found.collect()) == sorted([(D(2024, 3, 1), 9), *((D(2024, m, 1), u) for m in (4, 5) for u in (1, 2))])
    assert {f.split("data_")[1][:8] for f in found.inputFiles()} == {"20240301", "20240401", "20240501"}
    assert readers.scan_shards(spark, root).count() == 11
    assert readers.scan_shards(spark, root, D(2030, 1, 1)).count() == 0 and readers.scan_shards(spark, str(tmp_path / "none")).count() == 0


def test_replace_rows_in_coarser_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = raw(spark, []).withColumn("year", F.year("date")).schema

    def put(rows):
        sinks.replace_rows(spark, raw(spark, rows).withColumn("year", F.year("date")), path, ["date", "hole"], ["year"], schema)
        return sorted((x["date"], x["hole"], x["machine_number"]) for x in spark.read.schema(schema).parquet(path).collect())

    put([(D(2023, 1, 1), "A", "m", 1, 1, 1), (D(2024, 1, 1), "A", "m", 1, 1, 1), (D(2024, 1, 1), "B", "m", 1, 1, 1), (D(2024, 1, 2), "A", "m", 1, 1, 1)])
    assert put([(D(2024, 1, 1), "A", "m", 7, 1, 1)]) == [
        (D(2023, 1, 1), "A", 1), (D(2024, 1, 1), "A", 7), (D(2024, 1, 1), "B", 1), (D(2024, 1, 2), "A", 1),
    ]


def test_replace_day_keeps_a_wider_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = raw(spark, [(D(2024, 1, 1), h, "m", 1, 1, 1) for h in "AB"]).withColumn("extra", F.lit(5))
    sinks.overwrite_partitions(rows, path, ["date", "hole"])
    sinks.replace_day(spark, rows.where("hole = 'B'"), path, schema=rows.schema)
    assert [x["hole"] for x in spark.read.schema(rows.schema).parquet(path).collect()] == ["B"]


def test_slices_within_day_partitions_and_copies_without_folders(spark, tmp_path, monkeypatch):
    """Partitions of a day hold many venues; a merge writes its copy as a few files, not into folders."""
    p, d, days = str(tmp_path / "t"), [D(2024, 1, i) for i in (1, 2)], ("date",)
    rows = raw(spark, [(x, h, "m", 1, 1, 1) for x in d for h in "ABC"])
    sinks.replace_slice(rows.unionByName(rows.where("hole = 'A'")), p, days)
    written = []
    monkeypatch.setattr(sinks, "overwrite_partitions", lambda df, *a, f=sinks.overwrite_partitions: (written.append(df.inputFiles()), f(df, *a)))
    sinks.replace_slice(raw(spark, [(d[0], "B", "m", 1, 9, 1)]), p, days)
    for diff in (3, 4):  # rows without a venue are a slice too
        sinks.replace_slice(raw(spark, [(D(2024, 1, 3), None, "m", 1, diff, 1)]), p, days)
    assert [x for x in content(spark, p) if x[1] is None] == [(D(2024, 1, 3), None, 1, 4)]
    report = sinks.rewrite_deduped(spark, p, d[0], d[0], by=days)
    assert [(r.date, r.hole, r.duplicate_count) for r in report.collect()] == [(d[0], "A", 1)]
    assert content(spark, p)[:-1] == [(d[0], "A", 1, 1), (d[0], "B", 1, 9), (d[0], "C", 1, 1)] + [(d[1], h, 1, 1) for h in "AABC"]
    assert sinks.upsert(spark, raw(spark, [(d[1], "C", "m", 1, 5, 1)]), p, ["date", "hole", "machine_number"], list(days), schemas.RAW).updated == 1
    assert (d[1], "C", 1, 5) in content(spark, p) and len(written) == 5
    assert sum(any("__merged/" in f for f in files) for files in written) >= 3
    assert all("date=" not in f for files in written for f in files)


def test_delete_slice_and_replace_day_within_day_partitions(spark, tmp_path):
    """A table by day: the venue leaves its days, rows without a venue and other days stay; a replaced day has the batch's venues only."""
    p, d = str(tmp_path / "t"), [D(2024, 1, i) for i in (1, 2, 3)]
    rows = raw(spark, [(x, h, "m", 1, 1, 1) for x in d for h in ("A:b", None)] + [(d[0], "C", "m", 1, 1, 1)]).where("hole is not null or date < date'2024-01-03'")
    sinks.overwrite_partitions(rows, p, ["date"])
    assert sinks.delete_slice(spark, p, d[0], d[1], "A:b", by=("date",)) == 2
    assert sinks.delete_slice(spark, p, d[0], d[1], "A:b", by=("date",)) == 0
    left = {(r.date, r.hole) for r in spark.read.schema(schemas.RAW).parquet(p).collect()}
    assert left == {(d[0], None), (d[0], "C"), (d[1], None), (d[2], "A:b")}
    assert sinks.delete_slice(spark, p, d[2], d[2], "A:b", by=("date",)) == 1  # the last rows of a day
    sinks.replace_day(spark, raw(spark, [(d[0], "B", "m", 1, 2, 1)]), p, ("date",))
    assert {(r.date, r.hole) for r in spark.read.schema(schemas.RAW).parquet(p).collect()} == {(d[0], "B"), (d[1], None)}
    sinks.replace_day(spark, raw(spark, [(d[0], None, "m", 1, 3, 1), (d[0], "E", "m", 1, 3, 1), (d[1], None, "m", 1, 3, 1)]), p, ("date",))
    assert {(r.date, r.hole) for r in spark.read.schema(schemas.RAW).parquet(p).collect()} == {(d[0], "E")}
