"""Registered queries: data quality, reconciliation, parsing, maintenance, streaming."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorlens import session
from floorlens.functions import scalars as sc
from floorlens.operators import dedupe, lists, quality, reconcile
from floorlens.plans import profiles, summary
from floorlens.sources import clean, layouts, pages, schemas, sinks, text
from floorlens.sources import derived as d
from floorlens.streaming import ingest



def _mart(s, f):
    from .registry import mart

    return mart(s, f)


def _unit_days(s, f):
    from .registry import unit_days

    return unit_days(s, f)


def _range(s, f):
    return d.observations(s, f).agg(F.min("date"), F.max("date")).first()


def _collection(s, f):
    return quality.collection_status(d.observations(s, f), d.venues(s, f), *_range(s, f), ts="ts")


def has_data(s, f):
    """Venue-days of the orders table that have observations."""
    keys = d.table(s, f, "orders").selectExpr(
        "cast(o_orderdate as date) as date", "concat('H', cast(o_custkey div 750 as string)) as hole"
    )
    return quality.has_data(keys.distinct(), d.observations(s, f))


def listed_models(s, f):
    """Models a venue lists: one more than stored on every day divisible by seven."""
    return quality.model_count(d.observations(s, f)).select(
        "date", "hole", (F.col("models") + F.when(F.dayofmonth("date") % 7 == 0, 1).otherwise(0)).alias("models")
    )


def stored_rows(s, f):
    """The store lacks what was returned."""
    return d.observations(s, f).where("l_returnflag <> 'R'")


def fallback(s, f):
    """Every failed model of every observation, with the rows that stand in for it: the backup holds
    what the first source brought; what has neither backup nor correction stays a failure."""
    failed = _failed_models(s, f)
    cols = ["date", "hole", "machine", "machine_number", "diff", "game", "win", "source"]
    backup = dedupe.dedupe_latest(
        d.observations(s, f).where("source = 's0'"), ["date", "hole", "machine_number"], "ts", d.TIES
    ).select(*cols)
    fixes = dedupe.dedupe_latest(d.corrections(s, f), ["date", "hole", "machine_number"], "ts", d.TIES)
    fixes = clean.with_win(fixes).select(*cols)
    used, left = reconcile.fallback(failed, backup, fixes)
    shown = ["date", "hole", "machine", "origin", "machine_number", "diff", "game"]
    none = {c: F.lit(None).cast("bigint") for c in shown[4:]}
    return used.select(*shown).unionByName(left.withColumn("origin", F.lit("failure")).withColumns(none).select(*shown))


def _failed_models(s, f):
    """Every (date, venue, model) with a unit that played nothing."""
    return d.observations(s, f).where("game = 0 or game is null").select("date", "hole", "machine").distinct()


def restore_day(s, f):
    newest = dedupe.dedupe_latest(d.corrections(s, f), ["date", "hole", "machine_number"], "ts", d.TIES)
    return reconcile.restore_day(newest, "s9").select("id", "date", "hole", "machine", "machine_number", "diff", "game", "win", "source")


def upsert_result(s, f):
    """Stored unit-days updated by the corrected ones."""
    cols = ["date", "hole", "machine_number", "machine", "diff", "game"]
    key = ["date", "hole", "machine_number"]
    target = dedupe.dedupe_latest(stored_rows(s, f), key, "ts", d.TIES).select(*cols)
    source = dedupe.dedupe_latest(d.corrections(s, f), key, "ts", d.TIES).select(*cols)
    return sinks.merged(target, source, key)


def insert_ignore_result(s, f):
    """Stored unit-days, and the corrected ones only where nothing is stored."""
    cols = ["date", "hole", "machine_number", "machine", "diff", "game"]
    key = ["date", "hole", "machine_number"]
    target = dedupe.dedupe_latest(stored_rows(s, f), key, "ts", d.TIES).select(*cols)
    source = dedupe.dedupe_first(d.corrections(s, f), key, "ts", d.TIES).select(*cols)
    return target.unionByName(sinks.absent(source, target, key))


def apply_changes(s, f):
    """Errors per day and user as the target, all other events as changes to it."""
    ev = d.table(s, f, "events").selectExpr("cast(ts as date) as date", "user_id", "event_type", "value", "event_id")
    target = ev.where("event_type = 'error'").groupBy("date", "user_id").agg(
        F.count(F.lit(1)).alias("errors"), F.max("value").alias("worst")
    )
    op = F.when(F.col("event_type") == "signup", "delete").when(F.col("event_type") == "view", "add").otherwise("update")
    changes = ev.where("event_type <> 'error'").select(
        "date",
        "user_id",
        op.alias("op"),
        F.when(F.col("event_type") == "click", F.col("value")).alias("worst"),
        F.when((F.col("event_type") == "view") & (F.col("event_id") % 3 == 0), F.array(F.lit("worst"))).alias("set_null"),
        F.col("event_id").alias("seq"),
    )
    return sinks.apply_changes(target, changes, ["date", "user_id"])


def raw_texts(s, f):
    """Observations as text in the camel naming of a page scrape."""
    o = d.observations(s, f)
    return o.select(
        F.replace(F.col("date").cast("string"), F.lit("-"), F.lit("/")).alias("date"),
        "hole",
        F.when(F.col("l_returnflag") == "A", F.lit("")).otherwise(F.col("machine")).alias("machine"),
        F.col("machine_number").cast("string").alias("machineNumber"),
        F.concat(F.when(F.col("diff") > 0, "+").otherwise(""), F.format_number("diff", 0)).alias("diff"),
        F.coalesce(F.col("game").cast("string"), F.lit("--")).alias("game"),
        F.concat(F.col("machine_number").cast("string"), F.lit("px")).alias("big"),
        F.col("ts").alias("ts"),
        "l_partkey",
        "l_extendedprice",
    )


def format_raw(s, f):
    typed = clean.format_raw(raw_texts(s, f))
    return typed.groupBy("date", "hole", "machine_number", "diff", "game", "big").agg(F.count(F.lit(1)).alias("n"))


def validate_raw(s, f):
    checked = clean.validity(clean.format_raw(raw_texts(s, f)))
    return checked.groupBy(F.array_join("errors", ",").alias("errors")).agg(F.count(F.lit(1)).alias("n"))


def pastes(s, f) -> DataFrame:
    """One pasted table per venue-day: header, unit lines, average line."""
    u = _unit_days(s, f)
    line = F.concat_ws(
        "\t",
        F.col("machine_number").cast("string"),
        F.concat(F.when(F.col("diff") > 0, "+").otherwise(""), F.format_number("diff", 0)),
        F.coalesce(F.format_number("game", 0), F.lit("")),
        (F.col("machine_number") % 30).cast("string"),
        (F.dayofmonth("date") % 10).cast("string"),
        F.concat(F.lit("1/"), F.col("machine_number").cast("string")),
    )
    lines = u.groupBy("date", "hole").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    head, foot = F.lit("台番\t差枚\tG数\tBB\tRB\t合成\n"), F.lit("\n平均\t0\t0\t0\t0\t-")
    return lines.select("date", "hole", F.concat(head, F.array_join("lines", "\n"), foot).alias("text"))


def grids(s, f) -> DataFrame:
    """One floor grid per venue-day: a line per model, then a line of structures."""
    u = _unit_days(s, f)
    lines = u.groupBy("date", "hole", "machine").agg(F.array_sort(F.collect_list("machine_number")).alias("units"))
    text_line = F.concat(F.col("machine"), F.lit(","), F.array_join(F.col("units").cast("array<string>"), ","))
    files = lines.groupBy("date", "hole").agg(F.array_sort(F.collect_list(text_line)).alias("lines"))
    return files.select("date", "hole", F.concat(F.array_join("lines", "\r\n"), F.lit("\r\n\r\nx,入口, 北階段 ,コーナー")).alias("text"))


def layout_documents(s, f):
    cells = layouts.trim_columns(layouts.parse_layout_grid(grids(s, f)), ["date", "hole"])
    docs = layouts.build_layout(cells, ["date", "hole"], "2026-01-01")
    return docs.select(
        "date", "hole", "version", "grid.rows", "grid.cols", F.size("cells").alias("n"), F.col("cells")[0]["number"].alias("first")
    )


def overlay(s, f):
    """Cells of a floor with the latest statistics of the units in them."""
    cells = layouts.parse_layout_grid(grids(s, f).withColumn("floor", F.lit("1F")))
    docs = layouts.build_layout(cells, ["date", "hole", "floor"], "2026-01-01")
    newest = docs.groupBy("hole").agg(F.max("date").alias("date"))
    docs = docs.join(newest, ["hole", "date"], "left_semi")
    from .registry import common

    stats = summary.latest_unit_statistics(d.observations(s, f), **common(s)).select("hole", "machine_number", "d1_diff", "d28_diff")
    return summary.overlay_layout(docs, stats).select("hole", "floor", "row", "col", "type", "number", "d1_diff", "d28_diff")


def captured_pages(s, f) -> DataFrame:
    """A model page per (date, venue, model): unit cards and the summary table, which differ by one coin."""
    u = _unit_days(s, f)
    n = F.col("machine_number").cast("string")
    game = F.coalesce(F.format_number("game", 0), F.lit("0"))

    def cells(tag, *values):
        out = []
        for v in values:
            out += [F.lit(f"<{tag}>"), v, F.lit(f"</{tag}>")]
        return F.concat(*out)

    heads = cells("th", *[F.lit(h) for h in ("差枚", "G数", "BB", "RB", "合成")])
    card = F.concat(
        F.lit('<div class="wp-block-column is-vertically-aligned-top"><p class="has-text-align-center"><strong><font>'),
        n,
        F.lit("</font></strong></p><table><tbody><tr>"),
        heads,
        F.lit("</tr><tr>"),
        cells("td", F.format_number(F.col("diff") - 1, 0), game, F.lit("5"), F.lit("6"), F.lit("1/99")),
        F.lit("</tr></tbody></table><script>var c = {data: [0, "),
        F.col("diff").cast("string"),
        F.lit("]};</script></div>"),
    )
    row = F.concat(F.lit("<tr>"), cells("td", n, F.format_number("diff", 0), game, F.lit("7"), F.lit("8"), F.lit("1/100")), F.lit("</tr>"))
    both = u.groupBy("date", "hole", "machine").agg(
        F.array_sort(F.collect_list(F.struct(n.alias("n"), card.alias("card"), row.alias("row")))).alias("r")
    )
    average = cells("td", F.lit("平均"), *[F.lit("0")] * 5)
    return both.select(
        "date",
        "hole",
        "machine",
        F.concat(
            F.lit("<html><body>"),
            F.array_join("r.card", ""),
            F.lit('<table class="table2"><thead><tr>'),
            cells("th", F.lit("台番")),
            heads,
            F.lit("</tr></thead><tbody>"),
            F.array_join("r.row", ""),
            F.lit("<tr>"),
            average,
            F.lit("</tr></tbody></table></body></html>"),
        ).alias("html"),
    )


def extract_units(s, f):
    rows = pages.extract_units(captured_pages(s, f), ["date", "hole", "machine"])
    return rows.select("date", "hole", "machine", "machine_number", "diff", "game", "big", "reg", "combined_rate", "win", F.size("graph_data").alias("points"))


def extract_models(s, f):
    u = _unit_days(s, f).select("date", "hole", F.concat("machine", F.lit(" L+ア")).alias("m")).distinct()
    link = F.concat(F.lit('<li><a class="k" href="kishu/?kishu='), F.url_encode("m"), F.lit('"> <b>'), F.col("m"), F.lit("</b> </a></li>"))
    html = u.groupBy("date", "hole").agg(F.array_join(F.array_sort(F.collect_list(link)), "").alias("html"))
    return pages.extract_models(html).select("date", "hole", "position", "name", "decoded_name")


def classify_errors(s, f):
    docs = d.table(s, f, "documents")
    return docs.select("doc_id", sc.classify_error(F.col("text"), F.col("source")).alias("error_class"))


def classify_http(s, f):
    status = (F.floor("value") + 150).cast("int")
    return d.table(s, f, "events").select(
        "event_id", status.alias("status"), sc.classify_http(status).alias("class"), sc.retryable_http(status).alias("retryable")
    )


def run_times(s, f):
    t = sc.target_date(F.col("ts"))
    return d.table(s, f, "events").select("event_id", t.alias("target_date"), sc.run_time(t).alias("run_time"))


def slugs(s, f):
    named = d.table(s, f, "supplier").select(F.concat("s_name", F.lit(" 店")).alias("hole"), F.concat(F.lit(" B"), "s_suppkey", F.lit("/2 F")).alias("floor"))
    return layouts.with_slugs(named)


def failures_list(s, f):
    return lists.list_rows(
        d.failures(s, f).drop("error_message"), equals={"status": "pending"}, newest=["failed_at", "event_id"], limit=50
    ).drop("failed_at", "event_id")


def venues_by_priority(s, f):
    return lists.by_priority(lists.venues(d.venues(s, f)))


def events_from_dates(s, f):
    return lists.events_from_dates(d.event_days(s, f).select("date"), "H0", "rush")


def evolve(s, f):
    rows = d.observations(s, f).select("id", "date", "hole", "machine", "machine_number", "diff")
    out = clean.evolve(rows, schemas.RAW, {"source": "s1", "max_my": 0}).groupBy("source", "hole", "max_my")
    return out.agg(F.count(F.lit(1)).alias("n"), F.count("game").alias("games"), F.sum("diff").alias("diff"))


STREAM_SCHEMA = "date date, hole string, machine string, machine_number bigint, diff bigint, game bigint, win bigint, source string, timestamp timestamp, event_id bigint"


def _streamed(s, f, with_mart: bool):
    """Feeds the `events` table, a file per day, through the streaming ingest."""
    from pyspark.sql.types import StructType

    base = session.work_folder(s)
    d.stream_rows(s, f).repartitionByRange(10, "date").write.parquet(f"{base}/incoming")
    schema = StructType.fromDDL(STREAM_SCHEMA)
    stream = ingest.read_stream(s, f"{base}/incoming", schema, files_per_trigger=4)
    mart = f"{base}/mart" if with_mart else None
    extra = dict(ties=["event_id"]) if with_mart else {}
    ingest.ingest(stream, f"{base}/raw", f"{base}/state", mart, schema=schema, by=("date",), **extra).awaitTermination()
    return s.read.schema(schemas.MART).parquet(mart) if with_mart else s.read.schema(schema).parquet(f"{base}/raw")


def stream_ingest(s, f):
    return _streamed(s, f, False).select("date", "hole", "machine_number", "source", "machine", "diff", "game", "win", "event_id")


def stream_mart(s, f):
    cols = ["d1_diff", "d3_diff", "d7_game", "d28_diff", "prev_d7_diff", "all_days", "mtd_game"]
    return _streamed(s, f, True).select("target_date", "hole", "machine_number", "machine", *cols)


def queries():
    obs = d.observations
    return {
        "scan_rows_per_date": lambda s, f: lists.rows_per_date(obs(s, f), *_range(s, f)),
        "latest_dates": lambda s, f: summary.latest_dates(_mart(s, f), ["hole", "machine"]),
        "collection_status": _collection,
        "collection_days": lambda s, f: quality.collection_days(_collection(s, f)),
        "collection_summary": lambda s, f: quality.collection_summary(quality.collection_days(_collection(s, f))),
        "mart_status": lambda s, f: quality.mart_status(_mart(s, f)),
        "model_count": lambda s, f: quality.model_count(obs(s, f)),
        "has_data": has_data,
        "row_count_by_venue": lambda s, f: quality.row_count_by_venue(obs(s, f)),
        "failure_stats": lambda s, f: quality.failure_stats(d.failures(s, f)),
        "pending_failures": lambda s, f: quality.pending_failures(d.failures(s, f)),
        "failures_list": failures_list,
        "corrections_summary": lambda s, f: quality.corrections_summary(d.corrections(s, f)),
        "distinct_event_types": lambda s, f: lists.distinct_values(d.event_rows(s, f), "event"),
        "venues_by_priority": venues_by_priority,
        "failure_venue_codes": lambda s, f: lists.with_venue_code(d.failures(s, f).select("id", "hole"), d.venues(s, f)),
        "events_from_dates": events_from_dates,
        "resync_decision": lambda s, f: reconcile.collection_decision(stored_rows(s, f), listed_models(s, f)),
        "sync_decision": lambda s, f: reconcile.sync_decision(obs(s, f), stored_rows(s, f)),
        "fallback_merge": fallback,
        "restore_day": restore_day,
        "upsert_result": upsert_result,
        "insert_ignore_result": insert_ignore_result,
        "apply_changes": apply_changes,
        "evolve": evolve,
        "format_raw": format_raw,
        "validate_raw": validate_raw,
        "parse_tsv": lambda s, f: text.parse_tsv(pastes(s, f)).drop("line"),
        "parse_layout_grid": lambda s, f: layouts.parse_layout_grid(grids(s, f)),
        "layout_cell_counts": lambda s, f: layouts.cell_counts(
            layouts.filter_unit_range(layouts.parse_layout_grid(grids(s, f)), 105, 2000), ["date", "hole"]
        ),
        "layout_documents": layout_documents,
        "overlay_layout": overlay,
        "extract_units": extract_units,
        "extract_models": extract_models,
        "classify_errors": classify_errors,
        "classify_http": classify_http,
        "run_times": run_times,
        "slugs": slugs,
        "mart_breakdown_weekday": lambda s, f: _round(summary.mart_breakdown(_mart(s, f), "day_of_week_jp")),
        "mart_breakdown_day_type": lambda s, f: _round(summary.mart_breakdown(_mart(s, f), "day_type")),
        "trend_screen": lambda s, f: summary.rising_units(_mart(s, f)),
        "steady_winners": lambda s, f: summary.steady_winners(_mart(s, f)),
        "stream_ingest": stream_ingest,
        "stream_mart": stream_mart,
        **profile_queries(),
    }


def _round(df):
    return df.withColumns({c: F.round(c, 6) for c, t in df.dtypes if t == "double"})


ENSEMBLE = ["d3_win_rate", "d7_payout_rate", "d14_payout_rate", "d28_payout_rate"]


def _ensemble(s, f):
    rows = _mart(s, f).select("hole", "machine", "target_date", "machine_number", "d1_diff", "d1_payout_rate", *ENSEMBLE)
    return profiles.ensemble(rows, ENSEMBLE, [0.3, 0.25, 0.25, 0.2], ["hole", "machine", "target_date"], rows=d.observations(s, f).count())


def conditional_ensemble(s, f):
    scored = session.stored(_ensemble(s, f))
    out = profiles.conditional_ensemble(scored, ENSEMBLE)
    return _round(out.select("hole", "machine", "target_date", "machine_number", *[f"accuracy_{i}" for i in range(3)], "conditional_score", "conditional_rank"))


def _venue_days(s, f):
    """A venue's days with data: the raw keys have the days of the mart."""
    return d.observations(s, f).select("hole", F.col("date").alias("target_date")).distinct()


def _venue_profile():
    return F.when(F.col("hole") == "H0", "island").otherwise("espas")


def profile_queries():
    p = profiles
    m = _mart
    key = ["hole", "machine", "target_date", "machine_number"]
    return {
        "weekday_profile": lambda s, f: _round(p.weekday_profile(m(s, f))),
        "cycle_profile": lambda s, f: _round(p.cycle_profile(m(s, f), 14, dt.date(1996, 1, 1))),
        "ma_cross": lambda s, f: p.moving_average_cross(m(s, f)),
        "rebound_rate": lambda s, f: p.rebound_rate(m(s, f)),
        "volatility": lambda s, f: _round(p.volatility(m(s, f))),
        "neighbour_effect": lambda s, f: _round(p.neighbour_effect(m(s, f), ["hole"])),
        "digit_groups": lambda s, f: p.digit_groups(m(s, f)),
        "special_distances": lambda s, f: p.special_distances(m(s, f), _venue_profile()),
        "feature_table": lambda s, f: _round(
            p.feature_table(m(s, f), _venue_profile(), _venue_days(s, f), d.observations(s, f).count()).select(
                *key, "consecutive_wins", "consecutive_losses", "ma3_ma7_diff", "volatility", "diff_percentile",
                "diff_rank", "weekday", "is_weekend", "is_month_end", "machine_last_2digits",
                "days_since_last_special", "days_until_next_special",
            )
        ),
        "ensemble_rank": lambda s, f: _ensemble(s, f).select(
            *key, "ensemble_score", "avg_rank", "total_votes", "consensus_count", "ensemble_rank", "priority_rank"
        ),
        "weight_grid": lambda s, f: _round(
            p.weight_grid_search(p.with_next_day(_ensemble(s, f)), [f"norm_{c}" for c in ENSEMBLE], "next_payout_rate")
        ),
        "conditional_ensemble": conditional_ensemble,
    }
