"""SQL counterparts: data quality, reconciliation, parsing, maintenance, streaming."""

from __future__ import annotations

from .oracle import EVENT_ROWS, EVENTS, NEWEST, OBS, OLDEST, UNITS, mart

KEY = "date, hole, machine_number"
VENUES = """
venues as (
  select 'H' || n_nationkey as name, lower(n_name) as code,
    case n_nationkey % 3 when 0 then 'high' when 1 then 'normal' else 'low' end as priority,
    'R' || n_regionkey as region, n_nationkey % 5 <> 4 as active, n_nationkey % 4 = 0 as late_update
  from nation)"""
STATUS = f"""{OBS}, {VENUES},
have as (select date, hole, count(*) as rows, max(ts) as last_updated from obs group by all),
status as (
  select cast(d as date) as date, v.name as hole, v.region, v.late_update, true as active, coalesce(h.rows, 0) as rows, h.last_updated
  from generate_series((select min(date) from obs), (select max(date) from obs), interval 1 day) g(d) cross join venues v
  left join have h on h.date = cast(d as date) and h.hole = v.name where v.active),
inactive as (select h.* from have h where hole not in (select name from venues where active)),
every as (
  select * from status union all
  select date, i.hole, v.region, coalesce(v.late_update, false), false, i.rows, i.last_updated from inactive i left join venues v on v.name = i.hole),
days as (
  select date, cast(sum(rows) as bigint) as total_count, count(*) filter (where rows > 0) as acquired_count,
    count(*) filter (where active) as total_venues,
    coalesce(bool_and(rows > 0) filter (where late_update and active), true) as priority_complete,
    coalesce(bool_and(rows > 0) filter (where active), true) as all_complete
  from every group by all)"""
FAILURES = """
failures as (
  select cast(event_id as varchar) as id, cast(ts as date) as date, 'H' || (user_id // 75) as hole,
    case when event_id % 4 = 0 then null else 'M' || (event_id % 3) end as machine, ts as failed_at,
    case event_id % 3 when 0 then 'pending' when 1 then 'resolved' else 'ignored' end as status, event_id
  from events where event_type = 'error')"""
CORRECTIONS = """
fix as (
  select id, date, hole, machine, machine_number, diff + 1 as diff, game, source, ts + 1000000000 as ts,
    make_timestamp(ts * 1000000) as corrected_at, 'note ' || ts as notes, l_partkey, l_suppkey, l_extendedprice
  from obs where l_returnflag = 'R')"""
STORE = f"store as (select * from obs where l_returnflag <> 'R')"


def newest(src: str, key: str = KEY) -> str:
    return f"select * from {src} qualify row_number() over (partition by {key} {NEWEST}) = 1"


def build() -> dict[str, tuple[str, str]]:
    q = {}
    q["scan_rows_per_date"] = (OBS, "select date, count(*) as n from obs group by date")
    q["latest_dates"] = (mart(["d1"]), "select hole, machine, max(target_date) as latest_date from mart group by all")
    q["collection_status"] = (STATUS, "select * from every")
    q["collection_days"] = (STATUS, "select * from days")
    q["collection_summary"] = (STATUS, "select count(*) as total_dates, count(*) filter (where priority_complete) as priority_complete_dates, count(*) filter (where all_complete) as all_complete_dates from days")
    q["mart_status"] = (mart(["d1"]), """select target_date, hole, case grouping(target_date, hole) when 0 then 'venue' when 1 then 'date' else 'total' end as level,
  count(*) as count, count(*) filter (where d1_diff > 0) as win_count, round(coalesce(avg(d1_diff), 0), 0) as avg_diff
from mart group by rollup (target_date, hole)""")
    q["model_count"] = (OBS, "select date, hole, count(distinct machine) as models from obs group by all")
    q["has_data"] = (OBS, "select k.date, k.hole, exists (select 1 from obs o where o.date = k.date and o.hole = k.hole) as \"exists\" from (select distinct cast(o_orderdate as date) as date, 'H' || (o_custkey // 750) as hole from orders) k")
    q["row_count_by_venue"] = (OBS, "select hole, count(distinct id) as n from obs group by all")
    q["failure_stats"] = (FAILURES, "select count(*) filter (where status = 'pending') as pending, count(*) filter (where status = 'resolved') as resolved, count(*) filter (where status = 'ignored') as ignored, count(*) as total from failures")
    q["pending_failures"] = (FAILURES, "select date, hole, count(*) as pending from failures where status = 'pending' group by all")
    q["failures_list"] = (FAILURES, "select id, date, hole, machine, status from failures where status = 'pending' order by failed_at desc, event_id desc limit 50")
    q["corrections_summary"] = (f"{OBS}, {CORRECTIONS}", "select date, hole, machine, count(*) as count, min(corrected_at) as first_corrected, max(corrected_at) as last_corrected, arg_max(notes, (corrected_at, notes)) as notes from fix group by all")
    q["distinct_event_types"] = (EVENT_ROWS, "select distinct event from event_rows")
    q["venues_by_priority"] = (VENUES, "select *, cast(case priority when 'high' then 0 when 'normal' then 1 else 2 end as bigint) as priority_order from venues where active")
    q["failure_venue_codes"] = (f"{FAILURES}, {VENUES}", "select f.id, f.hole, v.code as hole_code from failures f left join venues v on v.name = f.hole")
    q["events_from_dates"] = (EVENTS, "select distinct sha256(date || '_H0_rush') as id, date, 'H0' as hole, 'rush' as event from event_days")
    q["resync_decision"] = (f"""{OBS}, {STORE},
saved as (select date, hole, count(distinct machine) as saved from store group by all),
listed as (select date, hole, count(distinct machine) + max(case when day(date) % 7 = 0 then 1 else 0 end) as listed from obs group by date, hole)""",
        "select date, hole, coalesce(saved, 0) as saved, coalesce(listed, 0) as listed, case when coalesce(saved, 0) = 0 then 'new' when saved <> coalesce(listed, 0) then 'refresh' else 'skip' end as action from listed full join saved using (date, hole)")
    q["sync_decision"] = (f"{OBS}, {STORE}", "select date, hole, count(*) as primary_rows, count(*) filter (where l_returnflag <> 'R') as copy_rows, count(*) <> count(*) filter (where l_returnflag <> 'R') as sync from obs group by all")
    q["fallback_merge"] = (f"""{OBS}, {CORRECTIONS},
failed as (select distinct date, hole, machine from obs where coalesce(game, 0) = 0),
src as (select * from obs where source = 's0'),
b as ({newest('src')}), c as ({newest('fix')})""",
        """select date, hole, machine, 'backup' as origin, machine_number, diff, game from failed join b using (date, hole, machine)
union all
select date, hole, machine, 'correction', machine_number, diff, game from failed join c using (date, hole, machine)
where (date, hole, machine) not in (select (date, hole, machine) from b)
union all
select date, hole, machine, 'failure', null, null, null from failed
where (date, hole, machine) not in (select (date, hole, machine) from b) and (date, hole, machine) not in (select (date, hole, machine) from c)""")
    q["restore_day"] = (f"{OBS}, {CORRECTIONS}, c as ({newest('fix')})", "select date || '_' || hole || '_' || machine_number || '_s9' as id, date, hole, machine, machine_number, diff, game, cast(case when diff > 0 then 1 else 0 end as bigint) as win, 's9' as source from c")
    cols = f"{KEY}, machine, diff, game"
    q["upsert_result"] = (f"{OBS}, {CORRECTIONS}, {STORE}, t as ({newest('store')}), c as ({newest('fix')})",
        f"select {cols} from c union all select {cols} from t where ({KEY}) not in (select ({KEY}) from c)")
    q["insert_ignore_result"] = (f"{OBS}, {CORRECTIONS}, {STORE}, t as ({newest('store')}), c as (select * from fix qualify row_number() over (partition by {KEY} {OLDEST}) = 1)",
        f"select {cols} from t union all select {cols} from c where ({KEY}) not in (select ({KEY}) from t)")
    # one by one: each change reads the row that the ones before it left
    q["apply_changes"] = ("""
recursive ev as (select cast(ts as date) as date, user_id, event_type, value, event_id from events),
t as (select date, user_id, count(*) as errors, max(value) as worst from ev where event_type = 'error' group by all),
c as (select *, row_number() over (partition by date, user_id order by event_id) as n from ev where event_type <> 'error'),
k as (select date, user_id from t union select date, user_id from c),
step as (
  select k.date, k.user_id, 0 as n, t.user_id is not null as here, t.errors, t.worst from k left join t using (date, user_id)
  union all
  select s.date, s.user_id, c.n,
    case c.event_type when 'signup' then false when 'view' then true else s.here end,
    case when c.event_type = 'signup' then null else s.errors end,
    case when c.event_type = 'signup' then null
      when c.event_type = 'click' and s.here then c.value
      when c.event_type = 'view' and c.event_id % 3 = 0 then null else s.worst end
  from step s join c on c.date = s.date and c.user_id = s.user_id and c.n = s.n + 1)""",
        """select date, user_id, errors, worst from (
  select * from step qualify row_number() over (partition by date, user_id order by n desc) = 1) where here""")
    q["evolve"] = (OBS, "select 's1' as source, hole, cast(0 as bigint) as max_my, count(*) as n, cast(0 as bigint) as games, cast(sum(diff) as bigint) as diff from obs group by hole")
    q["format_raw"] = (OBS, "select date, hole, machine_number, diff, game, machine_number as big, count(*) as n from obs group by all")
    q["validate_raw"] = (OBS, "select array_to_string(list_filter([case when l_returnflag = 'A' then 'machine' end, case when game is null then 'game' end], lambda x: x is not null), ',') as errors, count(*) as n from obs group by all")
    q["parse_tsv"] = (UNITS, "select date, hole, machine_number, diff, coalesce(game, 0) as game, machine_number % 30 as big, day(date) % 10 as reg, '1/' || machine_number as combined_rate from unit_days")
    grid = f"""{UNITS},
placed as (
  select date, hole, machine_number, dense_rank() over (partition by date, hole order by machine) - 1 as r,
    row_number() over (partition by date, hole, machine order by machine_number) - 1 as c from unit_days),
size as (select date, hole, max(r) + 2 as grid_rows, max(c) + 1 as units_wide, greatest(max(c) + 1, 3) as grid_cols from placed group by all),
cells as (
  select date, hole, r as row, c as col, 'machine' as type, machine_number as number, null as subtype, null as label, null as text from placed
  union all
  select date, hole, grid_rows - 1, i, ['structure', 'structure', 'label'][i + 1], null, ['entrance', 'stairs', null][i + 1],
    ['入口', '北階段', null][i + 1], [null, null, 'コーナー'][i + 1]
  from size, (values (0), (1), (2)) x(i))"""
    q["parse_layout_grid"] = (grid, "select date, hole, cast(grid_rows as integer) as grid_rows, cast(grid_cols as integer) as grid_cols, cast(row as integer) as row, cast(col as integer) as col, type, number, subtype, label, text from cells join size using (date, hole)")
    q["layout_cell_counts"] = (grid, "select date, hole, count(*) as cells, count(*) filter (where type = 'machine') as machines, count(*) filter (where type = 'structure') as structures, count(*) filter (where type = 'label') as labels from cells where type <> 'machine' or number between 105 and 2000 group by all")
    q["layout_documents"] = (grid, "select date, hole, '2.0' as version, cast(any_value(grid_rows) as integer) as rows, cast(any_value(units_wide) as integer) as cols, cast(count(*) as integer) as n, arg_min(number, row * 1000 + col) as first from cells join size using (date, hole) where col < units_wide group by date, hole")
    q["overlay_layout"] = (mart(["d1", "d28"]) + grid[len(UNITS):] + """,
stats as (select hole, machine_number as number, d1_diff, d28_diff from mart where (hole, target_date) in (select (hole, max(target_date)) from mart group by hole))""",
        "select c.hole, '1F' as floor, cast(row as integer) as row, cast(col as integer) as col, type, c.number, d1_diff, d28_diff from cells c left join stats s on s.hole = c.hole and s.number = c.number where (c.hole, c.date) in (select (hole, max(date)) from cells group by hole)")
    q["extract_units"] = (UNITS, "select date, hole, machine, machine_number, diff, coalesce(game, 0) as game, cast(7 as bigint) as big, cast(8 as bigint) as reg, '1/100' as combined_rate, cast(case when diff > 0 then 1 else 0 end as bigint) as win, cast(2 as integer) as points from unit_days")
    q["extract_models"] = (UNITS, "select date, hole, cast(row_number() over (partition by date, hole order by machine) - 1 as integer) as position, machine || ' L+ア' as name, machine || ' L+ア' as decoded_name from (select distinct date, hole, machine from unit_days)")

    def words(col, ws):
        return " or ".join(f"contains({col}, '{w}')" for w in ws)

    q["classify_errors"] = ("x as (select 1)", f"""select doc_id, case
  when {words('lower(source)', ['cloudflare', 'just a moment', 'checking'])} or contains(text, 'cloudflare') then 'cloudflare'
  when {words('text', ['timeout', 'Timeout'])} then 'timeout'
  when {words('text', ['net::', 'ECONNREFUSED', 'ENOTFOUND', 'network'])} then 'network'
  when {words('text', ['parse', 'undefined', 'null', 'Cannot read'])} then 'parse' else 'unknown' end as error_class from documents""")
    q["classify_http"] = ("x as (select event_id, cast(floor(value) as integer) + 150 as status from events)", """select event_id, status,
  case when status = 403 then 'cloudflare' when status = 404 then 'not_found' when status = 429 then 'rate_limit' when status >= 500 then 'server_error' when status >= 400 then 'client_error' else 'unknown' end as class,
  status = 429 or status >= 500 as retryable from x""")
    q["run_times"] = ("x as (select event_id, cast(ts + interval 9 hour as date) - 1 as target_date from events)", "select event_id, target_date, cast(target_date + 1 as timestamp) - interval 9 hour as run_time from x")
    q["slugs"] = ("x as (select s_name || ' 店' as hole, ' B' || s_suppkey || '/2 F' as floor from supplier)", "select hole, floor, lower(replace(url_encode(hole), '%', '-')) as hole_slug, lower(regexp_replace(trim(floor), '[^A-Za-z0-9_-]+', '-', 'g')) as floor_slug from x")
    for name, col in (("mart_breakdown_weekday", "day_of_week_jp"), ("mart_breakdown_day_type", "day_type")):
        q[name] = (mart(["d1"]), f"select {col}, count(*) as sample_count, round(avg(d1_diff), 6) as avg_diff, round(avg(d1_payout_rate), 6) as avg_payout_rate, round(avg(case when d1_diff > 0 then 1.0::double else 0.0::double end), 6) as win_rate from mart group by all")
    q["trend_screen"] = (mart(["d7", "d14", "d28"]), "select target_date, hole, machine_number, machine, d7_payout_rate as short_term, d14_payout_rate as mid_term, d28_payout_rate as long_term from mart where d7_payout_rate > d14_payout_rate and d14_payout_rate > d28_payout_rate")
    q["steady_winners"] = (mart(["d2", "prev_d2"]), "select target_date, hole, machine_number, machine, d2_win_rate, prev_d2_win_rate from mart where d2_win_rate >= 0.5 and prev_d2_win_rate >= 0.5")
    stream = """
st as (
  select cast(ts as date) as date, 'H' || (user_id // 75) as hole, 'M' || (user_id % 3) as machine, user_id % 40 as machine_number,
    cast(floor(value) as bigint) - 30 as diff, 100 + event_id % 50 as game,
    case when cast(floor(value) as bigint) - 30 > 0 then 1 else 0 end as win, event_type as source, ts as stamp, event_id
  from events)"""
    order = "order by stamp desc, machine desc, diff desc, game desc, win desc, event_id desc"
    one = f"raw as (select * from st qualify row_number() over (partition by date, hole, machine_number, source {order}) = 1)"
    q["stream_ingest"] = (f"{stream}, {one}", "select date, hole, machine_number, source, machine, diff, game, win, event_id from raw")
    frame = "sum({}) over (partition by hole, machine_number, machine order by n range between {} preceding and {})"
    f = lambda c, a, b="current row": f"cast({frame.format(c, a, b)} as bigint)"
    q["stream_mart"] = (f"""{stream}, {one},
u as (select *, date - date '1970-01-01' as n from raw qualify row_number() over (partition by date, hole, machine_number order by stamp desc, event_id desc) = 1)""",
        f"""select date as target_date, hole, machine_number, machine, diff as d1_diff, {f('diff', 2)} as d3_diff, {f('game', 6)} as d7_game,
  {f('diff', 27)} as d28_diff, {f('diff', 7, '1 preceding')} as prev_d7_diff, {f('1', 31)} as all_days,
  cast(sum(game) over (partition by hole, machine_number, machine, year(date), month(date) order by n) as bigint) as mtd_game from u""")
    return q | profiles()


U = "hole, machine, machine_number"


def profiles() -> dict[str, tuple[str, str]]:
    d1 = mart(["d1"])
    won = "case when d1_diff > 0 then 1.0::double else 0.0::double end"
    q = {}
    q["weekday_profile"] = (d1, f"select {U}, cast(dayofweek(target_date) + 1 as integer) as weekday, round(avg({won}), 6) as win_rate, round(avg(d1_payout_rate), 6) as avg_payout_rate from mart group by all")
    q["cycle_profile"] = (d1, f"select {U}, cast(((target_date - date '1996-01-01') % 14 + 14) % 14 as integer) as cycle_day, count(*) as n, round(avg({won}), 6) as win_rate from mart group by all")
    ma = lambda n: f"round(avg(d1_payout_rate) over (partition by {U} order by target_date rows between {n - 1} preceding and current row), 9)"
    q["ma_cross"] = (f"{d1}, m as (select {U}, target_date, {ma(3)} as ma_short, {ma(7)} as ma_long from mart)",
        f"select *, case when ma_short > ma_long and lag(ma_short) over w <= lag(ma_long) over w then 'ゴールデンクロス' end as signal from m window w as (partition by {U} order by target_date)")
    q["rebound_rate"] = (f"{d1}, r as (select *, coalesce(lag(d1_diff, 1) over w < 0 and lag(d1_diff, 2) over w < 0 and lag(d1_diff, 3) over w < 0, false) as a from mart window w as (partition by {U} order by target_date))",
        f"select {U}, count(*) filter (where a and d1_diff > 0) as rebound_wins, count(*) filter (where a) as total_rebounds, (count(*) filter (where a and d1_diff > 0))::double / nullif(count(*) filter (where a), 0) as rebound_rate from r group by all")
    q["volatility"] = (f"{d1}, v as (select {U}, stddev_samp(d1_payout_rate) as s from mart group by all)",
        f"select {U}, round(s, 6) as volatility, case when s > 0.1 then '高ボラ（設定変更頻繁）' when s > 0.05 then '中ボラ' else '低ボラ（設定固定気味）' end as volatility_category from v")
    q["neighbour_effect"] = (f"{d1}, p as (select a.*, b.d1_diff as other from mart a join mart b on a.hole = b.hole and a.target_date = b.target_date and b.machine_number in (a.machine_number - 1, a.machine_number + 1))",
        f"select {U}, count(*) as pairs, round(avg(case when d1_diff > 0 and other > 0 then 1.0::double else 0 end), 6) as neighbor_same_win_rate, round(avg(case when d1_diff > 0 and other < 0 then 1.0::double else 0 end), 6) as neighbor_opposite_rate from p group by all")
    q["digit_groups"] = (d1, f"select hole, machine, machine_number % 10 as last_digit, target_date, avg(d1_payout_rate) as avg_payout_rate, avg({won}) as group_win_rate from mart group by all")
    sp = f"""days as (select distinct hole, target_date from mart),
flag as (select *, day(target_date) in (6, 16, 26) or target_date = last_day(target_date) or (hole = 'H1' and day(target_date) = 14) as sp from days),
dist as (
  select hole, target_date, sp as is_special_day,
    cast(target_date - max(case when sp then target_date end) over (partition by hole order by target_date rows between unbounded preceding and 1 preceding) as integer) as days_since_last_special,
    cast(min(case when sp then target_date end) over (partition by hole order by target_date rows between 1 following and unbounded following) - target_date as integer) as days_until_next_special
  from flag)"""
    q["special_distances"] = (f"{d1}, {sp}", "select * from dist")
    q["feature_table"] = (f"""{mart(['d1', 'prev_d28'])}, {sp},
s as (select *, row_number() over (partition by {U} order by target_date) as seq from mart),
f as (
  select *, seq - 1 - coalesce(max(case when d1_diff > 0 then null else seq end) over b, 0) as consecutive_wins,
    seq - 1 - coalesce(max(case when d1_diff <= 0 then null else seq end) over b, 0) as consecutive_losses,
    avg(d1_payout_rate) over (partition by {U} order by target_date rows between 3 preceding and 1 preceding)
      - avg(d1_payout_rate) over (partition by {U} order by target_date rows between 7 preceding and 1 preceding) as ma,
    stddev_samp(d1_payout_rate) over (partition by {U} order by target_date rows between 28 preceding and 1 preceding) as vol,
    percent_rank() over (partition by hole, machine, target_date order by prev_d28_diff asc nulls first) as pr,
    row_number() over (partition by hole, machine, target_date order by prev_d28_diff desc nulls last, machine_number) as rk
  from s window b as (partition by {U} order by target_date rows between unbounded preceding and 1 preceding))""",
        """select hole, machine, target_date, machine_number, cast(consecutive_wins as integer) as consecutive_wins, cast(consecutive_losses as integer) as consecutive_losses, round(ma, 6) as ma3_ma7_diff, round(vol, 6) as volatility,
  round(pr, 6) as diff_percentile, cast(rk as integer) as diff_rank, cast(dayofweek(target_date) + 1 as integer) as weekday, dayofweek(target_date) in (0, 6) as is_weekend,
  target_date = last_day(target_date) as is_month_end, machine_number % 100 as machine_last_2digits, days_since_last_special, days_until_next_special
from f join dist using (hole, target_date)""")
    cols = ["d3_win_rate", "d7_payout_rate", "d14_payout_rate", "d28_payout_rate"]
    g = "partition by hole, machine, target_date"
    norms = ", ".join(f"percent_rank() over ({g} order by {c} asc nulls first) as n{i}, row_number() over ({g} order by {c} desc nulls last, machine_number) as r{i}" for i, c in enumerate(cols))
    ens = f"""{mart(['d1', 'd3', 'd7', 'd14', 'd28'])}, e0 as (select *, {norms} from mart),
e1 as (select *, round(n0 * 0.3::double + n1 * 0.25::double + n2 * 0.25::double + n3 * 0.2::double, 9) as sc,
  (r0 <= 10)::int + (r1 <= 10)::int + (r2 <= 10)::int + (r3 <= 10)::int as cc from e0),
e2 as (select *, row_number() over ({g} order by sc desc, machine_number) as er from e1)"""
    q["ensemble_rank"] = (ens, """select hole, machine, target_date, machine_number, sc as ensemble_score, (r0 + r1 + r2 + r3) / 4.0::double as avg_rank,
  (r0 <= 5)::int + (r1 <= 5)::int + (r2 <= 5)::int + (r3 <= 5)::int as total_votes, cc as consensus_count, cast(er as integer) as ensemble_rank,
  case when er <= 1 then 5 when er <= 3 then 4 when er <= 5 then 3 when cc >= 3 then 3 when er <= 10 then 2 else 1 end as priority_rank from e2""")
    q["weight_grid"] = (f"{ens}, e0n as (select *, lead(target_date) over u as next_day, lead(d1_payout_rate) over u as next_payout_rate from e0 window u as (partition by {U} order by target_date)), k(x) as (values (1), (2), (3), (4), (5)), w as (select i.x as a, j.x as b, l.x as c, 10 - i.x - j.x - l.x as d from k i, k j, k l where i.x + j.x + l.x <= 10)",
        "select a, b, c, d, count(*) as n, round(avg(next_payout_rate), 6) as avg_payout_rate from e0n, w where next_day is not null and round((a * n0 + b * n1 + c * n2 + d * n3) / 10, 9) >= 0.95 group by a, b, c, d")
    hit = ", ".join(f"sum(case when r{i} <= 5 and lead_won is not null then lead_won end) as h{i}, count(case when r{i} <= 5 then lead_won end) as c{i}" for i in range(3))
    run = ", ".join(f"sum(h{i}) over before / nullif(sum(c{i}) over before, 0) as a{i}" for i in range(3))
    part = lambda i, hi, lo: f"case when a{i} > 0.55 then {hi}::double else {lo}::double end"
    q["conditional_ensemble"] = (f"""{ens},
nx as (select *, case when lead(d1_diff) over u > 0 then 1 when lead(target_date) over u is not null then 0 end as lead_won, lead(target_date) over u as judged from e0 window u as (partition by {U} order by target_date)),
dayhits as (select hole, machine, judged as target_date, {hit} from nx where judged is not null group by hole, machine, judged),
days as (select distinct hole, machine, target_date from mart),
acc as (select d.hole, d.machine, d.target_date, {run} from days d left join dayhits using (hole, machine, target_date) window before as (partition by d.hole, d.machine order by d.target_date rows between unbounded preceding and current row)),
wts as (select *, {part(0, 0.35, 0.20)} as w0, {part(1, 0.25, 0.15)} as w1, {part(2, 0.25, 0.15)} as w2 from acc),
sc as (select e0.*, a0, a1, a2, round(n0 * w0 + n1 * w1 + n2 * w2 + n3 * (1.0::double - w0 - w1 - w2), 9) as conditional_score from e0 join wts using (hole, machine, target_date))""",
        f"select hole, machine, target_date, machine_number, round(a0, 6) as accuracy_0, round(a1, 6) as accuracy_1, round(a2, 6) as accuracy_2, conditional_score, cast(row_number() over ({g} order by conditional_score desc, machine_number) as integer) as conditional_rank from sc")
    return q
