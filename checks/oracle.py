"""SQL counterparts of the registered queries.

Written for DuckDB from the definitions of the measures: window frames with
explicit bounds, one statement per query, shared steps as CTEs.
"""

from __future__ import annotations

TRAIL = [2, 3, 4, 5, 6, 7, 14, 28]

OBS = """
obs as (
  select cast(l_shipdate as date) as date,
    'H' || (l_suppkey // 50) as hole,
    'M' || ((l_partkey % 20 + year(l_shipdate)) % 3) as machine,
    100 + l_partkey % 20 as machine_number,
    cast(floor(l_extendedprice) as bigint) % 6001 - 3000 as diff,
    case when l_orderkey % 97 = 0 then 0 when l_orderkey % 89 = 0 then null
      else cast(l_quantity as bigint) * 100 end as game,
    cast(case when cast(floor(l_extendedprice) as bigint) % 6001 - 3000 > 0 then 1 else 0 end as bigint) as win,
    's' || (l_linenumber % 2) as source,
    l_orderkey * 10 + l_linenumber as ts,
    l_partkey, l_suppkey, l_extendedprice, l_returnflag,
    strftime(l_shipdate, '%Y-%m-%d') || '_H' || (l_suppkey // 50) || '_' || (100 + l_partkey % 20)
      || '_s' || (l_linenumber % 2) as id
  from lineitem)"""

NEWEST = "order by ts desc, l_partkey desc, l_suppkey desc, l_extendedprice desc"
OLDEST = "order by ts, l_partkey, l_suppkey, l_extendedprice"


def renumbered(src: str) -> str:
    return f"""select {src}.* replace (case
      when hole = 'H0' and date <= date '1998-03-31' and machine_number between 100 and 109 then machine_number + 1000
      when hole = 'H1' and date <= date '1998-02-28' and machine_number between 110 and 119 then machine_number + 2000
      else machine_number end as machine_number) from {src}"""


UNITS = f"""{OBS},
ren as ({renumbered('obs')}),
unit_days as (
  select date, hole, machine_number, machine, diff, game, win from ren
  qualify row_number() over (partition by date, hole, machine_number {NEWEST}) = 1)"""

# Days off as published for the years of the derived tables, as month and day.
HOLIDAYS = {
    1995: "0101 0102 0115 0116 0211 0321 0429 0503 0504 0505 0915 0923 1010 1103 1123 1223",
    1996: "0101 0115 0211 0212 0320 0429 0503 0504 0505 0506 0720 0915 0916 0923 1010 1103 1104 1123 1223",
    1997: "0101 0115 0211 0320 0429 0503 0505 0720 0721 0915 0923 1010 1103 1123 1124 1223",
    1998: "0101 0115 0211 0321 0429 0503 0504 0505 0720 0915 0923 1010 1103 1123 1223",
    1999: "0101 0115 0211 0321 0322 0429 0503 0504 0505 0720 0915 0923 1010 1011 1103 1123 1223",
    2000: "0101 0110 0211 0320 0429 0503 0504 0505 0720 0915 0923 1009 1103 1123 1223",
    2001: "0101 0108 0211 0212 0320 0429 0430 0503 0504 0505 0720 0915 0923 0924 1008 1103 1123 1223 1224",
}
DAYS_OFF = ", ".join(f"{y * 10000 + int(md)}" for y, days in HOLIDAYS.items() for md in days.split())
IS_HOLIDAY = "(year({d}) * 10000 + month({d}) * 100 + day({d})) in (" + DAYS_OFF + ")"
WEEKDAY = "['日','月','火','水','木','金','土'][dayofweek({d}) + 1]"


def day_type(d: str, merged: bool = False) -> str:
    off, hol = ("土日祝", "土日祝") if merged else ("週末", "祝日")
    return f"case when dayofweek({d}) in (0, 6) then '{off}' when {IS_HOLIDAY.format(d=d)} then '{hol}' else '平日' end"


def pay(game: str, diff: str) -> str:
    return f"(({game}) * 3 + ({diff}))::double / nullif(({game}) * 3, 0)"


def _frame(prefix: str) -> tuple[str, str]:
    """(named window, frame) of a mart window."""
    prev = prefix.startswith("prev_")
    base = prefix.removeprefix("prev_")
    end = "1 preceding" if prev else "current row"
    if base == "mtd":
        return "m", f"range between unbounded preceding and {end}"
    if base == "all":
        return "u", f"range between 31 preceding and {end}"
    n = int(base[1:])
    return "u", f"range between {n if prev else n - 1} preceding and {end}"


def _window_cols(prefix: str) -> list[str]:
    part = {"u": "partition by hole, machine_number, machine order by n",
            "m": "partition by hole, machine_number, machine, year(date), month(date) order by n"}
    w, frame = _frame(prefix)
    over = f"over ({part[w]} {frame})"
    base = prefix.removeprefix("prev_")
    d, g = f"sum(diff) {over}", f"sum(game) {over}"
    cols = [f"cast({d} as bigint) as {prefix}_diff", f"cast({g} as bigint) as {prefix}_game"]
    if base != "d1":
        cols.append(f"(sum(win) {over})::double / nullif(count(*) {over}, 0) as {prefix}_win_rate")
    cols.append(f"{pay(g, d)} as {prefix}_payout_rate")
    if base == "all":
        cols.append(f"nullif(count(*) {over}, 0) as {prefix}_days")
    return cols


PREFIXES = ["d1"] + [f"d{n}" for n in TRAIL] + ["mtd", "all"]


def mart(prefixes: list[str] | None = None) -> str:
    """CTEs up to `mart` with the given windows."""
    prefixes = PREFIXES + ["prev_" + p for p in PREFIXES] if prefixes is None else prefixes
    cols = ",\n    ".join(c for p in prefixes for c in _window_cols(p))
    return f"""{UNITS},
mart as (
  select date as target_date, hole, machine_number, machine,
    min(date) over (partition by hole, machine_number, machine order by n range between 31 preceding and current row) as start_date,
    date as end_date,
    year(date) as target_year, month(date) as target_month, day(date) as target_day,
    day(date) % 10 as target_day_last_digit,
    month(date) = day(date) as is_month_day_repdigit, day(date) in (11, 22) as is_day_repdigit,
    {WEEKDAY.format(d='date')} as day_of_week_jp,
    {day_type('date')} as day_type,
    {cols}
  from (select *, date - date '1970-01-01' as n from unit_days))"""


HEAD = ("target_date, hole, machine_number, machine, start_date, end_date, target_year, target_month, target_day, "
        "target_day_last_digit, is_month_day_repdigit, is_day_repdigit, day_of_week_jp, day_type")


def mart_cols(prefixes: list[str]) -> str:
    out = []
    for p in prefixes:
        base = p.removeprefix("prev_")
        out += [f"{p}_diff", f"{p}_game"]
        out += [] if base == "d1" else [f"{p}_win_rate"]
        out.append(f"{p}_payout_rate")
        out += [f"{p}_days"] if base == "all" else []
    return ", ".join(out)


EVENTS = """
event_days as (
  select cast(o_orderdate as date) as date, 'H' || (o_custkey // 750) as hole, 'rush' as event
  from orders group by all
  having count(*) filter (where o_orderpriority = '1-URGENT') * 3 > count(*))"""
EVENT_ROWS = f"""{EVENTS},
event_rows as (
  select cast(o_orderdate as date) as date, 'H' || (o_custkey // 750) as hole, 'rush' as event, o_orderkey
  from orders where o_orderpriority = '1-URGENT'
    and (cast(o_orderdate as date), 'H' || (o_custkey // 750)) in (select (date, hole) from event_days))"""

CATEGORIES = ["LINE告知", "月末", "0のつく日", "1のつく日", "6のつく日", "8のつく日", "9のつく日", "通常日", "すべての日"]


def category(d: str, event: str) -> str:
    digits = " ".join(f"when day({d}) % 10 = {n} then '{n}のつく日'" for n in (0, 1, 6, 8, 9))
    return f"case when {event} then 'LINE告知' when {d} = last_day({d}) then '月末' {digits} else '通常日' end"


def position(col: str, values: list[str]) -> str:
    return f"cast(list_position([{', '.join(repr(v) for v in values)}], {col}) as bigint)"


STUDY = """
study as (
  select hole, machine, target_date, d1_diff, d1_game, d1_payout_rate,
    prev_d2_win_rate as w2, prev_d3_win_rate as w3, prev_d5_win_rate as w5,
    case when d1_diff > 0 then 1 else 0 end as win
  from mart where d1_game > 0),
base as (
  select hole, machine, avg(d1_payout_rate) as bp, avg(win) as bw from study group by all)"""
STUDY_WINDOWS = ["d1", "prev_d2", "prev_d3", "prev_d5"]

CATEGORIZED = f"""
cat as (
  select s.*, {category('s.target_date', 'e.date is not null')} as day_category
  from study s left join event_days e on s.target_date = e.date and s.hole = e.hole)"""

MEASURES = """round(avg(d1_diff), 0) as avg_diff, round(avg(d1_payout_rate), 4) as avg_payout_rate,
    round(avg(win), 4) as avg_win_rate, round(stddev_samp(d1_payout_rate), 4) as stddev_payout_rate,
    round(avg(d1_payout_rate) - any_value(bp), 4) as vs_baseline_payout,
    round(avg(win) - any_value(bw), 4) as vs_baseline_win"""


def streaks(src: str) -> str:
    parts = [
        f"select *, '{n}日間' as period, case when w{n} = 1 then '{n}連勝' else '{n}連敗' end as pattern "
        f"from {src} where w{n} in (0, 1)"
        for n in (2, 3, 5)
    ]
    return "\n  union all ".join(parts)


PATTERNS = ["2連勝", "2連敗", "3連勝", "3連敗", "5連勝", "5連敗"]


# --- strategies ---
RATES = ["d3", "d5", "d7", "d28"]
STRATEGY_WINDOWS = ["d1"] + RATES + ["prev_" + r for r in RATES]


def strategy_list(p: str, best: str, worst: str, day: str, special: str, version: str, literal: bool = False) -> str:
    """Codes of the matched strategies as a list expression.

    literal: a strategy matches by its long or its short condition; only the
    last long condition needs the empty short one.
    """
    le = "<=" if version == "backtest" else "<"
    w, y = f"{p}d28_win_rate", f"{p}d28_payout_rate"
    longs = {
        1: f"{w} >= 0.5", 2: f"{w} >= 0.429 and {w} {le} 0.5", 3: f"{w} >= 0.357 and {w} {le} 0.429", 4: f"{w} < 0.357",
        7: f"{y} >= 1.0447", 8: f"{y} >= 1.0247 and {y} < 1.0447", 9: f"{y} >= 1.0091 and {y} < 1.0247", 10: f"{y} < 1.0091",
        11: f"{best} <= 5", 12: f"{best} between 6 and 10", 13: f"{worst} <= 5", 14: f"{worst} between 6 and 10",
    }
    shorts = {}
    for i, n in enumerate((3, 5, 7)):
        x = f"{p}d{n}_win_rate"
        shorts |= {
            10 * i + 1: f"{x} = 1", 10 * i + 2: f"{x} > 0.75 and {x} {le} 1", 10 * i + 3: f"{x} > 0.5 and {x} <= 0.75",
            10 * i + 4: f"{x} > 0.25 and {x} {le} 0.5", 10 * i + 5: f"{x} > 0 and {x} {le} 0.25", 10 * i + 6: f"{x} = 0",
        }
    u, d = "machine_number % 10", f"day({day})"
    days = {
        30: f"{u} = {d} % 10", 31: f"machine_number % 100 = {d}", 32: f"{u} = ({d} + 1) % 10", 33: f"{u} = ({d} + 9) % 10",
        40: special, 41: f"not {special}",
    }

    def holds(k, a, j, b):
        if not literal:
            return f"({a}) and ({b})"
        if k == 14:
            return a if j == 0 else b
        return a if j == 0 else f"coalesce({a}, false) or coalesce({b}, false)"

    cross = [
        f"case when {holds(k, a, j, b)} then {k * 100 + j} end"
        for k, a in ({0: "true"} | longs).items()
        for j, b in ({0: "true"} | shorts).items()
    ]
    tail = [f"case when {'true' if literal else c} then {k} end" for k, c in days.items()]
    return f"list_filter([{', '.join(cross + tail)}], lambda x: x is not null)"


def special(profile: str, d: str) -> str:
    return (f"coalesce(case {profile} when 'island' then day({d}) in (6, 16, 26) or {d} = last_day({d}) "
            f"when 'espas' then day({d}) in (6, 14, 16, 26) or {d} = last_day({d}) else false end, false)")


def pct(x: str, knots: tuple[float, float, float]) -> str:
    a, b, c = (f"{k}::double" for k in knots)
    return (f"case when {x} is null then null when {x} >= {c} then 1.0::double "
            f"when {x} >= {b} then 0.5 + 0.5 * ({x} - {b}) / ({c} - {b}) "
            f"when {x} >= {a} then 0.25 + 0.25 * ({x} - {a}) / ({b} - {a}) "
            f"else greatest(0.0::double, 0.25 * {x} / {a}) end")


WIN_KNOTS, PAY_KNOTS = (0.357, 0.429, 0.5), (1.0091, 1.0247, 1.0447)
STUDIES = """
studies as (
  select distinct hole, machine, case when hole = 'H0' then 'island' else 'espas' end as sp from unit_days)"""


def ranks(diff: str, best: str, worst: str) -> str:
    keys = "partition by hole, machine, sp, target_date"
    return (f"row_number() over ({keys} order by {diff} desc nulls last, machine_number) as {best}, "
            f"row_number() over ({keys} order by {diff} asc nulls first, machine_number) as {worst}")


EFF = f"({pct('win_rate', WIN_KNOTS)} + {pct('payout_rate', PAY_KNOTS)}) / 2"


def scores(src: str, group: str, relative: bool) -> str:
    """CTEs parts, scored from rows with match_count, weight, pay, win, days, refs."""
    p, v = "p", "v"
    rel = "least((days + refs)::double / max(days + refs) over g, 1.0::double)" if relative else "steps"
    return f"""
parts as (
  select *, case when weight > 0 then pay / weight else 0.0::double end as p,
    case when weight > 0 then win / weight else 0.0::double end as v,
    case when days >= 30 and refs >= 50 then 1.0::double when days >= 20 and refs >= 30 then 0.8::double
      when days >= 10 and refs >= 20 then 0.6::double else 0.4::double end as steps
  from {src}),
factors as (
  select *, sqrt((({pct(v, WIN_KNOTS)}) ^ 2 + ({pct(p, PAY_KNOTS)}) ^ 2) / 2) as rms,
    least(sqrt(match_count) / sqrt(max(match_count) over g), 1.0::double) as freq,
    {rel} as rel,
    case when p > 1.0447::double * 1.05::double and v > 0.5::double * 1.1::double then 1.1::double * 1.1::double
      when p > 1.0447::double * 1.05::double or v > 0.5::double * 1.1::double then 1.1::double else 1.0::double end as anomaly,
    case when p >= 1.0247::double and v >= 0.429::double then 1.1::double else 1.0::double end as dual
  from parts window g as (partition by {group})),
scored as (
  select *, round(case method when 'simple' then rms when 'rms_reliability' then rms * steps
    when 'rms_frequency' then rms * freq when 'rms_frequency_filter' then rms * freq
    when 'rms_frequency_anomaly' then rms * freq * anomaly when 'rms_frequency_dual' then rms * freq * dual
    else rms * rel * freq * anomaly * dual end, 9) as total_score
  from factors)"""


def weighted(filter_sql: str = "") -> str:
    w = "coalesce(n, 1) * coalesce(eff, 1.0::double)"
    f = f" filter (where {filter_sql})" if filter_sql else ""
    return (f"count(*){f} as match_count, sum({w}){f} as weight, sum({w} * coalesce(payout_rate, 0)){f} as pay, "
            f"sum({w} * coalesce(win_rate, 0)){f} as win, cast(sum(coalesce(days, 0)){f} as bigint) as days, "
            f"cast(sum(coalesce(n, 0)){f} as bigint) as refs")


def reco(features: str, literal: bool, methods: list[str]) -> str:
    """CTEs up to `scored` of the recommendation."""
    now_p, b, w = ("", "cb", "cw") if features == "current" else ("prev_", "pb", "pw")
    past = strategy_list("prev_", "pb", "pw", "target_date", special("sp", "target_date"), "recommend", literal)
    now = strategy_list(now_p, b, w, "next_date", special("sp", "next_date"), "recommend", literal)
    plain = "', '".join(m for m in methods if m != "rms_frequency_filter")
    filt = "rms_frequency_filter"
    return f"""{mart(STRATEGY_WINDOWS)}, {STUDIES},
rows0 as (
  select m.*, sp, lead(d1_diff) over u as next_diff, lead(d1_game) over u as next_game
  from mart m join studies using (hole, machine)
  window u as (partition by hole, machine, sp, machine_number order by target_date)),
rows1 as (select *, {ranks('prev_d28_diff', 'pb', 'pw')}, {ranks('d28_diff', 'cb', 'cw')} from rows0),
latest as (select hole, machine, max(target_date) + 1 as next_date from mart group by all),
cur as (select r.*, next_date from rows1 r join latest l using (hole, machine) where target_date = next_date - 1),
hist as (
  select hole, machine, sp, target_date, next_diff, next_game, unnest({past}) as strategy from rows1 r
  where next_game is not null and exists (
    select 1 from cur c where c.hole = r.hole and c.machine = r.machine and c.sp = r.sp and c.machine_number = r.machine_number)),
rec0 as (
  select hole, machine, sp, strategy, count(*) as n, count(distinct target_date) as days,
    avg(case when next_diff > 0 then 1.0::double else 0.0::double end) as win_rate,
    avg({pay('next_game', 'next_diff')}) as payout_rate
  from hist group by all),
rec as (select *, {EFF} as eff from rec0),
hits as (select hole, machine, sp, next_date, machine_number, unnest({now}) as strategy from cur),
joined as (select h.*, r.n, r.days, r.win_rate, r.payout_rate, r.eff from hits h left join rec r using (hole, machine, sp, strategy)),
inputs as (
  select hole, machine, sp, next_date, machine_number, unnest(['{plain}']) as method, {weighted()} from joined
  group by hole, machine, sp, next_date, machine_number
  union all
  select hole, machine, sp, next_date, machine_number, unnest(['{filt}']) as method, {weighted()} from joined
  where eff >= 0.5 group by hole, machine, sp, next_date, machine_number),
{scores('inputs', 'hole, machine, sp, method', False)}"""


def repeats(ctes: str) -> str:
    """The same with the strategies of the empty short condition listed twice."""
    again = "{0} as (select * from {0}1 union all select * from {0}1 where strategy % 100 = 0),"
    ctes = ctes.replace("rec0 as (", again.format("hist") + "\nrec0 as (")
    ctes = ctes.replace("joined as (", again.format("hits") + "\njoined as (")
    return ctes.replace("count(*) as match_count", "count(distinct strategy) as match_count")


def backtest(candidates: int | None = None) -> str:
    """CTEs up to `picks` of the back-test over all days."""
    cut = f"where r.rank <= {candidates}" if candidates else ""
    past = strategy_list("prev_", "pb", "pw", "target_date", special("sp", "target_date"), "backtest")
    now = strategy_list("", "cb", "cw", "next_date", special("sp", "next_date"), "backtest")
    keys = "hole, machine, sp"
    return f"""{mart(STRATEGY_WINDOWS)}, {STUDIES},
rows0 as (select m.*, sp, target_date + 1 as next_date from mart m join studies using (hole, machine) where d1_diff is not null),
rows1 as (select *, {ranks('prev_d28_diff', 'pb', 'pw')}, {ranks('d28_diff', 'cb', 'cw')} from rows0),
hist as (select {keys}, target_date, d1_diff, d1_game, unnest({past}) as strategy from rows1),
daily as (
  select {keys}, strategy, target_date, count(*) as n, count(*) filter (where d1_diff > 0) as wins,
    sum({pay('d1_game', 'd1_diff')}) as pays, count({pay('d1_game', 'd1_diff')}) as npays
  from hist group by all),
hits as (select {keys}, target_date, machine_number, unnest({now}) as strategy from rows1),
every as (
  select {keys}, strategy, target_date, n, wins, pays, npays from daily
  union all
  select distinct {keys}, strategy, target_date, 0, 0, cast(null as double), 0 from hits),
sums as (
  select {keys}, strategy, target_date, sum(n) as n, sum(wins) as wins, sum(pays) as pays, sum(npays) as npays
  from every group by {keys}, strategy, target_date),
run as (
  select {keys}, strategy, target_date, cast(sum(n) over w as bigint) as n, count(*) filter (where n > 0) over w as days,
    (sum(wins) over w)::double / nullif(sum(n) over w, 0) as win_rate,
    (sum(pays) over w) / nullif(sum(npays) over w, 0) as payout_rate
  from sums window w as (partition by {keys}, strategy order by target_date)),
rec as (select *, {EFF} as eff from run where n > 0),
joined as (
  select h.*, r.n, r.days, r.win_rate, r.payout_rate, r.eff
  from hits h left join rec r using ({keys}, strategy, target_date)),
inputs as (
  select {keys}, target_date, machine_number,
    unnest(['original', 'simple', 'rms_reliability', 'rms_frequency', 'rms_frequency_anomaly', 'rms_frequency_dual']) as method,
    {weighted()} from joined group by {keys}, target_date, machine_number
  union all
  select {keys}, target_date, machine_number, unnest(['strategy_filter', 'rms_frequency_filter']) as method,
    {weighted()} from joined where coalesce(eff, 1.0) >= 0.5 group by {keys}, target_date, machine_number),
{scores('inputs', 'hole, machine, sp, method, target_date', True)},
stats as (
  select hole, machine, sp, method, target_date, avg(total_score) as a, stddev_samp(total_score) as s,
    quantile_disc(total_score, 0.25) as q1, quantile_disc(total_score, 0.75) as q3, max(total_score) as top1
  from scored group by all),
ranked as (
  select *, row_number() over (partition by hole, machine, sp, method, target_date
    order by total_score desc nulls last, machine_number) as rank from scored),
picks as (
  select r.hole, r.machine, r.sp, r.method, r.target_date, r.target_date + 1 as evaluation_date, r.machine_number,
    r.total_score, r.rank, top1, round(least(q3 + 1.0 * (q3 - q1), a + 1.5 * coalesce(s, 0)), 9) as cut,
    o.d1_diff as actual_diff, o.d1_game as actual_game, o.d1_diff is not null as has_actual
  from ranked r join stats t using (hole, machine, sp, method, target_date)
  left join rows0 o on o.hole = r.hole and o.machine = r.machine and o.sp = r.sp
    and o.machine_number = r.machine_number and o.target_date = r.target_date + 1
  {cut})"""


BACKTEST_AS_OF = "2001-11-04"
BACKTEST_PERIODS = [14, 28, 60, 120, 5000]

SUMMARY = f"""
rules as (
  select *, unnest(list_filter([
    {', '.join(f"case when rank <= {k} then 'TOP{k}' end" for k in (1, 2, 3, 4, 5))},
    case when total_score >= cut then 'OUTLIER' end,
    {', '.join(f"case when total_score >= top1 * {p / 100}::double then 'THRESHOLD_{p}PCT' end" for p in (80, 85, 90, 95, 96, 97, 98, 99))}
    ], lambda x: x is not null)) as result_key
  from picks where has_actual),
summary as (
  select hole as target_hole, machine as target_machine, d.evaluation_days, sp as special_day_type, method as score_method,
    result_key, count(distinct evaluation_date) as evaluation_days_count, count(*) as total_machines,
    ((200 * count(*) + count(distinct evaluation_date)) // (2 * count(distinct evaluation_date)))::double / 100 as avg_machines_per_day,
    count(*) filter (where actual_diff > 0) as win_days,
    round((count(*) filter (where actual_diff > 0))::double / count(*) * 100, 2) as win_rate,
    cast(sum(actual_diff) as bigint) as total_diff, round(avg(actual_diff), 0) as avg_diff,
    round(avg({pay('actual_game', 'actual_diff')}) * 100, 2) as payout_rate,
    max(actual_diff) as max_diff, min(actual_diff) as min_diff
  from rules join (values {', '.join(f'({n})' for n in BACKTEST_PERIODS)}) d(evaluation_days)
    on target_date >= date '{BACKTEST_AS_OF}' - d.evaluation_days
  group by hole, machine, sp, method, result_key, d.evaluation_days)"""


def build() -> dict[str, str]:
    from . import oracle_more, oracle_studies, registry_store

    q: dict[str, str] = {}

    def add(name, ctes, select):
        q[name] = f"with {ctes}\n{select}"

    # deduplication, renumbering, calendar
    add("dedupe_latest", OBS, f"select date, hole, machine_number, machine, diff, game, win, ts from obs qualify row_number() over (partition by date, hole, machine_number {NEWEST}) = 1")
    add("dedupe_latest_by_id", OBS, f"select id, machine, diff, game, win, ts from obs qualify row_number() over (partition by id {NEWEST}) = 1")
    add("dedupe_collapse", OBS, f"select id, machine, diff, game, win, ts from obs qualify row_number() over (partition by id {OLDEST}) = 1")
    add("dedupe_first", OBS, f"select date, hole, machine_number, source, diff, ts from obs qualify row_number() over (partition by date, hole, machine_number, source {OLDEST}) = 1")
    add("duplicate_report", OBS, "select date, hole, count(*) as total, count(distinct id) as unique_count, count(*) - count(distinct id) as duplicate_count, count(*) > count(distinct id) as has_duplicates from obs group by all")
    add("remap_units", f"{OBS}, ren as ({renumbered('obs')})", "select date, hole, machine_number, count(*) as n, cast(sum(diff) as bigint) as diff from ren group by all")
    d = "date"
    add("calendar_cols", UNITS, f"select date, hole, machine_number, year(date) as target_year, month(date) as target_month, day(date) as target_day, day(date) % 10 as target_day_last_digit, month(date) = day(date) as is_month_day_repdigit, day(date) in (11, 22) as is_day_repdigit, {WEEKDAY.format(d=d)} as day_of_week_jp, {day_type(d)} as day_type from unit_days")
    add("calendar_summary_flags", UNITS, f"select date, hole, machine_number, {WEEKDAY.format(d=d)} as day_of_week, {day_type(d, True)} as day_type, cast(day(date) % 10 as varchar) as last_digit, day(date) in (11, 22) as is_day_repdigit, month(date) = day(date) or month(date) * 11 = day(date) as is_month_day_match, day(date) = 20 as is_anniversary, day(date) = 1 as is_first_day, date = last_day(date) as is_last_day from unit_days")
    add("digit_features", UNITS, "select date, hole, machine_number, day(date) % 10 as date_last_1digit, day(date) as date_last_2digits, machine_number % 10 as machine_last_1digit, machine_number % 100 as machine_last_2digits from unit_days")
    add("special_days", UNITS, f"select date, hole, {special('sp', 'date')} as is_special_day, count(*) as n from (select *, case when hole = 'H0' then 'island' else 'espas' end as sp from unit_days) group by all")

    # mart
    incl = [p for p in PREFIXES if p not in ("mtd", "all")]
    for name, ps in {
        "mart_incl": incl,
        "mart_excl": ["prev_" + p for p in incl],
        "mart_mtd_all": ["mtd", "all", "prev_mtd", "prev_all"],
        "mart_full": PREFIXES + ["prev_" + p for p in PREFIXES],
    }.items():
        head = HEAD if name == "mart_full" else "target_date, hole, machine_number, machine, start_date"
        add(name, mart(ps), f"select {head}, {mart_cols(ps)} from mart")
    add("unit_stats_latest", mart(PREFIXES), f"select hole, machine_number, machine, target_date, start_date, end_date, {mart_cols(PREFIXES)} from mart where (hole, target_date) in (select (hole, max(target_date)) from mart group by hole)")

    # summaries
    heat = f"""{OBS},
one as (select * from obs qualify row_number() over (partition by id {NEWEST}) = 1),
ren as ({renumbered('one')}),
agg as (
  select hole, machine, machine_number, sum(diff)::double / count(*) as avg_diff, sum(win)::double / count(*) as win_rate,
    min(date) as date_from, max(date) as date_to, {pay('sum(game)', 'sum(diff)')} as payout_rate
  from ren where game > 0 {{cond}} group by all)"""
    out = "select hole, machine, machine_number, avg_diff, win_rate, date_from, date_to, payout_rate from agg qualify date_to = max(date_to) over (partition by hole, machine_number)"
    add("heatmap_all", heat.format(cond=""), out)
    cond = f"and ('土日' like '%' || {WEEKDAY.format(d=d)} || '%' or '祝日' like '%' || ({day_type(d)}) || '%' or '06' like '%' || (day(date) % 10) || '%' or month(date) = day(date))"
    add("heatmap_special", heat.format(cond=cond), out)
    fam = [
        ("'全期間'", "'全期間'", "true"), ("'曜日'", WEEKDAY.format(d=d), "true"), ("'日種別'", day_type(d, True), "true"),
        ("'下一桁'", "(day(date) % 10) || 'のつく日'", "true"), ("'日ゾロ目'", "'ゾロ目日(11,22)'", "day(date) in (11, 22)"),
        ("'月日ゾロ'", "'月日ゾロ'", "month(date) = day(date) or month(date) * 11 = day(date)"),
        ("'周年日'", "'月周年日(20日)'", "day(date) = 20"), ("'月初'", "'月初(1日)'", "day(date) = 1"), ("'月末'", "'月末'", "date = last_day(date)"),
    ]
    union = "\n  union all ".join(f"select {a} as condition_type, {b} as condition_value, * from one where {c}" for a, b, c in fam)
    add("condition_summary", f"{OBS}, one as (select * from obs where game > 0 qualify row_number() over (partition by id {NEWEST}) = 1), spread as ({union})",
        f"select condition_type, condition_value, hole, machine, min(date) as period_from, max(date) as period_to, count(distinct date) as sample_days, count(*) as sample_units, cast(sum(diff) as bigint) as total_diff, sum(diff)::double / count(*) as avg_diff, cast(sum(game) as bigint) as total_game, sum(win)::double / count(*) as win_rate, {pay('sum(game)', 'sum(diff)')} as payout_rate from spread group by condition_type, condition_value, hole, machine")

    # studies
    m = mart(STUDY_WINDOWS)
    add("study_baseline", f"{m}, {STUDY}", "select hole, machine, round(bp, 6) as baseline_payout_rate, round(bw, 6) as baseline_win_rate from base")
    add("day_category_effect", f"{m}, {EVENTS}, {STUDY}, {CATEGORIZED}", f"select hole, machine, day_category, count(distinct target_date) as sample_days, count(*) as sample_records, cast(sum(d1_game) as bigint) as total_game, {MEASURES}, {position('day_category', CATEGORIES)} as sort_order from cat join base using (hole, machine) group by hole, machine, day_category")
    fan = CATEGORIZED.replace("event_days e", "event_rows e")
    add("day_category_effect_fanout", f"{m}, {EVENT_ROWS}, {STUDY}, {fan}, fbase as (select hole, machine, avg(d1_payout_rate) as bp, avg(win) as bw from cat group by all)", f"select hole, machine, day_category, count(distinct target_date) as sample_days, count(*) as sample_records, cast(sum(d1_game) as bigint) as total_game, {MEASURES}, {position('day_category', CATEGORIES)} as sort_order from cat join fbase using (hole, machine) group by hole, machine, day_category")
    add("streak_effect", f"{m}, {STUDY}, s as ({streaks('study')})", f"select hole, machine, period, pattern as streak_pattern, count(*) as sample_count, {MEASURES}, {position('period', ['2日間', '3日間', '5日間'])} as period_order, cast(case when pattern like '%連勝' then 1 else 2 end as bigint) as pattern_order from s join base using (hole, machine) group by hole, machine, period, pattern")
    add("combined_effect", f"{m}, {EVENTS}, {STUDY}, {CATEGORIZED}, s as ({streaks('cat')}), t as (select * from s union all select * replace ('すべての日' as day_category) from s)", f"select hole, machine, day_category, pattern as streak_pattern, count(*) as sample_count, {MEASURES}, {position('day_category', CATEGORIES)} as day_sort, {position('pattern', PATTERNS)} as streak_sort from t join base using (hole, machine) group by hole, machine, day_category, pattern")
    for name, p in {"tier_recommend": "prev_", "tier_recommend_current": ""}.items():
        pat = ", ".join(f"case when w{n} = 1 then '{n}連勝' when w{n} = 0 then '{n}連敗' end as d{n}_pattern" for n in (2, 3, 5))
        add(name, f"""{mart([p + w for w in ('d2', 'd3', 'd5')])}, {EVENTS},
l as (select hole, machine, max(target_date) as ld from mart group by all),
x as (select hole, machine, machine_number, ld, ld + 1 as td, {', '.join(f'{p}d{n}_win_rate as w{n}' for n in (2, 3, 5))}
  from mart join l using (hole, machine) where target_date = ld),
c as (select x.*, {category('td', 'e.date is not null')} as c, {pat} from x left join event_days e on e.date = td and e.hole = x.hole),
r as (select *, case when c in ('0のつく日', '1のつく日') then (0, '対象外（避けるべき日）')
  when c = '8のつく日' and d3_pattern = '3連敗' then (5, '8のつく日+3連敗 (108.81%)') when c = '8のつく日' and d5_pattern = '5連敗' then (5, '8のつく日+5連敗 (108.30%)')
  when c = 'LINE告知' and d5_pattern = '5連敗' then (5, 'LINE告知+5連敗 (108.15%)') when c = '月末' and d3_pattern = '3連敗' then (4, '月末+3連敗 (107.80%)')
  when d5_pattern = '5連勝' then (4, c || '+5連勝 (107.24%)') when c = 'LINE告知' and d3_pattern = '3連勝' then (4, 'LINE告知+3連勝 (106.82%)')
  when c = '月末' and d2_pattern = '2連敗' then (4, '月末+2連敗 (106.09%)') when c = 'LINE告知' and d3_pattern = '3連敗' then (3, 'LINE告知+3連敗 (106.01%)')
  when c = 'LINE告知' and d2_pattern = '2連勝' then (3, 'LINE告知+2連勝 (105.45%)') when c = 'LINE告知' then (2, 'LINE告知のみ (103.99%)')
  when c = '月末' then (2, '月末のみ (103.86%)') when d3_pattern = '3連勝' then (1, '3連勝のみ (103.53%)') when d3_pattern = '3連敗' then (1, '3連敗のみ (103.68%)')
  else (0, '対象外') end as t from c)""",
            "select td as target_date, ld as data_latest_date, hole, machine, c as day_category, machine_number, t[1] as priority_rank, t[2] as strategy_name, round(w2, 2) as d2_win_rate, round(w3, 2) as d3_win_rate, round(w5, 2) as d5_win_rate, d2_pattern, d3_pattern, d5_pattern from r where t[1] > 0")

    # strategies
    methods = ["original", "simple", "rms_reliability", "rms_frequency", "rms_frequency_filter", "rms_frequency_anomaly", "rms_frequency_dual", "strategy_filter"]
    r = reco("current", False, methods)
    add("strategy_match", r, "select hole, machine, sp as special_day_type, strategy, count(*) as matched_units from hits group by all")
    add("strategy_record", r, "select hole, machine, sp as special_day_type, strategy, n as ref_count, days, win_rate as rec_win_rate, round(payout_rate, 6) as rec_payout_rate, round(eff, 6) as effectiveness from rec")
    parts = "match_count, round(p, 6) as weighted_payout_rate, round(v, 6) as weighted_win_rate, round(rms, 6) as rms, round(freq, 6) as frequency_bonus, round(rel, 6) as reliability_score, round(anomaly, 6) as anomaly_bonus, dual as dual_high_bonus"
    add("strategy_scores", r, f"select hole, machine, sp as special_day_type, method as score_method, next_date as target_date, machine_number, {parts}, total_score from scored")
    final = """select hole, machine, sp as special_day_type, method as score_method, next_date as target_date, machine_number,
  case when ratio >= 0.99 then 5 when ratio >= 0.97 then 4 when ratio >= 0.95 then 3 when ratio >= 0.9 then 2 when ratio >= 0.8 then 1 else 0 end as priority_rank,
  total_score, ratio as top1_ratio, cast(rank as integer) as rank, match_count
from (select *, round(total_score / nullif(max(total_score) over g, 0), 9) as ratio,
  row_number() over (partition by hole, machine, sp, method order by total_score desc nulls last, machine_number) as rank
  from scored window g as (partition by hole, machine, sp, method))"""
    add("strategy_recommend", r, final)
    add("strategy_recommend_prev", reco("prev", False, methods), final)
    add("strategy_recommend_literal", reco("prev", True, methods), final)
    twice = r.replace("hits as (select", "hits1 as (select").replace("hist as (", "hist1 as (")
    q["strategy_recommend_repeats"] = f"with {repeats(twice)}\n{final}"

    # back-test
    b = backtest()
    add("backtest_record", b, "select hole, machine, sp as special_day_type, strategy, target_date, n as ref_count, days, win_rate as rec_win_rate, round(payout_rate, 6) as rec_payout_rate, round(eff, 6) as effectiveness from rec where (hole, machine, sp, strategy, target_date) in (select (hole, machine, sp, strategy, target_date) from hits)")
    add("backtest_picks", b, "select hole, machine, sp as special_day_type, method as score_method, target_date, evaluation_date, machine_number, total_score, cast(rank as integer) as rank, top1 as top1_score, cut as outlier_threshold, actual_diff, actual_game from picks")
    s = f"{b}, {SUMMARY}"
    add("backtest_summary", s, "select *, cast(null as varchar) as result_detail from summary")
    keys = "target_hole, target_machine, evaluation_days, special_day_type"
    piv = ["TOP1"] + [f"THRESHOLD_{p}PCT" for p in (95, 96, 97, 98, 99)]
    cells = ", ".join(f"max({c}) filter (where result_key = '{k}') as \"{k}_{c}\"" for k in piv for c in ("win_rate", "payout_rate", "avg_machines_per_day"))
    add("method_matrix", s, f"select {keys}, score_method, {cells} from summary group by all having count(*) filter (where result_key = 'TOP1') > 0")
    best = lambda a, key, lo, hi: f"""{a} as (select {keys}, score_method as {a}_method, payout_rate as {a}_payout, avg_machines_per_day as {a}_units from summary
  where result_key = '{key}' and avg_machines_per_day between {lo} and {hi} and payout_rate > -1
  qualify row_number() over (partition by {keys} order by payout_rate desc, score_method) = 1)"""
    add("best_method", f"{s}, {best('top1', 'TOP1', 0, 100)}, {best('th98', 'THRESHOLD_98PCT', 1, 2)}, {best('th99', 'THRESHOLD_99PCT', 1, 1.5)}",
        f"select {keys}, top1_method, top1_payout, th98_method, th98_payout, th98_units, th99_method, th99_payout, th99_units, round(top1_payout - th98_payout, 2) as top1_th98_gap, abs(top1_payout - th98_payout) < 1 as gap_below_one from top1 left join th98 using ({keys}) left join th99 using ({keys})")
    side = lambda n: f"(select target_hole, target_machine, special_day_type, score_method, max(nullif(payout_rate, 0)) filter (where result_key = 'TOP1') as t, max(nullif(payout_rate, 0)) filter (where result_key = 'THRESHOLD_99PCT') as h from summary where evaluation_days = {n} group by all having count(*) filter (where result_key = 'TOP1') > 0)"
    add("period_compare", s, f"select target_hole, target_machine, special_day_type, score_method, a.t as short_top1, b.t as long_top1, round(b.t - a.t, 2) as top1_change, a.h as short_th99, b.h as long_th99, round(b.h - a.h, 2) as th99_change from {side(60)} a full join {side(120)} b using (target_hole, target_machine, special_day_type, score_method)")
    grade = "case when win_rate > 60 and payout_rate > 108 then '非常に高い' when win_rate > 55 and payout_rate > 105 then '高い' when win_rate > 50 and payout_rate > 102 then '中程度' when win_rate > 45 and payout_rate > 100 then '低い' else '非常に低い' end"
    add("reliability_grade", s, f"select {keys}, score_method, win_rate, payout_rate, case when win_rate > 60 and payout_rate > 108 then 5 when win_rate > 55 and payout_rate > 105 then 4 when win_rate > 50 and payout_rate > 102 then 3 when win_rate > 45 and payout_rate > 100 then 2 else 1 end as stars, {grade} as grade from summary where result_key = 'TOP1'")
    add("backtest_summary_top10", f"{backtest(10)}, {SUMMARY}", "select *, cast(null as varchar) as result_detail from summary")
    pay_of = ", ".join(f"max(payout_rate) filter (where evaluation_days = {n}) as payout_{n}" for n in (14, 28, 60))
    add("recent_trend", s, f"select *, coalesce(payout_14 > payout_28 and payout_28 > payout_60, false) as rising from (select target_hole, target_machine, special_day_type, score_method, {pay_of} from summary where result_key = 'TOP1' group by all)")
    levels = ", ".join(f"round(max(total_score) * {p / 100}::double, 9) as threshold_{p}" for p in (80, 85, 90, 95, 96, 97, 98, 99))
    add("score_stats", b, f"select hole, machine, sp as special_day_type, method as score_method, target_date, count(*) as units, min(total_score) as min_score, max(total_score) as max_score, round(median(total_score), 9) as median_score, round(avg(total_score), 6) as avg_score, round(stddev_samp(total_score), 6) as stddev_score, quantile_disc(total_score, 0.25) as q1_score, quantile_disc(total_score, 0.75) as q3_score, max(total_score) as top1_score, {levels} from scored group by all")

    for name, (ctes, select) in (oracle_more.build() | registry_store.build() | oracle_studies.build()).items():
        add(name, ctes, select)
    return q
