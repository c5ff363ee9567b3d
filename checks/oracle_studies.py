"""SQL counterparts of the pair and group studies: self-joins and a recursive closure."""

from __future__ import annotations

from .oracle import IS_HOLIDAY, mart

PAIRS = """pairs as (
  select a.hole, a.machine, a.machine_number as a, b.machine_number as b, count(*) as days,
    round(corr(a.d1_payout_rate, b.d1_payout_rate), 9) as r,
    count(*) filter (where a.d1_diff > 0 and b.d1_diff > 0) as wins
  from mart a join mart b on a.hole = b.hole and a.machine = b.machine and a.target_date = b.target_date
    and a.machine_number <> b.machine_number
  group by all having count(*) >= 30)"""

GROUPS = """links as (select hole, machine, a, b from pairs where r > 0.1),
reach as (
  select hole, machine, a, b from links
  union select r.hole, r.machine, r.a, l.b from reach r join links l on l.hole = r.hole and l.machine = r.machine and l.a = r.b),
member as (select hole, machine, a as machine_number, least(a, min(b)) as group_id from reach group by hole, machine, a),
grp as (select *, count(*) over (partition by hole, machine, group_id) as group_size from member)"""


def build() -> dict[str, tuple[str, str]]:
    d1 = mart(["d1"])
    best = "partition by hole, machine, a order by r desc nulls last, b"
    q = {}
    q["same_day_partners"] = (f"""{d1}, {PAIRS},
ranked as (select *, row_number() over ({best}) as k, count(*) over (partition by hole, machine, a) as partners,
  count(*) filter (where r > 0.5) over (partition by hole, machine, a) as strong_partners from pairs)""",
        """select hole, machine, a as machine_number, partners, strong_partners, b as best_partner, round(r, 6) as best_correlation,
  days as common_days, round(wins / days, 6) as both_win_rate from ranked where k = 1""")
    q["next_day_successors"] = (f"""{d1},
steps as (
  select a.hole, a.machine, a.machine_number as a, b.machine_number as b, count(*) as days,
    round(count(*) filter (where a.d1_diff < 0 and b.d1_diff > 0) / nullif(count(*) filter (where a.d1_diff < 0), 0), 9) as r,
    count(*) filter (where a.d1_diff > 0 and b.d1_diff > 0) / nullif(count(*) filter (where a.d1_diff > 0), 0) as again
  from mart a join mart b on a.hole = b.hole and a.machine = b.machine and b.target_date = a.target_date + 1
  group by all having count(*) >= 30),
ranked as (select *, row_number() over ({best}) as k, count(*) over (partition by hole, machine, a) as successors from steps)""",
        """select hole, machine, a as machine_number, successors, b as best_successor, round(r, 6) as rotation_rate,
  round(again, 6) as next_day_win_rate, days as day_pairs from ranked where k = 1""")
    q["correlated_groups"] = (f"recursive {d1}, {PAIRS}, {GROUPS}", "select * from grp")
    q["correlated_group_days"] = (f"""recursive {d1}, {PAIRS}, {GROUPS},
gd as (select hole, machine, group_id, target_date, count(*) as units, round(avg(d1_payout_rate), 9) as p,
  avg(case when d1_diff > 0 then 1.0::double when d1_diff is not null then 0 end) as w
  from mart join grp using (hole, machine, machine_number) group by all)""",
        """select hole, machine, group_id, target_date, units, round(p, 6) as avg_payout_rate, round(w, 6) as win_rate,
  round(lag(p) over (partition by hole, machine, group_id order by target_date), 6) as group_momentum from gd""")
    q["national_holidays"] = (
        "o as (select cast(o_orderdate as date) as date from orders)",
        f"select date, count(*) as orders from o where {IS_HOLIDAY.format(d='date')} group by date",
    )
    return q
