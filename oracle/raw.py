"""The telemetry views, as SQL text."""

from __future__ import annotations

import re
from collections.abc import Callable

K = "make, batch, cell_no, max_cap"
ORDER = (
    "absolute_time nulls first, cycler_step_no nulls first, capacity_ah nulls first, volt_v nulls first, "
    "current_a nulls first"
)
MICROS = "epoch_us(absolute_time)"


def telemetry(*tests: str) -> str:
    """CTE ``raw`` still to be filled in: samples of ``tests``, or of all; see ``filled``."""
    return f"raw as (select * from telemetry_of('{','.join(tests)}'))"


def filled(sql: str, source: Callable[..., str]) -> str:
    """SQL whose telemetry comes from ``source(*tests)``, the text of a CTE ``raw``."""
    return re.sub(r"raw as \(select \* from telemetry_of\('([^']*)'\)\)", lambda m: source(*filter(None, m[1].split(","))), sql)


EVENTS = """
raw as (
  select lpad(cast(user_id as varchar), 8, '0') as cell_no, cast(day(ts) as integer) as cycle_no,
    cast(null as integer) as cycler_step_no,
    case event_type when 'click' then 'CC_Chg' when 'view' then 'CC_DChg' when 'purchase' then 'Rest'
      when 'signup' then 'CP_DChg' else 'CCCV_Chg' end as step_name,
    ts as absolute_time, cast(3.2 as double) + value / cast(1000 as double) as volt_v,
    case when event_type = 'purchase' then 0.0 when event_type in ('view', 'signup') then -1.0 else 1.0 end
      * value / cast(10 as double) as current_a,
    case when event_type = 'purchase' then 0.0 when event_type in ('view', 'signup') then -1.0 else 1.0 end
      * value / cast(100 as double) as capacity_ah,
    cast(null as varchar) as crate, cast(null as varchar) as drate, cast(null as varchar) as dod,
    cast(5 as double) as max_cap,
    case when user_id % 3 = 0 then 'RPT' else 'Longterm' end as test,
    'MAKE' || cast(user_id % 4 as varchar) as make, cast(user_id % 2 as varchar) as batch
  from events
)"""

def lineitem(*tests: str) -> str:
    """CTE ``raw``: orders as steps, their lines as samples, of each of the tests."""
    width = "case test when 'HPPC' then 1000 when 'DCIR' then 400 when 'PeakPower' then 600 when 'GITT' then 30000 else 60000 end"
    sign = "case o_orderkey % 4 when 1 then cast(0 as double) when 2 then cast(1 as double) else cast(-1 as double) end"
    return f"""
raw as (
  select lpad(cast(o_custkey // 15 as varchar), 8, '0') as cell_no, cast(o_orderkey % 5 as integer) as cycle_no,
    case when (o_custkey // 15) % 4 <> 0 then cast(case when test = 'OCVSOC' then o_orderkey % 12 else o_orderkey end as integer) end as cycler_step_no,
    case o_orderkey % 4 when 0 then 'CC_DChg' when 1 then 'Rest' when 2 then 'CC_Chg' else 'CP_DChg' end as step_name,
    make_timestamp((o_orderkey * 16000000 + cast(l_quantity as bigint) * case when o_orderkey % 4 = 1 then 300000 else {width} end
      + l_linenumber) * 1000) as absolute_time,
    cast(3 as double) + l_quantity / cast(100 as double) + l_extendedprice * cast(1.2345678e-7 as double) as volt_v,
    {sign} * (cast(1 as double) + round(l_discount * cast(100 as double))) as current_a,
    {sign} * l_quantity / cast(50 as double) * cast(4.5 as double) as capacity_ah,
    case l_returnflag when 'R' then l_linenumber || '.25C' when 'A' then 'C/n' end as crate,
    case when l_returnflag <> 'A' then '0.' || l_linenumber || 'D' end as drate, cast(null as varchar) as dod,
    case when (o_custkey // 15) % 10 <> 9 then cast(5 as double) end as max_cap, test,
    'MAKE' || cast((o_custkey // 15) % 4 as varchar) as make, cast((o_custkey // 15) % 2 as varchar) as batch
  from orders join lineitem on o_orderkey = l_orderkey, unnest([{", ".join(f"'{t}'" for t in tests)}]) as t(test)
)"""


#: CTE ``raw``: order keys as time; blocks of 256 keys are pulses and rests in turn, and a cell is sixteen of them.
RELAXING = """
raw as (
  select 'R' || lpad(cast(l_orderkey // 4096 as varchar), 7, '0') as cell_no, cast(l_orderkey % 4096 // 256 as integer) as cycle_no,
    cast(null as integer) as cycler_step_no, case when pulse then 'CC_DChg' else 'Rest' end as step_name,
    make_timestamp(((l_orderkey // 256) * 20000000 + ms) * 1000) as absolute_time,
    round(case when pulse then cast(3.1 as double) - ms * cast(5e-8 as double)
      else cast(3.2 as double) + a * (1 - exp(-(ms / cast(1000 as double)) / tau)) end + l_discount * cast(1e-4 as double), 6) as volt_v,
    case when pulse then -(cast(2 as double) + l_orderkey // 4096 % 3) else cast(0 as double) end as current_a,
    case when pulse then -(cast(2 as double) + l_orderkey // 4096 % 3) else cast(0 as double) end * ms / cast(3600000 as double) as capacity_ah,
    cast(null as varchar) as crate, cast(null as varchar) as drate, cast(null as varchar) as dod, cast(5 as double) as max_cap,
    'GITT' as test, 'MAKE9' as make, '0' as batch
  from (select *, l_orderkey // 256 % 2 = 0 as pulse, cast(0.05 as double) + cast(0.01 as double) * (l_orderkey // 4096 % 10) as a,
      cast(150 as double) + 250 * (l_orderkey // 256 % 8) as tau,
      case when l_orderkey // 256 % 2 = 0 then l_orderkey % 256 * 4000 + l_linenumber * 500
        else (l_orderkey % 256 * 8 + l_linenumber) * (l_orderkey % 256 * 8 + l_linenumber) * 3 end as ms
    from lineitem)
)"""

OTHER_TESTS = ["HPPC", "OCVSOC", "DCIR", "RateCapability", "SelfDischarge", "PeakPower", "ConstantPower", "RPT", "Longterm"]


def all_of(*tests: str) -> str:
    """CTE ``raw``: order lines as samples, relaxations for GITT; all protocols if none is named."""
    if tests == ("GITT",):
        return RELAXING
    if tests:
        return lineitem(*tests)
    lines, rests = lineitem(*OTHER_TESTS).strip(), RELAXING.strip()
    return f"raw as (with {lines.replace('raw as', 'lines as', 1)}, {rests.replace('raw as', 'rests as', 1)} select * from lines union all select * from rests)"


# steps in time order: runs of equal (cycle, name)
ISLANDS = f"""
flagged as (
  select *, case when row_number() over w > 1 and cycle_no is not distinct from lag(cycle_no) over w
      and step_name is not distinct from lag(step_name) over w then 0 else 1 end as is_new,
    row_number() over w as idx
  from raw window w as (partition by {K} order by {ORDER})
),
labelled as (
  select *, sum(is_new) over (partition by {K} order by idx rows unbounded preceding) as block from flagged
),
steps as (
  select {K}, block, cycle_no, step_name, count(*) as n_rows, min(absolute_time) as start_time,
    max(absolute_time) as end_time, arg_min(volt_v, idx) filter (volt_v is not null) as start_volt_v,
    arg_max(volt_v, idx) filter (volt_v is not null) as end_volt_v, avg(current_a) as current_mean_a,
    abs(arg_max(capacity_ah, idx) filter (capacity_ah is not null)
      - arg_min(capacity_ah, idx) filter (capacity_ah is not null)) as step_capacity_ah,
    (epoch_us(max(absolute_time)) - epoch_us(min(absolute_time))) / cast(1000000 as double) as duration_s,
    avg(abs(volt_v * current_a)) as power_w, count(current_a) as n_current
  from labelled group by {K}, block, cycle_no, step_name
)"""

# steps by native number, or by runs of equal names in cells without numbers
NUMBERED = f"""
flagged as (
  select *, max(case when cycler_step_no is not null then 1 else 0 end) over (partition by {K}) as native,
    case when row_number() over w > 1 and step_name is not distinct from lag(step_name) over w then 0 else 1 end as is_new,
    row_number() over w as idx
  from raw window w as (partition by {K} order by {ORDER})
),
labelled as (
  select * from (
    select *, case when native = 1 then cycler_step_no
      else sum(is_new) over (partition by {K} order by idx rows unbounded preceding) end as step_no from flagged)
  where step_no is not null
),
steps as (
  select {K}, step_no, arg_min(step_name, idx) filter (step_name is not null) as step_name,
    arg_min(cycle_no, idx) filter (cycle_no is not null) as cycle_no, count(volt_v) as n_samples,
    min(absolute_time) as t_start, max(absolute_time) as t_end,
    arg_min(volt_v, idx) filter (volt_v is not null) as v_first,
    arg_max(volt_v, idx) filter (volt_v is not null) as v_last,
    avg(abs(current_a)) as i_abs_mean, avg(current_a) as i_mean, max(abs(capacity_ah)) as q_max,
    (epoch_us(max(absolute_time)) - epoch_us(min(absolute_time))) / cast(1000000 as double) as duration_s
  from labelled group by {K}, step_no
)"""

# state of charge before each step: a clamped fold, so recursive
SOC = f"""
deltas as (
  select *, case when current_mean_a is null or abs(current_mean_a) < 1e-6 then 0.0
    when step_capacity_ah is null or step_capacity_ah < 1e-6 then
      case when duration_s > 0 then current_mean_a * duration_s / 3600.0 / max_cap else 0.0 end
    else sign(current_mean_a) * step_capacity_ah / max_cap end as delta
  from steps where max_cap > 0
),
fold as (
  select make, batch, cell_no, max_cap, block, cast(1.0 as double) as soc, cast(delta as double) as delta
  from deltas where block = 1
  union all
  select d.make, d.batch, d.cell_no, d.max_cap, d.block,
    greatest(least(f.soc + f.delta, cast(1.0 as double)), cast(0.0 as double)), cast(d.delta as double)
  from fold f join deltas d on f.make = d.make and f.batch = d.batch and f.cell_no = d.cell_no
    and f.max_cap = d.max_cap and d.block = f.block + 1
)"""


def half_even(x: str, digits: int = 0) -> str:
    return f"round_even({x}, 0)" if digits == 0 else f"round_even(({x}) * 1e{digits}, 0) / 1e{digits}"


def with_(*ctes: str, recursive: bool = False) -> str:
    return "with " + ("recursive " if recursive else "") + ",".join(ctes) + "\n"


def rounded(cols: list[str], digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) as {c.split('.')[-1]}" for c in cols)
