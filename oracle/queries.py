"""Query name -> oracle SQL."""

from __future__ import annotations

from oracle.raw import EVENTS, ISLANDS, K, NUMBERED, ORDER, SOC, all_of, filled, half_even, lineitem, rounded, telemetry, with_

ORACLES: dict[str, str] = {}
#: SQL over telemetry that is still to be filled in.
TEMPLATES: dict[str, str] = {}

CYCLES = f"""
step_level as (
  select {K}, cycle_no, phase, step_id, max(abs(capacity_ah)) as cap, avg(volt_v) as v, max(volt_v) as vmax,
    min(volt_v) as vmin
  from (select *, case when lower(step_name) like '%dchg%' then 'dchg' when lower(step_name) like '%chg%' then 'chg'
      else 'other' end as phase, coalesce(cast(cycler_step_no as varchar), step_name) as step_id from raw)
  where phase <> 'other' group by {K}, cycle_no, phase, step_id
),
cycles as (
  select {K}, cycle_no, sum(cap) filter (phase = 'chg') as chg_cap_ah, avg(v) filter (phase = 'chg') as avg_chg_v,
    max(vmax) filter (phase = 'chg') as chg_v_max, sum(cap) filter (phase = 'dchg') as dchg_cap_ah,
    avg(v) filter (phase = 'dchg') as avg_dchg_v, min(vmin) filter (phase = 'dchg') as dchg_v_min
  from step_level group by {K}, cycle_no
)"""
_CYCLE_OUT = f"""
select {K}, cycle_no, {rounded(['chg_cap_ah', 'avg_chg_v', 'chg_v_max', 'dchg_cap_ah', 'avg_dchg_v', 'dchg_v_min'], 9)},
  round(case when chg_cap_ah > 0 then dchg_cap_ah / chg_cap_ah end, 9) as coulombic_eff
from cycles"""

TEMPLATES["cycle_agg"] = with_(telemetry("RPT", "Longterm"), CYCLES) + _CYCLE_OUT
ORACLES["cycle_agg_events"] = with_(EVENTS, CYCLES) + _CYCLE_OUT

_ENERGY = f"""
corners as (
  select *, lag(us) over w as us0, lag(p) over w as p0 from (
    select {K}, cycle_no, case when lower(step_name) like '%dchg%' then 'out' else 'in' end as moves,
      coalesce(cast(cycler_step_no as varchar), step_name) as step, epoch_us(absolute_time) as us, volt_v * abs(current_a) as p,
      absolute_time, cycler_step_no, capacity_ah, volt_v, current_a
    from raw where lower(step_name) like '%chg%')
  window w as (partition by {K}, cycle_no, moves, step order by {ORDER})
),
energies as (
  select {K}, cycle_no, sum((us - us0) / cast(1000000 as double) * (p + p0) / 2) filter (moves = 'in') as e_in,
    sum((us - us0) / cast(1000000 as double) * (p + p0) / 2) filter (moves = 'out') as e_out,
    count(*) filter (moves = 'in') as n_in, count(*) filter (moves = 'out') as n_out, max(volt_v) as top, min(volt_v) as bottom
  from corners group by {K}, cycle_no
)"""
_ENERGY_OUT = """
round(case when n_in > 0 then coalesce(e_in, 0) / 3600 end, 6) as chg_energy_wh, round(case when n_out > 0 then coalesce(e_out, 0) / 3600 end, 6) as dchg_energy_wh,
  round(top, 6) as v_max, round(bottom, 6) as v_min"""
ORACLES["cycle_energy_lineitem"] = with_(lineitem("RPT"), _ENERGY) + f"select {K}, cycle_no, {_ENERGY_OUT} from energies"
ORACLES["cycle_energy_events"] = with_(EVENTS, _ENERGY) + f"select {K}, cycle_no, {_ENERGY_OUT} from energies"
_SAME = " and ".join(f"c.{k} is not distinct from e.{k}" for k in ("make", "batch", "cell_no", "max_cap", "cycle_no"))
ORACLES["cycles_with_energy_lineitem"] = with_(lineitem("Longterm"), CYCLES, _ENERGY) + f"""
select c.*, round(case when chg_cap_ah > 0 then dchg_cap_ah / chg_cap_ah end, 3) as coulombic_eff, {_ENERGY_OUT}
from (select {K}, cycle_no, {rounded(['chg_cap_ah', 'avg_chg_v', 'chg_v_max', 'dchg_cap_ah', 'avg_dchg_v', 'dchg_v_min'], 6)} from cycles) c
join energies e on {_SAME}"""

TEMPLATES["state_of_health"] = with_(telemetry("RPT"), CYCLES) + f"""
select {K}, round(max(dchg_cap_ah), 6) as q_rpt_ah, round(max(chg_cap_ah), 6) as q_rpt_chg_ah,
  round(case when max_cap > 0 then max(dchg_cap_ah) / max_cap * 100.0 end, 6) as Soh
from cycles group by {K}"""

TEMPLATES["rpt_c_rate"] = with_(telemetry("RPT")) + f"""
select {K}, round(arg_min(rate, absolute_time), 6) as rpt_protocol_c_rate from (
  select *, try_cast(regexp_extract(coalesce(crate, drate), '([0-9]*\\.?[0-9]+)', 1) as double) as rate from raw)
where rate is not null group by {K}"""

_USABLE = "usable as (select * from steps where max_cap > 0)"


def _rate(chg: str) -> str:
    return with_(telemetry("RateCapability"), ISLANDS, _USABLE) + f"""
select {K}, direction, c_rate, round(median(step_capacity_ah), 6) as q_ah, cast(null as double) as energy_wh from (
  select *, {half_even('abs(current_mean_a) / max_cap', 2)} as c_rate, unnest(case
      when lower(step_name) like '%dchg%' and ({chg}) then ['dchg', 'chg']
      when lower(step_name) like '%dchg%' then ['dchg'] when {chg} then ['chg'] end) as direction
  from usable where lower(step_name) not like '%cp%' and step_capacity_ah >= 0.5 * max_cap)
group by {K}, direction, c_rate"""


TEMPLATES["rate_capability"] = _rate("lower(step_name) like '%chg%'")
TEMPLATES["rate_capability_strict"] = _rate("lower(step_name) like '%chg%' and lower(step_name) not like '%dchg%'")

_SD = f"""
near as (
  select *, lag(step_name) over w as p_name, lag(q_max) over w as p_q, lead(step_name) over w as n_name,
    lead(q_max) over w as n_q from steps window w as (partition by {K} order by step_no)
),
rest as (
  select *, case when contains(p_name, 'Chg') then p_q end as q_before,
    case when contains(n_name, 'DChg') then n_q end as q_after from near
  where step_name = 'Rest' and duration_s >= 3600
  qualify row_number() over (partition by {K} order by duration_s desc, step_no) = 1
)"""
TEMPLATES["self_discharge"] = with_(telemetry("SelfDischarge"), NUMBERED, _SD) + f"""
select {K}, round(duration_s, 6) as rest_duration_s, round(v_first, 6) as v_start, round(v_last, 6) as v_end,
  round((v_last - v_first) / (duration_s / 3600.0) * 1000.0, 6) as "dv_dt_mV_per_h",
  round(q_after, 6) as q_recovered_ah,
  round(case when q_before > 0 then q_after / q_before * 100.0 end, 6) as retention_pct,
  cast(null as double) as dsoc_per_day, 25.0 as ambient_c from rest"""

TEMPLATES["constant_power"] = with_(telemetry("ConstantPower"), ISLANDS) + f"""
select {K}, 'dchg' as direction, round(power_w, 6) as power_w, round(power_w * duration_s / 3600.0, 6) as energy_wh,
  round(duration_s, 6) as duration_s, cast(null as double) as q_ah
from steps where lower(step_name) like '%cp%' and lower(step_name) like '%dchg%'"""

OCV = f"""
directed as (
  select *, case when step_name in ('CC_Chg', 'CCCV_Chg') then 'chg' when step_name = 'CC_DChg' then 'dchg' end as direction
  from labelled
),
sized as (
  select {K}, direction, step_no, count(*) as n, arg_min(capacity_ah, idx) as q0 from directed
  where direction is not null group by {K}, direction, step_no
  qualify row_number() over (partition by {K}, direction order by count(*) desc, step_no) = 1
),
seg as (
  select d.*, abs(d.capacity_ah - s.q0) as q, max(abs(d.capacity_ah - s.q0)) over (partition by {', '.join('d.' + k for k in K.split(', '))}, d.direction) as q_max
  from directed d join sized s on d.make = s.make and d.batch = s.batch and d.cell_no = s.cell_no
    and d.max_cap is not distinct from s.max_cap and d.direction = s.direction and d.step_no = s.step_no
  where s.n >= 20
),
progress as (
  select *, case when direction = 'chg' then q / q_max else 1.0 - q / q_max end as soc from seg where q_max > 0
),
grid as (select unnest([0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]::double[]) as g),
bracket as (
  select {K}, direction, g, max(soc) filter (soc <= g) as x0, min(soc) filter (soc > g) as x1,
    arg_max(volt_v, struct_pack(s := soc, i := idx)) filter (soc <= g) as y0,
    arg_min(volt_v, struct_pack(s := soc, i := idx)) filter (soc > g) as y1
  from progress cross join grid group by {K}, direction, g
),
ocv as (
  select {K}, direction, g as soc, case when x0 is null then y1 when x1 is null or x0 = g then y0
    else (y1 - y0) / (x1 - x0) * (g - x0) + y0 end as v_oc from bracket
)"""
TEMPLATES["ocv_curves"] = with_(telemetry("OCVSOC"), NUMBERED, OCV) + f"""
select {K}, direction, round(soc, 6) as soc, round(v_oc, 6) as v_oc from ocv"""

PEAK = f"""
pulse as (
  select s.*, f.soc as soc0, unnest(case when lower(step_name) like '%dchg%' and lower(step_name) like '%cc_chg%'
      then ['dchg', 'chg'] when lower(step_name) like '%dchg%' then ['dchg']
      when lower(step_name) like '%cc_chg%' then ['chg'] end) as direction
  from steps s join fold f on s.make = f.make and s.batch = f.batch and s.cell_no = f.cell_no
    and s.max_cap = f.max_cap and s.block = f.block
  where s.duration_s <= 30 and abs(s.current_mean_a) > 1
),
sample as (
  select p.make, p.batch, p.cell_no, p.max_cap, p.block, l.idx, l.volt_v, l.current_a, p.duration_s,
    (epoch_us(l.absolute_time) - epoch_us(p.start_time)) / cast(1000000 as double) as t
  from pulse p join labelled l on p.make = l.make and p.batch = l.batch and p.cell_no = l.cell_no
    and p.max_cap = l.max_cap and p.block = l.block where p.duration_s >= 10
),
probed as (
  select {K}, block, max(t) filter (t <= 10) as x0, min(t) filter (t > 10) as x1,
    arg_max(volt_v, idx) filter (t <= 10) as v0, arg_min(volt_v, idx) filter (t > 10) as v1,
    arg_max(current_a, idx) filter (t <= 10) as i0, arg_min(current_a, idx) filter (t > 10) as i1
  from sample group by {K}, block
),
peak as (
  select p.*, {half_even('soc0', 2)} as soc,
    case when x0 = 10 or x1 is null then v0 else (v1 - v0) / (x1 - x0) * (10.0 - x0) + v0 end as v_at_peak,
    case when x0 = 10 or x1 is null then i0 else (i1 - i0) / (x1 - x0) * (10.0 - x0) + i0 end as i_at_peak
  from pulse p left join probed b on p.make = b.make and p.batch = b.batch and p.cell_no = b.cell_no
    and p.max_cap = b.max_cap and p.block = b.block
),
latest as (
  select * from peak qualify row_number() over (partition by {K}, direction, soc order by block desc) = 1
)"""
TEMPLATES["peak_power"] = with_(telemetry("PeakPower"), ISLANDS, SOC, PEAK, recursive=True) + f"""
select {K}, direction, soc, round(abs(v_at_peak * i_at_peak), 6) as p_peak_w, round(v_at_peak, 6) as v_at_peak,
  round(i_at_peak, 6) as i_at_peak, round(duration_s, 6) as duration_s from latest"""

HPPC = f"""
near as (
  select *, lag(step_name) over w as p_name, lag(duration_s) over w as p_dur, lag(v_last) over w as v_pre
  from steps window w as (partition by {K} order by step_no)
),
pulse as (
  select *, row_number() over (partition by {K} order by step_no) as pulse_idx from near
  where step_name = 'CC_DChg' and contains(p_name, 'Rest') and p_dur >= 600 and duration_s between 5 and 60
    and i_abs_mean >= 1
),
s0 as (
  select p.make, p.batch, p.cell_no, p.max_cap, p.step_no, l.volt_v as v, l.idx,
    epoch_ms(l.absolute_time) as ms
  from labelled l join pulse p on l.make = p.make and l.batch = p.batch and l.cell_no = p.cell_no
    and l.max_cap is not distinct from p.max_cap and l.step_no = p.step_no
),
s1 as (
  select *, (ms - min(ms) over (partition by {K}, step_no)) / cast(1000 as double) as t,
    row_number() over (partition by {K}, step_no order by idx) - 1 as j,
    count(*) over (partition by {K}, step_no) as n from s0
),
s2 as (select *, nullif(t - lag(t) over w, 0) as dt, lag(v) over w as v_prev from s1
  window w as (partition by {K}, step_no order by j)),
s3 as (select *, (v - v_prev) / dt as dv from s2),
s4 as (select *, abs((dv - lag(dv) over (partition by {K}, step_no order by j)) / dt) as bend from s3),
s5 as (select *, case when bend < 0.008 * max(bend) over (partition by {K}, step_no) then 1 else 0 end as flat from s4),
s6 as (select *, sum(flat) over (partition by {K}, step_no order by j rows between current row and 4 following) as run,
  max(t) over (partition by {K}, step_no) as t_end from s5),
s7 as (select *, coalesce(min(case when run = 5 and j - 2 <= n - 8 and n >= 8 then j end)
  over (partition by {K}, step_no), n // 2) as knee from s6),
hppc as (
  select p.*, k.v as v_fast, k.t as t_fast, greatest(k.t, cast(1e-6 as double)) as tau1,
    greatest(k.t_end - k.t, cast(1e-6 as double)) as tau2,
    abs((p.v_pre - p.v_first) / p.i_mean) * 1000 as r0, abs((p.v_first - k.v) / p.i_mean) * 1000 as r1,
    abs((k.v - p.v_last) / p.i_mean) * 1000 as r2, abs((p.v_pre - p.v_last) / p.i_mean) * 1000 as r30
  from pulse p join s7 k on k.make = p.make and k.batch = p.batch and k.cell_no = p.cell_no
    and k.max_cap is not distinct from p.max_cap and k.step_no = p.step_no and k.j = k.knee
)"""
TEMPLATES["hppc_pulses"] = with_(telemetry("HPPC"), NUMBERED, HPPC) + f"""
select {K}, cycle_no, cast(pulse_idx as integer) as pulse_idx, cast(step_no as integer) as step_no,
  round(duration_s, 6) as duration_s, round(i_mean, 6) as "I_step", round(pulse_idx * cast(0.1 as double), 6) as soc_start,
  round(v_pre, 6) as "V_pre", round(v_first, 6) as "V_post", round(v_fast, 6) as "V_fast", round(v_last, 6) as "V_end",
  round(tau1, 6) as tau1_s, round(tau2, 6) as tau2_s, round(r0, 6) as "R0_mOhm", round(r1, 6) as "R1_mOhm",
  round(r2, 6) as "R2_mOhm", round(tau1 / nullif(r1 * 1e-3, 0), 2) as "C1_F",
  round(tau2 / nullif(r2 * 1e-3, 0), 2) as "C2_F", round(r30, 6) as "R_30s_mOhm" from hppc"""

DCIR = f"""
cand as (
  select s.make, s.batch, s.cell_no, s.max_cap, s.block, f.soc as soc0, min(l.idx) as first_idx,
    min(l.absolute_time) as t0, median(abs(l.current_a)) as base, max(abs(l.current_a)) as peak
  from steps s join fold f on s.make = f.make and s.batch = f.batch and s.cell_no = f.cell_no
      and s.max_cap = f.max_cap and s.block = f.block
    join labelled l on s.make = l.make and s.batch = l.batch and s.cell_no = l.cell_no
      and s.max_cap = l.max_cap and s.block = l.block
  where contains(s.step_name, 'CC_DChg') and abs(s.current_mean_a) >= 1 and s.n_rows >= 3 and s.n_current = s.n_rows
  group by all
  having median(abs(l.current_a)) >= 1 and max(abs(l.current_a)) >= 1.5 * median(abs(l.current_a))
),
d0 as (
  select c.*, l.idx - c.first_idx as i, (epoch_us(l.absolute_time) - epoch_us(c.t0)) / cast(1000000 as double) as t,
    l.volt_v as v, l.current_a as cur, abs(l.current_a) > (base + peak) / 2 as hot
  from cand c join labelled l on c.make = l.make and c.batch = l.batch and c.cell_no = l.cell_no
    and c.max_cap = l.max_cap and c.block = l.block
),
d1 as (
  select *, coalesce(cur * (t - lag(t) over w), 0) as dq from d0 window w as (partition by {K}, block order by i)
),
d2 as (select *, sum(dq) over (partition by {K}, block order by i rows unbounded preceding) as q from d1),
hot as (
  select *, case when lag(i) over w is null or (i <> lag(i) over w + 1 and t - lag(t) over w >= 2) then 1 else 0 end as opens
  from d2 where hot window w as (partition by {K}, block order by i)
),
numbered as (select *, sum(opens) over (partition by {K}, block order by i rows unbounded preceding) as region from hot),
region as (
  select {K}, block, region, min(i) as a, max(i) + 1 as b,
    greatest(1, cast(round_even((max(t) - min(t)) / 10, 0) as bigint)) as parts
  from numbered group by {K}, block, region
),
part as (
  select *, cast(round_even(a + k * ((b - a) / cast(parts as double)), 0) as bigint) as lo,
    cast(round_even(a + (k + 1) * ((b - a) / cast(parts as double)), 0) as bigint) as hi
  from region, unnest(range(parts)) as u(k)
),
burst as (
  select p.make, p.batch, p.cell_no, p.max_cap, p.block, p.lo, d.soc0, avg(d.cur) as i_at_pulse,
    max(d.t) - min(d.t) as dur, arg_min(d.v, d.i) as v_s, arg_max(d.v, d.i) as v_e, arg_min(d.q, d.i) as q
  from part p join d2 d on p.make = d.make and p.batch = d.batch and p.cell_no = d.cell_no
    and p.max_cap = d.max_cap and p.block = d.block and d.i >= p.lo and d.i < p.hi
  where p.hi - p.lo >= 2 group by all having max(d.t) - min(d.t) >= 1 and abs(avg(d.cur)) >= 1e-6
),
dcir as (
  select {K}, cast(row_number() over (partition by {K} order by block, lo) as integer) as pulse_idx,
    {half_even('soc0 + q / 3600.0 / max_cap', 3)} as soc, abs(v_s - v_e) / abs(i_at_pulse) * 1000 as r0_mohm, i_at_pulse
  from burst
)"""
TEMPLATES["dcir_anchors"] = with_(telemetry("DCIR"), ISLANDS, SOC, DCIR, recursive=True) + f"""
select {K}, pulse_idx, soc, round(r0_mohm, 6) as r0_mohm, round(i_at_pulse, 6) as i_at_pulse from dcir"""

GITT = f"""
near as (
  select s.*, f.soc as soc0, lead(step_name) over w as n_name, lead(duration_s) over w as n_dur,
    lead(s.n_rows) over w as n_n
  from steps s join fold f on s.make = f.make and s.batch = f.batch and s.cell_no = f.cell_no
    and s.max_cap = f.max_cap and s.block = f.block
  window w as (partition by s.make, s.batch, s.cell_no, s.max_cap order by s.block)
),
gitt as (
  select *, cast(row_number() over (partition by {K} order by block) as integer) as pulse_idx from near
  where contains(step_name, 'CC_DChg') and duration_s between 60 and 1800 and abs(current_mean_a) >= 1
    and lower(n_name) like '%rest%' and n_dur >= 600
)"""
TEMPLATES["gitt_pulses"] = with_(telemetry("GITT"), ISLANDS, SOC, GITT, recursive=True) + f"""
select {K}, pulse_idx, {half_even('soc0', 3)} as soc,
  round(abs(end_volt_v - start_volt_v) / abs(current_mean_a) * 1000, 6) as r_pulse_mohm,
  cast(null as double) as tau_diff_s, cast(null as double) as v_inf_v from gitt"""


def _sse(w: str, a: str) -> str:
    return f"sww - 2 * ({w}) * sw - 2 * ({a}) * swe + n * ({w}) * ({w}) + 2 * ({w}) * ({a}) * se + ({a}) * ({a}) * see"


def _clip(x: str, low: str, high: str) -> str:
    return f"greatest(least({x}, {high}), {low})"


def _pass(name: str, grid: str, source: str) -> str:
    """One grid pass: the sums per (rest, log_tau), and the bounded optimum of each."""
    free_a = "(n * swe - se * sw) / nullif(n * see - se * se, 0)"
    a_of = lambda w: _clip(f"(swe - ({w}) * se) / see", "a_lo", "a_hi")
    w_of = lambda a: _clip(f"(sw - ({a}) * se) / n", "w_lo", "w_hi")
    edges = [("w_lo", a_of("w_lo")), ("w_hi", a_of("w_hi")), (w_of("a_lo"), "a_lo"), (w_of("a_hi"), "a_hi")]
    options = ", ".join(f"struct_pack(sse := {_sse(w, a)}, w := {w}, a := {a})" for w, a in edges)
    return f"""
{name}_grid as (
  select distinct {K}, block, rising, greatest(least(lt, ln(1e5)), ln(5.0)) as lt
  from (select {K}, block, rising, {grid} as lt from {source})
),
{name}_sum as (
  select s.make, s.batch, s.cell_no, s.max_cap, s.block, rising, lt, cast(count(*) as double) as n, sum(w) as sw,
    sum(w * w) as sww, sum(e) as se, sum(e * e) as see, sum(w * e) as swe,
    case when rising then 0.0 else -1.0 end as w_lo, case when rising then 1.0 else 0.0 end as w_hi,
    case when rising then -0.5 else 1e-5 end as a_lo, case when rising then -1e-5 else 0.5 end as a_hi
  from (select f.*, g.rising, g.lt, exp(-t / exp(lt)) as e from fitted f join {name}_grid g on f.make = g.make
    and f.batch = g.batch and f.cell_no = g.cell_no and f.max_cap = g.max_cap and f.block = g.block) s
  group by all
),
{name}_free as (select *, {free_a} as fa, (sw - ({free_a}) * se) / n as fw from {name}_sum),
{name} as (
  select {K}, block, rising, lt, case when fa between a_lo and a_hi and fw between w_lo and w_hi
    then struct_pack(sse := {_sse('fw', 'fa')}, w := fw, a := fa) else list_min([{options}]) end as p
  from {name}_free
),
{name}_best as (select {K}, block, rising, arg_min(lt, p.sse) as centre from {name} group by {K}, block, rising)"""


_H = "(ln(1e5 / 5.0) / 40)"
FIT = f"""
fit_rest as (
  select g.make, g.batch, g.cell_no, g.max_cap, g.block + 1 as block, coalesce(g.current_mean_a < 0, false) as rising,
    g.pulse_idx from gitt g
),
fitted as (
  select * from (
    select r.make, r.batch, r.cell_no, r.max_cap, r.block,
      (epoch_us(l.absolute_time) - min(epoch_us(l.absolute_time)) over w) / cast(1000000 as double) as t,
      l.volt_v - arg_min(l.volt_v, l.idx) over w as w, count(*) over w as nn, count(l.volt_v) over w as nv
    from fit_rest r join labelled l on r.make = l.make and r.batch = l.batch and r.cell_no = l.cell_no
      and r.max_cap = l.max_cap and r.block = l.block
    window w as (partition by r.make, r.batch, r.cell_no, r.max_cap, r.block))
  where nn >= 30 and nv = nn
),
{_pass('p1', f'unnest([ln(5.0) + {_H} * k for k in range(41)])', 'fit_rest')},
{_pass('p2', f'unnest([centre + k * {_H} / 10 for k in range(-10, 11)])', 'p1_best')},
{_pass('p3', f'unnest([centre + k * {_H} / 100 for k in range(-10, 11)])', 'p2_best')},
around as (
  select *, row_number() over w as at, lag(lt) over w as l_lt, lag(p) over w as l_p, lead(lt) over w as r_lt,
    lead(p) over w as r_p, min(p.sse) over (partition by {K}, block) as least
  from p3 window w as (partition by {K}, block order by lt)
),
vertex as (
  select *, case when abs(lt - l_lt - {_H} / 100) < {_H} / 10000 and abs(r_lt - lt - {_H} / 100) < {_H} / 10000
      and l_p.sse - 2 * p.sse + r_p.sse > 0
    then (l_p.sse - r_p.sse) / (2 * (l_p.sse - 2 * p.sse + r_p.sse)) else 0 end as u
  from around where p.sse = least
  qualify row_number() over (partition by {K}, block order by lt) = 1
),
relax as (
  select {K}, block, exp(lt + u * {_H} / 100) as tau, case when u <> 0 then p.w + (r_p.w - l_p.w) / 2 * u
    + (r_p.w - 2 * p.w + l_p.w) / 2 * u * u else p.w end as w_inf from vertex
),
v_start as (
  select {K}, block, arg_min(volt_v, idx) as v0 from labelled group by {K}, block
),
gitt_fit as (
  select r.make, r.batch, r.cell_no, r.max_cap, r.pulse_idx, x.tau, v.v0 + x.w_inf as v_inf
  from fit_rest r left join relax x on r.make = x.make and r.batch = x.batch and r.cell_no = x.cell_no
      and r.max_cap = x.max_cap and r.block = x.block
    left join v_start v on r.make = v.make and r.batch = v.batch and r.cell_no = v.cell_no
      and r.max_cap = v.max_cap and r.block = v.block
)"""
TEMPLATES["gitt_relaxation"] = with_(telemetry("GITT"), ISLANDS, SOC, GITT, FIT, recursive=True) + f"""
select {K}, pulse_idx, round(tau, 2) as tau_diff_s, round(v_inf, 6) as v_inf_v from gitt_fit"""

ORACLES["conform_raw"] = """
select case when length(c) < 4 then lpad(c, 4, '0') else c end as cell_no, cast(day(ts) as integer) as cycle_no,
  case when value < 300 then cast(event_id as integer) end as cycler_step_no, event_type as step_name,
  ts as absolute_time, case when value < 200 then round(value, 6) end as volt_v,
  case when value < 100 then round(value, 6) end as current_a, cast(null as double) as capacity_ah,
  cast(null as varchar) as crate, cast(null as varchar) as drate, cast(null as varchar) as dod,
  cast(null as double) as max_cap, 'RPT' as test, 'MAKE' || cast(user_id % 4 as varchar) as make,
  cast(user_id % 2 as varchar) as batch
from (select *, cast(user_id as varchar) as c from events) where event_type <> 'error'"""

ORACLES["islands_events"] = with_(EVENTS, ISLANDS) + f"""
select {K}, absolute_time, step_name, idx, block from labelled"""

ORACLES["steps_events"] = with_(EVENTS, ISLANDS) + f"""
select {K}, block, cycle_no, step_name, n_rows, start_time, end_time,
  {rounded(['start_volt_v', 'end_volt_v', 'current_mean_a', 'duration_s', 'step_capacity_ah'], 9)} from steps"""

ORACLES["step_neighbours_events"] = with_(EVENTS, ISLANDS) + f"""
select {K}, block, lag(step_name) over w as prev_step, round(lag(duration_s) over w, 6) as prev_s,
  lead(step_name) over w as next_step, round(lead(duration_s) over w, 6) as next_s
from steps window w as (partition by {K} order by block)"""

TEMPLATES["steps_by_number"] = with_(telemetry("HPPC"), NUMBERED) + f"""
select {K}, step_no, step_name, cycle_no, n_samples, t_start, t_end,
  {rounded(['v_first', 'v_last', 'i_abs_mean', 'i_mean', 'q_max', 'duration_s'])} from steps"""

ORACLES["soc_at_step_start_events"] = with_(EVENTS, ISLANDS, SOC, recursive=True) + f"""
select {K}, block, round(soc, 6) as soc from fold"""

ORACLES["rate_medians_events"] = with_(EVENTS) + f"""
select {K}, step_name, round(median(volt_v), 9) as median_v from raw group by {K}, step_name"""

_FILES = """
files as (
  select distinct 'lake/Test=' || test || '/Make=M' || user_id % 4 || '/Batch=' || user_id % 2 || '/Cell=' || user_id
      || '/YYYY=' || year(ts) || '/MM=' || month(ts) || '/DD=' || day(ts) || '/part-0.parquet' as path,
    test as "Test", 'M' || user_id % 4 as "Make", cast(user_id % 2 as varchar) as "Batch",
    cast(user_id as varchar) as "Cell", strftime(ts, '%Y-%m-%d') as date
  from (select *, unnest(case when event_type = 'click' then [t, 'OCVSOC'] else [t] end) as test from (
    select *, case user_id % 3 when 0 then 'SelfDischarge' when 1 then 'GITT' else 'Longterm' end as t from events))
  where test <> 'Longterm'
)"""
_G = '"Test", "Make", "Batch", "Cell"'
ORACLES["file_inventory"] = with_(_FILES) + f"select path, {_G}, date from files"
ORACLES["file_inventory_lake"] = """
select distinct case user_id % 3 when 0 then 'SelfDischarge' else 'GITT' end as "Test", 'M' || user_id % 4 as "Make", cast(user_id % 2 as varchar) as "Batch",
  'c:' || user_id % 50 as "Cell", strftime(ts, '%Y-%m-') || lpad(cast((day(ts) - 1) // 7 * 7 + 1 as varchar), 2, '0') as date, 1::bigint as n_files
from events where user_id % 3 <> 2"""
ORACLES["changed_group_selection"] = with_(_FILES) + f"""
select {_G}, max(date) as last_date from files group by {_G} having max(date) > '2024-01-28'"""
ORACLES["changed_with_dependencies"] = with_(
    _FILES,
    f"""changed as (
  select {_G} from files where "Make" in ('M0', 'M1') group by {_G} having max(date) > '2024-01-29')""",
) + f"""
select {_G} from changed union
select f."Test", f."Make", f."Batch", f."Cell" from files f join changed c on f."Make" = c."Make"
  and f."Batch" = c."Batch" and f."Cell" = c."Cell"
where (f."Test", c."Test") in (('SelfDischarge', 'OCVSOC'), ('OCVSOC', 'SelfDischarge'))"""


def _user_state(name: str, prefix: str, where: str, shown: str = "true") -> str:
    return f"""
{name} as (
  select user_id, max(value) filter (event_type = 'click' and {shown}) as best,
    case when max(value) <= 150 then max(value) end as top,
    case when max(value) <= 120 then '{prefix}' || min(event_type) end as tag, min(ts) as first_seen,
    nullif(string_agg(cast(cast(round(value * 1e6) as bigint) as varchar), ',' order by value)
      filter (event_type = 'error' and {shown}), '') as errors
  from events where {where} group by user_id
)"""


ORACLES["null_safe_upsert"] = with_(
    _user_state("fresh", "new-", "ts >= '2024-01-16'", "value > 20"), _user_state("known", "old-", "ts < '2024-01-16'")
) + """
select f.user_id, coalesce(f.best, k.best) as best, coalesce(f.top, k.top) as top, coalesce(f.tag, k.tag) as tag,
  least(f.first_seen, k.first_seen) as first_seen, coalesce(f.errors, k.errors) as errors
from fresh f left join known k on f.user_id = k.user_id"""


def _list(value: str, order: str, only: str = "true", scale: str = "1e6") -> str:
    """Values in order as comma separated millionths, null as n; null where there are none."""
    text = f"coalesce(cast(cast(round(({value}) * {scale}) as bigint) as varchar), 'n')"
    return f"string_agg({text}, ',' order by {order}) filter ({only})"


def _part(name: str, body: str, *ctes: str, recursive: bool = False) -> str:
    return f"{name} as ({with_(*ctes, recursive=recursive)} {body})"


def _per_cell(source: str, **cols: str) -> str:
    return f"select {K}, " + ", ".join(f"{sql} as {name}" for name, sql in cols.items()) + f" from {source} group by {K}"


_D, _C = "direction = 'dchg'", "direction = 'chg'"
_RATE_ROWS = f"""
rates as (
  select {K}, direction, c_rate, median(step_capacity_ah) as q_ah from (
    select *, {half_even('abs(current_mean_a) / max_cap', 2)} as c_rate, unnest(case
        when lower(step_name) like '%dchg%' then ['dchg', 'chg'] when lower(step_name) like '%chg%' then ['chg'] end)
        as direction
    from usable where lower(step_name) not like '%cp%' and step_capacity_ah >= 0.5 * max_cap)
  group by {K}, direction, c_rate
)"""

OCV_PART = _part(
    "w_ocv",
    _per_cell(
        "ocv",
        ocv_soc_grid=_list("soc", "soc, v_oc", _D),
        v_oc_curve=_list("v_oc", "soc, v_oc", _D),
        ocv_soc_grid_chg=_list("soc", "soc, v_oc", _C),
        v_oc_chg_curve=_list("v_oc", "soc, v_oc", _C),
        pts=f"list(struct_pack(v := v_oc, s := soc) order by v_oc, soc) filter ({_D})",
    ),
    telemetry("OCVSOC"), NUMBERED, OCV,
)
SD_PART = _part(
    "w_sd",
    f"""select {K}, duration_s / 3600.0 as self_disch_rest_duration_h, v_first as self_disch_v_start_v,
    v_last as self_disch_v_end_v, cast(25.0 as double) as self_disch_ambient_c from rest""",
    telemetry("SelfDischarge"), NUMBERED, _SD,
)


def _look_up(v: str) -> str:
    """Charge at voltage ``v`` on the sorted points ``pts``, ends held."""
    low, high = f"[p for p in pts if p.v <= {v}][-1]", f"[p for p in pts if p.v > {v}][1]"
    return f"""case when {low} is null then {high}.s when {high} is null or {low}.v = {v} then {low}.s
      else ({high}.s - {low}.s) / ({high}.v - {low}.v) * ({v} - {low}.v) + {low}.s end"""


_DSOC = f"""case when self_disch_rest_duration_h > 0 then case when len(pts) > 1
    then (({_look_up('self_disch_v_start_v')}) - ({_look_up('self_disch_v_end_v')})) / (self_disch_rest_duration_h / 24.0)
    else -(self_disch_v_end_v - self_disch_v_start_v) / 0.05 / (self_disch_rest_duration_h / 24.0) end end"""

TEMPLATES["dsoc_per_day"] = with_(
    f"cells as (with {telemetry('OCVSOC', 'SelfDischarge')} select distinct {K} from raw)", OCV_PART, SD_PART
) + f"""
select {K}, round({_DSOC}, 6) as self_disch_dsoc_per_day
from cells left join w_ocv using ({K}) left join w_sd using ({K})"""

_WIDE_PARTS = [
    f"""cells as (with {telemetry()} select {K}, min(absolute_time) as test_session_start,
      max(absolute_time) as test_session_end from raw where test <> 'Longterm' group by {K})""",
    _part(
        "w_hppc",
        _per_cell(
            "hppc",
            hppc_n_pulses_dchg="cast(count(*) as double)",
            hppc_soc_at_pulse_dchg=_list("pulse_idx * cast(0.1 as double)", "pulse_idx"),
            hppc_i_at_pulse_dchg=_list("i_mean", "pulse_idx"),
            r0_dchg_curve=_list("r0", "pulse_idx"),
            r1_dchg_curve=_list("r1", "pulse_idx"),
            c1_dchg_curve=_list("tau1 / nullif(r1 * 1e-3, 0)", "pulse_idx", scale="1e1"),
            r2_dchg_curve=_list("r2", "pulse_idx"),
            c2_dchg_curve=_list("tau2 / nullif(r2 * 1e-3, 0)", "pulse_idx", scale="1e1"),
        ),
        telemetry("HPPC"), NUMBERED, HPPC,
    ),
    OCV_PART,
    _part(
        "w_dcir",
        _per_cell(
            "dcir",
            dcir_n_pulses="cast(count(*) as double)",
            dcir_soc_at_pulse=_list("soc", "pulse_idx"),
            dcir_soc_nominal="case count(*) when 1 then '900000' when 2 then '900000,200000' "
            f"when 3 then '900000,500000,200000' else {_list('soc', 'pulse_idx')} end",
            dcir_i_at_pulse=_list("i_at_pulse", "pulse_idx"),
            r_dc_curve=_list("r0_mohm", "pulse_idx"),
        ),
        telemetry("DCIR"), ISLANDS, SOC, DCIR, recursive=True,
    ),
    _part(
        "w_gitt",
        _per_cell(
            "gitt join gitt_fit using (make, batch, cell_no, max_cap, pulse_idx)",
            gitt_soc_grid=_list(half_even("soc0", 3), "pulse_idx"),
            r_pulse_curve=_list("abs(end_volt_v - start_volt_v) / abs(current_mean_a) * 1000", "pulse_idx"),
            tau_diff_curve=_list("tau", "pulse_idx", scale="1e1"),
            v_inf_curve=_list("v_inf", "pulse_idx"),
        ),
        telemetry("GITT"), ISLANDS, SOC, GITT, FIT, recursive=True,
    ),
    _part(
        "w_rate",
        _per_cell(
            "rates",
            rate_cap_c_rates=_list("c_rate", "c_rate", _D),
            rate_cap_q_curve=_list("q_ah", "c_rate", _D),
            rate_cap_c_rates_chg=_list("c_rate", "c_rate", _C),
            rate_cap_q_chg_curve=_list("q_ah", "c_rate", _C),
        ),
        telemetry("RateCapability"), ISLANDS, _USABLE, _RATE_ROWS,
    ),
    _part(
        "w_cp",
        _per_cell(
            "steps where lower(step_name) like '%cp%' and lower(step_name) like '%dchg%'",
            const_power_levels_w=_list("power_w", "power_w, duration_s"),
            const_power_t_dis_curve=_list("duration_s", "power_w, duration_s"),
            const_power_energy_curve=_list("power_w * duration_s / 3600.0", "power_w, duration_s"),
        ),
        telemetry("ConstantPower"), ISLANDS,
    ),
    _part(
        "w_peak",
        _per_cell(
            "latest",
            peak_power_soc_grid=_list("soc", "soc", _D),
            p_peak_10s_dchg_curve=_list("abs(v_at_peak * i_at_peak)", "soc", _D),
            p_peak_10s_chg_curve=_list("abs(v_at_peak * i_at_peak)", "soc", _C),
        ),
        telemetry("PeakPower"), ISLANDS, SOC, PEAK, recursive=True,
    ),
    SD_PART,
    _part(
        "w_rpt",
        _per_cell("cycles", q_rpt_ah="max(dchg_cap_ah)", q_rpt_chg_ah="max(chg_cap_ah)"),
        telemetry("RPT"), CYCLES,
    ),
    _part(
        "w_crate",
        f"""select {K}, arg_min(rate, absolute_time) as rpt_protocol_c_rate from (select *, try_cast(
          regexp_extract(coalesce(crate, drate), '([0-9]*\\.?[0-9]+)', 1) as double) as rate from raw)
        where rate is not null group by {K}""",
        telemetry("RPT"),
    ),
]
_WIDE_NAMES = ["w_hppc", "w_ocv", "w_dcir", "w_gitt", "w_rate", "w_cp", "w_peak", "w_sd", "w_rpt", "w_crate"]
_WIDE_DOUBLES = (
    "q_rpt_ah q_rpt_chg_ah rpt_protocol_c_rate self_disch_rest_duration_h self_disch_v_start_v self_disch_v_end_v "
    "self_disch_ambient_c dcir_n_pulses hppc_n_pulses_dchg"
).split()
_WIDE_LISTS = (
    "rate_cap_c_rates rate_cap_q_curve rate_cap_c_rates_chg rate_cap_q_chg_curve const_power_levels_w "
    "const_power_t_dis_curve const_power_energy_curve ocv_soc_grid v_oc_curve ocv_soc_grid_chg v_oc_chg_curve "
    "dcir_soc_nominal dcir_soc_at_pulse dcir_i_at_pulse r_dc_curve peak_power_soc_grid p_peak_10s_dchg_curve "
    "p_peak_10s_chg_curve hppc_soc_at_pulse_dchg hppc_i_at_pulse_dchg r0_dchg_curve r1_dchg_curve c1_dchg_curve "
    "r2_dchg_curve c2_dchg_curve gitt_soc_grid r_pulse_curve tau_diff_curve v_inf_curve"
).split()
TEMPLATES["wide_cells"] = with_(*_WIDE_PARTS) + f"""
select {K}, make as cohort, test_session_start, test_session_end, 'LFP' as chemistry, 'ok' as qc_flag,
  'cellspark-1.0' as processor_version, round(case when max_cap > 0 then q_rpt_ah / max_cap * 100.0 end, 6) as "Soh",
  {rounded(_WIDE_DOUBLES)}, {', '.join(_WIDE_LISTS)}, round({_DSOC}, 6) as self_disch_dsoc_per_day,
  'details/cohort=' || make || '/cell_id=' || cell_no || '/batch=' || batch || '/ocv.parquet' as ocv_details_path
from cells {' '.join(f'left join {w} using ({K})' for w in _WIDE_NAMES)}"""


for _name, _sql in TEMPLATES.items():
    ORACLES[f"{_name}_lineitem"] = filled(_sql, all_of if _name in ("gitt_relaxation", "wide_cells") else lineitem)
ORACLES["cycle_agg_lineitem"] = filled(TEMPLATES["cycle_agg"], lambda *_: lineitem("RPT"))


def _results(name: str, where: str) -> str:
    same = " and ".join(f"ses.{k} = cap.{k}" for k in K.split(", "))
    return f"""{name} as (
  with {lineitem("RPT").strip().replace("raw as", "src as", 1)}, raw as (select * from src where {where}), {CYCLES},
  cap as (select {K}, max(dchg_cap_ah) as q, max(chg_cap_ah) as q_chg from cycles where max_cap is not null group by {K}),
  ses as (select {K}, min(absolute_time) as t0, max(absolute_time) as t1 from raw group by {K})
  select ses.make, ses.batch, ses.cell_no as cell, case when ses.max_cap is null then 'unknown' else '5.0' end as cap, q, q_chg, t0, t1
  from ses left join cap on {same})"""


_BOTH = with_(_results("n", "cycle_no >= 3"), _results("o", "cycle_no < 3"))
_SAME = "n.make = o.make and n.batch = o.batch and n.cell = o.cell and n.cap = o.cap"
ORACLES["result_upsert_all_lineitem"] = _BOTH + f"""
select n.make, n.cap as max_cap, n.cell, n.batch, round(coalesce(n.q / 5.0 * 100.0, o.q / 5.0 * 100.0), 6) as "Soh", round(coalesce(n.q, o.q), 6) as q_rpt_ah,
  round(coalesce(n.q_chg, o.q_chg), 6) as q_rpt_chg_ah, least(n.t0, o.t0) as test_session_start, greatest(n.t1, o.t1) as test_session_end
from n left join o on {_SAME}"""
ORACLES["existing_results_all_lineitem"] = _BOTH + f"""
select o.make, o.cap as max_cap, o.cell, o.batch, round(o.q, 6) as q_rpt_ah, o.t1 as test_session_end from o join n on {_SAME}"""
ORACLES["latest_states_events"] = """
select user_id, strftime(ts, '%Y-%m-%d') as last_run_date, event_type as "table" from events
qualify row_number() over (partition by user_id order by ts desc, event_type desc) = 1"""
