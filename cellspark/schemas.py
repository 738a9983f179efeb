"""Typed schemas of the raw telemetry and of every result table."""

from __future__ import annotations

from pyspark.sql import types as T

CELL_KEYS = ["make", "batch", "cell_no", "max_cap"]

STRING, INT, DOUBLE, TIME = T.StringType(), T.IntegerType(), T.DoubleType(), T.TimestampType()
CURVE = T.ArrayType(DOUBLE)


def _columns(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


def _per_cell(**types: T.DataType) -> T.StructType:
    return _columns(make=STRING, batch=STRING, cell_no=STRING, max_cap=DOUBLE, **types)


# The columns of the raw telemetry, of each protocol's results and of the wide row, in published order.
RAW = _columns(
    cell_no=STRING,
    cycle_no=INT,
    cycler_step_no=INT,
    step_name=STRING,
    absolute_time=TIME,
    volt_v=DOUBLE,
    current_a=DOUBLE,
    capacity_ah=DOUBLE,
    crate=STRING,
    drate=STRING,
    dod=STRING,
    max_cap=DOUBLE,
    test=STRING,
    make=STRING,
    batch=STRING,
)
PULSE = _per_cell(
    cycle_no=INT,
    pulse_idx=INT,
    step_no=INT,
    duration_s=DOUBLE,
    I_step=DOUBLE,
    soc_start=DOUBLE,
    V_pre=DOUBLE,
    V_post=DOUBLE,
    V_fast=DOUBLE,
    V_end=DOUBLE,
    tau1_s=DOUBLE,
    tau2_s=DOUBLE,
    R0_mOhm=DOUBLE,
    R1_mOhm=DOUBLE,
    R2_mOhm=DOUBLE,
    C1_F=DOUBLE,
    C2_F=DOUBLE,
    R_30s_mOhm=DOUBLE,
)
CYCLE = _per_cell(
    cycle_no=INT,
    chg_cap_ah=DOUBLE,
    avg_chg_v=DOUBLE,
    chg_v_max=DOUBLE,
    dchg_cap_ah=DOUBLE,
    avg_dchg_v=DOUBLE,
    dchg_v_min=DOUBLE,
    coulombic_eff=DOUBLE,
)
CYCLE_ENERGY = _per_cell(cycle_no=INT, chg_energy_wh=DOUBLE, dchg_energy_wh=DOUBLE, v_max=DOUBLE, v_min=DOUBLE)
OCV = _per_cell(
    direction=STRING,
    soc=DOUBLE,
    v_oc=DOUBLE,
)
DCIR = _per_cell(
    pulse_idx=INT,
    soc=DOUBLE,
    r0_mohm=DOUBLE,
    i_at_pulse=DOUBLE,
)
GITT = _per_cell(
    pulse_idx=INT,
    soc=DOUBLE,
    r_pulse_mohm=DOUBLE,
    tau_diff_s=DOUBLE,
    v_inf_v=DOUBLE,
)
RATE = _per_cell(
    direction=STRING,
    c_rate=DOUBLE,
    q_ah=DOUBLE,
    energy_wh=DOUBLE,
)
SELF_DISCHARGE = _per_cell(
    rest_duration_s=DOUBLE,
    v_start=DOUBLE,
    v_end=DOUBLE,
    dv_dt_mV_per_h=DOUBLE,
    q_recovered_ah=DOUBLE,
    retention_pct=DOUBLE,
    dsoc_per_day=DOUBLE,
    ambient_c=DOUBLE,
)
PEAK_POWER = _per_cell(
    direction=STRING,
    soc=DOUBLE,
    p_peak_w=DOUBLE,
    v_at_peak=DOUBLE,
    i_at_peak=DOUBLE,
    duration_s=DOUBLE,
)
CONSTANT_POWER = _per_cell(
    direction=STRING,
    power_w=DOUBLE,
    energy_wh=DOUBLE,
    duration_s=DOUBLE,
    q_ah=DOUBLE,
)
RESULT = _columns(
    cohort=STRING,
    test_session_start=TIME,
    test_session_end=TIME,
    chemistry=STRING,
    qc_flag=STRING,
    processor_version=STRING,
    Soh=DOUBLE,
    q_rpt_ah=DOUBLE,
    q_rpt_chg_ah=DOUBLE,
    rpt_protocol_c_rate=DOUBLE,
    rate_cap_c_rates=CURVE,
    rate_cap_q_curve=CURVE,
    rate_cap_c_rates_chg=CURVE,
    rate_cap_q_chg_curve=CURVE,
    const_power_levels_w=CURVE,
    const_power_t_dis_curve=CURVE,
    const_power_energy_curve=CURVE,
    self_disch_rest_duration_h=DOUBLE,
    self_disch_v_start_v=DOUBLE,
    self_disch_v_end_v=DOUBLE,
    self_disch_dsoc_per_day=DOUBLE,
    self_disch_ambient_c=DOUBLE,
    ocv_soc_grid=CURVE,
    v_oc_curve=CURVE,
    ocv_soc_grid_chg=CURVE,
    v_oc_chg_curve=CURVE,
    ocv_details_path=STRING,
    dcir_n_pulses=DOUBLE,
    dcir_soc_nominal=CURVE,
    dcir_soc_at_pulse=CURVE,
    dcir_i_at_pulse=CURVE,
    r_dc_curve=CURVE,
    peak_power_soc_grid=CURVE,
    p_peak_10s_dchg_curve=CURVE,
    p_peak_10s_chg_curve=CURVE,
    hppc_n_pulses_dchg=DOUBLE,
    hppc_soc_at_pulse_dchg=CURVE,
    hppc_i_at_pulse_dchg=CURVE,
    r0_dchg_curve=CURVE,
    r1_dchg_curve=CURVE,
    c1_dchg_curve=CURVE,
    r2_dchg_curve=CURVE,
    c2_dchg_curve=CURVE,
    gitt_soc_grid=CURVE,
    r_pulse_curve=CURVE,
    tau_diff_curve=CURVE,
    v_inf_curve=CURVE,
)
DATA_COLS = RESULT.names

# The partition columns of the result table and the processed protocols.
RESULT_PARTITIONS = ["make", "max_cap", "cell", "batch"]
PROCESSED_TESTS = [
    "HPPC", "OCVSOC", "DCIR", "GITT", "RateCapability", "SelfDischarge", "PeakPower", "ConstantPower", "RPT",
]


def shape(df, schema: T.StructType):
    """Project ``df`` to ``schema``: its columns, order and types; absent columns become typed nulls."""
    from pyspark.sql import functions as F

    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
