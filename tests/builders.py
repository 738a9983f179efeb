"""Small telemetry tables written out by hand."""

from __future__ import annotations

import datetime as dt

from cellspark.schemas import RAW

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def _at(x, t):
    x = x(t) if callable(x) else x
    return None if x is None else float(x)


class Cell:
    """Collects samples of one cell and test; steps follow each other one second apart."""

    def __init__(self, test, cell="0001", make="M", batch="1", max_cap=100.0, numbered=True, start_s=0.0):
        self.key = dict(test=test, cell_no=cell, make=make, batch=batch, max_cap=max_cap)
        self.numbered, self.now, self.number, self.rows = numbered, start_s, 0, []

    def step(self, name, seconds, n, current=0.0, volts=3.3, cycle=1, cap=None, number=None, **extra):
        """``n`` samples over ``seconds``; ``volts`` / ``current`` / ``cap`` are numbers or functions of time."""
        self.number = self.number + 1 if number is None else number
        for k in range(n):
            t = seconds * k / (n - 1) if n > 1 else 0.0
            i = _at(current, t)
            row = dict(
                self.key, cycle_no=cycle, step_name=name, volt_v=_at(volts, t), current_a=i,
                cycler_step_no=self.number if self.numbered else None,
                capacity_ah=_at(cap, t) if cap is not None else (None if i is None else i * t / 3600),
                absolute_time=START + dt.timedelta(seconds=self.now + t),
            )
            self.rows.append({**row, **extra})
        self.now += seconds + 1
        return self


def raw(spark, *cells):
    rows = [r for c in cells for r in c.rows]
    return spark.createDataFrame([tuple(r.get(f) for f in RAW.names) for r in rows], RAW)


def collect(df, *order):
    return [r.asDict(recursive=True) for r in df.orderBy(*order).collect()]
