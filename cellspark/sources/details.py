"""The details store: one small file per cell with its open-circuit curves, where the result row points.

Files are written by the tasks that hold the rows, each in one piece under a name of its own and then moved to its
place, so a lost task or a second run leaves whole files with the same content.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.sources.folders import opened

FILE = pa.schema([("direction", pa.string()), ("soc", pa.float64()), ("v_oc", pa.float64())])
CURVES = {"dchg": ("ocv_soc_grid", "v_oc_curve"), "chg": ("ocv_soc_grid_chg", "v_oc_chg_curve")}


def write_details(rows: DataFrame, root: str, pointer: str = "ocv_details_path") -> int:
    """Write the curves of result rows to ``root/<pointer>``; returns the number of files.

    A cell without curves gets an empty file, so that every pointer opens. Rows without a pointer are left out.
    """
    columns = [c for pair in CURVES.values() for c in pair]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = opened(root)
        for batch in batches:
            for row in batch.to_pylist():
                points = [(d, s, v) for d, (soc, volts) in CURVES.items() for s, v in zip(row[soc] or [], row[volts] or [], strict=False)]
                path = f"{base}/{row['path']}"
                folder = path.rsplit("/", 1)[0]
                system.create_dir(folder, recursive=True)
                own = f"{folder}/.{uuid.uuid4().hex}"
                with system.open_output_stream(own) as out:
                    pq.write_table(pa.Table.from_arrays([pa.array([p[i] for p in points], FILE.field(i).type) for i in range(3)], schema=FILE), out)
                system.move(own, path)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["files"])

    sent = rows.where(F.col(pointer).isNotNull()).select(F.col(pointer).alias("path"), *columns)
    return sent.mapInArrow(run, "files bigint").agg(F.sum("files")).first()[0] or 0


def read_details(rows: DataFrame, root: str, pointer: str = "ocv_details_path") -> DataFrame:
    """(path, direction, soc, v_oc) of the files that result rows point at; a missing file raises."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = opened(root)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with system.open_input_file(f"{base}/{path}") as file:
                    table = pq.read_table(file, schema=FILE)
                for part in table.to_batches():
                    yield pa.RecordBatch.from_arrays([pa.array([path] * part.num_rows, pa.string()), *part.columns], ["path", *FILE.names])

    paths = rows.where(F.col(pointer).isNotNull()).select(F.col(pointer).alias("path"))
    return paths.mapInArrow(run, "path string, direction string, soc double, v_oc double")
