"""Near duplicates by SimHash: tiled exact comparison of all fingerprints.

Equal fingerprints are one node. Nodes are dealt into tiles by the population counts of their two halves
(1,089 possible pairs of counts) and, inside such a cell, by hash into tiles of about ``tile_rows``. Two
fingerprints within the radius have halves whose counts differ by no more than the radius in sum, so other
pairs of tiles are never met; inside a task sorted blocks are skipped the same way by the counts of their
quarters. What remains is compared exactly, by exclusive-or and bit counts on whole blocks. A task passes
on a spanning forest of the links it found (at most one link a node), so a group of near copies never
turns into all of its pairs; the components are put together by Spark.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.functions.lineage import store
from cellspark.llm.components import Forest, connected_components

SHINGLE_WORDS = 3
SEED = 42
RADIUS = 2
TILE_ROWS = 65_536
BLOCK = 512
HASHES_AT_ONCE = 65_536
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of one text (UTF-8), unsigned: a bit is 1 if more than half of all shingles' hashes set it.

    Words end at ASCII white space; A-Z are lower-cased. Null and wordless texts give 0; a text of fewer
    words than a shingle is one shingle. Repeated shingles count each time.
    """
    words = (text or b"").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle_words + 1)
    spans = list(zip(starts[:n].tolist(), ends[len(words) - n :].tolist(), strict=True))
    digest, seed = xxhash.xxh64_intdigest, SEED
    ones = np.zeros(64, np.int64)
    for at in range(0, n, HASHES_AT_ONCE):
        part = spans[at : at + HASHES_AT_ONCE]
        hashes = np.fromiter((digest(joined[s:e], seed) for s, e in part), np.dtype("<u8"), len(part))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, fp) of every row; fp is the fingerprint as a signed long."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            values = np.fromiter((fingerprint(x.as_py()) for x in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["key", "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"key {kind}, fp bigint"
    )


def _quarters(values: np.ndarray) -> np.ndarray:
    """Population counts of the four 16-bit parts of each value."""
    return np.bitwise_count(np.ascontiguousarray(values).view(np.uint16).reshape(-1, 4)).astype(np.int16)


def forest(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, as (node, root), of the links within ``left`` (right None) or between the two."""
    own = right is None
    sides = []
    for values in (left,) if own else (left, right):
        counts = _quarters(values)
        order = np.lexsort(counts.T[::-1])
        values, counts = values[order], counts[order]
        starts = range(0, len(values), BLOCK)
        low = np.array([counts[s : s + BLOCK].min(0) for s in starts])
        high = np.array([counts[s : s + BLOCK].max(0) for s in starts])
        sides.append((values, low, high))
    (a, a_low, a_high), (b, b_low, b_high) = sides[0], sides[-1]
    nodes = a if own else np.concatenate((a, b))
    shift = 0 if own else len(a)
    trees = Forest(len(nodes))
    for i in range(len(a_low)):
        gap = np.maximum(0, np.maximum(a_low[i] - b_high, b_low - a_high[i])).sum(axis=1)
        rows = a[i * BLOCK : (i + 1) * BLOCK, None]
        found_u, found_v = [], []
        for j in np.flatnonzero(gap <= radius).tolist():
            if own and j < i:
                continue
            close = np.bitwise_count(rows ^ b[None, j * BLOCK : (j + 1) * BLOCK]) <= radius
            u, v = np.nonzero(close)
            u, v = u + i * BLOCK, v + j * BLOCK + shift
            if own:
                u, v = u[u != v], v[u != v]
            if len(u):
                found_u.append(u)
                found_v.append(v)
                if sum(map(len, found_u)) > 1_000_000:
                    trees.link(np.concatenate(found_u), np.concatenate(found_v))
                    found_u, found_v = [], []
        if found_u:
            trees.link(np.concatenate(found_u), np.concatenate(found_v))
    node, root = trees.edges()
    return nodes[node], nodes[root]


def links(nodes: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Links (src, dst) that span the components of distinct fingerprints (column fp) within ``radius`` bits."""
    spark = nodes.sparkSession
    low = F.bit_count(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)))
    high = F.bit_count(F.shiftrightunsigned("fp", 32))
    cells = nodes.select("fp", low.cast("int").alias("low"), high.cast("int").alias("high"))
    # at most 33 x 33 rows
    tiles_of = F.broadcast(
        cells.groupBy("low", "high").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("tiles"))
    )
    tiles = store(
        cells.join(tiles_of, ["low", "high"])
        .withColumn("tile", F.pmod(F.xxhash64(F.col("fp")), F.col("tiles")).cast("int"))
        .groupBy("low", "high", "tile")
        .agg(F.collect_list("fp").alias("fps"))
    )
    reach = [
        (dl, dh)
        for dl in range(-radius, radius + 1)
        for dh in range(-radius, radius + 1)
        if abs(dl) + abs(dh) <= radius and (dl, dh) >= (0, 0)
    ]
    steps = F.array(*[F.struct(F.lit(dl).alias("dl"), F.lit(dh).alias("dh")) for dl, dh in reach])
    same = (F.col("dl") == 0) & (F.col("dh") == 0)
    wanted = (
        tiles.select("low", "high", "tile", F.col("fps").alias("left"), F.inline(steps))
        .select(
            "left", same.alias("same"), F.col("tile").alias("from"), F.col("low").alias("from_low"),
            F.col("high").alias("from_high"), (F.col("low") + F.col("dl")).alias("low"), (F.col("high") + F.col("dh")).alias("high"),
        )
        .join(tiles_of, ["low", "high"])
        .withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .where(~F.col("same") | (F.col("tile") >= F.col("from")))
    )
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    pairs = wanted.join(tiles.withColumnRenamed("fps", "right"), ["low", "high", "tile"]).select(
        "left",
        F.when(F.col("same") & (F.col("tile") == F.col("from")), F.lit(None)).otherwise(F.col("right")).alias("right"),
        F.xxhash64("low", "high", "tile", "from_low", "from_high", "from").alias("deal"),
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right in zip(batch.column(0), batch.column(1), strict=True):
                a = left.values.to_numpy().view(np.uint64)
                b = right.values.to_numpy().view(np.uint64) if right.is_valid else None
                src, dst = forest(a, b, radius)
                if len(src):
                    yield pa.RecordBatch.from_arrays([pa.array(src.view(np.int64)), pa.array(dst.view(np.int64))], ["src", "dst"])

    return pairs.repartition(tasks, "deal").select("left", "right").mapInArrow(run, "src bigint, dst bigint")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, tile_rows: int = TILE_ROWS
) -> DataFrame:
    """(key, fingerprint, component_id) of every row of ``docs``; the key is an integer column.

    Fingerprints that differ in at most ``radius`` bits are linked; component_id is the smallest key
    reachable. Null and wordless texts have fingerprint zero, linked like any other. Rows with a null key
    take part; they never give a component its id, and one without any key has a null id. Repeated rows
    are repeated in the result. An empty table gives no rows.
    """
    rows = store(fingerprints(docs, key, text))
    nodes = store(rows.groupBy("fp").agg(F.min("key").alias("least")))
    labels = connected_components(links(nodes, radius, tile_rows))
    near = nodes.join(labels, nodes.fp == labels.id, "left").select("fp", F.coalesce("component", "fp").alias("component"), "least")
    ids = near.groupBy("component").agg(F.min("least").alias("component_id"))
    return (
        rows.join(near.join(ids, "component").select("fp", "component_id"), "fp")
        .select(F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` of each group of near duplicates: that of the smallest key, a row without one only if none has any.

    Rows are told apart by a stored number, so of rows that repeat a key one stays at most, and other texts of
    that key stand for their own groups.
    """
    order = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.monotonically_increasing_id().alias("number"))
    rows = store(docs.select(F.struct(*docs.columns).alias("row"), order.alias("order")))
    found = near_duplicates(rows.select("order", F.col("row")[text].alias("text")), "order", "text", radius)
    kept = found.where(F.col("order.number") == F.col("component_id.number")).select("order.number")
    return rows.withColumn("number", F.col("order.number")).join(kept, "number", "left_semi").select("row.*")
