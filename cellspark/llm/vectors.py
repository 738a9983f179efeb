"""Near duplicates of embeddings: random-hyperplane sign hashing, exact verification, connected components.

Equal vectors are one node with a count. Each node falls into one bucket of every table; buckets of more than
``TILE_ROWS`` are cut into tiles and every pair of tiles of a bucket is one piece of work, so a bucket of
any size is spread over tasks of bounded memory. Cosines are computed exactly, in double precision, as
products of blocks; small buckets of one size are multiplied together. A pair that meets in several tables
counts in the first of them only, which its own signatures tell; so links are counted without ever being
listed, and only counts and a spanning forest of the pieces of work move on.

Two vectors at an angle a share a bit with probability 1 - a / pi. The bits grow with the number of nodes, so
that a bucket holds about ``BUCKET_ROWS`` unrelated ones at every size, and the tables with the bits, so that a
pair at the threshold is missed with probability ``MISS`` at most, closer ones less often: a row of a group of
1,000 such pairs misses 0.0025 links. At a cosine of 0.95 that is 24 tables of 8 bits up to 4,096 nodes, 40 of
12 up to 65,536, 103 of 20 up to 16 million; each bit more asks for 1.11 times as many tables.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.functions.lineage import store
from cellspark.llm.components import Forest, connected_components

COSINE = 0.95
#: Probability of missing a pair at the threshold.
MISS = 2.5e-6
BUCKET_ROWS = 16
#: With more than BUCKET_ROWS * 2 ** 30 nodes buckets grow.
LEAST_BITS, MOST_BITS = 8, 30
SEED = 20_240_601
TILE_ROWS = 2_048
ROWS_AT_ONCE = 512
#: Buckets of at most this many rows are compared together, so many at a time that no array has more numbers than CELLS.
SMALL_ROWS = 128
CELLS = 1 << 20


def shape_of(nodes: int, cosine: float) -> tuple[int, int]:
    """(bits, tables) for so many nodes."""
    bits = min(max(math.ceil(math.log2(max(nodes, 1) / BUCKET_ROWS)), LEAST_BITS), MOST_BITS)
    met = (1 - math.acos(min(max(cosine, -1.0), 1.0)) / math.pi) ** bits
    return bits, 1 if met >= 1 - MISS else math.ceil(math.log(MISS) / math.log1p(-met))


def planes(dimension: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, dimension]).standard_normal((dimension, bits * tables))


def signatures(vectors: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """(n, tables) bucket numbers of the rows of ``vectors``."""
    signs = (vectors @ planes(vectors.shape[1], bits, tables) > 0).reshape(len(vectors), tables, bits)
    return (signs @ (1 << np.arange(bits))).astype(np.uint32)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square overflows or vanishes."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(rows, starts of the groups and the end) of whole groups of rows with equal keys, from batches in which they are neighbours."""
    kept: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.concat_tables([*kept[-1:], pa.Table.from_batches([batch])])
        new = np.zeros(table.num_rows - 1, bool)
        for key in keys:
            values = table[key].to_numpy()
            new |= values[1:] != values[:-1]
        edges = np.concatenate(([0], np.flatnonzero(new) + 1))
        if len(edges) > 1:
            yield table.slice(0, int(edges[-1])), edges
        kept = [table.slice(int(edges[-1]))]
    for table in kept:
        yield table, np.array([0, table.num_rows])


def rows_of(column: list[bytes], kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1)


def compare_small(held: pa.Table, starts: np.ndarray, sizes: np.ndarray, cosine: float, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As ``compare``, for many small tiles each met with itself: rows ``starts[i]`` to ``starts[i] + sizes[i]``."""
    node, count, table, length = (held[c].to_numpy() for c in ("node", "n", "table", "length"))
    vec, sig = held["vec"].to_pylist(), rows_of(held["sig"].to_pylist(), np.uint32)
    links = np.zeros(len(node), np.int64)
    trees = Forest(len(node))
    lengths = length[starts]
    for dimension, size in sorted(set(zip(lengths.tolist(), sizes.tolist(), strict=True))):
        of = starts[(lengths == dimension) & (sizes == size)]
        step = max(1, CELLS // (size * max(size, dimension)))
        for at in range(0, len(of), step):
            rows = of[at : at + step, None] + np.arange(size)
            units = unit(rows_of([vec[i] for i in rows.ravel().tolist()], kind).astype(np.float64)).reshape(*rows.shape, dimension)
            g, i, j = np.nonzero(np.triu(units @ units.transpose(0, 2, 1) >= cosine, 1))
            u, v = rows[g, i], rows[g, j]
            first = np.ones(len(u), bool)
            for t in range(int(table[u].max()) if len(u) else 0):  # met before
                first &= (sig[u, t] != sig[v, t]) | (table[u] <= t)
            u, v = u[first], v[first]
            if len(u):
                np.add.at(links, u, count[v])
                np.add.at(links, v, count[u])
                trees.link(u, v)
    some = np.flatnonzero(links)
    child, root = trees.edges()
    return node[some], links[some], node[child], node[root]


def compare(group: pa.Table, table: int, same: bool, cosine: float, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(nodes, links of each, forest nodes, forest roots) of one piece of work.

    A group holds rows (side, node, n, vec, sig); with ``same`` it is one tile met with itself.
    """
    side = group["side"].to_numpy()
    order = np.argsort(side, kind="stable")
    cut = int((side == 0).sum())
    node = group["node"].to_numpy()[order]
    count = group["n"].to_numpy()[order]
    vec = unit(rows_of(group["vec"].to_pylist(), kind)[order].astype(np.float64))
    sig = rows_of(group["sig"].to_pylist(), np.uint32)[order]
    shift = 0 if same else cut
    links = np.zeros(len(node), np.int64)
    trees = Forest(len(node))
    right, right_sig = vec[shift:], sig[shift:, :table]
    for at in range(0, cut, ROWS_AT_ONCE):
        u, v = np.nonzero(vec[at : min(cut, at + ROWS_AT_ONCE)] @ right.T >= cosine)
        u = u + at
        if same:
            u, v = u[u < v], v[u < v]
        if not len(u):
            continue
        first = np.ones(len(u), bool)
        for t in range(table):  # met before
            first &= sig[u, t] != right_sig[v, t]
        u, v = u[first], v[first] + shift
        np.add.at(links, u, count[v])
        np.add.at(links, v, count[u])
        trees.link(u, v)
    some = np.flatnonzero(links)
    child, root = trees.edges()
    return node[some], links[some], node[child], node[root]


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vec: str = "embedding", cosine: float = COSINE,
                    tile_rows: int = TILE_ROWS) -> DataFrame:
    """(key, n_links, component_id, kept) of every row; the key is an integer column.

    n_links counts the other rows linked directly, equal vectors included; component_id is the smallest key
    reachable, kept whether it is the row's own. Vectors that are null, empty, all zero or hold null or
    non-finite components link with nothing; vectors of different lengths never link. A row without a key
    takes part and gives no component its id. Repeated rows count each. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    # single precision travels as it is
    kind = np.float32 if vectors.schema[vec].dataType.simpleString() == "array<float>" else np.float64
    values = F.col(vec).cast("array<double>")
    sound = (F.size(values) > 0) & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(values, lambda x: x != 0)
    # 0.0 and -0.0 are one value
    rows = vectors.select(F.col(key).alias("key"), F.transform(values, lambda x: x + F.lit(0.0)).alias("vec"), F.coalesce(sound, F.lit(False)).alias("sound"))
    rows = rows.withColumn("c1", F.xxhash64("vec")).withColumn("c2", F.xxhash64(F.lit(7), "vec"))
    nodes = store(
        rows.where("sound").groupBy("c1", "c2").agg(F.min("key").alias("least"), F.count("*").alias("n"), F.first("vec").alias("vec")).withColumn("node", F.monotonically_increasing_id())
    )
    bits, tables = shape_of(nodes.count(), cosine)

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vec")
            lengths = np.diff(column.offsets.to_numpy())
            for length in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == length))
                dense = part.column("vec").flatten().to_numpy().reshape(-1, length)
                sig = signatures(unit(dense), bits, tables)
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), part.column("n"), pa.array(np.full(len(dense), length, np.int32)), pa.array([x.tobytes() for x in dense.astype(kind)], pa.binary()),
                     pa.array([x.tobytes() for x in sig], pa.binary()), pa.array(sig.astype(np.int32).tolist(), pa.list_(pa.int32()))],
                    ["node", "n", "length", "vec", "sig", "buckets"],
                )

    signed = store(nodes.select("node", "n", "vec").mapInArrow(hashed, "node bigint, n bigint, length int, vec binary, sig binary, buckets array<int>"))
    # only buckets of more than one tile; stored, so that Spark knows the size and broadcasts it or not
    sizes = signed.select("length", F.posexplode("buckets").alias("table", "bucket")).groupBy("length", "table", "bucket").agg(F.count("*").alias("size"))
    tiled = store(sizes.where(F.col("size") > tile_rows).select("length", "table", "bucket", F.ceil(F.col("size") / tile_rows).cast("int").alias("tiles")))
    tile = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    placed = (
        signed.select("node", "n", "length", "vec", "sig", F.posexplode("buckets").alias("table", "bucket"))
        .join(tiled, ["length", "table", "bucket"], "left")
        .withColumn("tiles", F.coalesce("tiles", F.lit(1)))
        .withColumn("tile", tile)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(
            "table", "bucket", "length", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"),
            F.when(F.col("tile") <= F.col("other"), 0).otherwise(1).alias("side"), "node", "n", "vec", "sig",
        )
    )
    work = ["table", "bucket", "length", "a", "b"]

    def verified(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, edges in groups(batches, work):
            starts, sizes = edges[:-1], np.diff(edges)
            a, b, table = (held[c].to_numpy() for c in ("a", "b", "table"))
            small = (a[starts] == b[starts]) & (sizes <= SMALL_ROWS)
            some = small & (sizes > 1)
            found = [compare_small(held, starts[some], sizes[some], cosine, kind)] if some.any() else []
            for at, size in zip(starts[~small].tolist(), sizes[~small].tolist(), strict=True):
                found.append(compare(held.slice(at, size), int(table[at]), a[at] == b[at], cosine, kind))
            for node, links, child, root in found:
                if len(node):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate((node, child))), pa.array(np.concatenate((links, np.zeros(len(child), np.int64)))),
                         pa.array(np.concatenate((np.full(len(node), -1), root)))],
                        ["node", "links", "root"],
                    )

    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = store(placed.repartition(tasks, *work).sortWithinPartitions(*work).mapInArrow(verified, "node bigint, links bigint, root bigint"))
    counts = found.where("links > 0").groupBy("node").agg(F.sum("links").alias("links"))
    labels = connected_components(found.where("root >= 0").select(F.col("node").alias("src"), F.col("root").alias("dst")))
    of = nodes.select("c1", "c2", "least", "n", "node").join(counts, "node", "left").join(labels, F.col("node") == F.col("id"), "left")
    of = of.withColumn("component", F.coalesce("component", "node"))
    ids = of.groupBy("component").agg(F.min("least").alias("component_id"))
    of = of.join(ids, "component").select("c1", "c2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    linked = rows.where("sound").select("key", "c1", "c2").join(of, ["c1", "c2"]).select("key", "n_links", "component_id")
    alone = rows.where(~F.col("sound")).select("key", F.lit(0).cast("bigint").alias("n_links"), F.col("key").alias("component_id"))
    return linked.union(alone).select(F.col("key").alias(key), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))
