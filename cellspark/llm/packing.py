"""Best-fit packing of documents into sequences of several permitted lengths.

Documents are cut into pieces of at most the greatest length. Pieces are dealt at random into blocks of
about ``BLOCK_PIECES``, and every block is packed on its own, longest pieces first: a piece goes into the
open bin that it fills best; if none has room, a new bin is opened at the length with the least cost for
each word it can expect to hold, given the pieces still to come. Last, each bin shrinks to the least
length that holds its contents. Only lengths move; a block's state is bounded by its number of pieces.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellspark.functions.lineage import store

LENGTHS = (512, 1024, 2048, 4096)
BLOCK_PIECES = 32_768
#: Cost of a bin: a share for the sequence itself, its length, and attention, which grows with the square.
PER_BIN, PER_SQUARE = 32.0, 1 / 65_536


def cost(length: int) -> float:
    return PER_BIN + length + PER_SQUARE * length * length


def pack_block(sizes: np.ndarray, lengths: tuple[int, ...] = LENGTHS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset, capacity) of each size; sizes are from 1 to the greatest length.

    Ties go to the earlier piece and the older bin. Bins are numbered from 0 as they are opened.
    """
    lengths = tuple(sorted(lengths))
    order = np.argsort(-sizes, kind="stable")
    falling = sizes[order]
    # words still to come, from the i-th piece on; and where pieces of at most g words begin
    rest = np.concatenate((np.cumsum(falling[::-1])[::-1], [0])).tolist()
    fits_from = np.searchsorted(-falling, -np.arange(lengths[-1] + 1), side="left").tolist()
    open_bins: list[deque[int]] = [deque() for _ in range(lengths[-1] + 1)]  # by room left, oldest last
    some = 0  # bit r is set if a bin has r words of room
    filled: list[int] = []
    where = np.zeros(len(sizes), np.int64)
    offset = np.zeros(len(sizes), np.int64)
    for i, n in enumerate(falling.tolist()):
        fitting = some >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                some ^= 1 << room
        else:
            best = None
            for length in lengths:
                if length >= n:
                    gap = length - n
                    expected = n + min(gap, rest[max(i + 1, fits_from[gap])])
                    final = next(c for c in lengths if c >= expected)
                    each = cost(final) / expected
                    if best is None or each < best[0]:
                        best = (each, length)
            room = best[1]
            b = len(filled)
            filled.append(0)
        at = order[i]
        where[at], offset[at] = b, filled[b]
        filled[b] += n
        room -= n
        if room:
            if not open_bins[room]:
                some |= 1 << room
            open_bins[room].appendleft(b)
    final = np.array(lengths)[np.searchsorted(lengths, filled)] if filled else np.zeros(0, np.int64)
    return where, offset, final[where] if len(where) else where


def word_count(text: str) -> Column:
    """Words of a text, parted by white space; null has none."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(r"\S+")), F.lit(0)).cast("bigint")


def pack(docs: DataFrame, key: str = "doc_id", size: Column | None = None, lengths: tuple[int, ...] = LENGTHS,
         block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """A row for each piece of each row of ``docs``.

    Columns: key, piece (from 0), start and n_words (the words of the document in it), bin_id, bin_offset
    and capacity (the bin's final length). ``size`` counts a row's words (default: those of column text).
    A document without words gives one piece of none, in no bin (nulls). Repeated rows and rows without a
    key are packed like others; an empty table gives no rows.
    """
    longest = max(lengths)
    rows = store(
        docs.select(F.col(key).alias("key"), (word_count("text") if size is None else size).cast("bigint").alias("size")).withColumn("row", F.monotonically_increasing_id())
    )
    many = F.ceil(F.col("size") / longest)
    total = rows.agg(F.sum(many)).first()[0] or 0
    blocks = max(1, -(-int(total) // block_pieces))
    pieces = (
        rows.select("key", "row", "size", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(many - 1, F.lit(0)).cast("bigint"))).alias("piece"))
        .select("key", "row", "piece", (F.col("piece") * longest).alias("start"), F.least(F.col("size") - F.col("piece") * longest, F.lit(longest)).alias("n_words"))
    )
    held = pieces.where("n_words > 0").withColumn("block", F.pmod(F.xxhash64("row", "piece"), F.lit(blocks)))
    kind = docs.schema[key].dataType.simpleString()

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("row", "ascending"), ("piece", "ascending")])
        where, offset, capacity = pack_block(group["n_words"].to_numpy(), lengths)
        block = group["block"].to_numpy()
        return group.select(["key", "piece", "start", "n_words"]).append_column("bin_id", pa.array((block << 32) + where)).append_column(
            "bin_offset", pa.array(offset)
        ).append_column("capacity", pa.array(capacity.astype(np.int64)))

    columns = f"key {kind}, piece bigint, start bigint, n_words bigint, bin_id bigint, bin_offset bigint, capacity bigint"
    packed = held.repartition(blocks, "block").groupBy("block").applyInArrow(run, columns)
    none = F.lit(None).cast("bigint")
    empty = pieces.where("n_words = 0").select(
        "key", "piece", "start", "n_words", none.alias("bin_id"), none.alias("bin_offset"), none.alias("capacity")
    )
    return packed.union(empty).withColumnRenamed("key", key)
