"""Fill-in-middle: texts cut into units and put together as prefix, suffix and middle, or suffix, prefix and middle.

A unit is a word with the white space before it; white space at the end of a text is a unit of its own. The numbers of
units before and after the middle come from a hash of the row's key, as does the form. Each Arrow batch goes through one
columnar pipeline: a mark after every unit, a split into lists, the lists flattened with the number of the text each
unit came from, the units' ordinals, a filter for each of the three roles, lists built again from what is left, and the
pieces joined.

Texts are taken whole. A null text counts as empty, a null key as the empty string; empty texts and texts that hold a
sentinel stay plain. Equal rows get equal results, rows are neither merged nor dropped, and other columns pass by.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellspark.llm.rows import TEXT, packed

SEED = 42
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Out of 100 texts so many are transformed, and of 100 transformed ones so many begin with the suffix.
TRANSFORMED, SUFFIX_FIRST = 50, 80
#: Bytes of text that go through the pipeline at once; a longer text goes alone.
BYTES_AT_ONCE = 32 << 20

#: A byte that no UTF-8 text holds, set after each unit.
_MARK = b"\xff"
_UNIT = rb"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"
_DRAWN = [f"drawn_{i}" for i in range(1, 5)]
_OUT = "n bigint, form string, prefix string, middle string, suffix string, output string"


def draws(key: str, seed: int = SEED) -> list[Column]:
    """Four numbers below 2^32: the first groups of eight digits of the hash of the seed and the key as text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]


def _modulo(a: pa.Array, b: pa.Array | int) -> pa.Array:
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))


def _offsets(parent: pa.Array, rows: int) -> pa.Array:
    """Where each text's units begin, and the end: ``parent`` names the text of each unit, in order."""
    counts = pc.value_counts(pa.concat_arrays([parent, pa.array(range(rows), pa.int64())]))
    order = pc.sort_indices(counts.field("values"))
    return pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(pc.subtract(counts.field("counts").take(order), 1))])


def transform(text: pa.Array, drawn: list[pa.Array]) -> list[pa.Array]:
    """(n, form, prefix, middle, suffix, output) of binary texts without nulls; the three parts are null if plain."""
    rows = len(text)
    marked = pc.replace_substring_regex(text, _UNIT, rb"\1" + _MARK)
    lists = pc.split_pattern(marked, _MARK)
    unit, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    real = pc.greater(pc.binary_length(unit), 0)  # a split leaves an empty piece after the last mark
    unit, parent = unit.filter(real), parent.filter(real).cast(pa.int64())

    begin = _offsets(parent, rows)
    n = pc.subtract(begin.slice(1), begin.slice(0, rows))
    ordinal = pc.subtract(pa.array(range(len(unit)), pa.int64()), begin.take(parent))
    cuts = [_modulo(h, pc.add(n, 1)) for h in drawn[:2]]
    low, high = pc.min_element_wise(*cuts).take(parent), pc.max_element_wise(*cuts).take(parent)

    def joined(role: pa.Array) -> pa.Array:
        at = _offsets(parent.filter(role), rows).cast(pa.int32())
        return pc.binary_join(pa.ListArray.from_arrays(at, unit.filter(role)), b"")

    parts = [joined(pc.less(ordinal, low)), joined(pc.and_(pc.greater_equal(ordinal, low), pc.less(ordinal, high))), joined(pc.greater_equal(ordinal, high))]
    signs = [s.encode() for s in (PREFIX, MIDDLE, SUFFIX)]
    plain = pc.or_(pc.equal(n, 0), pc.greater_equal(_modulo(drawn[2], 100), TRANSFORMED))
    for sign in signs:
        plain = pc.or_(plain, pc.match_substring(text, sign))
    spm = pc.less(_modulo(drawn[3], 100), SUFFIX_FIRST)

    def ordered(*order: int) -> pa.Array:
        return pc.binary_join_element_wise(*[x for i in order for x in (pa.scalar(signs[i]), parts[i])], b"")

    output = pc.if_else(plain, text, pc.if_else(spm, ordered(2, 0, 1), ordered(0, 2, 1)))
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    none = pa.scalar(None, pa.binary())
    return [n, form, *[pc.if_else(plain, none, p).cast(pa.string()) for p in parts], output.cast(pa.string())]


def _slices(batch: pa.RecordBatch, text: pa.Array) -> Iterator[tuple[int, int]]:
    """(first row, rows) of slices of at most ``BYTES_AT_ONCE``, or one row."""
    start = held = 0
    for i, size in enumerate(pc.binary_length(text).to_pylist()):
        if held and held + size > BYTES_AT_ONCE:
            yield start, i - start
            start, held = i, 0
        held += size
    if start < len(text):
        yield start, len(text) - start


def fill_in_middle(docs: DataFrame, keep: list[str], key: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """Every row as (row: struct of ``keep``, n, form, prefix, middle, suffix, output)."""
    rows = packed(docs.withColumns(dict(zip(_DRAWN, draws(key, seed), strict=True))), [*keep, *_DRAWN], text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("row")
            whole = (batch.column(TEXT) if TEXT in batch.schema.names else row.field(text)).cast(pa.binary()).fill_null(b"")
            for at, size in _slices(batch, whole):
                part = row.slice(at, size)
                drawn = [pc.struct_field(part, d) for d in _DRAWN]
                out = transform(whole.slice(at, size), drawn)
                yield pa.RecordBatch.from_arrays([part, *out], ["row", *[c.split()[0] for c in _OUT.split(", ")]])

    done = rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, {_OUT}")
    return done.withColumn("row", F.struct(*[F.col("row")[c].alias(c) for c in keep]))


def restored(output: Column, form: Column) -> Column:
    """The text again from an output and its form."""
    pieces = F.split(output, "<[PSM]>")  # before the first sentinel nothing, then three parts
    first, second, third = (F.get(pieces, F.lit(i)) for i in (1, 2, 3))
    return F.when(form == "plain", output).when(form == "spm", F.concat(second, third, first)).otherwise(F.concat(first, third, second))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of every row of ``docs``."""
    done = fill_in_middle(docs.select(key, text), [key], key, text)
    return done.select(
        F.col("row")[key].alias(key), "n", "form", F.length("prefix").cast("bigint").alias("prefix_chars"), F.length("middle").cast("bigint").alias("middle_chars"),
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )
