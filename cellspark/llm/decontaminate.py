"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned over every document.

Normalisation lower-cases A-Z and takes words of letters, digits and non-ASCII characters. A window is
``WINDOW`` consecutive words of a test item; a shorter item is one window. The hash set is one sorted numpy array of
64-bit window hashes, with a table of leading bits before it; a hit is verified against the words of the
window itself, which are kept as one text. Of a word longer than ``LONG_WORD`` bytes its SHA-256 stands there.

Items are cut into pieces that overlap by a window less one word, so one item may have any length. Pieces are
dealt by their size to blocks of at most about ``block_bytes`` of words, which go to the tasks one after another: a
benchmark of any size is scanned block by block, with the hits so far stored in between. The arrays of a block are
built once, on the driver, and take about five times its bytes in a Python worker.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.functions.lineage import store
from cellspark.llm.rows import packed, texts

WINDOW = 10
BLOCK_BYTES = 16 << 20
PIECE_WORDS = 1 << 16
LONG_WORD = 256
KNOWN_WORDS = 1 << 17
FACTOR = np.uint64(0x9E3779B97F4A7C15)
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
WORD = re.compile(rb"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
FOUND = "n_words bigint, hits array<struct<start:bigint,end:bigint>>, items array<string>"


def words_of(text: bytes | None) -> list[bytes]:
    """Normalised words of a UTF-8 text; null has none."""
    return (text or b"").translate(NORMAL).split()


def joined(words: list[bytes]) -> bytes:
    """Words parted by spaces, long ones replaced by a zero byte and their digest."""
    if max(map(len, words), default=0) > LONG_WORD:
        words = [w if len(w) <= LONG_WORD else b"\0" + sha256(w).hexdigest().encode() for w in words]
    return b" ".join(words)


class WordHashes(dict):
    """Hashes of words, remembered until ``forget`` finds too many."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = xxhash.xxh3_64_intdigest(joined([word]))
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > KNOWN_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def window_hashes(ids: np.ndarray, length: int) -> np.ndarray:
    """The hash of every window of ``length`` words, from the words' hashes."""
    many = max(0, len(ids) - length + 1)
    out = np.zeros(many, np.uint64)
    for j in range(length):
        out *= FACTOR
        out += ids[j : j + many]
    return out


class Windows:
    """The windows of some pieces (item id, words parted by single spaces)."""

    def __init__(self, pieces: list[tuple[str | None, bytes]], size: int = WINDOW):
        pieces = [(item, text) for item, text in pieces if text]
        number: dict[str | None, int] = {}
        owner = np.array([number.setdefault(item, len(number)) for item, _ in pieces], np.int64)
        self.names = list(number)
        self.text = b" ".join([text for _, text in pieces])
        self.begins = np.append(np.flatnonzero(np.frombuffer(b" " + self.text, np.uint8) == 32), len(self.text) + 1).astype(np.uint32 if len(self.text) < 1 << 31 else np.int64)
        hashes = WordHashes()
        ids = np.concatenate([np.zeros(0, np.uint64), *(hashes.of(text.split(b" ")) for _, text in pieces)])
        counts = np.array([text.count(b" ") + 1 for _, text in pieces], np.int64)
        ends = np.repeat(np.cumsum(counts), counts)
        lengths = np.repeat(np.minimum(counts, size), counts)
        self.tables = {}
        for length in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == length)
            at = at[at + length <= ends[at]]
            key, of = window_hashes(ids, length)[at], np.repeat(owner, counts)[at]
            order = np.lexsort((at, of, key))
            at, key, of = at[order], key[order], of[order]
            keep = np.ones(len(at), bool)
            kept = 0
            # an item's equal windows count once
            for i in (np.flatnonzero((key[1:] == key[:-1]) & (of[1:] == of[:-1])) + 1).tolist():
                kept = i - 1 if keep[i - 1] else kept
                keep[i] = self.window(int(at[i]), length) != self.window(int(at[kept]), length)
            at, key, of = at[keep], key[keep], of[keep]
            begins = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            bits = min(24, max(8, len(begins).bit_length() + 3))
            leading = np.zeros(1 << bits, bool)
            leading[key >> np.uint64(64 - bits)] = True
            self.tables[length] = (leading, np.uint64(64 - bits), key[begins], np.append(begins, len(at)).astype(np.uint32), at.astype(np.uint32), of.astype(np.uint32))

    def window(self, at: int, length: int) -> bytes:
        return self.text[self.begins[at] : self.begins[at + length] - 1]

    def scan(self, text: bytes | None, hashes: WordHashes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """(number of words, hit spans in words, items with occurring windows) of a text."""
        words = words_of(text)
        ids = hashes.of(words)
        spans, items, seen = [], set(), {}
        for length, (leading, shift, keys, begins, places, owners) in self.tables.items():
            found = window_hashes(ids, length)
            at = np.flatnonzero(leading[found >> shift])
            near = np.minimum(np.searchsorted(keys, found[at]), len(keys) - 1)
            same = keys[near] == found[at]
            for start, k in zip(at[same].tolist(), near[same].tolist(), strict=True):
                said = joined(words[start : start + length])
                if said not in seen:
                    run = range(begins[k], begins[k + 1])
                    seen[said] = {int(owners[i]) for i in run if self.window(int(places[i]), length) == said}
                    items.update(seen[said])
                if seen[said]:
                    spans.append((start, start + length))
        return len(words), merged(spans), {name for name in map(self.names.__getitem__, items) if name is not None}


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, disjoint spans that cover the same words."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """A text without the words of ``spans`` and what lies between words of one span."""
    places = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for start, end in spans:
        out.append(text[at : places[start][0]])
        at = places[end - 1][1]
    return b"".join([*out, text[at:]])


def cut(tests: DataFrame, size: int = WINDOW, piece_words: int = PIECE_WORDS) -> DataFrame:
    """(item, words, bytes) of the pieces of test items (item, text): normalised words, parted by spaces.

    Every window of an item lies in one piece. Items without words have none.
    """
    step = max(1, piece_words - size + 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                words = words_of(text)
                starts = range(0, max(1, len(words) - size + 1), step) if words else ()
                for first in range(0, len(starts), 16):
                    pieces = [joined(words[at : at + step + size - 1]) for at in starts[first : first + 16]]
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(pieces), pa.string()), pa.array(pieces, pa.binary()), pa.array(map(len, pieces), pa.int64())], ["item", "words", "bytes"])

    return tests.mapInArrow(run, "item string, words binary, bytes bigint")


def blocks_of(pieces: DataFrame, block_bytes: int) -> list[list[int]]:
    """Buckets of pieces (see ``scan``) dealt to blocks in turn: a block has at most ``block_bytes``, or one bucket."""
    out, room = [], 0
    for bucket, size in sorted((r["bucket"], r["bytes"]) for r in pieces.groupBy("bucket").agg(F.sum("bytes").alias("bytes")).collect()):
        if size > room:
            out.append([])
            room = block_bytes
        out[-1].append(bucket)
        room -= size
    return out


def scan(docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text", item: str = "item_id",
         item_text: str = "text", size: int = WINDOW, block_bytes: int = BLOCK_BYTES, piece_words: int = PIECE_WORDS) -> DataFrame:
    """Every row of ``docs`` as (row: struct of the columns ``keep``, n_words, hits, items).

    hits are disjoint spans of words inside occurrences of any window, items the ids (as text) of test items
    with an occurring window. Null and wordless texts have no hits; items without words have no windows;
    an item without an id gives hits but no entry in items. An empty benchmark hits nothing. Rows are
    neither merged nor dropped, and columns are only taken by the given names.
    """
    spark = docs.sparkSession
    tests = benchmark.select(F.col(item).cast("string").alias("item"), F.col(item_text).cast("string").alias("text")).distinct()
    pieces = store(cut(tests, size, piece_words))
    total = pieces.agg(F.sum("bytes")).first()[0] or 0
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("item", "words"), F.lit(max(1, -(-4 * total // block_bytes)))))
    blocks = blocks_of(pieces, block_bytes) or [[]]
    rows = packed(docs, keep, text)
    beside = [c for c in rows.columns if c != "row"]
    kind = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in rows.columns)
    out = rows.select(
        "*", F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("hits"), F.array().cast("array<string>").alias("items"),
    )
    for block, buckets in enumerate(blocks):
        held = pieces.where(F.col("bucket").isin(buckets)).select("item", "words").collect()  # block_bytes
        sent = spark.sparkContext.broadcast(Windows([(r["item"], bytes(r["words"])) for r in held], size))

        def run(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            windows, hashes = sent.value, WordHashes()
            for batch in batches:
                n, hits, items = [], [], []
                old_hits, old_items = batch.column("hits"), batch.column("items")
                for i, x in enumerate(texts(batch, text)):
                    n_words, spans, names = windows.scan(x, hashes)
                    n.append(n_words)
                    hits.append([{"start": s, "end": e} for s, e in merged([*spans, *((h["start"], h["end"]) for h in old_hits[i].as_py())])])
                    items.append(sorted(names.union(old_items[i].as_py())))
                columns = {c: batch.column(c) for c in ("row", *beside)} | {
                    "n_words": pa.array(n, pa.int64()),
                    "hits": pa.array(hits, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    "items": pa.array(items, pa.list_(pa.string())),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

        out = out.mapInArrow(run, f"{kind}, {FOUND}")
        if block < len(blocks) - 1:
            out = store(out)
    return out.drop(*beside)


def report(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", size: int = WINDOW,
           block_bytes: int = BLOCK_BYTES, piece_words: int = PIECE_WORDS) -> DataFrame:
    """(key, n_words, n_hit, n_items, items_sha256, contaminated) of every row; see ``scan`` for odd cases."""
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, h: n + h["end"] - h["start"])
    return scan(docs, benchmark, [key], text, size=size, block_bytes=block_bytes, piece_words=piece_words).select(
        F.col("row")[key].alias(key),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", size: int = WINDOW,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` without any hit, all columns as they are."""
    return scan(docs, benchmark, docs.columns, text, size=size, block_bytes=block_bytes).where(F.size("hits") == 0).select("row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", size: int = WINDOW,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All rows of ``docs``; hit spans are cut out of ``text``, other texts and columns stay as they are."""
    found = scan(docs, benchmark, docs.columns, text, size=size, block_bytes=block_bytes)
    kind = found.schema["row"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("row")
            at = row.type.get_field_index(text)
            cleaned = [
                without(x.as_py(), [(h["start"], h["end"]) for h in spans.as_py()]).decode() if len(spans) else (x.as_py() or b"").decode() if x.is_valid else None
                for x, spans in zip(row.field(at).cast(pa.binary()), batch.column("hits"), strict=True)
            ]
            fields = [pa.array(cleaned, row.type.field(at).type) if i == at else row.field(i) for i in range(row.type.num_fields)]
            yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(fields, fields=list(row.type))], ["row"])

    return found.select("row", "hits").mapInArrow(run, f"row {kind}").select("row.*")
