"""Token counts of whole texts, without making token ids of them.

A tokenizer cuts a text into pre-tokens and each pre-token into tokens on its own. So a text's count is the sum, over its
distinct pre-tokens, of how often it holds one times that one's tokens. Texts are cut in blocks: a block lists its
distinct pre-tokens once, and each of its texts as numbers in that list with frequencies. The lists of all blocks
together give the distinct pre-tokens, whose tokens are counted once each for all blocks that list them; the counts are
joined to the block's texts and summed. A pre-token, however common, has one row a block, so no key holds many rows.

A null text counts as empty: 0 bytes, 0 tokens. Equal rows get equal results, rows are neither merged nor dropped, and
other columns pass by.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from cellspark.functions.lineage import store
from cellspark.llm.rows import packed, texts

LIMIT = 1024
#: A block ends at either; its texts and its list are in one task's memory. A longer text is a block by itself.
BLOCK_BYTES, BLOCK_PIECES = 32 << 20, 500_000
#: Rows of texts, or pre-tokens, that leave a task together.
ROWS_AT_ONCE, PIECES_AT_ONCE = 512, 8_192

#: The pattern of byte-level pre-tokens, as the tokenizers library cuts them.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose classes both pattern engines agree on; tests try each. Other texts are cut by the library itself.
AGREED = regex.compile(r"[\x00-\u024f\u0391-\u03a1\u03b1-\u03c9\u0400-\u045f\u2010-\u2027\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]*+")


class Cutter:
    """The pre-tokens of a text and the number of tokens of a pre-token, as a tokenizer file gives them."""

    def __init__(self, path: str):
        if not path.endswith(".json"):
            raise ValueError(f"pre-tokens are known for tokenizer files in JSON, not for {path}")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added):
            raise ValueError(f"added tokens that take in their surroundings are not handled: {path}")
        #: An added token's string inside a text is one token, and ends the text before it.
        alone = sorted((t.content for t in added), key=len, reverse=True)
        self.alone = regex.compile("|".join(map(regex.escape, alone))) if alone else None
        split = json.loads(self.tokenizer.to_str())["pre_tokenizer"] or {}
        self.byte_level = self.tokenizer.normalizer is None and split.get("type") == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]
        self.pattern = regex.compile(BYTE_LEVEL)
        self.letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def _cut(self, text: str) -> list[str]:
        if not self.byte_level:
            normal = self.tokenizer.normalizer.normalize_str(text) if self.tokenizer.normalizer else text
            return [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)] if self.tokenizer.pre_tokenizer else [normal]
        if AGREED.fullmatch(text):
            return self.pattern.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def pieces(self, text: str) -> tuple[list[str], int]:
        """(pre-tokens, number of added tokens) of a text."""
        if self.alone is None or not self.alone.search(text):
            return self._cut(text), 0
        between = self.alone.split(text)
        return [p for x in between for p in self._cut(x)], len(between) - 1

    def count(self, piece: str) -> int:
        if self.byte_level:
            return sum(len(self.tokenizer.model.tokenize(p)) for p, _ in self.letters.pre_tokenize_str(piece))
        return len(self.tokenizer.model.tokenize(piece))


@lru_cache(maxsize=4)
def cutter(path: str) -> Cutter:
    """One a worker, which runs many tasks."""
    return Cutter(path)


def encode(numbers: np.ndarray, counts: np.ndarray) -> bytes:
    """Numbers of pre-tokens and their frequencies, by planes of bytes: the high ones are mostly zero and compress well."""
    order = np.argsort(numbers)
    widths, planes = [], []
    for values in (numbers[order], counts[order]):
        widths.append(max(1, (int(values.max(initial=0)).bit_length() + 7) // 8))
        planes.append(values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, : widths[-1]].T.tobytes())
    return bytes(widths) + b"".join(planes)


def decode(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    widths, raw = data[:2], np.frombuffer(data, np.uint8, offset=2)
    n, at, out = len(raw) // sum(widths), 0, []
    for width in widths:
        plane = raw[at : at + n * width].reshape(width, n).astype(np.int64)
        out.append((plane << (8 * np.arange(width)[:, None])).sum(axis=0))
        at += n * width
    return out[0], out[1]


def _blocks(batches: Iterable[pa.RecordBatch], path: str, text: str, names: list[str], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Rows of texts (row, n_bytes, alone, entries) and rows of lists (first, pieces), both with their block."""
    cut = cutter(path)
    schema = pa.schema(list(zip(names, [pa.int64(), kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.string())], strict=True)))
    block, held, known = TaskContext.get().partitionId() << 32, 0, {}

    def listed() -> Iterator[pa.RecordBatch]:
        pieces = list(known)
        for at in range(0, len(pieces), PIECES_AT_ONCE):
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip([[block], [None], [None], [None], [None], [at], [pieces[at : at + PIECES_AT_ONCE]]], schema, strict=True)], schema=schema)

    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            sizes, alone, entries, blocks = [], [], [], []
            for data in texts(part, text):
                data = data or b""
                if held and (held + len(data) > BLOCK_BYTES or len(known) >= BLOCK_PIECES):
                    yield from listed()
                    block, held, known = block + 1, 0, {}
                pieces, added = cut.pieces(data.decode("utf-8", "replace"))
                counts = Counter(pieces)
                for p in counts:
                    if p not in known:
                        known[p] = len(known)
                numbers = np.fromiter(map(known.__getitem__, counts), np.int64, len(counts))
                entries.append(encode(numbers, np.fromiter(counts.values(), np.int64, len(counts))))
                sizes.append(len(data))
                alone.append(added)
                blocks.append(block)
                held += len(data)
            n = len(sizes)
            columns = [pa.array(blocks, pa.int64()), part.column("row"), pa.array(sizes, pa.int64()), pa.array(alone, pa.int64()), pa.array(entries, pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=names)
    yield from listed()


def _packed_by_block(batch: pa.RecordBatch, counts: np.ndarray) -> pa.RecordBatch:
    """(of, several): for each block its pre-tokens of this batch that have more than one token, or none."""
    several = np.flatnonzero(counts != 1)
    block, number, counts = batch.column("block").to_numpy()[several], batch.column("number").to_numpy()[several], counts[several]
    order = np.argsort(block, kind="stable")
    of, starts = np.unique(block[order], return_index=True)
    packs = [encode(number[at], counts[at]) for at in np.split(order, starts[1:])] if len(of) else []
    return pa.RecordBatch.from_arrays([pa.array(of, pa.int64()), pa.array(packs, pa.binary())], ["of", "several"])


_NAMES = ["block", "row", "n_bytes", "alone", "entries", "first", "pieces"]


def count_tokens(docs: DataFrame, tokenizer: str, keep: list[str], text: str = "text") -> DataFrame:
    """Every row of ``docs`` as (row: struct of the columns ``keep``, n_bytes, n_tokens).

    ``tokenizer`` is the path of a JSON file of the tokenizers library. No begin or end tokens are counted; an added
    token's string inside a text is one token, as the library has it by default.
    """
    rows = packed(docs, keep, text)
    kind = rows.schema["row"].dataType.simpleString()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        first = next(batches, None)
        if first is not None:
            yield from _blocks(_again(first, batches), tokenizer, text, _NAMES, first.schema.field("row").type)

    blocks = store(rows.mapInArrow(cut, f"block bigint, row {kind}, n_bytes bigint, alone bigint, entries binary, first bigint, pieces array<string>"))
    lists = blocks.where("first IS NOT NULL").select("block", "first", F.posexplode("pieces").alias("nth", "piece")).select("block", (F.col("first") + F.col("nth")).alias("number"), "piece")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, last = cutter(tokenizer), {}
        for batch in batches:
            pieces = batch.column("piece").dictionary_encode()
            counts = {p: last.get(p) or known.count(p) for p in pieces.dictionary.to_pylist()}
            yield _packed_by_block(batch, np.fromiter(counts.values(), np.int64, len(counts))[pieces.indices.to_numpy()])
            last = dict([counts.popitem()]) if counts else {}

    # equal pre-tokens of all blocks stand together, so that each is counted once for all of them
    counted = lists.repartition("piece").sortWithinPartitions("piece").mapInArrow(count, "of bigint, several binary")

    def total(held: pa.Table, counts: pa.Table) -> pa.Table:
        found = [decode(x) for x in counts.column("several").to_pylist()]
        more = np.zeros(max((int(at.max()) for at, _ in found), default=-1) + 1, np.int64)
        for at, n in found:
            more[at] = n - 1
        sums = []
        for data, added in zip(held.column("entries").to_pylist(), held.column("alone").to_pylist(), strict=True):
            at, times = decode(data)
            inside = at < len(more)
            sums.append(added + int(times.sum()) + int(times[inside] @ more[at[inside]]))
        return pa.table({"row": held.column("row"), "n_bytes": held.column("n_bytes"), "n_tokens": pa.array(sums, pa.int64())})

    whole = blocks.where("first IS NULL").select("block", "row", "n_bytes", "alone", "entries")
    return whole.groupBy("block").cogroup(counted.groupBy("of")).applyInArrow(total, f"row {kind}, n_bytes bigint, n_tokens bigint")


def _again(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


def report(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row of ``docs``."""
    counted = count_tokens(docs.select(key, text), tokenizer, [key], text)
    return counted.select(F.col("row")[key].alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
