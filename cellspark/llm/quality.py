"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

A document's terms are pairs of adjacent character classes (letters in either case, digits, line breaks,
each punctuation mark...), hashed words, and classes of its length, its share of distinct words and its
share of words that repeat the one before. Term
weights use document frequencies over all documents. A truncated singular value decomposition of at most
``MAX_LABELLED`` labelled documents gives the latent space; their vectors are broadcast (at most a few MB),
and every document's cosines to all of them are computed exactly, block by block. The nearest ``NEIGHBOURS``
vote with weights that grow with their similarity, and a small weight votes for the labels' mean.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.functions.lineage import store
from cellspark.llm.rows import packed, texts

#: The only bound on what is fitted: labelled documents, half of them of each label where there are enough.
MAX_LABELLED = 4_096
DIMENSIONS = 64
NEIGHBOURS = 25
SHARPNESS = 12
PRIOR_WEIGHT = 1e-3
ACCEPT = 0.3
ROWS_AT_ONCE = 256

CLASSES = 32
WORD_TERMS = 4_096
DOC_TERMS = 32
PAIR_TERMS = CLASSES * CLASSES
TERMS = PAIR_TERMS + WORD_TERMS + DOC_TERMS
#: Weight of the three kinds of terms in a vector.
SHARES = (1.0, 0.5, 0.5)
MARKS = b".,!?*#$%&|-:;'\"()/<>=_@+\\"
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_CLASS = np.zeros(256, np.int64)
for _c in range(256):
    _CLASS[_c] = (
        1 if 97 <= _c <= 122 else 2 if 65 <= _c <= 90 else 3 if 48 <= _c <= 57 else 4 if _c >= 128 else 5 if _c in b" \t" else 6 if _c in b"\r\n"
        else 7 + MARKS.index(_c) if _c in MARKS else 0
    )
KNOWN_WORDS = 1 << 20


def terms(text: bytes, known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """(term numbers, weights before document frequencies) of a UTF-8 text; known caches the words' numbers."""
    classes = _CLASS[np.frombuffer(b"\n" + text + b"\n", np.uint8)]
    pairs = np.bincount(classes[:-1] * CLASSES + classes[1:], minlength=PAIR_TERMS)
    pair_at = np.flatnonzero(pairs)
    pair_weight = np.sqrt(pairs[pair_at] / (len(text) + 1))
    words = text.translate(WORDS).split()
    if len(known) > KNOWN_WORDS:
        known.clear()
    different = set(words)
    for w in different.difference(known):
        known[w] = crc32(w) % WORD_TERMS
    numbers = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    counts = np.bincount(numbers, minlength=WORD_TERMS)
    word_at = np.flatnonzero(counts)
    distinct = 16 * len(different) // max(1, len(words))
    again = int(8 * (numbers[1:] == numbers[:-1]).mean()) if len(words) > 1 else 0
    doc_at = np.array([min(distinct, 15), 16 + min(7, len(words).bit_length() // 2), 24 + min(again, 7)])
    at = np.concatenate((pair_at, PAIR_TERMS + word_at, PAIR_TERMS + WORD_TERMS + doc_at))
    return at, np.concatenate((pair_weight, np.log1p(counts[word_at]), np.ones(3)))


def weighted(at: np.ndarray, weight: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Weights times rarity, each kind of terms scaled to its share."""
    out = weight * rarity[at]
    for low, high, share in ((0, PAIR_TERMS, SHARES[0]), (PAIR_TERMS, PAIR_TERMS + WORD_TERMS, SHARES[1]), (PAIR_TERMS + WORD_TERMS, TERMS, SHARES[2])):
        kind = (at >= low) & (at < high)
        length = np.sqrt((out[kind] ** 2).sum())
        if length > 0:
            out[kind] *= share / length
    return out.astype(np.float32)


def decompose(matrix: np.ndarray, dimensions: int) -> np.ndarray:
    """(terms, dimensions) leading right singular vectors, by subspace iteration."""
    dimensions = min(dimensions, *matrix.shape)
    basis = np.random.default_rng(7).standard_normal((matrix.shape[1], min(dimensions + 16, *matrix.shape))).astype(np.float32)
    for _ in range(4):
        basis, _ = np.linalg.qr(matrix.T @ (matrix @ basis))
    _, _, right = np.linalg.svd(matrix @ basis, full_matrices=False)
    return np.ascontiguousarray((basis @ right.T)[:, :dimensions], np.float32)


def unit(rows: np.ndarray) -> np.ndarray:
    length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(length > 0, length, 1)


class Model:
    """Rarity of terms, latent space, and the labelled vectors in it."""

    def __init__(self, rarity: np.ndarray, sparse: list[tuple[np.ndarray, np.ndarray]], labels: list[int]):
        self.rarity = rarity
        self.labels = np.array(labels, np.float64)
        self.mean = float(self.labels.mean()) if labels else 0.5
        matrix = np.zeros((len(sparse), TERMS), np.float32)
        for row, (at, weight) in zip(matrix, sparse, strict=True):
            row[at] = weighted(at, weight, rarity)
        self.space = decompose(matrix, DIMENSIONS) if labels else np.zeros((TERMS, 1), np.float32)
        self.known = unit(matrix @ self.space)

    def scores(self, texts: list[bytes], words: dict[bytes, int]) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(texts), self.mean)
        latent = np.zeros((len(texts), self.space.shape[1]), np.float32)
        for row, text in zip(latent, texts, strict=True):
            at, weight = terms(text, words)
            row[:] = weighted(at, weight, self.rarity) @ self.space[at]
        cosines = unit(latent) @ self.known.T
        k = min(NEIGHBOURS, cosines.shape[1])
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.clip(np.take_along_axis(cosines, near, 1).astype(np.float64), 0, 1) ** SHARPNESS
        return ((weight * self.labels[near]).sum(1) + PRIOR_WEIGHT * self.mean) / (weight.sum(1) + PRIOR_WEIGHT)


def _texts(batch: pa.RecordBatch, name: str) -> list[bytes]:
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", max_labelled: int = MAX_LABELLED) -> Model:
    """The model of labelled documents; ``labels`` has (key, label) rows, of which those with a null are left out.

    Of each label the rows with the least hashes of their key are taken. A key labelled both ways counts as 1; of a
    key with several texts the one with the least hash is learnt from.
    """
    whole = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, words, n = np.zeros(TERMS, np.int64), {}, 0
        for batch in _slices(batches):
            for x in _texts(batch, "text"):
                seen[terms(x, words)[0]] += 1
                n += 1
        held = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(held, TERMS)), pa.array(np.append(seen[held], n))], ["term", "n"])

    counted = whole.select("text").mapInArrow(frequencies, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    frequency = np.zeros(TERMS + 1, np.int64)
    for row in counted.collect():  # TERMS + 1 rows at most
        frequency[row["term"]] = row["n"]
    total = frequency[TERMS]
    rarity = np.log((1 + total) / (1 + frequency[:TERMS])) + 0.1
    rarity[:PAIR_TERMS] = 1.0

    valid = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).dropna().where(F.col("label").isin(0, 1))
    valid = valid.groupBy("key").agg(F.max("label").alias("label"))
    drawn = valid.where("label = 1").orderBy(F.xxhash64("key"), "key").limit(max_labelled // 2).union(
        valid.where("label = 0").orderBy(F.xxhash64("key"), "key").limit(max_labelled // 2)
    )

    def sparse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[bytes, int] = {}
        for batch in _slices(batches):
            found = [terms(x, words) for x in _texts(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("label"), pa.array([a.astype(np.uint16).tobytes() for a, _ in found], pa.binary()), pa.array([w.astype(np.float32).tobytes() for _, w in found], pa.binary())],
                ["key", "label", "at", "weight"],
            )

    # max_labelled keys
    known = whole.join(F.broadcast(store(drawn)), "key").groupBy("key", "label")
    # of a key's texts the one with the least hash, whatever the order of rows
    chosen = known.agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    kind = chosen.schema["key"].dataType.simpleString()
    rows = sorted(chosen.mapInArrow(sparse, f"key {kind}, label int, at binary, weight binary").collect(), key=lambda r: r["key"])
    vectors = [(np.frombuffer(r["at"], np.uint16).astype(np.int64), np.frombuffer(r["weight"], np.float32)) for r in rows]
    return Model(rarity, vectors, [r["label"] for r in rows])


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """Every row of ``docs`` as (row: struct of the columns ``keep``, score: double from 0 to 1).

    Null and empty texts are scored by their few terms like others. Without labelled documents every score
    is 0.5. Rows are neither merged nor dropped.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, words = sent.value, {}
        for batch in _slices(batches):
            scores = known.scores([x or b"" for x in texts(batch, text)], words)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(scores)], ["row", "score"])

    rows = packed(docs, keep, text)
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, score double")


def training(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """The labels that may be learnt from."""
    return labels.where(~held_out(key))


def held_out(key: str = "doc_id"):
    """Whether a row is held out: crc32 of its key as text is a multiple of five; null keys are not."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def report(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted) of every row of ``docs``; held-out labels are not learnt from."""
    model = fit(docs, training(labels, key), key, text)
    scored = score(docs, model, [key], text).select(F.col("row")[key].alias(key), "score")
    return scored.select(key, held_out(key).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of at least ``ACCEPT``, all columns as they are."""
    model = fit(docs, training(labels, key), key, text)
    return score(docs, model, docs.columns, text).where(F.col("score") >= ACCEPT).select("row.*")
