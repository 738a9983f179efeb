"""Small tables with the odd cases every operator has to take."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names that operators use inside.
CLASHING = ["row", "key", "content", "lines", "runs", "hits", "items", "n_words", "score", "fp", "id", "component", "size", "block", "piece", "at", "text_beside_row", "label", "digest", "first"]


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    syllables = ["an", "be", "co", "dü", "er", "fi", "gé", "ho", "in", "ka", "lo", "mu"]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(2, 4))) for _ in range(words))


def documents(spark: SparkSession, rows: list[tuple], clashing: bool = False) -> DataFrame:
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return docs.withColumns({c: F.lit(f"extra {c}") for c in CLASHING}) if clashing else docs


def odd_rows() -> list[tuple]:
    """Null and empty texts, blanks, repeated rows, a null id, a very long text, equal texts."""
    long = "\n".join(prose(900 + i, 40) for i in range(500))
    same = prose(1, 80)
    return [(5, None), (6, ""), (7, " \n \t"), (8, same), (8, same), (3, same), (None, same), (None, None), (9, long), (10, prose(2, 3))]
