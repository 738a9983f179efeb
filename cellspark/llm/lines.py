"""Removal of repeated line runs by a suffix array over line ids. DataFrame functions only.

1. Lines with words are hashed (128 bits); those that occur once split the documents into segments of
   repeated lines, and a segment with fewer than ``min_words`` words can hold no long run. Segments with the
   same lines are one sequence; every copy but the first is a later copy as a whole.
2. The suffixes of the sequences are ranked by prefix doubling: ranks by line, then by pairs of ranks one,
   two, four... lines apart. A rank is a position among the sorted distinct keys, found by range partitions
   and their sizes. Doubling ends when half the longest window is reached.
3. Suffixes that share their first n lines are neighbours in the array: an interval of common prefixes of
   at least n, named by the ranks at its start and at n lines less the greatest power of two. For every
   line the shortest windows of at least ``min_words`` words that begin or end there are looked up; the
   interval's first member stays, the others are later copies. A maximal repeated run of enough words is
   the union of the windows inside it, so what is deleted is exactly the later copies of maximal runs.

Counts and ranks are aggregated before they move; no task gathers a group of copies, and rows whose line or
rank is very common take their rank or first place from a broadcast (``rows.meet``). What is gathered into one
row never exceeds one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellspark.functions.lineage import store
from cellspark.llm.rows import meet

MIN_WORDS = 50
SEQ = ["s1", "s2"]


def _lines(text: str) -> Column:
    return F.split(F.col(text).cast("string"), "\n", -1)


def _content(text: str) -> Column:
    return F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256)


def hashed_lines(docs: DataFrame, key: str, text: str, min_words: int) -> DataFrame:
    """(key, content, pos, line, words, h1, h2) of every line with words, in documents of enough words.

    pos counts lines with words, line counts all lines of the text.
    """
    filled = F.filter(
        F.transform(_lines(text), lambda x, i: F.struct(i.alias("line"), F.regexp_count(x, F.lit(r"\S+")).alias("words"), F.xxhash64(x).alias("h1"), F.xxhash64(F.lit(7), x).alias("h2"))),
        lambda s: s["words"] > 0,
    )
    rows = docs.select(F.col(key).alias("key"), _content(text).alias("content"), filled.alias("lines"))
    enough = F.aggregate("lines", F.lit(0).cast("bigint"), lambda n, s: n + s["words"]) >= min_words
    return rows.where(enough).select("key", "content", F.posexplode("lines").alias("pos", "at")).select("key", "content", "pos", "at.*")


def ranked(rows: DataFrame, keys: list[str], name: str, apart: list[str]) -> DataFrame:
    """``rows`` with the dense rank, from 1, of their (never null) keys among all distinct keys; ``apart`` tells rows from one another."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = store(rows.groupBy(*keys).agg(F.count("*").alias("copies")).repartitionByRange(parts, *keys).withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each partition
    offsets = distinct.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*keys))
    numbered = distinct.withColumn("inside", inside).join(F.broadcast(offsets), "part").select(*keys, "copies", (F.col("inside") + F.col("before")).alias(name))
    return meet(rows, numbered, keys, "copies", apart, distinct).select(*rows.columns, f"met.{name}")


def segments(lines: DataFrame, min_words: int) -> DataFrame:
    """(key, content, seg, lines, s1, s2) of the segments of repeated lines with enough words."""
    often = store(lines.groupBy("h1", "h2").agg(F.count("*").alias("copies")).where("copies > 1"))
    repeated = meet(lines, often, ["h1", "h2"], "copies", ["key", "content", "pos"]).drop("met")
    # a row given twice is one document: its lines are the same rows
    repeated = repeated.repartition("key", "content").dropDuplicates(["key", "content", "pos"])
    inside = Window.partitionBy("key", "content").orderBy("pos")
    breaks = F.coalesce(F.col("pos") - F.lag("pos").over(inside) != 1, F.lit(True)).cast("int")
    return (
        repeated.withColumn("break", breaks)
        .withColumn("seg", F.sum("break").over(inside))
        .groupBy("key", "content", "seg")
        .agg(F.sum("words").alias("total"), F.sort_array(F.collect_list(F.struct("pos", "line", "words", "h1", "h2"))).alias("lines"))
        .where(F.col("total") >= min_words)
        .withColumn("s1", F.xxhash64(F.col("lines.h1"), F.col("lines.h2")))
        .withColumn("s2", F.xxhash64(F.lit(7), F.col("lines.h2"), F.col("lines.h1")))
    )


def windows_of(suffixes: DataFrame, min_words: int) -> DataFrame:
    """(s1, s2, start, end) of the shortest windows with enough words that begin or end at each line."""
    of = Window.partitionBy(*SEQ)
    upto = F.sum("words").over(of.orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    placed = suffixes.select(*SEQ, "at", "words").withColumn("upto", upto).withColumn("from", F.col("upto") - F.col("words"))
    # lines that begin before the window is full; lines that end before it may begin
    end = F.count("*").over(of.orderBy("from").rangeBetween(Window.unboundedPreceding, min_words - 1))
    start = F.count("*").over(of.orderBy("upto").rangeBetween(Window.unboundedPreceding, -min_words))
    total = F.max("upto").over(of)
    found = placed.withColumn("end", end).withColumn("start", start).withColumn("total", total)
    forward = found.where(F.col("total") - F.col("from") >= min_words).select(*SEQ, F.col("at").cast("bigint").alias("start"), "end")
    backward = found.where(F.col("upto") >= min_words).select(*SEQ, "start", (F.col("at") + 1).cast("bigint").alias("end"))
    return forward.union(backward).distinct()


def later_lines(sequences: DataFrame, min_words: int) -> DataFrame:
    """(s1, s2, at) of the lines of sequences (s1, s2, ord, lines) inside runs that an earlier place has.

    Places are ordered by ord, the rank of a sequence's first occurrence, then by line. A window is a later
    copy if the first one ends before it begins, so a line repeated on and on keeps its first window.
    """
    suffixes = sequences.select(*SEQ, "ord", F.posexplode("lines").alias("at", "x")).select(*SEQ, "ord", "at", "x.words", "x.h1", "x.h2")
    wanted = store(windows_of(suffixes, min_words))
    longest = wanted.agg(F.max(F.col("end") - F.col("start"))).first()[0] or 0
    ranks = store(ranked(suffixes, ["h1", "h2"], "r0", [*SEQ, "at"]).select(*SEQ, "ord", "at", "r0"))
    levels = 0
    while 2 << levels <= longest:
        apart = Window.partitionBy(*SEQ).orderBy("at")
        shifted = ranks.withColumn("next", F.coalesce(F.lead(f"r{levels}", 1 << levels).over(apart), F.lit(0)))
        ranks = store(ranked(shifted, [f"r{levels}", "next"], f"r{levels + 1}", [*SEQ, "at"]).drop("next"))
        levels += 1
    every = F.array(*[f"r{k}" for k in range(levels + 1)])
    size = F.col("end") - F.col("start")
    level = F.coalesce(*[F.when(size >= 1 << k, k) for k in range(levels, -1, -1)])
    powers = F.array(*[F.lit(1 << k).cast("bigint") for k in range(levels + 1)])
    begins = ranks.select(*SEQ, F.col("at").alias("start"), "ord", every.alias("head"))
    ends = ranks.select(*SEQ, F.col("at").alias("tail_at"), every.alias("tail"))
    members = store(
        wanted.withColumn("level", level)
        .withColumn("tail_at", F.col("end") - F.element_at(powers, F.col("level") + 1))
        .join(begins, [*SEQ, "start"])
        .join(ends, [*SEQ, "tail_at"])
        .select(
            *SEQ, "start", "end", (F.col("end") - F.col("start")).alias("n"), F.element_at("head", F.col("level") + 1).alias("head"),
            F.element_at("tail", F.col("level") + 1).alias("tail"), (F.col("ord") * (1 << 31) + F.col("start")).alias("place"),
        )
    )
    interval = ["n", "head", "tail"]
    first = store(members.groupBy(*interval).agg(F.min("place").alias("first"), F.count("*").alias("copies")).where("copies > 1"))
    later = meet(members, first, interval, "copies", [*SEQ, "start"]).where(F.col("place") >= F.col("met.first") + F.col("n"))
    return later.select(*SEQ, F.explode(F.sequence("start", F.col("end") - 1)).alias("at")).distinct()


def repeated_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(key, content, runs) of the documents with deleted lines; runs are sorted spans [from, to] of lines."""
    found = store(segments(store(hashed_lines(docs, key, text, min_words)), min_words).withColumn("place", F.struct("key", "content", "seg")))
    first = store(found.groupBy(*SEQ).agg(F.min("place").alias("place"), F.count("*").alias("copies")))
    sequences = store(ranked(found.join(first.select("place"), "place").select(*SEQ, "lines", "place"), ["place"], "ord", ["place"]))
    flagged = later_lines(sequences.select(*SEQ, "ord", "lines"), min_words)
    inside = Window.partitionBy(*SEQ).orderBy("at")
    islands = (
        flagged.withColumn("island", F.col("at") - F.row_number().over(inside))
        .groupBy(*SEQ, "island")
        .agg(F.min("at").cast("int").alias("low"), F.max("at").cast("int").alias("high"))
    )
    in_first = sequences.join(islands, SEQ).select(
        "place.key", "place.content", F.element_at("lines", F.col("low") + 1)["line"].alias("from"), F.element_at("lines", F.col("high") + 1)["line"].alias("to")
    )
    spans = found.select(*SEQ, "key", "content", "place", F.element_at("lines", 1)["line"].alias("from"), F.element_at("lines", -1)["line"].alias("to"))
    copies = meet(spans, first, SEQ, "copies", ["place"]).where(F.col("place") != F.col("met.place")).select("key", "content", "from", "to")
    return in_first.union(copies).groupBy("key", "content").agg(F.sort_array(F.collect_list(F.struct("from", "to"))).alias("runs"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(row: the columns of ``docs`` as a struct, text without later copies, n_lines, n_removed) of every row.

    Deleted are later copies of maximal line runs that occur at least twice, in one document or several, and
    have at least ``min_words`` words; blank lines count as no line of a run and go with it if they lie
    inside. Copies are ordered by key (null first), then by a hash of the text, then by line; rows that
    repeat key and text are one document given several times and stay alike. Null texts stay null with no
    lines, an empty text has one. A document may lose all lines; its row stays with an empty text.
    """
    runs = repeated_runs(docs, key, text, min_words).toDF("run_key", "run_content", "runs")
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("key"), _content(text).alias("content"), F.col(text).cast("string").alias("text"))
    joined = whole.join(runs, F.col("key").eqNullSafe(F.col("run_key")) & (F.col("content") == F.col("run_content")), "left")
    lines, n, last = F.col("lines"), F.size("lines"), F.size("runs")
    kept = F.flatten(
        F.transform(
            F.sequence(F.lit(0), last),
            lambda k: F.slice(
                lines,
                start := F.when(k == 0, 0).otherwise(F.get("runs", k - 1)["to"] + 1) + 1,
                F.when(k == last, n).otherwise(F.get("runs", k)["from"]) - start + 1,
            ),
        )
    )
    gone = F.aggregate("runs", F.lit(0), lambda s, r: s + r["to"] - r["from"] + 1)
    return joined.withColumn("lines", _lines("text")).select(
        "row",
        F.when(F.col("runs").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(n).cast("bigint").alias("n_lines"),
        F.coalesce(gone, F.lit(0)).cast("bigint").alias("n_removed"),
    )
