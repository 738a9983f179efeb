"""Chat formatting with typed content parts.

A turn holds parts of type text, image, audio or document. A visitor flattens them in order: neighbouring
texts are put together and escaped, attachments become a placeholder of their type, their reference is recorded with its ordinal and the
number of tokens it expands to. A formatted turn is

    <|im_start|>ROLE\\nCONTENT<|im_end|>\\n

and a conversation is its turns in order, a row for each turn, so that no row outgrows a turn. In texts and
roles a backslash is put into every ``<|`` (and ``<\\|``, ``<\\\\|``... get one more), so control strings occur
only where the template put them; a role's line breaks are written ``\\n``. Both are undone exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
IMAGE_PATCH, AUDIO_PER_SECOND, DOCUMENT_PER_PAGE = 28, 25, 256
ATTACHMENTS = ("image", "audio", "document")
PLACEHOLDER = r"<\|(?:image|audio|document)\|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    plain = unescape(role)
    pieces = F.split(plain, r"\\\\", -1)  # between escaped backslashes
    return F.array_join(F.transform(pieces, lambda x: F.replace(x, F.lit("\\n"), F.lit("\n"))), "\\")


def part(type: str, **fields: Column) -> Column:
    """A content part of a turn; fields that are not given are null."""
    kinds = {"text": "string", "ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.struct(F.lit(type).alias("type"), *[fields.get(n, F.lit(None)).cast(t).alias(n) for n, t in kinds.items()])


def text_part(text: Column) -> Column:
    """A plain text as the parts of a turn."""
    return F.array(part("text", text=text))


def text_parts(text: Column, cut: str = r"(?<=[<\\|])") -> Column:
    """A plain text as several parts: cut at every place that matches, by default after the marks of control strings."""
    return F.transform(F.split(text, cut, -1), lambda x: part("text", text=x))


def _tokens(part: Column) -> Column:
    """Tokens that an attachment expands to; an unknown size counts as one unit."""
    patches = F.ceil(F.coalesce(part["width"], F.lit(1)) / IMAGE_PATCH) * F.ceil(F.coalesce(part["height"], F.lit(1)) / IMAGE_PATCH)
    audio = F.ceil(F.coalesce(part["seconds"], F.lit(1.0)) * AUDIO_PER_SECOND)
    pages = F.coalesce(part["pages"], F.lit(1)) * DOCUMENT_PER_PAGE
    return F.when(part["type"] == "image", patches).when(part["type"] == "audio", audio).otherwise(pages).cast("bigint")


def _attached(part: Column) -> Column:
    """Whether a part is an attachment. An unknown or null type is text."""
    return F.coalesce(part["type"].isin(*ATTACHMENTS), F.lit(False))


def _runs(parts: Column) -> Column:
    """The parts as (text, type): the text of neighbouring text parts as one, and the attachment that ends it.

    Texts have to be put together before they are escaped, or two parts could form a control string between them.
    The last run ends without an attachment.
    """
    held = F.transform(F.array(parts), lambda p: F.struct(p.alias("parts"), F.filter(F.sequence(F.lit(0), F.size(p)), lambda i: (i == F.size(p)) | _attached(F.get(p, i))).alias("ends")))

    def run(p: Column, i: Column, end: Column) -> Column:
        start = F.when(i > 0, F.get(p["ends"], i - 1) + 1).otherwise(0)
        text = F.array_join(F.transform(F.slice(p["parts"], start + 1, end - start), lambda x: F.coalesce(x["text"], F.lit(""))), "")
        return F.struct(text.alias("text"), F.get(p["parts"], end)["type"].alias("type"))

    return F.get(F.transform(held, lambda p: F.transform(p["ends"], lambda end, i: run(p, i, end))), F.lit(0))


def _visit(run: Column) -> Column:
    """What a run leaves in the content: its text escaped, then the placeholder of its attachment."""
    return F.concat(escape(run["text"]), F.coalesce(F.concat(F.lit("<|"), run["type"], F.lit("|>")), F.lit("")))


def text_tokens(text: Column, tokenizer: str | None) -> Column:
    """Tokens of a text under a tokenizer file; its UTF-8 bytes without one."""
    if tokenizer is None:
        return F.octet_length(text).cast("bigint")

    @F.arrow_udf("bigint")
    def count(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        encoder = Tokenizer.from_file(tokenizer)
        encoder.encode_special_tokens = True
        for batch in texts:
            counts = []
            for at in range(0, len(batch), 64):
                some = batch.slice(at, 64).to_pylist()
                counts += [len(x) for x in encoder.encode_batch(some, add_special_tokens=False)]
            yield pa.array(counts, pa.int64())

    return count(text)


def format_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts",
                 tokenizer: str | None = None) -> DataFrame:
    """(conv, turn, formatted, loss, attachments, n_tokens) of every row of ``turns``.

    loss is the span [start, end) of code points of ``formatted`` to learn from: the content of assistant turns,
    else null. attachments are (ordinal, type, ref, tokens) in the order of their placeholders. n_tokens counts
    the template's four marks, the role, the texts, and what attachments expand to; texts are counted under a
    ``tokenizer`` file, or byte by byte without one. Null roles, texts and part lists are empty. Rows are
    neither merged nor dropped.
    """
    held = F.coalesce(F.col(parts).cast(PARTS), F.array().cast(PARTS))
    called = F.coalesce(F.col(role).cast("string"), F.lit(""))
    head = F.concat(F.lit("<|im_start|>"), escape_role(called), F.lit("\n"))
    listed = F.filter(held, _attached)
    attachments = F.transform(listed, lambda p, i: F.struct(i.alias("ordinal"), p["type"].alias("type"), p["ref"].alias("ref"), _tokens(p).alias("tokens")))
    flat = turns.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), called.alias("role"), head.alias("head"), attachments.alias("attachments"), _runs(held).alias("runs")
    ).withColumns({"content": F.array_join(F.transform("runs", _visit), ""), "plain": F.array_join(F.transform("runs", lambda r: r["text"]), "")})
    start = F.length("head")
    expanded = F.aggregate("attachments", F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"])
    return flat.select(
        F.col("conv").alias(conv), F.col("turn").alias(turn),
        F.concat("head", "content", F.lit("<|im_end|>\n")).alias("formatted"),
        F.when(F.col("role") == "assistant", F.struct(start.alias("start"), (start + F.length("content")).alias("end"))).alias("loss"),
        "attachments",
        (F.lit(4) + text_tokens(F.col("role"), tokenizer) + text_tokens(F.col("plain"), tokenizer) + expanded).alias("n_tokens"),
    )


def read_turns(formatted: DataFrame, conv: str = "conv_id", turn: str = "turn", keep: list[str] | None = None) -> DataFrame:
    """(conv, turn, role, texts, placeholders, loss_text, chars, n_tokens, ``keep``) read back from ``format_turns``' rows.

    texts are the unescaped texts around the placeholders; loss_text is what lies under the loss mask, unescaped.
    """
    shape = r"(?s)^<\|im_start\|>([^\n]*)\n(.*)<\|im_end\|>\n$"
    content = F.regexp_extract("formatted", shape, 2)
    masked = F.substring(F.col("formatted"), F.col("loss.start") + 1, F.col("loss.end") - F.col("loss.start"))
    return formatted.select(
        F.col(conv), F.col(turn), unescape_role(F.regexp_extract("formatted", shape, 1)).alias("role"),
        F.transform(F.split(content, PLACEHOLDER, -1), unescape).alias("texts"),
        F.regexp_extract_all(content, F.lit(PLACEHOLDER), F.lit(0)).alias("placeholders"),
        F.when(F.col("loss").isNotNull(), unescape(masked)).alias("loss_text"),
        F.length("formatted").cast("bigint").alias("chars"), F.col("n_tokens"), *(keep or []),
    )


DIGEST = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_tokens bigint"


def digests(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Digests of each conversation of ``read_turns``' rows, in the order of turn, role and text.

    A digest over a conversation has to be taken in order; it is fed row by row, so a task holds one batch of
    rows and two digests, however long the conversation is. Rows without a conversation are one conversation.
    """
    kind = turns.schema[conv].dataType.simpleString()
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), "role", F.array_join("texts", "").alias("text"), "loss_text", "chars", "n_tokens")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None
        schema = None

        def closed(done: list[list]) -> pa.RecordBatch:
            columns = list(zip(*[(c, n, t.hexdigest(), lc, l.hexdigest(), fc, nt) for c, n, t, lc, l, fc, nt in done], strict=True))
            types = [schema.field("conv").type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            schema = batch.schema
            done = []
            for c, role, text, loss, chars, tokens in zip(*[batch.column(n).to_pylist() for n in ("conv", "role", "text", "loss_text", "chars", "n_tokens")], strict=True):
                if state is None or state[0] != c:
                    if state is not None:
                        done.append(state)
                    state = [c, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                if loss is not None:
                    state[3] += len(loss)
                    state[4].update(loss.encode())
                state[5] += chars
                state[6] += tokens
            if done:
                yield closed(done)
        if state is not None:
            yield closed([state])

    tasks = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, "conv").sortWithinPartitions("conv", "turn", "role", "text").mapInArrow(run, f"conv {kind}, {DIGEST}").withColumnRenamed("conv", conv)
