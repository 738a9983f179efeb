"""Secret scanning by a trigram inverted index. DataFrame functions only.

From each rule's regular expression a Boolean query over trigrams is derived: every match must contain, for
each clause, all trigrams of one of the clause's alternatives. Texts are indexed once, by content, for the
trigrams that any rule asks for (the other posting lists would never be read): a posting is (trigram, text).
The postings of an alternative are intersected, those of a clause united, those of a rule intersected, all
by grouping. Only candidates are verified with the expression itself. Rules from which no trigram can be
derived, such as long runs of hexadecimal digits, scan every text.
"""

from __future__ import annotations

import re._constants as op
import re._parser as parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern``, leftmost and non-overlapping, whose ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: In the order in which kinds are listed at equal starts. The first three are the base rules.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("github", r"gh[opsru]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
BASE = ("assign", "access", "hex")
MANY_STRINGS, MANY_LETTERS = 256, 8
#: Matches whose lengths are summed together.
AT_ONCE = 128

Alternative = frozenset[str]
Clause = tuple[Alternative, ...]


def _exact(node) -> set[str] | None:
    """The lower-cased strings a node can match, if they are few; else None."""
    kind, value = node
    if kind is op.LITERAL:
        return {chr(value).lower()}
    if kind is op.IN:
        letters = set()
        for what, x in value:
            if what is op.LITERAL:
                letters.add(chr(x).lower())
            elif what is op.RANGE and x[1] - x[0] < 2 * MANY_LETTERS:
                letters.update(chr(c).lower() for c in range(x[0], x[1] + 1))
            else:
                return None
        return letters if len(letters) <= MANY_LETTERS else None
    if kind is op.SUBPATTERN:
        return _exact_all(value[3])
    if kind is op.BRANCH:
        parts = [_exact_all(x) for x in value[1]]
        return None if None in parts else set().union(*parts)
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[1] is not op.MAXREPEAT and value[1] <= 3:
        inner = _exact_all(value[2])
        if inner is None:
            return None
        counted = [{"".join(x) for x in product(inner, repeat=n)} for n in range(value[0], value[1] + 1)]
        return set().union(*counted)
    if kind is op.AT:
        return {""}
    return None


def _exact_all(nodes) -> set[str] | None:
    found = {""}
    for node in nodes:
        part = _exact(node)
        if part is None or len(found) * len(part) > MANY_STRINGS:
            return None
        found = {a + b for a in found for b in part}
    return found


def _clause(strings: set[str]) -> list[Clause]:
    """The clause that one of ``strings`` occurs; none if some string has no trigram."""
    if any(len(s) < 3 for s in strings):
        return []
    sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    return [tuple(sorted((a for a in sets if not any(b < a for b in sets)), key=sorted))]


def _clauses(nodes) -> list[Clause]:
    found: list[Clause] = []
    run = {""}
    for node in nodes:
        part = _exact(node)
        if part is not None and len(run) * len(part) <= MANY_STRINGS:
            run = {a + b for a in run for b in part}
            continue
        found += _clause(run)
        run = part if part is not None else {""}
        kind, value = node
        if part is None and kind is op.SUBPATTERN:
            found += _clauses(value[3])
        elif part is None and kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] > 0:
            found += _clauses(value[2])
        elif part is None and kind is op.BRANCH:
            each = [_clauses(x) for x in value[1]]
            if all(each):
                found.append(tuple(a for clauses in each for a in clauses[0]))
    return found + _clause(run)


def trigram_query(pattern: str) -> list[Clause]:
    """The clauses that lower-cased text around any match of ``pattern`` fulfils; empty if nothing is mandatory."""
    return sorted(set(_clauses(parser.parse(pattern))), key=lambda c: [sorted(a) for a in c])


def build_index(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (trigram, content) of texts (content, text) for the given trigrams, letters in either case."""
    asked = F.array(*map(F.lit, trigrams))
    # as a lambda's argument the lower-cased text is worked out once, not for every trigram
    held = F.transform(F.array(F.lower("text")), lambda low: F.filter(asked, lambda t: F.contains(low, t)))
    return texts.select("content", F.explode(F.flatten(held)).alias("trigram")).distinct()


def candidates(postings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(content, kinds) of the texts that fulfil the trigram query of a rule."""
    terms = [
        (rule.kind, c, a, trigram, len(alternative), len(clauses))
        for rule in rules
        for clauses in [trigram_query(rule.pattern)]
        for c, clause in enumerate(clauses)
        for a, alternative in enumerate(clause)
        for trigram in alternative
    ]
    query = postings.sparkSession.createDataFrame(terms, "kind string, clause int, alternative int, trigram string, size int, clauses int")
    # as many rows as the rules have trigrams
    met = postings.join(F.broadcast(query), "trigram").groupBy("content", "kind", "clauses", "clause", "alternative", "size").agg(F.count("*").alias("n"))
    return (
        met.where("n = size")
        .groupBy("content", "kind", "clauses")
        .agg(F.count_distinct("clause").alias("n"))
        .where("n = clauses")
        .groupBy("content")
        .agg(F.collect_set("kind").alias("kinds"))
    )


def _spans(rule: Rule, order: int, text: Column) -> Column:
    """Spans (start, order, end, kind) of a rule's matches in a text, in code points."""
    pattern = F.lit(rule.pattern)
    # the pieces between matches and the matches themselves add up to the places
    apart = F.transform(
        F.arrays_zip(
            F.split(text, rule.pattern, -1).alias("before"),
            F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"),
            F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("value"),
        ),
        lambda x: F.struct(F.length(x["before"]).alias("before"), F.length(x["match"]).alias("match"), F.length(x["value"]).alias("value")),
    )
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")

    def summed(lengths: Column) -> Column:
        return F.aggregate(lengths, F.lit(0), lambda a, x: a + x)

    def placed(s: Column) -> Column:
        """Where each match begins: what lies before its block of matches, and before it in the block."""
        spans = F.transform(
            s["apart"],
            lambda x, i: F.transform(
                F.array(F.get(s["upto"], F.floor(i / AT_ONCE).cast("int")) + summed(F.slice(s["steps"], i - i % AT_ONCE + 1, i % AT_ONCE)) + x["before"]),
                lambda at: F.struct(at.alias("start"), F.lit(order).alias("order"), (at + x["match"]).alias("end"), F.lit(rule.kind).alias("kind"), x["value"].alias("value")),
            )[0],
        )
        kept = F.filter(spans, lambda x: x["value"] >= rule.least)
        return F.transform(kept, lambda x: F.struct(*[x[c].alias(c) for c in ("start", "order", "end", "kind")]))

    # sums over blocks of matches, then inside a block; a lambda's argument is worked out once
    steps = F.transform(F.array(F.struct(apart.alias("apart"))), lambda s: F.struct(s["apart"].alias("apart"), F.transform(s["apart"], lambda x: x["before"] + F.coalesce(x["match"], F.lit(0))).alias("steps")))
    sums = F.transform(steps, lambda s: F.struct(s["apart"].alias("apart"), s["steps"].alias("steps"), F.transform(F.sequence(F.lit(0), F.floor(F.size(s["steps"]) / AT_ONCE).cast("int")), lambda b: summed(F.slice(s["steps"], b * AT_ONCE + 1, AT_ONCE))).alias("sums")))
    upto = F.transform(sums, lambda s: F.struct(s["apart"].alias("apart"), s["steps"].alias("steps"), F.transform(s["sums"], lambda _, b: summed(F.slice(s["sums"], 1, b))).alias("upto")))
    return F.when(F.regexp_like(text, pattern), F.transform(upto, placed)[0]).otherwise(none)


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(key, spans) of every row: array of (start, order, end, kind), sorted by start, then by the rules' order.

    Places count code points, the end is exclusive. Null and empty texts have no spans; repeated rows are
    repeated, and a text given many times is indexed once; an empty table gives no rows.
    """
    whole = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).withColumn("content", F.sha2("text", 256))
    asked = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    trigrams = sorted({t for clauses in asked.values() for clause in clauses for a in clause for t in a})
    found = candidates(build_index(whole, trigrams), rules)
    joined = whole.join(found, "content", "left")
    spans = []
    for order, rule in enumerate(rules):
        here = _spans(rule, order, F.col("text"))
        none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
        spans.append(here if not asked[rule.kind] else F.when(F.array_contains("kinds", rule.kind), here).otherwise(none))
    return joined.select(F.col("key").alias(key), F.array_sort(F.concat(*spans)).alias("spans"))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(key, n_assign, n_access, n_hex, base_sha256, spans as text) of every row; see ``find_secrets``."""

    def written(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return find_secrets(docs, key, text, rules).select(
        key, *[count(k) for k in BASE], F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans")
    )
