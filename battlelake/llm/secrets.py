"""Secret scans: trigram queries choose the documents, regular expressions verify them; SQL functions only.

Each rule's regular expression is read into a Boolean query over trigrams that every match must contain. Documents
give postings (row, trigram) for the trigrams that any query names; postings are intersected per clause; the rows
left are candidates, and only they are searched with that rule's expression. A rule without mandatory trigrams is
searched in every document. The trigrams are of the lower-cased text, so they also serve rules that ignore case.

A posting's row key is a hash of doc_id and text: two rows with one key would only both be verified, so a collision
changes no result. Positions come from the pieces between matches: their lengths are summed in two levels, so a
text with n matches costs n times a constant number of steps.

Defined cases: a null text has no spans, like an empty one; repeated rows each get their spans; null doc_ids are
allowed; other columns are kept, and result columns take free names.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from battlelake.llm import bytesets


@dataclass(frozen=True)
class Rule:
    kind: str
    #: Read alike by Java's and Python's engines.
    pattern: str
    #: The group whose length counts, and its least length.
    group: int = 0
    least: int = 1


#: The three base kinds, in their listed order. Fixed values.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)

#: Spans that the method adds.
ADDED = (
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{30,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("payment", r"sk_live_[A-Za-z0-9]{16,}"),
    Rule("url_login", r"[a-z]{2,20}://[A-Za-z0-9._-]{1,60}:[^\x00-\x20/@:]{3,60}@"),
)

RULES = BASE + ADDED

#: A literal set is not multiplied out beyond this many strings; what follows then joins by AND.
MAX_EXACT = 64

#: A query in disjunctive form: any clause, of which each trigram. The empty clause holds for every text.
Query = frozenset[frozenset[str]]
EVERY: Query = frozenset({frozenset()})


def _both(a: Query, b: Query) -> Query:
    return _least(frozenset(x | y for x in a for y in b))


def _least(q: Query) -> Query:
    """Without clauses that a weaker clause makes needless."""
    return frozenset(c for c in q if not any(d < c for d in q))


def _of_strings(strings: frozenset[str]) -> Query:
    return _least(frozenset(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings))


def _analysed(nodes) -> tuple[frozenset[str] | None, Query]:
    """The exact strings of an expression if they are few, and the query that each of its matches meets."""
    exact: frozenset[str] | None = frozenset({""})
    query = EVERY
    for op, arg in nodes:
        own_exact, own_query = _one(op, arg)
        if exact is not None and own_exact is not None and len(exact) * len(own_exact) <= MAX_EXACT:
            exact = frozenset(a + b for a in exact for b in own_exact)
            continue
        if exact is not None:
            query = _both(query, _of_strings(exact))
        exact = own_exact if own_exact is not None else frozenset({""})
        if own_exact is None:
            query = _both(query, own_query)
            exact = frozenset({""})
    complete = query == EVERY and exact is not None and all(_is_known(op, arg) for op, arg in nodes)
    total = _both(query, _of_strings(exact)) if exact is not None else query
    return (exact if complete else None), total


def _is_known(op, arg) -> bool:
    return _one(op, arg)[0] is not None


def _one(op, arg) -> tuple[frozenset[str] | None, Query]:
    if op is sre.LITERAL:
        return frozenset({chr(arg).lower()}), EVERY
    if op is sre.IN:
        if all(kind is sre.LITERAL for kind, _ in arg):
            return frozenset(chr(c).lower() for _, c in arg), EVERY
        return None, EVERY
    if op is sre.SUBPATTERN:
        return _analysed(arg[-1])
    if op is sre.BRANCH:
        parts = [_analysed(p) for p in arg[1]]
        if all(e is not None for e, _ in parts) and sum(len(e) for e, _ in parts) <= MAX_EXACT:
            return frozenset().union(*(e for e, _ in parts)), EVERY
        return None, _least(frozenset().union(*(q for _, q in parts)))
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        low, high, inner = arg
        exact, query = _analysed(inner)
        if exact is not None and (low, high) == (0, 1):
            return exact | {""}, EVERY
        if exact is not None and low == high == 1:
            return exact, EVERY
        return None, query if low else EVERY
    return None, EVERY


def trigram_query(pattern: str) -> Query:
    """Trigrams in lower case that every match must contain, as clauses of which one holds."""
    return _analysed(sre_parser.parse(pattern))[1]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with its value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


BLOCK = 128


def _running(values: Column, combine: Callable[[Column, Column], Column], kind: str = "int") -> Column:
    """For each element of an array of counts, what combines all before it (0 for the first), in two levels."""
    fold = lambda part: F.aggregate(part, F.lit(0).cast(kind), combine)

    def with_blocks(blocks: Column) -> Column:
        heads = F.transform(blocks, lambda _, i: fold(F.slice(blocks, 1, i)))
        return _let(heads, lambda h: F.transform(
            values, lambda _, i: combine(h[(i / BLOCK).cast("int")], fold(F.slice(values, i - i % BLOCK + 1, i % BLOCK)))))

    count = F.greatest(F.ceil(F.size(values) / F.lit(BLOCK)).cast("int"), F.lit(1))
    blocks = F.transform(F.sequence(F.lit(0), count - 1), lambda b: fold(F.slice(values, b * BLOCK + 1, BLOCK)))
    return F.when(F.size(values) == 0, F.array().cast(f"array<{kind}>")).otherwise(_let(blocks, with_blocks))


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """The rule's spans: struct(start, kind_no, end), in code points, end exclusive."""
    pattern = F.lit(rule.pattern)

    def between(found: Column) -> Column:
        pieces = F.transform(F.split(text, rule.pattern, -1), lambda p: F.length(p))
        sizes = F.transform(found, lambda m: F.length(m))
        counted = sizes if rule.group == 0 else F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda g: F.length(g))
        return _let(F.struct(pieces.alias("p"), sizes.alias("m"), counted.alias("c")), lambda s: _let(
            _running(F.zip_with(F.slice(s["p"], 1, F.size(s["m"])), s["m"], lambda a, b: a + b), lambda a, b: a + b),
            lambda before: F.filter(
                F.transform(s["m"], lambda size, i: F.when(s["c"][i] >= rule.least, F.struct(
                    (before[i] + s["p"][i]).alias("start"), F.lit(number).alias("kind_no"),
                    (before[i] + s["p"][i] + size).alias("end")))),
                lambda x: x.isNotNull())))

    none = F.array().cast(SPANS)
    return _let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda found: F.when(F.size(found) > 0, between(found)).otherwise(none)).cast(SPANS)


SPANS = "array<struct<start:int,kind_no:int,end:int>>"


def postings(keyed: DataFrame, key: str, text: str, trigrams: list[str]) -> DataFrame:
    """The inverted index over the given trigrams: (trigram, row key)."""
    present = _let(F.lower(F.col(f"`{text}`")), lambda lowered: F.array_compact(
        F.array(*[F.when(F.contains(lowered, F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams)])))
    return keyed.select(F.col(f"`{key}`").alias("row_key"), F.explode(present).alias("trigram"))


def candidates(index: DataFrame, trigrams: list[str], queries: dict[int, Query]) -> DataFrame:
    """(row_key, rules): a bit for each rule of which a clause has all its postings."""
    slot = {t: i for i, t in enumerate(trigrams)}
    rows = []
    for rule, query in queries.items():
        for number, clause in enumerate(sorted(query, key=sorted)):
            need = sorted(clause)
            rows += [(slot[t], rule * 1000 + number, 1 << k, (1 << len(need)) - 1) for k, t in enumerate(need)]
    # As many rows as the rules have trigrams.
    names = ("trigram", "clause", "bit", "whole")
    literals = F.array(*[F.struct(*[F.lit(v).cast("bigint").alias(n) for n, v in zip(names, row, strict=True)]) for row in rows])
    clauses = F.broadcast(index.sparkSession.range(1).select(F.inline(literals)))
    met = (
        index.join(clauses, "trigram").repartition("row_key")
        .groupBy("row_key", "clause", "whole").agg(F.bit_or("bit").alias("bits")).where(F.col("bits") == F.col("whole"))
    )
    rule_bit = F.expr("shiftleft(1L, clause DIV 1000)")
    return met.groupBy("row_key").agg(F.bit_or(rule_bit).alias("rules"))


def find(docs: DataFrame, text: str = "text", key: str | None = None, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, str]:
    """All columns of ``docs`` and the sorted spans of all rules; also the name of that column.

    ``key`` names a column that tells rows apart and spreads rows of equal text over the tasks.
    """
    queries = {i: trigram_query(r.pattern) for i, r in enumerate(rules)}
    queries = {i: q for i, q in queries.items() if q != EVERY}
    trigrams = sorted({t for q in queries.values() for c in q for t in c})
    row_key, mask, spans = (bytesets.free_name(docs, n) for n in ("row_key", "rule_mask", "secret_spans"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    parts = [F.col(f"`{key}`").cast("string")] if key else []
    keyed = docs.select(*columns, F.xxhash64(*parts, F.col(f"`{text}`")).alias(row_key))
    chosen = candidates(postings(keyed, row_key, text, trigrams), trigrams, queries)
    chosen = chosen.select(F.col("row_key").alias(row_key), F.col("rules").alias(mask))
    whole = keyed.join(chosen, row_key, "left")
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    found = []
    for i, rule in enumerate(rules):
        own = _spans(body, rule, i)
        if i in queries:
            own = F.when(F.col(mask).bitwiseAND(F.lit(1 << i)) != 0, own).otherwise(F.array().cast(SPANS))
        found.append(own)
    return whole.select(*columns, F.array_sort(F.flatten(F.array(*found))).alias(spans)), spans


def written(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind_no"] + 1), s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with each run of overlapping spans replaced by the mark."""
    def cut(before: Column) -> Column:
        pieces = F.transform(spans, lambda s, i: F.when(
            s["start"] >= before[i], F.concat(F.substring(text, before[i] + 1, s["start"] - before[i]), F.lit(mark))).otherwise(F.lit("")))
        last = F.greatest(F.element_at(before, -1), F.element_at(spans, -1)["end"])
        return F.concat(F.array_join(pieces, ""), F.substring(text, last + 1, F.length(text)))

    ends = F.transform(spans, lambda s: s["end"])
    return F.when(F.size(spans) > 0, _let(_running(ends, lambda a, b: F.greatest(a, b)), cut)).otherwise(text)


def redact(docs: DataFrame, text: str = "text", key: str | None = None) -> DataFrame:
    """All documents with the same columns; secrets in ``text`` are replaced."""
    found, spans = find(docs, text, key)
    return found.select(*[
        redacted(F.col(f"`{c}`"), F.col(spans)).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])


def report(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, a digest of the base spans, and all spans as text."""
    found, spans = find(bytesets.only(docs, doc_id="bigint", text="string"), "text", "doc_id")
    own = F.col(spans)
    base = F.filter(own, lambda s: s["kind_no"] < len(BASE))
    count = lambda i: F.size(F.filter(own, lambda s: s["kind_no"] == i)).cast("bigint")
    return found.select(
        "doc_id", *[count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE)],
        F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(own).alias("spans"))
