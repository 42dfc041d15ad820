"""Secret scans: candidates from a trigram index, verified by the rules' regular expressions."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property
from re import _parser as regex_tree

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.shared import in_batches

#: Texts are indexed and scanned in segments of about this many characters.
SEGMENT_CHARS = 4_000_000
#: A set of alternative strings is kept whole up to this size, then only its trigrams are.
EXACT_SETS = 64

Query = tuple  # ("all",) | ("gram", t) | ("and", q...) | ("or", q...)
ANY: Query = ("all",)


@dataclass(frozen=True)
class Rule:
    """``least``: what a match must have: (group, characters). Shorter ones are dropped."""

    kind: str
    pattern: str
    least: tuple[int, int] = (0, 0)

    @cached_property
    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII)

    @cached_property
    def query(self) -> Query:
        return trigram_query(self.pattern)

    def spans(self, text: str) -> Iterator[tuple[int, int]]:
        """Leftmost non-overlapping matches, then those that are long enough."""
        group, chars = self.least
        for m in self.compiled.finditer(text):
            if m.end(group) - m.start(group) >= chars:
                yield m.start(), m.end()


BASE_RULES = (
    Rule(
        "assign",
        r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        (2, 12),
    ),
    Rule("access", r"AKIA[A-Z0-9]+", (0, 18)),
    Rule("hex", r"[0-9a-f]+", (0, 16)),
)
#: Published formats of common credentials.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]*PRIVATE KEY-----)?"),
    Rule("web_token", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("hub_token", r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("pay_key", r"\b[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("map_key", r"\bAIza[A-Za-z0-9_-]{35}"),
)
RULES = BASE_RULES + MORE_RULES


# -- which trigrams a match must hold --------------------------------------------------


def both(*queries: Query) -> Query:
    kept = list(dict.fromkeys(q for q in queries if q != ANY))
    return ANY if not kept else kept[0] if len(kept) == 1 else ("and", *kept)


def either(*queries: Query) -> Query:
    kept = list(dict.fromkeys(queries))
    return ANY if ANY in kept or not kept else kept[0] if len(kept) == 1 else ("or", *kept)


def grams_of(strings: set[str]) -> Query:
    """Every string's trigrams, any of the strings; no condition if one is too short."""
    return either(*(both(*(("gram", s[i : i + 3]) for i in range(len(s) - 2))) for s in sorted(strings)))


def trigram_query(pattern: str) -> Query:
    """A Boolean query over lower-cased trigrams that every match of ``pattern`` satisfies.

    Alternatives are followed as sets of exact strings for as long as these stay small;
    what may vary freely ends a run of exact strings, whose trigrams are then demanded.
    """

    def exact(items) -> tuple[set[str] | None, Query]:
        """All that a sequence can match (None: too many), and what it demands besides."""
        runs, current, demands = False, {""}, []
        for op, value in items:
            name, own, query = str(op), None, ANY
            if name == "LITERAL":
                own = {chr(value).lower()}
            elif name == "IN" and all(str(o) == "LITERAL" for o, _ in value):
                own = {chr(v).lower() for _, v in value}
            elif name == "SUBPATTERN":
                own, query = exact(value[-1])
            elif name == "BRANCH":
                sides = [exact(x) for x in value[1]]
                if all(s is not None for s, _ in sides):
                    own = set().union(*(s for s, _ in sides))
                query = either(*(both(q, grams_of(s)) if s is not None else q for s, q in sides))
            elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
                low, high, inner = value
                once, inner_query = exact(inner)
                if once is not None and (low, high) == (0, 1):
                    own = once | {""}
                elif once is not None and low == high == 1:
                    own = once
                elif low:
                    query = both(inner_query, grams_of(once) if once is not None else ANY)
            elif name in ("AT", "ASSERT", "ASSERT_NOT"):
                own = {""}
            demands.append(query)
            joined = {a + b for a in current for b in own} if own is not None else None
            if joined is not None and len(joined) <= EXACT_SETS:
                current = joined
                continue
            demands.append(grams_of(current))
            runs, current = True, own if own is not None and len(own) <= EXACT_SETS else {""}
        demands.append(grams_of(current) if runs else ANY)
        return (None if runs else current), both(*demands)

    whole, query = exact(regex_tree.parse(pattern))
    return both(query, grams_of(whole)) if whole is not None else query


def grams(query: Query) -> set[str]:
    if query[0] == "gram":
        return {query[1]}
    return set().union(*(grams(q) for q in query[1:]))


def candidates(query: Query, postings: dict[str, set[int]], everything: set[int]) -> set[int]:
    """The texts of a segment that satisfy ``query``, from its posting lists."""
    kind, *rest = query
    if kind == "all":
        return everything
    if kind == "gram":
        return postings[rest[0]]
    sets = [candidates(q, postings, everything) for q in rest]
    return set.intersection(*sets) if kind == "and" else set.union(*sets)


def segment_spans(texts: list[str], rules: tuple[Rule, ...]) -> list[list[tuple[int, int, int]]]:
    """For each text its (start, rule, end), sorted. Indexes the segment, intersects, verifies."""
    lowered = [t.lower() for t in texts]
    needed = set().union(*(grams(r.query) for r in rules))
    postings = {g: {i for i, t in enumerate(lowered) if g in t} for g in sorted(needed)}
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, rule in enumerate(rules):
        for i in candidates(rule.query, postings, set(range(len(texts)))):
            found[i] += ((start, k, end) for start, end in rule.spans(texts[i]))
    return [sorted(f) for f in found]


def segments(texts: pa.Array) -> Iterator[list[str]]:
    """The texts in order, in lists of bounded size; a longer text comes alone."""
    held, chars = [], 0
    for t in texts:
        text = t.as_py() or ""
        if held and chars + len(text) > SEGMENT_CHARS:
            yield held
            held, chars = [], 0
        held.append(text)
        chars += len(text)
    if held:
        yield held


SPAN = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]
)


def _scanner(rules: tuple[Rule, ...], finish: Callable) -> Callable:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for_text = []
            for texts in segments(batch.column(batch.schema.get_field_index("text"))):
                for_text += zip(texts, segment_spans(texts, rules))
            yield finish(batch, for_text)

    return scan


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, secrets) per row; ``secrets``: array of (kind, start, end), by start, then rule.

    Offsets count code points, the end is exclusive; kinds may overlap each other. Each batch
    of texts is a segment with its own inverted index from the rules' trigrams to its texts;
    a rule's Boolean query intersects the postings and the regular expression verifies what is
    left. Rules without a mandatory trigram scan every text. Nothing is shuffled. Null and
    empty texts have no spans; repeated rows, null doc_ids and extra columns change nothing.
    """

    def finish(batch, for_text):
        spans = [[{"kind": rules[k].kind, "start": s, "end": e} for s, k, e in found] for _, found in for_text]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, kind)], ["doc_id", "secrets"])

    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("secrets", T.ArrayType(SPAN))])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return in_batches(rows, _scanner(tuple(rules), finish), schema)


def redacted(text: str, found: list[tuple[int, int, int]], mask: str) -> str:
    """Overlapping spans are masked as one."""
    out, at = [], 0
    for start, _, end in found:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, mask: str = "[SECRET]", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mask``; all columns and rows stay.

    Null texts stay null. ``n_chars``, where there is such a column, is counted anew for
    texts that change.
    """

    def finish(batch, for_text):
        at = batch.schema.get_field_index("text")
        old = batch.column(at)
        new = pa.array(
            [None if not o.is_valid else redacted(t, f, mask) if f else t for o, (t, f) in zip(old, for_text)],
            old.type,
        )
        columns = list(batch.columns)
        columns[at] = new
        count = batch.schema.get_field_index("n_chars")
        if count >= 0:
            kind = columns[count].type
            columns[count] = pa.array(
                [c.as_py() if not f else len(n.as_py()) for c, n, (_, f) in zip(columns[count], new, for_text)], kind
            )
        return pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return in_batches(docs, _scanner(tuple(rules), finish), docs.schema)
