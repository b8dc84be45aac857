"""Secrets in texts, found through a trigram index (op6).

Of each rule's regex a Boolean query over trigrams is derived: trigrams that every match
must hold, joined by "and" along a sequence and by "or" over alternatives. Each block of
documents gets an inverted index of the trigrams that the rules ask for (folded to small
letters): trigram -> documents. A rule's query is worked out on these postings by
intersection and union, and only the documents left are searched with the regex. A rule
whose regex has no trigram that every match must hold searches all documents.

The index is dealt out by documents: a block's postings and texts are in one task, so
nothing is shuffled and a text never moves. A lost task is run again on its own block.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from re import _constants as kinds
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tunesmith.llm.common import quoted

# Strings that an exact set may hold before it is turned into trigrams, and characters of a class it takes in.
EXACT, CLASS = 64, 4
# Bytes of text, about, in one block of the index.
BLOCK_BYTES = 8 << 20


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` of ``least`` characters or more (in ``group``); ``base`` rules are counted."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    any_case: bool = False
    base: bool = False

    @property
    def regex(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


#: The first three are fixed values; spans at one start come in the order of this list.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True, True),
    Rule("access", r"AKIA[A-Z0-9]+", 20, base=True),
    Rule("hex", r"[0-9a-f]+", 24, base=True),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    # Only at the beginning of a run, as a search from every "eyJ" inside a long one would be quadratic.
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("git", r"gh[pousr]_[A-Za-z0-9]{36}"),
)

# A query is True (all documents), a trigram, or ("and" | "or", frozenset of queries).
Query = object


def _all_of(queries) -> Query:
    found = set()
    for q in queries:
        if isinstance(q, tuple) and q[0] == "and":
            found |= q[1]
        elif q is not True:
            found.add(q)
    return True if not found else next(iter(found)) if len(found) == 1 else ("and", frozenset(found))


def _any_of(queries) -> Query:
    found = set(queries)
    return True if not found or True in found else next(iter(found)) if len(found) == 1 else ("or", frozenset(found))


def _of_strings(strings: set[str]) -> Query:
    """What a text holds if it holds one of the strings, in small letters."""
    return _any_of(_all_of(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _exact(node) -> set[str] | None:
    """All strings (small letters) one parsed item stands for, if they are few."""
    kind, value = node
    if kind is kinds.LITERAL:
        return {chr(value).lower()} if value < 128 else None
    if kind is kinds.IN:
        found = set()
        for k, v in value:
            if k is kinds.LITERAL and v < 128:
                found.add(chr(v).lower())
            elif k is kinds.RANGE and v[1] - v[0] < CLASS and v[1] < 128:
                found |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
            else:
                return None
        return found if len(found) <= CLASS else None
    if kind is kinds.SUBPATTERN:
        return _exact_of(value[3])
    if kind is kinds.BRANCH:
        parts = [_exact_of(b) for b in value[1]]
        return None if None in parts else set().union(*parts)
    if kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT) and value[1] == 1:
        one = _exact_of(value[2])
        return None if one is None else one | {""} if value[0] == 0 else one
    if kind is kinds.AT:
        return {""}
    return None


def _exact_of(nodes) -> set[str] | None:
    strings = {""}
    for node in nodes:
        one = _exact(node)
        if one is None or len(strings) * len(one) > EXACT:
            return None
        strings = {a + b for a in strings for b in one}
    return strings


def _needs(node) -> Query:
    """What every text with a match of one parsed item holds."""
    kind, value = node
    if kind is kinds.SUBPATTERN:
        return _needs_of(value[3])
    if kind is kinds.BRANCH:
        return _any_of(_needs_of(b) for b in value[1])
    if kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT) and value[0] > 0:
        return _needs_of(value[2])
    return True


def _needs_of(nodes) -> Query:
    needs, run = [], {""}
    for node in nodes:
        one = _exact(node)
        if one is not None and len(run) * len(one) <= EXACT:
            run = {a + b for a in run for b in one}
            continue
        needs.append(_of_strings(run))
        run = one if one is not None else {""}
        if one is None:
            needs.append(_needs(node))
    needs.append(_of_strings(run))
    return _all_of(needs)


def trigram_query(pattern: str) -> Query:
    """The trigrams (ASCII, small letters) that a text must hold for the regex to match; True if none."""
    return _needs_of(parser.parse(pattern, re.ASCII))


def trigrams_of(query: Query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))


@lru_cache(4)
def _compiled(rules: tuple[Rule, ...]):
    queries = [trigram_query(r.pattern) for r in rules]
    wanted = sorted(set().union(*map(trigrams_of, queries)))
    slot = np.zeros(1 << 24, np.uint16)
    for k, t in enumerate(wanted):
        slot[int.from_bytes(t.encode(), "big")] = k + 1
    return [r.regex for r in rules], queries, wanted, slot


_FOLD = bytes(range(256)).lower()


def postings(raw: list[bytes], wanted: list[str], slot: np.ndarray) -> dict[str, np.ndarray]:
    """Of each trigram asked for, the numbers of the texts that hold it, ascending."""
    joined = np.frombuffer(b"\0\0".join(raw).translate(_FOLD), np.uint8)
    if len(joined) < 3 or not wanted:
        return {}
    starts = np.cumsum([0] + [len(r) + 2 for r in raw[:-1]])
    code = joined[:-2].astype(np.uint32) << 16
    code |= joined[1:-1].astype(np.uint32) << 8
    code |= joined[2:]
    found = slot[code]
    at = np.flatnonzero(found)
    pairs = np.unique((found[at].astype(np.int64) - 1) * len(raw) + np.searchsorted(starts, at, "right") - 1)
    numbers, docs = np.divmod(pairs, len(raw))
    edges = np.searchsorted(numbers, np.arange(len(wanted) + 1))
    return {t: docs[edges[k] : edges[k + 1]] for k, t in enumerate(wanted)}


def candidates(query: Query, index: dict[str, np.ndarray], n: int) -> np.ndarray:
    """Numbers of the texts that a query lets through."""
    if query is True:
        return np.arange(n)
    if isinstance(query, str):
        return index.get(query, np.zeros(0, np.int64))
    parts = sorted((candidates(q, index, n) for q in query[1]), key=len)
    if query[0] == "or":
        return reduce(np.union1d, parts)
    found = parts[0]
    for part in parts[1:]:
        if not len(found):
            break
        found = np.intersect1d(found, part, assume_unique=True)
    return found


def scan_block(texts: list[str | None], rules: tuple[Rule, ...] = RULES) -> list[list[tuple[int, int, int]]]:
    """Of each text, the (start, rule number, end) of its matches, in order; ends are exclusive."""
    regexes, queries, wanted, slot = _compiled(rules)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    start = 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and (size < BLOCK_BYTES or stop == start):
            size += len(texts[stop] or "")
            stop += 1
        block = [t or "" for t in texts[start:stop]]
        index = postings([t.encode() for t in block], wanted, slot)
        for k, (rule, regex, query) in enumerate(zip(rules, regexes, queries)):
            for i in candidates(query, index, len(block)).tolist():
                for m in regex.finditer(block[i]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        found[start + i].append((m.start(), k, m.end()))
        start = stop
    return [sorted(spans) for spans in found]


def _listed(spans, rules) -> str:
    return ",".join(f"{rules[k].kind}:{a}:{b}" for a, k, b in spans)


_FOUND = "struct<n: array<bigint>, base_sha256: string, spans: string>"


def found_secrets(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Struct per whole text: ``n`` (matches of each base rule), ``base_sha256``, ``spans``.

    Spans are kind:start:end in code points, by start, then by the rules' order, joined by
    commas; ``base_sha256`` is of the base rules' spans alone. A null text is an empty one:
    no match, empty ``spans``.
    """
    base = [k for k, r in enumerate(rules) if r.base]

    @F.arrow_udf(_FOUND)
    def scan(texts: pa.Array) -> pa.Array:
        rows = []
        for spans in scan_block(texts.to_pylist(), rules):
            own = [s for s in spans if rules[s[1]].base]
            counts = [sum(1 for s in own if s[1] == k) for k in base]
            rows.append({"n": counts, "base_sha256": hashlib.sha256(_listed(own, rules).encode()).hexdigest(), "spans": _listed(spans, rules)})
        return pa.array(rows, pa.struct([("n", pa.list_(pa.int64())), ("base_sha256", pa.string()), ("spans", pa.string())]))

    return scan(text)


def secrets(df: DataFrame, text: str = "text", key: str = "doc_id", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row: key, ``n_<kind>`` of each base rule, ``base_sha256``, ``spans``.

    Null keys and repeated rows are kept; an empty table gives no row.
    """
    found = df.select(quoted(key).alias(key), found_secrets(quoted(text), rules).alias("__found"))
    counts = [F.col("__found.n")[k].alias(f"n_{r.kind}") for k, r in enumerate(r for r in rules if r.base)]
    return found.select(key, *counts, "__found.base_sha256", "__found.spans")


def masked(text: Column, rules: tuple[Rule, ...] = RULES, mask: str = "[secret]") -> Column:
    """The text with every secret replaced; overlapping matches get one mask. Null stays null."""

    @F.arrow_udf("string")
    def cover(texts: pa.Array) -> pa.Array:
        given, out = texts.to_pylist(), []
        for whole, spans in zip(given, scan_block(given, rules)):
            if not spans:
                out.append(whole)
                continue
            parts, at = [], 0
            for start, _, end in spans:
                if start >= at:
                    parts += [whole[at:start], mask]
                at = max(at, end)
            out.append("".join([*parts, whole[at:]]))
        return pa.array(out, pa.string())

    return cover(text)
