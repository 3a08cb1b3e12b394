"""Secret scan behind a trigram inverted index.

Each rule's regex is turned into a Boolean query over the trigrams that any match must hold. A document-sharded inverted
index (trigram -> rows of the shard) is built for every Arrow batch in one numpy pass; the query intersects and unites
postings, and only rows that are left are verified by the regex. A rule without mandatory trigrams scans every row.
The index is a shard's own, so no text moves between executors.

The index holds lower-cased (A-Z) UTF-8 bytes, so its queries are necessary conditions for rules in either case.
"""

from __future__ import annotations

import hashlib
import re
import re._constants as sre
import re._parser as sre_parser
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.llm.common import map_batches
from harvestry.llm.kernel import LOWER, Block, blocks

EXACT_LIMIT = 24


@dataclass(frozen=True)
class Rule:
    """kind names the spans, which are those of the group `span`. Matches whose `group` is shorter than `least` characters are dropped after matching."""

    kind: str
    pattern: str
    ignore_case: bool = False
    group: int = 0
    least: int = 1
    span: int = 0

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))


BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Public formats of credentials, beside the base rules.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----"),
    Rule("git_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    # tried once a run of its letters, from the first eyJ on, as a later one can't match where that doesn't: so "eyJeyJ..." costs linear time
    Rule("web_token", r"(?<![A-Za-z0-9_-])(?:(?!eyJ)[A-Za-z0-9_-])*+(eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})", span=1),
    Rule("bearer", r"bearer\x20+[A-Za-z0-9+/_.=-]{16,}", True),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,15}://[^\s/:@]{1,64}:[^\s/:@]{3,64}@", True),
)
RULES = BASE_RULES + MORE_RULES

# A query is True (anything), or a trigram as bytes, or ("and", parts), or ("or", parts).


def _join(op: str, parts: list) -> object:
    flat = []
    for p in parts:
        flat.extend(p[1] if isinstance(p, tuple) and p[0] == op else [p])
    if op == "or" and any(p is True for p in flat):
        return True
    flat = list(dict.fromkeys(p for p in flat if p is not True))
    if op == "or":  # a part that asks for more than another one adds nothing
        asks = [frozenset(p[1]) if isinstance(p, tuple) else frozenset([p]) for p in flat]
        flat = [p for p, a in zip(flat, asks, strict=True) if not any(b < a for b in asks)]
    return True if not flat else flat[0] if len(flat) == 1 else (op, tuple(flat))


def _of_strings(strings: set[bytes]) -> object:
    """What holds if one of the strings occurs."""
    return _join("or", [_join("and", [s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _walk(nodes) -> tuple[set[bytes] | None, object]:
    """(all strings the nodes can match, or None if unknown or too many; the query that any match fulfils)."""
    query, run, exact = [], {b""}, True
    for op, arg in nodes:
        strings, needs = _node(op, arg)
        if strings is not None and len(run) * len(strings) <= EXACT_LIMIT:
            run = {a + b for a in run for b in strings}
            continue
        query += [_of_strings(run), needs if strings is None else _of_strings(strings)]
        run, exact = {b""}, False
        if strings is not None:
            run = strings
    query.append(_of_strings(run))
    return (run if exact else None), _join("and", query)


def _node(op, arg) -> tuple[set[bytes] | None, object]:
    if op is sre.LITERAL:
        return {chr(arg).lower().encode()} if arg < 128 else {chr(arg).encode()}, True
    if op is sre.IN and all(k in (sre.LITERAL, sre.RANGE) for k, _ in arg):
        codes = {c for k, v in arg for c in ([v] if k is sre.LITERAL else range(v[0], min(v[1], v[0] + 99) + 1))}
        return ({chr(c).lower().encode() for c in codes} if len(codes) <= 6 and max(codes) < 128 else None), True
    if op is sre.SUBPATTERN:
        return _walk(arg[-1])
    if op is sre.BRANCH:
        parts = [_walk(p) for p in arg[1]]
        known = set().union(*(s for s, _ in parts if s)) if all(s is not None for s, _ in parts) else None
        return (known if known is not None and len(known) <= EXACT_LIMIT else None), _join("or", [q for _, q in parts])
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
        least, most, body = arg
        strings, needs = _walk(body)
        if strings is not None and (least, most) == (0, 1):
            return strings | {b""}, True
        if strings is not None and least == most == 1:
            return strings, needs
        return None, needs if least else True
    if op is sre.AT:
        return {b""}, True
    return None, True


def trigram_query(rule: Rule) -> object:
    """The Boolean query over trigrams that every match of the rule fulfils; True if there is none."""
    return _walk(sre_parser.parse(rule.pattern))[1]


def vocabulary(queries: list) -> list[bytes]:
    found: dict[bytes, None] = {}

    def visit(q) -> None:
        if isinstance(q, bytes):
            found[q] = None
        elif isinstance(q, tuple):
            for p in q[1]:
                visit(p)

    for q in queries:
        visit(q)
    return list(found)


class TrigramIndex:
    """Postings of one shard, for the trigrams that the rules ask for."""

    def __init__(self, words: list[bytes]) -> None:
        self.words = words
        self.id_of = np.zeros(1 << 24, dtype=np.uint8 if len(words) < 255 else np.uint16)
        for k, w in enumerate(words):
            self.id_of[w[0] << 16 | w[1] << 8 | w[2]] = k + 1

    def postings(self, block: Block) -> dict[bytes, np.ndarray]:
        """Trigram -> ascending rows of the block that hold it."""
        b = LOWER[block.data]
        if len(b) < 3:
            return {}
        code = b[:-2].astype(np.uint32)
        code <<= 8
        code |= b[1:-1]
        code <<= 8
        code |= b[2:]
        ids = self.id_of[code]
        at = np.flatnonzero(ids)
        row = np.searchsorted(block.offsets, at, "right") - 1
        whole = at + 3 <= block.offsets[row + 1]
        pairs = np.unique(ids[at[whole]].astype(np.int64) << 32 | row[whole])
        which, rows = pairs >> 32, pairs & 0xFFFFFFFF
        cut = np.searchsorted(which, np.arange(1, len(self.words) + 2))
        return {w: rows[cut[k] : cut[k + 1]] for k, w in enumerate(self.words) if cut[k + 1] > cut[k]}


def evaluate(query, postings: dict[bytes, np.ndarray], rows: int) -> np.ndarray:
    """Rows that fulfil the query, by intersecting and uniting postings."""
    if query is True:
        return np.arange(rows)
    if isinstance(query, bytes):
        return postings.get(query, np.zeros(0, dtype=np.int64))
    parts = sorted((evaluate(p, postings, rows) for p in query[1]), key=len)
    out = parts[0]
    for p in parts[1:]:
        out = np.intersect1d(out, p, assume_unique=True) if query[0] == "and" else np.union1d(out, p)
    return out


def matches(rule: Rule, pattern: re.Pattern, text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches in code points, without those that are too short."""
    return [m.span(rule.span) for m in pattern.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


SPAN_TYPE = "array<struct<kind:string,start:int,end:int>>"


def scan_secrets(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", out: str = "secrets") -> DataFrame:
    """df with a column `out`: the spans of all rules, by start and then by the rules' order.

    A null or empty text has an empty array. Other columns pass through; an existing column `out` is replaced.
    Rows that repeat, and texts of any length, are scanned one by one and whole; an empty table gives an empty table.
    """
    base = df.drop(out)
    fields = [(f.name, f.dataType.simpleString()) for f in base.schema.fields]
    schema = ", ".join([f"`{n}` {t}" for n, t in fields] + [f"`{out}` {SPAN_TYPE}"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [trigram_query(r) for r in rules]
        patterns = [r.compiled() for r in rules]
        index = TrigramIndex(vocabulary(queries))
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            found: list[list[dict]] = []
            for block in blocks(column):
                texts = column.slice(block.first, block.rows).to_pylist()
                postings = index.postings(block)
                spans: list[list] = [[] for _ in texts]
                for k, (rule, query, pattern) in enumerate(zip(rules, queries, patterns, strict=True)):
                    for r in evaluate(query, postings, block.rows):
                        if texts[r]:
                            spans[r] += [(a, k, b) for a, b in matches(rule, pattern, texts[r])]
                found += [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in sorted(s)] for s in spans]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, type=kind)], names=[*batch.schema.names, out])

    return map_batches(base, run, schema)


def build_index(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The inverted index as a table (trigram string, shard long, keys array), to be stored and searched later.

    A shard is a block of about a megabyte of text; postings list the block's keys in row order.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        index, shard = TrigramIndex(vocabulary([trigram_query(r) for r in rules])), TaskContext.get().partitionId() << 32
        for batch in batches:
            keys = batch.column(0)
            for block in blocks(batch.column(1)):
                postings = index.postings(block)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([w.decode("latin-1") for w in postings], type=pa.string()),
                        pa.array([shard] * len(postings), type=pa.int64()),
                        pa.array([keys.take(pa.array(v + block.first)).to_pylist() for v in postings.values()], type=pa.list_(keys.type)),
                    ],
                    names=["trigram", "shard", "keys"],
                )
                shard += 1

    return map_batches(df.select(key, text), run, f"trigram string, shard long, keys array<{kind}>")


def digest(spans) -> str:
    return hashlib.sha256(",".join(spans).encode()).hexdigest()


def secret_report(df: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, SHA-256 of the base spans and all spans as text, one row for each row of df."""
    scanned = scan_secrets(df.select("doc_id", "text")).select("doc_id", "secrets")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("secrets", lambda s: s["kind"].isin(*(r.kind for r in BASE_RULES)))
    return scanned.select("doc_id", *(count(r.kind) for r in BASE_RULES), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))
