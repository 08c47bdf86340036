"""Secret scan with a trigram inverted index.

Each rule's regex is analysed once into a Boolean query over trigrams of
lower-cased bytes. Every batch of documents is an index segment: it keeps
postings (trigram -> rows) of the trigrams that occur in some query,
intersects and unites them into candidate rows per rule, and verifies only the
candidates with the regex. A rule without mandatory trigrams scans all rows.
Segments are independent: no shuffle, no state beyond a batch, and a lost
executor repeats only its own partitions.

Defined results: a null text counts as empty; an empty text or table has no
spans; repeated rows give equal rows; other input columns are not read by
``scan``. A private key is one span from its BEGIN line over its body to its END
line; a key cut off before its END goes as far as the base64 does. Spans are code points, end exclusive; spans of different rules may
overlap and all are kept.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as C
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.llm.store import map_batches
from scorelake.llm.textblock import LOWER, Block


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    flags: int = re.ASCII

    def spans(self, text: str) -> list[tuple[int, int]]:
        return [m.span() for m in re.compile(self.pattern, self.flags).finditer(text)
                if m.end(self.group) - m.start(self.group) >= self.least]


#: The three base kinds. Runs of a class are maximal, so ``{24,}`` gives what ``+`` and a length check give.
BASE_RULES = (
    Rule("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
         2, 6, re.ASCII | re.IGNORECASE),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
_BREAK = r"(?:\r?\n|(?:\\r)?\\n)"
_BASE64 = r"[A-Za-z0-9+/]"
#: A key from its header to the END line of the same label; without one before the next BEGIN, over what follows
#: of base64: runs of 16 or more, and lines (real or escaped breaks, quoted or indented) of nothing else.
_PRIVATE_KEY = (
    r"-----BEGIN ([A-Z ]{0,20})PRIVATE KEY-----"
    r"(?:(?:(?!-----BEGIN )[\s\S])*?-----END \1PRIVATE KEY-----"
    rf"|(?:(?:{_BREAK}(?:Proc-Type|DEK-Info):[^\r\n\\]*)|"
    rf"(?:[\x20\t>#*\"'+,/]|{_BREAK})*{_BASE64}{{16,}}={{0,2}}|"
    rf"{_BREAK}+[\x20\t>#*\"'/]*{_BASE64}+={{0,2}}(?=[\x20\t\"',;]*(?:\r|\n|\\[rn]|\Z)))*)")
RULES = BASE_RULES + (
    Rule("private_key", _PRIVATE_KEY),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    # from the start of a run of its class, so that each run is entered once
    Rule("web_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"://[A-Za-z0-9._-]{1,64}:[A-Za-z0-9._~!$&*+=-]{3,64}@"),
)

#: At most so many strings are followed exactly through a regex; beyond, the part gives no trigrams.
MOST_STRINGS = 64
SPAN_TYPE = "array<struct<kind:string,start:long,end:long>>"


# ------------------------------------------------------------- regex -> query
# A query is True (no condition), a trigram (bytes), or ("and" | "or", frozenset of queries).
def _join(op: str, parts) -> object:
    parts = set(parts)
    if op == "and":
        parts.discard(True)
        if not parts:
            return True
    elif True in parts or not parts:
        return True
    return parts.pop() if len(parts) == 1 else (op, frozenset(parts))


def _of_strings(strings: set[bytes]) -> object:
    """Any one of these strings occurs."""
    return _join("or", [_join("and", [s[i:i + 3] for i in range(len(s) - 2)]) for s in strings])


def _class(items, most: int) -> set[bytes] | None:
    out = set()
    for op, arg in items:
        if op is C.LITERAL and arg < 128:
            out.add(chr(arg).lower().encode())
        elif op is C.RANGE and arg[1] < 128 and arg[1] - arg[0] < most:
            out |= {chr(c).lower().encode() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return out if len(out) <= most else None


def _walk(tree) -> tuple[set[bytes] | None, object]:
    """(all strings the part can match or None if too many, query that each match fulfils)."""
    run, whole, found = {b""}, True, []

    def flush():
        nonlocal run, whole
        found.append(_of_strings(run))
        run, whole = {b""}, False

    for op, arg in tree:
        exact, query = None, True
        if op is C.LITERAL and arg < 128:
            exact = {chr(arg).lower().encode()}
        elif op is C.IN:
            exact = _class(arg, 8)
        elif op is C.SUBPATTERN:
            exact, query = _walk(arg[3])
        elif op is C.BRANCH:
            parts = [_walk(p) for p in arg[1]]
            if all(e is not None for e, _ in parts):
                exact = set().union(*(e for e, _ in parts))
            query = _join("or", [q if e is None else _of_strings(e) for e, q in parts])
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT):
            low, high, sub = arg
            inner, query = _walk(sub)
            if inner is not None and low == high and len(inner) ** low <= MOST_STRINGS:
                exact = {b""}
                for _ in range(low):
                    exact = {a + b for a in exact for b in inner}
            elif inner is not None and (low, high) == (0, 1):
                exact = inner | {b""}
            else:
                query = True if low == 0 else query if inner is None else _of_strings(inner)
        elif op is C.AT:
            continue
        if exact is not None and len(exact) * len(run) <= MOST_STRINGS:
            run = {a + b for a in run for b in exact}
        else:
            flush()
            found.append(query if exact is None else _of_strings(exact))
    if whole:
        return run, _of_strings(run)
    flush()
    return None, _join("and", found)


def trigram_query(pattern: str, flags: int = 0) -> object:
    """The Boolean trigram query that every match of the regex fulfils (True: none is mandatory)."""
    return _walk(_parser.parse(pattern, flags))[1]


def query_trigrams(query) -> set[bytes]:
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(query_trigrams, query[1]))


# ------------------------------------------------------------- index segment
class Index:
    """The rules ready for scanning: their trigram queries and the number of each wanted trigram (built once a task)."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.queries = [trigram_query(r.pattern, r.flags) for r in rules]
        self.trigrams = sorted(set().union(set(), *map(query_trigrams, self.queries)))
        self.number = np.zeros(1 << 24, np.uint8 if len(self.trigrams) < 255 else np.uint16)
        for i, t in enumerate(self.trigrams):
            self.number[int.from_bytes(t, "big")] = i + 1

    def postings(self, block: Block) -> dict[bytes, np.ndarray]:
        """Sorted rows of the batch that hold each of the trigrams."""
        low = LOWER[block.bytes].astype(np.uint32)
        if len(low) < 3 or not self.trigrams:
            return {t: np.zeros(0, np.int64) for t in self.trigrams}
        hit = self.number[(low[:-2] << np.uint32(16)) | (low[1:-1] << np.uint32(8)) | low[2:]]
        at = np.flatnonzero(hit)
        row = np.searchsorted(block.offsets, at, side="right") - 1
        inside = at + 3 <= block.offsets[row + 1]
        pairs = np.unique(hit[at[inside]].astype(np.int64) * block.rows + row[inside])
        edge = np.searchsorted(pairs, np.arange(1, len(self.trigrams) + 2) * block.rows)
        return {t: pairs[edge[i]:edge[i + 1]] - (i + 1) * block.rows for i, t in enumerate(self.trigrams)}


def candidates(query, posting: dict[bytes, np.ndarray], rows: int) -> np.ndarray:
    if query is True:
        return np.arange(rows)
    if isinstance(query, bytes):
        return posting[query]
    sets = sorted((candidates(q, posting, rows) for q in query[1]), key=len)
    out = sets[0]
    for s in sets[1:]:
        out = np.intersect1d(out, s, True) if query[0] == "and" else np.union1d(out, s)
    return out


def find_spans(texts: pa.Array, rules: Index | tuple[Rule, ...]) -> list[list[tuple[str, int, int]]]:
    """The spans of each text by start, then rule, found through one index segment."""
    index = rules if isinstance(rules, Index) else Index(rules)
    posting = index.postings(Block(texts))
    values = texts.to_pylist()
    found: list[list[tuple[int, int, str, int]]] = [[] for _ in values]
    for order, (rule, query) in enumerate(zip(index.rules, index.queries)):
        for row in candidates(query, posting, len(values)).tolist():
            found[row] += [(s, order, rule.kind, e) for s, e in rule.spans(values[row] or "")]
    return [[(kind, s, e) for s, _, kind, e in sorted(f)] for f in found]


def scan(df: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Per row: its id and ``spans`` (kind, start, end) by start, then rule order."""

    def run(batch: pa.RecordBatch, index: Index) -> pa.RecordBatch:
        spans = [[{"kind": k, "start": s, "end": e} for k, s, e in row]
                 for row in find_spans(batch.column(1), index)]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["doc_id", "spans"])

    src = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(src, run, f"doc_id {src.schema[0].dataType.simpleString()}, spans {SPAN_TYPE}",
                       state=lambda: Index(rules))


def redact(df: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text",
           mask: str = "[secret]") -> DataFrame:
    """All rows and columns, with each maximal run of secret characters replaced by ``mask``."""

    def clean(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
        if not spans:
            return text
        out, done = [], 0
        for _, s, e in spans:
            if s > done or not out:
                out += [text[done:s], mask]
            done = max(done, e)
        return "".join(out) + text[done:]

    def run(batch: pa.RecordBatch, index: Index) -> pa.RecordBatch:
        at = batch.schema.get_field_index(text_col)
        texts = batch.column(at)
        new = [clean(t, s) for t, s in zip(texts.to_pylist(), find_spans(texts, index))]
        return batch.set_column(at, text_col, pa.array(new, texts.type))

    return map_batches(df, run, df.schema, state=lambda: Index(rules))
