r"""Find secrets with a trigram index over each batch of documents.

Every rule's regular expression is turned into a Boolean trigram query: trigrams that
all matches must hold, joined by AND, alternatives by OR. A batch of documents gets an
inverted index of the trigrams that the queries name, postings are intersected and
united, and only the documents left are verified with the expression. A rule from which
no trigram follows is verified on every document. The index is local to a batch, as in a
sharded code search: no text is shuffled, memory is bounded by the batch, and a lost
task is redone from its split.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from re import _constants as op
from re import _parser as parser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import digest_input, table

Clauses = list[frozenset[str]]  # any clause whose trigrams are all there


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    flags: int = re.ASCII
    group: int = 0
    least: int = 0  # characters of the group

    def spans(self, text: str) -> list[tuple[int, int]]:
        found = re.compile(self.pattern, self.flags).finditer(text)
        return [m.span() for m in found if m.end(self.group) - m.start(self.group) >= self.least]


BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.ASCII | re.IGNORECASE,
        2,
        12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", re.ASCII, 0, 18),
    Rule("hex", r"[0-9a-f]{16,}"),
)
# A heading, then header fields and base64 lines to the END line, where there is one, or else the base64
# lines that follow. Lines may be indented, quoted, or end in an escaped line feed.
_BREAK = r"""(?:[\x20\t>#*+"',]|\r|\n|\\[rnt])*+"""
_PEM = (
    r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"
    rf"(?:{_BREAK}(?:[A-Za-z]+-[A-Za-z]+:[^\n\\]*+(?:\n|\\n)|[A-Za-z0-9+/=]++(?={_BREAK}-----END )|[A-Za-z0-9+/=]{{16,}}+))*+"
    rf"(?:{_BREAK}-----END (?:[A-Z]+ )*PRIVATE KEY-----)?"
)
# Published formats of well-known issuers.
MORE = (
    Rule("pem", _PEM),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    # Begins with a run of its letters and takes runs whole, so no run is gone through twice.
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]+"),
)
RULES = BASE + MORE
MOST_EXACT = 64  # strings followed through one stretch of an expression

# ---- Boolean trigram queries


def query(rule: Rule) -> Clauses | None:
    """Trigrams, in lower case, that a text with a match must hold; None: nothing follows."""
    tree = parser.parse(rule.pattern, rule.flags)
    return _simplest(_all_of(tree))


def _all_of(items) -> Clauses | None:
    """The query of a sequence: stretches of known strings, cut where one is not known."""
    known, found = {""}, None
    for item in items:
        strings = _strings([item])
        if strings is not None and len(known) * len(strings) <= MOST_EXACT:
            known = {a + b for a in known for b in strings}
            continue
        found = _and(found, _of_strings(known))
        if strings is not None:
            known = strings
        else:
            known = {""}
            found = _and(found, _inside(item))
    return _and(found, _of_strings(known))


def _inside(item) -> Clauses | None:
    """The query of one item that stands for too many strings to list."""
    kind, value = item
    if kind is op.SUBPATTERN:
        return _all_of(value[-1])
    if kind is op.BRANCH:
        return reduce(_or, [_all_of(x) for x in value[1]])
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT) and value[0] > 0:
        return _all_of(value[2])
    return None


def _strings(items) -> set[str] | None:
    """All strings that the items can match, if they are few."""
    out = {""}
    for kind, value in items:
        if kind is op.LITERAL:
            more = {chr(value).lower()}
        elif kind is op.IN and all(k is op.LITERAL for k, _ in value):
            more = {chr(v).lower() for _, v in value}
        elif kind is op.AT:
            more = {""}
        elif kind is op.SUBPATTERN:
            more = _strings(value[-1])
        elif kind is op.BRANCH:
            each = [_strings(x) for x in value[1]]
            more = None if None in each else set().union(*each)
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT) and value[1] is not op.MAXREPEAT and value[1] <= 8:
            once = _strings(value[2])
            more = None if once is None else set()
            for n in range(value[0], value[1] + 1) if once is not None else ():
                more |= reduce(lambda a, b: {x + y for x in a for y in b}, [once] * n, {""})
                if len(more) > MOST_EXACT:
                    return None
        else:
            more = None
        if more is None or len(out) * len(more) > MOST_EXACT:
            return None
        out = {a + b for a in out for b in more}
    return out


def _of_strings(strings: set[str]) -> Clauses | None:
    if any(len(s) < 3 for s in strings):
        return None
    return [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings]


def _and(a: Clauses | None, b: Clauses | None) -> Clauses | None:
    if a is None or b is None:
        return b if a is None else a
    return _simplest([x | y for x in a for y in b])


def _or(a: Clauses | None, b: Clauses | None) -> Clauses | None:
    return None if a is None or b is None else _simplest(a + b)


def _simplest(clauses: Clauses | None) -> Clauses | None:
    """Without the clauses that another one implies."""
    if clauses is None:
        return None
    return sorted(
        {x for x in clauses if not any(y < x for y in clauses)}, key=lambda x: sorted(x)
    )


# ---- Index


class TrigramIndex:
    """Postings of the trigrams that some queries name, over one batch of texts."""

    def __init__(self, texts: Sequence[str], trigrams: set[str]):
        folded = [t.lower() for t in texts]
        self.size = len(texts)
        self.postings = {
            gram: np.array([i for i, t in enumerate(folded) if gram in t], dtype=np.int64)
            for gram in trigrams
        }

    def candidates(self, clauses: Clauses | None) -> np.ndarray:
        """Rows that may match: a union over clauses of intersected postings."""
        if clauses is None:
            return np.arange(self.size)
        hits = [
            reduce(np.intersect1d, sorted((self.postings[g] for g in clause), key=len))
            for clause in clauses
        ]
        return reduce(np.union1d, hits, np.empty(0, np.int64)).astype(np.int64)


def scanner(rules: Sequence[Rule]) -> Callable[[Sequence[str]], list[list[tuple[str, int, int]]]]:
    """A function from texts to their spans ``(kind, start, end)``, by start, then rule."""
    queries = [query(r) for r in rules]
    grams = set().union(*(clause for q in queries if q for clause in q))

    def scan(texts: Sequence[str]) -> list[list[tuple[str, int, int]]]:
        index = TrigramIndex(texts, grams)
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for order, (rule, clauses) in enumerate(zip(rules, queries, strict=True)):
            for row in index.candidates(clauses):
                found[row] += [(start, order, end) for start, end in rule.spans(texts[row])]
        return [[(rules[k].kind, start, end) for start, k, end in sorted(spans)] for spans in found]

    return scan


# ---- Operators

SPANS = "array<struct<kind:string,start:long,end:long>>"


def spans(text: Column, rules: Sequence[Rule] = RULES) -> Column:
    """The spans of each text, in code points, end exclusive; NULL is empty."""

    @F.pandas_udf(SPANS)
    def run(texts: pd.Series) -> pd.Series:
        found = scanner(rules)([t or "" for t in texts])
        return pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in row] for row in found])

    return run(text)


def redacted(docs: DataFrame, rules: Sequence[Rule] = RULES, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every secret replaced by ``mark`` and ``n_chars`` kept in step.

    Overlapping spans are replaced once. Texts without a secret, NULL and empty ones stay
    as they are; all rows and columns are kept.
    """

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        found = scanner(rules)([t or "" for t in texts])
        return pd.Series([_cover(t, row, mark) for t, row in zip(texts, found, strict=True)], dtype=object)

    out = docs.withColumn("text", run("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def _cover(text: str | None, found: list[tuple[str, int, int]], mark: str) -> str | None:
    if not found:
        return text
    out, at = [], 0
    for _, start, end in found:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of the secrets in every document."""
    kinds = [r.kind for r in BASE]

    @F.pandas_udf(
        "struct<n_assign:long,n_access:long,n_hex:long,base_sha256:string,spans:string>"
    )
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for found in scanner(RULES)([t or "" for t in texts]):
            base = [s for s in found if s[0] in kinds]
            counts = [sum(s[0] == k for s in base) for k in kinds]
            digest = hashlib.sha256(digest_input(base).encode()).hexdigest()
            rows.append((*counts, digest, digest_input(found)))
        return pd.DataFrame(rows, columns=[*(f"n_{k}" for k in kinds), "base_sha256", "spans"])

    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", run("text").alias("r")).select("doc_id", "r.*")
