r"""Find personal data by weak supervision.

Patterns propose candidate spans. Labelers vote on each: its exact shape, check digits and
ranges, gazetteers of issuers and domains, the words around it. An
expectation-maximisation over the counts of vote patterns estimates, kind by kind, how
reliable each labeler is, without a label. The resulting probabilities train a logistic
span classifier on votes and shape, which decides about every candidate. Votes and shapes
take few values, so only a bounded table of counts leaves the workers. Matches of the
base rules are always kept; accepted candidates that overlap no other span are added,
longest first.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import digest_input, table

KINDS = ("email", "ip", "card", "phone")

# ---- Base rules

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
Span = tuple[int, int]


def emails(text: str) -> list[Span]:
    """Leftmost matches, found from each ``@`` so that long words cost no backtracking."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            out.append((start, end))
        else:
            end = max(end, at)
        at = text.find("@", at + 1 if not domain else end)
    return out


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def ips(text: str) -> list[Span]:
    return [m.span() for m in _IP.finditer(text) if _octets(m[0])]


def _octets(found: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))


def cards(text: str) -> list[Span]:
    return [m.span() for m in _CARD.finditer(text) if _card(m[0])]


def _card(found: str) -> bool:
    digits = _NOT_DIGIT.sub("", found)
    return 16 <= len(digits) <= 19 and luhn(digits)


def phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]


_BASE = {"email": emails, "ip": ips, "card": cards, "phone": phones}


def base(text: str) -> dict[str, list[Span]]:
    """Matches of the base rules by kind; a failing match is dropped and not retried."""
    digits = any(d in text for d in "0123456789")
    return {k: f(text) if (k == "email" and "@" in text) or (k != "email" and digits) else [] for k, f in _BASE.items()}


# ---- Candidates, labelers and shapes

_CANDIDATES = {
    "email": re.compile(
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}\x20?(?:@|\[at\]|\(at\))\x20?"
        r"[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}"
    ),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:([\x20-])[0-9]{4})(?:\1[0-9]{4}){2})(?![0-9])"),
    "phone": re.compile(
        r"(?:(?<![0-9A-Za-z])\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,4}\)[\x20.-]?|(?<![0-9])[0-9]{2,4}[\x20.-])"
        r"[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])"
    ),
}
_SURE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    "ip": re.compile(r"(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}"),
    "card": re.compile(r"[0-9]{16}|[0-9]{15}|[0-9]{4}(?:[\x20-][0-9]{4}){3}"),
    "phone": re.compile(r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-][0-9]{3,4}"),
}
# Common top-level domains, calling codes, card issuer prefixes.
_DOMAINS = frozenset("com org net edu gov io info biz de fr es uk it nl pl ru cn jp br in eu us ca au ch at".split())
_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 54 55 61 81 86 90 91".split())
_ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6011|65|35")
_AROUND = {
    "email": re.compile(r"(?i)\b(?:e-?mail|mail|contact|write|reach|courriel|correo)\b"),
    "ip": re.compile(r"(?i)\b(?:ip|host|server|address|login|from)\b"),
    "card": re.compile(r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|carte|tarjeta|karte)\b"),
    "phone": re.compile(r"(?i)\b(?:tel|phone|call|mobile|fax|cell|telefon|tél|teléfono)\b"),
}
_AGAINST = re.compile(r"(?i)\b(?:version|isbn|issn|order|invoice|page|id|build|release|section|chapter|doi)\W*$")
WINDOW = 32  # characters around a span that its context labeler reads
LABELERS = ("form", "digits", "gazetteer", "context", "edges")
FAILED_CHECK = 1e-4  # greatest share of true spans whose check digits, ranges or counts fail
SHAPES = 4  # classes of length


@dataclass(frozen=True)
class Candidate:
    kind: str
    start: int
    end: int
    votes: tuple[int, ...]  # of LABELERS: 1 for, -1 against, 0 abstains
    shape: int

    @property
    def features(self) -> tuple:
        return (self.kind, *self.votes, self.shape)


def candidates(text: str) -> Iterator[Candidate]:
    """Candidate spans of a text with the labelers' votes."""
    digits = any(d in text for d in "0123456789")
    for kind, pattern in _CANDIDATES.items():
        if kind == "email" and not ("@" in text or "at]" in text or "at)" in text):
            continue
        if kind != "email" and not digits:
            continue
        for m in _found(kind, pattern, text):
            yield Candidate(kind, *m.span(), _votes(kind, m[0], text, *m.span()), _shape(m[0]))


def _found(kind: str, pattern: re.Pattern, text: str):
    if kind != "email":
        return pattern.finditer(text)
    # Only near a sign of an address, so that plain prose is not walked character by character.
    end, out = 0, []
    for sign in re.finditer(r"@|\[at\]|\(at\)", text):
        m = pattern.search(text, max(end, sign.start() - 66), min(len(text), sign.end() + 600))
        if m and m.start() < sign.start():
            out.append(m)
            end = m.end()
    return out


def _shape(found: str) -> int:
    return min(SHAPES - 1, len(found) // 8)


def _votes(kind: str, found: str, text: str, start: int, end: int) -> tuple[int, ...]:
    before, after = text[max(0, start - WINDOW) : start], text[end : end + WINDOW]
    digits = _NOT_DIGIT.sub("", found)
    shape = 1 if _SURE[kind].fullmatch(found) else -1
    if kind == "email":
        check = 1 if "@" in found and ".." not in found else -1
        gazetteer = 1 if found.rpartition(".")[2].lower() in _DOMAINS else 0
    elif kind == "ip":
        check = 1 if _octets(found) else -1
        gazetteer = -1 if found.startswith(("0.", "127.", "255.", "224.")) else 0
    elif kind == "card":
        check = 1 if luhn(digits) else -1
        gazetteer = 1 if _ISSUERS.match(digits) else -1
    else:
        check = 1 if 10 <= len(digits) <= 13 else -1
        code = re.match(r"\+([0-9]{1,3})", found)
        gazetteer = 0 if not code else 1 if any(code[1][:n] in _CODES for n in (1, 2)) else -1
    context = -1 if _AGAINST.search(before) else 1 if _AROUND[kind].search(before + " " + after) else 0
    edges = 1 if not (before[-1:].isalnum() or after[:1].isalnum()) else -1
    return shape, check, gazetteer, context, edges


# ---- Reliabilities and the span classifier


@dataclass(frozen=True)
class Model:
    """Per kind: reliabilities of the labelers, and the weights of the span classifier."""

    reliability: dict[str, np.ndarray]  # labeler x (vote against, none, for) x (not, is)
    weights: dict[str, np.ndarray]

    def accepts(self, c: Candidate) -> bool:
        w = self.weights.get(c.kind)
        return w is not None and float(_encoded([c.features[1:]])[0] @ w) > 0


def vote_counts(docs: DataFrame) -> DataFrame:
    """``kind``, the votes, ``shape`` and ``n`` over all candidates of all whole texts."""
    names = ["kind", *LABELERS, "shape"]

    @F.pandas_udf("array<struct<kind:string," + ",".join(f"{c}:int" for c in names[1:]) + ",n:long>>")
    def count(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            tally = Counter(c.features for c in candidates(text or ""))
            out.append([dict(zip(names, f, strict=True)) | {"n": n} for f, n in tally.items()])
        return pd.Series(out)

    votes = docs.select(F.explode(count("text")).alias("v")).select("v.*")
    return votes.groupBy(*names).agg(F.sum("n").alias("n"))


def learn(counts: list[tuple], rounds: int = 60) -> Model:
    """Fit to rows ``(kind, *votes, shape, n)``; their number is bounded by the values of votes."""
    reliability, weights = {}, {}
    for kind in KINDS:
        rows = sorted(r for r in counts if r[0] == kind)
        if not rows:
            continue
        votes = np.array([r[1 : 1 + len(LABELERS)] for r in rows])
        n = np.array([r[-1] for r in rows], float)
        posterior, reliability[kind] = reliabilities(votes, n, rounds)
        weights[kind] = logistic(_encoded([r[1:-1] for r in rows]), posterior, n)
    return Model(reliability, weights)


def reliabilities(votes: np.ndarray, n: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation for labelers that are independent given the truth.

    It starts from the majority of votes, with a veto for failed check digits and ranges, and
    the counts are smoothed by a prior under which a vote is right more often than wrong,
    so that few candidates cannot turn it around. Numbers that fail their check are next to
    never real, whatever the other votes; that reliability is known and not estimated.
    """
    share = ((votes.sum(axis=1) > 0) & (votes[:, LABELERS.index("digits")] >= 0)).astype(float) * 0.8 + 0.1
    prior = np.array([[4.0, 1.0], [2.0, 2.0], [1.0, 4.0]])  # vote x truth
    for _ in range(rounds):
        table_ = np.empty((votes.shape[1], 3, 2))
        for j in range(votes.shape[1]):
            for v in (-1, 0, 1):
                at = votes[:, j] == v
                table_[j, v + 1] = prior[v + 1] + [(n[at] * (1 - share[at])).sum(), (n[at] * share[at]).sum()]
        table_ /= table_.sum(axis=1, keepdims=True)
        check = table_[LABELERS.index("digits"), :, 1]
        check[0] = min(check[0], FAILED_CHECK)
        check /= check.sum()
        rate = ((n * share).sum() + 1) / (n.sum() + 2)
        odds = np.log(rate / (1 - rate)) * np.ones(len(n))
        for j in range(votes.shape[1]):
            odds += np.log(table_[j, votes[:, j] + 1, 1] / table_[j, votes[:, j] + 1, 0])
        share = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return share, table_


def _encoded(rows: list[tuple]) -> np.ndarray:
    """Votes as two indicators each, shape classes, and a constant."""
    out = []
    for *votes, shape in rows:
        out.append([x for v in votes for x in (v == 1, v == -1)] + [shape == k for k in range(SHAPES)] + [True])
    return np.array(out, float)


def logistic(x: np.ndarray, target: np.ndarray, n: np.ndarray, penalty: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights of a logistic regression on probabilities, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (target - p)) - penalty * w
        curve = (x.T * (n * p * (1 - p))) @ x + penalty * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


# ---- Operators


def train(docs: DataFrame) -> Model:
    return learn([tuple(r) for r in vote_counts(docs).collect()])


def _covered(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the disjoint stretches that the spans cover, in order."""
    starts, ends = [], []
    for a, b in sorted(spans):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def found(text: str, model: Model) -> tuple[dict[str, list[Span]], list[tuple[str, int, int]]]:
    """Base spans by kind, and all spans by kind as listed, then start."""
    sure = base(text)
    out = [(kind, a, b) for kind in KINDS for a, b in sure[kind]]
    accepted = [c for c in candidates(text) if model.accepts(c)]
    starts, ends = _covered([(a, b) for _, a, b in out])
    for c in sorted(accepted, key=lambda c: (c.start - c.end, c.start, c.kind)):  # longest first
        at = bisect_left(starts, c.end)
        if not at or ends[at - 1] <= c.start:
            out.append((c.kind, c.start, c.end))
            starts.insert(at, c.start)
            ends.insert(at, c.end)
    return sure, sorted(out, key=lambda s: (KINDS.index(s[0]), s[1:]))


def detected(text: Column, model: Model) -> Column:
    """``array<struct<kind, start, end>>`` of each text in code points, end exclusive; NULL is empty."""

    @F.pandas_udf("array<struct<kind:string,start:long,end:long>>")
    def run(texts: pd.Series) -> pd.Series:
        every = [found(t or "", model)[1] for t in texts]
        return pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in row] for row in every])

    return run(text)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of the personal data in every document."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs)

    @F.pandas_udf("struct<n_email:long,n_ip:long,n_card:long,n_phone:long,base_sha256:string,spans:string>")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            sure, every = found(text or "", model)
            listed = [(k, a, b) for k in KINDS for a, b in sure[k]]
            digest = hashlib.sha256(digest_input(listed).encode()).hexdigest()
            rows.append((*(len(sure[k]) for k in KINDS), digest, digest_input(every)))
        return pd.DataFrame(rows, columns=[*(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return docs.select("doc_id", run("text").alias("r")).select("doc_id", "r.*")
