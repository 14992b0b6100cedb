import collections
import hashlib
import random

import numpy as np
import pytest
from tests.llm.helpers import clashing, documents, odd

from tidewatch.llm import suffixes as sx


def brute(texts, length):
    """Kept bytes, removed bytes and removed runs of each text."""
    raw = [(t or "").encode() for t in texts]
    count = collections.Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        covered = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                covered[i : i + length] = b"\1" * length
        runs = sum(c and not before for c, before in zip(covered, b"\0" + covered, strict=False))
        out.append((len(b), sum(covered), runs, bytes(x for x, c in zip(b, covered, strict=True) if not c)))
    return out


def found(df):
    return [(r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in df.orderBy("doc_id").collect()]


def shared_texts(seed, n):
    rng = random.Random(seed)
    phrases = ["".join(rng.choice("ab c") for _ in range(rng.randrange(5, 60))) for _ in range(8)]
    return [
        "".join(
            rng.choice(phrases) if rng.random() < 0.5 else "".join(rng.choice("abcdefg hé") for _ in range(rng.randrange(1, 40)))
            for _ in range(rng.randrange(9))
        )
        for _ in range(n)
    ]


# The last number sends strings with more contexts to the counting of windows.
@pytest.mark.parametrize(("length", "gram", "most"), [(20, 4, 512), (24, 8, 1), (33, 16, 2)])
def test_matches_brute_force(spark, length, gram, most):
    texts = shared_texts(length, 120)
    docs = documents(spark, list(enumerate(texts)))
    assert found(sx.deduplicated(docs, length, gram, most)) == brute(texts, length)


def test_contract_length(spark):
    rng = random.Random(9)
    words = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    passage = words(60)
    texts = [words(40) + passage + words(10), passage[:199] + "!" + words(30), passage[50:250] + words(3), words(80),
             "x" * 450, "é" * 150, None, "", passage]
    rows = sx.deduplicated(documents(spark, list(enumerate(texts))))
    assert found(rows) == brute(texts, 200)
    digests = [hashlib.sha256(k).hexdigest() for *_, k in brute(texts, 200)]
    assert len(set(digests)) > 4


def test_odd_rows(spark):
    docs = odd(spark)
    got = sorted((r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in sx.deduplicated(clashing(docs)).collect())
    assert got == sorted(brute([r["text"] for r in docs.collect()], 200))
    assert sx.deduplicated(docs.limit(0)).count() == 0


def test_anchors_do_not_depend_on_the_surroundings():
    rng = random.Random(1)
    core = bytes(rng.randrange(256) for _ in range(400))
    a = core + bytes(rng.randrange(256) for _ in range(500))
    b = bytes(rng.randrange(256) for _ in range(777)) + core
    number, place, _ = sx.anchors([a, b])
    inside = lambda t, first: {p - first for n, p in zip(number, place, strict=True) if n == t and first + 168 <= p <= first + 200}
    assert inside(0, 0) == inside(1, 777)
    for text, number_ in ((a, 0), (b, 1)):  # every window holds one
        mine = np.sort(place[number == number_])
        assert mine[0] <= 168 and len(text) - 200 <= mine[-1] and np.diff(mine).max() <= 169


def test_long_texts_are_hashed_in_pieces():
    rng = np.random.default_rng(3)
    text = rng.integers(0, 256, 1_300_000, dtype=np.uint8).tobytes()
    _, place, _ = sx.anchors([text])
    _, later, _ = sx.anchors([text[400_000:]])
    assert np.diff(place).max() <= 169 and len(np.unique(place)) == len(place)
    assert set((later + 400_000)[2:]) <= set(place)


@pytest.mark.parametrize("shallow", [0, 1, 3])
def test_deep_shallow_sorting(shallow):
    rng = random.Random(shallow)
    rows = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(30))).ljust(32, b"\0") for _ in range(300)]
    rows += rows[:40]
    group = np.array([rng.randrange(4) for _ in rows])
    order, lcp = sx.deep_shallow(np.frombuffer(b"".join(rows), np.uint8).reshape(-1, 32), group, shallow)
    keys = [(group[i], rows[i]) for i in order]
    assert keys == sorted(keys) and sorted(order) == list(range(len(rows)))
    for i in range(1, len(rows)):
        (g, a), (h, b) = keys[i - 1], keys[i]
        assert lcp[i] == (-1 if g != h else next((k for k in range(32) if a[k] != b[k]), 32))
