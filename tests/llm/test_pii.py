import hashlib
import random
import re
import time
from types import SimpleNamespace

import numpy as np
from tests.conftest import SF
from tests.llm.helpers import clashing, odd

from tidewatch.llm import pii
from pyspark.sql import functions as F

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def digits(text):
    return re.sub("[^0-9]", "", text)


def check(kind, found):
    n = len(digits(found))
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        total = sum(int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(digits(found)[::-1]))
        return 16 <= n <= 19 and total % 10 == 0
    return kind == "email" or 8 <= n <= 15


def brute(text):
    return [
        (k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if check(k, m[0])
    ]


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_query_keeps_the_base_spans(spark):
    got = {r["doc_id"]: r for r in pii.op8_pii(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        want, row = brute(d["text"]), got[d["doc_id"]]
        assert row["base_sha256"] == hashlib.sha256(listed(want).encode()).hexdigest()
        assert set(listed(want).split(",")) <= set(row["spans"].split(",")) or not want
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(k == s[0] for s in want) for k in pii.KINDS]


def test_base_rules_on_random_texts():
    rng = random.Random(8)
    parts = ["a.b", "@", "x", "-", ".", " ", "com", "+1", "255", "256", "1.2.3.4", "4", "4111111111111111", "(", ")",
             "555-1234", "é", "\n", "%", "_", "0"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(25)))
        assert [(k, a, b) for k in pii.KINDS for a, b in pii.base(text)[k]] == brute(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 200_000, "1" * 200_000, "1.1." * 50_000, "+" * 100_000, "a@" * 50_000, "+1" + " (" * 100_000):
        pii.base(text)
        list(pii.candidates(text))


def model():
    votes = [("card", 1, 1, 1, 0, 1, 1, 400), ("card", 1, -1, 1, 0, 1, 1, 90), ("card", -1, -1, -1, -1, 1, 1, 50),
             ("phone", 1, 1, 1, 0, 1, 2, 400), ("phone", -1, -1, 0, -1, 1, 1, 60), ("email", 1, 1, 1, 0, 1, 3, 300)]
    return pii.learn(votes)


def test_weak_labels_find_what_the_base_rules_drop():
    text = "call +1 (269) 555-3296 4524132264652876 now, order 4524132264652870"
    assert brute(text) == []  # phone and card run together
    _, every = pii.found(text, model())
    assert [(k, text[a:b]) for k, a, b in every] == [("card", "4524132264652876"), ("phone", "+1 (269) 555-3296")]


def test_reliabilities_are_recovered():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.6
    right = (0.95, 0.9, 0.8, 0.7, 0.6)
    votes = np.column_stack([np.where(rng.random(4000) < r, truth, ~truth) * 2 - 1 for r in right])
    votes[truth, 1] = 1  # real numbers pass their check
    share, table = pii.reliabilities(votes, np.ones(4000), 60)
    weight = np.log(np.array(right) / (1 - np.array(right))) * (np.arange(5) != 1)
    odds = np.log(0.6 / 0.4) + votes @ weight + np.where(votes[:, 1] > 0, np.log(1 / 0.1), -np.inf)
    best = np.mean((odds > 0) == truth)  # with the reliabilities known
    assert np.mean((share > 0.5) == truth) > best - 0.005
    assert table[0, 2, 1] > table[4, 2, 1]


def test_odd_rows(spark):
    docs = clashing(odd(spark))
    trained = pii.train(docs)
    out = docs.select(pii.detected(F.col("text"), trained).alias("s")).collect()
    assert len(out) == 10 and not any(r["s"] for r in out)
    assert pii.train(docs.limit(0)).weights == {}


def seconds(call, *given):
    started = time.perf_counter()
    call(*given)
    return time.perf_counter() - started


def test_many_spans_in_one_text_take_linear_time():
    """A long log of addresses and numbers: twice the text, about twice the time."""
    learned = model()
    line = "from a.{}@mail.example.com at 10.2.{}.7 call +1 (269) 555-3296 4524132264652876\n"
    text = lambda n: "".join(line.format(i, i % 255) for i in range(n))
    pii.found(text(200), learned)
    small, large = text(7_000), text(14_000)
    assert len(large) > 1_000_000
    assert seconds(pii.found, large, learned) < 3.2 * min(seconds(pii.found, small, learned) for _ in range(2)) + 0.2


def test_selection_of_spans_equals_the_plain_one(monkeypatch):
    """Longest first, none that overlaps another."""
    draw = random.Random(6)

    class Every:
        def accepts(self, _):
            return True

    for _ in range(200):
        spans = [(a, a + draw.randint(1, 12)) for a in (draw.randrange(60) for _ in range(draw.randint(0, 14)))]
        sure = {k: [] for k in pii.KINDS} | {pii.KINDS[0]: spans[:3]}
        others = [SimpleNamespace(kind=pii.KINDS[-1], start=a, end=b) for a, b in spans[3:]]
        monkeypatch.setattr(pii, "base", lambda _, sure=sure: sure)
        monkeypatch.setattr(pii, "candidates", lambda _, others=others: others)
        taken = list(spans[:3])
        for a, b in sorted(spans[3:], key=lambda s: (s[0] - s[1], s[0])):
            if not any(x < b and a < y for x, y in taken):
                taken.append((a, b))
        assert sorted((a, b) for _, a, b in pii.found("", Every())[1]) == sorted(taken)
