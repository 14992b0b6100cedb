import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.conftest import SF
from tests.llm.helpers import clashing, odd
from tokenizers import Tokenizer

from tidewatch.llm import packing

SLOW = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
FAST = packing.Encoder(public_tokenizers.path(packing.TOKENIZER), public_tokenizers.path(packing.RANKS))


def ids(text):
    return [*SLOW.encode(text or "", add_special_tokens=False).ids, 2]


def check(rows, texts):
    """``texts`` as ``(doc_id, text)``, repeats included; every token once, no gap, no overflow."""
    want = Counter()
    for i, text in texts:
        tokens = np.array(ids(text), dtype="<u4")
        assert [n for _, n in packing.cut(len(tokens), 1024)][1:] == [1024] * (-(-len(tokens) // 1024) - 1)
        for k, (s, n) in enumerate(packing.cut(len(tokens), 1024)):
            want[i, k, s, n, zlib.crc32(tokens[s : s + n].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    return len(sequences), -(-sum(r["length"] for r in rows) // 1024)


def test_query_packs_every_document(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    used, bound = check(packing.op10_packing(spark, SF).collect(), [(d["doc_id"], d["text"]) for d in docs])
    assert used <= 1.03 * bound


def test_odd_rows(spark):
    docs = odd(spark)
    check(packing.packed(clashing(docs)).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert packing.packed(docs.limit(0)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=60))
def test_ids_equal_the_tokenizers(text):
    assert FAST.ids(text) == ids(text)[:-1]


def test_ids_of_hard_texts():
    rng = random.Random(2)
    near = [chr(c) for c in range(1, 0x180)]
    texts = ["<|endoftext|> a<|endoftext|>", "  \n\n  x", "it's WE'LL", "a" * 3000, " " * 30_000 + "x", "1" * 25_000, "é" * 21_000]
    texts += ["".join(rng.choice(near) for _ in range(80)) for _ in range(300)]
    assert [FAST.ids(t) for t in texts] == [ids(t)[:-1] for t in texts]


def lengths(pattern):
    return Counter(x for content, n in pattern for x in content for _ in range(n))


def test_plans_use_every_piece_and_fill_gaps():
    rng = random.Random(3)
    for _ in range(60):
        counts = Counter(rng.randrange(1, 65) for _ in range(rng.randrange(200)))
        made = packing.plan(counts, 64)
        assert lengths(made) == counts and all(sum(c) <= 64 for c, _ in made)
    assert sum(n for _, n in packing.plan({40: 1, 10: 1, 8: 1, 6: 1, 64: 3}, 64)) == 4  # a triple
    assert sum(n for _, n in packing.plan({32: 1_000_001}, 64)) == 500_001
    many = Counter({x: 10_000 + x for x in range(1, 1025)})
    made = packing.plan(many)
    # No two pieces of more than half a sequence go together, nor three of half.
    assert sum(n for _, n in made) == sum(n for x, n in many.items() if x > 512) + many[512] // 2
    assert len(made) < 5000


def test_complements():
    left = np.zeros(65, np.int64)
    left[[5, 9, 20]] = 1, 1, 2
    assert packing.complement(left, 20) == (20,)
    assert packing.complement(left, 14) == (9, 5)
    assert packing.complement(left, 40) == (20, 20)
    assert packing.complement(left, 45) == (20, 20, 5)
    assert packing.complement(left, 45, 2) is None and packing.complement(left, 10) is None
