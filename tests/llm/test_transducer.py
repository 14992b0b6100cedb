import hashlib
import itertools
import json
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.conftest import SF
from tests.llm.helpers import clashing, odd
from tokenizers import Tokenizer

from tidewatch.llm import transducer
from tidewatch.llm.transducer import Decoder, Encoder, MergeList, Word, coded, decoded, digests, op12_bpe

PATH = public_tokenizers.path(transducer.TOKENIZER)


@pytest.fixture(scope="module")
def tools():
    return Tokenizer.from_file(PATH), Encoder(PATH), Encoder(PATH, read=1, block=16), Decoder(PATH)


def ids(encoder, text):
    return [i for some in encoder.ids(text) for i in some]


def same(tools, text):
    library, *encoders, decoder = tools
    want = library.encode(text, add_special_tokens=False).ids
    for encoder in encoders:
        assert ids(encoder, text) == want
    blocks = [want[i : i + 3] for i in range(0, len(want), 3)]
    assert "".join(decoder.text(blocks)) == library.decode(want, skip_special_tokens=False)


ALPHABETS = [
    "abcdefghijklmnopqrstuvwxyz '", "'stremvldSTREMVLD ", "0123456789 .-_=!#", "ÀÉïñŁśžß ×÷", "̧́e a",
    "Σςσ ΑΩάΐ", "İIiı", "中文字符，。", "각각", "😀👍🏽‍❤️", "\t\n\r\x0b\x0c\x1c\x85\xa0 　​ a",
    "ǅǆ ﬁ ½²٣०Ⅻ", "ำกཱི क़", "\x00\x01\x7f﻿� a", ["<|endoftext|>", "<|startoftext|>", "x", "<|", " "],
]


def test_texts_of_mixed_alphabets(tools):
    draw = random.Random(5)
    for _ in range(600):
        letters = [c for a in draw.sample(ALPHABETS, draw.randint(1, 3)) for c in a]
        same(tools, "".join(draw.choice(letters) for _ in range(draw.choice([0, 1, 2, 3, 5, 10, 30, 80, 300]))))


@settings(max_examples=150, deadline=None)
@given(text=st.text(max_size=60))
def test_any_text(tools, text):
    same(tools, text)


@pytest.mark.parametrize("text", ["=" * 4000, "ha" * 2000 + "'s", "'" * 3000 + "s", "中" * 3000, "e" + "́" * 2000, "_-" * 2000, "xyz1" * 500])
def test_long_runs(tools, text):
    same(tools, text)


def small_list(draw, letters, size):
    """A random proper list of merges over a few letters, with word ends."""
    made = [c for x in letters for c in (x, x + "</w>")]
    merges = []
    while len(merges) < size:
        a, b = draw.choice([m for m in made if not m.endswith("</w>")]), draw.choice(made)
        if a + b not in made:
            merges.append((a, b))
            made.append(a + b)
    ids_ = {c: i for i, c in enumerate(dict.fromkeys([*made, *(c + e for c in transducer.byte_alphabet() for e in ("", "</w>"))]))}
    return MergeList(merges, ids_)


def test_lookahead_is_sufficient():
    """Whatever follows, the tokens that end a lookahead before the end stay the same."""
    draw = random.Random(2)
    for _ in range(40):
        merges = small_list(draw, "ab", draw.randint(3, 9))
        names = {i: t for t, i in merges.ids.items()}
        for _ in range(6):
            text = "".join(draw.choice("ab") for _ in range(merges.lookahead + 12))
            futures = ["".join(f) for n in range(4) for f in itertools.product("ab", repeat=n)]
            cut = set()
            for more in futures:
                whole = list(text + more)
                whole[-1] += "</w>"
                ends, at = [], 0
                for token in merges.merged(whole):
                    at += merges.size(token)
                    if at <= len(text) - merges.lookahead:
                        ends.append(at)
                cut.add(tuple(ends))
                word = Word(merges, 1)
                streamed = [*itertools.chain.from_iterable(word.feed(c) for c in text + more), *word.close()]
                assert "".join(names[i] for i in streamed) == text + more + "</w>"
                assert [names[i] for i in streamed] == merges.merged(whole)
            assert len(cut) == 1


def test_both_ways_of_merging_agree():
    draw = random.Random(4)
    for _ in range(60):
        merges = small_list(draw, "abc", draw.randint(3, 25))
        symbols = [draw.choice("abc") for _ in range(draw.randint(1, 50))]
        assert merges._one_by_one(symbols) == merges._at_once(symbols)


def test_what_is_held_is_bounded(tools):
    word = Word(tools[1].merges)
    most = 0
    for _ in range(3000):
        for _ in word.feed("ab=" * 20):
            pass
        most = max(most, len(word.held))
    assert most <= word.most and word.most < 2000


def test_improper_lists_are_refused():
    full = {c + e: i for i, (c, e) in enumerate(itertools.product(transducer.byte_alphabet(), ("", "</w>")))}
    with pytest.raises(ValueError):
        MergeList([("ab", "c")], full)
    with pytest.raises(ValueError):
        MergeList([], {"a": 0})


def test_bytes_come_back_as_text(tools):
    plain = Decoder(PATH, plain=True)
    text = "naïve 😀 中 x"
    found = ids(tools[1], text)
    assert "".join(plain.text([i] for i in found)) == text + " "
    half = [i for i in found if len(plain.pieces[i]) and plain.pieces[i][0] >= 0x80][:1]
    assert "".join(plain.text([half, []])).count("�") <= 3
    assert "".join(tools[3].text([[10**6, -1], []])) == ""


def test_query_against_the_library(spark, tools):
    library = tools[0]
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op12_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        back = library.decode(want, skip_special_tokens=False)
        assert r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()


def test_odd_rows(spark, tools):
    docs = clashing(odd(spark))
    found = coded(docs)
    out = found.select("doc_id", "ids", decoded(found["ids"]).alias("back"), digests(found["ids"]).alias("d")).collect()
    key = lambda r: (r["doc_id"] or 0)
    for r, doc in zip(sorted(out, key=key), sorted(docs.collect(), key=key), strict=True):
        want = tools[0].encode(doc["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == want and r["d"]["n_tokens"] == len(want)
        assert r["back"] == tools[0].decode(want, skip_special_tokens=False)
    assert coded(docs.limit(0)).count() == 0


def test_other_kinds_of_tokenizer_are_refused(tmp_path):
    with open(PATH) as file:
        setup = json.load(file)
    setup["model"]["ignore_merges"] = True
    path = tmp_path / "t.json"
    path.write_text(json.dumps(setup))
    with pytest.raises(ValueError):
        Encoder(str(path))
