"""Each stage of the pipeline against a plain version on its own input."""

import corpus_pipeline
import numpy as np
from tests.conftest import SF
from tests.llm.helpers import clashing, odd
from tests.llm.test_mixing import brute_targets
from tests.llm.test_packing import check
from tests.llm.test_secrets import brute as base_secrets
from tests.llm.test_simhash import brute_bits, brute_groups
from tests.llm.helpers import WORD

from tidewatch.llm import quality
from tidewatch.plans import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_on_the_smallest_tables(spark):
    (_, good), (_, distinct), (_, clean), (_, mix), (_, pack) = corpus_pipeline.STAGES
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = stage(good(spark, docs, SF), "t")
    model = quality.train(docs, labels)
    before = docs.orderBy("doc_id").collect()
    scores = model.score(quality.matrix([r["text"] for r in before]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [r["doc_id"] for r, s in zip(before, scores, strict=True) if s >= 0.5]
    marked = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert np.mean([r["doc_id"] in {k["doc_id"] for k in kept.collect()} for r in before if marked.get(r["doc_id"]) == 1]) > 0.97

    one = stage(distinct(spark, kept, SF), "t")
    prints = [(r["doc_id"], brute_bits(r["text"])) for r in kept.collect()]
    assert sorted(r["doc_id"] for r in one.collect()) == sorted({g for g in brute_groups(prints).values()})

    blank = stage(clean(spark, one, SF), "t")
    texts = {r["doc_id"]: r["text"] for r in one.collect()}
    for r in blank.collect():
        found = base_secrets(texts[r["doc_id"]])
        assert (r["text"] == texts[r["doc_id"]]) == (not found) and not base_secrets(r["text"])
        assert r["n_chars"] == len(r["text"])

    mixed = stage(mix(spark, blank, SF), "t")
    sizes, taken = {}, {}
    for r in blank.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(WORD.findall(r["text"]))
    for r in mixed.collect():
        taken[r["source"]] = taken.get(r["source"], 0) + len(WORD.findall(r["text"]))
    wanted = brute_targets(sizes)
    assert max(abs(taken[s] - t) for s, t in wanted.items()) < 0.05 * max(wanted.values())

    rows = pack(spark, mixed, SF).collect()
    used, bound = check(rows, [(r["doc_id"], r["text"]) for r in mixed.collect()])
    assert used <= 1.03 * bound
    assert all(d.columns == COLUMNS for d in (kept, one, blank, mixed))
    assert corpus_pipeline.run(spark, SF).count() == len(rows)


def test_stages_take_odd_rows_and_none(spark):
    for docs in (clashing(odd(spark)), odd(spark).limit(0)):
        for k, (name, step) in enumerate(corpus_pipeline.STAGES):
            out = stage(step(spark, docs, SF), "t")
            if k < 4:
                assert out.columns == docs.columns, name
                docs = out
            else:
                assert out.count() >= docs.count()
