"""The pipeline as a whole, and what each stage promises, on planted documents."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reachmap.llm import quality, secrets, simhash
from test_llm import brute_base, brute_tiles

PATH = "/root/testdata/sf0.001"


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "SimHash near-dedup", "benchmark decontamination", "secret scans", "SentencePiece encoding and decoding"]


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    labels = spark.read.parquet(f"{PATH}/labels.parquet")
    good = corpus_pipeline.keep_good(spark, docs, PATH)
    model = quality.train(docs, labels, "doc_id", "text", "quality", ~quality.held_out("id"))
    rows = docs.collect()
    log = np.log(0.7 / 0.3)
    kept = [r for r in rows if model.log_odds(r.text or "") >= log]
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in kept}

    sets = {r.doc_id: set(simhash.shingle_bytes(r.text, 5)) for r in kept}
    comp = {}
    for a in sorted(sets):
        if a in comp:
            continue
        comp[a], todo = a, [a]
        while todo:
            x = todo.pop()
            for b in sets:
                if b not in comp and len(sets[x] & sets[b]) >= 0.8 * len(sets[x] | sets[b]):
                    comp[b] = a
                    todo.append(b)
    single = corpus_pipeline.drop_near_duplicates(spark, good, PATH)
    assert {r.doc_id for r in single.collect()} == set(comp.values())

    clean = corpus_pipeline.drop_benchmark(spark, single, PATH)
    text = {r.doc_id: r.text for r in kept}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{PATH}/benchmark.parquet").collect()]
    gone = {i for i in comp.values() if contains_an_item(text[i], items)}
    assert gone and {r.doc_id for r in clean.collect()} == set(comp.values()) - gone
    hidden = corpus_pipeline.hide_secrets(spark, clean, PATH)
    assert hidden.columns == docs.columns
    want = {i: without_secrets(text[i]) for i in set(comp.values()) - gone}
    assert any(want[i] != text[i] for i in want)
    assert {r.doc_id: (r.text, r.n_chars) for r in hidden.collect()} == {i: (t, len(t)) if t != text[i] else (t, next(r.n_chars for r in kept if r.doc_id == i)) for i, t in want.items()}
    tokens = corpus_pipeline.to_tokens(spark, hidden, PATH)
    assert tokens.filter("not exact").count() == 0 and tokens.count() == clean.count()


def contains_an_item(text, items):
    """Tiling as it is defined, of the pairs that share a window of five tokens."""
    words = lambda t: re.findall(r"\w+", (t or "").lower())
    own = words(text)
    seeds = {tuple(own[k : k + 5]) for k in range(len(own) - 4)}
    for _, item in items:
        theirs = words(item)
        if any(tuple(theirs[k : k + 5]) in seeds for k in range(len(theirs) - 4)):
            if sum(n for *_, n in brute_tiles(theirs, own, 5)) >= 0.5 * len(theirs):
                return True
    return False


def without_secrets(text):
    spans = brute_base(text) + [(m.start(), 3, "", m.end()) for x in secrets.MORE_RULES for m in re.finditer(x.pattern, text or "")]
    merged = []
    for start, _, _, end in sorted(spans):
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    for start, end in reversed(merged):
        text = text[:start] + "[SECRET]" + text[end:]
    return text


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_empty_and_odd_rows(spark, name, stage):
    """Null and empty texts, and null ids, stay; the classifier, without a labelled document, goes by the share of good labels."""
    docs = spark.read.parquet(f"{PATH}/documents.parquet").limit(0)
    assert stage(spark, docs, PATH).count() == 0
    odd = docs.unionByName(spark.createDataFrame([(None, None, None, None, None), (10**9, "", "en", "s", 0)], docs.schema)).withColumn("count", F.lit(1))
    got = stage(spark, odd, PATH).collect()
    if name == "quality classifier":
        labels = spark.read.parquet(f"{PATH}/labels.parquet").filter(~quality.held_out("doc_id")).groupBy("quality").count().collect()
        assert sum(r["count"] for r in labels if r.quality == 1) >= 0.7 * sum(r["count"] for r in labels)
    if name == "SentencePiece encoding and decoding":
        assert {(r.doc_id, r.n_chars, r.n_tokens, None if r.ids is None else tuple(r.ids), r.exact) for r in got} == {(None, None, 0, None, True), (10**9, 0, 0, (), True)}, got
    else:
        assert {tuple(r) for r in got} == {(None, None, None, None, None, 1), (10**9, "", "en", "s", 0, 1)}
