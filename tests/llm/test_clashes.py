"""Tables with further columns whose names the operators use themselves."""

import math

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reachmap import storage
from reachmap.llm import langid, lattice, multiindex, quality, secrets, simhash, spm, tiling, urlfilter, warc

NAMES = ["blob", "found", "own_id", "own_hash", "own_key", "own_ids", "own_exact", "text_hash", "text_to_score", "__blob", "__spans", "__id", "__ids", "__key", "__found", "__exact", "_spans", "copies", "stays", "no", "least", "id", "content", "seen", "spans", "rules", "f0", "key", "node", "n", "component", "component_id", "place", "places", "word", "value", "exact", "ids", "score", "label", "url", "host", "path", "block", "held_out", "part", "share", "features", "suffix", "digest", "kept", "v"]


def clash(df):
    return df.withColumns({n: F.lit(f"clash {n}") for n in NAMES if n not in df.columns})


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"the cat {i} sat on the mat and saw the dog number {i % 3} password = abcdefghijklmnop", "en", "s", 9) for i in range(12)]
    return clash(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))


def test_documents(spark, docs):
    labels = clash(spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int"))
    bench = clash(spark.createDataFrame([(1, "nothing that is there at all today")], "item_id long, text string"))
    trees = langid.train(docs, "doc_id", "text", "lang", F.lit(True), 100)
    assert langid.predict(docs, trees, [F.col("doc_id")], "text").count() == 12
    model = quality.train(docs, labels, "doc_id", "text", "quality", F.lit(True))
    assert quality.score(docs, model, "text", [F.col("doc_id")]).count() == 12
    assert quality.accepted(docs, model).columns == docs.columns
    assert {r.n_assign for r in secrets.secret_report(docs).collect()} == {1}
    assert secrets.redact(docs, length_col="n_chars").filter("text like '%[SECRET]' and spans = 'clash spans'").count() == 12
    assert tiling.contaminated(docs, bench).count() == 0
    assert tiling.without_contaminated(docs, bench).columns == docs.columns
    assert simhash.simhash_groups(docs).count() == 12
    assert simhash.one_of_each_group(docs).columns == docs.columns
    assert spm.encode(docs, chunk=16).filter("exact").count() == 12
    assert lattice.lattice_scores(docs, F.lit(False)).count() == 12


def test_pages_and_vectors(spark):
    pages = spark.createDataFrame([(i, f"http://a{i % 4}.example.com/en/{i}", "x" * 500 * i) for i in range(8)], "page_id long, url string, html string")
    pages = pages.withColumns({n: F.lit(f"clash {n}") for n in NAMES if n != "url"})
    assert urlfilter.filter_urls(pages).count() == 8
    path = storage.new_path(spark, "warc-clash")
    warc.write_warc(pages, path)
    assert warc.read_warc(spark, path).filter("digest_ok").count() == 8
    vectors = spark.createDataFrame([(i, [1.0, 0.1 * i], 1) for i in range(6)], "vec_id long, embedding array<float>, label int")
    assert multiindex.near_duplicates(vectors.withColumns({n: F.lit(n) for n in NAMES if n != "label"})).count() == 6


def test_columns_pass_the_stages(spark, docs, tmp_path):
    """All stages, on a table whose further columns have the names that operators use, very long texts, ties and repeats among its rows."""
    rows = [(i, "the cat sat on the mat and saw a dog " * 3 + ("fine " if i % 2 else "spam win$$$ ") * 4, "en", "s", 9) for i in range(60)]
    rows += [(100, "fine long text " * 30_000, "en", "s", 9), (101, "fine long text " * 30_000, "en", "s", 9), (101, "fine long text " * 30_000, "en", "s", 9), (102, None, "en", "s", None), (None, "fine cat", None, None, None), (103, "fine password = abcdefghijklmnop", "en", "s", 4), (104, "fine nothing that is there at all today", "en", "s", 4)]
    docs = clash(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    clash(spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")).write.parquet(f"{tmp_path}/labels.parquet")
    clash(spark.createDataFrame([(1, "nothing that is there at all today"), (None, None)], "item_id long, text string")).write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = storage.written(stage(spark, docs, str(tmp_path)), "clash")
        assert out.count() > 0, name
        if stage is corpus_pipeline.STAGES[-1][1]:
            assert out.filter("exact").count() == len(rows)
        else:
            assert out.columns == docs.columns, name
            assert {r[n] for r in out.select(*NAMES).distinct().collect() for n in NAMES} <= {f"clash {n}" for n in NAMES}, name
        if name == "quality classifier":
            # what the same model gives to the texts, one by one
            model = quality.train(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"), "doc_id", "text", "quality", ~quality.held_out("id"))
            texts = {i: t for i, t, *_ in rows}
            accepted = [i for i in (100, 101, 101, 102, 103, 104) if model.log_odds(texts[i] or "") >= math.log(0.7 / 0.3)]
            assert 100 in accepted and 104 in accepted
        ids = sorted(r.doc_id for r in out.select("doc_id").collect() if r.doc_id is not None and r.doc_id >= 100)
        want = {"quality classifier": accepted, "SimHash near-dedup": [100, 102, 103, 104], "benchmark decontamination": [100, 101, 101, 102, 103]}.get(name, [100, 101, 101, 102, 103, 104])
        assert ids == want, name
