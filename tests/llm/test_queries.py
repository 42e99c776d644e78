"""The registered queries: SQL twins, the pipeline against its stages' definitions."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tallyframe.llm import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_sql_twins(spark, con, name):
    got = catalog.QUERIES[name](spark, SF)
    want = con.sql(catalog.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    assert sorted(tuple(r[c] for c in cols) for r in got.collect()) == sorted(con.sql(f"select {', '.join(cols)} from ({catalog.ORACLES[name]}) q").fetchall())


def test_all_registered():
    names = entry.queries()
    assert all(any(k.startswith(f"op{n}_") for k in names) for n in range(1, 14)) and "pipeline" in names
    assert [k for k, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "n-gram Jaccard join", "substring dedup", "best-fit packing"]


def test_pipeline_stages(spark):
    """Each stage keeps what its operator says of its own input; the run equals the stages."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    from tallyframe.llm import jaccard_join, quality_rules, substring_dedup, toxicity
    from tallyframe.llm.shared import stored

    clean = stored(corpus_pipeline.drop_toxic(spark, docs, SF))
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids(clean) == sorted(r.doc_id for r in toxicity.toxicity_scores(docs, model).collect() if not r.predicted)
    good = stored(corpus_pipeline.drop_low_quality(spark, clean, SF))
    assert ids(good) == sorted(r.doc_id for r in quality_rules.quality_rules(clean).collect() if r.kept)
    alone = stored(corpus_pipeline.drop_near_duplicates(spark, good, SF))
    assert ids(alone) == sorted(r.doc_id for r in jaccard_join.join(good).collect() if r.doc_id == r.component_id)
    cut = stored(corpus_pipeline.drop_repeated_passages(spark, alone, SF))
    removed = {r.doc_id: r.n_removed for r in substring_dedup.dedup(alone).collect()}
    before = {r.doc_id: r for r in alone.collect()}
    for r in cut.collect():
        old = before.pop(r.doc_id)
        assert (r.lang, r.source) == (old.lang, old.source)
        assert len(r.text.split()) == len(old.text.split()) - removed[r.doc_id] and (removed[r.doc_id] or (r.text, r.n_chars) == (old.text, old.n_chars))
    assert not before
    for frame in (clean, good, alone, cut):
        assert frame.columns == docs.columns
    packed = sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in corpus_pipeline.pack_sequences(spark, cut, SF).collect())
    run = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in run) == packed


def test_stages_take_odd_rows(spark):
    """Nulls in every column, repeated rows and ids, clashing extra columns, and no rows at all."""
    import random

    from pyspark.sql import functions as F
    from texts import prose
    from tallyframe.llm.shared import stored
    rng = random.Random(3)
    text, other = prose(rng, 300, 4000), prose(rng, 300, 4000)
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, text, "en", "a", len(text)), (1, text, "en", "a", len(text)), (2, text, None, None, None), (None, other, None, "b", 5), (None, None, None, None, None),
            (3, "", "en", "a", 0), (4, other + " more", "en", "a", 7), (5, prose(rng, 200, 4000) + " " + " ".join(text.split()[:80]), "fr", "c", 1)]
    odd = spark.createDataFrame(rows, kind).select("*", *[F.lit("x").alias(c) for c in ("score", "component_id", "n_removed", "__tf_id", "toxic")])
    for docs, alive in ((odd, True), (odd.where("false"), False)):
        counts = []
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SF))
            counts.append(docs.count())
            if name != "best-fit packing":
                assert docs.columns == corpus_pipeline.COLUMNS
            if name == "n-gram Jaccard join" and alive:
                assert sorted(r.doc_id for r in docs.collect()) == [1, 1, 4, 5]      # 2 copies 1, the row without an id is near 4
            if name == "substring dedup" and alive:
                left = {r.doc_id: r for r in docs.collect()}
                assert len(left[5].text.split()) == 200 and left[5].n_chars == len(left[5].text) and left[1].text == text
        assert counts == ([8, 6, 4, 4, 4] if alive else [0] * 5)


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())
