"""The corpus pipeline against its stages done by hand, and the SQL of the operators."""

from collections import Counter

import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F
from tallyspark.llm import registry
from tallyspark.llm.shared import table


def test_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, sf)
        assert out.columns == docs.columns, name
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in kept.select("doc_id").collect()}
        kept = corpus_pipeline.stored(out, "test")
    clean = table(spark, sf, "labels").filter("toxic = 0").select("doc_id")
    toxic_gone = corpus_pipeline.STAGES[0][1](spark, docs, sf)
    assert clean.join(toxic_gone, "doc_id", "left_anti").count() < 0.02 * clean.count()
    pieces = corpus_pipeline.run(spark, sf)
    assert pieces.select("doc_id").distinct().count() == kept.count()
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 4096").count() == 0


def test_one_of_repeated_rows_and_null_ids_stays(spark):
    text = lambda k: " ".join(f"{k}w{i}" for i in range(200))
    rows = [(7, text("a")), (7, text("a")), (None, text("b")), (None, text("b")), (3, text("c")), (None, text("c")), (1, text("d")), (2, text("d")), (2, text("e")), (9, None), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text"))
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    want = Counter([(7, text("a")), (None, text("b")), (3, text("c")), (1, text("d")), (2, text("e")), (9, None), (9, "")])
    assert kept.columns == docs.columns and Counter((r.doc_id, r.text) for r in kept.collect()) == want
    # The next stage finds nothing repeated in them.
    texts = Counter((r.doc_id, r.text or "") for r in corpus_pipeline.cut_repeats(spark, corpus_pipeline.stored(kept, "test"), "").collect())
    assert texts == Counter((i, t or "") for i, t in want.elements())


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_sql(spark, sf, name):
    con = duckdb.connect()
    for t in "documents embeddings conversations labels benchmark".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.execute(registry.SQL[name]).df()
    got = registry.QUERIES[name](spark, sf).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    rows = lambda df: sorted(map(tuple, df[columns].astype(str).to_numpy().tolist()))
    assert rows(got) == rows(want)
