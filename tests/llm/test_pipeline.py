import corpus_pipeline
from keepwell.llm import bpe, queries
from tests.llm import brute


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").cache()
    columns = docs.columns
    functions = dict(corpus_pipeline.STAGES)
    good = functions["quality classifier"](spark, docs, sf_dir)
    bad = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1").join(good, "doc_id", "left_anti").count()
    assert good.columns == columns and bad <= 2 and 0 < good.count() < docs.count()
    near = functions["near dedup"](spark, docs, sf_dir)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert near.columns == columns
    assert sorted(r.doc_id for r in near.collect()) == sorted(i for i, x in brute.near(rows).items() if x[2])
    fresh = functions["line dedup"](spark, docs, sf_dir)
    assert fresh.columns == columns and fresh.filter("n_chars <> length(text)").count() == 0


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir).collect()
    ids = {r.doc_id for r in out}
    assert ids and len(out) >= len(ids)
    assert all(r.n_tokens == len(r.ids) for r in out)


def test_names():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert bpe.vocabulary_path("/x") == "/x/byte_bpe_50k.json"
