import corpus_pipeline as cp
import pytest
from tidelog.llm import near_dedup, queries, secrets, toxicity
from tidelog.llm.common import durable


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for _, stage in cp.STAGES:
        out.append(durable(stage(spark, out[-1], sf_dir)))
    return out


def test_stages_are_named_and_keep_the_columns(steps):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near-dedup", "secrets", "mixing", "packing"]
    assert all(s.columns == steps[0].columns for s in steps[:-1])
    assert set(queries.QUERIES) >= {"op1_mixing", "op10_near_dedup"} and len(queries.QUERIES) == 10


def test_each_stage_takes_effect(spark, sf_dir, steps):
    docs, civil, distinct, clean, mixed, packed = steps
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert ids(civil) == ids(toxicity.score(docs, *model).where("predicted = 0"))
    assert ids(distinct) == ids(near_dedup.near_copies(civil).where("doc_id = component_id")) and len(ids(distinct)) < len(ids(civil))
    assert ids(clean) == ids(distinct)
    assert secrets.digest(clean).where("n_assign + n_access + n_hex > 0").count() == 0
    assert set(ids(mixed)) <= set(ids(clean)) and ids(packed.where("piece = 0")) == ids(mixed)


def test_run_equals_its_stages(spark, sf_dir, steps):
    key = lambda df: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert key(cp.run(spark, sf_dir)) == key(steps[-1])


def test_an_empty_table(spark, sf_dir, no_docs):
    docs = no_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in cp.STAGES:
        docs = durable(stage(spark, docs, sf_dir))
        assert docs.count() == 0
