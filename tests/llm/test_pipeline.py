import pytest
from pyspark.sql import functions as F

import corpus_pipeline as p
from tests.llm.test_dedup import norm
from tests.llm.test_near import brute as near_copies
from tests.llm.test_op1 import brute
from tests.llm.test_tokens import check_pieces
from voxelyard.llm import quality
from voxelyard.llm.shared import materialise


def test_stages_by_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = [docs]
    for name, stage in p.STAGES[:-1]:
        kept.append(materialise(stage(spark, kept[-1], small), "stage"))
        assert kept[-1].schema == docs.schema, name
    ids = [{r["doc_id"]: r["text"] for r in df.collect()} for df in kept]
    judged = quality.judge(docs, spark.read.parquet(f"{small}/labels.parquet"))
    assert {*ids[1]} == {r["doc_id"] for r in judged.where("keep").collect()}
    first = {}
    for i in sorted(ids[1]):
        first.setdefault(norm(ids[1][i]), i)
    assert {*ids[2]} == {*first.values()}
    assert {*ids[3]} == near_copies([*ids[2].items()])  # five-word shingles, similarity 0.8, whatever finds them
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    assert {*ids[4]} == {i for i, _, hit, _ in brute([*ids[3].items()], items) if not hit}
    check_pieces(p.packing_stage(spark, kept[4], small).collect(), ids[4])


def test_run(spark, small):
    out = p.run(spark, small)
    assert out.count() > 0 and {"doc_id", "start", "length", "sequence_id", "offset"} <= set(out.columns)


@pytest.mark.parametrize("k", range(5))
def test_stages_on_odd_tables(spark, odd, none, k, tmp_path):
    spark.createDataFrame([(5, 1), (6, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "same text here")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for df in (odd, none):
        out = p.STAGES[k][1](spark, df, str(tmp_path))
        if k < 4:
            assert out.columns == df.columns and out.count() <= df.count()
        else:
            assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in df.collect()}
    assert p.STAGES[k][1](spark, odd.withColumn("text", F.lit(None).cast("string")), str(tmp_path)).count() >= 1
