import pytest

import corpus_pipeline as P
from palimpsest.llm import near_dedup
from palimpsest.llm.common import stored

from .helpers import SF, documents, empty_documents, odd_documents


def test_stages_in_order_and_columns(spark):
    docs = documents(spark)
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "simhash_near_dedup", "best_fit_packing"]
    for name, stage in P.STAGES[:-1]:
        out = stored(stage(spark, docs, SF), "t")
        assert out.columns == documents(spark).columns and 0 < out.count() <= docs.count()
        docs = out
    rows = P.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.collect()}
    got = P.run(spark, SF).collect()
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, got)) == sorted(map(key, rows))


def test_language_stage_keeps_clean_documents(spark):
    docs = documents(spark)
    assert P.language_id(spark, docs, SF).count() >= 0.99 * docs.count()
    junk = docs.limit(5).selectExpr("doc_id + 100000 as doc_id", "'12 34 !!' as text", "lang", "source", "n_chars")
    assert P.language_id(spark, docs.union(junk), SF).where("doc_id >= 100000").count() == 0


def test_near_dedup_stage_leaves_one_of_each_group(spark):
    docs = documents(spark)
    kept = {r["doc_id"] for r in P.remove_near_duplicates(spark, docs, SF).collect()}
    assert kept == {r["component_id"] for r in near_dedup.near_duplicates(docs).collect()}


@pytest.mark.parametrize("name,stage", P.STAGES)
def test_odd_and_empty_tables(spark, name, stage):
    stage(spark, odd_documents(spark), SF).collect()
    out = stage(spark, empty_documents(spark), SF)
    assert out.count() == 0
