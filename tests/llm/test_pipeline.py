from collections import Counter

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tidemark.llm.common import stored

from llm_samples import FOLDER


def test_stages_keep_the_columns_and_decide(spark, documents):
    docs, sizes = documents, [documents.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, FOLDER), "stage")
        assert docs.columns == documents.columns, name
        sizes.append(docs.count())
    assert sizes[1] < sizes[0] and sizes[2] <= sizes[1] and sizes[3] < sizes[2]
    once = docs.distinct()
    assert once.count() <= sizes[3] and once.join(documents, documents.columns, "left_semi").count() == once.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert packed.selectExpr("sum(length)").first()[0] == packed.where("start = 0").selectExpr("sum(doc_tokens)").first()[0]


def test_stages_take_odd_and_empty_tables(spark, odd, none, odd_rows):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, none):
            out = stage(spark, docs, FOLDER)
            assert name == "packing" or out.columns == docs.columns
            if docs is none:
                assert out.count() == 0, name
            elif name == "packing":
                assert out.where("start = 0").count() == len(odd_rows)
            else:  # rows of the input, unchanged; mixing may repeat them
                texts = Counter(t for _, t, _, _ in odd_rows)
                found = Counter(r["text"] for r in out.collect())
                limit = 2 if name.startswith("mixing") else 1
                assert all(n <= limit * texts[t] for t, n in found.items()), name
                if name.startswith("n-gram"):
                    assert all(found[t] == 1 for t, n in texts.items() if t and n > 1), name  # copies became one


def test_registered():
    names = queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names and corpus_pipeline.ORACLE_SQL is None
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "quality rules", "n-gram Jaccard join", "mixing sources to target weights", "packing"]
    assert {"op7_quality_rules", "op11_merkle_manifest", "op12_hard_negatives"} <= set(oracle_sql())
