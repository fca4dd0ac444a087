import random
import re

import pytest

from llm_samples import make_docs
from tidemark.llm import mixing


def highest_quotients(weights, seats, limits):
    out = [0] * len(weights)
    for _ in range(min(seats, sum(t for w, t in zip(weights, limits) if w > 0))):
        best = max((i for i in range(len(weights)) if out[i] < limits[i] and weights[i] > 0), key=lambda i: (weights[i] / (2 * out[i] + 1), -i))
        out[best] += 1
    return out


def test_apportionment_is_highest_quotients():
    r = random.Random(4)
    for _ in range(200):
        n = r.randint(1, 8)
        weights = [r.choice([0, 1, 2.5, 7, 40, 0.2]) for _ in range(n)]
        limits = [r.randint(0, 30) for _ in range(n)]
        seats = r.randint(0, 60)
        got = mixing.apportion(weights, seats, limits)
        want = highest_quotients(weights, seats, limits) if sum(weights) else [0] * n
        assert got.sum() == sum(want) and (got <= limits).all()
        if all(t > 60 for t in limits):
            assert list(got) == want
    assert list(mixing.apportion([5, 2, 1], 9, [99, 99, 99])) == highest_quotients([5, 2, 1], 9, [99] * 3)


def test_targets_stop_at_the_limit():
    assert mixing.source_targets([10, 100, 100], [5, 2, 1], 1.5, 2) == pytest.approx([20, 295 * 2 / 3, 295 / 3])
    assert mixing.source_targets([0, 0], [5, 2], 1.5, 2) == [0, 0]
    assert mixing.source_targets([], [], 1.5, 2) == []


def test_mix_takes_each_target(spark, documents):
    rows = mixing.mix(documents).join(documents.select("doc_id", "source", "text"), "doc_id").collect()
    by_source = {}
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
        assert 0 <= r["taken"] <= 2 * r["size"]
        by_source.setdefault(r["source"], []).append(r)
    for own in by_source.values():
        assert own[0]["source_size"] == sum(r["size"] for r in own)
        assert sum(r["taken"] for r in own) == pytest.approx(own[0]["target"], rel=0.01)
    assert sum(own[0]["target"] for own in by_source.values()) == pytest.approx(1.5 * sum(r["size"] for r in rows))
    again = {r["doc_id"]: r["taken"] for r in mixing.mix(documents.repartition(5)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}


def test_odd_rows(odd, none, odd_rows):
    rows = mixing.mix(odd).collect()
    assert len(rows) == len(odd_rows)
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert sorted(r["size"] for r in rows) == sorted(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _, _ in odd_rows)
    assert mixing.mix(none).collect() == []
    whole = mixing.repeated(odd)
    assert whole.columns == odd.columns and whole.count() >= 1
    assert mixing.repeated(none).count() == 0


def test_whole_copies_meet_the_target_at_every_block_size(spark, monkeypatch):
    r = random.Random(8)
    rows = [(None if k % 50 == 7 else k // 2 if k % 50 == 9 else k, "w " * max(1, int(r.lognormvariate(3, 0.7))), "en", "abc"[min(k % 7, 2)])
            for k in range(2100)]
    docs = make_docs(spark, rows).repartition(4).persist()
    for top, mixture in ((4096, mixing.Mixture()), (8, mixing.Mixture()), (1, mixing.Mixture(weights=(1, 4, 8), share=0.4)),
                         (4096, mixing.Mixture(weights=(1, 4, 8), share=0.4))):
        monkeypatch.setattr(mixing, "MAX_SHARDS", top)
        mixed = mixing.mix(docs, mixture, carry=True)
        found = mixed.select("*", "row.source").collect()
        for name in "abc":
            own = [x for x in found if x["source"] == name]
            assert all(x["taken"] // x["size"] <= x["copies"] <= -(-x["taken"] // x["size"]) for x in own)
            given = sum(x["copies"] * x["size"] for x in own)
            assert abs(given - own[0]["target"]) <= 0.01 * own[0]["target"] + max(x["size"] for x in own), (top, name)
        again = mixing.mix(docs.repartition(7), mixture).collect()
        assert sorted((x["doc_id"] or -1, x["size"], x["copies"]) for x in found) == sorted(
            (x["doc_id"] or -1, x["size"], x["copies"]) for x in again)
        whole = {x["source"]: x["n"] for x in mixing.repeated(docs, mixture).groupBy("source").count().withColumnRenamed("count", "n").collect()}
        assert whole == {n: sum(x["copies"] for x in found if x["source"] == n) for n in "abc"}


def test_null_ids_are_dealt_over_shards(spark):
    """Ten thousand texts without an id: no shard has much more than its share."""
    docs = make_docs(spark, [(None, "w " * (1 + k % 40) + str(k), "en", "s") for k in range(10_000)])
    mixed = mixing.mix(docs)
    assert mixed.count() == 10_000 and mixed.where("taken > 2 * size").isEmpty()
    total = mixed.agg({"taken": "sum"}).first()[0]
    assert total == pytest.approx(mixed.first()["target"], rel=0.01)
    dealt = docs.selectExpr("pmod(xxhash64(xxhash64(doc_id, coalesce(text, '')), 20240229), 8) AS shard").groupBy("shard").count()
    assert {r["shard"] for r in dealt.collect()} == set(range(8)) and dealt.agg({"count": "max"}).first()[0] < 1500


def test_taken_block_by_block(spark):
    """One source, one shard: blocks laid over the documents in their order, each taken as often as the quota says."""
    docs = make_docs(spark, [(k, "w " * (1 + (k * 37) % 90), "en", "s") for k in range(120)])
    mixture = mixing.Mixture(share=0.7)
    rows = mixing.mix(docs, mixture, block=16).collect()
    total = sum(r["size"] for r in rows)
    assert total < mixing.BLOCKS_PER_SHARD * 16 * 1.5  # one shard
    order = docs.selectExpr("doc_id", "xxhash64(xxhash64(doc_id, text), 20240230) AS at", "xxhash64(doc_id, text) AS key").orderBy("at", "key").collect()
    size = {r["doc_id"]: r["size"] for r in rows}
    words = [r["doc_id"] for r in order for _ in range(size[r["doc_id"]])]
    n = round(total / 16)
    quota = round(0.7 * total * n / total)
    stride, shift = mixing._stride(n, mixture.seed), (mixture.seed * 31) % n
    taken = dict.fromkeys(size, 0)
    for j in range(n):
        times = quota // n + ((j * stride + shift) % n < quota % n)
        for x in words[j * total // n : (j + 1) * total // n]:
            taken[x] += times
    assert {r["doc_id"]: r["taken"] for r in rows} == taken
