import hashlib

import numpy as np
import pytest

from llm_samples import make_docs, prose
from tidemark.llm import spotsigs


def brute(rows):
    """(id, n, sha of the edited text) in descending order of id, nulls last."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = []
    for k, (i, t, *_) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        edited = t[: len(t) - len(t) // 3] + nxt[: len(t) // 3]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    return out


def test_edits_follow_the_next_document(spark, odd_rows, none, monkeypatch):
    seen, rows = set(), []
    for r in odd_rows:
        if r[0] not in seen:
            seen.add(r[0])
            rows.append(r)
    rows += [(1000 + k, prose(k, 40 + k), "en", "s") for k in range(60)]
    docs = make_docs(spark, rows).repartition(4)
    for chars in (1 << 24, 3000):  # one range and many
        monkeypatch.setattr(spotsigs, "ROWS_PER_RANGE_CHARS", chars)
        got = spotsigs.edited(docs).collect()
        assert sorted((r["doc_id"] or -1, r["n_chars"], r["edited_sha256"]) for r in got) == sorted((i or -1, n, s) for i, n, s in brute(rows))
    one = spotsigs.edited(make_docs(spark, [(5, "a b c d e f", "en", "s")])).collect()
    assert one[0]["near_next"] == 1 and one[0]["n_chars"] == 11
    assert spotsigs.edited(none).collect() == []
    assert spotsigs.edited(make_docs(spark, [(1, "x y", "", ""), (1, "x y", "", ""), (1, None, "", "")])).count() == 3


def test_likeness_of_edits(documents):
    rows = spotsigs.edited(documents).collect()
    assert np.mean([r["near_edited"] for r in rows]) > 0.4
    assert np.mean([r["near_next"] for r in rows]) < 0.05
    assert all(0 <= r[c] <= 1 for r in rows for c in ("near_edited", "near_next"))


def test_fingerprints_of_equal_texts_are_equal():
    texts = [prose(1, 50), prose(1, 50), "", " ", "\n", "word", "word", prose(2, 50), "中文 é"]
    a, b = spotsigs.spot_sets(texts), [spotsigs.spot_sets([t])[0] for t in texts]
    assert all((x == y).all() and len(x) == len(y) for x, y in zip(a, b))
    assert spotsigs.encoded(a[0]) == spotsigs.encoded(a[1]) != spotsigs.encoded(a[7])
    assert len(a[2]) == 0 and spotsigs.encoded(a[3]) != spotsigs.encoded(a[4]) and len(a[5]) == 1


def test_pruning_loses_nothing():
    r = np.random.default_rng(1)
    left = [np.unique(r.integers(0, 60, n)).astype(np.uint32) for n in r.integers(0, 50, 300)]
    right = [np.unique(np.append(s[: int(len(s) * r.random())], r.integers(0, 60, r.integers(0, 6)))).astype(np.uint32) for s in left]
    whole = spotsigs.likeness(left, right)
    for i, (a, b) in enumerate(zip(left, right)):
        want = 1.0 if not len(a) and not len(b) else len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert whole[i] == pytest.approx(want)
    for threshold in (0.5, 0.8):
        pruned = spotsigs.likeness(left, right, threshold)
        assert (pruned[whole >= threshold] == whole[whole >= threshold]).all()


def test_near_duplicates_equal_brute_force(spark, none):
    rows = [(k, prose(k % 5, 200) + (" extra" * (k % 4) if k % 3 else "") + f" tail{k % 7}", "en", "s") for k in range(25)]
    rows += [(50, "", "en", "s"), (51, None, "en", "s")]
    sets = {i: frozenset(spotsigs.spot_sets([t or ""])[0].tolist()) for i, t, *_ in rows}
    near = lambda x, y: x == y or bool(x and y) and len(x & y) >= 0.8 * len(x | y)
    got = {r["doc_id"]: r["n_links"] for r in spotsigs.near_duplicates(make_docs(spark, rows)).collect()}
    assert got == {i: sum(near(s, t) for j, t in sets.items() if j != i) for i, s in sets.items()}
    assert spotsigs.near_duplicates(none).collect() == []


def test_ranges_cut_hot_keys_by_ties():
    r = np.random.default_rng(5)
    key = np.where(r.random(20_000) < 0.4, -1, r.integers(0, 50, 20_000))
    tie = r.integers(-(2**63), 2**63 - 1, 20_000)
    splits = np.sort(key)[np.arange(1, 40) * 500]  # as quantiles are
    own = spotsigs.range_of(splits, key, tie)
    order = np.lexsort([tie, key])
    assert (np.diff(own[order]) >= 0).all()  # ranges follow the order
    assert np.bincount(own).max() < 1300 and own.min() >= 0 and own.max() <= len(splits)
    assert spotsigs.range_of(np.zeros(0, np.int64), key[:3], tie[:3]).tolist() == [0, 0, 0]


def test_many_rows_without_an_id(spark, monkeypatch):
    """A third of the rows have no id: their next ones follow by the hash of their texts, over all ranges."""
    import hashlib

    rows = [(None if k % 3 == 0 else k, prose(k, 5 + k % 30), "en", "s") for k in range(900)]
    docs = make_docs(spark, rows).repartition(3)
    monkeypatch.setattr(spotsigs, "ROWS_PER_RANGE_CHARS", 5000)
    got = sorted((r["doc_id"] or -1, r["n_chars"], r["edited_sha256"]) for r in spotsigs.edited(docs).collect())
    order = docs.selectExpr("doc_id", "text", "xxhash64(text) AS h").orderBy("doc_id", "h").collect()[::-1]
    want = []
    for a, b in zip(order, order[1:] + order[:1]):
        cut = len(a["text"]) // 3
        want.append((a["doc_id"] or -1, len(a["text"]), hashlib.sha256((a["text"][: len(a["text"]) - cut] + b["text"][:cut]).encode()).hexdigest()))
    assert got == sorted(want)
