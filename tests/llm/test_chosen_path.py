import random
import re
from collections import defaultdict

import numpy as np

from llm_samples import make_docs, prose
from tidemark.llm import chosen_path, links


def brute(rows, threshold=0.8):
    """(id, class, links) by comparing all pairs of shingle sets."""
    sets = []
    for i, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        sets.append((i, frozenset(tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))) if w else frozenset()))
    order = lambda i: -1 if i is None else i
    near = [[False] * len(sets) for _ in sets]
    for a, (_, x) in enumerate(sets):
        for b, (_, y) in enumerate(sets):
            near[a][b] = a != b and (x == y or (len(x & y) >= threshold * len(x | y) - 1e-9 if x and y else False))
    label = list(range(len(sets)))
    changed = True
    while changed:
        changed = False
        for a in range(len(sets)):
            for b in range(len(sets)):
                if near[a][b] and label[b] < label[a]:
                    label[a], changed = label[b], True
    least = defaultdict(list)
    for a, (i, _) in enumerate(sets):
        least[label[a]].append(i)
    return sorted((order(i), order(min(least[label[a]], key=order)), sum(near[a])) for a, (i, _) in enumerate(sets))


def got(df):
    order = lambda i: -1 if i is None else i
    return sorted((order(r["doc_id"]), order(r["class_id"]), r["n_links"]) for r in df.collect())


def edited(text, n, seed):
    words, r = text.split(" "), random.Random(seed)
    for _ in range(n):
        words[r.randrange(len(words))] = "edit" + str(r.randrange(1000))
    return " ".join(words)


def test_equals_brute_force(spark, odd_rows):
    rows = [(i, t, lang, s) for i, t, lang, s in odd_rows if i is not None]
    for k in range(30):  # copies with few to many edits around the threshold
        base = prose(k % 6, 150)
        rows.append((100 + k, edited(base, k % 9, k), "en", "s"))
    rows += [(200, "one two three", "en", "s"), (201, "one  two\nthree", "en", "s"), (202, "one two", "en", "s")]
    assert got(chosen_path.similar(make_docs(spark, rows))) == brute(rows)


def test_a_group_larger_than_leaves_and_blocks(spark):
    base = prose(50, 300)
    rows = [(k, edited(base, 1 + k % 3, k), "en", "s") for k in range(chosen_path.LEAF * 3)]
    assert got(chosen_path.similar(make_docs(spark, rows))) == brute(rows)


def test_real_documents(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert got(chosen_path.similar(documents)) == brute(rows)


def test_one_row_of_each_class(spark, odd, none, odd_rows):
    kept = chosen_path.distinct(odd)
    assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in kept.collect())
    # null ids, the least of all: one row, which stands for the texts without words too
    assert len(ids) == len(set(ids)) and (True, 1) in ids and (True, 2) not in ids
    assert chosen_path.distinct(none).count() == 0 and chosen_path.similar(none).count() == 0


def test_null_and_repeated_ids_of_different_texts(spark):
    # null ids and one repeated id on unrelated texts, each with a near copy, some of them under an id of its own
    rows = [(None, prose(300 + k, 80), "en", "s") for k in range(12)] + [(7, prose(400 + k, 80), "en", "s") for k in range(12)]
    rows += [(500 + k, edited(prose(300 + k, 80), 1, k), "en", "s") for k in range(0, 12, 3)]
    rows += [(None, edited(prose(400 + k, 80), 1, k), "en", "s") for k in range(0, 12, 4)]
    rows += [(3, edited(prose(405, 80), 1, 5), "en", "s"), (7, prose(401, 80), "en", "s"), (None, None, "en", "s"), (7, " ", "en", "s"), (None, prose(301, 80), "en", "s")]
    docs = make_docs(spark, rows).repartition(4)
    assert got(chosen_path.similar(docs)) == brute(rows)
    texts = {t for _, t, *_ in rows}
    kept = [(r["doc_id"], r["text"]) for r in chosen_path.distinct(docs).collect()]
    assert len(kept) == 12 + 12 + 1  # one row for each of the unrelated texts, and one for those without words
    words = lambda t: frozenset((t or "").split())
    for k in range(300, 312):  # the row of a valid id stays, where there is one
        own = [i for i, t in kept if len(words(t) & words(prose(k, 80))) > 0.9 * len(words(prose(k, 80)))]
        assert own == [200 + k if k % 3 == 0 else None]
    assert all(t in texts for _, t in kept) and (3, edited(prose(405, 80), 1, 5)) in kept


def test_block_cells_count_each_pair_once(spark, monkeypatch):
    r = np.random.default_rng(5)
    base = r.integers(0, 1 << 62, 60).astype(np.uint64)
    sets = []
    for k in range(40):
        own = base.copy()
        own[r.integers(0, 60, k % 14)] = r.integers(0, 1 << 62, k % 14).astype(np.uint64)
        sets.append(np.unique(own))
    rows = [(k, 7, k % 3 + 1, bytearray(s.tobytes())) for k, s in enumerate(sets)]
    frame = spark.createDataFrame(rows, "id long, cluster long, weight long, items binary")
    near = [[a != b and len(np.intersect1d(x, y)) >= 0.8 * len(np.union1d(x, y)) for b, y in enumerate(sets)] for a, x in enumerate(sets)]
    want = {k: sum(b % 3 + 1 for b in range(40) if near[k][b]) for k in range(40)}
    for block in (512, 7):
        monkeypatch.setattr(links, "BLOCK", block)
        assert {x["id"]: x["links"] for x in links.linked(frame, 0.8).collect()} == want


def test_components_of_a_long_path(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 101), (101, 100), (200, 200)]
    found = links.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["root"] for r in found.collect()} == {k: 0 for k in range(61)} | {100: 100, 101: 100}


def test_runs_grow_with_recall():
    assert chosen_path.runs_for(0.9) < chosen_path.runs_for(0.99) < chosen_path.runs_for(0.9999)
