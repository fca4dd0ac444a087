"""Merkle manifest: against a plain recursive build, and trees grown in pieces."""

import hashlib
import zlib

import pytest
from llm_samples import make_docs

from tidemark.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(leaves):
    """(root, siblings and sides of every leaf), level by level."""
    paths, level, where = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, p in enumerate(where):
            q = p ^ 1
            paths[i].append(("L" if p % 2 else "R") + level[q] if q < len(level) else "-")
        where = [p // 2 for p in where]
        level = [sha("".join(level[k : k + 2])) for k in range(0, len(level), 2)]
    return level[0], paths


def plain_manifest(rows):
    leaf = lambda *v: sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in v))
    groups = {}
    for i, t, lang, s, n in rows:
        bad = i is not None and zlib.crc32(str(i).encode()) % 7 == 0 and n is not None
        groups.setdefault(lang, []).append((i, leaf(i, s, lang, n, t), leaf(i, s, lang, n + bad if n is not None else None, t)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in order:
        members = sorted(groups[g], key=lambda m: (m[0] is not None, m[0] or 0, m[1]))
        trees.append((members, *plain_tree([m[1] for m in members])))
    root, above = plain_tree([t[1] for t in trees])
    out = []
    for (members, sub, paths), upper in zip(trees, above):
        for (i, own, offered), path in zip(members, paths):
            whole, now = path + upper, offered
            for step in whole:
                now = sha(now) if step == "-" else sha(step[1:] + now if step[0] == "L" else now + step[1:])
            out.append((i, own, sub, root, sha("".join(s[1:] for s in whole)), now, now == root))
    return sorted(out, key=str)


def digests(docs, bits=merkle.BITS):
    return sorted((tuple(r) for r in merkle.tampered_digests(docs, bits).collect()), key=str)


@pytest.mark.parametrize("bits", [1, 3, 12])
def test_equals_a_plain_build_with_odd_rows_at_any_block_size(spark, odd, odd_rows, bits):
    rows = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in odd_rows]
    assert digests(odd, bits) == plain_manifest(rows)


def test_hot_group_of_copies_and_null_ids(spark):
    rows = [(None, "same", "en", "s")] * 300 + [(k, f"text {k}", "de" if k % 3 else None, "s") for k in range(200)] + [(7, "x", "one", "s")]
    docs = make_docs(spark, rows).repartition(5)
    assert digests(docs, 4) == plain_manifest([(i, t, g, s, len(t)) for i, t, g, s in rows])


def test_layout_does_not_matter(spark, documents):
    assert digests(documents.repartition(7)) == digests(documents.coalesce(1))


def test_one_row_and_no_row(spark, none):
    one = digests(make_docs(spark, [(1, "a", "en", "s")]))
    assert one == plain_manifest([(1, "a", "en", "s", 1)]) and one[0][1] == one[0][2] == one[0][3]
    assert merkle.tampered_digests(none).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 21])
def test_appending_extends_witnesses(n):
    leaves = [sha(str(k)).encode() for k in range(n)]
    tree = merkle.Appender(n, 6)
    for k, x in enumerate(leaves):
        tree.append(x)
        # what is complete so far already leads to the roots of the open subtrees
        for _, a, b, root in tree.open:
            assert all(merkle.fold(leaves[i], tree.witnesses()[i]) == root for i in range(a, b))
    root, paths = plain_tree([x.decode() for x in leaves])
    assert tree.close().decode() == root
    assert [w.decode() for w in tree.witnesses()] == ["".join(p) for p in paths]
    assert all(merkle.fold(x, w).decode() == root for x, w in zip(leaves, tree.witnesses()))
    assert merkle.fold(sha("other").encode(), tree.witnesses()[0]).decode() != root
