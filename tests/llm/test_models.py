"""The trained operators: held-out quality on the given tables, odd rows, exact parts by brute force."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from llm_samples import make_docs, prose
from tidemark.llm import langid, nce_lm, quality_crf, toxicity
from tidemark.llm.chars import CharTexts, fold_table
from tidemark.llm.common import Words

BIG = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def big(spark):
    return spark.read.parquet(f"{BIG}/documents.parquet")


@pytest.fixture(scope="module")
def big_labels(spark):
    return spark.read.parquet(f"{BIG}/labels.parquet")


def held_out(i, modulus, remainder):
    return zlib.crc32(str(i).encode()) % modulus == remainder


def auc(pairs):
    pos, neg = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


def test_quality_on_held_out_documents(big, big_labels):
    model = quality_crf.fit(quality_crf.split_off(big), big_labels)
    label = {r["doc_id"]: r["quality"] for r in big_labels.collect()}
    rows = [r for r in quality_crf.score(big, model).collect() if held_out(r["doc_id"], 4, 2) and r["doc_id"] in label]
    assert auc([(r["score"], label[r["doc_id"]]) for r in rows]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    assert np.mean([r["predicted"] == label[r["doc_id"]] for r in rows]) > 0.95


def test_toxicity_on_held_out_documents(big, big_labels):
    model = toxicity.fit(toxicity.split_off(big), big_labels)
    label = {r["doc_id"]: r["toxic"] for r in big_labels.collect()}
    rows = [r for r in toxicity.score(big, model).collect() if held_out(r["doc_id"], 5, 0) and r["doc_id"] in label]
    assert auc([(r["score"], label[r["doc_id"]]) for r in rows]) > 0.85
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_held_out_documents(big):
    model = langid.fit(langid.split_off(big))
    lang = {r["doc_id"]: r["lang"] for r in big.select("doc_id", "lang").collect()}
    rows = [r for r in langid.predict(big, model).collect() if held_out(r["doc_id"], 3, 1)]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in rows]) > 0.98
    assert np.mean([r["accepted"] for r in rows]) > 0.9


def test_scoring_odd_rows(odd, none, odd_rows, big, big_labels):
    quality = quality_crf.fit(big, big_labels)
    toxic = toxicity.fit(big, big_labels, max_rows=200)
    languages = langid.fit(big, max_texts=20)
    for df in (quality_crf.score(odd, quality), toxicity.score(odd, toxic)):
        assert all(0 <= r["score"] <= 1 for r in df.collect()) and df.count() == len(odd_rows)
    empty = [r["score"] for r in quality_crf.score(odd, quality).collect() if r["doc_id"] in (4, 5, 6)]
    assert empty == [pytest.approx(quality.prior)] * 3
    found = {r["doc_id"]: r for r in langid.predict(odd, languages).collect()}
    assert all(found[k]["lang_pred"] == "und" and not found[k]["score"] and not found[k]["accepted"] for k in (4, 5, 6, 9))
    assert all(found[k]["lang_pred"] in languages.languages for k in (1, 7, 8, 10))
    assert quality_crf.good(odd, quality).columns == odd.columns
    assert [f(none, m).count() for f, m in ((quality_crf.score, quality), (quality_crf.good, quality), (toxicity.score, toxic), (langid.predict, languages))] == [0] * 4


def test_nothing_to_learn_from(spark, odd, none, odd_rows):
    no_labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one_class = spark.createDataFrame([(1, 1, 1), (2, 1, 1), (77, 0, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality_crf.score(odd, quality_crf.fit(odd, no_labels)).collect()} == {0.5}
    assert all(r["score"] > 0.99 for r in quality_crf.score(odd, quality_crf.fit(odd, one_class)).collect())
    assert all(r["score"] < 0.01 for r in toxicity.score(odd, toxicity.fit(odd, no_labels)).collect())
    assert all(r["score"] > 0.99 for r in toxicity.score(odd, toxicity.fit(odd, one_class)).collect())
    assert langid.fit(none) is None
    assert {r["lang_pred"] for r in langid.predict(odd, None).collect()} == {"und"}
    counts, total, distinct, model = nce_lm.fit(none)
    rows = nce_lm.score(odd, counts, total, distinct, model).collect()
    assert (total, distinct, model) == (0, 0, None) and {r["score"] for r in rows} == {0.0} and len(rows) == len(odd_rows)


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def test_language_model_counts_are_exact(spark, odd, odd_rows, documents):
    docs = documents.select("doc_id", "text")
    train, scored = [tokens(r["text"]) for r in docs.collect()], odd
    counts, total, distinct, model = nce_lm.fit(docs)
    c = Counter(t for text in train for t in text)
    assert (total, distinct) == (sum(c.values()), len(c))
    want = sorted((len(tokens(t)), sum(w in c for w in tokens(t)), round(sum(math.log10((c[w] + 1) / (total + distinct + 1)) for w in tokens(t)), 6)) for _, t, _, _ in odd_rows)
    got = sorted((r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in nce_lm.score(scored, counts, total, distinct, model).collect())
    assert got == want
    rows = nce_lm.score(docs, counts, total, distinct, model).collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_language_model_is_normalised(documents):
    _, total, distinct, model = nce_lm.fit(documents.limit(50), frequent=40)
    n = len(model.classes)
    for one, two in ((n, n), (0, 3), (5, n)):
        logs = model.log10_classes(np.arange(n), np.full(n, one), np.full(n, two))
        assert (10.0**logs).sum() == pytest.approx(1)
    # words of a class: their add-one shares and one unknown
    assert model.classes.total.sum() == total and model.classes.distinct.sum() == distinct


def test_language_model_scores_by_enumeration(spark, documents):
    """Scores of texts, token by token: class by a plain softmax over the two classes before, word by add-one shares in its class."""
    docs = documents.select("doc_id", "text").limit(60)
    counts, total, distinct, model = nce_lm.fit(docs, frequent=30)
    p, n = model.parameters, len(model.classes)
    held = {r["word"]: r["n"] for r in counts.collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.limit(15).collect()} | {-1: "never seen words here", -2: "", -3: None}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for row in nce_lm.score(frame, counts, total, distinct, model).collect():
        words = nce_lm.Words([texts[row["doc_id"]]], lower=True)
        kinds = [*model.classes.of(words.hash, nce_lm.endings(words)).tolist(), 0]
        hashes, want = [*words.hash.view(np.int64).tolist(), nce_lm.END], 0.0
        for k, (c, h) in enumerate(zip(kinds, hashes)):
            one, two = kinds[k - 1] if k > 0 else n, kinds[k - 2] if k > 1 else n
            score = (p.one[one] + p.two[two]).astype(float) @ p.out.T.astype(float) + p.bias
            want += score[c] - np.log(np.exp(score).sum())
            if c > len(model.classes.words):
                want += np.log((held.get(h, 0) + 1) / (model.classes.total[c] + model.classes.distinct[c] + 1))
        assert row["score"] == pytest.approx(want / np.log(10), abs=0.01 + 1e-4 * len(kinds))


def test_language_model_does_not_depend_on_the_number_of_tasks(spark):
    """Held-out gain over the base with 1, 8 and 64 partitions."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    gains = []
    for n in (1, 8, 64):
        own = docs.repartition(n)
        counts, total, distinct, model = nce_lm.fit(nce_lm.split_off(own))
        held = nce_lm.score(own, counts, total, distinct, model).where("crc32(cast(doc_id as string)) % 7 = 2")
        gains.append(held.selectExpr("(sum(score) - sum(base_score)) / sum(n_tokens)").first()[0])
    assert min(gains) > 0.06 and max(gains) - min(gains) < 0.05 * max(gains)


def test_contexts_stay_within_texts():
    one, two = nce_lm.before(np.array([5, 6, 0, 0, 7, 8, 9, 0]), 99)
    assert one.tolist() == [99, 5, 6, 99, 99, 7, 8, 9] and two.tolist() == [99, 99, 5, 99, 99, 99, 7, 8]


def test_walk_follows_the_slopes_of_the_loss():
    """One batch moves every touched parameter against the plain derivative of the estimation loss."""
    r = np.random.default_rng(4)
    n, codes = 6, np.array([3, 1, 4, 0, 2, 2, 5, 0])
    share = np.full(n, 1 / n)
    p = [r.normal(0, 0.3, (rows, nce_lm.WIDTH)).astype(np.float32) for rows in (n + 1, n + 1, n)] + [np.zeros((n, 1), np.float32)]
    noise = np.minimum(np.searchsorted(np.cumsum(share), np.random.default_rng(8).random(nce_lm.NOISE)), n - 1)
    one, two = nce_lm.before(codes, n)

    def loss(q):
        shift, context, total = np.log(nce_lm.NOISE) + np.log(share), q[0][one] + q[1][two], 0.0
        for h, w in zip(context, codes):
            total += np.log1p(np.exp(-(h @ q[2][w] + q[3][w, 0] - shift[w])))
            total += np.log1p(np.exp(q[2][noise] @ h + q[3][noise, 0] - shift[noise])).sum()
        return total / len(codes)

    start = [x.astype(float) for x in p]
    nce_lm._walk(codes, p, [np.full_like(x, 1e-6) for x in p], share, np.random.default_rng(8))
    for k, at in ((0, (3, 2)), (1, (3, 5)), (2, (4, 1)), (2, (0, 7)), (3, (5, 0))):
        moved = [x.copy() for x in start]
        moved[k][at] += 1e-4
        slope = (loss(moved) - loss(start)) / 1e-4
        want = -nce_lm.RATE * slope / np.sqrt(1e-6 + slope * slope)
        assert p[k][at] - start[k][at] == pytest.approx(want, abs=2e-4)


def test_chain_marginals_by_enumeration():
    r = np.random.default_rng(2)
    doc = np.array([0, 0, 0, 0, 1, 2, 2])
    unary, link = r.normal(size=(7, 2)), r.normal(size=(2, 2))
    p, pairs, z = quality_crf.Chains.of(doc).marginals(unary, link)
    want, want_pairs, log_z = np.zeros((7, 2)), np.zeros((2, 2)), 0.0
    for d in range(3):
        at = np.flatnonzero(doc == d)
        weights = {}
        for code in range(2 ** len(at)):
            y = [(code >> k) & 1 for k in range(len(at))]
            weights[tuple(y)] = math.exp(sum(unary[i, b] for i, b in zip(at, y)) + sum(link[a, b] for a, b in zip(y, y[1:])))
        total = sum(weights.values())
        log_z += math.log(total)
        for y, w in weights.items():
            for i, b in zip(at, y):
                want[i, b] += w / total
            for a, b in zip(y, y[1:]):
                want_pairs[a, b] += w / total
    assert np.allclose(p, want) and np.allclose(pairs, want_pairs) and z == pytest.approx(log_z)


def test_language_models_sum_to_one():
    table = fold_table(letters_only=True)
    texts = [prose(1, 200), prose(2, 150)]
    counts = []
    for t in texts:
        keys, n = np.unique(langid.grams(CharTexts([t], table)), return_counts=True)
        counts.append(dict(zip(keys.tolist(), n.tolist())))
    alphabet = np.unique(np.concatenate([CharTexts([t], table).codes for t in texts])).astype(np.int64)
    model = langid.Model(["a", "b"], *langid.build(counts, len(alphabet)), np.zeros(2), np.ones(2))
    for history in (0x20 << 28 | 0x20 << 14 | 0x20, 0x61 << 28 | 0x20 << 14 | 0x74, 0x7A << 28 | 0x7A << 14 | 0x7A):
        total = np.exp(model.log_probabilities((history << 14) | alphabet)).sum(0)
        assert np.allclose(total + np.exp(model.log_probabilities(np.array([(history << 14) | 0x3FF]))[0]), 1, atol=0.02)


def test_words_are_split_and_hashed_alike():
    texts = ["a bb  ccc", "", "\x0b x\ty \n", "bb", None, "é 中文"]
    words = Words(texts)
    assert words.counts.tolist() == [3, 0, 2, 1, 0, 2]
    assert [bytes(words.data[a:b]) for a, b in zip(words.start, words.end)] == ["a".encode(), b"bb", b"ccc", b"x", b"y", b"bb", "é".encode(), "中文".encode()]
    assert words.hash[1] == words.hash[5] and len(set(words.hash.tolist())) == 7
    assert Words(["A ß"], lower=True).hash[0] == Words(["a"]).hash[0]


def test_repeated_label_rows_do_not_repeat_documents(spark):
    docs = make_docs(spark, [(k, prose(k, 30) if k % 2 else "## " * 40, "en", "s") for k in range(20)])
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(20)] * 3, "doc_id long, quality int, toxic int")
    model = quality_crf.fit(docs, labels)
    assert [r["predicted"] for r in quality_crf.score(docs, model).orderBy("doc_id").collect()] == [k % 2 for k in range(20)]


MARKS = ["\u2014 \u2014\u2014", "\u2026\u2026", "\u201c\u201d \u2018\u2019", "\u2022 \u2022", "\u200b\u200d\ufeff", "\U0001f600 \U0001f680\ufe0f", "\u3002\u300c\u300d", "\u2003\u3000"]


def test_marks_beyond_the_first_scripts_are_no_letters(spark):
    chars = CharTexts(MARKS, fold_table(letters_only=True))
    assert not chars.letters().any()
    # letters keep 14 bits; case is folded; kana and the basic Han letters next to each other differ
    table = fold_table(letters_only=True)
    assert len(table) == 0x110000 and table.max() < 1 << langid.BITS
    assert table[0xFF21] == table[0xFF41] and len(set(table[0x3041:0x3097].tolist())) == 0x3097 - 0x3041
    # three languages without blanks between words, that have no letter in common
    han, kana, hangul = ("".join(chr(lo + (7 * k * k + 3 * k) % n) for k in range(400)) for lo, n in ((0x4E00, 300), (0x3041, 80), (0xAC00, 300)))
    rows = [(10 * j + k, t[20 * k : 20 * k + 60], name, "s") for j, (name, t) in enumerate((("zh", han), ("ja", kana), ("ko", hangul))) for k in range(10)]
    model = langid.fit(make_docs(spark, rows))
    odd = [(100 + k, t, None, "s") for k, t in enumerate(MARKS)] + [(200, han[100:150] + "\u3002\u2014", None, "s"), (201, kana[100:150], None, "s"), (202, hangul[100:150] + "\u2026", None, "s")]
    found = {r["doc_id"]: r for r in langid.predict(make_docs(spark, odd), model).collect()}
    for k in range(len(MARKS)):
        assert (found[100 + k]["lang_pred"], found[100 + k]["score"], found[100 + k]["accepted"]) == ("und", 0.0, False)
    assert [found[k]["lang_pred"] for k in (200, 201, 202)] == ["zh", "ja", "ko"]


def test_samples_take_copies_one_by_one(spark):
    """A language whose texts are one text: a sample of it is neither empty nor all of it."""
    rows = [(k, prose(1, 60), "aa", "s") for k in range(400)] + [(k, prose(k, 60), "bb", "s") for k in range(400, 480)]
    model = langid.fit(make_docs(spark, rows), max_texts=60)
    assert model.languages == ["aa", "bb"] and np.isfinite(model.mean).all()
    held = {r["lang_pred"] for r in langid.predict(make_docs(spark, rows[:3]), model).collect()}
    assert held == {"aa"}


def test_ratios_and_counts_by_hand(spark):
    """Every feature's weight starts from the log ratio of its add-one shares; scores are the logistic of their sum."""
    texts = {k: ("vile curs " if k % 3 == 0 else "kind word ") + prose(k, 8) for k in range(60)}
    docs = make_docs(spark, [(k, t, "en", "s") for k, t in texts.items()])
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in texts], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    table, ids = toxicity.fold_table(), list(texts)
    held = {}
    for doc, bucket in toxicity.presence([texts[k] for k in ids], table, None):
        for d, b in zip(doc.tolist(), bucket.tolist()):
            held.setdefault(b, [0, 0])[int(ids[d] % 3 == 0)] += 1
    n = [sum(k % 3 != 0 for k in ids), sum(k % 3 == 0 for k in ids)]
    want = set()
    for b, (clean, toxic) in held.items():
        ratio = math.log((toxic + 1) / (n[1] + 2) / ((clean + 1) / (n[0] + 2)))
        if clean + toxic >= toxicity.MIN_TEXTS and abs(ratio) >= max(toxicity.MIN_RATIO, toxicity.MIN_Z * math.sqrt(1 / (clean + 1) + 1 / (toxic + 1))):
            want.add(b)
    assert set(np.flatnonzero(model.feature).tolist()) == want and want
    for r in toxicity.score(docs.limit(10), model).collect():
        features = {int(model.feature[b]) for _, bucket in toxicity.presence([texts[r["doc_id"]]], table, None) for b in bucket.tolist()} - {0}
        z = model.bias + sum(model.weight[f] for f in features)
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)
