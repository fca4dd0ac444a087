import re
from collections import Counter

from llm_samples import make_docs, prose
from pyspark.sql import functions as F

from tidemark.llm import rules


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    times = Counter(grams)
    again = {k + j for k, g in enumerate(grams) if times[g] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    base = len(w) < 50 or 100 * len(again) > 50 * len(w)
    upper = sum(c.isupper() for c in text or "")
    kept = not (base or 10 * symbols > len(w) or 10 * upper > 3 * sum(map(len, w)) or 2 * (len(lines) - len(set(lines))) > len(lines))
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(again), base, kept


def as_tuples(df):
    return sorted(tuple(r)[1:] for r in df.collect())


def test_measures_and_verdict(spark, odd, odd_rows):
    more = [(20, "a b c " * 40, "en", "s"), (21, "x y z a b x y z", "en", "s"), (22, prose(5, 80).upper(), "en", "s"),
            (23, "### " + prose(6, 60).replace(" ", "# "), "en", "s"), (24, (prose(7, 60, 20) + "\n") * 2, "en", "s"), (25, "a a a a", "en", "s")]
    rows = odd_rows + more
    assert as_tuples(rules.judged(make_docs(spark, rows))) == sorted(brute(t) for _, t, _, _ in rows)


def test_cascade_keeps_what_no_rule_fails(odd, none, odd_rows, documents):
    kept = rules.kept(odd)
    assert kept.columns == odd.columns
    assert sorted(r["text"] for r in kept.collect()) == sorted(t for _, t, _, _ in odd_rows if brute(t)[-1])
    assert rules.kept(none).count() == 0 and rules.judged(none).count() == 0
    order = rules.ordered(documents)
    assert {e.rule for e in order} == {*rules.BASE, *rules.RULES}
    reordered = tuple(e.rule for e in order[::-1])
    assert documents.where(rules.verdict(reordered) + " IS NULL").count() == rules.kept(documents).count()
    assert rules.kept(documents, ()).count() == documents.count()


def test_no_python_in_the_plan(documents):
    plan = rules.judged(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_sample_of_copies_is_neither_empty_nor_everything(spark):
    docs = make_docs(spark, [(k, prose(1, 70), "en", "s") for k in range(3000)])
    some = docs.withColumn("row", F.monotonically_increasing_id())
    assert {e.rule for e in rules.ordered(docs, sample_rows=100)} == {*rules.BASE, *rules.RULES}
    share = some.where(F.pmod(F.xxhash64("text", "row", F.lit(7)), F.lit(1 << 40)) < int(100 / 3000 * (1 << 40))).count()
    assert 40 < share < 200
