"""Quality rules as a short-circuit cascade, in Spark expressions only.

A rule is a SQL condition under which a document fails, written over named
measures of its text. On a sample every rule is timed by itself, and one
aggregation counts which sets of rules the sample's rows fail. The order is
greedy: next comes the rule that rejects most of what is left per unit of cost.
The cascade is one CASE in that order, so a document pays only for the rules up
to the first it fails. Order changes the cost, never the verdict.

Defined cases: a null text is an empty one, without words or lines, and ratios
over zero words or lines fail nothing; null and repeated ids are rows like any
other; an empty table keeps the given order of rules and gives an empty result.

At scale: a narrow pass without any shuffle. The sample's size is a parameter
and steers only the order.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

_SPLIT = r"filter(split({t}, '[\\x20\\x09-\\x0D]+'), x -> x != '')"
_LINES = r"filter(split({t}, '\\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')"

# Words in 3-word windows that occur twice or more: windows are hashed; only texts
# that repeat one sort them and add up the stretches their positions cover.
_REPEATS = """IF(size({w}) < 4, 0L, transform(array(
  transform(sequence(0, size({w}) - 3), i -> xxhash64({w}[i], {w}[i + 1], {w}[i + 2]))),
  h -> IF(size(array_distinct(h)) = size(h), 0L, transform(array(
    array_sort(transform(h, (x, i) -> named_struct('x', x, 'i', i)))),
    s -> aggregate(
      array_sort(transform(
        filter(s, (e, k) -> (k > 0 AND s[greatest(k - 1, 0)].x = e.x)
          OR (k < size(s) - 1 AND s[least(k + 1, size(s) - 1)].x = e.x)),
        e -> e.i)),
      named_struct('n', 0L, 'last', -3),
      (a, i) -> named_struct('n', a.n + least(3, i - a.last), 'last', i),
      a -> a.n))[0]))[0])"""

# Measures by name, over a text {t} and its words {w}.
MEASURES = {
    "n_words": "CAST(size({w}) AS LONG)",
    "word_chars": "CAST(length(array_join({w}, '')) AS LONG)",
    "n_symbols": r"CAST(regexp_count({t}, '[#*$%&|<>]') AS LONG)",
    "n_upper": r"CAST(regexp_count({t}, '\\p{{Lu}}') AS LONG)",
    "n_lines": f"CAST(size({_LINES}) AS LONG)",
    "n_dup_lines": f"transform(array({_LINES}), l -> CAST(size(l) - size(array_distinct(l)) AS LONG))[0]",
    "n_repeat_words": _REPEATS,
}


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over measures in braces, e.g. ``{n_words} < 50``."""

    name: str
    fails: str


BASE = (
    Rule("too_short", "{n_words} < 50"),
    Rule("repeats_itself", "100 * {n_repeat_words} > 50 * {n_words}"),
)
RULES = (
    Rule("symbols", "10 * {n_symbols} > {n_words}"),
    Rule("capitals", "10 * {n_upper} > 3 * {word_chars}"),
    Rule("copied_lines", "2 * {n_dup_lines} > {n_lines}"),
)


def _over(condition: str, known: dict[str, str], text: str, words: str) -> str:
    values = {m: known.get(m) or e.format(t=text, w=words) for m, e in MEASURES.items()}
    return condition.format(**values)


def _bound(text: str, body: str, known: dict[str, str] | None = None) -> str:
    """``body`` over measures, with the words split once: an expression of its own."""
    return f"transform(array({_SPLIT.format(t=text)}), w -> {_over(body, known or {}, text, 'w')})[0]"


def verdict(rules: tuple[Rule, ...], text: str = "coalesce(text, '')", known: dict[str, str] | None = None) -> str:
    """SQL for the name of the first rule failed, null if none."""
    if not rules:
        return "CAST(NULL AS STRING)"
    return _bound(text, "CASE " + " ".join(f"WHEN {r.fails} THEN '{r.name}'" for r in rules) + " END", known)


def measured(docs: DataFrame, *names: str, column: str = "m", text: str = "text") -> DataFrame:
    """The rows with a struct of measures added."""
    clean = f"coalesce({text}, '')"
    fields = ", ".join(f"'{n}', {MEASURES[n].format(t=clean, w='w')}" for n in names)
    return docs.withColumn(column, F.expr(f"transform(array({_SPLIT.format(t=clean)}), w -> named_struct({fields}))[0]"))


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    cost: float  # seconds over the sample
    rejects: float  # share of what the rules before it left


def ordered(docs: DataFrame, rules: tuple[Rule, ...] = BASE + RULES, *, text: str = "text",
            sample_rows: int = 2000, seed: int = 7) -> list[Estimate]:
    """The rules in order of rejection per cost, estimated on a seeded sample of rows."""
    total = docs.count()
    if not total or not rules:
        return [Estimate(r, 0.0, 0.0) for r in rules]
    share = min(1.0, sample_rows / total)
    some = docs.select(F.expr(f"coalesce({text}, '')").alias("text"))
    if share < 1:
        # by the number of the row as well: copies of a text are chosen one by one
        some = some.withColumn("row", F.monotonically_increasing_id())
        some = some.where(F.pmod(F.xxhash64("text", "row", F.lit(seed)), F.lit(1 << 40)) < int(share * (1 << 40))).drop("row")
    some = stored(some, "rule-sample")

    def seconds(condition: str) -> float:
        began = time.perf_counter()
        some.agg(F.count_if(F.expr(condition))).collect()
        return time.perf_counter() - began

    conditions = [_bound("text", r.fails) for r in rules]
    seconds("true")
    idle = seconds("true")
    costs = [max(min(seconds(c), seconds(c)) - idle, 1e-4) for c in conditions]
    # At most 2^rules rows, far fewer in practice.
    masks = some.select([F.expr(c).cast("int").alias(f"f{i}") for i, c in enumerate(conditions)]).groupBy(
        *[f"f{i}" for i in range(len(rules))]).count().collect()
    left, out, rest = list(masks), [], list(range(len(rules)))
    while rest:
        n = sum(m["count"] for m in left)
        hit = {i: sum(m["count"] for m in left if m[f"f{i}"] == 1) / n if n else 0.0 for i in rest}
        best = max(rest, key=lambda i: (hit[i] / costs[i], -costs[i], -i))
        out.append(Estimate(rules[best], costs[best], hit[best]))
        left = [m for m in left if m[f"f{best}"] != 1]
        rest.remove(best)
    return out


def kept(docs: DataFrame, rules: tuple[Rule, ...] = BASE + RULES, *, text: str = "text",
         sample_rows: int = 2000) -> DataFrame:
    """The rows that fail no rule, unchanged."""
    order = tuple(e.rule for e in ordered(docs, rules, text=text, sample_rows=sample_rows))
    return docs.where(F.expr(verdict(order, f"coalesce({text}, '')")).isNull())


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE, *,
           id: str = "doc_id", text: str = "text", sample_rows: int = 2000) -> DataFrame:
    """doc_id, measures, base_failed and kept: base rules first, then the cascade."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    order = tuple(e.rule for e in ordered(docs, rules, text=text, sample_rows=sample_rows))
    rows = measured(docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")), *names)
    known = {n: f"m.{n}" for n in names}
    failed = " OR ".join(_over(r.fails, known, "text", "") for r in base)
    rest = " ".join(f"WHEN {_over(r.fails, known, _TEXT, _SPLIT.format(t=_TEXT))} THEN false" for r in order)
    return rows.select("doc_id", *[F.col(f"m.{n}").alias(n) for n in names], F.expr(failed).alias("base_failed"),
                       F.expr(f"CASE WHEN {failed} THEN false {rest} ELSE true END").alias("kept"))


_TEXT = "coalesce(text, '')"

SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
windows AS (
  SELECT doc_id, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(3) AS r(k) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    len(l) AS n_lines, len(regexp_extract_all(t, '\p{Lu}')) AS n_upper
  FROM d LEFT JOIN covered c ON d.doc_id = c.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words
    OR 10 * n_upper > 3 * word_chars OR 2 * n_dup_lines > n_lines) AS kept
FROM m
"""
