"""Language identification by character models with interpolated Kneser-Ney smoothing.

One model of order 4 per language, over case-folded letters and blanks (everything
that is no letter is a blank). An n-gram is packed into 14 bits a character: letters
below U+2000 have codes of their own, the others (Han, kana, Hangul, ...) share 8192
by a hash; per order the sorted keys of all languages stand in one array, with
a column of log probabilities for each language and, for contexts, of log
back-off weights. Scoring is binary search for whole batches of characters. The
language with the lowest cross-entropy per character wins; a text whose entropy
is out of line with what the language's own texts have is not accepted.

Learned from at most ``max_texts`` texts per language (a parameter; chosen by hash,
all of them where there are fewer). N-grams are counted by Spark tasks; the driver
builds the arrays from one row per language and n-gram of that sample.

Defined cases: a text without letters, empty or null, is ``und`` with score 0; so is
every text if nothing could be learned; null languages are not learned from; ties
go to the language first by code point; repeated rows are scored each; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chars import CharTexts, fold_table
from tidemark.llm.common import id_remainder, stored, text_of

ORDER = 4
BITS = 14
MAX_TEXTS = 1500
CHUNK = 1 << 19
UNKNOWN = "und"


def _fields(n: int) -> int:
    return (1 << (BITS * n)) - 1


def grams(chars: CharTexts) -> np.ndarray:
    """Key of the ORDER characters that end at each place; blanks stand before a text."""
    code, doc = chars.codes.astype(np.int64), chars.doc
    out = code.copy()
    for k in range(1, ORDER):
        back = np.full(len(code), 32, np.int64)
        back[k:] = np.where(doc[k:] == doc[:-k], code[:-k], 32)
        out |= back << (BITS * k)
    return out


@dataclass(frozen=True)
class Model:
    languages: list[str]
    keys: list[np.ndarray]  # by order - 1: sorted n-grams
    logp: list[np.ndarray]  # n-grams x languages
    contexts: list[np.ndarray]  # by order - 1: sorted contexts
    backoff: list[np.ndarray]  # contexts x languages
    floor: float  # log probability of a character no language has seen
    mean: np.ndarray  # cross-entropy of a language's own texts
    spread: np.ndarray

    def log_probabilities(self, key: np.ndarray) -> np.ndarray:
        return _lookup(key, ORDER, self.keys, self.logp, self.contexts, self.backoff, self.floor, len(self.languages))


def _find(sorted_: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(sorted_, key), max(len(sorted_) - 1, 0))
    return at, (sorted_[at] == key) if len(sorted_) else np.zeros(len(key), bool)


def _lookup(key, order, keys, logp, contexts, backoff, floor, n_languages) -> np.ndarray:
    """Log probability of each key's last character given the ones before, per language."""
    if order == 0:
        return np.full((len(key), n_languages), floor, np.float32)
    at, hit = _find(keys[order - 1], key)
    if hit.all() and len(key):
        return logp[order - 1][at]
    out = np.empty((len(key), n_languages), np.float32)
    out[hit] = logp[order - 1][at[hit]]
    rest = key[~hit]
    low = _lookup(rest & _fields(order - 1), order - 1, keys, logp, contexts, backoff, floor, n_languages)
    at, known = _find(contexts[order - 1], rest >> BITS)
    low[known] += backoff[order - 1][at[known]]
    out[~hit] = low
    return out


def build(counts: list[dict[int, int]], n_codes: int) -> tuple[list, list, list, list, float]:
    """Arrays of the interpolated Kneser-Ney models, one per language, from ORDER-gram counts."""
    n_languages, floor = len(counts), float(-np.log(n_codes + 1))
    level: list[tuple[np.ndarray, np.ndarray]] = []
    for own in counts:
        k = np.fromiter(own, np.int64, len(own))
        c = np.fromiter(own.values(), np.int64, len(own))
        by_key = np.argsort(k)
        level.append((k[by_key], c[by_key]))
    levels = [level]
    for n in range(ORDER - 1, 0, -1):  # continuation counts: in how many longer n-grams a shorter one ends
        level = [np.unique(k & _fields(n), return_counts=True) for k, _ in level]
        levels.insert(0, level)
    keys, logp, contexts, backoff = [], [], [], []
    for n, level in enumerate(levels, 1):
        union = np.unique(np.concatenate([k for k, _ in level]))
        contexts_n = np.unique(union >> BITS)
        low = np.exp(_lookup(union & _fields(n - 1), n - 1, keys, logp, contexts, backoff, floor, n_languages).astype(float))
        p, weight = np.empty((len(union), n_languages)), np.ones((len(contexts_n), n_languages))
        for j, (k, c) in enumerate(level):
            once, twice = (c == 1).sum(), (c == 2).sum()
            cut = once / (once + 2 * twice) if once and twice else 0.5
            place = np.searchsorted(contexts_n, k >> BITS)
            total = np.bincount(place, weights=c, minlength=len(contexts_n))
            taken = np.bincount(place, weights=np.minimum(c, cut), minlength=len(contexts_n))
            seen = total > 0
            weight[seen, j] = np.maximum(taken[seen] / total[seen], 1e-9)
            at, hit = _find(k, union)
            context = np.searchsorted(contexts_n, union >> BITS)
            own = np.where(hit, np.maximum(c[at] - cut, 0), 0) if len(k) else np.zeros(len(union))
            p[:, j] = own / np.maximum(total[context], 1) + weight[context, j] * low[:, j]
        keys.append(union)
        logp.append(np.log(p).astype(np.float32))
        contexts.append(contexts_n)
        backoff.append(np.log(weight).astype(np.float32))
    return keys, logp, contexts, backoff, floor


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    at, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t or "") + 1
        if size >= CHUNK:
            yield at, texts[at : k + 1]
            at, size = k + 1, 0
    if at < len(texts):
        yield at, texts[at:]


def entropies(model: Model, texts: list[str | None], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cross-entropy per character and language, characters, letters of each text."""
    total = np.zeros((len(texts), len(model.languages)))
    size, letters = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for base, some in _chunks(texts):
        chars = CharTexts(some, table)
        own = slice(base, base + len(some))
        letters[own] = chars.letters()
        logp = model.log_probabilities(grams(chars))
        size[own] = np.bincount(chars.doc, minlength=len(some))
        for j in range(len(model.languages)):
            total[own, j] = np.bincount(chars.doc, weights=logp[:, j], minlength=len(some))
    return -total / np.maximum(size, 1)[:, None], size, letters


def fit(docs: DataFrame, *, text: str = "text", lang: str = "lang", max_texts: int = MAX_TEXTS, seed: int = 5) -> Model | None:
    """A model from the rows given (held-out ones must be gone already)."""
    rows = docs.select(text_of(text).alias("text"), F.col(lang).cast("string").alias("lang"), F.monotonically_increasing_id().alias("row")).where(
        "lang IS NOT NULL AND text != ''")
    totals = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not totals:
        return None
    shares = docs.sparkSession.createDataFrame([(k, min(1.0, max_texts / n)) for k, n in totals.items()], "of_lang string, share double")
    # one row per language on the right
    # by text and number of the row: copies of a text are chosen one by one
    rows = rows.join(F.broadcast(shares), F.col("lang") == F.col("of_lang")).where(
        F.pmod(F.xxhash64("text", "row", F.lit(seed)), F.lit(1 << 30)) < F.col("share") * (1 << 30))
    sample = stored(rows.select("lang", "text"), "lang-sample")
    languages = sorted(totals)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = fold_table(letters_only=True)  # built once in each worker
        for batch in batches:
            names = batch.column(0).to_pylist()
            texts = batch.column(1).to_pylist()
            for name in sorted(set(names)):
                own = [t for t, x in zip(texts, names) if x == name]
                for _, some in _chunks(own):
                    key, n = np.unique(grams(CharTexts(some, table)), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(key)), pa.array(key), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    counted = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    names, gram, n = counted.column("lang").to_numpy(), counted.column("gram").to_numpy(), counted.column("n").to_numpy()
    counts = [dict(zip(gram[names == x].tolist(), n[names == x].tolist())) for x in languages]
    n_codes = len(np.unique(gram & _fields(1)))
    arrays = build(counts, n_codes)
    model = Model(languages, *arrays, np.zeros(len(languages)), np.ones(len(languages)))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def own_entropy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = fold_table(letters_only=True)
        for batch in batches:
            h, size, letters = entropies(shared.value, batch.column(1).to_pylist(), table)
            at = [languages.index(x) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(h[np.arange(len(at)), at]), pa.array(letters)], ["lang", "h", "letters"])

    own = {r["lang"]: r for r in sample.mapInArrow(own_entropy, "lang string, h double, letters long").where("letters >= 20").groupBy("lang").agg(
        F.avg("h").alias("mean"), F.coalesce(F.stddev_pop("h"), F.lit(0.0)).alias("spread")).collect()}
    mean = np.array([own[x]["mean"] if x in own else np.inf for x in languages])
    spread = np.array([own[x]["spread"] if x in own else 1.0 for x in languages])
    return Model(languages, *arrays, mean, spread)


def predict(docs: DataFrame, model: Model | None, *, id: str = "doc_id", text: str = "text", limit: float = 6.0) -> DataFrame:
    """doc_id, lang_pred, score, entropy, accepted.

    ``score`` is the winner's share of the likelihoods per 10 characters. ``accepted``
    is false for ``und`` and where the entropy lies more than ``limit`` spreads
    above the mean of the language's own texts; short texts get more room.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "lang_pred", "score", "entropy", "accepted"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, table = shared.value, fold_table(letters_only=True)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            if m is None:
                n = len(texts)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([UNKNOWN] * n), pa.array([0.0] * n), pa.array([None] * n, pa.float64()), pa.array([False] * n)], names)
                continue
            h, size, letters = entropies(m, texts, table)
            best = h.argmin(1)
            low = h[np.arange(len(h)), best]
            share = 1 / np.exp(-(h - low[:, None]) * 10).sum(1)
            room = limit * m.spread[best] + 2.5 / np.sqrt(np.maximum(size, 1))
            some = letters > 0
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([m.languages[b] if s else UNKNOWN for b, s in zip(best, some)]),
                pa.array(np.where(some, share, 0.0)), pa.array(low, mask=~some), pa.array(some & (low <= m.mean[best] + room))], names)

    return docs.select(F.col(id).cast("long").alias("doc_id"), text_of(text).alias("text")).mapInArrow(
        run, "doc_id long, lang_pred string, score double, entropy double, accepted boolean")


def split_off(docs: DataFrame, id: str = "doc_id", modulus: int = 3, remainder: int = 1) -> DataFrame:
    """The rows that may be learned from."""
    return docs.where(id_remainder(id, modulus) != remainder)
