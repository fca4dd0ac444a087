"""A log-bilinear language model trained by noise-contrastive estimation.

Tokens are words in lower case (A to Z only) and one end per text. The frequent
words and the end are classes of their own, all other words fall into classes by
their last letters. The model predicts a token's class from the classes of the two
tokens before it: score(w) = q_w . (r1[c1] + r2[c2]) + b_w, and a word within its
class by its add-one frequency there, with one unknown word per class. It is trained
in numpy against noise from the class frequencies, shared by a batch. The normaliser
of two classes before is a sum of products, so one matrix product gives it for all contexts:
exp(r1 q' + b) times exp(r2 q') transposed.

Every training text is counted, and trained on once, in ``ROUNDS`` rounds: the texts are dealt
into parts of about ``TASK_TOKENS`` tokens, a round takes an equal share of the parts, each part is walked from
the round's common start, and the results, averaged by tokens, start the next round. The first
start has zero-mean vectors and class log-frequencies as biases. So the sequence of
updates behind the model does not depend on files, tasks or cores.

The number of frequent words grows with the vocabulary, up to ``MAX_FREQUENT``: the
normalisers of all contexts must fit a task.

Defined cases: a null text is an empty one, only its end; null ids are learned from;
with nothing to learn from all scores are 0 (N = V = 0); words are told apart by 64 bits
of hash; repeated rows are counted and scored each; an empty table gives an empty
result; other columns are ignored.

At scale: counts are aggregated by word over all tasks, and no task or driver ever
holds the vocabulary. Texts are dealt once into buckets of bounded size, and each
bucket is joined with the counts of its own words only. The driver sees the
frequent words, one row per class and the averaged parameters. For training a token is the
two bytes of its class.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import _IS_MARK, Words, id_remainder, stored, text_of
from tidemark.session import work_dir

MAX_FREQUENT = 1791  # words with classes of their own, besides the end
MIN_FREQUENT = 255
WORDS_PER_CLASS = 64  # different words of the vocabulary to a frequent one
ENDINGS = 256  # classes of all other words
WIDTH = 16
NOISE = 64
BATCH = 8192
RATE = 0.05
ROUNDS = 6
TASK_TOKENS = 1 << 20
CHUNK = 1 << 20
BUCKET_CHARS = 1 << 25
LEAST_CHARS = 1 << 21
END = 0


@dataclass(frozen=True)
class Classes:
    words: np.ndarray  # sorted hashes of the frequent words
    total: np.ndarray  # training tokens per class
    distinct: np.ndarray  # distinct words per class

    def __len__(self) -> int:
        return len(self.words) + 1 + ENDINGS

    def of(self, h: np.ndarray, ending: np.ndarray) -> np.ndarray:
        """0 the end, then the frequent words, then endings."""
        at = np.minimum(np.searchsorted(self.words, h), max(len(self.words) - 1, 0))
        known = self.words[at] == h if len(self.words) else np.zeros(len(h), bool)
        return np.where(known, at + 1, ending + len(self.words) + 1)


@dataclass
class Parameters:
    one: np.ndarray  # vectors of the class before, the last row for none
    two: np.ndarray  # of the class before that
    out: np.ndarray
    bias: np.ndarray

    @staticmethod
    def start(log_share: np.ndarray, seed: int = 1) -> Parameters:
        rng, n = np.random.default_rng(seed), len(log_share)
        draw = lambda rows: rng.normal(0, 0.1, (rows, WIDTH)).astype(np.float32)
        return Parameters(draw(n + 1), draw(n + 1), draw(n), log_share.astype(np.float32))


def endings(words: Words) -> np.ndarray:
    """Class of each word's last three bytes, marks at its end left out."""
    data, start, end = words.data, words.start, words.end.copy()
    for _ in range(4):
        end -= (end - 1 > start) & _IS_MARK[data[end - 1]]
    code = np.zeros(len(end), np.int64)
    for k in (1, 2, 3):
        code = code * 257 + np.where(end - k >= start, data[np.maximum(end - k, 0)], 256)
    return (code * 2654435761 >> 11) % ENDINGS


def with_ends(words: Words, values: np.ndarray, end: int) -> np.ndarray:
    """A value per word, and one for the end of each text."""
    return np.insert(values, words.first[1:], end)


def _chunks(texts: list[str]) -> Iterator[tuple[int, Words]]:
    at, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t) + 1
        if size >= CHUNK or k == len(texts) - 1:
            yield at, Words(texts[at : k + 1], lower=True)
            at, size = k + 1, 0


def _texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[list[str]]:
    """Texts of several small batches at a time."""
    held: list[str] = []
    size = 0
    for b in batches:
        for t in b.column(column).to_pylist():
            held.append(t)
            size += len(t)
            if size >= CHUNK:
                yield held
                held, size = [], 0
    if held:
        yield held


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to rows (word, ending, tokens)."""
    for texts in _texts(batches, 0):
        for _, words in _chunks(texts):
            h, first, n = np.unique(words.hash, return_index=True, return_counts=True)
            ending = endings(words)[first] if len(first) else np.zeros(0, np.int64)
            h, ending, n = np.append(h, np.uint64(END)), np.append(ending, 0), np.append(n, words.n_docs)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(ending.astype(np.int32)), pa.array(n.astype(np.int64))],
                                             ["word", "ending", "n"])


def _add_rows(grad: np.ndarray, into: np.ndarray, n: int) -> np.ndarray:
    """Sum of gradient rows per parameter row."""
    order = np.argsort(into, kind="stable")
    rows, first = np.unique(into[order], return_index=True)
    out = np.zeros((n, grad.shape[1]), np.float32)
    out[rows] = np.add.reduceat(grad[order], first, axis=0)
    return out


def contexts(words: Words, classes: np.ndarray, none: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class, the class before and the one before that, for all tokens with ends."""
    w = with_ends(words, classes, 0)
    doc = with_ends(words, words.doc, -1)
    last = np.flatnonzero(doc == -1)
    doc[last] = np.arange(len(last))
    one, two = np.full(len(w), none), np.full(len(w), none)
    one[1:] = np.where(doc[1:] == doc[:-1], w[:-1], none)
    two[2:] = np.where(doc[2:] == doc[:-2], w[:-2], none)
    return w, one, two


def _coded(classes: Classes):
    """Rows (part, text) to rows (part, the classes of its tokens as two-byte numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, part = b.column(1).to_pylist(), b.column(0)
            for at, words in _chunks(texts):
                codes = with_ends(words, classes.of(words.hash, endings(words)), 0).astype("<u2")
                stops = np.cumsum(words.counts + 1)
                rows = [codes[lo:hi].tobytes() for lo, hi in zip([0, *stops[:-1].tolist()], stops.tolist())]
                yield pa.RecordBatch.from_arrays([part.slice(at, len(rows)), pa.array(rows, pa.binary())], ["part", "codes"])

    return run


def _one_part(rows: pa.Table) -> pa.Table:
    """The texts of a part, one after another."""
    whole = b"".join(rows.column("codes").to_pylist())
    part = rows.column("part")[0].as_py()
    return pa.table({"part": pa.array([part], pa.int64()), "codes": pa.array([whole], pa.binary()), "round": pa.array([part % ROUNDS], pa.int32())})


def before(w: np.ndarray, none: int) -> tuple[np.ndarray, np.ndarray]:
    """The class before each token and the one before that, within its text."""
    one, two = np.full(len(w), none), np.full(len(w), none)
    same = w[:-1] != 0
    one[1:] = np.where(same, w[:-1], none)
    two[2:] = np.where(same[1:] & same[:-1], w[:-2], none)
    return one, two


def _walk(codes: np.ndarray, p: list[np.ndarray], squares: list[np.ndarray], share: np.ndarray, rng: np.random.Generator) -> None:
    """Updates of the parameters in place: one pass over a part, by batches, with a step size per parameter."""
    n = len(share)
    edges, shift = np.cumsum(share), (np.log(NOISE) + np.log(share)).astype(np.float32)
    one_all, two_all = before(codes, n)
    for lo in range(0, len(codes), BATCH):
        w, one, two = (x[lo : lo + BATCH] for x in (codes, one_all, two_all))
        noise = np.minimum(np.searchsorted(edges, rng.random(NOISE)), n - 1)
        predicted = p[0][one] + p[1][two]
        bias, target, other = p[3][:, 0], p[2][w], p[2][noise]
        good = (predicted * target).sum(1) + bias[w] - shift[w]
        bad = predicted @ other.T + bias[noise] - shift[noise]
        pull = (1 / (1 + np.exp(np.clip(good, -30, 30)))).astype(np.float32)
        push = (1 / (1 + np.exp(-np.clip(bad, -30, 30)))).astype(np.float32)
        d_context = pull[:, None] * target - push @ other
        d_out = _add_rows(pull[:, None] * predicted, w, n)
        d_bias = np.bincount(w, weights=pull, minlength=n).astype(np.float32)
        np.add.at(d_out, noise, -(push.T @ predicted))
        np.add.at(d_bias, noise, -push.sum(0))
        for x, s, g in zip(p, squares, (_add_rows(d_context, one, n + 1), _add_rows(d_context, two, n + 1), d_out, d_bias[:, None])):
            g /= len(w)
            s += g * g
            x += RATE * g / np.sqrt(s)


def _train(share: np.ndarray, start: np.ndarray, seed: int):
    """Parts to parameter rows (row, weight, values and their squared slopes), all from the same start."""
    n = len(share)
    cuts = [n + 1, 2 * (n + 1), 3 * n + 2]

    def parted(m: np.ndarray) -> list[np.ndarray]:
        """Vectors before, before that, outputs and biases; a bias stands in its output's row."""
        one, two, out, _ = np.split(m[:, :WIDTH].copy(), cuts)
        return [one, two, out, m[cuts[1] : cuts[2], WIDTH:].copy()]

    def joined(p: list[np.ndarray]) -> np.ndarray:
        m = np.zeros((cuts[2], WIDTH + 1), np.float32)
        m[:, :WIDTH] = np.concatenate(p[:3])
        m[cuts[1] :, WIDTH] = p[3][:, 0]
        return m

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                codes = np.frombuffer(raw.as_buffer(), "<u2").astype(np.int64)
                p, squares = parted(start[:, : WIDTH + 1]), parted(start[:, WIDTH + 1 :])
                _walk(codes, p, squares, share, np.random.default_rng([seed, part]))
                values = np.concatenate([joined(p), joined(squares)], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(values))), pa.array(np.full(len(values), float(len(codes)))), *(pa.array(c) for c in values.T)],
                    ["row", "weight", *(f"v{k}" for k in range(values.shape[1]))])

    return run


@dataclass(frozen=True)
class Model:
    classes: Classes
    parameters: Parameters

    @functools.cached_property
    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores by class before and class, by class before that and class, and the log normaliser of every context."""
        p = self.parameters
        one, two = p.one @ p.out.T + p.bias, p.two @ p.out.T
        top_one, top_two = one.max(1, keepdims=True), two.max(1, keepdims=True)
        second, log_norm = np.exp(two - top_two).T, np.empty((len(one), len(two)), np.float32)
        for lo in range(0, len(one), 256):  # some rows at a time, for the memory of a task
            own = slice(lo, lo + 256)
            log_norm[own] = np.log(np.exp(one[own] - top_one[own]) @ second) + top_one[own] + top_two.T
        return one, two, log_norm

    def log10_classes(self, w: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Normalised log10 probability of each class after its context."""
        by_one, by_two, log_norm = self.tables
        return (by_one[one, w].astype(float) + by_two[two, w] - log_norm[one, two]) / np.log(10)


def fit(train: DataFrame, *, text: str = "text", frequent: int | None = None) -> tuple[DataFrame, int, int, Model | None]:
    """Word counts (word, ending, n) of the rows given, N, V, and the model."""
    rows = train.select(text_of(text).alias("text"))
    counts = stored(rows.mapInArrow(_count, "word long, ending int, n long").groupBy("word").agg(
        F.max("ending").alias("ending"), F.sum("n").alias("n")), "word-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    if not total:
        return counts, 0, 0, None
    if frequent is None:
        frequent = min(max(int(distinct) // WORDS_PER_CLASS, MIN_FREQUENT), MAX_FREQUENT)
    top = counts.where(F.col("word") != END).orderBy(F.desc("n"), "word").limit(frequent).collect()
    words = np.sort(np.array([r["word"] for r in top], np.int64).view(np.uint64))
    n_classes = len(words) + 1 + ENDINGS
    totals, kinds = np.zeros(n_classes), np.zeros(n_classes)
    for r in top:
        totals[np.searchsorted(words, np.int64(r["word"]).view(np.uint64)) + 1] = r["n"]
    kinds[: len(words) + 1] = 1
    of_ending = {r["ending"]: r for r in counts.where(F.col("word") != END).groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect()}
    shared = Classes(words, totals, kinds)
    top_ending = np.array([r["ending"] for r in top], np.int64)
    for e, r in of_ending.items():
        at = len(words) + 1 + e
        totals[at] = r["n"] - sum(t["n"] for t, x in zip(top, top_ending) if x == e)
        kinds[at] = r["kinds"] - int((top_ending == e).sum())
    totals[0] = counts.where(F.col("word") == END).agg(F.sum("n")).first()[0]
    return counts, int(total), int(distinct), Model(shared, _rounds(rows, shared, int(total)))


def _rounds(rows: DataFrame, classes: Classes, total: int, seed: int = 7) -> Parameters:
    """Parameters after all rounds."""
    n = len(classes)
    share = (classes.total + 1) / (classes.total + 1).sum()
    p = Parameters.start(np.log(share))
    start = np.full((3 * n + 2, 2 * (WIDTH + 1)), 1e-6, np.float32)
    start[:, : WIDTH + 1] = 0
    start[:, :WIDTH] = np.concatenate([p.one, p.two, p.out])
    start[2 * (n + 1) :, WIDTH] = p.bias
    parts = ROUNDS * max(1, round(total / (ROUNDS * TASK_TOKENS)))
    # the row's number deals copies of a row as well
    dealt = rows.withColumn("id", F.monotonically_increasing_id()).select(F.pmod(F.xxhash64("text", "id"), F.lit(parts)).alias("part"), "text")
    path = work_dir(rows.sparkSession, "coded")
    dealt.mapInArrow(_coded(classes), "part long, codes binary").groupBy("part").applyInArrow(
        _one_part, "part long, codes binary, round int").write.partitionBy("round").parquet(path)
    coded = rows.sparkSession.read.schema("part long, codes binary, round int").parquet(path)
    names = [f"v{k}" for k in range(2 * (WIDTH + 1))]
    schema = "row long, weight double, " + ", ".join(f"{c} float" for c in names)
    means = [(F.sum(F.col(c) * F.col("weight")) / F.sum("weight")).cast("float").alias(c) for c in names]
    for k in range(ROUNDS):
        own = coded.where(F.col("round") == k).select("part", "codes")
        found = own.mapInArrow(_train(share, start, seed), schema).groupBy("row").agg(*means).orderBy("row").toArrow()
        if found.num_rows:
            start = np.stack([found.column(c).to_numpy() for c in names], 1)
    a, b = n + 1, 2 * (n + 1)
    return Parameters(start[:a, :WIDTH], start[a:b, :WIDTH], start[b:, :WIDTH], start[b:, WIDTH])


def _own_words(frequent: np.ndarray):
    """Rows (bucket, doc_id, text) to the distinct words (bucket, word) of each bucket."""

    def flush(held: dict[int, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for bucket, parts in held.items():
            h = np.unique(np.concatenate(parts))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), bucket, np.int64)), pa.array(h.view(np.int64))], ["bucket", "word"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        size = 0
        for b in batches:
            buckets = b.column(0).to_numpy()
            for bucket in np.unique(buckets):
                texts = b.filter(pa.array(buckets == bucket)).column(2).to_pylist()
                for _, words in _chunks(texts):
                    h = np.unique(words.hash)
                    h = h[~np.isin(h, frequent, assume_unique=True)]
                    held.setdefault(int(bucket), []).append(h)
                    size += len(h)
            if size > 3_000_000:
                held = {k: [np.unique(np.concatenate(v))] for k, v in held.items()}
                size = sum(len(v[0]) for v in held.values())
                if size > 2_000_000:
                    yield from flush(held)
                    held, size = {}, 0
        yield from flush(held)

    return run


_SCORED = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def score(docs: DataFrame, counts: DataFrame, total: int, distinct: int, model: Model | None, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score per row."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = int(max(1, chars // BUCKET_CHARS, min(int(spark.conf.get("spark.sql.shuffle.partitions")), chars // LEAST_CHARS)))
    dealt = rows.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).alias("bucket"), "doc_id", "text").repartition("bucket")
    frequent = model.classes.words if model else np.zeros(0, np.uint64)
    own = dealt.mapInArrow(_own_words(frequent), "bucket long, word long").join(counts.select("word", "n"), "word").select("bucket", "word", "n")
    shared = spark.sparkContext.broadcast(model)
    scale = np.log10(total + distinct + 1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        m = shared.value
        word = right.column("word").to_numpy().view(np.uint64)
        order = np.argsort(word)
        word, n_of = word[order], right.column("n").to_numpy()[order]
        texts, ids, out = left.column("text"), left.column("doc_id"), []
        at, size, lengths = 0, 0, pc.utf8_length(texts).to_pylist()
        for k, length in enumerate(lengths):
            size += length + 1
            if size >= CHUNK or k == len(lengths) - 1:
                out.append(_scored(m, Words(texts.slice(at, k + 1 - at).to_pylist(), lower=True), word, n_of, scale))
                at, size = k + 1, 0
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)] * 2
        return pa.table([ids, *map(pa.array, columns)], names=[c.split()[0] for c in _SCORED.split(", ")])

    return dealt.groupBy("bucket").cogroup(own.groupBy("bucket")).applyInArrow(run, _SCORED)


def _scored(m: Model | None, words: Words, word: np.ndarray, n_of: np.ndarray, scale: float) -> tuple[np.ndarray, ...]:
    tokens = words.counts + 1
    start = np.cumsum(tokens) - tokens
    if m is None:
        zero = np.zeros(words.n_docs)
        return tokens, np.zeros(words.n_docs, np.int64), zero, zero
    at = np.minimum(np.searchsorted(word, words.hash), max(len(word) - 1, 0))
    c = np.where(word[at] == words.hash, n_of[at], 0) if len(word) else np.zeros(len(words.hash), np.int64)
    kind = m.classes.of(words.hash, endings(words))
    own = kind <= len(m.classes.words)
    c[own] = m.classes.total[kind[own]]
    count = with_ends(words, c, int(m.classes.total[0]))
    w, one, two = contexts(words, kind, len(m.classes))
    within = np.where(w <= len(m.classes.words), 0.0, np.log10((count + 1) / (m.classes.total[w] + m.classes.distinct[w] + 1)))
    model_score = m.log10_classes(w, one, two) + within
    return (tokens, np.add.reduceat((count > 0).astype(np.int64), start), np.add.reduceat(np.log10(count + 1.0) - scale, start),
            np.add.reduceat(model_score, start))


def split_off(docs: DataFrame, id: str = "doc_id", modulus: int = 7, remainder: int = 2) -> DataFrame:
    """The rows that may be learned from."""
    return docs.where(id_remainder(id, modulus) != remainder)
