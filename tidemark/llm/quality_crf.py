"""Document quality from a linear-chain conditional random field over lines.

Every line with a visible character is a node with two labels, good and bad. Its
observation holds its own features and those of the lines before and after it.
Forward-backward gives each line's marginal; the mean of the good marginals,
weighted by the lines' lengths, and calibrated on the training texts, is the
document's score.

Only documents are labelled. The first fit gives all lines their document's label;
the second one takes lines of bad documents that look good for good, except the
worst line of each. At most ``max_rows`` labelled documents are learned from (a
parameter; chosen by hash, all of them where there are fewer). Line features are
made by Spark tasks; the driver fits from the sample's features.

Defined cases: a null text is an empty one; a text without visible lines scores the
training share of good documents; if only one class is labelled every text scores that
share (0.5 without any label); labels that are null or without a document are left
out; repeated rows are scored each; an empty table gives an empty result; other
columns are ignored, or kept as they are by ``good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import powers, id_remainder, mixed, stored, text_of

MAX_ROWS = 5000
CHUNK = 1 << 20
_TABLE = 0x2000
_SPACE, _UPPER, _LETTER, _DIGIT, _STOP, _SHOUT, _MARK = 1, 2, 4, 8, 16, 32, 64


def _classes() -> np.ndarray:
    out = np.zeros(_TABLE, np.uint8)
    for c in range(_TABLE):
        ch = chr(c)
        if ch in " \t\n\x0b\f\r":
            out[c] = _SPACE
        elif ch.isalpha():
            out[c] = _LETTER | (_UPPER if ch.isupper() else 0)
        elif ch.isdigit():
            out[c] = _DIGIT
        elif ch in ".,;:'\"()-":
            out[c] = _STOP
        elif ch in "!?":
            out[c] = _SHOUT
        else:
            out[c] = _MARK
    return out


CLASSES = _classes()
OWN = 11


@dataclass
class Lines:
    """Visible lines of a batch: features with neighbours, length and document."""

    x: np.ndarray
    size: np.ndarray
    doc: np.ndarray


def lines(texts: list[str]) -> Lines:
    joined = "\n".join([*texts, ""])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return Lines(np.zeros((0, 3 * OWN + 3), np.float32), np.zeros(0), np.zeros(0, np.int64))
    doc_ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    kind = np.where(points < _TABLE, CLASSES[np.minimum(points, _TABLE - 1)], _LETTER)
    ends = np.flatnonzero(points == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])

    def per_line(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
        return (total[ends] - total[starts]).astype(np.float64)

    visible = per_line((kind & _SPACE) == 0)
    inside = (kind & _SPACE) == 0
    step = np.diff(inside.astype(np.int8), prepend=0, append=0)
    w0, w1 = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    forward, back = powers(len(points) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((points.astype(np.uint64) + np.uint64(1)) * forward[:-1])])
    word = mixed((total[w1] - total[w0]) * back[w0] ^ (w1 - w0).astype(np.uint64))
    line_hash = mixed((total[ends] - total[starts]) * back[starts])
    of_line = np.searchsorted(ends, w0)
    n_lines = len(ends)
    words = np.bincount(of_line, minlength=n_lines).astype(np.float64)
    same = np.concatenate([[False], (word[1:] == word[:-1]) & (of_line[1:] == of_line[:-1])])
    again = np.bincount(of_line, weights=same, minlength=n_lines)
    marked = np.bincount(of_line, weights=(kind[w1 - 1] & (_MARK | _SHOUT)) > 0, minlength=n_lines)
    keep = visible > 0
    doc = np.searchsorted(doc_ends, ends, "right")
    n, w = np.maximum(visible, 1), np.maximum(words, 1)
    letters = per_line((kind & _LETTER) > 0)
    times = _times(doc, line_hash)
    own = np.stack([
        np.minimum(np.log1p(visible) / 8, 1.5), per_line((kind & _UPPER) > 0) / np.maximum(letters, 1), per_line((kind & _DIGIT) > 0) / n,
        np.minimum(per_line((kind & _MARK) > 0) / w, 2), np.minimum(per_line((kind & _SHOUT) > 0) / w, 2), letters / n,
        np.minimum(visible / w / 10, 2), again / w, np.minimum(times - 1, 5) / 5, marked / w, words < 4,
    ], 1).astype(np.float32)[keep]
    doc = doc[keep]
    same_doc = doc[1:] == doc[:-1] if len(doc) else np.zeros(0, bool)
    before, after = np.zeros_like(own), np.zeros_like(own)
    if len(doc):
        before[1:] = own[:-1] * same_doc[:, None]
        after[:-1] = own[1:] * same_doc[:, None]
    has = np.zeros((len(doc), 3), np.float32)
    has[:, 0] = 1
    if len(doc):
        has[1:, 1], has[:-1, 2] = same_doc, same_doc
    return Lines(np.concatenate([own, before, after, has], 1), visible[keep], doc)


def _times(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """How often each line occurs in its document."""
    key = mixed(h ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    _, place, times = np.unique(key, return_inverse=True, return_counts=True)
    return times[place]


def _both(a: np.ndarray) -> np.ndarray:
    return np.logaddexp(a[..., 0], a[..., 1])


@dataclass
class Chains:
    """Where each chain's nodes lie, for all chains to be walked abreast."""

    first: np.ndarray
    count: np.ndarray

    @staticmethod
    def of(doc: np.ndarray) -> Chains:
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        count = np.diff(np.append(first, len(doc)))
        by_size = np.argsort(-count, kind="stable")
        return Chains(first[by_size], count[by_size])

    def steps(self) -> Iterator[np.ndarray]:
        """Nodes number 1, 2, ... of all chains that have them."""
        for t in range(1, int(self.count[0]) if len(self.count) else 0):
            yield self.first[: np.searchsorted(-self.count, -t)] + t

    def marginals(self, unary: np.ndarray, link: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Label marginals per node, summed pair marginals, summed log partition."""
        ahead, behind = unary.copy(), np.zeros_like(unary)
        walk = list(self.steps())
        for at in walk:
            ahead[at] += _both(np.swapaxes(ahead[at - 1][:, :, None] + link, 1, 2))
        last = self.first + self.count - 1
        for at in reversed(walk):
            behind[at - 1] = _both(link[None] + (unary[at] + behind[at])[:, None, :])
        in_order = np.argsort(self.first)
        z = np.repeat(_both(ahead[last])[in_order], self.count[in_order])
        p = np.exp(ahead + behind - z[:, None])
        pairs = np.zeros((2, 2))
        for at in walk:
            pairs += np.exp(ahead[at - 1][:, :, None] + link + (unary[at] + behind[at])[:, None, :] - z[at][:, None, None]).sum(0)
        return p, pairs, float(_both(ahead[last]).sum())


@dataclass(frozen=True)
class Model:
    weight: np.ndarray | None  # observation weights of the label good, against bad
    link: np.ndarray
    slope: float
    shift: float
    prior: float

    def line_marginals(self, found: Lines) -> np.ndarray:
        unary = np.zeros((len(found.doc), 2))
        unary[:, 1] = found.x @ self.weight
        return Chains.of(found.doc).marginals(unary, self.link)[0][:, 1] if len(found.doc) else np.zeros(0)

    def raw(self, found: Lines, n: int) -> np.ndarray:
        """Length-weighted good marginals, -1 for documents without lines."""
        good = np.bincount(found.doc, weights=self.line_marginals(found) * found.size, minlength=n)
        size = np.bincount(found.doc, weights=found.size, minlength=n)
        return np.where(size > 0, good / np.maximum(size, 1), -1.0)

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        return np.where(raw < 0, self.prior, 1 / (1 + np.exp(-(self.slope * raw + self.shift))))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.weight is None:
            return np.full(len(texts), self.prior)
        out, at, size = [], 0, 0
        for k, t in enumerate(texts):
            size += len(t or "") + 1
            if size >= CHUNK or k == len(texts) - 1:
                some = [x or "" for x in texts[at : k + 1]]
                out.append(self.calibrated(self.raw(lines(some), len(some))))
                at, size = k + 1, 0
        return np.concatenate(out) if out else np.zeros(0)


def _adam(start: np.ndarray, slope, rounds: int, rate: float) -> np.ndarray:
    at, first, second = start.copy(), np.zeros(len(start)), np.zeros(len(start))
    for t in range(1, rounds + 1):
        g = slope(at)
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        at -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    return at


def _fit_chain(x: np.ndarray, label: np.ndarray, chains: Chains, start: np.ndarray, rounds: int, held: float = 1e-4) -> np.ndarray:
    """Maximum conditional likelihood of line labels: weights, then the four link scores."""
    d, n = x.shape[1], max(len(x), 1)
    observed = np.zeros((2, 2))
    for at in chains.steps():
        np.add.at(observed, (label[at - 1], label[at]), 1)

    def slope(v: np.ndarray) -> np.ndarray:
        unary = np.zeros((len(x), 2))
        unary[:, 1] = x @ v[:d]
        p, pairs, _ = chains.marginals(unary, v[d:].reshape(2, 2))
        return np.concatenate([x.T @ (p[:, 1] - label), (pairs - observed).ravel()]) / n + held * v

    return _adam(start, slope, rounds, 0.1)


def fit(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "quality",
        max_rows: int = MAX_ROWS, seed: int = 11, rounds: int = 100) -> Model:
    """A model from the labelled documents given (held-out ones must be gone already)."""
    known = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(id).alias("label_id")).agg(F.min(label).cast("int").alias("y"))
    total = known.count()
    if total > max_rows:
        known = known.where(F.pmod(F.xxhash64("label_id", F.lit(seed)), F.lit(1 << 30)) < int((1 << 30) * max_rows / total))
    rows = docs.select(F.col(id).cast("long").alias("label_id"), text_of(text).alias("text")).join(known, "label_id").select("label_id", "text", "y")

    def observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            xs, sizes = [], []
            for t in b.column(1).to_pylist():
                found = lines([t])
                xs.append(found.x.astype(np.float32).tobytes())
                sizes.append(found.size.astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(xs, pa.binary()), pa.array(sizes, pa.binary())], ["label_id", "y", "x", "size"])

    sample = stored(rows.mapInArrow(observe, "label_id long, y int, x binary, size binary"), "quality-sample").toArrow()
    y_doc, xs, sizes = (sample.column(c).to_pylist() for c in ("y", "x", "size"))
    order = np.argsort(np.array(sample.column("label_id").to_pylist(), np.int64), kind="stable")  # reruns agree
    prior = min(max(float(np.mean(y_doc)), 1e-6), 1 - 1e-6) if y_doc else 0.5
    if len(set(y_doc)) < 2:
        return Model(None, np.zeros((2, 2)), 1.0, 0.0, prior)
    x = [np.frombuffer(xs[i], np.float32).reshape(-1, 3 * OWN + 3) for i in order]
    y_doc = np.array([y_doc[i] for i in order])
    doc = np.repeat(np.arange(len(x)), [len(a) for a in x])
    found = Lines(np.concatenate(x), np.concatenate([np.frombuffer(sizes[i], np.float32) for i in order]), doc)
    chains = Chains.of(doc)
    label = y_doc[doc]
    v = _fit_chain(found.x, label, chains, np.zeros(found.x.shape[1] + 4), rounds)

    def model(v: np.ndarray, slope: float = 1.0, shift: float = 0.0) -> Model:
        return Model(v[:-4].astype(np.float32), v[-4:].reshape(2, 2), slope, shift, prior)

    good = model(v).line_marginals(found)
    worst = np.zeros(len(doc), bool)
    by_doc = np.lexsort([good, doc])
    worst[by_doc[np.flatnonzero(np.diff(doc[by_doc], prepend=-1))]] = True
    label = np.where((label == 0) & (good > 0.5) & ~worst, 1, label)
    v = _fit_chain(found.x, label, chains, v, rounds)
    raw = model(v).raw(found, len(x))
    some = raw >= 0
    z, t = raw[some], y_doc[some]

    def slope(w: np.ndarray) -> np.ndarray:
        error = 1 / (1 + np.exp(-(w[0] * z + w[1]))) - t
        return np.array([(error * z).mean() + 1e-4 * w[0], error.mean() + 1e-4 * w[1]])

    a, b = _adam(np.array([4.0, -2.0]), slope, 500, 0.1)
    return model(v, float(a), float(b))


def score(docs: DataFrame, model: Model, *, id: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """doc_id, score, predicted for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            value = shared.value.scores(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(value), pa.array((value >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col(id).cast("long").alias("doc_id"), text_of(text).alias("text")).mapInArrow(run, "doc_id long, score double, predicted int")


def good(docs: DataFrame, model: Model, *, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows whose text scores ``threshold`` or more, unchanged."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = shared.value.scores([None if t is None else str(t) for t in b.column(at).to_pylist()]) >= threshold
            yield b.filter(pa.array(keep))

    return docs.mapInArrow(run, T.StructType(docs.schema.fields))


def split_off(docs: DataFrame, id: str = "doc_id", modulus: int = 4, remainder: int = 2) -> DataFrame:
    """The rows that may be learned from."""
    return docs.where(id_remainder(id, modulus) != remainder)
