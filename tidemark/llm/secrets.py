"""Secrets in texts: fixed patterns, and a character convolutional network over every other candidate.

Patterns find assignments to names such as ``password``, access keys and long hexadecimal runs; their
findings always stay. Candidates of the network are the runs of letters, digits and ``+/_.-``
(with ``=`` at the end) of ``MIN_BARE`` characters or more, or of ``MIN_KEYED`` or more after a colon or
equals sign. It sees the whole candidate, the characters before and after it, and says how likely it is a secret. Candidates
that overlap no pattern's finding and reach the threshold of their context (after a sign, or
bare) are findings of kind ``model``.

The network: features of characters, convolutions over five neighbours, maxima per region
(before, inside, after) and means inside, a hidden layer, one output; all numpy. It learns from
labelled findings: a table made by a rule (shapes of credentials, and of what looks
like them, in several contexts), and all different ones of the corpus, where
patterns' findings are secrets and plain words are not. Those of a label weigh ``max_weight`` made ones together, or one each
where there are fewer, so that plain words do not outweigh all else. A third of the labelled findings is kept
apart, as calibration by a logistic curve needs scores of findings not trained on. The threshold of a context is the
highest at which the share ``recall`` of its secrets kept apart, by weight, is found.

Training starts from the made table. Then the findings of the corpus are dealt by hash into parts of about ``PART`` and each
is walked once, with the made table, in ``ROUNDS`` rounds: the parts of a round start from the same network, whose average
over them starts the next. So the network does not depend on files, tasks or cores.

Defined cases: a null text is an empty one, which has no findings; other columns are
ignored; repeated rows are scanned each, a finding's copies are learned from once; an empty table gives an empty result and a
model of the made table alone. Offsets count code points.

At scale: one pass over the texts to learn, one to scan, without a shuffle of texts; candidates are scored in slices of bounded
size, so the length of a text or candidate does not matter for memory. Labelled findings, of at most ``CONTEXT`` characters
each, are shuffled to be told apart and to meet in their parts. The driver gets the averaged network of a round, and the
number of findings kept apart by steps of their outputs, of which there is a fixed number.
"""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored, text_of

KINDS = ("assign", "access", "hex", "model")
MAX_WEIGHT = 1500
RECALL = 0.97
MIN_BARE, MIN_KEYED = 12, 8
LEFT, RIGHT, CONTEXT = 24, 8, 512
WIDTH, FILTERS, HIDDEN = 5, 24, 16
SLICE = 1 << 16
PART, ROUNDS, WALKED = 1 << 14, 4, 40_000  # findings of a part; small parts are walked until so many rows are seen
STEPS, LARGEST = 256, 64  # outputs are counted in steps of 1 / STEPS, up to LARGEST on both sides

# The patterns of the contract; a finding counts from these lengths on.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
NAMES = ("passw", "secret", "token", "api")
ASSIGN_FROM, ACCESS_FROM = 6, 20

CANDIDATE = re.compile(r"[A-Za-z0-9+/_.-]{%d,}(?:={1,2}(?![A-Za-z0-9+/_.=-]))?" % MIN_KEYED)
SIGN = re.compile(r"[:=][\"'\x20]*\Z")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' findings."""
    out = []
    if (":" in text or "=" in text) and any(n in low for low in (text.lower(),) for n in NAMES):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_FROM]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_FROM]
    return sorted(out + [(m.start(), 2, m.end()) for m in HEX.finditer(text)])


def candidates(text: str) -> list[tuple[int, int, bool]]:
    """(start, end, follows a sign) of what the network looks at."""
    out = []
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while end > start and text[end - 1] in ".-":
            end -= 1
        keyed = bool(SIGN.search(text, max(0, start - 4), start))
        if end - start >= (MIN_KEYED if keyed else MIN_BARE):
            out.append((start, end, keyed))
    return out


def overlapping(spans: list[tuple[int, int]], others: list[tuple[int, int]]) -> np.ndarray:
    """Which spans touch one of the others; both ascending by start."""
    if not others or not spans:
        return np.zeros(len(spans), bool)
    a, b = np.array(spans), np.array(others)
    reach = np.maximum.accumulate(b[:, 1])
    k = np.searchsorted(b[:, 0], a[:, 1], "left")
    return (k > 0) & (reach[np.maximum(k - 1, 0)] > a[:, 0])


def _features() -> np.ndarray:
    """A row per character code: its classes, its folded letter. 128 stands for all beyond ASCII, 129 for no character."""
    marks = "+/_.=-:\"'@ "
    out = np.zeros((130, 9 + len(marks) + 26), np.float32)
    for c in range(128):
        ch = chr(c)
        out[c, :7] = [ch.islower(), ch.isupper(), ch.isdigit(), ch in "abcdef", ch.lower() in "aeiouy", ch.isspace(), ch.isalpha()]
        if ch in marks:
            out[c, 9 + marks.index(ch)] = 1
        if ch.isalpha():
            out[c, 9 + len(marks) + ord(ch.lower()) - 97] = 1
    out[128, 7] = out[129, 8] = 1
    return out


FEATURES = _features()


@dataclass
class Sample:
    """Candidates as character codes, each between two blank codes on either side."""

    codes: np.ndarray
    region: np.ndarray  # 0 before, 1 inside, 2 after, 3 none
    owner: np.ndarray
    length: np.ndarray

    @classmethod
    def of(cls, windows: list[tuple[str, str, str]]) -> "Sample":
        gap = "\x7f\x7f"
        raw = np.frombuffer("".join([gap + a + b + c + gap for a, b, c in windows]).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.array([[2, len(a), len(b), len(c), 2] for a, b, c in windows], np.int64).reshape(-1, 5)
        region = np.repeat(np.tile([3, 0, 1, 2, 3], len(windows)), sizes.ravel())
        codes = np.where(region == 3, 129, np.minimum(raw, 128))
        return cls(codes.astype(np.int64), region, np.repeat(np.arange(len(windows)), sizes.sum(1)), sizes[:, 2])


@dataclass
class Network:
    conv: np.ndarray  # neighbour, character feature, filter
    bias: np.ndarray  # region, filter
    dense: np.ndarray
    dense_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    thresholds: tuple[float, float] = (0.5, 0.5)  # bare, after a sign
    names: tuple[str, ...] = field(default=("conv", "bias", "dense", "dense_bias", "out", "out_bias"), repr=False)

    @classmethod
    def start(cls, seed: int) -> "Network":
        r = np.random.default_rng(seed)
        wide = 4 * FILTERS + 1
        return cls(r.normal(0, 0.15, (WIDTH, FEATURES.shape[1], FILTERS)), np.zeros((3, FILTERS)),
                   r.normal(0, wide**-0.5, (wide, HIDDEN)), np.zeros(HIDDEN), r.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1))

    def pooled(self, sample: Sample) -> np.ndarray:
        """Maxima per region, means inside and length of every candidate, in slices of positions."""
        n = len(sample.length)
        tops, mean = np.zeros((3, n, FILTERS), np.float32), np.zeros((n, FILTERS), np.float64)
        tables = (FEATURES @ self.conv).astype(np.float32)  # a row per code and neighbour
        half = WIDTH // 2
        for lo in range(half, len(sample.codes) - half, SLICE):
            at = np.arange(lo, min(lo + SLICE, len(sample.codes) - half))
            at = at[sample.region[at] < 3]
            if not len(at):
                continue
            region, owner = sample.region[at], sample.owner[at]
            y = self.bias.astype(np.float32)[region]
            for k in range(WIDTH):
                y += tables[k][sample.codes[at + k - half]]
            np.maximum(y, 0, out=y)
            first = np.flatnonzero(np.diff(owner * 3 + region, prepend=-1))
            r, o = region[first], owner[first]
            tops[r, o] = np.maximum(tops[r, o], np.maximum.reduceat(y, first))
            inside = r == 1
            mean[o[inside]] += np.add.reduceat(y, first)[inside]
        mean /= np.maximum(sample.length, 1)[:, None]
        return np.concatenate([*tops, mean, np.log2(sample.length + 1.0)[:, None] / 8], axis=1)

    def logits(self, sample: Sample) -> np.ndarray:
        hidden = np.maximum(self.pooled(sample) @ self.dense + self.dense_bias, 0)
        return hidden @ self.out + self.out_bias[0]

    def probability(self, sample: Sample) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.logits(sample) + self.shift, -40, 40)))


def _slopes(net: Network, sample: Sample, label: np.ndarray, weight: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """Gradients of the log loss, its mean if no weights are given."""
    n, half = len(label), WIDTH // 2
    inner = slice(half, len(sample.codes) - half)  # gaps are as wide: all positions of candidates, and the gaps between
    region, owner = sample.region[inner], sample.owner[inner]
    x = FEATURES[sample.codes]
    around = [x[k : k + len(region)] for k in range(WIDTH)]
    y = net.bias.astype(np.float32)[np.minimum(region, 2)]
    for k in range(WIDTH):
        y += around[k] @ net.conv[k].astype(np.float32)
    y = np.maximum(y, 0)
    first = np.flatnonzero(np.diff(owner * 4 + region, prepend=-1))
    best = np.maximum.reduceat(y, first)
    run = np.repeat(np.arange(len(first)), np.diff(first, append=len(y)))
    place = np.minimum.reduceat(np.where(y == best[run], np.arange(len(y))[:, None], len(y)), first)  # the first of equal ones
    own = region[first] < 3
    first, best, place = first[own], best[own], place[own]
    r, o = region[first], owner[first]
    inside = np.flatnonzero(region == 1)
    tops, mean = np.zeros((3, n, FILTERS)), np.zeros((n, FILTERS))
    tops[r, o] = best
    if len(inside):
        mean[o[r == 1]] = np.add.reduceat(y[inside], np.flatnonzero(np.diff(owner[inside], prepend=-1)))
    size = np.maximum(sample.length, 1)[:, None]
    pooled = np.concatenate([*tops, mean / size, np.log2(sample.length + 1.0)[:, None] / 8], axis=1)
    before = pooled @ net.dense + net.dense_bias
    hidden = np.maximum(before, 0)
    error = (1 / (1 + np.exp(-np.clip(hidden @ net.out + net.out_bias[0], -40, 40))) - label) * (1 / n if weight is None else weight)
    d_hidden = np.outer(error, net.out) * (before > 0)
    d_pooled = d_hidden @ net.dense.T
    parts = np.stack(np.split(d_pooled[:, : 4 * FILTERS], 4, axis=1)).astype(np.float32)
    d_y = np.zeros_like(y)
    d_y[inside] = (parts[3] / size.astype(np.float32))[owner[inside]] * (y[inside] > 0)
    d_y[place, np.arange(FILTERS)] += np.where(best > 0, parts[r, o], 0)
    return {"conv": np.stack([around[k].T @ d_y for k in range(WIDTH)]),
            "bias": np.stack([d_y[region == k].sum(0) for k in range(3)]),
            "dense": pooled.T @ d_hidden, "dense_bias": d_hidden.sum(0), "out": hidden.T @ error, "out_bias": error.sum(keepdims=True)}


def _joined(values: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([values[name].ravel() for name in Network.start(0).names])


def _network(values: np.ndarray) -> Network:
    """The network of joined parameters, which it shares."""
    like = Network.start(0)
    shapes = [getattr(like, name).shape for name in like.names]
    cuts = np.cumsum([int(np.prod(s)) for s in shapes])[:-1]
    return Network(*(v.reshape(s) for v, s in zip(np.split(values, cuts), shapes)))


Windows = list[tuple[str, str, str]]


def _walk(state: np.ndarray, step: int, windows: Windows, label: np.ndarray, weight: np.ndarray, r: np.random.Generator,
          epochs: int, batch: int = 128, decay: float = 1e-4) -> int:
    """Adam over shuffled batches, in place: parameters, mean slopes, mean squared slopes. Gives the step reached."""
    net, (value, first, second) = _network(state[0]), state
    weight = weight / weight.mean()
    for _ in range(epochs):
        order = r.permutation(len(windows))
        for lo in range(0, len(order), batch):
            some, step = order[lo : lo + batch], step + 1
            slope = _joined(_slopes(net, Sample.of([windows[i] for i in some]), label[some], weight[some] / len(some))) + decay * value
            first += 0.1 * (slope - first)
            second += 0.01 * (slope * slope - second)
            value -= 0.01 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return step


def _start(seed: int) -> np.ndarray:
    net = Network.start(seed)
    values = _joined({name: getattr(net, name) for name in net.names})
    return np.stack([values, np.zeros_like(values), np.zeros_like(values)])


def calibrate(net: Network, z: np.ndarray, label: np.ndarray, keyed: np.ndarray, weight: np.ndarray, recall: float) -> Network:
    """A logistic curve over the outputs, and per context the highest threshold that keeps the recall."""
    for _ in range(50):  # Newton steps with a small pull towards slope one
        p = 1 / (1 + np.exp(-np.clip(net.slope * z + net.shift, -40, 40)))
        w = weight * p * (1 - p) + 1e-9
        miss = weight * (p - label)
        gradient = np.array([(miss * z).sum() + (net.slope - 1), miss.sum() + 0.1 * net.shift])
        hessian = np.array([[(w * z * z).sum() + 1, (w * z).sum()], [(w * z).sum(), w.sum() + 0.1]])
        move = np.linalg.solve(hessian, gradient)
        net.slope, net.shift = float(net.slope - np.clip(move[0], -1, 1)), float(net.shift - np.clip(move[1], -1, 1))
    p = 1 / (1 + np.exp(-np.clip(net.slope * z + net.shift, -40, 40)))
    found = []
    for context in (False, True):
        own = np.flatnonzero((label == 1) & (keyed == context))
        own = own[np.argsort(p[own], kind="stable")]
        below = np.cumsum(weight[own]) - weight[own]
        found.append(float(p[own[below <= (1 - recall) * weight[own].sum()][-1]]) if len(own) else 1.0)
    net.thresholds = (found[0], found[1])
    return net


def made_findings(n: int = 2400, seed: int = 11) -> list[tuple[str, str, str, int]]:
    """The labelled table: (before, candidate, after, label), made by shape."""
    r = random.Random(seed)
    lower, upper, digits = string.ascii_lowercase, string.ascii_uppercase, string.digits
    draw = lambda stock, lo, hi: "".join(r.choice(stock) for _ in range(r.randint(lo, hi)))

    def word(lo: int = 2, hi: int = 5) -> str:
        return "".join(r.choice("bcdfghlmnprstvw") + r.choice("aeiou") + r.choice(["", "n", "r", "s", "t"]) for _ in range(r.randint(lo, hi)))

    mixed, hexes = lower + upper + digits, digits + "abcdef"
    secrets = [
        lambda: draw(hexes, 24, 64), lambda: "AKIA" + draw(upper + digits, 16, 16), lambda: draw(mixed + "+/", 32, 64) + r.choice(["", "=", "=="]),
        lambda: r.choice(["ghp_", "gho_", "sk_live_", "pk_live_", "rk_test_", "glpat-", "npm_", "hf_", "sk-"]) + draw(mixed, 20, 40),
        lambda: "xox" + r.choice("bap") + "-" + draw(digits, 10, 12) + "-" + draw(mixed, 20, 24),
        lambda: "eyJ" + draw(mixed, 17, 40) + "." + draw(mixed + "_-", 30, 80) + "." + draw(mixed + "_-", 27, 43),
        lambda: "AIza" + draw(mixed + "_-", 35, 35), lambda: draw(mixed, 20, 40), lambda: draw(mixed + "_-", 24, 43)]
    keyed_only = [lambda: draw(mixed, 10, 20), lambda: word(1, 2).title() + draw(digits, 2, 4) + draw(upper + "+-_", 1, 3) + draw(mixed, 2, 6), lambda: draw(hexes, 12, 22)]
    harmless = [
        lambda: word(5, 9), lambda: word(5, 8).title(), lambda: word(5, 8).upper(), lambda: "".join(word(1, 3).title() for _ in range(3)),
        lambda: "_".join(word(1, 3) for _ in range(r.randint(2, 4))), lambda: "-".join(word(1, 3) for _ in range(r.randint(2, 4))),
        lambda: "//www." + word() + r.choice([".com", ".org", ".net"]) + "/" + "/".join(word(1, 3) for _ in range(r.randint(1, 3))),
        lambda: "/".join(["", word(1, 2), word(1, 2), word(1, 3) + "." + draw(lower, 2, 4)]), lambda: word(1, 2) + "." + word(1, 3) + "." + word(1, 2),
        lambda: word() + "." + draw(digits, 1, 3), lambda: ".".join(draw(digits, 2, 3) for _ in range(4)), lambda: draw(digits, 12, 20),
        lambda: f"20{r.randint(10, 29)}-{r.randint(10, 12)}-{r.randint(10, 28)}T{r.randint(10, 23)}", lambda: draw("-", 12, 40) if r.random() < 0.5 else draw("_", 12, 40),
        lambda: r.choice(["x", "X", "0", "1"]) * r.randint(12, 40), lambda: "v" + ".".join(draw(digits, 1, 2) for _ in range(3)) + "-" + word(2, 3),
        lambda: word(1, 2) + str(r.randint(1, 99)) + "." + word(2, 3) + r.choice([".com", ".org"]), lambda: "mail" + str(r.randint(1, 99)) + ".example.com",
        lambda: "YOUR_" + r.choice(["API_KEY", "SECRET", "TOKEN", "PASSWORD"]) + "_HERE", lambda: "https." + word() + "." + word()]
    names = ["password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "access_key", "client_secret", "auth", "bearer", "private_key", "credential", "passphrase"]
    others = ["title", "name", "path", "url", "version", "author", "date", "file", "class", "id", "http", "https", "see", "note", "width", "count"]

    def prose() -> str:
        return " ".join(word(1, 3) for _ in range(r.randint(0, 5)))

    out = []
    for k in range(n):
        label, keyed = k % 2, r.random() < 0.5
        before = prose() + r.choice(["", "\n", " ", ". "])
        if keyed:
            name = r.choice(names if r.random() < (0.8 if label else 0.15) else others)
            before = (before + " " + r.choice([name, name.upper(), '"' + name + '"']) + r.choice(["=", ": ", " = ", ":", '": "', '="', "='"]))
        elif before and not before[-1].isspace():
            before += " "
        stock = secrets + (keyed_only if keyed else []) if label else harmless
        after = r.choice(["", " ", "\n", '" ', ", ", ". ", "' "]) + prose()
        out.append((before[-LEFT:], r.choice(stock)(), after[:RIGHT], label))
    return out


def _window(text: str, start: int, end: int) -> tuple[str, str, str]:
    return text[max(0, start - LEFT) : start], text[start:end], text[end : end + RIGHT]


def corpus_findings(most: int | None, seed: int):
    """Findings with a sure label (in a pattern's finding, or a plain word), and a hash of the window as their key: all,
    or of each label the ``most`` different ones of a task with the least keys."""
    plain = re.compile(r"[A-Za-z][a-z]+|[A-Z]+")

    def rows(kept: list[dict]) -> Iterator[pa.RecordBatch]:
        for y in (0, 1):
            keys = sorted(kept[y]) if most is None else heapq.nsmallest(most, kept[y])
            columns = [keys, *([kept[y][k][c] for k in keys] for c in range(3)), [y] * len(keys)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), *[pa.string()] * 3, pa.int32()])],
                                             ["key", "before", "value", "after", "label"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[dict] = [{}, {}]
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = candidates(text)
                inside = overlapping([f[:2] for f in found], [(a, b) for a, _, b in base_spans(text)])
                for (a, b, _), own in zip(found, inside):
                    if own or plain.fullmatch(text, a, b):
                        before, value, after = _window(text, a, b)
                        window = (before, value[:CONTEXT], after)
                        key = hashlib.blake2b(repr((seed, window)).encode("utf-8", "surrogatepass"), digest_size=7).digest()
                        kept[int(own)][int.from_bytes(key)] = window
                if most is None and len(kept[0]) + len(kept[1]) > PART:
                    yield from rows(kept)
                    kept = [{}, {}]
            for y in (0, 1):
                if most is not None and len(kept[y]) > 2 * most:
                    kept[y] = {k: kept[y][k] for k in heapq.nsmallest(most, kept[y])}
        yield from rows(kept)

    return run


def _bare(windows: Windows, label: np.ndarray, weight: np.ndarray, r: np.random.Generator) -> tuple[Windows, np.ndarray, np.ndarray]:
    """Three in ten secrets also without the name before them: these are secrets too."""
    some = np.flatnonzero((label == 1) & (r.random(len(windows)) < 0.3))
    more = [("", *windows[i][1:]) for i in some]
    return windows + more, np.concatenate([label, np.ones(len(more))]), np.concatenate([weight, weight[some]])


@dataclass
class Labelled:
    """The made table, dealt into what is shown and what is kept apart."""

    shown: Windows
    label: np.ndarray
    rest: Windows
    rest_label: np.ndarray

    @classmethod
    def of(cls, findings: list[tuple[str, str, str, int]], seed: int) -> "Labelled":
        r = np.random.default_rng(seed)
        label = np.array([f[3] for f in findings], float)
        apart = r.random(len(findings)) < 1 / 3
        shown, y, _ = _bare([f[:3] for f, a in zip(findings, apart) if not a], label[~apart], np.ones(int((~apart).sum())), r)
        return cls(shown, y, [f[:3] for f, a in zip(findings, apart) if a], label[apart])

    def trained(self, seed: int) -> tuple[np.ndarray, int]:
        state = _start(seed)
        return state, _walk(state, 0, self.shown, self.label, np.ones(len(self.shown)), np.random.default_rng(seed), 12)


def _keyed(windows: Windows) -> np.ndarray:
    return np.array([bool(SIGN.search(w[0])) for w in windows], bool)


def _walked(made: Labelled, state: np.ndarray, step: int, weights: tuple[float, float], seed: int):
    """A part's findings to the parameters after a walk over them and the made table."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("key", "ascending"), ("before", "ascending"), ("value", "ascending"), ("after", "ascending")])
        label = rows.column("label").to_numpy().astype(float)
        r = np.random.default_rng([seed, rows.column("part")[0].as_py()])
        windows = list(zip(*(rows.column(c).to_pylist() for c in ("before", "value", "after"))))
        windows, label, weight = _bare(windows, label, np.where(label == 1, weights[1], weights[0]), r)
        own = state.copy()
        _walk(own, step, made.shown + windows, np.concatenate([made.label, label]), np.concatenate([np.ones(len(made.shown)), weight]), r,
              max(1, min(12, WALKED // (len(made.shown) + len(windows)))))
        return pa.table([np.arange(own.shape[1]), *own], ["at", "value", "first", "second"])

    return run


def _outputs(net: Network):
    """Findings to their label, context and output of the network, in whole steps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                some = batch.slice(lo, 1024)
                windows = list(zip(*(some.column(c).to_pylist() for c in range(3))))
                z = np.clip(net.logits(Sample.of(windows)), -LARGEST, LARGEST)
                yield pa.RecordBatch.from_arrays(
                    [some.column(3), pa.array(_keyed(windows)), pa.array(np.floor(z * STEPS).astype(np.int32))], ["label", "keyed", "step"])

    return run


def labelled(docs: DataFrame, *, text: str = "text", max_findings: int | None = None, seed: int = 5) -> DataFrame:
    """Different labelled findings of the corpus, all or at most ``max_findings`` of each label, stored."""
    rows = docs.select(text_of(text).alias("text")).where(F.col("text") != "")
    found = rows.mapInArrow(corpus_findings(max_findings, seed), "key long, before string, value string, after string, label int")
    # copies of a window count once, as its secret if it is one somewhere
    found = stored(found.groupBy("key", "before", "value", "after").agg(F.max("label").alias("label")), "findings")
    if max_findings is None:
        return found
    parts = [found.where(F.col("label") == y).orderBy("key").limit(max_findings) for y in (0, 1)]
    return stored(parts[0].unionAll(parts[1]), "some-findings")


def fit(docs: DataFrame, *, text: str = "text", max_findings: int | None = None, max_weight: int = MAX_WEIGHT, recall: float = RECALL,
        seed: int = 5) -> Network:
    """A network from the made table and all labelled findings of the corpus, or from ``max_findings`` of each label if that is given."""
    found = labelled(docs, text=text, max_findings=max_findings, seed=seed)
    apart = F.col("key") % 3 == 0
    number = {(r["label"], r["apart"]): r["count"] for r in found.groupBy("label", apart.alias("apart")).count().collect()}
    made = Labelled.of(made_findings(), seed)
    state, step = made.trained(seed)
    own = [sum(number.get((y, a), 0) for a in (False, True)) for y in (0, 1)]
    weights = [min(1.0, max_weight / max(n, 1)) for n in own]
    n_parts = -(-sum(number.get((y, False), 0) for y in (0, 1)) // PART)
    dealt = found.where(~apart).withColumn("part", F.expr("key div 3") % max(n_parts, 1))
    n_rounds = min(ROUNDS, n_parts)
    for k in range(n_rounds):
        # a part stands for the whole corpus; decimals add up to the same in any order
        walk = _walked(made, state, step, (weights[0] * n_parts, weights[1] * n_parts), seed)
        some = dealt.where(F.col("part") % n_rounds == k).repartition(-(-n_parts // n_rounds), "part").groupBy("part").applyInArrow(walk, "at long, value double, first double, second double")
        mean = [F.avg(F.col(c).cast("decimal(30,18)")).cast("double").alias(c) for c in ("value", "first", "second")]
        rows = some.groupBy("at").agg(*mean).toArrow().sort_by("at")
        if len(rows):
            state = np.stack([rows.column(c).to_numpy() for c in ("value", "first", "second")])
    net = _network(state[0])
    counts = found.where(apart).select("before", "value", "after", "label").mapInArrow(_outputs(net), "label int, keyed boolean, step int")
    counts = sorted(tuple(r) for r in counts.groupBy("label", "keyed", "step").count().collect())
    label, keyed, z, n = np.array(counts, float).reshape(-1, 4).T
    pairs = [(net.logits(Sample.of(made.rest)), z / STEPS), (made.rest_label, label), (_keyed(made.rest), keyed > 0),
             (np.ones(len(made.rest)), n * np.array(weights)[label.astype(int)])]
    return calibrate(net, *map(np.concatenate, pairs), recall)


def fitted(findings: list[tuple[str, str, str, int]], recall: float = RECALL, seed: int = 5) -> Network:
    """A network from these findings alone."""
    made = Labelled.of(findings, seed)
    net = _network(made.trained(seed)[0][0])
    return calibrate(net, net.logits(Sample.of(made.rest)), made.rest_label, _keyed(made.rest), np.ones(len(made.rest)), recall)


FOUND = "array<struct<start:long, kind:int, end:long, score:double>>"


def scan(docs: DataFrame, net: Network, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and findings of every row: start, kind (by place in ``KINDS``), end and the network's score."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            model, texts = shared.value, batch.column(1).to_pylist()
            spans, found = [base_spans(t) for t in texts], [candidates(t) for t in texts]
            # every pattern's finding and candidate, in slices of bounded length
            jobs = [(d, a, b, k, False) for d, s in enumerate(spans) for a, k, b in s]
            for d, own in enumerate(found):
                free = ~overlapping([(a, b) for a, b, _ in own], [(a, b) for a, _, b in spans[d]])
                jobs += [(d, a, b, 3, keyed) for (a, b, keyed), ok in zip(own, free) if ok]
            out: list[list[dict]] = [[] for _ in texts]
            at = 0
            while at < len(jobs):
                stop, size = at, 0
                while stop < len(jobs) and (stop == at or size < 1 << 18):
                    size, stop = size + jobs[stop][2] - jobs[stop][1] + LEFT + RIGHT + 4, stop + 1
                some = jobs[at:stop]
                for (d, a, b, k, keyed), p in zip(some, model.probability(Sample.of([_window(texts[d], a, b) for d, a, b, _, _ in some])).tolist()):
                    if k < 3 or p >= model.thresholds[keyed]:
                        out[d].append({"start": a, "kind": k, "end": b, "score": p})
                at = stop
            for o in out:
                o.sort(key=lambda f: (f["start"], f["kind"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], ["doc_id", "findings"])

    return docs.select(F.col(id).cast("long").alias("doc_id"), text_of(text).alias("text")).mapInArrow(run, f"doc_id long, findings {FOUND}")


def listed(findings: Column) -> Column:
    """kind:start:end of findings, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", F.get(names, f["kind"]), f["start"].cast("string"), f["end"].cast("string"))), ",")


def digests(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, counts of the patterns' findings, the digest of these, and all findings listed."""
    found = F.col("findings")
    count = lambda k: F.size(F.filter(found, lambda f: f["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return scan(docs, net).select(
        "doc_id", *(count(k) for k in range(3)), F.sha2(listed(F.filter(found, lambda f: f["kind"] < 3)), 256).alias("base_sha256"),
        listed(found).alias("spans"), count(3))
