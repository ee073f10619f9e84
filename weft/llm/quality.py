"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad.  A line's evidence is its own features and those of the lines before and after it, each in
bins; neighbouring labels are coupled.  Training lines take their document's label.  Forward-backward gives each
line's probability of being good; their mean, weighted by line length, is calibrated on the training documents into
the score.

Features are counted for all lines of a batch at once on the text's bytes, and the recursions run over all documents
of a batch at once, line by line.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import held_out_row, lowest_by_hash, train_row

SAMPLE_DOCS = 1500  # training documents a label, the lowest by a hash of their id
SAMPLE_LINES = 200_000  # and their lines together: documents that would exceed them are passed over
BINS = 8
FEATURES = 13
ROUNDS = 250
THRESHOLD = 0.7
SLICE_BYTES = 2 << 20
SCHEMA = "doc_id long, held_out boolean, score double, predicted int, n_lines long, good_lines long"

#: Byte classes of the line features.
_LOWER, _UPPER, _DIGIT, _SPACE, _STOP, _BANG, _PIPE, _OTHER, _HIGH = range(9)


def _byte_classes() -> np.ndarray:
    kind = np.full(256, _OTHER, np.uint8)
    kind[ord("a") : ord("z") + 1] = _LOWER
    kind[ord("A") : ord("Z") + 1] = _UPPER
    kind[ord("0") : ord("9") + 1] = _DIGIT
    kind[[9, 11, 12, 13, 32]] = _SPACE
    kind[[ord(c) for c in ".,;:?'\"()-"]] = _STOP
    kind[ord("!")] = _BANG
    kind[ord("|")] = _PIPE
    kind[128:] = _HIGH
    return kind


KIND = _byte_classes()
TOKEN_OF = np.random.default_rng(7).integers(1, 1 << 62, 256, dtype=np.int64).astype(np.uint64)


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features by line, line lengths, lines by text) of whole texts cut at line feeds."""
    x = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.flatnonzero(x == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    length = ends - starts
    per_text = np.array([t.count(b"\n") + 1 for t in texts])
    kind = KIND[x]
    kind[ends] = 255
    counts = np.stack([np.add.reduceat(kind == k, starts, dtype=np.int64) for k in range(9)], 1).astype(np.float32)
    # words: runs without white space; a word's token is the sum of its bytes' tokens
    gap = (kind == _SPACE) | (kind == 255)
    first = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
    words = np.zeros(len(ends), np.float32)
    repeats, again, distance = words.copy(), words.copy(), words.copy()
    if len(first):
        token = np.add.reduceat(np.where(gap, np.uint64(0), TOKEN_OF[x]), first)
        line = np.searchsorted(ends, first)
        n = len(ends)
        words = np.bincount(line, minlength=n).astype(np.float32)
        same = lambda lag: np.bincount(line[lag:][(token[lag:] == token[:-lag]) & (line[lag:] == line[:-lag])], minlength=n)
        repeats, again = same(1).astype(np.float32), same(2).astype(np.float32)
        stops = (kind[np.minimum(np.concatenate([first[1:], [len(x)]]) - 2, len(x) - 1)] >= _STOP) & (line >= 0)
        distance = np.bincount(line[stops], minlength=n).astype(np.float32)
    size = np.maximum(length, 1).astype(np.float32)
    n_words = np.maximum(words, 1)
    share = counts / size[:, None]
    features = np.column_stack([
        np.log1p(length), words, share[:, _LOWER] + share[:, _HIGH], share[:, _UPPER], share[:, _DIGIT], share[:, _STOP],
        share[:, _BANG], share[:, _PIPE], share[:, _OTHER], repeats / n_words, again / n_words, length / n_words, distance / n_words,
    ])
    return features.astype(np.float32), length, per_text


@dataclass
class Model:
    edges: np.ndarray  # FEATURES x (BINS - 1)
    weights: np.ndarray  # 3 x FEATURES x (BINS + 1): this line, the one before, the one after; last bin: no such line
    bias: float
    coupling: np.ndarray  # 2 x 2, log potentials of neighbouring labels
    scale: float
    shift: float


def _bins(features: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(edges[f], features[:, f], side="right") for f in range(features.shape[1])], 1)


def _around(bins: np.ndarray, per_text: np.ndarray) -> list[np.ndarray]:
    """Bins of each line, of the line before and of the line after."""
    begin = np.concatenate([[0], np.cumsum(per_text)[:-1]])
    last = begin + per_text - 1
    before, after = np.roll(bins, 1, 0), np.roll(bins, -1, 0)
    before[begin], after[last] = BINS, BINS
    return [bins, before, after]


def _evidence(around: list[np.ndarray], weights: np.ndarray, bias: float) -> np.ndarray:
    out = np.full(len(around[0]), bias)
    for k, bins in enumerate(around):
        for f in range(bins.shape[1]):
            out += weights[k, f][bins[:, f]]
    return out


def _messages(u: np.ndarray, per_text: np.ndarray, coupling: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward log-odds with a line's own evidence, and backward log-odds without it."""
    order = np.argsort(-per_text, kind="stable")
    begin = np.concatenate([[0], np.cumsum(per_text)[:-1]])[order]
    n = per_text[order]
    ends = begin + n - 1
    c = coupling
    forward, backward = u.copy(), np.zeros_like(u)
    for t in range(1, int(n.max(initial=0))):
        active = int(np.searchsorted(-n, -t, side="left"))  # texts of more than t lines
        at = begin[:active] + t
        z = forward[at - 1]
        forward[at] = u[at] + np.logaddexp(z + c[1, 1], c[0, 1]) - np.logaddexp(z + c[1, 0], c[0, 0])
        at = ends[:active] - t
        z = u[at + 1] + backward[at + 1]
        backward[at] = np.logaddexp(z + c[1, 1], c[1, 0]) - np.logaddexp(z + c[0, 1], c[0, 0])
    return forward, backward


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def _weighted(good: np.ndarray, length: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    begin = np.concatenate([[0], np.cumsum(per_text)[:-1]])
    w = length + 1.0
    return np.add.reduceat(good * w, begin) / np.add.reduceat(w, begin)


def fit(features: np.ndarray, length: np.ndarray, per_text: np.ndarray, label: np.ndarray) -> Model:
    """Penalised maximum likelihood by gradient steps (Adam) over all chains at once, then the calibration."""
    edges = np.quantile(features, np.arange(1, BINS) / BINS, axis=0).T + 1e-6
    # shares are mostly 0: half of the edges go to what lies above
    for f in range(features.shape[1]):
        above = features[features[:, f] > 1e-6, f]
        if len(above) and (edges[f] <= 2e-6).sum() > 1:
            edges[f] = np.concatenate([[1e-6], np.quantile(above, np.arange(1, BINS - 1) / (BINS - 1))])
    around = _around(_bins(features, edges), per_text)
    y = np.repeat(label, per_text).astype(float)
    joined = np.repeat(np.arange(len(per_text)), per_text)
    pair = np.flatnonzero(joined[1:] == joined[:-1])
    text_weight = np.repeat(1 / np.sqrt(per_text), per_text)  # a long text counts less a line
    m = Model(edges, np.zeros((3, features.shape[1], BINS + 1)), 0.0, np.zeros((2, 2)), 1.0, 0.0)
    state = [np.zeros_like(m.weights), np.zeros_like(m.weights), np.zeros(5), np.zeros(5)]
    total = text_weight.sum()
    for step in range(1, ROUNDS + 1):
        u = _evidence(around, m.weights, m.bias)
        fwd, bwd = _messages(u, per_text, m.coupling)
        p = _sigmoid(fwd + bwd)
        off = (y - p) * text_weight / total
        g = np.stack([np.stack([np.bincount(b[:, f], off, BINS + 1) for f in range(b.shape[1])]) for b in around]) - 1e-4 * m.weights
        # expected pairs: message before, coupling, evidence and message after
        right = u[pair + 1] + bwd[pair + 1]
        logs = np.stack([fwd[pair] * a + m.coupling[a, b] + right * b for a in (0, 1) for b in (0, 1)])
        q = np.exp(logs - np.logaddexp.reduce(logs, 0))
        seen = np.stack([(y[pair] == a) & (y[pair + 1] == b) for a in (0, 1) for b in (0, 1)])
        small = np.concatenate([[off.sum()], ((seen - q) * text_weight[pair]).sum(1) / total - 0.02 * m.coupling.ravel()])
        for k, grad in ((0, g), (2, small)):
            state[k] = 0.9 * state[k] + 0.1 * grad
            state[k + 1] = 0.99 * state[k + 1] + 0.01 * grad**2
        move = lambda k: 0.05 * (state[k] / (1 - 0.9**step)) / (np.sqrt(state[k + 1] / (1 - 0.99**step)) + 1e-8)  # noqa: B023, E731
        m.weights += move(0)
        m.bias += move(2)[0]
        m.coupling += move(2)[1:].reshape(2, 2)
    mean = _weighted(marginals(m, around, per_text), length, per_text)
    z = np.log(np.clip(mean, 1e-4, 1 - 1e-4) / np.clip(1 - mean, 1e-4, 1))
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps of the calibrating logistic regression, slightly ridged
        p = _sigmoid(a * z + b)
        v = p * (1 - p) + 1e-9
        h = np.array([[(v * z * z).sum() + 1e-2, (v * z).sum()], [(v * z).sum(), v.sum() + 1e-2]])
        d = np.linalg.solve(h, np.array([((label - p) * z).sum() - 1e-2 * (a - 1), (label - p).sum() - 1e-2 * b]))
        a, b = a + np.clip(d[0], -1, 1), b + np.clip(d[1], -1, 1)
    m.scale, m.shift = max(float(a), 1e-3), float(b)
    return m


def marginals(m: Model, around: list[np.ndarray], per_text: np.ndarray) -> np.ndarray:
    fwd, bwd = _messages(_evidence(around, m.weights, m.bias), per_text, m.coupling)
    return _sigmoid(fwd + bwd)


def score_texts(m: Model, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(score, number of lines, number of good lines) of each text."""
    features, length, per_text = line_features(texts)
    good = marginals(m, _around(_bins(features, m.edges), per_text), per_text)
    mean = np.clip(_weighted(good, length, per_text), 1e-4, 1 - 1e-4)
    begin = np.concatenate([[0], np.cumsum(per_text)[:-1]])
    return _sigmoid(m.scale * np.log(mean / (1 - mean)) + m.shift), per_text, np.add.reduceat(good >= 0.5, begin, dtype=np.int64)


def learn(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model from at most SAMPLE_DOCS training rows and SAMPLE_LINES lines a label; None unless both labels are there.

    Ids whose label rows disagree are not learned from.  What reaches the driver is the line features of the sample, 60
    bytes a line.
    """
    label = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & train_row(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("quality").cast("int").alias("y"), F.max("quality").cast("int").alias("other")).where("y = other")
    )
    ids = docs.select("doc_id").distinct()
    chosen = lowest_by_hash(label.join(ids, "doc_id", "left_semi").select("doc_id", "y"), "y", "doc_id", SAMPLE_DOCS, 7)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id", "y")), "doc_id")  # 2 * SAMPLE_DOCS ids
    sample = lowest_by_hash(sample, "y", "doc_id", SAMPLE_DOCS, 7)  # again, as rows may repeat an id
    lines = F.regexp_count(F.coalesce("text", F.lit("")), F.lit("\n")) + 1
    upto = F.sum(lines).over(Window.partitionBy("y").orderBy(F.xxhash64(F.lit(7), "doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    sample = sample.where(lines <= SAMPLE_LINES).withColumn("upto", upto).where(F.col("upto") <= SAMPLE_LINES)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, y in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "y")), strict=True):
                f, length, _ = line_features([(text or "").encode()])
                out.append((doc_id, y, f.astype("<f4").tobytes(), length.astype("<i8").tobytes()))
            if out:
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "y", "f", "length"])

    rows = sample.mapInArrow(features, "doc_id long, y int, f binary, length binary").collect()
    rows = sorted((r.doc_id, r.y, bytes(r.f), bytes(r.length)) for r in rows)
    if len({r[1] for r in rows}) < 2:
        return None
    f = np.concatenate([np.frombuffer(r[2], "<f4").reshape(-1, FEATURES) for r in rows])
    lengths = [np.frombuffer(r[3], "<i8") for r in rows]
    return fit(f, np.concatenate(lengths), np.array([len(x) for x in lengths]), np.array([r[1] for r in rows]))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_lines, good_lines) of every row, from its whole text alone.

    Null is scored like the empty text, which is one empty line.  Without both labels to learn from every score is 0.5.
    Repeated rows are scored each; an empty table gives an empty result; clashing extra columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))  # some kilobytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def judged(ids: list, texts: list[bytes]) -> pa.RecordBatch:
            if model.value is None:
                score, lines, good = np.full(len(ids), 0.5), np.array([t.count(b"\n") + 1 for t in texts]), np.zeros(len(ids), np.int64)
            else:
                score, lines, good = score_texts(model.value, texts)
            columns = [pa.array(ids, pa.int64()), pa.array(score, pa.float64()), pa.array(lines, pa.int64()), pa.array(good, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "n_lines", "good_lines"])

        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids.append(doc_id)
                texts.append(text.as_buffer().to_pybytes() if text.is_valid else b"")
                size += len(texts[-1])
                if size > SLICE_BYTES:
                    yield judged(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield judged(ids, texts)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, n_lines long, good_lines long")
    return rows.select(
        "doc_id", held_out_row(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_lines", "good_lines",
    )
