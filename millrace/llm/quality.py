"""Document quality by a linear-chain conditional random field over lines (operator 4).

Every line is labelled good (1) or bad (0). Its features are shares of byte classes, word
lengths, class changes and repeated words, of the line itself and of both neighbours; transition weights join
the labels of neighbouring lines. The field is fitted on documents with a known quality, whose
lines all carry the document's label, by the gradient of the conditional likelihood. The score
of a document is the mean marginal probability of `good` by forward and backward passes,
weighted by the bytes of the lines.

Fitted on at most `sample` labelled documents, those whose key has the smallest hash, of at
most `sample_lines` lines each; every document is scored, whole. Labels and keys choose the
sample and are no inputs of a score.

Defined cases: null and empty texts are one empty line; without labelled documents of both
kinds nothing can be learnt and every score is 0.5; a key with several labels takes the
largest; all columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from millrace.llm.words import chunks, stretches, word_hashes
from millrace.session import materialize

LOWER, UPPER, DIGIT, BLANK, BAR, STOP, CRY, SIGN, HIGH, OTHER = range(10)
CLASSES = 10
STRETCH_BYTES = 1_000_000


def _byte_classes() -> np.ndarray:
    table = np.full(256, OTHER, np.uint8)
    table[33:127] = SIGN
    table[ord("a") : ord("z") + 1], table[ord("A") : ord("Z") + 1] = LOWER, UPPER
    table[ord("0") : ord("9") + 1], table[128:] = DIGIT, HIGH
    table[[9, 32]], table[ord("|")] = BLANK, BAR
    table[[ord(c) for c in ".,;:'\"-?"]], table[ord("!")] = STOP, CRY
    return table


TABLE = _byte_classes()


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Base features of all lines, bytes of each line, and lines of each text."""
    raws = [(t or "").encode() for t in texts]
    per_text = np.array([r.count(b"\n") + 1 for r in raws])
    data = np.frombuffer(b"\n".join(raws), np.uint8)
    n = int(per_text.sum())
    counts, changes, again = np.zeros(n * CLASSES), np.zeros(n * 2), np.zeros(n)
    line, last, last_word, last_line = 0, -1, np.uint64(0), -1
    for at, to in chunks(data):
        part = data[at:to]
        ends = part == 10
        own = line + np.cumsum(ends) - ends
        kind = TABLE[part]
        counts += np.bincount(own[~ends] * CLASSES + kind[~ends], minlength=n * CLASSES)
        before = np.concatenate([[last], kind[:-1]])
        word = (before == LOWER) | (before == UPPER) | (before == HIGH)
        changes[0::2] += np.bincount(own[word & ((kind == SIGN) | (kind == CRY))], minlength=n)
        changes[1::2] += np.bincount(own[(before == LOWER) & (kind == UPPER)], minlength=n)
        starts, hashes = word_hashes(part)
        if len(starts):
            lines = own[starts]
            same = (hashes == np.concatenate([[last_word], hashes[:-1]])) & (lines == np.concatenate([[last_line], lines[:-1]]))
            again += np.bincount(lines[same], minlength=n)
            last_word, last_line = hashes[-1], int(lines[-1])
        line += int(ends.sum())
        last = int(kind[-1])
    counts, changes = counts.reshape(n, CLASSES), changes.reshape(n, 2)
    size = counts.sum(axis=1)
    letters = counts[:, LOWER] + counts[:, UPPER] + counts[:, HIGH]
    words = counts[:, BLANK] + 1
    share = counts / np.maximum(size, 1)[:, None]
    rates = np.column_stack([counts[:, UPPER] / np.maximum(letters, 1), *(changes / words[:, None]).T, counts[:, CRY] / words, counts[:, BAR] / words, counts[:, SIGN] / words, counts[:, DIGIT] / words, counts[:, STOP] / words, again / words])
    base = np.column_stack([share, rates, np.minimum(1, 8 * rates), np.log1p(size), letters / words / 10, size == 0])
    return base, size, per_text


def with_neighbours(base: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Each line's features, its neighbours' (zero where there is none), and its place."""
    ends = np.cumsum(per_text)
    first, final = np.zeros(len(base), bool), np.zeros(len(base), bool)
    first[ends - per_text], final[ends - 1] = True, True
    before, after = np.roll(base, 1, axis=0), np.roll(base, -1, axis=0)
    before[first], after[final] = 0, 0
    return np.column_stack([base, before, after, first, final, np.ones(len(base))])


@dataclass
class LineField:
    """Weights of the label `good`, and transition weights from label i to label j."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    moves: np.ndarray

    def marginals(self, base: np.ndarray, per_text: np.ndarray) -> np.ndarray:
        """Probability of `good` of every line."""
        x = with_neighbours((base - self.mean) / self.scale, per_text)
        return _passes(x @ self.weights, self.moves, per_text)[0]


def _passes(unary: np.ndarray, moves: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of `good`, and expected counts of the moves. All texts go through the
    recursions together, line by line, the longest first; every step is normalised."""
    order = np.argsort(-per_text, kind="stable")
    starts = (np.cumsum(per_text) - per_text)[order]
    lengths, top = per_text[order], int(per_text.max(initial=0))
    open_ = np.searchsorted(-lengths, -np.arange(1, top + 1), "right")  # texts with a line t
    u = np.clip(unary, -30, 30)
    psi = np.column_stack([np.exp(-u / 2), np.exp(u / 2)])
    psi /= psi.sum(axis=1, keepdims=True)
    step = np.exp(moves)
    alpha, beta = np.empty_like(psi), np.ones_like(psi)
    for t in range(top):
        at = starts[: open_[t]] + t
        now = psi[at] if t == 0 else (alpha[at - 1] @ step) * psi[at]
        alpha[at] = now / now.sum(axis=1, keepdims=True)
    counts = np.zeros((2, 2))
    for t in range(top - 2, -1, -1):
        at = starts[: open_[t + 1]] + t
        ahead = psi[at + 1] * beta[at + 1]
        back = ahead @ step.T
        beta[at] = back / back.sum(axis=1, keepdims=True)
        pair = alpha[at][:, :, None] * step[None] * ahead[:, None, :]
        counts += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    good = alpha * beta
    return good[:, 1] / good.sum(axis=1), counts


def fit_field(base: np.ndarray, per_text: np.ndarray, labels: np.ndarray, rounds: int = 150, ridge: float = 1e-3, rate: float = 0.1) -> LineField:
    """Maximise the conditional likelihood of the line labels by Adam."""
    mean, scale = base.mean(axis=0), base.std(axis=0) + 1e-3
    field = LineField(mean, scale, np.zeros(3 * base.shape[1] + 3), np.zeros((2, 2)))
    if len(np.unique(labels)) < 2:
        return field
    x = with_neighbours((base - mean) / scale, per_text)
    y = np.repeat(labels.astype(float), per_text)
    seen = np.zeros((2, 2))
    for label in (0, 1):
        seen[label, label] = (per_text[labels == label] - 1).sum()
    n, size = len(y), field.weights.size
    theta = np.zeros(size + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for i in range(1, rounds + 1):
        weights, moves = theta[:size], theta[size:].reshape(2, 2)
        p, counts = _passes(x @ weights, moves, per_text)
        gradient = np.concatenate([x.T @ (y - p), (seen - counts).ravel()]) / n - ridge * theta
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        theta = theta + rate * (first / (1 - 0.9**i)) / (np.sqrt(second / (1 - 0.999**i)) + 1e-8)
    field.weights, field.moves = theta[:size], theta[size:].reshape(2, 2)
    return field


def fit_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = 3_000, sample_lines: int = 2_000, most_lines: int = 200_000) -> LineField:
    """Fit on the labelled documents of `labels` (key, label), which should hold training rows only:
    in the order of a hash, up to `sample` documents of up to `sample_lines` lines each, as long as
    they have `most_lines` together. That bounds what the driver holds, about 150 MB."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(key).alias("own")).agg(F.max(label).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("own"), "own").limit(sample)  # the bound of the broadcast
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(chosen), F.col("key") == F.col("own"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, found = [], []
            for k, y, t in zip(*(batch.column(c).to_pylist() for c in ("key", "label", "text")), strict=True):
                base, _, per_text = line_features([t])
                if per_text[0] <= sample_lines:
                    found.append((y, base.astype("<f4").tobytes(), int(per_text[0])))
                    keys.append(k)
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys, batch.schema.field("key").type), "label": pa.array([f[0] for f in found], pa.int32()), "base": pa.array([f[1] for f in found], pa.binary()), "lines": pa.array([f[2] for f in found], pa.int64())})

    kind = rows.schema["key"].dataType.simpleString()
    order = [F.xxhash64("key"), F.col("key"), F.xxhash64("base"), F.col("base")]
    drawn = rows.mapInArrow(extract, f"key {kind}, label int, base binary, lines long").orderBy(*order).limit(sample)  # a key may repeat
    so_far = F.sum("lines").over(Window.orderBy(*order))
    got = materialize(drawn, "line-sample").withColumn("so_far", so_far).where(F.col("so_far") <= most_lines)
    got = sorted(got.select("key", "label", "base").toLocalIterator(), key=lambda r: (r["key"], r["base"]))
    width = line_features([""])[0].shape[1]
    parts = [np.frombuffer(r["base"], "<f4").reshape(-1, width) for r in got]
    if not parts:
        return LineField(np.zeros(width), np.ones(width), np.zeros(3 * width + 3), np.zeros((2, 2)))
    return fit_field(np.concatenate(parts).astype(float), np.array([len(p) for p in parts]), np.array([r["label"] for r in got]))


def score_quality(docs: DataFrame, field: LineField, text: str = "text", out: str = "score") -> DataFrame:
    """All columns and the score, a double from 0 to 1."""
    if out in docs.columns:
        raise ValueError(f"the table already has a column {out}")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, own in stretches(batch.column(text), STRETCH_BYTES):
                base, size, per_text = line_features(own)
                good = field.marginals(base, per_text)
                weight = size + 1e-9  # lines without bytes count only among themselves
                starts = np.cumsum(per_text) - per_text
                value = np.add.reduceat(good * weight, starts) / np.add.reduceat(weight, starts)
                yield batch.slice(at, len(own)).append_column(out, pa.array(np.clip(value, 0, 1)))

    return docs.mapInArrow(score, StructType([*docs.schema.fields, StructField(out, DoubleType())]))
