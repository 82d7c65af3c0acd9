"""Quality rules: exact repetition counts, and a hashed n-gram logistic regression with calibrated output.

The regression is trained in numpy on a bounded sample of labelled rows (``per_label`` of each class), its
output is mapped to probabilities by a logistic fit on rows kept out of training, and documents are scored
in Arrow batches against fixed thresholds.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.llm import hashed, kernel

SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEATED_PERCENT, WINDOW = 10, 20, 5
KEEP_FROM = 0.5
SCALE = 100.0


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    shift: float
    bits: int
    trained: bool


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic map, by Newton steps on softened targets."""
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * z + b)
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - target) * z).sum(), (p - target).sum()]) + 1e-3 * np.array([a - 1, b])
        h = np.array([[(w * z * z).sum(), (w * z).sum()], [(w * z).sum(), w.sum()]]) + 1e-3 * np.eye(2)
        d = np.linalg.solve(h, g)
        a, b = a - d[0], b - d[1]
        if abs(d).max() < 1e-9:
            break
    return float(a), float(b)


def train(docs: DataFrame, labels: DataFrame, per_label: int = 1500, bits: int = 15, epochs: int = 25, rate: float = 0.5,
          seed: int = 11) -> Model:
    """Fit on at most ``per_label`` rows of each quality value 0 and 1; null ids, texts or labels are left out.

    If either class has no row the model is untrained and keeps what the base rules keep.
    """
    voted = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(
        F.max("quality").cast("int").alias("__quality"))
    rows = hashed.training_bags(docs.select("doc_id", "text"), "__quality", per_label, hashed.Features(bits, fold=False), voted)
    y = np.array([r["label"] for r in rows], float)
    if not rows or y.min() == y.max():
        return Model(np.zeros(1 << bits), 0.0, 1.0, 0.0, bits, False)
    idx, share, off = hashed.ragged(rows)
    share = SCALE * share
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    held, fit = order[:len(order) // 5], order[len(order) // 5:].copy()
    w, seen, bias = np.zeros(1 << bits), np.full(1 << bits, 1e-2), 0.0
    for _ in range(epochs):
        rng.shuffle(fit)
        for at in range(0, len(fit), 32):
            pick = fit[at:at + 32]
            i, s, r = hashed.batch_of(pick, idx, share, off)
            e = _sigmoid(np.bincount(r, w[i] * s, len(pick)) + bias) - y[pick]
            touched, inverse = np.unique(i, return_inverse=True)
            g = np.bincount(inverse, s * e[r], len(touched)) / len(pick)
            seen[touched] += g * g
            w[touched] -= rate * 0.1 * (g / np.sqrt(seen[touched]) + 1e-3 * w[touched])
            bias -= rate * 0.1 * e.mean()
    check = held if len(held) and y[held].min() != y[held].max() else order
    i, s, r = hashed.batch_of(check, idx, share, off)
    slope, shift = _platt(np.bincount(r, w[i] * s, len(check)) + bias, y[check])
    return Model(w * SCALE, float(bias), slope, shift, bits, True)


def counts(data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """Per text: words, code points in words, symbols, repeated lines, words in repeated windows."""
    n = len(off) - 1
    start, end, first = kernel.words(data, off)
    n_words = np.diff(first)
    inside = ~kernel.SPACE[data]
    chars = kernel.per_text((inside & ((data & 0xC0) != 0x80)).astype(np.int64), off)
    symbol = np.zeros(256, np.int64)
    symbol[list(SYMBOLS)] = 1
    n_symbols = kernel.per_text(symbol[data], off)
    running = kernel.prefix(data)
    hashes = kernel.span_hash(running, start, end)

    # lines with a word: from the text's start or past a newline up to the next newline or the text's end
    is_break = data == 10
    cuts = np.flatnonzero(is_break)
    begin = np.sort(np.concatenate([off[:-1], cuts + 1]))
    text_of = np.searchsorted(off, begin, "right") - 1
    ok = begin < off[np.minimum(text_of + 1, n)]
    begin, text_of = begin[ok], text_of[ok]
    begin, at = np.unique(begin, return_index=True)
    text_of = text_of[at]
    nxt = np.append(cuts, len(data))[np.searchsorted(cuts, begin)]
    stop = np.minimum(nxt, off[text_of + 1])
    has = np.searchsorted(start, stop) > np.searchsorted(start, begin)
    begin, stop, text_of = begin[has], stop[has], text_of[has]
    line = kernel.span_hash(running, begin, stop)
    n_dup = np.bincount(text_of, minlength=n) - _distinct(line, text_of, n)

    repeated = np.zeros(n, np.int64)
    window = kernel.window_hash(hashes, WINDOW)
    if len(window):
        owner = np.repeat(np.arange(n), n_words)
        whole = owner[:len(window)] == owner[WINDOW - 1:]
        at = np.flatnonzero(whole)
        key = kernel.mix(window[at] ^ (owner[at].astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB)))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        cover = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(cover, at[twice], 1)
        np.add.at(cover, at[twice] + WINDOW, -1)
        repeated = kernel.per_text((np.cumsum(cover)[:-1] > 0).astype(np.int64), first)
    return [n_words, chars, n_symbols, n_dup, repeated]


def _distinct(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    return np.bincount(o[new], minlength=n)


def judge(docs: DataFrame, model: Model, keep_from: float = KEEP_FROM) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, good (probability).

    One row per input row; a null or empty text has no words and fails the base rules.
    """
    weights, bits, trained, m = [model.weights], model.bits, model.trained, model

    def make():
        features = hashed.Features(bits, fold=False)

        def score(data, off, null):
            raw = features.means(weights, data, off)[:, 0] + m.bias
            good = _sigmoid(m.slope * raw + m.shift) if trained else np.ones(len(off) - 1)
            return [*counts(data, off), good]

        return score

    got = kernel.map_texts(docs, make, "n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                                       "n_repeat_words long, good double")
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT)
    return got.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("good") >= keep_from)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "good")


def kept_rows(docs: DataFrame, model: Model, keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of ``docs``, all columns, that ``judge`` keeps."""
    weights, bits, trained, m = [model.weights], model.bits, model.trained, model

    def make():
        features = hashed.Features(bits, fold=False)

        def verdict(data, off, null):
            n_words, _, _, _, repeated = counts(data, off)
            good = _sigmoid(m.slope * (features.means(weights, data, off)[:, 0] + m.bias) + m.shift) if trained else 1.0
            return (n_words >= MIN_WORDS) & (repeated * 100 <= n_words * MAX_REPEATED_PERCENT) & (good >= keep_from)

        return verdict

    return docs.where(kernel.text_column(make, "boolean")(F.col("text")))
