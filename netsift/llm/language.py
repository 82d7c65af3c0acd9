"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the mean of the embeddings of its hashed words and byte n-grams; a softmax layer on that mean
gives the language.  Training is stochastic gradient descent in numpy on a bounded, documented sample of
labelled rows (``per_lang`` rows of each language).  A temperature fitted on rows kept out of training
calibrates the probabilities.

Softmax only compares the languages it knows, so rejection looks at what it cannot see: the mean log
likelihood of a text's features under the features of the language it was given, as a distance from what texts of that
language and length have.  The largest distance that loses a share ``lost`` of the rows kept out of training is the threshold.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.llm import hashed, kernel

UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    table: np.ndarray  # buckets x languages: embedding times output layer
    bias: np.ndarray
    temperature: float
    threshold: float     # largest accepted distance
    bits: int
    likelihood: np.ndarray   # buckets x languages: log share of a bucket among the features of a language
    usual: np.ndarray        # per language: mean log likelihood, variance between texts, variance within a text per feature


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _descend(idx, share, off, y, n_langs, bits, dim, epochs, rate, seed):
    """Embeddings, output layer and bias by mini-batch gradient descent with a step size per parameter."""
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 1, (1 << bits, dim))
    out, bias = np.zeros((dim, n_langs)), np.zeros(n_langs)
    emb_seen, out_seen = np.full(1 << bits, 1e-6), np.full((dim, n_langs), 1e-6)
    rows = np.arange(len(y))
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        rng.shuffle(rows)
        for at in range(0, len(rows), 32):
            pick = rows[at:at + 32]
            i, s, r = hashed.batch_of(pick, idx, share, off)
            x = np.stack([np.bincount(r, emb[i, k] * s, len(pick)) for k in range(dim)], axis=1)
            g = softmax(x @ out + bias)
            g[np.arange(len(pick)), y[pick]] -= 1
            g /= len(pick)
            back = g @ out.T
            g_out = x.T @ g
            out_seen += g_out * g_out
            out -= step * g_out / np.sqrt(out_seen)
            bias -= step * g.sum(axis=0)
            touched, inverse = np.unique(i, return_inverse=True)
            g_emb = np.stack([np.bincount(inverse, s * back[r, k], len(touched)) for k in range(dim)], axis=1)
            emb_seen[touched] += (g_emb * g_emb).mean(axis=1)
            emb[touched] -= step * g_emb / np.sqrt(emb_seen[touched])[:, None]
    return emb, out, bias


def _likelihood(idx, share, off, y, n_langs: int, bits: int) -> np.ndarray:
    """Log share of every bucket in each language; every bucket gets a hundredth of one text's share beside the rest."""
    out = np.empty((1 << bits, n_langs))
    size = np.diff(off)
    for k in range(n_langs):
        mine = np.repeat(y == k, size)
        mass = np.bincount(idx[mine], share[mine], 1 << bits) + 0.01 / (1 << bits)
        out[:, k] = np.log(mass / mass.sum())
    return out


def distance(mean: np.ndarray, features: np.ndarray, lang: np.ndarray, usual: np.ndarray) -> np.ndarray:
    """How far below its language's usual likelihood a text lies, in standard deviations for its length."""
    spread = np.sqrt(usual[lang, 1] + usual[lang, 2] / np.maximum(features, 1))
    return (usual[lang, 0] - mean) / np.maximum(spread, 1e-9)


def train(docs: DataFrame, lang: str = "lang", per_lang: int = 400, bits: int = 13, dim: int = 12, epochs: int = 6,
          rate: float = 0.3, lost: float = 0.001, margin: float = 1.5, seed: int = 7) -> Model:
    """Fit on at most ``per_lang`` rows of each non-null language (a bounded sample); null ids and texts are left out.

    The threshold is ``margin`` times the distance that loses a share ``lost`` of the rows kept out of training, a fifth of all.

    With no usable row the model knows no language and answers ``und`` everywhere.
    """
    rows = hashed.training_bags(docs, lang, per_lang, hashed.Features(bits))
    langs = tuple(sorted({r["label"] for r in rows}))
    if not langs:
        none = np.zeros((1 << bits, 0))
        return Model((), none, np.zeros(0), 1.0, 0.0, bits, none, np.zeros((0, 3)))
    idx, share, off = hashed.ragged(rows)
    y = np.array([langs.index(r["label"]) for r in rows])
    order = np.random.default_rng(seed).permutation(len(rows))
    held, fit = order[:len(order) // 5], order[len(order) // 5:]
    fi, fs, fr = hashed.batch_of(fit, idx, share, off)
    foff = np.concatenate([[0], np.cumsum(np.bincount(fr, minlength=len(fit)))]).astype(np.int64)
    emb, out, bias = _descend(fi, fs, foff, y[fit], len(langs), bits, dim, epochs, rate, seed)
    table = emb @ out
    check = held if len(held) else fit
    i, s, r = hashed.batch_of(check, idx, share, off)
    z = np.stack([np.bincount(r, table[i, k] * s, len(check)) for k in range(len(langs))], axis=1) + bias
    grid = np.geomspace(0.2, 5, 60)
    loss = [-np.log(softmax(z / t)[np.arange(len(check)), y[check]] + 1e-12).mean() for t in grid]
    t = float(grid[int(np.argmin(loss))])
    # likelihoods of the rows kept out, against those of the language the model gives them
    likelihood = _likelihood(fi, fs, foff, y[fit], len(langs), bits)
    given = z.argmax(axis=1)
    mean = np.bincount(r, likelihood[i, given[r]] * s, len(check))
    square = np.bincount(r, likelihood[i, given[r]] ** 2 * s, len(check))
    features = 1 / np.minimum.reduceat(s, np.flatnonzero(np.diff(r, prepend=-1))) if len(s) else np.ones(len(check))
    usual = np.zeros((len(langs), 3))
    for k in range(len(langs)):
        mine = given == k if (given == k).any() else np.ones(len(check), bool)
        usual[k] = mean[mine].mean(), 0, (square - mean ** 2)[mine].mean()
    usual[:, 1] = ((mean - usual[given, 0]) ** 2).mean()      # of all languages: a few odd texts must not count for one alone
    threshold = float(np.quantile(distance(mean, features, given, usual), 1 - lost)) * margin
    return Model(langs, table, bias, t, threshold, bits, likelihood, usual)


def _judge(model: Model):
    """A function (bytes, offsets) -> best language, its probability, accepted, made once per task."""
    n = len(model.langs)
    tables = [np.ascontiguousarray(t[:, k]) for t in (model.table, model.likelihood) for k in range(n)]
    features = hashed.Features(model.bits)

    def judge(data, off):
        means, count = features.means_and_counts(tables, data, off)
        p = softmax((means[:, :n] + model.bias) / model.temperature)
        best = p.argmax(axis=1)
        rows = np.arange(len(best))
        far = distance(means[rows, n + best], count, best, model.usual)
        return best, p[rows, best], far <= model.threshold

    return judge


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, accepted: one row per input row, whole texts.

    Null text, or text without a letter: ``und``, score 0, not accepted.  ``accepted`` is false where the
    text lies farther from the language than the model's threshold; of equal probabilities the first language in
    alphabetical order wins.  Repeated and null ids stay rows of their own; other columns are ignored.
    """
    known_langs = model.langs

    def make():
        import pyarrow as pa

        names = pa.array([*known_langs, UNKNOWN])
        judge = _judge(model)

        def score(data, off, null):
            n = len(off) - 1
            if not known_langs:
                return names.take(pa.array(np.zeros(n, np.int64))), np.zeros(n), np.zeros(n, bool)
            best, p, near = judge(data, off)
            return names.take(pa.array(best)), p, near

        return score

    letter = docs.select("doc_id", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("__letter"))
    got = kernel.map_texts(letter, make, "lang_pred string, score double, near boolean", keep=("doc_id", "__letter"))
    known = F.col("__letter") & F.lit(bool(known_langs))
    return got.select(
        "doc_id", F.when(known, F.col("lang_pred")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(known, F.col("score")).otherwise(0.0).alias("score"), (known & F.col("near")).alias("accepted"))


def accepted_rows(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, that ``identify`` accepts; repeated rows stay, an empty table stays empty."""
    if not model.langs:
        return docs.where(F.lit(False))

    def make():
        judge = _judge(model)
        return lambda data, off, null: judge(data, off)[2]

    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.where(letter & kernel.text_column(make, "boolean")(F.col("text")))
