"""Language identification with a small byte convolutional network.

A text is cut into windows of ``WINDOW`` UTF-8 bytes (letters A-Z and the
two-byte Latin capitals lower-cased). Each byte gets an embedding; filters
of several widths slide over the window, are rectified and max-pooled over
its positions; a softmax over the pooled values names the language. A
document's score is the mean of its windows' probabilities, weighted by
their bytes, over the whole text.

Training is plain numpy (Adam) on the driver, on a sample of about
``PER_LANG`` distinct texts of each language (all of a language with fewer),
of which up to ``SAMPLE_CHARS`` characters are read: under 1 MB of ASCII text
per language. Prediction covers every byte of every text, in blocks of windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maillens.llm.common import text_blocks, tidy

WINDOW = 128             # bytes
WIDTHS = (2, 3, 4)       # filter widths, in bytes
FILTERS = 8              # filters of each width
EMBED = 8                # embedding size
PER_LANG = 500           # training texts of a language
SAMPLE_CHARS = 1500      # of a training text, from a place that its hash picks
DRAWS = 1 << 40          # steps of the sampling rate
EPOCHS = 4
BATCH = 64
UNKNOWN = "und"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class ByteCnn:
    """Weights: embedding (256, E), per width a (w * E, F) kernel and (F,)
    bias, softmax (3F, L) and (L,); ``langs`` in the softmax's order."""

    langs: list[str]
    embed: np.ndarray
    kernels: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray


def fold_case(data: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 capitals as small letters, byte by byte."""
    out = _LOWER[data]
    latin = np.flatnonzero(data[:-1] == 0xC3) + 1
    high = out[latin]
    out[latin] = np.where((high >= 0x80) & (high <= 0x9E) & (high != 0x97), high + 0x20, high)
    return out


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows x WINDOW bytes, padded with 0; text of each; bytes in each)."""
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    out = np.zeros(int(count.sum()) * WINDOW, dtype=np.uint8)
    if len(data):
        first = np.concatenate(([0], np.cumsum(count)[:-1])) * WINDOW
        out[np.arange(len(data)) + np.repeat(first - offsets[:-1], size)] = fold_case(data)
    owner = np.repeat(np.arange(len(size)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    return out.reshape(-1, WINDOW), owner, np.minimum(WINDOW, size[owner] - nth * WINDOW)


def _columns(x: np.ndarray, width: int) -> np.ndarray:
    """(batch, positions, width * E) of an embedded batch."""
    n = x.shape[1] - width + 1
    return np.concatenate([x[:, k:k + n] for k in range(width)], axis=2)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def train(texts: list[str], labels: list[str], seed: int = 7) -> ByteCnn:
    """Fit the network on (text, language) samples; no samples: no languages."""
    langs = sorted(set(labels))
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, 0.5, (256, EMBED))]
    params[0][0] = 0.0                                    # padding
    for w in WIDTHS:
        params += [rng.normal(0, (2.0 / (w * EMBED)) ** 0.5, (w * EMBED, FILTERS)), np.zeros(FILTERS)]
    pooled = FILTERS * len(WIDTHS)
    params += [rng.normal(0, (1.0 / pooled) ** 0.5, (pooled, max(1, len(langs)))),
               np.zeros(max(1, len(langs)))]
    params = [p.astype(np.float32) for p in params]
    if len(langs) > 1:
        raw = [t.encode() for t in texts]
        offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
        x_all, owner, size = windows(np.frombuffer(b"".join(raw), np.uint8), offsets)
        keep = size >= 16                                 # rests of a few bytes teach noise
        x_all, owner = x_all[keep], owner[keep]
        code = {v: i for i, v in enumerate(langs)}
        y_all = np.array([code[v] for v in labels])[owner]
        per_class = np.bincount(y_all, minlength=len(langs))
        weight = (len(y_all) / (len(langs) * np.maximum(per_class, 1)))[y_all].astype(np.float32)
        mean = [np.zeros_like(p) for p in params]
        var = [np.zeros_like(p) for p in params]
        step = 0
        for _ in range(EPOCHS):
            mix_up = rng.permutation(len(x_all))
            for a in range(0, len(mix_up), BATCH):
                pick = mix_up[a:a + BATCH]
                grads = _gradients(params, x_all[pick], y_all[pick], weight[pick])
                step += 1
                for i, g in enumerate(grads):
                    mean[i] = 0.9 * mean[i] + 0.1 * g
                    var[i] = 0.999 * var[i] + 0.001 * g * g
                    params[i] -= (0.01 * (mean[i] / (1 - 0.9 ** step))
                                  / (np.sqrt(var[i] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
                params[0][0] = 0.0
    return ByteCnn(langs, params[0], params[1:1 + 2 * len(WIDTHS):2],
                   params[2:2 + 2 * len(WIDTHS):2], params[-2], params[-1])


def _gradients(params, x, y, weight):
    embedded = params[0][x]
    n = len(x)
    pools, saved = [], []
    for i, w in enumerate(WIDTHS):
        cols = _columns(embedded, w)
        conv = cols @ params[1 + 2 * i] + params[2 + 2 * i]
        top = conv.argmax(axis=1)                          # (n, F)
        best = np.take_along_axis(conv, top[:, None, :], axis=1)[:, 0]
        pools.append(np.maximum(best, 0))
        saved.append((cols, top, best > 0))
    h = np.concatenate(pools, axis=1)
    d = _softmax(h @ params[-2] + params[-1])
    d[np.arange(n), y] -= 1
    d *= weight[:, None] / n
    grads = [np.zeros_like(p) for p in params]
    grads[-2], grads[-1] = h.T @ d, d.sum(axis=0)
    dh = d @ params[-2].T
    rows = np.arange(n)[:, None]
    for i, w in enumerate(WIDTHS):
        cols, top, on = saved[i]
        dp = dh[:, i * FILTERS:(i + 1) * FILTERS] * on
        seen = cols[rows, top]                             # (n, F, w * E)
        grads[1 + 2 * i] = np.einsum("nf,nfk->kf", dp, seen)
        grads[2 + 2 * i] = dp.sum(axis=0)
        back = dp[:, :, None] * params[1 + 2 * i].T[None]  # (n, F, w * E)
        for k in range(w):
            np.add.at(grads[0], x[rows, top + k], back[:, :, k * EMBED:(k + 1) * EMBED])
    return grads


class _Tables:
    """The convolution as look-ups: what a byte pair or a byte adds to every
    filter (exactly embedding times kernel, summed in another order)."""

    def __init__(self, m: ByteCnn):
        part = lambda i, k: m.embed @ m.kernels[i][k * EMBED:(k + 1) * EMBED]
        two = lambda i, k: (part(i, k)[:, None, :] + part(i, k + 1)[None]).reshape(65536, -1)
        self.lead = np.concatenate([two(i, 0) + m.biases[i] for i in range(3)], axis=1).astype(np.float32)
        self.third = part(1, 2).astype(np.float32)
        self.rear = two(2, 2).astype(np.float32)
        self.model = m

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        m, f = self.model, FILTERS
        pair = (x[:, :-1].astype(np.int32) << 8) | x[:, 1:]
        lead = self.lead[pair]
        h = np.empty((len(x), 3 * f), dtype=np.float32)
        h[:, :f] = lead[:, :, :f].max(axis=1)
        h[:, f:2 * f] = (lead[:, :-1, f:2 * f] + self.third[x[:, 2:]]).max(axis=1)
        h[:, 2 * f:] = (lead[:, :-2, 2 * f:] + self.rear[pair[:, 2:]]).max(axis=1)
        return _softmax(np.maximum(h, 0) @ m.out + m.out_bias)


def scorer(model: ByteCnn, text_at: int, passed: list[int]):
    """A function for ``mapInArrow`` over rows whose last column says whether
    the text holds a letter: columns ``passed``, then lang_pred and score."""
    tables: list[_Tables] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not tables:
            tables.append(_Tables(model))                  # once per task
        n_langs = len(model.langs)
        for batch in batches:
            has_letter = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            for a, b, data, offsets in text_blocks(batch.column(text_at)):
                x, owner, size = windows(data, offsets)
                total = np.zeros((b - a, max(1, n_langs)))
                for at in range(0, len(x), 1024):
                    p = tables[0].probabilities(x[at:at + 1024]) * size[at:at + 1024, None]
                    np.add.at(total, owner[at:at + 1024], p)
                total /= np.maximum(np.diff(offsets), 1)[:, None]
                ok = has_letter[a:b].astype(bool) & (n_langs > 0)
                best = total.argmax(axis=1)
                names = np.array(model.langs or [UNKNOWN], dtype=object)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(a, b - a) for c in passed]
                    + [pa.array(np.where(ok, names[best], UNKNOWN), pa.string()),
                       pa.array(np.where(ok, np.clip(total.max(axis=1), 0, 1), 0.0))],
                    names=[batch.schema.names[c] for c in passed] + ["lang_pred", "score"])
            tidy()
    return run


def is_held_out() -> F.Column:
    """Documents that never teach: crc32 of the id's text, modulo 4, is 2."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(crc % 4 == 2, F.lit(False))


def learn(docs: DataFrame) -> ByteCnn:
    """Train on the labelled rows of ``docs(doc_id, text, lang)`` that are
    not held out; rows without text, letters or lang teach nothing.

    The sample is drawn by a hash of the text at a rate that yields about
    ``PER_LANG`` texts of each language. The rate follows the language's
    distinct texts, so copies of a text count once. Of a text that is longer than
    ``SAMPLE_CHARS`` a stretch of that size teaches, from anywhere in it (from
    its first letter where the stretch holds none).
    """
    places = F.greatest(F.length("text") - SAMPLE_CHARS + 1, F.lit(1))
    start = F.pmod(F.xxhash64(F.lit(1), "text"), places).cast("int") + 1
    stretch = F.substring(F.col("text"), start, F.lit(SAMPLE_CHARS))
    first = F.regexp_extract("text", rf"\p{{L}}[\s\S]{{0,{SAMPLE_CHARS - 1}}}", 0)
    usable = (docs.where("lang is not null and text is not null").where(~is_held_out())
              .where(F.col("text").rlike(r"\p{L}")).select("lang", F.xxhash64("text").alias("h"), "text"))
    taught = F.when(stretch.rlike(r"\p{L}"), stretch).otherwise(first)
    counts = usable.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()
    if not counts:
        return train([], [])
    rates = docs.sparkSession.createDataFrame(
        [(r["lang"], min(DRAWS, -(-PER_LANG * DRAWS // r["n"]))) for r in counts], "lang string, rate long")
    rows = (usable.join(F.broadcast(rates), "lang").where(F.pmod("h", F.lit(DRAWS)) < F.col("rate"))
            .select("lang", "h", taught.alias("t")).groupBy("lang", "h").agg(F.min("t").alias("t")).collect())
    rows.sort(key=lambda r: (r["h"], r["lang"]))
    return train([r["t"] for r in rows], [r["lang"] for r in rows])


def predict(docs: DataFrame, model: ByteCnn, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) plus ``lang_pred`` and ``score``.

    Only ``text`` is looked at; other columns pass through, columns of those
    two names are replaced. A null text, a text without any letter and a model without
    languages give ``und`` with score 0; equal probabilities take the first
    language by name; an empty table gives an empty one.
    """
    docs = docs.drop("lang_pred", "score")
    names = docs.columns
    keep = names if keep is None else keep
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields]
    return docs.select("*", letter.alias("__letter")).mapInArrow(
        scorer(model, names.index("text"), [names.index(c) for c in keep]),
        ", ".join([*schema, "lang_pred string", "score double"]))


def identify(docs: DataFrame) -> DataFrame:
    """Train on ``docs(doc_id, text, lang, ...)`` and predict every row:
    ``doc_id, held_out, lang_pred, score``. A null doc_id is not held out."""
    rows = docs.select("doc_id", "text", is_held_out().alias("held_out"))
    return predict(rows, learn(docs), ["doc_id", "held_out"])
