"""Language identification with a byte convolutional network.

The network reads windows of ``WINDOW`` bytes: filters of several widths slide over the bytes,
each filter keeps its maximum over the window, and a softmax over the maxima gives the languages'
probabilities. A document's score is the mean of the logarithms over all windows of its whole
text. Training is plain numpy on the driver, on a bounded sample of labelled windows; prediction
runs on Spark's partitions, in batches of windows, so long texts need no more memory.

A filter is a sum of per-byte weights, so two neighbouring bytes are looked up at once: a filter
of width 4 costs two look-ups in a table of byte pairs.

Defined results: null texts and texts without a letter are ``und`` with score 0, as is every text
if nothing was learned from; rows with null text, lang or doc_id are not learned from; languages of
equal probability go by their name; an empty table gives an empty result; repeated
rows each get their own row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import pick

WINDOW = 64
WIDTHS = (2, 3, 4)
FILTERS = 8
#: Bound of the training sample: no more windows are drawn in all, and the languages share them.
SAMPLE_WINDOWS = 8_192
#: Most languages that are learned.
LANGUAGES = 512
WINDOWS_PER_TEXT = 2
EPOCHS = 12
SEED = 7
UNKNOWN = "und"
#: Windows scored at a time.
BATCH = 2_048


def _byte_classes() -> np.ndarray:
    """Byte to class: letters without case, one class each for white space, digits and marks."""
    classes = np.zeros(256, np.int64)
    for b in range(256):
        c = chr(b)
        if b >= 128:
            classes[b] = b - 128 + 30
        elif c.isalpha():
            classes[b] = ord(c.lower()) - ord("a") + 4
        elif c.isspace():
            classes[b] = 1
        else:
            classes[b] = 2 if c.isdigit() else 3
    return classes


CLASSES = _byte_classes()
N = 158


def windows_of(text: bytes) -> np.ndarray:
    """All windows of a text as byte classes: WINDOW each, plus the overlap of the widest filter."""
    step, wide = WINDOW, WINDOW + max(WIDTHS) - 1
    codes = CLASSES[np.frombuffer(text, np.uint8)]
    n = max(1, -(-len(codes) // step))
    padded = np.zeros((n - 1) * step + wide, np.int64)
    padded[: len(codes)] = codes
    return np.lib.stride_tricks.sliding_window_view(padded, wide)[::step]


@dataclass
class ByteNet:
    """Weights: ``filters[w]`` (w, N, FILTERS) per width, ``bias`` per filter, ``out`` and ``out_bias``."""

    languages: list[str]
    filters: dict[int, np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Look-up tables of byte pairs: a filter's first two places, and its places three and four."""
        first, second = [], []
        for w in WIDTHS:
            f = self.filters[w].astype(np.float32)
            first.append((f[0][:, None, :] + f[1][None, :, :]).reshape(N * N, -1))
            rest = [f[k] if k < w else np.zeros_like(f[0]) for k in (2, 3)]
            second.append((rest[0][:, None, :] + rest[1][None, :, :]).reshape(N * N, -1))
        return np.ascontiguousarray(np.concatenate(first, 1)), np.ascontiguousarray(np.concatenate(second, 1))

    def pooled(self, codes: np.ndarray, tables: tuple[np.ndarray, np.ndarray], with_place: bool = False):
        """Maxima over the window of every filter, before bias: (windows, filters)."""
        first, second = tables
        pairs = np.ascontiguousarray((codes[:, :-1] * N + codes[:, 1:]).T)
        best = first[pairs[0]] + second[pairs[2]]
        place = np.zeros(best.shape, np.int64) if with_place else None
        for t in range(1, WINDOW):
            act = first[pairs[t]]
            act += second[pairs[t + 2]]
            if with_place:
                place[act > best] = t
            np.maximum(best, act, out=best)
        return (best, place) if with_place else best

    def log_probabilities(self, codes: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        hidden = np.maximum(self.pooled(codes, tables) + self.bias, 0)
        logits = hidden @ self.out + self.out_bias
        logits -= logits.max(1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(1, keepdims=True))


def train(windows: list[bytes], labels: list[str], epochs: int = EPOCHS, seed: int = SEED) -> ByteNet:
    """Fit by Adam on the cross-entropy of single windows; the maximum passes its gradient on."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    y = np.array([languages.index(x) for x in labels])
    x = np.concatenate([windows_of(w)[:1] for w in windows])
    total = FILTERS * len(WIDTHS)
    # classes weigh alike, whatever their share of the sample
    weight = (len(y) / len(languages) / np.bincount(y, minlength=len(languages)))[y]
    net = ByteNet(
        languages,
        {w: rng.normal(0, 0.3, (w, N, FILTERS)) for w in WIDTHS},
        np.zeros(total), rng.normal(0, 0.3, (total, len(languages))), np.zeros(len(languages)),
    )
    params = [*(net.filters[w] for w in WIDTHS), net.bias, net.out, net.out_bias]
    moment, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step, size = 0, 128
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), size):
            rows = order[at : at + size]
            codes, n = x[rows], len(rows)
            best, place = net.pooled(codes, net.tables(), with_place=True)
            pre = best + net.bias
            hidden = np.maximum(pre, 0)
            logits = hidden @ net.out + net.out_bias
            logits -= logits.max(1, keepdims=True)
            p = np.exp(logits)
            p /= p.sum(1, keepdims=True)
            p[np.arange(n), y[rows]] -= 1
            p *= (weight[rows] / n)[:, None]
            back = (p @ net.out.T) * (pre > 0)
            grads = []
            for i, w in enumerate(WIDTHS):
                own = slice(i * FILTERS, (i + 1) * FILTERS)
                g = np.zeros_like(net.filters[w])
                for k in range(w):
                    bytes_at = np.take_along_axis(codes, place[:, own] + k, 1)
                    np.add.at(g[k], (bytes_at, np.arange(FILTERS)[None, :]), back[:, own])
                grads.append(g)
            grads += [back.sum(0), hidden.T @ p, p.sum(0)]
            step += 1
            for q, g, m, s in zip(params, grads, moment, square):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                q -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return net


def training_windows(labelled: DataFrame, limit: int = SAMPLE_WINDOWS) -> DataFrame:
    """(lang, piece): at most ``limit`` different byte windows at hashed places of a hashed sample of the labelled texts.

    Rows are taken by a hash threshold of doc_id and text from the counts per language, so that each
    language gets about the same number. Equal windows of one language are taken once, map-side first, and of
    more than ``limit`` the ones of least hash stay, so neither a repeated row nor a hot doc_id can
    exceed the bound. Of more than ``LANGUAGES`` languages the most frequent are learned (ties: smaller name).
    """
    rows = pick(labelled, "doc_id", "text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL")
    frequent = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "lang").limit(LANGUAGES)
    counts = {r["lang"]: r["n"] for r in frequent.collect()}
    share = max(1, limit // (WINDOWS_PER_TEXT * max(len(counts), 1)))
    part = F.pmod(F.xxhash64("doc_id", "text", F.lit(SEED)), F.lit(1 << 20)) / float(1 << 20)
    chance = F.create_map(*(x for lang, n in sorted(counts.items()) for x in (F.lit(lang), F.lit(min(1.0, share / n))))) if counts else None
    sample = rows.filter(F.col("lang").isin(list(counts)) & (part < F.try_element_at(chance, F.col("lang")))) if counts else rows.limit(0)
    data = F.col("text").cast("binary")
    places = [F.pmod(F.xxhash64("doc_id", F.lit(SEED + 1 + k)), F.greatest(F.octet_length("text") - WINDOW, F.lit(1))) + 1 for k in range(WINDOWS_PER_TEXT)]
    pieces = F.array(*(F.substring(data, p.cast("int"), F.lit(WINDOW + max(WIDTHS) - 1)) for p in places))
    return sample.select("lang", F.explode(pieces).alias("piece")).distinct().orderBy(F.xxhash64("lang", "piece", F.lit(SEED)), "lang", "piece").limit(limit)


def fit(labelled: DataFrame, limit: int = SAMPLE_WINDOWS) -> ByteNet | None:
    """A network learned from (doc_id, text, lang); None if there is no such row."""
    rows = training_windows(labelled, limit).orderBy("lang", "piece").collect()
    return train([bytes(r["piece"]) for r in rows], [r["lang"] for r in rows]) if rows else None


def predictor(net: ByteNet | None, spark):
    """Column function: text to a struct of lang_pred and score."""
    shared = spark.sparkContext.broadcast(net)

    @pandas_udf("struct<lang_pred: string, score: double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        tables = None if model is None else model.tables()
        for texts in batches:
            n, sums, counts = len(texts), None, np.zeros(len(texts))
            if model is not None:
                sums = np.zeros((n, len(model.languages)))
                parts: list[np.ndarray] = []
                owner: list[np.ndarray] = []
                held = 0

                def score() -> None:
                    codes, who = np.concatenate(parts), np.concatenate(owner)
                    for at in range(0, len(codes), BATCH):
                        own = who[at : at + BATCH]
                        np.add.at(sums, own, model.log_probabilities(codes[at : at + BATCH], tables))
                    parts.clear()
                    owner.clear()

                for i, text in enumerate(texts):
                    if text is None:
                        continue
                    data = text.encode()
                    for at in range(0, len(data), BATCH * WINDOW):
                        part = windows_of(data[at : at + BATCH * WINDOW + max(WIDTHS) - 1])
                        left = -(-(min(len(data) - at, BATCH * WINDOW)) // WINDOW)
                        parts.append(part[:left])
                        owner.append(np.full(left, i))
                        counts[i] += left
                        held += left
                        if held >= 2 * BATCH:
                            score()
                            held = 0
                if parts:
                    score()
            if model is None:
                yield pd.DataFrame({"lang_pred": [None] * n, "score": np.zeros(n)})
                continue
            mean = sums / np.maximum(counts, 1)[:, None]
            mean = np.exp(mean - mean.max(1, keepdims=True))
            mean /= mean.sum(1, keepdims=True)
            best = mean.argmax(1)
            yield pd.DataFrame({"lang_pred": [model.languages[b] if c else None for b, c in zip(best, counts)], "score": np.where(counts > 0, mean.max(1), 0.0)})

    return predict


def identify(docs: DataFrame, net: ByteNet | None) -> DataFrame:
    """doc_id, lang_pred and score, one row per document."""
    predict = predictor(net, docs.sparkSession)
    text: Column = F.when(F.col("text").rlike(r"\p{L}"), F.col("text"))
    return pick(docs, "doc_id", "text").select("doc_id", predict(text).alias("p")).select(
        "doc_id", F.coalesce("p.lang_pred", F.lit(UNKNOWN)).alias("lang_pred"), F.coalesce("p.score", F.lit(0.0)).alias("score")
    )
