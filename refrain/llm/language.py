"""Language identification with error-correcting output codes.

Each language has a codeword; each of its bits has a binary classifier over byte n-grams, which tells the
languages with a 1 from those with a 0. Its weights are log ratios of n-gram shares, from counts of all
training texts that Spark adds up. A text's bits are soft votes; decoding weighs each bit's loss by how far the
bit separates the language in question and takes the codeword with the smallest loss. If the second is close,
the answer is flagged as ambiguous.

The model holds ``2 * BUCKETS`` numbers for each language or bit, whatever the corpus holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.llm.common import slices

#: Buckets of the pairs and of the triples of bytes.
BUCKETS = 1 << 16
#: Loss between the two nearest codewords under which an answer is ambiguous.
MARGIN = 0.15
UNKNOWN = "und"
_LETTER = np.full(256, 32, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every byte pair, of every byte triple, first place of each text) of the texts put in a row."""
    raw = [b" " + (t or "").lower().encode() + b"  " for t in texts]
    data = _LETTER[np.frombuffer(b"".join(raw), np.uint8)]
    firsts = np.cumsum([0, *map(len, raw)])[:-1]
    two = data[:-1].astype(np.int32) * 256 + data[1:]
    three = (two[:-1].astype(np.uint32) * np.uint32(256) + data[2:]) * np.uint32(2654435761) >> np.uint32(16)
    blank = two == 32 * 257
    return np.where(blank, -1, two)[:-1], np.where(blank[:-1], -1, three.astype(np.int32) + BUCKETS), firsts


def code_words(n: int) -> np.ndarray:
    """One row of +1 / -1 for each language: all ways to part a few languages, far apart random rows for many."""
    if n < 2:
        return np.ones((n, 1), np.int8)
    if n <= 5:
        columns = [[1] + [1 if c >> i & 1 else -1 for i in range(n - 1)] for c in range(2 ** (n - 1) - 1)]
        return np.array(columns, np.int8).T
    bits, best, most = int(np.ceil(10 * np.log2(n))), None, -1
    for seed in range(64):
        words = np.random.default_rng(seed).choice(np.array([-1, 1], np.int8), (n, bits))
        apart = min((words[i] != words[j]).sum() for i in range(n) for j in range(i))
        if apart > most and (np.abs(words.sum(0)) < n).all():
            best, most = words, apart
    return best if best is not None else words


@dataclass
class Model:
    languages: list[str]
    words: np.ndarray
    #: Weight of each n-gram bucket for each bit; the last row, of no n-gram, is 0.
    weights: np.ndarray
    #: Bit votes expected for each language.
    expected: np.ndarray


def fit(counts: dict[str, np.ndarray]) -> Model:
    """A model from the n-gram counts of each language."""
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros((0, 1), np.int8), np.zeros((2 * BUCKETS + 1, 1), np.float32), np.zeros((0, 1)))
    words = code_words(len(languages))
    shares = np.array([counts[x] for x in languages], float).reshape(len(languages), 2, BUCKETS) + 0.5
    shares = (shares / shares.sum(2, keepdims=True)).reshape(len(languages), -1)
    weights = np.zeros((2 * BUCKETS + 1, words.shape[1]), np.float32)
    for k, bits in enumerate(words.T):
        if (bits > 0).any() and (bits < 0).any():
            weights[:-1, k] = np.log(shares[bits > 0].mean(0) / shares[bits < 0].mean(0))
    return Model(languages, words, weights, shares @ weights[:-1] / 2)


def decode(model: Model, votes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nearest language, score, whether it is ambiguous) for the bit votes of each text."""
    scale = np.abs(model.expected).mean(0) + 1e-9
    reach = np.abs(model.expected) + 1e-9
    trust = reach / reach.sum(1, keepdims=True)
    z = np.clip(votes / scale, -4, 4)
    loss = np.stack([(np.exp(-z * word) * t).sum(1) for word, t in zip(model.words, trust)], 1)
    order = np.argsort(loss, 1, kind="stable")
    best = order[:, 0]
    share = np.exp(-3 * (loss - loss.min(1, keepdims=True)))
    score = 1 / share.sum(1)
    near = np.take_along_axis(loss, order[:, : min(2, loss.shape[1])], 1)
    return best, score, near[:, -1] - near[:, 0] < MARGIN if near.shape[1] > 1 else np.zeros(len(best), bool)


def votes(model: Model, texts: list[str | None]) -> np.ndarray:
    """Mean weight of a text's n-grams for each bit; 0 without any."""
    two, three, firsts = grams(texts)
    total = np.zeros((len(texts), model.weights.shape[1]), np.float64)
    seen = np.zeros(len(texts))
    step = 1 << 18
    owner = np.searchsorted(firsts, np.arange(0, len(two), step), "right") - 1
    for start, first in zip(range(0, len(two), step), owner):
        end = min(start + step, len(two))
        inside = firsts[(firsts > start) & (firsts < end)] - start
        at = np.append(0, inside)
        rows = np.arange(first, first + len(at))
        for index in (two[start:end], three[start:end]):
            np.add.at(total, rows, np.add.reduceat(model.weights[index], at))
            np.add.at(seen, rows, np.add.reduceat((index >= 0).astype(np.int64), at))
    return total / np.maximum(seen, 1)[:, None]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in slices(batches, "text", 1 << 20):
        languages, texts = np.array(batch.column("lang").to_pylist(), object), batch.column("text").to_pylist()
        for language in set(languages):
            two, three, _ = grams([t for t, x in zip(texts, languages) if x == language])
            both = np.concatenate([two, three])
            mine = sums.setdefault(language, np.zeros(2 * BUCKETS, np.int64))
            mine += np.bincount(both[both >= 0], minlength=2 * BUCKETS)
    for language, mine in sums.items():
        at = np.flatnonzero(mine)
        yield pa.RecordBatch.from_arrays(
            [pa.array([language] * len(at), pa.string()), pa.array(at), pa.array(mine[at])], ["lang", "gram", "n"]
        )


def learn(docs: DataFrame) -> Model:
    """A model from all rows of ``docs(text, lang)`` that have both; the counts collected are bounded by the
    number of languages times ``2 * BUCKETS``."""
    known = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("text", F.col("lang").cast("string").alias("lang"))
    rows = known.mapInArrow(_counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts: dict[str, np.ndarray] = {}
    for language, part in rows.toPandas().groupby("lang"):
        counts[language] = np.zeros(2 * BUCKETS)
        counts[language][part["gram"].to_numpy()] = part["n"].to_numpy()
    return fit(counts)


def _predicted(batches: Iterator[pa.RecordBatch], shared, keep_text: bool) -> Iterator[pa.RecordBatch]:
    model = shared.value
    names = np.array([*model.languages, UNKNOWN], object)
    for batch in slices(batches, "text", 1 << 20):
        texts = batch.column("text").to_pylist()
        unknown = np.array([not t or not any(map(str.isalpha, t)) for t in texts], bool)
        if model.languages:
            best, score, unsure = decode(model, votes(model, texts))
        else:
            best, score, unsure = np.zeros(len(texts), int), np.zeros(len(texts)), np.ones(len(texts), bool)
            unknown[:] = True
        best = np.where(unknown, len(model.languages), best)
        kept = [c for c in batch.schema.names if c != "text" or keep_text]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in kept]
            + [pa.array(names[best], pa.string()), pa.array(np.where(unknown, 0.0, score)), pa.array(unsure | unknown)],
            [*kept, "lang_pred", "score", "ambiguous"],
        )


def identify(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with lang_pred, score and ambiguous; columns of these names give way.

    A null text and one without a letter are ``und`` with score 0. Rows may repeat; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in keep if c not in ("lang_pred", "score", "ambiguous")]
    keep_text = "text" in keep
    rows = docs.select(*[c for c in keep if c != "text"], F.col("text").cast("string").alias("text"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name != "text" or keep_text)
    return rows.mapInArrow(
        partial(_predicted, shared=shared, keep_text=keep_text),
        f"{kinds}lang_pred string, score double, ambiguous boolean",
    )
