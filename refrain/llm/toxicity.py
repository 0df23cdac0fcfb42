"""Toxicity of texts behind spelling noise: a noisy-channel decoder, then a learned lexicon.

* **Language model.** Counts of character triples over all texts, added up by Spark (at most 64 ** 3 numbers).
* **Decoder.** A suspicious token (letters with digits or signs anywhere before the next white space, a letter three
  times or more, single letters set apart) is a lattice: each run of one character offers the letters it may
  stand for, at a cost, however long the run. Viterbi search takes the path whose letters are likeliest under the
  language model, less the cost. Other tokens have one path only, which is the token itself.
* **Lexicon.** Words and word beginnings of the restored texts of a bounded sample of labelled documents; each
  weighs the lower confidence bound of its log odds between the two labels.
* **Score.** The strongest feature of a document through a logistic curve. The curve is fitted to the sample with
  each document's own counts taken out, so that rare words do not look better than they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.llm.common import slices
from refrain.llm.words import BLOCK, Prefix
from refrain.sources.storage import stage_table

#: Most labelled documents of each label that the lexicon is learned from (about; a hash decides).
SAMPLE = {1: 4_000, 0: 16_000}
#: Bytes of the word beginnings that count as features, besides whole words.
BEGINNINGS = (4, 5, 6, 7, 8)
#: Fewest toxic sample documents that must have a feature.
SUPPORT = 2
#: Standard errors taken off a feature's log odds.
CAUTION = 1.64
#: Strength of a document without any known feature.
NOTHING = -6.0
_SIDE = 64
# Letters that a sign may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g"}
LEET |= {"@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e"}
_SIGNS = re.escape("".join(LEET))
_L = r"[^\W\d_]"
#: Signs that may also just end a word.
ENDINGS = "!|+"
#: A suspicious token: letters set apart; letters and signs without white space between; a letter three times.
#: The look-ahead parts start at the beginning of a token only, so the search is linear in its length.
SUSPECT = re.compile(
    rf"(?<![\w])(?:{_L}[ .\-_*]){{3,}}{_L}(?![\w])"
    rf"|(?<!\S)(?=[^\s{_SIGNS}]*[{_SIGNS}])(?=(?:(?!{_L})\S)*{_L})\S+"
    rf"|(?<!\S)(?=\S*?({_L})\1\1)\S+"
)
#: Cost of a sign that stands for nothing.
DROPPED = 10.0
#: Tokens up to this length are remembered.
REMEMBERED = 64
# Kinds of code points below 128: 1 letters, 2 signs, 4 gaps between letters set apart, 8 white space.
_KIND = np.zeros(128, np.uint8)
_KIND[97:123] = 1
_KIND[[ord(c) for c in LEET if ord(c) < 128]] |= 2
_KIND[[ord(c) for c in " .-_*"]] |= 4
_KIND[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] |= 8


def kinds(code: np.ndarray) -> np.ndarray:
    """Kinds of code points. Beyond 127 all may be letters, and those that LEET names or that are white space may be that."""
    out = np.where(code < 128, _KIND[np.minimum(code, 127)], 1).astype(np.uint8)
    beyond = code >= 128
    if beyond.any():
        out[np.isin(code, [ord(c) for c in LEET if ord(c) > 127])] |= 2
    return out


_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[97:123] = _IS_LETTER[128:] = True


def classes(text: str) -> np.ndarray:
    """Character classes: 1-26 for a-z, 27-58 for the Latin-1 small letters, 59 other letters, 0 for the rest."""
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    out = np.where(code < 256, _CLASS[np.minimum(code, 255)], np.where(code > 0x2AF, 59, 58)).astype(np.int64)
    return out


_CLASS = np.zeros(256, np.int64)
_CLASS[97:123] = np.arange(1, 27)
_CLASS[0xDF:0x100] = 26 + np.minimum(np.arange(1, 34), 32)


def _triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = np.zeros(_SIDE**3, np.int64)
    for batch in slices(batches, "text", 1 << 20):
        c = classes("  ".join(t.lower() for t in batch.column("text").to_pylist() if t))
        if len(c) > 2:
            sums += np.bincount(c[:-2] * _SIDE**2 + c[1:-1] * _SIDE + c[2:], minlength=_SIDE**3)
    at = np.flatnonzero(sums)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["triple", "n"])


def learn_characters(docs: DataFrame) -> np.ndarray:
    """Cost (negative log probability) of a character class after two others, from all texts."""
    rows = docs.select("text").mapInArrow(_triples, "triple long, n long").groupBy("triple").agg(F.sum("n").alias("n"))
    sums = np.zeros(_SIDE**3)
    got = rows.toPandas()
    sums[got["triple"].to_numpy(int)] = got["n"].to_numpy()
    three = sums.reshape(_SIDE, _SIDE, _SIDE)
    two = three.sum(0) + 0.1
    two /= two.sum(1, keepdims=True)
    # Triples lean on pairs where they are rare.
    return -np.log((three + 5 * two) / (three.sum(2, keepdims=True) + 5))


class Decoder:
    """Viterbi decoding of suspicious tokens; results are remembered up to a bound."""

    def __init__(self, costs: np.ndarray):
        self.costs, self.known = costs, {}

    def restore(self, text: str) -> str:
        """The lower-cased text with suspicious tokens decoded."""
        low = text.lower()
        if len(low) > 1 and suspicious(np.frombuffer(low.encode("utf-32-le"), np.uint32)):
            return SUSPECT.sub(lambda m: self.token(m[0]), low)
        return low

    def token(self, token: str) -> str:
        if len(token) > REMEMBERED:
            return self.decode(token)
        if token not in self.known:
            if len(self.known) >= 50_000:
                self.known.clear()
            self.known[token] = self.decode(token)
        return self.known[token]

    def decode(self, token: str) -> str:
        """The cheapest path through the token's lattice; of equal ones the first in letter order."""
        # States are the last two classes; each keeps its cheapest way, as a chain of letters.
        best: dict = {(0, 0): (0.0, None)}
        for options in lattice(token):
            after: dict = {}
            for (a, b), (cost, way) in best.items():
                for letters, price, steps in options:
                    x, y, total = a, b, cost + price
                    for k in steps:
                        total += self.costs[x, y, k]
                        x, y = y, k
                    if (x, y) not in after or total < after[x, y][0]:
                        after[x, y] = (total, (way, letters))
            best = after
        end = min(best, key=lambda s: best[s][0] + self.costs[s[0], s[1], 0])
        out, way = [], best[end][1]
        while way:
            way, letters = way
            out.append(letters)
        return "".join(reversed(out))


def suspicious(code: np.ndarray) -> bool:
    """Whether lower-cased code points may hold a match of ``SUSPECT``: never false if they do."""
    kind = kinds(code)
    letter = kind & 1 > 0
    if len(code) > 2 and (letter[2:] & (code[:-2] == code[1:-1]) & (code[1:-1] == code[2:])).any():
        return True
    signs = np.flatnonzero(kind & 2)
    if len(signs):
        token = np.cumsum(kind & 8 > 0)
        if np.isin(token[signs], token[letter]).any():
            return True
    n = len(code) - 6
    if n < 1:
        return False
    gap = kind & 4 > 0
    out = letter[:n].copy()
    for j in range(1, 7):
        out &= (gap if j % 2 else letter)[j : j + n]
    return bool(out.any())


def lattice(token: str) -> list[list[tuple[str, float, list[int]]]]:
    """For each run of one character what it may stand for: (letters, cost, their classes)."""
    letters = sum(c.isalpha() for c in token)
    apart = len(token) > 6 and letters * 2 == len(token) + 1 and all(c.isalpha() for c in token[::2])
    # Behind the last letter, digit or other sign, the ending signs may be just that.
    core = max((i for i, c in enumerate(token, 1) if c.isalnum() or c in LEET and c not in ENDINGS), default=0)
    places: list[list[tuple[str, float]]] = []
    i = 0
    while i < len(token):
        c, n = token[i], 1
        while i + n < len(token) and token[i + n] == c:
            n += 1
        if c.isalpha():
            places.append([(c * k, 0.5 * abs(n - k) if n < 3 else 0.5 * k) for k in ((n,) if n < 3 else (1, 2))])
        elif c in LEET and not (apart and c in ENDINGS):
            # However long the run, it stands for one letter.
            at_end = i >= core
            options = [(x, (4.0 if at_end else 1.0) + 0.3 * min(n - 1, 9)) for x in LEET[c]] + [("", DROPPED)]
            places.append(options + [(c * n, 0.0)] if at_end else options)
        else:
            places.append([("", 0.5)] if apart else [(c * n, 0.0)])
        i += n
    return [[(x, cost, _class_list(x[:3])) for x, cost in options] for options in places]


@lru_cache(1 << 14)
def _class_list(letters: str) -> list[int]:
    return classes(letters).tolist() if letters else []


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit feature, number of its text) for the words and word beginnings of restored texts."""
    found, owners = [], []
    start = 0
    while start < len(texts):
        end, size = start, 0
        raw: list[bytes] = []
        while end < len(texts) and (end == start or size < BLOCK):
            raw.append(texts[end].encode())
            size += len(raw[-1]) + 1
            end += 1
        data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
        firsts = np.cumsum([0, *(len(r) + 1 for r in raw)])[:-1]
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = _IS_LETTER[data]
        edges = np.flatnonzero(np.diff(inside))
        low, high = edges[::2], edges[1::2]
        owner = np.searchsorted(firsts, low, "right") - 1 + start
        prefix = Prefix(data)
        keys, whose = [prefix.ranges(low, high)], [owner]
        for n in BEGINNINGS:
            long = high - low > n
            keys.append(prefix.ranges(low[long], low[long] + n) ^ np.uint64(n * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
            whose.append(owner[long])
        found += keys
        owners += whose
        start = end
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(owners)


def _sample_features(batches: Iterator[pa.RecordBatch], decoder: Decoder, only: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Distinct features of each document; only known ones, if a list is given."""
    for batch in slices(batches, "text", 1 << 20):
        keys, owner = features([decoder.restore(t) for t in batch.column("text").to_pylist()])
        if only is not None:
            hit = np.isin(keys, only)
            keys, owner = keys[hit], owner[hit]
        order = np.lexsort((keys, owner))
        keys, owner = keys[order], owner[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
        keys = keys[new]
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], ["feature"])


class Lexicon:
    """Features in order with their counts by label, and the curve from strength to score."""

    def __init__(self, keys: np.ndarray, toxic: np.ndarray, clean: np.ndarray, sizes: tuple[int, int]):
        order = np.argsort(keys)
        self.keys, self.toxic, self.clean, self.sizes = keys[order], toxic[order], clean[order], sizes
        self.curve = (0.0, 1.0)
        self.weights = self.odds(0, 0)

    def odds(self, toxic_less: int, clean_less: int) -> np.ndarray:
        """Lower bounds of the log odds, with a document of either label taken out."""
        t, c = np.maximum(self.toxic - toxic_less, 0), np.maximum(self.clean - clean_less, 0)
        n, m = self.sizes
        return (
            np.log((t + 0.5) / (n + 1)) - np.log((c + 0.5) / (m + 1)) - CAUTION * np.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))
        )

    def strength(self, texts: list[str], weights: np.ndarray) -> np.ndarray:
        out = np.full(len(texts), NOTHING)
        keys, owner = features(texts)
        if len(self.keys) and len(keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = self.keys[at] == keys
            np.maximum.at(out, owner[hit], weights[at[hit]])
        return out

    def score(self, strength: np.ndarray) -> np.ndarray:
        a, b = self.curve
        return 1 / (1 + np.exp(-np.clip(a + b * strength, -30, 30)))


def _strengths(batches: Iterator[pa.RecordBatch], decoder: Decoder, lexicon: Lexicon) -> Iterator[pa.RecordBatch]:
    """How many sample documents of each label have a strength, without their own counts."""
    less = {1: lexicon.odds(1, 0), 0: lexicon.odds(0, 1)}
    for batch in slices(batches, "text", 1 << 20):
        texts = [decoder.restore(t) for t in batch.column("text").to_pylist()]
        label = np.array(batch.column("toxic").to_pylist())
        got = np.where(label == 1, lexicon.strength(texts, less[1]), lexicon.strength(texts, less[0]))
        yield pa.RecordBatch.from_arrays([pa.array(label.astype(np.int64)), pa.array(np.round(got * 4).astype(np.int64))], ["toxic", "bin"])


def fit_curve(strength: np.ndarray, share: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic regression of one variable, slightly held towards a flat curve: Newton steps, halved until they help."""
    centre = float(np.average(strength, weights=weight))
    x = np.stack([np.ones(len(strength)), strength - centre])
    held = np.array([1e-3, 1e-2])

    def loss(c: np.ndarray) -> float:
        z = c @ x
        return float((weight * (np.logaddexp(0, z) - share * z)).sum() + (held * c**2).sum() / 2)

    c = np.array([0.0, 0.5])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(c @ x, -500, 500)))
        slope = x @ (weight * (share - p)) - held * c
        step = np.linalg.solve((x * (weight * p * (1 - p))) @ x.T + np.diag(held), slope)
        size = 1.0
        while size > 1e-9 and loss(c + size * step) > loss(c):
            size /= 2
        c = c + size * step
        if np.abs(size * step).max() < 1e-9:
            break
    b = max(float(c[1]), 0.0)
    return float(c[0]) - b * centre, b


def learn(docs: DataFrame, labels: DataFrame) -> tuple[Decoder, Lexicon]:
    """Decoder and lexicon from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``.

    The labelled sample is bounded by ``SAMPLE``, so its ids may be broadcast, and with it what is collected.
    Labels other than 0 and 1 and null ids are not used; an id with both labels counts as 0. Without any label
    every score is 0.5 or less.
    """
    decoder = Decoder(learn_characters(docs))
    marks = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")
    )
    marks = marks.groupBy("doc_id").agg(F.min("toxic").alias("toxic"))
    there = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    spread = (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30))
    rates = {t: min(1.0, SAMPLE[t] / max(there.get(t, 0), 1)) for t in SAMPLE}
    marks = marks.filter(spread < F.when(F.col("toxic") == 1, rates[1]).otherwise(rates[0]))
    sample = stage_table(docs.filter("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(marks), "doc_id"), "sample")
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}

    def counted(label: int, only: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        run = partial(_sample_features, decoder=decoder, only=only)
        rows = sample.filter(F.col("toxic") == label).select("text").mapInArrow(run, "feature long")
        rows = rows.groupBy("feature").count()
        got = (rows.filter(F.col("count") >= SUPPORT) if only is None else rows).toPandas()
        return got["feature"].to_numpy(np.int64).view(np.uint64), got["count"].to_numpy(float)

    keys, toxic = counted(1, None)
    seen, n = counted(0, keys)
    clean = np.zeros(len(keys))
    order = np.argsort(keys)
    keys, toxic = keys[order], toxic[order]
    clean[np.searchsorted(keys, seen)] = n
    lexicon = Lexicon(keys, toxic, clean, (sizes.get(1, 0), sizes.get(0, 0)))
    # Features that say nothing can neither raise a score nor need to be shipped.
    told = lexicon.weights > NOTHING / 2
    lexicon = Lexicon(keys[told], toxic[told], clean[told], lexicon.sizes)
    got = (
        sample.select("text", "toxic")
        .mapInArrow(partial(_strengths, decoder=decoder, lexicon=lexicon), "toxic long, bin long")
        .groupBy("toxic", "bin")
        .count()
        .toPandas()
    )
    if len(got):
        weight = got["count"].to_numpy(float) / got["toxic"].map(rates).to_numpy(float)
        lexicon.curve = fit_curve(got["bin"].to_numpy() / 4, got["toxic"].to_numpy(float), weight)
    else:
        lexicon.curve = (-3.0, 0.0)
    return decoder, lexicon


def _scored(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    decoder, lexicon = shared.value
    for batch in slices(batches, "text", 1 << 20):
        texts = [decoder.restore(t) if t else "" for t in batch.column("text").to_pylist()]
        kept = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in kept] + [pa.array(lexicon.score(lexicon.strength(texts, lexicon.weights)))],
            [*kept, "score"],
        )


def score_toxicity(docs: DataFrame, decoder: Decoder, lexicon: Lexicon, keep: list[str]) -> DataFrame:
    """The columns ``keep`` (without the text) with ``score``; null and empty texts score like one without any
    known feature. Rows may repeat, ids may be null; a column named ``score`` gives way; others are not read."""
    keep = [c for c in keep if c not in ("text", "score")]
    shared = docs.sparkSession.sparkContext.broadcast((decoder, lexicon))
    rows = docs.select(*keep, F.col("text").cast("string").alias("text"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name != "text")
    return rows.mapInArrow(partial(_scored, shared=shared), f"{kinds}score double")
