"""Substring de-duplication against all smaller documents.

A relative Lempel-Ziv parse factors a document, left to right, into the longest phrases that a reference holds. One
greedy parse after the other against every block of the corpus would read each document once per block, and
it would still miss windows that lie across the boundary of two factors. So the **parse is replaced by lookup**:
every window of ``window`` words is looked up in an index of all windows that may repeat, cut into blocks by
hash. What a parse against all blocks with a check of the factor boundaries finds is exactly this: the words of all
windows that a smaller document holds; runs of them are the factors reported.

* **Whole texts.** A text whose words equal those of a document with a smaller doc_id is one factor. Only the smallest
  document of equal ones takes further part, so a large group of copies costs a row each.
* **Anchors.** Of each window the ``ANCHOR``-word phrase with the smallest hash is an anchor, so equal windows have
  equal anchors. Anchors that only one document has cannot be part of a repeated window and go.
* **Index.** The windows around shared anchors: phrase -> smallest doc_id. A phrase is told by two 64-bit hashes.

Both joins are plain: partial aggregates come before the shuffle, and a skewed phrase may be split. Rows are a few
numbers; texts are moved once, to their factors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.llm.common import slices, text_key, texts
from refrain.llm.words import hash_texts, mix, ramp, shingles
from refrain.sources.storage import drop_stages, stage_table

#: Words of an anchor.
ANCHOR = 8


_OTHER = np.uint64(0xA24BAED4963EE407)


def _windows(hashes: np.ndarray, counts: np.ndarray, window: int):
    """For each full window: its text, its place in the text, its two hashes, and its anchor's hash."""
    enough = counts >= window
    n = np.where(enough, counts - window + 1, 0)
    owner, at = np.repeat(np.arange(len(counts)), n), ramp(n)
    short = min(ANCHOR, window)
    phrases, n_phrases = _only(hashes, counts, enough, short)
    first = np.cumsum(n_phrases) - n_phrases
    base = first[owner] + at
    anchor = phrases[base].copy()
    for j in range(1, window - short + 1):
        np.minimum(anchor, phrases[base + j], out=anchor)
    whole, _ = _only(hashes, counts, enough, window)
    # The second hash starts from other word hashes, so it fails independently of the first.
    second, _ = _only(mix(hashes ^ _OTHER), counts, enough, window)
    return owner, at, (whole, second), anchor


def _only(hashes: np.ndarray, counts: np.ndarray, enough: np.ndarray, k: int):
    """The k-word phrases of the texts that are long enough."""
    kept = hashes[np.repeat(enough, counts)]
    runs, sizes = shingles(kept, counts[enough], k)
    out = np.zeros(len(counts), np.int64)
    out[enough] = sizes
    return runs, out


def _anchors(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            owner, _, _, anchor = _windows(*hash_texts(texts(batch, "text")), window)
            doc = batch.column("doc_id").to_numpy(zero_copy_only=False)[owner]
            new = np.ones(len(anchor), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
            anchor, doc = anchor[new], doc[new]
            order = np.lexsort((anchor, doc))
            anchor, doc = anchor[order], doc[order]
            new = np.ones(len(anchor), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[new].view(np.int64)), pa.array(doc[new].astype(np.int64))], ["anchor", "doc_id"]
            )

    return run


def _shared_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            owner, at, (whole, second), anchor = _windows(*hash_texts(texts(batch, "text")), window)
            lists = batch.column("anchors")
            shared = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            # A window is wanted if its own document lists its anchor.
            mine = np.repeat(np.arange(len(sizes)), sizes)
            salt = lambda a, d: mix(a ^ mix(d.astype(np.uint64) + np.uint64(1)))
            hit = np.flatnonzero(np.isin(salt(anchor, owner), salt(shared, mine)))
            doc = batch.column("doc_id").to_numpy(zero_copy_only=False)[owner[hit]].astype(np.int64)
            key = batch.column("text_key").to_numpy(zero_copy_only=False)[owner[hit]].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(whole[hit].view(np.int64)), pa.array(second[hit].view(np.int64))]
                + [pa.array(doc), pa.array(key), pa.array(at[hit].astype(np.int32))],
                ["phrase", "second", "doc_id", "text_key", "at"],
            )

    return run


def _identities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, key of the text, and for its words in order: their number and two hashes."""
    for batch in slices(batches, "text"):
        hashes, counts = hash_texts(texts(batch, "text"))
        starts = np.cumsum(counts) - counts
        place = ramp(counts).astype(np.uint64)
        sums = []
        for salt in (np.uint64(1), _OTHER):
            total = np.zeros(len(hashes) + 1, np.uint64)
            np.cumsum(mix(mix(hashes ^ salt) + place * _OTHER), out=total[1:])
            sums.append(pa.array((total[starts + counts] - total[starts]).view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(counts), *sums],
            ["doc_id", "text_key", "n", "k1", "k2"],
        )


def _runs(window: int):
    """Factors of each document as word ranges, from the starts of its found windows."""

    def merge(starts: np.ndarray) -> tuple[list[int], list[int]]:
        starts = np.unique(starts)
        breaks = np.flatnonzero(np.diff(starts) > window)
        return starts[np.append(0, breaks + 1)].tolist(), (starts[np.append(breaks, len(starts) - 1)] + window).tolist()

    return merge


def _kept(window: int):
    merge = _runs(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found, copies = batch.column("found"), batch.column("copy").to_pylist()
            n_words, n_removed, kept, lows, highs = [], [], [], [], []
            for row, text in enumerate(texts(batch, "text")):
                words = text.split()
                low, high = [], []
                if copies[row]:
                    low, high = [0], [len(words)]
                elif found[row].is_valid and len(found[row]):
                    low, high = merge(np.asarray(found[row].values))
                n_words.append(len(words))
                n_removed.append(sum(high) - sum(low))
                lows.append(low)
                highs.append(high)
                parts, last = [], 0
                for a, b in zip(low, high):
                    parts += words[last:a]
                    last = b
                kept.append(b" ".join(parts + words[last:]) if low else b" ".join(words))
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
                + [pa.array(kept, pa.binary()).cast(pa.string()), pa.array(lows, ints), pa.array(highs, ints)],
                ["doc_id", "n_words", "n_removed", "kept_text", "factor_starts", "factor_ends"],
            )

    return run


def remove_repeats(docs: DataFrame, window: int = 13) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text, factor_starts, factor_ends for each row of ``docs``.

    Words are runs without ASCII white space, compared unchanged. A word is removed if a run of ``window``
    words that covers it also stands in a document with a smaller doc_id. ``kept_text`` joins the other words
    by one space; the factors are the removed word ranges, end exclusive. Null texts have no words. A row
    without a doc_id neither loses words nor serves as reference; rows that repeat a doc_id are one document
    and do not remove each other's words. Other columns are not read.
    """
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).withColumn("text_key", text_key("text"))
    known = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL")
    same = ["n", "k1", "k2"]
    marked = known.mapInArrow(_identities, "doc_id long, text_key long, n long, k1 long, k2 long")
    marked = stage_table(marked.filter(F.col("n") >= window), "identities")
    firsts = marked.groupBy(*same).agg(F.min("doc_id").alias("first"), F.count("*").alias("rows"))
    copies = marked.join(firsts.filter("rows > 1"), same).filter("doc_id > first").select("doc_id", "text_key")
    copies = stage_table(copies.distinct(), "copies")
    single = known.join(copies, ["doc_id", "text_key"], "left_anti")
    anchors = stage_table(
        single.select("doc_id", "text").mapInArrow(_anchors(window), "anchor long, doc_id long"), "anchors"
    )
    shared = anchors.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    per_doc = (
        anchors.join(shared.filter("low < high").select("anchor"), "anchor", "left_semi")
        .groupBy("doc_id")
        .agg(F.collect_list("anchor").alias("anchors"))
    )
    per_doc = stage_table(per_doc, "shared-anchors")
    drop_stages(anchors)
    phrases = stage_table(
        single.join(per_doc, "doc_id").mapInArrow(
            _shared_windows(window), "phrase long, second long, doc_id long, text_key long, at int"
        ),
        "phrases",
    )
    index = phrases.groupBy("phrase", "second").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    found = (
        phrases.join(index.filter("low < high").select("phrase", "second", "low"), ["phrase", "second"])
        .filter("doc_id > low")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_list("at").alias("found"))
    )
    found = stage_table(found, "factors")
    drop_stages(marked, per_doc, phrases)
    whole = copies.withColumn("copy", F.lit(True)).withColumn("found", F.lit(None).cast("array<int>"))
    cut = found.select("doc_id", "text_key", F.lit(False).alias("copy"), "found").unionByName(whole)
    return docs.join(cut, ["doc_id", "text_key"], "left").drop("text_key").mapInArrow(
        _kept(window),
        "doc_id long, n_words long, n_removed long, kept_text string,"
        " factor_starts array<int>, factor_ends array<int>",
    )
