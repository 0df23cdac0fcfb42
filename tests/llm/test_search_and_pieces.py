"""Ranked search, hard negatives and piece encoding against plain Python versions and the library."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from refrain.llm import catalog, negatives, pieces, ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"
VECTORS = "id long, label long, vector array<float>"


def terms(text: str | None) -> list[str]:
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def ranking(docs, items, k: int) -> dict:
    """Score lists of each (item_id, text) by scoring every document."""
    words = [(doc, Counter(terms(text))) for doc, text in docs]
    n_docs, total = sum(bool(c) for _, c in words), sum(sum(c.values()) for _, c in words)
    df = Counter(t for _, c in words for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = defaultdict(list)
    for item, text in set(items):
        got = []
        for doc, counts in words:
            m = 75 + 25 * sum(counts.values()) * n_docs // max(total, 1)
            score = sum(weight[t] * (10**9 * counts[t] // (1000 * counts[t] + 12 * m)) for t in terms(text) if t in counts)
            if score > 0:
                got.append((-score, doc is None, doc or 0, doc))
        out[item] += [(i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(got, key=lambda r: r[:3])[:k])]
    return {i: sorted(r) for i, r in out.items() if r}


def listed(rows) -> dict:
    out = defaultdict(list)
    for r in rows:
        out[r.item_id].append((r.rank, r.doc_id, r.score))
    return {i: sorted(r) for i, r in out.items()}


@pytest.fixture
def small_blocks(monkeypatch):
    """Several blocks and deep trees from a few rows; workers get the sizes with the functions' module state."""
    for name, value in {"ITEMS": 5, "ENTRIES": 60, "SHARE": 3}.items():
        monkeypatch.setattr(ranked, name, value)


def test_ranked_search_equals_scoring_every_document(spark, small_blocks):
    rng = random.Random(3)
    pool = [f"w{i}" for i in range(60)] + ["Ä", "ñandú", "语", "X1", "x1"]
    draw = lambda n: rng.choice([" ", "-", "\n"]).join(rng.choices(pool, weights=[1 / (i + 1) for i in range(len(pool))], k=n))
    docs = [(i, draw(rng.randrange(1, 60))) for i in range(700)]
    docs += [(i, docs[5][1]) for i in range(2000, 2040)] + [docs[7], docs[7]]
    docs += [(-1, None), (-2, ""), (-3, " \t.,;"), (None, "w1 w2 w3"), (None, "w1 w2 w3"), (-4, "w3 " * 40_000), (-5, "y" * 70_000)]
    items = [(i, draw(rng.randrange(1, 25))) for i in range(23)] + [(50, docs[5][1])]
    items += [(60, None), (61, ""), (62, "neverseen"), (None, "w1 w1 X1"), items[0], (1, "w4 w5"), (63, "w2 " * 3_000)]
    extra = spark.createDataFrame(docs, DOCS).withColumns({"n": F.lit(1), "terms": F.lit("x"), "row": F.lit(None)})
    asked = spark.createDataFrame(items, ITEMS).withColumns({"q": F.lit(1), "term": F.lit("x")})
    want = ranking(docs, items, 20)
    for rows in (extra, extra.repartition(13)):
        assert listed(ranked.search(rows, asked, k=20).collect()) == want
    assert ranked.search(extra.limit(0), asked).count() == 0
    assert ranked.search(extra, asked.limit(0)).count() == 0


def test_trees_prune_and_lose_nothing():
    """Walked by hand over one batch: fewer pairs are scored than there are, with the same lists."""
    import pyarrow as pa

    rng = random.Random(9)
    texts = [" ".join(f"g{i % 40}x{rng.randrange(30)}" for _ in range(12)) for i in range(3_000)]
    items = [(i, " ".join(f"g{i}x{j}" for j in range(10))) for i in range(40)]
    table = pa.Table.from_batches(
        ranked._item_terms(iter(pa.table({"row": range(40), "item_id": [i for i, _ in items], "text": [t for _, t in items]}).to_batches()))
    )

    class Shared:
        value = np.full(ranked.BITS >> 6, ~np.uint64(0))

    batch = pa.Table.from_batches(
        ranked._vectors(iter(pa.table({"doc_id": range(3_000), "text": texts}).to_batches()), Shared)
    ).combine_chunks().to_batches()[0]
    df = Counter(t for x in texts for t in set(x.split()))
    weights = [math.floor(1000 * math.log(6002 / (2 * df[t] + 1))) for t in table.column("term").to_pylist()]
    block = ranked.build_block(table.append_column("w", pa.array(weights, pa.int64())))
    docs = ranked.Documents(batch, block, 3_000, 36_000)
    scored, dense = [], docs.dense
    docs.dense = lambda columns, found: (scored.append(len(found)), dense(columns, found))[1]
    lists = ranked.Lists(block, 20)
    ranked.search_trees(docs, block.root, 0, np.arange(1), lists)
    assert sum(scored) * ranked.ITEM_LEAF < 0.8 * 40 * 3_000
    got = defaultdict(list)
    for part in lists.batches(block):
        for r in part.to_pylist():
            got[r["item_id"]].append((-r["score"], r["doc_id"]))
    want = ranking(list(enumerate(texts)), items, 20)
    assert {i: [(k + 1, d, -s) for k, (s, d) in enumerate(sorted(r))] for i, r in got.items()} == want


def mined(rows, anchors, k: int = 5) -> list[tuple]:
    """Hard negatives by scoring every pair with Python's whole numbers."""
    rows, anchors = set(rows), set(anchors)
    whole = lambda v: [math.floor(256 * x) for x in v]
    out = []
    for anchor, label, vector in anchors:
        mine = whole(vector)
        scored = [
            (sum(a * b for a, b in zip(mine, whole(v))), i, other)
            for i, other, v in rows
            if len(v) == len(vector)
        ]
        order = lambda r: (-r[0], r[1])
        for top, positive, _ in sorted((r for r in scored if r[2] == label and r[1] != anchor), key=order)[:k]:
            window = sorted((r for r in scored if r[2] != label and 80 * top <= 100 * r[0] <= 100 * top), key=order)[:k]
            out += [(anchor, positive, n + 1, other, top, score) for n, (score, other, _) in enumerate(window)]
    return sorted(out)


def test_hard_negatives_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(negatives, "LEAST", 16)
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(4, 7))
    rows = []
    for i in range(400):
        v = centre[i % 4] + rng.normal(size=7) * (0.4 if i % 3 else 0.0)
        rows.append((i, i % 3, tuple(np.float32(v / 4).tolist())))
    rows += [(500 + i, 9, (0.5, 0.25)) for i in range(4)] + [(600 + i, 8, (0.5, 0.25)) for i in range(3)]
    rows += [(700, 1, ()), (800, 2, (0.0,) * 7), rows[0], rows[0], rows[20], (20, 2, rows[20][2]), (900, 77, rows[3][2])]
    anchors = [r for r in rows if r[0] % 20 == 0]
    odd = [(None, 1, (0.1,) * 7), (1001, None, (0.1,) * 7), (1002, 1, None)]
    table = spark.createDataFrame(rows + odd, VECTORS).withColumns({"shard": F.lit("x"), "anchor": F.lit(5), "row": F.lit(0)})
    asked = spark.createDataFrame(anchors + odd, VECTORS)
    want = mined(rows, anchors)
    assert len(want) > 200
    for vectors in (table, table.repartition(11)):
        got = negatives.hard_negatives(vectors, asked)
        columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        assert sorted(tuple(r) for r in got.select(columns).collect()) == want
    assert negatives.hard_negatives(table.limit(0), asked).count() == 0
    assert negatives.hard_negatives(table, asked.limit(0)).count() == 0


@pytest.mark.parametrize("direct", [1, 2, 8, 32])
def test_strassen_equals_the_plain_product(direct):
    rng = np.random.default_rng(direct)
    for m, k, n in ((1, 1, 1), (3, 5, 7), (33, 65, 17), (64, 64, 200), (1, 40, 9), (0, 4, 5)):
        a, b = rng.integers(-(2**20), 2**20, (m, k)), rng.integers(-(2**20), 2**20, (k, n))
        assert (negatives.strassen(a, b, direct) == a @ b).all()
    a, b = (rng.integers(-(2**62), 2**62, (9, 9)) for _ in range(2))
    assert (negatives.strassen(a, b, direct) == a @ b).all()


def test_components_beyond_64_bits_are_held():
    got = negatives.scaled(np.array([1e300, -1e300, -0.001, 0.999]), 256)
    assert got.tolist()[2:] == [-1, 255] and got[0] > 2**62 and got[1] < -(2**62)


ODD_TEXTS = [
    "", " ", "  a", "a  ", " " * 70, "x" * 40_000, "é ü 語 " * 9_000, "▁▁a▁ b", "<s> </s> <0x41> <unk>", "\x00\x01 tab\tline\n\r end",
    "🙂🙃 flags 🇩🇪 é", "a" * 16_383 + " b", " word" * 7_000,
]


def test_pieces_equal_the_library(spark, small_folder):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())
    real = [r.text for r in spark.read.parquet(f"{small_folder}/documents.parquet").select("text").collect()]
    rng = random.Random(2)
    mixed = ["".join(rng.choices("ab  ▁\n\tñ語🙂<s></s>́", k=rng.randrange(60))) for _ in range(200)]
    rows = [(i, t) for i, t in enumerate(real + ODD_TEXTS + mixed)] + [(None, "no id"), (None, None), (0, real[0])]
    table = spark.createDataFrame(rows, DOCS).withColumns({"ids": F.lit("x"), "starts": F.lit(1), "extra": F.lit("e"), "decoded": F.lit(0)})
    out = pieces.decode(pieces.encode(table, keep=["doc_id", "extra"])).collect()
    assert len(out) == len(rows)
    by_id = {i: t for i, t in rows if i is not None}
    for r in out:
        if r.doc_id is None:
            continue
        text = by_id[r.doc_id]
        assert r.ids == library.encode(text, add_bos=True, add_eos=True)
        assert r.decoded == library.decode(r.ids) and r.extra == "e"
        if len(text) < 5_000:
            found = library.encode(text.encode(), return_type="proto").pieces
            assert (r.starts[1:-1], r.ends[1:-1]) == ([p.begin for p in found], [p.end for p in found])
        assert r.starts[0] == r.ends[0] == 0 and r.starts[-1] == r.ends[-1] == len(text.encode())
    assert [r.ids for r in out if r.doc_id is None and r.decoded == ""] == [[1, 2]]
    assert pieces.encode(table.limit(0)).count() == 0


@pytest.mark.parametrize("rule", ["identity", "nfkc", "nmt_nfkc", "nmt_nfkc_cf"])
def test_compiled_maps_give_the_library_text_and_offsets(rule):
    import sentencepiece

    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, remove_extra_whitespaces=True, add_dummy_prefix=True, escape_whitespaces=True)
    settings = {pieces.DUMMY_PREFIX: 1, pieces.SQUEEZE: 1, pieces.ESCAPE: 1}
    for field, value in pieces.message(library.serialized_model_proto()):
        if field == pieces.NORMALIZER:
            settings |= dict(pieces.message(value))
    compiled = settings.get(pieces.CHARACTER_MAP) or b""
    ours = pieces.Normalizer(
        pieces.CharacterMap(compiled) if compiled else None,
        *[bool(settings[s]) for s in (pieces.DUMMY_PREFIX, pieces.SQUEEZE, pieces.ESCAPE)],
        False,
        [],
    )
    rng = random.Random(6)
    for _ in range(1_500):
        text = "".join(rng.choices("aA  　ﬁé①ｶﾞ▁ñé한글가½\t", k=rng.randrange(12)))
        want, offsets = library.normalize(text, with_offsets=True)
        got, source = ours(text.encode())
        assert got.decode() == want
        to_byte = np.cumsum([0, *(len(c.encode()) for c in text)])
        marks = np.cumsum([0, *(len(c.encode()) for c in want)])
        assert source[marks].tolist() == [int(to_byte[o]) for o in offsets]


def test_the_query_of_pieces_digests_them(spark, small_folder):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{small_folder}/documents.parquet").collect()}
    got = catalog.QUERIES["op13_pieces"](spark, small_folder).collect()
    assert len(got) == len(text)
    for r in got:
        ids = library.encode(text[r.doc_id] or "", add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids) and r.n_bytes == len((text[r.doc_id] or "").encode())
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
