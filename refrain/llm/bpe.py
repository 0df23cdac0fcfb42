"""Byte-level BPE encoding by overlapping chunks, and decoding by joining bytes.

A long text is cut into chunks that overlap. Chunks are rows, so they are pre-tokenised in parallel, whichever
text they come from. The pre-token pattern reads from left to right and looks at most one character past a
match, so once two neighbouring chunks agree on a boundary, they agree from there on: the pair is stitched at
such a boundary, and everything between two stitches is a piece that encodes on its own. If an overlap
has no common boundary (one long run of letters or spaces), the two chunks stay one piece. A text that fits
in one chunk is a piece by itself and is not moved.

A boundary counts only after a non-space character: a run of spaces may be divided differently at the end of a
piece, other pre-tokens may not. Boundaries of a chunk's last match are not used, since it may be cut short.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.llm.common import free_name, slices
from refrain.sources.storage import stage_table

#: Characters that a chunk adds to the one before it, and characters that both have.
CHUNK = 1 << 16
OVERLAP = 1 << 10


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@cache
def encoding(path: str, pattern: str):
    """The encoder of a rank file, once a worker."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@cache
def _pretokens(pattern: str):
    import regex

    return regex.compile(pattern)


def boundaries(chunk: str, pattern: str, last: bool, after: int = 0) -> list[int]:
    """Ends of the pre-tokens of a chunk at or after a place, where a piece may end."""
    ends = [m.end() for m in _pretokens(pattern).finditer(chunk)]
    if not last:
        ends = ends[:-1]
    return [e for e in ends if e >= after and not chunk[e - 1].isspace()]


def chunk_places(length: int, chunk: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of the chunks of a text; each but the first starts ``overlap`` before the last one's end."""
    starts = range(0, max(length - overlap, 1), chunk)
    return [(s, min(s + chunk + overlap, length)) for s in starts]


def _chunks(batches: Iterator[pa.RecordBatch], key: str, text: str, chunk: int, overlap: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, text, 1 << 20):
        rows = []
        for k, whole in zip(batch.column(key).to_pylist(), batch.column(text).to_pylist()):
            places = chunk_places(len(whole), chunk, overlap)
            rows += [(k, i, a, i == len(places) - 1, whole[a:b]) for i, (a, b) in enumerate(places)]
        yield _batch(rows, [(key, pa.int64()), ("chunk", pa.int64()), ("start", pa.int64()), ("last", pa.bool_()), ("part", pa.string())])


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])


def _boundary_sets(batches: Iterator[pa.RecordBatch], key: str, pattern: str, overlap: int) -> Iterator[pa.RecordBatch]:
    """For each chunk the boundaries that it sees in the overlaps with its neighbours, as places in the text."""
    for batch in slices(batches, "part", 1 << 20):
        rows = []
        columns = [batch.column(c).to_pylist() for c in (key, "chunk", "start", "last", "part")]
        for k, i, start, last, part in zip(*columns):
            ends = boundaries(part, pattern, last)
            head = [start + e for e in ends if i and e <= overlap]
            tail = [start + e for e in ends if not last and e >= len(part) - overlap]
            rows.append((k, i, head, tail))
        places = pa.list_(pa.int64())
        yield _batch(rows, [(key, pa.int64()), ("chunk", pa.int64()), ("head", places), ("tail", places)])


def _encoded(batches: Iterator[pa.RecordBatch], text: str, path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    encoder = encoding(path, pattern)
    for batch in slices(batches, text, 1 << 20):
        ids = [encoder.encode_ordinary(t or "") for t in batch.column(text).to_pylist()]
        names = [c for c in batch.schema.names if c != text]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in names] + [pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
        )


def encode(
    docs: DataFrame,
    text: str = "text",
    path: str | None = None,
    pattern: str | None = None,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` (all but the text by default) and ``ids``, the token ids of the whole text.

    A null or empty text has no ids; special tokens are ordinary text. Rows may repeat and keys may be null.
    A column of ``docs`` named ``ids`` gives way to the new one. The rank file must be readable on executors.
    """
    path, pattern = path or default_path(), pattern or default_pattern()
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (text, "ids")]
    docs = docs.select(*keep, F.col(text).cast("string").alias(text))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text)
    schema = f"{kinds}, ids array<int>" if kinds else "ids array<int>"
    run = partial(_encoded, text=text, path=path, pattern=pattern)
    one = docs.filter(F.coalesce(F.length(text), F.lit(0)) <= chunk + overlap).mapInArrow(run, schema)
    long = docs.filter(F.length(text) > chunk + overlap)
    return one.unionByName(_encode_long(long, text, path, pattern, chunk, overlap))


def _encode_long(long: DataFrame, text: str, path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """The same for texts of several chunks, chunk by chunk.

    The rows are written with their keys first: they are read three times and must have the same key each time.
    """
    key = free_name(long, "row")
    long = stage_table(long.withColumn(key, F.monotonically_increasing_id()), "long-texts")
    chunks = long.select(key, text).mapInArrow(
        partial(_chunks, key=key, text=text, chunk=chunk, overlap=overlap),
        f"{key} long, chunk long, start long, last boolean, part string",
    )
    chunks = chunks.repartition(key, "chunk")
    seen = chunks.mapInArrow(
        partial(_boundary_sets, key=key, pattern=pattern, overlap=overlap),
        f"{key} long, chunk long, head array<long>, tail array<long>",
    )
    # The tail of one chunk meets the head of the next; the first common boundary is the stitch.
    stitch = (
        seen.select(key, (F.col("chunk") + 1).alias("chunk"), "tail")
        .join(seen.select(key, "chunk", "head"), [key, "chunk"])
        .select(key, "chunk", F.array_min(F.array_intersect("tail", "head")).alias("cut"))
    )
    # A chunk without a stitch before it continues the piece of the chunk before.
    cuts = stitch.filter("cut IS NOT NULL").groupBy(key).agg(F.sort_array(F.collect_list("cut")).alias("cuts"))
    pieces = (
        long.select(key, text)
        .join(cuts, key, "left")
        .withColumn("cuts", F.concat(F.array(F.lit(0).cast("long")), F.coalesce("cuts", F.array().cast("array<long>"))))
        .mapInArrow(partial(_pieces, key=key, text=text), f"{key} long, piece long, part string")
        .repartition(key, "piece")
    )
    encoded = pieces.mapInArrow(
        partial(_encoded, text="part", path=path, pattern=pattern), f"{key} long, piece long, ids array<int>"
    )
    whole = encoded.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("piece", "ids"))).alias("parts"))
    whole = whole.select(key, F.flatten("parts.ids").alias("ids"))
    return long.drop(text).join(whole, key).drop(key)


def _pieces(batches: Iterator[pa.RecordBatch], key: str, text: str) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, text, 1 << 20):
        rows = []
        for k, whole, cuts in zip(*[batch.column(c).to_pylist() for c in (key, text, "cuts")]):
            rows += [(k, i, whole[a:b]) for i, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(whole)]))]
        yield _batch(rows, [(key, pa.int64()), ("piece", pa.int64()), ("part", pa.string())])


@cache
def token_bytes(path: str) -> dict[int, bytes]:
    """The bytes of each token of a rank file."""
    with open(path, "rb") as lines:
        return {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in lines if line.strip())}


def _decoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    part_of = token_bytes(path).__getitem__
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            raw = [b"".join(map(part_of, ids or [])) for ids in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(raw, pa.binary())], [*part.schema.names, "decoded"])


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """The table with ``decoded``: the raw bytes of its ``ids`` joined; null or no ids give no bytes."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name != "decoded")
    return encoded.drop("decoded").mapInArrow(
        partial(_decoded, path=path or default_path()), f"{kinds}, decoded binary"
    )
