"""SentencePiece encoding that keeps source offsets, and decoding.

* **Normalising.** A text is read from left to right; at each place the longest prefix that the model's compiled
  character map holds is replaced, other characters stay. Blanks become the piece mark, a mark is put in
  front, and blanks are squeezed, as the model's settings say. Every normalised byte records the source byte that
  it comes from.
* **Encoding.** The normalised bytes go to the library with its own normaliser switched off. If no piece of the
  model holds a mark after another character, no merge can cross the place before a mark that follows such
  a character; long texts are cut there, so that a step holds a few kilobytes, whatever the text's length.
* **Projecting.** The pieces of a text are its normalised bytes in order, so their lengths add up to places in
  the normalised text, and the record takes those to source bytes.

The compiled map is a double-array trie with a table of replacements, read as the model file stores it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, cached_property, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.llm.common import slices, texts

# The piece mark, the replacement character, numbers of the model file's fields and kinds of pieces.
MARK = "▁".encode()
REPLACEMENT = "�".encode()
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_KIND = 1, 3
TRAINER_SUFFIX, UNKNOWN_ID, BEGIN_ID, END_ID = 24, 40, 41, 42
CHARACTER_MAP, DUMMY_PREFIX, SQUEEZE, ESCAPE = 2, 3, 4, 5
USER_DEFINED, BYTE = 4, 6
#: A normaliser message that changes nothing; put after a model's own, its fields replace those.
NO_NORMALIZER = bytes([NORMALIZER << 3 | 2, 8, CHARACTER_MAP << 3 | 2, 0, DUMMY_PREFIX << 3, 0, SQUEEZE << 3, 0, ESCAPE << 3, 0])
#: Normalised bytes that are encoded at once, about.
SEGMENT = 1 << 14


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def message(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a serialised message."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = raw[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(raw):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(tag & 7)
        size = number() if size is None else size
        yield tag >> 3, raw[at : at + size]
        at += size


class CharacterMap:
    """Longest-prefix lookup in a compiled character map."""

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little")
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist()
        self.replacements = compiled[4 + size :]

    @staticmethod
    def _step(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """(replacement, bytes replaced) of the longest key that starts at a place, if any does."""
        node, found = self._step(self.units[0]), None
        for end in range(at, len(data)):
            node ^= data[end]
            unit = self.units[node]
            if unit & 0x800000FF != data[end]:
                break
            node ^= self._step(unit)
            if unit >> 8 & 1:
                start = self.units[node] & 0x7FFFFFFF
                found = self.replacements[start : self.replacements.index(0, start)], end + 1 - at
        return found


class Normalizer:
    """A model's normaliser with the record of source bytes."""

    def __init__(self, charmap: CharacterMap | None, prefix: bool, squeeze: bool, escape: bool, suffix: bool, own: list[bytes]):
        self.charmap, self.prefix, self.squeeze, self.suffix = charmap, prefix, squeeze, suffix
        self.blank = MARK if escape else b" "
        self.own = sorted(own, key=len, reverse=True)

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """(normalised bytes, source byte of each and of the end)."""
        if not text:
            return b"", np.zeros(1, np.int64)
        if self.charmap is None and not self.own and not self.squeeze:
            return self._plain(text)
        return self._general(text)

    def _plain(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The same for a model that replaces blanks only."""
        data = np.frombuffer(text, np.uint8)
        # Bytes of one character come from its first byte.
        source = np.maximum.accumulate(np.where(data & 0xC0 == 0x80, 0, np.arange(len(text))))
        source = np.repeat(source, np.where(data == 32, len(self.blank), 1))
        before = self.blank if self.prefix and not self.suffix else b""
        after = self.blank if self.prefix and self.suffix else b""
        ends = np.full(len(after) + 1, len(text))
        return before + text.replace(b" ", self.blank) + after, np.concatenate([np.zeros(len(before), np.int64), source, ends])

    def _next(self, text: bytes, at: int) -> tuple[bytes, int]:
        for symbol in self.own:
            if text.startswith(symbol, at):
                return symbol, len(symbol)
        found = self.charmap.longest(text, at) if self.charmap else None
        if found:
            return found
        lead = text[at]
        size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return text[at : at + size], size

    def _general(self, text: bytes) -> tuple[bytes, np.ndarray]:
        at = 0
        if self.squeeze:
            while at < len(text):
                part, size = self._next(text, at)
                if part != b" ":
                    break
                at += size
            if at == len(text):
                return b"", np.array([0])
        out, source = bytearray(), []

        def put(part: bytes, place: int) -> None:
            out.extend(part)
            source.extend([place] * len(part))

        if self.prefix and not self.suffix:
            put(self.blank, at)
        after_blank = self.squeeze
        while at < len(text):
            part, size = self._next(text, at)
            if after_blank:
                part = part.lstrip(b" ")
            if part:
                put(part.replace(b" ", self.blank), at)
                after_blank = part.endswith(b" ")
            at += size
            after_blank = after_blank and self.squeeze
        if self.squeeze:
            while out.endswith(self.blank):
                del out[-len(self.blank) :]
                at = source[len(out)]
                del source[len(out) :]
        if self.prefix and self.suffix:
            put(self.blank, at)
        return bytes(out), np.array([*source, at], np.int64)


class Model:
    """A model file: normaliser, encoder of normalised text, decoder."""

    def __init__(self, raw: bytes):
        kinds, pieces, settings, trainer = [], [], {DUMMY_PREFIX: 1, SQUEEZE: 1, ESCAPE: 1}, {}
        for field, value in message(raw):
            if field == PIECES:
                piece = dict(message(value))
                pieces.append(piece[PIECE_TEXT])
                kinds.append(piece.get(PIECE_KIND, 1))
            elif field == NORMALIZER:
                settings |= dict(message(value))
            elif field == TRAINER:
                trainer = dict(message(value))
        compiled = settings.get(CHARACTER_MAP) or b""
        own = [p for p, k in zip(pieces, kinds) if k == USER_DEFINED]
        self.normalize = Normalizer(
            CharacterMap(compiled) if compiled else None,
            bool(settings[DUMMY_PREFIX]),
            bool(settings[SQUEEZE]),
            bool(settings[ESCAPE]),
            bool(trainer.get(TRAINER_SUFFIX, 0)),
            own,
        )
        self.lengths = np.array([1 if k == BYTE else len(p) for p, k in zip(pieces, kinds)], np.int64)
        # Merges stay within "marks, then other characters" if every piece does.
        self.divisible = not own and not any(MARK in p[_marks(p) :] for p in pieces)
        self.raw = raw
        self.begin, self.end, self.unknown = (trainer.get(f, d) for f, d in ((BEGIN_ID, 1), (END_ID, 2), (UNKNOWN_ID, 0)))

    @cached_property
    def encoder(self):
        """The library's encoder without its normaliser."""
        return _processor(self.raw + NO_NORMALIZER)

    @cached_property
    def decoder(self):
        return _processor(self.raw)

    def segments(self, data: bytes, size: int = SEGMENT) -> list[bytes]:
        """The normalised text in parts that encode on their own."""
        out, start = [], 0
        while self.divisible and len(data) - start > size:
            cut = data.find(MARK, start + size)
            while cut > 0 and data.endswith(MARK, start, cut):
                cut = data.find(MARK, cut + len(MARK))
            if cut < 0:
                break
            out.append(data[start:cut])
            start = cut
        return [*out, data[start:]]

    def encode(self, text: bytes, size: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids with begin and end, first source byte, end of the source bytes) of each piece."""
        data, source = self.normalize(text)
        ids: list[np.ndarray] = []
        widths: list[np.ndarray] = []
        for part in self.segments(data, size):
            got = self.encoder.encode(part.decode(), return_type="numpy")
            ids.append(got)
            if (got == self.unknown).any():
                found = self.encoder.encode(part.decode(), return_type="proto").pieces
                widths.append(np.array([len(p.surface.encode()) for p in found], np.int64))
            else:
                widths.append(self.lengths[got])
        places = source[np.cumsum(np.concatenate([[0], *widths]).astype(np.int64))]
        edge = [len(text)]
        return (
            np.concatenate([[self.begin], *ids, [self.end]]).astype(np.int32),
            np.concatenate([[0], places[:-1], edge]).astype(np.int32),
            np.concatenate([[0], places[1:], edge]).astype(np.int32),
        )


def _processor(raw: bytes):
    import sentencepiece

    out = sentencepiece.SentencePieceProcessor()
    out.load_from_serialized_proto(raw)
    return out


def _marks(piece: bytes) -> int:
    """Bytes of the marks that a piece begins with."""
    at = 0
    while piece.startswith(MARK, at):
        at += len(MARK)
    return at


@cache
def load(path: str) -> Model:
    """The model of a file, once a worker."""
    with open(path, "rb") as file:
        return Model(file.read())


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, parts)])
    values = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


def _encoded(batches: Iterator[pa.RecordBatch], text: str, path: str) -> Iterator[pa.RecordBatch]:
    model = load(path)
    for batch in slices(batches, text, 1 << 20):
        columns = [list(c) for c in zip(*[model.encode(t) for t in texts(batch, text)])] or [[], [], []]
        names = [c for c in batch.schema.names if c != text]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in names] + [_lists(c) for c in columns], [*names, "ids", "starts", "ends"]
        )


def encode(docs: DataFrame, text: str = "text", path: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all but the text by default) with ``ids``, ``starts`` and ``ends``.

    ``ids`` are the library's for the whole text, with begin and end ids; ``starts`` and ``ends`` (exclusive) are
    the bytes of the UTF-8 text that each stands for. Begin and end stand for none, like a mark put in front and
    all but the last of the byte pieces of one replaced character. A null or empty text has the begin and end
    ids alone. Rows may repeat and keys may be null. Columns of ``docs`` named like the new ones give way. A
    text of more than 2 GB cannot be a Spark value. The model file must be readable on executors.
    """
    new = ("ids", "starts", "ends")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (text, *new)]
    docs = docs.select(*keep, F.col(text).cast("string").alias(text))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema if f.name != text)
    return docs.mapInArrow(
        partial(_encoded, text=text, path=path or default_path()), kinds + ", ".join(f"{c} array<int>" for c in new)
    )


def _decoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    decoder = load(path).decoder
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            lists = part.column("ids")
            out = [decoder.decode(ids.values.to_numpy()) if ids.is_valid and len(ids) else "" for ids in lists]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.string())], [*part.schema.names, "decoded"])


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """The table with ``decoded``, the text of its ``ids``; null or no ids give an empty text."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name != "decoded")
    return encoded.drop("decoded").mapInArrow(partial(_decoded, path=path or default_path()), f"{kinds}, decoded string")
