"""Secret scans with multipart credential linking.

A credential often comes in parts: an access identifier, a secret, an endpoint. Some parts are telling alone
(the base kinds); others (a bare 40-character key, a short hex string, a client id, an address) are weak and are
reported only where complementary parts stand nearby. Parts are found per text; the linking is an interval
join within one text: positions fall into bins as wide as the reach, each weak part meets what its own and the
two neighbouring bins hold of each class. Bins are reduced to their first and last positions before the join,
so a text with a hundred thousand parts makes no pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refrain.llm.common import slices, text_key
from refrain.sources.storage import stage_table

# Patterns of the base kinds, in the order in which spans at one place are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
# Weak kinds.
LONG_KEY = re.compile(r"(?<![A-Za-z0-9+/=])(?=[A-Za-z0-9+/]*[0-9])(?=[A-Za-z0-9+/]*[A-Z])(?=[A-Za-z0-9+/]*[a-z])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])")
SHORT_HEX = re.compile(r"(?<![0-9A-Za-z])(?=[0-9a-f]*[0-9])(?=[0-9a-f]*[a-f])[0-9a-f]{16,23}(?![0-9A-Za-z])")
IDENTIFIER = re.compile(
    r"""(?:client_?id|access_?key_?id|account_?id|user_?name)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{4,})""",
    re.IGNORECASE | re.ASCII,
)
ENDPOINT = re.compile(r"https?://[^\s\"'<>|]{4,}", re.ASCII)

KINDS = ("assign", "access", "hex", "key", "short_hex", "identifier", "endpoint")
BASE = KINDS[:3]
#: Class of each kind: identifier, secret or endpoint.
CLASSES = dict(zip(KINDS, ("secret", "identifier", "secret", "secret", "secret", "identifier", "endpoint")))
#: Code points between the starts of two parts that belong together.
REACH = 200
PART = "struct<start:int,place:int,kind:string,end:int>"


def parts_of(text: str) -> list[tuple[int, int, str, int]]:
    """(start, place in ``KINDS``, kind, end) of all parts of a text, weak ones included."""
    found = []

    def add(kind: str, spans) -> None:
        found.extend((a, KINDS.index(kind), kind, b) for a, b in spans)

    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        add("assign", (m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= 6))
    if "AKIA" in text:
        add("access", (m.span() for m in ACCESS.finditer(text) if m.end() - m.start() >= 20))
    add("hex", (m.span() for m in HEX.finditer(text)))
    taken = [(a, b) for a, _, _, b in found]
    weak = []
    if "_id" in low or "id" in low and ("clientid" in low or "accountid" in low or "keyid" in low) or "username" in low or "user_name" in low:
        weak += [("identifier", m.span()) for m in IDENTIFIER.finditer(text)]
    if "://" in low:
        weak += [("endpoint", m.span()) for m in ENDPOINT.finditer(text)]
    if _DIGITS.search(text):
        weak += [("key", m.span()) for m in LONG_KEY.finditer(text)] + [("short_hex", m.span()) for m in SHORT_HEX.finditer(text)]
    for kind, (a, b) in weak:
        if not any(a < y and x < b for x, y in taken):
            add(kind, [(a, b)])
    return sorted(found)


#: No weak key is shorter than this run of its characters.
_DIGITS = re.compile(r"[0-9a-f]{16}|[A-Za-z0-9+/]{40}")


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = {"start": pa.int32(), "place": pa.int32(), "kind": pa.string(), "end": pa.int32()}
    for batch in slices(batches, "text", 1 << 20):
        found, ends = [], [0]
        for text in batch.column("text"):
            found += parts_of(text.as_py() or "")
            ends.append(len(found))
        columns = [pa.array(c, t) for c, t in zip(list(zip(*found)) or [()] * len(types), types.values())]
        parts = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, list(types)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), parts], ["doc_id", "text_key", "parts"]
        )


def find_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """(doc_id, text_key, spans) for each row of ``docs(doc_id, text, ..)``; spans: array of (start, place, kind, end).

    Base kinds are always reported, weak ones if within ``reach`` a base part of another class starts, or parts
    of both other classes. Starts and ends are code points, end exclusive, sorted by start, then kind.
    ``text_key`` is a hash of the text; null and empty texts have no spans. Rows may repeat, doc_ids may be
    null. Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = docs.withColumn("text_key", text_key("text")).mapInArrow(
        _found, f"doc_id long, text_key long, parts array<{PART}>"
    )
    found = stage_table(found, "parts")
    base = F.filter("parts", lambda p: p["kind"].isin(*BASE))
    # Equal texts have equal links, so a key of the text is enough.
    with_weak = found.filter(F.size("parts") > F.size(base)).select("text_key", "doc_id", "parts").distinct()
    each = with_weak.select("text_key", "doc_id", F.explode("parts").alias("p")).select("text_key", "doc_id", "p.*")
    classes = F.create_map(*[F.lit(x) for pair in CLASSES.items() for x in pair])
    each = each.withColumns(
        {"class": classes[F.col("kind")], "weak": ~F.col("kind").isin(*BASE), "bin": F.floor(F.col("start") / reach)}
    )
    held = each.groupBy("doc_id", "text_key", "bin", "class", "weak").agg(
        F.min("start").alias("first"), F.max("start").alias("last")
    )
    asking = each.filter("weak").withColumn("near", F.explode(F.array(*[F.col("bin") + d for d in (-1, 0, 1)])))
    close = "a.near = a.bin OR (a.near < a.bin AND b.last >= a.start - {0}) OR (a.near > a.bin AND b.first <= a.start + {0})"
    met = asking.alias("a").join(
        held.alias("b"),
        F.expr(
            "a.doc_id <=> b.doc_id AND a.text_key = b.text_key AND a.near = b.bin AND a.class <> b.class"
            f" AND ({close.format(reach)})"
        ),
    )
    linked = (
        met.groupBy("a.doc_id", "a.text_key", "a.start", "a.place", "a.kind", "a.end")
        .agg(F.bool_or(~F.col("b.weak")).alias("strong"), F.count_distinct("b.class").alias("classes"))
        .filter("strong OR classes = 2")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_list(F.struct("start", "place", "kind", "end")).alias("linked"))
    )
    joined = found.alias("f").join(
        linked.alias("l"), F.expr("f.doc_id <=> l.doc_id AND f.text_key = l.text_key"), "left"
    )
    spans = F.sort_array(F.concat(base, F.coalesce("linked", F.array().cast(f"array<{PART}>"))))
    return joined.select("f.doc_id", "f.text_key", spans.alias("spans"))


def spans_text(spans: str | Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: str, spans: str, mark: str = "[secret]") -> Column:
    """The text with its spans replaced; spans that overlap are replaced as one."""
    state = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda s, p: F.struct(
            F.greatest(s["at"], p["end"]).alias("at"),
            F.when(
                p["start"] >= s["at"],
                F.concat(s["out"], F.array(F.substr(F.col(text), s["at"] + 1, p["start"] - s["at"]), F.lit(mark))),
            )
            .otherwise(s["out"])
            .alias("out"),
        ),
        lambda s: F.concat(F.array_join(s["out"], ""), F.substr(F.col(text), s["at"] + 1)),
    )
    return F.when(F.size(spans) > 0, state).otherwise(F.col(text))
