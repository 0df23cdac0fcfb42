"""Chat formatting with a grammar round trip, in DataFrame functions alone.

A turn is rendered as ``<|im_start|>role``, a line feed, its text, ``<|im_end|>`` and a line feed. A conversation
is first rendered as it is and read back by the deterministic parser; if what comes back differs from the
source, the turns that do not come back as they went in are escaped, and if that is not enough, all are.

Escaping puts one backslash into ``<``, any number of backslashes, ``|``; reading takes one out. Roles also have
``%`` and line feeds written as ``%25`` and ``%0A``. Both are reversible and leave no control string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refrain.llm.common import let

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def _block(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END))


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a rendered conversation, read from left to right: each start mark begins a turn,
    its role ends at the first line feed, its text at the first end mark; what follows up to the next start
    mark is skipped."""

    def turn(piece: Column) -> Column:
        return let(
            F.substring_index(piece, END.strip(), 1),
            lambda b: F.struct(
                unescape_role(F.substring_index(b, "\n", 1)).alias("role"),
                unescape(F.substr(b, F.length(F.substring_index(b, "\n", 1)) + 2)).alias("text"),
            ),
        )

    return let(F.split(formatted, r"<\|im_start\|>"), lambda p: F.transform(F.slice(p, 2, F.size(p)), turn))


def format_chats(turns: DataFrame, trained: str = "assistant") -> DataFrame:
    """conv_id, n_turns, formatted, level and loss_spans for each conversation of ``turns(conv_id, turn, role, text)``.

    Turns stand in the order (turn, role, text), nulls first; null roles and texts are empty. Rows without a
    conv_id are one conversation. ``level`` is 0 (as it is), 1 (some turns escaped) or 2 (all escaped);
    ``loss_spans`` holds for each turn of the role ``trained`` where its text stands in ``formatted``: start
    and length in code points. Every result reads back as the source. Other columns are not read.
    """
    one = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    # What a turn looks like at each level, and whether it comes back unescaped.
    alone = parse(_block(F.col("role"), F.col("text")))
    same = F.size(alone).eqNullSafe(F.lit(1)) & (alone[0]["role"] == F.col("role")) & (alone[0]["text"] == F.col("text"))
    one = one.withColumns({"role2": escape_role(F.col("role")), "text2": escape(F.col("text")), "clean": same})
    grouped = one.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "role2", "text2", "clean"))).alias("turns")
    )
    source = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))

    def choose(level: int):
        def pick(t: Column) -> Column:
            plain, escaped = (F.struct(t[r].alias("role"), t[x].alias("text")) for r, x in (("role", "text"), ("role2", "text2")))
            return plain if level == 0 else escaped if level == 2 else F.when(t["clean"], plain).otherwise(escaped)

        return F.transform("turns", pick)

    def render(blocks: Column) -> Column:
        return F.array_join(F.transform(blocks, lambda b: _block(b["role"], b["text"])), "")

    for level in (0, 1):
        grouped = grouped.withColumn(f"back{level}", parse(render(choose(level))) == source)
    grouped = grouped.withColumn("level", F.when(F.col("back0"), 0).when(F.col("back1"), 1).otherwise(2))
    chosen = F.when(F.col("level") == 0, choose(0)).when(F.col("level") == 1, choose(1)).otherwise(choose(2))
    grouped = grouped.withColumn("blocks", chosen)
    # Running places of the texts: lengths are added up once, by the position of the turn.
    state = F.aggregate(
        "blocks",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,length:long>>").alias("spans")),
        lambda s, b: F.struct(
            (s["at"] + F.length(b["role"]) + F.length(b["text"]) + len(START) + 1 + len(END)).cast("long").alias("at"),
            F.when(
                unescape_role(b["role"]) == trained,
                F.concat(
                    s["spans"],
                    F.array(
                        F.struct(
                            (s["at"] + len(START) + F.length(b["role"]) + 1).cast("long").alias("start"),
                            F.length(b["text"]).cast("long").alias("length"),
                        )
                    ),
                ),
            )
            .otherwise(s["spans"])
            .alias("spans"),
        ),
    )
    return grouped.select(
        "conv_id",
        F.size("blocks").cast("long").alias("n_turns"),
        render(F.col("blocks")).alias("formatted"),
        "level",
        state["spans"].alias("loss_spans"),
    )


def loss_text(formatted: str = "formatted", spans: str = "loss_spans") -> Column:
    """All text under the loss mask, read from the rendered conversation and unescaped."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substr(F.col(formatted), (s["start"] + 1).cast("int"), s["length"].cast("int")))), ""
    )
