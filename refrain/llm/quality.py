"""Learned quality rules: a decision list by sequential covering, in DataFrame functions alone.

Rules are found one after the other on labelled documents. A rule starts empty and grows by the condition
``feature >= threshold`` or ``feature <= threshold`` that gains most information on the growing part; then its
last conditions are pruned while that raises its precision on the other part. What a rule covers is taken out
and the next one is grown; a rule that is not precise enough is dropped, and none begins like it again. Each step is one count by feature and bin; only those counts, a few hundred
numbers, reach the driver. The list becomes one ordered CASE expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refrain.llm.common import GAP, WORD, let
from refrain.sources.storage import stage_table

#: Words of a window for repeats.
WINDOW = 5
#: Thresholds tried for each feature, most rules, most conditions of a rule, and the least precision of a rule.
BINS = 24
RULES = 8
CONDITIONS = 3
PRECISION = 0.9
#: Fewest documents of the poor class that a rule must cover on either part.
LEAST = 5
FEATURES = (
    "n_words",
    "mean_word",
    "symbol_share",
    "dup_line_share",
    "repeat_share",
    "upper_share",
    "mark_share",
    "bare_share",
)


def base_statistics(text: str = "text") -> dict[str, Column]:
    """Counts of a text, each 0 for null."""
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(WORD)))

    def repeats(w: Column) -> Column:
        """Words in windows whose word sequence stands in the text twice or more."""
        hashed = F.transform(w, lambda x: F.xxhash64(x))
        windows = let(
            hashed,
            lambda h: F.transform(
                F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)),
                lambda i: F.xxhash64(*[F.get(h, i + (j - 1)) for j in range(WINDOW)]),
            ),
        )

        def count(g: Column) -> Column:
            # Windows in hash order: one next to its equal is a repeat; then in text order, covered words add up.
            ranked = F.array_sort(F.transform(g, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
            equal = let(
                ranked,
                lambda r: F.filter(
                    F.transform(
                        r,
                        lambda x, k: F.when(
                            (x["h"] == F.get(r, k - 1)["h"]) | (x["h"] == F.get(r, k + 1)["h"]), x["i"]
                        ),
                    ),
                    lambda i: i.isNotNull(),
                ),
            )
            covered = F.aggregate(
                F.array_sort(equal),
                F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
                lambda s, i: F.struct(
                    i.alias("last"), (s["n"] + F.least(F.lit(WINDOW), i - s["last"])).alias("n")
                ),
                lambda s: s["n"],
            )
            return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(covered)

        return F.when(F.size(w) <= WINDOW, F.lit(0)).otherwise(let(windows, count))

    n = let(words, lambda w: F.struct(F.size(w).alias("words"), repeats(w).alias("repeats")))
    counts = {
        "word_chars": F.length(F.regexp_replace(text, GAP, "")),
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_upper": F.regexp_count(text, F.lit(r"\p{Lu}")),
        "n_marks": F.regexp_count(text, F.lit(r"[!?]")),
        "n_letters": F.regexp_count(text, F.lit(r"\p{L}")),
    }
    out = {k: F.coalesce(c, F.lit(0)).cast("long") for k, c in counts.items()}
    return out | {"_counts": n}


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id with the base counts and the features; every count of a null text is 0."""
    stats = base_statistics(text)
    both = docs.select("doc_id", *[c.alias(k) for k, c in stats.items()])
    both = both.withColumns(
        {
            "n_words": F.coalesce(F.col("_counts.words"), F.lit(0)).cast("long"),
            "n_repeat_words": F.coalesce(F.col("_counts.repeats"), F.lit(0)).cast("long"),
        }
    ).drop("_counts")

    def share(part: str, whole: str) -> Column:
        return F.col(part) / F.greatest(F.col(whole), F.lit(1))

    return both.withColumns(
        {
            "mean_word": share("word_chars", "n_words"),
            "symbol_share": share("n_symbols", "word_chars"),
            "dup_line_share": share("n_dup_lines", "n_words"),
            "repeat_share": share("n_repeat_words", "n_words"),
            "upper_share": share("n_upper", "n_letters"),
            "mark_share": share("n_marks", "n_words"),
            "bare_share": 1 - share("n_letters", "word_chars"),
        }
    )


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        c = F.col(self.feature)
        return c >= self.threshold if self.above else c < self.threshold

    def text(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold!r}"


def holds(rule: list[Condition]) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def verdict(rules: list[list[Condition]]) -> Column:
    """The list as one expression: the first rule that holds rejects, else the document is kept."""
    out = F
    for rule in rules:
        out = out.when(holds(rule), F.lit(False))
    return out.otherwise(F.lit(True)) if rules else F.lit(True)


def learn_rules(labelled: DataFrame) -> list[list[Condition]]:
    """Rules for the poor class of ``labelled(good int, grow boolean, features ..)``, best first.

    No rows, or one class only, give no rules.
    """
    cuts = labelled.agg(
        *[F.percentile_approx(f, [i / BINS for i in range(1, BINS)], 10000).alias(f) for f in FEATURES]
    ).first()
    thresholds = {f: sorted(set(cuts[f] or [])) for f in FEATURES}
    # The largest values get thresholds of their own: a rare kind of bad text lies beyond the last quantile.
    tops = labelled.agg(*[F.percentile_approx(f, [0.97, 0.98, 0.99, 0.995], 10000).alias(f) for f in FEATURES]).first()
    thresholds = {f: sorted({*t, *(tops[f] or [])}) for f, t in thresholds.items()}
    bins = {f: _bin(f, t) for f, t in thresholds.items()}
    table = stage_table(labelled.select("good", "grow", *FEATURES, *[b.alias(f"_{f}") for f, b in bins.items()]), "labelled")
    rules: list[list[Condition]] = []
    barred: set[tuple[str, bool]] = set()
    while len(rules) < RULES:
        grown = _grow(table, rules, thresholds, barred)
        if not grown:
            break
        rule = _prune(table, rules, grown)
        if rule:
            rules.append(rule)
        else:
            # No rule may begin that way again; the other beginnings, at most two a feature, still get their turn.
            barred.add((grown[0].feature, grown[0].above))
    return rules


def _bin(feature: str, thresholds: list[float]) -> Column:
    """Number of thresholds that a value reaches."""
    out = F.lit(0)
    for t in thresholds:
        out = out + (F.col(feature) >= t).cast("int")
    return out


def _open(table: DataFrame, rules: list[list[Condition]]) -> DataFrame:
    return table.filter(verdict(rules)) if rules else table


def _grow(table: DataFrame, rules: list, thresholds: dict[str, list[float]], barred: set) -> list[Condition]:
    """The rule that gains most, condition by condition; its first one is not ``barred`` (feature, above)."""
    rule: list[Condition] = []
    while len(rule) < CONDITIONS:
        rows = _open(table, rules).filter("grow").filter(holds(rule))
        each = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f"_{f}").alias("b")) for f in FEATURES]))
        counts = (
            rows.select("good", each.alias("x"))
            .groupBy("x.f", "x.b")
            .agg(F.sum(1 - F.col("good")).alias("p"), F.sum("good").alias("n"))
            .collect()
        )
        held = {(r["f"], r["b"]): (r["p"], r["n"]) for r in counts}
        best, gain = None, 0.0
        for f, cuts in thresholds.items():
            cells = [held.get((f, b), (0, 0)) for b in range(len(cuts) + 1)]
            all_p, all_n = (sum(c[i] for c in cells) for i in (0, 1))
            low_p = low_n = 0
            for b, t in enumerate(cuts):
                low_p, low_n = low_p + cells[b][0], low_n + cells[b][1]
                for above, p, n in ((False, low_p, low_n), (True, all_p - low_p, all_n - low_n)):
                    if p < LEAST or p + n == all_p + all_n or (not rule and (f, above) in barred):
                        continue
                    value = p * (math.log2((p + 0.5) / (p + n + 1)) - math.log2((all_p + 0.5) / (all_p + all_n + 1)))
                    if value > gain + 1e-9:
                        best, gain, exact = Condition(f, above, float(t)), value, n == 0
        if best is None:
            break
        rule.append(best)
        if exact:
            break
    return rule


def _prune(table: DataFrame, rules: list, rule: list[Condition]) -> list[Condition]:
    """The beginning of the rule with the best precision on the other part; none if that is too low."""
    if not rule:
        return []
    rows = _open(table, rules).filter("NOT grow")
    heads = [rule[: i + 1] for i in range(len(rule))]
    row = rows.agg(
        *[F.count_if(holds(h) & (F.col("good") == 0)).alias(f"p{i}") for i, h in enumerate(heads)],
        *[F.count_if(holds(h) & (F.col("good") == 1)).alias(f"n{i}") for i, h in enumerate(heads)],
    ).first()
    scored = [((row[f"p{i}"] + 1) / (row[f"p{i}"] + row[f"n{i}"] + 2), -i) for i in range(len(heads))]
    precision, i = max(scored)
    good = row[f"p{-i}"] >= max(1, LEAST // 2) and row[f"p{-i}"] >= PRECISION * (row[f"p{-i}"] + row[f"n{-i}"])
    return heads[-i] if good else []


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and the features for each row of ``docs(doc_id, text, ..)``.

    ``labels(doc_id, quality)`` says which documents are good (1) and poor (0); other or null labels are not
    used. Documents that fail the base rule (under ten words, or over a fifth of them in repeated windows) are
    never kept. Rows may repeat; a null text has no words. Without labels only the base rule decides.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    stats = stage_table(statistics(rows), "statistics")
    marks = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("good")
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    labelled = stats.filter(~failed).join(marks.distinct(), "doc_id")
    labelled = labelled.withColumn("grow", F.pmod(F.xxhash64("doc_id"), F.lit(3)) < 2)
    rules = learn_rules(labelled.select("good", "grow", *FEATURES))
    return stats.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & verdict(rules)
    ).withColumn("rules", F.lit(" | ".join(" AND ".join(c.text() for c in r) for r in rules)))
