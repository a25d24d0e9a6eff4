"""Quality rules: a decision list learned by sequential covering from labelled statistics.

Statistics of a text are column expressions. Labelled rows, a bounded sample, give the thresholds (quantiles of either
class) and are reduced to bin numbers. A rule grows by the threshold condition of the best information gain over the rows
that no earlier rule covers, and is then pruned from its last condition on rows that didn't grow it. A rule that is precise
enough there joins the list. All counts are aggregations over bins; what reaches the driver is a count for each bin. The
list becomes one ordered conditional expression.

Everything runs in DataFrame expressions. A repeated three-word window is told by 64 bits of hash.

Cases: null or empty texts have no words and fail the base rule. Labels that are null, or have a null doc_id, teach
nothing; of a doc_id with several labels the least counts. Without labels there are no rules, and the base rule decides.
Rows that repeat a doc_id are judged one by one. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from math import log2
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from adlake.llm.shared import written

#: The list is learned from a sample by doc_id hash of about this many labelled rows at most.
MAX_ROWS = 30_000
MAX_RULES, MAX_CONDITIONS = 8, 3
#: Share of poor rows among those that a rule covers, on rows that didn't grow it, and how many of them it must cover.
PRECISION, SUPPORT = 0.9, 5
QUANTILES = (0.005, 0.02, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.98, 0.995)
FEATURES = ("n_words", "word_length", "symbols", "dup_lines", "repeats", "capitals", "marks", "line_length")
_BLANK = "[ \\t\\n\\x0B\\f\\r]"


class Condition(NamedTuple):
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        return F.col(self.feature) > self.threshold if self.above else F.col(self.feature) <= self.threshold


def _repeat_words(words: str) -> Column:
    """Words in windows of three that the text has twice or more; ``hashes`` holds those of all windows."""
    indexed = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def covered(s: Column) -> Column:
        twice = F.filter(s, lambda x, k: (F.get(s, k - 1)["h"].eqNullSafe(x["h"])) | (F.get(s, k + 1)["h"].eqNullSafe(x["h"])))
        at = F.sort_array(F.transform(twice, lambda x: x["i"]))
        return F.aggregate(
            at,
            F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
            lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")),
            lambda a: a["n"],
        )

    some = F.size(F.array_distinct("hashes")) < F.size("hashes")
    return F.when(some, F.element_at(F.transform(F.array(indexed), covered), 1)).otherwise(F.lit(0).cast("long"))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, and the features of every row."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("words", F.array_remove(F.split("text", _BLANK + "+"), ""))
    windows = F.when(
        F.size("words") > 2,
        F.transform(F.sequence(F.lit(0), F.size("words") - 3), lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))),
    ).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike("[^ \\t\\x0B\\f\\r]"))
    less = lambda pattern: (F.char_length("text") - F.char_length(F.regexp_replace("text", pattern, ""))).cast("long")
    rows = rows.withColumns({"hashes": windows, "lines": lines})
    counts = rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        less("[#*$%&|<>]+").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words("words").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        less("[A-Z]+").alias("n_capitals"),
        less("[!?]+").alias("n_marks"),
    )
    return counts


def features() -> dict[str, Column]:
    """The features, of base counts; 0 for a text without words."""
    per = lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))
    return {
        "n_words": F.col("n_words").cast("double"),
        "word_length": per("word_chars", "n_words"),
        "symbols": per("n_symbols", "n_words"),
        "dup_lines": per("n_dup_lines", "n_lines"),
        "repeats": per("n_repeat_words", "n_words"),
        "capitals": per("n_capitals", "word_chars"),
        "marks": per("n_marks", "n_words"),
        "line_length": per("n_words", "n_lines"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def _thresholds(rows: DataFrame) -> dict[str, list[float]]:
    """Quantiles of the features, over good and poor rows."""
    found = rows.groupBy("poor").agg(*(F.percentile_approx(f, list(QUANTILES), 2_000).alias(f) for f in FEATURES)).collect()
    return {f: sorted({x for row in found for x in row[f]}) for f in FEATURES}


def _bins(thresholds: dict[str, list[float]]) -> Column:
    """For each feature, how many thresholds lie below it."""
    below = lambda f: sum(((F.col(f) > t).cast("int") for t in thresholds[f]), F.lit(0))
    return F.array(*(below(f) for f in FEATURES))


def _holds(conditions: list[Condition], thresholds: dict[str, list[float]]) -> Column:
    out = F.lit(True)
    for c in conditions:
        at = F.col("bins")[FEATURES.index(c.feature)]
        rank = thresholds[c.feature].index(c.threshold)
        out = out & (at > rank if c.above else at <= rank)
    return out


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    return p * (log2(p / (p + n)) - log2(p0 / (p0 + n0))) if p else 0.0


def _grow(rows: DataFrame, thresholds: dict[str, list[float]]) -> list[Condition]:
    rule: list[Condition] = []
    while len(rule) < MAX_CONDITIONS:
        counts = (
            rows.where(_holds(rule, thresholds))
            .select("poor", F.posexplode("bins").alias("feature", "bin"))
            .groupBy("feature", "bin")
            .agg(F.count_if("poor").alias("p"), F.count_if(~F.col("poor")).alias("n"))
            .collect()
        )
        of = [{r["bin"]: (r["p"], r["n"]) for r in counts if r["feature"] == k} for k in range(len(FEATURES))]
        p0, n0 = (sum(x[k] for x in of[0].values()) for k in (0, 1)) if of[0] else (0, 0)
        if not p0 or not n0:
            break
        best, gain = None, 0.0
        for k, feature in enumerate(FEATURES):
            p = n = 0
            for rank, threshold in enumerate(thresholds[feature]):
                p, n = p + of[k].get(rank, (0, 0))[0], n + of[k].get(rank, (0, 0))[1]
                for above, a, b in ((False, p, n), (True, p0 - p, n0 - n)):
                    if _gain(a, b, p0, n0) > gain:
                        best, gain = Condition(feature, above, threshold), _gain(a, b, p0, n0)
        if best is None:
            break
        rule.append(best)
    return rule


def _prune(rule: list[Condition], rows: DataFrame, thresholds: dict[str, list[float]]) -> tuple[list[Condition], int, int]:
    """The beginning of the rule with the best precision, then the most poor rows, and the rows that it covers."""
    cuts = [_holds(rule[: k + 1], thresholds) for k in range(len(rule))]
    found = rows.agg(*(x for k, c in enumerate(cuts) for x in (F.count_if(c & F.col("poor")).alias(f"p{k}"), F.count_if(c & ~F.col("poor")).alias(f"n{k}")))).first()
    kept = max(range(len(rule)), key=lambda k: ((found[f"p{k}"] - found[f"n{k}"]) / max(found[f"p{k}"] + found[f"n{k}"], 1), found[f"p{k}"], -k))
    return rule[: kept + 1], found[f"p{kept}"], found[f"n{kept}"]


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> list[list[Condition]]:
    """Rules whose texts are poor, in order. ``labels``: doc_id and 0 for poor, 1 for good."""
    marked = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg((F.min(label) == 0).alias("poor"))
    total = marked.count()
    if total > max_rows:
        share = 1 << 30
        marked = marked.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(share)) < int(share * max_rows / total))
    rows = stats.join(F.broadcast(marked), "doc_id").select("doc_id", "poor", *(c.alias(f) for f, c in features().items()))
    rows = written(rows, "labelled")
    if rows.select("poor").distinct().count() < 2:
        return []
    thresholds = _thresholds(rows)
    rows = written(rows.select("poor", (F.pmod(F.xxhash64("doc_id", F.lit("prune")), F.lit(3)) == 0).alias("prunes"), _bins(thresholds).alias("bins")), "binned").coalesce(4)
    rules: list[list[Condition]] = []
    left = rows
    while len(rules) < MAX_RULES:
        rule = _grow(left.where("not prunes"), thresholds)
        if not rule:
            break
        rule, p, n = _prune(rule, left.where("prunes"), thresholds)
        if p < SUPPORT or p < PRECISION * (p + n):
            break
        rules.append(rule)
        left = left.where(~_holds(rule, thresholds))
    return rules


def verdict(rules: list[list[Condition]]) -> Column:
    """The number of the first rule that holds, null if none does; over the features."""
    out = F.lit(None).cast("int")
    for k, rule in reversed(list(enumerate(rules))):
        holds = F.lit(True)
        for c in rule:
            holds = holds & c.column()
        out = F.when(holds, k + 1).otherwise(out)
    return out


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, base counts, base_failed, rule (the first that holds) and kept of every row."""
    stats = written(statistics(docs), "statistics")
    rules = fit(stats, labels)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    named = stats.select("doc_id", F.struct(*counts).alias("counts"), base_failed().alias("base_failed"), *(c.alias(f) for f, c in features().items()))
    judged = named.withColumn("rule", verdict(rules))
    return judged.select("doc_id", "counts.*", "base_failed", "rule", (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"))
