"""Quality rules: statistics of texts, and a decision list learned from labelled ones.

Everything is a Spark expression or aggregation. Learning counts, in one aggregation per step, how labelled texts spread over
the thresholds of every rate; only those counts reach the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartonwise.config import materialized
from cartonwise.llm.tables import BLANKS, WORD_SPACE

SYMBOLS = "#*$%&|<>"
STATISTICS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_upper",
              "n_digits", "n_marks", "n_lines")


def _let(value: Column, body) -> Column:
    """body(value) with value computed once, also where body uses it inside other lambdas."""
    return F.transform(F.array(value), body)[0]


def _words(text: Column) -> Column:
    trimmed = F.trim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_SPACE))


def _count_chars(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window of three words found twice or more. Windows are sorted by hash, so equal ones meet as
    neighbours: n log n steps, also for texts that repeat one window."""
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.struct(
        F.xxhash64(words[i], words[i + 1], words[i + 2]).alias("h"), i.alias("i")))

    def repeated(ordered: Column) -> Column:
        pairs = F.zip_with(F.slice(ordered, F.lit(1), F.size(ordered) - 1), F.slice(ordered, F.lit(2), F.size(ordered) - 1),
                           lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
        return F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))

    def covered(places: Column) -> Column:  # each window adds the words that the next one doesn't hold
        gaps = F.zip_with(F.slice(places, F.lit(1), F.size(places) - 1), F.slice(places, F.lit(2), F.size(places) - 1),
                          lambda a, b: F.least(b - a, F.lit(3)))
        return F.when(F.size(places) == 0, 0).otherwise(F.aggregate(gaps, F.lit(3), lambda total, gap: total + gap))

    return F.when(F.size(words) < 4, 0).otherwise(
        _let(F.sort_array(windows), lambda ordered: _let(repeated(ordered), covered)))


def statistics(docs: DataFrame) -> DataFrame:
    """STATISTICS of each row of docs; a null text counts as an empty one. Only doc_id and text are read; rows are
    independent."""
    text = F.coalesce("text", F.lit(""))
    lines = F.split(text, "\n")
    with_word = F.filter(lines, lambda x: F.trim(x, F.lit(BLANKS)) != "")
    counted = docs.select("doc_id", text.alias("text")).select(
        "doc_id",
        _let(_words(F.col("text")), lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("r"))).alias("words"),
        (F.length("text") - _count_chars(F.col("text"), BLANKS)).alias("word_chars"),
        _count_chars(F.col("text"), SYMBOLS).alias("n_symbols"),
        _let(with_word, lambda x: F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
        F.length("text").alias("n_chars"),
        F.length(F.regexp_replace("text", r"\P{Lu}+", "")).alias("n_upper"),
        _count_chars(F.col("text"), "0123456789").alias("n_digits"),
        _count_chars(F.col("text"), ".,;:!?").alias("n_marks"),
        F.size(lines).alias("n_lines"))
    longs = {"n_words": F.col("words.n"), "n_repeat_words": F.col("words.r")}
    return counted.select("doc_id", *(longs.get(c, F.col(c)).cast("long").alias(c) for c in STATISTICS[1:]))


# Rates that rules may test, by name. A text without words has none of them (null), so no rule covers it.
RATES: dict[str, str] = {
    "n_words": "cast(n_words as double)",
    "mean_word_length": "word_chars / nullif(n_words, 0)",
    "symbols_per_word": "n_symbols / nullif(n_words, 0)",
    "repeat_share": "n_repeat_words / nullif(n_words, 0)",
    "dup_line_share": "n_dup_lines / nullif(n_lines, 0)",
    "upper_share": "n_upper / nullif(word_chars, 0)",
    "digit_share": "n_digits / nullif(word_chars, 0)",
    "marks_per_word": "n_marks / nullif(n_words, 0)",
    "words_per_line": "n_words / nullif(n_lines, 0)",
}


@dataclass(frozen=True)
class Condition:
    rate: str
    above: bool  # rate >= threshold, else rate < threshold
    threshold: float

    @property
    def sql(self) -> str:
        return f"(({RATES[self.rate]}) {'>=' if self.above else '<'} {self.threshold!r}D)"


@dataclass(frozen=True)
class Rule:
    """A text that meets all conditions is of low quality."""

    conditions: tuple[Condition, ...]

    @property
    def sql(self) -> str:
        return " and ".join(c.sql for c in self.conditions) or "true"


Counts = dict[tuple[int, int], list[int]]  # by rate and bin: [low, good] rows


def _counts(rows: DataFrame) -> Counts:
    """Rows by rate, bin and label: one aggregation that tells what every condition covers."""
    found = (rows.select("label", F.posexplode("bins").alias("rate", "bin")).where("bin is not null")
             .groupBy("rate", "bin").agg(F.sum(1 - F.col("label")).alias("low"), F.sum("label").alias("good")))
    return {(r.rate, r.bin): [r.low, r.good] for r in found.collect()}


def _covered(rows: DataFrame, conditions: list[tuple[int, bool, int]]) -> tuple[int, int]:
    found = rows.where(_met(conditions)).agg(F.sum(1 - F.col("label")), F.sum("label")).first()
    return found[0] or 0, found[1] or 0


def _met(conditions: list[tuple[int, bool, int]]) -> Column:
    """Conditions are (rate, above, threshold), both numbers of places in lists."""
    met = F.lit(True)
    for rate, above, threshold in conditions:
        place = F.element_at("bins", rate + 1)
        met = met & F.coalesce(place > threshold if above else place <= threshold, F.lit(False))
    return met


def _gain(before: tuple[int, int], after: tuple[int, int]) -> float:
    """FOIL's information gain."""
    if not after[0] or not before[0]:
        return -math.inf
    return after[0] * (math.log2(after[0] / sum(after)) - math.log2(before[0] / sum(before)))


def _place(rate: Column, edges: list[float]) -> Column:
    """How many of the edges the rate reaches."""
    return F.when(rate.isNotNull(), F.size(F.filter(F.lit(edges).cast("array<double>"), lambda x: x <= rate)))


def learn(rows: DataFrame, max_rules: int = 8, max_conditions: int = 4, splits: int = 24, least_covered: int = 5,
          least_precision: float = 0.95) -> list[Rule]:
    """A decision list from rows of STATISTICS and label (1: good, 0: low).

    Two thirds of the rows grow a rule: the condition of the highest gain is added until the rule covers low texts only. The
    other third prunes it: of the rule's beginnings the one that separates best is kept. The rule is taken if it covers at
    least least_covered rows with least_precision, then its rows are removed and the next one is grown. Thresholds are
    quantiles, extremes included, of low and of all rows; a row is kept as the places of its rates among them. Of conditions
    with the same gain the first in the order of RATES is taken, of one rate's that with the lowest threshold, and of one
    threshold's the one for values above. Without low rows the list is empty.
    """
    rows = materialized(rows.where("label is not null").select(
        "label", F.expr("pmod(xxhash64(doc_id), 3) <> 0").alias("grows"),
        F.array(*(F.expr(sql).cast("double") for sql in RATES.values())).alias("rates")))
    names, shares = list(RATES), [i / splits for i in range(splits + 1)]
    asked = [F.percentile_approx(F.when(F.expr(kind), F.element_at("rates", i + 1)), shares, 2000).alias(f"{name}_{k}")
             for i, name in enumerate(names) for k, kind in enumerate(("true", "label = 0"))]
    quantiles = rows.where("grows").agg(*asked).first()
    thresholds = [sorted({*(quantiles[f"{n}_0"] or ()), *(quantiles[f"{n}_1"] or ())}) for n in names]
    places = [_place(F.element_at("rates", i + 1), edges) for i, edges in enumerate(thresholds)]
    rows = materialized(rows.select("label", "grows", F.array(*places).alias("bins")))
    taken: list[list[tuple[int, bool, int]]] = []
    while len(taken) < max_rules:
        left = rows
        for conditions in taken:
            left = left.where(~_met(conditions))
        grow, conditions = left.where("grows"), []
        before = _covered(grow, [])
        while len(conditions) < max_conditions and before[0] and before[1]:
            counts, best = _counts(grow.where(_met(conditions))), (0.0, None, before)
            for rate, edges in enumerate(thresholds):
                bins = [counts.get((rate, b), (0, 0)) for b in range(len(edges) + 1)]
                for edge in range(len(edges)):
                    for above in (True, False):
                        side = bins[edge + 1:] if above else bins[:edge + 1]
                        after = (sum(b[0] for b in side), sum(b[1] for b in side))
                        gain = _gain(before, after)
                        if after[0] >= least_covered and gain > best[0]:
                            best = (gain, (rate, above, edge), after)
            if best[1] is None:
                break
            conditions.append(best[1])
            before = best[2]
        if not conditions:
            break
        prune = left.where("not grows")
        judged = [_covered(prune, conditions[:n]) for n in range(1, len(conditions) + 1)]
        kept = max(range(len(judged)), key=lambda i: ((judged[i][0] - judged[i][1]) / max(1, sum(judged[i])), judged[i][0], -i))
        low, good = _covered(left, conditions[:kept + 1])
        if low + good < least_covered or low < least_precision * (low + good):
            break
        taken.append(conditions[:kept + 1])
    # `bin > edge` is `rate >= threshold`, as a bin is the number of thresholds that the rate reaches.
    return [Rule(tuple(Condition(names[r], above, float(thresholds[r][t])) for r, above, t in rule)) for rule in taken]


def verdict(rules: list[Rule]) -> tuple[Column, Column]:
    """(kept, number of the first rule met or null) as ordered conditional expressions."""
    first = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, 1))):
        first = F.when(F.expr(rule.sql), F.lit(number)).otherwise(first)
    return first.isNull(), first


def judge(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed (under
    50 words, or over half of them in repeated windows), kept (not base_failed and no rule met), rule (number of the first rule met,
    null if none), learned from labels (doc_id, quality). Texts are read once; the statistics are kept as a table and the
    labels joined to it. Null and contradictory labels of a document teach nothing; without labels kept is not base_failed."""
    stats = materialized(statistics(docs))
    known = (labels.where("quality is not null and doc_id is not null").groupBy("doc_id")
             .agg(F.min("quality").alias("label"), F.max("quality").alias("_most")).where("label = _most").drop("_most"))
    rules = learn(stats.join(known, "doc_id"), **options)
    base_failed = F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")
    kept, first = verdict(rules)
    return stats.select(*STATISTICS[:6], base_failed.alias("base_failed"), (~base_failed & kept).alias("kept"),
                        first.alias("rule"))
