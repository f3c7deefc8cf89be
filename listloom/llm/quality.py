"""Operator 7: quality rules learnt as a decision list, in DataFrame operations only."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

# Fixed values of the contract.
BLANKS = "[\\x20\\x09-\\x0D]+"
BLANK_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# What rules may ask about; all are columns of ``text_statistics``.
FEATURES = (
    "n_words", "mean_word", "symbols_per_word", "dup_line_share", "repeat_share",
    "upper_share", "mark_share", "digit_share", "distinct_share", "words_per_line",
)


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _count_chars(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(_without(text, chars))).cast("bigint")


def repeated_words(words: Column, windows: Column) -> Column:
    """Words inside a 3-word window that the text has twice or more.

    ``windows`` are the windows' hashes in order. Only texts in which a hash comes twice are sorted; then equal hashes are
    neighbours, and the places of repeated windows, in order, cover up to three words each.
    """
    entries = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def is_repeated(entry: Column, k: Column) -> Column:
        before, after = F.get(entries_, k - 1)["h"], F.get(entries_, k + 1)["h"]
        return (F.coalesce(before == entry["h"], F.lit(False))) | (F.coalesce(after == entry["h"], F.lit(False)))

    # A one-element transform names the sorted array, so it is computed once for each text.
    def covered(sorted_entries: Column) -> Column:
        nonlocal entries_
        entries_ = sorted_entries
        places = F.transform(F.filter(sorted_entries, is_repeated), lambda e: e["i"])
        start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("end"))

        def add(state: Column, place: Column) -> Column:
            fresh = F.greatest(F.lit(0), place + 3 - F.greatest(place, state["end"]))
            return F.struct((state["n"] + fresh).cast("bigint").alias("n"), (place + 3).alias("end"))

        return F.aggregate(F.array_sort(places), start, add, lambda s: s["n"])

    entries_ = entries
    heavy = F.get(F.transform(F.array(entries), covered), F.lit(0))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("bigint")).otherwise(heavy)


def text_statistics(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Counts and shares of every whole text beside the ``keep`` columns; narrow, no shuffle.

    A null text has no words, lines or characters. Windows are compared by a 64-bit hash of their words.
    """
    base = docs.select(*keep, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_t"))
    split = base.withColumns({
        "_w": F.array_remove(F.split("_t", BLANKS), ""),
        "_l": F.filter(F.split("_t", "\n"), lambda line: _without(line, BLANK_CHARS) != ""),
    })
    places = F.when(F.size("_w") >= 3, F.sequence(F.lit(0), F.size("_w") - 3)).otherwise(F.array().cast("array<int>"))
    window = F.transform(places, lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)))
    counted = split.withColumn("_h", window).select(
        *keep,
        F.size("_w").cast("bigint").alias("n_words"),
        F.length(_without(F.col("_t"), BLANK_CHARS)).cast("bigint").alias("word_chars"),
        _count_chars(F.col("_t"), SYMBOLS).alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("_w"), F.col("_h")).alias("n_repeat_words"),
        F.size("_l").cast("bigint").alias("n_lines"),
        F.size(F.array_distinct("_w")).cast("bigint").alias("n_distinct"),
        _count_chars(F.col("_t"), UPPER).alias("n_upper"),
        _count_chars(F.col("_t"), "!?").alias("n_marks"),
        _count_chars(F.col("_t"), "0123456789").alias("n_digits"),
    )

    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))

    return counted.withColumns({
        "mean_word": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "upper_share": share("n_upper", "word_chars"),
        "mark_share": share("n_marks", "n_words"),
        "digit_share": share("n_digits", "word_chars"),
        "distinct_share": share("n_distinct", "n_words"),
        "words_per_line": share("n_words", "n_lines"),
    })


@dataclass(frozen=True)
class Condition:
    """``feature > threshold`` or ``feature <= threshold``."""

    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature).cast("double")
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def all_of(rule: Rule) -> Column:
    out = F.lit(True)
    for condition in rule:
        out = out & condition.column()
    return out


def keep_column(rules: Sequence[Rule]) -> Column:
    """The decision list as one ordered conditional expression: the first rule that holds rejects, else the row is kept."""
    out = None
    for rule in rules:
        out = F.when(all_of(rule), F.lit(False)) if out is None else out.when(all_of(rule), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def _thresholds(rows: DataFrame, features: Sequence[str], cuts: int) -> dict[str, list[float]]:
    """Candidate thresholds: distinct quantiles of each feature over the rows of either label."""
    shares = [i / cuts for i in range(cuts + 1)]
    found: dict[str, set[float]] = {f: set() for f in features}
    for label in (0, 1):
        for f, values in zip(features, rows.where(F.col("label") == label).approxQuantile(list(features), shares, 0.002), strict=True):
            found[f].update(values)
    return {f: sorted(v)[:-1] for f, v in found.items()}


def _binned(rows: DataFrame, thresholds: dict[str, list[float]]) -> DataFrame:
    """``bad`` and for each feature the number of thresholds below its value."""

    def below(f: str, cuts: list[float]) -> Column:
        # One constant array and one loop over it, so the generated code does not grow with the cuts.
        limits = F.array(*[F.lit(float(t)) for t in cuts]).cast("array<double>")
        return F.array_size(F.filter(limits, lambda t: t < F.col(f).cast("double"))).alias(f"b_{f}")

    bins = [below(f, cuts) for f, cuts in thresholds.items()]
    return rows.select((1 - F.col("label")).alias("bad"), (F.col("_fold") == 0).alias("prune"), *FEATURES, *bins)


def _best_condition(rows: DataFrame, rule: Rule, thresholds: dict[str, list[float]], least: int) -> Condition | None:
    """The condition with the largest FOIL gain over the rows that ``rule`` already covers, among those worth their description.

    To name a condition takes the logarithm of how many there are to choose from, in bits; it has to save more bits than
    that in telling the labels of the rows it covers. Labels that do not follow the features pass no condition, at any size.
    One aggregation by feature and bin; the driver sees features times bins, never rows.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f"b_{f}").alias("b")) for f in thresholds])).alias("x")
    counts = rows.where(all_of(rule)).select("bad", pairs).groupBy("x.f", "x.b").agg(F.sum("bad").alias("p"), F.count("*").alias("n"))
    table: dict[str, dict[int, tuple[int, int]]] = {}
    for r in counts.collect():
        table.setdefault(r["f"], {})[r["b"]] = (r["p"], r["n"] - r["p"])
    if not table:
        return None
    first = next(iter(table.values()))
    p0, n0 = sum(p for p, _ in first.values()), sum(n for _, n in first.values())
    if p0 == 0 or n0 == 0:
        return None
    best, best_gain = None, 0.0
    cost = 1 + math.log2(max(1, 2 * sum(map(len, thresholds.values()))))
    for f in sorted(table):
        low_p = low_n = 0
        for b, threshold in enumerate(thresholds[f]):
            p, n = table[f].get(b, (0, 0))
            low_p, low_n = low_p + p, low_n + n
            for above, (p1, n1) in ((False, (low_p, low_n)), (True, (p0 - low_p, n0 - low_n))):
                if p1 < least or (p1, n1) == (p0, n0):
                    continue
                if _saved_bits(p1, n1, p0, n0) <= cost:
                    continue
                gain = p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0)))
                if gain > best_gain + 1e-9:
                    best, best_gain = Condition(f, above, threshold), gain
    return best


def _saved_bits(p1: int, n1: int, p0: int, n0: int) -> float:
    """Bits saved in telling ``p1`` bad and ``n1`` good rows by their own share rather than by that of all ``p0`` and ``n0``."""
    parts = [(x, x / (p1 + n1), y / (p0 + n0)) for x, y in ((p1, p0), (n1, n0)) if x]
    return sum(x * math.log2(own / all_) for x, own, all_ in parts)


def _pruned(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The beginning of ``rule`` that does best on the rows held back, with the rows of either label it covers there."""
    sums = []
    for k in range(1, len(rule) + 1):
        held = all_of(rule[:k])
        sums += [F.sum(F.when(held, F.col("bad")).otherwise(0)), F.sum(F.when(held, 1 - F.col("bad")).otherwise(0))]
    got = [int(v or 0) for v in rows.agg(*sums).first()]
    scored = [((p - n) / (p + n) if p + n else -1.0, -k, p, n) for k, (p, n) in enumerate(zip(got[::2], got[1::2], strict=True), 1)]
    value, k, p, n = max(scored)
    return rule[:-k], p, n


def learn(
    labelled: DataFrame, cuts: int = 32, precision: float = 0.9, least: int = 3, keep_every: int = 4
) -> list[Rule]:
    """Rules that reject, from rows of statistics with ``label`` (1 good, 0 bad), by sequential covering over all of them.

    Two thirds of the rows, by a hash, grow a rule condition by condition; the other third prunes it. A rule
    stays if ``precision`` of what it covers among the held rows is bad; then the rows it covers leave and
    the next is grown. The rows that a failed rule covered before pruning are set aside for growing alone, and the next is tried,
    until no condition is worth its description (see ``_best_condition``); nothing else bounds the length of a rule or the number of
    rules. The rows that are left are stored every ``keep_every`` tries, so plans stay short. Without rows of both labels
    there are no rules.
    """
    folds = F.pmod(F.xxhash64(*[F.col(f) for f in FEATURES]), F.lit(3))
    rows = stored(labelled.where(F.col("label").isin(0, 1)).select("label", *FEATURES).withColumn("_fold", folds), "quality-rows")
    if len(rows.select("label").distinct().collect()) < 2:
        return []
    thresholds = _thresholds(rows, FEATURES, cuts)
    left = stored(_binned(rows, thresholds), "quality-bins")
    grow, prune = left.where(~F.col("prune")), left.where("prune")
    rules: list[Rule] = []
    for attempt in count(1):
        rule: Rule = ()
        while (condition := _best_condition(grow, rule, thresholds, least)) is not None:
            rule = (*rule, condition)
        if not rule:
            break
        if attempt % keep_every == 0:
            grow, prune = stored(grow, "quality-grow"), stored(prune, "quality-prune")
        grown = rule
        rule, p, n = _pruned(prune, grown)
        if p < 1 or p < precision * (p + n):
            grow = grow.where(~all_of(grown))
            continue
        rules.append(rule)
        grow, prune = grow.where(~all_of(rule)), prune.where(~all_of(rule))
    return rules


def labelled_statistics(stats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """Statistics of rows with a label; an id labelled twice counts as bad if one of its labels does."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(key).agg(F.min(label).alias("label"))
    return stats.drop("label").join(known, key)


def judge_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Statistics of every document, ``base_failed``, ``method_kept`` (the learnt list) and ``kept``.

    Texts are read once; the statistics are stored and serve the learner and the verdict. Null texts have zero counts
    and fail the base rule; repeated rows get equal rows; an empty table gives none. A text is taken whole, whatever its length;
    columns other than the two named ones are not read.
    """
    stats = stored(text_statistics(docs, text, (key,)), "quality-stats")
    rules = learn(labelled_statistics(stats, labels, key))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = stats.withColumns({"base_failed": base, "method_kept": keep_column(rules)})
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("method_kept"))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, n_words``, the base counts, ``base_failed`` and ``kept`` of every document."""
    return judge_documents(docs, labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
