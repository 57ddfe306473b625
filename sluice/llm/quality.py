"""Quality rules: text statistics, and decision lists learned from labelled documents.

A list is learned by sequential covering. A rule is a conjunction of thresholds on statistics; it is grown on one
part of the labelled rows by the condition of highest information gain, pruned on the other part, and the rows it covers
are set aside before the next rule. The result is an ordered conditional expression that people can read and Spark
compiles. Each step is one aggregate over all labelled rows, whose statistics are cut into bins beforehand; what comes to
the driver is a count per statistic and bin.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import GAP, ROW, held, let, written

WINDOW = 5
SYMBOLS = "[#*$%&|<>]"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What rules may test, each a share or mean so that it does not depend on the length alone.
FEATURES = ("n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "mark_share", "variety", "stutter")
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


def _repeated(windows: Column) -> Column:
    """Words covered by windows (hashes by position) that occur more than once; by sorting, so n log n in any text."""

    def doubles(s: Column) -> Column:
        same = lambda x, i, by: F.coalesce(F.get(s, i + by)["h"] == x["h"], F.lit(False))
        return F.transform(F.filter(s, lambda x, i: same(x, i, -1) | same(x, i, 1)), lambda x: x["i"])

    def covered(p: Column) -> Column:
        widths = F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW))))
        return F.aggregate(widths, F.lit(0), lambda a, b: a + b)

    def searched(w: Column) -> Column:
        by_hash = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(F.sort_array(let(by_hash, doubles)), covered)

    return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(searched(w)))


def with_stats(docs: DataFrame) -> DataFrame:
    """``docs`` with the struct column ``_stats``: the counts of ``BASE``, the features, and ``base_failed``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.filter(F.split(text, GAP), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("long")

    def windows(h: Column) -> Column:
        at = lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(WINDOW)))
        spans = F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), at)
        return F.when(F.size(h) >= WINDOW, spans).otherwise(F.array().cast("array<bigint>"))

    of_words = let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda s, x: s + F.length(x)).alias("word_chars"),
            let(
                F.transform(w, lambda x: F.xxhash64(x)),
                lambda h: F.struct(
                    F.size(F.array_distinct(h)).cast("long").alias("n_distinct"),
                    _repeated(windows(h)).cast("long").alias("n_repeat_words"),
                    F.size(F.filter(F.transform(h, lambda x, i: x == F.get(h, i - 1)), lambda same: same)).alias("n_stutters"),
                ),
            ).alias("hashed"),
        ),
    )
    of_lines = let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")
        ),
    )
    parts = F.struct(
        of_words.alias("w"),
        of_lines.alias("l"),
        count(SYMBOLS).alias("n_symbols"),
        count(r"[A-ZÀ-ÖØ-Þ]").alias("n_upper"),
        count("!").alias("n_marks"),
    )

    def stats(p: Column) -> Column:
        n, chars = p["w"]["n_words"], p["w"]["word_chars"]
        over = lambda a, b: a / F.greatest(b, F.lit(1))
        repeat = p["w"]["hashed"]["n_repeat_words"]
        return F.struct(
            n.alias("n_words"),
            chars.alias("word_chars"),
            p["n_symbols"].alias("n_symbols"),
            p["l"]["n_dup_lines"].alias("n_dup_lines"),
            repeat.alias("n_repeat_words"),
            ((n < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n)).alias("base_failed"),
            F.array(
                n.cast("double"),
                over(chars, n),
                over(p["n_symbols"], n),
                over(p["l"]["n_dup_lines"], p["l"]["n_lines"]),
                over(repeat, n),
                over(p["n_upper"], chars),
                over(p["n_marks"], n),
                over(p["w"]["hashed"]["n_distinct"], n),
                over(p["w"]["hashed"]["n_stutters"], n),
            ).alias("features"),
        )

    return docs.withColumn("_stats", let(parts, stats))


@dataclass(frozen=True)
class Condition:
    feature: int
    at_least: bool
    threshold: float
    bin: int  # of the threshold among the feature's candidates

    def holds(self, features: Column) -> Column:
        value = F.get(features, F.lit(self.feature))
        return value >= self.threshold if self.at_least else value < self.threshold

    def binned(self, bins: Column) -> Column:
        value = F.get(bins, F.lit(self.feature))
        return value > self.bin if self.at_least else value <= self.bin

    def __str__(self) -> str:
        return f"{FEATURES[self.feature]} {'>=' if self.at_least else '<'} {self.threshold:g}"


Rule = tuple[Condition, ...]


def _all(conditions, of) -> Column:
    return reduce(lambda a, b: a & b, (of(c) for c in conditions), F.lit(True))


def verdict(rules: list[Rule], features: Column) -> Column:
    """True for rows that no rule rejects: the rules as one ordered conditional expression."""
    out = None
    for rule in rules:
        hit = _all(rule, lambda c: c.holds(features))
        out = F.when(hit, False) if out is None else out.when(hit, False)
    return F.lit(True) if out is None else out.otherwise(True)


@dataclass(frozen=True)
class Learner:
    """``bins``: candidate thresholds of a statistic; ``least_precision``: of a rule on the rows held back for
    pruning; a list ends with the first rule below it, or after ``most_rules``."""

    bins: int = 64
    most_rules: int = 12
    most_conditions: int = 4
    least_precision: float = 0.75
    least_covered: int = 3

    def learn(self, labelled: DataFrame) -> list[Rule]:
        """Rules that reject: ``labelled`` has ``features`` (array), ``bad`` (boolean) and ``grow`` (boolean)."""
        cuts = self._cuts(labelled)
        index = lambda i: F.size(
            F.filter(F.array(*map(F.lit, cuts[i])).cast("array<double>"), lambda t: t <= F.get("features", F.lit(i)))
        )
        rows = written(
            labelled.select(F.array(*(index(i) for i in range(len(FEATURES)))).alias("bins"), "bad", "grow"), "labelled-bins"
        )
        rules: list[Rule] = []
        left = rows
        while len(rules) < self.most_rules:
            rule = self._pruned(left, self._grown(left, cuts))
            if not rule:
                break
            rules.append(rule)
            left = left.filter(~_all(rule, lambda c: c.binned(F.col("bins"))))
        return rules

    def _cuts(self, labelled: DataFrame) -> list[list[float]]:
        """Candidate thresholds: quantiles of each statistic, over the bad rows and over all."""
        shares = F.array(*(F.lit((k + 0.5) / self.bins) for k in range(self.bins)))
        each = [
            F.percentile_approx(F.when(of, F.get("features", F.lit(i))), shares, 10_000)
            for i in range(len(FEATURES))
            for of in (F.lit(True), F.col("bad"))
        ]
        found = labelled.agg(*(e.alias(f"q{k}") for k, e in enumerate(each))).first()
        values = [set(found[2 * i] or ()) | set(found[2 * i + 1] or ()) for i in range(len(FEATURES))]
        return [sorted(v)[1:] for v in values]

    def _grown(self, left: DataFrame, cuts: list[list[float]]) -> Rule:
        rule: Rule = ()
        rows = left.filter("grow")
        while len(rule) < self.most_conditions:
            inside = rows.filter(_all(rule, lambda c: c.binned(F.col("bins"))))
            counted = (
                inside.select(F.posexplode("bins").alias("f", "b"), "bad")
                .groupBy("f", "b")
                .agg(F.sum(F.col("bad").cast("int")).alias("p"), F.count(F.lit(1)).alias("n"))
                .collect()
            )
            best = self._best(counted, cuts)
            if best is None or best in rule:
                break
            rule += (best,)
        return rule

    def _best(self, counted, cuts: list[list[float]]) -> Condition | None:
        """The condition of highest gain: bad rows it keeps, times what it adds to the log of their share."""
        tables = [[[0, 0] for _ in range(len(c) + 1)] for c in cuts]
        for f, b, p, n in counted:
            tables[f][b] = [p, n]
        bad, rows = (sum(x[k] for x in tables[0]) for k in (0, 1))
        if not bad or bad == rows:
            return None
        best, most = None, 1e-9
        for f, table in enumerate(tables):
            p = n = 0
            for b in range(len(cuts[f])):
                p, n = p + table[b][0], n + table[b][1]
                for at_least, kp, kn in ((False, p, n), (True, bad - p, rows - n)):
                    if kp < self.least_covered or kn == rows:
                        continue
                    gain = kp * (math.log2(kp / kn) - math.log2(bad / rows))
                    if gain > most:
                        best, most = Condition(f, at_least, cuts[f][b], b), gain
        return best

    def _pruned(self, left: DataFrame, rule: Rule) -> Rule:
        """The prefix of ``rule`` of the highest precision net of its errors on the rows held back, if good enough."""
        if not rule:
            return ()
        hit = [_all(rule[: k + 1], lambda c: c.binned(F.col("bins"))).cast("int") for k in range(len(rule))]
        sums = [F.sum(h * F.col("bad").cast("int")) for h in hit] + [F.sum(h) for h in hit]
        held = left.filter("NOT grow").agg(*(s.alias(f"s{k}") for k, s in enumerate(sums))).first()
        best, most = (), 0.0
        for k in range(len(rule)):
            p, n = held[k] or 0, held[len(rule) + k] or 0
            share = (p + 1) / (n + 2)
            if n >= self.least_covered and p / n >= self.least_precision and share > most + 1e-12:
                best, most = rule[: k + 1], share
        return best


def learn_rules(stats: DataFrame, labels: DataFrame, learner: Learner = Learner()) -> list[Rule]:
    """Rules from all rows of ``stats`` (doc_id, ``_stats``) that pass the base rules and have a label.

    A document labelled more than once counts as bad if any label says so; null ids and labels are left out; without labels,
    or with labels of one kind only, there are no rules and every document passes.
    """
    marks = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg((F.min("quality") == 0).alias("bad"))
    labelled = stats.filter(~F.col("_stats.base_failed")).join(marks, "doc_id")
    part = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(3)) > 0  # two thirds to grow on, one to prune on
    return learner.learn(written(labelled.select(F.col("_stats.features").alias("features"), "bad", part.alias("grow")), "labelled"))


def judged(docs: DataFrame, labels: DataFrame, learner: Learner = Learner()) -> DataFrame:
    """Per row of ``docs``: doc_id, the counts of ``BASE``, ``base_failed`` and ``kept``.

    A null text counts as empty and fails the base rules, as does any text of fewer than ten words. Ids may be null or
    repeat; other columns are not looked at.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    stats = written(with_stats(read).select("doc_id", "_stats"), "quality-stats")
    rules = learn_rules(stats, labels, learner)
    kept = ~F.col("_stats.base_failed") & verdict(rules, F.col("_stats.features"))
    return stats.select("doc_id", *(F.col(f"_stats.{c}") for c in BASE), "_stats.base_failed", kept.alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, learner: Learner = Learner()) -> DataFrame:
    """The rows of ``docs`` that pass, with all of their columns as they are, whatever their names.

    As ``judged``: null texts and short ones go, a null id can have no label, rows that share an id are judged one by one
    and stay as often as they pass. An empty table gives none.
    """
    # Rows are written with their statistics: those are taken once, and no text is shuffled to meet its label.
    rows = held(docs, doc_id=F.col("doc_id").cast("long"), text=F.col("text").cast("string"))
    rows = written(with_stats(rows).select(ROW, "doc_id", "_stats"), "quality-rows")
    rules = learn_rules(rows.select("doc_id", "_stats"), labels, learner)
    kept = ~F.col("_stats.base_failed") & verdict(rules, F.col("_stats.features"))
    return rows.filter(kept).select(f"{ROW}.*")
