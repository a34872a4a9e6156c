"""Quality rules: text statistics, a learned decision list, ordered conditional expressions. DataFrame functions only."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITESPACE, bind, documents, scratch, staged, text_or_empty, whole_row
from .labels import few, fold, labelled

#: Statistics that rules may set thresholds on.
FEATURES = ["n_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "exclaim_share", "variety", "line_words"]
#: Quantiles of each statistic for each label that thresholds lie between, conditions in a rule, rules in a list at most.
CUTS, CONDITIONS, RULES = 20, 3, 12
#: What a rule must reach on the pruning fold: rows caught, and share of them labelled as bad.
SUPPORT, PRECISION = 3, 0.95


class Condition(NamedTuple):
    feature: str
    above: bool
    cut: float

    def column(self) -> Column:
        return F.col(self.feature) > self.cut if self.above else F.col(self.feature) <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:g}"


def repeat_words(words: Column) -> Column:
    """How many of ``words`` lie in a window of three that is found twice or more. Windows are compared by a 64-bit hash
    within their text; only texts in which one repeats are sorted."""

    def positions(hashes: Column) -> Column:
        order = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        equal = lambda other, e: F.coalesce(other["h"] == e["h"], F.lit(False))
        same = lambda o, e, k: equal(F.get(o, k - 1), e) | equal(F.get(o, k + 1), e)
        return bind(order, lambda o: F.filter(F.transform(o, lambda e, k: F.when(same(o, e, k), e["i"])), lambda i: i.isNotNull()))

    def counted(hashes: Column) -> Column:
        covered = lambda at: F.size(F.array_distinct(F.concat(at, F.transform(at, lambda i: i + 1), F.transform(at, lambda i: i + 2))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(bind(positions(hashes), covered))

    def hashed(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(bind(hashed(words), counted))


def statistics(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """doc (struct of all columns, or of those in ``carry``), doc_id, the contract's statistics and ``FEATURES`` of every whole text (null: empty)."""
    text = text_or_empty()
    only = lambda kept: F.length(F.regexp_replace(text, f"[^{kept}]+", "")).cast("long")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{WHITESPACE}]"))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
            repeat_words(w).cast("long").alias("n_repeat_words"),
        )

    def of_lines(found: Column) -> Column:
        return F.struct(F.size(found).cast("long").alias("n_lines"), (F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines"))

    words = F.filter(F.split(text, f"[{WHITESPACE}]+"), lambda w: w != "")
    rows = docs.select(
        whole_row(docs.columns if carry is None else carry).alias("doc"),
        F.col("doc_id").cast("long").alias("doc_id"),
        bind(words, of_words).alias("w"),
        bind(lines, of_lines).alias("l"),
        only("#*$%&|<>").alias("n_symbols"),
        only("A-Z").alias("n_upper"),
        only("!").alias("n_exclaim"),
    ).select("doc", "doc_id", "w.*", "l.*", "n_symbols", "n_upper", "n_exclaim")
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0)).cast("double")
    rows = rows.withColumns({
        "word_length": share("word_chars", "n_words"), "symbol_share": share("n_symbols", "word_chars"), "dup_line_share": share("n_dup_lines", "n_lines"), "repeat_share": share("n_repeat_words", "n_words"),
        "upper_share": share("n_upper", "word_chars"), "exclaim_share": share("n_exclaim", "n_words"), "variety": share("n_distinct", "n_words"), "line_words": share("n_words", "n_lines"),
    })
    return rows.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def fires(rule: list[Condition]) -> Column:
    out = F.lit(True)
    for condition in rule:
        out = out & condition.column()
    return out


def thresholds(rows: DataFrame) -> dict[str, list[float]]:
    """For each statistic, where rules may cut: the middles between neighbours among the quantiles of rows labelled 0 and
    of those labelled 1 (each its smallest and largest value included), those of value zero taken apart, as half of
    all rows and more may have it. A cut thus has room on both sides. Empty if a label is missing."""
    marks = [k / CUTS for k in range(CUTS + 1)]
    of = lambda f, y: F.percentile_approx(F.when((F.col("y") == y) & (F.col(f) != 0), F.col(f).cast("double")), marks, 2000).alias(f"{f}_{y}")
    zero = [F.max((F.col(f) == 0).cast("int")).alias(f"{f}_z") for f in FEATURES]
    seen = rows.agg(F.min("y").alias("low"), F.max("y").alias("high"), *[of(f, y) for f in FEATURES for y in (0, 1)], *zero).first()
    if seen["low"] != 0 or seen["high"] != 1:
        return {}
    values = {f: sorted({*(seen[f"{f}_0"] or []), *(seen[f"{f}_1"] or []), *([0.0] * seen[f"{f}_z"])}) for f in FEATURES}
    return {f: [(x + y) / 2 for x, y in zip(v, v[1:], strict=False)] for f, v in values.items()}


def learn(rows: DataFrame) -> list[list[Condition]]:
    """A decision list against label 0 from ``rows`` (``FEATURES``, y, grow), by sequential covering.

    A rule grows by the condition of largest FOIL gain over the rows that it and no earlier rule catches (of equal gains
    the first by statistic, cut, and below before above), is pruned to the prefix of best precision on the other fold
    (of equal ones the shortest), and stays if it catches ``SUPPORT`` rows there with ``PRECISION``. Otherwise another is
    grown that doesn't start with the same statistic; the list ends when none stays. Counts are taken in Spark over
    every labelled row, one small aggregate for each step (statistics by thresholds). No labelled rows, or none of either
    label, give no rules.
    """
    cuts = thresholds(rows)
    if not cuts:
        return []
    below = lambda f: lambda c: c < F.col(f).cast("double")
    binned = F.array(*[F.size(F.filter(F.array(*map(F.lit, cuts[f])).cast("array<double>"), below(f))) for f in FEATURES])
    rows = staged(rows.withColumn("bins", binned), "labelled")
    free, found, failed = rows, [], set()
    while len(found) < RULES:
        grown = grow(free.where("grow"), cuts, failed)
        if not grown:
            break
        rule = prune(free.where("not grow"), grown)
        if rule:
            found.append(rule)
            free, failed = free.where(~fires(rule)), set()
        else:
            failed.add(grown[0].feature)
    return found


def gain(bad: int, good: int, all_bad: int, all_good: int) -> float:
    """What a condition that leaves ``bad`` and ``good`` of so many rows is worth: bad rows kept, times bits of purity won."""
    return bad * (math.log2(bad / (bad + good)) - math.log2(all_bad / (all_bad + all_good))) if bad else 0.0


def grow(rows: DataFrame, cuts: dict[str, list[float]], failed: set[str]) -> list[Condition]:
    """A rule that doesn't start with a statistic in ``failed``; none if no condition is worth a bit."""
    rule: list[Condition] = []
    while len(rule) < CONDITIONS:
        counts = rows.where(fires(rule)).select("y", F.posexplode("bins").alias("f", "bin")).groupBy("f", "bin").agg(F.sum(1 - F.col("y")).alias("bad"), F.sum("y").alias("good")).collect()
        by = {k: {r["bin"]: (r["bad"], r["good"]) for r in counts if r["f"] == k} for k in range(len(FEATURES))}
        all_bad, all_good = (sum(v[x] for v in by[0].values()) for x in (0, 1))
        if all_bad < SUPPORT or not all_good:
            break
        best, chosen = 1.0, None
        for k, feature in enumerate(FEATURES):
            if not rule and feature in failed:
                continue
            low = [0, 0]
            for at, cut in enumerate(cuts[feature]):
                # a value is in bin b if b cuts are below it
                low = [low[x] + by[k].get(at, (0, 0))[x] for x in (0, 1)]
                for above, (bad, good) in ((False, low), (True, [all_bad - low[0], all_good - low[1]])):
                    if (worth := gain(bad, good, all_bad, all_good)) > best:
                        best, chosen = worth, Condition(feature, above, cut)
        if chosen is None:
            break
        rule.append(chosen)
    return rule


def prune(rows: DataFrame, rule: list[Condition]) -> list[Condition]:
    if not rule:
        return []
    ends = range(1, len(rule) + 1)
    counts = rows.agg(*[F.count(F.when(fires(rule[:k]) & (F.col("y") == y), 1)).alias(f"n{k}_{y}") for k in ends for y in (0, 1)]).first()
    worth = {k: counts[f"n{k}_0"] / (counts[f"n{k}_0"] + counts[f"n{k}_1"]) for k in ends if counts[f"n{k}_0"] >= SUPPORT}
    best = max(worth, key=lambda k: (worth[k], -k), default=None)
    return rule[:best] if best and worth[best] >= PRECISION else []


def verdict(rules: list[list[Condition]]) -> Column:
    """The ordered list as a conditional expression: 0 if no rule fires, else the first one's number."""
    out = F.when(F.lit(False), F.lit(0))
    for k, rule in enumerate(rules):
        out = out.when(fires(rule), F.lit(k + 1))
    return out.otherwise(F.lit(0))


def ruled(docs: DataFrame, labels: DataFrame, carry: list[str] | None = None, sample: DataFrame | None = None, base: bool = True) -> tuple[DataFrame, list[list[Condition]]]:
    """Statistics of every row of ``docs`` with base_failed, rule (number of the first that fires, else 0) and kept; and
    the rules, learned from ``labels`` (doc_id, y). kept: no rule fires and, if ``base``, the base didn't fail. The rules
    are learned from all labelled rows of ``sample`` if it is given, else from those of ``docs``, whatever the base says
    of them: it fails short texts that are labelled as good.

    A null text counts as empty. Repeated rows get the same verdict. No rows give no rows, no labels no rules. Other
    columns are ignored. Labels are joined to statistics, by a shuffle that deals the
    labelled rows evenly to the learner; texts of ``sample`` without a label are left out before, if labels are few.
    """
    rows = staged(statistics(docs, carry), "statistics")
    if sample is not None and few(labels):  # statistics of labelled rows only
        sample = sample.join(F.broadcast(labels.select("doc_id")), "doc_id", "left_semi")
    known = rows if sample is None else statistics(sample, ["doc_id"])
    known = known.select("doc_id", *FEATURES).join(labels, "doc_id").select(*FEATURES, "y", (fold() != 3).alias("grow"))
    with scratch(docs.sparkSession):
        rules = learn(known if sample is None else staged(known, "sample"))
    kept = F.col("rule") == 0
    return rows.withColumn("rule", verdict(rules)).withColumn("kept", kept & ~F.col("base_failed") if base else kept), rules


def kept_by_rules(docs: DataFrame, labels: DataFrame, sample: DataFrame | None = None, base: bool = True) -> DataFrame:
    """The rows of ``docs`` that the rules keep (and the base, if ``base``), with all their columns. ``sample`` as in
    ``ruled``."""
    return ruled(docs, labels, sample=sample, base=base)[0].where("kept").select("doc.*")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all documents."""
    rows, _ = ruled(documents(spark, sf_dir), labelled(spark, sf_dir, "quality"), ["doc_id"])
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
