"""Quality rules: text statistics and a decision list learned from labels; DataFrame functions only.

Sequential covering: a rule is a conjunction of thresholds, grown on two thirds of the labelled
rows by information gain, cut back on the other third, accepted if it is precise there; the rows it
covers are set aside and the next rule is grown. The list becomes ordered conditions of Spark.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tideline.llm.shared import BLANKS, checkpointed, fresh

#: About so many labelled rows are learned from, taken by a hash of the id.
SAMPLE = 10_000
QUANTILES = 16
MAX_RULES, MAX_CONDITIONS = 8, 3
#: A rule must drop so many rows of the pruning third, and so few good ones among them.
MIN_COVER, MIN_PRECISION = 5, 0.95
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["symbols", "dup_lines", "repeats", "word_length", "distinct", "upper", "marks", "length"]


def _repeat_words(hashes: Column) -> Column:
    """Words in windows that occur twice or more, from the windows' hashes in order.

    Hashes are sorted with their places; equal neighbours are repeats. A window at place i, in
    order, adds the words that the window before did not cover. Texts without repeats stop early.
    """
    order = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def of(s: Column) -> Column:
        same = lambda j, k: F.get(s, j)["h"] == F.get(s, k)["h"]
        twice = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda j: F.coalesce(same(j, j - 1), F.lit(False)) | F.coalesce(same(j, j + 1), F.lit(False)),
        )
        places = F.sort_array(F.transform(twice, lambda j: F.get(s, j)["i"]))
        return F.aggregate(
            places,
            F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
            lambda acc, i: F.struct(
                (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")
            ),
            lambda acc: acc["n"],
        )

    # Through an array of one, so that the sorted array is made once and not for each place.
    counted = F.get(F.transform(F.array(order), of), F.lit(0))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(counted)


def _once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with columns that are computed once for each row.

    They come out of a generator, so no filter above is pushed below it, which would repeat them,
    inside lambdas even for each element.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def with_statistics(docs: DataFrame, text: str, prefix: str) -> DataFrame:
    """``docs`` with BASE (long) and FEATURES (double) of whole texts, names prefixed."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    inner = ["words", "lines", "hashes", "upper_chars", "mark_chars"]
    name = {n: prefix + n for n in [*inner, *BASE, *FEATURES]}
    c = {k: F.col(v) for k, v in name.items()}
    without = lambda pattern: F.length(F.regexp_replace(whole, pattern, ""))
    split = _once(
        docs,
        {
            name["words"]: F.array_remove(F.split(whole, BLANKS), ""),
            name["lines"]: F.filter(F.split(whole, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")),
            name["n_symbols"]: (F.length(whole) - without("[#*$%&|<>]+")).cast("bigint"),
            name["upper_chars"]: F.length(whole) - without("[A-Z]+"),
            name["mark_chars"]: F.length(whole) - without("[!?]+"),
        },
    )
    windows = F.when(
        F.size(c["words"]) >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size(c["words"]) - 3),
            lambda i: F.xxhash64(F.get(c["words"], i), F.get(c["words"], i + 1), F.get(c["words"], i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    counted = _once(
        split,
        {
            name["n_words"]: F.size(c["words"]).cast("bigint"),
            name["word_chars"]: F.length(F.array_join(c["words"], "")).cast("bigint"),
            name["n_dup_lines"]: (F.size(c["lines"]) - F.size(F.array_distinct(c["lines"]))).cast("bigint"),
            name["hashes"]: windows,
        },
    )
    part = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    stated = _once(
        counted,
        {
            name["n_repeat_words"]: _repeat_words(c["hashes"]).cast("bigint"),
            name["symbols"]: part(c["n_symbols"], c["word_chars"]),
            name["dup_lines"]: part(c["n_dup_lines"], F.size(c["lines"])),
            name["word_length"]: part(c["word_chars"], c["n_words"]),
            name["distinct"]: part(F.size(F.array_distinct(c["words"])), c["n_words"]),
            name["upper"]: part(c["upper_chars"], c["word_chars"]),
            name["marks"]: part(c["mark_chars"], c["word_chars"]),
            name["length"]: F.log1p(c["n_words"].cast("double")),
        },
    )
    repeats = {name["repeats"]: part(c["n_repeat_words"], c["n_words"])}
    return stated.withColumns(repeats).drop(*[name[n] for n in inner])


def base_failed(prefix: str = "") -> Column:
    words = F.col(f"{prefix}n_words")
    return (words < 50) | (100 * F.col(f"{prefix}n_repeat_words") > 50 * words)


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self, prefix: str = "") -> Column:
        value = F.col(prefix + self.feature)
        return value >= self.threshold if self.at_least else value < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Rules in order; the first that holds drops a text, which is kept if none does."""

    rules: list[list[Condition]] = field(default_factory=list)

    def _when(self, outcome, otherwise: Column, prefix: str) -> Column:
        out = None
        for i, rule in enumerate(self.rules):
            test = F.lit(True)
            for condition in rule:
                test = test & condition.column(prefix)
            out = F.when(test, outcome(i)) if out is None else out.when(test, outcome(i))
        return otherwise if out is None else out.otherwise(otherwise)

    def kept(self, prefix: str = "") -> Column:
        return self._when(lambda i: F.lit(False), F.lit(True), prefix)

    def reason(self, prefix: str = "") -> Column:
        """The rule that drops a text, as text; null if none does."""
        said = [" AND ".join(map(str, rule)) for rule in self.rules]
        return self._when(lambda i: F.lit(said[i]), F.lit(None).cast("string"), prefix)


def learn(stats: DataFrame, bad: str = "bad", fold: str = "fold") -> DecisionList:
    """A list from stored rows with FEATURES, ``bad`` (0/1) and ``fold`` (2: pruning).

    Each step is one small aggregate: rows carry the number of thresholds each feature reaches,
    and counts of bad and good rows per feature and number give those of every threshold.
    """
    quantiles = [(i + 0.5) / QUANTILES for i in range(QUANTILES)]
    found = stats.groupBy(bad).agg(
        *[F.percentile_approx(f, quantiles, 1000).alias(f) for f in FEATURES]
    ).collect()
    cuts = {f: sorted({v for row in found for v in row[f] or []}) for f in FEATURES}
    if len(found) < 2:
        return DecisionList()
    reached = [
        sum((F.when(F.col(f) >= v, 1).otherwise(0) for v in cuts[f]), F.lit(0)).alias(f) for f in FEATURES
    ]
    rows = checkpointed(stats.select(F.col(bad).alias("bad"), (F.col(fold) == 2).alias("prunes"), *reached))

    def numbers(condition: tuple[str, bool, int]) -> Column:
        feature, at_least, k = condition
        return F.col(feature) >= k if at_least else F.col(feature) < k

    def all_of(rule: list[tuple[str, bool, int]]) -> Column:
        out = F.lit(True)
        for condition in rule:
            out = out & numbers(condition)
        return out

    rest, accepted = F.lit(True), DecisionList()
    while len(accepted.rules) < MAX_RULES:
        rule: list[tuple[str, bool, int]] = []
        while len(rule) < MAX_CONDITIONS:
            counts = (
                rows.where(~F.col("prunes") & rest & all_of(rule))
                .select("bad", F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("k")) for f in FEATURES])).alias("x"))
                .groupBy("x.f", "x.k")
                .agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n"))
                .collect()
            )
            best = _best_condition(counts, {f: len(v) for f, v in cuts.items()})
            if best is None:
                break
            rule.append(best)
        if not rule:
            return accepted
        held = rows.where(F.col("prunes") & rest).agg(
            *[
                F.struct(
                    F.coalesce(F.sum(F.when(all_of(rule[:k]), F.col("bad"))), F.lit(0)).alias("p"),
                    F.coalesce(F.sum(F.when(all_of(rule[:k]), 1 - F.col("bad"))), F.lit(0)).alias("n"),
                ).alias(str(k))
                for k in range(1, len(rule) + 1)
            ]
        ).first()
        worth = lambda k: (held[k]["p"] - held[k]["n"]) / max(1, held[k]["p"] + held[k]["n"])
        k = max(range(1, len(rule) + 1), key=lambda k: (worth(str(k)), -k))
        p, n = held[str(k)]["p"], held[str(k)]["n"]
        if p + n < MIN_COVER or p < MIN_PRECISION * (p + n):
            return accepted
        rule = rule[:k]
        accepted.rules.append([Condition(f, up, cuts[f][at - 1]) for f, up, at in rule])
        rest = rest & ~all_of(rule)
    return accepted


def _best_condition(counts: list, sizes: dict[str, int]) -> tuple[str, bool, int] | None:
    """The condition with the largest information gain that leaves fewer good rows."""
    by = {f: [[0, 0] for _ in range(n + 1)] for f, n in sizes.items()}
    for row in counts:
        by[row["f"]][row["k"]] = [row["p"], row["n"]]
    first = next(iter(by.values()))
    bad, good = sum(x[0] for x in first), sum(x[1] for x in first)
    if not bad or not good:
        return None
    found, most = None, 1e-9
    for feature, bins in by.items():
        for k in range(1, len(bins)):
            above = [sum(x[i] for x in bins[k:]) for i in (0, 1)]
            for at_least, (p, n) in ((True, above), (False, [bad - above[0], good - above[1]])):
                if p and n < good:
                    gain = p * (math.log2(p / (p + n)) - math.log2(bad / (bad + good)))
                    if gain > most:
                        found, most = (feature, at_least, k), gain
    return found


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", sample: int = SAMPLE) -> DecisionList:
    """A list from documents with a quality label, of which 0 is bad.

    Labels of an id are averaged (half counts as good), null ones left out. A hash of the id takes
    the share that gives ``sample`` rows on average; only their statistics are computed. Texts that
    fail the base rules are dropped anyway and teach nothing.
    """
    marks = labels.where("quality IS NOT NULL").groupBy("doc_id").agg(
        (F.avg("quality") < 0.5).cast("int").alias("bad")
    )
    n = marks.count()
    draw = F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(1_000_000)) / 1_000_000
    taken = marks.where(draw < min(1.0, sample / max(1, n)))
    # About ``sample`` ids at most are broadcast; texts stay where they are.
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(taken), "doc_id")
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(3)).alias("fold")
    stats = with_statistics(rows, "text", "").where(~base_failed()).select("bad", fold, *FEATURES)
    return learn(checkpointed(stats))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics and verdict of every whole text; a null text has no words and fails."""
    rules = train(docs, labels)
    stats = with_statistics(docs.select("doc_id", "text"), "text", "")
    return stats.select(
        "doc_id", *BASE, base_failed().alias("base_failed"), (~base_failed() & rules.kept()).alias("kept"),
        F.when(~base_failed(), rules.reason()).alias("reason"),
    )


def drop_bad(docs: DataFrame, rules: DecisionList, text: str = "text") -> DataFrame:
    """Rows of ``docs`` that the base rules and the list keep, with the same columns."""
    prefix = fresh(docs, "_q")
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    return with_statistics(docs, text, prefix).where(~base_failed(prefix) & rules.kept(prefix)).select(*docs.columns)
