"""Quality rules (op 8): decision lists learned by sequential covering, as ordered Spark conditional expressions.

The statistics of a text are DataFrame expressions; no Python runs on the executors. Rules are learned on the driver from
the statistics of at most `SAMPLE_ROWS` labelled documents (those with the smallest hash of their id; a documented
bound). Each rule is a conjunction of thresholds that covers low-quality documents:

1. grow: on two thirds of the rows, add the threshold with the best information gain until no good row is covered;
2. prune: on the other third, drop the last conditions as long as (bad - good) / (bad + good) does not fall;
3. keep the rule if it is right for at least `PRECISION` of the rows it covers in either part; remove what it covers; repeat.

`verdict` turns the list into CASE WHEN rule 1 THEN false WHEN rule 2 THEN false ... ELSE true END.

Null and empty texts have no words; they fail the base rules. Repeated rows are judged each and equally. A document whose
labels differ counts as bad if one of them says so; null labels are not used. Without labels of both kinds the list is empty
and only the base rules reject. Other columns are neither read nor changed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemart.llm.common import free_name

SAMPLE_ROWS = 20_000
#: Share of the rows covered by a rule that must be bad, on the rows it was grown and on those it was pruned with.
PRECISION = 0.95
#: Bad rows that a rule must cover at least.
SUPPORT = 5
MOST_RULES = 24
MOST_CONDITIONS = 4
CUTS = 64

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "upper_share", "mark_share", "words"]


def _let(value: Column, body) -> Column:
    """body(value), with value computed once: lambdas would compute a column they refer to once per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(words: Column, n: Column) -> Column:
    """Words in windows of three words that the text holds twice or more.

    Windows are sorted by hash, those with an equal neighbour are kept, and the words of the kept windows are counted in order of
    place. The sort is skipped when all windows are distinct.
    """

    def hashed(i: Column) -> Column:
        return F.xxhash64(F.get(words, i - 1), F.get(words, i), F.get(words, i + 1))

    def repeated(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))

        def twins(s: Column) -> Column:
            def twin(x: Column, i: Column) -> Column:
                return F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))

            return F.sort_array(F.transform(F.filter(s, twin), lambda x: x["p"]))

        def covered(places: Column) -> Column:
            steps = F.transform(places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3))))
            return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(_let(_let(pairs, twins), covered))

    return F.when(n >= 3, _let(F.transform(F.sequence(F.lit(1), n - 2), hashed), repeated)).otherwise(F.lit(0))


def _counts(text: Column) -> Column:
    """All counts of a text as one struct."""
    # As one expression: words and lines are split once.
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))

    def of(words: Column) -> Column:
        n = F.size(words)
        return F.struct(
            n.cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
            _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("all"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("lines"),
            _repeat_words(words, n).cast("long").alias("n_repeat_words"),
            F.size(F.array_distinct(words)).cast("long").alias("distinct"),
            F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("upper"),
            F.regexp_count(text, F.lit("[!?|]")).cast("long").alias("marks"),
        )

    return _let(F.array_remove(F.split(text, SPACE), ""), of)


def text_statistics(docs: DataFrame, stats: str = "_stats") -> DataFrame:
    """The columns of docs and one struct with COUNTS, base_failed and FEATURES of the text column, under the name `stats`."""
    own = free_name(docs, "_counts")
    counted = docs.withColumn(own, _counts(F.coalesce(F.col("text"), F.lit(""))))
    c = {name: F.col(f"{own}.{name}") for name in ("n_words", "word_chars", "n_symbols", "n_repeat_words", "distinct", "upper", "marks")}
    lines, dup = F.col(f"{own}.lines.all"), F.col(f"{own}.lines.dup")

    def share(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    failed = (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
    fields = [
        c["n_words"].alias("n_words"),
        c["word_chars"].alias("word_chars"),
        c["n_symbols"].alias("n_symbols"),
        dup.alias("n_dup_lines"),
        c["n_repeat_words"].alias("n_repeat_words"),
        failed.alias("base_failed"),
        share(c["word_chars"], c["n_words"]).alias("mean_word"),
        share(c["n_symbols"], c["word_chars"]).alias("symbol_share"),
        share(dup, lines).alias("dup_line_share"),
        share(c["n_repeat_words"], c["n_words"]).alias("repeat_share"),
        share(c["distinct"], c["n_words"]).alias("distinct_share"),
        share(c["upper"], c["word_chars"]).alias("upper_share"),
        share(c["marks"], c["word_chars"]).alias("mark_share"),
        c["n_words"].cast("double").alias("words"),
    ]
    return counted.withColumn(stats, F.struct(*fields)).drop(own)


@dataclass(frozen=True)
class Condition:
    """feature <= cut, or feature > cut."""

    feature: str
    above: bool
    cut: float

    def holds(self, values: np.ndarray) -> np.ndarray:
        x = values[:, FEATURES.index(self.feature)]
        return x > self.cut if self.above else x <= self.cut

    def column(self, stats: str) -> Column:
        x = F.col(f"{stats}.{self.feature}")
        return x > self.cut if self.above else x <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, values: np.ndarray) -> np.ndarray:
    out = np.ones(len(values), bool)
    for condition in rule:
        out &= condition.holds(values)
    return out


def _best_condition(values: np.ndarray, bad: np.ndarray) -> tuple[float, Condition | None]:
    """The threshold with the highest gain: bad rows kept, times the bits that the share of bad rows wins."""
    before = np.log2(max(bad.sum(), 1e-9) / len(bad))
    best: tuple[float, Condition | None] = (1e-9, None)
    for k, feature in enumerate(FEATURES):
        order = np.argsort(values[:, k], kind="stable")
        x, b = values[order, k], np.cumsum(bad[order])
        ends = np.flatnonzero(x[:-1] < x[1:])
        if len(ends) > CUTS * 64:  # for many distinct values: cuts at equal steps of rank
            ends = ends[np.linspace(0, len(ends) - 1, CUTS * 64).astype(int)]
        if not len(ends):
            continue
        for above in (False, True):
            p = (b[-1] - b[ends] if above else b[ends]).astype(float)
            n = (len(x) - 1 - ends if above else ends + 1).astype(float)
            gain = p * (np.log2(np.maximum(p, 1e-9) / n) - before)
            top = int(np.argmax(gain))
            if gain[top] > best[0]:
                best = float(gain[top]), Condition(feature, above, float((x[ends[top]] + x[ends[top] + 1]) / 2))
    return best


def _grow(values: np.ndarray, bad: np.ndarray) -> Rule:
    rule: Rule = ()
    while len(rule) < MOST_CONDITIONS and bad.any() and not bad.all():
        _, condition = _best_condition(values, bad)
        if condition is None:
            break
        rule = (*rule, condition)
        held = condition.holds(values)
        values, bad = values[held], bad[held]
    return rule


def _prune(rule: Rule, values: np.ndarray, bad: np.ndarray) -> Rule:
    def worth(r: Rule) -> float:
        held = covers(r, values)
        return (2 * bad[held].sum() - held.sum()) / held.sum() if held.any() else -1.0

    while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
        rule = rule[:-1]
    return rule


def learn_rules(values: np.ndarray, bad: np.ndarray) -> list[Rule]:
    """An ordered list of rules that cover bad rows. values: one column per feature."""
    part = np.arange(len(bad)) % 3 == 2
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while len(rules) < MOST_RULES and bad[left & ~part].sum() >= SUPPORT:
        grown, pruned = left & ~part, left & part
        rule = _prune(_grow(values[grown], bad[grown]), values[pruned], bad[pruned])
        held = covers(rule, values) & left if rule else np.zeros(len(bad), bool)
        right = all(bad[held & s].sum() >= PRECISION * (held & s).sum() for s in (part, ~part))
        if not right or bad[held].sum() < SUPPORT:
            break
        rules.append(rule)
        left &= ~held
    return rules


def fit_rules(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules learned from at most sample_rows labelled documents. docs: doc_id, text; labels: doc_id, quality (1 is good)."""
    marked = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("_quality"))
    order = F.xxhash64("doc_id")
    chosen = marked.orderBy(order, "doc_id").limit(sample_rows)
    # The sample has a fixed bound on its rows, so it may be sent to all executors.
    rows = (
        text_statistics(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))
        .filter("NOT _stats.base_failed")
        .select(order.alias("_order"), "doc_id", "_quality", *[f"_stats.{x}" for x in FEATURES])
        .dropDuplicates(["doc_id"])
        .collect()
    )
    rows.sort(key=lambda r: (r["_order"], r["doc_id"]))
    values = np.array([[r[x] for x in FEATURES] for r in rows], float).reshape(-1, len(FEATURES))
    return learn_rules(values, np.array([r["_quality"] == 0 for r in rows], bool))


def verdict(rules: list[Rule], stats: str = "_stats") -> Column:
    """Whether a text is kept: the first rule that covers it rejects it."""
    out = F.when(F.col(f"{stats}.base_failed"), F.lit(False))
    for rule in rules:
        condition = rule[0].column(stats)
        for more in rule[1:]:
            condition = condition & more.column(stats)
        out = out.when(condition, F.lit(False))
    return out.otherwise(F.lit(True))


def quality(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """doc_id, the counts, base_failed and kept of each row of docs (doc_id, text)."""
    stats = text_statistics(docs.select("doc_id", "text"))
    return stats.select("doc_id", *[f"_stats.{x}" for x in COUNTS], "_stats.base_failed", verdict(rules).alias("kept"))


def keep_good(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows of docs that the rules keep, with all columns of docs."""
    stats = free_name(docs, "_stats")
    return text_statistics(docs, stats).filter(verdict(rules, stats)).drop(stats)
