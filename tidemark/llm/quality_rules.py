"""Quality rules: hard limits, then a decision list learned by sequential covering.

A rule is a conjunction of thresholds on text statistics that tells bad documents. Rules are grown on two
thirds of the labelled documents (best FOIL gain first), pruned on the last third (conditions are dropped
from the end while the share of bad documents among those covered does not fall), and the labelled
documents that a rule covers are set aside before the next one is learned. A rule that is not precise enough
sets its last condition aside instead, and the search goes on without it. It ends when no condition is left
that saves more bits in telling bad from good than it takes to write down; nothing else bounds the number of
rules or of conditions. Thresholds are chosen among quantiles, those of the far ends included, and then
refined between their neighbours. The list is an ordered Spark conditional expression. Statistics and
verdicts are DataFrame functions throughout; learning reads counts per threshold that Spark sums over all
labelled documents, never rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import SPACE, materialise, read, word_array

#: Fixed value: the symbols that count as such.
SYMBOLS = "#*$%&|<>"
#: Thresholds are quantiles, so many evenly spread and the rest at both ends; chosen ones are refined so often.
CUTS, REFINED = 16, 2
#: A rule must be right on this share of the labelled documents that it covers, and cover so many.
MIN_PRECISION = 0.9
MIN_COVER = 5


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def expression(self) -> Column:
        value = F.col(self.feature)
        return value > self.cut if self.above else value <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def _repeat_words(words: Column) -> Column:
    """Words in three-word windows that occur twice or more, the first occurrence included.

    Windows are hashed and sorted with their places, so equal ones lie side by side.
    """
    n = F.size(words) - 2
    codes = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(
        F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def places(codes: Column) -> Column:
        ordered = F.sort_array(F.transform(codes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.transform(F.array(ordered), lambda o: F.transform(F.filter(
            F.transform(o, lambda x, j: F.struct(
                x["i"].alias("i"),
                ((F.get(o, j - 1)["h"] == x["h"]) | F.coalesce(F.get(o, j + 1)["h"] == x["h"], F.lit(False)))
                .alias("twice"))),
            lambda x: x["twice"]), lambda x: x["i"]))[0]

    def covered(at: Column) -> Column:
        return F.size(F.array_distinct(F.concat(
            at, F.transform(at, lambda i: i + 1), F.transform(at, lambda i: i + 2))))

    def count(codes: Column) -> Column:
        return F.when(F.size(F.array_distinct(codes)) == F.size(codes), F.lit(0)).otherwise(
            F.transform(F.array(places(codes)), covered)[0])

    # A one-element array binds a name, so the hashes and their order are computed once.
    return F.when(n < 2, F.lit(0)).otherwise(F.transform(F.array(codes), count)[0]).cast("long")


def statistics(docs: DataFrame, *carry: Column) -> DataFrame:
    """doc_id, the columns ``carry`` and the statistics of each whole text; a null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    return docs.select(
        "doc_id", *carry,
        F.length(F.regexp_replace(text, f"[{SPACE}]+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.transform(F.array(word_array(text)), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), _repeat_words(w).alias("n_repeat_words"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct_words")))[0].alias("__w"),
        F.transform(F.array(lines), lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))[0].alias("__l"),
    ).select("*", "__w.*", "__l.*").drop("__w", "__l")


FEATURES = ["n_words", "mean_word_chars", "symbols_per_word", "dup_line_share", "repeat_share", "distinct_share",
            "words_per_line"]


def with_features(stats: DataFrame) -> DataFrame:
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return stats.withColumns({
        "mean_word_chars": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "dup_line_share": F.col("n_dup_lines") / lines,
        "repeat_share": F.col("n_repeat_words") / words,
        "distinct_share": F.col("n_distinct_words") / words,
        "words_per_line": F.col("n_words") / lines,
    })


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _all(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, [c.expression() for c in rule], F.lit(True))


def _counts(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[tuple[str, int], tuple[int, int]]:
    """(bad, good) of the rows by feature and number of cuts below the value: at most features x cuts rows."""
    bins = F.array(*[F.struct(F.lit(f).alias("feature"), F.size(F.filter(
        F.array(*[F.lit(c) for c in at]), lambda c: c < F.col(f))).alias("bin")) for f, at in cuts.items()])
    counted = rows.select("bad", F.explode(bins).alias("b")).groupBy("b.feature", "b.bin").agg(
        F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good"))
    return {(r["feature"], r["bin"]): (r["bad"], r["good"]) for r in counted.collect()}


def _quantiles(rows: DataFrame, features: list[str], at: list[float]) -> dict[str, list[float]]:
    """Thresholds by feature: quantiles of all rows and of the bad ones."""
    found = rows.agg(*[F.percentile_approx(v, at, 100_000).alias(f"{kind}{f}") for f in features for kind, v in (
        ("all_", F.col(f)), ("bad_", F.when(F.col("bad") == 1, F.col(f))))]).first()
    return {f: sorted({float(x) for kind in ("all_", "bad_") for x in found[f"{kind}{f}"] or []}) for f in features}


def _places(n_bad: int) -> list[float]:
    """Shares at which thresholds lie: even ones, and at both ends from MIN_COVER bad rows on by doubling."""
    even = [k / (CUTS + 1) for k in range(1, CUTS + 1)]
    ends, share = [], MIN_COVER / max(n_bad, 2 * MIN_COVER)
    while share < even[0]:
        ends += [share, 1 - share]
        share *= 2
    return sorted({*even, *ends})


def _entropy(p: int, n: int) -> float:
    """Bits that tell p bad from n good rows."""
    return sum(-x * math.log2(x / (p + n)) for x in (p, n) if x)


def _conditions(counts: dict, cuts: dict[str, list[float]], cost: float = 0.0):
    """FOIL gain, condition and precision of all that save more bits than ``cost``, over rows within and without."""
    for feature in cuts:
        by_bin = [counts.get((feature, i), (0, 0)) for i in range(len(cuts[feature]) + 1)]
        bad, good = sum(x[0] for x in by_bin), sum(x[1] for x in by_bin)
        if not bad:
            continue
        before, whole = math.log2(bad / (bad + good)), _entropy(bad, good)
        low = [0, 0]
        for i, cut in enumerate(cuts[feature]):
            low = [low[0] + by_bin[i][0], low[1] + by_bin[i][1]]
            for above, (p, n) in ((False, low), (True, (bad - low[0], good - low[1]))):
                if p >= MIN_COVER and whole - _entropy(p, n) - _entropy(bad - p, good - n) > cost:
                    yield p * (math.log2(p / (p + n)) - before), Condition(feature, above, cut), p / (p + n)


def _refine(rows: DataFrame, chosen: Condition, gain: float, cuts: list[float]) -> Condition:
    """The best threshold between the neighbours of a chosen one."""
    for _ in range(REFINED):
        i = cuts.index(chosen.cut)
        value = F.col(chosen.feature)
        near = rows
        if i > 0:
            near = near.filter(value > cuts[i - 1])
        if i + 1 < len(cuts):
            near = near.filter(value <= cuts[i + 1])
        finer = _quantiles(near, [chosen.feature], [k / (2 * CUTS) for k in range(1, 2 * CUTS)])[chosen.feature]
        finer = sorted({*finer, *cuts[max(0, i - 1):i + 2]})
        better = max(((g, c) for g, c, _ in _conditions(_counts(rows, {chosen.feature: finer}), {chosen.feature: finer})
                      if c.above == chosen.above), key=lambda x: x[0], default=(gain, chosen))
        if better[0] <= gain + 1e-9:
            break
        (gain, chosen), cuts = better, finer
    # Half-way between the values on its two sides: rows that it was not grown on may lie in between.
    value = F.col(chosen.feature)
    low, high = rows.agg(F.max(F.when(value <= chosen.cut, value)), F.min(F.when(value > chosen.cut, value))).first()
    if low is not None and high is not None and low < (middle := (low + high) / 2) < high:
        chosen = Condition(chosen.feature, chosen.above, middle)
    return chosen


def _grow(rows: DataFrame, cuts: dict[str, list[float]], aside: set[tuple]) -> tuple[Rule, tuple | None]:
    """A rule, condition by condition, until it covers no good row or no condition saves what it costs to write
    down; and what to set aside if it is refused: its last condition's feature and side after the ones before.
    What is set aside is only tried at thresholds that are precise enough by themselves."""
    rule: Rule = ()
    last = None
    cost = math.log2(2 * sum(map(len, cuts.values())) or 1)
    while True:
        inside = rows.filter(_all(rule))
        counts = _counts(inside, cuts)
        feature = next(iter(cuts))
        if not sum(n for (f, _), (_, n) in counts.items() if f == feature):
            return rule, last
        before = tuple((c.feature, c.above) for c in rule)
        # Ties go to the first feature, cut and side.
        best = max(((gain, c) for gain, c, precision in _conditions(counts, cuts, cost)
                    if (before, c.feature, c.above) not in aside
                    or precision >= MIN_PRECISION and (before, c.feature, c.above, c.cut) not in aside),
                   key=lambda x: x[0], default=None)
        if best is None or best[0] <= 0:
            return rule, last
        last = (before, best[1].feature, best[1].above)
        if last in aside:
            last = (*last, best[1].cut)
        rule = (*rule, _refine(inside, best[1], best[0], cuts[best[1].feature]))


def _prune(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The shortest prefix of the rule that is as precise as any on rows that it was not grown on."""
    heads = [rule[:k] for k in range(1, len(rule) + 1)]
    sums = rows.agg(*[F.sum(F.when(_all(h), x).otherwise(0)).alias(f"{name}{k}")
                      for k, h in enumerate(heads) for name, x in (("p", F.col("bad")), ("n", 1 - F.col("bad")))]).first()
    share = [((sums[f"p{k}"] or 0) + 1) / ((sums[f"p{k}"] or 0) + (sums[f"n{k}"] or 0) + 2) for k in range(len(heads))]
    k = max(range(len(heads)), key=lambda i: (share[i], -i))
    return heads[k], sums[f"p{k}"] or 0, sums[f"n{k}"] or 0


def learn(labelled: DataFrame) -> list[Rule]:
    """The decision list from rows with FEATURES, ``bad`` (0 or 1) and ``fold`` (0, 1 or 2; 2 prunes).

    Each accepted rule takes MIN_COVER bad rows away and each refused one a condition, so the search ends. No
    rows, or rows of one kind only, give an empty list.
    """
    rows, rules, aside = labelled, [], set()
    while True:
        n_bad = rows.agg(F.coalesce(F.sum("bad"), F.lit(0))).first()[0]
        if n_bad < MIN_COVER:
            return rules
        grown = rows.filter("fold < 2")
        if not aside:
            cuts = _quantiles(rows, FEATURES, _places(n_bad))
        rule, last = _grow(grown, cuts, aside)
        if last is None:
            return rules
        pruned, bad, good = _prune(rows.filter("fold = 2"), rule)
        grown_bad, grown_good = grown.filter(_all(pruned)).agg(F.sum("bad"), F.sum(1 - F.col("bad"))).first()
        bad, good = bad + (grown_bad or 0), good + (grown_good or 0)
        if bad < MIN_COVER or bad < MIN_PRECISION * (bad + good):
            aside.add(last)
            continue
        rules.append(pruned)
        rows, aside = rows.filter(~_all(pruned)), set()


def verdict(rules: list[Rule]) -> Column:
    """True for documents that no rule covers; the ordered conditional expression of the list."""
    kept = F.lit(True)
    for rule in reversed(rules):
        kept = F.when(_all(rule), F.lit(False)).otherwise(kept)
    return kept


def judged(docs: DataFrame, labels: DataFrame, *carry: Column) -> DataFrame:
    """doc_id, ``carry``, the statistics, base_failed and kept; one row per row of ``docs``, in no order.

    ``labels`` has doc_id and quality (1 good, 0 bad). Only labelled documents that pass the base limits
    teach; labels without a quality or a document are left out, and of several labels of one doc_id the
    lowest counts. Null and empty texts have no words and fail the base. Without labels the base decides.
    """
    stats = materialise(
        with_features(statistics(docs, *carry)).withColumn("base_failed", base_failed()), "statistics")
    marks = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality"))
    labelled = materialise(
        stats.filter(~F.col("base_failed")).select("doc_id", *FEATURES).join(marks, "doc_id")
        .select(*FEATURES, (F.col("quality") == 0).cast("int").alias("bad"),
                F.pmod(F.crc32(F.concat(F.lit("fold"), F.col("doc_id").cast("string"))), F.lit(3)).alias("fold")),
        "labelled")
    return stats.withColumn("kept", ~F.col("base_failed") & verdict(learn(labelled)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judged(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns as they are; no text is shuffled."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    return judged(docs, labels, whole).filter("kept").select("__row.*")


BASE_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^{SPACE}]+') AS ws FROM t),
wins AS (SELECT doc_id, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] AS win
         FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
dups AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS n FROM wins) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM dups, (SELECT unnest([0, 1, 2]) AS j) GROUP BY doc_id),
lin AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM
        (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t)
        WHERE regexp_matches(line, '[^{SPACE}]') GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, length(regexp_replace(text, '[{SPACE}]+', '', 'g')) AS word_chars,
       length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
       coalesce(lin.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
       len(ws) < 50 OR 100 * coalesce(rep.n, 0) > 50 * len(ws) AS base_failed
FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN lin USING (doc_id)
"""
