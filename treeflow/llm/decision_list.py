"""Quality rules as a learned decision list, in DataFrame and SQL functions only.

Statistics of a text come from array functions over its own words and lines, so documents
are neither exploded nor shuffled.  Windows of three words are compared by 64-bit hashes,
sorted within the text; the second sort, by hash and place, runs only for texts where some
window repeats.

Learning is sequential covering.  Labelled statistics are binned once at quantiles; every
step of growing a rule is one grouped count of (statistic, bin, fold, label), whose size is
bounded by the bins, and the driver takes the threshold of most information gain (FOIL).
A grown rule is pruned from its end on another fold, or on all rows while that fold has too
few bad ones to judge by.  It is kept if precise enough there and if its likelihood ratio
against the share of bad rows is significant, which asks for more rows the less rare they are,
however few labels there are.  Covered rows leave, and the next rule is grown.  The rules
become one ordered CASE.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._spark import cut

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
BINS, MAX_RULES, MAX_CONDITIONS = 16, 12, 4
MIN_PRECISION, TRAIN_ROWS = 0.95, 200_000
#: bad rows from which a fold of its own judges rules; chi-squared of one degree at 0.1 percent
MIN_FOLD, MIN_LIKELIHOOD = 20, 10.83

_WHITE = "[\\x20\\x09-\\x0D]+"
#: name of a learned statistic -> how it follows from the counts
FEATURES = {
    "n_words": lambda: F.col("n_words").cast("double"),
    "word_length": lambda: F.col("word_chars") / F.greatest("n_words", F.lit(1)),
    "symbols_a_word": lambda: F.col("n_symbols") / F.greatest("n_words", F.lit(1)),
    "dup_lines_a_line": lambda: F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
    "repeated_words_a_word": lambda: F.col("n_repeat_words") / F.greatest("n_words", F.lit(1)),
    "upper_a_char": lambda: F.col("n_upper") / F.greatest("word_chars", F.lit(1)),
    "marks_a_word": lambda: F.col("n_marks") / F.greatest("n_words", F.lit(1)),
    "digits_a_char": lambda: F.col("n_digits") / F.greatest("word_chars", F.lit(1)),
}
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_digits"]


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of statistics_plan, stored: were a filter on a count pushed into the plan, it
    would evaluate the array functions anew for every element."""
    return cut(statistics_plan(docs, id_col, text_col))


def statistics_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and the counts of each whole text; a null or empty text has none.

    Words are maximal runs without [\\x20\\x09-\\x0D]; lines, those with a word, are split
    at \\n.  Rows are taken singly, so ids may repeat or be null.  A text's arrays are held
    whole: its task needs some 100 bytes for each word of the longest text.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    a = docs.select(F.col(id_col).alias("_id"), text.alias("_t"))
    a = a.select("_id", "_t", F.filter(F.split("_t", _WHITE), lambda w: w != "").alias("_w"), F.filter(F.split("_t", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("_l"))
    count = lambda pattern: F.regexp_count("_t", F.lit(pattern))
    a = a.select(
        "_id",
        "_w",
        F.size("_w").alias("n_words"),
        F.length(F.array_join("_w", "")).alias("word_chars"),
        count("[#*$%&|<>]").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).alias("n_dup_lines"),
        F.size("_l").alias("n_lines"),
        count("\\p{Lu}").alias("n_upper"),
        count("[!?]").alias("n_marks"),
        count("[0-9]").alias("n_digits"),
    )
    rest = [c for c in a.columns if c != "_w"]
    windows = F.transform(F.sequence(F.lit(0), F.col("n_words") - 3), lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)))
    a = a.select(*rest, F.when(F.col("n_words") >= 4, windows).otherwise(F.array().cast("array<long>")).alias("_g"))
    a = a.select(*rest, "_g", F.sort_array("_g").alias("_s"))
    some = F.size(F.array_distinct("_g")) < F.size("_g")
    a = a.select(*rest, F.when(some, F.sort_array(F.transform("_g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(F.array().cast("array<struct<h:long,i:int>>")).alias("_p"))
    again = lambda x, k: (x["h"] == F.get("_p", k - 1)["h"]) | (x["h"] == F.get("_p", k + 1)["h"])
    a = a.select(*rest, F.sort_array(F.transform(F.filter("_p", lambda x, k: F.coalesce(again(x, k), x["h"] == F.get("_p", k - 1)["h"], x["h"] == F.get("_p", k + 1)["h"], F.lit(False))), lambda x: x["i"])).alias("_r"))
    # a window covers its three words, or as many as there are before the next window
    covered = F.aggregate(F.transform("_r", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("_r", k + 1) - p, F.lit(3)))), F.lit(0), lambda s, x: s + x)
    a = a.select(*rest, covered.alias("n_repeat_words"))
    return a.select(F.col("_id").alias(id_col), *(F.col(c).cast("long").alias(c) for c in _COUNTS))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    threshold: float
    at_least: bool

    def column(self) -> Column:
        x = FEATURES[self.feature]()
        return x >= self.threshold if self.at_least else x < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c.column()
    return out


def decide(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, from 1; 0 if none does."""
    out = F
    for i, rule in enumerate(rules, 1):
        out = out.when(_all(rule), F.lit(i))
    return out.otherwise(F.lit(0)).cast("int") if rules else F.lit(0)


def _best(counts: dict, thresholds: dict[str, list[float]], p0: int, n0: int) -> tuple[float, Condition] | None:
    """The condition of most gain; counts: (feature, bin) -> (bad, good)."""
    best = None
    for name, cuts in thresholds.items():
        bins = [counts.get((name, b), (0, 0)) for b in range(len(cuts) + 1)]
        for i, cut_at in enumerate(cuts):
            low = [sum(x) for x in zip(*bins[: i + 1], strict=True)]
            for at_least, (p, n) in ((False, low), (True, [p0 - low[0], n0 - low[1]])):
                if p and (p, n) != (p0, n0):
                    gain = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))
                    if gain > 1e-9 and (best is None or gain > best[0]):
                        best = (gain, Condition(name, cut_at, at_least))
    return best


def _likelihood_ratio(p: int, q: int, bad: int, good: int) -> float:
    """Twice the logarithm of how much likelier p bad and q good rows are by their own shares
    than by those of all rows."""
    share = lambda n, own, every: n * math.log(own / every) if n else 0.0
    return 2 * (share(p, p / max(p + q, 1), bad / (bad + good)) + share(q, q / max(p + q, 1), good / (bad + good)))


def learn(stats: DataFrame, labels: DataFrame, id_col="doc_id", label_col="quality", bins=BINS, max_rules=MAX_RULES, max_conditions=MAX_CONDITIONS, min_precision=MIN_PRECISION, min_fold=MIN_FOLD, min_likelihood=MIN_LIKELIHOOD, train_rows=TRAIN_ROWS) -> list[Rule]:
    """Rules for label 0, in order.

    Learns from at most about `train_rows` labelled rows that pass the base rules, chosen
    by a hash.  Null labels and ids are left out; an id with several labels counts with its
    least.  Without rows of both labels there are no rules.
    """
    own = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_lid")).agg(F.min(label_col).alias("_y"))
    n = own.count()
    own = own.filter(F.pmod(F.xxhash64("_lid"), F.lit(1 << 20)) < min(1.0, train_rows / max(n, 1)) * (1 << 20))
    rows = stats.filter(~base_failed()).join(own, F.col(id_col) == F.col("_lid")).select((F.col("_y") == 0).alias("bad"), (F.pmod(F.xxhash64("_lid", F.lit(7)), F.lit(3)) == 0).alias("prune"), *_COUNTS)
    rows = cut(rows.repartition(8))
    probs = [i / bins for i in range(1, bins)]
    found = rows.groupBy("bad").agg(*(F.percentile_approx(f(), probs, 1000).alias(name) for name, f in FEATURES.items())).collect()
    if len(found) < 2:
        return []
    # thresholds lie between the labels' quantiles
    thresholds = {}
    for name in FEATURES:
        values = sorted({v for r in found for v in r[name]})
        thresholds[name] = [(a + b) / 2 for a, b in zip(values, values[1:], strict=False)]
    placed = F.explode(F.array(*(F.struct(F.lit(name).alias("f"), sum((F.when(f() >= t, 1).otherwise(0) for t in thresholds[name]), F.lit(0)).alias("b")) for name, f in FEATURES.items()))).alias("x")
    left, rules = rows, []
    while len(rules) < max_rules:
        rest = {(r["prune"], r["bad"]): r["count"] for r in left.groupBy("prune", "bad").count().collect()}
        apart = rest.get((True, True), 0) >= min_fold
        grown, judged = (~F.col("prune"), F.col("prune")) if apart else (F.lit(True), F.lit(True))
        bad, good = (sum(rest.get((fold, b), 0) for fold in ((True,) if apart else (True, False))) for b in (True, False))
        rule: list[Condition] = []
        while len(rule) < max_conditions:
            got = left.filter(grown & _all(rule)).select("bad", placed).groupBy("x.f", "x.b", "bad").count().collect()
            counts: dict = {}
            for r in got:
                p, q = counts.get((r["f"], r["b"]), (0, 0))
                counts[r["f"], r["b"]] = (p + r["count"], q) if r["bad"] else (p, q + r["count"])
            first = next(iter(FEATURES))
            p0, n0 = (sum(v[k] for (f, _), v in counts.items() if f == first) for k in (0, 1))
            best = _best(counts, thresholds, p0, n0) if p0 and n0 else None
            if best is None:
                break
            rule.append(best[1])
        if not rule:
            break
        held = left.filter(judged).agg(*(F.sum(F.when(_all(rule[: k + 1]) & (F.col("bad") == b), 1).otherwise(0)).alias(f"c{k}{int(b)}") for k in range(len(rule)) for b in (False, True))).first()
        value = [((held[f"c{k}1"] or 0), (held[f"c{k}0"] or 0)) for k in range(len(rule))]
        worth = [(p + 1) / (p + q + 2) for p, q in value]
        keep = max(range(len(rule)), key=lambda k: (worth[k], -k))
        p, q = value[keep]
        if p < min_precision * (p + q) or _likelihood_ratio(p, q, bad, good) < min_likelihood:
            break
        rules.append(tuple(rule[: keep + 1]))
        left = left.filter(~_all(rules[-1]))
    return rules


def judge(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """stats with base_failed, rule (0: none) and kept."""
    out = stats.withColumn("base_failed", base_failed()).withColumn("rule", decide(rules))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
