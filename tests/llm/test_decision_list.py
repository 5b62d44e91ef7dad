import random
from collections import Counter

from tests.conftest import DATA
from tests.llm.common import EDGES, with_clashes, words
from treeflow.llm import decision_list as X


def brute(text):
    text = text or ""
    w, seen, dup = words(text), set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_counts(spark):
    r = random.Random(3)
    rows = [*EDGES, (10, "a a a a"), (11, "a a a"), (12, "a b c a b c"), (13, "a b c x a b c y b c x"), (14, "q w " * 15_000), (15, "#<>|" * 1000)]
    rows += [(100 + i, " ".join(r.choice("abc") for _ in range(r.randint(0, 30)))) for i in range(60)]
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"), ["n_words", "_w", "_id", "_t"])
    out = X.statistics(docs)
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out.collect())
    assert got == Counter((i, *brute(t)) for i, t in rows)
    assert X.statistics(docs.limit(0)).count() == 0


def test_table_and_plan(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = X.statistics(docs)
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out.collect()}
    assert got == {r.doc_id: brute(r.text) for r in docs.collect()}
    plan = X.statistics_plan(docs)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Exchange"))


def frame(spark, n=400):
    """Bad rows: many symbols, or short words together with many marks."""
    r = random.Random(1)
    rows = []
    for i in range(n):
        symbols, marks, length = r.randint(0, 20), r.randint(0, 30), r.randint(300, 700)
        bad = symbols > 14 or (marks > 20 and length < 420)
        rows.append((i, 100, length, symbols, 0, 0, 5, 10, marks, 0, 0 if bad else 1))
    df = spark.createDataFrame(rows, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, n_marks long, n_digits long, quality int")
    return df.drop("quality"), df.select("doc_id", "quality")


def test_learns_rules(spark):
    stats, labels = frame(spark)
    rules = X.learn(stats, labels, min_precision=0.9)
    assert rules and any(c.feature == "symbols_a_word" for c in rules[0])
    out = X.judge(stats, rules).join(labels, "doc_id").collect()
    kept_good = sum(r.kept for r in out if r.quality == 1) / sum(r.quality == 1 for r in out)
    caught = sum(not r.kept for r in out if r.quality == 0) / sum(r.quality == 0 for r in out)
    assert kept_good > 0.97 and caught > 0.7
    # the ordered conditions, evaluated one by one
    by = {r.doc_id: r for r in X.judge(stats, rules).collect()}
    for i, rule in enumerate(rules, 1):
        holds = {r.doc_id for r in stats.filter(X._all(rule)).collect()}
        assert all(1 <= by[d].rule <= i for d in holds)


def test_base_rules_and_no_labels(spark):
    stats, labels = frame(spark, 20)
    assert X.learn(stats, labels.limit(0)) == []
    assert X.learn(stats, labels.withColumn("quality", X.F.lit(None).cast("int"))) == []
    assert X.learn(stats, labels.withColumn("quality", X.F.lit(1))) == []
    base = stats.withColumn("n_words", X.F.when(X.F.col("doc_id") == 0, 49).otherwise(100)).withColumn("n_repeat_words", X.F.when(X.F.col("doc_id") == 1, 51).when(X.F.col("doc_id") == 2, 50).otherwise(0))
    failed = {r.doc_id for r in X.judge(base, []).filter("base_failed").collect()}
    assert failed == {0, 1} and X.judge(base, []).filter("kept").count() == 18


def shares(stats, rules, labels):
    """Of good rows the share kept, of bad ones the share that rules catch, by held-out labels."""
    out = X.judge(stats, rules).join(labels, "doc_id").filter("not base_failed").collect()
    good, bad = ([r.kept for r in out if r.quality == q] for q in (1, 0))
    return sum(good) / max(len(good), 1), 1 - sum(bad) / max(len(bad), 1), len(bad)


def test_few_labels(spark):
    """All labels of the smallest table, and half of those of the next one, judged by the rest."""
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    stats = X.statistics(docs)
    kept, caught, _ = shares(stats, X.learn(stats, labels), labels)
    assert kept == 1 and caught > 0.6
    folder = DATA.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    stats = X.statistics(docs)
    for half in (0, 1):
        rules = X.learn(stats, labels.filter(f"doc_id % 2 = {half}"))
        kept, caught, n = shares(stats, rules, labels.filter(f"doc_id % 2 <> {half}"))
        print([[str(c) for c in r] for r in rules], kept, caught, n)
        assert rules and kept > 0.97 and caught > 0.7


def test_labels_of_chance_give_no_rule(spark):
    stats, labels = frame(spark, 300)
    for seed in range(3):
        chance = labels.withColumn("quality", X.F.when(X.F.pmod(X.F.xxhash64("doc_id", X.F.lit(seed)), X.F.lit(12)) == 0, 0).otherwise(1))
        assert X.learn(stats, chance) == []


def test_two_rules_one_of_two_conditions(spark):
    stats, labels = frame(spark, 3000)
    rules = X.learn(stats, labels.filter("doc_id % 2 = 0"))
    print([[str(c) for c in r] for r in rules])
    assert len(rules) >= 2 and any({c.feature for c in r} >= {"marks_a_word", "word_length"} for r in rules)
    kept, caught, _ = shares(stats, rules, labels.filter("doc_id % 2 = 1"))
    assert kept > 0.97 and caught > 0.85


def test_likelihood_ratio():
    import math

    assert X._likelihood_ratio(5, 0, 10, 90) == 2 * 5 * math.log(10)
    assert X._likelihood_ratio(1, 9, 10, 90) == 0 and X._likelihood_ratio(0, 0, 10, 90) == 0


def test_the_registered_query(spark):
    from treeflow.llm.queries import op5_decision_list

    docs = {r.doc_id: brute(r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    out = op5_decision_list(spark, DATA).collect()
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out} == docs
    for r in out:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.rule == 0)
