import zlib

import numpy as np
import pytest

from tests.conftest import DATA
from tests.llm.common import EDGES, with_clashes
from treeflow.llm import language_id as X

SAMPLES = {
    "en": "the quick brown fox jumps over the lazy dog while this weather remains with them",
    "de": "der schnelle braune fuchs springt über den faulen hund während das wetter schön bleibt",
    "ru": "быстрая лиса прыгает через ленивую собаку пока погода остаётся хорошей",
    "el": "η γρήγορη αλεπού πηδάει πάνω από το τεμπέλικο σκυλί όσο ο καιρός μένει καλός",
}


def rows(n=90):
    rng = np.random.default_rng(2)
    out = []
    for i in range(n):
        lang = list(SAMPLES)[i % 4]
        out.append((i, " ".join(rng.choice(SAMPLES[lang].split(), 30)), lang))
    return out


@pytest.fixture(scope="module")
def model(spark):
    return X.train(spark.createDataFrame([*rows(), (1000, "no label here", None), (1001, None, "en")], "doc_id long, text string, lang string"))


def brute_viterbi(scores, switch):
    n, k = scores.shape
    value, back = scores[0].copy(), []
    for t in range(1, n):
        top = int(value.argmax())
        stay = value >= value[top] - switch
        back.append(np.where(stay, np.arange(k), top))
        value = np.where(stay, value, value[top] - switch) + scores[t]
    path = [int(value.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def test_viterbi_is_the_plain_one():
    rng = np.random.default_rng(1)
    counts = np.array([1, 7, 0, 40, 3, 40, 200])
    scores = -rng.integers(0, 4, (counts.sum(), 3)).astype(float)
    got = X.viterbi(scores, counts, 2.0)
    at = np.concatenate([[0], np.cumsum(counts)])
    for i, n in enumerate(counts):
        if n:
            part = scores[at[i] : at[i + 1]]
            own, ref = got[at[i] : at[i + 1]], brute_viterbi(part, 2.0)
            worth = lambda p, s=part: s[np.arange(len(p)), p].sum() - 2.0 * (np.diff(p) != 0).sum()
            assert list(own) == ref and worth(own) == worth(np.array(ref))


def test_held_out_accuracy(spark, model):
    df = spark.createDataFrame(rows(), "doc_id long, text string, lang string")
    out = X.predict(df.withColumn("h", X.held_out()), model).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    held = [r for r in out if r.h]
    assert held and np.mean([r.lang_pred == r.lang for r in held]) > 0.95


def test_accuracy_on_the_table(spark):
    from tests.conftest import DATA

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = X.predict(docs.withColumn("h", X.held_out()), X.train(docs), keep=["h", "lang"]).filter("h").collect()
    assert np.mean([r.lang_pred == r.lang for r in out]) > 0.95
    assert all(0 <= r.score <= 1 for r in out)


def test_spans_of_mixed_text(spark, model):
    text = " ".join(SAMPLES[x] for x in ("en", "de", "ru"))
    r = X.predict(spark.createDataFrame([(1, text)], "doc_id long, text string"), model, spans=True).first()
    assert [s["lang"] for s in r.spans] == ["en", "de", "ru"]
    bounds = np.cumsum([len(SAMPLES[x]) + 1 for x in ("en", "de", "ru")])
    assert all(abs(s["end"] - (b - 1)) <= 12 for s, b in zip(r.spans, bounds, strict=True))


def test_scripts_narrow(model):
    w = X.Words(["лиса fox αλεπού 日本"], model.buckets, model.sizes)
    s = model.scores(w)
    assert [model.langs[i] for i in s.argmax(1)[:3]][0] == "ru" and (s[0] < 0).sum() == 3
    assert (s[3] == 0).all()  # nobody's script: no evidence


def test_edges(spark, model):
    data = [*EDGES, (7, "123 - 456 !"), (8, "日本語"), (9, "the dog " * 40_000)]
    df = with_clashes(spark.createDataFrame(data, "doc_id long, text string"), ["score", "lang_pred", "_0"])
    out = X.predict(df, model).collect()
    assert len(out) == len(data)
    by = {(r.doc_id, r.text): r for r in out}
    for _, t in data:
        letters = any(c.isalpha() for c in t or "")
        assert all((r.lang_pred == "und") == (not letters) and (letters or r.score == 0) for (_, x), r in by.items() if x == t)
    assert by[9, "the dog " * 40_000].lang_pred == "en" and by[8, "日本語"].score < 0.5
    assert X.predict(df.limit(0), model).count() == 0


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "words", None)], "doc_id long, text string, lang string")
    assert X.train(df) is None
    assert X.predict(df, None).first().lang_pred == "und"


def test_drop_unknown(spark, model):
    df = with_clashes(spark.createDataFrame([(1, SAMPLES["en"]), (2, "--"), (3, None), (4, "日本語")], "doc_id long, text string"), ["score", "lang_pred"])
    out = X.drop_unknown(df, model)
    assert out.columns == df.columns and [r.doc_id for r in out.collect()] == [1]


def gram_buckets(word, sizes, buckets):
    """The n-grams of one word with a boundary on either side, hashed in plain integers."""
    padded, out = [0, *(ord(c) for c in word.lower()), 0], []
    for size in sizes:
        for i in range(len(padded) - size + 1):
            if size > 1 or padded[i]:
                h = size
                for c in padded[i : i + size]:
                    h = (h ^ c) * 0x9E3779B97F4A7C15 % (1 << 64)
                    h ^= h >> 29
                out.append(h % buckets)
    return out


def test_counts_and_word_scores_by_brute_force(spark):
    import math
    import re

    rows = [(i, " ".join(ws), lang) for i, (ws, lang) in enumerate([(["Der", "Hund", "und", "die", "Katze"], "de"), (["the", "dog", "and", "A", "cat"], "en"), (["кот", "и", "Собака"], "ru"), (["und", "der", "the"], "de")] * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = X.train(docs, buckets=512, train_docs=10**6)
    known = [(t, lang) for r in docs.filter(~X.held_out()).collect() for t, lang in [(r.text, r.lang)]]
    langs = sorted({lang for _, lang in known})
    assert model.langs == langs
    counts, script = [[0] * len(langs) for _ in range(512)], {}
    for text, lang in known:
        for word in re.findall(r"\w+", text):
            for b in gram_buckets(word, X.SIZES, 512):
                counts[b][langs.index(lang)] += 1
            own = "cyrillic" if ord(word[0]) > 1000 else "latin"
            script[own, lang] = script.get((own, lang), 0) + 1
    total = [sum(c[j] for c in counts) + 0.5 * 512 for j in range(len(langs))]
    words_seen = ["Hund", "the", "кот", "x", "Unbekannt", "собака", "a"]
    w = X.Words([" ".join(words_seen)], 512, X.SIZES)
    got = model.scores(w)
    for i, word in enumerate(words_seen):
        own = "cyrillic" if ord(word[0]) > 1000 else "latin"
        logs = [sum(math.log((counts[b][j] + 0.5) / total[j]) for b in gram_buckets(word, X.SIZES, 512)) if script.get((own, lang)) else -math.inf for j, lang in enumerate(langs)]
        best = max(logs)
        assert [float(x) for x in got[i]] == pytest.approx([max(x - best, -X.FLOOR) for x in logs], abs=1e-3)


def test_order_of_texts_does_not_matter(spark):
    """Long and short texts share groups by length; every text keeps its own answer."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = X.train(docs)
    rows = [(r.doc_id, (r.text or "") * (40 if r.doc_id % 17 == 0 else 1)) for r in docs.collect()]
    got = {r.doc_id: r for r in X.predict(spark.createDataFrame(rows, "doc_id long, text string"), model, spans=True).collect()}
    for i, t in rows:
        langs, share, spans = X._label(model, [t], X.SWITCH, True)
        assert (got[i].lang_pred, got[i].score) == (langs[0], pytest.approx(share[0])) and [s.asDict() for s in got[i].spans] == spans[0]
