import math
import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimload.llm import language_id
from dimload.llm.common import WordIndex
from dimload.llm.language_id import BEGIN, END, CharacterModel, LanguageModels

from corpus_data import prose

TONGUES = {
    "aa": ("ba", "ke", "mi", "lo", "tu", "ran", "sel", "dor"),
    "bb": ("zu", "che", "ügt", "schi", "ein", "pf", "wor", "ä"),
    "cc": ("où", "que", "ion", "eau", "ré", "é", "il", "ent"),
}


def plain_probability(counts, order, word):
    """Interpolated Kneser-Ney by its definition, over dictionaries of strings."""
    levels = {order: dict(counts)}
    for n in range(order - 1, 0, -1):
        levels[n] = {}
        for g in {g[1:] for g in levels[n + 1]}:
            before = [h for h in levels[n + 1] if h[1:] == g]
            levels[n][g] = sum(levels[n + 1][h] for h in before) if g[0] == BEGIN else len(before)
    discount = {}
    for n, c in levels.items():
        one, two = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        discount[n] = one / (one + 2 * two) if one and two else 0.5

    def p(gram):
        n = len(gram)
        if not n:
            return 1 / (len(levels[1]) + 1)
        follow = [v for g, v in levels[n].items() if g[:-1] == gram[:-1]]
        if not follow:
            return p(gram[1:])
        d = discount[n]
        return max(levels[n].get(gram, 0) - d, 0) / sum(follow) + d * len(follow) / sum(follow) * p(gram[1:])

    padded = BEGIN * (order - 1) + word + END
    return sum(math.log(p(padded[i - order + 1 : i + 1])) for i in range(order - 1, len(padded)))


def test_kneser_ney():
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abc") for _ in range(rnd.randint(1, 5))) for _ in range(60)]
    counts = Counter()
    for w in words:
        padded = BEGIN * 3 + w + END
        counts.update(padded[i : i + 4] for i in range(len(padded) - 3))
    other = Counter({"\x02\x02\x02a": 3, "\x02\x02az": 2, "\x02az\x03": 1, "abcz": 2})
    one, two = CharacterModel.fit(dict(counts), 4), CharacterModel.fit(dict(other), 4)
    models = LanguageModels(4, ["x", "y"], [one, two], [math.inf] * 2)
    tried = ["abc", "a", "zz", "cabz", "bbbbbbb", "aab"]
    got = models.word_scores([w.encode() for w in tried])
    for w, (score, second, n) in zip(tried, got):
        assert n == len(w) + 1 and score == pytest.approx(plain_probability(counts, 4, w))
        assert second == pytest.approx(plain_probability(other, 4, w))
    # Probabilities of what may follow a history add up to one, the unseen character included.
    total = sum(math.exp(one.log_probabilities(*hashed(h))[-1]) for h in ("\x02ab" + c for c in "abc\x03?"))
    assert total == pytest.approx(1, abs=1e-9)


@pytest.mark.parametrize("pad", [0, 3])
def test_letter_runs(pad):
    tokens = ["It's", "12", "", "é\u0301x", "\u0301ab", "中文-ÄÖ", "\u0301", "a1b2"]
    codes, lengths, owner = language_id.letter_runs([t.encode() for t in tokens], pad)
    text = "".join(map(chr, codes.tolist()))
    ends = np.cumsum(lengths)
    runs = [text[e - n : e] for e, n in zip(ends, lengths)]
    want = [(0, "it"), (0, "s"), (3, "é\u0301x"), (4, "ab"), (5, "中文"), (5, "äö"), (7, "a"), (7, "b")]
    assert list(zip(owner.tolist(), runs)) == [(i, BEGIN * pad + w + END) for i, w in want]


def hashed(text):
    hashes = language_id._hashes(language_id._codes(text), 4)
    return hashes, [np.concatenate([h[:1], h[:-1]]) for h in hashes]


@pytest.fixture(scope="module")
def tongues(spark):
    data = [(i, prose(i, 80, TONGUES[t]), t) for i, t in enumerate([*TONGUES] * 60)]
    return spark.createDataFrame(data, "doc_id long, text string, lang string")


def test_held_out_accuracy_and_rejection(spark, tongues):
    learned = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4) != 2
    models = language_id.train(tongues.where(learned))
    assert models.languages == sorted(TONGUES) and all(map(math.isfinite, models.highest))
    found = language_id.identify(tongues.where(~learned), models).collect()
    assert len(found) > 20
    assert sum(r.language.lang_pred == r.lang for r in found) >= 0.95 * len(found)
    assert all(r.language.accepted and 0 <= r.language.score <= 1 for r in found)
    noise = "".join(random.Random(1).choice("qxjvw ") for _ in range(2000))
    odd = [(1, None), (2, ""), (3, "12 34 !!"), (4, noise), (5, "KEMILO RANSEL dortu " * 20_000), (6, "ke"), (6, "ke")]
    odd = spark.createDataFrame(odd, "doc_id long, text string").withColumn("language", F.lit("taken"))
    rows = {r.doc_id: r.language for r in language_id.identify(odd, models).collect()}
    for i in (1, 2, 3):
        assert (rows[i].lang_pred, rows[i].score, rows[i].accepted) == ("und", 0.0, False)
    assert rows[4].lang_pred in TONGUES and not rows[4].accepted
    assert rows[5].lang_pred == rows[6].lang_pred == "aa" and rows[5].accepted
    kept = language_id.in_a_language(odd, models)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [5, 6, 6]


def test_nothing_to_learn_from(spark, odd_docs, no_docs):
    models = language_id.train(no_docs)
    assert {r.language.lang_pred for r in language_id.identify(odd_docs, models).collect()} == {"und"}
    models = language_id.train(odd_docs)
    assert language_id.identify(no_docs, models).count() == 0
    found = language_id.identify(odd_docs, models).collect()
    assert {r.language.lang_pred for r in found} <= {"en", "de", "und"}


def test_cache_does_not_change_scores(tongues, monkeypatch):
    models = language_id.train(tongues)
    texts = [r.text.encode() for r in tongues.collect()]
    whole = np.concatenate(list(models.entropies([texts])))
    monkeypatch.setattr(language_id, "CACHE_WORDS", 5)
    monkeypatch.setattr(language_id, "CHUNK", 700)
    assert np.allclose(whole, np.concatenate(list(models.entropies(texts[i : i + 7] for i in range(0, len(texts), 7)))))


def test_every_n_gram_counts(spark):
    """A language with more than 200,000 n-grams, most of them rare, as a large script has."""
    rnd = random.Random(7)
    letters = [chr(0x4E00 + i) for i in range(3000)]
    data = [(i, " ".join("".join(rnd.choices(letters, k=8)) for _ in range(300)), "zz") for i in range(150)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    models = language_id.train(docs)
    kept_back = F.pmod(F.xxhash64(F.xxhash64("text"), F.lit("calibrate")), F.lit(5)) == 0
    counts = Counter()
    for r in docs.where(~kept_back).collect():
        for w in r.text.split():
            padded = BEGIN * 4 + w + END
            counts.update(padded[i : i + 5] for i in range(len(padded) - 4))
    assert len(counts) > 250_000 and len(models.grams[5][0]) == len(counts)
    one = LanguageModels(5, ["zz"], [CharacterModel.fit(dict(counts), 5)], [math.inf])
    words = [w.encode() for w in data[0][1].split()[:20]]
    assert np.allclose(models.word_scores(words), one.word_scores(words))


def test_foreign_texts_in_the_same_letters(spark, tongues):
    """Long texts in a language that was not learned are rejected, short ones of a learned one are not."""
    other = (*TONGUES["aa"][:-1], "rod")
    data = [(i, prose(900 + i, 400, other), False) for i in range(10)]
    data += [(100 + i, prose(950 + i, 400 if i % 2 else 4, TONGUES["aa"]), True) for i in range(20)]
    found = language_id.identify(spark.createDataFrame(data, "doc_id long, text string, own boolean"), language_id.train(tongues))
    assert [r.doc_id for r in found.collect() if r.language.accepted != r.own] == []


def test_limits():
    rnd = np.random.default_rng(5)
    many = np.stack([rnd.normal(2, 0.1, 1000), np.full(1000, 400.0)], axis=1)
    few = many[:4] + [[0.5, 0]]
    none = np.zeros((0, 2))
    a, b, c = language_id.limits([many, few, none], 0.999, 1.5, 4.0)
    assert a == pytest.approx(np.sort(many[:, 0])[-2:].max() - 0.2 + 1.5 / 1000**0.5, abs=0.1)
    assert b == pytest.approx(few[:, 0].max() - 0.2 + 0.75)
    assert a <= c < math.inf  # of all texts together
    models = LanguageModels(1, ["x"], (), [1.0])
    assert models.decide(np.array([[1.3, 100], [1.3, 1600]]))["accepted"].tolist() == [True, False]


def test_few_texts_set_a_limit(spark):
    """A language whose texts are all learned from accepts no letters that it never saw."""
    kept_back = F.pmod(F.xxhash64(F.xxhash64("text"), F.lit("calibrate")), F.lit(5)) == 0
    data = spark.createDataFrame([(i, prose(i, 60, TONGUES["aa"]), "aa") for i in range(12)], "doc_id long, text string, lang string")
    models = language_id.train(data.where(~kept_back))
    odd = spark.createDataFrame([(1, "qxjvw xwq vjx " * 50), (2, prose(77, 60, TONGUES["aa"]))], "doc_id long, text string")
    assert {r.doc_id: r.language.accepted for r in language_id.identify(odd, models).collect()} == {1: False, 2: True}


def test_copies_count_once(spark):
    """Many copies of a text change neither the models nor the limits."""
    data = [(i, prose(i, 60, TONGUES["aa"]), "aa") for i in range(30)]
    once = spark.createDataFrame(data, "doc_id long, text string, lang string")
    often = spark.createDataFrame(data + [(100 + i, data[i % 3][1], "aa") for i in range(60)], once.schema)
    a, b = language_id.train(once), language_id.train(often)
    assert all(np.array_equal(x, y) for n in range(1, 6) for x, y in zip(a.grams[n] + a.backoff[n], b.grams[n] + b.backoff[n]))
    assert a.highest == b.highest


def test_grams_of_long_texts_in_stretches(spark):
    texts = ["abcd", "abcde", "x" * 999 + "yz", "".join(chr(97 + k % 23) for k in range(5003))]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", language_id._grams(F.col("t"), 4).alias("g"))
    for r in df.collect():
        assert r.g == [r.t[i : i + 4] for i in range(len(r.t) - 3)]


def test_a_run_of_a_million_letters(spark):
    rnd = random.Random(1)
    run = "".join(rnd.choice("abcdefgh") for _ in range(1_000_000))
    docs = spark.createDataFrame([(run, "xx"), *[(prose(k, 60), "yy") for k in range(10)]], "text string, lang string")
    began = time.monotonic()
    found = language_id.identify(docs, language_id.train(docs)).collect()
    assert time.monotonic() - began < 90
    assert {r.lang: r.language.lang_pred for r in found}["yy"] == "yy"


@pytest.mark.parametrize("window", [8, 64, 1 << 20])
def test_words_in_windows(window):
    """Words longer than a window are known alone; each different word is learned once."""
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abé") for _ in range(rnd.choice([1, 3, 9, 60, 200]))).encode() for _ in range(60)]
    texts = [b" ".join(rnd.choices(words, k=rnd.randint(0, 30))) + b" \n" * rnd.randint(0, 2) for _ in range(20)]
    learned = []
    index = WordIndex(learned.extend, learned.clear, 10_000, window)
    for _ in range(2):
        rows, ends = index.rows(texts)
        assert [learned[k] for k in rows.tolist()] == [w for t in texts for w in t.split()]
        assert ends.tolist() == [sum(len(t.split()) for t in texts[: i + 1]) for i in range(len(texts))]
        assert len(learned) == len(set(learned))
