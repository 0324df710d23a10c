import re
import time
from collections import Counter

from pyspark.sql import functions as F

from dimload.llm import quality_rules

WHITE = " \t\n\v\f\r"


def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if x.strip(WHITE)]
    return (
        len(words),
        sum(map(len, words)),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(repeated),
    )


def test_measures(rows, odd_docs):
    found = quality_rules.judge(odd_docs).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    want = []
    for i, text, *_ in rows:
        m = plain_measures(text)
        want.append((str(i), *m, m[0] < 50 or 100 * m[4] > 50 * m[0]))
    assert sorted((str(r.doc_id), *[r[n] for n in names], r.base_failed) for r in found) == sorted(want)
    assert not any(r.kept for r in found if r.base_failed)


def lines(*words):
    return "\n".join(words)


def body(i, n=60):
    return " ".join(f"w{i}x{j}" for j in range(n))


def test_lines_of_a_host(spark):
    """A line above the limit goes everywhere in its host but where it stands first; copies
    of one text are one document; another host has counts of its own."""
    shared = " ".join(f"common{j}" for j in range(40))
    data = [(i, lines(shared, body(i)), "a") for i in range(6)]  # 6 texts with the line
    data += [(10, lines("COMMON0  " + shared[8:], body(10, 30)), "a")]  # the same line, most of its words
    data += [(20 + i, lines(shared, body(20)), "b") for i in range(9)]  # one text nine times
    data += [(40, lines(shared, body(40)), None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    found = {r.doc_id: r for r in quality_rules.judge(docs, max_line_docs=3).collect()}
    full = [i for i in (0, 1, 2, 3, 4, 5, 10) if found[i].words_left == found[i].n_words]
    assert len(full) == 1  # the first carrier
    assert all(found[i].n_words - found[i].words_left == 40 for i in (0, 1, 2, 3, 4, 5, 10) if i not in full)
    assert found[10].kept == (10 in full) and all(found[i].kept for i in range(6))
    assert all(found[i].words_left == found[i].n_words and found[i].kept for i in (*range(20, 29), 40))
    cleaned = quality_rules.clean_documents(docs.withColumn("n_chars", F.length("text")), max_line_docs=3).collect()
    texts = {r.doc_id: r.text for r in cleaned}
    assert sorted(texts) == sorted(i for i, r in found.items() if r.kept)
    assert sum(shared in texts[i] for i in range(6)) == len([i for i in full if i < 6])
    assert all(r.n_chars == len(r.text) for r in cleaned)


def test_clean_documents_keep_columns(odd_docs, rows):
    cleaned = quality_rules.clean_documents(odd_docs)
    assert cleaned.columns == odd_docs.columns
    kept = [(str(r.doc_id), r.text) for r in cleaned.collect()]
    want = []
    for i, t, *_ in rows:
        m = plain_measures(t)
        if m[0] >= 50 and 100 * m[4] <= 50 * m[0]:
            want.append((str(i), t))
    assert sorted(kept) == sorted(want)  # no line stands in more than ten documents here


def test_no_rows(no_docs):
    assert quality_rules.judge(no_docs).count() == 0
    assert quality_rules.clean_documents(no_docs).count() == 0


def test_no_python(odd_docs):
    for df in (quality_rules.judge(odd_docs), quality_rules.clean_documents(odd_docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_documents_of_very_many_frequent_lines(spark):
    """What a document loses is looked for in short lists, not in all that it loses."""
    shared = [f"a{k} b{k} c{k} d{k} e{k}" for k in range(8000)]
    docs = [(i, lines(*shared, f"own line {i} " + "some more words " * 30), "en", "a", None) for i in range(12)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    began = time.monotonic()
    found = {r.doc_id: (r.words_left, r.kept) for r in quality_rules.judge(df).collect()}
    took = time.monotonic() - began
    left = len(docs[0][1].split("\n")[-1].split())
    assert sorted(w for w, _ in found.values())[:11] == [left] * 11 and took < 60
    assert sum(k for _, k in found.values()) == 1
    (kept,) = quality_rules.clean_documents(df).collect()
    assert len(kept.text.split("\n")) == 8001
    clean = quality_rules.clean_documents(df, min_left=0.0).collect()
    assert sorted(len(r.text.split("\n")) for r in clean) == [1] * 11 + [8001]
