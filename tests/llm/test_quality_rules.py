import re
from collections import Counter

from pyspark.sql import functions as F

from millrace.llm import quality_rules
from millrace.llm.queries import queries
from millrace.llm.shared import table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    marked = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(marked)


def compare(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        want = counts(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert r["kept"] == (not r["base_failed"] and r["rule"] is None)


def test_query_against_brute_force(spark):
    compare(queries()["op4_quality_rules"](spark, SF).collect(), {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()})


def labels_of(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_odd_texts(spark, docs_of, words):
    w8 = "a b c d e f g h"
    texts = [None, "", " \n\t ", w8, f"{w8} {w8}", f"{w8} {w8} a", "x " * 40, f"{w8} q {w8} r s {w8}\n{w8}\n\n \n{w8}", "é#*$ \x0b\x0c ü|<>&%",
             words(30_000, 1, 50), "a\nb\na\n a\nb", "tail "]
    labels = labels_of(spark, [(0, None, 0), (None, 1, 0), (9, 1, 0), (9, 0, 1)])
    compare(quality_rules.judge(docs_of(texts), labels).collect(), dict(enumerate(texts)))


def test_empty_tables(spark, docs_of):
    none = labels_of(spark, [])
    assert quality_rules.judge(docs_of([]), none).collect() == []
    assert quality_rules.good_documents(docs_of([]), none).collect() == []


def corpus(words, n=240):
    """Every third text is junk of one of three kinds."""
    rows = []
    for i in range(n):
        text = words(60 + i % 40, i)
        if i % 9 == 0:
            text = text.replace(" ", "### ")
        elif i % 9 == 3:
            text = text.upper() + "!!"
        elif i % 9 == 6:
            text = "\n".join(["same line here"] * 10 + [text])
        rows.append(text)
    return rows


def test_learned_list_holds_on_held_out_rows(spark, docs_of, words):
    texts = corpus(words)
    labels = labels_of(spark, [(i, 0 if i % 3 == 0 else 1, 0) for i in range(len(texts) // 2)])
    rows = quality_rules.judge(docs_of(texts), labels).collect()
    held_out = [r for r in rows if r["doc_id"] >= len(texts) // 2]
    assert sum(r["kept"] == (r["doc_id"] % 3 != 0) for r in held_out) >= 0.97 * len(held_out)
    assert all(r["kept"] for r in held_out if r["doc_id"] % 3)
    assert len({r["rule"] for r in rows if r["rule"]}) >= 2


def test_repeated_rows_and_columns(spark, docs_of, words):
    good = words(50, 3)
    docs = docs_of([(1, good, "s"), (1, good, "s"), (None, good, None), (2, "short", "s")])
    kept = quality_rules.good_documents(docs, labels_of(spark, [(1, 1, 0), (2, 0, 0)]))
    assert kept.schema.simpleString() == docs.schema.simpleString()
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 1]


def test_no_python_in_the_plan(spark, docs_of, words):
    measured = quality_rules.with_measures(docs_of([words(40)]), "measures").select(F.col("measures"))
    plan = measured._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_more_kinds_of_junk_than_any_fixed_number_of_rules(spark):
    """Fourteen kinds, each told from good rows by a band of one measure: a rule is learned for each."""
    kinds = 14
    rows = []
    for i in range(kinds * 120):
        band, bad = i % kinds, i // kinds % 2
        rows.append((i, bad, band + 0.6 * bad))
    flat = spark.createDataFrame(rows, "doc_id long, rejected int, v double")
    m = F.struct(*(F.col("v").alias(f) if f == "chars_per_word" else F.lit(0.0).alias(f) for f in quality_rules.FEATURES))
    learned = quality_rules.learn(flat.select("doc_id", "rejected", m.alias("m")))
    assert len(learned) > 12
