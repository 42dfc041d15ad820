import hashlib
import re

from millrace.llm import exact_dedup
from millrace.llm.queries import queries
from millrace.llm.shared import table

SF = "/root/testdata/sf0.001"


def brute(rows):
    """What the query returns, sorted, from (doc_id, text) pairs."""
    groups = {}
    for doc_id, text in rows:
        digest = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()
        groups.setdefault(digest, []).append(doc_id)
    out = []
    for digest, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i))
        out += [(i, ids[0], len(ids), k == 0, digest) for k, i in enumerate(ids)]
    return sorted(out, key=repr)


def result(df):
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted(map(tuple, df.collect()), key=repr)


def test_query_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    assert result(queries()["op12_exact_dedup"](spark, SF)) == brute(docs)


ODD = [
    (7, "a  b\tc", "s"), (3, "a b c", "s"), (3, "a\x0bb\x0c\rc", "s"), (9, " a b c", "s"), (1, "a b c ", "s"),
    (None, None, None), (5, "", "s"), (6, None, "s"), (None, "only without id", "s"), (None, "only without id", "t"),
    (11, "long " * 200_000, "s"), (12, "long  " * 200_000, "s"), (13, "a b c", "s"), (14, "A b c", "s"),
]


def test_nulls_ties_blanks_and_long_texts(docs_of):
    assert result(exact_dedup.exact_duplicates(docs_of(ODD))) == brute([r[:2] for r in ODD])


def test_empty_table(docs_of):
    assert exact_dedup.exact_duplicates(docs_of(["x"]).where("false")).count() == 0
    assert exact_dedup.without_copies(docs_of(["x"]).where("false")).count() == 0


def test_hot_text_and_filter_without_broadcast(docs_of, words, monkeypatch):
    rows = ["the same"] * 400 + [words(12, i) for i in range(800)] + [words(12, i) for i in range(0, 800, 3)]
    docs = docs_of(rows)
    want = brute(list(enumerate(rows)))
    assert result(exact_dedup.exact_duplicates(docs)) == want
    monkeypatch.setattr(exact_dedup, "MOST_WORDS", 0)
    assert result(exact_dedup.exact_duplicates(docs)) == want


def test_filter_holds_every_repeat_and_little_else(spark):
    rows = spark.range(60_000).selectExpr("id as doc_id", "cast(id % 55000 as string) as text")
    hashed = exact_dedup.hashed(rows)
    words = exact_dedup.words_for(60_000)
    judged = exact_dedup.with_repeats(hashed, exact_dedup.twice_set(hashed, words), words)
    found = {r[0] for r in judged.where("may_repeat").select("doc_id").collect()}
    repeated = {i for i in range(60_000) if i < 5_000 or i >= 55_000}
    assert repeated <= found and len(found) < 1.2 * len(repeated)


def test_rows_that_stay(docs_of):
    stays = exact_dedup.without_copies(docs_of(ODD))
    assert stays.columns == docs_of(ODD).columns
    kept = {r["doc_id"] for r in stays.collect() if r["doc_id"] is not None}
    assert kept == {r[1] for r in brute([r[:2] for r in ODD]) if r[1] is not None}


def test_no_python_on_the_way(spark):
    plan = queries()["op12_exact_dedup"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
