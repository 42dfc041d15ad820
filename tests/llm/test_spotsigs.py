import hashlib

import pytest

from millrace.llm import spotsigs
from millrace.llm.queries import queries
from millrace.llm.shared import table

SF = "/root/testdata/sf0.001"


def signature_set(fingerprint):
    return {fingerprint[i : i + 16] for i in range(0, len(fingerprint), 16)}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def compare(rows, texts):
    """Edits and likenesses from the texts and fingerprints; ids differ and are no nulls."""
    got = {r["doc_id"]: r for r in rows}
    assert set(got) == set(texts)
    order = sorted(texts)
    for d, following in zip(order, order[1:] + order[:1]):
        text, after, r = texts[d] or "", texts[following] or "", got[d]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        own = signature_set(r["fingerprint"])
        assert r["near_edited"] == pytest.approx(jaccard(own, signature_set(r["edited_fingerprint"])))
        assert r["near_next"] == pytest.approx(jaccard(own, signature_set(got[following]["fingerprint"])))


def test_query_against_brute_force(spark):
    rows = queries()["op7_spotsigs"](spark, SF).collect()
    compare(rows, {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()})
    long = [r for r in rows if r["n_chars"] > 500]
    assert sum(r["near_edited"] > 0.35 and r["near_next"] < 0.2 for r in long) >= 0.95 * len(long)


def chains(text):
    """Signatures as tuples of words."""
    import re

    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    at = [i for i, w in enumerate(words) if w not in spotsigs.ANCHORS]
    out = set()
    for k, p in enumerate(at):
        rest = tuple(words[q] for q in at[k : k + 3])
        if p > 0 and (k == 0 or at[k - 1] < p - 1):
            out.add((words[p - 1], *rest))
        elif p == k if k < 8 else p - at[k - 8] == 8:
            out.add(("", *rest))
    return out


def test_sets_have_as_many_chains_as_the_definition(docs_of, words):
    texts = [words(300, i) for i in range(5)] + ["one two three", "the cat and the dog sat on a mat", " ".join(f"w{i}" for i in range(40)), "x | y | the z"]
    rows = spotsigs.compare_edits(docs_of(texts)).collect()
    for r in rows:
        assert len(signature_set(r["fingerprint"])) == len(chains(texts[r["doc_id"]]))


def test_odd_texts(docs_of, words):
    texts = [None, "", "a", "to be or not to be", "!!!", "ÄÖ ß", words(20_000, 1), "same text of the day", "same text of the day", "  ", "x" * 3000]
    rows = spotsigs.compare_edits(docs_of(texts)).collect()
    compare(rows, dict(enumerate(texts)))
    by = {r["doc_id"]: r for r in rows}
    assert by[7]["fingerprint"] == by[8]["fingerprint"] != "" and by[7]["near_next"] == 1.0
    assert by[0]["fingerprint"] == "" and by[0]["near_next"] == 1.0 and by[1]["near_next"] == 0.0


def test_edges(docs_of, words):
    assert spotsigs.compare_edits(docs_of([])).collect() == []
    lone = spotsigs.compare_edits(docs_of([(4, words(80, 1), "a")])).collect()
    assert lone[0]["near_next"] == 1.0
    rows = [(2, words(80, 1), "a"), (2, words(80, 2), "a"), (None, words(80, 3), None), (9, words(80, 4), "a")]
    got = spotsigs.compare_edits(docs_of(rows)).collect()
    assert len(got) == 4
    by_text = {hashlib.sha256(t.encode()).hexdigest() for _, t, _ in rows}
    first = min(words(80, 1), words(80, 2))
    lone = next(r for r in got if r["doc_id"] is None)
    text = rows[2][1]
    edited = text[: len(text) - len(text) // 4] + first[: len(text) // 4]
    assert lone["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() not in by_text
    assert len(spotsigs.compare_edits(docs_of([(None, "a b c", None)])).collect()) == 1


def test_near_duplicates_against_all_pairs(docs_of, words):
    base = [words(200, i) for i in range(12)]
    texts = [*base, *(b.replace("w1", "v1", 1) for b in base[:6]), *base[:3], *(words(150, i) + " " + words(60, 50) for i in range(4)), None, ""]
    docs = docs_of(texts)
    sets = {r["doc_id"]: signature_set(r["fingerprint"]) for r in spotsigs.compare_edits(docs).collect()}
    membership, pairs = spotsigs.similar_classes(docs, 0.8)
    member = {r["doc_id"]: r["class_id"] for r in membership.collect()}
    assert all(member[d] == min(e for e in sets if sets[e] == sets[d]) for d in sets)
    classes = sorted(set(member.values()))
    want = {(a, b) for a in classes for b in classes if a < b and sets[a] and sets[b] and jaccard(sets[a], sets[b]) >= 0.8}
    assert {(r["a"], r["b"]) for r in pairs.collect()} == want and want
    component = {r["doc_id"]: r["component_id"] for r in spotsigs.near_duplicates(docs, 0.8).collect()}
    assert component[12] == component[0] == 0 and component[7] == 7


def test_no_python_in_the_plan(spark):
    plan = queries()["op7_spotsigs"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
