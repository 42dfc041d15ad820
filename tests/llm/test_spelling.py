import random
import re
import zlib
from collections import Counter

import pytest

from millrace.llm import spelling
from millrace.llm.queries import queries
from millrace.llm.shared import table

SF = "/root/testdata/sf0.001"


def edits(word, letters):
    for i in range(len(word) + 1):
        yield from (word[:i] + c + word[i:] for c in letters)
        if i < len(word):
            yield word[:i] + word[i + 1 :]
            yield from (word[:i] + c + word[i + 1 :] for c in letters)


def near_of(words):
    """{word: set of words one edit away}, by trying every edit."""
    letters = sorted(set("".join(words)))
    return {w: (set(edits(w, letters)) & set(words)) - {w} for w in words}


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = near_of(counts)
    forms = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best and counts[best] >= 5 * n else None

    def root(w):
        return root(forms[w]) if forms[w] else w

    return sorted((w, n, len(near[w]), forms[w], forms[w] and counts[forms[w]], root(w)) for w, n in counts.items())


def result(df):
    assert df.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    return sorted(map(tuple, df.collect()))


def test_query_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    want = brute(docs)
    assert any(r[3] for r in want)
    assert result(queries()["op13_spelling"](spark, SF)) == want


def dense(n, seed, letters="abé÷", low=5, high=9):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(low, high))) for _ in range(n)]


@pytest.mark.parametrize("shard_rows", [1 << 17, 300, 20])
def test_all_pairs_of_a_dense_vocabulary(spark, shard_rows):
    words = sorted({w for w in dense(1500, 1) if len(w) >= 6} | {"aaaaaaa" + c * k for c in "ab" for k in range(9)} | {"x" * 3000, "x" * 2999})
    found = spelling.near_words(spark.createDataFrame([(w, 1) for w in words], "word string, n long"), shard_rows)
    got = {}
    for r in found.collect():
        got.setdefault(r["word"], []).append(r["near"])
    want = {w: sorted(v) for w, v in near_of([w for w in words if len(w) < 50]).items() if v}
    want |= {"x" * 3000: ["x" * 2999], "x" * 2999: ["x" * 3000]}
    assert {w: sorted(v) for w, v in got.items()} == want


def test_odd_texts_chains_and_ties(docs_of):
    chain = "wonders " * 900 + "wonder " * 150 + "wander " * 25 + "wandar " * 5
    ties = "kitten " * 5 + "mitten " * 25 + "bitten " * 25 + "Smitten " * 30
    rows = [
        (1, chain, "s"), (2, ties, "s"), (2, ties, "t"), (3, None, "s"), (4, "", "s"), (None, "orphan " * 6, None),
        (5, "ÆtherÀx Éclairs éclairs éclairs éclairs éclairs éclairs tail×÷ÿtail " * 7, "s"), (6, "abc.def_1 " * 9, "s"),
        (7, "z" * 1_500_000 + " " + "lengthy words " * 150_000, "s"), *((i, "same text again and again repeated", "s") for i in range(100, 130)),
    ]
    want = brute([r[:2] for r in rows])
    assert {r[0]: r[5] for r in want}["wandar"] == "wonders"
    assert result(spelling.variants(docs_of(rows))) == want


def test_empty_table(docs_of):
    assert spelling.variants(docs_of(["x"]).where("false")).count() == 0
    assert spelling.variants(docs_of(["short words"])).count() == 0


def test_a_hot_half_is_dealt_to_several_shards(spark):
    words = [f"common{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    rows = spelling.dealt(spark.createDataFrame([(w, 1) for w in words], "word string, n long"), 30).collect()
    held = Counter(r["shard"] for r in rows if r["held"])
    assert max(held.values()) < 100 and len(rows) < 12 * len(words)
