import hashlib
import random
from collections import Counter

import numpy as np

from millrace.llm import suffix_dedup
from millrace.llm.queries import queries
from millrace.llm.shared import table

SF = "/root/testdata/sf0.01"
LENGTH = suffix_dedup.LENGTH


def brute_force(texts):
    """(kept, removed, runs) for each text, from a table of all strings of LENGTH bytes."""
    count = Counter(t[i : i + LENGTH] for t in texts for i in range(len(t) - LENGTH + 1))
    out = []
    for t in texts:
        marks = np.zeros(len(t) + 1, np.int64)
        for i in range(len(t) - LENGTH + 1):
            if count[t[i : i + LENGTH]] > 1:
                marks[i] += 1
                marks[i + LENGTH] -= 1
        gone = np.cumsum(marks)[:-1] > 0
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((np.frombuffer(t, np.uint8)[~gone].tobytes(), int(gone.sum()), runs))
    return out


def compare(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        kept, removed, runs = texts[r["doc_id"]]
        assert (bytes(r["kept"]), r["n_removed"], r["n_spans"]) == (kept, removed, runs)


def test_query_against_brute_force(spark):
    texts = {r["doc_id"]: r["text"].encode() for r in table(spark, SF, "documents").collect()}
    want = dict(zip(texts, brute_force(list(texts.values()))))
    rows = queries()["op10_suffix_dedup"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        kept, removed, runs = want[r["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(texts[r["doc_id"]]), removed, runs)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def odd_texts():
    rng = random.Random(1)
    base = "".join(rng.choice("abcdé") for _ in range(2500))
    texts = ["", base[:1500], base[700:1200] + "x" * 300, "y" * 100 + base[1000:1900], "a" * 1500, "a" * 400, "ab" * 300 + base[1600:2050],
             base[1640:2045], base[100:330], base[200:1100] + base[200:700], "q" * 399, "q" * 399, base[50:420]]
    for _ in range(20):
        cuts = [(rng.randrange(2400), rng.randrange(50, 900)) for _ in range(rng.randrange(4))]
        texts.append("".join(base[a : a + n] + "z" * rng.randrange(500) for a, n in cuts))
    return texts


def test_odd_texts(docs_of):
    texts = odd_texts()
    want = dict(enumerate(brute_force([t.encode() for t in texts])))
    compare(suffix_dedup.remove_repeats(docs_of(texts)).collect(), want)


def test_hot_blocks_and_long_texts_give_the_same(docs_of, monkeypatch):
    """Blocks through hashed windows, buckets and steps as small as they go."""
    texts = odd_texts()
    want = dict(enumerate(brute_force([t.encode() for t in texts])))
    monkeypatch.setattr(suffix_dedup, "HOT", 3)
    monkeypatch.setattr(suffix_dedup, "BUCKET", 500)
    compare(suffix_dedup.remove_repeats(docs_of(texts)).collect(), want)


def test_steps_cover_every_window(monkeypatch):
    text = np.frombuffer(odd_texts()[1].encode() * 3, np.uint8)
    monkeypatch.setattr(suffix_dedup, "STEP", 700)
    suffix_dedup._tables.cache_clear()
    _, at, first, last = suffix_dedup.cover_sample(text)
    covered = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)])
    assert sorted(covered) == list(range(len(text) - LENGTH + 1))
    assert all(a <= p <= b + LENGTH - suffix_dedup.GRAM for p, a, b in zip(at, first, last))
    suffix_dedup._tables.cache_clear()


def test_edges(docs_of, words):
    long = words(300, 1)
    rows = [(1, None, "a"), (2, "", "a"), (3, long, "a"), (3, long, "a"), (None, words(200, 2), None)]
    got = suffix_dedup.remove_repeats(docs_of(rows)).collect()
    assert sorted(((r["doc_id"] or 0), r["n_bytes"], r["n_removed"]) for r in got) == sorted(
        [(1, 0, 0), (2, 0, 0), (3, len(long), len(long)), (3, len(long), len(long)), (0, len(rows[4][1]), 0)]
    )
    assert suffix_dedup.remove_repeats(docs_of([])).collect() == []


def test_a_context_of_many_places_is_settled_in_parts(monkeypatch):
    """Whatever the parts, the same places are found, and no part holds more than its bound and one context's windows."""
    import random

    import numpy as np
    import pyarrow as pa

    from millrace.llm import suffix_dedup as S

    rng = random.Random(5)
    text = bytes(rng.randrange(97, 123) for _ in range(S.LENGTH + 60))
    columns = {
        "context": pa.array([text, text[7:] + b"zz", bytes(reversed(text))], pa.binary()),
        "key": pa.array([1, 2, 3], pa.int64()),
        "firsts": pa.array([np.arange(0, 500_000, 1000, "<i4").tobytes(), np.array([5], "<i4").tobytes(), np.array([0], "<i4").tobytes()]),
    }
    batch = pa.RecordBatch.from_pydict(columns)

    def found(most):
        monkeypatch.setattr(S, "MOST_RECORDS", most)
        places, onward = set(), {}
        for out in S._window_records(3)(iter([batch])):
            for bucket, records in zip(*(c.to_pylist() for c in out.columns)):
                if bucket < 0:
                    places |= {tuple(p) for p in np.frombuffer(records, "<i8").reshape(-1, 2)}
                else:
                    for r in np.frombuffer(records, S._RECORD):
                        onward.setdefault((r["h"], r["g"]), []).append((r["key"], r["start"]))
        # What meets again later counts as found there.
        for met in onward.values():
            if len(met) > 1:
                places |= {p for p in met if p != (-1, -1)}
        return {(int(k), int(s)) for k, s in places}

    whole = found(10**9)
    assert len(whole) > 20_000 and whole == found(5_000) == found(1)
