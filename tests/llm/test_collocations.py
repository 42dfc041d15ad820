import random
import re
import tracemalloc
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import collocations as module
from millrace.llm.collocations import BLOCK, blocks, collocations, packed, tokens, unpacked
from millrace.llm.fm_index import Bidirectional, bwt_of, shallow_order


def brute(rows, least, percent=100, top=2000):
    """The result's rows from (text, lang) pairs, by counting every phrase."""
    counts, sizes = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for d in range(1, 6):
                counts[lang].update(tuple(words[i : i + d]) for i in range(len(words) - d + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in candidates.items():
            for d in range(2, len(p)):
                for i in range(len(p) - d + 1):
                    inside[p[i : i + d]] = max(inside[p[i : i + d]], a)
        rows = []
        for p, a in candidates.items():
            if p in inside and 100 * inside[p] >= percent * a:
                continue
            cut = min((1000 * a * sizes[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-cut[0], -a, " ".join(p).encode(), cut))
        for rank, (score, a, phrase, cut) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, cut[2], cut[3], sizes[lang], -score))
    return sorted(out)


def prose(n, seed, vocabulary=12):
    rng = random.Random(seed)
    return "".join(f"{rng.choice('aBcdé')}{rng.randrange(vocabulary)}" + rng.choice(["", "", "", "", ".", ",\t", "\n", "\r\x0b"]) + " " for _ in range(n))


def frame(spark, rows):
    full = [(i, t, lang, "x", "y") for i, (t, lang) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, word string, shard string")


ROWS = [
    (prose(900, 1), "en"), (prose(900, 2), "en"), (prose(700, 3), "de"), (prose(500, 4), None), (None, "en"), ("", None),
    ("of the of the of the of the " * 60, "fr"), ("no marks at all in here " * 200, "fr"), (" \t . , ;;!?", "en"),
    ("ÀB ab\x85c \xa0x y\x00z " * 50, "es"), (prose(900, 1), "en"),
]


@pytest.mark.parametrize("shard_words", [1 << 21, 300, 7])
def test_against_brute_force(spark, shard_words):
    got = sorted(map(tuple, collocations(frame(spark, ROWS).repartition(3), least=6, shard_words=shard_words).collect()))
    assert got == brute(ROWS, 6)


def test_other_parameters_and_ties(spark):
    got = sorted(map(tuple, collocations(frame(spark, ROWS), least=4, percent=60, top=25).collect()))
    assert got == brute(ROWS, 4, 60, 25)


def test_empty_table_and_nothing_frequent(spark):
    assert collocations(frame(spark, ROWS).where("false")).count() == 0
    assert collocations(frame(spark, [("a b c", "en")])).count() == 0
    assert collocations(frame(spark, [("a. b. c. " * 200, "en")])).count() == 0


def test_very_long_text_without_marks(spark):
    text = "x " + "alpha beta gamma delta " * 100_000
    rows = [(text, "en"), ("y" * 3_000_000, "en")]
    got = sorted(map(tuple, collocations(frame(spark, rows), shard_words=50_000).collect()))
    assert got == brute(rows, 100)


def test_blocks_lose_nothing_and_cut_no_word():
    text = prose(300_000, 9).encode()
    parts = list(blocks(text))
    assert len(parts) > 1 and b"".join(parts) == text and max(map(len, parts)) < BLOCK + 100
    assert sum(map(tokens, parts), []) == tokens(text)


def test_packing_of_symbols():
    symbols = np.random.default_rng(1).integers(0, 1 << 31, 1001)
    assert (unpacked(packed(symbols), 1001) == symbols).all()
    assert len(unpacked(packed(symbols[:0]), 0)) == 0


@pytest.mark.parametrize("sides", ["lllll", "rrrrr", "lrlrl", "rllrr"])
def test_both_intervals_of_every_phrase(sides):
    text = np.concatenate([[0], np.random.default_rng(3).integers(0, 7, 4000), [0]])
    (left, order), (right, reverse) = bwt_of(text, 6), bwt_of(text[::-1], 6)
    phrases, index = Bidirectional(left, right).words(), Bidirectional(left, right)
    for length, side in enumerate(sides, 1):
        want = Counter(tuple(text[i : i + length]) for i in range(len(text) - length + 1) if all(text[i : i + length]))
        assert {tuple(s): n for s, n in zip(phrases.symbols.tolist(), phrases.size.tolist())} == want
        for at, to, size, symbols in list(zip(phrases.left, phrases.right, phrases.size, phrases.symbols))[::17]:
            starts = order[at : at + size]
            assert all((text[i : i + length] == symbols).all() for i in starts)
            ends = len(text) - reverse[to : to + size]
            assert sorted(ends - length) == sorted(starts)
        phrases = index.extended(phrases, side == "l")


def test_memory_of_a_shard_and_words_in_a_row(monkeypatch):
    monkeypatch.setattr(module, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    n, rng = 250_000, np.random.default_rng(2)
    langs = ["de", "en", "es", "fr"]
    texts = [" ".join(map(str, rng.zipf(1.3, n) % 40_000)) for _ in langs]
    batch = pa.RecordBatch.from_arrays([pa.array(langs), pa.array(texts)], ["lang", "text"])
    tracemalloc.start()
    rows = list(module._shards([batch], 1 << 21))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 45 * len(langs) * n
    assert max(len(words) for row in rows for words in row.column("words").to_pylist() if words) <= 1 << 14


def test_shallow_order_by_first_symbols():
    text = np.concatenate([[0], np.random.default_rng(5).zipf(1.2, 700_000) % 5000, [0]]).astype(np.int32)
    order, ends = shallow_order(text, 5), np.concatenate([text, np.zeros(5, np.int32)])
    keys = np.stack([ends[order + i] for i in range(5)])
    differ = keys[:, :-1] != keys[:, 1:]
    first, at = differ.argmax(0), np.flatnonzero(differ.any(0))
    assert (np.sort(order) == np.arange(len(text))).all()
    assert (keys[first[at], at] < keys[first[at], at + 1]).all()
