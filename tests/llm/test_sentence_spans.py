import random

from millrace.llm import sentence_spans
from millrace.llm.queries import queries
from millrace.llm.sentence_spans import sentences, spans
from millrace.llm.shared import table

SF = "/root/testdata/sf0.01"


def brute_force(texts):
    """(pieces, pieces removed, text left) in order of id."""
    first, gone = {}, {d: set() for d in texts}
    for d in sorted(texts):
        for at, n, normal in spans(sentences(texts[d] or "")):
            if first.setdefault(normal, (d, at)) != (d, at):
                gone[d] |= set(range(at, at + n))
    out = {}
    for d, t in texts.items():
        pieces = sentences(t or "")
        out[d] = (len(pieces), len(gone[d]), "".join(p for i, p in enumerate(pieces) if i not in gone[d]))
    return out


def compare(rows, texts):
    assert {r["doc_id"]: (r["n_sentences"], r["n_removed"], r["text"]) for r in rows} == brute_force(texts)


def test_query_against_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    compare(queries()["op6_sentence_spans"](spark, SF).collect(), texts)


def test_sentences_join_to_the_text(words):
    for t in ("", " ", "a", "a. b! c?\n\n d", "...", "\n\n", words(500, 1), "no end " * 100, " lead. tail ", "é… ü."):
        assert "".join(sentences(t)) == t


def test_a_repeated_passage_goes_but_for_the_first(docs_of, words):
    passage = words(60, 99, 900)
    texts = [words(80, i) + "\n" + passage + "\n" + words(80, 100 + i) for i in range(12)] + [passage.replace(" ", ", ", 3), words(20, 7)]
    rows = {r["doc_id"]: r["text"] for r in sentence_spans.remove_repeated_spans(docs_of(texts)).collect()}
    assert rows[0] == texts[0] and rows[13] == texts[13]
    for i in range(1, 12):
        assert passage not in rows[i] and rows[i].startswith(words(80, i)) and rows[i].endswith(words(80, 100 + i))


def test_one_long_sentence_is_caught(docs_of, words):
    passage = words(55, 5).replace(".", "")
    texts = [words(40, 1) + "\n" + passage + "\n" + words(40, 2), words(40, 3) + "\n" + passage + "\n" + words(40, 4)]
    rows = {r["doc_id"]: r["text"] for r in sentence_spans.remove_repeated_spans(docs_of(texts)).collect()}
    assert rows[1] == words(40, 3) + "\n" + words(40, 4)


def test_edges(docs_of, words):
    base = words(100, 1)
    texts = [None, "", "short.", "short.", base, base + "\n" + base, "One. " * 300, words(20_000, 8)]
    compare(sentence_spans.remove_repeated_spans(docs_of(texts)).collect(), dict(enumerate(texts)))
    twice = sentence_spans.remove_repeated_spans(docs_of([(1, base, "a"), (1, base, "a"), (None, base, None)])).collect()
    assert sorted(r["text"] for r in twice) == ["", "", base]
    assert sentence_spans.remove_repeated_spans(docs_of([])).collect() == []


def test_a_passage_inside_other_sentences_is_caught(docs_of, words):
    """It begins and ends in the middle of sentences; most of it goes, what surrounds it stays."""
    passage = words(70, 5).replace(".", "")
    before, after = words(30, 1).replace(".", "") + " ", " " + words(30, 2).replace(".", "")
    texts = [words(40, 3) + " " + passage + " " + words(40, 4), before + passage + after]
    rows = {r["doc_id"]: r["text"] for r in sentence_spans.remove_repeated_spans(docs_of(texts)).collect()}
    left = rows[1].split()
    assert len(left) <= 60 + 25 and rows[1].startswith(before.strip()) and rows[1].endswith(after.strip())


def spans_shared(texts):
    return set.intersection(*({normal for _, _, normal in spans(sentences(t))} for t in texts))


def test_every_run_of_50_words_holds_a_whole_span(words):
    """At random places, with and without punctuation, between random words."""
    rng = random.Random(8)
    pool = words(30_000, 11).split()
    bare = [w.strip(".") for w in pool]
    for k in range(4000):
        source, other = (pool, bare)[k % 2], (pool, bare)[k // 2 % 2]
        at = rng.randrange(len(source) - 60)
        passage = source[at : at + 50 + k % 2]
        texts = []
        for _ in range(2):
            start, n, m = rng.randrange(len(other) - 200), rng.randrange(60), rng.randrange(60)
            texts.append(" ".join(other[start : start + n] + passage + other[start + n : start + n + m]))
        assert any(normal in " ".join(passage).lower() for normal in spans_shared(texts)), texts


def test_text_without_blanks_counts_characters():
    rng = random.Random(2)
    signs = ["".join(chr(rng.randrange(0x4E00, 0x9F00)) for _ in range(n)) for n in (60, 90, 80, 70, 50)]
    texts = [signs[1] + signs[0] + signs[2], signs[3] + signs[0] + signs[4]]
    assert spans_shared(texts) and ["".join(sentences(t)) for t in texts] == texts
