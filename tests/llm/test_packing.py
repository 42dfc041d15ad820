import itertools
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from millrace.llm import packing
from millrace.llm.queries import queries
from millrace.llm.shared import table

SF = "/root/testdata/sf0.001"


def check(pieces, texts):
    """Every id in exactly one piece, sequences without gaps, almost no padding."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for d, t in texts.items()}
    of_doc, of_sequence = {}, {}
    for p in pieces:
        own = ids[p["doc_id"]]
        assert p["doc_tokens"] == len(own) and p["length"] > 0
        assert zlib.crc32(own[p["start"] : p["start"] + p["length"]].tobytes()) == p["ids_crc32"]
        of_doc.setdefault(p["doc_id"], []).append((p["start"], p["length"]))
        of_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for d, own in ids.items():
        at = 0
        for start, length in sorted(of_doc[d]):
            assert start == at
            at += length
        assert at == len(own)
    for parts in of_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048 and at & (at - 1) == 0


def test_query_packs_every_id(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    check(queries()["op2_hilbert_packing"](spark, SF).collect(), texts)


def test_odd_texts(docs_of, words):
    texts = [None, "", " ", "\n", "a  b", " a", "a ", "a\n b", "a \nb", "\t x", "it's we'll 'tis", "x<|endoftext|>y",
             "é à", "x" * 5000, "日本語 テキスト", "a b", "1 22  333", words(9000), words(9000), "a\x0bb c"]
    check(packing.pack(docs_of(texts)).collect(), dict(enumerate(texts)))


def test_empty_table_repeats_and_null_ids(docs_of):
    assert packing.pack(docs_of([])).collect() == []
    rows = packing.pack(docs_of([(1, "a b", "s"), (1, "a b", "s"), (None, "a b", "s")])).collect()
    assert sum(r["length"] for r in rows) == 9


def test_curve_visits_every_cell_through_neighbours():
    cells = np.array(list(itertools.product(range(8), repeat=3)))
    keys = packing.hilbert_keys(cells, 3)
    assert sorted(keys) == list(range(512))
    steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_alike_documents_are_neighbours(spark, docs_of, words):
    """Two kinds of text end up apart on the curve, though they alternate in the table."""
    kinds = [words(300, i, 50) if i % 2 else " ".join(f"ñandú{(i * 7 + k) % 60}" for k in range(300)) for i in range(60)]
    rows = packing.pack(docs_of(kinds).coalesce(1)).collect()
    order = [r["doc_id"] % 2 for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])) if r["start"] == 0]
    assert sum(a != b for a, b in zip(order, order[1:])) <= 6
