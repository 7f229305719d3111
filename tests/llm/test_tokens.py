import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from moodlens.llm import packing as P
from moodlens.llm.bpe import WordBpe, encode_decode
from moodlens.llm.queries import vocabulary

HARD = [
    None, "", " ", "İstanbul ΣΟΦΟΣ don't it'sound they'LL", "x<|endoftext|>y <|startoftext|>", "\x85\x1c a\xa0b c", "日本語 😀😀 !!!!?? 123 ٣",
    "é ẛ̣ ﬁ ǅ ß ẞ", "a" * 3000, "!" * 500, "aaaa bbbbb  x", "é" * 40 + " " + "É" * 40,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


def _texts():
    rnd = random.Random(1)
    return HARD + ["".join(rnd.choice("abcdeéüñ'sthTH日！ 😀\n1") for _ in range(150)) for _ in range(150)]


def test_encoder_equals_library(library):
    bpe = WordBpe(vocabulary())
    for text, raw in zip(_texts(), bpe.encode_all(_texts())):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(raw, "<u4").tolist() == ids
        assert bpe.decode(raw) == library.decode(ids, skip_special_tokens=False)


def test_long_texts_are_split_at_blanks(library, monkeypatch):
    import moodlens.llm.bpe as B

    monkeypatch.setattr(B, "PIECE", 7)
    text = "one two  three\n\nfour-five six'll 77 " * 5
    assert np.frombuffer(WordBpe(vocabulary()).encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_query_on_whole_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = encode_decode(docs, vocabulary()).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        assert (r.n_tokens, r.ids_sha256, bytes(r.ids)) == (len(ids), hashlib.sha256(raw).hexdigest(), raw)
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest() and r.decoded == library.decode(ids, skip_special_tokens=False)


def test_encode_odd_rows(table, odd_rows):
    rows = encode_decode(table(odd_rows), vocabulary()).collect()
    assert len(rows) == len(odd_rows)
    assert all(r.n_tokens == 0 and r.decoded == "" for r in rows if r.doc_id in (1, 2, 3))
    assert encode_decode(table(odd_rows).limit(0), vocabulary()).count() == 0


def test_cut_sizes():
    counts = P.class_counts(2048)
    sizes = [2048 // k for k in counts]
    assert sizes[-1] == 1 and all(2048 - k * (2048 // k) <= 4 for k in counts)
    for n in [1, 2, 5, 100, 1100, 2047, 2048, 2049, 9999]:
        pieces = P.cut(n, sizes)
        assert sum(pieces) == n and set(pieces) <= set(sizes)
        assert len(pieces) <= n // 2048 + 6


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing_whole_table(spark, library, capacity):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3, "doc_id")
    ids = {r.doc_id: library.encode(r.text, add_special_tokens=False).ids + [1] for r in docs.collect()}
    rows = P.pack(docs, vocabulary(), capacity, with_ids=True).cache()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows.collect():
        raw = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
        assert (r.ids_crc32, r.doc_tokens, bytes(r.ids)) == (zlib.crc32(raw), len(ids[r.doc_id]), raw)
        by_doc[r.doc_id].append((r.start, r.length))
        by_seq[r.sequence_id].append((r.offset, r.length))
    assert by_doc.keys() == ids.keys()
    for spans, end in [*((s, len(ids[d])) for d, s in by_doc.items()), *((s, None) for s in by_seq.values())]:
        at = 0
        for a, n in sorted(spans):
            assert a == at and n > 0
            at += n
        assert at == end if end else at <= capacity
    used = [sum(n for _, n in s) for s in by_seq.values()]
    padding = sum(capacity - n for n in used if n & (n - 1))
    assert padding <= capacity + 0.01 * sum(used)
    packed = {r.sequence_id: r for r in P.sequences(rows, capacity).collect()}
    assert all(len(r.ids) == (capacity if r.n_ids & (r.n_ids - 1) else r.n_ids) for r in packed.values())
    assert sum(r.n_ids for r in packed.values()) == sum(map(len, ids.values()))


def test_packing_odd_rows(table, odd_rows):
    rows = P.pack(table(odd_rows), vocabulary()).collect()
    assert sum(r.length for r in rows if r.doc_id in (1, 2, 3)) == 3
    assert sum(r.length for r in rows if r.doc_id == 4) == 8
    assert sum(r.length for r in rows if r.doc_id is None) == 5
    assert P.pack(table(odd_rows).limit(0), vocabulary()).count() == 0
