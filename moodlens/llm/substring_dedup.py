"""Substring dedup by recompression.

Recompression replaces, round by round, runs of one symbol and chosen pairs of symbols by new
symbols.  Names are made from content (``words.mix``), so every worker gives equal substrings equal
symbols without a dictionary.  Inside a window of ``window`` words all symbols but a few at its two
ends are the same wherever the window occurs, so the symbol with the smallest name among those
*interior* ones, and a fixed block of words around it, are a function of the window alone.

1. Each chunk of documents parses its words and names the blocks that its windows choose.
2. Blocks meet by name: a window whose block occurs once in the corpus occurs once itself.
3. Windows on repeated blocks are named by 128 bits and meet again: the first place of each stays.
4. Each chunk gets the windows that start earlier elsewhere, and drops the words that they cover.

Only 8-byte names (step 2) and 28-byte windows of repeated blocks (step 3) are shuffled, each name at
most once per chunk: a passage that a third of all documents share costs one row per chunk.  The text
is shuffled once; the three passes read the same exchange.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .bpe import forget

U = np.uint64
BLOCK = 10
PAIR_ROUNDS = 4
LONGEST = 8  # words of a symbol that may still take part in a pair
ROWS_WORDS = 65_536  # words whose windows are chosen together
NO_ID = np.iinfo(np.int64).max
OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def parse(names: np.ndarray, row_off: np.ndarray, window: int, places: np.ndarray):
    """Recompress the words of a chunk.  Returns the start and name of each final symbol and, for the
    window at each of ``places``, the borders of its interior (equal borders: no interior)."""
    n = len(names)
    first = np.zeros(n + 1, bool)
    first[row_off] = True  # a symbol that begins a row merges with none before it
    at, sym = np.arange(n), names.copy()
    lo, hi = places.copy(), places + window
    to_lo, to_hi = np.arange(n + 1), np.arange(n + 1)
    for r in range(1 + PAIR_ROUNDS):
        ends = np.append(at[1:], n)
        size = ends - at
        if r == 0:
            joins = np.zeros(len(at), bool)  # joins its left neighbour
            joins[1:] = (sym[1:] == sym[:-1]) & ~first[at[1:]]
            head = np.flatnonzero(~joins)
            count = np.diff(np.append(head, len(at)))
            run_end = np.repeat(np.append(at[head[1:]], n) if len(head) else head, count)
            # An end symbol of the window may belong to a run that goes on outside.
            to_lo[at], to_hi[ends] = run_end, np.repeat(at[head], count)
            new = np.where(count > 1, W.mix(sym[head] + W.mix(count.astype(U), 50), 51), sym[head])
        else:
            kind = W.mix(sym, 60 + r) >> U(63)
            open_ = size <= LONGEST
            left, right = open_ & (kind == 0), open_ & (kind == 1)
            joins = np.zeros(len(at), bool)
            joins[1:] = right[1:] & left[:-1] & ~first[at[1:]]
            head = np.flatnonzero(~joins)
            # A right symbol at the front, or a left one at the back, may pair with one outside.
            to_lo[at], to_hi[ends] = np.where(right, ends, at), np.where(left, at, ends)
            new = sym[head]
            pair = np.append(joins[1:], False)[head]
            new[pair] = W.mix(new[pair] * U(0xC2B2AE3D27D4EB4F) + W.mix(sym[head[pair] + 1], 52), 53)
        live = lo < hi
        lo, hi = np.where(live, to_lo[lo], lo), np.where(live, to_hi[hi], lo)
        hi = np.maximum(lo, hi)
        at, sym = at[head], new
    return at, sym, lo, hi


def row_groups(row_off: np.ndarray, words: int = ROWS_WORDS):
    """Slices of neighbouring rows of about ``words`` words (one row at least).  A window never reaches over rows, so
    what a chunk makes of its windows can be made group by group, and its arrays stay as small as a group."""
    group = row_off[:-1] // words
    cut = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    yield from zip(cut.tolist(), np.append(cut[1:], len(group)).tolist())


def chosen_blocks(names: np.ndarray, row_off: np.ndarray, window: int):
    """Places of all windows and, for each, the place of the block that it chooses."""
    made = []
    for a, b in row_groups(row_off):
        first = row_off[a]
        places, block = _chosen(names[first : row_off[b]], row_off[a : b + 1] - first, window)
        made.append((places + first, block + first))
    return tuple(np.concatenate(x) for x in zip(*made)) if made else (np.zeros(0, np.int64),) * 2


def _chosen(names: np.ndarray, row_off: np.ndarray, window: int):
    counts = np.maximum(np.diff(row_off) - window + 1, 0)
    total = int(counts.sum())
    places = np.repeat(row_off[:-1] - (np.cumsum(counts) - counts), counts) + np.arange(total)
    if not total:
        return places, places
    at, sym, lo, hi = parse(names, row_off, window, places)
    index = np.zeros(len(names) + 1, np.int64)
    index[at] = np.arange(len(at))
    index[len(names)] = len(at)
    a, b = index[lo], index[hi]
    some = b > a
    order = W.mix(sym, 70)
    best = [np.arange(len(at))]  # best[k][i]: the leftmost smallest of 2**k symbols from i
    while 1 << len(best) <= window:
        x, h = best[-1], 1 << (len(best) - 1)
        if len(x) <= h:
            break
        y = x[h:]
        best.append(np.where(order[x[: len(y)]] <= order[y], x[: len(y)], y))
    pick = np.zeros(total, np.int64)
    level = np.zeros(total, np.int64)
    level[some] = np.frexp((b - a)[some].astype(float))[1] - 1
    for k, x in enumerate(best):
        m = np.flatnonzero(some & (level == k))
        l, r = x[a[m]], x[b[m] - (1 << k)]
        pick[m] = np.where(order[l] <= order[r], l, r)
    size = min(BLOCK, window)
    middle = places + (window - size) // 2
    start = np.clip(at[pick] - size // 2, places, places + window - size) if len(at) else middle
    return places, np.where(some, start, middle)


def _read(table: pa.Table):
    """Rows of a chunk in the order of doc_id (null last), their words, and places within a doc_id."""
    ids = table.column("doc_id").fill_null(NO_ID).to_numpy().astype(np.int64)
    texts = table.column("text").to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i] is not None, texts[i] or ""))
    table, ids = table.take(order), ids[order]
    data, off = W.text_bytes(table.column("text"))
    starts, ends, row_off = W.word_spans(data, off)
    return table, ids, data, starts, ends, row_off


def _places(ids: np.ndarray, row_off: np.ndarray, places: np.ndarray):
    """doc_id and word number of each place; rows of one doc_id count on from one another."""
    row = np.searchsorted(row_off, places, side="right") - 1
    new = np.append(True, ids[1:] != ids[:-1])
    base = row_off[:-1][np.flatnonzero(new)][np.cumsum(new) - 1]
    return ids[row], places - base[row]


def _pack(*arrays: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(x).tobytes() for x in arrays)


def _bucketed(key: np.ndarray, buckets: int):
    """Order by bucket (stable) and each bucket's slice."""
    b = ((key >> U(20)) % U(buckets)).astype(np.int64)
    order = np.argsort(b, kind="stable")
    b = b[order]
    cut = np.flatnonzero(np.append(True, b[1:] != b[:-1])) if len(b) else np.zeros(0, np.int64)
    for s, e in zip(cut, np.append(cut[1:], len(b))):
        yield int(b[s]), order[s:e]


_BLOBS = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("kind", pa.int32()), ("blob", pa.binary())])
_BACK = pa.schema([("chunk", pa.int32()), ("blob", pa.binary())])


def _blobs(rows):
    return pa.Table.from_pylist([dict(zip(_BLOBS.names, r)) for r in rows], _BLOBS)


def _back(rows):
    return pa.Table.from_pylist([dict(zip(_BACK.names, r)) for r in rows], _BACK)


def _join_blobs(table: pa.Table, width: type) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, width) for x in table.column("blob").to_pylist()] or [np.zeros(0, width)])


def _name_blocks(window: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        forget()
        chunk = table.column("chunk")[0].as_py()
        _, _, data, starts, ends, row_off = _read(table)
        names = W.word_names(data, starts, ends)
        _, block = chosen_blocks(names, row_off, window)
        keys = np.unique(W.gram_names(names, min(BLOCK, window))[np.unique(block)])
        return _blobs((b, chunk, 0, _pack(keys[i])) for b, i in _bucketed(keys, buckets))

    return run


def _meet_blocks(table: pa.Table) -> pa.Table:
    """Names that more than one chunk sent go back to those chunks."""
    parts = [np.frombuffer(x, U) for x in table.column("blob").to_pylist()]
    keys = np.concatenate(parts)
    chunk = np.repeat(table.column("chunk").to_numpy(), [len(x) for x in parts])
    order = np.argsort(keys, kind="stable")
    keys, chunk = keys[order], chunk[order]
    same = keys[1:] == keys[:-1]
    twice = np.append(same, False) | np.append(False, same)
    keys, chunk = keys[twice], chunk[twice]
    order = np.argsort(chunk, kind="stable")
    keys, chunk = keys[order], chunk[order]
    cut = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1])) if len(chunk) else np.zeros(0, np.int64)
    return _back((int(chunk[s]), _pack(keys[s:e])) for s, e in zip(cut, np.append(cut[1:], len(chunk))))


def _name_windows(window: int, buckets: int):
    def run(table: pa.Table, back: pa.Table) -> pa.Table:
        if not len(table):
            return _blobs([])
        chunk = table.column("chunk")[0].as_py()
        _, ids, data, starts, ends, row_off = _read(table)
        names = W.word_names(data, starts, ends)
        places, block = chosen_blocks(names, row_off, window)
        if not len(places):
            return _blobs([])
        at, where = np.unique(block, return_inverse=True)
        key = W.gram_names(names, min(BLOCK, window))[at]
        value, times = np.unique(key, return_counts=True)
        repeated = np.isin(key, np.union1d(value[times > 1], _join_blobs(back, U)))
        take = repeated[where]
        p, key = places[take], key[where[take]]
        h1, h2 = W.gram_names(names, window, 1)[p], W.gram_names(names, window, 2)[p]
        order = np.lexsort((p, h2, h1))
        later = np.zeros(len(p), bool)
        later[order[1:]] = (h1[order[1:]] == h1[order[:-1]]) & (h2[order[1:]] == h2[order[:-1]])
        doc, num = _places(ids, row_off, p)
        keep = np.flatnonzero(~later)
        rows = []
        for b, i in _bucketed(key[keep], buckets):
            i = keep[i]
            rows.append((b, chunk, 0, _pack(h1[i], h2[i], doc[i], np.diff(p[i], prepend=0).astype(np.int32), np.diff(num[i], prepend=0).astype(np.int32))))
        if later.any():
            rows.append((chunk % buckets, chunk, 1, _pack(p[later].astype(np.int32))))
        return _blobs(rows)

    return run


def _meet_windows(table: pa.Table) -> pa.Table:
    """Of equal windows the first stays; the places of the others go back to their chunks."""
    out, cols, chunk = [], [[] for _ in range(5)], []
    for c, kind, blob in zip(*(table.column(x).to_pylist() for x in ("chunk", "kind", "blob"))):
        if kind:
            out.append((c, blob))
            continue
        n = len(blob) // 32
        for x, (start, t) in zip(cols, ((0, U), (8, U), (16, np.int64), (24, np.int32), (28, np.int32))):
            x.append(np.frombuffer(blob, t, n, start * n))
        cols[3][-1], cols[4][-1] = np.cumsum(cols[3][-1], dtype=np.int64), np.cumsum(cols[4][-1], dtype=np.int64)
        chunk.append(np.full(n, c))
    if chunk:
        h1, h2, doc, p, num = (np.concatenate(x) for x in cols)
        chunk = np.concatenate(chunk)
        order = np.lexsort((num, doc, h2, h1))
        h1, h2, p, chunk = h1[order], h2[order], p[order], chunk[order]
        later = np.append(False, (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1]))
        p, chunk = p[later], chunk[later]
        order = np.lexsort((p, chunk))
        p, chunk = p[order], chunk[order]
        cut = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1])) if len(chunk) else np.zeros(0, np.int64)
        out += [(int(chunk[s]), _pack(p[s:e].astype(np.int32))) for s, e in zip(cut, np.append(cut[1:], len(chunk)))]
    return _back(out)


def _cut(window: int, with_text: bool, carried: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())])

    def run(table: pa.Table, back: pa.Table) -> pa.Table:
        extra = [f"carried_{i}" for i in range(carried)]
        if not len(table):
            return pa.table({**{f.name: pa.array([], f.type) for f in schema}, **{c: table.column(c) for c in extra}})
        table, _, _, _, _, row_off = _read(table)
        p = _join_blobs(back, np.int32)
        cover = np.zeros(row_off[-1] + 1, np.int32)
        np.add.at(cover, p, 1)
        np.add.at(cover, p + window, -1)
        keep = np.cumsum(cover)[:-1] == 0
        rows = []
        for i, (doc, text) in enumerate(zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist())):
            k = keep[row_off[i] : row_off[i + 1]]
            words = (text or "").encode().split()
            gone = len(k) - int(k.sum())
            kept = b" ".join(compress(words, k) if gone else words)
            shown = (text if not gone else kept.decode()) if with_text else None
            rows.append((doc, len(words), gone, hashlib.sha256(kept).hexdigest(), shown))
        made = [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)]
        return pa.Table.from_arrays([*made, *(table.column(c) for c in extra)], names=[*schema.names, *extra])

    return run


def substring_dedup(docs: DataFrame, window: int = 20, chunk_bytes: int = 4 << 20, with_text: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """Remove every word covered by a run of ``window`` words that also starts earlier: in a smaller doc_id,
    or earlier in the same document.

    Input: ``doc_id``, ``text`` (other columns are ignored, whatever their names).  One row per input row:
    doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space), kept_text (null text
    stays null; a text of which nothing goes stays as it is; null everywhere without ``with_text``), then the
    columns named in ``carry`` as carried_0, carried_1, ... (their names may clash with the result's).

    Null and empty texts have no words (the digest is that of the empty string).  Rows of a null doc_id come
    last in the order.  Rows that repeat a doc_id count as one longer document in the order of their texts,
    but windows never reach over two rows.  An empty table gives an empty table.
    """
    spark = docs.sparkSession
    extra = [F.col(c).alias(f"carried_{i}") for i, c in enumerate(carry)]
    types = [docs.schema[c].dataType.simpleString() for c in carry]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *extra)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(least, -(-total // chunk_bytes))
    texts = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).cast("int")).repartition(chunks, "chunk")
    by_chunk = texts.groupBy("chunk")
    blobs, back = "bucket int, chunk int, kind int, blob binary", "chunk int, blob binary"
    buckets = max(least, -(-total // (4 * chunk_bytes)))
    # A task for each bucket: their number grows with the table, so that a task does not.
    blocks = by_chunk.applyInArrow(_name_blocks(window, buckets), blobs).repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_meet_blocks, back)
    places = by_chunk.cogroup(blocks.groupBy("chunk")).applyInArrow(_name_windows(window, buckets), blobs)
    later = places.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_meet_windows, back)
    made = OUT + "".join(f", carried_{i} {t}" for i, t in enumerate(types))
    return by_chunk.cogroup(later.groupBy("chunk")).applyInArrow(_cut(window, with_text, len(carry)), made)
