"""Ranked lexical search by the Best Position Algorithm over impact lists.

Each term of an item has a list of (document, impact) in order of falling impact.  The lists are read in
parallel; a document met for the first time is looked up directly in all lists of the item, which gives its
whole score and marks its places in them.  The best position of a list is the end of its unbroken run of seen
places, however they were seen; no unseen document scores above the sum of the impacts there.  Reading stops
when that sum is strictly below the k-th score (so that equal scores are all met) or at the ends of the lists.

Documents are read as chunks of bounded size, each with its own lists, so an index needs no shuffle and no word
is a hot key; a task carries the k-th scores from chunk to chunk.  Impacts use statistics of all documents.
Items come in blocks of bounded size, one at a time.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_TERM = re.compile(TERM)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DEPTH = 16  # places read from each list before the first test; doubled at each further one


def terms(text: str | None) -> list[str]:
    return _TERM.findall((text or "").translate(_LOWER))


class Lists:
    """Impact lists of a chunk of documents, and each document's own places in them."""

    def __init__(self, off: np.ndarray, term: np.ndarray, impact: np.ndarray):
        docs = len(off) - 1
        doc = np.repeat(np.arange(docs), np.diff(off))
        order = np.lexsort((doc, -impact, term))
        self.off, self.term, self.impact = off, term, impact
        self.doc_at, self.impact_at = doc[order], impact[order]  # list order: by term, falling impact
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        self.lists, at = np.unique(term[order], return_index=True)
        self.start, self.end = at, np.append(at[1:], len(order))
        self.seen = np.zeros(len(order), bool)
        self.met = np.zeros(docs, bool)
        self.asked = np.zeros(int(term.max(initial=-1)) + 2, bool)

    def search(self, item: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents, and scores above 0, among them all that belong to the k best and reach ``floor``."""
        i = np.searchsorted(self.lists, item)
        i = i[np.append(self.lists, -1)[i] == item]
        i = i[self.impact_at[self.start[i]] > 0]  # a list without impact adds nothing
        if not len(i):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.asked[self.lists[i]] = True
        start, end = self.start[i], self.end[i]
        best, depth, read = start.copy(), DEPTH, start.copy()
        docs, scores, kept = [], [], np.zeros(0, np.int64)
        while True:
            to = np.minimum(read + depth, end)
            found = np.concatenate([self.doc_at[a:b] for a, b in zip(read, to)])
            new = np.unique(found[~self.met[found]])
            if len(new):
                self.met[new] = True
                # Direct access: every posting of the new documents, those of the item's lists count.
                size = self.off[new + 1] - self.off[new]
                rows = np.repeat(self.off[new] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
                own = np.repeat(np.arange(len(new)), size)
                mine = self.asked[self.term[rows]]
                rows, own = rows[mine], own[mine]
                self.seen[self.place[rows]] = True
                total = np.concatenate([[0], np.cumsum(self.impact[rows])])
                cut = np.searchsorted(own, np.arange(len(new) + 1))
                score = total[cut[1:]] - total[cut[:-1]]
                docs.append(new)
                scores.append(score)
                kept = np.concatenate([kept, score])
                if len(kept) > k:
                    kept = kept[np.argpartition(kept, len(kept) - k)[len(kept) - k :]]
                if len(kept) == k:
                    floor = max(floor, int(kept.min()))
            bound = 0
            for j in range(len(i)):
                run = self.seen[best[j] : end[j]]
                step = int(run.argmin()) if len(run) and not run.all() else len(run)
                best[j] += step
                # The last place of the unbroken run bounds what follows it; a list read to its end adds nothing.
                if best[j] < end[j]:
                    bound += int(self.impact_at[max(best[j] - 1, start[j])])
            read, depth = np.maximum(to, best), depth * 2
            if bound < floor or (best == end).all():
                break
        docs, scores = np.concatenate(docs) if docs else found[:0], np.concatenate(scores) if scores else kept
        for a, b in zip(start, end):
            self.seen[a:b] = False
        self.met[docs] = False
        self.asked[self.lists[i]] = False
        good = (scores > 0) & (scores >= floor)
        return docs[good], scores[good]


def counter(known: dict[str, int]):
    """A task: per document its number of terms, and the known ones with their counts."""

    def run(batches):
        for b in batches:
            n, off, term, tf = [], [0], [], []
            for text in b.column("text").to_pylist():
                words = terms(text)
                n.append(len(words))
                for t, c in Counter(known[w] for w in words if w in known).items():
                    term.append(t)
                    tf.append(c)
                off.append(len(term))
            at = pa.array(off, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.ListArray.from_arrays(at, pa.array(term, pa.int32())), pa.ListArray.from_arrays(at, pa.array(tf, pa.int64()))],
                names=["doc_id", "n", "terms", "tf"],
            )

    return run


_FOUND = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def searcher(items: list[tuple[int | None, np.ndarray]], weight: np.ndarray, n_docs: int, n_terms: int, k: int, chunk: int):
    """A task: at most k documents for each item, out of chunks of about ``chunk`` postings."""

    def run(batches):
        best: dict[int, tuple] = {}
        held, size = [], 0

        def flush():
            ids = pa.concat_arrays([b.column("doc_id") for b in held])
            # A null doc_id stands before all others.
            null, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            n = np.concatenate([b.column("n").to_numpy() for b in held])
            off = np.concatenate([[0], np.cumsum(np.concatenate([b.column("terms").value_lengths().to_numpy() for b in held]))]).astype(np.int64)
            term = np.concatenate([b.column("terms").flatten().to_numpy() for b in held]).astype(np.int64)
            tf = np.concatenate([b.column("tf").flatten().to_numpy() for b in held])
            m = 50 + (50 * n * n_docs) // max(n_terms, 1)
            impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, np.diff(off))))
            lists = Lists(off, term, impact)
            for i, (_, item) in enumerate(items):
                old = best.get(i)
                floor = int(old[2][-1]) if old is not None and len(old[2]) == k else 0
                docs, score = lists.search(item, k, floor)
                if len(docs):
                    rows = (~null[docs], ids[docs], score)
                    if old is not None:
                        rows = tuple(np.concatenate(z) for z in zip(old, rows))
                    top = np.lexsort((rows[1], rows[0], -rows[2]))[:k]
                    best[i] = tuple(z[top] for z in rows)
            held.clear()

        for b in batches:
            if b.num_rows:
                held.append(b)
                size += len(b.column("terms").flatten()) + b.num_rows
                if size >= chunk:
                    flush()
                    size = 0
        if held:
            flush()
        for i, (there, ids, score) in sorted(best.items()):
            yield pa.RecordBatch.from_arrays([pa.array([items[i][0]] * len(ids), pa.int64()), pa.array(ids, mask=~there), pa.array(score)], schema=_FOUND)

    return run


def ranked_search(documents: DataFrame, items: DataFrame, k: int = 50, block_terms: int = 500_000, chunk: int = 1_000_000) -> DataFrame:
    """The k highest-scoring documents (score above 0) of each item.

    Input: documents with ``doc_id``, ``text``; items with ``item_id``, ``text`` (other columns are ignored,
    whatever their names).  Result: item_id, rank (from 1, unique), doc_id, score.  Terms, weights and scores as in
    the query's contract, in 64-bit integers.  Equal scores go by ascending doc_id, null first.

    A null text has no terms; a document without terms counts nowhere, an item without terms has no rows.  Every
    row of ``documents`` is a document, also where it repeats a doc_id.  Rows that share an item_id (null too) are
    one item with the terms of all of them.  Empty tables give an empty table.  Items are split into blocks of
    about ``block_terms`` terms (a longer item is a block of its own); a task holds chunks of about ``chunk``
    postings and at most k documents of each item of the block.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def item_terms(batches):
        for b in batches:
            ids, out = [], []
            for i, text in zip(b.column("item_id").to_pylist(), b.column("text").to_pylist()):
                words = sorted(set(terms(text)))
                ids += [i] * len(words)
                out += words
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.string())], names=["item_id", "term"])

    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    asked = materialize(asked.mapInArrow(item_terms, "item_id long, term string").distinct())
    parts = max(1, math.ceil(asked.count() / block_terms))
    asked = asked.withColumn("part", F.pmod(F.xxhash64(F.col("item_id"), F.col("item_id").isNull()), F.lit(parts)))
    out = []
    totals = None
    for part in range(parts):
        block = asked.where(F.col("part") == part).select("item_id", "term").collect()
        if not block:
            continue
        known = {w: i for i, w in enumerate(sorted({r["term"] for r in block}))}
        of_item: dict = {}
        for r in block:
            of_item.setdefault(r["item_id"], []).append(known[r["term"]])
        lists = [(key, np.array(sorted(places), np.int64)) for key, places in of_item.items()]

        index = materialize(docs.mapInArrow(counter(known), "doc_id long, n long, terms array<int>, tf array<long>").where("n > 0"))
        if totals is None:
            row = index.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
            totals = int(row["n"]), int(row["l"] or 0)
        n_docs, n_terms = totals
        df = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
        weight = np.zeros(len(known), np.int64)
        for r in df.select("term", F.floor(1000 * F.log((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).cast("long").alias("w")).toLocalIterator():
            weight[r["term"]] = r["w"]  # one row per term of the block
        found = index.where(F.size("terms") > 0).select("doc_id", "n", "terms", "tf").mapInArrow(searcher(lists, weight, n_docs, n_terms, k, chunk), "item_id long, doc_id long, score long")
        order = [F.desc("score"), F.asc_nulls_first("doc_id")]
        # Ranks within parts of an item first, so that no task holds all that the chunks found for it.
        found = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(16)))
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*order))).where(F.col("rank") <= k)
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= k)
        out.append(materialize(found.select("item_id", "rank", "doc_id", "score")))
    if not out:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    whole = out[0]
    for df in out[1:]:
        whole = whole.unionByName(df)
    return whole


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents
), c AS (
  SELECT count(*) AS big_n, CAST(sum(len(t)) AS BIGINT) AS big_l FROM d WHERE len(t) > 0
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), p AS (
  SELECT r, doc_id, n, term, count(*) AS tf
  FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM p GROUP BY term) CROSS JOIN c
), s AS (
  SELECT q.item_id, p.doc_id, p.r, CAST(sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 20 * (100 - 50 + ((50 * p.n * c.big_n) // c.big_l))))) AS BIGINT) AS score
  FROM q JOIN p ON q.term = p.term JOIN w ON w.term = q.term CROSS JOIN c
  GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0
QUALIFY rank <= 50
"""
