import math
import random
from collections import Counter, defaultdict

import numpy as np

from moodlens.llm import best_position as B


def brute(docs, items, k):
    """item_id -> [(score, doc_id)], by the contract's formula."""
    counts = [(d, Counter(B.terms(t)), len(B.terms(t))) for d, t in docs]
    counts = [c for c in counts if c[2]]
    n_docs, n_terms = len(counts), sum(n for *_, n in counts)
    df = Counter(w for _, c, _ in counts for w in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(B.terms(t))
    out = {}
    for i, words in asked.items():
        rows = []
        for d, c, n in counts:
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1_000_000_000 * c[w]) // (1000 * c[w] + 20 * m)) for w in words if w in c)
            if s > 0:
                rows.append((s, d))
        rows.sort(key=lambda r: (-r[0], r[1] is not None, r[1] or 0))
        if rows:
            out[i] = rows[:k]
    return out


def got(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r.item_id].append((r["rank"], r.score, r.doc_id))
    for rows in out.values():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, len(rows) + 1))
    return {i: [r[1:] for r in rows] for i, rows in out.items()}


def frames(spark, docs, items):
    from pyspark.sql import functions as F

    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n", F.lit("x")).withColumn("terms", F.lit("y")).withColumn("item_id", F.lit(1))
    q = spark.createDataFrame(items, "item_id long, text string").withColumn("part", F.lit("x")).withColumn("doc_id", F.lit("z"))
    return d, q


def corpus(rng, n):
    words = [f"w{int(rng.paretovariate(0.7)) % 400}" for _ in range(3000)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(1, 60)))) for i in range(n)]
    return docs + [(n + i, docs[0][1]) for i in range(n // 3)]  # a third are copies: ties


def test_equal_to_brute_force_on_any_chunks(spark):
    rng = random.Random(4)
    docs = corpus(rng, 500)
    items = [(i, " ".join(rng.choices(docs, k=1)[0][1].split()[:20]) + " W1, unknown") for i in range(25)] + [(3, "w7 w8")]
    want = brute(docs, items, 10)
    d, q = frames(spark, docs, items)
    for block, chunk in ((500_000, 1_000_000), (40, 300)):
        assert got(B.ranked_search(d, q, k=10, block_terms=block, chunk=chunk)) == want


def test_odd_rows(spark):
    long = "Alpha " + "x" * 200_000 + " beta" * 50_000
    docs = [(1, None), (2, ""), (3, " ,;_ "), (None, "alpha beta"), (4, "Alpha_beta"), (4, "Alpha_beta"), (None, None), (5, "ÄLPHA alpha é"), (6, long), (7, "nothing here"), (8, "gamma delta")]
    items = [(1, "ALPHA; beta"), (None, "älpha Älpha"), (2, None), (2, "beta"), (3, ""), (4, "absent"), (5, "alpha alpha " * 30_000 + "gamma")]
    d, q = frames(spark, docs, items)
    want = brute(docs, items, 50)
    assert got(B.ranked_search(d, q)) == want and set(want) == {1, None, 2, 5}
    assert [r for r in want[2]][0][1] == 6
    assert B.ranked_search(d.limit(0), q).count() == 0
    assert B.ranked_search(d, q.limit(0)).count() == 0


def test_stops_before_the_ends_of_the_lists():
    rng = np.random.default_rng(0)
    docs, vocab = 20_000, 50
    off = np.arange(0, docs * 5 + 1, 5)
    term = np.concatenate([rng.choice(vocab, 5, replace=False) for _ in range(docs)])
    impact = rng.integers(1, 1000, len(term)) ** 2
    lists = B.Lists(off, term, impact)
    met = []
    for item in (np.array([1]), np.array([2, 3]), np.array([0, 7, 49])):
        found, score = lists.search(item, 10, 0)
        whole = np.zeros(docs, np.int64)
        np.add.at(whole, np.repeat(np.arange(docs), 5), np.where(np.isin(term, item), impact, 0))
        tenth = np.sort(whole)[-10]
        assert set(np.flatnonzero(whole >= tenth)) <= set(found) and (whole[found] == score).all()
        assert not lists.seen.any() and not lists.met.any() and not lists.asked.any()
        met.append(len(found))
    assert max(met) < docs / 4
    # Equal scores at the limit handed in are kept, lower ones are not.
    found, score = lists.search(np.array([1]), 10, int(np.sort(impact[term == 1])[-3]))
    assert len(found) >= 3 and score.min() >= np.sort(impact[term == 1])[-3]
