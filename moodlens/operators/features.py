"""Splits, vocabulary and TF-IDF as relational jobs.

Sparse features are kept in long form ``(doc_id, term, value)``: they partition by key like any
table, and the vocabulary never has to fit on one machine unless it is capped (``max_features``),
in which case its size is bounded and it is broadcast.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.lexicon import text_slices
from ..session import materialize
from .selection import numbered, top_k
from .sizing import broadcast_if_small


def hash_bucket(key, buckets: int = 100) -> Column:
    """Stable bucket of a key: first 32 bits of ``md5(key as text)`` modulo ``buckets``.

    Independent of partitioning and of the engine (DuckDB computes the same bucket)."""
    k = F.col(key) if isinstance(key, str) else key
    return (F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint") % buckets).cast("int")


def hash_split(df: DataFrame, key: str, train_pct: int = 90) -> DataFrame:
    """Add ``is_train``: deterministic train/test assignment by key (no shuffle, no sort)."""
    return df.withColumn("is_train", hash_bucket(key) < train_pct)


def random_split(df: DataFrame, weights=(0.8, 0.2), seed: int = 24):
    """``DataFrame.randomSplit`` (depends on partitioning; prefer ``hash_split`` for repeatable runs)."""
    return df.randomSplit(list(weights), seed)


def doc_terms(df: DataFrame, doc_col: str, words_col: str, extra=()) -> DataFrame:
    """``(doc_id, term, tf, *extra)``: 1- and 2-gram counts per document, without a shuffle.

    A document is one row, so its counts need no grouping across rows: the grams of the rows of an Arrow batch
    are numbered, and equal (row, number) pairs are counted by one sort.
    """
    rows = df.select(F.col(doc_col).alias("doc_id"), *extra, F.col(words_col).alias("_words"))
    kept = [f for f in rows.schema.fields if f.name != "_words"]
    out = T.StructType([kept[0], T.StructField("term", T.StringType()), *kept[1:], T.StructField("tf", T.LongType())])

    def run(batches):
        for batch in batches:
            for b in text_slices(batch, "_words"):
                row, terms, tf = gram_counts(b.column("_words"))
                cols = [b.column(f.name).take(row) for f in kept]
                yield pa.RecordBatch.from_arrays([cols[0], terms, *cols[1:], tf], names=out.names)

    return rows.mapInArrow(run, out)


def gram_counts(words: pa.ListArray) -> tuple[pa.Array, pa.Array, pa.Array]:
    """``(row, term, tf)``: each distinct 1- or 2-gram of each row with its count (null words are no terms)."""
    size = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
    flat, row = words.flatten(), np.repeat(np.arange(len(size)), size)
    near = row[1:] == row[:-1]
    pairs = pc.binary_join_element_wise(flat[:-1].filter(pa.array(near)), flat[1:].filter(pa.array(near)), " ")
    grams = pa.concat_arrays([flat, pairs]).dictionary_encode()
    code = grams.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.concatenate([row, row[1:][near]])[code >= 0]
    width = max(len(grams.dictionary), 1)
    key, tf = np.unique(row * width + code[code >= 0], return_counts=True)
    return pa.array(key // width), grams.dictionary.take(pa.array(key % width)), pa.array(tf.astype(np.int64))


def term_stats(tf: DataFrame) -> DataFrame:
    """``(term, df, cf)``: document frequency and corpus frequency (partial aggregation first, so a
    hot term ships one partial row per task)."""
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def top_vocabulary(stats: DataFrame, max_features: int | None) -> DataFrame:
    """The ``max_features`` most frequent terms (by ``cf``, ties by term), see :func:`selection.top_k`."""
    if max_features is None:
        return stats
    return top_k(stats, max_features, "cf", "term")


def idf_table(vocab: DataFrame, n_docs: int) -> DataFrame:
    """Smoothed idf: ``ln((1 + n) / (1 + df)) + 1``."""
    idx = [c for c in ("idx",) if c in vocab.columns]
    return vocab.select("term", "df", *idx, (F.log((F.lit(n_docs) + 1) / (F.col("df") + 1)) + 1).alias("idf"))


def tfidf(tf: DataFrame, idf: DataFrame, bounded_vocab: bool) -> DataFrame:
    """``(doc_id, term, weight, …)``: tf × idf, L2-normalised per document.

    The idf side is broadcast only when its row count is capped (``max_features`` set) and its
    measured size is small; otherwise the join shuffles on ``term`` and AQE re-plans it at run time.
    The norms are summed where the terms of a document lie, so that a row per document and task is shuffled, and
    meet the weights in a join on ``doc_id``: broadcast while they are small.
    """
    side = broadcast_if_small(idf) if bounded_vocab else idf
    w = tf.join(side.drop("df"), "term").withColumn("w", F.col("tf") * F.col("idf"))
    norms = w.groupBy(F.col("doc_id").alias("_doc")).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_norm"))
    met = w.join(broadcast_if_small(materialize(norms)), F.col("doc_id").eqNullSafe(F.col("_doc")))
    return met.withColumn("weight", F.col("w") / F.col("_norm")).drop("w", "_doc", "_norm")


def sparse_rows(features: DataFrame, docs: DataFrame) -> DataFrame:
    """``docs`` plus ``ids array<int>`` and ``x array<double>``: the non-zeros of each document by rising id."""
    pairs = features.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("idx", "x"))).alias("_p"))
    out = docs.join(pairs, "doc_id", "left")
    none = F.array()
    return out.select(*docs.columns, F.coalesce(F.col("_p.idx"), none.cast("array<int>")).alias("ids"),
                      F.coalesce(F.col("_p.x"), none.cast("array<double>")).alias("x"))


class TfidfFit:
    """Fit on the training rows, apply to all rows (as ``TfidfVectorizer.fit`` then ``transform``)."""

    def __init__(self, tf: DataFrame, max_features: int | None = 500_000, n_docs: int | None = None):
        train = tf.filter("is_train")
        self.n_docs = n_docs if n_docs is not None else train.select("doc_id").distinct().count()
        # Statistics feed the cut-off histogram and the top-k; the vocabulary feeds a size check,
        # the vocabulary count and every transform: each is written once, not recomputed.
        stats = materialize(term_stats(train)) if max_features is not None else term_stats(train)
        # ``idx``: the term's place by frequency, from 0; ids of sparse rows and of model weights.
        order = [F.desc("cf"), F.asc("term")]
        self.vocab = materialize(numbered(top_vocabulary(stats, max_features), order, "idx", start=0))
        self.bounded = max_features is not None
        self.idf = idf_table(self.vocab, self.n_docs)

    def transform(self, tf: DataFrame) -> DataFrame:
        return tfidf(tf, self.idf, self.bounded)

    def vocab_size(self) -> int:
        return self.vocab.count()


def word2vec_embed(df: DataFrame, tokens_col: str, out_col: str = "features", vector_size: int = 100,
                   min_count: int = 5, seed: int = 42, num_partitions: int = 1):
    """``Word2Vec`` (mean of word vectors per row, see :mod:`skipgram`); returns the fitted model."""
    from .skipgram import SkipGram

    w2v = SkipGram(vectorSize=vector_size, minCount=min_count, inputCol=tokens_col, outputCol=out_col,
                   seed=seed, numPartitions=num_partitions)
    return w2v.fit(df)


def vocabulary_ids(tokens_df: DataFrame, doc_col: str, tokens_col: str, vocab_size: int,
                   seq_len: int) -> DataFrame:
    """Token ids padded/truncated to ``seq_len``: ``0`` pads, ``1`` marks an unknown token, known
    tokens get ``rank + 1`` in a frequency vocabulary of ``vocab_size`` terms (ties by term).

    The vocabulary counts the words of whole texts; ids are then looked up only for the ``seq_len`` words
    that a sequence can hold.  The vocabulary is capped, so it is a bounded broadcast side.  Tokens are
    re-gathered per document in their original order.
    """
    whole = tokens_df.select(F.explode(tokens_col).alias("term"))
    exploded = tokens_df.select(F.col(doc_col).alias("doc_id"), F.posexplode(F.slice(tokens_col, 1, seq_len)).alias("pos", "term"))
    counts = materialize(whole.groupBy("term").agg(F.count(F.lit(1)).alias("cnt")))
    top = top_k(counts, vocab_size, "cnt", "term")
    ranked = materialize(numbered(top, [F.desc("cnt"), F.asc("term")], "id", start=2).select("term", F.col("id").cast("int").alias("id")))
    ids = exploded.join(broadcast_if_small(ranked), "term", "left").select(
        "doc_id", "pos", F.coalesce("id", F.lit(1)).alias("id")
    )
    gathered = ids.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", "id"))).alias("p"))
    from ..functions.text import pad_truncate

    docs = tokens_df.select(F.col(doc_col).alias("doc_id"))
    seq = docs.join(gathered, "doc_id", "left").select(
        "doc_id", F.coalesce(F.transform("p", lambda s: s["id"]), F.array().cast("array<int>")).alias("ids")
    )
    return seq.select("doc_id", pad_truncate("ids", seq_len).alias("input_ids"))
