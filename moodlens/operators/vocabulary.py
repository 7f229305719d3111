"""Word rules applied to a vocabulary, not to every token.

A rule over tokens (a stem, a lemma, a slang value, a stop word) is a dictionary from a word to the words that
replace it.  The dictionary is built by ordinary DataFrame work over the distinct words, keeps changed words
only, and is applied in one of two ways:

* measured small (rows and bytes): sent to the tasks and applied to whole Arrow batches of token arrays, each
  distinct word of a batch looked up once.  Rows keep their place: no shuffle, no re-gathering;
* larger: the distinct words of chunks of rows are joined with the dictionary, and each chunk meets its entries.

A dictionary that names more words than the table holds is cut down to the table's words first.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.lexicon import text_slices
from ..session import materialize
from .sizing import measure

MAX_SENT_ROWS = 500_000
MAX_SENT_BYTES = 32 * 1024 * 1024
CHUNK_TOKENS = 1_000_000  # of rows that meet their words' entries in one task


def distinct_words(df: DataFrame, tokens_col: str) -> DataFrame:
    """``(word)``: every word of a token column once, written."""
    return materialize(df.select(F.explode(tokens_col).alias("word")).where("word is not null").distinct())


def numbered_words(words: DataFrame) -> DataFrame:
    """``(word, id)``: ids from 0 in the order of the words, by prefix sums."""
    from .selection import numbered

    return numbered(words, [F.asc("word")], "id", start=0)


def _small(dictionary: DataFrame, max_rows: int, max_bytes: int) -> bool:
    rows, size = measure(dictionary)
    return rows <= max_rows and size <= max_bytes


def replace_tokens(df: DataFrame, tokens_col: str, dictionary: DataFrame, max_rows: int = MAX_SENT_ROWS, max_bytes: int = MAX_SENT_BYTES) -> DataFrame:
    """``df`` with every token that ``dictionary (word, out array<string>)`` names replaced by its words (none: the
    token goes); one row per word.  A null array stays null, a null token stays."""
    dictionary = materialize(dictionary.select("word", "out"))
    if not _small(dictionary, max_rows, max_bytes):
        dictionary = materialize(dictionary.join(distinct_words(df, tokens_col), "word", "left_semi"))
        if not _small(dictionary, max_rows, max_bytes):
            return _joined(df, tokens_col, dictionary)
    table = {r["word"]: tuple(r["out"]) for r in dictionary.collect()}
    sent = df.sparkSession.sparkContext.broadcast(table)
    names = df.columns

    def run(batches):
        for batch in batches:
            for b in text_slices(batch, tokens_col):
                at = b.schema.get_field_index(tokens_col)
                columns = list(b.columns)
                columns[at] = replaced(columns[at], sent.value)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(run, df.schema)


def replaced(tokens: pa.ListArray, table: dict[str, tuple]) -> pa.ListArray:
    """``tokens`` with the words of ``table`` replaced."""
    flat = tokens.flatten().dictionary_encode()
    words = flat.dictionary.to_pylist()
    outs = [table.get(w, (w,)) for w in words] + [(None,)]  # the last one stands for a null token
    codes = flat.indices.fill_null(len(words)).to_numpy()
    size = np.array([len(o) for o in outs], np.int64)
    start = np.cumsum(size) - size
    n = size[codes]
    ends = np.cumsum(n)
    place = np.repeat(start[codes] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
    values = pa.array([w for o in outs for w in o], pa.string()).take(pa.array(place))
    lengths = tokens.value_lengths().fill_null(0).to_numpy()
    off = np.concatenate([[0], np.cumsum(lengths)])
    off = np.concatenate([[0], ends])[off].astype(np.int32)
    offsets = pa.array(off, mask=np.append(tokens.is_null().to_numpy(zero_copy_only=False), False))
    return pa.ListArray.from_arrays(offsets, values)


def _joined(df: DataFrame, tokens_col: str, dictionary: DataFrame) -> DataFrame:
    """The same by a join on the distinct words of chunks of rows: a chunk and its words' entries meet in one task,
    so that what is shuffled is each row once and each word once per chunk, not each token.  Chunks are written
    first: they must not change when a task runs again."""
    names, held = df.columns, T.StructType([*df.schema.fields, T.StructField("_chunk", T.LongType())])

    def chunks(batches):
        at, filled = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            for b in text_slices(batch, tokens_col):
                tokens = len(b.column(tokens_col).flatten())
                if filled and filled + tokens > CHUNK_TOKENS:
                    at, filled = at + 1, 0
                filled += tokens + b.num_rows
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, at))], names=[*names, "_chunk"])

    def words(batches):
        for b in batches:
            ids = b.column("_chunk").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(ids)) + 1, [len(ids)]])
            for x, y in zip(cuts[:-1], cuts[1:]):
                if y > x:
                    found = b.column("_t").slice(int(x), int(y - x)).flatten().drop_null().unique()
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), ids[x])), found], names=["_chunk", "word"])

    def gathered(rows: pa.Table, entries: pa.Table) -> pa.Table:
        table = dict(zip(entries.column("word").to_pylist(), map(tuple, entries.column("out").to_pylist())))
        made = []
        for b in rows.select(names).to_batches():
            columns = list(b.columns)
            columns[names.index(tokens_col)] = replaced(b.column(tokens_col), table)
            made.append(pa.RecordBatch.from_arrays(columns, names=names))
        return pa.Table.from_batches(made, made[0].schema) if made else rows.select(names)

    rows = materialize(df.mapInArrow(chunks, held))
    known = rows.select("_chunk", F.col(tokens_col).alias("_t")).mapInArrow(words, "_chunk long, word string").distinct()
    entries = known.join(dictionary, "word").select("_chunk", "word", "out")
    return rows.groupBy("_chunk").cogroup(entries.groupBy("_chunk")).applyInArrow(gathered, df.schema)


def apply_word_rule(df: DataFrame, tokens_col: str, rule: Callable[[str], str] | None = None, expression: Callable[[Column], Column] | None = None,
                    max_rows: int = MAX_SENT_ROWS, max_bytes: int = MAX_SENT_BYTES) -> DataFrame:
    """A word rule, a Python function or an expression, over the distinct words of ``tokens_col``: each word is
    handled once per table.  ``df`` is read twice: pass a written table."""
    words = distinct_words(df, tokens_col)
    if expression is None:

        @F.pandas_udf("string")
        def once(s: pd.Series) -> pd.Series:
            return s.map(rule)

        expression = once.asNondeterministic()  # evaluated once, not again by a filter on its result
    changed = words.withColumn("_new", expression(F.col("word"))).where(F.col("_new") != F.col("word"))
    return replace_tokens(df, tokens_col, changed.select("word", F.array("_new").alias("out")), max_rows, max_bytes)


#: Detachment rules of English nouns: ending, what stands for it (fixed values, tried in this order).
NOUN_ENDINGS = (("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"))


def noun_lemmas(words: DataFrame, exceptions: DataFrame | None = None, nouns: DataFrame | None = None) -> DataFrame:
    """``(word, lemma)`` of the words that have another form: the entry of ``exceptions (key, value[, ord])`` (the
    last one counts), else the shortest form (ties: the first in order) that a detachment rule gives and that is
    a noun of ``nouns (word)``, by default a word of ``words`` itself.  A word of ``nouns`` is its own lemma only
    if no rule gives a shorter one."""
    known = words if nouns is None else nouns.select("word").distinct()
    forms = [F.when(F.endswith("word", F.lit(e)) & (F.length("word") > len(e)), F.concat(F.expr(f"left(word, length(word) - {len(e)})"), F.lit(r))) for e, r in NOUN_ENDINGS]
    tried = words.select("word", F.explode(F.array_compact(F.array(*forms))).alias("form")).where(F.length("form") > 1)
    found = tried.join(known.select(F.col("word").alias("form")), "form", "left_semi")
    lemma = found.groupBy("word").agg(F.min(F.struct(F.length("form"), "form"))["form"].alias("lemma"))
    if exceptions is None:
        return lemma
    last = F.max_by("value", "ord") if "ord" in exceptions.columns else F.max("value")
    own = exceptions.groupBy(F.col("key").alias("word")).agg(last.alias("own")).join(words, "word", "left_semi")
    return lemma.join(own, "word", "full").select("word", F.coalesce("own", "lemma").alias("lemma")).where("word <> lemma")
