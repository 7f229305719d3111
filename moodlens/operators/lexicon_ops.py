"""Lexicons given as tables, of any size, applied to token columns.

Each of these is a dictionary from a word to the words that replace it, applied by
``vocabulary.replace_tokens``: in place where the dictionary is measured small, by a join otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lexicon import is_large, lexicon_frame, lexicon_pairs, lookup_tokens, texts_changed, words_replaced
from ..functions.text import FrameStep, split_words
from .vocabulary import MAX_SENT_ROWS, distinct_words, replace_tokens


def _dictionary(lexicon: DataFrame, value_name: str) -> DataFrame:
    """``(word, value)`` with one row per key, the last one in lexicon order."""
    last = F.max_by("value", "ord") if "ord" in lexicon.columns else F.max("value")
    return lexicon.groupBy(F.col("key").alias("word")).agg(last.alias(value_name)).where("word is not null")


def _applied(df: DataFrame, id_col: str, tokens_col: str, dictionary: DataFrame, out_col: str, max_rows: int) -> DataFrame:
    tokens = df.select(F.col(id_col), F.coalesce(F.col(tokens_col), F.array().cast("array<string>")).alias(out_col))
    return replace_tokens(tokens, out_col, dictionary, max_rows)


def lexicon_lookup_join(df: DataFrame, id_col: str, tokens_col: str, lexicon: DataFrame, out_col: str = "tokens",
                        resplit: bool = True, max_rows: int = MAX_SENT_ROWS) -> DataFrame:
    """``(id, out)``: each token replaced by its lexicon value (``key → value``), multi-word values
    split into several tokens."""
    lex = _dictionary(lexicon, "_val").where("_val is not null")
    out = split_words("_val") if resplit else F.array("_val")
    return _applied(df, id_col, tokens_col, lex.select("word", out.alias("out")), out_col, max_rows)


def _lexicon_step(lexicon, resplit: bool) -> FrameStep:
    def apply(df: DataFrame, column: str) -> DataFrame:
        table = lexicon if isinstance(lexicon, DataFrame) else lexicon_frame(df.sparkSession, lexicon)
        lex = _dictionary(table.where("key <> ''"), "_val").where("_val is not null")
        return replace_tokens(df, column, lex.select("word", (split_words("_val") if resplit else F.array("_val")).alias("out")))

    return FrameStep(apply)


def word_lookup_steps(lexicon, before=()) -> list:
    """Steps of ``run_steps`` that do what ``lookup_words`` does, for a lexicon of any size, after the functions
    ``before`` of a text."""
    if not is_large(lexicon):
        return [words_replaced(lexicon, before=before)]
    return [*([texts_changed(*before)] if before else []), split_words, _lexicon_step(lexicon, resplit=False), lambda c: F.array_join(c, " ")]


def token_lookup_steps(lexicon, resplit: bool = True, single_words: bool = False) -> list:
    """The same for ``lookup_tokens`` (tokens that hold no white space)."""
    if not is_large(lexicon):
        pairs = lexicon_pairs(lexicon)
        return [lambda c: lookup_tokens(c, pairs, resplit, single_words)]
    return [_lexicon_step(lexicon, resplit)]


def tag_filter_step(lexicon, default_tag: str, allowed) -> FrameStep:
    """The tag filter by a lexicon of any size."""

    def apply(df: DataFrame, column: str) -> DataFrame:
        table = lexicon if isinstance(lexicon, DataFrame) else lexicon_frame(df.sparkSession, lexicon)
        return replace_tokens(df, column, _dropped_tags(df, column, table, default_tag, allowed))

    return FrameStep(apply)


def stopword_anti_join(df: DataFrame, id_col: str, tokens_col: str, stopwords: DataFrame, out_col: str = "tokens",
                       max_rows: int = MAX_SENT_ROWS) -> DataFrame:
    """``(id, out)``: tokens not in the stop-word table (``word``), order kept."""
    none = F.array().cast("array<string>")
    stop = stopwords.select("word").where("word is not null").distinct().withColumn("out", none)
    return _applied(df, id_col, tokens_col, stop, out_col, max_rows)


def tag_filter_join(df: DataFrame, id_col: str, tokens_col: str, lexicon: DataFrame, out_col: str = "tokens",
                    default_tag: str = "NN", allowed=("J", "R", "V", "N"), max_rows: int = MAX_SENT_ROWS) -> DataFrame:
    """``(id, out)``: tokens whose tag (``key -> value``, else ``default_tag``) starts with an allowed letter: the
    form of ``pos_filter`` for lexicons of any size."""
    return _applied(df, id_col, tokens_col, _dropped_tags(df, tokens_col, lexicon, default_tag, allowed), out_col, max_rows)


def _dropped_tags(df: DataFrame, tokens_col: str, lexicon: DataFrame, default_tag: str, allowed) -> DataFrame:
    """``(word, no words)`` for every word whose tag is not allowed."""
    tags = _dictionary(lexicon, "_tag")
    if default_tag[:1] not in allowed:  # words without an entry go too
        tags = distinct_words(df, tokens_col).join(tags, "word", "left")
    first = F.substring(F.coalesce("_tag", F.lit(default_tag)), 1, 1)
    return tags.where(~first.isin(*allowed)).select("word", F.array().cast("array<string>").alias("out"))


def invert_lexicon(lexicon: DataFrame) -> DataFrame:
    """``value → key`` with Python ``dict`` inversion semantics: the last key wins; rows ordered by
    the first position of each value.  A grouped aggregate, not a driver loop."""
    return lexicon.groupBy(F.col("value").alias("key")).agg(
        F.min("ord").alias("ord"), F.max_by("key", "ord").alias("value")
    ).select("ord", "key", "value")
