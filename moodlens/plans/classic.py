"""The classic (pandas-style) cleaner, as column expressions.

Order: links → mentions → emojis (padded, ordered) → slang (padded) → non-alphanumerics →
lower → split → drop words of one character and stop words → lemma → join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as TX
from ..functions.fixed import CLASSIC_EMOJIS, CLASSIC_STOPWORDS, DEFAULT_ABBREVIATIONS
from ..functions.lexicon import LONG_FOLD, MAX_FOLD, fold_pairs, lexicon_pairs, literals_replaced, lookup_tokens, lookup_words, ordered_replace, words_kept
from ..operators.lexicon_ops import token_lookup_steps, word_lookup_steps


def expand_abbreviations(text, abbreviations=DEFAULT_ABBREVIATIONS, mode: str = "word") -> Column:
    """``mode="substring"`` keeps the original meaning (every key replaced inside words, padded);
    ``mode="word"`` (default) replaces whole words only."""
    if mode == "substring":
        return ordered_replace(text, abbreviations, pad=True)
    if mode == "word":
        return lookup_words(text, abbreviations)
    raise ValueError(mode)


def classic_words(text, abbreviations=DEFAULT_ABBREVIATIONS, stopwords=CLASSIC_STOPWORDS,
                  lemma_lexicon=None, abbrev_mode: str = "substring") -> Column:
    t = TX.replace_url_padded(text)
    t = TX.replace_mention_padded(t)
    t = ordered_replace(t, CLASSIC_EMOJIS, pad=True)
    t = expand_abbreviations(t, abbreviations, abbrev_mode)
    t = TX.lower_text(TX.keep_alnum(t))
    words = TX.remove_stopwords(TX.min_length_filter(TX.split_words(t), 2), stopwords, case_sensitive=True)
    if lemma_lexicon is not None:
        words = lookup_tokens(words, lemma_lexicon, resplit=False)
    return words


def classic_steps(abbreviations=DEFAULT_ABBREVIATIONS, stopwords=CLASSIC_STOPWORDS, lemma_lexicon=None,
                  abbrev_mode: str = "substring"):
    if abbrev_mode not in ("substring", "word"):
        raise ValueError(abbrev_mode)
    substring = abbrev_mode == "substring"
    pairs = lexicon_pairs(abbreviations, MAX_FOLD) if substring else []
    folds, before = [lambda c: ordered_replace(c, CLASSIC_EMOJIS, pad=True)], ()
    if not substring:
        folds += word_lookup_steps(abbreviations)
    elif len(pairs) > LONG_FOLD:
        folds.append(lambda c: ordered_replace(c, pairs, pad=True))
    else:  # one pass over Arrow batches
        folds, before = [], tuple(literals_replaced(fold_pairs(p, pad=True)) for p in (lexicon_pairs(CLASSIC_EMOJIS), pairs))
    lemmas = token_lookup_steps(lemma_lexicon, resplit=False) if lemma_lexicon is not None else []
    return [
        TX.only_with(TX.replace_url_padded, "http://", "https://", " www."),
        TX.only_with(TX.replace_mention_padded, "@"),
        *folds,
        words_kept(stopwords, 2, before),
        *lemmas,
        lambda c: c,
    ]


def classic_words_df(df: DataFrame, text_col: str, out_col: str = "words", abbreviations=DEFAULT_ABBREVIATIONS,
                     stopwords=CLASSIC_STOPWORDS, lemma_lexicon=None, abbrev_mode: str = "substring",
                     keep=None) -> DataFrame:
    """Staged form of ``classic_words``: one narrow projection per step."""
    steps = classic_steps(abbreviations, stopwords, lemma_lexicon, abbrev_mode)
    return TX.run_steps(df, text_col, steps, out_col, keep, empty=F.array().cast("array<string>"))


def clean_classic_df(df: DataFrame, text_col: str, out_col: str = "text", keep=None, **kw) -> DataFrame:
    keep = list(df.columns) if keep is None else list(keep)
    w = classic_words_df(df, text_col, "_words", keep=keep, **kw)
    return w.select(*keep, F.array_join("_words", " ").alias(out_col))


def clean_classic(text, **kw) -> Column:
    """Cleaned text: kept words joined by one blank ('' when nothing is left)."""
    return F.array_join(F.coalesce(classic_words(text, **kw), F.array().cast("array<string>")), " ")


def classic_dataset(df: DataFrame, text_col: str = "text", label_col: str = "label", **kw) -> DataFrame:
    """``(text, label)`` rows of cleaned text, dropping rows left empty (label stays aligned)."""
    base = df.select(F.col(text_col).alias("_raw"), F.col(label_col).alias("label"))
    cleaned = clean_classic_df(base, "_raw", "text", keep=["label"], **kw)
    return TX.keep_where(cleaned.select("text", "label"), F.length("text") > 0)
