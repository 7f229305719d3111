"""Queries: text-cleaning scalars and their compositions (inventory 2.8).

Each query cleans the whole text of every document and returns ``(TweetID, out)``; token arrays
are returned joined by ``|`` together with their length, so the value hash sees plain columns.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as TX
from ..functions.fixed import (
    CLASSIC_EMOJIS,
    CLASSIC_STOPWORDS,
    DEFAULT_ABBREVIATIONS,
    DEFAULT_EMOTICONS,
    SPARK_ENGLISH_STOPWORDS,
)
from ..functions.lexicon import lookup_tokens, lookup_words, ordered_replace
from ..sources import tweets as SRC
from . import classic, social
from . import sqltext as S
from .catalog import register

CTE = "WITH " + S.tweets_cte()


def _str_query(name, spark_fn, sql_expr, df_fn=None):
    def run(spark, sf_dir):
        v = SRC.text_view(spark, sf_dir)
        if df_fn is not None:
            return df_fn(v.select("TweetID", "TweetText"), "TweetText", "out", keep=["TweetID"])
        return v.select("TweetID", spark_fn(F.col("TweetText")).alias("out"))

    run.__name__ = name
    register(name, f"{CTE}\nSELECT TweetID, {sql_expr} AS out FROM tweets")(run)


def _arr_query(name, spark_fn, sql_expr, df_fn=None):
    def run(spark, sf_dir):
        v = SRC.text_view(spark, sf_dir)
        if df_fn is not None:
            v = df_fn(v.select("TweetID", "TweetText"), "TweetText", "_arr", keep=["TweetID"])
            arr = F.col("_arr")
        else:
            arr = spark_fn(F.col("TweetText"))
        return v.select("TweetID", F.array_join(arr, "|").alias("out"), F.size(arr).alias("n_tokens"))

    run.__name__ = name
    register(
        name,
        f"{CTE}\nSELECT TweetID, array_to_string(a, '|') AS out, CAST(len(a) AS INTEGER) AS n_tokens "
        f"FROM (SELECT TweetID, {sql_expr} AS a FROM tweets)",
    )(run)


T = "TweetText"

_str_query("lower_strip", lambda c: TX.strip_ws(TX.lower_text(c)), S.strip_ws(f"lower({T})"))
_str_query("replace_url", TX.replace_url, S.replace_url(T))
_str_query("replace_url_padded", TX.replace_url_padded, S.replace_url_padded(T))
_str_query("html_unescape", TX.html_unescape_common, S.html_unescape_common(T))
_str_query("html_unescape_full", lambda c: TX.html_unescape(c, "full"), S.html_unescape_full(T))
_str_query("expand_abbrev_words", lambda c: lookup_words(c, DEFAULT_ABBREVIATIONS), S.lookup_words(T, DEFAULT_ABBREVIATIONS))
_str_query(
    "expand_abbrev_substring",
    lambda c: classic.expand_abbreviations(c, DEFAULT_ABBREVIATIONS, "substring"),
    S.ordered_replace(T, DEFAULT_ABBREVIATIONS, pad=True),
)
_str_query("remove_unicode", TX.remove_unicode, S.remove_unicode(T))
_str_query(
    "emoticon_to_words",
    lambda c: ordered_replace(TX.lower_text(c), DEFAULT_EMOTICONS),
    S.ordered_replace(f"lower({T})", DEFAULT_EMOTICONS),
)
_str_query(
    "emoji_to_words_padded",
    lambda c: ordered_replace(c, CLASSIC_EMOJIS, pad=True),
    S.ordered_replace(T, CLASSIC_EMOJIS, pad=True),
)
_str_query("replace_mention", TX.replace_mention, S.replace_mention(T))
_str_query("replace_mention_padded", TX.replace_mention_padded, S.replace_mention(T, " USER "))
_str_query("strip_hashtag", TX.strip_hashtag, S.strip_hashtag(T))
_str_query("collapse_repeats", TX.collapse_repeats, S.collapse_repeats(T))
_str_query("collapse_exclaim", TX.collapse_exclaim, S.rr(T, r"!{2,}", " multiExclamation "))
_str_query("collapse_question", TX.collapse_question, S.rr(T, r"\?{2,}", " multiQuestion "))
_str_query("collapse_stop", TX.collapse_stop, S.rr(T, r"\.{2,}", " multiStop "))
_str_query("expand_contractions", lambda c: TX.expand_contractions(TX.lower_text(c)), S.expand_contractions(f"lower({T})"))
_str_query("keep_alnum", TX.keep_alnum, S.keep_alnum(T))
_str_query(
    "clean_social_text",
    lambda c: social.clean_social_text(c),
    S.clean_social_text(T, DEFAULT_EMOTICONS, DEFAULT_ABBREVIATIONS),
    df_fn=social.social_text_df,
)
_str_query(
    "clean_classic",
    lambda c: classic.clean_classic(c),
    S.clean_classic(T, DEFAULT_ABBREVIATIONS, CLASSIC_EMOJIS, CLASSIC_STOPWORDS),
    df_fn=classic.clean_classic_df,
)
_str_query(
    "clean_classic_wordwise",
    lambda c: classic.clean_classic(c, abbrev_mode="word"),
    S.clean_classic(T, DEFAULT_ABBREVIATIONS, CLASSIC_EMOJIS, CLASSIC_STOPWORDS, abbrev_mode="word"),
    df_fn=lambda df, t, o, keep: classic.clean_classic_df(df, t, o, keep=keep, abbrev_mode="word"),
)

_arr_query(
    "clean_social",
    lambda c: social.clean_social(c),
    S.clean_social(T, DEFAULT_EMOTICONS, DEFAULT_ABBREVIATIONS, SPARK_ENGLISH_STOPWORDS),
    df_fn=social.social_tokens_df,
)
_arr_query(
    "expand_abbrev_tokens",
    lambda c: lookup_tokens(TX.tokenize_regex(TX.lower_text(c)), DEFAULT_ABBREVIATIONS),
    S.lookup_tokens(S.tokenize_regex(f"lower({T})"), DEFAULT_ABBREVIATIONS),
)
_arr_query(
    "remove_stopwords",
    lambda c: TX.remove_stopwords(TX.tokenize_ws(c), SPARK_ENGLISH_STOPWORDS),
    S.remove_stopwords(S.tokenize_ws(T), SPARK_ENGLISH_STOPWORDS),
)


@register(
    "filter_nonempty_clean",
    f"""{CTE}
SELECT text, label FROM (
  SELECT {S.clean_classic(T, DEFAULT_ABBREVIATIONS, CLASSIC_EMOJIS, CLASSIC_STOPWORDS)} AS text,
         CAST(CASE WHEN Polarity = 4 THEN 1 ELSE Polarity END AS INTEGER) AS label
  FROM tweets WHERE Polarity IS NOT NULL) WHERE length(text) > 0""",
)
def filter_nonempty_clean(spark, sf_dir):
    from ..functions.labels import label_replace

    v = SRC.labelled_tweets(spark, sf_dir).select(
        F.col("TweetText").alias("text"), label_replace("Polarity").cast("int").alias("label")
    )
    return classic.classic_dataset(v)


@register(
    "filter_class",
    f"""{CTE}
SELECT TweetID, {S.clean_classic(T, DEFAULT_ABBREVIATIONS, CLASSIC_EMOJIS, CLASSIC_STOPWORDS)} AS text
FROM tweets WHERE Polarity = 0""",
)
def filter_class(spark, sf_dir):
    """Negative subset by label value (the notebook cut by row position)."""
    v = SRC.tweet_view(spark, sf_dir).filter(F.col("Polarity") == 0).select("TweetID", "TweetText")
    return classic.clean_classic_df(v, "TweetText", "text", keep=["TweetID"])


@register(
    "filter_class_positive",
    f"""{CTE}
SELECT TweetID, {S.clean_classic(T, DEFAULT_ABBREVIATIONS, CLASSIC_EMOJIS, CLASSIC_STOPWORDS)} AS text
FROM tweets WHERE Polarity = 4""",
)
def filter_class_positive(spark, sf_dir):
    """Positive subset by label value."""
    v = SRC.tweet_view(spark, sf_dir).filter(F.col("Polarity") == 4).select("TweetID", "TweetText")
    return classic.clean_classic_df(v, "TweetText", "text", keep=["TweetID"])
