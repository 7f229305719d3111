"""The social-text cleaner of the Spark notebooks, as one projection of built-in expressions.

Order (it matters, see SURVEY §3.2): lower → links (and hashtags) → strip → HTML entities →
non-ASCII removal → emoticons (ordered fold) → slang by word → mentions → hashtags → repeated
``!``/``?``/``.`` → contractions → regex tokens → slang by token (re-split) → tag and stop-word
filter → stem.  Lexicons are arguments; the defaults are small tables of our own.
"""

from __future__ import annotations

from html import unescape

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as TX
from ..functions.fixed import (
    ALLOWED_TAG_PREFIXES,
    CONTRACTION_RULES,
    DEFAULT_ABBREVIATIONS,
    DEFAULT_EMOTICONS,
    SPARK_ENGLISH_STOPWORDS,
)
from ..functions.lexicon import (
    LONG_FOLD,
    MAX_FOLD,
    ascii_text,
    fold_pairs,
    is_large,
    lexicon_pairs,
    literals_replaced,
    lookup_tokens,
    lookup_words,
    map_literal,
    ordered_replace,
    probe,
    tokens_replaced,
)
from ..operators.lexicon_ops import tag_filter_step, token_lookup_steps, word_lookup_steps


def _head(text, emoticons, html_mode) -> Column:
    t = TX.lower_text(text)
    t = TX.replace_url(t)
    t = TX.strip_ws(t)
    t = TX.html_unescape(t, html_mode)
    t = TX.remove_unicode(t)
    return ordered_replace(t, emoticons, ascii_input=True)


def _tail(t) -> Column:
    return TX.expand_contractions(TX.collapse_repeats(TX.strip_hashtag(TX.replace_mention(t))))


def clean_social_text(text, emoticons=DEFAULT_EMOTICONS, abbreviations=DEFAULT_ABBREVIATIONS,
                      html_mode: str = "full") -> Column:
    """Cleaned string before tokenizing (steps 1-9 of the notebook), as one Column.

    Convenient for small inputs; ``social_text_df`` computes the same value in staged projections
    so that the slang lookup (a higher-order function) does not pull the chain out of codegen.
    """
    return _tail(lookup_words(_head(text, emoticons, html_mode), abbreviations))


def social_text_steps(emoticons=DEFAULT_EMOTICONS, abbreviations=DEFAULT_ABBREVIATIONS, html_mode: str = "full"):
    """The string steps of ``clean_social_text``, one ``Column -> Column`` per projection."""
    emot = lexicon_pairs(emoticons, MAX_FOLD)
    if html_mode == "full" and len(emot) <= LONG_FOLD:  # one pass over Arrow batches
        middle = word_lookup_steps(abbreviations, before=(unescape, ascii_text, literals_replaced(fold_pairs(emot, ascii_input=True))))
    else:
        middle = [lambda c: TX.html_unescape(c, html_mode), TX.remove_unicode, lambda c: ordered_replace(c, emot, ascii_input=True), *word_lookup_steps(abbreviations)]
    return [
        TX.lower_text,
        TX.only_with(TX.replace_url, "www.", "http", "#"),
        TX.strip_ws,
        *middle,
        TX.only_with(TX.replace_mention, "@"),
        TX.only_with(TX.strip_hashtag, "#"),
        *TX.collapse_steps(),
        *TX.contraction_steps(CONTRACTION_RULES),
    ]


def social_text_df(df: DataFrame, text_col: str, out_col: str = "cleaned", emoticons=DEFAULT_EMOTICONS,
                   abbreviations=DEFAULT_ABBREVIATIONS, html_mode: str = "full", keep=None) -> DataFrame:
    """``df`` plus ``out_col``, the cleaned string; narrow projections only."""
    return TX.run_steps(df, text_col, social_text_steps(emoticons, abbreviations, html_mode), out_col, keep)


def pos_filter(tokens, pos_lexicon, default_tag: str = "NN", allowed=ALLOWED_TAG_PREFIXES) -> Column:
    """Keep tokens whose tag starts with an allowed prefix; tags come from a ``(token, tag)`` lexicon
    (unknown tokens take ``default_tag``).  Re-aimed from a trained tagger, which we do not ship."""
    pairs = lexicon_pairs(pos_lexicon)
    allowed_arr = F.array(*[F.lit(a) for a in allowed])
    tag = (lambda w: F.coalesce(probe(w, pairs, map_literal(pairs)), F.lit(default_tag))) if pairs else (lambda w: F.lit(default_tag))
    return F.filter(TX._col(tokens), lambda w: F.array_contains(allowed_arr, F.substring(tag(w), 1, 1)))


def social_tokens(cleaned, abbreviations=DEFAULT_ABBREVIATIONS, stopwords=SPARK_ENGLISH_STOPWORDS,
                  pos_lexicon=None) -> Column:
    """Steps 10-11: regex tokens, slang per token (re-split), tag filter, stop words (case-sensitive)."""
    tokens = lookup_tokens(TX.tokenize_regex(cleaned), abbreviations, resplit=True, single_words=True)
    if pos_lexicon is not None:
        tokens = pos_filter(tokens, pos_lexicon)
    return TX.remove_stopwords(tokens, stopwords, case_sensitive=True)


def social_table(abbreviations, stopwords, pos_lexicon=None, default_tag: str = "NN", allowed=ALLOWED_TAG_PREFIXES) -> dict[str, tuple]:
    """What ``social_tokens`` makes of each word that a lexicon names; the others stay (``default_tag`` is allowed)."""
    slang = {k: v.split() for k, v in lexicon_pairs(abbreviations) if v is not None}
    tags = {} if pos_lexicon is None else dict(lexicon_pairs(pos_lexicon))
    stop = set(stopwords)

    def stays(w: str) -> bool:
        tag = tags.get(w)
        return w not in stop and (default_tag if tag is None else tag)[:1] in allowed

    return {w: tuple(x for x in slang.get(w, [w]) if stays(x)) for w in {*slang, *tags, *stop}}


def clean_social(text, emoticons=DEFAULT_EMOTICONS, abbreviations=DEFAULT_ABBREVIATIONS,
                 stopwords=SPARK_ENGLISH_STOPWORDS, pos_lexicon=None, html_mode: str = "full") -> Column:
    """Text → token array (without stemming; see ``operators.stem.stem_tokens``).

    A NULL text gives an empty array (the notebook turned it into the word ``none``).
    """
    cleaned = clean_social_text(text, emoticons, abbreviations, html_mode)
    tokens = social_tokens(cleaned, abbreviations, stopwords, pos_lexicon)
    return F.coalesce(tokens, F.array().cast("array<string>"))


def social_tokens_df(df: DataFrame, text_col: str, out_col: str = "tokens", emoticons=DEFAULT_EMOTICONS,
                     abbreviations=DEFAULT_ABBREVIATIONS, stopwords=SPARK_ENGLISH_STOPWORDS, pos_lexicon=None,
                     html_mode: str = "full", keep=None) -> DataFrame:
    """``df`` plus ``out_col``: the token array of ``clean_social`` (NULL text → empty array).

    Narrow projections: the string chain runs in whole-stage codegen, the lookups and token filters in
    Arrow batches.  No shuffle, unless a lexicon is too large to send to the tasks
    (``operators.vocabulary``).
    """
    if not isinstance(abbreviations, DataFrame) or not is_large(abbreviations):
        abbreviations = lexicon_pairs(abbreviations, MAX_FOLD)
    text = social_text_steps(emoticons, abbreviations, html_mode)
    if is_large(abbreviations) or (pos_lexicon is not None and is_large(pos_lexicon)):
        tags = [] if pos_lexicon is None else [tag_filter_step(pos_lexicon, "NN", ALLOWED_TAG_PREFIXES)]
        tokens = [TX.tokenize_regex, *token_lookup_steps(abbreviations, True, True), *tags, lambda c: TX.remove_stopwords(c, stopwords, case_sensitive=True)]
    else:
        tokens = [tokens_replaced(social_table(abbreviations, stopwords, pos_lexicon)), lambda c: c]
    return TX.run_steps(df, text_col, text + tokens, out_col, keep, empty=F.array().cast("array<string>"))
