"""Queries: tokenizers, token filters, lexicon jobs, ids, emoji maps, stemming (inventory 2.3, 2.9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as TX
from ..functions.fixed import (
    CLASSIC_EMOJIS,
    CLASSIC_STOPWORDS,
    DEFAULT_ABBREVIATIONS,
    DEFAULT_EMOJI_ALIASES,
    DEFAULT_EMOTICONS,
    DEFAULT_LEMMAS,
    DEFAULT_POS_TAGS,
    SPARK_ENGLISH_STOPWORDS,
)
from ..functions.lexicon import dict_order, lexicon_frame, lexicon_pairs, ordered_replace
from ..functions.porter import stem
from ..operators import features as FE
from ..operators import lexicon_ops as LX
from ..operators import ppmi as PP
from ..operators import tagger as TG
from ..operators import vocabulary as V
from ..session import materialize
from ..sources import tweets as SRC
from . import social
from . import sqltext as S
from .catalog import register
from .classic_job import classic_corpus

CTE = "WITH " + S.tweets_cte()
T = "TweetText"


def _tokens_out(df, id_col, arr_col):
    return df.select(id_col, F.array_join(arr_col, "|").alias("out"), F.size(arr_col).alias("n_tokens"))


def _tokens_sql(expr, id_col="TweetID", source="tweets", cte=CTE):
    return (
        f"{cte}\nSELECT {id_col}, array_to_string(a, '|') AS out, CAST(len(a) AS INTEGER) AS n_tokens "
        f"FROM (SELECT {id_col}, {expr} AS a FROM {source})"
    )


@register("tokenize_ws", _tokens_sql(S.tokenize_ws(T)))
def q_tokenize_ws(spark, sf_dir):
    v = SRC.text_view(spark, sf_dir)
    return _tokens_out(v.select("TweetID", TX.tokenize_ws(T).alias("a")), "TweetID", "a")


@register("tokenize_regex", _tokens_sql(S.tokenize_regex(f"lower({T})")))
def q_tokenize_regex(spark, sf_dir):
    v = SRC.text_view(spark, sf_dir)
    return _tokens_out(v.select("TweetID", TX.tokenize_regex(TX.lower_text(T)).alias("a")), "TweetID", "a")


@register("min_length_filter", _tokens_sql(f"list_filter({S.split_words(S.keep_alnum(T))}, lambda w: length(w) >= 2)"))
def q_min_length(spark, sf_dir):
    v = SRC.text_view(spark, sf_dir).select("TweetID", TX.keep_alnum(T).alias("t"))
    return _tokens_out(v.select("TweetID", TX.min_length_filter(TX.split_words("t"), 2).alias("a")), "TweetID", "a")


@register("pos_filter", _tokens_sql(S.pos_filter(S.tokenize_regex(f"lower({T})"), DEFAULT_POS_TAGS)))
def q_pos_filter(spark, sf_dir):
    v = SRC.text_view(spark, sf_dir).select("TweetID", TX.tokenize_regex(TX.lower_text(T)).alias("t"))
    return _tokens_out(v.select("TweetID", social.pos_filter("t", DEFAULT_POS_TAGS).alias("a")), "TweetID", "a")


_LEMMA_SQL = S.lookup_tokens(
    f"list_filter({S.split_words(f'lower({S.keep_alnum(T)})')}, lambda w: length(w) >= 2)", DEFAULT_LEMMAS, resplit=False
)


@register("lemmatize_vocabulary", _tokens_sql(_LEMMA_SQL))
def q_lemmatize(spark, sf_dir):
    from ..functions.lexicon import lookup_tokens

    v = SRC.text_view(spark, sf_dir).select("TweetID", TX.lower_text(TX.keep_alnum(T)).alias("t"))
    words = TX.min_length_filter(TX.split_words("t"), 2)
    return _tokens_out(v.select("TweetID", lookup_tokens(words, DEFAULT_LEMMAS, resplit=False).alias("a")), "TweetID", "a")


@register("lexicon_lookup", _tokens_sql(S.lookup_tokens(S.tokenize_regex(f"lower({T})"), DEFAULT_ABBREVIATIONS)))
def q_lexicon_lookup(spark, sf_dir):
    """Slang per token through a join with the lexicon table (the large-lexicon path)."""
    v = SRC.text_view(spark, sf_dir).select("TweetID", TX.tokenize_regex(TX.lower_text(T)).alias("t"))
    lex = lexicon_frame(spark, DEFAULT_ABBREVIATIONS)
    out = LX.lexicon_lookup_join(v, "TweetID", "t", lex, "a")
    return _tokens_out(out, "TweetID", "a")


@register("stopword_anti", _tokens_sql(S.remove_stopwords(S.tokenize_regex(f"lower({T})"), SPARK_ENGLISH_STOPWORDS, True)))
def q_stopword_anti(spark, sf_dir):
    """Stop words removed by a left anti join with a stop-word table."""
    v = SRC.text_view(spark, sf_dir).select("TweetID", TX.tokenize_regex(TX.lower_text(T)).alias("t"))
    stop = spark.createDataFrame([(w,) for w in SPARK_ENGLISH_STOPWORDS], "word string")
    return _tokens_out(LX.stopword_anti_join(v, "TweetID", "t", stop, "a"), "TweetID", "a")


_REGEX_TOKENS = S.tokenize_regex(f"lower({T})")


def _corpus_lexicon(tokens, value):
    """A lexicon of all distinct tokens of the corpus: far too large to inline."""
    words = tokens.select(F.explode("t").alias("key")).distinct()
    return words.select(F.lit(0).alias("ord"), "key", value(F.col("key")).alias("value"))


@register("lemmatize_large_lexicon", _tokens_sql(f"list_transform({_REGEX_TOKENS}, lambda w: substr(w, 1, 4))"))
def q_lemmatize_large(spark, sf_dir):
    """Form -> lemma through a join; every token of the corpus has an entry (its first four letters)."""
    v = SRC.text_view(spark, sf_dir).select("TweetID", TX.tokenize_regex(TX.lower_text(T)).alias("t"))
    lex = _corpus_lexicon(v, lambda w: F.substring(w, 1, 4))
    return _tokens_out(LX.lexicon_lookup_join(v, "TweetID", "t", lex, "a", resplit=False), "TweetID", "a")


@register("pos_filter_large_lexicon", _tokens_sql(f"list_filter({_REGEX_TOKENS}, lambda w: length(w) % 2 = 0)"))
def q_pos_large(spark, sf_dir):
    """The tag filter through a join; every token of the corpus has an entry (a noun if its length is even)."""
    v = SRC.text_view(spark, sf_dir).select("TweetID", TX.tokenize_regex(TX.lower_text(T)).alias("t"))
    lex = _corpus_lexicon(v, lambda w: F.when(F.length(w) % 2 == 0, "NN").otherwise("DT"))
    return _tokens_out(LX.tag_filter_join(v, "TweetID", "t", lex, "a"), "TweetID", "a")


@register(
    "clean_social_tagged",
    _tokens_sql(S.clean_social(T, DEFAULT_EMOTICONS, DEFAULT_ABBREVIATIONS, SPARK_ENGLISH_STOPWORDS, DEFAULT_POS_TAGS)),
)
def q_clean_social_tagged(spark, sf_dir):
    """The social chain with the tag filter (stems: ``stem_vocabulary``)."""
    v = SRC.text_view(spark, sf_dir).select("TweetID", "TweetText")
    out = social.social_tokens_df(v, "TweetText", "a", pos_lexicon=DEFAULT_POS_TAGS, keep=["TweetID"])
    return _tokens_out(out, "TweetID", "a")


VOCAB_K = 30_000
SEQ_LEN = 512


@register(
    "pad_truncate_ids",
    S.classic_job_ctes(DEFAULT_ABBREVIATIONS, CLASSIC_EMOJIS,
                       CLASSIC_STOPWORDS)
    + f""",
ex AS (SELECT doc_id, unnest(words) AS term, unnest(range(len(words))) AS pos FROM corpus),
cnt AS (SELECT term, count(*) AS cnt FROM ex GROUP BY term),
topv AS (SELECT term, CAST(row_number() OVER (ORDER BY cnt DESC, term) + 1 AS INTEGER) AS id
         FROM (SELECT * FROM cnt ORDER BY cnt DESC, term LIMIT {VOCAB_K})),
ids AS (SELECT ex.doc_id, ex.pos, coalesce(topv.id, 1) AS id FROM ex LEFT JOIN topv USING (term)),
seq AS (SELECT doc_id, list(id ORDER BY pos) AS ids FROM ids GROUP BY doc_id)
SELECT c.doc_id, array_to_string((coalesce(s.ids, []::INTEGER[]) || [{', '.join(['0'] * SEQ_LEN)}])[1:{SEQ_LEN}], ',') AS input_ids
FROM corpus c LEFT JOIN seq s USING (doc_id)""",
)
def q_pad_truncate(spark, sf_dir):
    c = materialize(classic_corpus(spark, sf_dir).select("doc_id", "words"))
    ids = FE.vocabulary_ids(c, "doc_id", "words", VOCAB_K, SEQ_LEN)
    return ids.select("doc_id", F.array_join("input_ids", ",").alias("input_ids"))


def _emoji_pairs():
    return dict_order(DEFAULT_EMOJI_ALIASES)


def _inverse_pairs():
    inv: dict[str, str] = {}
    for alias, emo in DEFAULT_EMOJI_ALIASES:
        inv[emo] = alias
    return list(inv.items())


@register("emojize", f"{CTE}\nSELECT TweetID, {S.ordered_replace(T, _emoji_pairs())} AS out FROM tweets")
def q_emojize(spark, sf_dir):
    v = SRC.text_view(spark, sf_dir)
    lex = lexicon_frame(spark, DEFAULT_EMOJI_ALIASES)
    return v.select("TweetID", ordered_replace(F.col(T), lex).alias("out"))


@register(
    "demojize",
    f"{CTE}\nSELECT TweetID, {S.ordered_replace(S.ordered_replace(T, _emoji_pairs()), _inverse_pairs())} AS out FROM tweets",
)
def q_demojize(spark, sf_dir):
    """Aliases → emoji → aliases; the inverse table is a grouped aggregate (last alias wins)."""
    lex = lexicon_frame(spark, DEFAULT_EMOJI_ALIASES)
    inv = LX.invert_lexicon(lex)
    v = SRC.text_view(spark, sf_dir).select("TweetID", ordered_replace(F.col(T), lex).alias("e"))
    return TX.run_steps(v, "e", [lambda c: ordered_replace(c, inv)], "out", keep=["TweetID"])


@register("stem_vocabulary")
def q_stem(spark, sf_dir):
    """Porter stems of the social tokens (rows-only: a library-defined algorithm)."""
    v = SRC.text_view(spark, sf_dir).select("TweetID", "TweetText")
    toks = materialize(social.social_tokens_df(v, "TweetText", "a", keep=["TweetID"]))
    return _tokens_out(V.apply_word_rule(toks, "a", stem), "TweetID", "a")


#: Step 1a of Porter's rules, in SQL: sses -> ss, ies -> i, ss -> ss, s -> nothing.
_PLURAL_SQL = ("CASE WHEN suffix(w, 'sses') OR suffix(w, 'ies') THEN w[1:length(w) - 2] "
               "WHEN suffix(w, 's') AND NOT suffix(w, 'ss') THEN w[1:length(w) - 1] ELSE w END")


def _plural_rule(w):
    """The same as an expression over the dictionary."""
    short = F.when(F.endswith(w, F.lit("sses")) | F.endswith(w, F.lit("ies")), 2).when(F.endswith(w, F.lit("s")) & ~F.endswith(w, F.lit("ss")), 1).otherwise(0)
    return F.left(w, F.length(w) - short)


@register("stem_plurals", _tokens_sql(f"list_transform({_REGEX_TOKENS}, lambda w: {_PLURAL_SQL})"))
def q_stem_plurals(spark, sf_dir):
    """Step 1a of the stemmer, each distinct word handled once."""
    v = SRC.text_view(spark, sf_dir).select("TweetID", TX.tokenize_regex(TX.lower_text(T)).alias("a"))
    return _tokens_out(V.apply_word_rule(materialize(v), "a", expression=_plural_rule), "TweetID", "a")


_FORMS = " UNION ALL ".join(
    f"SELECT w, w[1:length(w) - {len(e)}] || {S.q(r)} AS f FROM words WHERE suffix(w, {S.q(e)}) AND length(w) > {len(e)}" for e, r in V.NOUN_ENDINGS
)


@register(
    "lemmatize_nouns",
    f"""{CTE},
toks AS (SELECT TweetID, {_REGEX_TOKENS} AS t FROM tweets),
words AS (SELECT DISTINCT unnest(t) AS w FROM toks),
ruled AS (SELECT w, min(printf('%08d', length(f)) || f)[9:] AS l FROM ({_FORMS}) WHERE length(f) > 1 AND f IN (SELECT w FROM words) GROUP BY w),
own(w, l) AS (VALUES {", ".join(f"({S.q(k)}, {S.q(v)})" for k, v in DEFAULT_LEMMAS)}),
lemma AS (SELECT words.w, coalesce(own.l, ruled.l, words.w) AS l FROM words LEFT JOIN own USING (w) LEFT JOIN ruled USING (w)),
ex AS (SELECT TweetID, unnest(t) AS w, unnest(range(len(t))) AS pos FROM toks),
got AS (SELECT TweetID, list(l ORDER BY pos) AS a FROM ex JOIN lemma USING (w) GROUP BY TweetID)
SELECT TweetID, array_to_string(coalesce(a, []), '|') AS out, CAST(len(coalesce(a, [])) AS INTEGER) AS n_tokens FROM toks LEFT JOIN got USING (TweetID)""",
)
def q_lemmatize_nouns(spark, sf_dir):
    """Noun lemmas: exceptions first, then detachment rules whose result is a word of the corpus."""
    v = materialize(SRC.text_view(spark, sf_dir).select("TweetID", TX.tokenize_regex(TX.lower_text(T)).alias("a")))
    lemmas = V.noun_lemmas(V.distinct_words(v, "a"), lexicon_frame(spark, DEFAULT_LEMMAS))
    return _tokens_out(V.replace_tokens(v, "a", lemmas.select("word", F.array("lemma").alias("out"))), "TweetID", "a")


@register("hmm_tags")
def q_hmm_tags(spark, sf_dir):
    """Tags by context: a hidden Markov model of the text's own tag pairs, with the words of the tag lexicon."""
    v = materialize(SRC.text_view(spark, sf_dir).select("TweetID", TX.tokenize_regex(TX.lower_text(T)).alias("a")))
    tagger = TG.fit_tagger(TG.lexicon_tagged(v, "a", lexicon_frame(spark, DEFAULT_POS_TAGS)))
    return _tokens_out(tagger.transform(v, "a", "tags"), "TweetID", "tags")


WINDOW, MIN_COUNT = 5, 5
_PAIRS_SQL = S.classic_job_ctes(DEFAULT_ABBREVIATIONS, CLASSIC_EMOJIS, CLASSIC_STOPWORDS) + f""",
places AS (SELECT doc_id, unnest(words) AS w, unnest(range(len(words))) AS pos FROM corpus),
pairs AS (SELECT least(x.w, y.w) AS a, greatest(x.w, y.w) AS b, count(*) AS n
          FROM places x JOIN (SELECT p.*, d FROM places p CROSS JOIN range(1, {WINDOW + 1}) AS r(d)) y ON x.doc_id = y.doc_id AND x.pos = y.pos - y.d GROUP BY ALL)"""


@register("cooccurrence_counts", _PAIRS_SQL + "\nSELECT a, b, n FROM pairs")
def q_cooccurrences(spark, sf_dir):
    """How often two words stand at most five places apart."""
    c = classic_corpus(spark, sf_dir).select("words")
    return PP.cooccurrences(c, "words", WINDOW)


@register(
    "sppmi_weights",
    _PAIRS_SQL + f""",
common AS (SELECT w FROM places GROUP BY w HAVING count(*) >= {MIN_COUNT}),
kept AS (SELECT * FROM pairs WHERE a IN (SELECT w FROM common) AND b IN (SELECT w FROM common)),
margins AS (SELECT w, sum(n) AS s FROM (SELECT a AS w, n FROM kept UNION ALL SELECT b, n FROM kept WHERE a <> b) GROUP BY w),
total AS (SELECT sum(s) AS t FROM margins)
SELECT a, b, round(ln(n * t / (x.s * y.s)), 6) AS m FROM kept CROSS JOIN total JOIN margins x ON x.w = a JOIN margins y ON y.w = b WHERE ln(n * t / (x.s * y.s)) > 0""",
)
def q_sppmi(spark, sf_dir):
    """Positive pointwise mutual information of words met five times or more."""
    c = materialize(classic_corpus(spark, sf_dir).select("words"))
    weights = PP.sppmi(PP.cooccurrences(c, "words", WINDOW), PP.word_counts(c, "words", MIN_COUNT))
    return weights.select("a", "b", F.round("m", 6).alias("m"))


@register("ppmi_embed")
def q_ppmi_embed(spark, sf_dir):
    """Mean PPMI vector (100 dimensions) of each cleaned tweet; no vocabulary or matrix on the driver."""
    c = materialize(classic_corpus(spark, sf_dir).select("doc_id", "words"))
    vectors = PP.embed_words(c, "words", vector_size=100, window=WINDOW, min_count=MIN_COUNT)
    return PP.embed_rows(c, "doc_id", "words", vectors, 100)
