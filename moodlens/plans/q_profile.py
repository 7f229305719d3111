"""Queries: scans/sinks, projections, labels, profiling, terms (inventory 2.1, 2.2, 2.4, 2.6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as TX
from ..functions.fixed import CLASSIC_EMOJIS, CLASSIC_STOPWORDS, DEFAULT_ABBREVIATIONS
from ..functions.labels import class_name, label_binary, label_replace, label_ternary
from ..operators import profile, terms
from ..sources import tweets as SRC
from . import classic
from . import sqltext as S
from .catalog import register

CTE = "WITH " + S.tweets_cte()

# ------------------------------------------------------------------ minimum slice / entry

TOP_K = 1000


def top_terms(spark, sf_dir, k=TOP_K):
    df = SRC.labelled_tweets(spark, sf_dir).select(
        label_binary("Polarity").alias("label"), TX.drop_empty(TX.tokenize_ws("TweetText")).alias("words")
    )
    out = terms.top_terms_by_class(df, "label", "words", k)
    return out.select("label", F.col("rank").cast("bigint").alias("rank"), "term", "cnt", F.round("rel", 6).alias("rel"))


TERM_FREQ_SQL = f"""{CTE},
lab AS (SELECT CASE WHEN Polarity = 4 THEN 1.0 ELSE 0.0 END::DOUBLE AS label,
               list_filter({S.tokenize_ws('TweetText')}, lambda w: w <> '') AS words
        FROM tweets WHERE Polarity IS NOT NULL),
tf AS (SELECT label, term, count(*) AS cnt FROM (SELECT label, unnest(words) AS term FROM lab) GROUP BY label, term),
rel AS (SELECT label, term, cnt, cnt / max(cnt) OVER (PARTITION BY label) AS rel FROM tf)"""

register(
    "top_terms_by_class",
    f"""{TERM_FREQ_SQL}
SELECT label, rank, term, cnt, round(rel, 6) AS rel FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY cnt DESC, term ASC) AS rank FROM rel)
WHERE rank <= {TOP_K}""",
)(top_terms)


@register("term_freq_by_class", f"{TERM_FREQ_SQL}\nSELECT label, term, cnt, round(rel, 6) AS rel FROM rel")
def term_freq(spark, sf_dir):
    df = SRC.labelled_tweets(spark, sf_dir).select(
        label_binary("Polarity").alias("label"), TX.drop_empty(TX.tokenize_ws("TweetText")).alias("words")
    )
    return terms.term_freq_by_class(df, "label", "words").select("label", "term", "cnt", F.round("rel", 6).alias("rel"))


# ------------------------------------------------------------------ scans and sinks


@register("scan_csv_tweets", f"{CTE}\nSELECT * FROM tweets")
def scan_csv_tweets(spark, sf_dir):
    """Headerless CSV sink of the raw view, re-read with an explicit schema and renamed."""
    path = SRC.scratch_path(spark, "tweets-csv")
    SRC.write_tweets_csv(SRC.positional_view(spark, sf_dir), path)
    return SRC.rename_columns(SRC.scan_tweets_csv(spark, path, multi_line=True))


@register(
    "scan_csv_latin1",
    f"{CTE}\nSELECT Polarity, TweetID, \"Date\", QueryFlag, \"User\", "
    f"{S.rr('TweetText', '[^\\x00-\\x{ff}]', '?')} AS TweetText FROM tweets",
)
def scan_csv_latin1(spark, sf_dir):
    """ISO-8859-1 round trip: characters outside Latin-1 are written as ``?``."""
    path = SRC.scratch_path(spark, "tweets-latin1")
    SRC.write_tweets_csv(SRC.positional_view(spark, sf_dir), path, encoding="ISO-8859-1")
    return SRC.scan_tweets_latin1(spark, path, multi_line=True)


@register(
    "rename_columns",
    f"{CTE}\nSELECT * FROM tweets",
)
def rename_columns(spark, sf_dir):
    return SRC.rename_columns(SRC.positional_view(spark, sf_dir))


KEEP_SQL = f"""{CTE}
SELECT TweetText AS text, CAST(CASE WHEN Polarity = 4 THEN 1 ELSE Polarity END AS INTEGER) AS label FROM tweets"""
CLEANED_SQL = f"""{CTE}
SELECT text, label FROM (
  SELECT {S.clean_classic('TweetText', DEFAULT_ABBREVIATIONS, CLASSIC_EMOJIS, CLASSIC_STOPWORDS)} AS text,
         CAST(CASE WHEN Polarity = 4 THEN 1 ELSE Polarity END AS INTEGER) AS label
  FROM tweets WHERE Polarity IS NOT NULL) WHERE length(text) > 0"""


def _cleaned_csv(spark, sf_dir):
    """The classic cleaner's ``(text, label)`` output written as CSV with a header, read back."""
    v = SRC.labelled_tweets(spark, sf_dir).select(
        F.col("TweetText").alias("text"), label_replace("Polarity").cast("int").alias("label")
    )
    path = SRC.scratch_path(spark, "cleaned-csv")
    SRC.write_cleaned(classic.classic_dataset(v), path, fmt="csv")
    return SRC.scan_cleaned(spark, path, fmt="csv")


@register("sink_csv_cleaned", CLEANED_SQL)
def sink_csv_cleaned(spark, sf_dir):
    return _cleaned_csv(spark, sf_dir)


@register("scan_csv_header", KEEP_SQL)
def scan_csv_header(spark, sf_dir):
    """``(text, label)`` of every tweet through a CSV file with a header (re-read by name)."""
    df = SRC.tweet_view(spark, sf_dir).select(
        F.col("TweetText").alias("text"), label_replace("Polarity").cast("int").alias("label")
    )
    path = SRC.scratch_path(spark, "keep-csv")
    SRC.write_cleaned(df, path, fmt="csv")
    return SRC.scan_cleaned(spark, path, fmt="csv", multi_line=True)


@register("rows_to_records", CLEANED_SQL)
def rows_to_records(spark, sf_dir):
    """Records ``{text, label}`` for a downstream trainer: a projection, no driver iteration."""
    return _cleaned_csv(spark, sf_dir).select("text", "label")


@register(
    "inspect_schema",
    f"""{CTE}
SELECT * FROM (VALUES (0, 'Polarity', 'int'), (1, 'TweetID', 'bigint'), (2, 'Date', 'string'),
  (3, 'QueryFlag', 'string'), (4, 'User', 'string'), (5, 'TweetText', 'string')) v(position, name, type)
JOIN (SELECT unnest([0, 1, 2, 3, 4, 5]) AS position,
             unnest([count(Polarity), count(TweetID), count("Date"), count(QueryFlag), count("User"), count(TweetText)]) AS non_null
      FROM tweets) USING (position)""",
)
def inspect_schema(spark, sf_dir):
    return profile.inspect_schema(SRC.tweet_view(spark, sf_dir))


@register("collect_columns", f"{CTE}\nSELECT TweetText AS text, Polarity AS label FROM tweets")
def collect_columns(spark, sf_dir):
    """Keep the two columns distributed (no driver-side lists)."""
    return SRC.tweet_view(spark, sf_dir).select(F.col("TweetText").alias("text"), F.col("Polarity").alias("label"))


# ------------------------------------------------------------------ projections and labels


@register("drop_columns", f"{CTE}\nSELECT Polarity, TweetText FROM tweets")
def drop_columns(spark, sf_dir):
    return SRC.tweet_view(spark, sf_dir).drop("TweetID", "Date", "QueryFlag", "User")


@register(
    "keep_columns",
    f"{CTE}\nSELECT CAST(CASE WHEN Polarity = 4 THEN 1 ELSE Polarity END AS INTEGER) AS label, TweetText AS text FROM tweets",
)
def keep_columns(spark, sf_dir):
    v = SRC.tweet_view(spark, sf_dir)
    return v.select(label_replace("Polarity").cast("int").alias("label"), F.col("TweetText").alias("text"))


@register(
    "label_ternary",
    f"{CTE}\nSELECT TweetID, Polarity, CASE WHEN Polarity = 4 THEN 2.0 WHEN Polarity = 2 THEN 1.0 ELSE 0.0 END::DOUBLE AS label FROM tweets",
)
def q_label_ternary(spark, sf_dir):
    v = SRC.tweet_view(spark, sf_dir)
    return v.select("TweetID", "Polarity", label_ternary("Polarity").alias("label"))


@register(
    "label_binary",
    f"{CTE}\nSELECT TweetID, Polarity, CASE WHEN Polarity = 4 THEN 1.0 ELSE 0.0 END::DOUBLE AS label FROM tweets",
)
def q_label_binary(spark, sf_dir):
    v = SRC.tweet_view(spark, sf_dir)
    return v.select("TweetID", "Polarity", label_binary("Polarity").alias("label"))


@register(
    "label_replace",
    f"{CTE}\nSELECT TweetID, CAST(CASE WHEN Polarity = 4 THEN 1 ELSE Polarity END AS INTEGER) AS label FROM tweets",
)
def q_label_replace(spark, sf_dir):
    v = SRC.tweet_view(spark, sf_dir)
    return v.select("TweetID", label_replace("Polarity").cast("int").alias("label"))


# ------------------------------------------------------------------ profiling


@register(
    "missing_count",
    f"""{CTE}
SELECT count_if(Polarity IS NULL) AS Polarity, count_if(TweetID IS NULL) AS TweetID, count_if("Date" IS NULL) AS "Date",
       count_if(QueryFlag IS NULL) AS QueryFlag, count_if("User" IS NULL) AS "User",
       count_if(TweetText IS NULL) AS TweetText FROM tweets""",
)
def missing_count(spark, sf_dir):
    return profile.missing_count(SRC.tweet_view(spark, sf_dir))


@register(
    "row_col_count",
    f"""{CTE},
d AS (SELECT DISTINCT Polarity, TweetText FROM tweets)
SELECT 'raw' AS stage, (SELECT count(*) FROM tweets) AS n_rows, 6 AS n_cols
UNION ALL SELECT 'dedup', (SELECT count(*) FROM d), 2""",
)
def row_col_count(spark, sf_dir):
    v = SRC.tweet_view(spark, sf_dir)
    raw = profile.row_col_count(v).select(F.lit("raw").alias("stage"), "n_rows", "n_cols")
    reduced = profile.distinct_rows(v.select("Polarity", "TweetText"), digest="TweetText")
    dedup = profile.row_col_count(reduced).select(F.lit("dedup").alias("stage"), "n_rows", "n_cols")
    return raw.unionByName(dedup)


@register(
    "duplicate_groups",
    f"""{CTE}
SELECT Polarity, TweetText, count(*) AS count FROM tweets GROUP BY Polarity, TweetText HAVING count(*) > 1""",
)
def duplicate_groups(spark, sf_dir):
    v = SRC.tweet_view(spark, sf_dir).select("Polarity", "TweetText")
    return profile.duplicate_groups(v, digest="TweetText")


@register(
    "duplicate_groups_all_columns",
    f"""{CTE}
SELECT Polarity, "Date", QueryFlag, "User", TweetText, count(*) AS count FROM tweets
GROUP BY ALL HAVING count(*) > 1""",
)
def duplicate_groups_all_columns(spark, sf_dir):
    """Rows that agree in every column but the key."""
    return profile.duplicate_groups(SRC.tweet_view(spark, sf_dir).drop("TweetID"), digest="TweetText")


@register("filter_having_dups", f"""{CTE}
SELECT "User", TweetText, count(*) AS count FROM tweets GROUP BY "User", TweetText HAVING count(*) > 1""")
def filter_having_dups(spark, sf_dir):
    v = SRC.text_view(spark, sf_dir).select("User", "TweetText")
    return profile.duplicate_groups(v, digest="TweetText")


@register("drop_duplicates", f"{CTE}\nSELECT DISTINCT Polarity, TweetText FROM tweets")
def drop_duplicates(spark, sf_dir):
    v = SRC.tweet_view(spark, sf_dir).drop("TweetID", "Date", "QueryFlag", "User")
    return profile.drop_duplicates(v, text="TweetText")


@register(
    "polarity_counts",
    f"{CTE}\nSELECT Polarity, count(*) AS count FROM (SELECT DISTINCT Polarity, TweetText FROM tweets) GROUP BY Polarity",
)
def polarity_counts(spark, sf_dir):
    v = profile.distinct_rows(SRC.tweet_view(spark, sf_dir).select("Polarity", "TweetText"), digest="TweetText")
    return profile.class_counts(v, "Polarity")


@register(
    "label_counts",
    f"""{CTE}
SELECT CASE WHEN Polarity = 4 THEN 1.0 ELSE 0.0 END::DOUBLE AS label, count(*) AS count
FROM (SELECT DISTINCT Polarity, TweetText FROM tweets) GROUP BY 1""",
)
def label_counts(spark, sf_dir):
    v = profile.distinct_rows(SRC.tweet_view(spark, sf_dir).select("Polarity", "TweetText"), digest="TweetText")
    return profile.class_counts(v.select(label_binary("Polarity").alias("label")), "label")


@register(
    "order_by_count",
    f"""{CTE}
SELECT Polarity, count(*) AS count, CAST(row_number() OVER (ORDER BY count(*), Polarity NULLS FIRST) AS BIGINT) AS position
FROM tweets GROUP BY Polarity""",
)
def order_by_count(spark, sf_dir):
    from pyspark.sql import Window

    counts = profile.class_counts(SRC.tweet_view(spark, sf_dir), "Polarity")
    # The class table is tiny (one row per class): a global window over it is one small task.
    w = Window.orderBy(F.col("count"), F.col("Polarity").asc_nulls_first())
    return counts.withColumn("position", F.row_number().over(w).cast("bigint"))


@register(
    "label_distribution",
    f"""{CTE}
SELECT CAST(CASE WHEN Polarity = 4 THEN 1 ELSE Polarity END AS INTEGER) AS label,
       CASE WHEN Polarity = 4 THEN 'Positive' WHEN Polarity = 0 THEN 'Negative' END AS name, count(*) AS count
FROM tweets WHERE Polarity IS NOT NULL GROUP BY 1, 2""",
)
def label_distribution(spark, sf_dir):
    v = SRC.labelled_tweets(spark, sf_dir).select(label_replace("Polarity").cast("int").alias("label"))
    counts = profile.class_counts(v, "label")
    return counts.select("label", class_name("label").alias("name"), "count")


@register(
    "preview_head",
    f"{CTE}\nSELECT * FROM tweets ORDER BY TweetID LIMIT 5",
)
def preview_head(spark, sf_dir):
    return profile.preview(SRC.tweet_view(spark, sf_dir), "TweetID", 5)


@register(
    "preview_tail",
    f"{CTE}\nSELECT * FROM tweets ORDER BY TweetID DESC LIMIT 5",
)
def preview_tail(spark, sf_dir):
    return profile.preview(SRC.tweet_view(spark, sf_dir), "TweetID", 5, tail=True)
