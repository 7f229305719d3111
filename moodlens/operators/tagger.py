"""A hidden Markov tagger fitted by aggregation.

Counts of tag pairs and of words by tag come from rows of tokens with tags; without tagged text, rows are read with
a lexicon: a word with one tag is tagged, words the lexicon does not know are gaps that only their neighbours
bridge.  Costs are whole numbers (millionths of -ln p, add-one smoothed), so that a best path is exact; ties go
to the earlier tag in the order of their names.  A word without counts takes the tags of known words that end
alike: its last three letters, else two, else one, else all words.

The tag tables are small (tags squared, suffixes of the lexicon).  Word costs join by the dictionary of the
vocabulary job: each distinct word gets its row of costs once.  A row's best path is a fold over its tokens
(Viterbi), in Arrow batches.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lexicon import text_slices
from ..session import materialize
from .sizing import measure
from .vocabulary import MAX_SENT_BYTES, MAX_SENT_ROWS, distinct_words

SUFFIXES = (3, 2, 1)
MAX_TAGS = 200
UNIT = 1_000_000
PLACES, CELLS = 200_000, 8_000_000  # tokens whose paths are found together, and those times pairs of tags


def lexicon_tagged(df: DataFrame, tokens_col: str, lexicon: DataFrame) -> DataFrame:
    """``(tag, previous, word, n)``: how often a word with its tag follows a tag (null: a row's start, or a word the
    lexicon does not know), over a token column and a lexicon ``(key, value)`` of one tag a word."""
    rows = materialize(df.select(F.monotonically_increasing_id().alias("_row"), F.col(tokens_col).alias("_t")))
    tokens = rows.select("_row", F.posexplode("_t").alias("pos", "word"))
    tags = lexicon.groupBy(F.col("key").alias("word")).agg((F.max_by("value", "ord") if "ord" in lexicon.columns else F.max("value")).alias("tag"))
    known = materialize(tokens.join(tags, "word"))
    before = known.select("_row", (F.col("pos") + 1).alias("pos"), F.col("tag").alias("previous"))
    return known.join(before, ["_row", "pos"], "left").groupBy("tag", "previous", "word").agg(F.count(F.lit(1)).alias("n"))


def tagged(df: DataFrame, tokens_col: str, tags_col: str) -> DataFrame:
    """The same counts from rows with a tag per token (arrays of one length)."""
    pairs = df.select(F.arrays_zip(F.col(tokens_col).alias("w"), F.col(tags_col).alias("t"), F.concat(F.array(F.lit(None).cast("string")), F.slice(F.col(tags_col), 1, F.greatest(F.size(tags_col) - 1, F.lit(0)))).alias("p")).alias("_z"))
    z = pairs.select(F.explode("_z").alias("_p")).select("_p.*").where("t is not null")
    return z.groupBy(F.col("t").alias("tag"), F.col("p").alias("previous"), F.col("w").alias("word")).agg(F.count(F.lit(1)).alias("n"))


def _cost(share: float) -> int:
    return round(-math.log(share) * UNIT)


@dataclass
class Tagger:
    tags: list[str]
    start: np.ndarray  # cost of a first tag (or after a gap)
    step: np.ndarray  # (previous, next)
    suffixes: dict[str, np.ndarray]  # ending to costs by tag; "" for all words
    words: DataFrame  # (word, costs array<long>)

    def unknown(self, word: str) -> np.ndarray:
        for n in SUFFIXES:
            if len(word) > n and word[-n:] in self.suffixes:
                return self.suffixes[word[-n:]]
        return self.suffixes[""]

    def paths(self, costs: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The cheapest tags of rows, from the (token, tag) costs of all their tokens and the rows' sizes (1 or more).
        The longest rows come first, so that those that reach a place are the first ones: a step of the fold
        handles a place of all of them."""
        first = np.cumsum(size) - size
        order = np.argsort(-size, kind="stable")
        at, left = first[order], size[order]
        total = self.start + costs[at]
        came = np.zeros(costs.shape, np.uint8)  # of each token, by its tag: the tag before (fewer than 256 tags)
        for place in range(1, int(left[0]) if len(left) else 0):
            n = int(np.searchsorted(-left, -place, side="left"))  # rows of more than ``place`` tokens
            by = total[:n, :, None] + self.step
            best = by.argmin(axis=1)
            came[at[:n] + place] = best
            total[:n] = np.take_along_axis(by, best[:, None, :], 1)[:, 0] + costs[at[:n] + place]
        out = np.zeros(len(costs), np.int64)
        tag = total.argmin(axis=1)
        out[at + left - 1] = tag
        for place in range(int(left[0]) - 1 if len(left) else 0, 0, -1):
            n = int(np.searchsorted(-left, -place, side="left"))
            tag[:n] = came[at[:n] + place, tag[:n]]
            out[at[:n] + place - 1] = tag[:n]
        return out

    def path(self, costs: np.ndarray) -> list[int]:
        """The cheapest tags of a row, from its (token, tag) costs."""
        return self.paths(costs, np.array([len(costs)])).tolist()

    def tag_lists(self, words: pa.Array, size: np.ndarray, table: np.ndarray) -> pa.Array:
        """Tags of the tokens of rows of ``size`` tokens, null for a row of size -1: a token's costs are the row of
        ``table`` that ``words`` names."""
        names, held = pa.array(self.tags, pa.string()), np.maximum(size, 0)
        full = np.flatnonzero(held)
        tags = np.zeros(len(words), np.int64)
        ends = np.cumsum(held)
        group = (ends[full] - 1) // max(1, min(PLACES, CELLS // len(self.tags) ** 2))
        for rows in np.split(full, np.flatnonzero(np.diff(group)) + 1) if len(full) else []:
            a, b = int(ends[rows[0]] - held[rows[0]]), int(ends[rows[-1]])
            tags[a:b] = self.paths(table[words[a:b]], held[rows])
        offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32), mask=np.append(size < 0, False))
        return pa.ListArray.from_arrays(offsets, names.take(pa.array(tags)))

    def transform(self, df: DataFrame, tokens_col: str, out_col: str = "tags") -> DataFrame:
        """``df`` plus the tags of its tokens (a null array: null; a null token counts as an empty word)."""
        if df.rdd.getNumPartitions() == 0:
            return df.withColumn(out_col, F.array().cast("array<string>"))
        words = self.words
        rows, size = measure(words)
        if rows * (size // max(rows, 1) + 8 * len(self.tags)) > MAX_SENT_BYTES or rows > MAX_SENT_ROWS:
            words = materialize(words.join(distinct_words(df, tokens_col), "word", "left_semi"))
            rows, _ = measure(words)
            if rows > MAX_SENT_ROWS:
                return self._joined(df, tokens_col, out_col, words)
        known = {r["word"]: np.array(r["costs"], np.int64) for r in words.collect()}
        sent = df.sparkSession.sparkContext.broadcast(known)

        def run(batches):
            for b in batches:
                for s in text_slices(b, tokens_col):
                    tokens = s.column(tokens_col)
                    words = tokens.flatten().fill_null("").dictionary_encode()
                    own = [sent.value[w] if w in sent.value else self.unknown(w) for w in words.dictionary.to_pylist()]
                    size = tokens.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                    out = self.tag_lists(words.indices.to_numpy(), size, np.array(own, np.int64).reshape(-1, len(self.tags)))
                    yield pa.RecordBatch.from_arrays([*s.columns, out], names=[*s.schema.names, out_col])

        kept = self
        self = Tagger(kept.tags, kept.start, kept.step, kept.suffixes, None)  # what the tasks need
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", `{out_col}` array<string>"
        return df.mapInArrow(run, schema)

    def _joined(self, df: DataFrame, tokens_col: str, out_col: str, words: DataFrame) -> DataFrame:
        """Costs reach the rows by a join on the word and are gathered in order per row."""
        rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()))
        tokens = rows.select("_row", F.posexplode(tokens_col).alias("_pos", "word"))
        met = tokens.join(words, "word", "left").select("_row", F.struct("_pos", F.coalesce("word", F.lit("")).alias("word"), "costs").alias("_p"))
        gathered = met.groupBy("_row").agg(F.array_sort(F.collect_list("_p")).alias("_p"))
        light = Tagger(self.tags, self.start, self.step, self.suffixes, None)

        def run(batches):
            for b in batches:
                out = []
                for cells in b.column("_p").to_pylist():
                    costs = [light.unknown(c["word"]) if c["costs"] is None else np.array(c["costs"], np.int64) for c in cells]
                    out.append([light.tags[i] for i in light.path(np.array(costs))])
                yield pa.RecordBatch.from_arrays([b.column("_row"), pa.array(out, pa.list_(pa.string()))], names=["_row", "_tags"])

        found = gathered.mapInArrow(run, "_row long, _tags array<string>")
        empty = F.when(F.col(tokens_col).isNotNull(), F.array().cast("array<string>"))
        return rows.join(found, "_row", "left").select(*df.columns, F.coalesce("_tags", empty).alias(out_col))


def fit_tagger(counts: DataFrame) -> Tagger:
    """``counts``: (tag, previous, word, n) of :func:`tagged` or :func:`lexicon_tagged`."""
    counts = materialize(counts)
    sums = {r["tag"]: r["n"] for r in counts.groupBy("tag").agg(F.sum("n").alias("n")).orderBy("tag").limit(MAX_TAGS + 1).collect()}
    if not sums or len(sums) > MAX_TAGS:
        raise ValueError(f"a tagger needs 1 to {MAX_TAGS} tags")
    tags = list(sums)
    at, k = {t: i for i, t in enumerate(tags)}, len(tags)
    pairs = np.zeros((k + 1, k))
    for r in counts.groupBy("previous", "tag").agg(F.sum("n").alias("n")).collect():  # at most tags squared
        pairs[k if r["previous"] is None else at[r["previous"]], at[r["tag"]]] = r["n"]
    shares = (pairs + 1) / (pairs.sum(axis=1, keepdims=True) + k)
    cost = np.vectorize(_cost, otypes=[np.int64])

    # P(word | tag) up to the word's own share, which is the same for all tags: P(tag | word) / P(tag).
    total = np.array([sums[t] for t in tags], float)
    prior = total / total.sum()

    def costs(n: list[int]) -> np.ndarray:
        n = np.array(n, float)
        return cost(((n + prior) / (n.sum() + 1)) / prior)

    by_tag = [F.sum(F.when(F.col("tag") == t, F.col("n")).otherwise(0)).alias(f"c{i}") for i, t in enumerate(tags)]
    of = [f"c{i}" for i in range(k)]
    words = materialize(counts.groupBy("word").agg(*by_tag))
    n = sum(F.col(c) for c in of)
    # ln in whole millionths, as in the tables above.
    arr = F.array(*[F.round(-F.log((F.col(c) + F.lit(float(p))) / (n + 1) / F.lit(float(p))) * UNIT).cast("long") for c, p in zip(of, prior)])
    # Distinct words count for the endings, not how often each occurs: unknown words are rare ones.
    kinds = [F.sum((F.col(c) > 0).cast("long")).alias(c) for c in of]
    endings = [words.where(F.length("word") > s).select(F.expr(f"right(word, {s})").alias("ending"), *of) for s in SUFFIXES]
    ends = endings[0].unionByName(endings[1]).unionByName(endings[2]).groupBy("ending").agg(*kinds)
    ends = ends.orderBy(F.desc(sum(F.col(c) for c in of)), "ending").limit(MAX_SENT_ROWS // 10)  # the commonest endings
    suffixes = {r["ending"]: costs([r[c] for c in of]) for r in ends.collect()}
    whole = words.agg(*kinds).first()
    suffixes[""] = costs([whole[c] for c in of])
    return Tagger(tags, cost(shares[k]), cost(shares[:k]), suffixes, words.select("word", arr.alias("costs")))
