"""Lexicons as small dimension DataFrames ``(ord int, key string, value string)``.

A lexicon reaches a row in one of three shapes:

* an **ordered fold** of literal replacements, when the meaning is "replace substrings in this
  order" (emoticons, emojis): the order matters because short keys shadow longer ones;
* a **map literal** for exact-token lookup (slang by word or by token);
* a **join** when the lexicon is too large to inline (``operators.lexicon_ops``).

The first two inline the lexicon into the plan, so they collect it once on the driver; that is
only done behind a row-count bound (``max_entries``, a parameter).  Maps beyond it have a join form
(lookup, tag filter, stop words) in ``operators.lexicon_ops``; long folds run through one automaton
(``functions.automaton``) instead of a chain of calls.
"""

from __future__ import annotations

import re
from typing import Iterable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .automaton import fold_column
from .text import ESCAPED_UNICODE_RE, TOKEN_RE, WS, FrameStep, _col, split_words

LEXICON_SCHEMA = "ord int, key string, value string"
LONG_FOLD = 500  # beyond this one automaton stands for the chain of calls
MAX_FOLD = 200_000
MAX_INLINE_MAP = 20_000


def lexicon_frame(spark: SparkSession, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    rows = [(i, k, v) for i, (k, v) in enumerate(pairs)]
    return spark.createDataFrame(rows, LEXICON_SCHEMA)


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Read a lexicon CSV with header ``ord,key,value`` (keys may hold commas if quoted)."""
    return (
        spark.read.option("header", True).option("escape", '"').schema(LEXICON_SCHEMA).csv(path)
    )


def dict_order(pairs: Iterable[tuple[str, str]]) -> list[tuple[str, str]]:
    """Python ``dict`` semantics for repeated keys: first position, last value."""
    out: dict[str, str] = {}
    for k, v in pairs:
        out[k] = v
    return list(out.items())


def lexicon_pairs(lexicon, max_entries: int = MAX_INLINE_MAP) -> list[tuple[str, str]]:
    """Ordered ``(key, value)`` pairs of a lexicon DataFrame or a Python sequence.

    A DataFrame is collected only after checking it holds at most ``max_entries`` rows.
    """
    if isinstance(lexicon, DataFrame):
        rows = lexicon.select("ord", "key", "value").orderBy("ord").limit(max_entries + 1).collect()
        if len(rows) > max_entries:
            raise ValueError(
                f"lexicon has more than {max_entries} rows; use the join form in operators.lexicon_ops"
            )
        pairs = [(r["key"], r["value"]) for r in rows if r["key"] is not None and r["key"] != ""]
    else:
        pairs = [(k, v) for k, v in lexicon if k]
    return dict_order(pairs)


def is_large(lexicon, max_entries: int = MAX_INLINE_MAP) -> bool:
    """Whether a lexicon has too many keys for a map literal (a table of its own is applied as a dictionary then)."""
    if isinstance(lexicon, DataFrame):
        return lexicon.limit(max_entries + 1).count() > max_entries
    return len(lexicon) > max_entries


# ------------------------------------------------------------------------ ordered fold

_COMMON = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 ")


def hitting_class(keys: Sequence[str]) -> str | None:
    """A set of uncommon characters such that every key holds at least one (greedy cover).

    A row holding none of them cannot change under the fold, so ``rlike('[…]')`` is an exact
    guard.  ``None`` when some key is made of letters, digits and blanks only.
    """
    remaining = [set(k) - _COMMON for k in keys]
    if any(not s for s in remaining):
        return None
    chosen: list[str] = []
    while remaining:
        counts: dict[str, int] = {}
        for s in remaining:
            for ch in s:
                counts[ch] = counts.get(ch, 0) + 1
        best = max(sorted(counts), key=lambda ch: counts[ch])
        chosen.append(best)
        remaining = [s for s in remaining if best not in s]
    return "[" + "".join(_class_escape(ch) for ch in sorted(chosen)) + "]"


def _class_escape(ch: str) -> str:
    if ch.isascii() and not ch.isalnum():
        return "\\" + ch
    return ch


def fold_pairs(pairs, ascii_input: bool = False, pad: bool = False) -> list[tuple[str, str]]:
    """Pairs an ordered fold must apply.

    With ``ascii_input`` (the text is pure ASCII, as after ``remove_unicode``) and ASCII values,
    keys holding non-ASCII characters can never match and are dropped: an exact pruning.
    """
    pairs = list(pairs)
    if ascii_input and all(v.isascii() for _, v in pairs):
        pairs = [(k, v) for k, v in pairs if k.isascii()]
    return [(k, f" {v} " if pad else v) for k, v in pairs]


def ordered_replace(c, lexicon, pad: bool = False, ascii_input: bool = False,
                    max_entries: int = MAX_FOLD) -> Column:
    """Replace every key by its value, one key after another, in lexicon order.

    Equivalent to ``for k, v in d.items(): s = s.replace(k, v)``; guarded by an exact
    character-class test so rows without any candidate character skip the fold.
    """
    pairs = fold_pairs(lexicon_pairs(lexicon, max_entries), ascii_input=ascii_input, pad=pad)
    col = _col(c)
    if not pairs:
        return col
    guard = hitting_class([k for k, _ in pairs])
    if len(pairs) > LONG_FOLD:
        return fold_column(col, pairs, guard)
    out = col
    for k, v in pairs:
        out = F.replace(out, F.lit(k), F.lit(v))
    if guard is None:
        return out
    return F.when(col.rlike(guard), out).otherwise(col)


# -------------------------------------------------------------------------- map lookup


def map_literal(pairs: Sequence[tuple[str, str]]) -> Column:
    pairs = dict_order(pairs)
    if not pairs:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[F.lit(x) for kv in pairs for x in kv])


def probe(w: Column, pairs, m: Column) -> Column:
    """Value of ``w`` in the map literal ``m``, or NULL.  Map literals are searched linearly, so a
    hashed ``InSet`` membership test runs first and only hits pay for the search."""
    keys = [k for k, _ in pairs]
    return F.when(w.isin(*keys), F.try_element_at(m, w))


def lookup_words(c, lexicon, max_entries: int = MAX_INLINE_MAP) -> Column:
    """Split on white space, replace each word found in the lexicon, join with one blank."""
    pairs = lexicon_pairs(lexicon, max_entries)
    m = map_literal(pairs)
    words = split_words(c)
    if not pairs:
        return F.array_join(words, " ")
    return F.array_join(F.transform(words, lambda w: F.coalesce(probe(w, pairs, m), w)), " ")


def lookup_tokens(tokens, lexicon, resplit: bool = True, single_words: bool = False,
                  max_entries: int = MAX_INLINE_MAP) -> Column:
    """Exact lookup per token; with ``resplit`` every result is split on white space (``str.split``).

    Lexicon values are split once on the driver (``map<string, array<string>>``), so no regex runs
    per token.  Tokens not in the lexicon are split only when they hold white space or are empty;
    ``single_words`` promises they never do (regex tokens) and skips even that test.
    """
    pairs = lexicon_pairs(lexicon, max_entries)
    if not pairs and not resplit:
        return _col(tokens)
    if not resplit:
        m = map_literal(pairs)
        return F.transform(_col(tokens), lambda w: F.coalesce(probe(w, pairs, m), w))
    split_pairs = [(k, v.split()) for k, v in pairs]
    m = array_map_literal(split_pairs)

    def one(w):
        own = F.array(w) if single_words else F.when(w.rlike(f"^$|{WS}"), split_words(w)).otherwise(F.array(w))
        return F.coalesce(probe(w, split_pairs, m), own) if pairs else own

    return F.flatten(F.transform(_col(tokens), one))


def array_map_literal(pairs: Sequence[tuple[str, list[str]]]) -> Column:
    pairs = dict_order(pairs)
    if not pairs:
        return F.create_map().cast("map<string,array<string>>")
    return F.create_map(
        *[x for k, vs in pairs for x in (F.lit(k), F.array(*[F.lit(v) for v in vs]).cast("array<string>"))]
    )


# ------------------------------------------------------------------- word rules in Arrow batches
#
# The same lookups and filters as steps of ``run_steps`` over Arrow batches: a higher-order function is
# interpreted per token in the JVM, a dictionary probe is not.  ``str.split`` and ``split_words`` agree on
# white space.


def text_slices(batch: pa.RecordBatch, column: str, size: int = 4 << 20):
    """Slices of a batch with about ``size`` bytes in ``column`` (at least one row each), so that what a step
    makes of its rows stays small."""
    col = batch.column(column)
    held = pc.binary_length(col) if pa.types.is_string(col.type) else pc.list_value_length(col)
    weight = 1 if pa.types.is_string(col.type) else 8
    group = np.cumsum(pc.fill_null(held, 0).to_numpy(zero_copy_only=False).astype(np.int64) * weight) // size
    cut = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    for a, b in zip(cut, np.append(cut[1:], len(group))):
        yield batch.slice(int(a), int(b - a))


def _text_step(fn, kind: T.DataType, made: pa.DataType) -> FrameStep:
    """``fn`` on each text of a column that becomes one of type ``kind`` (null stays null)."""

    def apply(df: DataFrame, column: str) -> DataFrame:
        schema = T.StructType([T.StructField(f.name, kind if f.name == column else f.dataType) for f in df.schema])
        names = schema.names

        def run(batches):
            for batch in batches:
                for b in text_slices(batch, column):
                    out = pa.array([None if s is None else fn(s) for s in b.column(column).to_pylist()], made)
                    yield pa.RecordBatch.from_arrays([out if n == column else b.column(n) for n in names], names=names)

        return df.mapInArrow(run, schema)

    return FrameStep(apply)


def words_replaced(lexicon, max_entries: int = MAX_INLINE_MAP, before=()) -> FrameStep:
    """What ``lookup_words`` does, after the functions ``before`` of a text."""
    table = {k: v for k, v in lexicon_pairs(lexicon, max_entries) if v is not None}
    return texts_changed(*before, lambda s: " ".join([table.get(w, w) for w in s.split()]))


def texts_changed(*functions) -> FrameStep:
    """Functions of a text, one after another."""

    def run(s: str) -> str:
        for f in functions:
            s = f(s)
        return s

    return _text_step(run, T.StringType(), pa.string())


def literals_replaced(pairs: Sequence[tuple[str, str]]):
    """The ordered fold as a function of a text."""
    pairs = list(pairs)

    def fold(s: str) -> str:
        for k, v in pairs:
            s = s.replace(k, v)
        return s

    return fold


_ESCAPED = re.compile(ESCAPED_UNICODE_RE)


def ascii_text(s: str) -> str:
    """What ``remove_unicode`` does."""
    if "\\u" in s:
        s = _ESCAPED.sub("", s)
    return s if s.isascii() else s.encode("ascii", "ignore").decode()


def words_kept(stopwords: Sequence[str], min_len: int = 2, before=()) -> FrameStep:
    """Runs of ASCII letters and digits, lower-cased, of ``min_len`` and more, without stop words: what
    ``keep_alnum``, ``split_words``, ``min_length_filter`` and ``remove_stopwords`` do, after the functions
    ``before`` of a text."""
    stop = frozenset(stopwords)
    find = re.compile("[a-zA-Z0-9]{%d,}" % min_len).findall
    # Lower-cased after the cut: other letters have ASCII lower cases.

    def words(s: str) -> list[str]:
        for f in before:
            s = f(s)
        return [w for w in " ".join(find(s)).lower().split() if w not in stop]

    return _text_step(words, T.ArrayType(T.StringType()), pa.list_(pa.string()))


def tokens_replaced(table: dict[str, tuple]) -> FrameStep:
    """Regex tokens, those of ``table`` replaced by its words."""
    find = re.compile(TOKEN_RE).findall

    def row(s: str) -> list[str]:
        out: list[str] = []
        for w in find(s):
            own = table.get(w)
            if own is None:
                out.append(w)
            else:
                out.extend(own)
        return out

    return _text_step(row, T.ArrayType(T.StringType()), pa.list_(pa.string()))
