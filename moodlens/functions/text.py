"""Text-cleaning steps as ``Column -> Column`` functions.

All steps are built-in Spark expressions, so a whole cleaning chain collapses into one projection
inside whole-stage codegen.  Regexes are written once in a dialect both Java (Spark) and RE2
(the DuckDB oracle) read the same way: explicit white-space classes instead of ``\\s`` (the
scripts' ``\\s`` is Unicode-aware, Java's is not) and repetition counts instead of back-references.
"""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import posexplode_outer

from . import entities
from .fixed import COMMON_HTML_ENTITIES, CONTRACTION_RULES

# White space as Python's ``str.isspace`` sees it.
WS_CHARS = (
    r"\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WS = f"[{WS_CHARS}]"
NON_WS = f"[^{WS_CHARS}]"
WS_EACH = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
# White space as Java's ``\s`` (and Spark ML's Tokenizer) sees it.
JAVA_WS = r"[ \t\n\x0b\x0c\r]"

URL_RE = rf"(www\.{NON_WS}+)|(https?://{NON_WS}+)"
URL_PADDED_RE = r"(http://)[^ ]*|(https://)[^ ]*|( www\.)[^ ]*"
HASHTAG_RE = rf"#({NON_WS}+)"
MENTION_RE = rf"@{NON_WS}+"
ESCAPED_UNICODE_RE = r"\\u[0-9A-Fa-f]+"
NON_ASCII_RE = r"[^\x00-\x7f]"
TOKEN_RE = r"[A-Za-z0-9_']+"
NON_ALNUM_RE = r"[^a-zA-Z0-9]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def staged(df, exprs: dict, keep=None):
    """Add columns in their own projection, kept apart from the next one.

    Higher-order functions (``transform``, ``filter``) are evaluated outside whole-stage codegen and
    evaluate their input expression tree interpreted, without common-subexpression elimination.
    Each staged column is referenced twice by ``null_safe`` below, which stops ``CollapseProject``
    from inlining the (expensive) producer into the consumer, so the string chain stays in codegen.
    """
    keep = list(df.columns) if keep is None else list(keep)
    return df.select(*keep, *[e.alias(n) for n, e in exprs.items()])


class FrameStep:
    """A step of ``run_steps`` that needs the whole frame: ``fn(df, column name) -> df`` with that column changed."""

    def __init__(self, fn):
        self.fn = fn


def run_steps(df, text_col: str, steps, out_col: str, keep=None, empty=None):
    """Apply ``steps`` (``Column -> Column``, or a ``FrameStep``) one after another, keeping ``keep`` columns.

    Small projections keep every generated method well under the JIT and 64 KB limits, and a
    step's guard (``when(test(x), f(x)).otherwise(x)``) then reads a plain column, never a deep
    expression tree.  Projections stay narrow: no shuffle, one pass over the rows.
    """
    keep = [c for c in (list(df.columns) if keep is None else list(keep)) if c != out_col]
    cur = text_col
    steps = list(steps)
    for i, step in enumerate(steps):
        if isinstance(step, FrameStep):  # never the first or the last
            df = step.fn(df, cur)
            continue
        name = out_col if i == len(steps) - 1 else f"_{out_col}_{i}"
        last = i == len(steps) - 1
        df = df.select(*keep, null_safe(cur, step, empty if last else None).alias(name))
        cur = name
    return df


def keep_where(df, cond: Column):
    """Rows where ``cond`` holds, as a generator rather than a ``Filter``.

    Catalyst pushes a ``Filter`` on a derived column through every projection below it, inlining the
    column's expression, so a filter on cleaned text would run the whole cleaning chain a second
    time, at the scan and outside codegen.  A generator is never moved through projections: the
    condition is evaluated once, on the already computed column, in the same pipeline.
    """
    gate = F.explode(F.array_repeat(F.lit(0), F.when(cond, F.lit(1)).otherwise(F.lit(0))))
    return df.select("*", gate.alias("_gate")).drop("_gate")


def explode_rows(df, arr, out_col: str, keep=()):
    """``explode(arr)`` as ``keep`` columns plus ``out_col``, without an inferred pre-filter.

    For a plain ``explode`` Catalyst infers ``size(arr) > 0`` and pushes it through the projections
    below with ``arr`` inlined, computing the array twice.  ``posexplode_outer`` gets no inferred
    filter; dropping its NULL position afterwards gives exactly ``explode``'s rows (NULL elements
    inside an array are kept).
    """
    g = df.select(*keep, posexplode_outer(arr).alias("_pos", out_col))
    return g.filter(F.col("_pos").isNotNull()).drop("_pos")


def null_safe(c, fn, empty=None) -> Column:
    """``fn(c)``, NULL (or ``empty``) when ``c`` is NULL; references ``c`` twice (see ``staged``)."""
    col = _col(c)
    return F.when(col.isNull(), empty if empty is not None else F.lit(None)).otherwise(fn(col))


def lower_text(c) -> Column:
    return F.lower(_col(c))


def strip_ws(c) -> Column:
    """Strip leading and trailing white space of every kind (``trim`` alone only strips blanks)."""
    return F.trim(_col(c), F.lit(WS_EACH))


def only_with(fn, *literals: str):
    """``fn`` as a step that runs only on texts with one of ``literals``, of which every match must hold one."""

    def step(c):
        col = _col(c)
        return F.when(reduce(or_, [col.contains(x) for x in literals]), fn(col)).otherwise(col)

    return step


def replace_url(c, token: str = "URL") -> Column:
    """``www.…`` or ``http(s)://…`` up to white space becomes ``token``; then ``#word`` → ``word``."""
    return strip_hashtag(F.regexp_replace(_col(c), URL_RE, token))


def replace_url_padded(c, token: str = " URL ") -> Column:
    """Classic form: ``http://``, ``https://`` or blank + ``www.`` up to the next blank; case-sensitive."""
    return F.regexp_replace(_col(c), URL_PADDED_RE, token)


def replace_mention(c, token: str = "atUser") -> Column:
    """``@name`` up to white space becomes ``token`` (also fires inside e-mail addresses)."""
    return F.regexp_replace(_col(c), MENTION_RE, token)


def replace_mention_padded(c) -> Column:
    return replace_mention(c, " USER ")


def strip_hashtag(c) -> Column:
    return F.regexp_replace(_col(c), HASHTAG_RE, "$1")


def collapse_exclaim(c) -> Column:
    return F.regexp_replace(_col(c), r"!{2,}", " multiExclamation ")


def collapse_question(c) -> Column:
    return F.regexp_replace(_col(c), r"\?{2,}", " multiQuestion ")


def collapse_stop(c) -> Column:
    return F.regexp_replace(_col(c), r"\.{2,}", " multiStop ")


def collapse_repeats(c) -> Column:
    """Runs of two or more ``!``, ``?``, ``.``, in that order."""
    return collapse_stop(collapse_question(collapse_exclaim(c)))


def remove_unicode(c) -> Column:
    """Delete literal ``\\uXXXX`` escapes, then every non-ASCII code point."""
    return F.regexp_replace(F.regexp_replace(_col(c), ESCAPED_UNICODE_RE, ""), NON_ASCII_RE, "")


_REGEX_META = set(".^$*+?()[]{}|\\")


def _compile_rule(pattern: str, repl: str):
    r"""Java form of one rewrite rule, plus the literal every match must contain (its guard).

    ``(\w+)X`` becomes ``(\w++)X`` when X starts with a non-word character: backtracking into the
    word can then never produce a match, so the possessive form finds exactly the same matches
    without the quadratic retry inside long words (``(\w+)n't`` needs the backtrack and keeps it).
    Rules with no regex syntax become literal replaces.
    """
    if not any(ch in _REGEX_META for ch in pattern):
        return ("literal", pattern, repl, None)
    tail = pattern.rsplit(")", 1)[-1] if ")" in pattern else ""
    guard = tail if tail and not any(ch in _REGEX_META for ch in tail) else None
    if guard and not (guard[0].isalnum() or guard[0] == "_"):
        pattern = pattern.replace(r"(\w+)", r"(\w++)")
    return ("regex", pattern, repl, guard)


def expand_contractions(c, rules: Sequence[tuple[str, str]] = CONTRACTION_RULES) -> Column:
    """Ordered regex rewrite; each rule sees the output of the previous one.

    Each regex rule only runs on rows holding its literal tail (``'ll``, ``n't`` …).
    """
    out = _col(c)
    for kind, pattern, repl, guard in (_compile_rule(p, r) for p, r in rules):
        if kind == "literal":
            out = F.replace(out, F.lit(pattern), F.lit(repl))
        elif guard is None:
            out = F.regexp_replace(out, pattern, repl)
        else:
            out = F.when(out.contains(guard), F.regexp_replace(out, pattern, repl)).otherwise(out)
    return out


def contraction_steps(rules: Sequence[tuple[str, str]] = CONTRACTION_RULES) -> list:
    """``expand_contractions`` cut into steps for ``run_steps``: each guarded regex rule alone,
    runs of literal rules together."""
    steps, group = [], []
    for rule in rules:
        if _compile_rule(*rule)[0] == "literal":
            group.append(rule)
            continue
        if group:
            steps.append(lambda c, g=tuple(group): expand_contractions(c, g))
            group = []
        steps.append(lambda c, r=(rule,): expand_contractions(c, r))
    if group:
        steps.append(lambda c, g=tuple(group): expand_contractions(c, g))
    return steps


def collapse_steps() -> list:
    """``collapse_repeats`` as steps."""
    return [only_with(collapse_exclaim, "!!"), only_with(collapse_question, "??"), only_with(collapse_stop, "..")]


def keep_alnum(c) -> Column:
    """Every character outside ``[a-zA-Z0-9]`` becomes a blank."""
    return F.regexp_replace(_col(c), NON_ALNUM_RE, " ")


def replace_literals(c, pairs: Iterable[tuple[str, str]], pad: bool = False) -> Column:
    """Ordered literal (substring) replacement; ``pad`` puts one blank on both sides of values."""
    out = _col(c)
    for key, value in pairs:
        out = F.replace(out, F.lit(key), F.lit(f" {value} " if pad else value))
    return out


def html_unescape_common(c) -> Column:
    """Native decode of the common named entities (``&amp;`` last); stays in codegen."""
    col = _col(c)
    return F.when(col.contains("&"), replace_literals(col, COMMON_HTML_ENTITIES)).otherwise(col)


def html_unescape(c, mode: str = "common") -> Column:
    if mode == "common":
        return html_unescape_common(c)
    if mode == "full":
        return entities.html_unescape(_col(c))
    raise ValueError(f"unknown html mode {mode!r}")


# ---------------------------------------------------------------------------- tokens


def split_words(c) -> Column:
    """Python ``str.split()``: runs of white space, no empty tokens."""
    return F.filter(F.split(strip_ws(c), f"{WS}+"), lambda w: w != F.lit(""))


def tokenize_regex(c, pattern: str = TOKEN_RE) -> Column:
    """All non-overlapping matches of ``pattern`` (NLTK ``RegexpTokenizer`` default mode)."""
    return F.regexp_extract_all(_col(c), F.lit(f"({pattern})"), 1)


def tokenize_ws(c) -> Column:
    """Spark ML ``Tokenizer``: lower-case, split on each Java white-space character.

    Inner and leading empty tokens stay; trailing ones go (Java ``String.split``).
    """
    low = F.lower(_col(c))
    stripped = F.regexp_replace(low, f"{JAVA_WS}+$", "")
    return (
        F.when(low == "", F.array(F.lit("")))
        .when(stripped == "", F.array().cast("array<string>"))
        .otherwise(F.split(stripped, JAVA_WS))
    )


def min_length_filter(tokens, min_len: int = 2) -> Column:
    return F.filter(_col(tokens), lambda w: F.length(w) >= min_len)


def remove_stopwords(tokens, stopwords: Sequence[str], case_sensitive: bool = False) -> Column:
    """Array filter against a stop-word list; ``isin`` over many literals is planned as a hashed
    ``InSet``, so each token costs one hash probe whatever the list length."""
    if case_sensitive:
        words = list(dict.fromkeys(stopwords))
        return F.filter(_col(tokens), lambda w: ~w.isin(*words))
    words = list(dict.fromkeys(w.lower() for w in stopwords))
    return F.filter(_col(tokens), lambda w: ~F.lower(w).isin(*words))


def drop_empty(tokens) -> Column:
    return F.filter(_col(tokens), lambda w: w != F.lit(""))


def ngrams(tokens, n: int) -> Column:
    """Space-joined n-grams of consecutive tokens, like ``pyspark.ml.feature.NGram``."""
    t = _col(tokens)
    if n == 1:
        return t
    count = F.size(t) - (n - 1)
    return F.when(
        count > 0,
        F.transform(F.sequence(F.lit(1), count), lambda i: F.array_join(F.slice(t, i, n), " ")),
    ).otherwise(F.array().cast("array<string>"))


def ngrams_1_2(tokens) -> Column:
    """Unigrams followed by bigrams (``ngram_range=(1, 2)``)."""
    return F.concat(_col(tokens), ngrams(tokens, 2))


def pad_truncate(ids, length: int, pad_value: int = 0) -> Column:
    """Fixed-length id sequence: cut to ``length``, pad on the right with ``pad_value``."""
    arr = _col(ids)
    return F.slice(F.concat(arr, F.array_repeat(F.lit(pad_value), length)), 1, length)


def argmax_index(values) -> Column:
    """0-based index of the first largest element (``np.argmax``)."""
    v = _col(values)
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")
