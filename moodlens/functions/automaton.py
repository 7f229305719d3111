"""The ordered fold of literal replacements in time independent of the number of keys.

``for k, v in pairs: s = s.replace(k, v)`` touches a text once per key, though few keys occur in it.  Here one
automaton over all keys reads the text once and names the first key, in lexicon order, that occurs; that key is
replaced, and the search goes on with the keys after it in the new text, where values may have formed new keys
and shadowed ones are gone.  So a text is read once more than the number of keys that change it, and the result
is that of the fold by construction, whatever keys share, hold or shadow.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


class Fold:
    """Built once per task from its pairs; keys are distinct and not empty."""

    def __init__(self, pairs: Sequence[tuple[str, str]]):
        import ahocorasick

        self.pairs = list(pairs)
        self.keys = ahocorasick.Automaton()
        for at, (key, _) in enumerate(self.pairs):
            self.keys.add_word(key, at)
        if self.pairs:
            self.keys.make_automaton()

    def first(self, text: str, start: int) -> int | None:
        """The first pair from ``start`` whose key occurs."""
        return min((at for _, at in self.keys.iter(text) if at >= start), default=None)

    def __call__(self, text: str | None) -> str | None:
        if not text or not self.pairs:
            return text
        at = self.first(text, 0)
        while at is not None:
            key, value = self.pairs[at]
            text = text.replace(key, value)
            at = self.first(text, at + 1)
        return text


def fold_column(text: Column, pairs: Sequence[tuple[str, str]], guard: str | None = None) -> Column:
    """The fold as a column.  Only rows that match ``guard`` (all, without one) are read by the automaton."""
    pairs = list(pairs)
    built: list[Fold] = []

    @F.pandas_udf("string")
    def fold(texts: pd.Series) -> pd.Series:
        if not built:
            built.append(Fold(pairs))
        one = built[0]
        return texts.map(one, na_action="ignore")

    return fold(text) if guard is None else F.coalesce(fold(F.when(text.rlike(guard), text)), text)
