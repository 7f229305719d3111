"""BPE encoding and decoding with a trie of the distinct words.

The words of a batch are sorted, which is the depth-first order of their trie: the path of the current
word is a stack with one state per byte, and the next word keeps the states of the prefix it shares.  The
state of a prefix is the *last token* of its encoding, kept with the encoding itself.  A token t that ends
the prefix p is its last token exactly if t may follow the last token of p without t, so each state of a
path follows from earlier ones.  "May follow" means that the merges across the border of two tokens never
come before the merges inside them.

Words of ``word_bpe_49k.json``: text between special tokens, NFC, lower case, split by the file's
pattern; a word's last byte carries the end mark ``</w>``.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import functions as F

SPACE = "\\x09-\\x0d\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Fixed: the pattern of the vocabulary file.
WORDS = regex.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[\\p{{L}}]+|[\\p{{N}}]|[^{SPACE}\\p{{L}}\\p{{N}}]+")
CACHE = 600_000  # words (and as many blank-separated strings) whose encodings a worker keeps
PART_BYTES = 1 << 20  # bytes of texts whose words are learnt together
BLANKS = regex.compile(f"[{SPACE}]+")
ODD = regex.compile("[\x1c-\x1f]")
PIECE = 1 << 20  # characters of a text that are split into words at once


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    odd = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(odd)) for b in range(256)]


class WordBpe:
    """Encoder and decoder of one vocabulary file (one per Python worker)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, end = spec["model"], spec["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_re = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        self.strings = {i: t for t, i in [*model["vocab"].items(), *self.special.items()]}
        byte_of = {c: b for b, c in enumerate(byte_chars())}
        self.vocab: tuple[dict[bytes, int], dict[bytes, int]] = ({}, {})  # inside a word; at its end
        for t, i in model["vocab"].items():
            closed = t.endswith(end) and len(t) > len(end)
            raw = bytes(byte_of[c] for c in (t[: -len(end)] if closed else t))
            self.vocab[closed][raw] = i
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        ids = model["vocab"]
        for r, (a, b) in enumerate(x.split(" ") if isinstance(x, str) else x for x in model["merges"]):
            self.rank[ids[a], ids[b]] = r
            self.parts[ids[a + b]] = (ids[a], ids[b], r)
        self._edges: dict[tuple[int, int], list[tuple[int, float]]] = {}
        self._follow: dict[int, bool] = {}
        self._real: dict[int, bool] = {}
        self.vocab = tuple({raw: t for raw, t in v.items() if self.real(t)} for v in self.vocab)
        self.longest, self.longest_end = [0] * 256, [0] * 256  # by last byte
        for longest, vocab in zip((self.longest, self.longest_end), self.vocab):
            for raw in vocab:
                longest[raw[-1]] = max(longest[raw[-1]], len(raw))
        self.raw_id = {t: array("I", [t]).tobytes() for v in self.vocab for t in v.values()}
        self.cache: dict[str, bytes] = {}
        self.strings_seen: dict[str, bytes] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The symbols on one side of a token while it is built, with the rank of the merge that ends each."""
        out = self._edges.get((token, side))
        if out is None:
            chain, ends, t = [token], [float("inf")], token
            while t in self.parts:
                ends.append(self.parts[t][2])
                t = self.parts[t][side]
                chain.append(t)
            out = self._edges[token, side] = list(zip(chain[::-1], ends[::-1]))
        return out

    def follows(self, a: int, b: int) -> bool:
        """Whether the encoding of a's and b's bytes is a, b."""
        key = a << 32 | b
        known = self._follow.get(key)
        if known is None:
            xs, ys, i, j = self._edge(a, 1), self._edge(b, 0), 0, 0
            while True:
                (x, end_x), (y, end_y) = xs[i], ys[j]
                across = self.rank.get((x, y))
                # Of merges with one rank the leftmost comes first: a's own, then the one across, then b's.
                if across is not None and across < end_x and across <= end_y:
                    known = False
                    break
                if i + 1 == len(xs) and j + 1 == len(ys):
                    known = True
                    break
                if end_x <= end_y:
                    i += 1
                else:
                    j += 1
            if len(self._follow) > 2_000_000:
                self._follow.clear()
            self._follow[key] = known
        return known

    def real(self, token: int) -> bool:
        """Whether the token's own bytes are encoded as this token."""
        known = self._real.get(token)
        if known is None:
            if token not in self.parts:
                known = True
            else:
                a, b, r = self.parts[token]
                known = self.real(a) and self.real(b) and self._first_merge(a, b) == r
            self._real[token] = known
        return known

    def _first_merge(self, a: int, b: int) -> int | None:
        """Rank of the first merge across the border of a and b."""
        xs, ys, i, j = self._edge(a, 1), self._edge(b, 0), 0, 0
        while True:
            (x, end_x), (y, end_y) = xs[i], ys[j]
            across = self.rank.get((x, y))
            if across is not None and across < end_x and across <= end_y:
                return across if i + 1 == len(xs) and j + 1 == len(ys) else None
            if i + 1 == len(xs) and j + 1 == len(ys):
                return None
            if end_x <= end_y:
                i += 1
            else:
                j += 1

    def learn(self, words: set[str]) -> None:
        """Encode words by a walk over their trie, into the cache."""
        inner, closing = self.vocab
        raw_id, follow, follows, longest, longest_end, cache = self.raw_id, self._follow, self.follows, self.longest, self.longest_end, self.cache
        path, last, done = b"", [0], [b""]  # of the first d bytes of the path: the last token, the encoding
        for word in sorted(words):  # the order of code points is that of UTF-8 bytes
            raw = word.encode()
            n = len(raw)
            shared = 0
            for x, y in zip(path, raw):
                if x != y:
                    break
                shared += 1
            shared = min(shared, n - 1)
            del last[shared + 1 :], done[shared + 1 :]
            for d in range(len(last), n):
                for k in range(min(d, longest[raw[d - 1]]), 0, -1):
                    t = inner.get(raw[d - k : d])
                    if t is not None:
                        if k < d:
                            ok = follow.get(last[d - k] << 32 | t)
                            if not (follows(last[d - k], t) if ok is None else ok):
                                continue
                        last.append(t)
                        done.append(done[d - k] + raw_id[t])
                        break
            path = raw
            for k in range(min(n, longest_end[raw[n - 1]]), 0, -1):
                t = closing.get(raw[n - k :])
                if t is not None:
                    if k < n:
                        ok = follow.get(last[n - k] << 32 | t)
                        if not (follows(last[n - k], t) if ok is None else ok):
                            continue
                    cache[word] = done[n - k] + raw_id[t]
                    break

    def parts_of(self, text: str):
        """Lists of blank-separated strings of bounded size, and the ids of special tokens between them (as bytes)."""
        at = 0
        for m in self.special_re.finditer(text):
            yield from self._split(text[at : m.start()])
            yield array("I", [self.special[m.group()]]).tobytes()
            at = m.end()
        yield from self._split(text[at:])

    @staticmethod
    def _split(text: str):
        at = 0
        while at < len(text):
            end = at + PIECE
            if end < len(text):  # blanks border words, and nothing composes with them
                end = text.rfind(" ", at + 1, end)
                end = end if end > 0 else (text.find(" ", at + PIECE) + 1 or len(text) + 1) - 1
            part = unicodedata.normalize("NFC", text[at:end]).replace("Σ", "σ").lower()
            at = end
            # split() also cuts at 0x1C-0x1F, which are no blanks of the vocabulary's pattern
            yield BLANKS.split(part) if ODD.search(part) else part.split()

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers.  The new words of all texts are learnt
        together: the more words a trie holds, the more prefixes they share."""
        strings, cache = self.strings_seen, self.cache
        split = [list(self.parts_of(t or "")) for t in texts]
        if len(strings) > CACHE:
            strings.clear()
        new = set().union(*(p for ps in split for p in ps if isinstance(p, list))).difference(strings)
        if new:
            words = {s: (s,) if s.isalpha() else (s[:-1], s[-1]) if s[-1:] in ".," and s[:-1].isalpha() else WORDS.findall(s) for s in new}
            if len(cache) > CACHE:
                cache.clear()
            self.learn({w for ws in words.values() for w in ws}.difference(cache))
            for s, ws in words.items():
                strings[s] = cache[ws[0]] if len(ws) == 1 else b"".join([cache[w] for w in ws])
        return [b"".join([p if isinstance(p, bytes) else b"".join(map(strings.__getitem__, p)) for p in ps]) for ps in split]

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> str:
        """The tokens' strings joined by a blank: the file names no decoder."""
        return " ".join(map(self.strings.__getitem__, array("I", ids)))


_LOADED: dict[str, WordBpe] = {}


def loaded(path: str) -> WordBpe:
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def forget() -> None:
    """Let the tokenizers of this worker go.  Spark gives a worker to other steps later; those call this, so that
    a worker does not hold the words of one step beside the arrays of another."""
    _LOADED.clear()


def encode_decode(docs, path: str, with_ids: bool = True):
    """Encode every text and decode its ids again.

    Input: ``doc_id``, ``text`` (others are ignored, whatever their names).  One row per input row: doc_id,
    n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit numbers), decoded_sha256 (UTF-8), and with
    ``with_ids`` the ids as binary and the decoded text.  Null and empty texts have no ids and decode to the
    empty string.  Repeated rows are encoded each; an empty table gives an empty table.  ``path`` must be
    readable on the workers.  Narrow: no shuffle; a worker keeps a bounded cache of encoded words.
    """
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string()]
    if not with_ids:
        names, kinds = names[:4], kinds[:4]
    schema = pa.schema(list(zip(names, kinds)))

    def run(batches):
        bpe = loaded(path)
        for batch in batches:
            for piece in slices(batch, size=PART_BYTES):
                rows = []
                for doc, ids in zip(piece.column("doc_id").to_pylist(), bpe.encode_all(piece.column("text").to_pylist())):
                    decoded = bpe.decode(ids)
                    raw = decoded.encode()
                    rows.append((doc, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(raw).hexdigest(), ids, decoded)[: len(names)])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], schema=schema)

    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded string" * with_ids
    return _columns(docs).mapInArrow(run, ddl)


def slices(batch: pa.RecordBatch, column: str = "text", size: int = 4 << 20):
    """Slices of a batch with about ``size`` bytes in ``column`` (at least one row each), so that what a step
    makes of its rows stays small."""
    col = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
    group = np.cumsum(col, dtype=np.int64) // size
    cut = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    for a, b in zip(cut, np.append(cut[1:], len(group))):
        yield batch.slice(int(a), int(b - a))


def _columns(docs):
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
