"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a byte string, the encoding that the merges give it ends in
one token, and a sequence of tokens is what the merges give exactly when each
adjacent pair is. So the last token of a prefix is the only token t such that
the prefix without t is empty or its own last token may stand before t. The
table of last tokens can be extended at the end, and after an edit it is right
again as soon as it has agreed with the old one for a token's length.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import chain

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: No limit: a whole token is never merged into another.
_NEVER = 1 << 62
#: Pieces of text and pairs of tokens that a worker remembers at a time.
PIECES, PAIRS = 200_000, 1_000_000
#: Unicode white space, which the splitting pattern means by \s.
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# Texts of these characters can be split by the faster built-in module, whose
# letters, digits and white space are the pattern's there.
_PLAIN = re.compile("[\\x00-\\x1b\\x20-\\xb1\\xb4-\\xb8\\xba\\xbb\\xbf-\\u024f]*")
_PLAIN_PIECE = re.compile(
    r" ?[^\W\d_]+| ?\d+|'(?:[stmd]|re|ve|ll)| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


class Vocabulary:
    """The tokens of a rank file, and what its merges make of bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.longest = max(map(len, ranks))
        self.names = [str(i) for i in range(len(self.tokens))]
        self._halves: dict[bytes, tuple[bytes, bytes] | None] = {}
        self._spines: dict[bytes, tuple[list, list]] = {}
        self._pairs: dict[int, bool] = {}
        self._split = regex.compile(
            pattern.replace(r"[^\s", f"[^{_WHITE}").replace(r"\S", f"[^{_WHITE}]")
            .replace(r"\s", f"[{_WHITE}]"))
        self._ends = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if self.reachable(token):
                self._ends.add_word(token.decode("latin-1"), (rank, len(token)))
        self._ends.make_automaton()
        self.pieces = _Pieces(self)

    @classmethod
    def of(cls, lines: bytes, pattern: str) -> Vocabulary:
        """From the content of a rank file: a base64 token and its rank a line."""
        rows = (line.split() for line in lines.splitlines() if line.strip())
        return cls({base64.b64decode(a): int(b) for a, b in rows}, pattern)

    def halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two tokens whose merge makes this one; None for a single byte, and
        for a token that its own bytes do not merge to."""
        if token in self._halves:
            return self._halves[token]
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(range(len(parts) - 1),
                       key=lambda i: self.ranks.get(parts[i] + parts[i + 1], _NEVER))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        found = (parts[0], parts[1]) if len(parts) == 2 else None
        self._halves[token] = found
        return found

    def reachable(self, token: bytes) -> bool:
        return len(token) == 1 or self.halves(token) is not None

    def spines(self, token: bytes) -> tuple[list, list]:
        """Down the left and down the right edge of a token's merges: (bytes, the
        rank of the merge that uses them up)."""
        found = self._spines.get(token)
        if found is None:
            found = ([], [])
            for side, out in enumerate(found):
                part, until = token, _NEVER
                while part is not None:
                    out.append((part, until))
                    until, halves = self.ranks[part], self.halves(part)
                    part = halves[side] if halves else None
            self._spines[token] = found
        return found

    def may_follow(self, a: int, b: int) -> bool:
        """Whether token b may stand after token a: no merge across their border
        comes before the merges inside that use up its two sides."""
        known = self._pairs.get(a << 32 | b)
        if known is None:
            rights, lefts = self.spines(self.tokens[a])[1], self.spines(self.tokens[b])[0]
            ranks = self.ranks
            known = True
            for x, x_until in rights:
                for y, y_until in lefts:
                    rank = ranks.get(x + y)
                    # Of equal ranks the leftmost merge comes first.
                    if rank is not None and rank < x_until and rank <= y_until:
                        known = False
            if len(self._pairs) >= PAIRS:
                self._pairs.clear()
            self._pairs[a << 32 | b] = known
        return known

    def extend(self, data: bytes, last: list[int], upto: int | None = None) -> None:
        """Add the last tokens of the prefixes from len(last) on. last[0] is -1.

        The automaton names the tokens that end at each byte, longest first.
        """
        begin, stop = len(last), len(data) if upto is None else upto
        base = max(0, begin - self.longest)
        last.extend([-1] * (stop - begin + 1))
        pairs = self._pairs
        for at, (rank, length) in self._ends.iter(data[base:stop].decode("latin-1")):
            end = base + at + 1
            if end < begin or last[end] >= 0:
                continue
            before = last[end - length]
            if end != length:
                known = pairs.get(before << 32 | rank)
                if known is None:
                    known = before >= 0 and self.may_follow(before, rank)
                if not known:
                    continue
            last[end] = rank
        if stop >= begin and -1 in last[begin:]:
            raise ValueError("a byte is in no token")

    def walk(self, data: bytes, last: list[int]) -> list[int]:
        out, end = [], len(data)
        while end:
            out.append(last[end])
            end -= len(self.tokens[last[end]])
        return out[::-1]

    def split(self, text: str) -> list[str]:
        if _PLAIN.fullmatch(text):
            return _PLAIN_PIECE.findall(text)
        return self._split.findall(text)

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.pieces.__getitem__, self.split(text))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class _Pieces(dict):
    """Pieces of text and their ids; starts anew when it is full."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> tuple[int, ...]:
        data = piece.encode()
        whole = self.vocabulary.ranks.get(data)
        if whole is not None:
            ids = (whole,)
        else:
            last = [-1]
            self.vocabulary.extend(data, last)
            ids = tuple(self.vocabulary.walk(data, last))
        if len(piece) <= 64:
            if len(self) >= PIECES:
                self.clear()
            self[piece] = ids
        return ids


class Prefixes:
    """One byte string, not split by a pattern, whose encoding follows its edits."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, data, [-1]
        vocabulary.extend(data, self.last)

    def ids(self) -> list[int]:
        return self.vocabulary.walk(self.data, self.last)

    def append(self, more: bytes) -> None:
        self.data += more
        self.vocabulary.extend(self.data, self.last)

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of data[start:stop]; how many prefixes were redone."""
        old, shift = self.last, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        self.last, agreed = old[:start + 1], 0
        for end in range(start + 1, len(self.data) + 1):
            self.vocabulary.extend(self.data, self.last, end)
            # A last token looks back over its own length alone, and over the last
            # tokens there: agreement for a longest token's length carries on.
            past = end > start + len(new) and self.last[end] == old[end - shift]
            agreed = agreed + 1 if past else 0
            if agreed > self.vocabulary.longest:
                self.last += old[end - shift + 1:]
                return end - start
        return len(self.data) - start


_LOADED: dict[str, Vocabulary] = {}


def _vocabulary(shared, pattern: str) -> Vocabulary:
    """The worker's vocabulary of a broadcast rank file, built once."""
    lines = shared.value
    key = hashlib.md5(lines + pattern.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Vocabulary.of(lines, pattern)
    return _LOADED[key]


def rank_file(name: str = "byte_bpe_multi_50k.tiktoken") -> tuple[str, str]:
    """Path and splitting pattern of a public rank file."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def _over_texts(docs: DataFrame, path: str, pattern: str, kept: list[str],
                fields: dict[str, tuple[str, pa.DataType]], row: Callable) -> DataFrame:
    """A row per document: the columns of ``kept``, then ``row(vocabulary, text)``."""
    with open(path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    source = docs.select(*kept, docs["text"].alias("__text"))
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept]
                       + [f"{name} {kind}" for name, (kind, _) in fields.items()])
    types = [kind for _, kind in fields.values()]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [row(vocabulary, t.as_py() or "") for t in part.column(len(kept))]
                columns = [pa.array(c, kind) for c, kind in
                           zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(len(kept))), *columns], [*kept, *fields])

    return source.mapInArrow(encode, schema)


def _digest(vocabulary: Vocabulary, text: str) -> tuple[int, str, str]:
    ids = vocabulary.encode(text)
    listed = ",".join(map(vocabulary.names.__getitem__, ids))
    return (len(ids), hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(vocabulary.decode(ids)).hexdigest())


def _whole(vocabulary: Vocabulary, text: str) -> tuple[int, list[int], bool]:
    ids = vocabulary.encode(text)
    return len(ids), ids, vocabulary.decode(ids) == text.encode()


def digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the bytes they decode to.

    A null text is an empty one and has no tokens.
    """
    fields = {"n_tokens": ("bigint", pa.int64()), "ids_sha256": ("string", pa.string()),
              "decoded_sha256": ("string", pa.string())}
    return _over_texts(docs, path, pattern, ["doc_id"], fields, _digest)


def tokenised(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """All columns but text, then n_tokens, ids, and whether they decode to the text."""
    kept = [c for c in docs.columns if c not in ("text", "n_tokens", "ids", "round_trip")]
    fields = {"n_tokens": ("bigint", pa.int64()), "ids": ("array<int>", pa.list_(pa.int32())),
              "round_trip": ("boolean", pa.bool_())}
    return _over_texts(docs, path, pattern, kept, fields, _whole)
