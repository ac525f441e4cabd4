"""SentencePiece encoding and decoding for vocabularies of the merge type.

A text starts as single characters. An agenda holds the adjacent pairs that are a
piece, best score first and the leftmost of equal scores first; the best pair is
merged and its new neighbours join the agenda, until none is left. What then is no
piece is spelt in bytes. The agenda of a short part is a list of scores in the order
of the text; that of a long one is a heap.

Where no piece of the vocabulary reaches from one kind of character to another (the
pieces are asked, not trusted), no merge does, and a text is the pieces of its parts,
each worked out once by a worker while it remembers it. Every batch hands the parts
that were new in it to the sentencepiece library and compares the ids; ``agrees`` says
per document whether all its parts did. What each id decodes to is compared with the
library when a worker reads the model.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Callable, Iterator
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import DataFrame

#: The character that stands for a space.
MARK = "▁"
#: Parts that a worker remembers at a time, and the longest that it remembers. The
#: same length tells the parts whose agenda is a list.
PARTS, LONGEST = 300_000, 64
_NEVER = float("inf")
#: Texts of an Arrow batch that are encoded and checked together.
TOGETHER = 64


class Model:
    """The pieces of a model file, what its merges make of a text, and the library."""

    def __init__(self, content: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto.FromString(content)
        spec, norm = proto.trainer_spec, proto.normalizer_spec
        kind = proto.SentencePiece
        kinds = {p.type for p in proto.pieces}
        if (spec.model_type != spec.BPE or not spec.byte_fallback or norm.precompiled_charsmap
                or norm.remove_extra_whitespaces or not norm.escape_whitespaces
                or not norm.add_dummy_prefix or spec.treat_whitespace_as_suffix
                or kinds & {kind.USER_DEFINED, kind.UNUSED}):
            raise ValueError("only merge-type models with byte fallback and plain text are read")
        self.library = sentencepiece.SentencePieceProcessor(model_proto=content)
        listed = list(enumerate(proto.pieces))
        self.ids = {p.piece: i for i, p in listed if p.type == kind.NORMAL}
        # The heap takes the least first.
        self.cost = {p.piece: -p.score for _, p in listed if p.type == kind.NORMAL}
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in listed if p.type == kind.BYTE}
        #: The bytes that each id stands for, and whether it opens with a mark.
        self.surface = [p.piece.replace(MARK, " ").encode() for _, p in listed]
        self.marked = [p.type == kind.NORMAL and p.piece.startswith(MARK) for _, p in listed]
        for byte, i in self.byte_ids.items():
            self.surface[i] = bytes([byte])
        self.silent = {i for i, p in listed if p.type == kind.CONTROL}
        for i in self.silent:
            self.surface[i] = b""
        for i, p in listed:
            if p.type == kind.UNKNOWN:
                self.surface[i] = spec.unk_surface.encode()
        alone = self.library.decode([[i] for i in range(len(listed))], num_threads=1)
        if [self.decode([i]) for i in range(len(listed))] != alone:
            raise ValueError("the library decodes a piece of this model otherwise")
        self.names = [str(i) for i in range(len(listed))]
        self._parts = self._cut()
        self._lead = self.library.encode("\n")
        self.memory = _Memory(self)
        self.fresh: list[tuple[str, tuple[int, ...]]] = []

    def _cut(self) -> re.Pattern | None:
        """Parts of a marked text, as fine as cuts no piece: marks with letters or with
        others, or marks with what follows."""
        # What the module counts with letters but is none; beyond the pieces it does not matter.
        odd = "".join(sorted({c for c in "".join(self.ids) if c.isalnum() and not c.isalpha()}))
        letters, others = rf"[^\W\d_{odd}]+", rf"(?:[^\w{MARK}]|[\d_{odd}])+"
        fine, coarse = f"{MARK}*(?:{letters}|{others})|{MARK}+", f"{MARK}*[^{MARK}]+|{MARK}+"
        # Parts of the fine cut may open without a mark, and are checked behind a line end.
        for cut in map(re.compile, ([] if any("\n" in p for p in self.ids) else [fine]) + [coarse]):
            if all(map(cut.fullmatch, self.ids)):
                return cut
        return None

    def split(self, text: str) -> list[str]:
        """Parts of the marked text that no merge crosses."""
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        return [marked] if self._parts is None else self._parts.findall(marked)

    def merge(self, part: str) -> tuple[int, ...]:
        """The agenda: ids of one part of a marked text."""
        symbols = list(part)
        (self._merge_few if len(symbols) <= LONGEST else self._merge_many)(symbols)
        out: list[int] = []
        for symbol in symbols:
            i = self.ids.get(symbol)
            if i is not None:
                out.append(i)
            else:
                out += map(self.byte_ids.__getitem__, symbol.encode())
        return tuple(out)

    def _merge_few(self, symbols: list[str]) -> None:
        cost = self.cost.get
        agenda = [cost(a + b, _NEVER) for a, b in zip(symbols, symbols[1:])]
        while agenda:
            best = min(agenda)
            if best == _NEVER:
                break
            at = agenda.index(best)
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
            del agenda[at]
            if at:
                agenda[at - 1] = cost(symbols[at - 1] + symbols[at], _NEVER)
            if at < len(agenda):
                agenda[at] = cost(symbols[at] + symbols[at + 1], _NEVER)

    def _merge_many(self, symbols: list[str]) -> None:
        """The same on a heap and links; what was merged away is empty until the end."""
        cost, end = self.cost, len(symbols)
        before, after = list(range(-1, end - 1)), list(range(1, end + 1))
        agenda = []
        for left in range(end - 1):
            found = cost.get(symbols[left] + symbols[left + 1])
            if found is not None:
                agenda.append((found, left, left + 1, 2))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, size = heapq.heappop(agenda)
            a, b = symbols[left], symbols[right]
            if not a or not b or len(a) + len(b) != size:
                continue  # one of the two has been merged since
            symbols[left], symbols[right] = a + b, ""
            beyond = after[left] = after[right]
            if beyond < end:
                before[beyond] = left
                found = cost.get(a + b + symbols[beyond])
                if found is not None:
                    heapq.heappush(
                        agenda, (found, left, beyond, size + len(symbols[beyond])))
            earlier = before[left]
            if earlier >= 0:
                found = cost.get(symbols[earlier] + a + b)
                if found is not None:
                    heapq.heappush(
                        agenda, (found, earlier, left, len(symbols[earlier]) + size))
        symbols[:] = filter(None, symbols)

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.memory.__getitem__, self.split(text))))

    def decode(self, ids: list[int]) -> str:
        """The text of any ids; of a first piece's mark nothing remains."""
        runs = [ids]
        if not self.silent.isdisjoint(ids):
            # Bytes on two sides of an id without text are no one character.
            runs = [list(g) for silent, g in groupby(ids, self.silent.__contains__) if not silent]
        out = []
        for run in runs:
            data = b"".join(map(self.surface.__getitem__, run))
            if run and not out and self.marked[run[0]]:
                data = data[1:]
            try:
                out.append(data.decode())
            except UnicodeDecodeError:
                out.append(_each_byte(data))
        return "".join(out)

    def disagreeing(self) -> set[str]:
        """Parts worked out since the last call that the library encodes otherwise."""
        fresh, self.fresh = self.fresh, []
        # The library puts a mark before any text. A part without one stands behind a line
        # end, which is in no piece.
        texts = [part[1:].replace(MARK, " ") if part[0] == MARK else "\n" + part
                 for part, _ in fresh]
        theirs = self.library.encode(texts, num_threads=1)
        skip = len(self._lead)
        # A mark alone is the library's before an empty text, where it puts none.
        return {
            part for (part, ids), found in zip(fresh, theirs, strict=True)
            if list(ids) != (found if part[0] == MARK else found[skip:]) and part != MARK
        }


def _each_byte(data: bytes) -> str:
    """UTF-8 with a replacement character for each byte that is in no character."""
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at:at + size].decode())
            except UnicodeDecodeError:
                continue
            break
        else:
            size = 1
            out.append("�")
        at += size
    return "".join(out)


class _Memory(dict):
    """Parts of texts and their ids. When it is full it keeps what it was asked for since
    it was last full."""

    def __init__(self, model: Model):
        self.model, self.earlier = model, {}

    def __missing__(self, part: str) -> tuple[int, ...]:
        ids = self.earlier.get(part)
        if ids is None:
            ids = self.model.merge(part)
            self.model.fresh.append((part, ids))
        if len(part) <= LONGEST:
            if len(self) >= PARTS:
                self.earlier = dict(self)
                self.clear()
            self[part] = ids
        return ids


_LOADED: dict[str, Model] = {}


def _model(shared) -> Model:
    """The worker's model of a broadcast file, built once."""
    key = hashlib.md5(shared.value).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Model(shared.value)
    return _LOADED[key]


def model_file(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _over_texts(docs: DataFrame, path: str, kept: dict[str, str],
                fields: dict[str, tuple[str, pa.DataType]], row: Callable) -> DataFrame:
    """The columns ``kept`` (name: new name), then ``row(model, text, parts)`` and ``agrees``.

    The model file is what is broadcast: its size does not grow with the documents.
    """
    with open(path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    source = docs.select(*[docs[f"`{c}`"].alias(new) for c, new in kept.items()],
                         docs["text"].alias("__text"))
    schema = ", ".join([f"`{new}` {docs.schema[c].dataType.simpleString()}"
                        for c, new in kept.items()]
                       + [f"{name} {kind}" for name, (kind, _) in fields.items()]
                       + ["agrees boolean"])
    types = [kind for _, kind in fields.values()]
    names = [*kept.values(), *fields, "agrees"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared)
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                some = batch.slice(at, TOGETHER)
                texts = [t.as_py() or "" for t in some.column(len(kept))]
                rows = [row(model, text) for text in texts]
                wrong = model.disagreeing()
                agrees = [not wrong or wrong.isdisjoint(model.split(text)) for text in texts]
                columns = [pa.array(c, kind) for c, kind in
                           zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(some.column(i) for i in range(len(kept))), *columns, pa.array(agrees)],
                    names)

    return source.mapInArrow(encode, schema)


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _digest(model: Model, text: str) -> tuple[int, str, str]:
    ids = model.encode(text)
    listed = ",".join(map(model.names.__getitem__, ids))
    return len(ids), _sha(listed.encode()), _sha(model.decode(ids).encode())


def _whole(model: Model, text: str) -> tuple[int, list[int], str]:
    ids = model.encode(text)
    return len(ids), ids, model.decode(ids)


def digest(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the text they decode to, and agrees.

    A row per row of ``docs``, repeats included. A null or empty text has no tokens.
    Other columns are not read, whatever their names.
    """
    fields = {"n_tokens": ("bigint", pa.int64()), "ids_sha256": ("string", pa.string()),
              "decoded_sha256": ("string", pa.string())}
    return _over_texts(docs, path, {"doc_id": "doc_id"}, fields, _digest)


def tokenised(docs: DataFrame, path: str) -> DataFrame:
    """All columns but text, then n_tokens, ids, decoded and agrees.

    A column of ``docs`` that has one of these names is kept with ``_`` behind it.
    A mark in a text (U+2581) is a space to the vocabulary and comes back as one.
    """
    fields = {"n_tokens": ("bigint", pa.int64()), "ids": ("array<int>", pa.list_(pa.int32())),
              "decoded": ("string", pa.string())}
    kept: dict[str, str] = {}
    for c in docs.columns:
        if c != "text":
            new = c
            while new in (*fields, "agrees", "__text") or new != c and new in docs.columns:
                new += "_"
            kept[c] = new
    return _over_texts(docs, path, kept, fields, _whole)
