"""Byte-level BPE encoding and decoding with a sentencepiece model.

The model is serialised from the rank file: each byte string becomes a piece of
printable characters, one per byte, scored by its negative rank, and nothing is
normalised. Texts are cut into pre-tokens, each of which is encoded on its own;
ids are turned back into bytes by the inverse mapping.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Distinct stretches between spaces whose ids a worker remembers, before some texts, and
#: bytes of text that are encoded at once. A worker holds some hundred bytes for each of either.
CACHE_SIZE, FEW_BYTES = 100_000, 1_000_000


def byte_characters() -> list[str]:
    """One printable character per byte: itself, or one from 256 upwards."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    extra = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(extra)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a rank file, by rank; ranks have to be 0, 1, 2, ..."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    ranks = {int(rank): base64.b64decode(piece) for piece, rank in pairs}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"{path}: ranks have gaps or repeat")
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value & (1 << 64) - 1)


def _block(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def serialise_model(pieces: list[bytes]) -> bytes:
    """A sentencepiece BPE model of ``pieces``; the unknown piece comes last.

    Fields of the model file: 1 pieces (1 text, 2 score, 3 type), 2 trainer
    settings (3 kind of model, 40 to 43 ids of special pieces), 3 normaliser
    (1 name, 3 to 5 handling of white space).
    """
    shown = byte_characters()
    out = bytearray()
    for rank, piece in enumerate(pieces):
        text = "".join(shown[b] for b in piece).encode()
        out += _block(1, _block(1, text) + b"\x15" + struct.pack("<f", -rank) + _number(3, 1))
    out += _block(1, _block(1, b"<unk>") + b"\x15" + struct.pack("<f", 0) + _number(3, 2))
    trainer = _number(3, 2) + _number(4, len(pieces) + 1) + _number(40, len(pieces))
    out += _block(2, trainer + b"".join(_number(i, -1) for i in (41, 42, 43)))
    out += _block(3, _block(1, b"identity") + b"".join(_number(i, 0) for i in (3, 4, 5)))
    return bytes(out)


#: Marks that are a match of their own when they end a stretch after letters.
MARKS = ".,;:!?"

_ASCII_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
_SPACE = _ASCII_SPACE + "\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def spaced(text: str) -> bool:
    """Whether a space stands beside other white space or at an end of ``text``."""
    if text[:1] == " " or text[-1:] == " ":
        return True
    return any(s + " " in text or " " + s in text for s in (_ASCII_SPACE if text.isascii() else _SPACE))


def codec(pieces: list[bytes], model: bytes, pattern: str) -> Codec:
    """The process's codec, kept while its worker takes further tasks."""
    kept = sys.__dict__.setdefault("_bpe_codec", {})  # of the process; not shipped with jobs
    if kept.get("model") != (model, pattern):
        kept.update(model=(model, pattern), codec=Codec(pieces, model, pattern))
    return kept["codec"]


class Codec:
    """Encodes and decodes within one worker.

    No pre-token goes on behind a single space between two characters that are not
    white space, so a text is first cut there and the ids of a stretch, which
    is mostly a word, are remembered. Stretches are cut by the pattern.
    """

    def __init__(self, pieces: list[bytes], model: bytes, pattern: str):
        import re

        import regex
        import sentencepiece

        self.pieces = pieces
        self.find = regex.compile(pattern).findall
        self.cut = re.compile(r"(?<=\S) (?=\S)").split
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.shown = dict(enumerate(byte_characters()))
        self.stretches: dict[str, bytes] = {}  # of what follows a single space
        #: A pre-token that is a piece is that piece, also where merges don't lead to it.
        self.whole: dict[str, bytes] = {}
        shown = [p.decode("latin-1").translate(self.shown) for p in pieces]
        for i, (text, ids) in enumerate(zip(shown, self.model.encode(shown, num_threads=1))):
            if ids != [i]:
                self.whole[text] = struct.pack("<I", i)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        parts = [self.cut(t) if spaced(t) else t.split(" ") for t in texts]
        heads = [p.pop(0) for p in parts]
        new = set()
        for p in parts:
            new.update(p)
        if len(self.stretches) > CACHE_SIZE:
            self.stretches.clear()
        self._learn(new.difference(self.stretches))
        get = self.stretches.__getitem__
        out = [head + b"".join(map(get, p)) for head, p in zip(self._cut_up(heads), parts)]
        for p in new:
            if len(p) > 64:
                self.stretches.pop(p)
        return out

    def _learn(self, new: set[str]) -> None:
        """Ids of stretches after a single space. Letters are one match with the space; a
        mark after them is another."""
        marks = dict(zip(MARKS, self._tokens(list(MARKS))))
        words, marked, others = set(), [], []
        for p in new:
            if p.isalpha():
                words.add(p)
            elif p[-1:] in marks and p[:-1].isalpha():
                marked.append(p)
                if p[:-1] not in self.stretches:
                    words.add(p[:-1])
            else:
                others.append(p)
        words = list(words)
        self.stretches.update(zip(words, self._tokens([" " + p for p in words])))
        for p in marked:
            self.stretches[p] = self.stretches[p[:-1]] + marks[p[-1]]
        self.stretches.update(zip(others, self._cut_up([" " + p for p in others])))

    def _cut_up(self, stretches: list[str]) -> list[bytes]:
        tokens = [self.find(s) for s in stretches]
        known = list({t for ts in tokens for t in ts})
        codes = dict(zip(known, self._tokens(known)))
        return [b"".join([codes[t] for t in ts]) for ts in tokens]

    def _tokens(self, tokens: list[str]) -> list[bytes]:
        """Ids of pre-tokens."""
        shown = self.shown
        pieces = [
            "\u0120" + t[1:] if t[:1] == " " and t[1:].isascii() and t[1:].isalpha()
            else t.encode().decode("latin-1").translate(shown) for t in tokens
        ]
        pack = struct.pack
        codes = [pack(f"<{len(ids)}I", *ids) for ids in self.model.encode(pieces, num_threads=1)]
        return [self.whole.get(p, c) for p, c in zip(pieces, codes)] if self.whole else codes

    def decode(self, ids: bytes) -> bytes:
        return b"".join([self.pieces[i] for i in memoryview(ids).cast("I")])


def pieces_of(batch: pa.RecordBatch, column: int = 1, size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose ``column`` has about ``size`` bytes, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    groups = np.cumsum(sizes.astype(np.int64)) // size
    edges = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(edges, edges[1:]):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def encode_texts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                 keep_ids: bool = True) -> DataFrame:
    """``(id, n_tokens, ids, ids_sha256, decoded_sha256)`` for every row of ``docs``.

    ``ids`` is an array of integers, left out if not ``keep_ids``. A null text is
    empty and has no tokens; rows with the same id or text each get a row; other
    columns are not looked at. The vocabulary, of a fixed size, travels with the
    job, so workers need no file. Nothing is shuffled.
    """
    pieces = read_ranks(path)
    model = serialise_model(pieces)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens bigint" + ", ids array<int>" * keep_ids
    schema += ", ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(pieces, model, pattern)
        for batch in batches:
            for part in pieces_of(batch, size=FEW_BYTES):
                codes = coder.encode([t or "" for t in part.column(1).to_pylist()])
                columns = [part.column(0), pa.array([len(c) // 4 for c in codes], pa.int64())]
                if keep_ids:
                    columns.append(pa.array([np.frombuffer(c, "<i4") for c in codes], pa.list_(pa.int32())))
                columns.append(pa.array([hashlib.sha256(c).hexdigest() for c in codes], pa.string()))
                columns.append(pa.array([hashlib.sha256(coder.decode(c)).hexdigest() for c in codes], pa.string()))
                names = [id_col, "n_tokens", *["ids"] * keep_ids, "ids_sha256", "decoded_sha256"]
                yield pa.RecordBatch.from_arrays(columns, names)
            pa.default_memory_pool().release_unused()
        coder.stretches.clear()  # the worker stays, beside those of later jobs

    return docs.select(id_col, text_col).mapInArrow(run, schema)
