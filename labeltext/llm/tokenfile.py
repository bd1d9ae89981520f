"""Token ids in seekable zstandard files.

A file is a row of independent zstandard frames and, at its end, a seek table in a
skippable frame, so every zstandard tool can read it. A document is one frame of
little-endian unsigned 32-bit ids (a very long one several); the frame before the table
is the index: document ids and how many frames each has. The table holds every frame's
compressed and plain size and a checksum (the low half of XXH64 of the plain bytes),
so counts need no decompression and a reader opens only the frames it is asked for.

Files are written by Spark's text writer, one row a file: its commit protocol makes
a lost task harmless, and any file system that Spark can write to will do.
"""

from __future__ import annotations

import gc
import json
import os
import re
import struct
import sys
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labeltext.llm.bpe import byte_characters, pieces_of

#: Fixed values of the seekable format: mark of the skippable frame, last bytes of a file, flag for checksums.
SKIPPABLE, FILE_END, HAS_CHECKSUMS = 0x184D2A5E, b"\xb1\xea\x92\x8f", 0x80

#: Compressed bytes after which a file ends, and ids in one frame at most.
FILE_BYTES, FRAME_IDS = 4 << 20, 1 << 20

#: Zstandard's level, and strings whose ids a worker remembers before a batch.
LEVEL, CACHE_SIZE = 1, 300_000

#: Stretches that the library gets as one text.
JOINED = 2_000

#: Marks that are a pre-token of their own at the end of a stretch after letters.
MARKS = ".,;:!?"

#: Fixed value: pre-tokens of byte-level tokenizers.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Ids of texts by a tokenizer of the tokenizers library, given as its JSON.

    A byte-level tokenizer never lets a pre-token go on behind a single space between
    two other characters, so texts are cut there, and every distinct stretch of a
    batch is encoded once. A stretch of Latin characters is cut on into pre-tokens, which go
    straight to the library's model and are remembered. Other stretches go to the library many
    at a time, joined by single spaces: tokens that begin with a space tell where each begins.
    Other tokenizers get whole texts.
    """

    def __init__(self, text: str):
        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core already
        self.model = Tokenizer.from_str(text)
        self.merge = self.model.model.tokenize  # of one pre-token, a character for each byte
        self.shown = dict(enumerate(byte_characters()))
        self.cut = re.compile(r"(?<=\S) (?=\S)").split
        self.find = regex.compile(PRE_TOKENS).findall
        self.latin = re.compile(r"[\t\n\r -~\u00a1-\u024f]*").fullmatch
        self.after: dict[str, bytes] = {}  # ids of what follows a space, the space included
        self.plain: dict[str, bytes] = {}  # ids of strings without a space before them
        parts = json.loads(text)
        before = parts.get("pre_tokenizer") or {}
        added = [x["content"] for x in parts.get("added_tokens") or ()]
        self.added = re.compile("|".join(map(re.escape, added))).search if added else lambda _: None
        vocabulary = self.model.get_vocab()
        self.leads = np.zeros(max(vocabulary.values(), default=0) + 1, bool)  # tokens whose first byte is a space
        self.leads[[i for t, i in vocabulary.items() if t[:1] == "\u0120" and t not in added]] = True
        self.by_stretch = (
            not any(parts.get(x) for x in ("normalizer", "truncation", "padding"))
            and before.get("type") == "ByteLevel" and before.get("use_regex", True)
            and not before.get("add_prefix_space") and not parts["model"].get("dropout")
            and not any(" " in x["content"] or x["lstrip"] or x["rstrip"] or x["single_word"]
                        for x in parts.get("added_tokens") or ())
        )

    def _by_library(self, texts: list[str]) -> list[bytes]:
        coded = self.model.encode_batch_fast(texts, add_special_tokens=False)
        return [struct.pack(f"<{len(c)}I", *c.ids) for c in coded]

    def _joined(self, stretches: list[str]) -> list[bytes]:
        """Ids of stretches, each after one space."""
        loose = [s for s in stretches if " " in s or s != s.strip() or not s]
        if loose:  # white space at an end or two spaces
            known = dict(zip(loose, self._by_library([" " + s for s in loose])))
            tight = [s for s in stretches if s not in known]
            known.update(zip(tight, self._joined(tight)))
            return [known[s] for s in stretches]
        out = []
        for i in range(0, len(stretches), JOINED):
            some = stretches[i : i + JOINED]
            ids = np.array(self.model.encode_batch_fast([" " + " ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            at = np.flatnonzero(self.leads[ids])
            if len(at) == len(some):  # a stretch has one space, so each begins at one of these
                plain, edges = ids.tobytes(), [*(4 * at).tolist(), 4 * len(ids)]
                out += [plain[a:b] for a, b in zip(edges, edges[1:])]
            else:  # a vocabulary without some bytes
                out += self._by_library([" " + s for s in some])
        return out

    def _tokens(self, tokens: Iterable[str], spaced: bool) -> dict[str, bytes]:
        """What is remembered of pre-tokens, by what follows their space if ``spaced``, with the new ``tokens``."""
        known, lead, merge, shown = self.after if spaced else self.plain, "\u0120" * spaced, self.merge, self.shown
        new = [t for t in dict.fromkeys(tokens) if t not in known]
        codes = [
            [x.id for x in merge(lead + (t if t.isascii() and t.isalpha() else t.encode().decode("latin-1").translate(shown)))]
            for t in new]
        edges = np.cumsum([0, *map(len, codes)]) * 4
        plain, edges = np.array(list(chain.from_iterable(codes)), "<u4").tobytes(), edges.tolist()
        known.update(zip(new, [plain[a:b] for a, b in zip(edges, edges[1:])]))
        return known

    def _stretches(self, stretches: list[str], spaced: bool) -> list[bytes]:
        """Ids of stretches without a single space, each after one space if ``spaced``."""
        known, lead = self.after if spaced else self.plain, " " * spaced
        if len(known) > CACHE_SIZE:  # common ones are among these
            kept = {s: known[s] for s in stretches if s in known}
            known.clear()
            known.update(kept)
        words, marked, mixed, whole = [], [], [], []
        out = list(map(known.get, stretches))
        gaps = [i for i, code in enumerate(out) if code is None]
        new = dict.fromkeys([stretches[i] for i in gaps])
        for s in new:
            if not (s.isascii() or self.latin(s)):
                whole.append(s)
            elif s.isalpha():
                words.append(s)
            elif s and s[-1] in MARKS and s[:-1].isalpha():
                marked.append(s)  # a word and its mark
            else:
                (whole if self.added(s) or not self.latin(s) else mixed).append(s)
        known.update(zip(whole, self._joined(whole) if spaced else self._by_library(whole)))
        parts = [self.find(lead + s) for s in mixed]
        after = self._tokens((t[1:] for ts in parts for t in ts if t[0] == " "), True).__getitem__
        plain = self._tokens((t for ts in parts for t in ts if t[0] != " "), False).__getitem__
        known.update(zip(mixed, [b"".join([after(t[1:]) if t[0] == " " else plain(t) for t in ts]) for ts in parts]))
        own, marks = self._tokens([*words, *[s[:-1] for s in marked]], spaced), self._tokens(MARKS, False)
        known.update([(s, own[s[:-1]] + marks[s[-1]]) for s in marked])
        for i in gaps:
            out[i] = known[stretches[i]]
        for s in new:
            if len(s) > 64:
                known.pop(s, None)
        return out

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text (null: empty) as little-endian unsigned 32-bit integers."""
        texts = texts.fill_null("")
        if not len(texts):
            return []
        gc.disable()  # nothing below makes cycles, and many small objects would be looked through again and again
        try:
            return self._by_stretch(texts) if self.by_stretch else self._by_library(texts.to_pylist())
        finally:
            gc.enable()

    def _by_stretch(self, texts: pa.Array) -> list[bytes]:
        parts = pc.split_pattern(texts, " ")
        flat = parts.flatten().dictionary_encode()
        which, bounds = flat.indices.to_numpy().copy(), parts.offsets.to_numpy() - parts.offsets[0].as_py()
        found = flat.dictionary
        # a stretch that is empty or has white space at an end tells that another cut is needed
        fine = pc.and_(pc.equal(found, pc.utf8_trim_whitespace(found)), pc.greater(pc.binary_length(found), 0))
        odd = ~fine.to_numpy(zero_copy_only=False)
        other = np.flatnonzero(np.add.reduceat(odd[which], bounds[:-1]))
        found = pc.if_else(fine, found, "x").to_numpy(zero_copy_only=False).tolist()
        heads = [found[i] for i in which[bounds[:-1]].tolist()]
        place = {h: i for i, h in enumerate(dict.fromkeys(heads), len(found))}
        which[bounds[:-1]] = [place[h] for h in heads]
        codes = self._stretches(found, True) + self._stretches(list(place), False)
        out = []
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            out.append(b"".join([codes[i] for i in which[lo:hi].tolist()]))
        for i in other.tolist():
            head, *rest = self.cut(texts[i].as_py())
            out[i] = b"".join(self._stretches([head], False) + self._stretches(rest, True))
        return out


def encoder(text: str) -> Encoder:
    """The process's encoder, kept while its worker takes further tasks."""
    kept = sys.__dict__.setdefault("_token_encoder", {})  # of the process; not shipped with jobs
    if kept.get("text") != text:
        kept.update(text=text, encoder=Encoder(text))
    return kept["encoder"]


class FileBuilder:
    """Frames of one file, in order."""

    def __init__(self):
        import zstandard

        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False)
        self.frames: list[bytes] = []
        self.table: list[bytes] = []
        self.ids: list[int | None] = []
        self.counts: list[int] = []
        self.size = 0

    def _frame(self, plain: bytes) -> None:
        import xxhash

        packed = self.packer.compress(plain)
        self.frames.append(packed)
        self.table.append(struct.pack("<III", len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.size += len(packed)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        step = 4 * FRAME_IDS
        parts = [ids[i : i + step] for i in range(0, len(ids), step)] or [b""]
        for part in parts:
            self._frame(part)
        self.ids.append(doc_id)
        self.counts.append(len(parts))

    def finish(self) -> bytes:
        """The whole file but its last four bytes, which the writer adds to every row."""
        known = np.array([i is not None for i in self.ids], np.uint8)
        ids = np.array([i or 0 for i in self.ids], "<i8")
        self._frame(ids.tobytes() + np.array(self.counts, "<u4").tobytes() + known.tobytes())
        entries = b"".join(self.table)
        return b"".join([
            *self.frames, struct.pack("<II", SKIPPABLE, len(entries) + 9), entries,
            struct.pack("<IB", len(self.table), HAS_CHECKSUMS)])


class FileReader:
    """One file; frames are decompressed when they are asked for."""

    def __init__(self, data: bytes):
        import zstandard

        self.data, self.opened = memoryview(data), 0
        self.unpacker = zstandard.ZstdDecompressor()
        if len(data) < 17 or bytes(self.data[-4:]) != FILE_END:
            raise ValueError("no seek table at the end of the file")
        n, flags = struct.unpack("<IB", self.data[-9:-4])
        start = len(data) - 17 - 12 * n
        if flags != HAS_CHECKSUMS or n < 1 or start < 0 or struct.unpack("<II", self.data[start : start + 8]) != (SKIPPABLE, 12 * n + 9):
            raise ValueError("the seek table is damaged")
        table = np.frombuffer(self.data, "<u4", 3 * n, start + 8).reshape(n, 3).astype(np.int64)
        self.packed, self.plain, self.sums = table.T
        self.at = np.cumsum(self.packed) - self.packed
        index = self.frame(n - 1)
        docs = len(index) // 13
        self.ids = np.frombuffer(index, "<i8", docs)
        self.counts = np.frombuffer(index, "<u4", docs, 8 * docs).astype(np.int64)
        self.known = np.frombuffer(index, np.uint8, docs, 12 * docs).astype(bool)
        self.first = np.cumsum(self.counts) - self.counts  # frame of each document
        edges = np.r_[0, np.cumsum(self.plain[: n - 1])] // 4
        self.start = edges[self.first]  # ids of the file before each document
        self.n_tokens = edges[self.first + self.counts] - self.start

    def frame(self, i: int) -> bytes:
        import xxhash

        self.opened += 1
        packed = self.data[self.at[i] : self.at[i] + self.packed[i]]
        plain = self.unpacker.decompress(packed, max_output_size=int(self.plain[i])) if self.plain[i] else b""
        if len(plain) != self.plain[i] or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.sums[i]:
            raise ValueError(f"checksum of frame {i} differs")
        return plain

    def document(self, i: int) -> bytes:
        return b"".join(self.frame(j) for j in range(self.first[i], self.first[i] + self.counts[i]))


def write_token_files(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int = 0, file_bytes: int = FILE_BYTES) -> None:
    """Files below ``path`` (a new folder) with the ids of every row of ``docs``, in ascending order of the id.

    ``tokenizer``: path of the tokenizer's JSON, read on the driver and sent with the job.
    Every document ends with ``end_id``; null and empty texts have nothing else. Ids
    are integers; rows with a null id come first; rows with the same id follow one
    another by a hash of the text. Other columns are not looked at. An empty table
    gives no documents. Texts are shuffled once, by ranges of the id and (so that a
    hot id is split) the hash and place of the row.
    """
    with open(tokenizer, encoding="utf-8") as file:
        model = file.read()
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ["id", "mark", "row"]
    named = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"),
        F.xxhash64(F.col(text_col)).alias("mark"), F.monotonically_increasing_id().alias("row"))
    ordered = named.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, file = encoder(model), FileBuilder()
        whole = lambda: pa.RecordBatch.from_arrays([pa.array([file.finish()], pa.binary())], ["value"])
        for batch in batches:
            for part in pieces_of(batch, size=3_000_000):
                codes = coder.encode(part.column(1))
                for doc_id, code in zip(part.column(0).to_pylist(), codes):
                    file.add(doc_id, code + end)
                    if file.size >= file_bytes:
                        yield whole()
                        file = FileBuilder()
        if file.ids:
            yield whole()

    files = ordered.select("id", "text").mapInArrow(run, "value binary").select(F.col("value").cast("string"))
    # a row is a file, and what the writer puts after a row is the end of the seek table
    files.write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option(
        "lineSep", FILE_END.decode("latin-1")).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """``(part, number, content)``: the files in the order of their documents."""
    files = spark.read.format("binaryFile").load(path).where("length > 0")
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(
        F.regexp_extract(name, r"^part-(\d+)-", 1).cast("bigint").alias("part"),
        F.regexp_extract(name, r"-c(\d+)\.", 1).cast("bigint").alias("number"), "content")


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = []
        for table in batch.column(2).to_pylist():
            n = len(table) // 12
            ids.append(int(np.frombuffer(table, "<u4", 3 * (n - 1)).reshape(-1, 3)[:, 1].sum(dtype=np.int64)) // 4)
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(ids, pa.int64())], ["part", "number", "n_ids"])


def file_starts(spark: SparkSession, path: str) -> DataFrame:
    """``(part, number, n_ids, start)`` per file, from the seek tables alone; ``start``: ids in the files before."""
    tail = "hex(substring(content, -9, 4))"
    swapped = f"concat(substring({tail}, 7, 2), substring({tail}, 5, 2), substring({tail}, 3, 2), substring({tail}, 1, 2))"
    frames = _files(spark, path).selectExpr("part", "number", f"cast(conv({swapped}, 16, 10) as int) as n", "content")
    tables = frames.selectExpr("part", "number", "substring(content, -(12 * n + 9), 12 * n) as table")
    sizes = tables.mapInArrow(_tables, "part bigint, number bigint, n_ids bigint")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return sizes.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id", only: Iterable[int] | None = None,
                     keep_ids: bool = True) -> DataFrame:
    """``(id, start, n_tokens, ids, ids_crc32)`` of the documents below ``path``.

    ``start``: ids of all documents before it. ``only``: the document ids wanted (sent with
    the job, so the list must fit a task); frames of others stay compressed. ``ids``, an
    array of longs, is left out if not ``keep_ids``. A frame that does not fit its
    checksum, and a file without a whole seek table, raises ``ValueError``.
    """
    wanted = None if only is None else np.unique(np.fromiter(only, np.int64))
    names = ["part", "number", id_col, "at", "n_tokens", *["ids"] * keep_ids, "ids_crc32"]
    schema = f"part bigint, number bigint, `{id_col}` bigint, at bigint, n_tokens bigint"
    schema += ", ids array<bigint>" * keep_ids + ", ids_crc32 bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, data in zip(*(batch.column(i) for i in range(3))):
                file = FileReader(data.as_buffer())
                chosen = np.arange(len(file.ids))
                if wanted is not None:
                    chosen = np.flatnonzero(file.known & np.isin(file.ids, wanted))
                for lo in range(0, len(chosen), 1000):
                    at = chosen[lo : lo + 1000]
                    plain = [file.document(i) for i in at]
                    columns = [
                        pa.array([part.as_py()] * len(at), pa.int64()), pa.array([number.as_py()] * len(at), pa.int64()),
                        pa.array(file.ids[at], mask=~file.known[at]), pa.array(file.start[at]), pa.array(file.n_tokens[at])]
                    if keep_ids:
                        columns.append(pa.array([np.frombuffer(p, "<u4").astype(np.int64) for p in plain], pa.list_(pa.int64())))
                    columns.append(pa.array([zlib.crc32(p) for p in plain], pa.int64()))
                    yield pa.RecordBatch.from_arrays(columns, names)

    rows = _files(spark, path).mapInArrow(run, schema)
    starts = file_starts(spark, path).select("part", "number", F.col("start").alias("file_start"))
    joined = rows.join(starts, ["part", "number"])
    return joined.select(
        id_col, (F.col("file_start") + F.col("at")).alias("start"), "n_tokens", *["ids"] * keep_ids, "ids_crc32")
