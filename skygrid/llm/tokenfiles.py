"""Token ids of documents in seekable zstandard files.

A file is a row of independent zstandard frames, then a skippable frame with
the document index, then the seek table of the public seekable format: sizes
and a checksum (low half of XXH64) of each frame. A reader fetches the table,
and then decompresses only the frames of the documents it wants. Frames end at
document bounds and hold about ``frame_ids`` ids; a longer document has a
frame of its own.

Documents are range-partitioned by doc_id and the text's hash and sorted, one
file a partition, so the files in order of number hold the ids in ascending
doc_id order, and rows that share a doc_id or have none may fill many files.
Frames are written to the shared folder as they fill, and a file is renamed
when complete.

Encoding: a space between two characters that are not white space always
begins a pre-token of a byte-level vocabulary, so what stands between such
spaces is encoded once by the tokenizers library and remembered, up to
``memo_limit`` entries a worker. Texts with other white space around a space
go to the library whole.

Defined cases: a null text is empty and has just the end id; null doc_ids come
first; rows of equal doc_id follow each other in order of the text's hash; any
64-bit doc_id reads back as it is; an empty table makes no files; other columns
are ignored.
"""

from __future__ import annotations

import string
import struct
import sys
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bounded_batches, cut, new_file, open_file, small, worker_state

# Fixed values of the public zstandard seekable format.
SKIPPABLE_SEEK = 0x184D2A5E
SKIPPABLE_INDEX = 0x184D2A50
SEEK_FOOTER = 0x8F92EAB1
WITH_CHECKSUMS = 0x80
#: How byte-level vocabularies write a space.
SPACE = "\u0120"

#: The document index by columns: doc_id, ids, frame, whether it has a doc_id.
INDEX = ("<i8", "<u4", "<u4", "u1")
FRAME_IDS = 1 << 16
MEMO_LIMIT = 600_000
#: ASCII marks: none is a letter, a digit or white space.
MARKS = string.punctuation
#: Letters before it are letters to every version of the character tables.
BEYOND_LATIN = "\u0250"
MANIFEST = "file_no int, path string, n_docs long, n_ids long, n_bytes long"
DOCUMENT = "file_no int, doc_id long, doc_no long, file_start long, n_tokens long, ids_crc32 long"


class Words(dict):
    """Id bytes of words with a given lead (a space or nothing) before them,
    found when first asked for; None for what texts may not be split around."""

    def __init__(self, tokenizer, kind: str, space: str, letters: dict[int, str], first: Words | None = None):
        super().__init__()
        self.kind, self.lead, self.space, self.letters, self.marks = kind, " " if space else "", space, letters, {}
        self.merge, self.encode, self.first = tokenizer.model.tokenize, tokenizer.encode, self if first is None else first

    def _plain(self, text: str) -> bytes:
        return array(self.kind, self.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: str) -> bytes | None:
        if not word or word[0].isspace() or word[-1].isspace():
            self[word] = None
            return None
        # Pre-tokens end where letters end, and before and after a line end, so
        # Latin letters and a run of marks behind them go to the library by
        # themselves, the letters to its model at once.
        core = word.rstrip(MARKS)
        left, line, right = word.partition("\n")
        if core.isalpha() and (core.isascii() or max(core) < BEYOND_LATIN):
            ids = array(self.kind, [t.id for t in self.merge(self.space + core.translate(self.letters))]).tobytes()
            if len(core) < len(word):
                marks = word[len(core) :]
                if marks not in self.marks:
                    if len(self.marks) > 10_000:
                        self.marks.clear()
                    self.marks[marks] = self._plain(marks)
                ids += self.marks[marks]
        elif line and left and right and not left[-1].isspace() and not right[0].isspace():
            ids = self[left] + self.first.line + self.first[right]
        else:
            ids = self._plain(self.lead + word)
        self[word] = ids
        return ids


class Encoder:
    """Texts to little-endian id bytes through bounded memos of words."""

    def __init__(self, path: str, memo_limit: int = MEMO_LIMIT):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.memo_limit = Tokenizer.from_file(path), memo_limit
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        kind = self.tokenizer.pre_tokenizer
        self.splits = sys.byteorder == "little" and type(kind).__name__ == "ByteLevel" and not kind.add_prefix_space and self.tokenizer.normalizer is None and not any(" " in t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        if self.splits:
            # Letters beyond ASCII as the vocabulary writes their bytes.
            written = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
            letters = {c: written(chr(c))[0][0] for c in range(128, ord(BEYOND_LATIN)) if chr(c).isalpha()}
            code = "H" if self.dtype.itemsize == 2 else "I"
            self.first = Words(self.tokenizer, code, "", letters)
            self.first.line = self._ids("\n")
            self.memo = Words(self.tokenizer, code, SPACE, letters, self.first)

    def _ids(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not self.splits:
            return [self._ids(t) for t in texts]
        for memo in (self.first, self.memo):
            if len(memo) > self.memo_limit:
                memo.clear()
        out, word, first = [], self.memo.__getitem__, self.first.__getitem__
        for text in texts:
            parts = text.split(" ")
            try:
                rest = map(word, parts)
                head = first(parts[0])
                if len(parts) > 1:
                    next(rest)  # the first word has no space before it
                    out.append(head + b"".join(rest))
                else:
                    out.append(self._ids(text) if head is None else head)
            except TypeError:  # white space beside a space
                out.append(self._ids(text))
        return out


class Writer:
    """Writes one file to a stream, frame by frame; only the open frame and
    the index (17 bytes a document) are held."""

    def __init__(self, out, dtype: np.dtype, frame_ids: int = FRAME_IDS, level: int = 1):
        import zstandard

        self.zstd, self.dtype, self.most = zstandard.ZstdCompressor(level=level), dtype, frame_ids * dtype.itemsize
        self.out, self.frames, self.open, self.held, self.n_ids, self.n_bytes = out, [], [], 0, 0, 0
        #: doc_id, ids, frame, and whether there is a doc_id.
        self.index = {"q": array("q"), "I": array("I"), "L": array("I"), "B": array("B")}

    @property
    def n_docs(self) -> int:
        return len(self.index["q"])

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.n_bytes += len(data)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.open and self.held + len(ids) > self.most:
            self._end_frame()
        for column, x in zip(self.index.values(), (doc_id or 0, len(ids) // self.dtype.itemsize, len(self.frames), doc_id is not None)):
            column.append(x)
        self.open.append(ids)
        self.held += len(ids)
        self.n_ids += len(ids) // self.dtype.itemsize

    def _end_frame(self) -> None:
        import xxhash

        data = b"".join(self.open)
        packed = self.zstd.compress(data)
        self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self._write(packed)
        self.open, self.held = [], 0

    def finish(self) -> None:
        """Writes the open frame, the index and the seek table."""
        if self.open:
            self._end_frame()
        columns = [np.asarray(c).astype(kind).tobytes() for c, kind in zip(self.index.values(), INDEX)]
        index = struct.pack("<B", self.dtype.itemsize) + self.zstd.compress(b"".join(columns))
        table = np.array(self.frames, "<u4").reshape(-1, 3).tobytes() + struct.pack("<IBI", len(self.frames), WITH_CHECKSUMS, SEEK_FOOTER)
        for part in (struct.pack("<II", SKIPPABLE_INDEX, len(index)), index, struct.pack("<II", SKIPPABLE_SEEK, len(table)), table):
            self._write(part)


class Reader:
    """Reads documents of one file, decompressing only their frames."""

    def __init__(self, uri: str):
        import zstandard

        self.file, self.zstd = open_file(uri), zstandard.ZstdDecompressor()
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_FOOTER or flags != WITH_CHECKSUMS:
            raise ValueError(f"{uri} ends without a seek table with checksums")
        table = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), "<u4").reshape(-1, 3).astype(np.int64)
        self.table, self.starts = table, np.concatenate([[0], np.cumsum(table[:, 0])])
        at = int(self.starts[-1])
        index = self._at(at + 8, struct.unpack("<I", self._at(at + 4, 4))[0])
        self.dtype = np.dtype({2: "<u2", 4: "<u4"}[index[0]])
        raw = self.zstd.decompress(index[1:])
        m = len(raw) // 17
        self.doc_id, self.n_ids, self.frame, self.named = (np.frombuffer(raw, kind, m, at * m) for kind, at in zip(INDEX, (0, 8, 12, 16)))
        self.n_ids = self.n_ids.astype(np.int64)
        first = np.concatenate([[True], self.frame[1:] != self.frame[:-1]]) if m else np.zeros(0, bool)
        before = np.cumsum(self.n_ids) - self.n_ids
        self.in_frame = before - np.maximum.accumulate(np.where(first, before, 0)) if m else before

    def _at(self, start: int, size: int) -> bytes:
        self.file.seek(start)
        return self.file.read(size)

    def read_frame(self, k: int) -> np.ndarray:
        import xxhash

        packed, size, check = self.table[k].tolist()
        data = self.zstd.decompress(self._at(int(self.starts[k]), packed), max_output_size=size)
        if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k} fails its checksum")
        return np.frombuffer(data, self.dtype)

    def document(self, i: int, frame: np.ndarray | None = None) -> np.ndarray:
        ids = self.read_frame(int(self.frame[i])) if frame is None else frame
        return ids[self.in_frame[i] : self.in_frame[i] + self.n_ids[i]]


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, files: int, frame_ids: int = FRAME_IDS) -> DataFrame:
    """Encode and write; returns the manifest, one row a file."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        held = worker_state()
        encode = held.get(("encoder", tokenizer)) or held.setdefault(("encoder", tokenizer), Encoder(tokenizer))
        end, no = np.asarray([end_id], encode.dtype).tobytes(), TaskContext.get().partitionId()
        batches = (b for b in batches if b.num_rows)
        head = next(batches, None)
        if head is not None:
            uri = f"{path}/part-{no:05d}.ids.zst"
            with new_file(uri) as out:
                writer = Writer(out, encode.dtype, frame_ids)
                for b in chain([head], batches):
                    for at in range(0, b.num_rows, 1000):
                        part = b.slice(at, 1000)
                        for doc_id, ids in zip(part["doc_id"].to_pylist(), encode([t or "" for t in part["text"].to_pylist()])):
                            writer.add(doc_id, ids + end)
                writer.finish()
            yield pa.RecordBatch.from_pylist([{"file_no": no, "path": uri, "n_docs": writer.n_docs, "n_ids": writer.n_ids, "n_bytes": writer.n_bytes}], schema=pa.schema([("file_no", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())]))

    bounded_batches(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text", F.monotonically_increasing_id().alias("row_no"))
    # Rows that are alike in all may be many: their place spreads them over files.
    dealt = d.repartitionByRange(files, "doc_id", "text_key", "row_no").sortWithinPartitions("doc_id", "text_key", "text")
    return cut(dealt.select("doc_id", "text").mapInArrow(write, MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, ids_crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for no, uri in zip(b["file_no"].to_pylist(), b["path"].to_pylist()):
                r, frame, k, sums = Reader(uri), None, -1, []
                for i in range(len(r.doc_id)):
                    if r.frame[i] != k:
                        k = int(r.frame[i])
                        frame = r.read_frame(k)
                    sums.append(zlib.crc32(r.document(i, frame).astype("<u4").tobytes()))
                n = len(sums)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, no, np.int32)), pa.array(r.doc_id, mask=r.named == 0), pa.array(np.arange(n, dtype=np.int64)),
                    pa.array(np.cumsum(r.n_ids) - r.n_ids), pa.array(r.n_ids), pa.array(np.asarray(sums, np.int64)),
                ], names=["file_no", "doc_id", "doc_no", "file_start", "n_tokens", "ids_crc32"])

    files = max(1, manifest.count())
    each = manifest.select("file_no", "path").repartition(files).mapInArrow(read, DOCUMENT)
    before = manifest.select(F.col("file_no").alias("of_file"), (F.sum("n_ids").over(W.orderBy("file_no")) - F.col("n_ids")).alias("before"))
    return each.join(small(before), F.col("file_no") == F.col("of_file")).select("doc_id", (F.col("before") + F.col("file_start")).alias("start"), "n_tokens", "ids_crc32")


def files_for(docs: DataFrame) -> int:
    """As many files as the input has splits, so a file is about a split."""
    return max(1, docs.select("doc_id", "text").rdd.getNumPartitions())
