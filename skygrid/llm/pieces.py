"""SentencePiece (merge type) encoding by backtracking, and decoding.

A model of merge type joins the neighbouring symbols whose concatenation is
the piece of the highest score, leftmost first, until none is left. What it
ends with has one property that names it: each two neighbours, merged again by
themselves, end as these two. So no merging is needed to find it:

1. An Aho-Corasick automaton over the pieces finds all pieces of a stretch in
   one walk; at each place the longest is tried first.
2. A piece may follow another if the two, joined and merged again from single
   characters, come out as these two. The answer is remembered.
3. Where nothing may follow, the place is marked as failed in a bitfield, the
   last piece is taken back and the next shorter one tried. A stretch before a
   place has one encoding only, so a failed place fails whatever led to it,
   and each place is given up at most once.

Characters without a piece are their UTF-8 bytes' pieces. If no piece goes on
after a space mark that follows another character (checked when a model is
loaded), stretches between such marks don't touch each other and are
remembered whole; else a text is one stretch. In the same way a new stretch is
taken apart where two characters meet that are neighbours in no piece.

Defined cases: null text is empty text, and has no ids; empty tables give no
rows; equal rows are each encoded; null keys stay null; very long texts are
worked through in stretches, so only their ids are held at once; key columns
may have any name, other columns are left out. Models that are not of merge
type, or have user-defined or unused pieces or no bytes to fall back to, are
an error, as this method would not give what the library gives.
"""

from __future__ import annotations

import codecs
import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, slices, worker_state

#: How SentencePiece writes a space.
SPACE = "▁"
#: Stretches that a worker remembers before older ones fade, and pairs.
MEMO, PAIRS = 200_000, 1_000_000
#: Longer stretches are not remembered.
MEMO_CHARS = 64
#: Texts are encoded this many characters at a time, texts move on in batches
#: of this many bytes.
CHUNK, BATCH_BYTES = 1 << 20, 8 << 20

# Kinds of pieces in model files.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MERGE_TYPE = 2


def _each_byte(e: UnicodeDecodeError) -> tuple[str, int]:
    return "�", e.start + 1


codecs.register_error("skygrid_each_byte", _each_byte)


class Pieces:
    """A model's tables, and what was worked out with them."""

    def __init__(self, model: bytes):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto.FromString(model)
        if proto.trainer_spec.model_type != MERGE_TYPE or not proto.trainer_spec.byte_fallback:
            raise ValueError("the model is not of merge type with bytes to fall back to")
        if any(p.type not in (NORMAL, UNKNOWN, CONTROL, BYTE) for p in proto.pieces) or proto.denormalizer_spec.precompiled_charsmap:
            raise ValueError("the model has user-defined or unused pieces, or its own way to write texts out")
        self.processor = SentencePieceProcessor(model_proto=model)
        #: Tokens are numbers: those of normal pieces are their ids; characters
        #: without a piece get numbers after the last id when first met.
        self.text = [p.piece if p.type == NORMAL else "" for p in proto.pieces]
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.characters = {t: i for t, i in ids.items() if len(t) == 1}
        byte_ids = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.byte_ids = [byte_ids[b] for b in range(256)]
        self.out = [np.int32(i).tobytes() for i in range(len(self.text))]
        self.size = [len(t) for t in self.text]
        #: The longest shorter piece that a piece begins with, then its first
        #: character; -1 if there is none.
        self.shorter = [next((ids[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in ids), self._character(t[0]) if len(t) > 1 else -1) for t in list(self.text)]
        self.shorter += [-1] * (len(self.text) - len(self.shorter))
        self.written = [self._written(p, proto.trainer_spec.unk_surface) for p in proto.pieces]
        self.spaced = [p.type == NORMAL and p.piece.startswith(SPACE) for p in proto.pieces]
        self.extra = proto.normalizer_spec.remove_extra_whitespaces
        self.drop_first = proto.normalizer_spec.add_dummy_prefix or self.extra
        self.automaton = ahocorasick.Automaton()
        for piece, i in ids.items():
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.apart = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in ids)
        self.stretch = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+" if self.apart else r"[\s\S]+")
        #: Neighbouring characters of some piece: between others nothing merges.
        self.inside = {x for p in ids for x in zip(p, p[1:])}
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}

    @staticmethod
    def _written(p, unknown: str) -> bytes:
        if p.type == BYTE:
            return bytes([int(p.piece[1:-1], 16)])
        return b"" if p.type == CONTROL else unknown.encode() if p.type == UNKNOWN else p.piece.replace(SPACE, " ").encode()

    def _character(self, c: str) -> int:
        """The number of a character that may have no piece."""
        i = self.characters.get(c)
        if i is None:
            i = self.characters[c] = len(self.text)
            self.text.append(c)
            self.size.append(1)
            self.out.append(np.array([self.byte_ids[b] for b in c.encode()], np.int32).tobytes())
            if hasattr(self, "shorter"):
                self.shorter.append(-1)
        return i

    def stay(self, last: str, piece: str) -> bool:
        """Whether two texts, merged again from single characters, come out as
        these two; with no ``last``, whether one comes out as one."""
        parts, get = list(last + piece), self.scores.get
        joined = [get(a + b, -math.inf) for a, b in zip(parts, parts[1:])]
        seam = len(last) - 1
        while joined and (best := max(joined)) > -math.inf:
            i = joined.index(best)
            if i == seam:
                return False
            seam -= i < seam
            parts[i] += parts.pop(i + 1)
            del joined[i]
            if i:
                joined[i - 1] = get(parts[i - 1] + parts[i], -math.inf)
            if i < len(joined):
                joined[i] = get(parts[i] + parts[i + 1], -math.inf)
        return len(parts) == 1 + bool(last)

    def _may_follow(self, last: int, token: int) -> bool:
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        known = self.pairs[last << 32 | token] = self.stay(self.text[last] if last >= 0 else "", self.text[token])
        return known

    def tokens(self, text: str) -> list[int]:
        """The tokens of a stretch, by backtracking."""
        n, size, shorter, pairs = len(text), self.size, self.shorter, self.pairs
        longest = [-1] * n
        for end, token in self.automaton.iter(text):
            longest[end - size[token] + 1] = token  # as ends grow, so do sizes
        for i, token in enumerate(longest):
            if token < 0:
                longest[i] = self._character(text[i])
        failed, taken, at, last, token = None, [], 0, -1, longest[0] if n else -1
        while at < n:
            while token >= 0:
                end = at + size[token]
                if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                    known = pairs.get(last << 32 | token)
                    if known or known is None and self._may_follow(last, token):
                        break
                token = shorter[token]
            if token >= 0:
                taken.append(token)
                last, at = token, end
                token = longest[at] if at < n else -1
            else:
                failed = failed or bytearray((n >> 3) + 1)
                failed[at >> 3] |= 1 << (at & 7)
                token = taken.pop()
                at -= size[token]
                token, last = shorter[token], taken[-1] if taken else -1
        return taken

    def _ids(self, stretch: str) -> bytes:
        """Ids as 32-bit numbers of a stretch that is met for the first time."""
        inside, first, found = self.inside, 0, []
        bounds = [i for i, pair in enumerate(zip(stretch, stretch[1:]), 1) if pair not in inside]
        for end in [*bounds, len(stretch)]:
            part, first = stretch[first:end], end
            known = self.memo.get(part)
            if known is None:
                known = self.older.get(part)
                if known is None:
                    known = b"".join(map(self.out.__getitem__, self.tokens(part)))
                if len(part) <= MEMO_CHARS:
                    self.memo[part] = known
            found.append(known)
        return b"".join(found)

    def _chunks(self, text: str) -> Iterator[str]:
        """A text in parts that end where a stretch ends."""
        at = 0
        while self.apart and len(text) - at > CHUNK:
            cut = re.compile(f"(?<!{SPACE}){SPACE}").search(text, at + CHUNK)
            if cut is None:
                break
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, without begin or end."""
        out = []
        for part in self._chunks(self.processor.normalize(text)):
            parts = self.stretch.findall(part)
            if len(self.memo) > MEMO:
                self.memo, self.older = {}, self.memo
            memo, older, long = self.memo, self.older, []
            for s in set(parts):
                if s not in memo:
                    memo[s] = older.get(s) or self._ids(s)
                    if len(s) > MEMO_CHARS:
                        long.append(s)
            out.append(b"".join(map(memo.__getitem__, parts)))
            for s in long:
                del memo[s]
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: Sequence[int]) -> str:
        """A text of ids. The space mark that every text begins with goes."""
        written = self.written
        out = b"".join(map(written.__getitem__, ids))
        if self.drop_first:
            for i in ids:
                if self.spaced[i]:
                    out = out[1:]
                if written[i] and not (self.extra and self.spaced[i] and written[i] == b" "):
                    break
        return out.decode("utf-8", "skygrid_each_byte")


def _pieces(model: bytes) -> Pieces:
    """A worker's tables of a model; the last model is kept."""
    state = worker_state()
    held = state.get("pieces")
    if held is None or held[0] != model:
        held = state["pieces"] = (model, Pieces(model))
    return held[1]


def _model(path: str) -> bytes:
    """A model's bytes, read once by the driver: workers need no such file."""
    with open(path, "rb") as f:
        return f.read()


def _keyed(df: DataFrame, key: Sequence[str], *more) -> tuple[DataFrame, str]:
    """The key columns, under names that any column may have had, and more."""
    keys = [F.col(f"`{k}`").alias(f"key_{i}") for i, k in enumerate(key)]
    types = df.select(*keys).schema.fields
    return df.select(*keys, *more), "".join(f"{f.name} {f.dataType.simpleString()}, " for f in types)


def encode_documents(docs: DataFrame, model: str, key: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The key columns and ``ids``: a text's ids as array<int>. One pass, no
    shuffle. ``model`` is a model file's path."""
    bounded_batches(docs.sparkSession)
    blob, n_key = _model(model), len(key)
    d, types = _keyed(docs, key, F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = _pieces(blob)
        for b in batches:
            column = b.column(n_key)
            lengths = pa.compute.binary_length(column).to_numpy(zero_copy_only=False)
            for i, j in slices(lengths, BATCH_BYTES):
                found = [p.encode(t) for t in column.slice(i, j - i).to_pylist()]
                ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found) if found else np.empty(0, np.int32), pa.int32()))
                yield pa.RecordBatch.from_arrays([*(b.column(k).slice(i, j - i) for k in range(n_key)), ids], names=[*b.schema.names[:n_key], "ids"])

    return d.mapInArrow(run, types + "ids array<int>").toDF(*key, "ids")


def decode_documents(encoded: DataFrame, model: str, key: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The key columns, ``ids`` and ``decoded``: the ids' text. Null ids give
    the empty text; an id that the model does not have is an error."""
    bounded_batches(encoded.sparkSession)
    blob, n_key = _model(model), len(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = _pieces(blob)
        for b in batches:
            ids = b.column(n_key)
            lengths = pa.compute.fill_null(pa.compute.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
            for i, j in slices(4 * lengths, BATCH_BYTES):
                part = ids.slice(i, j - i)
                texts = [p.decode(x.values.to_numpy(zero_copy_only=False).tolist() if x.is_valid else ()) for x in part]
                yield pa.RecordBatch.from_arrays([*(b.column(k).slice(i, j - i) for k in range(n_key + 1)), pa.array(texts, pa.string())], names=[*b.schema.names[: n_key + 1], "decoded"])

    d, types = _keyed(encoded, key, "ids")
    return d.mapInArrow(run, types + "ids array<int>, decoded string").toDF(*key, "ids", "decoded")
