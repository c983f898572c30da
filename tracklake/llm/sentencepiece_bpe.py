"""SentencePiece BPE: exact encoding by backtracking, and decoding.

The encoder walks over longest matches found by an Aho-Corasick automaton. A token is accepted
if it is compatible with the token before it, that is, if merging the two tokens' characters
anew gives just these two tokens. Otherwise the next shorter piece is tried, and if there is
none, the last token is taken back and the position is marked in a bitfield of failed positions,
so that no position is tried twice. A sequence in which all neighbours are compatible is the one
that merging the whole text gives.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.llm._text import pieces, text_bytes, tidy

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
CACHE = 150_000


def _fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """Numbered fields of a serialised message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            n = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield key >> 3, data[at : at + n]
            at += n


class Model:
    """The pieces of a BPE model file with byte fallback and an identity normaliser."""

    def __init__(self, data: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        normaliser = {}
        for number, value in _fields(data):
            if number == 1:
                own = dict(_fields(value))
                self.pieces.append((own[1].decode(), struct.unpack("<f", own[2])[0] if 2 in own else 0.0, own.get(3, NORMAL)))
            elif number == 3:
                normaliser = dict(_fields(value))
        if normaliser.get(1, b"identity") != b"identity" or normaliser.get(2, b"") or not normaliser.get(3, 1) or normaliser.get(4, 1):
            raise ValueError("only an identity normaliser with a dummy prefix and kept white space is supported")
        kinds = [k for _, _, k in self.pieces]
        if USER_DEFINED in kinds or UNUSED in kinds or kinds.count(BYTE) != 256:
            raise ValueError("only models of normal, control and all 256 byte pieces are supported")
        self.ids = {p: i for i, (p, _, k) in enumerate(self.pieces) if k == NORMAL}
        self.score = {p: s for p, s, k in self.pieces if k == NORMAL}
        self.byte_ids = [0] * 256
        for i, (p, _, k) in enumerate(self.pieces):
            if k == BYTE:
                self.byte_ids[int(p[3:5], 16)] = i
        self.bos, self.eos = (next(i for i, (p, _, k) in enumerate(self.pieces) if k == CONTROL and p == x) for x in ("<s>", "</s>"))
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            self.automaton.add_word(p, len(p))
        self.automaton.make_automaton()
        self.splits_at_space = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.splits_at_line = self.splits_at_space and not any("\n" in p for p in self.ids)
        self.shorter: dict[str, str] = {}
        self.compatible: dict[tuple[str, str], bool] = {}
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.packed = {p: struct.pack("<I", i) for p, i in self.ids.items()}
        self.surface = [self._surface(p, k) for p, _, k in self.pieces]

    @staticmethod
    def _surface(piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        return {CONTROL: "", UNKNOWN: " ⁇ "}.get(kind, piece.replace(SPACE, " ")).encode()

    def merged(self, text: str) -> list[str]:
        """Merge characters, best score first and leftmost among equals, until nothing merges."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, where = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, where = s, i
            if best is None:
                break
            parts[where : where + 2] = [parts[where] + parts[where + 1]]
        return parts

    def fits(self, left: str, right: str) -> bool:
        if len(self.compatible) >= CACHE:
            self.compatible.clear()
        found = self.compatible[left, right] = self.merged(left + right) == [left, right]
        return found

    def prefix(self, piece: str) -> str:
        """The longest piece that is a proper prefix; '' if there is none. One character is always a piece."""
        if (found := self.shorter.get(piece)) is None:
            found = piece[:-1]
            while len(found) > 1 and found not in self.ids:
                found = found[:-1]
            if len(self.shorter) < CACHE:
                self.shorter[piece] = found
        return found

    def split(self, text: str) -> list[str]:
        """The pieces of ``text``, in which white space is already escaped."""
        n = len(text)
        longest = [1] * n
        for end, size in self.automaton.iter(text):
            if size > 1:
                longest[end - size + 1] = size
        failed = bytearray(n // 8 + 1)
        compatible = self.compatible
        out: list[str] = []
        pos = 0
        last = None
        token = text[: longest[0]] if n else ""
        while pos < n:
            while token:
                end = pos + len(token)
                if not failed[end >> 3] >> (end & 7) & 1:
                    if last is None or ((known := compatible.get((last, token))) is None and self.fits(last, token)) or known:
                        break
                token = self.prefix(token)
            if token:
                out.append(token)
                last, pos = token, end
                if pos < n:
                    token = text[pos : pos + longest[pos]]
            else:
                failed[pos >> 3] |= 1 << (pos & 7)
                token = out.pop()
                pos -= len(token)
                last = out[-1] if out else None
        return out

    def chunk_ids(self, chunk: bytes) -> bytes:
        """Packed ids of a stretch of text that no piece reaches out of."""
        if (found := self.known.get(chunk)) is not None:
            return found
        if (found := self.older.get(chunk)) is None:
            packed = self.packed
            out = []
            for piece in self.split(chunk.decode().replace(" ", SPACE)):
                ids = packed.get(piece)
                out.append(ids if ids is not None else struct.pack(f"<{len(b := piece.encode())}I", *(self.byte_ids[x] for x in b)))
            found = b"".join(out)
        if len(chunk) <= 64:
            if len(self.known) >= CACHE:
                self.known, self.older = {}, self.known
            self.known[chunk] = found
        return found

    def forget(self) -> None:
        """Empty the caches: a worker lives on for other tasks."""
        self.known, self.older = {}, {}
        self.compatible.clear()
        self.shorter.clear()

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids without begin and end ids, and the offsets of the rows into them."""
        texts = texts.fill_null("")
        texts = pc.replace_substring(texts, SPACE, " ")
        texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(" ", texts, ""))
        data, at = text_bytes(texts)
        starts = np.zeros(len(data), bool)
        if self.splits_at_space:
            space = data == 32
            starts |= space
            starts[1:] &= ~space[:-1]
        if self.splits_at_line:
            line = data == 10
            starts |= line
            starts[1:] |= line[:-1]
        starts[at[:-1][at[:-1] < at[1:]]] = True
        where = np.flatnonzero(starts)
        offsets = np.append(where, len(data)).astype(np.int32)
        flat = pa.Array.from_buffers(pa.binary(), len(where), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        packed = [self.chunk_ids(x) for x in flat.dictionary.to_pylist()]
        ids = np.frombuffer(b"".join(packed), "<u4")
        size = np.fromiter(map(len, packed), np.int64, len(packed)) >> 2
        begin = np.cumsum(size) - size
        chosen = flat.indices.to_numpy(zero_copy_only=False)
        n = size[chosen]
        done = np.concatenate([[0], np.cumsum(n)])
        out = ids[np.repeat(begin[chosen] - done[:-1], n) + np.arange(done[-1])] if len(chosen) else np.zeros(0, np.uint32)
        return out.astype("<u4"), done[np.searchsorted(where, at)]

    def encode(self, text: str | None) -> list[int]:
        ids, _ = self.encode_batch(pa.array([text], pa.string()))
        return [self.bos, *ids.tolist(), self.eos]

    def decode_bytes(self, ids: list[int]) -> bytes:
        """The text of ``ids``; a byte that no character holds becomes U+FFFD."""
        first = next((i for i in ids if self.pieces[i][2] != CONTROL), None)
        out = b"".join(map(self.surface.__getitem__, ids))
        if first is not None and self.pieces[first][0].startswith(SPACE):
            out = out[1:]
        try:
            out.decode()
        except UnicodeDecodeError:
            out = out.decode(errors="surrogateescape")
            out = "".join("�" if 0xDC80 <= ord(c) <= 0xDCFF else c for c in out).encode()
        return out


_loaded: dict[bytes, Model] = {}


def _model(data: bytes) -> Model:
    if data not in _loaded:
        _loaded[data] = Model(data)
    return _loaded[data]


def _coded(shared, name: str, decode: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared.value)
        try:
            for batch in pieces(batches, limit=2 << 20):
                ids, at = model.encode_batch(batch.column("text"))
                rows = [np.concatenate([[model.bos], ids[a:b], [model.eos]]).astype("<u4") for a, b in zip(at[:-1], at[1:], strict=True)]
                columns = [batch.column("doc_id").cast(pa.int64()), pa.array(np.diff(at) + 2), pa.array([r.tobytes() for r in rows], pa.binary())]
                if decode:
                    columns.append(pa.array([model.decode_bytes(r.tolist()) for r in rows], pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids", "decoded"][: len(columns)])
        finally:
            model.forget()
            tidy()

    return run


def encode_documents(docs: DataFrame, model_path: str, decode: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids[, decoded]`` of every row: ids as little-endian unsigned 32-bit integers.

    The ids have a begin and an end id; ``decoded`` is the text that the ids stand for, made from
    them alone. A null text is encoded as an empty one: begin and end. Texts of any length are
    encoded whole, and memory follows the batch, of about 2 MB of text, or the longest text. The
    model file is read by the driver and shared once with the executors; it has a fixed size.
    Repeated rows are encoded each; a null doc_id stays null; other columns are ignored.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Path(model_path).read_bytes())
    schema = "doc_id long, n_tokens long, ids binary" + ", decoded string" * decode
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_coded(shared, model_path, decode), schema)
