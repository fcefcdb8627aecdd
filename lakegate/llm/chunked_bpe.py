"""BPE encoding and decoding with reuse of content-defined chunks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import content, give_back, pick, ship
from lakegate.llm.encoder import SPECIAL, PieceEncoder, safe_end, safe_start, slices

#: A chunk ends where the hash of its last WINDOW bytes has CHUNK_BITS leading zero bits.
WINDOW = 16
CHUNK_BITS = 10
#: Encoded chunks kept per Python worker, in bytes of text; beyond it the table starts anew.
TABLE_BYTES = 16 * 1024 * 1024
#: Pieces kept per Python worker since the last turn of the memo, and as many from before it.
MEMO_PIECES = 300_000
#: Text encoded at a time (a longer document is taken alone).
SLICE_BYTES = 2 * 1024 * 1024
_SEGMENT = 1024 * 1024
_MULTIPLIER = 0x9E3779B1
_TABLE = (np.arange(1, 257, dtype=np.uint64) * 0xD6E8FEB86659FD93 >> 32).astype(np.uint32)


def chunk_ends(text: bytes, bits: int = CHUNK_BITS) -> list[int]:
    """Ends of the chunks, by a rolling hash; always between characters, the last at the end.

    An end depends on the WINDOW bytes before it alone, so a passage gets the same chunks in
    every document, but for its edges.
    """
    data = np.frombuffer(text, np.uint8)
    ends: list[int] = []
    for begin in range(0, len(data), _SEGMENT):
        lead = min(begin, WINDOW - 1)
        h = _TABLE[data[begin - lead : begin + _SEGMENT]]
        multiplier, width = _MULTIPLIER, 1
        while width < WINDOW:
            if len(h) <= width:
                h = h[:0]
                break
            h = h[width:] + h[:-width] * np.uint32(multiplier)
            multiplier = multiplier * multiplier % 2**32
            width *= 2
        ends += (np.flatnonzero(h >> np.uint32(32 - bits) == 0) + begin - lead + WINDOW).tolist()
    whole = len(data)
    out = []
    for end in ends:
        while end < whole and data[end] & 0xC0 == 0x80:
            end += 1
        if end < whole and (not out or end > out[-1]):
            out.append(end)
    return [*out, whole] if whole else []


def cut_parts(parts: list[bytes], dirty: set[bytes]) -> list[bytes]:
    """``encoder.cut_at_spaces`` of a text split at its spaces, the pieces without their leading space.

    ``dirty`` holds the inner parts that do not begin and end safely; the others are pieces of their own.
    """
    pieces, current = [], parts[0]
    safe, last = safe_end(current), len(parts) - 1
    for i, part in enumerate(parts[1:], 1):
        clean = i < last and part not in dirty
        if safe and (clean or safe_start(part)):
            pieces.append(current)
            current = part
        else:
            current = current + b" " + part
        safe = clean or safe_end(part)
    return [*pieces, current]


@dataclass(slots=True)
class Chunk:
    """An encoded chunk. ``head`` and ``tail`` are the texts outside its outermost safe cuts.

    ``first`` and ``last`` are its outermost whole pieces with their ids. A chunk with fewer than
    two safe cuts is all ``head`` and has no ids of its own.
    """

    head: bytes
    ids: bytes | None = None
    first: tuple[bytes, bytes] = (b"", b"")
    last: tuple[bytes, bytes] = (b"", b"")
    tail: bytes = b""


class ChunkEncoder:
    """Encodes documents from a table of chunks; each chunk in the table was encoded once.

    Where two chunks meet, the text between their outermost safe cuts is encoded again together
    with the whole piece on either side. If the outer pieces come out as they are in the chunks,
    the join is exact; if not, the window grows to the whole document.
    """

    def __init__(self, path: str, bits: int = CHUNK_BITS, table_bytes: int = TABLE_BYTES) -> None:
        self.pieces = PieceEncoder(path, MEMO_PIECES)
        self.older: dict[bytes, bytes] = {}
        self.bits, self.limit = bits, table_bytes
        self.table: dict[bytes, Chunk] = {}
        self.size = self.encoded = self.reused = self.widened = 0
        vocabulary = self.pieces.tokenizer.get_vocab(with_added_tokens=True)
        names: list[str] = [""] * (max(vocabulary.values()) + 1)
        for name, number in vocabulary.items():
            names[number] = name
        self.names = names

    def encode(self, texts: Sequence[bytes]) -> list[np.ndarray]:
        out = []
        for _, part in slices(texts):
            out += [np.frombuffer(ids, self.pieces.dtype) for ids in self._encode(part)]
        return out

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        if self.size > self.limit:
            self.table.clear()
            self.size = 0
        if len(self.pieces.memo) > self.pieces.limit:
            self.older, self.pieces.memo = self.pieces.memo, {}
        plans: list[list[bytes] | None] = []
        new: dict[bytes, list[bytes]] = {}
        for text in texts:
            if SPECIAL in text:
                plans.append(None)
                continue
            at, chunks = 0, []
            for end in chunk_ends(text, self.bits):
                chunk = text[at:end]
                at = end
                chunks.append(chunk)
                if chunk in self.table or chunk in new:
                    self.reused += 1
                else:
                    new[chunk] = chunk.split(b" ")
            plans.append(chunks)
        self._add(new)
        whole = self._whole([t for t, plan in zip(texts, plans, strict=True) if plan is None])
        joined = self._join([p for p in plans if p is not None])
        return [next(whole) if plan is None else next(joined) for plan in plans]

    def _learn(self, pieces: set[bytes]) -> None:
        """Bring pieces that are not in the memo into it."""
        known = pieces.intersection(self.older) if self.older else set()
        self.pieces.memo.update((p, self.older[p]) for p in known)
        self.pieces.learn(pieces - known)

    def _add(self, new: dict[bytes, list[bytes]]) -> None:
        """Encode chunks that were split at their spaces.

        Only pieces between two safe cuts are in the memo, so a part found there is such a piece.
        """
        memo = self.pieces.memo
        found: list[list[bytes | None]] = []
        unknown: set[bytes] = set()
        for parts in new.values():
            ids = list(map(memo.get, parts[1:-1]))
            if None in ids:
                unknown.update([p for p, x in zip(parts[1:-1], ids, strict=True) if x is None])
            found.append(ids)
        dirty = {p for p in unknown if not (safe_start(p) and safe_end(p))}
        self._learn(unknown - dirty)
        late: dict[bytes, list[bytes]] = {}
        for (chunk, parts), ids in zip(new.items(), found, strict=True):
            self.size += len(chunk)
            self.encoded += 1
            if len(parts) < 4 or (dirty and not dirty.isdisjoint(parts[1:-1])):
                late[chunk] = cut_parts(parts, dirty)
                continue
            # All inner parts are pieces; only the outer ones may belong to their neighbours.
            ids = [memo[p] if x is None else x for p, x in zip(parts[1:-1], ids, strict=True)]
            if not safe_end(parts[0]):
                parts[:2] = [parts[0] + b" " + parts[1]]
                del ids[0]
            if not safe_start(parts[-1]):
                parts[-2:] = [parts[-2] + b" " + parts[-1]]
                del ids[-1:]
            self._keep(chunk, parts, ids)
        inner: set[bytes] = set()
        for pieces in late.values():
            inner.update(pieces[1:-1])
        self._learn(inner.difference(memo))
        for chunk, pieces in late.items():
            self._keep(chunk, pieces, [memo[p] for p in pieces[1:-1]])

    def _keep(self, chunk: bytes, pieces: list[bytes], ids: list[bytes]) -> None:
        if not ids:
            self.table[chunk] = Chunk(chunk)
            return
        first, last, tail = (b" " + pieces[i] for i in (1, -2, -1))
        self.table[chunk] = Chunk(pieces[0], b"".join(ids), (first, ids[0]), (last, ids[-1]), tail)

    def _join(self, plans: list[list[bytes]]) -> Iterator[bytes]:
        """Ids of each document: chunk, repaired join, chunk, …"""
        windows: dict[bytes, bytes] = {}
        laid: list[list[tuple[bytes, Chunk | None, Chunk | None]]] = []
        for chunks in plans:
            joins = []
            pending, left = b"", None
            for chunk in chunks:
                right = self.table[chunk]
                pending += right.head
                if right.ids is None:
                    continue
                joins.append((pending, left, right))
                pending, left = right.tail, right
            joins.append((pending, left, None))
            for between, left, right in joins:
                windows[_window(between, left, right)] = b""
            laid.append(joins)
        windows = dict(zip(windows, self.pieces.library(windows), strict=True))
        for chunks, joins in zip(plans, laid, strict=True):
            out = []
            for between, left, right in joins:
                ids = windows[_window(between, left, right)]
                before = left.last[1] if left else b""
                after = right.first[1] if right else b""
                agrees = (
                    len(ids) >= len(before) + len(after)
                    and ids.startswith(before)
                    and ids.endswith(after)
                )
                if not agrees:
                    self.widened += 1
                    out = [next(self._whole([b"".join(chunks)]))]
                    break
                out.append(ids[len(before) : len(ids) - len(after)])
                if right:
                    out.append(right.ids or b"")
            yield b"".join(out)

    def _whole(self, texts: list[bytes]) -> Iterator[bytes]:
        return iter(self.pieces.library(texts))

    def decode(self, ids: np.ndarray) -> str:
        """The library's decode for a tokenizer without a decoder: tokens joined by spaces."""
        if self.pieces.tokenizer.decoder is not None:
            return self.pieces.tokenizer.decode(ids.tolist(), skip_special_tokens=False)
        return " ".join(map(self.names.__getitem__, ids.tolist()))


def _window(between: bytes, left: Chunk | None, right: Chunk | None) -> bytes:
    return (left.last[0] if left else b"") + between + (right.first[0] if right else b"")


_ENCODERS: dict[tuple[str, int], ChunkEncoder] = {}


def chunk_encoder(path: str, bits: int) -> ChunkEncoder:
    key = (path, bits)
    if key not in _ENCODERS:
        _ENCODERS[key] = ChunkEncoder(path, bits)
    return _ENCODERS[key]


def encode_decode(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_bits: int = CHUNK_BITS,
    gather: bool = True,
) -> DataFrame:
    """doc_id, ids (array of int), decoded (text of the ids), one row per input row.

    ``gather`` brings documents that share lines to the same task first: they are dealt out by the
    smallest hash of their lines. Adaptive execution rebalances: it splits what exceeds its
    advisory size, so a hot group gets as many tasks as its bytes need, and each of them encodes a
    shared chunk once. The tokenizer file must be at the same path on every worker.

    NULL and empty texts have no ids and decode to the empty text. A text holding the opening of a
    special token is encoded whole. Extra columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = pick(docs, doc_id=id_col, text=text_col)
    if gather:
        lines = F.split(F.coalesce("text", F.lit("")), "\n")
        smallest = F.array_min(F.transform(lines, lambda line: F.xxhash64(line)))
        rows = rows.withColumn("__place", smallest).hint("rebalance", "__place").select("doc_id", "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.select("doc_id", content().alias("text"))

    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = chunk_encoder(tokenizer_path, chunk_bits)
        for batch in batches:
            texts = batch["text"].to_pylist()
            for begin, part in slices(texts, SLICE_BYTES):
                ids = tool.encode(part)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch["doc_id"].slice(begin, len(part)),
                        "ids": pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())),
                        "decoded": pa.array([tool.decode(x) for x in ids], pa.string()),
                    }
                )
        give_back()

    return rows.mapInArrow(run_batches, f"doc_id {id_type}, ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """n_tokens, and SHA-256 of the ids (decimal, joined by spaces) and of the decoded text."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
