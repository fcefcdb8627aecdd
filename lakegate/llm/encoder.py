"""Exact tokenizing with a memo of pieces.

A text may be cut at an ASCII space whose neighbours are certainly neither white space nor
combining characters: both tokenizer families here split their input at such a space and encode
the parts on their own. A piece that has been encoded once is then looked up. Texts that hold the
opening of a special token are encoded whole by the library.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
from tokenizers import Tokenizer

# Spark gives each task one core.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Pieces kept per Python worker (about 200 bytes each); beyond it the memo starts anew.
MEMO_PIECES = 1_200_000
#: Text handled at once in a task.
SLICE_BYTES = 8 * 1024 * 1024
#: First characters of what may be a special token.
SPECIAL = b"<|"


def slices(texts: Sequence[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(offset, part) of the list, parts of about ``limit`` bytes (a longer text is one part)."""
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield begin, list(texts[begin:i])
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, list(texts[begin:])


def safe_start(piece: bytes) -> bool:
    """The first character is printable ASCII or a letter of U+00C0 to U+027F."""
    return bool(piece) and (0x21 <= piece[0] <= 0x7E or 0xC3 <= piece[0] <= 0xC9)


def safe_end(piece: bytes) -> bool:
    if not piece:
        return False
    return 0x21 <= piece[-1] <= 0x7E or (len(piece) > 1 and 0xC3 <= piece[-2] <= 0xC9)


def cut_at_spaces(text: bytes) -> list[bytes]:
    """Pieces whose concatenation is the text; all but the first begin with their space."""
    pieces: list[bytes] = []
    current = None
    for part in text.split(b" "):
        if current is None:
            current = part
        elif safe_end(current) and safe_start(part):
            pieces.append(current)
            current = b" " + part
        else:
            current = current + b" " + part
    return pieces if current is None else [*pieces, current]


class PieceEncoder:
    """One tokenizer file; ``dtype`` is the narrowest unsigned type that holds its ids."""

    def __init__(self, path: str, memo_pieces: int = MEMO_PIECES) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 65536 else "<u4")
        self.limit = memo_pieces
        self.memo: dict[bytes, bytes] = {}

    def library(self, texts: Iterable[bytes]) -> list[bytes]:
        """The library's own result, ids as bytes."""
        decoded = [t.decode("utf-8", "replace") for t in texts]
        found = self.tokenizer.encode_batch_fast(decoded, add_special_tokens=False)
        return [np.array(x.ids, self.dtype).tobytes() for x in found]

    def learn(self, pieces: Iterable[bytes]) -> None:
        """Encode pieces (without their leading space) that are not in the memo."""
        new = list(pieces)
        self.memo.update(zip(new, self.library([b" " + p for p in new]), strict=True))

    def encode(self, texts: Sequence[bytes]) -> list[bytes]:
        """Ids of each text as bytes."""
        return [ids for _, part in slices(texts) for ids in self._encode(part)]

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self.memo) > self.limit:
            self.memo.clear()
        memo = self.memo
        split = [t.split(b" ") for t in texts]
        unknown: set[bytes] = set()
        for parts in split:
            unknown.update(set(parts).difference(memo))
        dirty = {p for p in unknown if not (safe_start(p) and safe_end(p))}
        self.learn(unknown - dirty)
        # Whatever is not a plain list of clean pieces is put together from raw pieces.
        raw: dict[bytes, bytes] = {}
        plans: list[list[bytes] | None] = []
        for text, parts in zip(texts, split, strict=True):
            if SPECIAL in text:
                plan = [text]
            elif dirty and not dirty.isdisjoint(parts):
                plan = cut_at_spaces(text)
            else:
                plan = None
                raw[parts[0]] = b""
            for piece in plan or ():
                raw[piece] = b""
            plans.append(plan)
        raw = dict(zip(raw, self.library(raw), strict=True))
        out = []
        for parts, plan in zip(split, plans, strict=True):
            if plan is None:
                out.append(raw[parts[0]] + b"".join(map(memo.__getitem__, parts[1:])))
            else:
                out.append(b"".join(map(raw.__getitem__, plan)))
        return out


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One per tokenizer file and Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]
