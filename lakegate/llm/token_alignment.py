"""Alignment of two tokenizers by byte ranges, with corpus-wide counts of aligned id pairs."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakegate.llm.common import content, pick, ship, stage
from lakegate.llm.encoder import safe_end, safe_start, slices
from lakegate.llm.perfect_hash import KeyTable, PerfectHash, shard_of

#: A longer text is encoded and aligned in parts, cut between words that both tokenizers part.
PART = 1024 * 1024
#: Text encoded at once.
SLICE_BYTES = 1024 * 1024
#: Tokens (of both tokenizers) aligned at once.
SLICE_TOKENS = 400_000
#: The split of byte-level BPE before its merges. FIXED VALUE of that public scheme.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A longer word goes to the tokenizer's own library, whose time does not grow with its square.
_LONG_WORD = re.compile(rb"[^\x09-\x0D\x20]{1000}")
#: Id pairs of one table (about 20 bytes each, sent to every task); more pairs take several tables.
TABLE_PAIRS = 4_000_000
#: Pairs of one perfect hash.
SHARD_PAIRS = 65_536
#: Counts of one piece of a dense vector.
PIECE = 16_384
#: Tasks that count; each holds one dense vector.
COUNTING_TASKS = 16_384


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def parts_of(text: bytes) -> Iterator[bytes]:
    """The text in parts of about ``PART`` bytes, cut at spaces that both tokenizers cut at.

    The space of a cut belongs to no part: each part stands for one space and its bytes, as the
    whole text does.
    """
    begin = 0
    while True:
        at = text.find(b" ", begin + PART)
        while at >= 0 and not (safe_end(text[at - 2 : at]) and safe_start(text[at + 1 : at + 2])):
            at = text.find(b" ", at + 1)
        yield text[begin:] if at < 0 else text[begin:at]
        if at < 0:
            return
        begin = at + 1


class Strings:
    """Numbered byte strings, put together by array operations."""

    def __init__(self, strings: Sequence[bytes]) -> None:
        self.lengths = np.array([len(x) for x in strings], np.int32)
        self.starts = np.cumsum(self.lengths, dtype=np.int64) - self.lengths
        self.blob = np.frombuffer(b"".join(strings), np.uint8)

    def text(self, numbers: np.ndarray) -> np.ndarray:
        lengths = self.lengths[numbers]
        shift = self.starts[numbers] - (np.cumsum(lengths, dtype=np.int64) - lengths)
        return self.blob[np.arange(int(lengths.sum())) + np.repeat(shift, lengths)]


class ByteLevel:
    """A byte-level BPE from its tokenizer file; the strings of special tokens are plain text.

    Where ids rise with the order of merges, the merges are done by ranks; other files, and long
    words, are left to the file's own library.
    """

    def __init__(self, path: str) -> None:
        self.path, self._library = path, None
        with open(path, encoding="utf-8") as source:
            content = json.load(source)
        alphabet = byte_alphabet()
        vocabulary = dict(content["model"]["vocab"])
        vocabulary |= {t["content"]: t["id"] for t in content.get("added_tokens", ())}
        tokens = [b""] * (max(vocabulary.values()) + 1)
        for name, number in vocabulary.items():
            plain = all(c in alphabet for c in name)
            tokens[number] = bytes(alphabet[c] for c in name) if plain else name.encode()
        self.strings = Strings(tokens)
        model, split = content["model"], content.get("pre_tokenizer") or {}
        special = {t["content"] for t in content.get("added_tokens", ())}
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        order = [model["vocab"][m] for m in merged]
        by_rank = (
            split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
            and not content.get("normalizer") and not model.get("ignore_merges")
            and all(x < y for x, y in zip(order, order[1:], strict=False))
        )
        self.fast = None
        if by_rank:
            ranks = {tokens[i]: i for name, i in model["vocab"].items() if name not in special}
            self.fast = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    @property
    def library(self) -> Tokenizer:
        """Loaded where it is needed only."""
        if self._library is None:
            self._library = Tokenizer.from_file(self.path)
            self._library.encode_special_tokens = True
            self._library.no_truncation()
            self._library.no_padding()
        return self._library

    def encode(self, text: bytes) -> np.ndarray:
        if self.fast is None or _LONG_WORD.search(text):
            return np.array(self.library.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, np.int32)
        return np.array(self.fast.encode_ordinary(text.decode("utf-8", "replace")), np.int32)


class Pair:
    """Both tokenizers, with the bytes of every token."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a = ByteLevel(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.strings_a = self.a.strings
        self.strings_b = Strings(
            [
                bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.b.is_byte(i)
                else self.b.id_to_piece(i).replace("▁", " ").encode()
                for i in range(self.b.get_piece_size())
            ]
        )
        #: Staged ids take two bytes where both vocabularies allow it.
        sizes = (len(self.strings_a.lengths), len(self.strings_b.lengths))
        self.dtype = np.dtype("<u2" if max(sizes) <= 65536 else "<u4")
        # The text of each id in a group: followed by more of its side, or last of its side.
        self.size_a = len(self.strings_a.lengths)
        self.names = Strings(
            [
                *(f"{i}{end}".encode() for i in range(self.size_a) for end in (",", "|")),
                *(f"{i}{end}".encode() for i in range(self.b.get_piece_size()) for end in (",", ";")),
            ]
        )

    def encode(self, texts: Sequence[bytes]) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
        """Ids of each text by both tokenizers, part by part; no part if bytes are not given back."""
        for _, some in slices(texts, SLICE_BYTES):
            parts = [list(parts_of(t)) if t else [] for t in some]
            flat = [p for of_text in parts for p in of_text]
            ids_b = iter(self.b.encode([p.decode("utf-8", "replace") for p in flat], num_threads=1))
            for of_text in parts:
                found, exact = [], True
                for part in of_text:
                    whole = b" " + part
                    a, b = self.a.encode(whole), np.array(next(ids_b), np.int32)
                    exact = exact and self._gives(self.strings_a, a, whole) and self._gives(self.strings_b, b, whole)
                    found.append((a, b))
                yield found if exact else []

    @staticmethod
    def _gives(strings: Strings, ids: np.ndarray, whole: bytes) -> bool:
        return int(strings.lengths[ids].sum()) == len(whole) and strings.text(ids).tobytes() == whole


_PAIRS: dict[tuple[str, str], Pair] = {}


def pair_of(path_a: str, path_b: str) -> Pair:
    """One per pair of tokenizer files and Python worker."""
    key = (path_a, path_b)
    if key not in _PAIRS:
        _PAIRS[key] = Pair(path_a, path_b)
    return _PAIRS[key]


@dataclass(slots=True)
class Alignment:
    """Several token sequences aligned at once; ``cuts`` part links and groups by sequence.

    A link is a stretch of bytes between neighbouring token ends of either side, and so belongs to
    one token of each; a group ends where both sides end.
    """

    keys: np.ndarray
    link_cuts: np.ndarray
    group_cuts: np.ndarray
    names: list[bytes]


def align_tokens(tool: Pair, sequences: list[tuple[np.ndarray, np.ndarray]], with_names: bool) -> Alignment:
    """``names``: each sequence's groups as text."""
    none = np.zeros(0, tool.dtype)
    a = np.concatenate([none, *(x for x, _ in sequences)]).astype(np.int32)
    b = np.concatenate([none, *(y for _, y in sequences)]).astype(np.int32)
    ends_a, ends_b = np.cumsum(tool.strings_a.lengths[a], dtype=np.int64), np.cumsum(tool.strings_b.lengths[b], dtype=np.int64)
    mark = np.zeros(int(ends_a[-1]) + 1 if len(a) else 1, np.uint8)
    mark[ends_a] = 1
    mark[ends_b] |= 2
    at = np.flatnonzero(mark)
    side = mark[at]
    is_a, is_b = side & 1, side >> 1
    i = np.cumsum(is_a, dtype=np.int64) - is_a
    j = np.cumsum(is_b, dtype=np.int64) - is_b
    keys = a[i].astype(np.int64) << 32 | b[j]
    both = side == 3
    count_a = np.cumsum([0, *(len(x) for x, _ in sequences)])
    count_b = np.cumsum([0, *(len(y) for _, y in sequences)])
    stops = np.concatenate([[0], ends_a])[count_a]  # where each sequence ends, in bytes
    link_cuts = np.searchsorted(at, stops, "right")
    group_cuts = np.concatenate([[0], np.cumsum(both, dtype=np.int64)])[link_cuts]
    names: list[bytes] = []
    if with_names:
        # Tokens in the order of the text: of each group first those of A, then those of B.
        last_a, last_b = i[both], j[both]
        group_a = np.repeat(np.arange(len(last_a)), np.diff(last_a, prepend=-1))
        group_b = np.repeat(np.arange(len(last_b)), np.diff(last_b, prepend=-1))
        place_a = np.arange(len(a)) + np.concatenate([[0], last_b + 1])[group_a]
        place_b = np.arange(len(b)) + last_a[group_b] + 1
        code_a, code_b = 2 * a.astype(np.int64), 2 * (b.astype(np.int64) + tool.size_a)
        code_a[last_a] += 1
        code_b[last_b] += 1
        codes = np.empty(len(a) + len(b), np.int64)
        codes[place_a], codes[place_b] = code_a, code_b
        text = tool.names.text(codes).tobytes()
        ends = np.concatenate([[0], np.cumsum(tool.names.lengths[codes], dtype=np.int64)])
        bounds = ends[count_a + count_b].tolist()
        names = [text[x : max(x, y - 1)] for x, y in zip(bounds, bounds[1:], strict=False)]
    return Alignment(keys, link_cuts, group_cuts, names)


def totals(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sum of the values of each sequence."""
    return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[cuts])


def encoded(rows: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, the ids of both tokenizers (``Pair.dtype``), and the tokens of each part."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = pair_of(path_a, path_b)
        for batch in batches:
            for begin, texts in slices(batch["text"].to_pylist(), SLICE_BYTES):
                a, b, parts = [], [], []
                for found in tool.encode(texts):
                    a.append(b"".join(x.astype(tool.dtype).tobytes() for x, _ in found))
                    b.append(b"".join(y.astype(tool.dtype).tobytes() for _, y in found))
                    parts.append([n for x, y in found for n in (len(x), len(y))])
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch["doc_id"].slice(begin, len(texts)),
                        "a": pa.array(a, pa.binary()),
                        "b": pa.array(b, pa.binary()),
                        "parts": pa.array(parts, pa.list_(pa.int32())),
                    }
                )

    return rows.mapInArrow(run, f"doc_id {kind}, a binary, b binary, parts array<int>")


def sliced(batch: pa.RecordBatch, dtype: np.dtype) -> Iterator[tuple[int, int, bool, list[tuple[np.ndarray, np.ndarray]]]]:
    """(first row, rows, is it the last slice of its rows, sequences) of about ``SLICE_TOKENS``.

    A slice holds the sequences of whole rows, or some parts of one row (then ``rows`` is 0).
    """
    begin, held, size = 0, [], 0
    columns = (batch["a"], batch["b"], batch["parts"])
    for row, (ids_a, ids_b, counts) in enumerate(zip(*columns, strict=True)):
        a, b = (np.frombuffer(x.as_buffer(), dtype) if x.as_buffer().size else np.zeros(0, dtype) for x in (ids_a, ids_b))
        tokens = len(a) + len(b)
        if held and size + tokens > SLICE_TOKENS:
            yield begin, len(held), True, held
            begin, held, size = row, [], 0
        if tokens <= SLICE_TOKENS:
            held.append((a, b))
            size += tokens
            continue
        parts = counts.as_py()
        cuts_a, cuts_b = np.cumsum([0, *parts[::2]]), np.cumsum([0, *parts[1::2]])
        some: list[tuple[np.ndarray, np.ndarray]] = []
        for k in range(len(cuts_a) - 1):
            some.append((a[cuts_a[k] : cuts_a[k + 1]], b[cuts_b[k] : cuts_b[k + 1]]))
            last = k == len(cuts_a) - 2
            if last or sum(len(x) + len(y) for x, y in some) > SLICE_TOKENS:
                yield row, 0, last, some
                some = []
        begin = row + 1
    if held:
        yield begin, len(held), True, held


_TABLES: dict[str, KeyTable] = {}


def _table(key: str, sent) -> KeyTable:
    """Unpacked once per Python worker; one table is held at a time."""
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = KeyTable(*sent.value)
    return _TABLES[key]


def distinct_pairs(tokens: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``pair``: the distinct id pairs linked anywhere (A's id in the upper, B's in the lower half)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = pair_of(path_a, path_b)
        seen = np.zeros(0, np.int64)
        for batch in batches:
            for _, _, _, sequences in sliced(batch, tool.dtype):
                found = align_tokens(tool, sequences, False).keys
                seen = np.union1d(seen, found)
                if len(seen) > 2_000_000:
                    yield pa.RecordBatch.from_pydict({"pair": seen})
                    seen = np.zeros(0, np.int64)
        yield pa.RecordBatch.from_pydict({"pair": seen})

    return tokens.select("a", "b", "parts").mapInArrow(run, "pair bigint").distinct()


def key_table(pairs: DataFrame, count: int) -> tuple[list[bytes], list[np.ndarray]]:
    """A perfect hash per shard of the pairs, built in tasks; what is collected is the table itself."""
    shards = max(1, -(-count // SHARD_PAIRS))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch["pair"].to_numpy()
            yield pa.RecordBatch.from_pydict({"shard": shard_of(keys, shards), "pair": keys})

    def built(group: pa.Table) -> pa.Table:
        keys = group["pair"].to_numpy()
        tool = PerfectHash.build(keys)
        ordered = np.zeros(tool.size, np.int64)
        ordered[tool(keys)] = keys
        return pa.table({"shard": [group["shard"][0].as_py()], "levels": [tool.packed()], "pairs": [ordered.tobytes()]})

    hashed = pairs.mapInArrow(placed, "shard bigint, pair bigint").groupBy("shard")
    found = hashed.applyInArrow(built, "shard bigint, levels binary, pairs binary").collect()
    by_shard = {r["shard"]: r for r in found}
    empty = PerfectHash.build(np.zeros(0, np.int64)).packed()
    packed = [bytes(by_shard[s]["levels"]) if s in by_shard else empty for s in range(shards)]
    keys = [np.frombuffer(by_shard[s]["pairs"], np.int64) for s in range(shards) if s in by_shard]
    return packed, keys


def document_counts(tokens: DataFrame, path_a: str, path_b: str, sent, key: str, size: int) -> np.ndarray:
    """In how many documents each pair of the table is linked: dense vectors, summed as a tree."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, table = pair_of(path_a, path_b), _table(key, sent)
        counts, open_ = np.zeros(size, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for _, rows, complete, sequences in sliced(batch, tool.dtype):
                found = align_tokens(tool, sequences, False)
                pairs = table.find(found.keys)
                if not rows:  # some parts of one document
                    open_ = np.union1d(open_, pairs[pairs >= 0])
                    if complete:
                        counts[open_] += 1
                        open_ = open_[:0]
                    continue
                doc = np.repeat(np.arange(rows), np.diff(found.link_cuts))
                linked = np.unique((doc * (size + 1) + pairs)[pairs >= 0])
                counts += np.bincount(linked % (size + 1), minlength=size)[:size]
        group = TaskContext.get().partitionId() % 64
        for begin in range(0, size, PIECE):
            piece = counts[begin : begin + PIECE]
            if piece.any():
                yield _row((begin // PIECE, group), piece)

    def summed(by_branch: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # Rows come sorted by piece (and branch): one vector is held at a time.
            last, total = None, None
            for batch in batches:
                for piece, branch, blob in zip(*(batch[c].to_pylist() for c in ("piece", "branch", "counts")), strict=True):
                    vector = np.frombuffer(blob, np.int64)
                    name = (piece, branch if by_branch else 0)
                    if name == last:
                        total = total + vector
                        continue
                    if last is not None:
                        yield _row(last, total)
                    last, total = name, vector
            if last is not None:
                yield _row(last, total)

        return run

    schema = "piece bigint, branch bigint, counts binary"
    few = tokens.select("a", "b", "parts").coalesce(COUNTING_TASKS).mapInArrow(counted, schema)
    branches = few.repartition("piece", "branch").sortWithinPartitions("piece", "branch").mapInArrow(summed(True), schema)
    whole = branches.repartition("piece").sortWithinPartitions("piece").mapInArrow(summed(False), schema)
    counts = np.zeros(size, np.int64)
    for row in whole.collect():  # the vector itself, bounded by the table
        begin = row["piece"] * PIECE
        part = np.frombuffer(row["counts"], np.int64)
        counts[begin : begin + len(part)] += part
    return counts


def _row(name: tuple[int, int], total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"piece": [name[0]], "branch": [name[1]], "counts": [total.tobytes()]})


def align(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    table_pairs: int = TABLE_PAIRS,
    with_groups: bool = False,
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Every text is encoded once and its ids are staged. Then three maps over the ids: the first
    gathers the distinct id pairs, from which tasks build a minimal perfect hash; the second
    counts, per pair, the documents that link it, in one dense vector per task; the third aligns
    again and looks the counts up. Pairs and vectors are shuffled, never texts or ids. The number
    of pairs is bounded by the two vocabularies; a table takes ``table_pairs`` of them, all pairs
    of an id of A in the same table, and where there are more, the second and third map run once
    per table and their figures are added.

    NULL and empty texts, and those whose tokens do not give back their bytes, have zeros and an
    empty digest, and count for no pair. Repeated rows are documents of their own. NULL ids are
    kept. Extra columns are not read. ``with_groups`` adds the groups themselves, as text. Both
    tokenizer files must be at the same path on every worker.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = pick(docs, doc_id=id_col, text=text_col).select("doc_id", content().alias("text"))
    tokens = stage(encoded(rows, path_a, path_b), "two-tokenizers")
    pairs = stage(distinct_pairs(tokens, path_a, path_b), "id-pairs")
    count = pairs.count()
    tables = max(1, -(-count // table_pairs))
    table_of = F.pmod(F.xxhash64(F.shiftright("pair", 32)), F.lit(tables))
    for number in range(tables):
        mine = pairs if tables == 1 else pairs.where(table_of == number)
        size = count if tables == 1 else mine.count()
        packed, keys = key_table(mine, size)
        key = uuid4().hex
        sent = spark.sparkContext.broadcast((packed, keys))
        counts = document_counts(tokens, path_a, path_b, sent, key, size)
        by_a = np.concatenate([*keys, np.zeros(0, np.int64)]) >> 32
        names, at = np.unique(by_a, return_inverse=True)
        highest = np.zeros(len(names), np.int64)
        np.maximum.at(highest, at, counts)
        known = spark.sparkContext.broadcast((counts, counts == highest[at]))
        last = number == tables - 1
        tokens = _answered(tokens, path_a, path_b, sent, key, known, number == 0, last, with_groups)
        if not last:
            tokens = stage(tokens, "alignment")
    return tokens


def _answered(tokens, path_a: str, path_b: str, sent, key: str, known, first: bool, last: bool, with_groups: bool) -> DataFrame:
    """The third map. Between tables the ids are carried with what was found so far."""
    kind = tokens.schema["doc_id"].dataType.simpleString()
    added, others = ("n_best", "count_sum"), ("n_a", "n_b", "n_groups", "n_links")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, table = pair_of(path_a, path_b), _table(key, sent)
        counts, best = known.value
        # A pair of another table has number -1: the entry added at the end.
        counts, best = np.append(counts, 0), np.append(best, False)
        for batch in batches:
            n = batch.num_rows
            total = {name: np.zeros(n, np.int64) for name in (*others, *added)}
            if not first:
                total |= {name: batch[name].to_numpy().copy() for name in added}
            digests, groups, open_, texts = [""] * n, [""] * n, hashlib.sha256(), []
            for begin, rows, complete, sequences in sliced(batch, tool.dtype):
                found = align_tokens(tool, sequences, last)
                pairs = table.find(found.keys)
                values = {
                    "n_a": np.array([len(a) for a, _ in sequences]),
                    "n_b": np.array([len(b) for _, b in sequences]),
                    "n_groups": np.diff(found.group_cuts),
                    "n_links": np.diff(found.link_cuts),
                    "n_best": totals(best[pairs], found.link_cuts),
                    "count_sum": totals(counts[pairs], found.link_cuts),
                }
                for name, value in values.items():
                    if rows:
                        total[name][begin : begin + rows] += value
                    else:
                        total[name][begin] += value.sum()
                if not last:
                    continue
                if rows:
                    for k, name in enumerate(found.names):
                        if name:
                            digests[begin + k] = hashlib.sha256(name).hexdigest()
                            groups[begin + k] = name.decode() if with_groups else ""
                    continue
                for name in found.names:
                    open_.update(b";" + name if texts else name)
                    texts.append(name if with_groups else b"")
                if complete:
                    digests[begin] = open_.hexdigest()
                    groups[begin] = b";".join(texts).decode()
                    open_, texts = hashlib.sha256(), []
            columns = {"doc_id": batch["doc_id"]}
            if not last:
                columns |= {name: batch[name] for name in ("a", "b", "parts")}
            columns |= {name: pa.array(total[name], pa.int64()) for name in (*others, *added)}
            if last:
                columns["groups_sha256"] = pa.array(digests, pa.string())
                if with_groups:
                    columns["groups"] = pa.array(groups, pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    schema = f"doc_id {kind}, " + ("" if last else "a binary, b binary, parts array<int>, ")
    schema += ", ".join(f"{name} bigint" for name in (*others, *added))
    if last:
        schema += ", groups_sha256 string" + (", groups string" if with_groups else "")
    return tokens.mapInArrow(run, schema)
