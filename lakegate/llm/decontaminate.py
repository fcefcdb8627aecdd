"""Benchmark decontamination with a generalised suffix automaton over words."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from lakegate.llm.common import content, pick, ship, stage

#: Words are runs of ASCII letters and digits, lower-cased, and of any non-ASCII characters.
_FOLD = bytes(
    (c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WINDOW = 10
#: Text of the items that one automaton holds; more items are matched in several passes.
BLOCK_BYTES = 2 * 1024 * 1024

SCHEMA = "doc_id bigint, n_words bigint, spans array<int>, items array<string>"


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Automaton:
    """Suffix automaton of all items: ``length[v]`` and ``link[v]`` per state, ``step`` by word.

    ``windows[v]`` lists the items that have a window of ``window`` words ending in state v, where
    v is the state whose longest word sequence is shortest among those that hold the window.
    Items shorter than a window are kept whole in ``short``, by their words.
    """

    def __init__(self, items: Sequence[tuple[str, bytes]], window: int = WINDOW) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.length, self.link, self.step = [0], [-1], [{}]
        self.short: dict[tuple[int, ...], list[str]] = {}
        number = self.vocabulary.setdefault
        sequences = []
        for item, text in items:
            sequence = [number(w, len(self.vocabulary)) for w in words(text)]
            if len(sequence) >= window:
                sequences.append((item, sequence))
                self._add(sequence)
            elif sequence:
                owners = self.short.setdefault(tuple(sequence), [])
                if item not in owners:
                    owners.append(item)
        self.short_lengths = sorted({len(s) for s in self.short})
        self.windows: dict[int, list[str]] = {}
        for item, sequence in sequences:
            state = size = 0
            for word in sequence:
                state, size = self.advance(state, size, word)
                state, size = self.shorten(state, size, window)
                if size == window:
                    owners = self.windows.setdefault(state, [])
                    if item not in owners:
                        owners.append(item)

    def _state(self, length: int, link: int, step: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.step.append(step)
        return len(self.length) - 1

    def _add(self, sequence: list[int]) -> None:
        """Extend by one item; each item starts again at the root."""
        last = 0
        for word in sequence:
            known = self.step[last].get(word)
            if known is not None:
                # The extended sequence occurs already: take its state, split off if needed.
                last = known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
                continue
            new = self._state(self.length[last] + 1, 0, {})
            at = last
            while at >= 0 and word not in self.step[at]:
                self.step[at][word] = new
                at = self.link[at]
            if at >= 0:
                target = self.step[at][word]
                exact = self.length[target] == self.length[at] + 1
                self.link[new] = target if exact else self._split(at, word, target)
            last = new

    def _split(self, at: int, word: int, target: int) -> int:
        twin = self._state(self.length[at] + 1, self.link[target], dict(self.step[target]))
        self.link[target] = twin
        while at >= 0 and self.step[at].get(word) == target:
            self.step[at][word] = twin
            at = self.link[at]
        return twin

    def advance(self, state: int, size: int, word: int) -> tuple[int, int]:
        """State and length of the longest item sequence that ends with this word."""
        while state and word not in self.step[state]:
            state = self.link[state]
            size = self.length[state]
        following = self.step[state].get(word)
        return (0, 0) if following is None else (following, size + 1)

    def shorten(self, state: int, size: int, most: int) -> tuple[int, int]:
        """The same match cut to its last ``most`` words."""
        if size > most:
            size = most
            while self.length[self.link[state]] >= size:
                state = self.link[state]
        return state, size

    def match(self, text: list[bytes]) -> tuple[list[int], set[str]]:
        """Hit words as flat [start, end, …] spans in order, and the items whose windows occur."""
        get, window = self.vocabulary.get, self.window
        spans: list[int] = []
        found: set[str] = set()
        state = size = run = 0
        ids: list[int] = []  # the words since the last unknown one
        for i, word in enumerate(map(get, text)):
            if word is None:
                if run:
                    state = size = run = 0
                    ids.clear()
                continue
            run += 1
            # ``state`` stays at most ``window`` words deep, so ``size`` never passes the window.
            state, size = self.advance(state, size, word)
            state, size = self.shorten(state, size, window)
            if size == window:
                found.update(self.windows[state])
                _cover(spans, i + 1 - window, i + 1)
            if self.short_lengths:
                ids.append(word)
                for n in self.short_lengths:
                    if n > run:
                        break
                    owners = self.short.get(tuple(ids[-n:]))
                    if owners:
                        found.update(owners)
                        _cover(spans, i + 1 - n, i + 1)
                if len(ids) > 4 * window:
                    del ids[: -window]
        return spans, found


def _cover(spans: list[int], start: int, end: int) -> None:
    """Add a span whose end is not before the ends of the earlier ones; touching spans join."""
    while spans and spans[-1] >= start:
        start = min(start, spans[-2])
        del spans[-2:]
    spans += (start, end)


def merge_spans(one: Sequence[int], other: Sequence[int]) -> list[int]:
    pairs = sorted([*zip(one[::2], one[1::2], strict=True), *zip(other[::2], other[1::2], strict=True)])
    spans: list[int] = []
    for start, end in pairs:
        if spans and spans[-1] >= start:
            spans[-1] = max(spans[-1], end)
        else:
            spans += (start, end)
    return spans


_CACHE: dict[str, Automaton] = {}


def _automaton(items: Sequence[tuple[str, bytes]], window: int) -> Automaton:
    """Built once per Python worker; one block is held at a time."""
    key = hashlib.sha256(repr((window, items)).encode()).hexdigest()
    if key not in _CACHE:
        _CACHE.clear()
        _CACHE[key] = Automaton(items, window)
    return _CACHE[key]


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> list[list[tuple[str, bytes]]]:
    """The test items in blocks of bounded size (an item larger than a block is one of its own)."""
    rows = pick(items, item_id=id_col, text=text_col).select(
        F.col("item_id").cast("string").alias("item_id"), content().alias("text")
    ).where(F.col("item_id").isNotNull())
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).collect()[0]["n"]
    count = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    out = []
    for number in range(count):
        part = rows.where(block == number).distinct().collect()  # about block_bytes
        if part or not out:
            out.append(sorted((r["item_id"], bytes(r["text"])) for r in part))
    return out


def contamination(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    with_text: bool = False,
) -> DataFrame:
    """One row per document: doc_id, n_words, spans (flat starts and ends of hit words), items.

    A map over the documents: words are streamed through the automaton, nothing is shuffled.
    The items are the only thing sent to every task, in blocks of ``block_bytes``; with more than
    one block the documents pass once per block and the spans are united.

    NULL text has no words; a NULL item id is left out; equal item rows count once. Extra columns
    are not read. Repeated rows each get their row. ``with_text`` keeps the text, as bytes.
    """
    ship(docs.sparkSession)
    rows = pick(docs, doc_id=id_col, text=text_col).select(
        "doc_id",
        content().alias("text"),
        F.array().cast("array<int>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    blocks = item_blocks(items, item_col, item_text_col, block_bytes)
    context = docs.sparkSession.sparkContext
    id_type = rows.schema["doc_id"].dataType.simpleString()
    for number, block in enumerate(blocks):
        last = number == len(blocks) - 1
        sent = context.broadcast(block)
        keep_text = with_text or not last
        fields = SCHEMA.replace("doc_id bigint", f"doc_id {id_type}") + (", text binary" if keep_text else "")
        rows = rows.mapInArrow(_matcher(sent, window, keep_text), fields)
        if not last:
            rows = stage(rows, "decontaminate")
    return rows


def _matcher(sent, window: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(sent.value, window)
        for batch in batches:
            n_words, spans, items = [], [], []
            before = zip(batch["text"].to_pylist(), batch["spans"].to_pylist(), batch["items"].to_pylist(), strict=True)
            for text, old_spans, old_items in before:
                sequence = words(text)
                hit, found = automaton.match(sequence)
                n_words.append(len(sequence))
                spans.append(merge_spans(old_spans, hit) if old_spans else hit)
                items.append(sorted(found.union(old_items)))
            columns = {
                "doc_id": batch["doc_id"],
                "n_words": pa.array(n_words, pa.int64()),
                "spans": pa.array(spans, pa.list_(pa.int32())),
                "items": pa.array(items, pa.list_(pa.string())),
            }
            if keep_text:
                columns["text"] = batch["text"]
            yield pa.RecordBatch.from_pydict(columns)

    return run


def n_hit(spans: str = "spans"):
    """Number of hit words, from flat spans."""
    signed = F.transform(spans, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    return F.aggregate(signed, F.lit(0).cast("bigint"), lambda a, x: a + x)


def cut(text: bytes, spans: Sequence[int], min_length: int) -> tuple[bytes, int]:
    """The text without its hit spans of ``min_length`` words or more, and the words removed."""
    bounds = [m.span() for m in _WORD.finditer(text)]
    out, at, removed = [], 0, 0
    for start, end in zip(spans[::2], spans[1::2], strict=True):
        if end - start >= min_length:
            out.append(text[at : bounds[start][0]])
            at = bounds[end - 1][1]
            removed += end - start
    out.append(text[at:])
    return b"".join(out), removed


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    min_length: int = 1,
    max_coverage: float = 0.5,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` without benchmark passages, all columns kept.

    Hit spans of at least ``min_length`` words are cut out of the text (``n_chars``, if there is
    such a column, follows). A document goes when its hit words are more than ``max_coverage`` of
    its words. A clean document is returned as it was, NULL text included.

    With more than one block of items the spans of all blocks are found on the uncut text and
    united before the document is tested and cut, so the result does not depend on ``block_bytes``.
    """
    spark = docs.sparkSession
    ship(spark)
    blocks = item_blocks(items, "item_id", "text", block_bytes)
    position, schema = docs.columns.index(text_col), docs.schema
    carried = "spans"
    while carried in {c.lower() for c in docs.columns}:
        carried += "_"
    with_spans = StructType([*schema.fields, StructField(carried, ArrayType(IntegerType()))])
    for number, block in enumerate(blocks):
        last = number == len(blocks) - 1
        sent = spark.sparkContext.broadcast(block)
        run = _cutter(sent, position, window, min_length, max_coverage, carried, number == 0, last)
        docs = docs.mapInArrow(run, schema if last else with_spans)
        if not last:
            docs = stage(docs, "decontaminate")
    if "n_chars" in docs.columns:
        docs = docs.withColumn("n_chars", F.when(F.col(text_col).isNull(), F.col("n_chars")).otherwise(F.char_length(text_col)).cast(schema["n_chars"].dataType))
    return docs


def _cutter(sent, position: int, window: int, min_length: int, max_coverage: float, name: str, first: bool, last: bool):
    """Spans of one block, united with those of the earlier blocks in the last column; the last one cuts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(sent.value, window)
        for batch in batches:
            texts, kept, carried = batch.column(position).to_pylist(), [], []
            before = [()] * len(texts) if first else batch.column(batch.num_columns - 1).to_pylist()
            for i, text in enumerate(texts):
                raw = (text or "").encode()
                sequence = words(raw)
                spans = merge_spans(before[i], automaton.match(sequence)[0])
                if not last:
                    carried.append(spans)
                    continue
                hit = sum(spans[1::2]) - sum(spans[::2])
                if hit > max_coverage * len(sequence):
                    continue
                if hit:
                    texts[i] = cut(raw, spans, min_length)[0].decode()
                kept.append(i)
            columns = list(batch.columns) if first else batch.columns[:-1]
            names = batch.schema.names[: len(columns)]
            if not last:
                spans_column = pa.array(carried, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*columns, spans_column], [*names, name])
                continue
            columns[position] = pa.array(texts, batch.schema.field(position).type)
            yield pa.RecordBatch.from_arrays(columns, names).take(pa.array(kept, pa.int64()))

    return run
