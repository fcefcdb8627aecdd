"""Ranked search of documents for many items by an Aho-Corasick scan of the texts, without an index."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from uuid import uuid4

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakegate.llm.common import content, pick, ship, stage
from lakegate.sources.staging import shared_folder

#: Terms are runs of ASCII letters and digits (A-Z lower-cased) and of any non-ASCII characters.
_FOLD = bytes(
    (c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)
#: Text of the items that one automaton holds (a larger item has one of its own).
BLOCK_BYTES = 4 * 1024 * 1024
#: Scores held at once in a task: documents times items.
CELLS = 1_000_000
#: Text scanned at once.
PART = 4 * 1024 * 1024
_DOCUMENTS, _TERMS = -1, -2


def folded(text: bytes) -> bytes:
    return text.translate(_FOLD)


class Items:
    """The automaton over all terms of some items, and which items each term stands in.

    A term is guarded by a space on either side, and texts are scanned with every other separator
    turned into one, so the automaton stops at whole terms only. Its output is the term's number;
    ``first[t]:first[t + 1]`` are the term's entries in ``item`` and ``times``.
    """

    def __init__(self, texts: Sequence[bytes]) -> None:
        counts = [Counter(folded(text).split()) for text in texts]
        self.numbers: dict[bytes, int] = {}
        for found in counts:
            for term in sorted(found):
                self.numbers.setdefault(term, len(self.numbers))
        places: list[list[tuple[int, int]]] = [[] for _ in self.numbers]
        for item, found in enumerate(counts):
            for term, times in found.items():
                places[self.numbers[term]].append((item, times))
        self.first = np.cumsum([0, *map(len, places)])
        flat = [pair for part in places for pair in part]
        self.item = np.array([i for i, _ in flat], np.int64)
        self.times = np.array([n for _, n in flat], np.int64)
        self.automaton = None
        if self.numbers:
            self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
            for term, number in self.numbers.items():
                self.automaton.add_word(f" {term.decode('latin-1')} ", number)
            self.automaton.make_automaton()

    def count(self, text: bytes) -> tuple[int, Counter]:
        """Number of terms of a text, and how often it holds each term of the items."""
        n, found, at = 0, Counter(), 0
        text = folded(text)
        while at < len(text):
            end = text.find(b" ", at + PART)
            part = text[at:end] if end >= 0 else text[at:]
            at += len(part)
            n += len(part.split())
            if self.automaton is not None:
                found.update(t for _, t in self.automaton.iter(f" {part.decode('latin-1')} "))
        return n, found


_CACHE: dict[str, Items] = {}


def _items(key: str, texts: Sequence[bytes]) -> Items:
    """Built once per Python worker; one block is held at a time."""
    if key not in _CACHE:
        _CACHE.clear()
        _CACHE[key] = Items(texts)
    return _CACHE[key]


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Best:
    """The best documents of each item so far: score falling, then id rising, NULL ids last."""

    def __init__(self, items: int, k: int) -> None:
        self.k = k
        self.least = np.zeros(items, np.int64)  # what a score must reach to matter
        self.rows: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def offer(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        """``scores``: documents by items."""
        doc, item = np.nonzero((scores > 0) & (scores >= self.least))
        if len(doc):
            self.rows.append((item, scores[doc, item], missing[doc], ids[doc]))
            self.size += len(doc)
            if self.size > 4 * self.k * len(self.least) + 4096:
                self.settle()

    def settle(self) -> tuple[np.ndarray, ...]:
        if not self.rows:
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        item, score, missing, ids = (np.concatenate(x) for x in zip(*self.rows, strict=True))
        order = np.lexsort((ids, missing, -score, item))
        item, score, missing, ids = item[order], score[order], missing[order], ids[order]
        begins = np.searchsorted(item, item)
        rank = np.arange(len(item)) - begins
        kept = rank < self.k
        last = rank == self.k - 1
        self.least[item[last]] = score[last]
        self.rows = [(item[kept], score[kept], missing[kept], ids[kept])]
        self.size = int(kept.sum())
        return self.rows[0]


def _numbered_items(items: DataFrame, item_col: str, text_col: str, block_bytes: int) -> tuple[str, int, DataFrame]:
    """Distinct items with a block number, in a folder by block; a block holds about ``block_bytes``."""
    spark = items.sparkSession
    rows = pick(items, item_id=item_col, text=text_col).select("item_id", content().alias("text")).distinct()
    sized = rows.select(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n"))
    blocks = max(1, -(-sized.collect()[0]["n"] // block_bytes))
    path = f"{shared_folder(spark)}/lakegate-stage/items-{uuid4().hex}"
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).alias("block")
    rows.select("item_id", "text", block).repartition("block").write.partitionBy("block").parquet(path)
    return path, blocks, rows


def search(
    docs: DataFrame,
    items: DataFrame,
    *,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank, doc_id, score.

    Two maps over the texts for each block of items, and no index of the documents. The first
    counts documents, terms and, for each term of the items, the documents that hold it; the
    second scores each document by what the automaton finds in it. A task passes on at most k
    rows an item, and these are ranked in two steps, so no item meets in one task. Only the items
    of a block and their counts (at most ``block_bytes`` of text) are sent to the tasks.

    NULL, empty and term-less texts score nothing; items without terms, or found nowhere, have no
    rows. Every row is a document, repeated rows too; equal scores go by id, NULL ids last, and
    repeated rows of one id in any order, as they do not differ. Items equal in id and text count
    once; one id with two texts gets a ranking for each. Ids are whole numbers. Extra columns are
    not read.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), content().alias("text")
    )
    path, blocks, _ = _numbered_items(items, item_col, item_text_col, block_bytes)
    item_type = items.schema[item_col].dataType
    stored = spark.read.schema(f"item_id {item_type.simpleString()}, text binary, block int").parquet(path)
    parts = []
    for number in range(blocks):
        # One block is about block_bytes of text.
        block = sorted(stored.where(F.col("block") == number).collect(), key=lambda r: (str(r["item_id"]), r["text"]))
        if block or not parts:
            parts.append(_search_block(spark, rows, block, item_type, k))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def _search_block(spark: SparkSession, rows: DataFrame, block: list, item_type, k: int) -> DataFrame:
    texts = [bytes(r["text"]) for r in block]
    key = uuid4().hex
    sent = spark.sparkContext.broadcast(texts)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = _items(key, sent.value)
        held = np.zeros(len(tool.numbers), np.int64)
        documents = terms = 0
        for batch in batches:
            for text in batch["text"]:
                n, found = tool.count(text.as_py())
                documents += n > 0
                terms += n
                held[list(found)] += 1
        named = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict(
            {
                "term": pa.array([_DOCUMENTS, _TERMS, *named.tolist()], pa.int64()),
                "n": pa.array([documents, terms, *held[named].tolist()], pa.int64()),
            }
        )

    totals = rows.select("text").mapInArrow(counted, "term bigint, n bigint")
    figures = {r["term"]: r["n"] for r in totals.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    documents, terms = figures.pop(_DOCUMENTS, 0), figures.pop(_TERMS, 0)
    weights = spark.sparkContext.broadcast({t: weight(documents, df) for t, df in figures.items()})

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = _items(key, sent.value)
        w = np.zeros(len(tool.numbers), np.int64)
        for term, value in weights.value.items():
            w[term] = value
        best = Best(len(block), k)
        step = max(1, CELLS // max(1, len(block)))
        for batch in batches:
            column = batch["doc_id"]
            ids = column.fill_null(0).to_numpy(zero_copy_only=False)
            missing = column.is_null().to_numpy(zero_copy_only=False)
            for begin in range(0, batch.num_rows, step):
                part = batch["text"].slice(begin, step)
                at = slice(begin, begin + len(part))
                best.offer(_scores(tool, part, w, len(block), documents, terms), ids[at], missing[at])
        item, score, missing, ids = best.settle()
        yield pa.RecordBatch.from_pydict(
            {
                "item": pa.array(item, pa.int32()),
                "doc_id": pa.array(ids, pa.int64(), mask=missing.astype(bool)),
                "score": pa.array(score, pa.int64()),
            }
        )

    found = rows.mapInArrow(scored, "item int, doc_id bigint, score bigint")
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(64))
    rank = F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))
    few = found.withColumn("part", part).withColumn("rank", rank).where(F.col("rank") <= k)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    ranked = stage(few.drop("rank", "part").withColumn("rank", rank).where(F.col("rank") <= k), "lexical-search")
    names = spark.createDataFrame(
        [(i, r["item_id"]) for i, r in enumerate(block)], f"item int, item_id {item_type.simpleString()}"
    )
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def _scores(tool: Items, texts: pa.Array, w: np.ndarray, items: int, documents: int, terms: int) -> np.ndarray:
    """Scores of some documents (rows) for all items of the block (columns)."""
    doc, term, value = [], [], []
    for row, text in enumerate(texts):
        n, found = tool.count(text.as_py())
        if found:
            m = 100 - 75 + (75 * n * documents) // terms
            doc += [row] * len(found)
            term += found
            value += [1_000_000_000 * tf // (1000 * tf + 8 * m) for tf in found.values()]
    scores = np.zeros(len(texts) * items, np.int64)
    if doc:
        doc, term = np.array(doc, np.int64), np.array(term, np.int64)
        value = np.array(value, np.int64) * w[term]
        size = tool.first[term + 1] - tool.first[term]
        begin = np.cumsum(size) - size
        entry = np.arange(int(size.sum())) - np.repeat(begin - tool.first[term], size)
        np.add.at(
            scores,
            np.repeat(doc, size) * items + tool.item[entry],
            np.repeat(value, size) * tool.times[entry],
        )
    return scores.reshape(len(texts), items)
