"""Removal of word passages that occur elsewhere, by level-wise doubling of the window."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import content, pick, ship, stage
from lakegate.llm.encoder import slices
from lakegate.llm.wordhash import mix, rolling, word_hashes

WINDOW = 35
#: The first level's windows are no shorter than this many words.
SHORTEST = 16
_RUN = 0xE7037ED1A0B428DB
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def levels(window: int, shortest: int = SHORTEST) -> list[int]:
    """Window lengths, each at most twice the one before, the last the wanted one."""
    out = [window]
    while -(-out[0] // 2) >= shortest:
        out.insert(0, -(-out[0] // 2))
    return out


def runs(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of each window of ``length`` words."""
    return mix(rolling(words, length, _RUN), length)


def anchors(words: np.ndarray, length: int, window: int) -> np.ndarray:
    """Per window, the start of the shorter window of ``length`` that stands for it.

    That is the one with the smallest hash inside, the first of equals, so equal windows have
    equal anchors: where an anchor's words occur once in the corpus, its windows occur once too.
    """
    inner = runs(words, length)
    span = window - length + 1
    if len(inner) < span:
        return np.zeros(0, np.int64)
    best = np.arange(len(inner), dtype=np.int64)
    width = 1
    while 2 * width <= span:
        best = _lower(inner, best[:-width], best[width:])
        width *= 2
    if width < span:
        best = _lower(inner, best[: len(best) - (span - width)], best[span - width :])
    return best


def _lower(values: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.where(values[right] < values[left], right, left)


def windows_of(words: np.ndarray, length: int, window: int, known: dict[int, np.ndarray]) -> np.ndarray:
    """Starts of the windows of ``length`` to look at: those whose shorter levels are all repeated.

    At the last level these are windows, before it they are the windows' anchors.
    """
    total = len(words) - window + 1
    if total <= 0:
        return np.zeros(0, np.int64)
    alive = np.ones(total, bool)
    for shorter, repeated in known.items():
        alive &= np.isin(runs(words, shorter)[anchors(words, shorter, window)], repeated)
    if length == window:
        return np.flatnonzero(alive)
    return np.unique(anchors(words, length, window)[alive])


def _hash_rows(docs: DataFrame, length: int, window: int, shorter: list[int]) -> DataFrame:
    """(hash, key, several): the windows of one level per document, each hash once.

    ``several``: the hash starts at more than one place of the document. Documents have, per
    shorter level, a column with the repeated hashes of their text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, places = batch["text"].to_pylist(), batch["key"].to_numpy(zero_copy_only=False)
            known = {n: batch[f"level_{n}"] for n in shorter}
            for begin, part in slices(texts):
                hashes, owners, several = [], [], []
                for i, words in enumerate(word_hashes(part), begin):
                    lists = {n: _numbers(column[i]) for n, column in known.items()}
                    starts = windows_of(words, length, window, lists)
                    if not len(starts):
                        continue
                    found, times = np.unique(runs(words, length)[starts], return_counts=True)
                    hashes.append(found.view(np.int64))
                    several.append(times > 1)
                    owners.append(np.full(len(found), places[i]))
                if hashes:
                    columns = [np.concatenate(x) for x in (hashes, owners, several)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["hash", "key", "several"])

    return docs.mapInArrow(run, "hash bigint, key bigint, several boolean")


def _numbers(value: pa.ListScalar) -> np.ndarray:
    values = value.values
    return np.zeros(0, np.uint64) if values is None else values.to_numpy().view(np.uint64)


def _repeated(rows: DataFrame, column: str) -> DataFrame:
    """(key, column): the hashes of each text that start at two places or more in the corpus."""
    twice = (
        rows.groupBy("hash")
        .agg(F.count("*").alias("n"), F.max("several").alias("several"))
        .where("n > 1 or several")
        .select("hash")
    )
    # collect_set is partial per task, so the copies of a hot text meet before the shuffle.
    return rows.join(twice, "hash").groupBy("key").agg(F.collect_set("hash").alias(column))


def repeated_windows(docs: DataFrame, window: int = WINDOW, shortest: int = SHORTEST) -> DataFrame:
    """(key, hashes) of texts with repeated windows (rows: text, key)."""
    found: list[DataFrame] = []
    lengths = levels(window, shortest)
    for number, length in enumerate(lengths):
        rows = docs.select("text", "key")
        # Only texts with candidates at the level before are looked at again.
        for lists in found:
            rows = rows.join(lists, "key")
        hashed = stage(_hash_rows(rows, length, window, lengths[:number]), f"substring-{length}")
        found.append(stage(_repeated(hashed, f"level_{length}"), f"substring-{length}-repeated"))
    return found[-1].select("key", F.col(f"level_{window}").alias("hashes"))


def covered(words: np.ndarray, window: int, repeated: np.ndarray) -> np.ndarray:
    """Which words lie in a repeated window."""
    edges = np.zeros(len(words) + 1, np.int64)
    if len(repeated) and len(words) >= window:
        starts = np.flatnonzero(np.isin(runs(words, window), repeated))
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + window, -1)
    return np.cumsum(edges[:-1]) > 0


def substring_dedup(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    shortest: int = SHORTEST,
    with_text: bool = False,
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept (words joined by one space).

    A word goes when a window of ``window`` words over it starts at another place of the corpus
    too, the same document included; all copies go. Windows are found level by level
    (:func:`levels`): what is repeated at one length alone is looked at again at up to twice that
    length. Before the last level a window is represented by an anchor inside it, so only about
    one in ten positions is hashed into the shuffle. Beyond ``window`` no level is needed: a longer
    repeat is covered by its repeated windows.

    Texts are found again by a 64-bit key; texts with one key share their lists of hashes, which
    are facts about the whole corpus, so that is harmless. Windows are told apart by 64-bit hashes
    at the last level and, independently, at each one before. NULL text has no words; a text
    shorter than a window keeps all. Repeated rows are copies of each other. Extra columns are not
    read; an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    rows = pick(docs, doc_id=id_col, text=text_col).select("doc_id", content().alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text"))
    lists = repeated_windows(rows, window, shortest)
    joined = rows.join(lists, "key", "left").select("doc_id", "text", "hashes")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            for begin, part in slices(texts):
                counts, removed, digests, kept = [], [], [], []
                for i, text in enumerate(part, begin):
                    words = _WORD.findall(text)
                    repeated = _numbers(batch["hashes"][i])
                    if len(repeated):
                        gone = covered(word_hashes([text])[0], window, repeated)
                        left = [w for w, g in zip(words, gone, strict=True) if not g]
                    else:
                        left = words
                    text = b" ".join(left)
                    counts.append(len(words))
                    removed.append(len(words) - len(left))
                    digests.append(hashlib.sha256(text).hexdigest())
                    if with_text:
                        kept.append(text.decode())
                columns = {
                    "doc_id": batch["doc_id"].slice(begin, len(part)),
                    "n_words": pa.array(counts, pa.int64()),
                    "n_removed": pa.array(removed, pa.int64()),
                    "kept_sha256": pa.array(digests, pa.string()),
                }
                if with_text:
                    columns["kept"] = pa.array(kept, pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    fields = f"doc_id {id_type}, n_words bigint, n_removed bigint, kept_sha256 string"
    return joined.mapInArrow(run, fields + (", kept string" if with_text else ""))
