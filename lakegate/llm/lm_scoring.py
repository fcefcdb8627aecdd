"""Stupid-backoff language-model scores from n-gram counts summed by hash and given back to the texts."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import content, give_back, pick, ship, stage
from lakegate.llm.encoder import slices
from lakegate.llm.wordhash import mix, rolling, word_hashes

ORDER = 3
ALPHA = 0.4
#: Bytes of text whose n-grams are summed before they leave a task, and scored together.
SLICE_BYTES = 4 * 1024 * 1024
#: Bytes of text whose n-grams of one order make one hash bucket.
BUCKET_BYTES = 24 * 1024 * 1024
#: Least number of hash buckets.
LEAST_BUCKETS = 64
_RUN = 0xA0761D6478BD642F
#: Stands before the first word.
_START = np.uint64(0x9D39247E33776D41)

PARTS = "n int, bucket int, slice bigint, grams binary, counts binary, ends binary"
TOTALS = "slice bigint, n int, bucket int, size int, counts binary, ends binary"


class Words:
    """The words of some texts, one after another, with the hash of the n-gram that ends at each.

    The first words are preceded by start signs, so every word has an n-gram of every order.
    """

    def __init__(self, texts: Sequence[bytes], order: int) -> None:
        found = [words for _, part in slices(texts, SLICE_BYTES) for words in word_hashes(part)]
        self.lengths = np.array([len(words) for words in found], np.int64)
        self.text = np.repeat(np.arange(len(found)), self.lengths)
        ends = np.cumsum(self.lengths)
        #: Last words of the texts that have any, and first ones.
        self.last = ends[self.lengths > 0] - 1
        self.first = (ends - self.lengths)[self.lengths > 0]
        self._at = np.arange(len(self.text)) + (self.text + 1) * (order - 1)
        self._padded = np.full(len(self.text) + len(found) * (order - 1), _START)
        if found:
            self._padded[self._at] = np.concatenate(found)

    def grams(self, n: int) -> np.ndarray:
        return mix(rolling(self._padded, n, _RUN), 20 + n)[self._at - (n - 1)]


def _packed(grams: np.ndarray) -> bytes:
    """Sorted hashes byte by byte: their first bytes are nearly equal, so they compress."""
    return grams.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _numbers(values: np.ndarray) -> bytes:
    """Counts in as many bytes each as the largest needs."""
    return values.astype(np.min_scalar_type(int(values.max()))).tobytes()


def _read(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(blob, f"<u{len(blob) // n}").astype(np.int64)


def _partial(words: Words, orders: Sequence[int], buckets: int, number: int | None, counted: bool) -> Iterator[tuple]:
    """PARTS rows of a slice: its distinct n-grams by bucket, how often they occur and how often as the last of a text."""
    for n in orders:
        grams, which = np.unique(words.grams(n), return_inverse=True)
        if not len(grams):
            return
        counts = np.bincount(which, minlength=len(grams))
        ends = np.bincount(which[words.last], minlength=len(grams))
        bucket = (grams >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=bucket[0] + np.uint64(1))), len(grams))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            held = (_numbers(counts[a:b]), _numbers(ends[a:b])) if counted else (None, None)
            yield n, int(bucket[a]), number, _packed(grams[a:b]), *held


_PARTS = pa.schema(
    [("n", pa.int32()), ("bucket", pa.int32()), ("slice", pa.int64())]
    + [(name, pa.binary()) for name in ("grams", "counts", "ends")]
)
_TOTALS = pa.schema(
    [("slice", pa.int64())]
    + [(name, pa.int32()) for name in ("n", "bucket", "size")]
    + [(name, pa.binary()) for name in ("counts", "ends")]
)


def _table(rows: Sequence[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _asked(placed: DataFrame, orders: Sequence[int], buckets: int, counted: bool) -> DataFrame:
    """The n-grams of each slice of the texts to be scored, counted in case they belong to the corpus."""

    def run(rows: pa.Table) -> pa.Table:
        words = Words(rows["text"].to_pylist(), max(orders))
        out = _table([*_partial(words, orders, buckets, rows["slice"][0].as_py(), counted)], _PARTS)
        give_back()
        return out

    return placed.select("slice", "text").groupBy("slice").applyInArrow(run, PARTS)


def _counted(corpus: DataFrame, orders: Sequence[int], buckets: int) -> DataFrame:
    """The n-grams of a corpus that is not scored itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in slices(batch["text"].to_pylist(), SLICE_BYTES):
                rows = [*_partial(Words(part, max(orders)), orders, buckets, None, True)]
                yield from _table(rows, _PARTS).to_batches()
        give_back()

    return corpus.select("text").mapInArrow(run, PARTS)


def _totals(parts: DataFrame) -> DataFrame:
    """For each slice its n-grams' counts in the corpus, in the order of their hashes."""

    def run(rows: pa.Table) -> pa.Table:
        n, bucket = rows["n"][0].as_py(), rows["bucket"][0].as_py()
        held = [_unpacked(blob) for blob in rows["grams"].to_pylist()]
        cuts = np.cumsum([0, *map(len, held)])
        grams, which = np.unique(np.concatenate(held), return_inverse=True)
        sums = []
        for name in ("counts", "ends"):
            sum_ = np.zeros(len(grams), np.int64)
            for blob, a, b in zip(rows[name].to_pylist(), cuts[:-1], cuts[1:], strict=True):
                if blob is not None:
                    # The n-grams of a part are distinct.
                    sum_[which[a:b]] += _read(blob, b - a)
            sums.append(sum_)
        out = [
            (number, n, bucket, b - a, *(_numbers(x[which[a:b]]) for x in sums))
            for number, a, b in zip(rows["slice"].to_pylist(), cuts[:-1], cuts[1:], strict=True)
            if number is not None
        ]
        out = _table(out, _TOTALS)
        give_back()
        return out

    return parts.groupBy("n", "bucket").applyInArrow(run, TOTALS)


def _own(words: Words, which: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How often the n-gram of each word occurs in the word's own text, a part of the corpus."""
    out = np.ones(len(which), np.int64)
    several = counts > 1
    pairs = words.text[several] * (int(which.max()) + 1) + which[several]
    _, at, mine = np.unique(pairs, return_inverse=True, return_counts=True)
    out[several] = mine[at]
    return out


def _log_scores(
    words: Words, totals: dict[int, tuple[np.ndarray, np.ndarray]], order: int, total: int, texts: int, alpha: float, own: bool
) -> np.ndarray:
    """Each word's score.

    ``totals`` are an order's counts and ends for the sorted distinct n-grams. The count of a
    context is that of the n-gram one shorter that ends at the word before, less its ends.
    """
    rest = np.maximum(1, total - words.lengths[words.text] * own)
    scores = np.log(0.5 / rest)
    above = rest
    for n in range(1, order + 1):
        _, which = np.unique(words.grams(n), return_inverse=True)
        left, ends = (x[which] for x in totals[n])
        if own:
            closing = np.zeros(len(words.lengths), np.int64)
            closing[words.text[words.last]] = which[words.last]
            left = left - _own(words, which, left)
            ends = ends - (closing[words.text] == which)
        found = left > 0
        if n > 1:
            scores += math.log(alpha)
        scores[found] = np.log(left[found] / above[found])
        above = np.roll(left - ends, 1)
        above[words.first] = texts - own
    return scores


def score(
    docs: DataFrame,
    corpus: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = ORDER,
    alpha: float = ALPHA,
    own: bool = False,
) -> DataFrame:
    """doc_id, n_words, log_score (sum of natural logs), per_word, one row per row of ``docs``.

    Counts are taken over all rows of ``corpus`` (a frame with a column ``text_col``). A word's
    score is the share of its n-gram in the counts of its context; where the n-gram was never
    counted it is ``alpha`` times the score by one word less, at last the word's share of all words,
    or of half a count for a word never seen. Start signs precede the first words of a text. ``own``
    says that the rows of ``docs`` are rows of ``corpus``: each is scored by the counts of all other
    rows, its own counts being taken off those of its n-grams, their contexts and all words.

    The texts are dealt by hash into slices of about SLICE_BYTES. A slice sends its distinct
    n-grams with their counts to buckets by hash, where they are summed over the corpus, and gets
    the sums back in the same order; then each of its texts is scored. A frequent n-gram is sent
    once per slice. The highest order goes first and alone, so that the n-grams of two high orders
    are not on disk at once. The numbers of slices and buckets follow the texts, so a bucket holds the
    n-grams of at most about BUCKET_BYTES of text.

    Words are runs of anything but ASCII white space. NULL and empty texts have no words, log_score 0 and
    per_word NULL. Repeated rows get equal scores. Extra columns are not read. With an empty corpus
    every word counts as never seen.
    """
    spark = docs.sparkSession
    ship(spark)
    same = own and docs is corpus
    rows = pick(docs, doc_id=id_col, text=text_col).select("doc_id", content().alias("text"))
    counted = pick(corpus, text=text_col).select(content().alias("text"))
    words = F.regexp_count(F.col("text").cast("string"), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")
    of_bytes = F.coalesce(F.sum(F.octet_length("text")), F.lit(0))
    size, total, texts = counted.agg(of_bytes, F.coalesce(F.sum(words), F.lit(0)), F.count_if(words > 0)).first()
    asked = size if same else rows.agg(of_bytes).first()[0]
    buckets = max(LEAST_BUCKETS, -(-(size if same else size + asked) // BUCKET_BYTES))
    number = F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(1, -(-asked // SLICE_BYTES))))
    placed = rows.select(number.cast("bigint").alias("slice"), "doc_id", "text")

    answers: DataFrame | None = None
    rounds = [*((n,) for n in range(order, 2, -1)), tuple(range(min(order, 2), 0, -1))]
    for orders in rounds:
        parts = _asked(placed, orders, buckets, same)
        if not same:
            parts = parts.unionByName(_counted(counted, orders, buckets))
        answer = stage(_totals(parts), f"lm-order-{orders[0]}")
        answers = answer if answers is None else answers.unionByName(answer)

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        found = Words(rows["text"].to_pylist(), order)
        held: dict[int, list[tuple]] = {n: [] for n in range(1, order + 1)}
        for row in answers.to_pylist():
            held[row["n"]].append((row["bucket"], row["size"], row["counts"], row["ends"]))
        sums = np.zeros(rows.num_rows)
        if len(found.text):
            # Buckets follow the hashes, so their answers in order are those of the sorted n-grams.
            totals = {
                n: tuple(np.concatenate([_read(x[k], x[1]) for x in sorted(parts)]) for k in (2, 3))
                for n, parts in held.items()
            }
            scores = _log_scores(found, totals, order, total, texts, alpha, own)
            sums = np.bincount(found.text, scores, len(sums))
        n_words = pa.array(found.lengths)
        log_score = pa.array(sums)
        per_word = pa.array(sums / np.maximum(1, found.lengths), mask=found.lengths == 0)
        out = pa.table({"doc_id": rows["doc_id"], "n_words": n_words, "log_score": log_score, "per_word": per_word})
        give_back()
        return out

    id_type = rows.schema["doc_id"].dataType.simpleString()
    pairs = placed.groupBy("slice").cogroup(answers.groupBy("slice"))
    return pairs.applyInArrow(run, f"doc_id {id_type}, n_words bigint, log_score double, per_word double")


def score_corpus(docs: DataFrame, **options) -> DataFrame:
    """Every document scored by the counts of all other documents."""
    return score(docs, docs, own=True, **options)
