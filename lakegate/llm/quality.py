"""Text quality by a regularised quadratic discriminant over document statistics."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import content, give_back, pick, ship, stage

FEATURES = (
    "log_words",
    "word_bytes",
    "distinct_words",
    "distinct_triples",
    "top_word",
    "top_line",
    "line_words",
    "upper",
    "digits",
    "marks",
    "symbols",
    "bars",
    "stops",
    "short_words",
)
#: Weight of the pooled covariance and of its mean variance in each class covariance.
POOLED, SPHERE = 0.6, 0.01
#: A document is predicted good from this score on.
THRESHOLD = 0.3

_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_DIGITS = bytes(range(48, 58))
_MARKS = b"!?"
_STOPS = b".,;:"
_SYMBOLS = b"#$%&*@^~=+<>{}[]\\/_"


def statistics(text: bytes) -> list[float]:
    """Transformed statistics of one text; an empty text has a vector too."""
    words = text.split()
    n, size = len(words), len(text)
    length = max(1, size - text.count(b" "))

    def share(chars: bytes) -> float:
        return (size - len(text.translate(None, chars))) / length

    counts = Counter(words)
    lines = [x for x in text.split(b"\n") if x]
    repeated = Counter(lines)
    triples = len(set(zip(words, words[1:], words[2:], strict=False)))
    top_line = max((k * len(x) for x, k in repeated.items() if k > 1), default=0)
    return [
        math.log1p(n),
        math.log1p(length / max(1, n)),
        _logit(len(counts), n),
        _logit(triples, max(0, n - 2)),
        _logit(max(counts.values(), default=0), n),
        math.sqrt(top_line / max(1, size)),
        math.log1p(n / max(1, len(lines))),
        math.sqrt(share(_UPPER)),
        math.sqrt(share(_DIGITS)),
        math.sqrt(share(_MARKS)),
        math.sqrt(share(_SYMBOLS)),
        math.sqrt(share(b"|")),
        math.sqrt(share(_STOPS)),
        math.sqrt(sum(len(w) <= 3 for w in words) / max(1, n)),
    ]


def _logit(part: int, whole: int) -> float:
    return math.log((part + 0.5) / (whole - part + 0.5))


@dataclass(frozen=True)
class Discriminant:
    """Class means, inverse Cholesky factors and log-density constants, ready for scoring."""

    means: np.ndarray  # class, feature
    whiteners: np.ndarray  # class, feature, feature: inverse of the Cholesky factor
    constants: np.ndarray  # class: log prior minus half the log determinant
    known: bool = True
    prior: float = 0.5

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 of each row: logistic of the difference of log densities."""
        if not self.known:
            return np.full(len(x), self.prior)
        logs = []
        for mean, whitener, constant in zip(self.means, self.whiteners, self.constants, strict=True):
            z = (x - mean) @ whitener.T
            logs.append(constant - 0.5 * np.einsum("ij,ij->i", z, z))
        return 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def fit(moments: dict[int, tuple[float, np.ndarray, np.ndarray]], pooled: float = POOLED, sphere: float = SPHERE) -> Discriminant:
    """Model from (count, sum, sum of outer products) per class.

    A class covariance is shrunk to the pooled one by ``pooled``, then its diagonal is raised by
    ``sphere`` of the pooled variances. With a class missing the score is the share of class 1,
    without any label 0.5.
    """
    counts = {k: moments[k][0] for k in moments if moments[k][0]}
    if len(counts) < 2:
        prior = float(next(iter(counts))) if counts else 0.5
        return Discriminant(np.zeros((0, 0)), np.zeros((0, 0, 0)), np.zeros(0), False, prior)
    total = sum(counts.values())
    means, spreads = [], []
    for k in (0, 1):
        n, first, second = moments[k]
        mean = first / n
        means.append(mean)
        spreads.append(second / n - np.outer(mean, mean))
    common = sum(counts[k] * spreads[k] for k in (0, 1)) / total
    floor = np.diag(sphere * np.diag(common).clip(0) + 1e-6)
    whiteners, constants = [], []
    for k in (0, 1):
        factor = np.linalg.cholesky((1 - pooled) * spreads[k] + pooled * common + floor)
        whiteners.append(np.linalg.inv(factor))
        constants.append(math.log(counts[k] / total) - float(np.log(np.diag(factor)).sum()))
    return Discriminant(np.array(means), np.array(whiteners), np.array(constants))


def features(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the array of statistics, one row per input row; NULL text is the empty text."""
    ship(docs.sparkSession)
    rows = pick(docs, doc_id=id_col, text=text_col).select("doc_id", content().alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [statistics(t.as_py()) for t in batch["text"]]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch["doc_id"], "features": pa.array(values, pa.list_(pa.float64()))}
            )
        give_back()

    return rows.mapInArrow(run, f"doc_id {id_type}, features array<double>")


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """Rows that no model learns from: CRC-32 of the id's text is a multiple of ``folds``."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == 0, F.lit(False))


def train(found: DataFrame, labels: DataFrame, *, label_col: str = "quality", id_col: str = "doc_id") -> Discriminant:
    """Fit on all rows of ``found`` (doc_id, features) that are labelled 0 or 1 and not held out.

    Every task adds up its rows; what reaches the driver is 2 x 211 sums. A label row whose id or
    label is NULL counts nowhere; a document labelled twice counts twice.
    """
    known = pick(labels, doc_id=id_col, label=label_col).where("doc_id is not null and label in (0, 1)")
    rows = found.where(~held_out()).join(known, "doc_id").select("features", F.col("label").cast("int"))
    width = len(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 + width + width * width))
        for batch in batches:
            label = np.array(batch["label"])
            x = _matrix(batch["features"])
            for k in (0, 1):
                part = x[label == k]
                sums[k] += np.concatenate([[len(part)], part.sum(0), (part.T @ part).ravel()])
        yield pa.RecordBatch.from_pydict(
            {
                "label": pa.array(np.repeat([0, 1], sums.shape[1]), pa.int32()),
                "place": pa.array(np.tile(np.arange(sums.shape[1]), 2), pa.int32()),
                "value": pa.array(sums.ravel(), pa.float64()),
            }
        )

    partial = rows.mapInArrow(run, "label int, place int, value double")
    totals = np.zeros((2, 1 + width + width * width))
    for r in partial.groupBy("label", "place").agg(F.sum("value").alias("value")).collect():
        totals[r["label"], r["place"]] = r["value"]
    return fit({k: (t[0], t[1 : 1 + width], t[1 + width :].reshape(width, width)) for k, t in enumerate(totals)})


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, len(FEATURES))


def scores(found: DataFrame, model: Discriminant) -> DataFrame:
    """doc_id and score of rows (doc_id, features)."""
    id_type = found.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(_matrix(batch["features"])) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "score": pa.array(score)})

    return found.select("doc_id", "features").mapInArrow(run, f"doc_id {id_type}, score double")


def classify(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted, one row per input row.

    The statistics of all documents are computed once and staged; labels, language, source and id
    are no inputs. Empty and NULL texts are scored like any others; extra columns are not read.
    """
    found = stage(features(docs), "quality-features")
    scored = scores(found, train(found, labels))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score ``threshold`` or more, all columns kept.

    Each row is judged on its own where it lies (its statistics are computed again), so that no
    text is shuffled. The statistics learnt from are staged: where their join with the labels is a
    broadcast, the sums would run in the same task, and each core would need two Python workers,
    which stay and are used in turn by all later stages.
    """
    model = train(stage(features(docs, text_col=text_col), "quality-features"), labels)
    position = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics((t.as_py() or "").encode()) for t in batch.column(position)]
            good = model.score(np.array(rows).reshape(-1, len(FEATURES))) >= threshold
            yield batch.filter(pa.array(good, pa.bool_()))
        give_back()

    return docs.mapInArrow(run, docs.schema)
