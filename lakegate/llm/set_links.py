"""Links among the members of the Jaccard join's buckets: parity sketches first, then the words.

A sketch is the parity of a set's tokens in each of some bits. Two sketches differ in at most as
many bits as the sets differ in tokens, so pairs whose sketches differ in too many bits are no
partners for certain. The rest is decided on the words of both texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import partitions, stage
from lakegate.llm.wordhash import LOWER, mix

#: Members of a bucket that are compared in one piece.
BLOCK = 512
#: Longest sketch. Pairs of sets too large for it are decided on their words instead.
SKETCH_BITS = 1 << 15
_FAR = np.int64(1) << 60
_PAIRS = "low bigint, high bigint"


def sketch(tokens: np.ndarray) -> bytes:
    """About one bit per token; a sketch twice as long folds to the shorter one by XOR."""
    bits = min(SKETCH_BITS, max(64, 1 << (len(tokens) - 1).bit_length()))
    at = (mix(tokens, 11) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """The sketches at the length of the shortest, one row each."""
    width = min(map(len, sketches)) // 8
    out = np.empty((len(sketches), width), np.uint64)
    for i, one in enumerate(sketches):
        words = np.frombuffer(one, np.uint64)
        while len(words) > width:
            words = words[: len(words) // 2] ^ words[len(words) // 2 :]
        out[i] = words
    return out


def differing_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which each row of ``a`` differs from each of ``b``."""
    out = np.empty((len(a), len(b)), np.int64)
    step = max(1, 2_000_000 // max(1, b.size))
    for i in range(0, len(a), step):
        out[i : i + step] = np.bitwise_count(a[i : i + step, None, :] ^ b[None, :, :]).sum(2, dtype=np.int64)
    return out


def possible(a: np.ndarray, b: np.ndarray, bits: np.ndarray, percent: int) -> np.ndarray:
    """Pairs that sizes and sketches leave open.

    With s tokens in both together and d in one alone, ``100 * intersection >= percent * union``
    is ``100 * (s - d) >= percent * (s + d)``.
    """
    a, b = a[:, None], b[None, :]
    sizes = 100 * np.minimum(a, b) >= percent * np.maximum(a, b)
    return sizes & (bits * (100 + percent) <= (a + b) * (100 - percent))


def forest(nodes: list[int], sizes: list[int], sketches: list[bytes], percent: int) -> list[tuple[int, int]]:
    """Pairs (low, high) that connect all members which possible pairs connect, nearest first.

    Equal distances are put in an order that depends on the pair alone, so that buckets with the
    same members propose the same pairs.
    """
    n, rows = np.array(sizes, np.int64), folded(sketches)
    bits = differing_bits(rows, rows)
    marks = mix(np.array(nodes, np.int64).view(np.uint64), 12)
    order = (mix(marks[:, None] + marks[None, :], 13) >> np.uint64(24)).astype(np.int64)
    weight = np.where(possible(n, n, bits, percent), (bits << 40) | order, _FAR)
    best, via = np.full(len(nodes), _FAR), np.zeros(len(nodes), np.int64)
    taken = np.zeros(len(nodes), bool)
    out = []
    for _ in range(len(nodes)):
        at = int(np.argmin(np.where(taken, _FAR + 1, best)))
        if best[at] < _FAR:
            out.append(_pair(nodes[at], nodes[via[at]]))
        taken[at] = True
        nearer = weight[at] < best
        best[nearer], via[nearer] = weight[at][nearer], at
    return out


def _pair(a: int, b: int) -> tuple[int, int]:
    return (a, b) if a < b else (b, a)


def proposed(met: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """(bucket, low, high): forests of each bucket's possible pairs, at most a pair per member.

    A bucket of more than BLOCK members is cut into blocks, each with the bucket's ``first``
    member, which near copies of one text are near to.
    """
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    mine = F.array(_dealt(blocks))
    block = F.explode(F.when(F.col("node") == F.col("first"), F.sequence(F.lit(0), blocks - 1)).otherwise(mine))
    rows = met.select("bucket", block.alias("block"), "node").join(sketches, "node")
    rows = rows.select("bucket", "block", "node", "n", "sketch")
    rows = rows.repartition(partitions(met.sparkSession), "bucket", "block").sortWithinPartitions("bucket", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (bucket, _), members in groupby(_rows(batches), key=lambda r: r[:2]):
            _, _, nodes, sizes, marks = zip(*members, strict=True)
            if len(nodes) > 1:
                out += [(bucket, *pair) for pair in forest(nodes, sizes, marks, percent)]
            if len(out) >= 10_000:
                yield _batch(out, "bucket", "low", "high")
                out = []
        yield _batch(out, "bucket", "low", "high")

    return rows.mapInArrow(run, f"bucket bigint, {_PAIRS}")


def _dealt(blocks: Column) -> Column:
    return F.pmod(F.xxhash64("node", "bucket"), blocks).cast("int")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _batch(rows: list[tuple], *names: str) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(names))


def gathered(labelled: DataFrame, opened: DataFrame) -> DataFrame:
    """(bucket, node, label, top, members, outside): the rows of ``opened`` buckets, those of buckets
    that overlap much under the smallest bucket's number, each node once.

    Near copies and what is just too far from them meet in many buckets that differ by a few members,
    and each would give the same pairs again. Buckets with one largest label and sizes within a factor
    of two are put together where that makes fewer comparisons than all of them apart; ``outside``
    counts the members of other labels.
    """
    kind = ["top", "class"]
    opened = opened.withColumn("class", F.floor(F.log2("members")))
    rows = labelled.select("bucket", "node", "label").join(opened, "bucket")
    united = rows.select(*kind, "node", "label").distinct().groupBy(kind)
    united = united.agg(F.count("*").alias("nodes"), F.count_if(F.col("label") != F.col("top")).alias("others"))
    comparisons = lambda a, b: F.col(a).cast("double") * b
    apart = opened.groupBy(kind).agg(
        F.min("bucket").alias("one"), F.sum(comparisons("members", F.col("members") - F.col("largest"))).alias("apart")
    )
    fewer = apart.join(united, kind).where(comparisons("nodes", F.col("others")) < F.col("apart"))
    placed = opened.join(fewer, kind, "left").select(
        "bucket",
        "top",
        F.coalesce("one", "bucket").alias("into"),
        F.coalesce("nodes", "members").alias("members"),
        F.coalesce("others", F.col("members") - F.col("largest")).alias("outside"),
    )
    placed = stage(placed, "jaccard-gathered")
    rows = labelled.select("bucket", "node", "label").join(placed, "bucket")
    return rows.select(F.col("into").alias("bucket"), "node", "label", "top", "members", "outside").distinct()


def across(labelled: DataFrame, opened: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """(low, high): all possible pairs of different labels in the ``opened`` buckets.

    Members outside a bucket's largest label are compared with all of its members, block by block;
    members of that label are not compared with each other. So a group of m near copies and a few
    others costs about m rows for each block of the others. Buckets that overlap much are compared
    as one (:func:`gathered`); pairs that shared none of them are no links, and decided as such.
    """
    rows = gathered(labelled, opened)
    inner = F.ceil(F.col("members") / BLOCK).cast("int")
    outer = F.ceil(F.col("outside") / BLOCK).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), count - 1))
    inside = rows.withColumn("i", _dealt(inner)).withColumn("j", every(outer)).withColumn("side", F.lit(0))
    outside = rows.where("label <> top").withColumn("i", every(inner)).withColumn("j", _dealt(outer))
    columns = ["bucket", "i", "j", "side", "node", "label"]
    dealt = inside.select(columns).unionAll(outside.withColumn("side", F.lit(1)).select(columns))
    dealt = dealt.join(sketches, "node").select(*columns, "n", "sketch")
    group = ("bucket", "i", "j")
    spread = dealt.repartition(partitions(dealt.sparkSession), *group).sortWithinPartitions(*group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, members in groupby(_rows(batches), key=lambda r: r[:3]):
            _, _, _, side, nodes, labels, sizes, marks = zip(*members, strict=True)
            side, nodes, labels = np.array(side), np.array(nodes), np.array(labels)
            sizes, marks = np.array(sizes, np.int64), folded(marks)
            a, b = np.flatnonzero(side), np.flatnonzero(side == 0)
            found = possible(sizes[a], sizes[b], differing_bits(marks[a], marks[b]), percent)
            at, of = np.nonzero(found & (labels[a][:, None] != labels[b][None, :]))
            yield _batch([_pair(x, y) for x, y in zip(nodes[a[at]].tolist(), nodes[b[of]].tolist())], "low", "high")

    return spread.mapInArrow(run, _PAIRS).distinct()


def similar(a: list[bytes], b: list[bytes], words: int, percent: int) -> bool:
    """The link itself, on the words: each distinct word gets a number, then each distinct run."""
    if min(len(a), len(b)) < words:
        return bool(a) and a == b
    ids: dict[bytes, int] = {}
    number = np.fromiter((ids.setdefault(w, len(ids)) for part in (a, b) for w in part), np.int64, len(a) + len(b))
    runs, done = number, 1
    while done < words:
        step = min(done, words - done)
        runs = (runs[: len(runs) - step] << 32) | runs[step:]
        runs = np.unique(runs, return_inverse=True)[1]
        done += step
    # Runs that lie across the end of the first text belong to neither.
    first, second = np.unique(runs[: len(a) - words + 1]), np.unique(runs[len(a) :])
    shared = len(np.intersect1d(first, second, assume_unique=True))
    return 100 * shared >= percent * (len(first) + len(second) - shared)


def decided(pairs: DataFrame, packed: DataFrame, words: int, percent: int) -> DataFrame:
    """(low, high, linked) of each pair, from the whole texts of both."""
    low = packed.select(F.col("node").alias("low"), F.col("packed").alias("a"))
    high = packed.select(F.col("node").alias("high"), F.col("packed").alias("b"))
    both = pairs.join(low, "low").join(high, "high").select("low", "high", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompress = zstandard.ZstdDecompressor().decompress
        split = lambda text: decompress(text).translate(LOWER).split()
        for batch in batches:
            linked, last, b = [], None, []
            for row in zip(batch["high"].to_pylist(), batch["a"], batch["b"], strict=True):
                if row[0] != last:
                    last, b = row[0], split(row[2].as_py())
                linked.append(similar(split(row[1].as_py()), b, words, percent))
            yield pa.RecordBatch.from_pydict(
                {"low": batch["low"], "high": batch["high"], "linked": pa.array(linked, pa.bool_())}
            )

    return both.mapInArrow(run, f"{_PAIRS}, linked boolean")


def links(met: DataFrame, packed: DataFrame, words: int, percent: int, components) -> DataFrame:
    """(low, high): links that connect whatever the links inside the buckets connect.

    ``met`` holds (bucket, node, members, first), ``packed`` (node, n, sketch, packed). Forests of
    possible pairs are decided first. A bucket is looked at again only if it has several
    components left and either was cut into blocks or lost a pair of its forest; then all its
    possible pairs across components are decided.
    """
    sketches = packed.select("node", "n", "sketch")
    asked = stage(proposed(met, sketches, percent), "jaccard-proposed")
    answers = stage(decided(asked.select("low", "high").distinct(), packed, words, percent), "jaccard-answers")
    linked = answers.where("linked").select("low", "high")
    labels = components(linked)
    labelled = met.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    labelled = stage(labelled.select("bucket", "node", "label"), "jaccard-labelled")
    by_label = labelled.groupBy("bucket", "label").agg(F.count("*").alias("rows"))
    several = by_label.groupBy("bucket").agg(
        F.max(F.struct("rows", "label")).alias("most"), F.sum("rows").alias("members"), F.count("*").alias("labels")
    )
    several = several.where("labels > 1")
    lost = answers.where("not linked").select("low", "high")
    for side in ("low", "high"):
        of = labels.select(F.col("node").alias(side), F.col("label").alias(f"{side}_label"))
        lost = lost.join(of, side, "left").withColumn(f"{side}_label", F.coalesce(f"{side}_label", side))
    lost = lost.where("low_label <> high_label").select("low", "high")
    cut = several.where(F.col("members") > BLOCK).select("bucket")
    again = cut.unionAll(asked.join(lost, ["low", "high"]).select("bucket")).distinct()
    opened = several.join(again, "bucket").select(
        "bucket", "members", F.col("most.rows").alias("largest"), F.col("most.label").alias("top")
    )
    opened = stage(opened, "jaccard-opened")
    further = across(labelled, opened, sketches, percent).join(answers, ["low", "high"], "left_anti")
    further = stage(decided(further, packed, words, percent), "jaccard-further")
    return linked.unionAll(further.where("linked").select("low", "high"))
