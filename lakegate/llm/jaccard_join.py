"""Exact Jaccard join on word shingles by universe partition and pigeonhole."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache
from itertools import count, takewhile

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import content, give_back, pick, ship, stage
from lakegate.llm.encoder import slices
from lakegate.llm.set_links import links, sketch
from lakegate.llm.wordhash import LOWER, mix, rolling, word_hashes

#: A size band ends where sets are this many thresholds larger than where it begins; which of
#: these a join takes is settled by the cost of its index.
BAND_STEPS = (1, 2, 3, 6)
#: Text hashed at a time: hashing takes some fifty times as much memory.
SLICE_BYTES = 1024 * 1024
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_SHINGLE = 0x9FB21C651E98DF25
_KEY = 0xA24BAED4963EE407


@dataclass(frozen=True)
class Join:
    """Sets are linked when ``100 * intersection >= percent * union``."""

    words: int = 5
    percent: int = 80
    steps: int = 1

    def differing(self, size: int) -> int:
        """Most tokens in which a set of this size and one not smaller may differ, if linked."""
        # |a| = size, |b| <= 100 size / percent, and the difference is largest for the largest b.
        largest = 100 * size // self.percent
        return (size + largest) * (100 - self.percent) // (100 + self.percent)

    def band(self, size: int) -> int:
        """Band 0 holds the sets for which only equality will do."""
        if not self.differing(size):
            return 0
        step = self.steps * math.log(100 / self.percent)
        k = int(math.log(size / _first_size(self)) / step) + 1
        # The bounds are integers; correct what rounding of the logarithm may have done.
        while size < self.begin(k):
            k -= 1
        while size >= self.begin(k + 1):
            k += 1
        return k

    def begin(self, band: int) -> int:
        return _begin(self, band)


@lru_cache(maxsize=64)
def _first_size(join: Join) -> int:
    return next(size for size in count(1) if join.differing(size))


@lru_cache(maxsize=65_536)
def _begin(join: Join, band: int) -> int:
    """In integers, as a set and its smallest partner must never be two bands apart."""
    if band <= 0:
        return 1
    power = join.steps * (band - 1)
    return -(-_first_size(join) * 100**power // join.percent**power)


@dataclass(frozen=True)
class Scheme:
    """How a band is indexed: tokens fall into ``segments``; the first ``doubled`` of them stand
    for two units each, by their subset and its one-deletion neighbours, the others for one.

    ``spare`` units are used beyond what pigeonhole needs, so partners agree in more than that
    many. A set with no more units than that in empty keys does without them: it meets each of its
    partners by tokens as well."""

    segments: int
    doubled: int
    spare: int = 0

    def used(self, units: int) -> int:
        """Segments a set uses that needs so many units."""
        units += self.spare
        return units // 2 + units % 2 if units <= 2 * self.doubled else units - self.doubled

    def rows(self, used: int, size: float) -> float:
        """Index rows of a set of this size that uses so many segments."""
        return used + min(self.doubled, used) * size / self.segments

    def empties(self, used: int, size: float) -> float:
        """Empty keys that a set of this size is expected to index, by segment."""
        tokens = size / self.segments
        none, few = math.exp(-tokens), (1 + tokens) * math.exp(-tokens)
        doubled = min(self.doubled, used)
        units = (used - doubled) * none + 2 * doubled * few
        deviation = math.sqrt((used - doubled) * none + 4 * doubled * few) or 1.0
        needed = math.erfc((self.spare + 0.5 - units) / deviation / math.sqrt(2)) / 2
        return needed * ((used - doubled) * none + doubled * few) / self.segments


def allocate(differing: int, users: list[tuple[int, int, float]]) -> tuple[float, Scheme]:
    """The cost of the cheapest scheme of a band, and that scheme.

    ``users`` holds documents, units needed and mean size, by size. With u units wanted, d doubled
    segments leave u - d segments. A plain segment costs one row per set, a doubled one a row more
    for each of its tokens. Fewer segments are larger ones: unrelated sets meet in a segment only
    by an empty key, and each pair of them is taken to cost a row.
    """

    def cost(scheme: Scheme) -> float:
        rows = meeting = 0.0
        for documents, units, size in users:
            used = min(scheme.segments, scheme.used(units))
            rows += documents * scheme.rows(used, size)
            meeting += documents * scheme.empties(used, size)
        return rows + scheme.segments * meeting * meeting / 2

    schemes = []
    for spare in _steps(differing + 1):
        units = differing + 1 + spare
        schemes += [Scheme(units - doubled, doubled, spare) for doubled in _steps(units // 2)]
    return min(((cost(s), s) for s in schemes), key=lambda c: c[0])


def _steps(most: int) -> list[int]:
    """0 to ``most`` in steps that grow by an eighth."""
    out, n = [0], 1
    while n < most:
        out.append(n)
        n += max(1, n // 8)
    return [*out, most] if most else out


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer than n words are one shingle, none give none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    runs = mix(rolling(words, n, _SHINGLE), 2) if len(words) >= n else mix(rolling(words, len(words), _SHINGLE), 3)
    return np.unique(runs)


def signature(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    a, b = int(mix(tokens, 4).sum()), int(mix(tokens, 5).sum())
    size = np.array([a, b, len(tokens)], np.uint64)
    return _signed(mix(size[:1] + size[2:], 6)[0]), _signed(mix(size[1:2] + size[2:], 7)[0])


def _signed(x: np.uint64) -> int:
    return int(np.asarray(x, np.uint64).astype(np.int64))


def keys(tokens: np.ndarray, join: Join, schemes: dict[int, Scheme]) -> np.ndarray:
    """Index keys of a set: for its own band, and for the next lower one if partners may be there.

    A set uses the first segments of a band until the units exceed the tokens in which it may
    differ from a partner that is not larger; the smaller of two partners uses the fewest, and
    those the other has as well. So at most ``differing`` tokens are spread over more units than
    that, and some segment is equal, or a doubled one differs by one token at most. With spare
    units, more units than those agree. Where a set's empty keys stand for no more than the spare
    ones, some key of tokens is among the agreeing ones, whatever the partner is.
    """
    size = len(tokens)
    band = join.band(size)
    if not size or not band:
        return np.zeros(0, np.uint64)
    out = []
    bands = [band]
    if join.band(-(-size * join.percent // 100)) < band:
        bands.append(band - 1)
    for b in bands:
        scheme = schemes.get(b)
        if scheme is None:
            continue
        # Larger sets of the next band use the whole lower band's index.
        used = scheme.segments if b < band else scheme.used(join.differing(size) + 1)
        segment = (mix(tokens, 8) % np.uint64(scheme.segments)).astype(np.int64)
        # A subset's hash is the sum of its tokens' hashes: a deletion is one subtraction.
        values = mix(tokens, 9)
        sums = np.zeros(scheme.segments, np.uint64)
        np.add.at(sums, segment, values)
        salt = np.arange(scheme.segments, dtype=np.uint64) + np.uint64(b << 32)
        tokens_in = np.bincount(segment, minlength=scheme.segments)
        doubled = min(scheme.doubled, used)
        # Keys of the empty subset: of empty segments, and of doubled ones with a single token.
        empty = np.count_nonzero(tokens_in[doubled:used] == 0) + 2 * np.count_nonzero(tokens_in[:doubled] <= 1)
        least = 0 if empty > scheme.spare else 1
        at = np.flatnonzero(tokens_in[:used] >= least)
        out.append(mix(sums[at] + salt[at] * np.uint64(_KEY), 10))
        deleted = (segment < doubled) & (tokens_in[segment] > least)
        if deleted.any():
            left = sums[segment[deleted]] - values[deleted]
            out.append(mix(left + salt[segment[deleted]] * np.uint64(_KEY), 10))
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)


def sets(docs: DataFrame, join: Join) -> DataFrame:
    """doc_id, text_key, n, s1, s2 of each document (rows: doc_id, text)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(len(t), *(signature(t) if len(t) else (0, 0))) for t in _tokens(batch["text"].to_pylist(), join)]
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_key"], *(pa.array(list(c), pa.int64()) for c in columns)],
                names=["doc_id", "text_key", "n", "s1", "s2"],
            )
        give_back()

    return docs.mapInArrow(run, f"doc_id {id_type}, text_key bigint, n bigint, s1 bigint, s2 bigint")


def _tokens(texts: list[bytes], join: Join) -> Iterator[np.ndarray]:
    for _, part in slices(texts, SLICE_BYTES):
        if len(part[0]) > SLICE_BYTES:
            hashes = [np.concatenate([word_hashes([p.translate(LOWER)])[0] for p in _pieces(part[0])])]
        else:
            hashes = word_hashes([t.translate(LOWER) for t in part])
        for words in hashes:
            yield shingles(words, join.words)


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long text cut before white space; only a single word may be longer than a slice."""
    begin = 0
    while begin < len(text):
        blank = _BLANK.search(text, begin + SLICE_BYTES)
        end = blank.start() if blank else len(text)
        yield text[begin:end]
        begin = end


def postings(packed: DataFrame, join: Join, schemes: dict[int, Scheme]) -> DataFrame:
    """(key, node): index keys of each distinct set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompress = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for begin, part in slices(batch["packed"].to_pylist()):
                found = [keys(t, join, schemes) for t in _tokens([decompress(p) for p in part], join)]
                nodes = batch["node"].to_numpy()[begin : begin + len(part)]
                every = np.concatenate(found).view(np.int64)
                yield pa.RecordBatch.from_pydict(
                    {"key": pa.array(every), "node": pa.array(np.repeat(nodes, [len(k) for k in found]))}
                )
        give_back()

    return packed.select("node", "packed").mapInArrow(run, "key bigint, node bigint")


def buckets(posted: DataFrame) -> DataFrame:
    """(bucket, node, members, first): buckets of two sets or more, one of each set of members.

    ``first`` is the smallest member.

    Near copies meet in many buckets with the same members; one of them is enough. Which buckets
    those are is settled by aggregates (number, sums of hashes), so no list of members is built.
    """
    posted = posted.repartition("key")  # one shuffle, which both uses below read
    several = posted.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    members = stage(posted.join(several.select("key"), "key"), "jaccard-members")
    mark = F.xxhash64("node")
    wide = lambda c: F.sum(c.cast("decimal(28,0)"))
    shape = members.groupBy("key").agg(
        F.count("*").alias("members"),
        F.min("node").alias("first"),
        wide(mark).alias("a"),
        wide(F.xxhash64(mark)).alias("b"),
    )
    chosen = shape.groupBy("members", "first", "a", "b").agg(F.min("key").alias("key"))
    chosen = chosen.select("key", "members", "first")
    return members.join(chosen, "key").select(F.col("key").alias("bucket"), "node", "members", "first")


def components(links: DataFrame) -> DataFrame:
    """(node, label) for the nodes of ``links`` (low, high): one label per component.

    Smallest labels spread along the links and are then followed from label to label, so the
    number of rounds is about the logarithm of a component's diameter. Every round is a written table.
    """
    pairs = links.select(F.col("low").alias("node"), F.col("high").alias("other"))
    both = stage(pairs.unionAll(pairs.select(F.col("other"), F.col("node"))).distinct(), "component-links")
    labels = stage(
        both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("label")), "component-labels"
    )
    while True:
        seen = both.join(labels.select(F.col("node").alias("other"), F.col("label").alias("near")), "other")
        lower = seen.groupBy("node").agg(F.min("near").alias("near"))
        spread = stage(
            labels.join(lower, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("old")),
            "component-spread",
        )
        further = spread.select(F.col("node").alias("label"), F.col("label").alias("next"))
        moved = stage(
            spread.join(further, "label").select("node", F.least("label", "next").alias("label"), "old"),
            "component-labels",
        )
        labels = moved.select("node", "label")
        if not moved.where("label <> old").take(1):
            return labels


def near_components(
    docs: DataFrame,
    join: Join = Join(),
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, group_key, one row per input row.

    1. Each document becomes the set of its shingles, named by 128 bits. Equal sets are one
       numbered node, and one document stands for it.
    2. Sets are indexed by segments (:func:`keys`), in bands of similar size; how wide a
       band is (:func:`banded`) and how it is indexed (:func:`allocate`) follow from the number of
       documents by size.
    3. Sets that share a key meet in a bucket. Pairs of a bucket that their sizes and parity
       sketches leave open are decided on the words of both texts, and links become components
       (:func:`~lakegate.llm.set_links.links`).

    ``component_id`` is the smallest id reachable. A text without words has no shingle and is
    linked with nothing: its component is its own id and its ``group_key`` is NULL. Other rows share
    a ``group_key`` exactly if they are of one component. NULL text has no words. Rows repeated with
    the same text are one node; rows of one id with different texts are nodes of their own. NULL
    ids never become a component's id unless there is no other. Extra columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = pick(docs, doc_id=id_col, text=text_col).select("doc_id", content().alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    known = stage(sets(rows, join), "jaccard-sets")
    join, schemes = banded(known, join)
    nodes = known.where("n > 0").groupBy("s1", "s2").agg(F.min(F.struct("doc_id", "text_key")).alias("row"), F.min("doc_id").alias("least_id"))
    nodes = nodes.select(F.monotonically_increasing_id().alias("node"), "s1", "s2", "row.*", "least_id")
    nodes = stage(nodes, "jaccard-nodes")
    wanted = nodes.select(F.col("doc_id").alias("id"), F.col("text_key").alias("of"), "node")
    same = rows["doc_id"].eqNullSafe(wanted["id"]) & (rows["text_key"] == wanted["of"])
    # A row that is repeated stands for its set once.
    packed = _pack(rows.join(wanted, same).select("node", "text"), join).dropDuplicates(["node"])
    packed = stage(packed, "jaccard-texts")
    met = stage(buckets(postings(packed, join, schemes)), "jaccard-buckets")
    linked = links(met, packed, join.words, join.percent, components)
    labels = components(stage(linked, "jaccard-links"))
    least = nodes.select("node", "least_id").join(labels, "node")
    named = least.groupBy("label").agg(F.min("least_id").alias("component"))
    of_node = nodes.select("node", "s1", "s2", "least_id").join(labels, "node", "left").join(named, "label", "left")
    of_node = stage(of_node, "jaccard-components")
    return known.join(of_node, ["s1", "s2"], "left").select(
        "doc_id",
        "text_key",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "least_id", "doc_id").alias("component_id"),
        F.coalesce("label", "node").alias("group_key"),
    )


def drop_near_copies(
    docs: DataFrame, join: Join = Join(), *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one document left of each component, all columns kept: the smallest id's.

    NULL ids come after all others. Texts without words stay. Rows that repeat both id and text
    are one document and stay or go together.
    """
    found = stage(near_components(docs, join, id_col=id_col, text_col=text_col), "jaccard-found")
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id"), F.col("text_key"))
    first = found.where("group_key is not null").groupBy("group_key").agg(F.min(order).alias("row"))
    alone = found.where("group_key is null").select("doc_id", "text_key").distinct()
    kept = first.select("row.doc_id", "row.text_key").unionByName(alone)
    kept = kept.select(F.col("doc_id").alias("__kept_id"), F.col("text_key").alias("__kept_text"))
    key = F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b"")))
    same = F.col(f"`{id_col}`").eqNullSafe(F.col("__kept_id")) & (key == F.col("__kept_text"))
    return docs.join(kept, same, "left_semi")


def _pack(texts: DataFrame, join: Join) -> DataFrame:
    """(node, n, sketch, packed) of each text that stands for a node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            every = batch["text"].to_pylist()
            rows = [(len(t), sketch(t)) for t in _tokens(every, join)]
            sizes, sketches = zip(*rows, strict=True) if rows else ((), ())
            yield pa.RecordBatch.from_pydict(
                {
                    "node": batch["node"],
                    "n": pa.array(sizes, pa.int64()),
                    "sketch": pa.array(sketches, pa.binary()),
                    "packed": pa.array([compress(t) for t in every], pa.binary()),
                }
            )
        give_back()

    return texts.mapInArrow(run, "node bigint, n bigint, sketch binary, packed binary")


def banded(known: DataFrame, join: Join) -> tuple[Join, dict[int, Scheme]]:
    """The join with the band width whose index is cheapest, and the scheme of each band.

    Narrow bands suit each set's size better, but more sets are indexed in two of them. Both are
    reckoned from the number of documents and their mean size by bands of one step (a row each).
    """
    narrow = replace(join, steps=1)
    # At 100 percent only equality will do: every set is in band 0.
    starts = map(narrow.begin, count(1)) if join.percent < 100 else ()
    bounds = F.array(*(F.lit(b) for b in takewhile(lambda b: b < 2**31, starts))).cast("array<bigint>")
    band = F.size(F.filter(bounds, lambda b: b <= F.col("n")))
    counts = known.where("n > 0").groupBy(band.alias("band")).agg(F.count("*").alias("documents"), F.avg("n").alias("mean"))
    found = {r["band"]: (r["documents"], r["mean"]) for r in counts.collect() if r["band"]}
    choices = []
    for steps in BAND_STEPS:
        cost, schemes = _schemes(found, replace(join, steps=steps))
        choices.append((cost, steps, schemes))
    _, steps, schemes = min(choices, key=lambda c: c[:2])
    return replace(join, steps=steps), schemes


def _schemes(found: dict[int, tuple[int, float]], join: Join) -> tuple[float, dict[int, Scheme]]:
    """The cost of the index, and the scheme of each band, from documents and mean size by bands
    of one step. The sets of a band's first step use the whole of the band below too."""
    users: dict[int, list[tuple[int, int, float]]] = {}
    for narrow, (documents, mean) in sorted(found.items()):
        k = (narrow - 1) // join.steps + 1
        users.setdefault(k, []).append((documents, join.differing(int(mean)) + 1, mean))
        if k > 1 and (narrow - 1) % join.steps == 0:
            below = join.differing(join.begin(k) - 1) + 1
            users.setdefault(k - 1, []).append((documents, below, mean))
    total, out = 0.0, {}
    for k, uses in users.items():
        cost, out[k] = allocate(join.differing(join.begin(k + 1) - 1), uses)
        total += cost
    return total, out
