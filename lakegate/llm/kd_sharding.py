"""K-d tree sharding: weighted median cuts along the widest metadata dimension, in SQL only."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakegate.llm.common import literal_map, partitions, pick, stage

#: Bits of a cut coordinate that one aggregation resolves, and the steps of a whole coordinate.
DIGIT_BITS = 16
DIGITS = 8


@dataclass(frozen=True)
class Node:
    """A cell of the tree: its first shard, and how many shards it still has to give."""

    first: int
    shards: int


def metadata(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32 and the dimensions: log size, characters per byte.

    Both dimensions are functions of the text, so equal texts have one place in the tree.
    """
    rows = pick(docs, doc_id=id_col, text=text_col)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 1
    chars = F.coalesce(F.char_length("text"), F.lit(0)) + 1
    return rows.select(
        "doc_id",
        size.alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.log2(size).alias("log_size"),
        (chars / size).alias("density"),
    )


def kd_shards(
    rows: DataFrame,
    *,
    shards: int | None = None,
    target_bytes: int | None = None,
    dimensions: tuple[str, ...] = ("log_size", "density"),
    tolerance: float = 0.02,
) -> DataFrame:
    """``rows`` (doc_id, size, text_crc32, dimensions) with ``shard`` and ``slot``.

    Give the number of shards, or the bytes of a leaf. A cell is cut at the weighted median of
    its widest dimension (range inside the cell over range of the whole table), so that both
    parts hold bytes in proportion to the shards they get. The coordinate of a row is
    (dimension, CRC of the text, hash of the id): rows of equal texts stay adjacent, and a cut goes
    to an edge of such a group unless the group outweighs ``tolerance`` of a shard; then it goes
    through the group, by id.

    No row is moved to find a cut: its coordinate is resolved 16 bits at a time by aggregating
    bytes into at most 65,536 bins per cell. The driver holds a few numbers per cell. NULL
    dimensions count as 0, NULL ids as one id. An empty table gives an empty result.
    """
    rows = stage(rows.select("doc_id", "size", "text_crc32", *(F.coalesce(d, F.lit(0.0)).alias(d) for d in dimensions)), "kd-rows")
    whole = rows.agg(F.sum("size").alias("bytes"), *_ranges(dimensions)).collect()[0]
    total = whole["bytes"] or 0
    if shards is None:
        shards = max(1, -(-total // (target_bytes or total or 1)))
    spans = {d: (whole[f"{d}_max"] or 0.0) - (whole[f"{d}_min"] or 0.0) for d in dimensions}
    slack = tolerance * total / shards
    cells = {0: Node(0, shards)}
    rows = rows.withColumn("cell", F.lit(0))
    while any(c.shards > 1 for c in cells.values()):
        rows, cells = _cut_all(rows, cells, dimensions, spans, slack)
    shard_of = literal_map({cell: node.first for cell, node in cells.items()}, F.col("cell"), "int")
    return with_slots(rows.withColumn("shard", shard_of))


def _ranges(dimensions: tuple[str, ...]) -> list[Column]:
    return [f(d).alias(f"{d}_{n}") for d in dimensions for n, f in (("min", F.min), ("max", F.max))]


def _cut_all(
    rows: DataFrame,
    cells: Mapping[int, Node],
    dimensions: tuple[str, ...],
    spans: Mapping[str, float],
    slack: float,
) -> tuple[DataFrame, dict[int, Node]]:
    """Cut every cell that has more than one shard to give; cell c becomes 2c and 2c + 1."""
    stats = {
        r["cell"]: r
        for r in rows.groupBy("cell").agg(F.sum("size").alias("bytes"), *_ranges(dimensions)).collect()
    }  # one row per cell
    open_cells = {c: n for c, n in cells.items() if n.shards > 1 and c in stats}
    low, width, axis, goal = {}, {}, {}, {}
    for cell, node in open_cells.items():
        row = stats[cell]
        extent = {d: row[f"{d}_max"] - row[f"{d}_min"] for d in dimensions}
        widest = max(dimensions, key=lambda d: extent[d] / spans[d] if spans[d] else 0.0)
        axis[cell] = dimensions.index(widest)
        low[cell], width[cell] = row[f"{widest}_min"], extent[widest] or 1.0
        goal[cell] = row["bytes"] * (node.shards // 2) / node.shards
    # Literals of a few cells; with one Node per shard the mapping stays as small as the tree.
    cell = F.col("cell")
    value = F.element_at(F.array(*dimensions), literal_map(axis, cell, "int") + 1) if axis else F.lit(0.0)
    place = (value - literal_map(low, cell, "double")) / literal_map(width, cell, "double") if axis else F.lit(0.0)
    high = F.shiftleft(F.floor(place * F.lit(2.0**31 - 1)).cast("bigint"), 32) + F.col("text_crc32")
    coded = rows.withColumn("__high", high).withColumn(
        "__low", F.coalesce(F.xxhash64("doc_id"), F.lit(0).cast("bigint"))
    )

    def digit(k: int) -> Column:
        source = F.col("__high" if k < DIGITS // 2 else "__low")
        shift = 64 - DIGIT_BITS * (k % (DIGITS // 2) + 1)
        return F.shiftrightunsigned(source, shift).bitwiseAND(F.lit(2**DIGIT_BITS - 1))

    prefix = {c: [] for c in open_cells}  # digits of the cut found so far
    base = dict.fromkeys(open_cells, 0)  # bytes below that prefix
    take = {}  # whether rows at the cut itself go left
    pending = set(open_cells)
    for k in range(DIGITS):
        if not pending:
            break
        inside = F.lit(True)
        for j in range(k):
            inside = inside & (digit(j) == literal_map({c: prefix[c][j] for c in pending}, cell))
        bins = (
            coded.where(cell.isin(sorted(pending)) & inside)
            .groupBy("cell", digit(k).alias("bin"))
            .agg(F.sum("size").alias("bytes"))
        )
        running = F.sum("bytes").over(Window.partitionBy("cell").orderBy("bin"))
        wanted = literal_map({c: max(1, round(goal[c] - base[c])) for c in pending}, cell)
        crossing = (
            bins.withColumn("upto", running)
            .where((F.col("upto") >= wanted) & (F.col("upto") - F.col("bytes") < wanted))
            .collect()
        )  # one row per cell
        for row in crossing:
            c = row["cell"]
            prefix[c].append(row["bin"])
            base[c] += row["upto"] - row["bytes"]
            over, under = base[c] + row["bytes"] - goal[c], goal[c] - base[c]
            fine = row["bytes"] <= slack if k >= DIGITS // 2 - 1 else row["bytes"] <= slack / 64
            if fine or k == DIGITS - 1:
                take[c] = over <= under
                pending.discard(c)
    left = F.lit(False)
    for c, cut in prefix.items():
        # Lexicographic comparison with the digits of the cut.
        below = F.lit(take[c])
        for j in reversed(range(len(cut))):
            below = (digit(j) < cut[j]) | ((digit(j) == cut[j]) & below)
        left = left | ((cell == c) & below)
    parted = cell.isin(sorted(open_cells)) if open_cells else F.lit(False)
    after = F.when(parted & left, cell * 2 + 2**24).when(parted, cell * 2 + 1 + 2**24).otherwise(cell)
    # Renumber: cells stay small integers, whatever the depth.
    new: dict[int, Node] = {}
    number: dict[int, int] = {}
    for c, node in cells.items():
        if c not in open_cells:
            # A cell without rows has nothing to cut: its shards stay empty.
            number[c], new[len(new)] = len(new), Node(node.first, 1)
            continue
        half = node.shards // 2
        for side, child in enumerate((Node(node.first, half), Node(node.first + half, node.shards - half))):
            number[2 * c + side + 2**24], new[len(new)] = len(new), child
    moved = coded.withColumn("cell", literal_map(number, after, "int")).drop("__high", "__low")
    return stage(moved, "kd-cells"), new


def with_slots(rows: DataFrame) -> DataFrame:
    """Add ``slot``: 0, 1, 2, … inside each shard, by doc_id.

    Ranges of (shard, doc_id) are numbered on their own and then moved by the rows before them,
    so a shard is never numbered by one task.
    """
    spread = rows.repartitionByRange(partitions(rows.sparkSession), "shard", "doc_id", "text_crc32")
    parts = stage(spread.withColumn("part", F.spark_partition_id()), "kd-slots")
    counts = parts.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32"))
    return (
        parts.withColumn("inside", inside)
        .join(offsets, ["shard", "part"])
        .withColumn("slot", (F.col("offset") + F.col("inside") - 1).cast("bigint"))
        .drop("part", "inside", "offset", "cell")
    )
