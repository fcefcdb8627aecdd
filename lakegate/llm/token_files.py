"""Token ids in compressed binary shards with a shared dictionary and an offset index."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import groupby
from uuid import uuid4

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakegate.llm import files
from lakegate.llm.common import content, partitions, pick, ship
from lakegate.llm.encoder import encoder, slices
from lakegate.sources.staging import shared_folder

#: The dictionary is trained on slices of about this many documents.
SAMPLE_DOCUMENTS = 1000
SAMPLE_SLICES = 4
SLICE_IDS = 1024
DICTIONARY_BYTES = 32 * 1024
LEVEL = 3
END = 0

INDEX = "part int, position int, path string, doc_id {id}, offset bigint, length int, n_tokens bigint, dictionary_sha256 string"


def sample_ids(docs: DataFrame, tokenizer_path: str, documents: int = SAMPLE_DOCUMENTS) -> list[bytes]:
    """Serialized id slices for the dictionary, from a bounded sample spread over all documents.

    About ``documents`` rows are taken by a hash of their id and text; of each, at most
    SAMPLE_SLICES slices of SLICE_IDS ids spread over the whole document.
    """
    count = docs.count()
    modulus = max(1, count // documents)
    chosen = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(modulus)) == 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer_path)
        for batch in batches:
            out = []
            for _, part in slices(batch["text"].to_pylist()):
                for ids in tool.encode(part):
                    size = SLICE_IDS * tool.dtype.itemsize
                    starts = range(0, len(ids), size)
                    stride = max(1, -(-len(starts) // SAMPLE_SLICES))
                    out += [ids[s : s + size] for s in starts[::stride]]
            yield pa.RecordBatch.from_pydict({"ids": pa.array(out, pa.binary())})

    rows = chosen.select("text").mapInArrow(run, "ids binary").limit(2 * documents * SAMPLE_SLICES)
    return sorted(bytes(r["ids"]) for r in rows.collect())


def train_dictionary(samples: list[bytes]) -> bytes:
    """A shared dictionary; empty where there is too little to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = END,
    sample_documents: int = SAMPLE_DOCUMENTS,
) -> None:
    """Encode ``docs`` and write ``folder``: dictionary, shards, index.

    Shards hold documents in ascending id order, each compressed on its own with the shared
    dictionary; ids are unsigned little-endian, 2 bytes if the vocabulary allows it, else 4.
    ``index`` (Parquet) gives per document its shard, offset, length, number of tokens and the
    dictionary's SHA-256: one short document is read by one seek. The text is range-partitioned by
    id first and encoded where it lands, so each text is moved once and encoded once.

    NULL text is the empty text, a document of ``end_id`` alone. Equal ids lie next to each other,
    in order of a hash of their text; NULL ids come first. Extra columns are not written.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = pick(docs, doc_id=id_col, text=text_col).select("doc_id", content().alias("text"))
    folder = folder.rstrip("/")
    files.make_folder(f"{folder}/shards")
    dictionary = train_dictionary(sample_ids(rows, tokenizer_path, sample_documents))
    digest = hashlib.sha256(dictionary).hexdigest()
    files.write_whole(f"{folder}/{digest}.dictionary", dictionary)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    # A sort key of three values spreads equal ids over several ranges.
    ordered = (
        rows.withColumn("__text", F.xxhash64("text"))
        .repartitionByRange(partitions(spark), "doc_id", "__text")
        .sortWithinPartitions("doc_id", "__text")
        .select("doc_id", "text")
    )
    write = _writer(f"{folder}/shards", tokenizer_path, dictionary, digest, end_id)
    ordered.mapInArrow(write, INDEX.format(id=id_type)).write.mode("overwrite").parquet(f"{folder}/index")


def _writer(shards: str, tokenizer_path: str, dictionary: bytes, digest: str, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer_path)
        end = b"" if end_id is None else np.array([end_id], tool.dtype).tobytes()
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared).compress
        part = TaskContext.get().partitionId()
        path = f"{shards}/{part:06d}-{uuid4().hex}.ids"
        system, place = files.filesystem(path)
        offset = position = 0
        out = None
        try:
            for batch in batches:
                out = out or system.open_output_stream(place, compression=None)
                for begin, texts in slices(batch["text"].to_pylist()):
                    lengths, counts, offsets = [], [], []
                    for ids in tool.encode(texts):
                        frame = compress(ids + end)
                        out.write(frame)
                        offsets.append(offset)
                        lengths.append(len(frame))
                        counts.append((len(ids) + len(end)) // tool.dtype.itemsize)
                        offset += len(frame)
                    n = len(texts)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "part": pa.array([part] * n, pa.int32()),
                            "position": pa.array(range(position, position + n), pa.int32()),
                            "path": pa.array([path] * n, pa.string()),
                            "doc_id": batch["doc_id"].slice(begin, n),
                            "offset": pa.array(offsets, pa.int64()),
                            "length": pa.array(lengths, pa.int32()),
                            "n_tokens": pa.array(counts, pa.int64()),
                            "dictionary_sha256": pa.array([digest] * n, pa.string()),
                        }
                    )
                    position += n
        finally:
            if out is not None:
                out.close()

    return run


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The index with ``start``: ids of all documents before each."""
    index = spark.read.parquet(f"{folder.rstrip('/')}/index")
    # One row per shard; the running sum over shards needs no document.
    parts = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    return (
        index.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(base, "part")
        .withColumn("start", F.col("base") + F.col("inside"))
        .drop("base", "inside")
    )


def read_token_files(index: DataFrame, folder: str, tokenizer_path: str, *, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, if asked for, ids, of the indexed documents.

    ``index`` may be any selection of :func:`read_index`. Each shard is read by one task, in
    order, by coalesced ranges. The CRC is taken over all ids as unsigned 32-bit integers.
    """
    spark = index.sparkSession
    ship(spark)
    folder = folder.rstrip("/")
    id_type = index.schema["doc_id"].dataType.simpleString()
    wanted = index.select("path", "offset", "length", "dictionary_sha256", "doc_id", "start")
    sorted_reads = wanted.repartition(partitions(spark), "path").sortWithinPartitions("path", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = encoder(tokenizer_path).dtype
        tools: dict[str, zstandard.ZstdDecompressor] = {}
        for batch in batches:
            counts, sums, kept = [], [], []
            rows = zip(*(batch[c].to_pylist() for c in ("path", "offset", "length", "dictionary_sha256")), strict=True)
            for (path, digest), group in groupby(rows, key=lambda r: (r[0], r[3])):
                if digest not in tools:
                    data = files.read_whole(f"{folder}/{digest}.dictionary")
                    if hashlib.sha256(data).hexdigest() != digest:
                        raise ValueError(f"dictionary {digest} is damaged")
                    shared = zstandard.ZstdCompressionDict(data) if data else None
                    tools[digest] = zstandard.ZstdDecompressor(dict_data=shared)
                for frame in files.read_ranges(path, [(r[1], r[2]) for r in group]):
                    ids = np.frombuffer(tools[digest].decompress(frame), dtype).astype("<u4")
                    counts.append(len(ids))
                    sums.append(zlib.crc32(ids.tobytes()))
                    if with_ids:
                        kept.append(ids)
            columns = {
                "doc_id": batch["doc_id"],
                "start": batch["start"],
                "n_tokens": pa.array(counts, pa.int64()),
                "ids_crc32": pa.array(sums, pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array([x.astype(np.int32) for x in kept], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    schema = f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint"
    return sorted_reads.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


def new_folder(spark: SparkSession, label: str) -> str:
    """A new folder for files in the cluster's shared folder."""
    return f"{shared_folder(spark)}/lakegate-files/{label}-{uuid4().hex}"
