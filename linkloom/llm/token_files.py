"""Token ids of documents in block files, in ascending order of document id."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.llm.rangecoder import decode_block, encode_block
from linkloom.llm.wordcache import cache_for, slices

BLOCKS = "part long, block long, part_start long, n_docs long, n_ids long, payload binary"
_BLOCK_ARROW = pa.schema([(n, pa.int64()) for n in ("part", "block", "part_start", "n_docs", "n_ids")]
                         + [("payload", pa.binary())])


def _coded(batches: Iterator[pa.RecordBatch], path: str, end_id: int, vocabulary: int, block_ids: int):
    from pyspark import TaskContext

    cache, part = cache_for(path), TaskContext.get().partitionId()
    docs: list[int] = []
    counts: list[int] = []
    held: list[np.ndarray] = []
    number = start = size = 0

    def closed() -> pa.RecordBatch:
        nonlocal number, start, size
        ids = np.concatenate(held)
        row = (part, number, start, len(docs), len(ids), encode_block(docs, counts, ids, vocabulary))
        number, start, size = number + 1, start + len(ids), 0
        docs.clear(), counts.clear(), held.clear()
        return pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(row, _BLOCK_ARROW)], schema=_BLOCK_ARROW)

    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lo, hi in slices(texts):
            flat, found = cache.encode(texts[lo:hi])
            ends = np.cumsum(found)
            with_end = np.insert(flat, ends, np.uint32(end_id))
            at = 0
            for doc, count in zip(ids[lo:hi], (found + 1).tolist()):
                docs.append(doc), counts.append(count), held.append(with_end[at : at + count])
                at, size = at + count, size + count
                if size >= block_ids:
                    yield closed()
    if docs:
        yield closed()


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, vocabulary: int,
              block_ids: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append ``end_id`` and write the blocks below ``path``.

    The rows are dealt by ranges of the id and sorted, so files and blocks ascend by id.  Each
    row of the written Parquet container is one self-contained block of whole documents with at
    least ``block_ids`` ids (but the last of a part); Spark's commit keeps the files of finished
    tasks only.  A null or empty text is its end id alone.  Rows without id come first; equal ids lie
    side by side, in any order among themselves; an empty table gives no blocks; other columns are ignored.
    """
    (
        docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
        .repartitionByRange("doc_id").sortWithinPartitions("doc_id")
        .mapInArrow(lambda it: _coded(it, tokenizer_path, end_id, vocabulary, block_ids), BLOCKS)
        .write.parquet(path)
    )


def _decoded(batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, start, payload in zip(*(batch.column(i).to_pylist() for i in range(3))):
            docs, counts, ids = decode_block(payload)
            ids = ids.astype("<u4")
            ends = np.cumsum(counts)
            raw = ids.tobytes()
            crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), counts.tolist())]
            columns = [pa.array(np.full(len(docs), part)), pa.array(docs, pa.int64()), pa.array(start + ends - counts),
                       pa.array(counts), pa.array(crc, pa.int64())]
            names = ["part", "doc_id", "part_start", "n_tokens", "ids_crc32"]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)),
                                                        pa.array(ids.astype(np.int64))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) per document, decoded from the blocks below ``path``.

    ``start`` counts the ids of all documents before it.  A block whose checksum fails ends the
    read with an error that names the fault.
    """
    blocks = spark.read.schema(BLOCKS).parquet(path)
    # one row per part, which bounds the broadcast by the number of partitions
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    schema = "part long, doc_id long, part_start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    found = blocks.select("part", "part_start", "payload").mapInArrow(lambda it: _decoded(it, with_ids), schema)
    return found.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("_offset") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
