"""A distinct-word table over blocks of documents.

A block is some megabytes of texts.  Its words are numbered by falling frequency
within the block, and a document becomes the sequence of those numbers: this is the
position side.  The word side has one row per block and bucket of words, so what is
shuffled to look words up is each block's distinct words, never its occurrences.

Words go to a bucket by hash; all rows of a bucket meet in one task (in `salts`
tasks once there are more tasks than buckets), which looks each distinct word up
once.  A frequent word stands in a block's row once, so it is no hot key.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import ROW, lean, pack, pack_words, shared_folder, text_batches, unpack

BLOCK_BYTES = 12 << 20
BUCKETS = 128

_BLOCK = (
    "block bigint, bucket int, words binary, weights binary, at binary, "
    "ids array<bigint>, doc_ids array<bigint>, counts binary, numbers binary"
)
_KINDS = [pa.int64(), pa.int32(), *[pa.binary()] * 3, *[pa.list_(pa.int64())] * 2, *[pa.binary()] * 2]


class WordBlocks(NamedTuple):
    documents: DataFrame  # block, ids (row ids), doc_ids, counts (words per document), numbers
    words: DataFrame  # block, bucket, words, weights, at (their numbers)


def _numbered(texts: Iterable[str | None], weights, split) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """(distinct words by falling frequency, weight of each, words per text, numbers of all words)."""
    seen: dict[bytes, int] = {}
    parts, counts = [], []
    for text in texts:
        words = split(text)
        parts.append(np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.uint32, len(words)))
        counts.append(len(words))
    counts = np.array(counts, np.uint32)
    numbers = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    order = np.argsort(-np.bincount(numbers, minlength=len(seen)), kind="stable")
    rank = np.empty(len(seen), np.uint32)
    rank[order] = np.arange(len(seen))
    numbers = rank[numbers]
    weight = np.bincount(
        numbers, weights=np.repeat(weights, counts) if weights is not None else None, minlength=len(seen)
    ).astype(np.uint32)
    words = list(seen)
    return [words[i] for i in order.tolist()], weight, counts, numbers


def word_blocks(
    docs: DataFrame,
    split: Callable[[str | None], list[bytes]],
    block_bytes: int = BLOCK_BYTES,
) -> WordBlocks:
    """Blocks of `docs` (row id, text, document id, optional weight), stored.

    `weights` of a word add up the weights of the documents it occurs in, once per
    occurrence; without a weight column they are NULL.  Document ids are integers.
    """
    weighted = len(docs.columns) > 3
    spark = docs.sparkSession

    def run(batches):
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(text_batches(batches, 1, block_bytes)):
            block = (part << 32) | number
            weights = batch.column(3).to_numpy(zero_copy_only=False) if weighted else None
            words, weight, counts, numbers = _numbered(batch.column(1).to_pylist(), weights, split)
            bucket = np.fromiter((xxhash.xxh32_intdigest(w) % BUCKETS for w in words), np.int64, len(words))
            order = np.argsort(bucket, kind="stable")
            found, first = np.unique(bucket[order], return_index=True)
            rows = [
                (
                    block, int(b), pack_words([words[i] for i in own.tolist()]),
                    pack(weight[own]) if weighted else None, pack(np.diff(own, prepend=0)), *[None] * 4,
                )
                for b, own in zip(found, np.split(order, first[1:]))
            ] if words else []
            ids = [batch.column(k).to_pylist() for k in (0, 2)]
            rows.append((block, *[None] * 4, *ids, pack(counts), pack(numbers)))
            names = [c.split()[0] for c in _BLOCK.split(", ")]
            for at in range(0, len(rows), 256):
                columns = zip(*rows[at : at + 256])
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, _KINDS)], names=names)

    # Laid out by block, so that the position side is read where its values are sent and
    # is not shuffled.  Only the files matter: the table's name goes once they are resolved.
    name = f"word_blocks_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = docs.mapInArrow(lean(run), _BLOCK).write.option("compression", "zstd")
    writer.bucketBy(parts, "block").option("path", shared_folder(spark)).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return WordBlocks(
        table.where("bucket IS NULL").select("block", "ids", "doc_ids", "counts", "numbers"),
        table.where("bucket IS NOT NULL").select("block", "bucket", "words", "weights", "at"),
    )


def by_word(words: DataFrame) -> DataFrame:
    """The word side with all rows of a bucket, up to salts, in one task."""
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = math.ceil(4 * tasks / BUCKETS)
    return words.repartition(tasks, "bucket", F.pmod("block", F.lit(salts)))


def join_by_block(blocks: WordBlocks, values: DataFrame, assemble, schema: str) -> DataFrame:
    """Bring looked-up `values` (block, ...) back to their block's documents.

    `assemble(counts, numbers, values)` gets one block: words per document, word numbers,
    and an Arrow table of values.  It yields record batches with a row per document, in
    order; row and document ids come first in `schema` and are added here.
    """

    def run(key, left: pa.Table, right: pa.Table):
        row = left.select(["ids", "doc_ids"]).combine_chunks()
        ids = [row.column(k)[0].values for k in range(2)]
        counts, numbers = (unpack(left.column(k)[0].as_py()) for k in ("counts", "numbers"))
        at, out = 0, []
        for batch in assemble(counts, numbers, right):
            own = [column.slice(at, batch.num_rows) for column in ids]
            out.append(pa.record_batch([*own, *batch.columns], names=[ROW, "doc_id", *batch.schema.names]))
            at += batch.num_rows
        return pa.Table.from_batches(out)

    return (
        blocks.documents.groupBy("block").cogroup(values.groupBy("block")).applyInArrow(run, schema)
    )


def spans(counts: np.ndarray, limit: int = 400_000):
    """(first, last, words before, words up to) of runs of documents with about `limit` words."""
    ends = np.cumsum(counts, dtype=np.int64)
    piece = np.maximum(ends - 1, 0) // limit
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(counts)]
    for first, last in zip(cuts, cuts[1:]):
        if last > first:
            yield first, last, int(ends[first - 1]) if first else 0, int(ends[last - 1])


def gathered(start: np.ndarray, length: np.ndarray, picks: np.ndarray) -> np.ndarray:
    """Positions of the runs [start, start + length) of all `picks`, one after the other."""
    sizes = length[picks]
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start[picks] - (ends - sizes), sizes)
