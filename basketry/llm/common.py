"""What the operators share: stored intermediate tables, row ids, byte packing.

Row ids are a file's number among the frame's files, by path, and the row's place in
that file: the same in every scan, however Spark splits the files.  A frame that does
not read Parquet files row by row is written first, and its rows are numbered as written.
"""

from __future__ import annotations

import ctypes
import os
import re
import shutil
import tempfile
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

ROW = "_row_id"

# ASCII words: lower-case A-Z; bytes outside a-z, 0-9 and non-ASCII separate.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, unless they have it on their Python path."""
    package = Path(__file__).resolve().parents[1]
    application = spark.sparkContext.applicationId
    if str(package.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or application in _shipped:
        return
    archive = shutil.make_archive(
        f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name
    )
    spark.sparkContext.addPyFile(archive)  # the driver serves it to every executor
    _shipped.add(application)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder path below `spark.checkpoint.dir`, which all executors share.

    Where that is unset (a local session), the warehouse folder takes its place.
    """
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        top = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{top.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(frame: DataFrame, partition_by: str | None = None) -> DataFrame:
    """The frame written as Parquet to the shared folder and read back.

    Cuts the lineage and pins what would otherwise be computed again: executors
    may be lost afterwards.
    """
    spark = frame.sparkSession
    path = shared_folder(spark)
    writer = frame.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


_SLASHES = "(?<=:)/+"
_ROW_BY_ROW = {"LogicalRelation", "Project", "Filter", "SubqueryAlias", "View"}


def pinned(frame: DataFrame) -> DataFrame:
    """The frame itself if its rows have a place in a Parquet file, else as stored."""
    try:
        frame.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return stored(frame)
    # A join or an exploded array has such columns too, but may repeat a row.
    plans = [frame._jdf.queryExecution().analyzed()]
    for plan in plans:
        below = plan.children()
        plans += [below.apply(k) for k in range(below.size())]
    return frame if {p.nodeName() for p in plans} <= _ROW_BY_ROW else stored(frame)


def with_row_id(frame: DataFrame, name: str = ROW) -> DataFrame:
    """The frame with row ids; to number the same rows again, give what `pinned` gave."""
    ship(frame.sparkSession)
    frame = pinned(frame)
    # Slashes after a scheme are counted differently by the two.
    files = sorted(re.sub(_SLASHES, "/", f) for f in frame.inputFiles())
    place = F.col("_metadata.row_index")
    if len(files) < 2:
        return frame.withColumn(name, place)
    # Ids are file << 32 | row; the list of paths is as small as the scan's own.
    path = name + "file"
    while path in frame.columns:
        path += "_"
    unknown = F.raise_error(F.concat(F.lit("a row of an unlisted file: "), path)).cast("bigint")
    numbers = frame.sparkSession.createDataFrame([(f, k) for k, f in enumerate(files)], f"{path} string, {name}no bigint")
    return (
        frame.withColumns({path: F.regexp_replace("_metadata.file_path", _SLASHES, "/"), name: place})
        .join(F.broadcast(numbers), path, "left")
        .withColumn(name, F.shiftleft(F.coalesce(f"{name}no", unknown), 32).bitwiseOR(F.col(name)))
        .drop(path, f"{name}no")
    )


def pack(array: np.ndarray) -> bytes:
    """An array of unsigned 32-bit numbers, compressed."""
    raw = np.ascontiguousarray(array, dtype="<u4")
    return raw.size.to_bytes(4, "little") + pa.compress(
        raw.view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True
    )


def unpack(blob: bytes) -> np.ndarray:
    size = int.from_bytes(blob[:4], "little")
    raw = pa.decompress(blob[4:], size * 4, "zstd", asbytes=True)
    return np.frombuffer(raw, np.uint8).reshape(4, size).T.copy().view("<u4").ravel()


def pack_words(words: list[bytes]) -> bytes:
    """Words of any bytes, compressed: their lengths, then the joined bytes."""
    joined = b"".join(words)
    lengths = pack(np.fromiter(map(len, words), np.uint32, len(words)))
    return (
        len(lengths).to_bytes(4, "little")
        + len(joined).to_bytes(8, "little")
        + lengths
        + pa.compress(joined, "zstd", asbytes=True)
    )


def unpack_words(blob: bytes) -> list[bytes]:
    split = 12 + int.from_bytes(blob[:4], "little")
    size = int.from_bytes(blob[4:12], "little")
    joined = pa.decompress(blob[split:], size, "zstd", asbytes=True)
    ends = np.cumsum(unpack(blob[12:split]), dtype=np.int64).tolist()
    return [joined[a:b] for a, b in zip([0, *ends], ends)]


def text_batches(batches, column: int = -1, max_bytes: int = 16 << 20):
    """Arrow record batches cut so that the texts of one hold about `max_bytes`."""
    for batch in batches:
        sizes = np.diff(np.frombuffer(batch.column(column).buffers()[1], np.int32)[
            batch.column(column).offset : batch.column(column).offset + batch.num_rows + 1
        ]) if batch.num_rows else np.zeros(0)
        piece = np.cumsum(sizes) // max_bytes
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            if stop > start:
                yield batch.slice(start, stop - start)
                pa.default_memory_pool().release_unused()


def lean(run):
    """`run`, a function of record batches, giving a task's memory back when it ends.

    Worker processes wait for further tasks, and what they keep is missing in the next stage.
    """

    def leaving(batches):
        yield from run(batches)  # its own variables are gone after this
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # another C library
            pass

    return leaving
