"""Near-duplicate detection with MinHash bands and odd sketches.

1. Every text becomes its set of distinct 3-word shingles (64-bit hashes).  Rows
   with equal sets collapse to one representative, so copies cost no pairs.
2. A representative gets K MinHash samples.  Its samples, folded into a parity
   bitmap, are its odd sketch: the population count of two sketches' XOR estimates
   their similarity, most precisely where it is high.
3. Samples in bands give buckets.  Within a bucket, sketches are compared and only
   a spanning forest of the pairs that may reach the threshold is kept; forests
   connect to clusters, which hold every true link.
4. Within a cluster, links are confirmed on full sets, again keeping a forest of
   them, and connect to components.

Scale: buckets and clusters beyond a fixed size are cut into blocks, and every pair
of blocks is a task of its own, so no group is gathered whole and no pair is left
out.  Only forests are ever rows: at most one per member of a block pair.

Recall: two sets of similarity 0.85 share no band with probability below 1e-6, and
the sketch cut lies six standard deviations below the threshold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import ROW, lean, pinned, stored, text_batches, with_row_id
from .graph import components, join_few, join_spread, only_rows

BANDS, DEPTH = 24, 5
SAMPLES = BANDS * DEPTH
SKETCH_BITS = 512
SHINGLE = 3
THRESHOLD = 85  # per cent of the union
SLACK = 0.20  # how far below the threshold an estimate may lie
BLOCK_ROWS = 1024
BLOCK_BYTES = 4 << 20
BATCH_BYTES = 2 << 20

_DRAW = np.random.default_rng(20240501)
_A = _DRAW.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _DRAW.integers(0, 1 << 63, SAMPLES, dtype=np.uint64)
_TURN = _DRAW.integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class _WordHashes(dict):
    """Hashes of words met so far; starts anew when it is full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _WordHashes()


def shingle_set(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """The sorted distinct shingle hashes of a text; fewer words make one shingle."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    count = len(words) - width + 1
    total = np.full(count, width, np.uint64)
    for k in range(width):
        total += hashes[k : k + count] * _TURN[k]
    return np.unique(_mixed(total))


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(band keys, odd sketches) of non-empty sets, one row each."""
    joined = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    rows = np.arange(len(sets))
    keys = np.zeros((len(sets), BANDS), np.uint64)
    sketch = np.zeros((len(sets), SKETCH_BITS // 64), np.uint64)
    for i in range(SAMPLES):
        sample = np.minimum.reduceat(joined * _A[i] + _B[i], starts)
        band = i // DEPTH
        keys[:, band] = _mixed(keys[:, band] + sample * _TURN[i % DEPTH] + np.uint64(band))
        bit = _mixed(sample + np.uint64(i)) % np.uint64(SKETCH_BITS)
        sketch[rows, (bit >> np.uint64(6)).astype(np.intp)] ^= np.uint64(1) << (bit & np.uint64(63))
    return keys.view(np.int64), sketch


def similarity(differing_bits: np.ndarray) -> np.ndarray:
    """Estimated similarity of two sets from the XOR population count of their sketches."""
    inner = np.maximum(1 - 2 * np.asarray(differing_bits) / SKETCH_BITS, 1e-9)
    return 1 + SKETCH_BITS / (4 * SAMPLES) * np.log(inner)


def _most_bits(threshold: int) -> int:
    """The largest population count whose estimate reaches the threshold less the slack."""
    least = threshold / 100 - SLACK
    return int(SKETCH_BITS / 2 * (1 - math.exp(4 * SAMPLES / SKETCH_BITS * (least - 1))))


class _Forest:
    def __init__(self, size: int):
        self.parent = list(range(size))
        self.trees = size

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.trees -= 1

    def links(self, names: np.ndarray) -> list[tuple[int, int]]:
        roots = [self.find(i) for i in range(len(names))]
        return [(int(names[i]), int(names[r])) for i, r in enumerate(roots) if i != r]


def _close_pairs(
    sketch: np.ndarray, cross: np.ndarray | None, most: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(a, b, differing bits) of the members a < b in reach of each other, some rows at a time."""
    size = len(sketch)
    step = max(1, (1 << 18) // max(1, size))
    for at in range(0, size, step):
        rows = sketch[at : at + step]
        bits = np.bitwise_count(rows[:, None, :] ^ sketch[None, :, :]).sum(axis=2, dtype=np.int64)
        near = (bits <= most) & (np.arange(size)[None, :] > np.arange(at, at + len(rows))[:, None])
        if cross is not None:
            near &= cross[at : at + len(rows), None] != cross[None, :]
        a, b = np.nonzero(near)
        yield a + at, b, bits[a, b]


def _describe(width: int):
    schema = pa.schema(
        [
            (ROW, pa.int64()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()),
            ("_key", pa.binary()), ("_bands", pa.list_(pa.int64())), ("_sketch", pa.binary()),
        ]
    )

    def run(batches):
        for batch in text_batches(batches, 2, BATCH_BYTES):
            sets = [shingle_set(t, width) for t in batch.column(2).to_pylist()]
            full = [s for s in sets if len(s)]
            keys, sketch = signatures(full) if full else (np.zeros((0, BANDS), np.int64), [])
            at = iter(range(len(full)))
            where = [next(at) if len(s) else -1 for s in sets]
            yield pa.record_batch(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([keys[i] if i >= 0 else [] for i in where], pa.list_(pa.int64())),
                    pa.array([sketch[i].tobytes() if i >= 0 else b"" for i in where], pa.binary()),
                ],
                schema=schema,
            )
        _HASHES.clear()

    return run


_DESCRIBED = (
    f"{ROW} bigint, doc_id bigint, n_shingles bigint, _key binary, "
    "_bands array<bigint>, _sketch binary"
)


def _bucket_forest(most: int):
    def run(batches):
        for batch in batches:
            found: list[tuple[int, int]] = []
            for row in batch.to_pylist():
                reps = np.array(row["reps"], np.int64)
                sketch = np.frombuffer(b"".join(row["sketches"]), np.uint64).reshape(len(reps), -1)
                # Whole block pairs are compared: a forest over all of it loses nothing.
                forest = _Forest(len(reps))
                for a, b, _ in _close_pairs(sketch, None, most):
                    for x, y in zip(a.tolist(), b.tolist()):
                        forest.union(x, y)
                    if forest.trees == 1:
                        break
                found += forest.links(reps)
            yield pa.record_batch(
                [pa.array([u for u, _ in found], pa.int64()), pa.array([v for _, v in found], pa.int64())],
                names=["u", "v"],
            )

    return run


def _in_blocks(members: DataFrame, key: str, parts: str) -> DataFrame:
    """Every member once per pair of blocks (_i <= _j) that its own block takes part in."""
    own = F.pmod(F.xxhash64("rep"), F.col(parts)).cast("int")
    other = F.sequence(F.lit(0), F.col(parts).cast("int") - 1)
    return (
        members.withColumn("_own", own)
        .withColumn("_other", F.explode(other))
        .withColumn("_i", F.least("_own", "_other"))
        .withColumn("_j", F.greatest("_own", "_other"))
        .drop("_other")
    )


def _sets(width: int):
    def run(batches):
        for batch in text_batches(batches, 2, BATCH_BYTES):
            sets = [shingle_set(t, width) for t in batch.column(2).to_pylist()]
            sketch = signatures(sets)[1]
            yield pa.record_batch(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                    pa.array([s.tobytes() for s in sketch], pa.binary()),
                ],
                names=["rep", "cluster", "_set", "_sketch"],
            )
        _HASHES.clear()

    return run


def linked(a: np.ndarray, b: np.ndarray, threshold: int = THRESHOLD) -> bool:
    """Whether 100 * intersection >= threshold * union, on sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) * 100 < threshold * len(b):
        return False
    both = int(np.count_nonzero(b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a))
    return 100 * both >= threshold * (len(a) + len(b) - both)


def _confirmed(threshold: int, most: int):
    def run(key, group: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(s, np.uint64) for s in group["_set"]]
        reps = group["rep"].to_numpy()
        sketch = np.frombuffer(b"".join(group["_sketch"]), np.uint64).reshape(len(reps), -1)
        # A pair of two blocks looks across them; links inside are found by block pair (i, i).
        cross = group["_own"].to_numpy() if key[1] != key[2] else None
        forest = _Forest(len(reps))
        for a, b, bits in _close_pairs(sketch, cross, most):
            order = np.argsort(bits, kind="stable")
            for x, y in zip(a[order].tolist(), b[order].tolist()):
                if forest.find(x) != forest.find(y) and linked(sets[x], sets[y], threshold):
                    forest.union(x, y)
            if forest.trees == 1:
                break
        return pd.DataFrame(forest.links(reps), columns=["u", "v"], dtype="int64")

    return run


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    threshold: int = THRESHOLD,
    width: int = SHINGLE,
    block_rows: int = BLOCK_ROWS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: (_row_id, doc_id, n_shingles, component_id, kept).

    Words are separated by ASCII white space, A-Z lower-cased.  A text of fewer
    words than `width` is one shingle; without words, or NULL, a text has none and is alone in its
    component.  `component_id` is the smallest id of the component (NULL ids come
    last; NULL only if it has no other).  One row stays per component: the one with
    that id; of rows repeating it, the first in scan order.  An empty table gives an
    empty result; other columns are ignored.
    """
    most = _most_bits(threshold)
    rows = with_row_id(docs).select(
        ROW, F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("_text")
    )
    described = stored(rows.mapInArrow(lean(_describe(width)), _DESCRIBED))
    reps = stored(
        described.where("n_shingles > 0")
        .groupBy("_key")
        .agg(
            F.min(ROW).alias("rep"), F.first("_bands").alias("_bands"), F.first("_sketch").alias("_sketch"),
            F.count("*").alias("_rows"),
        )
    )
    banded = reps.select("rep", F.explode("_bands").alias("_bucket"))
    crowded = banded.groupBy("_bucket").agg(F.count("*").alias("_n")).where("_n > 1")
    members = stored(
        banded.join(crowded, "_bucket").select(
            "rep", "_bucket", F.ceil(F.col("_n") / block_rows).cast("bigint").alias("_parts")
        )
    ).join(reps.select("rep", "_sketch"), "rep")
    buckets = (
        _in_blocks(members, "_bucket", "_parts")
        .groupBy("_bucket", "_i", "_j")
        .agg(F.collect_list(F.struct("rep", "_sketch")).alias("_m"))
        .select(F.col("_m.rep").alias("reps"), F.col("_m._sketch").alias("sketches"))
    )
    clusters = stored(
        components(buckets.mapInArrow(_bucket_forest(most), "u bigint, v bigint")).select(
            F.col("node").alias(ROW), F.col("component").alias("cluster")
        )
    )
    sets = stored(
        join_few(rows, clusters, ROW)
        .select(ROW, "cluster", "_text")
        .mapInArrow(lean(_sets(width)), "rep bigint, cluster bigint, _set binary, _sketch binary")
    )
    sizes = sets.groupBy("cluster").agg(
        F.greatest(
            F.ceil(F.sum(F.octet_length("_set")) / block_bytes), F.ceil(F.count("*") / block_rows)
        ).cast("bigint").alias("_parts")
    )
    links = (
        _in_blocks(sets.join(sizes, "cluster"), "cluster", "_parts")
        .repartition("cluster", "_i", "_j")  # else all block pairs of a cluster may stay together
        .groupBy("cluster", "_i", "_j")
        .applyInPandas(_confirmed(threshold, most), "u bigint, v bigint")
    )
    joined = components(links).withColumnsRenamed({"node": "rep"})
    same = stored(
        reps.select("_key", "rep", "_rows").join(joined, "rep", "left").select(
            "_key", "_rows", F.coalesce("component", "rep").alias("_component")
        )
    )
    # Rows without words have no set to meet by; one that is hot meets its rows in parts.
    narrow = described.select(ROW, "doc_id", "n_shingles", "_key")
    labelled = stored(
        join_spread(narrow.where("n_shingles > 0"), same, ["_key"], "_rows")
        .select(ROW, "doc_id", "n_shingles", "_component")
        .unionByName(narrow.where("n_shingles = 0").select(ROW, "doc_id", "n_shingles", F.col(ROW).alias("_component")))
    )
    first = stored(
        labelled.groupBy("_component").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("late"), F.col("doc_id").alias("id"), F.col(ROW).alias("at"))).alias("_first"),
            F.count("*").alias("_rows"),
        )
    )
    return join_spread(labelled, first, ["_component"], "_rows").select(
        ROW,
        "doc_id",
        "n_shingles",
        F.col("_first.id").alias("component_id"),
        (F.col("_first.at") == F.col(ROW)).alias("kept"),
    )


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **settings) -> DataFrame:
    """`docs` with one row of each component of near-duplicates, all columns kept."""
    docs = pinned(docs)
    return only_rows(docs, near_duplicates(docs, id_column, text_column, **settings).where("kept"))
