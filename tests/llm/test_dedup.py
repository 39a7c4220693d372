"""Exact and near deduplication, shards and components against brute force."""

import heapq
import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

from basketry.llm import common, exact_dedup, graph, near_dedup, sharding
from basketry.llm.common import stored
from basketry.llm.graph import components


@pytest.mark.parametrize("changed", [False, True])
def test_row_ids_do_not_depend_on_the_splits(spark, tmp_path, changed):
    path, sizes = str(tmp_path / "d"), (1, 900, 40, 3000, 7)
    for k, n in enumerate(sizes):
        part = spark.range(n).select((F.col("id") + 10_000 * k).alias("doc_id"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
        part.coalesce(1).write.mode("append").parquet(path)
    frame = spark.read.parquet(path)
    if changed:
        frame = frame.where("doc_id % 3 > 0").withColumn("text", F.upper("text"))
    assert common.pinned(frame) is frame
    found = []
    try:
        for size in ("128m", "20k", "1k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            found.append({r.doc_id: r._row_id for r in common.with_row_id(frame).collect()})
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found[0] == found[1] == found[2]
    assert len(set(found[0].values())) == len(found[0]) == frame.count()


def test_row_ids_of_frames_that_repeat_rows(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.range(5).write.parquet(path)
    one = spark.read.parquet(path)
    for frame in (one.crossJoin(spark.range(3).withColumnRenamed("id", "k")), one.withColumn("k", F.explode(F.array(F.lit(1), F.lit(2))))):
        ids = [r._row_id for r in common.with_row_id(frame).collect()]
        assert len(set(ids)) == len(ids) == frame.count()


def test_exact_groups(odd_docs):
    rows = exact_dedup.duplicate_groups(odd_docs, first_digit=4, growth=2).collect()
    texts = {r._1: r._2 for r in odd_docs.selectExpr("monotonically_increasing_id() _1", "coalesce(text, '') _2").collect()}
    assert len(rows) == len(texts)
    groups = defaultdict(list)
    for r in rows:
        groups[texts[r._row_id]].append(r)
    for members in groups.values():
        assert {r.group_size for r in members} == {len(members)}
        assert sum(r.kept for r in members) == 1
        ids = [r.doc_id for r in members if r.doc_id is not None]
        assert {r.keep_id for r in members} == {max(ids, default=None)}


@pytest.mark.parametrize("prefix", ["", "same beginning " * 40])
def test_exact_long_shared_prefixes(spark, tmp_path, prefix):
    texts = [prefix + t for t in ("a", "b", "a", "ab", "", "b", "é", "e")]
    path = str(tmp_path / "d")
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(path)
    found = exact_dedup.duplicate_groups(spark.read.parquet(path), first_digit=2, growth=2).collect()
    counts = Counter(texts)
    assert {r.doc_id: r.group_size for r in found} == {i: counts[t] for i, t in enumerate(texts)}
    assert exact_dedup.deduplicated(spark.read.parquet(path)).count() == len(counts)


def test_deduplicated_keeps_clashing_columns(odd_docs):
    kept = exact_dedup.deduplicated(odd_docs)
    assert kept.columns == odd_docs.columns
    assert {r._row_id for r in kept.collect()} == {"r"}
    assert kept.count() == odd_docs.selectExpr("coalesce(text, '')").distinct().count()


def test_empty_tables(no_docs):
    assert exact_dedup.duplicate_groups(no_docs).count() == 0
    assert near_dedup.near_duplicates(no_docs).count() == 0
    assert sharding.assign_shards(no_docs).count() == 0


def brute_components(texts, width, threshold):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        k = min(width, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= threshold * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


@pytest.mark.parametrize("block_rows,block_bytes", [(1024, 4 << 20), (8, 4000)])
def test_near_components(spark, tmp_path, block_rows, block_bytes):
    random.seed(11)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(25):
        base = [random.choice(words) for _ in range(random.choice([3, 30, 120]))]
        for _ in range(random.choice([1, 2, 12])):
            copy = list(base)
            for _ in range(random.choice([0, 1, 2, 4])):
                copy[random.randrange(len(copy))] = random.choice(words)
            texts.append(" ".join(copy))
    texts += [None, "", "one", "One", "one two", " \n"]
    path = str(tmp_path / "d")
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(path)
    found = near_dedup.near_duplicates(
        spark.read.parquet(path), block_rows=block_rows, block_bytes=block_bytes
    ).collect()
    roots, sizes = brute_components(texts, 3, 85)
    assert {r.doc_id: (r.component_id, r.n_shingles, r.kept) for r in found} == {
        i: (roots[i], sizes[i], roots[i] == i) for i in range(len(texts))
    }


def test_near_odd_cases(odd_docs):
    rows = near_dedup.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert {by[1][0].component_id, by[2][0].component_id, by[11][0].component_id} == {1}
    assert [r.kept for r in by[9]].count(True) == 1
    assert by[6][0].component_id == by[7][0].component_id == 6
    assert by[3][0].n_shingles == by[4][0].n_shingles == by[5][0].n_shingles == 0
    assert by[3][0].kept and by[4][0].kept and by[5][0].kept


def test_odd_sketch_estimates():
    rng = np.random.default_rng(1)
    for share in (0.7, 0.85, 0.95):
        both = rng.integers(0, 1 << 62, int(2000 * share), dtype=np.uint64)
        rest = rng.integers(0, 1 << 62, (2, int(2000 * (1 - share) / 2)), dtype=np.uint64)
        _, sketch = near_dedup.signatures([np.concatenate([both, r]) for r in rest])
        bits = np.bitwise_count(sketch[0] ^ sketch[1]).sum()
        assert abs(near_dedup.similarity(bits) - share) < 0.15


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    found = components(spark.createDataFrame(path + star + [(7, 7)], "u bigint, v bigint")).collect()
    assert {r.node: r.component for r in found} == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


@pytest.mark.parametrize("shards", [1, 3, 24])
def test_schedule_is_longest_first(shards):
    random.seed(shards)
    sizes = sorted({random.randint(0, 60): random.choice([1, 3, 500]) for _ in range(9)}.items(), reverse=True)
    heap, expected = [(0, k) for k in range(shards)], []
    for size, groups in sizes:
        given = [0] * shards
        for _ in range(groups):
            load, shard = heap[0]
            given[shard] += 1
            heapq.heapreplace(heap, (load + size, shard))
        expected.append((size, given))
    assert list(sharding.schedule(sizes, shards)) == expected


def test_shards(odd_docs):
    rows = sharding.assign_shards(odd_docs, shards=3).collect()
    texts = {r._1: r._2 for r in odd_docs.selectExpr("monotonically_increasing_id() _1", "coalesce(text, '') _2").collect()}
    shard_of, slots, loads = {}, defaultdict(list), Counter()
    for r in rows:
        assert r["size"] == len(texts[r._row_id].encode()) + 8
        assert shard_of.setdefault(texts[r._row_id], r.shard) == r.shard
        slots[r.shard].append(r.slot)
        loads[r.shard] += r["size"]
    assert len(rows) == len(texts)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = Counter()
    for t in texts.values():
        groups[t] += len(t.encode()) + 8
    heap = [0] * 3
    for load in sorted(groups.values(), reverse=True):
        heapq.heapreplace(heap, heap[0] + load)
    assert sorted(loads[k] for k in range(3)) == sorted(heap)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_rows_of_hot_groups_are_spread(spark, tmp_path, monkeypatch, how):
    monkeypatch.setattr(graph, "HOT_SHARE", 100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # Half of the rows have key 0; key 5000 has no group and NULL never meets.
        rows = spark.range(4000).selectExpr(
            "id AS _row_id", "CASE WHEN id % 2 = 0 THEN 0 WHEN id = 1 THEN NULL WHEN id = 3 THEN 5000 ELSE id END AS k"
        )
        groups = stored(rows.where("k <> 5000").groupBy("k").count().withColumn("v", F.col("k") * 2))
        joined = graph.join_spread(rows, groups, ["k"], "count", how)
        found = sorted((r._row_id, r.k, r.v) for r in joined.collect())
        expected = [(r._row_id, r.k, None if r.k in (None, 5000) else 2 * r.k) for r in rows.collect()]
        assert found == sorted(e for e in expected if how == "left" or e[2] is not None)
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        # The hot key alone has 2000 rows; its parts are dealt over the four partitions.
        assert len(sizes) == 4 and max(sizes) < 1500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
