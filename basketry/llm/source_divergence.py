"""How far the sources of a language differ in their words, by hash-consed segment trees.

A term is a run of ASCII letters and characters beyond ASCII, with A-Z lower-cased.  A
language keeps the terms that at least `least_docs` of its documents hold; they are the
positions of a segment tree, falling in total count.  The leaves of a source's tree are
its counts.  Nodes are hash-consed: equal pairs of children are one node, whichever tree
and place they stand in, so that all stretches of a rare term or none are shared.  Two
trees are compared by walking both at once, level by level; a pair of nodes that meets
more than once is priced once.

Scale.  Terms are counted per task and shuffled as (language, source, term) sums, once.  A
language's terms are cut into blocks by hash, such that a block has about `ENTRIES` counts,
and a block grows one subtree per source; the prices of the blocks' roots add up to
those of the whole trees.  With many sources the pairs are dealt over several tasks.
What meets in a task is thus bounded, and one language or source may hold all rows.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from .common import ship, stored, text_batches
from .graph import join_few

LEAST_DOCS = 30
TERM_RANKS = 50
ENTRIES = 1 << 15  # counts of one block: its terms times the sources and the language
PAIRS = 4096  # pairs of sources, in both directions, that one task compares
PENDING = 400_000  # distinct (group, term) a task holds before it hands them on

# Lower-case A-Z; bytes that are no letter and no part of a character beyond ASCII separate.
TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256)
)


def _named(column: str, name: str):
    return F.coalesce(F.col(column).cast("string"), F.lit("")).alias(name)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n_docs, n) per task, of documents (lang, source, data: UTF-8)."""

    def rows(counts, holders):
        for (lang, source), own in counts.items():
            terms = list(own)
            docs_of = holders[lang, source]
            for at in range(0, len(terms), 50_000):
                some = terms[at : at + 50_000]
                yield pa.record_batch(
                    [
                        pa.array([lang] * len(some), pa.string()),
                        pa.array([source] * len(some), pa.string()),
                        pa.array(some, pa.binary()).cast(pa.string()),
                        pa.array([docs_of[t] for t in some], pa.int64()),
                        pa.array([own[t] for t in some], pa.int64()),
                    ],
                    names=["lang", "source", "term", "n_docs", "n"],
                )

    def run(batches):
        from collections import Counter

        counts, holders, pending = defaultdict(Counter), defaultdict(Counter), 0
        for batch in text_batches(batches, 2):
            for lang, source, data in zip(*(column.to_pylist() for column in batch.columns)):
                terms = data.translate(TERM_BYTES).split()
                own = counts[lang, source]
                before = len(own)
                own.update(terms)
                holders[lang, source].update(set(terms))
                pending += len(own) - before
                if pending > PENDING:
                    yield from rows(counts, holders)
                    counts, holders, pending = defaultdict(Counter), defaultdict(Counter), 0
        yield from rows(counts, holders)

    return docs.mapInArrow(run, "lang string, source string, term string, n_docs bigint, n bigint")


class Forest:
    """Segment trees over the same positions, one per row of `counts`, with shared nodes.

    `counts` is padded to a power of two with -1, which stands for no position.
    """

    def __init__(self, counts: np.ndarray):
        rows, width = counts.shape
        padded = np.full((rows, 1 << max(width - 1, 0).bit_length()), -1, np.int64)
        padded[:, :width] = counts
        self.leaves, nodes = np.unique(padded, return_inverse=True)
        nodes = nodes.reshape(padded.shape)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # children of each level's nodes, upwards
        size = len(self.leaves)
        while nodes.shape[1] > 1:
            made, nodes = np.unique(nodes[:, ::2] * size + nodes[:, 1::2], return_inverse=True)
            nodes = nodes.reshape(rows, -1)
            self.levels.append((made // size, made % size))
            size = len(made)
        self.roots = nodes[:, 0]

    def meet(self, one: int, other: int):
        """Walk two trees at once: (leaf pairs, for each level upwards the pairs' child pairs)."""
        left = np.array([self.roots[one]])
        right = np.array([self.roots[other]])
        steps = []
        for first, second in reversed(self.levels):
            lefts = np.concatenate([first[left], second[left]])
            rights = np.concatenate([first[right], second[right]])
            span = int(rights.max()) + 1
            met, place = np.unique(lefts * span + rights, return_inverse=True)
            steps.append((place[: len(left)], place[len(left) :]))
            left, right = met // span, met % span
        return (left, right), steps[::-1]


def added_up(price: np.ndarray, steps) -> int:
    """The sum over all positions, from the price of each distinct pair of leaves."""
    for first, second in steps:
        price = price[first] + price[second]
    return int(price[0])


def largest(price: np.ndarray, steps, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, prices) of all positive prices not below the `count`-th largest one."""
    best = [price]
    for first, second in steps:
        best.append(np.maximum(best[-1][first], best[-1][second]))
    at, pair = np.zeros(1, np.int64), np.zeros(1, np.int64)
    values = best.pop()
    for first, second in reversed(steps):
        at = np.concatenate([2 * at, 2 * at + 1])
        pair = np.concatenate([first[pair], second[pair]])
        values = best.pop()[pair]
        # Each node has a position of its price: the count-th largest node bounds from below.
        least = np.partition(values, -count)[-count] if len(values) > count else 1
        keep = values >= max(int(least), 1)
        at, pair, values = at[keep], pair[keep], values[keep]
    keep = values > 0
    return at[keep], values[keep]


def shares(counts: np.ndarray, total: int, terms: int, weight: int, scale_digits: int) -> np.ndarray:
    """1 + floor(10^digits * (count + weight) / (total + weight * terms)), exactly; 0 where count < 0.

    Long division by three digits at a time: exact for totals up to 9 * 10^15.
    """
    divisor = total + weight * terms
    whole, rest = np.divmod(counts + weight, divisor)
    for _ in range(scale_digits // 3):
        digits, rest = np.divmod(rest * 1000, divisor)
        whole = whole * 1000 + digits
    return np.where(counts < 0, 0, 1 + whole)


def _compare(weight: int, ranks: int):
    def run(key, header, terms):
        head = header.slice(0, 1).to_pylist()[0]
        groups = sorted(head["groups"], key=lambda g: g["source"])
        names = [g["source"] for g in groups]
        size, kept, slices = len(names), head["terms"], head["slices"]
        totals = [g["total"] for g in groups] + [sum(g["total"] for g in groups)]
        out = {"source": [], "part": [], "item": [], "value": []}

        def add(source, part, item, value):
            for column, cell in zip(out.values(), (source, part, item, value)):
                column.append(cell)

        terms = terms.combine_chunks().sort_by([("total", "descending"), ("term", "ascending")])
        words = terms.column("term").to_pylist()
        counts = np.zeros((size + 1, max(len(words), 1)), np.int64)
        if words:
            lists = terms.column("counts").combine_chunks()
            held = lists.flatten()
            row = np.repeat(np.arange(len(words)), pc.list_value_length(lists).to_numpy())
            owner = pc.index_in(held.field("source"), pa.array(names, pa.string())).to_numpy()
            counts[owner, row] = held.field("n").to_numpy()
            counts[size] = terms.column("total").to_numpy()
        else:
            counts[:] = -1
        forest = Forest(counts)
        # What a count is worth in each group, once per distinct count.
        worth = [shares(forest.leaves, total, kept, weight, 9) if words else np.zeros(1, np.int64) for total in totals]
        for one in range(key[2].as_py(), size, slices):
            for other in range(one + 1, size):
                (left, right), steps = forest.meet(one, other)
                value = added_up(np.abs(worth[one][left] - worth[other][right]), steps)
                add(names[one], "pair", names[other], value)
                add(names[other], "pair", names[one], value)
            (left, right), steps = forest.meet(one, size)
            gain = worth[one][left] - worth[size][right]
            gain[(forest.leaves[left] <= 0) | (gain < 0)] = 0
            at, value = largest(gain, steps, ranks)
            chosen = sorted(zip((-value).tolist(), [words[k].encode() for k in at.tolist()]))[:ranks]
            for value, term in chosen:
                add(names[one], "term", term.decode(), -value)
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64()]
        columns = [pa.array(cells, kind) for cells, kind in zip(out.values(), kinds)]
        return pa.table([pa.array([key[0].as_py()] * len(out["value"]), pa.string()), *columns], names=["lang", *out])

    return run


def divergence(
    docs: DataFrame,
    lang_column: str = "lang",
    source_column: str = "source",
    text_column: str = "text",
    least_docs: int = LEAST_DOCS,
    weight: int = 5,
    ranks: int = TERM_RANKS,
    entries: int = ENTRIES,
    pairs: int = PAIRS,
) -> DataFrame:
    """(lang, source, part, item, value, rank) of every (language, source) group.

    A group's share of a kept term is 1 + floor(10^9 (count + weight) / (total + weight
    * terms)).  Part `pair` has a row per other source of the language: the absolute
    differences of their shares, summed over all kept terms (0 if none is kept).
    Part `term` has the group's terms whose share exceeds the language's, by that
    excess, to rank `ranks`.  Ranks go by falling value, then by the item's UTF-8
    bytes.  NULL and empty language, source and text are ''.  Groups without terms take
    part in all pairs; a language's only source has no pair.  Repeated rows count each
    time, other columns are ignored, an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    cells = docs.select(_named(lang_column, "lang"), _named(source_column, "source"), _named(text_column, "text"))
    counted = (
        term_counts(cells.select("lang", "source", F.encode("text", "UTF-8").alias("data")))
        .repartition("lang", "term")  # serves both sums: the terms are shuffled once
        .groupBy("lang", "source", "term")
        .agg(F.sum("n_docs").alias("n_docs"), F.sum("n").alias("n"))
        .groupBy("lang", "term")
        .agg(
            F.sum("n_docs").alias("n_docs"),
            F.sum("n").alias("total"),
            F.collect_list(F.struct("source", "n")).alias("counts"),
        )
        .where(F.col("n_docs") >= least_docs)
    )
    kept = stored(counted.drop("n_docs"))
    totals = kept.select("lang", F.inline("counts")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = cells.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
    sources = F.size("groups")
    header = stored(
        groups.groupBy("lang")
        .agg(F.collect_list(F.struct("source", F.coalesce("total", F.lit(0)).alias("total"))).alias("groups"))
        .join(kept.groupBy("lang").agg(F.count("*").alias("terms")), "lang", "left")
        .withColumn("terms", F.coalesce("terms", F.lit(0)))
        .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("terms") * (sources + 1) / F.lit(entries))).cast("int"))
        .withColumn("slices", F.ceil(sources * sources / F.lit(pairs)).cast("int"))
    )
    spread = F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
    blocks = header.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("slice", spread)
    terms = (
        join_few(kept, header.select("lang", "blocks", "slices"), "lang")
        .withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int"))
        .select("lang", "block", spread.alias("slice"), "term", "total", "counts")
    )
    keys = ["lang", "block", "slice"]
    found = stored(
        blocks.select(*keys, "groups", "terms", "slices")
        .groupBy(*keys)
        .cogroup(terms.groupBy(*keys))
        .applyInArrow(_compare(weight, ranks), "lang string, source string, part string, item string, value bigint")
    )
    names = ["lang", "source", "part", "item"]
    summed = found.where("part = 'pair'").groupBy(*names).agg(F.sum("value").alias("value"))
    place = F.row_number().over(
        Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    )
    every = summed.withColumn("rank", place)
    first = found.where("part = 'term'").withColumn("rank", place).where(F.col("rank") <= ranks)
    return every.unionByName(first)
