"""Benchmark decontamination with a distributed positional inverted index.

The index is split by documents: a segment holds some megabytes of texts, and for
every term a posting list of the positions where it stands.  A position counts the
words of the whole segment, with a gap between documents wider than any phrase, so
one sorted list per term and segment serves all its documents.  The index is stored
and holds the terms that the test set asks for.

A phrase is looked up from its rarest term (by counts over the whole corpus): that
term's list, shifted by the term's offset in the phrase, gives the possible starts,
and the other lists, rarer ones first, are intersected with what is left.

The test set is taken in blocks of a fixed number of phrases; each block is one pass.
So nothing grows with the test set but the number of passes, and what a task holds
is a block of phrases and a segment.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import ROW, WORD_BYTES, lean, pack, pinned, stored, text_batches, unpack, with_row_id
from .graph import only_rows

WINDOW = 10
BLOCK_PHRASES = 200_000
SEGMENT_BYTES = 8 << 20
GAP = 1024


def words_of(text: str | None) -> list[bytes]:
    """Words of a-z, 0-9 and non-ASCII characters, A-Z lower-cased."""
    return text.encode().translate(WORD_BYTES).split() if text else []


def phrases_of(text: str | None, window: int = WINDOW) -> list[tuple[bytes, ...]]:
    """Every run of `window` words; of fewer words, all of them; of none, nothing."""
    words = words_of(text)
    last = max(1, len(words) - window + 1) if words else 0
    return [tuple(words[i : i + window]) for i in range(last)]


class PhraseBlock:
    """Phrases of a bounded part of the test set, as numbers of their terms."""

    def __init__(self, items: list[tuple[int | None, list[tuple[bytes, ...]]]]):
        self.terms: dict[bytes, int] = {}
        self.items = [item for item, _ in items]
        owners: dict[tuple[int, ...], list[int]] = {}
        for number, (_, phrases) in enumerate(items):
            for phrase in phrases:
                key = tuple(self.terms.setdefault(word, len(self.terms)) for word in phrase)
                owner = owners.setdefault(key, [])
                if not owner or owner[-1] != number:
                    owner.append(number)
        self.phrases = list(owners)
        self.owners = list(owners.values())

    def rarest_first(self, counts: dict[int, int]) -> list[list[tuple[int, int]]]:
        """Per phrase its (term, offset) pairs, rare terms first; phrases with an absent term are empty."""
        plans = []
        for phrase in self.phrases:
            plan = sorted(((t, k) for k, t in enumerate(phrase)), key=lambda p: (counts.get(p[0], 0), p[1]))
            plans.append(plan if counts.get(plan[0][0], 0) else [])
        return plans


def _blocks(benchmark: DataFrame, id_column: str, text_column: str, window: int, limit: int) -> Iterator[PhraseBlock]:
    held, count = [], 0
    for item, text in benchmark.select(id_column, text_column).toLocalIterator():
        phrases = phrases_of(text, window)
        for at in range(0, len(phrases), limit):
            held.append((item, phrases[at : at + limit]))
            count += len(held[-1][1])
            if count >= limit:
                yield PhraseBlock(held)
                held, count = [], 0
    if held:
        yield PhraseBlock(held)


_INDEX = "segment bigint, term int, n bigint, postings binary, rows array<bigint>, ends binary"


def _indexer(terms: dict[bytes, int]):
    """Segments of the texts: one row per term, and one (term NULL) with rows and text ends."""

    def run(batches):
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(text_batches(batches, 1, SEGMENT_BYTES)):
            segment = (part << 32) | number
            lists, ends, at = [], [], 0
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                lists.append(np.fromiter((terms.get(w, -1) for w in words), np.int32, len(words)))
                ends.append(len(words))
            starts = np.concatenate([[0], np.cumsum(np.array(ends, np.int64) + GAP)])[:-1]
            numbers = np.concatenate(lists) if lists else np.zeros(0, np.int32)
            where = np.arange(len(numbers)) + np.repeat(
                starts - np.concatenate([[0], np.cumsum(ends)])[:-1], ends
            )
            hit = np.flatnonzero(numbers >= 0)
            numbers, where = numbers[hit], where[hit]
            order = np.argsort(numbers, kind="stable")
            found, first = np.unique(numbers[order], return_index=True)
            pieces = np.split(where[order], first[1:]) if len(found) else []
            yield pa.record_batch(
                [
                    pa.array([segment] * (len(found) + 1), pa.int64()),
                    pa.array([*found.tolist(), None], pa.int32()),
                    pa.array([*map(len, pieces), len(ends)], pa.int64()),
                    pa.array([*(pack(np.diff(p, prepend=0)) for p in pieces), None], pa.binary()),
                    pa.array([None] * len(found) + [batch.column(0).to_pylist()], pa.list_(pa.int64())),
                    pa.array([None] * len(found) + [pack(np.array(ends))], pa.binary()),
                ],
                names=["segment", "term", "n", "postings", "rows", "ends"],
            )

    return run


class _Segment:
    def __init__(self, rows: list[dict]):
        self._packed = {r["term"]: r["postings"] for r in rows if r["term"] is not None}
        self._lists: dict[int, np.ndarray] = {}
        head = next(r for r in rows if r["term"] is None)
        self.rows = head["rows"]
        self.lengths = unpack(head["ends"]).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths + GAP)])[:-1]

    def positions(self, term: int) -> np.ndarray | None:
        if term not in self._packed:
            return None
        if term not in self._lists:
            self._lists[term] = np.cumsum(unpack(self._packed[term]), dtype=np.int64)
        return self._lists[term]

    def exact(self, plan: list[tuple[int, int]]) -> np.ndarray:
        """Starts of a phrase: offset-adjusted lists intersected from the rarest term on."""
        starts = None
        for term, offset in plan:
            where = self.positions(term)
            if where is None:
                return np.zeros(0, np.int64)
            if starts is None:
                starts = where - offset
            else:
                wanted = starts + offset
                at = np.minimum(np.searchsorted(where, wanted), len(where) - 1)
                starts = starts[where[at] == wanted]
            if not len(starts):
                break
        return starts if starts is not None else np.zeros(0, np.int64)

    def near(self, phrase: tuple[int, ...], plan: list[tuple[int, int]], slop: int) -> list[tuple[int, int]]:
        """(start, end) spans with the phrase's words in order and at most `slop` words between them."""
        lists = [self.positions(t) for t in phrase]
        if not plan or any(x is None for x in lists):
            return []
        rare, offset = self.positions(plan[0][0]), plan[0][1]
        first = lists[0]
        # Only starts within reach of the rarest term are tried.
        near = np.searchsorted(rare, first + offset + slop, "right") > np.searchsorted(rare, first + offset)
        at = first[near]
        start = at
        for where in lists[1:]:
            nxt = np.searchsorted(where, at, "right")
            keep = nxt < len(where)
            start, at = start[keep], where[nxt[keep]]
        keep = at - start <= len(phrase) - 1 + slop
        return list(zip(start[keep].tolist(), (at[keep] + 1).tolist()))

    def document(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, position, "right") - 1


_HITS = f"{ROW} bigint, n_words bigint, hit array<bigint>, items array<bigint>"
_SPANS = f"{ROW} bigint, item_id bigint, first bigint, last bigint"


def _search(block: PhraseBlock, plans):
    def run(group: pa.Table) -> pa.Table:
        segment = _Segment(group.to_pylist())
        marks: dict[int, list[np.ndarray]] = {}
        items: dict[int, set[int]] = {}
        for plan, owners in zip(plans, block.owners):
            starts = segment.exact(plan) if plan else ()
            if not len(starts):
                continue
            docs = segment.document(starts)
            for d in np.unique(docs).tolist():
                words = (starts[docs == d] - segment.starts[d])[:, None] + np.arange(len(plan))
                marks.setdefault(d, []).append(words.ravel())
                items.setdefault(d, set()).update(owners)
        hit = [np.unique(np.concatenate(marks[d])) if d in marks else [] for d in range(len(segment.rows))]
        return pa.table(
            {
                ROW: pa.array(segment.rows, pa.int64()),
                "n_words": pa.array(segment.lengths, pa.int64()),
                "hit": pa.array(hit, pa.list_(pa.int64())),
                "items": pa.array(
                    [[block.items[i] for i in sorted(items.get(d, ()))] for d in range(len(segment.rows))],
                    pa.list_(pa.int64()),
                ),
            }
        )

    return run


def _search_near(block: PhraseBlock, plans, slop: int):
    def run(group: pa.Table) -> pa.Table:
        segment = _Segment(group.to_pylist())
        out = set()
        for phrase, plan, owners in zip(block.phrases, plans, block.owners):
            spans = segment.near(phrase, plan, slop)
            if spans:
                docs = segment.document(np.array([a for a, _ in spans])).tolist()
                for d, (a, b) in zip(docs, spans):
                    base = int(segment.starts[d])
                    out.update((segment.rows[d], block.items[i], a - base, b - base) for i in owners)
        rows = sorted(out, key=str)
        names = [ROW, "item_id", "first", "last"]
        return pa.table({n: pa.array([r[k] for r in rows], pa.int64()) for k, n in enumerate(names)})

    return run


def _passes(docs, benchmark, text_column, item_column, benchmark_text, window, block_phrases):
    """(block, plans, index) for each block of the test set; the index is stored."""
    texts = with_row_id(docs).select(ROW, F.col(text_column).cast("string").alias("_text"))
    for block in _blocks(benchmark, item_column, benchmark_text, window, block_phrases):
        index = stored(texts.mapInArrow(lean(_indexer(block.terms)), _INDEX))
        counts = {  # at most as many rows as the block has terms
            r["term"]: r["n"]
            for r in index.where("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator()
        }
        yield block, block.rarest_first(counts), index


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    benchmark_text: str = "text",
    window: int = WINDOW,
    block_phrases: int = BLOCK_PHRASES,
) -> DataFrame:
    """One row per document: (_row_id, doc_id, n_words, n_hit, n_items, items_sha256, contaminated).

    A hit word lies in an occurrence of a window of a test item.  NULL and empty texts
    have no words; items without words, or with a NULL text, have no windows.  Items
    that repeat an id count once; items with a NULL id hit words but are not counted.
    Without documents the result is empty; without items nothing is hit.
    """
    if window > GAP:
        raise ValueError(f"a window may have at most {GAP} words")
    docs = pinned(docs)
    parts = [
        index.groupBy("segment").applyInArrow(_search(block, plans), _HITS)
        for block, plans, index in _passes(
            docs, benchmark, text_column, item_column, benchmark_text, window, block_phrases
        )
    ]
    if not parts:  # nothing to look for: words are counted all the same
        texts = with_row_id(docs).select(ROW, F.col(text_column).cast("string").alias("_text"))
        index = texts.mapInArrow(_indexer({}), _INDEX)
        parts = [index.groupBy("segment").applyInArrow(_search(PhraseBlock([]), []), _HITS)]
    found = parts[0]
    if len(parts) > 1:
        for part in parts[1:]:
            found = found.unionByName(part)
        found = found.groupBy(ROW).agg(
            F.first("n_words").alias("n_words"),
            F.array_distinct(F.flatten(F.collect_list("hit"))).alias("hit"),
            F.flatten(F.collect_list("items")).alias("items"),
        )
    items = F.array_sort(F.array_distinct(F.transform(F.array_compact("items"), lambda i: i.cast("string"))))
    ids = with_row_id(docs).select(ROW, F.col(id_column).alias("doc_id"))
    return ids.join(found, ROW).select(
        ROW,
        "doc_id",
        "n_words",
        F.size("hit").cast("bigint").alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.size("hit") > 0).alias("contaminated"),
    )


def proximity_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    slop: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    benchmark_text: str = "text",
    window: int = WINDOW,
    block_phrases: int = BLOCK_PHRASES,
) -> DataFrame:
    """(_row_id, doc_id, item_id, first, last): word spans that hold a window's words in order.

    At most `slop` other words may stand between them; `last` is exclusive.  For each
    start the shortest span is given.  Edge cases are as in `benchmark_hits`.
    """
    if window + slop > GAP:
        raise ValueError(f"window and slop may have at most {GAP} words")
    docs = pinned(docs)
    found = docs.sparkSession.createDataFrame([], _SPANS)
    for block, plans, index in _passes(
        docs, benchmark, text_column, item_column, benchmark_text, window, block_phrases
    ):
        part = index.groupBy("segment").applyInArrow(_search_near(block, plans, slop), _SPANS)
        found = found.unionByName(part)
    ids = with_row_id(docs).select(ROW, F.col(id_column).alias("doc_id"))
    return ids.join(found.distinct(), ROW).select(ROW, "doc_id", "item_id", "first", "last")


def decontaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """`docs` without the documents that hold a window of the benchmark, all columns kept."""
    docs = pinned(docs)
    hits = benchmark_hits(docs, benchmark, **settings)
    return only_rows(docs, hits.where("NOT contaminated"))
