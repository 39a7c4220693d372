"""Token pairs of two tokenizers that end together, and how often the corpus holds each pair.

Both tokenizers cut a text where a space follows a character that is no white space, so a
text is a sequence of chunks that are encoded and aligned on their own, each distinct one
once per batch of texts.  The first pass collects and counts pairs per task.  The distinct pairs are
dealt into `SHARDS` shards, and each shard is given a minimal perfect hash in a task: bit
arrays level by level, where a key's rank among the set bits is its number.  The tasks'
counts become dense vectors indexed by that number, which are summed shard by shard in a
tree.  Every lookup is verified against the key stored at its number.  The second pass
aligns the documents again and looks the counts up.

Scale: texts are never shuffled.  Of two tokens that end together one's bytes are a suffix
of the other's, so the two vocabularies alone bound the distinct pairs, whatever the corpus
(`Pieces.most_pairs`, about 700,000 for two vocabularies of 50,000 and 32,000 tokens; the
bound is checked).  That bounds every vector, the hash and what is broadcast.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .bpe import OTHER, WORDS, byte_letters
from .common import ship, stored, text_batches

SHARDS = 64
FAN_IN = 16  # vectors that one task of the tree adds
BATCH_BYTES = 4 << 20  # of text that a task aligns at once
RUN_LENGTH = 4_000  # characters of chunks that are encoded in one call

# White space in any version of Unicode, and separators that some count as such.
_WHITE = "\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff"
# Spaces and the run after them; a run that ends in white space takes the next one in.
_JOINED = re.compile(f"[^{_WHITE}]\\Z")  # a chunk that the next one may follow
_CHUNK = re.compile(f"(?: [^ ]*+(?<=[{_WHITE}])(?= ))*+ [^ ]*+")


class Pieces(NamedTuple):
    """The two tokenizers' files, as what can be sent to tasks."""

    byte_level: str
    piece_model: bytes

    @classmethod
    def read(cls, byte_level_path: str, piece_model_path: str) -> Pieces:
        with open(byte_level_path, encoding="utf-8") as text, open(piece_model_path, "rb") as model:
            return cls(text.read(), model.read())

    def most_pairs(self) -> int:
        """An upper bound of the pairs that can end together: suffixes that are tokens too."""
        a, b = aligner(self).bytes_a, aligner(self).bytes_b
        held_a, held_b = Counter(a), Counter(b)
        return sum(held_b[t[k:]] for t in a for k in range(len(t))) + sum(
            held_a[t[k:]] for t in b for k in range(1, len(t))
        )


class Chunks(NamedTuple):
    """Distinct chunks, encoded and aligned, as flat arrays in the order of the chunks."""

    valid: np.ndarray  # per chunk: do the tokens of both spell it?
    n_a: np.ndarray  # tokens per chunk; none where not valid
    n_b: np.ndarray
    n_links: np.ndarray
    a: np.ndarray  # token ids
    b: np.ndarray
    cut_a: np.ndarray  # does a token of the other end where this one does?
    cut_b: np.ndarray

    def codes(self) -> np.ndarray:
        """The linked pairs, first id << 32 | second id."""
        return self.a[self.cut_a] << 32 | self.b[self.cut_b]


class Aligner:
    """Encodes chunks with both tokenizers and aligns them."""

    def __init__(self, pieces: Pieces):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(pieces.byte_level)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces.piece_model)
        letter = {c: b for b, c in byte_letters().items()}
        entries = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for entry, number in entries.items():
            self.bytes_a[number] = bytes(letter[c] for c in entry if c in letter)
        self.bytes_b = []
        for number in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(number)
            if self.b.is_byte(number):
                self.bytes_b.append(bytes([int(piece[1:-1], 16)]))
            elif self.b.is_control(number) or self.b.is_unknown(number):
                self.bytes_b.append(b"")
            else:
                self.bytes_b.append(piece.replace("▁", " ").encode())
        self.size_a, self.size_b = (np.array(list(map(len, of))) for of in (self.bytes_a, self.bytes_b))
        # Where ids rise as merges are applied, ids are ranks and a faster encoder gives the same.
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in json.loads(pieces.byte_level)["model"]["merges"]]
        ranked = [entries.get(x + y) for x, y in merges]
        special = {t["content"] for t in json.loads(pieces.byte_level)["added_tokens"]}
        self.fast = None
        if ranked == list(range(256, 256 + len(merges))):
            ranks = {self.bytes_a[i]: i for entry, i in entries.items() if entry not in special}
            self.fast = tiktoken.Encoding("ranks", pat_str=WORDS.pattern, mergeable_ranks=ranks, special_tokens={})
        self.space = self.b.piece_to_id("▁")
        # A piece with a space after another character would join chunks.
        self.chunked = self.bytes_b[self.space] == b" " and not any(re.search(rb"[^ ] ", piece) for piece in self.bytes_b)
        # The model must leave white space as it is, or chunks would lose theirs.
        self.chunked &= b"".join(self.bytes_b[i] for i in self.b.encode("a  b \t c ")) == b" a  b \t c "
        self._digits: list[bytes] | None = None

    def chunks(self, text: str) -> list[str]:
        spaced = " " + text
        return _CHUNK.findall(spaced) if self.chunked else [spaced]

    def _runs(self, chunks: list[str]):
        """Chunks in runs that are encoded as one string, since each is cut off from the next."""
        run, size, kind = [], 0, None
        for chunk in chunks:
            other = bool(OTHER.search(chunk))
            if run and (size > RUN_LENGTH or other != kind or not _JOINED.search(run[-1]) or not self.chunked):
                yield run
                run, size = [], 0
            run.append(chunk)
            size, kind = size + len(chunk), other
        if run:
            yield run

    def _encode(self, run: list[str]) -> tuple[list[int], list[int]] | None:
        """Both tokenizers' ids of the run; None where they do not spell it."""
        joined = "".join(run)
        if self.fast and not OTHER.search(joined):
            a = self.fast.encode_ordinary(joined)
        else:
            a = self.a.encode(joined, add_special_tokens=False).ids
        # An empty text has no tokens, where a text's last space has its own.
        b = self.b.encode(joined[1:]) if len(joined) > 1 else [self.space]
        data = joined.encode()
        spelt = all(b"".join(map(of.__getitem__, ids)) == data for of, ids in ((self.bytes_a, a), (self.bytes_b, b)))
        return (a, b) if spelt else None

    def align(self, chunks: list[str]) -> Chunks:
        valid = np.ones(len(chunks), bool)
        flat_a, flat_b, at = [], [], 0
        for run in self._runs(chunks):
            both = self._encode(run)
            if both:
                flat_a += both[0]
                flat_b += both[1]
            else:
                for k, chunk in enumerate(run, at):
                    both = self._encode([chunk])
                    valid[k] = both is not None
                    flat_a += both[0] if both else []
                    flat_b += both[1] if both else []
            at += len(run)
        a, b = np.array(flat_a, np.int64), np.array(flat_b, np.int64)
        sizes = np.fromiter((len(c.encode()) for c in chunks), np.int64, len(chunks)) * valid
        ends_a, ends_b, ends = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]), np.cumsum(sizes)
        mark = np.zeros(int(ends[-1]) + 1 if len(ends) else 1, np.uint8)
        mark[ends_a] += 1
        mark[ends_b] += 1
        cut_a, cut_b = mark[ends_a] == 2, mark[ends_b] == 2
        per_chunk = (np.diff(np.searchsorted(e, ends, "right"), prepend=0) for e in (ends_a, ends_b, ends_a[cut_a]))
        return Chunks(valid, *per_chunk, a, b, cut_a, cut_b)

    def groups(self, made: Chunks) -> list[bytes]:
        """Of each chunk `a1,a2|b1;a3|b2,b3;`, with a semicolon after each group."""
        if self._digits is None:
            ids = [str(i).encode() for i in range(max(len(self.bytes_a), len(self.bytes_b)))]
            self._digits = [i + mark for mark in (b",", b"|", b";") for i in ids]
            self._lengths = np.array(list(map(len, self._digits)))
        span = len(self._digits) // 3
        group_a, group_b = (np.cumsum(cut) - cut for cut in (made.cut_a, made.cut_b))
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        shown = np.concatenate([made.a + span * made.cut_a, made.b + 2 * span * made.cut_b])[order]
        joined = b"".join(map(self._digits.__getitem__, shown.tolist()))
        before = np.concatenate([[0], np.cumsum(self._lengths[shown])])
        cuts = before[np.concatenate([[0], np.cumsum(made.n_a + made.n_b)])].tolist()
        return [joined[x:y] for x, y in zip(cuts, cuts[1:])]


@functools.lru_cache(maxsize=1)
def aligner(pieces: Pieces) -> Aligner:
    return Aligner(pieces)


class Batch(NamedTuple):
    """The texts of a batch as sequences of its distinct chunks."""

    counts: np.ndarray  # chunks per text
    numbers: np.ndarray  # of all texts' chunks
    made: Chunks
    spelt: np.ndarray  # per text: has it chunks, all of them valid?

    @classmethod
    def of(cls, own: Aligner, texts: list[str | None]) -> Batch:
        seen: dict[str, int] = {}
        parts = []
        for text in texts:
            some = own.chunks(text) if text else []
            parts.append(np.fromiter((seen.setdefault(c, len(seen)) for c in some), np.int64, len(some)))
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        numbers = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        made = own.align(list(seen))
        return cls(counts, numbers, made, (counts > 0) & (cls._sums(counts, numbers, ~made.valid) == 0))

    @staticmethod
    def _sums(counts: np.ndarray, numbers: np.ndarray, of_chunks: np.ndarray) -> np.ndarray:
        before = np.concatenate([[0], np.cumsum(of_chunks[numbers], dtype=np.int64)])
        ends = np.cumsum(counts)
        return before[ends] - before[ends - counts]

    def sums(self, of_chunks: np.ndarray) -> np.ndarray:
        """Per text, the sum of a number of its chunks; 0 where the text is not spelt."""
        return self._sums(self.counts, self.numbers, of_chunks) * self.spelt


def _merged(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, place = np.unique(codes, return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, place, counts)
    return found, total


def pair_counts(texts: DataFrame, pieces: Pieces, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """First pass over a frame of one text column: (codes, counts), one row per task, sorted by code."""
    shipped = texts.sparkSession.sparkContext.broadcast(pieces)

    def run(batches):
        own = aligner(shipped.value)
        codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in text_batches(batches, 0, batch_bytes):
            found = Batch.of(own, batch.column(0).to_pylist())
            used = found.numbers[np.repeat(found.spelt, found.counts)]
            times = np.repeat(np.bincount(used, minlength=len(found.made.valid)), found.made.n_links)
            codes, counts = _merged(
                np.concatenate([codes, found.made.codes()[times > 0]]), np.concatenate([counts, times[times > 0]])
            )
        yield pa.record_batch(
            [pa.array([codes.tobytes()], pa.binary()), pa.array([counts.tobytes()], pa.binary())],
            names=["codes", "counts"],
        )

    return texts.mapInArrow(run, "codes binary, counts binary")


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 well-mixed bits of each key, another set for each seed."""
    x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Numbers 0 to n - 1 for n distinct keys.

    A level has two slots per key still to be placed.  A key alone in its slot sets the
    slot's bit and stays, the others go on to the next level.  A key's number is the rank
    of its bit over all levels.
    """

    def __init__(self, sizes: list[int], bits: bytes):
        self.sizes, self.bits = sizes, bits
        flags = np.unpackbits(np.frombuffer(bits, np.uint8))[: sum(sizes)].astype(bool)
        self.flags, self.rank = flags, np.cumsum(flags) - 1

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        sizes, flags = [], []
        while len(keys):
            sizes.append(2 * len(keys))
            slot = (mixed(keys, len(sizes)) % np.uint64(sizes[-1])).astype(np.int64)
            alone = np.bincount(slot, minlength=sizes[-1]) == 1
            flags.append(alone)
            keys = keys[~alone[slot]]
        joined = np.concatenate(flags) if flags else np.zeros(0, bool)
        return cls(sizes, np.packbits(joined).tobytes())

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """A number of each key; -1 or any number for a key that was not there when it was built."""
        found = np.full(len(keys), -1, np.int64)
        left, start = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes, 1):
            slot = (mixed(keys[left], level) % np.uint64(size)).astype(np.int64) + start
            here = self.flags[slot]
            found[left[here]] = self.rank[slot[here]]
            left, start = left[~here], start + size
        return found


class PairTable:
    """Verified lookups of pairs over all shards."""

    def __init__(self, hashes: list[tuple[list[int], bytes]], keys: list[bytes]):
        self.hashes = [PerfectHash(*h) for h in hashes]
        self.keys = np.concatenate([np.frombuffer(k, np.int64) for k in keys])
        self.starts = np.concatenate([[0], np.cumsum([len(k) // 8 for k in keys])]).astype(np.int64)

    def numbers(self, codes: np.ndarray) -> np.ndarray:
        shard = shard_of(codes)
        found = np.empty(len(codes), np.int64)
        for s in np.unique(shard).tolist():
            own = np.flatnonzero(shard == s)
            number = self.hashes[s].numbers(codes[own])
            if (number < 0).any():
                raise ValueError("a pair that the first pass did not see")
            found[own] = number + self.starts[s]
        if (self.keys[found] != codes).any():
            raise ValueError("a pair that the first pass did not see")
        return found


def shard_of(codes: np.ndarray) -> np.ndarray:
    return (mixed(codes, 0) % np.uint64(SHARDS)).astype(np.int64)


def _codes(batches):
    """Distinct pairs of the tasks' rows, and their shards."""
    seen = np.zeros(0, np.int64)
    for batch in batches:
        for codes in batch.column(0).to_pylist():
            seen = np.union1d(seen, np.frombuffer(codes, np.int64))
    yield pa.record_batch([pa.array(shard_of(seen).astype(np.int32)), pa.array(seen)], names=["shard", "code"])


def _hashed(key, rows):
    keys = np.sort(rows.column("code").to_numpy())
    made = PerfectHash.of(keys)
    placed = np.empty(len(keys), np.int64)
    placed[made.numbers(keys)] = keys
    columns = [
        pa.array([key[0].as_py()], pa.int32()), pa.array([made.sizes], pa.list_(pa.int64())),
        pa.array([made.bits], pa.binary()), pa.array([placed.tobytes()], pa.binary()),
    ]
    return pa.table(columns, names=["shard", "sizes", "bits", "keys"])


def _vectors(shipped):
    def run(batches):
        table: PairTable = shipped.value
        total = np.zeros(len(table.keys), np.int64)
        for batch in batches:
            for codes, counts in zip(*(column.to_pylist() for column in batch.columns)):
                total[table.numbers(np.frombuffer(codes, np.int64))] += np.frombuffer(counts, np.int64)
        node = TaskContext.get().partitionId()
        slices = [total[a:b].tobytes() for a, b in zip(table.starts, table.starts[1:])]
        columns = [
            pa.array(range(len(slices)), pa.int32()), pa.array([node] * len(slices), pa.int32()),
            pa.array(slices, pa.binary()),
        ]
        yield pa.record_batch(columns, names=["shard", "node", "vector"])

    return run


def _added(key, rows):
    vectors = rows.column("vector").to_pylist()
    total = sum(np.frombuffer(v, np.int64) for v in vectors)
    columns = [pa.array([k.as_py()], pa.int32()) for k in key] + [pa.array([total.tobytes()], pa.binary())]
    return pa.table(columns, names=["shard", "node", "vector"])


def counted_pairs(counts: DataFrame, pieces: Pieces) -> tuple[PairTable, np.ndarray]:
    """The distinct pairs, numbered by their minimal perfect hash, and their summed counts.

    `counts` is what `pair_counts` gives, stored.
    """
    spark = counts.sparkSession
    context = spark.sparkContext
    distinct = stored(counts.select("codes").mapInArrow(_codes, "shard int, code bigint").distinct())
    most, found = pieces.most_pairs(), distinct.count()
    if found > most:
        raise ValueError(f"{found} pairs, more than the {most} that the vocabularies permit")
    made = (
        distinct.groupBy("shard")
        .applyInArrow(_hashed, "shard int, sizes array<bigint>, bits binary, keys binary")
        .collect()  # bits and keys of at most `most` pairs
    )
    by_shard = {r.shard: r for r in made}
    hashes = [(list(by_shard[s].sizes), bytes(by_shard[s].bits)) if s in by_shard else ([], b"") for s in range(SHARDS)]
    keys = [bytes(by_shard[s]["keys"]) if s in by_shard else b"" for s in range(SHARDS)]
    table = PairTable(hashes, keys)
    shipped = context.broadcast(table)
    schema = "shard int, node int, vector binary"
    level = stored(counts.mapInArrow(_vectors(shipped), schema))
    while (level.agg(F.max("node")).first()[0] or 0) > 0:
        level = level.withColumn("node", F.expr(f"int(node div {FAN_IN})"))
        level = stored(level.groupBy("shard", "node").applyInArrow(_added, schema))
    sums = {r.shard: bytes(r.vector) for r in level.collect()}
    shipped.unpersist()
    return table, np.concatenate([np.frombuffer(sums.get(s, b""), np.int64) for s in range(SHARDS)])


_RESULT = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups {}"


def aligned(
    docs: DataFrame,
    pieces: Pieces,
    id_column: str = "doc_id",
    text_column: str = "text",
    digest: bool = False,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """One row per document: (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups).

    Tokens of space+text by the first tokenizer and of the text by the second, special
    strings taken as plain text, are cut into groups wherever a token of each ends.  A
    group is `a1,a2|b1` in decimal ids, groups are joined by `;`; its last two tokens
    are a link.  `count_sum` adds up how many links of the corpus hold the same pair, and
    `n_best` counts the links whose pair is the most frequent one of its second token,
    ties included.  NULL and empty texts, and texts that the tokens of either tokenizer
    do not spell, have zeros and empty groups.  With `digest`, `groups` is the lowercase
    SHA-256 of the groups, or '' without tokens.  `batch_bytes` of
    text are aligned at once, which changes no result.  Repeated rows count each time; other
    columns are ignored; an empty table gives an empty result.
    """
    spark: SparkSession = docs.sparkSession
    ship(spark)
    text = F.col(text_column).cast("string").alias("_text")
    table, counts = counted_pairs(stored(pair_counts(docs.select(text), pieces, batch_bytes)), pieces)
    best = np.zeros(len(aligner(pieces).bytes_b), np.int64)
    second = table.keys & 0xFFFFFFFF
    np.maximum.at(best, second, counts)
    shipped = spark.sparkContext.broadcast((pieces, table, counts, counts == best[second]))

    def run(batches):
        pieces, table, counts, is_best = shipped.value
        own = aligner(pieces)
        for batch in text_batches(batches, 1, batch_bytes):
            found = Batch.of(own, batch.column(1).to_pylist())
            made = found.made
            linked = np.flatnonzero(np.repeat(np.bincount(found.numbers[np.repeat(found.spelt, found.counts)], minlength=len(made.valid)) > 0, made.n_links))
            each, best = np.zeros((2, int(made.n_links.sum())), np.int64)
            number = table.numbers(made.codes()[linked])
            each[linked], best[linked] = counts[number], is_best[number]
            ends = np.cumsum(made.n_links)

            def per_chunk(of_links):
                before = np.concatenate([[0], np.cumsum(of_links)])
                return before[ends] - before[ends - made.n_links]

            links = found.sums(made.n_links)
            numbers = [
                found.sums(made.n_a), found.sums(made.n_b), links, links, found.sums(per_chunk(best)), found.sums(per_chunk(each)),
            ]
            shown, groups, at = [], own.groups(made), 0
            places = found.numbers.tolist()
            for count, spelt in zip(found.counts.tolist(), found.spelt.tolist()):
                joined = b"".join([groups[k] for k in places[at : at + count]])[:-1] if spelt else b""
                shown.append((hashlib.sha256(joined).hexdigest() if digest and spelt else joined.decode()))
                at += count
            columns = [*(pa.array(c) for c in numbers), pa.array(shown, pa.string())]
            names = ["doc_id", *(c.split()[0] for c in _RESULT.split(", "))]
            yield pa.record_batch([batch.column(0), *columns], names=names)

    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), text)
    return rows.mapInArrow(run, "doc_id bigint, " + _RESULT.format("string"))
