"""Token counts with a finite-state transducer compiled from a byte-level BPE vocabulary.

A BPE encoding's every prefix is the encoding of the prefix's text, and a sequence of
tokens is an encoding exactly if each adjacent pair is.  So the last token of a
prefix, and with it the number of tokens, follows from a bounded memory: for each
place from which some vocabulary entry may still grow, the entry's beginning (a trie
node), the token before it, and the token count there.  That memory is the state of a
deterministic transducer over bytes; its transitions are annotated with the change in
the number of tokens.  States and transitions are compiled when first met.

A text is cut into chunks, all of which run at once, one byte per step.  A word's start
resets the state, so a chunk's map from entry state to exit state is a constant from its
first word start on; the bytes before it (its head) run once the state they enter with is
known from the chunk before.  The maps compose chunk by chunk in as many rounds as the
longest word has chunks; sums of the annotated counts give the documents' counts.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from .bpe import OTHER, Vocabulary, around_specials, tokenizer_of
from .common import ROW, text_batches, with_row_id

CHUNK = 512
MOST_STATES = 200_000
BATCH_BYTES = 4 << 20
LIMIT = 1024
HEADS = 2048  # heads that run together; states may be forgotten between two such blocks
ROUNDS = 16  # in which maps are run for all states that may be met; afterwards only where needed

_MISSING = np.int32(-1)
_SHIFT = 8  # a transition holds the next state above, the change in count (plus 128) below


class Transducer:
    """The counting transducer of a vocabulary (`pieces` by id, `merges` by rank)."""

    def __init__(self, vocabulary: Vocabulary):
        letter = vocabulary.pieces()
        self.number = {p: i for i, p in enumerate(letter) if p and p.decode("latin-1") not in vocabulary.specials}
        # Per entry: the rank after which its last merge can run, and the entries it merges.
        raw = {entry: i for entry, i in vocabulary.entries.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.ready = {i: -1 for p, i in self.number.items() if len(p) == 1}
        for rank, merge in enumerate(vocabulary.merges):
            left, right = (raw[x] for x in (merge.split(" ") if isinstance(merge, str) else merge))
            self.rank[left, right] = rank
            whole = self.number[letter[left] + letter[right]]
            if whole not in self.parts:
                self.parts[whole] = left, right
                self.ready[whole] = max(rank, self.ready[left], self.ready[right])
        # The trie of all entries: children by byte, and the entry that ends at a node.
        self.children: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]
        for piece, number in self.number.items():
            node = 0
            for byte in piece:
                if byte not in self.children[node]:
                    self.children[node][byte] = len(self.children)
                    self.children.append({})
                    self.ends.append(-1)
                node = self.children[node][byte]
            self.ends[node] = number
        self.fits: dict[tuple[int, int], bool] = {}
        self.reset()

    def reset(self) -> None:
        """Forget all compiled states but the start."""
        self.index = {((0, -1, 0),): 0}
        self.states = [((0, -1, 0),)]
        self.column = np.full(256, -1, np.int64)  # of the table, for bytes met so far
        self.table = np.full((1024, 64), _MISSING, np.int32)

    def renew(self, states: np.ndarray) -> np.ndarray:
        """Forget all compiled states but the start and the given ones; their new numbers."""
        used, place = np.unique(states, return_inverse=True)
        memories = [self.states[k] for k in used.tolist()]
        columns, width = self.column, self.table.shape[1]
        self.reset()
        self.column, self.table = columns, np.full((1024, width), _MISSING, np.int32)
        return np.array([self.intern(m) for m in memories], np.int64)[place]

    def intern(self, memory: tuple) -> int:
        """The number of a state, given one if it is new."""
        state = self.index.get(memory)
        if state is None:
            state = self.index[memory] = len(self.states)
            self.states.append(memory)
            if state >= len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, _MISSING)])
        return state

    def adjacent(self, left: int, right: int) -> bool:
        """Whether the two tokens may follow each other in an encoding.

        They may not if some merge across their border comes before the merges that would
        take its two sides away: sides are the tokens on the border while the left one
        grows to `left` and the right one to `right`.
        """
        key = (left, right)
        if key in self.fits:
            return self.fits[key]
        lefts, rights = [left], [right]
        while lefts[-1] in self.parts:
            lefts.append(self.parts[lefts[-1]][1])
        while rights[-1] in self.parts:
            rights.append(self.parts[rights[-1]][0])
        fits, never = True, len(self.rank)
        while fits:
            x, y = lefts[-1], rights[-1]
            next_x = self.ready[lefts[-2]] if len(lefts) > 1 else never
            next_y = self.ready[rights[-2]] if len(rights) > 1 else never
            across = self.rank.get((x, y), never)
            # Of equal ranks the leftmost merge comes first.
            fits = not (across < next_x and across <= next_y and across < never)
            if next_x == next_y == never:
                break
            (lefts if next_x <= next_y else rights).pop()
        self.fits[key] = fits
        return fits

    def compile(self, state: int, byte: int) -> None:
        grown, last, count = [], -1, 0
        for node, before, at in self.states[state]:
            child = self.children[node].get(byte)
            if child is None:
                continue
            if self.children[child]:
                grown.append((child, before, at))
            token = self.ends[child]
            if last < 0 and token >= 0 and (before < 0 or self.adjacent(before, token)):
                last, count = token, at + 1
        if last < 0:
            raise ValueError("the vocabulary lacks a byte")
        memory = tuple(sorted((n, b, a - count) for n, b, a in [*grown, (0, last, count)]))
        target = self.intern(memory)
        self.table[state, self.column[byte]] = (target << _SHIFT) | (count + 128)

    def step(self, states: np.ndarray, data: np.ndarray) -> np.ndarray:
        """The transitions taken by many states at once."""
        moves = self.table[states, self.column[data]]
        if moves.min(initial=0) < 0:
            missing = moves < 0
            for key in np.unique(states[missing].astype(np.int64) << 8 | data[missing]).tolist():
                self.compile(key >> 8, key & 255)
            moves = self.table[states, self.column[data]]
        return moves

    def meet(self, data: np.ndarray) -> None:
        """Give every byte of the data a column of the table."""
        for byte in np.flatnonzero((np.bincount(data, minlength=256) > 0) & (self.column < 0)).tolist():
            self.column[byte] = self.column.max() + 1
            if self.column[byte] >= self.table.shape[1]:
                self.table = np.concatenate([self.table, np.full_like(self.table, _MISSING)], axis=1)


@functools.lru_cache(maxsize=2)
def _machine(vocabulary: Vocabulary) -> Transducer:
    return Transducer(vocabulary)


# Classes of characters: 0 other, 1 letter, 2 number, 3 space, 4 other white space.
@functools.lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    for number, kind in ((1, r"\p{L}+"), (2, r"\p{N}+"), (4, r"\s+")):
        for found in regex.finditer(kind, every):
            run = np.frombuffer(found[0].encode("utf-32-le"), "<u4")
            table[run] = number
    table[32] = 3
    return table


def word_starts(text: str) -> np.ndarray:
    """Where the tokenizer's words start, as a flag per character."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    kind = _classes()[points]
    size = len(kind)
    before = np.concatenate([[255], kind[:-1]])
    after = np.concatenate([kind[1:], [255]])
    white, white_before = kind >= 3, (before >= 3) & (before != 255)
    starts = np.where(
        white,
        ~white_before | ((after < 3)),  # a run of white space leaves its last character to the word after it
        (before != kind) & (before != 3),
    )
    starts[:1] = True
    # After an apostrophe that starts a word, an English ending is a word of its own.
    quote = np.flatnonzero((points == 39) & (before != 0) & (before != 3) & (after == 1))
    for at in quote.tolist():
        ending = _ENDING.match(text, at)
        if ending:
            stop = ending.end()
            starts[at + 1 : stop] = False
            if stop < size:
                starts[stop] = True
    return starts


_ENDING = re.compile("'(?:s|t|re|ve|m|ll|d)")


def count_tokens(texts: list[str], machine: Transducer, chunk: int = CHUNK, starts_of=word_starts) -> np.ndarray:
    """The number of tokens of each text."""
    if len(machine.states) > MOST_STATES:
        machine.reset()
    encoded = [t.encode() for t in texts]
    sizes = np.array([len(e) for e in encoded], np.int64)
    if not sizes.sum():
        return np.zeros(len(texts), np.int64)
    data = np.frombuffer(b"".join(encoded), np.uint8)
    machine.meet(data)
    starts = np.zeros(len(data), bool)
    starts[np.flatnonzero((data & 0xC0) != 0x80)] = np.concatenate([starts_of(t) for t in texts if t])
    offset = np.cumsum(sizes) - sizes
    # Chunks never span texts.
    pieces = -(-sizes // chunk)
    owner = np.repeat(np.arange(len(texts)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = offset[owner] + nth * chunk
    end = np.minimum(begin + chunk, (offset + sizes)[owner])
    marks = np.flatnonzero(starts)
    first = np.minimum(np.append(marks, len(data))[np.searchsorted(marks, begin)], end)
    total, leaves = _run(machine, data, starts, first, end, np.zeros(len(begin), np.int64))
    # Heads: the part of a chunk before its first word start, entered from the chunk before.
    known = first < end
    waiting = np.flatnonzero(first > begin)
    for heads in np.split(waiting, range(HEADS, len(waiting), HEADS)):
        if len(machine.states) > MOST_STATES:
            leaves = machine.renew(leaves)
        entries = np.where(known[heads - 1], leaves[heads - 1], -1)
        # The next head is entered with what this one leaves, if it has no word start.
        linked = np.append(np.diff(heads) == 1, False) & ~known[heads]

        def run(places: np.ndarray, states: np.ndarray):
            return _run(machine, data, starts, begin[heads[places]], first[heads[places]], states)

        added, out = _scan(entries, linked, run)
        total[heads] += added
        leaves[heads] = np.where(known[heads], leaves[heads], out)
        known[heads] = True
    return np.bincount(owner, total, len(texts)).astype(np.int64)


def _scan(entries: np.ndarray, linked: np.ndarray, run) -> tuple[np.ndarray, np.ndarray]:
    """(change in count, exit state) of each chunk of a sequence, whose maps `run` computes.

    `entries` are the known entry states, -1 where the chunk before decides (it is `linked`).
    `run(places, states)` runs chunks for given entries, any number of them at once.
    """
    size = len(entries)
    places, states = np.arange(size), np.maximum(entries, 0)
    sums, leaves = run(places, states)
    for turn in range(size + 1):
        # Entries of the maps, in order; each leads to an entry of the next chunk's map.
        keys = places << 32 | states
        order = np.argsort(keys)
        places, states, sums, leaves, keys = places[order], states[order], sums[order], leaves[order], keys[order]
        then = (places + 1) << 32 | leaves
        jump = np.minimum(np.searchsorted(keys, then), len(keys) - 1)
        leads = linked[places]
        missing = leads & (keys[jump] != then)
        jump = np.where(leads & ~missing, jump, -1)
        # Prefix scan: after k steps all entries within 2^k chunks of a known one are found.
        real = (entries >= 0)[places] & (states == entries[places])
        for _ in range(max(1, size).bit_length()):
            real[jump[real & (jump >= 0)]] = True
            jump = np.where(jump >= 0, jump[jump], -1)
        if not (real & missing).any():
            break
        new = np.unique(then[missing] if turn < ROUNDS else then[missing & real])
        more, out = run(new >> 32, new & 0xFFFFFFFF)
        places, states = np.append(places, new >> 32), np.append(states, new & 0xFFFFFFFF)
        sums, leaves = np.append(sums, more), np.append(leaves, out)
    return sums[real], leaves[real]


def _run(machine, data, starts, begin, end, states) -> tuple[np.ndarray, np.ndarray]:
    """Run chunks [begin, end) from their entry states: (change in count, exit state) of each."""
    order = np.argsort(begin - end, kind="stable")
    at, stop, state = begin[order], end[order], states[order].copy()
    total = np.zeros(len(order), np.int64)
    length = stop - at
    live = len(order)
    for k in range(int(length[0]) if live else 0):
        live = int(np.searchsorted(-length[:live], -k, "left"))
        where = at[:live] + k
        now = np.where(starts[where], 0, state[:live])
        moves = machine.step(now, data[where])
        state[:live] = moves >> _SHIFT
        total[:live] += (moves & 255) - 128
    sums, leaves = np.empty_like(total), np.empty_like(state)
    sums[order], leaves[order] = total, state
    return sums, leaves


def _starts_with(vocabulary: Vocabulary):
    """Word starts; where a character's class may depend on the Unicode version, by the tokenizer's own splitter."""

    def starts_of(text: str) -> np.ndarray:
        if not OTHER.search(text):
            return word_starts(text)
        starts = np.zeros(len(text), bool)
        for _, (at, _) in tokenizer_of(vocabulary.text).pre_tokenizer.pre_tokenize_str(text):
            starts[at] = True
        return starts

    return starts_of


def token_counts(
    docs: DataFrame,
    vocabulary: Vocabulary,
    id_column: str = "doc_id",
    text_column: str = "text",
    limit: int = LIMIT,
) -> DataFrame:
    """One row per document: (_row_id, doc_id, n_bytes, n_tokens, over_limit).

    Counts what the tokenizer gives without added special tokens, truncation or padding;
    a special string within a text is one token.  NULL and empty texts have none.  An
    empty table gives an empty result; other columns are ignored.  No shuffle.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = with_row_id(docs).select(
        ROW, F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("_text")
    )
    ids = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        machine, around = _machine(shipped.value), around_specials(list(shipped.value.specials))
        starts_of = _starts_with(shipped.value)
        for batch in text_batches(batches, 2, BATCH_BYTES):
            parts, owner, specials = [], [], np.zeros(batch.num_rows, np.int64)
            for k, text in enumerate(batch.column(2).to_pylist()):
                cut = around.split(text) if around else [text]
                specials[k] = len(cut) // 2
                parts += cut[::2]
                owner += [k] * len(cut[::2])
            counts = count_tokens(parts, machine, starts_of=starts_of)
            total = np.bincount(owner, counts, batch.num_rows).astype(np.int64) + specials
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pc.binary_length(batch.column(2)).cast("int64"), pa.array(total)],
                names=[ROW, "doc_id", "n_bytes", "n_tokens"],
            )

    counted = rows.mapInArrow(run, f"{ROW} bigint, doc_id {ids}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
