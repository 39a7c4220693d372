"""Byte-level BPE encoding through a distinct-word table, and decoding.

Texts are cut into words as the tokenizer cuts them, special strings first.  Each
distinct word is encoded once, by the tokenizer itself; the ids come back to the
word's positions (`word_blocks`).  Decoding joins ids with their pieces: the table of
pieces has one row per vocabulary entry, a proven bound, and goes to every task.
"""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from .common import ROW, lean, pack, text_batches, unpack, unpack_words, with_row_id
from .word_blocks import by_word, gathered, join_by_block, spans, word_blocks

# Fixed value: how the byte-level tokenizer cuts a text into words.
WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
CACHED_WORDS = 100_000


class Vocabulary:
    """A byte-level BPE tokenizer file, as text that can be sent to tasks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            self.text = file.read()
        parsed = json.loads(self.text)
        cut = parsed["pre_tokenizer"] or {}
        if parsed["normalizer"] or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space"):
            raise ValueError("not a byte-level BPE tokenizer")
        self.specials = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        self.entries = parsed["model"]["vocab"]
        self.merges = parsed["model"]["merges"]

    def __eq__(self, other) -> bool:
        return isinstance(other, Vocabulary) and self.text == other.text

    def __hash__(self) -> int:
        return hash(self.text)

    def pieces(self) -> list[bytes]:
        """The bytes of every id."""
        letter = {c: b for b, c in byte_letters().items()}
        size = max([*self.entries.values(), *self.specials.values()]) + 1
        pieces = [b""] * size
        for entry, number in self.entries.items():
            pieces[number] = bytes(letter[c] for c in entry if c in letter)
        for content, number in self.specials.items():
            pieces[number] = content.encode()
        return pieces


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


def around_specials(specials) -> re.Pattern | None:
    """Cuts a text so that every second part is a special string."""
    longest_first = sorted(specials, key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if specials else None


# Letters, digits and white space of these ranges are such in every Unicode version.
OTHER = re.compile("[^\x00-\u02ff\u2010-\u2027\u20ac]")


def splitter(specials, shipped):
    """A function that cuts a text into the tokenizer's words.

    Texts with characters whose class may depend on the Unicode version are cut by the
    tokenizer's own splitter.  `shipped` is a broadcast of the tokenizer file's text.
    """

    def cut(text: str) -> list[str]:
        if OTHER.search(text):
            found = tokenizer_of(shipped.value).pre_tokenizer.pre_tokenize_str(text)
            return [text[a:b] for _, (a, b) in found]
        return WORDS.findall(text)

    around = around_specials(specials)

    def split(text: str | None) -> list[bytes]:
        if not text:
            return []
        if around and around.search(text):
            words = []
            for k, part in enumerate(around.split(text)):
                words += [part] if k % 2 else cut(part)
        else:
            words = cut(text)
        return [w.encode() for w in words]

    return split


@functools.lru_cache(maxsize=2)
def tokenizer_of(text: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(text)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _encode_words(shipped):
    def run(batches):
        tokenizer = tokenizer_of(shipped.value)
        known: dict[bytes, list[int]] = {}
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                words = unpack_words(row["words"])
                if len(known) > CACHED_WORDS:
                    known.clear()
                new = [w for w in words if w not in known]
                for word, coded in zip(
                    new, tokenizer.encode_batch([w.decode() for w in new], add_special_tokens=False)
                ):
                    known[word] = coded.ids
                ids = [known[w] for w in words]
                sizes = np.fromiter(map(len, ids), np.uint32, len(ids))
                flat = np.fromiter((i for own in ids for i in own), np.uint32, int(sizes.sum()))
                out.append((row["block"], row["at"], pack(sizes), pack(flat)))
            kinds = [pa.int64()] + [pa.binary()] * 3
            columns = zip(*out) if out else [[]] * 4
            yield pa.record_batch(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["block", "at", "sizes", "flat"]
            )

    return run


def _assemble(counts, numbers, values: pa.Table):
    words = int(numbers.max()) + 1 if len(numbers) else 0
    start, length = np.zeros(words, np.int64), np.zeros(words, np.int64)
    flats, total = [], 0
    for row in values.to_pylist():
        at = np.cumsum(unpack(row["at"]).view(np.int32), dtype=np.int64)
        sizes = unpack(row["sizes"]).astype(np.int64)
        start[at] = total + np.cumsum(sizes) - sizes
        length[at] = sizes
        flats.append(unpack(row["flat"]))
        total += len(flats[-1])
    flat = np.concatenate(flats) if flats else np.zeros(0, np.uint32)
    for first, last, begin, end in spans(counts):
        picks = numbers[begin:end]
        coded = flat[gathered(start, length, picks)].astype("<u4")
        before = np.concatenate([[0], np.cumsum(length[picks])])
        cuts = before[np.concatenate([[0], np.cumsum(counts[first:last], dtype=np.int64)])]
        offsets = pa.py_buffer((cuts * 4).astype(np.int32))
        own = pa.Array.from_buffers(pa.binary(), last - first, [None, offsets, pa.py_buffer(coded)])
        yield pa.record_batch([pa.array(np.diff(cuts)), own], names=["n_tokens", "ids"])


def encode(
    docs: DataFrame, vocabulary: Vocabulary, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: (_row_id, doc_id, n_tokens, ids).

    `ids` holds the token ids as little-endian unsigned 32-bit numbers, as the
    tokenizer gives them without added special tokens, truncation or padding; special
    strings within a text give their ids.  NULL and empty texts have no ids.  An empty
    table gives an empty result; other columns are ignored.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary.text)
    texts = with_row_id(docs).select(
        ROW, F.col(text_column).cast("string").alias("_text"), F.col(id_column).cast("bigint").alias("doc_id")
    )
    blocks = word_blocks(texts, splitter(list(vocabulary.specials), shipped))
    coded = by_word(blocks.words.select("block", "bucket", "words", "at")).mapInArrow(
        lean(_encode_words(shipped)), "block bigint, at binary, sizes binary, flat binary"
    )
    schema = f"{ROW} bigint, doc_id bigint, n_tokens bigint, ids binary"
    return join_by_block(blocks, coded, _assemble, schema)


def decode(coded: DataFrame, vocabulary: Vocabulary, ids_column: str = "ids") -> DataFrame:
    """`coded` with a column `text` after its own: the pieces of the ids, joined.

    NULL ids give a NULL text.  Bytes that are no UTF-8 become replacement characters.
    """
    shipped = coded.sparkSession.sparkContext.broadcast(vocabulary.pieces())
    columns = [c for c in coded.columns if c != "text"]
    at = columns.index(ids_column)

    def run(batches):
        pieces = shipped.value
        for batch in text_batches(batches, at):
            texts = [
                None if ids is None
                else b"".join([pieces[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")
                for ids in batch.column(at).to_pylist()
            ]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], names=[*columns, "text"])

    source = coded.select(*columns)
    return source.mapInArrow(lean(run), T.StructType([*source.schema.fields, T.StructField("text", T.StringType())]))
