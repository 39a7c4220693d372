"""Quality rules: base counts, and the Jensen-Shannon distance to language references.

A language's reference has two histograms over all of its documents: classes of
characters, and its `COMMON` most widespread terms with one bin for all others.  A
document is as far from the languages as from the nearest of them, for each histogram.
It fails where a distance exceeds its limit, unless it is too short for that histogram
to say anything: a short clean text is far from every reference by chance.

Scale.  The references take one pass over the texts and one shuffle of per-task sums by
(language, term); of each language the widespread terms come to the driver, so at most
`COMMON` + 9 rows per language, and at most `MOST_LANGUAGES` of those.  The second pass
needs no shuffle.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import ship, text_batches
from .source_divergence import PENDING, TERM_BYTES

COMMON = 100
LEAST_DOCS = 30  # documents that a reference needs
MOST_LANGUAGES = 5_000
CLASS_LIMIT, LEAST_CHARS = 0.28, 200
WORD_LIMIT, LEAST_TERMS = 0.42, 120
LEAST_WORDS, MOST_REPEATED = 50, 50  # words; percent of words in repeated windows

WHITE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
MARKS = b".,;:!?'\"()-"
FOLLOWING = bytes(range(0x80, 0xC0))  # bytes that continue a character
LOWER, UPPER, DIGIT, SPACE, MARK, OTHER, BEYOND, NONE = range(8)
CLASSES = np.array(
    [
        LOWER if 97 <= b <= 122
        else UPPER if 65 <= b <= 90
        else DIGIT if 48 <= b <= 57
        else SPACE if b in WHITE
        else MARK if b in MARKS
        else OTHER if b < 0x80
        else NONE if b in FOLLOWING
        else BEYOND
        for b in range(256)
    ],
    np.uint8,
)

_TERM, _CLASS, _TOTAL = range(3)


class Reference(NamedTuple):
    lang: str
    classes: np.ndarray
    terms: list[bytes]
    counts: np.ndarray  # of `terms`, then of all others


def _classes(data: bytes) -> np.ndarray:
    return np.bincount(CLASSES[np.frombuffer(data, np.uint8)], minlength=8)[:NONE]


def _sums(batches):
    """(lang, kind, item, n_docs, n) of one task: its terms, classes of characters, totals."""

    def rows(terms, holders):
        for lang, own in terms.items():
            items = list(own)
            for at in range(0, len(items), 50_000):
                some = items[at : at + 50_000]
                yield batch_of(
                    [lang] * len(some), [_TERM] * len(some), [t.decode() for t in some],
                    [holders[lang][t] for t in some], [own[t] for t in some],
                )

    def batch_of(*columns):
        kinds = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        return pa.record_batch(list(map(pa.array, columns, kinds)), names=["lang", "kind", "item", "n_docs", "n"])

    terms, holders, pending = defaultdict(Counter), defaultdict(Counter), 0
    classes = defaultdict(lambda: np.zeros(NONE, np.int64))
    docs, total = Counter(), Counter()
    for batch in text_batches(batches, 1):
        for lang, data in zip(*(column.to_pylist() for column in batch.columns)):
            words = data.translate(TERM_BYTES).split()
            before = len(terms[lang])
            terms[lang].update(words)
            holders[lang].update(set(words))
            pending += len(terms[lang]) - before
            classes[lang] += _classes(data)
            docs[lang] += 1
            total[lang] += len(words)
            if pending > PENDING:
                yield from rows(terms, holders)
                terms, holders, pending = defaultdict(Counter), defaultdict(Counter), 0
    yield from rows(terms, holders)
    for lang, own in classes.items():
        yield batch_of(
            [lang] * (NONE + 1), [_CLASS] * NONE + [_TOTAL], [str(k) for k in range(NONE)] + ["terms"],
            [0] * NONE + [docs[lang]], [*own.tolist(), total[lang]],
        )


def references(
    docs: DataFrame,
    lang_column: str = "lang",
    text_column: str = "text",
    common: int = COMMON,
    least_docs: int = LEAST_DOCS,
) -> list[Reference]:
    """A reference per language that has at least `least_docs` documents.

    Common terms are those that most documents hold, ties by their bytes; they are counted
    by occurrence.  NULL language is a language of its own, ''; NULL text is empty.
    """
    ship(docs.sparkSession)
    cells = docs.select(_text(lang_column).alias("lang"), F.encode(_text(text_column), "UTF-8").alias("data"))
    sums = (
        cells.mapInArrow(_sums, "lang string, kind int, item string, n_docs bigint, n bigint")
        .groupBy("lang", "kind", "item")
        .agg(F.sum("n_docs").alias("n_docs"), F.sum("n").alias("n"))
    )
    place = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.col("n_docs").desc(), "item"))
    # Classes and totals are fewer than the terms that are kept.
    first = sums.withColumn("place", place).where(F.col("place") <= max(common, NONE))
    languages = docs.select(_text(lang_column).alias("lang")).groupBy("lang").count().where(F.col("count") >= least_docs)
    found = languages.count()
    if found > MOST_LANGUAGES:
        raise ValueError(f"{found} languages, more than {MOST_LANGUAGES}: is this a language column?")
    by_lang = defaultdict(list)
    for row in first.join(F.broadcast(languages.select("lang")), "lang", "left_semi").collect():
        by_lang[row.lang].append(row)
    made = []
    for lang in sorted(by_lang):
        rows = sorted(by_lang[lang], key=lambda r: (r.kind, r.place))
        terms = [r for r in rows if r.kind == _TERM][:common]
        classes = {int(r["item"]): r.n for r in rows if r.kind == _CLASS}
        total = next(r.n for r in rows if r.kind == _TOTAL)
        counts = [r.n for r in terms]
        made.append(
            Reference(
                lang,
                np.array([classes[k] for k in range(NONE)], np.float64),
                [r["item"].encode() for r in terms],
                np.array([*counts, total - sum(counts)], np.float64),
            )
        )
    return made


def _text(column: str):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def distances(own: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, so from 0 to 1) of histograms to the rows of `others`.

    `own` is one histogram or one per row.  Against an empty histogram it is 0.
    """
    p = own / np.maximum(own.sum(-1, keepdims=True), 1)
    q = others / np.maximum(others.sum(-1, keepdims=True), 1)
    p = np.broadcast_to(p, q.shape)
    middle = (p + q) / 2

    def divergence(x):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(x > 0, x * np.log2(x / middle), 0).sum(-1)

    full = (p.sum(-1) > 0) & (q.sum(-1) > 0)
    return np.where(full, np.sqrt(np.maximum(divergence(p) + divergence(q), 0) / 2), 0)


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words in windows of `width` words that the text holds twice or more."""
    if len(words) <= width:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    window, size = ids[: len(ids) - width + 1], len(seen)
    for k in range(1, width):
        window = window * size + ids[k : len(ids) - width + 1 + k]
        _, window = np.unique(window, return_inverse=True)
    marks = np.bincount(window)[window] > 1
    hit = np.zeros(len(words), bool)
    for k in range(width):
        hit[k : k + len(marks)] |= marks
    return int(hit.sum())


def base_counts(data: bytes) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a text's bytes."""
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words),
        len(data.translate(None, WHITE + FOLLOWING)),
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


class Nearest:
    """Distances of a document to the nearest of the references, by each histogram."""

    def __init__(self, known: list[Reference]):
        terms = {t for r in known for t in r.terms}
        self.place = {t: k for k, t in enumerate(sorted(terms))}
        self.classes = np.array([r.classes for r in known])
        width = max(len(r.terms) for r in known)
        # Each reference's terms among all terms; its unused bins point to a bin that stays 0.
        self.bins = np.full((len(known), width), len(terms))
        self.counts = np.zeros((len(known), width + 1))
        for k, r in enumerate(known):
            self.bins[k, : len(r.terms)] = [self.place[t] for t in r.terms]
            self.counts[k, : len(r.terms)] = r.counts[:-1]
            self.counts[k, -1] = r.counts[-1]

    def __call__(self, data: bytes) -> tuple[int, float, int, float]:
        """(characters, distance of classes, terms, distance of terms)."""
        classes = _classes(data)
        terms = data.translate(TERM_BYTES).split()
        held = [self.place[t] for t in terms if t in self.place]
        common = np.bincount(held, minlength=len(self.place) + 1)[self.bins] if held else np.zeros(self.bins.shape)
        own = np.concatenate([common, len(terms) - common.sum(1, keepdims=True)], axis=1)
        return (
            int(classes.sum()),
            float(distances(classes, self.classes).min()),
            len(terms),
            float(distances(own, self.counts).min()),
        )


_RESULT = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, class_distance double, word_distance double"
)


def judged(
    docs: DataFrame,
    known: list[Reference],
    id_column: str = "doc_id",
    text_column: str = "text",
    class_limit: float = CLASS_LIMIT,
    least_chars: int = LEAST_CHARS,
    word_limit: float = WORD_LIMIT,
    least_terms: int = LEAST_TERMS,
    least_words: int = LEAST_WORDS,
    most_repeated: int = MOST_REPEATED,
) -> DataFrame:
    """One row per document: base counts, base_failed, kept and the two distances.

    The base fails texts of fewer than `least_words` words, or with over `most_repeated`
    percent of them in three-word windows that the text repeats.  Of the others those go
    whose classes of characters (of `least_chars` characters or more) or terms (of
    `least_terms` or more) are farther from every reference than the limits.  Without
    references only the base judges, and the distances are NULL.  NULL text has no words;
    repeated rows are judged alike; other columns are ignored.
    """
    ship(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        nearest = Nearest(shipped.value) if shipped.value else None
        for batch in text_batches(batches, 1):
            out = []
            for data in batch.column(1).to_pylist():
                counts = base_counts(data)
                failed = counts[0] < least_words or 100 * counts[-1] > most_repeated * counts[0]
                if nearest:
                    chars, of_classes, terms, of_terms = nearest(data)
                    far = (chars >= least_chars and of_classes > class_limit) or (
                        terms >= least_terms and of_terms > word_limit
                    )
                    out.append((*counts, failed, not failed and not far, of_classes, of_terms))
                else:
                    out.append((*counts, failed, not failed, None, None))
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            yield pa.record_batch([batch.column(0), *columns], names=[c.split()[0] for c in _RESULT.split(", ")])

    cells = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.encode(_text(text_column), "UTF-8").alias("data")
    )
    return cells.mapInArrow(run, _RESULT)
