"""Language identification with a linear-chain conditional random field.

Each word of a text is a state: which language it is in.  A word's score in a language
comes from its character n-grams, those at its ends (affixes) among them, the word
itself, and a lexicon of how often the word was met per language.  Learned transitions
tie neighbours together.  Forward-backward gives every word's probabilities; words label
runs of a code-switched text, and their mean labels the text.

The model is fitted on a bounded sample: at most `DOCS_PER_LANGUAGE` labelled texts of
each language, chosen by a hash of their ids, and `WORDS_PER_DOC` consecutive words of each.
Sequences to learn from are spliced from runs of different texts, so that transitions
between languages are seen.  All texts are labelled, whole, without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ROW, lean, stored, text_batches, with_row_id
from .graph import join_few

DOCS_PER_LANGUAGE = 500
WORDS_PER_DOC = 60
FEATURE_BITS = 17
SEQUENCE = 40
RUN = 12
SWITCH = 0.5  # chance that the next run is in another language
EPOCHS = 4
RATE = 0.3
BATCH_SEQUENCES = 32
CACHED_WORDS = 100_000
BATCH_BYTES = 2 << 20
CELLS = 200_000

WORD = re.compile(r"[^\W\d_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, the word each belongs to), in the words' order."""
    joined = "".join(f"^{w}$" for w in words)
    points = np.frombuffer(joined.encode("utf-32-le"), "<u4").astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    found, whose = [], []
    gram = points
    for length in (2, 3, 4):
        gram = (gram[:-1] if length > 1 else gram) * np.uint64(0x100000001B3) + points[length - 1 :]
        inside = owner[: len(gram)] == owner[length - 1 :]
        found.append((gram * _MIX + np.uint64(length * int(_MIX) % (1 << 64)))[inside])
        whose.append(owner[: len(gram)][inside])
    start = np.cumsum(sizes) - sizes
    power = np.arange(len(points), dtype=np.uint64) - start[owner].astype(np.uint64)
    whole = np.add.reduceat(_spread(points + (power << np.uint64(32))), start) if len(words) else points[:0]
    found.append(whole * _MIX)
    whose.append(np.arange(len(words)))
    numbers, whose = np.concatenate(found), np.concatenate(whose)
    order = np.argsort(whose, kind="stable")
    return (_spread(numbers[order]) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64), whose[order]


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) * _MIX


class Field:
    """The random field: weights of features and the lexicon, starts and transitions."""

    def __init__(self, languages: list[str], lexicon: dict[str, np.ndarray]):
        k = len(languages)
        self.languages = languages
        self.lexicon = lexicon
        self.weights = np.zeros((1 << FEATURE_BITS, k))
        self.trust = np.full(k, 0.3)
        self.start = np.zeros(k)
        self.steps = np.eye(k)

    def emissions(self, words: list[str]) -> np.ndarray:
        """Each word's score in each language."""
        if not words:
            return np.zeros((0, len(self.languages)))
        number, owner = features(words)
        count = np.bincount(owner, minlength=len(words))
        total = np.add.reduceat(self.weights[number], np.cumsum(count) - count, axis=0)
        none = np.zeros(len(self.languages))
        met = np.array([self.lexicon.get(w, none) for w in words])
        return total / np.sqrt(count)[:, None] + met * self.trust

    def marginals(self, scores: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probabilities of each place's language, expected transitions) of padded sequences."""
        batch, steps, k = scores.shape
        chance = np.exp(scores - scores.max(axis=2, keepdims=True))
        move = np.exp(self.steps - self.steps.max())
        ahead = np.empty_like(chance)
        state = chance[:, 0] * np.exp(self.start - self.start.max())
        ahead[:, 0] = state = state / state.sum(axis=1, keepdims=True)
        for t in range(1, steps):
            state = (state @ move) * chance[:, t]
            state /= state.sum(axis=1, keepdims=True)
            ahead[:, t] = state
        pairs = np.zeros((k, k))
        behind = np.ones((batch, k))
        both = np.empty_like(chance)
        for t in range(steps - 1, -1, -1):
            last = (t >= length - 1)[:, None]
            if t < steps - 1:
                onward = chance[:, t + 1] * behind
                joint = ahead[:, t, :, None] * move * onward[:, None, :]
                joint /= joint.sum(axis=(1, 2), keepdims=True)
                pairs += joint[~last[:, 0]].sum(axis=0)
                behind = onward @ move.T
                behind /= behind.sum(axis=1, keepdims=True)
            behind = np.where(last, 1.0, behind)
            both[:, t] = ahead[:, t] * behind
        return both / both.sum(axis=2, keepdims=True), pairs

    def probabilities(self, scores: np.ndarray, move: np.ndarray, length: np.ndarray) -> np.ndarray:
        """As `marginals`, without transitions; `scores` are exponentials."""
        ahead = np.empty_like(scores)
        state = scores[:, 0] * np.exp(self.start - self.start.max())
        ahead[:, 0] = state = state / state.sum(axis=1, keepdims=True)
        steps = scores.shape[1]
        for t in range(1, steps):
            state = (state @ move) * scores[:, t]
            state /= state.sum(axis=1, keepdims=True)
            ahead[:, t] = state
        behind = np.ones_like(state)
        for t in range(steps - 2, -1, -1):
            behind = (scores[:, t + 1] * behind) @ move.T
            behind /= behind.sum(axis=1, keepdims=True)
            if length[-1] <= t + 1:  # shortest last
                behind[length <= t + 1] = 1.0
            ahead[:, t] *= behind
        return ahead / ahead.sum(axis=2, keepdims=True)

    def fit(self, sequences: list[tuple[list[str], list[int]]], seed: int = 3) -> None:
        """Maximum likelihood by stochastic gradient steps, scaled by past gradients."""
        words = sorted({w for s, _ in sequences for w in s})
        index = {w: i for i, w in enumerate(words)}
        number, owner = features(words)
        count = np.bincount(owner, minlength=len(words))
        first = np.cumsum(count) - count
        past = np.full(self.weights.shape, 1e-2)
        rng = np.random.default_rng(seed)
        known = np.array([self.lexicon.get(w, np.zeros(len(self.languages))) for w in words])
        for _ in range(EPOCHS):
            for at in range(0, len(sequences), BATCH_SEQUENCES):
                picked = [sequences[i] for i in rng.permutation(len(sequences))[:BATCH_SEQUENCES]]
                length = np.array([len(s) for s, _ in picked])
                ids = np.zeros((len(picked), length.max()), np.int64)
                gold = np.full(ids.shape, -1)
                for row, (s, labels) in enumerate(picked):
                    ids[row, : len(s)] = [index[w] for w in s]
                    gold[row, : len(s)] = labels
                used, where = np.unique(ids, return_inverse=True)
                own = np.concatenate([number[first[u] : first[u] + count[u]] for u in used])
                size = count[used]
                emitted = np.add.reduceat(self.weights[own], np.cumsum(size) - size, axis=0)
                emitted = emitted / np.sqrt(size)[:, None] + known[used] * self.trust
                chance, pairs = self.marginals(emitted[where.reshape(ids.shape)], length)
                real = gold >= 0
                error = -chance * real[:, :, None]
                error[np.nonzero(real) + (gold[real],)] += 1
                gradient = np.zeros_like(emitted)
                np.add.at(gradient, where.reshape(ids.shape), error)
                self.trust += 0.002 * (gradient * known[used]).sum(axis=0) / len(picked)
                change = np.zeros_like(self.weights)
                np.add.at(change, own, np.repeat(gradient / np.sqrt(size)[:, None], size, axis=0))
                rows = np.unique(own)
                past[rows] += change[rows] ** 2
                self.weights[rows] += RATE * change[rows] / np.sqrt(past[rows])
                seen = np.zeros_like(self.steps)
                follow = real[:, 1:]
                np.add.at(seen, (gold[:, :-1][follow], gold[:, 1:][follow]), 1)
                self.steps += 0.1 * (seen - pairs) / real.sum() * len(self.languages)
                self.start += 0.1 * error[:, 0].mean(axis=0)


def spliced(texts: list[tuple[str, list[str]]], languages: list[str], seed: int = 5) -> list[tuple[list[str], list[int]]]:
    """Sequences of runs taken from texts of changing languages, using all their words."""
    rng = np.random.default_rng(seed)
    runs: dict[int, list[list[str]]] = {k: [] for k in range(len(languages))}
    for language, words in texts:
        for at in range(0, len(words), RUN):
            runs[languages.index(language)].append(words[at : at + RUN])
    for own in runs.values():
        rng.shuffle(own)
    sequences, now = [], 0
    while any(runs.values()):
        words, labels = [], []
        while len(words) < SEQUENCE and any(runs.values()):
            if not runs[now] or rng.random() < SWITCH:
                now = int(rng.choice([k for k, own in runs.items() if own]))
            run = runs[now].pop()
            words += run
            labels += [now] * len(run)
        sequences.append((words, labels))
    return sequences


def held_out(id_column: str, folds: int = 4, fold: int = 2):
    """Whether crc32(id as text) has the remainder; a NULL id counts as the empty text."""
    text = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % folds == fold


def fitted(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    docs_per_language: int = DOCS_PER_LANGUAGE,
    words_per_doc: int = WORDS_PER_DOC,
) -> Field | None:
    """The field learned from the labelled documents that are not held out; None without any."""
    labelled = with_row_id(docs).where(
        ~held_out(id_column) & F.col(lang_column).isNotNull() & F.col(text_column).isNotNull()
    ).select(
        ROW, F.col(lang_column).cast("string").alias("_lang"), F.col(text_column).cast("string").alias("_text"),
        (F.pmod(F.xxhash64(F.col(id_column).cast("string"), F.lit(17)), F.lit(1 << 40)) / float(1 << 40)).alias("_draw"),
    )
    counts = labelled.groupBy("_lang").count()
    share = stored(counts.select("_lang", (2.0 * docs_per_language / F.col("count")).alias("_share")))

    def sample(batches):
        for batch in batches:
            out = []
            for language, text, draw in zip(*(batch.column(k).to_pylist() for k in range(3))):
                words = words_of(text)
                at = int(draw * 1e9) % max(1, len(words) - words_per_doc + 1)
                out.append((language, draw, [w[:64] for w in words[at : at + words_per_doc]]))
            yield pa.record_batch(
                [pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), pa.float64(), pa.list_(pa.string())))],
                names=["lang", "draw", "words"],
            )

    rows = (
        join_few(labelled, share, "_lang").where("_draw < _share").select("_lang", "_text", "_draw")
        .mapInArrow(sample, "lang string, draw double, words array<string>")
        .where("size(words) > 0").collect()
    )
    texts: dict[str, list[list[str]]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["draw"], r["words"])):
        texts.setdefault(row["lang"], []).append(row["words"])
    languages = sorted(texts)
    if not languages:
        return None
    chosen = [(g, words) for g in languages for words in texts[g][:docs_per_language]]
    counted: dict[str, np.ndarray] = {}
    for language, words in chosen:
        for word in words:
            counted.setdefault(word, np.zeros(len(languages)))[languages.index(language)] += 1
    lexicon = {
        w: np.log((c + 0.1) / (c + 0.1).sum() * len(languages)) for w, c in counted.items() if c.sum() > 1
    }
    field = Field(languages, lexicon)
    field.fit(spliced(chosen, languages))
    return field


class _Labeller:
    def __init__(self, field: Field):
        self.field = field
        self.move = np.exp(field.steps - field.steps.max())
        self.known: dict[str, int] = {}
        self.table = np.zeros((0, len(field.languages)), np.float32)

    def ids(self, texts: list[list[str]]) -> list[np.ndarray]:
        if len(self.known) > CACHED_WORDS:
            self.known, self.table = {}, self.table[:0]
        size = len(self.known)
        own = [
            np.fromiter((self.known.setdefault(w, len(self.known)) for w in words), np.int64, len(words))
            for words in texts
        ]
        new = list(self.known)[size:]
        parts = [self.table]
        for at in range(0, len(new), 20_000):
            scores = self.field.emissions(new[at : at + 20_000])
            parts.append(np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float32))
        self.table = np.concatenate(parts)
        return own

    def label(self, texts: list[list[str]]) -> list[np.ndarray | None]:
        """Each text's word probabilities; None for a text without words."""
        ids = self.ids(texts)
        out: list[np.ndarray | None] = [None] * len(texts)
        order = sorted((i for i in range(len(texts)) if len(ids[i])), key=lambda i: -len(ids[i]))
        at = 0
        while at < len(order):
            longest = len(ids[order[at]])
            group = order[at : at + max(1, CELLS // longest)]
            group = [i for i in group if len(ids[i]) * 2 > longest or len(ids[i]) > longest - 64]
            length = np.array([len(ids[i]) for i in group])
            padded = np.zeros((len(group), longest), np.int64)
            for row, i in enumerate(group):
                padded[row, : length[row]] = ids[i]
            chance = self.field.probabilities(self.table[padded], self.move, length)
            for row, i in enumerate(group):
                out[i] = chance[row, : length[row]]
            at += len(group)
        return out


_RUNS = "array<struct<lang:string,start:bigint,end:bigint>>"


def _runs(text: str, best: np.ndarray, languages: list[str]) -> list[dict]:
    spans = [m.span() for m in WORD.finditer(text)]
    if len(spans) != len(best):  # lower-casing changed the number of words
        return []
    cuts = [0, *(np.flatnonzero(np.diff(best)) + 1).tolist(), len(best)]
    return [
        {"lang": languages[best[a]], "start": spans[a][0], "end": spans[b - 1][1]}
        for a, b in zip(cuts, cuts[1:])
    ]


def identified(
    docs: DataFrame,
    field: Field | None,
    id_column: str = "doc_id",
    text_column: str = "text",
    runs: bool = False,
) -> DataFrame:
    """One row per document: (_row_id, doc_id, lang_pred, score, n_words, n_switches, runs, confidence).

    `lang_pred` has the largest mean probability over the text's words, which is `score`
    (ties: the first in alphabetical order).  Without a letter, with a NULL text or without
    a field it is `und` with score 0.  `confidence` is the mean probability of the words'
    own labels, which is high in a text that switches between known languages.  `runs` are the stretches of one language by character
    positions, NULL unless asked for.  An empty table gives an empty result; other columns
    are ignored.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(field)
    rows = with_row_id(docs).select(
        ROW, F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("_text")
    )
    ids = rows.schema["doc_id"].dataType.simpleString()

    def run(batches) -> Iterator[pa.RecordBatch]:
        field = shipped.value
        labeller = _Labeller(field) if field else None
        for batch in text_batches(batches, 2, BATCH_BYTES):
            texts = batch.column(2).to_pylist()
            words = [words_of(t) for t in texts]
            label, score, switches, spans, sure = [], [], [], [], []
            for text, chance in zip(texts, labeller.label(words) if labeller else [None] * len(texts)):
                if chance is None:
                    label.append("und")
                    score.append(0.0)
                    switches.append(0)
                    spans.append([] if runs else None)
                    sure.append(0.0)
                    continue
                mean = chance.mean(axis=0, dtype=np.float64)
                best = chance.argmax(axis=1)
                label.append(field.languages[int(mean.argmax())])
                score.append(min(1.0, float(mean.max())))
                sure.append(min(1.0, float(chance.max(axis=1).mean(dtype=np.float64))))
                switches.append(int(np.count_nonzero(np.diff(best))))
                spans.append(_runs(text, best, field.languages) if runs else None)
            kind = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.record_batch(
                [
                    batch.column(0), batch.column(1), pa.array(label, pa.string()), pa.array(score, pa.float64()),
                    pa.array([len(w) for w in words], pa.int64()), pa.array(switches, pa.int64()), pa.array(spans, kind),
                    pa.array(sure, pa.float64()),
                ],
                names=[ROW, "doc_id", "lang_pred", "score", "n_words", "n_switches", "runs", "confidence"],
            )

    schema = (
        f"{ROW} bigint, doc_id {ids}, lang_pred string, score double, n_words bigint, "
        f"n_switches bigint, runs {_RUNS}, confidence double"
    )
    return rows.mapInArrow(lean(run), schema)
