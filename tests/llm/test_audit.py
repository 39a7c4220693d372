"""Source divergence, cross-tokenizer alignment and quality rules against brute force."""

import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from basketry.llm import quality_divergence, source_divergence, token_alignment

SCHEMA = "doc_id bigint, text string, lang string, source string, term string, block int, total string"


def some_docs(spark, rows):
    return spark.createDataFrame([(*row, "t", 1, "x") for row in rows], SCHEMA)


# Source divergence


def brute_divergence(rows, least, ranks):
    def terms(text):
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in found]

    held, counts = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        own = terms(text)
        held[lang or ""].update(set(own))
        counts[lang or "", source or ""].update(own)
    out = set()
    for lang in held:
        kept = {t for t, n in held[lang].items() if n >= least}
        groups = {s: c for (g, s), c in counts.items() if g == lang}
        everyone = sum(groups.values(), Counter())

        def share(own):
            total = sum(own[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (own[t] + 5) // total for t in kept}

        of = {s: share(c) for s, c in groups.items()}
        q = share(everyone)
        for s, own in groups.items():
            parts = {
                "pair": [(-sum(abs(of[s][t] - of[o][t]) for t in kept), o) for o in groups if o != s],
                "term": [(q[t] - of[s][t], t) for t in kept if own[t] > 0 and of[s][t] > q[t]],
            }
            for part, found in parts.items():
                found.sort(key=lambda x: (x[0], x[1].encode()))
                for rank, (value, item) in enumerate(found[: ranks if part == "term" else None], 1):
                    out.add((lang, s, part, item, -value, rank))
    return out


@pytest.mark.parametrize("entries, pairs", [(1 << 18, 4096), (40, 3), (1, 1)])
def test_divergence_against_brute_force(spark, entries, pairs):
    rng = np.random.default_rng(4)
    words = ["a", "B", "ça", "Ça", "d1e", "née", "x_y", "z", "Q", "r", "s", "t"] + [f"w{chr(97 + k)}" for k in range(14)]
    rows = []
    for k in range(260):
        lang = [None, "", "en", "en", "en", "fr"][k % 6]
        source = [None, "s1", "s2", "s3", "é", "s1"][int(rng.integers(6))]
        picked = rng.choice(words, size=int(rng.integers(0, 25)), p=np.arange(26, 0, -1) / 351)
        rows.append((k, None if k % 41 == 0 else " ".join(picked), lang, source))
    rows += [(1, "lone words", "xx", "only"), (1, "lone words", "xx", "other"), (2, None, "yy", "only")]
    found = source_divergence.divergence(some_docs(spark, rows), least_docs=9, ranks=3, entries=entries, pairs=pairs)
    result = [tuple(r) for r in found.select("lang", "source", "part", "item", "value", "rank").collect()]
    expected = brute_divergence(rows, 9, 3)
    assert len(result) == len(expected) and set(result) == expected


def test_divergence_of_no_documents(spark, no_docs, odd_docs):
    assert source_divergence.divergence(no_docs).count() == 0
    assert {(r.part, r.value) for r in source_divergence.divergence(odd_docs).collect()} == set()


def test_trees_share_nodes_and_price_pairs_once():
    counts = np.zeros((3, 1 << 12), np.int64)
    counts[0, 5] = counts[1, 77] = 3
    forest = source_divergence.Forest(counts)
    assert sum(len(first) for first, _ in forest.levels) <= 3 * 12
    (left, right), steps = forest.meet(0, 1)
    assert len(left) <= 3 and all(len(first) <= 4 for first, _ in steps)
    price = np.abs(forest.leaves[left] - forest.leaves[right])
    assert source_divergence.added_up(price, steps) == 6
    at, value = source_divergence.largest(price, steps, 1)
    assert sorted(zip(at.tolist(), value.tolist())) == [(5, 3), (77, 3)]


def test_shares_are_exact():
    totals = [10**6, 7 * 10**14, 8 * 10**15]
    for total in totals:
        counts = np.array([-1, 0, 1, 999, total // 3, total], np.int64)
        expected = [0 if c < 0 else 1 + 10**9 * (c + 5) // (total + 5 * 17) for c in counts.tolist()]
        assert source_divergence.shares(counts, total, 17, 5, 9).tolist() == expected


# Cross-tokenizer alignment


def brute_alignment(texts, pieces):
    import hashlib

    own = token_alignment.aligner(pieces)
    links, groups, sizes = [], [], []
    for text in texts:
        data = (" " + (text or "")).encode()
        a = own.a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = own.b.encode(text) if text else []
        if b"".join(own.bytes_a[i] for i in a) != data or b"".join(own.bytes_b[i] for i in b) != data:
            a, b = [], []
        ends = [np.cumsum([len(of[i]) for i in ids]).tolist() for of, ids in ((own.bytes_a, a), (own.bytes_b, b))]
        common = sorted(set(ends[0]) & set(ends[1]))
        at = [np.searchsorted(end, common).tolist() for end in ends]
        links.append([(a[i], b[j]) for i, j in zip(*at)])
        cuts = zip([0] + [i + 1 for i in at[0]], [i + 1 for i in at[0]], [0] + [j + 1 for j in at[1]], [j + 1 for j in at[1]])
        groups.append(";".join(",".join(map(str, a[i:j])) + "|" + ",".join(map(str, b[k:n])) for i, j, k, n in cuts))
        sizes.append((len(a), len(b)))
    count = Counter(pair for own in links for pair in own)
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return [
        (*size, len(own), len(own), sum(count[p] == best[p[1]] for p in own), sum(count[p] for p in own),
         hashlib.sha256(group.encode()).hexdigest() if size[0] else "")
        for size, own, group in zip(sizes, links, groups)
    ]


@pytest.fixture(scope="module")
def pieces():
    return token_alignment.Pieces.read(
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    )


def test_alignment_against_brute_force(spark, pieces, odd_docs):
    odd = [(r.doc_id, r.text) for r in odd_docs.collect()]
    more = [
        "  two  spaces  ", "tabs\t and\n lines \n\n end\n", "a▁b", "<s> <0x41> <|endoftext|> </s>", "　 x  y",
        "it's 12345 o'clock  z", "\x00 \x1c \x85 q", "\U0001f600 \U0001f468‍\U0001f469 é e", " ", "\n", "﻿ bom",
    ]
    sample = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    rows = odd + [(100 + k, t) for k, t in enumerate(more)] + sample
    docs = some_docs(spark, [(i, t, None, None) for i, t in rows]).repartition(5)
    found = token_alignment.aligned(docs, pieces, digest=True).collect()
    expected = [(i, *own) for (i, _), own in zip(rows, brute_alignment([t for _, t in rows], pieces))]
    assert Counter(map(tuple, found)) == Counter(expected)
    spelt = token_alignment.aligned(docs.where("doc_id = 102"), pieces).first()
    assert spelt.groups == "" and spelt.n_a == 0


def test_chunks_spell_the_text_and_batches_change_nothing(spark, pieces):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    own = token_alignment.aligner(pieces)
    assert own.chunked
    for row in docs.limit(50).collect():
        assert "".join(own.chunks(row.text or "")) == " " + (row.text or "")
    narrow = token_alignment.aligned(docs.repartition(40), pieces, batch_bytes=5_000)
    assert Counter(narrow.collect()) == Counter(token_alignment.aligned(docs, pieces).collect())


def test_alignment_of_no_documents(spark, pieces, no_docs):
    assert token_alignment.aligned(no_docs, pieces).count() == 0


def test_perfect_hash_numbers_keys_without_gaps():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 47, 20_000))
    made = token_alignment.PerfectHash.of(keys)
    assert sorted(made.numbers(keys).tolist()) == list(range(len(keys)))
    assert len(made.bits) < len(keys)  # fewer than eight bits a key
    hashes, parts = [], []
    for s in range(token_alignment.SHARDS):
        some = keys[token_alignment.shard_of(keys) == s]
        made = token_alignment.PerfectHash.of(some)
        placed = np.empty_like(some)
        placed[made.numbers(some)] = some
        hashes.append((made.sizes, made.bits))
        parts.append(placed.tobytes())
    table = token_alignment.PairTable(hashes, parts)
    assert (table.keys[table.numbers(keys)] == keys).all()
    with pytest.raises(ValueError):
        table.numbers(np.array([keys[0] + 1, 3], np.int64))


# Quality rules


def brute_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = {k + j for k, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit),
    )


def test_base_counts_against_brute_force():
    rng = np.random.default_rng(7)
    cases = ["", " \n\t", "a", "a a", "a a a", "a a a a", "x\ny\nx\n\n \n x\n", "é b c é b c é", "# * | <b> $5 100%"]
    cases += [" ".join(rng.choice(list("abc\n"), size=int(rng.integers(1, 60)))) for _ in range(200)]
    cases += ["one two three " * 5000, "  no break \x1c", "\U0001f600 " * 9]
    for text in cases:
        assert quality_divergence.base_counts(text.encode()) == brute_base(text), text[:80]


def test_distances():
    own = np.array([1.0, 1, 0])
    assert quality_divergence.distances(own, np.array([[5.0, 5, 0], [0, 0, 3], [0, 0, 0]])).tolist() == [0, 1, 0]
    p, q = np.array([0.5, 0.25, 0.25]), np.array([0.1, 0.1, 0.8])
    m = (p + q) / 2
    expected = ((p * np.log2(p / m) + q * np.log2(q / m)).sum() / 2) ** 0.5
    assert abs(quality_divergence.distances(p * 8, q[None] * 10)[0] - expected) < 1e-9


def test_rules_tell_junk_from_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = quality_divergence.judged(docs, quality_divergence.references(docs)).where("n_words >= 50")
    rows = found.join(labels, "doc_id").select("quality", "kept").collect()
    good = [r.kept for r in rows if r.quality == 1]
    junk = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.97 * len(good) and sum(junk) <= 0.5 * len(junk)


def test_rules_on_odd_documents(spark, odd_docs, no_docs):
    text = "the cat and the dog of a house in the town that is on the hill and it was for all of us to see. "
    clean = [(k, f"{text * 2}number{k} stays {k} " + " ".join(f"w{j}x{k}" for j in range(70)), "en", None) for k in range(40)]
    known = quality_divergence.references(some_docs(spark, clean))
    assert [r.lang for r in known] == ["en"] and known[0].terms[:2] == [b"a", b"all"]
    found = {r.doc_id: r for r in quality_divergence.judged(some_docs(spark, clean), known).collect()}
    assert all(r.kept and not r.base_failed for r in found.values())
    shouted = some_docs(spark, [(k, t.upper().replace(" ", "!! "), n, s) for k, t, n, s in clean])
    judged = quality_divergence.judged(shouted, known).collect()
    assert not any(r.kept for r in judged) and not any(r.base_failed for r in judged)
    rows = quality_divergence.judged(odd_docs, known).collect()
    texts = Counter((r.doc_id, brute_base(r.text or "")) for r in odd_docs.collect())
    assert Counter((r.doc_id, tuple(r)[1:6]) for r in rows) == texts
    assert all(r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words) for r in rows)
    assert not any(r.kept and r.base_failed for r in rows)
    # Too few documents for any reference: the base alone judges.
    assert quality_divergence.references(odd_docs) == quality_divergence.references(no_docs) == []
    rows = quality_divergence.judged(odd_docs, []).collect()
    assert all(r.kept != r.base_failed and r.class_distance is None for r in rows)
    assert quality_divergence.judged(no_docs, known).count() == 0
