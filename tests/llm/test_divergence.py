"""Divergence of sources against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from spendcast.llm import divergence
from tests.llm.frames import LOWER

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
SCHEMA = "text string, lang string, source string, term string, shard long, n string, count int"


def frame(spark, rows, partitions=5):
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA).repartition(partitions)


def expected(rows):
    terms = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER))) for text, lang, source in rows]
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, found in terms:
        docs[lang].update(set(found))
        counts[lang, source].update(found)
    out = {}
    for lang in {g[0] for g in counts}:
        kept = [t for t, n in docs[lang].items() if n >= 3]
        own = {s: counts[lang, s] for x, s in counts if x == lang}

        def chances(c):
            size = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // size for t in kept}

        p = {s: chances(c) for s, c in own.items()}
        q = chances(sum(own.values(), Counter()))
        f = lambda a, b: (a - b) ** 2 // b
        for s in own:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in own if o != s]
            best = [(-f(p[s][t], q[t]), t.encode()) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", sorted(best)[:200])):
                for rank, (value, item) in enumerate(sorted(items), 1):
                    out[lang, s, part, item.decode()] = (-value, rank)
    return out


def corpus(n=260):
    rng = random.Random(11)
    lexicon = ["".join(rng.choice("abcDEéß日") for _ in range(rng.randint(1, 4))) for _ in range(700)]
    rows = []
    for i in range(n):
        words = [lexicon[min(int(rng.expovariate(0.02)), 699)] for _ in range(rng.randint(0, 120))]
        lang = rng.choice(["en", "en", "fr", None, ""])
        source = "hot" if i % 3 == 0 else rng.choice(["a", "B", "é", None, f"s{i % 7}"])
        rows.append((rng.choice([" ", "1", "\n- ", "_"]).join(words), lang, source))
    rows += [(None, "en", "silent"), ("", "xx", "only"), ("rare words", "yy", "a"), ("other", "yy", "b"), ("same same", "zz", "a")]
    return rows + [("again and again", "dd", s) for s in "ppq"] * 2


def found(df):
    return {(r.lang, r.source, r.part, r["item"]): (r.value, r["rank"]) for r in df.collect()}


@pytest.mark.parametrize("cells", [divergence.SHARD_CELLS, 150])
def test_divergences(spark, monkeypatch, cells):
    monkeypatch.setattr(divergence, "SHARD_CELLS", cells)
    rows = corpus()
    df = divergence.divergences(frame(spark, rows))
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    got = df.collect()
    assert {(r.lang, r.source, r.part, r["item"]): (r.value, r["rank"]) for r in got} == expected(rows)
    assert len(got) == len(expected(rows))


def test_divergences_of_nothing(spark):
    assert divergence.divergences(frame(spark, [])).count() == 0
    assert found(divergence.divergences(frame(spark, [(None, None, None)]))) == {}


def test_long_text_is_cut_between_terms(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 7)
    text = b"One two,three  FOUR5five " * 40 + b"x" * 100
    parts = list(divergence.text_terms(text))
    assert len(parts) > 50
    assert sum(parts, []) == [t.encode() for t in TERM.findall(text.decode().lower())]


def test_pairs_in_small_blocks(monkeypatch):
    rng = np.random.default_rng(4)
    counts = rng.integers(0, 4, (3, 100))
    size = counts.sum(1) + 100
    p = np.stack([divergence.probabilities(c, np.full(100, s)) for c, s in zip(counts, size)])
    word, group, level, bits = [], [], [], []
    for g in range(3):
        for w in range(2):
            for c in range(4):
                members = [t for t in range(w * 64, min(w * 64 + 64, 100)) if counts[g, t] == c]
                if members:
                    word.append(w)
                    group.append(g)
                    level.append(p[g, members[0]])
                    bits.append(sum(1 << (t % 64) for t in members))
    monkeypatch.setattr(divergence, "EXPANDED", 3)
    got = divergence.pair_values(np.array(word), np.array(group), np.array(level), np.array(bits, np.uint64), 3)
    for a in range(3):
        for b in range(3):
            assert got[a, b] == (0 if a == b else sum((x - y) ** 2 // y for x, y in zip(p[a].tolist(), p[b].tolist())))


def test_probabilities_beyond_64_bits():
    count = np.array([0, 10**10, 2 * 10**10])
    size = np.full(3, 3 * 10**10)
    assert divergence.probabilities(count, size).tolist() == [1 + 10**9 * (c + 1) // (3 * 10**10) for c in count.tolist()]
