"""Operators on repeats against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from spendcast.llm import near_dup, substring_dedup, suffix_dedup
from spendcast.llm.components import components
from tests.llm.frames import LOWER, corpus, documents, table, words

ROWS = corpus()


def sha(data):
    return hashlib.sha256(data).hexdigest()


def cut_bytes(texts, length):
    """Expected (n_bytes, n_removed, n_spans, digest) per text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[j : j + length] for b in data for j in range(len(b) - length + 1))
    out = []
    for b in data:
        keep = np.ones(len(b) + 1, bool)
        for j in range(len(b) - length + 1):
            if seen[b[j : j + length]] > 1:
                keep[j : j + length] = False
        keep[-1] = True
        left = np.frombuffer(b, np.uint8)[keep[:-1]].tobytes()
        out.append((len(b), len(b) - len(left), int((~keep[:-1] & keep[1:]).sum()), sha(left)))
    return out


@pytest.mark.parametrize("length, part, shard", [(400, 48, 2 << 20), (60, 12, 2 << 20), (60, 12, 500)])
def test_suffix_dedup(spark, length, part, shard):
    got = table(suffix_dedup.remove_strings(documents(spark, ROWS), length, part, shard))
    for row, want in zip(ROWS, cut_bytes([r[1] for r in ROWS], length)):
        g = got[row[0]]
        assert (g["n_bytes"], g["n_removed"], g["n_spans"], g["kept_sha256"]) == want
        assert sha(bytes(g["kept"])) == want[3]


def test_suffix_dedup_repeated_rows_and_empty_table(spark):
    long, short = "ab" * 300, "xyz"
    rows = [(1, long), (1, long), (2, short), (2, short), (None, None), (None, "z" * 401)]
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in suffix_dedup.remove_strings(documents(spark, rows)).collect())
    assert got == [(0, 0, 0), (0, 401, 401), (1, 600, 600), (1, 600, 600), (2, 3, 0), (2, 3, 0)]
    assert suffix_dedup.remove_strings(documents(spark, [])).count() == 0


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(0)
    text = rng.integers(97, 99, 300).astype(np.uint8)
    order, head = suffix_dedup.suffix_array(text)
    data = text.tobytes()
    assert order.tolist() == sorted(range(300), key=lambda i: data[i:])
    got = suffix_dedup.common_prefixes(text, order, head, np.array([0, 80]), np.array([80, 220]), 30)
    for a, b in zip(order[:-1], order[1:]):
        n = 0
        while n < 30 and max(a, b) + n < 300 and text[a + n] == text[b + n]:
            n += 1
        assert got[b] == n


def test_substring_dedup(spark):
    got = table(substring_dedup.remove_repeats(documents(spark, ROWS)))
    seen = set()
    for doc_id, text, *_ in ROWS:
        w = words(text)
        keep = [True] * len(w)
        for j in range(len(w) - 19):
            key = tuple(w[j : j + 20])
            if key in seen:
                keep[j : j + 20] = [False] * 20
            seen.add(key)
        left = " ".join(x for x, k in zip(w, keep) if k)
        g = got[doc_id]
        assert (g["n_words"], g["n_removed"], g["kept"], g["kept_sha256"]) == (len(w), keep.count(False), left, sha(left.encode()))


def test_substring_dedup_edge_rows(spark):
    passage = " ".join(f"w{i}" for i in range(25))
    rows = [(2, passage), (2, passage), (None, passage), (3, None), (4, "short")]
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(documents(spark, rows)).collect())
    assert got == [(-1, 25, 0), (2, 25, 25), (2, 25, 25), (3, 0, 0), (4, 1, 0)]
    assert substring_dedup.remove_repeats(documents(spark, [])).count() == 0


def near_groups(rows, how):
    sets = {}
    for doc_id, text, *_ in rows:
        w = words((text or "").translate(LOWER))
        k = how.words
        sets[doc_id] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= how.percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def chain(n, step):
    """Texts that each overlap the next one, so links run through the group."""
    return [(100 + i, " ".join(f"W{j}" for j in range(i * step, i * step + 100))) for i in range(n)]


@pytest.mark.parametrize("how", [near_dup.QUERY, near_dup.STAGE])
def test_near_duplicates(spark, how):
    rows = ROWS + chain(12, 4)
    got = table(near_dup.near_duplicates(documents(spark, rows), how))
    for i, (n, component) in near_groups(rows, how).items():
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (n, component, i == component)


def test_near_duplicates_edge_rows(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "A b c d e f"), (None, None), (7, ""), (8, "x"), (9, "X")]
    got = sorted(((r.doc_id or -1, r.n_shingles, r.component_id) for r in near_dup.near_duplicates(documents(spark, rows), near_dup.QUERY).collect()), key=str)
    want = [(5, 4, 5), (5, 4, 5), (-1, 4, 5), (-1, 0, None), (7, 0, 7), (8, 1, 8), (9, 1, 8)]
    assert got == sorted(want, key=str)
    assert near_dup.near_duplicates(documents(spark, []), near_dup.QUERY).count() == 0


def test_near_copies_of_a_missing_origin_are_not_paired(spark, monkeypatch):
    """Most of a large group are linked, the rest too far from it: few pairs are left to compare."""
    rng, how = np.random.default_rng(4), near_dup.STAGE
    origin, rows = [f"w{i}" for i in range(150)], []
    for i in range(400):
        text = origin.copy()
        for j in rng.choice(150, 1 + i % 8, replace=False):
            text[j] = f"x{i}y{j}"
        rows.append((i, " ".join(text)))
    made, put = {}, near_dup.Store.put

    def counted(self, df, name, *rest):
        out = put(self, df, name, *rest)
        made[name] = out.count()
        return out

    monkeypatch.setattr(near_dup.Store, "put", counted)
    got = table(near_dup.near_duplicates(documents(spark, rows), how))
    for i, (n, component) in near_groups(rows, how).items():
        assert (got[i]["n_shingles"], got[i]["component_id"]) == (n, component)
    assert max(made[name] for name in made if name.startswith(("tested", "rest", "met"))) < 12 * len(rows)


def test_circulant_signature_estimates_jaccard():
    rng = np.random.default_rng(1)
    shared, own = rng.integers(0, 1 << 62, 800, dtype=np.uint64), rng.integers(0, 1 << 62, (2, 100), dtype=np.uint64)
    a, b = (np.concatenate([shared, o]) for o in own)
    sig = near_dup.signatures(np.concatenate([a, b]), np.array([900, 900]), 400)
    assert abs((sig[0] == sig[1]).mean() - 0.8) < 0.07


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(20)] + [(50, i) for i in range(51, 70)] + [(60, 80), (90, 90)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, **{i: 50 for i in range(50, 70)}, 80: 50}


def test_overlapping_claims_keep_their_whole_reach(spark):
    claims = spark.createDataFrame(
        [(1, 7, s, n, 0, 7, s + 40) for s, n in ((0, 10), (3, 2), (5, 1), (5, 3), (30, 2), (32, 1), (32, 1))],
        "doc long, mark long, start int, n int, source long, source_mark long, origin int",
    )
    got = substring_dedup.compact(claims, 20).select("start", "words", "origin").collect()
    assert sorted(map(tuple, got)) == [(0, 29, 40), (30, 22, 70)]
