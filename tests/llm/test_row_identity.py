"""Texts that share a doc_id, or have none, are told apart by their hash."""

import random
from collections import Counter

import pytest

from spendcast.llm import near_dup, stages, substring_dedup, suffix_dedup
from tests.llm.frames import corpus, documents, words
from tests.llm.test_duplicates import cut_bytes, near_groups, sha


def text(name, n):
    return " ".join(f"{name}{i}" for i in range(n))


def shared_ids(seed, size=50):
    """The texts of a corpus under few ids, a third of them missing."""
    rng = random.Random(seed)
    return [(rng.choice([None, rng.randrange(12)]), t) for _, t, *_ in corpus(seed, size)]


def test_unrepeated_text_without_id_keeps_all_bytes(spark):
    repeated, own = "r" * 300 + text("x", 100), text("own", 120)
    rows = [(1, repeated), (None, repeated), (None, own), (None, None)]
    got = sorted((r.n_bytes, r.n_removed) for r in suffix_dedup.remove_strings(documents(spark, rows)).collect())
    assert got == sorted([(len(repeated), len(repeated))] * 2 + [(len(own), 0), (0, 0)])


@pytest.mark.parametrize("seed", [5, 6])
def test_bytes_of_texts_with_shared_ids(spark, seed):
    rows = shared_ids(seed)
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_strings(documents(spark, rows), 60, 12, 2 << 20).collect())
    assert got == Counter((i, *want) for (i, _), want in zip(rows, cut_bytes([t for _, t in rows], 60)))


@pytest.mark.parametrize("first", [None, 3])
def test_passage_is_removed_whatever_else_its_source_id_holds(spark, first):
    rows = [(first, text("p", 25)), (first, text("o", 25)), (5, text("p", 25))]
    got = {(r.doc_id, r.kept[:1] if r.kept else ""): r.n_removed for r in substring_dedup.remove_repeats(documents(spark, rows)).collect()}
    assert got == {(first, "p"): 0, (first, "o"): 0, (5, ""): 25}


@pytest.mark.parametrize("seed", [5, 6])
def test_words_of_texts_with_shared_ids(spark, seed):
    """Of different texts with one id, any may come first; each repeat stays once."""
    rows = shared_ids(seed)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(documents(spark, rows)).collect()]
    marks = {t: h for t, h in spark.createDataFrame([(t,) for t in {t for _, t in rows}], "t string").selectExpr("t", "xxhash64(t)").collect()}
    order = sorted({(i is not None, i or 0, marks[t], t) for i, t in rows}, key=lambda r: r[:3])
    seen, want = set(), {}
    for known, i, _, t in order:
        w = words(t)
        keep = [True] * len(w)
        for j in range(len(w) - 19):
            if tuple(w[j : j + 20]) in seen:
                keep[j : j + 20] = [False] * 20
            seen.add(tuple(w[j : j + 20]))
        left = " ".join(x for x, k in zip(w, keep) if k)
        want[i if known else None, t] = (len(w), keep.count(False), sha(left.encode()))
    assert Counter(got) == Counter((i, *want[i, t]) for i, t in rows)


def chained():
    """Three texts, the first linked to the second and that to the third only."""
    own = [f"w{i}" for i in range(80)]
    return [" ".join(own[a : a + 70]) for a in (0, 4, 8)]


def test_text_without_id_links_its_neighbours(spark):
    a, b, c = chained()
    for middle in (2, None):
        got = near_dup.near_duplicates(documents(spark, [(1, a), (middle, b), (3, c)]), near_dup.QUERY).collect()
        assert {r.doc_id: r.component_id for r in got} == {1: 1, middle: 1, 3: 1}
    alone = near_dup.near_duplicates(documents(spark, [(None, a), (None, b), (None, c), (None, text("z", 9))]), near_dup.QUERY).collect()
    assert [r.component_id for r in alone] == [None] * 4 and sum(r.stays for r in alone) == 2


@pytest.mark.parametrize("seed", [5, 6])
def test_components_of_texts_with_shared_ids(spark, seed):
    rows = shared_ids(seed)
    numbered = {n: component for n, (_, component) in near_groups([(n, t) for n, (_, t) in enumerate(rows)], near_dup.QUERY).items()}
    least = {}
    for n, component in numbered.items():
        least.setdefault(component, []).append(rows[n][0])
    want = Counter(
        (i, t, None if not words(t) and i is None else i if not words(t) else min((x for x in least[numbered[n]] if x is not None), default=None))
        for n, (i, t) in enumerate(rows)
    )
    found = near_dup.near_duplicates(documents(spark, rows), near_dup.QUERY).collect()
    marks = {(h or 0): t for t, h in spark.createDataFrame([(t,) for _, t in rows], "t string").selectExpr("t", "xxhash64(t)").collect()}
    assert Counter((r.doc_id, marks[r.mark], r.component_id) for r in found) == want


def test_stage_drops_copies_without_id(spark):
    t, o = text("t", 30), text("o", 30)
    docs = documents(spark, [(1, t), (None, t), (None, t), (None, o), (None, o + " more"), (4, ""), (None, None), (7, t + " end")])
    got = stages.deduplicate(spark, docs, "")
    assert got.columns == docs.columns
    left = [(r.doc_id, r.text) for r in got.collect()]
    assert (1, t) in left and (4, "") in left and (None, None) in left and len(left) == 4
    assert sum(i is None and bool(x) for i, x in left) == 1
