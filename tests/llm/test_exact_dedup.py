"""Exact duplicates and quotient filters against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from spendcast.llm.exact_dedup import digests, exact_duplicates, quotient_filters, repeated_marks
from spendcast.llm.quotient import QuotientFilter, merge, summed
from tests.llm.frames import documents

SPACED = ["a b", "ab", "a\tb\n", "a b", "", None, " \r\n", "long " * 2000, "long" * 2000, "é e", "ée"]


def expected(rows):
    classes = defaultdict(list)
    for i, (doc_id, text, *_) in enumerate(rows):
        norm = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        classes[norm].append((-len(text or ""), doc_id is None, doc_id or 0, i))
    out = []
    for norm, members in classes.items():
        members.sort()
        for place, (_, _, _, i) in enumerate(members):
            digest = hashlib.sha256(norm.encode()).hexdigest()
            out.append((rows[i][0], rows[members[0][3]][0], len(members), place == 0, digest))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [64, 3])
def test_exact_duplicates(spark, bits):
    """With 3 bits most fingerprints clash, and bytes alone tell texts apart."""
    rows = [(i, t) for i, t in enumerate(SPACED * 2)]
    rows += [(5, "twice"), (5, "twice"), (None, "twice"), (None, "none"), (None, "n one"), (-(1 << 63), "low"), (7, "low")]
    rows += [(i, "hot  text") for i in range(100, 1500)] + [(i, f"own {i}") for i in range(2000, 2200)]
    got = exact_duplicates(documents(spark, rows), bits).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(rows)
    assert exact_duplicates(documents(spark, [])).count() == 0


def test_hot_and_other_classes_meet(spark):
    rows = [(i, "hot") for i in range(1100)] + [(2000 + i, f"t{i // 3}") for i in range(300)]
    got = Counter((r.group_size, r.kept) for r in exact_duplicates(documents(spark, rows)).collect())
    assert got == {(1100, False): 1099, (1100, True): 1, (3, False): 200, (3, True): 100}


@pytest.mark.parametrize("n", [0, 1, 2, 5000])
def test_filter_loses_nothing(n):
    rng = np.random.default_rng(n)
    marks = rng.integers(0, 1 << 64, n, dtype=np.uint64)
    marks[n // 2 :] >>= np.uint64(50)  # crowded quotients, runs pushed on
    marks, counts = summed(marks, rng.integers(1, 9, n))
    got = QuotientFilter.of(marks, counts).entries()
    assert got[0].tolist() == marks.tolist() and got[1].tolist() == counts.tolist()


def test_filters_merge_by_adding_counts():
    rng = np.random.default_rng(8)
    parts = [summed(rng.integers(0, 400, 300).astype(np.uint64) << np.uint64(54), np.ones(300, np.int64)) for _ in range(5)]
    want = Counter()
    for marks, counts in parts:
        want.update(dict(zip(marks.tolist(), counts.tolist())))
    marks, counts = merge([QuotientFilter.of(*p) for p in parts]).entries()
    assert dict(zip(marks.tolist(), counts.tolist())) == want and (np.diff(marks.astype(object)) > 0).all()


@pytest.mark.parametrize("slice_bits", [0, 5])
def test_slices_give_counts_of_all_tasks(spark, slice_bits):
    rows = [(i, f"t{i % 90}" if i % 3 else f"u{i}") for i in range(600)]
    marks = digests(documents(spark, rows, 7)).select("mark")
    want = {m: n for m, n in Counter(r.mark for r in marks.collect()).items() if n > 1}
    got = {r.mark: r.n for r in repeated_marks(quotient_filters(marks, slice_bits), slice_bits).collect()}
    assert got == want


def test_one_very_long_text(spark):
    text = "word " * 1_000_000
    got = {r.doc_id: r for r in exact_duplicates(documents(spark, [(1, text), (2, text.strip()), (3, "x")])).collect()}
    assert got[2].keep_id == 1 and got[1].group_size == 2 and got[3].kept
