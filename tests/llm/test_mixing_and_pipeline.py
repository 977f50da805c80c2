"""Mixing against an independent apportionment, and the pipeline's stages."""

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from spendcast.llm import mixing, near_dup, rules
from tests.conftest import SF
from tests.llm.frames import corpus, documents, table, words

ROWS = corpus()


def level_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total >= most * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        target |= {s: most * sizes[s] for s in over}
        left -= sum(most * sizes[s] for s in over)
        open_ -= over
    return target


def test_mixing(spark):
    rows = [(i, t, [None, "b", "ä", "z"][i % 4]) for i, t, *_ in ROWS]
    got = table(mixing.mix_sources(documents(spark, rows), block_words=16, shard_words=900))
    size = {i: len(words(t)) for i, t, _ in rows}
    per = {}
    for i, _, s in rows:
        per[s] = per.get(s, 0) + size[i]
    target, taken = level_targets(per), {}
    for i, _, s in rows:
        g = got[i]
        assert (g["size"], g["source_size"]) == (size[i], per[s]) and g["target"] == pytest.approx(target[s])
        assert 0 <= g["taken"] <= 2 * g["size"]
        taken[s] = taken.get(s, 0) + g["taken"]
    assert all(abs(taken[s] - target[s]) <= 0.05 * target[s] + 80 for s in per)
    again = table(mixing.mix_sources(documents(spark, rows, 5), block_words=16, shard_words=900))
    assert again == got


def test_quotas_are_the_highest_quotients(spark):
    rng = np.random.default_rng(4)
    rows = [(h, f"s{i}", int(w), float(w * rng.uniform(0, 2))) for h in range(5) for i, w in enumerate(rng.integers(1, 5000, 12))]
    got = {(r.shard, r.source): r.quota for r in mixing.block_quotas(spark.createDataFrame(rows, "shard long, source string, words long, wanted double"), 64).collect()}
    for h in range(5):
        own = [(s, -(-w // 64), v / 64) for x, s, w, v in rows if x == h]
        seats = [(v / (2 * k + 1), s, k) for s, blocks, v in own for k in range(2 * blocks)]
        best = sorted(seats, key=lambda q: (-q[0], q[1], q[2]))[: int(sum(v for *_, v in own) + 0.5)]
        for s, *_ in own:
            assert got[h, s] == sum(x == s for _, x, _ in best)


def test_mixing_edge_tables(spark):
    assert mixing.mix_sources(documents(spark, [])).count() == 0
    rows = [(1, None), (1, None), (2, ""), (None, "a b"), (None, "a b"), (3, "x y", "t"), (3, "x y", "t")]
    got = mixing.mix_sources(documents(spark, rows)).collect()
    assert sorted(r.size for r in got) == [0, 0, 0, 2, 2, 2, 2] and all(r.taken <= 2 * r.size for r in got)


def test_mixing_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(mixing.MIXING_SQL).fetchall()
    got = [tuple(r) for r in mixing.mixing_query(spark, SF).collect()]
    assert sorted(got) == sorted(want)


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF).cache()
        assert docs.columns == before.columns
        seen[name] = (table(before), docs.collect())
    before, after = seen["quality rules"]
    verdict = table(rules.judge(spark.createDataFrame(list(before.values()), docs.schema), rules.fit_votes(spark.createDataFrame(list(before.values()), docs.schema))))
    assert {r.doc_id for r in after} == {i for i, v in verdict.items() if v["kept"]}
    before, after = seen["near duplicates"]
    groups = table(near_dup.near_duplicates(spark.createDataFrame(list(before.values()), docs.schema), near_dup.STAGE))
    assert sorted(r.doc_id for r in after) == sorted(i for i, g in groups.items() if g["kept"])
    before, after = seen["mixing"]
    times = {}
    for r in after:
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
        assert before[r.doc_id]["text"] == r.text
    assert max(times.values()) <= 2
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert tokens.count() == docs.count()


@pytest.mark.parametrize("rows", [[], [(1, None), (1, None), (None, ""), (None, "a b c d e f g h")]])
def test_stages_on_odd_tables(spark, rows):
    docs = documents(spark, rows)
    odd = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        odd = stage(spark, docs, "")
        assert odd.columns == docs.columns and odd.count() <= 2 * len(rows)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == len(rows)


def test_one_row_of_each_near_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = documents(spark, [(4, text), (4, text), (2, text.upper()), (9, "other " * 30)])
    assert sorted(r.doc_id for r in corpus_pipeline.STAGES[1][1](spark, docs, "").collect()) == [2, 9]
