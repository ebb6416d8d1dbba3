"""Problem 9: nothing lost, nothing over capacity, little unused."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from turnloom.llm.packing import pack_histogram, packed


@pytest.mark.parametrize("seed", range(4))
def test_histogram(seed):
    rnd = random.Random(seed)
    h = Counter(min(512, max(1, int(rnd.lognormvariate(4.5, 1)))) for _ in range(3000))
    plan = pack_histogram(dict(h), 512)
    used = Counter()
    for pattern, times in plan:
        assert times > 0 and sum(k * n for k, n in pattern.items()) <= 512
        for k, n in pattern.items():
            used[k] += n * times
    assert used == h
    least = -(-sum(k * n for k, n in h.items()) // 512)
    assert sum(t for _, t in plan) <= 1.02 * least + 1


def test_histogram_edges():
    assert pack_histogram({}, 10) == []
    assert pack_histogram({10: 3}, 10) == [({10: 1}, 3)]
    assert sum(t for _, t in pack_histogram({6: 5}, 10)) == 5


def test_packed(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice([0, None, 5, 5, 5, rnd.randint(1, 90), rnd.randint(100, 450)])) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id bigint, n_tokens int").withColumn("length", F.lit(1)).withColumn("rank", F.lit(1))
    got = packed(df, {"s": 100, "l": 400}).toPandas()
    for kind, cap in (("s", 100), ("l", 400)):
        own = got[got["container_kind"] == kind]
        assert own.groupby("container_id")["length"].sum().max() <= cap
        assert own.groupby("doc_id")["length"].sum().to_dict() == {i: n or 0 for i, n in rows}
        for i, n in rows:
            if (n or 0) <= cap:
                continue
        cut = own.sort_values(["doc_id", "piece_no"]).groupby("doc_id")
        assert all((g["start"].to_numpy()[1:] == g["length"].cumsum().to_numpy()[:-1]).all() for _, g in cut)
        assert sorted(own["container_id"].unique()) == list(range(own["container_id"].nunique()))
    assert packed(df.limit(0), {"s": 10}).count() == 0


def test_ranks_in_many_blocks(spark, monkeypatch):
    from turnloom.llm import packing

    monkeypatch.setattr(packing, "RANK_ROWS", 40)
    test_packed(spark)


def test_bisection(spark):
    from turnloom.llm.packing import _last_upto

    rows = [(starts, v) for starts in ([0], [0, 3], [0, 1, 2, 5, 9, 30, 31]) for v in range(40)]
    df = spark.createDataFrame(rows, "s array<bigint>, v bigint")
    got = [r[0] for r in df.select(_last_upto(F.col("s"), F.col("v"))).collect()]
    assert got == [max(i for i, x in enumerate(s) if x <= v) for s, v in rows]
