"""Problem 1 against brute force, and on edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnloom.llm import overlap as P
from turnloom.llm.words import comparable_words, split_column


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b):
            diagonal, row[j + 1] = row[j + 1], diagonal + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


def test_same_order_is_lcs():
    rnd = random.Random(1)
    for _ in range(200):
        a, b = ([rnd.choice("abcd") for _ in range(rnd.randint(0, 12))] for _ in range(2))
        assert P.same_order(a, b) == lcs(a, b)


def test_words():
    assert comparable_words("Ｈello, wоrld! ﬁne") == ["hello", "world", "fine"]
    assert comparable_words("東京へ行くTom") == ["東", "京", "へ", "行", "く", "tom"]
    assert comparable_words("... 🙂") == []


def test_splits(spark):
    df = spark.createDataFrame([("Train",), (" dev ",), ("TEST",), ("x",), (None,)], "s string")
    assert [r[0] for r in df.select(split_column(F.col("s"))).collect()] == ["train", "validation", "test", None, None]


def test_overlaps_against_brute_force(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [[rnd.choice(words) for _ in range(rnd.choice([3, 6, 12, 25, 60, 150]))] for _ in range(60)]
    rows = []
    for i, b in enumerate(base):
        rows.append((i, True, " ".join(b)))
        c = list(b)
        for _ in range(rnd.choice([0, 1, len(b) // 8, len(b) // 3])):
            k = rnd.randrange(len(c))
            c[k : k + 1] = rnd.choice([[], [rnd.choice(words)], [c[k], "new"]])
            if not c:
                c = ["z"]
        rows.append((100 + i, False, " ".join(c).upper()))
    rows += [(900, False, None), (901, True, ""), (902, None, rows[0][2]), (903, False, "?!"), (904, True, "?!"), (0, True, rows[0][2])]
    df = spark.createDataFrame(rows, "id bigint, t boolean, text string").withColumn("class", F.lit(1)).withColumn("n", F.lit(2))
    links, members = P.overlaps(df, F.col("id"), F.col("t"), F.col("text"))
    ids = {}
    for r in members.collect():
        ids.setdefault((r["class"], r["is_train"]), []).append(r["id"])
    got = {(a, b) for r in links.collect() for a in ids[r["e"], False] for b in ids[r["t"], True]}
    want = set()
    for i, t, x in rows:
        for j, u, y in rows:
            if t is False and u and x and y:
                a, b = comparable_words(x), comparable_words(y)
                if a and b and lcs(a, b) >= 0.8 * max(len(a), len(b)):
                    want.add((i, j))
    assert got == want


def test_empty(spark):
    df = spark.createDataFrame([], "id bigint, t boolean, text string")
    links, members = P.overlaps(df, F.col("id"), F.col("t"), F.col("text"))
    assert links.count() == 0 and members.count() == 0


def test_large_family_of_variants_is_whole(spark):
    """Every shared n-gram joins 50 x 50 pairs, and no two records share a run of 20 words."""
    rows = [(i, i >= 50, " ".join(f"v{i}x{k}" if k % 15 == 7 else f"w{k}" for k in range(60))) for i in range(100)]
    df = spark.createDataFrame(rows, "id bigint, t boolean, text string")
    links, _ = P.overlaps(df, F.col("id"), F.col("t"), F.col("text"))
    assert links.count() == 2500


def test_small_blocks_and_chunks_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK_WORDS", 700)
    monkeypatch.setattr(P, "CHUNK_WORDS", 900)
    monkeypatch.setattr(P, "_CELLS", 50)
    test_large_family_of_variants_is_whole(spark)


def test_a_family_of_templates_is_whole(spark):
    """Records of ten words of which two differ in each: 500 x 500 links."""
    rows = [(i, i >= 500, f"we met v{i} near the old w{i} bridge at noon") for i in range(1000)]
    df = spark.createDataFrame(rows, "id bigint, t boolean, text string")
    links, _ = P.overlaps(df, F.col("id"), F.col("t"), F.col("text"))
    assert links.count() == 250_000


def test_four_words(spark):
    rows = [(1, True, "alpha beta gamma delta"), (2, False, "alpha beta gamma delta epsilon"), (3, False, "alpha beta gamma"), (4, False, "alpha beta delta")]
    df = spark.createDataFrame(rows, "id bigint, t boolean, text string")
    links, members = P.overlaps(df, F.col("id"), F.col("t"), F.col("text"))
    ids = {r["class"]: r["id"] for r in members.collect()}
    assert [(ids[r["e"]], ids[r["t"]], r["agreement"]) for r in links.collect()] == [(2, 1, 0.8)]


def apart(n, k):
    """Two records of n words whose n - k common words stand in as many runs as k words out and k others in can make."""
    common, a, b = [f"c{i}" for i in range(n - k)], [], []
    for i, run in enumerate(np.array_split(common, 2 * k + 1)):
        a += [*run, f"a{i}"] if i % 2 else [*run]
        b += [*run, f"b{i}"] if i % 2 == 0 and i < 2 * k else [*run]
    return a, b


def scanned(a, b):
    h = [np.array([hash(w) & (1 << 63) - 1 for w in x], dtype=np.uint64) for x in (a, b)]
    return list(P.candidates(h[0], np.array([len(a)]), h[1], np.array([len(b)])))


@pytest.mark.parametrize("n", [*range(5, 51), 99, 142, 500])
def test_separate_insertions_and_deletions_are_candidates(n):
    a, b = apart(n, n // 5)
    assert len(a) == len(b) == n and P.same_order(a, b) == n - n // 5
    assert len(scanned(a, b)) == 1


def test_every_agreeing_pair_is_a_candidate():
    rnd = random.Random(3)
    for _ in range(400):
        n = rnd.randint(4, 70)
        a = [f"w{rnd.randrange(rnd.choice([3, 12, 400]))}" for _ in range(n)]
        b = list(a)
        for _ in range(rnd.randint(0, max(1, n // 4))):
            k = rnd.randrange(len(b))
            b[k : k + 1] = rnd.choice([[], [f"x{rnd.randrange(5)}"], [b[k], "new"]])
        if b and lcs(a, b) >= 0.8 * max(len(a), len(b)) and len(b) > 3 and a != b:
            assert scanned(a, b), (a, b)


def test_separate_insertions_and_deletions_are_found(spark):
    pairs = [apart(n, n // 5) for n in (5, 9, 11, 12, 15, 16, 17, 20, 25, 30, 35, 40, 45, 60, 100, 300)]
    rows = [(100 * s + i, s == 1, " ".join(f"n{i}{w}" for w in p[s])) for i, p in enumerate(pairs) for s in (0, 1)]
    df = spark.createDataFrame(rows, "id bigint, t boolean, text string")
    links, _ = P.overlaps(df, F.col("id"), F.col("t"), F.col("text"))
    assert links.count() == len(pairs)


def test_sketches_differ_in_no_more_bits_than_bags_in_words():
    from collections import Counter

    rnd = random.Random(7)
    for n in (4, 9, 40, 200):
        a = [rnd.choice([3, 5, 1 << 40, rnd.getrandbits(64)]) for _ in range(n)]
        b = [rnd.choice([x, x, x, rnd.getrandbits(64)]) for x in a] + [5]
        flat = np.array(a + b, dtype=np.uint64)
        wide = P.sketches(flat, np.array([n, n + 1]), 16)
        bags = Counter(a), Counter(b)
        assert np.bitwise_count(wide[0] ^ wide[1]).sum() <= ((bags[0] - bags[1]) + (bags[1] - bags[0])).total()
        # a record's sketch doesn't depend on its batch, and a narrow one is the wide one's halves laid over each other
        alone = P.sketches(flat[n:], np.array([n + 1]), 8)[0]
        assert (alone == wide[1, :8] ^ wide[1, 8:]).all()


def test_a_cell_gets_sketches_and_few_pairs_by_chance(spark, monkeypatch):
    """Words cross the cluster for pairs that are near alone, not for each block and chunk; records of a small vocabulary are rarely so."""
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, i >= 100, " ".join(rnd.choice(words) for _ in range(rnd.randint(80, 120)))) for i in range(400)]
    rows += [(1000 + i, True, f"{text} one more") for i, _, text in rows[:40]]
    df = spark.createDataFrame(rows, "id bigint, t boolean, text string")
    compared = spark.sparkContext.accumulator(0)
    compare = P._compared

    def counted(batches):
        def tell():
            for b in batches:
                compared.add(b.num_rows)
                yield b

        return compare(tell())

    monkeypatch.setattr(P, "_compared", counted)
    links, _ = P.overlaps(df, F.col("id"), F.col("t"), F.col("text"))
    assert links.count() == 40 and compared.value <= 44
