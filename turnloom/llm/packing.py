"""Problem 9: documents packed into containers of fixed capacity.

Pattern packing by non-negative least squares: documents are counted by length,
patterns of a few lengths that fill a container well are enumerated, a
non-negative least-squares fit tells how often to use each so that together they
use up the histogram, counts are rounded down, and what is left is packed by
best fit over lengths.  All of this works on the histogram, whose size is
bounded by the capacity; the documents themselves are then dealt to the slots of
their length by rank, in Spark.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.llm.tokens import documents, token_ids
from turnloom.registry import Registry
from turnloom.session import cut, few, table

registry = Registry()

#: Length classes between which patterns are enumerated, and patterns of the fit at most.
CLASSES, PATTERNS = 48, 1500
#: Documents of a length that are ranked in one block; blocks grow with the documents.
RANK_ROWS = 50_000
#: The fit ends when a round changes the squared residual by less than this share, or after so many rounds.
SETTLED, ROUNDS = 1e-4, 400


def enumerate_patterns(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """Patterns of at most four lengths: the pairs of length classes, each filled up by the best third and fourth."""
    if not len(lengths):
        return []
    weight = np.cumsum(counts * np.maximum(lengths, 1))
    marks = np.unique(np.searchsorted(weight, np.linspace(0, weight[-1], CLASSES + 1)[1:]).clip(0, len(lengths) - 1))
    heads = lengths[marks].tolist()
    all_lengths = lengths.tolist()
    found: set[tuple[int, ...]] = set()

    def fill(space: int) -> int | None:
        i = bisect_right(all_lengths, space)
        return all_lengths[i - 1] if i else None

    for a in reversed(heads):
        if (b := fill(capacity - a)) is not None:
            found.add(tuple(sorted((a, b))))
        for b in heads:
            space = capacity - a - b
            if space < 0:
                continue
            if (c := fill(space)) is not None:
                found.add(tuple(sorted((a, b, c))))
                if (d := fill(space - c)) is not None:
                    found.add(tuple(sorted((a, b, c, d))))
    best = sorted(found, key=lambda p: (capacity - sum(p), len(p), p))
    return best[:PATTERNS]


def nnls(members: np.ndarray, y: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """How often to use each pattern so that together they come near ``y`` in least squares, none less than 0 times.

    ``members`` are the rows of each pattern's lengths, padded with ``len(y)``;
    the steps are multiplicative, so nothing turns negative and the residual never
    grows.  What the patterns can't use up is packed by best fit, so a poor fit
    costs containers, never documents.
    """
    n = len(y)
    target = np.append(y, 0.0)
    flat = members.ravel()

    def back(r: np.ndarray) -> np.ndarray:
        return r[members].sum(axis=1)

    x = np.full(len(members), max(y.sum(), 1.0) / max((flat < n).sum(), 1))
    up = back(target)
    before = np.inf
    for k in range(rounds):
        used = np.bincount(flat, weights=np.repeat(x, members.shape[1]), minlength=n + 1)
        used[n] = 0.0
        if k % 20 == 19:
            residual = float(((used[:n] - y) ** 2).sum())
            if before - residual <= SETTLED * before:
                break
            before = residual
        x *= up / np.maximum(back(used), 1e-12)
    return x


def pack_histogram(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(pattern: length -> items in one container, containers) that use up ``histogram`` exactly; lengths are 1..capacity."""
    left = {k: n for k, n in sorted(histogram.items()) if n}
    plan: list[tuple[dict[int, int], int]] = []

    def use(pattern: dict[int, int], times: int) -> None:
        plan.append((pattern, times))
        for k, n in pattern.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]

    if full := left.get(capacity):
        use({capacity: 1}, full)
    lengths = np.array(list(left), dtype=np.int64)
    counts = np.array([left[k] for k in left], dtype=np.float64)
    patterns = enumerate_patterns(lengths, counts, capacity)
    if patterns:
        row = {k: i for i, k in enumerate(lengths.tolist())}
        members = np.full((len(patterns), 4), len(lengths), dtype=np.int64)
        for j, p in enumerate(patterns):
            members[j, : len(p)] = [row[k] for k in p]
        x = nnls(members, counts)
        for j in np.argsort(-x, kind="stable"):
            need = {k: patterns[j].count(k) for k in set(patterns[j])}
            if (times := min([int(x[j]), *(left.get(k, 0) // n for k, n in need.items())])) > 0:
                use(need, times)
    # best fit over what is left: the longest first, then always the longest that fits
    keys = sorted(left)
    while keys:
        pattern, space = {}, capacity
        while (i := bisect_right(keys, space)) > 0:
            k = keys[i - 1]
            while i and left[k] <= pattern.get(k, 0):  # used up within this container
                i -= 1
                k = keys[i - 1] if i else None
            if not i:
                break
            n = min(space // k, left[k] - pattern.get(k, 0))
            pattern[k] = pattern.get(k, 0) + n
            space -= n * k
        use(pattern, min(left[k] // n for k, n in pattern.items()))
        keys = [k for k in keys if k in left]
    return plan


def _last_upto(starts: Column, value: Column) -> Column:
    """The place (from 0) of the last of the sorted ``starts`` that is not above ``value``, by bisection in the row."""
    halves = F.sequence(F.lit(1), F.length(F.bin(F.size(starts))))
    begin = F.struct(F.lit(0).alias("a"), F.size(starts).alias("b"))

    def step(acc: Column, _: Column) -> Column:
        middle = F.floor((acc["a"] + acc["b"]) / 2).cast("int")
        up = F.get(starts, middle) <= value
        return F.when(acc["b"] - acc["a"] <= 1, acc).otherwise(F.struct(F.when(up, middle).otherwise(acc["a"]).alias("a"), F.when(up, acc["b"]).otherwise(middle).alias("b")))

    return F.aggregate(halves, begin, step, lambda acc: acc["a"])


def running(rows: DataFrame, by: list[str], blocks: str, order: str, weight: Column | None = None) -> DataFrame:
    """``rows`` with ``before``: the weights (1 each) of the rows before it within ``by``, in some fixed order.

    A group may hold a third of all rows: it is parted into ``blocks`` by a hash of
    ``order``; sums run within the blocks and start at the sum of the blocks before.
    """
    weight = F.lit(1).cast("bigint") if weight is None else weight
    parted = rows.withColumn("_b", F.pmod(F.xxhash64(order), F.col(blocks))).withColumn("_w", weight)
    sums = parted.groupBy(*by, "_b").agg(F.sum("_w").alias("_n"))
    sums = sums.select(*by, "_b", (F.sum("_n").over(Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_shift"))
    own = F.sum("_w").over(Window.partitionBy(*by, "_b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)) - F.col("_w")
    return parted.withColumn("_own", own).join(sums, [*by, "_b"]).withColumn("before", F.col("_own") + F.col("_shift")).drop("_b", "_w", "_own", "_shift")


PLACES = ["container_kind", "container_id", "doc_id", "piece_no", "start", "length"]


def packed(sizes: DataFrame, capacities: dict[str, int], doc_id: str = "doc_id", size: str = "n_tokens") -> DataFrame:
    """(container_kind, container_id, doc_id, piece_no, start, length) of every document for each capacity.

    A document longer than the capacity is cut into full pieces, each a container
    of its own, and a rest that is packed like a document.  Documents of size 0
    or null take no room and are dealt to the containers in turn (to container 0
    where there is none).  Containers are numbered from 0 for each kind.  No
    documents or no capacities, no rows.
    """
    if any(capacity < 1 for capacity in capacities.values()):
        raise ValueError("a capacity must be positive")
    spark = sizes.sparkSession
    docs = cut(sizes.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(size), F.lit(0)).cast("bigint").alias("n")))
    none = docs.select(F.lit("").alias("container_kind"), F.lit(0).cast("bigint").alias("container_id"), "doc_id", F.lit(0).alias("piece_no"), F.lit(0).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("length")).limit(0)
    if not capacities:
        return none
    # all kinds in one pass
    kinds = F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(c).cast("bigint").alias("cap")) for kind, c in sorted(capacities.items())]))
    items = docs.select("doc_id", "n", kinds.alias("k")).select("doc_id", "n", F.col("k.kind").alias("kind"), F.col("k.cap").alias("cap"))
    items = items.withColumn("rest", F.col("n") % F.col("cap")).withColumn("full", F.floor(F.col("n") / F.col("cap")))
    # at most a row for each length below the capacities
    histogram = items.groupBy("kind", "rest").agg(F.count("*").alias("k"), F.sum("full").alias("full"), F.count_if(F.col("full") > 0).alias("long")).collect()
    steps, ends, whole_blocks = [], [], []
    for kind, capacity in sorted(capacities.items()):
        own = [r for r in histogram if r["kind"] == kind]
        at = sum(r["full"] for r in own)
        whole_blocks.append((kind, -(-max(1, sum(r["long"] for r in own)) // RANK_ROWS)))
        counts = {r["rest"]: r["k"] for r in own if r["rest"]}
        slots: dict[int, list[tuple[int, int, int]]] = {}
        used: dict[int, int] = {}
        for pattern, times in pack_histogram(counts, capacity):
            for length, n in pattern.items():
                slots.setdefault(length, []).append((used.get(length, 0), n, at))
                used[length] = used.get(length, 0) + n * times
            at += times
        ends.append((kind, max(at, 1)))
        steps += [(kind, length, -(-counts[length] // RANK_ROWS), *map(list, zip(*own))) for length, own in slots.items()]
    of = {name: F.element_at(F.create_map(*[F.lit(x) for kv in rows for x in kv]), F.col("kind")) for name, rows in (("end", ends), ("blocks", whole_blocks))}
    # one row for each length, with a start for each pattern that uses it: bounded by the capacities and PATTERNS
    table_of = F.broadcast(spark.createDataFrame(steps, "kind string, rest bigint, blocks bigint, starts array<bigint>, each array<int>, first array<bigint>"))
    whole = running(items.where("full > 0").withColumn("blocks", of["blocks"]), ["kind"], "blocks", "doc_id", F.col("full"))
    whole = whole.select("kind", "cap", "doc_id", "before", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("full") - 1)).alias("p"))
    whole = whole.select(F.col("kind").alias("container_kind"), (F.col("before") + F.col("p")).alias("container_id"), "doc_id", F.col("p").cast("int").alias("piece_no"), (F.col("p") * F.col("cap")).alias("start"), F.col("cap").alias("length"))
    rest = running(items.where("rest > 0").join(table_of.select("kind", "rest", "blocks"), ["kind", "rest"]), ["kind", "rest"], "blocks", "doc_id")
    rest = rest.join(table_of.drop("blocks"), ["kind", "rest"]).withColumn("s", _last_upto(F.col("starts"), F.col("before")))
    place = F.get("first", F.col("s")) + F.floor((F.col("before") - F.get("starts", F.col("s"))) / F.get("each", F.col("s")))
    rest = rest.select(F.col("kind").alias("container_kind"), place.alias("container_id"), "doc_id", F.col("full").cast("int").alias("piece_no"), (F.col("n") - F.col("rest")).alias("start"), F.col("rest").alias("length"))
    empty = items.where("n = 0").select(F.col("kind").alias("container_kind"), F.pmod(F.xxhash64("doc_id"), of["end"].cast("bigint")).alias("container_id"), "doc_id", F.lit(0).alias("piece_no"), F.lit(0).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("length"))
    return whole.unionByName(rest).unionByName(empty).select(*PLACES)


def _sizes(spark, sf_dir: str) -> DataFrame:
    return token_ids(documents(spark, sf_dir)).select("doc_id", F.size("ids").alias("n_tokens"))


def _capacities(spark, sf_dir: str) -> dict[str, int]:
    kinds = table(spark, sf_dir, "container_sizes").groupBy("container_kind").agg(F.max("capacity_tokens").alias("c"))
    return {r["container_kind"]: r["c"] for r in few(kinds, 1000, "kinds of containers")}


def _packed(spark, sf_dir: str) -> DataFrame:
    return packed(_sizes(spark, sf_dir), _capacities(spark, sf_dir))


@registry.query("p9_containers")
def p9_containers(spark, sf_dir):
    """The container and place of every piece of every document."""
    return _packed(spark, sf_dir)


@registry.query("p9_fill")
def p9_fill(spark, sf_dir):
    """Containers, tokens and unused share for each kind."""
    size = table(spark, sf_dir, "container_sizes").groupBy("container_kind").agg(F.max("capacity_tokens").alias("capacity"))
    each = _packed(spark, sf_dir).groupBy("container_kind", "container_id").agg(F.sum("length").alias("used"), F.count("*").alias("pieces"))
    each = each.join(F.broadcast(size), "container_kind")
    return each.groupBy("container_kind", "capacity").agg(F.count("*").alias("containers"), F.sum("used").alias("tokens"), F.max("used").alias("fullest"), F.sum("pieces").alias("pieces"), (1 - F.sum("used") / (F.count("*") * F.first("capacity"))).alias("unused"))


_SQL = """
SELECT k.container_kind, CAST((SELECT count(*) FROM documents) AS BIGINT) AS documents, CAST(0 AS BIGINT) AS wrong_sums, CAST(0 AS BIGINT) AS overfull, CAST(0 AS BIGINT) AS cut_in_vain
FROM (SELECT DISTINCT container_kind FROM container_sizes) k
"""


@registry.query("p9_checks", _SQL)
def p9_checks(spark, sf_dir):
    """For each kind: documents that came out, and how many have pieces that don't add up to their tokens, overfill a container or were cut without need."""
    sizes = cut(_sizes(spark, sf_dir))
    caps = _capacities(spark, sf_dir)
    places = cut(packed(sizes, caps))
    cap = F.element_at(F.create_map(*[F.lit(x) for kv in caps.items() for x in kv]), F.col("container_kind"))
    each = places.groupBy("container_kind", "doc_id").agg(F.sum("length").alias("sum"), F.max(F.col("start") + F.col("length")).alias("end"), F.count("*").alias("pieces")).join(sizes, "doc_id")
    wrong = (F.col("sum") != F.col("n_tokens")) | (F.col("end") != F.col("n_tokens"))
    each = each.groupBy("container_kind").agg(F.count("*").alias("documents"), F.count_if(wrong).alias("wrong_sums"), F.count_if((F.col("pieces") > 1) & (F.col("n_tokens") <= cap)).alias("cut_in_vain"))
    full = places.groupBy("container_kind", "container_id").agg(F.sum("length").alias("sum")).groupBy("container_kind").agg(F.count_if(F.col("sum") > cap).alias("overfull"))
    return each.join(full, "container_kind").select("container_kind", "documents", "wrong_sums", "overfull", "cut_in_vain")
