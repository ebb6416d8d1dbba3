"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.session import cut

#: A key that holds more than this share of the rows is joined by broadcast; there are fewer than 1 / HEAVY of them.
HEAVY = 0.005

#: Rounds after which an unfinished run is an error; each round at least halves long chains.
MAX_ROUNDS = 40


def matched(rows: DataFrame, per_key: DataFrame, on: list[str], total: int) -> DataFrame:
    """``rows`` joined to the one row of ``per_key`` for their key, whose column ``n`` tells how many of the ``total`` rows have it.

    A key may hold a third of all rows: rows of such keys are not shuffled but meet
    a broadcast of their few keys, which are fewer than 1 / HEAVY for each kind of key.
    """
    most = max(1, int(total * HEAVY))
    heavy = F.broadcast(per_key.where(F.col("n") > most).drop("n"))
    light = per_key.where(F.col("n") <= most).drop("n")
    rest = rows.join(heavy.select(*on), on, "left_anti")
    return rows.join(heavy, on).unionByName(rest.join(light, on))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every linked node; the component is its least node.

    ``links`` are pairs of orderable ids; nulls and links of a node to itself
    don't count.  Every round replaces each node's links by links to the least of
    its neighbours, so that stars around the least nodes are left.  Minima are
    aggregated before they are shuffled; rows of a node with very many neighbours
    meet them by broadcast and are never gathered in one task.  Rounds end when no
    node has two links upwards and no star's middle has one.  No links, no rows.
    """
    edges = links.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).where("u IS NOT NULL AND u != v").distinct()
    edges = cut(edges)
    total = edges.count()
    for _ in range(MAX_ROUNDS):
        both = edges.select(F.col("v").alias("x"), F.col("u").alias("y")).unionByName(edges.select(F.col("u").alias("x"), F.col("v").alias("y")))
        least = both.groupBy("x").agg(F.least("x", F.min("y")).alias("m"), F.count("*").alias("n"))
        # large star: each greater neighbour of x moves to x's least
        large = matched(both.where("y > x"), least, ["x"], 2 * total).select(F.col("y").alias("v"), F.col("m").alias("u")).where("v != u").distinct()
        # small star: each node's lesser neighbours move to the least of them
        low = large.groupBy("v").agg(F.min("u").alias("m"), F.count("*").alias("n"))
        moved = matched(large, low.where("n > 1"), ["v"], total).where("u != m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        edges = cut(moved.unionByName(low.select("v", F.col("m").alias("u"))).distinct())
        end = [F.struct(F.col(c).alias("x"), F.lit(k).alias("up"), F.lit(1 - k).alias("middle")) for c, k in (("v", 1), ("u", 0))]
        ends = edges.select(F.inline(F.array(*end)))
        ends = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("middle").alias("middle"))
        total, open_ends = ends.agg(F.sum("up"), F.count_if((F.col("up") > 1) | (F.col("up") + F.col("middle") > 1))).first()
        if not open_ends:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
    raise RuntimeError(f"components were not settled after {MAX_ROUNDS} rounds")
