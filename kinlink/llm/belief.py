"""One-to-one matching by loopy belief propagation over candidate pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


MOST_ODDS = 20.0


def _log_sum_others(d: DataFrame, node: str, value: Column, out: str) -> DataFrame:
    """d with out: minus log(1 + sum of exp(value) over the node's other pairs).

    The node's sums are aggregated before the join, so a node of any number of pairs is no hot task.
    The pair's own share is taken out of the sum; with values of at most MOST_ODDS the error of that
    is below 1e-7.
    """
    d = d.withColumn("_e", F.exp(F.least(value, F.lit(MOST_ODDS))))
    total = d.groupBy(node).agg(F.sum("_e").alias("_sum"))
    return d.join(total, node).withColumn(out, -F.log1p(F.greatest(F.col("_sum") - F.col("_e"), F.lit(0.0)))).drop("_e", "_sum")


def sigmoid(c: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(c, F.lit(500.0)), F.lit(-500.0))))


def one_to_one(edges: DataFrame, cut, rounds: int = 200, eps: float = 0.05) -> DataFrame:
    """(l, r, p): the marginal probability of each candidate pair (l, r, odds).

    odds are the log odds of the pair by its own evidence. Each node on either side takes part in one
    pair at most: its factor tells a pair minus log(1 + sum of exp(evidence and message from the other
    side) over its other pairs). Messages go to and fro by aggregates and joins on the nodes until none moves
    by eps; the lineage is cut in each round. From the first round whose largest move is no smaller than
    that before, messages are damped by half. For one-to-one factors they are known to converge; should they not in
    so many rounds, an error says so, and no unfinished result is given. Pairs that compete with none keep their own
    probability. Null nodes or odds drop out, repeated pairs count once with their best odds; an empty table gives no rows.
    """
    e = edges.where("l is not null and r is not null and odds is not null").groupBy("l", "r").agg(F.max("odds").alias("odds"))
    lonely = lambda x: e.groupBy(x).agg(F.count(F.lit(1)).alias(f"n{x}"))
    e = cut(e.join(lonely("l"), "l").join(lonely("r"), "r"))
    alone = e.where("nl = 1 and nr = 1").select("l", "r", sigmoid(F.col("odds")).alias("p"))
    d = e.where("nl > 1 or nr > 1").select("l", "r", "odds", F.lit(0.0).alias("a"), F.lit(0.0).alias("b"))
    damping, before = 0.0, float("inf")
    for _ in range(rounds):
        new = _log_sum_others(d, "l", F.col("odds") + F.col("b"), "a2").withColumn("a2", damping * F.col("a") + (1 - damping) * F.col("a2"))
        new = _log_sum_others(new, "r", F.col("odds") + F.col("a2"), "b2").withColumn("b2", damping * F.col("b") + (1 - damping) * F.col("b2"))
        moved = F.greatest(F.abs(F.col("a2") - F.col("a")), F.abs(F.col("b2") - F.col("b")))
        d = cut(new.select("l", "r", "odds", moved.alias("moved"), F.col("a2").alias("a"), F.col("b2").alias("b")))
        most = d.agg(F.max("moved")).first()[0] or 0.0
        if most < eps:
            break
        if most >= before:
            damping = 0.5
        before = most
    else:
        raise RuntimeError(f"belief propagation still moves by {most} after {rounds} rounds")
    return alone.unionByName(d.select("l", "r", sigmoid(F.col("odds") + F.col("a") + F.col("b")).alias("p")))


def same_entity(pairs: DataFrame, cut) -> DataFrame:
    """(registry, code, entity) for pairs (registry, code_a, code_b): entity is the least code each is linked to.

    Labels go along the pairs by joins until none changes. A code that learns of a lower label tells the
    code that labels it, and each then takes the label of its label, so that the rounds grow with the
    logarithm of the longest chain. Codes in no pair have no row.
    """
    side = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    p = pairs.select("registry", F.explode(F.array(side("code_a", "code_b"), side("code_b", "code_a"))).alias("p"))
    p = cut(p.select("registry", "p.x", "p.y").distinct())
    label = p.groupBy("registry", "x").agg(F.least(F.min("y"), F.first("x")).alias("e"))
    while True:
        near = p.join(label.withColumnRenamed("x", "y"), ["registry", "y"]).groupBy("registry", "x").agg(F.min("e").alias("n"))
        new = cut(label.join(near, ["registry", "x"]).select("registry", "x", "e", F.least("e", "n").alias("n")))
        if new.where("n < e").isEmpty():
            break
        told = new.groupBy("registry", F.col("e").alias("x")).agg(F.min("n").alias("told"))
        low = cut(new.join(told, ["registry", "x"], "left").select("registry", "x", F.least("n", "told").alias("e")))
        label = cut(low.join(low.select("registry", F.col("x").alias("e"), F.col("e").alias("up")), ["registry", "e"]).select("registry", "x", F.col("up").alias("e")))
    return label.select("registry", F.col("x").alias("code"), F.col("e").alias("entity"))
