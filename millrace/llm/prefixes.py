"""Pairs of sets that may be similar enough, by prefixes in the order of rarity. Exact.

Where all sets are put in one order, two sets that share s members share one of the first
n - s + 1 of each. Sharing a similarity of p percent, the larger set shares p percent of its own
members at least, and the smaller one 2p / (100 + p) of its own; so a larger set is named by a
longer prefix, a smaller one by a shorter one, and a pair needs one of each. With the rarest
members first, a set that has enough members of its own stands in no pair at all and goes at
once, before any pair is made: that is what keeps texts that merely hold a common passage, and
texts of one group that differ too much from each other, from being paired with one another.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Keep = Callable[[DataFrame, str], DataFrame]


def _least_shared(percent: int) -> tuple[Column, Column]:
    """Members that a set shares with a partner at least: as the larger one, as the smaller one."""
    smaller = f"(n * {2 * percent} + {99 + percent}) div {100 + percent}"
    return F.expr(f"(n * {percent} + 99) div 100"), F.expr(smaller)


def _counted(sets: DataFrame) -> DataFrame:
    """How often each member occurs, and a set that has it."""
    return sets.select("id", F.explode("members").alias("member")).groupBy("member").agg(
        F.count(F.lit(1)).alias("count"), F.min("id").alias("id")
    )


def _with_own(sets: DataFrame) -> DataFrame:
    """Sets with the number of members that no other set has."""
    own = _counted(sets).where("count = 1").groupBy("id").agg(F.count(F.lit(1)).alias("own"))
    named = sets.drop("own").join(own, "id", "left")
    return named.withColumn("own", F.coalesce("own", F.lit(0).cast("long")))


def candidate_pairs(sets: DataFrame, percent: int, keep: Keep) -> DataFrame:
    """Pairs (a, b), a < b, of sets (id, component, n, members) of different components.

    n is the number of members, which are distinct. Every pair whose intersection holds percent
    of the union or more is among them, unless both are of one component. keep writes a table
    and reads it again.
    """
    as_larger, as_smaller = _least_shared(percent)
    sets = keep(_with_own(sets).where(F.col("own") <= F.col("n") - as_larger), "sets")
    members = sets.select("id", F.explode("members").alias("member"))
    shared = _counted(sets).where("count > 1").select("member", "count")
    # Members that are a set's own come first, so positions of the others follow them.
    whole = Window.partitionBy("id")
    own = F.col("n") - F.count(F.lit(1)).over(whole)
    rank = F.row_number().over(whole.orderBy("count", "member"))
    ranked = members.join(shared, "member").join(sets.select("id", "component", "n"), "id")
    placed = ranked.withColumn("place", own + rank)
    named = keep(
        placed.where(F.col("place") <= F.col("n") - as_larger + 1).select(
            "member", "id", "component", "n", "place",
            (F.col("place") <= F.col("n") - as_smaller + 1).alias("short"),
        ),
        "prefixes",
    )
    # A place beyond the short prefix only serves partners that are enough smaller; where a member
    # has none, or all its sets are of one component, nothing is left to pair.
    fits = (100 + percent) * (F.col("n") - F.col("place") + 1) >= percent * (F.col("least") + F.col("n"))
    near = fits & (100 * F.col("most") >= percent * F.col("n"))
    sizes = named.where("short").groupBy("member").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    named = named.join(sizes, "member").where(F.col("short") | near).drop("least", "most")
    mixed = named.groupBy("member").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    named = keep(named.join(mixed.where("x < y").select("member"), "member", "left_semi"), "prefixes")
    # Of each member the component that most of its sets are of stands apart: its sets meet those
    # of others only, never each other.
    groups = named.groupBy("member", "component").agg(F.count(F.lit(1)).alias("sets"))
    major = groups.groupBy("member").agg(F.max(F.struct("sets", "component")).alias("major"))
    marked = named.join(major, "member").withColumn("in_major", F.col("component") == F.col("major.component"))
    small = marked.where("short").drop("major", "short")
    large = marked.select(
        "member", F.col("component").alias("component_b"), F.col("id").alias("id_b"),
        F.col("n").alias("n_b"), F.col("place").alias("place_b"), F.col("in_major").alias("in_major_b"),
    )
    n, n_b = F.col("n"), F.col("n_b")
    # At the first member that two sets share, what follows it bounds what they share.
    most = F.least(n - F.col("place"), n_b - F.col("place_b")) + 1
    near = (
        (F.col("component") != F.col("component_b"))
        & (n <= n_b)
        & (100 * n >= percent * n_b)
        & ((100 + percent) * most >= percent * (n + n_b))
    )

    def met(smaller: DataFrame, larger: DataFrame) -> DataFrame:
        found = smaller.join(larger, "member").where(near)
        return found.select(F.least("id", "id_b").alias("a"), F.greatest("id", "id_b").alias("b"))

    others = met(small.where("NOT in_major"), large)
    return others.unionAll(met(small.where("in_major"), large.where("NOT in_major_b"))).distinct()
