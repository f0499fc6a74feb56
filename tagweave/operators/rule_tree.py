"""Antecedents as a prefix tree that every basket walks.

Items are coded by rising frequency, so an antecedent begins with its rarest item
and most baskets leave the tree at its root. A node's edges are rows, so a frequent
item may begin any number of antecedents; a walk takes one join a level, and a
basket holds only the items that antecedents are made of.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.operators.lookup import HEAVY_KEYS, heavy_by_count, heavy_by_rank, lookup
from tagweave.operators.ordering import ordered_index
from tagweave.operators.rows import explode_rows
from tagweave.operators.skew import skew_join
from tagweave.sources.tables import materialize

ROOT = -1


@dataclass(frozen=True)
class RuleTree:
    """Written tables: ``item, code`` and ``node, code, child, rule, inner, rank``.

    ``rule`` is the antecedent that ends at ``child``, if one does, and ``inner``
    says whether the child has edges of its own. ``rank`` orders
    many edges by how many baskets can reach them. ``small`` says that all edges, rows
    of fixed width, are few enough to be broadcast.
    """

    items: DataFrame
    edges: DataFrame
    n_items: int
    depth: int
    small: bool


def build_tree(antecedents: DataFrame, frequencies: DataFrame) -> RuleTree:
    """The tree of a written table ``rule, antecedent`` of distinct item sets.

    ``frequencies`` has ``item, freq``; items that it lacks count as the rarest.
    """
    long = explode_rows(antecedents, ["rule"], F.array_distinct("antecedent"), "item")
    used = long.groupBy("item").agg(F.count("*").alias("uses")).join(frequencies, "item", "left")
    used = used.select("item", F.coalesce("freq", F.lit(0)).cast("long").alias("freq"), "uses")
    items = materialize(ordered_index(used, [F.asc("freq"), F.asc("item")], "code"), "rule-items")
    coded = lookup(long, items, ["item"], heavy_by_count(items, "uses"), "rule")
    sorted_pairs = F.sort_array(F.collect_list(F.struct("code", "freq")))
    paths = materialize(coded.groupBy("rule").agg(sorted_pairs.alias("pairs")), "rule-paths")
    codes = F.transform("pairs", lambda p: p["code"])
    whole = paths.select("rule", codes.alias("codes"), F.col("pairs")[0]["freq"].alias("reach"))
    prefixes = F.transform(F.sequence(F.lit(1), F.size("codes")), lambda n: F.slice("codes", F.lit(1), n))
    nodes = (
        whole.select("rule", "codes", "reach", F.explode(prefixes).alias("path"))
        .groupBy("path")
        .agg(
            F.max(F.when(F.col("path") == F.col("codes"), F.col("rule"))).alias("rule"),
            F.max(F.size("path") < F.size("codes")).alias("inner"),
            F.max("reach").alias("reach"),
        )
    )
    nodes = materialize(nodes.withColumn("child", F.monotonically_increasing_id()), "rule-nodes")
    parents = nodes.select("path", F.col("child").alias("node"))
    ends = nodes.select(
        F.slice("path", F.lit(1), F.size("path") - 1).alias("path"), F.element_at("path", -1).alias("code"), "child", "rule", "inner", "reach"
    )
    edges = skew_join(ends, parents, ["path"], "left").select(F.coalesce("node", F.lit(ROOT)).alias("node"), "code", "child", "rule", "inner", "reach")
    depth, n = nodes.agg(F.coalesce(F.max(F.size("path")), F.lit(0)), F.count("*")).first()
    small = n <= HEAVY_KEYS
    ranked = edges.withColumn("rank", F.lit(0)) if small else ordered_index(edges, [F.desc("reach"), F.asc("child")], "rank")
    return RuleTree(items, materialize(ranked.drop("reach"), "rule-edges"), items.count(), depth, small)


def match_rules(baskets: DataFrame, tree: RuleTree, row: str, items: str) -> DataFrame:
    """``<row>, rule``: every antecedent that a basket holds; ``row`` numbers the baskets.

    A null or empty basket holds none, and neither does any basket if the tree is
    empty.
    """
    none = baskets.sparkSession.createDataFrame([], f"{row} long, rule long")
    if tree.depth == 0:
        return none
    exploded = explode_rows(baskets.select(row, F.array_distinct(items).alias("_items")), [row], "_items", "item")
    frequent = tree.items.select("item", "code", "freq")
    cut = lookup(exploded, frequent, ["item"], F.col("code") >= tree.n_items - HEAVY_KEYS, row)
    coded = cut.where(F.col("code").isNotNull()).groupBy(row).agg(F.sort_array(F.collect_list("code")).alias("codes"))
    coded = materialize(coded, "coded-baskets")
    edges = tree.edges.select("node", "code", "child", "rule", "inner", "rank")
    state, found = coded.select(row, "codes", F.lit(ROOT).cast("long").alias("node"), F.lit(-1).alias("last")), []
    for level in range(1, tree.depth + 1):
        later = F.filter("codes", lambda c: c > F.col("last"))
        if tree.small:  # the codes stay in the row, which no shuffle moves
            step = state.select(row, "codes", "node", F.explode(later).alias("code"))
            met = step.join(F.broadcast(edges), ["node", "code"])
        else:
            step = state.select(row, "node", F.explode(later).alias("code"))
            met = lookup(step, edges, ["node", "code"], heavy_by_rank("rank"), row).where(F.col("child").isNotNull())
            met = met.join(coded, row)
        # Where a path ends, its codes are not carried on.
        state = met.select(row, F.when(F.col("inner"), F.col("codes")).alias("codes"), F.col("child").alias("node"), F.col("code").alias("last"), "rule", "inner")
        state = materialize(state, f"rule-walk-{level}")
        found.append(state.where(F.col("rule").isNotNull()).select(row, "rule"))
        state = state.where("inner").drop("rule", "inner")
    matched = found[0]
    for more in found[1:]:
        matched = matched.unionByName(more)
    return matched
