"""Fitted forests as tables: nodes, scoring by expressions, rows of every leaf.

The node table has one row per node of a model, so its size is bounded by the
model's settings (trees and depth), whatever it was trained on.  A frame is
scored by walking that table, which a plan holds as one scalar value; no row is
shuffled and no model object is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.session import scratch_path


def node_table(spark: SparkSession, forest) -> DataFrame:
    """Nodes of a fitted forest: ``tree, node, value, stats, rows, left, right, feature, cut, categories``.

    ``node`` counts from 0 (the root) without gaps.  A leaf has no children
    (-1).  ``stats`` holds the weight per class, or count, sum and sum of
    squares.  ``categories`` is -1 for a split at ``cut[0]``, else ``cut``
    lists the categories that go left.
    """
    path = scratch_path(spark, "forest")
    forest.write().save(path)
    node = F.col("nodeData")
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        node["prediction"].alias("value"),
        node["impurityStats"].alias("stats"),
        node["rawCount"].alias("rows"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        node["split"]["featureIndex"].alias("feature"),
        node["split"]["leftCategoriesOrThreshold"].alias("cut"),
        node["split"]["numCategories"].alias("categories"),
    )


def _trees(nodes: DataFrame) -> Column:
    """All trees as one value: an array of trees, each the array of its nodes by number."""
    node = F.struct(*[F.col(c) for c in ("node", *[c for c in nodes.columns if c not in ("tree", "node")])])
    trees = nodes.groupBy("tree").agg(F.sort_array(F.collect_list(node)).alias("nodes"))
    return trees.agg(F.sort_array(F.collect_list(F.struct("tree", "nodes")))).scalar()


def _leaf(nodes: Column, inputs: Column, depth: int) -> Column:
    """Number of the node at which a row ends; a leaf stays where it is."""

    def step(at: Column, _: Column) -> Column:
        node = F.get(nodes, at)
        value = F.get(inputs, node["feature"])
        left = F.when(node["categories"] >= 0, F.array_contains(node["cut"], value)).otherwise(
            value <= F.get(node["cut"], F.lit(0))
        )
        return F.when(node["left"] < 0, at).when(left, node["left"]).otherwise(node["right"])

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step)


def with_leaves(rows: DataFrame, nodes: DataFrame, inputs: Column, depth: int) -> DataFrame:
    """``rows`` and the leaf they reach in every tree, as ``leaves`` (one struct per tree).

    ``inputs`` is an array of doubles in the order of the model's features;
    ``depth`` the largest depth of a tree (at least 1).
    """
    placed = rows.withColumns({"forest_trees": _trees(nodes), "forest_inputs": inputs})
    leaves = F.transform(
        F.col("forest_trees"),
        lambda t: F.struct(
            t["tree"].alias("tree"),
            F.get(t["nodes"], _leaf(t["nodes"], F.col("forest_inputs"), depth)).alias("leaf"),
        ),
    )
    return placed.withColumn("leaves", leaves).drop("forest_trees", "forest_inputs")


def mean_of_leaves(leaves: Column) -> Column:
    """Regression: mean of the values of a row's leaves."""
    total = F.aggregate(leaves, F.lit(0.0), lambda s, t: s + t["leaf"]["value"])
    return total / F.size(leaves)


def class_shares(leaves: Column, classes: int) -> Column:
    """Classification: share of every class, each tree counting alike."""

    def share(t: Column, c: int) -> Column:
        stats = t["leaf"]["stats"]
        weight = F.aggregate(stats, F.lit(0.0), lambda s, v: s + v)
        return F.coalesce(F.get(stats, F.lit(c)) / F.nullif(weight, F.lit(0.0)), F.lit(0.0))

    def votes(c: int) -> Column:
        return F.aggregate(leaves, F.lit(0.0), lambda s, t: s + share(t, c))

    return F.transform(F.array(*map(votes, range(classes))), lambda v: v / F.size(leaves))


def leaf_means(placed: DataFrame, label: Column) -> DataFrame:
    """Rows and mean label per leaf: ``tree, node, n, mean``.

    Combined before the shuffle: a task sends one row per leaf, however the
    rows are spread over them.
    """
    each = placed.select(label.alias("label"), F.explode("leaves").alias("at"))
    return each.groupBy(
        F.col("at")["tree"].alias("tree"), F.col("at")["leaf"]["node"].alias("node")
    ).agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("mean"))
