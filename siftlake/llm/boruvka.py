"""Problem 3: consolidating pairwise matches into groups by deterministic Borůvka hooking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlake.operators.lookup import salted_join
from siftlake.session import drop_stage, stage


def _hook(edges: DataFrame) -> DataFrame:
    """Every component's smallest outgoing edge: ``(node, parent)``.

    Edges are ordered by (smaller end, larger end), so a component's smallest edge leads to its
    smallest neighbour.  The minimum is taken before the shuffle as well, so a hub costs no more
    than any other component.
    """
    ends = F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("to")), F.struct(F.col("b").alias("node"), F.col("a").alias("to")))
    return edges.select(F.inline(ends)).groupBy("node").agg(F.min("to").alias("parent"))


def _collapse(hooks: DataFrame, count: int) -> DataFrame:
    """Turn the hooks into stars by pointer doubling.

    Two components that chose the same edge point at each other; the smaller becomes the root.  As the
    edges have a total order, there are no longer cycles.
    """
    up = hooks.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
    mutual = F.col("above") == F.col("node")
    trees = stage(
        salted_join(hooks, up, "parent", count=count).select(
            "node",
            F.when(mutual & (F.col("node") < F.col("parent")), F.col("node")).otherwise(F.col("parent")).alias("parent"),
            F.lit(True).alias("moved"),
        ),
        "trees",
    )
    while True:
        up = trees.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        doubled = stage(
            salted_join(trees.select("node", "parent"), up, "parent", count=count).select(
                "node", F.col("above").alias("parent"), (F.col("above") != F.col("parent")).alias("moved")
            ),
            "trees",
        )
        drop_stage(trees)
        trees = doubled
        if not trees.filter("moved").limit(1).count():
            return trees.select("node", "parent")


def boruvka_components(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Connected components of undirected ``pairs``: one row ``(node, component)`` per linked node.

    ``component`` is the smallest node of the component.  Ids may be of any ordered type.  Pairs with a
    null end, pairs of a node with itself and repeated pairs add nothing; nodes without a pair to
    another node have no row; no pairs give no rows.  The result depends on the set of pairs only.

    Each round every component selects its smallest outgoing edge, the trees collapse by pointer
    doubling, and the edges are renamed to component roots, freed of loops and deduplicated, until none
    remain.  A round at least halves the components that have edges, so there are at most log2(nodes)
    rounds, each on a smaller graph.  Every step is staged in the shared folder; only row counts
    reach the driver.
    """
    spark = pairs.sparkSession
    a, b = F.col(left), F.col(right)
    edges = stage(
        pairs.filter(a.isNotNull() & b.isNotNull() & (a != b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(),
        "edges",
    )
    rounds: list[tuple[DataFrame, int]] = []
    left_over = edges.count()
    while left_over:
        roots = _collapse(stage(_hook(edges), "hooks"), 2 * left_over)
        rounds.append((roots, 2 * left_over))
        to_a = roots.select(F.col("node").alias("a"), F.col("parent").alias("root_a"))
        to_b = roots.select(F.col("node").alias("b"), F.col("parent").alias("root_b"))
        renamed = salted_join(salted_join(edges, to_a, "a", "inner", left_over), to_b, "b", "inner", left_over)
        smaller = stage(
            renamed.filter("root_a <> root_b")
            .select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b"))
            .distinct(),
            "edges",
        )
        drop_stage(edges)
        edges, left_over = smaller, smaller.count()
    if not rounds:
        kind = edges.schema["a"].dataType
        return spark.createDataFrame([], "node string, component string").select(
            F.col("node").cast(kind), F.col("component").cast(kind)
        )
    found, most = rounds.pop()
    while rounds:  # compose the rounds backwards: the later, smaller maps first
        above = found.select(F.col("node").alias("parent"), F.col("parent").alias("root"))
        (earlier, most) = rounds.pop()
        found = salted_join(earlier, above, "parent", count=most).select("node", F.coalesce("root", "parent").alias("parent"))
    found = stage(found, "components")
    smallest = found.groupBy("parent").agg(F.min(F.least("node", "parent")).alias("component"))
    return salted_join(found, smallest, "parent", "inner", most).select("node", "component")
