"""Connected components of a large set of links by alternating star operations.

Each round links every node's larger neighbours to its smallest one, then every node
and its smaller neighbours to the smallest of them (Kiveris et al., Connected
Components in MapReduce and Beyond, 2014). The number of rounds grows with the
logarithm of the longest path. Minima are combined map-side, joins are guarded
against hot nodes, and each round is cut by a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amendry.operators.joins import guarded_join
from amendry.sources.workspace import Workspace


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return guarded_join(both.filter("b > a"), least, [("a", "a")], "inner").selectExpr("b as a", "m as b")


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    joined = guarded_join(links, least, [("a", "a")], "inner")
    return joined.selectExpr("inline(array(struct(a, m as b), struct(b as a, m as b)))").filter("a > b")


def components(links: DataFrame, work: Workspace) -> DataFrame:
    """(node, component) for every node of links(a, b), component its smallest connected node.

    a and b are long and never null. Links may repeat, in either direction; a node linked
    to itself only is left out, as is any node without links.
    """
    turn, before = 0, None
    ordered = links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = work.stage(ordered.distinct(), "links_0")
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(state) == before or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before, turn = tuple(state), turn + 1
        now = work.stage(_small_star(_large_star(now).distinct()).distinct(), f"links_{turn}")
