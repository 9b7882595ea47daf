"""Connected components by alternating large and small stars.

Every step needs the least neighbour of each node on each of its edges.  The
edges of a node are dealt over as many salts as there are shuffle partitions,
so a node with a third of all edges is in no task by itself: the least
neighbour is found for each (node, salt), then for each node from those few
rows, and brought back to the edges by (node, salt).  Each step is written to
the shared folder; the driver sees one number a step, never edges.  Two rows
of one edge are made by ``_both`` and not by a union, which would put every
input into the plan twice, and a step holds one step in another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _both(rows: DataFrame, one: dict, other: dict) -> DataFrame:
    """Two rows of each row of ``rows``; the columns and their names in ``one`` and ``other``."""
    either = [F.struct(*[F.expr(x).alias(name) for name, x in row.items()]) for row in (one, other)]
    return rows.select(F.inline(F.array(*either)))


def _hung(edges: DataFrame, both_ways: bool) -> DataFrame:
    """(u, salt, v, m): each edge with the least m of u and its neighbours."""
    both = _both(edges, {"u": "u", "v": "v"}, {"u": "v", "v": "u"}) if both_ways else edges
    salts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = both.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(salts)).cast("int"))
    part = both.groupBy("u", "salt").agg(F.min("v").alias("m"))
    low = part.groupBy("u").agg(F.min("m").alias("m")).withColumn("m", F.least("u", "m"))
    return both.join(part.select("u", "salt").join(low, "u"), ["u", "salt"])


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u, v) with v < u."""
    hung = _hung(edges, large)
    if large:   # neighbours above u hang on the least neighbour
        out = hung.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:       # u and its lower neighbours hang on the least of them
        out = _both(hung, {"u": "v", "v": "m"}, {"u": "u", "v": "m"})
    return out.filter("u <> v")


def _all_stars(edges: DataFrame) -> bool:
    """Each node hangs on one other node at most, and on none that hangs itself."""
    ends = _both(edges, {"node": "u", "hangs": "1", "holds": "0"}, {"node": "v", "hangs": "0", "holds": "1"})
    bad = (ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
           .filter("hangs > 1 or hangs = 1 and holds = 1"))
    return bad.agg(F.count("*")).first()[0] == 0


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node with an edge; a component is named by its least node."""
    state = common.materialise(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "cc")
    while not _all_stars(state):
        step = common.materialise(_stars(_stars(state, True), False).distinct(), "cc")
        common.release(state)
        state = step
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
