"""Edges, closures, cycles, trees and frontiers.

Recursion runs as a loop over frontiers: each round joins only the new nodes with the edges and leaves out what was seen.
"""

from __future__ import annotations

from itertools import count

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltloom.common import durable
from siltloom.functions.code import resolve_path


def import_edges(imports: DataFrame, files: DataFrame) -> DataFrame:
    """(src, dst): relative imports resolved beside their file, where such a file exists."""
    @F.pandas_udf("string")
    def target(path: pd.Series, module: pd.Series) -> pd.Series:
        return pd.Series([resolve_path(p, m) if p and m else None for p, m in zip(path, module)])

    edges = imports.where(F.col("module_name").startswith(".")).select(F.col("file").alias("src"), target("file", "module_name").alias("dst")).distinct()
    return edges.join(files.select(F.col("file").alias("dst")).distinct(), "dst", "left_semi").select("src", "dst")


def reference_edges(units: DataFrame, symbols: DataFrame, exclude: bool = True) -> DataFrame:
    """(src, ref_type, dst): declared symbols of the same file that a unit's content names.

    With ``exclude`` the unit itself and the file's base name are left out.
    """
    from siltloom.operators.relational import uses

    used = uses(units.select("unit_id", "file", "content"), symbols.select("file", "name", "ref_type"))
    if not exclude:
        return used.select(F.col("unit_id").alias("src"), "ref_type", F.col("name").alias("dst")).distinct()
    named = used.join(units.select("unit_id", F.col("name").alias("own")), "unit_id")
    base = F.regexp_extract("file", r"([^/]*?)(?:\.[^./]*)?$", 1)
    return named.where((F.coalesce(F.col("own"), F.lit("")) != F.col("name")) & (F.col("name") != base)).select(F.col("unit_id").alias("src"), "ref_type", F.col("name").alias("dst")).distinct()


def closure(edges: DataFrame, roots: DataFrame, max_depth: int | None = None) -> DataFrame:
    """(root, node, depth): every node reachable from each root with its least depth, the root at 0; cycles end by themselves.

    ``max_depth`` is for callers that ask for nodes up to a depth only.
    """
    edges = durable(edges.select("src", "dst").distinct())
    seen = durable(roots.select(F.col("root"), F.col("root").alias("node"), F.lit(0).alias("depth")).distinct())
    frontier = seen
    for depth in count(1) if max_depth is None else range(1, max_depth + 1):
        step = frontier.join(edges, frontier["node"] == edges["src"]).select("root", F.col("dst").alias("node")).distinct()
        frontier = durable(step.join(seen.select("root", "node"), ["root", "node"], "left_anti").withColumn("depth", F.lit(depth)))
        if not frontier.limit(1).count():
            break
        seen = durable(seen.unionByName(frontier))
    return seen


def _peeled(edges: DataFrame) -> DataFrame:
    """The edges left after nodes without an edge in or out are taken away again and again."""
    left = durable(edges)
    n = left.count()
    while n:
        ahead = left.join(left.select(F.col("src").alias("dst")).distinct(), "dst", "left_semi")
        left = durable(ahead.join(ahead.select(F.col("dst").alias("src")).distinct(), "src", "left_semi").select("src", "dst"))
        n, before = left.count(), n
        if n == before:
            break
    return left


def cyclic_nodes(edges: DataFrame) -> DataFrame:
    """(node): nodes that lie on a cycle; those that only lie between two cycles do not.

    Nodes outside all cycles are peeled off first.  Then every node takes the greatest id that reaches it; the nodes of one
    such colour that reach the colour's own node are its strong component.  Components are taken out and the rest starts again.
    """
    left = _peeled(edges.select("src", "dst").distinct())
    found: DataFrame | None = None
    while left.limit(1).count():
        colours = durable(left.select(F.col("src").alias("id")).unionByName(left.select(F.col("dst").alias("id"))).distinct().withColumn("colour", F.col("id")))
        while True:
            seen = left.join(colours.withColumnRenamed("id", "src"), "src").groupBy(F.col("dst").alias("id")).agg(F.max("colour").alias("seen"))
            new = durable(colours.join(seen, "id", "left").select("id", F.col("colour").alias("old"), F.greatest("colour", "seen").alias("colour")))
            colours = new.select("id", "colour")
            if not new.where("colour > old").limit(1).count():
                break
        ends = left.join(colours.select(F.col("id").alias("src"), F.col("colour").alias("c")), "src").join(colours.select(F.col("id").alias("dst"), F.col("colour").alias("d")), "dst")
        back = durable(ends.where("c = d").select("src", "dst"))
        part = durable(colours.where("id = colour"))
        frontier = part
        while frontier.limit(1).count():
            step = back.join(frontier.withColumnRenamed("id", "dst"), "dst").select(F.col("src").alias("id"), "colour").distinct()
            frontier = durable(step.join(part.select("id"), "id", "left_anti"))
            part = durable(part.unionByName(frontier))
        several = part.groupBy("colour").agg(F.count("*").alias("n")).where("n > 1").select("colour")
        alone = left.where("src = dst").select(F.col("src").alias("id"))
        nodes = durable(part.join(several, "colour", "left_semi").select("id").unionByName(part.select("id").join(alone, "id", "left_semi")).distinct())
        found = nodes if found is None else found.unionByName(nodes)
        rest = left.join(part.select(F.col("id").alias("src")), "src", "left_anti").join(part.select(F.col("id").alias("dst")), "dst", "left_anti")
        left = _peeled(rest.select("src", "dst"))
    nodes = found if found is not None else edges.select(F.col("src").alias("id")).where("false")
    return nodes.select(F.col("id").alias("node")).distinct()


def leaves(nodes: DataFrame) -> DataFrame:
    """Nodes of a (id, parent) tree that are no parent."""
    return nodes.join(nodes.where("parent is not null").select(F.col("parent").alias("id")).distinct(), "id", "left_anti")


def frontier_crawl(links: DataFrame, seeds: DataFrame, depth: int = 3) -> DataFrame:
    """(url, parent, depth): breadth-first visits up to ``depth``, each page once, by its smallest parent."""
    links = durable(links.select("src", "dst").distinct())
    seen = durable(seeds.select(F.col("url"), F.lit(None).cast("string").alias("parent"), F.lit(0).alias("depth")).distinct())
    frontier = seen
    for d in range(1, depth + 1):
        step = frontier.join(links, frontier["url"] == links["src"]).groupBy(F.col("dst").alias("url")).agg(F.min("src").alias("parent"))
        frontier = durable(step.join(seen.select("url"), "url", "left_anti").withColumn("depth", F.lit(d)))
        seen = durable(seen.unionByName(frontier.select("url", "parent", "depth")))
    return seen
