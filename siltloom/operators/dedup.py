"""Exact and near-duplicate removal with the rules of first occurrence and of greedy order.

Greedy order is not connected components: an item is dropped only where an earlier item that was kept is like it.
``greedy`` settles that from the edges (earlier, later) in rounds, the lexicographically first maximal independent set.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltloom.common import durable, spread
from siltloom.functions import similarity


def keep_first(df: DataFrame, keys: list[str | Column], order: list[str]) -> DataFrame:
    """One row per key, the first in the order; ties go to the order's further columns.

    An aggregate, not a window: of a key that a third of all rows share each partition sends one row.
    """
    first = F.min_by(F.struct(*df.columns), F.struct(*order)).alias("__r")
    return df.groupBy(*keys).agg(first).select("__r.*")


def exact(df: DataFrame, text: str, order: str) -> DataFrame:
    """Rows whose text occurs under no smaller order key; null texts are all kept.

    The hash is aggregated to its smallest key before anything is joined, so a text that a third of all rows share is
    one row per partition in the shuffle.
    """
    keys = df.where(F.col(text).isNotNull()).groupBy(F.md5(F.col(text)).alias("__h")).agg(F.min(order).alias(order)).select(order)
    return df.join(keys, order, "left_semi").unionByName(df.where(F.col(text).isNull()))


def exact_in_group(df: DataFrame, prefix: str, content: str, number: str) -> DataFrame:
    """The lowest-numbered row per (prefix, md5 of the content)."""
    return keep_first(df, [F.col(prefix).alias("__k"), F.md5(F.col(content)).alias("__h")], [number])


def greedy(nodes: DataFrame, edges: DataFrame, key: str = "id") -> DataFrame:
    """The kept nodes; ``edges`` has earlier and later, by the nodes' order.

    Each round keeps the undecided nodes all of whose earlier neighbours are dropped, and drops the undecided ones that
    have a kept earlier neighbour.  Only nodes with edges take part; each round's state is written.
    """
    touched = edges.select(F.col("earlier").alias(key)).unionByName(edges.select(F.col("later").alias(key))).distinct()
    state = durable(touched.withColumn("state", F.lit(None).cast("boolean")))
    edges = durable(edges.select("earlier", "later").distinct())
    while True:
        before = edges.join(state.select(F.col(key).alias("earlier"), F.col("state").alias("known")), "earlier")
        seen = before.groupBy("later").agg(F.max(F.coalesce("known", F.lit(False))).alias("any_kept"), F.min(F.coalesce(~F.col("known"), F.lit(False))).alias("all_dropped"))
        joined = state.join(seen.withColumnRenamed("later", key), key, "left")
        decided = F.when(F.col("state").isNotNull(), F.col("state")).when(F.coalesce("any_kept", F.lit(False)), F.lit(False)).when(F.coalesce("all_dropped", F.lit(True)), F.lit(True))
        state = durable(joined.select(key, decided.alias("state")))
        if not state.where("state is null").limit(1).count():
            break
    return nodes.join(state.where("not state").select(key), key, "left_anti")


def ratio_edges(df: DataFrame, key: str = "id", text: str = "text", threshold: float = 0.9, within: str | None = None) -> DataFrame:
    """(earlier, later): pairs of texts, equal ones too, whose sequence ratio, the later as first argument, is above the threshold.

    Two texts above the threshold have lengths within (2-t)/t of each other, so they lie in the same or in neighbouring
    length classes of that factor; shorter texts than 3 signs are compared exactly.  What meets is verified with lossless
    bounds first.  ``within`` restricts pairs to one file or group.
    """
    factor = (2 - threshold) / threshold
    made = df.where(F.col(text).isNotNull()).select(F.col(key).alias("id"), F.col(text).alias("text"), (F.col(within) if within else F.lit(0)).alias("w"), F.floor(F.log(F.length(text) + 1.0) / F.lit(__import__("math").log(factor))).cast("int").alias("c"))
    left = made.withColumn("meet", F.explode(F.array(F.col("c"), F.col("c") + 1)))
    right = made.withColumn("meet", F.explode(F.array(F.col("c"), F.col("c") + 1)))
    a = left.select(F.col("id").alias("earlier"), F.col("text").alias("ta"), "w", "meet", F.col("c").alias("ca"))
    b = right.select(F.col("id").alias("later"), F.col("text").alias("tb"), "w", "meet", F.col("c").alias("cb"))
    pairs = a.join(b, ["w", "meet"]).where((F.col("earlier") < F.col("later")) & (F.col("meet") == F.greatest("ca", "cb")) & (2 * F.least(F.length("ta"), F.length("tb")) > threshold * (F.length("ta") + F.length("tb"))))

    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            keep = [similarity.above(b, a, threshold) for a, b in zip(f["ta"], f["tb"])]
            yield f.loc[keep, ["earlier", "later"]]

    kind = dict(df.dtypes)[key]
    return pairs.select("earlier", "later", "ta", "tb").mapInPandas(verify, f"earlier {kind}, later {kind}")


def ratio_dedup(df: DataFrame, key: str = "id", text: str = "text", threshold: float = 0.9, within: str | None = None) -> DataFrame:
    """The rows kept when texts are taken in key order and one is dropped that is above the threshold to any kept text.

    Equal texts are collapsed first (equal means ratio 1.0); null texts are kept.
    """
    first = keep_first(df.where(F.col(text).isNotNull()), [(F.col(within) if within else F.lit(0)).alias("__k"), F.md5(text).alias("__h")], [key])
    kept = greedy(first, ratio_edges(first, key, text, threshold, within), key)
    return kept.unionByName(df.where(F.col(text).isNull()))


def comment_blind_dedup(df: DataFrame, key: str = "id", text: str = "code", threshold: float = 0.9, within: str | None = None) -> DataFrame:
    """The rows kept by ``ratio_dedup`` of their texts without comments; the rows themselves stay as they are."""
    from siltloom.functions.code import strip_comments_column

    bare = df.select(key, *([within] if within else []), strip_comments_column(F.col(text)).alias("__bare"))
    return df.join(ratio_dedup(bare, key, "__bare", threshold, within).select(key), key, "left_semi")


def audit(df: DataFrame, key: str = "id", text: str = "text", threshold: float = 0.9) -> DataFrame:
    """Every pair above the threshold with its ratio, most alike first."""
    edges = ratio_edges(df, key, text, threshold)
    texts = df.select(F.col(key).alias("k"), F.col(text).alias("t"))
    both = edges.join(texts.select(F.col("k").alias("earlier"), F.col("t").alias("a")), "earlier").join(texts.select(F.col("k").alias("later"), F.col("t").alias("b")), "later")

    @F.pandas_udf("double")
    def measured(b: pd.Series, a: pd.Series) -> pd.Series:
        return pd.Series([similarity.ratio(x, y) for x, y in zip(b, a)])

    return both.select("earlier", "later", measured("b", "a").alias("ratio")).orderBy(F.desc("ratio"), "earlier", "later")


def simhash_column(text: Column) -> Column:
    @F.pandas_udf("long")
    def call(s: pd.Series) -> pd.Series:
        return s.map(similarity.simhash, na_action="ignore").astype("Int64")

    return call(text)


def _signatures(df: DataFrame, key: str, text: str) -> DataFrame:
    """(id, sig) of the rows that have a text, made once."""
    return durable(spread(df.where(F.col(text).isNotNull()).select(key, text)).select(F.col(key).alias("id"), simhash_column(F.col(text)).alias("sig")))


def _close(firsts: DataFrame, distance: int) -> DataFrame:
    """(earlier, later) of distinct signatures within ``distance`` bits.

    The bits are cut into distance + 3 blocks, of which close signatures share three whole: they meet under the blocks of one
    of all such choices, about half of the bits, so that few others do.
    """
    n = distance + 3
    cuts = [round(i * 64 / n) for i in range(n + 1)]
    masks = [sum(((1 << b) - 1) ^ ((1 << a) - 1) for a, b in (cuts[i : i + 2] for i in chosen)) for chosen in combinations(range(n), 3)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = firsts.withColumn("meet", F.explode(F.array(*[F.struct(F.lit(i).alias("n"), F.col("sig").bitwiseAND(F.lit(m)).alias("v")) for i, m in enumerate(signed)])))
    a = keyed.select("meet", F.col("id").alias("earlier"), F.col("sig").alias("sa"))
    b = keyed.select("meet", F.col("id").alias("later"), F.col("sig").alias("sb"))
    near = a.join(b, "meet").where((F.col("earlier") < F.col("later")) & (F.bit_count(F.col("sa").bitwiseXOR(F.col("sb"))) <= distance))
    return near.select("earlier", "later").distinct()


def simhash_edges(df: DataFrame, key: str = "id", text: str = "text", distance: int = 3) -> DataFrame:
    """(earlier, later) within ``distance`` bits; rows of equal signatures are linked to their first row only, so that a hot
    signature gives no square of pairs."""
    signed = _signatures(df, key, text)
    firsts = signed.groupBy("sig").agg(F.min("id").alias("id"))
    same = signed.join(firsts.withColumnRenamed("id", "earlier"), "sig").where("id > earlier").select("earlier", F.col("id").alias("later"))
    return _close(firsts, distance).unionByName(same)


def simhash_dedup(df: DataFrame, key: str = "id", text: str = "text", distance: int = 3) -> DataFrame:
    """Greedy in key order: a row goes where its signature is within ``distance`` bits of an earlier kept one.

    Rows of one signature stand or fall with the first of them, so they take its links.
    """
    firsts = durable(_signatures(df, key, text).groupBy("sig").agg(F.min("id").alias("id")))
    kept = greedy(firsts, _close(firsts, distance), "id").select(F.col("id").alias(key))
    return df.join(kept, key, "left_semi").unionByName(df.where(F.col(text).isNull()))


def dedup_statistics(df: DataFrame, text: str, group: str) -> DataFrame:
    """(group, total, distinct_texts, duplicates, missing) in one aggregate; texts are told apart by md5."""
    out = df.groupBy(group).agg(F.count("*").alias("total"), F.count_distinct(F.md5(text)).alias("distinct_texts"), F.count(F.when(F.col(text).isNull(), 1)).alias("missing"))
    return out.withColumn("duplicates", F.col("total") - F.col("missing") - F.col("distinct_texts"))


def perceptual_match(images: DataFrame, references: list[int], distance: int = 5) -> DataFrame:
    """Adds ``matched``: whether the hash is within ``distance`` bits of one of a few reference hashes."""
    near = [F.bit_count(F.col("phash").bitwiseXOR(F.lit(r))) <= distance for r in references]
    out = F.lit(False)
    for n in near:
        out = out | n
    return images.withColumn("matched", out)
