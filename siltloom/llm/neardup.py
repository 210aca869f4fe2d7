"""Near-duplicates by meet-in-the-middle ball hashing.

A text is the set of hashes of its triples of consecutive words.  Its fingerprint is a bottom-k sketch: the k
smallest of the set's hashes under one of T orders.  Two fingerprints within the radius (2d elements apart) meet
halfway: each emits all variants that leave out d of its k elements, and both emit the common part.  Variants are
shuffled, pairs that collide are deduplicated and verified on the whole sets, so no pair below the threshold is given.
With k=6, d=2 and T=5 a pair of likeness 0.7 is missed with probability below 0.0012.  That is where one text contains
the other: of the k smallest of the larger set four must lie in the smaller one, which fails with probability 0.256 per
order, and 0.256**5 = 0.0011.  Where the differences are split evenly fewer are missed.
Pairs of sets of eight triples or fewer are never missed.

Texts with equal sets form a class first; only class representatives are fingerprinted.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltloom.common import durable

K, DROP, ORDERS, BLOCK, BROADCAST_ROWS = 6, 2, 5, 64, 200_000
#: Rows of one class that meet in one task.
MEMBERS = 4096


def triple_sets(texts: DataFrame) -> DataFrame:
    """Adds ``triples``, the sorted distinct hashes of the text's word triples; texts without a triple are left out.

    Words are the longest runs of [A-Za-z0-9_].  Null and empty texts have no triple.
    """
    words = texts.withColumn("__w", F.regexp_extract_all("text", F.lit("[A-Za-z0-9_]+"), F.lit(0))).where(F.size("__w") >= 3)
    hashed = words.withColumn("__w", F.transform("__w", lambda x: F.xxhash64(x)))
    triples = F.transform(F.arrays_zip(F.expr("slice(__w, 1, size(__w) - 2) as a"), F.expr("slice(__w, 2, size(__w) - 2) as b"), F.expr("slice(__w, 3, size(__w) - 2) as c")), lambda x: F.xxhash64(x["a"], x["b"], x["c"]))
    return hashed.withColumn("triples", F.array_sort(F.array_distinct(triples))).drop("__w", "text")


def _sketch(order: int) -> Column:
    """One order's fingerprint: the K smallest of the set's hashes under it."""
    return F.slice(F.array_sort(F.transform("triples", lambda x: F.xxhash64(x, F.lit(order)))), 1, K).alias(f"s{order}")


def _combos(order: int) -> Column:
    """The variants of one order's fingerprint: the hashes of its parts that leave out DROP elements."""
    name = f"s{order}"
    made = [F.when(F.size(name) > max(c), F.xxhash64(F.lit(order), *[F.get(name, F.lit(i)) for i in c])) for c in combinations(range(K), K - DROP)]
    # sets of one or two triples: equal sets are one class already, and no other likeness reaches the threshold;
    # sets of three and four may be alike by three, which is fewer than a variant holds
    if order == 0:
        made += [F.when((F.size(name) <= 4) & (F.size(name) > max(c)), F.xxhash64(F.lit(-1), *[F.get(name, F.lit(i)) for i in c])) for c in combinations(range(4), 3)]
    return F.filter(F.array(*made), lambda x: x.isNotNull())


def fingerprints(texts: DataFrame) -> DataFrame:
    """(source_table, row_id, class_id, s0, s1, ...) of every text with a triple; the class is the hash of table and set."""
    sets = triple_sets(texts).withColumn("class_id", F.xxhash64("source_table", "triples", F.hash("triples")))
    return sets.select("source_table", "row_id", "class_id", *[_sketch(t) for t in range(ORDERS)])


def representatives(prints: DataFrame) -> DataFrame:
    """(class_id, source_table, row_id, n): each class with its smallest row and its number of rows."""
    return prints.groupBy("class_id").agg(F.min("row_id").alias("row_id"), F.first("source_table").alias("source_table"), F.count("*").alias("n"))


def candidates(prints: DataFrame) -> DataFrame:
    """(a, b): pairs of class ids, a < b, that share a variant; each once.

    A variant that two classes share gives its pair from the aggregate itself.  Of more classes the lists are made,
    and where a variant is shared by more than BLOCK classes it is cut into blocks of about that many, each pair of
    blocks in a group of its own: no group is ever gathered whole.  Rows of one class emit the same variants, so they
    are dropped to one before.
    """
    one = prints.dropDuplicates(["class_id"])
    variants = one.select("class_id", F.explode(F.concat(*[_combos(t) for t in range(ORDERS)])).alias("variant"))
    # nearly all variants occur once: aggregating before the shuffle would only widen the rows
    counted = durable(variants.repartition("variant").groupBy("variant").agg(F.count("*").alias("n"), F.min("class_id").alias("lo"), F.max("class_id").alias("hi")).where("n > 1 and lo < hi"))
    two = counted.where("n = 2").select(F.col("lo").alias("a"), F.col("hi").alias("b"))
    many = variants.join(counted.where("n > 2").select("variant", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "variant")
    own = many.withColumn("own", F.pmod(F.xxhash64("class_id", F.lit(99)), F.col("blocks")).cast("int"))
    spread = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    grouped = spread.groupBy("variant", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y")).agg(F.array_sort(F.collect_set("class_id")).alias("ids")).select("ids").distinct()
    pairs = grouped.select("ids", F.posexplode("ids").alias("i", "a")).select("a", F.explode(F.expr("slice(ids, i + 2, size(ids))")).alias("b"))
    return two.unionByName(pairs).distinct()


def similar_classes(texts: DataFrame, prints: DataFrame, firsts: DataFrame, threshold: float = 0.7) -> DataFrame:
    """(a, b, likeness): pairs of classes of one table whose sets' Jaccard likeness reaches the threshold.

    Only the sets of candidates' representatives are made again, from the texts.  Their keys are broadcast where they
    are counted to be few (BROADCAST_ROWS), and joined by shuffle otherwise.
    """
    found = durable(candidates(prints))
    ends = found.select(F.col("a").alias("class_id")).unionByName(found.select(F.col("b").alias("class_id"))).distinct()
    row = F.xxhash64("source_table", "row_id").alias("__row")
    keys = durable(firsts.join(ends, "class_id", "left_semi").select(row, "class_id", F.col("row_id").alias("__own")))
    if keys.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    chosen = texts.withColumn("__row", row).join(keys, "__row").where("row_id = __own").drop("__row", "__own")
    needed = durable(triple_sets(chosen).dropDuplicates(["class_id"]))
    left = needed.select(F.col("class_id").alias("a"), F.col("triples").alias("ta"), F.col("source_table").alias("sa"))
    right = needed.select(F.col("class_id").alias("b"), F.col("triples").alias("tb"), F.col("source_table").alias("sb"))
    both = found.join(left, "a").join(right, "b").where("sa = sb")
    likeness = both.withColumn("common", F.size(F.array_intersect("ta", "tb"))).select("a", "b", (F.col("common") / (F.size("ta") + F.size("tb") - F.col("common"))).alias("likeness"))
    return likeness.where(F.col("likeness") >= threshold)


def similar_pairs(texts: DataFrame, threshold: float = 0.7) -> DataFrame:
    """(source_table, row_a, row_b), row_a < row_b: all pairs of rows of one table above the threshold.

    ``texts`` has source_table, row_id (unique within its table) and text.  Rows with equal sets are pairs too; rows
    without a triple are in none.
    """
    texts = texts.select("source_table", "row_id", "text")
    prints = durable(fingerprints(texts))
    firsts = durable(representatives(prints))
    links = similar_classes(texts, prints, firsts, threshold).select("a", "b")
    repeated = firsts.where("n > 1").select(F.col("class_id").alias("a"), F.col("class_id").alias("b"))
    # a class of many rows is cut into blocks of about MEMBERS rows, and each pair of blocks is a join key of its own
    blocks = firsts.select("class_id", F.ceil(F.col("n") / MEMBERS).cast("int").alias("blocks"))
    many = blocks.where("blocks > 1")
    known = many.agg(F.count("*").alias("c")).first()["c"]
    rows = prints.select("source_table", "row_id", "class_id")
    if known:
        rows = rows.join(many, "class_id", "left").withColumn("block", F.coalesce(F.pmod(F.xxhash64("row_id"), F.col("blocks")), F.lit(0)).cast("int")).drop("blocks")
    else:
        rows = rows.withColumn("block", F.lit(0))
    sides = links.unionByName(repeated)
    if known:
        sides = sides.join(many.select(F.col("class_id").alias("a"), F.col("blocks").alias("na")), "a", "left").join(many.select(F.col("class_id").alias("b"), F.col("blocks").alias("nb")), "b", "left")
        sides = sides.withColumn("x", F.explode(F.sequence(F.lit(0), F.coalesce("na", F.lit(1)) - 1))).withColumn("y", F.explode(F.sequence(F.lit(0), F.coalesce("nb", F.lit(1)) - 1))).drop("na", "nb")
    else:
        sides = sides.select("*", F.lit(0).alias("x"), F.lit(0).alias("y"))
    m1 = rows.select(F.col("class_id").alias("a"), F.col("block").alias("x"), F.col("row_id").alias("r1"), "source_table")
    m2 = rows.select(F.col("class_id").alias("b"), F.col("block").alias("y"), F.col("row_id").alias("r2"))
    found = sides.join(m1, ["a", "x"]).join(m2, ["b", "y"]).where("r1 < r2 or (a <> b and r1 <> r2)")
    return found.select("source_table", F.least("r1", "r2").alias("row_a"), F.greatest("r1", "r2").alias("row_b"))


def groups(texts: DataFrame, threshold: float = 0.7) -> DataFrame:
    """(source_table, row_id, group_id, links): the connected group of every text that has a triple.

    group_id is the smallest class id of the group, links the number of other classes its class is like.
    Labels travel along the links until none changes, each round a join and an aggregate on the class, cut by checkpoint.
    """
    texts = texts.select("source_table", "row_id", "text")
    prints = durable(fingerprints(texts))
    members = prints.select("source_table", "row_id", "class_id")
    found = durable(similar_classes(texts, prints, durable(representatives(prints)), threshold).select("a", "b"))
    edges = durable(found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = durable(edges.groupBy("a").agg(F.count("*").alias("links"), F.min("b").alias("m")).select(F.col("a").alias("class_id"), "links", F.least("a", "m").alias("label")))
    while True:
        near = edges.join(labels.select(F.col("class_id").alias("b"), F.col("label").alias("seen")), "b").groupBy("a").agg(F.min("seen").alias("seen"))
        # the label's own label is taken as well, which halves the distance left in each round
        hop = labels.select(F.col("class_id").alias("label"), F.col("label").alias("hop"))
        new = durable(labels.join(near.withColumnRenamed("a", "class_id"), "class_id").join(hop, "label", "left").select("class_id", "links", "label", F.least("label", "seen", F.coalesce("hop", "label")).alias("next")))
        changed = new.where("next < label").limit(1).count()
        labels = new.select("class_id", "links", F.col("next").alias("label"))
        if not changed:
            break
    return members.join(labels, "class_id", "left").select("source_table", "row_id", F.coalesce("label", "class_id").alias("group_id"), F.coalesce("links", F.lit(0)).alias("links"))
