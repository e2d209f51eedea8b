"""Groups of similar rows: exact set-similarity joins, connected components, representatives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut


def jaccard_distance(a: Column, b: Column) -> Column:
    """1 - |a ∩ b| / |a ∪ b| of arrays of distinct values; 0 if both are empty."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when(union == 0, 0.0).otherwise(1 - shared / union)


def set_containment(a: Column, b: Column) -> Column:
    """|a ∩ b| / |a|; 1 where ``a`` is empty."""
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def mean_abs_difference(a: Column, b: Column) -> Column:
    """Mean absolute difference of two vectors; null where one is missing, empty or of another length."""
    same = (F.size(a) == F.size(b)) & (F.size(a) > 0)
    return F.when(same, F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0))) / F.size(a))


def similar_sets(rows: DataFrame, *, group: str, key: str, items: str, similarity: float) -> DataFrame:
    """(group, a, b, distance): all pairs a < b of one group whose sets have at least this Jaccard similarity, none missed.

    Items are ranked by their frequency in the whole table, and a set's rarest
    n - ceil(similarity * n) + 1 items are its prefix: two sets as similar as that share
    an item of their prefixes, so that an equi-join on (group, prefix item) proposes all
    pairs without forming those of a group. Empty sets are left out; equal sets are joined first and
    expanded at the end. Keys are unique within a group.
    """
    x = rows.select(group, F.col(key).alias("key"), F.array_sort(F.array_distinct(items)).alias("items")).filter(F.size("items") > 0)
    x = x.withColumn("sha", F.sha2(F.array_join(F.transform("items", lambda i: i.cast("string")), "\x1f"), 256))
    reps = cut(x.groupBy(group, "sha").agg(F.min("key").alias("rep"), F.first("items").alias("items")), "sets")
    single = reps.select(group, "rep", F.size("items").alias("n"), F.explode("items").alias("item"))
    counts = single.groupBy("item").agg(F.count(F.lit(1)).alias("f"))
    ranked = single.join(counts, "item").withColumn("_r", F.row_number().over(W.partitionBy(group, "rep").orderBy("f", "item")))
    # The small amount keeps a product such as 0.7 * 10 from being rounded up.
    prefix = ranked.filter(F.col("_r") <= F.col("n") - F.ceil(F.col("n") * similarity - 1e-9) + 1).select(group, "item", "rep", "n")
    right = prefix.select(F.col(group).alias("_g"), F.col("item").alias("_i"), F.col("rep").alias("b"), F.col("n").alias("nb"))
    near = (F.col("n") >= F.col("nb") * similarity - 1e-9) & (F.col("nb") >= F.col("n") * similarity - 1e-9)
    pairs = prefix.withColumnRenamed("rep", "a").join(right, (F.col(group) == F.col("_g")) & (F.col("item") == F.col("_i")) & (F.col("a") < F.col("b")) & near).select(group, "a", "b").distinct()
    ia = reps.select(group, F.col("rep").alias("a"), F.col("items").alias("ia"))
    ib = reps.select(group, F.col("rep").alias("b"), F.col("items").alias("ib"))
    links = pairs.join(ia, [group, "a"]).join(ib, [group, "b"]).select(group, "a", "b", jaccard_distance(F.col("ia"), F.col("ib")).alias("distance")).filter(F.col("distance") <= 1 - similarity + 1e-12)
    members = x.join(reps.select(group, "sha", "rep"), [group, "sha"])
    ties = members.filter(F.col("key") > F.col("rep")).select(group, F.col("rep").alias("a"), F.col("key").alias("b"), F.lit(0.0).alias("distance"))
    return links.unionByName(ties)


def connected_components(edges: DataFrame, *, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component): the least node that each node of an edge is joined to, however far.

    Nodes take the least label among their neighbours' and then their label's own label, until
    nothing changes; every round is written to the shared folder, so that lineage stays
    short and a lost executor costs one round. The least label of a neighbourhood is combined before
    the shuffle. Raises if ``rounds`` aren't enough.
    """
    forth = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x IS NOT NULL AND y IS NOT NULL AND x <> y")
    both = cut(forth.unionByName(forth.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "edges")
    labels = cut(both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("label")), "labels")
    for _ in range(rounds):
        seen = both.join(labels.select(F.col("x").alias("y"), F.col("label").alias("there")), "y").groupBy("x").agg(F.min("there").alias("there"))
        near = labels.join(seen, "x").select("x", F.col("label").alias("was"), F.least("label", "there").alias("label"))
        jump = labels.select(F.col("x").alias("label"), F.col("label").alias("further"))
        new = cut(near.join(jump, "label", "left").select("x", "was", F.least("label", "further").alias("label")), "labels")
        if new.filter("label <> was").limit(1).count() == 0:
            return new.select(F.col("x").alias("node"), F.col("label").alias("component"))
        labels = new.select("x", "label")
    raise RuntimeError(f"components didn't settle in {rounds} rounds")


def dedup_groups(rows: DataFrame, *, group: str, key: str, items: str, distance: float = 0.30, guard: float = 0.9) -> DataFrame:
    """(group, key, rep): single linkage at ``distance`` within each group.

    rep is the member with the most items, the least key on ties. Where one component
    would hold ``guard`` or more of a group of several, nothing of the group is joined. Rows with empty or
    null sets stand alone.
    """
    pairs = similar_sets(rows, group=group, key=key, items=items, similarity=1 - distance)
    node = lambda c: F.struct(F.col(group).alias("g"), F.col(c).alias("k"))
    comp = connected_components(pairs.select(node("a").alias("a"), node("b").alias("b")))
    comp = comp.select(F.col("node.g").alias(group), F.col("node.k").alias(key), F.col("component.k").alias("_c"))
    x = rows.select(group, key, F.greatest(F.size(F.coalesce(items, F.array())), F.lit(0)).alias("_n")).join(comp, [group, key], "left").withColumn("_c", F.coalesce("_c", key))
    sizes = x.groupBy(group, "_c").agg(F.count(F.lit(1)).alias("_m"), F.min(F.struct((-F.col("_n")).alias("n"), F.col(key).alias("k")))["k"].alias("rep"))
    worst = sizes.groupBy(group).agg((F.max("_m") / F.sum("_m")).alias("_share"), F.sum("_m").alias("_all"))
    out = x.join(sizes.select(group, "_c", "rep"), [group, "_c"]).join(worst, group)
    return out.select(group, key, F.when((F.col("_share") >= guard) & (F.col("_all") > 1), F.col(key)).otherwise(F.col("rep")).alias("rep"))


def propagate(rows: DataFrame, reps: DataFrame, *, key: str, rep: str, columns: list[str]) -> DataFrame:
    """Rows with the representative's values of ``columns`` where it has one, else their own."""
    held = rows.select(F.col(key).alias("_rep"), *[F.col(c).alias(f"_r_{c}") for c in columns])
    joined = rows.join(reps.select(key, F.col(rep).alias("_rep")), key, "left").join(held, "_rep", "left")
    return joined.select(*[F.coalesce(f"_r_{c}", c).alias(c) if c in columns else F.col(c) for c in rows.columns])
