"""Connected components of links, by labels that shrink to the least of each component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored


def _tight(left: DataFrame, right: DataFrame, keys: list[str], on: tuple[str, str], how: str) -> DataFrame:
    """Equi-join on the keys and one more column each; a null key is a key."""
    cond = F.col(on[0]) == F.col(on[1])
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return left.join(right.withColumnsRenamed({k: f"__{k}" for k in keys}), cond, how).drop(*[f"__{k}" for k in keys], on[1])


def components(links: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """Rows (*keys, node, label): for every node of the links `a` - `b`, the least node of its
    component. Links join nodes with the same keys; their direction, repeats and loops do not matter;
    links with a null end are left out.

    A round gives each node the least label among its neighbours and itself, then the label of that
    label, so labels travel twice as far each time. A round is a written table in the shared folder:
    the plan does not grow, and a lost executor costs its tasks only. Neighbours' labels are
    reduced in each task before the shuffle, so a node with very many links is no hot group.
    """
    ends = links.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(*keys, F.col(a).alias("node"), F.col(b).alias("other"))
    both = stored(ends.unionByName(ends.select(*keys, F.col("other").alias("node"), F.col("node").alias("other"))).distinct())
    labels = stored(both.groupBy(*keys, "node").agg(F.least(F.min("other"), F.col("node")).alias("label")))
    while True:
        names = labels.select(*keys, F.col("node").alias("__node"), F.col("label").alias("__label"))
        near = _tight(both, names, keys, ("other", "__node"), "inner").groupBy(*keys, "node").agg(F.min("__label").alias("__near"))
        near = near.withColumnRenamed("node", "__of")
        lower = _tight(labels, near, keys, ("node", "__of"), "inner").select(*keys, "node", "label", F.least("label", "__near").alias("__low"))
        ahead = _tight(lower, names, keys, ("__low", "__node"), "inner")
        after = stored(ahead.select(*keys, "node", F.col("label").alias("__before"), F.least("__low", "__label").alias("label")))
        moved = after.where(F.col("label") != F.col("__before")).limit(1).count()
        labels = after.drop("__before")
        if not moved:
            return labels
