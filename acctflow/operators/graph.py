"""Connected components of payment edges (G1), distributed.

A node's bigint id is a hash of its name, so edges need no join to get ids. That no
two names share an id is checked; if two do, the next of the hashes is taken. The
components are found on ids (``operators.components``), and names come back at the
end. Only the two node columns and the order column feed the graph; the rows
themselves, however wide, meet one join with the finished (node, label) table, a
written table, so that the skew-join can split a busy node.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctflow.operators.components import bigint_components
from acctflow.operators.ranking import ordinal
from acctflow.operators.skew import join_by_key, unless_small
from acctflow.session import materialize, release


def node_id(name: Column, salt: int) -> Column:
    """A bigint for a node's name, by the hash numbered ``salt``."""
    return F.xxhash64(F.lit(salt), name)


def ids_differ(names: DataFrame, salt: int) -> bool:
    """Whether all ``n`` (different names) have different ids."""
    return names.groupBy(node_id(F.col("n"), salt).alias("id")).count().where("count > 1").isEmpty()


def with_components(
    rows: DataFrame,
    src: str = "ORIG",
    dst: str = "BENEF",
    order_by: str = "REF_ID",
    name: str = "Group",
    prefix: str = "G",
    trim: bool = False,
) -> DataFrame:
    """Label each row with ``G<k>``, the component of its ``src`` node.

    Components are numbered 1, 2, ... by the smallest ``order_by`` among their
    rows (then by their smallest ``src`` node), i.e. in order of first
    appearance when rows are read in ``order_by`` order. A row whose ``dst``
    is null still puts ``src`` in the graph as a node without edges; a null
    ``src`` gets a null label. Node values are compared exactly unless ``trim``,
    which drops surrounding spaces from node values first (the rows keep theirs).
    """
    node = (lambda c: F.trim(F.col(c))) if trim else F.col
    scratch: list[DataFrame] = []

    def kept(df: DataFrame, tag: str) -> DataFrame:
        scratch.append(materialize(df, tag))
        return scratch[-1]

    try:
        narrow = kept(rows.select(node(src).alias("s"), node(dst).alias("d"), F.col(order_by).alias("o")), "cc-narrow")
        sources = narrow.where(F.col("s").isNotNull())
        no_order = F.lit(None).cast(narrow.schema["o"].dataType)
        ends = sources.select(F.col("s").alias("n"), F.col("o"), F.lit(True).alias("is_src")).unionByName(
            sources.where(F.col("d").isNotNull()).select(F.col("d").alias("n"), no_order.alias("o"), F.lit(False).alias("is_src"))
        )
        names = kept(ends.groupBy("n").agg(F.min("o").alias("first"), F.max("is_src").alias("is_src")), "cc-nodes")
        salt = next(k for k in count() if ids_differ(names, k))
        kind = names.schema["n"].dataType
        u, v = (node_id(F.col(c).cast(kind), salt).alias(to) for c, to in (("s", "u"), ("d", "v")))
        edges = sources.where(F.col("d").isNotNull() & (F.col("s") != F.col("d"))).select(u, v)
        roots = bigint_components(edges)
        scratch.append(roots)
        ids = names.where("is_src").withColumn("id", node_id(F.col("n"), salt))
        named = ids.join(roots.withColumnRenamed("node", "id").hint("merge"), "id", "left").select(
            F.col("n").alias("s"), "first", F.coalesce("root", "id").alias("root")
        )
        named = kept(named, "cc-named")
        comps = named.groupBy("root").agg(F.min("first").alias("first"), F.min("s").alias("first_node"))
        numbered = ordinal(comps, ["first", "first_node"], "k")
        scratch.append(numbered)
        labels = named.join(unless_small(numbered).select("root", F.concat(F.lit(prefix), F.col("k").cast("string")).alias(name)), "root")
        labelled = join_by_key(rows.withColumn("__node", node(src)), labels.select(F.col("s").alias("__node"), name), ["__node"])
        return labelled.drop("__node")
    finally:
        for frame in scratch:
            release(frame)
