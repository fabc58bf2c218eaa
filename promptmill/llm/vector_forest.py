"""Embedding near duplicates: a forest of random-projection trees, compared within leaves, linked and united."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptmill.llm.components import connected_components
from promptmill.llm.shared import broadcast_if_small, ready
from promptmill.workspace import materialize

#: Least cosine of a link.
LEAST_COSINE = 0.93
#: Trees of the forest; each vector lies in at least one leaf of every tree.
TREES = 8
#: Share of a node on each side of its middle that goes to both children.
SPILL = 0.1
#: A node of at most so many vectors is a leaf: all its pairs are compared.
LEAF = 128
#: Nodes of more vectors than this are split by Spark, a level at a time; smaller ones inside one task.
LOCAL_ROWS = 20_000
#: Levels split by Spark at most; beyond, a node is split inside one task whatever its size.
SPARK_LEVELS = 40
SEED = 20_240_601


def _direction(tree: int, path: str, dim: int) -> np.ndarray:
    """The random direction of a node, the same wherever it is drawn."""
    seed = int.from_bytes(hashlib.blake2b(f"{SEED}:{tree}:{path}".encode(), digest_size=8).digest(), "little")
    return np.random.default_rng(seed).standard_normal(dim)


def _links_in_leaves(group: pd.DataFrame) -> pd.DataFrame:
    """Pairs (a, b), a < b, of one node's copy groups (least key, code) vectors with a cosine of LEAST_COSINE or more.

    The node is split further where it holds more than LEAF vectors; ranks by
    projection decide the sides, so equal projections never stall a split.
    """
    tree = int(group["tree"].iloc[0])
    ids = np.arange(len(group))
    vectors = np.stack([np.asarray(v, dtype=np.float64) for v in group["vec"]]) if len(group) else np.zeros((0, 1))
    norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    found_a, found_b = [], []
    todo = [(str(group["path"].iloc[0]), np.arange(len(ids)))]
    while todo:
        path, at = todo.pop()
        n = len(at)
        if n <= LEAF:
            dots = vectors[at] @ vectors[at].T
            cosine = dots / np.outer(norms[at], norms[at])
            i, j = np.nonzero(np.triu(cosine >= LEAST_COSINE, 1))
            found_a.append(at[i])
            found_b.append(at[j])
            continue
        order = at[np.argsort(vectors[at] @ _direction(tree, path, vectors.shape[1]), kind="stable")]
        todo.append((path + "0", order[: int(np.ceil((0.5 + SPILL) * n))]))
        todo.append((path + "1", order[int(np.floor((0.5 - SPILL) * n)) :]))
    a = np.concatenate(found_a) if found_a else np.zeros(0, np.int64)
    b = np.concatenate(found_b) if found_b else np.zeros(0, np.int64)
    least, code = group["least"].to_numpy(np.int64), group["code"].to_numpy(np.int64)
    pairs = pd.DataFrame({"a_least": least[a], "a_code": code[a], "b_least": least[b], "b_code": code[b]})
    swap = (pairs.a_least > pairs.b_least) | (pairs.a_least == pairs.b_least) & (pairs.a_code > pairs.b_code)
    pairs.loc[swap, ["a_least", "a_code", "b_least", "b_code"]] = pairs.loc[swap, ["b_least", "b_code", "a_least", "a_code"]].to_numpy()
    return pairs.drop_duplicates()


def _split_by_spark(nodes: DataFrame, dim: int) -> DataFrame:
    """Nodes of more than LOCAL_ROWS vectors cut a level at a time with approximate quantiles, spill included."""
    for level in range(SPARK_LEVELS):
        sizes = nodes.groupBy("label", "tree", "path").agg(F.count("*").alias("n"))
        big = sizes.where(F.col("n") > LOCAL_ROWS).select("label", "tree", "path")
        if big.isEmpty():
            break
        # One direction per tree and level here; inside a task each node draws its own.
        projected = F.lit(None).cast("double")
        for tree in range(TREES):
            direction = F.array(*[F.lit(float(x)) for x in _direction(tree, f"spark{level}", dim)])
            products = F.zip_with("vec", direction, lambda x, y: F.coalesce(x * y, F.lit(0.0)))
            projected = F.when(F.col("tree") == tree, F.aggregate(products, F.lit(0.0), lambda s, x: s + x)).otherwise(projected)
        inside = nodes.join(broadcast_if_small(big), ["label", "tree", "path"], "left_semi").withColumn("proj", projected)
        bounds = inside.groupBy("label", "tree", "path").agg(
            F.percentile_approx("proj", [0.5 - SPILL, 0.5 + SPILL], 10_000).alias("q")
        )
        inside = inside.join(broadcast_if_small(bounds), ["label", "tree", "path"])
        left = inside.where(F.col("proj") <= F.col("q")[1]).withColumn("path", F.concat("path", F.lit("0")))
        right = inside.where(F.col("proj") >= F.col("q")[0]).withColumn("path", F.concat("path", F.lit("1")))
        small = nodes.join(broadcast_if_small(big), ["label", "tree", "path"], "left_anti")
        columns = ["label", "tree", "path", "rep", "vec"]
        nodes = materialize(small.select(columns).unionByName(left.select(columns)).unionByName(right.select(columns)), "forest-level")
    return nodes


def vector_links(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(key, n_links, component_id, kept): near duplicates among vectors of the same label.

    Two vectors of equal, non-null labels are linked where the cosine of their
    values in double precision is LEAST_COSINE or more (vectors of different
    lengths never are); a vector that is null,
    empty, all zero or holds a null, NaN or infinite component links with
    nothing, as does a row without a key or label. Exact copies (same label, same
    values) are put together at once and count as links of each other; of the
    other vectors only those in a common leaf of some tree of the forest are
    compared, so links may be missed but none below the bound is made (recall is
    measured in the tests). ``n_links`` counts the other rows linked directly,
    ``component_id`` is the least key reachable by links (the row's own key when
    it has none; null for a row without a key) and ``kept`` tells whether the
    row names its component (true where it links with nothing). Repeated rows are
    copies of each other. Other columns are not returned. An empty table gives
    an empty result.
    """
    ready(vectors.sparkSession)
    finite = "forall(__vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    rows = vectors.select(
        F.col(key).cast("bigint").alias("__key"),
        F.col(label).alias("__label"),
        F.transform(F.col(vector), lambda x: x.cast("double")).alias("__vec"),
    ).withColumn(
        "__valid",
        F.col("__key").isNotNull() & F.col("__label").isNotNull() & (F.size("__vec") > 0) & F.expr(finite)
        & F.exists("__vec", lambda x: x != 0),
    )
    rows = materialize(rows.select("__key", "__label", F.when(F.col("__valid"), F.col("__vec")).alias("__vec")), "vectors")
    valid = rows.where(F.col("__vec").isNotNull())
    copies = materialize(
        valid.groupBy("__label", "__vec").agg(F.min("__key").alias("least"), F.count("*").alias("mult"))
        .select("__label", "__vec", "mult", F.struct("least", F.xxhash64("__label", "__vec").alias("code")).alias("rep")),
        "vector-copies",
    )
    dim = copies.select(F.max(F.size("__vec"))).first()[0] or 1
    trees = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    label = F.struct(F.col("__label").alias("label"), F.size("__vec").alias("dim")).alias("label")
    nodes = copies.select(label, trees, F.lit("").alias("path"), "rep", F.col("__vec").alias("vec"))
    nodes = _split_by_spark(nodes, dim)
    nodes = nodes.select("label", "tree", "path", F.col("rep.least").alias("least"), F.col("rep.code").alias("code"), "vec")
    links = nodes.groupBy("label", "tree", "path").applyInPandas(_links_in_leaves, "a_least long, a_code long, b_least long, b_code long")
    links = links.select(
        F.struct(F.col("a_least").alias("least"), F.col("a_code").alias("code")).alias("a"),
        F.struct(F.col("b_least").alias("least"), F.col("b_code").alias("code")).alias("b"),
    )
    links = materialize(links.distinct(), "vector-links")
    labels = connected_components(links)
    weights = copies.select("rep", "mult")
    ends = links.select("a", "b").union(links.select("b", "a"))
    partners = ends.join(weights.withColumnRenamed("rep", "b"), "b").groupBy("a").agg(F.sum("mult").alias("others"))
    per_rep = (
        weights.join(partners.withColumnRenamed("a", "rep"), "rep", "left")
        .join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .select("rep", (F.col("mult") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("label", "rep")["least"].alias("component"))
    )
    per_rep = materialize(per_rep, "vector-components")
    reps = copies.join(per_rep, "rep").select("__label", "__vec", "n_links", "component")
    found = rows.join(broadcast_if_small(reps), ["__label", "__vec"], "left")
    component = F.when(F.col("__vec").isNotNull(), F.col("component")).otherwise(F.col("__key"))
    return found.select(
        F.col("__key").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.cast("bigint").alias("component_id"),
        F.coalesce(F.col("__key") == component, F.lit(True)).alias("kept"),
    )


def vector_report(embeddings: DataFrame) -> DataFrame:
    return vector_links(embeddings)


#: All pairs of a label in DuckDB, components by a recursive join; for small tables.
VECTOR_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), ok AS (
  SELECT vec_id, label, e FROM v
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
    AND list_bool_and(list_transform(e, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(e, lambda x: x <> 0))
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id < b.vec_id
  WHERE list_inner_product(a.e, b.e) / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.93
), ends AS (
  SELECT a AS x, b AS y FROM links UNION ALL SELECT b, a FROM links
), reach(x, y) AS (
  SELECT vec_id, vec_id FROM ok
  UNION
  SELECT reach.x, ends.y FROM reach JOIN ends ON reach.y = ends.x
), named AS (
  SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x
), degree AS (
  SELECT x AS vec_id, count(*) AS n FROM ends GROUP BY x
)
SELECT e.vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links, CAST(coalesce(n.component_id, e.vec_id) AS BIGINT) AS component_id,
       coalesce(e.vec_id = coalesce(n.component_id, e.vec_id), true) AS kept
FROM embeddings e LEFT JOIN named n ON e.vec_id = n.vec_id LEFT JOIN degree d ON e.vec_id = d.vec_id
"""
