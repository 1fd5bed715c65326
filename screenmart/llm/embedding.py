"""Embedding near-dedup: pairs that collide in enough windows of one-dimensional projections."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, erf, floor, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenmart.llm.common import map_arrow, ranges, ship, stored
from screenmart.llm.components import components

PROJECTIONS = 40
SEED = 20
#: Half-width of a window, in standard deviations of a linked pair's projected distance.
WINDOW_SIGMAS = 2.5
#: Width of a bin of the first projection, in the same unit; only bins side by side are compared.
BIN_SIGMAS = 4.5
#: Share of linked pairs that may fall short of the collision count.
MISS = 1e-6
CHUNK = 1024


def least_collisions(projections: int = PROJECTIONS, sigmas: float = WINDOW_SIGMAS, miss: float = MISS) -> int:
    """The largest count that a pair at the very threshold reaches with probability 1 - ``miss``.

    Its projected distance is normal, so each window holds it with the same probability, independently.
    """
    p, below = erf(sigmas / sqrt(2)), 0.0
    for count in range(projections + 1):
        below += comb(projections, count) * p**count * (1 - p) ** (projections - count)
        if below > miss:
            return count
    return projections


def directions(dim: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, PROJECTIONS))


def unit_rows(vectors: list) -> np.ndarray:
    x = np.array(vectors, dtype=np.float64)
    scale = np.abs(x).max(axis=1, keepdims=True)  # against overflow of squares
    x /= scale
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def colliding(left: np.ndarray, right: np.ndarray, same: bool, half: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs whose projections collide in at least ``least`` windows centred on the left row.

    The first projection is sorted and its windows cut by binary search; a pair that has missed too many
    of the next ones to reach the count is dropped at once.
    """
    order = np.argsort(right[:, 0], kind="stable")
    line = right[order, 0]
    lo, hi = np.searchsorted(line, left[:, 0] - BIN_SIGMAS / WINDOW_SIGMAS * half), np.searchsorted(line, left[:, 0] + BIN_SIGMAS / WINDOW_SIGMAS * half, "right")
    i, j = np.repeat(np.arange(len(left)), hi - lo), order[ranges(lo, hi - lo)]
    if same:
        i, j = i[i < j], j[i < j]
    misses = np.zeros(len(i), dtype=np.int16)
    for k in range(left.shape[1]):
        misses += np.abs(left[i, k] - right[j, k]) > half
        if k >= left.shape[1] - least:
            keep = misses <= left.shape[1] - least
            if not keep.all():
                i, j, misses = i[keep], j[keep], misses[keep]
    return i, j


def roots(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The smallest row that each row reaches over the pairs."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def near_links(reps: DataFrame, least_cosine: float) -> DataFrame:
    """(node, links, other) of the distinct vectors (node, label, embedding, copies).

    links: vectors at ``least_cosine`` or more found for the node in one block, copies included; other: the node it is
    tied to there. Vectors of a label are dealt to bins of their first projection, and bins to chunks of about
    CHUNK vectors by hash, so a label of any size spreads; blocks are pairs of chunks of the same bin or
    of bins side by side. A block emits one row per vector that has a link in it, not one per pair.
    """
    spark = reps.sparkSession
    ship(spark)
    sigma = sqrt(2 - 2 * least_cosine)  # the distance of unit vectors at the threshold
    half, width = WINDOW_SIGMAS * sigma, BIN_SIGMAS * sigma
    least = least_collisions()

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [0] * batch.num_rows
            vectors = batch.column(2).to_pylist()
            for dim in {len(v) for v in vectors}:
                rows = [k for k, v in enumerate(vectors) if len(v) == dim]
                first = unit_rows([vectors[k] for k in rows]) @ directions(dim)[:, 0]
                for k, x in zip(rows, first.tolist(), strict=True):
                    out[k] = floor(x / width)
            columns = [batch.column(0), batch.column(1), pa.array([len(v) for v in vectors], pa.int32()), pa.array(out, pa.int32())]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(2), batch.column(3)], ["node", "label", "dim", "bin", "embedding", "copies"])

    kind, vector = (reps.schema[c].dataType.simpleString() for c in ("label", "embedding"))
    schema = f"node long, label {kind}, dim int, bin int, embedding {vector}, copies long"
    placed = stored(map_arrow(reps.select("node", "label", "embedding", "copies"), bins, schema), "placed_vectors")
    sizes = placed.groupBy("label", "dim", "bin").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    key = ["label", "dim", "bin"]
    near = sizes
    for name, step in (("before", 1), ("after", -1)):
        near = near.join(sizes.select("label", "dim", (F.col("bin") + step).alias("bin"), F.col("chunks").alias(name)), key, "left")
    rows = placed.join(near.na.fill(0, ["before", "after"]), key).withColumn("chunk", F.pmod(F.xxhash64("node", F.lit(1)), F.col("chunks")).cast("int"))

    def others(n: str):
        return F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))

    def block(first_bin, first, second_bin, second, right):
        return F.struct(first_bin.alias("b1"), first.alias("c1"), second_bin.alias("b2"), second.alias("c2"), right.alias("right"))

    own, mine = F.col("bin"), F.col("chunk")
    blocks = F.concat(
        F.transform(others("chunks"), lambda c: block(own, F.least(mine, c), own, F.greatest(mine, c), mine > c)),
        F.transform(others("after"), lambda c: block(own, mine, own + 1, c, F.lit(False))),
        F.transform(others("before"), lambda c: block(own - 1, c, own, mine, F.lit(True))),
    )
    dealt = rows.select("label", "dim", "node", "embedding", "copies", F.explode(blocks).alias("at")).select(
        "label", "dim", "node", "embedding", "copies", "at.*"
    )

    def run(part: pd.DataFrame) -> pd.DataFrame:
        same = part["b1"].iat[0] == part["b2"].iat[0] and part["c1"].iat[0] == part["c2"].iat[0]
        part = part.sort_values(["right", "node"])
        on_right = part["right"].to_numpy(bool)
        x = unit_rows(part["embedding"].tolist())
        projected = x @ directions(x.shape[1])
        cut = len(part) - int(on_right.sum())
        if same:
            i, j = colliding(projected, projected, True, half, least)
        else:
            i, j = colliding(projected[:cut], projected[cut:], False, half, least)
            j = j + cut
        found = np.concatenate([(x[i[k : k + 65536]] * x[j[k : k + 65536]]).sum(axis=1) for k in range(0, len(i), 65536)] or [np.zeros(0)])
        i, j = i[found >= least_cosine], j[found >= least_cosine]
        node, copies = part["node"].to_numpy(), part["copies"].to_numpy()
        links = np.bincount(i, copies[j], len(part)) + np.bincount(j, copies[i], len(part))
        some = np.flatnonzero(links)
        return pd.DataFrame({"node": node[some], "links": links[some].astype(np.int64), "other": node[roots(i, j, len(part))[some]]})

    return dealt.groupBy("label", "dim", "b1", "c1", "b2", "c2").applyInPandas(run, "node long, links long, other long")


def near_duplicates(vectors: DataFrame, least_cosine: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of (vec_id, embedding, label); other columns are not read.

    Links join vectors of one label and length with a cosine of at least ``least_cosine``, in double precision.
    Rows whose vector is null, empty, all zero, or holds a null or non-finite component, and rows without label or
    vec_id, link with nothing: n_links 0, their own component, kept (not kept where vec_id is null). Equal
    vectors are reduced to one before any pair is looked at, and count as links of each other.
    component_id is the smallest vec_id of the component. Repeated rows count as vectors of their own.
    """
    usable = F.coalesce(
        F.col("label").isNotNull() & F.col("vec_id").isNotNull() & (F.size("embedding") > 0)
        & F.forall("embedding", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
        & F.exists("embedding", lambda x: x != 0),
        F.lit(False),
    )
    rows = vectors.select("vec_id", "embedding", "label", usable.alias("usable"))
    rows = rows.withColumn("node", F.when(F.col("usable"), F.xxhash64("label", "embedding")))
    reps = stored(
        rows.where("usable").groupBy("node").agg(
            F.first("label").alias("label"), F.first("embedding").alias("embedding"),
            F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"),
        ),
        "vectors",
    )
    found = stored(near_links(reps, least_cosine), "vector_links")
    totals = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = reps.select("node", "least", "copies").join(components(found, "node", "other"), "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    known = named.join(names, "component").join(totals, "node", "left").select(
        F.col("node").alias("_node"), "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    out = rows.join(known, rows["node"] == known["_node"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def op8_embedding(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), least_cosine=0.98)


OP8_SQL = """
with recursive v as (
  select vec_id, label, embedding::double[] as e from embeddings
  where vec_id is not null and label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.98
), reach(a, b) as (
  select a, b from pairs union select r.a, p.b from reach r join pairs p on r.b = p.a
), n as (select a, count(*) as n from pairs group by a),
c as (select a, min(b) as low from reach group by a)
select e.vec_id, coalesce(n.n, 0)::bigint as n_links, least(e.vec_id, coalesce(c.low, e.vec_id)) as component_id,
  e.vec_id <= coalesce(c.low, e.vec_id) as kept
from embeddings e left join n on n.a = e.vec_id left join c on c.a = e.vec_id
"""
