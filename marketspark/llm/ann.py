"""Approximate nearest neighbours by a permutation index.

A vector is represented by its ``POSTED`` nearest pivots, in order. Vectors of one length are dealt into blocks of bounded size; each block draws its pivots from
its own rows and posts its vectors in one inverted file per pivot, with the pivot's place. A query walks the files of its own nearest pivots; of the
footrule distance between both orders (places beyond the posted ones count as the first of them) only shared pivots
change the sum, so a walk adds up the exact footrule of every vector it meets. The nearest ``share`` of each block by footrule, and
all that tie with the last of them, are ranked again by the inner product of the original vectors in double precision.

The largest inner product is made a smallest distance first: every vector of a block gets one more component, the root of the block's largest squared norm
less its own, and a query gets a zero. All then have one norm, and pivots are near or far by what the query asks for, long vectors included.

Pivots point different ways: of two sample rows with a cosine over ``ALIKE`` only the first is one. Rows that are so close to their nearest pivot form its
group; footrule cannot tell such near copies apart, so where one of a group is ranked again all are.

Equal vectors of a block are posted once. Of each such class the ``top`` rows of smallest vec_id, and one more as a query excludes its own
row, stand for all: no other row of the class can be among the nearest.

Pivots come from a documented sample, at most ``PIVOT_ROWS`` rows of a block. Every row is indexed. Queries and blocks meet in
pairs of bounded size, so the work is queries times vectors at a small constant, and memory is bounded. With ``share`` 1 the search is exact.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no part; those of other lengths are searched among their own. Ties
go to the smaller vec_id, null ids last. Repeated rows are candidates each; a query excludes its own row only. A query without candidates has
no result, as has an empty table. Only vec_id and embedding are read, so clashing columns do not matter.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import keep, ship

PIVOTS, PIVOT_ROWS = 512, 4096
ALIKE = 0.9
POSTED = 96
SHARE, LEAST = 0.2, 512
BLOCK, QUERIES = 8192, 4096


def usable(vectors: DataFrame) -> DataFrame:
    """row, vec_id, embedding (doubles) and size of the vectors that take part, written."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(
        "embedding is not null and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity')) "
        "and exists(embedding, x -> x <> 0)")
    return keep(rows.select("*", F.size("embedding").alias("size"), F.monotonically_increasing_id().alias("row")), "vectors")


def level(vectors: np.ndarray) -> np.ndarray:
    """One component more, so that all have the largest norm among them."""
    squares = (vectors**2).sum(axis=1)
    return np.column_stack([vectors, np.sqrt(np.maximum(squares.max() - squares, 0))])


def pivots(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors of a sample of rows, no two of them alike."""
    order = np.random.default_rng(len(vectors)).permutation(len(vectors))[:PIVOT_ROWS]  # the same for the same rows
    unit = vectors[order] / np.linalg.norm(vectors[order], axis=1, keepdims=True)
    chosen, open_rows = [], np.ones(len(unit), dtype=bool)
    while len(chosen) < PIVOTS and open_rows.any():
        chosen.append(int(open_rows.argmax()))
        open_rows &= unit @ unit[chosen[-1]] <= ALIKE
        open_rows[chosen[-1]] = False
    return unit[chosen]


def places(nearness: np.ndarray, posted: int) -> np.ndarray:
    """For each vector and pivot the posted length less the pivot's place, 0 if it is not posted."""
    order = np.argsort(-nearness, axis=1, kind="stable")[:, :posted]
    out = np.zeros(nearness.shape, dtype=np.int32)
    np.put_along_axis(out, order, np.arange(posted, 0, -1, dtype=np.int32)[None, :], 1)
    return out


def search_block(queries: pd.DataFrame, block: pd.DataFrame, top: int, share: float) -> pd.DataFrame:
    """The best ``top`` of one block for each of the queries, after ranking by footrule and again by inner product."""
    none = pd.DataFrame({"query_row": [], "query_id": [], "vec_id": [], "score": []})
    if not len(queries) or not len(block):
        return none
    block = block.sort_values(["vec_id", "row"], kind="stable", na_position="last")
    wanted, whole = np.stack(queries["embedding"].to_numpy()), np.stack(block["embedding"].to_numpy())
    _, first, classes = np.unique(whole.view(f"V{whole.strides[0]}").ravel(), return_index=True, return_inverse=True)
    vectors = whole[first]
    chosen = (pd.Series(classes).groupby(classes).cumcount() <= top).to_numpy()
    block, classes = block[chosen], classes[chosen]
    ids, missing, rows = block["vec_id"].fillna(0).to_numpy(), block["vec_id"].isna().to_numpy(), block["row"].to_numpy()
    raised = level(vectors)
    centres = pivots(raised)
    near = raised @ centres.T
    posted = min(POSTED, len(centres))
    table, asked = places(near, posted), places(wanted @ centres[:, :-1].T, posted)
    files = [(f, table[f, p]) for p in range(len(centres)) for f in [np.flatnonzero(table[:, p])]]
    group = np.where(near.max(axis=1) > ALIKE * np.linalg.norm(raised, axis=1), near.argmax(axis=1), len(centres))
    count = min(len(vectors), max(LEAST, top + 1, math.ceil(share * len(whole))))
    out = []
    for vector, own, row, query in zip(wanted, asked, queries["row"], queries["vec_id"], strict=True):
        # Footrule: a constant less twice the sum, over shared pivots, of the smaller remainder.
        shared = np.zeros(len(vectors), dtype=np.int32)
        for p in np.flatnonzero(own):
            at, rest = files[p]
            shared[at] += np.minimum(rest, own[p])
        taken = shared >= np.partition(shared, -count)[-count]
        met = np.zeros(len(centres) + 1, dtype=bool)
        met[group[taken]] = True
        met[-1] = False  # of no group
        taken |= met[group]
        scores = np.full(len(vectors), -np.inf)
        scores[taken] = (vectors[taken] * vector).sum(axis=1)
        found = np.flatnonzero(taken[classes] & (rows != row))
        scores = scores[classes[found]]
        best = np.lexsort((rows[found], ids[found], missing[found], -scores))[:top]
        out.append(pd.DataFrame({
            "query_row": row, "query_id": query, "vec_id": block["vec_id"].to_numpy()[found[best]], "score": scores[best]}))
    return pd.concat(out, ignore_index=True)


def _searcher(top: int, share: float):
    def run(key, queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        return search_block(queries, block, top, share)
    return run


def nearest(vectors: DataFrame, every: int = 20, top: int = 20, share: float = SHARE) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest ``top`` of every vector whose vec_id is divisible by ``every``."""
    ship(vectors.sparkSession)
    stored = usable(vectors)
    asks = F.col("vec_id") % every == 0
    # One row per length; lengths without a query drop out.
    sizes = stored.groupBy("size").agg(F.count("*").alias("n"), F.count_if(asks).alias("q")).where("q > 0").select(
        "size", F.expr(f"ceil(n / {BLOCK})").alias("blocks"), F.expr(f"ceil(q / {QUERIES})").alias("chunks"))
    number = F.xxhash64("row")
    sized = stored.join(sizes, "size")
    dealt = sized.withColumn("block", F.pmod(number, F.col("blocks"))).withColumn("chunk", F.explode(F.expr("sequence(0L, chunks - 1)")))
    asked = sized.where(asks).withColumn("chunk", F.pmod(number, F.col("chunks"))).withColumn(
        "block", F.explode(F.expr("sequence(0L, blocks - 1)")))
    key = ("size", "block", "chunk")
    columns = (*key, "row", "vec_id", "embedding")
    found = asked.select(*(F.col(c).alias(c) for c in columns)).groupBy(*key).cogroup(dealt.select(*columns).groupBy(*key)).applyInPandas(
        _searcher(top, share), "query_row long, query_id long, vec_id long, score double")
    best = F.expr("row_number() over (partition by query_row order by score desc, vec_id asc nulls last)")
    return found.withColumn("rank", best).where(f"rank <= {top}").select("query_id", "rank", "vec_id", "score")
