"""Exact top-k inner-product search by exhaustive term-at-a-time accumulation.

Rows are packed into blocks, in the narrowest integers that hold them. Each wave of QUERIES queries meets each block of
CANDIDATES candidates once, through an equi-join on both numbers; so a row travels once for each block of the other side,
and a task holds one wave and one block. A pair scatters the postings of each term (vector component) into dense score
arrays, selects its own k best, and the partial lists are merged by a second selection.

Defined results: a vector that is null, empty of values, or holds a null or non-finite component takes no part; a missing
component (vectors of unequal length) counts as zero; vectors of any length are taken whole; rows that repeat a vec_id count
once (the greatest vector is taken); a null vec_id takes no part; equal scores rank by smaller vec_id; extra columns are
ignored; an empty table gives no rows. Scores are 64-bit integers: a finite component beyond 2**62 after scaling, and vectors
whose inner product could leave the range, are errors, never wrong scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrazzo.llm.common import stash

CANDIDATES, QUERIES = 16384, 4096


def quantise(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id, x array<bigint> = floor(scale * component); unusable vectors are left out."""
    values = F.transform("embedding", lambda v: v.cast("double"))
    fit = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
    large = F.exists(values, lambda v: F.abs(v * scale) > 2.0**62)
    whole = F.transform(values, lambda v: F.floor(v * scale))
    checked = F.when(large, F.raise_error(F.lit("a component is too large for integer scores"))).otherwise(whole)
    return vectors.where(fit).select("vec_id", checked.alias("x")).groupBy("vec_id").agg(F.max("x").alias("x"))


def narrow(x: np.ndarray) -> np.ndarray:
    """The same integers in the narrowest type that holds them."""
    most = max(int(x.max(initial=0)), -int(x.min(initial=0)) - 1)
    return x.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(t).max))


def unpacked(row: dict, prefix: str) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row[f"{prefix}ids"], np.int64)
    return ids, np.frombuffer(row[f"{prefix}data"], f"i{row[f'{prefix}width']}").reshape(len(ids), row[f"{prefix}dim"])


def _packed(rows: DataFrame, blocks: int, prefix: str) -> DataFrame:
    """One row per block: the block's number, ids ascending, and values as flat arrays. Ids are hashed to blocks, so they are even."""
    names = [f"{prefix}{c}" for c in ("block", "ids", "data", "dim", "width")]

    def out(block: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        lists = t.column("x").combine_chunks()
        lens = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        dense = np.zeros((len(lens), int(lens.max(initial=0))), np.int64)
        dense[np.arange(dense.shape[1])[None, :] < lens[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
        ids = t.column("vec_id").to_numpy().astype(np.int64)
        dense = narrow(dense)
        arrays = [pa.array([x], pa.binary()) for x in (ids.tobytes(), dense.tobytes())]
        sizes = [pa.array([n], pa.int32()) for n in (dense.shape[1], dense.itemsize)]
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *arrays, *sizes], names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        block = -1
        for batch in batches:
            of = batch.column("b").to_numpy()
            cuts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if hi == lo:
                    continue
                if held and of[lo] != block:
                    yield out(block, held)
                    held = []
                block = int(of[lo])
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield out(block, held)

    dealt = rows.withColumn("b", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))).repartition(blocks, "b").sortWithinPartitions("b", "vec_id")
    return dealt.mapInArrow(pack, f"{names[0]} bigint, {names[1]} binary, {names[2]} binary, {names[3]} int, {names[4]} int")


def best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the k greatest of each row; columns ascend by id, so the first of equals wins."""
    n = scores.shape[1]
    if n <= k:
        rows, cols = np.indices(scores.shape)
        return rows.ravel(), cols.ravel()
    kth = np.partition(scores, n - k, axis=1)[:, n - k]
    above = scores > kth[:, None]
    need = k - above.sum(axis=1)
    rows, cols = np.nonzero(scores == kth[:, None])
    first = np.searchsorted(rows, rows)  # rows ascend
    tied = np.arange(len(rows)) - first < need[rows]
    r, c = np.nonzero(above)
    return np.concatenate([r, rows[tied]]), np.concatenate([c, cols[tied]])


def accumulate(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products, a term at a time: each non-zero weight of a query scatters the term's postings into its scores."""
    most = lambda x: max(int(x.max(initial=0)), -int(x.min(initial=0)))
    bound = most(queries) * most(candidates) * max(1, queries.shape[1])
    if bound >= 2**63:
        raise OverflowError("an inner product may not fit a 64-bit score")
    kind = np.int32 if bound < 2**31 else np.int64
    scores = np.zeros((len(queries), len(candidates)), kind)
    for term in range(min(queries.shape[1], candidates.shape[1])):
        weights, column = queries[:, term].astype(kind), candidates[:, term].astype(kind)
        rows, posting = np.flatnonzero(weights), np.flatnonzero(column)
        if 2 * len(posting) > len(column):  # a long posting list is added whole, without indices
            for q in rows:
                scores[q] += weights[q] * column
        else:
            for q in rows:
                scores[q, posting] += weights[q] * column[posting]
    return scores


def _scored(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 3, NAMES)]
        for q in left.to_pylist():
            qids, qs = unpacked(q, "q_")
            for c in right.to_pylist():
                cids, cs = unpacked(c, "c_")
                for a in range(0, len(qids), 128):
                    part = accumulate(qs[a : a + 128], cs)
                    r, at = best(part, k + 1)  # one more, as the query itself may be among them
                    other = qids[a + r] != cids[at]
                    r, at = r[other], at[other]
                    out.append(pa.RecordBatch.from_arrays([pa.array(qids[a + r]), pa.array(cids[at]), pa.array(part[r, at].astype(np.int64))], NAMES))
        return pa.Table.from_batches(out)

    return run


NAMES = ["query_id", "vec_id", "score"]


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best other rows of each row that meets `is_query`."""
    x = stash(quantise(vectors, scale), "topk-vectors")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    blocks = -(-max(1, x.count()) // CANDIDATES)
    waves = -(-max(1, x.where(is_query).count()) // QUERIES)
    candidates = _packed(x, blocks, "c_").withColumn("q_block", every(waves))
    queries = _packed(x.where(is_query), waves, "q_").withColumn("c_block", every(blocks))
    pairs = queries.groupBy("c_block", "q_block").cogroup(candidates.groupBy("c_block", "q_block"))
    scored = pairs.applyInArrow(_scored(k), "query_id bigint, vec_id bigint, score bigint")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
