"""Near-duplicate documents by b-bit MinHash.

Signing: words are split at ASCII white space, A-Z lower-cased; a document's set holds its distinct k-word shingles as
64-bit hashes, which are compared within pairs only; a class of equal sets goes by a 128-bit cryptographic hash of the sorted
set, and pairs are confirmed with shingle hashes of another seed. HASHES minima make BANDS band keys of ROWS minima each, and their low BITS bits are packed into a signature. Equal sets
form a class first, which stands for its members. A band's bucket then links each member to the bucket's most central one
(the member whose buckets are the fullest), so a group of n copies gives n candidates and not n squared; members that stay
outside their hub's component then meet those of the bucket that are in other components, but for members that link to the
hub directly if the outsider is too far from it: Jaccard distance is a metric, so what is further than twice the allowed
distance from the hub (by a lower bound, from bitmaps) cannot be near to what is within it. Candidates whose
collision-corrected similarity, by bit counts, is more than SLACK below the threshold are dropped (about five standard
deviations), as are those whose parity bitmaps (a bit flipped for each shingle) differ in more bits than similar sets can
differ in shingles; the others are confirmed on full sets. A pair at the threshold shares no band with probability
(1 - 0.8**4)**32 = 5e-8.

Defined results: a text without words (or null) has an empty set and links with nothing; a text of fewer than k words has one
shingle, the whole sequence; a text of any length is taken whole; doc_id has to be a bigint; documents are identified by doc_id, so rows that repeat a doc_id share a component; a null
doc_id links with nothing, has no component and is kept; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrazzo.llm.common import ASCII_LOWER, U64, blocks, drop, give_back, mix, spaced, span_hashes, stash, utf8, word_spans
from terrazzo.llm.components import components

HASHES, BANDS, ROWS, BITS, SLACK, PARITY = 128, 32, 4, 4, 0.18, 512
_RNG = np.random.default_rng(41)
A, B = _RNG.integers(0, 2**63, HASHES, dtype=np.uint64) * U64(2) + U64(1), _RNG.integers(0, 2**63, HASHES, dtype=np.uint64)
PLACE = _RNG.integers(0, 2**63, 64, dtype=np.uint64) * U64(2) + U64(1)
SIGN = "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, bands array<bigint>, sig array<bigint>"


def shingles(data: np.ndarray, offsets: np.ndarray, k: int, seed: int = 0) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    for a, b in blocks(offsets, 1 << 18):
        buf, starts = spaced(data, offsets, a, b)
        buf = ASCII_LOWER[buf]
        first, last, upto = word_spans(buf, starts)
        words = span_hashes(buf, first, last, seed)
        n = len(words) - k + 1
        runs = np.zeros(max(0, n), np.uint64)
        for j in range(k if n > 0 else 0):
            runs += words[j : j + n] * PLACE[j]
        runs = mix(runs)
        for lo, hi in zip(upto, upto[1:], strict=False):
            if hi - lo >= k:
                yield np.unique(runs[lo : hi - k + 1])
            elif hi > lo:
                yield mix((words[lo:hi] * PLACE[: hi - lo]).sum(keepdims=True) + U64(hi - lo))
            else:
                yield np.zeros(0, np.uint64)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """HASHES minima of each non-empty set."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), HASHES), np.uint64)
    for j in range(HASHES):
        out[:, j] = np.minimum.reduceat(flat * A[j] + B[j], starts)
    return out


def pack(low: np.ndarray) -> np.ndarray:
    """Low bits of the minima as 64-bit words."""
    each = 64 // BITS
    words = low.reshape(len(low), -1, each) << (U64(BITS) * np.arange(each, dtype=np.uint64))
    return np.bitwise_or.reduce(words, axis=2)


def parity(sets: list[np.ndarray]) -> np.ndarray:
    """PARITY bits of each set as 64-bit words: two sets differ in at least as many shingles as bits."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    bit = ((np.concatenate(sets) * PLACE[7]) >> U64(32)).astype(np.int64) % PARITY
    odd = np.bincount(row * PARITY + bit, minlength=len(sets) * PARITY).reshape(len(sets), -1, 64).astype(np.uint64) & U64(1)
    return np.bitwise_or.reduce(odd << np.arange(64, dtype=np.uint64), axis=2)


def signed(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            data, offsets = utf8(batch.column("text"))
            size, keys = np.zeros(n, np.int64), np.zeros((n, 2), np.uint64)
            bands, sig = np.zeros((n, BANDS), np.uint64), np.zeros((n, (HASHES * BITS + PARITY) // 64), np.uint64)
            held: list[np.ndarray] = []
            rows: list[int] = []

            def flush() -> None:
                if rows:
                    m = minima(held)
                    bands[rows] = mix((m.reshape(len(rows), BANDS, ROWS) * PLACE[:ROWS]).sum(axis=2) + np.arange(BANDS, dtype=np.uint64) * PLACE[ROWS])
                    sig[rows] = np.concatenate([pack((m * PLACE[5]) >> U64(64 - BITS)), parity(held)], axis=1)
                    held.clear()
                    rows.clear()

            for i, s in enumerate(shingles(data, offsets, k)):
                size[i] = len(s)
                if len(s):
                    keys[i] = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.uint64)
                    held.append(s)
                    rows.append(i)
                    if sum(map(len, held[-64:])) > 1 << 15 or len(held) >= 512:
                        flush()
            flush()
            full = pa.array(size == 0)
            lists = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * x.shape[1]), pa.array(x.view(np.int64).ravel()), mask=full)
            ids = [pa.array(keys[:, j].copy().view(np.int64), mask=size == 0) for j in (0, 1)]
            columns = [batch.column("doc_id"), pa.array(size), *ids, lists(bands), lists(sig)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "k1", "k2", "bands", "sig"])
        give_back()

    return run


def similarity(x: Column, y: Column) -> Column:
    """Estimated Jaccard similarity of two signatures: the share of equal b-bit values, less what chance makes equal."""
    ones = sum(1 << i for i in range(0, 64, BITS))
    unequal = None
    for i in range(HASHES * BITS // 64):
        d = x[i].bitwiseXOR(y[i])
        s = BITS
        while s > 1:  # each value's lowest bit gathers the others
            s //= 2
            d = d.bitwiseOR(F.shiftrightunsigned(d, s))
        c = F.bit_count(d.bitwiseAND(F.lit(ones)))
        unequal = c if unequal is None else unequal + c
    chance = 2.0**-BITS
    return (1 - unequal / HASHES - chance) / (1 - chance)


def confirmed(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = batch.column("u").to_numpy(), batch.column("v").to_numpy()
            sides = (shingles(*utf8(batch.column(c)), k, 1) for c in ("text_u", "text_v"))
            keep = []
            for x, y in zip(*sides, strict=True):
                least, most = sorted((len(x), len(y)))
                both = len(np.intersect1d(x, y, assume_unique=True)) if 100 * least >= percent * most else 0
                keep.append(bool(most) and 100 * both >= percent * (len(x) + len(y) - both))
            keep = np.array(keep, bool)
            yield pa.RecordBatch.from_arrays([pa.array(u[keep]), pa.array(v[keep])], ["u", "v"])
        give_back()

    return run


def confirm(pairs: DataFrame, documents: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs u, v whose full sets are similar enough."""
    text = documents.select("doc_id", "text")
    wide = pairs.join(text.select(F.col("doc_id").alias("u"), F.col("text").alias("text_u")), "u").join(text.select(F.col("doc_id").alias("v"), F.col("text").alias("text_v")), "v")
    return wide.mapInArrow(confirmed(k, percent), "u bigint, v bigint")


def unequal_bits() -> Column:
    """Bits in which the parity bitmaps of x and y differ: at most as many as shingles that only one of them has."""
    words = range(HASHES * BITS // 64, (HASHES * BITS + PARITY) // 64)
    counts = [F.bit_count(F.col("x.sig")[i].bitwiseXOR(F.col("y.sig")[i])) for i in words]
    return sum(counts[1:], counts[0])


def ordered(a: str | Column, b: str | Column) -> list[Column]:
    return [F.least(a, b).alias("u"), F.greatest(a, b).alias("v")]


def near_duplicates(documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id that links reach), kept: a row for each document."""
    own = documents.select("doc_id", "text")
    signs = stash(own.mapInArrow(signed(k), SIGN), "signs")
    linked = signs.where("n_shingles > 0 and doc_id is not null").select("doc_id", "k1", "k2")
    classes = linked.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"))
    of_doc = stash(linked.join(classes, ["k1", "k2"]).select("doc_id", "rep"), "classes")
    first = Window.partitionBy("doc_id")
    repeated = of_doc.withColumn("v", F.min("rep").over(first)).where("rep <> v").select(F.col("rep").alias("u"), "v")

    reps = signs.join(of_doc.where("doc_id = rep").select("doc_id").distinct(), "doc_id", "left_semi")
    short = stash(reps.select("doc_id", "n_shingles", "sig"), "short")  # read six times
    postings = reps.select("doc_id", F.explode("bands").alias("band"))
    full = postings.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    buckets = stash(postings.join(full, "band"), "buckets")
    both = F.col("x.n_shingles") + F.col("y.n_shingles")
    alike = similarity(F.col("x.sig"), F.col("y.sig")) >= percent / 100 - SLACK
    close = (unequal_bits() * (100 + percent) <= both * (100 - percent)) & alike

    # each member of a bucket meets the bucket's hub
    weight = buckets.groupBy("doc_id").agg(F.sum("n").alias("w"))
    central = F.max(F.struct("w", (-F.col("doc_id")).alias("id")))
    hubs = buckets.join(weight, "doc_id").groupBy("band").agg(central.alias("h")).select("band", (-F.col("h.id")).alias("hub"))
    met = stash(buckets.join(hubs, "band"), "met")
    pairs = met.where("doc_id <> hub").select(*ordered("doc_id", "hub")).distinct()
    x, y = short.alias("x"), short.alias("y")
    pairs = pairs.join(x, F.col("u") == F.col("x.doc_id")).join(y, F.col("v") == F.col("y.doc_id")).where(close).select("u", "v")
    near = stash(confirm(pairs, own, k, percent), "links")
    repeated = stash(repeated, "repeated")
    edges = near.unionByName(repeated)
    labels = components(edges)

    # which members are in their hub's component, and which link to the hub itself; a doc_id of several texts has several
    # sets, so its links tell nothing of distances
    once = of_doc.groupBy("doc_id").agg(F.count("*").alias("n")).where("n = 1")
    as_u, as_v = once.select(F.col("doc_id").alias("u")), once.select(F.col("doc_id").alias("v"))
    sure = near.join(as_u, "u", "left_semi").join(as_v, "v", "left_semi").select("u", "v")
    itself = once.select(F.col("doc_id").alias("u"), F.col("doc_id").alias("v"))
    sure = sure.unionByName(itself).distinct().withColumn("direct", F.lit(True))
    at = lambda c: labels.select(F.col("id").alias(c), F.col("component").alias(f"{c}_in"))
    # a hub's own figures reach the members by band: it is the hub of many bands, each of which has its members once
    of_band = met.select("band", "hub").distinct().join(at("hub"), "hub", "left").select("band", "hub", F.coalesce("hub_in", "hub").alias("hub_c"))
    inside = met.select("band", "doc_id").join(of_band, "band").join(at("doc_id"), "doc_id", "left")
    inside = inside.withColumn("c", F.coalesce("doc_id_in", "doc_id"))
    inside = inside.select("band", "doc_id", "hub", "c", "hub_c", *ordered("doc_id", "hub")).join(sure, ["u", "v"], "left")
    inside = stash(inside.select("band", "doc_id", "hub", "c", "hub_c", F.coalesce("direct", F.lit(False)).alias("direct")), "inside")

    # the others meet the rest of their buckets, but for what their distance from the hub rules out
    outside = inside.where("c <> hub_c").select("band", "doc_id", "hub", "c")
    far = unequal_bits() * percent > both * (100 - percent)
    hub_sets = outside.select("band", "hub").distinct().join(short.withColumnRenamed("doc_id", "hub"), "hub").alias("y")
    late = outside.alias("o").join(x, F.col("o.doc_id") == F.col("x.doc_id")).join(hub_sets, F.col("o.band") == F.col("y.band"))
    late = late.select("o.band", "o.doc_id", "o.c", "x.n_shingles", "x.sig", far.alias("far"))
    every = inside.select("band", "doc_id", "c", "direct").join(outside.select("band").distinct(), "band", "left_semi").join(short, "doc_id")

    def meet(late: DataFrame, every: DataFrame) -> DataFrame:
        apart = (F.col("x.band") == F.col("y.band")) & (F.col("x.c") != F.col("y.c"))
        return late.alias("x").join(every.alias("y"), apart & close).select(*ordered(F.col("x.doc_id"), F.col("y.doc_id")))

    rest = meet(late, every.where("not direct")).unionByName(meet(late.where("not far"), every.where("direct"))).distinct()
    labels = components(edges.unionByName(confirm(rest, own, k, percent)))
    drop(buckets, met, near, repeated, inside, short)

    by_doc = of_doc.join(labels, of_doc.rep == labels.id, "left").groupBy("doc_id").agg(F.min(F.coalesce("component", "rep")).alias("component_id"))
    whole = signs.select("doc_id", "n_shingles").join(by_doc, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return whole.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
