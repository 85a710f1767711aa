"""Exact removal of repeated substrings by a difference-cover suffix sort, dealt out by content.

Every window of LENGTH bytes owns an anchor: the leftmost of its least GRAM-byte hashes. Equal windows own equal anchors at
equal places, so only anchors that occur again have to be looked at, and windows of different anchors never meet: that
deals the suffixes out without loss. The windows of one anchor occurrence are consecutive and make a context; equal
contexts (two 64-bit hashes) repeat as wholes and one of them stands for all. Contexts are dealt by anchor, and each task
sorts the suffixes of its contexts by the difference cover modulo 3: sampled triples are sorted and named, names recurse
until they are distinct, the remaining suffixes are sorted by the sample's ranks and merged, and adjacent prefixes of LENGTH
bytes are compared byte by byte.

An anchor of more than SPLIT different contexts (many copies, each edited elsewhere) is divided further by content: its
windows are parted by their distance from the anchor, into thirds; the windows of a part share a core of bytes, which deals
them anew, and the slices that hold them are contexts of the next level. In the last level the core is the window itself. So
no task ever holds more than SPLIT contexts of a group, and equal windows meet at every level.

Defined results: a null text is empty; texts shorter than LENGTH keep all; longer ones of any size are worked through in
overlapping pieces; rows that repeat a document repeat each other (rows of equal doc_id and text get the same result); a
null doc_id stays null; doc_id is of any type that can be ordered; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrazzo.llm.common import U64, blocks, drop, mix, stash, utf8

LENGTH, GRAM, SPLIT, SLAB, PIECE = 200, 40, 512, 1 << 20, 1 << 20
_RNG = np.random.default_rng(20240229)
BYTE_KEYS = _RNG.integers(1, 2**63, (2, 256), dtype=np.uint64)
BASES = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASES[which]**i and its inverse modulo 2**64, for i < n."""
    if which not in _POWERS or len(_POWERS[which][0]) < n:
        made = []
        for base in (BASES[which], pow(BASES[which], -1, 1 << 64)):
            factors = np.full(max(n, 2 * PIECE), base, np.uint64)
            factors[0] = 1
            made.append(np.cumprod(factors, dtype=np.uint64))
        _POWERS[which] = made[0], made[1]
    up, down = _POWERS[which]
    return up[:n], down[:n]


def prefix_sums(buf: np.ndarray, which: int) -> np.ndarray:
    up, _ = powers(which, len(buf) + 1)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(BYTE_KEYS[which][buf] * up[: len(buf)], out=sums[1:])
    return sums


def anchors(buf: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: row, first and last window start and anchor (within the row), key, and the two hashes
    of the context."""
    sums, (_, down) = prefix_sums(buf, 0), powers(0, len(buf) + 1)
    h = mix((sums[gram:] - sums[: len(sums) - gram]) * down[: len(sums) - gram])
    place = np.arange(len(h), dtype=np.uint64)
    least = (h & ~U64((1 << 28) - 1)) | place  # a buffer holds far less than 2**28 bytes
    span, have = length - gram + 1, 1
    while 2 * have <= span:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < span:
        least = np.minimum(least[: len(least) - (span - have)], least[span - have :])
    of = (least & U64((1 << 28) - 1)).astype(np.int64)  # the anchor of each window start
    lens = np.diff(offsets)
    many = np.maximum(0, lens - length + 1)
    row = np.repeat(np.arange(len(lens)), many)
    start = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(offsets[:-1], many)
    own = of[start]
    cut = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (row[1:] != row[:-1])))[: len(row)]
    lo = start[cut]
    hi = start[np.append(cut[1:], len(row)) - 1]
    anchor, row = own[cut], row[cut]
    shape = (hi - lo).astype(np.uint64) * U64(0x9E3779B97F4A7C15) + (anchor - lo).astype(np.uint64)
    context = []
    for which in range(2):
        sums, (_, down) = sums if not which else prefix_sums(buf, which), powers(which, len(buf) + 1)
        context.append(mix(mix((sums[hi + length] - sums[lo]) * down[lo]) + shape))
    return row, lo - offsets[row], hi - offsets[row], anchor - offsets[row], h[anchor], *context


def pieces(offsets: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, int]]:
    """First row, offsets in the data, and place in the row: rows together, or a part of one long row. Each window is in one."""
    for a, b in blocks(offsets, PIECE // 2):
        at = offsets[a : b + 1]
        if b - a > 1 or at[-1] - at[0] <= PIECE:
            yield a, at, 0
        else:
            for s in range(0, int(at[1] - at[0]) - length + 1, PIECE):
                yield a, np.array([at[0] + s, min(at[1], at[0] + s + PIECE + length - 1)]), s


def anchored(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for a, at, base in pieces(offsets, length):
                if at[-1] - at[0] >= length:
                    row, lo, hi, anchor, *hashes = anchors(data[at[0] : at[-1]], at - at[0], length, gram)
                    own = pa.array(a + row)
                    places = [pa.array((base + x).astype(np.int32)) for x in (lo, hi, anchor)]
                    columns = [batch.column("doc_id").take(own), batch.column("row").take(own), *places, *(pa.array(x.view(np.int64)) for x in hashes)]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "lo", "hi", "at", "key", "c1", "c2"])

    return run


def suffix_order(t: np.ndarray) -> np.ndarray:
    """Suffixes of t (positive integers below 2**21, fewer than 2**21 of them) in order, by the difference cover {1, 2} modulo 3."""
    n = len(t)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: t[i:].tolist()), np.int64)
    t = np.concatenate([t, np.zeros(3, np.int64)])
    width = int(t.max()) + 1
    first = np.arange(1, n + (n % 3 == 1), 3)  # a sample at n keeps the two halves apart
    sample = np.concatenate([first, np.arange(2, n, 3)])
    _, names = np.unique((t[sample] * width + t[sample + 1]) * width + t[sample + 2], return_inverse=True)
    names = names.astype(np.int64) + 1
    if names.max() < len(names):
        order = suffix_order(names)
    else:
        order = np.argsort(names)
    rank = np.zeros(n + 3, np.int64)
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    sample = sample[order]
    sample = sample[sample < n]
    ranks = len(sample) + 3
    zero = np.arange(0, n, 3)
    by_one = lambda i: t[i] * ranks + rank[i + 1]
    by_two = lambda i: (t[i] * width + t[i + 1]) * ranks + rank[i + 2]
    zero = zero[np.argsort(by_one(zero))]
    ones, twos = sample[sample % 3 == 1], sample[sample % 3 == 2]
    at = np.arange(len(zero)) + np.searchsorted(by_one(ones), by_one(zero)) + np.searchsorted(by_two(twos), by_two(zero))
    out, rest = np.empty(n, np.int64), np.ones(n, bool)
    out[at], rest[at] = zero, False
    out[rest] = sample
    return out


def repeated(texts: list[bytes], length: int) -> np.ndarray:
    """Window starts (in the texts laid end to end) whose first `length` bytes start another window as well, by suffix sorting."""
    lens = np.array([len(x) for x in texts])
    ends = np.cumsum(lens)
    t = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64) + 1
    order = suffix_order(t)
    room = np.repeat(ends, lens) - np.arange(len(t))
    order = order[room[order] >= length]
    same = np.ones(max(0, len(order) - 1), bool)
    for j in range(0, length, 8):  # adjacent prefixes, eight bytes at a time
        live = np.flatnonzero(same)
        x, y = order[live], order[live + 1]
        ok = np.ones(len(live), bool)
        for i in range(j, min(j + 8, length)):
            ok &= t[x + i] == t[y + i]
        same[live] = ok
    found = np.append(same, False) | np.append(False, same)
    return np.sort(order[found[: len(order)]])

def sorted_out(length: int):
    """Spans of repeated windows in the slices of whole groups, for slices that are not known to repeat as wholes."""

    def spans(held: list[tuple]) -> pa.RecordBatch:
        texts = [h[3] for h in held]
        starts = repeated(texts, length)
        begin = np.cumsum([0, *(len(x) for x in texts)])
        of = np.searchsorted(begin, starts, "right") - 1
        at = starts - begin[of] + np.array([h[2] for h in held])[of]
        part = ~np.array([h[4] for h in held])[of]
        of, at = of[part], at[part]
        cut = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (at[1:] != at[:-1] + 1))[: len(at)])
        last = np.append(cut[1:], len(at))[: len(cut)] - 1
        first = np.flatnonzero(np.append(True, of[cut][1:] != of[cut][:-1])[: len(cut)])
        own = of[cut][first]
        each = pa.StructArray.from_arrays([pa.array(at[cut], pa.int32()), pa.array(at[last] + length, pa.int32())], ["s", "e"])
        spans = pa.ListArray.from_arrays(pa.array(np.append(first, len(cut)), pa.int32()), each)
        return pa.RecordBatch.from_arrays([*(pa.array([held[i][j] for i in own], pa.int64()) for j in range(2)), spans], ["p1", "p2", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, group = 0, None
        for batch in batches:
            for g, *row in zip(*(batch.column(c).to_pylist() for c in ("key", "p1", "p2", "off", "body", "full")), strict=True):
                if g != group and size >= SLAB:
                    yield spans(held)
                    held, size = [], 0
                group = g
                held.append(tuple(row))
                size += len(row[3])
        if held:
            yield spans(held)

    return run


def batched(rows: Iterator[tuple[tuple, int]], names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Record batches of about 4 MB from rows and their sizes."""
    out: list[tuple] = []
    size = 0
    make = lambda: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
    for row, n in rows:
        out.append(row)
        size += n
        if size > 1 << 22:
            yield make()
            out, size = [], 0
    if out:
        yield make()


def cut_out(length: int):
    """The slices' bytes out of the texts."""

    def rows(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int]]:
        for text, wanted in zip(batch.column("text"), batch.column("wanted"), strict=True):
            body = text.as_py().encode()
            for w in wanted.as_py():
                own = body[w["lo"] : w["hi"] + length]
                yield (w["key"], w["p1"], w["p2"], w["off"], own, w["full"]), len(own) + 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from batched(rows(batch), ["key", "p1", "p2", "off", "body", "full"], [*[pa.int64()] * 3, pa.int32(), pa.binary(), pa.bool_()])

    return run


def divided(length: int, width: int):
    """Slices parted by the windows' distances from the anchor, `width` distances each; dealt by the bytes that all windows of
    the part share."""

    def rows(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int]]:
        for doc_id, row, text, wanted in zip(*(batch.column(c) for c in ("doc_id", "row", "text", "wanted")), strict=True):
            body, place = text.as_py().encode(), (doc_id.as_py(), row.as_py())
            for w in wanted.as_py():
                at, upto = w["at"], w["hi"]
                while upto >= w["lo"]:
                    part = (at - upto) // width
                    lo = max(w["lo"], at - (part + 1) * width + 1)
                    core = at - part * width
                    shape = f"{width} {part} {at - lo} {upto - lo} ".encode()
                    key = hashlib.blake2b(shape.split(b" ")[1] + body[core : core - width + 1 + length], digest_size=8, person=b"core").digest()
                    own = hashlib.blake2b(shape + body[lo : upto + length], digest_size=16).digest()
                    ints = [int.from_bytes(x, "little", signed=True) for x in (key, own[:8], own[8:])]
                    yield (*place, *ints, w["p1"], w["p2"], lo, upto, at, w["off"] + lo - w["lo"], w["full"]), 128
                    upto = lo - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = [batch.schema.field("doc_id").type, *[pa.int64()] * 6, *[pa.int32()] * 4, pa.bool_()]
            yield from batched(rows(batch), ["doc_id", "row", "key", "x1", "x2", "p1", "p2", "lo", "hi", "at", "off", "full"], kinds)

    return run


def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans"), strict=True):
            body = (text or "").encode()
            runs: list[list[int]] = []
            for s in sorted((x["s"], x["e"]) for x in spans.as_py() or ()):
                if runs and s[0] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], s[1])
                else:
                    runs.append(list(s))
            kept, upto = [], 0
            for s, e in runs:
                kept.append(body[upto:s])
                upto = e
            kept.append(body[upto:])
            rows.append((len(body), sum(e - s for s, e in runs), len(runs), b"".join(kept)))
        cols = [pa.array([r[j] for r in rows], pa.int64()) for j in range(3)]
        digests = pa.array([hashlib.sha256(r[3]).hexdigest() for r in rows], pa.string())
        columns = [batch.column("doc_id"), *cols, digests, pa.array([r[3] for r in rows], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

def same_row(x: str, y: str) -> Column:
    return (F.col(f"{x}.row") == F.col(f"{y}.row")) & F.col(f"{x}.doc_id").eqNullSafe(F.col(f"{y}.doc_id"))


SLICE = ("doc_id", "row", "lo", "hi", "at", "off", "full")


def repeated_spans(contexts: DataFrame, docs: DataFrame, length: int, gram: int) -> DataFrame:
    """p1, p2 (a context), spans (relative to it): of contexts that occur once, and share windows with others."""
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = contexts.select("key", F.col("c1").alias("p1"), F.col("c2").alias("p2"), "one.*", F.lit(0).alias("off"), (F.col("c") > 1).alias("full"))
    found, made, width = [], [], length - gram + 1

    def with_texts(rows: DataFrame) -> DataFrame:
        """A row that repeats another comes twice, but then all of its slices are known to repeat."""
        wanted = rows.groupBy("doc_id", "row").agg(F.collect_list(F.struct("key", "p1", "p2", *SLICE[2:])).alias("wanted"))
        return docs.alias("x").join(wanted.alias("y"), same_row("x", "y")).select("x.doc_id", "x.row", "text", "wanted")

    while True:
        kinds = own.groupBy("key").agg(F.count("*").alias("kinds")).where("kinds > 1")
        several = stash(own.join(kinds, "key"), "several")
        few = with_texts(several.where(F.col("kinds") <= SPLIT)).select("text", "wanted")
        bodies = few.mapInArrow(cut_out(length), "key bigint, p1 bigint, p2 bigint, off int, body binary, full boolean")
        ordered = bodies.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(sorted_out(length), "p1 bigint, p2 bigint, spans array<struct<s: int, e: int>>")
        found.append(stash(ordered, "spans"))
        hot = several.where(F.col("kinds") > SPLIT)
        made.append(several)
        if hot.isEmpty():
            break
        width = -(-width // 3)
        names = f"doc_id {kind}, row bigint, key bigint, x1 bigint, x2 bigint, p1 bigint, p2 bigint, lo int, hi int, at int, off int, full boolean"
        slices = stash(with_texts(hot).mapInArrow(divided(length, width), names), "slices")
        groups = stash(slices.groupBy("key", "x1", "x2").agg(F.count("*").alias("c"), F.min(F.struct("p1", "p2", *SLICE)).alias("one")), "groups")
        whole = slices.join(groups.where("c > 1").select("key", "x1", "x2"), ["key", "x1", "x2"]).where("not full")
        found.append(stash(whole.select("p1", "p2", F.array(F.struct(F.col("off").alias("s"), (F.col("off") + F.col("hi") - F.col("lo") + length).alias("e"))).alias("spans")), "spans"))
        own = groups.select("key", "one.*", "c").withColumn("full", F.col("full") | (F.col("c") > 1)).drop("c")
        made += [slices, groups]
    every = stash(reduce(DataFrame.unionByName, found).groupBy("p1", "p2").agg(F.flatten(F.collect_list("spans")).alias("spans")), "spans")
    drop(*found, *made)
    return every


def remove_repeats(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes; they may split a character)."""
    docs = documents.select("doc_id", "text", F.xxhash64("text").alias("row"))
    kind = documents.schema["doc_id"].dataType.simpleString()
    found = docs.where(F.octet_length("text") >= length).mapInArrow(anchored(length, gram), f"doc_id {kind}, row bigint, lo int, hi int, at int, key bigint, c1 bigint, c2 bigint")
    again = stash(found.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "again")
    places = stash(found.join(again, "key"), "places")
    contexts = stash(places.groupBy("key", "c1", "c2").agg(F.count("*").alias("c"), F.min(F.struct("doc_id", "row", "lo", "hi", "at")).alias("one")), "contexts")
    partial = repeated_spans(contexts, docs, length, gram)
    everything = F.array(F.struct(F.lit(0).alias("s"), (F.col("one.hi") - F.col("one.lo") + length).alias("e")))
    whole = contexts.where("c > 1").select(F.col("c1").alias("p1"), F.col("c2").alias("p2"), everything.alias("spans"))
    spans = whole.unionByName(partial)
    moved = F.transform("spans", lambda x: F.struct((F.col("lo") + x["s"]).alias("s"), (F.col("lo") + x["e"]).alias("e")))
    by_doc = places.join(spans, (F.col("c1") == F.col("p1")) & (F.col("c2") == F.col("p2"))).groupBy("doc_id", "row").agg(F.flatten(F.collect_list(moved)).alias("spans"))
    by_doc = stash(by_doc, "by-doc")
    drop(again, places, contexts, partial)
    marked = docs.alias("x").join(by_doc.alias("y"), same_row("x", "y"), "left").select("x.doc_id", "text", "spans")
    names = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    return marked.mapInArrow(removed, names)
