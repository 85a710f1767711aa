"""Benchmark decontamination by latent semantic retrieval.

Texts become TF-IDF vectors over the benchmark's vocabulary; frequencies are counted over all document blocks of BLOCK
words. A randomised SVD in one distributed pass: with all document blocks A and the benchmark items B (weighted W, so that
the space is spanned by what has to be retrieved) the range of M = A'A + W B'B is sketched as Y = M Q for random Q, M is
projected to the small core Q'Y, and the SVD of Y times the inverse square root of the core gives M's eigenvectors (the
right singular vectors of the stacked passages) and eigenvalues (the Nystrom form of the randomised SVD). Each passage (two
adjacent blocks) is projected as the sum of its words' latent vectors, and items whose cosine reaches COSINE are candidates.
So is an item of whose answer words (below) half stand within its own length, as the cosine of a short item depends on the
words around it. A candidate is a leak if the item's longest common subsequence with the words around the passage (of the
latter: within less than its length from those answer words) covers SHARE of the item, which a paraphrase that keeps the
order still does, and if the answer (the quarter of the item's words that are rarest) is there by at least a third.

A benchmark travels to every task in rounds of at most LARGEST items, each with its own latent space and its own pass over
the documents; what they find is united. Weights, answers and the words around a passage do not depend on the rounds.

Sums over the words of a block split by frequency: the FREQUENT most frequent words of the vocabulary go through a dense
count matrix, the others through their vectors one by one.

Defined results: a null text, or one without words, has no leak; a text of any length is searched whole; of items of equal
cosine all are candidates; benchmark items that are null or have no words are ignored; repeated rows give repeated rows;
extra columns are ignored; without benchmark items nothing leaks; an empty documents table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrazzo.llm.common import ASCII_LOWER, U64, blocks, give_back, spaced, span_hashes, stash, utf8, word_spans

BLOCK, RANK, WEIGHT, COSINE, SHARE, FREQUENT, PIECE = 32, 256, 10.0, 0.4, 0.6, 64, 1 << 13
LARGEST = RANK - 8  # items of a round; more than the space has dimensions for would blur each other
TOKEN = np.zeros(256, bool)
TOKEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def tokens(data: np.ndarray, offsets: np.ndarray, size: int = 1 << 19) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges, the hashes of their words, and for each row (and the end) the number of words before it."""
    for a, b in blocks(offsets, size):
        buf, starts = spaced(data, offsets, a, b)
        buf = ASCII_LOWER[buf]
        first, last, upto = word_spans(buf, starts, TOKEN)
        yield a, b, span_hashes(buf, first, last), upto


class Items:
    """The benchmark: words of each item as numbers of a sorted vocabulary of word hashes."""

    def __init__(self, rows: list[tuple[int, str]]):
        texts = pa.array([t for _, t in rows], pa.large_string())
        words = []
        for _, _, hashes, upto in tokens(*utf8(texts)):
            words += [hashes[lo:hi] for lo, hi in zip(upto, upto[1:], strict=False)]
        full = [k for k, w in enumerate(words) if len(w)]
        self.ids = np.array([rows[k][0] for k in full], np.int64)
        self.vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *(words[k] for k in full)]))
        self.words = [np.searchsorted(self.vocabulary, words[k]) for k in full]
        n = len(self.vocabulary)
        slot = (self.vocabulary & U64((1 << max(10, (16 * n).bit_length())) - 1)).astype(np.int64)
        self.slots = np.full(1 << max(10, (16 * n).bit_length()), -1, np.int32)  # the word of each slot; -2 if it has several
        self.slots[slot] = np.where(np.bincount(slot, minlength=len(self.slots))[slot] == 1, np.arange(n), -2)
        self.masks: list[dict[int, int]] = []
        for w in self.words:
            mask: dict[int, int] = {}
            for i, x in enumerate(w.tolist()):
                mask[x] = mask.get(x, 0) | 1 << i
            self.masks.append(mask)

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary numbers; -1 for other words."""
        out = self.slots[(hashes & U64(len(self.slots) - 1)).astype(np.int64)]
        several = np.flatnonzero(out == -2)
        out[several] = np.minimum(np.searchsorted(self.vocabulary, hashes[several]), len(self.vocabulary) - 1)
        return np.where((out >= 0) & (self.vocabulary[out] == hashes), out, -1)

    def weigh(self, frequency: np.ndarray, total: int) -> None:
        self.idf = np.log((1.0 + total) / (1.0 + frequency))
        n = len(self.vocabulary)
        self.frequent = np.argsort(-frequency, kind="stable")[:FREQUENT]
        self.column = np.full(n, -1)
        self.column[self.frequent] = np.arange(len(self.frequent))
        self.rows = np.stack([np.bincount(w, minlength=n) * self.idf for w in self.words])
        self.answers = []
        for w in self.words:
            own = np.unique(w)
            self.answers.append(set(own[np.argsort(-self.idf[own], kind="stable")][: max(1, len(own) // 4)].tolist()))
        pairs = np.array([(w, k) for k, own in enumerate(self.answers) for w in own], int).reshape(-1, 2)
        pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
        self.owners, self.owned = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(n + 1))
        self.sizes = np.array([len(w) for w in self.words], int)
        self.half = np.array([-(-len(a) // 2) for a in self.answers], int)

    def block_sums(self, vectors: np.ndarray, number: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
        """Sums of the words' vectors by ascending block number; the counts of frequent words, and which words are others."""
        column = self.column[number]
        often = column >= 0
        width = len(self.frequent)
        counts = np.bincount(of[often] * width + column[often], minlength=n * width).reshape(n, width).astype(np.float32)
        out = counts @ vectors[self.frequent]
        other = np.flatnonzero(~often)
        if len(other):
            own = of[other]
            starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            out[own[starts]] += np.add.reduceat(vectors[number[other]], starts, axis=0)
        return out, counts, other

    def common(self, item: int, region: np.ndarray) -> int:
        """Length of the longest common subsequence, bit-parallel."""
        n, mask = len(self.words[item]), self.masks[item]
        ones = (1 << n) - 1
        v = ones
        for w in region.tolist():
            if w in mask:
                u = v & mask[w]
                v = (v + u | v - u) & ones
        return n - v.bit_count()

    def near(self, number: np.ndarray, upto: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Row, item, start and end of all places where half of an item's answer words stand within its length."""
        at = np.flatnonzero(number >= 0)
        first, many = self.owned[number[at]], np.diff(self.owned)[number[at]]
        at = np.repeat(at, many)
        item = self.owners[np.repeat(first - np.cumsum(many) + many, many) + np.arange(len(at))]
        order = np.argsort(item, kind="stable")
        at, item = at[order], item[order]
        row = np.searchsorted(upto, at, "right") - 1
        end = np.arange(len(at)) + self.half[item] - 1
        start = np.flatnonzero(end < len(at))
        end = end[start]
        met = (item[end] == item[start]) & (row[end] == row[start]) & (at[end] - at[start] < self.sizes[item[start]])
        start, end = start[met], end[met]
        size, row, item = self.sizes[item[start]], row[start], item[start]
        lo, hi = np.maximum(upto[row], at[end] - size + 1), np.minimum(upto[row + 1], at[start] + size)
        return zip(row.tolist(), item.tolist(), lo.tolist(), hi.tolist(), strict=True)


def block_of(upto: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block of each word (blocks never cross rows), and the first block of each row (and the end)."""
    lens = np.diff(upto)
    first = np.concatenate([[0], np.cumsum(-(-lens // BLOCK))])
    inside = np.arange(upto[-1]) - np.repeat(upto[:-1], lens)
    return np.repeat(first[:-1], lens) + inside // BLOCK, first


def _summed(documents: DataFrame, part, size: int) -> np.ndarray:
    """The sum over all partitions of the float64 vectors that part yields; pieces of PIECE values are added up apart."""

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            part(total, *utf8(batch.column("text")))
        for k in range(0, size, PIECE):
            yield pa.RecordBatch.from_arrays([pa.array([k // PIECE], pa.int32()), pa.array([total[k : k + PIECE].tobytes()], pa.binary())], ["k", "x"])
        give_back()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, x in zip(batch.column("k").to_pylist(), batch.column("x"), strict=True):
                own = np.frombuffer(x.as_buffer())
                if k in sums:
                    sums[k] += own
                else:
                    sums[k] = own.copy()
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["k", "x"])

    dealt = documents.select("text").mapInArrow(one, "k int, x binary").repartition(-(-size // PIECE), "k").mapInArrow(add, "k int, x binary")
    out = np.zeros(size)
    for r in dealt.toLocalIterator():
        out[r.k * PIECE : (r.k + 1) * PIECE] += np.frombuffer(r.x)
    return out


def weighted(items: Items, hashes: np.ndarray, upto: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Known words of a range: their numbers and blocks; the first block of each row."""
    of, first = block_of(upto)
    number = items.number(hashes)
    known = number >= 0
    return number[known], of[known], first


def rounds(usable: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Distinct items by item_id and text, at most LARGEST at once."""
    rest = usable
    while rows := rest.orderBy("item_id", "text").limit(LARGEST).collect():
        yield [(r.item_id, r.text) for r in rows]
        last = rows[-1]
        rest = usable.where((F.col("item_id") > last.item_id) | ((F.col("item_id") == last.item_id) & (F.col("text") > last.text)))


def fit(documents: DataFrame, rows: list[tuple[int, str]], rank: int = RANK) -> tuple[Items, np.ndarray] | None:
    """Items with their weights, and the latent space (a vector for each word); None without items."""
    items = Items(rows)
    if not len(items.ids):
        return None
    n = len(items.vocabulary)
    shared = documents.sparkSession.sparkContext.broadcast(items)

    def count(total: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
        for _, _, hashes, upto in tokens(data, offsets):
            number, of, first = weighted(shared.value, hashes, upto)
            total[:-1] += np.bincount(np.unique(of * n + number) % n, minlength=n)
            total[-1] += first[-1]

    counted = _summed(documents, count, n + 1)
    items.weigh(counted[:-1], int(counted[-1]))
    rank = min(rank, len(items.ids) + 8, n)
    start = np.random.default_rng(5).standard_normal((n, rank)).astype(np.float32)
    heavy = documents.sparkSession.sparkContext.broadcast((items, (start * items.idf[:, None]).astype(np.float32)))

    def multiply(total: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
        items, omega = heavy.value
        g = total.reshape(n, rank)
        for _, _, hashes, upto in tokens(data, offsets, 1 << 18):
            number, of, first = weighted(items, hashes, upto)
            y, counts, other = items.block_sums(omega, number, of, int(first[-1]))
            g[items.frequent] += (counts.T @ y) * items.idf[items.frequent, None]
            if len(other):
                other = other[np.argsort(number[other], kind="stable")]
                own = number[other]
                starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
                g[own[starts]] += np.add.reduceat(y[of[other]], starts, axis=0) * items.idf[own[starts], None]

    g = _summed(documents, multiply, n * rank).reshape(n, rank)
    g /= max(1.0, float(np.linalg.norm(g)))
    b = items.rows / np.linalg.norm(items.rows, axis=1, keepdims=True).clip(1e-9)
    g += WEIGHT * b.T @ (b @ start)
    return items, eigenvectors(g, start.astype(np.float64))[0].astype(np.float32)


def eigenvectors(sketch: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvectors and eigenvalues, descending, of a positive semidefinite M from sketch = M @ start."""
    core = start.T @ sketch
    values, basis = np.linalg.eigh((core + core.T) / 2)
    sound = values > values.max(initial=0) * 1e-9  # directions that only rounding fills are left out
    vectors, roots, _ = np.linalg.svd(sketch @ (basis[:, sound] / np.sqrt(values[sound])), full_matrices=False)
    return vectors, roots**2


def search(documents: DataFrame, fitted: tuple[Items, np.ndarray] | None, room: int) -> DataFrame:
    """All columns of documents but the text, item_ids and best, of one round's items."""
    shared = documents.sparkSession.sparkContext.broadcast(fitted)
    keys = [c for c in documents.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if shared.value is not None:
            items, space = shared.value
            latent = items.rows @ space
            latent = (latent / np.linalg.norm(latent, axis=1, keepdims=True).clip(1e-9)).astype(np.float32)
            words = (space * items.idf[:, None]).astype(np.float32)
        for batch in batches:
            found: list[list[int]] = [[] for _ in range(batch.num_rows)]
            best = np.zeros(batch.num_rows)
            for a, b, hashes, upto in tokens(*utf8(batch.column("text")), 1 << 18) if shared.value is not None else ():
                of, first = block_of(upto)
                number = items.number(hashes)
                known = number >= 0
                z, _, _ = items.block_sums(words, number[known], of[known], int(first[-1]))
                last = np.zeros(len(z), bool)
                last[first[1:][np.diff(first) > 0] - 1] = True
                z[:-1] += np.where(last[:-1, None], 0, z[1:])
                z /= np.sqrt(np.einsum("ij,ij->i", z, z)).clip(1e-9)[:, None]
                passage, item = np.nonzero(z @ latent.T >= COSINE)
                row = np.searchsorted(first, passage, "right") - 1
                begin = upto[row] + (passage - first[row]) * BLOCK
                lo, hi = np.maximum(upto[row], begin - room), np.minimum(upto[row + 1], begin + 2 * BLOCK + room)
                around = zip(row.tolist(), item.tolist(), lo.tolist(), hi.tolist(), strict=True)
                for r, i, lo, hi in chain(around, items.near(number, upto)):
                    if items.ids[i] in found[a + r]:
                        continue
                    own = number[lo:hi]
                    share = items.common(i, own) / len(items.words[i])
                    if share >= SHARE and 3 * len(items.answers[i].intersection(own.tolist())) >= len(items.answers[i]):
                        found[a + r].append(int(items.ids[i]))
                        best[a + r] = max(best[a + r], share)
            yield pa.RecordBatch.from_arrays([*map(batch.column, keys), pa.array([sorted(x) for x in found], pa.list_(pa.int64())), pa.array(best)], [*keys, "item_ids", "best"])
        give_back()

    kinds = ", ".join(f"{c} {documents.schema[c].dataType.simpleString()}" for c in keys)
    return documents.mapInArrow(run, f"{kinds}, item_ids array<bigint>, best double")


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_ids array<bigint> (ascending, of all leaked items), best (the highest share of an item found)."""
    usable = benchmark.where("text is not null and item_id is not null").select("item_id", "text").distinct()
    room = usable.agg(F.max(F.regexp_count("text", F.lit(WORD)))).first()[0] or 0
    own, earlier = documents.select("doc_id", "text"), []
    keyed = own.withColumn("key", F.sha2("text", 256))  # what is found depends on the text alone
    every = rounds(usable)
    items, more = next(every, []), next(every, None)
    while more:
        found = search(keyed, fit(documents, items), room)
        earlier.append(stash(found.where(F.size("item_ids") > 0).distinct(), "leaks"))
        items, more = more, next(every, None)
    if not earlier:
        return search(own, fit(documents, items), room)
    united = reduce(DataFrame.unionByName, earlier).groupBy("doc_id", "key").agg(F.flatten(F.collect_list("item_ids")).alias("before"), F.max("best").alias("highest")).alias("e")
    last = search(keyed, fit(documents, items), room).alias("l")
    both = last.join(united, F.col("l.doc_id").eqNullSafe(F.col("e.doc_id")) & (F.col("l.key") == F.col("e.key")), "left")
    ids = F.when(F.col("before").isNull(), F.col("item_ids")).otherwise(F.sort_array(F.array_union("item_ids", "before")))
    return both.select("l.doc_id", ids.alias("item_ids"), F.greatest("best", "highest").alias("best"))


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any leak, with all their columns."""
    found = leaks(documents, benchmark).where(F.size("item_ids") > 0).select("doc_id").distinct()
    return documents.join(found, "doc_id", "left_anti").select(*documents.columns)
