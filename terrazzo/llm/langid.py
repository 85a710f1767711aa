"""Language identification by prediction by partial matching (PPM).

Each language has a context tree of byte n-grams up to ORDER bytes of context, counted on a bounded sample of labelled
rows and then frozen. A symbol that a context has seen c times out of n, among d distinct ones, costs -log2(c / (n + d));
an unseen one costs the escape -log2(d / (n + d)) and is coded by the next shorter context, down to a uniform order -1.
(Method C, without exclusions.) As the statistics are frozen, the cost of a byte depends on the longest context that any
language knows and on the byte alone. Costs are tabulated once, sparsely: a row of costs (one for each language) for each
gram that any language has seen, a row of escapes for each context, and a number for each (context, byte) that says which
row, or that the next shorter context decides. Whole texts are scored exactly by look-ups.

Sample: the first LARGEST characters of the SAMPLE rows of each language that come first by hash of doc_id.

Defined results: a null text, or one without any letter, is `und` with score 0; a text of any length is scored whole; equal
code lengths go to the language that sorts first; repeated rows give repeated rows; with no labelled row at all every text is
`und`; extra columns pass through, but for lang_pred, score and bits_per_byte, which are replaced; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrazzo.llm.common import blocks, give_back, utf8

ORDER, SAMPLE, LARGEST = 3, 300, 64 << 10
UNKNOWN = "und"


class Model:
    """Costs of the grams that any language has seen, and escapes of their contexts; one column for each language.

    Bytes are folded to the classes that the sample holds, and one class for all others; class 0 is the start of a text.
    A state is the longest known context, at most ORDER classes; `state_of` has it for each ORDER last classes, `shorter`
    the state without its oldest class (-1 for the empty context), `slot` the row of costs for each state and class (-1 if
    no language has seen them).
    """

    def __init__(self, sample: dict[str, list[bytes]], order: int = ORDER):
        self.langs = sorted(sample)
        self.order = order
        seen = np.zeros(256, bool)
        for texts in sample.values():
            for t in texts:
                seen[np.frombuffer(t, np.uint8)] = True
        self.fold = np.full(256, seen.sum() + 1, np.int32)
        self.fold[seen] = np.arange(1, seen.sum() + 1)
        self.size = size = int(seen.sum()) + 2
        grams = []  # for each language and length, the distinct grams and their counts
        for lang in self.langs:
            rows = [np.concatenate([np.zeros(order, np.int64), self.fold[np.frombuffer(t, np.uint8)]]) for t in sample[lang]]
            own = []
            for k in range(1, order + 2):
                codes = [self._codes(r, k)[order - k + 1 :] for r in rows]
                own.append(np.unique(np.concatenate([*codes, np.zeros(0, np.int64)]), return_counts=True))
            grams.append(own)
        union = [np.unique(np.concatenate([own[k][0] for own in grams])) for k in range(order + 1)]
        contexts = [np.unique(u // size) for u in union]
        begin = np.cumsum([0, *map(len, contexts)])
        width = len(self.langs)
        self.shorter = np.full(begin[-1], -1, np.int32)
        self.slot = np.full(begin[-1] * size, -1, np.int32)
        self.escape = np.zeros((begin[-1], width), np.float32)
        self.cost = np.zeros((0, width), np.float32)
        for k in range(order + 1):
            known, codes = contexts[k], union[k]
            if k:
                self.shorter[begin[k] : begin[k + 1]] = begin[k - 1] + np.searchsorted(contexts[k - 1], known % size ** (k - 1))
            row = np.searchsorted(known, codes // size)
            state = begin[k] + row
            below = self.bits_of(self.shorter[state], codes % size)
            cost = np.empty((len(codes), width), np.float32)
            for j, own in enumerate(grams):
                mine, counts = own[k]
                at = np.searchsorted(known, mine // size)
                total, kinds = np.bincount(at, counts, minlength=len(known)), np.bincount(at, minlength=len(known))
                met = total > 0
                out = np.where(met, -np.log2(np.where(met, kinds, 1) / np.where(met, total + kinds, 1)), 0.0)
                self.escape[begin[k] : begin[k + 1], j] = out
                cost[:, j] = below[:, j] + out[row]
                cost[np.searchsorted(codes, mine), j] = -np.log2(counts / (total[at] + kinds[at]))
            self.slot[state * size + codes % size] = len(self.cost) + np.arange(len(codes))
            self.cost = np.concatenate([self.cost, cost])
        state = np.zeros(1, np.int64)
        for k in range(1, order + 1):  # index: the last k classes, oldest first
            state = np.tile(state, size)
            state[contexts[k]] = begin[k] + np.arange(len(contexts[k]))
        self.state_of = state.astype(np.int32)

    def bits_of(self, state: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Costs of classes in their states, under each language; state -1 codes as many symbols as there are bytes."""
        if not len(self.cost):
            return np.full((len(state), len(self.langs)), np.log2(256.0), np.float32)
        slot = self.slot[np.maximum(0, state).astype(np.int64) * self.size + classes]
        slot[state < 0] = -1
        bits = self.cost.take(np.maximum(slot, 0), axis=0)
        left = np.flatnonzero(slot < 0)
        bits[left] = 0
        while len(left):
            now, own = state[left], classes[left]
            bits[left[now < 0]] += np.float32(np.log2(256.0))
            left, now, own = left[now >= 0], now[now >= 0], own[now >= 0]
            slot = self.slot[now.astype(np.int64) * self.size + own]
            bits[left] += np.where(slot[:, None] >= 0, self.cost.take(np.maximum(slot, 0), axis=0), self.escape[now])
            left, now = left[slot < 0], now[slot < 0]
            state = state.copy() if len(left) else state
            state[left] = self.shorter[now]
        return bits

    def _codes(self, classes: np.ndarray, k: int) -> np.ndarray:
        """Each position's last k classes as one number; the first k - 1 positions lack them and are left out."""
        out = np.zeros(len(classes) - k + 1, np.int64)
        for i in range(k):
            out = out * self.size + classes[i : len(classes) - k + 1 + i]
        return out

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each row under each language."""
        out = np.zeros((len(offsets) - 1, len(self.langs)))
        pad = self.order
        for a, b in blocks(offsets, 1 << 18):
            lo, hi = int(offsets[a]), int(offsets[b])
            starts = offsets[a:b] - lo + pad * np.arange(1, b - a + 1)
            classes = np.zeros(hi - lo + pad * (b - a), np.int32)
            real = np.ones(len(classes), bool)
            real[(starts[:, None] - np.arange(1, pad + 1)).ravel()] = False
            classes[real] = self.fold[data[lo:hi]]
            n = len(classes) - pad
            if n <= 0:
                continue
            context = np.zeros(n, np.int32)
            for i in range(pad):
                context *= self.size
                context += classes[i : i + n]
            state, classes = self.state_of[context][real[pad:]], classes[pad:][real[pad:]]
            lens = np.diff(offsets[a : b + 1])
            full = lens > 0
            if len(state):
                first = (offsets[a:b] - lo)[full]
                bits = self.bits_of(state, classes)
                for j in range(len(self.langs)):
                    out[a:b, j][full] = np.add.reduceat(bits[:, j], first, dtype=np.float64)
        return out


def letters(column: pa.Array) -> np.ndarray:
    """Whether each text has a letter; a null one has none."""
    return pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)


def fit(documents: DataFrame, labelled: Column, per_language: int = SAMPLE, largest: int = LARGEST) -> Model | None:
    """The model of the bounded sample that the module's description names; None without labelled rows."""
    rows = documents.where(labelled & F.col("lang").isNotNull() & (F.octet_length("text") > 0))
    rows = rows.select("lang", "text", F.struct(F.xxhash64("doc_id").alias("h"), F.col("doc_id"), F.xxhash64("text").alias("t")).alias("place"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("place"))
    # places alone tell how far each language's sample reaches, a row for each language; only its texts are then shuffled
    reach = rows.select("lang", "place").withColumn("n", first).where(F.col("n") <= per_language).groupBy("lang").agg(F.max("place").alias("last"))
    picked = rows.join(F.broadcast(reach), "lang").where("place <= last").withColumn("n", first).where(F.col("n") <= per_language)
    picked = picked.select("lang", F.substring("text", 1, largest).alias("text"))
    sample: dict[str, list[bytes]] = {}
    for row in picked.toLocalIterator():
        sample.setdefault(row.lang, []).append(row.text.encode())
    return Model(sample) if sample else None


def identify(documents: DataFrame, model: Model | None) -> DataFrame:
    """All columns of documents, and lang_pred, score (the posterior of lang_pred among the languages, all equally likely
    before), bits_per_byte (of the best language; null for und)."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            n = batch.num_rows
            column = batch.column("text")
            known = letters(column)
            pred, score, rate = np.full(n, UNKNOWN, object), np.zeros(n), np.full(n, np.nan)
            if m is not None and n:
                data, offsets = utf8(column)
                bits = m.code_lengths(data, offsets)
                best = bits.argmin(axis=1)
                least = bits[np.arange(n), best]
                post = 1 / np.exp2(np.minimum(0, least[:, None] - bits)).sum(axis=1)
                lens = np.maximum(1, np.diff(offsets))
                pred = np.where(known, np.array(m.langs, object)[best], UNKNOWN)
                score, rate = np.where(known, post, 0.0), np.where(known, least / lens, np.nan)
            made = [pa.array(pred, pa.string()), pa.array(score), pa.array(rate, mask=~known | (m is None))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, "lang_pred", "score", "bits_per_byte"])
        give_back()

    plain = documents.drop("lang_pred", "score", "bits_per_byte")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    return plain.mapInArrow(run, f"{fields}, lang_pred string, score double, bits_per_byte double")


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
