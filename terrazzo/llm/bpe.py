"""Byte-level BPE by DuckDB recursive queries, one connection per Python worker.

Each partition splits its whole texts with the pre-tokenizer pattern and gives the distinct new words of a batch to one
recursive query: a row per (word, position, token) joins the merge table, the leftmost minimum-rank pair of every word is
contracted, until no pair is in the table. A word of more than LONG bytes is encoded in overlapping windows, all in one
query; two windows are joined at a token boundary that both have, where the two tokens that meet stay two tokens when their
bytes are encoded alone, which is the condition under which a concatenation of encodings is the encoding. A word whose
windows have no such boundary is encoded window after window, each begun at a boundary of the one before. Decoding joins
(document, position, id) with the vocabulary and aggregates by position.

Defined results: a null text is empty (no ids, the digests of nothing); a text or word of any length is encoded whole;
repeated rows give repeated rows; a null doc_id stays null; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import os
import tempfile
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from terrazzo.llm.common import give_back

#: Bytes of a long word and of its windows' overlap; words that a worker remembers; characters handled at once.
LONG, OVERLAP, CACHED, CHUNK = 512, 128, 300_000, 1 << 19

#: A row holds its token, the next row's token and position; a word whose rows find no merge is finished.
CONTRACT = """
with recursive walk(step, word, pos, tok, next, next_pos) as (
    select 0, word, pos, tok, next, next_pos from start
    union all
    (
        with pairs as materialized (
            select w.*, m.merged from walk w left join merges m on m.a = w.tok and m.b = w.next where w.step >= 0
        ),
        best as (
            select word, min(merged::bigint * 65536 + pos) as k from pairs where merged is not null group by word
        ),
        hit as materialized (
            select b.word, b.k % 65536 as at, (b.k // 65536)::int as merged, r.pos as gone, r.next as after, r.next_pos as after_pos
            from best b join pairs l on l.word = b.word and l.pos = b.k % 65536 join pairs r on r.word = l.word and r.pos = l.next_pos
        )
        select case when h.word is null then -1 else p.step + 1 end, p.word, p.pos,
               case when p.pos = h.at then h.merged else p.tok end,
               case when p.pos = h.at then h.after when p.next_pos = h.at then h.merged else p.next end,
               case when p.pos = h.at then h.after_pos else p.next_pos end
        from pairs p left join hit h on h.word = p.word
        where h.word is null or p.pos <> h.gone
    )
)
select word, tok from walk where step < 0 order by word, pos
"""


DECODE = "select doc, string_agg(chars, '' order by pos) as chars from coded join vocabulary using (id) group by doc"


class Coder:
    """Encoder and decoder over one rank file (lines of base64 token and rank)."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.split = regex.compile(pattern).findall
        ranks = self.ranks
        found = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        a, b, merged = (pa.array(x, pa.int32()) for x in zip(*found, strict=True))
        self.tables = {"merges": pa.table({"a": a, "b": b, "merged": merged})}
        texts = {r: t.decode("latin-1") for t, r in ranks.items()}
        self.tables["vocabulary"] = pa.table({"id": pa.array(list(texts), pa.int32()), "chars": pa.array([x.replace("\0", "Ā") for x in texts.values()])})
        self.opened: duckdb.DuckDBPyConnection | None = None
        self.of_byte = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int32)
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.decimal = np.array([str(r) for r in range(max(ranks.values()) + 1)], object)
        self.forget()

    @property
    def db(self) -> duckdb.DuckDBPyConnection:
        if self.opened is None:
            # spills go to the task's own temporary folder
            self.opened = duckdb.connect(config={"threads": 1, "memory_limit": "256MB", "temp_directory": f"{tempfile.gettempdir()}/duckdb-{os.getpid()}"})
            for name, rows in self.tables.items():
                self.opened.register("rows_", rows)
                self.opened.execute(f"create table {name} as select * from rows_")
                self.opened.unregister("rows_")
        return self.opened

    def rest(self) -> None:
        """Closes the database, which keeps tens of MB that it no longer uses, until the next task; known words stay."""
        if self.opened is not None:
            self.opened.close()
            self.opened = None

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.flat, self.ends = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int64)  # ids of all known words, one after the other

    def contract(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after the other, and how many each has, by one recursive query."""
        lens = np.array([len(w) for w in words], np.int64)
        word = np.repeat(np.arange(len(words), dtype=np.int32), lens)
        pos = (np.arange(len(word)) - np.repeat(np.cumsum(lens) - lens, lens)).astype(np.int32)
        tok = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        last = np.append(word[1:] != word[:-1], True)[: len(word)]
        start = {"word": pa.array(word), "pos": pa.array(pos), "tok": pa.array(tok)}
        start |= {"next": pa.array(np.append(tok[1:], 0)[: len(tok)].astype(np.int32), mask=last), "next_pos": pa.array(pos + 1, pa.int32(), mask=last)}
        self.db.register("start", pa.table(start))
        got = self.db.sql(CONTRACT).to_arrow_table()
        self.db.unregister("start")
        return got.column("tok").to_numpy(), np.bincount(got.column("word").to_numpy(), minlength=len(words))

    def contracted(self, words: list[bytes]) -> list[list[int]]:
        ids, counts = self.contract(words)
        return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] if words else []

    def encode_windows(self, word: bytes) -> list[int] | None:
        """All windows at once, joined where the tokens that meet are their own encoding; None where two have no such place."""
        begins = range(0, max(1, len(word) - OVERLAP), LONG - OVERLAP)
        pieces = self.contracted([word[s : s + LONG] for s in begins])
        bounds = [dict(zip((s + np.cumsum([len(self.bytes_of[t]) for t in p])).tolist(), range(1, len(p) + 1), strict=True)) for s, p in zip(begins, pieces, strict=True)]
        meets: list[list[tuple[int, bytes, bytes]]] = []  # for each two windows: the places, and the tokens around each
        for (x, y), (bx, by) in zip(zip(pieces, pieces[1:], strict=False), zip(bounds, bounds[1:], strict=False), strict=True):
            last = max(by)
            meets.append([(at, self.bytes_of[x[bx[at] - 1]], self.bytes_of[y[by[at]]]) for at in sorted(bx.keys() & by.keys()) if at < last])
        pairs = sorted({a + b for own in meets for _, a, b in own})
        alone = dict(zip(pairs, map(len, self.contracted(pairs)), strict=True))
        done, start = [], 0
        for k, own in enumerate(meets):
            sound = [at for at, a, b in own if at > start and alone[a + b] == 2]
            if not sound:
                return None
            done += pieces[k][bounds[k].get(start, 0) : bounds[k][sound[0]]]
            start = sound[0]
        return done + pieces[-1][bounds[-1].get(start, 0) :]

    def encode_long(self, word: bytes) -> list[int]:
        """Window after window, each begun at a token boundary; see the module's description."""
        done: list[int] = []
        start, size = 0, LONG
        while start < len(word):
            piece = self.contracted([word[start : start + size]])[0]
            if done and len(self.contracted([self.bytes_of[done[-1]] + self.bytes_of[piece[0]]])[0]) != 2:
                back = len(self.bytes_of[done.pop()])  # begin a token earlier
                start, size = start - back, size + back
                continue
            if start + size >= len(word):
                return done + piece
            ends = start + np.cumsum([len(self.bytes_of[t]) for t in piece])
            keep = int(np.searchsorted(ends, start + size - OVERLAP, "right"))
            if keep:
                done += piece[:keep]
                start, size = int(ends[keep - 1]), LONG
            else:
                size *= 2
        return done

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.number]
        if len(self.number) + len(new) > CACHED:
            self.forget()
            new = list(words)
        if not new:
            return
        coded = [w.encode() for w in new]
        short = [i for i, w in enumerate(coded) if len(w) <= LONG]
        long = [i for i, w in enumerate(coded) if len(w) > LONG]
        ids, counts = self.contract([coded[i] for i in short]) if short else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        for i in long:
            own = self.encode_windows(coded[i]) or self.encode_long(coded[i])
            ids, counts = np.append(ids, np.array(own, np.int32)), np.append(counts, len(own))
        known = len(self.number)
        used = int(self.ends[known - 1]) if known else 0
        self.flat = self._room(self.flat, used + len(ids))
        self.ends = self._room(self.ends, known + len(new))
        self.flat[used : used + len(ids)] = ids
        self.ends[known : known + len(new)] = used + np.cumsum(counts)
        self.number.update((new[i], known + k) for k, i in enumerate(short + long))

    @staticmethod
    def _room(x: np.ndarray, n: int) -> np.ndarray:
        return x if n <= len(x) else np.concatenate([x, np.zeros(max(n, 2 * len(x)) - len(x), x.dtype)])

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[str]]:
        """Ids of each text, and the same as decimal strings joined by a space."""
        split = [self.split(t) for t in texts]
        self.learn(set().union(*split))
        ids, said = [], []
        for words in split:
            numbers = list(map(self.number.__getitem__, words))
            at = np.array(numbers, np.int64)
            starts = np.where(at > 0, self.ends[at - 1], 0)
            lens = self.ends[at] - starts
            ids.append(self.flat[np.repeat(starts - np.cumsum(lens) + lens, lens) + np.arange(lens.sum())])
            said.append(" ".join(self.decimal[ids[-1]].tolist()))
        return ids, said

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        lens = np.array([len(x) for x in ids], np.int64)
        flat = np.concatenate([*ids, np.zeros(0, np.int32)]).astype(np.int32)
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), lens)
        self.db.register("coded", pa.table({"doc": doc, "pos": np.arange(len(flat), dtype=np.int32), "id": flat}))
        got = self.db.sql(DECODE).to_arrow_table()
        self.db.unregister("coded")
        out = [b""] * len(ids)
        for d, chars in zip(got.column("doc").to_pylist(), got.column("chars").to_pylist(), strict=True):
            out[d] = chars.replace("Ā", "\0").encode("latin-1")
        return out


_CODERS: dict[tuple[str, str], Coder] = {}


def coder(path: str, pattern: str) -> Coder:
    if (path, pattern) not in _CODERS:
        _CODERS[path, pattern] = Coder(path, pattern)
    return _CODERS[path, pattern]


def encode_documents(documents: DataFrame, path: str, pattern: str, keep_ids: bool = True) -> DataFrame:
    """doc_id, ids array<int> (left out unless keep_ids), n_tokens, ids_sha256, decoded_sha256, round_trip."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path, pattern)
        for batch in batches:
            column = batch.column("text")
            a = 0
            while a < batch.num_rows:
                b, held, texts = a, 0, []
                while b < batch.num_rows and (b == a or held < CHUNK):
                    texts.append(column[b].as_py() or "")
                    held += len(texts[-1])
                    b += 1
                ids, said = c.encode(texts)
                back = c.decode(ids)
                columns = [batch.column("doc_id").slice(a, b - a)]
                if keep_ids:
                    ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                    flat = np.concatenate([*ids, np.zeros(0, np.int32)]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
                columns += [
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(s.encode()).hexdigest() for s in said]),
                    pa.array([hashlib.sha256(x).hexdigest() for x in back]),
                    pa.array([x == t.encode() for x, t in zip(back, texts, strict=True)]),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *["ids"] * keep_ids, "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"])
                a = b
        c.rest()
        give_back()

    kind = documents.schema["doc_id"].dataType.simpleString()
    ids = "ids array<int>, " if keep_ids else ""
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {ids}n_tokens bigint, ids_sha256 string, decoded_sha256 string, round_trip boolean")
