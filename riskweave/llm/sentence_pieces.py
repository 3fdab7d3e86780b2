"""SentencePiece merge-type (BPE) vocabularies: encode by a score-ordered agenda, decode by the library.

The agenda holds every adjacent symbol pair whose joint string is a piece; the
pair with the highest score (leftmost of equals) is merged first. No piece has
a space after another character, so merges never leave a run of spaces plus the
word after it, and a text's ids are those of its words. :func:`agenda` is the
plain form, with a heap; :meth:`PieceEncoder.encode_chunks` runs the agendas of
thousands of distinct words side by side with numpy, one merge of each per
round. The ids of every whole text of an Arrow batch are checked against the
sentencepiece library (``check=False`` leaves that out); a difference raises.

Edge cases: null text is empty and has the end id alone; any control or unknown
character falls back to its bytes; very long words go through the heap.
"""

from __future__ import annotations

import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.chunks import ChunkEncoder, _flat
from riskweave.llm.common import text_column, text_slices
from riskweave.llm.direct_codes import _encoder, with_end

SPACE = "▁"
NONE = np.iinfo(np.int64).max


class Merges:
    """Symbols, and the priority and result of every pair that makes a piece."""

    def __init__(self, library):
        self.library = library
        size = library.get_piece_size()
        self.bytes = {}
        self.code: dict[str, int] = {}
        for i in range(size):
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                self.bytes[int(piece[3:-1], 16)] = i
            elif not (library.is_control(i) or library.is_unknown(i) or library.is_unused(i)):
                self.code[piece] = i
        if len(self.bytes) != 256:
            raise ValueError("the vocabulary has no byte pieces to fall back to")
        if any(SPACE in p.lstrip(SPACE) for p in self.code):
            raise ValueError("the vocabulary has pieces that go beyond a word")
        pieces = dict(self.code)
        for c in sorted({c for p in pieces for c in p} - pieces.keys()):  # characters that occur in pieces only
            self.code[c] = size + len(self.code)
        self.base = max(self.code.values()) + 2
        self.other = self.base - 1  # any character that no piece holds
        # Equal scores share a rank: the leftmost pair then wins.
        scores = sorted({library.get_score(i) for i in pieces.values()}, reverse=True)
        rank = {s: k for k, s in enumerate(scores)}
        self.pairs = {}
        for piece, i in pieces.items():
            for k in range(1, len(piece)):
                a, b = self.code.get(piece[:k]), self.code.get(piece[k:])
                if a is not None and b is not None:
                    self.pairs[a, b] = (rank[library.get_score(i)], i)
        self._hash()

    def _hash(self):
        """The pairs as an open-addressing table, for lookups of whole arrays."""
        self.bits = max(4, (4 * len(self.pairs)).bit_length())
        keys = np.array([a * self.base + b for a, b in self.pairs], dtype=np.int64)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks, self.made = np.full(1 << self.bits, NONE), np.zeros(1 << self.bits, np.int64)
        values = np.array(list(self.pairs.values()), dtype=np.int64).reshape(-1, 2)
        at, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[at[todo]] < 0]
            slots, chosen = np.unique(at[free], return_index=True)
            put = free[chosen]
            self.keys[slots], self.ranks[slots], self.made[slots] = keys[put], values[put, 0], values[put, 1]
            todo = np.setdiff1d(todo, put, assume_unique=True)
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys):
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Table slots of the pairs; slots of absent pairs have the rank NONE."""
        keys = left * self.base + right
        at = self._slot(keys)
        wrong = np.flatnonzero((self.keys[at] != keys) & (self.keys[at] >= 0))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & ((1 << self.bits) - 1)
            wrong = wrong[(self.keys[at[wrong]] != keys[wrong]) & (self.keys[at[wrong]] >= 0)]
        return at


def agenda(merges: Merges, unit: str) -> list[int]:
    """Ids of one unit (spaces as the mark): pop the best pair, merge, push its new neighbours."""
    symbols = [merges.code.get(c, merges.other) for c in unit]
    after, before = list(range(1, len(unit) + 1)), list(range(-1, len(unit) - 1))
    heap = []

    def push(i):
        j = after[i]
        if j < len(symbols) and (symbols[i], symbols[j]) in merges.pairs:
            rank, made = merges.pairs[symbols[i], symbols[j]]
            heapq.heappush(heap, (rank, i, symbols[i], symbols[j], made))
    for i in range(len(unit) - 1):
        push(i)
    while heap:
        _, i, a, b, made = heapq.heappop(heap)
        j = after[i] if symbols[i] == a else len(symbols)
        if j >= len(symbols) or symbols[j] != b:
            continue  # one of the two has been merged meanwhile
        symbols[i], symbols[j] = made, -1
        after[i] = after[j]
        if after[j] < len(symbols):
            before[after[j]] = i
        push(i)
        if before[i] >= 0:
            push(before[i])
    out, i = [], 0
    while i < len(symbols):
        out += [symbols[i]] if symbols[i] in merges.library_ids else [
            merges.bytes[x] for x in unit[i].encode()]
        i = after[i]
    return out


class PieceEncoder(ChunkEncoder):
    """Chunk keys are what follows a space mark; every chunk has one before it."""

    whole = f"  |^ | $|{SPACE}"
    LONG = 64

    def __init__(self, path: str, check: bool = True, **bounds):
        import sentencepiece
        super().__init__(**bounds)
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.check = check
        self.merges = Merges(self.library)
        self.merges.library_ids = set(range(self.library.get_piece_size()))

    def encode_chunks(self, chunks, first=False):
        return self._agendas(chunks)

    def _agendas(self, chunks):
        m, size = self.merges, len(self.library)
        long = [k for k, c in enumerate(chunks) if len(c) >= self.LONG]
        if long:
            short = [k for k, c in enumerate(chunks) if len(c) < self.LONG]
            lists: list = [None] * len(chunks)
            ids, counts = self._agendas([chunks[k] for k in short])
            starts = np.cumsum(counts) - counts
            for k, a, n in zip(short, starts, counts):
                lists[k] = ids[a:a + n]
            for k in long:
                lists[k] = agenda(m, SPACE + chunks[k])
            return _flat(lists)
        if not chunks:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        points = np.frombuffer((SPACE + SPACE.join(chunks)).encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks)) + 1
        word = np.repeat(np.arange(len(chunks)), lengths)
        symbol = self._symbols(points)
        at = np.arange(len(points))  # where a symbol began, for the bytes of unknown characters
        done = []
        while len(word):
            joint = word[:-1] == word[1:]
            slot = m.find(symbol[:-1], symbol[1:])
            rank = np.append(np.where(joint, m.ranks[slot], NONE), NONE)
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            best = np.minimum.reduceat(rank, starts)
            run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(word))))
            hit = np.flatnonzero((rank == best[run]) & (rank != NONE))
            hit = hit[np.append(True, word[hit][1:] != word[hit][:-1])] if len(hit) else hit
            symbol = symbol.copy()
            symbol[hit] = m.made[slot[hit]]
            over = (best == NONE)[run]
            done.append((word[over], symbol[over], at[over]))
            keep = ~over
            keep[hit + 1] = False
            word, symbol, at = word[keep], symbol[keep], at[keep]
        word, symbol, at = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(at, kind="stable")
        word, symbol, at = word[order], symbol[order], at[order]
        odd = np.flatnonzero(symbol >= size)
        if len(odd):
            spelled = [[m.bytes[x] for x in chr(points[at[k]]).encode("utf-8", "surrogatepass")] for k in odd]
            times = np.ones(len(symbol), np.int64)
            times[odd] = [len(s) for s in spelled]
            word, out = np.repeat(word, times), np.repeat(symbol, times)
            out[np.repeat(symbol >= size, times)] = [x for s in spelled for x in s]
            symbol = out
        return symbol.astype(np.uint32), np.bincount(word, minlength=len(chunks))

    def _symbols(self, points):
        kinds, where = np.unique(points, return_inverse=True)
        return np.array([self.merges.code.get(chr(p), self.merges.other) for p in kinds], dtype=np.int64)[where]

    def encode_texts(self, texts):
        """Texts with runs of spaces, or with the mark itself: cut before every run of marks."""
        lists = []
        for t in texts:
            if not t:
                lists.append([])
                continue
            units = re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + t.replace(" ", SPACE))
            lists.append([i for u in units for i in agenda(self.merges, u)])
        return _flat(lists)

    def encode(self, texts):
        ids, offsets = super().encode(texts)
        empty = np.asarray(pc.equal(pc.cast(texts, pa.large_string()).fill_null(""), ""))
        if empty.any():  # an empty text has no ids, not even the mark's
            counts = np.diff(offsets)
            ids = ids[np.repeat(~empty, counts)]
            offsets = np.append(0, np.cumsum(np.where(empty, 0, counts)))
        if self.check:
            wanted, counts = _flat(self.library.encode(texts.fill_null("").to_pylist(), num_threads=1))
            if not np.array_equal(counts, np.diff(offsets)) or not np.array_equal(ids, wanted):
                raise RuntimeError("the agenda and the sentencepiece library disagree")
        return ids, offsets


def encode_and_decode(docs: DataFrame, model: str, check: bool = True) -> DataFrame:
    """doc_id, ids (array), decoded text of every document, in Arrow batches; no shuffle."""
    return _each(docs, model, check, "ids array<int>, decoded string", lambda ids, offsets, texts: [
        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())), texts])


def digests(docs: DataFrame, model: str, check: bool = True) -> DataFrame:
    """doc_id, n_tokens, and sha256 of the decimal ids and of the decoded text."""
    def columns(ids, offsets, texts):
        decimal = pa.array([str(i) for i in range(int(ids.max(initial=0)) + 1)], pa.string())
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                                         decimal.take(pa.array(ids, pa.int64()))), " ")
        sha = lambda values: pa.array([hashlib.sha256(v.encode()).hexdigest() for v in values], pa.string())
        return [pa.array(np.diff(offsets), pa.int64()), sha(joined.to_pylist()), sha(texts)]
    return _each(docs, model, check, "n_tokens long, ids_sha256 string, decoded_sha256 string", columns)


def _each(docs, model, check, schema, columns):
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    names = ["doc_id", *(c.split()[0] for c in schema.split(", "))]

    def run(batches):
        encoder = _encoder(model, PieceEncoder)
        encoder.check = check
        end = encoder.library.eos_id()
        for batch in batches:
            for rows in text_slices(batch, "text", 4 << 20):
                ids, offsets = with_end(*encoder.encode(rows.column("text")), end)
                flat = ids.tolist()
                texts = encoder.library.decode([flat[a:b] for a, b in zip(offsets, offsets[1:])], num_threads=1)
                got = columns(ids, offsets, texts)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), *(x if isinstance(x, pa.Array) else pa.array(x, pa.string()) for x in got)],
                    names=names)
    return source.mapInArrow(run, f"doc_id long, {schema}")
