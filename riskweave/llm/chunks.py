"""Token ids of whole texts by way of their distinct chunks.

A vocabulary that never merges across a space gives a text the ids of its
chunks, one after another. Arrow splits a slice of texts and numbers its
distinct chunks; only chunks that this worker has not met are encoded, and the
ids are gathered with numpy. The memo is emptied when it passes its bound, so
memory does not grow with the input. Texts whose chunks would not be
independent are encoded whole.
"""

from __future__ import annotations

import os
import re
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from riskweave.llm.common import exclusive_sum, gather_runs

#: White space besides the plain space, as Unicode lists it (fixed values).
OTHER_SPACE = "\\t\\n\\x0b\\x0c\\r\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"


class ChunkEncoder:
    """Base: ``encode`` gives flat ids and row offsets; subclasses say what a chunk's ids are."""

    #: RE2 pattern of texts that must be encoded whole; None: every text splits at spaces.
    whole: str | None = None
    #: Does the first chunk of a text differ from the same chunk after a space?
    first_differs = False

    def __init__(self, max_entries: int = 400_000, max_ids: int = 4_000_000):
        self.max_entries, self.max_ids = max_entries, max_ids
        self._clear()

    def _clear(self):
        self._memo: dict = {}
        self._starts, self._lengths = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self._store, self._used = np.zeros(1 << 16, np.uint32), 0

    def split(self, texts: pa.Array) -> pa.Array:
        return pc.split_pattern(texts, " ")

    def encode_chunks(self, chunks: list[str], first: bool) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, ids per chunk) of chunks that follow a space, or that begin a text."""
        raise NotImplementedError

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, ids per text) of texts that do not split at their spaces."""
        raise NotImplementedError

    def _add(self, keys: list, ids: np.ndarray, counts: np.ndarray):
        n, m = len(self._memo), len(self._memo) + len(keys)
        if m > len(self._starts):
            size = 2 * m
            self._starts, self._lengths = np.resize(self._starts, size), np.resize(self._lengths, size)
        if self._used + len(ids) > len(self._store):
            self._store = np.resize(self._store, 2 * (self._used + len(ids)))
        self._store[self._used:self._used + len(ids)] = ids
        self._starts[n:m] = self._used + exclusive_sum(counts)[:-1]
        self._lengths[n:m] = counts
        self._used += len(ids)
        self._memo.update(zip(keys, range(n, m)))

    def _places(self, chunks: list[str], first: bool) -> np.ndarray:
        keys = [(c,) for c in chunks] if first else chunks
        missing = [c for c, k in zip(chunks, keys) if k not in self._memo]
        if missing:
            self._add([(c,) for c in missing] if first else missing, *self.encode_chunks(missing, first))
        return np.fromiter(map(self._memo.__getitem__, keys), np.int64, len(keys))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat uint32 ids of all texts and the ``len(texts) + 1`` offsets of the texts in them."""
        texts = pc.cast(texts, pa.large_string()).fill_null("")
        n = len(texts)
        if len(self._memo) > self.max_entries or self._used > self.max_ids:
            self._clear()
        odd = (np.asarray(pc.match_substring_regex(texts, self.whole)) if self.whole and n
               else np.zeros(n, bool))
        rows = np.flatnonzero(~odd)
        lists = self.split(texts if len(rows) == n else texts.take(pa.array(rows)))
        offsets = np.asarray(lists.offsets, dtype=np.int64)
        flat = lists.values
        coded = flat.dictionary_encode()
        index = np.asarray(coded.indices, dtype=np.int64)
        if self.first_differs and len(rows):
            later = np.ones(len(index), bool)
            later[offsets[:-1]] = False
            used = np.zeros(len(coded.dictionary), bool)
            used[index[later]] = True
            place = np.zeros(len(used), np.int64)
            place[used] = self._places(coded.dictionary.filter(pa.array(used)).to_pylist(), False)
            where = place[index]
            firsts = flat.take(pa.array(offsets[:-1])).dictionary_encode()
            where[offsets[:-1]] = self._places(firsts.dictionary.to_pylist(), True)[np.asarray(firsts.indices)]
        else:
            where = self._places(coded.dictionary.to_pylist(), False)[index]
        lengths = self._lengths[where]
        counts = np.zeros(n, np.int64)
        if len(rows):
            counts[rows] = np.diff(exclusive_sum(lengths)[offsets])
        ids = gather_runs(self._store, self._starts[where], lengths)
        if not odd.any():
            return ids, exclusive_sum(counts)
        odd_ids, odd_counts = self.encode_texts(texts.filter(pa.array(odd)).to_pylist())
        counts[odd] = odd_counts
        both = np.concatenate([ids, odd_ids])
        starts = np.zeros(n, np.int64)
        starts[rows] = exclusive_sum(counts[rows])[:-1]
        starts[odd] = len(ids) + exclusive_sum(odd_counts)[:-1]
        return gather_runs(both, starts, counts), exclusive_sum(counts)


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    out = np.empty(counts.sum(), np.uint32)
    at = 0
    for x in lists:
        out[at:at + len(x)] = x
        at += len(x)
    return out, counts


class LibraryEncoder(ChunkEncoder):
    """Ids of the tokenizers library. Missing chunks go to it joined, a thousand to a call.

    A text that holds one of the vocabulary's special strings goes to the
    library whole, which gives such a string its own id.
    """

    def __init__(self, path: str, **bounds):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        super().__init__(**bounds)
        self.library = Tokenizer.from_file(path)
        special = [re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()]
        self.whole = "|".join([*([self.whole] if self.whole else []), *special]) or None

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_texts(self, texts):
        return _flat(self._ids(texts))

    def _joined(self, chunks: list[str], joint: str, split) -> tuple[np.ndarray, np.ndarray]:
        runs = [chunks[i:i + 1000] for i in range(0, len(chunks), 1000)]
        parts = []
        for run, ids in zip(runs, self._ids([joint + joint.join(r) for r in runs])):
            ids = np.array(ids, dtype=np.uint32)
            got = split(ids)
            parts.append(got if len(got[1]) == len(run) else _flat(self._ids([self.alone(c) for c in run])))
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


class ByteLevelEncoder(LibraryEncoder):
    """Byte-level BPE: a space belongs to the word after it, if one follows it at once."""

    whole = f"^ | $|  |[{OTHER_SPACE}] | [{OTHER_SPACE}]"
    first_differs = True

    def __init__(self, path: str, **bounds):
        super().__init__(path, **bounds)
        lib = self.library
        self._spaced = np.array([(lib.id_to_token(i) or "").startswith("Ġ")
                                 for i in range(lib.get_vocab_size())])

    def alone(self, chunk):
        return " " + chunk

    def encode_chunks(self, chunks, first):
        if first:
            return _flat(self._ids(chunks))

        def split(ids):
            starts = np.flatnonzero(self._spaced[ids])
            return ids, np.diff(np.append(starts, len(ids)))
        return self._joined(chunks, " ", split)


class WordLevelEncoder(LibraryEncoder):
    """BPE with word ends that drops white space and case: any white space may be cut at.

    A word and the signs after it are pieces of their own to the vocabulary, so
    a chunk's ids are those of the two; words of letters alone are told apart by
    their word ends, other units by a control character between them.
    """

    JOINT = "\x01"
    TAIL = ".,;:!?$%&*#|)"

    def __init__(self, path: str, **bounds):
        super().__init__(path, **bounds)
        lib = self.library
        joint = self._ids([self.JOINT])[0]
        if len(joint) != 1:
            raise ValueError("the vocabulary has no id of its own for the control character between chunks")
        self._joint = joint[0]
        self._ends = np.array([(lib.id_to_token(i) or "").endswith("</w>") for i in range(lib.get_vocab_size())])

    def _clear(self):
        super()._clear()
        self._units: dict[str, bytes] = {}

    def split(self, texts):
        return pc.ascii_split_whitespace(texts)

    def alone(self, chunk):
        return chunk

    def _parts(self, chunk):
        low = chunk.lower() if chunk.isascii() else chunk
        word = low.rstrip(self.TAIL)
        return (word, low[len(word):]) if len(word) < len(low) and word and word[-1].lower()[-1].isalnum() else (low,)

    def encode_chunks(self, chunks, first):
        parts = [self._parts(c) for c in chunks]
        units = self._units
        missing = [u for u in dict.fromkeys(u for p in parts for u in p) if u not in units]

        def by_end(ids):
            return ids, np.diff(np.append(0, np.flatnonzero(self._ends[ids]) + 1))

        def by_joint(ids):  # a unit that holds the joint makes the count differ, and its run is encoded unit by unit
            at = np.flatnonzero(ids == self._joint)
            return ids[ids != self._joint], np.diff(np.append(at, len(ids))) - 1
        # Of plain lower-case letters neither normaliser nor splitter changes anything: the library's model takes them as they are.
        plain, letters, others = [], [], []
        for u in missing:
            (plain if u.isascii() and u.isalpha() else letters if u.isalpha() else others).append(u)
        tokenize = self.library.model.tokenize
        for u in plain:
            ids = [t.id for t in tokenize(u)]
            units[u] = struct.pack(f"<{len(ids)}I", *ids)
        for run, joint, cut in ((letters, " ", by_end), (others, f" {self.JOINT} ", by_joint)):
            if run:
                ids, counts = self._joined(run, joint, cut)
                data, ends = ids.astype("<u4").tobytes(), (np.cumsum(counts) * 4).tolist()
                units.update(zip(run, map(data.__getitem__, map(slice, [0, *ends[:-1]], ends))))
        held = [b"".join(map(units.__getitem__, p)) for p in parts]
        return np.frombuffer(b"".join(held), "<u4"), np.fromiter(map(len, held), np.int64, len(held)) // 4
