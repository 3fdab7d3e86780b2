import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskweave.llm.chunks import ByteLevelEncoder, WordLevelEncoder
from riskweave.llm.direct_codes import TokenFile, crc_of, to_bytes, write_tokens
from riskweave.llm.packing import pack, plan_patterns, price
from riskweave.llm.sentence_pieces import PieceEncoder, agenda, digests, encode_and_decode

PARTS = [" ", "  ", "\n", "\t", "a", "The", "▁", "é", "é", "ß", "'s", "don't", "12", "<|endoftext|>", "</s>", "\x01",
         "ﬁ", "😀", "中文", "Σ", "　", "!", "##", "Ġ", "\x00", "\r\n", "İ", "word.", "word", "WORD!!"]
TEXTS = st.lists(st.lists(st.sampled_from(PARTS), max_size=10).map("".join), min_size=1, max_size=8)
DOCS = [(3, "The ende here."), (1, None), (2, ""), (2, "again  two"), (None, "no id"), (5, "x" * 30_000), (4, "word " * 5000)]


@pytest.fixture(scope="module")
def encoders():
    out = {}
    for name, kind in (("byte_bpe_50k.json", ByteLevelEncoder), ("word_bpe_49k.json", WordLevelEncoder)):
        lib = Tokenizer.from_file(public_tokenizers.path(name))
        out[name] = kind(public_tokenizers.path(name), max_entries=40), lib
    return out


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@settings(max_examples=60, deadline=None)
@given(texts=TEXTS)
def test_chunked_ids_are_the_librarys(encoders, name, texts):
    encoder, lib = encoders[name]
    ids, offsets = encoder.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [
        e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("name, special", [("byte_bpe_50k.json", 50256), ("word_bpe_49k.json", 49407)])
def test_special_strings_have_the_librarys_ids(encoders, name, special):
    encoder, lib = encoders[name]
    texts = ["a <|endoftext|> b", "x<|endoftext|>", "plain words", "<|ENDOFTEXT|> <|startoftext|>", "<|endoftext|><|endoftext|>"]
    ids, offsets = encoder.encode(pa.array(texts))
    got = [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]
    assert got == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert special in got[0] and got[4] == [special, special]


@settings(max_examples=60, deadline=None)
@given(texts=TEXTS)
def test_agenda_is_sentencepiece(texts):
    path = public_tokenizers.path("piece_bpe_32k.model")
    encoder = _PIECES.setdefault(path, PieceEncoder(path, check=False) if path not in _PIECES else None)
    lib = encoder.library
    ids, offsets = encoder.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == lib.encode(texts)
    for t in texts:  # the heap agenda takes a whole text as one unit
        assert not t or agenda(encoder.merges, "▁" + t.replace(" ", "▁")) == lib.encode(t)


_PIECES: dict = {}


@settings(max_examples=40, deadline=None)
@given(ids=st.lists(st.integers(0, 2 ** 32 - 1) | st.integers(0, 300), max_size=1500))
def test_any_id_is_read_without_its_neighbours(ids):
    ids = np.array(ids, dtype=np.uint32)
    f = TokenFile(to_bytes(ids, np.array([7]), np.array([False]), np.array([0, len(ids)])))
    assert f.all().tolist() == ids.tolist()
    assert [f.get(i) for i in range(0, len(ids), 37)] == ids[::37].tolist()
    assert f.document(0).tolist() == ids.tolist()
    with pytest.raises(IndexError):
        f.get(len(ids))


def _frame(spark, rows=DOCS):
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as ids", "'x' as length")


def test_token_store_round_trip(spark):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    store = write_tokens(_frame(spark), public_tokenizers.path("byte_bpe_50k.json"), 2, ids_per_file=100)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["digest"]) for r in store.documents(crc_of).collect())
    want, at = [], 0
    for doc_id, text in sorted(DOCS, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or "")):
        ids = [*lib.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((at, doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want
    assert write_tokens(_frame(spark, []), public_tokenizers.path("byte_bpe_50k.json"), 2).documents(crc_of).count() == 0


def test_sentence_pieces_in_batches(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    got = encode_and_decode(_frame(spark), path).collect()
    assert len(got) == len(DOCS)
    want = sorted([*lib.encode(t or ""), lib.eos_id()] for _, t in DOCS)
    assert sorted(list(r["ids"]) for r in got) == want
    assert sorted(r["decoded"] for r in got) == sorted(lib.decode(lib.encode(t or "")) for _, t in DOCS)
    assert sorted(r["n_tokens"] for r in digests(_frame(spark), path).collect()) == sorted(map(len, want))
    assert digests(_frame(spark, []), path).count() == 0


def test_price_is_the_best_knapsack():
    rng = np.random.default_rng(1)
    for _ in range(30):
        weights = np.sort(rng.choice(np.arange(1, 12), 4, replace=False))
        values = rng.random(4)
        best = max(sum(c * v for c, v in zip(n, values)) for n in np.ndindex(*[12 // w + 1 for w in weights])
                   if np.dot(n, weights) <= 12)
        value, counts = price(values, weights, 12)
        assert abs(value - best) < 1e-9 and abs(counts @ values - best) < 1e-9 and counts @ weights <= 12


def test_patterns_use_the_histogram_up():
    rng = np.random.default_rng(2)
    for n in (0, 1, 5, 500, 20_000):
        sizes = np.minimum(64, 1 + np.floor(np.exp(rng.normal(2.5, 1, n)))).astype(int)
        histogram = dict(zip(*map(np.ndarray.tolist, np.unique(sizes, return_counts=True)))) if n else {}
        plan = plan_patterns(histogram, 64)
        used: dict = {}
        for times, held in plan:
            assert times > 0 and sum(k * c for k, c in held.items()) <= 64
            for k, c in held.items():
                used[k] = used.get(k, 0) + times * c
        assert used == histogram
        if n >= 500:
            assert sum(t for t, _ in plan) <= np.ceil(sizes.sum() / 64) * 1.02 + 2


def test_packing(spark):
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = DOCS + [(100 + i, "word " * (i % 50)) for i in range(300)]
    found = pack(_frame(spark, docs), public_tokenizers.path("word_bpe_49k.json"), capacity=256)
    rows = [r.asDict() for r in found.pieces.join(found.placement, "row").collect()]
    ids = {}
    for doc_id, text in docs:
        ids.setdefault(doc_id, []).append([*lib.encode(text or "", add_special_tokens=False).ids, 2])
    assert sum(r["length"] for r in rows) == sum(len(x) for v in ids.values() for x in v)
    for r in rows:
        piece = np.frombuffer(r["ids"], "<u4").tolist()
        assert any(len(x) == r["doc_tokens"] and x[r["start"]:r["start"] + r["length"]] == piece for x in ids[r["doc_id"]])
    by_sequence: dict = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for held in by_sequence.values():
        at = 0
        for r in sorted(held, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 256
    whole = {r["sequence_id"]: r for r in found.sequences().collect()}
    for k, held in by_sequence.items():
        assert bytes(whole[k]["ids"]) == b"".join(bytes(r["ids"]) for r in sorted(held, key=lambda r: r["offset"]))
    empty = pack(_frame(spark, []), public_tokenizers.path("word_bpe_49k.json"))
    assert empty.pieces.count() == 0 and empty.placement.count() == 0
