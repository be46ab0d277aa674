"""Sharding, token files and packing."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from fieldloom.llm import huffman, packing, sharding  # noqa: E402
from fieldloom.llm.tokens import PieceEncoder  # noqa: E402

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
DOCS = "doc_id long, text string, shard string, ids string, offset long"
PIECES = ["The ", " word", "\n", "  ", "é", "ß", " don't", "12", "!?", "<|endoftext|>", "\x01", "　", "😀", "́", "a"]


def documents(spark, texts, shift=0):
    rows = [(i + shift, t, "x", "y", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def odd_texts(n, seed=1):
    draw = random.Random(seed)
    texts = ["".join(draw.choice(PIECES) for _ in range(draw.randrange(40))) for _ in range(n)]
    return [*texts, None, "", " ", "word " * 9000, "same text", "same text"]


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000])
def test_permutation_and_its_inverse(size):
    places = sharding.permute(np.arange(size), size)
    assert sorted(places) == list(range(size))
    assert list(sharding.unpermute(places, size)) == list(range(size))


def test_shards(spark):
    texts = odd_texts(300)
    df = documents(spark, texts).repartition(5)
    rows = sharding.shard_documents(df, 40).collect()
    assert len(rows) == len(texts)
    slots = {}
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) == set(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = sharding.shard_documents(documents(spark, texts).repartition(3), 40).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, rows), key=str)


def test_shards_of_repeated_and_missing_ids_and_of_nothing(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (1, None), (1, None), (2, "")], "doc_id long, text string")
    rows = sharding.shard_documents(df, 2).collect()
    assert sorted((r.shard, r.slot) for r in rows) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1)]
    assert sharding.shard_documents(df.limit(0)).collect() == []


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_pieces_give_the_ids_of_whole_texts(path):
    texts = odd_texts(800, seed=5)
    ids, ends = PieceEncoder(path).encode(pa.array(texts))
    whole = Tokenizer.from_file(path)
    for i, text in enumerate(texts):
        assert ids[ends[i] : ends[i + 1]].tolist() == whole.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("symbols, limit", [(1, 16), (2, 16), (40, 6), (300, 9), (300, 16)])
def test_code_lengths(symbols, limit):
    counts = np.random.default_rng(symbols).zipf(1.3, symbols).clip(max=10**9)
    lengths = huffman.code_lengths(counts, limit)
    assert lengths.max() <= limit and lengths.min() >= 1
    assert sum(2.0 ** -int(n) for n in lengths) <= 1
    codes = huffman.canonical_codes(lengths)
    words = [format(int(c), f"0{n}b") for c, n in zip(codes, lengths)]
    assert not any(a != b and b.startswith(a) for a in words for b in words)
    if limit == 16 and symbols > 1:  # no limit in the way: as good as Huffman's own
        import heapq

        heap, cost = list(map(int, counts)), 0
        heapq.heapify(heap)
        while len(heap) > 1:
            pair = heapq.heappop(heap) + heapq.heappop(heap)
            cost += pair
            heapq.heappush(heap, pair)
        if max(lengths) < 16:
            assert int((counts * lengths).sum()) == cost


def test_token_file_round_trip(spark):
    texts = odd_texts(200, seed=9)
    df = documents(spark, texts).repartition(4)
    rows = huffman.token_file(df, BYTES).orderBy("key").collect()
    whole, before = Tokenizer.from_file(BYTES), 0
    assert [r.key for r in rows] == list(range(len(texts)))
    for r in rows:
        ids = [*whole.encode(texts[r.key] or "", add_special_tokens=False).ids, 2]
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        assert (r.start, r.n_tokens) == (before, len(ids))
        before += len(ids)


def test_token_file_of_nothing(spark):
    assert huffman.token_file(documents(spark, ["x"]).limit(0), BYTES).collect() == []


def test_combinations_and_least_squares():
    for units, depth in ((1, 1), (6, 3), (12, 12)):
        found = packing.combinations(units, depth)
        assert (found @ np.arange(units + 1) == units).all() and (found.sum(1) <= depth).all()
        assert len(np.unique(found, axis=0)) == len(found)
    assert len(packing.combinations(12, 12)) == 77  # the partitions of 12
    draw = np.random.default_rng(3)
    a, truth = draw.random((8, 30)), np.zeros(30)
    truth[[2, 11, 23]] = [1.0, 4.0, 2.0]
    x = packing.nnls(a, a @ truth)
    assert x.min() >= 0 and np.allclose(a @ x, a @ truth, atol=1e-6)


def test_packing(spark):
    draw = random.Random(2)
    texts = [" ".join(draw.choice(["the", "word", "éé", "long"]) for _ in range(int(draw.paretovariate(1) * 60) % 9000)) for _ in range(400)]
    texts += [None, "", "word " * 13000, *["same text here"] * 30]
    df = documents(spark, texts).repartition(6)
    rows = packing.pack(df, WORDS).collect()
    whole = Tokenizer.from_file(WORDS)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, text in enumerate(texts):
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 2]
        pieces = sorted(by_doc[i], key=lambda r: r.start)
        assert [r.start for r in pieces] == list(np.cumsum([0, *[r.length for r in pieces[:-1]]]))
        assert sum((np.frombuffer(r.ids, "<u4").tolist() for r in pieces), []) == ids
        assert {r.doc_tokens for r in pieces} == {len(ids)}
    totals = []
    for pieces in by_sequence.values():
        pieces.sort()
        assert [p[0] for p in pieces] == list(np.cumsum([0, *[p[1] for p in pieces[:-1]]]))
        totals.append(sum(p[1] for p in pieces))
    assert max(totals) <= 4096 and sum(t < 4096 for t in totals) <= 1
    assert packing.pack(df.limit(0), WORDS).collect() == []
