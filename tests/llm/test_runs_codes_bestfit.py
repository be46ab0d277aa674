"""Runs of words, vector codes and best-fit packing, against brute force."""

import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from fieldloom.llm import bestfit, codebooks, common, periodic, queries  # noqa: E402

WORDS = public_tokenizers.path("word_bpe_49k.json")


def written(spark, folder, name, rows, schema, parts=3):
    spark.createDataFrame(rows, schema).repartition(parts).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


# Runs


def brute_runs(words, least=6, exponent=4):
    n, out = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, exponent * q):
                part = words[i : i + length]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def repetitive(draw, n, letters):
    out = []
    while len(out) < n:
        root = [draw.choice(letters) for _ in range(draw.randrange(1, 9))]
        out += (root * draw.randrange(1, 8))[: draw.randrange(1, 40)]
        out += [draw.choice(letters) for _ in range(draw.randrange(4))]
    return out[:n]


@pytest.mark.parametrize("exponent, least", [(4, 6), (2, 2), (3, 1), (5, 30)])
def test_runs_of_stretches(exponent, least):
    draw = random.Random(exponent)
    many = [repetitive(draw, draw.randrange(1, 120), range(1, 2 + k % 5)) for k in range(150)]
    found = periodic.runs_of([np.array(x) for x in many], least, exponent)
    for k, words in enumerate(many):
        own = [tuple(r[1:]) for r in found.tolist() if r[0] == k]
        assert own == brute_runs(words, least, exponent), words


@pytest.mark.parametrize("exponent, least", [(4, 6), (2, 2), (3, 10)])
def test_runs_in_documents_after_rare_words_are_cut_out(exponent, least):
    draw = random.Random(7)
    docs = []
    for k in range(200):
        words = repetitive(draw, draw.randrange(60), range(3))
        rare = [draw.randrange(100, 160) for _ in range(draw.randrange(80))]
        docs.append([*words, *rare, *repetitive(draw, draw.randrange(60), range(50, 52)), *rare[:5]])
    codes = np.array([c for d in docs for c in d])
    owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    found = periodic.find_runs(codes, owner, least, exponent).tolist()
    expected, before = [], 0
    for d in docs:
        expected += [[before + s, length, q] for s, length, q in brute_runs(d, least, exponent)]
        before += len(d)
    assert found == expected


def test_suffix_tree_extensions():
    draw = random.Random(3)
    for _ in range(30):
        s = [*(draw.randrange(1, 3) for _ in range(draw.randrange(1, 60))), 0]
        tree = periodic.SuffixTree(np.array(s), 3)
        assert [i for _, i in sorted((s[i:], i) for i in range(len(s)))] == np.argsort(tree.rank).tolist()
        pairs = [(a, b) for a in range(len(s)) for b in range(len(s)) if a != b]
        same = [next(k for k in range(99) if a + k >= len(s) or b + k >= len(s) or s[a + k] != s[b + k]) for a, b in pairs]
        assert tree.extension(*np.array(pairs).T).tolist() == same


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def run_row(doc_id, text):
    words = planted(doc_id, re.findall("[^\x20\x09-\x0d]+", text or ""))
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *four, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_runs_query(spark, tmp_path):
    draw = random.Random(11)
    names = ["a", "b", "éé", "the", "x\x00y", "\x85", "\xa0"]
    space = [" ", "  ", "\n", "\t\x0b", "\r\x0c", " \n "]
    texts = [None, "", " \n", "one", "a " * 5000, "\n" + "a b " * 7, "x " * 6, "x " * 5]
    for k in range(400):
        words = repetitive(draw, draw.randrange(80), names[: 1 + k % 7]) if k % 2 else [draw.choice(names) + str(draw.randrange(60)) for _ in range(draw.randrange(400))]
        texts.append("".join(draw.choice(space[: 1 + k % 6]) + w for w in words))
    rows = [(i, t, 5, "k", "r") for i, t in enumerate(texts)]
    folder = written(spark, tmp_path, "documents", rows, "doc_id long, text string, start long, w string, runs string")
    found = sorted(map(tuple, queries.op12_periodic_runs(spark, folder).collect()))
    assert found == sorted(run_row(i, t) for i, t in enumerate(texts))
    assert sum(r[1] > 0 for r in found) > 100


def test_runs_of_missing_and_repeated_keys_and_of_nothing(spark):
    df = spark.createDataFrame([(None, "x " * 9), (1, "x " * 9), (1, "x " * 9), (2, None)], "doc_id long, text string")
    rows = periodic.word_runs(df).collect()
    assert [(r.doc_id, r.n_words, len(r.runs), r.collapsed) for r in rows] == [
        (None, 9, 1, "x"), (1, 9, 1, "x"), (1, 9, 1, "x"), (2, 0, 0, "")
    ]
    assert periodic.word_runs(df.limit(0)).collect() == []


# Vector codes


def brute_codes(rows, parts=4, entries=256, rounds=4):
    """rows: (key, vector, label) of fit vectors."""
    whole = [[math.floor(1024 * x) for x in v] for _, v, _ in rows]
    width = len(whole[0]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in whole]
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, whole[i]))[:entries]
    books = [[list(cut[i][p]) for i in first] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        moved = []
        for p in range(parts):
            members = {}
            for c in cut:
                members.setdefault(nearest(p, c[p])[1], []).append(c[p])
            moved.append([[sum(x) // len(members[k]) for x in zip(*members[k])] if k in members else e for k, e in enumerate(books[p])])
        books = moved
    found = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
    error = [sum(d for d, _ in f) for f in found]
    total = {}
    for (_, _, label), e in zip(rows, error):
        total[label] = total.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [
        (key, "".join(f"{k:02x}" for _, k in f), e, total[label], digest)
        for (key, _, label), f, e in zip(rows, found, error)
    ]


def by_row(rows):
    return sorted((tuple(r) for r in rows), key=str)


EMBEDDINGS = "vec_id long, embedding array<double>, label int, code string, error string, v int"


@pytest.mark.parametrize("kind", ["normal", "ties", "few"])
def test_codes_query(spark, tmp_path, kind):
    draw = np.random.default_rng(5)
    n = 40 if kind == "few" else 700
    vectors = draw.normal(0, 1, (n, 8)) if kind != "ties" else draw.integers(-2, 3, (n, 8)) / 1024
    rows = [(int(1000 - 7 * i), [float(x) for x in v], [None, 1, 1, 2][i % 4]) for i, v in enumerate(vectors)]
    rows += [(rows[3][0], rows[3][1], 9), (rows[3][0], rows[5][1], 9), (None, rows[6][1], None)]
    unfit = [(1, None, 1), (-9999, [None, *rows[0][1][1:]], 1), (-9998, [math.nan] * 8, 1), (-9997, [math.inf] * 8, 1)]
    folder = written(spark, tmp_path, "embeddings", [(*r, "c", "e", 1) for r in rows + unfit], EMBEDDINGS)
    assert by_row(queries.op13_vector_codes(spark, folder).collect()) == by_row(brute_codes(rows))


def test_codes_of_given_vectors(spark):
    folder = "/root/testdata/sf0.01"
    table = pq.read_table(f"{folder}/embeddings.parquet").to_pydict()
    rows = list(zip(table["vec_id"], table["embedding"], table["label"]))
    assert by_row(queries.op13_vector_codes(spark, folder).collect()) == by_row(brute_codes(rows))


def test_nearest_entries_of_large_and_small_numbers():
    draw = np.random.default_rng(1)
    for top, width in ((4, 3), (1 << 22, 5), (1 << 27, 16)):
        entries, parts = draw.integers(-top, top, (200, width)), draw.integers(-top, top, (1500, width))
        number, distance = codebooks.Codebook(entries).nearest(parts)
        whole = ((parts[:, None, :] - entries) ** 2).sum(2)
        assert (distance == whole.min(1)).all() and (number == whole.argmin(1)).all()


def test_decoded_vectors_and_their_error(spark):
    draw = np.random.default_rng(2)
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(draw.integers(-900, 900, (300, 8)) / 1024)]
    df = spark.createDataFrame([(*r, "c", "e", 1) for r in rows], EMBEDDINGS)
    coded, books = codebooks.compress(df)
    for r in codebooks.decode(coded, books).collect():
        gap = (np.array(rows[r.vec_id][1]) - np.array(r.vector)) * 1024
        assert int(round((gap**2).sum())) == r.error


def test_labels_that_are_many(spark, monkeypatch):
    monkeypatch.setattr(codebooks, "HOT", 3)
    rows = [(i, [0, 1, 1, 1, 2, None][i % 6] if i < 60 else i, b"", i) for i in range(90)]
    coded = spark.createDataFrame(rows, "key long, label int, code binary, error long")
    total = {}
    for _, label, _, error in rows:
        total[label] = total.get(label, 0) + error
    found = codebooks.with_label_error(coded).collect()
    assert sorted((r.key, r.label_error) for r in found) == [(k, total[label]) for k, label, _, _ in rows]


def test_codes_of_nothing_and_of_what_has_no_code(spark):
    none = spark.createDataFrame([(1, None, 1, "", "", 1)], EMBEDDINGS)
    assert codebooks.compress(none)[0].collect() == [] and codebooks.compress(none)[1] == []
    assert codebooks.compress(none.limit(0))[0].columns == ["vec_id", "label", "code", "error", "label_error"]
    for bad in ([[1.0] * 8, [1.0] * 4], [[1.0] * 6], [[1e300] * 8], [[]]):
        df = spark.createDataFrame([(i, v, 1, "", "", 1) for i, v in enumerate(bad)], EMBEDDINGS)
        with pytest.raises(Exception, match="component"):
            codebooks.compress(df)


# Best-fit packing


def brute_best_fit(lengths, window):
    """Room left in each sequence, by best-fit decreasing over single pieces."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [i for i, room in enumerate(rooms) if room >= n]
        if fit:
            rooms[min(fit, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(window - n)
    return sorted(rooms)


@pytest.mark.parametrize("window", [1, 7, 64, 100])
def test_plan_is_that_of_best_fit_over_single_pieces(window):
    draw = random.Random(window)
    for n in (0, 1, 5, 300):
        for _ in range(20):
            lengths = [min(window, 1 + int(draw.expovariate(8 / window))) if draw.random() < 0.7 else draw.choice([1, window, window // 2 + 1]) for _ in range(n)]
            histogram = np.bincount(lengths, minlength=window + 1) if n else np.zeros(window + 1, np.int64)
            steps, sequences = bestfit.plan_slots(histogram, window)
            all_ = np.repeat(np.arange(window + 1), histogram)
            ranks = np.concatenate([np.arange(c) for c in histogram])
            order = np.random.default_rng(n).permutation(n)
            used = [[] for _ in range(sequences)]
            if n:
                sequence, offset = bestfit.Slots(steps)(all_[order], ranks[order].astype(int))
                for s, o, length in zip(sequence, offset, all_[order]):
                    used[s].append((o, length))
            for pieces in used:
                pieces.sort()
                assert [o for o, _ in pieces] == list(np.cumsum([0, *[x for _, x in pieces[:-1]]]))
            assert sorted(window - sum(x for _, x in p) for p in used) == brute_best_fit(lengths, window)


def test_best_fit_query(spark, tmp_path):
    draw = random.Random(2)
    texts = [" ".join(draw.choice(["the", "word", "éé", "long"]) for _ in range(int(draw.paretovariate(1) * 60) % 5000)) for _ in range(400)]
    texts += [None, "", "word " * 13000, "word " * 2047, "word " * 2048, *["same text here"] * 30, *[""] * 50]
    rows = [(i, t, 3, "x", "y") for i, t in enumerate(texts)]
    folder = written(spark, tmp_path, "documents", rows, "doc_id long, text string, piece long, key string, ids string", 6)
    whole = Tokenizer.from_file(WORDS)
    by_doc, by_sequence = {}, {}
    for r in queries.op11_best_fit(spark, folder).collect():
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    lengths = []
    for i, text in enumerate(texts):
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(-(-len(ids) // 2048)))
        for r in pieces:
            own = ids[r.piece * 2048 : (r.piece + 1) * 2048]
            assert (r.start, r.length) == (r.piece * 2048, len(own))
            assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
            lengths.append(len(own))
    for pieces in by_sequence.values():
        pieces.sort()
        assert [p[0] for p in pieces] == list(np.cumsum([0, *[p[1] for p in pieces[:-1]]]))
    left = sorted(2048 - sum(p[1] for p in pieces) for pieces in by_sequence.values())
    assert left == brute_best_fit(lengths, 2048)


def test_best_fit_of_missing_and_repeated_keys_and_of_nothing(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (1, None), (1, None), (2, "")], "doc_id long, text string")
    rows = bestfit.pack(df, WORDS, window=2).collect()
    assert sorted((r.length, r.offset) for r in rows) == [(1, 0), (1, 0), (1, 1), (2, 0), (2, 0)]
    assert bestfit.pack(df.limit(0), WORDS).collect() == []


# Word codes


def test_words_that_sums_of_letters_confuse_have_codes_of_their_own():
    letters = np.arange(256, dtype=np.uint8)
    letters[0x20] = 0
    for size in (1024, 2048, 4096):
        one = "".join("ab"[bin(i).count("1") % 2] for i in range(size))
        two = one.translate(str.maketrans("ab", "ba"))
        raw = np.frombuffer(f"{one} {two} {one}".encode(), np.uint8)
        codes, counts = common.word_codes(raw, np.array([0, len(raw)]), letters)
        assert codes[0] != codes[1] and codes[0] == codes[2] and counts.tolist() == [0, 3]
