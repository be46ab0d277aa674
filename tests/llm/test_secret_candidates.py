"""Every token of six characters is a candidate of the secret scan."""

import random

import numpy as np
import pyarrow as pa
from test_documents import prose

from fieldloom.llm import secrets


def candidates(text):
    found = secrets.find(pa.array([text]))
    return [found.raw[a:b].tobytes().decode() for a, b in zip(found.begin, found.end)]


def test_candidates_without_digits_short_and_dotted():
    assert candidates("auth QwErTyUiOpAsDfGhJkLz") == ["QwErTyUiOpAsDfGhJkLz"]
    assert candidates("pass: xK4pQz.") == ["xK4pQz"]
    assert candidates("Bearer ab1.cd2.ef3 é") == ["Bearer", "ab1.cd2.ef3"]
    draw = np.random.default_rng(1)
    keys = ["".join(secrets._MIXED[i] for i in draw.integers(0, 62, 16)) for _ in range(300)]
    assert all(candidates(f"is {k} ok") == [k] for k in keys)


def test_misses_count_against_the_recall():
    draw = random.Random(1)
    x, y = secrets.labelled_findings([prose(draw, 60) for _ in range(50)], seed=1)
    net = secrets.CharNet().fit(x, y)
    before = net.calibrate(x, y).threshold
    lost = np.full((int(0.03 * y.sum()), secrets.WIDTH), secrets._NONE, np.uint8)
    net.calibrate(np.concatenate([x, lost]), np.concatenate([y, np.ones(len(lost), np.float32)]))
    assert net.threshold < before
    kept = (net.probability(x[y == 1]) >= net.threshold).sum()
    assert kept >= secrets.RECALL * (y.sum() + len(lost)) - 1


def test_fast_logits_are_those_of_the_network():
    draw = np.random.default_rng(2)
    net = secrets.CharNet()
    x = draw.integers(0, 98, (50, secrets.WIDTH)).astype(np.uint8)
    assert np.allclose(net.logits(x), net._forward(x)[-1], atol=1e-4)


def test_keys_behind_other_names_and_plain_words():
    draw = random.Random(3)
    texts = [prose(draw, 60) for _ in range(200)]
    x, y = secrets.labelled_findings(texts)
    held = np.arange(len(x)) % 5 == 4
    net = secrets.CharNet().fit(x[~held], y[~held]).calibrate(x[held], y[held])
    keys = ["".join(draw.choices(secrets._MIXED[:52], k=24)) for _ in range(200)]
    spans = secrets._spans(secrets.find(pa.array([f"the auth: {k} of it" for k in keys])), net)
    # The hardest kind; the recall of the threshold is that of all kinds together.
    assert np.mean([any(a <= 10 and b >= 34 for a, b, _ in s) for s in spans]) >= 0.8
    other = secrets.find(pa.array([prose(draw, 60) for _ in range(100)]))
    hits = sum(k == "learned" for s in secrets._spans(other, net) for *_, k in s)
    assert hits <= 0.01 * len(other.begin)


def test_what_is_left_of_a_token_around_a_base_finding_is_scored():
    digits = "0123456789abcdef0123456789abcdef"
    assert candidates(f"is {digits} ok") == []
    assert candidates(f"is abc{digits}xyz ok") == []  # less is left than a token
    assert candidates(f"is QwErTyUi{digits}xyz ok") == [f"QwErTyUi{digits}xyz"]
    assert candidates("password=hunter22 and others") == ["others"]


def test_letters_around_a_base_finding_are_masked():
    draw = random.Random(3)
    texts = [prose(draw, 60) for _ in range(200)]
    x, y, sorts, tokens = secrets.labelled_tokens(texts)
    held = tokens % 5 == 4
    net = secrets.CharNet().fit(x[~held], y[~held]).calibrate(x[held], y[held], sorts=sorts[held])
    letters = secrets._MIXED[:52]
    masked = 0
    for _ in range(100):
        token = "".join(draw.choices(letters, k=23)) + "4f" * 12 + "".join(draw.choices(letters, k=12))
        text = f"the key {token} of it"
        found = secrets._spans(secrets.find(pa.array([text])), net)[0]
        masked += secrets._replaced(text, [s[:2] for s in found], "[secret]") == "the key [secret] of it"
    assert masked >= 95


def test_recall_of_each_sort_of_findings_on_tokens_that_were_not_trained_on():
    draw = random.Random(4)
    x, y, sorts, tokens = secrets.labelled_tokens([prose(draw, 60) for _ in range(200)])
    held = tokens % 5 == 4
    net = secrets.CharNet().fit(x[~held], y[~held]).calibrate(x[held], y[held], sorts=sorts[held])
    probability = net.probability(x[held])
    for sort in np.unique(sorts[held & (y == 1)]):
        own = (y[held] == 1) & (sorts[held] == sort)
        if own.sum() >= secrets.SORT_ROWS:
            assert (probability[own] >= net.threshold).mean() >= secrets.RECALL
    assert not set(tokens[held]) & set(tokens[~held])


def test_windows_over_the_ends_of_texts():
    draw = random.Random(6)
    texts = [prose(draw, draw.randrange(1, 9)) + "x" * draw.randrange(90) for _ in range(60)]
    found = secrets.find(pa.array(texts))
    x = secrets.windows(found.raw, found.offsets, found.text, found.begin, found.end)
    for row, t, a, b in zip(x, found.text, found.begin, found.end):
        text = texts[t].encode()
        a, b = a - found.offsets[t], b - found.offsets[t]
        token = text[a:b] if b - a <= 40 else text[a : a + 20] + text[b - 20 : b]
        codes = lambda part: [int(secrets._CODE[c]) for c in part]
        left, right = codes(text[max(0, a - 20) : a]), codes(text[b : b + 8])
        none = [secrets._NONE]
        inside = codes(token)
        assert row.tolist() == none * (20 - len(left)) + left + inside + none * (40 - len(inside)) + right + none * (8 - len(right))


def test_the_sample_holds_each_text_once(spark):
    rows = [("same " * 9,)] * 300 + [(f"text {i}",) for i in range(500)] + [(None,), ("x" * (1 << 17),)]
    df = spark.createDataFrame(rows, "text string").repartition(5)
    found = secrets.sample_texts(df, rows=100)
    assert len(found) == len(set(found)) and 50 <= len(found) <= 100
    assert secrets.sample_texts(df.repartition(2), rows=100) == found
    assert len(secrets.sample_texts(df, rows=5000)) == 501
    assert secrets.sample_texts(df.limit(0)) == []
