"""The corpus pipeline, stage by stage, against brute force on a small corpus."""

import random

import brute
import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fieldloom.llm import quality, secrets
from fieldloom.storage import materialize

WORDS = ["river", "stone", "runs", "under", "bridge", "and", "the", "old", "mill", "by"]


def prose(draw, n):
    return " ".join(draw.choice(WORDS) + str(draw.randrange(90)) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    draw = random.Random(12)
    items = [(i, prose(draw, 30)) for i in range(4)]
    texts, labels = [], []
    for i in range(150):
        text = prose(draw, draw.randrange(60, 160))
        poor = i % 4 == 0
        texts.append(" ".join(f"{w.upper()}!!" for w in text.split()) if poor else text)
        labels.append((i, int(not poor), 0))
    texts += [texts[1], texts[2] + " tail", texts[3].replace("river", "rivers", 1)]
    texts += [prose(draw, 40) + " " + items[0][1] + " " + prose(draw, 10)]
    texts += [texts[5] + ' x token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" y ' + prose(draw, 60), None, ""]
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in enumerate(texts)]
    shape = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, shape).repartition(5).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, items


def test_stages(spark, folder):
    path, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    results = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        results.append(materialize(stage(spark, results[-1], path), f"stage-{i}"))
    assert all(r.columns == columns for r in results[:-1])
    texts = [dict((r.doc_id, r.text) for r in df.collect()) for df in results[:-1]]
    every, good, single, clean, masked = texts
    scored = quality.classify(docs, spark.read.parquet(f"{path}/labels.parquet")).collect()
    assert set(good) == {r.doc_id for r in scored if r.predicted}
    assert not any(good[i] and "!!" in good[i] for i in good) and set(range(1, 150)) - set(range(0, 150, 4)) <= set(good)
    component, sizes = brute.near_duplicates(sorted(good.items()), 5, 80)
    assert set(single) == {i for i in good if component[i] == i or not sizes[i]}
    assert {150, 151, 152} & set(single) == set()
    judged = brute.contamination(sorted(single.items()), items)
    assert set(clean) == {i for i in single if not judged[i][4]} and 153 not in clean
    assert set(masked) == set(clean)
    for i, text in clean.items():
        spans = [(a, b) for a, b, _ in brute.base_findings(text)]
        assert masked[i] == (secrets._replaced(text, spans, "[secret]") if spans else text)
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {}
    for r in results[-1].collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
    assert set(pieces) == set(masked)
    for i, own in pieces.items():
        own.sort()
        count = len(whole.encode(masked[i] or "", add_special_tokens=False).ids) + 1
        assert [s for s, *_ in own] == list(np.cumsum([0, *[n for _, n, _ in own[:-1]]]))
        assert sum(n for _, n, _ in own) == count == own[0][2]


def test_names():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "MinHash near-dedup", "benchmark decontamination", "secret scans", "packing"]
