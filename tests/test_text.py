from collections import Counter

from fieldloom.functions.words import PUNCTUATION, STOP_WORDS
from fieldloom.operators.parse import (
    label_range,
    parse_categorical,
    parse_numeric_points,
    shift_label,
)
from fieldloom.operators.tokens import tokenize, word_count
from fieldloom.sources import read_lines

import pytest


def lines(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


def test_read_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one two\n\nthree\n")
    rows = read_lines(spark, str(tmp_path / "a.txt"), "text")
    assert rows.columns == ["text"]
    assert sorted(row.text for row in rows.collect()) == ["", "one two", "three"]


def test_tokenize_keeps_empty_pieces(spark):
    words = [row.word for row in tokenize(lines(spark, "a  b ", "")).collect()]
    assert sorted(words) == ["", "", "", "a", "b"]


def test_word_count_against_brute_force(spark):
    texts = [
        "The [cat] sat on 'the' mat.\nThe cat, the <dog>!",
        "a-b - a-b: ## ##x `if` IF or",
        "cat\r\ndog\rcat  dog",
    ]
    expected = Counter()
    for text in texts:
        for line in text.splitlines():
            for raw in line.split(" "):
                word = raw.strip(PUNCTUATION)
                if word not in STOP_WORDS:
                    expected[word] += 1
    counts = {row.word: row["count"] for row in word_count(lines(spark, *texts)).collect()}
    assert counts == dict(expected)


def test_word_count_top(spark):
    top = word_count(lines(spark, "x y z y z z w"), k=2).collect()
    assert [tuple(row) for row in top] == [("z", 3), ("y", 2)]


def test_word_count_ties_break_by_word(spark):
    top = word_count(lines(spark, "d c b e"), k=2).collect()
    assert [row.word for row in top] == ["b", "c"]


def test_parse_numeric_points(spark):
    row = parse_numeric_points(lines(spark, "2001.0,0.884,0.61,1e-3")).first()
    assert row.label == 2001.0
    assert row.features == [0.884, 0.61, 1e-3]


def test_parse_numeric_points_other_separator(spark):
    row = parse_numeric_points(lines(spark, "1|2|3"), sep="|").first()
    assert (row.label, row.features) == (1.0, [2.0, 3.0])


def test_parse_numeric_points_rejects_text(spark):
    with pytest.raises(Exception, match="not a number"):
        parse_numeric_points(lines(spark, "1,x")).collect()
    row = parse_numeric_points(lines(spark, "1,x,2"), strict=False).first()
    assert row.features == [None, 2.0]


def test_parse_categorical(spark):
    row = parse_categorical(lines(spark, "0\t1\t1\t5\t\t1382")).first()
    assert row.label == 0.0
    assert [tuple(pair) for pair in row.feature] == [
        (0, "1"), (1, "1"), (2, "5"), (3, ""), (4, "1382"),
    ]


def test_parse_categorical_schema_and_short_lines(spark):
    parsed = parse_categorical(lines(spark, "x", ""))
    assert parsed.schema["feature"].dataType.simpleString() == "array<struct<_1:smallint,_2:string>>"
    assert [tuple(row) for row in parsed.collect()] == [(None, []), (None, [])]


def test_label_range_and_shift(spark):
    points = parse_numeric_points(lines(spark, "1922,1", "2011,2", "2001,3"))
    assert tuple(label_range(points).first()) == (1922.0, 2011.0)
    shifted = shift_label(points)
    assert sorted(row.label for row in shifted.collect()) == [0.0, 79.0, 89.0]
    assert shifted.columns == points.columns
