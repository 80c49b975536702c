import pytest
from pyspark.sql import functions as F

from strataframe.llm import _shared, line_dedup, span_dedup
from tests.llm import brute

BOTH = [line_dedup.dedup_lines, span_dedup.dedup_spans]


def rows(found):
    return sorted([(r.doc_id, r.text) for r in found], key=str)


def test_lines_equal_maximal_common_runs(spark, prose):
    """Every two places are compared line by line, with no windows, fingerprints or hashes."""
    docs = [(i, t[:4000] if t else t) for i, t in prose if i != 7]
    docs += [(1000 + k, "\n".join(x)) for k, x in enumerate((["a b", "", "c d e f g h i", "x"], ["a b", "", "c d e f g h i", "y", "a b"], ["", "", "c d e f g h i", "", "x"], ["one two three"] * 9, ["b", *["one two three"] * 3, "c"], [""] * 40 + ["a b", ""] * 3))]
    wanted = brute.dedup_maximal(docs)
    found = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()
    assert rows(found) == sorted([(i, wanted[i, t]) for i, t in docs], key=str)
    assert any(r.removed for r in found)


def test_spans_equal_brute_force(spark, prose):
    docs = [d for d in prose if d[0] != 7]
    wanted = brute.dedup(docs, brute.sentences, brute.sentence_runs)
    found = span_dedup.dedup_spans(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()
    assert rows(found) == sorted([(i, wanted[i, t]) for i, t in docs], key=str)
    assert any(r.removed for r in found)


@pytest.mark.parametrize("dedup", BOTH)
def test_cases(spark, dedup):
    long = "a sentence with more than ten words in it so that it counts alone. And another one of some more words that stands behind the first."
    docs = spark.createDataFrame([(1, long + "\nshort"), (2, "short\n" + long), (2, "other\n" + long), (3, None), (4, ""), (None, long)], "doc_id long, text string")
    docs = docs.withColumns({c: F.lit(1) for c in ("units", "removed", "row", "ord", "starts", "lines", "sentences", "__key", "Spans")}).withColumn("key", F.lit("k"))
    assert rows(dedup(docs).collect()) == sorted([(1, long + "\nshort"), (2, "short"), (2, "other"), (3, None), (4, ""), (None, "")], key=str)
    assert dedup(docs.limit(0)).collect() == []


@pytest.mark.parametrize("dedup", BOTH)
def test_very_common_runs_are_sent_to_all_tasks(spark, dedup, monkeypatch):
    """The same result whether a run counts as common or not, with two thirds of the rows alike."""
    text = "these are eight words in one single line. And these are fifteen more words of a second sentence in the line.\n"
    docs = spark.createDataFrame([(i, text + f"own {i} words") for i in range(400)] + [(500, f"x {text}")] * 300, "doc_id long, text string").repartition(6)
    plain = rows(dedup(docs).collect())
    monkeypatch.setattr(_shared.looked_up, "__defaults__", (5,))
    assert rows(dedup(docs).collect()) == plain
    assert (0, text + "own 0 words") in plain and (399, "own 399 words") in plain


def test_long_text_of_blank_lines(spark):
    text = "\n" * 200_000 + "some words of a line that is long enough\n" + "\n" * 200_000
    docs = spark.createDataFrame([(1, text), (2, "a\n" + text + "b")], "doc_id long, text string")
    found = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert found[1] == text and found[2].split() == ["a", "b"]


def test_a_run_within_one_text(spark):
    line = "these are eight words in one single line\n"
    docs = spark.createDataFrame([(1, line * 4 + "end")], "doc_id long, text string")
    assert line_dedup.dedup_lines(docs).first().text == line + "end"


def test_all_columns_and_empty_rests(spark):
    line = "these are eight words in one single line"
    docs = spark.createDataFrame([(1, line, 40), (2, line, 40), (3, line + "\nrest", 45), (4, "", 0), (5, None, None)], "doc_id long, text string, n_chars long").withColumns({"removed": F.lit("own"), "text_": F.lit(1)})
    found = line_dedup.without_repeats(docs)
    assert found.columns == docs.columns and sorted(map(tuple, found.collect())) == [(1, line, 40, "own", 1), (3, "rest", 4, "own", 1), (4, "", 0, "own", 1), (5, None, None, "own", 1)]
