"""A word and the stem of the same letters in one lexicon."""

import pytest

from docflow.llm import toxicity


@pytest.mark.parametrize("entries", [{"scum*": 5.0, "scum": 4.5}, {"scum": 4.5, "scum*": 5.0}])
def test_a_word_and_its_equal_stem_both_match(entries):
    lexicon = toxicity.Lexicon(entries)
    assert lexicon.matches("scum, scumbag") == {0: (4, 4.5), 6: (10, 5.0)}
    assert toxicity.Lexicon({"scum": 4.5}).matches("scum, scumbag") == {0: (4, 4.5)}


def test_inflections_of_a_learnt_word_match(spark):
    bad = [(f"you {w} {i}x", 1) for i in range(60) for w in ("scum", "scumbag", "scums")]
    good = [(f"you {w} {i}x", 0) for i in range(300) for w in ("friend", "reader")]
    lexicon = toxicity.learn(spark.createDataFrame(bad + good, "text string, y int"))
    assert {"scum", "scum*"} <= set(lexicon.entries)
    assert all(lexicon.matches(w) for w in ("scum", "scums", "scumbag"))
