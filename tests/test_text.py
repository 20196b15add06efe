"""Text expressions against plain Python on hand-made and random texts."""

import re
import string

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from pyspark.sql import functions as F

from lexiloom.functions import budgets, languages, prompts, responses, results, text

# Fixed value: the sentence boundary.
BOUNDARY = r"(?<!\w\.\w.)(?<![A-Z][a-z]\.)(?<=\.|\?|\!)\s+"
CASES = [
    "",
    " ",
    "one",
    "No terminator here",
    "Mr. X came. He left.",
    "See e.g. this one. And that!",
    "Line one.\nLine two?\n\n  Line three!  ",
    "Tabs\tand spaces. Wide. \x1cSeparator!",
    "Wait... what?! Yes!!",
    "a.b.c. d",
    "Éa. Ñb! ¿Que? ßs.",
    "end without",
    "...",
    ". . .",
    "x\r\ny. z w. v",
    "one two. three four. five six seven! eight nine ten eleven twelve",
]


def frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, text string")


def collect(spark, values, column):
    return [r[0] for r in frame(spark, values).orderBy("i").select(column).collect()]


def python_sentences(value):
    return [s.strip() for s in re.split(BOUNDARY, value) if s.strip()]


def cut_places(value, limit):
    """Where chunks must end, as word counts from the start: the first sentence end at or after each limit."""
    words = value.split()
    if len(words) <= limit:
        return []
    ends = [i for i, word in enumerate(words, 1) if re.search(r"[.!?]$", word)]
    places = [0]
    while (later := [e for e in ends if e >= places[-1] + limit]):
        places.append(later[0])
    return [p for p in places[1:] if p < len(words)]


def expected_chunks(value, limit):
    places, words = cut_places(value, limit), value.split()
    if len(words) <= limit:
        return [value]
    return [" ".join(words[a:b]) for a, b in zip([0, *places], [*places, len(words)])]


def chunks_of(spark, values, limit):
    done = text.with_chunks(frame(spark, values), "text", "chunks", limit)
    return [r["chunks"] for r in done.orderBy("i").collect()]


def test_sentences_words_and_counts(spark):
    c = F.col("text")
    assert collect(spark, CASES, text.split_sentences(c)) == [python_sentences(v) for v in CASES]
    assert collect(spark, CASES, text.word_count(c)) == [len(v.split()) for v in CASES]
    assert collect(spark, CASES, text.sentence_count(c)) == [len(re.findall(r".+?[.!?]+", v)) for v in CASES]
    table = str.maketrans("", "", string.punctuation)
    assert collect(spark, CASES, text.normalize(c)) == [v.lower().translate(table) for v in CASES]
    assert collect(spark, CASES, text.strip(c)) == [v.strip() for v in CASES]


@pytest.mark.parametrize("limit", [1, 2, 3, 5, 500])
def test_chunks(spark, limit):
    assert chunks_of(spark, CASES, limit) == [expected_chunks(v, limit) for v in CASES]


WORDS = st.lists(st.sampled_from(["a", "b.", "cc", "d!", "e?", "f.g", "."]), max_size=40).map(" ".join)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(WORDS, min_size=5, max_size=20), limit=st.integers(1, 8))
def test_chunk_properties(spark, values, limit):
    for value, chunks in zip(values, chunks_of(spark, values, limit)):
        assert chunks == expected_chunks(value, limit)
        assert " ".join(chunks).split() == value.split()
        for chunk in chunks[:-1]:
            assert chunk[-1] in ".!?" and len(chunk.split()) >= limit


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.text(alphabet="aB .!?\n\té1", max_size=60), min_size=5, max_size=20))
def test_random_texts(spark, values):
    c = F.col("text")
    assert collect(spark, values, text.split_sentences(c)) == [python_sentences(v) for v in values]
    assert collect(spark, values, text.sentence_count(c)) == [len(re.findall(r".+?[.!?]+", v)) for v in values]


def test_budget_follows_the_words(spark):
    values = ["w " * n for n in (0, 1, 74, 75, 76, 150, 2000, 3000)]
    expected = [512, 512, 512, 512, 1024, 1024, 13824, 16384]
    assert collect(spark, values, budgets.token_budget(F.col("text"))) == expected
    tiers = collect(spark, values, budgets.budget_tiers(budgets.token_budget(F.col("text"))))
    assert tiers == [[min(b * f, 16384) for f in (1, 2, 4)] for b in expected]


def test_rendering_reads_no_slots_in_values(spark):
    values = {"a": "{b}", "b": "{a}"}
    column = prompts.render("{a}-{b}-{c}-{{", a=F.lit("{b}"), b=F.lit("{a}"))
    assert collect(spark, ["x"], column) == ["{b}-{a}-{c}-{{"]
    assert prompts.fill("{a}-{b}-{c}-{{", values) == "{b}-{a}-{c}-{{"


def test_judge_answers(spark):
    answers = ['{"score": 4.0, "reasoning": " fine "}', "```json\n{\"score\": 2.5}\n```", "{}", "no", None]
    rows = collect(spark, answers, responses.parse_judge(F.col("text")))
    assert [r["label"] for r in rows] == ["good", "acceptable", "poor", None, None]
    assert [r["score"] for r in rows] == [4.0, 2.5, 0.0, None, None]
    assert rows[0]["reasoning"] == "fine"
    assert [r["error"] is None for r in rows] == [True, True, True, False, False]


def test_judge_scores_as_text_null_or_nonsense(spark):
    answers = ['{"score": "4.5"}', '{"score": null}', '{"score": "high"}', '{"fluency": 1}']
    rows = collect(spark, answers, responses.parse_judge(F.col("text")))
    assert [r["score"] for r in rows] == [4.5, None, None, 0.0]
    assert [r["error"] is None for r in rows] == [True, False, False, True]


def test_blank_words_are_routed(spark):
    words = ["ok", "\t\n", " ", "", None]
    problems = collect(spark, words, results.row_problem(word=F.col("text")))
    assert problems == [None, "blank word", "blank word", "blank word", "blank word"]


def test_error_marks(spark):
    values = ["[ERROR after 3 attempts: x]", "[ERROR: x]", "Error: x", "fine", None]
    assert collect(spark, values, responses.is_error(F.col("text"))) == [True, True, True, False, False]


def test_pair_is_case_insensitive(spark):
    pair = languages.DEFAULT_PAIR
    values = ["English", "KINYARWANDA", "french", None]
    assert collect(spark, values, pair.is_member(F.col("text"))) == [True, True, False, False]
    assert collect(spark, values, pair.target(F.col("text"))) == ["kinyarwanda", "english", None, None]
    assert collect(spark, values, languages.scorer_for(F.col("text"))) == ["general", "low_resource", "general", "general"]


def test_guards():
    with pytest.raises(ValueError):
        results.check_temperature(2.5)
    with pytest.raises(ValueError):
        results.check_languages("en", "en")
    assert results.check_temperature(2.0) == 2.0


def test_required_columns(spark):
    df = spark.createDataFrame([("a", "b")], "source_text string, reference string")
    with pytest.raises(ValueError, match="translation"):
        results.rename_and_require(df, {"source_text": "source"}, ["source", "translation"])
