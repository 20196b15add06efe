"""Model calls as columns.  Only the texts cross to Python; the other columns stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexiloom.functions.ngrams import bare_chrf_scores, portions
from lexiloom.functions.prompts import fill
from lexiloom.functions.text import bind
from lexiloom.providers.base import CallSettings, Provider, RetryPolicy, Step, run_batch

CALL_SCHEMA = "values array<string>, error string, attempts int, budget long"
ATTEMPT_SCHEMA = "forward string, back string, score double"
BEST_SCHEMA = f"{ATTEMPT_SCHEMA}, attempt int, temperature double"

# Fixed values of the sweep: stop at once from 95, keep the best one from 50.
EARLY_STOP = 95.0
MIN_THRESHOLD = 50.0
TEMPERATURES = tuple(n / 10 for n in range(11))

# Scores that differ by the order of additions only are equal: the earlier attempt wins.
DIGITS = 9

# Characters that go through the model and back to Spark together, so that memory does not grow with an Arrow batch.
PORTION = 1 << 20

Gate = Callable[[pd.Series], np.ndarray]
Scores = Callable[[list[str], list[str]], np.ndarray]  # of hypotheses and references


def call_model(
    provider: Provider,
    text: Column,
    system: Column,
    model_name: str,
    temperature: Column | float = 0.0,
    max_tokens: Column | int | None = None,
    policy: RetryPolicy = RetryPolicy(),
) -> Column:
    """Struct ``value, error, attempts, budget`` of one call per row."""
    done = call_model_on_parts(provider, F.array(text), system, model_name, temperature, max_tokens, policy)
    return _named(done, lambda values: values[0])


def call_model_on_parts(
    provider: Provider,
    parts: Column,
    system: Column,
    model_name: str,
    temperature: Column | float = 0.0,
    max_tokens: Column | int | None = None,
    policy: RetryPolicy = RetryPolicy(),
) -> Column:
    """Calls for every part of a row's array of texts, many rows together.

    Parts stay in their row, so a long text needs no shuffle to be put together again.  The struct has
    the answers in order, the first error if any part failed, the number of calls and the largest budget.
    """

    def answers(part_lists: pd.Series, systems: pd.Series, temperatures: pd.Series, budgets: pd.Series) -> pd.DataFrame:
        sizes = [0 if parts is None else len(parts) for parts in part_lists]
        row_of = np.repeat(np.arange(len(sizes)), sizes)
        texts = [t or "" for parts in part_lists if parts is not None for t in parts]
        configs = [
            CallSettings(
                model_name,
                float(temperatures.iat[r]),
                None if pd.isna(budgets.iat[r]) else int(budgets.iat[r]),
            )
            for r in row_of
        ]
        outcomes = run_batch(provider, policy, texts, [systems.iat[r] for r in row_of], configs)
        ends = np.cumsum(sizes)
        grouped = [outcomes[end - size : end] for end, size in zip(ends, sizes)]
        return pd.DataFrame(
            {
                "values": [[o.value for o in g] for g in grouped],
                "error": [next((o.error for o in g if o.error is not None), None) for g in grouped],
                "attempts": [sum(o.attempts for o in g) for g in grouped],
                "budget": pd.Series(
                    [max((o.budget for o in g if o.budget is not None), default=None) for g in grouped],
                    dtype="Int64",
                ),
            }
        )

    @F.pandas_udf(CALL_SCHEMA)
    def run(
        batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]],
    ) -> Iterator[pd.DataFrame]:
        provider.open()
        try:
            for batch in batches:
                for a, b in portions(map(_chars, batch[0]), PORTION):
                    yield answers(*(column.iloc[a:b] for column in batch))
        finally:
            provider.close()

    temperature = temperature if isinstance(temperature, Column) else F.lit(float(temperature))
    budget = max_tokens if isinstance(max_tokens, Column) else F.lit(max_tokens).cast("long")
    return run.asNondeterministic()(parts, system, temperature, budget)


def call_batches(
    provider: Provider,
    texts: Column,
    system: Column,
    model_name: str,
    max_tokens: Column,
    policy: RetryPolicy = RetryPolicy(),
) -> Column:
    """Array of ``value, error`` for an array of texts that the model gets as one batch."""

    @F.pandas_udf("array<struct<value: string, error: string>>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        provider.open()
        try:
            for batch in batches:
                for a, b in portions(map(_chars, batch[0]), PORTION):
                    answers = []
                    for texts, system, cap in zip(*(column.iloc[a:b] for column in batch), strict=True):
                        settings = [CallSettings(model_name, 0.0, int(cap))] * len(texts)
                        outcomes = run_batch(provider, policy, [t or "" for t in texts], [system] * len(texts), settings)
                        answers.append([{"value": o.value, "error": o.error} for o in outcomes])
                    yield pd.Series(answers, dtype=object)
        finally:
            provider.close()

    return run.asNondeterministic()(texts, system, max_tokens)


def _chars(texts: np.ndarray | None) -> int:
    return 0 if texts is None else sum(len(t) for t in texts if t is not None)


def _named(call: Column, pick: Callable[[Column], Column]) -> Column:
    return bind(
        call,
        lambda c: F.struct(
            pick(c["values"]).alias("value"),
            c["error"].alias("error"),
            c["attempts"].alias("attempts"),
            c["budget"].alias("budget"),
        ),
    )


def call_round_trip(
    provider: Provider,
    text: Column,
    forward_system: Column,
    backward_system: Column,
    model_name: str,
    temperature: Column | float = 0.0,
    policy: RetryPolicy = RetryPolicy(),
) -> Column:
    """Struct ``forward, back, error``: both calls of a row in one visit to Python."""

    @F.pandas_udf("forward string, back string, error string")
    def run(
        batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]],
    ) -> Iterator[pd.DataFrame]:
        provider.open()
        try:
            for texts, forth, home, temperatures in batches:
                configs = [CallSettings(model_name, float(t)) for t in temperatures]
                there = run_batch(provider, policy, [t or "" for t in texts], forth.tolist(), configs)
                good = [i for i, o in enumerate(there) if o.error is None]
                back = run_batch(
                    provider, policy, [there[i].value for i in good], home.iloc[good].tolist(), [configs[i] for i in good]
                )
                returned: list[str | None] = [None] * len(there)
                errors = [o.error for o in there]
                for i, outcome in zip(good, back):
                    returned[i], errors[i] = outcome.value, outcome.error
                yield pd.DataFrame({"forward": [o.value for o in there], "back": returned, "error": errors})
        finally:
            provider.close()

    temperature = temperature if isinstance(temperature, Column) else F.lit(float(temperature))
    return run.asNondeterministic()(text, forward_system, backward_system, temperature)


def call_chain(
    provider: Provider, inputs: dict[str, Column], steps: list[Step], model_name: str, policy: RetryPolicy = RetryPolicy()
) -> Column:
    """Struct of every step's answer and ``error``: all steps of a row in one visit to Python.

    A row that fails keeps the first error with the name of its step; its later steps are not asked.
    """
    names = list(inputs)
    schema = ", ".join(f"{name} string" for name in [*(step.out for step in steps), "error"])

    @F.pandas_udf(schema)
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        provider.open()
        try:
            for columns in batches:
                size = len(columns[0])
                values = {name: column.to_numpy(dtype=object) for name, column in zip(names, columns)}
                error = np.full(size, None, dtype=object)
                active = np.arange(size)
                for step in steps:
                    values[step.out] = np.full(size, None, dtype=object)
                    slots = [{slot: values[name][i] for slot, name in step.slots.items()} for i in active]
                    outcomes = run_batch(
                        provider,
                        policy,
                        [fill(step.text, s) for s in slots],
                        [fill(step.system, s) for s in slots],
                        [CallSettings(model_name, step.temperature)] * len(active),
                    )
                    for i, outcome in zip(active, outcomes):
                        if outcome.error is None:
                            values[step.out][i] = outcome.value
                        else:
                            error[i] = f"{step.out}: {outcome.error}"
                    active = active[[o.error is None for o in outcomes]]
                yield pd.DataFrame({step.out: values[step.out] for step in steps} | {"error": error})
        finally:
            provider.close()

    # The iterator form takes a tuple of columns; a constant second one serves chains with one input.
    columns = list(inputs.values())
    return run.asNondeterministic()(*columns, *([F.lit("")] if len(columns) == 1 else []))


def _attempt(
    provider: Provider,
    policy: RetryPolicy,
    sentences: list[str],
    there: str,
    home: str,
    settings: CallSettings,
    gate: Gate | None,
    scores: Scores,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``forward, back, score`` of one attempt at every sentence; the score is NaN where it failed or did not pass."""
    size = len(sentences)
    outcomes = run_batch(provider, policy, sentences, [there] * size, [settings] * size)
    forward = np.array([o.value for o in outcomes], dtype=object)
    usable = np.array([o.error is None for o in outcomes], dtype=bool)
    if gate is not None and usable.any():
        usable[usable] = gate(pd.Series(forward[usable]))
    rows = np.flatnonzero(usable)
    returned = run_batch(provider, policy, forward[rows].tolist(), [home] * len(rows), [settings] * len(rows))
    kept = np.array([o.error is None for o in returned], dtype=bool)
    rows, values = rows[kept], [o.value for o in returned if o.error is None]
    back, score = np.full(size, None, dtype=object), np.full(size, np.nan)
    if len(rows):
        back[rows] = values
        score[rows] = np.round(scores(values, [sentences[i] for i in rows]), DIGITS)
    return forward, back, score


def try_attempt(
    provider: Provider,
    sentence: Column,
    forward_system: str,
    backward_system: str,
    model_name: str,
    temperature: float,
    gate: Gate | None = None,
    policy: RetryPolicy = RetryPolicy(),
) -> Column:
    """Struct ``forward, back, score`` of one attempt at a round trip, in one visit to Python.

    The score is the chrF of the way back against the sentence.  It is null where a call fails or ``gate`` finds that
    the translation is not in the target language; then the way back is not asked for.
    """

    @F.pandas_udf(ATTEMPT_SCHEMA)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        settings = CallSettings(model_name, temperature)
        provider.open()
        try:
            for batch in batches:
                texts = batch.tolist()
                for a, b in portions((0 if t is None else len(t) for t in texts), PORTION):
                    made = _attempt(
                        provider, policy, texts[a:b], forward_system, backward_system, settings, gate, bare_chrf_scores
                    )
                    yield pd.DataFrame(dict(zip(("forward", "back", "score"), made)))
        finally:
            provider.close()

    return run.asNondeterministic()(sentence)


def try_attempts(
    provider: Provider,
    sentence: Column,
    forward_system: str,
    backward_system: str,
    model_name: str,
    temperatures: tuple[float, ...],
    scores: Scores,
    gate: Gate | None = None,
    policy: RetryPolicy = RetryPolicy(),
) -> Column:
    """Struct ``forward, back, score, attempt, temperature``: the best of a sentence's attempts at all temperatures.

    All of them are made, in one visit to Python, and scored against the sentence; an attempt that fails or does not
    pass ``gate`` does not count.  Of equal scores the first one stays, so other attempts never leave the task.  All
    fields are null where no attempt counts.
    """
    fields = ("forward", "back", "score", "attempt", "temperature")

    @F.pandas_udf(BEST_SCHEMA)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        settings = [CallSettings(model_name, t) for t in temperatures]
        provider.open()
        try:
            for batch in batches:
                texts = batch.tolist()
                for a, b in portions((0 if t is None else len(t) for t in texts), PORTION):
                    sentences, size = texts[a:b], b - a
                    forward, back = np.full(size, None, dtype=object), np.full(size, None, dtype=object)
                    score, attempt, degree = (np.full(size, np.nan) for _ in range(3))
                    known = None if gate is None else _remembering(gate)
                    for number, one in enumerate(settings):
                        there, returned, found = _attempt(
                            provider, policy, sentences, forward_system, backward_system, one, known, scores
                        )
                        better = ~np.isnan(found) & ~(found <= score)
                        forward[better], back[better], score[better] = there[better], returned[better], found[better]
                        attempt[better], degree[better] = number, one.temperature
                    attempt = pd.array(attempt, dtype="Int32")
                    yield pd.DataFrame(dict(zip(fields, (forward, back, score, attempt, degree))))
        finally:
            provider.close()

    return run.asNondeterministic()(sentence)


def _remembering(gate: Gate) -> Gate:
    """A gate that sees a text once; attempts at a sentence are often the same text."""
    seen: dict[str, bool] = {}

    def known(texts: pd.Series) -> np.ndarray:
        new = [text for text in dict.fromkeys(texts) if text not in seen]
        if new:
            seen.update(zip(new, gate(pd.Series(new, dtype=object)).tolist(), strict=True))
        return np.array([seen[text] for text in texts], dtype=bool)

    return known


def passes(gate: Gate, text: Column) -> Column:
    """A gate as a column."""

    @F.pandas_udf("boolean")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(gate(texts.fillna("")))

    return run(text)
