"""The provider hook: how a model is plugged in, and how its failures are retried."""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from lexiloom.functions.responses import ANSWER_LABEL, EMPTY, TRUNCATED

_LABEL = re.compile(ANSWER_LABEL.removeprefix("(?U)"))


@dataclass(frozen=True)
class CallSettings:
    """What a provider is told about one call besides its texts."""

    model_name: str
    temperature: float = 0.0
    max_tokens: int | None = None
    attempt: int = 1

    def __post_init__(self):
        if not 0.0 <= self.temperature <= 2.0:
            raise ValueError(f"temperature must lie between 0 and 2, got {self.temperature}")


class TruncatedOutput(ValueError):
    """The answer was cut off by the token limit; a larger limit may help."""


class Provider:
    """Base class of model providers.  Instances are pickled to the executors.

    ``open`` runs once per task before the first batch: connect or load weights there.  Override
    ``invoke`` for one call at a time, or ``invoke_many`` where the model takes whole batches.
    """

    name = "provider"

    def open(self) -> None:
        pass

    def close(self) -> None:
        pass

    def invoke(self, text: str, system: str, config: CallSettings) -> str:
        raise NotImplementedError

    def invoke_many(
        self, texts: list[str], systems: list[str], configs: list[CallSettings]
    ) -> list[str | Exception]:
        answers: list[str | Exception] = []
        for text, system, config in zip(texts, systems, configs):
            try:
                answers.append(self.invoke(text, system, config))
            except Exception as error:  # a failed row is data, not a failed task
                answers.append(error)
        return answers


@dataclass(frozen=True)
class RetryPolicy:
    """Attempts per token tier, waits between them, and errors that end a row at once."""

    attempts: int = 3
    delay: float = 5.0
    rate_limit_factor: int = 3
    tiers: tuple[int, ...] = (1,)
    tier_ceiling: int = 16384
    fatal: tuple[str, ...] = ("authentication", "invalid api key")
    sleep: Callable[[float], None] = time.sleep

    def budget(self, base: int | None, tier: int) -> int | None:
        return None if base is None else min(base * self.tiers[tier], self.tier_ceiling)


@dataclass(frozen=True)
class Step:
    """One prompt of a chain: templates over earlier columns, and the column the answer goes to."""

    out: str
    system: str
    text: str
    slots: dict[str, str] = field(default_factory=dict)
    temperature: float = 0.0


@dataclass(slots=True)
class Outcome:
    value: str | None = None
    error: str | None = None
    attempts: int = 0
    budget: int | None = None


def _settings(config: CallSettings, max_tokens: int | None, attempt: int) -> CallSettings:
    """``config`` itself where nothing changes, as in most first attempts."""
    if config.max_tokens == max_tokens and config.attempt == attempt:
        return config
    return replace(config, max_tokens=max_tokens, attempt=attempt)


def run_batch(
    provider: Provider, policy: RetryPolicy, texts: list[str], systems: list[str], configs: list[CallSettings]
) -> list[Outcome]:
    """Call a batch, retrying the rows that failed; every row ends with a value or an error."""
    outcomes: list[Outcome | None] = [None] * len(texts)
    tier, tries = [0] * len(texts), [0] * len(texts)
    pending = list(range(len(texts)))
    asked, told = list(texts), list(systems)
    calls = [c if c.max_tokens is None and c.attempt == 1 else _settings(c, policy.budget(c.max_tokens, 0), 1) for c in configs]
    while pending:
        try:
            answers = list(provider.invoke_many(asked, told, calls))
            if len(answers) != len(pending):
                raise ValueError(f"{len(answers)} answers to {len(pending)} texts")
        except Exception as problem:  # a failed batch is failed rows, which are data
            answers = [problem] * len(pending)
        again, wait = [], 0.0
        for i, call, answer in zip(pending, calls, answers, strict=True):
            outcome = outcomes[i]
            if outcome is None:
                outcome = outcomes[i] = Outcome()
            outcome.attempts += 1
            outcome.budget = call.max_tokens
            if not isinstance(answer, Exception):
                cleaned = (answer or "").strip()
                if label := _LABEL.match(cleaned):  # the pattern stands at the start only
                    cleaned = cleaned[label.end() :].strip()
                if cleaned:
                    outcome.value, outcome.error = cleaned, None
                    continue
                answer = ValueError(EMPTY)
            message = TRUNCATED if isinstance(answer, TruncatedOutput) else str(answer)
            outcome.error = message
            if any(mark in message.lower() for mark in policy.fatal):
                continue
            tries[i] += 1
            if isinstance(answer, TruncatedOutput) or tries[i] >= policy.attempts:
                if tier[i] + 1 >= len(policy.tiers):
                    continue
                tier[i], tries[i] = tier[i] + 1, 0
            else:
                factor = policy.rate_limit_factor if "rate" in message.lower() else 1
                wait = max(wait, policy.delay * tries[i] * factor)
            again.append(i)
        pending = again
        if pending:
            calls = [_settings(configs[i], policy.budget(configs[i].max_tokens, tier[i]), tries[i] + 1) for i in pending]
            asked, told = [texts[i] for i in pending], [systems[i] for i in pending]
        if pending and wait > 0:
            policy.sleep(wait)
    return outcomes
