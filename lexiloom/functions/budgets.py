"""How many output tokens a model call may use, from the length of its input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexiloom.functions.text import word_count

# Fixed values of the budget estimate.
TOKENS_PER_WORD = 1.3
OUTPUT_AND_THINKING = 3.5
SAFETY = 1.5
STEP = 512
CEILING = 16384
TIER_FACTORS = (1, 2, 4)


def token_budget(text: Column) -> Column:
    """Budget in steps of 512, between 512 and 16384."""
    raw = word_count(text) * F.lit(TOKENS_PER_WORD) * F.lit(OUTPUT_AND_THINKING) * F.lit(SAFETY)
    stepped = F.floor((raw + F.lit(STEP - 1)) / F.lit(STEP)) * F.lit(STEP)
    return F.least(F.greatest(stepped, F.lit(STEP).cast("long")), F.lit(CEILING).cast("long"))


def budget_tiers(budget: Column) -> Column:
    """Growing budgets to try when an answer is cut off, each capped at the ceiling."""
    factors = F.array(*[F.lit(f).cast("long") for f in TIER_FACTORS])
    return F.transform(factors, lambda f: F.least(f * budget, F.lit(CEILING).cast("long")))


def batch_cap(length: Column, batch_keys: list[str], max_new_tokens: int) -> Column:
    """Generation cap of a batch: twice its longest input, at most ``max_new_tokens``.

    Batches have a fixed row count, so the window's groups are bounded by the batch size.
    """
    longest = F.max(length).over(Window.partitionBy(*batch_keys))
    return F.least(F.lit(max_new_tokens), longest * 2)
