"""Prompt templates and their rendering on columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

TRANSLATE_TEXT = (
    "Please translate this text from {src_lang} to {tgt_lang}. Answer with the translation alone, "
    "without labels or comments.\n\nText: {sentence}\n\nTranslation:"
)
TRANSLATE_SYSTEM = (
    "You translate from {src_lang} to {tgt_lang}. Answer with the translated text alone: "
    "no explanation, no introduction, no reasoning and no quotation marks."
)
DESCRIBE_SYSTEM = (
    "Give one simple, common synonym or a short phrase of at most four words that can stand in for the "
    "given word in a sentence. Answer with the word or phrase alone."
)
SENTENCE_SYSTEM = (
    "Write one clear, natural sentence that uses the given word meaningfully. Answer with the sentence alone."
)
SIMPLE_SENTENCE_SYSTEM = (
    "Write one short sentence of fewer than fifteen everyday words that uses the given word, in the active "
    "voice and without idioms or names. Answer with the sentence alone."
)
SUBSTITUTE_SYSTEM = (
    "Replace the original word by the replacement word everywhere in the sentence and keep the grammar "
    "right. Answer with the corrected sentence alone."
)
SUBSTITUTE_TEXT = "In the sentence below, put \"{replacement}\" where it says \"{word}\".\n\n{sentence}"
ANCHORED_SYSTEM = (
    "Translate the sentence from {src_lang} to {tgt_lang}. \"{term}\" is already translated as "
    "\"{term_translation}\"; use that translation wherever \"{term}\" appears. "
    "Answer with the translated sentence alone."
)
WORD_IN_CONTEXT_SYSTEM = (
    "Translate the sentence from {src_lang} to {tgt_lang}. Its key word is \"{word}\"; where {tgt_lang} has "
    "no natural equivalent, use the simplest phrase of at most four words. "
    "Answer with the translated sentence alone."
)
JUDGE_SYSTEM = (
    "You are a strict evaluator of translations from {src_lang} to {tgt_lang}. Rate fluency, adequacy and "
    "consistency from 1 to 5 and give their mean as score. Answer only with a JSON object: "
    '{"score": <float>, "fluency": <float>, "adequacy": <float>, "consistency": <float>, '
    '"reasoning": "<one sentence>"}'
)
JUDGE_TEXT = "Source: {source}\nTranslation: {translation}"


def render(template: str | Column, **values: str | Column) -> Column:
    """Fill ``{name}`` slots of a template.

    The template is cut at its slots before anything is filled in, so braces inside the values are
    never read as slots; unnamed braces in the template stay as they are.
    """
    if isinstance(template, Column):
        rendered = template
        for name, value in values.items():
            rendered = F.replace(rendered, F.lit("{" + name + "}"), _column(value))
        return rendered
    pieces: list[Column] = []
    rest = template
    while True:
        hits = [(rest.find("{" + n + "}"), n) for n in values if "{" + n + "}" in rest]
        if not hits:
            break
        at, name = min(hits)
        pieces.append(F.lit(rest[:at]))
        pieces.append(_column(values[name]))
        rest = rest[at + len(name) + 2 :]
    pieces.append(F.lit(rest))
    return F.concat(*pieces)


def fill(template: str, values: dict[str, str]) -> str:
    """The same filling for one prompt inside a task: one pass, so filled-in text is not read again."""
    if not values:
        return template
    slot = re.compile("|".join(re.escape("{" + name + "}") for name in values))
    return slot.sub(lambda found: values[found.group()[1:-1]], template)


def _column(value: str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
