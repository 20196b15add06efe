"""Language names, codes, pairs and the routing rules that depend on them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Language:
    key: str
    name: str
    script_code: str
    iso_code: str


@dataclass(frozen=True)
class LanguagePair:
    """Two languages that are translated into each other."""

    first: Language
    second: Language

    @property
    def members(self) -> tuple[Language, Language]:
        return (self.first, self.second)

    def keys(self) -> list[str]:
        return [m.key for m in self.members]

    def is_member(self, language: Column) -> Column:
        """True where the language belongs to the pair; a null language does not."""
        return F.coalesce(F.lower(language).isin(self.keys()), F.lit(False))

    def _lookup(self, language: Column, values: dict[str, str]) -> Column:
        entries = [F.lit(v) for item in values.items() for v in item]
        return F.try_element_at(F.create_map(*entries), F.lower(language))

    def target(self, language: Column) -> Column:
        a, b = self.members
        return self._lookup(language, {a.key: b.key, b.key: a.key})

    def name(self, language: Column) -> Column:
        return self._lookup(language, {m.key: m.name for m in self.members})

    def script_code(self, language: Column) -> Column:
        return self._lookup(language, {m.key: m.script_code for m in self.members})

    def iso_code(self, language: Column) -> Column:
        return self._lookup(language, {m.key: m.iso_code for m in self.members})


# Names and codes of the default pair.
ENGLISH = Language("english", "English", "eng_Latn", "en")
KINYARWANDA = Language("kinyarwanda", "Kinyarwanda", "kin_Latn", "rw")
DEFAULT_PAIR = LanguagePair(ENGLISH, KINYARWANDA)

# Spellings under which the second language is named when a scorer is chosen.
KINYARWANDA_NAMES = ("kin", "rw", "kinyarwanda")


def display_name(language: Column) -> Column:
    """First letter upper, the rest lower."""
    return F.concat(F.upper(F.substring(language, 1, 1)), F.lower(F.substr(language, F.lit(2))))


def backend_for(model_name: Column) -> Column:
    """Which batch backend serves a model."""
    return F.when(F.lower(model_name).contains("translategemma"), F.lit("chat")).otherwise(F.lit("seq2seq"))


def routed_temperature(model_name: Column, temperature: Column) -> Column:
    """Models of the ``-5`` family only accept temperature 1."""
    return F.when(model_name.contains("-5"), F.lit(1.0)).otherwise(temperature)


def scorer_for(language: Column) -> Column:
    """Name of the quality scorer tuned for a language."""
    low_resource = F.coalesce(F.lower(language).isin(*KINYARWANDA_NAMES), F.lit(False))
    return F.when(low_resource, F.lit("low_resource")).otherwise(F.lit("general"))


def direction_of_file(path: Column) -> Column:
    """``results/en-rw.csv`` -> ``en->rw``."""
    stem = F.regexp_extract(path, r"([^/.]*)[^/]*$", 1)
    return F.replace(stem, F.lit("-"), F.lit("->"))


def direction(source: Column, target: Column) -> Column:
    return F.concat(source, F.lit("->"), target)
