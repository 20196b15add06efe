"""Deterministic providers for runs without a model, and the same rules as column expressions.

A real model is plugged in through ``Provider``.  These make a job's result a fixed function of its
input, so that jobs can be checked against plain expressions.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections import defaultdict
from functools import lru_cache
from itertools import chain

import numpy as np

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexiloom.functions.prompts import SUBSTITUTE_TEXT
from lexiloom.functions.text import split_words
from lexiloom.providers.base import CallSettings, Provider, TruncatedOutput

PLAIN = "abcdefghijklmnopqrstuvwxyz"
CODED = "bcdfghjklmnpqrstvwxyzaeiou"
_DIRECTION = re.compile(r"from (\S+) to ([^\s:.]+)")

_SUBSTITUTION = re.compile(
    re.escape(SUBSTITUTE_TEXT)
    .replace(r"\{replacement\}", "(.*?)")
    .replace(r"\{word\}", "(.*?)")
    .replace(r"\{sentence\}", "(.*)"),
    re.DOTALL,
)


def drop_below(tenths: int) -> str:
    """Words whose digest starts below this hex byte are dropped; the share grows with temperature."""
    return f"{8 + 4 * tenths:02x}"


_TO_CODED = bytes.maketrans(PLAIN.encode(), CODED.encode())
_TO_PLAIN = bytes.maketrans(CODED.encode(), PLAIN.encode())


@lru_cache(maxsize=256)
def _source(system: str) -> str | None:
    found = _DIRECTION.search(system)
    return None if found is None else found.group(1)


def digest(text: str) -> str:
    return hashlib.md5(text.encode("utf-8")).hexdigest()


def _recoded(text: str, table: bytes) -> str:
    """Letters replaced; they are single bytes of UTF-8, and no byte of another character looks like one."""
    return text.encode("utf-8", "surrogatepass").translate(table).decode("utf-8", "surrogatepass")


_SINES = [np.uint32(int(abs(math.sin(i + 1)) * 2**32)) for i in range(64)]
_TURNS = [7, 12, 17, 22] * 4 + [5, 9, 14, 20] * 4 + [4, 11, 16, 23] * 4 + [6, 10, 15, 21] * 4
_BLOCK, _ROOM = 64, 55  # bytes of a block of MD5, and of a message that needs no second one
DIGESTS = 1 << 14  # made together; their arrays stay in the processor's cache


def first_bytes(blocks: np.ndarray) -> np.ndarray:
    """First byte of the MD5 of messages that are one padded block each, a row of bytes."""
    words = np.ascontiguousarray(blocks.view("<u4").T)
    a, b, c, d = (np.full(len(blocks), start, np.uint32) for start in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476))
    for i in range(64):
        if i < 16:
            mixed, at = ((c ^ d) & b) ^ d, i
        elif i < 32:
            mixed, at = ((b ^ c) & d) ^ c, (5 * i + 1) % 16
        elif i < 48:
            mixed, at = b ^ c ^ d, (3 * i + 5) % 16
        else:
            mixed, at = (~d | b) ^ c, 7 * i % 16
        mixed += a
        mixed += _SINES[i]
        mixed += words[at]
        turned = mixed >> np.uint32(32 - _TURNS[i])
        mixed <<= np.uint32(_TURNS[i])
        mixed |= turned
        mixed += b
        a, b, c, d = d, mixed, b, c
    return (a + np.uint32(0x67452301)).astype(np.uint8)


def _digest_bytes(tenths: int, places: np.ndarray, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """First byte of ``digest(f"{tenths}|{place}|{word}")`` of words that are parts of UTF-8 bytes."""
    found = np.zeros(len(places), np.uint8)
    heads = [f"{tenths}|{place}|".encode() for place in range(int(places.max(initial=0)) + 1)]
    lead = np.array([len(head) for head in heads])
    table = np.zeros((len(heads), int(lead.max())), np.uint8)
    for row, head in zip(table, heads):
        row[: len(head)] = list(head)
    sizes, before = ends - starts, lead[places]
    for first in range(0, len(places), DIGESTS):
        part = np.flatnonzero((sizes + before)[first : first + DIGESTS] <= _ROOM) + first
        blocks = np.zeros((len(part), _BLOCK), np.uint8)
        blocks[:, : table.shape[1]] = table[places[part]]
        size, total = sizes[part], sizes[part] + before[part]
        row = np.arange(len(part)) * _BLOCK
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        blocks.reshape(-1)[np.repeat(row + before[part], size) + step] = text[np.repeat(starts[part], size) + step]
        blocks.reshape(-1)[row + total] = 0x80
        blocks.view("<u4")[:, 14] = 8 * total
        found[part] = first_bytes(blocks)
    for i in np.flatnonzero(sizes + before > _ROOM):
        found[i] = hashlib.md5(heads[places[i]] + text[starts[i] : ends[i]].tobytes()).digest()[0]
    return found


def _lossy(texts: list[str], tenths: int) -> list[str]:
    """Coded texts without the words that are lost at a temperature.  The first word of a text stays."""
    lists = [text.split() for text in texts]
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    if not counts.any():
        return [""] * len(texts)
    text = np.frombuffer((" ".join(chain.from_iterable(lists)) + " ").encode("utf-8"), np.uint8)
    ends = np.flatnonzero(text == ord(" "))
    starts = np.concatenate([[0], ends[:-1] + 1])
    places = np.arange(len(ends)) - np.repeat(np.cumsum(counts) - counts, counts)
    kept = (_digest_bytes(tenths, places, text, starts, ends) >= int(drop_below(tenths), 16)) | (places == 0)
    owner = np.repeat(np.arange(len(texts)), counts)[kept]
    marked = text.copy()
    marked[ends[kept][np.append(owner[1:] != owner[:-1], True)]] = ord("\n")  # no word has a line end
    rest = iter(marked[np.repeat(kept, ends - starts + 1)].tobytes().translate(_TO_CODED).decode("utf-8").split("\n"))
    return [next(rest) if count else "" for count in counts.tolist()]


def _plain(texts: list[str]) -> list[str]:
    """Texts with their letters back."""
    joined = "\0".join(texts)
    if joined.count("\0") >= len(texts):
        return [_recoded(text, _TO_PLAIN) for text in texts]
    return _recoded(joined, _TO_PLAIN).split("\0")


class CipherProvider(Provider):
    """Substitutes letters on the way out of ``home`` and back; loses some words on the way out."""

    name = "cipher"

    def __init__(self, home: str):
        self.home = home

    def invoke(self, text: str, system: str, config: CallSettings) -> str:
        if _source(system) in (None, self.home):
            tenths = round(config.temperature * 10)
            limit = drop_below(tenths)
            kept = [
                word
                for i, word in enumerate(text.split())
                if i == 0 or digest(f"{tenths}|{i}|{word}") >= limit
            ]
            return _recoded(" ".join(kept), _TO_CODED)
        return _recoded(text, _TO_PLAIN)

    def invoke_many(self, texts, systems, configs):
        """The same answers for all texts of a system and temperature together."""
        rows_of, answers = defaultdict(list), [""] * len(texts)
        for i, (system, config) in enumerate(zip(systems, configs, strict=True)):
            rows_of[system, config.temperature].append(i)
        try:
            for (system, temperature), rows in rows_of.items():
                asked = [texts[i] for i in rows]
                out = _source(system) in (None, self.home)
                for i, answer in zip(rows, _lossy(asked, round(temperature * 10)) if out else _plain(asked), strict=True):
                    answers[i] = answer
        except (UnicodeError, AttributeError):  # one text that is none fails alone
            return super().invoke_many(texts, systems, configs)
        return answers


def cipher_forward(text: Column, tenths: int) -> Column:
    """What ``CipherProvider`` answers on the way out, as an expression."""
    limit = drop_below(tenths)
    kept = F.filter(
        split_words(text),
        lambda word, i: (i == 0) | (F.md5(F.concat(F.lit(f"{tenths}|"), i.cast("string"), F.lit("|"), word)) >= limit),
    )
    return F.translate(F.array_join(kept, " "), PLAIN, CODED)


def cipher_backward(text: Column) -> Column:
    return F.translate(text, CODED, PLAIN)


class FlakyProvider(Provider):
    """Fails in a fixed way that depends on the text, to exercise the retry policy."""

    name = "flaky"

    def __init__(self, inner: Provider):
        self.inner = inner

    def invoke(self, text: str, system: str, config: CallSettings) -> str:
        kind = digest(text)[0]
        if kind == "0":
            raise RuntimeError("authentication rejected")
        if kind in "12" and config.attempt == 1:
            raise RuntimeError("rate limit reached")
        if kind in "34" and config.attempt <= 2:
            return " "
        if kind in "56" and (config.max_tokens or 0) < 2048:
            raise TruncatedOutput("cut off")
        if kind == "7":
            raise RuntimeError("connection lost")
        return self.inner.invoke(text, system, config)


class WordsmithProvider(Provider):
    """Plays every step of the word-to-sentence chain by simple rules."""

    name = "wordsmith"

    def invoke(self, text: str, system: str, config: CallSettings) -> str:
        if system.startswith("Give one simple"):
            if digest(text)[0] == "0":
                raise RuntimeError("no synonym found")
            return f"{text} kind"
        if system.startswith("Write one"):
            return f"Here is {text} today."
        if system.startswith("Replace the original"):
            replacement, word, sentence = _SUBSTITUTION.fullmatch(text).groups()
            return sentence.replace(word, replacement)
        if "evaluator" in system:
            score = int(digest(text)[:2], 16) % 41 / 10 + 1
            return "```json\n" + json.dumps({"score": score, "reasoning": "rated"}) + "\n```"
        return text.translate(str.maketrans(PLAIN, CODED))
