"""Byte-level BPE over Arrow batches: texts to token ids with character offsets, and back.

The ``tokenizers`` library works on a printable alphabet with one character per byte.  A rank table (token
bytes and rank, one pair a line) becomes its vocabulary, and every way to cut a token into two others becomes
a merge with that token's rank, so merges happen in the order of the ranks.

A text is first cut where no match of a split pattern of this family can span; equal pieces are encoded once
per worker and looked up after that.  The memo is emptied when it reaches ``MEMO`` pieces, so memory does not
grow with the input.

Decoding looks bytes up by id and decodes UTF-8 only after all tokens of a text are joined, so characters
split over several tokens come out whole.

Defined results: null text is an empty text with no ids; an id outside the vocabulary raises; null ids decode
to no bytes; columns of the input that have the name of an output column are replaced by it.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEMO = 300_000
SLICE_CHARS = 2_000_000  # text characters per yielded batch


def byte_alphabet() -> list[str]:
    """Character of each byte: printable Latin-1 bytes stand for themselves, the others for U+0100 onwards."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(byte) if byte in kept else chr(next(spare)) for byte in range(256)]


class Codec:
    def __init__(self, ranks_path: str, pattern: str):
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        with open(ranks_path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        alphabet = byte_alphabet()

        def spelled(token: bytes) -> str:
            return "".join(alphabet[byte] for byte in token)

        merges = [
            (spelled(token[:cut]), spelled(token[cut:]))
            for token in sorted(ranks, key=ranks.get)
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        vocabulary = {spelled(token): rank for token, rank in ranks.items()}
        self.tokenizer = Tokenizer(models.BPE(vocab=vocabulary, merges=merges, ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.Split(Regex(pattern), "removed", invert=True),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        self.model = self.tokenizer.model
        self.spelling = dict(enumerate(alphabet))
        # The reverse table comes from the library's own spelling of each id.
        byte_of = {ord(character): byte for byte, character in enumerate(alphabet)}
        self.bytes_of = {
            rank: bytes(byte_of[ord(character)] for character in self.tokenizer.id_to_token(rank))
            for rank in ranks.values()
        }
        size = max(self.bytes_of, default=-1) + 1
        self.lengths = np.zeros(size, np.int64)
        for rank, token in self.bytes_of.items():
            self.lengths[rank] = len(token)
        self.memo: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [pieces(text) for text in texts]
        memo = self.memo
        new = list({piece for parts in cut for piece in parts if piece not in memo})
        if len(memo) + len(new) > MEMO:
            memo.clear()
            new = list({piece for parts in cut for piece in parts})
        mixed = []
        for piece in new:
            if _SINGLE.fullmatch(piece):  # one match of the pattern: straight to the model
                spelled = piece.encode("utf-8").decode("latin-1").translate(self.spelling)
                memo[piece] = array("I", [token.id for token in self.model.tokenize(spelled)]).tobytes()
            else:
                mixed.append(piece)
        encoded = self.tokenizer.encode_batch_fast(mixed, add_special_tokens=False)
        for piece, encoding in zip(mixed, encoded, strict=True):
            memo[piece] = array("I", encoding.ids).tobytes()
        return [b"".join(map(memo.__getitem__, parts)) for parts in cut]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character of each token and the one after its last; tokens that share a character overlap.

        Exact where the split pattern covers the whole text, as patterns of byte-level models do.
        """
        raw = np.frombuffer(text.encode("utf-8"), np.uint8)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1  # character of each byte
        ends = np.cumsum(self.lengths[ids])
        starts = ends - self.lengths[ids]
        return character[starts], character[ends - 1] + 1


# Unicode white space, and letters of whose class no Unicode version disagrees.
_BLANK = " \\t\\n\\x0b\\x0c\\r\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_PIECE = re.compile(
    f" ?[{_LETTER}]+(?=[,. \\n])|[,.]+(?=[ \\n])|\\n(?=[^{_BLANK}])|[{_BLANK}]*[^{_BLANK}]+|[{_BLANK}]+"
)
_SINGLE = re.compile(f" ?[{_LETTER}]+")


def pieces(text: str) -> list[str]:
    """The text cut where no match of the split pattern can span: before white space, after a line end, and
    between a letter and a comma or full stop.
    """
    return _PIECE.findall(text)


@lru_cache(maxsize=4)
def codec(ranks_path: str, pattern: str) -> Codec:
    """One codec per Python worker."""
    return Codec(ranks_path, pattern)


def _slices(lengths: list[int]) -> Iterator[tuple[int, int]]:
    start = chars = 0
    for end, length in enumerate(lengths):
        if chars and chars + length > SLICE_CHARS:
            yield start, end
            start, chars = end, 0
        chars += length
    if start < len(lengths):
        yield start, len(lengths)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays).astype(np.int32)))


def encode(
    df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: bool = True, offsets: bool = False,
    digests: bool = False,
) -> DataFrame:
    """All columns of ``df`` with ``n_tokens`` and, as asked for, ``ids``, ``starts`` and ``ends`` (character
    offsets of each token), and SHA-256 digests of the ids and of the decoded bytes.

    The digests are of ids as little-endian 32-bit integers; the bytes are decoded from the ids.
    """
    added = {"n_tokens": "long"}
    added |= {"ids": "array<int>"} if ids else {}
    added |= {"starts": "array<int>", "ends": "array<int>"} if offsets else {}
    added |= {"ids_sha256": "string", "decoded_sha256": "string"} if digests else {}
    kept = [c for c in df.columns if c not in added]
    source = df.select(*kept, F.col(text).alias("_bpe_text"))

    def run(batches):
        one = codec(ranks_path, pattern)
        for batch in batches:
            column = batch.column(len(kept))
            rest = batch.select(range(len(kept)))
            lengths = [n or 0 for n in pa.compute.utf8_length(column).to_pylist()]
            for start, end in _slices(lengths):
                texts = [value or "" for value in column.slice(start, end - start).to_pylist()]
                packed = one.encode(texts)
                numbers = [np.frombuffer(p, "<u4") for p in packed]
                out = {"n_tokens": pa.array([len(n) for n in numbers], pa.int64())}
                if ids:
                    out["ids"] = _lists(numbers)
                if offsets:
                    spans = [one.offsets(t, n) for t, n in zip(texts, numbers, strict=True)]
                    out |= {"starts": _lists([s for s, _ in spans]), "ends": _lists([e for _, e in spans])}
                if digests:
                    out["ids_sha256"] = pa.array([sha256(p).hexdigest() for p in packed])
                    out["decoded_sha256"] = pa.array([sha256(one.decode(n)).hexdigest() for n in numbers])
                part = rest.slice(start, end - start)
                yield pa.RecordBatch.from_arrays([*part.columns, *out.values()], names=[*kept, *out])

    fields = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
        + [f"{n} {t}" for n, t in added.items()]
    )
    return source.mapInArrow(run, fields)


def decode(df: DataFrame, ranks_path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """All columns of ``df`` with ``decoded`` (bytes) and ``decoded_text``.

    Bytes that are not UTF-8 as a whole, such as those of a list of ids that ends inside a character, become
    U+FFFD in the text; the bytes are exact.
    """
    kept = [c for c in df.columns if c not in ("decoded", "decoded_text")]
    source = df.select(*kept, F.col(ids).alias("_bpe_ids"))

    def run(batches):
        one = codec(ranks_path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                raw = [one.decode(np.asarray(x or [], np.int64)) for x in part.column(len(kept)).to_pylist()]
                texts = [r.decode("utf-8", "replace") for r in raw]
                columns = [*part.columns[:-1], pa.array(raw, pa.binary()), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "decoded", "decoded_text"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    return source.mapInArrow(run, f"{fields}, decoded binary, decoded_text string")
