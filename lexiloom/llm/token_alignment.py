"""Alignment of two tokenizers by an associative composition of fragments.

Both tokenizers cut the same bytes, a space and the text.  Where a token of each ends, a group ends.  The tokens that
end in a byte range make a fragment: an open prefix up to the first common end, closed groups, and an open suffix
after the last common end (or open tokens alone, where the range has no common end).  Fragments compose:
what is open on both sides of a joint closes to a group.  The composition is associative, so

* a text of up to ``CHUNK`` bytes is one range;
* a longer one is cut in byte ranges at any place, characters and tokens included; their fragments are made in different
  tasks and composed in a tree, ``FAN`` neighbours at a time.

No token of either tokenizer spans a blank between two visible characters, so the stretches between such blanks are
encoded and grouped alone, and equal ones once per worker; a byte range is encoded from the stretches that cover it.

Links are pairs of tokens that end together.  The bytes of one are then the end of the other's, so the two
vocabularies alone bound the pairs that can occur (about half a million); counts of pairs over the corpus are summed in
an array of that size per task, joined by pair, and broadcast under that bound.

Defined results: texts that are null, empty or that either tokenizer does not give back byte by byte have no tokens, all
numbers 0 and no groups; repeated rows count twice; the id is copied as it is and never a key; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.byte_bpe import byte_alphabet
from lexiloom.llm.scratch import stored

CHUNK = 1 << 16
FAN = 16
MEMO = 120_000  # stretches whose groups a worker keeps, twice
TOGETHER = 64  # stretches encoded in one text
MEMO_CHARS = 64
SLICE = 1 << 19  # bytes of texts worked on together

_HALF = 31  # two numbers of tokens in one whole number

# A blank between characters that no tokenizer takes for white space; what is left out here only makes stretches longer.
_HIDDEN = r"\s\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u2581\u3000\ufeff"
STRETCH = re.compile(rf"(?<=[^{_HIDDEN}]) (?=[^{_HIDDEN}])")


_UNSAFE = re.compile(rf" (?:(?=[{_HIDDEN}])|(?<=[{_HIDDEN}] ))")


def stretches_of(text: str) -> list[str]:
    if text[:1] == " " or text[-1:] == " " or _UNSAFE.search(text):
        return STRETCH.split(text)
    return text.split(" ")  # the same, and faster, where all blanks part stretches


@lru_cache(maxsize=1 << 16)
def visible(character: str) -> bool:
    return re.match(f"[^{_HIDDEN}]", character) is not None


@dataclass
class Fragment:
    """Tokens that end in one byte range.  Without a common end (``closed`` is None) all of them are in the prefix."""

    prefix: tuple[list[int], list[int]] = field(default_factory=lambda: ([], []))
    closed: list[str] | None = None
    suffix: tuple[list[int], list[int]] = field(default_factory=lambda: ([], []))
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0  # common ends
    links: list[np.ndarray] = field(default_factory=list)
    valid: bool = True


def spelled(a: list[int], b: list[int]) -> str:
    return f"{','.join(map(str, a))}|{','.join(map(str, b))}"


def compose(left: Fragment, right: Fragment) -> Fragment:
    out = Fragment(
        n_a=left.n_a + right.n_a,
        n_b=left.n_b + right.n_b,
        n_groups=left.n_groups + right.n_groups,
        links=left.links + right.links,
        valid=left.valid and right.valid,
    )
    if left.closed is None:
        joined = (left.prefix[0] + right.prefix[0], left.prefix[1] + right.prefix[1])
        out.prefix, out.closed, out.suffix = joined, right.closed, right.suffix
        return out
    out.prefix = left.prefix
    joined = (left.suffix[0] + right.prefix[0], left.suffix[1] + right.prefix[1])
    if right.closed is None:
        out.closed, out.suffix = left.closed, joined
    else:
        out.closed, out.suffix = [*left.closed, spelled(*joined), *right.closed], right.suffix
    return out


def compose_all(fragments: list[Fragment]) -> Fragment:
    """The composition of many neighbours, halves first."""
    if not fragments:
        return Fragment()
    while len(fragments) > 1:
        pairs = [compose(x, y) for x, y in zip(fragments[::2], fragments[1::2])]
        fragments = pairs + fragments[2 * len(pairs) :]
    return fragments[0]


def groups_of(whole: Fragment) -> str:
    """All groups of a text; its end is a common end."""
    return ";".join([spelled(*whole.prefix), *whole.closed]) if whole.closed is not None else ""


class Aligner:
    """Two tokenizers, the bytes of their tokens, and the pairs of tokens that can end together."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of = {character: byte for byte, character in enumerate(byte_alphabet())}
        with open(a_path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        self.a_bytes = {i: bytes(byte_of[c] for c in token) for token, i in vocabulary.items() if set(token) <= byte_of.keys()}
        self.b_bytes = {}
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.b_bytes[i] = bytes([int(piece[1:-1], 16)])
            else:  # control and unknown pieces give nothing back
                self.b_bytes[i] = b"" if self.b.is_control(i) or self.b.is_unknown(i) else piece.replace("▁", " ").encode()
        self.width = self.b.get_piece_size()
        self.a_size = np.zeros(max(self.a_bytes) + 1, np.int64)
        self.a_size[list(self.a_bytes)] = [len(x) for x in self.a_bytes.values()]
        self.b_size = np.array([len(self.b_bytes[i]) for i in range(self.width)], np.int64)
        self.ids = max(len(self.a_size), self.width)
        self.names = [f"{i}{mark}" for mark in ",|;" for i in range(self.ids)]
        self.pairs = self._pairs()
        self.memo: dict[str, tuple[int, str, bytes] | None] = {}
        self.older: dict[str, tuple[int, str, bytes] | None] = {}

    def _pairs(self) -> np.ndarray:
        a_of: dict[bytes, list[int]] = {}
        b_of: dict[bytes, list[int]] = {}
        for table, of in ((self.a_bytes, a_of), (self.b_bytes, b_of)):
            for i, token in table.items():
                if token:
                    of.setdefault(token, []).append(i)
        found = {
            a * self.width + b
            for token, ids in a_of.items()
            for cut in range(len(token))
            for b in b_of.get(token[cut:], ())
            for a in ids
        }
        found |= {
            a * self.width + b
            for token, ids in b_of.items()
            for cut in range(len(token))
            for a in a_of.get(token[cut:], ())
            for b in ids
        }
        return np.array(sorted(found), np.int64)

    def encoded(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both tokenizers over a space and each stretch, with their numbers, and which stretches both give back.

        For A, which spends more on a text than on its tokens, stretches that start and end visibly are encoded many in
        a text; its tokens give all bytes back, so the places of the bytes tell those of the stretches.
        """
        texts, several = [], []
        for s in stretches:
            if visible(s[:1]) and visible(s[-1:]):
                several.append(s)
                if len(several) < TOGETHER:
                    continue
                s = None
            if several:
                texts.append(" " + " ".join(several))
                several = []
            if s is not None:
                texts.append(" " + s)
        if several:
            texts.append(" " + " ".join(several))
        encodings = self.a.encode_batch_fast(texts, add_special_tokens=False)
        a = np.array([*chain.from_iterable([e.ids for e in encodings])], np.int32)
        seconds = self.b.encode(stretches, num_threads=1)
        flat = [*chain.from_iterable(seconds)]
        b, n_b = np.array(flat, np.int32), np.array([len(x) for x in seconds], np.int64)
        raws = [(" " + s).encode() for s in stretches]
        sizes = np.array([len(r) for r in raws], np.int64)
        a_ends = np.searchsorted(np.cumsum(self.a_size[a]), np.cumsum(sizes)) + 1
        b_ends = np.concatenate([[0], np.cumsum(self.b_size[b])])[np.concatenate([[0], np.cumsum(n_b)])]
        valid = np.ones(len(stretches), bool)
        if (np.diff(b_ends) != sizes).any() or b"".join(map(self.b_bytes.__getitem__, flat)) != b"".join(raws):
            valid[:] = [b"".join(map(self.b_bytes.__getitem__, x)) == raw for x, raw in zip(seconds, raws, strict=True)]
        return a, np.diff(a_ends, prepend=0), b, n_b, valid

    def learn(self, stretches: list[str]) -> None:
        """Numbers, groups and links of stretches, each of which starts and ends at a common end; None if not given back."""
        a, n_a, b, n_b, valid = self.encoded(stretches)
        if not valid.all():
            a, b = a[np.repeat(valid, n_a)], b[np.repeat(valid, n_b)]
        n_a, n_b = n_a[valid], n_b[valid]
        a_last, b_last, links = self.groups(a, b, np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]))
        names, stops = self.spell(a, b, a_last, b_last)
        ends = np.concatenate([[0], np.cumsum(a_last)])[np.concatenate([[0], np.cumsum(n_a)])]  # groups up to each stretch
        cuts = np.concatenate([[0], stops])[ends].tolist()
        raw, ends = links.astype(np.uint32).tobytes(), (4 * ends).tolist()
        numbers = (n_a + (n_b << _HALF)).tolist()
        at = 0
        for s, good in zip(stretches, valid.tolist(), strict=True):
            if good:
                text = "".join(names[cuts[at] : cuts[at + 1]])[:-1]
                self.memo[s] = (numbers[at], text, raw[ends[at] : ends[at + 1]])
                at += 1
            else:
                self.memo[s] = None

    def groups(self, a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """Whether each token ends a group, both ways, and ranks of the linked pairs.  The last tokens end together."""
        if not len(a):
            return np.zeros(0, bool), np.zeros(0, bool), np.zeros(0, np.int64)
        a_last = b_ends[np.minimum(np.searchsorted(b_ends, a_ends), len(b_ends) - 1)] == a_ends
        b_last = a_ends[np.minimum(np.searchsorted(a_ends, b_ends), len(a_ends) - 1)] == b_ends
        return a_last, b_last, np.searchsorted(self.pairs, a[a_last].astype(np.int64) * self.width + b[b_last])

    def spell(self, a: np.ndarray, b: np.ndarray, a_last: np.ndarray, b_last: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Ids in the order of the groups, each with the mark that follows it, and where each group ends."""
        a_stop, b_stop = np.flatnonzero(a_last) + 1, np.flatnonzero(b_last) + 1
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.concatenate([[0], b_stop])[a_group]] = a + self.ids * a_last
        order[np.arange(len(b)) + a_stop[b_group]] = b + 2 * self.ids * b_last
        return list(map(self.names.__getitem__, order.tolist())), a_stop + b_stop

    def whole(self, texts: list[str]) -> Iterator[tuple[int, int, int, str, np.ndarray] | None]:
        """Numbers, groups and links of whole texts; None for one that a tokenizer does not give back."""
        cut = [stretches_of(t) for t in texts]
        if len(self.memo) > MEMO:  # what is asked for again comes back from the older half
            self.older, self.memo = self.memo, {}
        memo = self.memo
        unseen = {s for stretches in cut for s in stretches if s not in memo}
        memo |= {s: self.older[s] for s in unseen if s in self.older}
        new = [s for s in unseen if s not in memo]
        if new:
            self.learn(new)
        for stretches in cut:
            parts = [memo[s] for s in stretches]
            if None in parts:
                yield None
                continue
            numbers, groups, ranks = zip(*parts, strict=True)
            total, links = sum(numbers), np.frombuffer(b"".join(ranks), np.uint32)
            yield total & ((1 << _HALF) - 1), total >> _HALF, len(links), ";".join(groups), links
        for s in new:
            if len(s) > MEMO_CHARS:
                del memo[s]

    def ranged(self, text: str, offset: int, low: int, high: int) -> Fragment:
        """The fragment of a byte range (``low``, ``high``], from stretches that cover it; the first starts at ``offset``."""
        a, _, b, _, valid = self.encoded(stretches_of(text))
        if not valid.all():
            return Fragment(valid=False)
        a_ends, b_ends = offset + np.cumsum(self.a_size[a]), offset + np.cumsum(self.b_size[b])
        a_in, b_in = (a_ends > low) & (a_ends <= high), (b_ends > low) & (b_ends <= high)
        a, b, a_ends, b_ends = a[a_in], b[b_in], a_ends[a_in], b_ends[b_in]
        out = Fragment(n_a=len(a), n_b=len(b))
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        if not len(common):
            out.prefix = (a.tolist(), b.tolist())
            return out
        cuts = [np.searchsorted(ends, (common[0], common[-1]), "right") for ends in (a_ends, b_ends)]
        out.prefix = (a[: cuts[0][0]].tolist(), b[: cuts[1][0]].tolist())
        out.suffix = (a[cuts[0][1] :].tolist(), b[cuts[1][1] :].tolist())
        to_a, to_b = slice(0, cuts[0][1]), slice(0, cuts[1][1])
        a_last, b_last, links = self.groups(a[to_a], b[to_b], a_ends[to_a], b_ends[to_b])
        names, stops = self.spell(a[to_a], b[to_b], a_last, b_last)
        inner = "".join(names[stops[0] :])[:-1]
        out.closed, out.n_groups, out.links = [inner] if inner else [], len(common), [links]
        return out


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def pack_links(links: np.ndarray) -> bytes:
    """Ranks of pairs in order, as differences by byte place."""
    if not len(links):
        return b""
    gaps = np.diff(np.sort(links.astype(np.uint32)), prepend=np.uint32(0)).astype("<u4")
    return zstandard.ZstdCompressor(level=3).compress(gaps.view(np.uint8).reshape(-1, 4).T.tobytes())


def unpack_links(packed: bytes) -> np.ndarray:
    if not packed:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64))


ROWS = "n_a long, n_b long, n_groups long, groups string, links binary"
_PART = "row long, chunk int, chunks int, offset long, low long, high long, part string"
_FRAGMENT = (
    "row long, chunk int, chunks int, valid boolean, bounded boolean, prefix_a array<int>, prefix_b array<int>, "
    "closed string, suffix_a array<int>, suffix_b array<int>, n_a long, n_b long, n_groups long, links binary"
)
_FRAGMENT_ARROW = pa.schema(
    [
        ("row", pa.int64()), ("chunk", pa.int32()), ("chunks", pa.int32()), ("valid", pa.bool_()), ("bounded", pa.bool_()),
        ("prefix_a", pa.list_(pa.int32())), ("prefix_b", pa.list_(pa.int32())), ("closed", pa.string()),
        ("suffix_a", pa.list_(pa.int32())), ("suffix_b", pa.list_(pa.int32())),
        ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("links", pa.binary()),
    ]
)


def _as_row(f: Fragment) -> tuple:
    closed = None if f.closed is None else ";".join(f.closed)
    links = np.concatenate([np.zeros(0, np.uint32), *f.links]).astype(np.uint32).tobytes()
    return (f.valid, f.closed is not None, *f.prefix, closed, *f.suffix, f.n_a, f.n_b, f.n_groups, links)


def _of_row(row: dict) -> Fragment:
    closed = None if not row["bounded"] else [row["closed"]] if row["closed"] else []
    return Fragment(
        (row["prefix_a"], row["prefix_b"]), closed, (row["suffix_a"], row["suffix_b"]), row["n_a"], row["n_b"],
        row["n_groups"], [np.frombuffer(row["links"], np.uint32)], row["valid"],
    )


def chunk_ranges(text: str, size: int) -> Iterator[tuple[int, int, int, int, int, str]]:
    """Byte ranges of a space and a text, each with the stretches that cover it: (chunk, chunks, offset, low, high, part)."""
    stretches = stretches_of(text)
    ends = np.cumsum([1 + len(s.encode()) for s in stretches])
    chunks = -(-int(ends[-1]) // size)
    for chunk in range(chunks):
        low, high = chunk * size, min((chunk + 1) * size, int(ends[-1]))
        first, last = int(np.searchsorted(ends, low, "right")), int(np.searchsorted(ends, high, "left"))
        offset = int(ends[first - 1]) if first else 0
        yield chunk, chunks, offset, low, high, " ".join(stretches[first : last + 1])


def _chunks(batches: Iterator[pa.RecordBatch], size: int, key: pa.DataType) -> Iterator[pa.RecordBatch]:
    kinds = [key, pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    names = ["_id", "row", "chunk", "chunks", "offset", "low", "high", "part"]
    for batch in batches:
        for id_, row, text in zip(batch["_id"], batch["_row"], batch["_text"], strict=True):
            for part in chunk_ranges(text.as_py(), size):
                columns = [id_.as_py(), row.as_py(), *part]
                yield pa.record_batch([pa.array([x], k) for x, k in zip(columns, kinds, strict=True)], names=names)


def tree(fragments: DataFrame, key: str) -> DataFrame:
    """One fragment per ``row``: ``FAN`` neighbours compose to one in each round."""

    def join(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
        whole = compose_all([_of_row(r) for r in rows])
        head = (rows[0]["_id"], rows[0]["row"], rows[0]["chunk"] // FAN, -(-rows[0]["chunks"] // FAN))
        schema = pa.schema([table.schema.field("_id"), *_FRAGMENT_ARROW])
        return pa.table([pa.array([x], f.type) for x, f in zip((*head, *_as_row(whole)), schema, strict=True)], schema=schema)

    while fragments.filter("chunks > 1").limit(1).count():
        groups = fragments.groupBy("row", F.floor(F.col("chunk") / FAN).alias("_at"))
        fragments = stored(groups.applyInArrow(join, f"_id {key}, {_FRAGMENT}"), "token_fragments")
    return fragments


def aligned(df: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", groups: bool = True) -> DataFrame:
    """``_id``, numbers, groups (or their SHA-256) and packed links of every row."""
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = df.select(F.col(f"`{key}`").alias("_id"), content.alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    long = F.octet_length("_text") >= CHUNK
    size = CHUNK

    def told(ids: pa.Array, found: list) -> pa.RecordBatch:
        none = (0, 0, 0, "", np.zeros(0, np.uint32))
        rows = [none if f is None else f for f in found]
        texts = [r[3] if groups or not r[3] else sha256(r[3].encode()).hexdigest() for r in rows]
        numbers = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
        links = pa.array([pack_links(r[4]) for r in rows], pa.binary())
        return pa.record_batch(
            [ids, *numbers, pa.array(texts, pa.string()), links], names=["_id", "n_a", "n_b", "n_groups", "groups", "links"]
        )

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = aligner(a_path, b_path)
        for batch in batches:
            texts = batch["_text"].to_pylist()
            at = size_ = 0
            for i, t in enumerate(texts):
                size_ += len(t)
                if size_ >= SLICE or i == len(texts) - 1:
                    mine = texts[at : i + 1]
                    found = iter(tools.whole([t for t in mine if t]))
                    yield told(batch["_id"].slice(at, i + 1 - at), [next(found) if t else None for t in mine])
                    at, size_ = i + 1, 0

    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = aligner(a_path, b_path)
        for batch in batches:
            for i, r in enumerate(batch.drop_columns(["_id"]).to_pylist()):
                found = tools.ranged(r["part"], r["offset"], r["low"], r["high"])
                values = (r["row"], r["chunk"], r["chunks"], *_as_row(found))
                columns = [pa.array([x], f.type) for x, f in zip(values, _FRAGMENT_ARROW, strict=True)]
                yield pa.record_batch([batch["_id"].slice(i, 1), *columns], names=["_id", *_FRAGMENT_ARROW.names])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, r in enumerate(batch.drop_columns(["_id"]).to_pylist()):
                f = _of_row(r)
                whole = (f.n_a, f.n_b, f.n_groups, groups_of(f), np.concatenate(f.links)) if f.valid else None
                yield told(batch["_id"].slice(i, 1), [whole])

    schema = f"_id {kind}, {ROWS}"
    parts = rows.filter(long).withColumn("_row", F.monotonically_increasing_id())
    key_type = _arrow_type(rows)
    cut = parts.mapInArrow(lambda x: _chunks(x, size, key_type), f"_id {kind}, {_PART}")
    made = cut.repartition(F.col("row"), F.col("chunk")).mapInArrow(fragments, f"_id {kind}, {_FRAGMENT}")
    ends = tree(stored(made, "token_fragments"), kind).mapInArrow(finish, schema)
    return rows.filter(~long).mapInArrow(short, schema).unionByName(ends)


def _arrow_type(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema["_id"].dataType)


def pair_counts(links: DataFrame, pairs: int) -> DataFrame:
    """``pair`` (its rank) and ``n``: how many links of the corpus hold it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(pairs, np.int64)
        for batch in batches:
            for packed in batch["links"]:
                total += 0 if not packed.as_py() else np.bincount(unpack_links(packed.as_py()), minlength=pairs)
        found = np.flatnonzero(total)
        yield pa.record_batch([pa.array(found), pa.array(total[found])], names=["pair", "n"])

    return links.select("links").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def align(df: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", groups: bool = True) -> DataFrame:
    """``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups`` of every row.

    A is a byte-level BPE file, B a sentence piece model that puts a space before texts.  ``groups`` is spelled
    ``a1,a2|b1;a3|b2,b3``; with ``groups=False`` it is the SHA-256 of that.
    """
    spark = df.sparkSession
    rows = stored(aligned(df, a_path, b_path, key, text, groups), "token_groups")
    tools = aligner(a_path, b_path)
    counted = pair_counts(rows, len(tools.pairs)).toPandas()  # at most as many rows as there are possible pairs
    n = np.zeros(len(tools.pairs), np.int64)
    n[counted["pair"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    most = np.zeros(tools.width, np.int64)
    np.maximum.at(most, tools.pairs % tools.width, n)
    sent = spark.sparkContext.broadcast((n, n == most[tools.pairs % tools.width]))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, best = sent.value
        for batch in batches:
            links = [unpack_links(x.as_py()) for x in batch["links"]]
            added = [[len(x) for x in links], [int(best[x].sum()) for x in links], [int(count[x].sum()) for x in links]]
            columns = [batch[c] for c in ("_id", "n_a", "n_b", "n_groups")] + [pa.array(x, pa.int64()) for x in added]
            names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
            yield pa.record_batch([*columns, batch["groups"]], names=names)

    kind = rows.schema["_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
    return rows.mapInArrow(look, schema)
