"""Near-duplicate documents by an LSH forest over MinHash signatures.

Documents with equal shingle sets are one class.  A signature of ``4 * TREES`` minima gives ``TREES`` sorted
orders: tree t orders the classes by the eight minima from place 4 t on, in a ring.  A region is a run that
agrees on the first four.  Candidates of a class are its neighbours in each order, which share the longest
prefixes with it: in a region of a few classes that is the whole region, in a dense one only classes that agree
on more minima, so the depth follows the density.  Signatures rank the neighbours and the best few are verified
on the full sets.

Dense regions would lose links that way, so two further steps look at regions only:

* the class with most links (the hub) of the main component of a region meets the classes apart from it, which
  is linear;
* classes still apart from the main component of a region meet all others of it whose signatures do not rule
  the pair out, in chunks of bounded size.

Two documents at the threshold share no region with a probability of 2.1e-8 (0.85) or 3.3e-6 (0.8).  Signatures rule
such a pair out in 4.4e-9 or 3.6e-8 of the cases and sketches in less than 3e-9, by binomial tails: whole, less than
3e-8 or 4e-6 of the pairs at the threshold are missed, and fewer above it.

Pairs inside a group of copies are never listed beyond that: copies in one component need no further link.
Classes are found by a hash of 128 bits; links, sets and components stay in the cluster.

Defined results: documents without words (null, empty, blank) have size 0 and are linked with nothing; with
fewer words than a shingle has, the whole sequence is the one shingle; rows that repeat an id are one node, so
they share a component; a null id is linked with nothing and kept; other columns are ignored.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.components import components
from lexiloom.llm.scratch import stored
from lexiloom.llm.words import lower_ascii, words

TREES = 24
DEPTH = 4  # minima that a region agrees on
ORDER = 8  # minima that an order sorts by
SPAN = 32  # neighbours looked at on each side
BEST = 2  # of these, candidates per class and tree
MARGIN = 0.24  # of a similarity estimated from a signature; its binomial tail is below the miss of the regions
CHUNK = 1024
SKETCH = 256  # smallest shingle hashes kept for a second, finer estimate
DEVIATIONS = 6.5  # that a sketch may be off; its tail is below the miss of the regions too

_RANDOM = np.random.default_rng(20240229)
_FACTORS = _RANDOM.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _RANDOM.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a sequence of word hashes."""
    h = hashes.astype(np.int64).view(np.uint64)
    if not len(h):
        return h
    n = max(1, len(h) - width + 1)
    total = np.zeros(n, np.uint64)
    for i in range(min(width, len(h))):
        total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
    return np.unique(total)


def signature(shingles: np.ndarray) -> np.ndarray:
    low = np.full(TREES * DEPTH, np.iinfo(np.uint32).max, np.uint32)
    for start in range(0, len(shingles), 4096):
        part = shingles[start : start + 4096]
        values = (_FACTORS[:, None] * part[None, :] + _TERMS[:, None]) >> np.uint64(32)
        low = np.minimum(low, values.min(axis=1).astype(np.uint32))
    return low


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The smallest hashes of a set, in order; all of a small set."""
    return (shingles[:SKETCH] >> np.uint64(32)).astype(np.uint32)


def sketches_allow(a: list[bytes], b: list[bytes], least: float) -> np.ndarray:
    """Which pairs of sketches allow a similarity of ``least``: exact for small sets, ``DEVIATIONS`` else."""

    def padded(rows: list[bytes], pad: int) -> tuple[np.ndarray, np.ndarray]:
        values = np.full((len(rows), SKETCH), pad, np.uint64)
        for i, row in enumerate(rows):
            own = np.frombuffer(row, np.uint32)
            values[i, : len(own)] = own
        cut = np.array([len(row) == 4 * SKETCH for row in rows])
        return values, np.where(cut, values[:, -1], np.uint64(1 << 32))

    left, left_end = padded(a, 1 << 33)
    right, right_end = padded(b, 1 << 34)
    end = np.minimum(left_end, right_end)[:, None]
    merged = np.sort(np.concatenate([left, right], axis=1), axis=1)
    both = ((merged[:, 1:] == merged[:, :-1]) & (merged[:, 1:] <= end)).sum(axis=1)
    union = (left <= end).sum(axis=1) + (right <= end).sum(axis=1) - both
    slack = np.where(end[:, 0] < 1 << 32, DEVIATIONS * np.sqrt(least * (1 - least) / np.maximum(union, 1)), 0.01)
    return both >= (least - slack) * union


def document_sets(df: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``digest`` of the set, ``sig`` and ``sketch`` of every row."""
    hashes = F.transform(words(lower_ascii(F.col(f"`{text}`"))), lambda w: F.xxhash64(w))
    source = df.select(F.col(f"`{key}`").alias("doc_id"), hashes.alias("h"))

    def run(frames):
        for frame in frames:
            sizes, digests, signatures, sketches = [], [], [], []
            for h in frame["h"]:
                s = shingle_set(np.asarray(h), width)
                sizes.append(len(s))
                digests.append(blake2b(s.tobytes(), digest_size=16).digest())
                signatures.append(signature(s).tobytes() if len(s) else b"")
                sketches.append(sketch(s).tobytes())
            columns = {"n_shingles": sizes, "digest": digests, "sig": signatures, "sketch": sketches}
            yield pd.DataFrame({"doc_id": frame["doc_id"]} | columns)

    return source.mapInPandas(run, "doc_id long, n_shingles long, digest binary, sig binary, sketch binary")


def region_keys(sig: np.ndarray) -> np.ndarray:
    """Region of each class (row) in each tree (column)."""
    minima = sig.reshape(len(sig), TREES, DEPTH).astype(np.uint64)
    h = np.arange(1, TREES + 1, dtype=np.uint64)[None, :] + np.zeros((len(sig), 1), np.uint64)
    for i in range(DEPTH):
        h = _mixed(h * np.uint64(0x9E3779B97F4A7C15) + minima[:, :, i])
    return h.view(np.int64)


def regions(nodes: DataFrame) -> DataFrame:
    """``region`` and the minima that order it (``rest``), one row per class and tree."""

    def run(frames):
        for frame in frames:
            if not len(frame):
                continue
            sig = np.frombuffer(b"".join(frame["sig"]), np.uint32).reshape(len(frame), TREES * DEPTH)
            ring = np.concatenate([sig, sig[:, : ORDER - DEPTH]], axis=1)
            keys = region_keys(sig)
            for t in range(TREES):
                rest = ring[:, DEPTH * (t + 1) : DEPTH * t + ORDER].astype(">u4")
                yield pd.DataFrame(
                    {"region": keys[:, t], "rest": [r.tobytes() for r in rest], "node": frame["node"]}
                )

    return nodes.select("node", "sig").mapInPandas(run, "region long, rest binary, node long")


def _alike(sig: np.ndarray, other: np.ndarray, n: np.ndarray, m: np.ndarray, least: float) -> np.ndarray:
    """Estimated similarity of all pairs; -1 where it or the sizes rule a link out."""
    if len(sig) * len(other) < 1024:
        same = (sig[:, None, :] == other[None, :, :]).sum(axis=2)
    else:
        same = np.zeros((len(sig), len(other)), np.int16)
        for i in range(sig.shape[1]):
            same += sig[:, i, None] == other[None, :, i]
    estimate = same / sig.shape[1]
    small, large = np.minimum(n[:, None], m[None, :]), np.maximum(n[:, None], m[None, :])
    return np.where((estimate >= least - MARGIN) & (small >= least * large), estimate, -1.0)


def _signatures(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint32).reshape(len(column), TREES * DEPTH)


def _pairs(a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def neighbours(rows: DataFrame, least: float) -> DataFrame:
    """Best candidates among the neighbours in each order: ``a`` < ``b``."""
    ordered = rows.repartitionByRange("region", "rest", "node").sortWithinPartitions("region", "rest", "node")

    def best(block: pd.DataFrame):
        same_region = block["region"].to_numpy()
        sig, n, node = _signatures(block["sig"]), block["n_shingles"].to_numpy(), block["node"].to_numpy()
        estimate = _alike(sig, sig, n, n, least)
        place = np.arange(len(block))
        far = (np.abs(place[:, None] - place[None, :]) > SPAN) | (node[:, None] == node[None, :])
        estimate[far | (same_region[:, None] != same_region[None, :])] = -1.0
        top = np.argpartition(-estimate, min(BEST, len(block) - 1), axis=1)[:, :BEST]
        a, b = np.repeat(place, top.shape[1]), top.ravel()
        good = estimate[a, b] >= 0
        return _pairs(node[a[good]], node[b[good]])

    def run(frames):
        kept = None
        for frame in frames:
            block = frame if kept is None else pd.concat([kept, frame], ignore_index=True)
            start = 0
            while len(block) - start > 4 * SPAN:  # overlapping blocks: every row meets SPAN rows on each side
                yield best(block.iloc[start : start + 4 * SPAN])
                start += 2 * SPAN
            kept = block.iloc[start:]
        if kept is not None and len(kept) > 1:
            yield best(kept)

    return ordered.mapInPandas(run, "a long, b long").distinct()


def mixed_regions(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of regions that hold several components, with ``label``, the ``main`` one and the region's chunks."""
    labelled = rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    counts = labelled.groupBy("region", "label").agg(F.count(F.lit(1)).alias("_c"))
    mixed = counts.groupBy("region").agg(
        F.max(F.struct("_c", "label")).alias("_main"), F.sum("_c").alias("_all"), F.count(F.lit(1)).alias("_labels")
    )
    mixed = mixed.filter("_labels > 1").select(
        "region",
        F.col("_main.label").alias("main"),
        F.ceil(F.col("_all") / CHUNK).cast("int").alias("_chunks"),
        F.ceil((F.col("_all") - F.col("_main._c")) / CHUNK).cast("int").alias("_pieces"),
    )
    return labelled.join(mixed, "region")


def hub_pairs(rows: DataFrame, links: DataFrame, labels: DataFrame, least: float) -> DataFrame:
    """The class with most links of the main component of each region, with the classes apart from it.

    A group of copies has its original as its hub: one meeting with it decides for nearly every copy.
    """
    ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node")))
    degree = ends.groupBy("node").agg(F.count(F.lit(1)).alias("_degree"))
    hubs = degree.join(labels, "node").groupBy("label").agg(F.max(F.struct("_degree", "node")).alias("_top"))
    hubs = hubs.select(F.col("label").alias("main"), F.col("_top.node").alias("hub"))
    signed = rows.select("node", "sig").dropDuplicates(["node"])
    hubs = hubs.join(signed.withColumnsRenamed({"node": "hub", "sig": "hub_sig"}), "hub")
    outside = mixed_regions(rows, labels).filter("label <> main").dropDuplicates(["node", "main"])

    def run(frames):
        for frame in frames:
            if len(frame):
                same = (_signatures(frame["sig"]) == _signatures(frame["hub_sig"])).mean(axis=1)
                good = same >= least - MARGIN
                yield _pairs(frame["node"].to_numpy()[good], frame["hub"].to_numpy()[good])

    joined = outside.join(hubs, "main").select("node", "sig", "hub", "hub_sig")
    return joined.mapInPandas(run, "a long, b long").distinct()


def apart_pairs(rows: DataFrame, sketches: DataFrame, labels: DataFrame, least: float) -> DataFrame:
    """Pairs of a region in different components, one of them not its main one, unless signatures rule it out.

    A pair that shares several regions is listed in the one of its first tree only.
    """
    within = mixed_regions(rows, labels).join(sketches, "node")
    # All classes of a region in chunks, those apart from its main component in pieces: every piece meets every chunk.
    chunk = F.pmod(F.xxhash64("node"), F.col("_chunks")).cast("int")
    piece = F.pmod(F.xxhash64("node", F.lit(1)), F.col("_pieces")).cast("int")
    everyone = within.withColumn("_chunk", chunk).withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1))
    )
    outside = within.filter("label <> main").withColumn("_piece", piece)
    outside = outside.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    columns = ["region", "_chunk", "_piece", "node", "n_shingles", "sig", "sketch", "label"]
    both = everyone.select(*columns, F.lit(False).alias("_apart")).unionByName(
        outside.select(*columns, F.lit(True).alias("_apart"))
    )
    grouped = both.repartition("region", "_chunk", "_piece").sortWithinPartitions("region", "_chunk", "_piece")

    def meet(group: pd.DataFrame):
        apart = group["_apart"].to_numpy()
        sig, n, label = _signatures(group["sig"]), group["n_shingles"].to_numpy(), group["label"].to_numpy()
        left, right = np.flatnonzero(apart), np.flatnonzero(~apart)
        if not len(left) or not len(right):
            return
        good = _alike(sig[left], sig[right], n[left], n[right], least) >= 0
        good &= label[left][:, None] != label[right][None, :]
        a, b = np.nonzero(good)
        if not len(a):
            return
        a, b = left[a], right[b]
        keys, region = region_keys(sig), group["region"].iloc[0]
        node, sketch_ = group["node"].to_numpy(), group["sketch"].to_numpy()
        for start in range(0, len(a), 2048):  # a group may have a million pairs
            i, j = a[start : start + 2048], b[start : start + 2048]
            first = (sig[i] == sig[j]).reshape(len(i), TREES, DEPTH).all(axis=2).argmax(axis=1)
            here = keys[i, first] == region
            i, j = i[here], j[here]
            if not len(i):
                continue
            fine = sketches_allow(sketch_[i].tolist(), sketch_[j].tolist(), least)
            yield _pairs(node[i[fine]], node[j[fine]])

    def run(frames):
        rest = None
        for frame in frames:
            rest = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            keys = rest[["region", "_chunk", "_piece"]].to_numpy()
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for start, end in zip(np.concatenate([[0], cuts[:-1]]), cuts, strict=False):
                yield from meet(rest.iloc[start:end])
            rest = rest.iloc[cuts[-1] :] if len(cuts) else rest
        if rest is not None and len(rest):
            yield from meet(rest)

    return grouped.mapInPandas(run, "a long, b long").distinct()


def exact_sets(df: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``node`` and its distinct shingles as hashes."""
    hashes = F.transform(words(lower_ascii(F.col(f"`{text}`"))), lambda w: F.xxhash64(w))
    rows = df.select(F.col(f"`{key}`").alias("node"), hashes.alias("_h"))
    whole = F.array(F.xxhash64("_h"))
    n = F.size("_h")
    parts = F.transform(
        F.sequence(F.lit(0), F.greatest(n - width, F.lit(0))),
        lambda i: F.xxhash64(*(F.get(F.col("_h"), i + k) for k in range(width))),
    )
    return rows.select("node", F.array_distinct(F.when(n < width, whole).otherwise(parts)).alias("_set"))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets have ``100 * intersection >= percent * union``."""
    a = sets.select(F.col("node").alias("a"), F.col("_set").alias("_sa"))
    b = sets.select(F.col("node").alias("b"), F.col("_set").alias("_sb"))
    both = pairs.join(a, "a").join(b, "b").select(
        "a", "b", F.size("_sa").alias("_na"), F.size("_sb").alias("_nb"), "_sa", "_sb"
    )
    close = 100 * F.least("_na", "_nb") >= percent * F.greatest("_na", "_nb")
    common = F.size(F.array_intersect("_sa", "_sb"))
    return both.filter(close).filter((100 + percent) * common >= percent * (F.col("_na") + F.col("_nb"))).select("a", "b")


def same_id(worded: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes that rows of one ``doc_id`` are in: a star around the smallest of them."""
    repeated = worded.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1").select("doc_id")
    nodes = worded.select("doc_id", "digest").join(repeated, "doc_id").join(classes, "digest")
    least = nodes.groupBy("doc_id").agg(F.min("node").alias("a"))
    return nodes.join(least, "doc_id").filter("a <> node").select("a", F.col("node").alias("b")).distinct()


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row."""
    least = percent / 100
    documents = stored(document_sets(df, key, text, width), "signatures")
    worded = documents.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = worded.groupBy("digest").agg(F.min("doc_id").alias("node"))
    nodes = (
        worded.join(classes, "digest").filter("doc_id = node").dropDuplicates(["digest"])
        .select("node", "n_shingles", "sig", "sketch")
    )
    places = stored(regions(nodes), "regions")
    shared = places.groupBy("region").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1").select("region")
    rows = stored(places.join(shared, "region").join(nodes.drop("sketch"), "node"), "forest")
    busy = rows.select("node").distinct()
    sketches = stored(nodes.select("node", "sketch").join(busy, "node", "left_semi"), "sketches")
    sets = stored(exact_sets(df.join(busy, F.col(f"`{key}`") == busy["node"], "left_semi"), key, text, width), "sets")

    tried = stored(neighbours(rows, least), "pairs")
    links = stored(verified(tried, sets, percent).unionByName(same_id(worded, classes)), "links")
    labels = components(links)
    more = stored(hub_pairs(rows, links, labels, least).join(tried, ["a", "b"], "left_anti"), "pairs")
    tried = tried.unionByName(more)
    late = stored(verified(more, sets, percent), "links")
    if late.limit(1).count():
        links = links.unionByName(late)
        labels = components(links)
    rest = stored(apart_pairs(rows, sketches, labels, least).join(tried, ["a", "b"], "left_anti"), "pairs")
    late = stored(verified(rest, sets, percent), "links")
    if late.limit(1).count():
        labels = components(links.unionByName(late))
    # Rows of one class share a node; classes that share an id are linked.
    of_class = classes.join(labels, "node", "left").select("digest", F.coalesce("label", "node").alias("_label"))
    found = documents.join(of_class, "digest", "left").select("doc_id", "n_shingles", "_label")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("_label", "doc_id")).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )

