"""Near-duplicate lines across all documents, in DataFrame functions only: a deletion-neighbourhood join.

The edit distance counts words: one inserted, deleted or replaced word is one edit, and lines of at least
``min_words`` words within one edit are copies.  Shorter lines are copies of equal lines only.  A line goes if
an earlier one (by document, then place) is its copy; white space between words does not count.

1. Equal lines fold into one row each, with the earliest place.
2. Two lines within one edit share their first or their last half.  Lines that share neither with another line
   are put aside by counting 64-bit keys of the halves; the others emit their deletion neighbourhood.
3. A variant is a hashed key.  Lines of equal length that agree after deletion of the same place differ by one
   replaced word; a line and the deletion variant of a longer one differ by one inserted word.  So a group of
   equal keys needs only its earliest line, never its pairs, however many lines it holds.
4. Each hit is verified on the words themselves before it counts.

Counts and minima have map-side combining, so a line or half that holds a third of all rows costs one row a
task; joins back to the rows are plain equi-joins, which adaptive execution splits at hot keys.

Defined results: null text has no lines; lines without a word stay and match nothing; rows with equal id and
equal text are one document and keep the same lines; rows with equal id and other texts are documents of their
own, whose lines are ordered by place, then by a hash of the text; a null id sorts first; columns of the input
that clash with added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.scratch import stored
from lexiloom.llm.words import GAP, SPACES, words

MIN_WORDS = 6
HALVES = [f"_k{i}" for i in range(4)]
STEP = 1 << 61  # orders of one document
WORDED = r"[^\x20\x09-\x0D]"


def _places(df: DataFrame, key: str, text: str) -> DataFrame:
    """Worded lines with document, row and place."""
    content = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(
        F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("_doc"),
        F.xxhash64(content).alias("_row"),
        F.posexplode(F.split(content, "\n")).alias("_at", "_line"),
    )
    return rows.filter(F.col("_line").rlike(WORDED))


def _order() -> Column:
    """Document, place and 30 bits of the row's hash as one number that compares like the three."""
    low = F.shiftleft(F.col("_at").cast("long"), 30) + F.shiftrightunsigned("_row", 34)  # 61 bits
    return (F.col("_doc").cast("decimal(20,0)") * F.lit(STEP).cast("decimal(19,0)") + low).cast("decimal(38,0)")


def _cut(n: Column) -> Column:
    """Words of a half that lines of about ``n`` words are compared by: at most (n - 1) / 2, in coarse steps."""
    most = F.floor((n - 1) / 2).cast("int")
    step = F.when(n < 24, F.lit(1)).when(n < 96, F.lit(4)).otherwise(F.lit(16))
    return most - most % step


def _normal(line: Column) -> Column:
    """A line with single spaces between its words and none around them."""
    odd = line.startswith(" ") | line.endswith(" ") | line.contains("  ")
    for space in SPACES[1:]:
        odd = odd | line.contains(space)
    return F.when(odd, F.regexp_replace(F.btrim(line, F.lit(SPACES)), GAP, " ")).otherwise(line)


def _half_keys(line: Column, n: Column) -> list[Column]:
    """Keys of the first and the last words of a line, as it is cut and as a line of one word less is.

    One edit leaves the first or the last ``_cut`` words of both lines alone, and both know the shorter's cut.
    """

    def key(side: int, k: Column) -> Column:
        return F.xxhash64(F.lit(side), k, F.call_function("substring_index", line, F.lit(" "), k if side == 0 else -k))

    own, less = _cut(n), _cut(n - 1)
    return [key(0, own), key(1, own), F.when(less != own, key(0, less)), F.when(less != own, key(1, less))]


def lines_table(df: DataFrame, key: str, text: str, min_words: int) -> DataFrame:
    """Every worded line by its hash, with the keys of its halves (null where it is too short)."""
    rows = _places(df, key, text).select("_doc", "_row", "_at", _normal(F.col("_line")).alias("_line"))
    n = F.length("_line") - F.length(F.replace(F.col("_line"), F.lit(" "), F.lit(""))) + 1
    rows = rows.select("*", n.alias("_n"))
    halves = [F.when(F.col("_n") >= min_words, k) for k in _half_keys(F.col("_line"), F.col("_n"))]
    return rows.select(
        "_doc", "_row", "_at", F.xxhash64("_line").alias("_id"), *(k.alias(f"_k{i}") for i, k in enumerate(halves))
    )


def _fold(window: Column) -> Column:
    """A hash cut so short that sums of up to 2^23 of them fit a long."""
    return F.shiftright(window, 24)


def neighbourhood(lines: DataFrame) -> DataFrame:
    """Deletion variants of lines (``_order``, ``_h``) as hashed keys: ``_key``, ``_place``, ``_whole``.

    The hash of a line is the sum (of 40 bits each) and the exclusive or (of 64) of the hashes of its 3-word
    windows, so deleting a word changes five terms.  Windows that repeat vanish from the one, not from the other.
    ``_place`` is the deleted place, 0 for the line itself.  A replaced word is looked for under keys that hold
    the place and length, an inserted one under keys that hold the shorter length.
    """
    h = F.col("_h")
    pad = F.lit(0).cast("long")

    def word(i: Column) -> Column:
        return F.coalesce(F.get(h, i), pad)

    windows = F.transform(
        F.sequence(F.lit(0), F.col("_n") + 1), lambda i: F.xxhash64(word(i - 2), word(i - 1), word(i))
    )  # window i ends at word i
    rows = lines.select("_order", "_h", F.size("_h").alias("_n")).select("*", windows.alias("_w"))
    rows = rows.select(
        "*",
        F.aggregate("_w", pad, lambda a, b: a + _fold(b)).alias("_sum"),
        F.aggregate("_w", pad, lambda a, b: a.bitwiseXOR(b)).alias("_xor"),
    )
    # Windows that appear where word i goes: two of them.
    new = F.transform(
        F.sequence(F.lit(0), F.col("_n") - 1),
        lambda i: F.struct(
            F.xxhash64(word(i - 2), word(i - 1), word(i + 1)).alias("a"),
            F.xxhash64(word(i - 1), word(i + 1), word(i + 2)).alias("b"),
        ),
    )

    def without(pair: Column, i: Column) -> Column:
        old = [F.get(F.col("_w"), i + k) for k in range(3)]
        total = F.col("_sum") + _fold(pair["a"]) + _fold(pair["b"])
        parity = F.col("_xor").bitwiseXOR(pair["a"]).bitwiseXOR(pair["b"])
        for window in old:
            total, parity = total - _fold(window), parity.bitwiseXOR(window)
        return F.xxhash64(total, parity)

    def variant(kind: int, key: Column, place: Column) -> Column:
        return F.struct(key.alias("_key"), place.alias("_place"), F.lit(kind).alias("_kind"))

    rows = rows.select("_order", "_n", F.xxhash64("_sum", "_xor").alias("_all"), F.transform(new, without).alias("_d"))
    replaced = F.transform("_d", lambda d, i: variant(0, F.xxhash64(F.lit(0), F.col("_n"), i, d), i + 1))
    shorter = F.transform("_d", lambda d, i: variant(1, F.xxhash64(F.lit(1), F.col("_n") - 1, d), i + 1))
    whole = F.array(variant(2, F.xxhash64(F.lit(1), F.col("_n"), F.col("_all")), F.lit(0)))
    return rows.select("_order", F.inline(F.concat(replaced, shorter, whole)))


def near_lines(df: DataFrame, distinct: DataFrame, key: str, text: str) -> DataFrame:
    """``_id`` of distinct lines (``_id``, first ``_order``, keys) that have an earlier one within one edit."""
    keys = F.array_compact(F.array(*HALVES))
    halves = distinct.select("_id", F.explode(keys).alias("_half"))
    shared = halves.groupBy("_half").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1")
    some = stored(halves.join(shared, "_half", "left_semi").select("_id").distinct(), "line_candidates")
    step = F.lit(STEP).cast("decimal(19,0)")
    within_doc = F.pmod("_order", step.cast("decimal(38,0)"))
    firsts = distinct.join(some, "_id", "left_semi").select(
        "_id",
        "_order",
        ((F.col("_order") - within_doc) / step).cast("long").alias("_doc"),
        F.shiftright(within_doc.cast("long"), 30).cast("int").alias("_at"),
    )
    # One row per document on both sides: no hot key, and a hash of the few places spares sorting all texts.
    wanted = firsts.groupBy("_doc").agg(F.collect_list(F.struct("_at", "_id", "_order")).alias("_wanted"))
    docs = df.select(
        F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("_doc"), F.col(text).alias("_text")
    )
    found = docs.join(wanted.hint("shuffle_hash"), "_doc").select(
        F.split(F.coalesce("_text", F.lit("")), "\n").alias("_lines"), "_wanted"
    )
    line = F.transform(
        "_wanted",
        lambda w: F.struct(w["_id"].alias("_id"), w["_order"].alias("_order"), F.get("_lines", w["_at"]).alias("_line")),
    )
    found = found.select(F.inline(line)).select("_id", "_order", words(F.col("_line")).alias("_words"))
    # Rows that repeat a document id may have other lines at that place.
    near = stored(found.filter(F.xxhash64(F.array_join("_words", " ")) == F.col("_id")), "line_texts")

    variants = neighbourhood(near.select("_order", F.transform("_words", lambda w: F.xxhash64(w)).alias("_h")))
    groups = variants.groupBy("_key").agg(
        F.min(F.when(F.col("_kind") != 2, F.col("_order"))).alias("_first"),
        F.min(F.when(F.col("_kind") == 2, F.col("_order"))).alias("_whole"),
        F.count(F.lit(1)).alias("_c"),
    )
    groups = groups.filter("_c > 1").drop("_c")
    # Replacement groups have no whole line: their earliest member is the witness of the others.
    witness = F.when(F.col("_kind") == 1, F.col("_whole")).otherwise(F.col("_first"))
    hits = (
        variants.join(groups, "_key")
        .select("_order", "_place", "_kind", witness.alias("_witness"))
        .filter("_witness < _order")
    )
    # The witness is within one edit if its words agree before and after the edited place.
    mine, theirs = F.col("_words"), F.col("_their_words")
    n, m = F.size(mine), F.size(theirs)
    longer = F.when(n >= m, mine).otherwise(theirs)
    other = F.when(n >= m, theirs).otherwise(mine)
    paired = (
        hits.select("_order", "_witness")
        .distinct()
        .join(near, "_order")
        .join(near.select(F.col("_order").alias("_witness"), F.col("_words").alias("_their_words")), "_witness")
        .select("_id", longer.alias("_a"), other.alias("_b"))
    )
    differs = F.array_position(
        F.transform(
            F.sequence(F.lit(0), F.size("_a") - 1), lambda i: ~F.get(F.col("_a"), i).eqNullSafe(F.get(F.col("_b"), i))
        ),
        F.lit(True),
    ).cast("int")  # first place that differs, from 1; 0 if none
    tail_a = F.slice("_a", differs + 1, F.greatest(F.size("_a") - differs, F.lit(0)))
    same_length = F.size("_a") == F.size("_b")
    tail_b = F.when(same_length, F.slice("_b", differs + 1, F.greatest(F.size("_b") - differs, F.lit(0)))).otherwise(
        F.slice("_b", F.greatest(differs, F.lit(1)), F.greatest(F.size("_b") - differs + 1, F.lit(0)))
    )
    within = (F.size("_a") - F.size("_b") <= 1) & ((differs == 0) | (tail_a == tail_b))
    return paired.filter(within).select("_id").distinct()


def removed_lines(df: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``_doc``, ``_row`` and the places of its lines that go (``_gone``), for documents that lose any."""
    lines = stored(lines_table(df, key, text, min_words), "lines")
    first = F.min(_order()).alias("_order")
    distinct = stored(lines.groupBy("_id", *HALVES).agg(first), "distinct_lines")
    near = near_lines(df, distinct, key, text).withColumn("_near", F.lit(True))
    verdict = distinct.select("_id", F.col("_order").alias("_first")).join(near, "_id", "left")
    gone = lines.select("_id", "_doc", "_row", "_at").join(verdict, "_id")
    gone = gone.filter((_order() != F.col("_first")) | F.col("_near"))
    return stored(gone.groupBy("_doc", "_row").agg(F.collect_set("_at").alias("_gone")), "removed_lines")


def deduplicate(df: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """All columns of ``df`` with ``dedup_text``, ``n_lines`` (worded ones) and ``n_removed``."""
    added = ("dedup_text", "n_lines", "n_removed")
    rest = [F.col(f"`{c}`") for c in df.columns if c not in added]
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = df.select(
        *rest,
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(-(1 << 63))).alias("_doc"),
        F.xxhash64(content).alias("_row"),
        F.split(content, "\n").alias("_lines"),
    )
    gone = removed_lines(df, key, text, min_words)
    joined = rows.join(gone.hint("shuffle_hash"), ["_doc", "_row"], "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    left = F.array_join(F.transform(stay, lambda i: F.get(F.col("_lines"), i)), "\n")
    return joined.select(
        *rest,
        F.when(F.col("_gone").isNull(), content).otherwise(left).alias("dedup_text"),
        F.size(F.filter("_lines", lambda line: line.rlike(WORDED))).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
    )
