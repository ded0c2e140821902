"""Operator 9: one-permutation MinHash fingerprints of documents.

Each word shingle is hashed once; the hash's top bits choose one of ``BINS``
bins and the smallest hash of a bin stands for it.  Empty bins are filled by
optimal densification: each follows its own fixed sequence of uniformly
drawn bins to the first that is not empty (``PROBES`` draws from a table,
then the non-empty bin of least hashed preference, a uniform draw as well),
so equal sets fill equally.  Of each bin the low ``BITS`` bits are stored as
one hexadecimal digit; likeness is the share of equal digits, corrected for
digits that agree by chance.

A sorted array gives the smallest hash of every bin in one pass, so a
document is one row expression: no shingle is shuffled and everything is
a DataFrame function.

Shingles are runs of five words (lower-cased, split at white space); fewer
words form one shingle.  Null, empty and blank texts have no shingle and the
fingerprint of all zero digits, which is like itself only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import fenced, positions

BINS = 256
_BIN_SHIFT = 56          # a hash's top eight bits
BITS = 4
PROBES = 8
WORDS = 5


def _draw(j: int, attempt: int) -> int:
    """Universal hash of bin and attempt: the attempt-th bin that bin ``j`` asks."""
    x = (j * 0x9E3779B97F4A7C15 + attempt * 0xC2B2AE3D27D4EB4F + 0x165667B19E3779F9) % (1 << 64)
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) % (1 << 64)
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) % (1 << 64)
    return (x ^ (x >> 31)) % BINS


def _table(attempt: int) -> Column:
    return F.expr("array(" + ",".join(str(_draw(j, attempt)) for j in range(BINS)) + ")")


def add_digits(df: DataFrame, text: str, out: str, words: int = WORDS) -> DataFrame:
    """Add ``out``: the ``BINS`` low-order values (array of int; null without shingles)."""
    h, s, m, d = (f"_{x}_{out}" for x in "hsmd")
    split = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\s+"),
                     lambda x: x != "")
    step1 = fenced(df, **{h: F.transform(split, lambda x: F.xxhash64(x))})
    n = F.size(h)
    runs = F.transform(F.sequence(F.lit(0), n - words),
                       lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(words)]))
    step2 = fenced(step1, **{s: F.sort_array(
        F.when(n >= words, runs).when(n > 0, F.array(F.xxhash64(F.col(h)))))}).drop(h)
    # Signed order visits the bins in a fixed order too; bins are numbered from the lowest.
    number = lambda x: F.shiftright(x, _BIN_SHIFT) + BINS // 2          # noqa: E731
    firsts = F.filter(F.col(s), lambda x, i: (i == 0) | (
        F.shiftright(x, _BIN_SHIFT) != F.shiftright(F.get(F.col(s), i - 1), _BIN_SHIFT)))
    step3 = fenced(step2, **{m: firsts}).drop(s)
    gaps = F.transform(F.col(m), lambda x, i: F.concat(
        F.array_repeat(F.lit(None).cast("long"), (number(x) - F.coalesce(
            number(F.get(F.col(m), i - 1)), F.lit(-1)) - 1).cast("int")), F.array(x)))
    dense = F.concat(F.flatten(gaps), F.array_repeat(F.lit(None).cast("long"), (
        BINS - 1 - number(F.element_at(F.col(m), -1))).cast("int")))
    step4 = fenced(step3, **{d: F.when(F.size(m) > 0, dense)})
    tables = [_table(a) for a in range(PROBES)]

    def preferred(j):
        return F.array_min(F.transform(F.col(m), lambda x: F.struct(
            F.xxhash64(j, number(x)).alias("p"), x.alias("x"))))["x"]
    filled = F.transform(F.col(d), lambda x, j: F.coalesce(
        x, *[F.get(F.col(d), F.get(t, j)) for t in tables], preferred(j)).bitwiseAND(
            F.lit((1 << BITS) - 1)).cast("int"))
    return fenced(step4, **{out: filled}).drop(m, d)


def packed(digits: Column) -> Column:
    """The stored form: one hexadecimal digit a bin."""
    text = F.array_join(F.transform(digits, lambda x: F.substring(F.hex(x.cast("long")), -1, 1)), "")
    return F.lower(F.coalesce(text, F.lit("0" * BINS)))


def likeness(a: Column, b: Column) -> Column:
    """Estimated similarity of two documents from their digits, 0 to 1."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")),
                       F.lit(0), lambda n, x: n + x) / F.lit(float(BINS))
    chance = 1.0 / (1 << BITS)
    fair = F.greatest(F.lit(0.0), (same - chance) / (1 - chance))
    return F.when(a.isNull() & b.isNull(), F.lit(1.0)).when(
        a.isNull() | b.isNull(), F.lit(0.0)).otherwise(fair)


def fingerprints(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``key``, ``digits`` and ``fingerprint`` of every text."""
    return (add_digits(docs.select(key, text_col), text_col, "digits")
            .select(key, "digits", packed(F.col("digits")).alias("fingerprint")))


def with_next_edit(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's ``key``, ``n_chars``, ``digits``, ``edited`` text, ``edited_digits`` and
    ``next_digits``.

    The edit replaces the last quarter of a text by as many code points of
    the document with the next larger id (after the largest: the smallest).
    Of rows that share an id, the smallest head is next.  A row without an id
    has no next document: its last quarter is dropped.  Ids are ranked over
    range partitions; a text crosses the network once, and its head once more
    to the row that needs it.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = add_digits(docs.select(F.col(key).alias("_id"), text.alias("_text")), "_text", "_digits")
    ids = positions(
        docs.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_id"))
        .agg(F.max(F.floor(F.char_length(text) / 4)).alias("_need")), [F.col("_id")])
    asked = ids.select(F.col("_id").alias("_for"), "_need",
                       F.pmod(F.col("_pos") + 1, F.col("_total")).alias("_pos"))
    heads = (rows.join(ids.select("_id", "_pos").join(asked, "_pos"), "_id")
             .select("_for", F.struct(F.expr("substring(_text, 1, cast(_need as int))").alias("t"),
                                      F.col("_digits").alias("d")).alias("_h"))
             .groupBy("_for").agg(F.min("_h").alias("_h")))
    n = F.char_length("_text")
    return (rows.join(heads, F.col("_id") == F.col("_for"), "left")
            .withColumn("n_chars", n.cast("long"))
            .withColumn("_quarter", F.floor(n / 4).cast("int"))
            .withColumn("edited", F.concat(
                F.expr("substring(_text, 1, cast(n_chars as int) - _quarter)"),
                F.coalesce(F.expr("substring(_h.t, 1, _quarter)"), F.lit(""))))
            .transform(lambda df: add_digits(df, "edited", "edited_digits"))
            .select(F.col("_id").alias(key), "n_chars", "edited", F.col("_digits").alias("digits"),
                    "edited_digits", F.col("_h.d").alias("next_digits")))
