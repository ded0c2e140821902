"""Operator 10: benchmark decontamination by a prefix-filtered set join.

A benchmark item's windows are its runs of ``WINDOW`` words (the whole item
if it has fewer).  A window's tokens are its runs of up to ``TOKEN`` words.
As an occurrence contains the whole window, every one of its tokens is
needed, so the necessary prefix of a window ordered by rarity is its rarest
token alone.

1. Document tokens that no window has are dropped inside the row, against a
   fixed-size bit table of all window tokens (``BITS`` at most; false hits
   cost only rows).  What is left is written once with its position and the
   words around it.
2. Those rows give each token's count over the whole corpus, and each
   window its rarest token.
3. Documents join windows on that token; the token's offset gives the
   place, which must fit the document's length; the words there must equal
   the window.

All steps are DataFrame functions; a token on many documents is a plain join
key that adaptive execution can split.

Results: null and word-free texts have no words and are never contaminated;
null and word-free items have no window; repeated items and rows count once each
by id and text; an item without an id is ignored; empty tables give no
hits.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import ascii_lower, cut, unused

WINDOW = 13
TOKEN = 5
#: Size limits of the bit table of window tokens: 4 KB to 512 KB.
BITS = (1 << 15, 1 << 22)
SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased runs of ASCII letters, digits and all characters above U+007F."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SPLIT), lambda w: w != "")


def _token(hashes: Column, at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.get(hashes, at + k) for k in range(size)])


def windows(bench: DataFrame, item: str, text_col: str, window: int) -> DataFrame:
    """Distinct windows: ``words``, ``len`` and the ids of the items that have them."""
    items = bench.where(F.col(item).isNotNull()).select(
        F.col(item).alias("_item"), words(F.col(text_col)).alias("_w"))
    n = F.size("_w")
    starts = F.when(n >= window, F.sequence(F.lit(0), n - window)).when(n > 0, F.array(F.lit(0)))
    return (items.withColumn("_s", F.explode(starts))
            .select("_item", F.slice("_w", F.col("_s") + 1, window).alias("words"))
            .groupBy("words").agg(F.collect_set("_item").alias("items"))
            .withColumn("len", F.size("words")))


def _sized(size: int):
    return lambda o: F.struct(o.alias("o"), F.lit(size).alias("size"),
                              _token(F.col("_h"), o, size).alias("h"))


def _window_tokens(wins: DataFrame) -> DataFrame:
    """One row per window and token: ``words``, ``len``, ``o`` (offset), ``size``, ``h``."""
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    per_size = F.lit(None).cast("array<struct<o:int,size:int,h:bigint>>")
    for size in range(1, TOKEN + 1):
        fits = (F.col("len") == size) if size < TOKEN else (F.col("len") >= size)
        per_size = F.when(fits, F.transform(
            F.sequence(F.lit(0), F.col("len") - size), _sized(size))).otherwise(per_size)
    return (wins.withColumn("_h", hashes).withColumn("_t", F.explode(per_size))
            .select("words", "len", "_t.o", "_t.size", "_t.h"))


def _bit_table(tokens: DataFrame) -> tuple[Column, int]:
    """A bit table with three bits for every token hash; bounded by ``BITS``."""
    n = tokens.count()
    bits = min(max(BITS[0], 1 << max(1, 32 * n).bit_length()), BITS[1])
    probes = F.explode(F.array(*_probes(F.col("h"), bits)))
    rows = (tokens.select(probes.alias("b")).groupBy(F.shiftright("b", 6).alias("i"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("v")).collect())
    table = [0] * (bits // 64)
    for r in rows:
        table[r["i"]] = r["v"]
    low = -(1 << 63)
    return F.expr("array(" + ",".join(
        f"{v}L" if v != low else f"(-{(1 << 63) - 1}L - 1L)" for v in table) + ")"), bits


def _probes(h: Column, bits: int) -> list[Column]:
    return [F.shiftright(h, s).bitwiseAND(F.lit(bits - 1)) for s in (0, 21, 42)]


def _maybe(h: Column, table: Column, bits: int) -> Column:
    """Whether a hash may be in the table: three bits, the first of which mostly decides."""
    out = None
    for b in reversed(_probes(h, bits)):
        word = F.get(table, F.shiftright(b, 6).cast("int"))
        hit = F.call_function("getbit", word, b.bitwiseAND(F.lit(63)).cast("int")) == 1
        out = hit if out is None else hit & out
    return out


def _at(size: int):
    return lambda i: _token(F.col("_h"), i, size)


def _kept(tokens: Column, table: Column, bits: int):
    return lambda i: _maybe(F.get(tokens, i), table, bits)


def _place(size: int, window: int):
    """A token's place with the words around it that any window with it can cover."""
    before = window - size if size == TOKEN else 0
    return lambda i: F.struct(
        F.lit(size).alias("size"), F.get(F.col(f"_t{size}"), i).alias("h"), i.alias("at"),
        F.greatest(i - before, F.lit(0)).alias("from"),
        F.slice(F.col("_w"), F.greatest(i - before, F.lit(0)) + 1, before + window).alias("around"))


def _candidates(docs: DataFrame, key: str, text_col: str, sizes: list[int], table: Column,
                bits: int, window: int) -> DataFrame:
    """Every row with its word count and the places where a window's token may stand."""
    rows = docs.select(F.col(key).alias("_id"), F.xxhash64(text_col).alias("_th"),
                       words(F.col(text_col)).alias("_w"))
    rows = rows.withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
    n = F.size("_w")
    rows = rows.withColumns({f"_t{s}": F.when(n >= s, F.transform(
        F.sequence(F.lit(0), n - s), _at(s))) for s in sizes})
    rows = rows.withColumns({f"_p{s}": F.when(n >= s, F.filter(
        F.sequence(F.lit(0), n - s), _kept(F.col(f"_t{s}"), table, bits))) for s in sizes})
    found = [F.transform(f"_p{s}", _place(s, window)) for s in sizes]
    empty = F.array().cast("array<struct<size:int,h:bigint,at:int,from:int,around:array<string>>>")
    places = F.flatten(F.array(*[F.coalesce(f, empty) for f in found])) if found else empty
    return rows.select("_id", "_th", n.alias("n_words"), places.alias("_places"))


def contamination(docs: DataFrame, bench: DataFrame, key: str = "doc_id", text_col: str = "text",
                  item: str = "item_id", item_text: str = "text",
                  window: int = WINDOW) -> DataFrame:
    """``key``, text hash ``_th``, ``n_words``, ``n_hit`` and ``items`` of every row."""
    wins = cut(windows(bench, item, item_text, window))
    tokens = cut(_window_tokens(wins))
    sizes = sorted(r["size"] for r in tokens.select("size").distinct().collect())  # 1 to TOKEN
    table, bits = _bit_table(tokens.select("h").distinct())
    rows = cut(_candidates(docs, key, text_col, sizes, table, bits, window))
    places = (rows.where(F.size("_places") > 0)
              .select("_id", "_th", "n_words", F.explode("_places").alias("p"))
              .select("_id", "_th", "n_words", "p.*"))
    counts = places.groupBy("size", "h").agg(F.count(F.lit(1)).alias("c"))
    rarest = (tokens.join(counts, ["size", "h"])
              .groupBy("words", "len")
              .agg(F.min(F.struct("c", "h", "o", "size")).alias("r"))
              .select(F.col("words").alias("window"), "len", "r.h", "r.o", "r.size")
              .join(wins.select(F.col("words").alias("window"), "items"), "window"))
    start = F.col("at") - F.col("o")
    hits = (places.join(cut(rarest), ["size", "h"])
            .withColumn("start", start)
            .where((F.col("start") >= 0) & (F.col("start") + F.col("len") <= F.col("n_words")))
            .where(F.slice("around", F.col("start") - F.col("from") + 1, F.col("len"))
                   == F.col("window")))
    per_doc = (hits.groupBy("_id", "_th")
               .agg(F.collect_set(F.struct("start", (F.col("start") + F.col("len")).alias("end")))
                    .alias("_spans"),
                    F.array_distinct(F.flatten(F.collect_set("items"))).alias("items")))
    covered = F.aggregate(
        F.array_sort("_spans"), F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, x: F.struct(
            F.greatest(a["end"], x["end"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(a["end"], x["start"]))).alias("n")),
        lambda a: a["n"])
    found = per_doc.select(F.col("_id").alias("_fid"), F.col("_th").alias("_fth"),
                           covered.alias("n_hit"), "items")
    return (rows.select("_id", "_th", "n_words")
            .join(found, F.col("_id").eqNullSafe(F.col("_fid")) & (F.col("_th") == F.col("_fth")),
                  "left")
            .select(F.col("_id").alias(key), "_th", F.col("n_words").cast("long").alias("n_words"),
                    F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", F.array().cast(found.schema["items"].dataType))
                    .alias("items")))


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, bench: DataFrame, key: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """``docs`` without its contaminated rows; one row per row that stays, its columns of any name."""
    bid, bth = unused(docs, "_bid"), unused(docs, "_bth")
    bad = (contamination(docs, bench, key, text_col).where(contaminated())
           .select(F.col(key).alias(bid), F.col("_th").alias(bth)).distinct())
    return docs.join(bad, docs[key].eqNullSafe(F.col(bid))
                     & (F.xxhash64(docs[text_col]) == F.col(bth)), "left_anti")
