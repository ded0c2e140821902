"""Operator 13: toxicity by gradient-boosted trees over dense features.

A text becomes a few dozen numbers: densities of a learned lexicon, nearness
of its words to a second person, rates of capitals, punctuation and
obfuscation, repetition and length.  Boosted trees score them, and isotonic
regression on rows that the trees have not seen calibrates the score.

The lexicon is learned from the training rows alone: whole words and word
beginnings of 3 to 6 letters that occur more often in rows labelled toxic, by
a smoothed log-odds ratio.  No word is written down here but second persons.
Training features are cross-fitted: a row's lexicon leaves out the row's own
third, so the trees see lexicon hits as an unseen text shows them.

Bounds: training takes the ``TRAIN`` labelled ids of least hash, one text
each; the lexicon keeps ``LEXICON`` units.  Scoring is one pass over the whole
texts, without a shuffle.

Defined cases: a null or empty text has all features zero and a score like
any other; rows that share an id are scored each by its own text, and the
least text of the id trains; an id with several labels is toxic if any is; a
null id or label trains nothing; a null id is not held out; with fewer than
``LEAST`` training rows of either label every score is the share of toxic
ones (0 without any).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from math import log1p

import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.llm.common import cut, map_rows

# Most labelled ids that train, most units of the lexicon, least rows of a label.
TRAIN, LEXICON, LEAST = 24_000, 4_000, 5
# Thirds of the cross-fit; of CALIBRATE parts of the rows one calibrates.
FOLDS, CALIBRATE = 3, 5
TREES, DEPTH, STEP = 30, 4, 0.2
# A unit needs this many toxic rows and this log-odds ratio; a row counts a unit so often at most.
UNIT_ROWS, UNIT_ODDS, UNIT_COUNT = 3, 1.0, 5

# FIXED VALUES: words for the second person in English, German, French and Spanish.
SECOND_PERSON = frozenset((
    "you your yours yourself yourselves u ur du dich dir dein deine deinen deiner deinem ihr euch "
    "euer eure tu te toi ton ta tes vous votre vos tú ti tuyo tuya tus usted ustedes vosotros "
    "vuestro vuestra").split())
# FIXED VALUES: signs that stand for letters.
LOOKALIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b",
                           "@": "a", "$": "s", "!": "i", "|": "l", "*": None})

_WORD = re.compile(r"[^\W\d_]+")
_CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_SHOUT = re.compile(r"[A-ZÀ-ÖØ-Þ]{3,}")
_MARKS = re.compile(r"[!?]{2,}")
_SIGNS = re.compile(r"[#$%&*@~^|<>]")
_MASKED = re.compile(r"[@$*!|0-9]+[^\W\d_]")
_INNER = re.compile(r"(?<=[^\W\d_])[@$*!|0-9]+(?=[^\W\d_])")
_STRETCHED = re.compile(r"(.)\1\1")
_SPACED = re.compile(r" [^\W\d_] [^\W\d_] [^\W\d_] [^\W\d_]\b")

FEATURES = (
    "strong_density", "hit_density", "weight_density", "top_weight", "units", "hits",
    "you_near", "you_close_share", "you_rate", "capitals", "shouts", "exclamations",
    "questions", "marks", "signs", "masked", "masked_hits", "stretched", "spaced", "words",
    "word_length", "distinct", "top_share")


@dataclass
class Model:
    """A fitted scorer; without trees every score is ``share``."""
    lexicon: dict[str, float]
    trees: GBTClassificationModel | None = None
    calibration: IsotonicRegressionModel | None = None
    share: float = 0.0


def held_out(doc_id: Column) -> Column:
    """Whether labels of the row must not be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


# ---------------------------------------------------------------- features

def _units(word: str) -> Iterable[str]:
    yield word
    for n in range(3, min(len(word), 7)):
        yield "^" + word[:n]


def _cached(f: Callable, size: int = 100_000) -> Callable:
    """``f`` of a string, remembered for short strings up to a number of them."""
    known: dict[str, object] = {}

    def look(x):
        made = known.get(x)
        if made is None:
            made = f(x)
            if len(known) < size and len(x) <= 40:
                known[x] = made
        return made
    return look


def _featurer(lexicon: dict[str, float]) -> Callable[[str | None], list[float]]:
    heads = {u.lstrip("^")[:3] for u in lexicon}
    weight = _cached(lambda word: max(lexicon.get(u, 0.0) for u in _units(word)))

    def features(text):
        words = _WORD.findall((text or "").lower())
        if not words:
            return [0.0] * len(FEATURES)
        n, counts, letters = len(words), Counter(words), sum(map(len, words))
        met = [w for w in counts if w[:3] in heads]
        found = {w: x for w, x in zip(met, map(weight, met)) if x > 0}
        hits, you = sum(counts[w] for w in found), sum(counts[w] for w in SECOND_PERSON)
        near, close = _nearness(words, found) if hits and you else (0.0, 0)
        masked = [text[max(0, m.start() - 20):m.end() + 20].lower() for m in _MASKED.finditer(text)
                  if m.start() and text[m.start() - 1].isalpha()]
        return [
            sum(counts[w] for w, x in found.items() if x >= 2) / n, hits / n,
            sum(counts[w] * x for w, x in found.items()) / n, max(found.values(), default=0.0),
            log1p(len(found)), log1p(hits), near, close / max(hits, 1), you / n,
            len(_CAPITAL.findall(text)) / letters, len(_SHOUT.findall(text)) / n,
            text.count("!") / n, text.count("?") / n, len(_MARKS.findall(text)) / n,
            len(_SIGNS.findall(text)) / n, len(masked) / n,
            sum(_opened(m) for m in masked) / n,
            sum(map(str.isalpha, _STRETCHED.findall(text))) / n, len(_SPACED.findall(text)) / n,
            log1p(n), letters / n, len(counts) / n, max(counts.values()) / n]

    def _opened(around: str) -> bool:
        """Whether a hit stands behind the signs near a masked place."""
        clear = _INNER.sub(lambda m: m[0].translate(LOOKALIKE), around)
        new = set(_WORD.findall(clear)) - set(_WORD.findall(around))
        return any(w[:3] in heads and weight(w) > 0 for w in new)
    return features


def _nearness(words: list[str], found: dict[str, float]) -> tuple[float, int]:
    """1 / (1 + least distance of a hit to a second person), and hits within 5 words of one."""
    gaps: dict[int, int] = {}
    for order in (range(len(words)), range(len(words) - 1, -1, -1)):
        last = None
        for i in order:
            if words[i] in SECOND_PERSON:
                last = i
            if last is not None and words[i] in found:
                gaps[i] = min(gaps.get(i, len(words)), abs(i - last))
    return 1.0 / (1 + min(gaps.values())), sum(g <= 5 for g in gaps.values())


def _with_features(docs: DataFrame, lexicons: list[dict[str, float]], keep: list[str]) -> DataFrame:
    """``keep`` and ``features``; a column ``fold`` names the lexicon of a row."""
    def start():
        made = [_featurer(x) for x in lexicons]

        def row(text, fold, *rest):
            return (*rest, made[fold](text))
        return row
    schema = T.StructType([*docs.select(*keep).schema.fields,
                           T.StructField("features", T.ArrayType(T.DoubleType()))])
    return map_rows(docs.select("text", "fold", *keep), start, schema, chunk=64)


# ---------------------------------------------------------------- fitting

def training_rows(docs: DataFrame, labels: DataFrame, train: int = TRAIN) -> DataFrame:
    """``doc_id, text, toxic, fold, calibrates`` of at most ``train`` labelled ids."""
    part = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(13)), F.lit(FOLDS * CALIBRATE))
    picked = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
              .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()
                     & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train))
    # at most ``train`` ids: texts do not move to meet them
    return (docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
            .groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
            .select("doc_id", "text", "toxic", (part % FOLDS).cast("int").alias("fold"),
                    (part / FOLDS < 1).alias("calibrates")))


def learn_lexicon(rows: DataFrame, size: int = LEXICON) -> list[dict[str, float]]:
    """Weights of the units: one lexicon per third, without that third, then one of all."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        seen: dict[tuple[str, int, int], list[int]] = {}
        for batch in batches:
            for text, fold, toxic in zip(*(c.to_pylist() for c in batch.columns)):
                units = Counter()
                for word, n in Counter(_WORD.findall((text or "").lower())).items():
                    for unit in _units(word):
                        units[unit] += n
                for unit, n in units.items():
                    at = seen.setdefault((unit, fold, toxic), [0, 0])
                    at[0] += 1
                    at[1] += min(n, UNIT_COUNT)
        keys = list(seen)
        for lo in range(0, len(keys), 50_000):
            part = keys[lo:lo + 50_000]
            yield pa.RecordBatch.from_pydict({
                "unit": [k[0] for k in part], "fold": pa.array([k[1] for k in part], pa.int32()),
                "toxic": pa.array([k[2] for k in part], pa.int32()),
                "n_rows": [seen[k][0] for k in part], "n": [seen[k][1] for k in part]})

    counted = rows.select("text", "fold", "toxic").mapInArrow(
        count, "unit string, fold int, toxic int, n_rows bigint, n bigint")
    toxic = F.col("toxic") == 1
    per = counted.groupBy("unit").agg(
        *[F.sum(F.when((F.col("fold") == f) & (F.col("toxic") == x), F.col("n")).otherwise(0))
          .alias(f"n{x}_{f}") for f in range(FOLDS) for x in (0, 1)],
        F.sum(F.when(toxic, F.col("n_rows")).otherwise(0)).alias("toxic_rows"))
    sizes = {(r["fold"], r["toxic"]): r["n"] for r in rows.groupBy("fold", "toxic").agg(
        F.sum(F.length(F.coalesce("text", F.lit("")))).alias("n")).collect()}

    def odds(folds) -> Column:
        """Smoothed log ratio of a unit's rates in toxic and other text."""
        def rate(x):
            seen = sum((F.col(f"n{x}_{f}") for f in folds), F.lit(0))
            return (seen + 0.5) / float(sum(sizes.get((f, x), 0) for f in folds) + 1)
        return F.log(rate(1) / rate(0))

    every = range(FOLDS)
    sets = [[g for g in every if g != f] for f in every] + [list(every)]
    both = [sum((F.col(f"n{x}_{f}") for f in every), F.lit(0)) + 0.5 for x in (1, 0)]
    scored = (per.where(F.col("toxic_rows") >= UNIT_ROWS)
              .select("unit", *[odds(s).alias(f"w{i}") for i, s in enumerate(sets)],
                      (odds(every) / F.sqrt(1 / both[0] + 1 / both[1])).alias("sure"))
              .where(F.col(f"w{FOLDS}") >= UNIT_ODDS)
              .orderBy(F.desc("sure"), "unit").limit(size).collect())
    return [{r["unit"]: r[f"w{i}"] for r in scored if r[f"w{i}"] >= UNIT_ODDS}
            for i in range(FOLDS + 1)]


def fit(docs: DataFrame, labels: DataFrame, train: int = TRAIN) -> Model:
    """Fit lexicon, trees and calibration on rows that are not held out."""
    rows = cut(training_rows(docs, labels, train))
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = n.get(1, 0), sum(n.values()) - n.get(1, 0)
    share = bad / (bad + good) if bad else 0.0
    if min(bad, good) < LEAST:
        return Model({}, share=share)
    lexicons = learn_lexicon(rows)
    made = cut(_with_features(rows, lexicons, ["doc_id", "toxic", "calibrates"]))
    # ``train`` rows of a few numbers: one partition in a fixed order makes fits repeatable
    data = cut(made.select("calibrates", F.col("toxic").cast("double").alias("label"),
                           array_to_vector("features").alias("features"), "doc_id")
               .coalesce(1).sortWithinPartitions("doc_id"))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=13).fit(
        data.where(~F.col("calibrates")))
    unseen = trees.transform(data.where("calibrates")).select(
        "label", vector_to_array("probability")[1].alias("raw"))
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label").fit(unseen) \
        if unseen.agg(F.count_distinct("label")).first()[0] == 2 else None
    return Model(lexicons[-1], trees, calibration, share)


# ---------------------------------------------------------------- scoring

def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    base = docs.select("doc_id", "text", F.lit(0).alias("fold"))
    if model.trees is None:
        scored = base.select("doc_id", F.lit(float(model.share)).alias("score"))
    else:
        made = _with_features(base, [model.lexicon], ["doc_id"])
        raw = model.trees.transform(made.withColumn("features", array_to_vector("features"))) \
            .select("doc_id", vector_to_array("probability")[1].alias("raw"))
        scored = raw.withColumnRenamed("raw", "score") if model.calibration is None else \
            model.calibration.transform(raw).select("doc_id", F.col("prediction").alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
