"""Operator 2: quality classifier from weak labels.

1. Heuristic labellers vote good (1), bad (0) or abstain (-) on every
   document.
2. Expectation-maximisation over the counts of vote patterns of all documents
   (at most 3 to the number of labellers, whatever the corpus) estimates
   each labeller's accuracy on either class, and so the probability that a
   pattern is good.  No gold label is used.
3. Posterior labels of a bounded sample (the ``SAMPLE`` smallest hashes of id
   and text, each weighted by the rows that repeat it) train a logistic scorer over hashed features, which then
   scores every document.
4. A second set of labellers votes on abusive words (clean 1, abusive 0); the same
   expectation-maximisation and a second scorer give every document a clean score.
   A document is kept if both scores are at least 0.5.

Results: null, empty and blank texts have no words; every labeller abstains
on them and they are rejected (``score`` 0).  Repeated rows get equal scores; ids are
only used to draw the sample; an empty table gives no rows.  Extra columns
are kept by ``keep_good`` and ignored by ``classify``.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.llm.common import cut, map_rows

DIMENSIONS = 1 << 16
SAMPLE = 6000            # size of the training sample, in distinct documents
EM_ROUNDS = 100
START_WEIGHT = 5.0       # of a bad vote at the start: labellers call few documents bad
EPOCHS = 60
THRESHOLD = 0.5

# Frequent function words of the corpus languages.
STOP_WORDS = frozenset("""the of and to in is that was for with as on are this from by der die und das ist
nicht ein eine mit von den le la les et un une des est que pour dans pas qui el los las una en por con
se no es su de""".split())
_STOP = np.unique(np.fromiter((xxhash.xxh32_intdigest(v) for w in STOP_WORDS
                               for v in (w, w.capitalize(), w.upper())), np.uint64))
# Abusive words, by kind.
INSULTS = """idiot idiots moron morons loser losers clown clowns scum trash imbecile bastard bitch asshole
trottel dummkopf arschloch abschaum versager connard salaud ordure crétin idiota imbécil cabrón escoria
payaso basura""".split()
CONTEMPT = """stupid pathetic worthless disgusting dumb filthy despicable dumm widerlich erbärmlich wertlos
ekelhaft stupide minable débile dégoûtant pathétique estúpido estúpida patético asqueroso""".split()
_ABUSE = re.compile(r"\b(?:%s)\b" % "|".join(INSULTS + CONTEMPT))
_INSULTS = frozenset(INSULTS)
_UPPER, _LOWER = slice(65, 91), slice(97, 123)
_SYMBOLS = np.frombuffer(b"#*|$%&!@~^<>{}=+_\\", np.uint8)


class Shape:
    """Statistics of a text, and its distinct word hashes with their counts."""

    def __init__(self, text: str):
        words = text.split()
        n = self.words = len(words)
        h = np.fromiter(map(xxhash.xxh32_intdigest, words), np.uint64, n)
        self.hashes, self.counts = np.unique(h, return_counts=True)
        byte = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
        upper, lower = int(byte[_UPPER].sum()), int(byte[_LOWER].sum())
        lines = [x for x in text.split("\n") if x and not x.isspace()]
        trios = h[:-2] * np.uint64(0x9E3779B97F4A7C15) + h[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:]
        stop = np.isin(self.hashes, _STOP, assume_unique=True)
        abuse = _ABUSE.findall(text.lower())
        insults = sum(w in _INSULTS for w in abuse)
        self.abuse = {"insults": insults / n, "contempt": (len(abuse) - insults) / n,
                      "abuse": len(abuse) / n, "abuse_kinds": len(set(abuse))}
        self.stats = {
            "words": n,
            "symbols": int(byte[_SYMBOLS].sum()) / n,
            "upper": upper / max(1, upper + lower),
            "kinds": len(self.hashes) / n,
            "top": int(self.counts.max()) / n,
            "trio": 1 - len(np.unique(trios)) / max(1, n - 2) if n > 2 else 0.0,
            "stop": int(self.counts[stop].sum()) / n,
            "length": len(text) / n,
            "same_lines": 1 - len(set(lines)) / max(1, len(lines)),
            "ends": sum(x.rstrip()[-1] in ".!?\"'" for x in lines) / max(1, len(lines)),
        }


def shape(text: str | None) -> Shape | None:
    """The shape of a text; None if it has no words."""
    return Shape(text) if text and not text.isspace() else None


def _vote(good: bool, bad: bool) -> str:
    return "0" if bad else "1" if good else "-"


# Labellers: each sees one or two statistics; long texts may repeat more.
LABELLERS = {
    "symbols": lambda s: _vote(s["symbols"] < 0.10, s["symbols"] > 0.25),
    "case": lambda s: _vote(s["upper"] < 0.25, s["upper"] > 0.6),
    "variety": lambda s: ("-" if s["words"] < 20 else _vote(
        s["kinds"] > min(0.3, 30 / s["words"] ** 0.7), s["kinds"] < min(0.2, 10 / s["words"] ** 0.7))),
    "top_word": lambda s: "-" if s["words"] < 10 else _vote(s["top"] < 0.2, s["top"] > 0.3),
    "trios": lambda s: "-" if s["words"] < 20 else _vote(s["trio"] < 0.3, s["trio"] > 0.6),
    "function_words": lambda s: "-" if s["words"] < 10 else _vote(s["stop"] > 0.08, s["stop"] < 0.02),
    "word_length": lambda s: _vote(2.5 < s["length"] < 11, s["length"] < 2 or s["length"] > 15),
    "lines": lambda s: _vote(s["same_lines"] < 0.2 and s["ends"] > 0.5, s["same_lines"] > 0.4),
}


def votes(seen: Shape | None) -> str:
    """One character a labeller, in order."""
    return "-" * len(LABELLERS) if seen is None else "".join(
        [f(seen.stats) for f in LABELLERS.values()])


# Labellers of abuse: a vote against needs more than a word quoted in passing.
CLEAN_LABELLERS = {
    "insults": lambda s: _vote(s["insults"] == 0, s["insults"] > 0.004),
    "contempt": lambda s: _vote(s["contempt"] == 0, s["contempt"] > 0.004),
    "abuse": lambda s: _vote(s["abuse"] < 0.002, s["abuse"] > 0.008),
    "abuse_kinds": lambda s: _vote(s["abuse_kinds"] == 0, s["abuse_kinds"] > 1),
}


def clean_votes(seen: Shape | None) -> str:
    """One character a labeller of abuse, in order."""
    return "-" * len(CLEAN_LABELLERS) if seen is None else "".join(
        [f(seen.abuse) for f in CLEAN_LABELLERS.values()])


#: Bins of each statistic: feature "statistic is in bin i".
BINS = {
    "words": np.array([5, 10, 20, 50, 100, 200, 500, 1000, 5000]),
    "length": np.array([2, 3, 4, 5, 6, 7, 8, 10, 12, 16]),
    **{k: np.array([0.01, 0.02, 0.05, 0.08, 0.12, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.97])
       for k in ("symbols", "upper", "kinds", "top", "trio", "stop", "same_lines", "ends")},
}
ABUSE_BINS = {
    **{k: np.array([1e-9, 0.002, 0.004, 0.008, 0.015, 0.03, 0.1]) for k in ("insults", "contempt", "abuse")},
    "abuse_kinds": np.array([1, 2, 3, 5]),
}
_BIN_AT = {k: np.array([xxhash.xxh32_intdigest(f"{k}:{i}") % DIMENSIONS for i in range(len(v) + 1)])
           for k, v in {**BINS, **ABUSE_BINS}.items()}
_BIN_WEIGHT = 0.3
#: How features and their weights travel to the driver.
_AT, _WEIGHT = np.dtype("<i4"), np.dtype("<f4")


def features(seen: Shape | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features and their weights: words by share, and binned statistics."""
    if seen is None:
        return np.empty(0, np.int64), np.empty(0)
    bins = [_BIN_AT[k][np.searchsorted(v, seen.stats[k])] for k, v in BINS.items()]
    return (np.concatenate([(seen.hashes % np.uint64(DIMENSIONS)).astype(np.int64), bins]),
            np.concatenate([seen.counts / seen.words, np.full(len(bins), _BIN_WEIGHT)]))


def clean_features(seen: Shape | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of abuse and their weights: words by share, and binned statistics."""
    if seen is None:
        return np.empty(0, np.int64), np.empty(0)
    bins = [_BIN_AT[k][np.searchsorted(v, seen.abuse[k], side="right")] for k, v in ABUSE_BINS.items()]
    return (np.concatenate([(seen.hashes % np.uint64(DIMENSIONS)).astype(np.int64), bins]),
            np.concatenate([seen.counts / seen.words, np.full(len(bins), 1.0)]))


def fit_votes(patterns: dict[str, int], rounds: int = EM_ROUNDS) -> tuple[dict[str, float], np.ndarray]:
    """Posterior of the good class per pattern, and ``accuracy[labeller, class, vote]``.

    A labeller that abstains says nothing about the class.
    """
    names = sorted(patterns)
    if not names:
        return {}, np.zeros((len(LABELLERS), 2, 2))
    width = len(names[0])
    count = np.array([patterns[p] for p in names], float)
    vote = np.array([["01-".index(c) for c in p] for p in names])
    hot = np.eye(3)[vote][:, :, :2]                              # pattern, labeller, vote
    good, bad = (vote == 1).sum(1), (vote == 0).sum(1)
    q = (good + 1.0) / (good + START_WEIGHT * bad + 1.5)         # start: a weighted majority
    accuracy = np.zeros((width, 2, 2))
    for _ in range(rounds):
        for y, w in ((0, count * (1 - q)), (1, count * q)):
            seen = np.einsum("p,plv->lv", w, hot) + 1.0
            accuracy[:, y] = seen / seen.sum(1, keepdims=True)
        prior = np.clip((count * q).sum() / count.sum(), 1e-3, 1 - 1e-3)
        logs = np.einsum("plv,lyv->py", hot, np.log(accuracy)) + np.log([1 - prior, prior])
        q = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -50, 50)))
    return dict(zip(names, q)), accuracy


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray, float]], epochs: int = EPOCHS,
               times: list[int] | None = None) -> np.ndarray:
    """Weights (bias last) of a logistic scorer on soft labels, by full-batch Adagrad.

    ``times`` says how many rows each of ``rows`` stands for (one, if not given).
    """
    w = np.zeros(DIMENSIONS + 1)
    if not rows:
        return w
    at = np.concatenate([r[0] for r in rows])
    x = np.concatenate([r[1] for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    y = np.array([r[2] for r in rows])
    # Either class weighs the same, however rare it is.
    many = np.ones(len(rows)) if times is None else np.array(times, float)
    share = np.clip((y * many).sum() / many.sum(), 1e-3, 1 - 1e-3)
    importance = many * (y / share + (1 - y) / (1 - share))
    importance /= importance.sum()
    g2 = np.full(DIMENSIONS + 1, 1e-8)
    for _ in range(epochs):
        z = np.bincount(row, x * w[at], len(rows)) + w[-1]
        miss = (1 / (1 + np.exp(-z)) - y) * importance
        g = np.append(np.bincount(at, x * miss[row], DIMENSIONS), miss.sum()) + 1e-6 * w
        g2 += g * g
        w -= 0.5 * g / np.sqrt(g2)
    return w


def score(seen: Shape | None, w: np.ndarray) -> float:
    at, x = features(seen)
    return float(1 / (1 + np.exp(-(x @ w[at] + w[-1])))) if len(at) else 0.0


def clean_score(seen: Shape | None, w: np.ndarray) -> float:
    at, x = clean_features(seen)
    return float(1 / (1 + np.exp(-(x @ w[at] + w[-1])))) if len(at) else 0.0


class Model:
    """A fitted classifier: pattern posteriors, labeller accuracies, weights of both scorers."""

    def __init__(self, posterior: dict[str, float], accuracy: np.ndarray, weights: np.ndarray,
                 clean: np.ndarray):
        self.posterior, self.accuracy, self.weights, self.clean = posterior, accuracy, weights, clean

    def keeps(self, seen: Shape | None, threshold: float) -> bool:
        return score(seen, self.weights) >= threshold and clean_score(seen, self.clean) >= threshold


def draw(docs: DataFrame, key: str, text_col: str, sample: int) -> DataFrame:
    """Text and number of rows ``n`` of the ``sample`` distinct documents of the smallest hashes."""
    hashed = docs.select(text_col, F.xxhash64(key, text_col, F.lit("quality sample")).alias("_draw"))
    counted = cut(hashed.groupBy("_draw").agg(F.count(F.lit(1)).alias("n")))
    total = counted.count()
    # Half as many again as wanted are sorted, not the whole table in one task.
    share = min(1.0, 1.5 * sample / max(1, total))
    below = counted if share == 1.0 else counted.where(
        F.col("_draw") < int(-(1 << 63) + share * (1 << 64)))
    few = F.broadcast(cut(below.orderBy("_draw").limit(sample)))
    return (hashed.join(few, "_draw").groupBy("_draw")
            .agg(F.first(text_col).alias(text_col), F.first("n").alias("n")).select(text_col, "n"))


def fit(docs: DataFrame, key: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    """Fit on ``docs``: vote patterns of all rows, the scorer on a bounded sample."""
    def both(t):
        seen = shape(t)
        return votes(seen), clean_votes(seen)
    names = T.StructType([T.StructField("pattern", T.StringType()), T.StructField("clean", T.StringType())])
    counted = (map_rows(docs.select(text_col), lambda: both, names)
               .groupBy("pattern", "clean").count().collect())   # at most 3 ** (labellers of both) rows
    fitted = []
    for name in ("pattern", "clean"):
        patterns: dict[str, int] = {}
        for r in counted:
            if set(r[name]) != {"-"}:
                patterns[r[name]] = patterns.get(r[name], 0) + r["count"]
        fitted.append(fit_votes(patterns))
    (posterior, accuracy), (clean, _) = fitted
    drawn = draw(docs, key, text_col, sample)

    def start():
        def row(t, n):
            seen = shape(t)
            at, x = features(seen)
            clean_at, clean_x = clean_features(seen)
            # The words of both are the same and come first.
            words = len(at) - len(BINS) if seen else 0
            return (n, *both(t), *[v.astype(kind).tobytes() for v, kind in (
                (at, _AT), (x, _WEIGHT), (clean_at[words:], _AT), (clean_x[words:], _WEIGHT))])
        return row
    # Packed: as arrays, every number of the sample would be an object on the driver, in the JVM and in Python.
    schema = T.StructType([T.StructField("n", T.LongType()), *names.fields,
                           *[T.StructField(c, T.BinaryType()) for c in ("at", "x", "clean_at", "clean_x")]])
    rows = map_rows(drawn, start, schema).collect()

    def unpacked(r, clean_too: bool) -> tuple[np.ndarray, np.ndarray]:
        at, x = np.frombuffer(r["at"], _AT), np.frombuffer(r["x"], _WEIGHT)
        if clean_too:
            at = np.concatenate([at[:-len(BINS)], np.frombuffer(r["clean_at"], _AT)])
            x = np.concatenate([x[:-len(BINS)], np.frombuffer(r["clean_x"], _WEIGHT)])
        return at.astype(np.int64), x.astype(float)
    weights = []
    for name, soft in (("pattern", posterior), ("clean", clean)):
        t = [(*unpacked(r, name == "clean"), soft[r[name]], r["n"]) for r in rows if r[name] in soft]
        t.sort(key=lambda r: (len(r[0]), r[0].tobytes(), r[1].tobytes(), r[3]))
        weights.append(fit_scorer([r[:3] for r in t], times=[r[3] for r in t]))
    return Model(posterior, accuracy, *weights)


def classify(docs: DataFrame, model: Model, key: str = "doc_id", text_col: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """``key``, ``votes``, ``posterior`` (null where no labeller voted), ``score``, ``kept``."""
    posterior = model.posterior

    def start():
        def row(k, t):
            seen = shape(t)
            v, s = votes(seen), score(seen, model.weights)
            return k, v, posterior.get(v), s, model.keeps(seen, threshold)
        return row
    schema = T.StructType([docs.schema[key], T.StructField("votes", T.StringType()),
                           T.StructField("posterior", T.DoubleType()),
                           T.StructField("score", T.DoubleType()),
                           T.StructField("kept", T.BooleanType())])
    return map_rows(docs.select(key, text_col), start, schema)


def keep_good(docs: DataFrame, key: str = "doc_id", text_col: str = "text",
              threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier fitted on them keeps."""
    model = fit(docs, key, text_col)
    i = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            keep = [model.keeps(shape(t), threshold) for t in b.column(i).to_pylist()]
            yield b.filter(pa.array(keep, pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
