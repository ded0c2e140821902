"""Operator 7: near-duplicates by a chosen-path set similarity join.

Documents with equal shingle sets are first collapsed into one
representative, named by a 64-bit hash of the set and not by an id, which may
stand on several sets (a grouped minimum, however large the group).  Each
representative gets ``SKETCH`` minwise tokens.  ``TREES`` independent trees
branch the representatives recursively: a node's members are divided twice,
by the minwise tokens at two positions that the node's own hash names, so
that nodes branch independently and a pair at the threshold keeps 1.5 paths
a level on average.  A node whose members are all connected is finished.
Else,

* in a node of at most ``SMALL`` members all sketches are compared: first
  the strongest pairs that would connect it are confirmed, then every other
  pair whose ends are still apart;
* in a larger node every member is compared with the smallest one (linear in
  the node), and if that doesn't connect it, it branches on until its parts
  are small or connected, however many levels that takes.

A component takes its smallest ``doc_id`` for a name once all links are found.

Only links' connectivity is asked for, so no group of copies is expanded
into its pairs, and no node is cut short.  A sketch holds one byte of each
token.  Pairs that share fewer than ``SCREEN`` of them are left out (a pair
at the threshold falls below with probability 1e-4); the others are
confirmed on their full sets of 64-bit shingle hashes.  With eight trees a pair at similarity 0.75
misses all first-level nodes with probability 1.5e-5.  Below a node that it shares all its
paths end with probability 1/9 at most, the root of q = (0.25 + 0.75 q)^2, so it misses all
trees with probability (1 - 0.75 * 8/9)^8 = 1.5e-4, however deep the nodes go.  The
price is two paths a level for every member of a node that stays large and unconnected.

Results: texts that are null, empty or only white space have an empty set
and stand alone.  Rows with a null ``doc_id`` are returned with a null
component and not kept, and link with nothing.  Repeated rows each get a row;
rows that repeat an id with other texts are judged by their own text.  Extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.llm.common import counted, cut, map_rows, unused
from tremor.llm.components import components
from tremor.session import release

WORDS = 5
PERCENT = 75
SKETCH = 512
TREES = 8
SMALL = 4096
SCREEN = 348
#: Counted rows of one or two ids up to which they are broadcast (under 8 MB); else they shuffle.
BROADCAST_ROWS = 200_000
#: Full sets that one task is given, where their number is known.
SETS_A_TASK = 2_000
_BLOCK = 256
_ROWS = 64               # members compared with all others of a node at a time
_MIX = np.random.default_rng(20240531).integers(1 << 62, 1 << 63, size=SKETCH + WORDS + 1,
                                                dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles."""
    parts = (text or "").encode().lower().split()      # bytes: only A to Z, ASCII white space
    if not parts:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, parts), np.uint64, len(parts))
    k = min(words, len(parts))
    n = len(parts) - k + 1
    out = np.full(n, k, np.uint64) * _MIX[-1]
    for i in range(k):
        out += h[i:i + n] * _MIX[SKETCH + i]
    out ^= out >> np.uint64(31)
    out *= _MIX[-1]
    out ^= out >> np.uint64(29)
    return np.unique(out)


def minwise(values: np.ndarray) -> np.ndarray:
    """The smallest image of the set under each of ``SKETCH`` multiplicative orders."""
    out = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(values), _BLOCK):
        np.minimum(out, np.multiply.outer(values[lo:lo + _BLOCK], _MIX[:SKETCH]).min(axis=0), out)
    return out


def _split(tokens: np.ndarray) -> tuple[np.ndarray, bytes]:
    """The first tokens whole, for the trees' first level, and a byte of each."""
    return tokens[:TREES].view(np.int64), (tokens >> np.uint64(32)).astype(np.uint8).tobytes()


def _sketches(docs: DataFrame, key: str, text_col: str, *more: str) -> DataFrame:
    """Set and sketch of every row, with the columns ``more`` as they are."""
    def start():
        def row(k, text, *rest):
            values = shingle_set(text)
            if not len(values):
                return k, 0, None, None, None, *rest
            return (k, len(values), xxhash.xxh3_128_digest(values.tobytes()),
                    *_split(minwise(values)), *rest)
        return row
    schema = T.StructType([T.StructField("doc_id", docs.schema[key].dataType),
                           T.StructField("n_shingles", T.LongType()),
                           T.StructField("set_id", T.BinaryType()),
                           T.StructField("first", T.ArrayType(T.LongType())),
                           T.StructField("sketch", T.BinaryType()),
                           *[docs.schema[c] for c in more]])
    return map_rows(docs.select(key, text_col, *more), start, schema)


def _sets(docs: DataFrame, text_col: str) -> DataFrame:
    def start():
        def row(text):
            values = shingle_set(text)
            return xxhash.xxh3_128_digest(values.tobytes()), values.view(np.int64)
        return row
    schema = T.StructType([T.StructField("set_id", T.BinaryType()),
                           T.StructField("shingles", T.ArrayType(T.LongType()))])
    return map_rows(docs.select(text_col), start, schema, chunk=64)


def _sized(rows: DataFrame, n: int) -> DataFrame:
    """``rows`` of one or two ids, marked for broadcast if their counted number is small."""
    return F.broadcast(rows) if n <= BROADCAST_ROWS else rows


class _Links:
    """Links confirmed so far, and the sets that confirming them needed."""

    def __init__(self, docs: DataFrame, reps: DataFrame, key: str, text_col: str):
        self.docs, self.reps, self.key, self.text_col = docs, reps, key, text_col
        spark = docs.sparkSession
        self.short = reps.select("rep", F.col("sketch").alias("s"))
        self.sets = spark.createDataFrame([], "rep bigint, shingles array<bigint>")
        self.found = spark.createDataFrame([], "a bigint, b bigint")
        self.labels = spark.createDataFrame([], "node bigint, component bigint")

    def screened(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose sketches agree enough."""
        both = (pairs.join(self.short.withColumnsRenamed({"rep": "a", "s": "sa"}), "a")
                .join(self.short.withColumnsRenamed({"rep": "b", "s": "sb"}), "b"))

        def start():
            def row(a, b, sa, sb):
                same = np.frombuffer(sa, np.uint8) == np.frombuffer(sb, np.uint8)
                return a, b, int(same.sum()) >= SCREEN
            return row
        schema = T.StructType([pairs.schema["a"], pairs.schema["b"],
                               T.StructField("agree", T.BooleanType())])
        return map_rows(both.select("a", "b", "sa", "sb"), start, schema).where("agree").select("a", "b")

    def prepare(self, reps: DataFrame) -> None:
        """Build the sets of the representatives ``reps`` (column ``rep``) that are not there yet."""
        missing, n = counted(reps.distinct().join(self.sets.select("rep"), "rep", "left_anti"))
        if not n:
            return
        own = self.reps.select("rep", "set_id", "head").join(_sized(missing, n), "rep", "left_semi")
        heads = own.select(F.col("head").alias(self.key)).distinct()
        texts = self.docs.select(self.key, self.text_col).join(_sized(heads, n), self.key, "left_semi")
        # An id may stand on several texts; the representatives' sets are meant.
        built = (_sets(texts, self.text_col).join(_sized(own.select("rep", "set_id"), n), "set_id")
                 .select("rep", "shingles").dropDuplicates(["rep"]))
        self.sets = self.sets.unionByName(counted(built, SETS_A_TASK)[0])
        release(self.docs.sparkSession)                # the driver's copies of what that broadcast

    def confirm(self, pairs: DataFrame, later: DataFrame | None = None) -> bool:
        """Judge candidate pairs on full sets; True if the components changed.

        ``later`` names representatives whose sets further levels may need; they are
        built in the same pass over the texts.
        """
        pairs, n = counted(pairs.distinct())
        if not n:
            return False
        ends = pairs.select(F.col("a").alias("rep")).union(pairs.select("b"))
        self.prepare(ends if later is None else ends.union(later))
        # Only one end's set moves with each pair; the other is met where its document is.
        held = self.sets.join(_sized(pairs, n), F.col("rep") == F.col("a")).select(
            "a", "b", F.col("shingles").alias("sa"))
        ends = self.sets.join(_sized(pairs.select(F.col("b").alias("rep")), n), "rep", "left_semi")
        both = held.join(ends.select(F.col("rep").alias("b"), F.col("shingles").alias("sb")), "b")
        linked, n = counted(both.withColumn("i", F.size(F.array_intersect("sa", "sb")))
                            .where(100 * F.col("i") >= PERCENT * (F.size("sa") + F.size("sb") - F.col("i")))
                            .select("a", "b"))
        if not n:
            return False
        self.found = self.found.unionByName(linked)
        self.labels = components(self.found, "a", "b")
        return True

    def label(self, paths: DataFrame) -> DataFrame:
        """Paths with their representative's component so far."""
        return (paths.drop("component")
                .join(self.labels.withColumnRenamed("node", "rep"), "rep", "left")
                .withColumn("component", F.coalesce("component", "rep")))


def _branch(open_paths: DataFrame, reps: DataFrame, steps: int = 1) -> DataFrame:
    """Divide open nodes by the minwise tokens at two positions of the node's own, ``steps`` times."""
    at = open_paths.join(reps.select("rep", "sketch"), "rep")
    for _ in range(steps):
        first = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(SKETCH))
        second = F.pmod(first + 1 + F.pmod(F.xxhash64("node", F.lit(2)), F.lit(SKETCH - 1)),
                        F.lit(SKETCH))
        at = at.withColumn("place", F.explode(F.array(first, second)))
        token = F.substring("sketch", F.col("place").cast("int") + 1, F.lit(1))
        at = at.withColumn("node", F.xxhash64("node", "place", token))
    return at.select("tree", "node", "rep", "component")


def _open(paths: DataFrame) -> DataFrame:
    """Paths in nodes whose members are not all connected, with the node's size and pivot."""
    nodes, _ = counted(paths.groupBy("node")
                       .agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("pivot"),
                            F.min_by("component", "rep").alias("pivot_component"),
                            F.min("component").alias("lo"), F.max("component").alias("hi"))
                       .where("lo <> hi").drop("lo", "hi"))
    return counted(paths.join(nodes, "node"))[0]


def _agreeing(tokens: np.ndarray, rows: int) -> np.ndarray:
    """Tokens that each of the first ``rows`` members shares with every member.

    ``tokens`` has a row per minwise order, so each step runs over neighbours in memory.
    """
    shared = np.zeros((rows, tokens.shape[1]), np.uint16)
    same = np.empty(shared.shape, np.bool_)
    for lo in range(0, len(tokens), 128):              # counts that fit a byte
        part = np.zeros(shared.shape, np.uint8)
        for t in tokens[lo:lo + 128]:
            np.equal(t[:rows, None], t, out=same)
            part += same.view(np.uint8)
        shared += part
    return shared


def strongest_forest(a: np.ndarray, b: np.ndarray, strength: np.ndarray, n: int) -> np.ndarray:
    """Places of the pairs ``(a, b)`` of a maximum spanning forest over ``n`` components.

    In each round every component takes its strongest pair, the first of equals.
    """
    at = np.argsort(-strength.astype(np.int16), kind="stable")
    a, b = a[at], b[at]
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x
    out = []
    while len(at):
        place = np.arange(len(at))[::-1]
        best, other = np.full(n, len(at)), np.full(n, len(at))
        best[a[::-1]] = place                          # of repeated indexes the last, least one stays
        other[b[::-1]] = place
        taken = np.unique(np.minimum(best, other))
        for k in taken[taken < len(at)].tolist():
            x, y = find(int(a[k])), find(int(b[k]))
            if x != y:
                parent[x] = y
                out.append(int(at[k]))
        root = np.array([find(x) for x in range(n)], a.dtype)
        a, b = root[a], root[b]
        apart = a != b
        a, b, at = a[apart], b[apart], at[apart]
    return np.array(out, np.int64)


def node_pairs(comps: list, sketches: np.ndarray, forest: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (by place) of a node whose sketches agree enough and that are not connected.

    With ``forest`` only the strongest pairs that would connect the members.
    """
    number = {c: i for i, c in enumerate(dict.fromkeys(comps))}
    comp = np.array([number[c] for c in comps], np.int32)
    tokens = np.ascontiguousarray(sketches.T)
    left, right, strength = [], [], []
    for lo in range(0, len(comp), _ROWS):
        shared = _agreeing(tokens[:, lo:], min(_ROWS, len(comp) - lo))
        apart = comp[lo:lo + _ROWS, None] != comp[lo:]
        i, j = np.nonzero(np.triu((shared >= SCREEN) & apart, 1))
        left.append((i + lo).astype(np.int32))
        right.append((j + lo).astype(np.int32))
        strength.append(shared[i, j])
    i, j = np.concatenate(left), np.concatenate(right)
    if forest:
        k = strongest_forest(comp[i], comp[j], np.concatenate(strength), len(number))
        i, j = i[k], j[k]
    return i, j


def first_meetings(i: np.ndarray, j: np.ndarray, node: int, nodes: list[list]) -> np.ndarray:
    """Which pairs' ends, by place, share no node before ``node``; ``nodes`` has each member's."""
    new = np.ones(len(i), bool)
    before = [[x for x in held if x < node] for held in nodes]
    for k in range(max(map(len, before), default=0)):
        # Members' k-th earlier node against all earlier nodes of the other end.
        has = np.array([len(held) > k for held in before])
        at = np.array([held[k] if len(held) > k else 0 for held in before], np.int64)
        for m in range(max(map(len, before))):
            there = np.array([len(held) > m for held in before])
            other = np.array([held[m] if len(held) > m else 0 for held in before], np.int64)
            new &= ~(has[i] & there[j] & (at[i] == other[j]))
    return new


def _small_pairs(small: DataFrame, links: _Links, forest: bool) -> DataFrame:
    """Candidate pairs within nodes of at most ``SMALL`` members.

    Without ``forest`` a pair comes once, from the first of the nodes that its ends share.
    """
    member = F.struct("rep", "component", "s", "nodes")
    paths = small.select("node", "rep", "component")
    if forest:
        paths = paths.withColumn("nodes", F.array().cast("array<bigint>"))
    else:
        held = paths.groupBy("rep").agg(F.sort_array(F.collect_set("node")).alias("nodes"))
        paths = paths.join(held, "rep")
    nodes = (paths.join(links.short, "rep").groupBy("node")
             .agg(F.array_sort(F.collect_list(member)).alias("m")))
    # Trees often hold the same members in a node; one of them is enough.
    same = F.xxhash64(F.transform("m", lambda x: x["rep"]))
    nodes = nodes.groupBy(same.alias("k"), F.size("m").alias("n")).agg(
        F.min("node").alias("node"), F.first("m").alias("m"))
    ids = T.ArrayType(small.schema["rep"].dataType)

    def start():
        def row(node, members):
            reps = [m["rep"] for m in members]
            sketches = np.frombuffer(b"".join([m["s"] for m in members]), np.uint8).reshape(-1, SKETCH)
            i, j = node_pairs([m["component"] for m in members], sketches, forest)
            new = first_meetings(i, j, node, [m["nodes"] for m in members])
            i, j = i[new], j[new]
            return [reps[x] for x in i.tolist()], [reps[x] for x in j.tolist()]
        return row
    schema = T.StructType([T.StructField("a", ids), T.StructField("b", ids)])
    return (map_rows(nodes.select("node", "m"), start, schema, chunk=4)
            .select(F.explode(F.arrays_zip("a", "b")).alias("p")).select("p.a", "p.b"))


def _grouped(rows: DataFrame, docs: DataFrame, key: str, text_col: str) -> DataFrame:
    """``set_id``, ``component`` and the component's smallest id ``head`` of every distinct set."""
    reps = cut(rows.where("set_id is not null and doc_id is not null").groupBy("set_id")
               .agg(F.min("doc_id").alias("head"), F.first("first").alias("first"),
                    F.first("sketch").alias("sketch"))
               .withColumn("rep", F.xxhash64("set_id")))
    links = _Links(docs, reps, key, text_col)
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))
    paths = (reps.withColumn("tree", tree)
             .select("tree", F.xxhash64("tree", F.get("first", "tree")).alias("node"), "rep",
                     F.col("rep").alias("component")))
    columns = ["tree", "node", "rep", "component"]
    reps_left = reps
    for level in range(1, SKETCH + 1):
        release(docs.sparkSession)
        paths = _open(paths)
        star = paths.where(F.col("n") > SMALL).where("component <> pivot_component").select(
            F.col("pivot").alias("a"), F.col("rep").alias("b"))
        first = _small_pairs(paths.where(F.col("n") <= SMALL), links, forest=True)
        members = paths.where(F.col("n") > SMALL).select("rep")
        if links.confirm(first.union(links.screened(star.distinct())), members):
            paths = _open(links.label(paths.select(columns)))
        large = paths.where(F.col("n") > SMALL).select(columns)
        if links.confirm(_small_pairs(paths.where(F.col("n") <= SMALL), links, forest=False)):
            large = links.label(large)
        if level == SKETCH or large.isEmpty():
            break
        # Only members of open nodes go on, so only their sketches do.
        reps_left = cut(reps_left.join(large.select("rep").distinct(), "rep", "left_semi"))
        links.short = reps_left.select("rep", F.col("sketch").alias("s"))
        # Few paths are open after the first division: two levels a pass from then on.
        paths = _branch(large, reps_left, min(level, 2))
    centres = links.labels.select("component").distinct()
    linked = links.labels.union(centres.select("component", "component")).withColumnRenamed("node", "rep")
    heads, n = counted(linked.join(reps.select("rep", "head"), "rep").groupBy("component")
                       .agg(F.min("head").alias("least")))
    named = linked.join(_sized(heads, n), "component")
    return (reps.select("set_id", "rep", "head").join(named, "rep", "left")
            .select("set_id", F.coalesce("component", "rep").alias("component"),
                    F.coalesce("least", "head").alias("head")))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` of every row of ``docs``."""
    rows = cut(_sketches(docs, key, text_col))
    joined = rows.select("doc_id", "n_shingles", "set_id").join(
        _grouped(rows, docs, key, text_col), "set_id", "left")
    component = F.coalesce("head", "doc_id")
    return joined.select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def keep_first(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each near-duplicate group: the smallest id's.

    Rows without an id are kept.  Where the smallest id stands on several texts of the
    group, the one with the smallest hash stays.  Texts without words stand alone, once
    per id and text; of rows that repeat an id and text the one with the smallest SHA-256
    of its JSON stays, so columns may have any type that JSON has, and any name.
    """
    mark = unused(docs, "_text")
    marked = docs.withColumn(mark, F.xxhash64(text_col))
    rows = cut(_sketches(marked, key, text_col, mark))
    seen = cut(rows.where("doc_id is not null").groupBy("doc_id", mark)
               .agg(F.first("set_id").alias("set_id"), F.count(F.lit(1)).alias("n")))
    member = seen.join(_grouped(rows, docs, key, text_col), "set_id").select(
        "component", F.struct("doc_id", mark).alias("row"))
    first, n = counted(member.groupBy("component")
                       .agg(F.min("row").alias("least"), F.count(F.lit(1)).alias("n"))
                       .where("n > 1").drop("n"))
    away, n = counted(member.join(_sized(first, n), "component").where("row <> least")
                      .select(F.col("row.doc_id").alias(key), F.col("row")[mark].alias(mark)))
    left = marked.join(_sized(away, n), [key, mark], "left_anti")
    again, n = counted(seen.where("n > 1").select(F.col("doc_id").alias(key), mark))
    if n:
        again = _sized(again, n)
        row = F.struct(*docs.columns)
        once = (left.join(again, [key, mark], "left_semi").groupBy(key, mark)
                .agg(F.min_by(row, F.sha2(F.to_json(row), 256)).alias(unused(marked, "_row")))
                .select(F.col(unused(marked, "_row") + ".*")))
        left = left.join(again, [key, mark], "left_anti").select(*docs.columns).unionByName(once)
    return left.select(*docs.columns)
