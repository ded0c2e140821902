"""Operator 11: conversation structure repair by a run-length min-plus programme.

A conversation's turns should read ``(s?(ua)+)?`` by role initial.  Every row
becomes one symbol (role initial and fault), equal consecutive symbols become
one run, and a run of length n advances the vector of cheapest costs to go by
the cached powers M, M^2, M^4, ... of its symbol's min-plus matrix.  The
choices are then unrolled from the front, which gives the edit string.

Distribution: rows travel as symbols, never as texts, until the very end.
Equal rows are counted together before any shuffle.  The symbols are range
partitioned by (conversation, turn) and sorted, so a conversation that holds a
third of all rows spreads over many tasks, each of which streams its part and
emits runs.  Only the runs of a conversation meet in one task; they are never
longer than the edit string that the result must hold.  At the end texts and
edit string stream through one task per conversation in order (a hash of the
whole conversation needs that), a batch at a time.

Defined cases: a null role or text counts as one space; a null conversation id
is a conversation of its own; a null turn comes first; rows of one turn are
ordered by role, then by the text's SHA-256; rows that repeat a role and text
are duplicates of the first; a conversation without rows has zeros and an
empty edit string; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tremor.llm.common import cut, map_rows
from tremor.session import shuffle_partitions

# Costs of the edits; a truncated row that stays adds TRUNCATED.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
# A block of runs ends after this many rows, a stretch of choices after this many edits.
BLOCK, STRETCH = 65_536, 4_096

_INF = 1 << 60
# States by what was put out last: nothing, system, user, assistant.
_STATES = range(4)
_ACCEPT = (0, _INF, _INF, 0)
_NEXT = (2, 2, 3, 2)                       # state after an inserted or re-roled turn
_KEEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}

Vector = tuple[int, ...]


def _times(matrix: list[Vector], vector: Vector) -> Vector:
    return tuple(min(row[k] + vector[k] for k in _STATES) for row in matrix)


def _product(a: list[Vector], b: list[Vector]) -> list[Vector]:
    return [tuple(min(row[k] + b[k][j] for k in _STATES) for j in _STATES) for row in a]


def _inserts() -> list[Vector]:
    """Cheapest costs by inserts alone (two reach every state that inserts reach)."""
    once = [tuple(0 if j == i else INSERT if j == _NEXT[i] else _INF for j in _STATES)
            for i in _STATES]
    return _product(once, once)


def _choices(symbol: str, state: int) -> Iterator[tuple[str, int, int]]:
    """``(edit, cost, next state)`` that take one row, in ASCII order.  Upper case: truncated."""
    yield "D", DELETE, state
    if symbol != "-":
        extra = TRUNCATED if symbol.isupper() else 0
        kept = _KEEP.get(symbol.lower(), {}).get(state)
        if kept is not None:
            yield "K", extra, kept
        yield "R", REROLE + extra, _NEXT[state]


class Steps:
    """Min-plus matrices of the symbols and their binary powers, each made once."""

    def __init__(self) -> None:
        self.inserts = _inserts()
        self.end = _times(self.inserts, _ACCEPT)
        self.powers: dict[tuple[str, int], list[Vector]] = {}

    def power(self, symbol: str, bit: int) -> list[Vector]:
        """The matrix of ``2 ** bit`` rows of ``symbol``."""
        made = self.powers.get((symbol, bit))
        if made is None:
            if bit:
                half = self.power(symbol, bit - 1)
                made = _product(half, half)
            else:
                row = [[_INF] * 4 for _ in _STATES]
                for i in _STATES:
                    for _, cost, j in _choices(symbol, i):
                        row[i][j] = min(row[i][j], cost)
                made = _product(self.inserts, [tuple(r) for r in row])
            self.powers[symbol, bit] = made
        return made

    def back(self, symbol: str, n: int, after: Vector) -> Vector:
        """Costs to go before ``n`` rows of ``symbol``, given those after them."""
        bit = 0
        while n:
            if n & 1:
                after = _times(self.power(symbol, bit), after)
            n, bit = n >> 1, bit + 1
        return after

    def solve(self, runs: list[tuple[str, int]]) -> tuple[int, str]:
        """``(cost, edits)`` of the cheapest repair; of equal ones the ASCII-least."""
        togo = [self.end]
        for symbol, n in reversed(runs):
            togo.append(self.back(symbol, n, togo[-1]))
        togo.reverse()
        out, state = [], 0
        for (symbol, n), after in zip(runs, togo[1:]):
            if symbol == "-":       # D is the least edit, and the only one that takes such a row
                out.append("D" * n)
                continue
            for lo in range(0, n, STRETCH):
                part = min(STRETCH, n - lo)
                ahead = [self.back(symbol, n - lo - part, after)]
                for _ in range(part):
                    ahead.append(_times(self.power(symbol, 0), ahead[-1]))
                for k in range(part, 0, -1):
                    edits, state = self._take(symbol, state, ahead[k], ahead[k - 1])
                    out.append(edits)
        while _ACCEPT[state]:
            out.append("I")
            state = _NEXT[state]
        return togo[0][0], "".join(out)

    def _take(self, symbol: str, state: int, now: Vector, then: Vector) -> tuple[str, int]:
        """The least edits that take one row at the cheapest cost, and the state after them."""
        edits = ""
        while True:
            fits = {e: j for e, cost, j in _choices(symbol, state) if cost + then[j] == now[state]}
            if "D" not in fits and INSERT + now[_NEXT[state]] == now[state]:
                edits, state = edits + "I", _NEXT[state]
                continue
            edit = min(fits)
            return edits + edit, fits[edit]


# ---------------------------------------------------------------- rows to symbols

def _filled(c: Column) -> Column:
    return F.coalesce(c, F.lit(" "))


def damage(rows: DataFrame) -> DataFrame:
    """Rows with planted faults, chosen by crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 removes its sentence marks, 3
    repeats it, 4 makes the role ``user``.  Nulls count as one space.
    """
    key = F.concat(_filled(F.col("conv_id").cast("string")), F.lit(":"),
                   _filled(F.col("turn").cast("string")))
    text = _filled(F.col("text"))
    return (rows.select("conv_id", "turn", _filled(F.col("role")).alias("role"),
                        text.alias("text"), (F.crc32(key) % 20).alias("_kind"))
            .where(F.col("_kind") != 0)
            .withColumn("role", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")))
            .withColumn("text", F.when(F.col("_kind") == 1, "")
                        .when(F.col("_kind") == 2, F.translate("text", ".!?", ""))
                        .otherwise(F.col("text")))
            .withColumn("_again", F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1)))
                                            .otherwise(F.array(F.lit(0)))))
            .drop("_kind", "_again"))


def _hashed(rows: DataFrame) -> DataFrame:
    return rows.select("conv_id", "turn", _filled(F.col("role")).alias("role"),
                       _filled(F.col("text")).alias("text")) \
               .withColumn("sha", F.unhex(F.sha2("text", 256)))


_ORDER = ["conv_id", "turn", "role", "sha"]

_BLOCK_FIELDS = [("symbols", "string"), ("lengths", "array<bigint>"), ("blank", "bigint"),
                 ("duplicate", "bigint"), ("truncated", "bigint"), ("illegal", "bigint"),
                 ("first_role", "string"), ("last_role", "string"), ("min_turn", "bigint"),
                 ("max_turn", "bigint"), ("first_turn", "bigint"), ("last_turn", "bigint"),
                 ("turns", "bigint")]
_BLOCK = ", ".join(f"{n} {t}" for n, t in _BLOCK_FIELDS)


def _symbols(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, initial, symbol, first, n``: equal rows counted, in order, cut."""
    text = F.col("text")
    seen = (_hashed(rows)
            .withColumn("blank", ~text.rlike(r"[^\x20\x09-\x0D]"))
            .withColumn("open", ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z"))
            .groupBy(*_ORDER, "blank", "open").agg(F.count(F.lit(1)).alias("n")))
    # Only what occurs at several turns needs a look at the other turns.
    firsts = (seen.where(~F.col("blank")).groupBy("conv_id", "role", "sha")
              .agg(F.count(F.lit(1)).alias("_times"), F.min(F.struct("turn")).alias("_first"))
              .where(F.col("_times") > 1)
              .select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"),
                      F.col("sha").alias("_sha"), F.col("_first.turn").alias("_first"),
                      F.lit(True).alias("_several")))
    joined = seen.join(firsts, F.col("conv_id").eqNullSafe(F.col("_conv"))
                       & (F.col("role") == F.col("_role")) & (F.col("sha") == F.col("_sha")), "left")
    first = F.col("_several").isNull() | F.col("turn").eqNullSafe(F.col("_first"))
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    symbol = (F.when(F.col("blank"), "-").when(~first, "=")
              .when(F.col("open"), F.upper(known)).otherwise(known))
    n = shuffle_partitions(rows.sparkSession)
    return cut(joined.select(*_ORDER, initial.alias("initial"), symbol.alias("symbol"), "n")
               .repartitionByRange(n, *_ORDER).sortWithinPartitions(*_ORDER)
               .select("conv_id", F.col("turn").cast("long").alias("turn"), "initial", "symbol", "n"))


class _Block:
    """Runs and counts of consecutive rows of one conversation."""

    def __init__(self) -> None:
        self.symbols, self.lengths, self.rows = [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_role = self.last_role = None
        self.min_turn = self.max_turn = self.first_turn = self.last_turn = None

    def run(self, symbol: str, n: int) -> None:
        if n and self.symbols and self.symbols[-1] == symbol:
            self.lengths[-1] += n
        elif n:
            self.symbols.append(symbol)
            self.lengths.append(n)

    def add(self, turn, initial: str, symbol: str, n: int) -> None:
        if symbol in "-=":
            self.run("-", n)
        else:
            self.run(symbol, 1)
            self.run("-", n - 1)
        self.blank += n * (symbol == "-")
        self.duplicate += n * (symbol == "=") + (n - 1) * (symbol not in "-=")
        self.truncated += symbol.isupper()
        if self.rows:
            self.illegal += _illegal(self.last_role, initial)
        else:
            self.first_role, self.first_turn = initial, turn
        self.illegal += n - 1
        if turn is not None:
            self.turns += not self.rows or turn != self.last_turn
            self.min_turn = turn if self.min_turn is None else min(turn, self.min_turn)
            self.max_turn = turn if self.max_turn is None else max(turn, self.max_turn)
        self.last_role, self.last_turn = initial, turn
        self.rows += 1

    def fields(self) -> tuple:
        return ("".join(self.symbols), self.lengths, *(getattr(self, n) for n, _ in _BLOCK_FIELDS[2:]))


def _illegal(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au")


def _blocks(placed: DataFrame) -> DataFrame:
    """One row per block of a conversation: where it starts, its runs and counts."""
    tagged = placed.select("conv_id", F.monotonically_increasing_id().alias("start"),
                           "turn", "initial", "symbol", "n")
    schema = T.StructType([*tagged.schema.fields[:2],
                           *T.StructType.fromDDL(_BLOCK).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        key, block, made = None, None, []
        for batch in batches:
            for conv, start, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if block is None or conv != key[0] or block.rows >= BLOCK:
                    if block is not None:
                        made.append((*key, *block.fields()))
                    key, block = (conv, start), _Block()
                block.add(*row)
            if made:
                yield _batch(made, arrow)
                made = []
        if block is not None:
            yield _batch([(*key, *block.fields())], arrow)
    return tagged.mapInArrow(run, schema)


def _batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(col, type=t.type) for col, t in zip(zip(*rows), arrow)], schema=arrow)


_PLAN = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
         "cost bigint, audit string")


def _solver() -> Callable[..., tuple]:
    steps = Steps()

    def solve(conv, blocks):
        whole, gaps_of = _Block(), []
        illegal = turns = 0
        last = None
        for b in blocks:
            if not b["symbols"]:
                continue
            for symbol, n in zip(b["symbols"], b["lengths"]):
                whole.run(symbol, n)
            illegal += b["illegal"] + (last is not None and _illegal(last["last_role"], b["first_role"]))
            # a turn that goes on from the block before was counted there
            goes_on = last is not None and b["first_turn"] is not None \
                and last["last_turn"] == b["first_turn"]
            turns += b["turns"] - goes_on
            if b["min_turn"] is not None:
                gaps_of += [b["min_turn"], b["max_turn"]]
            last = b
        gaps = max(gaps_of) - min(gaps_of) + 1 - turns if gaps_of else 0
        cost, audit = steps.solve(list(zip(whole.symbols, whole.lengths)))
        return (conv, gaps, *(sum(b[k] for b in blocks) for k in ("blank", "duplicate", "truncated")),
                illegal, cost, audit)
    return solve


def plan(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` per conversation.

    ``rows``: conv_id, turn, role, text.  ``conversations`` adds conversation
    ids that may have no rows.
    """
    blocks = _blocks(_symbols(rows))
    ids = (conversations if conversations is not None else rows).select("conv_id").distinct()
    none = {"symbols": F.lit(""), "lengths": F.array()} | {
        n: F.lit(0) for n in ("blank", "duplicate", "truncated", "illegal", "turns")}
    empty = ids.select("conv_id", F.lit(-1).cast("long").alias("start"), *[
        none.get(n, F.lit(None)).cast(t).alias(n) for n, t in _BLOCK_FIELDS])
    every = blocks.unionByName(empty).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("start", *[n for n, _ in _BLOCK_FIELDS]))).alias("blocks"))
    schema = T.StructType([every.schema["conv_id"], *T.StructType.fromDDL(_PLAN).fields])
    return map_rows(every, _solver, schema)


# ---------------------------------------------------------------- edits applied

def _edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """Roles and texts after the edits; a new or changed role follows the one before."""
    last = ""
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if last == "u" else "user"
        last = role[:1]
        yield role, text


def _walk(rows: DataFrame, plans: DataFrame, schema: T.StructType,
          emit: Callable[[tuple, Iterator], Iterator[tuple]]) -> DataFrame:
    """Stream each conversation's plan and rows, in order, through ``emit``.

    A plan sorts before the rows of its conversation; rows come a batch at a time.
    """
    heads = plans.select("conv_id", F.lit(0).alias("_row"), *[c for c in plans.columns if c != "conv_id"])
    items = _hashed(rows).withColumn("_row", F.lit(1))
    both = heads.unionByName(items, allowMissingColumns=True)
    n = shuffle_partitions(rows.sparkSession)
    streamed = (both.repartition(n, "conv_id")
                .sortWithinPartitions("conv_id", "_row", "turn", "role", "sha")
                .select(*heads.columns, "role", "text"))
    width = len(heads.columns)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        flat = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        made, size = [], 0
        for _, group in groupby(flat, key=lambda r: r[0]):
            head = next(group)
            # a role is set on rows, never on a plan
            for out in emit(head[:width], (r[width:] for r in group)):
                made.append(out)
                size += sum(len(x) for x in out if isinstance(x, str))
                if len(made) >= 1000 or size > 1 << 24:
                    yield _batch(made, arrow)
                    made, size = [], 0
        if made:
            yield _batch(made, arrow)
    return streamed.mapInArrow(run, schema)


def repaired(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """``conv_id, place, role, text``: the rows after the edits of their plan."""
    schema = T.StructType([rows.schema["conv_id"], *T.StructType.fromDDL(
        "place bigint, role string, text string").fields])
    audit = plans.columns.index("audit") + 1

    def emit(head, items):
        for place, (role, text) in enumerate(_edited(head[audit], items)):
            yield head[0], place, role, text
    return _walk(rows, plans, schema, emit)


def with_digest(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The plans with ``repaired_sha256``, of the repaired ``role:text`` joined by newlines."""
    schema = T.StructType([*plans.schema.fields, T.StructField("repaired_sha256", T.StringType())])
    audit = plans.columns.index("audit") + 1

    def emit(head, items):
        made, join = hashlib.sha256(), b""
        for role, text in _edited(head[audit], items):
            made.update(join + f"{role}:{text}".encode())
            join = b"\n"
        yield head[0], *head[2:], made.hexdigest()
    return _walk(rows, plans, schema, emit)
