"""Operator 5: secret scans with assignment-aware lexing.

Three fixed patterns give the base spans (``assign``, ``access``, ``hex``).
The method adds ``literal`` spans: source and configuration syntax
(``name = "x"``, ``name: x``, ``"name": "x"``, ``name := x``, ``name => x``,
with ``+`` chains and ``$NAME``/``${NAME}`` references) is lexed into pairs
of a name and its operands; constants are propagated through names, forward
references included; and each literal is scored by the most sensitive name
that it reaches, times how much it looks like a secret.  A literal inside a
base span is not reported again.

Offsets are code points, end exclusive.  Null and empty texts have no spans;
repeated rows each get a row; all scans are linear in the text's length.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.llm.common import map_rows

KINDS = ("assign", "access", "hex", "literal")
_ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                     r"""([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")

_TARGET = re.compile(r"""(?a)(?<![\w$.-])["']?([A-Za-z_][\w-]*+(?:\.[\w-]++)*+)["']?[ \t]*+"""
                     r"""(?:=>|:=|[:=](?![=:]))[ \t]*+""")
_OPERAND = re.compile(r"""(?a)"((?:[^"\\\n]|\\.)*+)"|'((?:[^'\\\n]|\\.)*+)'"""
                      r"""|\$\{?([A-Za-z_]\w*+)\}?|([A-Za-z0-9+/_.~!@%^&*-]++={0,2})""")
_PLUS = re.compile(r"[ \t]*\+[ \t]*(?=[\"'$A-Za-z_])")
_NAME_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_IDENTIFIER = re.compile(r"(?a)[A-Za-z_]\w*\Z")

# Parts of names that announce a secret, with their weight.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "apikey": 1.0,
    "token": 0.9, "credential": 0.9, "credentials": 0.9, "bearer": 0.9, "privatekey": 1.0,
    "accesskey": 1.0, "auth": 0.6, "pass": 0.7, "signature": 0.5, "salt": 0.5,
}
# Two adjacent parts that announce a secret together.
SENSITIVE_PAIRS = {("api", "key"), ("access", "key"), ("private", "key"), ("secret", "key"),
                   ("encryption", "key"), ("signing", "key"), ("auth", "key"), ("client", "secret")}
PLACEHOLDER = re.compile(r"(?i)x+|\*+|change_?me|example.*|your[_-].*|dummy|test|none|null|true|"
                         r"false|todo|placeholder|undefined|string|.*\.(com|org|net|html?)")
THRESHOLD = 0.5


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the three fixed patterns, too short matches dropped after matching."""
    out = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return out + [("hex", *m.span()) for m in _HEX.finditer(text)]


def name_score(name: str) -> float:
    """How sensitive a target name is, 0 to 1, by its parts."""
    parts = [p.lower() for p in _NAME_PART.findall(name)]
    score = max([SENSITIVE.get(p, 0.0) for p in parts], default=0.0)
    return 1.0 if SENSITIVE_PAIRS & {*zip(parts, parts[1:])} else score


def literal_score(value: str) -> float:
    """How much a literal looks like a secret, 0 to 1: length, alphabet, entropy."""
    n = len(value)
    if n < 6 or PLACEHOLDER.fullmatch(value) or any(c.isspace() for c in value):
        return 0.0
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(value).values())
    kinds = (any(c.isdigit() for c in value) + any(c.islower() for c in value)
             + any(c.isupper() for c in value) + any(not c.isalnum() for c in value))
    return min(1.0, entropy / 3.0) * (1.0 if kinds > 1 else 0.4)


def lex(text: str) -> list[tuple[str, list[tuple[str, str, int, int]]]]:
    """(name, operands) in order of the text; an operand is (kind, value, start, end)."""
    pairs, scanned = [], 0
    while target := _TARGET.search(text, scanned):
        operands, at = [], target.end()
        scanned = at
        while m := _OPERAND.match(text, at):
            group = m.lastindex
            kind = "ref" if group == 3 else "bare" if group == 4 else "text"
            operands.append((kind, m[group], *m.span(group)))
            if kind == "text":            # no assignment is read inside a quoted literal
                scanned = m.end()
            plus = _PLUS.match(text, m.end())
            if not plus:
                break
            at = plus.end()
        if operands:
            pairs.append((target[1], operands))
    return pairs


def literal_spans(text: str, threshold: float = THRESHOLD) -> list[tuple[str, int, int]]:
    """Literals that reach a sensitive name, directly or through other names."""
    pairs = lex(text)
    if not pairs:
        return []
    names = {name for name, _ in pairs}
    feeds: dict[str, set[str]] = {}          # name -> names that its value is assigned to
    held: list[tuple[str, str, int, int]] = []
    for name, operands in pairs:
        for kind, value, start, end in operands:
            known = value in names and (kind == "ref" or kind == "bare"
                                        and _IDENTIFIER.match(value))
            if known:
                feeds.setdefault(value, set()).add(name)
            elif kind != "ref":
                held.append((name, value, start, end))
    reach = {name: name_score(name) for name in names}
    # Push each name's score back to the names that feed it, strongest first.
    feeders: dict[str, list[str]] = {}
    for source, targets in feeds.items():
        for t in targets:
            feeders.setdefault(t, []).append(source)
    for top in sorted(names, key=lambda x: (-reach[x], x)):
        todo = [top]
        while todo:
            for source in feeders.get(name := todo.pop(), ()):
                if reach[source] < reach[name]:
                    reach[source] = reach[name]
                    todo.append(source)
    return [("literal", start, end) for name, value, start, end in held
            if reach[name] * literal_score(value) >= threshold]


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of a text by start, then kind."""
    if not text:
        return []
    base = base_spans(text)
    order = {k: i for i, k in enumerate(KINDS)}
    out = sorted(base, key=lambda s: (s[1], order[s[0]], s[2]))
    covered = _merged(out)
    out += [s for s in literal_spans(text) if not _inside(s, covered)]
    return sorted(set(out), key=lambda s: (s[1], order[s[0]], s[2]))


def _merged(spans: list[tuple[str, int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for _, start, end in spans:
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _inside(span: tuple[str, int, int], covered: list[list[int]]) -> bool:
    from bisect import bisect_right
    i = bisect_right(covered, [span[1], math.inf]) - 1
    return i >= 0 and span[2] <= covered[i][1]


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()),
                                  T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType())]))


def _records(spans):
    return [{"kind": k, "start": s, "end": e} for k, s, e in spans]


def find_secrets(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``key`` and ``spans`` (array of kind, start, end) of every text."""
    def start():
        return lambda k, text: (k, _records(scan(text)))
    schema = T.StructType([docs.schema[key], T.StructField("spans", SPANS)])
    return map_rows(docs.select(key, text_col), start, schema)


def redact(text: str | None, mark: str = "[secret]") -> str | None:
    """The text with every span, overlapping ones together, replaced by ``mark``."""
    if not text or not (spans := scan(text)):
        return text
    out, at = [], 0
    for start, end in _merged(spans):
        out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]])


def redact_documents(docs: DataFrame, text_col: str = "text",
                     length_col: str = "n_chars") -> DataFrame:
    """``docs`` with secrets masked; ``length_col`` follows the text where it changed."""
    names = docs.columns
    i, j = names.index(text_col), names.index(length_col) if length_col in names else None

    def start():
        def row(*values):
            text = redact(values[i])
            if text == values[i]:
                return values
            out = list(values)
            out[i] = text
            if j is not None:
                out[j] = len(text)
            return tuple(out)
        return row
    return map_rows(docs, start, docs.schema)


def joined(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of the spans of some kinds, joined by commas."""
    kept = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
