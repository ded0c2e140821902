"""Free-text place parsing as native column expressions (no Python UDF).

A place looks like ``"10 km SSE of Volcano, Hawaii"``: an optional distance,
an optional compass direction followed by ``of``, the nearest locality and an
optional state.  The grammar is matched case-insensitively against the text
with surrounding whitespace removed.

Whitespace follows Python's ``str.isspace`` (Java's ``\\s`` alone would miss
the four information separators U+001C..U+001F), and digits are Unicode
decimal digits, so the groups are the same as a Python ``re`` parse.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES — whitespace as Python's str.isspace() defines it.
WHITESPACE_CLASS = (r"[\t\n\x0B\f\r\x1C-\x1F \x85\xA0\u1680\u2000-\u200A"
                    r"\u2028\u2029\u202F\u205F\u3000]")

_WS = WHITESPACE_CLASS
# FIXED VALUES — the place grammar: distance, direction + "of", locality, state.
PLACE_PATTERN = (
    r"(?iu)^"
    rf"(?:(\p{{Nd}}+{_WS}*km){_WS}*)?"
    rf"(?:([NSEW]{{1,3}}){_WS}*of{_WS}*)?"
    r"([^,]+?)"
    rf"(?:,{_WS}*([A-Za-z ]+))?"
    r"$"
)

_STRIP_PATTERN = rf"^{_WS}+|{_WS}+$"


def strip_ws(col: Column) -> Column:
    """Remove leading and trailing whitespace (Unicode, like ``str.strip``)."""
    return F.regexp_replace(col, _STRIP_PATTERN, "")


# U+FFFF is a Unicode noncharacter: it separates the groups in the one-pass
# rewrite below.  Texts that contain it take the per-group path instead.
_SEP = "\uffff"
_REWRITE = _SEP + "$1" + _SEP + "$2" + _SEP + "$3" + _SEP + "$4"


def place_pieces(place: Column) -> Column:
    """One evaluation of the grammar over a stripped text.

    An anchored ``regexp_replace`` rewrites a matching text to its four
    groups joined by a separator and ``split`` takes them apart; a
    non-matching text comes back unchanged (one piece).
    """
    return F.split(F.regexp_replace(place, PLACE_PATTERN, _REWRITE), _SEP, -1)


def place_parts(place: Column, pieces: Column | None = None) -> dict[str, Column]:
    """Column expressions for the four place parts of a stripped text.

    * a group that did not take part in the match is null;
    * when the grammar does not match at all, ``nearest`` is null here
      (the caller substitutes the original text) and the others are null;
    * ``nearest`` is stripped and may be an empty (non-null) string.

    ``pieces`` is ``place_pieces(place)``, ideally already a column so the
    grammar runs once per row.  Every group except ``nearest`` needs at
    least one character when it takes part, so an empty piece means absent.
    Texts containing the separator take the per-group extraction path.
    """
    if pieces is None:
        pieces = place_pieces(place)
    fast_match = F.size(pieces) == 5

    def fast(i: int) -> Column:
        return F.when(fast_match, pieces.getItem(i))

    def slow(i: int) -> Column:
        return F.regexp_extract(place, PLACE_PATTERN, i)

    has_sep = F.instr(place, _SEP) > 0
    g = {i: F.when(has_sep, slow(i)).otherwise(fast(i)) for i in (1, 2, 4)}
    nearest_group = F.when(has_sep, F.when(place.rlike(PLACE_PATTERN), slow(3))) \
                     .otherwise(fast(3))
    return {
        "distance": F.nullif(g[1], F.lit("")),
        "direction": F.nullif(g[2], F.lit("")),
        "nearest": strip_ws(nearest_group),
        "state": F.nullif(g[4], F.lit("")),
    }
