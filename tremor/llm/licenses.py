"""Operator 4: licence scans by sentence rules.

A text is cut into sentences, each normalised (lower case, comment marks and
punctuation gone, spelling unified) and mapped to a known licence-sentence
identifier; the identifiers in order of the text are then matched against
ordered licence rules, each of which consumes what it matches, so a more
specific rule comes before a more general one.

A line with an SPDX tag and a line that begins as a copyright notice end the
sentence before them and are looked up apart.  Any other sentence may be
wrapped over lines: it is looked up whole first, then, if unknown, line by line.  Everything is a row expression; no text is moved.
Texts without any of the ``ANCHORS`` skip the work: every known sentence has
one of them.

Results: null and empty texts have no identifiers and no licences;
identifiers that no rule consumes are listed as ``unmatched``; a licence
that matches more than once is listed once; repeated rows each get a row; columns
beyond key and text are dropped.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import fenced

# Words of which every known sentence has one, a grant's "under" among them.
ANCHORS = ("licen", "copyright", "permission", "warrant", "redistribut", "liab", "merchantab",
           "under", "(c)", "©")

# Normalised names of licences as used in grants.
NAMES = {
    "mit": "MIT", "apache 2.0": "Apache-2.0", "apache": "Apache",
    "gnu general public 2": "GPL-2.0", "gnu general public 3": "GPL-3.0",
    "gnu general public": "GPL", "gnu gpl 2": "GPL-2.0", "gnu gpl 3": "GPL-3.0",
    "gpl 2": "GPL-2.0", "gpl 3": "GPL-3.0", "gpl": "GPL", "gnu gpl": "GPL",
    "gnu lesser general public 2.1": "LGPL-2.1", "gnu lesser general public 3": "LGPL-3.0",
    "lgpl 2.1": "LGPL-2.1", "lgpl 3": "LGPL-3.0",
    "gnu affero general public 3": "AGPL-3.0", "agpl 3": "AGPL-3.0",
    "mozilla public 2.0": "MPL-2.0", "mpl 2.0": "MPL-2.0", "bsd": "BSD",
    "bsd 2 clause": "BSD-2-Clause", "bsd 3 clause": "BSD-3-Clause", "isc": "ISC", "zlib": "Zlib",
    "boost software 1.0": "BSL-1.0", "eclipse public 2.0": "EPL-2.0", "artistic 2.0": "Artistic-2.0",
    "cc by 4.0": "CC-BY-4.0", "cc by sa 4.0": "CC-BY-SA-4.0", "cc by nc 4.0": "CC-BY-NC-4.0",
    "cc by nd 4.0": "CC-BY-ND-4.0", "cc by nc sa 4.0": "CC-BY-NC-SA-4.0",
    "cc by nc nd 4.0": "CC-BY-NC-ND-4.0", "cc0 1.0": "CC0-1.0",
    "creative commons attribution 4.0": "CC-BY-4.0",
    "creative commons attribution 4.0 international": "CC-BY-4.0",
    "creative commons attribution sharealike 4.0 international": "CC-BY-SA-4.0",
    "creative commons attribution noncommercial 4.0 international": "CC-BY-NC-4.0",
}

# Sentences of licence texts and the identifiers they map to.
SENTENCES = {
    "The MIT License": "MitTitle",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    "and associated documentation files (the \"Software\"), to deal in the Software without "
    "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions:": "MitGrant",
    "The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software.": "MitNotice",
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
    "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
    "NONINFRINGEMENT.": "MitAsIs",
    "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
    "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.": "MitLiability",
    "You may not use this file except in compliance with the License.": "ApacheCompliance",
    "You may obtain a copy of the License at": "ApacheObtain",
    "Unless required by applicable law or agreed to in writing, software distributed under the "
    "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
    "either express or implied.": "ApacheAsIs",
    "See the License for the specific language governing permissions and limitations under the "
    "License.": "ApacheSee",
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met:": "BsdGrant",
    "Redistributions of source code must retain the above copyright notice, this list of conditions "
    "and the following disclaimer.": "BsdSource",
    "Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution.": "BsdBinary",
    "Neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written "
    "permission.": "BsdEndorse",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
    "fee is hereby granted, provided that the above copyright notice and this permission notice "
    "appear in all copies.": "IscGrant",
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
    "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.":
        "GplWarranty",
    "See the GNU General Public License for more details.": "GplSee",
    "You should have received a copy of the GNU General Public License along with this program.":
        "GplReceived",
    "All rights reserved, no license is granted.": "NoLicense",
}

# Pieces of the published GPL notices and the identifiers they map to.
_GPL_TERMS = ("you can redistribute it and/or modify it under the terms of the GNU General Public License "
              "as published by the Free Software Foundation")
NOTICES = {
    _GPL_TERMS + ", either version 3 of the License, or (at your option) any later version.": "Grant:GPL-3.0",
    _GPL_TERMS + ", either version 2 of the License, or (at your option) any later version.": "Grant:GPL-2.0",
    _GPL_TERMS + ";": "GplTerms",
    "either version 3 of the License, or (at your option) any later version.": "GplEither3",
    "either version 2 of the License, or (at your option) any later version.": "GplEither2",
}

# Ordered rules over identifier sequences; each consumes its match.
RULES = (
    ("MIT", r"(?:MitTitle,)?(?:Copyright,)*MitGrant,MitNotice,MitAsIs,MitLiability,"),
    ("Apache-2.0", r"(?:Copyright,)*Grant:Apache-2\.0,ApacheCompliance,ApacheObtain,ApacheAsIs,ApacheSee,"),
    ("BSD-3-Clause", r"(?:Copyright,)*BsdGrant,BsdSource,BsdBinary,BsdEndorse,"),
    ("BSD-2-Clause", r"(?:Copyright,)*BsdGrant,BsdSource,BsdBinary,"),
    ("ISC", r"(?:Copyright,)*IscGrant,"),
    ("GPL-3.0", r"(?:Copyright,)*Grant:GPL-3\.0,(?:GplWarranty,)(?:GplSee,)?(?:GplReceived,)?"),
    ("GPL-2.0", r"(?:Copyright,)*Grant:GPL-2\.0,(?:GplWarranty,)(?:GplSee,)?(?:GplReceived,)?"),
    ("GPL-3.0", r"(?:Copyright,)*GplTerms,GplEither3,(?:GplWarranty,)?(?:GplSee,)?(?:GplReceived,)?"),
    ("GPL-2.0", r"(?:Copyright,)*GplTerms,GplEither2,(?:GplWarranty,)?(?:GplSee,)?(?:GplReceived,)?"),
    ("MIT", r"MitTitle,"),
    ("NoLicense", r"NoLicense,"),
)
GRANT = (r"^(?:this (?:work|file|software|project|program|code|library|document|material) (?:is|may be)"
         r" |it is |code )?(?:dual )?(?:licensed|released|distributed|made available|available|published"
         r"|provided) under (?:the )?(?:terms (?:of|and conditions of) )?(?:the )?")
STOP = "\x01"
# Lines that stand for themselves: a copyright notice, an SPDX tag.
OWN_LINE = (r"(?im)^([ \t]*(?:(?:copyright|\(c\)|©)[ \t]*)+[0-9]{4}.*|.*spdx-licen[sc]e-identifier:.*)$")


def _normal(text: Column) -> Column:
    """Comparable form of a sentence."""
    steps = ((r"\(c\)|©", " copyright "), (r"\b(licen)ce", "$1se"), (r"\b(?:v|version) ?([0-9])", "$1"),
             (r"[^a-z0-9.+]+", " "), (r"\.+( |$)", "$1"), (r"^ +| +$", ""))
    out = F.lower(text)
    for pattern, by in steps:
        out = F.regexp_replace(out, pattern, by)
    return out


def normal(text: str) -> str:
    """The same form on the driver, for the tables."""
    out = text.lower()
    for pattern, by in ((r"\(c\)|©", " copyright "), (r"\b(licen)ce", r"\1se"),
                        (r"\b(?:v|version) ?([0-9])", r"\1"), (r"[^a-z0-9.+]+", " "),
                        (r"\.+( |$)", r"\1"), (r"^ +| +$", "")):
        out = re.sub(pattern, by, out)
    return out


def _pieces(text: str) -> list[str]:
    """A table sentence as the splitter cuts it: a semicolon or colon ends a sentence too."""
    return [p for p in (normal(x) for x in re.split(r"(?<=[.;:!?])\s+", text)) if p]


def sentence_table() -> dict[str, str]:
    """Normalised sentence to identifier; later pieces of a cut sentence carry none."""
    out: dict[str, str] = {}
    for text, name in SENTENCES.items():
        out[_pieces(text)[0]] = name
    return out


def known_pieces() -> list[str]:
    """Normalised sentences that name an identifier on their own."""
    return [*sentence_table(), *notice_table()]


def notice_table() -> dict[str, str]:
    """Normalised piece of a published notice to identifier."""
    return {normal(text): name for text, name in NOTICES.items()}


def _lookup(table: dict[str, str], key: Column) -> Column:
    items = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*items), key)


def identifier(sentence: Column) -> Column:
    """Identifier of one sentence, null if it is not known."""
    s = _normal(sentence)
    spdx = F.regexp_extract(sentence, r"(?i)spdx-licen[sc]e-identifier:\s*([A-Za-z0-9.+-]+)", 1)
    # '(the "License")' after a name defines a word.
    plain = F.regexp_replace(s, " the license$", "")
    granted = F.regexp_replace(F.regexp_replace(plain, GRANT, ""), r"\b(?:license|or later|only) ?", "")
    name = _lookup(NAMES, F.regexp_replace(granted, "^ +| +$", ""))
    return (F.when(spdx != "", F.concat(F.lit("Spdx:"), spdx))
            .when(s.rlike(GRANT) & name.isNotNull(), F.concat(F.lit("Grant:"), name))
            .when(s.rlike(r"^(?:copyright )+[0-9]{4}"), F.lit("Copyright"))
            .otherwise(_lookup({**sentence_table(), **notice_table()}, F.regexp_replace(s, r"^(?:[0-9]+|[a-z])\.? ", ""))))


def identifiers(text: Column) -> Column:
    """Identifiers of a text's known sentences, in order (array of string)."""
    low = F.lower(text)
    may = None
    for a in ANCHORS:
        may = low.contains(a) if may is None else may | low.contains(a)
    bare = F.regexp_replace(text, r"(?m)^[ \t]*(?:/\*+|\*+/?|//+|#+|--+|;+|<!--|rem )[ \t]?", "")
    apart = F.regexp_replace(bare, OWN_LINE, STOP + "$1" + STOP)
    marked = F.regexp_replace(F.regexp_replace(apart, r"\n[ \t]*\r?\n", STOP), r"(?<!dentifier)([.;:!?])\s+", "$1" + STOP)
    keep = F.filter(F.split(marked, STOP), lambda s: s != "")
    # A sentence unknown as a whole is looked up line by line.
    found = F.transform(keep, lambda s: F.when(
        identifier(s).isNotNull(), F.array(identifier(s))).otherwise(
            F.transform(F.split(s, "\n"), lambda line: identifier(line))))
    return F.when(may, F.filter(F.flatten(found), lambda x: x.isNotNull())).otherwise(
        F.array().cast("array<string>"))


def scan(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``key``, ``sentences`` and ``licenses`` (arrays), ``unmatched`` (string) of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = fenced(docs.select(F.col(key), text.alias("_text")),
                sentences=identifiers(F.col("_text"))).drop("_text")
    df = df.withColumn("_left", F.when(F.size("sentences") > 0, F.concat(
        F.array_join("sentences", ","), F.lit(","))).otherwise(F.lit("")))
    found = []
    for i, (name, pattern) in enumerate(RULES):
        anchored = r"(?<=^|,)" + pattern
        met = F.col("_left").rlike(anchored)
        df = fenced(df, **{f"_m{i}": met, "_left": F.when(
            met, F.regexp_replace("_left", anchored, "")).otherwise(F.col("_left"))})
        found.append(F.when(F.col(f"_m{i}"), F.lit(name)))
    # A grant or tag on its own names its licence.
    alone = F.regexp_extract_all("_left", F.lit(r"(?:Grant|Spdx):([^,]+),"), F.lit(1))
    left = F.regexp_replace("_left", r"(?:Grant|Spdx):[^,]+,", "")
    licenses = F.array_sort(F.array_distinct(F.concat(
        F.filter(F.array(*found), lambda x: x.isNotNull()), alone)))
    return df.select(key, "sentences", licenses.alias("licenses"),
                     F.regexp_replace(left, ",$", "").alias("unmatched"))
