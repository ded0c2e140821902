"""Operators on DataFrames against brute-force versions, with the odd cases of every column."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tremor.llm import (bpe, components, decontam, fingerprint, licenses, near_dup, quality,
                        queries, secret_scan, sharding, token_count, url_filter)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " \t\n ", "one", "a b c d", "A  b\tC\nd e", "word " * 6000, "é ñ ß " * 20]


def documents(make, texts, parts=3, start=0):
    rows = [(start + i, t, "en", f"src{i % 3}" if i % 4 else None, None if t is None else len(t))
            for i, t in enumerate(texts)]
    return make(rows, DOCS, parts)


def rows_of(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


# ---------------------------------------------------------------- components

def test_components_equal_union_find(make):
    rnd = random.Random(2)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(150)]
    edges += [(300 + i, 301 + i) for i in range(40)] + [(500, 500 + i) for i in range(60)]
    edges += [(None, 3), (4, None), (7, 7)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a is not None and b is not None:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    want = sorted((x, find(x)) for x in list(parent) if find(x) != x)
    got = components.components(make(edges, "a long, b long"), "a", "b")
    assert rows_of(got, "node", "component") == want


# ---------------------------------------------------------------- op 1

PAGES = "page_id long, url string, html string, host string"


def canonical(href):
    return f"<head><link rel='canonical' href='{href}'></head>"


def test_url_rules_hosts_and_paths(make):
    urls = [None, "", "no-scheme.org/x", "HTTP://WWW.Example.ORG/es/1?x#y", "http://a.org", "http://a.org/",
            "http://example.org/en/12", "http://x.com/fr/", "http://x.com/de/1", "http://notexample.org/es/",
            "http://xcom/de/", "http://q.net/?u=http://a.com/de/", "http://ÄB.com/De/", "http://com/fr/é"]
    pages = make([(i, u, None, "clash") for i, u in enumerate(urls)], PAGES)
    got = {r["page_id"]: r for r in url_filter.judge(pages).collect()}
    want = [("", "", None, "allow")] * 3 + [
        ("www.example.org", "/es/1", "example.org/es/", "block"), ("a.org", "", None, "allow"),
        ("a.org", "/", "org/", "allow"), ("example.org", "/en/12", "example.org/en/1", "block"),
        ("x.com", "/fr/", "com/fr/", "allow"), ("x.com", "/de/1", "com/de/", "block"),
        ("notexample.org", "/es/", "org/", "allow"), ("xcom", "/de/", None, "allow"),
        ("q.net", "/", None, "allow"), ("Äb.com", "/De/", None, "allow"),
        ("com", "/fr/é", "com/fr/", "allow")]
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"])
            for i in range(len(urls))] == want


def test_blocks_reach_aliases_and_allow_has_precedence(make):
    chain = [("http://s.com/de/1", ""), ("http://a.net/1", canonical("http://s.com/de/1")),
             ("http://b.net/1#top", canonical("//a.net/1")),
             ("https://c.net/x/y", "<meta http-equiv=refresh content='0; url=http://b.net/1'>"),
             ("http://free.net/", canonical("http://z.com/de/9")),
             ("http://free2.net/", canonical("http://free.net/")),
             ("http://m.com/fr/2", canonical("http://free.net/")),
             ("http://k.net/a", "<!-- " + canonical("http://s.com/de/1") + " -->"),
             ("http://k.net/b", "<link rel='stylesheet' href='http://s.com/de/1'>"),
             ("http://k.net/p/q", canonical("r")), ("http://k.net/p/r", canonical("/s")),
             ("http://k.net/s", canonical("http://s.com/de/7")), ("http://k.net/s", "")]
    pages = make([(i, u, h, "") for i, (u, h) in enumerate(chain)], PAGES)
    got = {r["page_id"]: (r["verdict"], r["reason"]) for r in url_filter.judge(pages).collect()}
    assert [got[i] for i in range(len(chain))] == [
        ("block", "rule"), ("block", "alias"), ("block", "alias"), ("block", "alias"),
        ("allow", "alias"), ("allow", "alias"), ("allow", "rule"), ("allow", "default"),
        ("allow", "default"), ("block", "alias"), ("block", "alias"), ("block", "alias"),
        ("block", "alias")]


def test_redirect_table_and_empty_pages(make, spark):
    pages = make([(1, "http://a.net/", None, ""), (2, "http://b.net/", None, "")], PAGES)
    moves = make([("http://a.net/", "http://gone.net/"), ("http://gone.net/", "http://x.com/de/"),
                  (None, "http://b.net/")], "source string, target string")
    assert rows_of(url_filter.judge(pages, redirects=moves), "page_id", "verdict") == [
        (1, "block"), (2, "allow")]
    assert url_filter.judge(pages.where("page_id < 0")).count() == 0


# ---------------------------------------------------------------- op 2

GOOD = ("The {0} of the {1} was in the {2}, and it is on {3}. With that {4}, from this {5} by the {0}.")


def corpus(n=300):
    rnd = random.Random(9)

    def word():
        return "".join(rnd.choice(["ra", "ti", "sho", "ner", "pel", "qu"]) for _ in range(rnd.randint(1, 3)))
    good, bad = [], []
    for i in range(n):
        good.append(" ".join(GOOD.format(*[word() for _ in range(6)]) for _ in range(rnd.randint(2, 5))))
        kind = i % 3
        bad.append((" ".join(word().upper() + "!!" for _ in range(50)), (word() + " ") * 60,
                    " ".join(f"{word()} | ### $$$" for _ in range(40)))[kind])
    return good, bad


def test_quality_separates_held_out_documents(make):
    good, bad = corpus()
    docs = documents(make, good + bad[:90])
    model = quality.fit(docs)
    fresh_good, fresh_bad = corpus(320)
    held = documents(make, fresh_good[300:] + fresh_bad[300:] + ODD)
    got = {r["doc_id"]: r for r in quality.classify(held, model).collect()}
    assert all(got[i]["kept"] for i in range(20))
    assert not any(got[i]["kept"] for i in range(20, 40))
    assert [got[40 + i]["kept"] for i in range(3)] == [False] * 3      # null, empty, blank
    assert got[40]["posterior"] is None and got[40]["score"] == 0.0
    # A labeller that is right more often than not is found to be so.
    assert (model.accuracy[:, 1, 1] > 0.6).all()


def test_quality_is_repeatable_and_takes_empty_tables(make):
    good, bad = corpus(60)
    docs = documents(make, good + bad, parts=2)
    again = documents(make, good + bad, parts=5)
    a = rows_of(quality.classify(docs, quality.fit(docs)), "doc_id", "score")
    assert a == rows_of(quality.classify(again, quality.fit(again)), "doc_id", "score")
    none = docs.where("doc_id < 0")
    assert quality.keep_good(none).count() == 0
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and 50 <= kept.count() <= 62


def test_training_sample_is_bounded_whatever_the_ids(make):
    """One id or null on most rows neither fills nor empties the sample; repeated rows are one."""
    rows = [(None if i % 2 else 1, f"text {i}", "", "", 1) for i in range(300)] + [(2, "same", "", "", 1)] * 100
    drawn = quality.draw(make(rows, DOCS), "doc_id", "text", 40).collect()
    assert len(drawn) == 40 and len({r["text"] for r in drawn}) == 40
    every = {r["text"]: r["n"] for r in quality.draw(make(rows, DOCS), "doc_id", "text", 1000).collect()}
    assert len(every) == 301 and every["same"] == 100 and every["text 7"] == 1


def test_training_sees_every_feature(make, monkeypatch):
    """A sampled document trains with all the words that it is scored by."""
    seen = []
    monkeypatch.setattr(quality, "fit_scorer", lambda rows, **_: seen.extend(rows))
    text = " ".join(f"word{i}" for i in range(1500))
    quality.fit(documents(make, [text]))
    assert len(seen[0][0]) == len(quality.features(quality.shape(text))[0]) > 1500


def test_toxic_documents_of_good_quality_are_rejected(make):
    good, bad = corpus()
    rnd = random.Random(2)

    def toxic(text):
        words = text.split()
        for _ in range(max(3, len(words) // 25)):
            words.insert(rnd.randrange(len(words)), rnd.choice(["idiot", "stupid,", "Scum", "pathetic", "moron"]))
        return " ".join(words)
    docs = documents(make, good[40:] + [toxic(t) for t in good[:40]] + bad[:60])
    model = quality.fit(docs)
    fresh = corpus(340)[0][300:]
    got = {r["doc_id"]: r["kept"] for r in quality.classify(
        documents(make, fresh + [toxic(t) for t in fresh]), model).collect()}
    assert all(got[i] for i in range(40)) and not any(got[40 + i] for i in range(40))


def test_em_recovers_planted_accuracies():
    rnd = random.Random(4)
    true = [0.9, 0.8, 0.95, 0.7, 0.85]
    n_lab = len(quality.LABELLERS)
    true = (true * 2)[:n_lab]
    patterns = {}
    for _ in range(20000):
        y = rnd.random() < 0.7
        p = "".join("-" if rnd.random() < 0.2 else str(int(y == (rnd.random() < a))) for a in true)
        patterns[p] = patterns.get(p, 0) + 1
    _, accuracy = quality.fit_votes(patterns)
    for k, a in enumerate(true):
        assert abs(accuracy[k, 1, 1] - a) < 0.04 and abs(accuracy[k, 0, 0] - a) < 0.05


# ---------------------------------------------------------------- op 3, 5, 6 on tables

def test_text_tools_take_odd_rows(make):
    docs = documents(make, ODD + ODD)
    coded = {r["doc_id"]: r for r in bpe.encode_decode(docs, queries.public_tokenizers.path(
        "word_bpe_49k.json")).collect()}
    assert len(coded) == 16 and coded[0]["ids"] == [] and coded[0]["decoded"] == ""
    assert coded[3]["ids"] == coded[11]["ids"]
    assert secret_scan.find_secrets(docs).where("size(spans) > 0").count() == 0
    pieces = token_count.read_pieces(queries.public_tokenizers.path("piece_bpe_32k.model"))
    assert token_count.count_tokens(docs, pieces).where("n_tokens = 0").count() == 4
    none = docs.where("doc_id < 0")
    assert secret_scan.find_secrets(none).count() == token_count.count_tokens(none, pieces).count() == 0


def test_redaction_keeps_columns_and_clean_rows(make):
    docs = documents(make, ["nothing here", None, "password=abcdef123 end"])
    out = {r["doc_id"]: r for r in secret_scan.redact_documents(docs).collect()}
    assert out[0]["text"] == "nothing here" and out[1]["text"] is None
    assert out[2]["text"] == "[secret] end" and out[2]["n_chars"] == 12


# ---------------------------------------------------------------- op 4

MIT_TEXT = "\n".join(["The MIT License", "", "Copyright (c) 2020 A. Person", ""] + [
    re.sub(r"(.{40,70}) ", r"\1\n", s) for s, n in licenses.SENTENCES.items() if n.startswith("Mit")
    and n != "MitTitle"])
BSD = [s for s, n in licenses.SENTENCES.items() if n.startswith("Bsd")]


def scanned(make, texts):
    docs = documents(make, texts)
    return [r["licenses"] for r in sorted(licenses.scan(docs).collect(), key=lambda r: r["doc_id"])]


def test_licences_from_sentences_in_order(make):
    texts = ["Licensed under CC BY-NC 4.0.\nfoo", "Plain words\nReleased under the MIT License.",
             "This work is licensed under the GNU General Public License, version 3.",
             "Licensed under the Apache License, Version 2.0.", MIT_TEXT,
             "# " + MIT_TEXT.replace("\n", "\n# "), "\n".join(BSD), "\n".join(BSD[:3]), BSD[0],
             "// SPDX-License-Identifier: MPL-2.0\ncode", "a licence to print money.", None, "",
             "Released under the MIT Licence. Licensed under the Apache License, Version 2.0."]
    assert scanned(make, texts) == [
        ["CC-BY-NC-4.0"], ["MIT"], ["GPL-3.0"], ["Apache-2.0"], ["MIT"], ["MIT"], ["BSD-3-Clause"],
        ["BSD-2-Clause"], [], ["MPL-2.0"], [], [], [], ["Apache-2.0", "MIT"]]
    left = licenses.scan(documents(make, [BSD[0]])).first()
    assert left["unmatched"] == "BsdGrant" and left["sentences"] == ["BsdGrant"]


def test_every_known_sentence_has_an_anchor():
    known = list(licenses.SENTENCES) + ["Licensed under the x", "SPDX-License-Identifier: x"]
    for text in known:
        assert any(a in text.lower() for a in licenses.ANCHORS), text
    assert len(set(licenses.sentence_table().values())) == len(licenses.SENTENCES)


def test_every_grant_verb_name_and_copyright_sign_counts(make):
    verbs = ("Licensed", "Released", "Distributed", "Made available", "Available", "Published", "Provided")
    texts = [f"{v} under GPL 2" for v in verbs] + [f"Released under {n}." for n in licenses.NAMES]
    texts += ["Code released under CC BY-SA 4.0.", "Released under the GPL v3."]
    want = [["GPL-2.0"]] * len(verbs) + [[n] for n in licenses.NAMES.values()] + [["CC-BY-SA-4.0"], ["GPL-3.0"]]
    assert scanned(make, texts) == want
    signs = licenses.scan(documents(make, ["\u00a9 2021 Jane Doe", "(c) 2021 Jane Doe", "(C) 2021"])).collect()
    assert [r["sentences"] for r in signs] == [["Copyright"]] * 3
    for piece in licenses.known_pieces():
        assert any(a in piece for a in licenses.ANCHORS), piece


APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
GPL_HEADER = """This program is free software{0} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{1} either version {2} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>."""


def test_copyright_and_spdx_take_only_their_line(make):
    mit = MIT_TEXT.split("\n\n")[-1]
    texts = ["Copyright 2020 Foo Inc\nLicensed under the MIT License.",
             "SPDX-License-Identifier: MIT\nSPDX-License-Identifier: ISC",
             "// SPDX-License-Identifier: Zlib\n" + mit, "Copyright (c) 2020 Foo\n" + mit]
    assert scanned(make, texts) == [["MIT"], ["ISC", "MIT"], ["MIT", "Zlib"], ["MIT"]]


def test_published_apache_and_gpl_headers(make):
    texts = [APACHE_HEADER, "# Copyright 2020 Foo\n" + re.sub("(?m)^", "# ", APACHE_HEADER),
             GPL_HEADER.format(":", ",", 3), GPL_HEADER.format(";", ";", 2), GPL_HEADER.format(";", ";", 3),
             " * " + GPL_HEADER.format(";", ",", 2).replace("\n", "\n * ")]
    assert scanned(make, texts) == [["Apache-2.0"], ["Apache-2.0"], ["GPL-3.0"], ["GPL-2.0"], ["GPL-3.0"],
                                    ["GPL-2.0"]]
    left = licenses.scan(documents(make, texts)).collect()
    assert [r["unmatched"] for r in left] == [""] * 6


# ---------------------------------------------------------------- op 7

def shingles(text):
    words = re.findall(r"[^ \t\n\v\f\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    k = min(5, len(words))
    return frozenset((k, *words[i:i + k]) for i in range(len(words) - k + 1))


def brute_components(texts):
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(sets)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if inter and 100 * inter >= 75 * len(sets[i] | sets[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [(i, len(s), find(i), find(i) == i) for i, s in enumerate(sets)]


def near_corpus(seed, bases=12, copies=25, length=80):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rnd.choice(vocab) for _ in range(30)]
    out = list(ODD)
    for b in range(bases):
        base = [rnd.choice(vocab) for _ in range(rnd.randint(4, length))]
        if b % 3 == 0:
            base += passage
        for _ in range(copies if b < 3 else 4):
            text = list(base)
            for _ in range(rnd.randint(0, 4)):
                text[rnd.randrange(len(text))] = rnd.choice(vocab).upper()
            out.append(" ".join(text))
    rnd.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_equal_brute_force(make, seed):
    texts = near_corpus(seed)
    got = near_dup.near_duplicates(documents(make, texts))
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == brute_components(texts)


def test_near_duplicates_large_node_without_links(make, monkeypatch):
    """Documents that share a passage, too many for a small node, with a few links among them."""
    rnd = random.Random(8)
    monkeypatch.setattr(near_dup, "SMALL", 8)          # so that nodes branch on
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [passage + " " + " ".join(f"u{i}x{k}" for k in range(45)) for i in range(60)]
    texts += [t.replace("x44", "y") for t in texts[:20]]
    rnd.shuffle(texts)
    got = near_dup.near_duplicates(documents(make, texts))
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == brute_components(texts)


def test_branching_keeps_pairs_at_the_threshold(spark):
    """Planted pairs at 0.75 and 0.80 still meet after many levels, in whatever tree."""
    rng = np.random.default_rng(12)
    n = 400
    rows, paths = [], []
    for i in range(n):
        a = rng.integers(0, 256, near_dup.SKETCH).astype(np.uint8)
        same = rng.random(near_dup.SKETCH) < (0.75 if i < n // 2 else 0.80)
        b = np.where(same, a, a + np.uint8(1)).astype(np.uint8)
        rows += [(2 * i, a.tobytes()), (2 * i + 1, b.tobytes())]
        paths += [(t, i * near_dup.TREES + t, r, r) for t in range(near_dup.TREES)
                  if rng.random() < same.mean() for r in (2 * i, 2 * i + 1)]
    reps = spark.createDataFrame(rows, "rep long, sketch binary").cache()
    at = spark.createDataFrame(paths, "tree int, node long, rep long, component long")
    for _ in range(8):
        at = near_dup._branch(at, reps)
        shared = at.groupBy("node").count().where("count > 1").select("node")
        at = near_dup.cut(at.join(shared, "node").select("tree", "node", "rep", "component"))
    met = {r["rep"] // 2 for r in at.select("rep").distinct().collect()}
    assert len(met) >= n - 2


def test_node_pairs_once_and_strongest_forest():
    """Every pair of agreeing members comes once over all nodes; the forest weighs as much as Kruskal's."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 256, near_dup.SKETCH).astype(np.uint8)
    sketches = np.where(rng.random((150, near_dup.SKETCH)) < 0.82, base, rng.integers(
        0, 256, (150, near_dup.SKETCH))).astype(np.uint8)
    same = (sketches[:, None] == sketches[None]).sum(-1)
    want = set(zip(*[x.tolist() for x in np.nonzero(np.triu(same >= near_dup.SCREEN, 1))]))
    members = {node: sorted(rng.choice(150, 90, replace=False).tolist()) for node in (-7, 0, 5, 12)}
    seen = []
    for node, at in members.items():
        i, j = near_dup.node_pairs(at, sketches[at], False)
        new = near_dup.first_meetings(i, j, node, [
            sorted(x for x in members if m in members[x]) for m in at])
        seen += [(at[x], at[y]) for x, y in zip(i[new].tolist(), j[new].tolist())]
    assert len(seen) == len(set(seen))
    assert set(seen) == {p for p in want if any(p[0] in m and p[1] in m for m in members.values())}
    root, weight = list(range(150)), 0
    for x, y in sorted(want, key=lambda p: -same[p]):
        if root[x] != root[y]:
            weight += same[x, y]
            root = [root[y] if r == root[x] else r for r in root]
    i, j = near_dup.node_pairs(list(range(150)), sketches, True)
    assert weight == same[i, j].sum()


def test_near_duplicates_odd_ids(make):
    docs = make([(None, "a b c d e f", "", "", 1), (5, "a b c d e f", "", "", 1), (5, "a b c d e f", "", "", 1),
                 (3, "x y", "", "", 1), (None, None, "", "", None)], DOCS)
    got = sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"])
                 for r in near_dup.near_duplicates(docs).collect())
    assert got == [("3", "3", True), ("5", "5", True), ("5", "5", True), ("None", "None", False),
                   ("None", "None", False)]
    assert near_dup.near_duplicates(docs.where("doc_id < 0")).count() == 0


def test_near_duplicates_one_id_on_many_texts(make):
    """Each text is judged by its own set, though id 1 is the smallest of several."""
    def words(c, n=30):
        return " ".join(f"{c}{i}" for i in range(n))
    rows = [(1, words("a")), (1, words("b")), (1, words("c")), (7, words("c", 29) + " x"),
            (8, words("b", 29) + " x"), (9, words("a", 29) + " x"), (6, words("d")), (1, words("e"))]
    docs = make([(i, t, "", "", 1) for i, t in rows], DOCS)
    got = sorted((r["doc_id"], r["component_id"]) for r in near_dup.near_duplicates(docs).collect())
    assert got == [(1, 1)] * 4 + [(6, 6), (7, 1), (8, 1), (9, 1)]


def test_keep_first_leaves_one_row_a_group(make, spark):
    """The pipeline's stage against brute force, with repeated ids, repeated rows and null ids."""
    import corpus_pipeline

    def words(c, n=30):
        return " ".join(f"{c}{i}" for i in range(n))
    rows = [(5, words("x")), (5, words("y")), (3, words("y", 29) + " z"), (6, words("x", 29) + " z"),
            (8, words("v")), (8, words("v")), (8, words("v")), (9, words("v").upper()),
            (2, words("w")), (2, words("w", 29) + " z"), (4, None), (4, None), (4, " "), (4, "q"),
            (None, words("x")), (None, words("x")), (None, None)]
    docs = make([(i, t, "en", "", 1) for i, t in rows], DOCS)
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_dup_stage(spark, docs, "").collect()]
    sets = {t: shingles(t) for _, t in rows}
    groups = []
    for row in sorted({r for r in rows if r[0] is not None}, key=lambda r: (r[0], str(r[1]))):
        a = sets[row[1]]
        hits = [g for g in groups if a and any(
            100 * len(a & sets[t]) >= 75 * len(a | sets[t]) for _, t in g)]
        groups = [g for g in groups if g not in hits] + [sum(hits, [row])]
    alone = [r for r in got if r[0] is not None]
    assert len(alone) == len(groups) and got.count((None, words("x"))) == 2 and (None, None) in got
    for g in groups:
        kept = [r for r in alone if r in g]
        assert len(kept) == 1 and kept[0][0] == min(i for i, _ in g)


def test_stages_take_clashing_names_and_maps(make, spark):
    """Columns named as the stages' own, a map column, rows that differ only in such columns."""
    import corpus_pipeline

    def words(c, n=30):
        return " ".join(f"{c}{i}" for i in range(n))
    schema = ("doc_id long, text string, _text string, _row string, _BID long, _bth long, set_id string, "
              "component string, more map<string, int>")
    rows = [(1, words("a"), "t1", "r", 5, 6, "s", "c", {"k": 1}),
            (2, words("a"), "t2", "r", 5, 6, "s", "c", None),
            (3, words("b"), "t3", None, None, 6, "s", "c", {"k": 1}),
            (3, words("b"), "t4", None, None, 6, "s", "c", {"k": 2}),
            (4, words("c"), "t5", "r", 5, 6, "s", "c", {}),
            (None, None, None, None, None, None, None, None, None)]
    docs = make(rows, schema)
    got = near_dup.keep_first(docs)
    assert got.columns == docs.columns
    kept = [tuple(r) for r in got.collect()]
    assert all(r in rows for r in kept) and len(kept) == 4
    assert sorted(r[0] for r in kept if r[0]) == [1, 3, 4]
    assert near_dup.keep_first(make(rows[::-1], schema, 3)).where("doc_id = 3").collect() \
        == got.where("doc_id = 3").collect()

    bench = make([(7, words("c"))], "item_id long, text string")
    clean = decontam.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(str(r["_text"]) for r in clean.collect()) == ["None", "t1", "t2", "t3", "t4"]
    coded = corpus_pipeline.bpe_stage(spark, docs, "")
    assert coded.columns == ["doc_id", "ids", "decoded", "n_tokens"] and coded.count() == 6


# ---------------------------------------------------------------- op 8

def test_sharding_balances_every_source(make):
    texts = ODD + [f"t{i}" * (i % 7) for i in range(300)]
    docs = documents(make, texts, parts=4)
    got = sharding.shard(docs).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(len(texts)))
    sizes, mix = {}, {}
    for r in got:
        t = texts[r["doc_id"]]
        assert r["size"] == len((t or "").encode()) + 1 and r["text_crc32"] == zlib.crc32((t or "").encode())
        sizes.setdefault(r["shard"], []).append(r["slot"])
        mix[r["source"], r["shard"]] = mix.get((r["source"], r["shard"]), 0) + 1
    assert sorted(sizes) == list(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in sizes.values())
    assert max(map(len, sizes.values())) - min(map(len, sizes.values())) <= 1
    for source in {r["source"] for r in got}:
        n = [mix.get((source, s), 0) for s in range(8)]
        assert max(n) - min(n) <= 2
    again = sharding.shard(documents(make, texts, parts=2))
    assert rows_of(again, "doc_id", "shard", "slot") == sorted(
        (r["doc_id"], r["shard"], r["slot"]) for r in got)


def test_sharding_odd_rows(make):
    docs = make([(1, "a", "", "s", 1)] * 3 + [(None, None, "", None, None)], DOCS)
    got = sharding.shard(docs).collect()
    assert sorted((r["shard"], r["slot"]) for r in got) == [(0, 0), (2, 0), (4, 0), (6, 0)]
    assert sharding.shard(docs.where("doc_id < 0")).count() == 0


# ---------------------------------------------------------------- op 9

def test_fingerprints_estimate_similarity(make):
    rnd = random.Random(1)
    vocab = [f"w{i}" for i in range(3000)]
    base = [rnd.choice(vocab) for _ in range(400)]
    texts = [" ".join(base)]
    for cut in (0, 20, 60, 120, 200):
        texts.append(" ".join(base[:400 - cut] + [rnd.choice(vocab) for _ in range(cut)]))
    texts += [" ".join(rnd.choice(vocab) for _ in range(n)) for n in (8, 30, 400)]
    df = fingerprint.fingerprints(documents(make, texts))
    digits = {r["doc_id"]: r["digits"] for r in df.collect()}
    for i in range(1, len(texts)):
        a, b = shingles(texts[0]), shingles(texts[i])
        same = sum(x == y for x, y in zip(digits[0], digits[i])) / 256
        est = max(0.0, (same - 1 / 16) / (15 / 16))
        assert abs(est - len(a & b) / len(a | b)) < 0.12


def test_edited_texts_and_odd_rows(make, spark):
    texts = ["abcdefgh ij", None, "", "é😀xyzw one two three four five", "QQ"] + ODD
    docs = documents(make, texts)
    docs = docs.unionByName(make([(None, "no id here at all my friend", "", "", 1)], DOCS))
    got = {r["doc_id"]: r for r in fingerprint.with_next_edit(docs).collect()}
    for i, t in enumerate(texts):
        t, nxt = t or "", texts[(i + 1) % len(texts)] or ""
        q = len(t) // 4
        assert got[i]["edited"] == t[:len(t) - q] + nxt[:q], i
        assert got[i]["n_chars"] == len(t)
    assert got[None]["edited"] == "no id here at all my "
    assert got[1]["digits"] is None and got[5]["digits"] is None
    assert got[4]["digits"] is not None
    twice = docs.where("doc_id = 3").union(docs.where("doc_id = 3"))
    made = fingerprint.with_next_edit(twice).collect()
    assert len(made) == 2 and made[0] == made[1]
    assert fingerprint.with_next_edit(docs.where("doc_id < -1")).count() == 0


def test_equal_texts_have_equal_fingerprints(make):
    df = fingerprint.fingerprints(documents(make, ODD + ODD))
    got = {r["doc_id"]: r["fingerprint"] for r in df.collect()}
    assert all(got[i] == got[i + len(ODD)] and len(got[i]) == 256 for i in range(len(ODD)))
    assert got[0] == "0" * 256


# ---------------------------------------------------------------- op 10

def word_list(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_contamination(texts, items, window=13):
    out = []
    for d, text in enumerate(texts):
        words, hit, found = word_list(text), set(), set()
        for item, body in items:
            w = word_list(body)
            runs = [w[i:i + window] for i in range(max(1, len(w) - window + 1))] if w else []
            for run in runs:
                for s in range(len(words) - len(run) + 1):
                    if words[s:s + len(run)] == run:
                        hit.update(range(s, s + len(run)))
                        found.add(item)
        found.discard(None)
        out.append((d, len(words), len(hit), tuple(sorted(found))))
    return out


def test_contamination_equals_brute_force(make):
    rnd = random.Random(3)
    vocab = [f"v{i}" for i in range(30)] + ["É", "x-y", "Straße"]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(n)))
             for i, n in enumerate([1, 2, 3, 4, 5, 6, 12, 13, 14, 20, 40, 40])]
    items += [(20, items[8][1]), (21, None), (22, "--"), (23, "a a a a a a a a a a a a a a a"), (4, items[4][1])]
    texts = list(ODD)
    for _ in range(60):
        words = [rnd.choice(vocab) for _ in range(rnd.randint(0, 40))]
        for _ in range(rnd.randint(0, 2)):
            body = rnd.choice(items)[1] or ""
            part = body.split()[rnd.randint(0, 3):]
            at = rnd.randint(0, len(words))
            words[at:at] = part if rnd.random() < 0.8 else [w.upper() + "," for w in part]
        texts.append(" ".join(words))
    texts += ["a " * 40, "A a.a"]
    bench = make(items + [(None, "q w e r t y")], "item_id long, text string")
    got = decontam.contamination(documents(make, texts), bench).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], tuple(sorted(r["items"]))) for r in got) \
        == brute_contamination(texts, items)


def test_contamination_odd_tables(make):
    docs = make([(1, "a b c", "", "", 1)] * 2 + [(None, "a b c", "", "", 1), (1, "other", "", "", 1)], DOCS)
    bench = make([(7, "A, b")], "item_id long, text string")
    got = decontam.contamination(docs, bench)
    assert sorted((str(r["doc_id"]), r["n_hit"]) for r in got.collect()) == [
        ("1", 0), ("1", 2), ("1", 2), ("None", 2)]
    assert [r["text"] for r in decontam.drop_contaminated(docs, bench).collect()] == ["other"]
    none = bench.where("item_id < 0")
    assert {r["n_hit"] for r in decontam.contamination(docs, none).collect()} == {0}
    assert decontam.contamination(docs.where("doc_id < 0"), bench).count() == 0


def test_queries_have_the_contracts_columns(spark, sf_small):
    got = queries.op10_decontamination(spark, sf_small)
    assert got.columns[:6] == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    shard = queries.op8_sharding(spark, sf_small)
    assert shard.columns[:7] == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    prints = queries.op9_fingerprints(spark, sf_small)
    assert prints.where("near_edited < 0 or near_edited > 1").count() == 0
    assert hashlib.sha256(b"").hexdigest() == got.where("n_items = 0").first()["items_sha256"]
