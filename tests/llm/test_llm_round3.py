"""Operators 11 to 13 against brute-force versions, with the odd cases of every column."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tremor.llm import conversation, manifest, queries, toxicity
from tremor.llm.oracle import ORACLE_SQL
from oracle.compare import compare, connect

TURNS = "conv_id long, turn long, role string, text string, start string, _row int"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, grp string, node string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- op 11

def brute_repair(rows):
    """``(cost, edits, repaired)`` by trying every state in turn; rows: (role, text, fault)."""
    best = {"": (0, "", ())}         # grammar state -> (cost, edits, repaired)

    def follow(state, initial):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"} \
            .get((state, initial))

    def least(options):
        out = {}
        for state, x in options:
            if state is not None and (state not in out or x[:2] < out[state][:2]):
                out[state] = x
        return out

    def inserted(states):
        for _ in range(3):
            states = least([*states.items(), *[
                (follow(s, r[0]), (c + 2, e + "I", t + ((r, ""),)))
                for s, (c, e, t) in states.items() for r in ("user", "assistant")]])
        return states

    for role, text, fault in rows:
        options = []
        for s, (c, e, t) in inserted(best).items():
            options.append((s, (c + 3, e + "D", t)))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if role[:1] in ("s", "u", "a"):
                    options.append((follow(s, role[:1]), (c + more, e + "K", t + ((role, text),))))
                for r in ("user", "assistant"):
                    options.append((follow(s, r[0]), (c + 2 + more, e + "R", t + ((r, text),))))
        best = least(options)
    ends = inserted(best)
    return min(ends[s] for s in ("", "a") if s in ends)


def brute_conversations(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        mine.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1].encode(), sha(m[2])))
        seen, marked = set(), []
        for _, role, text in mine:
            last = re.sub(r"[\x20\x09-\x0D]+$", "", text)[-1:]
            fault = ("blank" if not last else "duplicate" if (role, text) in seen
                     else "truncated" if last not in ".!?" else "")
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [t for t, _, _ in mine if t is not None]
        cost, audit, made = brute_repair(marked)
        faults = [f for _, _, f in marked]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                     *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                     sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:])),
                     cost, audit, sha("\n".join(f"{r}:{t}" for r, t in made)))
    return out


def solved(df, given=None):
    made = conversation.with_digest(df, conversation.plan(df, given))
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = made.collect()
    assert len(rows) == len({r["conv_id"] for r in rows})
    return {r["conv_id"]: tuple(r[n] for n in names) for r in rows}


def talk(rnd, conv, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    texts = ["Hello.", "Yes!", "open end", "Why? ", " \t", "", None, "é.", "x" * 50 + "."]
    return [(conv, rnd.choice([*range(n), None]) if rnd.random() < 0.2 else i, rnd.choice(roles),
             rnd.choice(texts)) for i in range(n)]


@pytest.mark.parametrize("block, stretch", [(65_536, 4_096), (3, 2)])
def test_repair_equals_brute_force(make, monkeypatch, block, stretch):
    monkeypatch.setattr(conversation, "BLOCK", block)
    monkeypatch.setattr(conversation, "STRETCH", stretch)
    rnd = random.Random(block)
    rows = [r for c in range(60) for r in talk(rnd, c if c else None, rnd.randint(1, 9))]
    rows += talk(rnd, 100, 150)                                      # one over many partitions
    rows += [(101, i, "user", "same.") for i in range(70)] + [(102, 5, "assistant", "same.")] * 40
    rows += [(103, i, "user", f"q{i}") for i in range(90)]          # one run
    df = make([(*r, "x", 7) for r in rows], TURNS, 5)
    assert solved(df) == brute_conversations(rows)


def test_powers_of_a_run_equal_single_steps():
    steps = conversation.Steps()
    for symbol in "suaxSUAX-":
        vector = steps.end
        for n in range(1, 70):
            vector = conversation._times(steps.power(symbol, 0), vector)
            assert steps.back(symbol, n, steps.end) == vector
    cost, audit = steps.solve([("u", 100_000), ("-", 3), ("a", 1)])
    assert len(audit.replace("I", "")) == 100_004
    assert cost == sum({"K": 0, "R": 2, "I": 2, "D": 3}[e] for e in audit)


def test_conversations_without_rows_and_empty_tables(make):
    df = make([(1, 0, "user", "Hi.", "", 0), (2, 0, "user", "Hi.", "", 0)], TURNS)
    got = solved(df.where("conv_id = 1"), df)
    assert got[2] == (0, 0, 0, 0, 0, 0, "", sha("")) and got[1][5:7] == (2, "KI")
    assert solved(df.where("conv_id > 5")) == {}
    rows = conversation.repaired(df, conversation.plan(df)).collect()
    assert sorted((r["conv_id"], r["place"], r["role"], r["text"]) for r in rows) == [
        (c, *x) for c in (1, 2) for x in ((0, "user", "Hi."), (1, "assistant", ""))]


def test_damage_follows_the_hash(make):
    rows = [(c, t, "assistant", "A. b!") for c in range(40) for t in (0, 1, None)]
    rows += [(None, 3, None, None)]
    want = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = r or " ", x or " "
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        want += [(c, t, "user" if kind == 4 else r, x)] * {0: 0, 3: 2}.get(kind, 1)
    got = conversation.damage(make([(*r, "", 0) for r in rows], TURNS))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


# ---------------------------------------------------------------- op 12

def brute_manifest(rows):
    """(doc_id, text) -> (leaf, subroot, root, siblings) of rows without repeats."""
    def code(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def tree(nodes):
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for p, i in zip(paths, at):
                if i ^ 1 < len(nodes):
                    p.append(nodes[i ^ 1])
            nodes = [sha("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
            at = [i >> 1 for i in at]
        return nodes[0], paths
    groups = {}
    for d, text, lang, source, n, *_ in rows:
        leaf = sha("".join(map(code, (d, source, lang, n, text))))
        groups.setdefault(lang, []).append((d is not None, d or 0, leaf))
    subs, out = {}, []
    for lang, leaves in groups.items():
        leaves.sort()
        subs[lang] = tree([x[2] for x in leaves])
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    root, tops = tree([subs[x][0] for x in langs])
    for lang, top in zip(langs, tops):
        for (known, d, leaf), path in zip(groups[lang], subs[lang][1]):
            out.append((str(d if known else None), leaf, subs[lang][0], root, tuple(path + top)))
    return sorted(out)


@pytest.mark.parametrize("bits", [1, 2, 6])
def test_manifest_equals_brute_force(make, monkeypatch, bits):
    monkeypatch.setattr(manifest, "BITS", bits)
    rnd = random.Random(bits)
    langs = [None, "", "de", "en", "en", "é", "z"]
    rows = [(rnd.randrange(90), rnd.choice([None, "", "a", "é" * 9, "w " * 3000]), rnd.choice(langs),
             rnd.choice([None, "s"]), rnd.choice([None, 3, 4]), "g", "n") for _ in range(130)]
    rows += [(None, "no id", "en", "s", 1, "g", "n"), (7, "alone", "xx", None, 1, "g", "n")]
    rows += [(5, "repeated", "en", "s", 2, "g", "n")] * 9
    got = manifest.manifest(make(rows, DOCS, 5)).collect()
    assert sorted((str(r["doc_id"]), r["leaf"], r["subroot"], r["root"],
                   tuple(p["sibling"] for p in r["path"] if p["sibling"])) for r in got) \
        == brute_manifest(rows)


def test_folded_roots_show_tampering(make):
    rows = [(i, f"t{i}", "en", "s", None if i % 5 == 0 else i, "g", "n") for i in range(80)]
    from pyspark.sql import functions as F
    changed = F.when(F.col("doc_id") % 7 == 0, manifest.leaf_hash(n_chars=F.col("n_chars") + 1))
    made = manifest.manifest(make(rows, DOCS), changed)
    fits = made.select("doc_id", (manifest.fold(F.coalesce("changed_leaf", "leaf"), F.col("path"))
                                  == F.col("root")).alias("fits"))
    assert {r["doc_id"] for r in fits.where("not fits").collect()} == \
        {i for i in range(80) if i % 7 == 0 and i % 5}
    assert manifest.manifest(make(rows, DOCS).where("doc_id < 0")).count() == 0


def test_manifest_writes_no_file_for_every_shuffle_partition(spark, make, monkeypatch):
    cuts = []
    monkeypatch.setattr(manifest, "cut", lambda df, f=manifest.cut: cuts.append(f(df)) or cuts[-1])
    cores = spark.sparkContext.defaultParallelism
    rows = [(i, f"t{i}", "en" if i % 3 else "de", "s", i, "g", "n") for i in range(300)]
    held = {"spark.sql.shuffle.partitions": "37", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        made = manifest.manifest(make(rows, DOCS))
        assert [df.rdd.getNumPartitions() <= cores for df in cuts] == [True] * 3
        assert made.rdd.getNumPartitions() <= cores
        assert made.select("doc_id").distinct().count() == 300
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["op11_conversations", "op12_manifest"])
def test_queries_equal_their_sql(spark, sf_small, name):
    ok, msg = compare(queries.QUERIES[name](spark, sf_small), connect(sf_small), ORACLE_SQL[name])
    assert ok, msg


# ---------------------------------------------------------------- op 13

SEEN = "doc_id long, text string, lang string, raw string, features string"


def corpus(n):
    rnd = random.Random(4)
    words = [a + b for a, b in itertools.product("ba ke lo mi su ta re no".split(), repeat=2)]
    rows, labels = [], []
    for i in range(n):
        text = [rnd.choice(words) for _ in range(rnd.randint(5, 60))]
        bad = rnd.random() < 0.25
        for _ in range(rnd.randint(1, 3) if bad else 0):
            text.insert(rnd.randrange(len(text)), rnd.choice(["vrotz", "plumf", "grax" + rnd.choice(words)]))
        rows.append((i, " ".join(text), "en", "", ""))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_of_held_out_documents(make):
    rows, labels = corpus(1200)
    docs, marks = make(rows, SEEN), make(labels, "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, marks)).collect()
    assert len(got) == 1200 and all(0 <= r["score"] <= 1 for r in got)
    truth = dict(labels)
    out = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in out} == {i for i in range(1200) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in out) / len(out) > 0.97


def test_held_out_labels_and_other_columns_change_nothing(make):
    rows, labels = corpus(300)
    docs = make(rows, SEEN)
    held = {i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0}

    def scores(d, marks):
        model = toxicity.fit(d, make(marks, "doc_id long, toxic int"))
        return sorted((r["doc_id"], r["score"]) for r in toxicity.score(d, model).collect())
    want = scores(docs, labels)
    assert scores(docs, [(i, 1 - t if i in held else t) for i, t in labels]) == want
    assert scores(make([(i, t, "xx", "q", "f") for i, t, *_ in rows], SEEN, 2), labels) == want


def test_toxicity_of_odd_rows(make):
    rows, labels = corpus(200)
    odd = [(1000, None, None, "", ""), (1001, "", "", "", ""), (1002, " \t\n", "", "", ""), (None, "vrotz", "", "", ""),
           (1003, "vrotz " * 50_000, "", "", ""), (1003, "ba ke", "", "", ""), (3, "a" * 300_000 + "!1" * 1000, "", "", "")]
    docs = make(rows + odd + odd[:1], SEEN)
    marks = labels + [(None, 1), (5, None), (7, 0), (7, 1)]
    model = toxicity.fit(docs, make(marks, "doc_id long, toxic int"))
    got = toxicity.score(docs, model).collect()
    assert len(got) == 208 and [r["held_out"] for r in got if r["doc_id"] is None] == [False]
    same = {r["score"] for r in got if r["doc_id"] in (1000, 1001, 1002)}
    assert len(same) == 1
    none = make(marks, "doc_id long, toxic int").where("doc_id < 0")
    assert {r["score"] for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0.0}
    assert toxicity.score(docs.where("doc_id < 0"), model).count() == 0
    many = toxicity.training_rows(docs, make(marks, "doc_id long, toxic int"), 20).collect()
    assert len(many) == 20 and len({r["doc_id"] for r in many}) == 20


def test_features_by_hand():
    f = toxicity._featurer({"idiot": 3.0, "^tra": 2.0})
    x = dict(zip(toxicity.FEATURES, f("You id1ot!! TRASHY stuff, trash.")))
    assert x["masked_hits"] == x["masked"] == 1 / 6 and x["exclamations"] == 2 / 6
    assert x["hits"] > 0 and x["top_weight"] == 2.0 and x["you_rate"] == 1 / 6 and x["shouts"] == 1 / 6
    assert x["you_near"] == 0.25
    assert f(None) == f(" ") == [0.0] * len(toxicity.FEATURES)
