"""Operators 3, 5 and 6 against the public libraries and brute force."""

import json
import random
import re

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, pre_tokenizers

from tremor.llm import bpe, secret_scan, token_count

VOCAB = public_tokenizers.path("word_bpe_49k.json")
PIECES = token_count.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def ours():
    with open(VOCAB, "rb") as f:
        return bpe.ForcedBoundaryBpe(f.read(), cache=500)


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(VOCAB)
    t.no_truncation()
    t.no_padding()
    return t


TEXTS = ["", " ", "a", "Hello  World's it's we'll", "don't STOP\n\tnow", "<|endoftext|>x<|startoftext|> y",
         "naïve café ñandú ÉÇÈ straße ẞ ΑΣ ΌΔΟΣ İstanbul", "12345 6 ½ Ⅷ", "é ä", "!!! ?? ***...###",
         "日本語テキスト 漢字", "🎉👍🏽", "a\x1cb\x1fc\x85d e f　g", "x" * 3000, "ab" * 900 + "!" * 700,
         "</w> <w>", "<|endoftext", "the<|ENDOFTEXT|>"]


def test_bpe_equals_library(ours, library):
    for t in TEXTS:
        ids = library.encode(t, add_special_tokens=False).ids
        assert ours.encode(t) == ids, t
        assert ours.decode(ids) == library.decode(ids, skip_special_tokens=False)


@given(st.text(max_size=60))
@settings(max_examples=400, deadline=None)
def test_bpe_equals_library_on_any_text(text):
    lib, own = _pair()
    assert own.encode(text) == lib.encode(text, add_special_tokens=False).ids


_MADE = []


def _pair():
    if not _MADE:
        with open(VOCAB, "rb") as f:
            _MADE.extend((Tokenizer.from_file(VOCAB), bpe.ForcedBoundaryBpe(f.read(), cache=50)))
    return _MADE


def test_bpe_of_many_texts_together(library, monkeypatch):
    """Any grouping gives every text its own ids, whatever is merged beside it."""
    rnd = random.Random(11)
    made = ["".join(rnd.choice("aeioustnrlé ñß'.,!1 日\t\x85\xa0") for _ in range(rnd.randrange(400)))
            for _ in range(60)]
    edge = ["x" * n + " " + "ab" * n for n in (49, 50, 51, 99, 100, 101)]
    texts = [None, *TEXTS, *made, *edge, *made[:5], "a<|endoftext|>日本 b<|startoftext|>"]
    wanted = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    for together, part in ((1 << 17, 1 << 20), (1, 1), (37, 200)):
        monkeypatch.setattr(bpe, "TOGETHER", together)
        monkeypatch.setattr(bpe, "PART", part)
        with open(VOCAB, "rb") as f:
            own = bpe.ForcedBoundaryBpe(f.read(), cache=30)
        assert own.encode_all(texts) == wanted
    assert own.encode_all([]) == []


def test_merging_long_and_short_fragments_agrees(ours):
    rnd = random.Random(5)
    words = ["".join(rnd.choice("aeithnosrq") for _ in range(rnd.randrange(1, 60))) for _ in range(300)]
    one = [tuple(i for part in ours.fragments(w) for i in ours._merge_long(*part)) for w in words]
    assert ours.merge_words(words) == one


def test_forced_boundaries_cut_words(ours):
    assert len(ours.fragments("qzxÃ±æ¼")) > 1
    assert "".join(ours.tokens[i] for ids, _ in ours.fragments("hello") for i in ids) == "hello</w>"


def test_cache_is_bounded():
    with open(VOCAB, "rb") as f:
        own = bpe.ForcedBoundaryBpe(f.read(), cache=10)
    own.encode(" ".join(f"w{i}" for i in range(500)))
    for held in (own.words, own.chunks):
        assert len(held.young) <= 10 and len(held.old) <= 10


@given(st.text(alphabet=st.characters(max_codepoint=0x24f), max_size=40))
@settings(max_examples=400, deadline=None)
def test_bpe_equals_library_on_latin_text(text):
    lib, own = _pair()
    assert own.encode(text) == lib.encode(text, add_special_tokens=False).ids


def test_every_latin_character_is_split_as_the_library_does():
    lib, own = _pair()
    for c in map(chr, range(0x180)):
        for text in (c, f"a{c}b", f"1{c}'s", f"!{c}!", f"{c}{c.upper()}"):
            assert own.encode(text) == lib.encode(text, add_special_tokens=False).ids, repr(text)


def test_latin_way_needs_the_files_own_steps():
    with open(VOCAB, "rb") as f:
        spec = json.loads(f.read())
    assert bpe._latin_pattern(spec) is not None
    spec["normalizer"]["normalizers"].pop()
    assert bpe._latin_pattern(spec) is None
    assert bpe._latin_pattern(spec | {"normalizer": None, "pre_tokenizer": None}) is None


@pytest.fixture(scope="module")
def unigram():
    t = Tokenizer(models.Unigram(PIECES, unk_id=0, byte_fallback=True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=False)
    return t


def test_viterbi_counts_equal_library(unigram):
    own = token_count.UnigramCounter(PIECES, cache=100)
    rnd = random.Random(3)
    texts = TEXTS + ["<s> <unk> <0x41> </s>", "a▁b▁▁c", "▁x", "▁", "  two  spaces ", "\n\n\tmixed",
                     "a    b", "x\n    y", " " * 40, "a" + " " * 33 + "b ", "▁▁  ▁"]
    texts += ["".join(rnd.choice("aei  str  n thäé漢\n▁z") for _ in range(rnd.randint(1, 60)))
              for _ in range(400)]
    for t in texts:
        want = len(unigram.encode(t, add_special_tokens=False).ids) if t else 0
        assert own.text(t)[1] == want, repr(t)
    assert own.text(None) == (0.0, 0)


def test_pieces_of_several_marks_are_reached():
    own = token_count.UnigramCounter(PIECES)
    assert own.splits and sum(len(p) > 1 and set(p) == {token_count.MARK} for p, _ in PIECES) == 14
    assert own.text("a    b")[1] == 3 and not own.text("z" * 500 + " b")[1] == 0
    assert all(len(w) <= token_count.LONG for w in own.young)
    inside = token_count.UnigramCounter([("<unk>", -9.0), ("▁", -2.0), ("a", -2.0), ("a▁a", -1.0)])
    assert not inside.splits and inside.text("a a") == (-3.0, 2)


def test_viterbi_ties_prefer_the_leftmost_start():
    pieces = [("<unk>", 0.0), ("▁", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁ab", -2.0)]
    own = token_count.UnigramCounter(pieces)
    lib = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=False))
    assert own.word("▁ab")[1] == len(lib.encode("▁ab").ids) == 1


def slow_base(text):
    """Base spans by trying each pattern at each place."""
    out = []
    names = re.compile(r"password|passwd|secret|token|api_?key", re.I | re.A)
    at = 0
    while at < len(text):
        if m := names.match(text, at):
            rest = re.compile(r"[\"']? *[:=] *[\"']?").match(text, m.end())
            value = rest and re.compile(r"[A-Za-z0-9+/_.=-]+").match(text, rest.end())
            if value:
                if len(value[0]) >= 6:
                    out.append(("assign", at, value.end()))
                at = value.end()
                continue
        at += 1
    for kind, pat, least in (("access", r"AKIA[A-Z0-9]+", 20), ("hex", r"[0-9a-f]+", 24)):
        out += [(kind, *m.span()) for m in re.finditer(pat, text) if len(m[0]) >= least]
    return out


SECRETS = ["password=token:abcdefgh", "Password : 'abc.def=ghi'", 'API_KEY="AKIA' + "A1" * 9 + '"',
           "tokeN = " + "0af" * 9, "ſecret=abcdefg toKen=abcdefg", "passwd=abc", "secret==abcdefg",
           "AKIA" + "B" * 15, "é😀 apikey:zzzzzzz", "f" * 23 + " " + "f" * 24, "token\n=abcdefgh"]


def test_base_spans_equal_brute_force():
    rnd = random.Random(5)
    bits = ["password", "token", "api_key", "=", ":", " ", '"', "abc123", "AKIA", "A1B2C3D4E5F6G7H8",
            "deadbeefdeadbeefdeadbeef", "é", "\n", "x"]
    texts = SECRETS + ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 14)))
                       for _ in range(3000)]
    for t in texts:
        assert sorted(secret_scan.base_spans(t)) == sorted(slow_base(t)), t


def literals(text):
    return [text[s:e] for k, s, e in secret_scan.scan(text) if k == "literal"]


def test_method_finds_literals_by_target_name():
    assert literals('db_pwd: "hunter2Zq9x"') == ["hunter2Zq9x"]
    assert literals('AUTH_CREDENTIAL => \'k9Zq8-77ab\'') == ["k9Zq8-77ab"]
    assert literals('color = "blue-green-77"') == []
    assert literals('db_pwd = "changeme"') == []


def test_method_propagates_constants():
    assert literals('x1 = "hunter2Zq9x"\ny = x1\nclient_pwd = $y') == ["hunter2Zq9x"]
    assert literals('client_pwd = later\nlater = "hunter2Zq9x"') == ["hunter2Zq9x"]
    assert literals('a = "Zk81-9qpL" + b\nb = "77vvT0-x"\nprivate_key = a') == ["Zk81-9qpL", "77vvT0-x"]
    assert literals('a = b\nb = a\na = "q8Zk81-9qpL"\n') == []


def test_base_spans_stay_and_prose_is_left_alone():
    text = 'note: the colour = red; password=abc123def'
    assert [s[0] for s in secret_scan.scan(text)] == ["assign"]
    assert secret_scan.scan(None) == secret_scan.scan("") == []


def test_lexer_is_linear_on_long_runs():
    for t in ("a-" * 100_000, "a." * 100_000, "=" * 200_000, "a=" * 50_000, '"' * 100_000, "a = \"" * 30_000):
        secret_scan.scan(t)


def test_redaction_removes_every_span():
    text = 'é token = "0af0af0af0af0af0af0af0af0af" tail AKIA' + "Z9" * 10
    clean = secret_scan.redact(text)
    assert clean.count("[secret]") == 2 and secret_scan.scan(clean) == []
    assert clean.startswith("é ") and " tail " in clean


def test_vocabulary_bound():
    import os
    assert os.path.getsize(VOCAB) < 4 << 20
    assert json.load(open(VOCAB))["decoder"] is None
