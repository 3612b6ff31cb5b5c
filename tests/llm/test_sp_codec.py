"""The codec on models made here by hand (no training): unigram and BPE, with and without a normaliser, against sentencepiece."""

import os
import random
import struct

import pytest
import sentencepiece

from seamwright.llm import sp_codec


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def field(number, value):
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, (bytes, str)):
        value = value.encode() if isinstance(value, str) else value
        return varint(number << 3 | 2) + varint(len(value)) + value
    return varint(number << 3) + varint(int(value))


def model(kind, fallback, normal=b"", prefix=True, squeeze=False, extra=(), letters="abcdefghinorstwld,.éèü日本"):
    rng = random.Random(3)
    words = ["▁the", "▁of", "he", "th", "er", "in", "an", "▁a", "▁", "on", "ing", "▁in", "the", "ée", "日本", "▁w", "or", "wor", "▁wor", "ld", "▁world", *extra]
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] if fallback else []
    pieces += [(w, -rng.uniform(2, 9) if kind == sp_codec.UNIGRAM else -float(k), 1) for k, w in enumerate(dict.fromkeys([*words, *letters]))]
    body = b"".join(field(1, field(1, t) + field(2, s) + field(3, k)) for t, s, k in pieces)
    body += field(2, field(3, kind) + field(35, fallback) + field(40, 0) + field(41, 1) + field(42, 2))
    return body + field(3, field(1, "own") + (field(2, normal) if normal else b"") + field(3, prefix) + field(4, squeeze) + field(5, True))


def texts():
    rng = random.Random(5)
    some = ["the", "world", "of", "hering", "日本", "ée", "ü", "😀", "ﬁ", "Ａ", "ß", "xyz", "Q", "the  the", "a.b", ",,"]
    return ["".join(rng.choice(some) + rng.choice([" ", "  ", "\n", "", "\t"]) for _ in range(rng.randrange(14))) for _ in range(150)] + ["", " ", "\n", "  the ", "QQ QQ", "the" * 400]


def charsmap():
    """A precompiled normaliser map as sentencepiece ships it."""
    made = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto()
    return dict(sp_codec._fields(dict(sp_codec._fields(made))[3]))[2]


@pytest.mark.parametrize("kind", [sp_codec.UNIGRAM, sp_codec.BPE])
@pytest.mark.parametrize(("fallback", "mapped", "prefix", "squeeze"), [(True, False, True, False), (False, False, True, False), (True, True, True, True), (True, False, False, False)])
def test_ids_are_sentencepieces(tmp_path, kind, fallback, mapped, prefix, squeeze):
    data = model(kind, fallback, charsmap() if mapped else b"", prefix, squeeze)
    (tmp_path / "m.model").write_bytes(data)
    sp = sentencepiece.SentencePieceProcessor(model_proto=data)
    c = sp_codec.Codec(str(tmp_path / "m.model"))
    assert c.cut == (kind == sp_codec.BPE and fallback and not mapped)
    all_texts = texts()
    got = list(c.encode([t.encode() for t in all_texts] + [None]))
    assert [ids.tolist() for ids, _ in got] == [sp.encode(t) for t in all_texts] + [[]]
    assert sum(m > 0 for _, m in got) <= (0 if c.cut else 12)  # ids of the library itself but for a few texts, which are counted
    if not mapped and fallback:
        assert [c.decode(ids.tolist()) for ids, _ in got[:-1]] == [t.encode() for t in all_texts]


def test_unigram_scores_decide(tmp_path):
    """The best sum of scores wins, not the longest piece."""
    data = model(sp_codec.UNIGRAM, True, extra=("zz", "zzz"))
    parsed = sp_codec.parse(data)
    score = {t: s for t, s, _ in parsed["pieces"]}
    ids = sp_codec.build(parsed).encode("theworld", add_special_tokens=False).tokens
    best = {0: (0.0, [])}
    text = "▁theworld"
    for end in range(1, len(text) + 1):
        ways = [(best[a][0] + score[text[a:end]], [*best[a][1], text[a:end]]) for a in best if text[a:end] in score]
        if ways:
            best[end] = max(ways)
    assert ids == best[len(text)][1]


def test_pieces_of_letters_that_are_no_pieces(tmp_path):
    """sentencepiece merges any characters, the tokenizers library only pieces: such cuts are counted and take its ids."""
    data = model(sp_codec.BPE, True, letters="abc日")
    (tmp_path / "m.model").write_bytes(data)
    sp = sentencepiece.SentencePieceProcessor(model_proto=data)
    got = list(sp_codec.Codec(str(tmp_path / "m.model")).encode(["a 日本 b 日本".encode(), b"a b"]))
    assert [(g.tolist(), m) for g, m in got] == [(sp.encode("a 日本 b 日本"), 2), (sp.encode("a b"), 0)]


def test_differing_cuts_take_the_reference_ids(tmp_path, monkeypatch):
    c = sp_codec.Codec(sp_codec.default_path())
    sp = sentencepiece.SentencePieceProcessor(model_file=sp_codec.default_path())
    real = c._both

    def wrong(batch):
        mine, theirs = real(batch)
        return [[7, *m] if "word" in t else m for t, m in zip(batch, mine, strict=True)], theirs

    monkeypatch.setattr(c, "_both", wrong)
    monkeypatch.setattr(c, "line", None)
    for _ in range(2):  # the second time from the cache
        got = list(c.encode([b"a word and a word", b"none"]))
        assert [g.tolist() for g, _ in got] == [sp.encode("a word and a word"), sp.encode("none")] and [m for _, m in got] == [2, 0]


def test_long_text_in_parts(monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choice(["word", "日本 ", "  ", "\n", "é.", " "]) for _ in range(6000))
    monkeypatch.setattr(sp_codec, "LOOKED_UP", 500)
    c = sp_codec.Codec(sp_codec.default_path())
    sp = sentencepiece.SentencePieceProcessor(model_file=sp_codec.default_path())
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # what another operator in the process may have set
    (ids, misses), = c.encode([text.encode()])
    assert ids.tolist() == sp.encode(text) and misses == 0 and c.decode(ids.tolist()) == text.encode() and os.environ["TOKENIZERS_PARALLELISM"] == "true"


def test_literal_markers_beside_spaces(monkeypatch):
    """Cuts alone, without the comparison of whole texts, give sentencepiece's ids on texts that hold the marker itself."""
    c = sp_codec.Codec(sp_codec.default_path())
    sp = sentencepiece.SentencePieceProcessor(model_file=sp_codec.default_path())
    rng = random.Random(8)
    parts = ["▁", "▁▁", " ", "  ", "\t", "\n", "x", "1", "漢", "the", "é", "▁the", "\r", " "]
    some = ["x▁ 1", "▁ 漢", "x▁▁ 1", "\t▁▁ 漢", "▁", " ▁", "▁ ", "a▁b", *("".join(rng.choice(parts) for _ in range(rng.randrange(1, 9))) for _ in range(8000))]
    for most in (-1, 1 << 20):
        monkeypatch.setattr(sp_codec, "WHOLE_BYTES", most)
        for text, (ids, misses) in zip(some, c.encode([t.encode() for t in some]), strict=True):
            assert ids.tolist() == sp.encode(text) and misses == 0, repr(text)


def test_a_wrong_cut_is_seen(monkeypatch):
    c = sp_codec.Codec(sp_codec.default_path())
    monkeypatch.setattr(sp_codec, "_CUT", __import__("re").compile(rb"[^ ]*"))  # loses all spaces
    monkeypatch.setattr(sp_codec, "WHOLE", 1)
    sp = sentencepiece.SentencePieceProcessor(model_file=sp_codec.default_path())
    (ids, misses), = c.encode([b"the world of ours"])
    assert misses == 1 and ids.tolist() == sp.encode("the world of ours")
