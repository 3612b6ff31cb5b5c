import re

import pytest

pytest.importorskip("sentencepiece")


def test_every_text_is_compared_as_a_whole(monkeypatch):
    import sentencepiece
    from seamwright.llm import sp_codec

    c = sp_codec.Codec(sp_codec.default_path())
    monkeypatch.setattr(sp_codec, "_CUT", re.compile(rb"[^ ]*"))  # loses all spaces
    sp = sentencepiece.SentencePieceProcessor(model_file=sp_codec.default_path())
    texts = [f"the world of ours {i}" for i in range(40)]
    got = list(c.encode([t.encode() for t in texts]))
    assert all(m == 1 for _, m in got) and [ids.tolist() for ids, _ in got] == [sp.encode(t) for t in texts]


def test_cuts_are_compared_where_a_text_differs(monkeypatch):
    """A text that sentencepiece encodes alike is encoded by it once, as a whole; the others' cuts are compared, and take its ids."""
    from seamwright.llm import sp_codec

    c = sp_codec.Codec(sp_codec.default_path())
    real, asked = c._both, []

    def seen(batch):
        mine, theirs = real(batch)
        return mine, lambda: asked.append(batch) or theirs()

    monkeypatch.setattr(c, "_both", seen)
    sp = sentencepiece_of(sp_codec)
    assert [(i.tolist(), m) for i, m in c.encode([b"the world of ours", b"", None])] == [(sp.encode("the world of ours"), 0), ([], 0), ([], 0)] and not asked
    monkeypatch.setattr(c.cache, "fill", lambda cuts: c._encode([b" off" if x == b" on" else x for x in cuts]))
    (ids, misses), = c.encode([b"go on and on"])
    assert ids.tolist() == sp.encode("go on and on") and misses == 1 and asked


def sentencepiece_of(sp_codec):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=sp_codec.default_path())
