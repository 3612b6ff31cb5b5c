"""Words, grammar, bit packing and the way from a doc_id to its shard."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seamwright.llm import token_file


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(token_file.default_path())


def odd_texts():
    rng = random.Random(6)
    pieces = ["word", "Word", "über", "Ça", "é", "İx", "ΣΑΣ", "ß", "it's", "I'LL", "a.b", "<|endoftext|>", "<|ENDOFTEXT|>", "abc<|endoftext|>.", "***", "!?", "3d", "¼", "日本", "😀", "ﬁ", "\x1c", "\x85", "á", "", "`~{|}", "x<y"]
    gaps = [" ", "\n", "\t", "  ", "", "\x0b", "\x0c\r"]
    return ["".join(rng.choice(pieces) + rng.choice([*gaps, ".", ",", "..."]) for _ in range(rng.randrange(30))) for _ in range(300)] + ["", " ", None]


@pytest.mark.parametrize("group", [token_file.GROUP, 40])
def test_words_encode_as_texts(tok, group, monkeypatch):
    monkeypatch.setattr(token_file, "GROUP", group)
    texts, got = odd_texts(), []
    for ids, ends in token_file.WordEncoder(token_file.default_path()).encode(pa.array([None if t is None else t.encode() for t in texts], pa.binary())):
        got += [ids[a:b].tolist() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
    assert got == [[*tok.encode(t or "", add_special_tokens=False).ids, token_file.END] for t in texts]


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 17, 20, 31])
def test_packed(bits):
    x = np.random.default_rng(bits).integers(0, 1 << bits, 101)
    image = np.frombuffer(token_file.packed(x, bits), np.uint8)
    assert len(image) == 13 * bits and all((token_file.unpacked(image, a, b, bits) == x[a:b]).all() for a, b in ((0, 101), (0, 0), (7, 9), (100, 101), (16, 50)))


def test_no_pair_twice():
    rng = np.random.default_rng(3)
    ids = np.concatenate([rng.integers(0, 6, 3000), np.full(500, 4), np.tile(rng.integers(0, 50, 40), 30)]).astype(np.int32)
    ends = np.sort(np.append(rng.choice(np.arange(1, len(ids)), 20, replace=False), len(ids)))
    s = token_file.Shard(token_file.pack(list(range(21)), ids, ends, 50))
    assert (s.expand(s.symbols()) == ids).all() and (s.everything() == ids).all()
    count = {}
    for a, b in zip([0, *s.symbol_ends[:-1].tolist()], s.symbol_ends.tolist(), strict=True):
        at, symbols = a, s.symbols(a, b).tolist()
        while at < b - 1:
            pair = (symbols[at - a], symbols[at - a + 1])
            count[pair] = count.get(pair, 0) + 1
            at += 2 if at + 2 < b and symbols[at - a + 2] == pair[0] == pair[1] else 1
    assert max(count.values()) == 1
    long = np.concatenate([np.full(5000, 3), *(np.arange(k) for k in range(60))]).astype(np.int32)  # rules within rules
    t = token_file.Shard(token_file.pack([0], long, np.array([len(long)]), 70))
    assert (t.everything() == long).all() and (t.expand(t.symbols()) == long).all()
    plain = token_file.pack([0], np.arange(9, dtype=np.int32), np.array([9]), 10)  # nothing to replace
    assert (token_file.Shard(plain).document(0) == np.arange(9)).all()


def test_document_opens_one_shard(spark, tok):
    rng = random.Random(2)
    rows = [(3 * k, " ".join(f"w{rng.randrange(80)}" for _ in range(60)), "x") for k in range(200)] + [(None, "no id", "y"), (60, "again", "z")]
    shards = token_file.write(spark.createDataFrame(rows, "doc_id long, text string, image string"), token_file.default_path(), shard=1000)
    listed = sorted((r["start"], r["n_docs"], r["n_ids"], r["first_id"], r["last_id"]) for r in token_file.directory(shards).collect())
    assert len(listed) > 10 and listed[0][3] is None and sum(r[1] for r in listed) == len(rows)
    assert [r[0] for r in listed] == [sum(r[2] for r in listed[:k]) for k in range(len(listed))]
    want = {d: [*tok.encode(t, add_special_tokens=False).ids, 2] for d, t, _ in rows}
    for d in (0, 300, 597):
        assert [r["ids"] for r in token_file.document(shards, d).collect()] == [want[d]]
        assert shards.filter((F.col("first_id") <= d) & (F.col("last_id") >= d)).count() == 1
    assert [r["ids"] for r in token_file.document(shards, 300, 2, 7).collect()] == [want[300][2:7]]
    assert len(token_file.document(shards, 60).collect()) == 2 and token_file.document(shards, 1).collect() == []
    path = shards.inputFiles()[0].removeprefix("file://").removeprefix("file:")
    import pyarrow.parquet as pq

    meta = pq.ParquetFile(path).metadata
    assert all(meta.row_group(k).num_rows == 1 for k in range(meta.num_row_groups))
