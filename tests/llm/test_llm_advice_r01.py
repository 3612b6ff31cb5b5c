"""Where an operator used to do less than the whole job."""

from collections import Counter

import numpy as np

from seamwright.llm import substring_dedup, token_file


def _frequent(seq, ends, least):
    """Pairs within documents that occur at least ``least`` times without overlap, by brute force."""
    count, begin = Counter(), 0
    for end in ends:
        i = begin
        while i < end - 1:
            pair = (int(seq[i]), int(seq[i + 1]))
            run = i
            while run < end - 1 and (int(seq[run]), int(seq[run + 1])) == pair:
                run += 1
            count[pair] += (run - i + 1) // 2
            i = run
        begin = end
    return {p for p, n in count.items() if n >= least}


def test_repair_whole():
    rng = np.random.default_rng(11)
    passage = rng.integers(3, 30000, 200)
    docs = [np.concatenate([rng.integers(3, 30000, 300), passage, np.full(int(rng.integers(0, 90)), 7), rng.integers(3, 40, 300), [token_file.END]]) for _ in range(60)]
    ids, ends = np.concatenate(docs).astype(np.int32), np.cumsum([len(d) for d in docs])
    image = token_file.pack(list(range(60)), ids, ends, 30000)
    s = token_file.Shard(image)
    assert (s.expand(s.symbols()) == ids).all() and not _frequent(s.symbols(), s.symbol_ends, token_file.LEAST)
    assert s.lengths.max() >= 100  # a shared passage becomes a few long rules
    left, _, per, seq, symbol_ends = token_file.compress(ids, ends, 30000, rules=50)
    assert len(left) == per.sum() == 50 and len(symbol_ends) == 60


def _prose(n, seed):
    r = np.random.default_rng(seed)
    return " ".join("".join(r.choice(list("abcdefghijklmnop"), 5)) for _ in range(n))


def test_substring_inside_sentences(spark):
    run = _prose(60, 1)
    df = spark.createDataFrame([(1, f"{_prose(30, 2)} {run} {_prose(25, 3)}."), (2, f"{_prose(7, 4)} {run.upper()} {_prose(41, 5)}!"), (3, _prose(90, 6)), (4, "la " * 100)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in substring_dedup.removals(df).collect()}
    text = {r["doc_id"]: r["text"] for r in df.collect()}
    assert sorted(got) == [2, 4] and got[2]["keep_id"] == 1 and got[2]["n_words"] >= 60 - 2 * (substring_dedup.WINDOW - 1)
    assert text[2][got[2]["start"] : got[2]["end"]] in run.upper() and text[4][: got[4]["start"]].split().count("la") >= 20


def test_substring_without_spaces(spark):
    r = np.random.default_rng(8)
    han = lambda n: "".join(chr(0x4E00 + int(k)) for k in r.integers(0, 8000, n))
    line, sentence = han(30) + "。", han(25) + "？"
    df = spark.createDataFrame([(1, f"{han(20)}\n{line}\n{han(12)}。{sentence}{han(9)}"), (2, f"{han(14)}\n{line}\n{han(8)}"), (3, f"{han(11)}！{sentence}{han(10)}")], "doc_id long, text string")
    text = {r["doc_id"]: r["text"] for r in df.collect()}
    assert {(r["doc_id"], text[r["doc_id"]][r["start"] : r["end"]], r["keep_id"]) for r in substring_dedup.removals(df).collect()} == {(2, line, 1), (3, sentence, 1)}
