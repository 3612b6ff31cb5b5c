import random

from seamwright.operators import tokens


def same(a, b):
    return next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))


def learned(pairs):
    votes = {}
    for t, m in set(pairs):
        k = same(t, m)
        cut, add = len(t) - k, m[k:]
        if cut <= 8 and k + len(add) >= 2:
            for n in range(max(cut, 1), min(len(t), 8) + 1):
                rule = votes.setdefault(t[-n:], {})
                rule[cut, add] = rule.get((cut, add), 0) + 1
    return {s: min(r, key=lambda x: (-r[x], x)) for s, r in votes.items()}


def applied(word, table, rules):
    if word in table:
        return table[word]
    for n in range(min(len(word), 8), 0, -1):
        if (rule := rules.get(word[-n:])) and len(word) - rule[0] + len(rule[1]) >= 2:
            return word[: len(word) - rule[0]] + rule[1]
    return word


def made():
    stems = ["walk", "play", "box", "cit", "tr", "stop", "mak", "book", "dress", "read", "stud", "wolf", "teach", "learn", "paint", "count", "hik", "bak"]
    ends = [("s", ""), ("ing", ""), ("ed", ""), ("ies", "y"), ("ing", "e"), ("er", ""), ("ers", "er"), ("", ""), ("ness", "")]
    return sorted({(a + x, a + y) for a in stems for x, y in ends if a + y}) + [("went", "go"), ("is", "be"), ("a", "a"), ("mice", "mouse")]


def test_held_out_words_against_a_plain_matcher(spark):
    pairs = made()
    random.Random(2).shuffle(pairs)
    known, held = pairs[:110], pairs[110:]
    table = {}
    for t, m in known:
        table[t] = min(m, table.get(t, m))
    rules = learned(known)
    lemmas = spark.createDataFrame(known, "token string, lemma string")
    got = {r["suffix"]: (r["cut"], r["add"]) for r in tokens.lemma_rules(lemmas).collect()}
    assert got == rules
    words = [t for t, _ in held] + [t for t, _ in known[:20]] + ["x", "s", "unknownings", "", None]
    found = {r["token"]: r["lemma"] for r in tokens.lemma_of(spark.createDataFrame([(w,) for w in words], "token string"), lemmas, tokens.lemma_rules(lemmas)).collect()}
    assert found == {w: applied(w, table, rules) for w in words if w is not None}
    assert found["unknownings"] != "unknownings" and found["x"] == "x"


def test_tokens_keep_their_rows(spark):
    df = spark.createDataFrame([(1, "walks"), (1, "walks"), (2, "talks"), (3, None)], "doc_id long, token string")
    lemmas = spark.createDataFrame([("walks", "walk"), ("books", "book"), (None, "x"), ("empty", None)], "token string, lemma string")
    got = sorted(((r["doc_id"], r["token"]) for r in tokens.lemmatize_all(df, lemmas).collect()), key=str)
    assert got == [(1, "walk"), (1, "walk"), (2, "talk"), (3, None)]
    assert tokens.lemmatize_all(df, lemmas.limit(0)).count() == 4
