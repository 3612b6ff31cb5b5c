"""Where a base operator or query used to do less than the whole job."""

from seamwright.operators import enrich, tokens
from seamwright.plans import registry


def test_tokens_of_whole_texts(spark):
    df = spark.createDataFrame([(1, "word " * 700 + "late"), (2, "word")], "doc_id long, text string")
    tk = tokens.positions(df)
    assert {r["token"]: r["corpus_freq"] for r in tokens.corpus_freq(tk).collect()} == {"word": 701, "late": 1}
    assert tokens.positions(df, limit=500).count() == 501


def test_clusters_of_all_rare_terms(spark, tmp_path):
    names = ["alpha", "bravo", "delta", "gamma"]
    texts = [(i, " ".join(f"{names[i % 4]}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}{chr(97 + k)}" for k in range(26))) for i in range(170)] + [(999, "zebrafish zebrafishes zebrafishs")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = [r.terms for r in registry.QUERIES["term_clusters"](spark, str(tmp_path)).collect()]
    assert ["zebrafish", "zebrafishes", "zebrafishs"] in found  # beyond the thousand first and more than 4,000 terms


def test_inject_phrases(spark):
    docs = spark.createDataFrame([(1, ["a", "new", "york", "city", "new", "york"]), (2, ["york", "new"]), (3, [])], "doc_id long, tokens array<string>")
    lookup = spark.createDataFrame([("new york", "__place__"), ("york city new", "__odd__"), ("york", "__name__")], "term string, injected string")
    got = {r["doc_id"]: r["tokens"] for r in enrich.inject(docs, lookup).collect()}
    assert got[1][6:] == ["__place__", "__name__", "__odd__"] and got[2] == ["york", "new", "__name__"] and got[3] == []
