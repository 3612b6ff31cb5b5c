"""Tokenising, vocabulary counts and vocabulary rules."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..durable import durable
from ..session import ship
from .quantiles import quantile_columns

#: Stopwords of the queries; a caller brings a list or a table of its own.
STOPWORDS = ("the", "and", "for", "are", "was", "with", "that", "this", "from", "not")
#: Fixed value: the ends of words that a stemmer is likely to have cut off (in words of at most eight letters).
TRUNCATED = "(at|iv|iz|az|ig|if|ic|olog)$"
#: Bits of the filter that tells n-grams whose shorter ones are rare (32 MB, whatever the vocabulary), and bytes of a part of it.
FILTER_BITS, FILTER_PART = 1 << 28, 1 << 15
#: Each byte as tokens have it: a letter in lower case or a space.
_LOWER = np.array([c | 32 if 65 <= c | 32 <= 122 and chr(c).isalpha() and c < 128 else 32 for c in range(256)], np.uint8)
#: Fixed value: the words that the term vectoriser sees, on lower-cased text; injected tokens (``__x__``) are none of them.
VECTOR_TERM = r"(?U)\b[a-z][a-z_\-]*\b"


def letter_tokens(text: Column, limit: int | None = None) -> Column:
    """Lower-case runs of ASCII letters: all, or the first ``limit`` positions (an empty one in front counts)."""
    runs = F.split(F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), "[^a-zA-Z]+", " ")), " ", -1)
    return runs if limit is None else F.slice(runs, 1, limit)


def positions(docs: DataFrame, keys=("doc_id",), text: str = "text", limit: int | None = None) -> DataFrame:
    """One row per kept token: keys, pos (from 1), token.  Kept: three letters or more, or ``ai``."""
    rows = docs.select(*keys, F.posexplode(letter_tokens(F.col(text), limit)).alias("pos", "token")).withColumn("pos", F.col("pos") + 1)
    return rows.filter((F.length("token") >= 3) | (F.col("token") == "ai"))


def corpus_freq(tokens: DataFrame) -> DataFrame:
    return tokens.groupBy("token").agg(F.count("*").alias("corpus_freq"))


def doc_freq(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    return tokens.select(key, "token").distinct().groupBy("token").agg(F.count("*").alias("doc_freq"))


def vocabulary(tokens: DataFrame, n_docs: int | Column, key: str = "doc_id") -> DataFrame:
    """token, corpus_freq, doc_freq, docs_pct.  A token's occurrences are counted per document once, for both numbers."""
    per = tokens.groupBy(key, "token").agg(F.count("*").alias("c"))
    return per.groupBy("token").agg(F.sum("c").alias("corpus_freq"), F.count("*").alias("doc_freq")).withColumn("docs_pct", F.round(F.col("doc_freq") / n_docs, 6))


def doc_freq_summary(frequencies: DataFrame) -> DataFrame:
    """One row: retained terms, least, greatest and median document frequency.  frequencies: doc_freq."""
    median = quantile_columns(frequencies, "doc_freq", {"median": 0.5})
    return frequencies.agg(F.count("*").alias("retained"), F.min("doc_freq").alias("least"), F.max("doc_freq").alias("most")).withColumns(median)


def without(tokens: DataFrame, stopwords) -> DataFrame:
    """stopwords: words, or a table with a column ``token`` of any length."""
    if isinstance(stopwords, DataFrame):
        return tokens.join(stopwords.select("token").distinct(), "token", "left_anti")
    return tokens.filter(~F.col("token").isin(*stopwords)) if stopwords else tokens


def extract(tokens: DataFrame, min_docs: int, stopwords=STOPWORDS, key: str = "doc_id") -> DataFrame:
    """One row per document: its frequent tokens in order, comma-joined."""
    keep = without(doc_freq(tokens, key).filter(F.col("doc_freq") >= min_docs), stopwords)
    kept = tokens.join(keep.select("token"), "token", "left_semi")
    ordered = F.array_sort(F.collect_list(F.struct("pos", "token")))
    return kept.groupBy(key).agg(ordered.alias("t")).select(key, F.array_join(F.transform("t", lambda x: x["token"]), ",").alias("tokens"))


def token_lists(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """doc and its tokens as an ordered array."""
    return tokens.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("t")).select(key, F.transform("t", lambda x: x["token"]).alias("tokens"))


def token_arrays(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, tokens: the kept tokens of each row's text in order, without a shuffle; rows without any are left out."""
    kept = F.filter(letter_tokens(F.col(text)), lambda x: (F.length(x) >= 3) | (x == "ai"))
    return docs.select(key, kept.alias("tokens")).filter(F.size("tokens") > 0)


def token_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, text of the rows that have a kept token, for counts that cut texts in their own tasks."""
    return docs.select(key, F.col(text).alias("text")).filter(F.col("text").rlike("(?i)[a-z]{3}|(?<![a-z])ai(?![a-z])"))


def _cut(texts: pa.Array) -> pa.Array:
    """The kept tokens of texts, as ``token_arrays`` has them."""
    return kept_words(texts)[0]


def _letters(texts: pa.Array) -> pa.Array:
    """Texts in lower case with one space for each run of bytes that are no ASCII letters."""
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = _LOWER[np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]]
    keep = raw != 32
    keep[1:] |= keep[:-1]  # of a run of spaces the first stays
    starts = ends[:-1][ends[:-1] < ends[1:]] - ends[0]
    keep[starts] = True
    ends = np.concatenate(([0], np.cumsum(keep)))[ends - ends[0]]
    return pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(ends), pa.py_buffer(raw[keep])])


def kept_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The kept tokens of texts, as ``token_arrays`` has them, and the position of each among its text's runs."""
    lists = pc.split_pattern(_letters(pc.fill_null(texts.cast(pa.large_string()), "")), " ")
    words = lists.flatten()
    kept = pc.or_(pc.greater_equal(pc.binary_length(words), 3), pc.equal(words, "ai"))
    sizes, flags = pc.list_value_length(lists).to_numpy(), kept.to_numpy(zero_copy_only=False)
    start = np.concatenate(([0], np.cumsum(sizes)))
    ends = np.concatenate(([0], np.cumsum(flags)))[start]
    at = np.flatnonzero(flags) - np.repeat(start[:-1], np.diff(ends))
    return pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), words.filter(kept)), at


def counted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, token, tf of the kept tokens.  Rows of a key are brought together as texts, so its tokens need no shuffle."""
    ship(docs.sparkSession)
    whole = docs.groupBy(key).agg(F.array_join(F.collect_list(F.coalesce(text, F.lit(""))), " ").alias("text"))

    def run(batches):
        for batch in batches:
            lists = _cut(batch.column(1))
            sizes, words = pc.list_value_length(lists).to_numpy(), lists.flatten().dictionary_encode()
            pairs = np.repeat(np.arange(len(sizes)), sizes) * len(words.dictionary) + words.indices.to_numpy()
            pairs, tf = np.unique(pairs, return_counts=True)
            doc, code = np.divmod(pairs, max(len(words.dictionary), 1))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc)), words.dictionary.cast(pa.string()).take(pa.array(code)), pa.array(tf)], [key, "token", "tf"])

    return whole.mapInArrow(run, f"{key} {docs.schema[key].dataType.simpleString()}, token string, tf long")


def first_occurrences(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """Ranks a token's occurrences in a document (row_number) and keeps the distinct-document count by conditional sum."""
    ranked = tokens.withColumn("rn", F.row_number().over(Window.partitionBy(key, "token").orderBy("pos")))
    return ranked.groupBy("token").agg(F.sum(F.when(F.col("rn") == 1, 1).otherwise(0)).alias("doc_count"), F.count("*").alias("n"))


def apply_map(tokens: Column, mapping: Column) -> Column:
    """One pass, not transitive."""
    return F.transform(tokens, lambda t: F.coalesce(F.try_element_at(mapping, t), t))


def consolidation_candidates(freq: DataFrame, window: int = 1000, known: dict[str, str] | None = None) -> DataFrame:
    """The ``window`` most frequent tokens (ties by token): flag_type ``truncation`` or '', and a replacement or ''.

    A replacement is the known fix, else the token without ``s``, else without ``es`` where the window has that word.  The
    window is a list to be read by people; its size is a parameter."""
    top = freq.orderBy(F.desc("corpus_freq"), "token").limit(window)
    cut = (F.length("token") <= 8) & F.col("token").rlike(TRUNCATED)
    plural = F.col("token").endswith("s") & ~F.col("token").endswith("ss") & (F.length("token") > 3)
    less_s, less_es = F.expr("substring(token, 1, length(token) - 1)"), F.expr("substring(token, 1, length(token) - 2)")
    rows = top.withColumn("s", F.when(plural, less_s)).withColumn("es", F.when(F.col("token").endswith("es") & (F.length("token") > 4), less_es))
    for c in ("s", "es"):
        rows = rows.join(top.select(F.col("token").alias(f"has_{c}")), F.col(c) == F.col(f"has_{c}"), "left")
    fix = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])[F.col("token")] if known else F.lit(None).cast("string")
    return rows.select("token", "corpus_freq", F.when(cut, "truncation").otherwise("").alias("flag_type"), F.coalesce(fix, "has_s", "has_es", F.lit("")).alias("replacement"))


def sparsity_filter(tokens: DataFrame, n_docs: int | Column, min_df: int, max_share: float, cap: int = 80, least: int = 5, key: str = "doc_id") -> DataFrame:
    """doc, kept tokens (half-open document-frequency bounds, first occurrences, at most cap), whether retained.

    One aggregate finds first occurrences; frequencies and lists come of it, so texts are split once."""
    first = tokens.groupBy(key, "token").agg(F.min("pos").alias("pos"))
    keep = first.groupBy("token").agg(F.count("*").alias("df")).filter((F.col("df") >= min_df) & (F.col("df") < n_docs * F.lit(max_share))).select("token", F.lit(True).alias("keep"))
    lists = first.join(keep, "token", "left").groupBy(key).agg(F.array_sort(F.collect_list(F.when(F.col("keep"), F.struct("pos", "token")))).alias("t"))
    return lists.select(key, F.slice(F.transform("t", lambda x: x["token"]), 1, cap).alias("tokens")).withColumn("retained", F.size("tokens") >= least)


def ngrams(tokens: Column, n: int) -> Column:
    """Space-joined n-grams in order."""
    last = F.size(tokens) - n + 1
    grams = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.array_join(F.slice(tokens, i, F.lit(n)), " "))
    return F.when(last >= 1, grams).otherwise(F.array().cast("array<string>"))


def ngram_terms(lists: DataFrame, sizes=(1, 2, 3), key: str = "doc_id") -> DataFrame:
    """key, n, term: the n-grams of all sizes in one pass over the token lists."""

    def sized(n):
        return F.transform(F.col("tokens") if n == 1 else ngrams(F.col("tokens"), n), lambda x: F.struct(F.lit(n).alias("n"), x.alias("term")))

    every = F.concat(*[sized(n) for n in sizes])
    return lists.select(key, F.explode(every).alias("t")).select(key, "t.n", "t.term")


def _hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter((zlib.crc32(w.as_buffer() if w.is_valid else b"") for w in words.cast(pa.large_binary())), np.uint64, len(words))


def _joined(hashes: list[np.ndarray], bits: int) -> np.ndarray:
    """The place in the filter of n-grams, from the hashes of their words."""
    total = np.zeros(len(hashes[0]), np.uint64)
    for h in hashes:
        total = (total + h + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return (total % np.uint64(bits)).astype(np.int64)


def _filter(terms: DataFrame, n: int) -> np.ndarray:
    """A Bloom filter of one hash of n-grams, as bytes: made in parts by tasks, of a fixed size whatever their number."""
    n_bits = FILTER_BITS

    def places(batches):
        for batch in batches:
            words = pc.split_pattern(batch.column(0), " ").flatten().dictionary_encode()
            of = _hashes(words.dictionary)[words.indices.to_numpy()].reshape(-1, n)
            at = np.unique(_joined([of[:, k] for k in range(n)], n_bits))
            yield pa.RecordBatch.from_arrays([pa.array((at // (8 * FILTER_PART)).astype(np.int32)), pa.array(at)], ["part", "at"])

    def packed(table: pa.Table) -> pa.Table:
        part, held = table.column("part")[0].as_py(), np.zeros(8 * FILTER_PART, np.uint8)
        held[table.column("at").to_numpy() - part * 8 * FILTER_PART] = 1
        return pa.table({"part": pa.array([part], pa.int32()), "bits": pa.array([np.packbits(held, bitorder="little").tobytes()], pa.binary())})

    found, bits = terms.select("term").mapInArrow(places, "part int, at long"), np.zeros(n_bits // 8 + FILTER_PART, np.uint8)
    for r in found.distinct().groupBy("part").applyInArrow(packed, "part int, bits binary").collect():
        bits[r["part"] * FILTER_PART : (r["part"] + 1) * FILTER_PART] = np.frombuffer(r["bits"], np.uint8)
    return bits


def ngram_counts(lists: DataFrame, n: int, shorter: DataFrame | None = None) -> DataFrame:
    """term, doc_freq, corpus_freq of the n-grams of token lists, one list a document, or of the tokens of ``token_texts``.

    With ``shorter``, a table of (n-1)-grams, an n-gram is counted only if that holds both of its own: tested by the numbers
    of its words in a filter that lets some others pass, before any text of it is made.  A task counts each batch of
    documents by sorting, so one shuffle moves a row a term and task."""
    spark, n_bits = ship(lists.sparkSession), FILTER_BITS
    shared = spark.sparkContext.broadcast(_filter(shorter, n - 1)) if shorter is not None and n > 1 else None

    def run(batches):
        for batch in batches:
            column = batch.column(0) if listed else _cut(batch.column(0))
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
            words = column.flatten().dictionary_encode()
            code, doc = words.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(sizes)), sizes)
            at = np.flatnonzero(doc[: len(doc) - n + 1] == doc[n - 1 :]) if len(doc) >= n else np.zeros(0, np.int64)
            if shared and len(at):
                bits, of = shared.value, _hashes(words.dictionary)
                for first in (0, 1):
                    place = _joined([of[code[at + first + k]] for k in range(n - 1)], n_bits)
                    at = at[(bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1]
            if not len(at):
                continue
            key = code[at]
            for k in range(1, n):
                key = np.unique(key * len(words.dictionary) + code[at + k], return_inverse=True)[1] if k + 1 < n else key * len(words.dictionary) + code[at + k]
            order = np.argsort(key, kind="stable")  # the documents of a term stay in order
            key, docs = key[order], doc[at[order]]
            new = np.diff(key, prepend=-1) != 0
            first = np.flatnonzero(new)
            d = np.add.reduceat((new | (np.diff(docs, prepend=-1) != 0)).astype(np.int64), first)
            names = words.dictionary.cast(pa.string())
            one = [names.take(pa.array(code[at[order[first]] + k])) for k in range(n)]
            term = one[0] if n == 1 else pc.binary_join_element_wise(*one, " ")
            yield pa.RecordBatch.from_arrays([term, pa.array(d), pa.array(np.diff(first, append=len(key)))], ["term", "d", "c"])

    listed = "tokens" in lists.columns
    rows = lists.select("tokens" if listed else "text").mapInArrow(run, "term string, d long, c long")
    return rows.groupBy("term").agg(F.sum("d").alias("doc_freq"), F.sum("c").alias("corpus_freq"))


def ngram_vocabulary(lists: DataFrame, sizes=(1, 2, 3), min_df: int = 8, max_share: float = 0.4, key: str = "doc_id") -> DataFrame:
    """term, n, doc_freq, corpus_freq with closed bounds, level by level: an n-gram in ``min_df`` documents has (n-1)-grams in as many.

    lists: key, tokens, or ``token_texts``; one row a document."""
    most, out, shorter = F.lit(max_share) * lists.agg(F.count("*")).scalar(), None, None
    for n in range(1, max(sizes) + 1):
        found = durable(ngram_counts(lists, n, shorter).filter(F.col("doc_freq") >= min_df), "ngrams")  # read by the next level and the result
        shorter = found.select("term")
        if n in sizes:
            level = found.filter(F.col("doc_freq") <= most).select(F.lit(n).alias("n"), "term", "doc_freq", "corpus_freq")
            out = level if out is None else out.unionByName(level)
    return out


def taxonomy_vocabulary(unigrams: DataFrame, grams: DataFrame) -> DataFrame:
    """Both vocabularies as one, each term once; ``unigrams`` wins.  Both: term, doc_freq, corpus_freq; the result has term_type and source too."""
    both = unigrams.select("term", "doc_freq", "corpus_freq", F.lit("unigram").alias("source")).unionByName(grams.select("term", "doc_freq", "corpus_freq", F.lit("ngram").alias("source")))
    first = F.min_by(F.struct("doc_freq", "corpus_freq", "source"), F.struct((F.col("source") != "unigram").alias("late"), (-F.col("doc_freq")).alias("d"), "corpus_freq")).alias("x")
    n = F.size(F.split("term", " "))
    return both.groupBy("term").agg(first).select("term", "x.*", F.when(n == 1, "unigram").when(n == 2, "bigram").otherwise("ngram").alias("term_type"))


def vector_terms(docs: DataFrame, sizes=(1, 1), mode: str = "words", key: str = "doc_id") -> DataFrame:
    """key, token: one row an occurrence of a term of the vectoriser, n-grams of ``sizes`` (least, most).

    mode ``words``: the words VECTOR_TERM finds in the joined tokens, in lower case - hyphens and underscores inside words
    stay, injected tokens don't count; ``array``: the token array as it is.  docs: key, tokens."""
    words = F.regexp_extract_all(F.lower(F.array_join("tokens", " ")), F.lit(VECTOR_TERM), F.lit(0)) if mode == "words" else F.col("tokens")
    return ngram_terms(docs.select(key, words.alias("tokens")), range(sizes[0], sizes[1] + 1), key).select(key, F.col("term").alias("token"))


def lemmatize(tokens: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Table-backed lemmas: (token, lemma); tokens without one stay."""
    return tokens.join(lemmas, "token", "left").withColumn("token", F.coalesce("lemma", "token")).drop("lemma")


#: Longest suffix a lemma rule looks at, and the letters that a lemma keeps of its word at least.
SUFFIX, STEM = 8, 2


def lemma_rules(lemmas: DataFrame) -> DataFrame:
    """suffix, cut, add: what words that end so lose and get, learned from (token, lemma).

    A word and its lemma share their beginning; what is left of either makes the word's rule, which counts for each of its
    suffixes that the rule's own cut lies in.  A suffix keeps its most frequent rule (ties: the smaller cut, then ``add``)."""
    pairs = lemmas.select("token", "lemma").filter("token <> '' AND lemma <> ''").distinct()
    most = F.least(F.length("token"), F.length("lemma"))
    same = F.size(F.filter(F.sequence(F.lit(1), most), lambda i: F.substr("token", F.lit(1), i) == F.substr("lemma", F.lit(1), i)))
    rules = pairs.withColumn("same", same).select("token", (F.length("token") - F.col("same")).alias("cut"), F.substr("lemma", F.col("same") + 1).alias("add"))
    rules = rules.filter((F.col("cut") <= SUFFIX) & (F.length("token") - F.col("cut") + F.length("add") >= STEM))
    sizes = F.sequence(F.greatest(F.col("cut"), F.lit(1)), F.least(F.length("token"), F.lit(SUFFIX)))
    votes = rules.select(F.explode(sizes).alias("size"), "token", "cut", "add").select(F.right("token", F.col("size")).alias("suffix"), "cut", "add").groupBy("suffix", "cut", "add").agg(F.count("*").alias("n"))
    return votes.groupBy("suffix").agg(F.min_by(F.struct("cut", "add"), F.struct((-F.col("n")).alias("n"), "cut", "add")).alias("r")).select("suffix", "r.cut", "r.add")


def lemma_of(words: DataFrame, lemmas: DataFrame, rules: DataFrame) -> DataFrame:
    """token, lemma of distinct words: an entry of the table (the first in order of several), else the rule of the longest suffix that leaves ``STEM`` letters, else the word itself."""
    exact = lemmas.filter("lemma <> ''").groupBy("token").agg(F.min("lemma").alias("exact"))
    words = words.select("token").filter("token IS NOT NULL").distinct().join(exact, "token", "left")
    sizes = F.sequence(F.lit(1), F.least(F.length("token"), F.lit(SUFFIX)))
    open_ = words.filter("exact IS NULL AND token <> ''").select("token", F.explode(sizes).alias("size")).withColumn("suffix", F.right("token", F.col("size")))
    fits = open_.join(rules, "suffix").filter(F.length("token") - F.col("cut") + F.length("add") >= STEM)
    best = fits.groupBy("token").agg(F.max_by(F.struct("cut", "add"), "size").alias("r"))
    ruled = best.select("token", F.concat(F.expr("left(token, length(token) - r.cut)"), F.col("r.add")).alias("ruled"))
    return words.join(ruled, "token", "left").select("token", F.coalesce("exact", "ruled", "token").alias("lemma"))


def lemmatize_all(tokens: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Tokens by their lemma, words outside the table by the rules it teaches.  Each distinct word is looked up once."""
    return lemmatize(tokens, lemma_of(tokens, lemmas, lemma_rules(lemmas)))
