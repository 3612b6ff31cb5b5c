"""Token injection and tags, and the lookups they stand on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..durable import durable

#: Prefixes of category names that already say what the category is about.
NAMESPACES = ("sensitive_context", "framing", "subject", "industry", "request", "context")


def plain_term(term: Column) -> Column:
    """Lower case, underscores as spaces, white space collapsed, punctuation off both ends; null gives ''."""
    spaced = F.regexp_replace(F.replace(F.lower(F.trim(F.coalesce(term, F.lit("")))), F.lit("_"), F.lit(" ")), r"\s+", " ")
    return F.btrim(spaced, F.lit(" \t\r\n\"'`.,;:()[]{}"))


def phrase_anchors(taxonomy: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """term, available: terms of two or more words among a taxonomy's examples and counter-examples, and whether the vocabulary has them.

    taxonomy: examples, counter_examples (arrays); vocabulary: term."""
    none = F.array().cast("array<string>")
    terms = taxonomy.select(F.explode(F.concat(F.coalesce("examples", none), F.coalesce("counter_examples", none))).alias("t")).select(plain_term(F.col("t")).alias("term"))
    phrases = terms.filter(F.size(F.split("term", " ")) >= 2).distinct()
    known = vocabulary.select("term").distinct().withColumn("available", F.lit(True))
    return phrases.join(known, "term", "left").withColumn("available", F.coalesce("available", F.lit(False)))


def with_phrases(vocabulary: DataFrame, anchors: DataFrame) -> DataFrame:
    """The vocabulary that terms are classified from: its single words and the phrases that are available anchors."""
    phrase = F.col("term").contains(" ")
    return vocabulary.filter(~phrase).unionByName(vocabulary.filter(phrase).join(anchors.filter("available").select("term"), "term", "left_semi").select(*vocabulary.columns))


def expand_gate(gated: DataFrame) -> DataFrame:
    """term, primary_category, subcategory, source_cluster: one row a term of the clusters that a gate injects or splits.

    gated: cluster, terms, decision, category, subcategory, groups (array of category and terms).  A split gives each part's
    terms its category and no subcategory; any other decision gives nothing."""
    whole = gated.filter("decision = 'inject'").select(F.explode("terms").alias("term"), F.col("category").alias("primary_category"), "subcategory", F.col("cluster").alias("source_cluster"))
    parts = gated.filter("decision = 'split'").select("cluster", F.explode("groups").alias("g"))
    parts = parts.select(F.explode("g.terms").alias("term"), F.col("g.category").alias("primary_category"), F.lit(None).cast("string").alias("subcategory"), F.col("cluster").alias("source_cluster"))
    return whole.unionByName(parts)


def category_token(category: Column) -> Column:
    """``__name__`` for a category with a namespace, ``__framing_name__`` for one without."""
    name = F.trim(category)
    known = F.lit(False)
    for n in NAMESPACES:
        known = known | name.startswith(f"{n}_")
    return F.concat(F.when(known, "__").otherwise("__framing_"), name, F.lit("__"))


def full_lookup(semantic: DataFrame, framing: DataFrame, vocabulary: DataFrame, least: int = 25, ceiling: int = 25_000, exceptions: DataFrame | None = None) -> DataFrame:
    """term, injected: what each term of the vocabulary injects, each token once.

    semantic: term, primary_category, subcategory -> ``__cat_x__`` and, with one, ``__sub_y__``; framing: term, category ->
    ``category_token``.  Terms in fewer than ``least`` documents inject nothing, those in more than ``ceiling`` neither, but
    for the framing category that ``exceptions`` (term, category) names for the term.  vocabulary: term, doc_freq."""
    known = vocabulary.select("term", "doc_freq").filter(F.col("doc_freq") >= least)
    low = semantic.join(known.filter(F.col("doc_freq") <= ceiling), "term")
    sub = F.when(F.col("subcategory").isNotNull() & (F.col("subcategory") != ""), F.concat(F.lit("__sub_"), "subcategory", F.lit("__")))
    first = low.select("term", F.explode(F.array_compact(F.array(F.concat(F.lit("__cat_"), "primary_category", F.lit("__")), sub))).alias("injected"))
    framed = framing.join(known, "term")
    if exceptions is not None:
        framed = framed.join(exceptions.select("term", F.col("category").alias("_kept")), "term", "left")
        framed = framed.filter((F.col("doc_freq") <= ceiling) | F.col("category").eqNullSafe(F.col("_kept")))
    else:
        framed = framed.filter(F.col("doc_freq") <= ceiling)
    return first.unionByName(framed.select("term", category_token(F.col("category")).alias("injected"))).filter("injected IS NOT NULL").distinct()


def injection_lookup(classified: DataFrame, vocabulary: DataFrame, least: int, ceiling: int) -> DataFrame:
    """classified: term, category.  Terms whose document frequency lies in [least, ceiling] and the token they inject."""
    ok = classified.join(vocabulary.select(F.col("token").alias("term"), "doc_freq"), "term").filter(F.col("doc_freq").between(least, ceiling))
    return ok.select("term", F.concat(F.lit("__cat_"), "category", F.lit("__")).alias("injected"))


def inject(docs: DataFrame, lookup: DataFrame, key: str = "doc_id", sizes: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Appends the lookup's tokens (term, injected) of a document's terms, by first place of the term, then token; each once, none it has.

    Terms are tokens and runs of tokens with a space between, of the numbers in ``sizes``.  The lookup is indexed by the first
    token of its terms: each place of a document comes once, with the tokens behind it, meets the terms that begin with its
    token and leaves only if the rest follows.  The lookup is written first, so the planner knows its size: up to
    ``spark.sql.autoBroadcastJoinThreshold`` it goes by broadcast and no token moves, a larger one meets the tokens by shuffle."""
    most = max(sizes)
    parts = F.split("term", " ")
    terms = lookup.filter(F.size(parts).isin(*sizes)).select("injected", *[F.get(parts, F.lit(k)).alias(f"t{k}") for k in range(most)])
    terms = durable(terms.filter("injected IS NOT NULL").distinct(), "lookup")
    place = F.transform("tokens", lambda x, i: F.struct(i.alias("pos"), x.alias("w0"), *[F.get("tokens", i + k).alias(f"w{k}") for k in range(1, most)]))
    places = docs.select(key, F.explode(place).alias("p")).select(key, "p.*")
    follows = [F.col(f"t{k}").isNull() | (F.col(f"t{k}") == F.col(f"w{k}")) for k in range(1, most)]
    hits = places.join(terms, reduce(Column.__and__, follows, F.col("w0") == F.col("t0"))).select(key, "pos", "injected")
    new = hits.groupBy(key, "injected").agg(F.min("pos").alias("pos")).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "injected"))).alias("n"))
    joined = docs.join(new, key, "left")
    added = F.array_except(F.coalesce(F.transform("n", lambda x: x["injected"]), F.array().cast("array<string>")), F.col("tokens"))
    return joined.withColumn("tokens", F.concat("tokens", added)).drop("n")


def tag_columns(docs: DataFrame, names: list[str]) -> DataFrame:
    """One boolean column per injected token, in one projection."""
    return docs.select("*", *[F.array_contains("tokens", n).alias("tag_" + n.strip("_")) for n in names])


def strip_injected(tokens: Column) -> Column:
    """Tokens without injected ones, once waterfalls have used them."""
    return F.filter(tokens, lambda t: ~t.startswith("__"))


def coverage(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    inj = docs.select(key, F.explode(F.array_distinct(F.filter("tokens", lambda t: t.rlike("^__.*__$")))).alias("injected"))
    return inj.groupBy("injected").agg(F.count("*").alias("n_docs"))


def target_share(text: Column) -> Column:
    """The number that ``2-4%`` or ``3%`` stands for; null for anything else."""
    parts = F.split(F.replace(F.trim(text), F.lit("%"), F.lit("")), "-", 2)
    low, high = (F.trim(F.get(parts, F.lit(k))).try_cast("double") for k in (0, 1))
    return F.when(F.size(parts) == 1, low).otherwise((low + high) / 2)


def coverage_deviation(classified: DataFrame, taxonomy: DataFrame, beyond: float) -> DataFrame:
    """category, actual_pct, target_pct of the categories whose share of classified terms is more than ``beyond`` points off.

    classified: category (null counts nowhere); taxonomy: category, target_coverage_pct."""
    n = classified.filter("category IS NOT NULL").groupBy("category").agg(F.count("*").alias("n"))
    share = n.select("category", (100.0 * F.col("n") / n.agg(F.sum("n")).scalar()).alias("actual_pct"))
    want = taxonomy.select("category", target_share(F.col("target_coverage_pct")).alias("target_pct")).filter("target_pct IS NOT NULL")
    both = want.join(share, "category", "left").withColumn("actual_pct", F.coalesce("actual_pct", F.lit(0.0)))
    return both.filter(F.abs(F.col("actual_pct") - F.col("target_pct")) > beyond).select("category", "actual_pct", "target_pct")


def short_name(token: Column) -> Column:
    return F.regexp_replace(token, "^__|__$", "")
