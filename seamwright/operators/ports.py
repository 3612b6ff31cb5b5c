"""Stages that ask a language model, behind a callable ``prompt -> reply``; the caller brings the model."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .replies import Replies

#: Reply schema of the coherence gate.
GATE = "decision string, injected string, groups array<struct<injected: string, terms: array<string>>>"


def ask(rows: DataFrame, prompt: str, model: Callable[[str], str], tries: int = 3, wait: float = 1.0, replies: Replies | None = None) -> DataFrame:
    """Adds ``reply`` and ``error``; a call that fails ``tries`` times (pauses doubling) leaves a null reply and its error.

    With ``replies`` equal prompts are asked once, now and in later runs (this asks at once); without, each row asks when it
    is computed, and again whenever it is."""
    ship(rows.sparkSession)

    def one(text: str) -> tuple[str | None, str | None]:
        for k in range(tries):
            try:
                return model(text), None
            except Exception as e:  # noqa: BLE001 - whatever a model's client raises becomes a row's error
                error = f"{type(e).__name__}: {e}"
                if k + 1 < tries:
                    time.sleep(wait * 2**k)
        return None, error

    @F.pandas_udf("reply string, error string")
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(x) if x is not None else (None, "no prompt") for x in s], columns=["reply", "error"])

    def asked(df: DataFrame, column: str) -> DataFrame:
        return df.withColumn("_r", run(column)).select("*", "_r.reply", "_r.error").drop("_r")

    if replies is None:
        return asked(rows, prompt)
    keyed = rows.withColumn("_key", replies.key(F.col(prompt)))
    found = replies.fill(keyed.select(F.col("_key").alias("key"), F.col(prompt).alias("prompt")), lambda df: asked(df, "prompt"))
    out = keyed.join(found.withColumnRenamed("key", "_key"), "_key", "left")
    return out.withColumn("error", F.when(F.col("_key").isNull(), F.lit("no prompt")).otherwise(F.col("error"))).drop("_key")


def json_reply(schema: str):
    """A reply parsed after Markdown fences are taken off; null when it isn't such JSON."""
    return F.from_json(F.regexp_replace(F.trim("reply"), r"^```(?:json)?\s*|\s*```$", ""), schema)


def gate_clusters(clusters: DataFrame, model: Callable[[str], str], most: int = 20, **how) -> DataFrame:
    """Rows (term, injected) of clusters that the model injects whole or splits; other or failed replies discard a cluster.

    The prompt shows the first ``most`` terms; an injected cluster gives all of its terms."""
    prompt = F.concat(F.lit("Do these terms share one theme? Answer JSON {decision: inject|split|discard, injected, groups}: "), F.array_join(F.slice("terms", 1, most), ", "))
    told = ask(clusters.withColumn("prompt", prompt), "prompt", model, **how).withColumn("g", json_reply(GATE))
    whole = told.filter("g.decision = 'inject' AND g.injected IS NOT NULL").select(F.explode("terms").alias("term"), F.col("g.injected").alias("injected"))
    parts = told.filter("g.decision = 'split'").select("terms", F.explode("g.groups").alias("p"))
    parts = parts.select(F.explode(F.array_intersect("terms", "p.terms")).alias("term"), F.col("p.injected").alias("injected")).filter("injected IS NOT NULL")
    return whole.unionByName(parts)


def classify_terms(terms: DataFrame, categories: Sequence[str], model: Callable[[str], str], batch: int = 150, buckets: int | None = None, **how) -> DataFrame:
    """term, category (null: none of ``categories``, or the batch failed).  Batches of up to ``batch`` terms; a reply maps terms to categories.

    Terms are dealt out of ``buckets``, by default one for a hundred batches.  Kept replies (``replies``) hold for the same
    categories and batch size, and a batch for the same terms."""
    from pyspark.sql.window import Window

    if how.get("replies"):
        how["replies"] = how["replies"].scoped(categories=sorted(categories), batch=batch)
    known = terms.select("term").filter("term IS NOT NULL").distinct()
    buckets = buckets or -(-known.count() // (100 * batch)) or 1
    dealt = known.withColumn("b", F.pmod(F.xxhash64("term"), F.lit(buckets)))
    dealt = dealt.withColumn("k", F.floor((F.row_number().over(Window.partitionBy("b").orderBy("term")) - 1) / batch))
    sets = dealt.groupBy("b", "k").agg(F.sort_array(F.collect_list("term")).alias("terms"))
    prompt = F.concat(F.lit(f"Map each term to one of {', '.join(categories)} or null, as a JSON object: "), F.to_json("terms"))
    told = ask(sets.withColumn("prompt", prompt), "prompt", model, **how).withColumn("m", json_reply("map<string,string>"))
    rows = told.select("m", F.explode("terms").alias("term")).withColumn("c", F.try_element_at("m", F.col("term")))
    return rows.select("term", F.when(F.col("c").isin(*categories), F.col("c")).alias("category"))


def verify_topics(claims: DataFrame, prompt: str, model: Callable[[str], str], **how) -> DataFrame:
    """claims: insight_id, topic_keys.  Adds ``verified``: the claimed topics that the model's JSON list keeps, none when it fails."""
    told = ask(claims, prompt, model, **how)
    kept = F.array_intersect(F.array_distinct("topic_keys"), F.coalesce(json_reply("array<string>"), F.array().cast("array<string>")))
    return told.withColumn("verified", kept).withColumn("ratio", F.when(F.size("topic_keys") > 0, F.size("verified") / F.size(F.array_distinct("topic_keys"))))


CLAIM = "struct<group: string, topic_id: int>"


def _claims() -> Column:
    return F.coalesce(F.col("source_topics").cast(f"array<{CLAIM}>"), F.array().cast(f"array<{CLAIM}>"))


def verify_claims(insights: DataFrame, labels: DataFrame, model: Callable[[str], str], groups: Sequence[str], least: dict[str, int] | None = None, **how) -> DataFrame:
    """Adds ``verified`` (topics that the model lets stand) and ``problem``.

    insights: insight_id, section, title, finding, evidence_basis, source_topics (array of group and topic_id); labels: group,
    topic_id, label, description.  Sections have a least number of claimed topics in ``least`` (1 otherwise) under which an
    insight isn't sent; one none of whose topics has a label isn't either.  The reply is JSON {verified_topics: [{group,
    topic_id}]}; its topics of known ``groups`` stay, each once.  What isn't sent, fails or answers otherwise keeps its claims."""
    floor = F.coalesce(F.create_map(*[F.lit(x) for kv in least.items() for x in kv])[F.col("section")], F.lit(1)) if least else F.lit(1)
    rows = insights.withColumn("_claims", _claims())
    one = labels.groupBy("group", "topic_id").agg(F.min(F.struct("label", "description")).alias("l")).select("group", F.col("topic_id").cast("int").alias("topic_id"), "l.*")
    cited = rows.filter(F.size("_claims") >= floor).select("insight_id", F.posexplode("_claims").alias("k", "c")).select("insight_id", "k", "c.group", "c.topic_id")
    line = F.concat(F.lit("  "), "group", F.lit("|"), F.col("topic_id").cast("string"), F.lit(" | label: "), F.coalesce("label", F.lit("")), F.lit(" | description: "), F.coalesce("description", F.lit("")))
    shown = cited.join(one, ["group", "topic_id"]).groupBy("insight_id").agg(F.array_sort(F.collect_list(F.struct("k", line.alias("line")))).alias("l"))
    shown = shown.select("insight_id", F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("_lines"))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    parts = [F.lit("Title: "), text("title"), F.lit("\nFinding: "), text("finding"), F.lit("\nEvidence: "), text("evidence_basis"), F.lit("\nClaimed topics:\n"), F.col("_lines")]
    prompt = F.concat(*parts, F.lit("\nAnswer JSON {verified_topics: [{group, topic_id}]} with those that support it."))
    sent = shown.join(rows.select("insight_id", "title", "finding", "evidence_basis"), "insight_id").select("insight_id", prompt.alias("_prompt"))
    told = ask(sent, "_prompt", model, **how).withColumn("g", json_reply(f"verified_topics array<{CLAIM}>"))
    kept = F.array_distinct(F.filter("g.verified_topics", lambda x: x["group"].isin(*groups) & x["topic_id"].isNotNull()))
    problem = F.when(F.col("error").isNotNull(), F.concat(F.lit("call failed: "), "error")).when(F.col("g.verified_topics").isNull(), "not the JSON asked for")
    told = told.select("insight_id", kept.alias("_kept"), problem.alias("problem"))
    return rows.join(told, "insight_id", "left").withColumn("verified", F.coalesce("_kept", "_claims")).drop("_claims", "_kept")


def verification_stats(verified: DataFrame) -> DataFrame:
    """One row a section: insights, how many changed, how many lost all topics, topics before and after."""
    before, after = F.size(_claims()), F.size("verified")
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    sums = [F.count("*").alias("insight_count"), count(before != after).alias("changed_count"), count((before > 0) & (after == 0)).alias("dropped_to_zero_count"), F.sum(before).alias("topics_before"), F.sum(after).alias("topics_after")]
    return verified.groupBy("section").agg(*sums)


def judge_pairs(pairs: DataFrame, insights: DataFrame, model: Callable[[str], str], shown: Sequence[str] = ("section", "category_bucket", "title", "finding"), **how) -> DataFrame:
    """pairs (insight_id_a, insight_id_b and their overlaps) with ``duplicate`` and ``reason``: a model's decision on each screened pair.

    The reply is JSON {duplicate, reason}; a failed call or another reply keeps both insights."""
    told = pairs
    for side in "ab":
        text = F.concat_ws("\n", *[F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in shown])
        told = told.join(insights.select(F.col("insight_id").alias(f"insight_id_{side}"), text.alias(f"_{side}")), f"insight_id_{side}")
    hints = [F.format_string(f"{c}: %.3f", F.col(c)) for c in pairs.columns if c.endswith("_overlap")]
    prompt = F.concat_ws("\n\n", F.lit("Do both insights say the same? Answer JSON {duplicate, reason}."), F.concat(F.lit("A\n"), "_a"), F.concat(F.lit("B\n"), "_b"), F.concat_ws("\n", *hints))
    told = ask(told.withColumn("_prompt", prompt), "_prompt", model, **how).withColumn("g", json_reply("duplicate boolean, reason string"))
    return told.select(*pairs.columns, F.coalesce("g.duplicate", F.lit(False)).alias("duplicate"), F.coalesce("g.reason", "error").alias("reason"))
