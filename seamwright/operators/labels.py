"""Payloads, topic lines and replies of the stages that label topics and write insights."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import clean_label
from . import ports

#: Reply schema of a topic label, and what its coherence flag may be.
LABEL = "proposed_label string, description string, coherence_flag string, notes string"
FLAGS = ("coherent", "mixed", "redundant", "unclear")


def payloads(topics: DataFrame, weights: DataFrame, texts: DataFrame, group: str, project: str, snippets: int = 5, terms: int = 10) -> DataFrame:
    """group, topic_id, unigrams, bigrams, nmf_terms, snippets: what a prompt shows of a topic.

    topics: group, topic_id, top_terms; weights: group, topic_id, project, weight (the heaviest ``snippets`` projects come, ties
    by project); texts: project, text."""
    k = F.row_number().over(Window.partitionBy(group, "topic_id").orderBy(F.desc("weight"), F.col(project)))
    w = weights.withColumn("k", k).filter(F.col("k") <= snippets).select(group, "topic_id", "k", F.col(project).alias("_q"))
    shown = w.join(texts.select(F.col(project).alias("_p"), F.col("text")), F.col("_q") == F.col("_p"), "left")
    shown = shown.groupBy(group, "topic_id").agg(F.array_sort(F.collect_list(F.struct("k", F.coalesce("text", F.lit("")).alias("t")))).alias("s"))
    lines = F.array_join(F.transform("s", lambda x: F.concat(F.lit("- "), x["t"])), "\n")
    first = lambda keep, n: F.array_join(F.slice(F.filter("top_terms", keep), 1, n), ", ")
    out = topics.join(shown.select(group, "topic_id", lines.alias("snippets")), [group, "topic_id"], "left")
    return out.select(
        group, "topic_id", first(lambda t: ~t.contains(" "), terms).alias("unigrams"), first(lambda t: t.contains(" "), max(2, terms // 2)).alias("bigrams"),
        F.array_join(F.slice("top_terms", 1, terms), ", ").alias("nmf_terms"), F.coalesce("snippets", F.lit("")).alias("snippets"),
    )


def label_topics(shown: DataFrame, group: str, model: Callable[[str], str], **how) -> DataFrame:
    """group, topic_id, LABEL's fields and ``problem`` (null: fine).  A failed call or a reply that isn't such JSON gives an empty label; an unknown flag becomes ``unclear``."""
    prompt = F.concat_ws("\n", F.lit("Label this topic. Answer JSON {proposed_label, description, coherence_flag, notes}."), F.concat(F.lit("Terms: "), "nmf_terms"), F.concat(F.lit("Phrases: "), "bigrams"), "snippets")
    told = ports.ask(shown.withColumn("_prompt", prompt), "_prompt", model, **how).withColumn("g", ports.json_reply(LABEL))
    usable = F.col("g.proposed_label").isNotNull()
    flag = F.when(F.col("g.coherence_flag").isin(*FLAGS), F.col("g.coherence_flag")).otherwise("unclear")
    problem = F.when(F.col("error").isNotNull(), F.concat(F.lit("call failed: "), "error")).when(~F.coalesce(usable, F.lit(False)), "not the JSON asked for")
    return told.select(group, "topic_id", "g.proposed_label", "g.description", flag.alias("coherence_flag"), "g.notes", problem.alias("problem"))


def label_order(labels: DataFrame, topics: DataFrame, group: str) -> DataFrame:
    """group, topic_id, problem: topics without a label, labels without a topic, and topics labelled more than once."""
    want = topics.select(group, "topic_id").distinct().withColumn("_want", F.lit(1))
    got = labels.groupBy(group, "topic_id").agg(F.count("*").alias("n"))
    both = want.join(got, [group, "topic_id"], "full")
    problem = F.when(F.col("n").isNull(), "no label").when(F.col("_want").isNull(), "no such topic").when(F.col("n") > 1, "labelled more than once")
    return both.withColumn("problem", problem).filter("problem IS NOT NULL").select(group, "topic_id", "problem")


def coherence_counts(labels: DataFrame) -> DataFrame:
    return labels.groupBy("coherence_flag").agg(F.count("*").alias("n"))


def topic_line(group: Column, topic: Column, label: Column, flag: Column, terms: Column, description: Column, n: int = 4) -> Column:
    """One line of a synthesis prompt; without terms that part is left out."""
    clean = F.filter(F.transform(F.slice(terms, 1, n), clean_label), lambda t: t != "")
    shown = F.array_join(clean, ", ")
    parts = [F.concat(F.lit("  "), group.cast("string")), F.concat(F.lit("topic "), topic.cast("string")), F.concat(F.lit("label: "), clean_label(label)), F.concat(F.lit("coherence: "), flag)]
    return F.concat_ws(" | ", *parts, F.when(F.size(clean) > 0, F.concat(F.lit("top_terms: "), shown)), F.concat(F.lit("description: "), F.coalesce(description, F.lit(""))))


def topic_lines(labelled: DataFrame, group: str, n: int = 4) -> DataFrame:
    """group, lines: every topic of a group on a line, by topic_id.  labelled: group, topic_id, proposed_label, coherence_flag, top_terms, description."""
    line = topic_line(F.col(group), F.col("topic_id"), F.col("proposed_label"), F.col("coherence_flag"), F.col("top_terms"), F.col("description"), n)
    rows = labelled.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("topic_id", line.alias("line")))).alias("l"))
    return rows.select(group, F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("lines"))


def synthesize(lines: DataFrame, group: str, instructions: str, model: Callable[[str], str], descriptions: DataFrame | None = None, **how) -> DataFrame:
    """group, text (null: the call failed), error: one call a group over its topic lines."""
    rows = lines if descriptions is None else lines.join(descriptions, group, "left")
    about = F.col("description") if descriptions is not None else F.lit(None).cast("string")
    prompt = F.concat_ws("\n\n", F.concat(F.lit("Group: "), F.col(group).cast("string")), about, "lines", F.lit(instructions))
    return ports.ask(rows.withColumn("_prompt", prompt), "_prompt", model, **how).select(group, F.col("reply").alias("text"), "error")
