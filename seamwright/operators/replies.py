"""Replies of a language model, kept in a table so that no prompt is asked twice."""

from __future__ import annotations

import datetime
import hashlib
import json
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "key string, reply string, error string, model string, asked_at timestamp"


@dataclass(frozen=True)
class Replies:
    """A folder of replies that all executors reach.

    A reply belongs to the model's name, the scope (what else it depends on: taxonomy, batch size, a version) and the prompt,
    by their MD5; with another of these it is asked anew, with ``force`` everything is.  Failed calls are kept as history and
    asked again.  ``in_flight`` bounds the calls at any time; every wave of ``in_flight * per_task`` prompts is appended as
    soon as it is answered, so a run that ends early loses one wave at most, and a lost task what it had in hand."""

    folder: str
    model: str
    scope: dict = field(default_factory=dict)
    in_flight: int = 20
    per_task: int = 5
    force: bool = False

    def scoped(self, **more) -> Replies:
        return replace(self, scope=self.scope | more)

    def key(self, prompt: Column) -> Column:
        """Null for a null prompt."""
        own = hashlib.md5(json.dumps([self.model, self.scope], sort_keys=True, default=str).encode()).hexdigest()
        return F.when(prompt.isNotNull(), F.md5(F.concat(F.lit(own), prompt)))

    def known(self, spark: SparkSession) -> DataFrame:
        """key, reply: the earliest good reply of each key."""
        folder = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            return spark.createDataFrame([], "key string, reply string")
        rows = spark.read.schema(SCHEMA).parquet(self.folder).filter("reply IS NOT NULL")
        return rows.groupBy("key").agg(F.min_by("reply", F.struct("asked_at", "reply")).alias("reply"))

    def fill(self, prompts: DataFrame, asked) -> DataFrame:
        """Asks what isn't known: prompts has key and prompt, asked(DataFrame) adds reply and error.  Returns key, reply, error of all prompts."""
        spark, since = prompts.sparkSession, datetime.datetime.now(datetime.UTC)
        want = prompts.filter("key IS NOT NULL").dropDuplicates(["key"])
        if not self.force:
            want = want.join(self.known(spark).select("key"), "key", "left_anti")
        waves = -(-want.count() // (self.in_flight * self.per_task))
        for wave in range(waves):
            # what a wave asks depends on its key alone, so an append before it changes nothing for it
            some = want.filter(F.pmod(F.xxhash64("key"), F.lit(waves)) == wave).repartition(self.in_flight, "key")
            told = asked(some).select("key", "reply", "error", F.lit(self.model).alias("model"), F.current_timestamp().alias("asked_at"))
            told.write.mode("append").parquet(self.folder)
        if not waves:
            return self.known(spark).withColumn("error", F.lit(None).cast("string"))
        rows = spark.read.schema(SCHEMA).parquet(self.folder)
        usable = rows.filter(F.col("asked_at") >= F.lit(since)) if self.force else rows
        late = F.struct(F.col("reply").isNull().alias("failed"), "asked_at", "reply")
        failed_now = F.max_by("error", F.when(F.col("reply").isNull(), F.col("asked_at")))
        return usable.groupBy("key").agg(F.min_by("reply", late).alias("reply"), failed_now.alias("error")).withColumn("error", F.when(F.col("reply").isNull(), F.col("error")))
