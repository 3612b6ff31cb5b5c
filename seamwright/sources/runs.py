"""Folders of runs: a run's tables beside its manifest, and reading several runs back."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from ..operators.quality import compatible
from .files import _path, listed, read_text, union_runs, write_json
from .reports import manifest

MANIFEST = "manifest.json"


def write_run(spark: SparkSession, root: str, run: str, tables: dict[str, DataFrame], group_field: str, filter_fields_key: str, rows: int, params: dict | None = None, inputs: dict[str, DataFrame] | None = None, seconds: float = 0.0) -> str:
    """Writes every table as Parquet under ``root/run``, then the manifest: a run without one isn't finished.  Returns the folder."""
    folder = f"{root.rstrip('/')}/{run}"
    for name, df in tables.items():
        df.write.mode("error").parquet(f"{folder}/{name}.parquet")
    written = {name: spark.read.schema(df.schema).parquet(f"{folder}/{name}.parquet") for name, df in tables.items()}
    made = manifest("run", run, written, params or {}, seconds, inputs=inputs)
    made["files"] = {name: file_sizes(spark, f"{folder}/{name}.parquet") for name in tables}
    write_json(spark, made | {"group_field": group_field, "filter_fields_key": filter_fields_key, "output_row_count": rows}, f"{folder}/{MANIFEST}")
    return folder


def file_sizes(spark: SparkSession, path: str) -> dict:
    """Files and bytes under a path."""
    target, fs = _path(spark, path)
    found = fs.getContentSummary(target)
    return {"files": found.getFileCount(), "bytes": found.getLength()}


def find_runs(spark: SparkSession, root: str) -> dict[str, dict]:
    """Manifests of the finished runs under a folder, by run, oldest first (their names begin with the time)."""
    try:
        paths = listed(spark, f"{root.rstrip('/')}/*/{MANIFEST}")
    except FileNotFoundError:
        return {}
    return {p.rsplit("/", 2)[-2]: json.loads(read_text(spark, p)) for p in sorted(paths)}


def load_runs(spark: SparkSession, root: str, tables: dict[str, str], primary: str | None = None, within: float = 1.0, runs: list[str] | None = None) -> dict[str, DataFrame]:
    """Each named table of all runs (or those in ``runs``) as one, with run_id, ids and buckets told apart by run; a run that lacks a table adds no rows.

    tables: schema by name.  Every run is held against ``primary`` (by default the latest): other filters, or a population that
    differs by more than ``within`` percent, raise ValueError.  No finished run raises FileNotFoundError."""
    found = {k: v for k, v in find_runs(spark, root).items() if runs is None or k in runs}
    if not found or (primary and primary not in found):
        raise FileNotFoundError(f"no finished run {primary or ''} in {root}")
    main = found[primary or max(found)]
    for run, made in found.items():
        try:
            compatible(main, made, within)
        except ValueError as e:
            raise ValueError(f"run {run}: {e}") from e
    out = {}
    for name, schema in tables.items():
        frames = {run: spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{run}/{name}.parquet") for run, made in found.items() if name in made["outputs"]}
        out[name] = union_runs(frames, {run: found[run]["group_field"] for run in frames}) if frames else spark.createDataFrame([], f"{schema}, run_id string")
    return out
