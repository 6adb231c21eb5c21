"""Batch jobs: sources -> Bronze -> Silver -> Gold."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratakit.operators.dedup import latest
from stratakit.operators.enrich import enrich_municipality_targets, enrich_state_targets, prune, STUDENT_COLUMNS
from stratakit.operators.indicator import local_indicator, state_indicator
from stratakit.operators.quality import FOREIGN_KEY, Checked, check, failures_of, metrics_of, written
from stratakit.operators.standardize import standardize_common
from stratakit.plans.config import BATCH_SOURCES, ENTITIES, GOLD_RULES, Entity
from stratakit.sources.readers import read_bronze, read_silver, read_source
from stratakit.sources.sinks import write_bronze, write_gold, write_quarantine, write_silver

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Run:
    """What one run works on; ids and times come from the caller, so that a
    rerun of a batch repeats it."""

    batch_id: str
    at: str
    years: tuple[int, ...] | None = None
    limit: int | None = None
    overwrite: bool = True
    lean: bool = False  #: foreign keys without their reference pass instead of failing the run


def selected(names: Iterable[str] | str, known: Iterable[str]) -> list[str]:
    """Validated names, or all of them for ``"all"``."""
    known = list(known)
    if names == "all":
        return known
    wanted = [n.strip() for n in names.split(",")] if isinstance(names, str) else list(names)
    unknown = [n for n in wanted if n not in known]
    if unknown:
        raise ValueError(f"unknown names: {', '.join(unknown)}")
    return wanted


def parsed_years(text: str | None) -> tuple[int, ...] | None:
    """``"2023, 2024"`` as numbers; nothing or ``"all"`` is no filter."""
    parts = [p.strip() for p in (text or "").split(",") if p.strip()]
    if not parts or parts == ["all"]:
        return None
    wrong = [p for p in parts if not p.isdigit()]
    if wrong:
        raise ValueError(f"not years: {', '.join(wrong)}")
    return tuple(sorted({int(p) for p in parts}))


def ingest(spark: SparkSession, sources: dict[str, str], bronze: str, run: Run, names: Iterable[str] | str = "all", source_format: str = "parquet", **options: str) -> DataFrame:
    """Sources to Bronze; gives ``source, records, written``."""
    rows = []
    for name in selected(names, BATCH_SOURCES):
        entity = ENTITIES[name]
        df = read_source(spark, sources[name], None, run.years if entity.year_filter else None, entity.partition or "ano", run.limit, None, source_format, **options).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            n = df.count()
            done = n > 0 and write_bronze(df, f"{bronze}/{name}", entity.source, run.batch_id, run.at, entity.required, entity.partition, run.overwrite)
            rows.append((name, n, bool(done)))
        finally:
            df.unpersist()
    return spark.createDataFrame(rows, "source string, records long, written boolean")


def ingestion_metrics(counts: DataFrame, seconds: float = 0.0, failed: bool = False) -> DataFrame:
    """One row: all records, sources with rows, sources without, the run's
    duration, and 1 if it failed."""
    return counts.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("total_records"), F.count_if(F.col("records") > 0).alias("sources_processed"), F.count_if(F.col("records") == 0).alias("sources_empty"),
        F.lit(float(seconds)).alias("duration_seconds"), F.lit(int(failed)).alias("job_failure"),
    )


def measured_ingest(spark: SparkSession, sources: dict[str, str], bronze: str, run: Run, report: Callable[[DataFrame], None], clock: Callable[[], float] = time.monotonic, **more: str) -> DataFrame:
    """:func:`ingest`, whose metrics go to ``report`` whether it succeeds or not."""
    began = clock()
    try:
        counts = ingest(spark, sources, bronze, run, **more)
    except Exception:
        report(ingestion_metrics(spark.createDataFrame([], "source string, records long"), clock() - began, True))
        raise
    report(ingestion_metrics(counts, clock() - began))
    return counts


def to_silver(df: DataFrame, entity: Entity, references: dict[str, DataFrame], run: Run) -> Checked:
    """Standard columns, latest row a key, enrichment, checks."""
    needed = {r.reference.partition(".")[0] for r in entity.rules if r.kind == FOREIGN_KEY and r.reference} - {entity.name}
    if not run.lean and (absent := needed - references.keys()):
        raise ValueError(f"{entity.name}: references missing: {', '.join(sorted(absent))}")
    out = latest(standardize_common(df), list(entity.keys), ties=[F.asc_nulls_last(c) for c in df.columns if c not in entity.keys])
    if entity.enrich_with and entity.enrich_with in references:
        out = (enrich_state_targets if entity.enrich_with == "uf" else enrich_municipality_targets)(out, references[entity.enrich_with])
    if entity.name == "alunos":
        out = prune(out, STUDENT_COLUMNS)
    return check(out, entity.rules, references, run.at)


def silver(
    spark: SparkSession, bronze: str, silver_path: str, quarantine: str, run: Run, names: Iterable[str] | str = "all", references: dict[str, DataFrame] | None = None,
    report: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Bronze to Silver, valid rows and quarantine; gives metrics by entity, and
    ``report`` gets ``entity, rule_id, failures``.

    Entities go in the configured order, so that references are ready; masks are
    kept until all that need them are written.  The passes that write count what
    the metrics say; no other pass does.
    """
    found, kept, done = dict(references or {}), [], {}
    try:
        for name in selected(names, ENTITIES):
            entity = ENTITIES[name]
            raw = read_bronze(spark, f"{bronze}/{name}", run.years if entity.year_filter else None, entity.partition)
            if not raw.columns:
                continue
            checked = to_silver(raw, entity, found, run)
            kept.append(checked.masked.persist(StorageLevel.MEMORY_AND_DISK))
            matching = {"unmatched": F.count_if(~F.col("_join_match"))} if "_join_match" in checked.masked.columns else {}
            good = write_silver(checked.valid, f"{silver_path}/{name}", run.batch_id, run.at, entity.partition, run.overwrite, matching)
            bad = write_quarantine(checked.quarantine, f"{quarantine}/{name}", run.batch_id, "silver", {**checked.failures_in_quarantine, **matching})
            if unmatched := good.get("unmatched", 0) + bad.get("unmatched", 0):
                log.warning("%s: %d rows match no row of %s", name, unmatched, entity.enrich_with)
            found[name], done[name] = checked.valid, written(checked, good, bad)
    finally:
        for masked in kept:
            masked.unpersist()
    if report:
        report(failures_of(spark, done))
    return metrics_of(spark, done)


def gold(
    spark: SparkSession, silver_path: str, gold_path: str, quarantine: str, run: Run, names: Iterable[str] | str = "all", report: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Silver to the two indicators; gives metrics by dataset, and ``report`` gets
    ``entity, rule_id, failures``.  Both are counted by the passes that write."""
    students, towns = read_silver(spark, f"{silver_path}/alunos", run.years), read_silver(spark, f"{silver_path}/municipio", None, None)
    done = {}
    for name in selected(names, GOLD_RULES):
        targets = read_silver(spark, f"{silver_path}/meta_{name}", run.years)
        rows = local_indicator(students, targets, towns) if name == "municipio" else state_indicator(students, towns, targets)
        checked = check(rows, GOLD_RULES[name], {"municipio": towns}, run.at)
        checked.masked.persist(StorageLevel.MEMORY_AND_DISK)
        dataset = f"indicador_crianca_alfabetizada_{name}"
        try:
            good = write_gold(checked.valid, f"{gold_path}/{dataset}", run.batch_id, run.at, "ano", run.overwrite)
            bad = write_quarantine(checked.quarantine, f"{quarantine}/{dataset}", run.batch_id, "gold", checked.failures_in_quarantine)
        finally:
            checked.masked.unpersist()
        done[dataset] = written(checked, good, bad)
    if report:
        report(failures_of(spark, done))
    return metrics_of(spark, done)
