"""The whole cleaning run: read, steps in the caller's order, reports, write."""

from __future__ import annotations

import logging
import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from poiloom.operators import steps as S
from poiloom.operators.dedup import exact_drops, legacy_drops
from poiloom.plans.audit import AuditFile, StepMetrics, audit, html_report, log_reduction, step_metrics
from poiloom.sources.config import Settings
from poiloom.sources.io import read_csv, with_row_id, write_csv
from poiloom.sources.packs import blacklist, chain_patterns
from poiloom.sources.tables import materialized


@dataclass(frozen=True)
class Step:
    name: str
    file: str
    run: Callable[[DataFrame], S.StepResult]


def pipeline_steps(chains: Sequence[str], keywords: Sequence[str]) -> dict[int, Step]:
    """The registry of steps; callers may add or replace entries."""
    return {
        1: Step("Module 1: Normalization", "01_normalized_deduped.csv", S.normalize_and_dedup),
        2: Step("Module 2: Chain Filter", "02_chains_filtered.csv", lambda df: S.remove_chains(df, chains)),
        3: Step("Module 3: Spatial Dedup", "03_geo_deduped.csv", S.geo_dedup),
        4: Step("Module 4: Hours and Fuzzy Filters", "04_hours_fuzzy_filtered.csv", S.hours_and_fuzzy),
        5: Step("Module 5: Final Keywords", "05_keywords_excluded.csv", lambda df: S.final_keywords(df, keywords)),
        6: Step("Module 6: Crowded Property", "06_crowded_filtered.csv", S.crowded_property),
    }


def clean(df: DataFrame, chains: Sequence[str], keywords: Sequence[str], modules: Sequence[int] = (1, 2, 3, 4, 5, 6)) -> DataFrame:
    """The survivors of the steps, each step's result written to the shared folder; unknown steps are left out."""
    registry = pipeline_steps(chains, keywords)
    # row numbers made here have to be the same in every later look at the rows
    current = df if "row_id" in df.columns else materialized(with_row_id(df), "rows")
    for m in modules:
        if m in registry:
            current = materialized(registry[m].run(current).kept, f"step-{m}")
    return current


def run_pipeline(
    spark: SparkSession,
    settings: Settings,
    modules: Sequence[int] = (1, 2, 3, 4, 5, 6),
    save_tracking: bool = True,
    save_drops: bool = True,
    items: Sequence[str] = (),
    prune: bool = True,
    exact: bool = True,
) -> list[StepMetrics]:
    """Reads the raw CSV, runs the modules and writes survivors, drops, audit, report and the final CSV.

    exact: drops are the rows that went; else those without an equal row left, where nulls are never equal.
    """
    registry = pipeline_steps(chain_patterns(settings.country, settings.packs), blacklist(settings.packs) if 5 in modules else ())
    left = list(items)
    report = AuditFile(settings.data_dir, left) if left else None
    metrics = []
    start = current = materialized(read_csv(spark, settings.raw_data), "raw")
    for m in modules:
        if m not in registry:
            continue
        step, before = registry[m], current
        result = step.run(before)
        result = S.StepResult(materialized(result.rows, f"step-{m}"), result.track)
        current = result.kept
        left, text = audit(result, left, step.name, prune)
        if report and text:
            report.add(text)
        metrics.append(step_metrics(before, current, step.name))
        if save_tracking:
            os.makedirs(f"{settings.data_dir}/processed", exist_ok=True)
            write_csv(current, f"{settings.data_dir}/processed/{step.file}")
        if save_drops and metrics[-1].dropped_count:
            os.makedirs(f"{settings.data_dir}/dropped", exist_ok=True)
            gone = exact_drops(before, current) if exact else legacy_drops(before, current)
            write_csv(gone, f"{settings.data_dir}/dropped/{step.file}")
        log_reduction(metrics[-1].dropped_count + metrics[-1].remaining_count, metrics[-1].remaining_count, step.name)
    if report:
        report.finish(current, left)
    if metrics:
        html_report(metrics, settings.data_dir)
    log_reduction(start.count(), current.count(), "whole run")
    write_csv(current, settings.output_data)
    logging.info("final file: %s", settings.output_data)
    return metrics
