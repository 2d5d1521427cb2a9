"""Tracked names, step metrics, and the files that show them."""

from __future__ import annotations

import html
import json
import logging
import time
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poiloom.operators.dedup import report_drops, top_dropped
from poiloom.operators.steps import StepResult


def tracked(rows: DataFrame, items: list[str], column: str) -> DataFrame:
    """text, drop_reason, records: of each tracked text the rows that contain it, by reason (null: kept)."""
    low = F.lower(F.col(column))
    hits = F.filter(F.array(*[F.lit(x) for x in items]), lambda x: F.contains(low, F.lower(x)))
    return rows.select(F.explode(hits).alias("text"), "drop_reason").groupBy("text", "drop_reason").agg(F.count(F.lit(1)).alias("records"))


def audit(result: StepResult, items: list[str], title: str, prune: bool = True) -> tuple[list[str], str | None]:
    """What became of the tracked texts at a step, and the texts still tracked: prune takes out those with any drop."""
    if not items:
        return items, None
    found: dict[str, dict] = {}
    for r in tracked(result.rows, items, result.track).collect():
        found.setdefault(r["text"], {})[r["drop_reason"]] = r["records"]
    lines = []
    for text in (t for t in items if t in found):
        lines.append(f"Tracked text: '{text}'")
        if None in found[text]:
            lines.append(f"    SURVIVED: passed this filter ({found[text][None]} records)")
        lines += [f"    DROPPED: [{why}] ({n} records dropped)" for why, n in sorted((w, n) for w, n in found[text].items() if w is not None)]
    left = [t for t in items if not (prune and any(w is not None for w in found.get(t, {})))]
    return left, "\n".join([f"AUDIT: {title}", *lines]) if lines else None


class AuditFile:
    """A text file on the driver: header, a part for each step, a verdict."""

    def __init__(self, data_dir: str, items: list[str]):
        folder = Path(data_dir) / "audit"
        folder.mkdir(parents=True, exist_ok=True)
        self.path = folder / f"audit_report_{time.strftime('%Y%m%d_%H%M%S')}.txt"
        self.path.write_text(f"AUDIT REPORT STARTED\nTracked items: {items}\n", encoding="utf-8")

    def add(self, text: str) -> None:
        with self.path.open("a", encoding="utf-8") as f:
            f.write(f"\n{text}\n")

    def finish(self, final: DataFrame, items: list[str]) -> None:
        """The verdict on what is still tracked; nothing is written if that is nothing."""
        if not items:
            return
        rows = tracked(final.withColumn("drop_reason", F.lit(None).cast("string")), items, "name_normalized").collect()
        n = {r["text"]: r["records"] for r in rows}
        self.add("\n".join(["FINAL SUMMARY", *[f"'{t}': REACHED THE END ({n[t]} records)" if t in n else f"'{t}': COMPLETELY DROPPED" for t in items]]))


@dataclass
class StepMetrics:
    step_name: str
    dropped_count: int
    remaining_count: int
    top_dropped: list[tuple[str, int]] = field(default_factory=list)


def percentage(removed: int, initial: int) -> float:
    return removed / initial * 100 if initial else 0.0


def log_reduction(before: int, after: int, step: str) -> None:
    logging.info("[%s] removed %d rows (%.2f%%): %d, now %d", step, before - after, percentage(before - after, before), before, after)


def step_metrics(before: DataFrame, after: DataFrame, step_name: str) -> StepMetrics:
    """Counts, and the five names most frequent among the rows that went."""
    n, m = before.count(), after.count()
    name = "name" if "name" in before.columns else "name_normalized"
    top = [(r[name], r["freq"]) for r in top_dropped(report_drops(before, after), name).collect()] if m < n else []
    return StepMetrics(step_name, n - m, m, top)


def html_report(metrics: list[StepMetrics], data_dir: str) -> Path:
    """A page with a bar chart of drops by step and a card for each; names are escaped."""
    folder = Path(data_dir).parent / "reports"
    folder.mkdir(parents=True, exist_ok=True)
    cards = []
    for m in metrics:
        rows = "".join(f"<li><b>{n}</b> <code>{html.escape(str(name))}</code></li>" for name, n in m.top_dropped) or "<li>none</li>"
        cards.append(f"<section><h3>{html.escape(m.step_name)}</h3><p>Dropped: {m.dropped_count:,}. Remaining: {m.remaining_count:,}.</p><ul>{rows}</ul></section>")
    data = json.dumps({"labels": [m.step_name for m in metrics], "datasets": [{"label": "Dropped records", "data": [m.dropped_count for m in metrics]}]}).replace("<", "\\u003c")
    page = f"""<!DOCTYPE html>
<html lang="en"><head><meta charset="utf-8"><title>Cleaning report</title><script src="https://cdn.jsdelivr.net/npm/chart.js"></script></head>
<body><h1>Cleaning report</h1><canvas id="drops"></canvas>{"".join(cards)}
<script>new Chart(document.getElementById("drops"), {{type: "bar", data: {data}}});</script></body></html>
"""
    path = folder / f"pipeline_report_{time.strftime('%Y%m%d_%H%M%S')}.html"
    path.write_text(page, encoding="utf-8")
    return path
