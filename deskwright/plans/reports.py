"""Summary reports, made from the one-row summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskwright import fixed
from deskwright.functions.formatting import percent, thousands, yes_no
from deskwright.plans.store import TicketStore


def json_report(summary: DataFrame) -> DataFrame:
    """One JSON text per run, with sorted keys."""
    columns = sorted(summary.columns)
    dimensions = F.struct(*[f"quality_dimensions.{d}" for d in sorted(fixed.DIMENSIONS)])
    body = F.struct(
        *[dimensions.alias(c) if c == "quality_dimensions" else F.col(c) for c in columns]
    )
    return summary.select(F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


# The counters of a run, in the order of the report, as (column, what it says).
_COUNTERS = [
    ("total_records", "rows read"),
    ("accepted_records", "rows accepted"),
    ("quarantined_records", "rows in quarantine"),
    ("duplicate_records", "rows whose ticket had come before"),
    ("loaded_records", "tickets written"),
    ("unchanged_records", "tickets already as new in the store"),
]


def _sentence(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def markdown_report(summary: DataFrame, timings: bool = True) -> DataFrame:
    """One Markdown text per run; ``timings`` adds the line that depends on the clock."""
    c = F.col
    mode = F.when(c("dry_run"), "trial without loading").otherwise(
        F.when(c("incremental"), "newer rows win").otherwise("new tickets only")
    )
    verdict = yes_no(c("quality_gate_passed"), "PASS", "FAIL")
    lines = [
        _sentence("# Ticket export ", c("run_id")),
        F.lit(""),
        _sentence("Run ", F.lower("status"), ", mode: ", mode, "."),
        _sentence("Input ", c("input_format"), " with identity ", c("input_hash"), "."),
        _sentence(
            verdict, ": the score is ", percent(c("quality_score")), ", wanted are ",
            percent(c("quality_threshold")), " or more.",
        ),
        F.lit(""),
        *[_sentence("* ", thousands(c(name)), f" {what}") for name, what in _COUNTERS],
    ]
    if timings:
        rate = thousands(c("records_per_second"), 2)
        lines.append(
            _sentence("* ", F.format_string("%.3f", "duration_seconds"), " s of work, ", rate, " rows a second")
        )
    lines.append(F.lit(""))
    lines += [
        _sentence(f"{name.title()} | ", percent(c(f"quality_dimensions.{name}")))
        for name in fixed.DIMENSIONS
    ]
    return summary.select(F.concat_ws("\n", *lines).alias("value"))


def write_reports(
    store: TicketStore, summary: DataFrame, run_id: str, only_missing: bool = False
) -> None:
    """Write the JSON and Markdown reports of one run under the store's ``reports`` folder."""
    for kind, report in (("json", json_report), ("markdown", markdown_report)):
        path = f"{store.root}/reports/{run_id}/{kind}"
        if only_missing and store.exists(f"{path}/_SUCCESS"):
            continue
        report(summary).coalesce(1).write.mode("overwrite").text(path)
