"""Render corpora of question/SQL records into training examples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.context import read_fields, training_context
from ..operators.templates import Template, is_valid_render, load_template
from ..session import configure
from ..sinks.counters import observed, write_counts
from ..sinks.writers import write_lines, write_sorted_out
from ..sources.config import DatasetSpec, RenderSpec
from ..sources.records import PROVENANCE, read_records

MODES = ("safe", "raw")


def render_records(records: DataFrame, template: Template, mode: str = "safe") -> DataFrame:
    """Provenance and ``rendered`` for records as ``read_records`` gives them.  No shuffle."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    fields = read_fields(records)
    if mode == "raw":
        text = template.render_raw(training_context(fields, python_text=True))
    else:
        text = template.render_safe(training_context(fields))
    return fields.frame.select(*PROVENANCE, text.alias("rendered"))


def render_corpus(
    spark: SparkSession,
    dataset: DatasetSpec,
    default_template: Template,
    mode: str = "safe",
    layout: str = "auto",
) -> DataFrame:
    template = load_template(spark, dataset.template) if dataset.template else default_template
    return render_records(read_records(spark, dataset.input, layout), template, mode)


def run_render(
    spark: SparkSession,
    spec: RenderSpec,
    mode: str = "safe",
    ordered: bool = False,
    layout: str = "auto",
    on_error: str = "keep",
) -> list[dict[str, int]]:
    """Render every dataset of the job to its output folder; returns its counts.

    One narrow pass per dataset, in which the rows and the texts that are no valid JSON are counted;
    the counts are kept in ``<output>.counts``.  Only ``ordered`` output needs a shuffle.  Raw values can
    break the JSON: ``on_error="quarantine"`` writes such texts apart, as ``status=bad`` beside
    ``status=good``; ``fail`` ends the job; ``keep`` writes them with the others.
    """
    if on_error not in ("keep", "fail", "quarantine"):
        raise ValueError(f"on_error must be 'keep', 'fail' or 'quarantine', not {on_error!r}")
    configure(spark)
    default = load_template(spark, spec.default_template)
    counts = []
    for dataset in spec.datasets:
        rendered = render_corpus(spark, dataset, default, mode, layout)
        # Safe rendering escapes every value; only raw text needs to be read again.
        valid = is_valid_render(F.col("rendered")) if mode == "raw" else F.lit(True)
        rendered = rendered.withColumn("valid", valid)
        if on_error == "fail":
            broken = F.raise_error(F.concat(F.lit("no JSON after rendering: "), F.col("rendered"))).cast("string")
            rendered = rendered.withColumn("rendered", F.when(F.col("valid"), F.col("rendered")).otherwise(broken))
        rendered, seen = observed(rendered, rendered=F.lit(True), invalid=~F.col("valid"))
        if on_error == "quarantine":
            write_sorted_out(rendered, F.col("rendered"), F.col("valid"), dataset.output)
        else:
            write_lines(rendered, F.col("rendered"), dataset.output, ordered)
        counts.append(seen())
        write_counts(spark, counts[-1], f"{dataset.output.rstrip('/')}.counts")
    return counts
