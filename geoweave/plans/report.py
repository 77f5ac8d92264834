"""Reports from small summary tables: a card of a run, and a comparison of two lexical versions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from geoweave.operators import gazetteer
from geoweave.plans.runs import comparison, top_names
from geoweave.session import saved


def _table(frame: DataFrame) -> list[str]:
    """Summaries have a row a source or a name, so they are small."""
    rows = frame.collect()
    head = [f"| {' | '.join(frame.columns)} |", f"| {' | '.join('---' for _ in frame.columns)} |"]
    return head + [f"| {' | '.join(str(v) for v in r)} |" for r in rows]


def run_card(title: str, settings: dict, summary: DataFrame) -> str:
    lines = [f"# {title}", "", "## Settings", "", *(f"- {k}: {v}" for k, v in sorted(settings.items())), "", "## Results by source", "", *_table(summary.orderBy("source_key"))]
    return "\n".join(lines) + "\n"


def comparison_report(v2: DataFrame, v3: DataFrame, k: int = 10) -> str:
    """Both are worked out once, and kept without the columns that the report does not show."""
    keys = ["source_key", "polygon_id", "matched_alias", "url", "sentence"]
    v2 = saved(v2.select(*keys), "compared-v2")
    v3 = saved(v3.select(*keys, "decision_tier", *gazetteer.document_key(v3), "start"), "compared-v3")
    row = comparison(v2, v3).first()
    tiers = v3.groupBy("source_key", "decision_tier").count().orderBy("source_key", "decision_tier")
    share = f"{100 * v3.where('decision_tier = \"high_confidence\"').count() / row.rows_v3:.2f} %" if row.rows_v3 else "no rows"
    return "\n".join(["# Candidates of versions 2 and 3", "", f"Rows: {row.rows_v2} and {row.rows_v3}; equal as multisets: {'yes' if row.equal else 'no'}. High confidence: {share}.", "", "## Tiers", "", *_table(tiers), "", "## Names with the most mentions", "", *_table(top_names(v3, k))]) + "\n"
