"""Scoring a live stream with the stored models."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from flowlens import conventions as K
from flowlens.plans.layout import Layout
from flowlens.sources.documents import load_manifest, read_values
from flowlens.sources.tables import load_model
from flowlens.sources.wire import LINEAGE_SCHEMA, parse_wire_checked, wire_schema
from flowlens.streaming.scoring import CLUSTER_SINK, FOREST_SINK, Scorer, batch_writer, start_scoring
from flowlens.streaming.sla import SlaListener


def load_scorer(
    spark: SparkSession, layout: Layout, forest: str = "forest_v1", clusters: str = "clusters_v1"
) -> Scorer:
    """The stored models with the calibrated threshold, or the fixed one where none was calibrated."""
    calibrated = read_values(spark, layout("reports", f"{clusters}_threshold"))
    return Scorer(
        load_model(layout("models", "preparation")),
        load_model(layout("models", forest)),
        load_model(layout("models", clusters)),
        calibrated.get("threshold_optimal", K.STREAM_THRESHOLD),
    )


def score_lines(
    spark: SparkSession,
    layout: Layout,
    lines: DataFrame,
    trigger: str | None = K.TRIGGER,
    extra: Sequence[str] = (),
    listener: bool = True,
    **models: str,
) -> StreamingQuery:
    """Start scoring a stream of wire lines into the two score tables, the batch summaries and the
    service-level log. Malformed lines go to a table of their own, unscored. ``extra`` names feature columns to store beside the predictions."""
    features = load_manifest(spark, layout("models", "features"))
    rows = parse_wire_checked(lines, wire_schema(features), LINEAGE_SCHEMA)
    writer = batch_writer(
        load_scorer(spark, layout, **models).score,
        {
            layout("live", "forest"): [*FOREST_SINK, *extra],
            layout("live", "clusters"): CLUSTER_SINK,
        },
        layout("live", "summary"),
        bad_path=layout("live", "malformed"),
        commit_path=layout("live", "commits"),
    )
    name = f"scoring-{uuid.uuid4().hex}"
    if listener:
        spark.streams.addListener(SlaListener(spark, layout("live", "sla"), name))
    return start_scoring(rows, writer, layout("live", "checkpoint"), trigger, name)
