"""The flagship query: load → gate (quantile bounds) → label → phenotype summary per cluster."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytospark.operators import gating, labels, phenotype
from cytospark.session import configure
from cytospark.sources import fixtures as fx

FLAGSHIP_GATE = [
    ("price band", {"price": "between quantile(0.05), quantile(0.95)"}),
]


def flagship(spark: SparkSession, sf_dir: str, threshold: float = 0.5) -> DataFrame:
    configure(spark)
    ev = gating.gate(fx.line_events(spark, sf_dir), FLAGSHIP_GATE)
    lab = labels.label_events(ev, fx.LINE_CUTOFFS)
    sm = phenotype.summarize_phenotypes(lab, fx.LINE_CHANNELS, "cluster", threshold)
    return phenotype.phenotype_strings(sm).join(
        lab.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_events")), "cluster")
