"""Batch operators for sensor time series on Spark DataFrames."""

from strandline.functions import columns
from strandline.operators import dedupe, features, figures, gate, model, upsert
from strandline.plans import limits, medallion
from strandline.sources import runs, scan, schemas, shared, tables

__all__ = [
    "columns",
    "dedupe",
    "features",
    "figures",
    "gate",
    "limits",
    "medallion",
    "model",
    "runs",
    "scan",
    "schemas",
    "shared",
    "tables",
    "upsert",
]
