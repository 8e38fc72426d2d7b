"""Default field labels: code -> language -> label."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from shelfweave.operators.relational import literal_rows

# Fixed values, kept as plain JSON text next to this module.
LABEL_FILE = Path(__file__).with_name("default_labels.json")


def default_labels(spark: SparkSession) -> DataFrame:
    """(code, iso_code, label) of the labels every shop starts with."""
    labels = json.loads(LABEL_FILE.read_text(encoding="utf-8"))
    rows = [(code, iso, label) for code, by_iso in labels.items() for iso, label in by_iso.items()]
    return literal_rows(spark, rows, "code string, iso_code string, label string")
