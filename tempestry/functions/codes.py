"""One-letter codes and their labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---
FATALITY_TYPES = {"I": "Indirect", "D": "Direct"}
SEXES = {"M": "Male", "F": "Female"}
UNKNOWN = "Unknown"
# --- end of fixed values ---

TYPE_LABELS = (*FATALITY_TYPES.values(), UNKNOWN)


def decode(code: Column, labels: dict[str, str]) -> Column:
    """[C10, C11, F4] The label of ``code``; null and anything unlisted is Unknown."""
    label = F.lit(UNKNOWN)
    for letter, text in labels.items():
        label = F.when(code == letter, F.lit(text)).otherwise(label)
    return label
