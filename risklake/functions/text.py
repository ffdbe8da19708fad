"""Text clean-up and label parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from risklake.config import LABEL_FALSE, LABEL_TRUE


def folded(text: Column) -> Column:
    return F.lower(F.trim(text))


def label(text: Column) -> Column:
    """True/False for the known spellings, NULL for anything else."""
    word = folded(text)
    return F.when(word.isin(*LABEL_TRUE), F.lit(True)).when(
        word.isin(*LABEL_FALSE), F.lit(False)
    )
