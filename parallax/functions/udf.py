"""I4: scoring hook for a user's own text model.

``apply_model`` runs ``load_model()`` once per partition (Arrow batches through
``mapInPandas``) and applies the returned callable to each batch of texts, so a model is
loaded per task, never per row, and never on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def apply_model(df: DataFrame, text_col: str, load_model: Callable[[], Callable[[pd.Series], pd.Series]],
                out_col: str = "output", out_type: T.DataType = T.StringType()) -> DataFrame:
    """Add ``out_col`` = model(text) to every row of ``df``."""
    schema = T.StructType(df.schema.fields + [T.StructField(out_col, out_type)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load_model()
        for pdf in batches:
            yield pdf.assign(**{out_col: model(pdf[text_col])})

    return df.mapInPandas(run, schema)
