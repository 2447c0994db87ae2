"""The one Python helper of the library: byte-exact indented JSON for reports
(EXP-11 option).  Arrow-batched; the default path stays JVM-side
(``exprs.json_normalise``)."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType


def _indent(text):
    if text is None:
        return None
    if text.strip().startswith(("{", "[")):
        try:
            return json.dumps(json.loads(text), indent=2)
        except ValueError:
            return text
    return text


@pandas_udf(StringType())
def json_indent(s: pd.Series) -> pd.Series:
    """Valid JSON text re-rendered with a 2-space indent (key order kept);
    other text unchanged."""
    return s.map(_indent)


def json_indent_col(c):
    """``json_indent`` as a column, with the package shipped to the workers."""
    from pyspark.sql import SparkSession

    from sluice.session import ship_package

    ship_package(SparkSession.getActiveSession())
    return json_indent(c)
