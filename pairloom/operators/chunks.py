"""Sequential state along a series, run chunk by chunk in three passes.

1. every chunk is summarised for each state it could be entered in,
2. the summaries of a series (one small row per chunk) are folded to entry states,
3. every chunk runs again from its known entry state.

Passes 1 and 3 are spread over chunks, so one long series uses many tasks.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.operators.series import ORD, SeriesSpec, with_ordinal

CHUNK = "_chunk"
HOME = "_home"
Step = Callable[[pd.DataFrame], pd.DataFrame]


def _fields(ddl: str) -> list[T.StructField]:
    return list(T.StructType.fromDDL(ddl).fields)


def chunk_fold(df: DataFrame, spec: SeriesSpec, summarise: Step, summary: str, fold: Step, entry: str,
               apply: Step, output: str, back: int = 0) -> DataFrame:
    """Run ``summarise`` per chunk, ``fold`` per series, ``apply`` per chunk with its entry row.

    Frames given to the steps are sorted. Chunks also hold ``back`` rows before their own ones
    (``_home`` false). The DDL strings list the columns each step adds to the keys.
    """
    keys = list(spec.keys)
    size = spec.chunk_rows
    if ORD not in df.columns:
        df = with_ordinal(df, spec)
    rows = df.withColumn(
        CHUNK, F.explode(F.sequence(F.floor(F.col(ORD) / size), F.floor((F.col(ORD) + back) / size)))
    ).withColumn(HOME, F.floor(F.col(ORD) / size) == F.col(CHUNK))
    key_fields = [df.schema[k] for k in keys]
    summary_fields, entry_fields, output_fields = _fields(summary), _fields(entry), _fields(output)
    summary_names, entry_names, output_names = (
        [f.name for f in fields] for fields in (summary_fields, entry_fields, output_fields))
    chunk_field = T.StructField(CHUNK, T.LongType())

    def keyed(pdf: pd.DataFrame, out: pd.DataFrame, cols: list[str]) -> pd.DataFrame:
        for i, c in enumerate(cols):
            out.insert(i, c, pdf[c].iloc[0])
        return out

    def run_summary(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ORD)
        names = [*keys, CHUNK, *summary_names]
        if not pdf[HOME].any():
            return pd.DataFrame(columns=names)
        return keyed(pdf, summarise(pdf), [*keys, CHUNK])[names]

    def run_fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(CHUNK)
        out = fold(pdf)
        out[CHUNK] = pdf[CHUNK].to_numpy()
        return keyed(pdf, out, keys)[[*keys, CHUNK, *entry_names]]

    def run_apply(pdf: pd.DataFrame) -> pd.DataFrame:
        return keyed(pdf, apply(pdf.sort_values(ORD)), keys)[[*keys, *output_names]]

    summaries = rows.groupBy(*keys, CHUNK).applyInPandas(
        run_summary, T.StructType([*key_fields, chunk_field, *summary_fields]))
    entries = summaries.groupBy(*keys).applyInPandas(
        run_fold, T.StructType([*key_fields, chunk_field, *entry_fields]))
    return rows.join(entries, [*keys, CHUNK]).groupBy(*keys, CHUNK).applyInPandas(
        run_apply, T.StructType([*key_fields, *output_fields]))
