"""Stages by name over a table of clips, each a step of its own or all in a row."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import quality as Q
from ..operators import relational as R

#: Batches of a table to batches of the same columns.
Hook = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def hooked(df: DataFrame, hook: Hook | None) -> DataFrame:
    """df through a denoiser or speech detector that the caller has; without one the clips are passed on as they are."""
    return df.mapInPandas(hook, df.schema) if hook else df


def ingest(df: DataFrame) -> DataFrame:
    """Clips with audio and text, the first (by path) of each speaker's sentence; where it has no id the text stands for it."""
    given = F.nullif(F.col("sentence_id").cast("string"), F.lit("")) if "sentence_id" in df.columns else F.lit(None).cast("string")
    keyed = Q.with_audio_and_text(df, "audio_path", "text").withColumns({"__by_id": given.isNotNull(), "__sentence": F.coalesce(given, F.col("text"))})
    speaker = ["speaker_id"] if "speaker_id" in df.columns else []
    return R.first_wins(keyed, [*speaker, "__by_id", "__sentence"], ["audio_path", "text"]).drop("__by_id", "__sentence")


def normalize(df: DataFrame) -> DataFrame:
    """The text as it is read aloud; what it was is kept as text_raw."""
    return T.normalize(df.withColumn("text_raw", F.col("text")))


STAGES: dict[str, Callable[..., DataFrame]] = {
    "ingest": ingest,
    "measure": lambda df, samples="samples", rate="sample_rate": Q.measured(df, samples, F.col(rate)),
    "filter": lambda df, lowest="B": Q.at_least(df, lowest),
    "denoise": lambda df, hook=None: hooked(df, hook),
    "vad": lambda df, hook=None: hooked(df, hook),
    "normalize": normalize,
}


def run(df: DataFrame, stages: Sequence[str], **options: dict) -> DataFrame:
    """df through the named stages; options holds the arguments of a stage by its name."""
    if unknown := [s for s in stages if s not in STAGES]:
        raise ValueError(f"no such stage: {', '.join(unknown)}")
    for s in stages:
        df = STAGES[s](df, **options.get(s, {}))
    return df
