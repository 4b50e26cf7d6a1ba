"""Text normalisation with an optional lemma table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
)
from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.functions.text import kept_tokens, normalized, surface_tokens
from reviewlens.operators.lookup import lookup_join
from reviewlens.schema import STOP_WORDS
from reviewlens.sources.staging import stage

_ROW = "_row"


def normalize_text(
    df: DataFrame,
    text: str,
    out: str = "normalized",
    lemmas: DataFrame | None = None,
    stop: Iterable[str] = STOP_WORDS,
) -> DataFrame:
    """Add ``out``: marks stripped, tokens replaced by lemmas, filtered, lowered.

    Without ``lemmas`` (surface, lemma) this is one projection. With them, of any
    number, every token is joined to its lemma, and the lemmas that were found are put in
    their places in the row; tokens without lemma pass no grouping. The rows are numbered and written to the shared folder for that when this is called,
    so rows that share an id, or have none, stay apart.
    """
    stop = list(stop)
    if lemmas is None:
        return df.withColumn(out, normalized(text, stop))
    known = lemmas.where("surface is not null and lemma is not null")
    lemmas = known.groupBy("surface").agg(F.min("lemma").alias("lemma"))
    numbered = stage(df.withColumn(_ROW, F.monotonically_increasing_id()), "numbered")
    words = numbered.select(_ROW, F.posexplode(surface_tokens(text)).alias("_pos", "surface"))
    # Token frequencies, counted before the join, tell which tokens are hot.
    vocabulary = (
        words.groupBy("surface")
        .agg(F.count("*").alias("_n"))
        .join(lemmas, "surface", "left")
        .select("surface", F.col("lemma").alias("_token"), "_n")
    )
    changed = (
        lookup_join(words, vocabulary, "surface", "_n")
        .where(F.col("_token").isNotNull())
        .groupBy(_ROW)
        .agg(F.collect_list(F.struct("_pos", "_token")).alias("_changed"))
    )
    tokens = _replaced(surface_tokens(text), F.col("_changed"))
    joined = F.array_join(kept_tokens(tokens, stop), " ")
    return numbered.join(changed, _ROW, "left").withColumn(out, joined).drop(_ROW, "_changed")


def _replaced(tokens: Column, changed: Column) -> Column:
    """``tokens`` with those at the places in ``changed`` (_pos, _token) replaced; null changes none.

    Both are sorted together by place, the change first, and the first of a place is kept.
    """
    own = F.transform(
        tokens, lambda t, i: F.struct(i.alias("_pos"), F.lit(1).alias("_own"), t.alias("_token"))
    )
    new = F.transform(
        changed, lambda e: F.struct(e["_pos"].alias("_pos"), F.lit(0).alias("_own"), e["_token"].alias("_token"))
    )
    # A one-element transform binds the sorted entries, so they are computed once.
    merged = F.transform(
        F.array(F.array_sort(F.concat(own, new))),
        lambda all_: F.transform(
            F.filter(all_, lambda e, i: (i == 0) | (F.get(all_, i - 1)["_pos"] != e["_pos"])),
            lambda e: e["_token"],
        ),
    )
    return F.when(changed.isNull(), tokens).otherwise(F.get(merged, F.lit(0)))


_LEMMAS = "lemmas"


class _NormalizerWriter(DefaultParamsWriter):
    """Parameters, and the lemma table beside them."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        if self.instance.lemmas is not None:
            self.instance.lemmas.select("surface", "lemma").write.parquet(f"{path}/{_LEMMAS}")


class _NormalizerReader(DefaultParamsReader):
    def load(self, path: str) -> TextNormalizer:
        stage_ = super().load(path)
        if stage_.getOrDefault(stage_.hasLemmas):
            stage_.lemmas = self.sparkSession.read.schema("surface string, lemma string").parquet(
                f"{path}/{_LEMMAS}"
            )
        return stage_


class TextNormalizer(
    Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable
):
    """`normalize_text` as a stage, so saved models take raw text.

    A lemma table (surface, lemma) is written and read with the stage. A stage with
    lemmas writes its rows to the shared folder when it transforms.
    """

    stop = Param(
        Params._dummy(), "stop", "tokens to drop", TypeConverters.toListString
    )
    hasLemmas = Param(
        Params._dummy(), "hasLemmas", "whether a lemma table belongs to the stage", TypeConverters.toBoolean
    )
    lemmas: DataFrame | None = None

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, stop=None, lemmas=None):
        super().__init__()
        self._setDefault(stop=list(STOP_WORDS), hasLemmas=False)
        given = {k: v for k, v in self._input_kwargs.items() if v is not None and k != _LEMMAS}
        self._set(hasLemmas=lemmas is not None, **given)
        self.lemmas = lemmas

    def write(self) -> _NormalizerWriter:
        return _NormalizerWriter(self)

    @classmethod
    def read(cls) -> _NormalizerReader:
        return _NormalizerReader(cls)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return normalize_text(
            dataset, self.getInputCol(), self.getOutputCol(), self.lemmas, self.getOrDefault(self.stop)
        )
