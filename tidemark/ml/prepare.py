"""From a training frame to scaled model inputs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Transformer
from pyspark.ml.feature import SQLTransformer, StringIndexer, StringIndexerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed_point
from tidemark.operators.series import Hot, forward_fill
from tidemark.operators.shape import numeric_columns

LABEL = "label_24h"

# Columns that are never model inputs.
EXCLUDED = (
    "city", "recorded_at", "recorded_date", "weather_condition",
    "label_24h", "label_6h", "label_12h",
)


def usable(frame: DataFrame) -> DataFrame:
    """Rows with a current value and a label."""
    return frame.dropna(subset=["temperature", LABEL])


def known_category(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("Unknown"))


def fit_encoder(frame: DataFrame, column: str = "weather_condition") -> StringIndexerModel:
    """Alphabetical codes of a category, null as 'Unknown'; unseen values get one more code."""
    indexer = StringIndexer(
        inputCol="_category",
        outputCol="condition_encoded",
        stringOrderType="alphabetAsc",
        handleInvalid="keep",
    )
    return indexer.fit(frame.select(known_category(column).alias("_category")))


def encode(
    frame: DataFrame, encoder: StringIndexerModel, column: str = "weather_condition"
) -> DataFrame:
    with_category = frame.withColumn("_category", known_category(column))
    return encoder.transform(with_category).drop("_category")


def category_stages(encoder: StringIndexerModel) -> list[Transformer]:
    """The encoding as stages of a saved model, for rows with ``weather_condition`` (null is
    'Unknown') and ``condition_given``, a code that goes before it if there is one."""
    indexer = StringIndexerModel.from_labels(
        list(encoder.labels), inputCol="_category", outputCol="_code", handleInvalid="keep"
    )
    return [
        SQLTransformer(statement="SELECT *, coalesce(weather_condition, 'Unknown') AS _category FROM __THIS__"),
        indexer,
        SQLTransformer(
            statement="SELECT * EXCEPT (condition_encoded, _category, _code),"
            " coalesce(condition_given, _code) AS condition_encoded FROM __THIS__"
        ),
    ]


def engineer(
    frame: DataFrame, encoder: StringIndexerModel, order: Sequence[str], hot: Hot = "count"
) -> DataFrame:
    """Drop unusable rows, encode the category, fill gaps forward per entity, then with 0."""
    coded = encode(usable(frame), encoder)
    gaps = numeric_columns(coded, ["city", "condition_encoded"])
    return forward_fill(coded, ["city"], order, gaps, hot=hot)


def input_columns(frame: DataFrame, target: str = LABEL) -> list[str]:
    return numeric_columns(frame, [*EXCLUDED, target])


def in_training(keys: Sequence[str], share: float = 0.8, seed: int = 42) -> Column:
    """True for about ``share`` of the keys.

    The side depends on the text of the key alone: the same under any partitioning, after any
    retry and in any engine that knows MD5, which a random split is not.
    """
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 1000 < int(share * 1000)


@dataclass(frozen=True)
class Scaling:
    """Mean and population deviation per column, fitted on training rows."""

    mean: Mapping[str, float]
    deviation: Mapping[str, float]

    def column(self, name: str) -> Column:
        return (F.col(name) - F.lit(self.mean[name])) / F.lit(self.deviation[name])

    def transformer(self) -> SQLTransformer:
        """The scaling as a pipeline stage, so that it is saved with the model."""
        scaled = ", ".join(
            f"(`{c}` - {self.mean[c]!r}D) / {self.deviation[c]!r}D AS `scaled_{c}`"
            for c in self.mean
        )
        return SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__")


def fit_scaling(
    frame: DataFrame, columns: Sequence[str], digits: Mapping[str, int] | None = None
) -> Scaling:
    """One aggregate row comes back to the driver. A constant column keeps deviation 1."""
    digits = digits or {}
    aggregates = []
    for c in columns:
        if c in digits:
            unit = fixed_point.units(c, digits[c]).cast("decimal(19,0)")
            aggregates += [
                F.count(c).alias(f"n_{c}"),
                F.sum(unit).alias(f"s_{c}"),
                F.sum(unit * unit).alias(f"q_{c}"),
            ]
        else:
            aggregates += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"d_{c}")]
    row = frame.agg(*aggregates).first()
    mean, deviation = {}, {}
    for c in columns:
        if c in digits:
            n, total, squares = row[f"n_{c}"], int(row[f"s_{c}"]), int(row[f"q_{c}"])
            mean[c] = total / n / 10 ** digits[c]
            deviation[c] = ((n * squares - total * total) / (n * n)) ** 0.5 / 10 ** digits[c]
        else:
            mean[c], deviation[c] = row[f"m_{c}"], row[f"d_{c}"]
        deviation[c] = deviation[c] or 1.0
    return Scaling(mean, deviation)
