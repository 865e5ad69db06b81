"""Batch scoring of forecast requests."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import attach
from tidemark.operators.quality import Rule

# The last resort for a feature, and the reading that comes before it.
DEFAULTS: dict[str, float] = {
    "temp_lag_1h": 20.0,
    "temp_lag_3h": 20.0,
    "temp_lag_6h": 20.0,
    "temp_lag_24h": 20.0,
    "temp_24h_ma": 20.0,
    "temp_168h_ma": 20.0,
    "humid_lag_1h": 60.0,
    "humid_24h_ma": 60.0,
    "temp_24h_std": 2.0,
    "condition_encoded": 0,
}
READINGS: dict[str, str] = {
    "temp_lag_1h": "temperature",
    "temp_lag_3h": "temperature",
    "temp_lag_6h": "temperature",
    "temp_lag_24h": "temperature",
    "temp_24h_ma": "temperature",
    "temp_168h_ma": "temperature",
    "humid_lag_1h": "humidity",
    "humid_24h_ma": "humidity",
}

# Band and fallback rule.
Z_95 = 1.96
ERROR_SHARE = 0.15
FALLBACK_STEP = 0.5
FALLBACK_BAND = 2.0
ROW_EPSILON = 1e-8


def request_rules() -> list[Rule]:
    """Accepted request values; the required ones must be present."""
    required = ("temperature", "humidity", "pressure", "wind_speed", "hour", "day_of_week", "month")
    ranges = {"hour": (0, 23), "day_of_week": (1, 7), "month": (1, 12)}
    return [Rule(f"{c} is missing", F.col(c).isNull()) for c in required] + [
        Rule(f"{c} out of range", ~F.col(c).between(*bounds)) for c, bounds in ranges.items()
    ]


def split_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted requests, and rejected ones with the names of the rules they break."""
    broken = F.filter(
        F.array(*[F.when(rule.violation, F.lit(rule.name)) for rule in request_rules()]), lambda name: name.isNotNull()
    )
    judged = requests.withColumn("rejected_by", broken)
    accepted = judged.filter(F.size("rejected_by") == 0).drop("rejected_by")
    return accepted, judged.filter(F.size("rejected_by") > 0)


def with_category(requests: DataFrame, latest: DataFrame | None, entity: str = "city") -> DataFrame:
    """``with_defaults`` for a model that encodes the category itself.

    ``weather_condition`` is the request's or the latest stored one; ``condition_given`` is
    the request's code, or the constant where neither code nor category is known.
    """
    has = set(requests.columns)
    code = F.col("condition_encoded").cast("double") if "condition_encoded" in has else F.lit(None).cast("double")
    filled = with_defaults(requests.withColumn("condition_given", code), latest, entity, carry=("condition",))
    named = [F.col(c) for c in ("weather_condition",) if c in has]
    named += [F.col("_stored_condition")] if "_stored_condition" in filled.columns else []
    category = F.coalesce(*named) if named else F.lit(None).cast("string")
    unknown = F.when(F.col("weather_condition").isNull(), F.lit(float(DEFAULTS["condition_encoded"])))
    return (
        filled.withColumn("weather_condition", category)
        .withColumn("condition_given", F.coalesce("condition_given", unknown))
        .drop("_stored_condition")
    )


def with_defaults(
    requests: DataFrame, latest: DataFrame | None, entity: str = "city", carry: Sequence[str] = ()
) -> DataFrame:
    """Fill each optional feature: request, latest stored feature, current reading, constant.

    Other stored columns to ``carry`` along are named ``_stored_…``.
    """
    names = list(DEFAULTS)
    present = set(requests.columns)
    stored = [n for n in [*names, *carry] if latest is not None and n in latest.columns]
    joined = requests
    if stored:
        joined = attach(
            requests, latest.select(entity, *[F.col(n).alias(f"_stored_{n}") for n in stored]), entity
        )

    def chain(name: str) -> Column:
        options = []
        if name in present:
            options.append(F.col(name))
        if name in stored:
            options.append(F.col(f"_stored_{name}"))
        if name in READINGS:
            options.append(F.col(READINGS[name]))
        kind = "int" if isinstance(DEFAULTS[name], int) else "double"
        return F.coalesce(*options, F.lit(DEFAULTS[name])).cast(kind)

    filled = joined.withColumns({n: chain(n) for n in names})
    return filled.drop(*[f"_stored_{n}" for n in stored if n not in carry])


def with_band(
    scored: DataFrame, prediction: str = "prediction", current: str = "temperature"
) -> DataFrame:
    """Forecast with a 95 % band of fifteen percent of the predicted change."""
    p = F.col(prediction)
    width = F.lit(Z_95) * (F.abs(p - F.col(current)) * F.lit(ERROR_SHARE))
    return scored.withColumns(
        {
            "predicted_temperature_24h": F.round(p, 2),
            "confidence_lower": F.round(p - width, 2),
            "confidence_upper": F.round(p + width, 2),
        }
    )


def fallback(requests: DataFrame) -> DataFrame:
    """The rule used while no model is in production."""
    step = F.when(F.col("hour") > 12, F.lit(FALLBACK_STEP)).otherwise(F.lit(-FALLBACK_STEP))
    p = F.col("temperature") + step
    return requests.withColumns(
        {
            "predicted_temperature_24h": F.round(p, 2),
            "confidence_lower": F.round(p - F.lit(FALLBACK_BAND), 2),
            "confidence_upper": F.round(p + F.lit(FALLBACK_BAND), 2),
            "model_version": F.lit("fallback"),
        }
    )


def row_scaled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scale each row by its own mean and population deviation (no fitted scaler)."""
    values = [F.col(c).cast("double") for c in columns]
    n = F.lit(float(len(values)))
    add = lambda items: reduce(lambda a, b: a + b, items)
    centred = df.withColumn("_mean", add(values) / n)
    squares = [(v - F.col("_mean")) * (v - F.col("_mean")) for v in values]
    spread = centred.withColumn("_std", F.sqrt(add(squares) / n) + F.lit(ROW_EPSILON))
    return spread.withColumns(
        {f"scaled_{c}": (v - F.col("_mean")) / F.col("_std") for c, v in zip(columns, values)}
    ).drop("_mean", "_std")


def score(
    requests: DataFrame,
    latest: DataFrame | None,
    model: PipelineModel | None,
    version: str = "",
) -> DataFrame:
    """Forecast a whole table of requests."""
    if model is None:
        out = fallback(requests)
    else:
        scored = model.transform(with_category(requests, latest))
        out = with_band(scored).withColumn("model_version", F.lit(version))
    return out.withColumn("timestamp", F.current_timestamp())
