"""Median fill, scaling and one-hot coding as fitted pipeline stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.operators.ranking import exact_quantiles


def fit_medians(df: DataFrame, columns: Sequence[str], exact: bool = True) -> dict[str, float | None]:
    """The median of each column; the two middle values are averaged.

    ``exact=False`` returns the sketch's answer after a single pass.
    """
    if exact:
        return {c: q[0] for c, q in exact_quantiles(df, columns, [0.5]).items()}
    found = df.approxQuantile(list(columns), [0.5], 1e-4)
    return {c: q[0] if q else None for c, q in zip(columns, found)}


def _filled(column: str, median: float | None) -> Column:
    value = F.col(column).cast("double")
    return F.coalesce(F.when(~F.isnan(value), value), F.lit(median).cast("double"))


def median_impute(df: DataFrame, medians: dict[str, float | None]) -> DataFrame:
    """Every missing number replaced by its column's median."""
    return df.withColumns({c: _filled(c, m) for c, m in medians.items()})


def fit_scaling(filled: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column; a constant column keeps 1."""
    row = filled.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"std_{c}") for c in columns],
    ).first()
    return {c: (row[f"mean_{c}"] or 0.0, row[f"std_{c}"] or 1.0) for c in columns}


def standard_scale(filled: DataFrame, scaling: dict[str, tuple[float, float]]) -> DataFrame:
    """Each column centred and divided by its deviation."""
    return filled.withColumns({c: (F.col(c) - mean) / F.lit(std) for c, (mean, std) in scaling.items()})


def one_hot_stages(columns: Sequence[str]) -> list:
    """All categories kept; an unseen or missing one becomes all zeros."""
    indexed = [f"{c}_index" for c in columns]
    encoded = [f"{c}_onehot" for c in columns]
    return [
        StringIndexer(
            inputCols=list(columns), outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"
        ),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
    ]


def _scaling_stage(medians: dict, scaling: dict) -> SQLTransformer:
    # A stage of its own, so the fitted numbers are saved with the pipeline.
    columns = ", ".join(
        f"(coalesce(nanvl(double({c}), null), {_sql(medians[c])}) - {_sql(mean)}) / {_sql(std)} as {c}_scaled"
        for c, (mean, std) in scaling.items()
    )
    return SQLTransformer(statement=f"select *, {columns} from __THIS__")


def _sql(number: float | None) -> str:
    return "cast(null as double)" if number is None else f"cast({number!r} as double)"


def fit_preprocessor(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], exact_medians: bool = True
) -> PipelineModel:
    """Fill, scale, encode and assemble to ``features``."""
    medians = fit_medians(train, numeric, exact_medians)
    scaling = fit_scaling(median_impute(train, medians), numeric)
    return Pipeline(
        stages=[
            _scaling_stage(medians, scaling),
            *one_hot_stages(categorical),
            VectorAssembler(
                inputCols=[f"{c}_scaled" for c in numeric] + [f"{c}_onehot" for c in categorical],
                outputCol="features",
                handleInvalid="keep",
            ),
        ]
    ).fit(train)
