"""Named parameters as one-row scalars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def parameter(params: DataFrame, name: str, order_by: list[str] | None = None) -> DataFrame:
    """One row with the value of the first row named ``name``; NULL when there is none."""
    order = F.struct(*[F.col(c) for c in (order_by or sorted(params.columns))])
    first = F.min(F.struct(order.alias("o"), F.col("valor").alias("valor")))
    return params.where(F.col("nom_param") == name).agg(first.getField("valor").alias("valor"))


def as_int_list(value: Column) -> Column:
    """``"2;4"`` to ``[2, 4]``."""
    return F.transform(F.split(value, ";"), lambda part: part.try_cast("int"))


def _required(value: Column, name: str) -> Column:
    return F.coalesce(value, F.raise_error(F.lit(f"parameter {name} is missing or not numeric")))


def scalar_int(params: DataFrame, name: str, order_by: list[str] | None = None) -> Column:
    """The parameter as an integer inside other expressions; an unreadable one fails the query."""
    row = parameter(params, name, order_by).select(_required(F.col("valor").try_cast("int"), name).alias("v"))
    return row.scalar()


def scalar_int_list(params: DataFrame, name: str, order_by: list[str] | None = None) -> Column:
    numbers = as_int_list(F.col("valor"))
    readable = F.when(F.forall(numbers, lambda n: n.isNotNull()), numbers)
    row = parameter(params, name, order_by).select(
        F.coalesce(readable, F.raise_error(F.lit(f"parameter {name} is missing or not numeric"))).alias("v")
    )
    return row.scalar()
