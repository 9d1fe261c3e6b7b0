"""Insert, update and upsert of records into a keyed table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def insert(target: DataFrame, source: DataFrame) -> DataFrame:
    return target.unionByName(source, allowMissingColumns=True)


def _unique(source: DataFrame, key: str) -> DataFrame:
    """``source`` unchanged; the query fails when a key occurs twice in it."""
    times = source.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    most = times.agg(F.max("n")).scalar()
    message = F.lit(f"key {key} is not unique in the source records")
    return source.where(F.when(most > 1, F.raise_error(message).cast("boolean")).otherwise(True))


def _named_alike(target: DataFrame, source: DataFrame, key: str) -> tuple[DataFrame, str]:
    """``source`` and the key by the names of ``target``, compared as the session compares names."""
    if target.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true":
        return source, key
    names = {c.lower(): c for c in target.columns}
    if len({c.lower() for c in source.columns}) < len(source.columns):
        raise ValueError("source columns differ only in case")
    return source.withColumnsRenamed({c: names[c.lower()] for c in source.columns if c.lower() in names}), names.get(key.lower(), key)


def update(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Rows of ``target``; where the key is in ``source`` its columns replace the old values, NULLs included."""
    source, key = _named_alike(target, source, key)
    side = _unique(source, key).withColumnsRenamed({c: f"__new_{c}" for c in source.columns}).withColumn("__hit", F.lit(True))

    def pick(name: str) -> Column:
        if name not in source.columns:
            return F.col(name)
        return F.when(F.col("__hit"), F.col(f"__new_{name}")).otherwise(F.col(name)).alias(name)

    added = [F.col(f"__new_{c}").alias(c) for c in source.columns if c not in target.columns]
    joined = target.join(side, F.col(key) == F.col(f"__new_{key}"), "left")
    return joined.select(*[pick(c) for c in target.columns], *added)


def upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """``update``, plus the rows of ``source`` whose key is new.

    A left and an anti join instead of a full outer one, because adaptive execution can split their hot partitions.
    """
    source, key = _named_alike(target, source, key)
    # both branches are checked: with an empty target nothing is left of the update branch
    new = _unique(source, key).join(target.select(key), key, "left_anti").select(*source.columns)
    return update(target, source, key).unionByName(new, allowMissingColumns=True)


def apply(target: DataFrame, source: DataFrame, operation: str, key: str = "Id") -> DataFrame:
    if operation == "insert":
        return insert(target, source)
    if operation not in ("update", "upsert"):
        raise ValueError(f"operation must be insert, update or upsert, not {operation!r}")
    return update(target, source, key) if operation == "update" else upsert(target, source, key)
