"""Type 1 merge of a source into a target, as joins and a rewrite."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostermart.operators.ordering import dense_ids

ACTION = "merge_action"
#: A side of a join with more rows is not sent through the driver, however small its files are.
SENT_ROWS = 50_000


class RepeatedSourceKeyError(ValueError):
    """The merge source holds a key more than once."""


def beside(side: DataFrame, rows: int) -> DataFrame:
    """A join's side of at most ``rows`` rows, which Spark may broadcast only if these are few.

    Spark goes by the size of files, and those of keys are small even for millions of rows.
    """
    return side.hint("merge") if rows > SENT_ROWS else side


def require_unique(source: DataFrame, keys: Sequence[str], equal_rows: bool = False) -> None:
    """Raise if a fully known key has two rows; with ``equal_rows``, two different ones.

    The usual case takes one pass over the keys alone. Whole rows are looked at
    only for keys that occur more than once.
    """
    known = source.na.drop("any", subset=list(keys))
    repeated = known.groupBy(*keys).count().where("count > 1").select(*keys)
    if repeated.isEmpty():
        return
    rows = known.join(repeated, list(keys), "left_semi")
    if equal_rows:
        rows = rows.distinct()
    hit = rows.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if hit:
        shown = ", ".join(f"{k}={hit[0][k]}" for k in keys)
        raise RepeatedSourceKeyError(f"The source repeats the key {shown}")


def _differs(columns: Sequence[str]) -> Column:
    # A comparison with null is not true, so it does not cause an update.
    unequal = [F.coalesce(F.col(f"t.{c}") != F.col(f"s.{c}"), F.lit(False)) for c in columns]
    return reduce(Column.__or__, unequal, F.lit(False))


def merge_type1(target: DataFrame | None, source: DataFrame, keys: Sequence[str], updatable: Sequence[str],
                surrogate: str, update: str = "changed", high_water: int = 0,
                order: Sequence[str] | None = None, keep_known: Sequence[str] = ()) -> DataFrame:
    """The merged table plus ``merge_action`` (INSERT, UPDATE or KEEP); no target means all new.

    ``update`` is ``changed`` (some updatable column differs), ``always`` or
    ``never``. Rows only in the target stay. New rows get surrogate keys after
    ``high_water`` in the order of ``order`` (default: the keys); existing keys
    never change. ``keep_known`` columns keep the target's value once it is set
    and the source has one too.
    """
    if update not in ("changed", "always", "never"):
        raise ValueError(f"Unknown update rule: {update}")
    fresh = source if target is None else source.join(target.select(*keys), list(keys), "left_anti")
    inserts = dense_ids(fresh, list(order or keys), surrogate, high_water).withColumn(
        ACTION, F.lit("INSERT"))
    if target is None:
        return inserts
    matched = reduce(Column.__and__, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])
    both = target.alias("t").join(source.withColumn("_hit", F.lit(True)).alias("s"), matched, "left")
    hit = F.col("s._hit").isNotNull()
    act = {"changed": hit & _differs(updatable), "always": hit, "never": F.lit(False)}[update]

    def merged(c: str) -> Column:
        if c not in updatable:
            return F.col(f"t.{c}").alias(c)
        new = F.col(f"s.{c}")
        if c in keep_known:
            new = F.when(new.isNotNull(), F.coalesce(F.col(f"t.{c}"), new))
        return F.when(act, new).otherwise(F.col(f"t.{c}")).alias(c)

    kept = both.select(*[merged(c) for c in target.columns],
                       F.when(act, "UPDATE").otherwise("KEEP").alias(ACTION))
    return kept.unionByName(inserts)


def one_row_per_key(source: DataFrame, keys: Sequence[str], partitions: int) -> tuple[DataFrame, Column]:
    """The source with equal rows made one, lying by its keys after one shuffle, and whether a key had different rows."""
    row = F.struct(*[c for c in source.columns if c not in keys])
    found = source.repartition(partitions, *keys).groupBy(*keys).agg(F.min(row).alias("_row"), F.max(row).alias("_last"))
    return found, ~F.col("_row").eqNullSafe(F.col("_last"))


def merge_by_outer_join(target: DataFrame | None, source: DataFrame, ids: DataFrame, keys: Sequence[str], updatable: Sequence[str],
                        surrogate: str, keep_known: Sequence[str] = ()) -> DataFrame:
    """``merge_type1`` with rule ``always`` as one full outer join, for sides that lie by their keys.

    The keys are known and unique on both sides; ``ids`` has the surrogate of each key that the target lacks.
    """
    source = source.join(ids, list(keys), "left")
    if target is None:
        return source.withColumn(ACTION, F.lit("INSERT"))
    matched = reduce(Column.__and__, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])
    both = target.alias("t").join(source.withColumn("_hit", F.lit(True)).alias("s"), matched, "full_outer")
    new, hit = F.col(f"t.{keys[0]}").isNull(), F.col("s._hit").isNotNull()

    def merged(c: str) -> Column:
        old, fresh = F.col(f"t.{c}"), F.col(f"s.{c}")
        if c == surrogate or c in keys:
            return F.coalesce(old, fresh).alias(c)
        if c not in updatable:
            return F.when(new, fresh).otherwise(old).alias(c)
        if c in keep_known:
            return F.when(new, fresh).when(hit & fresh.isNotNull(), F.coalesce(old, fresh)).when(hit, fresh).otherwise(old).alias(c)
        return F.when(hit, fresh).otherwise(old).alias(c)

    action = F.when(new, "INSERT").when(hit, "UPDATE").otherwise("KEEP")
    return both.select(*[merged(c) for c in target.columns], action.alias(ACTION))


def insert_absent(target: DataFrame | None, source: DataFrame, keys: Sequence[str], surrogate: str,
                  first_by: Sequence[Column] | None = None, high_water: int = 0) -> DataFrame:
    """Rows of the source whose key is not there yet, numbered; the target stays as it is.

    For a key repeated in the source the first row by ``first_by`` is kept,
    picked by a map-side aggregate.
    """
    rest = [c for c in source.columns if c not in keys]
    if rest:
        row = F.struct(*[F.col(c) for c in rest])
        by = F.struct(*(first_by or [F.col(c) for c in rest]))
        source = source.groupBy(*keys).agg(F.min_by(row, by).alias("_row")).select(*keys, "_row.*")
    else:
        source = source.select(*keys).distinct()
    if target is not None:
        source = source.join(target.select(*keys), list(keys), "left_anti")
    fresh = dense_ids(source, list(keys), surrogate, high_water)
    return fresh if target is None else target.unionByName(fresh)
