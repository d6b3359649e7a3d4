"""Update, delete, merge and schema change as functions from one table state to the next.

Pair them with tallyforge.sources.states, which keeps states side by side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyforge.operators.skew import hot_keys, is_small, salted_join


def update_where(df: DataFrame, condition: Column, changes: Mapping[str, Column]) -> DataFrame:
    """Set columns where `condition` holds; a NULL condition leaves the row as it is."""
    return df.withColumns(
        {name: F.when(condition, value).otherwise(F.col(name)) for name, value in changes.items()}
    )


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Drop the rows where `condition` holds; a NULL condition keeps the row."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def _unique_source(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Columns keys + _source, one row per key. Fails the query when a key occurs twice."""
    rows = source.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.any_value(F.struct(*source.columns)).alias("_source")
    )
    repeated = F.raise_error(
        F.concat(F.lit("merge source repeats the key "), F.to_json(F.struct(*keys)))
    )
    # The check is part of the used column, so the optimizer cannot drop it.
    return rows.select(*keys, F.when(F.col("_n") > 1, repeated.cast(rows.schema["_source"].dataType))
                       .otherwise(F.col("_source")).alias("_source"))


def _taken(target: DataFrame, column: str, update: Sequence[str]) -> Column:
    """A column of a target row after the merge."""
    if column not in update:
        return F.col(column)
    given = F.col("_source").getField(column).cast(target.schema[column].dataType)
    return F.when(F.col("_source").isNotNull(), given).otherwise(F.col(column)).alias(column)


def _merged_at_once(target: DataFrame, unique: DataFrame, keys: Sequence[str], update: Sequence[str]) -> DataFrame:
    """Updated, untouched and new rows from one full outer join."""
    both = target.withColumn("_held", F.lit(True)).join(unique, list(keys), "full_outer")
    new = F.col("_held").isNull()
    columns = []
    for c in target.columns:
        given = F.col("_source").getField(c).cast(target.schema[c].dataType)
        columns.append(F.when(new, given).otherwise(_taken(target, c, update)).alias(c))
    return both.select(*columns)


def merge_into(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    spread_by: Sequence[str] | None = None,
    broadcast_rows: int = 100_000,
    small: bool | None = None,
    hot: Mapping[int, int] | None = None,
) -> DataFrame:
    """Update matched rows of `target`, append unmatched rows of `source`.

    `update` names the columns taken over on a match (all but the keys by
    default). Several target rows may match one source row; the source must be
    unique per key. NULL keys never match.

    A source of at most `broadcast_rows` rows is sent to the target, which then is not
    shuffled. Otherwise both meet in one full outer join, which reads the target once; if
    keys repeat a lot in the target, it is read twice instead, and these keys are spread over tasks by the
    columns in `spread_by`. Which of these holds is measured first, unless the caller knows: `small` says
    that the source can be broadcast, `hot` takes the result of `skew.hot_keys` for the target, {} if no key is.
    """
    update = [c for c in target.columns if c not in keys] if update is None else list(update)
    has_keys = F.lit(True)
    for key in keys:
        has_keys = has_keys & F.col(key).isNotNull()
    unique = _unique_source(source.filter(has_keys), keys)
    keyless = source.filter(~has_keys).select(*target.columns)
    spread_by = spread_by or target.columns
    small = is_small(source, broadcast_rows) if small is None else small
    if small:
        unique, hot = F.broadcast(unique), {}
    else:
        hot = hot_keys(target, keys) if hot is None else hot
        if not hot:
            return _merged_at_once(target, unique, keys, update).unionByName(keyless)
    matched = salted_join(target, unique, keys, spread_by, how="left", hot=hot)
    kept = matched.select(*[_taken(target, c, update) for c in target.columns])
    # Only keys that occur in the source are collected from the target.
    taken = salted_join(target, unique.select(*keys), keys, spread_by, how="left_semi", hot=hot)
    new = unique.join(taken.select(*keys).distinct(), list(keys), "left_anti").select("_source.*")
    return kept.unionByName(new.select(*target.columns)).unionByName(keyless)


def append_rows(table: DataFrame, more: DataFrame, evolve: bool = False) -> DataFrame:
    """Append; extra columns are refused unless `evolve`, then older rows read NULL there."""
    extra = [c for c in more.columns if c not in table.columns]
    if extra and not evolve:
        raise ValueError(f"columns not in the table: {extra}; pass evolve=True to add them")
    for field in table.schema.fields:
        if field.name in more.columns and more.schema[field.name].dataType != field.dataType:
            raise ValueError(f"{field.name}: {more.schema[field.name].dataType} does not fit {field.dataType}")
    return table.unionByName(more, allowMissingColumns=True)


def compare_versions(states: Mapping[str, DataFrame], value: str) -> DataFrame:
    """Rows (version, row_count, mean) for each named state."""
    parts = [
        state.agg(
            F.lit(label).alias("version"),
            F.count("*").alias("row_count"),
            F.avg(F.col(value).cast("double")).alias("mean"),
        )
        for label, state in states.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
