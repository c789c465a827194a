"""Differences between a target and a new source, and the rows they lead to.

`classify` compares both sides in one join. Upsert, delete and all counts are read from
its result, so a sync needs no second pass over either side.
"""

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from flowatlas.functions import differs, pack_columns, text_columns, unpack_columns
from flowatlas.operators.quality import require_keys

ACTION = "change_action"
INSERT, UPDATE, DELETE, SAME = "insert", "update", "delete", "same"
# A source row that cannot be stored as a key of it is NULL; only counted.
NULL_KEY = "null_key"
# Private column: how many source rows have a key, see `keys_counted`.
KEY_ROWS = "_key_rows"
# Columns that are stamped per run say nothing about a change.
STAMPED = ("CreatedDate",)


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def null_keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that cannot be matched because a key column is NULL."""
    return df.filter(_any_null(require_keys(keys)))


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a value in every key column."""
    return df.filter(~_any_null(keys))


def keys_counted(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each key, any of those that have it, with their number in `KEY_ROWS`.

    Rows of a key are reduced in each task before they move; the keys stay partitioned and
    sorted for a join by them. NULLs count as equal.
    """
    keys = require_keys(keys)
    if KEY_ROWS in df.columns:
        raise ValueError(f"the name {KEY_ROWS} is taken for the number of rows of a key")
    rest = [c for c in df.columns if c not in keys]
    first = F.first(F.struct(*rest)) if rest else F.first(F.lit(None))
    found = df.groupBy(*keys).agg(first.alias("_row"), F.count("*").alias(KEY_ROWS))
    return found.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns], KEY_ROWS)


def repeated_key(keys: Sequence[str]) -> Column:
    """Aggregate over rows with `KEY_ROWS`: the keys of one that repeats as JSON, or NULL."""
    return F.max(F.when(F.col(KEY_ROWS) > 1, F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})))


def changed(
    old: str,
    new: str,
    columns: Sequence[str],
    ignore_columns: Sequence[str] = STAMPED,
    null_safe: bool = True,
) -> Column:
    """True when any compared column differs between two struct columns."""
    compared = [c for c in columns if c not in ignore_columns]
    flags = [differs(F.col(old)[c], F.col(new)[c], null_safe) for c in compared]
    return reduce(or_, flags) if flags else F.lit(False)


def classify(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    ignore_columns: Sequence[str] = STAMPED,
    null_safe: bool = True,
    delete_missing: bool = True,
    delete_scope: DataFrame | None = None,
) -> DataFrame:
    """Every row of either side with its `change_action`.

    insert  only in the source
    update  in both, and a compared column differs: new values, old ignored columns
    same    in both without a difference, or kept: the old row
    delete  only in the target: the old row

    Keys must be unique on both sides. Rows with a NULL key match nothing: those of the
    source are left out (see `null_keyed`), those of the target are deleted; neither
    enters the join, where they would meet in one task.

    The result has the target's columns, then those only the source has. A stored column
    that the source lacks keeps its values, and is NULL in inserted rows; one that is new in
    the source is NULL in kept rows. A column whose type differs is refused.

    With `delete_missing=False` nothing is deleted. With `delete_scope`, a DataFrame
    over some of the target's columns, only target rows found in it are; a source that
    is a part of the whole says nothing about the rest.

    A source from `keys_counted` brings its counts to the result. Its rows with a NULL key then
    come through as `null_key`, one for each key, so that whoever reads the result sees them all.
    """
    keys = require_keys(keys)
    counted = KEY_ROWS in source.columns
    full_source, source = source, source.drop(KEY_ROWS)
    require_same_types(target, source)
    columns = [*target.columns, *(c for c in source.columns if c not in target.columns)]
    old_values = [c for c in columns if c not in keys] or keys
    new_values = [c for c in source.columns if c not in keys] or keys
    old_only = _delete_action(delete_missing, delete_scope)
    target = with_columns_of(target, source)
    if delete_scope is not None:
        in_scope = delete_scope.distinct().withColumn("_in_scope", F.lit(True))
        target = target.join(in_scope, delete_scope.columns, "left")
        scope_flag = ["_in_scope"]
    else:
        scope_flag = []
    old = with_keys(target, keys).select(*keys, F.struct(*old_values).alias("old"), *scope_flag)
    if counted:
        new = full_source.select(*keys, F.struct(*new_values).alias("new"), KEY_ROWS)
    else:
        new = with_keys(source, keys).select(*keys, F.struct(*new_values).alias("new"))
    both = old.join(new, keys, "full_outer")
    rows = decided(both, columns, keys, new_values, old_only, ignore_columns, null_safe, counted)
    unmatched = null_keyed(target, keys).select(*columns, old_only.alias(ACTION))
    return rows.unionByName(unmatched, allowMissingColumns=counted)


def decided(
    both: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    new_values: Sequence[str],
    old_only: Column,
    ignore_columns: Sequence[str],
    null_safe: bool,
    counted: bool = False,
) -> DataFrame:
    """Rows of keys with an `old` and a `new` struct as table columns with their change."""
    unusable = _any_null(keys) if counted else F.lit(False)
    action = (
        F.when(unusable, F.lit(NULL_KEY))
        .when(F.col("old").isNull(), F.lit(INSERT))
        .when(F.col("new").isNull(), old_only)
        .when(changed("old", "new", new_values, ignore_columns, null_safe), F.lit(UPDATE))
        .otherwise(F.lit(SAME))
    )

    def value(column: str) -> Column:
        if column not in new_values:
            return F.col("old")[column].alias(column)
        first, second = ("old", "new") if column in ignore_columns else ("new", "old")
        return (
            F.when(F.col(first).isNull(), F.col(second)[column])
            .otherwise(F.col(first)[column])
            .alias(column)
        )

    values = [F.col(c) if c in keys else value(c) for c in columns]
    return both.select(*values, action.alias(ACTION), *([KEY_ROWS] if counted else []))


def _delete_action(delete_missing: bool, delete_scope: DataFrame | None) -> Column:
    if not delete_missing:
        return F.lit(SAME)
    if delete_scope is None:
        return F.lit(DELETE)
    return F.when(F.col("_in_scope"), F.lit(DELETE)).otherwise(F.lit(SAME))


def apply_changes(changes: DataFrame) -> DataFrame:
    """The rows of the table after the changes."""
    return changes.filter(~F.col(ACTION).isin(DELETE, NULL_KEY)).drop(ACTION, KEY_ROWS)


def count_columns() -> list[Column]:
    """One count per kind of change, for an aggregate or an observation."""
    names = {"inserted": INSERT, "updated": UPDATE, "deleted": DELETE, "unchanged": SAME}
    return [F.count(F.when(F.col(ACTION) == a, 1)).alias(name) for name, a in names.items()]


def change_counts(changes: DataFrame) -> DataFrame:
    """One row: `inserted, updated, deleted, unchanged`."""
    return changes.agg(*count_columns())


def _distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of one side, reduced per task before they are shuffled.

    A semi or anti join cannot split its right side, so a key that many rows share must
    not arrive as many rows.
    """
    return df.select(*require_keys(keys)).distinct()


def _unmatched(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.join(_distinct_keys(right, keys), list(keys), "left_anti")


def count_inserted(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of source rows whose key the target does not hold."""
    return _unmatched(source, target, keys).agg(F.count("*").alias("inserted"))


def count_deleted(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of target rows whose key the source does not hold."""
    return _unmatched(target, source, keys).agg(F.count("*").alias("deleted"))


def keep_present(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target without the rows whose key the source does not hold."""
    kept = target.join(_distinct_keys(source, keys), list(keys), "left_semi")
    return kept.select(*target.columns)


def rows_changed(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of `left` that `right` does not hold, NULLs being equal.

    The set difference as one aggregate over both sides: equal rows are reduced before
    the shuffle, and each side is shuffled once, where EXCEPT joins and then aggregates.
    """
    columns = left.columns
    tagged = left.withColumn("_left", F.lit(True)).unionByName(
        right.select(*columns).withColumn("_left", F.lit(False))
    )
    only_left = tagged.groupBy(*columns).agg(F.min("_left").alias("_left"))
    return only_left.filter("_left").drop("_left")


def column_changes(
    before: DataFrame, after: DataFrame, keys: Sequence[str], ignore_columns: Sequence[str] = STAMPED
) -> DataFrame:
    """Keys of the rows in which two states differ, with `change_action` and `changed_columns`.

    The columns that differ are named in the order of the later state, for updates only. Keys
    must be unique in each state; rows with a NULL key are left out. NULLs count as equal, and
    a column that one state lacks is NULL there. One shuffle for each side, with texts packed.
    """
    keys = require_keys(keys)
    require_same_types(before, after)
    before, after = with_columns_of(before, after), with_columns_of(after, before)
    texts = text_columns(after)
    before, after = pack_columns(before, texts), pack_columns(after, texts)
    values = [c for c in after.columns if c not in keys]
    sides = [
        with_keys(state, keys).select(*keys, F.struct(F.lit(True).alias("_there"), *values).alias(name))
        for name, state in (("_before", before), ("_after", after))
    ]
    both = sides[0].join(sides[1], keys, "full_outer")
    old, new = F.col("_before"), F.col("_after")
    named = [F.when(differs(old[c], new[c], True), F.lit(c)) for c in values if c not in ignore_columns]
    names = F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")
    action = F.when(old.isNull(), F.lit(INSERT)).when(new.isNull(), F.lit(DELETE)).otherwise(F.lit(UPDATE))
    found = both.select(*keys, action.alias(ACTION), F.when(old.isNotNull() & new.isNotNull(), names).alias("changed_columns"))
    found = found.filter(F.col("changed_columns").isNull() | (F.size("changed_columns") > 0))
    return unpack_columns(found, [c for c in keys if c in texts])


def append_rows(target: DataFrame, source: DataFrame) -> DataFrame:
    """All rows of both; a column that one side lacks is NULL there."""
    require_same_types(target, source)
    return with_columns_of(target, source).unionByName(source, allowMissingColumns=True)


def require_same_types(target: DataFrame, source: DataFrame) -> None:
    """Raise if a column that both have changes its type."""
    stored = dict(target.dtypes)
    for name, kind in source.dtypes:
        if stored.get(name, kind) != kind:
            raise ValueError(f"column {name} is {stored[name]} in the table and {kind} in the source")


def with_columns_of(target: DataFrame, source: DataFrame) -> DataFrame:
    """The target with NULLs for the columns only the source has."""
    missing = [f for f in source.schema if f.name not in target.columns]
    return target.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else target
