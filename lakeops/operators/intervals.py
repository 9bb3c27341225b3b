"""Histories of changing rows: one row per key and stretch of time, with no two stretches of a key overlapping.

A history holds the key and value columns, ``valid_from``, ``valid_to`` (excluded, NULL while it lasts) and ``deleted``
(TRUE for a stretch in which the key does not exist). Merging a batch of changes gives the history that all changes
would have given at once, whatever their order of arrival.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeops.operators.names import column, fresh_name
from lakeops.operators.ordering import join_null_safe, with_neighbours

VALID_FROM, VALID_TO, DELETED = "valid_from", "valid_to", "deleted"
_OWN = (VALID_FROM, VALID_TO, DELETED)


def _col(name: str) -> Column:
    return F.col(column(name))


def _checked(state: DataFrame, changes: DataFrame, keys: list[str], at: str, extra: list[str]) -> list[str]:
    """The value columns; raise if the changes do not fit the history."""
    taken = [c for c in changes.columns if c.lower() in _OWN and c not in (at, *extra)]
    if taken:
        raise ValueError(f"column names of the history itself are taken: {taken}")
    have = {f.name: f.dataType for f in state.schema.fields}
    values = [c for c in state.columns if c not in (*keys, *_OWN)]
    given = {f.name: f.dataType for f in changes.schema.fields}
    missing = [c for c in (*keys, *values, at) if c not in given]
    wrong = [f"{c}: {have[c].simpleString()} and {given[c].simpleString()}" for c in (*keys, *values)
             if c not in missing and have[c] != given[c]]
    if at not in missing and have[VALID_FROM] != given[at]:
        wrong.append(f"{at}: {have[VALID_FROM].simpleString()} and {given[at].simpleString()}")
    unknown = [c for c in given if c not in (*keys, *values, at, *extra)]
    if missing or wrong or unknown:
        raise ValueError(f"changes do not fit the history: missing {missing}, other types {wrong}, unknown {unknown}")
    return values


def empty_history(changes: DataFrame, keys: list[str], at: str, sequence: str | None = None,
                  deleted: str | None = None) -> DataFrame:
    """A history without rows for changes of this form."""
    values = [c for c in changes.columns if c not in (*keys, at, sequence, deleted)]
    return changes.limit(0).select(
        *[_col(c) for c in (*keys, *values)], _col(at).alias(VALID_FROM), _col(at).alias(VALID_TO),
        F.lit(False).alias(DELETED))


def merge_history(state: DataFrame | None, changes: DataFrame, keys: list[str], at: str, sequence: str | None = None,
                  deleted: str | None = None, collapse: bool = False, chunks: int | None = None) -> DataFrame:
    """The history after ``changes``, each of which says what its key's values are from the time ``at`` on.

    - A key may change many times in one batch. A change that falls inside a known stretch splits it; it holds until
      the next change known, older or newer. A change at the time of a known one replaces it.
    - Of several changes of one key and time the largest ``sequence`` wins; those that also share it, or have none,
      must be equal, else the result raises an error. A NULL time is an error.
    - Where the boolean column ``deleted`` is TRUE the key ceases to exist; its values become NULL.
    - ``collapse`` drops stretches that say the same as the one before, and deletions of keys that do not exist. That
      makes the history shorter but forgets that the value was confirmed, so later arrivals in between may differ.
    - NULL keys are a key like any other. ``state`` None is an empty history.

    Rows of keys without a change pass by. The others are compared in ranges of (key, time), so a key with most of the
    changes spans many tasks. A history with gaps (``valid_to`` not met by a next row) is read as deleted in them.
    """
    keys = list(keys)
    if state is None:
        state = empty_history(changes, keys, at, sequence, deleted)
    extra = [c for c in (sequence, deleted) if c]
    values = _checked(state, changes, keys, at, extra)
    time, body, source, order = (fresh_name(state, n) for n in ("_time", "_body", "_source", "_order"))
    kind = changes.schema[sequence].dataType.simpleString() if sequence else "int"

    def event(rows: DataFrame, when: Column, gone: Column, rank: int, place: Column) -> DataFrame:
        types = {f.name: f.dataType for f in state.schema.fields}
        fields = [F.when(~gone, _col(c)).cast(types[c]).alias(f"v{i}") for i, c in enumerate(values)]
        return rows.select(*[_col(k) for k in keys], when.alias(time), F.struct(gone.alias("gone"), *fields).alias(body),
                           F.lit(rank).alias(source), place.cast(kind).alias(order))

    changed = changes.select(*[_col(k) for k in keys]).distinct()
    touched = join_null_safe(state, changed, keys, "left_semi")
    untouched = join_null_safe(state, changed, keys, "left_anti")
    none = F.lit(None)
    now = F.coalesce(_col(at), F.raise_error(F.lit(f"{at} is NULL")).cast(state.schema[VALID_FROM].dataType))
    gone = F.coalesce(_col(deleted), F.lit(False)) if deleted else F.lit(False)
    events = (event(touched, F.col(VALID_FROM), F.col(DELETED), 1, none)
              .unionByName(event(touched.filter(F.col(VALID_TO).isNotNull()), F.col(VALID_TO), F.lit(True), 0, none))
              .unionByName(event(changes, now, gone, 2, _col(sequence) if sequence else none)))

    group = [_col(k) for k in keys]
    same = F.min(F.xxhash64(body)) == F.max(F.xxhash64(body))
    clash = F.raise_error(F.lit("several changes of one key and time differ")).cast(events.schema[body].dataType)
    single = events.groupBy(*group, time, source, order).agg(F.when(same, F.any_value(body)).otherwise(clash).alias(body))
    merged = single.groupBy(*group, time).agg(F.max_by(body, F.struct(source, order)).alias(body))
    if collapse:
        before = fresh_name(merged, "_before")
        near = with_neighbours(merged, keys, [F.col(time)], previous={before: F.col(body)}, chunks=chunks)
        idle = F.when(F.col(before).isNull(), F.col(body)["gone"]).otherwise(F.col(before).eqNullSafe(F.col(body)))
        merged = near.filter(~idle).select(*merged.columns)
    ended = with_neighbours(merged, keys, [F.col(time)], following={VALID_TO: F.col(time)}, chunks=chunks)
    rows = ended.select(*group, *[F.col(body)[f"v{i}"].alias(c) for i, c in enumerate(values)],
                        F.col(time).alias(VALID_FROM), VALID_TO, F.col(body)["gone"].alias(DELETED))
    return untouched.unionByName(rows).select(*[_col(c) for c in state.columns])


def as_of(history: DataFrame, when: Column) -> DataFrame:
    """The keys that exist at a time with their values then, without the history's own columns."""
    held = (F.col(VALID_FROM) <= when) & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > when)) & ~F.col(DELETED)
    return history.filter(held).drop(*_OWN)


def current(history: DataFrame) -> DataFrame:
    """The keys that exist after all changes, with their values."""
    return history.filter(F.col(VALID_TO).isNull() & ~F.col(DELETED)).drop(*_OWN)
