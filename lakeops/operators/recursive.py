"""Recursive queries: rows that follow from rows, until nothing new comes, and chains followed to their end.

Every round is written to the shared folder and read again, so the plan does not grow with the rounds and a lost
executor costs one round. A round's files go when no later round reads them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lakeops.operators.names import column, fresh_names
from lakeops.operators.ordering import join_null_safe
from lakeops.session import discard, materialize


def fixpoint(base: DataFrame, step: Callable[[DataFrame], DataFrame], most_rounds: int | None = None) -> DataFrame:
    """All distinct rows of ``base`` and those that ``step`` makes of rows, again and again until it makes no new ones.

    ``step`` gets the rows that the round before found for the first time and must be a union over them: what it makes
    of all of them together is what it makes of each. A row that is known already is not followed again, so cycles
    end. That is only certain if ``step`` cannot make new values forever; ``most_rounds`` raises an error beyond it.
    NULL equals NULL. The columns are those of ``base``; ``step`` must give the same names and types.
    """
    columns = base.columns
    quoted = [column(c) for c in columns]
    found = [materialize(base.select(*quoted).distinct())]
    fresh, rounds = found[0], 0
    while not fresh.isEmpty():
        if most_rounds is not None and rounds == most_rounds:
            raise ValueError(f"new rows after {most_rounds} rounds")
        made = step(fresh)
        if dict(made.dtypes) != dict(base.dtypes):
            raise ValueError(f"a step gives {made.dtypes} instead of {base.dtypes}")
        made = made.select(*quoted).distinct()
        # Earlier rounds are parts of one table, which one join leaves out.
        known = reduce(DataFrame.unionByName, found)
        fresh = materialize(join_null_safe(made, known, columns, "left_anti"))
        found.append(fresh)
        rounds += 1
    if len(found) > 1:
        discard(found.pop())
    if len(found) == 1:
        return found[0]
    whole = materialize(reduce(DataFrame.unionByName, found))
    discard(*found)
    return whole


def follow_links(links: DataFrame, node: str, next_node: str) -> DataFrame:
    """The end of each node's chain: columns ``node``, ``root``, ``steps`` and ``cyclic``.

    ``links`` names one following node per node, NULL at an end; a node that is not listed itself is an end too. Each
    round doubles the steps that are known, so a chain of n links takes log n rounds, however long the longest is. A
    node whose chain runs into a cycle never ends: its root and steps are NULL and ``cyclic`` is TRUE. Rows with a NULL
    node are left out; a node listed twice with different followers raises an error.
    """
    at, to, steps, least, most = fresh_names(links, "_at", "_to", "_steps", "_least", "_most")
    grouped = links.filter(F.col(column(node)).isNotNull()).groupBy(F.col(column(node)).alias(at)).agg(
        F.min(column(next_node)).alias(least), F.max(column(next_node)).alias(most),
        F.count_if(F.col(column(next_node)).isNull()).alias(steps), F.count(F.lit(1)).alias(to))
    several = (F.col(least) < F.col(most)) | ((F.col(steps) > 0) & F.col(least).isNotNull())
    clash = F.raise_error(F.lit("a node is followed by several")).cast("boolean")
    single = grouped.filter(F.when(several, clash).otherwise(F.lit(True)))
    kind = links.schema[node].dataType
    # Ends stand for themselves at 0 steps, so that a jump from an end stays there.
    state = materialize(single.select(at, F.coalesce(F.col(least).cast(kind), F.col(at)).alias(to),
                                      F.when(F.col(least).isNull(), 0).otherwise(1).cast("long").alias(steps)))
    total, rounds = state.count(), 0
    while True:
        ahead = state.select(F.col(at).alias(f"{at}_2"), F.col(to).alias(f"{to}_2"), F.col(steps).alias(f"{steps}_2"))
        jumped = state.join(ahead, F.col(to) == F.col(f"{at}_2"), "left").select(
            at, F.coalesce(f"{to}_2", to).alias(to), (F.col(steps) + F.coalesce(f"{steps}_2", F.lit(0))).alias(steps),
            # An end is met, or a node that is not listed.
            (F.coalesce(f"{steps}_2", F.lit(0)) > 0).alias("moved"))
        later = materialize(jumped)
        moved = later.filter("moved").count()
        discard(state)
        state, rounds = later, rounds + 1
        # Who moved had more than half the steps of this round behind it: as many as there are nodes make a cycle.
        if moved == 0 or 2 ** (rounds - 1) >= total:
            break
    return state.select(
        F.col(at).alias(node), F.when(~F.col("moved"), F.col(to)).alias("root"),
        F.when(~F.col("moved"), F.col(steps)).alias("steps"), F.col("moved").alias("cyclic"))
