"""Event plan contract.

A plan turns the enriched event batch into partial documents.  Each plan has
one or more document *kinds*; a kind is selected by a predicate over the
batch, has a write rank (its position in the plan's write order) and a column
list.  The kinds of one plan select disjoint rows, so all of them are produced
by a single projection: one scan of the batch, no union of filtered copies.
A column that a kind does not write is null in that kind's rows.

The output ("changes") has the documents' columns plus ``write_rank`` and the
hidden source position ``__src`` used by the keyed merge.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import schema
from ..catalog import PIPELINE_DIMS, PIPELINE_EVENTS, PIPELINE_TABLE
from ..functions.time import epoch_ms_to_datetime, event_time, month_part, week_part

Spec = "str | tuple[str, Column]"


@dataclass
class PlanContext:
    """Per-batch inputs besides the events: currency rates for deposits, of one snapshot
    (``rates``) or by day (``daily_rates``, which then goes first).

    ``with_present`` adds ``present``: the columns the row's document kind
    writes, for document tables merged with ``null_policy="present_wins"``.
    """
    rates: DataFrame | None = None
    daily_rates: DataFrame | None = None
    with_present: bool = False


@dataclass
class DocKind:
    name: str
    rank: int
    when: Column
    columns: list = field(default_factory=list)  # column name, or (name, Column)


def week_of(ms: str = "event_ts") -> Column:
    return week_part(event_time(ms))


def month_of(ms: str = "event_ts") -> Column:
    return month_part(event_time(ms))


def datetime_of(ms: str) -> Column:
    return epoch_ms_to_datetime(ms)


def cols(*lists, drop: Sequence[str] = (), extra: Sequence = ()) -> list:
    """Column spec list: de-duplicated names from field lists, minus ``drop``, plus ``extra``."""
    names = [n for n in schema.names(*lists) if n not in drop]
    out: list = list(names)
    for e in extra:
        name = e[0] if isinstance(e, tuple) else e
        if name in names:
            out = [x for x in out if (x[0] if isinstance(x, tuple) else x) != name]
        out.append(e)
    return out


class EventPlan:
    name: str = ""
    fields: list = []

    @property
    def events(self) -> tuple[str, ...]:
        return PIPELINE_EVENTS[self.name]

    @property
    def dims(self) -> tuple[str, ...]:
        return PIPELINE_DIMS[self.name]

    @property
    def table(self) -> tuple[str, str | None]:
        return PIPELINE_TABLE[self.name]

    def prepare(self, df: DataFrame, ctx: PlanContext) -> DataFrame:
        rows = df.where(F.col("event_name").isin(list(self.events)))
        for d in self.dims:
            hidden = f"__dim_{d}_name"
            if hidden in rows.columns:
                rows = rows.withColumn(f"{d}_name", F.col(hidden))
        return rows

    def kinds(self) -> list[DocKind]:
        raise NotImplementedError

    def projection(self) -> tuple[Column, list[Column], Column]:
        """(place of the row's kind, output columns by it as ``__kind``, written-column list) of
        the single-pass projection.

        Unresolved column expressions do not depend on the input frame, so they
        are built once per plan and reused for every batch.
        """
        from pyspark import SparkContext
        gw = id(SparkContext._gateway)
        cached = getattr(self, "_projection_cache", None)
        if cached is not None and cached[0] == gw:
            return cached[1]
        kinds = self.kinds()
        place = F.when(kinds[0].when, F.lit(0))
        for i, k in enumerate(kinds[1:], 1):
            place = place.when(k.when, F.lit(i))
        at = F.col("__kind")
        rank = F.get(F.array(*[F.lit(k.rank) for k in kinds]), at)

        order: dict[str, None] = {}
        per_kind: list[dict[str, Column]] = []
        for k in kinds:
            exprs: dict[str, Column] = {}
            for spec in k.columns:
                name, expr = (spec, F.col(spec)) if isinstance(spec, str) else spec
                exprs[name] = expr
                order.setdefault(name, None)
            per_kind.append(exprs)

        out = [rank.cast("int").alias("write_rank")]
        for name in order:
            # one branch for all kinds that write the same: the projection's code stays small
            # enough to be compiled
            having: dict[str, tuple[Column, list[int]]] = {}
            for i, e in enumerate(per_kind):
                if name in e:
                    having.setdefault(str(e[name]), (e[name], []))[1].append(i)
            (first, its), *others = having.values()
            if len(its) == len(kinds):
                out.append(first.alias(name))
                continue
            expr = F.when(at.isin(its), first)
            for e, its in others:
                expr = expr.when(at.isin(its), e)
            out.append(expr.alias(name))
        present = None
        for i, e in enumerate(per_kind):
            names = F.array(*[F.lit(n) for n in e])
            present = F.when(at == i, names) if present is None else present.when(at == i, names)
        out.append(F.col("__src"))
        self._projection_cache = (gw, (place, out, present.alias("present")))
        return place, out, present.alias("present")

    def changes(self, df: DataFrame, ctx: PlanContext | None = None, seen: Observation | None = None) -> DataFrame:
        """The rows' partial documents; ``seen`` counts them by document kind, and the rows
        that make none (``no_document``), as they are written."""
        ctx = ctx or PlanContext()
        pre = self.prepare(df, ctx)
        place, out, present = self.projection()
        if seen is not None:
            pre = pre.observe(seen, F.count_if(place.isNull()).alias("no_document"),
                              *[F.count_if(k.when).alias(k.name) for k in self.kinds()])
        batch = [F.col("__batch")] if "__batch" in pre.columns else []
        return pre.withColumn("__kind", place).where("__kind IS NOT NULL").select(*out, *([present] if ctx.with_present else []), *batch)

    def documents(self, changes: DataFrame) -> DataFrame:
        """The changes in the columns of the document table."""
        return changes


BASE_SELECT = schema.BASE_SELECT
