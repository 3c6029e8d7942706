"""What was known before each row: aggregates over an entity's earlier rows.

One exchange and one sort serve every aggregate of a call. All frames grow from
the start of the history, so the work is linear in its length:

* ``prior``   sum / count / max over all earlier rows,
* ``recent``  the last n earlier rows that satisfy a condition, read with
  ``lag .. IGNORE NULLS`` instead of a re-sorted frame per condition,
* ``before``  sum / count over rows more than n days older. A trailing window of
  n days is ``prior - before``; a sliding frame would re-add its rows each time.

A window keeps an entity in one task. Entities above ``hot_rows`` are therefore
cut into pieces of equal size along the order (range partitioning over the full
order key, frozen by writing it), each piece is processed like a short history,
and what the earlier pieces of the entity hold is carried in from one summary
row per piece. Nothing is dropped or sampled on either way.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringside.session import cut, pieces_for, setting

HOT_ROWS = 500_000
PIECE_ROWS = 250_000
MAX_HOT_KEYS = 100_000

PIECE = "__piece"


@dataclass(frozen=True)
class Agg:
    kind: str  # sum, count or max
    value: Column


def total(value: Column) -> Agg:
    return Agg("sum", value)


def number(value: Column | None = None) -> Agg:
    """Count of non-null values, or of rows."""
    return Agg("count", F.lit(1) if value is None else value)


def highest(value: Column) -> Agg:
    return Agg("max", value)


@dataclass(frozen=True)
class Recent:
    """The last ``n`` earlier rows with ``where`` true: columns <name>_1 .. <name>_n, newest first."""

    n: int
    values: dict[str, Column]
    where: Column | None = None

    def cell(self) -> Column:
        row = F.struct(*[v.alias(k) for k, v in self.values.items()])
        return row if self.where is None else F.when(self.where, row)


@dataclass
class Timeline:
    cold: DataFrame
    hot: DataFrame | None
    entity: list[str]
    order: list[str]
    day: str | None = None

    # -- building ----------------------------------------------------------

    @classmethod
    def of(cls, df, entity, order, day=None, hot_rows=None, piece_rows=None, sized_from=None) -> "Timeline":
        """Split off hot entities, if any. ``order`` must be unique within an entity.

        ``sized_from`` names a cheaper table with the same rows per entity.

        The count per entity is pre-aggregated in each map task. The list of hot
        keys is broadcast while it has at most MAX_HOT_KEYS rows; a longer one is
        joined like any other table.
        """
        spark = df.sparkSession
        hot_rows = hot_rows or setting(spark, "hotRows", HOT_ROWS)
        piece_rows = piece_rows or setting(spark, "pieceRows", PIECE_ROWS)
        sizes = (df if sized_from is None else sized_from).groupBy(*entity).agg(F.count(F.lit(1)).alias("__rows"))
        if (sizes.agg(F.max("__rows")).first()[0] or 0) <= hot_rows:
            return cls(df, None, list(entity), list(order), day)
        keys = cut(sizes.filter(F.col("__rows") > hot_rows), "hot-keys")
        many, hot_total = keys.agg(F.count(F.lit(1)), F.sum("__rows")).first()
        small = keys.drop("__rows")
        small = F.broadcast(small) if many <= MAX_HOT_KEYS else small
        same = _same(df, small, entity)
        hot = df.join(small, same, "left_semi")
        cold = df.join(small, same, "left_anti")
        hot = (
            hot.repartitionByRange(pieces_for(hot_total, piece_rows), *entity, *order)
            .withColumn(PIECE, F.spark_partition_id())
        )
        return cls(cold, cut(hot, "hot-pieces"), list(entity), list(order), day)

    @property
    def df(self) -> DataFrame:
        if self.hot is None:
            return self.cold
        return self.cold.unionByName(self.hot.drop(PIECE))

    # -- aggregates --------------------------------------------------------

    def with_known(self, prior=None, recent=None, before=None) -> "Timeline":
        """Add columns known before each row.

        prior:  {name: Agg}; recent: {name: Recent}; before: {days: {name: Agg}}
        """
        prior, recent, before = prior or {}, recent or {}, before or {}
        cold = self._known_whole(self.cold, prior, recent, before)
        hot = None
        if self.hot is not None:
            hot = cut(self._known_pieces(self.hot, prior, recent, before), "hot-known")
        return Timeline(cold, hot, self.entity, self.order, self.day)

    def _known_whole(self, df, prior, recent, before) -> DataFrame:
        cells = {f"__{name}": r.cell() for name, r in recent.items()}
        rows = df.withColumns(cells) if cells else df
        w = Window.partitionBy(*self.entity).orderBy(*self.order)
        out = {n: _over(a, w.rowsBetween(Window.unboundedPreceding, -1)) for n, a in prior.items()}
        for name, r in recent.items():
            for k in range(1, r.n + 1):
                out[f"{name}_{k}"] = _lag(f"__{name}", k, self.entity, self.order)
        rows = rows.withColumns(out) if out else rows
        rows = rows.drop(*cells)
        older = {}
        for days, aggs in before.items():
            frame = self._older_than(days, self.entity)
            older.update({n: _over(a, frame) for n, a in aggs.items()})
        return rows.withColumns(older) if older else rows

    def _older_than(self, days, keys):
        return (
            Window.partitionBy(*keys)
            .orderBy(self.day)
            .rangeBetween(Window.unboundedPreceding, -(days + 1))
        )

    def _known_pieces(self, df, prior, recent, before) -> DataFrame:
        keys = self.entity + [PIECE]
        w = Window.partitionBy(*keys).orderBy(*self.order)
        upto = w.rowsBetween(Window.unboundedPreceding, -1)
        cells = {f"__{name}": r.cell() for name, r in recent.items()}
        base = df.withColumns(cells) if cells else df

        # inside the piece
        inner = {f"__in_{n}": _over(a, upto) for n, a in prior.items()}
        for name, r in recent.items():
            inner[f"__n_{name}"] = F.count(F.col(f"__{name}")).over(upto)
            for k in range(1, r.n + 1):
                inner[f"__in_{name}_{k}"] = _lag(f"__{name}", k, keys, self.order)
        rows = base.withColumns(inner) if inner else base

        # one summary row per piece, then what earlier pieces of the entity add up to
        parts = base.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("__rows"), *[_plain(a).alias(f"__c_{n}") for n, a in prior.items()]
        )
        earlier = Window.partitionBy(*self.entity).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
        carry = parts.select(
            *keys, *[_merge(a, F.col(f"__c_{n}"), earlier).alias(f"__c_{n}") for n, a in prior.items()]
        )
        for name, r in recent.items():
            carry = _join(carry, self._tails(base, name, r, parts), keys)
        rows = _join(rows, carry, keys)

        out = {}
        for n, a in prior.items():
            out[n] = _plus(a, F.col(f"__in_{n}"), F.col(f"__c_{n}"))
        for name, r in recent.items():
            got = F.col(f"__n_{name}")
            for k in range(1, r.n + 1):
                older = [F.when(k - got == j, F.col(f"__t_{name}_{j}")) for j in range(1, k + 1)]
                out[f"{name}_{k}"] = F.coalesce(
                    F.when(got >= k, F.col(f"__in_{name}_{k}")), *older
                )
        rows = rows.withColumns(out)
        if before:
            rows = _join(rows, self._older_days(base, before), keys + [self.day])
        temp = [c for c in rows.columns if c.startswith("__") and c != PIECE]
        return rows.drop(*temp)

    def _tails(self, base, name, r, parts) -> DataFrame:
        """The last n qualifying rows before each piece; at most n rows per piece take part."""
        keys = self.entity + [PIECE]
        newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in self.order])
        cell = f"__{name}"
        tail = (
            base.filter(F.col(cell).isNotNull())
            .withColumn("__rank", F.row_number().over(newest))
            .filter(F.col("__rank") <= r.n)
            .select(*keys, F.lit(1).alias("__side"), (-F.col("__rank")).alias("__pos"), cell)
        )
        marks = parts.select(*keys, F.lit(0).alias("__side"), F.lit(0).alias("__pos"))
        marks = marks.withColumn(cell, F.lit(None).cast(tail.schema[cell].dataType))
        order = [PIECE, "__side", "__pos"]
        lags = {f"__t_{name}_{k}": _lag(cell, k, self.entity, order) for k in range(1, r.n + 1)}
        both = tail.unionByName(marks).withColumns(lags)
        return both.filter("__side = 0").select(*keys, *lags)

    def _older_days(self, base, before) -> DataFrame:
        """Sums of the days before the window, worked out on one row per entity and day."""
        named = {n: a for aggs in before.values() for n, a in aggs.items()}
        days = base.groupBy(*self.entity, self.day).agg(*[_plain(a).alias(n) for n, a in named.items()])
        out = [
            _merge(a, F.col(n), self._older_than(span, self.entity)).alias(n)
            for span, aggs in before.items()
            for n, a in aggs.items()
        ]
        sums = days.select(*self.entity, self.day, *out)
        spots = base.select(*self.entity, PIECE, self.day).distinct()
        return _join(spots, sums, self.entity + [self.day])


def _over(agg: Agg, frame) -> Column:
    return _plain(agg).over(frame)


def _plain(agg: Agg) -> Column:
    fn = {"sum": F.sum, "count": F.count, "max": F.max}[agg.kind]
    return fn(agg.value)


def _merge(agg: Agg, partial: Column, frame) -> Column:
    if agg.kind == "max":
        return F.max(partial).over(frame)
    merged = F.sum(partial).over(frame)
    return F.coalesce(merged, F.lit(0)) if agg.kind == "count" else merged


def _plus(agg: Agg, a: Column, b: Column) -> Column:
    if agg.kind == "max":
        return F.greatest(a, b)
    if agg.kind == "count":
        return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
    return F.coalesce(a + b, a, b)


def _lag(column: str, k: int, keys: list[str], order: list[str]) -> Column:
    names = lambda cols: ", ".join(f"`{c}`" for c in cols)
    return F.expr(
        f"lag(`{column}`, {k}) ignore nulls over (partition by {names(keys)} order by {names(order)})"
    )


def _same(left, right, keys) -> Column:
    cond = None
    for k in keys:
        one = left[k].eqNullSafe(right[k])
        cond = one if cond is None else cond & one
    return cond


def _join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys that may be NULL, keeping the left key columns."""
    renamed = right.withColumnsRenamed({k: f"__k_{k}" for k in keys})
    cond = None
    for k in keys:
        one = left[k].eqNullSafe(renamed[f"__k_{k}"])
        cond = one if cond is None else cond & one
    return left.join(renamed, cond, "left").drop(*[f"__k_{k}" for k in keys])
