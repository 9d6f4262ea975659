"""Ordered per-key computations that survive a key holding much of the table: a segmented scan.

A window over ``key`` sends all rows of a key to one task. Instead, a fact is arranged once (``arrange``): range-partitioned by
key and order, sorted, and cut into parts of equal size, whatever the keys. ``sequence`` runs its windows inside (part, key),
so a key of any size is many parts' work, and adds what earlier and later parts of the key contribute. That comes from
``carries``: only a part's first and last key can reach beyond it, so there is one summary row per part, and a window over a
key sees at most two rows per part. Summaries are small enough to store beside the fact; a query then reads and
shuffles the fact once.

Rows that were not arranged are dealt by their key, which suits small tables.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = "_part"
PART_ROWS = 16_384
FILE_ROWS = 1_000_000
_MERGE = {"count": F.sum, "sum": F.sum, "max": F.max, "min": F.min}
_LOCAL = {"count": F.count, "sum": F.sum, "max": F.max, "min": F.min}
Look = Callable[[str], Column]


@dataclass(frozen=True)
class Steps:
    """What ``sequence`` adds to the rows of ``key`` in ``order`` (which ends in a unique column).

    ``lag``/``lead``/``first``/``last`` map new names to source columns, ``total`` to (aggregate, column). ``running`` maps a new
    name to (columns, value): sums, up to and including the row, of ``value(now, before)``, which may look at those columns of
    the row and of the row before it; before the key's first row they are NULL.
    """

    key: str
    order: tuple[str, ...]
    number: str | None = None
    lag: dict[str, str] = field(default_factory=dict)
    lead: dict[str, str] = field(default_factory=dict)
    running: dict[str, tuple[tuple[str, ...], Callable[[Look, Look], Column]]] = field(default_factory=dict)
    total: dict[str, tuple[str, str]] = field(default_factory=dict)
    first: dict[str, str] = field(default_factory=dict)
    last: dict[str, str] = field(default_factory=dict)

    @property
    def looked_at(self) -> list[str]:
        return sorted({*self.lag.values(), *(c for columns, _ in self.running.values() for c in columns)})

    @property
    def ahead(self) -> list[str]:
        return sorted(set(self.lead.values()))


def arrange(df: DataFrame, steps: Steps, path: str, part_rows: int = PART_ROWS, file_rows: int = FILE_ROWS) -> DataFrame:
    """Write ``df`` to ``path`` in order of key and time, with its part, and read it back."""
    files = max(1, math.ceil(df.count() / file_rows))
    by = [steps.key, *steps.order]
    rows = df.repartitionByRange(files, *by).sortWithinPartitions(*by)
    # The number of a row is its file's number and its place there; parts are runs of places.
    row = F.monotonically_increasing_id()
    place = F.floor(row.bitwiseAND((1 << 33) - 1) / part_rows)
    rows.withColumn(PART, F.shiftleft(F.shiftright(row, 33), 24) + place).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _null_like(column: Column) -> Column:
    return F.when(F.lit(False), column)


def _local(df: DataFrame, s: Steps) -> DataFrame:
    """Rows with everything as if their part were all there is of the key."""
    rows = df.repartition(F.col(PART)) if PART in df.columns else df.withColumn(PART, F.xxhash64(s.key))
    own = Window.partitionBy(PART, s.key)
    seq = own.orderBy(*s.order)
    whole = seq.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = seq.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    new: dict[str, Column] = {"_n": F.row_number().over(seq), "_size": F.count(F.lit(1)).over(whole)}
    new |= {f"_before_{c}": F.lag(c).over(seq) for c in s.looked_at}
    new |= {f"_after_{c}": F.lead(c).over(seq) for c in s.ahead}
    new |= {f"_total_{n}": _LOCAL[a](c).over(whole) for n, (a, c) in s.total.items()}
    new |= {f"_first_{n}": F.first(c).over(whole) for n, c in s.first.items()}
    new |= {f"_last_{n}": F.last(c).over(whole) for n, c in s.last.items()}
    rows = rows.withColumns(new)
    if s.running:
        before = lambda c: F.col(f"_before_{c}")
        rows = rows.withColumns({f"_value_{n}": value(F.col, before) for n, (_, value) in s.running.items()})
        rows = rows.withColumns(
            {f"_run_{n}": F.sum(f"_value_{n}").over(upto) for n in s.running}
            | {f"_all_{n}": F.sum(f"_value_{n}").over(whole) for n in s.running}
        )
    return rows


def _shared(arranged: DataFrame, s: Steps) -> DataFrame:
    """(part, key) of the keys that lie in several parts: at most two rows per part, its first and its last key."""
    key = F.struct(s.key)
    ends = arranged.groupBy(F.col(PART).alias("_in")).agg(F.min(key).alias("_a"), F.max(key).alias("_b"))
    ends = ends.select("_in", F.explode(F.array_distinct(F.array("_a", "_b"))).alias("_of")).select("_in", F.col(f"_of.{s.key}").alias("_of"))
    return ends.withColumn("_parts", F.count(F.lit(1)).over(Window.partitionBy("_of"))).where("_parts > 1").select("_in", "_of")


def carries(arranged: DataFrame, s: Steps) -> DataFrame:
    """One row per part that shares a key with another part: ``_carry`` lists, for its first and last key, what lies beyond.

    Only rows of keys that lie in several parts are shuffled.
    """
    rows = _local(arranged.join(F.broadcast(_shared(arranged, s)), (F.col(PART) == F.col("_in")) & F.col(s.key).eqNullSafe(F.col("_of")), "left_semi"), s)
    seen = [F.col(c) for c in sorted({*s.looked_at, *s.ahead})] or [F.lit(1).alias("one")]
    same = [*(f"_total_{n}" for n in s.total), *(f"_first_{n}" for n in s.first), *(f"_last_{n}" for n in s.last), *(f"_all_{n}" for n in s.running)]
    segments = rows.groupBy(PART, s.key).agg(
        F.max("_size").alias("_size"), F.max(F.when(F.col("_n") == 1, F.struct(*seen))).alias("_begin"),
        F.max(F.when(F.col("_n") == F.col("_size"), F.struct(*seen))).alias("_end"), *[F.max(c).alias(c) for c in same],
    )
    every = Window.partitionBy(s.key)
    seq = every.orderBy(PART)
    earlier = seq.rowsBetween(Window.unboundedPreceding, -1)
    segments = segments.withColumns(
        {"_parts": F.count(F.lit(1)).over(every), "_prev": F.lag("_end").over(seq), "_next": F.lead("_begin").over(seq)}
    ).where("_parts > 1")
    # A part's first row was valued as if nothing came before it.
    fix = {}
    for n, (_, value) in s.running.items():
        now = lambda c: F.col(f"_begin.{c}")
        true, taken = value(now, lambda c: F.col(f"_prev.{c}")), value(now, lambda c: _null_like(F.col(f"_prev.{c}")))
        shift = F.coalesce(true, F.lit(0)) - F.coalesce(taken, F.lit(0))
        fix[f"_fix_{n}"] = F.when(F.col("_prev").isNotNull(), shift).otherwise(F.lit(0))
    segments = segments.withColumns(fix) if fix else segments
    carry: dict[str, Column] = {
        "key": F.col(s.key), "rows": F.coalesce(F.sum("_size").over(earlier), F.lit(0)), "prev": F.col("_prev"), "next": F.col("_next"),
    }
    carry |= {f"total_{n}": _MERGE[a](f"_total_{n}").over(every) for n, (a, _) in s.total.items()}
    wide = seq.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry |= {f"first_{n}": F.first(f"_first_{n}").over(wide) for n in s.first}
    carry |= {f"last_{n}": F.last(f"_last_{n}").over(wide) for n in s.last}
    for n in s.running:
        # NULL where nothing was summed before and nothing is to be mended.
        carry[f"run_{n}"] = F.sum(F.col(f"_all_{n}") + F.col(f"_fix_{n}")).over(earlier)
        carry[f"fix_{n}"] = F.col(f"_fix_{n}")
    listed = segments.select(PART, *[c.alias(f"_c_{n}") for n, c in carry.items()])
    packed = F.struct(*[F.col(f"_c_{n}").alias(n) for n in carry])
    return listed.groupBy(F.col(PART).alias("_of")).agg(F.collect_list(packed).alias("_carry"))


def sequence(df: DataFrame, s: Steps, carried: DataFrame | None = None) -> DataFrame:
    """Rows of ``df`` with the columns of ``s``. For arranged rows ``carried`` is the stored result of ``carries``, or found here
    by a second read of the fact."""
    rows = _local(df, s)
    if PART in df.columns:
        rows = rows.join(carries(df, s) if carried is None else carried, F.col(PART) == F.col("_of"), "left")
        rows = rows.withColumn("_c", F.get(F.filter("_carry", lambda x: x["key"].eqNullSafe(F.col(s.key))), F.lit(0)))
        rows = _joined(rows, s)
    else:
        rows = rows.withColumns(
            {n: F.col(f"_before_{c}") for n, c in s.lag.items()} | {n: F.col(f"_after_{c}") for n, c in s.lead.items()}
            | {n: F.col(f"_run_{n}") for n in s.running} | {n: F.col(f"_total_{n}") for n in s.total}
            | {n: F.col(f"_first_{n}") for n in s.first} | {n: F.col(f"_last_{n}") for n in s.last}
            | ({s.number: F.col("_n").cast("int")} if s.number else {})
        )
    return rows.select(*[c for c in rows.columns if c not in _hidden(s)])


def _hidden(s: Steps) -> set[str]:
    made = {"_n", "_size", "_of", "_carry", "_c", PART}
    made |= {f"_before_{c}" for c in s.looked_at} | {f"_after_{c}" for c in s.ahead}
    made |= {f"_{kind}_{n}" for n in s.running for kind in ("value", "run", "all")}
    return made | {f"_total_{n}" for n in s.total} | {f"_first_{n}" for n in s.first} | {f"_last_{n}" for n in s.last}


def _joined(rows: DataFrame, s: Steps) -> DataFrame:
    """Local values corrected by what lies in other parts of the key (``_c``, NULL where the key has one part)."""
    more, zero = F.col("_c").isNotNull(), F.lit(0)
    out: dict[str, Column] = {}
    for n, c in s.lag.items():
        out[n] = F.when(more & (F.col("_n") == 1), F.col(f"_c.prev.{c}")).otherwise(F.col(f"_before_{c}"))
    for n, c in s.lead.items():
        out[n] = F.when(more & (F.col("_n") == F.col("_size")), F.col(f"_c.next.{c}")).otherwise(F.col(f"_after_{c}"))
    for n in s.running:
        here, past = F.col(f"_run_{n}"), F.col(f"_c.run_{n}")
        summed = F.coalesce(here, zero) + F.coalesce(past, zero) + F.coalesce(F.col(f"_c.fix_{n}"), zero)
        out[n] = F.when(here.isNotNull() | past.isNotNull(), summed)
    for kind, names in (("total", s.total), ("first", s.first), ("last", s.last)):
        out |= {n: F.when(more, F.col(f"_c.{kind}_{n}")).otherwise(F.col(f"_{kind}_{n}")) for n in names}
    if s.number:
        out[s.number] = (F.col("_n") + F.coalesce(F.col("_c.rows"), zero)).cast("int")
    return rows.withColumns(out)
