"""Windows over ordered groups of any size.

A plain window puts each group in one task. That is the right plan for ordinary
groups (one shuffle serves any number of windows) and the wrong one for a group
that holds a large share of the table. ``OrderedGroups`` counts the rows and the
bytes of text per group first (one scan, combined before its shuffle):

* no group above a threshold: plain windows, one shuffle;
* otherwise the large groups, and only those, are cut into blocks at quantiles
  of their order key. Windows run inside ``(keys, block)``; what a row needs
  from the other blocks comes from a table with one row per block.

Sizes. A group is cut when it has more than ``hot_rows`` rows or ``hot_bytes``
of text, so a table of N rows and B bytes has at most N / hot_rows + B /
hot_bytes such groups. A block aims at half of either, whatever the size of the
group, so the tables of cut points and of block values have about twice as many
entries. The cut points only decide which task does what, never the result.
Both tables are written to the shared folder: every reader, and every retry,
sees the same ones, and their size is known when they are joined. The driver sees
one number: the largest count of blocks.

The order key is one number or time column, unique within its group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from colloquy.plans.shared import scratch_path

HOT_ROWS_SETTING = "spark.colloquy.hotGroupRows"
HOT_ROWS_DEFAULT = 200_000
HOT_BYTES_SETTING = "spark.colloquy.hotGroupBytes"
HOT_BYTES_DEFAULT = 512 << 20

_COARSE = 64  # cut points are searched 64 apart first, then 64 one by one
MOST_BLOCKS = 10_000  # of a group; above MOST_BLOCKS * hot_rows / 2 rows its blocks grow, so that a plan holds few quantiles
_BLOCK = "_block"
_HOT = "_hot"


@dataclass(frozen=True)
class Step:
    """A window value, and how it is put together when its group is cut into blocks."""

    value: Column
    local: Callable[[Column, WindowSpec], Column]  # of the value, inside one block
    block: Callable[[Column, Column], Column]  # of value and order key: one for each block
    carry: Callable[[Column, WindowSpec], Column]  # over the block values of a group
    merge: Callable[[Column, Column, Column], Column]  # (local, carry, in a cut group)
    ordered: bool = True
    wide: bool = False  # a large value, of a block's first or last row


def _whole(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _before(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def _frame(window: WindowSpec, inclusive: bool) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, 0) if inclusive else _before(window)


def total(agg: Callable, value: Column, combine: Callable | None = None) -> Step:
    """An aggregate of the whole group."""
    return Step(
        value,
        local=lambda v, window: agg(v).over(_whole(window)),
        block=lambda v, order: agg(v),
        carry=lambda v, window: (combine or agg)(v).over(_whole(window)),
        merge=lambda local, carry, hot: F.when(hot, carry).otherwise(local),
        ordered=False,
    )


def total_count() -> Step:
    return total(F.count, F.lit(1), F.sum)


def running_sum(value: Column, inclusive: bool = False) -> Step:
    """Sum over the rows before this one (0 at the start); ``inclusive`` adds this row."""
    return Step(
        value,
        local=lambda v, window: F.coalesce(F.sum(v).over(_frame(window, inclusive)), F.lit(0)),
        block=lambda v, order: F.sum(v),
        carry=lambda v, window: F.sum(v).over(_before(window)),
        merge=lambda local, carry, hot: local + F.coalesce(carry, F.lit(0)),
    )


def position() -> Step:
    """0-based position of the row in its group."""
    return running_sum(F.lit(1).cast("bigint"))


def running_max(value: Column, inclusive: bool = False) -> Step:
    return Step(
        value,
        local=lambda v, window: F.max(v).over(_frame(window, inclusive)),
        block=lambda v, order: F.max(v),
        carry=lambda v, window: F.max(v).over(_before(window)),
        merge=lambda local, carry, hot: F.greatest(local, carry),
    )


def running_last(value: Column, inclusive: bool = True) -> Step:
    """The latest value that is not null."""
    return Step(
        value,
        local=lambda v, window: F.last(v, ignorenulls=True).over(_frame(window, inclusive)),
        block=lambda v, order: F.max_by(v, F.when(v.isNotNull(), order)),
        carry=lambda v, window: F.last(v, ignorenulls=True).over(_before(window)),
        merge=lambda local, carry, hot: F.coalesce(local, carry),
    )


def previous(value: Column, wide: bool = False) -> Step:
    """``value`` (a struct, so never null) of the row before; null at the start.

    ``wide`` values, such as texts, are fetched from the edges of the blocks by a
    join; an aggregate over them would sort all texts.
    """
    return Step(
        value,
        local=lambda v, window: F.lag(v).over(window),
        block=F.max_by,
        carry=lambda v, window: F.lag(v).over(window),
        merge=lambda local, carry, hot: F.coalesce(local, carry),
        wide=wide,
    )


def following(value: Column, wide: bool = False) -> Step:
    """``value`` (a struct, so never null) of the row after; null at the end."""
    return Step(
        value,
        local=lambda v, window: F.lead(v).over(window),
        block=F.min_by,
        carry=lambda v, window: F.lead(v).over(window),
        merge=lambda local, carry, hot: F.coalesce(local, carry),
        wide=wide,
    )


def hot_threshold(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(HOT_ROWS_SETTING, str(HOT_ROWS_DEFAULT)))


def hot_bytes_threshold(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(HOT_BYTES_SETTING, str(HOT_BYTES_DEFAULT)))


def _text_bytes(df: DataFrame) -> Column:
    """Bytes of a row's texts."""
    texts = [f.name for f in df.schema if f.dataType.typeName() == "string"]
    size = F.lit(0).cast("bigint")
    for name in texts:
        size = size + F.coalesce(F.octet_length(f"`{name}`"), F.lit(0))
    return size


def _hot_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """The groups to cut, with their rows and number of blocks."""
    most_rows, most_bytes = hot_threshold(df), hot_bytes_threshold(df)
    measured = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), F.sum(_text_bytes(df.drop(*keys))).alias("_bytes")
    )
    blocks = F.greatest(
        F.ceil(F.col("_rows") / max(most_rows // 2, 1)), F.ceil(F.col("_bytes") / max(most_bytes // 2, 1))
    )
    large = measured.where((F.col("_rows") > most_rows) | (F.col("_bytes") > most_bytes))
    return large.select(*keys, "_rows", F.least(blocks, F.col("_rows"), F.lit(MOST_BLOCKS)).cast("bigint").alias("_blocks"))


def settled(small: DataFrame, name: str) -> DataFrame:
    """A small table, written once to the shared folder and read from there.

    Later steps would otherwise compute all steps before them twice, and a chain
    of them would grow as a power of two. As a file its size is known, by which
    Spark decides how to join it.
    """
    path = scratch_path(small.sparkSession, name)
    small.write.parquet(path)
    return small.sparkSession.read.schema(small.schema).parquet(path)


def attach(df: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join to a settled table; null keys match null keys.

    No hint: below ``spark.sql.autoBroadcastJoinThreshold`` Spark broadcasts the
    file, above it shuffles both sides and adaptive execution splits hot keys.
    """
    renamed = small.withColumnsRenamed({k: f"_small_{k}" for k in keys})
    match = [df[k].eqNullSafe(renamed[f"_small_{k}"]) for k in keys]
    return df.join(renamed, match, "left").drop(*[f"_small_{k}" for k in keys])


class OrderedGroups:
    """A DataFrame seen as ordered groups; add window values with ``with_columns``.

    If groups are cut, the rows of the cut groups are kept a second time on
    their own: block values come from those alone, and a total then costs an
    aggregate but no shuffle of rows.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: str,
        hot: DataFrame | None = None,
        ordered: bool = True,
    ):
        self._df = df
        self._hot = hot
        self._ordered = ordered
        self.keys = list(keys)
        self.order = order

    @classmethod
    def of(
        cls,
        df: DataFrame,
        keys: Sequence[str],
        order: str,
        ordered: bool = True,
        store: bool = False,
    ) -> OrderedGroups:
        """``ordered=False`` is enough, and cheaper, for totals alone.

        Cut groups read the rows several times; ``store`` writes them to the
        shared folder first, for rows that are dear to compute.
        """
        keys = list(keys)
        most = _hot_groups(df, keys).agg(F.max("_blocks")).first()[0]
        if most is None:
            return cls(df, keys, order, ordered=ordered)
        if store:
            df = settled(df, "rows")
        hot = settled(_hot_groups(df, keys), "hot")
        if ordered:
            known, small = F.col("_cuts"), _cut_points(df, hot, keys, order, most)
            block = _block_between(known, F.col(order))
        else:
            known, small = F.col("_blocks"), hot.drop("_rows")
            block = F.pmod(F.xxhash64(order), known)
        marked = (
            attach(df, small, keys)
            .withColumn(_HOT, known.isNotNull())
            .withColumn(_BLOCK, F.when(F.col(_HOT), block).otherwise(0).cast("int"))
            .drop("_cuts", "_blocks")
        )
        return cls(marked, keys, order, marked.where(F.col(_HOT)), ordered)

    @property
    def cut(self) -> bool:
        return self._hot is not None

    @property
    def df(self) -> DataFrame:
        """The rows, without helper columns."""
        return self._df.drop(_HOT, _BLOCK)

    @property
    def rows(self) -> DataFrame:
        """The rows, with the helper columns if groups are cut."""
        return self._df

    @property
    def hot_rows(self) -> DataFrame:
        """The rows of the cut groups alone."""
        return self._hot

    @property
    def partition(self) -> list[str]:
        """The columns the rows are partitioned by: further work on them needs no shuffle."""
        return [*self.keys, _BLOCK] if self.cut else self.keys

    @staticmethod
    def helpers(df: DataFrame) -> list[str]:
        """The helper columns of ``rows``, to be carried through a projection."""
        return [c for c in (_HOT, _BLOCK) if c in df.columns]

    @property
    def hot(self) -> Column:
        """Whether a row belongs to a group that is cut into blocks."""
        return F.col(_HOT) if self.cut else F.lit(False)

    def replace(
        self,
        change: Callable[[DataFrame], DataFrame],
        hot_change: Callable[[DataFrame], DataFrame] | None = None,
    ) -> OrderedGroups:
        """The same groups after a row-wise change of the DataFrame.

        ``hot_change`` does the same to rows of cut groups, if that is less work.
        """
        hot = (hot_change or change)(self._hot) if self.cut else None
        return OrderedGroups(change(self._df), self.keys, self.order, hot, self._ordered)

    def with_columns(self, **steps: Step) -> OrderedGroups:
        if not self._ordered and any(s.ordered for s in steps.values()):
            raise ValueError("these groups have no order, only totals")
        if not self.cut:
            return self.replace(lambda df: self._local(df, steps))
        values = self._hot.select(
            *self.partition,
            F.col(self.order).alias("_order"),
            *[s.value.alias(n) for n, s in steps.items()],
        )
        blocks = self._blocks(values, steps)
        across = Window.partitionBy(*self.keys).orderBy(_BLOCK)
        carried = settled(
            blocks.select(
                *self.partition,
                *[s.carry(F.col(n), across).alias(f"_carry_{n}") for n, s in steps.items()],
            ),
            "blocks",
        )

        def merged(df: DataFrame, hot: Column) -> DataFrame:
            return (
                attach(self._local(df, steps), carried, self.partition)
                .withColumns(
                    {n: s.merge(F.col(n), F.col(f"_carry_{n}"), hot) for n, s in steps.items()}
                )
                .drop(*[f"_carry_{n}" for n in steps])
            )

        return self.replace(lambda df: merged(df, F.col(_HOT)), lambda df: merged(df, F.lit(True)))

    def _blocks(self, values: DataFrame, steps: dict[str, Step]) -> DataFrame:
        """One row per block with the value of each step."""

        def aggregates(wide: bool) -> list[Column]:
            order = F.col("_order")
            return [s.block(F.col(n), order).alias(n) for n, s in steps.items() if s.wide == wide]

        if not any(s.wide for s in steps.values()):
            return values.groupBy(*self.partition).agg(*aggregates(False))
        edges = [F.min("_order").alias("_first"), F.max("_order").alias("_last")]
        narrow = settled(values.groupBy(*self.partition).agg(*edges, *aggregates(False)), "edges")
        at_edge = attach(values, narrow.select(*self.partition, "_first", "_last"), self.partition)
        wide = (
            at_edge.where(F.col("_order").isin(F.col("_first"), F.col("_last")))
            .groupBy(*self.partition)
            .agg(*aggregates(True))
        )
        return attach(narrow.drop("_first", "_last"), wide, self.partition)

    def _local(self, df: DataFrame, steps: dict[str, Step]) -> DataFrame:
        # Totals next to ordered steps share their window, so that Spark plans one sort for
        # all; totals alone need no order and keep whatever the rows are sorted by.
        window = Window.partitionBy(*self.partition)
        if any(s.ordered for s in steps.values()):
            window = window.orderBy(self.order)
        return df.withColumns({n: s.local(s.value, window) for n, s in steps.items()})


def _cut_points(df: DataFrame, hot: DataFrame, keys: list[str], order: str, most: int) -> DataFrame:
    """One row per large group with the order keys at which its blocks begin.

    ``most`` is the largest number of blocks of a group; quantiles are taken for
    that many, and a smaller group takes every so many of them.
    """
    rows = attach(df.select(*keys, order), hot, keys).where(F.col("_rows").isNotNull())
    count = max(2, most)
    shares = ", ".join(f"{i / count!r}D" for i in range(1, count))
    points = F.expr(f"percentile_approx(`{order}`, array({shares}), {max(10_000, count * 16)})")
    stride = F.greatest(F.lit(1), F.floor(F.lit(count) / F.col("_blocks")))
    cuts = (
        rows.groupBy(*keys)
        .agg(F.first("_blocks").alias("_blocks"), points.alias("_points"))
        .withColumn("_stride", stride)
        .select(
            *keys,
            F.array_sort(
                F.array_distinct(
                    F.filter("_points", lambda x, i: (i + 1) % F.col("_stride") == 0)
                )
            ).alias("_cuts"),
        )
    )
    return settled(cuts, "cuts")


def _block_between(cuts: Column, order: Column) -> Column:
    """How many cut points are not above the order key."""
    far = F.size(F.filter(cuts, lambda x, i: (i % _COARSE == 0) & (x <= order)))
    near = F.size(F.filter(F.slice(cuts, (far - 1) * _COARSE + 1, _COARSE), lambda x: x <= order))
    return F.when(far == 0, 0).otherwise((far - 1) * _COARSE + near)
