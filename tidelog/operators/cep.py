"""Pattern matching over ordered rows.

``Pattern`` describes stages. ``match_pattern`` picks a plan:

* stages that each take one row, contiguous or skipping to the next match: window functions
  that look backwards from the last stage, no joins;
* stages that each take one row with every combination wanted: time-bounded joins;
* contiguous stages, some repeated or optional: rows are numbered, and stages are joined by the
  number that follows; a repeated stage lies in one run of numbers without a gap;
* running state, skipping beside repetition, mixed skip-to-any: rows are cut into overlapping
  tiles, sorted, and streamed once through the run helper. Without ``within()`` there are no tiles:
  a key is one sorted pass of one task, which holds its open runs only.

All plans return the partition columns and, per stage, the ordered array of its row ids.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions import nfa
from tidelog.functions.nfa import (
    ONE,
    ONE_OR_MORE,
    OPTIONAL,
    SKIP_ANY,
    SKIP_NEXT,
    STRICT,
    ZERO_OR_MORE,
)
from tidelog.operators.joins import interval_join
from tidelog.plans.ordered import ROWS_PER_CHUNK, KeyedOrder, micros, tiles
from tidelog.sources.scratch import scratch_dir, through

Predicate = Column | Callable


@dataclass(frozen=True)
class Stage:
    name: str
    predicates: tuple[Predicate, ...] = ()
    cardinality: str = ONE
    strategy: str = STRICT
    folds: tuple[tuple[str, Callable], ...] = ()
    within_micros: int | None = None

    @property
    def repeats(self) -> bool:
        return self.cardinality in (ZERO_OR_MORE, ONE_OR_MORE)

    @property
    def relational(self) -> bool:
        return not any(callable(p) and not isinstance(p, Column) for p in self.predicates)

    def condition(self) -> Column:
        """The column predicates of the stage, null counting as false."""
        cond = F.lit(True)
        for p in self.predicates:
            if isinstance(p, Column):
                cond = cond & p
        return F.coalesce(cond, F.lit(False))


@dataclass(frozen=True)
class Pattern:
    """Immutable builder; every call describes the stage selected last.

    ``Pattern.select("a").where(p).then("b").one_or_more().where(q).within(3600)``
    """

    stages: tuple[Stage, ...]

    @staticmethod
    def select(name: str) -> "Pattern":
        return Pattern((Stage(name),))

    def then(self, name: str) -> "Pattern":
        return replace(self, stages=(*self.stages, Stage(name)))

    def _last(self, **changes) -> "Pattern":
        return replace(self, stages=(*self.stages[:-1], replace(self.stages[-1], **changes)))

    def where(self, predicate: Predicate) -> "Pattern":
        """A boolean column, or ``fn(row, state) -> bool`` where running state is read."""
        return self._last(predicates=(*self.stages[-1].predicates, predicate))

    and_ = where

    def optional(self) -> "Pattern":
        return self._last(cardinality=OPTIONAL)

    def zero_or_more(self) -> "Pattern":
        return self._last(cardinality=ZERO_OR_MORE)

    def one_or_more(self) -> "Pattern":
        return self._last(cardinality=ONE_OR_MORE)

    def strict_contiguity(self) -> "Pattern":
        return self._last(strategy=STRICT)

    def skip_till_next_match(self) -> "Pattern":
        return self._last(strategy=SKIP_NEXT)

    def skip_till_any_match(self) -> "Pattern":
        return self._last(strategy=SKIP_ANY)

    def fold(self, state: str, fn: Callable) -> "Pattern":
        """``fn(row, current)`` gives the new value of ``state`` after a row was taken."""
        return self._last(folds=(*self.stages[-1].folds, (state, fn)))

    def within(self, seconds: float) -> "Pattern":
        """Rows up to this stage lie at most this long behind the first row, equality included.

        Stages have bounds of their own; the last stage's holds for the whole match. What ends a
        repeated stage, or passes over an optional one, lies within that stage's bound as well.
        """
        return self._last(within_micros=int(seconds * 1_000_000))

    @property
    def within_micros(self) -> int | None:
        """The longest a whole match can be."""
        return self.stages[-1].within_micros

    @property
    def bounds(self) -> tuple[int | None, ...]:
        """Per stage the smallest bound of it and the stages behind it: those rows come later."""
        found: list[int | None] = []
        for stage in reversed(self.stages):
            known = [b for b in (stage.within_micros, *found[-1:]) if b is not None]
            found.append(min(known, default=None))
        return tuple(reversed(found))

    def check(self) -> None:
        if self.stages[-1].cardinality != ONE:
            raise ValueError("the last stage must take exactly one row")
        if self.stages[0].cardinality not in (ONE, ONE_OR_MORE):
            raise ValueError("the first stage must take at least one row")
        if any(s.strategy == SKIP_ANY for s in self.stages) and self.within_micros is None:
            raise ValueError("skip-till-any needs within(): every combination is a match")


def match_pattern(
    df: DataFrame,
    pattern: Pattern,
    partition_by: Sequence[str],
    ts: str,
    row_id: str,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Matches of the pattern among rows ordered by ``(ts, row_id)`` inside ``partition_by``.

    A new match may begin on every row while others are open.
    """
    pattern.check()
    for key in partition_by:
        df = df.filter(F.col(key).isNotNull())
    stages = pattern.stages
    plain = all(s.cardinality == ONE and s.relational and not s.folds for s in stages)
    later = {s.strategy for s in stages[1:]}
    if plain and SKIP_ANY not in later:
        return _match_next(df, pattern, partition_by, ts, row_id, rows_per_chunk)
    if plain and later == {SKIP_ANY}:
        return _match_any(df, pattern, partition_by, ts, row_id)
    if _contiguous(stages):
        return _match_contiguous(df, pattern, partition_by, ts, row_id, rows_per_chunk)
    return _match_runs(df, pattern, partition_by, ts, row_id)


def _match_next(df, pattern, keys, ts, row_id, rows_per_chunk) -> DataFrame:
    """Build matches from the last stage backwards: a row of stage k points at the match that
    begins on the following row of stage k + 1."""
    stages = pattern.stages
    flags = [s.condition().alias(f"_p{i}") for i, s in enumerate(stages)]
    rows = df.select(*keys, ts, row_id, *flags)
    chain = KeyedOrder.of(rows, keys, [ts, row_id], micros(ts), rows_per_chunk)
    here = F.struct(F.array(row_id).alias("ids"), F.array(micros(ts)).alias("at"))
    chain = chain.with_column("_m", F.when(F.col(f"_p{len(stages) - 1}"), here))
    for i in range(len(stages) - 2, -1, -1):
        # A contiguous stage asks the next row, a skipping stage the next row that fits it. The
        # box tells a row without a match from no row.
        boxed = F.struct(F.col("_m").alias("m"))
        if stages[i + 1].strategy == SKIP_NEXT:
            boxed = F.when(F.col(f"_p{i + 1}"), boxed)
        chain = chain.running({"_next": ("last", boxed)}, inclusive=False, reverse=True)
        rest = F.col("_next.m")
        longer = F.struct(
            F.concat(F.array(row_id), rest["ids"]).alias("ids"),
            F.concat(F.array(micros(ts)), rest["at"]).alias("at"),
        )
        chain = chain.with_column("_m", F.when(F.col(f"_p{i}") & rest.isNotNull(), longer))
    found = chain.result().filter(F.col("_m").isNotNull())
    for i, stage in enumerate(stages):
        if stage.within_micros is not None:
            found = found.filter(F.col("_m.at")[i] - micros(ts) <= stage.within_micros)
    return found.select(
        *keys, *[F.array(F.col("_m.ids")[i]).alias(s.name) for i, s in enumerate(stages)]
    )


def _match_any(df, pattern, keys, ts, row_id) -> DataFrame:
    """Every ordered combination within the time bound, one time-tiled join per stage."""
    reach = pattern.within_micros
    found = None
    for i, stage in enumerate(pattern.stages):
        part = df.filter(stage.condition()).select(
            *keys, F.col(ts).alias(f"_t{i}"), F.col(row_id).alias(f"_id{i}")
        )
        if found is None:
            found = part
            continue
        after = F.struct(f"_t{i}", f"_id{i}") > F.struct(f"_t{i - 1}", f"_id{i - 1}")
        bound = min(reach, pattern.bounds[i])
        found = interval_join(found, part, keys, "_t0", f"_t{i}", 0, bound, extra=after)
    return found.select(
        *keys, *[F.array(f"_id{i}").alias(s.name) for i, s in enumerate(pattern.stages)]
    )


def runtime_steps(pattern: Pattern) -> list[nfa.Step]:
    """Stages as the run helper needs them: column predicates arrive evaluated in ``_p<i>``."""
    steps = []
    for i, s in enumerate(pattern.stages):
        fns = [p for p in s.predicates if not isinstance(p, Column)]

        def test(row, state, _flag=f"_p{i}", _fns=tuple(fns)) -> bool:
            return row[_flag] and all(f(row, state) for f in _fns)

        steps.append(nfa.Step(test, s.cardinality, s.strategy, s.folds, pattern.bounds[i]))
    return steps


def with_conditions(df: DataFrame, pattern: Pattern) -> DataFrame:
    """Add the column predicates of every stage, evaluated by Spark."""
    return df.select(
        "*", *[s.condition().alias(f"_p{i}") for i, s in enumerate(pattern.stages)]
    )


def match_schema(df: DataFrame, pattern: Pattern, keys: Sequence[str], row_id: str) -> str:
    kind = df.schema[row_id].dataType.simpleString()
    fixed = [f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys]
    return ", ".join(fixed + [f"`{s.name}` array<{kind}>" for s in pattern.stages])


def _contiguous(stages: Sequence[Stage]) -> bool:
    """Whether numbered rows can be joined: column predicates, no skipping, and behind a stage of
    open length one that takes a row."""
    open_ended = [s.cardinality != ONE for s in stages]
    must = [s.cardinality in (ONE, ONE_OR_MORE) for s in stages]
    return (
        all(s.relational and not s.folds for s in stages)
        and all(s.strategy == STRICT for s in stages[1:])
        and (stages[0].strategy == STRICT or not open_ended[0])
        and all(must[i + 1] for i in range(len(stages) - 1) if open_ended[i])
    )


def _match_contiguous(df, pattern, keys, ts, row_id, rows_per_chunk) -> DataFrame:
    """Rows are numbered inside their key. A stage begins at the number behind the stage before; a
    repeated one ends on a row of the same unbroken run whose next row fits the next stage."""
    stages, bounds = pattern.stages, pattern.bounds
    repeated = [i for i, s in enumerate(stages) if s.repeats]
    flags = [s.condition().alias(f"_p{i}") for i, s in enumerate(stages)]
    rows = df.select(*keys, ts, F.col(row_id).alias("_id"), *flags)
    counts = {f"_c{i}": ("count", F.when(F.col(f"_p{i}"), 1)) for i in repeated}
    chain = KeyedOrder.of(rows, keys, [ts, "_id"], micros(ts), rows_per_chunk)
    chain = chain.running({"_rn": ("count", F.lit(1)), **counts})
    following = F.struct(*[F.col(f"_p{i + 1}").alias(f"p{i + 1}") for i in repeated])
    chain = chain.running({"_next": ("last", following)}, inclusive=False, reverse=True)
    runs = [(F.col("_rn") - F.col(f"_c{i}")).alias(f"_g{i}") for i in repeated]
    closes = [F.coalesce(F.col(f"_next.p{i + 1}"), F.lit(False)).alias(f"_z{i}") for i in repeated]
    fits = reduce(lambda a, b: a | b, [F.col(f"_p{i}") for i in range(len(stages))])
    numbered = chain.result().filter(fits).select(
        *keys, "_id", "_rn", micros(ts).alias("_at"), *[f"_p{i}" for i in range(len(stages))], *runs, *closes
    )
    # Written once: every stage reads it.
    numbered = through(numbered, scratch_dir(df.sparkSession, "pattern-rows"))

    def within(found: DataFrame, at: str, bound: int | None) -> DataFrame:
        return found if bound is None else found.filter(F.col(at) - F.col("_first") <= bound)

    found = None
    for i, stage in enumerate(stages):
        here = numbered.filter(f"_p{i}").select(
            *keys, F.col("_rn").alias(f"_b{i}"), F.col("_id").alias(f"_id{i}"), F.col("_at").alias("_now"),
            *([f"_g{i}"] if stage.repeats else []),
        )
        if found is None:
            taken = here.withColumn("_first", F.col("_now"))
        else:
            taken = found.withColumn(f"_b{i}", F.col("_end") + 1).join(here, [*keys, f"_b{i}"])
            taken = within(taken, "_now", bounds[i])
            if stages[i - 1].cardinality != ONE:
                # The run was still in the stage before when it saw this row.
                limit = F.when(F.col("_still"), F.lit(bounds[i - 1]))
                taken = taken.filter(limit.isNull() | (F.col("_now") - F.col("_first") <= limit))
        if stage.repeats:
            ends = numbered.filter(F.col(f"_p{i}") & F.col(f"_z{i}")).select(
                *keys, f"_g{i}", F.col("_rn").alias("_to"), F.col("_at").alias("_until")
            )
            taken = taken.join(ends, [*keys, f"_g{i}"]).filter(F.col("_to") >= F.col(f"_b{i}"))
            taken = within(taken, "_until", bounds[i]).withColumn(f"_e{i}", F.col("_to"))
            taken = taken.withColumn("_end", F.col("_to")).drop("_to", "_until", f"_id{i}")
        else:
            taken = taken.withColumn("_end", F.col(f"_b{i}")).drop(f"_b{i}")
        taken = taken.withColumn("_still", F.lit(stage.repeats)).drop("_now")
        if stage.cardinality in (OPTIONAL, ZERO_OR_MORE):
            passed = found.withColumn("_still", F.lit(True))
            taken = taken.unionByName(passed, allowMissingColumns=True)
        found = taken
    for i in repeated:
        # A passed-over stage has no run and finds no rows.
        inside = numbered.filter(f"_p{i}").select(*keys, f"_g{i}", F.col("_rn").alias("_k"), F.col("_id").alias("_row"))
        match, row = found.alias("m"), inside.alias("r")
        same = [F.col(f"m.{c}") == F.col(f"r.{c}") for c in [*keys, f"_g{i}"]]
        between = F.col("r._k").between(F.col(f"m._b{i}"), F.col(f"m._e{i}"))
        found = (
            match.join(row, reduce(lambda a, b: a & b, [*same, between]), "left")
            .groupBy(*[F.col(f"m.{c}") for c in found.columns])
            .agg(F.sort_array(F.collect_list(F.when(F.col("_k").isNotNull(), F.struct("_k", "_row")))).alias(f"_l{i}"))
        )

    none = F.array().cast(f"array<{df.schema[row_id].dataType.simpleString()}>")

    def ids(i: int, stage: Stage) -> Column:
        if stage.repeats:
            return F.col(f"_l{i}._row")
        only = F.col(f"_id{i}")
        return F.array(only) if stage.cardinality == ONE else F.when(only.isNull(), none).otherwise(F.array(only))

    return found.select(*keys, *[ids(i, s).alias(s.name) for i, s in enumerate(stages)])


def _match_runs(df, pattern, keys, ts, row_id) -> DataFrame:
    """One sorted pass per tile. Rows are streamed in Arrow batches and only open runs are
    held, so neither a long key nor a crowded tile has to fit in memory at once."""
    reach = pattern.within_micros
    prepared = with_conditions(df, pattern).withColumn("_at", micros(ts))
    if all(s.strategy != STRICT for s in pattern.stages[1:]):
        # Without contiguity a row that fits no stage changes nothing.
        fits = [F.col(f"_p{i}") for i in range(len(pattern.stages))]
        prepared = prepared.filter(reduce(lambda a, b: a | b, fits))
    group = [*keys, "_tile"]
    if reach is None:
        cut = prepared.withColumns({"_tile": F.lit(0), "_own": F.lit(True)})
    else:
        cut = tiles(prepared, F.col("_at"), 4 * max(reach, 1), after=reach)
    cut = cut.drop(ts)
    if all(s.relational and not s.folds for s in pattern.stages):
        flags = [f"_p{i}" for i in range(len(pattern.stages))]
        cut = cut.select(*group, "_own", "_at", row_id, *flags)
    ordered = cut.repartition(*group).sortWithinPartitions(*group, "_at", row_id)
    steps, names = runtime_steps(pattern), [s.name for s in pattern.stages]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Plain Python values: a whole number beside a null stays a whole number.
        current, runs, schema = None, [], None
        for batch in batches:
            if schema is None:
                of = batch.schema.field
                kinds = [of(k) for k in keys] + [pa.field(n, pa.list_(of(row_id).type)) for n in names]
                schema = pa.schema(kinds)
            found = []
            for row in batch.to_pylist():
                at_group = tuple(row[c] for c in group)
                if at_group != current:
                    current, runs = at_group, []
                begins = row["_own"] and row["_p0"]
                if not runs and not begins:
                    continue
                runs, done = nfa.advance(steps, runs, row, row[row_id], row["_at"], begins)
                found += [
                    [*at_group[:-1], *[d.taken.get(k, []) for k in range(len(names))]]
                    for d in done
                ]
            if found:
                columns = [pa.array(list(c), f.type) for c, f in zip(zip(*found), schema)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return ordered.mapInArrow(run, match_schema(df, pattern, keys, row_id))


def sequence_rows(matches: DataFrame, pattern: Pattern, keys: Sequence[str]) -> DataFrame:
    """One row per match and stage: ``match_id, stage, events`` in ascending order.

    The match id is made of the matched rows, so it is the same in every run.
    """
    names = [s.name for s in pattern.stages]
    match_id = F.concat_ws("|", *[F.array_join(F.col(n).cast("array<string>"), " ") for n in names])
    stages = F.array(
        *[F.struct(F.lit(n).alias("stage"), F.array_sort(n).alias("events")) for n in names]
    )
    return (
        matches.select(*keys, match_id.alias("match_id"), F.explode(stages).alias("s"))
        .select(*keys, "match_id", "s.stage", "s.events")
        .filter(F.size("events") > 0)
    )


def sequence_json(matches: DataFrame, pattern: Pattern) -> DataFrame:
    """Each match as JSON text from stage to row ids."""
    return matches.withColumn("json", F.to_json(F.struct(*[s.name for s in pattern.stages])))
