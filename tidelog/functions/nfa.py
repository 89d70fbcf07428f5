"""Advancing open pattern runs by one row.

Only patterns with repeated stages or running state need this; all others are relational plans.
Spark partitions, orders and overlaps the rows; this helper sees one row at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

ONE, OPTIONAL, ZERO_OR_MORE, ONE_OR_MORE = "one", "optional", "zero_or_more", "one_or_more"
STRICT, SKIP_NEXT, SKIP_ANY = "strict", "skip_next", "skip_any"


@dataclass(frozen=True)
class Step:
    """What a stage needs at run time; ``test(row, state)`` decides, ``folds`` update state, and a
    run in this stage ends ``bound`` behind its first row."""

    test: Callable
    cardinality: str
    strategy: str
    folds: tuple[tuple[str, Callable], ...] = ()
    bound: int | None = None

    @property
    def repeats(self) -> bool:
        return self.cardinality in (ZERO_OR_MORE, ONE_OR_MORE)


@dataclass
class Run:
    """An open match: stage, rows taken per stage, folded state, instant of its first row."""

    stage: int
    taken: dict[int, list] = field(default_factory=dict)
    state: dict = field(default_factory=dict)
    first: int | None = None

    def copy(self) -> "Run":
        taken = {k: list(v) for k, v in self.taken.items()}
        return Run(self.stage, taken, dict(self.state), self.first)

    def take(self, stage: int, row_id, at: int) -> None:
        self.taken.setdefault(stage, []).append(row_id)
        self.first = at if self.first is None else self.first


def fold(run: Run, step: Step, row) -> None:
    for name, fn in step.folds:
        run.state[name] = fn(row, run.state.get(name))


def evaluate(steps: Sequence[Step], run: Run, row, row_id, at: int) -> list[Run]:
    """The runs that ``run`` becomes by looking at ``row``; none when it dies."""
    i = run.stage
    step = steps[i]
    take = bool(step.test(row, run.state))
    begun = bool(run.taken)
    skips = begun and (
        step.strategy == SKIP_ANY or (step.strategy == SKIP_NEXT and not take)
    )
    optional = step.repeats and (step.cardinality == ZERO_OR_MORE or i in run.taken)
    out: list[Run] = []
    if not (optional or step.cardinality == OPTIONAL):
        # A mandatory row. A repeating stage stays open after it, any other moves on.
        if skips:
            out.append(run)
        if take:
            moved = run.copy()
            moved.take(i, row_id, at)
            moved.stage = i if step.repeats else i + 1
            fold(moved, step, row)
            out.append(moved)
        return out
    follows = bool(steps[i + 1].test(row, run.state))
    proceed = follows or (not take and not skips)
    passed: list[Run] = []
    if proceed:
        ahead = run.copy()
        ahead.stage = i + 1
        passed = evaluate(steps, ahead, row, row_id, at)
        out.extend(passed)
    if take:
        stays = run.copy()
        stays.take(i, row_id, at)
        if not step.repeats:
            stays.stage = i + 1
        if passed:
            # The row fits here and in the next stage. The run that stays keeps the state from
            # before this stage's update; the one that moved on receives the update.
            for moved in passed:
                fold(moved, step, row)
        else:
            fold(stays, step, row)
        out.append(stays)
    if skips:
        out.append(run)
    return out


def advance(
    steps: Sequence[Step], runs: list[Run], row, row_id, at: int, start: bool
) -> tuple[list[Run], list[Run]]:
    """Open runs and finished runs after ``row``; ``start`` lets the row begin a run."""
    open_runs: list[Run] = []
    done: list[Run] = []
    for run in runs + ([Run(0)] if start else []):
        bound = steps[run.stage].bound
        if bound is not None and run.first is not None and at - run.first > bound:
            continue
        for new in evaluate(steps, run, row, row_id, at):
            (done if new.stage == len(steps) else open_runs).append(new)
    return open_runs, done
