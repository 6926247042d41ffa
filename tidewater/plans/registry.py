"""Datasets by name: what each reads, what it promises, and who may see what.

``@dataset`` registers a builder.  A :class:`Context` builds datasets on demand,
once each, and remembers which dataset read which: that is the lineage.  Reading
as a principal applies row filters and column masks on the way out, so that no
builder needs to know of them.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import expectations
from ..operators.expectations import Expectation
from ..staging import written
from .runlog import RunLog


@dataclass(frozen=True)
class Dataset:
    name: str
    layer: str
    build: Callable[[Context], DataFrame]
    expectations: tuple[Expectation, ...] = ()
    shared: bool = False
    properties: dict[str, str] = field(default_factory=dict)


DATASETS: dict[str, Dataset] = {}


def dataset(layer: str, *rules: Expectation, name: str | None = None, shared: bool = False, **properties: str):
    """Register a builder under its function's name; ``properties`` are kept as metadata.

    A ``shared`` dataset is written once when other datasets read it, as many
    branches of one query would otherwise each compute it anew.
    """

    def register(build: Callable[[Context], DataFrame]):
        own = name or build.__name__
        DATASETS[own] = Dataset(own, layer, build, tuple(rules), shared, {"quality": layer, **properties})
        return build

    return register


@dataclass(frozen=True)
class Principal:
    """A reader: a user and groups."""

    user: str
    groups: frozenset[str] = frozenset()


_TRACE = "_read_from_"


def traced_name(alias: str) -> str | None:
    """The dataset that a traced context handed out under an alias."""
    return alias.removeprefix(_TRACE) if alias.startswith(_TRACE) else None


class Context:
    """Builds datasets over one set of source tables, as of one date.

    ``stamp`` adds load times and counts broken expectations; ``staged`` writes
    shared datasets to the shared folder when a second dataset needs them;
    ``traced`` marks in every plan which columns come from which dataset.
    """

    def __init__(self, spark: SparkSession, source: Callable[[str], DataFrame], as_of: dt.date, stamp: bool = False, staged: bool = False, traced: bool = False):
        self.spark, self.source, self.as_of, self.stamp, self.staged, self.traced = spark, source, as_of, stamp, staged, traced
        self.counted = False
        self._written: set[str] = set()
        self.edges: set[tuple[str, str]] = set()
        self.failures: dict[str, Observation] = {}
        self._built: dict[str, DataFrame] = {}
        self._open: list[str] = []

    @property
    def today(self):
        return F.lit(self.as_of)

    def read(self, name: str) -> DataFrame:
        """A dataset, or a source table of that name; built once."""
        if self._open:
            self.edges.add((name, self._open[-1]))
        if name in self._open:
            raise ValueError(f"datasets read each other: {' -> '.join([*self._open, name])}")
        if name not in self._built:
            if name not in DATASETS:
                self._built[name] = self.source(name)
            else:
                self._open.append(name)
                try:
                    df = DATASETS[name].build(self)
                finally:
                    self._open.pop()
                rules = list(DATASETS[name].expectations)
                if rules and (self.stamp or self.counted):
                    self.failures[name] = Observation(f"{name}_{uuid.uuid4().hex}")
                df = expectations.apply(df, rules, self.failures.get(name), self.counted)
                self._built[name] = df.withColumn(f"_{DATASETS[name].layer}_loaded_at", F.current_timestamp()) if self.stamp else df
        if self.staged and self._open and name in DATASETS and DATASETS[name].shared and name not in self._written:
            self._built[name] = written(self._built[name])
            self._written.add(name)
        return self._built[name].alias(f"{_TRACE}{name}") if self.traced and self._open else self._built[name]

    def lineage(self) -> DataFrame:
        """(source, target) of every read so far."""
        return self.spark.createDataFrame(sorted(self.edges), "source string, target string")


def order(targets: list[str], context: Context) -> list[str]:
    """Names of the datasets that targets need, each behind those it reads."""
    for t in targets:
        context.read(t)
    out: list[str] = []

    def visit(name: str) -> None:
        for source, target in sorted(context.edges):
            if target == name and source not in out:
                visit(source)
        if name not in out:
            out.append(name)

    for t in targets:
        visit(t)
    return out


def materialize(context: Context, targets: list[str], folder: str, log: RunLog | None = None, steps: bool = True) -> dict[str, str]:
    """Write datasets in dependency order as Parquet; each is read back before those that need it, so nothing is computed twice.

    Without ``steps``, of datasets that are no targets only shared ones are written:
    the others' columns that nothing reads are then never computed.  With a ``log``,
    this is a run of it: the rows, seconds and expectations of every dataset that is
    written are noted, counted by the job that writes it.
    """
    paths = {}
    with log.run(f"materialize {', '.join(targets)}") if log else contextlib.nullcontext():
        for name in order(targets, context):
            if name not in DATASETS:
                continue
            path = f"{folder}/{DATASETS[name].layer}/{name}"
            # built anew, over datasets that are already written
            context._built.pop(name)
            if not (steps or name in targets or DATASETS[name].shared):
                context.read(name)
                continue
            context.counted = log is not None
            try:
                began = time.monotonic()
                context.read(name).write.mode("overwrite").parquet(path)
                context._built[name] = context.spark.read.parquet(path)
                if log:
                    seen = context.failures[name].get if DATASETS[name].expectations else {}
                    counts = [(e.name, seen[expectations.ROWS] - (seen[e.name] or 0), seen[e.name] or 0) for e in DATASETS[name].expectations]
                    log.built(name, time.monotonic() - began, context._built[name].count(), counts)
            finally:
                context.counted = False
            paths[name] = path
    return paths
