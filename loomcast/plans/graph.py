"""A declarative graph of batch datasets: builders by name, edges by what they read, materialised as Parquet."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import remove, replace
from .quality import Expectation, ExpectationFailed, Watched, guard


class GraphError(Exception):
    """A dataset is missing, defined twice, or part of a cycle."""


@dataclass
class Dataset:
    name: str
    build: Callable
    inputs: tuple[str, ...]
    comment: str = ""
    properties: dict[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    rules: list[Expectation] = field(default_factory=list)


class Graph:
    """``dataset`` registers a function of its inputs' DataFrames; ``source`` binds a name to a DataFrame or table."""

    def __init__(self):
        self.datasets: dict[str, Dataset] = {}
        self.sources: dict[str, Callable[[SparkSession], DataFrame]] = {}

    def source(self, name: str, read: Callable[[SparkSession], DataFrame]) -> None:
        self._new(name)
        self.sources[name] = read

    def dataset(self, *inputs: str, name: str | None = None, comment: str = "", table_properties: dict[str, str] | None = None, partition_cols: list[str] | None = None, expect: list[Expectation] | None = None):
        def register(build: Callable) -> Callable:
            key = name or build.__name__
            self._new(key)
            self.datasets[key] = Dataset(key, build, inputs, comment, dict(table_properties or {}), tuple(partition_cols or ()), list(expect or []))
            return build

        return register

    def _new(self, name: str) -> None:
        if name in self.datasets or name in self.sources:
            raise GraphError(f"{name} is defined twice")

    def order(self, targets: list[str] | None = None) -> list[str]:
        """The datasets that ``targets`` (all, if not given) need, inputs first."""
        out: list[str] = []
        state: dict[str, int] = {}

        def visit(name: str, path: tuple[str, ...]) -> None:
            if name in self.sources or state.get(name) == 2:
                return
            if name not in self.datasets:
                raise GraphError(f"{name} is not defined" + (f", {path[-1]} reads it" if path else ""))
            if state.get(name) == 1:
                raise GraphError("cycle: " + " -> ".join([*path[path.index(name) :], name]))
            state[name] = 1
            for i in self.datasets[name].inputs:
                visit(i, (*path, name))
            state[name] = 2
            out.append(name)

        for t in targets or list(self.datasets):
            visit(t, ())
        return out

    def plan(self, spark: SparkSession, target: str) -> DataFrame:
        """The target as one lazy plan; rules apply while it is read."""
        made = {n: read(spark) for n, read in self.sources.items()}
        for name in self.order([target]):
            d = self.datasets[name]
            made[name] = guard(d.build(*(made[i] for i in d.inputs)), d.rules)
        return made[target]

    def materialize(self, spark: SparkSession, path: str, targets: list[str] | None = None) -> dict[str, list]:
        """Writes each dataset below ``path``, later ones reading the stored earlier ones; the reports of their rules.

        A dataset is computed once: its rules are counted by the write. It is written beside its place and moved there after
        that, so that a broken ``fail`` rule raises and leaves what was there before.
        """
        made = {n: read(spark) for n, read in self.sources.items()}
        reports = {}
        for name in self.order(targets):
            d = self.datasets[name]
            watched = Watched(d.build(*(made[i] for i in d.inputs)), d.rules)
            place, beside = f"{path}/{name}", f"{path}/_new_{name}"
            writer = watched.rows.write.mode("overwrite")
            (writer.partitionBy(*d.partition_by) if d.partition_by else writer).parquet(beside)
            reports[name] = watched.report()
            if broken := watched.broken():
                remove(spark, beside)
                raise ExpectationFailed(", ".join(broken))
            replace(spark, beside, place)
            made[name] = spark.read.parquet(place).select(*watched.rows.columns)
        return reports

    def register_catalog(self, spark: SparkSession, path: str, database: str = "default") -> None:
        """Catalog tables over the materialised datasets, with their comments and properties."""
        for name, d in self.datasets.items():
            quoted = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
            listed = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in d.properties.items())
            spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
            spark.sql(f"CREATE TABLE {database}.{name} USING parquet OPTIONS (path {quoted(f'{path}/{name}')}) COMMENT {quoted(d.comment)}" + (f" TBLPROPERTIES ({listed})" if listed else ""))
            if d.partition_by:
                spark.sql(f"MSCK REPAIR TABLE {database}.{name}")

    def register_tables(self, spark: SparkSession, path: str) -> None:
        """Temporary views of the materialised datasets under their names."""
        for name in self.datasets:
            spark.read.parquet(f"{path}/{name}").createOrReplaceTempView(name)
