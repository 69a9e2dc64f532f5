"""The batch job over and over on one root: each run is one commit, whole or not there at all.

Tables that a run makes anew are written below the run's own folder. The incremental table and the
histories share their unchanged parts with the runs before (see ``operators.parts``). The commit that names
all of a run's files is the last thing it writes, so a run that breaks off changes nothing for readers, and
the next one starts from the last whole state.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators import quality
from ..operators.contracts import CONTRACTS
from ..operators.parts import merge_buckets, merge_history
from ..operators.scd2 import CHECKED_COLUMNS
from ..operators.validation import ERROR
from ..sources.catalogue import RESOURCES
from ..sources.commits import Commit, Commits, TableFiles
from ..sources.provenance import ingest_once, new_run_id, side
from ..sources.schemas import declared_schema
from ..sources.tables import StageReport
from .medallion import Medallion, RunReport

WHOLE = "whole"


class CommittedRun(Medallion):
    """A run that notes the files of each of its tables instead of having readers look for them."""

    def __init__(self, commits: Commits, held: dict[str, TableFiles], jobs: int = 4, buckets: int = 256):
        self.commits, self.held, self.buckets = commits, held, buckets
        self.folder = commits.new_folder()
        self.files: dict[str, TableFiles] = {}
        super().__init__(commits.spark, f"{commits.root}/{self.folder}", None, jobs)

    def read(self, layer: str, table: str) -> DataFrame:
        return self.files[f"{layer}/{table}"].read(self.spark, self.commits.root)

    def path(self, layer: str, table: str) -> str:
        """A table's folder; of a bronze table that of its records."""
        known = self.files.get(f"{layer}/{table}") if layer == "bronze" else None
        return f"{self.commits.root}/{known.parts[WHOLE][0]}" if known else super().path(layer, table)

    def _note(self, layer: str, table: str, schema: T.StructType, **parts: str) -> None:
        found = {part: (folder,) for part, folder in parts.items()}
        self.files[f"{layer}/{table}"] = TableFiles(schema, found)

    def _write(self, df: DataFrame, layer: str, table: str) -> None:
        super()._write(df, layer, table)
        self._note(layer, table, df.schema, **{WHOLE: f"{self.folder}/{layer}/{table}"})

    def bronze(
        self,
        source_dir: str,
        run_id: str,
        names: Iterable[str] = tuple(RESOURCES),
        infer: bool = False,
        spread: int | None = None,
    ) -> list[StageReport]:
        """As in ``Medallion``; where a schema is declared, records and bad lines are told apart in one pass."""
        names = list(names)
        declared = {} if infer else {n: s for n in names if (s := declared_schema(n)) is not None}

        def load(name: str) -> StageReport:
            table = RESOURCES[name].table
            if name not in declared:
                (report,) = super(CommittedRun, self).bronze(source_dir, run_id, (name,), infer, spread)
                schema = self.spark.read.parquet(report.target).schema
                self._note("bronze", table, schema, **{WHOLE: f"{self.folder}/bronze/{table}"})
                return report
            place = f"{self.folder}/bronze/{table}"
            source = f"{source_dir.rstrip('/')}/{RESOURCES[name].file_glob}"
            report, schema = ingest_once(self.spark, source, f"{self.commits.root}/{place}", run_id, declared[name], spread)
            self._note("bronze", table, schema, **{WHOLE: side(place, False)})
            bad = {WHOLE: side(place, True)} if report.rows["bad_lines"] else {}
            self._note("bronze", f"{table}_bad_lines", schema, **bad)
            return report

        return self._each(load, names)

    def validate(self, names: Iterable[str] = tuple(CONTRACTS)) -> list[StageReport]:
        names = list(names)
        reports = super().validate(names)
        for name, report in zip(names, reports, strict=True):
            table = RESOURCES[name].table
            schema = T.StructType([*self.files[f"bronze/{table}"].schema, T.StructField(ERROR, T.StringType())])
            held = {WHOLE: f"{self.folder}/silver/{table}_checked/is_valid=false"} if report.rows["held"] else {}
            self._note("silver", f"{table}_held", schema, **held)
        return reports

    def _load(self, rows: DataFrame, table: str, key: str, time: str) -> None:
        name = f"silver/{table}"
        self.files[name] = merge_buckets(self.commits, self.held.get(name), rows, key, time, self.buckets)

    def _version(self, table: str, at: Column) -> None:
        name = f"silver/{table}_snapshot"
        source = self.read("silver", table)
        self.files[name] = merge_history(self.commits, self.held.get(name), source, f"{table}_id", CHECKED_COLUMNS[table], at)


class Lake:
    """All runs below ``root``. ``run`` adds one; everything else reads the newest, or the one asked for."""

    def __init__(self, spark: SparkSession, root: str, jobs: int = 4, buckets: int = 256):
        self.spark, self.jobs, self.buckets = spark, jobs, buckets
        self.commits = Commits(spark, root)

    def run(self, source_dir: str, run_at: str, run_id: str | None = None, infer: bool = False, spread: int | None = None) -> RunReport:
        """Load an export and commit all tables that follow from it."""
        before = self.commits.newest()
        job = CommittedRun(self.commits, before.tables if before else {}, self.jobs, self.buckets)
        report = job.run(source_dir, run_at, run_id or new_run_id(), infer=infer, spread=spread)
        self.commits.publish(report.run_id, job.files, before)
        return report

    def _commit(self, number: int | None) -> Commit:
        found = self.commits.newest() if number is None else self.commits.get(number)
        if found is None:
            raise ValueError(f"{self.commits.root} holds no complete run")
        return found

    def read(self, layer: str, table: str, number: int | None = None) -> DataFrame:
        """A table as the newest run left it, or as commit ``number`` did."""
        return self._commit(number).tables[f"{layer}/{table}"].read(self.spark, self.commits.root)

    def held_back(self, table: str, number: int | None = None) -> DataFrame:
        """Records that failed their contract, with the reason."""
        return self.read("silver", f"{table}_held", number)

    def check(self, number: int | None = None) -> DataFrame:
        """Result of every declared data test on one state."""
        commit = self._commit(number)
        wanted = {c.table: "silver" for c in quality.SILVER_CHECKS} | {c.table: "gold" for c in quality.GOLD_CHECKS}
        tables = {t: commit.tables[f"{layer}/{t}"].read(self.spark, self.commits.root) for t, layer in wanted.items()}
        return quality.run_checks(tables, [*quality.SILVER_CHECKS, *quality.GOLD_CHECKS])
