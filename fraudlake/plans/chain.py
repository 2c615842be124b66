"""The data pipeline as a typed list of jobs: raw files -> bronze -> silver -> gold -> online table.

A job names its layer, its table, the tables it reads and the function that makes it. ``run``
takes the jobs in the order given, each reading only what earlier jobs wrote, so a run can stop
after any layer and be taken up again there. Nothing is kept between jobs but their tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gold, online, silver
from ..sources import files
from ..sources.json_ranges import read_json_ranges

LAYERS = ("bronze", "silver", "gold", "online")


@dataclass(frozen=True)
class Job:
    """``make(spark, *inputs)``: inputs are the frames of ``reads`` (``layer/table``), or of ``raw`` its path."""
    layer: str
    table: str
    make: Callable[..., DataFrame]
    reads: tuple[str, ...] = ()
    raw: str | None = None
    #: A date column: the table is then kept as monthly snapshots.
    snapshots: str | None = None

    @property
    def name(self) -> str:
        return f"{self.layer}/{self.table}"


@dataclass
class Folder:
    """Where the tables of a run lie, and the months it covers."""
    spark: SparkSession
    raw: str
    out: str
    start: str | None = None
    end: str | None = None
    monthly: set[str] = field(default_factory=set)

    def path(self, name: str) -> str:
        return f"{self.out}/{name}"

    def read(self, name: str) -> DataFrame:
        if name in self.monthly:
            return files.read_snapshots(self.spark, self.path(name), self.start, self.end)
        return self.spark.read.parquet(self.path(name))


def _csv(spark: SparkSession, path: str) -> DataFrame:
    return files.read_csv(spark, path)


def _codes(spark: SparkSession, path: str) -> DataFrame:
    return read_json_ranges(spark, path, "mcc_code", "mcc_description")


def _targets(spark: SparkSession, path: str) -> DataFrame:
    return read_json_ranges(spark, path, "transaction_id", "is_fraud", "target")


def _features(spark: SparkSession, tx: DataFrame, users: DataFrame, cards: DataFrame, mcc: DataFrame) -> DataFrame:
    return gold.build_features(tx.withColumnRenamed("id", "transaction_id").drop("snapshot_date"), users, cards, mcc)


def _profiles(spark: SparkSession, cards: DataFrame, users: DataFrame) -> DataFrame:
    return online.to_key_value(online.build_profiles(cards, users), "card_number", order=["acct_open_date", "card_id"])


def _one(clean: Callable[[DataFrame], DataFrame]) -> Callable[..., DataFrame]:
    return lambda spark, df: clean(df)


JOBS = [
    Job("bronze", "transactions", _csv, raw="transactions_data.csv", snapshots="date"),
    Job("bronze", "cards", _csv, raw="cards_data.csv"),
    Job("bronze", "users", _csv, raw="users_data.csv"),
    Job("bronze", "mcc", _codes, raw="mcc_codes.json"),
    Job("bronze", "labels", _targets, raw="train_fraud_labels.json"),
    Job("silver", "cards", _one(silver.clean_cards), ("bronze/cards",)),
    Job("silver", "users", _one(silver.clean_users), ("bronze/users",)),
    Job("silver", "labels", _one(silver.clean_labels), ("bronze/labels",)),
    Job("silver", "mcc", _one(silver.clean_mcc), ("bronze/mcc",)),
    Job("silver", "transactions", _one(silver.clean_transactions), ("bronze/transactions",), snapshots="date"),
    Job("gold", "labels", _one(lambda df: df), ("silver/labels",)),
    Job("gold", "features", _features, ("silver/transactions", "silver/users", "silver/cards", "silver/mcc"), snapshots="date"),
    Job("online", "profiles", _profiles, ("silver/cards", "silver/users")),
]


def check(jobs: list[Job]) -> None:
    """Raise unless every job reads a raw file or tables of earlier jobs, and no table is made twice."""
    made: set[str] = set()
    for job in jobs:
        if job.layer not in LAYERS:
            raise ValueError(f"{job.name}: no such layer")
        if (job.raw is None) == (not job.reads):
            raise ValueError(f"{job.name}: reads either one raw file or tables")
        missing = [r for r in job.reads if r not in made]
        if missing or job.name in made:
            raise ValueError(f"{job.name}: reads {missing} before they are made" if missing else f"{job.name}: made twice")
        made.add(job.name)


def run(spark: SparkSession, raw: str, out: str, start: str | None = None, end: str | None = None,
        jobs: list[Job] = JOBS, layers: tuple[str, ...] = LAYERS) -> Folder:
    """Run the jobs of ``layers`` in order; tables of other layers must lie in ``out`` from an earlier run.

    Monthly tables cover the months from ``start`` to ``end``: a rerun replaces these and keeps the
    others. Rows without a date are in no month. All other tables are replaced whole.
    """
    check(jobs)
    folder = Folder(spark, raw, out, start, end, {j.name for j in jobs if j.snapshots})
    for job in jobs:
        if job.layer not in layers:
            continue
        inputs = [f"{raw}/{job.raw}"] if job.raw else [folder.read(r) for r in job.reads]
        made = job.make(spark, *inputs)
        if job.snapshots:
            files.write_snapshots(made.drop("snapshot_date"), folder.path(job.name), job.snapshots, start, end)
        else:
            files.overwrite_table(made, folder.path(job.name))
    return folder


def row_counts(folder: Folder, jobs: list[Job] = JOBS) -> DataFrame:
    """``(job, n)``: the rows of every table of a run."""
    counts = None
    for job in jobs:
        one = folder.read(job.name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(job.name).alias("job"), "n")
        counts = one if counts is None else counts.unionByName(one)
    return counts
