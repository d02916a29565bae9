"""The changelog store: an append-only Parquet changelog with a commit log beside it.

Layout below the root folder:

    changelog/commit_seq=N/fate=F/iceberg_table=T/
                                              rows of commit N; F tells rows of the table from rows
                                              without a known table and rows with an error
    snapshots/commit_seq=N/                   one row per table the commit changed
    heads/commit_seq=N/                       newest snapshot of every table as of commit N
    cycles/commit_seq=N/                      one row, written last: it makes commit N visible
    states/commit_seq=N/                      filter states that commit N changed (null version: state gone)
    base/through=N/                           current rows up to commit N, from a compaction
    state_base/through=N/buckets=B/           filter states up to commit N, from a compaction, in B hash buckets
    held/commit_seq=N/                        records of a batch while it is being committed
    claims/N, numbers/<source>/<batch>/seq=N  commit numbers given out, and to which batch of which query

A commit owns its folders, so doing it again overwrites exactly what the first attempt left.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators import apply
from tidelog.options import IngestOptions
from tidelog.sources.keyed_states import KeyedStates, bucketed_table, write_bucketed
from tidelog.sources.published import write_clustered

CHANGELOG_SCHEMA = (
    "id string, dedup_key string, record string, version bigint, type string, key string, "
    "ngay_cap_nhat string, length string, _cdc_op string, topic string, partition int, offset bigint, "
    "timestamp timestamp, iceberg_table string, commit_seq bigint"
)
STORED_SCHEMA = CHANGELOG_SCHEMA + ", error string, fate string"
# Values of ``fate``.
APPLIED, SKIPPED, QUARANTINED = "applied", "skipped", "quarantined"
SNAPSHOT_SCHEMA = (
    "table string, branch string, snapshot_id bigint, parent_id bigint, committed_at timestamp, "
    "operation string, summary map<string,string>, added_records bigint, total_records bigint, commit_seq bigint"
)
HEAD_SCHEMA = "table string, snapshot_id bigint, total_records bigint, commit_seq bigint"
CYCLE_SCHEMA = "commit_id string, watermark_ms bigint, offsets string, commit_seq bigint"
BASE_SCHEMA = CHANGELOG_SCHEMA + ", through bigint"
STATE_SCHEMA = "dedup_key string, version bigint"


@dataclass(frozen=True)
class ChangelogStore:
    spark: SparkSession
    root: str
    state_buckets: int = 64  # of the next base of filter states

    def folder(self, name: str, seq: int | None = None, part: str = "commit_seq") -> str:
        return f"{self.root}/{name}" + ("" if seq is None else f"/{part}={seq}")

    def _exists(self, folder: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _read(self, name: str, schema: str) -> DataFrame:
        if not self._exists(self.folder(name)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.folder(name))

    def _read_commit(self, name: str, schema: str, seq: int) -> DataFrame:
        """One commit's folder, without listing those of the others."""
        if not self._exists(self.folder(name, seq)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.option("basePath", self.folder(name)).schema(schema).parquet(self.folder(name, seq))

    def committed(self, seq: int) -> bool:
        return self._exists(f"{self.folder('cycles', seq)}/_SUCCESS")

    def number_for(self, source: str, batch: int) -> int:
        """Commit number of a batch of a query: the one it was given before, else the next free one.

        A number is claimed by creating a file that nobody else has created, so several queries may share a store, and
        a query that starts anew from batch 0 gets numbers of its own. A crash after the claim leaves a gap.
        """
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        own = self.folder("numbers") + f"/{source}/{batch}"
        given = self._numbers(own, "seq")
        if given:
            return min(given)
        files = path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())
        claims = self.folder("claims")
        files.mkdirs(path(claims))
        taken = [int(e.getPath().getName()) for e in files.listStatus(path(claims)) if e.getPath().getName().isdigit()]
        seq = max([*taken, *self._numbers(self.folder("cycles"), "commit_seq")], default=-1) + 1
        while not files.createNewFile(path(f"{claims}/{seq}")):
            seq += 1
        files.mkdirs(path(f"{own}/seq={seq}"))
        return seq

    def hold(self, seq: int, batch: DataFrame) -> DataFrame:
        """The records of a commit in progress, written once and read from there until ``release``."""
        batch.write.mode("overwrite").parquet(self.folder("held", seq))
        return self.spark.read.schema(batch.schema).parquet(self.folder("held", seq))

    def release(self, seq: int) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder("held", seq))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def write_states(self, seq: int, states: DataFrame) -> None:
        states.write.mode("overwrite").parquet(self.folder("states", seq))

    def keyed_states(self, scope: Sequence[str] = ("topic",)) -> KeyedStates:
        """Filter states after all commits, for joining with the keys of a batch."""
        scoped = "".join(f"{name} string, " for name in scope) + STATE_SCHEMA
        changes = self._visible(self._read("states", scoped + ", commit_seq bigint"))
        through, base = self._state_through(), None
        if through is not None:
            changes = changes.where(F.col("commit_seq") > through)
            folder = self.folder("state_base", through, "through")
            base = bucketed_table(self.spark, folder, scope, max(self._numbers(folder, "buckets")))
        return KeyedStates(tuple(scope), changes, base)

    def states(self, scope: Sequence[str] = ("topic",)) -> DataFrame:
        """Filter states after all commits: scope columns, dedup_key, version. They don't depend on what became of rows."""
        keys, kept = [*scope, "dedup_key"], self.keyed_states(scope)
        all_states = kept.changes.select(*keys, "version", "commit_seq")
        if kept.base is not None:
            all_states = all_states.unionByName(kept.base.select(*keys, "version", F.lit(-1).cast("bigint").alias("commit_seq")))
        newest = all_states.groupBy(*keys).agg(F.max_by(F.struct("version"), "commit_seq").alias("_last"))
        return newest.select(*keys, "_last.version").where(F.col("version").isNotNull())

    def has_states(self) -> bool:
        return self._exists(self.folder("states")) or self._exists(self.folder("state_base"))

    def _state_through(self) -> int | None:
        folder = self.folder("state_base")
        ends = [(n, b) for n in self._numbers(folder, "through") for b in self._numbers(f"{folder}/through={n}", "buckets")]
        return max((n for n, b in ends if self._exists(f"{folder}/through={n}/buckets={b}/_SUCCESS")), default=None)

    def cycles(self) -> DataFrame:
        return self._read("cycles", CYCLE_SCHEMA)

    def _visible(self, rows: DataFrame) -> DataFrame:
        """Rows of finished commits. The commit number is a partition column, so the join prunes folders."""
        return rows.join(self.cycles().select("commit_seq"), "commit_seq", "left_semi")

    def snapshots(self) -> DataFrame:
        return self._visible(self._read("snapshots", SNAPSHOT_SCHEMA))

    def new_snapshots(self, seq: int) -> DataFrame:
        """Snapshots of one commit, finished or not."""
        return self._read_commit("snapshots", SNAPSHOT_SCHEMA, seq)

    def _stored(self) -> DataFrame:
        return self._read("changelog", STORED_SCHEMA)

    def changelog(self, table: str | None = None) -> DataFrame:
        rows = self._visible(self._stored().where(F.col("fate") == APPLIED)).drop("fate", "error")
        return rows if table is None else rows.where(F.col("iceberg_table") == table)

    def set_aside(self, fate: str) -> DataFrame:
        """Rows that reached no table: ``skipped`` or ``quarantined``."""
        return self._visible(self._stored().where(F.col("fate") == fate)).drop("fate")

    def written(self, seq: int) -> DataFrame:
        """Everything one commit wrote, finished or not."""
        return self._read_commit("changelog", STORED_SCHEMA, seq)

    def _numbers(self, folder: str, part: str) -> list[int]:
        """Numbers of the finished sub-folders, from their names alone."""
        if not self._exists(folder):
            return []
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        entries = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path)
        names = [e.getPath().getName() for e in entries if e.isDirectory()]
        return [int(name.split("=")[1]) for name in names if name.startswith(f"{part}=")]

    def base_through(self) -> int | None:
        """Last commit covered by a finished compaction."""
        folder = self.folder("base")
        ends = self._numbers(folder, "through")
        return max((n for n in ends if self._exists(f"{folder}/through={n}/_SUCCESS")), default=None)

    def heads_before(self, seq: int) -> DataFrame:
        """Newest snapshot per table before a commit: one small file, however many commits there are."""
        if self.committed(seq - 1):
            previous = seq - 1
        else:
            earlier = [n for n in self._numbers(self.folder("cycles"), "commit_seq") if n < seq and self.committed(n)]
            if not earlier:
                return self.spark.createDataFrame([], HEAD_SCHEMA)
            previous = max(earlier)
        return self.spark.read.schema(HEAD_SCHEMA).parquet(self.folder("heads", previous))

    def history(self, table: str | None = None, as_of: int | None = None) -> DataFrame:
        """What the current view is built from: the base, if one fits, and the commits after it."""
        rows, through = self.changelog(table), self.base_through()
        if as_of is not None:
            rows = apply.as_of(rows, as_of)
        if through is None or (as_of is not None and as_of < through):
            return rows
        base = self._read("base", BASE_SCHEMA).where(F.col("through") == through).drop("through")
        if table is not None:
            base = base.where(F.col("iceberg_table") == table)
        return rows.where(F.col("commit_seq") > through).unionByName(base)

    def current(
        self, options: IngestOptions, table: str | None = None, as_of: int | None = None
    ) -> DataFrame:
        """Current rows of one table or of all, after the commit ``as_of`` if given (time travel)."""
        history = self.history(table, as_of)
        if options.cdc_field is None and not options.upsert:
            return history
        mode = apply.UPSERT if options.upsert else apply.APPEND
        default = tuple(options.default_id_columns or ("dedup_key",))
        if table is not None:
            groups = {tuple(options.for_table(table).id_columns or default): None}
        else:  # tables with the same id columns are merged together, all others apart
            groups = {default: []}
            for name in options.table_options:
                groups.setdefault(tuple(options.for_table(name).id_columns or default), []).append(name)
        others = [name for ids, names in groups.items() if ids != default for name in names or ()]
        merged = []
        for ids, names in groups.items():
            rows = history
            if names is not None:
                rows = history.where(~F.col("iceberg_table").isin(others) if ids == default else F.col("iceberg_table").isin(names))
            merged.append(apply.merge_on_read(rows, ["iceberg_table", *ids], mode))
        return reduce(DataFrame.unionByName, merged)

    def versions(self, options: IngestOptions, table: str, commits: Sequence[int]) -> DataFrame:
        """The rows of a table after each of many commits (``as_of``), from one pass over the changelog."""
        rows = self.changelog(table)
        if options.cdc_field is None and not options.upsert:
            intervals = rows.withColumns({"valid_from": F.col("commit_seq"), "valid_to": F.lit(None).cast("bigint")})
        else:
            ids = options.for_table(table).id_columns or options.default_id_columns or ("dedup_key",)
            intervals = apply.validity(rows, ["iceberg_table", *ids], apply.UPSERT if options.upsert else apply.APPEND)
        return apply.at_versions(intervals, commits)

    def compact(self, options: IngestOptions, scope: Sequence[str] = ("topic",)) -> int | None:
        """Writes the current rows, and the filter states, as a new base. Commits stay readable for time travel."""
        last = self.cycles().agg(F.max("commit_seq")).first()[0]
        if last is None or last == self.base_through():
            return self.base_through()
        if self.has_states():
            write_bucketed(self.states(scope), self.folder("state_base", last, "through"), scope, self.state_buckets)
        # In order of the keys, so that a lookup reads few files and row groups.
        write_clustered(self.current(options), self.folder("base", last, "through"), ["iceberg_table", "dedup_key"],
                        partition_by=["iceberg_table"], mode="overwrite")
        return last

    def lookup(self, options: IngestOptions, table: str, key: str) -> DataFrame:
        """Current rows of one key. The filter reaches the files of both the rows and their removals."""
        return self.current(options, table).where(F.col("dedup_key") == key)

    def with_files(self) -> DataFrame:
        """Changelog rows with the file each is stored in."""
        applied = self._stored().where(F.col("fate") == APPLIED)
        return applied.withColumn("file_path", F.col("_metadata.file_path")).drop("fate", "error")

    def files(self) -> DataFrame:
        """One row per file: path, table, commit, records, and the snapshot that added it."""
        counted = self._visible(self.with_files()).groupBy("file_path", "iceberg_table", "commit_seq").agg(
            F.count(F.lit(1)).alias("record_count")
        )
        added = self.snapshots().select(
            F.col("table").alias("iceberg_table"), "commit_seq", F.col("snapshot_id").alias("added_snapshot_id")
        )
        return counted.join(added, ["iceberg_table", "commit_seq"])
