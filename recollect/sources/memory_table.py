"""The memory table: Parquet folders by tenant bucket and slice, written in generations.

``data/gen=N/tenant_bucket=B/slice=S`` holds the files, ``commits/gen=N`` one small file
naming the folders of that generation. A write becomes visible with its commit file
and never touches a folder being read, so a lost executor, a retried task or a driver
that dies half-way leave the table as it was. A write first claims its generation by a
file that only one writer can create; another writer fails before it has read anything.

Only the folders a write touches are read and rewritten; plain appends rewrite nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recollect import schema
from recollect.config import SESSION_KEY, TENANT, MemoryConfig, Now
from recollect.operators import ingest
from recollect.operators.retention import expired, live
from recollect.operators.transcript import segments
from recollect.sources.layout import (
    BUCKET,
    BUCKETS,
    SLICE,
    SLICES,
    mark_buckets,
    memory_slice,
    tenant_bucket,
)

APPEND, REPLACE, CREATE = "append", "replace", "create"
_COMMITS = f"kind string, {BUCKET} int, {SLICE} int, present boolean, txn string, gen bigint"
_DATA = f"{BUCKET} int, {SLICE} int"
Folder = tuple[int, int]


class ConcurrentWrite(RuntimeError):
    """Another writer holds the claim to the next generation."""


class MemoryTable:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        created = self._commits().filter(F.col("kind") == CREATE).first()
        self.buckets, self.slices = created[BUCKET], created[SLICE]

    @classmethod
    def create(
        cls, spark: SparkSession, path: str, buckets: int = BUCKETS, slices: int = SLICES
    ) -> MemoryTable:
        """A new table. Its numbers of buckets and slices are kept in the first commit."""
        first = spark.range(1).select(
            F.lit(CREATE).alias("kind"),
            F.lit(buckets).alias(BUCKET),
            F.lit(slices).alias(SLICE),
            F.lit(False).alias("present"),
            F.lit(None).cast("string").alias("txn"),
        )
        first.write.parquet(f"{path.rstrip('/')}/commits/gen=0")
        return cls(spark, path)

    # ---- reading -------------------------------------------------------------

    def read(self, folders: Iterable[Folder] | None = None) -> DataFrame:
        """Current memories with their bucket and slice; of some folders if given.

        The list of live folders is bounded by buckets x slices x appends since the
        last rewrite of a folder.
        """
        wanted = None if folders is None else set(folders)
        paths = [
            f"{self.path}/data/gen={r.gen}/{BUCKET}={r[BUCKET]}/{SLICE}={r[SLICE]}"
            for r in self._live_folders().collect()
            if wanted is None or (r[BUCKET], r[SLICE]) in wanted
        ]
        if not paths:
            rows = self.spark.createDataFrame([], schema.MEMORIES)
            rows = rows.withColumns({BUCKET: F.lit(0), SLICE: F.lit(0)})
        else:
            rows = (
                self.spark.read.schema(schema.MEMORIES)
                .option("basePath", f"{self.path}/data")
                .parquet(*paths)
                .drop("gen")
            )
        return mark_buckets(rows, self.buckets)

    def find_session(self, app_name: str, user_id: str, session_id: str) -> DataFrame:
        """A session's memory; one folder is read."""
        key = dict(zip(SESSION_KEY, (app_name, user_id, session_id)))
        named = self.spark.range(1).select(*[F.lit(v).alias(c) for c, v in key.items()])
        found = self.read(self._folders(self._session_keys(named)))
        for column, value in key.items():
            found = found.filter(F.col(column) == value)
        return found

    def interop(self, text_field: str = "text", vector_field: str = "embedding") -> DataFrame:
        """The table under the column names another reader expects."""
        return self.read().withColumnsRenamed({"transcript": text_field, "embedding": vector_field})

    # ---- writing -------------------------------------------------------------

    def add_sessions(
        self, events: DataFrame, config: MemoryConfig, now: Now, txn: str | None = None
    ) -> None:
        """Ingest whole sessions, replacing their memories."""
        self._rewrite(
            self._folders(self._session_keys(events)),
            lambda stored: ingest.ingest_sessions(events, config, now, stored),
            txn,
        )

    def add_events(
        self,
        events: DataFrame,
        config: MemoryConfig,
        now: Now,
        metadata: Mapping[str, str] | None = None,
        txn: str | None = None,
    ) -> None:
        """Append a delta of events to their sessions' memories.

        A first look at keys and event ids alone finds the folders with anything new;
        events delivered again rewrite nothing.
        """
        if self._done(txn):
            return
        arrived = segments(events, default_session=True)
        near = self.read(self._folders(self._session_keys(arrived)))
        fresh = ingest.new_segments(arrived, near)
        self._rewrite(
            self._folders(self._session_keys(fresh)),
            lambda stored: ingest.apply_delta(events, config, now, stored, metadata),
            txn,
        )

    def add_memories(self, memories: DataFrame, txn: str | None = None) -> None:
        """Append independent memories (see :func:`recollect.operators.ingest.insert_memories`)."""
        if not self._done(txn):
            with self._claimed() as gen:
                self._write(gen, memories, APPEND, None, txn)

    def delete_tenant(self, app_name: str, user_id: str, txn: str | None = None) -> None:
        own = self.spark.range(1).select(tenant_bucket(self.buckets, F.lit(app_name), F.lit(user_id)))
        bucket = own.first()[0]  # one number
        theirs = (F.col("app_name") == app_name) & (F.col("user_id") == user_id)
        self._rewrite(
            [(bucket, s) for s in range(self.slices)], lambda stored: stored.filter(~theirs), txn
        )

    def purge(self, ttl_seconds: int | None, now: Now, txn: str | None = None) -> None:
        """Remove expired memories; folders without any are left alone."""
        gone = expired(self.read(), ttl_seconds, now)
        self._rewrite(
            self._folders(gone), lambda stored: live(stored, ttl_seconds, now), txn
        )

    def replace_all(self, fn: Callable[[DataFrame], DataFrame], txn: str | None = None) -> None:
        """Rewrite every folder through ``fn`` (field protection, compaction)."""
        everything = [(b, s) for b in range(self.buckets) for s in range(self.slices)]
        self._rewrite(everything, fn, txn)

    def vacuum(self) -> int:
        """Delete the files that later generations have replaced; readers that started
        before should be done. Returns the number of folders removed."""
        live_now = self._live_folders().select("gen", BUCKET, SLICE)
        written = self._commits().filter("present").select("gen", BUCKET, SLICE)
        removed = 0
        hadoop = self.spark.sparkContext._jsc.hadoopConfiguration()
        for r in written.join(live_now, ["gen", BUCKET, SLICE], "left_anti").collect():
            name = f"{self.path}/data/gen={r.gen}/{BUCKET}={r[BUCKET]}/{SLICE}={r[SLICE]}"
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(name)
            removed += folder.getFileSystem(hadoop).delete(folder, True)
        return removed

    # ---- folders and commits -------------------------------------------------

    def _placed(self, df: DataFrame) -> DataFrame:
        return df.withColumns({BUCKET: tenant_bucket(self.buckets), SLICE: memory_slice(self.slices)})

    def _session_keys(self, events: DataFrame) -> DataFrame:
        return events.select(
            *TENANT, ingest.session_memory_id().alias("memory_id")
        )

    def _folders(self, rows: DataFrame) -> list[Folder]:
        """Folders these rows belong to: at most buckets x slices pairs of numbers."""
        found = self._placed(rows).select(BUCKET, SLICE).distinct().collect()
        return [(r[BUCKET], r[SLICE]) for r in found]

    def _commits(self) -> DataFrame:
        return self.spark.read.schema(_COMMITS).parquet(f"{self.path}/commits")

    def _live_folders(self) -> DataFrame:
        """Per folder: the last rewrite and the appends after it."""
        log = self._commits().filter(F.col("kind") != CREATE)
        base = log.groupBy(BUCKET, SLICE).agg(
            F.coalesce(F.max(F.when(F.col("kind") == REPLACE, F.col("gen"))), F.lit(0)).alias("base")
        )
        return log.join(base, [BUCKET, SLICE]).filter(
            F.col("present") & (F.col("gen") >= F.col("base"))
        )

    def _done(self, txn: str | None) -> bool:
        return txn is not None and not self._commits().filter(F.col("txn") == txn).isEmpty()

    def _rewrite(
        self, folders: list[Folder], fn: Callable[[DataFrame], DataFrame], txn: str | None
    ) -> None:
        if folders and not self._done(txn):
            with self._claimed() as gen:
                self._write(gen, fn(self.read(folders)), REPLACE, folders, txn)

    def _claim(self, gen: int):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/claims/gen={gen}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    @contextmanager
    def _claimed(self) -> Iterator[int]:
        """The next generation, for this writer alone; nothing is read before it is claimed."""
        gen = self._commits().agg(F.max("gen")).first()[0] + 1
        fs, path = self._claim(gen)
        try:
            fs.create(path, False).close()
        except Exception as error:
            raise ConcurrentWrite(f"generation {gen} of {self.path} is being written; see release()") from error
        try:
            if self._commits().agg(F.max("gen")).first()[0] + 1 != gen:
                raise ConcurrentWrite(f"generation {gen} of {self.path} was written meanwhile")
            yield gen
        finally:
            fs.delete(path, False)

    def release(self) -> bool:
        """Withdraw the claim of a writer that died; true if there was one."""
        fs, path = self._claim(self._commits().agg(F.max("gen")).first()[0] + 1)
        return fs.delete(path, False)

    def _write(
        self, gen: int, memories: DataFrame, kind: str, folders: list[Folder] | None, txn: str | None
    ) -> None:
        data = f"{self.path}/data/gen={gen}"
        placed = self._placed(memories.select(*schema.MEMORIES.fieldNames()))
        # rebalancing splits a folder that is too much for one task; the sort lets the
        # scan skip row groups of other tenants
        (
            placed.hint("rebalance", BUCKET, SLICE)
            .sortWithinPartitions(BUCKET, SLICE, "app_name", "user_id", "memory_id")
            .write.mode("overwrite")
            .partitionBy(BUCKET, SLICE)
            .parquet(data)
        )
        written = self.spark.read.schema(_DATA).parquet(data).select(BUCKET, SLICE).distinct()
        written = written.withColumn("present", F.lit(True))
        if folders is not None:
            named = self.spark.createDataFrame(folders, _DATA)
            written = named.join(written, [BUCKET, SLICE], "left")
        commit = written.select(
            F.lit(kind).alias("kind"),
            BUCKET,
            SLICE,
            F.coalesce("present", F.lit(False)).alias("present"),
            F.lit(txn).cast("string").alias("txn"),
        )
        commit.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/gen={gen}")
