"""A keyed table in files that a stream upserts into: one row per key, whatever the order of the events.

The table is cut into buckets by a hash of the key. A micro-batch reads the buckets its keys fall into, merges
them with its own rows and writes them anew in a folder of its own; a manifest then names, for every bucket, the
batch that wrote it last. The manifest is one small file and appears at once or not at all, so a batch that failed
half-way left nothing that is read, and a batch that is replayed starts from the manifest before its own.

What is stored is a mergeable state per key (such as the latest row of each kind), so a key costs one row and
rows that arrive late or out of order change nothing that later ones have decided.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from eventflow.functions.scalar import normalize_tier
from eventflow.operators.saga import account_event_kinds

_MANIFEST = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("written_by", T.LongType()),
                          T.StructField("buckets", T.IntegerType())])


class KeyedTable:
    """`merge` maps each state column to the aggregate that merges the states of a key (such as F.max): it must be
    associative, commutative, and unchanged by merging a state with itself. `buckets` holds for the table's whole life."""

    def __init__(self, spark: SparkSession, location: str, keys: Sequence[str], schema: T.StructType,
                 merge: Mapping[str, Callable[[str], Column]], buckets: int = 64):
        self.spark, self.location, self.keys, self.merge, self.buckets = spark, location.rstrip("/"), list(keys), dict(merge), buckets
        self.schema = T.StructType([*[schema[c] for c in self.keys], *[schema[c] for c in self.merge]])
        self._of = F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int")

    # --- manifests

    def _path(self, kind: str) -> str:
        return f"{self.location}/{kind}"

    def _batches(self) -> list[int]:
        """The batches whose manifests are there, in their order."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self._path("manifests"))
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(root):
            return []
        names = [s.getPath().getName() for s in files.listStatus(root)]
        done = [int(n.removeprefix("batch=")) for n in names if n.startswith("batch=")]
        return sorted(b for b in done if files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._path('manifests')}/batch={b}/_SUCCESS")))

    def manifest(self, before: int | None = None) -> dict[int, int]:
        """bucket -> the batch that wrote it, as of the last batch (the last one below `before`)."""
        known = [b for b in self._batches() if before is None or b < before]
        if not known:
            return {}
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self._path('manifests')}/batch={known[-1]}").collect()
        if any(r.buckets != self.buckets for r in rows):
            raise ValueError(f"the table at {self.location} has {rows[0].buckets} buckets, not {self.buckets}")
        return {r.bucket: r.written_by for r in rows}

    # --- rows

    def _stored(self, manifest: Mapping[int, int]) -> DataFrame:
        """The rows of these buckets, with their bucket."""
        full = T.StructType([*self.schema.fields, T.StructField("__bucket", T.IntegerType())])
        paths = [f"{self._path('data')}/batch={batch}/__bucket={bucket}" for bucket, batch in sorted(manifest.items())]
        if not paths:
            return self.spark.createDataFrame([], full)
        # the bucket is a hash of the key, so it need not be read from the folder's name
        return self.spark.read.schema(self.schema).parquet(*paths).withColumn("__bucket", self._of)

    def read(self) -> DataFrame:
        """The table as of the last batch that ended."""
        return self._stored(self.manifest()).drop("__bucket")

    def get(self, keys: DataFrame) -> DataFrame:
        """The rows of these keys; only the buckets they fall into are opened."""
        wanted = keys.select(*self.keys).distinct().withColumn("__bucket", self._of)
        touched = {r[0] for r in wanted.select("__bucket").distinct().collect()}  # at most `buckets`
        held = self._stored({b: w for b, w in self.manifest().items() if b in touched})
        same = [held[k].eqNullSafe(wanted[k]) for k in self.keys]
        return held.join(wanted, [held["__bucket"] == wanted["__bucket"], *same], "left_semi").drop("__bucket")

    def upsert(self, states: DataFrame, batch_id: int) -> None:
        """Merge states (keys and state columns, any number of rows per key) into the table, as batch `batch_id`.

        Doing so again under the same number gives the same table. Null keys are a key of their own.
        """
        named = states.select(*self.keys, *self.merge)
        changes = named.groupBy(*self.keys).agg(*[f(c).alias(c) for c, f in self.merge.items()]).withColumn("__bucket", self._of).persist()
        try:
            touched = sorted(r[0] for r in changes.select("__bucket").distinct().collect())  # at most `buckets`
            before = self.manifest(batch_id)
            if touched:
                old = self._stored({b: before[b] for b in touched if b in before})
                both = old.unionByName(changes).repartition(min(len(touched), self.buckets), "__bucket")
                merged = both.groupBy("__bucket", *self.keys).agg(*[f(c).alias(c) for c, f in self.merge.items()])
                merged.write.partitionBy("__bucket").mode("overwrite").parquet(f"{self._path('data')}/batch={batch_id}")
        finally:
            changes.unpersist()
        after = before | {b: batch_id for b in touched}
        rows = [(bucket, batch, self.buckets) for bucket, batch in sorted(after.items())]
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self._path('manifests')}/batch={batch_id}")

    def sink(self, states_of: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
        """foreachBatch handler that upserts what `states_of` makes of each micro-batch."""

        def handle(batch: DataFrame, batch_id: int) -> None:
            self.upsert(states_of(batch), batch_id)

        return handle

    def prune(self, keep: int = 2) -> int:
        """Remove what none of the last `keep` manifests names; how many folders went.

        Readers of older states, and replays of batches before these, must have ended.
        """
        batches = self._batches()
        if len(batches) <= keep:
            return 0
        kept = batches[-max(1, keep):]
        named = {(b, w) for batch in kept for b, w in self.manifest(batch + 1).items()}
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        root = path(self._path("data"))
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        gone = 0
        for folder in files.listStatus(root) if files.exists(root) else []:
            batch = int(folder.getPath().getName().removeprefix("batch="))
            if batch > kept[-1]:
                continue
            for part in files.listStatus(folder.getPath()):
                name = part.getPath().getName()
                if name.startswith("__bucket=") and (int(name.removeprefix("__bucket=")), batch) not in named:
                    gone += files.delete(part.getPath(), True)
        for batch in batches:
            if batch not in kept:
                gone += files.delete(path(f"{self._path('manifests')}/batch={batch}"), True)
        return gone


# --- account states -----------------------------------------------------------------------------

def account_states(df: DataFrame, key: str = "account") -> DataFrame:
    """What each event that bears on an account says about it, as mergeable states: see `account_view`."""
    opened, upgraded, closed = account_event_kinds()
    at = [F.col("time"), F.col("id")]
    return df.filter(opened | upgraded | closed).select(
        key,
        F.when(opened | upgraded, F.struct(*at, F.col("tier"))).alias("tier_at"),
        F.when(opened | closed, F.struct(*at, opened.alias("active"))).alias("active_at"),
        F.col("time").alias("updated_at"),
    )


ACCOUNT_MERGE = {c: F.max for c in ("tier_at", "active_at", "updated_at")}


def account_table(spark: SparkSession, location: str, events: DataFrame, key: str = "account", buckets: int = 64) -> KeyedTable:
    """The upserted table of account states; events: any frame with the events' columns, for their types."""
    return KeyedTable(spark, location, [key], account_states(events, key).schema, ACCOUNT_MERGE, buckets)


def account_view(table: DataFrame, key: str = "account") -> DataFrame:
    """The stored states as `saga.account_state` gives them."""
    return table.select(key, F.col("active_at.active").alias("active"), normalize_tier(F.col("tier_at.tier")).alias("tier"), "updated_at")
