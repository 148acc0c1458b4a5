"""Incremental jobs: deduplication, upsert and counts over a stream of incident files; all replay-safe."""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from caseweave.functions.labels import norm, usable
from caseweave.operators.merge import keep_last, reconcile_ids


def file_stream(spark: SparkSession, path: str, files_per_trigger: int = 64) -> DataFrame:
    """A stream of Parquet files with the schema of those that are there."""
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def run_once(query) -> None:
    """Starts a prepared writer on all that is there and waits for its end."""
    query.trigger(availableNow=True).start().awaitTermination()


def known_ids(target: DataFrame, key: str, path: str, closed: str | None = None) -> DataFrame:
    """The target's ids (and when they were closed) as a stream, from a copy that is written to ``path`` once.

    A restarted job doesn't read the target.  All files come with the first trigger, so the ids are in the state when the
    first incidents are judged.
    """
    spark = target.sparkSession
    moment = F.max(F.col(closed).cast("timestamp") if closed else F.lit(None).cast("timestamp")).alias("__moment")
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        target.where(F.col(key).isNotNull()).groupBy(key).agg(moment).write.mode("overwrite").parquet(path)
    return spark.readStream.schema(StructType([target.schema[key], StructField("__moment", TimestampType())])).parquet(path)


#: Moment of a known id that has none: above the first watermark, below all others.
UNDATED = 1000
#: Last moment of an id that stays for good.
FOREVER = 1 << 60


def _met_ids(frame: pd.DataFrame, carried: pd.DataFrame | None) -> pd.DataFrame:
    """One row for each id: the first one by moment, the last moment, and whether any was known, and known for good."""
    ms = frame["__moment"].to_numpy("datetime64[ms]")
    last = np.where(np.isnat(ms), 0, ms.astype(np.int64))
    rows = frame.assign(__last=last, __stays=frame["__known"] & (last <= UNDATED))
    rows = rows if carried is None else pd.concat([carried, rows])
    rows = rows.sort_values("__moment", kind="stable")
    codes = pd.factorize(rows["__id"], use_na_sentinel=False)[0]
    _, first = np.unique(codes, return_index=True)
    latest = rows["__last"].to_numpy()[first]
    np.maximum.at(latest, codes, rows["__last"].to_numpy())
    some = {c: np.bincount(codes, rows[c].astype(bool)) > 0 for c in ("__known", "__stays")}
    return rows.iloc[first].assign(__last=latest, **some)


def incremental_dedup(
    stream: DataFrame, known: DataFrame, key: str, moment: str, delay: str = "6 hours", look_back_hours: float = 24 * 366, buckets: int = 1024
) -> DataFrame:
    """New incidents: the first row of each id (by moment), without ids that ``known`` (see ``known_ids``) has given.

    An id that was seen stays in the state until the watermark is ``look_back_hours`` beyond its last row or closing (a
    known id without a moment stays for good), so neither the target nor earlier output is read again.  Rows later than
    ``delay`` are dropped by the stream (``complete_dedup`` finds them); rows without an id are one id.

    Ids live in ``buckets`` packed states (by hash; the number stays with the checkpoint), so a call judges many ids at once.
    A trigger reads and writes the buckets that its rows fall into, some 20 bytes for each of their ids.
    """
    columns = stream.columns
    whole = [f.name for f in stream.schema.fields if f.name != key and f.dataType == LongType()]  # as text: next to a null pandas would round them
    timed = stream.select(*columns, F.col(moment).cast("timestamp").alias("__moment"), F.lit(False).alias("__known"))
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in stream.schema.fields if f.name != key]
    dated = F.greatest(F.coalesce("__moment", F.timestamp_millis(F.lit(UNDATED))), F.timestamp_millis(F.lit(UNDATED))).alias("__moment")
    given = known.select(key, *nulls, dated, F.lit(True).alias("__known")).select(*columns, "__moment", "__known")
    both = timed.unionByName(given).withWatermark("__moment", delay)
    bucket = F.when(F.col(key).isNull(), -1).otherwise(F.pmod(F.xxhash64(key), F.lit(buckets)))
    both = both.withColumns({c: F.col(c).cast("string") for c in whole} | {"__id": F.col(key).cast("string"), "__bucket": bucket})
    kept = int(look_back_hours * 3_600_000)

    def judge(_, frames, state):
        now = state.getCurrentWatermarkMs()
        held = pd.Series(dtype="int64") if not state.exists else pd.Series(np.frombuffer(state.get[1], np.int64), index=pd.Index(pickle.loads(state.get[0]), dtype=object))
        met = None
        if not state.hasTimedOut:
            for frame in frames:
                met = _met_ids(frame, met)
        if met is not None and len(met):
            ids = pd.Index(met["__id"].to_numpy(), dtype=object)
            place = held.index.get_indexer(ids)
            before = np.where(place >= 0, held.to_numpy()[place] if len(held) else 0, 0)
            until = np.maximum(np.maximum(met["__last"].to_numpy() + kept, now + 1), before)
            until = np.where(met["__stays"].to_numpy(), FOREVER, until)
            fresh = met[(place < 0) & ~met["__known"].to_numpy(dtype=bool)]
            rest = held.drop(held.index[place[place >= 0]])
            held = pd.concat([rest[rest >= now], pd.Series(until, index=ids)])
        else:
            fresh, held = None, held[held >= now]
        if not len(held):
            state.remove()
            return
        state.update((pickle.dumps(held.index.to_list()), held.to_numpy(np.int64).tobytes()))
        if held.min() < FOREVER:
            state.setTimeoutTimestamp(int(held.min()))
        if fresh is not None and len(fresh):
            yield fresh[columns]

    schema = ", ".join(f"`{f.name}` {'string' if f.name in whole else f.dataType.simpleString()}" for f in stream.schema.fields)
    out = both.groupBy("__bucket").applyInPandasWithState(judge, schema, "ids binary, until binary", "append", GroupStateTimeout.EventTimeTimeout)
    return out.select(*(F.col(c).cast("long").alias(c) if c in whole else F.col(c) for c in columns))


class MergeLog:
    """``foreachBatch`` sink: an append-only log of runs that readers merge.

    A batch writes its own rows as one run, whatever the log holds: bytes in proportion to the batch.  ``merge`` turns
    rows of any runs into one for each key; it has to give the same whatever the grouping and order (the last row by a
    total order, sums).  Runs of about one size are compacted into one when there are ``fanout`` of them, sizes being measured, so
    a row is rewritten about as often as the log grows ``fanout``-fold, and a read meets few runs.  A list names the
    runs as of each batch.  A replayed batch starts from the list before it and writes the same paths, so nothing is applied
    twice; no path is read and written at once.  Runs that neither the new list nor the one before it names are deleted.
    """

    def __init__(self, path: str, merge: Callable[[DataFrame], DataFrame], fanout: int = 4, unit: int = 1 << 20):
        self.path, self.merge, self.fanout, self.unit = path, merge, fanout, unit
        self.written: list[int] = []  # bytes that each batch wrote, compaction included

    def _list(self, spark: SparkSession, number: int) -> dict[str, int]:
        if number < 0:
            return {}
        return {r["run"]: r["bytes"] for r in spark.read.schema("run string, bytes long").json(f"{self.path}/runs-{number}").collect()}

    def _runs(self, spark: SparkSession, number: int) -> dict[str, int]:
        """Name and bytes of the runs as of a batch; bytes of -1 mark runs that the batch itself compacted."""
        return {r: n for r, n in self._list(spark, number).items() if n >= 0}

    def _rows(self, spark: SparkSession, runs: list[str], schema) -> DataFrame:
        return spark.read.schema(schema).parquet(*(f"{self.path}/{r}" for r in runs))

    def _write(self, rows: DataFrame, run: str) -> int:
        rows.write.mode("overwrite").parquet(f"{self.path}/{run}")
        path = rows.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{run}")
        return path.getFileSystem(rows.sparkSession._jsc.hadoopConfiguration()).getContentSummary(path).getLength()

    def _tier(self, size: int) -> int:
        return int(math.log(max(size, self.unit) / self.unit, self.fanout))

    def read(self, spark: SparkSession, number: int, schema) -> DataFrame:
        """The merged rows as of a batch."""
        runs = sorted(self._runs(spark, number))
        return self.merge(self._rows(spark, runs, schema)) if runs else spark.createDataFrame([], schema)

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        listed = self._list(spark, number - 1)
        before = {r: n for r, n in listed.items() if n >= 0}
        own = {f"run-{number}": self._write(self.merge(batch), f"run-{number}")}
        runs = before | own
        while True:
            tiers: dict[int, list[str]] = {}
            for run, size in runs.items():
                tiers.setdefault(self._tier(size), []).append(run)
            full = min((t for t, r in tiers.items() if len(r) >= self.fanout), default=None)
            if full is None:
                break
            name = f"run-{number}-{full}"
            size = self._write(self.merge(self._rows(spark, sorted(tiers[full]), batch.schema)), name)
            own[name] = size
            runs = {r: n for r, n in runs.items() if r not in tiers[full]} | {name: size}
            if self._tier(size) == full:  # smaller than its parts: nothing to gain by going on
                break
        self.written.append(sum(own.values()))
        names = sorted((runs | {r: -1 for r in own if r not in runs}).items())
        spark.createDataFrame(names, "run string, bytes long").coalesce(1).write.mode("overwrite").json(f"{self.path}/runs-{number}")
        self._clean(spark, (set(self._list(spark, number - 2)) | set(listed)) - set(before) - set(runs))

    def _clean(self, spark: SparkSession, dropped: set) -> None:
        for run in dropped:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{run}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class VersionedUpsert(MergeLog):
    """Upsert sink: a key's row is the last one by ``order`` over all batches, so an older row in a later batch replaces nothing."""

    def __init__(self, path: str, key: str, order: list[str], **options):
        super().__init__(path, lambda rows: keep_last(rows, [key], order), **options)


WINDOW_KEYS = ["start", "level", "label", "usable"]


def window_counts(rows: DataFrame, moment: str, levels: dict[str, Column], width: str = "1 hour") -> DataFrame:
    """``start, level, label, usable, n, latest``: rows of a batch by window, level and normalised label.

    Labels that aren't usable are one null label, so they are counted too.  Such counts of any batches add up.
    """
    start = F.window(F.col(moment).cast("timestamp"), width).start
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("level"), c.cast("string").alias("v")) for k, c in levels.items()))).alias("p")
    flat = rows.select(start.alias("start"), F.col(moment).cast("timestamp").alias("at"), each)
    good = usable(F.col("p.v"))
    return flat.groupBy("start", F.col("p.level").alias("level"), F.when(good, norm(F.col("p.v"))).alias("label"), good.alias("usable")).agg(
        F.count(F.lit(1)).alias("n"), F.max("at").alias("latest")
    )


class WindowCounts(MergeLog):
    """Window counts kept up to date by every batch: what comes late corrects its window, however late it is.

    The state is the log of summed counts.  ``updates`` gives the windows that a batch changed with their values before and
    after, so that a downstream copy can take the old ones back; the source is never read a second time.
    """

    def __init__(self, path: str, moment: str, levels: dict[str, Column], width: str = "1 hour", **options):
        add = lambda rows: rows.groupBy(*WINDOW_KEYS).agg(F.sum("n").alias("n"), F.max("latest").alias("latest"))
        super().__init__(path, add, **options)
        self.moment, self.levels, self.width = moment, levels, width
        self.schema = "start timestamp, level string, label string, usable boolean, n long, latest timestamp"

    def __call__(self, batch: DataFrame, number: int) -> None:
        super().__call__(window_counts(batch, self.moment, self.levels, self.width), number)

    def updates(self, spark: SparkSession, number: int) -> DataFrame:
        """Counts that the last batch changed: ``n_before`` (0: none) and ``n_after``."""
        changed = self._rows(spark, [f"run-{number}"], self.schema).select(*WINDOW_KEYS, F.col("n").alias("more"))
        after = self.read(spark, number, self.schema).select(*(F.col(c).alias(f"__{c}") for c in WINDOW_KEYS), "n")
        same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in WINDOW_KEYS]
        return changed.join(after, same).select(*WINDOW_KEYS, (F.col("n") - F.col("more")).alias("n_before"), F.col("n").alias("n_after"))


def closed_windows(counts: DataFrame, width: str = "1 hour", delay: str = "6 hours") -> DataFrame:
    """The counts of windows that end ``delay`` before the latest row or earlier."""
    until = counts.agg((F.max(F.date_trunc("millisecond", "latest")) - F.expr(f"interval {delay}")).alias("until"))  # one row
    return counts.join(F.broadcast(until)).where(F.col("start") + F.expr(f"interval {width}") <= F.col("until")).drop("until")


def coverage_by_window(counts: DataFrame) -> DataFrame:
    """Per window and level: rows, usable share, labels, the commonest one's share and the entropy, and the drift of each
    share against the window before (null for a level's first one).

    Labels are summed up before windows are put in order, so the order is over windows, not rows.
    """
    n = F.when(F.col("usable"), F.col("n"))
    total = F.sum(n)
    by = counts.groupBy("start", "level").agg(
        F.sum("n").alias("rows"), (F.coalesce(total, F.lit(0)) * 100 / F.sum("n")).alias("usable_pct"), F.count(n).alias("labels"),
        (F.max(n) * 100 / total).alias("top_pct"), (F.log2(total) - F.sum(n * F.log2(n)) / total).alias("entropy"),
    )
    before = Window.partitionBy("level").orderBy("start")
    return by.select("*", *((F.col(c) - F.lag(c).over(before)).alias(c.replace("_pct", "_drift")) for c in ("usable_pct", "top_pct")))


def late_ids(source: DataFrame, streamed: DataFrame, key: str) -> DataFrame:
    """Ids that the stream missed, for instance because they came after the delay: found by the batch job after it."""
    return reconcile_ids(source, streamed, key).where("side = 'missing_in_target'")


def complete_dedup(source: DataFrame, streamed: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Each new id once: those that the stream gave out, and those of the source that it dropped as late."""
    late = late_ids(source, streamed, key).select(key).join(target.select(key), key, "left_anti")
    return streamed.select(key).distinct().unionByName(late)
