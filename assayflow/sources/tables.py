"""Tables that are rebuilt or merged, on plain Parquet.

Rows are laid out in parts: buckets of the key, or days. A merge rewrites only the parts it
touches, into a new version folder, and then publishes a small list of which
versions of each part are current. Updates go there first, the stored rows they do not replace are added. Readers follow the newest list, so they see
either the state before or the state after, and nothing is overwritten while it
is read. One writer at a time is assumed.

By key, update keys that are spread touch most buckets. By day, a scan of the stored keys finds the
days that hold updated rows; those are rewritten, and rows of other days are added to
theirs, so a load that brings new rows only rewrites nothing.

The list also states the newest day of the table, noted while rows are written, so that
nothing is scanned to learn it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayflow.operators.incremental import DuplicateKeyError, any_null, high_water, unreplaced
from assayflow.operators.observe import noted
from assayflow.operators.schema import conform, merge_schemas
from assayflow.sources.passes import passes, shuffles_deleted
from assayflow.sources.paths import hadoop_path

BUCKET = "key_bucket"
BROADCAST_LIMIT = 32 * 1024 * 1024  # bytes of keys
DEFAULT_BUCKETS = 8
ROW_OVERHEAD = 64  # bytes assumed per broadcast key on top of its text
DAY = "ingest_date"
CODEC = "zstd"
LAYOUTS = ("keys", "days")

#: Looks at the rows a table would have and raises to keep them from being published.
Approval = Callable[[DataFrame], None]
#: The versions of each part.
Parts = dict[str, list[int]]


class Table:
    """A table under ``path``; ``keys`` and ``buckets`` matter for merged tables only.

    Choose ``buckets`` before the first merge so that one bucket holds a few hundred megabytes
    (DEFAULT_BUCKETS if not given). With ``layout`` "days" a merged table is laid out by ingest day instead.
    A stored table keeps its own layout, number of buckets, keys and column types:
    asking for other ones is an error, and updates are brought to the stored types.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str] = (),
        buckets: int | None = None,
        broadcast_limit: int = BROADCAST_LIMIT,
        layout: str = "keys",
    ):
        if layout not in LAYOUTS:
            raise ValueError(f"layout in {LAYOUTS}")
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self._buckets = buckets
        self.broadcast_limit = broadcast_limit
        self.layout = layout

    @property
    def buckets(self) -> int:
        """The stored table's number of buckets, or the one it will get."""
        stored = self._published()["n_buckets"] if self.exists() else None
        if stored is not None and self._buckets not in (None, stored):
            raise ValueError(f"{self.path} has {stored} buckets, not {self._buckets}")
        return stored or self._buckets or DEFAULT_BUCKETS

    # -- which version of each bucket is current ------------------------------------

    def _versions(self) -> list[int]:
        fs, folder = hadoop_path(self.spark, f"{self.path}/current")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def _published(self, version: int | None = None) -> dict:
        versions = self._versions()
        if not versions:
            raise FileNotFoundError(f"no table at {self.path}")
        name = f"{self.path}/current/v{version or versions[-1]:08d}.json"
        return json.loads(self.spark.read.text(name, wholetext=True).head()[0])

    def _list(self, version: int | None = None) -> tuple[T.StructType, Parts]:
        """Schema, and the versions of each non-empty part, as published."""
        published = self._published(version)
        return T.StructType.fromJson(published["schema"]), published["parts"]

    def _publish(self, version: int, schema: T.StructType, n_buckets: int, parts: Parts, newest: dict, approve: Approval | None) -> None:
        if approve is not None:
            approve(self._read(schema, parts))
        layout = {"schema": schema.jsonValue(), "n_buckets": n_buckets, "keys": self.keys, "layout": self.layout, "parts": parts, "newest": newest}
        fs, draft = hadoop_path(self.spark, f"{self.path}/current/.draft-{version:08d}")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(layout), "utf-8"))
        out.close()
        _, final = hadoop_path(self.spark, f"{self.path}/current/v{version:08d}.json")
        if fs.exists(final) or not fs.rename(draft, final):
            raise RuntimeError(f"another writer published version {version} of {self.path}")

    # -- the newest day ----------------------------------------------------------------

    def _noted(self, df: DataFrame) -> tuple[DataFrame, Observation | None]:
        """The rows, with their first and last day noted while they are written."""
        if DAY not in df.columns:
            return df, None
        days = Observation()
        return df.observe(days, F.min(DAY).cast("string").alias("first"), F.max(DAY).cast("string").alias("last")), days

    def newest_day(self) -> date | None:
        """The largest ingest day of the table, NULL days aside; from the published list where that has it."""
        newest = self._published()["newest"]
        if "day" in newest:
            return date.fromisoformat(newest["day"]) if newest["day"] else None
        return high_water(self.read(), DAY).head().high_water

    # -- reading ---------------------------------------------------------------------

    def exists(self) -> bool:
        return bool(self._versions())

    def _read(self, schema: T.StructType, parts: Parts) -> DataFrame:
        paths = [f"{self.path}/data/v{v:08d}/{BUCKET}={part}" for part, versions in sorted(parts.items()) for v in versions]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self) -> DataFrame:
        """Current rows."""
        return self._read(*self._list())

    def read_matching(self, rows: DataFrame) -> DataFrame:
        """Current rows whose key is among those of ``rows``, from the buckets these keys are in.

        ``rows`` are read twice, so stage them first. Their keys are broadcast if they are small.
        """
        schema, current = self._list()
        keyed = conform(rows.select(*self.keys), T.StructType([schema[k] for k in self.keys])).filter(~any_null(self.keys))
        size = F.octet_length(F.concat_ws("", *(F.col(k).cast("string") for k in self.keys))) + ROW_OVERHEAD
        # One row per bucket.
        part = self._by_key(keyed, self.buckets) if self.layout == "keys" else F.lit("")
        stats = keyed.groupBy(part.cast("string").alias(BUCKET)).agg(F.sum(size).alias("key_bytes")).collect()
        touched = {b: v for b, v in current.items() if self.layout == "days" or b in {r[BUCKET] for r in stats}}
        keys = F.broadcast(keyed) if sum(r.key_bytes for r in stats) <= self.broadcast_limit else keyed
        return self._read(schema, touched).join(keys, self.keys, "left_semi")

    # -- writing ---------------------------------------------------------------------

    def _by_key(self, df: DataFrame, n_buckets: int) -> Column:
        """Bucket of a row. Rows with a NULL key are spread by content, not sent to one bucket."""
        by_content = F.xxhash64(*(F.col(f"`{c}`") for c in df.columns))
        if not self.keys:
            return F.pmod(by_content, F.lit(n_buckets)).cast("int")
        by_key = F.xxhash64(*self.keys)
        return F.pmod(F.when(any_null(self.keys), by_content).otherwise(by_key), F.lit(n_buckets)).cast("int")

    def _part(self, df: DataFrame, n_buckets: int) -> Column:
        """The part of a row, as text."""
        if self.layout == "days":
            return F.coalesce(F.col(DAY).cast("string"), F.lit("none"))
        return self._by_key(df, n_buckets).cast("string")

    def _next_version(self) -> int:
        versions = self._versions()
        return versions[-1] + 1 if versions else 1

    def _write(self, df: DataFrame, version: int, mode: str = "overwrite") -> None:
        df.write.mode(mode).option("compression", CODEC).partitionBy(BUCKET).parquet(f"{self.path}/data/v{version:08d}")

    def overwrite(self, df: DataFrame, approve: Approval | None = None) -> None:
        """Replace all rows. Rows are written where they are computed, without a shuffle."""
        version, n_buckets = self._next_version(), self.buckets
        part = F.pmod(F.spark_partition_id(), F.lit(n_buckets)).cast("string")
        rows, days = self._noted(df)
        with shuffles_deleted(df.sparkSession):
            self._write(rows.withColumn(BUCKET, part), version)
        newest = {} if days is None else {"day": noted(days).get("last")}
        self._publish(version, df.schema, n_buckets, {b: [version] for b in self._written(version)}, newest, approve)

    def _written(self, version: int) -> list[str]:
        fs, folder = hadoop_path(self.spark, f"{self.path}/data/v{version:08d}")
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return [n.split("=")[1] for n in names if n.startswith(f"{BUCKET}=")]

    def _stage(self, updates: Sequence[DataFrame], version: int, n_buckets: int) -> tuple[DataFrame, dict[str, int], dict | None]:
        """Write the update set once, a frame at a time; then reject repeated keys and return the key bytes per part, and the days noted."""
        seen = []
        for frame in updates:
            rows, days = self._noted(frame)
            tagged = rows.withColumn(BUCKET, self._part(frame, n_buckets))
            # Rebalancing groups rows by part and splits a part that is too big for one task.
            self._write(tagged.hint("rebalance", BUCKET), version, "append" if seen else "overwrite")
            seen.append(days)
        staged = self.spark.read.schema(tagged.schema).parquet(f"{self.path}/data/v{version:08d}")
        # A key has one bucket, but may have rows on several days.
        per_key = staged.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n"), F.min(BUCKET).alias(BUCKET))
        repeated = F.count_if((F.col("n") > 1) & ~any_null(self.keys)).alias("repeated")
        text = F.octet_length(F.concat_ws("", *(F.col(k).cast("string") for k in self.keys)))
        size = F.sum(text + ROW_OVERHEAD).alias("key_bytes")
        stats = per_key.groupBy(BUCKET).agg(size, repeated).collect()  # one row per part
        if any(row.repeated for row in stats):
            raise DuplicateKeyError(f"{self.path}: update set repeats {sum(r.repeated for r in stats)} keys")
        found = None if None in seen else [noted(days) for days in seen]
        ends = found and {end: pick((f[end] for f in found if f.get(end)), default=None) for end, pick in (("first", min), ("last", max))}
        return staged, {row[BUCKET]: row.key_bytes for row in stats}, ends

    def merge(self, updates: DataFrame | Sequence[DataFrame], approve: Approval | None = None) -> None:
        """Replace matching keys, insert the rest, delete nothing.

        The updates are written as rows of the new version, then the stored rows of the touched parts that
        they do not replace are added to it. Update keys whose measured size is small are broadcast, so these are
        found without a shuffle; otherwise they meet the update keys in one. Several frames of
        updates are one update set, written a frame at a time. With ``approve`` the rows are shown before they are published.
        """
        frames = [updates] if isinstance(updates, DataFrame) else list(updates)
        with shuffles_deleted(frames[0].sparkSession), shuffles_deleted(self.spark):
            self._merge(frames, approve)

    def _merge(self, updates: Sequence[DataFrame], approve: Approval | None) -> None:
        version, n_buckets = self._next_version(), self.buckets
        if version == 1:
            _, _, days = self._stage(updates, version, n_buckets)
            newest = {} if days is None else {"day": days["last"]}
            self._publish(version, updates[0].schema, n_buckets, {b: [version] for b in self._written(version)}, newest, approve)
            return
        published = self._published()
        if published["keys"] != self.keys:
            raise ValueError(f"{self.path} is keyed by {published['keys']}, not {self.keys}")
        if published["layout"] != self.layout:
            raise ValueError(f"{self.path} is laid out by {published['layout']}, not by {self.layout}")
        schema, current = self._list()
        # Stored types stay, or keys would hash into other buckets; new columns are added behind.
        grown = merge_schemas(schema, *(frame.schema for frame in updates))
        staged, key_bytes, days = self._stage([conform(frame, grown) for frame in updates], version, n_buckets)
        if not key_bytes:
            return
        small = sum(key_bytes.values()) <= self.broadcast_limit
        if self.layout == "days":
            rewritten = self._days_of(staged, schema, current, small)
        else:
            rewritten = {b: v for b, v in current.items() if b in key_bytes}
        for parts in self._in_groups(rewritten):
            # Files of a data folder carry the part in their path only; those without a new column give NULL.
            stored = self._read(grown, parts)
            stored = stored.withColumn(BUCKET, self._part(stored.select(*schema.names), n_buckets))
            kept = unreplaced(stored, staged, self.keys, broadcast_keys=small)
            # After a shuffle by key the write deals big parts over several tasks.
            self._write(kept if small else kept.hint("rebalance", BUCKET), version, "append")
        # What was rewritten replaces all older versions of its part, what is new is added to those of its.
        kept = {b: v for b, v in current.items() if b not in rewritten}
        added = {b: [*kept.get(b, []), version] for b in self._written(version)}
        self._publish(version, grown, n_buckets, kept | added, self._newest_after(published["newest"], days), approve)

    def _in_groups(self, parts: Parts) -> list[Parts]:
        """The parts in groups of about the same size, to be rewritten one after the other; small ones together."""
        sizes = {b: self._bytes(b, versions) for b, versions in parts.items()}
        n = passes(sum(sizes.values()))
        groups, filled = [{} for _ in range(n)], [0] * n
        for part in sorted(parts, key=sizes.get, reverse=True):
            least = filled.index(min(filled))
            groups[least][part] = parts[part]
            filled[least] += sizes[part]
        return [group for group in groups if group]

    def _bytes(self, part: str, versions: list[int]) -> int:
        folders = (hadoop_path(self.spark, f"{self.path}/data/v{v:08d}/{BUCKET}={part}") for v in versions)
        return sum(fs.getContentSummary(folder).getLength() for fs, folder in folders)

    def _days_of(self, staged: DataFrame, schema: T.StructType, current: Parts, small: bool) -> Parts:
        """The days that hold stored rows of the staged keys, found from the keys alone."""
        keys = staged.filter(~any_null(self.keys)).select(*self.keys)
        held = self._read(schema, current).select(*self.keys, DAY).join(F.broadcast(keys) if small else keys, self.keys, "left_semi")
        days = {r[0] for r in held.select(self._part(held, 0).alias("day")).distinct().collect()}  # at most one row per day
        return {b: v for b, v in current.items() if b in days}

    @staticmethod
    def _newest_after(newest: dict, days: dict | None) -> dict:
        """The newest day after a merge, if that is certain: no row on the newest day can have moved to an earlier one."""
        if "day" not in newest or days is None or days["first"] is None or (newest["day"] or "") > days["first"]:
            return {}
        return {"day": days["last"]}

    def expire(self, keep: int = 2) -> None:
        """Delete folders that none of the newest ``keep`` published lists refers to."""
        versions = self._versions()
        live = set()
        for v in versions[-keep:]:
            live |= {data for held in self._list(v)[1].values() for data in held}
        for v in versions[:-keep]:
            for stale in [f"current/v{v:08d}.json", f"staged/v{v:08d}"] + ([] if v in live else [f"data/v{v:08d}"]):
                fs, path = hadoop_path(self.spark, f"{self.path}/{stale}")
                fs.delete(path, True)
