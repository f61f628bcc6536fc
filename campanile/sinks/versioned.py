"""Tables of immutable snapshots and of the micro-batches written since, for a long-running stream.

    <path>/manifests/<k>                    what version k consists of; written last, so a crash before it changes nothing
    <path>/snapshots/version=<k>/<part>=…   the parts that version k rewrote
    <path>/batches/batch=<n>/<part>=…       micro-batches

A version's manifest names, for each part (a day, a bucket), the version folder that holds it.  Folding micro-batches in
rewrites the parts they touch and no other, so its cost follows the changes and not the history.  Folders are deleted
one version after nothing names them any more, so queries that run meanwhile find what they read.  A table has
one writer of batches and one of versions at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from campanile.sinks import files
from campanile.sinks.stats_table import BACKOFF_SECONDS, MAX_ATTEMPTS, persistently


@dataclass
class Manifest:
    """Version ``version``: the version folder of each part, and notes of the writer."""

    version: int = 0
    parts: dict[str, int] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)


class Snapshots:
    """A table whose parts are replaced as wholes, version by version."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, part: str, order: Sequence[str] = (), bloom: Sequence[str] = ()):
        """``schema`` without ``part``, the partition column; files are sorted by ``order``, with Bloom filters on ``bloom``."""
        self.spark, self.path, self.schema, self.part, self.order, self.bloom = spark, path.rstrip("/"), schema, part, order, bloom
        self._columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)

    def manifest(self) -> Manifest:
        """The newest version; an empty one before the first."""
        numbers = [int(n) for n in files.names(self.spark, f"{self.path}/manifests") if n.isdigit()]
        return Manifest(**json.loads(files.read_text(self.spark, f"{self.path}/manifests/{max(numbers)}"))) if numbers else Manifest()

    def _scan(self, base: str, extra: str, folders: list[str]) -> DataFrame:
        schema = f"{self._columns}, {extra}, `{self.part}` string"
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{base}").parquet(*[f"{self.path}/{base}/{f}" for f in folders])

    def read(self, parts: Iterable[str] | None = None, manifest: Manifest | None = None) -> DataFrame:
        """Rows of the newest version, of the given parts only; other folders aren't even listed."""
        held = (manifest or self.manifest()).parts
        chosen = sorted(held if parts is None else set(held) & set(parts))
        return self._scan("snapshots", "version int", [f"version={held[p]}/{self.part}={p}" for p in chosen]).drop("version")

    def publish(self, rows: DataFrame | None, replaced: Iterable[str], before: Manifest, **notes) -> Manifest:
        """Replace parts by ``rows``, which have the column ``part``; parts without rows are gone.  The manifest comes last."""
        version, folder = before.version + 1, f"{self.path}/snapshots/version={before.version + 1}"
        held = {p: v for p, v in before.parts.items() if p not in set(replaced)}
        if rows is not None:
            # What a crashed attempt left at this version is overwritten.
            writer = rows.hint("rebalance", self.part).sortWithinPartitions(self.part, *self.order).write.mode("overwrite")
            for column in self.bloom:
                writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
            writer.partitionBy(self.part).parquet(folder)
            held |= {n.partition("=")[2]: version for n in files.names(self.spark, folder) if n.startswith(f"{self.part}=")}
        made = Manifest(version, held, {**before.notes, **notes})
        files.publish_text(self.spark, f"{self.path}/manifests/{version}", json.dumps(asdict(made)))
        self._retire(before, made)
        return made

    def _retire(self, before: Manifest, now: Manifest) -> None:
        needed = {*before.parts.values(), *now.parts.values()}
        for name in files.names(self.spark, f"{self.path}/snapshots"):
            number = name.removeprefix("version=")
            if number.isdigit() and int(number) not in needed and int(number) <= now.version:
                files.delete(self.spark, f"{self.path}/snapshots/{name}")
        for name in files.names(self.spark, f"{self.path}/manifests"):
            if name.isdigit() and int(name) < before.version:
                files.delete(self.spark, f"{self.path}/manifests/{name}")


class VersionedTable(Snapshots):
    """Snapshots and micro-batches; the newest batch holds a key's value."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], part: str, part_of: Column,
                 order: Sequence[str] = (), bloom: Sequence[str] = (), kept_by: str | None = None):
        """``part_of`` gives a row's part and depends on its key alone; ``kept_by`` is the time that retention goes by."""
        super().__init__(spark, path, schema, part, order, bloom)
        self.keys, self.part_of, self.kept_by = tuple(keys), part_of, kept_by

    def write_batch(self, batch: DataFrame, batch_id: int, attempts: int = MAX_ATTEMPTS, backoff: float = BACKOFF_SECONDS) -> None:
        """Write one micro-batch in place of an earlier attempt at it; one without rows leaves no folder."""
        folder = f"{self.path}/batches/batch={batch_id}"
        rows = batch.select(*self.schema.names, self.part_of.cast("string").alias(self.part))
        writer = rows.hint("rebalance", self.part).write.mode("overwrite").partitionBy(self.part)
        persistently(lambda: writer.parquet(folder), attempts, backoff)
        if not self._parts_in(folder):
            files.delete(self.spark, folder)

    def writer(self, **options) -> Callable[[DataFrame, int], None]:
        """Callback for ``foreachBatch``; ``updated_at`` is stamped if the schema has it."""
        def write(batch: DataFrame, batch_id: int) -> None:
            stamped = batch.withColumn("updated_at", F.current_timestamp()) if "updated_at" in self.schema.names else batch
            self.write_batch(stamped, batch_id, **options)

        return write

    def _parts_in(self, folder: str) -> list[str]:
        return [n.partition("=")[2] for n in files.names(self.spark, folder) if n.startswith(f"{self.part}=")]

    def live_batches(self, manifest: Manifest, before: int | None = None) -> dict[int, list[str]]:
        """Parts of each finished micro-batch that isn't folded in yet."""
        through, live = manifest.notes.get("through", -1), {}
        for name in files.names(self.spark, f"{self.path}/batches"):
            number = name.removeprefix("batch=")
            if number.isdigit() and int(number) > through and (before is None or int(number) < before):
                if files.exists(self.spark, f"{self.path}/batches/{name}/_SUCCESS"):
                    live[int(number)] = self._parts_in(f"{self.path}/batches/{name}")
        return live

    def states(self) -> dict[str, str]:
        """For each part, what its rows come from: another text means that they may have changed."""
        manifest = self.manifest()
        newest: dict[str, int] = {}
        for number, parts in sorted(self.live_batches(manifest).items()):
            newest |= dict.fromkeys(parts, number)
        return {p: f"{manifest.parts.get(p, 0)}:{newest.get(p, -1)}" for p in {*manifest.parts, *newest}}

    def _merged(self, manifest: Manifest, live: dict[int, list[str]], parts: set[str]) -> DataFrame:
        """The newest value of each key in ``parts``."""
        newer = self._scan("batches", "batch bigint", [f"batch={n}/{self.part}={p}" for n, held in sorted(live.items()) for p in held if p in parts])
        base = self.read(parts, manifest).withColumn("batch", F.lit(manifest.notes.get("through", -1)).cast("bigint"))
        both = base.select(*newer.columns).unionByName(newer)
        # Columns one by one, so this stays a hash aggregation.
        values = [F.max_by(c, "batch").alias(c) for c in self.schema.names if c not in self.keys]
        keyed = both.groupBy(*self.keys, self.part)
        return self._kept(keyed.agg(*values) if values else keyed.agg(F.max("batch")), manifest)

    def _kept(self, rows: DataFrame, manifest: Manifest) -> DataFrame:
        limit = manifest.notes.get("keep_from")
        return rows.filter(F.col(self.kept_by) >= F.lit(limit).cast("timestamp")) if limit else rows

    def current(self, first: str | None = None, last: str | None = None, parts: Iterable[str] | None = None, before: int | None = None) -> DataFrame:
        """Current rows, of the parts from ``first`` to ``last`` or those given; only ``before`` a micro-batch, if named.

        Parts without newer batches are read as they are; only the others are merged by key.
        """
        manifest = self.manifest()
        live = self.live_batches(manifest, before)
        touched = {p for held in live.values() for p in held}
        chosen = {p for p in touched | set(manifest.parts) if (first is None or p >= first) and (last is None or p <= last)}
        chosen &= chosen if parts is None else set(parts)
        columns = [*self.schema.names, self.part]
        settled = self._kept(self.read(chosen - touched, manifest), manifest).select(*columns)
        if not chosen & touched:
            return settled
        return settled.unionByName(self._merged(manifest, live, chosen & touched).select(*columns))

    def compact(self, before: int | None = None) -> Manifest:
        """Fold finished micro-batches into the snapshot; those that the version before had folded in are deleted."""
        manifest = self.manifest()
        live = self.live_batches(manifest, before)
        if not live:
            return manifest
        touched = {p for held in live.values() for p in held}
        merged = self._merged(manifest, live, touched)
        made = self.publish(merged.select(*self.schema.names, self.part), touched, manifest, through=max(live))
        for name in files.names(self.spark, f"{self.path}/batches"):
            number = name.removeprefix("batch=")
            if number.isdigit() and int(number) <= manifest.notes.get("through", -1):
                files.delete(self.spark, f"{self.path}/batches/{name}")
        return made

    def purge(self, keep_from: str) -> int:
        """Drop rows older than ``keep_from`` for good, later arrivals among them; their number.

        Parts are days here.  Whole expired days go by their name; the day that the limit falls into is rewritten.
        """
        manifest = self.compact()
        day = keep_from[:10]
        expired = {p for p in manifest.parts if p <= day}
        rows = self.read(expired, manifest)
        old = F.col(self.kept_by) < F.lit(keep_from).cast("timestamp")
        number = self._kept(rows, manifest).filter(old).count()
        kept = rows.filter((F.col(self.part) == day) & ~old) if day in expired else None
        self.publish(kept, expired, manifest, keep_from=max(keep_from, manifest.notes.get("keep_from") or keep_from))
        return number
