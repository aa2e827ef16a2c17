"""A keyed table kept up to date by streams: a merged base and the micro-batches since.

    query=<name>/life=<life>/batch_id=<n>/    what each micro-batch wrote
    base/<generation>/bucket=<b>/             merged rows, one per query and key
    manifest/<generation>/                    which batches the base holds, and where each
                                              of its buckets lies

A micro-batch adds a folder and touches nothing else. ``compact`` merges the finished
batches that no manifest names into the buckets they reach; the other buckets stay where
they are. Writing the manifest's one file is what makes a generation valid: a compaction
that dies before it leaves the table as it was, and the next one overwrites what it left.
A read opens the base and the batches after it, however long the table has been kept.

A key's bucket comes from ``bucket_by``. For windows that is their start, so that new
windows reach few buckets. The newest version of a key is that of the youngest life and,
in it, of the highest batch.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterflow.operators.keyed import newest_version
from meterflow.workspace import children, remove

BUCKETS = 64
VERSION = ["life", "batch_id"]


@dataclass(frozen=True)
class Manifest:
    """The batches that a base holds, as the highest one of each life, and its buckets' generations."""

    generation: int = 0
    upto: dict[str, int] = field(default_factory=dict)
    buckets: dict[str, int] = field(default_factory=dict)


class LiveTable:
    def __init__(self, spark: SparkSession, path: str, key: list[str], bucket_by: list[str] | None = None,
                 buckets: int = BUCKETS):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.bucket_by, self.buckets = bucket_by or key[:1], buckets

    # -- what there is ---------------------------------------------------------

    def manifests(self) -> Iterator[Manifest]:
        """The valid manifests, newest first."""
        for generation in reversed(children(self.spark, f"{self.path}/manifest")):
            here = f"{self.path}/manifest/{generation}"
            if any(f.startswith("part-") for f in children(self.spark, here)):
                yield Manifest(**json.loads(self.spark.read.text(here).first()[0]))

    def manifest(self) -> Manifest:
        return next(self.manifests(), Manifest())

    def batches(self) -> list[tuple[str, int]]:
        """(query=.../life=..., batch) of every finished batch, in order.

        A batch counts when it and all before it that are there have been committed: one
        that is being written now is left to the next reader.
        """
        found = []
        for query in children(self.spark, self.path):
            if not query.startswith("query="):
                continue
            for life in children(self.spark, f"{self.path}/{query}"):
                place = f"{query}/{life}"
                numbers = sorted(int(b.removeprefix("batch_id=")) for b in children(self.spark, f"{self.path}/{place}")
                                 if b.startswith("batch_id="))
                found += [(place, n) for n in numbers]
        return found

    def finished(self, place: str, batch: int) -> bool:
        return "_SUCCESS" in children(self.spark, f"{self.path}/{place}/batch_id={batch}")

    def fresh(self, manifest: Manifest) -> list[tuple[str, int]]:
        """Finished batches that the manifest's base does not hold."""
        found, closed = [], set()
        for place, batch in self.batches():
            if batch > manifest.upto.get(place, -1) and place not in closed:
                if self.finished(place, batch):
                    found.append((place, batch))
                else:
                    closed.add(place)
        return found

    # -- reading ---------------------------------------------------------------

    def _deltas(self, batches: list[tuple[str, int]]) -> DataFrame | None:
        if not batches:
            return None
        rows = self.spark.read.option("basePath", self.path).option("mergeSchema", "true").parquet(
            *[f"{self.path}/{place}/batch_id={batch}" for place, batch in batches])
        kinds = {"query": "string", "life": "string", "batch_id": "long"}
        return rows.withColumns({name: F.col(name).cast(kind) for name, kind in kinds.items()})

    def _base(self, manifest: Manifest, buckets: list[str] | None = None) -> DataFrame | None:
        places = [f"{self.path}/base/{generation:012d}/bucket={b}" for b, generation in manifest.buckets.items()
                  if buckets is None or b in buckets]
        return self.spark.read.parquet(*places) if places else None

    @staticmethod
    def _together(parts: list[DataFrame | None]) -> DataFrame | None:
        parts = [p for p in parts if p is not None]
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True) if parts else None

    def versions(self) -> DataFrame | None:
        """Rows of the base and of the batches since; None before the first batch."""
        manifest = self.manifest()
        return self._together([self._base(manifest), self._deltas(self.fresh(manifest))])

    def read(self, query: str | None = None) -> DataFrame | None:
        """The newest row of every key, of one query's rows if it is named. Filters on key
        columns reach the files of both parts, and the base's are sorted by the key."""
        versions = self.versions()
        if versions is None:
            return None
        if query is not None:
            versions = versions.where(F.col("query") == query)
        return self._newest(versions, self.key).drop("query", *VERSION)

    @staticmethod
    def _newest(versions: DataFrame, key: list[str]) -> DataFrame:
        return newest_version(versions.withColumn("_version", F.struct(*VERSION)), key, "_version").drop("_version")

    # -- writing ---------------------------------------------------------------

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")

    def compact(self) -> Manifest | None:
        """Merges the finished batches into the buckets they reach; None if there are none.

        What comes to the driver is the numbers of the buckets reached.
        """
        manifest = self.manifest()
        batches = self.fresh(manifest)
        if not batches:
            return None
        merged = self.merge(manifest, batches)
        self.commit(merged)
        return merged

    def merge(self, manifest: Manifest, batches: list[tuple[str, int]]) -> Manifest:
        """Writes the next generation's buckets and returns its manifest, which is not valid yet."""
        deltas, generation = self._deltas(batches), manifest.generation + 1
        reached = sorted(str(r[0]) for r in deltas.select(self._bucket()).distinct().collect())
        both = self._together([self._base(manifest, reached), deltas])
        newest = self._newest(both, [*self.key, "query"]).withColumn("bucket", self._bucket())
        (newest.hint("rebalance", "bucket").sortWithinPartitions("bucket", *self.key)
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/base/{generation:012d}"))
        upto = dict(manifest.upto)
        for place, batch in batches:
            upto[place] = max(batch, upto.get(place, -1))
        return Manifest(generation, upto, manifest.buckets | dict.fromkeys(reached, generation))

    def commit(self, manifest: Manifest) -> None:
        told = self.spark.createDataFrame([(json.dumps(vars(manifest)),)], "value string").coalesce(1)
        told.write.mode("overwrite").text(f"{self.path}/manifest/{manifest.generation:012d}")

    def vacuum(self, keep: int = 2) -> int:
        """Removes what no reader of the newest ``keep`` generations needs; returns how much.

        Batches go once all those generations hold them. A stream that reads the batches
        itself must have taken them before.
        """
        manifests = list(islice(self.manifests(), max(1, keep)))
        if not manifests:
            return 0
        held, gone = manifests[-1], []
        gone += [f"{place}/batch_id={batch}" for place, batch in self.batches() if batch <= held.upto.get(place, -1)]
        used = {f"{g:012d}/bucket={b}" for m in manifests for b, g in m.buckets.items()}
        newest = manifests[0].generation
        for generation in children(self.spark, f"{self.path}/base"):
            if int(generation) > newest:
                continue
            gone += [f"base/{generation}/{b}" for b in children(self.spark, f"{self.path}/base/{generation}")
                     if b.startswith("bucket=") and f"{generation}/{b}" not in used]
        kept = {f"{m.generation:012d}" for m in manifests}
        gone += [f"manifest/{g}" for g in children(self.spark, f"{self.path}/manifest") if int(g) <= newest and g not in kept]
        for place in gone:
            remove(self.spark, f"{self.path}/{place}")
        return len(gone)
