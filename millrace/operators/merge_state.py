"""The merge of duplicates kept up to date, batch by batch.

A merged value is the smallest (rank, position) among the rows of a key, so merges of parts can be merged again. The
state holds that partial for every key and column, in folders by bucket of the key. A batch is merged for itself, meets
the state of the buckets that its keys fall into, and only those are written anew; a pointer file says which folder
each bucket has and which batches are in it, so that a batch that comes again changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import catalog as C
from millrace.operators.dedup import GROUP_SIZE, KEY, SOURCES, _best, _group_key, _lineage
from millrace.operators.load import read_pointer, swap_pointer

BUCKET = "_bucket"
_FIRST = "_first_"


class MergeState:
    """Mergeable partials of :func:`millrace.operators.dedup.dedup_merge` below ``root``.

    ``schema`` is that of the rows, with the arrival position in ``order``; positions must differ between batches.
    ``sources`` lists the sources that can occur, where the rows name them in ``source``.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        keys: Sequence[str],
        order: str = C.ORDER_COLUMN,
        source: str | None = C.SOURCE_COLUMN,
        sources: Sequence[str] = tuple(C.SOURCE_RANKS),
        null_keys: str = "merge",
        buckets: int = 64,
    ):
        self.spark, self.root, self.schema, self.keys, self.order = spark, root.rstrip("/"), schema, list(keys), order
        self.source = source if source in schema.names else None
        self.sources, self.null_keys = list(sources) if self.source else [], null_keys
        state = read_pointer(spark, self.root) or {"buckets": buckets, "folders": {}, "batches": []}
        self.buckets: int = state["buckets"]
        self.folders: dict[int, str] = {int(b): v for b, v in state["folders"].items()}
        self.batches: list[str] = state["batches"]

    @property
    def _values(self) -> list[str]:
        return [c for c in self.schema.names if c != self.order]

    def partials(self, rows: DataFrame) -> DataFrame:
        """One row for each key of a batch: (key, bucket, a partial of every column, first positions, size)."""
        position = F.col(self.order)
        keyed = rows.select(*self.schema.names).withColumn(KEY, _group_key(rows, self.keys, self.order, self.null_keys))
        unlisted = []
        if self.source:
            # A source outside the list would be lost from the lineage without a word.
            odd = F.col(self.source).isNotNull() & ~F.col(self.source).isin(*self.sources)
            unlisted = [F.count_if(odd).alias("_unlisted")]
        merged = keyed.groupBy(KEY).agg(
            *[_best(rows, c, position).alias(c) for c in self._values],
            F.min(position).alias(self.order),
            F.count(F.lit(1)).alias(GROUP_SIZE),
            *[F.min(F.when(F.col(self.source) == s, position)).alias(f"{_FIRST}{i}") for i, s in enumerate(self.sources)],
            *unlisted,
        )
        if unlisted:
            stop = F.raise_error(F.lit("a source outside the list given to MergeState")).cast("boolean")
            merged = merged.where(F.when(F.col("_unlisted") > 0, stop).otherwise(F.lit(True))).drop("_unlisted")
        return merged.withColumn(BUCKET, F.pmod(F.xxhash64(KEY), F.lit(self.buckets)).cast("int"))

    def _together(self, partials: DataFrame) -> DataFrame:
        least = [*self._values, self.order, *[f"{_FIRST}{i}" for i in range(len(self.sources))]]
        return partials.groupBy(BUCKET, KEY).agg(*[F.min(c).alias(c) for c in least], F.sum(GROUP_SIZE).alias(GROUP_SIZE))

    def _stored(self, schema: T.StructType, buckets: Sequence[int] | None = None) -> DataFrame | None:
        paths = [f"{self.root}/{v}/{BUCKET}={b}" for b, v in sorted(self.folders.items()) if buckets is None or b in buckets]
        if not paths:
            return None
        # The bucket's number stands in the path.
        own = T.StructType([f for f in schema if f.name != BUCKET])
        return self.spark.read.schema(own).parquet(*paths).withColumn(BUCKET, F.pmod(F.xxhash64(KEY), F.lit(self.buckets)).cast("int"))

    def add(self, rows: DataFrame, batch: str) -> list[int]:
        """Merge a batch into the state; returns the buckets that were written, none for a batch that is in already."""
        if batch in self.batches:
            return []
        new = self.partials(rows)
        version = f"v-{uuid.uuid4().hex}"
        # Written once: it says which buckets are touched, and is then merged with them.
        path = f"{self.root}/batch-{version}"
        new.write.parquet(path)
        new = self.spark.read.schema(new.schema).parquet(path)
        touched = sorted(r[BUCKET] for r in new.select(BUCKET).distinct().collect())
        old = self._stored(new.schema, touched)
        merged = new if old is None else self._together(new.unionByName(old))
        # A bucket is cut into as many files as tasks hold parts of it; rows of one bucket lie together.
        merged.repartition(BUCKET, F.pmod(F.xxhash64(F.lit(7), KEY), F.lit(4))).write.partitionBy(BUCKET).parquet(f"{self.root}/{version}")
        folders = self.folders | dict.fromkeys(touched, version)
        swap_pointer(
            self.spark,
            self.root,
            {"buckets": self.buckets, "folders": {str(b): v for b, v in folders.items()}, "batches": [*self.batches, batch]},
        )
        self.folders, self.batches = folders, [*self.batches, batch]
        return touched

    def merged(self) -> DataFrame:
        """The merged rows, as :func:`dedup_merge` gives them for all batches together."""
        empty = self.partials(self.spark.createDataFrame([], self.schema))
        stored = self._stored(empty.schema)
        rows = empty if stored is None else stored
        out = rows.select(*[F.col(c) if c == self.order else F.col(c)["value"].alias(c) for c in self.schema.names], GROUP_SIZE, *[f"{_FIRST}{i}" for i in range(len(self.sources))])
        if not self.source:
            return out
        seen = F.array(
            *[F.when(F.col(f"{_FIRST}{i}").isNotNull(), F.struct(F.col(f"{_FIRST}{i}").alias("p"), F.lit(s).alias("s"))) for i, s in enumerate(self.sources)]
        )
        names = F.transform(F.array_sort(F.filter(seen, lambda x: x.isNotNull())), lambda x: x["s"])
        return out.select(*self.schema.names, GROUP_SIZE, _lineage(F.array_join(names, ","), names).alias(SOURCES))
