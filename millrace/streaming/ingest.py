"""Ingestion of envelopes into staging with Structured Streaming.

The checkpoint takes the place of acknowledgements: a batch that was not finished is run again, and
writing it again replaces what the first attempt left. Lines that are no sound envelope, and records
that do not fit their table, go to a table of their own instead of getting lost.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import catalog as C
from millrace.operators.staging import (
    MAX_CHUNK,
    UNCASTABLE,
    arrival_position,
    empty_staging,
    inserted_at,
    staged_schema,
    staging_length,
    typed_columns,
)
from millrace.session import hadoop_path
from millrace.streaming.envelopes import ENVELOPE_SCHEMA
from millrace.streaming.progress import UNKNOWN, IngestProgress

# What one batch reads at most; its text is persisted while its three outputs are written.
MAX_BYTES = 8 << 30
REASON = "reason"
MESSAGE = "__message"
FITS = "fits"


@dataclass(frozen=True)
class StagingArea:
    """Folders of an ingestion: rows, those that fit their table and those that do not; lines; counters."""

    root: str

    @property
    def rows(self) -> str:
        return f"{self.root.rstrip('/')}/rows"

    @property
    def dead_letters(self) -> str:
        return f"{self.root.rstrip('/')}/dead_letters"

    @property
    def counters(self) -> str:
        return f"{self.root.rstrip('/')}/counters"


def parse_envelopes(lines: DataFrame, catalog: C.Catalog = C.DEFAULT_CATALOG) -> DataFrame:
    """Envelope fields of every line, and in ``reason`` what is wrong with it, if anything."""
    kept = [c for c in lines.columns if c not in ENVELOPE_SCHEMA.names]
    parsed = lines.select(*kept, F.from_json("value", ENVELOPE_SCHEMA).alias("e")).select(*kept, "e.*")
    tables = [t.name for t in catalog]
    records = F.col("records")
    reason = (
        F.when(F.col("table").isNull() | records.isNull(), "not an envelope")
        .when(~F.col("table").isin(*tables), "unknown table")
        .when(F.col("source").isNull(), "no source")
        .when(F.col("recordCount") != F.size(records), "wrong record count")
        .when(F.size(records) > MAX_CHUNK, "too many records")
    )
    return parsed.withColumn(REASON, reason)


def describe_messages(lines: DataFrame, catalog: C.Catalog = C.DEFAULT_CATALOG) -> DataFrame:
    """What is known of every message but its records; the text is kept of those that are not sound."""
    parsed = parse_envelopes(lines, catalog)
    return parsed.select(
        MESSAGE, "source", "table", "batch", "recordCount", REASON,
        F.size("records").alias("n_records"),
        F.xxhash64("value").alias("__hash"),
        F.when(F.col(REASON).isNotNull(), F.col("value")).alias("value"),
    )


def number_messages(described: DataFrame) -> DataFrame:
    """``message``: consecutive numbers of the sound envelopes of a table, in the order of their chunks.

    Chunks of one number, as of two publishes or of messages that are no chunks, follow a hash of their text.
    Only numbers and hashes are sorted, for each table on its own.
    """
    order = Window.partitionBy("source", "table").orderBy(F.coalesce("batch", F.lit(1)), "__hash", MESSAGE)
    return described.where(F.col(REASON).isNull()).select(MESSAGE, (F.row_number().over(order) - 1).alias("message"))


def explode_records(lines: DataFrame, numbers: DataFrame, catalog: C.Catalog = C.DEFAULT_CATALOG) -> DataFrame:
    """One row per record of the numbered lines, with the place of the record in its message.

    Text meets the numbers, which is narrower than parsed records; it is parsed behind the join.
    """
    envelopes = parse_envelopes(lines.join(numbers, MESSAGE), catalog)
    return envelopes.select("source", "table", "message", F.posexplode("records").alias("place", "record"))


def typed_rows(records: DataFrame, catalog: C.Catalog, ranks: dict[str, int], batch_id: int = 0) -> DataFrame:
    """Staging rows of all tables side by side: one frame with the columns of all, typed once.

    ``_uncastable`` lists what keeps a record from its table: values that do not fit, and columns
    the table does not have.
    """
    columns = {c.name: c for t in catalog for c in t.columns}
    catalog.wide_columns  # raises where tables disagree on a type

    def longest(c: C.Column) -> Column | None:
        # Tables differ in the limit of a column of the same name.
        limits = {t.name: staging_length(own) for t in catalog for own in t.columns if own.name == c.name}
        limited = [F.lit(x) for pair in limits.items() if pair[1] is not None for x in pair]
        return F.try_element_at(F.create_map(*limited), F.col("table")) if limited else None

    casts, misfits = typed_columns(list(columns.values()), lambda name: F.try_element_at("record", F.lit(name)), longest)
    known = F.create_map(
        *[x for t in catalog for x in (F.lit(t.name), F.array(*[F.lit(c) for c in t.column_names]))]
    )
    unknown = F.array_except(F.map_keys("record"), F.try_element_at(known, F.col("table")))
    rank = F.coalesce(
        F.try_element_at(F.create_map(*[F.lit(x) for pair in ranks.items() for x in pair]), F.col("source")),
        F.lit(len(ranks)),
    )
    return records.select(
        *[casts[name].alias(name) for name in columns],
        F.col("source").alias(C.SOURCE_COLUMN),
        inserted_at().alias(C.INSERTED_AT_COLUMN),
        arrival_position(rank, F.lit(batch_id), F.col("message"), F.col("place")).alias(C.ORDER_COLUMN),
        F.concat(misfits, unknown).alias(UNCASTABLE),
        F.col("table").alias("table_name"),
        F.when(F.size(F.concat(misfits, unknown)) > 0, F.to_json("record")).alias("record"),
    )


def _counters(described: DataFrame) -> DataFrame:
    return described.groupBy(
        F.coalesce("source", F.lit("unknown")).alias("source"),
        F.coalesce("table", F.lit("unknown")).alias("table_name"),
    ).agg(
        F.count_if(F.col(REASON).isNull()).alias("processed_messages"),
        F.coalesce(F.sum(F.when(F.col(REASON).isNull(), F.col("n_records"))), F.lit(0)).cast("bigint").alias("total_records"),
        F.count_if(F.col(REASON).isNotNull()).alias("rejected_messages"),
    )


def _tally(described: DataFrame, catalog: C.Catalog) -> list[tuple[str, int, int]]:
    """(table, messages, records as they say) of a batch: one row per table of the catalogue at most, and one for others."""
    table = F.when(F.col("table").isin(*[t.name for t in catalog]), F.col("table")).otherwise(UNKNOWN)
    counts = described.groupBy(table.alias("name")).agg(F.count(F.lit(1)), F.coalesce(F.sum("recordCount"), F.lit(0)))
    return [tuple(r) for r in counts.collect()]


def stage_batch(
    area: StagingArea,
    catalog: C.Catalog = C.DEFAULT_CATALOG,
    ranks: dict[str, int] | None = None,
    stream: str = "s",
    first_batch: int = 0,
    finished: Callable[[str, list[tuple[str, int, int]]], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """The function that writes one micro-batch; the folder of the batch is replaced as a whole.

    ``first_batch`` is added to the number of the batch in arrival positions. ``finished`` is told the folder of a
    batch that has been written, with the messages and records of each table.
    """
    order = dict(C.SOURCE_RANKS if ranks is None else ranks)

    def write(lines: DataFrame, batch_id: int) -> None:
        folder = f"ingest={stream}-{batch_id}"
        # Text and one narrow row per message are held, but no parsed records, which are several times as wide.
        held = lines.select("value", F.monotonically_increasing_id().alias(MESSAGE)).persist()
        described = describe_messages(held, catalog).persist()
        try:
            # The first pass fills both, before branches of one plan ask for them side by side.
            tally = _tally(described, catalog)
            records = explode_records(held, number_messages(described), catalog)
            typed_rows(records, catalog, order, first_batch + batch_id).withColumn(
                FITS, F.size(UNCASTABLE) == 0
            ).write.mode("overwrite").partitionBy(FITS, "table_name", C.SOURCE_COLUMN).parquet(
                f"{area.rows}/{folder}"
            )
            described.where(F.col(REASON).isNotNull()).select("value", REASON).write.mode("overwrite").parquet(
                f"{area.dead_letters}/{folder}"
            )
            _counters(described).write.mode("overwrite").parquet(f"{area.counters}/{folder}")
        finally:
            described.unpersist()
            held.unpersist()
        if finished is not None:
            finished(f"{area.root}/{folder}", tally)

    return write


def read_lines(spark: SparkSession, landing: str, max_files: int | None = None, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Lines that land in a folder, in batches of bounded size: of files if ``max_files`` is given, else of bytes."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    else:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.text(landing)


def once_within(lines: DataFrame, delay: str) -> DataFrame:
    """The lines of a stream without messages that arrived before, within a time such as ``7 days``.

    A message is its source, table, batch number and records: the time of publishing is none of it, so that a chunk
    that is published again is known again. What has arrived is kept as state, by its hash, until no message of its
    time can be repeated any more; the clock of the batches decides, so that no message is ever too late to be staged.
    Lines that are no envelope count as the same if their text is.
    """
    part = lambda name: F.get_json_object("value", f"$.{name}")
    named = lines.select(
        "value",
        part("source").alias("_source"),
        part("table").alias("_table"),
        part("batch").alias("_batch"),
        F.sha2(F.coalesce(part("records"), F.col("value")), 256).alias("_hash"),
        F.current_timestamp().alias("_at"),
    )
    fresh = named.withWatermark("_at", delay).dropDuplicatesWithinWatermark(["_source", "_table", "_batch", "_hash"])
    return fresh.select("value")


def _drain(stream: DataFrame, function: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    query = (
        stream.writeStream.foreachBatch(function)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest(
    spark: SparkSession,
    landing: str,
    checkpoint: str,
    area: StagingArea,
    sources: Sequence[str] = tuple(C.SOURCE_RANKS),
    catalog: C.Catalog = C.DEFAULT_CATALOG,
    ranks: dict[str, int] | None = None,
    max_files: int | None = None,
    require: bool = False,
    stream: str | None = None,
    first_batch: int = 0,
    once: str | None = None,
    progress: IngestProgress | None = None,
) -> None:
    """Stage everything that has landed, source after source; running it again stages only what is new.

    ``once`` stages a message that lands again within that time only once, see :func:`once_within`; a checkpoint is
    begun either with it or without. ``progress`` counts messages and records while the streams run.

    Another landing folder for the same area needs a checkpoint and a ``stream`` of its own, and as
    ``first_batch`` a number beyond the batches staged so far. A source without a folder has published nothing yet; with ``require`` that is an error.
    """
    for source in sources:
        path = f"{landing.rstrip('/')}/{source}"
        fs, handle = hadoop_path(spark, path)
        if not fs.exists(handle):
            if require:
                raise FileNotFoundError(f"nothing has landed for {source}: {path}")
            continue
        name = source if stream is None else f"{source}-{stream}"
        finished = None if progress is None else partial(progress.finished, source)
        function = stage_batch(area, catalog, ranks, name, first_batch, finished)
        lines = read_lines(spark, path, max_files)
        if once is not None:
            lines = once_within(lines, once)
        _drain(lines, function, f"{checkpoint.rstrip('/')}/{source}")


def ingest_with(
    spark: SparkSession,
    landing: str,
    checkpoint: str,
    function: Callable[[DataFrame, int], None],
    catalog: C.Catalog = C.DEFAULT_CATALOG,
    dead_letters: str | None = None,
    max_files: int | None = None,
) -> None:
    """Hand every batch of sound envelopes to a function; the others go to ``dead_letters``, if given.

    An error in the function fails the batch, which then runs again on the next start.
    """

    def call(lines: DataFrame, batch_id: int) -> None:
        parsed = parse_envelopes(lines, catalog).persist()
        try:
            if dead_letters is not None:
                bad = parsed.where(F.col(REASON).isNotNull()).select("value", REASON)
                bad.write.mode("overwrite").parquet(f"{dead_letters.rstrip('/')}/ingest={batch_id}")
            function(parsed.where(F.col(REASON).isNull()).drop("value", REASON), batch_id)
        finally:
            parsed.unpersist()

    _drain(read_lines(spark, landing, max_files), call, checkpoint)


def read_staged(
    spark: SparkSession, area: StagingArea, catalog: C.Catalog = C.DEFAULT_CATALOG
) -> dict[str, DataFrame]:
    """All staging tables of an ingestion; the read prunes to the folders and columns of the table."""
    rows = _read_rows(spark, area, catalog)
    if rows is None:
        return {t.name: empty_staging(spark, t) for t in catalog}
    return {
        t.name: rows.where(F.col(FITS) & (F.col("table_name") == t.name)).select(*staged_schema(t).fieldNames())
        for t in catalog
    }


def _read_rows(spark: SparkSession, area: StagingArea, catalog: C.Catalog) -> DataFrame | None:
    fs, handle = hadoop_path(spark, area.rows)
    if not fs.exists(handle):
        return None
    lineage = [
        T.StructField(C.INSERTED_AT_COLUMN, T.StringType()),
        T.StructField(C.ORDER_COLUMN, T.LongType()),
        T.StructField(UNCASTABLE, T.ArrayType(T.StringType())),
        T.StructField("record", T.StringType()),
    ]
    partitions = [
        T.StructField("ingest", T.StringType()),
        T.StructField(FITS, T.BooleanType()),
        T.StructField("table_name", T.StringType()),
        T.StructField(C.SOURCE_COLUMN, T.StringType()),
    ]
    wide = [T.StructField(name, dtype) for name, dtype in catalog.wide_columns.items()]
    return spark.read.schema(T.StructType([*wide, *lineage, *partitions])).parquet(area.rows)


def read_dead_letters(spark: SparkSession, area: StagingArea) -> DataFrame:
    return spark.read.schema("value string, reason string, ingest string").parquet(area.dead_letters)


def read_rejects(spark: SparkSession, area: StagingArea, catalog: C.Catalog = C.DEFAULT_CATALOG) -> DataFrame:
    """Records that do not fit their table, as text, with the columns at fault."""
    columns = ["table_name", C.SOURCE_COLUMN, C.ORDER_COLUMN, UNCASTABLE, "record"]
    rows = _read_rows(spark, area, catalog)
    if rows is None:
        return spark.createDataFrame(
            [], f"table_name string, source string, {C.ORDER_COLUMN} bigint, {UNCASTABLE} array<string>, record string"
        )
    return rows.where(~F.col(FITS)).select(*columns)


def ingest_counters(spark: SparkSession, area: StagingArea) -> DataFrame:
    """Messages and records by source and table, over all batches so far."""
    schema = "source string, table_name string, processed_messages bigint, total_records bigint, rejected_messages bigint, ingest string"
    return (
        spark.read.schema(schema)
        .parquet(area.counters)
        .groupBy("source", "table_name")
        .agg(
            *[F.sum(c).alias(c) for c in ("processed_messages", "total_records", "rejected_messages")],
        )
    )
