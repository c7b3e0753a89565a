"""Text-line sources behind one interface: every source yields ``value, arrival_ts``.

``arrival_ts`` is stored with the data wherever the source can (broker timestamp,
file modification time), so that a replay puts lines into the same windows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillrank import schemas


@dataclass(frozen=True)
class KafkaLines:
    servers: str
    topic: str
    group_id: str
    starting_offsets: str = "latest"
    max_offsets_per_trigger: int | None = 10_000_000
    extra: dict[str, str] = field(default_factory=dict)

    def options(self, streaming: bool) -> dict[str, str]:
        opts = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.topic,
            "kafka.group.id": self.group_id,
        }
        if streaming:
            opts["startingOffsets"] = self.starting_offsets
            if self.max_offsets_per_trigger:
                opts["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        else:
            # A bounded read has no "latest" start; it covers what the topic holds.
            opts["startingOffsets"] = "earliest"
            opts["endingOffsets"] = "latest"
        return {**opts, **self.extra}


@dataclass(frozen=True)
class SocketLines:
    """Not replayable: after a failure, lines in flight are lost."""

    host: str
    port: int

    def options(self, streaming: bool) -> dict[str, str]:
        if not streaming:
            raise ValueError("a socket can only be read as a stream")
        return {"host": self.host, "port": str(self.port), "includeTimestamp": "true"}


@dataclass(frozen=True)
class FileLines:
    """No limit by default: files have no order in time, and a row of a later trigger can be too late."""

    path: str
    max_files_per_trigger: int | None = None

    def options(self, streaming: bool) -> dict[str, str]:
        if streaming and self.max_files_per_trigger:
            return {"maxFilesPerTrigger": str(self.max_files_per_trigger)}
        return {}


def read_lines(spark: SparkSession, spec: KafkaLines | SocketLines | FileLines, streaming: bool,
               place: bool = False) -> DataFrame:
    """``place`` adds a column of that name which orders lines as they arrived: by broker time, partition and
    offset, or by file time, file and part of the file. Lines of one place are in the order they are read."""
    opts = spec.options(streaming)
    place_of = (lambda *columns: [F.struct(*columns).alias("place")]) if place else (lambda *columns: [])
    reader = spark.readStream if streaming else spark.read
    match spec:
        case KafkaLines():
            return (
                reader.format("kafka").options(**opts).load()
                .select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("arrival_ts"),
                        *place_of("timestamp", "partition", "offset"))
            )
        case SocketLines():
            return (
                reader.format("socket").options(**opts).load()
                .select("value", F.col("timestamp").alias("arrival_ts"), *place_of("timestamp"))
            )
        case FileLines():
            return (
                reader.format("text").options(**opts).load(spec.path)
                .select("value", F.col("_metadata.file_modification_time").alias("arrival_ts"),
                        *place_of(*[F.col(f"_metadata.{c}").alias(c) for c in
                                    ("file_modification_time", "file_path", "file_block_start")]))
            )
    raise TypeError(f"not a line source: {spec!r}")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """A parquet table read as a stream of files; the schema comes from the table if not given."""
    schema = schema or spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # As a pattern the path may name a folder or one file; as a plain path only a folder.
    path = path.rstrip("/")
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def from_elements(spark: SparkSession, rows: Sequence[tuple],
                  schema: T.StructType = schemas.KEYED_VALUES) -> DataFrame:
    """Literal rows with their arrival order in a leading ``seq`` column."""
    return spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], schema)
