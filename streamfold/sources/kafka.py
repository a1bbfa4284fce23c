"""Kafka topic scans (SRC-01..SRC-07, SRC-10) and their local twin.

The Kafka connector jar is not part of a plain PySpark install, so the
reader is an option builder around ``format("kafka")``; tests run the same
operators on a parquet directory holding the Kafka record layout.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codecs import decode_json
from ..schemas import KAFKA_RECORD


@dataclass
class TlsOptions:
    """SRC-07: mutual TLS with PEM files, passed through to the client.
    ``keystore_location`` is one file with the private key and the
    certificate chain; the client reads a PEM key from no other file."""
    ca_location: str
    keystore_location: str
    key_password: str | None = None

    def options(self) -> dict[str, str]:
        opts = {
            "kafka.security.protocol": "SSL",
            "kafka.ssl.truststore.type": "PEM",
            "kafka.ssl.truststore.location": self.ca_location,
            "kafka.ssl.keystore.type": "PEM",
            "kafka.ssl.keystore.location": self.keystore_location,
        }
        if self.key_password:
            opts["kafka.ssl.key.password"] = self.key_password
        return opts


@dataclass
class TopicScan:
    """Options for one topic scan in one consumer group.

    * ``starting_offsets``: SRC-02 (``earliest`` / ``latest``)
    * ``max_records_per_trigger`` / ``min_records_per_trigger`` /
      ``max_trigger_delay``: SRC-03 read sizing
    * ``min_partitions``: SRC-05, split topic partitions further
    * ``include_headers``: SRC-06
    * ``group_id``: SRC-04; each streaming query also needs its own checkpoint
    """
    bootstrap_servers: str
    topics: list[str] = field(default_factory=list)
    pattern: str | None = None
    group_id: str | None = None
    starting_offsets: str = "earliest"
    max_records_per_trigger: int | None = None
    min_records_per_trigger: int | None = None
    max_trigger_delay: str | None = None
    min_partitions: int | None = None
    include_headers: bool = True
    tls: TlsOptions | None = None
    extra: dict[str, str] = field(default_factory=dict)

    def options(self, streaming: bool = True) -> dict[str, str]:
        if not streaming and self.starting_offsets == "latest":
            raise ValueError("a batch read cannot start at the latest offsets")
        o = {"kafka.bootstrap.servers": self.bootstrap_servers,
             "startingOffsets": self.starting_offsets,
             "includeHeaders": str(self.include_headers).lower(),
             "failOnDataLoss": "true"}
        if self.pattern:
            o["subscribePattern"] = self.pattern
        else:
            o["subscribe"] = ",".join(self.topics)
        if self.group_id:
            o["kafka.group.id"] = self.group_id
        if streaming:
            if self.max_records_per_trigger:
                o["maxOffsetsPerTrigger"] = str(self.max_records_per_trigger)
            if self.min_records_per_trigger:
                o["minOffsetsPerTrigger"] = str(self.min_records_per_trigger)
            if self.max_trigger_delay:
                o["maxTriggerDelay"] = self.max_trigger_delay
        else:
            o["endingOffsets"] = "latest"
        if self.min_partitions:
            o["minPartitions"] = str(self.min_partitions)
        if self.tls:
            o.update(self.tls.options())
        o.update(self.extra)
        return o

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.format("kafka").options(**self.options(False)).load()

    def read_stream(self, spark: SparkSession) -> DataFrame:
        return spark.readStream.format("kafka").options(**self.options(True)).load()


def sink_options(bootstrap_servers: str, topic: str | None = None,
                 acks: str = "all", retries: int = 10,
                 tls: TlsOptions | None = None) -> dict[str, str]:
    """SNK-01/02/09: Kafka sink options (at least once, ``acks=all``)."""
    o = {"kafka.bootstrap.servers": bootstrap_servers, "kafka.acks": acks,
         "kafka.retries": str(retries), "kafka.enable.idempotence": "false"}
    if topic:
        o["topic"] = topic
    if tls:
        o.update(tls.options())
    return o


def read_record_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                       glob: str | None = None) -> DataFrame:
    """Local twin of a topic stream: parquet files in the Kafka record layout
    (``key, value, topic, partition, offset, timestamp, timestampType``)."""
    r = spark.readStream.schema(KAFKA_RECORD)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.parquet(path)


def decode_value(records: DataFrame, schema, keep=("key", "topic", "partition", "offset")
                 ) -> DataFrame:
    """SRC-08: record scan plus typed JSON decode of the value (COD-01);
    fields that do not decode are NULL and ``_corrupt`` holds the text."""
    return records.select(*[F.col(c) for c in keep],
                          decode_json("value", schema).alias("v")).select(*keep, "v.*")
