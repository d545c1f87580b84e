"""Kafka source and sink. The connector package must be on the session's classpath."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


@dataclass(frozen=True)
class KafkaAccess:
    servers: str
    user: str
    password: str
    truststore: str | None = None
    truststore_password: str | None = None

    def options(self) -> dict[str, str]:
        """SASL_SSL with SCRAM-SHA-512."""
        login = "org.apache.kafka.common.security.scram.ScramLoginModule required"
        options = {
            "kafka.bootstrap.servers": self.servers,
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "SCRAM-SHA-512",
            "kafka.sasl.jaas.config": f'{login} username="{self.user}" password="{self.password}";',
        }
        if self.truststore:
            options["kafka.ssl.truststore.location"] = self.truststore
            options["kafka.ssl.truststore.password"] = self.truststore_password or ""
        return options


def source_options(access: KafkaAccess, topic: str, max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """From the earliest offset, going on when old messages have expired."""
    options = {
        **access.options(),
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_messages(spark: SparkSession, access: KafkaAccess, topic: str, **kw) -> DataFrame:
    return spark.readStream.format("kafka").options(**source_options(access, topic, **kw)).load()


def write_messages(messages: DataFrame, access: KafkaAccess, checkpoint: str, topic: str | None = None) -> StreamingQuery:
    """Start an append query. Without ``topic``, each row's own ``topic`` column decides."""
    writer = messages.writeStream.format("kafka").options(**access.options()).outputMode("append")
    if topic:
        writer = writer.option("topic", topic)
    return writer.option("checkpointLocation", checkpoint).start()


def send_messages(messages: DataFrame, access: KafkaAccess, topic: str) -> None:
    """Batch write of a ``value`` column, from the executors."""
    messages.select("value").write.format("kafka").options(**access.options()).option("topic", topic).save()
