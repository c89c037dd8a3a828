"""Kafka source and sink option builders.

The Kafka connector is not on this image's classpath, so these build the option
maps only; :mod:`keytally.sources.recordlog` uses them with ``format("kafka")`` on a
cluster that has the connector. Tests exercise the same pipelines on file sources
with the record-log schema.
"""

from __future__ import annotations

from collections.abc import Sequence

from keytally import fixed_values as fv


def kafka_source_options(bootstrap_servers: str, topics: Sequence[str] | str,
                         starting_offsets: str = fv.STARTING_OFFSETS,
                         max_offsets_per_trigger: int | None = None,
                         min_partitions: int | None = None,
                         extra: dict[str, str] | None = None) -> dict[str, str]:
    """Options for ``readStream.format("kafka")``.

    ``starting_offsets`` is ``"earliest"``, ``"latest"`` or a JSON position map from
    :func:`keytally.operators.offsets.starting_offsets_json` (resume from saved
    positions). ``failOnDataLoss`` stays true: a gap in the log is an error, not a
    silent skip. ``minPartitions`` splits large topic partitions across more tasks.
    """
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topics if isinstance(topics, str) else ",".join(topics),
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "true",
    }
    if max_offsets_per_trigger is not None:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        opts["minPartitions"] = str(min_partitions)
    opts.update(extra or {})
    return opts


def kafka_sink_options(bootstrap_servers: str, topic: str | None = None,
                       acks: str = fv.PRODUCER_ACKS, extra: dict[str, str] | None = None) -> dict[str, str]:
    """Options for ``write.format("kafka")``; ``acks=all`` waits for all in-sync replicas.

    The writer flushes and awaits every send of a task before the task succeeds, so a
    finished write is durable; records are not awaited one by one.
    """
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "kafka.acks": acks}
    if topic is not None:
        opts["topic"] = topic
    opts.update(extra or {})
    return opts


def kafka_partitions(spark, bootstrap_servers: str, topics: Sequence[str] | str) -> dict[str, int] | None:
    """Partition count per topic, asked of the brokers through the connector's client; None without it."""
    names = topics.split(",") if isinstance(topics, str) else list(topics)
    jvm = spark.sparkContext._jvm
    if not _on_classpath(jvm, "org.apache.kafka.clients.admin.AdminClient"):
        return None
    config = jvm.java.util.Properties()
    config.put("bootstrap.servers", bootstrap_servers)
    client = jvm.org.apache.kafka.clients.admin.AdminClient.create(config)
    try:
        found = client.describeTopics(jvm.java.util.ArrayList(names)).allTopicNames().get()
        return {t: found.get(t).partitions().size() for t in names}
    finally:
        client.close()


def _on_classpath(jvm, name: str) -> bool:
    from py4j.protocol import Py4JJavaError
    try:
        jvm.java.lang.Class.forName(name, False, jvm.java.lang.Thread.currentThread().getContextClassLoader())
        return True
    except Py4JJavaError:
        return False
