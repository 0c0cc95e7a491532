"""The change-message stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfstream import schemas

# Reader settings a caller may override.
KAFKA_SETTINGS = {
    "kafka.sasl.mechanism": "PLAIN",
    "kafka.security.protocol": "SASL_SSL",
    "kafka.request.timeout.ms": "60000",
    "kafka.session.timeout.ms": "60000",
}
# A live sample. It starts at the newest message, goes on if messages were
# lost, and reads few of them at a time.
LIVE_SAMPLE = {
    "failOnDataLoss": "false",
    "startingOffsets": "latest",
    "maxOffsetsPerTrigger": "100",
}
# All messages from the first on; a loss is an error.
EVERYTHING = {"failOnDataLoss": "true", "startingOffsets": "earliest"}
_NEEDED = ("subscribe", "kafka.bootstrap.servers", "kafka.sasl.jaas.config")


def kafka_options(
    options: dict[str, str], preset: dict[str, str] | None = None
) -> dict[str, str]:
    """Reader options: the settings above and a preset, under the caller's own.

    The preset is :data:`EVERYTHING` unless another, such as :data:`LIVE_SAMPLE`, is given.

    Topic, servers and login always come from the caller.
    """
    missing = [name for name in _NEEDED if name not in options]
    if missing:
        raise ValueError(f"missing options: {', '.join(missing)}")
    return {**KAFKA_SETTINGS, **(EVERYTHING if preset is None else preset), **options}


def read_change_stream(
    spark: SparkSession, source: str = "kafka", options: dict[str, str] | None = None
) -> DataFrame:
    """Messages in the fixed envelope.

    ``source`` is ``kafka`` (the connector must be on the class path), or a file format
    whose files hold the same envelope, with ``path`` among the options.
    """
    options = dict(options or {})
    if source == "kafka":
        return spark.readStream.format("kafka").options(**kafka_options(options)).load()
    return (
        spark.readStream.format(source).schema(schemas.ENVELOPE).options(**options).load()
    )
