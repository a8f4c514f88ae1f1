"""What the topic reader and writer ask Spark for; no broker is needed, and none is reached."""

from __future__ import annotations

from epigauge.sources.streams import kafka_records, kafka_send


class Recorder:
    """Stands for a reader, a writer and their frame: remembers what it is told."""

    def __init__(self):
        self.told, self.chosen = {}, ()

    readStream = property(lambda self: self)  # noqa: N815
    write = property(lambda self: self)

    def format(self, name):
        self.told["format"] = name
        return self

    def option(self, key, value):
        self.told[key] = value
        return self

    def options(self, **more):
        self.told |= more
        return self

    def load(self):
        return self

    def select(self, *columns):
        self.chosen = columns
        return self

    def save(self):
        self.told["saved"] = True


def test_the_reader_subscribes_to_one_topic(spark):
    asked = kafka_records(Recorder(), "one:9092,two:9092", "reports", options={"failOnDataLoss": "false"})
    assert asked.told == {
        "format": "kafka",
        "kafka.bootstrap.servers": "one:9092,two:9092",
        "subscribe": "reports",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    assert asked.chosen[0] == "value" and "arrived" in str(asked.chosen[1])


def test_where_a_new_checkpoint_starts_can_be_chosen(spark):
    assert kafka_records(Recorder(), "one:9092", "reports", "earliest").told["startingOffsets"] == "earliest"


def test_the_writer_sends_values_to_the_topic():
    sent = Recorder()
    kafka_send(sent, "one:9092", "reports")
    assert sent.told == {"format": "kafka", "kafka.bootstrap.servers": "one:9092", "topic": "reports", "saved": True}
    assert sent.chosen == ("value",)
