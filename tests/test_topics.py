"""Options and rows of Kafka topics, without a connector."""

import pytest
from pyspark.sql import functions as F

from tidewatch.sources import credit


@pytest.mark.parametrize("start,offsets", [("earliest", "earliest"), ("latest", "latest"), ({"0": 23, "1": -2}, '{"t": {"0": 23, "1": -2}}')])
def test_start_positions_and_properties(start, offsets):
    got = credit.reading("t", start, {"bootstrap.servers": "h:9092", "kafka.group.id": "g"}, {"maxOffsetsPerTrigger": 5000, "failOnDataLoss": "false"})
    assert got == {"subscribe": "t", "startingOffsets": offsets, "kafka.bootstrap.servers": "h:9092", "kafka.group.id": "g", "maxOffsetsPerTrigger": 5000, "failOnDataLoss": "false"}
    assert credit.reading("t") == {"subscribe": "t", "startingOffsets": "latest"}


def test_a_reader_gets_these_options(monkeypatch):
    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def load(self):
            raise StopIteration

    class Session:
        readStream = Reader()  # noqa: N815

    with pytest.raises(StopIteration):
        credit.read_topic(Session(), "t", "a int", "a", start={"0": 1}, options={"x": "y"}, reader_options={"maxOffsetsPerTrigger": 7})
    assert seen == {"format": "kafka", "subscribe": "t", "startingOffsets": '{"t": {"0": 1}}', "kafka.x": "y", "maxOffsetsPerTrigger": 7}


def test_rows_of_a_sink(spark):
    df = spark.createDataFrame([("P1", 7), (None, 8)], "k string, v int")
    assert [r.value for r in credit.topic_rows(df).collect()] == ['{"k":"P1","v":7}', '{"v":8}']
    assert credit.topic_rows(df, "k").columns == ["value", "key"]
    own = credit.topic_rows(df, F.upper("k"), F.pmod(F.col("v"), F.lit(3)))
    assert own.dtypes == [("value", "string"), ("key", "string"), ("partition", "int")] and [(r.key, r.partition) for r in own.collect()] == [("P1", 1), (None, 2)]
    assert [r.partition for r in credit.topic_rows(df, partition="v").collect()] == [7, 8]
