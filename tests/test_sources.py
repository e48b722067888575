from __future__ import annotations

import pytest
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.landing import land
from tidemark.sources import jdbc
from tidemark.session import scratch_path
from tidemark.sources.connector import Read, custom_query, load
from tidemark.sources.files import (
    file_count,
    file_inventory,
    infer_schema,
    latest_modification,
    read_files,
)
from tidemark.sources.jdbc import (
    DIALECTS,
    Dialect,
    bounds_query,
    column_cuts,
    count_query,
    equi_depth_predicates,
    even_split_read,
    jdbc_read,
    max_query,
    sliced,
    split_options,
    split_predicates,
)
from tidemark.sources.kafka import complete_start, kafka_read, kafka_stream, kafka_write_options, send
from tidemark.sources.nosql import cassandra_read, dynamodb_read, mongodb_above, mongodb_max, mongodb_read
from tidemark.sources.storage import configure_s3a, s3a_access, s3a_settings

WHO = {"username": "u", "password": "p"}


def postgres(**more):
    dialect = DIALECTS["sql"]
    return jdbc_read(dialect, dialect.address("h", 5432, "db"), credentials=WHO, **more)


def test_postgres_options():
    assert postgres(table="public.orders").options == {
        "url": "jdbc:postgresql://h:5432/db",
        "driver": "org.postgresql.Driver",
        "dbtable": "public.orders",
        "user": "u",
        "password": "p",
        "fetchsize": "10000",
    }


def test_mysql_url():
    url = DIALECTS["mysql"].address("h", 3306, "db")
    assert url == "jdbc:mysql://h:3306/db?useSSL=false&allowPublicKeyRetrieval=true"
    assert DIALECTS["mysql"].driver == "com.mysql.cj.jdbc.Driver"


def test_another_dialect_is_one_line():
    read = jdbc_read(Dialect("d.Driver", "jdbc:d://{host}/{database}"), "jdbc:d://h/db", table="t")
    assert read.options["driver"] == "d.Driver" and "user" not in read.options


def test_query_replaces_table_and_read_options_win():
    read = postgres(query="SELECT 1", fetch_size=5, read_options={"fetchsize": 7, "queryTimeout": 9})
    assert read.options["dbtable"] == "(SELECT 1) AS subq"
    assert read.options["fetchsize"] == "7" and read.options["queryTimeout"] == "9"
    with pytest.raises(ValueError):
        postgres(table="t", query="q")
    with pytest.raises(ValueError):
        postgres()


def test_partition_options_go_together():
    full = split_options("id", 1, 100, 8)
    assert full == {"partitionColumn": "id", "lowerBound": "1", "upperBound": "100", "numPartitions": "8"}
    assert postgres(table="t", read_options=full).options["numPartitions"] == "8"
    with pytest.raises(ValueError):
        postgres(table="t", read_options={"partitionColumn": "id"})
    assert split_options("id", None, None, 8) == {}
    assert split_options("id", 5, 5, 8)["upperBound"] == "6"


def test_aggregates_run_in_the_database():
    read = postgres(table="public.orders", schema="id BIGINT", read_options=split_options("id", 1, 9, 2))
    assert read.options["customSchema"] == "id BIGINT"
    top = max_query(read, "updated_at").options
    assert top["query"] == "SELECT MAX(updated_at) AS checkpoint_to FROM public.orders"
    assert not {"dbtable", "customSchema", "partitionColumn", "numPartitions"} & set(top)
    assert count_query(read).options["query"] == "SELECT COUNT(*) AS cnt FROM public.orders"
    assert "MIN(id) AS low, MAX(id) AS high" in bounds_query(read, "id").options["query"]
    assert max_query(postgres(query="SELECT a FROM t"), "a").options["query"].endswith("FROM (SELECT a FROM t) AS subq")


def test_jdbc_read_reaches_spark_and_stops_at_the_missing_driver(spark):
    with pytest.raises(Exception, match="org.postgresql.Driver"):
        load(spark, postgres(table="t"))


def test_split_predicates_cover_everything_once(spark):
    df = spark.range(-5, 105).unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS id"))
    sizes = [df.where(condition).count() for condition in split_predicates("id", 0, 99, 10)]
    assert sizes == [16, *[10] * 8, 15]
    assert [df.where(c).count() for c in split_predicates("id", 0, 2, 7)] and split_predicates("id", 3, 9, 1) == ["TRUE"]
    assert sum(df.where(c).count() for c in split_predicates("id", 0, 2, 7)) == 111


def test_decimal_bounds_become_whole(spark):
    from decimal import Decimal

    options = split_options("id", Decimal("1.25"), Decimal("9.50"), 4)
    assert (options["lowerBound"], options["upperBound"]) == ("1", "10")


def test_mongodb_credentials_are_escaped():
    read = mongodb_read("h", 1, "db", "c", {"username": "a@b", "password": "p/ :%"})
    assert "mongodb://a%40b:p%2F%20%3A%25@h:1/db" in read.options["spark.mongodb.read.connection.uri"]


def test_kafka_login_is_escaped():
    options = kafka_read("b", "t", credentials={"sasl_username": 'u"', "sasl_password": "p\\"}).options
    assert options["kafka.sasl.jaas.config"].endswith('username="u\\"" password="p\\\\";')


def test_mongodb():
    read = mongodb_read("h", 27017, "db", "c", WHO, read_options={"k": True})
    assert read.format == "mongodb"
    assert read.options == {
        "spark.mongodb.read.connection.uri": "mongodb://u:p@h:27017/db?authSource=admin",
        "spark.mongodb.read.database": "db",
        "spark.mongodb.read.collection": "c",
        "k": "true",
    }
    stage = "spark.mongodb.read.aggregation.pipeline"
    assert mongodb_above(read, "n", 0).options[stage] == '[{"$match": {"n": {"$gt": 0}}}]'
    assert '"$max": "$n"' in mongodb_max(read, "n").options[stage]
    own = mongodb_read("h", 1, "db", "c", WHO, pipeline="[{}]")
    assert mongodb_above(own, "n", 5).options[stage] == "[{}]"


def test_dynamodb():
    secret = {"aws_region": "r", "aws_access_key_id": "a", "aws_secret_access_key": "s"}
    read = dynamodb_read("t", secret, throughput=50)
    assert read.format == "dynamodb"
    assert read.options == {
        "tableName": "t", "region": "r", "accessKey": "a", "secretKey": "s", "readThroughput": "50",
    }


def test_cassandra():
    read = cassandra_read("h", 9042, "ks", "t", WHO)
    assert read.format == "org.apache.spark.sql.cassandra"
    assert read.options == {
        "keyspace": "ks",
        "table": "t",
        "spark.cassandra.connection.host": "h",
        "spark.cassandra.connection.port": "9042",
        "spark.cassandra.auth.username": "u",
        "spark.cassandra.auth.password": "p",
        "spark.cassandra.input.fetch.size_in_rows": "10000",
    }


def test_kafka_batch():
    plain = kafka_read("b:9092", "t1,t2").options
    assert plain == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "t1,t2",
        "startingOffsets": "earliest",
        "endingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    secured = kafka_read(
        "b", "t", start='{"t":{"0":1}}', end='{"t":{"0":9}}', group_id="g", min_partitions=64,
        credentials={"sasl_username": "u", "sasl_password": "p"},
        read_options={"failOnDataLoss": True},
    ).options
    assert secured["startingOffsets"] == '{"t":{"0":1}}' and secured["endingOffsets"] == '{"t":{"0":9}}'
    assert secured["kafka.group.id"] == "g" and secured["minPartitions"] == "64"
    assert secured["kafka.security.protocol"] == "SASL_PLAINTEXT" and secured["kafka.sasl.mechanism"] == "PLAIN"
    assert 'username="u" password="p";' in secured["kafka.sasl.jaas.config"]
    assert secured["failOnDataLoss"] == "true"
    half = kafka_read("b", "t", credentials={"sasl_username": "u"}).options
    assert not any("sasl" in k for k in half)


def test_kafka_stream_has_no_end():
    options = kafka_stream("b", "t").options
    assert options["startingOffsets"] == "earliest" and "endingOffsets" not in options


def test_kafka_delivery(spark):
    options = kafka_write_options("b:9092", "events", {"sasl_username": "u", "sasl_password": "p"})
    assert options["topic"] == "events" and options["kafka.sasl.mechanism"] == "PLAIN"
    assert "subscribe" not in options and "failOnDataLoss" not in options
    frame = spark.range(1).select(F.lit("x").cast("binary").alias("value"))
    with pytest.raises(Exception, match="(?i)kafka"):
        send(frame, options)


def test_new_topic_partitions_start_at_their_beginning():
    assert complete_start('{"t":{"0":5}}', '{"t":{"0":9,"1":4}}') == '{"t": {"0": 5, "1": -2}}'


def test_s3a():
    base = {"aws_access_key_id": "a", "aws_secret_access_key": "s"}
    settings = s3a_settings(base)
    assert settings["fs.s3a.access.key"] == "a" and settings["fs.s3a.endpoint.region"] == "us-east-1"
    assert "fs.s3a.endpoint" not in settings and "fs.s3a.fast.upload" not in settings
    own = s3a_settings(base | {"aws_endpoint": "http://minio:9000"}, writing=True)
    assert own["fs.s3a.path.style.access"] == "true"
    assert own["fs.s3a.fast.upload"] == "true" and own["fs.s3a.fast.upload.buffer"] == "bytebuffer"


def test_s3a_per_bucket(spark):
    secret = {"aws_access_key_id": "a", "aws_secret_access_key": "s"}
    settings = s3a_settings(secret, writing=True, bucket="raw")
    assert settings["fs.s3a.bucket.raw.access.key"] == "a"
    assert settings["fs.s3a.bucket.raw.fast.upload"] == "true"
    assert [k for k in settings if not k.startswith("fs.s3a.bucket.raw.")] == ["fs.s3a.impl"]
    configure_s3a(spark, secret, bucket="raw")
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    assert hadoop.get("fs.s3a.bucket.raw.secret.key") == "s" and hadoop.get("fs.s3a.access.key") is None


def test_connector_read_applies_schema_and_options(spark, sf_dir):
    read = Read("parquet", {"path": f"{sf_dir}/supplier.parquet"}, "s_suppkey bigint")
    assert load(spark, read).columns == ["s_suppkey"]


def test_custom_query(spark):
    assert rows(custom_query(spark.range(5), "SELECT id * 2 AS d FROM {source} WHERE id > 2")) == [(6,), (8,)]


def test_file_schema_enforced_and_inferred(spark):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    path = land(df, scratch_path(spark, "csv"), "csv", options={"header": "true"})
    wide = read_files(spark, path, "csv", "n bigint, s string", {"header": "true"})
    assert wide.dtypes == [("n", "bigint"), ("s", "string")] and rows(wide) == [(1, "a")]
    found = infer_schema(spark, path, "csv", {"header": "true", "inferSchema": "true"})
    assert [f.dataType for f in found] == [T.IntegerType(), T.StringType()]


def test_unknown_formats_are_refused(spark):
    with pytest.raises(ValueError, match="unknown file format"):
        read_files(spark, "/x", "xml")


@pytest.mark.parametrize("fmt", ["avro", "delta"])
def test_package_formats_reach_spark(spark, fmt):
    with pytest.raises(Exception, match=f"(?i)failed to find.*{fmt}"):
        read_files(spark, "/nowhere", fmt).count()


def test_listing(spark):
    base = scratch_path(spark, "tree")
    land(spark.range(4).repartition(2), base)
    land(spark.range(4).repartition(3), f"{base}/sub/deep")
    top = file_inventory(spark, base)
    # Two data files and the marker; on a local disk Hadoop's checksum files are listed too, but not counted.
    assert top.where("path NOT LIKE '%.crc'").count() == 3 and file_count(spark, base).first().cnt == 3
    everything = file_inventory(spark, base, recursive=True)
    assert everything.where("path NOT LIKE '%.crc'").count() == 7
    assert "content" not in everything.columns
    newest = everything.where("path NOT LIKE '%.crc'").agg(F.max("modificationTime")).first()[0]
    assert latest_modification(spark, base).first().checkpoint_to == newest


def test_storage_settings_are_put_back(spark):
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("fs.s3a.bucket.mine.access.key", "before")
    with s3a_access(spark, {"aws_access_key_id": "now", "aws_secret_access_key": "s"}, bucket="mine"):
        assert hadoop.get("fs.s3a.bucket.mine.access.key") == "now" and hadoop.get("fs.s3a.bucket.mine.secret.key") == "s"
    assert hadoop.get("fs.s3a.bucket.mine.access.key") == "before" and hadoop.get("fs.s3a.bucket.mine.secret.key") is None


def test_equi_depth_slices_are_even_on_a_skewed_key(spark):
    """A third of the rows on one value, half a dozen far outliers, nulls: no slice but the hot value's own is large."""
    hot = spark.range(3000).select(F.lit(77).cast("bigint").alias("k"))
    tail = spark.range(6000).select((F.pow(F.col("id") / 10.0, 3)).cast("bigint").alias("k"))
    df = hot.unionByName(tail).unionByName(spark.range(500).select(F.lit(None).cast("bigint").alias("k")))
    conditions = equi_depth_predicates("k", column_cuts(df, "k", 16))
    sizes = {condition: df.where(condition).count() for condition in conditions}
    assert sum(sizes.values()) == 9500 == sliced(df, conditions).count()
    assert sizes["k = 77"] >= 3000 and sizes["k IS NULL"] == 500
    assert max(n for c, n in sizes.items() if c != "k = 77") <= 2 * 9000 // 16
    width = split_predicates("k", 0, 599**3, 16)
    assert max(df.where(c).count() for c in width) > 5000  # what equal widths would give


def test_equi_depth_conditions_by_type():
    from datetime import date, datetime

    assert equi_depth_predicates("k", []) == equi_depth_predicates("k", [None]) == ["TRUE"]
    assert equi_depth_predicates("s", ["b'c", "b'c"]) == ["s < 'b''c'", "s = 'b''c'", "s > 'b''c'", "s IS NULL"]
    assert equi_depth_predicates("d", [date(2024, 1, 2)]) == ["d < DATE '2024-01-02'", "d >= DATE '2024-01-02'", "d IS NULL"]
    assert "TIMESTAMP '2024-01-02 03:00:00'" in equi_depth_predicates("t", [datetime(2024, 1, 2, 3)])[0]


def test_cuts_are_asked_of_the_database(spark, monkeypatch):
    read = postgres(table="public.orders", schema="id BIGINT")
    asked = []

    def fake(_, query):
        asked.append(query.options["query"])
        return spark.createDataFrame([(1,), (5,), (5,), (9,)], "cut int")

    monkeypatch.setattr(jdbc, "load", fake)
    split = even_split_read(spark, read, "id", 4)
    assert "NTILE(4) OVER (ORDER BY id)" in asked[0] and "FROM public.orders" in asked[0]
    assert split.predicates == ("id < 5", "id = 5", "id > 5 AND id < 9", "id >= 9", "id IS NULL")
    assert split.with_options({"a": 1}).predicates == split.predicates and split.options == read.options
    with pytest.raises(Exception, match="org.postgresql.Driver"):
        load(spark, split)
