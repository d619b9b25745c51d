"""Small tables with everything a table may hold, and the given ones."""

from __future__ import annotations

import random

import duckdb
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, types as T

FOLDER = "/root/testdata/sf0.001"
DOCUMENTS = T.StructType().add("doc_id", "long").add("text", "string").add("lang", "string").add("source", "string") \
    .add("n_chars", "long").add("key", "string").add("part", "integer").add("row", "string").add("keep_id", "double")


def given(name: str, folder: str = FOLDER) -> list[tuple]:
    table = pq.read_table(f"{folder}/{name}.parquet").to_pydict()
    return list(zip(*table.values()))


def written(spark: SparkSession, folder, rows, schema, parts: int = 3) -> DataFrame:
    path = str(folder)
    spark.createDataFrame(rows, schema).repartition(parts).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def documents(spark: SparkSession, folder, docs, lang="en", parts: int = 3) -> DataFrame:
    """Documents of (id, text), with further columns whose names the operators use themselves."""
    return written(spark, folder, [(k, t, lang, None, None, "k", 1, "r", 0.5) for k, t in docs], DOCUMENTS, parts)


def odd_documents(seed: int = 7) -> list[tuple]:
    """Nulls, empty and long texts, ties, repeated rows, copies, near copies and personal data."""
    draw = random.Random(seed)
    words = "the of and tha onthe über été señor data x1 ａ B".split()
    made = [" ".join(draw.choice(words) for _ in range(draw.randrange(0, 60))) for _ in range(60)]
    long = " ".join(draw.choice(words) for _ in range(30_000))
    rows = list(enumerate(made))
    rows += [(100 + i, made[i % 7].replace(" ", draw.choice([" ", "\n", "  ", "\t "]))) for i in range(25)]
    rows += [(200 + i, long + tail) for i, tail in enumerate(("", " end", " and another end"))]
    rows += [(300, None), (301, ""), (302, " \t\r\n\x0b\x0c"), (303, "\x1c\x85\xa0"), (304, "123 456!"), (None, None), (None, made[3])]
    rows += [(305, "same"), (305, "same"), (305, "s a m e"), (306, "same"), (307, "x" * 9_000), (308, "🙂 é́ ß İ")]
    secret = "mail to jo.doe@mail.example.com from Quonsar the third or call +49 (30) 123-4567 now, card 4111 1111 1111 1111 at 10.0.0.255"
    rows += [(400 + i, f"{made[i]} {secret} {made[i + 1]}") for i in range(5)]
    rows += [(500, "a@b.c_d@e.f a@b@c.d.e @x y@ 1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.004 +1 2 +12345678 4111-1111-1111-1111-1"),
             (501, "a" * 9_000 + "@"), (502, "a.b@c" + ".d" * 10_000), (503, "1" * 9_000), (504, "1 " * 400 + "1.1.1.1." * 300),
             (505, "🙂 é 10.1.1.1 ü +1(234)567-8901.")]
    return rows


def connect(folder: str = FOLDER) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "embeddings"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection
