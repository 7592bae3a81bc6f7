"""The given tables in the shapes of this toolkit, in Spark and as SQL for checking.

``*_SQL`` strings are common table expressions that build the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslab.operators.ordering import id_block, position_in_group

COPY_OFFSET = 1_000_000_000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """documents, spread over the cores when its scan has fewer splits than there are cores.

    Text work is bound by the processor; a small table in one row group would run in one task. A table
    with many files is left as it is and not shuffled.
    """
    docs = table(spark, sf, "documents")
    cores = spark.sparkContext.defaultParallelism
    return docs.repartition(cores, "doc_id") if docs.rdd.getNumPartitions() < cores else docs


def comments(spark: SparkSession, sf: str) -> DataFrame:
    """documents as comments: one file per source, positions by document id."""
    docs = table(spark, sf, "documents").select(
        F.col("source").alias("file"), "doc_id", F.col("doc_id").cast("string").alias("id"), "text"
    )
    return position_in_group(docs, ["file"], id_block("doc_id"), ["doc_id"])


COMMENTS_SQL = """comments AS (
  SELECT source AS file, doc_id, CAST(doc_id AS VARCHAR) AS id, text,
         row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos
  FROM documents)"""


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """embeddings as vector rows; twenty files, positions by vector id."""
    v = F.col("vec_id")
    return table(spark, sf, "embeddings").select(
        F.concat(F.lit("src"), v % 20).alias("file"),
        v.alias("pos"),
        v.cast("string").alias("id"),
        "embedding",
        v.alias("original_pos"),
        F.col("label").alias("cluster"),
    )


def doubled(spark: SparkSession, sf: str) -> DataFrame:
    """embeddings plus exact copies of two labels under new ids."""
    base = table(spark, sf, "embeddings")
    copies = base.filter("label IN (0, 1)").withColumn("vec_id", F.col("vec_id") + F.lit(COPY_OFFSET))
    return base.unionByName(copies)


DOUBLED_SQL = f"""doubled AS (
  SELECT vec_id, embedding, label FROM embeddings
  UNION ALL SELECT vec_id + {COPY_OFFSET}, embedding, label FROM embeddings WHERE label IN (0, 1))"""


def threads(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """conversations as thread pages and replies: five threads per video, two per page."""
    talk = table(spark, sf, "conversations")
    size = talk.groupBy("conv_id").agg(F.count_if(F.col("turn") > 0).alias("n_replies"))
    conv = F.col("conv_id")
    tops = talk.filter("turn = 0").join(size, "conv_id").select(
        F.floor(conv / 5).cast("string").alias("video_id"),
        F.floor((conv % 5) / 2).cast("int").alias("page"),
        (conv % 5 % 2).cast("int").alias("item"),
        conv.cast("string").alias("parent_id"),
        F.col("text").alias("_raw"),
        F.col("n_replies").alias("_replies"),
    )
    replies = talk.filter("turn > 0").select(conv.cast("string").alias("parent_id"), F.col("turn").alias("seq"), "text")
    return tops, replies


CLEAN_SQL = (
    r"regexp_replace(regexp_replace(regexp_replace({0}, 'https?://\S+', '', 'g'), "
    r"'\A[\x00-\x20]+|[\x00-\x20]+\z', '', 'g'), '[\n\r]+', ' ', 'g')"
)

THREADS_SQL = f"""flat AS (
  SELECT CAST(conv_id // 5 AS VARCHAR) AS video_id, CAST(conv_id % 5 // 2 AS INTEGER) AS page,
         CAST(conv_id % 5 % 2 AS INTEGER) AS item, turn AS seq, {CLEAN_SQL.format('text')} AS text
  FROM conversations WHERE length({CLEAN_SQL.format('text')}) > 0)"""


def norm_sql(v: str) -> str:
    return f"sqrt(list_sum(list_transform({v}, lambda x: x::DOUBLE * x::DOUBLE)))"


def square_sql(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}::DOUBLE[], {b}::DOUBLE[]), lambda p: (p[1]-p[2])*(p[1]-p[2])))"


def rounded_sql(expression: str, digits: int = 6) -> str:
    return f"round({expression}, {digits}) + 0.0"


def rounded(column, digits: int = 6):
    return F.round(column, digits) + F.lit(0.0)


CENTERS_SQL = """cells AS (
  SELECT label, unnest(range(1, len(embedding) + 1)) AS d, unnest(embedding)::DOUBLE AS x FROM embeddings),
means AS (SELECT label, d, avg(x) AS m FROM cells GROUP BY label, d),
centers AS (SELECT label, list(m ORDER BY d) AS center FROM means GROUP BY label)"""
