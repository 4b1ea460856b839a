"""Storage of intermediate tables and small column helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TASK_BYTES = 16 << 20
#: Spark's setting that takes a plan's shuffle files away when it has run, not when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder of the cluster (``spark.checkpoint.dir``; below the warehouse where that is unset)."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, tasks: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends here, and a lost executor loses nothing of it.

    ``tasks``: how many tasks, and so files, the last step is dealt to at most; as many as Spark gives it otherwise.
    The plan is not run again, so its shuffle files go as soon as the table is written: next to the stored tables, the
    disk holds one step's shuffles and not those of all steps.
    """
    spark, path = df.sparkSession, work_dir(df.sparkSession, name)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, True)
    try:  # the setting counts when a DataFrame is made
        (df.coalesce(tasks) if tasks else df.select("*")).write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def tasks_for(docs: DataFrame, text: str) -> int:
    """How many tasks share what is made of these texts: one for each 16 MB of them, and one for each core at least.

    Where there are many more shuffle partitions than that, tables of a few rows each would be written: every file
    costs the driver a commit, and on a local file system without Hadoop's native library the executor starts processes
    for it, which share its memory until they run their own program.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    return max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))


def row_key(key: str, text: str) -> Column:
    """What tells rows apart: the id, which may be null or repeated, and 16 bytes of the text's SHA-256. A null text is an empty one."""
    return F.struct(F.col(key).alias("id"), F.substring(F.unhex(F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256)), 1, 16).alias("digest"))


def with_row_key(docs: DataFrame, key: str, text: str, name: str) -> DataFrame:
    """``docs`` with the column ``name`` that tells rows apart as ``row_key`` does, but holds a digest only where the id may
    stand on rows with different texts, or is null: elsewhere the id alone says it, and digests do not compress.

    Whether an id may be repeated is looked up in a bitmap of fixed size; an id that is taken for one by mistake only gets a
    digest, on all its rows.
    """
    told = docs.select(row_key(key, text).alias("k")).groupBy("k.id").agg(F.min("k.digest").alias("low"), F.max("k.digest").alias("high"))
    words = stored(_bitmap(told.where("id IS NOT NULL AND low != high"), F.col("id")).select(F.col("_word").alias("_rk_word"), F.col("_bits").alias("_rk_bits")), "repeated-ids")
    hashed = F.xxhash64(F.col(key))
    marked = docs.join(F.broadcast(words), F.shiftrightunsigned(hashed, 47) == F.col("_rk_word"), "left")
    several = F.coalesce(F.expr(f"shiftright(_rk_bits, cast(xxhash64(`{key}`) & 63 as int)) & 1L") == 1, F.lit(False))
    own = row_key(key, text)
    return marked.select(*docs.columns, F.struct(own["id"].alias("id"), F.when(several | F.col(key).isNull(), own["digest"]).alias("digest")).alias(name))


def share(key: str, parts: int) -> Column:
    """crc32 of an id written as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % parts


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _bitmap(wanted: DataFrame, wanted_key: Column) -> DataFrame:
    """_word, _bits: 2^17 words of 64 bits at most, with a bit for each hash of the wanted keys."""
    hashed = wanted.select(F.xxhash64(wanted_key).alias("_h"))
    return hashed.groupBy(F.expr("shiftrightunsigned(_h, 47)").alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(_h & 63 as int))")).alias("_bits"))


def likely(df: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column) -> DataFrame:
    """The rows of ``df`` whose key may be among the wanted ones: all that are, and few others.

    A filter ahead of a join, so that texts which it drops are not shuffled. It is a bitmap of hashes in 2^17 words of
    64 bits, whatever the input's size, and so may be broadcast; when very many keys are wanted, it lets more rows pass.
    """
    words = _bitmap(wanted, wanted_key)
    hashed = df.withColumn("_key_hash", F.xxhash64(key))
    same = (F.expr("shiftrightunsigned(_key_hash, 47)") == F.col("_word")) & (F.expr("shiftright(_bits, cast(_key_hash & 63 as int)) & 1L") == 1)
    return hashed.join(F.broadcast(words), same, "left_semi").select(*df.columns)


def likely_marked(df: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column, name: str) -> DataFrame:
    """``df`` with a boolean column ``name``: true wherever the key is among the wanted ones, and on few other rows, as in ``likely``."""
    words = _bitmap(wanted, wanted_key).select(F.col("_word").alias("_lm_word"), F.col("_bits").alias("_lm_bits"))
    hashed = df.withColumn("_lm_hash", F.xxhash64(key))
    marked = hashed.join(F.broadcast(words), F.expr("shiftrightunsigned(_lm_hash, 47)") == F.col("_lm_word"), "left")
    return marked.select(*df.columns, F.coalesce(F.expr("shiftright(_lm_bits, cast(_lm_hash & 63 as int)) & 1L") == 1, F.lit(False)).alias(name))
