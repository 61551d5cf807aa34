"""Which stored batches may hold a key: a blocked Bloom filter per batch.

A filter is a table of blocks of 256 bits. A key falls into one block and sets one bit in each of
its eight words, so building a filter is one grouping by block that combines words bit by bit, and
asking all filters is one join on the block; both run in the JVM. A filter has as many blocks as
the keys of its batch need (a power of four), at about 1.5 bytes a key.

Filters never say no of a key that they hold. Writing a batch again adds a filter beside the
first, which can only add answers of yes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.schema import KEY

BITS_PER_KEY = 12
BLOCK_BITS = 256
WORDS = [f"word_{i}" for i in range(8)]
# Powers of two that numbers of blocks come in.
SIZES = range(0, 25, 2)
SCHEMA = "batch_id long, size int, block long, " + ", ".join(f"{word} int" for word in WORDS)
# Files of single batches that are merged into one.
MERGED_FILES = 64


def size_for(keys: int) -> int:
    """The power of two of the number of blocks for so many keys."""
    blocks = max(1, keys * BITS_PER_KEY / BLOCK_BITS)
    return next((s for s in SIZES if 1 << s >= blocks), SIZES[-1])


def _block(key: str, size: str) -> Column:
    """The block of a key among 2 ** size."""
    return F.expr(f"shiftrightunsigned(xxhash64({key}), 40) & (shiftleft(1L, {size}) - 1)")


def _bits(key: str) -> dict[str, Column]:
    """The bit of a key in each word: five bits of a second hash name it."""
    return {
        word: F.expr(f"shiftleft(1, cast(shiftright(xxhash64({key}, 1), {5 * i}) & 31 as int))")
        for i, word in enumerate(WORDS)
    }


class KeyFilters:
    """The filters of a table's batches, in a folder beside it."""

    def __init__(self, path: str) -> None:
        self.path = path
        self.sizes: set[int] | None = None  # those in use; None: not looked up yet

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(SCHEMA).parquet(self.path)

    def add(self, keys: DataFrame, batch_id: int, count: int, key: str = KEY) -> None:
        """Keep the filter of a batch's keys, of which there are about `count`."""
        spark, size = keys.sparkSession, size_for(count)
        blocks = keys.select(_block(key, str(size)).alias("block"), *(
            bits.alias(word) for word, bits in _bits(key).items()
        )).groupBy("block").agg(*(F.bit_or(word).alias(word) for word in WORDS))
        rows = blocks.select(
            F.lit(batch_id).cast("long").alias("batch_id"), F.lit(size).alias("size"), "block", *WORDS
        )
        rows.hint("rebalance").write.mode("append").parquet(self.path)
        if self.sizes is not None:
            self.sizes.add(size)
        self._merge(spark)

    def _files(self, spark: SparkSession) -> list:
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not store.exists(path):
            return []
        return [f for f in store.listStatus(path) if f.getPath().getName().startswith("part-")]

    def _merge(self, spark: SparkSession) -> None:
        """One file in place of many small ones; until they are gone, filters stand there twice."""
        files = self._files(spark)
        if len(files) < MERGED_FILES:
            return
        files = sorted(files, key=lambda f: f.getLen())[: MERGED_FILES - 1]
        names = [f.getPath().toString() for f in files]
        whole = spark.read.schema(SCHEMA).parquet(*names).distinct()
        whole.hint("rebalance").sortWithinPartitions("size", "block").write.mode("append").parquet(
            self.path
        )
        for f in files:
            f.getPath().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(
                f.getPath(), False
            )

    def may_hold(self, keys: DataFrame, key: str = KEY) -> DataFrame:
        """Pairs of a key and a batch whose filter says yes: columns `key`, `batch_id`."""
        return self._answers(keys, key).distinct()

    def _answers(self, keys: DataFrame, key: str) -> DataFrame:
        spark = keys.sparkSession
        if not self._files(spark):
            return spark.createDataFrame([], keys.select(key).schema.add("batch_id", "long"))
        filters = self.read(spark)
        if self.sizes is None:
            self.sizes = {row[0] for row in filters.select("size").distinct().collect()}
        sizes = F.explode(F.array(*map(F.lit, sorted(self.sizes)))).alias("size")
        bits = _bits(key)
        asked = keys.select(key, sizes, *(bits[word].alias(f"own_{word}") for word in WORDS))
        asked = asked.withColumn("block", _block(key, "size"))
        found = asked.join(filters, ["size", "block"])
        held = " AND ".join(f"{word} & own_{word} = own_{word}" for word in WORDS)
        return found.where(held).select(key, "batch_id")

    def batches_for(self, keys: DataFrame, but: int, key: str = KEY) -> list[int]:
        """Numbers of the batches, other than `but`, that may hold one of the keys."""
        found = self._answers(keys, key).where(F.col("batch_id") != but)
        # A number per batch at most.
        return sorted(found.agg(F.collect_set("batch_id").alias("numbers")).first()["numbers"])
