"""Exact duplicates by an exact count of hashes and a Bloom filter: only hashes, and rows whose hash may repeat, are shuffled.

Pass 1 reads the texts once and counts their 64-bit hashes; the map side already adds up equal
hashes, so a text that fills a third of the table sends one number per task. Hashes counted
twice or more set their bits in a blocked Bloom filter: a hash picks one block of 32,768 bits and
sets ``HASHES`` bits in it. Their number is known by then and gives the filter its size: ``HASH_BITS`` bits
a hash, with which about 1 in 400 rows without a copy is taken for one that has some. Pass 2 probes every row against the filter. A row that misses has no
equal and passes straight through, with no shuffle of it; a row that hits is shuffled and settled
exactly by its SHA-256, so a false hit costs time and never a result.

The filter has ``filter_bits`` bits at most (128 MB by default, enough for 67 million repeated texts) whatever
the input: that is the size of the only broadcast that holds data of the corpus, besides at most ``HOT_GROUPS``
group rows. With more repeated hashes than the bits can tell apart, more rows take the shuffled way; results
stay the same. For 100 TB raise ``filter_bits`` (8e9 bits are 1 GB).

Groups whose size ranks among the largest ``HOT_GROUPS`` are settled by broadcasting their one row,
so no key left to the shuffled join has more than 1/``HOT_GROUPS`` of the rows.

Defined cases: a null text equals an empty one. A null id counts as the smallest. Of rows that
repeat id and text, one stays (by a hash of their other columns). Input columns named like an
output column are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskmart.llm.common import hide, row_hash, without, written

BLOCK_BITS = 32_768  # what bitmap_construct_agg holds in one value
HASHES = 4
HASH_BITS = 16
FILTER_BITS = 1 << 27
MOST_BITS = 1 << 30
HOT_GROUPS = 4_096
OUTPUT = ("keep_id", "group_size", "kept", "text_sha256")


def digest(text: str) -> Column:
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


def _positions(hash64: Column) -> list[Column]:
    second = F.xxhash64(hash64, F.lit(1))
    return [F.shiftright(second, 15 * i).bitwiseAND(BLOCK_BITS - 1).cast("int") for i in range(HASHES)]


def _block(hash64: Column, filter_bits: int) -> Column:
    return F.pmod(hash64, F.lit(max(1, filter_bits // BLOCK_BITS)))


def bloom_filter(hashes: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """Blocked Bloom filter (block_, bits_) over a column ``h`` of 64-bit hashes; of fixed size at most."""
    return (
        hashes.select(_block(F.col("h"), filter_bits).alias("block_"), F.explode(F.array(*_positions(F.col("h")))).alias("at"))
        .groupBy("block_")
        .agg(F.bitmap_construct_agg("at").alias("bits_"))
    )


def sized_filter(n_hashes: int, most: int = MOST_BITS) -> int:
    """Bits of a filter over so many hashes: whole blocks, ``HASH_BITS`` a hash, ``most`` at most."""
    return max(1, min(-(-n_hashes * HASH_BITS // BLOCK_BITS), most // BLOCK_BITS)) * BLOCK_BITS


def repeated_filter(digests: DataFrame, filter_bits: int = MOST_BITS) -> tuple[DataFrame, int]:
    """Pass 1: the filter over the hashes that occur at least twice, and its size in bits."""
    counted = digests.groupBy(F.xxhash64("text_sha256").alias("h")).agg(F.count(F.lit(1)).alias("n"))
    repeated = written(counted.filter("n > 1").select("h"), "repeated")
    bits = sized_filter(repeated.count(), filter_bits)
    return written(bloom_filter(repeated, bits), "bloom"), bits


def _bit(position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col("bits_"), F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), position % 8 + 1)) != 0


def in_filter(rows: DataFrame, bloom: DataFrame, hash64: Column, filter_bits: int = FILTER_BITS) -> DataFrame:
    """Add ``maybe_``, true where every bit of the row's hash is set. No shuffle of the rows."""
    hit = reduce(lambda a, b: a & b, [_bit(p) for p in _positions(hash64)])
    probed = rows.withColumn("block_", _block(hash64, filter_bits)).join(F.broadcast(bloom), "block_", "left")
    return probed.withColumn("maybe_", F.coalesce(hit, F.lit(False))).drop("block_", "bits_")


def may_repeat(rows: DataFrame, bloom: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """Pass 2: mark the rows whose digest may occur twice."""
    return in_filter(rows, bloom, F.xxhash64("text_sha256"), filter_bits)


def _groups(maybe: DataFrame, id_col: str) -> DataFrame:
    by_id = maybe.groupBy("text_sha256", F.col(id_col).alias("id_")).agg(F.count(F.lit(1)).alias("n_"))
    return (
        by_id.groupBy("text_sha256")
        .agg(
            F.max("id_").alias("keep_id"),
            F.sum("n_").alias("group_size"),
            F.coalesce(F.max_by("n_", "id_"), F.sum("n_")).alias("top_"),
        )
        .filter("group_size > 1")
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", filter_bits: int = MOST_BITS) -> DataFrame:
    """All rows and columns, with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``."""
    base, (id_at, text_at), restored = hide(without(docs, OUTPUT), id_col, text_col)
    _, bloom, bits, groups = _passes(base, id_at, text_at, filter_bits)
    settled = _settle(base.withColumn("text_sha256", digest(text_at)), groups, bloom, id_at, bits)
    return settled.select(*restored, *OUTPUT)


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", filter_bits: int = MOST_BITS) -> DataFrame:
    """The same decisions for (id, digest) only: texts are read once, and no text is shuffled."""
    digests, bloom, bits, groups = _passes(docs, id_col, text_col, filter_bits)
    return _settle(digests, groups, bloom, id_col, bits)


def _passes(docs: DataFrame, id_col: str, text_col: str, filter_bits: int) -> tuple[DataFrame, DataFrame, int, DataFrame]:
    digests = written(docs.select(F.col(id_col), digest(text_col).alias("text_sha256")), "digests")
    bloom, bits = repeated_filter(digests, filter_bits)
    groups = written(_groups(may_repeat(digests, bloom, bits).filter("maybe_"), id_col), "groups")
    return digests, bloom, bits, groups


def _settle(rows: DataFrame, groups: DataFrame, bloom: DataFrame, id_col: str, filter_bits: int) -> DataFrame:
    names = [c for c in rows.columns if c != "text_sha256"]
    probed = may_repeat(rows, bloom, filter_bits)
    hot = groups.filter("top_ = 1").orderBy(F.desc("group_size"), "text_sha256").limit(HOT_GROUPS)
    probed = probed.join(
        F.broadcast(hot.select("text_sha256", F.col("keep_id").alias("hot_keep_"), F.col("group_size").alias("hot_size_"))),
        "text_sha256", "left",
    )
    local = ~F.col("maybe_") | F.col("hot_size_").isNotNull()
    keep = F.when(F.col("hot_size_").isNull(), F.col(id_col)).otherwise(F.col("hot_keep_"))
    straight = probed.filter(local).select(
        *names,
        keep.alias("keep_id"),
        F.coalesce("hot_size_", F.lit(1)).cast("long").alias("group_size"),
        F.col(id_col).eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )
    same = Window.partitionBy("text_sha256", id_col).orderBy(row_hash(rows, ["text_sha256", id_col]))
    shuffled = (
        probed.filter(~local)
        .drop("maybe_", "hot_keep_", "hot_size_")
        .withColumn("nth_", F.row_number().over(same))
        .join(groups, "text_sha256", "left")
        .withColumn("keep_id", F.when(F.col("group_size").isNull(), F.col(id_col)).otherwise(F.col("keep_id")))
        .select(
            *names,
            "keep_id",
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            (F.col(id_col).eqNullSafe(F.col("keep_id")) & (F.col("nth_") == 1)).alias("kept"),
            "text_sha256",
        )
    )
    return straight.unionByName(shuffled)


def op3_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return decide(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP3_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
