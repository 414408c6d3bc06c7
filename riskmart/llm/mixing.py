"""Mix sources to target weights by systematic sampling.

Every document of a source expects the same number of copies, the source's target over its size.
Documents lie in a fixed order within their source (by size, then id); expected copies are summed
along it, one random offset per source is added, and a document is emitted once for every whole
number that the running sum passes in it. Because the order is by size, the words taken differ
from the target by about one long document, however large the source.

The running sum is never made by one task per source. It is added up over three levels: size
classes of a source (some 130 rows), ``SUB_BUCKETS`` hash buckets of a class, and the documents of
one bucket. Windows run within one such group only, so a source with a third of all rows spreads
over classes x buckets. Sums are whole numbers (units of a trillionth copy), so reruns and
any partitioning agree exactly.

Targets: sources in code-point order, null last, weigh 5, 2, 1 in turn and share all words; no target
exceeds ``MAX_REPEAT`` times its source's words, and what is cut is shared out again by weight until
none is above. That fixed point is found in one pass over the sources sorted by cap over weight.
The per-source totals pass through one task: a mixture has one weight per source, so their number is
that of a configuration, not of the documents.

Defined cases: null or blank text has size 0; null sources are one source; a source without words has
target 0; rows with equal id and size are told apart by a hash of their other columns. Input columns
named like an output column are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskmart.llm.common import hide, row_hash, without, written

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SUB_BUCKETS = 256
UNIT = 10**12  # one copy
WORD = r"[^\x20\x09-\x0D]+"
OUTPUT = ("size", "source_size", "target", "taken")
_KEYS = ("key_", "class_", "sub_")


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _class(size: Column) -> Column:
    """Grows with the size, in steps of an eighth of an octave at most: the size's length and first four bits."""
    shift = F.greatest(F.length(F.bin(size)) - 4, F.lit(0))
    return (shift * 16 + F.call_function("shiftright", size, shift)).cast("long")


def _number(text: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def placed(docs: DataFrame, id_col: str, source_col: str, size: Column) -> DataFrame:
    """Add the size and the place of a row in its source: key_, class_, sub_."""
    return (
        docs.withColumn("size", size)
        .withColumn("key_", F.when(F.col(source_col).isNull(), F.lit("z")).otherwise(F.concat(F.lit("s"), F.col(source_col))))
        .withColumn("class_", _class(F.col("size")))
        .withColumn("sub_", F.pmod(_number(F.coalesce(F.col(id_col).cast("string"), F.lit("")), 8), F.lit(SUB_BUCKETS)))
    )


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(key_, source_size, target) from (key_, source_size): shares by weight, capped, the excess shared again."""
    by_key = Window.orderBy("key_")
    by_ratio = Window.orderBy("ratio_", "key_")
    everything = Window.partitionBy()
    turn = F.array(*[F.lit(w) for w in weights])
    weighed = (
        sources.withColumn("w_", F.element_at(turn, ((F.row_number().over(by_key) - 1) % len(weights) + 1).cast("int")).cast("long"))
        .withColumn("cap_", (F.col("source_size") * max_repeat).cast("long"))
        .withColumn("ratio_", F.col("cap_") / F.col("w_"))
    )
    level = (
        F.sum("source_size").over(everything)
        - F.coalesce(F.sum("cap_").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ) / F.sum("w_").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    # All sources before the first whose own cap lies above the level are capped; the rest share at that level.
    levelled = weighed.withColumn("level_", level).withColumn("at_", F.row_number().over(by_ratio))
    found = F.min_by(F.col("level_"), F.when(F.col("level_") <= F.col("ratio_"), F.col("at_"))).over(everything)
    return levelled.withColumn("found_", found).select(
        "key_", "source_size",
        F.least(F.col("w_") * F.col("found_"), F.col("cap_").cast("double")).alias("target"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    seed: str = "mix",
    weights: tuple[int, ...] = WEIGHTS,
    max_repeat: int = MAX_REPEAT,
) -> DataFrame:
    """All rows and columns with ``size``, ``source_size``, ``target``, ``taken`` and ``copies``."""
    base, (id_at, source_at, text_at), restored = hide(without(docs, (*OUTPUT, "copies")), id_col, source_col, text_col)
    rows = placed(base, id_at, source_at, words(text_at)).withColumn("tie_", row_hash(base, [id_at]))
    return _copies(rows, id_at, restored, seed, weights, max_repeat)


def decide(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    seed: str = "mix",
    weights: tuple[int, ...] = WEIGHTS,
    max_repeat: int = MAX_REPEAT,
) -> DataFrame:
    """The same mix for ids only: texts are read once, and no text is shuffled."""
    base, (id_at, source_at, text_at), _ = hide(without(docs, (*OUTPUT, "copies")), id_col, source_col, text_col)
    rows = placed(base, id_at, source_at, words(text_at))
    narrow = written(rows.select(id_at, "size", *_KEYS, row_hash(base, [id_at]).alias("tie_")), "sizes")
    return _copies(narrow, id_at, [F.col(id_at).alias(id_col)], seed, weights, max_repeat)


def _copies(rows: DataFrame, id_at: str, restored: list[Column], seed: str, weights: tuple[int, ...], max_repeat: int) -> DataFrame:
    """Copies of placed rows, told apart by id and ``tie_``."""
    # One pass over the rows gives the sizes of all buckets; everything above is made from these.
    buckets = written(rows.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("n_"), F.sum("size").alias("words_")), "buckets")
    classes = buckets.groupBy("key_", "class_").agg(F.sum("n_").alias("n_"), F.sum("words_").alias("words_"))
    rates = (
        targets(classes.groupBy("key_").agg(F.sum("words_").alias("source_size")), weights, max_repeat)
        .withColumn(
            "each_",
            F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * UNIT)).otherwise(F.lit(0)).cast("long"),
        )
        .withColumn("offset_", F.expr(f"cast({_offset(seed)} as long)"))
    )
    before = (Window.unboundedPreceding, -1)
    class_start = F.coalesce(F.sum("n_").over(Window.partitionBy("key_").orderBy("class_").rowsBetween(*before)), F.lit(0))
    starts = classes.select("key_", "class_", class_start.alias("start_")).join(rates, "key_")
    sub_start = F.coalesce(
        F.sum("n_").over(Window.partitionBy("key_", "class_").orderBy("sub_").rowsBetween(*before)), F.lit(0)
    )
    offsets = (
        buckets.withColumn("within_", sub_start)
        .join(starts, ["key_", "class_"])
        .select(*_KEYS, (F.col("start_") + F.col("within_")).alias("first_"), "source_size", "target", "each_", "offset_")
    )
    order = Window.partitionBy(*_KEYS).orderBy("size", id_at, "tie_")
    upto = F.expr("(cast(first_ + nth_ as decimal(20,0)) * cast(each_ as decimal(14,0)) + offset_) div %d" % UNIT)
    upto_before = F.expr("(cast(first_ + nth_ - 1 as decimal(20,0)) * cast(each_ as decimal(14,0)) + offset_) div %d" % UNIT)
    return (
        rows.withColumn("nth_", F.row_number().over(order))
        .join(offsets, list(_KEYS))
        .withColumn("copies", (upto - upto_before).cast("long"))
        .select(*restored, "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")
    )


def _offset(seed: str) -> str:
    """One offset per source in [0, UNIT): 32 bits of a hash of seed and source."""
    return f"(cast(conv(substring(md5(concat('{seed}|', key_)), 1, 8), 16, 10) as decimal(10,0)) * cast({UNIT} as decimal(13,0))) div 4294967296"


def emit(mixed: DataFrame) -> DataFrame:
    """Each row as often as it has copies, with the columns it had before mixing."""
    kept = mixed.filter("copies > 0").withColumn("copy_", F.explode(F.expr("sequence(1L, copies)")))
    return kept.drop(*OUTPUT, "copies", "copy_")


def op6_mix_sources(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return decide(docs).select("doc_id", "size", "source_size", "target", "taken")


def mix_sql(docs: str = "documents", seed: str = "mix") -> str:
    """CTEs of the same mix in DuckDB's SQL, up to ``mixed(doc_id, size, source_size, target, copies)``."""
    return f"""
sized AS (
  SELECT *, CASE WHEN source IS NULL THEN 'z' ELSE 's' || source END AS key_,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
  FROM {docs}),
placed AS (
  SELECT *, greatest(length(bin(size)) - 4, 0) * 16 + (size >> greatest(length(bin(size)) - 4, 0)::INTEGER) AS class_,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % {SUB_BUCKETS} AS sub_
  FROM sized),
sources AS (
  SELECT key_, sum(size)::BIGINT AS source_size,
         ([{', '.join(map(str, WEIGHTS))}])[((row_number() OVER (ORDER BY key_) - 1) % {len(WEIGHTS)} + 1)::INTEGER]::BIGINT AS w
  FROM sized GROUP BY key_),
capped AS (SELECT *, source_size * {MAX_REPEAT} AS cap, (source_size * {MAX_REPEAT})::DOUBLE / w AS ratio FROM sources),
levelled AS (
  SELECT *, row_number() OVER r AS at_,
         ((SELECT sum(source_size) FROM sources)
          - coalesce(sum(cap) OVER (ORDER BY ratio, key_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(w) OVER (ORDER BY ratio, key_ ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM capped WINDOW r AS (ORDER BY ratio, key_)),
rates AS (
  SELECT key_, source_size,
         least(w * (SELECT arg_min(level, at_) FROM levelled WHERE level <= ratio), cap::DOUBLE) AS target,
         (('0x' || substr(md5('{seed}|' || key_), 1, 8))::BIGINT::HUGEINT * {UNIT}) // 4294967296 AS offset_
  FROM levelled),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY key_ ORDER BY class_, sub_, size, doc_id) AS nth FROM placed),
stepped AS (
  SELECT o.*, r.source_size, r.target, r.offset_,
         CASE WHEN r.source_size > 0 THEN floor(r.target / r.source_size * {UNIT})::HUGEINT ELSE 0 END AS each_
  FROM ordered o JOIN rates r USING (key_)),
mixed AS (
  SELECT *, ((nth * each_ + offset_) // {UNIT} - ((nth - 1) * each_ + offset_) // {UNIT})::BIGINT AS copies FROM stepped)"""


OP6_SQL = f"WITH {mix_sql()} SELECT doc_id, size, source_size, target, copies * size AS taken FROM mixed"
