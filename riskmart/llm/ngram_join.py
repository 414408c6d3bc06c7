"""N-gram Jaccard self-join with tries, and the groups of documents that it links.

A document's set is its distinct five-word shingles, as 64-bit hashes. Documents with equal sets are one
node (a 128-bit hash of the sorted set). Two nodes link when ``100 * |x & y| >= 80 * |x | y|``.

1. *Sets* (one pass over the texts) gives (doc_id, n, node) and the head of each set in hash order.
   Shingles that more than ``FEW`` heads hold are common; the ``COMMON`` most frequent of them are put
   last in the global order, so that shared passages and lines seldom are in a prefix. Any order gives
   the same links; this one makes few candidates. The list is bounded and is what is broadcast.
2. *Prefixes* (second pass): two linked sets share a shingle among the first ``n - ceil(0.8 n) + 1`` of
   each. Prefix shingles are shuffled by shingle; those of a single node (nearly all) go at once.
3. *Shingles of 2 to FEW nodes*: equal member lists are merged with their count, and pairs are counted. The
   number of shared prefix shingles plus the longer rest bounds the overlap; pairs below the needed
   overlap fall away here. The rest is checked exactly: partners of one node form a trie.
4. *Shingles of more nodes*: their nodes are dealt into blocks of about ``BLOCK`` and block pairs are
   joined, again by trie. Nodes that share several such shingles are compared at the first of them
   only. A task returns the links of a spanning forest of what it found, so the number of rows is
   linear in its nodes.

A trie holds sets in the global order backwards (common shingles first), so that near copies share long
paths. Going down, the overlap of a path with all still possible queries is added up once for all sets
below; a query leaves a subtree when its overlap plus all that is left of the longest set below cannot
reach what the shortest set below would need. Leaves are exact: no link is missed or invented.

Links become groups by star contraction (``components``). No pair of equal sets is ever formed.

Defined cases: null or blank text has an empty set and links with nothing; fewer than five words are one
shingle; a null id takes part and never names a group unless no id of the group is known; repeated
rows each come back; an empty table gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskmart.llm.common import cached, hide, join_by_hot, only, row_hash, slices, tidy, written
from riskmart.llm.components import components
from riskmart.llm.exact_dedup import FILTER_BITS, bloom_filter, in_filter

WORDS = 5
FEW = 64
COMMON = 100_000
BLOCK = 256
_CELLS = 30_000_000  # of one membership table, in bytes
_WORD_CACHE = 250_000
_SEEN = 100_000
_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64
)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= _WORD_CACHE:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_HASHES = cached("ngram join", _WordHashes())


def shingles(text: bytes | None) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit numbers. Only A-Z are lower-cased; words end at ASCII white space."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.int64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    count = len(words) - width + 1
    total = np.full(count, len(words) if width < WORDS else 0, np.uint64)
    for i in range(width):
        total += hashes[i:i + count] * _FACTORS[i]
    total ^= total >> np.uint64(29)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    total ^= total >> np.uint64(32)
    return np.unique(total.view(np.int64))


def prefix_length(n):
    return n - -(-4 * n // 5) + 1


def node_key(sets: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(sets.tobytes())


def global_order(values: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Sorted set -> rare shingles in hash order, then common ones in hash order."""
    if not len(common):
        return values
    at = np.minimum(np.searchsorted(common, values), len(common) - 1)
    last = common[at] == values
    return np.concatenate([values[~last], values[last]])


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=pa.int64()))


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    only("ngram join")
    seen: set[bytes] = set()
    for batch in slices(batches):
        counts, nodes, heads = [], [], []
        for text in batch.column(1):
            values = shingles(text.as_py())
            key = node_key(values)
            n = len(values)
            counts.append(n)
            nodes.append(key)
            fresh = n and key not in seen  # copies within a task count once
            p = prefix_length(n)
            heads.append(values[:p + p // 4 + 8] if fresh else values[:0])
            if len(seen) < _SEEN:
                seen.add(key)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(counts, pa.int64()), pa.array(nodes, pa.binary()), _lists(heads)],
            names=["doc_id", "row_key", "n", "node", "head"],
        )


def _prefix_rows(common_list) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("ngram join")
        common = common_list.value
        seen: set[bytes] = set()
        for batch in slices(batches):
            tokens, nodes, counts = [], [], []
            for text in batch.column(0):
                values = shingles(text.as_py())
                n = len(values)
                key = node_key(values)
                if not n or key in seen:
                    continue
                if len(seen) < _SEEN:
                    seen.add(key)
                p = prefix_length(n)
                tokens.append(global_order(values, common)[:p])
                nodes.append(key)
                counts.append(n)
            if not tokens:
                continue
            lengths = [len(t) for t in tokens]
            at = pa.array(np.repeat(np.arange(len(nodes)), lengths))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(tokens)), pa.array(nodes, pa.binary()).take(at), pa.array(np.repeat(counts, lengths))],
                names=["token", "node", "n"],
            )

    return run


def _ordered_sets(common_list) -> Callable:
    """node -> its set in trie order: the global order backwards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("ngram join")
        common = common_list.value
        for batch in slices(batches):
            sets = [shingles(text.as_py()) for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([node_key(s) for s in sets], pa.binary()),
                    pa.array([global_order(s, common)[::-1].tobytes() for s in sets], pa.binary()),
                ],
                names=["node", "tokens"],
            )

    return run


class Trie:
    """Ordered sets with shared paths; runs of shingles without a branch are one edge."""

    __slots__ = ("run", "children", "ends", "least", "most", "rest")

    def __init__(self, members: list[tuple[int, np.ndarray]], depth: int = 0):
        """``members``: (index, columns of the set in trie order), sorted by their columns."""
        first, last = members[0][1], members[-1][1]
        length = min(len(first), len(last)) - depth
        differ = np.flatnonzero(first[depth:depth + length] != last[depth:depth + length])
        length = int(differ[0]) if len(differ) else length
        self.run = first[depth:depth + length]
        depth += length
        self.ends = [i for i, s in members if len(s) == depth]
        sizes = [len(s) for _, s in members]
        self.least, self.most = min(sizes), max(sizes)
        self.rest = self.most - depth
        self.children = []
        longer = [m for m in members if len(m[1]) > depth]
        start = 0
        for i in range(1, len(longer) + 1):
            if i == len(longer) or longer[i][1][depth] != longer[start][1][depth]:
                self.children.append(Trie(longer[start:i], depth))
                start = i


def trie_join(queries: list[np.ndarray], members: list[np.ndarray], allowed: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
    """(query, member) of all linked pairs of two lists of sets in trie order; of the allowed ones, if given."""
    if allowed is not None:
        some, needed = np.flatnonzero(allowed.any(axis=1)), np.flatnonzero(allowed.any(axis=0))
        if len(some) < len(queries) or len(needed) < len(members):
            inner = trie_join([queries[i] for i in some], [members[i] for i in needed], allowed[np.ix_(some, needed)])
            yield from ((int(some[q]), int(needed[m])) for q, m in inner)
            return
    if not queries or not members:
        return
    sys.setrecursionlimit(max(sys.getrecursionlimit(), len(members) + 1000))  # a trie is as deep as it has members, at worst
    order = sorted(range(len(members)), key=lambda i: members[i].tobytes())
    root = Trie([(i, members[i]) for i in order])
    start = 0
    while start < len(queries):
        end, cells = start + 1, len(queries[start])
        while end < len(queries) and (cells + len(queries[end])) * (end + 1 - start) <= _CELLS:
            cells += len(queries[end])
            end += 1
        for q, m in _descend(root, queries[start:end]):
            if allowed is None or allowed[start + q, m]:
                yield start + q, m
        start = end


def _descend(root: Trie, queries: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Walk the trie with all queries at once."""
    every = np.concatenate(queries)
    known = np.unique(every)
    columns = len(known)
    has = np.zeros((len(queries), columns + 1), bool)  # the last column: shingles of no query
    has[np.repeat(np.arange(len(queries)), [len(q) for q in queries]), np.searchsorted(known, every)] = True
    sizes = np.array([len(q) for q in queries])
    stack = [(root, 0, np.arange(len(queries)), np.zeros(len(queries), np.int64))]
    while stack:
        node, depth, active, overlap = stack.pop()
        possible = 5 * np.minimum(sizes[active], node.most) >= 4 * np.maximum(sizes[active], node.least)
        active, overlap = active[possible], overlap[possible]
        if not len(active):
            continue
        run = node.run
        if len(run):
            at = np.minimum(np.searchsorted(known, run), columns - 1)
            at = np.where(known[at] == run, at, columns)
            overlap = overlap + has[np.ix_(active, at)].sum(axis=1)
        depth += len(run)
        for i in node.ends:
            for q in active[9 * overlap >= 4 * (sizes[active] + depth)]:
                yield int(q), i
        if node.children:
            alive = 9 * (overlap + node.rest) >= 4 * (sizes[active] + max(node.least, depth))
            active, overlap = active[alive], overlap[alive]
            if len(active):
                stack += [(child, depth, active, overlap) for child in node.children]


def _star_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (hub, is_hub first): each hub's set is joined with the trie of its partners."""
    hub, query, partners, sets = None, None, [], []

    def links():
        if query is not None and sets:
            for _, i in trie_join([query], sets):
                yield hub, partners[i]

    for batch in batches:
        out = []
        for key, node, tokens in zip(*(c.to_pylist() for c in batch.columns)):
            if key != hub:
                out += links()
                hub, query, partners, sets = key, None, [], []
            values = np.frombuffer(tokens, np.int64)
            if node == key:
                query = values
            else:
                partners.append(node)
                sets.append(values)
        if out:
            yield _edges(out)
    out = list(links())
    if out:
        yield _edges(out)


def _edges(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    u, v = zip(*pairs)
    return pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary())], names=["u", "v"])


def _sides(rows) -> tuple[list[int], list[int], np.ndarray]:
    """Rows of either block of a pair (all rows twice, if it is one block), and the pairs to compare here."""
    token = int(rows["token"].iloc[0])
    earlier = [np.asarray(e)[np.asarray(e) < token] for e in rows["crowded"]]
    sides = rows["side"].tolist()
    left = [i for i, s in enumerate(sides) if s != 1]
    right = [i for i, s in enumerate(sides) if s != 0]
    return left, right, _first_here(earlier, left, right)


def _needed_rows(rows):
    """Of a pair of blocks, the rows that have any partner to compare here; sets follow for these only."""
    left, right, allowed = _sides(rows)
    needed = {left[i] for i in np.flatnonzero(allowed.any(axis=1))} | {right[i] for i in np.flatnonzero(allowed.any(axis=0))}
    return rows.iloc[sorted(needed)]


def _block_links(rows):
    """One pair of blocks (or one block with itself): links of a spanning forest."""
    import pandas as pd

    nodes = rows["node"].tolist()
    sets = [np.frombuffer(t, np.int64) for t in rows["tokens"]]
    left, right, allowed = _sides(rows)
    parent = list(range(len(nodes)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    pairs = []
    if left and right:
        for q, m in trie_join([sets[i] for i in left], [sets[i] for i in right], allowed):
            a, b = root(left[q]), root(right[m])
            if a != b:
                parent[a] = b
                pairs.append((nodes[left[q]], nodes[right[m]]))
    return pd.DataFrame(pairs, columns=["u", "v"])


def _first_here(earlier: list[np.ndarray], left: list[int], right: list[int]) -> np.ndarray:
    """Pairs that share no earlier crowded shingle, and no row with itself."""
    known = np.unique(np.concatenate(earlier)) if earlier else np.empty(0)

    def table(rows: list[int]) -> np.ndarray:
        out = np.zeros((len(rows), len(known)), np.float32)
        for k, i in enumerate(rows):
            out[k, np.searchsorted(known, earlier[i])] = 1
        return out

    allowed = table(left) @ table(right).T == 0
    return allowed & (np.array(left)[:, None] != np.array(right)[None, :])


def row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(id_col, text_col)


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", few: int = FEW, common: int = COMMON, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, row_key (a hash of id and text), n_shingles, component_id, root.

    ``root`` tells groups apart that share their least id, as ids may repeat; it is null for an empty set.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType
    slim = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"), row_key(id_col, text_col).alias("row_key")
    )
    rows = written(
        slim.mapInArrow(tidy(_set_rows), T.StructType([
            T.StructField("doc_id", id_type), T.StructField("row_key", T.LongType()), T.StructField("n", T.LongType()), T.StructField("node", T.BinaryType()),
            T.StructField("head", T.ArrayType(T.LongType())),
        ])), "sets")
    frequent = (
        rows.select(F.explode("head").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("c"))
        .filter(F.col("c") > few).orderBy(F.desc("c"), "token").limit(common).select("token")
    )
    listed = np.sort(np.array([r["token"] for r in frequent.collect()], dtype=np.int64))
    common_list = spark.sparkContext.broadcast(listed)
    entries = slim.select("text").mapInArrow(tidy(_prefix_rows(common_list)), "token long, node binary, n long")
    by_token = Window.partitionBy("token")
    shared = written(
        entries.withColumn("lo", F.min("node").over(by_token)).withColumn("hi", F.max("node").over(by_token))
        .filter("lo <> hi").select("token", "node", "n").distinct()
        .withColumn("df", F.count(F.lit(1)).over(by_token)),
        "prefixes",
    )
    pairs = written(_candidates(shared.filter(F.col("df") <= few)), "candidates")
    crowded = shared.filter(F.col("df") > few)
    # Sets are made again, only of the documents that stand for a node with a candidate.
    involved = written(
        pairs.select(F.explode(F.array("a", "b")).alias("node")).union(crowded.select("node")).distinct()
        .join(_stands_for(rows), "node"), "involved")
    sets = written(_sets_of(slim, involved, common_list), "ordered")
    edges = _stars(pairs, sets).union(_blocks(crowded, sets, block))
    labels = components(edges)
    return _labelled(rows.select("doc_id", "row_key", "n", "node"), labels)


def _candidates(shared: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes that share enough prefix shingles to reach the needed overlap."""
    lists = (
        shared.groupBy("token").agg(F.sort_array(F.collect_list(F.struct("node", "n"))).alias("m"))
        .groupBy("m").agg(F.count(F.lit(1)).alias("c"))
    )
    both = F.expr(
        "explode(flatten(transform(sequence(1, size(m) - 1), i -> "
        "filter(transform(slice(m, i + 1, size(m)), y -> struct(m[i - 1] as a, y as b)), "
        "p -> 5 * least(p.a.n, p.b.n) >= 4 * greatest(p.a.n, p.b.n)))))"
    )
    counted = (
        lists.select("c", both.alias("p"))
        .groupBy(F.col("p.a.node").alias("a"), F.col("p.b.node").alias("b"), F.col("p.a.n").alias("na"), F.col("p.b.n").alias("nb"))
        .agg(F.sum("c").alias("c"))
    )
    return counted.filter("c + ceil(4 * greatest(na, nb) / 5) - 1 >= ceil(4 * (na + nb) / 9)").select("a", "b")


def _stands_for(rows: DataFrame) -> DataFrame:
    """One document per node."""
    return rows.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"))


def _sets_of(slim: DataFrame, involved: DataFrame, common_list) -> DataFrame:
    """The ordered sets of involved nodes; a Bloom filter of fixed size on the ids spares all other texts."""
    bloom = written(bloom_filter(involved.select(F.xxhash64("doc_id").alias("h"))), "bloom")
    some = in_filter(slim, bloom, F.xxhash64("doc_id"), FILTER_BITS).filter("maybe_").select("text")
    made = some.mapInArrow(tidy(_ordered_sets(common_list)), "node binary, tokens binary")
    return made.join(involved.select("node"), "node").dropDuplicates(["node"])


def _stars(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    partners = pairs.join(sets.withColumnRenamed("node", "b"), "b").select(F.col("a").alias("hub"), F.col("b").alias("node"), "tokens")
    hubs = pairs.select(F.col("a").alias("node")).distinct().join(sets, "node").select(F.col("node").alias("hub"), "node", "tokens")
    rows = hubs.union(partners).repartition("hub").sortWithinPartitions("hub", (F.col("hub") != F.col("node")))
    return rows.mapInArrow(tidy(_star_links), "u binary, v binary")


def _blocks(crowded: DataFrame, sets: DataFrame, block: int) -> DataFrame:
    listed = crowded.groupBy("node").agg(F.sort_array(F.collect_list("token")).alias("crowded"))  # within one prefix
    placed = (
        crowded.withColumn("m", F.ceil(F.col("df") / block).cast("int"))
        .withColumn("i", F.pmod(F.xxhash64("node", "token"), F.col("m")).cast("int"))
        .join(listed, "node")
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
        .select(
            "token", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"), "node",
            F.when(F.col("i") == F.col("j"), 2).when(F.col("i") < F.col("j"), 0).otherwise(1).alias("side"), "crowded",
        )
    )
    needed = placed.groupBy("token", "lo", "hi").applyInPandas(_needed_rows, placed.schema)
    return needed.join(sets, "node").groupBy("token", "lo", "hi").applyInPandas(_block_links, "u binary, v binary")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Give every row the least id of its group."""
    nodes = rows.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("rows_"))
    rooted = written(nodes.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")
    roots = rooted.groupBy("root").agg(F.min("low").alias("component_id"), F.sum("rows_").alias("size_"))
    named = written(
        join_by_hot(rooted, written(roots, "roots"), "root", "size_").select("node", "component_id", "root", F.col("rows_").alias("size_")), "named"
    )
    full, empty = rows.filter("n > 0"), rows.filter("n = 0")
    return (
        join_by_hot(full, named, "node", "size_").select("doc_id", "row_key", F.col("n").alias("n_shingles"), "component_id", "root")
        .unionByName(empty.select(
            "doc_id", "row_key", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).cast("binary").alias("root")))
    )


def first_of_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that stay: of each group the one with the least id.

    Rows without a word are in no group and stay. Only rows that a Bloom filter of fixed size takes for
    dropped or repeated ones are shuffled; all others pass straight through.
    """
    decided = written(jaccard_groups(docs, id_col, text_col), "groups")
    # Of a group's rows with its least id (more than one only if ids repeat) the least key stays, once.
    same = Window.partitionBy("root").orderBy("row_key")
    heads = (
        decided.filter((F.col("n_shingles") > 0) & F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root", "doc_id", "row_key").agg(F.count(F.lit(1)).alias("times"))
        .withColumn("nth", F.row_number().over(same))
    )
    later = decided.filter((F.col("n_shingles") > 0) & ~F.col("doc_id").eqNullSafe(F.col("component_id")))
    touched = written(
        later.select("doc_id", "row_key", F.lit(True).alias("dropped")).distinct()
        .union(heads.filter("nth > 1 or times > 1").select("doc_id", "row_key", (F.col("nth") > 1).alias("dropped"))),
        "touched",
    )
    bloom = written(bloom_filter(touched.select(F.xxhash64("row_key").alias("h"))), "bloom")
    base, (id_at, text_at), restored = hide(docs, id_col, text_col)
    probed = in_filter(base.withColumn("row_key_", row_key(id_at, text_at)), bloom, F.xxhash64("row_key_"))
    copies = Window.partitionBy("row_key_", id_at).orderBy(row_hash(base, [id_at]))
    known = touched.select(F.col("doc_id").alias("id_"), "row_key", "dropped")
    settled = (
        probed.filter("maybe_")
        .join(known, (F.col("row_key_") == F.col("row_key")) & F.col(id_at).eqNullSafe(F.col("id_")), "left")
        .filter(~F.coalesce("dropped", F.lit(False)))
        .withColumn("nth_", F.when(F.col("dropped").isNull(), F.lit(1)).otherwise(F.row_number().over(copies)))
        .filter("nth_ = 1")
    )
    return probed.filter("not maybe_").select(*restored).unionByName(settled.select(*restored))


def op9_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return jaccard_groups(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("row_key", "root")


OP9_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingled AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM worded),
nodes AS (SELECT list_sort(s) AS k, min(doc_id) AS node, len(any_value(s)) AS n FROM shingled GROUP BY 1),
tokens AS (SELECT node, n, unnest(k) AS t FROM nodes),
shared AS (SELECT t FROM tokens GROUP BY t HAVING count(*) > 1),
kept AS (SELECT * FROM tokens SEMI JOIN shared USING (t)),
links AS (
  SELECT a.node AS u, b.node AS v FROM kept a JOIN kept b ON a.t = b.t AND a.node < b.node
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach(node, seen) AS (
  SELECT node, node FROM nodes UNION SELECT r.node, b.v FROM reach r JOIN both_ways b ON r.seen = b.u),
roots AS (SELECT node, min(seen) AS root FROM reach GROUP BY node)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE r.root END AS component_id
FROM shingled s JOIN nodes n ON list_sort(s.s) = n.k JOIN roots r ON r.node = n.node
"""
