"""Token counts that follow edits: a segment tree of pre-tokens per document.

A document is cut by the tokenizer's pattern into pre-tokens, and its tokens are counted per pre-token
(merges never cross one). Runs of ``LEAF`` pre-tokens are the leaves of a segment tree whose nodes hold the
characters and tokens below them. The leaves are a table of their own (``token_trees``), so that a later
batch of edits starts from them and encodes nothing again.

An edit replaces characters ``start .. start + length`` of the text as it then is. The leaves it touches are
found by descending the tree, widened by ``CONTEXT`` characters (a match looks at most two characters past
its end), cut and counted again, and widened to the right until a pre-token begins where the next leaf
begins: from there on nothing can differ. The new pre-tokens are dealt over the same leaves, and only the
sums above these change. Only when a leaf has grown over ``GROWN`` pre-tokens is the document cut anew.

Edits come as a list with the document's row: no shuffle. ``op2`` redacts e-mail addresses, telephone
numbers and licence lines, found natively, and returns the counts before and after.

Defined cases: null text is empty; null edits are none; positions are cut off at the ends of the text and a
negative length is 0; a null insertion is empty; repeated rows each come back; other columns are not
returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.llm.common import cached, only, slices, tidy
from riskmart.llm.word_tokens import byte_letters

LEAF = 64
GROWN = 4 * LEAF
CONTEXT = 3
VOCABULARY = "byte_bpe_50k.json"
CACHE = 400_000

# Fixed value: the pattern of the vocabulary, which cuts text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# What op2 takes out of the texts, and the strings one of which each match holds. A run of address characters is tried
# from its start (or where the last match ended) alone, and never given back: as many steps as characters.
REDACTED = r"(?:\G|(?<![\w.+-]))[\w.+-]++@[\w-]+(?:\.[\w-]+)+|\+\d{1,3} \(\d{3}\) \d{3}-\d{4}|(?m:^Licensed under [^\n]*$)"
HINTS = ("@", "+", "Licensed under ")
MARK = "[redacted]"


class PreTokenCounts(dict):
    """pre-token -> number of tokens, for as many pre-tokens as fit."""

    def __init__(self, path: str):
        super().__init__()
        import regex
        from tokenizers import Tokenizer

        self._model = Tokenizer.from_file(path).model
        self._letters = byte_letters()
        self.cut = regex.compile(PATTERN).findall

    def __missing__(self, piece: str) -> int:
        found = len(self._model.tokenize("".join(map(self._letters.__getitem__, piece.encode()))))
        if len(self) >= CACHE:
            self.clear()
        self[piece] = found
        return found


_BY_PATH: dict[str, PreTokenCounts] = {}


def counts_by(path: str | None = None) -> PreTokenCounts:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    if path not in _BY_PATH:
        _BY_PATH[path] = cached("token counts", PreTokenCounts(path))
    only("token counts")
    return _BY_PATH[path]


def _leaves(sizes: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters, tokens and pre-tokens of each run of LEAF pre-tokens."""
    if not len(sizes):
        return np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)
    starts = np.arange(0, len(sizes), LEAF)
    return np.add.reduceat(sizes, starts), np.add.reduceat(tokens, starts), np.diff(np.append(starts, len(sizes)))


def cut_leaves(text: str, counts: PreTokenCounts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    pieces = counts.cut(text)
    n = len(pieces)
    return _leaves(np.fromiter(map(len, pieces), np.int64, n), np.fromiter(map(counts.__getitem__, pieces), np.int64, n))


class TokenTree:
    """Segment tree over leaves; node 1 is the root and node ``i`` has the children ``2 i`` and ``2 i + 1``."""

    def __init__(self, text: str, chars, tokens, pieces, counts: PreTokenCounts):
        self._counts = counts
        self.encoded = 0  # characters encoded since the tree was made
        self._plant(text, np.asarray(chars), np.asarray(tokens), np.asarray(pieces))

    @classmethod
    def of(cls, text: str, counts: PreTokenCounts) -> "TokenTree":
        return cls(text, *cut_leaves(text, counts), counts)

    def _plant(self, text: str, chars: np.ndarray, tokens: np.ndarray, pieces: np.ndarray) -> None:
        count = len(chars)
        self._base = 1 << max(0, (count - 1).bit_length())
        self._leaf_count = count
        ends = np.cumsum(chars)
        self._texts = [text[a:b] for a, b in zip(ends - chars, ends)]
        self._pieces = pieces.tolist()
        self._chars = self._sums(chars)
        self._tokens = self._sums(tokens)

    def _sums(self, leaves: np.ndarray) -> list[int]:
        level = np.zeros(self._base, np.int64)
        level[:len(leaves)] = leaves
        levels = [level]
        while len(levels[-1]) > 1:
            levels.append(levels[-1].reshape(-1, 2).sum(axis=1))
        return [0, *np.concatenate(levels[::-1]).tolist()]

    @property
    def n_tokens(self) -> int:
        return self._tokens[1]

    @property
    def n_chars(self) -> int:
        return self._chars[1]

    @property
    def text(self) -> str:
        return "".join(self._texts)

    def _find(self, position: int) -> tuple[int, int]:
        """Leaf that holds a character (the last one past the end) and the characters before that leaf."""
        node, before = 1, 0
        while node < self._base:
            node *= 2
            if position - before >= self._chars[node] and self._chars[node + 1]:
                before += self._chars[node]
                node += 1
        return min(node - self._base, self._leaf_count - 1), before

    def _set(self, leaf: int, text: str, tokens: int, pieces: int) -> None:
        self._texts[leaf], self._pieces[leaf] = text, pieces
        node = self._base + leaf
        chars_more, tokens_more = len(text) - self._chars[node], tokens - self._tokens[node]
        while node:
            self._chars[node] += chars_more
            self._tokens[node] += tokens_more
            node //= 2

    def edit(self, start: int, length: int, inserted: str) -> None:
        start = min(max(start, 0), self.n_chars)
        end = min(start + max(length, 0), self.n_chars)
        if start == end and not inserted:
            return
        first, before = self._find(max(start - CONTEXT, 0))
        last, _ = self._find(min(end + CONTEXT, max(self.n_chars - 1, 0)))
        last = max(first, last)
        region = "".join(self._texts[first:last + 1])
        region = region[:start - before] + inserted + region[end - before:]
        while True:
            ahead = self._texts[last + 1] if last + 1 < self._leaf_count else ""
            pieces = self._counts.cut(region + ahead)
            inside, at = 0, 0
            while inside < len(pieces) and at < len(region):
                at += len(pieces[inside])
                inside += 1
            self.encoded += len(region)
            if at == len(region) and (ahead or last + 1 >= self._leaf_count):
                break
            # A pre-token now reaches over the leaf's edge, or an empty leaf shows nothing: take one leaf more.
            last += 1
            region += ahead
        pieces = pieces[:inside]
        leaves = last - first + 1
        bounds = [len(pieces) * i // leaves for i in range(leaves + 1)]
        for i in range(leaves):
            part = pieces[bounds[i]:bounds[i + 1]]
            self._set(first + i, "".join(part), sum(map(self._counts.__getitem__, part)), len(part))
        if max(self._pieces[first:last + 1]) > GROWN:
            self._regrow()

    def _regrow(self) -> None:
        text = self.text
        self.encoded += len(text)
        self._plant(text, *cut_leaves(text, self._counts))


def placed(between: pa.Array, matches: pa.Array) -> pa.Array:
    """Where matches lie: lists of {start, length} from the lengths between and of the matches, by running sums over a batch."""
    found = np.diff(matches.offsets.to_numpy())
    lengths = matches.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    gaps = between.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(found)), found)
    # A row has one gap more than it has matches: the last one comes after all of them.
    firsts = np.concatenate([[0], np.cumsum(np.diff(between.offsets.to_numpy()))])[:-1]
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(found) - found, found)
    steps = gaps[firsts[rows] + nth] + lengths
    ends = np.cumsum(steps)
    base = np.concatenate([[0], ends])[np.cumsum(found) - found]
    starts = ends - lengths - base[rows]
    offsets = np.concatenate([[0], np.cumsum(found)]).astype(np.int32)
    items = pa.StructArray.from_arrays([pa.array(starts), pa.array(lengths)], names=["start", "length"])
    return pa.ListArray.from_arrays(pa.array(offsets), items)


def redactions(text: Column, pattern: str = REDACTED, mark: str = MARK, hints: tuple[str, ...] = HINTS) -> Column:
    """Edits that replace every match of a pattern, last one first; linear in the text.

    Matches are found with built-in functions; only their lengths go to Python, which adds them up.
    ``hints`` are strings one of which every match holds (none: every text is searched).
    """
    place = F.arrow_udf(placed, "array<struct<start: bigint, length: bigint>>")
    searched = F.greatest(*[F.contains(text, F.lit(h)) for h in hints], F.lit(False)) if hints else F.lit(True)
    between = F.when(searched, F.split(text, pattern, -1)).otherwise(F.array(F.lit("")))
    matches = F.when(searched, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    sizes = [F.transform(x, lambda s: F.length(s)) for x in (between, matches)]
    return F.reverse(F.transform(place(*sizes), lambda e: F.struct(e["start"].alias("start"), e["length"].alias("length"), F.lit(mark).alias("inserted"))))


_LISTS = "array<long>"


def token_trees(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, edits_col: str | None = None) -> DataFrame:
    """The trees' leaves: doc_id, text, leaf_chars, leaf_tokens, leaf_pieces, n_tokens (and edits, if the rows have some)."""
    id_type = docs.schema[id_col].dataType
    columns = [F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")]
    fields = [T.StructField("doc_id", id_type), T.StructField("text", T.StringType())]
    if edits_col:
        columns.append(F.col(edits_col).alias("edits"))
        fields.append(T.StructField("edits", docs.schema[edits_col].dataType))
    schema = T.StructType([*fields, *[T.StructField(n, T.ArrayType(T.LongType())) for n in ("leaf_chars", "leaf_tokens", "leaf_pieces")], T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counts_by(path)
        for batch in slices(batches):
            made = [cut_leaves(t.as_py(), counts) for t in batch.column(1)]
            lists = [_list([m[i] for m in made]) for i in range(3)]
            totals = pa.array([int(m[1].sum()) for m in made], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists, totals], names=schema.names)

    return docs.select(*columns).mapInArrow(tidy(run), schema)


def _list(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))


def apply_edits(trees: DataFrame, path: str | None = None, with_text: bool = True) -> DataFrame:
    """Edit documents from their trees: counts before and after, characters encoded again, and the new text."""
    fields = [
        trees.schema["doc_id"],
        *[T.StructField(n, T.LongType()) for n in ("n_edits", "tokens_before", "tokens_after", "chars_after", "chars_encoded")],
    ]
    schema = T.StructType([*fields, T.StructField("text", T.StringType())] if with_text else fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counts_by(path)
        for batch in slices(batches):
            rows, texts = [], []
            edits_of = batch.column(1).to_pylist()
            totals = batch.column(6).to_pylist()
            for i, edits in enumerate(edits_of):
                if not edits:
                    text = batch.column(2)[i].as_py()
                    rows.append((0, totals[i], totals[i], len(text), 0))
                else:
                    text = batch.column(2)[i].as_py()
                    tree = TokenTree(text, *(batch.column(c)[i].values.to_numpy() for c in (3, 4, 5)), counts)
                    for e in edits:
                        tree.edit(e["start"] or 0, e["length"] or 0, e["inserted"] or "")
                    rows.append((len(edits), totals[i], tree.n_tokens, tree.n_chars, tree.encoded))
                    text = tree.text if with_text else ""
                if with_text:
                    texts.append(text)
            columns = [batch.column(0), *[pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 5)]]
            if with_text:
                columns.append(pa.array(texts, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    ordered = trees.select("doc_id", "edits", "text", "leaf_chars", "leaf_tokens", "leaf_pieces", "n_tokens")
    return ordered.mapInArrow(tidy(run), schema)


def op2_token_counts(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    edited = docs.withColumn("edits", redactions(F.coalesce("text", F.lit(""))))
    return apply_edits(token_trees(edited, edits_col="edits"), with_text=False)
