"""Language of whole texts by a bidirectional gated recurrent network over bytes.

Texts are read as UTF-8 bytes in windows of ``WINDOW`` positions, all of them, so that a text of any length
costs in proportion and long texts fill batches like short ones. In each window two gated recurrent units
run over the bytes, one from either side; every position gets the probabilities of all languages from both
states, and a document's probabilities are the mean over all its positions.

The network is written in numpy and trained by backpropagation through time on the driver, on a bounded
sample: of each language the documents whose ids hash lowest, at most ``PER_LANGUAGE`` and at most an equal
share of ``SAMPLE`` but one at least, so that no language is lost at any size of the table; and of each document
one passage of ``PASSAGE`` bytes at a hashed place. Documents held out never enter the sample. Prediction reads
the text only.

Defined cases: a null text or one without a letter is ``und`` with score 0, and so is every text if no
labelled document may be learned from; a null id hashes as the empty text; bytes of several-byte characters
are positions of their own; repeated rows each come back; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskmart.llm.common import only, slices, tidy

WINDOW = 64
HIDDEN = 8
BATCH = 1_024
PER_LANGUAGE = 800
SAMPLE = 20_000
PASSAGE = 256
STEPS = 240
TRAIN_BATCH = 256
UNKNOWN = "und"


class ByteGRU:
    """Two gated recurrent units over bytes and a softmax at every position.

    Gates and candidate are piecewise linear (cut off at 0 and 1, and at -1 and 1). Arrays hold both
    directions first and the windows last, so that every step works on unbroken rows.
    """

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        draw = lambda scale, *shape: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.p = {
            "table": draw(0.2, 2, 3 * hidden, 256),  # what each byte adds to update gate, reset gate and candidate
            "u": draw(0.7 / np.sqrt(hidden), 2, 3 * hidden, hidden),
            "out": draw(0.3, len(languages), 2 * hidden),
            "bias": np.zeros((len(languages), 1), np.float32),
        }
        self.p["table"][:, :hidden] += 0.7  # remember at first
        self.p["table"][:, hidden:2 * hidden] += 0.5

    def _states(self, windows: np.ndarray, keep: bool = False):
        """States (length, 2 * hidden, count) at their positions; what the backward pass needs, if asked."""
        hidden, (count, length) = self.hidden, windows.shape
        read = np.ascontiguousarray(windows.T).astype(np.intp)
        table, u = self.p["table"], self.p["u"]
        h = np.zeros((2, hidden, count), np.float32)
        states = np.empty((length, 2 * hidden, count), np.float32)
        saved = []
        x = np.empty((2, 3 * hidden, count), np.float32)
        a = np.empty((2, 3 * hidden, count), np.float32)
        for t in range(length):
            np.take(table[0], read[t], axis=1, out=x[0], mode="clip")
            np.take(table[1], read[length - 1 - t], axis=1, out=x[1], mode="clip")
            np.matmul(u, h, out=a)
            g = x[:, :2 * hidden] + a[:, :2 * hidden]
            np.maximum(g, 0, out=g)
            np.minimum(g, 1, out=g)
            z, r = g[:, :hidden], g[:, hidden:]
            n = r * a[:, 2 * hidden:]
            n += x[:, 2 * hidden:]
            np.maximum(n, -1, out=n)
            np.minimum(n, 1, out=n)
            if keep:
                saved.append((h, z, r, n, a[:, 2 * hidden:].copy()))
            h = h - n
            h *= z
            h += n
            states[t, :hidden] = h[0]
            states[length - 1 - t, hidden:] = h[1]
        return states, read, saved

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """(length, languages, count) for every position."""
        states, _, _ = self._states(windows)
        return self._softmax(states)

    def _softmax(self, states: np.ndarray) -> np.ndarray:
        z = self.p["out"] @ states
        z += self.p["bias"]
        z -= z.max(axis=1, keepdims=True)
        np.exp(z, out=z)
        z /= z.sum(axis=1, keepdims=True)
        return z

    def gradients(self, windows: np.ndarray, labels: np.ndarray, sizes: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over real positions, and its gradients by backpropagation through time."""
        hidden, (count, length) = self.hidden, windows.shape
        states, read, saved = self._states(windows, keep=True)
        dz = self._softmax(states)
        mask = (np.arange(length)[:, None] < sizes[None, :]).astype(np.float32)
        total = max(float(mask.sum()), 1.0)
        columns = np.arange(count)
        picked = dz[:, labels, columns]
        loss = float(-(np.log(picked + 1e-9) * mask).sum() / total)
        dz[:, labels, columns] -= 1
        dz *= (mask / total)[:, None, :]
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        grads["out"] = np.einsum("tkc,thc->kh", dz, states, optimize=True)
        grads["bias"] = dz.sum(axis=(0, 2))[:, None]
        dstates = self.p["out"].T @ dz
        dh = np.zeros((2, hidden, count), np.float32)
        back = self.p["u"].transpose(0, 2, 1)
        for t in range(length - 1, -1, -1):
            h, z, r, n, recurrent = saved[t]
            dh[0] += dstates[t, :hidden]
            dh[1] += dstates[length - 1 - t, hidden:]
            dn = dh * (1 - z) * (np.abs(n) < 1)
            dgates = np.concatenate([dh * (h - n) * ((z > 0) & (z < 1)), dn * recurrent * ((r > 0) & (r < 1))], axis=1)
            inner = np.concatenate([dgates, dn * r], axis=1)
            grads["u"] += inner @ h.transpose(0, 2, 1)
            added = np.concatenate([dgates, dn], axis=1)
            for d, at in ((0, read[t]), (1, read[length - 1 - t])):
                for row in range(3 * hidden):
                    grads["table"][d, row] += np.bincount(at, added[d, row], 256)
            dh = dh * z + back @ inner
        return loss, grads

    def fit(self, windows: np.ndarray, labels: np.ndarray, sizes: np.ndarray, steps: int = STEPS, batch: int = TRAIN_BATCH, rate: float = 0.02, seed: int = 3) -> list[float]:
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        weight = 1.0 / np.bincount(labels, minlength=len(self.languages)).clip(1)[labels]  # every language as often
        losses = []
        for step in range(1, steps + 1):
            rows = rng.choice(len(windows), min(batch, len(windows)), p=weight / weight.sum())
            chosen, real = windows[rows].copy(), sizes[rows].copy()
            short = rng.random(len(rows)) < 0.2  # texts end anywhere
            real[short] = np.maximum(1, (real[short] * rng.random(int(short.sum()))).astype(int))
            chosen[np.arange(chosen.shape[1])[None, :] >= real[:, None]] = 0
            loss, grads = self.gradients(chosen, labels[rows], real)
            losses.append(loss)
            norm = np.sqrt(sum(float((g ** 2).sum()) for g in grads.values()))
            for k, g in grads.items():
                g = g * min(1.0, 2.0 / (norm + 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                now = rate * (1 - 0.9 * step / steps)
                self.p[k] = (self.p[k] - now * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
        return losses

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities over all positions of each text; zeros for an empty one."""
        out = np.zeros((len(texts), len(self.languages)))
        waiting, held = [], 0
        for i, text in enumerate(texts):
            waiting.append((i, text))
            held += -(-len(text) // WINDOW)
            if held >= BATCH:
                self._pool(waiting, out)
                waiting, held = [], 0
        if waiting:
            self._pool(waiting, out)
        sizes = np.array([max(len(t), 1) for t in texts], float)
        return out / sizes[:, None]

    def _pool(self, texts: list[tuple[int, bytes]], out: np.ndarray) -> None:
        windows, owners, sizes = cut([t for _, t in texts])
        index = np.array([i for i, _ in texts])
        for start in range(0, len(windows), BATCH):
            part = slice(start, start + BATCH)
            prob = self.probabilities(windows[part])
            if sizes[part].min() < WINDOW:
                prob *= (np.arange(WINDOW)[:, None] < sizes[None, part])[:, None, :]
            np.add.at(out, index[owners[part]], prob.sum(axis=0).T)


def cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of all texts in windows; which text each window is of, and its number of real bytes."""
    counts = np.array([-(-len(t) // WINDOW) for t in texts])
    joined = b"".join(t + bytes(-len(t) % WINDOW) for t in texts)
    windows = np.frombuffer(joined, np.uint8).reshape(-1, WINDOW)
    owners = np.repeat(np.arange(len(texts)), counts)
    sizes = np.full(len(windows), WINDOW)
    last = np.cumsum(counts)[counts > 0] - 1
    sizes[last] = np.array([len(t) for t in texts])[counts > 0] - (counts[counts > 0] - 1) * WINDOW
    return windows, owners, sizes


def held_out(id_col: str) -> Column:
    """Documents never learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", seed: int = 3) -> ByteGRU | None:
    """Train on the bounded sample; None if there is nothing to learn from."""
    data = F.col(text_col).cast("binary")
    place = F.pmod(F.xxhash64(F.col(id_col), F.lit("place")), F.greatest(F.octet_length(data) - PASSAGE, F.lit(1))).cast("int") + 1
    readable = docs.filter(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    rows = readable.select(F.col(lang_col).alias("lang"), F.xxhash64(id_col).alias("h"), F.substring(data, place, F.lit(PASSAGE)).alias("passage"))
    # One row per language, as in the model. Sizes are of the rows to be ranked, so that a cut by size spares rare readable ones.
    counts = readable.groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("n"), F.min(F.xxhash64(id_col)).alias("least"))
    found = counts.collect()
    if not found:
        return None
    each = max(1, min(PER_LANGUAGE, SAMPLE // len(found)))
    sizes = F.broadcast(docs.sparkSession.createDataFrame(found, counts.schema))
    # Hashes spread evenly: only rows below about four times a language's expected cut go to its ranking, its lowest always.
    share = F.shiftrightunsigned(F.col("h").bitwiseXOR(F.lit(-(1 << 63))), 11) / float(1 << 53)
    near = (share <= 4.0 * PER_LANGUAGE / F.col("n")) | (F.col("h") == F.col("least"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h", "passage"))
    chosen = (
        rows.join(sizes, "lang").filter(near).withColumn("nth", nth)
        .filter(F.col("nth") <= each).orderBy("h", "lang", "passage").collect()
    )
    languages = sorted({r["lang"] for r in chosen})
    windows, owners, sizes = cut([bytes(r["passage"]) for r in chosen])
    labels = np.array([languages.index(r["lang"]) for r in chosen])[owners]
    model = ByteGRU(languages, seed=seed)
    model.fit(windows, labels, sizes)
    return model


def identify(docs: DataFrame, model: ByteGRU | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, from the whole text."""
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = docs.schema[id_col].dataType
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return docs.select(
            F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score")
        )
    arrow = pa.schema([("doc_id", to_arrow_type(id_type)), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("language")
        names = np.array(model.languages, dtype=object)
        for batch in slices(batches):
            readable = np.array(batch.column(2).to_pylist(), bool)
            texts = [t if ok else b"" for t, ok in zip(batch.column(3).to_pylist(), readable)]
            prob = model.pooled(texts)
            best = prob.argmax(axis=1)
            lang = np.where(readable, names[best], UNKNOWN) if len(best) else names[best]
            score = np.where(readable, np.clip(prob[np.arange(len(best)), best], 0.0, 1.0), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64())], schema=arrow)

    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("held_out", T.BooleanType()), T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ])
    slim = docs.select(F.col(id_col), held_out(id_col), letters, F.col(text_col).cast("binary"))
    return slim.mapInArrow(tidy(run), schema)


def op5_identify_language(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(docs, learn(docs))
