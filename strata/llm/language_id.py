"""Operator 9: language identification with a byte-level convolutional network trained in numpy.

Bytes are embedded, filters of several widths slide over fixed-length windows,
each filter's maximum over the window is kept, and a softmax layer gives label
probabilities. A text's probabilities are the mean over all its windows, weighted
by their bytes, so whole texts are judged.

Training uses a bounded sample: for each label about ``per_label`` distinct texts,
chosen by a hash of the text from exact counts of the label's distinct texts, and
``windows_per_doc`` windows of each. Copies and repeated ids neither crowd a label
out nor enlarge the sample. Prediction needs the text only.

Null text and text without a letter give label ``und`` and score 0. Null labels
are never learned; with no labelled document every text is ``und``. Each row is
judged on its own, so repeated rows agree and extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, text_bytes, tidy, without

UNDETERMINED = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
#: Labels are a vocabulary; more distinct values than this are refused rather than collected.
MAX_LABELS = 5000

_LETTERS = np.zeros(256, np.uint8)
_LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1


@dataclass
class ByteCNN:
    """Trained weights: byte embedding, one filter bank per width, softmax layer."""

    labels: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    weights: np.ndarray
    offset: np.ndarray

    def tables(self) -> list[list[np.ndarray]]:
        """Each filter bank as sums of lookup tables over byte pairs and single bytes."""
        out = []
        for bank, bias in zip(self.filters, self.biases, strict=True):
            single = [self.embedding @ taps for taps in bank]  # one (256, filters) table per tap
            parts = [(single[j][:, None, :] + single[j + 1][None, :, :]).reshape(65536, -1) if j + 1 < len(single) else single[j]
                     for j in range(0, len(single), 2)]
            parts[0] = parts[0] + bias
            out.append([np.ascontiguousarray(p, dtype=np.float32) for p in parts])
        return out

    def predictor(self):
        """A function from windows (n, WINDOW) of bytes to label probabilities (n, labels)."""
        tables = self.tables()

        def pooled(windows: np.ndarray) -> np.ndarray:
            wide = windows.astype(np.intp)
            pairs = (wide[:, :-1] << 8) | wide[:, 1:]
            columns = []
            for width, parts in zip(WIDTHS, tables, strict=True):
                span = WINDOW - width + 1
                total = parts[0].take(pairs[:, :span], axis=0)
                for k, part in enumerate(parts[1:], 1):
                    index = pairs if len(part) == 65536 else wide
                    total += part.take(index[:, 2 * k:2 * k + span], axis=0)
                columns.append(total.max(axis=1))
            return np.maximum(np.concatenate(columns, axis=1), 0)

        def predict(windows: np.ndarray) -> np.ndarray:
            hidden = [pooled(windows[i:i + 32]) for i in range(0, len(windows), 32)]
            return softmax(np.concatenate(hidden) @ self.weights + self.offset)

        return predict


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, targets: np.ndarray, labels: list[str], embedding: int = 12, filters: int = 16,
          epochs: int = 6, batch: int = 64, rate: float = 0.004, seed: int = 7) -> ByteCNN:
    """Fit by Adam on cross-entropy; gradients pass the max pooling through each filter's best position."""
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.3, (256, embedding)).astype(np.float32)
    banks = [rng.normal(0, (w * embedding) ** -0.5, (w, embedding, filters)).astype(np.float32) for w in WIDTHS]
    biases = [np.zeros(filters, np.float32) for _ in WIDTHS]
    dense = rng.normal(0, (len(WIDTHS) * filters) ** -0.5, (len(WIDTHS) * filters, len(labels))).astype(np.float32)
    offset = np.zeros(len(labels), np.float32)
    params = [table, *banks, *biases, dense, offset]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for i in range(0, len(order), batch):
            rows = order[i:i + batch]
            x, n = windows[rows].astype(np.intp), len(rows)
            embedded = table[x]
            best, peaks = [], []
            for width, bank, bias in zip(WIDTHS, banks, biases, strict=True):
                span = WINDOW - width + 1
                total = sum(embedded[:, j:j + span] @ bank[j] for j in range(width)) + bias
                at = total.argmax(axis=1)
                best.append(at)
                peaks.append(np.take_along_axis(total, at[:, None, :], axis=1)[:, 0])
            raw = np.concatenate(peaks, axis=1)
            hidden = np.maximum(raw, 0)
            slope = softmax(hidden @ dense + offset)
            slope[np.arange(n), targets[rows]] -= 1
            slope /= n
            back = (slope @ dense.T) * (raw > 0)
            g_table, g_banks, g_biases = np.zeros_like(table), [], []
            for k, (width, bank, at) in enumerate(zip(WIDTHS, banks, best, strict=True)):
                g = back[:, k * filters:(k + 1) * filters]
                g_bank = np.zeros_like(bank)
                for j in range(width):
                    seen = x[np.arange(n)[:, None], at + j]
                    g_bank[j] = np.einsum("nfe,nf->ef", table[seen], g)
                    np.add.at(g_table, seen, g[:, :, None] * bank[j].T[None])
                g_banks.append(g_bank)
                g_biases.append(g.sum(axis=0))
            step += 1
            for p, g, m, v in zip(params, [g_table, *g_banks, *g_biases, hidden.T @ slope, slope.sum(axis=0)], first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return ByteCNN(labels, table, banks, biases, dense, offset)


def to_windows(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of concatenated texts: bytes (zero-padded at each text's end), text row and bytes of each window."""
    lengths = np.diff(offsets)
    counts = -(-lengths // WINDOW)
    rows = np.repeat(np.arange(len(lengths)), counts)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    used = np.minimum(lengths[rows] - nth * WINDOW, WINDOW)
    at = (offsets[rows] + nth * WINDOW)[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < used[:, None]
    out = raw[np.minimum(at, len(raw) - 1)] if len(raw) else np.zeros((len(rows), WINDOW), np.uint8)
    return np.where(inside, out, 0).astype(np.uint8), rows, used


def has_letter(raw: np.ndarray, offsets: np.ndarray, texts: list[str | None]) -> np.ndarray:
    """Whether each text has a Unicode letter."""
    seen = np.concatenate([[0], np.cumsum(_LETTERS[raw], dtype=np.int64)])
    out = seen[offsets[1:]] > seen[offsets[:-1]]
    for i in np.flatnonzero(~out):
        out[i] = any(c.isalpha() for c in texts[i] or "")
    return out


def fit(labelled: DataFrame, text: str = "text", label: str = "lang", per_label: int = 600,
        windows_per_doc: int = 4, **options) -> ByteCNN | None:
    """Train on a bounded sample of labelled rows (null labels and null texts are left out); None without any."""
    rows = labelled.select(F.col(text).cast("string").alias("text"), F.col(label).cast("string").alias("label")).where(F.col("label").isNotNull() & F.col("text").isNotNull())
    rows = rows.withColumn("key", F.xxhash64("text"))
    counts = {r["label"]: r["count"] for r in rows.select("label", "key").distinct().groupBy("label").count().limit(MAX_LABELS + 1).collect()}
    if len(counts) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels")
    if not counts:
        return None
    labels = sorted(counts)
    share = F.create_map(*[F.lit(v) for k in labels for v in (k, min(1.0, per_label / counts[k]))])
    rank = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.where(rank < F.element_at(share, F.col("label"))).dropDuplicates(["label", "key"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.slice(i, 1)
                windows, _, used = to_windows(*text_bytes(part.column("text")))
                full = np.flatnonzero(used == used.max()) if len(used) else used
                pick = full[np.unique(np.linspace(0, len(full) - 1, windows_per_doc).astype(int))] if len(full) else full
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.column("key").to_pylist() * len(pick), pa.int64()), pa.array(part.column("label").to_pylist() * len(pick), pa.string()),
                     pa.array([windows[p].tobytes() for p in pick], pa.binary())], ["key", "label", "bytes"])

    got = sorted((r["label"], r["key"], bytes(r["bytes"])) for r in sample.mapInArrow(tidy(cut), "key long, label string, bytes binary").toLocalIterator())
    labels = sorted({g[0] for g in got})
    if not got:
        return None
    code = {name: i for i, name in enumerate(labels)}
    windows = np.frombuffer(b"".join(g[2] for g in got), np.uint8).reshape(-1, WINDOW)
    return train(windows, np.array([code[g[0]] for g in got]), labels, **options)


def predict(df: DataFrame, model: ByteCNN | None, text: str = "text", label: str = "lang_pred", score: str = "score") -> DataFrame:
    """Add the predicted label and its probability; reads nothing but the text. Columns called like them are replaced."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = model.predictor() if model else None
        for batch in batches:
            raw, offsets = text_bytes(batch.column(text))
            labels, scores = np.full(batch.num_rows, UNDETERMINED, object), np.zeros(batch.num_rows)
            for i, j in chunks(offsets, 1 << 20):
                own = offsets[i:j + 1] - offsets[i]
                piece = raw[offsets[i]:offsets[j]]
                known = has_letter(piece, own, batch.column(text).slice(i, j - i).to_pylist())
                if judge is None or not known.any():
                    continue
                total = np.zeros((j - i, len(model.labels)))
                windows, rows, used = to_windows(piece, own)
                np.add.at(total, rows, judge(windows) * used[:, None])
                total /= np.maximum(np.diff(own), 1)[:, None]
                best = total.argmax(axis=1)
                labels[i:j][known] = np.array(model.labels, object)[best[known]]
                scores[i:j][known] = np.clip(total[np.arange(j - i), best][known], 0, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(labels, pa.string()), pa.array(scores)], [*batch.schema.names, label, score])

    df = without(df, [label, score], [text])
    return df.mapInArrow(tidy(run), T.StructType([*df.schema.fields, T.StructField(label, T.StringType()), T.StructField(score, T.DoubleType())]))


def held_out(key: str = "doc_id"):
    """True for documents whose crc32 of the id's text is 2 modulo 4 (false for a null id)."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_on_rest(docs: DataFrame, **options) -> ByteCNN | None:
    """A model learned from the documents that are not held out."""
    return fit(docs.where(F.col("doc_id").isNotNull() & ~held_out()), **options)


def identify(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    model = fit_on_rest(docs, **options)
    slim = docs.select("doc_id", held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return predict(slim, model).select("doc_id", "held_out", "lang_pred", "score")
