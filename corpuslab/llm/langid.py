"""Language identification with a byte convolutional network.

Byte embeddings, convolutions of widths 2, 3 and 4, max pooling over fixed-length windows, one dense layer, softmax;
trained in numpy with Adam. A convolution over embedded bytes is a sum of one table row per byte, so for prediction
the trained filters are unfolded into byte and byte-pair tables (exactly the same numbers) and applied by lookups.

Training reads labelled windows from a hash sample of at most ``WINDOWS_PER_LANG`` documents per language (the one
bounded sample here); every prediction covers the whole text: it is cut into windows of ``WINDOW`` bytes, the log
probabilities of its windows are averaged with their lengths as weights and normalised again. Rows are independent,
nothing is shuffled, the broadcast model has a fixed size.

Edge cases: null texts and texts without a letter get ``und`` with score 1; the last window of a text is padded with
zero bytes; very long texts are walked in blocks of windows; repeated rows repeat their result; without any labelled
text there is no model and every row is ``und`` with score 0; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslab.llm.common import text_bytes

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBED = 8
LANGS = 256  # most languages a model may have
WINDOWS_PER_LANG = 1_500
STEPS = 600
BATCH = 64
BLOCK = 1_024  # windows per block of lookups
LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"


class ByteConvNet:
    """Parameters of the network and its training step."""

    def __init__(self, langs: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.params = {"embed": rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)}
        self.params["embed"][0] = 0  # padding
        for w in WIDTHS:
            self.params[f"conv{w}"] = rng.normal(0, (w * EMBED) ** -0.5, (w * EMBED, FILTERS)).astype(np.float32)
            self.params[f"bias{w}"] = np.zeros(FILTERS, np.float32)
        self.params["dense"] = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(langs))).astype(np.float32)
        self.params["out"] = np.zeros(len(langs), np.float32)

    def step(self, windows: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients of one batch of windows ``(B, WINDOW)``."""
        p, size = self.params, len(windows)
        embedded = p["embed"][windows]
        pooled, kept = [], []
        for w in WIDTHS:
            steps = windows.shape[1] - w + 1
            patches = np.concatenate([embedded[:, j:j + steps] for j in range(w)], axis=2)
            scores = patches @ p[f"conv{w}"] + p[f"bias{w}"]
            best = scores.argmax(1)
            pooled.append(np.take_along_axis(scores, best[:, None], 1)[:, 0])
            kept.append(best)
        raw = np.concatenate(pooled, 1)
        hidden = np.maximum(raw, 0)
        logits = hidden @ p["dense"] + p["out"]
        logits -= logits.max(1, keepdims=True)
        probs = np.exp(logits)
        probs /= probs.sum(1, keepdims=True)
        loss = float(-np.log(probs[np.arange(size), labels] + 1e-9).mean())
        delta = probs.copy()
        delta[np.arange(size), labels] -= 1
        delta /= size
        grads = {"dense": hidden.T @ delta, "out": delta.sum(0), "embed": np.zeros_like(p["embed"])}
        back = (delta @ p["dense"].T) * (raw > 0)
        rows = np.arange(size)[:, None]
        for i, w in enumerate(WIDTHS):
            part, best = back[:, i * FILTERS:(i + 1) * FILTERS], kept[i]
            taken = np.concatenate([embedded[rows, best + j] for j in range(w)], axis=2)  # (B, F, w * E)
            grads[f"conv{w}"] = np.einsum("bf,bfe->ef", part, taken)
            grads[f"bias{w}"] = part.sum(0)
            to_patch = part[:, :, None] * p[f"conv{w}"].T[None]
            for j in range(w):
                np.add.at(grads["embed"], windows[rows, best + j], to_patch[:, :, j * EMBED:(j + 1) * EMBED])
        grads["embed"][0] = 0
        return loss, grads

    def fit(self, windows: np.ndarray, labels: np.ndarray, steps: int = STEPS, rate: float = 0.01, seed: int = 11) -> float:
        """Adam over class-balanced random batches; returns the mean loss of the last tenth of the steps."""
        rng = np.random.default_rng(seed)
        by_lang = [np.flatnonzero(labels == k) for k in range(len(self.langs))]
        first = {k: np.zeros_like(v) for k, v in self.params.items()}
        second = {k: np.zeros_like(v) for k, v in self.params.items()}
        losses = []
        for t in range(1, steps + 1):
            picked = np.array([rng.choice(by_lang[k]) for k in rng.integers(0, len(by_lang), BATCH)])
            loss, grads = self.step(windows[picked], labels[picked])
            losses.append(loss)
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                lift = rate * min(1.0, 4 * (1 - t / (steps + 1)))
                self.params[k] -= (lift * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
        return float(np.mean(losses[-max(1, steps // 10):]))

    def unfold(self) -> dict:
        """Lookup form: per width the rows that byte pairs (and a last single byte) add to the filters."""
        p, tables = self.params, []
        for w in WIDTHS:
            single = [p["embed"] @ p[f"conv{w}"][j * EMBED:(j + 1) * EMBED] for j in range(w)]  # (256, F) per offset
            parts = []
            for j in range(0, w - 1, 2):
                parts.append((j, (single[j][:, None] + single[j + 1][None, :]).reshape(65_536, FILTERS)))
            if w % 2:
                parts.append((w - 1, single[w - 1]))
            tables.append((w, p[f"bias{w}"], parts))
        return {"langs": self.langs, "tables": tables, "dense": p["dense"], "out": p["out"]}


def to_windows(data: bytes) -> np.ndarray:
    """``(n, WINDOW)`` bytes of a whole text, the last window padded with zeros."""
    n = max(1, -(-len(data) // WINDOW))
    flat = np.zeros(n * WINDOW, np.uint8)
    flat[:len(data)] = np.frombuffer(data, np.uint8)
    return flat.reshape(n, WINDOW)


def log_probabilities(model: dict, windows: np.ndarray) -> np.ndarray:
    """Log probability of each language per window: all filters at all positions, then max pooling."""
    out = []
    for at in range(0, len(windows), BLOCK):
        part = windows[at:at + BLOCK]
        pairs = part[:, :-1].astype(np.uint16) * np.uint16(256) + part[:, 1:]
        pooled = []
        for w, bias, tables in model["tables"]:
            steps = WINDOW - w + 1
            scores = None
            for j, rows in tables:
                index = pairs[:, j:j + steps] if len(rows) > 256 else part[:, j:j + steps]
                got = rows.take(index, axis=0)
                scores = got if scores is None else np.add(scores, got, out=scores)
            pooled.append(scores.max(1) + bias)
        logits = np.maximum(np.concatenate(pooled, 1), 0) @ model["dense"] + model["out"]
        top = logits.max(1, keepdims=True)
        out.append(logits - top - np.log(np.exp(logits - top).sum(1, keepdims=True)))
    return np.concatenate(out)


def predict_batch(model: dict, texts: list[bytes]) -> tuple[list[str], list[float]]:
    """Language and score of each text; windows of all texts of a batch are looked up together, block by block."""
    langs, scores = [UNKNOWN] * len(texts), [1.0] * len(texts)
    pending: list[tuple[int, np.ndarray, int]] = []

    def flush() -> None:
        if not pending:
            return
        logs = log_probabilities(model, np.concatenate([w for _, w, _ in pending]))
        at = 0
        for row, windows, length in pending:
            part = logs[at:at + len(windows)]
            at += len(windows)
            weights = np.full(len(windows), float(WINDOW))
            weights[-1] = length - WINDOW * (len(windows) - 1)
            mean = weights @ part / weights.sum()
            probs = np.exp(mean - mean.max())
            probs /= probs.sum()
            best = int(probs.argmax())
            langs[row], scores[row] = model["langs"][best], float(probs[best])
        pending.clear()

    waiting = 0
    for row, data in enumerate(texts):
        if not data or not LETTER.search(data.decode("utf-8", "replace")):
            continue
        if not model["langs"]:
            scores[row] = 0.0
            continue
        windows = to_windows(data)
        pending.append((row, windows, len(data)))
        waiting += len(windows)
        if waiting >= BLOCK:
            flush()
            waiting = 0
    flush()
    return langs, scores


def training_windows(docs: DataFrame, text: str, label: str, key: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, windows and labels: one window per sampled document, at a hashed place of its text.

    Per language documents are sampled by a hash of the key at a rate that yields about ``WINDOWS_PER_LANG`` rows.
    """
    known = docs.filter(F.col(label).isNotNull() & (F.length(text) > 0))
    counts = {r[0]: r[1] for r in known.groupBy(label).count().orderBy(F.desc("count"), label).limit(LANGS).collect()}
    if not counts:
        return [], np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64)
    rate = F.coalesce(*[F.when(F.col(label) == k, F.lit(WINDOWS_PER_LANG / n)) for k, n in sorted(counts.items())])
    chance = F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    span = F.greatest(F.lit(1), F.length(text) - WINDOW + 1)
    start = F.pmod(F.xxhash64(F.col(key), F.lit("place")), span) + 1
    piece = F.substr(F.col(text), start.cast("int"), F.lit(WINDOW)).cast("binary")
    rows = known.filter(chance < rate).select(F.col(key).alias("k"), F.col(label).alias("l"), piece.alias("piece")).collect()
    rows.sort(key=lambda r: (r.l, str(r.k)))
    langs = sorted(counts)
    place = {k: i for i, k in enumerate(langs)}
    windows, labels, used = [], [], dict.fromkeys(langs, 0)
    for r in rows:
        if used[r.l] < 2 * WINDOWS_PER_LANG:
            used[r.l] += 1
            windows.append(to_windows(bytes(r.piece)[:WINDOW])[0])
            labels.append(place[r.l])
    if not windows:
        return [], np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64)
    present = sorted(set(labels))
    renumber = {old: new for new, old in enumerate(present)}
    return [langs[i] for i in present], np.stack(windows), np.array([renumber[i] for i in labels])


def train(docs: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id") -> dict:
    """The unfolded model of a labelled table."""
    langs, windows, labels = training_windows(docs, text, label, key)
    net = ByteConvNet(langs)
    if len(windows):
        net.fit(windows, labels)
    return net.unfold()


def predict(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to all rows (columns of that name are replaced)."""
    from pyspark.sql.functions import arrow_udf

    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few MB whatever the input

    @arrow_udf("struct<lang_pred: string, score: double>")
    def classify(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            langs, scores = predict_batch(shared.value, column.to_pylist())
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    guess = classify.asNondeterministic()(text_bytes(text))
    out = docs.drop("lang_pred", "score").withColumn("_guess", guess)
    return out.select(*[c for c in out.columns if c != "_guess"], "_guess.lang_pred", "_guess.score")


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2


def language_digests(docs: DataFrame) -> DataFrame:
    """The contract's rows: trained on the rows that are not held out, predicted for all."""
    is_held = F.coalesce(held_out(), F.lit(False))
    model = train(docs.filter(~is_held).select("doc_id", "text", "lang"))
    rows = docs.select("doc_id", "text", is_held.alias("held_out"))
    return predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")
