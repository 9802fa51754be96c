"""Language identification with a bidirectional gated recurrent network over bytes.

The network reads a text's bytes in both directions with a gated recurrent unit each, labels every
byte position with language probabilities, and a document's probabilities are the mean over all its
positions. It is trained here, in numpy, by backpropagation through time.

Training uses a bounded sample: about TRAIN_DOCS documents per language, chosen by hash, and
TRAIN_WINDOWS windows of WINDOW bytes spread evenly over each. Which rows may teach is a condition
that the caller gives. Prediction runs over whole texts in Spark tasks. A text is cut into segments
of SEGMENT bytes that are read side by side, so long texts take more segments, not more memory: a
batch holds SEGMENTS segments at most.

Edge cases: a text that is null or has no letter gets `und` with score 0, as does every text if
nothing could be learned; rows without a language teach nothing; repeated rows are predicted alike;
a null doc_id belongs to the training part; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardgrid.llm import words

HIDDEN = 12
TRAIN_DOCS = 300
TRAIN_WINDOWS = 6
WINDOW = 64
STEPS = 220
BATCH = 128
SEGMENT = 128
SEGMENTS = 4096
UNKNOWN = "und"
MAX_LANGUAGES = 1000


def fold(doc_id: Column) -> Column:
    """0 to 3; documents of fold 2 are held out."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4))


# ---------------------------------------------------------------------------- network


def new_network(languages: int, hidden: int = HIDDEN, seed: int = 0) -> dict[str, np.ndarray]:
    """Per direction d: W{d} byte to gates, U{d} state to gates, O{d} state to labels; gates: z, r, n."""
    rng = np.random.default_rng(seed)
    net = {"b": np.zeros((languages, 1), np.float32)}
    for d in "fb":
        net["W" + d] = (rng.standard_normal((3 * hidden, 256)) * 0.3).astype(np.float32)
        net["U" + d] = (rng.standard_normal((3 * hidden, hidden)) / np.sqrt(hidden)).astype(np.float32)
        net["O" + d] = (rng.standard_normal((languages, hidden)) / np.sqrt(hidden)).astype(np.float32)
    return net


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _softmax(x: np.ndarray, axis: int) -> np.ndarray:
    e = np.exp(x - x.max(axis=axis, keepdims=True))
    return e / e.sum(axis=axis, keepdims=True)


def loss_and_gradients(net: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy over all positions of x (time, batch) with labels y (batch), and its gradients."""
    time, batch = x.shape
    hidden = net["Uf"].shape[1]
    kept, logits = {}, np.repeat(net["b"][None], time, axis=0) + np.zeros((time, net["b"].shape[0], batch), np.float32)
    for d in "fb":
        h, states = np.zeros((hidden, batch), np.float32), []
        for t in range(time) if d == "f" else range(time - 1, -1, -1):
            g, u = net["W" + d][:, x[t]], net["U" + d] @ h
            z = _sigmoid(g[:hidden] + u[:hidden])
            r = _sigmoid(g[hidden : 2 * hidden] + u[hidden : 2 * hidden])
            n = np.tanh(g[2 * hidden :] + r * u[2 * hidden :])
            states.append((t, h, z, r, n, u[2 * hidden :]))
            h = n + z * (h - n)
            logits[t] += net["O" + d] @ h
        kept[d] = states
    p = _softmax(logits, 1)
    loss = float(-np.log(p[:, y, np.arange(batch)] + 1e-9).mean())
    p[:, y, np.arange(batch)] -= 1
    p /= time * batch
    grads = {k: np.zeros_like(v) for k, v in net.items()}
    grads["b"] = p.sum(axis=(0, 2))[:, None]
    for d in "fb":
        back = np.zeros((hidden, batch), np.float32)
        gates = np.empty((3 * hidden, batch), np.float32)
        rows = []
        for t, h, z, r, n, un in reversed(kept[d]):
            new = n + z * (h - n)
            grads["O" + d] += p[t] @ new.T
            dh = back + net["O" + d].T @ p[t]
            dn = dh * (1 - z) * (1 - n * n)
            gates[:hidden] = dh * (h - n) * z * (1 - z)
            gates[hidden : 2 * hidden] = dn * un * r * (1 - r)
            gates[2 * hidden :] = dn
            rows.append((t, gates.copy()))
            state = gates.copy()
            state[2 * hidden :] *= r
            grads["U" + d] += state @ h.T
            back = dh * z + net["U" + d].T @ state
        flat = np.concatenate([g for _, g in rows], axis=1)
        seen = np.concatenate([x[t] for t, _ in rows])
        order = np.argsort(seen, kind="stable")
        values, first = np.unique(seen[order], return_index=True)
        grads["W" + d][:, values] = np.add.reduceat(flat[:, order], first, axis=1)
    return loss, grads


def train(
    windows: list[bytes], labels: np.ndarray, languages: int, steps: int = STEPS, batch: int = BATCH, hidden: int = HIDDEN, seed: int = 0
) -> dict[str, np.ndarray]:
    """Adam over batches that draw each language equally often; windows are of one length.

    The languages' order runs on over the batches, so draws differ by one at most. Beyond `batch`
    languages the steps grow with their number, so each is drawn about `steps` times at least.
    """
    steps = -(-steps * max(languages, batch) // batch)
    rng = np.random.default_rng(seed)
    net = new_network(languages, hidden, seed)
    data = np.stack([np.frombuffer(w, np.uint8) for w in windows], axis=1)
    by_language = [np.flatnonzero(labels == k) for k in range(languages)]
    mean = {k: np.zeros_like(v) for k, v in net.items()}
    square = {k: np.zeros_like(v) for k, v in net.items()}
    for step in range(1, steps + 1):
        y = ((step - 1) * batch + np.arange(batch)) % languages
        chosen = np.array([rng.choice(by_language[k]) for k in y])
        _, grads = loss_and_gradients(net, data[:, chosen], y)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        rate = 0.02 * min(1.0, 3 * (1 - step / (steps + 1)))
        for k, g in grads.items():
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            net[k] -= (rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def _run_segments(net: dict[str, np.ndarray], x: np.ndarray, active: np.ndarray) -> np.ndarray:
    """Sum of each segment's position probabilities (languages, segments).

    x is (time, segments), longest segments first; active[t] segments reach position t.
    """
    hidden, (time, width) = net["Uf"].shape[1], x.shape
    logits = np.empty((time, net["b"].shape[0], width), np.float32)
    # sigmoid(v) = tanh(v / 2) / 2 + 1 / 2: halve the weights of z and r once.
    half = np.ones((3 * hidden, 1), np.float32)
    half[: 2 * hidden] = 0.5
    for d in "fb":
        table, recur, out = net["W" + d] * half, net["U" + d] * half, net["O" + d]
        h = np.zeros((hidden, width), np.float32)
        for t in range(time) if d == "f" else range(time - 1, -1, -1):
            n_now = int(active[t])
            if not n_now:
                continue
            now = h[:, :n_now]
            g, u = np.take(table, x[t, :n_now], axis=1), recur @ now
            gate = g[: 2 * hidden]
            gate += u[: 2 * hidden]
            np.tanh(gate, out=gate)
            gate *= 0.5
            gate += 0.5
            n = u[2 * hidden :]
            n *= gate[hidden:]
            n += g[2 * hidden :]
            np.tanh(n, out=n)
            now -= n
            now *= gate[:hidden]
            now += n
            if d == "f":
                np.matmul(out, now, out=logits[t, :, :n_now])
            else:
                logits[t, :, :n_now] += out @ now
    sums = np.zeros((net["b"].shape[0], width), np.float64)
    for t in range(time):
        n_now = int(active[t])
        if n_now:
            e = np.exp(np.clip(logits[t, :, :n_now] + net["b"], -30, 30))
            e /= e.sum(axis=0)
            sums[:, :n_now] += e
    return sums


def document_probabilities(net: dict[str, np.ndarray], texts: pa.Array) -> np.ndarray:
    """(texts, languages): mean of the position probabilities over each whole text; 0 for empty texts."""
    data, offsets = words.buffers(texts)
    lengths = np.diff(offsets)
    counts = -(-lengths // SEGMENT)
    owner = np.repeat(np.arange(len(lengths)), counts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    begins = offsets[:-1][owner] + number * SEGMENT
    sizes = np.minimum(SEGMENT, offsets[1:][owner] - begins)
    pooled = np.zeros((len(lengths), net["b"].shape[0]))
    order = np.argsort(-sizes, kind="stable")
    for at in range(0, len(order), SEGMENTS):
        part = order[at : at + SEGMENTS]
        size = sizes[part]
        places = begins[part][None, :] + np.arange(SEGMENT)[:, None]
        x = data[np.minimum(places, len(data) - 1)]
        active = np.searchsorted(-size, -np.arange(SEGMENT), "left")
        sums = _run_segments(net, x, active)
        for k in range(len(sums)):
            pooled[:, k] += np.bincount(owner[part], sums[k], minlength=len(lengths))
    return pooled / np.maximum(lengths, 1)[:, None]


# ---------------------------------------------------------------------------- Spark


def training_windows(docs: DataFrame, may_teach: Column, per_language: int = TRAIN_DOCS) -> list[tuple[str, bytes]]:
    """The bounded sample (language, window), in a fixed order."""
    rows = docs.select("doc_id", "lang", "text").filter(may_teach & F.col("lang").isNotNull() & (F.octet_length("text") > 0))
    counts = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return []
    counts = docs.sparkSession.createDataFrame([(c["lang"], c["count"]) for c in counts], "lang string, n long")
    draw = F.pmod(F.xxhash64(F.lit("language"), "doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = rows.join(F.broadcast(counts), "lang").filter(draw < F.lit(float(per_language)) / F.col("n"))
    raw = F.col("text").cast("binary")
    span = F.greatest(F.lit(0), F.length(raw) - WINDOW)
    cut = chosen.select("lang", raw.alias("raw"), span.alias("span"), F.explode(F.sequence(F.lit(0), F.lit(TRAIN_WINDOWS - 1))).alias("i"))
    start = F.floor(F.col("span") * F.col("i") / F.lit(TRAIN_WINDOWS)).cast("int") + 1
    found = cut.select("lang", F.substring("raw", start, F.lit(WINDOW)).alias("window")).distinct().collect()
    return sorted((r["lang"], bytes(r["window"]).ljust(WINDOW, b" ")) for r in found)


def learn(docs: DataFrame, may_teach: Column) -> tuple[dict[str, np.ndarray] | None, list[str]]:
    sample = training_windows(docs, may_teach)
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return None, []
    labels = np.array([languages.index(lang) for lang, _ in sample])
    return train([w for _, w in sample], labels, len(languages)), languages


def _predictor(net: dict[str, np.ndarray] | None, languages: list[str]):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.chunks(batch, "text", 4 << 20):
                names, scores = [UNKNOWN] * len(part), np.zeros(len(part))
                if net is not None:
                    p = document_probabilities(net, part.column("text"))
                    best = p.argmax(axis=1)
                    lettered = part.column("lettered").to_numpy(zero_copy_only=False)
                    scores = np.where(lettered, np.clip(p[np.arange(len(p)), best], 0, 1), 0.0)
                    names = [languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    return predict


def identify(docs: DataFrame, may_teach: Column | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document (doc_id, text, lang).

    may_teach: which rows may be learned from; by default those not held out.
    """
    held_out = fold(F.col("doc_id")) == 2
    net, languages = learn(docs, ~held_out if may_teach is None else may_teach)
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select("doc_id", held_out.alias("held_out"), lettered.alias("lettered"), "text").mapInArrow(
        _predictor(net, languages), "doc_id long, held_out boolean, lang_pred string, score double"
    )
