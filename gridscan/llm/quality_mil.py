"""Quality classifier: gated attention over passages, learned from document labels.

Every whole text is cut into passages of 512 bytes. A passage is encoded by the frequencies of pairs of
byte classes and by how many different 4-byte strings it holds, then by a dense layer. Attention
weights come from a gate, sigmoid(U h) * tanh(V h), and the score is that of the weighted sum of all
passages. Attention is normalised over a document, so passages may be encoded in any number of chunks.

Training fits in one task: it takes a sample of labelled documents, chosen by a hash of their id and bounded by number and bytes.
"""

from __future__ import annotations

import pickle
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: At most so many labelled documents are learned from, by all their passages, and at most so many bytes of text: documents
#: come in order of a hash of their id, and one that no longer fits is left out as a whole.
SAMPLE, SAMPLE_BYTES = 4096, 24 << 20
PASSAGE = 512
CHUNK = 1 << 20
HIDDEN, GATE = 32, 16
EPOCHS, BATCH, RATE, DECAY, SEED = 30, 64, 0.004, 1e-4, 7
THRESHOLD = 0.7
_GRAMS = 1024


def _classes() -> np.ndarray:
    """Byte -> class."""
    groups = [" ", "\n", ".", ",", "!", "?", "#", "*", "$", "%", "&", "|", "<>", "'\"`", "()[]{}", "-_/\\", ":;", string.digits, "AEIOUY", "aeiouy"]
    out = np.full(256, len(groups), np.uint8)  # control characters and the rest
    for k, group in enumerate(groups):
        out[list(group.encode())] = k
    rest = len(groups) + 1
    for k, group in enumerate((set(string.ascii_uppercase) - set("AEIOUY"), set(string.ascii_lowercase) - set("aeiouy"))):
        out[[ord(c) for c in group]] = rest + k
    out[0x80:0xC0] = rest + 2
    out[0xC0:] = rest + 3
    return out


_CLASS = _classes()
_K = int(_CLASS.max()) + 1
WIDTH = _K * _K + 3


def passage_features(pieces: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(features of all passages, number of passages of each piece); pieces are (bytes, length of their whole document)."""
    sizes = np.array([len(p) for p, _ in pieces], np.int64)
    counts = np.maximum(1, -(-sizes // PASSAGE))
    n = int(counts.sum())
    lengths = np.full(n, PASSAGE, np.int64)
    lengths[np.cumsum(counts) - 1] = sizes - (counts - 1) * PASSAGE
    whole = np.repeat(np.array([w for _, w in pieces], float), counts)
    data = np.frombuffer(b"".join(p for p, _ in pieces) + b"\0\0\0", np.uint8)
    owner = np.repeat(np.arange(n), lengths)
    # Past the end of its passage a byte sees zeros, so no passage depends on what is beside it.
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(owner))
    after = [np.where(left > k, data[k : len(data) - 3 + k], 0).astype(np.uint8) for k in (1, 2, 3)]
    c = _CLASS[data[:-3]].astype(np.int64)
    pairs = np.bincount(owner * (_K * _K) + c * _K + _CLASS[after[0]], minlength=n * _K * _K).reshape(n, -1)
    four = data[:-3].astype(np.uint32)
    for k, d in enumerate(after, 1):
        four |= d.astype(np.uint32) << np.uint32(8 * k)
    four = four * np.uint32(0x9E3779B1) >> np.uint32(22)
    different = np.count_nonzero(np.bincount(owner * _GRAMS + four, minlength=n * _GRAMS).reshape(n, -1), axis=1)
    size = np.maximum(lengths, 1)
    out = np.empty((n, WIDTH), np.float32)
    out[:, :-3] = np.sqrt(pairs / size[:, None])
    expected = _GRAMS * (1 - np.exp(-size / _GRAMS))
    out[:, -3] = different / expected
    out[:, -2] = np.log1p(lengths) / 6
    out[:, -1] = np.log1p(whole) / 10
    return out, counts


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Model:
    """Parameters, their training by Adam, and scores."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray) -> None:
        r = np.random.default_rng(SEED)
        shape = {"w": (WIDTH, HIDDEN), "v": (HIDDEN, GATE), "u": (HIDDEN, GATE), "a": (GATE, 1), "c": (HIDDEN, 1)}
        self.p = {k: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32) for k, s in shape.items()}
        self.p |= {"wb": np.zeros(HIDDEN, np.float32), "b": np.zeros(1, np.float32)}
        self.mean, self.scale = mean, scale

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(passage vectors, attention logits)."""
        h = np.tanh(((x - self.mean) / self.scale) @ self.p["w"] + self.p["wb"])
        return h, ((np.tanh(h @ self.p["v"]) * _sigmoid(h @ self.p["u"])) @ self.p["a"])[:, 0]

    def score(self, h: np.ndarray, logit: np.ndarray) -> float:
        """Score of one document from all its passages."""
        a = np.exp(logit - logit.max())
        return float(_sigmoid((a / a.sum()) @ h @ self.p["c"] + self.p["b"])[0])

    def gradients(self, bags: list[np.ndarray], labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """(mean cross-entropy, its gradients) over bags of scaled features."""
        p = self.p
        x = np.concatenate(bags)
        count = np.array([len(b) for b in bags])
        start, bag = np.cumsum(count) - count, np.repeat(np.arange(len(bags)), count)
        h = np.tanh(x @ p["w"] + p["wb"])
        t, s = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
        logit = ((t * s) @ p["a"])[:, 0]
        e = np.exp(logit - np.maximum.reduceat(logit, start)[bag])
        a = e / np.add.reduceat(e, start)[bag]
        z = np.add.reduceat(a[:, None] * h, start)
        y = _sigmoid(z @ p["c"] + p["b"])[:, 0]
        loss = -float(np.mean(labels * np.log(np.maximum(y, 1e-30)) + (1 - labels) * np.log(np.maximum(1 - y, 1e-30))))
        dy = ((y - labels) / len(bags)).astype(x.dtype)[:, None]
        dz = dy @ p["c"].T
        da = (dz[bag] * h).sum(1)
        dlogit = (a * (da - np.add.reduceat(a * da, start)[bag]))[:, None]
        dgate = dlogit @ p["a"].T
        dt, ds = dgate * s * (1 - t * t), dgate * t * s * (1 - s)
        dh = a[:, None] * dz[bag] + dt @ p["v"].T + ds @ p["u"].T
        dpre = dh * (1 - h * h)
        return loss, {"w": x.T @ dpre, "wb": dpre.sum(0), "v": h.T @ dt, "u": h.T @ ds, "a": (t * s).T @ dlogit, "c": z.T @ dy, "b": dy.sum(0)}

    def fit(self, bags: list[np.ndarray], labels: np.ndarray) -> None:
        p, r = self.p, np.random.default_rng(SEED)
        bags = [(b - self.mean) / self.scale for b in bags]
        m1 = {k: np.zeros_like(v) for k, v in p.items()}
        m2 = {k: np.zeros_like(v) for k, v in p.items()}
        step = 0
        for epoch in range(EPOCHS):
            rate = RATE * (1 - epoch / EPOCHS)
            order = r.permutation(len(bags))
            for at in range(0, len(order), BATCH):
                some = order[at : at + BATCH]
                _, grads = self.gradients([bags[i] for i in some], labels[some])
                step += 1
                for k, g in grads.items():
                    g = g + DECAY * p[k]
                    m1[k] = 0.9 * m1[k] + 0.1 * g
                    m2[k] = 0.999 * m2[k] + 0.001 * g * g
                    p[k] -= (rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)


def _pieces(text: bytes):
    """A document in chunks that are whole passages; an empty one is one empty chunk."""
    for at in range(0, max(len(text), 1), CHUNK):
        yield text[at : at + CHUNK], len(text)


def bag_of(text: bytes) -> np.ndarray:
    """Features of all passages of a text, encoded in chunks."""
    return np.concatenate([passage_features([piece])[0] for piece in _pieces(text)])


def train(bags: list[np.ndarray], labels: np.ndarray) -> Model:
    """A fitted model; without examples its scores are 0.5."""
    if not bags:
        model = Model(np.zeros(WIDTH, np.float32), np.ones(WIDTH, np.float32))
        model.p["c"][:] = 0
        return model
    x = np.concatenate(bags)
    model = Model(x.mean(0), x.std(0) + np.float32(0.02))
    model.fit(bags, labels.astype(np.float32))
    return model


def fit_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> bytes:
    """A pickled model from the labelled rows outside the held-out fold.

    Rows without an id or a label teach nothing; of several labels of an id the largest counts, of several texts the first by a hash.
    """
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
    chosen = usable.groupBy(F.col(id_col).alias("key")).agg(F.max(label_col).cast("int").alias("label"))
    chosen = chosen.withColumn("place", F.xxhash64("key")).orderBy("place", "key").limit(sample)
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary"))
    rows = docs.select(F.col(id_col).alias("key"), text.alias("text")).join(F.broadcast(chosen), "key")
    rows = rows.groupBy("place", "key", "label").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))

    def learn(batches):
        bags, marks, size = [], [], 0
        for b in batches:
            for mark, raw in zip(b.column(2).to_pylist(), b.column(3)):
                if size + len(raw.as_buffer()) <= sample_bytes:
                    size += len(raw.as_buffer())
                    bags.append(bag_of(raw.as_py()))
                    marks.append(mark)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(bags, np.array(marks)))], pa.binary())], ["model"])

    found = rows.repartition(1).sortWithinPartitions("place", "key").mapInArrow(learn, "model binary").first()
    return found[0] if found else pickle.dumps(train([], np.empty(0)))


def held_out(id_col: str = "doc_id"):
    """Whether a row belongs to the fold that is never learned from; false without an id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def score_texts(model: Model, texts: list[bytes]) -> list[float]:
    """Scores of whole texts, however long, in chunks of about CHUNK bytes."""
    vectors: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in texts]
    held: list[tuple[int, tuple[bytes, int]]] = []

    def flush():
        x, counts = passage_features([p for _, p in held])
        h, logit = model.encode(x)
        cuts = np.cumsum(counts)[:-1]
        for (i, _), hs, ls in zip(held, np.split(h, cuts), np.split(logit, cuts)):
            vectors[i].append((hs, ls))
        held.clear()

    size = 0
    for i, text in enumerate(texts):
        for piece in _pieces(text):
            held.append((i, piece))
            size += len(piece[0]) + PASSAGE
            if size >= CHUNK:
                flush()
                size = 0
    if held:
        flush()
    return [model.score(np.concatenate([h for h, _ in v]), np.concatenate([x for _, x in v])) for v in vectors]


def score_documents(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for every row of docs; null texts are empty."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        fitted = pickle.loads(sent.value)
        for b in batches:
            scores = score_texts(fitted, [t.as_py() for t in b.column(1)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary")).alias("text"))
    return narrow.mapInArrow(run, "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs, from its whole text alone.

    Null texts are empty and score like any other; rows without an id belong to no held-out fold; repeated rows score alike; an
    empty table gives no rows, and without usable labels all scores are 0.5. Other columns are not read.
    """
    scored = score_documents(docs, fit_model(docs, labels, id_col, text_col), id_col, text_col)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
