"""Language identification by error-correcting output codes.

Each language has a codeword; one binary classifier a bit (logistic, over
hashed character 1- to 3-grams) predicts that bit for a text. Decoding is
loss-weighted: for every language the logistic losses of its bits are summed
with weights that say how well each classifier knows that language, and the
nearest codeword wins. A text whose two nearest codewords lie closer than
``margin`` is flagged as ambiguous.

The classifiers are fitted on a bounded sample: of each language the
``max_train_rows`` texts with the least hash of key and text, whole, fewer
where ``max_sample_rows`` is reached; copies count once, and a key with very
many rows is thinned out like all others. More than ``max_languages`` labels
are an error. The model is ``2**bits`` weights a codeword bit. Prediction
reads every whole text, however long, row by row, without a shuffle.

Defined results: null texts and texts without a letter are ``und`` with
score 0; equally near codewords go to the language first in order; with no
labelled rows all texts are ``und``; repeated rows are judged alike; an empty
table gives an empty result. ``identified`` keeps all columns; ``predict``
returns those it is asked to keep, and columns of other names, also
``lang_pred`` or ``score``, are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import common as C

UND = "und"
#: Code points worked on at a time.
CHUNK = 1 << 20


@dataclass(frozen=True)
class Params:
    bits: int = 12
    max_train_rows: int = 800
    max_sample_rows: int = 8000
    max_languages: int = 256
    steps: int = 80
    l2: float = 1e-5
    margin: float = 0.05


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    code: np.ndarray  # languages x classifiers, +1 or -1
    trust: np.ndarray  # languages x classifiers, rows sum to 1
    weights: np.ndarray  # 2**bits + 1 (bias) x classifiers
    bits: int
    margin: float


def codewords(k: int) -> np.ndarray:
    """The exhaustive code up to 6 languages; above, the best of some random
    dense codes by the least distance between two codewords."""
    if k <= 6:
        columns = [[1, *[1 - 2 * (c >> (k - 2 - i) & 1) for i in range(k - 1)]] for c in range(1, 1 << (k - 1))]
        return np.array(columns, np.int8).T.reshape(k, -1)
    rng, best, width = np.random.default_rng(7), None, int(np.ceil(10 * np.log2(k)))
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.int8), (k, width))
        apart = min(int((code[i] != code[j]).sum()) for i in range(k) for j in range(i))
        if np.all(np.abs(code.sum(0)) < k) and (best is None or apart > best[0]):
            best = (apart, code)
    return best[1]


@cache
def _letters() -> np.ndarray:
    """1 for code points that are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _counts(text: str, bits: int) -> np.ndarray | None:
    """Unit vector of square-rooted n-gram counts; None without a letter.
    Runs of other characters count as one border."""
    total, seen = np.zeros(1 << bits), False
    text = text.lower()
    shift = np.uint32(32 - bits)
    tail = np.zeros(1, np.uint32)
    for a in range(0, len(text), CHUNK):
        c = np.frombuffer(text[a : a + CHUNK].encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[c]
        seen = seen or bool(letter.any())
        c = np.concatenate([tail, np.where(letter, c, 0)]).astype(np.uint32)
        c = c[np.append(True, (c[1:] != 0) | (c[:-1] != 0))]
        h = c * np.uint32(0x9E3779B1)
        for n in range(3):
            if n:
                if len(c) <= n:
                    break
                h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + c[n:] * np.uint32(0xC2B2AE35)
            idx = ((h ^ (h >> np.uint32(13))) * np.uint32(0x27D4EB2F)) >> shift
            total += np.bincount(idx, minlength=1 << bits)
        tail = c[-2:]  # pairs inside the tail are counted once more, a millionth of all
    if not seen:
        return None
    total = np.sqrt(total)
    return (total / np.linalg.norm(total)).astype(np.float32)


def featurise(docs: DataFrame, text: str, keep: tuple[str, str], bits: int) -> DataFrame:
    """Label and hash, coordinates and values of each text with a letter."""
    src = docs.select(*keep, F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, "t"):
                rows = [(y, o, v) for y, o, t in zip(*[part.column(i).to_pylist() for i in range(3)], strict=True) if (v := _counts(t or "", bits)) is not None]
                at = [np.flatnonzero(v).astype(np.int32) for _, _, v in rows]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([y for y, _, _ in rows], pa.string()), pa.array([o for _, o, _ in rows], pa.int64()), pa.array(at, pa.list_(pa.int32())), pa.array([v[i] for (_, _, v), i in zip(rows, at, strict=True)], pa.list_(pa.float32()))],
                    names=["y", "o", "i", "v"],
                )

    return src.mapInArrow(run, "y string, o long, i array<int>, v array<float>")


def _logistic(x: np.ndarray, y: np.ndarray, p: Params) -> np.ndarray:
    """All classifiers at once, by accelerated gradient steps; rows of ``x``
    have unit length, so a step of 2 is stable."""
    w = np.zeros((x.shape[1], y.shape[1]), np.float32)
    ahead, t = w.copy(), 1.0
    for _ in range(p.steps):
        pull = y / (1 + np.exp(np.clip(y * (x @ ahead), -30, 30)))
        new = ahead + 2.0 * (x.T @ (pull / len(x)) - p.l2 * ahead)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + np.float32((t - 1) / t_new) * (new - w), new, t_new
    return w


def _learnt(texts: list[tuple[str, int, np.ndarray, np.ndarray]], p: Params) -> Model:
    """The model of a sample of (label, hash, coordinates, values)."""
    texts = sorted(texts, key=lambda t: t[:2])  # the same sums in any order of arrival
    languages = tuple(sorted({y for y, _, _, _ in texts}))
    size = 1 << p.bits
    x = np.zeros((len(texts), size + 1), np.float32)
    for r, (_, _, i, v) in enumerate(texts):
        x[r, i] = v
    x[:, size] = 0.3
    at = {y: k for k, y in enumerate(languages)}
    cls = np.array([at[y] for y, _, _, _ in texts])
    code = codewords(len(languages)) if len(languages) > 1 else np.ones((1, 1), np.int8)
    # every language weighs the same
    y = code[cls].astype(np.float32)
    w = _logistic(x, y, p)
    right = (x @ w) * y > 0
    trust = np.array([right[cls == k].mean(0) for k in range(len(languages))]) + 1e-6
    return Model(languages, code, trust / trust.sum(1, keepdims=True), w, p.bits, p.margin)


def fit(labelled: DataFrame, label: str = "lang", text: str = "text", key: str = "doc_id", params: Params | None = None) -> Model | None:
    """None where nothing is labelled. One task learns from the sample's
    sparse features, at most ``max_sample_rows`` rows of ``2**bits`` values;
    only the model comes to the driver."""
    p = params or Params()
    src = labelled.where(F.col(label).isNotNull() & F.col(text).isNotNull())
    src = src.select(F.col(label).alias("y"), F.col(text).alias("t"), F.xxhash64(F.lit("ecoc"), F.col(key).cast("string"), F.col(text)).alias("o"))
    known = src.select("y").distinct().limit(p.max_languages + 1).count()
    if known > p.max_languages:
        raise ValueError(f"more than max_languages={p.max_languages} labels")
    few = F.broadcast(C.drawn(src, "y", "o", max(1, min(p.max_train_rows, p.max_sample_rows // max(known, 1))))[0])
    rows = featurise(src.join(few, ["y", "o"]), "t", ("y", "o"), p.bits).dropDuplicates(["y", "o"]).select("y", "o", "i", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = []
        for batch in batches:
            y, o, i, v = [batch.column(k) for k in range(4)]
            texts += [(y[r].as_py(), o[r].as_py(), i[r].values.to_numpy(), v[r].values.to_numpy()) for r in range(len(batch))]
        if texts:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(_learnt(texts, p))], pa.binary())], names=["model"])

    got = rows.coalesce(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(got[0].model) if got else None


def decode(model: Model, f: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language, its score, and whether it is ambiguous, of each row of
    classifier outputs."""
    loss = np.logaddexp(0, -f[:, None, :] * model.code[None])
    far = (loss * model.trust[None]).sum(2) * model.code.shape[1]
    best = far.argmin(1)
    p = np.exp(far.min(1, keepdims=True) - far)
    p /= p.sum(1, keepdims=True)
    top = np.sort(p, 1)
    close = (top[:, -1] - top[:, -2] < model.margin) if p.shape[1] > 1 else np.zeros(len(p), bool)
    return best, top[:, -1], close


def predict(docs: DataFrame, model: Model | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``lang_pred``, ``score``, ``ambiguous``."""
    src = docs.select(*keep, F.col(text).alias("__text"))
    names = [*keep, "lang_pred", "score", "ambiguous"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]] + ["lang_pred string, score double, ambiguous boolean"])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            for part in C.slices(batch, "__text"):
                n = len(part)
                lang, sure, close = [UND] * n, np.zeros(n), np.zeros(n, bool)
                vectors = [_counts(t or "", m.bits) if m else None for t in part.column(len(keep)).to_pylist()]
                at = [i for i, v in enumerate(vectors) if v is not None]
                if at:
                    f = np.array([vectors[i] @ m.weights[:-1] for i in at]) + 0.3 * m.weights[-1]
                    best, score, ambiguous = decode(m, f)
                    for i, b in zip(at, best, strict=True):
                        lang[i] = m.languages[b]
                    sure[at], close[at] = score, ambiguous
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(len(keep))], pa.array(lang, pa.string()), pa.array(sure), pa.array(close)], names=names)

    return src.mapInArrow(run, schema)


def identified(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows, columns unchanged, whose language is known: neither ``und``
    nor ambiguous."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            for part in C.slices(batch, text):
                vectors = [_counts(t or "", m.bits) if m else None for t in part.column(part.schema.get_field_index(text)).to_pylist()]
                keep = np.zeros(len(part), bool)
                at = [i for i, v in enumerate(vectors) if v is not None]
                if at:
                    keep[at] = ~decode(m, np.array([vectors[i] @ m.weights[:-1] for i in at]) + 0.3 * m.weights[-1])[2]
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
