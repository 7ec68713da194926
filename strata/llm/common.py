"""Shared helpers: vectorised word hashing over Arrow batches, table staging.

Words are hashed for a whole Arrow batch at once, straight from the UTF-8
buffer: a prefix sum of ``T[byte] * P**position`` (mod 2**64) gives every
word's polynomial hash by one subtraction and one multiplication. The
buffer is worked through in pieces of about ``PIECE`` bytes cut between
words, so memory beyond the 8 bytes a word stays constant however long a
text is. Hashes are 64 bits wide; two different words of one text agree
with a probability of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import scratch_path

#: Bytes of text hashed at a time.
PIECE = 1 << 18
#: Bytes of text that one slice of an Arrow batch holds (one row at least).
SLICE = 4 << 20

U = np.uint64
_M1, _M2, _GOLD = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB), U(0x9E3779B97F4A7C15)
#: Odd multiplier of the polynomial hash, 3 mod 8 so that P - 1 and P + 1
#: have few factors of two, and its inverse mod 2**64.
_P = 0x9E3779B97F4A7C1B
_P_INV = pow(_P, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers (splitmix64's finaliser)."""
    with np.errstate(over="ignore"):
        x = x + _GOLD
        x = (x ^ (x >> U(30))) * _M1
        x = (x ^ (x >> U(27))) * _M2
        return x ^ (x >> U(31))


def scaled(x: np.ndarray, n) -> np.ndarray:
    """Map well-mixed 64-bit integers evenly onto ``0 .. n-1``."""
    return (((x >> U(32)) * np.asarray(n).astype(np.uint64)) >> U(32)).astype(np.int64)


def byte_classes(separators: bytes, keep: bool = True, fold: bool = False) -> np.ndarray:
    """Per byte: 0 for a separator, else a random 64-bit value; ``fold``
    gives A-Z the values of a-z. ``keep=False`` reads ``separators`` as the
    bytes that are NOT separators."""
    t = mix(np.arange(1, 257, dtype=np.uint64)) | U(1)
    if fold:
        t[65:91] = t[97:123]
    sep = np.zeros(256, bool)
    sep[np.frombuffer(separators, np.uint8)] = True
    t[sep if keep else ~sep] = 0
    return t


#: ``[^\x20\x09-\x0D]+``: the words of the contracts.
SPACES = b" \t\n\x0b\x0c\r"
WORDS = byte_classes(SPACES)
WORDS_FOLDED = byte_classes(SPACES, fold=True)
#: Words without ASCII punctuation (bytes of other scripts belong to words).
ALNUM = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
PLAIN_WORDS = byte_classes(ALNUM, keep=False, fold=True)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    with np.errstate(over="ignore"):
        out[1:] = U(base)
        return np.multiply.accumulate(out)


class _Powers:
    """P**i and P**-i up to the longest piece met so far."""

    up = _powers(_P, PIECE + 1)
    down = _powers(_P_INV, PIECE + 1)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n >= len(cls.up):
            if n > 8 * PIECE:  # one huge word: not kept
                return _powers(_P, n + 1), _powers(_P_INV, n + 1)
            cls.up, cls.down = _powers(_P, n + 1), _powers(_P_INV, n + 1)
        return cls.up, cls.down


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and each text's offsets (n + 1); null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]] if len(offsets) else raw, offsets - (offsets[0] if len(offsets) else 0)


def hash_words(raw: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every text, and the word offsets of the texts.

    Returns ``(hashes, first)``: the words of text ``i`` are
    ``hashes[first[i]:first[i + 1]]`` in order.
    """
    hashes, starts_at = [], []
    begin, total = 0, len(raw)
    while begin < total:
        end = min(total, begin + PIECE)
        while end < total:  # cut before a separator or at a text's start
            step = classes[raw[end : end + 4096]] == 0
            nearest = int(step.argmax()) if step.any() else len(step)
            k = int(np.searchsorted(offsets, end))
            if k < len(offsets) and offsets[k] <= end + nearest:
                end = int(offsets[k])
                break
            end += nearest
            if nearest < len(step):
                break
        t = classes[raw[begin:end]]
        inside = t != 0
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        at = offsets[np.searchsorted(offsets, begin) : np.searchsorted(offsets, end)] - begin
        first[at] = inside[at]  # a text's first byte starts a word of its own
        s = np.flatnonzero(first)
        if len(s):
            last = inside.copy()
            last[:-1] &= ~inside[1:]
            at = at[at > 0] - 1
            last[at] = inside[at]
            e = np.flatnonzero(last) + 1
            up, down = _Powers.upto(end - begin)
            with np.errstate(over="ignore"):
                h = np.zeros(len(t) + 1, np.uint64)
                np.cumsum(t * up[: len(t)], out=h[1:])
                hashes.append(mix((h[e] - h[s]) * down[s]))
            starts_at.append(s + begin)
        begin = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts_at), offsets)


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Order-sensitive hash of each ``n`` neighbours (windows over text
    borders included: callers cut them off)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = np.full(len(h) - n + 1, U(n))
    for k in range(n):
        out = mix(out ^ h[k : len(h) - n + 1 + k])
    return out


def slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with about ``SLICE`` bytes of text each."""
    if not len(batch):
        return
    col = batch.column(batch.schema.get_field_index(text)).cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    lo = 0
    while lo < len(batch):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SLICE, side="right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64), pa.int64())


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back: what is
    read twice is made once, lineage ends here, and a lost executor costs
    no recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def held_out(doc_id="doc_id"):
    """The contract's fold: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def drawn(rows: DataFrame, label: str, hashed: str, most: int) -> tuple[DataFrame, dict]:
    """((label, hash) of a sample, distinct hashes of each label). The sample
    is the ``most`` least distinct hashes of each label: exactly so many rows
    (all, if fewer), however the rows are spread. Hashes that cannot be among
    them, by the label's number and four times over, are left out before
    anything is shuffled. The labels come to the driver."""
    pairs = rows.select(label, hashed)
    counts = {r[0]: r["count"] for r in pairs.distinct().groupBy(label).count().collect()}
    place = F.col(hashed).cast("double") / 2.0**64 + 0.5  # hashes lie evenly in 0 to 1
    low = F.lit(False)
    for value, n in counts.items():
        low = low | ((F.col(label) == value) & (place <= min(1.0, 4 * most / n)))
    order = Window.partitionBy(label).orderBy(hashed)
    first = pairs.where(low).distinct().withColumn("__at", F.row_number().over(order))
    return first.where(F.col("__at") <= most).select(label, hashed), counts
