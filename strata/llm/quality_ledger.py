"""Quality rules as a bitmask ledger.

``measure`` reads every text once and stores plain counts. ``ledger`` turns
them into one bit a failed rule. ``apply_policy`` decides from the stored
bits with a versioned policy (a set of rules), and ``ablation`` counts by
bitwise aggregation what each rule removes, alone or together with others,
without touching a text again.

Defined results: a null or empty text has no words, so every count is 0;
whole texts are measured, however long;
ties and repeated rows are judged row by row; an empty table gives an empty
ledger; other columns of the input, also ones named like a measurement, are
not carried along unless asked for with ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import common as C

SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_bangs")


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, np.int64)
    t[np.frombuffer(chars, np.uint8)] = 1
    return t


_IS_SYMBOL, _IS_UPPER, _IS_BANG = _table(SYMBOLS), _table(bytes(range(65, 91))), _table(b"!")
#: A code point inside a word: neither white space nor a continuation byte.
_IS_WORD_POINT = 1 - _table(C.SPACES + bytes(range(0x80, 0xC0)))


def _repeat_words(h: np.ndarray) -> int:
    """Words that lie in a 3-word window found at least twice."""
    if len(h) < 4:
        return 0
    _, inverse, counts = np.unique(C.ngrams(h, 3), return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    covered = np.zeros(len(h), bool)
    for k in range(3):
        covered[k : len(h) - 2 + k] |= twice
    return int(covered.sum())


def _measure(text: pa.Array) -> list[np.ndarray]:
    raw, off = C.utf8(text)
    h, first = C.hash_words(raw, off, C.WORDS)
    n = len(off) - 1
    out = {m: np.zeros(n, np.int64) for m in MEASURES}
    out["n_words"] = np.diff(first)
    for i in range(n):
        piece = raw[off[i] : off[i + 1]]
        for name, table in (("word_chars", _IS_WORD_POINT), ("n_symbols", _IS_SYMBOL), ("n_upper", _IS_UPPER), ("n_bangs", _IS_BANG)):
            out[name][i] = sum(int(table[piece[a : a + C.PIECE]].sum()) for a in range(0, len(piece), C.PIECE))
        lines = [x for x in piece.tobytes().split(b"\n") if x.strip()]
        out["n_lines"][i] = len(lines)
        out["n_dup_lines"][i] = len(lines) - len(set(lines))
        out["n_repeat_words"][i] = _repeat_words(h[first[i] : first[i + 1]])
    return [out[m] for m in MEASURES]


def measure(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and one long a measurement, row by row, no shuffle."""
    src = docs.select(*keep, F.col(text).alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]] + [f"{m} long" for m in MEASURES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, "__text"):
                cols = [part.column(i) for i in range(len(keep))] + [C.as_long(x) for x in _measure(part.column(len(keep)))]
                yield pa.RecordBatch.from_arrays(cols, names=[*keep, *MEASURES])

    return src.mapInArrow(run, schema)


#: Name and failure condition of each rule; the position is the bit. Rules
#: are only ever appended, so stored ledgers stay readable.
def rules() -> list[tuple[str, Column]]:
    w, c = F.col("n_words"), F.col("word_chars")
    return [
        ("few_words", w < 50),
        ("repeated_words", 100 * F.col("n_repeat_words") > 50 * w),
        ("symbols", 10 * F.col("n_symbols") > w),
        ("shouting", 100 * F.col("n_upper") > 40 * c),
        ("bangs", 10 * F.col("n_bangs") > w),
        ("repeated_lines", 100 * F.col("n_dup_lines") > 50 * F.col("n_lines")),
        ("short_words", 10 * c < 20 * w),
        ("long_words", c > 20 * w),
    ]


#: Policy versions: the rules that reject. Old versions stay as they were.
BASE = ("few_words", "repeated_words")
POLICIES: dict[int, tuple[str, ...]] = {
    1: BASE,
    2: (*BASE, "symbols", "shouting", "bangs", "repeated_lines", "short_words", "long_words"),
}


def mask(names: tuple[str, ...]) -> int:
    at = {name: bit for bit, (name, _) in enumerate(rules())}
    return sum(1 << at[n] for n in names)


def ledger(measured: DataFrame) -> DataFrame:
    """Adds ``failed``: bit ``k`` is set where rule ``k`` fails."""
    bits = F.lit(0).cast("long")
    for bit, (_, fails) in enumerate(rules()):
        bits = bits.bitwiseOR(F.when(fails, F.lit(1 << bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return measured.withColumn("failed", bits)


def rejected(policy: tuple[str, ...], failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(mask(policy)).cast("long")) != 0


def apply_policy(book: DataFrame, version: int) -> DataFrame:
    """Adds ``kept`` under the policy of that version."""
    return book.withColumn("kept", ~rejected(POLICIES[version]))


def ablation(book: DataFrame, version: int) -> DataFrame:
    """One row a rule of the policy: documents that fail it, that only it
    rejects, and that the policy without it keeps. One aggregation with
    map-side sums; bits only."""
    policy = POLICIES[version]
    m = F.lit(mask(policy)).cast("long")
    hit = F.col("failed").bitwiseAND(m)
    sums = [F.count(F.lit(1)).alias("n"), F.count_if(hit == 0).alias("kept")]
    for name in policy:
        one = F.lit(mask((name,))).cast("long")
        sums += [F.count_if(hit.bitwiseAND(one) != 0).alias(f"{name}_f"), F.count_if(hit == one).alias(f"{name}_o")]
    total = book.agg(*sums)
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"{n}_f").alias("n_failed"), F.col(f"{n}_o").alias("n_only"), (F.col("kept") + F.col(f"{n}_o")).alias("n_kept_without")) for n in policy])
    return total.select("n", "kept", F.inline(rows))
