"""Benchmark decontamination by CGK embeddings and bit-sampling LSH.

A document is contaminated by a benchmark item if some passage lies within
``floor((1 - similarity) * L)`` word edits of the item's ``L`` words. Texts
are lower-cased and cut into words without punctuation.

Windows: of any ``k + 1`` separate pieces of an item within ``k`` edits of a
passage, one stands unchanged in the passage. The pieces, one to three words
each, are chosen so that together they are as rare as can be among the
block's items: openings that many items share are passed over. An item-sized
window is laid around every piece (anchor) found in a document, so no window
that could match is left out; windows are built in bounded batches.

Embedding: from the anchor the window is embedded outwards, forwards and
backwards, by the CGK random walk: at step ``t`` the current word is written
and the walk moves on or stays, as a random function of ``t`` and the word
says. The walk turns edit distance into Hamming distance between outputs.

LSH: a table samples ``bits`` output positions; a window is a candidate
if it agrees with the item on all of one table's positions. The number of
tables (``tables_a_walk`` of them share a walk) is measured for each class
of item lengths: edited copies of its items, at the full edit budget, must
be found at ``recall``. Candidates are verified by exact edit distance
(bit-parallel, over words). Classes that ``max_tables`` do not bring to the
recall, as those of long items, take no tables: all their windows are
verified, overlapping ones as one region.

The items are a query set worked off in blocks of ``block_words`` words;
each block's index holds distinct texts, is broadcast (its size is bounded by
the block) and documents are read row by row: no shuffle, whatever the number
of documents. Only hits on texts that several items share are joined with
the items' keys.

Defined results: null and empty texts have no hits; whole texts are searched,
however long; items with fewer than ``min_words`` words are not searched for;
repeated items are reported each; hits are sorted by item; an empty benchmark
or table gives no hits. ``clean`` keeps all columns; ``find_items`` those it
is asked to keep, and a kept column named ``hits`` is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import common as C
from strata.llm.common import staged

HIT_TYPE = "array<struct<item_id:bigint,distance:int,mark:bigint>>"
_HIT = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("mark", pa.int64())]))
_FILTER_BITS = 20
#: Walk steps a word, up to which places are sampled (a walk takes about two).
DEPTH = 1.8
#: Items with more words are not tried with tables: all windows are verified.
EMBEDDED = 512
#: Edited copies by which a class of item lengths is measured.
COPIES = 400
#: Windows built at a time.
BATCH = 1 << 18
#: How much likelier a piece of one, two or three words is met in a text.
PIECE_COST = {1: 32.0, 2: 4.0, 3: 1.0}
#: Items with more words have their pieces chosen part by part.
CHOSEN_AT_ONCE = 512


@dataclass(frozen=True)
class Search:
    similarity: float = 0.8
    min_words: int = 5
    bits: int = 3
    recall: float = 0.99
    max_tables: int = 128
    #: Tables that sample the same embedding.
    tables_a_walk: int = 16
    block_words: int = 1_000_000
    #: Blocks worked off in one job; each needs a Python worker in every task.
    passes: int = 4
    seed: int = 11


def budget(words: int, similarity: float) -> int:
    return int(words * (1 - similarity) + 1e-9)


def word_hashes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw, off = C.utf8(pc.utf8_lower(text.cast(pa.large_string())))
    return C.hash_words(raw, off, C.PLAIN_WORDS)


def walk(words: np.ndarray, start: np.ndarray, end: np.ndarray, step: int, seed: int, steps: int) -> Iterator[np.ndarray]:
    """CGK outputs, step by step, of many strings at once: the words from
    ``start`` towards ``end`` (exclusive) in direction ``step``."""
    at = start.astype(np.int64).copy()
    for t in range(steps):
        on = at < end if step > 0 else at > end
        out = np.where(on, words[np.where(on, at, 0)] if len(words) else 0, C.U(0))
        yield out
        coin = C.mix(out ^ C.U(seed * 1_000_003 + t * 2 + (step > 0))) >> C.U(63)
        at += np.where(on, coin.astype(np.int64) * step, 0)


@dataclass
class Index:
    """Items of one block, their anchors and their embeddings' samples."""

    search: Search
    ids: list[int] = field(default_factory=list)
    marks: list[int] = field(default_factory=list)
    items: list[np.ndarray] = field(default_factory=list)
    #: pieces of each item: (offset, words)
    pieces: list[list[tuple[int, int]]] = field(default_factory=list)
    #: by anchor length: sorted hashes, item, offset; and a bitmap of hashes
    anchors: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)
    #: tables of each item; 0: all its windows are verified
    tables_of: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    #: most tables of an item
    tables: int = 1

    @staticmethod
    def build(rows: list[tuple[int, str]] | list[tuple[int, str, int]], search: Search) -> Index:
        """``rows``: key and text, and a mark of the text that hits carry."""
        x = Index(search)
        h, first = word_hashes(pa.array([r[1] for r in rows], pa.string()))
        grams = {q: C.ngrams(h, q) for q in PIECE_COST}
        cost = {}
        for q, g in grams.items():
            _, where, n = np.unique(g, return_inverse=True, return_counts=True)
            cost[q] = PIECE_COST[q] * n[where]
        found: dict[int, list[tuple[int, int, int]]] = {}
        for k, row in enumerate(rows):
            w = h[first[k] : first[k + 1]]
            if len(w) < max(1, search.min_words):
                continue
            chosen = _pieces({q: c[first[k] : first[k] + max(0, len(w) - q + 1)] for q, c in cost.items()}, len(w), budget(len(w), search.similarity) + 1)
            for o, q in chosen:
                found.setdefault(q, []).append((int(grams[q][first[k] + o]), len(x.items), o))
            x.ids.append(row[0])
            x.marks.append(row[2] if len(row) > 2 else 0)
            x.items.append(w)
            x.pieces.append(chosen)
        for q, entries in found.items():
            entries.sort()
            hashes, item, offset = (np.array(c, t) for c, t in zip(zip(*entries, strict=True), (np.uint64, np.int64, np.int64), strict=True))
            seen = np.zeros(1 << _FILTER_BITS, bool)
            seen[hashes >> C.U(64 - _FILTER_BITS)] = True
            x.anchors[q] = (hashes, item, offset, seen)
        classes = np.array([int(2 * np.log2(len(w))) for w in x.items], np.int64)
        x.tables_of = np.zeros(len(x.items), np.int64)
        for c in np.unique(classes):
            x.tables_of[classes == c] = x._measure_tables(np.flatnonzero(classes == c))
        x.tables = int(x.tables_of.max(initial=0))
        return x

    def windows(self, h: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(text, item, offset in the item, position) of every anchor found,
        about ``BATCH`` at a time."""
        for q, (hashes, item, offset, seen) in self.anchors.items():
            g = C.ngrams(h, q)
            at = np.flatnonzero(seen[g >> C.U(64 - _FILTER_BITS)])
            doc = np.searchsorted(first, at, side="right") - 1
            at = at[at + q <= first[doc + 1]]
            lo, hi = np.searchsorted(hashes, g[at]), np.searchsorted(hashes, g[at], side="right")
            at, lo, n = at[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
            total = np.cumsum(n)
            a = 0
            while a < len(at):
                b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + BATCH, side="right")))
                m = n[a:b]
                pos = np.repeat(at[a:b], m)
                entry = np.repeat(lo[a:b], m) + np.arange(len(pos)) - np.repeat(np.cumsum(m) - m, m)
                yield np.searchsorted(first, pos, side="right") - 1, item[entry], offset[entry], pos
                a = b

    def agree(self, h: np.ndarray, doc_lo: np.ndarray, doc_hi: np.ndarray, item: np.ndarray, offset: np.ndarray, pos: np.ndarray, tables: int) -> np.ndarray:
        """tables x windows: does the window agree with its item there?"""
        sizes = np.array([len(w) for w in self.items], np.int64)
        base = np.concatenate([[0], np.cumsum(sizes)])
        own = np.concatenate(self.items)
        lo, hi = base[item], base[item + 1]
        w_lo = np.maximum(doc_lo, pos - offset)
        w_hi = np.minimum(doc_hi, pos - offset + sizes[item])
        at = lo + offset
        ahead, behind = sizes[item] - offset, offset
        everyone = np.arange(len(item))
        rng = np.random.default_rng(self.search.seed)
        out = np.ones((tables, len(item)), bool)
        for z in range(tables):
            if z % self.search.tables_a_walk == 0:  # an embedding of its own
                seed = z // self.search.tables_a_walk
                same = {}
                for step, length in ((1, ahead), (-1, behind)):
                    steps = int(DEPTH * length.max(initial=0)) + 1
                    one = walk(h, pos if step > 0 else pos - 1, w_hi if step > 0 else w_lo - 1, step, seed, steps)
                    two = walk(own, at if step > 0 else at - 1, hi if step > 0 else lo - 1, step, seed, steps)
                    same[step] = np.array([x == y for x, y in zip(one, two, strict=True)])
            # sampled places as parts of the window; each falls on one of
            # the two walks, within the steps that read words
            for side, depth in rng.random((self.search.bits, 2)):
                forward = side * sizes[item] >= offset
                t = (depth * DEPTH * np.where(forward, ahead, behind)).astype(np.int64)
                out[z] &= np.where(forward, same[1][np.where(forward, t, 0), everyone], same[-1][np.where(forward, 0, t), everyone])
        return out

    def _measure_tables(self, members: np.ndarray) -> int:
        """Tables needed so that these items, edited as much as allowed, are
        found; 0 if ``max_tables`` are not enough."""
        if max(len(self.items[k]) for k in members) > EMBEDDED:
            return 0
        rng, s = np.random.default_rng(self.search.seed + 1), self.search
        words, lo, hi, item, offset, pos = [], [], [], [], [], []
        total = 0
        for k in np.resize(rng.permutation(members), COPIES):
            w = self.items[k]
            edits = budget(len(w), s.similarity)
            a, b = self.pieces[k][int(rng.integers(len(self.pieces[k])))]
            b += a
            text, at = list(w), a
            for _ in range(edits):
                if len(text) == b - a:
                    break
                i, kind = int(rng.integers(len(text) - (b - a))), int(rng.integers(3))
                i += (b - a) * (i >= at)  # past the intact piece
                new = C.U(rng.integers(1 << 62))
                if kind == 0:
                    text[i] = new
                elif kind == 1:
                    text.insert(i, new)
                    at += i < at
                else:
                    del text[i]
                    at -= i < at
            # words of other passages around it
            pad = rng.integers(1 << 62, size=edits + 1).astype(np.uint64)
            words += [pad, np.array(text, np.uint64), pad]
            size = 2 * len(pad) + len(text)
            lo.append(total)
            hi.append(total + size)
            item.append(k)
            offset.append(a)
            pos.append(total + len(pad) + at)
            total += size
        found = self.agree(np.concatenate(words), *[np.array(c, np.int64) for c in (lo, hi, item, offset, pos)], s.max_tables)
        share = np.logical_or.accumulate(found, axis=0).mean(1)
        return int(np.argmax(share >= s.recall)) + 1 if share[-1] >= s.recall else 0

    def hits(self, text: pa.Array) -> list[list[dict]]:
        h, first = word_hashes(text)
        best: dict[tuple[int, int], int] = {}

        def verify(d1: int, i1: int, start: int, end: int) -> None:
            w = self.items[i1]
            e = edit_distance(w, h[start:end])
            if e <= budget(len(w), self.search.similarity):
                best[d1, i1] = min(e, best.get((d1, i1), e))

        for doc, item, offset, pos in self.windows(h, first):
            need = self.tables_of[item]
            for tables in np.unique(need):
                at = np.flatnonzero(need == tables)
                if not tables:
                    for d1, i1, start, end in self._regions(h, first, doc[at], item[at], (pos - offset)[at]):
                        verify(d1, i1, start, end)
                    continue
                for a in range(0, len(at), 20_000):
                    d, i, o, p = (c[at[a : a + 20_000]] for c in (doc, item, offset, pos))
                    near = self.agree(h, first[d], first[d + 1], i, o, p, int(tables)).any(0)
                    for d1, i1, s1 in {(int(x), int(y), int(z)) for x, y, z in zip(d[near], i[near], (p - o)[near], strict=True)}:
                        if best.get((d1, i1)) == 0:
                            continue
                        k = budget(len(self.items[i1]), self.search.similarity)
                        verify(d1, i1, max(first[d1], s1 - k), min(first[d1 + 1], s1 + len(self.items[i1]) + k))
        out: list[list[dict]] = [[] for _ in range(len(text))]
        for (d1, i1), e in best.items():
            out[d1].append({"item_id": self.ids[i1], "distance": e, "mark": self.marks[i1]})
        return [sorted(x, key=_by_item) for x in out]

    def _regions(self, h: np.ndarray, first: np.ndarray, doc: np.ndarray, item: np.ndarray, start: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, from, to) of all these windows, with the edit budget
        around them and overlapping ones as one; without those that hold too
        few of the item's words at any place to be within its budget."""
        order = np.lexsort((start, item, doc))
        doc, item, start = doc[order], item[order], start[order]
        sizes = np.array([len(w) for w in self.items], np.int64)
        slack = np.array([budget(len(w), self.search.similarity) for w in self.items], np.int64)
        apart = np.append(True, (np.diff(doc) != 0) | (np.diff(item) != 0) | (np.diff(start) > (sizes + 2 * slack)[item[1:]]))
        begin = np.flatnonzero(apart)
        for a, b in zip(begin, np.append(begin[1:], len(doc)), strict=True):
            d1, i1 = int(doc[a]), int(item[a])
            size, k = int(sizes[i1]), int(slack[i1])
            lo, hi = max(int(first[d1]), int(start[a]) - k), min(int(first[d1 + 1]), int(start[b - 1]) + size + k)
            held = np.concatenate([[0], np.cumsum(np.isin(h[lo:hi], self.items[i1]))])
            wide = min(size + k, hi - lo)
            if (held[wide:] - held[: len(held) - wide]).max() >= size - k:
                yield d1, i1, lo, hi


def _by_item(hit: dict) -> tuple:
    return hit["item_id"] is None, hit["item_id"], hit["distance"]


def _pieces(cost: dict[int, np.ndarray], size: int, pieces: int) -> list[tuple[int, int]]:
    """``pieces`` separate grams (offset, words) of an item of ``size`` words
    with the least total cost; ``cost`` holds that of the gram at each
    offset, by its words. Long items are cut into parts of equal size, with
    an equal number of pieces each."""
    parts = -(-size // CHOSEN_AT_ONCE)
    if parts > 1:
        out = []
        for k in range(parts):
            a, b = k * size // parts, (k + 1) * size // parts
            n = (k + 1) * pieces // parts - k * pieces // parts
            out += [(a + o, q) for o, q in _pieces({q: c[a : b - q + 1] for q, c in cost.items()}, b - a, n)]
        return out
    # least[i]: cost of the pieces so far within the first i words
    least, ways = np.zeros(size + 1), []
    for _ in range(pieces):
        new = np.full((len(cost) + 1, size + 1), np.inf)
        for row, (q, c) in enumerate(cost.items()):
            if len(c):
                new[row, q:] = least[: size + 1 - q] + c
        best = new.min(0)
        least = np.minimum.accumulate(best)
        took = np.where(best <= least, new.argmin(0), -1)  # a gram ends here
        ways.append(took)
    sizes, at, out = list(cost), size, []
    for took in reversed(ways):
        while took[at] < 0 or took[at] == len(sizes):
            at -= 1
        q = sizes[took[at]]
        at -= q
        out.append((at, q))
    return out[::-1]


def edit_distance(item: np.ndarray, region: np.ndarray) -> int:
    """Least edit distance of the item to any passage of the region (the
    bit-parallel column recurrence of approximate matching)."""
    m = len(item)
    where: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        where[w] = where.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, least = full, 0, m, m
    for w in region.tolist():
        eq = where.get(w, 0)
        x = eq | down
        diagonal = (((eq & up) + up) ^ up) | eq
        rise = down | (~(diagonal | up) & full)
        fall = up & diagonal
        score += bool(rise & top) - bool(fall & top)
        rise, fall = (rise << 1) & full, (fall << 1) & full
        up = fall | (~(x | rise) & full)
        down = rise & x
        least = min(least, score)
    return least


def _items(benchmark: DataFrame, item_key: str, item_text: str) -> DataFrame:
    return benchmark.select(F.col(item_key).cast("long").alias("k"), F.coalesce(F.col(item_text), F.lit("")).alias("t"))


def indexes(benchmark: DataFrame, item_key: str, item_text: str, search: Search) -> Iterator:
    """Broadcast index of each block of distinct texts; a text that several
    items share goes by the least key and the hash of its text."""
    items = _items(benchmark, item_key, item_text).groupBy("t").agg(F.min("k").alias("k"), F.when(F.count(F.lit(1)) > 1, F.xxhash64("t")).otherwise(F.lit(0)).alias("mark"))
    total = items.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // (4 * search.block_words)))
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == b)
        yield benchmark.sparkSession.sparkContext.broadcast(Index.build([(r.k, r.t, r.mark) for r in part.orderBy("k", "t").collect()], search))


def find_items(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", keep: tuple[str, ...] = ("doc_id",), search: Search | None = None) -> DataFrame:
    """``keep`` columns and ``hits`` (item key and distance) of every row,
    block by block."""
    if "hits" in keep:
        raise ValueError("a kept column cannot be named hits")
    src = docs.select(*keep, F.col(text).alias("__text"), F.array().cast(HIT_TYPE).alias("hits"))
    s = search or Search()
    for k, index in enumerate(indexes(benchmark, item_key, item_text, s)):
        src = staged(src, "items") if k and k % s.passes == 0 else src
        src = src.mapInArrow(_pass(index), src.schema)
    plain = F.transform("hits", lambda h: F.struct(h["item_id"], h["distance"]))
    shared = _items(benchmark, item_key, item_text).groupBy("t").count().where(F.col("count") > 1)
    if shared.isEmpty():
        return src.select(*keep, plain.alias("hits"))
    return _each_item(staged(src.drop("__text"), "hits"), _items(benchmark, item_key, item_text), list(keep))


def _each_item(found: DataFrame, items: DataFrame, keep: list[str]) -> DataFrame:
    """Hits on texts that several items share, once for each item: only these
    hits are exploded and joined with the items."""
    many = F.exists("hits", lambda h: h["mark"] != 0)
    plain = F.transform("hits", lambda h: F.struct(h["item_id"], h["distance"]))
    rows = staged(found.where(many).withColumn("__row", F.monotonically_increasing_id()), "shared-hits")
    each = rows.select("__row", F.explode("hits").alias("h")).select("__row", "h.*")
    names = items.withColumn("m", F.xxhash64("t")).select("m", "k")
    met = each.where(F.col("mark") != 0).join(names, F.col("mark") == F.col("m")).select("__row", F.col("k").alias("item_id"), "distance")
    every = met.unionByName(each.where(F.col("mark") == 0).select("__row", "item_id", "distance"))
    order = F.struct(F.col("item_id").isNull().alias("z"), "item_id", "distance")
    back = every.groupBy("__row").agg(F.sort_array(F.collect_list(order)).alias("o"))
    hits = F.transform("o", lambda h: F.struct(h["item_id"], h["distance"]))
    whole = rows.drop("hits").join(back, "__row").select(*keep, hits.alias("hits"))
    return found.where(~many).select(*keep, plain.alias("hits")).union(whole)


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", search: Search | None = None) -> DataFrame:
    """The rows, columns unchanged, in which no item is found."""
    s = search or Search()
    for k, index in enumerate(indexes(benchmark, item_key, item_text, s)):
        docs = staged(docs, "items") if k and k % s.passes == 0 else docs

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in C.slices(batch, text):
                    found = index.value.hits(part.column(part.schema.get_field_index(text)))
                    yield part.filter(pa.array([not f for f in found]))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def _pass(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, "__text"):
                names = part.schema.names
                new = index.value.hits(part.column(names.index("__text")))
                old = part.column(names.index("hits")).to_pylist()
                hits = pa.array([sorted(a + n, key=_by_item) if a else n for a, n in zip(old, new, strict=True)], _HIT)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], hits], names=names)

    return run
