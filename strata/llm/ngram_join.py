"""Similarity self-join on n-gram sets by a partitioned universe.

Two sets with Jaccard similarity of at least ``num / den`` differ in at most
``H = (a + b) * (den - num) // (den + num)`` elements. Sizes are cut into
bands so that partners lie in the same or in neighbouring bands. In each
band's scheme the hashed universe is cut into ``H + 1`` segments; two
partners must then agree on the whole of at least one segment, so the hash
of each segment's subset is a signature, and partners share one.

The allocation gives every segment a threshold by its cost: empty segments,
which would agree in all small sets, get -1 (skipped); in large schemes one
reserve segment gets +1 and is matched within one deletion (its one-deletion
neighbourhoods are signatures too); all others get 0. Schemes have a few
segments more than ``H + 1`` to pay for the skipped ones; a set that has too
many empty segments skips none. The sum of ``threshold + 1`` never falls
below ``H + 1``, so nothing is lost.

Equal signatures form buckets. In buckets of up to ``crowd`` sets all pairs
are counted; a set with ``e`` segments in use shares at least ``e - H`` with
a partner, so pairs with fewer common signatures are left out before any set
is moved. What is left is verified exactly on the sets.

Larger buckets hold crowds of near copies, or passages that very many texts
share. A set with few signatures in such buckets is found without them: the
``e - H`` leaves room. Only crowded sets, with more of them, are searched for
there: they are described by their differences from a pivot near the middle
of their crowd; similar sets that are not both similar to the pivot share a
difference, and many if they are far from it, so an index of the rarest
differences finds them. Every link between different sets is found or
implied by transitivity, and neither copies nor crowds of unlinked near
copies are expanded into all pairs.

Sets are known by a 64-bit key (a sum of scrambled element hashes); equal
sets are one node.

Defined results: a text without words, or null, has an empty set, links with
nothing and is its own component; with fewer words than ``width`` the whole
sequence is the only element; rows with equal sets are linked, also when
their key repeats or is null; the component is named by its least non-null
key; whole texts are read, however long; an empty table gives an empty
result. ``join`` returns columns of its own and reads only the key and the
text, whatever the others are called; ``one_of_each`` keeps all columns
(names starting with ``__`` are reserved).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import common as C
from strata.llm.common import staged
from strata.llm.components import components, grown, with_root

#: Signatures held back in a task to link equal ones at once.
PENDING = 1_000_000


@dataclass(frozen=True)
class Join:
    num: int = 90
    den: int = 100
    width: int = 3
    #: Sets of a bucket up to which all its pairs are counted.
    crowd: int = 16
    #: Largest broadcast filter of sets to verify (2**28 bits: 32 MB); it has
    #: about 16 bits a set, so that few others pass.
    filter_bits: int = 28


@cache
def _band_ends(num: int, den: int, size: int) -> np.ndarray:
    """Largest size of each band, up to one that holds ``size``."""
    ends = [den // num]
    while ends[-1] < size:
        ends.append((ends[-1] + 1) * den // num)
    return np.array(ends, np.int64)


def bands(num: int, den: int, size: int) -> np.ndarray:
    return _band_ends(num, den, 1 << max(10, int(size).bit_length()))


@cache
def scheme(num: int, den: int, high: int, low: int) -> tuple[int, int]:
    """(segments, most differences) of the scheme of a band of sizes ``low``
    to ``high``: enough segments that sets of size ``low`` can mostly skip
    their empty ones."""
    partner = high * den // num
    most = (high + partner) * (den - num) // (den + num)
    for m in range(most + 1, max(most + 2, low)):
        empty = m * np.exp(-low / m)
        if m - empty >= most + 1 + 2 * np.sqrt(empty):
            return m, most
    return most + 1, most


def reserve(m: int) -> int:
    """Segments matched within one deletion: only where their neighbourhoods
    are few next to the signatures."""
    return int(m >= 48)


def _segments(u: np.ndarray, band: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Salt of a band's scheme, and a set's elements scrambled by it with the
    segment each falls in."""
    salt = C.mix(np.array([band + 1], np.uint64))
    e = C.mix(u ^ salt)
    return salt, e, C.scaled(e, m)


def _allocation(seg: np.ndarray, m: int, most: int) -> tuple[np.ndarray, int]:
    """Which segments are in use, and how many (0: all, as too many are
    empty)."""
    r = reserve(m)
    keep = np.zeros(m, bool)
    keep[seg] = True
    keep[:r] = True
    used = int(keep.sum())
    return (keep, used) if used + r > most else (np.ones(m, bool), 0)


def segments_in_use(u: np.ndarray, band: int, m: int, most: int) -> int:
    return _allocation(_segments(u, band, m)[2], m, most)[1]


def segment_signatures(u: np.ndarray, band: int, m: int, most: int) -> np.ndarray:
    """Signatures of one set in a band's scheme with ``m`` segments."""
    with np.errstate(over="ignore"):
        salt, e, seg = _segments(u, band, m)
        order = np.argsort(seg, kind="stable")
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(C.mix(e[order] + C.U(1)))])
        edge = np.searchsorted(seg[order], np.arange(m + 1))
        sums = total[edge[1:]] - total[edge[:-1]]
        name = C.mix(salt + np.arange(m, dtype=np.uint64))
        out = C.mix(sums ^ name)
        keep, _ = _allocation(seg, m, most)
        r = reserve(m)
        if not r:
            return out[keep]
        inside = order[: edge[r]]
        deletions = C.mix((sums[seg[inside]] - C.mix(e[inside] + C.U(1))) ^ name[seg[inside]])
        return np.concatenate([out[keep], deletions])


def schemes(n: int, j: Join) -> Iterator[tuple[bool, int, int, int]]:
    """(own band?, band, segments, most differences) of the schemes of a set
    of size ``n``: its own band's, and the one below, where it can be the
    larger partner."""
    ends = bands(j.num, j.den, n)
    own = int(np.searchsorted(ends, n))
    for band in (own, own - 1):
        if band < 0:
            continue
        high, low = int(ends[band]), int(ends[band - 1]) + 1 if band else 1
        m, most = scheme(j.num, j.den, high, low)
        if most and n <= high * j.den // j.num:  # else partners are equal sets
            yield band == own, band, m, most


def signatures(u: np.ndarray, j: Join) -> np.ndarray:
    """All signatures of a set."""
    return np.concatenate([np.zeros(0, np.uint64), *[segment_signatures(u, band, m, most) for _, band, m, most in schemes(len(u), j)]])


def sets(text: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Distinct sorted n-gram hashes of each text."""
    raw, off = C.utf8(text)
    h, first = C.hash_words(raw, off, C.WORDS_FOLDED)
    for i in range(len(off) - 1):
        w = h[first[i] : first[i + 1]]
        yield np.unique(C.ngrams(w, min(width, len(w)))) if len(w) else w


def node_of(u: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int(np.array([C.mix(C.mix(u ^ C.U(0x5E7)).sum(dtype=np.uint64) + C.U(len(u)))]).view(np.int64)[0])


class _Pending:
    """Sets of a task whose signatures wait to be sent together."""

    def __init__(self) -> None:
        self.sigs: dict[int, np.ndarray] = {}
        self.held = 0

    def add(self, u: np.ndarray, j: Join) -> None:
        node = node_of(u)
        if len(u) and node not in self.sigs:  # a copy adds nothing
            self.sigs[node] = np.unique(signatures(u, j))
            self.held += len(self.sigs[node]) + 8

    def flush(self, crowd: int) -> pa.RecordBatch:
        """(sig, part, node). A bucket that is a crowd already in this task
        sends only so many sets to its own place; the others are dealt out
        to many places (part > 0), as nothing needs to be counted there."""
        node = np.fromiter(self.sigs, np.int64, len(self.sigs))
        sig = np.concatenate([*self.sigs.values(), np.zeros(0, np.uint64)])
        of = np.repeat(node, [len(x) for x in self.sigs.values()])
        order = np.argsort(sig, kind="stable")
        fresh = np.append(True, np.diff(sig[order]) != 0)[: len(sig)]
        rank = np.arange(len(sig)) - np.maximum.accumulate(np.where(fresh, np.arange(len(sig)), 0))
        part = np.zeros(len(sig), np.int32)
        part[order] = np.where(rank > crowd, 1 + (of[order] & 63), 0)
        return pa.RecordBatch.from_arrays([C.as_long(sig), pa.array(part, pa.int32()), C.as_long(of)], names=["sig", "part", "node"])


def _signature_rows(docs: DataFrame, text: str, j: Join) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wait = _Pending()
        for batch in batches:
            for part in C.slices(batch, "__text"):
                for u in sets(part.column(0), j.width):
                    wait.add(u, j)
                if wait.held >= PENDING:
                    yield wait.flush(j.crowd)
                    wait = _Pending()
        if wait.sigs:
            yield wait.flush(j.crowd)

    return docs.select(F.col(text).alias("__text")).mapInArrow(run, "sig long, part int, node long")


def _buckets(docs: DataFrame, text: str, j: Join) -> DataFrame:
    """(sig, part, node, held) of buckets with several sets; ``held`` is
    their number, or more than ``crowd``."""
    bucket = Window.partitionBy("sig", "part")
    order = bucket.orderBy("node")
    rows = _signature_rows(docs, text, j).withColumns({"at": F.dense_rank().over(order), "again": F.lag("node").over(order)})
    rows = rows.withColumn("held", F.when(F.col("part") > 0, F.lit(j.crowd + 1)).otherwise(F.max("at").over(bucket)))
    rows = rows.where((F.col("held") > 1) & (F.col("again").isNull() | (F.col("again") != F.col("node"))))
    return staged(rows.select("sig", "part", "node", "held"), "buckets")


def _counted_pairs(buckets: DataFrame, j: Join) -> DataFrame:
    """(a, b, c): pairs of sets with ``c`` signatures in common, counted in
    the buckets that are no crowds. Each has at most ``crowd`` sets."""
    small = buckets.where(F.col("held") <= j.crowd).groupBy("sig", "part").agg(F.sort_array(F.collect_list("node")).alias("nodes"))
    pairs = F.flatten(F.transform("nodes", lambda a, i: F.transform(F.slice("nodes", i + 2, F.size("nodes")), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return small.select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("c"))


def _maybe(hashes: DataFrame, bits: int) -> np.ndarray:
    """Bloom filter of a column of hashes, ``2**bits`` bits whatever their
    number: only its non-zero words come to the driver."""
    h = F.col(hashes.columns[0])
    place = F.explode(F.array(h.bitwiseAND(F.lit((1 << bits) - 1)), F.shiftrightunsigned(h, 64 - bits)))
    words = hashes.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("x"))
    out = np.zeros(max(1, (1 << bits) >> 6), np.uint64)
    rows = words.toPandas()
    out[rows.w.to_numpy(np.int64)] = rows.x.to_numpy(np.int64).view(np.uint64)
    return out


def _passes(words: np.ndarray, bits: int, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the filter lets pass."""
    h = hashes.view(np.uint64)
    held = lambda p: words[p >> C.U(6)] >> (p & C.U(63)) & C.U(1) != 0
    return held(h & C.U((1 << bits) - 1)) & held(h >> C.U(64 - bits))


def _described(docs: DataFrame, text: str, keys: list[str], j: Join) -> DataFrame:
    """``keys``, set size and node of each row; the first time a task meets a
    node, also its segments in use and most differences in both schemes."""
    src = docs.select(*keys, F.col(text).alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]] + ["n long, node long, own int, own_most int, low int, low_most int"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        for batch in batches:
            for part in C.slices(batch, "__text"):
                n, nodes, use = [], [], []
                for u in sets(part.column(len(keys)), j.width):
                    node = node_of(u)
                    n.append(len(u))
                    nodes.append(node)
                    both = {} if node in given else {own: (segments_in_use(u, band, m, most), most) for own, band, m, most in schemes(len(u), j)}
                    use.append((*both.get(True, (None, None)), *both.get(False, (None, None))))
                    given.add(node)
                if len(given) > PENDING:
                    given.clear()
                cols = [part.column(i) for i in range(len(keys))] + [pa.array(n, pa.int64()), pa.array(nodes, pa.int64())]
                cols += [pa.array([x[k] for x in use], pa.int32()) for k in range(4)]
                yield pa.RecordBatch.from_arrays(cols, names=[*keys, "n", "node", "own", "own_most", "low", "low_most"])

    return src.mapInArrow(run, schema)


def _sets_of(docs: DataFrame, text: str, j: Join, nodes: DataFrame, signed: DataFrame) -> DataFrame:
    """(node, elements) of the ``nodes``, and of a few others that pass for
    them. The texts are read again, and stay where they are: one text of each
    node is picked by its hash, and only texts whose hash passes a broadcast
    filter of these are cut into words."""
    picked = staged(signed.groupBy("node").agg(F.min("hash").alias("hash")).join(nodes.select("node").distinct(), "node", "left_semi").select("hash"), "picked")
    bits = min(j.filter_bits, max(12, (16 * picked.count()).bit_length()))
    wanted = docs.sparkSession.sparkContext.broadcast(_maybe(picked, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        for batch in batches:
            batch = batch.filter(pa.array(_passes(wanted.value, bits, batch.column(1).to_numpy())))
            for part in C.slices(batch, "__text"):
                found = {node: u.view(np.int64) for u in sets(part.column(0), j.width) if len(u) and (node := node_of(u)) not in given}
                given.update(found)
                if len(given) > PENDING:
                    given.clear()
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.list_(pa.int64()))], names=["node", "elements"])

    rows = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("__text"), "hash").mapInArrow(run, "node long, elements array<long>")
    return staged(rows.dropDuplicates(["node"]), "sets")


def _promising(counted: DataFrame, info: DataFrame, j: Join) -> DataFrame:
    """Pairs with as many common signatures as similar sets must have."""
    side = lambda x: info.select(F.col("node").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in ("n", "own", "own_most", "low", "crowds")])
    met = counted.join(side("a"), "a").join(side("b"), "b")
    most = F.floor((F.col("a_n") + F.col("b_n")) * (j.den - j.num) / (j.den + j.num))
    # sets of one band share its scheme; else the smaller one's band is used.
    # A set of the larger band has a greater bound, and equal bounds mean one
    # band or two that are as good as one (the smaller use counts).
    use = lambda x, y: F.when(F.col(f"{x}_own_most") == F.col(f"{y}_own_most"), F.least(F.col(f"{x}_own"), F.col(f"{x}_low"))).when(F.col(f"{x}_own_most") < F.col(f"{y}_own_most"), F.col(f"{x}_own")).otherwise(F.col(f"{x}_low"))
    need = F.greatest(F.coalesce(use("a", "b"), F.lit(0)), F.coalesce(use("b", "a"), F.lit(0))) - most
    return met.where(F.col("c") >= F.greatest(F.lit(1), need - F.least("a_crowds", "b_crowds"))).select("a", "b")


def _similar(pairs: DataFrame, found: DataFrame, j: Join) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are similar enough."""
    one = found.select(F.col("node").alias("a"), F.col("elements").alias("ea"))
    two = found.select(F.col("node").alias("b"), F.col("elements").alias("eb"))
    met = pairs.join(one, "a").join(two, "b").withColumn("i", F.size(F.array_intersect("ea", "eb")))
    return staged(met.where(j.den * F.col("i") >= j.num * (F.size("ea") + F.size("eb") - F.col("i"))).select("a", "b"), "similar")


def join(docs: DataFrame, text: str = "text", key: str = "doc_id", params: Join | None = None) -> DataFrame:
    """One row a document: ``key``, ``rid`` (the key, or a hash of the text
    where it is null), ``n`` (set size), ``node`` (set) and ``component``
    (least key of the component)."""
    signed, root = _linked(docs, text, [key, "rid", "hash"], key, params)
    return _named(signed, key, root)


def _linked(docs: DataFrame, text: str, keys: list[str], key: str, params: Join | None) -> tuple[DataFrame, DataFrame]:
    """``keys`` (``key``, ``rid`` and ``hash``, that of the text), set size
    and node of each row; and the root of every node with a link."""
    j = params or Join()
    docs = docs.select(F.col(key), F.col(text), F.coalesce(F.col(key).cast("long"), F.xxhash64(text)).alias("rid"), F.xxhash64(text).alias("hash"))
    buckets = _buckets(docs, text, j)
    counted = staged(_counted_pairs(buckets, j), "counted")
    signed = staged(_described(docs, text, keys, j), "described")
    crowds = buckets.where(F.col("held") > j.crowd).select("sig", "node")
    seen = crowds.groupBy("node").agg(F.count(F.lit(1)).alias("crowds"))
    info = signed.where(F.col("own").isNotNull()).drop(*keys).dropDuplicates(["node"])
    info = staged(info.join(seen, "node", "left").fillna(0, ["crowds"]), "info")
    close = staged(_promising(counted, info, j), "promising")
    links = _similar(close, _sets_of(docs, text, j, close.select(F.explode(F.array("a", "b")).alias("node")), signed), j)
    root = staged(components(links), "roots")

    # sets that may have partners in crowds alone
    # partners in the own scheme have up to n * den / num elements, those in
    # the scheme below fewer than n
    bound = lambda n: F.floor(n * (j.den - j.num) / (j.den + j.num))
    own_most = F.least("own_most", bound(F.col("n") + F.floor(F.col("n") * j.den / j.num)))
    low_most = F.least("low_most", bound(2 * F.col("n") - 1))
    room = F.least(F.greatest(F.col("own") - own_most, F.lit(1)), F.greatest(F.coalesce("low", F.lit(1 << 30)) - F.coalesce(low_most, F.lit(0)), F.lit(1)))
    crowded = info.where((F.col("crowds") > 0) & (F.col("crowds") >= room)).select("node")
    members = staged(crowds.join(crowded, "node", "left_semi"), "members")
    sigs = _open_buckets(members, root)
    if sigs is not None:
        members = staged(members.join(sigs, "sig", "left_semi"), "members")
        found = _sets_of(docs, text, j, members.select("node"), signed)
        around = _around_pivots(members, found, j.crowd)
        # every set of a group against its pivot: most of what is linked at all
        near = around.where(_close(j, F.col("pn"), F.col("n"), _apart())).select(F.col("pivot").alias("a"), F.col("node").alias("b"))
        root = grown(root, near.where(F.col("a") != F.col("b")))
        new = staged(_overlapping(around, root, j), "pairs")
        if not new.isEmpty():
            root = grown(root, _similar(new, found, j))
    return signed, root


def _open_buckets(members: DataFrame, root: DataFrame) -> DataFrame | None:
    """Signatures whose sets lie in different components, or None."""
    ends = with_root(members, root, "node").groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    sigs = staged(ends.where(F.col("lo") != F.col("hi")).select("sig"), "open")
    return None if sigs.isEmpty() else sigs


def _close(j: Join, a: Column, b: Column, apart: Column) -> Column:
    """Are sets of sizes ``a`` and ``b`` with so many differences similar?"""
    return apart * (j.den + j.num) <= (a + b) * (j.den - j.num)


def _differences(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """``pairs`` (pivot, node) with sizes ``pn``, ``n`` and the symmetric
    difference: elements that the pivot lacks (``more``) and has (``less``)."""
    one = found.select(F.col("node").alias("pivot"), F.col("elements").alias("ep"))
    two = found.select("node", F.col("elements").alias("en"))
    met = pairs.join(one, "pivot").join(two, "node")
    return met.select(*pairs.columns, F.size("ep").alias("pn"), F.size("en").alias("n"), F.array_except("en", "ep").alias("more"), F.array_except("ep", "en").alias("less"))


def _apart() -> Column:
    return F.size("more") + F.size("less")


def _around_pivots(members: DataFrame, found: DataFrame, crowd: int) -> DataFrame:
    """Buckets drawn together into groups, and each group's sets by their
    difference from a pivot: the set that is nearest to the group's majority.

    Two sets of a bucket are in one group. If they are similar and share no
    difference from the pivot, both are similar to the pivot itself; so all
    links not given by the pivot are between sets that share a difference.
    """
    hubs = members.groupBy("sig").agg(F.min("node").alias("hub"))
    # a hub's bucket joins the group of the least hub that it meets elsewhere
    under = members.join(hubs, "sig").select("hub", "node").distinct()
    first = under.groupBy("node").agg(F.min("hub").alias("group")).withColumnRenamed("node", "of")
    groups = under.join(first, under["hub"] == first["of"]).select("group", "node").distinct()
    groups = staged(groups, "groups")
    rough = staged(_differences(groups.withColumnRenamed("group", "pivot"), found), "rough")
    size = groups.groupBy("group").agg(F.count(F.lit(1)).alias("held"))
    diff = F.concat("more", "less")
    each = rough.select(F.col("pivot").alias("group"), F.explode(diff).alias("x"))
    # the majority's differences: at most twice as many as a set has on
    # average. A crowd's majority is more than half of ``crowd``; in what is
    # left of a smaller one any set will do as a pivot
    common = each.groupBy("group", "x").agg(F.count(F.lit(1)).alias("c")).where(2 * F.col("c") > crowd).join(size, "group").where(2 * F.col("c") > F.col("held"))
    common = common.groupBy("group").agg(F.collect_list("x").alias("common"))
    score = rough.withColumnRenamed("pivot", "group").join(common, "group", "left")
    far = _apart() - 2 * F.size(F.array_intersect(diff, F.coalesce("common", F.array().cast("array<bigint>"))))
    pivot = score.groupBy("group").agg(F.min(F.struct(far.alias("far"), F.col("node"))).alias("p")).select("group", F.col("p.node").alias("pivot"))
    return staged(_differences(groups.join(pivot, "group"), found), "around")


def _overlapping(around: DataFrame, root: DataFrame, j: Join) -> DataFrame:
    """Pairs of sets of one group, in different components, that may be
    similar: they need ``(|dx| + |dy| - H) / 2`` common differences, so with
    the rarest differences first their first common one comes early. What the
    pivot lacks comes before what it has; where a set has more of the former
    than its first common difference can lie behind, the latter are not
    looked at. Differences that one component has alone come first of all:
    they pair nothing up and are only counted.
    """
    most = F.floor((F.col("n") + F.floor(F.col("n") * j.den / j.num)) * (j.den - j.num) / (j.den + j.num))
    enough_more = F.size("more") > most
    rows = around.select("group", "node", "n", _apart().alias("d"), most.alias("most"), F.when(enough_more, F.col("more")).otherwise(F.concat("more", "less")).alias("seen"), F.size("more").alias("m"))
    rows = with_root(rows, root, "node")
    each = rows.select("group", "node", "n", "d", "most", "root", "m", F.posexplode("seen").alias("k", "x"))
    often = each.groupBy("group", "x").agg(F.count(F.lit(1)).alias("c"), F.min("root").alias("lo"), F.max("root").alias("hi")).where(F.col("lo") != F.col("hi"))
    kept = each.join(often.select("group", "x", "c"), ["group", "x"])
    # elements the pivot has come last; of each kind the rarest come first
    mine = Window.partitionBy("group", "node")
    has = F.col("k") >= F.col("m")
    order = mine.orderBy(has, "c", "x")
    kept = kept.withColumns({"rank": F.row_number().over(order), "lacking": F.count_if(~has).over(mine), "all": F.count(F.lit(1)).over(mine)})
    # differences from this one on: those of its kind that are left, and the
    # whole kind behind it
    behind = F.when(has, F.col("all") - F.col("rank") + 1).otherwise(F.col("lacking") - F.col("rank") + 1 + F.col("d") - F.col("m"))
    ranked = kept.withColumn("left", behind).where(F.col("d") - F.col("left") <= F.col("most"))
    one = ranked.select("group", "x", F.col("node").alias("a"), F.col("root").alias("ra"), F.col("n").alias("na"), F.col("d").alias("da"), F.col("left").alias("la"))
    two = ranked.select("group", "x", F.col("node").alias("b"), F.col("root").alias("rb"), F.col("n").alias("nb"), F.col("d").alias("db"), F.col("left").alias("lb"))
    # with ``o`` common differences the two sets are da + db - 2 o apart
    enough = _close(j, F.col("na"), F.col("nb"), F.col("da") + F.col("db") - 2 * F.least("la", "lb"))
    met = one.join(two, ["group", "x"]).where((F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb")) & enough)
    return met.select("a", "b").distinct()


def _named(signed: DataFrame, key: str, root: DataFrame) -> DataFrame:
    full = signed.where(F.col("n") > 0)
    least = full.groupBy("node").agg(F.min(key).alias("least"))
    rooted = with_root(least, root, "node")
    names = rooted.groupBy("root").agg(F.min("least").alias("component")).withColumnRenamed("root", "r")
    # written, so that the last join reads two plain tables and can be split
    names = staged(rooted.join(names, rooted["root"] == names["r"]).select(F.col("node").alias("n_node"), "component"), "names")
    out = full.join(names, full["node"] == names["n_node"]).select(key, "rid", "n", "node", "component")
    return out.union(signed.where(F.col("n") == 0).select(key, "rid", "n", "node", F.col(key).alias("component")))


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", params: Join | None = None) -> DataFrame:
    """The rows and columns of ``docs`` with one document left of each
    component: the one with the least key, and of these the one with the
    least hash of its text. Components are told apart by their root node and
    documents by key and text, so keys may repeat or be null. Texts without
    words all stay."""
    signed, root = _linked(docs, text, [key, "rid", "hash"], key, params)
    lead = F.struct(F.col(key).isNull().alias("unkeyed"), F.col("rid"), F.col("hash"))
    least = signed.where(F.col("n") > 0).groupBy("node").agg(F.min(lead).alias("l"))
    leaders = with_root(least, root, "node").groupBy("root").agg(F.min("l").alias("l"))
    # written, so that the last join reads two plain tables and can be split
    leaders = staged(leaders.select(F.col("l.rid").alias("__rid"), F.col("l.hash").alias("__hash")), "leaders")
    rid = F.coalesce(F.col(key).cast("long"), F.xxhash64(text))
    wordless = ~F.rlike(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]"))
    rows = docs.where(~wordless).withColumns({"__rid": rid, "__hash": F.xxhash64(text)})
    full = rows.join(leaders, ["__rid", "__hash"], "left_semi").dropDuplicates(["__rid", "__hash"])
    return full.select(*docs.columns).union(docs.where(wordless))
