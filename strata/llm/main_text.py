"""Main text of HTML pages by minimum cuts.

A page becomes text blocks with a few features (kind of element, share of
linked characters, words, sentence end) and the evidence of its own markup.
A logistic classifier over the features is fitted on the counts of marked
blocks of ALL pages: Spark counts them by feature cell, so the driver gets
at most ``html_blocks.CELLS`` rows whatever the corpus. Its log-odds and the
evidence are a block's terminal capacities; neighbours in the text and
blocks with a common container are joined by smoothness edges, containers
being nodes of the graph. The minimum cut separates content from
boilerplate: nodes whose label no neighbours can turn are settled first, the
maximum flow runs on what is left.

Defined results: null or empty html, and pages without content, give an
empty text; ties are content; repeated rows are read alike; with no marked
block at all the classifier keeps its prior weights; white space is what
Unicode calls so; tags cut off by the end of a page are dropped; whole pages
are read, however long; input columns named ``text`` or ``n_chars`` are
replaced, others pass through; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf

from strata.llm import common as C
from strata.llm import html_blocks as H

ADDED = ("text", "n_chars")
#: Capacities are whole thousandths of a nat.
UNIT = 1000

# Prior weights of the classifier, in nats.
PRIOR_KIND = (0.3, 0.6, -0.1, -0.1, -0.2)  # heading, paragraph, item, cell, other
PRIOR_LINKS = (0.4, 0.0, -0.8, -1.8, -2.6)  # no link to all linked
PRIOR_WORDS = (-0.8, -0.5, -0.3, 0.1, 0.5, 0.9, 1.2, 1.4, 1.5, 1.5, 1.5, 1.5)  # by powers of two
PRIOR_ENDS = (-0.3, 0.4)


@dataclass(frozen=True)
class Cut:
    neighbours: float = 1.2  # next to each other in one container
    adjacency: float = 0.3  # next to each other in the text alone
    container: float = 0.6
    nesting: float = 1.0
    bound: float = 4.0  # of the classifier's log-odds
    trust: float = 200.0  # weight of each class against the prior


def _design() -> np.ndarray:
    """One row a feature cell: its one-hot features."""
    sizes = [len(p) for p in (PRIOR_KIND, PRIOR_LINKS, PRIOR_WORDS, PRIOR_ENDS)]
    grid = np.indices(sizes).reshape(len(sizes), -1).T
    return np.hstack([np.eye(n)[grid[:, k]] for k, n in enumerate(sizes)])


def marked_cells(pages: DataFrame, html: str = "html") -> DataFrame:
    """(cell, content, n): the blocks that markup calls content or
    boilerplate, counted by task and then by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for part in C.slices(batch, "html"):
                for html in part.column(0).to_pylist():
                    p = H.parse(html or "")
                    seen.update((c, e > 0) for c, e in zip(p.cells, p.evidence, strict=True) if abs(e) == H.STRONG)
        rows = sorted(seen.items())
        yield pa.RecordBatch.from_arrays([pa.array([c for (c, _), _ in rows], pa.int32()), pa.array([y for (_, y), _ in rows], pa.bool_()), pa.array([n for _, n in rows], pa.int64())], names=["cell", "content", "n"])

    return pages.select(F.col(html).alias("html")).mapInArrow(run, "cell int, content boolean, n long").groupBy("cell", "content").agg(F.sum("n").alias("n"))


def fit(pages: DataFrame, html: str = "html", params: Cut | None = None) -> np.ndarray:
    """Log-odds of content of each feature cell: logistic regression with a
    normal prior around the fixed weights, both classes weighing the same."""
    p, x = params or Cut(), _design()
    prior = np.array([*PRIOR_KIND, *PRIOR_LINKS, *PRIOR_WORDS, *PRIOR_ENDS])
    rows = marked_cells(pages, html).toPandas()
    n = np.zeros((2, len(x)))
    n[rows.content.to_numpy(int), rows.cell.to_numpy(int)] = rows.n
    total = n.sum(1, keepdims=True)
    n = np.where(total > 0, n / np.maximum(total, 1) * p.trust, 0.0)
    if not (total > 0).all():  # one class alone tells nothing
        n[:] = 0
    w = prior.copy()
    for _ in range(50):
        odds = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (n[1] * (1 - odds) - n[0] * odds) - (w - prior)
        curve = x.T @ (x * (n.sum(0) * odds * (1 - odds))[:, None]) + np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return np.clip(x @ w, -p.bound, p.bound)


def _flow(cost: dict[int, int], edges: dict[int, dict[int, int]]) -> set[int]:
    """Content side of the minimum cut of the nodes of ``cost`` (positive:
    capacity from the source, negative: to the sink), by Dinic's algorithm;
    among equal cuts the one with most content."""
    s, t = -1, -2
    left: dict[int, dict[int, int]] = {v: dict(edges[v]) for v in cost}
    left[s] = {v: c for v, c in cost.items() if c > 0}
    left[t] = {}
    for v, c in cost.items():
        if c < 0:
            left[v][t] = -c
            left[t][v] = 0
        elif c > 0:
            left[v][s] = 0
    while True:
        level, queue = {s: 0}, deque([s])
        while queue and t not in level:
            u = queue.popleft()
            for v, c in left[u].items():
                if c and v not in level:
                    level[v] = level[u] + 1
                    queue.append(v)
        if t not in level:
            break
        arcs = {v: iter(left[v].items()) for v in level}
        path = [s]
        while path:
            u = path[-1]
            if u == t:
                push = min(left[a][b] for a, b in zip(path, path[1:], strict=False))
                cut = 0
                for k in range(len(path) - 2, -1, -1):
                    a, b = path[k], path[k + 1]
                    left[a][b] -= push
                    left[b][a] += push
                    if not left[a][b]:
                        cut = k
                del path[cut + 1 :]
                arcs[path[-1]] = iter(left[path[-1]].items())
                continue
            for v, c in arcs[u]:
                if c and level.get(v) == level[u] + 1:
                    path.append(v)
                    break
            else:
                level.pop(u)
                path.pop()
    lost, queue = {t}, deque([t])  # whatever can still reach the sink
    while queue:
        v = queue.popleft()
        for u in left[v]:
            if u not in lost and left[u][v]:
                lost.add(u)
                queue.append(u)
    return {v for v in cost if v not in lost}


def cut(cost: list[int], parents: list[int], ups: list[int], p: Cut) -> list[bool]:
    """Which blocks the minimum cut leaves on the side of content."""
    n = len(cost)
    c = [*cost, *[0] * len(ups)]
    edges: list[dict[int, int]] = [{} for _ in c]

    def join(u: int, v: int, w: float) -> None:
        w = round(w * UNIT)
        edges[u][v] = edges[u].get(v, 0) + w
        edges[v][u] = edges[v].get(u, 0) + w

    for i in range(n):
        if i:
            join(i - 1, i, p.neighbours if parents[i] == parents[i - 1] else p.adjacency)
        join(i, n + parents[i], p.container)
    for i, up in enumerate(ups):
        if up >= 0:
            join(n + i, n + up, p.nesting)
    # a node whose capacity outweighs its open edges keeps its side
    open_ = [sum(e.values()) for e in edges]
    content: list[bool | None] = [None] * len(c)
    queue = deque(range(len(c)))
    while queue:
        v = queue.popleft()
        if content[v] is not None or -open_[v] <= c[v] < open_[v]:
            continue
        content[v] = c[v] > 0 or c[v] >= open_[v]
        for u, w in edges[v].items():
            if content[u] is None:
                c[u] += w if content[v] else -w
                open_[u] -= w
                queue.append(u)
    rest = {v: c[v] for v, side in enumerate(content) if side is None}
    kept = _flow(rest, {v: {u: w for u, w in edges[v].items() if u in rest} for v in rest}) if rest else set()
    return [content[i] if content[i] is not None else i in kept for i in range(n)]


def blocks(pages: DataFrame, html: str = "html", drop: tuple[str, ...] = ()) -> DataFrame:
    """Columns of ``pages`` but ``html`` and ``drop``, and the blocks of each
    page: ``__texts``, ``__cells``, ``__evidence``, ``__parents``, ``__ups``."""
    others = [c for c in pages.columns if c not in (*drop, html)]
    src = pages.select(*others, F.col(html).alias("__html"))
    names = [*others, "__texts", "__cells", "__evidence", "__parents", "__ups"]
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in C.slices(batch, "__html"):
                read = [H.parse(h or "") for h in part.column(len(others)).to_pylist()]
                ints = [pa.array([getattr(p, f) for p in read], pa.list_(pa.int32())) for f in ("cells", "evidence", "parents", "ups")]
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(len(others))], pa.array([p.texts for p in read], pa.list_(pa.string())), *ints], names=names)

    return src.mapInArrow(run, ", ".join([*types, "__texts array<string>", *[f"{c} array<int>" for c in names[-4:]]]))


def _labels(params: Cut):
    @arrow_udf("array<boolean>")
    def labels(cost: pa.Array, parents: pa.Array, ups: pa.Array) -> pa.Array:
        return pa.array([cut(*row, params) for row in zip(cost.to_pylist(), parents.to_pylist(), ups.to_pylist(), strict=True)], pa.list_(pa.bool_()))

    return labels


def costs(odds: np.ndarray) -> Column:
    """Terminal capacities of a page's blocks, in thousandths of a nat."""
    table = F.array(*[F.lit(int(v)) for v in np.round(odds * UNIT)])
    return F.zip_with("__cells", "__evidence", lambda cell, said: F.get(table, cell) + said * F.lit(UNIT))


def extract(pages: DataFrame, odds: np.ndarray, html: str = "html", params: Cut | None = None) -> DataFrame:
    """Columns of ``pages`` but ``html``, with ``text`` and ``n_chars``."""
    p = params or Cut()
    others = [c for c in pages.columns if c not in (*ADDED, html)]
    read = blocks(pages, html, ADDED).withColumn("__cost", costs(odds))
    kept = read.withColumn("__kept", _labels(p)("__cost", "__parents", "__ups"))
    text = F.array_join(F.filter("__texts", lambda _, i: F.get("__kept", i)), " ")
    return kept.select(*others, text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
