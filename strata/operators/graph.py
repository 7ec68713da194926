"""Property graph: typed vertices and directed edges with JSON properties.

No traversal is needed (the workloads only join vertices to edges), so the
graph is two DataFrames:

* vertices ``(identifier STRING, type STRING, properties)``
* edges ``(subject_identifier, subject_type, object_identifier,
  object_type, edge_type, properties)``

``properties`` is JSON text (``to_json`` keeping NULL fields) or, with
``as_map=True``, a ``MAP<STRING,STRING>``. With ``typed=True`` the properties
are columns of their own: queries between build and sink then neither write
nor parse JSON, read only the columns they use, and kinds with different
properties union by name; :func:`as_json` makes the JSON form at the sink.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import json_props
from strata.operators.joins import first_per_key


# Columns the edge builders carry through the (player, game) dedupe. Both
# edge kinds use the same set so their dedupe subtrees are identical and
# the shuffle is computed once and reused (plays_in, and both sides of the
# pair self-join).
EDGE_PAYLOAD = ("player_name", "start_position", "pts", "team_id", "team_abbreviation")


def _props(pairs: Sequence[tuple[str, Column]], as_map: bool) -> Column:
    if as_map:
        flat = []
        for k, v in pairs:
            flat += [F.lit(k), v.cast("string")]
        return F.create_map(*flat)
    return json_props(*pairs)


def _columns(pairs: Sequence[tuple[str, Column]], typed: bool, as_map: bool = False) -> list[Column]:
    return [v.alias(k) for k, v in pairs] if typed else [_props(pairs, as_map).alias("properties")]


def as_json(typed_rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Typed vertices or edges of one kind with their columns ``names`` as
    JSON ``properties``."""
    rest = [c for c in typed_rows.columns if c not in names]
    return typed_rows.select(*rest, json_props(*[(n, F.col(n)) for n in names]).alias("properties"))


def _property(df: DataFrame, name: str, kind: str) -> Column:
    """A property as ``kind``: its own column, or a field of the JSON."""
    return F.col(name).cast(kind) if name in df.columns else F.get_json_object("properties", f"$.{name}").try_cast(kind)


def vertices(df: DataFrame, id_col: str | Column, vertex_type: str,
             props: Sequence[tuple[str, Column | str]], *, as_map: bool = False, typed: bool = False) -> DataFrame:
    """Vertex rows from one row per entity."""
    ident = F.col(id_col) if isinstance(id_col, str) else id_col
    pairs = [(k, F.col(v) if isinstance(v, str) else v) for k, v in props]
    return df.select(ident.cast("string").alias("identifier"), F.lit(vertex_type).alias("type"),
                     *_columns(pairs, typed, as_map))


def game_vertices(games: DataFrame, *, typed: bool = False) -> DataFrame:
    """One vertex per game with points and the winning team."""
    winner = F.when(F.col("home_team_wins") == 1, F.col("home_team_id")).otherwise(F.col("visitor_team_id"))
    return vertices(games, "game_id", "game",
                    [("pts_home", "pts_home"), ("pts_away", "pts_away"), ("winning_team", winner)], typed=typed)


def player_vertices(details: DataFrame, *, typed: bool = False) -> DataFrame:
    """Players aggregated from box-score lines.

    ``teams`` is the sorted distinct team list (bounded by the number of
    teams, never by the number of games).
    """
    agg = details.groupBy("player_id").agg(
        F.max("player_name").alias("player_name"),
        F.count(F.lit(1)).alias("number_of_games"),
        F.sum("pts").alias("total_points"),
        F.sort_array(F.collect_set("team_id")).alias("teams"))
    return vertices(agg, "player_id", "player",
                    [("player_name", "player_name"), ("number_of_games", "number_of_games"),
                     ("total_points", "total_points"), ("teams", "teams")], typed=typed)


def team_vertices(teams: DataFrame, *, order_by: Sequence[str] = ("row_order",),
                  as_map: bool = False, typed: bool = False) -> DataFrame:
    """One vertex per team id, first row by ``order_by``.

    The reference leaves the pick among duplicates open; an explicit
    tie-break makes it deterministic.
    """
    one = first_per_key(teams, ["team_id"], list(order_by))
    year = F.col("yearfounded").cast("string") if as_map else F.col("yearfounded")
    return vertices(one, "team_id", "team",
                    [("abbreviation", "abbreviation"), ("nickname", "nickname"), ("city", "city"),
                     ("arena", "arena"), ("year_founded", year)], as_map=as_map, typed=typed)


def dedupe_appearances(details: DataFrame, *, order_by: Sequence[str] = ("line_no", "part_no"),
                       keep: Sequence[str] | None = None) -> DataFrame:
    """One line per (player, game), first by ``order_by``.

    ``keep`` narrows the carried columns before the shuffle, so only what
    the caller needs travels through the dedupe.
    """
    if keep is not None:
        wanted = ["player_id", "game_id", *order_by, *[c for c in keep if c not in order_by]]
        details = details.select(*dict.fromkeys(wanted))
    return first_per_key(details, ["player_id", "game_id"], list(order_by))


def plays_in_edges(details: DataFrame, *, order_by: Sequence[str] = ("line_no", "part_no"),
                   typed: bool = False) -> DataFrame:
    """Player -> game edges with the line's position, points and team."""
    d = dedupe_appearances(details, order_by=order_by, keep=EDGE_PAYLOAD)
    return d.select(
        F.col("player_id").cast("string").alias("subject_identifier"), F.lit("player").alias("subject_type"),
        F.col("game_id").cast("string").alias("object_identifier"), F.lit("game").alias("object_type"),
        F.lit("plays_in").alias("edge_type"),
        *_columns([(c, F.col(c)) for c in ("start_position", "pts", "team_id", "team_abbreviation")], typed))


def _met(rows: DataFrame, keys: Sequence[str], condition: Column, *, ordered: bool) -> DataFrame:
    """Two players of a game, once a pair, the greater id as subject;
    ``ordered``: the condition already puts it first."""
    f1, f2 = rows.alias("f1"), rows.alias("f2")
    cond = [F.col(f"f1.{k}") == F.col(f"f2.{k}") for k in keys] + [F.col("f1.player_name") != F.col("f2.player_name"), condition]
    etype = (F.when(F.col("f1.team_abbreviation") == F.col("f2.team_abbreviation"), F.lit("shares_team"))
              .otherwise(F.lit("plays_against")))
    first = F.col("f1.player_id") > F.col("f2.player_id")

    def pick(c: str) -> list[Column]:
        one, two = F.col(f"f1.{c}"), F.col(f"f2.{c}")
        return [one, two] if ordered else [F.when(first, one).otherwise(two), F.when(first, two).otherwise(one)]

    (s, o), (sn, on), (sp, op) = (pick(c) for c in ("player_id", "player_name", "pts"))
    return f1.join(f2, cond, "inner").select(s.alias("s"), o.alias("o"), etype.alias("edge_type"), sn.alias("sn"), on.alias("on"),
                                             sp.alias("sp"), op.alias("op"))


def _block_pairs(rows: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    """Pairs of the games of ``sizes`` (game_id, n): each game is cut into
    ``k = ceil(n / block)`` blocks of players, and each of the
    ``k * (k + 1) / 2`` pairs of blocks is a join key of its own."""
    k = F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(block))).cast("int")
    cut = rows.join(sizes.select("game_id", k.alias("k")), "game_id").withColumn("b", F.pmod(F.xxhash64("player_id"), F.col("k")).cast("int"))
    # a block meets itself and every other one, by the pair's (low, high)
    other = F.explode(F.sequence(F.lit(0), F.col("k") - 1))
    dealt = cut.withColumn("other", other).withColumns({"low": F.least("b", "other"), "high": F.greatest("b", "other")}).drop("k", "other")
    once = (F.col("f1.b") < F.col("f2.b")) | ((F.col("f1.b") == F.col("f2.b")) & (F.col("f1.low") == F.col("f1.high")) & (F.col("f1.player_id") > F.col("f2.player_id")))
    return _met(dealt, ["game_id", "low", "high"], once, ordered=False)


def pair_edges(details: DataFrame, *, order_by: Sequence[str] = ("line_no", "part_no"),
               hot_rows: int = 10_000, block: int = 1_000, typed: bool = False) -> DataFrame:
    """Player <-> player edges for players who met in a game.

    A self equi-join on game (the residual ``id1 > id2`` and name test is a
    join condition, not a filter after a product), aggregated per pair and
    edge type with map-side combine. Games of more than ``hot_rows`` lines,
    counted when the plan is built (one column, combined map-side), are hot
    join keys: they go by pairs of blocks of about ``block`` players, a task
    for each pair of blocks. Without such games the plan is the plain join:
    no count, copy or further join is in it.
    """
    d = dedupe_appearances(details, order_by=order_by, keep=EDGE_PAYLOAD).select(
        "game_id", "player_id", "player_name", "team_abbreviation", "pts")
    greater = F.col("f1.player_id") > F.col("f2.player_id")
    sizes = details.groupBy("game_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows)
    if sizes.isEmpty():
        pairs = _met(d, ["game_id"], greater, ordered=True)
    else:
        cold = d.join(sizes, "game_id", "left_anti")
        pairs = _met(cold, ["game_id"], greater, ordered=True).unionByName(_block_pairs(d, sizes, block))
    agg = pairs.groupBy("s", "o", "edge_type").agg(
        F.max("sn").alias("subject_player_name"), F.max("on").alias("object_player_name"),
        F.count(F.lit(1)).alias("num_games"), F.sum("sp").alias("subject_points"),
        F.sum("op").alias("object_points"))
    return agg.select(
        F.col("s").cast("string").alias("subject_identifier"), F.lit("player").alias("subject_type"),
        F.col("o").cast("string").alias("object_identifier"), F.lit("player").alias("object_type"),
        "edge_type", *_columns([(c, F.col(c)) for c in ("num_games", "subject_points", "object_points")], typed))


def vertex_counts(vertices_df: DataFrame) -> DataFrame:
    """C17: vertices per type."""
    return vertices_df.groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def _join_subject(vertices_df: DataFrame, edges_df: DataFrame, fields: Sequence[tuple[str, str]]) -> DataFrame:
    """Vertices joined to the edges they are the subject of.

    Properties are read on the vertex side *before* the join (once per
    vertex instead of once per edge row; Catalyst does not push expressions
    below a join by itself), as ``v_<field>``.
    """
    v = vertices_df.select("identifier", "type", *[_property(vertices_df, f, kind).alias(f"v_{f}") for f, kind in fields]).alias("v")
    e = edges_df.alias("e")
    return v.join(e, (F.col("v.identifier") == F.col("e.subject_identifier"))
                  & (F.col("v.type") == F.col("e.subject_type")))


def max_edge_points(vertices_df: DataFrame, edges_df: DataFrame) -> DataFrame:
    """Best single-game points per player name, from edge properties.

    Every edge whose subject is the vertex takes part. The points are read
    and the maximum taken per subject before the join, so the join sees one
    row a subject; edges without a ``pts`` property contribute NULL.
    """
    best = edges_df.groupBy("subject_identifier", "subject_type").agg(F.max(_property(edges_df, "pts", "int")).alias("pts"))
    j = _join_subject(vertices_df, best, [("player_name", "string")])
    return j.groupBy(F.col("v_player_name").alias("player_name")).agg(F.max("pts").alias("max_points"))


def _pair_properties(edges_df: DataFrame, kind: str) -> DataFrame:
    """Player-to-player edges with the properties of a pair as ``kind``."""
    names = ("subject_points", "num_games")
    if names[0] in edges_df.columns:
        read = [F.col(n).cast(kind).alias(f"p_{n}") for n in names]
        return edges_df.where(F.col("object_type") == "player").select("subject_identifier", "subject_type", "object_identifier", *read)
    p = F.from_json("properties", ", ".join(f"{n} string" for n in names))  # parsed once a row
    rows = edges_df.where(F.col("object_type") == "player").withColumn("p", p)
    read = {n: F.col(f"p.{n}") if kind == "string" else F.nullif(F.col(f"p.{n}"), F.lit("")).try_cast(kind) for n in names}
    return rows.select("subject_identifier", "subject_type", "object_identifier", *[c.alias(f"p_{n}") for n, c in read.items()])


_PLAYER = [("player_name", "string"), ("number_of_games", "double"), ("total_points", "double")]


def games_per_point(vertices_df: DataFrame, edges_df: DataFrame) -> DataFrame:
    """The draft ratio games / points (0 points read as 1), kept as is."""
    j = _join_subject(vertices_df, _pair_properties(edges_df, "string"), _PLAYER)
    tp = F.col("v_total_points")
    return j.select(
        F.col("v_player_name").alias("player_name"),
        F.col("e.object_identifier").alias("object_identifier"),
        (F.coalesce("v_number_of_games", F.lit(0.0)) / F.when(tp == 0, F.lit(1.0)).otherwise(tp)).alias("games_per_point"),
        F.col("e.p_subject_points").alias("subject_points"), F.col("e.p_num_games").alias("num_games"))


def points_per_game(vertices_df: DataFrame, edges_df: DataFrame) -> DataFrame:
    """C20: points per game from typed properties; NULL-safe, zero-safe."""
    j = _join_subject(vertices_df, _pair_properties(edges_df, "double"), _PLAYER)
    ratio = F.try_divide(F.nullif(F.col("v_total_points"), F.lit(0.0)), F.col("v_number_of_games"))
    return j.select(
        F.col("v_player_name").alias("player_name"),
        F.col("e.object_identifier").alias("object_identifier"),
        F.coalesce(ratio, F.lit(0.0)).alias("points_per_game"),
        F.col("e.p_subject_points").alias("subject_points"), F.col("e.p_num_games").alias("num_games"))
