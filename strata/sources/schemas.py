"""State and output table schemas of the modelling workloads (DDL strings;
``StructType.fromDDL`` / ``spark.createDataFrame(..., schema)`` accept them).

What the reference declares as PRIMARY KEY / NOT NULL / ENUM / CHECK stands
in ``KEYS``, ``NOT_NULL``, ``DOMAINS`` and ``CHECKS``; ``REFERENCES`` names
the keys that edges point to. Parquet enforces none of them:
``strata.operators.constraints`` compiles them into an audit of the tables.
"""

# The reference's enum domains.
SCORING_CLASSES = ("star", "good", "average", "bad")
VERTEX_TYPES = ("player", "team", "game")
EDGE_TYPES = ("plays_against", "shares_team", "plays_in", "plays_on")

SEASON_STATS = "struct<season:int,gp:bigint,pts:double>"
FILM = "struct<film:string,votes:int,rating:double,filmid:bigint>"

SCHEMAS = {
    "players": f"player_id bigint, season_stats array<{SEASON_STATS}>, scoring_class string, "
               "years_since_last_season int, current_season int, is_active boolean",
    "players_scd": "player_id bigint, scoring_class string, is_active boolean, start_season int, "
                   "end_season int, current_season int",
    "actors": f"actorid bigint, actor string, as_of_year int, films array<{FILM}>, quality_class string, "
              "is_active boolean",
    "actors_history_scd": "actorid bigint, actor string, quality_class string, is_active boolean, "
                          "start_year int, end_year int, current_year int",
    "vertices": "identifier string, type string, properties string",
    "edges": "subject_identifier string, subject_type string, object_identifier string, object_type string, "
             "edge_type string, properties string",
    "users_cumulated": "user_id bigint, dates_active array<date>, curr_date date",
    "user_devices_cumulated": "user_id bigint, browser_type string, device_activity_datelist array<date>, "
                              "curr_date date",
    "hosts_cumulated": "host string, host_activity_datelist array<date>, curr_date date",
    "array_metrics": "user_id bigint, month_start date, metric_name string, metric_array array<bigint>",
    "host_activity_reduced": "host string, month date, hit_array array<bigint>, unique_visitors array<bigint>",
    "processed_events": "ip string, event_timestamp timestamp, referrer string, host string, url string, "
                        "geodata string",
    "processed_events_aggregated": "event_hour timestamp, host string, num_hits bigint",
    "processed_events_aggregated_source": "event_hour timestamp, host string, referrer string, num_hits bigint",
    "processed_events_sessionized": "session_start timestamp, session_end timestamp, ip string, host string, "
                                    "num_hits bigint",
}

# (key columns, period / partition column)
KEYS = {
    "players": (("player_id", "current_season"), "current_season"),
    "players_scd": (("player_id", "start_season"), "current_season"),
    "actors": (("actorid", "as_of_year"), "as_of_year"),
    "actors_history_scd": (("current_year", "actorid", "start_year"), "current_year"),
    "vertices": (("identifier", "type"), None),
    "edges": (("subject_identifier", "subject_type", "object_identifier", "object_type", "edge_type"), None),
    "users_cumulated": (("user_id", "curr_date"), "curr_date"),
    "user_devices_cumulated": (("user_id", "browser_type", "curr_date"), "curr_date"),
    "hosts_cumulated": (("host", "curr_date"), "curr_date"),
    "array_metrics": (("user_id", "month_start", "metric_name"), "month_start"),
    "host_activity_reduced": (("host", "month"), "month"),
}

DOMAINS = {
    ("players", "scoring_class"): SCORING_CLASSES,
    ("actors", "quality_class"): SCORING_CLASSES,
    ("vertices", "type"): VERTEX_TYPES,
    ("edges", "edge_type"): EDGE_TYPES,
    ("edges", "subject_type"): VERTEX_TYPES,
    ("edges", "object_type"): VERTEX_TYPES,
    ("players_scd", "scoring_class"): SCORING_CLASSES,
    ("actors_history_scd", "quality_class"): SCORING_CLASSES,
}

#: Columns outside the key that must not be null.
NOT_NULL = {
    "user_devices_cumulated": ("device_activity_datelist",),
    "hosts_cumulated": ("host_activity_datelist",),
    "host_activity_reduced": ("hit_array", "unique_visitors"),
}

#: Row conditions in SQL; a condition that is unknown holds.
CHECKS = {
    "players_scd": {"interval": "start_season <= end_season", "as_of": "end_season <= current_season"},
    "actors_history_scd": {"interval": "start_year <= end_year", "as_of": "end_year <= current_year"},
    "array_metrics": {"first_of_month": "month_start = trunc(month_start, 'MM')"},
    "host_activity_reduced": {
        "first_of_month": "month = trunc(month, 'MM')",
        "same_length": "coalesce(array_size(hit_array), 0) = coalesce(array_size(unique_visitors), 0)",
    },
}

#: table: {name: (columns, table referred to)}; the columns match its key.
REFERENCES = {
    "edges": {
        "subject": (("subject_identifier", "subject_type"), "vertices"),
        "object": (("object_identifier", "object_type"), "vertices"),
    },
}
