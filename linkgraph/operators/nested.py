"""Nested-input flattening (N1-N5) and last-write-wins lookups.

The reference flattens nested event JSON with Python loops; here the same
shapes are read with an explicit schema and flattened with ``explode`` /
struct field access, so the work stays in the JVM and scales with partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkgraph.functions import expressions as X

# --- fixed values: nested input schemas ------------------------------------
# One "lineup" value: team -> team id/name and its players (IDs as BIGINT so
# large key spaces do not overflow).
LINEUP_SCHEMA = ("MAP<STRING, STRUCT<team_id: BIGINT, team_name: STRING, lineup: ARRAY<STRUCT<"
                 "player_id: BIGINT, player_name: STRING, country: STRUCT<name: STRING>>>>>")
# The parts of an event that name players: a substitute, and the players of a line-up.
EVENT_PLAYER_SCHEMA = ("substitution STRUCT<replacement: STRUCT<id: BIGINT, name: STRING>>, "
                       "tactics STRUCT<lineup: ARRAY<STRUCT<player: STRUCT<id: BIGINT, name: STRING>>>>")
CORRUPT_COLUMN = "_corrupt_record"
# ---------------------------------------------------------------------------


def flatten_lineup(df: DataFrame, map_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per player of every team in ``map_col``.

    Output: ``keep`` columns, team_id, team_name, player_id, player_name,
    country (``''`` when the player has no country).
    """
    keep = list(keep)
    teams = df.select(*keep, F.explode(F.map_values(F.col(map_col))).alias("__team__"))
    players = teams.select(*keep, F.col("__team__.team_id").alias("team_id"),
                           F.col("__team__.team_name").alias("team_name"),
                           F.explode(F.col("__team__.lineup")).alias("__p__"))
    return players.select(*keep, "team_id", "team_name",
                          F.col("__p__.player_id").alias("player_id"),
                          F.col("__p__.player_name").alias("player_name"),
                          F.coalesce(F.col("__p__.country.name"), F.lit("")).alias("country"))


def extract_fields(df: DataFrame, json_col: str, schema: str, fields: Mapping[str, str],
                   keep: Sequence[str] = ()) -> DataFrame:
    """Parse ``json_col`` with ``schema`` and pull dotted paths into flat columns.

    A missing parent (``pass`` absent) gives NULL, not an error.
    """
    parsed = df.select(*keep, F.from_json(F.col(json_col), schema).alias("__j__"))
    return parsed.select(*keep, *[F.col(f"__j__.{path}").alias(name) for name, path in fields.items()])


def parse_with_rejects(df: DataFrame, json_col: str, schema: str,
                       keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Parse JSON text permissively and split into (parsed rows, rejected rows).

    A malformed record does not fail the job: it lands in the rejected table
    with its raw text, every other record continues (one pass, no driver work).
    """
    with_corrupt = f"{schema}, {CORRUPT_COLUMN} STRING"
    parsed = df.select(*keep, F.col(json_col),
                       F.from_json(F.col(json_col), with_corrupt,
                                   {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN})
                       .alias("__j__"))
    bad = F.col(f"__j__.{CORRUPT_COLUMN}").isNotNull() | (F.col(json_col).isNotNull() & F.col("__j__").isNull())
    field_names = T.DataType.fromDDL(schema).fieldNames()
    good = parsed.where(~bad | F.col(json_col).isNull()).select(
        *keep, *[F.col(f"__j__.{n}").alias(n) for n in field_names])
    rejected = parsed.where(bad & F.col(json_col).isNotNull()).select(*keep, F.col(json_col).alias(CORRUPT_COLUMN))
    return good, rejected


def event_players(df: DataFrame, json_col: str, scope: Sequence[str], position: str) -> list[DataFrame]:
    """The players named in nested events, as the two sources of ``lookup_last_wins`` in write order.

    First the substitutes, then the line-ups (one row per player).  Columns:
    ``scope``, name, id, position (the event's ``position``, then the place in the
    line-up).  Events of other kinds give no rows.
    """
    scope = list(scope)
    ev = df.select(*scope, position, F.from_json(F.col(json_col), EVENT_PLAYER_SCHEMA).alias("__e__"))

    def rows(player: str, place) -> list:
        return [*scope, F.col(f"{player}.name").alias("name"), F.col(f"{player}.id").alias("id"),
                F.struct(F.col(position).alias("event"), place.alias("place")).alias("position")]

    subs = (ev.where(F.col("__e__.substitution.replacement").isNotNull())
              .select(*rows("__e__.substitution.replacement", F.lit(0))))
    lineups = (ev.select(*scope, position, F.posexplode("__e__.tactics.lineup").alias("__at__", "__p__"))
                 .select(*rows("__p__.player", F.col("__at__"))))
    return [subs, lineups]


def lookup_last_wins(sources: Sequence[DataFrame], scope: Sequence[str], name: str, value: str,
                     position: str) -> DataFrame:
    """Name -> value dictionary per scope where a later entry overwrites an earlier one.

    ``sources`` are in write order (later source wins); inside a source the
    larger ``position`` wins, then the larger value (deterministic on ties).  Each task hands on
    its last entry per name: no group is gathered into one task.
    """
    scope = list(scope)
    ranked = None
    for rank, src in enumerate(sources):
        part = src.select(*scope, name, value, position).withColumn("__rank__", F.lit(rank))
        ranked = part if ranked is None else ranked.unionByName(part)
    ranked = ranked.where(F.col(name).isNotNull())
    return X.survivors(ranked, [*scope, name], ["__rank__", position, value], last=True).select(*scope, name, value)
