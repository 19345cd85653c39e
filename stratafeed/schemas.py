"""Table specifications and the schemas of the match feed."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


def _fields(dtype: T.DataType, *names: str, required: bool = False):
    return [T.StructField(name, dtype, not required) for name in names]


_INT, _TEXT, _FLAG = T.IntegerType(), T.StringType(), T.BooleanType()
_FLOAT, _DOUBLE, _LONG = T.FloatType(), T.DoubleType(), T.LongType()

# Column names, order, types and required fields of the feed.
MATCH_SCHEMA = T.StructType(
    [
        *_fields(_INT, "GameId", "RoundId", "Season", "SeasonType", required=True),
        *_fields(_TEXT, "Group"),
        *_fields(_INT, "TeamAId", "TeamBId", "VenueId"),
        *_fields(_TEXT, "Day", "DateTime", "Status"),
        *_fields(_INT, "Week"),
        *_fields(_TEXT, "BestOf", "Winner", "VenueType", "TeamAKey", "TeamAName"),
        *_fields(_INT, "TeamAScore"),
        *_fields(_TEXT, "TeamBKey", "TeamBName"),
        *_fields(_INT, "TeamBScore"),
        *_fields(_INT, "TeamAMoneyLine", "TeamBMoneyLine", "DrawMoneyLine"),
        *_fields(T.DecimalType(10, 2), "PointSpread"),
        *_fields(_INT, "TeamAPointSpreadPayout", "TeamBPointSpreadPayout"),
        *_fields(_TEXT, "Updated", "UpdatedUtc"),
        *_fields(_FLAG, "IsClosed"),
    ]
)

# A player's entry in the leaderboard of one map.
ENTRY_SCHEMA = T.StructType(
    [
        *_fields(_INT, "PlayerId", "TeamId", required=True),
        *_fields(_TEXT, "Name", "MatchName", "Team", required=True),
        *_fields(_FLAG, "IsClosed", required=True),
        *_fields(_INT, "GameId", "OpponentId", required=True),
        *_fields(_TEXT, "Opponent", required=True),
        *_fields(_TEXT, "Day", "DateTime", "Updated", "UpdatedUtc", "Games"),
        *_fields(_FLOAT, "Maps", "FantasyPoints", "Kills", "Assists", "Deaths"),
        *_fields(_FLOAT, "Headshots", "AverageDamagePerRound", "Kast", "Rating"),
        *_fields(_FLOAT, "EntryKills", "QuadKills", "Aces"),
        *_fields(_FLOAT, "Clutch1v2s", "Clutch1v3s", "Clutch1v4s", "Clutch1v5s"),
    ]
)

LEADERBOARD_SCHEMA = T.StructType(
    [*ENTRY_SCHEMA, *_fields(_TEXT, "MapName", required=True)]
)

# One map of a match, and the attributes it takes from the match.
MAP_FIELDS = T.StructType(
    [
        *_fields(_INT, "Number"),
        *_fields(_TEXT, "Name", "Status"),
        *_fields(_INT, "CurrentRound", "TeamAScore", "TeamBScore"),
    ]
)
GAME_SCHEMA = T.StructType(
    [
        *_fields(_INT, "GameId", required=True),
        *_fields(_TEXT, "TeamAName", "TeamBName", "TeamAKey", "TeamBKey"),
    ]
)

MAP_SCHEMA = T.StructType([*MAP_FIELDS, *GAME_SCHEMA])

PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("Game", GAME_SCHEMA),
        T.StructField(
            "Maps",
            T.ArrayType(
                T.StructType(
                    [
                        *MAP_FIELDS,
                        T.StructField("Leaderboards", T.ArrayType(ENTRY_SCHEMA)),
                    ]
                )
            ),
        ),
    ]
)


@dataclass(frozen=True)
class TableSpec:
    """How one keyed table is cleaned, deduplicated and merged.

    * ``schema``: declared input schema; its non-null fields are required.
    * ``keys``: one row is kept for each.
    * ``version``: column by which a newer row replaces an older one; None means
      that the last batch wins.
    * ``tie_break``: decides between rows of one batch with equal versions (or
      without a version); None takes all remaining columns.
    * ``gate``: boolean column that must be true; null counts as false.
    * ``iso_columns``: text columns stored as timestamps.
    * ``complete_keys``: a row with a null in its key is rejected; otherwise nulls
      are a key of their own.
    """

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    version: str | None = None
    tie_break: tuple[str, ...] | None = None
    gate: str | None = None
    iso_columns: tuple[str, ...] = field(default=())
    keep_fraction: bool = False
    complete_keys: bool = False

    @property
    def required(self) -> list[str]:
        """Columns without which a row is rejected."""
        keys = self.keys if self.complete_keys else ()
        return [f.name for f in self.schema if not f.nullable or f.name in keys]

    @property
    def stored_schema(self) -> T.StructType:
        """Schema at rest: nullable, as file readers report it."""
        return T.StructType(
            [
                T.StructField(
                    f.name,
                    T.TimestampNTZType() if f.name in self.iso_columns else f.dataType,
                )
                for f in self.schema
            ]
        )


# Keys, versions and text timestamps of the bronze tables.
ISO_COLUMNS = ("Day", "DateTime", "Updated", "UpdatedUtc")

MATCHES = TableSpec(
    name="match_history",
    schema=MATCH_SCHEMA,
    keys=("GameId",),
    version="UpdatedUtc",
    gate="IsClosed",
    iso_columns=ISO_COLUMNS,
)
LEADERBOARDS = TableSpec(
    name="tb_leaderboards",
    schema=LEADERBOARD_SCHEMA,
    keys=("PlayerId", "GameId", "MapName"),
    version="UpdatedUtc",
    iso_columns=ISO_COLUMNS,
)
MAPS = TableSpec(
    name="tb_maps",
    schema=MAP_SCHEMA,
    keys=("Number", "GameId"),
    complete_keys=True,
    tie_break=(
        "CurrentRound",
        "TeamAScore",
        "TeamBScore",
        "Name",
        "Status",
        "TeamAName",
        "TeamBName",
        "TeamAKey",
        "TeamBKey",
    ),
)

# Output columns and keys of the silver tables.
PLAYERS = TableSpec(
    name="fs_players",
    schema=T.StructType(
        [
            *_fields(_INT, "PlayerId"),
            *_fields(_TEXT, "MatchName"),
            *_fields(_LONG, "qtGames"),
            *_fields(T.TimestampNTZType(), "firstMatch", "lastMatch"),
            *_fields(_DOUBLE, "avgPoints", "avgKills", "avgAssists", "avgDeaths"),
            *_fields(_DOUBLE, "avgHeadshots", "avgAverageDamagePerRound"),
            *_fields(_DOUBLE, "avgKast", "avgRating"),
        ]
    ),
    keys=("PlayerId", "MatchName"),
)
TEAMS = TableSpec(
    name="fs_teams",
    schema=T.StructType(
        [*_fields(_TEXT, "TeamName", "MapName"), *_fields(_LONG, "matchCount")]
    ),
    keys=("TeamName", "MapName"),
)

# Mean column of the player table -> measure it averages.
PLAYER_MEANS = {
    "avgPoints": "FantasyPoints",
    "avgKills": "Kills",
    "avgAssists": "Assists",
    "avgDeaths": "Deaths",
    "avgHeadshots": "Headshots",
    "avgAverageDamagePerRound": "AverageDamagePerRound",
    "avgKast": "Kast",
    "avgRating": "Rating",
}
