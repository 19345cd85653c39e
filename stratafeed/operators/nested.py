"""Nested payloads to flat rows, with ``explode`` only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a map row takes from its match.
GAME_FIELDS = ("GameId", "TeamAName", "TeamBName", "TeamAKey", "TeamBKey")
#: Kinds of the rows of ``flatten_details``, and the columns that hold them.
MAP, ENTRY = "map", "entry"


def explode_children(
    df: DataFrame,
    array: str,
    parent: Mapping[str, str],
    fields: Sequence[str] | None = None,
) -> DataFrame:
    """One row per array element: its fields plus columns of the parent.

    ``array`` and the values of ``parent`` (output name -> path) may be dotted
    paths. ``fields`` defaults to the fields of the element that are not arrays
    themselves. A parent whose array is empty or null gives no row.
    """
    element = df.select(array).schema[0].dataType.elementType
    if fields is None:
        fields = [
            f.name for f in element if not isinstance(f.dataType, T.ArrayType)
        ]
    children = F.col(array)
    if set(fields) != set(element.names):
        # Taking the wanted fields out before the explode, not after it, lets the
        # scan leave the others (such as arrays further down) unread.
        children = F.arrays_zip(*[children.getField(f).alias(f) for f in fields])
    child = "__child"
    exploded = df.select(
        *[F.col(path).alias(name) for name, path in parent.items()],
        F.explode(children).alias(child),
    )
    return exploded.select(
        *[F.col(child).getField(f).alias(f) for f in fields], *parent
    )


def flatten_details(payloads: DataFrame) -> DataFrame:
    """Map rows and player rows of every payload in one pass over it.

    Each row is a map or a player's entry, told apart by ``kind``: ``map`` holds what
    ``flatten_maps`` gives and is null for entries, ``entry`` what
    ``flatten_leaderboards`` gives and is null for maps. Written by ``kind``, each
    folder can be read as a table of its own.
    """
    element = payloads.select("Maps").schema[0].dataType.elementType
    own = [f.name for f in element if not isinstance(f.dataType, T.ArrayType)]
    entry_type = element["Leaderboards"].dataType.elementType
    m, slot, entry = F.col("__map"), "__slot", "__entry"
    maps = payloads.select(
        *[F.col(f"Game.{n}").alias(n) for n in GAME_FIELDS], F.explode("Maps").alias("__map")
    )
    # The first slot of a map is the map itself, the others are its entries. Lambdas over
    # the arrays would be interpreted, row by row; generators are compiled.
    first = F.array(F.lit(None).cast(entry_type))
    slots = F.concat(first, F.coalesce(m.getField("Leaderboards"), F.array()))
    of_map = F.struct(*[m.getField(f).alias(f) for f in own], *GAME_FIELDS)
    rows = maps.select(of_map.alias(MAP), slots.alias("__slots")).select(
        MAP, F.posexplode("__slots").alias(slot, entry)
    )
    is_map = F.col(slot) == 0
    fields = [F.col(entry).getField(f.name).alias(f.name) for f in entry_type]
    of_entry = F.struct(*fields, F.col(MAP).getField("Name").alias("MapName"))
    return rows.select(
        F.when(is_map, F.lit(MAP)).otherwise(F.lit(ENTRY)).alias("kind"),
        F.when(is_map, F.col(MAP)).alias(MAP),
        F.when(~is_map, of_entry).alias(ENTRY),
    )


def flatten_maps(payloads: DataFrame) -> DataFrame:
    """Map rows with the attributes of their match."""
    return explode_children(payloads, "Maps", {name: f"Game.{name}" for name in GAME_FIELDS})


def flatten_leaderboards(payloads: DataFrame) -> DataFrame:
    """Player rows of every map of every match, with the name of the map."""
    maps = explode_children(payloads, "Maps", {}, ["Name", "Leaderboards"])
    return explode_children(maps, "Leaderboards", {"MapName": "Name"})
