"""The seven topics, in an order that satisfies their lookups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column

from hitloom.functions.scalars import (
    clean_duration,
    clock_time,
    date_range_bounds,
    hash_key,
    joined_key,
    load_timestamp,
    point_coordinates,
    rounded_int,
    to_int,
    url,
)
from hitloom.operators.columns import constant, flat
from hitloom.plans import contract as c
from hitloom.plans.spec import (
    LookupSpec,
    TopicSpec,
    derive,
    derive_per_record,
    drop,
    rename,
    select,
)


def _period_bounds() -> Mapping[str, Column]:
    start, end = date_range_bounds(flat("_source.periods.date_range"))
    return {"date_range_from": start, "date_range_to": end}


def _grant_columns() -> Mapping[str, Column]:
    # The id becomes an integer first, so that a float id leaves no ".0" in the link.
    nhle_id = to_int(flat("_source.nhle_id"))
    return {
        "_source.nhle_id": nhle_id,
        "ExternalLinkUrl": url(c.MAP_SEARCH_URL, nhle_id),
        "isHidden": constant(c.NOT_HIDDEN),
    }


def _record_area_key() -> Mapping[str, Column]:
    return {"ConcatenatedId": joined_key(flat("_id"), flat("_source.area_id"))}


def _point_columns() -> Mapping[str, Column]:
    longitude, latitude = point_coordinates(flat("_source.geometry"))
    return {"longitude": longitude, "latitude": latitude, "hashkey": hash_key(flat("_id"))}


def _media_columns() -> Mapping[str, Column]:
    seconds = rounded_int(clean_duration(flat("_source.duration")))
    return {
        "RoundedDuration": seconds,
        "ExternalAssetEmbed": constant(c.EMBED_FILLER),
        "IsHidden": constant(c.NOT_HIDDEN),
        "DurationConverted": clock_time(seconds),
    }


def _mention_columns() -> Mapping[str, Column]:
    return {
        "URLAnchorCombined": joined_key(flat("_id"), flat("_source.mentions.anchor")),
        "CreatedOn": load_timestamp(),
    }


#: Names in the stories' rename that are no fields of a record.
_MADE_FOR_STORIES = ("RoundedDuration",)

AREAS = TopicSpec(
    name="areas",
    names=(*c.AREAS_DROP, *c.AREAS_RENAME),
    row_steps=(drop(c.AREAS_DROP), rename(c.AREAS_RENAME)),
)

AREA_BY_NUMBERS = TopicSpec(
    name="area-by-numbers",
    names=(*c.AREA_BY_NUMBERS_RENAME,),
    lookups=(LookupSpec("areas", left_key="_source.area_id", right_key="Id", take={"sort": "AreaId"}),),
    row_steps=(
        derive(_period_bounds),
        rename(c.AREA_BY_NUMBERS_RENAME),
        select((*c.AREA_BY_NUMBERS_RENAME.values(), *c.AREA_BY_NUMBERS_ADDED)),
    ),
    reads=tuple(c.AREA_BY_NUMBERS_RENAME),
)

GRANT_AIDED_PLACES = TopicSpec(
    name="grant-aided-places",
    names=(*c.GRANT_AIDED_PLACES_DROP, *c.GRANT_AIDED_PLACES_RENAME),
    record_steps=(derive_per_record(["_source.nhle_id"], _grant_columns),),
    row_steps=(
        drop(c.GRANT_AIDED_PLACES_DROP),
        derive(_record_area_key),
        rename(c.GRANT_AIDED_PLACES_RENAME),
    ),
)

HISTORIC_PLACES = TopicSpec(
    name="historic-places",
    names=(*c.HISTORIC_PLACES_DROP, *c.HISTORIC_PLACES_RENAME),
    record_steps=(
        derive_per_record(["_id"], lambda: {"ExternalLinkUrl": url(c.LIST_ENTRY_URL, flat("_id"))}),
    ),
    row_steps=(
        derive(_record_area_key),
        drop(c.HISTORIC_PLACES_DROP),
        rename(c.HISTORIC_PLACES_RENAME),
        # Last: the link and the key above use the id as text.
        derive(lambda: {"Id": to_int(flat("Id"))}),
    ),
)

IMAGES = TopicSpec(
    name="images",
    names=(*c.IMAGES_DROP, *c.IMAGES_RENAME),
    row_steps=(drop(c.IMAGES_DROP), rename(c.IMAGES_RENAME)),
)

PLACE_NAMES = TopicSpec(
    name="place-names",
    names=(*c.PLACE_NAMES_DROP, *c.PLACE_NAMES_RENAME),
    record_steps=(derive_per_record(["_id", "_source.geometry"], _point_columns),),
    row_steps=(drop(c.PLACE_NAMES_DROP), rename(c.PLACE_NAMES_RENAME)),
)

STORIES = TopicSpec(
    name="stories",
    names=(*c.STORIES_DROP, *(n for n in c.STORIES_RENAME if n not in _MADE_FOR_STORIES)),
    record_steps=(derive_per_record(["_source.duration"], _media_columns),),
    row_steps=(
        derive(_mention_columns),
        drop(c.STORIES_DROP),
        rename(c.STORIES_RENAME),
    ),
)

TOPICS: Mapping[str, TopicSpec] = {
    spec.name: spec
    for spec in (
        AREAS,
        AREA_BY_NUMBERS,
        GRANT_AIDED_PLACES,
        HISTORIC_PLACES,
        IMAGES,
        PLACE_NAMES,
        STORIES,
    )
}
