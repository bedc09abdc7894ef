"""Names, constants, patterns and formats the output must equal.

Nothing here is logic. Renames are in source order; a name that a record set
does not have is simply not renamed.
"""

# --- layers -----------------------------------------------------------------
BRONZE, SILVER, GOLD = "bronze", "silver", "gold"
REJECTS = "rejects"
REPORT = "report"

# --- patterns and separators --------------------------------------------------
DATE_RANGE_SEPARATOR = " to "
BEFORE_PATTERN = "%Before%"
POINT_PATTERN = r"POINT \((-?\d+\.\d+) (-?\d+\.\d+)\)"

# --- constant column values ---------------------------------------------------
NOT_HIDDEN = "False"
EMBED_FILLER = "filler"
LIST_ENTRY_URL = "https://historicengland.org.uk/listing/the-list/list-entry/"
MAP_SEARCH_URL = "https://historicengland.org.uk/listing/the-list/map-search?clearresults=True&postcode="

# --- areas --------------------------------------------------------------------
AREAS_DROP = (
    "_ignored",
    "_source.hierarchy_children",
    "_source.hierarchy_parents",
    "_source.in_scope",
    "_source.scope_note",
    "_source.view_more_url",
)
AREAS_RENAME = {
    "_id": "Id",
    "_index": "Index",
    "_score": "Score",
    "sort": "Sort",
    "_source.name": "Title",
    "_source.kind": "Kind",
    "_source.active": "Active",
    "_source.hierarchy_level": "HierarchyLevel",
    "_source.hierarchy_level_name": "HierarchyLevelName",
    "_source.description": "Description",
    "_source.header_image_id": "HeaderImageId",
    "_source.geometry": "geometry",
}

# --- area-by-numbers ------------------------------------------------------------
AREA_BY_NUMBERS_RENAME = {
    "_source.area_id": "AreaName",
    "_source.periods.name": "PeriodName",
    "_source.periods.date_range": "PeriodDateRange",
    "_source.periods.sort": "PeriodSort",
    "_source.periods.description": "PeriodDescription",
    "_source.periods.description_source": "PeriodDescription_source",
    "_source.periods.description_source_url": "PeriodDescription_source_url",
    "_source.periods.examples.nhle_id": "nhleId",
    "_source.periods.examples.name": "nhleName",
    "_source.periods.examples.image_id": "nhleImageId",
    "_source.periods.examples.priority": "nhlePriority",
    "_source.periods.examples.summary_text": "nhleSummaryText",
    "_source.periods.examples.url": "nhleUrl",
}
AREA_BY_NUMBERS_ADDED = ("date_range_from", "date_range_to", "AreaId")

# --- grant-aided-places -----------------------------------------------------------
GRANT_AIDED_PLACES_DROP = ("_ignored",)
GRANT_AIDED_PLACES_RENAME = {
    "_id": "Id",
    "_index": "Index",
    "_score": "Score",
    "sort": "Sort",
    "_source.status": "Status",
    "_source.url": "Url",
    "_source.nhle_id": "NHLE_UID",
    "_source.name": "Title",
    "_source.is_listed": "IsListed",
    "_source.map_view_url": "ExternalMapLinkUrl",
    "_source.priority": "Priority",
    "_source.area_id": "AreaId",
    "_source.description": "Description",
    "_source.image_id": "ThumbnailImageId",
    "_source.geometry": "geometry",
}

# --- historic-places ----------------------------------------------------------------
HISTORIC_PLACES_DROP = ("_ignored", "_source.display_in_highlights")
HISTORIC_PLACES_RENAME = {
    "_id": "Id",
    "_index": "Index",
    "_score": "Score",
    "sort": "Sort",
    "_source.name": "Title",
    "_source.heritage_category": "HeritageCategory",
    "_source.grade": "Grade",
    "_source.summary_text": "Description",
    "_source.image_id": "ThumbnailImageId",
    "_source.locality": "Locality",
    "_source.priority": "Priority",
    "_source.area_id": "area_id",
    "_source.identifying_location": "identifying_location",
    "_source.geometry": "geometry",
}

# --- images -------------------------------------------------------------------------
IMAGES_DROP = ("_ignored", "_source.image_id")
IMAGES_RENAME = {
    "sort": "sort",
    "_index": "index",
    "_id": "id",
    "_score": "score",
    "_source.created_date": "created_date",
    "_source.description": "description",
    "_source.url": "url",
    "_source.source": "source",
    "_source.copyright_statement": "copyright_statement",
    "_source.find_out_more_url": "find_out_more_url",
    "_source.sized_url.920x450": "sized_url_920x450",
    "_source.sized_url.759x569": "sized_url_759x569",
    "_source.sized_url.373x240": "sized_url_373x240",
    "_source.sized_url.868x560": "sized_url_868x560",
    "_source.sized_url.375x250": "sized_url_375x250",
    "_source.sized_url.700x400": "sized_url_700x400",
    "_source.sized_url.868x450": "sized_url_868x450",
}

# --- place-names ----------------------------------------------------------------------
PLACE_NAMES_DROP = ("_ignored", "_source.area_id")
PLACE_NAMES_RENAME = {
    "_id": "Id",
    "_index": "Index",
    "_score": "Score",
    "_source._type": "Type",
    "_source._type_name": "TypeName",
    "_source.geometry": "Geometry",
    "_source.name": "Name",
    "_source.name_alt": "NameAlt",
    "_source.name_country": "NameCountry",
    "_source.name_county": "NameCounty",
    "_source.name_county_1961": "NameCounty1961",
    "_source.name_county_1991": "NameCounty1991",
    "_source.name_county_historic": "NameCountyHistoric",
    "_source.name_district": "NameDistrict",
    "_source.name_district_1961": "NameDistrict1961",
    "_source.name_district_1991": "NameDistrict1991",
    "_source.name_national_park": "NameNationalPark",
    "_source.name_region": "NameRegion",
    "_source.place_id": "PlaceId",
    "sort": "Sort",
}

# --- stories --------------------------------------------------------------------------
STORIES_DROP = (
    "_ignored",
    "_source.mentions._type",
    "anchor",
    "_source.duration",
    "_source.mentions.anchor",
)
STORIES_RENAME = {
    "_id": "Id",
    "_index": "Index",
    "_score": "Score",
    "_source._type": "Type",
    "_source.description": "Description",
    "_source.url": "ExternalAssetSourceUrl",
    "_source.image_id": "ThumbnailImageId",
    "_source.mentions.name": "MentionedLocationText",
    "_source.featured": "Featured",
    "sort": "Sort",
    "_source.mentions.area_id": "AreaId",
    "_source.title": "Title",
    "_source.mentions.url": "ExternalLinkUrl",
    "RoundedDuration": "MediaDuration",
}
