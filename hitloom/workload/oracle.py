"""The same results as flat SQL for DuckDB.

Nothing here nests or unnests what a query nests and explodes, apart from
splitting texts: arrays of bounded length are joins to a list of positions.
"""

from hitloom.plans.contract import LIST_ENTRY_URL, MAP_SEARCH_URL

# Array positions 1 and 2; ON i <= n with a LEFT JOIN is an outer explode.
_TWO = "(VALUES (1), (2))"

_WKT = """CASE o_orderkey % 6
    WHEN 0 THEN 'POINT (-' || (o_orderkey % 180) || '.' || (10 + o_custkey % 90) || ' ' || (o_custkey % 90) || '.5)'
    WHEN 1 THEN 'POINT (' || (o_orderkey % 180) || '.25 -' || (o_custkey % 90) || '.75)'
    WHEN 2 THEN 'near POINT (' || (o_orderkey % 180) || '.0 ' || (o_custkey % 90) || '.0) there'
    WHEN 3 THEN 'POINT (' || (o_orderkey % 180) || ' ' || (o_custkey % 90) || ')'
    WHEN 4 THEN 'POINT(' || (o_orderkey % 180) || '.0 ' || (o_custkey % 90) || '.0)'
    ELSE NULL END"""


def _coordinate(wkt: str, group: int) -> str:
    return rf"regexp_extract({wkt}, 'POINT \((-?\d+\.\d+) (-?\d+\.\d+)\)', {group})"


def _hms(seconds: str) -> str:
    return f"strftime(make_timestamp(CAST({seconds} AS BIGINT) * 1000000), '%H:%M:%S')"


_DOCUMENT_WORDS = """
    SELECT doc_id, lang, source, line_number, length(line) AS line_chars,
           unnest(string_split(line, ' ')) AS word
    FROM (
        SELECT doc_id, lang, source, unnest(lines) AS line,
               unnest(range(1, len(lines) + 1)) AS line_number
        FROM (SELECT *, string_split(text, chr(10)) AS lines FROM documents)
    )"""

_ORDER_HITS = """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, 'orders' AS index_name, CAST(NULL AS DOUBLE) AS score,
           o_orderkey AS sort, o_custkey AS customer,
           o_orderstatus AS status, o_totalprice AS total, o_orderpriority AS priority
    FROM orders"""

_ALL_DOCUMENT_WORDS = f"""
    SELECT CAST(doc_id AS VARCHAR) AS id, 'documents' AS index_name, CAST(NULL AS DOUBLE) AS score,
           doc_id AS sort, lang, source, line_number, line_chars, word
    FROM ({_DOCUMENT_WORDS})"""

# One row per area and child, at least one per area.
_AREAS = f"""
    SELECT 'C' || c_custkey AS Id, 'areas' AS "Index", CAST(NULL AS DOUBLE) AS Score, c_custkey AS Sort,
           c_name AS Title, c_mktsegment AS Kind, c_acctbal > 0 AS Active,
           CAST(c_nationkey AS BIGINT) AS HierarchyLevel, 'Level ' || c_nationkey AS HierarchyLevelName,
           CASE WHEN c_custkey % 9 <> 0 THEN c_name || ' of ' || c_mktsegment END AS Description,
           'img-' || c_custkey AS HeaderImageId,
           'POINT (' || (c_custkey % 180) || '.5 ' || (c_custkey % 90) || '.25)' AS geometry
    FROM customer JOIN {_TWO} child(i) ON i <= greatest(1, c_custkey % 3)"""

_AREA_BY_NUMBERS = f"""
    WITH hits AS (
        SELECT *, CASE WHEN o_orderkey % 11 = 0 THEN NULL
                       WHEN o_orderkey % 13 = 0 THEN 'X' || o_custkey
                       ELSE 'C' || o_custkey END AS AreaName
        FROM orders
    ), periods AS (
        SELECT hits.*, p.i, CASE
                WHEN p.i = 2 THEN 'Year to ' || year(o_orderdate)
                WHEN p.i = 1 AND o_orderkey % 4 = 0
                    THEN (1000 + o_orderkey % 500) || ' to ' || (1500 + o_orderkey % 500)
                WHEN p.i = 1 AND o_orderkey % 4 = 1 THEN 'Before ' || o_orderkey
                WHEN p.i = 1 AND o_orderkey % 4 = 2 THEN CAST(o_orderkey AS VARCHAR) END AS written
        FROM hits LEFT JOIN {_TWO} p(i) ON p.i <= o_orderkey % 3
    ), examples AS (
        SELECT periods.*, e.j
        FROM periods LEFT JOIN {_TWO} e(j)
          ON e.j <= CASE periods.i WHEN 1 THEN o_orderkey % 3 WHEN 2 THEN o_custkey % 3 ELSE 0 END
    ), areas AS (
        SELECT 'C' || c_custkey AS Id, c_custkey AS Sort
        FROM customer JOIN {_TWO} child(i) ON i <= greatest(1, c_custkey % 3)
    )
    SELECT AreaName,
           CASE WHEN i IS NOT NULL THEN 'Period ' || i END AS PeriodName,
           written AS PeriodDateRange,
           CAST(i AS BIGINT) AS PeriodSort,
           CASE WHEN i IS NOT NULL THEN o_orderstatus || ' ' || i END AS PeriodDescription,
           CASE WHEN i IS NOT NULL THEN o_orderpriority END AS PeriodDescription_source,
           CASE WHEN i IS NOT NULL THEN 'https://sources.example/' || o_orderkey END AS PeriodDescription_source_url,
           CASE WHEN j IS NOT NULL THEN o_orderkey || '-' || j END AS nhleId,
           CASE WHEN j IS NOT NULL THEN 'Example ' || j END AS nhleName,
           CASE WHEN j IS NOT NULL THEN 'img-' || o_orderkey END AS nhleImageId,
           CAST(j AS BIGINT) AS nhlePriority,
           CASE WHEN j IS NOT NULL THEN o_orderpriority END AS nhleSummaryText,
           CASE WHEN j IS NOT NULL THEN 'https://examples.example/' || o_orderkey END AS nhleUrl,
           CASE WHEN i = 2 THEN 'Year'
                WHEN i = 1 AND o_orderkey % 4 = 0 THEN CAST(1000 + o_orderkey % 500 AS VARCHAR)
                WHEN i = 1 AND o_orderkey % 4 = 2 THEN CAST(o_orderkey AS VARCHAR) END AS date_range_from,
           CASE WHEN i = 2 THEN CAST(year(o_orderdate) AS VARCHAR)
                WHEN i = 1 AND o_orderkey % 4 = 0 THEN CAST(1500 + o_orderkey % 500 AS VARCHAR)
                WHEN i = 1 AND o_orderkey % 4 = 1 THEN 'Before ' || o_orderkey END AS date_range_to,
           areas.Sort AS AreaId
    FROM examples LEFT JOIN areas ON AreaName = areas.Id"""

_HISTORIC_ID = "CASE WHEN l_orderkey % 10 = 0 THEN 'H' || l_orderkey ELSE CAST(l_orderkey AS VARCHAR) END"
_HISTORIC_AREA = "CASE WHEN i = 2 THEN 'C0' ELSE 'C' || l_suppkey END"

_SIZES = ",\n".join(
    f"CASE WHEN page_id % 8 <> 0 THEN url || '#{size}' END AS sized_url_{size}"
    for size in ("920x450", "759x569", "373x240", "868x560", "375x250", "700x400", "868x450")
)

_PLACE_COLUMNS = ",\n".join(
    f"'{field} ' || (o_orderkey % {n}) AS {column}"
    for n, (field, column) in enumerate(
        (
            ("name_alt", "NameAlt"),
            ("name_country", "NameCountry"),
            ("name_county", "NameCounty"),
            ("name_county_1961", "NameCounty1961"),
            ("name_county_1991", "NameCounty1991"),
            ("name_county_historic", "NameCountyHistoric"),
            ("name_district", "NameDistrict"),
            ("name_district_1961", "NameDistrict1961"),
            ("name_district_1991", "NameDistrict1991"),
            ("name_national_park", "NameNationalPark"),
            ("name_region", "NameRegion"),
        ),
        start=2,
    )
)

# The rows of area-by-numbers without their areas.
_AREA_BY_NUMBERS_ROWS = _AREA_BY_NUMBERS.replace("areas.Sort", "NULL").replace(
    "LEFT JOIN areas ON AreaName = areas.Id", ""
)

# A row per line of a document; each has as many rows as words (one at least) times numbers (one at least).
_SIBLINGS = """
    texts AS (
        SELECT lang, string_split(text, chr(10)) AS ls, len(string_split(text, chr(10))) % 7 AS n FROM documents
    ), lines AS (
        SELECT lang, n, unnest(ls) AS l, unnest(range(1, len(ls) + 1)) AS line FROM texts
    ), siblings AS (
        SELECT lang, line, n, length(l) AS n_chars, len(list_filter(string_split(l, ' '), lambda x: x <> '')) AS n_words,
               greatest(len(list_filter(string_split(l, ' '), lambda x: x <> '')), 1) AS words,
               list_min(list_filter(string_split(l, ' '), lambda x: x <> '')) AS first_word,
               greatest(len(list_filter(string_split(l, ' '), lambda x: x <> '')), 1) * greatest(n, 1) AS n_rows
        FROM lines
    )"""

_FACTS = ", ".join(
    f"CAST(CASE WHEN o_orderkey % 4 > 1 AND o_orderpriority = '{key}' THEN o_custkey END AS BIGINT) AS \"{name}\""
    for key, name in (
        ("1-URGENT", "1_urgent"),
        ("2-HIGH", "2_high"),
        ("3-MEDIUM", "3_medium"),
        ("4-NOT SPECIFIED", "4_not_specified"),
        ("5-LOW", "5_low"),
    )
)

ORACLE_SQL: dict[str, str] = {
    "flatten_structs": """
        SELECT l_orderkey, l_linenumber,
               CASE WHEN l_linenumber % 5 <> 0 THEN l_quantity END AS quantity,
               CASE WHEN l_linenumber % 5 <> 0 THEN l_extendedprice END AS extended,
               CASE WHEN l_linenumber % 5 <> 0 THEN l_discount END AS discount,
               CASE WHEN l_linenumber % 5 <> 0 THEN l_tax END AS tax
        FROM lineitem""",
    "array_columns_explode": """
        SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS component FROM embeddings""",
    "explode_cross_product": f"""
        SELECT l_orderkey, l_linenumber,
               CASE f.n WHEN 1 THEN l_returnflag ELSE l_linestatus END AS flag, p.i AS part
        FROM lineitem CROSS JOIN {_TWO} f(n)
        LEFT JOIN {_TWO} p(i) ON p.i <= l_linenumber % 3""",
    "explode_empty_null": """
        SELECT o_orderkey, CAST(NULL AS VARCHAR) AS tag FROM orders WHERE o_orderkey % 4 IN (0, 1)
        UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 4 = 2
        UNION ALL SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderkey % 4 = 3
        UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderkey % 4 = 3""",
    "unpack_two_level": _ALL_DOCUMENT_WORDS,
    "unpack_conversations": """
        SELECT conv_id || '-' || turn AS id, conv_id AS conversation, turn, role,
               unnest(string_split(text, chr(10))) AS line
        FROM conversations""",
    "unpack_json_events": r"""
        SELECT event_id, event_type, CAST(regexp_extract(props, '"k": (\d+)', 1) AS BIGINT) AS k
        FROM events""",
    "unpack_drop_first": """
        SELECT 'C' || c_custkey AS id, c_custkey AS sort, c_name AS name FROM customer""",
    "add_replace_columns": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id, round(o_totalprice) AS total,
               o_orderstatus = 'F' AS is_final
        FROM orders""",
    "tolerant_drop": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderkey AS sort, o_custkey AS customer,
               o_orderstatus AS status
        FROM orders""",
    "bulk_rename": """
        SELECT l_orderkey AS OrderKey, l_partkey AS PartKey, l_suppkey AS SupplierKey, l_linenumber,
               l_quantity AS Quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
               CAST(l_shipdate AS DATE) AS ShipDate
        FROM lineitem""",
    "fixed_select": """
        SELECT l_tax AS "L_Tax", l_orderkey, l_linenumber AS "L_LINENUMBER",
               l_linenumber + 1 AS next_line
        FROM lineitem""",
    "literal_columns": """
        SELECT event_id, 'False' AS IsHidden, 'filler' AS ExternalAssetEmbed FROM events""",
    "case_like": """
        SELECT p_partkey,
               CASE WHEN p_partkey % 10 = 0 OR p_name NOT LIKE '%ring%' THEN p_brand END AS brand_if_no_ring,
               CASE WHEN p_partkey % 10 <> 0 AND p_name LIKE '%Ring%' THEN 'yes' ELSE 'no' END AS capital_ring
        FROM part""",
    "isin_infinity": """
        SELECT event_id,
               CASE event_id % 5 WHEN 0 THEN 0.0::DOUBLE WHEN 1 THEN 0.0::DOUBLE
                                 WHEN 4 THEN value * 1000 END AS seconds,
               CAST(CASE event_id % 5 WHEN 0 THEN 0 WHEN 1 THEN 0
                                      WHEN 4 THEN round(value * 1000) END AS INTEGER) AS whole_seconds,
               CASE WHEN event_id % 7 <> 0 THEN CAST(CASE event_id % 5 WHEN 0 THEN 0 WHEN 1 THEN 0
                                      WHEN 4 THEN round(value * 1000) END AS INTEGER) END AS whole_seconds_of_text,
               CASE WHEN event_id % 7 <> 0 THEN CAST(event_id AS INTEGER) END AS rounded_text
        FROM events""",
    "date_range_bounds": """
        SELECT o_orderkey,
               CASE o_orderkey % 6 WHEN 0 THEN o_custkey || ' to ' || o_orderkey
                   WHEN 1 THEN 'Before ' || o_orderkey WHEN 2 THEN CAST(o_orderkey AS VARCHAR)
                   WHEN 3 THEN 'before ' || o_orderkey
                   WHEN 4 THEN o_custkey || ' to ' || o_orderkey || ' to now' END AS date_range,
               CASE WHEN o_orderkey % 6 IN (0, 4) THEN CAST(o_custkey AS VARCHAR)
                    WHEN o_orderkey % 6 = 2 THEN CAST(o_orderkey AS VARCHAR)
                    WHEN o_orderkey % 6 = 3 THEN 'before ' || o_orderkey END AS date_range_from,
               CASE WHEN o_orderkey % 6 IN (0, 4) THEN CAST(o_orderkey AS VARCHAR)
                    WHEN o_orderkey % 6 = 1 THEN 'Before ' || o_orderkey END AS date_range_to
        FROM orders""",
    "concat_key": """
        SELECT o_orderkey,
               CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey || o_orderstatus || o_custkey END AS ConcatenatedId
        FROM orders""",
    "url_builder": f"""
        SELECT l_orderkey, '{LIST_ENTRY_URL}' || l_orderkey AS ListEntryUrl,
               CASE WHEN l_partkey % 4 <> 0 THEN '{MAP_SEARCH_URL}' || l_partkey END AS MapSearchUrl
        FROM lineitem""",
    "wkt_point": f"""
        SELECT o_orderkey, geometry, {_coordinate("geometry", 1)} AS longitude,
               {_coordinate("geometry", 2)} AS latitude
        FROM (SELECT o_orderkey, {_WKT} AS geometry FROM orders)""",
    "hashkey": """
        SELECT o_orderkey,
               CASE WHEN o_orderkey % 8 <> 0 THEN sha256(CAST(o_orderkey AS VARCHAR)) END AS hashkey
        FROM orders""",
    "round_cast_int": """
        SELECT l_orderkey, l_linenumber, CAST(round(l_extendedprice) AS INTEGER) AS price,
               CAST(round(l_quantity / 2) AS INTEGER) AS half_quantity
        FROM lineitem""",
    "id_to_int": """
        SELECT l_orderkey, l_linenumber,
               CASE WHEN l_linenumber % 4 IN (0, 2) THEN CAST(l_orderkey AS INTEGER) END AS id,
               CAST(l_partkey AS INTEGER) AS part
        FROM lineitem""",
    "seconds_to_hms": f"""
        SELECT l_orderkey * 97 + l_linenumber AS seconds,
               {_hms("l_orderkey * 97 + l_linenumber")} AS DurationConverted
        FROM lineitem""",
    "load_timestamp": "SELECT event_id, true AS has_created_on FROM events",
    "lookup_left_join": f"""
        SELECT o_orderkey, area, segment, copy
        FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL
                                      WHEN o_orderkey % 11 = 0 THEN -1 - o_custkey
                                      ELSE o_custkey END AS area FROM orders)
        LEFT JOIN (SELECT c_custkey, c_mktsegment AS segment, i AS copy
                   FROM customer JOIN {_TWO} c(i) ON i <= 1 + c_custkey % 2)
          ON area = c_custkey""",
    "lookup_hot_key": """
        SELECT l_orderkey, l_linenumber, l_partkey, supplier, s_name AS supplier_name
        FROM (SELECT *, CASE WHEN l_linenumber <= 3 THEN 0 ELSE l_suppkey END AS supplier FROM lineitem)
        LEFT JOIN supplier ON supplier = s_suppkey""",
    "bronze_roundtrip": _ALL_DOCUMENT_WORDS,
    "unpack_hot_record": """
        WITH lines AS (
            SELECT doc_id, length(line) AS length, row_number AS number
            FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                         unnest(range(1, len(string_split(text, chr(10))) + 1)) AS row_number FROM documents)
        )
        SELECT CAST(a.doc_id AS VARCHAR) AS id, CAST(a.length AS INTEGER) AS length, CAST(b.number AS INTEGER) AS number
        FROM lines a JOIN lines b USING (doc_id)""",
    "rejected_hits": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderkey % 97 <> 0 THEN o_totalprice END AS total,
               o_orderkey % 97 = 0 AS rejected
        FROM orders""",
    "conflicting_hits": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status,
               CASE o_orderkey % 4 WHEN 0 THEN '{"customer":' || o_custkey || '}'
                                   WHEN 1 THEN CAST(o_custkey AS VARCHAR)
                                   WHEN 2 THEN o_orderpriority END AS ref,
               layout
        FROM orders CROSS JOIN (VALUES ('lines'), ('indented'), ('document')) l(layout)""",
    "gold_aggregate": f"""
        SELECT Kind, Active, count(*) AS n_rows, count(DISTINCT Id) AS n_areas, max(Sort) AS last
        FROM ({_AREAS}) GROUP BY Kind, Active""",
    "multi_line_documents": _ORDER_HITS,
    "indented_documents": _ORDER_HITS,
    "lookup_bucketed": """
        SELECT o_orderkey, customer, c_name AS customer_name
        FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 1
                                      ELSE o_custkey END AS customer FROM orders)
        LEFT JOIN customer ON customer = c_custkey""",
    "audited_keys": """
        WITH keyed AS (SELECT DISTINCT o_orderkey || '' || o_custkey AS key, o_orderkey, o_custkey FROM orders)
        SELECT key, o_orderkey, o_custkey FROM keyed
        WHERE key IN (SELECT key FROM keyed GROUP BY key HAVING count(*) > 1)""",
    "replaced_layer": """
        SELECT o_orderkey AS id, o_custkey AS customer, o_totalprice AS total, 3 AS refused FROM orders""",
    "sibling_aggregates": f"""
        WITH {_SIBLINGS}
        SELECT lang, CAST(sum(n_rows) AS BIGINT) AS n_rows, CAST(sum(n_words * greatest(n, 1)) AS BIGINT) AS n_words,
               CAST(sum(n_chars * words * greatest(n, 1)) AS BIGINT) AS sum_chars,
               CASE WHEN max(n) > 0 THEN CAST(sum(words * n * (n + 1) // 2) AS BIGINT) END AS sum_numbers,
               CAST(max(n) AS BIGINT) AS last_number, min(first_word) AS first_word,
               CAST(sum(n_chars * words * greatest(n, 1)) AS DOUBLE) / CAST(sum(n_rows) AS DOUBLE) AS mean_chars
        FROM siblings GROUP BY lang""",
    "sibling_aggregates_by_element": f"""
        WITH {_SIBLINGS}
        SELECT line, CAST(sum(n_rows) AS BIGINT) AS n_rows, CAST(sum(n_chars * words * greatest(n, 1)) AS BIGINT) AS sum_chars,
               CASE WHEN max(n) > 0 THEN CAST(sum(words * n * (n + 1) // 2) AS BIGINT) END AS sum_numbers
        FROM siblings GROUP BY line""",
    "gold_from_hits": f"""
        SELECT AreaName AS area, count(*) AS n_rows, count(nhleId) AS n_examples,
               CAST(sum(nhlePriority) AS BIGINT) AS sum_priority, max(PeriodSort) AS last_period
        FROM ({_AREA_BY_NUMBERS_ROWS}) GROUP BY AreaName""",
    "map_entries": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id,
               CASE WHEN i = 2 THEN 'status' WHEN o_orderkey % 4 > 1 THEN o_orderpriority END AS fact,
               CAST(CASE WHEN i = 2 THEN o_orderkey WHEN o_orderkey % 4 > 1 THEN o_custkey END AS BIGINT) AS value
        FROM orders JOIN (VALUES (1), (2)) e(i) ON i = 1 OR o_orderkey % 4 = 3""",
    "map_pivot": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS id, {_FACTS},
               CAST(CASE WHEN o_orderkey % 4 = 3 THEN o_orderkey END AS BIGINT) AS status
        FROM orders""",
    "mixed_fields": """
        WITH parts AS (
            SELECT o_orderkey, 1 AS part, CAST(o_custkey AS BIGINT) AS part_size FROM orders WHERE o_orderkey % 3 < 2
            UNION ALL SELECT o_orderkey, 1, 7 FROM orders WHERE o_orderkey % 3 = 1
            UNION ALL SELECT o_orderkey, 2, NULL FROM orders WHERE o_orderkey % 3 = 1
        )
        SELECT CAST(o.o_orderkey AS VARCHAR) AS id, o_orderstatus AS status,
               CASE WHEN t.i = 1 AND o.o_orderkey % 5 < 2 THEN o_orderstatus
                    WHEN t.i = 2 THEN CAST(o_custkey AS VARCHAR) END AS tag,
               CAST(part AS BIGINT) AS part, part_size
        FROM orders o JOIN (VALUES (1), (2)) t(i) ON t.i = 1 OR o.o_orderkey % 5 = 1
        LEFT JOIN parts p ON p.o_orderkey = o.o_orderkey""",
    "compact_documents": r"""
        SELECT CAST(o_orderkey AS VARCHAR) AS id,
               '"},{"[' || o_custkey || ']\\' || CASE WHEN o_orderkey % 2 = 0 THEN '"' ELSE '}' END || o_orderstatus AS note,
               i AS part, '}' AS part_text, CAST(NULL AS VARCHAR) AS nothing
        FROM orders JOIN (VALUES (0::BIGINT), (1), (2)) p(i) ON i <= o_orderkey % 3""",
    "silver_gold_roundtrip": _AREAS,
    "medallion_area_by_numbers": _AREA_BY_NUMBERS,
    "topic_areas": _AREAS,
    "topic_area_by_numbers": _AREA_BY_NUMBERS,
    "topic_grant_aided_places": f"""
        SELECT 'G' || p_partkey AS Id, 'grant-aided-places' AS "Index", CAST(NULL AS DOUBLE) AS Score,
               p_partkey AS Sort, p_type AS Status, 'https://grants.example/' || p_partkey AS Url,
               CASE WHEN p_partkey % 6 <> 0 THEN CAST(1000000 + p_partkey AS INTEGER) END AS NHLE_UID,
               p_name AS Title, p_size > 25 AS IsListed,
               'https://maps.example/' || p_partkey AS ExternalMapLinkUrl,
               CAST(p_size AS BIGINT) AS Priority,
               CASE area.i WHEN 1 THEN 'C' || p_partkey WHEN 2 THEN p_brand END AS AreaId,
               p_name || ', ' || p_brand AS Description, 'img-' || p_partkey AS ThumbnailImageId,
               'POINT (' || (p_partkey % 180) || '.5 51.5)' AS geometry,
               CASE WHEN p_partkey % 6 <> 0 THEN '{MAP_SEARCH_URL}' || (1000000 + p_partkey) END AS ExternalLinkUrl,
               'False' AS isHidden,
               CASE area.i WHEN 1 THEN 'G' || p_partkey || 'C' || p_partkey
                           WHEN 2 THEN 'G' || p_partkey || p_brand END AS ConcatenatedId,
               p_brand AS passed_through
        FROM part
        JOIN {_TWO} ignored(n) ON n <= CASE WHEN p_partkey % 5 = 0 THEN 2 ELSE 1 END
        LEFT JOIN {_TWO} area(i) ON area.i <= p_partkey % 3""",
    "topic_historic_places": f"""
        SELECT CASE WHEN l_orderkey % 10 <> 0 THEN CAST(l_orderkey AS INTEGER) END AS Id,
               'historic-places' AS "Index", CAST(NULL AS DOUBLE) AS Score,
               CAST(l_linenumber AS BIGINT) AS Sort, 'Line ' || l_linenumber AS Title,
               l_returnflag AS HeritageCategory,
               CASE WHEN l_linestatus <> 'O' THEN l_linestatus END AS Grade,
               l_returnflag || l_linestatus AS Description, 'img-' || l_partkey AS ThumbnailImageId,
               'Supplier ' || l_suppkey AS Locality, CAST(l_linenumber AS BIGINT) AS Priority,
               {_HISTORIC_AREA} AS area_id, 'Part ' || l_partkey AS identifying_location,
               CAST(NULL AS VARCHAR) AS geometry,
               '{LIST_ENTRY_URL}' || {_HISTORIC_ID} AS ExternalLinkUrl,
               {_HISTORIC_ID} || {_HISTORIC_AREA} AS ConcatenatedId
        FROM lineitem JOIN {_TWO} area(i) ON i <= 2 - l_linenumber % 2""",
    "topic_images": f"""
        SELECT page_id AS sort, 'images' AS "index", CAST(page_id AS VARCHAR) AS id,
               CAST(NULL AS DOUBLE) AS score,
               '2024-01-' || lpad(CAST(1 + page_id % 28 AS VARCHAR), 2, '0') AS created_date,
               html AS description, url, 'pages' AS source,
               CASE WHEN page_id % 3 <> 0 THEN 'none' END AS copyright_statement,
               url || '/more' AS find_out_more_url,
               {_SIZES}
        FROM pages""",
    "topic_place_names": f"""
        SELECT 'P' || o_orderkey AS Id, 'place-names' AS "Index", CAST(NULL AS DOUBLE) AS Score,
               o_orderstatus AS "Type", o_orderpriority AS TypeName, Geometry,
               'Place ' || o_orderkey AS "Name", {_PLACE_COLUMNS},
               CAST(o_custkey AS VARCHAR) AS PlaceId, o_orderkey AS Sort,
               {_coordinate("Geometry", 1)} AS longitude, {_coordinate("Geometry", 2)} AS latitude,
               sha256('P' || o_orderkey) AS hashkey
        FROM (SELECT *, {_WKT} AS Geometry FROM orders)""",
    "topic_stories": f"""
        SELECT 'S' || event_id AS Id, 'stories' AS "Index", CAST(NULL AS DOUBLE) AS Score,
               event_type AS "Type", props AS Description,
               'https://media.example/' || event_id AS ExternalAssetSourceUrl,
               'img-' || event_id AS ThumbnailImageId,
               'Place ' || (user_id + i) AS MentionedLocationText, event_id % 2 = 0 AS Featured,
               event_id AS Sort, 'C' || (user_id + i) AS AreaId, 'Story of ' || user_id AS Title,
               CASE WHEN i IS NOT NULL THEN 'https://stories.example/' || event_id END AS ExternalLinkUrl,
               seconds AS MediaDuration, 'filler' AS ExternalAssetEmbed, 'False' AS IsHidden,
               {_hms("seconds")} AS DurationConverted,
               CASE WHEN i IS NOT NULL AND event_id % 4 <> 0
                    THEN 'S' || event_id || '#' || i END AS URLAnchorCombined
        FROM (SELECT *, CAST(CASE event_id % 5 WHEN 0 THEN 0 WHEN 1 THEN 0
                                               WHEN 4 THEN round(value * 1000) END AS INTEGER) AS seconds
              FROM events)
        LEFT JOIN {_TWO} mention(i) ON i <= event_id % 3""",
}

# From exported text to gold, a topic's rows are those of its hits.
for _topic in ("areas", "grant_aided_places", "historic_places", "images", "place_names", "stories"):
    ORACLE_SQL[f"medallion_{_topic}"] = ORACLE_SQL[f"topic_{_topic}"]

# A run's report counts the rows of its silver layer, and those without a value by column.
_STORY_NULLS = " UNION ALL ".join(
    f"SELECT 'nulls', '{name}', count(*) - count(\"{name}\") FROM g"
    for name in (
        "Id Index Score Sort Type Description ExternalAssetSourceUrl ThumbnailImageId MentionedLocationText Featured "
        "AreaId Title ExternalLinkUrl MediaDuration ExternalAssetEmbed IsHidden DurationConverted URLAnchorCombined"
    ).split()
)
ORACLE_SQL["run_report"] = f"""
    WITH g AS ({ORACLE_SQL["topic_stories"]})
    SELECT 'hits' AS metric, '' AS column_name, count(*) AS value FROM events
    UNION ALL SELECT 'rejects', '', 3
    UNION ALL SELECT 'absent', 'anchor', 0
    UNION ALL SELECT 'nulls', 'CreatedOn', 0
    UNION ALL SELECT 'rows', '', count(*) FROM g
    UNION ALL {_STORY_NULLS}"""
