"""Nested search hits made from the driver's tables.

Every table row becomes one hit whose arrays come from that row, so building
them neither shuffles nor groups: it scales as the scan does, and no hit can
outgrow its row however often a key occurs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """A new directory that every executor can see.

    It lies in the shared folder that ``spark.checkpoint.dir`` names. Without that it lies in the
    session's warehouse, if all run on this machine or the warehouse is on a shared file system; a
    cluster whose warehouse is a local folder raises ``ValueError``. What is written there is read
    lazily by the result of a query, so it is left for the owner of the folder to clear (by age,
    say) once results are in.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        alone = spark.conf.get("spark.master", "local").split("[")[0] == "local"
        if not alone and warehouse.startswith(("file:", "/")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share: the warehouse is a local one")
        base = f"{warehouse}/_scratch"
    return f"{base.rstrip('/')}/hitloom-{uuid.uuid4().hex}"


def hits(rows: DataFrame, index: str, hit_id: str, sort: str, source: str, ignored: str | None = None) -> DataFrame:
    """Wrap rows in the hit envelope; arguments are SQL expressions."""
    columns = [
        F.expr(f"cast({hit_id} as string)").alias("_id"),
        F.lit(index).alias("_index"),
        F.lit(None).cast("double").alias("_score"),
        F.array(F.expr(f"cast({sort} as bigint)")).alias("sort"),
        F.expr(source).alias("_source"),
    ]
    if ignored:
        columns.append(F.expr(ignored).alias("_ignored"))
    return rows.select(*columns)


def hit_lines(rows: DataFrame) -> DataFrame:
    """Hits as JSON text, one ``value`` per hit."""
    return rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def write_documents(lines: DataFrame, path: str, document_bytes: int = 1 << 22, indented: bool = True) -> None:
    """Write hits (JSON objects as text) as arrays, one per file, an element per indented block or all on one line.

    A document takes consecutive rows of one scan task, as many as fit into
    ``document_bytes`` at the size of the largest hit: documents are bounded in
    bytes, and their number grows with the data.
    """
    largest = lines.agg(F.max(F.octet_length("value"))).first()[0] or 1
    rows = max(1, document_bytes // (largest + 24))
    numbered = lines.withColumn("document", F.expr(f"monotonically_increasing_id() div {rows}"))
    block = r"concat('\n    {\n        ', substring(value, 2, char_length(value) - 2), '\n    }')"
    documents = numbered.groupBy("document").agg(F.collect_list(F.expr(block) if indented else F.col("value")).alias("elements"))
    end = r"\n]" if indented else "]"
    text = documents.selectExpr(f"concat('[', array_join(elements, ','), '{end}') AS value")
    text.write.option("maxRecordsPerFile", 1).text(path)


def conflicting_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as hits whose ``ref`` is an object, a number, a text or absent."""
    ref = """case o_orderkey % 4
        when 0 then concat(',"ref":{"customer":', o_custkey, '}')
        when 1 then concat(',"ref":', o_custkey)
        when 2 then concat(',"ref":"', o_orderpriority, '"')
        else '' end"""
    value = f"""concat('{{"_id":"', o_orderkey, '","_source":{{"status":"', o_orderstatus, '"', {ref}, '}}}}')"""
    return table(spark, sf_dir, "orders").selectExpr(f"{value} AS value")


def mixed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as hits whose ``tag`` and ``part`` are a single value, an array, null or absent, on two levels."""
    tag = """case o_orderkey % 5
        when 0 then concat(',"tag":"', o_orderstatus, '"')
        when 1 then concat(',"tag":["', o_orderstatus, '",', o_custkey, ']')
        when 2 then ',"tag":[]'
        when 3 then ',"tag":null'
        else '' end"""
    part = """case o_orderkey % 3
        when 0 then concat(',"part":{"n":1,"size":', o_custkey, '}')
        when 1 then concat(',"part":[{"n":1,"size":[', o_custkey, ',7]},{"n":2}]')
        else '' end"""
    value = f"""concat('{{"_id":"', o_orderkey, '","_source":{{"status":"', o_orderstatus, '"', {tag}, {part}, '}}}}')"""
    return table(spark, sf_dir, "orders").selectExpr(f"{value} AS value")


def noted_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as hits with braces, quotes and backslashes inside their strings, and arrays within."""
    rows = table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) as _id",
        r"""named_struct(
            'note', concat('"},{"[', o_custkey, ']\\\\', if(o_orderkey % 2 = 0, '"', '}'), o_orderstatus),
            'parts', transform(sequence(0, cast(o_orderkey % 3 as int)), i -> named_struct('n', i, 'text', '}')),
            'empty', named_struct('list', cast(array() as array<string>))) as _source""",
    )
    return hit_lines(rows)


def broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as hits, a 97th of them cut off before their last braces."""
    lines = order_hits(spark, sf_dir).select(F.col("sort")[0].alias("n"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    return lines.selectExpr("if(n % 97 = 0, substring(value, 1, char_length(value) - 2), value) AS value")


def hot_record_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records with two siblings of one element per line: a long text is a hot record."""
    return hits(
        table(spark, sf_dir, "documents"),
        "documents",
        "doc_id",
        "doc_id",
        r"""named_struct(
            'lengths', transform(split(text, '\n'), line -> char_length(line)),
            'numbers', sequence(1, size(split(text, '\n'))))""",
    )


def sibling_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as lines of words, and beside them numbers: siblings whose product grows with the square of a text."""
    return hits(
        table(spark, sf_dir, "documents"),
        "documents",
        "doc_id",
        "doc_id",
        r"""named_struct(
            'lang', lang,
            'lines', transform(split(text, '\n'), (line, i) -> named_struct(
                'number', cast(i + 1 as bigint),
                'n_chars', cast(char_length(line) as bigint),
                'words', filter(split(line, ' '), w -> w <> ''))),
            'numbers', slice(sequence(cast(1 as bigint), cast(7 as bigint)), 1, size(split(text, '\n')) % 7))""",
    )


#: Keys of the object in `keyed_lines`.
FACT_KEYS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "status")


def keyed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as hits with an object that is keyed by the order's priority; some have none, or an empty one."""
    facts = """case o_orderkey % 4
        when 0 then ''
        when 1 then '"facts":{}'
        when 2 then concat('"facts":{"', o_orderpriority, '":', o_custkey, '}')
        else concat('"facts":{"', o_orderpriority, '":', o_custkey, ',"status":', o_orderkey, '}') end"""
    value = f"""concat('{{"_id":"', o_orderkey, '","_source":{{', {facts}, '}}}}')"""
    return table(spark, sf_dir, "orders").selectExpr(f"{value} AS value")


def document_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as lines of words, over the whole text."""
    return hits(
        table(spark, sf_dir, "documents"),
        "documents",
        "doc_id",
        "doc_id",
        r"""named_struct(
            'lang', lang,
            'source', source,
            'lines', transform(split(text, '\n'), (line, i) -> named_struct(
                'number', cast(i + 1 as bigint),
                'n_chars', cast(char_length(line) as bigint),
                'words', split(line, ' '))))""",
    )


def conversation_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as lines, with the speaker three levels down."""
    return hits(
        table(spark, sf_dir, "conversations"),
        "conversations",
        "concat(conv_id, '-', turn)",
        "turn",
        r"""named_struct(
            'conversation', conv_id,
            'turn', named_struct(
                'number', turn,
                'speaker', named_struct('role', role),
                'lines', split(text, '\n')))""",
    )


def order_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits(
        table(spark, sf_dir, "orders"),
        "orders",
        "o_orderkey",
        "o_orderkey",
        """named_struct('customer', o_custkey, 'status', o_orderstatus,
                        'total', o_totalprice, 'priority', o_orderpriority)""",
    )


def areas_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as areas; 0 to 2 children and 0 or 1 parents each."""
    return hits(
        table(spark, sf_dir, "customer"),
        "areas",
        "concat('C', c_custkey)",
        "c_custkey",
        """named_struct(
            'name', c_name,
            'kind', c_mktsegment,
            'active', c_acctbal > 0,
            'hierarchy_level', cast(c_nationkey as bigint),
            'hierarchy_level_name', concat('Level ', c_nationkey),
            'description', if(c_custkey % 9 = 0, null, concat(c_name, ' of ', c_mktsegment)),
            'header_image_id', concat('img-', c_custkey),
            'geometry', concat('POINT (', c_custkey % 180, '.5 ', c_custkey % 90, '.25)'),
            'hierarchy_children', slice(array('first', 'second'), 1, cast(c_custkey % 3 as int)),
            'hierarchy_parents', if(c_custkey % 2 = 0, array(), array(concat('N', c_nationkey))),
            'in_scope', c_custkey % 4 = 0,
            'scope_note', cast(null as string),
            'view_more_url', concat('https://areas.example/', c_custkey))""",
        ignored="if(c_custkey % 7 = 0, array('name.raw'), cast(null as array<string>))",
    )


def area_by_numbers_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as numbers of an area: 0 to 2 periods, 0 to 2 examples each."""

    def example(n: int) -> str:
        return f"""named_struct(
            'nhle_id', concat(o_orderkey, '-', {n}),
            'name', concat('Example ', {n}),
            'image_id', concat('img-', o_orderkey),
            'priority', cast({n} as bigint),
            'summary_text', o_orderpriority,
            'url', concat('https://examples.example/', o_orderkey))"""

    def period(n: int, date_range: str, n_examples: str) -> str:
        return f"""named_struct(
            'name', concat('Period ', {n}),
            'date_range', {date_range},
            'sort', cast({n} as bigint),
            'description', concat(o_orderstatus, ' ', {n}),
            'description_source', o_orderpriority,
            'description_source_url', concat('https://sources.example/', o_orderkey),
            'examples', slice(array({example(1)}, {example(2)}), 1, cast({n_examples} as int)))"""

    written = """case o_orderkey % 4
        when 0 then concat(1000 + o_orderkey % 500, ' to ', 1500 + o_orderkey % 500)
        when 1 then concat('Before ', o_orderkey)
        when 2 then cast(o_orderkey as string)
        else null end"""
    first = period(1, written, "o_orderkey % 3")
    second = period(2, "concat('Year to ', year(o_orderdate))", "o_custkey % 3")
    return hits(
        table(spark, sf_dir, "orders"),
        "area-by-numbers",
        "o_orderkey",
        "o_orderkey",
        f"""named_struct(
            'area_id', case when o_orderkey % 11 = 0 then null
                            when o_orderkey % 13 = 0 then concat('X', o_custkey)
                            else concat('C', o_custkey) end,
            'unused', o_totalprice,
            'periods', slice(array({first}, {second}), 1, cast(o_orderkey % 3 as int)))""",
    )


def grant_aided_places_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as places, in 0 to 2 areas each."""
    return hits(
        table(spark, sf_dir, "part"),
        "grant-aided-places",
        "concat('G', p_partkey)",
        "p_partkey",
        """named_struct(
            'status', p_type,
            'url', concat('https://grants.example/', p_partkey),
            'nhle_id', if(p_partkey % 6 = 0, null, 1000000 + p_partkey),
            'name', p_name,
            'is_listed', p_size > 25,
            'map_view_url', concat('https://maps.example/', p_partkey),
            'priority', cast(p_size as bigint),
            'area_id', slice(array(concat('C', p_partkey), p_brand), 1, cast(p_partkey % 3 as int)),
            'description', concat(p_name, ', ', p_brand),
            'image_id', concat('img-', p_partkey),
            'geometry', concat('POINT (', p_partkey % 180, '.5 51.5)'),
            'reviewed_by', p_brand)""",
        ignored="if(p_partkey % 5 = 0, array('description', 'name'), array())",
    )


def historic_places_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as places; most ids are integers, some are not."""
    return hits(
        table(spark, sf_dir, "lineitem"),
        "historic-places",
        "if(l_orderkey % 10 = 0, concat('H', l_orderkey), cast(l_orderkey as string))",
        "l_linenumber",
        """named_struct(
            'name', concat('Line ', l_linenumber),
            'heritage_category', l_returnflag,
            'grade', if(l_linestatus = 'O', null, l_linestatus),
            'summary_text', concat(l_returnflag, l_linestatus),
            'image_id', concat('img-', l_partkey),
            'locality', concat('Supplier ', l_suppkey),
            'priority', cast(l_linenumber as bigint),
            'area_id', if(l_linenumber % 2 = 0, array(concat('C', l_suppkey), 'C0'), array(concat('C', l_suppkey))),
            'identifying_location', concat('Part ', l_partkey),
            'geometry', cast(null as string),
            'display_in_highlights', l_tax > 0.04)""",
    )


def images_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as images in seven sizes; some without any size."""
    sizes = ", ".join(
        f"'{size}', concat(url, '#{size}')"
        for size in ("920x450", "759x569", "373x240", "868x560", "375x250", "700x400", "868x450")
    )
    return hits(
        table(spark, sf_dir, "pages"),
        "images",
        "page_id",
        "page_id",
        f"""named_struct(
            'created_date', concat('2024-01-', lpad(cast(1 + page_id % 28 as string), 2, '0')),
            'description', html,
            'url', url,
            'source', 'pages',
            'copyright_statement', if(page_id % 3 = 0, null, 'none'),
            'find_out_more_url', concat(url, '/more'),
            'sized_url', if(page_id % 8 = 0, null, named_struct({sizes})),
            'image_id', page_id)""",
        ignored="array('description')",
    )


def place_names_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as place names; some geometries are no decimal point."""
    names = ", ".join(
        f"'{field}', concat('{field} ', o_orderkey % {n})"
        for n, field in enumerate(
            (
                "name_alt",
                "name_country",
                "name_county",
                "name_county_1961",
                "name_county_1991",
                "name_county_historic",
                "name_district",
                "name_district_1961",
                "name_district_1991",
                "name_national_park",
                "name_region",
            ),
            start=2,
        )
    )
    return hits(
        table(spark, sf_dir, "orders"),
        "place-names",
        "concat('P', o_orderkey)",
        "o_orderkey",
        f"""named_struct(
            '_type', o_orderstatus,
            '_type_name', o_orderpriority,
            'geometry', {WKT_BY_ORDER},
            'name', concat('Place ', o_orderkey),
            {names},
            'place_id', cast(o_custkey as string),
            'area_id', concat('C', o_custkey))""",
    )


# Well-formed points and everything that is none, by order key.
WKT_BY_ORDER = """case o_orderkey % 6
    when 0 then concat('POINT (-', o_orderkey % 180, '.', 10 + o_custkey % 90, ' ', o_custkey % 90, '.5)')
    when 1 then concat('POINT (', o_orderkey % 180, '.25 -', o_custkey % 90, '.75)')
    when 2 then concat('near POINT (', o_orderkey % 180, '.0 ', o_custkey % 90, '.0) there')
    when 3 then concat('POINT (', o_orderkey % 180, ' ', o_custkey % 90, ')')
    when 4 then concat('POINT(', o_orderkey % 180, '.0 ', o_custkey % 90, '.0)')
    else null end"""

# Durations with everything that is no number of seconds, by event.
DURATION_BY_EVENT = """case event_id % 5
    when 0 then double('Infinity')
    when 1 then double('-Infinity')
    when 2 then double('NaN')
    when 3 then cast(null as double)
    else value * 1000 end"""


def stories_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as stories that mention 0 to 2 places."""

    def mention(n: int) -> str:
        return f"""named_struct(
            '_type', 'place',
            'name', concat('Place ', user_id + {n}),
            'area_id', concat('C', user_id + {n}),
            'url', concat('https://stories.example/', event_id),
            'anchor', if(event_id % 4 = 0, null, concat('#', {n})))"""

    return hits(
        table(spark, sf_dir, "events"),
        "stories",
        "concat('S', event_id)",
        "event_id",
        f"""named_struct(
            '_type', event_type,
            'title', concat('Story of ', user_id),
            'description', props,
            'url', concat('https://media.example/', event_id),
            'image_id', concat('img-', event_id),
            'featured', event_id % 2 = 0,
            'duration', {DURATION_BY_EVENT},
            'mentions', slice(array({mention(1)}, {mention(2)}), 1, cast(event_id % 3 as int)))""",
        ignored="if(event_id % 6 = 0, array('description'), cast(null as array<string>))",
    )
