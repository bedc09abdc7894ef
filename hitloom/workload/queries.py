"""One query per operator, each over the whole of its tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

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
from hitloom.operators.columns import (
    add_columns,
    constant,
    drop_columns,
    flat,
    rename_columns,
    select_columns,
)
from hitloom.operators.keys import BUCKET_KEYS, key_collisions, key_sketches, merged_sketches
from hitloom.operators.lookup import lookup_left_join
from hitloom.operators.maps import objects_as_maps, pivot_map
from hitloom.operators.nested import array_columns, explode_outer_all, flatten, unpack
from hitloom.operators.siblings import aggregate_unpacked
from hitloom.plans.contract import EMBED_FILLER, LIST_ENTRY_URL, MAP_SEARCH_URL, NOT_HIDDEN
from hitloom.plans.medallion import curate, run_topics
from hitloom.plans.topics import TOPICS
from hitloom.sources.buckets import bucketed_left_join, write_bucketed
from hitloom.sources.hits import land_bronze, read_hits, split_rejects, write_bronze
from hitloom.sources.tables import SchemaChange, layer_path, read_table, write_table
from hitloom.workload import records
from hitloom.workload.records import table

Query = Callable[[SparkSession, str], DataFrame]

#: Tasks that the rows of hot records are dealt to between explodes.
HOT_SPREAD = 16

#: Buckets of the tables that a lookup joins without a shuffle.
BUCKETS = 16


# --- nested restructuring -------------------------------------------------------


def flatten_structs(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        """if(l_linenumber % 5 = 0, null, named_struct(
            'quantity', l_quantity,
            'price', named_struct(
                'extended', l_extendedprice,
                'rates', named_struct('discount', l_discount, 'tax', l_tax)))) as line""",
    )
    return rename_columns(
        flatten(nested),
        {
            "line.quantity": "quantity",
            "line.price.extended": "extended",
            "line.price.rates.discount": "discount",
            "line.price.rates.tax": "tax",
        },
    )


def array_columns_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    rows = explode_outer_all(vectors, array_columns(vectors))
    return rows.select("vec_id", "label", F.col("embedding").cast("double").alias("component"))


def explode_cross_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    siblings = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "array(l_returnflag, l_linestatus) as flag",
        "slice(array(1, 2), 1, l_linenumber % 3) as part",
    )
    return explode_outer_all(siblings, ["flag", "part"])


def explode_empty_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_outer_all(
        table(spark, sf_dir, "orders").selectExpr(
            "o_orderkey",
            """case o_orderkey % 4
                when 0 then cast(null as array<string>)
                when 1 then cast(array() as array<string>)
                when 2 then array(o_orderstatus)
                else array(o_orderpriority, null) end as tag""",
        ),
        ["tag", "o_orderkey"],
    )


def unpack_two_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename_columns(
        unpack(records.document_hits(spark, sf_dir)),
        {
            "_id": "id",
            "_index": "index_name",
            "_score": "score",
            "_source.lang": "lang",
            "_source.source": "source",
            "_source.lines.number": "line_number",
            "_source.lines.n_chars": "line_chars",
            "_source.lines.words": "word",
        },
    )


def unpack_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = unpack(records.conversation_hits(spark, sf_dir))
    return rows.select(
        flat("_id").alias("id"),
        flat("_source.conversation").alias("conversation"),
        flat("_source.turn.number").alias("turn"),
        flat("_source.turn.speaker.role").alias("role"),
        flat("_source.turn.lines").alias("line"),
    )


def unpack_json_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.from_json("props", "k bigint", {"mode": "FAILFAST"}).alias("props")
    )
    return rename_columns(unpack(events), {"props.k": "k"})


def unpack_drop_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = unpack(
        records.areas_hits(spark, sf_dir),
        drop_first=("_ignored", "_source.hierarchy_children", "_source.hierarchy_parents"),
    )
    return rows.select(flat("_id").alias("id"), "sort", flat("_source.name").alias("name"))


# --- projection and curation ------------------------------------------------------


def add_replace_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = add_columns(
        unpack(records.order_hits(spark, sf_dir)),
        {
            "_source.total": F.round(flat("_source.total"), 0),
            "is_final": flat("_source.status") == "F",
        },
    )
    return rows.select(
        flat("_id").alias("id"), flat("_source.total").alias("total"), "is_final"
    )


def tolerant_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = drop_columns(
        unpack(records.order_hits(spark, sf_dir)),
        "_index",
        "_score",
        "absent",
        "_source.absent",
        "_source.total",
        "_source.priority",
    )
    return rename_columns(rows, {"_id": "id", "_source.customer": "customer", "_source.status": "status"})


def bulk_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename_columns(
        table(spark, sf_dir, "lineitem"),
        {
            "L_ORDERKEY": "OrderKey",
            "l_partkey": "PartKey",
            "absent": "Absent",
            "_source.absent": "AbsentToo",
            "l_suppkey": "SupplierKey",
            "l_quantity": "Quantity",
            "l_SHIPDATE": "ShipDate",
        },
    ).withColumn("ShipDate", F.col("ShipDate").cast("date"))


def fixed_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = select_columns(table(spark, sf_dir, "lineitem"), ["L_Tax", "l_orderkey", "L_LINENUMBER"])
    return rows.withColumn("next_line", rows["l_linenumber"] + 1)


def literal_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id")
    return add_columns(
        events, {"IsHidden": constant(NOT_HIDDEN), "ExternalAssetEmbed": constant(EMBED_FILLER)}
    )


# --- predicates, strings, numbers, times --------------------------------------------


def case_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("p_partkey") % 10 == 0, F.lit(None)).otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(name.like("%ring%"), constant(None)).otherwise(F.col("p_brand")).alias("brand_if_no_ring"),
        F.when(name.like("%Ring%"), "yes").otherwise("no").alias("capital_ring"),
    )


def isin_infinity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Durations as numbers, and as text that one bad hit has widened the column to."""
    seconds = clean_duration(F.expr(records.DURATION_BY_EVENT))
    text = F.expr(f"if(event_id % 7 = 0, 'unknown', cast({records.DURATION_BY_EVENT} as string))")
    return table(spark, sf_dir, "events").select(
        "event_id",
        seconds.alias("seconds"),
        rounded_int(seconds).alias("whole_seconds"),
        rounded_int(clean_duration(text)).alias("whole_seconds_of_text"),
        rounded_int(F.expr("if(event_id % 7 = 0, 'unknown', cast(event_id as string))")).alias("rounded_text"),
    )


def date_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr(
        """case o_orderkey % 6
            when 0 then concat(o_custkey, ' to ', o_orderkey)
            when 1 then concat('Before ', o_orderkey)
            when 2 then cast(o_orderkey as string)
            when 3 then concat('before ', o_orderkey)
            when 4 then concat(o_custkey, ' to ', o_orderkey, ' to now')
            else null end"""
    )
    start, end = date_range_bounds(text)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", text.alias("date_range"), start.alias("date_range_from"), end.alias("date_range_to")
    )


def concat_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", joined_key(F.col("o_orderkey"), status, F.col("o_custkey")).alias("ConcatenatedId")
    )


def url_builder(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.when(F.col("l_partkey") % 4 != 0, F.col("l_partkey"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        url(LIST_ENTRY_URL, F.col("l_orderkey")).alias("ListEntryUrl"),
        url(MAP_SEARCH_URL, part).alias("MapSearchUrl"),
    )


def wkt_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    wkt = F.expr(records.WKT_BY_ORDER)
    longitude, latitude = point_coordinates(wkt)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", wkt.alias("geometry"), longitude.alias("longitude"), latitude.alias("latitude")
    )


def hashkey(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_id = F.when(F.col("o_orderkey") % 8 != 0, F.col("o_orderkey").cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", hash_key(text_id).alias("hashkey"))


def round_cast_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        rounded_int(F.col("l_extendedprice")).alias("price"),
        rounded_int(F.col("l_quantity") / 2).alias("half_quantity"),
    )


def id_to_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_id = F.expr(
        """case l_linenumber % 4
            when 0 then concat(' ', l_orderkey, ' ')
            when 1 then concat('x', l_orderkey)
            when 2 then cast(l_orderkey as string)
            else null end"""
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", to_int(text_id).alias("id"), to_int(F.col("l_partkey")).alias("part")
    )


def seconds_to_hms(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.col("l_orderkey") * 97 + F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        seconds.alias("seconds"), clock_time(seconds).alias("DurationConverted")
    )


def load_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = add_columns(table(spark, sf_dir, "events").select("event_id"), {"CreatedOn": load_timestamp()})
    return stamped.select("event_id", F.col("CreatedOn").isNotNull().alias("has_created_on"))


# --- lookups ------------------------------------------------------------------------


def lookup_with_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some keys are null, some match nothing, every second one matches twice."""
    left = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        """case when o_orderkey % 7 = 0 then null
                when o_orderkey % 11 = 0 then -1 - o_custkey
                else o_custkey end as area""",
    )
    lookup = explode_outer_all(
        table(spark, sf_dir, "customer").selectExpr(
            "c_custkey", "c_mktsegment", "slice(array(1, 2), 1, cast(1 + c_custkey % 2 as int)) as copy"
        ),
        ["copy"],
    )
    return lookup_left_join(left, lookup, "area", "c_custkey", {"c_mktsegment": "segment", "copy": "copy"})


def lookup_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over a third of the rows share one key, which salts spread over tasks."""
    left = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "if(l_linenumber <= 3, 0, l_suppkey) as supplier"
    )
    return lookup_left_join(
        left,
        table(spark, sf_dir, "supplier"),
        "supplier",
        "s_suppkey",
        {"s_name": "supplier_name"},
        salts=16,
        salt_by=["l_orderkey", "l_partkey"],
    )


def lookup_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides are stored by the hash of the key, so the join shuffles nothing; nulls and a hot key go apart."""
    root, run = records.scratch_dir(spark), uuid.uuid4().hex
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "case when o_orderkey % 7 = 0 then null when o_orderkey % 3 = 0 then 1 else o_custkey end as customer"
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    left = write_bucketed(orders, f"hitloom_orders_{run}", f"{root}/orders", "customer", BUCKETS)
    lookup = write_bucketed(customers, f"hitloom_customers_{run}", f"{root}/customers", "c_custkey", BUCKETS)
    return bucketed_left_join(left, lookup, "customer", "c_custkey", {"c_name": "customer_name"}, hot_keys=[1])


def audited_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different parts that give one key, found where sketches of two layers together disagree."""
    parts = ["o_orderkey", "o_custkey"]
    keyed = table(spark, sf_dir, "orders").withColumn("key", joined_key(F.col("o_orderkey"), F.col("o_custkey")))
    buckets = max(1, keyed.count() // BUCKET_KEYS)
    layers = [keyed.filter(F.col("o_orderkey") % 2 == rest) for rest in (0, 1)]
    sketches = merged_sketches(*(key_sketches(layer, "key", parts, buckets) for layer in layers))
    return key_collisions(keyed, "key", parts, sketches)


# --- layers -------------------------------------------------------------------------


def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export, land as text, infer the schema from bronze and unpack."""
    root = records.scratch_dir(spark)
    write_bronze(records.document_hits(spark, sf_dir), f"{root}/export")
    bronze = layer_path(root, "documents", "bronze")
    land_bronze(spark, f"{root}/export", bronze)
    return _document_rows(unpack(read_hits(spark, bronze)))


def _document_rows(rows: DataFrame) -> DataFrame:
    return rename_columns(
        rows,
        {
            "_id": "id",
            "_index": "index_name",
            "_score": "score",
            "_source.lang": "lang",
            "_source.source": "source",
            "_source.lines.number": "line_number",
            "_source.lines.n_chars": "line_chars",
            "_source.lines.words": "word",
        },
    )


def _landed_documents(spark: SparkSession, sf_dir: str, layout: str) -> DataFrame:
    root = records.scratch_dir(spark)
    records.write_documents(records.hit_lines(records.order_hits(spark, sf_dir)), f"{root}/export")
    bronze = layer_path(root, "orders", "bronze")
    land_bronze(spark, f"{root}/export", bronze, layout)
    return rename_columns(
        unpack(read_hits(spark, bronze)),
        {
            "_id": "id",
            "_index": "index_name",
            "_score": "score",
            "_source.customer": "customer",
            "_source.status": "status",
            "_source.total": "total",
            "_source.priority": "priority",
        },
    )


def multi_line_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON array documents, each parsed as a whole."""
    return _landed_documents(spark, sf_dir, "document")


def indented_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents, cut into hits by their indentation."""
    return _landed_documents(spark, sf_dir, "indented")


def compact_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays on one line each, of any size, cut into hits by the depth of their braces."""
    root = records.scratch_dir(spark)
    records.write_documents(records.noted_order_lines(spark, sf_dir), f"{root}/export", 1 << 26, indented=False)
    bronze = layer_path(root, "orders", "bronze")
    land_bronze(spark, f"{root}/export", bronze, "compact")
    rows = unpack(read_hits(spark, bronze))
    return rows.select(
        flat("_id").alias("id"),
        flat("_source.note").alias("note"),
        flat("_source.parts.n").alias("part"),
        flat("_source.parts.text").alias("part_text"),
        flat("_source.empty.list").alias("nothing"),
    )


def conflicting_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits with a field of several types, landed from all three layouts."""
    root = records.scratch_dir(spark)
    lines = records.conflicting_lines(spark, sf_dir)
    lines.write.text(f"{root}/lines")
    records.write_documents(lines, f"{root}/documents")
    parts = []
    for layout, export in (("lines", "lines"), ("indented", "documents"), ("document", "documents")):
        bronze = layer_path(root, layout, "bronze")
        land_bronze(spark, f"{root}/{export}", bronze, layout)
        rows = rename_columns(unpack(read_hits(spark, bronze)), {"_id": "id", "_source.status": "status", "_source.ref": "ref"})
        parts.append(rows.withColumn("layout", F.lit(layout)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def mixed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that only some hits hold an array in: a row for each element, one for a single value."""
    root = records.scratch_dir(spark)
    records.mixed_lines(spark, sf_dir).write.text(f"{root}/export")
    bronze = layer_path(root, "orders", "bronze")
    land_bronze(spark, f"{root}/export", bronze)
    rows = unpack(read_hits(spark, bronze, mixed_arrays=True))
    return rename_columns(
        rows,
        {
            "_id": "id",
            "_source.status": "status",
            "_source.tag": "tag",
            "_source.part.n": "part",
            "_source.part.size": "part_size",
        },
    )


def rejected_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits that can be read, and the lines that are none, kept apart."""
    root = records.scratch_dir(spark)
    records.broken_lines(spark, sf_dir).write.text(f"{root}/export")
    bronze = layer_path(root, "orders", "bronze")
    land_bronze(spark, f"{root}/export", bronze)
    good, bad = split_rejects(spark, bronze)
    rows = unpack(good).select(flat("_id").alias("id"), flat("_source.total").alias("total"), F.lit(False).alias("rejected"))
    lost = bad.select(
        F.regexp_extract("value", '"_id":"([0-9]+)"', 1).alias("id"),
        F.lit(None).cast("double").alias("total"),
        F.lit(True).alias("rejected"),
    )
    return rows.unionByName(lost)


def unpack_hot_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two siblings of one record multiply; rows are dealt out between the explodes."""
    rows = unpack(records.hot_record_hits(spark, sf_dir), spread=HOT_SPREAD)
    return rows.select(
        flat("_id").alias("id"),
        flat("_source.lengths").alias("length"),
        flat("_source.numbers").alias("number"),
    )


def silver_gold_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = records.scratch_dir(spark)
    silver, gold = (layer_path(root, "areas", layer) for layer in ("silver", "gold"))
    write_table(curate(records.areas_hits(spark, sf_dir), TOPICS["areas"]), silver)
    write_table(read_table(spark, silver), gold)
    return read_table(spark, gold)


def medallion_area_by_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both topics through all layers; the second looks up the first's gold."""
    exports = {
        "areas": records.areas_hits(spark, sf_dir),
        "area-by-numbers": records.area_by_numbers_hits(spark, sf_dir),
    }
    return run_topics(spark, exports, records.scratch_dir(spark))["area-by-numbers"]


def _medallion(spark: SparkSession, sf_dir: str, topic: str, hits: DataFrame, **options) -> DataFrame:
    """A topic from exported text to gold; the schema is inferred from bronze."""
    root = records.scratch_dir(spark)
    write_bronze(hits, f"{root}/export")
    return run_topics(spark, {topic: f"{root}/export"}, root, **options)[topic]


def medallion_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _medallion(spark, sf_dir, "areas", records.areas_hits(spark, sf_dir))


def medallion_grant_aided_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _medallion(spark, sf_dir, "grant-aided-places", records.grant_aided_places_hits(spark, sf_dir))
    return rename_columns(rows, {"_source.reviewed_by": "passed_through"})


def medallion_historic_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _medallion(spark, sf_dir, "historic-places", records.historic_places_hits(spark, sf_dir))


def medallion_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _medallion(spark, sf_dir, "images", records.images_hits(spark, sf_dir))


def medallion_place_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _medallion(spark, sf_dir, "place-names", records.place_names_hits(spark, sf_dir))


def medallion_stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the load timestamp, which differs from run to run."""
    return _medallion(spark, sf_dir, "stories", records.stories_hits(spark, sf_dir)).drop("CreatedOn")


def gold_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold as a topic's own function of silver."""

    def by_kind(silver: DataFrame) -> DataFrame:
        return silver.groupBy("Kind", "Active").agg(
            F.count("*").alias("n_rows"), F.countDistinct("Id").alias("n_areas"), F.max("Sort").alias("last")
        )

    hits = records.areas_hits(spark, sf_dir)
    return _medallion(spark, sf_dir, "areas", hits, topic_options={"areas": {"gold_fn": by_kind}})


def replaced_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layer that refuses another schema, and takes a wider one when asked to."""
    path = layer_path(records.scratch_dir(spark), "orders", "silver")
    orders = table(spark, sf_dir, "orders")
    first = orders.selectExpr("cast(o_custkey as int) as customer", "cast(o_totalprice as float) as total")
    write_table(first.limit(10), path)
    refused = []
    for other in (first.selectExpr("cast(customer as string) as customer", "total"), first.drop("total"), orders):
        try:
            write_table(other, path)
        except SchemaChange as change:
            refused.append(str(change).removeprefix(path))
    write_table(orders.selectExpr("o_totalprice as total", "o_custkey as customer", "o_orderkey as id"), path, schema_change="widen")
    return read_table(spark, path).select("id", "customer", "total", F.lit(len(refused)).alias("refused"))


def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the run of a topic has counted, bad lines and a name that no record has included."""
    root = records.scratch_dir(spark)
    bad = spark.range(3).selectExpr("concat('{\"_id\": ', id) AS value")
    records.hit_lines(records.stories_hits(spark, sf_dir)).unionByName(bad).write.text(f"{root}/export")
    run_topics(spark, {"stories": f"{root}/export"}, root, rejects=True)
    found = read_table(spark, layer_path(root, "stories", "report"))
    return found.select("metric", F.coalesce("name", F.lit("")).alias("column_name"), "value")


def sibling_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregates of two levels of arrays and a sibling, without their product."""
    return aggregate_unpacked(
        records.sibling_hits(spark, sf_dir),
        ["_source.lang"],
        {
            "n_rows": ("count", None),
            "n_words": ("count", "_source.lines.words"),
            "sum_chars": ("sum", "_source.lines.n_chars"),
            "sum_numbers": ("sum", "_source.numbers"),
            "last_number": ("max", "_source.numbers"),
            "first_word": ("min", "_source.lines.words"),
            "mean_chars": ("avg", "_source.lines.n_chars"),
        },
        names={"_source.lang": "lang"},
    )


def sibling_aggregates_by_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a group key inside an array, which alone is exploded."""
    return aggregate_unpacked(
        records.sibling_hits(spark, sf_dir),
        ["_source.lines.number"],
        {"n_rows": ("count", None), "sum_chars": ("sum", "_source.lines.n_chars"), "sum_numbers": ("sum", "_source.numbers")},
        names={"_source.lines.number": "line"},
    )


def gold_from_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold aggregated from nested hits, beside a silver layer of all rows."""

    def by_status(hits: DataFrame) -> DataFrame:
        return aggregate_unpacked(
            hits,
            ["_source.area_id"],
            {
                "n_rows": ("count", None),
                "n_examples": ("count", "_source.periods.examples.nhle_id"),
                "sum_priority": ("sum", "_source.periods.examples.priority"),
                "last_period": ("max", "_source.periods.sort"),
            },
            names={"_source.area_id": "area"},
        )

    exports = {
        "areas": records.areas_hits(spark, sf_dir),
        "area-by-numbers": records.area_by_numbers_hits(spark, sf_dir),
    }
    options = {"area-by-numbers": {"gold_fn": by_status, "gold_from": "hits"}}
    return run_topics(spark, exports, records.scratch_dir(spark), topic_options=options)["area-by-numbers"]


def _keyed_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits with an object whose keys are data, landed as text and read as a map."""
    root = records.scratch_dir(spark)
    records.keyed_lines(spark, sf_dir).write.text(f"{root}/export")
    bronze = layer_path(root, "orders", "bronze")
    land_bronze(spark, f"{root}/export", bronze)
    schema = objects_as_maps(read_hits(spark, bronze).schema, ["_source.facts"])
    return read_hits(spark, bronze, schema=schema)


def map_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each key of an object whose keys are data."""
    rows = unpack(_keyed_hits(spark, sf_dir), maps=True)
    return rename_columns(rows, {"_id": "id", "_source.facts.key": "fact", "_source.facts.value": "value"})


def map_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same object as a bounded list of columns."""
    rows = pivot_map(flatten(_keyed_hits(spark, sf_dir)), "_source.facts", limit=20)
    names = {f"_source.facts.{k}": k.replace("-", "_").replace(" ", "_").lower() for k in records.FACT_KEYS}
    return rename_columns(rows, {"_id": "id", **names})


# --- topics -------------------------------------------------------------------------


def topic_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate(records.areas_hits(spark, sf_dir), TOPICS["areas"])


def topic_area_by_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate(
        records.area_by_numbers_hits(spark, sf_dir),
        TOPICS["area-by-numbers"],
        lookups={"areas": topic_areas(spark, sf_dir)},
    )


def topic_grant_aided_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = curate(records.grant_aided_places_hits(spark, sf_dir), TOPICS["grant-aided-places"])
    return rename_columns(rows, {"_source.reviewed_by": "passed_through"})


def topic_historic_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate(records.historic_places_hits(spark, sf_dir), TOPICS["historic-places"])


def topic_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate(records.images_hits(spark, sf_dir), TOPICS["images"])


def topic_place_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate(records.place_names_hits(spark, sf_dir), TOPICS["place-names"])


def topic_stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the load timestamp, which differs from run to run."""
    return curate(records.stories_hits(spark, sf_dir), TOPICS["stories"]).drop("CreatedOn")


QUERIES: dict[str, Query] = {
    "flatten_structs": flatten_structs,
    "array_columns_explode": array_columns_explode,
    "explode_cross_product": explode_cross_product,
    "explode_empty_null": explode_empty_null,
    "unpack_two_level": unpack_two_level,
    "unpack_conversations": unpack_conversations,
    "unpack_json_events": unpack_json_events,
    "unpack_drop_first": unpack_drop_first,
    "add_replace_columns": add_replace_columns,
    "tolerant_drop": tolerant_drop,
    "bulk_rename": bulk_rename,
    "fixed_select": fixed_select,
    "literal_columns": literal_columns,
    "case_like": case_like,
    "isin_infinity": isin_infinity,
    "date_range_bounds": date_ranges,
    "concat_key": concat_key,
    "url_builder": url_builder,
    "wkt_point": wkt_point,
    "hashkey": hashkey,
    "round_cast_int": round_cast_int,
    "id_to_int": id_to_int,
    "seconds_to_hms": seconds_to_hms,
    "load_timestamp": load_timestamps,
    "lookup_left_join": lookup_with_fan_out,
    "lookup_hot_key": lookup_hot_key,
    "lookup_bucketed": lookup_bucketed,
    "audited_keys": audited_keys,
    "unpack_hot_record": unpack_hot_record,
    "bronze_roundtrip": bronze_roundtrip,
    "mixed_fields": mixed_fields,
    "rejected_hits": rejected_hits,
    "conflicting_hits": conflicting_hits,
    "multi_line_documents": multi_line_documents,
    "indented_documents": indented_documents,
    "compact_documents": compact_documents,
    "silver_gold_roundtrip": silver_gold_roundtrip,
    "gold_aggregate": gold_aggregate,
    "medallion_areas": medallion_areas,
    "medallion_area_by_numbers": medallion_area_by_numbers,
    "medallion_grant_aided_places": medallion_grant_aided_places,
    "medallion_historic_places": medallion_historic_places,
    "medallion_images": medallion_images,
    "medallion_place_names": medallion_place_names,
    "medallion_stories": medallion_stories,
    "replaced_layer": replaced_layer,
    "run_report": run_report,
    "sibling_aggregates": sibling_aggregates,
    "sibling_aggregates_by_element": sibling_aggregates_by_element,
    "gold_from_hits": gold_from_hits,
    "map_entries": map_entries,
    "map_pivot": map_pivot,
    "topic_areas": topic_areas,
    "topic_area_by_numbers": topic_area_by_numbers,
    "topic_grant_aided_places": topic_grant_aided_places,
    "topic_historic_places": topic_historic_places,
    "topic_images": topic_images,
    "topic_place_names": topic_place_names,
    "topic_stories": topic_stories,
}
