"""Readers and writers, checked by laying whole tables down and reading them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.config import PipelineConfig, QualityRule
from sediment.operators import quality
from sediment.operators.events import from_messages
from sediment.plans.layers import RunContext, process_table, run_bronze, run_gold, run_silver
from sediment.plans.queries.columns import FEED_CHECKED, FEED_SPARK, FEED_SPEC
from sediment.plans.queries.registry import query, table
from sediment.plans.runs import run_layers
from sediment.session import materialize, scratch_path
from sediment.sources import manifest, readers, writers

CUSTOMER_SCHEMA = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
CUSTOMER_SQL = "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer"


def _landed(spark: SparkSession, d: str, fmt: str, name: str = "customer") -> str:
    path = scratch_path(spark, f"landing-{fmt}")
    writers.write_landing(table(spark, d, name), path, fmt)
    return path


@query(
    "read_csv_inferred",
    """select cast(c_custkey as integer) as c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
              'int string int double string' as inferred from customer""",
)
def read_csv_inferred(spark: SparkSession, d: str) -> DataFrame:
    """The columns as inferred, with the kinds that were inferred for them."""
    df = readers.read_source(spark, _landed(spark, d, "csv"), "csv")
    return df.withColumn("inferred", F.concat_ws(" ", *[F.typeof(c) for c in df.columns]))


@query("read_json", CUSTOMER_SQL)
def read_json(spark: SparkSession, d: str) -> DataFrame:
    return readers.read_source(spark, _landed(spark, d, "json"), "json", CUSTOMER_SCHEMA)


@query("read_orc", CUSTOMER_SQL)
def read_orc(spark: SparkSession, d: str) -> DataFrame:
    return readers.read_source(spark, _landed(spark, d, "orc"), "orc")


@query("read_parquet", "select event_id, ts, user_id, event_type, value, props from events")
def read_parquet(spark: SparkSession, d: str) -> DataFrame:
    return readers.read_source(spark, _landed(spark, d, "parquet", "events"), "parquet")


@query("read_file_pattern", "select p_partkey, p_name, p_retailprice from part")
def read_file_pattern(spark: SparkSession, d: str) -> DataFrame:
    """A folder that holds files of two formats; the pattern picks one."""
    path = scratch_path(spark, "mixed")
    parts = table(spark, d, "part").select("p_partkey", "p_name", "p_retailprice")
    writers.write_landing(parts, path, "csv")
    writers.write_landing(parts, path, "json")
    return readers.read_source(spark, path, "csv", "p_partkey long, p_name string, p_retailprice double", "*.csv")


@query("read_explicit_schema", "select c_custkey, c_name, cast(c_acctbal as varchar) as c_acctbal from customer")
def read_explicit_schema(spark: SparkSession, d: str) -> DataFrame:
    customers = table(spark, d, "customer").select("c_custkey", "c_name", F.col("c_acctbal").cast("string").alias("c_acctbal"))
    path = scratch_path(spark, "typed")
    writers.write_landing(customers, path, "csv")
    schema = {
        "type": "struct",
        "fields": [
            {"name": "c_custkey", "type": "long", "nullable": True, "metadata": {}},
            {"name": "c_name", "type": "string", "nullable": True, "metadata": {}},
            {"name": "c_acctbal", "type": "string", "nullable": True, "metadata": {}},
        ],
    }
    return readers.read_source(spark, path, "csv", schema)


def _strict(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, d, "orders").select(
        F.expr(
            "concat('{\"o_orderkey\": ', if(o_orderstatus = 'P', concat('x', o_orderkey), string(o_orderkey)), "
            "', \"o_totalprice\": ', o_totalprice, '}')"
        ).alias("value")
    )
    path = scratch_path(spark, "lines")
    lines.write.text(path)
    typed = readers.read_strict(spark, path, "json", "o_orderkey long, o_totalprice double")
    return readers.split_corrupt(materialize(typed, "typed"))


@query("read_strict_good", "select o_orderkey, o_totalprice from orders where o_orderstatus <> 'P'")
def read_strict_good(spark: SparkSession, d: str) -> DataFrame:
    return _strict(spark, d)[0]


@query(
    "read_strict_quarantined",
    """select cast(regexp_extract(o_key, '[0-9]+') as bigint) as o_orderkey, 'malformed' as reason
       from (select 'x' || o_orderkey as o_key from orders where o_orderstatus = 'P')""",
)
def read_strict_quarantined(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "layer")
    writers.append_quarantine(_strict(spark, d)[1], path, "malformed")
    kept = spark.read.parquet(writers.quarantine_path(path, "malformed"))
    return kept.select(
        F.regexp_extract("raw_record", "x([0-9]+)", 1).cast("bigint").alias("o_orderkey"),
        F.element_at("reasons", 1).alias("reason"),
    )


@query(
    "layer_write_read",
    """select c_custkey, c_mktsegment, 2::bigint as copies from customer""",
)
def layer_write_read(spark: SparkSession, d: str) -> DataFrame:
    """Bronze appends: two runs leave two copies. The layer is read by its pipeline config."""
    config = PipelineConfig("customers", "landing", scratch_path(spark, "target"), "parquet")
    customers = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    for _ in range(2):
        writers.write_bronze(customers, config.layer_path("bronze"), config.storage_format, ["c_mktsegment"])
    return (
        readers.read_layer(spark, config, "bronze")
        .groupBy("c_custkey", "c_mktsegment")
        .agg(F.count("*").alias("copies"))
    )


@query(
    "partition_overwrite",
    """select o_orderkey, o_orderstatus, case when o_orderstatus = 'F' then o_totalprice * 2 else o_totalprice end as price from orders""",
)
def partition_overwrite(spark: SparkSession, d: str) -> DataFrame:
    """Silver overwrite of the partitions present in the frame; the others stay."""
    path = scratch_path(spark, "silver")
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("price"))
    writers.write_silver(rows, path, partition_by=["o_orderstatus"])
    doubled = rows.filter("o_orderstatus = 'F'").withColumn("price", F.col("price") * 2)
    writers.write_silver(doubled, path, partition_by=["o_orderstatus"], only_present_partitions=True)
    return spark.read.parquet(path)


@query(
    "partition_by_date",
    "select cast(cast(ts as date) as varchar) as ingestion_date, count(*) as n from events group by 1",
)
def partition_by_date(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "dated")
    rows = writers.with_partition_date(table(spark, d, "events"), "ingestion_date", F.col("ts"))
    writers.write_bronze(rows, path, partition_by=writers.layer_partitions(rows, "bronze"))
    stored = spark.read.parquet(path)
    return stored.groupBy(F.col("ingestion_date").cast("string").alias("ingestion_date")).agg(F.count("*").alias("n"))


@query("catalog_tables", "select o_orderkey, c_name from orders join customer on o_custkey = c_custkey")
def catalog_tables(spark: SparkSession, d: str) -> DataFrame:
    for name in ("orders", "customer"):
        writers.write_gold(
            table(spark, d, name), f"default.sediment_{name}", path=scratch_path(spark, f"catalog-{name}")
        )
    orders, customer = readers.read_tables(spark, ["default.sediment_orders", "default.sediment_customer"])
    return orders.join(customer, F.expr("o_custkey = c_custkey")).select("o_orderkey", "c_name")


@query(
    "file_facts",
    """select l_returnflag || l_linestatus as folder, count(*) as row_count, count(distinct l_orderkey // 1000)::bigint as files,
              31 * count(*) as file_size from lineitem group by 1""",
)
def file_facts(spark: SparkSession, d: str) -> DataFrame:
    """Files of 31 bytes a line (with its end), one for each pair of flags and thousand orders: tasks and files grow with the table."""
    path = scratch_path(spark, "facts")
    lines = table(spark, d, "lineitem").selectExpr(
        "concat(l_returnflag, l_linestatus) as folder",
        "l_orderkey div 16000 as block",
        "l_orderkey div 1000 as part",
        "lpad(concat_ws('-', l_orderkey, l_linenumber), 30, '.') as value",
    )
    # A listing task gets a block's folders together.
    writers.write_lines(lines, path, "value", ["folder", "block", "part"], ["folder", "block"])
    # Facts are of files, so no column is worked out from the folders' names.
    facts = manifest.file_facts(spark.read.option("recursiveFileLookup", "true").text(path))
    return facts.groupBy(F.regexp_extract("file_path", "folder=([^/]*)/", 1).alias("folder")).agg(
        F.sum("row_count").alias("row_count"), F.count_distinct("file_path").alias("files"), F.sum("file_size").alias("file_size")
    )


@query(
    "manifest_reconcile",
    """select o_orderstatus, count(*) as row_count, case when o_orderstatus = 'P' then count(*) + 1 else count(*) end as manifest_count,
              o_orderstatus <> 'P' as counts_agree from orders group by 1""",
)
def manifest_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """Sidecars announce the rows of each status folder; one of them is off by one."""
    path, sidecars = scratch_path(spark, "announced"), scratch_path(spark, "sidecars")
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    writers.write(orders, path, partition_by=["o_orderstatus"])
    stored = spark.read.parquet(path)
    told = (
        manifest.file_facts(stored)
        .withColumn("off", F.expr("if(row_number() over (partition by file_path like '%o_orderstatus=P%' order by file_name) = 1 and file_path like '%o_orderstatus=P%', 1, 0)"))
        .selectExpr("file_path as object_path", "row_count + off as record_count", "file_size")
    )
    told.write.json(sidecars)
    manifests = spark.read.schema(manifest.MANIFEST_SCHEMA).json(sidecars)
    named = stored.withColumn("source_file", F.expr("_metadata.file_path"))
    attached = manifest.attach_manifest(named, manifests)
    per_file = attached.groupBy("o_orderstatus", "source_file").agg(
        F.count("*").alias("row_count"), F.max("manifest_record_count").alias("manifest_count")
    )
    return per_file.groupBy("o_orderstatus").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("manifest_count").alias("manifest_count"),
        (F.sum("row_count") == F.sum("manifest_count")).alias("counts_agree"),
    )


@query(
    "dataset_version",
    """select 'orders' as dataset, '1' as version, count(*) as row_count,
              cast(min(o_orderkey) as varchar) as min_key, cast(max(o_orderkey) as varchar) as max_key, 6::bigint as column_count from orders""",
)
def dataset_version(spark: SparkSession, d: str) -> DataFrame:
    row = manifest.dataset_version(table(spark, d, "orders"), "orders", "1")
    stats = F.from_json("stats", "array<struct<column_name:string,null_count:long,min_value:string,max_value:string>>")
    key = F.filter(stats, lambda s: s["column_name"] == "o_orderkey")[0]
    return row.select(
        "dataset",
        "version",
        "row_count",
        key["min_value"].alias("min_key"),
        key["max_value"].alias("max_key"),
        F.size(stats).cast("bigint").alias("column_count"),
    )


@query(
    "dataset_profile",
    """select 'event_id' as column_name, count(*) as row_count, 0::bigint as null_count, cast(min(event_id) as varchar) as min_value, cast(max(event_id) as varchar) as max_value from events
       union all select 'event_type', count(*), 0, min(event_type), max(event_type) from events
       union all select 'user_id', count(*), 0, cast(min(user_id) as varchar), cast(max(user_id) as varchar) from events""",
)
def dataset_profile(spark: SparkSession, d: str) -> DataFrame:
    return manifest.column_profile(table(spark, d, "events"), ["event_id", "event_type", "user_id"])


@query(
    "dataset_sketches",
    """select 'event_id' as column_name, count(*) as row_count, 0::bigint as null_count, true as distinct_close, true as median_close from events
       union all select 'user_id', count(*), 0, true, true from events
       union all select 'value', count(*), count(*) filter (value > 80), true, true from events""",
)
def dataset_sketches(spark: SparkSession, d: str) -> DataFrame:
    """Sketches of two versions by event type are stored and merged; their answers are held against exact ones."""
    events = table(spark, d, "events").selectExpr("event_id", "user_id", "if(value > 80, null, value) as value", "event_type")
    path, names = scratch_path(spark, "sketches"), ["event_id", "user_id", "value"]
    for version, part in (("1", "event_id % 2 = 0"), ("2", "event_id % 2 = 1")):
        manifest.sketch_profile(events.filter(part), version, names, ["event_type"]).write.mode("append").parquet(path)
    merged = manifest.merged_profile(spark.read.parquet(path), [0.5])
    exact = []
    for name in names:
        median = merged.filter(F.col("column_name") == name).select(F.col("quantiles")[0]).scalar()
        exact.append(
            events.agg(
                F.lit(name).alias("column_name"), F.count_distinct(name).alias("distinct"),
                (F.count_if(F.col(name) <= median) / F.count(name)).alias("rank"),
            )
        )
    held = merged.join(exact[0].unionByName(exact[1]).unionByName(exact[2]), "column_name")
    off = F.abs(F.col("distinct_count") - F.col("distinct")) <= manifest.DISTINCT_ERROR * F.col("distinct")
    near = F.abs(F.col("rank") - 0.5) <= manifest.RANK_ERROR
    return held.select("column_name", "row_count", "null_count", off.alias("distinct_close"), near.alias("median_close"))


@query(
    "quality_results_stored",
    """select 'orders' as table_name, 'total' as rule_id, 'row_count' as metric, count(*)::double as value from orders""",
)
def quality_results_stored(spark: SparkSession, d: str) -> DataFrame:
    """Results appended as JSON rows and read back."""
    path = scratch_path(spark, "results")
    rules = [QualityRule("total", "row_count", {"min_threshold": 1})]
    results = quality.evaluate(table(spark, d, "orders"), rules, "orders")
    writers.append_quality_results(results, path, {"execution_time": F.lit("2024-02-01T00:00:00")})
    stored = spark.read.parquet(path)
    body = F.from_json("results", "rule_id string, metric string, value double")
    return stored.select("table_name", body["rule_id"].alias("rule_id"), body["metric"].alias("metric"), body["value"].alias("value"))


AS_OF = "2024-02-01 00:00:00"


def _context() -> RunContext:
    return RunContext("customers", "batch-1", F.lit(AS_OF).cast("timestamp"))


@query(
    "layers_end_to_end",
    """select trim(upper(c_mktsegment)) as segment, count(*) as customers, cast(sum(cast(c_acctbal as decimal(18,2))) as double) as balance
       from customer where c_acctbal is not null group by 1""",
)
def layers_end_to_end(spark: SparkSession, d: str) -> DataFrame:
    """Landing csv (written twice, so with copies) through bronze and silver to a gold table."""
    root = scratch_path(spark, "layers")
    for _ in range(2):
        writers.write_landing(table(spark, d, "customer"), f"{root}/landing", "csv")
    run_bronze(
        spark,
        {
            "source_configurations": [
                {
                    "name": "customers",
                    "format": "csv",
                    "landing_zone": {"path": f"{root}/landing", "file_pattern": "*.csv"},
                    "schema_validation": {"schema": CUSTOMER_SCHEMA, "mode": "strict", "on_error": "quarantine"},
                    "processing": {"clean_column_names": True, "handle_duplicates": "drop_exact"},
                    "encrypted_columns": ["c_name"],
                    "quality_checks": [
                        {"type": "row_count", "min_threshold": 1},
                        {"type": "null_check", "columns": ["c_custkey"], "max_nulls_percentage": 0},
                    ],
                    "bronze_zone": {"path": f"{root}/bronze", "partition_by": ["ingestion_date"]},
                }
            ]
        },
        _context(),
    )
    run_silver(
        spark,
        {
            "source_configurations": [
                {
                    "name": "customers",
                    "input": {"path": f"{root}/bronze"},
                    "transformations": [
                        {"type": "standardize_names", "columns": ["c_mktsegment"]},
                        {"type": "cast", "target_col": "balance", "source_col": "c_acctbal", "cast_type": "decimal(18,2)"},
                    ],
                    "quality_checks": [{"rule": "business_rule", "params": {"condition": "c_custkey >= 0"}}],
                    "output": {"path": f"{root}/silver", "partition_by": ["c_nationkey"]},
                }
            ]
        },
        _context(),
    )
    silver = spark.read.parquet(f"{root}/silver")
    run_gold(
        spark,
        {
            "aggregations": [
                {
                    "name": "segments",
                    "source_table": "silver_customers",
                    "time_window": [
                        {
                            "metrics": [
                                {"name": "customers", "expr": "count(*)"},
                                {"name": "balance", "expr": "sum(balance)", "type": "double"},
                            ]
                        }
                    ],
                    "dimensions": ["c_mktsegment as segment"],
                    "quality_checks": [{"type": "row_count", "min_threshold": 1}],
                    "output": {"table": "segments", "path": f"{root}/gold", "mode": "merge", "merge_key": ["segment"]},
                }
            ]
        },
        _context(),
        {"silver_customers": silver},
    )
    return spark.read.parquet(f"{root}/gold/v1").select("segment", "customers", "balance")


@query(
    "process_table_by_layer",
    "select user_id, count(*) as purchases, null::double as data_quality_score from events where event_type = 'purchase' group by 1",
)
def process_table_by_layer(spark: SparkSession, d: str) -> DataFrame:
    root = scratch_path(spark, "process")
    writers.write_landing(table(spark, d, "events"), f"{root}/landing/events", "parquet")
    process_table(spark, "bronze.events", None, f"{root}/bronze", landing_root=f"{root}/landing", context=_context())
    spark.read.parquet(f"{root}/bronze").createOrReplaceTempView("bronze_events")
    process_table(spark, "silver.purchases", "select * from bronze_events where event_type = 'purchase'", f"{root}/silver")
    spark.read.parquet(f"{root}/silver").createOrReplaceTempView("silver_purchases")
    text = "select user_id, count(*) as purchases from silver_purchases where quality_check_passed is null group by user_id"
    process_table(spark, "gold.purchases", text, f"{root}/gold")
    return spark.read.parquet(f"{root}/gold").select("user_id", "purchases", F.col("data_quality_score").cast("double"))


@query(
    "layer_quarantine_action",
    """select c_custkey, case when c_acctbal < 0 then 'people.numeric.c_acctbal:c_acctbal' else 'written' end as outcome from customer""",
)
def layer_quarantine_action(spark: SparkSession, d: str) -> DataFrame:
    """A failed rule whose action is quarantine moves its rows aside; the others are written."""
    root = scratch_path(spark, "actions")
    writers.write_landing(table(spark, d, "customer").select("c_custkey", "c_acctbal"), f"{root}/landing", "json")
    checks = {
        "rule_id": "people",
        "rules": {"numeric": {"type": "numeric", "rules": [{"column": "c_acctbal", "min_value": 0}], "severity": "high"}},
        "actions": {"on_failure": {"high": "quarantine"}},
    }
    item = {
        "name": "people",
        "format": "json",
        "landing_zone": {"path": f"{root}/landing"},
        "schema_validation": {"schema": {"c_custkey": "long", "c_acctbal": "double"}},
        "quality": checks,
        "bronze_zone": {"path": f"{root}/bronze"},
    }
    run_bronze(spark, {"source_configurations": [item]}, _context())
    written = spark.read.parquet(f"{root}/bronze").select("c_custkey", F.lit("written").alias("outcome"))
    aside = spark.read.parquet(writers.quarantine_path(f"{root}/bronze", "failed")).select("c_custkey", F.array_join("reasons", ",").alias("outcome"))
    return written.unionByName(aside)


@query(
    "layer_run_events",
    """select 'pipeline_complete' as event_type, 'customers' as table_name, 'INFO' as severity, count(*) as written from customer
       union all select 'quality_check_failure', 'orders', 'ERROR', 0 from orders having count(*) < 1000000000000""",
)
def layer_run_events(spark: SparkSession, d: str) -> DataFrame:
    """Two sources, one held back by its row count: the run's events, and what was written."""
    root = scratch_path(spark, "events")
    items = []
    for name, source, least in (("customers", "customer", 1), ("orders", "orders", 10**12)):
        writers.write_landing(table(spark, d, source), f"{root}/landing/{name}", "parquet")
        items.append(
            {
                "name": name,
                "format": "parquet",
                "landing_zone": {"path": f"{root}/landing/{name}"},
                "quality_checks": [{"type": "row_count", "min_threshold": least}],
                "bronze_zone": {"path": f"{root}/bronze/{name}"},
            }
        )
    context = RunContext("p", "b", F.lit(AS_OF).cast("timestamp"), events_path=f"{root}/topics")
    run_bronze(spark, {"source_configurations": items}, context)
    found = from_messages(spark.read.schema("key string, value string").json(f"{root}/topics"))
    rows = spark.read.parquet(f"{root}/bronze/customers").agg(F.count("*")).scalar()
    written = F.when(F.col("event_type") == "pipeline_complete", rows).otherwise(F.lit(0))
    return found.select("event_type", "table_name", "severity", written.alias("written"))


# Parts through the layers: what the feed check accepts, enriched by size class, sold lines per class.
SILVER_MAPPING = {
    "source_fields": {"brand": {"type": "string", "required": True}, "size": {"type": "int", "required": True}},
    "transformations": [
        {"type": "standardize_names", "columns": ["kind"]},
        {
            "type": "enrich_location",
            "config": {
                "input_columns": {"size_code": "size"},
                "output_columns": {"class": "size_class", "weight": "weight"},
                "reference_data": "sizes",
            },
        },
    ],
    "target_fields": {
        "part": {"source": "part", "type": "string"},
        "brand": {"source": "brand", "type": "string"},
        "kind": {"source": "kind", "type": "string"},
        "size_class": {"source": "size_class", "type": "string"},
        "weight": {"source": "weight", "type": "double"},
        "update_date": {"type": "date", "transform": "current_date"},
    },
}

GOLD_MAPPING = {
    "source_tables": [{"name": "stock"}, {"name": "sold"}],
    "joins": [{"type": "left", "tables": ["stock", "sold"], "condition": "sold.part = stock.part"}],
    "aggregations": [
        {
            "name": "turnover",
            "group_by": ["stock.brand", "stock.size_class"],
            "metrics": [
                {"name": "parts", "expression": "count(distinct stock.part)", "type": "bigint"},
                {"name": "lines", "expression": "count(sold.quantity)", "type": "bigint"},
                {"name": "heaviest", "expression": "max(stock.weight)", "type": "double"},
            ],
        }
    ],
    "target_fields": {
        "maker": {"source": "turnover.brand", "type": "string"},
        "class": {"source": "turnover.size_class", "type": "string"},
        "distinct_parts": {"source": "turnover.parts", "type": "bigint"},
        "lines_sold": {"source": "turnover.lines", "type": "bigint"},
        "heaviest": {"source": "turnover.heaviest", "type": "double"},
    },
}


@query(
    "part_layers",
    f"""select upper(brand) as maker, case when p_size < 20 then 'small' else 'large' end as class, count(distinct p_partkey) as distinct_parts,
              count(l_quantity) as lines_sold, max(p_size * 0.25)::double as heaviest
        from ({FEED_CHECKED}) f join part on p_partkey = cast(substr(f.code, 3) as bigint)
        left join lineitem on l_partkey = p_partkey
        where reasons = '' and p_size <> 17 group by 1, 2""",
)
def part_layers(spark: SparkSession, d: str) -> DataFrame:
    """Mapping, validation in bronze and silver, enrichment, checks and gold metrics, landing to gold."""
    root = scratch_path(spark, "parts")
    parts = table(spark, d, "part")
    parts.createOrReplaceTempView("part")
    writers.write_landing(spark.sql(FEED_SPARK), f"{root}/landing", "csv")
    sizes = parts.selectExpr(
        "p_size as size_code", "if(p_size < 20, 'small', 'large') as size_class", "p_size * 0.25D as weight"
    ).distinct()
    sold = table(spark, d, "lineitem").selectExpr("concat('P-', l_partkey) as part", "l_quantity as quantity")
    zones = {layer: f"{root}/{layer}" for layer in ("bronze", "silver", "gold")}
    spec = {
        "pipeline_name": "parts",
        "layers": {
            "bronze": {
                "source": {"format": "csv", "path": f"{root}/landing", "pattern": "*.csv"},
                "target": {"path": zones["bronze"], "partition_by": ["ingestion_date"]},
                "schema_validation": {"mode": "strict", "on_error": "quarantine"},
            },
            "silver": {"source": {"path": zones["bronze"]}, "target": {"path": zones["silver"], "partition_by": ["size_class"]}},
            "gold": {"source": {"path": zones["silver"]}, "target": {"path": zones["gold"]}},
        },
    }
    checks = {
        "silver": {
            "rules": {
                "filled": {"type": "completeness", "columns": ["part", "size_class"], "severity": "high"},
                "single": {"type": "uniqueness", "columns": [["part"]], "severity": "high"},
                "weights": {"type": "numeric", "rules": [{"column": "weight", "min_value": 0, "max_value": 20}]},
            },
        },
        "gold": {"rules": {"lines": {"type": "numeric", "rules": [{"column": "lines_sold", "min_value": 0}]}}},
    }
    gold = {**GOLD_MAPPING, "source_tables": [{"name": "stock", "path": zones["silver"]}, {"name": "sold"}]}
    outcomes = run_layers(
        spark,
        spec,
        {"bronze": FEED_SPEC, "silver": SILVER_MAPPING, "gold": gold},
        checks,
        {"sizes": sizes, "sold": sold},
        _context(),
    )
    assert [o.status for o in outcomes] == ["written"] * 3, outcomes
    return spark.read.parquet(zones["gold"]).select("maker", "class", "distinct_parts", "lines_sold", "heaviest")


@query(
    "silver_required_fields",
    """select p_partkey, p_size, case when p_size is null then 'p_size:required' else 'written' end as outcome,
              case when p_size is null then null else (select count(*) = 0 from part where p_size > 40) end as passed
       from (select p_partkey, nullif(p_size, 13) as p_size from part)""",
)
def silver_required_fields(spark: SparkSession, d: str) -> DataFrame:
    """Rows without a required field are kept out of silver; a failed rule that is only logged shows in the flag."""
    root = scratch_path(spark, "required")
    parts = table(spark, d, "part").selectExpr("p_partkey", "nullif(p_size, 13) as p_size")
    writers.write(parts, f"{root}/bronze")
    item = {
        "name": "sizes",
        "input": {"path": f"{root}/bronze"},
        "mapping": {
            "source_fields": {"p_size": {"type": "int", "required": True}},
            "target_fields": {n: {"source": n, "type": t} for n, t in (("p_partkey", "bigint"), ("p_size", "int"))},
        },
        "quality": {
            "rule_id": "sizes",
            "rules": {"limit": {"type": "numeric", "rules": [{"column": "p_size", "max_value": 40}], "severity": "low"}},
            "actions": {"on_failure": {"low": "log"}},
        },
        "output": {"path": f"{root}/silver"},
    }
    run_silver(spark, {"source_configurations": [item]}, _context())
    written = spark.read.parquet(f"{root}/silver").select(
        "p_partkey", "p_size", F.lit("written").alias("outcome"), F.col("quality_check_passed").alias("passed")
    )
    out = spark.read.parquet(writers.quarantine_path(f"{root}/silver", "invalid"))
    reasons = F.array_join("reasons", ",").alias("outcome")
    return written.unionByName(out.select("p_partkey", "p_size", reasons, F.lit(None).cast("boolean").alias("passed")))
