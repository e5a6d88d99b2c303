"""Column transforms, field mappings, validation, protection, schema checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.config import ColumnTransformation
from sediment.functions import protect, text
from sediment.operators import mapping
from sediment.plans.layers import silver_transform
from sediment.plans.queries.registry import query, table
from sediment.session import materialize
from sediment.sources.manifest import column_profile


@query(
    "columns_direct_cast_expression",
    """select p_partkey, p_name as title, cast(cast(p_retailprice as decimal(18,2)) as double) as price,
              try_cast(replace(p_brand, 'Brand#', case when p_size > 25 then '' else 'x' end) as integer) as brand_number,
              p_size * 2 as double_size, p_size * 2 + 1 as next_size from part""",
)
def columns_direct_cast_expression(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part").withColumn(
        "brand_text", F.expr("replace(p_brand, 'Brand#', if(p_size > 25, '', 'x'))")
    )
    steps = [
        ColumnTransformation("title", "direct", "p_name"),
        ColumnTransformation("price", "cast", "p_retailprice", "decimal(18,2)"),
        ColumnTransformation("brand_number", "cast", "brand_text", "int", on_error="null"),
        ColumnTransformation("double_size", "expression", expression="p_size * 2"),
        ColumnTransformation("next_size", "expression", expression="double_size + 1"),
    ]
    return mapping.apply_transformations(parts, steps).select(
        "p_partkey", "title", F.col("price").cast("double").alias("price"), "brand_number", "double_size", "next_size"
    )


@query(
    "predicate_filter",
    "select event_id, user_id, value from events where value > 50 and event_type in ('purchase', 'click')",
)
def predicate_filter(spark: SparkSession, d: str) -> DataFrame:
    return (
        table(spark, d, "events")
        .filter("value > 50 and event_type in ('purchase', 'click')")
        .select("event_id", "user_id", "value")
    )


@query(
    "missing_values",
    """select count(*) filter (where v is null) as null_values, count(*) filter (where isnan(v)) as nan_values,
              count(*) filter (where v is null or isnan(v)) as missing_values
       from (select case when event_type = 'view' then null when event_type = 'click' then 'nan'::double else value end as v
             from events)""",
)
def missing_values(spark: SparkSession, d: str) -> DataFrame:
    from sediment.operators.quality import missing

    events = table(spark, d, "events").selectExpr(
        "case when event_type = 'view' then null when event_type = 'click' then double('nan') else value end as v"
    )
    return events.agg(
        F.count_if(missing(events, "v")).alias("null_values"),
        F.count_if(F.isnan("v")).alias("nan_values"),
        F.count_if(missing(events, "v", nan_is_missing=True)).alias("missing_values"),
    )


# A feed of parts with the first order that each was in; its faults follow from the data.
FEED = """
  select 'P-' || p_partkey as "code", p_name as "label", p_brand as "brand",
         case when p_size = 17 then null else p_type end as "kind", cast(p_size as varchar) as "size",
         substr(p_type, 1, case when p_size = 31 then 4 else 3 end) as "short",
         case when p_partkey % 10 = 4 then 'none' else cast(p_retailprice as varchar) end as "price",
         case when p_partkey % 50 = 7 then '1998-13-01 00:00' else '1998-02-03 04:05' end as "checked"
  from part"""

FEED_SPARK = FEED.replace("varchar", "string").replace('"', "`")

FEED_SPEC = {
    "source_fields": {
        "code": {"validation": {"pattern": "^P-[0-9]*[0-8]$", "on_error": "reject"}},
        "label": {"required": True, "validation": {"max_length": 9, "on_error": "truncate"}},
        "brand": {"validation": {"pattern": "^Brand#[0-9]?[0-7]$", "on_error": "quarantine"}},
        "kind": {"required": True},
        "size": {"type": "int"},
        "short": {"validation": {"length": 3, "case": "lower"}},
        "price": {"type": "double", "validation": {"on_error": "null"}},
        "checked": {"type": "timestamp", "validation": {"format": "yyyy-MM-dd HH:mm", "timezone": "UTC"}},
    },
    "target_fields": {
        "part": {"source": "code"},
        "brand": {"source": "brand", "transform": "upper"},
        "label": {"source": "label", "transform": "proper_case"},
        "kind": {"source": "kind", "transform": "lower"},
        "size": {"source": "size", "type": "int"},
        "tag": {"transform": "concat", "params": {"columns": ["short", "label"], "separator": "/"}},
        "price": {"source": "price", "type": "double"},
        "checked_at": {"source": "checked", "type": "timestamp_ntz"},
        "load_id": {"transform": "uuid4"},
    },
}

FEED_CHECKED = f"""
  select *, concat_ws(',',
      case when not regexp_matches("brand", '^Brand#[0-9]?[0-7]$') then 'brand:pattern' end,
      case when "checked" like '%-13-%' then 'checked:format' end,
      case when not regexp_matches("code", '^P-[0-9]*[0-8]$') then 'code:pattern' end,
      case when "kind" is null then 'kind:required' end,
      case when length("short") <> 3 then 'short:length' end) as reasons
  from ({FEED})"""


@query(
    "field_mapping",
    f"""select "code" as part, upper("brand") as brand, lower("kind") as kind, cast("size" as integer) as size,
              upper(substr("label", 1, 1)) || substr(split_part(substr("label", 1, 9), ' ', 1), 2)
                || case when substr("label", 1, 9) like '% %' then ' ' || upper(substr(split_part(substr("label", 1, 9), ' ', 2), 1, 1))
                        || substr(split_part(substr("label", 1, 9), ' ', 2), 2) else '' end as label,
              lower("short") || '/' || substr("label", 1, 9) as tag, try_cast("price" as double) as price,
              timestamp '1998-02-03 04:05:00' as checked_at, 'batch-1' as load_id
       from ({FEED_CHECKED}) where reasons = ''""",
)
def field_mapping(spark: SparkSession, d: str) -> DataFrame:
    fields = mapping.FieldMapping.from_spec(FEED_SPEC)
    table(spark, d, "part").createOrReplaceTempView("part")
    accepted, _ = mapping.split_validated(materialize(fields.validate(spark.sql(FEED_SPARK)), "validated"))
    return fields.project(accepted, mapping.MappingContext(batch_id="batch-1"))


@query(
    "field_validation_quarantine",
    f"""select "code" as part, reasons, case when reasons like '%code:pattern%' then 'reject' else 'quarantine' end as action
       from ({FEED_CHECKED}) where reasons <> ''""",
)
def field_validation_quarantine(spark: SparkSession, d: str) -> DataFrame:
    fields = mapping.FieldMapping.from_spec(FEED_SPEC)
    table(spark, d, "part").createOrReplaceTempView("part")
    _, kept_out = mapping.split_validated(materialize(fields.validate(spark.sql(FEED_SPARK)), "validated"))
    return kept_out.select(F.col("code").alias("part"), F.array_join("reasons", ",").alias("reasons"), "action")


@query(
    "clean_column_names",
    'select c_custkey as "customer_key_", c_name as "full_name", c_acctbal as "balance__usd_" from customer',
)
def clean_column_names(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "customer").select(
        F.col("c_custkey").alias("customer-key!"),
        F.col("c_name").alias("full name"),
        F.col("c_acctbal").alias("balance (usd)"),
    )
    return mapping.clean_column_names(raw)


@query("protect_hash", "select doc_id, sha256(text) as text, lang, sha256(cast(n_chars as varchar)) as n_chars from documents")
def protect_hash(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents").select("doc_id", "text", "lang", "n_chars")
    return protect.protect_columns(documents, ["text", "n_chars"])


@query("protect_reversible", "select doc_id, text, true as hidden from documents")
def protect_reversible(spark: SparkSession, d: str) -> DataFrame:
    """Encrypted and decrypted again; the text between must differ from the original."""
    key = F.lit("0123456789abcdef")
    documents = table(spark, d, "documents").select("doc_id", "text", F.col("text").alias("sealed"))
    sealed = materialize(protect.protect_columns(documents, {"sealed": "aes"}, key), "sealed")
    return sealed.select(
        "doc_id",
        protect.decrypt(F.col("sealed"), key).alias("text"),
        (F.col("sealed") != F.col("text")).alias("hidden"),
    )


@query(
    "schema_differences",
    """select t.*, case when difference = 'missing' then 0 else (select count(*) from customer) end as row_count
       from (values ('c_acctbal', 'type', 'double', 'decimal(18,2)'), ('c_email', 'missing', null, 'string'),
              ('c_name', 'unexpected', 'string', null)) t(column_name, difference, actual, expected)""",
)
def schema_differences(spark: SparkSession, d: str) -> DataFrame:
    """Where a table departs from the expected schema, and how many values that concerns."""
    expected = T.StructType.fromDDL(
        "c_custkey bigint, c_nationkey int, c_acctbal decimal(18,2), c_mktsegment string, c_email string"
    )
    customers = table(spark, d, "customer")
    counts = column_profile(customers).select("column_name", (F.col("row_count") - F.col("null_count")).alias("row_count"))
    report = mapping.schema_report(spark, customers, expected).join(counts, "column_name", "left")
    return report.withColumn("row_count", F.coalesce("row_count", F.lit(0)))


@query(
    "text_names",
    """select p_partkey, trim(upper('  ' || p_name || ' ')) as standardized,
              upper(substr(split_part(p_name, ' ', 1), 1, 1)) || lower(substr(split_part(p_name, ' ', 1), 2)) || ' ' ||
              upper(substr(split_part(p_name, ' ', 2), 1, 1)) || lower(substr(split_part(p_name, ' ', 2), 2)) as proper,
              upper(p_name) as uppered, lower(p_brand) as lowered, trim('  ' || p_type || ' ') as trimmed from part""",
)
def text_names(spark: SparkSession, d: str) -> DataFrame:
    padded = F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))
    return table(spark, d, "part").select(
        "p_partkey",
        text.standardize_names(padded).alias("standardized"),
        text.proper_case(F.col("p_name")).alias("proper"),
        text.upper(F.col("p_name")).alias("uppered"),
        text.lower(F.col("p_brand")).alias("lowered"),
        text.trim(F.concat(F.lit("  "), F.col("p_type"), F.lit(" "))).alias("trimmed"),
    )


@query(
    "text_clean_documents",
    """select doc_id, regexp_replace(text, '[^\\p{L}\\p{N} ''-]', '', 'g') as cleaned,
              trim(regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'), ' ') as collapsed from documents""",
)
def text_clean_documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(
        "doc_id",
        text.remove_special_chars(F.col("text")).alias("cleaned"),
        text.clean_address(F.col("text")).alias("collapsed"),
    )


@query(
    "text_standard_name",
    """select s_suppkey, trim('Supplier' || substr(s_name, 10)) as full_name from supplier""",
)
def text_standard_name(spark: SparkSession, d: str) -> DataFrame:
    step = {
        "type": "standardize_name",
        "config": {"input_columns": ["full_name"], "operations": ["remove_special_chars", "proper_case", "trim"]},
    }
    raw = table(spark, d, "supplier").select("s_suppkey", F.concat(F.lit(" "), F.upper("s_name"), F.lit("!")).alias("full_name"))
    return silver_transform(raw, [step])


PHONES = """select c_custkey, case when c_nationkey > 12 then '+' else '' end || '(' || cast(c_nationkey as varchar) || ') '
   || cast(c_custkey as varchar) || '-' || c_mktsegment as phone,
   cast(c_custkey * 37 as varchar) || case when c_nationkey > 20 then '-' || cast(1000 + c_nationkey as varchar) else '' end as zip
   from customer"""


@query(
    "text_phone_zip",
    f"""select c_custkey, case when phone like '+%' then '+' else '' end || regexp_replace(phone, '[^0-9]', '', 'g') as phone,
              case when length(z) = 9 then substr(z, 1, 5) || '-' || substr(z, 6, 4)
                   when length(z) between 3 and 5 then lpad(z, 5, '0') end as zip
       from (select *, regexp_replace(zip, '[^0-9]', '', 'g') as z from ({PHONES}))""",
)
def text_phone_zip(spark: SparkSession, d: str) -> DataFrame:
    table(spark, d, "customer").createOrReplaceTempView("customer")
    raw = spark.sql(PHONES.replace("varchar", "string"))
    return raw.select(
        "c_custkey",
        text.clean_phone(F.col("phone")).alias("phone"),
        text.standardize_zip(F.col("zip")).alias("zip"),
    )


MAILS = """select c_custkey, case when c_nationkey = 3 then null
   else lower(c_mktsegment) || case when c_nationkey % 5 = 0 then '.' else '@' end || 'mail' || cast(c_nationkey as varchar) || '.Example.com' end as email
   from customer"""


@query(
    "text_contact_checks",
    f"""select c_custkey, email, regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}$') as email_valid,
              case when email is null or email not like '%@%' then null
                   else split_part(lower(email), '@', 2) in (select 'mail' || n_nationkey || '.example.com' from nation where n_regionkey = 1)
              end as email_domain_valid
       from ({MAILS})""",
)
def text_contact_checks(spark: SparkSession, d: str) -> DataFrame:
    table(spark, d, "customer").createOrReplaceTempView("customer")
    domains = table(spark, d, "nation").filter("n_regionkey = 1").selectExpr(
        "concat('mail', n_nationkey, '.example.com') as domain"
    )
    step = {
        "type": "validate_contact",
        "config": {
            "email_column": "email",
            "phone_column": "phone",
            "operations": ["validate_email_format", "validate_email_domain"],
        },
    }
    return silver_transform(spark.sql(MAILS.replace("varchar", "string")), [step], {"email_domains": domains})


@query(
    "silver_steps",
    """select c_custkey, trim(upper(c_name)) as c_name, n_name as nation_name,
              exists (select 1 from nation n where n.n_nationkey = c.c_nationkey and n.n_regionkey < 3) as city_state_valid
       from customer c left join nation on c_nationkey = n_nationkey""",
)
def silver_steps(spark: SparkSession, d: str) -> DataFrame:
    """Named silver steps: names, location enrichment, place check against a reference."""
    nation = table(spark, d, "nation")
    geo = nation.selectExpr("cast(n_nationkey as string) as zip", "'X' as country", "n_name as nation_name")
    places = nation.filter("n_regionkey < 3").selectExpr(
        "cast(n_nationkey as string) as city", "cast(n_nationkey as string) as state", "'X' as country"
    )
    rows = table(spark, d, "customer").selectExpr(
        "c_custkey", "c_name", "cast(c_nationkey as string) as zip_code", "cast(c_nationkey as string) as city", "'X' as country"
    )
    steps = [
        {"type": "standardize_names", "columns": ["c_name"]},
        {
            "type": "enrich_location",
            "config": {
                "input_columns": {"zip": "zip_code", "country": "country"},
                "output_columns": {"nation": "nation_name"},
                "reference_data": "geo",
            },
        },
        {
            "type": "standardize_address",
            "config": {
                "address_column": "c_name",
                "city_column": "city",
                "state_column": "zip_code",
                "zip_column": "zip_code",
                "country_column": "country",
                "reference_data": "places",
                "operations": ["validate_city_state"],
            },
        },
    ]
    out = silver_transform(rows, steps, {"geo": geo, "places": places})
    return out.select("c_custkey", "c_name", "nation_name", "city_state_valid")


@query(
    "dates_and_casts",
    """select o_orderkey, cast(cast(date_trunc('month', o_orderdate) as date) as varchar) as month,
              epoch_us(o_orderdate + interval 90 minute)::bigint // 1000000 - epoch_us(o_orderdate)::bigint // 1000000 as seconds,
              cast(cast(o_totalprice as decimal(18,2)) as double) as price, cast(cast(o_orderdate as date) as varchar) as day,
              case when o_orderstatus = 'F' then null else o_orderdate end as parsed
       from orders""",
)
def dates_and_casts(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").withColumn(
        "stamp",
        F.when(F.col("o_orderstatus") == "F", "not a date").otherwise(
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
        ),
    )
    return orders.select(
        "o_orderkey",
        F.date_trunc("month", "o_orderdate").cast("date").cast("string").alias("month"),
        text.epoch_seconds_between(F.col("o_orderdate"), F.expr("o_orderdate + interval 90 minutes")).alias("seconds"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("double").alias("price"),
        F.col("o_orderdate").cast("date").cast("string").alias("day"),
        text.parse_timestamp(F.col("stamp")).cast("timestamp_ntz").alias("parsed"),
    )


@query(
    "json_round_trip",
    """select event_id, cast(props->>'$.k' as bigint) as k, event_type from events""",
)
def json_round_trip(spark: SparkSession, d: str) -> DataFrame:
    parsed = table(spark, d, "events").select("event_id", "event_type", F.from_json("props", "k long").alias("p"))
    encoded = parsed.select("event_id", F.to_json(F.struct("event_type", "p.k")).alias("body"))
    decoded = encoded.select("event_id", F.from_json("body", "event_type string, k long").alias("b"))
    return decoded.select("event_id", "b.k", "b.event_type")


@query(
    "audit_columns",
    """select o_orderkey, 'active' as record_status, timestamp '2024-02-01 00:00:00' as processed_timestamp,
              o_totalprice > 5000 as quality_check_passed, 'batch-7' as batch_id from orders""",
)
def audit_columns(spark: SparkSession, d: str) -> DataFrame:
    as_of = F.lit("2024-02-01 00:00:00").cast("timestamp")
    df = mapping.add_audit_columns(
        table(spark, d, "orders"),
        "bronze",
        as_of,
        quality_check_passed=F.expr("o_totalprice > 5000"),
        batch_id=F.lit("batch-7"),
    )
    return df.select(
        "o_orderkey",
        "record_status",
        F.col("processed_timestamp").cast("timestamp_ntz").alias("processed_timestamp"),
        "quality_check_passed",
        "batch_id",
    )
