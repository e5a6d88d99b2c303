"""Join chains, reference look-ups, orphans, effective dates, keyed merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sediment.operators import joins
from sediment.operators.audit import active_mappings
from sediment.plans.queries.registry import query, table
from sediment.session import scratch_path
from sediment.sources import merge
from sediment.sources.merge import VersionedTable, merge_frames, merge_partitions, upsert_frames
from sediment.sources.writers import write
from sediment.sources.readers import sql_source


@query(
    "join_chain",
    """select o_orderkey, c_name, n_name, r_name from orders join customer on o_custkey = c_custkey
       join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey""",
)
def join_chain(spark: SparkSession, d: str) -> DataFrame:
    frames = [table(spark, d, n) for n in ("orders", "customer", "nation", "region")]
    conditions = [
        {"on": F.expr("o_custkey = c_custkey")},
        {"on": F.expr("c_nationkey = n_nationkey")},
        {"on": F.expr("n_regionkey = r_regionkey"), "how": "left"},
    ]
    return joins.join_chain(frames, conditions).select("o_orderkey", "c_name", "n_name", "r_name")


@query(
    "join_left_condition",
    """select c_custkey, count(o_orderkey) as order_count from customer
       left join orders on c_custkey = o_custkey and o_totalprice > 250000 group by 1""",
)
def join_left_condition(spark: SparkSession, d: str) -> DataFrame:
    condition = "c.c_custkey = o.o_custkey and o.o_totalprice > 250000"
    joined = joins.join_on(table(spark, d, "customer"), table(spark, d, "orders"), condition, "left", ("c", "o"))
    return joined.groupBy("c_custkey").agg(F.count("o_orderkey").alias("order_count"))


@query(
    "join_inner_sql",
    """select a.p_partkey as id, a.p_name as name, b.l_returnflag as category, b.l_quantity as value
       from part a join lineitem b on a.p_partkey = b.l_partkey""",
)
def join_inner_sql(spark: SparkSession, d: str) -> DataFrame:
    return sql_source(
        spark,
        "select a.p_partkey as id, a.p_name as name, b.l_returnflag as category, b.l_quantity as value "
        "from bronze_part a join bronze_lineitem b on a.p_partkey = b.l_partkey",
        {"bronze_part": table(spark, d, "part"), "bronze_lineitem": table(spark, d, "lineitem")},
    )


HALF_SUPPLIERS = "select s_suppkey, s_nationkey from supplier where s_acctbal > 5000"


@query(
    "join_anti_orphans",
    f"""select l_orderkey, l_linenumber, l_suppkey from lineitem
        where not exists (select 1 from ({HALF_SUPPLIERS}) where s_suppkey = l_suppkey)""",
)
def join_anti_orphans(spark: SparkSession, d: str) -> DataFrame:
    target = table(spark, d, "supplier").filter("s_acctbal > 5000")
    return joins.orphans(table(spark, d, "lineitem"), target, ["l_suppkey"], ["s_suppkey"]).select(
        "l_orderkey", "l_linenumber", "l_suppkey"
    )


@query(
    "join_orphan_counts",
    """select l_suppkey, l_partkey, count(*) as row_count from lineitem where not exists
         (select 1 from supplier, part where s_suppkey = l_suppkey and p_partkey = l_partkey
            and s_acctbal > 5000 and s_nationkey < 20 and p_size <= s_nationkey) group by 1, 2""",
)
def join_orphan_counts(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "lineitem")
    pairs = (
        items.select("l_suppkey", "l_partkey")
        .distinct()
        .join(table(spark, d, "supplier"), F.expr("s_suppkey = l_suppkey and s_acctbal > 5000 and s_nationkey < 20"))
        .join(table(spark, d, "part"), F.expr("p_partkey = l_partkey and p_size <= s_nationkey"))
        .select("s_suppkey", "p_partkey")
    )
    return joins.orphan_keys(items, pairs, ["l_suppkey", "l_partkey"], ["s_suppkey", "p_partkey"])


@query(
    "join_enrich_reference",
    """select c_custkey, n_name as nation, cast(n_regionkey as bigint) as region_key from customer
       left join (select * from nation where n_regionkey <> 3) on c_nationkey = n_nationkey""",
)
def join_enrich_reference(spark: SparkSession, d: str) -> DataFrame:
    reference = table(spark, d, "nation").filter("n_regionkey <> 3")
    outputs = {"nation": "n_name", "region_key": "n_regionkey"}
    out = joins.enrich(table(spark, d, "customer"), reference, {"c_nationkey": "n_nationkey"}, outputs)
    return out.select("c_custkey", "nation", F.col("region_key").cast("bigint").alias("region_key"))


@query(
    "join_validate_reference",
    """select o_orderkey, case when nullif(o_orderpriority, '5-LOW') is null then null
              else exists (select 1 from customer where c_custkey = o_custkey and c_acctbal > 0) end as customer_valid
       from orders""",
)
def join_validate_reference(spark: SparkSession, d: str) -> DataFrame:
    reference = table(spark, d, "customer").filter("c_acctbal > 0")
    orders = table(spark, d, "orders").withColumn("customer", F.expr("if(o_orderpriority = '5-LOW', null, o_custkey)"))
    return joins.validate_against(orders, reference, {"customer": "c_custkey"}, "customer_valid").select(
        "o_orderkey", "customer_valid"
    )


VERSIONS_SQL = """
  select o_custkey, effective_from, version_order, lead(effective_from) over
         (partition by o_custkey order by effective_from) as effective_to
  from (select o_custkey, o_orderdate as effective_from, max(o_orderkey) as version_order
        from orders where o_orderstatus = 'F' group by 1, 2)"""


def _versions(spark: SparkSession, d: str) -> DataFrame:
    starts = (
        table(spark, d, "orders")
        .filter("o_orderstatus = 'F'")
        .groupBy("o_custkey", F.col("o_orderdate").alias("effective_from"))
        .agg(F.max("o_orderkey").alias("version_order"))
    )
    following = F.lead("effective_from").over(Window.partitionBy("o_custkey").orderBy("effective_from"))
    return starts.withColumn("effective_to", following)


@query(
    "effective_lookup",
    f"""select f.o_orderkey, v.version_order from (select * from orders where o_orderstatus <> 'F') f
        left join ({VERSIONS_SQL}) v on f.o_custkey = v.o_custkey and v.effective_from <= f.o_orderdate
          and (v.effective_to is null or f.o_orderdate < v.effective_to)""",
)
def effective_lookup(spark: SparkSession, d: str) -> DataFrame:
    facts = table(spark, d, "orders").filter("o_orderstatus <> 'F'")
    found = active_mappings(facts, _versions(spark, d), ["o_custkey"], "o_orderdate")
    return found.select("o_orderkey", "version_order")


@query(
    "effective_lookup_overlapping",
    f"""select o_orderkey, version_order from (
          select f.o_orderkey, v.version_order,
                 row_number() over (partition by f.o_orderkey order by v.effective_from desc nulls last) as r
          from (select * from orders where o_orderstatus <> 'F') f
          left join ({VERSIONS_SQL}) v on f.o_custkey = v.o_custkey and v.effective_from <= f.o_orderdate
            and f.o_orderdate < v.effective_from + interval 500 day)
        where r = 1""",
)
def effective_lookup_overlapping(spark: SparkSession, d: str) -> DataFrame:
    facts = table(spark, d, "orders").filter("o_orderstatus <> 'F'")
    versions = _versions(spark, d).withColumn("effective_to", F.expr("effective_from + interval 500 days"))
    found = joins.effective_lookup(facts, versions, ["o_custkey"], "o_orderdate", row_id=["o_orderkey"])
    return found.select("o_orderkey", "version_order")


MERGE_SOURCE = """
  select case when c_nationkey < 12 then c_custkey else c_custkey + 10000000 end as c_custkey,
         case when c_acctbal < 0 then null else c_acctbal * 2 end as c_acctbal, upper(c_name) as c_name
  from customer where c_mktsegment <> 'BUILDING'"""


def _merge_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    customer = table(spark, d, "customer")
    target = customer.select("c_custkey", "c_acctbal", "c_name")
    source = customer.filter("c_mktsegment <> 'BUILDING'").selectExpr(
        "case when c_nationkey < 12 then c_custkey else c_custkey + 10000000 end as c_custkey",
        "case when c_acctbal < 0 then null else c_acctbal * 2 end as c_acctbal",
        "upper(c_name) as c_name",
    )
    return target, source


MERGED_SQL = f"""
  with s as ({MERGE_SOURCE})
  select c_custkey, c_acctbal, c_name from s
  union all
  select c_custkey, c_acctbal, c_name from customer t where not exists (select 1 from s where s.c_custkey = t.c_custkey)"""


@query("merge_upsert", MERGED_SQL)
def merge_upsert(spark: SparkSession, d: str) -> DataFrame:
    target, source = _merge_sides(spark, d)
    return merge_frames(target, source, ["c_custkey"])


@query("merge_versioned_table", MERGED_SQL)
def merge_versioned_table(spark: SparkSession, d: str) -> DataFrame:
    """The same through a stored table; the merge is done twice, which must change nothing."""
    target, source = _merge_sides(spark, d)
    stored = VersionedTable(spark, scratch_path(spark, "merge"))
    stored.replace(target)
    stored.merge(source, ["c_custkey"])
    stored.merge(source, ["c_custkey"])
    return stored.read()


@query(
    "merge_touched_files",
    """with s as (select o_orderkey, o_custkey, o_totalprice + 1 as price from orders
                 where o_orderkey <= (select max(o_orderkey) from orders) // 10 and o_orderstatus = 'P')
       select * from s union all
       select o_orderkey, o_custkey, o_totalprice from orders t where not exists (select 1 from s where s.o_orderkey = t.o_orderkey)""",
)
def merge_touched_files(spark: SparkSession, d: str) -> DataFrame:
    """Orders in twenty files by key; the source holds keys of the first tenth, so most files stay as they are."""
    path = scratch_path(spark, "files")
    orders = table(spark, d, "orders")
    target = orders.selectExpr("o_orderkey", "o_custkey", "o_totalprice as price")
    target.repartitionByRange(20, "o_orderkey").write.parquet(path)
    last = orders.agg(F.max("o_orderkey")).first()[0]
    source = orders.filter(f"o_orderkey <= {last // 10} and o_orderstatus = 'P'").selectExpr("o_orderkey", "o_custkey", "o_totalprice + 1 as price")
    rewritten = merge.merge_touched_files(spark, path, source, ["o_orderkey"])
    assert rewritten <= 4, rewritten
    return spark.read.parquet(path)


@query(
    "merge_precombine",
    """with latest as (
         select user_id, ts, event_type, value from (
           select *, row_number() over (partition by user_id order by ts desc, event_type desc, value desc) as r
           from events where event_type <> 'view') where r = 1),
       base as (select c_custkey as user_id, timestamp '2023-01-01 00:00:00' as ts, 'none' as event_type,
                       cast(c_acctbal as double) as value from customer)
       select * from latest union all
       select * from base where user_id not in (select user_id from latest)""",
)
def merge_precombine(spark: SparkSession, d: str) -> DataFrame:
    base = table(spark, d, "customer").selectExpr(
        "c_custkey as user_id", "timestamp_ntz '2023-01-01 00:00:00' as ts", "'none' as event_type", "c_acctbal as value"
    )
    events = table(spark, d, "events").filter("event_type <> 'view'").select("user_id", "ts", "event_type", "value")
    return upsert_frames(base, events, ["user_id"], "ts")


@query(
    "merge_touched_partitions",
    """with s as (select o_orderkey, o_orderstatus, case when o_orderpriority = '1-URGENT' then null else o_totalprice + 1 end as price
                  from orders where o_orderstatus = 'O' and o_totalprice > 100000)
       select * from s union all
       select o_orderkey, o_orderstatus, o_totalprice from orders t where not exists (select 1 from s where s.o_orderkey = t.o_orderkey)""",
)
def merge_touched_partitions(spark: SparkSession, d: str) -> DataFrame:
    """Only the status folder that the source holds rows of is rewritten."""
    path = scratch_path(spark, "partitions")
    orders = table(spark, d, "orders")
    write(orders.selectExpr("o_orderkey", "o_orderstatus", "o_totalprice as price"), path, partition_by=["o_orderstatus"])
    source = orders.filter("o_orderstatus = 'O' and o_totalprice > 100000").selectExpr(
        "o_orderkey", "o_orderstatus", "if(o_orderpriority = '1-URGENT', null, o_totalprice + 1) as price"
    )
    merge_partitions(spark, path, source, ["o_orderkey"], ["o_orderstatus"])
    return spark.read.parquet(path)
