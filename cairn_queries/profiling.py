"""Profiles, personal data and key discovery over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.operators import discovery, pii, profile
from cairn.sources import describe
from cairn_queries.fixtures import Tables, raw_sql
from cairn_queries.registry import query

ORDERS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
PARTS = ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
# money in cents or as decimals, so that sums and text forms are the same in both engines
ORDERS_SQL = "(select * replace (cast(round(o_totalprice * 100) as bigint) as o_totalprice) from orders)"
PARTS_SQL = "(select * replace (cast(p_retailprice as decimal(12,2)) as p_retailprice) from part)"
CUSTOMERS = "vistareserve.customer_profiles"


def orders(t: Tables) -> DataFrame:
    return t.orders.withColumn("o_totalprice", F.round(F.col("o_totalprice") * 100).cast("bigint"))


def parts(t: Tables) -> DataFrame:
    return t.part.withColumn("p_retailprice", F.col("p_retailprice").cast("decimal(12,2)"))


def melted_sql(columns: tuple[str, ...], source: str) -> str:
    return " union all ".join(
        f"select '{c}' as column_name, cast({c} as varchar) as value, count(*) as n from {source} group by all" for c in columns)


def profile_sql(columns: tuple[str, ...], source: str, means: tuple[str, ...]) -> str:
    """One scan per statistic and column, the plain way."""
    parts = []
    for c in columns:
        mean = f"avg(try_cast({c} as double))" if c in means else "cast(null as double)"
        top = (f"(select string_agg(v, '|' order by n desc, v nulls last) from (select cast({c} as varchar) as v, count(*) as n from {source} "
               "group by 1 order by n desc, v nulls last limit 5))")
        parts.append(
            f"select '{c}' as column_name, count(*) as total_count, count(*) - count({c}) as null_count, "
            f"count(distinct {c}) as distinct_count, cast(min({c}) as varchar) as min_val, cast(max({c}) as varchar) as max_val, "
            f"{mean} as avg_val, {top} as top_values from {source}")
    return " union all ".join(parts)


@query("quick_profile", "L1,E11", profile_sql(ORDERS, ORDERS_SQL, ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")))
def _(t: Tables) -> DataFrame:
    return profile.quick_profile(orders(t), ORDERS)


# every column of the work orders; the one money column that is a double as cents, averages of texts to four decimals
WORK_ORDERS = ("wo_id", "asset_tag", "park_id", "primary_assignee", "wo_type", "status", "labor_hours", "material_cost", "total_cost", "reported_date", "completed_date")


@query("quick_profile_dirty", "L1,L2", f"""
    with src as (select * replace (cast(round(total_cost * 100) as bigint) as total_cost) from ({raw_sql('infratrak.work_orders')})),
    p as ({profile_sql(WORK_ORDERS, 'src', WORK_ORDERS[:-2])})
    select * replace (round(avg_val, 4) as avg_val), round(null_count / total_count, 4) as null_rate, round(distinct_count / total_count, 4) as uniqueness_ratio from p""")
def _(t: Tables) -> DataFrame:
    orders_ = t.raw("infratrak.work_orders").withColumn("total_cost", F.round(F.col("total_cost") * 100).cast("bigint"))
    return profile.profile_ratios(profile.quick_profile(orders_)).withColumn("avg_val", F.round("avg_val", 4))


@query("top_values_per_column", "G3,E11", f"""
    with m as ({melted_sql(PARTS, PARTS_SQL)}), r as (select *, row_number() over (partition by column_name order by n desc, value) as rn from m)
    select column_name, string_agg(value, '|' order by rn) as top_values from r where rn <= 5 group by column_name""")
def _(t: Tables) -> DataFrame:
    return profile.top_values(profile.melt_counts(parts(t), PARTS))


@query("uniqueness_ratios", "L3", " union all ".join(
    f"select '{c}' as column_name, count(distinct {c}) / count(*) as uniqueness_ratio from part" for c in PARTS))
def _(t: Tables) -> DataFrame:
    return profile.uniqueness_ratios(parts(t), PARTS)


# Supplier names are unique; the money column is not; neither pair nor triple is needed.
@query("candidate_keys_single", "L4", """
    select * from (select 's_suppkey' as key_columns, 1 as key_size, count(distinct s_suppkey) / count(*) as uniqueness_ratio from supplier
        union all select 's_name', 1, count(distinct s_name) / count(*) from supplier
        union all select 's_acctbal', 1, count(distinct s_acctbal) / count(*) from supplier
        union all select 's_nationkey', 1, count(distinct s_nationkey) / count(*) from supplier) where uniqueness_ratio >= 0.5""")
def _(t: Tables) -> DataFrame:
    return discovery.candidate_keys(t.supplier)


PAIRED = """(select o_orderkey % (select count(*) * 7 // 10 from orders) as a, o_orderkey // 2 as b, nullif(o_custkey % 3, 0) as c from orders)"""


@query("candidate_keys_composite", "L4", f"""
    with s as {PAIRED} select 'a' as key_columns, 1 as key_size, count(distinct a) / count(*) as uniqueness_ratio from s
    union all select 'b', 1, count(distinct b) / count(*) from s union all select 'a, b', 2, count(distinct (a, b)) / count(*) from s""")
def _(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    seven_tenths = t.orders.select(F.floor(F.count("*") * 7 / F.lit(10)).alias("n")).scalar()
    keys = t.orders.select((k % seven_tenths).alias("a"), F.floor(k / 2).alias("b"),
                           F.nullif(F.col("o_custkey") % 3, F.lit(0)).alias("c"))
    return discovery.candidate_keys(keys)


@query("key_check_coverage", "L5", """
    with c as (select 's_suppkey' as key_columns, 1 as key_size, count(distinct s_suppkey) / count(*) as uniqueness_ratio from supplier
        union all select 's_name', 1, count(distinct s_name) / count(*) from supplier
        union all select 's_acctbal', 1, count(distinct s_acctbal) / count(*) from supplier)
    select *, key_columns = 's_suppkey' as covered, case key_columns when 's_suppkey' then '' when 's_name' then 'unique' else 'unique, not_null' end as missing_checks
    from c where uniqueness_ratio >= 0.5""")
def _(t: Tables) -> DataFrame:
    declared = t.spark.createDataFrame(
        [("s_suppkey", "unique"), ("s_suppkey", "not_null"), ("s_name", "not_null")], "column_name string, check_name string")
    return discovery.key_coverage(discovery.candidate_keys(t.supplier), declared)


def cardinality_sql(left: str, lk: str, right: str, rk: str) -> str:
    return f"""
        with c as (select (select count(distinct {lk}) from {left}) as left_distinct, (select count(distinct {rk}) from {right}) as right_distinct,
            (select count(*) from {left} join {right} on {lk} = {rk}) as result_rows, (select count(*) from {left}) as left_rows)
        select *, case when left_distinct = right_distinct and result_rows / left_rows <= 1.05 then '1:1'
            when left_distinct > right_distinct and result_rows / left_rows > 1.05 then '1:M'
            when left_distinct < right_distinct and result_rows / left_rows <= 1.05 then 'M:1' else 'M:M' end as cardinality,
            result_rows / left_rows > 1.05 as fan_out, round(result_rows / left_rows, 3) as expansion_ratio from c"""


@query("join_cardinality_one_to_many", "L6", cardinality_sql("orders", "o_orderkey", "lineitem", "l_orderkey"))
def _(t: Tables) -> DataFrame:
    return discovery.join_cardinality(t.orders, t.lineitem, {"o_orderkey": "l_orderkey"})


@query("join_cardinality_many_to_one", "L6", cardinality_sql("orders", "o_custkey", "customer", "c_custkey"))
def _(t: Tables) -> DataFrame:
    return discovery.join_cardinality(t.orders, t.customer, {"o_custkey": "c_custkey"})


@query("low_cardinality_values", "L7", f"""
    with m as ({melted_sql(ORDERS, ORDERS_SQL)}) select * from m where column_name in
        (select column_name from m group by 1 having count(value) between 1 and 10)""")
def _(t: Tables) -> DataFrame:
    return profile.value_counts(orders(t).select(*ORDERS))


@query("text_hygiene", "L8", """
    select * from (select 'text' as column_name, count(*) filter (where text = '') as empty_count,
        count(*) filter (where regexp_matches(text, '^\\s+|\\s+$')) as padded_count from d
        union all select 'padded', count(*) filter (where padded = ''), count(*) filter (where regexp_matches(padded, '^\\s+|\\s+$')) from d
        union all select 'lang', count(*) filter (where lang = ''), count(*) filter (where regexp_matches(lang, '^\\s+|\\s+$')) from d
        union all select 'source', count(*) filter (where source = ''), count(*) filter (where regexp_matches(source, '^\\s+|\\s+$')) from d)
    where empty_count + padded_count > 0""".replace("from d", "from (select text, lang, source, case when doc_id % 3 = 0 then '' when doc_id % 3 = 1 then ' ' || text else text end as padded from documents)"))
def _(t: Tables) -> DataFrame:
    r = F.col("doc_id") % 3
    padded = F.when(r == 0, "").when(r == 1, F.concat(F.lit(" "), "text")).otherwise(F.col("text"))
    return profile.text_hygiene(t.documents.select("text", "lang", "source", padded.alias("padded")))


@query("date_bounds", "L9", """
    select 'l_shipdate' as column_name, min(l_shipdate) as min_value, max(l_shipdate) as max_value from lineitem""")
def _(t: Tables) -> DataFrame:
    return profile.bounds(t.lineitem)


NULLABLE = ("first_name", "email", "address_state", "created_at", "preferences_json", "merged_into_customer_id", "customer_id",
            "last_name", "phone", "has_annual_pass", "is_senior", "is_veteran")


@query("null_counts_top", "L9,G1", f"""
    with s as ({raw_sql(CUSTOMERS)}) select * from (""" + " union all ".join(
    f"select '{c}' as column_name, count(*) - count({c}) as null_count, round(100.0 * (count(*) - count({c})) / count(*), 2) as null_pct from s"
    for c in NULLABLE) + ") where null_count > 0 order by null_count desc, column_name limit 4")
def _(t: Tables) -> DataFrame:
    return profile.null_top(t.raw(CUSTOMERS), 4)


@query("fully_unique_columns", "L10", " union all ".join(
    f"select '{c}' as column_name, count(distinct {c}) as distinct_count from orders having count(distinct {c}) = count(*)" for c in ORDERS))
def _(t: Tables) -> DataFrame:
    return profile.unique_columns(profile.quick_profile(orders(t), ORDERS)).select("column_name", "distinct_count")


SIGNAL_SQL = """(select cast(o_orderkey as varchar) as orderId, o_orderpriority as status, cast(o_orderdate as varchar) as created_on,
    1 as str_flag, if(o_orderkey % 10 < 8, null, o_custkey) as sparse from orders)"""


@query("staging_signals", "L11", f"""
    with s as {SIGNAL_SQL}, n as (select count(*) as n, count(try_cast(orderId as double)) as num, count(distinct str_flag) as k, count(sparse) as sp,
        count(try_cast(status as double)) as st, count(try_cast(created_on as double)) as co from s)
    select 'orderId' as column_name, 'CAST_HINT' as signal_type, 'cast(orderId as numeric) — column stores numeric values as text' as message from n where num = n
    union all select 'orderId', 'RENAME_HINT', 'rename to snake_case: order_id' from n
    union all select 'status', 'RENAME_HINT', 'ambiguous column name ''status'' — prefix with entity context' from n where st < n
    union all select 'created_on', 'CAST_HINT', 'cast(created_on as date) — column name suggests date/time data' from n where co < n
    union all select 'str_flag', 'RENAME_HINT', 'remove Hungarian notation prefix from: str_flag' from n
    union all select 'str_flag', 'UNUSED_COLUMN', 'constant value — consider dropping in staging' from n where k = 1
    union all select 'sparse', 'UNUSED_COLUMN', 'high null rate — consider dropping or documenting sparse population' from n where sp < n * 0.5""")
def _(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    rows = t.orders.select(
        k.cast("string").alias("orderId"), F.col("o_orderpriority").alias("status"),
        F.col("o_orderdate").cast("string").alias("created_on"), F.lit(1).alias("str_flag"),
        F.when(k % 10 >= 8, F.col("o_custkey")).alias("sparse"))
    return profile.staging_signals(rows, 0.5)


# Which columns are flagged follows from their names; how many rows they expose is counted on the data.
@query("pii_columns_by_name", "L12,A6", f"""
    with s as ({raw_sql(CUSTOMERS)})""" + " union all ".join(
    f" select '{c}' as column_name, count({c}) as filled_rows from s" for c in ("address_state", "email", "first_name", "last_name", "phone")))
def _(t: Tables) -> DataFrame:
    customers = t.raw(CUSTOMERS)
    filled = profile.wide_stats(customers, customers.columns, {"filled_rows": ("bigint", F.count)})
    return filled.join(pii.pii_by_name(describe(customers)).select("column_name"), "column_name", "left_semi")


def pii_value_sql(columns: dict[str, str]) -> str:
    return "select * from (" + " union all ".join(
        f"select '{c}' as column_name, " + ", ".join(
            f"count(*) filter (where regexp_matches({c}, '{p}')) as {kind}" for kind, p in pii.PII_PATTERNS.items()) + f" from {src}"
        for c, src in columns.items()) + ") where greatest(" + ", ".join(pii.PII_PATTERNS) + ") >= 1"


@query("pii_columns_by_value", "L13", pii_value_sql({"text": "documents", "lang": "documents", "source": "documents"}))
def _(t: Tables) -> DataFrame:
    return pii.pii_by_value(t.documents)


@query("pii_columns_by_value_contacts", "L13", f"with s as ({raw_sql(CUSTOMERS)}) " + pii_value_sql(
    {c: "s" for c in ("customer_id", "merged_into_customer_id", "address_state", "email", "first_name", "last_name", "phone",
                      "preferences_json")}))
def _(t: Tables) -> DataFrame:
    return pii.pii_by_value(t.raw(CUSTOMERS))


def _redacted(c: str) -> str:
    out = c
    for kind, p in pii.PII_PATTERNS.items():
        out = f"regexp_replace({out}, '{p}', '[REDACTED:{kind}]', 'g')"
    return f"case when {c} is null then null when {out} = {c} then '[REDACTED]' else {out} end"


@query("redact_columns", "L14", f"select doc_id, {_redacted('text')} as text, lang, {_redacted('source')} as source, n_chars from documents")
def _(t: Tables) -> DataFrame:
    return pii.redact(t.documents, ["text", "source", "no_such_column"])


@query("redact_customer_contacts", "L14", f"""
    select customer_id, {_redacted('email')} as email, {_redacted('phone')} as phone, created_at from ({raw_sql(CUSTOMERS)})""")
def _(t: Tables) -> DataFrame:
    return pii.redact(t.raw(CUSTOMERS).select("customer_id", "email", "phone", "created_at"), ["email", "phone"])


@query("suggest_checks", "L15", f"""
    with s as (select 'C' || o_orderkey as order_id, if(o_orderkey % 3 = 0, null, 'U' || (o_custkey % 9)) as user_key, o_orderpriority as priority,
        o_orderdate as placed_at, if(o_orderkey % 2 = 0, null, o_orderdate) as closed_on, 'x' as kind from orders)
    select 'order_id' as column_name, 'not_null' as check_name, null as accepted from s having count(*) > 0
    union all select 'order_id', 'unique', null from s having count(distinct order_id) = count(order_id)
    union all select 'user_key', 'not_null', null from s having count(*) > 0
    union all select 'user_key', 'unique', null from s having count(distinct user_key) = count(user_key)
    union all select 'placed_at', 'not_null', null from s having count(*) - count(placed_at) < 0.1 * count(*)
    union all select 'closed_on', 'not_null', null from s having count(*) - count(closed_on) < 0.1 * count(*)
    union all select 'priority', 'accepted_values', (select string_agg(priority, ', ' order by priority) from (select distinct priority from s)) from s
        having count(distinct priority) between 2 and 15
    union all select 'kind', 'accepted_values', 'x' from s having count(distinct kind) between 2 and 15""")
def _(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    rows = t.orders.select(
        F.concat(F.lit("C"), k.cast("string")).alias("order_id"),
        F.when(k % 3 != 0, F.concat(F.lit("U"), (F.col("o_custkey") % 9).cast("string"))).alias("user_key"),
        F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").alias("placed_at"),
        F.when(k % 2 != 0, F.col("o_orderdate")).alias("closed_on"), F.lit("x").alias("kind"))
    return profile.suggest_checks(rows)


# A registry of tables as data: names and columns come from the rows of part.
REGISTRY_SQL = """(select case p_size % 4 when 0 then 'sales_orders_' when 1 then 'status_codes_' when 2 then 'parks_' else 'Event_Log_' end || p_brand as table_name,
    case p_partkey % 5 when 0 then 'row_created_at' when 1 then 'etl_Loaded_At' when 2 then 'last_modified' when 3 then p_name else 'updated_at' end as column_name,
    p_partkey as position from part)"""


@query("suggest_freshness", "L16", f"""
    with c as (select *, case when lower(column_name) like '%\\_loaded\\_at' escape '\\' then 0 when lower(column_name) like '%\\_created\\_at' escape '\\' then 3
            when lower(column_name) like '%last\\_modified' escape '\\' then 6 when lower(column_name) like '%updated\\_at' escape '\\' then 8 end as rank from {REGISTRY_SQL}),
    b as (select table_name, arg_min(column_name, row(rank, position)) as loaded_at_field,
        case when regexp_matches(lower(table_name), 'transaction|event|log|order|payment|sale|booking') then 'transactional'
             when regexp_matches(lower(table_name), 'type|code|categor|mapping|lookup') then 'reference' else 'standard' end as table_kind
        from c where rank is not null group by table_name)
    select *, case table_kind when 'transactional' then 12 when 'reference' then 168 else 24 end as warn_hours,
        case table_kind when 'transactional' then 24 when 'reference' then 336 else 48 end as error_hours from b""")
def _(t: Tables) -> DataFrame:
    size, k = F.col("p_size") % 4, F.col("p_partkey") % 5
    prefix = F.when(size == 0, "sales_orders_").when(size == 1, "status_codes_").when(size == 2, "parks_").otherwise("Event_Log_")
    column = (F.when(k == 0, "row_created_at").when(k == 1, "etl_Loaded_At").when(k == 2, "last_modified")
              .when(k == 3, F.col("p_name")).otherwise("updated_at"))
    return profile.suggest_freshness(t.part.select(
        F.concat(prefix, "p_brand").alias("table_name"), column.alias("column_name"), F.col("p_partkey").alias("position")))
