"""Data-quality checks over whole tables: violations and summaries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn import streaming
from cairn.operators import quality as q
from cairn.session import shared_dir
from cairn_queries.fixtures import Tables, raw_sql
from cairn_queries.models import model_ctes, warehouse
from cairn_queries.registry import query

EMAIL = r"^[^@]+@[^@]+\.[^@]+$"
CUSTOMERS, WORK = "vistareserve.customer_profiles", "infratrak.work_orders"


@query("check_not_null", "K1", f"select * from ({raw_sql(CUSTOMERS)}) where email is null")
def _(t: Tables) -> DataFrame:
    return q.not_null("email").violations(t.raw(CUSTOMERS))


@query("check_unique", "K2", f"select customer_id, count(*) as n_rows from ({raw_sql(CUSTOMERS)}) where customer_id is not null group by 1 having count(*) > 1")
def _(t: Tables) -> DataFrame:
    return q.unique("customer_id").violations(t.raw(CUSTOMERS))


@query("check_accepted_values", "K3", """
    select o_orderpriority, count(*) as n_rows from orders where o_orderpriority not in ('1-URGENT', '2-HIGH', '3-MEDIUM') group by 1""")
def _(t: Tables) -> DataFrame:
    return q.accepted_values("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]).violations(t.orders)


@query("check_relationships", "K4", f"""
    select * from ({raw_sql(WORK)}) w where park_id is not null and park_id not in (select s_suppkey from supplier)""")
def _(t: Tables) -> DataFrame:
    return q.relationships("park_id", t.supplier, "s_suppkey").violations(t.raw(WORK))


@query("check_unique_combination", "K5", "select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by all having count(*) > 1")
def _(t: Tables) -> DataFrame:
    return q.unique_combination("l_orderkey", "l_linenumber").violations(t.lineitem)


@query("check_row_count_between", "K6", """
    select row_count from (select count(*) as row_count from lineitem) where row_count not between 10000000000 and 20000000000""")
def _(t: Tables) -> DataFrame:
    return q.row_count_between(10_000_000_000, 20_000_000_000).violations(t.lineitem)


@query("check_row_count_equals", "K7", """
    select * from (select count(*) as row_count from orders), (select count(*) as other_row_count from lineitem) where row_count <> other_row_count""")
def _(t: Tables) -> DataFrame:
    return q.row_count_equals(t.lineitem).violations(t.orders)


@query("check_between", "K8", "select * from lineitem where not (l_quantity between 3 and 40)")
def _(t: Tables) -> DataFrame:
    return q.between("l_quantity", 3, 40).violations(t.lineitem)


@query("check_max_between", "K9", "select max_value from (select max(c_acctbal) as max_value from customer) where max_value > 5000")
def _(t: Tables) -> DataFrame:
    return q.max_between("c_acctbal", 0, 5000).violations(t.customer)


@query("check_match_regex", "K10", f"select * from ({raw_sql(CUSTOMERS)}) where not regexp_matches(email, '{EMAIL}')")
def _(t: Tables) -> DataFrame:
    return q.match_regex("email", EMAIL).violations(t.raw(CUSTOMERS))


@query("check_pair_greater", "K11", f"""
    select * from ({raw_sql('vistareserve.reservations')}) where not (departure_date > arrival_date)""")
def _(t: Tables) -> DataFrame:
    return q.pair_greater("departure_date", "arrival_date").violations(t.raw("vistareserve.reservations"))


@query("check_not_null_where", "K12,K15", f"select * from ({raw_sql(WORK)}) where status = 'closed' and completed_date is null")
def _(t: Tables) -> DataFrame:
    return q.not_null_where("completed_date", F.col("status") == "closed").violations(t.raw(WORK))


@query("contract_enforced", "K13", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def _(t: Tables) -> DataFrame:
    shuffled = t.customer.select("c_mktsegment", "c_acctbal", "c_nationkey", "c_name", "c_custkey")
    return q.enforce_contract(shuffled, t.customer.schema)


# The differing columns are found from the schemas; how many rows each affects is counted on the data.
@query("column_diff_with_fill", "K14,A6", """
    select column_name, 'present only' as side, n as filled_rows from (
        select count(o_orderpriority) as o_orderpriority, count(o_totalprice) as o_totalprice from orders)
        unpivot (n for column_name in (o_orderpriority, o_totalprice))
    union all select 'o_channel', 'declared only', 0::bigint""")
def _(t: Tables) -> DataFrame:
    declared = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_channel"]
    diff = q.column_diff(t.orders, declared)
    filled = t.orders.agg(*[F.count(c).alias(c) for c in t.orders.columns])
    counts = filled.select(F.explode(F.map_from_arrays(
        F.array(*[F.lit(c) for c in t.orders.columns]), F.array(*t.orders.columns))).alias("column_name", "n"))
    return diff.join(counts, "column_name", "left").select(
        "column_name", "side", F.coalesce("n", F.lit(0)).alias("filled_rows"))


@query("quality_summary", "K1,K2,K3,K5,K8,K12,K15", """
    select 'not_null' as check_name, 'lineitem' as table_name, 'l_orderkey' as column_name, 'error' as severity,
        count(*) filter (where l_orderkey is null) as violations from lineitem
    union all select 'between', 'lineitem', 'l_quantity', 'warn', count(*) filter (where l_quantity > 40) from lineitem
    union all select 'accepted_values', 'lineitem', 'l_returnflag', 'error', count(distinct l_returnflag) filter (where l_returnflag not in ('A', 'N')) from lineitem
    union all select 'not_null', 'lineitem', 'l_tax', 'error', count(*) filter (where l_linestatus = 'F' and l_tax is null) from lineitem
    union all select 'pair_greater', 'lineitem', 'l_extendedprice, l_quantity', 'error',
        count(*) filter (where not (l_extendedprice >= l_quantity)) from lineitem
    union all select 'unique_combination', 'lineitem', 'l_orderkey, l_linenumber', 'error',
        (select count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1))""")
def _(t: Tables) -> DataFrame:
    return q.summarize(t.lineitem, "lineitem", [
        q.not_null("l_orderkey"), q.between("l_quantity", high=40).warn(),
        q.accepted_values("l_returnflag", ["A", "N"]), q.not_null_where("l_tax", F.col("l_linestatus") == "F"),
        q.pair_greater("l_extendedprice", "l_quantity", or_equal=True),
        q.unique_combination("l_orderkey", "l_linenumber")])


FRESHNESS_SQL = """
    select table_name, loaded_at, date_diff('second', loaded_at, timestamp '2024-02-01 00:00:00') / 3600.0 as age_hours,
        case when date_diff('second', loaded_at, timestamp '2024-02-01 00:00:00') / 3600.0 > error then 'error'
             when date_diff('second', loaded_at, timestamp '2024-02-01 00:00:00') / 3600.0 > warn then 'warn' else 'pass' end as status
    from (select 'events' as table_name, date_trunc('second', max(ts)) as loaded_at, 24.0 as warn, 72.0 as error from events
          union all select 'orders', max(o_orderdate), 24.0, 72.0 from orders
          union all select 'lineitem', max(l_shipdate), 24.0, 1000000.0 from lineitem)"""
AS_OF = "2024-02-01 00:00:00"


def freshness_tables(t: Tables) -> dict:
    events = t.events.select(F.date_trunc("second", "ts").cast("timestamp_ntz").alias("ts"))
    return {"events": (events, "ts", 24.0, 72.0), "orders": (t.orders, "o_orderdate", 24.0, 72.0),
            "lineitem": (t.lineitem, "l_shipdate", 24.0, 1000000.0)}


@query("source_freshness", "K16", FRESHNESS_SQL)
def _(t: Tables) -> DataFrame:
    return q.freshness(freshness_tables(t), F.lit(AS_OF).cast("timestamp_ntz"))


@query("check_orphan_parks", "K17", f"""{model_ctes('int_visits', 'int_parks')}
    select visits_sk, _park_sk from int_visits where _park_sk is null or _park_sk not in (select parks_sk from int_parks)""")
def _(t: Tables) -> DataFrame:
    w = warehouse(t)
    return q.orphan_check(w.int_visits.select("visits_sk", "_park_sk"), "_park_sk", w.int_parks, "parks_sk")


@query("check_ids_reconciled", "K18", f"""{model_ctes('int_parks')}
    select v.accountnumber from int_parks v where v.source_system like '%REV-01%'
        and not exists (select 1 from int_parks g where g.source_system like '%GEO-01%' and g.accountnumber = v.accountnumber)""")
def _(t: Tables) -> DataFrame:
    return q.reconcile_ids(warehouse(t).int_parks, "accountnumber", "source_system", "%REV-01%", "%GEO-01%")


@query("check_revenue_balance", "K19,Q2", f"""{model_ctes('fct_reservations', 'fct_pos_transactions', 'rpt_park_revenue_summary')}
    select f.res::decimal(38,2) as fact_reservations, p.pos::decimal(38,2) as fact_pos, r.res::decimal(38,2) as report_reservations,
        r.pos::decimal(38,2) as report_pos
    from (select coalesce(sum(reservation_amount), 0) as res from fct_reservations) f,
        (select coalesce(sum(transaction_amount), 0) as pos from fct_pos_transactions) p,
        (select coalesce(sum(total_reservation_revenue), 0) as res, coalesce(sum(total_pos_revenue), 0) as pos from rpt_park_revenue_summary) r
    where round(f.res, 2) <> round(r.res, 2) or round(p.pos, 2) <> round(r.pos, 2)""")
def _(t: Tables) -> DataFrame:
    w = warehouse(t)
    return q.balance_check(
        {"reservations": (w.fct_reservations, "reservation_amount"), "pos": (w.fct_pos_transactions, "transaction_amount")},
        w.rpt_park_revenue_summary, {"reservations": "total_reservation_revenue", "pos": "total_pos_revenue"})


# Catalog of allowed columns: part names are the column names, brands the entities.
@query("entity_conformance", "K20", """
    select column_name from (select distinct p_name || if(p_size % 9 = 0, '_id', '') as column_name from part) c
    where not (lower(column_name) like '%\\_sk' escape '\\' or lower(column_name) like '%\\_id' escape '\\')
        and lower(column_name) not in (select lower(if(p_name like 'small%', 'tiny ' || p_name, p_name)) from part where p_brand = 'Brand#7')""")
def _(t: Tables) -> DataFrame:
    suffix = F.when(F.col("p_size") % 9 == 0, "_id").otherwise("")
    columns = t.part.select(F.concat("p_name", suffix).alias("column_name")).distinct()
    listed = F.when(F.col("p_name").startswith("small"), F.concat(F.lit("tiny "), "p_name")).otherwise(F.col("p_name"))
    catalog = t.part.select(F.col("p_brand").alias("entity"), listed.alias("column_name"))
    return q.entity_conformance(columns, catalog, "Brand#7")


# --- streamed freshness

def new_folder(t: Tables) -> str:
    return f"{shared_dir(t.spark)}/freshness/{uuid.uuid4().hex}"


@query("streamed_freshness", "K16", FRESHNESS_SQL)
def _(t: Tables) -> DataFrame:
    root, tables = new_folder(t), {}
    for name, (df, column, warn, error) in freshness_tables(t).items():
        streaming.announce(df, column, f"{root}/{name}/in")
        streaming.watch(streaming.read_arrivals(t.spark, f"{root}/{name}/in"), f"{root}/{name}")
        tables[name] = (f"{root}/{name}", warn, error)
    return streaming.streamed_freshness(t.spark, tables, F.lit(AS_OF).cast("timestamp_ntz"))


@query("streamed_arrivals_per_day", "K16", """
    select date_trunc('day', ts)::timestamp as window_start, count(*) as n_rows, date_trunc('second', max(ts))::timestamp as loaded_at
    from events where ts is not null group by 1""")
def _(t: Tables) -> DataFrame:
    root = new_folder(t)
    events, column, _, _ = freshness_tables(t)["events"]
    # two loads in the order of time, each taken in by a run of its own
    half = F.col(column) < F.lit("2024-01-15").cast("timestamp_ntz")
    for load in (events.where(half), events.where(~half)):
        streaming.announce(load, column, f"{root}/in")
        streaming.watch(streaming.read_arrivals(t.spark, f"{root}/in"), root)
    return streaming.arrived(t.spark, root)
