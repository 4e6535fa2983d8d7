"""Closure of the lineage, occupancy and backlog, unpacked lists, pruned key search, validated detectors."""

from __future__ import annotations

import uuid
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn import sources
from cairn.operators import aggregates, discovery, joins, lineage, lists, pii
from cairn.plans import metrics
from cairn.session import shared_dir
from cairn_queries.catalog import EDGES_SQL, NODES_SQL, edges, nodes
from cairn_queries.fixtures import LINE_ID, Tables, gap, raw_sql
from cairn_queries.registry import query

# --- lineage from direct edges

CLOSURE_SQL = f"""
    direct as (select distinct parent, child from {EDGES_SQL} where distance = 1),
    ways as (select parent, child, 1 as distance, [parent, child] as path from direct
             union all select w.parent, d.child, w.distance + 1, list_append(w.path, d.child) from ways w join direct d on d.parent = w.child
             where w.child <> w.parent and not list_contains(w.path[2:], d.child)),
    closure as (select parent, child, min(distance) as distance, arg_min(path, (distance, path)) as path from ways group by all)"""


def closure(t: Tables) -> DataFrame:
    return lineage.closure(edges(t).where("distance = 1"))


@query("lineage_closure", "N1,N2,N3", f"""
    with recursive {CLOSURE_SQL} select parent, child, distance, array_to_string(path, ' > ') as path from closure""")
def _(t: Tables) -> DataFrame:
    return closure(t).select("parent", "child", "distance", F.array_join("path", " > ").alias("path"))


@query("lineage_audits_from_direct_edges", "N1,N2,N3", f"""
    with recursive {CLOSURE_SQL}, m as (select * from {NODES_SQL} where resource_type = 'model')
    select 'fact without integration' as audit, unique_id, name as resource_name from m where name[:4] in ('fct_', 'dim_')
        and not exists (select 1 from closure e where e.distance = 1 and e.child = m.unique_id and contains(parent, 'model.') and contains(parent, '.int_'))
    union all select 'mart on staging', unique_id, name from m join closure e on e.child = m.unique_id
        where name[:4] in ('fct_', 'dim_') and distance = 1 and contains(parent, 'model.') and contains(parent, '.stg_')
    union all select distinct 'staging off source', unique_id, name from m join closure e on e.child = m.unique_id
        where name[:4] = 'stg_' and distance = 1 and not (contains(parent, 'source.') or contains(parent, 'model.') and contains(parent, '.base_'))""")
def _(t: Tables) -> DataFrame:
    all_edges = closure(t)
    audits = {"fact without integration": lineage.facts_without_integration, "mart on staging": lineage.marts_on_staging,
              "staging off source": lineage.staging_off_source}
    found = [run(nodes(t), all_edges).select(F.lit(name).alias("audit"), "unique_id", "resource_name") for name, run in audits.items()]
    return found[0].unionAll(found[1]).unionAll(found[2])


# --- occupancy and maintenance backlog

STAYS_SQL = f"""
    inventory as ({raw_sql('vistareserve.inventory_assets')}), booked as ({raw_sql('vistareserve.reservations')}),
    stays as (select i.park_id, i.asset_type, i.asset_id, arrival_date, departure_date from booked join inventory i using (asset_id)
              where arrival_date < departure_date),
    bounds as (select min(arrival_date) as opens, max(departure_date) as closes from stays),
    days as (select unnest(generate_series(opens, closes - 1, interval 1 day))::date as day from bounds),
    units as (select park_id, asset_type, count(distinct asset_id) as available_units from inventory group by all),
    taken as (select park_id, asset_type, day, count(distinct asset_id) as n
              from (select park_id, asset_type, asset_id, unnest(generate_series(arrival_date, departure_date - 1, interval 1 day))::date as day from stays)
              group by all),
    daily as (select u.park_id, u.asset_type, days.day as occupancy_date, coalesce(n, 0)::bigint as occupied_units, available_units::bigint as available_units
              from units u cross join days left join taken k on k.day = days.day and k.asset_type = u.asset_type and k.park_id is not distinct from u.park_id)"""
PARK_AND_TYPE = ["park_id", "asset_type"]


def occupancy_levels(t: Tables) -> DataFrame:
    inventory = t.raw("vistareserve.inventory_assets")
    booked = t.raw("vistareserve.reservations").select("asset_id", "arrival_date", "departure_date").where("arrival_date < departure_date")
    stays = booked.join(inventory.select("asset_id", *PARK_AND_TYPE), "asset_id")
    # the inventory has no dates: every unit can be booked as long as there are stays
    bounds = booked.join(inventory.select("asset_id"), "asset_id").agg(
        F.min("arrival_date").alias("arrival_date"), F.max("departure_date").alias("departure_date"))
    units = inventory.select("asset_id", *PARK_AND_TYPE).crossJoin(F.broadcast(bounds))  # one row
    return metrics.occupancy_levels(stays, units, PARK_AND_TYPE, "asset_id", "arrival_date", "departure_date")


@query("occupancy_rate_daily", "D7,E1", f"""
    with {STAYS_SQL} select *, round(occupied_units / available_units, 4) as occupancy_rate from daily""")
def _(t: Tables) -> DataFrame:
    return metrics.occupancy_daily(occupancy_levels(t), PARK_AND_TYPE, "arrival_date", "departure_date")


@query("occupancy_rate_monthly", "D7,E2", f"""
    with {STAYS_SQL} select park_id, asset_type, date_trunc('month', occupancy_date)::date as month, sum(occupied_units)::bigint as occupied_nights,
        sum(available_units)::bigint as available_nights, round(sum(occupied_units) / sum(available_units), 4) as occupancy_rate from daily group by 1, 2, 3""")
def _(t: Tables) -> DataFrame:
    return metrics.occupancy_monthly(occupancy_levels(t), PARK_AND_TYPE, "arrival_date", "departure_date")


# condition scores of the derived tables end at 50, so a lower score counts as good here
GOOD = 30


@query("maintenance_backlog", "E1,E6", f"""
    with assets as ({raw_sql('infratrak.assets')}), parks as ({raw_sql('infratrak.parks')}),
    costs as (select asset_tag, calculation_date as d, arg_max(estimated_repair_cost, backlog_id) as cost from ({raw_sql('infratrak.deferred_maintenance')}) group by all),
    scores as (select asset_tag, inspection_date as d, arg_max(fci_score, assessment_id) as score from ({raw_sql('infratrak.condition_assessments')}) group by all),
    moments as (select asset_tag, d from costs union select asset_tag, d from scores),
    held as (select m.asset_tag, m.d, cost, score from moments m asof left join costs c on c.asset_tag = m.asset_tag and c.d <= m.d
             asof left join scores s on s.asset_tag = m.asset_tag and s.d <= m.d),
    worth as (select asset_tag, d, case when score < {GOOD} then cast(cost as decimal(18,2)) end as v from held),
    steps as (select asset_tag, d, coalesce(v, 0) - coalesce(lag(coalesce(v, 0)) over w, 0) as dv,
                     (v is not null)::int - coalesce(lag((v is not null)::int) over w, 0) as dn from worth window w as (partition by asset_tag order by d)),
    sums as (select park_id, d, sum(dv) as dv, sum(dn) as dn from steps join assets using (asset_tag) group by all having sum(dv) <> 0 or sum(dn) <> 0)
    select region_id, sums.park_id, d as changed_on, cast(sum(dv) over w as decimal(18,2)) as backlog_cost, (sum(dn) over w)::bigint as backlog_assets
    from sums left join parks using (park_id) window w as (partition by sums.park_id order by d)""")
def _(t: Tables) -> DataFrame:
    return metrics.maintenance_backlog(*(t.raw(f"infratrak.{name}") for name in (
        "deferred_maintenance", "condition_assessments", "assets", "parks")), good=GOOD)


# --- lists in text: some cut short, some quoted

_LINE = "(l_orderkey * 8 + l_linenumber)"
MEMO = f"repeat('INV-' || cast(l_partkey as string) || '|9.99|memo|', cast(l_linenumber as int))"
LEDGER = f"""select 'GL' || {LINE_ID} as gl_entry_id, cast(l_extendedprice as decimal(18,2)) as amount,
    case when {_LINE} % 9 = 0 then substr({MEMO}, 1, length({MEMO}) - 6) when {_LINE} % 7 = 0 then {MEMO} || 'INV-Q|1.50| "a ""b"" | c" |'
         when {_LINE} % 31 = 0 then {MEMO} || 'INV-O|2.50|"open|' else {gap(MEMO, _LINE, 6)} end as batch_detail_text from lineitem"""
MATCHES = """select 'MF' || cast(o_orderkey as string) as match_id, case when o_orderkey % 5 = 0 then '"Hill, ' || o_orderpriority || '",, Friends'
    when o_orderkey % 11 = 0 then 'Friends, "Hill, ' || o_orderpriority when o_orderkey % 13 = 0 then '' when o_orderkey % 17 = 0 then null
    else 'Friends, ' || o_orderpriority end as contributors from orders"""


def items_sql(source: str, key: str, column: str, sep: str) -> str:
    """One row per item of a list in text, in DuckDB."""
    s, quoted = "\\" + sep if sep == "|" else sep, lists.QUOTED
    return f"""
        found as (select {key}, regexp_extract_all('{sep}' || {column}, '{lists.item_pattern(sep)}') as xs from ({source}) where length({column}) > 0),
        placed as (select {key}, len(xs) as n, generate_subscripts(xs, 1) as position, unnest(xs) as x from found),
        bodied as (select *, trim(if(starts_with(x, '{sep}'), x[2:], x), ' ') as body, regexp_matches(x, '^{s}{quoted}$') as quoted, regexp_matches(x, '^{s}[^"{s}]*$') as plain
                   from placed),
        items as (select {key}, n, position, if(quoted, replace(body[2:-2], '""', '"'), body) as value, not (quoted or plain) as malformed from bodied)"""


@query("match_fund_contributors", "B10,I1", f"""
    with {items_sql(MATCHES, 'match_id', 'contributors', ',')} select match_id, position::int as position, value, malformed from items""")
def _(t: Tables) -> DataFrame:
    return lists.unpack_list(_select(t.orders, MATCHES), "contributors", ["match_id"])


def _select(df: DataFrame, sql: str) -> DataFrame:
    """A ``select ... from <table>`` text over ``df``."""
    return df.sparkSession.sql(sql.rsplit(" from ", 1)[0] + " from {d}", d=df)


RECORDS_SQL = items_sql(LEDGER, "gl_entry_id", "batch_detail_text", "|") + """,
        kept as (select * from items where not (position = n and n % 3 = 1 and value = '')),
        records as (select gl_entry_id, (position - 1) // 3 + 1 as position, max(value) filter (where position % 3 = 1) as invoice_number,
                           max(value) filter (where position % 3 = 2) as invoice_amount, max(value) filter (where position % 3 = 0) as memo,
                           bool_or(malformed) or count(*) < 3 as malformed from kept group by gl_entry_id, (position - 1) // 3)"""
FIELDS = ("invoice_number", "invoice_amount", "memo")


@query("ledger_invoice_lines", "B10,I1", f"""
    with {RECORDS_SQL} select gl_entry_id, position::int as position, invoice_number, invoice_amount, memo, malformed from records""")
def _(t: Tables) -> DataFrame:
    return lists.unpack_records(_select(t.lineitem, LEDGER), "batch_detail_text", ["gl_entry_id"], FIELDS)


@query("ledger_invoice_reconciliation", "K19,D13", f"""
    with {RECORDS_SQL}, ledger as ({LEDGER}),
    sums as (select gl_entry_id, count(*) as n_records, count(*) filter (where malformed) as n_malformed,
                    sum(try_cast(invoice_amount as decimal(10,2))) filter (where not malformed) as records_total from records group by all)
    select gl_entry_id, coalesce(n_records, 0)::bigint as n_records, coalesce(n_malformed, 0)::bigint as n_malformed,
        cast(coalesce(records_total, 0) as decimal(18,2)) as records_total, amount, cast(amount - coalesce(records_total, 0) as decimal(18,2)) as difference
    from ledger left join sums using (gl_entry_id)""")
def _(t: Tables) -> DataFrame:
    ledger = _select(t.lineitem, LEDGER)
    lines = lists.unpack_records(ledger, "batch_detail_text", ["gl_entry_id"], FIELDS)
    amounts = lines.withColumn("invoice_amount", F.col("invoice_amount").try_cast("decimal(10,2)"))
    return lists.reconcile(ledger, amounts, "gl_entry_id", "amount", "invoice_amount")


# --- keys: six columns that join a quarter of the rows to their neighbour, and their six opposites; only such a pair is a key

BITS = range(1, 7)
TWINS = {f"{name}{i}": f"o_orderkey - (o_orderkey % 2) * {'' if name == 'a' else '(1 - '}(floor(o_orderkey / {2**i}) % 2){'' if name == 'a' else ')'}"
         for i in BITS for name in "ab"}
TWINS_SQL = "(select " + ", ".join(f"cast({e} as bigint) as {c}" for c, e in TWINS.items()) + " from orders)"


@query("accepted_keys_of_twelve_columns", "L4", f"""
    with s as materialized {TWINS_SQL}, pairs as (""" + " union all ".join(
    f"select '{a}, {b}' as key_columns, 2 as key_size, count(distinct ({a}, {b})) / count(*) as uniqueness_ratio from s" for a, b in combinations(TWINS, 2))
    + ") select * from pairs where uniqueness_ratio >= 0.99")
def _(t: Tables) -> DataFrame:
    return discovery.accepted_keys(t.orders.selectExpr(*[f"cast({e} as bigint) as {c}" for c, e in TWINS.items()]))


@query("candidate_keys_of_twelve_columns", "L4,L5", f"""
    with s as materialized {TWINS_SQL} """ + " union all ".join(
    [f"select '{c}' as key_columns, 1 as key_size, count(distinct {c}) / count(*) as uniqueness_ratio from s" for c in TWINS]
    + [f"select '{a}, {b}', 2, count(distinct ({a}, {b})) / count(*) from s" for a, b in combinations(TWINS, 2)]))
def _(t: Tables) -> DataFrame:
    return discovery.candidate_keys(t.orders.selectExpr(*[f"cast({e} as bigint) as {c}" for c, e in TWINS.items()]))


# --- personal data by form and check

def luhn_sql(digits: str) -> str:
    digit = f"cast(substr(reverse({digits}), (i + 1)::int, 1) as int)"
    return f"(list_sum(list_transform(range(length({digits})), lambda i: case when i % 2 = 0 then {digit} when {digit} > 4 then {digit} * 2 - 9 else {digit} * 2 end)) % 10 = 0)"


NOTES = """select o_orderkey, 'order ' || lpad(cast(o_orderkey * 7919 as string), 16, '4') || ' via 10.' || cast(o_orderkey % 400 as string) || '.2.1 for '
    || lpad(cast(o_custkey % 1000 as string), 3, '0') || '-' || lpad(cast(o_orderkey % 100 as string), 2, '0') || '-' || lpad(cast(o_orderkey % 3000 as string), 4, '0')
    as note, o_orderstatus as status from orders"""
PARTS_SQL = """select o_orderkey, note, substr(note, 7, 16) as card, split_part(split_part(note, ' via ', 2), ' for ', 1) as ip, split_part(note, ' for ', 2) as ssn from notes"""
CARD_OK = luhn_sql("card")
IP_OK = "(cast(split_part(ip, '.', 2) as int) <= 255)"
SSN_OK = "(ssn[:3] not in ('000', '666') and ssn[1] <> '9' and ssn[5:6] <> '00' and ssn[8:] <> '0000')"


@query("pii_columns_validated", "L13", f"""
    with notes as ({NOTES}), parts as ({PARTS_SQL})
    select 'note' as column_name, 0::bigint as "EMAIL_ADDRESS", count(*) filter (where {SSN_OK}) as "US_SSN", count(*) filter (where {CARD_OK}) as "CREDIT_CARD",
        count(*) filter (where {IP_OK}) as "IP_ADDRESS", 0::bigint as "PHONE_NUMBER" from parts""")
def _(t: Tables) -> DataFrame:
    return pii.pii_by_value(_select(t.orders, NOTES), validated=True).select("column_name", *pii.PII_PATTERNS)


@query("redact_validated", "L14", f"""
    with notes as ({NOTES}), parts as ({PARTS_SQL})
    select o_orderkey, case when {CARD_OK} or {IP_OK} or {SSN_OK} then 'order ' || if({CARD_OK}, '[REDACTED:CREDIT_CARD]', card) || ' via ' || if({IP_OK}, '[REDACTED:IP_ADDRESS]', ip)
        || ' for ' || if({SSN_OK}, '[REDACTED:US_SSN]', ssn) else '[REDACTED]' end as note from parts""")
def _(t: Tables) -> DataFrame:
    return pii.redact(_select(t.orders, NOTES).select("o_orderkey", "note"), ["note"], validated=True)


# --- several levels of totals in one scan

BATCHES_SQL = f"""select b.park_id, region_id, date_trunc('month', batch_date)::date as month, cast(gross_revenue as decimal(18,2)) as revenue
    from ({raw_sql('vistareserve.revenue_batch')}) b left join ({raw_sql('vistareserve.parks')}) p on p.park_id = b.park_id"""


@query("revenue_totals_by_level", "E2,E3,E6", f"""
    with b as ({BATCHES_SQL})
    select region_id, park_id, month, (grouping(region_id) * 4 + grouping(park_id) * 2 + grouping(month))::int as level,
        sum(revenue)::decimal(28,2) as revenue, count(*) as batches
    from b group by grouping sets ((region_id, park_id, month), (region_id, month), (region_id), ())""")
def _(t: Tables) -> DataFrame:
    batches = t.raw("vistareserve.revenue_batch").select(
        "park_id", F.trunc("batch_date", "month").alias("month"), F.col("gross_revenue").cast("decimal(18,2)").alias("revenue"))
    placed = joins.left_lookup(batches, t.raw("vistareserve.parks"), ["park_id"], ["region_id"])
    sets = [["region_id", "park_id", "month"], ["region_id", "month"], ["region_id"], []]
    return aggregates.grouping_totals(placed, sets, {"revenue": F.sum("revenue"), "batches": F.count("*")})


# --- clustered and partitioned storage, hot keys

@query("join_clustered_tables", "A4,D1", """
    select o_orderkey, o_orderstatus, count(l_linenumber) as lines, sum(cast(l_quantity as bigint))::bigint as quantity
    from orders left join lineitem on l_orderkey = o_orderkey group by all""")
def _(t: Tables) -> DataFrame:
    orders = sources.store_clustered(t.orders.select("o_orderkey", "o_orderstatus"), "orders_by_key", ["o_orderkey"], 8)
    lines = sources.store_clustered(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), "lines_by_key", ["l_orderkey"], 8)
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").groupBy("o_orderkey", "o_orderstatus").agg(
        F.count("l_linenumber").alias("lines"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))


@query("restored_month", "A4", """
    with last as (select max(date_trunc('month', o_orderdate)) as m from orders)
    select o_orderkey, case when date_trunc('month', o_orderdate) = m then 'restored' else o_orderstatus end as status,
        strftime(o_orderdate, '%Y-%m') as month from orders, last""")
def _(t: Tables) -> DataFrame:
    path = f"{shared_dir(t.spark)}/orders_by_month/{uuid.uuid4().hex}"
    orders = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("status"), F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    sources.store_partitions(orders, path, ["month"])
    # storing the last month again leaves the other months as they are
    last = orders.agg(F.max("month").alias("month"))
    sources.store_partitions(orders.join(last, "month").withColumn("status", F.lit("restored")), path, ["month"])
    return t.spark.read.schema("o_orderkey bigint, status string, month string").parquet(path)


HOT_LINES = "(select l_orderkey, l_linenumber, case when l_orderkey % 3 = 0 then 1 else l_suppkey end as supplier from lineitem)"


@query("join_hot_keys", "D1", f"select l_orderkey, l_linenumber, supplier, s_name from {HOT_LINES} left join supplier on s_suppkey = supplier")
def _(t: Tables) -> DataFrame:
    # a third of all lines share one supplier
    lines = t.lineitem.select("l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("l_suppkey")).alias("supplier"))
    return joins.hot_lookup(lines, t.supplier, ("supplier", "s_suppkey"), ["s_name"], joins.hot_keys(lines, "supplier", 0.1))
