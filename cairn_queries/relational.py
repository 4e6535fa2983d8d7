"""Filters, joins, aggregates, windows, set operations and generators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn import functions as fn
from cairn.operators import aggregates as agg
from cairn.operators import dedup, filters, joins, reshape
from cairn.plans import marts
from cairn_queries.fixtures import Tables, raw_sql

from cairn_queries.registry import query

OK = "o_orderkey"
PRICE = "cast(o_totalprice as decimal(12,2))"


def money(c: str):
    return F.col(c).cast("decimal(12,2)")


# --- filters

@query("filter_live_rows", "C1", f"select * from ({raw_sql('peoplefirst.employees')}) where _is_deleted = false")
def _(t: Tables) -> DataFrame:
    return filters.live_rows(t.raw("peoplefirst.employees"), "_is_deleted")


@query("filter_in_list", "C2", "select o_orderkey, o_orderpriority from orders where o_orderpriority in ('1-URGENT', '2-HIGH', 'low')")
def _(t: Tables) -> DataFrame:
    return t.orders.select(OK, "o_orderpriority").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "low"))


@query("filter_equals", "C3", "select l_orderkey, l_linenumber from lineitem where l_returnflag = 'R'")
def _(t: Tables) -> DataFrame:
    return t.lineitem.where(F.col("l_returnflag") == "R").select("l_orderkey", "l_linenumber")


@query("filter_valid_intervals", "C4", f"""
    select reservation_id, arrival_date, departure_date from ({raw_sql('vistareserve.reservations')})
    where departure_date > arrival_date""")
def _(t: Tables) -> DataFrame:
    stays = t.raw("vistareserve.reservations").select("reservation_id", "arrival_date", "departure_date")
    return filters.valid_intervals(stays, "arrival_date", "departure_date")


@query("filter_any_present", "C5", f"""
    select award_id, fy2020_budgeted, fy2020_actual from ({raw_sql('granttrack.award_budget_by_fiscal_year')})
    where not (fy2020_budgeted is null and fy2020_actual is null)""")
def _(t: Tables) -> DataFrame:
    cols = ["fy2020_budgeted", "fy2020_actual"]
    return filters.any_present(t.raw("granttrack.award_budget_by_fiscal_year").select("award_id", *cols), cols)


@query("filter_like", "C6", "select doc_id, source from documents where source like '%src1%'")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "source").where(F.col("source").like("%src1%"))


@query("filter_prefix_and_not_contains", "C7", """
    select page_id, url from pages where url like 'http%' and not (url like '%example.org%' or (url like '%/en/%' and url like '%ref=%'))""")
def _(t: Tables) -> DataFrame:
    url = F.col("url")
    kept = url.startswith("http") & ~(url.contains("example.org") | (url.contains("/en/") & url.contains("ref=")))
    return t.pages.select("page_id", "url").where(kept)


@query("filter_non_blank", "C8", """
    select part_no, label from (select p_partkey as part_no, case when p_partkey % 5 = 0 then null when p_partkey % 7 = 0 then '' else p_name end as label
    from part) where coalesce(label, '') <> ''""")
def _(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    label = F.when(k % 5 == 0, F.lit(None)).when(k % 7 == 0, F.lit("")).otherwise(F.col("p_name"))
    return filters.non_blank(t.part.select(k.alias("part_no"), label.alias("label")), "label")


@query("having_conditional_sum", "C9,E8", """
    select l_suppkey, sum(case when l_returnflag = 'R' then 1 else 0 end)::bigint as returned from lineitem group by l_suppkey
    having sum(case when l_returnflag = 'R' then 1 else 0 end) > 0""")
def _(t: Tables) -> DataFrame:
    returned = agg.count_if(F.col("l_returnflag") == "R").alias("returned")
    return t.lineitem.groupBy("l_suppkey").agg(returned).where(F.col("returned") > 0)


# --- joins

@query("join_left_equi", "D1", "select o_orderkey, c_name, c_mktsegment from orders left join customer on c_custkey = o_custkey")
def _(t: Tables) -> DataFrame:
    return joins.left_lookup(t.orders.select(OK, "o_custkey"), t.customer, {"o_custkey": "c_custkey"},
                             ["c_name", "c_mktsegment"]).drop("o_custkey")


@query("join_left_salted", "D1", "select l_orderkey, l_linenumber, l_suppkey, s_name from lineitem left join supplier on s_suppkey = l_suppkey")
def _(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
    return joins.left_lookup(lines, t.supplier, {"l_suppkey": "s_suppkey"}, ["s_name"], salts=4)


@query("join_cast_keys", "D2", f"""
    select r.reservation_id, c.c_name from ({raw_sql('vistareserve.reservations')}) r left join customer c on cast(c.c_custkey as varchar) = r.customer_id""")
def _(t: Tables) -> DataFrame:
    return joins.left_lookup(t.raw("vistareserve.reservations").select("reservation_id", "customer_id"), t.customer,
                             {"customer_id": "c_custkey"}, ["c_name"], cast=True).drop("customer_id")


@query("join_computed_key", "D3", f"""
    select a.asset_id, g.park_name from ({raw_sql('vistareserve.inventory_assets')}) a
    left join ({raw_sql('geoparks.parks_master')}) g on g.geo_park_id = printf('GP-%03d', a.park_id)""")
def _(t: Tables) -> DataFrame:
    return joins.lookup_on(t.raw("vistareserve.inventory_assets").select("asset_id", "park_id"),
                           t.raw("geoparks.parks_master"), fn.padded_key("park_id"), "geo_park_id", ["park_name"]
                           ).drop("park_id")


@query("join_composite_key", "D4", """
    with best as (select l_orderkey, l_suppkey, max(l_quantity) as q from lineitem group by all)
    select o_orderkey, q from orders left join best on l_orderkey = o_orderkey and l_suppkey = o_orderkey % 10""")
def _(t: Tables) -> DataFrame:
    best = t.lineitem.groupBy("l_orderkey", "l_suppkey").agg(F.max("l_quantity").alias("q"))
    keyed = t.orders.select(OK, (F.col(OK) % 10).alias("supp"))
    return joins.left_lookup(keyed, best, {OK: "l_orderkey", "supp": "l_suppkey"}, ["q"]).drop("supp")


@query("join_two_hops", "D5", """
    select s_suppkey, n_name, r_name from supplier left join nation on n_nationkey = s_nationkey left join region on r_regionkey = n_regionkey""")
def _(t: Tables) -> DataFrame:
    placed = joins.left_lookup(t.supplier.select("s_suppkey", "s_nationkey"), t.nation, {"s_nationkey": "n_nationkey"},
                               ["n_name", "n_regionkey"])
    return joins.left_lookup(placed, t.region, {"n_regionkey": "r_regionkey"}, ["r_name"]).select("s_suppkey", "n_name", "r_name")


@query("join_inner_filtered", "D6", """
    select o_orderkey, l_linenumber, l_partkey, l_quantity from orders join lineitem on l_orderkey = o_orderkey where o_orderstatus in ('F', 'P')""")
def _(t: Tables) -> DataFrame:
    done = t.orders.where(F.col("o_orderstatus").isin("F", "P")).select(OK)
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return done.join(lines, F.col(OK) == F.col("l_orderkey")).drop("l_orderkey")


@query("join_nights_on_site", "D7", f"""
    with s as (select o_orderkey, cast(o_orderdate as date) as a, cast(o_orderdate as date) + cast(o_orderkey % 6 as int) as b from orders),
    d as (select cast(unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as date) as full_date from orders)
    select o_orderkey, full_date from s join d on d.full_date >= s.a and d.full_date < s.b""")
def _(t: Tables) -> DataFrame:
    start = F.col("o_orderdate").cast("date")
    stays = t.orders.select(OK, start.alias("a"), F.date_add(start, (F.col(OK) % 6).cast("int")).alias("b"))
    days = reshape.spine_of(t.orders, "o_orderdate", "full_date")
    return joins.nights_on_site(stays, "a", "b", days).select(OK, "full_date")


BOOKED_SQL = f"select o_custkey % 40 as park, cast(o_orderdate as date) as day, count(*) as booked from orders group by all"
SENSED_SQL = "select l_suppkey % 50 as park, cast(l_shipdate as date) as day, cast(sum(cast(l_quantity as int)) as bigint) as sensed from lineitem group by all"


def booked(t: Tables) -> DataFrame:
    return t.orders.groupBy((F.col("o_custkey") % 40).alias("park"), F.col("o_orderdate").cast("date").alias("day")
                            ).agg(F.count("*").alias("booked"))


def sensed(t: Tables) -> DataFrame:
    return t.lineitem.groupBy((F.col("l_suppkey") % 50).alias("park"), F.col("l_shipdate").cast("date").alias("day")
                              ).agg(F.sum(F.col("l_quantity").cast("int")).alias("sensed"))


@query("join_full_outer", "D8", f"""
    select coalesce(a.park, b.park) as park, coalesce(a.day, b.day) as day, booked, sensed
    from ({BOOKED_SQL}) a full join ({SENSED_SQL}) b on a.park = b.park and a.day = b.day""")
def _(t: Tables) -> DataFrame:
    return joins.full_outer(booked(t), sensed(t), ["park", "day"])


MERGE_CTES = f"""
    with f as (select nullif(o_custkey % 20, 3) as park, date_trunc('month', o_orderdate) as mon, count(*) as a from orders group by all),
    v as (select nullif(l_suppkey % 25, 3) as park, date_trunc('month', l_shipdate) as mon, count(*) as b from lineitem group by all),
    o as (select nullif(user_id % 20, 3) as park, date_trunc('month', ts) as mon, count(*) as c from events group by all)"""


def _three(t: Tables) -> list[DataFrame]:
    def grouped(df: DataFrame, k: str, n: int, when: str, name: str) -> DataFrame:
        return df.groupBy(F.nullif(F.col(k) % n, F.lit(3)).alias("park"), fn.month_of(when).alias("mon")
                          ).agg(F.count("*").alias(name))
    return [grouped(t.orders, "o_custkey", 20, "o_orderdate", "a"),
            grouped(t.lineitem, "l_suppkey", 25, "l_shipdate", "b"),
            grouped(t.events, "user_id", 20, "ts", "c")]


@query("join_full_outer_three_way", "D9,D10,Q1", MERGE_CTES + """,
    fv as (select coalesce(f.park, v.park) as park, coalesce(f.mon, v.mon) as mon from f full join v on f.park = v.park and f.mon = v.mon),
    k as (select coalesce(fv.park, o.park) as park, coalesce(fv.mon, o.mon) as mon from fv full join o on fv.park = o.park and fv.mon = o.mon)
    select k.park, k.mon, f.a, v.b, o.c from k left join f on f.park = k.park and f.mon = k.mon
    left join v on v.park = k.park and v.mon = k.mon left join o on o.park = k.park and o.mon = k.mon""")
def _(t: Tables) -> DataFrame:
    return joins.merge_aggregates(_three(t), ["park", "mon"])


@query("join_full_outer_null_safe", "Q1,Q2", MERGE_CTES + """
    select park, mon, max(a) as a, max(b) as b, max(c) as c from (
        select park, mon, a, null as b, null as c from f union all select park, mon, null, b, null from v
        union all select park, mon, null, null, c from o) group by park, mon""")
def _(t: Tables) -> DataFrame:
    return joins.merge_aggregates(_three(t), ["park", "mon"], null_safe=True)


@query("join_attach_to_keys", "D10", MERGE_CTES + """,
    k as (select park, mon from f union select park, mon from v)
    select k.park, k.mon, f.a, v.b from k left join f on f.park = k.park and f.mon = k.mon left join v on v.park = k.park and v.mon = k.mon""")
def _(t: Tables) -> DataFrame:
    f, v, _o = _three(t)
    return joins.attach_to_keys(reshape.key_union([f, v], ["park", "mon"]), [f, v], ["park", "mon"])


@query("join_anti_not_exists", "D11", """
    select o_orderkey from orders o where not exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey and l.l_returnflag = 'R' and l.l_quantity > 10)""")
def _(t: Tables) -> DataFrame:
    return joins.orphans(t.orders.select(OK), t.lineitem, {OK: "l_orderkey"},
                         (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 10))


@query("join_anti_left_null", "D12", """
    select o.o_orderkey, o.k from (select o_orderkey, nullif(o_custkey % 130, 0) as k from orders) o left join supplier s on s.s_suppkey = o.k
    where s.s_suppkey is null""")
def _(t: Tables) -> DataFrame:
    keyed = t.orders.select(OK, F.nullif(F.col("o_custkey") % 130, F.lit(0)).alias("k"))
    return joins.orphans(keyed, t.supplier, {"k": "s_suppkey"})


@query("join_totals_that_differ", "D13", f"""
    select * from (select sum({PRICE})::decimal(22,2) as ordered from orders)
    cross join (select sum(cast(l_extendedprice as decimal(12,2)))::decimal(22,2) as shipped from lineitem) where round(ordered, 2) <> round(shipped, 2)""")
def _(t: Tables) -> DataFrame:
    return joins.compare_totals(t.orders.agg(F.sum(money("o_totalprice")).alias("ordered")),
                                t.lineitem.agg(F.sum(money("l_extendedprice")).alias("shipped")), {"ordered": "shipped"})


@query("join_seed_expression_key", "D14", """
    select c_custkey, r_name from customer left join region on 'R' || (c_nationkey % 7) = 'R' || r_regionkey""")
def _(t: Tables) -> DataFrame:
    seed = t.region.select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("code"), "r_name")
    code = F.concat(F.lit("R"), (F.col("c_nationkey") % 7).cast("string"))
    return joins.lookup_on(t.customer.select("c_custkey", "c_nationkey"), seed, code, "code", ["r_name"]).drop("c_nationkey")


@query("join_on_value_coincidence", "D15,E5", f"""
    select g.gl_entry_id, g.account_id, g.amount, v.vendor_id from ({raw_sql('stategov.general_ledger')}) g
    left join (select account_id, amount, max(cast(vendor_id as varchar)) as vendor_id from ({raw_sql('stategov.accounts_payable')}) group by all) v
    on v.account_id = g.account_id and cast(v.amount as decimal(12,2)) = cast(g.amount as decimal(12,2))""")
def _(t: Tables) -> DataFrame:
    ledger = t.raw("stategov.general_ledger").select("gl_entry_id", "account_id", "amount", money("amount").alias("cents"))
    paid = t.raw("stategov.accounts_payable").select("account_id", money("amount").alias("cents"), "vendor_id")
    return joins.match_on_value(ledger, paid, ["account_id", "cents"], "vendor_id").drop("cents")


@query("join_first_match", "D16,F2", f"""
    select g.gl_entry_id, w.award_id from (select gl_entry_id, regexp_extract(account_id, '^(\\d+)-DIV', 1) as fund from ({raw_sql('stategov.general_ledger')})) g
    left join (select sgf_appropriation_code as fund, arg_min(award_id, row(performance_end is null, -epoch(performance_end), award_id)) as award_id
               from ({raw_sql('granttrack.active_awards')}) group by 1) w using (fund)""")
def _(t: Tables) -> DataFrame:
    fund = fn.split_account("account_id")["account_fund_code"]
    ledger = t.raw("stategov.general_ledger").select("gl_entry_id", fund.alias("fund"))
    return joins.lookup_first(ledger, t.raw("granttrack.active_awards"), {"fund": "sgf_appropriation_code"},
                              [F.desc_nulls_last("performance_end"), F.asc_nulls_last("award_id")], ["award_id"]).drop("fund")


# --- aggregates

@query("group_by_key_and_day", "E1", """
    select user_id, cast(ts as date) as day, cast(sum(cast(floor(value) as int)) as bigint) as total, count(*) as n from events group by all""")
def _(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(
        F.sum(F.floor("value").cast("int")).alias("total"), F.count("*").alias("n"))


@query("group_by_month", "E2", f"""
    select o_orderstatus, date_trunc('month', o_orderdate) as report_month, cast(sum({PRICE}) as decimal(22,2)) as amount from orders group by all""")
def _(t: Tables) -> DataFrame:
    return agg.by_month(t.orders, ["o_orderstatus"], "o_orderdate", {"amount": F.sum(money("o_totalprice"))})


@query("group_count_sum_avg", "E3", """
    select l_returnflag, l_linestatus, count(*) as n, cast(sum(cast(l_quantity as int)) as bigint) as quantity,
        cast(cast((2 * sum(cast(l_quantity as int)) * 100 + count(*)) // (2 * count(*)) as decimal(30,0)) * 0.01 as decimal(14,2)) as avg_quantity
    from lineitem group by all""")
def _(t: Tables) -> DataFrame:
    q = F.col("l_quantity").cast("int")
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.sum(q).alias("quantity"),
        fn.report_decimal(F.avg(q.cast("decimal(12,0)")), 14, 2).alias("avg_quantity"))


@query("group_then_calendar", "E4", f"""
    with d as (select *, cast(o_orderdate as date) as full_date from orders)
    select o_orderstatus, full_date, extract(year from full_date) as calendar_year, extract(quarter from full_date) as calendar_quarter,
        cast(year(full_date + interval 6 month) as integer) as fiscal_year, dayname(full_date) as day_name,
        count(*) as n, cast(sum({PRICE}) as decimal(22,2)) as amount from d group by all""")
def _(t: Tables) -> DataFrame:
    daily = t.orders.groupBy("o_orderstatus", F.col("o_orderdate").cast("date").alias("full_date")).agg(
        F.count("*").alias("n"), F.sum(money("o_totalprice")).alias("amount"))
    dates = marts.calendar(reshape.spine_of(t.orders, "o_orderdate"))
    return joins.left_lookup(daily, dates, ["full_date"], ["calendar_year", "calendar_quarter", "fiscal_year", "day_name"])


@query("max_id_as_text", "E5", "select l_orderkey, max(cast(l_partkey as varchar)) as part_id from lineitem group by l_orderkey")
def _(t: Tables) -> DataFrame:
    return dedup.pick_max(t.lineitem, ["l_orderkey"], {"part_id": F.col("l_partkey").cast("string")})


@query("global_totals", "E6", f"""
    select cast(coalesce(sum({PRICE}), 0) as decimal(22,2)) as total, cast(coalesce(sum({PRICE}) filter (where o_orderkey < 0), 0) as decimal(22,2)) as nothing from orders""")
def _(t: Tables) -> DataFrame:
    return agg.totals(t.orders, total=F.sum(money("o_totalprice")),
                      nothing=F.sum(F.when(F.col(OK) < 0, money("o_totalprice"))))


@query("count_distinct_per_group", "E7", "select l_suppkey, count(distinct l_partkey) as parts from lineitem group by l_suppkey")
def _(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("parts"))


@query("distinct_rows", "E9", "select distinct l_returnflag, l_linestatus, l_suppkey from lineitem")
def _(t: Tables) -> DataFrame:
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_suppkey").distinct()


@query("distinct_by_group", "E10", "select l_suppkey, date_trunc('month', l_shipdate) as report_month from lineitem group by 1, 2")
def _(t: Tables) -> DataFrame:
    return t.lineitem.select("l_suppkey", fn.month_of("l_shipdate").alias("report_month")).dropDuplicates()


# --- windows

@query("latest_per_key", "F1", """
    select * exclude rn from (select o_custkey, o_orderkey, o_orderdate, o_totalprice,
        row_number() over (partition by o_custkey order by o_orderdate desc nulls last, o_orderkey) as rn from orders) where rn = 1""")
def _(t: Tables) -> DataFrame:
    return dedup.latest_per_key(t.orders.select("o_custkey", OK, "o_orderdate", "o_totalprice"), ["o_custkey"],
                                [F.desc_nulls_last("o_orderdate"), F.asc_nulls_last(OK)])


@query("first_per_key_nulls_last", "F2", f"""
    select distinct on (sgf_appropriation_code) sgf_appropriation_code, award_id, performance_end from ({raw_sql('granttrack.active_awards')})
    order by sgf_appropriation_code, performance_end desc nulls last, award_id""")
def _(t: Tables) -> DataFrame:
    return dedup.first_per_key(t.raw("granttrack.active_awards").select("sgf_appropriation_code", "award_id", "performance_end"),
                               ["sgf_appropriation_code"], [F.desc_nulls_last("performance_end"), F.asc_nulls_last("award_id")])


@query("drop_exact_duplicates", "F3", f"select distinct * from ({raw_sql('granttrack.award_budget_by_fiscal_year')})")
def _(t: Tables) -> DataFrame:
    return dedup.drop_exact_duplicates(t.raw("granttrack.award_budget_by_fiscal_year"), ["award_id"])




@query("prefer_source_per_name", "F4", """
    with r as (select s_suppkey as id, s_name as name, 'GEO' as src from supplier union all
               select s_suppkey + 1000 as id, replace(s_name, '#', ' ') as name, 'REV' as src from supplier union all
               select s_suppkey + 5 as id, s_name || '.' as name, 'AST' as src from supplier)
    select unnest(arg_min({'id': id, 'name': name, 'src': src}, row(src <> 'GEO', id))) from r
    group by trim(regexp_replace(name, '[^a-zA-Z0-9 _-]', '', 'g'))""")
def _(t: Tables) -> DataFrame:
    return dedup.prefer_source(_registers(t), [fn.clean_string("name")], "src", ["GEO"], ["id"])


def _registers(t: Tables) -> DataFrame:
    s = t.supplier
    return reshape.union_conformed([
        s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("GEO").alias("src")),
        s.select((F.col("s_suppkey") + 1000).alias("id"), F.replace("s_name", F.lit("#"), F.lit(" ")).alias("name"),
                 F.lit("REV").alias("src")),
        s.select((F.col("s_suppkey") + 5).alias("id"), F.concat("s_name", F.lit(".")).alias("name"), F.lit("AST").alias("src"))])


@query("golden_record", "F4,F5", """
    with r as (select s_suppkey as id, s_name as name, 'GEO' as src, s_acctbal as bal, null::int as nation from supplier union all
               select s_suppkey + 1000, s_name || '!', 'REV', null, s_nationkey from supplier union all
               select s_suppkey + 5, s_name || '.', 'AST', 100.0, s_nationkey + 1 from supplier)
    select id, name, src, bal, nation from (select id, name, src,
        max(bal) over w as bal, max(nation) over w as nation,
        row_number() over (partition by trim(regexp_replace(name, '[^a-zA-Z0-9 _-]', '', 'g')) order by if(src = 'GEO', 1, 2), id) as rn
        from r window w as (partition by trim(regexp_replace(name, '[^a-zA-Z0-9 _-]', '', 'g')))) where rn = 1""")
def _(t: Tables) -> DataFrame:
    s = t.supplier
    rows = reshape.union_conformed([
        s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("GEO").alias("src"),
                 F.col("s_acctbal").alias("bal")),
        s.select((F.col("s_suppkey") + 1000).alias("id"), F.concat("s_name", F.lit("!")).alias("name"),
                 F.lit("REV").alias("src"), F.col("s_nationkey").alias("nation")),
        s.select((F.col("s_suppkey") + 5).alias("id"), F.concat("s_name", F.lit(".")).alias("name"), F.lit("AST").alias("src"),
                 F.lit(100.0).alias("bal"), (F.col("s_nationkey") + 1).alias("nation"))])
    return dedup.golden_record(rows, fn.clean_string("name"), ["bal", "nation"], "src", ["GEO"], ["id"])


# --- sort, limit, top-k

@query("top_n_two_keys", "G1", """
    select p_brand, count(*) as n, max(p_size) as biggest from part group by p_brand order by n desc, biggest desc, p_brand limit 10""")
def _(t: Tables) -> DataFrame:
    brands = t.part.groupBy("p_brand").agg(F.count("*").alias("n"), F.max("p_size").alias("biggest"))
    return agg.top_n(brands, [F.desc("n"), F.desc("biggest"), F.asc("p_brand")], 10)


@query("sorted_report", "G2", "select n_name, n_regionkey, count(*) as suppliers from nation join supplier on s_nationkey = n_nationkey group by all order by n_name")
def _(t: Tables) -> DataFrame:
    return (t.supplier.groupBy("s_nationkey").agg(F.count("*").alias("suppliers"))
            .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .select("n_name", "n_regionkey", "suppliers").orderBy("n_name"))


@query("top_values_per_group", "G3", """
    select l_returnflag, l_suppkey, n from (select l_returnflag, l_suppkey, count(*) as n from lineitem group by all)
    qualify row_number() over (partition by l_returnflag order by n desc, l_suppkey) <= 5""")
def _(t: Tables) -> DataFrame:
    counts = t.lineitem.groupBy("l_returnflag", "l_suppkey").agg(F.count("*").alias("n"))
    return dedup.first_per_key(counts, ["l_returnflag"], [F.desc("n"), F.asc("l_suppkey")], 5)


# --- set operations and generators

@query("union_conformed_sources", "H1,B35", """
    select c_custkey as id, c_name as name, c_mktsegment as segment, null::decimal(12,2) as price from customer
    union all select s_suppkey, s_name, null, null from supplier
    union all select p_partkey, p_name, null, cast(p_retailprice as decimal(12,2)) from part""")
def _(t: Tables) -> DataFrame:
    return reshape.union_conformed([
        t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")),
        t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")),
        t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), money("p_retailprice").alias("price"))])


@query("union_distinct_keys", "H2", """
    select o_custkey % 50 as park, date_trunc('month', o_orderdate) as mon from orders union
    select l_suppkey % 60, date_trunc('month', l_shipdate) from lineitem""")
def _(t: Tables) -> DataFrame:
    return reshape.key_union([
        t.orders.select((F.col("o_custkey") % 50).alias("park"), fn.month_of("o_orderdate").alias("mon")),
        t.lineitem.select((F.col("l_suppkey") % 60).alias("park"), fn.month_of("l_shipdate").alias("mon"))], ["park", "mon"])


@query("union_catalog_lists", "H3", """
    select entity, column_name from (select p_brand as entity, p_name as column_name from part union all
    select s_name, nullif('col' || s_nationkey, 'col3') from supplier union all select c_mktsegment, c_name from customer)
    where column_name is not null and column_name <> ''""")
def _(t: Tables) -> DataFrame:
    nation = F.nullif(F.concat(F.lit("col"), F.col("s_nationkey").cast("string")), F.lit("col3"))
    lists = [t.part.select(F.col("p_brand").alias("entity"), F.col("p_name").alias("column_name")),
             t.supplier.select(F.col("s_name").alias("entity"), nation.alias("column_name")),
             t.customer.select(F.col("c_mktsegment").alias("entity"), F.col("c_name").alias("column_name"))]
    return filters.non_blank(reshape.union_conformed(lists), "column_name")


@query("unpivot_wide_pairs", "I1", f"""
    select award_id, y as fiscal_year, b as budgeted, a as actual from ({raw_sql('granttrack.award_budget_by_fiscal_year')}),
    lateral (values (2020, fy2020_budgeted, fy2020_actual), (2021, fy2021_budgeted, fy2021_actual), (2022, fy2022_budgeted, fy2022_actual),
        (2023, fy2023_budgeted, fy2023_actual), (2024, fy2024_budgeted, fy2024_actual), (2025, fy2025_budgeted, fy2025_actual)) v(y, b, a)""")
def _(t: Tables) -> DataFrame:
    return reshape.unpivot_groups(
        t.raw("granttrack.award_budget_by_fiscal_year"), ["award_id"], "fiscal_year",
        {y: {"budgeted": f"fy{y}_budgeted", "actual": f"fy{y}_actual"} for y in range(2020, 2026)})


@query("date_spine_of_data", "I2", """
    select cast(d as date) as date_day, coalesce(n, 0) as orders_that_day from (select unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as d from orders)
    left join (select o_orderdate, count(*) as n from orders group by 1) on o_orderdate = d""")
def _(t: Tables) -> DataFrame:
    spine = reshape.spine_of(t.orders, "o_orderdate")
    daily = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("date_day")).agg(F.count("*").alias("n"))
    return joins.left_lookup(spine, daily, ["date_day"], ["n"]).select("date_day", fn.zero("n").alias("orders_that_day"))


@query("date_spine_fixed", "I2", """
    select cast(d as date) as date_day, count(o_orderkey) as orders_that_day from range(timestamp '1994-01-01', timestamp '1997-01-01', interval 1 day) s(d)
    left join orders on cast(o_orderdate as date) = cast(d as date) group by 1""")
def _(t: Tables) -> DataFrame:
    spine = reshape.date_spine(t.spark, "1994-01-01", "1997-01-01")
    daily = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("date_day")).agg(F.count("*").alias("n"))
    return joins.left_lookup(spine, daily, ["date_day"], ["n"]).select("date_day", fn.zero("n").alias("orders_that_day"))
