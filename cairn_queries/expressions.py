"""One query per column expression, over whole driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn import functions as fn
from cairn.functions.dates import MIXED_DATE_FORMATS
from cairn.operators.projection import cast_columns, keep_and_add, spec_from_schema
from cairn_queries.fixtures import Tables, raw_sql
from cairn_queries.models import AS_OF, DERIVED_SQL, key
from cairn_queries.registry import query

OK = "o_orderkey"
ACCOUNT_SQL = DERIVED_SQL["stg_stategov__general_ledger"]


@query("cast_projection", "B1", """
    select cast(l_orderkey as varchar) as order_id, cast(l_linenumber as integer) as line_no,
        cast(l_extendedprice as decimal(12,2)) as gross_amount, cast(l_shipdate as date) as shipped_on from lineitem""")
def _(t: Tables) -> DataFrame:
    return cast_columns(
        t.lineitem,
        {"l_orderkey": "string", "l_linenumber": "int", "l_extendedprice": "decimal(12,2)", "l_shipdate": "date"},
        {"l_orderkey": "order_id", "l_linenumber": "line_no", "l_extendedprice": "gross_amount",
         "l_shipdate": "shipped_on"})


@query("projection_from_schema", "B1a", """
    select cast(l_orderkey as bigint) as l_orderkey, cast(l_partkey as bigint) as l_partkey, l_suppkey, l_linenumber, l_quantity,
        l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate from lineitem""")
def _(t: Tables) -> DataFrame:
    return cast_columns(t.lineitem, spec_from_schema(t.lineitem))


@query("keep_and_add_columns", "B1b", f"""
    select *, {key('o_orderkey')} as order_sk, year(o_orderdate) as order_year from orders""")
def _(t: Tables) -> DataFrame:
    return keep_and_add(t.orders, order_sk=fn.surrogate_key(OK),
                        order_year=F.year("o_orderdate").cast("bigint"))


@query("surrogate_key_composite", "B2", f"""
    select o_orderkey, {key('o_orderkey', 'nullif(o_custkey % 7, 0)', 'o_orderstatus', 'cast(o_orderdate as date)')} as order_sk
    from orders""")
def _(t: Tables) -> DataFrame:
    gap = F.nullif(F.col("o_custkey") % 7, F.lit(0))
    return t.orders.select(OK, fn.surrogate_key(
        OK, gap, "o_orderstatus", F.col("o_orderdate").cast("date")).alias("order_sk"))


@query("surrogate_key_salted", "B3", f"""
    select c_custkey as id, {key("'customer'", 'c_custkey')} as sk from customer
    union all select s_suppkey as id, {key("'supplier'", 's_suppkey')} as sk from supplier""")
def _(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("id"), fn.salted_key("customer", "c_custkey").alias("sk")
                             ).unionAll(t.supplier.select("s_suppkey", fn.salted_key("supplier", "s_suppkey")))


@query("pii_hash", "B4", """
    select c_custkey, md5(if(c_custkey % 6 = 0, null, c_name)) as name_hash from customer""")
def _(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", fn.hash_pii(
        F.when(F.col("c_custkey") % 6 != 0, F.col("c_name"))).alias("name_hash"))


@query("source_system_tag", "B5", "select s_suppkey, 'FIN-01' as source_system from supplier")
def _(t: Tables) -> DataFrame:
    return t.supplier.select("s_suppkey", fn.source_tag("FIN-01").alias("source_system"))


@query("padded_business_key", "B6", """
    select o_orderkey, printf('GP-%03d', nullif(o_custkey % 1200, 0)) as account_number from orders""")
def _(t: Tables) -> DataFrame:
    return t.orders.select(OK, fn.padded_key(F.nullif(F.col("o_custkey") % 1200, F.lit(0))).alias("account_number"))


@query("id_to_string", "B7", "select cast(s_suppkey as varchar) as park_id from supplier")
def _(t: Tables) -> DataFrame:
    return t.supplier.select(fn.id_to_string("s_suppkey").alias("park_id"))


@query("clean_string", "B8", """
    select p_partkey, trim(regexp_replace(' ' || p_brand || '.,é  ' || p_name || '! ', '[^a-zA-Z0-9 _-]', '', 'g')) as cleaned,
        lower(trim(regexp_replace(' ' || p_brand || '.,é  ' || p_name || '! ', '[^a-zA-Z0-9 _-]', '', 'g'))) as folded from part""")
def _(t: Tables) -> DataFrame:
    text = F.concat(F.lit(" "), "p_brand", F.lit(".,é  "), "p_name", F.lit("! "))
    return t.part.select("p_partkey", fn.clean_string(text).alias("cleaned"),
                         fn.clean_string(text, fold_case=True).alias("folded"))


@query("split_account_code", "B9", f"""
    select log_sequence_id, {', '.join(f'{e} as {n}' for n, e in ACCOUNT_SQL.items() if n.startswith('account'))}
    from ({raw_sql('stategov.budget_activity_log')})""")
def _(t: Tables) -> DataFrame:
    parts = fn.split_account("account_id")
    return t.raw("stategov.budget_activity_log").select(
        "log_sequence_id", *[c.alias(n) for n, c in parts.items()])


@query("split_contact", "B10", f"""
    select application_id, split_part(primary_contact, '|', 1) as contact_name,
        if(primary_contact is null, null, coalesce(regexp_extract(primary_contact, '\\|([^|]*)\\|', 1), '')) as contact_email,
        if(primary_contact is null, null, coalesce(regexp_extract(primary_contact, '\\|([^|]*)$', 1), '')) as contact_phone
    from ({raw_sql('granttrack.grant_applications')})""")
def _(t: Tables) -> DataFrame:
    return t.raw("granttrack.grant_applications").select(
        "application_id", *[c.alias(n) for n, c in fn.split_contact("primary_contact").items()])


@query("tagged_counts", "B11", f"""
    select res_id, try_cast(nullif(regexp_extract(guest_info, 'Adults:(\\d+)', 1), '') as integer) as adults,
        try_cast(nullif(regexp_extract(guest_info, 'Vehicles:(\\d+)', 1), '') as integer) as vehicles
    from ({raw_sql('legacyres.legacy_reservations')})""")
def _(t: Tables) -> DataFrame:
    return t.raw("legacyres.legacy_reservations").select(
        "res_id", fn.tagged_count("guest_info", "Adults").alias("adults"),
        fn.tagged_count("guest_info", "Vehicles").alias("vehicles"))


@query("parse_money", "B12", f"""
    select award_id, try_cast(regexp_replace(fy2023_budgeted, '[$,]', '', 'g') as decimal(14,2)) as amount
    from ({raw_sql('granttrack.award_budget_by_fiscal_year')})""")
def _(t: Tables) -> DataFrame:
    return t.raw("granttrack.award_budget_by_fiscal_year").select(
        "award_id", fn.parse_money("fy2023_budgeted").alias("amount"))


@query("percent_to_rate", "B13", f"""
    select facility_type, cast(rtrim(senior_discount_pct, '%') as decimal(5,2)) / 100.0 as rate
    from ({raw_sql('legacyres.legacy_fee_schedule_wide')})""")
def _(t: Tables) -> DataFrame:
    return t.raw("legacyres.legacy_fee_schedule_wide").select(
        "facility_type", fn.percent_to_rate("senior_discount_pct").alias("rate"))


@query("parse_mixed_dates", "B14", f"""
    select deadline_id, {DERIVED_SQL['stg_granttrack__compliance_deadlines']['due_date']} as due_date
    from ({raw_sql('granttrack.compliance_deadlines')})""")
def _(t: Tables) -> DataFrame:
    return t.raw("granttrack.compliance_deadlines").select(
        "deadline_id", fn.parse_date("due_date", MIXED_DATE_FORMATS).alias("due_date"))


@query("parse_era_timestamps", "B15", f"""
    select res_id, {DERIVED_SQL['stg_legacyres__reservations']['arrival_date']} as arrived_at
    from ({raw_sql('legacyres.legacy_reservations')})""")
def _(t: Tables) -> DataFrame:
    return t.raw("legacyres.legacy_reservations").select(
        "res_id", fn.parse_era_timestamp("arrival_date").alias("arrived_at"))


@query("parse_compact_dates", "B16", f"""
    select log_sequence_id, try_strptime(effective_date, '%Y%m%d') as effective_at
    from ({raw_sql('stategov.budget_activity_log')})""")
def _(t: Tables) -> DataFrame:
    return t.raw("stategov.budget_activity_log").select(
        "log_sequence_id", fn.parse_compact_date("effective_date").alias("effective_at"))


@query("json_guarded", "B17", """
    select event_id, cast(json_extract_string(if(json_valid(doc), doc, '{}'), '$.k') as integer) as k
    from (select event_id, case when event_id % 20 = 0 then substr(props, 1, 5)
                                when event_id % 20 = 1 then props || ' x' when event_id % 20 = 2 then props || ',{}'
                                when event_id % 20 = 3 then props || '}' when event_id % 20 = 4 then props || '] x'
                                when event_id % 20 = 5 then props || ']}' when event_id % 20 = 6 then props || ',"x":2' else props end as doc
          from events)""")
def _(t: Tables) -> DataFrame:
    r = F.col("event_id") % 20
    doc = (F.when(r == 0, F.substring("props", 1, 5)).when(r == 1, F.concat("props", F.lit(" x")))
           .when(r == 2, F.concat("props", F.lit(",{}"))).when(r == 3, F.concat("props", F.lit("}")))
           .when(r == 4, F.concat("props", F.lit("] x"))).when(r == 5, F.concat("props", F.lit("]}")))
           .when(r == 6, F.concat("props", F.lit(',"x":2'))).otherwise(F.col("props")))
    return t.events.select("event_id", fn.json_text_guarded(doc, "$.k").cast("int").alias("k"))


@query("json_plain", "B18", """
    select event_id, json_extract_string(props, '$.k') as k, json_extract_string(props, '$.missing') as missing from events""")
def _(t: Tables) -> DataFrame:
    return t.events.select("event_id", fn.json_text("props", "$.k").alias("k"),
                           fn.json_text("props", "$.missing").alias("missing"))


@query("marker_count", "B19", """
    select doc_id, cast((length(text) - length(replace(text, 'th', ''))) / 2 as integer) as n from documents""")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", fn.marker_count("text", "th").alias("n"))


@query("sentinel_to_null", "B20", "select o_orderkey, nullif(o_orderpriority, '5-LOW') as priority from orders")
def _(t: Tables) -> DataFrame:
    return t.orders.select(OK, fn.null_if("o_orderpriority", "5-LOW").alias("priority"))


@query("tolerant_int", "B21", f"""
    select raw_id, try_cast(ecoli_count as integer) as ecoli_count from ({raw_sql('biosurvey.field_observations_raw')})""")
def _(t: Tables) -> DataFrame:
    return t.raw("biosurvey.field_observations_raw").select("raw_id", fn.try_int("ecoli_count").alias("ecoli_count"))


@query("staleness_days", "B22", f"""
    select o_orderkey, cast(date_diff('day', cast(o_orderdate as date), date '{AS_OF}') as integer) as days from orders""")
def _(t: Tables) -> DataFrame:
    return t.orders.select(OK, fn.staleness_days("o_orderdate", F.lit(AS_OF).cast("date")).alias("days"))


@query("is_set_flag", "B23", "select o_orderkey, nullif(o_custkey % 7, 0) is not null as has_key from orders")
def _(t: Tables) -> DataFrame:
    return t.orders.select(OK, fn.is_set(F.nullif(F.col("o_custkey") % 7, F.lit(0))).alias("has_key"))


@query("month_date", "B24", """
    select o_orderkey, make_date(year(o_orderdate), month(o_orderdate), 1) as month_start from orders""")
def _(t: Tables) -> DataFrame:
    return t.orders.select(OK, fn.month_date(F.year("o_orderdate"), F.month("o_orderdate")).alias("month_start"))


@query("guarded_key", "B25", f"""
    select o_orderkey, case when o_custkey % 7 <> 0 then {key('o_custkey')} end as customer_sk from orders""")
def _(t: Tables) -> DataFrame:
    return t.orders.select(OK, fn.guarded_key(
        F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey"))).alias("customer_sk"))


@query("numeric_bands", "B26", """
    select p_partkey, case when size is null then 'Unknown' when size <= 4 then 'Small' when size <= 8 then 'Medium' else 'Large' end as by_size,
        case when p_retailprice < 1000 then 'Low' when p_retailprice <= 1500 then 'Mid' else 'High' end as by_price
    from (select *, nullif(p_size, 7) as size from part)""")
def _(t: Tables) -> DataFrame:
    size = F.nullif("p_size", F.lit(7))
    return t.part.select(
        "p_partkey", fn.band(size, (4, 8), ("Small", "Medium", "Large"), first_closed=True).alias("by_size"),
        fn.band("p_retailprice", (1000, 1500), ("Low", "Mid", "High")).alias("by_price"))


@query("label_maps", "B27", """
    select o_orderkey, case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'Front' when o_orderpriority = '5-LOW' then 'Back'
        else 'Other' end as lane from orders""")
def _(t: Tables) -> DataFrame:
    return t.orders.select(OK, fn.label_map(
        "o_orderpriority", {"Front": ("1-URGENT", "2-HIGH"), "Back": ("5-LOW",)}, "Other").alias("lane"))


@query("tenure_tier", "B28", """
    select o_orderkey, coalesce(['New (< 1 year)', 'Established (1-3 years)', 'Loyal (> 3 years)'][1 + (years >= 1)::int + (years > 3)::int], 'Unknown') as tier
    from (select o_orderkey, 2000 - year(d) as years from (select o_orderkey, if(o_orderkey % 9 = 0, null, o_orderdate) as d from orders))""")
def _(t: Tables) -> DataFrame:
    d = F.when(F.col(OK) % 9 != 0, F.col("o_orderdate"))
    return t.orders.select(OK, fn.tenure_tier(d, F.lit("2000-01-01").cast("date")).alias("tier"))


@query("join_text", "B29", """
    select p_partkey, concat_ws(' ', if(p_partkey % 3 = 0, null, p_name), if(p_partkey % 2 = 0, null, p_brand)) as label from part""")
def _(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", fn.join_text(
        " ", F.when(F.col("p_partkey") % 3 != 0, F.col("p_name")),
        F.when(F.col("p_partkey") % 2 != 0, F.col("p_brand"))).alias("label"))


@query("nights_of_stay", "B30", f"""
    select reservation_id, cast(date_diff('day', arrival_date, departure_date) as integer) as nights
    from ({raw_sql('vistareserve.reservations')})""")
def _(t: Tables) -> DataFrame:
    return t.raw("vistareserve.reservations").select(
        "reservation_id", fn.nights("arrival_date", "departure_date").alias("nights"))


@query("fiscal_calendar", "B31", """
    select o_orderkey, cast(year(o_orderdate + interval 6 month) as integer) as fiscal_year,
        cast(month(o_orderdate + interval 6 month) as integer) as fiscal_month,
        cast(quarter(o_orderdate + interval 6 month) as integer) as fiscal_quarter from orders""")
def _(t: Tables) -> DataFrame:
    d = "o_orderdate"
    return t.orders.select(OK, fn.fiscal_year(d).alias("fiscal_year"), fn.fiscal_month(d).alias("fiscal_month"),
                           fn.fiscal_quarter(d).alias("fiscal_quarter"))


@query("date_parts_and_names", "B32", """
    select o_orderkey, extract(year from o_orderdate) as calendar_year, extract(month from o_orderdate) as calendar_month,
        extract(day from o_orderdate) as day_of_month, extract(quarter from o_orderdate) as calendar_quarter,
        dayname(o_orderdate) as day_name, monthname(o_orderdate) as month_name from orders""")
def _(t: Tables) -> DataFrame:
    return t.orders.select(OK, *[c.alias(n) for n, c in fn.date_parts("o_orderdate").items()])


@query("month_truncation", "B33", """
    select event_id, date_trunc('month', ts) as month_start, cast(date_trunc('month', ts) as date) as month_date from events""")
def _(t: Tables) -> DataFrame:
    return t.events.select("event_id", fn.month_of("ts").alias("month_start"),
                           fn.month_of("ts").cast("date").alias("month_date"))


@query("first_set_and_zero", "B34", f"""
    select wo_id, coalesce(reported_date, completed_date) as event_date, coalesce(park_id, 0) as park_id
    from ({raw_sql('infratrak.work_orders')})""")
def _(t: Tables) -> DataFrame:
    return t.raw("infratrak.work_orders").select(
        "wo_id", fn.first_set("reported_date", "completed_date").alias("event_date"), fn.zero("park_id").alias("park_id"))


@query("typed_null_padding", "B35", """
    select s_suppkey, cast(null as decimal(10,2)) as acres, cast(null as date) as updated_on, cast(null as varchar) as wkt from supplier""")
def _(t: Tables) -> DataFrame:
    return t.supplier.select("s_suppkey", fn.typed_null("decimal(10,2)").alias("acres"),
                             fn.typed_null("date").alias("updated_on"), fn.typed_null("string").alias("wkt"))


@query("constant_measure", "B36", "select l_orderkey, l_linenumber, cast(1 as integer) as quantity from lineitem")
def _(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", fn.constant(1, "int").alias("quantity"))


@query("report_rounding", "B37", """
    select o_orderpriority, cast(sum(amount) as decimal(20,2)) as revenue,
        cast(cast((2 * sum(cast(amount * 100 as hugeint)) + count(amount)) // (2 * count(amount)) as decimal(36,0)) * 0.01 as decimal(14,2)) as avg_value
    from (select o_orderpriority, cast(o_totalprice as decimal(12,2)) as amount from orders) group by o_orderpriority""")
def _(t: Tables) -> DataFrame:
    amount = F.col("o_totalprice").cast("decimal(12,2)")
    return t.orders.groupBy("o_orderpriority").agg(
        F.coalesce(F.sum(amount), F.lit(0)).cast("decimal(20,2)").alias("revenue"),
        fn.report_decimal(F.avg(amount), 14, 2).alias("avg_value"))


@query("percentage", "B38", """
    select l_returnflag, round(100.0 * sum(if(l_discount > 0.05, 1, 0)) / nullif(count(*), 0), 1) as pct_discounted
    from lineitem group by l_returnflag""")
def _(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(
        fn.pct(F.sum(F.when(F.col("l_discount") > 0.05, 1).otherwise(0)), F.count("*")).alias("pct_discounted"))
