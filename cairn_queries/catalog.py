"""Catalog coverage, search, scores and lineage audits.

Brands play the entities and part names the columns of the column catalog; documents
are the described entries of the text catalog; business concepts are a list of phrases.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.operators import catalog as c
from cairn.operators import lineage
from cairn_queries.fixtures import Tables
from cairn_queries.registry import query

# one brand is listed under another name, so that its parts find no entry
CATALOG_SQL = "(select if(p_brand = 'Brand#3', 'Renamed', p_brand) as entity, p_name as column_name from part)"


def column_catalog(t: Tables) -> DataFrame:
    name = F.when(F.col("p_brand") == "Brand#3", "Renamed").otherwise(F.col("p_brand"))
    return c.catalog_columns(t.part.withColumn("entity_name", name), "entity_name", "p_name")


@query("entity_coverage_report", "M1,C8,E7,B38", f"""
    with x as (select distinct 'int_' || p_type as model, p_brand as entity, if(p_size % 5 = 0, '', p_name) as mapped from part),
    m as (select model, entity, count(distinct mapped) as mapped_columns from x where mapped <> '' group by all),
    n as (select entity, count(*) as total_columns from {CATALOG_SQL} group by 1)
    select model, entity, mapped_columns, total_columns, round(100.0 * mapped_columns / nullif(total_columns, 0), 1) as coverage_pct,
        case when total_columns is null then 'No catalog entry' when round(100.0 * mapped_columns / nullif(total_columns, 0), 1) >= 50 then 'Above threshold'
             else 'Below threshold — review for CDM exception' end as coverage_status
    from m left join n using (entity)""")
def _(t: Tables) -> DataFrame:
    crosswalk = t.part.select(
        F.concat(F.lit("int_"), "p_type").alias("model"), F.col("p_brand").alias("entity"),
        F.when(F.col("p_size") % 5 == 0, "").otherwise(F.col("p_name")).alias("mapped_column"))
    return c.entity_coverage(crosswalk, column_catalog(t))


@query("entity_candidates", "M2,G1,E8,C9", f"""
    with w as (select distinct lower(case when p_size % 7 = 0 then p_name || '_id' when p_size % 7 = 1 then '_' || p_name else p_name end) as column_name
        from part),
    b as (select column_name from w where not (right(column_name, 3) in ('_sk', '_id') or left(column_name, 1) = '_')),
    g as (select entity, count(*) as total_columns, cast(sum(if(column_name in (select column_name from b), 1, 0)) as bigint) as matched_columns
        from {CATALOG_SQL} group by entity having matched_columns > 0)
    select *, round(100.0 * matched_columns / nullif(total_columns, 0), 1) as coverage_pct,
        round(100.0 * matched_columns / nullif(total_columns, 0), 1) < 50 as below_threshold
    from g order by matched_columns desc, coverage_pct desc, entity limit 10""")
def _(t: Tables) -> DataFrame:
    size = F.col("p_size") % 7
    name = (F.when(size == 0, F.concat("p_name", F.lit("_id"))).when(size == 1, F.concat(F.lit("_"), "p_name"))
            .otherwise(F.col("p_name")))
    return c.entity_candidates(t.part.select(name.alias("column_name")), column_catalog(t))


DOCS_SQL = "(select source as entity, doc_id, lang, lower(coalesce(source, '') || ' | ' || coalesce(lang, '') || ' | ' || coalesce(text, '')) as t from documents)"
FIELDS = ["source", "lang", "text"]


def documents(t: Tables) -> DataFrame:
    return t.documents.withColumn("entity", F.col("source"))


@query("catalog_search_any", "M3", f"select entity, count(*) as matches from {DOCS_SQL} where contains(t, 'ther') or contains(t, 'src1') group by entity")
def _(t: Tables) -> DataFrame:
    return c.entity_ranking(c.search_exact(documents(t), ["Ther", "SRC1"], FIELDS))


@query("catalog_search_all", "M3", f"select doc_id, entity, lang from {DOCS_SQL} where contains(t, 'ther') and contains(t, 'tion') and lower(entity) = 'src7'")
def _(t: Tables) -> DataFrame:
    found = c.search_exact(documents(t), ["ther", "tion"], FIELDS, all_words=True, entity="SRC7")
    return found.select("doc_id", "entity", "lang")


# The ratio takes the longest common block (earliest in the word, then in the keyword) and goes on left and right of it.
NEAR_SQL = """
words as (select distinct unnest(regexp_extract_all(t, '[a-z0-9]+')) as w from docs),
segments as (
    select w, k, 0 as alo, length(w) as ahi, 0 as blo, length(k) as bhi, 0::bigint as hit
    from words, (values ('thereing'), ('erentions')) keywords(k)
    where length(w) > 3 and 2.0 * least(length(w), length(k)) / (length(w) + length(k)) >= 0.8
    union all
    select w, k, if(side = 0, alo, m.i + m.l), if(side = 0, m.i, ahi), if(side = 0, blo, m.j + m.l), if(side = 0, m.j, bhi), if(side = 0, m.l, 0)
    from (select w, k, alo, ahi, blo, bhi, arg_min({'i': i, 'j': j, 'l': l}, row(-l, i, j)) as m, unnest([0, 1]) as side
          from (select *, unnest(range(1, least(ahi - i, bhi - j) + 1)) as l
                from (select *, unnest(range(blo, bhi)) as j from (select *, unnest(range(alo, ahi)) as i from segments)))
          where substr(w, i + 1, l) = substr(k, j + 1, l) group by w, k, alo, ahi, blo, bhi)),
near as (select w from segments group by w, k having 2.0 * sum(hit) / (length(w) + length(k)) >= 0.8)"""


@query("catalog_search_fuzzy", "M4", f"""
    with recursive docs as (select * from {DOCS_SQL}), {NEAR_SQL}
    select doc_id, entity, lang from docs
    where contains(t, 'thereing') or contains(t, 'erentions') or contains(t, 'and')
        or list_has_any(regexp_extract_all(t, '[a-z0-9]+'), (select coalesce(list(distinct w), []) from near))""")
def _(t: Tables) -> DataFrame:
    return c.search_fuzzy(documents(t), ["thereing", "erentions", "and"], FIELDS).select("doc_id", "entity", "lang")


TOKENS_SQL = """list_distinct(list_concat(list_concat(list_concat(regexp_extract_all(lower({0}), '[a-z]+'),
    [x[:-2] for x in regexp_extract_all(lower({0}), '[a-z]+') if right(x, 1) = 's' and length(x) > 3]),
    [x[:-4] for x in regexp_extract_all(lower({0}), '[a-z]+') if right(x, 3) = 'ing' and length(x) > 5]),
    [x[:-5] for x in regexp_extract_all(lower({0}), '[a-z]+') if right(x, 4) = 'tion' and length(x) > 6]))"""
CONCEPTS = ["Red widgets", "hot gear", "small bolts testing", "metal"]
TOPICS = ["The nation and threes", "Thering of leaux", "blerering"]
# every fourth synonym is spelled in another form
SYNONYMS_SQL = "(select if(p_partkey % 4 = 0, p_name || 's testing', p_name) as synonym, p_brand as entity, p_type as note, p_partkey as position from part)"


def concept_sql(concepts: list[str]) -> str:
    values = ", ".join(f"('{c}')" for c in concepts)
    return f"(select concept, {TOKENS_SQL.format('concept')} as cts from (values {values}) v(concept))"


SYNONYM_SQL = f"""
    select concept, entity, arg_min(score, position) as synonym_score, arg_min(note, position) as note
    from (select concept, entity, position, note, trim(lower(concept)) = trim(lower(synonym)) as same, len(list_intersect(cts, sts)) as k,
              if(same, 1.0::double, round(k / greatest(len(cts), len(sts)) * 0.9::double, 3)) as score
          from {concept_sql(CONCEPTS)}, (select *, {TOKENS_SQL.format('synonym')} as sts from {SYNONYMS_SQL}))
    where same or k > 0 group by concept, entity"""


def synonyms(t: Tables) -> DataFrame:
    phrase = F.when(F.col("p_partkey") % 4 == 0, F.concat("p_name", F.lit("s testing"))).otherwise(F.col("p_name"))
    return t.part.select(phrase.alias("synonym"), F.col("p_brand").alias("entity"), F.col("p_type").alias("note"),
                         F.col("p_partkey").alias("position"))


@query("synonym_match", "M5", SYNONYM_SQL)
def _(t: Tables) -> DataFrame:
    return c.synonym_match(CONCEPTS, synonyms(t))


def description_sql(concepts: list[str], entity_source: str) -> str:
    return f"""
    select concept, entity, round(k / greatest(len(cts), 1) * 0.8::double, 3) as description_score
    from (select concept, entity, cts, len(list_intersect(cts, dts)) as k
          from {concept_sql(concepts)}, (select entity, {TOKENS_SQL.format('description')} as dts from {entity_source}))
    where k > 0"""


@query("description_match", "M6", description_sql(TOPICS, "(select doc_id as entity, text as description from documents)"))
def _(t: Tables) -> DataFrame:
    return c.description_match(TOPICS, t.documents.select(F.col("doc_id").alias("entity"), F.col("text").alias("description")))


# One description per brand: its first and last part name.
BRANDS_SQL = "(select p_brand as entity, min(p_name) || ' and ' || max(p_name) as description from part group by p_brand)"


@query("combined_score", "M7", f"""
    with syn as ({SYNONYM_SQL}), des as ({description_sql(CONCEPTS, BRANDS_SQL)})
    select concept, entity, coalesce(synonym_score, 0) as synonym_score, coalesce(description_score, 0) as description_score,
        if(synonym_score is null, 0, 0.5)::double as column_bonus,
        round(0.6::double * coalesce(synonym_score, 0) + 0.3::double * coalesce(description_score, 0) + 0.1::double * if(synonym_score is null, 0, 0.5), 3) as final_score
    from syn full join des using (concept, entity)""")
def _(t: Tables) -> DataFrame:
    brands = t.part.groupBy(F.col("p_brand").alias("entity")).agg(
        F.concat(F.min("p_name"), F.lit(" and "), F.max("p_name")).alias("description"))
    return c.combined_score(c.synonym_match(CONCEPTS, synonyms(t)), c.description_match(CONCEPTS, brands), 0.5)


# --- lineage: parts are models, line items the edges between them

NODES_SQL = """(select p_partkey as k, case p_partkey % 4 when 0 then 'fct_' when 1 then 'dim_' when 2 then 'stg_' else 'int_' end || p_partkey as name,
    if(p_partkey % 11 = 0, 'seed', 'model') as resource_type, 'model.p.' || case p_partkey % 4 when 0 then 'fct_' when 1 then 'dim_'
    when 2 then 'stg_' else 'int_' end || p_partkey as unique_id from part)"""
EDGES_SQL = f"""(select n.unique_id as child, case l_suppkey % 5 when 0 then 'model.p.int_' when 1 then 'model.p.stg_' when 2 then 'model.p.base_'
    when 3 then 'source.p.s.' else 'model.p.other_' end || l_suppkey as parent, if(l_quantity > 42, 1, 2) as distance
    from lineitem join {NODES_SQL} n on n.k = l_partkey)"""


def _kind(k):
    return F.when(k % 4 == 0, "fct_").when(k % 4 == 1, "dim_").when(k % 4 == 2, "stg_").otherwise("int_")


def nodes(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    name = F.concat(_kind(k), k.cast("string"))
    return t.part.select(name.alias("name"), F.when(k % 11 == 0, "seed").otherwise("model").alias("resource_type"),
                         F.concat(F.lit("model.p."), name).alias("unique_id"))


def edges(t: Tables) -> DataFrame:
    k, s = F.col("l_partkey"), F.col("l_suppkey")
    r = s % 5
    parent = (F.when(r == 0, "model.p.int_").when(r == 1, "model.p.stg_").when(r == 2, "model.p.base_")
              .when(r == 3, "source.p.s.").otherwise("model.p.other_"))
    return t.lineitem.select(
        F.concat(F.lit("model.p."), _kind(k), k.cast("string")).alias("child"),
        F.concat(parent, s.cast("string")).alias("parent"), F.when(F.col("l_quantity") > 42, 1).otherwise(2).alias("distance"))


@query("lineage_facts_without_integration", "N1,D11", f"""
    select unique_id, name as resource_name from {NODES_SQL} m where resource_type = 'model' and (name like 'fct\\_%' escape '\\' or name like 'dim\\_%' escape '\\')
        and not exists (select 1 from {EDGES_SQL} e where e.distance = 1 and e.child = m.unique_id and e.parent like 'model.%.int\\_%' escape '\\')""")
def _(t: Tables) -> DataFrame:
    return lineage.facts_without_integration(nodes(t), edges(t))


@query("lineage_marts_on_staging", "N2,C7", f"""
    select m.unique_id, m.name as resource_name from {NODES_SQL} m join {EDGES_SQL} e on e.child = m.unique_id
    where resource_type = 'model' and name[:4] in ('fct_', 'dim_') and distance = 1 and contains(parent, 'model.') and contains(parent, '.stg_')""")
def _(t: Tables) -> DataFrame:
    return lineage.marts_on_staging(nodes(t), edges(t))


@query("lineage_staging_off_source", "N3,C7,E10", f"""
    select distinct m.unique_id, m.name as resource_name from {NODES_SQL} m join {EDGES_SQL} e on e.child = m.unique_id
    where resource_type = 'model' and name[:4] = 'stg_' and distance = 1
        and not contains(parent, 'source.') and not (contains(parent, 'model.') and contains(parent, '.base_'))""")
def _(t: Tables) -> DataFrame:
    return lineage.staging_off_source(nodes(t), edges(t))
