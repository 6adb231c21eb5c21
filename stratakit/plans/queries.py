"""Registered queries over the test tables, each with its SQL.

The star schema stands in for the literacy tables: line items are students
(ship year, supplier's nation as municipality, line status as network, return
flag as literacy, quantity as weight, price as score), orders give targets,
nations are municipalities and regions their states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratakit.operators import dedup, enrich, indicator, quality, reports, standardize, upsert
from stratakit.operators.quality import FOREIGN_KEY, NOT_NULL, PATTERN, RANGE, SUM, UNIQUE, Rule
from stratakit.plans import jobs
from stratakit.plans.config import DOCUMENTED_RULES
from stratakit.sources import readers, schemas, sinks
from stratakit.sources.scratch import scratch_dir
from stratakit.streaming import events as ev
from stratakit.streaming import jobs as stream_jobs

AT, BATCH = "2024-01-01T00:00:00+00:00", "batch-1"
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query and its SQL under the function's name."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded, since sums differ in their last bits by order."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# ---- the stand-in tables --------------------------------------------------


def students(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, suppliers = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    flag = F.when(F.col("l_returnflag") == "R", "Sim").when(F.col("l_returnflag") == "A", "Não")
    return items.join(suppliers.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"), "left").select(
        F.year("l_shipdate").alias("ano"), F.lpad(F.col("s_nationkey").cast("string"), 7, "0").alias("id_municipio"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("id_aluno"),
        F.lower("l_linestatus").alias("rede"), flag.alias("alfabetizado"), F.when(F.col("l_linenumber") != 7, F.col("l_quantity")).alias("peso_aluno"),
        F.when(F.col("l_linenumber") != 6, F.col("l_extendedprice")).alias("proficiencia"),
    )


STUDENTS = """students as (select year(l_shipdate)::int ano, lpad(s_nationkey::varchar, 7, '0') id_municipio, lower(l_linestatus) rede,
  case when l_returnflag = 'R' then 1.0 else 0.0 end f, case when l_linenumber <> 7 then l_quantity else 1.0 end w,
  case when l_linenumber <> 6 then l_extendedprice end p
  from lineitem left join supplier on l_suppkey = s_suppkey)"""


def _target_values() -> list:
    return [
        F.round(F.avg("o_totalprice") / 5000, 4).alias("taxa_alfabetizacao"),
        F.round(F.avg("o_totalprice") / 4000, 4).alias("meta_alfabetizacao_2024"),
        F.round(F.max("o_totalprice") / 3700, 4).alias("meta_alfabetizacao_2030"),
        F.round(F.min("o_totalprice") / 37, 4).alias("percentual_participacao"),
    ]


_TARGET_SQL = "round(avg(o_totalprice) / 5000, 4) t, round(avg(o_totalprice) / 4000, 4) m24, round(max(o_totalprice) / 3700, 4) m30, round(min(o_totalprice) / 37, 4) part"


def local_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where(F.col("o_custkey") % 25 != 3)
    keys = [F.year("o_orderdate").alias("ano"), F.lpad((F.col("o_custkey") % 25).cast("string"), 7, "0").alias("id_municipio"), F.lower("o_orderstatus").alias("rede")]
    return orders.groupBy(*keys).agg(*_target_values()).withColumn("nome_municipio", F.concat(F.lit("M"), "id_municipio"))


LOCAL_TARGETS = f"""targets as (select year(o_orderdate)::int ano, lpad((o_custkey % 25)::varchar, 7, '0') id_municipio, lower(o_orderstatus) rede, {_TARGET_SQL}
  from orders where o_custkey % 25 <> 3 group by all)"""


def towns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").where("n_nationkey <> 4").select(F.lpad(F.col("n_nationkey").cast("string"), 7, "0").alias("id_municipio"), F.col("n_name").alias("nome"), F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("sigla_uf"))


TOWNS = "towns as (select lpad(n_nationkey::varchar, 7, '0') id_municipio, n_name nome, 'R' || n_regionkey sigla_uf from nation where n_nationkey <> 4)"


def state_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = [F.year("o_orderdate").alias("ano"), F.concat(F.lit("R"), (F.col("o_custkey") % 5).cast("string")).alias("sigla_uf"), F.lower("o_orderstatus").alias("rede")]
    return table(spark, sf_dir, "orders").groupBy(*keys).agg(*_target_values())


STATE_TARGETS = f"""targets as (select year(o_orderdate)::int ano, 'R' || (o_custkey % 5) sigla_uf, lower(o_orderstatus) rede, {_TARGET_SQL} from orders group by all)"""

_AGG = """count(*) total_alunos, sum(w) total_peso, sum(f * w) total_alfabetizados_ponderado,
  coalesce(sum(p * w), 0) / nullif(sum(w), 0) proficiencia_media_ponderada, sum(f * w) / nullif(sum(w), 0) * 100 taxa_crianca_alfabetizada"""
_ROUND = """total_alunos, round(total_peso, 4) total_peso, round(total_alfabetizados_ponderado, 4) total_alfabetizados_ponderado,
  round(proficiencia_media_ponderada, 4) proficiencia_media_ponderada, round(taxa_crianca_alfabetizada, 4) taxa_crianca_alfabetizada"""
_GAPS = """t taxa_alfabetizacao, m24 meta_alfabetizacao_2024, m30 meta_alfabetizacao_2030,
  round(taxa_crianca_alfabetizada - t, 4) gap_taxa_vs_inep, round(taxa_crianca_alfabetizada - m24, 4) gap_meta_2024, round(taxa_crianca_alfabetizada - m30, 4) gap_meta_2030"""
LOCAL = f"""{STUDENTS}, {LOCAL_TARGETS}, {TOWNS}, ind as (select ano, id_municipio, rede, {_AGG} from students group by all),
  local as (select i.*, t, m24, m30, part, case when t.ano is not null then 'M' || i.id_municipio end nome_municipio from ind i left join targets t
    on i.ano is not distinct from t.ano and i.id_municipio is not distinct from t.id_municipio and i.rede is not distinct from t.rede)"""


# ---- sources, projection, standard forms ----------------------------------


@query("select o_orderkey, o_custkey, o_totalprice, year(o_orderdate)::int ano from orders where year(o_orderdate) in (1996, 1997) and o_totalprice > 1000")
def scan_year_filter(spark, sf_dir):
    """Years of a date, one more condition, and columns, all taken by the scan."""
    rows = readers.scan(table(spark, sf_dir, "orders"), None, [1996, 1997], extra="o_totalprice > 1000", date_column="o_orderdate")
    return rows.select("o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("ano"))


@query("select o_orderkey, o_totalprice, year(o_orderdate)::int ano from orders where year(o_orderdate) in (1996, 1997)")
def scan_partition_pruning(spark, sf_dir):
    """A table partitioned by year, of which two partitions are read."""
    path = f"{scratch_dir(spark)}/orders"
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("ano"))
    sinks.write_table(rows, path, "ano")
    return readers.read_bronze(spark, path, [1996, 1997], schema=rows.schema)


@query("select least(10, count(*))::bigint n_rows from orders")
def scan_limit(spark, sf_dir):
    """A limit above zero cuts; zero and below do not."""
    rows = table(spark, sf_dir, "orders")
    return readers.scan(readers.scan(readers.scan(rows, limit=0), limit=-1), limit=10).agg(F.count(F.lit(1)).alias("n_rows"))


@query("select o_orderkey, o_totalprice, year(o_orderdate)::int ano from orders where year(o_orderdate) in (1996, 1997)")
def scan_missing_source(spark, sf_dir):
    """Years of two sources of one table, one of which isn't there."""
    schema = table(spark, sf_dir, "orders").schema
    sources = [readers.read_source(spark, f"{sf_dir}/{name}.parquet", schema, [1996, 1997], date_column="o_orderdate") for name in ("absent", "orders")]
    return schemas.union_fragments(sources).select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("ano"))


@query("""select o_orderkey::bigint o_orderkey, year(o_orderdate)::int ano, case when year(o_orderdate) > 1995 then o_orderpriority end o_orderpriority,
  case when year(o_orderdate) <= 1995 then o_orderstatus end o_orderstatus, case when year(o_orderdate) > 1995 then 3000000000 else 0 end + o_custkey code from orders""")
def bronze_fragments(spark, sf_dir):
    """Partitions of one Bronze table whose columns differ: later years have one
    column more and one less, and their code, an int before, is a long."""
    path, orders = f"{scratch_dir(spark)}/orders", table(spark, sf_dir, "orders").withColumn("ano", F.year("o_orderdate"))
    old = orders.where("ano <= 1995").select(F.col("o_orderkey").cast("int").alias("o_orderkey"), "ano", "o_orderstatus", F.col("o_custkey").cast("int").alias("code"))
    new = orders.where("ano > 1995").select("o_orderkey", "ano", "o_orderpriority", (F.lit(3000000000) + F.col("o_custkey")).alias("code"))
    for rows in (old, new):
        sinks.write_table(rows, path, "ano")
    return readers.read_bronze(spark, path).select("o_orderkey", "ano", "o_orderpriority", "o_orderstatus", "code")


@query("""with o as (select o_orderkey, o_totalprice, year(o_orderdate)::int ano from orders)
select 'a' fragment, o_orderkey, o_totalprice, null::int ano from o where o_orderkey % 2 = 0 union all select 'b', o_orderkey, o_totalprice::int::double, ano from o where o_orderkey % 2 = 1""")
def fragments_union(spark, sf_dir):
    """Fragments with other columns and types under one schema."""
    orders = table(spark, sf_dir, "orders")
    a = orders.where("o_orderkey % 2 = 0").select(F.lit("a").alias("fragment"), "o_orderkey", "o_totalprice")
    b = orders.where("o_orderkey % 2 = 1").select(F.year("o_orderdate").alias("ano"), F.bround("o_totalprice").cast("int").alias("o_totalprice"), F.col("o_orderkey").cast("int").alias("o_orderkey"), F.lit("b").alias("fragment"))
    return schemas.union_fragments([a, b])


@query(f"select n_nationkey, n_name, n_regionkey, '{AT}' _ingestion_timestamp, 'nation' _source_table, '{BATCH}' _batch_id from nation")
def bronze_metadata(spark, sf_dir):
    return sinks.bronze_rows(table(spark, sf_dir, "nation"), "nation", BATCH, AT, ("n_nationkey", "n_name"))


def dirty_codes(spark, sf_dir):
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(k % 7 == 0, "abc").when(k % 5 == 0, "1996.0").otherwise((1990 + k % 9).cast("string")).alias("ano"),
        F.when(k % 11 == 0, "x").when(k % 3 == 0, F.concat(k.cast("string"), F.lit(".0"))).otherwise(F.concat(F.lit(" "), k.cast("string"))).alias("id_municipio"),
        F.when(k % 6 == 0, " sp ").when(k % 6 == 1, "Rj").when(k % 6 == 2, "NaN").when(k % 6 == 3, " None\t").otherwise(F.substring("c_mktsegment", 1, 2)).alias("sigla_uf"),
        F.concat(F.lit("\t"), "c_mktsegment", F.lit(" ")).alias("rede"),
    )


@query("""select c_custkey, (case when c_custkey % 7 = 0 then null when c_custkey % 5 = 0 then 1996 else 1990 + c_custkey % 9 end)::int ano,
  case when c_custkey % 11 = 0 then null else lpad(c_custkey::varchar, greatest(7, length(c_custkey::varchar))::int, '0') end id_municipio,
  case c_custkey % 6 when 0 then 'SP' when 1 then 'RJ' when 2 then null when 3 then null else upper(substr(c_mktsegment, 1, 2)) end sigla_uf,
  lower(c_mktsegment) rede from customer""")
def standardize_codes(spark, sf_dir):
    return standardize.standardize_common(dirty_codes(spark, sf_dir))


@query("select l_orderkey, l_linenumber, l_quantity, l_shipdate from lineitem")
def prune_columns(spark, sf_dir):
    keep = enrich.Keep(("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate", "absent"), ("l_line",), ("l_linestatus",))
    return enrich.prune(table(spark, sf_dir, "lineitem"), keep)


@query("""select ano, id_municipio, rede, total_alunos::double total_alunos, total_peso, '2024' _gold_batch_id from (
  select year(o_orderdate)::int ano, (o_custkey % 25)::varchar id_municipio, lower(o_orderstatus) rede, count(*) total_alunos, null::double total_peso from orders group by all)""")
def gold_coercion(spark, sf_dir):
    """Year, texts, and numbers; what isn't a number is null."""
    rows = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").cast("string").alias("ano"), (F.col("o_custkey") % 25).alias("id_municipio"), F.lower("o_orderstatus").alias("rede")).agg(F.count(F.lit(1)).cast("string").alias("total_alunos"))
    return indicator.coerce(rows.withColumns({"total_peso": F.lit("n/a"), "_gold_batch_id": F.lit(2024)}))


# ---- deduplication --------------------------------------------------------


@query("select * from events qualify row_number() over (partition by user_id, event_type order by ts desc nulls last, event_id desc) = 1")
def dedup_latest(spark, sf_dir):
    return dedup.latest(table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", [F.desc("event_id")])


@query("""select * from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc, l_partkey desc, l_suppkey desc,
  l_quantity desc, l_extendedprice desc, l_discount desc, l_tax desc, l_returnflag desc, l_linestatus desc) = 1""")
def dedup_last_arrival(spark, sf_dir):
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    return dedup.last_arrival(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], order)


@query("select min(n_nationkey)::int n_nationkey, n_regionkey from nation group by n_regionkey")
def dedup_lookup(spark, sf_dir):
    return dedup.lookup(table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"), ["n_regionkey"])


@query("select (count(*) - count(distinct (l_orderkey, l_linenumber)))::bigint removed_rows from lineitem")
def dedup_removed_rows(spark, sf_dir):
    return dedup.removed_rows(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# ---- joins ----------------------------------------------------------------

_NATION = enrich.Lookup({"c_nationkey": "n_nationkey"}, {"n_name": "nation_name", "absent": "never"})


def _customers_with_nation(spark, sf_dir):
    return enrich.enrich(table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation").where(~F.col("n_nationkey").isin(3, 7)), _NATION)


@query("""select c.*, n_name nation_name, n_name is not null _join_match from customer c left join (select * from nation where n_nationkey not in (3, 7)) on c_nationkey = n_nationkey""")
def enrich_lookup(spark, sf_dir):
    return _customers_with_nation(spark, sf_dir)


@query("select count(*) unmatched_rows from customer where c_nationkey in (3, 7)")
def enrich_unmatched(spark, sf_dir):
    return enrich.unmatched(_customers_with_nation(spark, sf_dir))


@query("""with c as (select c_custkey, case when c_custkey % 4 = 0 then null else c_nationkey end k from customer),
  n as (select case when n_nationkey = 5 then null else n_nationkey end k, n_name from nation)
  select c_custkey, c.k, n_name, n.n_name is not null _join_match from c left join n on c.k is not distinct from n.k""")
def enrich_null_safe(spark, sf_dir):
    left = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 4 != 0, F.col("c_nationkey")).alias("k"))
    right = table(spark, sf_dir, "nation").select(F.when(F.col("n_nationkey") != 5, F.col("n_nationkey")).alias("nk"), "n_name")
    return enrich.enrich(left, right, enrich.Lookup({"k": "nk"}, {"n_name": "n_name"}))


@query(f"""with {STATE_TARGETS} select ano, sigla_uf, rede, t taxa_alfabetizacao, r_name nome_uf, case when r_name is not null then 'x' end regiao_uf, r_regionkey::varchar id_uf, r_name is not null _join_match
  from targets left join (select * from region where r_regionkey <> 2) on sigla_uf = 'R' || r_regionkey""")
def enrich_states(spark, sf_dir):
    """State targets with their state's columns; one state isn't known."""
    regions = table(spark, sf_dir, "region").where("r_regionkey <> 2")
    states = regions.select(F.col("r_regionkey").cast("string").alias("id_uf"), F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("sigla"), F.col("r_name").alias("nome"), F.lit("x").alias("regiao"))
    return enrich.enrich_state_targets(state_targets(spark, sf_dir).select("ano", "sigla_uf", "rede", "taxa_alfabetizacao"), states)


# ---- indicators -----------------------------------------------------------

_KEYS = ["ano", "id_municipio", "rede"]


@query(f"with {STUDENTS}, ind as (select ano, id_municipio, rede, {_AGG} from students group by all) select ano, id_municipio, rede, {_ROUND} from ind")
def indicator_weighted(spark, sf_dir):
    return rounded(indicator.aggregate(indicator.prepare(students(spark, sf_dir)), _KEYS))


@query(f"""with {STUDENTS} select ano, rede, round(sum(p * w) / sum(case when p is not null then w end), 4) proficiencia_media_ponderada from students group by all""")
def indicator_mean_over_scored(spark, sf_dir):
    out = indicator.aggregate(indicator.prepare(students(spark, sf_dir)), ["ano", "rede"], mean_over="scored")
    return rounded(out.select("ano", "rede", "proficiencia_media_ponderada"))


def local(spark, sf_dir):
    return indicator.local_indicator(students(spark, sf_dir), local_targets(spark, sf_dir), towns(spark, sf_dir))


@query(f"with {LOCAL} select ano, l.id_municipio, rede, {_ROUND}, {_GAPS}, nome_municipio, sigla_uf from local l left join towns using (id_municipio)")
def indicator_gap_local(spark, sf_dir):
    return rounded(local(spark, sf_dir))


@query(f"""with {STUDENTS}, {STATE_TARGETS}, {TOWNS}, ind as (select ano, sigla_uf, rede, {_AGG} from students join towns using (id_municipio) group by all)
  select i.ano, i.sigla_uf, i.rede, {_ROUND}, {_GAPS} from ind i left join targets t on i.ano = t.ano and i.sigla_uf = t.sigla_uf and i.rede = t.rede""")
def indicator_gap_region(spark, sf_dir):
    return rounded(indicator.state_indicator(students(spark, sf_dir), towns(spark, sf_dir), state_targets(spark, sf_dir)))


@query(f"with {STUDENTS} select count(distinct ano) n_years from students")
def indicator_years(spark, sf_dir):
    return indicator.distinct_years(students(spark, sf_dir))


@query(f"with {LOCAL} select count(*) \"rows\", count(*) filter (where t is null) without_target from local")
def coverage_report(spark, sf_dir):
    return quality.coverage(local(spark, sf_dir), "taxa_alfabetizacao")


# ---- quality --------------------------------------------------------------


def dirty_orders(spark, sf_dir):
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(k % 10 != 0, F.year("o_orderdate")).alias("ano"),
        F.when(k % 13 == 0, "invalid").when(k % 17 == 0, " ").when(k % 19 != 0, F.lpad((k % 30).cast("string"), 7, "0")).alias("id_municipio"),
        F.when(k % 23 == 0, F.lit(float("nan"))).when(k % 29 == 0, F.lit(None)).otherwise(F.col("o_totalprice") / 4000).alias("taxa"),
    )


DIRTY = """dirty as (select o_orderkey, case when o_orderkey % 10 <> 0 then year(o_orderdate)::int end ano,
  case when o_orderkey % 13 = 0 then 'invalid' when o_orderkey % 17 = 0 then ' ' when o_orderkey % 19 <> 0 then lpad((o_orderkey % 30)::varchar, 7, '0') end id_municipio,
  case when o_orderkey % 23 = 0 then 'nan'::double when o_orderkey % 29 = 0 then null else o_totalprice / 4000 end taxa from orders)"""
_RULES = (
    Rule("r_ano", NOT_NULL, "ano", description="year is missing"), Rule("r_codigo", PATTERN, "id_municipio", description="code isn't 7 digits"),
    Rule("r_fk", FOREIGN_KEY, "id_municipio", reference="municipio.id_municipio", description="unknown code"), Rule("r_faixa", RANGE, "taxa"),
    Rule("r_ausente", RANGE, "absent", description="never"), Rule("r_outro", "other", "ano"),
)
MASKS = f"""{DIRTY}, {TOWNS}, masks as (select *, ano is null r1, coalesce(trim(id_municipio) <> '' and not regexp_full_match(trim(id_municipio), '\\d{{7}}'), false) r2,
  id_municipio is not null and id_municipio not in (select id_municipio from towns) r3, coalesce(not isnan(taxa) and (taxa < 0 or taxa > 100), false) r4 from dirty)"""


def checked_orders(spark, sf_dir):
    return quality.check(dirty_orders(spark, sf_dir), _RULES, {"municipio": towns(spark, sf_dir)}, AT)


@query(f"with {MASKS} select o_orderkey, ano, id_municipio, taxa from masks where not (r1 or r2 or r3 or r4)")
def quality_valid(spark, sf_dir):
    return checked_orders(spark, sf_dir).valid


@query(f"""with {MASKS} select o_orderkey, ano, id_municipio, taxa,
  concat_ws(',', case when r1 then 'r_ano' end, case when r2 then 'r_codigo' end, case when r3 then 'r_fk' end, case when r4 then 'r_faixa' end) _quality_rule_ids,
  concat_ws(' | ', case when r1 then 'year is missing' end, case when r2 then 'code isn''t 7 digits' end, case when r3 then 'unknown code' end) _quality_messages,
  '{AT}' _quarantined_at, '{BATCH}' _silver_batch_id, 'silver' _quarantine_layer from masks where r1 or r2 or r3 or r4""")
def quality_quarantine(spark, sf_dir):
    return sinks.quarantine_rows(checked_orders(spark, sf_dir).quarantine, BATCH, "silver")


@query(f"""with {MASKS}, c as (select count(*) filter (where r1) a, count(*) filter (where r2) b, count(*) filter (where r3) c, count(*) filter (where r4) d from masks)
  select 'r_ano' rule_id, a failures from c union all select 'r_codigo', b from c union all select 'r_fk', c from c union all select 'r_faixa', d from c
  union all select 'r_ausente', 0 from c union all select 'r_outro', 0 from c""")
def quality_rule_counts(spark, sf_dir):
    return checked_orders(spark, sf_dir).counts


@query(f"""with {MASKS} select 'orders' entity, count(*) filter (where not (r1 or r2 or r3 or r4)) valid_rows, count(*) filter (where r1 or r2 or r3 or r4) quarantined_rows,
  round(count(*) filter (where not (r1 or r2 or r3 or r4)) / count(*), 6) pass_rate from masks""")
def quality_pass_rate(spark, sf_dir):
    return rounded(quality.metrics({"orders": checked_orders(spark, sf_dir)}), 6)


@query(f"""with {MASKS}, s as ({STATE_TARGETS.replace("targets as (", "select * from (")}), n as (
  select 'orders' entity, count(*) filter (where not (r1 or r2 or r3 or r4)) v, count(*) filter (where r1 or r2 or r3 or r4) q from masks
  union all select 'targets', count(*) filter (where not (t > 100 or m24 > 100 or m30 > 100 or part > 100)), count(*) filter (where t > 100 or m24 > 100 or m30 > 100 or part > 100) from s)
  select entity, v valid_rows, q quarantined_rows, round(v / (v + q), 6) pass_rate from n""")
def quality_metrics_union(spark, sf_dir):
    """Metrics of several checked tables in one."""
    targets = quality.check(state_targets(spark, sf_dir), DOCUMENTED_RULES["targets"])
    return rounded(quality.metrics({"orders": checked_orders(spark, sf_dir), "targets": targets}), 6)


@query("""select l_orderkey, l_linenumber, count(*)::bigint n from lineitem where (l_orderkey, l_linenumber) in
  (select (l_orderkey, l_linenumber) from lineitem group by l_orderkey, l_linenumber having count(*) > 1) group by all""")
def quality_unique(spark, sf_dir):
    checked = quality.check(table(spark, sf_dir, "lineitem"), [Rule("unique", UNIQUE, columns=("l_orderkey", "l_linenumber"))], quarantined_at=AT)
    return checked.quarantine.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))


@query("select p_partkey, p_size * 2.0::double a, case when p_partkey % 9 <> 0 then 100.0::double - p_size * 2.0::double + (p_partkey % 5) end b from part where p_partkey % 9 = 0 or p_partkey % 5 <= 1")
def quality_sum(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * 2.0).alias("a"), F.when(F.col("p_partkey") % 9 != 0, 100.0 - F.col("p_size") * 2.0 + F.col("p_partkey") % 5).alias("b"))
    return quality.check(rows, [Rule("sum", SUM, columns=("a", "b"))]).valid


@query(f"""with {STATE_TARGETS} select count(*) input_rows, count(*) filter (where t > 100 or m24 > 100 or m30 > 100 or part > 100) quarantined_rows from targets""")
def quality_target_ranges(spark, sf_dir):
    """The documented 0 to 100 ranges of targets and participation."""
    return quality.check(state_targets(spark, sf_dir), DOCUMENTED_RULES["targets"]).totals.select("input_rows", "quarantined_rows")


# ---- upsert ---------------------------------------------------------------


def _upsert_sides(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("ano"), "o_totalprice", "o_orderstatus", "o_orderpriority")
    base = orders.where("o_orderkey % 4 <> 0").drop("o_orderpriority")
    batch = orders.where("o_orderkey % 3 = 0").select("o_orderkey", "ano", (F.col("o_totalprice") * 2).alias("o_totalprice"), F.lit("Z").alias("o_orderstatus"), "o_orderpriority")
    return base, batch


UPSERTED = """select o_orderkey, year(o_orderdate)::int ano, case when o_orderkey % 3 = 0 then o_totalprice * 2 else o_totalprice end o_totalprice,
  case when o_orderkey % 3 = 0 and o_orderkey % 4 = 0 then 'Z' else o_orderstatus end o_orderstatus,
  case when o_orderkey % 3 = 0 then o_orderpriority end o_orderpriority from orders where o_orderkey % 4 <> 0 or o_orderkey % 3 = 0"""


@query(UPSERTED)
def upsert_orders(spark, sf_dir):
    """Update matched, insert others; the status is preserved, the priority new."""
    base, batch = _upsert_sides(spark, sf_dir)
    return upsert.merged(base, batch, ["o_orderkey", "ano"], preserve=("o_orderstatus",))


@query(UPSERTED)
def upsert_parquet_table(spark, sf_dir):
    """The same through a partitioned Parquet table, the batch applied twice."""
    base, batch = _upsert_sides(spark, sf_dir)
    path = f"{scratch_dir(spark)}/orders"
    sinks.write_table(base.withColumn("o_orderpriority", F.lit(None).cast("string")), path, "ano")
    for _ in range(2):
        upsert.upsert_parquet(batch, path, ["o_orderkey", "ano"], [], ("o_orderstatus",), "ano")
    return spark.read.schema("o_orderkey long, ano int, o_totalprice double, o_orderstatus string, o_orderpriority string").parquet(path)


def _bucketed_orders(spark, sf_dir):
    """The same table with 16 buckets a year, after both upserts."""
    base, batch = _upsert_sides(spark, sf_dir)
    path = f"{scratch_dir(spark)}/orders"
    for rows in (base, batch):
        upsert.upsert_parquet(rows, path, ["o_orderkey", "ano"], [], ("o_orderstatus",), "ano", buckets=16)
    return path


@query(UPSERTED)
def upsert_buckets(spark, sf_dir):
    """Upserts into buckets of the key: the same rows as without them."""
    return readers.read_silver(spark, _bucketed_orders(spark, sf_dir), None).select("o_orderkey", "ano", "o_totalprice", "o_orderstatus", "o_orderpriority")


@query(f"""with t as ({UPSERTED}), k as (select max(o_orderkey) k from t)
select 1::bigint parts_rewritten, 0::bigint rows_lost, (select count(*) from t) n_rows, sum(case when o_orderkey = k then -1 else o_totalprice end) total from t, k""")
def upsert_buckets_touched(spark, sf_dir):
    """One key upserted: by the files' names, one bucket of one year is new and
    all other files are as they were."""
    path = _bucketed_orders(spark, sf_dir)
    place = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("place")
    read = lambda: schemas.read_table(spark, path)
    files = lambda: read().select(place, F.col("_metadata.file_name").alias("file")).distinct()
    kept = f"{scratch_dir(spark)}/files"
    files().write.parquet(kept)
    last = read().agg(F.max_by(F.struct("o_orderkey", "ano"), "o_orderkey").alias("k"), F.count(F.lit(1)).alias("n")).first()
    one = spark.createDataFrame([(last.k.o_orderkey, last.k.ano, -1.0)], "o_orderkey long, ano int, o_totalprice double")
    upsert.upsert_parquet(one, path, ["o_orderkey", "ano"], [], (), "ano", buckets=16)
    new = files().join(spark.read.schema("place string, file string").parquet(kept), ["place", "file"], "anti")
    parts = new.agg(F.countDistinct("place").alias("parts_rewritten"), F.lit(1).alias("one"))
    sums = read().agg((F.lit(last.n) - F.count(F.lit(1))).alias("rows_lost"), F.count(F.lit(1)).alias("n_rows"), F.sum("o_totalprice").alias("total"), F.lit(1).alias("one"))
    return parts.join(sums, "one").drop("one")


# ---- events ---------------------------------------------------------------

#: Files of a topic, which its stream reads in one batch.
TOPIC_FILES = 8
_EVENT = T.StructType().add("ano", "integer").add("id_aluno", "string").add("proficiencia", "double")


@query("""select '{"event_id":"' || event_id || '","event_type":"measure","event_timestamp":"2024","payload":"{\\"user_id\\":' || user_id || ',\\"ano\\":' || year(ts) || '}"}' "value" from events""")
def event_encode(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    return ev.encode(rows, F.col("event_id"), "measure", F.lit("2024"), ["user_id"], F.year("ts")).select(F.col("value").cast("string").alias("value"))


def messages(spark, sf_dir):
    """Events as messages, some spoilt in each way that the classifier knows."""
    k, year = F.col("event_id"), F.year("ts")
    body = F.to_json(F.struct(F.col("user_id").cast("string").alias("id_aluno"), year.alias("ano"), F.col("value").alias("proficiencia"), F.lit("e").alias("more")))
    no_year = F.to_json(F.struct(F.col("user_id").cast("string").alias("id_aluno"), F.col("value").alias("proficiencia")))
    no_id = F.to_json(F.struct(year.alias("ano"), F.col("value").alias("proficiencia")))
    wrap = lambda payload, event_id=k.cast("string"): F.to_json(F.struct(event_id.alias("event_id"), F.lit("measure").alias("event_type"), payload.alias("payload")))
    way = F.col("event_id") % 12
    text = (
        F.when(way == 1, "{not json").when(way == 2, "[1, 2]").when(way == 3, wrap(body, F.lit(""))).when(way == 4, wrap(F.lit("{bad"))).when(way == 5, wrap(F.lit("[1]"))).when(way == 6, wrap(no_id))
        .when(way == 7, F.to_json(F.struct(k.cast("string").alias("event_id"), year.alias("ano"), no_year.alias("payload"))))
        .when(way == 8, F.to_json(F.struct(k.cast("string").alias("event_id"), F.struct(F.col("user_id").cast("string").alias("id_aluno"), year.alias("ano"), F.col("value").alias("proficiencia")).alias("payload"))))
        .when(way == 9, wrap(body, F.lit(None).cast("string"))).otherwise(wrap(body))
    )
    value = F.when(way == 10, F.unhex(F.lit("C328"))).when(way != 11, text.cast("binary"))
    return table(spark, sf_dir, "events").select(value.alias("value"), F.lit("t").alias("topic"), (k % 3).cast("int").alias("partition"), k.alias("offset"))


def topic(rows: DataFrame, path: str) -> None:
    """Messages as files that several tasks write and read; one batch has them all, so
    their order is that of partition and offset, not of files."""
    rows.repartition(TOPIC_FILES, "partition", "offset").write.parquet(path)


@query(f"""select year(ts)::int ano, user_id::varchar id_aluno, value proficiencia, case when event_id % 12 = 0 then '{{"more":"e"}}' end _extra, event_id::varchar _event_id,
  (event_id % 3)::int _kafka_partition, event_id _kafka_offset, '{AT}' _ingestion_timestamp from events where event_id % 12 in (0, 7, 8)""")
def event_parse_valid(spark, sf_dir):
    return ev.parse(messages(spark, sf_dir), _EVENT, ("ano", "id_aluno"), AT)[0]


@query("""select case event_id % 12 when 1 then 'bronze_invalid_envelope_json' when 2 then 'bronze_invalid_envelope_shape' when 3 then 'bronze_missing_event_fields' when 4 then 'bronze_invalid_payload_json'
  when 5 then 'bronze_invalid_payload_shape' when 6 then 'bronze_missing_natural_keys' when 9 then 'bronze_missing_event_fields' when 10 then 'bronze_kafka_decode_error' else 'bronze_kafka_empty_value' end _dlq_rule_id,
  (event_id % 3)::int _kafka_partition, event_id _kafka_offset from events where event_id % 12 in (1, 2, 3, 4, 5, 6, 9, 10, 11)""")
def event_dead_letters(spark, sf_dir):
    return ev.parse(messages(spark, sf_dir), _EVENT, ("ano", "id_aluno"), AT)[1].select("_dlq_rule_id", "_kafka_partition", "_kafka_offset")


@query(f"""with e as (select *, event_id % 12 way, year(ts)::int y, '{{\\"id_aluno\\":\\"' || user_id || '\\",\\"ano\\":' || year(ts) || '}}' body from events),
  r as (select *, case way when 3 then '' when 4 then event_id::varchar when 5 then event_id::varchar when 6 then event_id::varchar end id,
  case way when 4 then '{{bad' when 5 then '[1]' when 6 then '{{\\"ano\\":' || y || '}}' else body end payload from e where way in (1, 2, 3, 4, 5, 6, 9, 10, 11))
  select case way when 1 then 'bronze_invalid_envelope_json' when 2 then 'bronze_invalid_envelope_shape' when 4 then 'bronze_invalid_payload_json' when 5 then 'bronze_invalid_payload_shape'
  when 6 then 'bronze_missing_natural_keys' when 10 then 'bronze_kafka_decode_error' when 11 then 'bronze_kafka_empty_value' else 'bronze_missing_event_fields' end _dlq_rule_id,
  case way when 1 then 'the envelope isn''t JSON' when 2 then 'the envelope isn''t an object' when 4 then 'the payload isn''t JSON' when 5 then 'the payload isn''t an object'
  when 6 then 'a natural key is missing' when 10 then 'the value isn''t UTF-8' when 11 then 'the message has no value' else 'the event id or the payload is missing' end _dlq_reason,
  case way when 1 then '{{not json' when 2 then '[1, 2]' when 10 then 'wyg=' when 11 then null else '{{' || coalesce('"event_id":"' || id || '",', '') || '"event_type":"measure","event_timestamp":"t1","payload":"' || payload || '"}}' end _raw_payload,
  id _event_id, case when way in (3, 4, 5, 6, 9) then 'measure' end _event_type, case when way in (3, 4, 5, 6, 9) then 't1' end _event_timestamp, 't' _kafka_topic, (event_id % 3)::int _kafka_partition, event_id _kafka_offset,
  '{AT}' _ingestion_timestamp, case when way in (3, 6, 9) then y end ano from r""")
def event_reject_records(spark, sf_dir):
    """Dead letters with all that can be read of them."""
    k, year = F.col("event_id"), F.year("ts")
    body = F.to_json(F.struct(F.col("user_id").cast("string").alias("id_aluno"), year.alias("ano")))
    wrap = lambda payload, event_id=k.cast("string"): F.to_json(F.struct(event_id.alias("event_id"), F.lit("measure").alias("event_type"), F.lit("t1").alias("event_timestamp"), payload.alias("payload")))
    way = k % 12
    text = (
        F.when(way == 1, "{not json").when(way == 2, "[1, 2]").when(way == 3, wrap(body, F.lit(""))).when(way == 4, wrap(F.lit("{bad"))).when(way == 5, wrap(F.lit("[1]")))
        .when(way == 6, wrap(F.to_json(F.struct(year.alias("ano"))))).when(way == 9, wrap(body, F.lit(None).cast("string"))).otherwise(wrap(body))
    )
    value = F.when(way == 10, F.unhex(F.lit("C328"))).when(way != 11, text.cast("binary"))
    rows = table(spark, sf_dir, "events").select(value.alias("value"), F.lit("t").alias("topic"), (k % 3).cast("int").alias("partition"), k.alias("offset"))
    return ev.parse(rows, _EVENT, ("ano", "id_aluno"), AT)[1]


@query(f"""with valid as (select year(ts)::int ano, user_id::varchar id_aluno, value proficiencia, event_id, event_id % 3 part from events where event_id % 12 in (0, 7, 8)),
  last as (select * from valid qualify row_number() over (partition by ano, id_aluno order by part desc, event_id desc) = 1)
  select ano, id_aluno, proficiencia, 'known' _quality_rule_ids, 'silver' _quarantine_layer from last where id_aluno::bigint % 2 = 1""")
def stream_quarantine(spark, sf_dir):
    """Rows of a stream whose reference has every other student; a second
    reference can't be read, and its rule passes."""
    base = scratch_dir(spark)
    topic(messages(spark, sf_dir), f"{base}/topic")
    table(spark, sf_dir, "events").where("user_id % 2 = 0").select(F.col("user_id").cast("string").alias("id_aluno")).distinct().write.parquet(f"{base}/known")
    rules = (Rule("known", FOREIGN_KEY, "id_aluno", reference="known.id_aluno"), Rule("other", FOREIGN_KEY, "id_aluno", reference="absent.id_aluno"))
    tables = stream_jobs.StreamTables(f"{base}/bronze", f"{base}/silver", f"{base}/quarantine", _EVENT, ("ano", "id_aluno"), rules)
    source = readers.read_file_stream(spark, f"{base}/topic", messages(spark, sf_dir).schema, TOPIC_FILES)
    references = lambda: readers.load_references(spark, {"known": f"{base}/known", "absent": f"{base}/none"})
    stream_jobs.run_stream(source, tables, references, f"{base}/checkpoint", "stream", lambda: AT).awaitTermination()
    return spark.read.parquet(tables.quarantine).select(F.col("ano").cast("int").alias("ano"), "id_aluno", "proficiencia", "_quality_rule_ids", "_quarantine_layer")


@query(f"""with valid as (select year(ts)::int ano, user_id::varchar id_aluno, value proficiencia, event_id, event_id % 3 part from events where event_id % 12 in (0, 7, 8))
  select ano, id_aluno, proficiencia, '{AT}' _ingestion_timestamp, '{AT}' _silver_processed_at from valid
  qualify row_number() over (partition by ano, id_aluno order by part desc, event_id desc) = 1""")
def stream_bronze_silver(spark, sf_dir):
    """Messages streamed through Bronze and the quality gate into Silver."""
    base = scratch_dir(spark)
    rows = messages(spark, sf_dir)
    topic(rows, f"{base}/topic")
    source = readers.read_file_stream(spark, f"{base}/topic", rows.schema, TOPIC_FILES)
    tables = stream_jobs.StreamTables(f"{base}/bronze", f"{base}/silver", f"{base}/quarantine", _EVENT, ("ano", "id_aluno"), (Rule("r", NOT_NULL, "id_aluno"),), rejects=f"{base}/rejects")
    stream_jobs.run_stream(source, tables, dict, f"{base}/checkpoint", "stream", lambda: AT).awaitTermination()
    return spark.read.parquet(tables.silver).select(F.col("ano").cast("int").alias("ano"), "id_aluno", "proficiencia", "_ingestion_timestamp", "_silver_processed_at")


# ---- jobs -----------------------------------------------------------------


def _sources(spark, sf_dir):
    """The stand-in tables as warehouse sources."""
    base = scratch_dir(spark)
    years = [F.lit(None).cast("double").alias(f"meta_alfabetizacao_{y}") for y in range(2025, 2030)]
    regions = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("string").alias("id_uf"), F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("sigla"), F.col("r_name").alias("nome"), F.lit("x").alias("regiao"))
    frames = {"uf": regions, "municipio": towns(spark, sf_dir), "meta_municipio": local_targets(spark, sf_dir).drop("nome_municipio").select("*", *years), "meta_uf": state_targets(spark, sf_dir).select("*", *years), "meta_brasil": state_targets(spark, sf_dir).select("*", *years).where("sigla_uf = 'R1'").drop("sigla_uf")}
    for name, df in frames.items():
        df.write.parquet(f"{base}/source/{name}")
    return base, {name: f"{base}/source/{name}" for name in frames}


@query(f"""with {LOCAL_TARGETS}, s as ({STATE_TARGETS.replace("targets as (", "select * from (")})
  select (select count(*) from region) + (select count(*) from nation where n_nationkey <> 4) + (select count(*) from targets) + (select count(*) from s) + (select count(*) from s where sigla_uf = 'R1') total_records,
  5::bigint sources_processed, 0::bigint sources_empty, 0::int job_failure""")
def job_ingestion(spark, sf_dir):
    base, sources = _sources(spark, sf_dir)
    counts = jobs.ingest(spark, sources, f"{base}/bronze", jobs.Run(BATCH, AT))
    return jobs.ingestion_metrics(counts).drop("duration_seconds")


def _to_silver(spark, sf_dir):
    """The folder of a run from the sources to Silver, and its metrics."""
    base, sources = _sources(spark, sf_dir)
    run = jobs.Run(BATCH, AT)
    jobs.ingest(spark, sources, f"{base}/bronze", run)
    sinks.write_table(students(spark, sf_dir).withColumn("_ingestion_timestamp", F.lit(AT)), f"{base}/bronze/alunos", "ano")
    return base, jobs.silver(spark, f"{base}/bronze", f"{base}/silver", f"{base}/quarantine", run)


@query(f"""with {LOCAL_TARGETS}, s as ({STATE_TARGETS.replace("targets as (", "select * from (")}), pupils as (select distinct year(l_shipdate) ano, l_orderkey, l_linenumber, l_partkey, l_suppkey, s_nationkey from lineitem left join supplier on l_suppkey = s_suppkey),
  n as (select 'uf' entity, count(*) valid_rows, 0 quarantined_rows from region union all select 'municipio', count(*), 0 from nation where n_nationkey <> 4
  union all select 'meta_brasil', count(*), 0 from s where sigla_uf = 'R1' union all select 'meta_uf', count(*), 0 from s
  union all select 'meta_municipio', count(*) filter (where id_municipio <> '0000004'), count(*) filter (where id_municipio = '0000004') from targets
  union all select 'alunos', count(*) filter (where s_nationkey is distinct from 4), count(*) filter (where s_nationkey = 4) from pupils)
  select entity, valid_rows, quarantined_rows::bigint quarantined_rows, round(valid_rows / (valid_rows + quarantined_rows), 6) pass_rate from n""")
def job_silver_metrics(spark, sf_dir):
    """What the Silver job says of each entity."""
    return rounded(_to_silver(spark, sf_dir)[1], 6)


@query(f"""with {LOCAL_TARGETS} select ano, id_municipio, rede, t taxa_alfabetizacao, 'meta_municipio_fk' _quality_rule_ids, 'id_municipio deve existir na tabela municipio' _quality_messages,
  '{AT}' _quarantined_at, 'silver' _quarantine_layer, '{BATCH}' _silver_batch_id from targets where id_municipio = '0000004'""")
def job_silver_quarantine(spark, sf_dir):
    """Targets of a town that isn't known, as the Silver job puts them aside."""
    base, _ = _to_silver(spark, sf_dir)
    rows = readers.read_silver(spark, f"{base}/quarantine/meta_municipio", None)
    return rows.select(F.col("ano").cast("int").alias("ano"), "id_municipio", "rede", "taxa_alfabetizacao", "_quality_rule_ids", "_quality_messages", "_quarantined_at", "_quarantine_layer", "_silver_batch_id")


@query(f"""with {STUDENTS}, {STATE_TARGETS}, {TOWNS}, ind as (select ano, sigla_uf, rede, {_AGG} from students join towns using (id_municipio) group by all)
  select i.ano, i.sigla_uf, i.rede, {_ROUND}, {_GAPS}, r_name nome_uf, '{BATCH}' _gold_batch_id
  from ind i left join targets t on i.ano = t.ano and i.sigla_uf = t.sigla_uf and i.rede = t.rede left join region on t.sigla_uf = 'R' || r_regionkey""")
def job_gold_state(spark, sf_dir):
    """The state dataset of a run from the sources to Gold."""
    base, _ = _to_silver(spark, sf_dir)
    jobs.gold(spark, f"{base}/silver", f"{base}/gold", f"{base}/quarantine", jobs.Run(BATCH, AT), "uf")
    out = spark.read.parquet(f"{base}/gold/indicador_crianca_alfabetizada_uf")
    names = ["total_peso", "total_alfabetizados_ponderado", "proficiencia_media_ponderada", "taxa_crianca_alfabetizada", "taxa_alfabetizacao", "meta_alfabetizacao_2024", "meta_alfabetizacao_2030", "gap_taxa_vs_inep", "gap_meta_2024", "gap_meta_2030", "nome_uf", "_gold_batch_id"]
    return rounded(out.select(F.col("ano").cast("int").alias("ano"), "sigla_uf", "rede", F.col("total_alunos").cast("long").alias("total_alunos"), *names))


@query(f"""with {LOCAL} select ano, l.id_municipio, rede, {_ROUND}, round(taxa_crianca_alfabetizada - t, 4) gap_taxa_vs_inep, round(taxa_crianca_alfabetizada - m24, 4) gap_meta_2024,
  case when t is not null then x.sigla_uf end sigla_uf, '{BATCH}' _gold_batch_id from local l left join towns x using (id_municipio)
  where l.id_municipio in (select id_municipio from towns)""")
def job_gold(spark, sf_dir):
    """Ingestion, Silver and Gold one after the other, on Parquet tables."""
    base, _ = _to_silver(spark, sf_dir)
    jobs.gold(spark, f"{base}/silver", f"{base}/gold", f"{base}/quarantine", jobs.Run(BATCH, AT))
    out = spark.read.parquet(f"{base}/gold/indicador_crianca_alfabetizada_municipio")
    return rounded(out.select(F.col("ano").cast("int").alias("ano"), "id_municipio", "rede", F.col("total_alunos").cast("long").alias("total_alunos"), "total_peso", "total_alfabetizados_ponderado", "proficiencia_media_ponderada", "taxa_crianca_alfabetizada", "gap_taxa_vs_inep", "gap_meta_2024", "sigla_uf", "_gold_batch_id"))


# ---- reports --------------------------------------------------------------


@query(f"with {LOCAL} select rede, count(*) filter (where taxa_crianca_alfabetizada - m24 < 0) below_target, count(*) territories from local group by all")
def report_below_target(spark, sf_dir):
    return reports.below_target(local(spark, sf_dir), "gap_meta_2024", "rede")


@query(f"""with {LOCAL} select id_municipio, rede, ano, round(taxa_crianca_alfabetizada, 4) taxa_crianca_alfabetizada,
  round(taxa_crianca_alfabetizada - lag(taxa_crianca_alfabetizada) over (partition by id_municipio, rede order by ano), 4) "change" from local""")
def report_trend(spark, sf_dir):
    return rounded(reports.trend(local(spark, sf_dir), "taxa_crianca_alfabetizada", ["id_municipio", "rede"], "ano"))


@query("""with s as (select o_orderstatus rede, o_orderkey % 7 + 1.0 w, case when o_orderkey % 5 <> 0 then (o_orderkey % 50)::double end a, (o_orderkey % 40)::double b from orders)
  select rede, round(sum(a * w) / sum(case when a is not null then w end) + sum(b * w) / sum(w), 4) lowest_share from s group by all""")
def report_lowest_levels(spark, sf_dir):
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("rede"), (k % 7 + 1.0).alias("w"), F.when(k % 5 != 0, (k % 50).cast("double")).alias("proporcao_aluno_nivel_0"), (k % 40).cast("double").alias("proporcao_aluno_nivel_1"))
    return rounded(reports.lowest_levels(rows, ["rede"], ["proporcao_aluno_nivel_0", "proporcao_aluno_nivel_1"], "w"))


@query(f"with {LOCAL} select ano, id_municipio, rede, round(proficiencia_media_ponderada, 4) proficiencia_media_ponderada, t taxa_alfabetizacao from local")
def report_score_and_target(spark, sf_dir):
    return rounded(reports.score_against_target(local(spark, sf_dir), _KEYS, "proficiencia_media_ponderada", "taxa_alfabetizacao"))


@query(f"with {LOCAL_TARGETS} select ano, id_municipio, rede, part percentual_participacao from targets where part < 50")
def report_low_participation(spark, sf_dir):
    return reports.low_participation(local_targets(spark, sf_dir), "percentual_participacao", 50.0).select(*_KEYS, "percentual_participacao")


@query(f"""with {LOCAL} select rede, ano, id_municipio, round(taxa_crianca_alfabetizada - m24, 4) gap_meta_2024, (row_number() over (partition by rede order by taxa_crianca_alfabetizada - m24 nulls last, ano, id_municipio))::int place
  from local qualify place <= 5 and gap_meta_2024 is not null""")
def report_worst_gaps(spark, sf_dir):
    return rounded(reports.worst_gaps(local(spark, sf_dir), "gap_meta_2024", "rede", ["ano", "id_municipio"], 5).select("rede", "ano", "id_municipio", "gap_meta_2024", "place"))


@query(f"with {STUDENTS} select p >= 30000 literate_by_score, count(*) n from students group by all")
def report_score_cutoff(spark, sf_dir):
    return reports.literate_by_score(students(spark, sf_dir), "proficiencia", 30000.0).groupBy("literate_by_score").agg(F.count(F.lit(1)).alias("n"))


@query("""with a as (select o_custkey k, count(*) n from orders group by all), b as (select c_custkey k, (c_custkey % 12)::bigint n from customer)
  select k o_custkey, coalesce(a.n, 0) left_total, coalesce(b.n, 0) right_total, coalesce(a.n, 0) - coalesce(b.n, 0) difference from a full join b using (k) where coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def report_reconcile(spark, sf_dir):
    left = table(spark, sf_dir, "orders").select("o_custkey", F.lit(1).alias("n"))
    right = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), (F.col("c_custkey") % 12).alias("n"))
    return reports.reconcile(left, right, ["o_custkey"], "n", "n")
