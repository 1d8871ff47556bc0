"""String (S1-S19), number (N1-N13) and date (D-1..D-8) operators bound
to whole driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import numeric as N
from ..functions import text as T
from ..functions.common import round_half_even, round_half_up
from ..operators.joins import attach_scalars, map_values
from ..tables import Tables
from . import standins as S
from .registry import register
from .sqlutil import normalize, parse_spanish, r2, spanish_text, strip_ws


def _docs(t: Tables):
    return t.documents.select("doc_id", "text")


@register("s1_normalize_documents", f"""
SELECT doc_id, {normalize('text')} AS norm_text,
       CASE WHEN doc_id % 5 = 0 THEN NULL ELSE {normalize('text')} END AS norm_keep_null
FROM documents""", ["S1", "S2"])
def s1(t: Tables):
    d = _docs(t).select("doc_id", T.normalize_text("text", null_as_empty=False).alias("__n"))
    # S2 keeps null input null; S1 maps it to ''. The gap is made inside the
    # query, so the normalised text is computed once and reused.
    return d.select("doc_id", F.coalesce(F.col("__n"), F.lit("")).alias("norm_text"),
                    F.when(F.col("doc_id") % 5 != 0, F.col("__n")).alias("norm_keep_null"))


@register("s3_remove_accents", "SELECT doc_id, strip_accents(text) AS plain_text FROM documents", ["S3"])
def s3(t: Tables):
    return _docs(t).select("doc_id", T.remove_accents("text").alias("plain_text"))


@register("s4_tidy_text", f"""
SELECT doc_id, regexp_replace(regexp_replace({strip_ws("text || ' ,,'")}, '\\s+', ' ', 'g'), ',+$', '', 'g') AS tidy_text
FROM documents""", ["S4"])
def s4(t: Tables):
    return _docs(t).select("doc_id", T.tidy_place(F.concat("text", F.lit(" ,,"))).alias("tidy_text"))


def _key_sql(x: str) -> str:
    n = normalize(x)
    whens = " ".join(
        "WHEN " + " OR ".join(f"contains({n}, '{kw}')" for kw in kws) + f" THEN '{key}'"
        for kws, key in T.REGION_KEY_RULES)
    return f"CASE {whens} WHEN contains({n}, ',') THEN trim(split_part({n}, ',', 1)) ELSE {n} END"


@register("s5_canonical_key", f"""
SELECT doc_id, {_key_sql('text')} AS doc_key,
       {_key_sql("CASE doc_id % 4 WHEN 0 THEN 'Comunidad de Madrid' WHEN 1 THEN 'Illes Balears, Mallorca' WHEN 2 THEN 'Rioja, La' ELSE lang || ', ' || source END")} AS region_key
FROM documents""", ["S5", "S1"])
def s5(t: Tables):
    d = t.documents.select("doc_id", "text", "lang", "source")
    name = (F.when(F.col("doc_id") % 4 == 0, F.lit("Comunidad de Madrid"))
            .when(F.col("doc_id") % 4 == 1, F.lit("Illes Balears, Mallorca"))
            .when(F.col("doc_id") % 4 == 2, F.lit("Rioja, La"))
            .otherwise(F.concat_ws(", ", "lang", "source")))
    return d.select("doc_id", T.canonical_key("text").alias("doc_key"), T.canonical_key(name).alias("region_key"))


SEGMENT_ALIASES = {"HOUSEHOLD": "home", "MACHINERY": "industry"}


@register("s6_alias_replace", """
SELECT c_custkey, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'home' WHEN 'MACHINERY' THEN 'industry'
                  ELSE c_mktsegment END AS segment,
       CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'home' WHEN 'MACHINERY' THEN 'industry' END AS segment_mapped
FROM customer""", ["S6", "J10"])
def s6(t: Tables):
    c = t.customer.select("c_custkey", "c_mktsegment")
    c = map_values(c, "c_mktsegment", SEGMENT_ALIASES, mode="replace", output="segment")
    c = map_values(c, "c_mktsegment", SEGMENT_ALIASES, mode="map", output="segment_mapped")
    return c.select("c_custkey", "segment", "segment_mapped")


@register("s7_zfill_codes", """
SELECT c_custkey, CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 6 THEN lpad(CAST(c_custkey AS VARCHAR), 6, '0')
                       ELSE CAST(c_custkey AS VARCHAR) END AS code6,
       CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 2 THEN lpad(CAST(c_custkey AS VARCHAR), 2, '0')
            ELSE CAST(c_custkey AS VARCHAR) END AS code2
FROM customer""", ["S7"])
def s7(t: Tables):
    c = t.customer.select("c_custkey")
    return c.select("c_custkey", T.zfill("c_custkey", 6).alias("code6"), T.zfill("c_custkey", 2).alias("code2"))


_SENTINEL_SRC = ("CASE c_custkey % 7 WHEN 0 THEN ' NaN ' WHEN 1 THEN '-' WHEN 2 THEN '<NA>' WHEN 3 THEN ''"
                 " WHEN 4 THEN 'None' ELSE c_mktsegment END")


@register("s8_null_sentinels", f"""
SELECT c_custkey, CASE WHEN lower(trim({_SENTINEL_SRC})) IN ('', 'nan', 'none', 'null', '<na>', '-', '—') THEN NULL
                       ELSE trim({_SENTINEL_SRC}) END AS segment
FROM customer""", ["S8"])
def s8(t: Tables):
    k = F.col("c_custkey") % 7
    raw = (F.when(k == 0, " NaN ").when(k == 1, "-").when(k == 2, "<NA>").when(k == 3, "")
           .when(k == 4, "None").otherwise(F.col("c_mktsegment")))
    return t.customer.select("c_custkey", T.nullify_sentinels(raw).alias("segment"))


_LEAD_SRC = ("CASE o_orderkey % 5 WHEN 0 THEN ' 2 - 3 Meses' WHEN 1 THEN '1  MES' WHEN 2 THEN 'null' "
             "WHEN 3 THEN '2 – 3 meses' ELSE o_orderpriority END")


@register("s9_lead_time_text", f"""
SELECT o_orderkey, CASE
  WHEN x IN ('', 'nan', 'none', 'null', '-') THEN NULL
  WHEN x IN ('1 mes', '1 semana', '2 semanas', '3 meses', '2-3 meses') THEN x
  WHEN x = '2 - 3 meses' THEN '2-3 meses' ELSE x END AS lead_time
FROM (SELECT o_orderkey, replace(replace(regexp_replace(lower(trim({_LEAD_SRC})), '\\s+', ' ', 'g'), '–', '-'), '—', '-') AS x
      FROM orders) z""", ["S9"])
def s9(t: Tables):
    k = F.col("o_orderkey") % 5
    raw = (F.when(k == 0, " 2 - 3 Meses").when(k == 1, "1  MES").when(k == 2, "null")
           .when(k == 3, "2 – 3 meses").otherwise(F.col("o_orderpriority")))
    return t.orders.select("o_orderkey", T.normalize_lead_time(raw).alias("lead_time"))


@register("s10_lower_strings", """
SELECT p_partkey, lower(p_name) AS p_name, lower(p_brand) AS p_brand, lower(p_type) AS p_type, p_size, p_retailprice
FROM part""", ["S10"])
def s10(t: Tables):
    return T.lower_string_columns(t.part)


@register("s11_truncate_upper", """
SELECT p_partkey, substring(upper(trim(p_name)), 1, 5) AS name5, substring(trim(p_brand), 1, 7) AS brand7 FROM part""",
          ["S11"])
def s11(t: Tables):
    return t.part.select("p_partkey", T.truncate_upper("p_name", 5).alias("name5"),
                         T.truncate_upper("p_brand", 7, upper=False).alias("brand7"))


@register("s12_split_route", """
SELECT s_suppkey, trim(split_part(route, '-', 1)) AS origin,
       CASE WHEN strpos(route, '-') > 0 THEN trim(substring(route, strpos(route, '-') + 1)) END AS destination
FROM (SELECT s_suppkey, replace(replace(CASE WHEN s_suppkey % 3 = 0 THEN s_name
             WHEN s_suppkey % 3 = 1 THEN s_name || ' – ' || n_name || ' - x' ELSE s_name || ' - ' || n_name END,
             '–', '-'), '—', '-') AS route
      FROM supplier JOIN nation ON s_nationkey = n_nationkey) r""", ["S12", "S14"])
def s12(t: Tables):
    s = t.supplier.select("s_suppkey", "s_name", "s_nationkey").join(
        t.nation.select("n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey"))
    k = F.col("s_suppkey") % 3
    route = (F.when(k == 0, F.col("s_name"))
             .when(k == 1, F.concat(F.col("s_name"), F.lit(" – "), F.col("n_name"), F.lit(" - x")))
             .otherwise(F.concat_ws(" - ", "s_name", "n_name")))
    o, d = T.split_pair(route)
    return s.select("s_suppkey", o.alias("origin"), d.alias("destination"))


@register("s13_before_slash", "SELECT p_partkey, trim(split_part(p_type || ' / ' || p_brand, '/', 1)) AS head FROM part",
          ["S13"])
def s13(t: Tables):
    return t.part.select("p_partkey", T.before_first(F.concat_ws(" / ", "p_type", "p_brand")).alias("head"))


@register("s15_code_parts", """
SELECT s_suppkey, code, substring(code, 1, 2) AS region_part, substring(code, 3, 2) AS nation_part,
       substring(code, 5, 3) AS local_part, substring(code, 3, 6) AS partial_code, 'ES-' || code AS global_id
FROM (SELECT s_suppkey, lpad(CAST(n_regionkey AS VARCHAR), 2, '0') || lpad(CAST(s_nationkey AS VARCHAR), 2, '0')
             || lpad(CAST(s_suppkey % 1000 AS VARCHAR), 3, '0') || CAST(s_suppkey % 10 AS VARCHAR) AS code
      FROM supplier JOIN nation ON s_nationkey = n_nationkey) z""", ["S15", "S14", "S7"])
def s15(t: Tables):
    s = t.supplier.select("s_suppkey", "s_nationkey").join(
        t.nation.select("n_nationkey", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey"))
    code = F.concat(T.zfill("n_regionkey", 2), T.zfill("s_nationkey", 2), T.zfill(F.col("s_suppkey") % 1000, 3),
                    (F.col("s_suppkey") % 10).cast("string"))
    s = s.select("s_suppkey", code.alias("code"))
    return s.select("s_suppkey", "code", T.code_part("code", 1, 2).alias("region_part"),
                    T.code_part("code", 3, 2).alias("nation_part"), T.code_part("code", 5, 3).alias("local_part"),
                    T.code_part("code", 3, 6).alias("partial_code"), T.join_id(F.lit("ES"), "code").alias("global_id"))


KEYWORD_RULES = [("ring", "jewel"), ("bolt", "fastener"), ("widget", "gadget")]


@register("s16_keyword_label", """
SELECT p_partkey, CASE WHEN p_name IS NULL THEN NULL WHEN contains(lower(p_name), 'ring') THEN 'jewel'
  WHEN contains(lower(p_name), 'bolt') THEN 'fastener' WHEN contains(lower(p_name), 'widget') THEN 'gadget'
  ELSE 'other' END AS kind FROM part""", ["S16"])
def s16(t: Tables):
    return t.part.select("p_partkey", T.keyword_label("p_name", KEYWORD_RULES, "other").alias("kind"))


TITLE_OVERRIDES = {"Red Widget": "Red WIDGET"}


@register("s17_title_case", """
SELECT p_partkey, CASE WHEN t = 'Red Widget' THEN 'Red WIDGET' ELSE t END AS title
FROM (SELECT p_partkey, array_to_string(list_transform(regexp_extract_all(lower(p_name), '[a-z]+|[^a-z]+'),
             lambda w: upper(w[1]) || w[2:]), '') AS t FROM part) z""", ["S17"])
def s17(t: Tables):
    return t.part.select("p_partkey", T.title_case("p_name", TITLE_OVERRIDES).alias("title"))


@register("s18_money_format", f"SELECT o_orderkey, {spanish_text('o_totalprice')} || ' €' AS price_text FROM orders",
          ["S18"])
def s18(t: Tables):
    return t.orders.select("o_orderkey", T.format_money("o_totalprice").alias("price_text"))


def _variants_sql(name: str = "s_name || ' ñ'") -> str:
    clean = lambda x: f"regexp_replace(regexp_replace({strip_ws(x)}, '\\s+', ' ', 'g'), ',+$', '', 'g')"
    n, p, r = clean(name), clean("n_name"), clean("r_name")
    tmpl = [f"{n} || ', ' || {p} || ', ' || {r} || ', España'", f"{n} || ', ' || {p} || ', España'",
            f"{n} || ', ' || {r} || ', España'", f"{n} || ', España'", n]
    parts = []
    for i, x in enumerate(tmpl):
        parts.append(f"SELECT s_suppkey, {2 * i + 1} AS k, {clean(x)} AS q FROM base")
        parts.append(f"SELECT s_suppkey, {2 * i + 2} AS k, {clean(f'strip_accents({x})')} AS q FROM base")
    return f"""
WITH base AS (SELECT s_suppkey, s_name, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
              JOIN region ON n_regionkey = r_regionkey),
v AS ({' UNION ALL '.join(parts)}),
f AS (SELECT s_suppkey, q, MIN(k) AS k FROM v WHERE q <> '' GROUP BY s_suppkey, q)
SELECT s_suppkey, CAST(ROW_NUMBER() OVER (PARTITION BY s_suppkey ORDER BY k) AS INTEGER) AS variant_pos, q AS query
FROM f"""


def supplier_variants(t: Tables):
    s = (t.supplier.select("s_suppkey", "s_name", "s_nationkey")
         .join(t.nation.select("n_nationkey", "n_name", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey"))
         .join(t.region, F.col("n_regionkey") == F.col("r_regionkey")))
    v = T.query_variants(F.concat(F.col("s_name"), F.lit(" ñ")), "n_name", "r_name")
    return s.select("s_suppkey", F.posexplode(v).alias("p", "query")).select(
        "s_suppkey", (F.col("p") + 1).alias("variant_pos"), "query")


register("s19_query_variants", _variants_sql(), ["S19", "S3", "S4"])(supplier_variants)


# ---------------------------------------------------------------- numbers

@register("n1_parse_spanish_number", f"""
SELECT p_partkey, {parse_spanish(spanish_text('p_retailprice'))} AS price,
       {parse_spanish("CASE WHEN p_partkey % 4 = 0 THEN 'null' WHEN p_partkey % 4 = 1 THEN CAST(p_size AS VARCHAR) || ',5%' ELSE 'x' || CAST(p_size AS VARCHAR) END")} AS pct_value
FROM part""", ["N1", "S18"])
def n1(t: Tables):
    p = t.part.select("p_partkey", "p_retailprice", "p_size")
    k = F.col("p_partkey") % 4
    other = (F.when(k == 0, F.lit("null")).when(k == 1, F.concat(F.col("p_size").cast("string"), F.lit(",5%")))
             .otherwise(F.concat(F.lit("x"), F.col("p_size").cast("string"))))
    return p.select("p_partkey", N.parse_spanish_number(T.format_money("p_retailprice", symbol="")).alias("price"),
                    N.parse_spanish_number(other).alias("pct_value"))


_AUTO_SRC = (f"CASE p_partkey % 3 WHEN 0 THEN {spanish_text('p_retailprice')} "
             "WHEN 1 THEN replace(CAST(p_retailprice AS VARCHAR), '.', ',') ELSE CAST(p_retailprice AS VARCHAR) END")


@register("n2_parse_number_auto", f"""
SELECT p_partkey, CASE WHEN contains(x, '.') AND contains(x, ',') THEN {parse_spanish('x')}
  WHEN contains(x, ',') THEN TRY_CAST(CASE WHEN lower(replace(x, ',', '.')) IN ('', 'nan', 'none', 'null', '-', '—') THEN NULL ELSE replace(x, ',', '.') END AS DOUBLE)
  ELSE TRY_CAST(CASE WHEN lower(x) IN ('', 'nan', 'none', 'null', '-', '—') THEN NULL ELSE x END AS DOUBLE) END AS price,
  TRY_CAST(replace(trim(replace(CAST(p_retailprice AS VARCHAR), '.', ',')), ',', '.') AS DOUBLE) AS comma_price
FROM (SELECT p_partkey, p_retailprice, trim({_AUTO_SRC}) AS x FROM part) z""", ["N2", "N3"])
def n2(t: Tables):
    p = t.part.select("p_partkey", "p_retailprice")
    k = F.col("p_partkey") % 3
    plain = F.col("p_retailprice").cast("string")
    src = (F.when(k == 0, T.format_money("p_retailprice", symbol=""))
           .when(k == 1, F.replace(plain, F.lit("."), F.lit(","))).otherwise(plain))
    return p.select("p_partkey", N.parse_number_auto(src).alias("price"),
                    N.parse_comma_decimal(F.replace(plain, F.lit("."), F.lit(","))).alias("comma_price"))


@register("n4_parse_currency", f"""
SELECT p_partkey, CASE WHEN v > 1000 THEN v / 100 ELSE v END AS price
FROM (SELECT p_partkey, {parse_spanish("trim(replace(CASE WHEN p_partkey % 2 = 0 THEN CAST(CAST(ROUND(p_retailprice * 100) AS BIGINT) AS VARCHAR) || ' €' ELSE " + spanish_text('p_retailprice') + " || ' €' END, '€', ''))")} AS v
      FROM part) z""", ["N4"])
def n4(t: Tables):
    p = t.part.select("p_partkey", "p_retailprice")
    cents = F.concat(F.round(F.col("p_retailprice") * 100).cast("bigint").cast("string"), F.lit(" €"))
    src = F.when(F.col("p_partkey") % 2 == 0, cents).otherwise(T.format_money("p_retailprice"))
    return p.select("p_partkey", N.parse_currency(src).alias("price"))


@register("n5_rescale_if_max", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       {r2("CASE WHEN m.mx > 10 THEN l_discount * 1000 / 100 ELSE l_discount * 1000 END")} AS rating,
       {r2("CASE WHEN m.mq > 10 THEN l_quantity / 100 ELSE l_quantity / 10 END")} AS qty_rating
FROM lineitem, (SELECT MAX(l_discount * 1000) AS mx, MAX(l_quantity / 10) AS mq FROM lineitem) m""", ["N5"])
def n5(t: Tables):
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                           "l_quantity", (F.col("l_discount") * 1000).alias("r1"), (F.col("l_quantity") / 10).alias("r2"))
    j = attach_scalars(li, li.agg(F.max("r1").alias("mx"), F.max("r2").alias("mq")))
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    round_half_up(F.when(F.col("mx") > 10, F.col("r1") / 100).otherwise(F.col("r1"))).alias("rating"),
                    round_half_up(F.when(F.col("mq") > 10, F.col("l_quantity") / 100).otherwise(F.col("r2"))).alias("qty_rating"))


@register("n6_rescale_by_source", f"""
SELECT event_id, {r2("CASE WHEN event_type IN ('purchase') THEN value / 20.0 ELSE value END")} AS value_0_5 FROM events""",
          ["N6"])
def n6(t: Tables):
    e = t.events.select("event_id", "event_type", "value")
    return e.select("event_id", round_half_up(N.rescale_by_source("value", "event_type", ["purchase"])).alias("value_0_5"))


_BOOL_SRC = "CASE o_orderkey % 6 WHEN 0 THEN ' Sí' WHEN 1 THEN 'T' WHEN 2 THEN 'no' WHEN 3 THEN 'maybe' WHEN 4 THEN '1' ELSE o_orderstatus END"


@register("n7_coerce_types", f"""
SELECT o_orderkey, CASE WHEN lower(trim({_BOOL_SRC})) IN ('1', 'true', 't', 'yes', 'y', 'si', 'sí') THEN TRUE
                        WHEN lower(trim({_BOOL_SRC})) IN ('0', 'false', 'f', 'no', 'n') THEN FALSE END AS flag,
       TRY_CAST(trunc(TRY_CAST(CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_totalprice AS VARCHAR) ELSE o_orderpriority END AS DOUBLE)) AS BIGINT) AS whole
FROM orders""", ["N7"])
def n7(t: Tables):
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    k = F.col("o_orderkey") % 6
    src = (F.when(k == 0, " Sí").when(k == 1, "T").when(k == 2, "no").when(k == 3, "maybe").when(k == 4, "1")
           .otherwise(F.col("o_orderstatus")))
    num = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice").cast("string")).otherwise(F.col("o_orderpriority"))
    return o.select("o_orderkey", N.to_boolean(src).alias("flag"), N.to_integer(num).alias("whole"))


@register("n8_rounding_modes", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(ROUND(CAST(l_extendedprice / 8 AS DECIMAL(38,6)), 2) AS DOUBLE) AS half_up,
       CAST(ROUND_EVEN(CAST(l_extendedprice / 8 AS DECIMAL(38,6)), 2) AS DOUBLE) AS half_even
FROM lineitem""", ["N8"])
def n8(t: Tables):
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    x = F.col("l_extendedprice") / 8
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     N.round_to(x, 2).alias("half_up"), N.round_to(x, 2, half_even=True).alias("half_even"))


@register("n9_n10_price_gap_and_row_mean", f"""
SELECT supplier_id, month, category,
       {r2('weekend_price - weekday_price')} AS abs_gap,
       {r2('CASE WHEN weekday_price = 0 THEN NULL ELSE (weekend_price - weekday_price) / weekday_price * 100 END')} AS pct_gap,
       {r2('(COALESCE(weekday_price, 0) + COALESCE(weekend_price, 0)) / NULLIF((weekday_price IS NOT NULL)::INT + (weekend_price IS NOT NULL)::INT, 0)')} AS mean_ignore_nulls,
       {r2('(weekday_price + weekend_price) / 2')} AS mean_strict
FROM ({S.LODGING_FACT_SQL}) f""", ["N9", "N10", "A10"])
def n9(t: Tables):
    f = S.lodging_fact(t)
    return f.select("supplier_id", "month", "category",
                    round_half_up(F.col("weekend_price") - F.col("weekday_price")).alias("abs_gap"),
                    round_half_up(N.pct_change("weekday_price", "weekend_price")).alias("pct_gap"),
                    round_half_up(N.row_mean("weekday_price", "weekend_price")).alias("mean_ignore_nulls"),
                    round_half_up(N.row_mean("weekday_price", "weekend_price", ignore_nulls=False)).alias("mean_strict"))


QTY_EDGES = [0, 10, 20, 30, 40, 50]
QTY_LABELS = ["0-10", "10-20", "20-30", "30-40", "40-50"]


@register("n11_fixed_bins", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_quantity > 0 AND l_quantity <= 10 THEN '0-10' WHEN l_quantity > 10 AND l_quantity <= 20 THEN '10-20'
       WHEN l_quantity > 20 AND l_quantity <= 30 THEN '20-30' WHEN l_quantity > 30 AND l_quantity <= 40 THEN '30-40'
       WHEN l_quantity > 40 AND l_quantity <= 50 THEN '40-50' END AS qty_bin,
  CASE WHEN l_discount >= 0 AND l_discount <= 0.05 THEN 'low' WHEN l_discount > 0.05 AND l_discount <= 0.1 THEN 'high' END AS disc_bin
FROM lineitem""", ["N11"])
def n11(t: Tables):
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     N.fixed_bins("l_quantity", QTY_EDGES, QTY_LABELS).alias("qty_bin"),
                     N.fixed_bins("l_discount", [0, 0.05, 0.1], ["low", "high"], include_lowest=True).alias("disc_bin"))


@register("n12_quantile_bins", """
WITH q AS (SELECT quantile_cont(l_extendedprice, [0.0, 0.25, 0.5, 0.75, 1.0]) AS e FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_extendedprice >= e[1] AND l_extendedprice <= e[2] THEN 'Q1'
       WHEN l_extendedprice > e[2] AND l_extendedprice <= e[3] THEN 'Q2'
       WHEN l_extendedprice > e[3] AND l_extendedprice <= e[4] THEN 'Q3'
       WHEN l_extendedprice > e[4] AND l_extendedprice <= e[5] THEN 'Q4' END AS price_quartile
FROM lineitem, q""", ["N12"])
def n12(t: Tables):
    from ..plans.recipes import quantile_bins
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return quantile_bins(li, "l_extendedprice", 4, "price_quartile").drop("l_extendedprice")


@register("n13_weighted_score", f"""
SELECT s_suppkey, {r2('0.6 * (s_acctbal / 10000.0) + 0.4 * (1 - s_suppkey / 1000.0)')} AS score FROM supplier""",
          ["N13"])
def n13(t: Tables):
    s = t.supplier.select("s_suppkey", (F.col("s_acctbal") / 10000.0).alias("a"),
                          (F.lit(1) - F.col("s_suppkey") / 1000.0).alias("b"))
    return s.select("s_suppkey", round_half_up(N.weighted_sum({"a": 0.6, "b": 0.4})).alias("score"))


# ------------------------------------------------------------------ dates

@register("d1_d3_trip_dates", f"""
SELECT o_orderkey,
  CAST(end_d - start_d + 1 AS INTEGER) AS trip_days, CAST(end_d - start_d AS INTEGER) AS trip_nights,
  CAST(GREATEST(start_d - DATE '1998-01-01', 0) AS INTEGER) AS days_left,
  CAST(GREATEST(CAST(ROUND_EVEN(CAST(GREATEST(start_d - DATE '1998-01-01', 0) AS DOUBLE) / 30.0, 0) AS INTEGER), 1) AS INTEGER) AS months_left
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS start_d,
             CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 15 AS INTEGER) AS DATE) AS end_d FROM orders) z""",
          ["D-1", "D-3"])
def d1(t: Tables):
    o = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("s"))
    o = o.withColumn("e", F.date_add("s", (F.col("o_orderkey") % 15).cast("int")))
    as_of = F.lit("1998-01-01").cast("date")
    return o.select("o_orderkey", D.trip_days("s", "e").alias("trip_days"), D.trip_nights("s", "e").alias("trip_nights"),
                    D.days_until("s", as_of).alias("days_left"), D.months_until("s", as_of).alias("months_left"))


def calendar(t: Tables):
    """D-4: calendar dimension for the years present in the orders."""
    yrs = t.orders.agg(F.min(F.year("o_orderdate")).alias("y0"), F.max(F.year("o_orderdate")).alias("y1"))
    # Years x months generated from the one-row year range (no join).
    cal = (yrs.select(F.explode(F.sequence("y0", "y1")).alias("year"))
           .select("year", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month")))
    return cal.select("year", "month", D.month_name("month").alias("month_name"),
                      D.quarter_of_month("month").alias("quarter"), D.season_of_month("month").alias("season"))


_NAMES_SQL = "[" + ", ".join(f"'{n}'" for n in D.MONTH_NAMES) + "]"
CALENDAR_SQL = f"""
SELECT CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month, {_NAMES_SQL}[m] AS month_name,
       CAST(floor((m - 1) / 3) + 1 AS INTEGER) AS quarter,
       CASE WHEN m IN (7, 8, 12) THEN 'alta' WHEN m IN (4, 5, 6, 9, 10) THEN 'media' ELSE 'baja' END AS season
FROM (SELECT UNNEST(generate_series(MIN(year(o_orderdate)), MAX(year(o_orderdate)))) AS y FROM orders) ys,
     (SELECT UNNEST(generate_series(1, 12)) AS m) ms"""


register("d4_calendar_dimension", CALENDAR_SQL, ["D-4", "J14", "J13"])(calendar)


@register("d5_d6_season_and_lead_time", f"""
SELECT o.o_orderkey, c.season, c.month_name,
       CASE WHEN month(o.o_orderdate) IN (6, 7, 8, 12) THEN '2-3 meses' WHEN month(o.o_orderdate) IS NOT NULL THEN '1 mes' END AS lead_time
FROM orders o LEFT JOIN ({CALENDAR_SQL}) c ON c.year = year(o.o_orderdate) AND c.month = month(o.o_orderdate)""",
          ["D-5", "D-6", "J1"])
def d5(t: Tables):
    o = t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    j = o.join(calendar(t), ["year", "month"], "left")
    return j.select("o_orderkey", "season", "month_name", D.lead_time_for_month("month").alias("lead_time"))


@register("d7_d8_date_parts", """
SELECT o_orderkey, CAST(make_date(year(o_orderdate), month(o_orderdate), 1) AS DATE) AS month_date,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, strftime(o_orderdate, '%Y-%m') AS period,
       TRY_CAST(CASE WHEN o_orderkey % 10 = 0 THEN 'not a date' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS DATE) AS parsed
FROM orders""", ["D-7", "D-8"])
def d7(t: Tables):
    o = t.orders.select("o_orderkey", "o_orderdate")
    txt = F.when(F.col("o_orderkey") % 10 == 0, F.lit("not a date")).otherwise(F.col("o_orderdate").cast("date").cast("string"))
    return o.select("o_orderkey", D.date_from_parts(F.year("o_orderdate"), F.month("o_orderdate")).alias("month_date"),
                    D.month_start("o_orderdate").alias("month_start"), D.year_month("o_orderdate").alias("period"),
                    D.coerce_date(txt).alias("parsed"))
