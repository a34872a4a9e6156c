"""Column functions over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fiscal, values
from .bindings import AMOUNT_LINES, LINES, PROBES, amount_lines, budget_lines, probes, table
from .registry import query

#: The fiscal year of an order's date, as SQL.
FY = "(SELECT o_orderkey, y || '-' || lpad(CAST((y + 1) % 100 AS VARCHAR), 2, '0') AS fy FROM (SELECT o_orderkey, year(o_orderdate) - CASE WHEN month(o_orderdate) < 4 THEN 1 ELSE 0 END AS y FROM orders))"


def orders_fy(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", fiscal.fy_of_date(F.col("o_orderdate")).alias("fy"))


def part_text(spark, sf_dir):
    """p_partkey and texts made of names and numbers, as they might stand in a document."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        "p_partkey", "p_name",
        F.concat(F.lit("Report "), (1990 + key % 40).cast("string"), F.when(key % 2 == 0, "-").otherwise("–"), F.lpad(((key + 1) % 100).cast("string"), 2, "0"), F.lit(" no. "), key.cast("string")).alias("title"),
        F.when(key % 7 == 0, "-").when(key % 7 == 1, "").when(key % 7 == 2, "NA").when(key % 7 == 3, F.concat(key.cast("string"), F.lit(",5"))).when(key % 7 == 4, F.concat(F.lit("-"), key.cast("string"), F.lit(".25"))).otherwise(F.concat((key % 90).cast("string"), F.lit(" 0"))).alias("cell"),
        F.element_at(F.array(*map(F.lit, ["Rs in lakh", "in thousand", "₹ crore", "plain"])), (key % 4 + 1).cast("int")).alias("unit"),
        F.concat(F.lit(" A  "), F.col("p_name"), F.lit(" (0"), (key % 30).cast("string"), F.lit(") <b>&: "), (key % 9).cast("string"), F.lit("/ ..")).alias("label"),
    )


PART_TEXT = """part_text AS (SELECT p_partkey, p_name,
  'Report ' || (1990 + p_partkey % 40) || CASE WHEN p_partkey % 2 = 0 THEN '-' ELSE '–' END || lpad(CAST((p_partkey + 1) % 100 AS VARCHAR), 2, '0') || ' no. ' || p_partkey AS title,
  CASE p_partkey % 7 WHEN 0 THEN '-' WHEN 1 THEN '' WHEN 2 THEN 'NA' WHEN 3 THEN p_partkey || ',5' WHEN 4 THEN '-' || p_partkey || '.25' ELSE (p_partkey % 90) || ' 0' END AS cell,
  CASE p_partkey % 4 WHEN 0 THEN 'Rs in lakh' WHEN 1 THEN 'in thousand' WHEN 2 THEN '₹ crore' ELSE 'plain' END AS unit,
  ' A  ' || p_name || ' (0' || (p_partkey % 30) || ') <b>&: ' || (p_partkey % 9) || '/ ..' AS label FROM part)"""


@query("fn_01", f"SELECT o_orderkey, fy, (s - 1) || '-' || lpad(CAST(s % 100 AS VARCHAR), 2, '0') AS prev_fy, (s - 2) || '-' || lpad(CAST((s - 1) % 100 AS VARCHAR), 2, '0') AS actuals_fy FROM (SELECT *, CAST(substr(fy, 1, 4) AS INT) AS s FROM {FY})")
def fn_01(spark, sf_dir):
    fy = F.col("fy")
    return orders_fy(spark, sf_dir).select("o_orderkey", "fy", fiscal.earlier_fy(fy).alias("prev_fy"), fiscal.earlier_fy(fy, 2).alias("actuals_fy"))


@query("fn_02", f"SELECT o_orderkey, substr(fy, 1, 5) || substr(fy, 1, 2) || substr(fy, 6, 2) AS full_fy FROM {FY}")
def fn_02(spark, sf_dir):
    return orders_fy(spark, sf_dir).select("o_orderkey", fiscal.full_fy(F.col("fy")).alias("full_fy"))


@query("fn_03", f"WITH {PART_TEXT} SELECT p_partkey, regexp_extract(title, '([0-9]{{4}})[-–]', 1) || '-' || regexp_extract(title, '[-–]([0-9]{{2}})', 1) AS fy FROM part_text")
def fn_03(spark, sf_dir):
    return part_text(spark, sf_dir).select("p_partkey", fiscal.fy_from_title(F.col("title")).alias("fy"))


@query("fn_04", f"SELECT o_orderkey, CASE WHEN fy LIKE '20%' THEN concat_ws('|', fy, replace(fy, '-', '_'), substr(fy, 1, 4) || '-20' || substr(fy, 6, 2), substr(fy, 1, 4) || '_20' || substr(fy, 6, 2)) ELSE concat_ws('|', fy, replace(fy, '-', '_')) END AS variants FROM {FY}")
def fn_04(spark, sf_dir):
    return orders_fy(spark, sf_dir).select("o_orderkey", F.array_join(fiscal.fy_variants(F.col("fy")), "|").alias("variants"))


@query("fn_05", f"SELECT fy, count(*) AS n FROM {FY} GROUP BY 1")
def fn_05(spark, sf_dir):
    return orders_fy(spark, sf_dir).groupBy("fy").agg(F.count(F.lit(1)).alias("n"))


@query("fn_06", f"WITH {PART_TEXT} SELECT p_partkey, nullif(regexp_extract(title, '(^|[^0-9A-Za-z_])((19|20)[0-9][0-9])([^0-9A-Za-z_]|$)', 2), '') AS year FROM part_text")
def fn_06(spark, sf_dir):
    found = F.regexp_extract("title", "(^|[^0-9A-Za-z_])((19|20)[0-9][0-9])([^0-9A-Za-z_]|$)", 2)
    return part_text(spark, sf_dir).select("p_partkey", F.nullif(found, F.lit("")).alias("year"))


@query("fn_07", f"WITH {LINES} SELECT l_orderkey, l_linenumber, major || '-' || sub || '-' || minor AS code, CASE WHEN sub = '00' THEN major ELSE major || '-' || sub END AS parent_code FROM lines")
def fn_07(spark, sf_dir):
    major, sub = F.col("major"), F.col("sub")
    return budget_lines(spark, sf_dir).select("l_orderkey", "l_linenumber", fiscal.head_code(major, sub, F.col("minor")).alias("code"), fiscal.parent_code(major, sub).alias("parent_code"))


@query("fn_09", f"WITH {LINES} SELECT major, CASE WHEN major < '2' THEN 0 WHEN major < '4' THEN 2 WHEN major < '6' THEN 4 WHEN major < '8' THEN 6 ELSE 8 END AS cls, CASE WHEN CAST(major AS INT) < 4000 THEN 1 ELSE 0 END AS is_receipt, CASE WHEN CAST(major AS INT) >= 2000 THEN 1 ELSE 0 END AS is_expenditure FROM lines GROUP BY major")
def fn_09(spark, sf_dir):
    m = F.col("major")
    return budget_lines(spark, sf_dir).select("major").distinct().select("major", fiscal.account_class(m).alias("cls"), fiscal.is_receipt(m).alias("is_receipt"), fiscal.is_expenditure(m).alias("is_expenditure"))


@query("fn_10", f"WITH {PART_TEXT} SELECT p_partkey, TRY_CAST(cell AS DOUBLE) AS value FROM part_text")
def fn_10(spark, sf_dir):
    return part_text(spark, sf_dir).select("p_partkey", values.to_float(F.col("cell")).alias("value"))


@query("fn_11", f"WITH {PART_TEXT} SELECT p_partkey, coalesce(TRY_CAST(cell AS DOUBLE), 0) AS value FROM part_text")
def fn_11(spark, sf_dir):
    return part_text(spark, sf_dir).select("p_partkey", values.clean_value(F.col("cell")).alias("value"))


@query("fn_12", f"WITH {PART_TEXT} SELECT p_partkey, coalesce(TRY_CAST(replace(cell, ',', '') AS DOUBLE), 0) AS value FROM part_text")
def fn_12(spark, sf_dir):
    return part_text(spark, sf_dir).select("p_partkey", values.clean_value(F.col("cell"), commas=True).alias("value"))


@query("fn_13", f"WITH {PART_TEXT} SELECT p_partkey, coalesce(TRY_CAST(replace(replace(replace(replace(cell, ',', ''), ' ', ''), '–', '0'), '-', '0') AS DOUBLE), 0) AS value FROM part_text")
def fn_13(spark, sf_dir):
    return part_text(spark, sf_dir).select("p_partkey", values.clean_value(F.col("cell"), legacy_dash=True).alias("value"))


@query("fn_14", f"WITH {AMOUNT_LINES} SELECT doc_id, line_no, array_to_string(list_transform(list_filter(regexp_extract_all(regexp_replace(line, '[0-9,]+\\.?[0-9]*\\s*%', '', 'g'), '[0-9,]+\\.[0-9]{{2}}'), lambda x: CAST(replace(x, ',', '') AS DECIMAL(18,2)) >= 20), lambda x: replace(x, ',', '')), '|') AS amounts FROM amount_lines")
def fn_14(spark, sf_dir):
    found = F.transform(values.amounts(F.col("line"), 20.0), lambda x: x.cast("decimal(18,2)").cast("string"))
    return amount_lines(spark, sf_dir).select("doc_id", "line_no", F.array_join(found, "|").alias("amounts"))


@query("fn_15", f"WITH {PART_TEXT} SELECT p_partkey, CASE WHEN unit LIKE '%lakh%' THEN v / 100 WHEN unit LIKE '%thousand%' THEN v / 10000 ELSE v END AS crore FROM (SELECT *, coalesce(TRY_CAST(replace(cell, ',', '') AS DOUBLE), 0) AS v FROM part_text)")
def fn_15(spark, sf_dir):
    return part_text(spark, sf_dir).select("p_partkey", values.to_crore(F.col("cell"), F.col("unit")).alias("crore"))


@query("fn_16", f"WITH {PART_TEXT} SELECT p_partkey, CASE WHEN contains(unit, 'in thousand') THEN 'Thousand' WHEN contains(unit, 'in lakh') THEN 'Lakh' END AS unit FROM part_text")
def fn_16(spark, sf_dir):
    return part_text(spark, sf_dir).select("p_partkey", values.declared_unit(F.col("unit")).alias("unit"))


@query("fn_17", f"WITH {AMOUNT_LINES} SELECT doc_id, line_no, regexp_extract(line, '^(.+?)\\s+([0-9,]+\\.?[0-9]*)\\s*$', 1) AS name, CAST(regexp_extract(line, '^(.+?)\\s+([0-9,]+\\.?[0-9]*)\\s*$', 2) AS DOUBLE) AS total FROM amount_lines")
def fn_17(spark, sf_dir):
    name, total = values.trailing_amount(F.col("line"))
    return amount_lines(spark, sf_dir).select("doc_id", "line_no", name.alias("name"), total.alias("total"))


@query("fn_18", f"WITH {AMOUNT_LINES} SELECT doc_id, line_no, trim(regexp_extract(line, '^(.*?)\\s{{2,}}([0-9,.-]+)\\s{{2,}}([0-9,.-]+)', 1)) AS label, regexp_extract(line, '^(.*?)\\s{{2,}}([0-9,.-]+)\\s{{2,}}([0-9,.-]+)', 3) AS value FROM amount_lines")
def fn_18(spark, sf_dir):
    label, value = values.second_column(F.col("line"))
    return amount_lines(spark, sf_dir).select("doc_id", "line_no", label.alias("label"), value.alias("value"))


@query("fn_19", "SELECT p_partkey, (p_partkey % 90 + (p_partkey % 10) / 10.0) * 100000.0 AS crore FROM part")
def fn_19(spark, sf_dir):
    key = F.col("p_partkey")
    text = F.concat(F.lit("GSDP of "), (key % 90).cast("string"), F.when(key % 2 == 0, "-").otherwise("."), (key % 10).cast("string"), F.lit(" lakh crore"))
    return table(spark, sf_dir, "part").select("p_partkey", F.round(values.lakh_crore(text), 2).alias("crore"))


@query("fn_20", f"WITH {PART_TEXT} SELECT p_partkey, substr(lower(regexp_replace(regexp_replace(concat_ws('_', title, label), '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')), 1, 140) AS slug FROM part_text")
def fn_20(spark, sf_dir):
    return part_text(spark, sf_dir).select("p_partkey", values.doc_slug(F.col("title"), F.col("label")).alias("slug"))


@query("fn_21", f"WITH {PART_TEXT} SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(regexp_replace(label, '\\s+', ' ', 'g'), '[<>:\"/\\\\|?*]', '_', 'g'), '_+', '_', 'g'), '^[ ._]+|[ ._]+$', '', 'g') AS name FROM part_text")
def fn_21(spark, sf_dir):
    return part_text(spark, sf_dir).select("p_partkey", values.safe_name(F.col("label")).alias("name"))


@query("fn_22", f"WITH {PART_TEXT} SELECT p_partkey, substr(sha256(concat_ws('|', CAST(p_partkey AS VARCHAR), coalesce(nullif(cell, ''), 'None'), unit)), 1, 16) AS id FROM part_text")
def fn_22(spark, sf_dir):
    return part_text(spark, sf_dir).select("p_partkey", values.row_id(F.col("p_partkey"), F.nullif(F.col("cell"), F.lit("")), F.col("unit")).alias("id"))


@query("fn_23", "SELECT page_id, coalesce(nullif(lower(regexp_extract(regexp_replace(url, '[?#].*$', ''), '\\.([A-Za-z0-9]+)$', 1)), ''), 'pdf') AS ext FROM pages")
def fn_23(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", values.extension(F.col("url")).alias("ext"))


@query("fn_25", f"WITH {PART_TEXT} SELECT p_partkey, trim(regexp_replace(lower(label), '[^a-z0-9]+', ' ', 'g')) AS normal FROM part_text")
def fn_25(spark, sf_dir):
    return part_text(spark, sf_dir).select("p_partkey", F.array_join(values.tokens(F.col("label")), " ").alias("normal"))


@query("fn_26", f"WITH {PART_TEXT} SELECT p_partkey, trim(regexp_replace(label, '\\s+', ' ', 'g')) AS cleaned, trim(regexp_replace(regexp_replace(label, '\\(\\s*[0-9]+\\s*\\)', '', 'g'), '\\s+', ' ', 'g')) AS bare FROM part_text")
def fn_26(spark, sf_dir):
    return part_text(spark, sf_dir).select("p_partkey", values.clean_text(F.col("label")).alias("cleaned"), values.clean_text(F.col("label"), True).alias("bare"))


@query("fn_27", "SELECT p_partkey, CAST(p_partkey % 30 AS VARCHAR) AS markers FROM part")
def fn_27(spark, sf_dir):
    return part_text(spark, sf_dir).select("p_partkey", F.array_join(values.markers(F.col("label")), ",").alias("markers"))


@query("fn_32", f"WITH {PART_TEXT} SELECT p_partkey, p_name || ' लाख करोड़' AS text FROM part_text")
def fn_32(spark, sf_dir):
    return part_text(spark, sf_dir).select("p_partkey", values.legacy_font(F.concat("p_name", F.lit(" yk[k djksM"))).alias("text"))


@query("fn_33", f"WITH {PROBES} SELECT doc_id, regexp_matches(text, '[éèêç]') AS has_script FROM probes")
def fn_33(spark, sf_dir):
    return probes(spark, sf_dir).select("doc_id", values.has_script(F.col("text"), "[éèêç]").alias("has_script"))


@query("fn_34", f"WITH {PROBES} SELECT doc_id, CASE WHEN ext IN ('xls', 'xlsx', 'csv') THEN 'xls' WHEN chars IS NULL THEN 'unknown' WHEN regexp_matches(text, '[éèêç]') THEN 'devanagari_pdf' WHEN chars < 100 THEN 'scanned_pdf' WHEN tables >= 2 THEN 'table_pdf' ELSE 'text_pdf' END AS route FROM probes")
def fn_34(spark, sf_dir):
    return probes(spark, sf_dir).select("doc_id", values.route(F.col("ext"), F.col("chars"), F.col("tables"), values.has_script(F.col("text"), "[éèêç]")).alias("route"))


@query("fn_35", f"WITH {PROBES} SELECT doc_id, len(regexp_extract_all(lower(text), 'the')) + len(regexp_extract_all(lower(text), 'tion')) AS score FROM probes")
def fn_35(spark, sf_dir):
    return probes(spark, sf_dir).select("doc_id", values.signal(F.col("text"), ["the", "tion"]).cast("long").alias("score"))


@query("fn_37", "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'unskilled' WHEN 1 THEN 'semi-skilled' WHEN 2 THEN 'skilled' WHEN 3 THEN 'skilled' END AS skill FROM part")
def fn_37(spark, sf_dir):
    line = F.element_at(F.array(*map(F.lit, ["Unskilled worker", "Semi-skilled", "SKILLED hand", "Highly Skilled", "clerk"])), (F.col("p_partkey") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", values.skill(line).alias("skill"))


@query("fn_39", "SELECT p_partkey, CAST(p_size * 26 AS BIGINT) AS monthly FROM part")
def fn_39(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * 26).cast("long").alias("monthly"))


@query("fn_40", "SELECT p_partkey, round_even(CAST(p_size AS DOUBLE) * 100 / (p_partkey % 50 + 1), 0) AS real FROM part")
def fn_40(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", values.deflated(F.col("p_size").cast("double"), F.col("p_partkey") % 50 + 1).alias("real"))


@query("fn_41", "SELECT p_partkey, CASE WHEN p_partkey % 50 > 0 THEN round_even(CAST(p_size AS DOUBLE) * 100 / (p_partkey % 50), 1) END AS pct FROM part")
def fn_41(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", values.share(F.col("p_size").cast("double"), (F.col("p_partkey") % 50).cast("double")).alias("pct"))


@query("fn_44", "SELECT p_partkey, '/head/' || (2000 + p_partkey % 1700) || '/' || lpad(CAST(p_partkey % 100 AS VARCHAR), 2, '0') AS uri, '&lt;b&gt;&amp;' AS escaped FROM part")
def fn_44(spark, sf_dir):
    key = F.col("p_partkey")
    code = F.concat((2000 + key % 1700).cast("string"), F.lit("-"), F.lpad((key % 100).cast("string"), 2, "0"))
    return table(spark, sf_dir, "part").select("p_partkey", values.concept_uri("/head/", code).alias("uri"), values.escaped(F.lit("<b>&")).alias("escaped"))


@query("fn_45", f"WITH {LINES} SELECT DISTINCT major FROM lines")
def fn_45(spark, sf_dir):
    code = fiscal.head_code(F.col("major"), F.col("sub"), F.col("minor"))
    return budget_lines(spark, sf_dir).select(fiscal.bare_major(code).alias("major")).distinct()
