"""Report-shaped views over the star-schema test tables.

Each view is one SQL text that Spark and the checking engine both run. Views
read whole tables; odd values come from key residues so every operator meets
nulls, partial dates, unknown codes and mixed notations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]

_QUARTER = "CONCAT(CAST(year({d}) AS STRING), 'Q', CAST(quarter({d}) AS STRING))"
_DAY = "CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS STRING)"
_ORDER_QUARTER = _QUARTER.format(d="o_orderdate")
_SHIP_QUARTER = _QUARTER.format(d="l_shipdate")
_ORDER_DAY = _DAY.format(d="o_orderdate")
_SHIP_DAY = _DAY.format(d="l_shipdate")

VIEWS: dict[str, str] = {
    "demo": f"""
SELECT CAST(o_orderkey AS STRING) AS primaryid, CAST(o_custkey AS STRING) AS caseid,
  CAST(o_orderkey % 5 AS STRING) AS caseversion,
  CASE o_orderkey % 3 WHEN 0 THEN 'I' WHEN 1 THEN 'F' END AS i_f_cod,
  {_ORDER_QUARTER} AS quarter,
  CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE {_ORDER_DAY} END AS fda_dt,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN '201301'
       ELSE CONCAT(CASE WHEN o_orderkey % 3 = 0 THEN '2013' ELSE '1998' END,
                   CASE WHEN o_orderkey % 2 = 0 THEN '1231' ELSE '0101' END) END AS event_dt,
  CASE WHEN o_orderkey % 29 = 0 THEN '20011340' ELSE {_ORDER_DAY} END AS rept_dt,
  {_ORDER_DAY} AS mfr_dt, {_ORDER_DAY} AS init_fda_dt,
  CASE o_orderkey % 7 WHEN 0 THEN 'M' WHEN 1 THEN 'f' WHEN 2 THEN ' F ' WHEN 3 THEN 'UNK'
       WHEN 4 THEN 'NS' WHEN 5 THEN NULL ELSE 'm' END AS sex,
  CASE o_orderkey % 6 WHEN 0 THEN '-08' WHEN 1 THEN '1,00' WHEN 2 THEN '45' WHEN 3 THEN 'abc'
       WHEN 4 THEN '4.5.6' ELSE '500' END AS age,
  CASE o_orderkey % 11 WHEN 0 THEN 'YR' WHEN 1 THEN 'MON' WHEN 2 THEN 'DEC' WHEN 3 THEN NULL WHEN 4 THEN 'UNK'
       WHEN 5 THEN 'WK' WHEN 6 THEN 'DY' WHEN 7 THEN 'HR' WHEN 8 THEN '' WHEN 9 THEN 'MIN' ELSE 'SEC' END AS age_cod,
  CASE o_orderkey % 4 WHEN 0 THEN '70 kg' WHEN 1 THEN '1500' WHEN 2 THEN '' ELSE '155.5' END AS wt,
  CASE o_orderkey % 5 WHEN 0 THEN 'KG' WHEN 1 THEN 'LBS' WHEN 2 THEN 'GMS' WHEN 3 THEN NULL ELSE 'STONE' END AS wt_cod,
  CASE o_orderkey % 6 WHEN 0 THEN 'US' WHEN 1 THEN 'fr' WHEN 2 THEN 'XE' WHEN 3 THEN 'A1' WHEN 4 THEN NULL
       ELSE 'ZZ' END AS reporter_country,
  CASE o_orderkey % 5 WHEN 0 THEN ' de' WHEN 1 THEN 'JP' WHEN 2 THEN 'QU' WHEN 3 THEN 'COUNTRY NOT SPECIFIED'
       ELSE '' END AS occr_country,
  CASE o_orderkey % 4 WHEN 0 THEN 'MD' WHEN 1 THEN 'SALES' WHEN 2 THEN 'CN' ELSE NULL END AS occp_cod,
  CASE o_orderkey % 3 WHEN 0 THEN 'EXP' WHEN 1 THEN 'PER' ELSE 'DIR' END AS rept_cod,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CONCAT('M', CAST(o_custkey % 40 AS STRING)) END AS mfr_num,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderpriority END AS mfr_sndr,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Y' ELSE 'N' END AS e_sub,
  CASE WHEN o_orderkey % 8 = 0 THEN 'N' END AS to_mfr,
  CAST(NULL AS STRING) AS auth_num,
  CASE WHEN o_orderkey % 10 = 0 THEN 'LIT' END AS lit_ref
FROM {{orders}}""",
    "drug": f"""
SELECT CAST(l_orderkey AS STRING) AS primaryid, CAST(l_linenumber AS STRING) AS drug_seq,
  {_SHIP_QUARTER} AS quarter,
  CASE l_linenumber % 4 WHEN 1 THEN 'PS' WHEN 2 THEN 'SS' WHEN 3 THEN 'C' ELSE 'I' END AS role_cod,
  CONCAT('  ', p_name, ' (R).') AS drugname,
  CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE UPPER(p_type) END AS prod_ai,
  CASE WHEN l_partkey % 11 = 0 THEN 'unspecified' WHEN l_partkey % 29 = 0 THEN 'S1, trial'
       ELSE CONCAT('S', CAST(l_partkey % 3 AS STRING)) END AS substance,
  CASE WHEN l_partkey % 31 = 0 THEN 'S1; S2' WHEN l_partkey % 29 = 0 THEN 'S1, trial' WHEN l_partkey % 37 = 0 THEN NULL
       ELSE CONCAT('S', CAST(l_partkey % 3 AS STRING)) END AS substance_raw,
  l_partkey % 29 = 0 AS trial,
  CASE l_partkey % 4 WHEN 0 THEN 'ORAL' WHEN 1 THEN 'po' WHEN 2 THEN 'Iv' ELSE 'nasal' END AS route
FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey""",
    "drug_info": f"""
SELECT CAST(l_orderkey AS STRING) AS primaryid, CAST(l_linenumber AS STRING) AS drug_seq,
  {_SHIP_QUARTER} AS quarter,
  CASE l_partkey % 2 WHEN 0 THEN '1' ELSE '2' END AS val_vbm,
  CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE CONCAT('N', CAST(l_suppkey % 50 AS STRING)) END AS nda_num,
  CONCAT('L', CAST(l_suppkey AS STRING)) AS lot_num,
  CASE l_partkey % 4 WHEN 0 THEN 'ORAL' WHEN 1 THEN 'po' WHEN 2 THEN 'Iv' ELSE 'nasal' END AS route,
  CASE l_partkey % 3 WHEN 0 THEN ' Tab' WHEN 1 THEN 'CAPS' ELSE 'gel' END AS dose_form,
  CASE l_suppkey % 5 WHEN 0 THEN 'qd' WHEN 1 THEN 'BID ' WHEN 2 THEN 'weekly' WHEN 3 THEN 'hourly' END AS dose_freq,
  {_SHIP_DAY} AS exp_dt,
  CONCAT(CAST(CAST(l_quantity AS INT) AS STRING), ' units') AS dose_vbm,
  CASE l_partkey % 3 WHEN 0 THEN 'MG' WHEN 1 THEN 'g ' ELSE 'drop' END AS dose_unit,
  CAST(l_quantity AS STRING) AS dose_amt,
  CASE l_suppkey % 4 WHEN 0 THEN 'ug' WHEN 1 THEN ' Mg' WHEN 2 THEN 'puff' END AS cum_dose_unit,
  CASE WHEN l_suppkey % 7 = 0 THEN 'many' ELSE CAST(l_tax AS STRING) END AS cum_dose_chr,
  CASE l_returnflag WHEN 'A' THEN 'Y' WHEN 'R' THEN 'N' ELSE 'U' END AS dechal,
  CASE l_linestatus WHEN 'F' THEN 'Y' ELSE 'D' END AS rechal
FROM {{lineitem}}""",
    "reac": f"""
SELECT CAST(l_orderkey AS STRING) AS primaryid, {_SHIP_QUARTER} AS quarter,
  CASE WHEN l_suppkey % 17 = 0 THEN 'no adverse event'
       ELSE CONCAT('PT', CAST(l_suppkey % 3 AS STRING)) END AS pt,
  CASE l_suppkey % 6 WHEN 0 THEN ' Nausea ' WHEN 1 THEN 'HEADACHE NOS' WHEN 2 THEN 'feeling sick'
       WHEN 3 THEN 'Dizzy spell' WHEN 4 THEN NULL ELSE 'dizziness' END AS pt_raw,
  CASE WHEN l_linenumber % 5 = 0 THEN 'PT1' END AS drug_rec_act
FROM {{lineitem}}""",
    "outc": f"""
SELECT CAST(l_orderkey AS STRING) AS primaryid, {_SHIP_QUARTER} AS quarter,
  CASE l_suppkey % 10 WHEN 0 THEN 'DE' WHEN 1 THEN 'LT' WHEN 2 THEN 'HO' WHEN 3 THEN 'DS' WHEN 4 THEN 'CA'
       WHEN 5 THEN 'RI' WHEN 6 THEN 'OT' WHEN 7 THEN 'ho' WHEN 8 THEN 'XX' END AS outc_cod
FROM {{lineitem}}""",
    "indi": f"""
SELECT CAST(l_orderkey AS STRING) AS primaryid, CAST(l_linenumber AS STRING) AS drug_seq,
  {_SHIP_QUARTER} AS quarter,
  CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE CONCAT('PT', CAST(l_suppkey % 4 AS STRING)) END AS indi_pt
FROM {{lineitem}}""",
    "rpsr": f"""
SELECT CAST(l_orderkey AS STRING) AS primaryid, {_SHIP_QUARTER} AS quarter,
  CASE l_suppkey % 4 WHEN 0 THEN 'HP' WHEN 1 THEN 'CSM' WHEN 2 THEN 'SDY' END AS rpsr_cod
FROM {{lineitem}}""",
    "ther": f"""
SELECT CAST(l_orderkey AS STRING) AS primaryid, CAST(l_linenumber AS STRING) AS drug_seq,
  {_SHIP_QUARTER} AS quarter,
  CASE WHEN l_partkey % 12 = 0 THEN '20150615' WHEN l_partkey % 41 = 0 THEN '2015' ELSE {_SHIP_DAY} END AS start_dt,
  CASE WHEN l_linenumber = 1 THEN CONCAT(CAST(year(l_shipdate) AS STRING), '06') END AS end_dt,
  CAST(l_quantity AS STRING) AS dur,
  CASE l_linenumber % 4 WHEN 0 THEN 'DY' WHEN 1 THEN 'WK' WHEN 2 THEN 'MON' END AS dur_cod
FROM {{lineitem}}""",
    # Raw text lines as they stand in a delimited drop; one old file lost line ends.
    "raw_lines": """
SELECT CONCAT('DRUG', SUBSTRING(CAST(year(l_shipdate) AS STRING), 3, 2), 'Q',
              CAST(quarter(l_shipdate) AS STRING), '.TXT') AS file_name,
  CASE WHEN l_partkey % 40 = 0
       THEN CONCAT(CAST(l_orderkey AS STRING), '$', CAST(l_linenumber AS STRING), '$PS$"q"$$$$$$7475791$9$SS$b$$$$$$')
       WHEN l_partkey % 41 = 0
       THEN CONCAT(CAST(l_orderkey AS STRING), '$', CAST(l_linenumber AS STRING), '$C$a$b$021487$7941354$2$I$c$d$1$')
       ELSE CONCAT(CAST(l_orderkey AS STRING), '$', CAST(l_linenumber AS STRING), '$C$', l_returnflag, '$$$$$$') END AS value
FROM {lineitem}""",
    # The same drop in its two column layouts: old names, then new names.
    "drug_old": f"""
SELECT CAST(l_orderkey AS STRING) AS ISR, CAST(l_linenumber AS STRING) AS DRUG_SEQ,
  CASE l_linenumber % 2 WHEN 0 THEN 'PS' ELSE 'SS' END AS ROLE_COD,
  CASE WHEN l_partkey % 9 = 0 THEN '  ' ELSE CONCAT('drug ', CAST(l_partkey % 20 AS STRING)) END AS DRUGNAME,
  CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE CONCAT('L', CAST(l_suppkey AS STRING)) END AS LOT_NUM,
  CONCAT('N', CAST(l_suppkey AS STRING)) AS LOT_NBR, 'x' AS DOSE_VBM,
  {_SHIP_QUARTER} AS quarter
FROM {{lineitem}} WHERE year(l_shipdate) < 1999""",
    "drug_new": f"""
SELECT CAST(l_orderkey AS STRING) AS primaryid, CAST(l_linenumber AS STRING) AS drug_seq,
  CASE l_linenumber % 2 WHEN 0 THEN 'PS' ELSE 'SS' END AS role_cod,
  CASE WHEN l_partkey % 9 = 0 THEN '' ELSE CONCAT('drug ', CAST(l_partkey % 20 AS STRING)) END AS drugname,
  CONCAT('A', CAST(l_partkey % 7 AS STRING)) AS prod_ai,
  CONCAT('L', CAST(l_suppkey AS STRING)) AS lot_num, l_returnflag AS route,
  {_SHIP_QUARTER} AS quarter
FROM {{lineitem}} WHERE year(l_shipdate) >= 1999""",
    "indi_old": """
SELECT CAST(l_orderkey AS STRING) AS ISR, CAST(l_linenumber AS STRING) AS DRUG_SEQ,
  CASE WHEN l_suppkey % 5 = 0 THEN ' ' ELSE CONCAT('PT', CAST(l_suppkey % 4 AS STRING)) END AS INDI_PT
FROM {lineitem} WHERE year(l_shipdate) < 1999""",
    "indi_new": """
SELECT CAST(l_orderkey AS STRING) AS primaryid, CAST(l_linenumber AS STRING) AS indi_drug_seq,
  CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE CONCAT('PT', CAST(l_suppkey % 4 AS STRING)) END AS indi_pt
FROM {lineitem} WHERE year(l_shipdate) >= 1999""",
    "outc_old": """
SELECT CAST(l_orderkey AS STRING) AS ISR,
  CASE WHEN l_suppkey % 5 = 0 THEN '' ELSE CONCAT('O', CAST(l_suppkey % 4 AS STRING)) END AS OUTC_COD
FROM {lineitem} WHERE year(l_shipdate) < 1999""",
    "outc_new": """
SELECT CAST(l_orderkey AS STRING) AS primaryid,
  CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE CONCAT('O', CAST(l_suppkey % 4 AS STRING)) END AS outc_code
FROM {lineitem} WHERE year(l_shipdate) >= 1999""",
    "reac_old": """
SELECT CAST(l_orderkey AS STRING) AS ISR,
  CASE WHEN l_suppkey % 5 = 0 THEN '' ELSE CONCAT('PT', CAST(l_suppkey % 4 AS STRING)) END AS PT
FROM {lineitem} WHERE year(l_shipdate) < 1999""",
    "reac_new": """
SELECT CAST(l_orderkey AS STRING) AS primaryid,
  CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE CONCAT('PT', CAST(l_suppkey % 4 AS STRING)) END AS pt,
  CASE WHEN l_partkey % 4 = 0 THEN 'PT1' END AS drug_rec_act
FROM {lineitem} WHERE year(l_shipdate) >= 1999""",
    "rpsr_old": """
SELECT CAST(l_orderkey AS STRING) AS ISR, CONCAT('R', CAST(l_suppkey % 4 AS STRING)) AS RPSR_COD
FROM {lineitem} WHERE year(l_shipdate) < 1999""",
    "rpsr_new": """
SELECT CAST(l_orderkey AS STRING) AS primaryid,
  CASE WHEN l_suppkey % 5 = 0 THEN '' ELSE CONCAT('R', CAST(l_suppkey % 4 AS STRING)) END AS rpsr_cod
FROM {lineitem} WHERE year(l_shipdate) >= 1999""",
    "ther_old": f"""
SELECT CAST(l_orderkey AS STRING) AS ISR, CAST(l_linenumber AS STRING) AS DRUG_SEQ,
  {_SHIP_DAY} AS START_DT, CASE WHEN l_suppkey % 5 = 0 THEN '' ELSE {_SHIP_DAY} END AS END_DT,
  CAST(l_linenumber AS STRING) AS DUR, 'DY' AS DUR_COD
FROM {{lineitem}} WHERE year(l_shipdate) < 1999""",
    "ther_new": f"""
SELECT CAST(l_orderkey AS STRING) AS primaryid, CAST(l_linenumber AS STRING) AS dsg_drug_seq,
  {_SHIP_DAY} AS start_dt, CAST(NULL AS STRING) AS end_dt,
  CAST(l_linenumber AS STRING) AS dur, 'WK' AS dur_cod
FROM {{lineitem}} WHERE year(l_shipdate) >= 1999""",
    "demo_old": f"""
SELECT CAST(o_orderkey AS STRING) AS ISR, CAST(o_custkey AS STRING) AS CASEID,
  CASE WHEN o_orderkey % 2 = 0 THEN 'M' END AS GNDR_COD,
  CASE WHEN o_orderkey % 3 = 0 THEN 'F' END AS sex, 'I' AS I_F_COD, '45' AS Age, 'YR' AS Age_Cod,
  {_ORDER_DAY} AS EVENT_DT, {_ORDER_QUARTER} AS quarter
FROM {{orders}}""",
    # Dictionaries of real size: one row per part, per LLT-like and PT-like term.
    "drug_dictionary": """
SELECT p_partkey AS line_no, CONCAT(p_name, ' (r)') AS drugname,
  CASE WHEN p_partkey % 31 = 0 THEN 'S1; S2' WHEN p_partkey % 29 = 0 THEN 'S1, trial'
       WHEN p_partkey % 37 = 0 THEN NULL WHEN p_partkey % 2 = 0 THEN CONCAT('S', CAST(p_partkey % 9 AS STRING))
       ELSE 'S5;S6; S7, trial' END AS substance
FROM {part}""",
    "llt": """
SELECT CAST(p_partkey AS STRING) AS llt_code, p_name AS llt_name, CAST(p_partkey % 150 AS STRING) AS pt_code,
       p_partkey AS line_no FROM {part}""",
    "pt": """
SELECT CAST(s_suppkey AS STRING) AS pt_code, s_name AS pt_name FROM {supplier}""",
    # Terms for reac.pt_raw: preferred terms named by market segment rows, low-level terms by part types.
    "pt_terms": """
SELECT DISTINCT CASE n_nationkey % 3 WHEN 0 THEN 'Nausea' WHEN 1 THEN 'Dizziness' ELSE 'Headache' END AS pt_name
FROM {nation}""",
    "llt_terms": """
SELECT DISTINCT CASE r_regionkey % 2 WHEN 0 THEN 'FEELING SICK' ELSE 'Queasy' END AS llt_name, 'NAUSEA' AS pt_name
FROM {region}""",
    "term_tree": """
SELECT r_name AS soc, n_name AS hlt, CONCAT('PT', CAST(s_suppkey % 2 AS STRING)) AS pt
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    # Terms as files write them, and a tree in another case that lacks some of them.
    "indi_raw": f"""
SELECT CAST(l_orderkey AS STRING) AS primaryid, CAST(l_linenumber AS STRING) AS drug_seq, {_SHIP_QUARTER} AS quarter,
  CASE l_suppkey % 5 WHEN 0 THEN 'NAUSEA' WHEN 1 THEN 'Headache' WHEN 2 THEN ' Feeling Sick' WHEN 3 THEN NULL ELSE 'Dizziness' END AS indi_pt
FROM {{lineitem}}""",
    "pt_tree": """
SELECT r_name AS soc, n_name AS hlt, CASE n_nationkey % 3 WHEN 0 THEN 'Nausea' WHEN 1 THEN 'DIZZINESS' ELSE 'Rash' END AS pt
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "archive_pages": """
SELECT o_orderkey AS page_id,
  CONCAT('<div><A class="x" HREF="/a/q', CAST(o_custkey AS STRING), '.html">x</A><a href="/files/rep_ascii_',
         CAST(year(o_orderdate) AS STRING), 'Q', CAST(quarter(o_orderdate) AS STRING), '.ZIP">z</a></div>') AS html
FROM {orders}""",
    "deleted": """
SELECT CAST(c_custkey AS STRING) AS caseid FROM {customer} WHERE c_acctbal < 0""",
    "hierarchy": """
SELECT r_regionkey AS soc_code, r_name AS soc, n_nationkey AS hlt_code, n_name AS hlt,
       s_suppkey AS pt_code, s_name AS pt
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
}

MIXED_DATES = """
SELECT o_orderkey, CASE o_orderkey % 5
  WHEN 0 THEN CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS STRING)
  WHEN 1 THEN CONCAT(CAST(year(o_orderdate) AS STRING), '-', CAST(month(o_orderdate) AS STRING), '-', CAST(day(o_orderdate) AS STRING))
  WHEN 2 THEN CONCAT(CAST(day(o_orderdate) AS STRING), '/', CAST(month(o_orderdate) AS STRING), '/', CAST(year(o_orderdate) AS STRING))
  WHEN 3 THEN CAST(year(o_orderdate) * 100 + month(o_orderdate) AS STRING)
  ELSE CONCAT(CAST(day(o_orderdate) AS STRING), '/', CAST(day(o_orderdate) AS STRING), '/1999') END AS raw
FROM {orders}"""

SYNONYMS = """
SELECT CONCAT('Std ', CAST(p_partkey % 7 AS STRING)) AS standardized_name,
       CONCAT(p_name, ' r,', p_brand, ', ', p_type, '.') AS common_variations, p_partkey AS line_no
FROM {part}"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Spark form of an adapter view; only the base tables it names are read."""
    sql = VIEWS[name]
    used = {t: table(spark, sf_dir, t) for t in BASE_TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **used)


def ctes(*names: str) -> str:
    """``WITH`` list of the same views for the checking engine."""
    plain = {t: t for t in BASE_TABLES}
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n].format(**plain)})" for n in names)
