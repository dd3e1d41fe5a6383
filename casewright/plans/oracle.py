"""The queries as plain SQL for an independent engine.

The texts share only the adapter views and the built-in lists with the Spark
side; every rule is written out again.
"""

from __future__ import annotations

from casewright.plans import adapter
from casewright.sources import dims


def _with(views: str, *more: str, body: str) -> str:
    text = adapter.ctes(*views.split()) if views else "WITH one AS (SELECT 1)"
    return text + "".join(",\n" + m for m in more) + "\n" + body


def _values(name: str, columns: str, rows) -> str:
    def lit(v):
        return "NULL" if v is None else ("'" + v + "'" if isinstance(v, str) else f"CAST({v} AS DOUBLE)")

    return f"{name}({columns}) AS (VALUES " + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows) + ")"


_BIG = "TRY_CAST({} AS HUGEINT)"
_FDA = "TRY_CAST(fda_dt AS HUGEINT) DESC NULLS FIRST"
_VER = "TRY_CAST(caseversion AS HUGEINT) DESC NULLS LAST"
_PID = "TRY_CAST(primaryid AS HUGEINT) DESC NULLS LAST"


def _full(c: str) -> str:
    return f"(CASE WHEN length({c}) = 8 THEN CAST(TRY_STRPTIME({c}, '%Y%m%d') AS DATE) END)"


_AGE_FACTOR = """CASE WHEN age_cod IS NULL OR age_cod IN ('', 'YR') THEN 365.0 WHEN age_cod = 'DEC' THEN 3650.0
  WHEN age_cod = 'MON' THEN CAST(30.41667 AS DOUBLE) WHEN age_cod = 'WK' THEN 7.0 WHEN age_cod = 'DY' THEN 1.0
  WHEN age_cod = 'HR' THEN 0.00011415525114155251::DOUBLE WHEN age_cod = 'MIN' THEN 1.9025875190259e-06
  WHEN age_cod = 'SEC' THEN 3.1709791983764586e-08 END"""
_DAYS = f"round_even(TRY_CAST(regexp_replace(age, '[^0-9.]', '', 'g') AS DOUBLE) * CAST({_AGE_FACTOR} AS DOUBLE), 0)"
_KILOS = """round_even(TRY_CAST(regexp_replace(wt, '[^0-9.]', '', 'g') AS DOUBLE) * CAST(CASE WHEN wt_cod IS NULL
  OR wt_cod IN ('', 'KG', 'KGS') THEN 1.0 WHEN wt_cod IN ('LBS', 'IB') THEN 0.453592 WHEN wt_cod = 'GMS' THEN 0.001
  WHEN wt_cod = 'MG' THEN 0.000001 END AS DOUBLE), 0)"""
_COUNTRIES = _values("countries", "code, country_name", [*dims.COUNTRIES, ("xe", "Europe"), ("qu", "Oceania")])

# Standardized demographics, from any relation of raw ones.
def _std(source: str, out: str) -> list[str]:
    return [
        _COUNTRIES,
        f"""{out}_days AS (SELECT *, {_DAYS} AS d0, {_KILOS} AS k0 FROM {source})""",
        f"""{out}_years AS (SELECT *, CASE WHEN d0 > 44530 THEN CASE WHEN age_cod = 'DEC' THEN d0 / 3650 END ELSE d0 END AS age_in_days
  FROM {out}_days)""",
        f"""{out} AS (SELECT x.* EXCLUDE (sex, occr_country, reporter_country, occp_cod, d0, k0),
  CASE WHEN upper(trim(sex)) IN ('M', 'F') THEN upper(trim(sex)) END AS sex,
  round_even(age_in_days / 365, 0) AS age_in_years,
  CASE WHEN k0 <= 635 THEN k0 END AS wt_in_kgs,
  CASE WHEN occp_cod IN ('MD', 'CN', 'OT', 'PH', 'HP', 'LW', 'RN') THEN occp_cod END AS occp_cod,
  c1.country_name AS occr_country, c2.country_name AS reporter_country
  FROM {out}_years x LEFT JOIN countries c1 ON lower(trim(occr_country)) = c1.code
  LEFT JOIN countries c2 ON lower(trim(reporter_country)) = c2.code)""",
    ]


_GROUP = """CASE WHEN age_in_years IS NULL THEN NULL WHEN age_in_days < 28 THEN 'N' WHEN age_in_years < 2 THEN 'I'
  WHEN age_in_years < 12 THEN 'C' WHEN age_in_years < 18 THEN 'T' WHEN age_in_years < 65 THEN 'A' ELSE 'E' END"""


def _newest_case(source: str, out: str) -> str:
    return f"""{out} AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY caseid
  ORDER BY {_FDA}, {_VER}, quarter DESC NULLS LAST, {_PID}, primaryid DESC) AS rn FROM {source} WHERE caseid IS NOT NULL) WHERE rn = 1)"""


_MFR_ORDER = f"{_FDA}, quarter DESC NULLS LAST, {_PID}"


def _mfr(source: str, out: str) -> str:
    return f"""{out} AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY mfr_num, mfr_sndr
  ORDER BY {_MFR_ORDER}) AS rn FROM {source}) WHERE rn = 1 OR mfr_num IS NULL OR mfr_sndr IS NULL)"""


_NAMED_DRUG = "(SELECT primaryid FROM drug WHERE substance IS NULL OR substance NOT IN ('no medication', 'unspecified'))"
_NAMED_REAC = "(SELECT primaryid FROM reac WHERE pt IS NULL OR pt <> 'no adverse event')"
_RELEASE = [*_std("cases", "st"), """release AS (SELECT *, primaryid IN (SELECT primaryid FROM drug WHERE trial) AS premarketing,
  lit_ref IS NOT NULL AS literature FROM st)"""]


def _release(views: str, *more: str, body: str) -> str:
    named = views.split()
    for v in ("demo", "drug"):
        if v not in named:
            named.append(v)
    return _with(" ".join(named), _newest_case("demo", "cases"), *_RELEASE, *more, body=body)


def _rb(demo: str) -> list[str]:
    return [
        "pts AS (SELECT primaryid, string_agg(pt, '; ' ORDER BY pt) AS pt FROM reac GROUP BY primaryid)",
        """lists AS (SELECT primaryid,
  string_agg(substance, '; ' ORDER BY substance) FILTER (WHERE role_cod = 'PS') AS ps,
  string_agg(substance, '; ' ORDER BY substance) FILTER (WHERE role_cod = 'SS') AS ss,
  string_agg(substance, '; ' ORDER BY substance) FILTER (WHERE role_cod IN ('I', 'C')) AS ic,
  string_agg(substance, '; ' ORDER BY substance) FILTER (WHERE role_cod IN ('PS', 'SS')) AS suspected
  FROM drug GROUP BY primaryid)""",
        f"""ranked AS (SELECT primaryid,
  row_number() OVER (PARTITION BY event_dt, sex, reporter_country, age_in_days, wt_in_kgs, pt, ps, ss, ic ORDER BY {_FDA}, {_PID}) AS r_all,
  row_number() OVER (PARTITION BY event_dt, sex, reporter_country, age_in_days, wt_in_kgs, pt, suspected ORDER BY {_FDA}, {_PID}) AS r_susp
  FROM {demo} JOIN pts USING (primaryid) LEFT JOIN lists USING (primaryid))""",
        f"""flagged AS (SELECT d.*, coalesce(r_all, 2) > 1 AS rb_duplicates, coalesce(r_susp, 2) > 1 AS rb_duplicates_only_susp
  FROM {demo} d LEFT JOIN ranked USING (primaryid))""",
    ]


_RAW_RB = [
    f"""raw_days AS (SELECT *, {_DAYS} AS d0, {_KILOS} AS k0 FROM demo)""",
    """raw_std AS (SELECT primaryid, fda_dt, event_dt, reporter_country, CASE WHEN upper(trim(sex)) IN ('M', 'F') THEN upper(trim(sex)) END AS sex,
  CASE WHEN d0 > 44530 THEN CASE WHEN age_cod = 'DEC' THEN d0 / 3650 END ELSE d0 END AS age_in_days,
  CASE WHEN k0 <= 635 THEN k0 END AS wt_in_kgs FROM raw_days)""",
]

_CLEAN_NAME = r"""regexp_replace(trim(regexp_replace(regexp_replace(lower({c}), '\.$', ''), '\s+', ' ', 'g')), '[^\p{{L}}\p{{N}}_\s-]', '', 'g')"""
_DICT = f"""dict AS (SELECT drugname, substance FROM (SELECT *, row_number() OVER (PARTITION BY drugname ORDER BY line_no DESC) AS rn
  FROM (SELECT {_CLEAN_NAME.format(c='drugname')} AS drugname, coalesce(substance, 'UNKNOWN') AS substance, line_no FROM drug_dictionary)) WHERE rn = 1)"""


def _drugs(dictionary: str = "dict", synonym: str = "NULL", join: str = "") -> str:
    return f"""mapped AS (SELECT primaryid, drug_seq, n.drugname, trim(unnest(string_split(coalesce(d.substance, {synonym}, 'UNKNOWN'), ';'))) AS s
  FROM (SELECT primaryid, drug_seq, {_CLEAN_NAME.format(c='drugname')} AS drugname FROM drug) n LEFT JOIN {dictionary} d ON n.drugname = d.drugname {join}),
drugs AS (SELECT primaryid, drug_seq, drugname, replace(s, ', trial', '') AS substance, contains(s, ', trial') AS trial FROM mapped)"""


_SYN = f"""raw_syn AS ({adapter.SYNONYMS.format(part='part')}),
syn AS (SELECT drugname, substance FROM (SELECT *, row_number() OVER (PARTITION BY drugname ORDER BY line_no DESC) AS rn FROM (
  SELECT {_CLEAN_NAME.format(c='v')} AS drugname, lower(standardized_name) AS substance, line_no
  FROM (SELECT *, unnest(string_split(common_variations, ',')) AS v FROM raw_syn)) WHERE drugname <> '') WHERE rn = 1)"""

_TERMS = _values("fixes", "pt, standard_pt", dims.PT_FIXES) + """,
terms AS (SELECT term, arg_min(target, source) AS standard_pt FROM (
  SELECT lower(trim(pt_name)) AS term, lower(trim(pt_name)) AS target, 1 AS source FROM pt_terms
  UNION ALL SELECT lower(trim(llt_name)), lower(trim(pt_name)), 2 FROM llt_terms
  UNION ALL SELECT pt, standard_pt, 3 FROM fixes) GROUP BY term)"""
_FREQ = """freq AS (SELECT c.term, n, round(n / sum(n) OVER () * 100, 2) AS pct,
  c.term IN (SELECT lower(pt_name) FROM pt_terms) AS is_pt, standard_pt
  FROM (SELECT lower(trim(pt_raw)) AS term, count(*) AS n FROM reac WHERE pt_raw IS NOT NULL GROUP BY 1) c LEFT JOIN terms USING (term))"""
_UNITS = _values("units", "unit, unit_st, factor", dims.UNITS)
_ROUTES = _values("routes", "route, route_st", dims.ROUTES)
_FORMS = _values("forms", "form, form_st", dims.DOSE_FORMS)
_FREQS = _values("freqs", "freq, freq_st", dims.DOSE_FREQS)
_ROUTE = "coalesce((SELECT max(r.route_st) FROM routes r WHERE r.route = i.route), (SELECT max(r.route_st) FROM routes r WHERE lower(r.route) = lower(i.route)))"
_FORM = "(SELECT max(form_st) FROM forms f WHERE lower(f.form) = lower(trim(i.dose_form)))"
_FREQ_ST = "(SELECT max(freq_st) FROM freqs f WHERE lower(f.freq) = lower(trim(i.dose_freq)))"
_DOSE = """TRY_CAST(dose_amt AS DOUBLE) * coalesce(u1.factor, 1.0) AS dose_amt, u1.unit_st AS dose_unit,
  TRY_CAST(cum_dose_chr AS DOUBLE) * coalesce(u2.factor, 1.0) AS cum_dose_chr, u2.unit_st AS cum_dose_unit"""
_DOSE_JOIN = """drug_info i LEFT JOIN units u1 ON lower(trim(i.dose_unit)) = u1.unit
  LEFT JOIN units u2 ON lower(trim(i.cum_dose_unit)) = u2.unit"""

_DURATION = """round_even(TRY_CAST(dur AS DOUBLE) * CASE dur_cod WHEN 'DY' THEN 1.0::DOUBLE WHEN 'WK' THEN 7.0::DOUBLE
  WHEN 'MON' THEN 30.41667::DOUBLE END, 0)"""
_TTO0 = f"date_diff('day', {_full('start_dt')}, {_full('event_dt')}) + 1"
_ONSET = f"""onset AS (SELECT * EXCLUDE t0, CASE WHEN t0 <= 0 AND TRY_CAST(event_dt AS BIGINT) <= 20121231 THEN NULL ELSE t0 END AS time_to_onset
  FROM (SELECT t.*, d.event_dt, {_TTO0} AS t0 FROM ther t LEFT JOIN (SELECT primaryid, event_dt FROM demo WHERE event_dt IS NOT NULL) d USING (primaryid)))"""

_TREE = """ranks AS (SELECT pt, min(pos) AS pt_rank FROM (SELECT pt, row_number() OVER (ORDER BY soc, hlt, pt) AS pos
  FROM (SELECT DISTINCT * FROM term_tree)) GROUP BY pt)"""


_INFO = f"""info AS (SELECT i.* EXCLUDE (route, dose_form, dose_freq, dose_amt, dose_unit, cum_dose_chr, cum_dose_unit),
  {_ROUTE} AS route, {_FORM} AS dose_form, {_FREQ_ST} AS dose_freq, {_DOSE} FROM {_DOSE_JOIN})"""


def _released(views: str, *more: str, body: str) -> str:
    """``released``: the reports of a release made from raw views, next to their standardized terms and drugs."""
    return _with(
        "demo drug reac drug_dictionary pt_terms llt_terms " + views,
        "newest AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY primaryid ORDER BY quarter DESC) AS rn FROM demo) WHERE rn = 1)",
        _newest_case("newest", "cases"), _mfr("cases", "kept"), _DICT, _drugs(), _TERMS,
        "st_reac AS (SELECT primaryid, standard_pt AS pt FROM reac LEFT JOIN terms ON lower(trim(pt_raw)) = term)",
        """released AS (SELECT primaryid FROM kept WHERE primaryid IN (SELECT primaryid FROM drugs WHERE substance NOT IN ('no medication', 'unspecified'))
  AND primaryid IN (SELECT primaryid FROM st_reac WHERE pt IS NULL OR pt <> 'no adverse event'))""",
        *more, body=body)


_PT_TREE = """pt_ranks AS (SELECT lower(pt) AS pt, CAST(min(pos) AS INT) AS pt_rank FROM (SELECT pt, row_number() OVER (ORDER BY soc, hlt, pt) AS pos
  FROM (SELECT DISTINCT * FROM pt_tree)) GROUP BY 1)"""


def _stack(kind: str, old: str, new: str) -> str:
    return f"SELECT DISTINCT * FROM (SELECT {old} FROM {kind}_old UNION ALL SELECT {new} FROM {kind}_new)"


_OLD_DRUG = "ISR AS primaryid, DRUG_SEQ AS drug_seq, ROLE_COD AS role_cod, nullif(trim(DRUGNAME), '') AS drugname"
_NEW_DRUG = "primaryid, drug_seq, role_cod, nullif(trim(drugname), '') AS drugname"

_CODES = {
    "sex": "sex NOT IN ('M', 'F', 'UNK')",
    "age_cod": "age_cod NOT IN ('YR', 'MON', 'WK', 'DY', 'HR')",
}


def _findings(kind: str, cells: list[tuple[str, str, str, str]]) -> str:
    """Rows of (rule, column, value expression, condition) as a findings table."""
    parts = " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, '{col}' AS column_name, {value} AS value FROM {kind} WHERE {cond}" for rule, col, value, cond in cells
    )
    return f"""SELECT '{kind}' AS kind, rule, column_name, 'warning' AS severity, count(*) AS n_bad, count(DISTINCT value) AS n_values,
  min(value) AS first_value, max(value) AS last_value FROM ({parts}) GROUP BY rule, column_name"""


def _date_cell(c: str) -> tuple[str, str, str, str]:
    return ("full_date", c, c, f"{c} IS NOT NULL AND {_full(c)} IS NULL")


_DEMO_CELLS = [("allowed_values", c, c, cond) for c, cond in _CODES.items()] + [_date_cell(c) for c in ("event_dt", "fda_dt", "rept_dt")]
_OUTC_CELLS = [("allowed_values", "outc_cod", "upper(outc_cod)", "upper(outc_cod) NOT IN ('DE', 'LT', 'HO', 'DS', 'CA', 'RI', 'OT')")]
_DRUG_CELLS = [
    ("allowed_values", "role_cod", "role_cod", "role_cod NOT IN ('PS', 'SS', 'C', 'I')"),
    ("allowed_values", "route", "upper(route)", "upper(route) NOT IN ('ORAL', 'INTRAVENOUS', 'SUBCUTANEOUS', 'INTRAMUSCULAR', 'TOPICAL')"),
]
def _bad_dates(*columns: str) -> str:
    return " + ".join(f"count(*) FILTER (WHERE {c} IS NOT NULL AND {_full(c)} IS NULL)" for c in columns) or "0"


_SUMMARY = {
    "demo": ("age_grp", ("event_dt", "fda_dt", "rept_dt")),
    "drug": ("", ()),
    "reac": ("", ()),
    "outc": ("", ()),
    "rpsr": ("", ()),
    "ther": ("", ("start_dt", "end_dt")),
    "indi": ("", ()),
}


def _summary(*kinds: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{k}' AS kind, quarter, count(*) AS total_rows, count(*) AS processed_rows, '{_SUMMARY[k][0]}' AS missing_columns,
  CAST({_bad_dates(*_SUMMARY[k][1])} AS BIGINT) AS invalid_dates FROM {k} GROUP BY quarter"""
        for k in kinds
    )


_TOTALS = """SELECT CASE WHEN grouping(kind) = 1 THEN 'ALL' ELSE kind END AS kind, CASE WHEN grouping(quarter) = 1 THEN 'ALL' ELSE quarter END AS quarter,
  CAST(sum(total_rows) AS BIGINT) AS total_rows, CAST(sum(processed_rows) AS BIGINT) AS processed_rows, CAST(sum(invalid_dates) AS BIGINT) AS invalid_dates,
  round(CASE WHEN sum(total_rows) > 0 THEN 100.0 * sum(processed_rows) / sum(total_rows) ELSE 0 END, 1) AS success_rate
  FROM ({}) GROUP BY ROLLUP (kind, quarter)"""

# Kinds sort by name in the order of the report: demo, drug, ther.
_LINE = "printf('%.1f%%', round(CASE WHEN t > 0 THEN 100.0 * p / t ELSE 0 END, 1))"
_REPORT = f"""parts AS (
  SELECT '' AS quarter, '' AS kind, ['# Processing Summary', '', '## Overall', '- Quarters: ' || count(DISTINCT quarter), '',
    '| Kind | Rows | Processed | Success rate | Invalid dates |', '|---|---|---|---|---|'] AS l FROM summary
  UNION ALL SELECT '', kind, ['| ' || upper(kind) || ' | ' || format('{{:,}}', t) || ' | ' || format('{{:,}}', p) || ' | ' || {_LINE} || ' | ' || format('{{:,}}', d) || ' |']
    FROM (SELECT kind, CAST(sum(total_rows) AS BIGINT) AS t, CAST(sum(processed_rows) AS BIGINT) AS p, CAST(sum(invalid_dates) AS BIGINT) AS d FROM summary GROUP BY kind)
  UNION ALL SELECT quarter, '', ['', '## Quarter ' || quarter] FROM (SELECT DISTINCT quarter FROM summary)
  UNION ALL SELECT quarter, kind, ['', '### ' || upper(kind), '- Total rows: ' || format('{{:,}}', t), '- Processed rows: ' || format('{{:,}}', p),
    '- Success rate: ' || {_LINE}, '- Invalid dates: ' || format('{{:,}}', d)] || CASE WHEN m = '' THEN [] ELSE ['- Missing columns: ' || m] END
    FROM (SELECT kind, quarter, total_rows AS t, processed_rows AS p, invalid_dates AS d, missing_columns AS m FROM summary))"""

_SIM = "sex age age_cod wt wt_cod reporter_country occr_country occp_cod e_sub rept_cod".split()


def _similar(threshold: float) -> str:
    share = " + ".join(f"(CASE WHEN a.{c} IS NOT DISTINCT FROM b.{c} THEN 1 ELSE 0 END)" for c in _SIM)
    return _with("demo", f"""best AS (SELECT a.primaryid, max(({share}) / {len(_SIM)}.0) AS sim
  FROM demo a JOIN demo b ON a.caseid IS NOT DISTINCT FROM b.caseid AND a.primaryid <> b.primaryid GROUP BY a.primaryid)""",
                 body=f"SELECT caseid, {', '.join(_SIM)} FROM demo LEFT JOIN best USING (primaryid) WHERE sim IS NULL OR sim >= {threshold}")


_LINK = {"sex": (0.9, -4.0, None), "age_in_days": (3.5, -3.0, 365), "wt_in_kgs": (2.5, -2.0, 2), "event_dt": (4.0, -3.0, None), "reporter_country": (1.5, -2.5, None),
         "occr_country": (1.5, -2.0, None), "mfr_sndr": (2.0, -1.0, None), "rept_cod": (1.0, -0.5, None)}
_LINK_LADDERS = [
    "caseid sex age_in_days wt_in_kgs event_dt reporter_country occr_country mfr_sndr rept_cod fda_dt mfr_num",
    "fda_dt reporter_country sex age_in_days wt_in_kgs event_dt occr_country mfr_sndr rept_cod caseid mfr_num",
    "mfr_num event_dt sex age_in_days wt_in_kgs reporter_country occr_country mfr_sndr rept_cod caseid fda_dt",
]


def _linked(body: str, *more: str, split: bool = False) -> str:
    """``scored``: pairs of profiles that share a pass's first key, the first such pass, their agreement pattern and score; ``split`` has blocks of at most 40."""
    columns = sorted(_LINK_LADDERS[0].split())
    blocks = []
    for ladder in (x.split() for x in _LINK_LADDERS):
        if not split:
            blocks.append(ladder[0])
            continue
        steps = [f"CASE WHEN {ladder[0]} IS NULL THEN NULL"]
        for d in range(1, len(ladder) + 1):
            prefix = ", ".join(ladder[:d])
            block = f"[{', '.join(f'CAST({c} AS VARCHAR)' for c in ladder[:d])}]"
            steps.append(f"ELSE {block}" if d == len(ladder) else f"WHEN count(*) OVER (PARTITION BY {prefix}) <= 40 THEN {block}")
        blocks.append(" ".join(steps) + " END")
    same = {c: f"a.{c} = b.{c}" if tolerance is None else f"abs(a.{c} - b.{c}) <= {tolerance}" for c, (_, _, tolerance) in _LINK.items()}
    missing = {c: f"a.{c} IS NULL OR b.{c} IS NULL" for c in _LINK}
    signs = " || ".join(f"CASE WHEN {missing[c]} THEN '-' WHEN {same[c]} THEN '1' ELSE '0' END" for c in _LINK)
    total = " + ".join(f"CASE WHEN {missing[c]} THEN 0.0::DOUBLE WHEN {same[c]} THEN {agree}::DOUBLE ELSE {differ}::DOUBLE END" for c, (agree, differ, _) in _LINK.items())
    pairs = []
    for i in range(len(blocks)):
        new = "".join(f" AND (a.b{j} IS NULL OR b.b{j} IS NULL OR a.b{j} <> b.b{j})" for j in range(i))
        pairs.append(f"SELECT a, b, {i} AS pass FROM blocked a JOIN blocked b ON a.b{i} = b.b{i} AND a.id < b.id{new}")
    return _with(
        "demo", *_std("demo", "st"), f"profiles AS (SELECT {', '.join(columns)}, min(primaryid) AS id, count(*) AS n FROM st GROUP BY {', '.join(columns)})",
        f"blocked AS (SELECT *, {', '.join(f'{b} AS b{i}' for i, b in enumerate(blocks))} FROM profiles)", f"pairs AS ({' UNION ALL '.join(pairs)})",
        f"scored AS (SELECT a.id AS id_a, b.id AS id_b, a.n AS n_a, b.n AS n_b, pass, {signs} AS pattern, round({total}, 6) AS score FROM pairs)", *more,
        body=body).replace("WITH", "WITH RECURSIVE", 1)


_RAW_AGE = f"""aged AS (SELECT *, CASE WHEN d0 > 44530 THEN CASE WHEN age_cod = 'DEC' THEN d0 / 3650 END ELSE d0 END AS age_in_days
  FROM (SELECT *, {_DAYS} AS d0 FROM demo)),
years AS (SELECT *, round_even(age_in_days / 365, 0) AS age_in_years FROM aged)"""


def _describe(relation: str, c: str) -> str:
    return f"""SELECT count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS min,
  quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, max({c}) AS max FROM {relation}"""


_DROP = f"""SELECT {_OLD_DRUG}, CAST(NULL AS VARCHAR) AS prod_ai, LOT_NUM AS lot_num, LOT_NBR AS lot_nbr, CAST(NULL AS VARCHAR) AS route, '1998Q4' AS quarter FROM drug_old
  UNION ALL SELECT {_NEW_DRUG}, prod_ai, lot_num, NULL, route, '2004Q1' FROM drug_new"""

_CATEGORIES = ["role_cod", "substance", "route", "prod_ai"]
_CODE_TABLE = "code_table AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS value, CAST(row_number() OVER (ORDER BY {c}) - 1 AS INT) AS code FROM (SELECT DISTINCT {c} FROM drug WHERE {c} IS NOT NULL)"
    for c in _CATEGORIES) + ")"
_FILE_ERRORS = _with("drug_new", body="""SELECT CASE WHEN year(l_shipdate) < 1999 THEN 'DRUG98Q4.TXT' ELSE 'drug04q1.txt' END AS file_name, 'drug' AS kind,
  CASE WHEN year(l_shipdate) < 1999 THEN '1998Q4' ELSE '2004Q1' END AS quarter, count(*) AS n_rows, 0 AS n_malformed, NULL AS error_class FROM lineitem GROUP BY 1, 2, 3
  UNION ALL SELECT 'DRUG04Q2.TXT', 'drug', '2004Q2', count(*), count(*), 'invalid_format' FROM drug_new
  UNION ALL SELECT 'DRUG04Q3.TXT', 'drug', '2004Q3', 0, 0, 'empty_file'
  UNION ALL SELECT 'DRUG04Q4.TXT', 'drug', '2004Q4', count(*), 0, 'missing_columns' FROM drug_new
  UNION ALL SELECT 'DRUG05Q1.TXT', 'drug', '2005Q1', 0, 0, 'missing_columns' UNION ALL SELECT 'DRUG05Q2.TXT', 'drug', '2005Q2', 0, 0, 'invalid_format'""")

ORACLE: dict[str, str] = {
    # sources and text
    "ingest_rows": _with("drug_old drug_new", body=_DROP),
    "process_all": _with("drug_old drug_new", body=_TOTALS.format(
        f"SELECT 'drug' AS kind, quarter, count(*) AS total_rows, count(*) AS processed_rows, 0 AS invalid_dates FROM ({_DROP}) GROUP BY quarter")),
    "bronze_rows": _with("drug_old drug_new", body=f"SELECT quarter, count(*) AS n_rows FROM ({_DROP}) GROUP BY quarter"),
    "unify_files": _with("drug_old drug_new", body=_stack("drug", _OLD_DRUG + ", CAST(NULL AS VARCHAR) AS prod_ai", _NEW_DRUG + ", prod_ai")),
    "file_manifest": """SELECT DISTINCT CASE WHEN year(l_shipdate) < 1999 THEN 'DRUG98Q4.TXT' ELSE 'drug04q1.txt' END AS file_name, 'drug' AS kind,
  CASE WHEN year(l_shipdate) < 1999 THEN '1998Q4' ELSE '2004Q1' END AS quarter FROM lineitem""",
    "file_errors": _FILE_ERRORS,
    "process_file_errors": _FILE_ERRORS,
    # The file without names has no route either.
    "process_findings": _with("drug_new", body="""SELECT 'drug' AS kind, 'allowed_values' AS rule, 'route' AS column_name, 'warning' AS severity, count(*) AS n_bad,
  min(route) AS first_value, max(route) AS last_value FROM drug_new HAVING count(*) > 0"""),
    "process_rejected": _with("drug_new", body="SELECT '2004Q2' AS quarter, count(*) AS n_lines, 0 AS n_names FROM drug_new HAVING count(*) > 0"),
    "parquet_sink": _with("reac", body="SELECT primaryid, pt, quarter FROM reac"),
    "detect_delimiter": _with("raw_lines", """counted AS (SELECT file_name, length(value) - length(replace(value, '$', '')) + 1 AS n_fields, count(*) AS n
  FROM raw_lines GROUP BY 1, 2)""", body="SELECT file_name, '$' AS delimiter, max(n) AS n_lines FROM counted WHERE n_fields > 1 GROUP BY file_name"),
    "clean_line": _with("raw_lines", body="SELECT file_name, replace(value, '\"', '\\\"') AS value FROM raw_lines"),
    "split_merged": _with("raw_lines", body="""SELECT file_name, unnest(string_split(replace(replace(value, '$$$$$$7475791', '$$$$$$' || chr(10) || '7475791'),
  '021487$7941354', '021487$' || chr(10) || '7941354'), chr(10))) AS value FROM raw_lines"""),
    "quarter_label": _with("raw_lines", body="""SELECT CASE WHEN CAST(substr(file_name, 5, 2) AS INT) > 50 THEN '19' ELSE '20' END || substr(file_name, 5, 4) AS quarter,
  count(*) AS n FROM raw_lines GROUP BY 1"""),
    "clean_cells": r"""SELECT doc_id, nullif(trim(regexp_replace(text, '[\s\v\x{0085}\p{Z}]+', ' ', 'g')), '') AS text,
  nullif(trim(regexp_replace(lang, '\s+', ' ', 'g')), '') AS lang, nullif(trim(regexp_replace(source, '\s+', ' ', 'g')), '') AS source FROM documents""",
    "na_tokens": _with("demo", body="SELECT primaryid, " + ", ".join(
        f"CASE WHEN {c} NOT IN ('', 'NA', 'NULL', 'UNK') THEN {c} END AS {c}" for c in ("sex", "age_cod", "occr_country")) + " FROM demo"),
    "narrow_stats": " UNION ALL ".join(
        [f"""SELECT '{c}' AS column_name, CAST(min({c}) AS BIGINT) AS low, CAST(max({c}) AS BIGINT) AS high,
  CASE WHEN min({c}) >= -128 AND max({c}) <= 127 THEN 'tinyint' WHEN min({c}) >= -32768 AND max({c}) <= 32767 THEN 'smallint'
       WHEN min({c}) >= -2147483648 AND max({c}) <= 2147483647 THEN 'int' ELSE 'bigint' END AS target FROM lineitem"""
         for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")]
        + [f"SELECT '{c}', NULL, NULL, CASE WHEN count(DISTINCT {c}) / count(*) < 0.5 THEN 'category' ELSE 'string' END FROM lineitem"
           for c in ("l_returnflag", "l_linestatus")]),
    "narrow_types": "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem",
    "category_codes": _with("drug", _CODE_TABLE, body="SELECT * FROM code_table"),
    "encode_categories": _with("drug", _CODE_TABLE, body="SELECT CAST(primaryid AS BIGINT) AS primaryid, CAST(drug_seq AS BIGINT) AS drug_seq, " + ", ".join(
        f"coalesce((SELECT code FROM code_table t WHERE column_name = '{c}' AND t.value = d.{c}), -1) AS {c}" for c in _CATEGORIES) + " FROM drug d"),
    "decode_categories": _with("drug", body=f"SELECT CAST(primaryid AS BIGINT) AS primaryid, CAST(drug_seq AS BIGINT) AS drug_seq, {', '.join(_CATEGORIES)} FROM drug"),
    "page_links": r"""SELECT page_id, generate_subscripts(h, 1) - 1 AS position, unnest(h) AS href FROM (
  SELECT page_id, regexp_extract_all(html, '(?i)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["'']', 1) AS h FROM pages)""",
    "archive_links": """SELECT CAST(year(o_orderdate) AS VARCHAR) || 'q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter,
  '/files/rep_ascii_' || CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) || '.ZIP' AS href FROM orders GROUP BY ALL""",
    "quarter_calendar": _with("demo", """days AS (SELECT unnest(generate_series(a, b, INTERVAL 3 MONTH)) AS day
  FROM (SELECT date_trunc('quarter', min(o_orderdate)) AS a, date_trunc('quarter', max(o_orderdate)) AS b FROM orders))""",
                              body="""SELECT q.quarter, count(primaryid) AS n_reports FROM (SELECT CAST(year(day) AS VARCHAR) || 'Q' || CAST(quarter(day) AS VARCHAR) AS quarter
  FROM days) q LEFT JOIN demo USING (quarter) GROUP BY q.quarter"""),
    "stream_ingest": _with("demo", body=f"""SELECT caseid, quarter, primaryid FROM (SELECT *, row_number() OVER (PARTITION BY caseid
  ORDER BY quarter DESC NULLS LAST, {_FDA}, {_VER}, primaryid DESC) AS rn FROM demo) WHERE rn = 1"""),
    # column unification
    "rename_columns": _with("drug_old drug_new", body="""SELECT ISR AS primaryid, DRUG_SEQ AS drug_seq, ROLE_COD AS role_cod, DRUGNAME AS drugname,
  LOT_NUM AS lot_num, LOT_NBR AS lot_nbr, DOSE_VBM AS dose_vbm, quarter, NULL AS prod_ai, NULL AS route FROM drug_old
  UNION ALL SELECT primaryid, drug_seq, role_cod, drugname, lot_num, NULL, NULL, quarter, prod_ai, route FROM drug_new"""),
    "demo_columns": _with("demo_old", body="SELECT ISR AS primaryid, CASEID AS caseid, coalesce(sex, GNDR_COD) AS sex, I_F_COD AS i_f_cod, Age AS age, "
                          "Age_Cod AS age_cod, EVENT_DT AS event_dt, quarter, " + ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in """caseversion age_grp wt wt_cod
  reporter_country occr_country rept_dt mfr_dt init_fda_dt fda_dt rept_cod occp_cod mfr_num mfr_sndr to_mfr e_sub auth_num lit_ref""".split()) + " FROM demo_old"),
    "drug_columns": _with("drug_old drug_new", body="""SELECT ISR AS primaryid, DRUG_SEQ AS drug_seq, ROLE_COD AS role_cod, DRUGNAME AS drugname, NULL AS prod_ai, quarter
  FROM drug_old UNION ALL SELECT primaryid, drug_seq, role_cod, drugname, prod_ai, quarter FROM drug_new"""),
    "drug_info_columns": _with("drug_old drug_new", body="SELECT *, " + ", ".join(
        f"CAST(NULL AS VARCHAR) AS {c}" for c in "val_vbm nda_num dose_form dose_freq exp_dt cum_dose_unit cum_dose_chr dose_amt dose_unit dechal rechal".split()) + """
  FROM (SELECT ISR AS primaryid, DRUG_SEQ AS drug_seq, coalesce(LOT_NUM, LOT_NBR) AS lot_num, DOSE_VBM AS dose_vbm, NULL AS route, quarter FROM drug_old
  UNION ALL SELECT primaryid, drug_seq, lot_num, NULL, route, quarter FROM drug_new)"""),
    "reac_columns": _with("reac_old reac_new", body="SELECT ISR AS primaryid, PT AS pt, NULL AS drug_rec_act FROM reac_old UNION ALL SELECT primaryid, pt, drug_rec_act FROM reac_new"),
    "indi_columns": _with("indi_old indi_new", body="SELECT ISR AS primaryid, DRUG_SEQ AS drug_seq, INDI_PT AS indi_pt FROM indi_old UNION ALL SELECT primaryid, indi_drug_seq, indi_pt FROM indi_new"),
    "outc_columns": _with("outc_old outc_new", body="SELECT ISR AS primaryid, OUTC_COD AS outc_cod FROM outc_old UNION ALL SELECT primaryid, coalesce(outc_code, '') FROM outc_new"),
    "ther_columns": _with("ther_old ther_new", body="""SELECT ISR AS primaryid, DRUG_SEQ AS drug_seq, START_DT AS start_dt, END_DT AS end_dt, DUR AS dur, DUR_COD AS dur_cod FROM ther_old
  UNION ALL SELECT primaryid, dsg_drug_seq, start_dt, end_dt, dur, dur_cod FROM ther_new"""),
    "rpsr_columns": _with("rpsr_old rpsr_new", body="SELECT ISR AS primaryid, RPSR_COD AS rpsr_cod FROM rpsr_old UNION ALL SELECT primaryid, rpsr_cod FROM rpsr_new"),
    "unify_columns": _with("drug_old drug_new", body="""SELECT quarter, role_cod, prod_ai, count(drugname) AS n_named FROM (
  SELECT quarter, ROLE_COD AS role_cod, CAST(NULL AS VARCHAR) AS prod_ai, DRUGNAME AS drugname FROM drug_old
  UNION ALL SELECT quarter, role_cod, prod_ai, drugname FROM drug_new) GROUP BY ALL"""),
    "unify_union": _with("rpsr_old rpsr_new", body=_stack("rpsr", "ISR AS primaryid, RPSR_COD AS rpsr_cod", "primaryid, nullif(rpsr_cod, '') AS rpsr_cod")),
    "unify_coalesce": _with("drug_old drug_new", body=_stack(
        "drug", "ISR AS primaryid, DRUG_SEQ AS drug_seq, coalesce(LOT_NUM, LOT_NBR) AS lot_num", "primaryid, drug_seq, lot_num")),
    "unify_distinct": _with("drug_old drug_new", body=_stack(
        "drug", "ROLE_COD AS role_cod, nullif(trim(DRUGNAME), '') AS drugname, CAST(NULL AS VARCHAR) AS prod_ai", "role_cod, nullif(trim(drugname), ''), prod_ai")),
    "unify_drug": _with("drug_old drug_new", body=_stack("drug", _OLD_DRUG + ", CAST(NULL AS VARCHAR) AS prod_ai", _NEW_DRUG + ", prod_ai")),
    "unify_drug_info": _with("drug_old drug_new", body="SELECT *, " + ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in
        "val_vbm nda_num dose_form dose_freq exp_dt cum_dose_unit cum_dose_chr dose_amt dose_unit dechal rechal".split()) + " FROM (" + _stack(
        "drug", "ISR AS primaryid, DRUG_SEQ AS drug_seq, coalesce(LOT_NUM, LOT_NBR) AS lot_num, CAST(NULL AS VARCHAR) AS route, DOSE_VBM AS dose_vbm",
        "primaryid, drug_seq, lot_num, route, NULL") + ")"),
    "unify_indi": _with("indi_old indi_new", body=_stack("indi", "ISR AS primaryid, DRUG_SEQ AS drug_seq, nullif(trim(INDI_PT), '') AS indi_pt",
                                                         "primaryid, indi_drug_seq, indi_pt") + " WHERE indi_pt IS NOT NULL"),
    "unify_outc": _with("outc_old outc_new", body=_stack("outc", "ISR AS primaryid, nullif(OUTC_COD, '') AS outc_cod", "primaryid, outc_code") + " WHERE outc_cod IS NOT NULL"),
    "unify_reac": _with("reac_old reac_new", body=_stack("reac", "ISR AS primaryid, nullif(PT, '') AS pt, CAST(NULL AS VARCHAR) AS drug_rec_act",
                                                         "primaryid, pt, drug_rec_act") + " WHERE pt IS NOT NULL"),
    "unify_rpsr": _with("rpsr_old rpsr_new", body=_stack("rpsr", "ISR AS primaryid, RPSR_COD AS rpsr_cod", "primaryid, nullif(rpsr_cod, '') AS rpsr_cod")),
    "unify_ther": _with("ther_old ther_new", body=_stack(
        "ther", "ISR AS primaryid, DRUG_SEQ AS drug_seq, START_DT AS start_dt, nullif(END_DT, '') AS end_dt, DUR AS dur, DUR_COD AS dur_cod",
        "primaryid, dsg_drug_seq, start_dt, end_dt, dur, dur_cod")),
    # scalar standardization
    "std_sex": _with("demo", body="SELECT primaryid, CASE WHEN lower(trim(sex)) IN ('m', 'f') THEN upper(trim(sex)) END AS sex FROM demo"),
    "std_age": _with("demo", _RAW_AGE, body="SELECT primaryid, age_in_days, age_in_years FROM years"),
    "std_age_group": _with("demo", _RAW_AGE, body=f"SELECT primaryid, {_GROUP} AS age_grp FROM years"),
    "std_weight": _with("demo", body=f"SELECT primaryid, CASE WHEN k0 <= 635 THEN k0 END AS wt_in_kgs FROM (SELECT primaryid, {_KILOS} AS k0 FROM demo)"),
    "std_occupation": _with("demo", body="SELECT primaryid, CASE WHEN occp_cod IN ('MD', 'CN', 'OT', 'PH', 'HP', 'LW', 'RN') THEN occp_cod END AS occp_cod FROM demo"),
    "std_outcome": _with("outc", body="""SELECT primaryid, CASE WHEN n IS NOT NULL THEN outc_cod END AS outc_cod, n AS outcome FROM (SELECT *, CASE outc_cod
  WHEN 'DE' THEN 'Death' WHEN 'LT' THEN 'Life-Threatening' WHEN 'HO' THEN 'Hospitalization' WHEN 'DS' THEN 'Disability' WHEN 'CA' THEN 'Congenital Anomaly'
  WHEN 'RI' THEN 'Required Intervention' WHEN 'OT' THEN 'Other' END AS n FROM outc)"""),
    "clean_drugname": _with("drug", body=f"SELECT primaryid, drug_seq, {_CLEAN_NAME.format(c='drugname')} AS drugname FROM drug"),
    "clean_term_text": "SELECT doc_id, " + r"regexp_replace(trim(regexp_replace(regexp_replace(lower(text), '\.$', ''), '[\s\v\x{0085}\p{Z}]+', ' ', 'g')), '[^\p{L}\p{N}_\s-]', '', 'g')" + " AS text FROM documents",
    "parse_dates": f"""SELECT o_orderkey, strftime(CASE WHEN raw LIKE '%-%' THEN TRY_STRPTIME(raw, '%Y-%m-%d') WHEN raw LIKE '%/%' THEN TRY_STRPTIME(raw, '%d/%m/%Y')
  WHEN length(raw) = 8 THEN TRY_STRPTIME(raw, '%Y%m%d') END, '%Y-%m-%d') AS day FROM ({adapter.MIXED_DATES.format(orders='orders')})""",
    "std_numeric": _with("drug_info", body="""SELECT primaryid, drug_seq, TRY_CAST(dose_amt AS DOUBLE) / CASE lower(trim(dose_unit)) WHEN 'g' THEN 1000 WHEN 'mg' THEN 1000000 ELSE 1 END AS dose,
  TRY_CAST(cum_dose_chr AS DOUBLE) / CASE lower(trim(cum_dose_unit)) WHEN 'g' THEN 1000 WHEN 'mg' THEN 1000000 ELSE 1 END AS cum_dose FROM drug_info"""),
    "role_rank": _with("drug", body="SELECT primaryid, drug_seq, role_cod, CASE role_cod WHEN 'C' THEN 1 WHEN 'I' THEN 2 WHEN 'SS' THEN 3 WHEN 'PS' THEN 4 END AS role_rank FROM drug"),
    "outcome_rank": _with("outc", body="""SELECT primaryid, CASE WHEN r IS NOT NULL THEN outc_cod END AS outc_cod, r AS outc_rank FROM (SELECT *, CASE outc_cod WHEN 'OT' THEN 1 WHEN 'CA' THEN 2
  WHEN 'HO' THEN 3 WHEN 'RI' THEN 4 WHEN 'DS' THEN 5 WHEN 'LT' THEN 6 WHEN 'DE' THEN 7 END AS r FROM outc)"""),
    "duration_days": _with("ther", body=f"SELECT primaryid, drug_seq, {_DURATION} AS dur_in_days FROM ther"),
    "finalize_demo": _with("demo", body="""SELECT primaryid, sex, quarter, i_f_cod, occp_cod, e_sub, CAST(NULL AS VARCHAR) AS caseversion, CAST(NULL AS VARCHAR) AS rept_cod,
  CAST(NULL AS VARCHAR) AS age_grp, CAST(NULL AS VARCHAR) AS occr_country, CAST(NULL AS VARCHAR) AS reporter_country FROM demo"""),
    # vocabularies
    "std_country": _with("demo", *_std("demo", "st"), body="SELECT primaryid, occr_country, reporter_country FROM st"),
    "std_route": _with("drug_info", _ROUTES, body=f"SELECT primaryid, drug_seq, {_ROUTE} AS route FROM drug_info i"),
    "std_dose_form": _with("drug_info", _FORMS, body=f"SELECT primaryid, drug_seq, {_FORM} AS dose_form FROM drug_info i"),
    "std_dose_freq": _with("drug_info", _FREQS, body=f"SELECT primaryid, drug_seq, {_FREQ_ST} AS dose_freq FROM drug_info i"),
    "std_dose": _with("drug_info", _UNITS, body=f"SELECT primaryid, drug_seq, {_DOSE} FROM {_DOSE_JOIN}"),
    "drug_info_clean": _with("drug_info", _UNITS, _ROUTES, _FORMS, _FREQS, body=f"""SELECT i.* EXCLUDE (route, dose_form, dose_freq, dose_amt, dose_unit, cum_dose_chr, cum_dose_unit),
  {_ROUTE} AS route, {_FORM} AS dose_form, {_FREQ_ST} AS dose_freq, {_DOSE} FROM {_DOSE_JOIN}"""),
    "drug_dictionary": _with("drug_dictionary", _DICT, body="SELECT drugname, substance FROM dict"),
    "std_drugs": _with("drug drug_dictionary", _DICT, _drugs(), body="SELECT primaryid, drug_seq, drugname, substance, trial FROM drugs"),
    "explode_substances": _with("drug", body="""SELECT primaryid, drug_seq, trim(unnest(string_split(substance_raw, ';'))) AS substance FROM drug WHERE substance_raw IS NOT NULL"""),
    "trial_flag": _with("drug", body="""SELECT primaryid, drug_seq, replace(substance_raw, ', trial', '') AS substance, coalesce(contains(substance_raw, ', trial'), false) AS trial FROM drug"""),
    "drug_synonyms": _with("", _SYN, body="SELECT drugname, substance FROM syn"),
    "std_drugs_synonyms": _with("drug drug_dictionary", _DICT, _SYN,
                                _drugs("dict", "y.substance", "LEFT JOIN syn y ON n.drugname = y.drugname"),
                                body="SELECT primaryid, drug_seq, substance, trial FROM drugs"),
    "drug_stats": _with("drug drug_dictionary", _DICT, _drugs(), body="SELECT count(*) AS n_rows, count(DISTINCT substance) AS n_substances, count(*) FILTER (WHERE trial) AS n_trial FROM drugs"),
    "llt_pt_join": _with("llt pt", body="""SELECT llt_name, pt_name FROM (SELECT upper(llt_name) AS llt_name, upper(pt_name) AS pt_name,
  row_number() OVER (PARTITION BY upper(llt_name) ORDER BY line_no DESC) AS rn FROM llt LEFT JOIN pt USING (pt_code)) WHERE rn = 1"""),
    "std_pt": _with("reac pt_terms llt_terms", _TERMS, body="SELECT primaryid, pt, standard_pt AS pt_raw FROM reac LEFT JOIN terms ON lower(trim(pt_raw)) = term"),
    "std_indications": _with("reac pt_terms llt_terms", _TERMS, body="SELECT standard_pt AS indi_pt, count(*) AS n FROM reac LEFT JOIN terms ON lower(trim(pt_raw)) = term GROUP BY 1"),
    "pt_frequency": _with("reac pt_terms llt_terms", _TERMS, _FREQ, body="SELECT * FROM freq"),
    "pt_coverage": _with("reac pt_terms llt_terms", _TERMS, _FREQ, body="""SELECT CAST(sum(n) AS BIGINT) AS n_rows,
  round(coalesce(sum(n) FILTER (WHERE NOT is_pt), 0) * 100 / sum(n), 3) AS pct_nonstandard_before,
  round(coalesce(sum(n) FILTER (WHERE standard_pt IS NOT NULL), 0) * 100 / sum(n), 3) AS pct_standard_after FROM freq"""),
    "pt_worklist": _with("reac pt_terms llt_terms", _TERMS, body="""SELECT pt, standard_pt FROM fixes UNION
  SELECT lower(trim(pt_raw)), NULL FROM reac WHERE pt_raw IS NOT NULL AND lower(trim(pt_raw)) NOT IN (SELECT term FROM terms)"""),
    "meddra_flat": _with("hierarchy", body="SELECT soc, hlt, pt, CAST(row_number() OVER (ORDER BY soc, hlt, pt) AS INT) AS pt_rank FROM hierarchy"),
    # deduplication
    "dedup_primaryid": _with("demo", body=f"""SELECT caseid, primaryid, quarter, fda_dt FROM (SELECT *, row_number() OVER (PARTITION BY caseid
  ORDER BY quarter DESC NULLS LAST, {_FDA}, {_VER}, primaryid DESC) AS rn FROM demo) WHERE rn = 1"""),
    "dedup_primaryid_ties": _with("demo", body="SELECT caseid, primaryid, quarter FROM (SELECT *, max(quarter) OVER (PARTITION BY caseid) AS q FROM demo) WHERE quarter = q"),
    "dedup_case": _with("demo", _newest_case("demo", "cases"), body="SELECT caseid, primaryid, caseversion, quarter, fda_dt FROM cases"),
    "dedup_manufacturer": _with("demo", _mfr("demo", "kept"), body="SELECT primaryid, mfr_num, mfr_sndr, fda_dt FROM kept"),
    "dedup_dataset": _with("demo", body=f"""SELECT caseid, primaryid, quarter FROM (SELECT *, row_number() OVER (PARTITION BY caseid
  ORDER BY quarter DESC NULLS LAST, {_FDA}, {_VER}, primaryid DESC) AS rn FROM demo) WHERE rn = 1"""),
    "rb_duplicates": _with("demo reac drug", *_RAW_RB, *_rb("raw_std"), body="SELECT primaryid, rb_duplicates FROM flagged"),
    "rb_duplicates_susp": _with("demo reac drug", *_RAW_RB, *_rb("raw_std"), body="SELECT primaryid, rb_duplicates_only_susp FROM flagged"),
    "dup_stats": _with("demo reac drug", *_RAW_RB, *_rb("raw_std"), body="""SELECT count(*) AS n_reports, count(*) FILTER (WHERE rb_duplicates) AS n_dup,
  count(*) FILTER (WHERE rb_duplicates_only_susp) AS n_dup_susp, round(100.0 * count(*) FILTER (WHERE rb_duplicates) / count(*), 1) AS pct_dup,
  round(100.0 * count(*) FILTER (WHERE rb_duplicates_only_susp) / count(*), 1) AS pct_dup_susp FROM flagged"""),
    "sorted_term_list": _with("reac", body="SELECT primaryid, string_agg(pt, '; ' ORDER BY pt) AS pt FROM reac GROUP BY primaryid"),
    "term_chunks": _with("reac", """starts AS (SELECT primaryid, pt,
  coalesce(sum(octet_length(encode(pt)) + 2) OVER (PARTITION BY primaryid ORDER BY pt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM reac WHERE pt IS NOT NULL)""",
                         body="""SELECT primaryid, CAST(start // 12 AS BIGINT) AS chunk, string_agg(pt, '; ' ORDER BY pt) AS text FROM starts GROUP BY 1, 2
  UNION ALL SELECT primaryid, 0, '' FROM reac GROUP BY primaryid HAVING count(pt) = 0"""),
    "role_lists": _with("drug", _rb("demo")[1], body="SELECT * FROM lists"),
    "similarity_filter": _similar(0.7),
    "similarity_filter_strict": _similar(0.9),
    "linkage_score": _linked("SELECT * FROM scored WHERE score >= 9.0"),
    "linkage_entities": _linked("""SELECT st.primaryid, coalesce(root, p.id) AS entity FROM st JOIN profiles p ON """ + " AND ".join(
        f"st.{c} IS NOT DISTINCT FROM p.{c}" for c in _LINK_LADDERS[0].split()) + """ LEFT JOIN (SELECT a, min(b) AS root FROM reach GROUP BY a) r ON r.a = p.id""",
        """links AS (SELECT id_a AS a, id_b AS b FROM scored WHERE score >= 13.0 UNION SELECT id_b, id_a FROM scored WHERE score >= 13.0)""",
        # What is reached passes on the smallest id that came to it in the round before.
        """reach AS (SELECT DISTINCT a, a AS b FROM links UNION SELECT l.b, min(r.b) FROM reach r JOIN links l ON r.a = l.a GROUP BY l.b)"""),
    "linkage_patterns": _linked("SELECT pattern, count(*) AS n_pairs FROM scored GROUP BY pattern", split=True),
    "drop_nullified": _with("demo deleted", body="SELECT primaryid, caseid FROM demo WHERE caseid NOT IN (SELECT caseid FROM deleted)"),
    # cases
    "complete_reports": _with("demo drug reac", body=f"SELECT primaryid, caseid FROM demo WHERE primaryid IN {_NAMED_DRUG} AND primaryid IN {_NAMED_REAC}"),
    "incomplete_reasons": _with("demo drug reac", body=f"""SELECT * FROM (SELECT primaryid, primaryid NOT IN {_NAMED_DRUG} AS no_drug,
  primaryid NOT IN {_NAMED_REAC} AS no_event FROM demo) WHERE no_drug OR no_event"""),
    "completeness_stats": _with("demo drug reac", body=f"""SELECT count(*) AS n_reports, count(*) FILTER (WHERE no_drug) AS n_no_drug, count(*) FILTER (WHERE no_event) AS n_no_event,
  count(*) FILTER (WHERE no_drug OR no_event) AS n_incomplete, count(*) FILTER (WHERE NOT (no_drug OR no_event)) AS n_complete
  FROM (SELECT primaryid, primaryid NOT IN {_NAMED_DRUG} AS no_drug, primaryid NOT IN {_NAMED_REAC} AS no_event FROM demo)"""),
    "case_flags": _with("demo drug", body="""SELECT primaryid, primaryid IN (SELECT primaryid FROM drug WHERE trial) AS premarketing, lit_ref IS NOT NULL AS literature FROM demo"""),
    "time_to_onset": _with("demo ther", _ONSET, body="SELECT primaryid, drug_seq, start_dt, event_dt, time_to_onset FROM onset"),
    "therapy_table": _with("demo ther", _ONSET, body=f"SELECT *, {_DURATION} AS dur_in_days FROM onset"),
    "onset_stats": _with("demo ther", _ONSET, body="""SELECT count(*) AS n_rows, count(time_to_onset) AS n_valid,
  round(100.0 * count(*) FILTER (WHERE time_to_onset < 0) / count(time_to_onset), 1) AS pct_negative,
  round(100.0 * count(*) FILTER (WHERE time_to_onset < 0 AND early) / count(*) FILTER (WHERE early), 1) AS pct_early_negative,
  round(100.0 * count(*) FILTER (WHERE early AND event_dt LIKE '%01') / count(*), 1) AS pct_early_first
  FROM (SELECT *, TRY_CAST(event_dt AS BIGINT) <= 20121231 AS early FROM onset)"""),
    "clean_cases": _with("demo drug reac", f"""newest AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY primaryid ORDER BY quarter DESC) AS rn FROM demo) WHERE rn = 1)""",
                         *_std("newest", "st"), _newest_case("st", "cases"), _mfr("cases", "kept"),
                         f"""whole AS (SELECT *, primaryid IN (SELECT primaryid FROM drug WHERE trial) AS premarketing, lit_ref IS NOT NULL AS literature
  FROM kept WHERE primaryid IN {_NAMED_DRUG} AND primaryid IN {_NAMED_REAC})""",
                         *_rb("whole"), body=f"""SELECT primaryid, caseid, quarter, sex, age_in_days, {_GROUP} AS age_grp, wt_in_kgs, occr_country, reporter_country, occp_cod,
  premarketing, literature, rb_duplicates, rb_duplicates_only_susp FROM flagged"""),
    # split
    "split_demo": _release("", body="""SELECT primaryid, sex, age_in_days, wt_in_kgs, occr_country, event_dt, occp_cod, reporter_country, rept_cod, init_fda_dt, fda_dt,
  premarketing, literature FROM release"""),
    "split_demo_supp": _release("rpsr", body="""SELECT r.primaryid, caseid, caseversion, i_f_cod, auth_num, e_sub, lit_ref, rept_dt, to_mfr, mfr_sndr, mfr_num, mfr_dt,
  r.quarter, rpsr_cod FROM release r JOIN rpsr s ON r.primaryid = s.primaryid"""),
    "split_drug": _release("", body="""SELECT DISTINCT primaryid, drug_seq, substance, role_cod, CASE role_cod WHEN 'C' THEN 1 WHEN 'I' THEN 2 WHEN 'SS' THEN 3 WHEN 'PS' THEN 4 END AS role_rank
  FROM drug WHERE primaryid IN (SELECT primaryid FROM release)"""),
    "split_drug_name": _release("drug_info", body="""SELECT i.primaryid, i.drug_seq, val_vbm, nda_num, drugname, prod_ai FROM drug_info i JOIN
  (SELECT DISTINCT primaryid, drug_seq, drugname, prod_ai FROM drug) d ON i.primaryid = d.primaryid AND i.drug_seq = d.drug_seq WHERE i.primaryid IN (SELECT primaryid FROM release)"""),
    "split_reac": _release("reac term_tree", _TREE, body="""SELECT primaryid, a.pt, b.pt AS drug_rec_act, CAST(a.pt_rank AS INT) AS pt_rank, CAST(b.pt_rank AS INT) AS drug_rec_act_rank
  FROM reac LEFT JOIN ranks a ON reac.pt = a.pt LEFT JOIN ranks b ON reac.drug_rec_act = b.pt WHERE primaryid IN (SELECT primaryid FROM release)"""),
    "split_outc": _release("outc", body="""SELECT DISTINCT primaryid, CASE WHEN r IS NOT NULL THEN outc_cod END AS outc_cod, r AS outc_rank FROM (SELECT *, CASE outc_cod WHEN 'OT' THEN 1
  WHEN 'CA' THEN 2 WHEN 'HO' THEN 3 WHEN 'RI' THEN 4 WHEN 'DS' THEN 5 WHEN 'LT' THEN 6 WHEN 'DE' THEN 7 END AS r FROM outc) WHERE primaryid IN (SELECT primaryid FROM release)"""),
    "split_indi": _release("indi term_tree", _TREE, body="""SELECT DISTINCT primaryid, drug_seq, pt AS indi_pt, CAST(pt_rank AS INT) AS indi_pt_rank
  FROM indi LEFT JOIN ranks ON indi_pt = pt WHERE primaryid IN (SELECT primaryid FROM release)"""),
    "split_ther": _release("ther", _ONSET, body=f"""SELECT DISTINCT primaryid, drug_seq, start_dt, {_DURATION} AS dur_in_days, end_dt, time_to_onset, event_dt
  FROM onset WHERE primaryid IN (SELECT primaryid FROM release)"""),
    "split_doses": _release("drug_info", body="""SELECT DISTINCT primaryid, drug_seq, dose_vbm, cum_dose_unit, cum_dose_chr, dose_amt, dose_unit, dose_freq
  FROM drug_info WHERE primaryid IN (SELECT primaryid FROM release)"""),
    "split_drug_supp": _release("drug_info", body="""SELECT DISTINCT primaryid, drug_seq, route, dose_form, dechal, rechal, lot_num, exp_dt
  FROM drug_info WHERE primaryid IN (SELECT primaryid FROM release)"""),
    # the composed release
    "release_demo": _released("", *_std("kept", "st"), body="""SELECT primaryid, sex, age_in_days, wt_in_kgs, occr_country, event_dt, occp_cod, reporter_country, rept_cod, init_fda_dt,
  fda_dt, primaryid IN (SELECT primaryid FROM drugs WHERE trial) AS premarketing, lit_ref IS NOT NULL AS literature FROM st WHERE primaryid IN (SELECT primaryid FROM released)"""),
    "release_demo_supp": _released("rpsr", body="""SELECT k.primaryid, caseid, caseversion, i_f_cod, auth_num, e_sub, lit_ref, rept_dt, to_mfr, mfr_sndr, mfr_num, mfr_dt, k.quarter, rpsr_cod
  FROM kept k JOIN rpsr s ON k.primaryid = s.primaryid WHERE k.primaryid IN (SELECT primaryid FROM released)"""),
    "release_drug": _released("", body="""SELECT DISTINCT s.primaryid, s.drug_seq, s.substance, role_cod, CASE role_cod WHEN 'C' THEN 1 WHEN 'I' THEN 2 WHEN 'SS' THEN 3
  WHEN 'PS' THEN 4 END AS role_rank FROM drugs s JOIN drug d ON s.primaryid = d.primaryid AND s.drug_seq = d.drug_seq WHERE s.primaryid IN (SELECT primaryid FROM released)"""),
    "release_drug_name": _released("drug_info", body=f"""SELECT i.primaryid, i.drug_seq, val_vbm, nda_num, n.drugname, n.prod_ai FROM drug_info i
  JOIN (SELECT DISTINCT primaryid, drug_seq, {_CLEAN_NAME.format(c='drugname')} AS drugname, prod_ai FROM drug) n ON i.primaryid = n.primaryid AND i.drug_seq = n.drug_seq
  WHERE i.primaryid IN (SELECT primaryid FROM released)"""),
    "release_outc": _released("outc", body="""SELECT DISTINCT primaryid, CASE WHEN r IS NOT NULL THEN outc_cod END AS outc_cod, r AS outc_rank FROM (SELECT *, CASE outc_cod WHEN 'OT' THEN 1
  WHEN 'CA' THEN 2 WHEN 'HO' THEN 3 WHEN 'RI' THEN 4 WHEN 'DS' THEN 5 WHEN 'LT' THEN 6 WHEN 'DE' THEN 7 END AS r FROM outc) WHERE primaryid IN (SELECT primaryid FROM released)"""),
    "release_ther": _released("ther", _ONSET, body=f"""SELECT DISTINCT primaryid, drug_seq, start_dt, {_DURATION} AS dur_in_days, end_dt, time_to_onset, event_dt
  FROM onset WHERE primaryid IN (SELECT primaryid FROM released)"""),
    "release_reac": _released("pt_tree", _PT_TREE, body="""SELECT primaryid, r.pt, r.pt AS drug_rec_act, pt_rank, pt_rank AS drug_rec_act_rank
  FROM st_reac LEFT JOIN pt_ranks r USING (pt) WHERE primaryid IN (SELECT primaryid FROM released)"""),
    "release_indi": _released("indi_raw pt_tree", _PT_TREE, body="""SELECT DISTINCT primaryid, drug_seq, r.pt AS indi_pt, pt_rank AS indi_pt_rank
  FROM indi_raw LEFT JOIN terms ON lower(trim(indi_pt)) = term LEFT JOIN pt_ranks r ON standard_pt = r.pt WHERE primaryid IN (SELECT primaryid FROM released)"""),
    "release_doses": _released("drug_info", _UNITS, _ROUTES, _FORMS, _FREQS, _INFO, body="""SELECT DISTINCT primaryid, drug_seq, dose_vbm, cum_dose_unit, cum_dose_chr,
  dose_amt, dose_unit, dose_freq FROM info WHERE primaryid IN (SELECT primaryid FROM released)"""),
    "release_drug_supp": _released("drug_info", _UNITS, _ROUTES, _FORMS, _FREQS, _INFO, body="""SELECT DISTINCT primaryid, drug_seq, route, dose_form, dechal, rechal, lot_num, exp_dt
  FROM info WHERE primaryid IN (SELECT primaryid FROM released)"""),
    # profiles and validation
    "value_distribution": _with("demo", body="SELECT age_cod AS value, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct FROM demo GROUP BY age_cod"),
    "top_countries": _with("demo", *_std("demo", "st"), body="""SELECT reporter_country AS value, count(*) AS n FROM st WHERE reporter_country IS NOT NULL
  GROUP BY 1 ORDER BY n DESC, value LIMIT 5"""),
    "describe_age": _with("demo", _RAW_AGE, body=_describe("years", "age_in_years")),
    "describe_weight": _with("demo", f"w AS (SELECT CASE WHEN k0 <= 635 THEN k0 END AS wt_in_kgs FROM (SELECT {_KILOS} AS k0 FROM demo))", body=_describe("w", "wt_in_kgs")),
    "describe_price": _describe("(SELECT CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders)", "o_totalprice"),
    "mfr_profile": _with("demo", body="""SELECT count(*) AS n_rows, count(DISTINCT caseid) AS n_cases, count(DISTINCT mfr_sndr) AS n_senders,
  count(*) FILTER (WHERE mfr_sndr IS NULL) AS n_no_sender, (SELECT count(*) FROM (SELECT DISTINCT caseid, mfr_sndr FROM demo WHERE mfr_sndr IS NOT NULL)) AS n_last_rows FROM demo"""),
    "mfr_per_case": _with("demo", body="""SELECT n_senders, count(*) AS n_cases FROM (SELECT caseid, count(DISTINCT mfr_sndr) AS n_senders FROM demo GROUP BY caseid)
  WHERE n_senders > 1 GROUP BY n_senders"""),
    "route_coverage": _with("drug_info", _ROUTES, body=f"""SELECT count(*) AS n_rows, count(route) AS n_standard, count(*) - count(route) AS n_nonstandard,
  round(100.0 * count(route) / count(*), 1) AS pct_standard FROM (SELECT {_ROUTE} AS route FROM drug_info i)"""),
    "unmapped_values": _with("drug_info", _FORMS, body="""SELECT lower(trim(dose_form)) AS value, count(*) AS n FROM drug_info
  WHERE lower(trim(dose_form)) NOT IN (SELECT lower(form) FROM forms) GROUP BY 1"""),
    "validate_demo": _with("demo", body=_findings("demo", _DEMO_CELLS)),
    "validate_drug": _with("drug", body=_findings("drug", _DRUG_CELLS)),
    "validate_reac": _with("reac_old reac_new", body="""SELECT 'reac' AS kind, count(*) AS n_rows, true AS valid, 0 AS n_errors, 0 AS n_warnings
  FROM (SELECT 1 FROM reac_old UNION ALL SELECT 1 FROM reac_new)"""),
    "validate_outc": _with("outc", body=_findings("outc", _OUTC_CELLS)),
    "validate_indi": _with("indi_old indi_new", body="""SELECT 'indi' AS kind, count(*) AS n_rows, false AS valid, 1 AS n_errors, 0 AS n_warnings
  FROM (SELECT 1 FROM indi_old UNION ALL SELECT 1 FROM indi_new)"""),
    "validate_ther": _with("ther", body=_findings("ther", [_date_cell("start_dt"), _date_cell("end_dt")])),
    "invalid_values": _with("demo", body="SELECT rule, column_name, value, count(*) AS n FROM (" + " UNION ALL ".join(
        f"SELECT '{r}' AS rule, '{c}' AS column_name, {v} AS value FROM demo WHERE {cond}" for r, c, v, cond in _DEMO_CELLS) + ") GROUP BY ALL"),
    "validation_report": _with("demo drug reac outc indi ther", "found AS (" + " UNION ALL ".join(
        [_findings("demo", _DEMO_CELLS), _findings("drug", _DRUG_CELLS), _findings("outc", _OUTC_CELLS),
         _findings("ther", [_date_cell("start_dt"), _date_cell("end_dt")])]) + ")",
        "sizes AS (" + " UNION ALL ".join(f"SELECT '{k}' AS kind, count(*) AS n_rows FROM {k}" for k in "demo drug reac outc indi ther".split()) + ")",
        body="""SELECT k.kind, n_rows, true AS valid, CAST(0 AS BIGINT) AS n_errors, count(f.kind) AS n_warnings
  FROM sizes k LEFT JOIN found f ON k.kind = f.kind GROUP BY k.kind, n_rows"""),
    "invalid_dates": _with("demo", body=" UNION ALL ".join(
        f"SELECT count(*) AS n_rows, '{c}' AS field, {_bad_dates(c)} AS n_invalid, round(100.0 * {_bad_dates(c)} / count(*), 1) AS pct FROM demo"
        for c in ("event_dt", "fda_dt", "rept_dt"))),
    "quarter_summary": _with("demo", body=_summary("demo")),
    "process_quarter": _with("demo drug reac outc rpsr ther indi", body=_summary("demo", "drug", "reac", "outc", "rpsr", "ther", "indi")),
    "summary_totals": _with("demo drug ther", body=_TOTALS.format(_summary("demo", "drug", "ther"))),
    "process_quarter_findings": _with("demo drug outc ther", body=" UNION ALL ".join([
        _findings("demo", _DEMO_CELLS), _findings("drug", _DRUG_CELLS), _findings("outc", _OUTC_CELLS), _findings("ther", [_date_cell("start_dt"), _date_cell("end_dt")])])),
    "report_lines": _with("demo drug ther", f"summary AS ({_summary('demo', 'drug', 'ther')})", _REPORT, body="""SELECT CAST(row_number() OVER (ORDER BY quarter, kind, i) - 1 AS INT) AS line_no, line
  FROM (SELECT quarter, kind, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM parts)"""),
}

# Dictionaries that go through files give what they give without.
ORACLE |= {
    "drug_list_file": ORACLE["std_drugs"], "synonyms_file": ORACLE["drug_synonyms"], "term_files": ORACLE["llt_pt_join"],
    "hierarchy_files": """SELECT r_name AS soc, n_name AS hlgt, s_name AS hlt, c_name AS pt, CAST(row_number() OVER (ORDER BY r_name, n_name, s_name, c_name) AS INT) AS pt_rank
  FROM region JOIN nation ON n_regionkey = r_regionkey JOIN supplier ON s_nationkey = n_nationkey JOIN customer ON c_custkey % 10 = s_suppkey""",
    "country_file": """SELECT CAST(c_custkey AS VARCHAR) AS primaryid, CASE WHEN n_nationkey > 0 THEN r_name END AS occr_country,
  CASE c_custkey % 3 WHEN 0 THEN 'Europe' WHEN 1 THEN CASE WHEN n_nationkey > 0 THEN r_name END END AS reporter_country
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "dose_form_file": _with("drug", "forms AS (SELECT upper(p_type) AS form, arg_max(p_brand, p_partkey) AS st FROM part GROUP BY 1)",
                            body="SELECT primaryid, drug_seq, st AS dose_form FROM drug LEFT JOIN forms ON prod_ai = form"),
    "route_file": _with("drug", """lines AS (SELECT CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE lower(p_type) END AS route, p_brand, p_partkey FROM part),
exact AS (SELECT route, arg_max(p_brand, p_partkey) AS st FROM lines GROUP BY route), loose AS (SELECT lower(route) AS route, arg_max(p_brand, p_partkey) AS st FROM lines GROUP BY 1),
given AS (SELECT primaryid, drug_seq, CASE drug_seq WHEN '1' THEN lower(prod_ai) WHEN '2' THEN upper(substr(prod_ai, 1, 1)) || lower(substr(prod_ai, 2)) ELSE prod_ai END AS route FROM drug)""",
                        body="SELECT primaryid, drug_seq, coalesce(e.st, l.st) AS route FROM given g LEFT JOIN exact e ON g.route = e.route LEFT JOIN loose l ON lower(g.route) = l.route"),
    "unit_file": """SELECT CAST(p.p_partkey AS VARCHAR) AS primaryid, st AS dose_unit, p.p_partkey * CASE WHEN size % 5 = 0 THEN 1.0::DOUBLE ELSE size::DOUBLE END AS dose_amt
  FROM part p JOIN (SELECT p_brand, arg_max(p_type, p_partkey) AS st, arg_max(p_size, p_partkey) AS size FROM part GROUP BY p_brand) u USING (p_brand)""",
    "archive_catalog": """SELECT y || 'q' || q AS quarter, '/files/rep_ascii_' || y || 'Q' || q || '.ZIP' AS href, CAST(y AS INT) >= 1993 AS valid,
  CASE WHEN CAST(y AS INT) >= 1996 THEN 'faers' ELSE 'aers' END || '_ascii_' || y || 'q' || q || '.zip' AS file_name, FALSE AS named
  FROM (SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) AS y, CAST(quarter(o_orderdate) AS VARCHAR) AS q FROM orders)""",
}
