"""DuckDB text of each job, written from the jobs' definitions in plain terms: percentiles as
weighted numbered rows, ranks by counting better rows, changes by joining a row's predecessor.
A difference that rounds to zero is stated as 0, since DuckDB would give -0.0.
"""

from __future__ import annotations

from cohortlens.plans.oracle_base import MISSING, quoted, values, with_tables

ORACLE_SQL: dict[str, str] = {}


def _state(name: str, body: str) -> None:
    ORACLE_SQL[name] = with_tables(body)


def _percentiles(name: str, source: str, keys: str, value: str, **probs: float) -> str:
    """CTE ``name``: keys, n and each percentile.  Row i of n weighs 1 - |i - (n - 1) p| (0 if less):
    that is linear interpolation between the two rows next to the wanted place."""
    cols = ", ".join(f"round(sum(v * greatest(0, 1 - abs(i - (n - 1) * {p}))), 6) AS {c}" for c, p in probs.items())
    return f""", {name}_numbered AS (
    SELECT {keys}, {value} AS v, row_number() OVER (PARTITION BY {keys} ORDER BY {value}) - 1 AS i,
           count(*) OVER (PARTITION BY {keys}) AS n FROM {source} WHERE {value} IS NOT NULL
), {name} AS (SELECT {keys}, max(n) AS n, {cols} FROM {name}_numbered GROUP BY {keys})
"""


def _ranked(name: str, source: str, by: str, within: str = "survey_year", column: str = "rank") -> str:
    """CTE ``name``: ``source`` with one more than the number of rows of the same group that have more."""
    return f""", {name} AS (
    SELECT own.*, 1 + (SELECT count(*) FROM {source} other WHERE other.{within} = own.{within}
                       AND other.{by} > own.{by}) AS {column} FROM {source} own)
"""


def _chained(name: str, source: str, key: str, **before: str) -> str:
    """CTE ``name``: ``source`` with columns of the same key's row before it in time."""
    cols = ", ".join(f"last.{c} AS {alias}" for alias, c in before.items())
    return f""", {name}_seq AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY survey_year) AS at FROM {source})
, {name} AS (SELECT own.*, {cols} FROM {name}_seq own LEFT JOIN {name}_seq last
             ON last.{key} IS NOT DISTINCT FROM own.{key} AND last.at = own.at - 1)
"""


# ------------------------------------------------------------ languages
_RATES = """, answered AS (SELECT survey_year, sum(1) AS people FROM responses_clean WHERE lang_worked IS NOT NULL GROUP BY ALL)
, users AS (SELECT survey_year, language, count(*) AS user_count
            FROM (SELECT DISTINCT survey_year, language, response_id FROM lang_exploded WHERE length(language) > 0) GROUP BY ALL)
, rate AS (SELECT survey_year, language, user_count, round(user_count * 100.0 / people, 2) AS adoption_pct
           FROM users NATURAL JOIN answered)
"""
_state("lang_trend", _RATES + _ranked("placed", "rate", "adoption_pct", column="rank_in_year") + """
, seq AS (SELECT *, row_number() OVER (PARTITION BY language ORDER BY survey_year) AS at FROM placed)
, steady AS (SELECT language FROM rate WHERE adoption_pct >= 5 GROUP BY language HAVING count(*) > 2)
SELECT c.survey_year, c.language, c.user_count, c.adoption_pct, b.adoption_pct AS prev_year_pct,
       if(round(c.adoption_pct - b.adoption_pct, 2) = 0, 0, round(c.adoption_pct - b.adoption_pct, 2)) AS yoy_change_pp, f.adoption_pct AS next_year_pct, c.rank_in_year
FROM seq c SEMI JOIN steady USING (language)
LEFT JOIN seq b ON b.language = c.language AND b.at + 1 = c.at LEFT JOIN seq f ON f.language = c.language AND f.at = c.at + 1""")
_state("lang_endpoints", _RATES + """
SELECT a.language, a.adoption_pct AS pct_2021, z.adoption_pct AS pct_2025,
       if(round(z.adoption_pct - a.adoption_pct, 2) = 0, 0, round(z.adoption_pct - a.adoption_pct, 2)) AS total_change_pp,
       ['Declining', 'Stable', 'Rising'][CAST(2 + sign(z.adoption_pct - a.adoption_pct) AS INTEGER)] AS trend_direction
FROM rate a JOIN rate z ON z.language = a.language AND a.survey_year = 2021 AND z.survey_year = 2025
WHERE greatest(a.adoption_pct, z.adoption_pct) >= 3""")
_state("lang_desire_gap", _RATES + """
, wish AS (SELECT DISTINCT survey_year, response_id, trim(unnest(string_split(lang_want, ';'))) AS language FROM responses_clean)
, wishers AS (SELECT survey_year, language, count(*) AS wants FROM wish GROUP BY ALL)
, both_sides AS (SELECT *, 100.0 * user_count / people AS u, 100.0 * wants / people AS w, 100.0 * wants / people - 100.0 * user_count / people AS gap
            FROM users NATURAL JOIN wishers NATURAL JOIN answered WHERE user_count + wants > 200)
""" + _ranked("placed", "both_sides", "gap", column="desire_gap_rank") + """
SELECT survey_year, language, round(u, 1) AS pct_use, round(w, 1) AS pct_want, if(round(gap, 1) = 0, 0, round(gap, 1)) AS desire_gap_pp,
       desire_gap_rank FROM placed""")

# ------------------------------------------------------------ cleaning
CLEAN_ALL = (
    "country", "age", "salary_usd_yearly_clean", "experience_years", "exp_bracket", "remote_work_clean", "ed_level_clean",
    "employment_clean", "dev_type_primary", "org_size_order", "ai_user", "lang_worked", "lang_want", "lang_admired",
    "db_worked", "db_want", "platform_worked", "tools_worked", "dev_envs_worked", "dev_type", "ed_level", "employment",
    "remote_work", "org_size", "ai_select", "industry", "years_code", "years_code_pro", "work_exp", "salary_usd_yearly",
    "main_branch")
RULE_COLUMNS = {
    "clean_salary": ("salary_usd_yearly_clean",), "clean_experience": ("experience_years",),
    "clean_exp_bracket": ("exp_bracket",), "clean_remote": ("remote_work_clean",), "clean_education": ("ed_level_clean",),
    "clean_employment": ("employment_clean",), "clean_dev_type": ("dev_type_primary",),
    "clean_org_size": ("org_size_order",), "clean_ai_user": ("ai_user",), "clean_view": CLEAN_ALL}
for _name, _cols in RULE_COLUMNS.items():
    _state(_name, f"SELECT response_id, survey_year, {', '.join(_cols)} FROM responses_clean")

# ------------------------------------------------------------ audits
_state("sanity_rows_per_year", "SELECT survey_year, count(response_id) AS n FROM responses GROUP BY survey_year")
_state("sanity_null_pct", """
SELECT survey_year, round(100 - 100.0 * count(salary_usd_yearly) / count(*), 1) AS pct_null FROM responses GROUP BY ALL""")
_state("clean_row_count", "SELECT count(*) AS n_rows FROM orders")
_state("v_row_reconcile", """
SELECT survey_year, count(*) AS raw_rows, count(*) FILTER (EXISTS (
    SELECT 1 FROM responses_clean c WHERE c.response_id = r.response_id AND c.survey_year = r.survey_year)) AS clean_rows
FROM responses r GROUP BY survey_year""")
_state("v_outliers", """
, had AS (SELECT survey_year, salary_usd_yearly < 1000 OR salary_usd_yearly > 1000000 AS far FROM responses
          WHERE salary_usd_yearly IS NOT NULL)
SELECT survey_year, count(*) AS raw_with_salary, count(*) FILTER (NOT far) AS clean_with_salary,
       count(*) FILTER (far) AS outliers_removed, round(avg(CAST(far AS INTEGER)) * 100, 2) AS pct_removed
FROM had GROUP BY survey_year""")


def _share(columns: str, total_by: str, where: str = "TRUE", name: str = "pct_total", more: str = "") -> str:
    """Counts by ``columns`` and their percent of the counts by ``total_by`` ('' for all)."""
    match = f"ON t.{total_by} = k.{total_by}" if total_by else "ON TRUE"
    total = f"SELECT {total_by + ', ' if total_by else ''}sum(n) AS everyone FROM kinds {'GROUP BY ' + total_by if total_by else ''}"
    return f""", kinds AS (SELECT {columns}, count(*) AS n {more} FROM responses_clean WHERE {where} GROUP BY {columns})
SELECT k.*, round(n / everyone * 100.0, 1) AS {name} FROM kinds k JOIN ({total}) t {match}"""


_state("v_remote_dist", _share("survey_year, remote_work_clean", "survey_year", "remote_work IS NOT NULL", "pct_of_year"))
_state("v_remote_unmatched", """
SELECT remote_work AS unmatched_raw_value, survey_year, sum(1)::BIGINT AS n FROM responses
WHERE remote_work NOT IN (SELECT raw FROM told WHERE question = 'remote') GROUP BY ALL""")
_state("v_education_dist", _share("ed_level_clean", ""))
_state("v_education_unmatched", """
SELECT ed_level AS unmatched_raw_value, sum(1)::BIGINT AS n FROM responses
WHERE ed_level NOT IN (SELECT raw FROM told WHERE question = 'education') GROUP BY ALL""")
_state("v_exp_dist", _share("exp_bracket", "", "exp_bracket IS NOT NULL",
                            more=", round(sum(experience_years) / count(experience_years), 1) AS avg_yrs"))
_state("v_exp_coverage", """
SELECT survey_year, count(*) FILTER (years_code_pro IS NOT NULL) AS has_years_code_pro,
       count(*) FILTER (work_exp IS NOT NULL) AS has_work_exp,
       count(*) FILTER (if(years_code_pro IS NULL, work_exp, years_code_pro) BETWEEN 0 AND 50) AS has_experience_years
FROM responses GROUP BY survey_year""")
_state("v_ai_dist", _share("survey_year, ai_user", "survey_year", name="pct_of_year"))
_state("v_employment_dist", _share("employment_clean", ""))
_state("v_other_top20", """
, other AS (SELECT employment AS raw_value, count(*) AS n FROM responses
            WHERE employment IS NULL OR employment NOT IN (SELECT raw FROM told WHERE question = 'employment') GROUP BY ALL)
SELECT * FROM other QUALIFY row_number() OVER (ORDER BY n DESC, raw_value NULLS FIRST) <= 20""")
_state("v_org_size", """
SELECT org_size AS raw_value, max(place) AS org_size_order, count(*) AS n
FROM responses LEFT JOIN size_place ON name = org_size WHERE org_size IS NOT NULL GROUP BY org_size""")



def _long(name: str, label: str, *measures: str, year: bool = False) -> str:
    """The rows of an audit's own text, one for each measure."""
    body = ORACLE_SQL[name]
    return "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS report, {'survey_year' if year else 'CAST(NULL AS INTEGER) AS survey_year'},
       CAST({label or 'NULL'} AS VARCHAR) AS label, '{m}' AS measure, CAST({m} AS DOUBLE) AS value FROM ({body})"""
        for m in measures)


ORACLE_SQL["audit_reports"] = "WITH every AS (\n" + "\nUNION ALL\n".join([
    _long("sanity_rows_per_year", "", "n", year=True), _long("sanity_null_pct", "", "pct_null", year=True),
    _long("clean_row_count", "", "n_rows"),
    _long("v_outliers", "", "raw_with_salary", "clean_with_salary", "outliers_removed", "pct_removed", year=True),
    _long("v_remote_dist", "remote_work_clean", "n", "pct_of_year", year=True),
    _long("v_remote_unmatched", "unmatched_raw_value", "n", year=True),
    _long("v_education_dist", "ed_level_clean", "n", "pct_total"),
    _long("v_education_unmatched", "unmatched_raw_value", "n"),
    _long("v_exp_dist", "exp_bracket", "n", "avg_yrs", "pct_total"),
    _long("v_exp_coverage", "", "has_years_code_pro", "has_work_exp", "has_experience_years", year=True),
    _long("v_ai_dist", "ai_user", "n", "pct_of_year", year=True),
    _long("v_employment_dist", "employment_clean", "n", "pct_total"),
    _long("v_other_top20", "raw_value", "n"), _long("v_org_size", "raw_value", "org_size_order", "n"),
]) + ") SELECT * FROM every"

# ------------------------------------------------------------ salaries
_PAID = """, paid AS (SELECT *, salary_usd_yearly_clean AS pay FROM responses_clean
                      WHERE employment_clean = 'Employed FT' AND salary_usd_yearly_clean > 0)
, role AS (SELECT *, dev_type_primary AS dev FROM paid WHERE length(dev_type_primary) > 0)
"""
_QUARTERS = {"lo": 0.25, "mid": 0.5, "hi": 0.75}
_state("salary_summary", _percentiles(
    "q", "(SELECT * FROM responses WHERE salary_usd_yearly >= 1000 AND salary_usd_yearly <= 1000000)", "survey_year",
    "salary_usd_yearly", **_QUARTERS) + """
SELECT survey_year, n AS total, n AS has_salary, round(mid) AS median_salary, round(lo) AS p25, round(hi) AS p75 FROM q""")
_state("salary_country", _PAID + _percentiles(
    "q", "(SELECT * FROM paid WHERE country IS NOT NULL)", "survey_year, country", "pay", **_QUARTERS) + """
, big AS (SELECT *, round(mid) AS m FROM q WHERE n >= 20)
""" + _ranked("placed", "big", "m") + _chained("chain", "placed", "country", before="m") + """
SELECT survey_year, country, n AS n_respondents, round(lo) AS p25, m AS median_salary, round(hi) AS p75,
       round(hi - lo) AS iqr, rank AS rank_by_median, before AS prev_year_median, if(round(m - before) = 0, 0, round(m - before)) AS yoy_median_change
FROM chain""")
_state("salary_experience", _PAID + """
, land AS (SELECT country, count(*) AS n FROM paid GROUP BY country HAVING count(*) >= 100)
, top_land AS (SELECT country FROM land QUALIFY row_number() OVER (ORDER BY n DESC, country NULLS FIRST) <= 10)
, chosen AS (SELECT * FROM paid WHERE exp_bracket IS NOT NULL AND country IN (SELECT country FROM top_land))
""" + _percentiles("q", "chosen", "survey_year, country, exp_bracket", "pay", **_QUARTERS) + """
, stage AS (SELECT q.*, round(mid) AS m, place FROM q JOIN bracket ON name = exp_bracket WHERE n >= 3)
, entry AS (SELECT survey_year, country, arg_min(m, place) AS first_m FROM stage GROUP BY ALL)
SELECT survey_year, country, exp_bracket, n, round(lo) AS p25, m AS median_salary, round(hi) AS p75,
       if(round(m - first_m) = 0, 0, round(m - first_m)) AS premium_vs_entry_level, place AS bracket_order FROM stage NATURAL JOIN entry""")
_state("salary_quartile_mix", _PAID + """
, recent AS (SELECT survey_year, dev, pay, response_id,
                    row_number() OVER (PARTITION BY survey_year ORDER BY pay, response_id) - 1 AS i,
                    count(*) OVER (PARTITION BY survey_year) AS n_year FROM role WHERE survey_year >= 2023)
, quarter AS (SELECT *, i < n_year // 4 + if(n_year % 4 > 0, 1, 0) AS bottom, i >= n_year - n_year // 4 AS top FROM recent)
, share AS (SELECT survey_year, dev, count(*) AS total_n, round(100.0 * count(*) FILTER (top) / count(*), 1) AS t,
                   round(100.0 * count(*) FILTER (bottom) / count(*), 1) AS b FROM quarter GROUP BY ALL)
""" + _percentiles("q", "recent", "survey_year, dev", "pay", mid=0.5) + """
, big AS (SELECT survey_year, dev, total_n, t, b, round(mid) AS m FROM share JOIN q USING (survey_year, dev) WHERE total_n >= 50)
""" + _ranked("placed", "big", "m") + """
SELECT survey_year, dev AS dev_type_primary, total_n, m AS median_salary, t AS pct_in_top_quartile,
       b AS pct_in_bottom_quartile, rank AS rank_by_median FROM placed""")

# ------------------------------------------------------------ remote work
_AT_WORK = """, at_work AS (SELECT survey_year, remote_work_clean AS mode, dev_type_primary AS dev FROM responses_clean
    WHERE remote_work_clean IS NOT NULL AND (employment_clean = 'Employed FT' OR employment_clean = 'Self-employed'))
"""
_state("remote_share", _AT_WORK + """
, kinds AS (SELECT survey_year, mode, count(*) AS n FROM at_work GROUP BY ALL)
, share AS (SELECT k.*, round(100.0 * n / (SELECT count(*) FROM at_work a WHERE a.survey_year = k.survey_year), 1) AS p FROM kinds k)
""" + _chained("chain", "share", "mode", before="p") + """
SELECT survey_year, mode AS remote_work_clean, n, p AS pct_of_year, before AS prev_year_pct, if(round(p - before, 1) = 0, 0, round(p - before, 1)) AS yoy_change_pp
FROM chain""")
_state("remote_salary", _PAID + _percentiles(
    "q", "(SELECT * FROM paid WHERE remote_work_clean IS NOT NULL)", "survey_year, remote_work_clean", "pay", **_QUARTERS) + """
, whole AS (SELECT *, round(mid) AS m, list_position(['In-person', 'Hybrid', 'Remote'], remote_work_clean) AS place FROM q)
, base AS (SELECT survey_year, arg_min(m, place) AS first_m FROM whole GROUP BY survey_year)
""" + _chained("chain", "whole", "remote_work_clean", before="m") + """
SELECT survey_year, remote_work_clean, n, round(lo) AS p25, m AS median_salary, round(hi) AS p75,
       if(round(m - first_m) = 0, 0, round(m - first_m)) AS gap_vs_inperson, before AS prev_year_median, if(round(m - before) = 0, 0, round(m - before)) AS yoy_salary_change
FROM chain JOIN base USING (survey_year)""")
_state("remote_by_role", _AT_WORK + """
, role AS (SELECT survey_year, dev, count(*) AS total_n, count(*) FILTER (mode = 'Remote') AS r,
                  count(*) FILTER (mode = 'Hybrid') AS h, count(*) FILTER (mode = 'In-person') AS i
           FROM at_work WHERE length(dev) > 0 GROUP BY ALL HAVING count(*) >= 120)
, share AS (SELECT *, 100.0 * r / total_n AS pr, 100.0 * h / total_n AS ph, 100.0 * i / total_n AS pi_ FROM role)
""" + _ranked("first_rank", "share", "pr", column="rank_most_remote")
       + _ranked("both_ranks", "first_rank", "pi_", column="rank_most_inperson") + """
SELECT survey_year, dev AS dev_type_primary, total_n, round(pr, 1) AS pct_remote, round(ph, 1) AS pct_hybrid,
       round(pi_, 1) AS pct_inperson, rank_most_remote, rank_most_inperson FROM both_ranks""")

# ------------------------------------------------------------ roles
_state("role_rank_change", _PAID + _percentiles("q", "role", "survey_year, dev", "pay", **_QUARTERS) + """
, big AS (SELECT *, round(mid) AS m, if(mid = 0, NULL, round((hi - lo) / mid, 2)) AS spread FROM q WHERE n >= 100)
""" + _ranked("placed", "big", "m") + _chained("chain", "placed", "dev", before="rank") + """
SELECT survey_year, dev AS dev_type_primary, n, m AS median_salary, rank AS salary_rank, before AS prev_year_rank,
       before - rank AS rank_change, spread AS iqr_over_median FROM chain""")
_state("role_spread", _PAID + _percentiles("q", "role", "survey_year, dev", "pay", mid=0.5) + """
, tenth AS (SELECT survey_year, dev, max(v) FILTER (i < n // 10 + if(n % 10 > 0, 1, 0)) AS low_end,
                   min(v) FILTER (i >= 8 * (n // 10) + least(8, n % 10)) AS high_end FROM q_numbered GROUP BY ALL)
, big AS (SELECT *, high_end / low_end AS ratio FROM q JOIN tenth USING (survey_year, dev) WHERE n >= 100)
""" + _ranked("placed", "big", "ratio") + """
SELECT survey_year, dev AS dev_type_primary, n AS total_n, low_end AS d1_ceiling, round(mid) AS median_salary,
       high_end AS d9_floor, round(ratio, 1) AS d9_d1_ratio, rank AS rank_by_spread FROM placed""")
_state("ai_salary", _PAID + """
, asked AS (SELECT * FROM role WHERE ai_user IS NOT NULL)
""" + _percentiles("q", "asked", "survey_year, dev, ai_user", "pay", mid=0.5) + """
, side AS (SELECT survey_year, dev, sum(n)::BIGINT AS total_n, coalesce(sum(n) FILTER (ai_user), 0) AS users,
                  max(round(mid)) FILTER (ai_user) AS yes, max(round(mid)) FILTER (NOT ai_user) AS no FROM q GROUP BY ALL)
, big AS (SELECT *, round(100.0 * users / total_n, 1) AS p FROM side WHERE total_n >= 80)
""" + _ranked("placed", "big", "p") + """
SELECT survey_year, dev AS dev_type_primary, total_n, p AS pct_ai_users, yes AS median_salary_ai_users,
       no AS median_salary_non_ai, if(round(yes - no) = 0, 0, round(yes - no)) AS ai_salary_premium, rank AS rank_by_ai_adoption FROM placed""")
_state("role_headcount", """
, named AS (SELECT survey_year, dev_type_primary AS dev FROM responses_clean WHERE length(dev_type_primary) > 0)
, heads AS (SELECT survey_year, dev, count(*) AS n FROM named GROUP BY ALL)
, share AS (SELECT h.survey_year, h.dev, h.n, round(100.0 * h.n / t.everyone, 2) AS p FROM heads h
            JOIN (SELECT survey_year, sum(n) AS everyone FROM heads GROUP BY ALL) t USING (survey_year) WHERE h.n >= 100)
""" + _chained("chain", "share", "dev", before="p") + """
SELECT survey_year, dev AS dev_type_primary, n, p AS pct_of_year, before AS prev_year_pct, if(round(p - before, 2) = 0, 0, round(p - before, 2)) AS yoy_share_change
FROM chain""")

# ------------------------------------------------------------ yearly files
# The files' column names by canonical column, with the first and last year each is in.
FILE_COLUMNS = [
    ("response_id", "ResponseId", 2021, 2025), ("main_branch", "MainBranch", 2021, 2025),
    ("employment", "Employment", 2021, 2025), ("country", "Country", 2021, 2025), ("ed_level", "EdLevel", 2021, 2025),
    ("age", "Age", 2021, 2025), ("years_code", "YearsCode", 2021, 2025), ("years_code_pro", "YearsCodePro", 2021, 2024),
    ("work_exp", "WorkExp", 2022, 2025), ("dev_type", "DevType", 2021, 2025), ("org_size", "OrgSize", 2021, 2025),
    ("currency", "Currency", 2021, 2025), ("comp_total", "CompTotal", 2021, 2025), ("comp_freq", "CompFreq", 2021, 2022),
    ("salary_usd_yearly", "ConvertedCompYearly", 2021, 2025), ("remote_work", "RemoteWork", 2022, 2025),
    ("industry", "Industry", 2023, 2025), ("ai_select", "AISelect", 2023, 2025),
    ("lang_worked", "LanguageHaveWorkedWith", 2021, 2025), ("lang_want", "LanguageWantToWorkWith", 2021, 2025),
    ("lang_admired", "LanguageAdmired", 2024, 2025), ("db_worked", "DatabaseHaveWorkedWith", 2021, 2025),
    ("db_want", "DatabaseWantToWorkWith", 2021, 2025), ("platform_worked", "PlatformHaveWorkedWith", 2021, 2025),
    ("tools_worked", "ToolsTechHaveWorkedWith", 2021, 2024), ("dev_envs_worked", "NEWCollabToolsHaveWorkedWith", 2021, 2024),
    ("dev_envs_worked", "DevEnvsHaveWorkedWith", 2025, 2025)]
_NUMBERS = ("years_code", "years_code_pro", "work_exp", "comp_total", "salary_usd_yearly")
_NOTE = "'Answered \"all\" questions' || chr(10) || 'second line, id ' || response_id::VARCHAR"


def _cell(column: str) -> str:
    """A column's text in the files; a missing-value token reads as NULL."""
    if column in ("years_code", "years_code_pro"):
        return f"if({column} = 0, 'Less than 1 year', if({column} > 50, 'More than 50 years', {column}::VARCHAR))"
    if column in (*_NUMBERS, "response_id"):
        return f"{column}::VARCHAR"
    return f"if(list_contains([{', '.join(map(quoted, MISSING))}], {column}), NULL, {column})"


def _read_back(column: str) -> str:
    if column in ("years_code", "years_code_pro"):
        return f"if({column} <> 0 AND {column} <= 50, {column}, NULL)"
    return column if column in _NUMBERS else _cell(column)


_CANON = list(dict.fromkeys(c for c, *_ in FILE_COLUMNS))
_INGESTED = ", ingested AS (SELECT survey_year, response_id, " + ", ".join(
    f"{_read_back(c)} AS {c}" for c in _CANON[1:]) + " FROM responses)\n"
_FILES = ", files AS MATERIALIZED (SELECT survey_year, " + ", ".join(
    f"if(survey_year BETWEEN {a} AND {z}, {_cell(c)}, NULL) AS \"{s}\"" for c, s, a, z in FILE_COLUMNS) + \
    f", {_NOTE} AS \"SurveyNotes\" FROM responses)\n"

_state("csv_roundtrip", _FILES + "SELECT * FROM files")
_state("na_tokens", _INGESTED + """
SELECT survey_year, response_id, dev_type, lang_worked, lang_want, db_worked, industry FROM ingested""")
BREAKS = ("years_code_pro", "work_exp", "comp_freq", "remote_work", "industry", "ai_select", "lang_admired", "tools_worked",
          "dev_envs_worked")
_state("harmonise_year", "SELECT survey_year, response_id::VARCHAR AS response_id, " + ", ".join(
    f"{_cell(c)} AS {c}" for c in BREAKS) + " FROM responses")
_state("union_years", _INGESTED + "SELECT * FROM ingested")
_state("coerce_numeric", _INGESTED + f"SELECT survey_year, response_id, {', '.join(_NUMBERS)} FROM ingested")
_state("explode_multival", _INGESTED + """
SELECT survey_year, response_id, trim(unnest(string_split(lang_want, ';'))) AS language_wanted FROM ingested""")
_state("lang_exploded", "SELECT * FROM lang_exploded")
_state("db_exploded", "SELECT * FROM db_exploded")
_state("write_tables", _INGESTED + """
SELECT 'responses' AS table_name, survey_year, response_id, country AS value FROM ingested
UNION ALL SELECT 'responses_clean', survey_year, response_id, employment_clean FROM responses_clean
UNION ALL SELECT 'lang_exploded', survey_year, response_id, language FROM lang_exploded
UNION ALL SELECT 'db_exploded', survey_year, response_id, database FROM db_exploded""")
_state("registered_views", """
SELECT c.survey_year, employment_clean, count(DISTINCT c.response_id) AS people, count(DISTINCT language) AS languages
FROM responses_clean c JOIN lang_exploded l ON l.response_id = c.response_id AND l.survey_year = c.survey_year GROUP BY ALL""")
_state("schema_profile", _FILES + f""", layout(column_name, first_year, last_year) AS ({values(
    [(s, a, z) for _, s, a, z in FILE_COLUMNS] + [("SurveyNotes", 2021, 2025)])})
, numbered AS (SELECT *, row_number() OVER (PARTITION BY survey_year ORDER BY "ResponseId"::DOUBLE) AS nth FROM files)
, cells AS (FROM numbered UNPIVOT INCLUDE NULLS (cell FOR column_name IN (COLUMNS(* EXCLUDE (survey_year, nth)))))
, heads AS (SELECT survey_year, column_name, count(cell) AS non_null,
                   list(cell ORDER BY nth) FILTER (nth <= 5 AND cell IS NOT NULL)[1:2] AS seen FROM cells GROUP BY ALL)
SELECT survey_year, (SELECT count(*) FROM layout l WHERE h.survey_year BETWEEN l.first_year AND l.last_year) AS n_columns,
       column_name, non_null, if(seen IS NULL OR len(seen) = 0, 'ALL NULL', array_to_string(seen, ' | ')) AS sample_values
FROM heads h JOIN layout USING (column_name) WHERE survey_year BETWEEN first_year AND last_year""")
