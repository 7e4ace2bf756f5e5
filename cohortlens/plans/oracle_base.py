"""DuckDB text of the panel tables, the common prefix of every oracle.

``with_tables(body)`` lets ``body`` read ``responses``, ``responses_clean``, ``lang_exploded``
and ``db_exploded``.  Nothing is imported from the code under test: labels, rules, ranges and
file layouts are stated here once more, as tables of values.
"""

from __future__ import annotations


def quoted(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def values(rows) -> str:
    return "VALUES " + ", ".join("(" + ", ".join(
        quoted(v) if v is None or isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


# Answers as the survey spells them, by question and code.
ANSWERS = {
    "age": ["18-24 years old", "25-34 years old", "35-44 years old"],
    "remote": ["Remote", "Hybrid (some remote, some in-person)", "In-person",
               "Your choice (very flexible, work wherever you want)", "Prefer not to say"],
    "education": ["Primary/elementary school", "Secondary school", "Associate degree (A.A., A.S., etc.)",
                  "Bachelor's degree (B.A., B.S., B.Eng., etc.)", "Master's degree (M.A., M.S., M.Eng., MBA, etc.)",
                  "Doctor of Philosophy (Ph.D.)", "Some college/university study without earning a degree",
                  "Unlisted level", "Professional degree (JD, MD, etc.)", "Something else"],
    "employment": ["Student, full-time", "Employed, part-time", "Independent contractor, freelancer, or self-employed",
                   "Not employed, but looking for work", "I prefer not to say", "Employed", "Retired", None,
                   "Employed, full-time", "Employed, full-time", "Employed, full-time"],
    "size": ["Just me - I am a freelancer, sole proprietor, etc.", "Just me - I am a freelancer, sole proprietor, etc",
             "2 to 9 employees", "10 to 19 employees", "20 to 99 employees", "100 to 499 employees",
             "1,000 to 4,999 employees", "10,000 or more employees", "Some made-up size", "500 to 999 employees",
             "5,000 to 9,999 employees"],
    "ai": ["Yes", "No, and I don't plan to", "No, but I plan to soon"],
    "branch": ["I am a developer by profession", "I code primarily as a hobby", "I am learning to code"],
    "currency": ["USD\tUnited States dollar", "EUR\tEuropean Euro", "GBP\tPound sterling"],
    "frequency": ["Yearly", "Monthly", "Weekly"],
}
# Cells that a survey file's reader takes for missing.
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
           "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
ANSWERS["industry"] = [*MISSING, "Banking", "Software", "Retail, wholesale"]

# Fixed values: (question, place in the rule order, words that must occur, word that must not, category); % is any text,
# = the exact answer that follows, capitals included.
RULES = [
    ("remote", 1, "%remote%", "%hybrid%", "Remote"), ("remote", 2, "%hybrid%", "", "Hybrid"),
    ("remote", 2, "%your choice%", "", "Hybrid"), ("remote", 2, "%flexible%", "", "Hybrid"),
    ("remote", 3, "%person%", "%hybrid%", "In-person"),
    ("education", 1, "%primary%", "", "No formal degree"), ("education", 1, "%secondary%", "", "No formal degree"),
    ("education", 1, "something else", "", "No formal degree"), ("education", 2, "%associate%", "", "Associate degree"),
    ("education", 3, "%bachelor%", "", "Bachelor's degree"), ("education", 4, "%master%", "", "Master's degree"),
    ("education", 5, "%doctor%", "", "PhD or higher"), ("education", 5, "%phd%", "", "PhD or higher"),
    ("education", 6, "%professional%", "", "Professional degree"), ("education", 7, "%some college%", "", "Some college"),
    ("education", 7, "%without earning%", "", "Some college"),
    ("employment", 1, "%student%", "", "Student"), ("employment", 2, "%full-time%", "", "Employed FT"),
    ("employment", 2, "%full time%", "", "Employed FT"), ("employment", 2, "=Employed", "", "Employed FT"),
    ("employment", 3, "%part-time%", "", "Employed PT"), ("employment", 3, "%part time%", "", "Employed PT"),
    ("employment", 4, "%self-employed%", "", "Self-employed"), ("employment", 4, "%freelance%", "", "Self-employed"),
    ("employment", 4, "%contractor%", "", "Self-employed"), ("employment", 4, "%independent%", "", "Self-employed"),
    ("employment", 5, "%not employed%", "", "Not employed"), ("employment", 5, "%retired%", "", "Not employed"),
    ("ai", 1, "%yes%", "", "yes"), ("ai", 2, "%no%", "", "no"),
]
# Experience brackets (from, below, name, place), and organisation sizes by place.
BRACKETS = [(-1e300, 2, "0-1 yrs", 1), (2, 5, "2-4 yrs", 2), (5, 10, "5-9 yrs", 3), (10, 20, "10-19 yrs", 4),
            (20, 50.0000001, "20+ yrs", 5)]
SIZES = [(1, "Just me - I am a freelancer, sole proprietor, etc."), (1, "Just me - I am a freelancer, sole proprietor, etc"),
         (2, "2 to 9 employees"), (3, "10 to 19 employees"), (4, "20 to 99 employees"), (5, "100 to 499 employees"),
         (6, "500 to 999 employees"), (7, "1,000 to 4,999 employees"), (8, "5,000 to 9,999 employees"),
         (9, "10,000 or more employees")]


def _answer(question: str, code: str) -> str:
    """The answer with this code; NULL beyond the last."""
    return f"list_extract([{', '.join(map(quoted, ANSWERS[question]))}], CAST({code} AS INTEGER) + 1)"


def _told(question: str, column: str) -> str:
    return (f"SELECT '{question}' AS question, {column} AS raw FROM responses WHERE {column} IS NOT NULL "
            f"GROUP BY {column}")


PANEL_CTES = f"""
order_part AS (
    SELECT l_orderkey AS id, used.p_name AS name, used.p_brand AS brand, wished.p_name AS wish, wished.p_brand AS wish_brand
    FROM lineitem JOIN part AS used ON used.p_partkey = l_partkey LEFT JOIN part AS wished ON wished.p_partkey = l_suppkey
),
order_lists AS MATERIALIZED (
    SELECT id, array_to_string(list_sort(list_distinct(list(name))), '; ') AS names,
           array_to_string(list_sort(list_distinct(list(wish))), ';') AS wishes,
           array_to_string(list_sort(list_distinct(list(brand))), ';') AS brands,
           array_to_string(list_sort(list_distinct(list(wish_brand))), ';') AS wish_brands
    FROM order_part GROUP BY id
),
person AS MATERIALIZED (
    SELECT o_orderkey AS id, o_custkey AS who, o_orderkey * 7 + o_custkey AS mix, o_totalprice AS price,
           o_orderpriority AS priority, c_mktsegment AS segment, n_name AS land,
           CAST(2021 + (year(o_orderdate) - 1995) % 5 AS INTEGER) AS y, names, wishes, brands, wish_brands
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN order_lists ON order_lists.id = o_orderkey
),
responses AS MATERIALIZED (
    SELECT y AS survey_year, id AS response_id, {_answer('branch', 'who % 4')} AS main_branch,
        if(mix % 22 = 4, 'employed', {_answer('employment', 'mix % 11')}) AS employment, if(mix % 37 = 0, NULL, land) AS country,
        {_answer('education', 'who % 11')} AS ed_level, {_answer('age', 'mix % 4')} AS age,
        CAST(who % 45 AS DOUBLE) AS years_code,
        if(y = 2025 OR mix % 10 = 0, NULL, if(mix % 97 = 1, -1, CAST(who % 60 AS DOUBLE))) AS years_code_pro,
        if(y = 2021, NULL, CAST(id % 56 AS DOUBLE)) AS work_exp,
        if(mix % 11 = 0, NULL, if(mix % 13 = 0, '', segment || if(mix % 3 = 0, ';' || priority, ''))) AS dev_type,
        {_answer('size', 'who % 13')} AS org_size, {_answer('currency', 'mix % 4')} AS currency,
        if(mix % 8 = 0, NULL, price * 3) AS comp_total,
        if(y > 2022, NULL, {_answer('frequency', 'id % 4')}) AS comp_freq,
        if(mix % 9 = 0, NULL, if(mix % 50 = 1, price / 1000, price * 2.5)) AS salary_usd_yearly,
        if(y = 2021, NULL, {_answer('remote', 'id % 6')}) AS remote_work,
        if(y < 2023, NULL, {_answer('industry', 'mix % 23')}) AS industry,
        if(y < 2023, NULL, {_answer('ai', 'who % 4')}) AS ai_select,
        names AS lang_worked, wishes AS lang_want, if(y < 2024, NULL, wishes) AS lang_admired,
        brands AS db_worked, wish_brands AS db_want, segment AS platform_worked,
        if(y > 2024, NULL, priority) AS tools_worked, segment || ';' || land AS dev_envs_worked
    FROM person
),
rule(question, place, needs, bars, category) AS ({values(RULES)}),
bracket(low, high, name, place) AS ({values(BRACKETS)}),
size_place(place, name) AS ({values(SIZES)}),
told AS (
    SELECT t.question, raw, arg_min(category, place) AS category
    FROM ({_told('remote', 'remote_work')} UNION ALL {_told('education', 'ed_level')}
          UNION ALL {_told('employment', 'employment')} UNION ALL {_told('ai', 'ai_select')}) t
    JOIN rule ON rule.question = t.question AND if(starts_with(needs, '='), raw = needs[2:], lower(raw) LIKE needs) AND NOT lower(raw) LIKE bars
    GROUP BY t.question, raw
),
responses_clean AS MATERIALIZED (
    SELECT response_id, survey_year, country, age,
        if(salary_usd_yearly >= 1000 AND salary_usd_yearly <= 1000000, salary_usd_yearly, NULL) AS salary_usd_yearly_clean,
        if(years >= 0 AND years <= 50, years, NULL) AS experience_years, bracket.name AS exp_bracket,
        r.category AS remote_work_clean, e.category AS ed_level_clean, coalesce(j.category, 'Other') AS employment_clean,
        string_split(dev_type, ';')[1] AS dev_type_primary, size_place.place AS org_size_order,
        if(survey_year < 2023, NULL, a.category = 'yes') AS ai_user,
        lang_worked, lang_want, lang_admired, db_worked, db_want, platform_worked, tools_worked, dev_envs_worked,
        dev_type, ed_level, employment, remote_work, org_size, ai_select, industry, years_code, years_code_pro,
        work_exp, salary_usd_yearly, main_branch
    FROM (SELECT *, if(years_code_pro IS NULL, work_exp, years_code_pro) AS years FROM responses)
    LEFT JOIN bracket ON years >= low AND years < high
    LEFT JOIN size_place ON size_place.name = org_size
    LEFT JOIN told r ON r.question = 'remote' AND r.raw = remote_work
    LEFT JOIN told e ON e.question = 'education' AND e.raw = ed_level
    LEFT JOIN told j ON j.question = 'employment' AND j.raw = employment
    LEFT JOIN told a ON a.question = 'ai' AND a.raw = ai_select
),
lang_exploded AS (SELECT survey_year, response_id, trim(unnest(string_split(lang_worked, ';'))) AS language FROM responses),
db_exploded AS (SELECT survey_year, response_id, trim(unnest(string_split(db_worked, ';'))) AS database FROM responses)"""


def with_tables(body: str) -> str:
    """``body``: a SELECT, or further CTEs that begin with a comma."""
    body = body.strip()
    return f"WITH {PANEL_CTES}{'' if body.startswith(',') else chr(10)}{body}"
