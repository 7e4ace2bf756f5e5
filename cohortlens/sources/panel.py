"""Survey-shaped panel derived from the driver's star-schema tables.

One respondent per order, every order, the order years mapped onto the five survey years;
the answer columns are deterministic functions of order / customer / nation / part
attributes (see FIXTURES.md, F4), so the panel grows with the tables and every query's work
grows with it.  The used answers list the parts of all lines of the order, the wanted
answers the parts numbered as the lines' suppliers.

Plan shape: lineitem x part (narrow projections, AQE picks broadcast or sort-merge)
-> per-order answer lists (lines are dealt by order as they are and collected there: a list is
larger than its lines) -> joined by sort-merge to orders x customer x nation, so that the panel
comes dealt by respondent and is written in buckets without another shuffle.  Every scan is
pruned to the columns used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Answer labels as they appear in the survey files.
AGE_LABELS = ("18-24 years old", "25-34 years old", "35-44 years old")
REMOTE_LABELS = (
    "Remote",
    "Hybrid (some remote, some in-person)",
    "In-person",
    "Your choice (very flexible, work wherever you want)",
    "Prefer not to say",
)
ED_LABELS = (
    "Primary/elementary school",
    "Secondary school",
    "Associate degree (A.A., A.S., etc.)",
    "Bachelor's degree (B.A., B.S., B.Eng., etc.)",
    "Master's degree (M.A., M.S., M.Eng., MBA, etc.)",
    "Doctor of Philosophy (Ph.D.)",
    "Some college/university study without earning a degree",
    "Unlisted level",
    "Professional degree (JD, MD, etc.)",
    "Something else",
)
EMPLOYMENT_LABELS = (
    "Student, full-time",
    "Employed, part-time",
    "Independent contractor, freelancer, or self-employed",
    "Not employed, but looking for work",
    "I prefer not to say",
    "Employed",
    "Retired",
)
ORG_LABELS = (
    "Just me - I am a freelancer, sole proprietor, etc.",
    "Just me - I am a freelancer, sole proprietor, etc",
    "2 to 9 employees",
    "10 to 19 employees",
    "20 to 99 employees",
    "100 to 499 employees",
    "1,000 to 4,999 employees",
    "10,000 or more employees",
    "Some made-up size",
    "500 to 999 employees",
    "5,000 to 9,999 employees",
)
BRANCH_LABELS = ("I am a developer by profession", "I code primarily as a hobby", "I am learning to code")
CURRENCY_LABELS = ("USD\tUnited States dollar", "EUR\tEuropean Euro", "GBP\tPound sterling")
FREQUENCY_LABELS = ("Yearly", "Monthly", "Weekly")
#: The first 19 are the cells that a survey file's reader takes for missing.
INDUSTRY_LABELS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null", "Banking", "Software", "Retail, wholesale")
AI_LABELS = ("Yes", "No, and I don't plan to", "No, but I plan to soon")

TABLES = ("orders", "customer", "nation", "lineitem", "part")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(index: Column, labels: tuple[str, ...]) -> Column:
    """labels[index] for 0 <= index < len(labels), else NULL."""
    expr = None
    for i, label in enumerate(labels):
        expr = F.when(index == i, F.lit(label)) if expr is None else expr.when(index == i, F.lit(label))
    return expr


def _joined_list(values: Column, sep: str) -> Column:
    return F.array_join(F.sort_array(F.collect_set(values)), sep)


def survey_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``responses`` table (27 canonical columns) built from the driver tables, dealt by
    ``response_id`` as Spark deals a join."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    wanted = part.select(F.col("p_partkey").alias("w_partkey"), F.col("p_name").alias("w_name"),
                         F.col("p_brand").alias("w_brand"))
    answer_lists = (
        lines.join(part, lines.l_partkey == part.p_partkey)
        .join(wanted, lines.l_suppkey == wanted.w_partkey, "left")
        .select("l_orderkey", "p_name", "p_brand", "w_name", "w_brand")
        .repartition("l_orderkey")
        .groupBy("l_orderkey")
        .agg(
            _joined_list(F.col("p_name"), "; ").alias("lang_worked"),
            _joined_list(F.col("w_name"), ";").alias("lang_want"),
            _joined_list(F.col("p_brand"), ";").alias("db_worked"),
            _joined_list(F.col("w_brand"), ";").alias("db_want"),
        )
    )

    base = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, F.col("c_nationkey") == nation.n_nationkey)
        .join(answer_lists.hint("merge"), F.col("o_orderkey") == answer_lists.l_orderkey, "left")
    )

    okey, ckey = F.col("o_orderkey"), F.col("o_custkey")
    h = okey * 7 + ckey
    year = (F.pmod(F.year("o_orderdate"), F.lit(5)) + 2021).cast("int")
    price = F.col("o_totalprice")
    dev_type = (
        F.when(h % 11 == 0, F.lit(None).cast("string"))
        .when(h % 13 == 0, F.lit(""))
        .when(h % 3 == 0, F.concat(F.col("c_mktsegment"), F.lit(";"), F.col("o_orderpriority")))
        .otherwise(F.col("c_mktsegment"))
    )
    null_s = F.lit(None).cast("string")
    null_d = F.lit(None).cast("double")
    cols = {
        "survey_year": year,
        "response_id": okey,
        "main_branch": _pick(ckey % 4, BRANCH_LABELS),
        # "employed" is not the answer "Employed": labels of that rule are compared as they are written
        "employment": F.when(h % 11 >= 8, F.lit("Employed, full-time")).when(h % 22 == 4, F.lit("employed")).otherwise(
            _pick(h % 11, EMPLOYMENT_LABELS)),
        "country": F.when(h % 37 == 0, null_s).otherwise(F.col("n_name")),
        "ed_level": _pick(ckey % 11, ED_LABELS),
        "age": _pick(h % 4, AGE_LABELS),
        "years_code": (ckey % 45).cast("double"),
        "years_code_pro": F.when((year == 2025) | (h % 10 == 0), null_d)
        .when(h % 97 == 1, F.lit(-1.0))
        .otherwise((ckey % 60).cast("double")),
        "work_exp": F.when(year == 2021, null_d).otherwise((okey % 56).cast("double")),
        "dev_type": dev_type,
        "org_size": _pick(ckey % 13, ORG_LABELS),
        "currency": _pick(h % 4, CURRENCY_LABELS),
        "comp_total": F.when(h % 8 != 0, price * 3),
        "comp_freq": F.when(year <= 2022, _pick(okey % 4, FREQUENCY_LABELS)),
        "salary_usd_yearly": F.when(h % 9 == 0, null_d).when(h % 50 == 1, price / 1000).otherwise(price * 2.5),
        "remote_work": F.when(year == 2021, null_s).otherwise(_pick(okey % 6, REMOTE_LABELS)),
        "industry": F.when(year >= 2023, _pick(h % 23, INDUSTRY_LABELS)),
        "ai_select": F.when(year < 2023, null_s).otherwise(_pick(ckey % 4, AI_LABELS)),
        "lang_worked": F.col("lang_worked"),
        "lang_want": F.col("lang_want"),
        "lang_admired": F.when(year >= 2024, F.col("lang_want")),
        "db_worked": F.col("db_worked"),
        "db_want": F.col("db_want"),
        "platform_worked": F.col("c_mktsegment"),
        "tools_worked": F.when(year <= 2024, F.col("o_orderpriority")),
        "dev_envs_worked": F.concat(F.col("c_mktsegment"), F.lit(";"), F.col("n_name")),
    }
    return base.select(*[expr.alias(name) for name, expr in cols.items()])
