"""Canonical panel schema and the per-year source-column map, kept as data."""

from __future__ import annotations

from pyspark.sql import types as T

YEARS = (2021, 2022, 2023, 2024, 2025)

# ---------------------------------------------------------------------------
# Canonical column -> {survey year: source column in that year's
# file, or None when the question was not asked}.  These must equal the survey
# files' real headers, so they are stated here verbatim, in canonical order.
# ---------------------------------------------------------------------------
COLUMN_MAP: dict[str, dict[int, str | None]] = {
    "response_id": {2021: "ResponseId", 2022: "ResponseId", 2023: "ResponseId", 2024: "ResponseId", 2025: "ResponseId"},
    "main_branch": {2021: "MainBranch", 2022: "MainBranch", 2023: "MainBranch", 2024: "MainBranch", 2025: "MainBranch"},
    "employment": {2021: "Employment", 2022: "Employment", 2023: "Employment", 2024: "Employment", 2025: "Employment"},
    "country": {2021: "Country", 2022: "Country", 2023: "Country", 2024: "Country", 2025: "Country"},
    "ed_level": {2021: "EdLevel", 2022: "EdLevel", 2023: "EdLevel", 2024: "EdLevel", 2025: "EdLevel"},
    "age": {2021: "Age", 2022: "Age", 2023: "Age", 2024: "Age", 2025: "Age"},
    "years_code": {2021: "YearsCode", 2022: "YearsCode", 2023: "YearsCode", 2024: "YearsCode", 2025: "YearsCode"},
    "years_code_pro": {2021: "YearsCodePro", 2022: "YearsCodePro", 2023: "YearsCodePro", 2024: "YearsCodePro", 2025: None},
    "work_exp": {2021: None, 2022: "WorkExp", 2023: "WorkExp", 2024: "WorkExp", 2025: "WorkExp"},
    "dev_type": {2021: "DevType", 2022: "DevType", 2023: "DevType", 2024: "DevType", 2025: "DevType"},
    "org_size": {2021: "OrgSize", 2022: "OrgSize", 2023: "OrgSize", 2024: "OrgSize", 2025: "OrgSize"},
    "currency": {2021: "Currency", 2022: "Currency", 2023: "Currency", 2024: "Currency", 2025: "Currency"},
    "comp_total": {2021: "CompTotal", 2022: "CompTotal", 2023: "CompTotal", 2024: "CompTotal", 2025: "CompTotal"},
    "comp_freq": {2021: "CompFreq", 2022: "CompFreq", 2023: None, 2024: None, 2025: None},
    "salary_usd_yearly": {2021: "ConvertedCompYearly", 2022: "ConvertedCompYearly", 2023: "ConvertedCompYearly", 2024: "ConvertedCompYearly", 2025: "ConvertedCompYearly"},
    "remote_work": {2021: None, 2022: "RemoteWork", 2023: "RemoteWork", 2024: "RemoteWork", 2025: "RemoteWork"},
    "industry": {2021: None, 2022: None, 2023: "Industry", 2024: "Industry", 2025: "Industry"},
    "ai_select": {2021: None, 2022: None, 2023: "AISelect", 2024: "AISelect", 2025: "AISelect"},
    "lang_worked": {2021: "LanguageHaveWorkedWith", 2022: "LanguageHaveWorkedWith", 2023: "LanguageHaveWorkedWith", 2024: "LanguageHaveWorkedWith", 2025: "LanguageHaveWorkedWith"},
    "lang_want": {2021: "LanguageWantToWorkWith", 2022: "LanguageWantToWorkWith", 2023: "LanguageWantToWorkWith", 2024: "LanguageWantToWorkWith", 2025: "LanguageWantToWorkWith"},
    "lang_admired": {2021: None, 2022: None, 2023: None, 2024: "LanguageAdmired", 2025: "LanguageAdmired"},
    "db_worked": {2021: "DatabaseHaveWorkedWith", 2022: "DatabaseHaveWorkedWith", 2023: "DatabaseHaveWorkedWith", 2024: "DatabaseHaveWorkedWith", 2025: "DatabaseHaveWorkedWith"},
    "db_want": {2021: "DatabaseWantToWorkWith", 2022: "DatabaseWantToWorkWith", 2023: "DatabaseWantToWorkWith", 2024: "DatabaseWantToWorkWith", 2025: "DatabaseWantToWorkWith"},
    "platform_worked": {2021: "PlatformHaveWorkedWith", 2022: "PlatformHaveWorkedWith", 2023: "PlatformHaveWorkedWith", 2024: "PlatformHaveWorkedWith", 2025: "PlatformHaveWorkedWith"},
    "tools_worked": {2021: "ToolsTechHaveWorkedWith", 2022: "ToolsTechHaveWorkedWith", 2023: "ToolsTechHaveWorkedWith", 2024: "ToolsTechHaveWorkedWith", 2025: None},
    "dev_envs_worked": {2021: "NEWCollabToolsHaveWorkedWith", 2022: "NEWCollabToolsHaveWorkedWith", 2023: "NEWCollabToolsHaveWorkedWith", 2024: "NEWCollabToolsHaveWorkedWith", 2025: "DevEnvsHaveWorkedWith"},
}

# Columns parsed to numbers after the union; everything else stays text.
NUMERIC_COLUMNS = ("years_code", "years_code_pro", "work_exp", "comp_total", "salary_usd_yearly")

# Multi-value (';'-separated) answer columns.
MULTIVALUE_COLUMNS = (
    "lang_worked", "lang_want", "lang_admired", "db_worked", "db_want",
    "platform_worked", "tools_worked", "dev_envs_worked",
)


def canonical_type(name: str) -> T.DataType:
    if name == "response_id":
        return T.LongType()
    if name in NUMERIC_COLUMNS:
        return T.DoubleType()
    return T.StringType()


def responses_schema() -> T.StructType:
    """``survey_year`` plus the 26 mapped columns, in map order."""
    fields = [T.StructField("survey_year", T.IntegerType(), True)]
    fields += [T.StructField(c, canonical_type(c), True) for c in COLUMN_MAP]
    return T.StructType(fields)


RESPONSE_COLUMNS = tuple(f.name for f in responses_schema().fields)


def source_columns(year: int) -> list[tuple[str, str]]:
    """(canonical, source) pairs present in ``year``'s file layout."""
    return [(c, m[year]) for c, m in COLUMN_MAP.items() if m.get(year)]


def validate_column_map(column_map: dict = COLUMN_MAP, years=YEARS) -> list[str]:
    """Structural problems of a column map (empty list when sound)."""
    problems = []
    for canon, by_year in column_map.items():
        for y in years:
            if y not in by_year:
                problems.append(f"{canon}: year {y} missing")
        for y, src in by_year.items():
            if src is not None and not isinstance(src, str):
                problems.append(f"{canon}: year {y} source must be str or None")
    for y in years:
        if not column_map.get("response_id", {}).get(y):
            problems.append(f"response_id: no source in {y}")
    return problems
