"""The jobs that the gate runs with smaller thresholds, here with the published ones, at sf0.1."""

from pathlib import Path

import duckdb
import pytest

from cohortlens.plans import remote, roles, salary, trends
from cohortlens.plans.oracles import ORACLE_SQL
from cohortlens.sources.store import store

SF = "/root/testdata/sf0.1"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not present")

#: job, its call, and the gate's thresholds in the oracle's text with those published
JOBS = {
    "lang_desire_gap": (lambda s: trends.lang_desire_gap(s.clean(), s.lang_exploded(), usage=s.lang_usage()),
                        [("user_count + wants > 200", "user_count + wants > 500")]),
    "salary_country": (lambda s: salary.salary_country(s.clean()), [("n >= 20", "n >= 100")]),
    "salary_experience": (lambda s: salary.salary_experience(s.clean()), [("count(*) >= 100", "count(*) >= 500"), ("n >= 3)", "n >= 30)")]),
    "remote_by_role": (lambda s: remote.remote_by_role(s.clean()), [("count(*) >= 120", "count(*) >= 100")]),
    "ai_salary": (lambda s: roles.ai_salary(s.clean()), [("total_n >= 80", "total_n >= 100")]),
}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("nation", "customer", "part", "orders", "lineitem"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", JOBS)
def test_published_thresholds(spark, con, name):
    job, changes = JOBS[name]
    sql = ORACLE_SQL[name]
    for old, new in changes:
        assert sql.count(old) == 1, old
        sql = sql.replace(old, new)
    df = job(store(spark, SF))
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(names)
    assert sorted(df.columns) == order
    want = sorted(repr([r[names.index(c)] for c in order]) for r in cur.fetchall())
    assert want and sorted(repr([r[c] for c in order]) for r in df.collect()) == want
