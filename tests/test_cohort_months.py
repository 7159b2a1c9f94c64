"""Cohort matrices lose no cell beyond the fixed month columns."""

from __future__ import annotations

import duckdb

from mercato.operators import serving
from mercato.plans import oracle, queries


def cohort(spark):
    rows = [("2010-01", m, 100 + m) for m in range(90)] + [("2010-02", m, m + 1) for m in (0, 83, 84, 200)]
    rows += [("2011-01", 0, 5), (None, None, 0)]
    return rows, spark.createDataFrame(rows, "cohort_month string, months_since_first int, customers long")


def test_ninety_months_keep_all_cells(spark):
    rows, frame = cohort(spark)
    got = {r["cohort_month"]: r.asDict() for r in serving.cohort_matrix(frame, queries.COHORT_MONTHS).collect()}
    for month, since, customers in rows:
        row = got[month]
        if since is None:
            assert row["later_months"] is None
        elif since < 84:
            assert row[str(since)] == customers
        else:
            cells = dict(c.split("=") for c in row["later_months"].split(";"))
            assert float(cells[str(since)]) == customers
    assert [c.split("=")[0] for c in got["2010-01"]["later_months"].split(";")] == [str(m) for m in range(84, 90)]
    assert got["2011-01"]["later_months"] is None


def test_oracle_has_the_same_cells(spark):
    rows, frame = cohort(spark)
    con = duckdb.connect()
    con.execute("CREATE TABLE metrics_cohort(cohort_month VARCHAR, months_since_first INTEGER, customers BIGINT)")
    con.executemany("INSERT INTO metrics_cohort VALUES (?, ?, ?)", rows)
    con.execute("""CREATE TABLE metrics_cohort_ret AS SELECT *, CAST(customers AS DOUBLE) / NULLIF(max(CASE WHEN
        months_since_first = 0 THEN customers END) OVER (PARTITION BY cohort_month), 0) * 100 AS retention_pct
        FROM metrics_cohort""")
    for value, source, made in (
            ("customers", "metrics_cohort", serving.cohort_matrix(frame, queries.COHORT_MONTHS)),
            ("retention_pct", "metrics_cohort_ret", serving.cohort_retention_pct(frame, queries.COHORT_MONTHS))):
        names = ", ".join(f'"{c}"' for c in made.columns)
        want = con.execute(f"SELECT {names} FROM ({oracle._pivot(value, source)})").fetchall()
        assert sorted(map(repr, map(tuple, made.collect()))) == sorted(map(repr, want))
