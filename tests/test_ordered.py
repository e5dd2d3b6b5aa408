"""Running totals against brute force."""

import random

import pytest

from tidemark.operators import ordered


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, descending):
    random.seed(1)
    rows = [(g, v, random.randint(0, 9)) for g in ("a", "b", "c") for v in random.sample(range(1000), 60)]
    df = spark.createDataFrame(rows, "g string, v int, n long").repartition(5)
    got = {
        (r.g, r.v): (r.n_upto, r.n_total, r.n_next)
        for r in ordered.running_totals(df, "v", ["n"], ["g"], descending).collect()
    }
    assert len(got) == len(rows)
    for group in ("a", "b", "c"):
        part = sorted(((v, n) for g, v, n in rows if g == group), reverse=descending)
        total, upto = sum(n for _, n in part), 0
        for i, (v, n) in enumerate(part):
            upto += n
            following = part[i + 1][1] if i + 1 < len(part) else None
            assert got[group, v] == (upto, total, following)


def test_slices_are_spread_by_range(spark, capsys):
    counts = spark.range(1000).selectExpr("id AS v", "1L AS n")
    ordered.running_totals(counts, "v", ["n"]).explain()
    plan = capsys.readouterr().out
    # only the small facts per slice are dealt by a hash
    rows = [line for line in plan.splitlines() if "Exchange" in line and "(_slice" in line]
    assert sum("rangepartitioning(_slice" in line for line in rows) == 1
    assert sum("hashpartitioning(_slice" in line for line in rows) <= 1
