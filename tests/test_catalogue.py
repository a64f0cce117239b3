import duckdb
import numpy as np
import pytest
from conftest import SF

import __spark_entry__ as entry
from fieldloom.plans import catalogue, shapes  # noqa: F401

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(p):
    def plain(v):
        if v is None or v != v:
            return None
        if isinstance(v, (float, np.floating)):
            return round(float(v), 8)
        return int(v) if isinstance(v, (int, np.integer)) and not isinstance(v, bool) else v

    p = p[sorted(p.columns)]
    return list(p.columns), sorted(repr(tuple(plain(v) for v in r)) for r in p.itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_query_equals_sql(spark, db, name):
    assert rows(catalogue.QUERIES[name](spark, SF).toPandas()) == rows(db.execute(catalogue.ORACLE[name]).df())


def test_entry(spark):
    assert entry.entry(spark).columns == ["vec_id", "sim_x", "sim_rest"]


def test_greedy_dedup_equals_a_loop(spark):
    b = catalogue.boxes(spark, SF).toPandas()
    kept = []
    for r in b.sort_values("id").itertuples():
        def iou(q):
            i = max(0, min(q.x1, r.x1) - max(q.x0, r.x0)) * max(0, min(q.y1, r.y1) - max(q.y0, r.y0))
            return i / ((q.x1 - q.x0) * (q.y1 - q.y0) + (r.x1 - r.x0) * (r.y1 - r.y0) - i)

        if all(iou(q) < 0.3 for q in kept):
            kept.append(r)
    got = {r["id"] for r in catalogue.QUERIES["greedy_dedup"](spark, SF).collect()}
    assert got == {q.id for q in kept}


def test_higher_threshold_never_adds_rows(spark):
    from fieldloom.operators import vectors

    e, p = catalogue._protos(spark, SF)
    get = lambda t, m: {r["vec_id"] for r in vectors.one_vs_rest(e, p, "vec_id", "embedding", "proto", "pv", 3, t, m).collect()}
    assert get(0.25, 0.05) <= get(0.15, 0.05) and get(0.15, 0.1) <= get(0.15, 0.05)
