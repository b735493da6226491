"""The inverted multi-index and the fixity audit."""

import hashlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from pnlflow.llm import merkle_fixity, multi_index, queries
from pnlflow.llm.common import table


def plain_neighbours(rows, asks, top=5):
    rows = [(i, np.array(v, float)) for i, v in rows]
    out = {}
    for i, v in rows:
        if asks(i):
            found = sorted((-float(multi_index.cosines(v[None], w[None])[0]), j) for j, w in rows if j != i)
            out[i] = [(j, -s) for s, j in found[:top]]
    return out


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r["rank"]
    return out


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall(spark, sf):
    vectors = table(spark, f"/root/testdata/{sf}", "embeddings")
    got = by_query(multi_index.neighbours(vectors, "vec_id", "embedding", F.col("vec_id") % 50 == 0).collect())
    expected = plain_neighbours([(r.vec_id, r.embedding) for r in vectors.collect()], lambda i: i % 50 == 0)
    assert set(got) == set(expected) and all(len(x) == 5 for x in got.values())
    hits = [j in {k for k, _ in got[q]} for q, x in expected.items() for j, _ in x]
    assert np.mean(hits) >= 0.9
    exact = {(q, j): s for q, x in expected.items() for j, s in x}
    assert all(exact[q, j] == s for q, x in got.items() for j, s in x if (q, j) in exact)


def test_odd_vectors(spark):
    rng = np.random.default_rng(0)
    good = [(i, rng.normal(size=6).tolist(), "x", 1) for i in range(0, 60)]
    good += [(100 + i, good[3][1], "x", 1) for i in range(30)]  # copies: ties go to the smaller id
    odd = [(200, None, "x", 1), (201, [0.0] * 6, "x", 1), (202, [1.0, None, 1.0, 1.0, 1.0, 1.0], "x", 1), (203, [float("nan")] * 6, "x", 1),
           (204, [float("inf")] + [1.0] * 5, "x", 1), (205, [], "x", 1), (206, [1.0, 2.0], "x", 1), (None, [1.0] * 6, "x", 1)]
    df = spark.createDataFrame(good + odd, "vec_id long, embedding array<double>, a string, part long")
    got = by_query(multi_index.neighbours(df, "vec_id", "embedding", F.col("vec_id") % 10 == 0, s=multi_index.Settings(recall=1.0, trial=1000, tile=7)).collect())
    assert got == plain_neighbours([r[:2] for r in good], lambda i: i % 10 == 0)
    few = by_query(multi_index.neighbours(df.where("vec_id in (0, 1, 2)"), "vec_id", "embedding", F.lit(True)).collect())
    assert {q: len(x) for q, x in few.items()} == {0: 2, 1: 2, 2: 2}
    assert multi_index.neighbours(df.where("vec_id < 0"), "vec_id", "embedding", F.lit(True)).collect() == []
    assert multi_index.neighbours(df.where("vec_id = 0"), "vec_id", "embedding", F.lit(True)).collect() == []


def test_extreme_components_and_repeated_ids(spark):
    """Doubles whose squares overflow or vanish; a query's row three times; one id with several vectors."""
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=6) * scale).tolist()) for i, scale in enumerate([1.0, 1e200, 1e-200, 1e300, 1e-150, 1.0] * 8)]
    rows += [rows[0], rows[0], rows[10], rows[11], rows[11]]
    rows += [(5, rng.normal(size=6).tolist()), *((7, (np.array(rows[20][1]) * k).tolist()) for k in (1.0, 2.0, 4.0, 3.0))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asks = [0, 1, 2, 3, 20, 30]
    got = by_query(multi_index.neighbours(df, "vec_id", "embedding", F.col("vec_id").isin(asks), s=multi_index.Settings(recall=1.0, trial=1000, tile=9)).collect())
    with np.errstate(all="ignore"):
        for q in asks:
            best = {}
            for i, v in rows:
                for j, w in rows:
                    if i == q and j != q:
                        a, b = (np.array([np.longdouble(x) for x in y]) for y in (v, w))
                        best[j] = max(best.get(j, -2.0), float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))))
            expected = sorted(best.items(), key=lambda x: -x[1])[:5]
            assert [j for j, _ in got[q]] == [j for j, _ in expected]
            assert np.allclose([x for _, x in got[q]], [x for _, x in expected], rtol=1e-12)
    assert multi_index.repeated(np.array([3, 1, 3, 2, 1, 3]))[0].tolist() == [1, 4] and len(multi_index.repeated(np.array([], np.int64))) == 0


def test_walk_goes_by_summed_distance():
    rng = np.random.default_rng(1)
    left, right, size = rng.random(9), rng.random(7), rng.integers(0, 3, (9, 7))
    cells = multi_index.walk(left, right, size, size.sum())
    assert sorted(cells) == [tuple(c) for c in np.argwhere(size > 0).tolist()]
    reach = [left[a] + right[b] for a, b in cells]
    assert reach == sorted(reach)
    assert sum(size[c] for c in multi_index.walk(left, right, size, 10)) >= 10


RECORDS = "volume long, offset long, length long, record_id long, sha256 string"


def sha(x):
    return hashlib.sha256(str(x).encode()).hexdigest()


def test_audit_finds_what_differs(spark):
    one = [(v, 500 * k, 500, 1000 * v + k, sha((v, k))) for v in (-2, 0, 1, 5, 300) for k in range(40 if v else 700)]
    two = list(one)
    two[3] = (*two[3][:4], sha("rot"))
    two[100] = (*two[100][:4], sha("rot again"))
    lost = two.pop(200)
    two.append((7, 0, 10, 1, sha("new volume")))
    two.append((0, 250, 10, 2, sha("between")))
    two.append(one[10])  # a record twice
    expected = {(*one[3][:2], "damaged"), (*one[100][:2], "damaged"), (*lost[:2], "missing"), (7, 0, "extra"), (0, 250, "extra"), (*one[10][:2], "damaged")}
    a, b = (spark.createDataFrame(r, RECORDS) for r in (one, two))
    assert {(r.volume, r.offset, r.status) for r in merkle_fixity.audit(a, b, fanout=4, span=2000).collect()} == expected
    assert merkle_fixity.audit(a, a.repartition(3)).collect() == []
    none = a.where("volume > 1000")
    assert merkle_fixity.audit(none, none).collect() == []
    assert Counter(r.status for r in merkle_fixity.audit(a, none).collect()) == {"missing": len(one)}
    assert Counter(r.status for r in merkle_fixity.audit(none, a).collect()) == {"extra": len(one)}


def test_archive_places_records_one_after_another(spark):
    pages = spark.createDataFrame([(i, f"u{i}", "é" * i, "x") for i in range(20)] + [(3, "u", None, "x"), (None, None, None, "x"), (1500, None, "", "x")],
                                  "page_id long, url string, html string, volume string")
    rows = merkle_fixity.archive(pages).collect()
    assert len(rows) == 23
    for v in {r.volume for r in rows}:
        here = sorted((r.offset, r.length) for r in rows if r.volume == v)
        assert here[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(here, here[1:]))
    assert {r.volume for r in rows if r.record_id is not None} == {0, 1}


def test_query_equals_its_sql(spark):
    got = queries.op3_merkle_fixity(spark, "/root/testdata/sf0.01")
    con = duckdb.connect()
    con.sql("create view pages as select * from '/root/testdata/sf0.01/pages.parquet'")
    columns = ", ".join(f'"{c}"' for c in got.columns)
    expected = con.sql(f"select {columns} from ({queries.oracle_sql()['op3_merkle_fixity']})").fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str) and expected
