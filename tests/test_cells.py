"""The inverted-list index against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemart.operators import cells, vectors


def nearest(points, asked, k, leave=None):
    distance = ((points - asked) ** 2).sum(1)
    order = [i for i in np.lexsort((np.arange(len(points)), distance)) if i != leave]
    return [(int(i), pytest.approx(float(distance[i]))) for i in order[:k]]


def answers(df):
    out = {}
    for row in df.orderBy("query_id", "rank").collect():
        out.setdefault(row["query_id"], []).append((row["vec_id"], row["distance"]))
    return out


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 3, (6, 5))
    drawn = np.round(centres[rng.integers(0, 6, 400)] + rng.normal(0, 1, (400, 5)), 1)
    drawn[50:90] = drawn[0]  # ties
    return drawn


@pytest.fixture(scope="module")
def corpus(spark, points):
    rows = [(i, p.tolist(), "x") for i, p in enumerate(points)] + [(9999, None, "no vector")]
    return spark.createDataFrame(rows, "vec_id int, embedding array<double>, cell string").repartition(5)


@pytest.mark.parametrize("block,per_task", [(1024, 1 << 16), (7, 20)])
def test_exact_search_is_brute_force(corpus, points, monkeypatch, block, per_task):
    monkeypatch.setattr(cells, "BLOCK_ROWS", block)
    monkeypatch.setattr(cells, "QUERY_ROWS", block)
    monkeypatch.setattr(cells, "TASK_ROWS", per_task)
    index = cells.build_index(corpus, cells=12)
    stored = index.blocks().select(F.explode("ids").alias("id")).groupBy("id").count().collect()
    assert sorted(map(tuple, stored)) == [(i, 1) for i in range(400)]
    asking = corpus.withColumnRenamed("vec_id", "query_id")
    found = answers(cells.search(index, asking, 4, cells=1, exact=True))
    assert set(found) == set(range(400))
    assert all(found[q] == nearest(points, points[q], 4) for q in found)
    others = answers(cells.search(index, asking, 3, cells=2, exact=True, exclude_self=True))
    assert all(others[q] == nearest(points, points[q], 3, q) for q in range(400))


def test_visiting_all_cells_is_exact_and_fewer_lose_little(spark, corpus, points):
    index = cells.build_index(corpus, cells=12)
    asking = corpus.withColumnRenamed("vec_id", "query_id").filter("query_id < 60")
    exact = vectors.knn_join(asking, corpus, 4)
    assert answers(cells.search(index, asking, 4, cells=12)) == answers(exact)
    hits = [cells.recall(cells.search(index, asking, 4, cells=n), exact).first()["recall"] for n in (1, 4, 12)]
    assert hits == sorted(hits) and hits[-1] == 1.0
    needed = cells.cells_for_recall(index, asking, 4, target=0.95, start=1)
    assert cells.recall(cells.search(index, asking, 4, cells=needed), exact).first()["recall"] >= 0.9
    again = cells.open_index(spark, index.folder)
    assert np.allclose(again.centres, index.centres) and np.allclose(again.radii, index.radii) and again.id_type == index.id_type
    assert answers(cells.search(again, asking, 4, exact=True)) == answers(exact)


def test_cells_hold_what_is_nearest_to_them(corpus, points):
    index = cells.build_index(corpus, cells=9)
    rows = index.blocks().select("cell", F.posexplode("ids")).collect()
    for row in rows:
        away = np.sqrt(((index.centres - points[row["col"]]) ** 2).sum(1))
        assert away[row["cell"]] == pytest.approx(away.min(), abs=1e-6) and away[row["cell"]] <= index.radii[row["cell"]] + 1e-6


def test_text_ids_few_rows_and_empty_tables(spark):
    few = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0]), (None, [5.0, 5.0])], "vec_id string, embedding array<float>")
    asking = spark.createDataFrame([(1, [0.9, 0.0]), (2, None)], "query_id long, embedding array<float>")
    got = cells.search(cells.build_index(few), asking, 2, cells=1, exact=True).orderBy("rank").collect()
    assert [(row.query_id, row.vec_id, row["rank"]) for row in got] == [(1, "a", 1), (1, "b", 2)]
    more = cells.search(cells.build_index(few, cells=50), asking, 10, cells=50).collect()
    assert len(more) == 3
    nothing = cells.build_index(few.limit(0))
    assert cells.search(nothing, asking, 2, exact=True).collect() == []
    assert cells.search(cells.build_index(few), asking.limit(0), 2, exact=True).collect() == []


def test_too_many_centres_are_refused(corpus, monkeypatch):
    monkeypatch.setattr(cells, "CENTRE_BYTES", 100)
    with pytest.raises(ValueError, match="fewer cells"):
        cells.build_index(corpus, cells=12)


@pytest.mark.parametrize("exact", [True, False])
def test_queries_in_many_groups_hold_one_group_a_task(spark, monkeypatch, exact):
    """Every row asks: whatever the groups, each query meets its own cells, and the rows sent grow with groups, not with queries times cells."""
    monkeypatch.setattr(vectors, "GROUP_ROWS", 64)
    monkeypatch.setattr(cells, "QUERY_ROWS", 64)
    monkeypatch.setattr(cells, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(3)
    points = rng.normal(size=(500, 6)).round(1)
    rows = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    asking = rows.withColumnRenamed("vec_id", "query_id")
    index = cells.build_index(rows, cells=12)
    sent = []
    stream = cells.stream_past
    monkeypatch.setattr(cells, "stream_past", lambda asked, blocks, *rest: sent.append((asked.count(), blocks.count())) or stream(asked, blocks, *rest))
    found = cells.search(index, asking, 4, cells=3, exact=exact, exclude_self=True).collect()
    away = ((points[:, None, :] - points[None, :, :]) ** 2).sum(2)
    home = np.sqrt(((points[:, None, :] - index.centres[None, :, :]) ** 2).sum(2))
    own_cells = home.argsort(1)[:, :3]
    for q in range(len(points)):
        allowed = np.ones(len(points), bool) if exact else np.isin(home.argmin(1), own_cells[q])
        allowed[q] = False
        want = sorted(np.flatnonzero(allowed), key=lambda c: (away[q, c], c))[:4]
        assert [r["vec_id"] for r in sorted((r for r in found if r["query_id"] == q), key=lambda r: r["rank"])] == want
    for groups, blocks in sent:
        assert 500 // 64 <= groups <= 40 and blocks <= groups * (500 // 16 + 12)
    joined = {(r["query_id"], r["vec_id"]): r["rank"] for r in vectors.knn_join(asking, rows, 4, exclude_self=True).collect()}
    if exact:
        assert joined == {(r["query_id"], r["vec_id"]): r["rank"] for r in found}
