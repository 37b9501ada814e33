import numpy as np
import pytest

from greenlake.llm import quality, queries


def test_thresholds_are_ordered_and_grades_recovered():
    rng = np.random.default_rng(1)
    grades = rng.integers(0, 4, 600)
    examples = [np.unique(np.concatenate([[10 + g], 100 + rng.integers(0, 50, 8)])) for g in grades]
    w, theta = quality.fit_ordinal(examples, grades)
    assert np.all(np.diff(theta) > 0)
    score = np.array([w[e].sum() for e in examples])
    expected = (1 / (1 + np.exp(theta - score[:, None]))).sum(1)
    assert np.mean(np.round(expected) == grades) > 0.95


def test_features_order_the_grades():
    examples, grades = [np.array([1]), np.array([2]), np.array([3])] * 10, np.array([0, 1, 2] * 10)
    w, theta = quality.fit_ordinal(examples, grades, folds=2)
    assert w[1] < w[2] < w[3] and w[1] < theta[0] < w[2] < theta[1] < w[3]


# sf0.001 has three toxic documents in the fitted half, too few to learn their words.
@pytest.mark.parametrize("sf, good, bad", [("sf0.001", 0.9, (1, 0.5)), ("sf0.01", 0.95, (0.4, 0.4)), ("sf0.1", 0.98, (0.1, 0.1))])
def test_held_out_selection(spark, sf, good, bad):
    d = f"/root/testdata/{sf}"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
    ratings = queries.ratings(spark.read.parquet(f"{d}/labels.parquet"))
    model = quality.train(docs, ratings.where("doc_id % 2 = 0"))
    got = quality.grade(docs.where("doc_id % 2 = 1"), model).join(ratings, "doc_id").select("grade", "kept").collect()
    kept = {g: np.mean([r["kept"] for r in got if r["grade"] == g]) for g in (0, 1, 2)}
    assert kept[2] > good and kept[0] <= bad[0] and kept[1] < bad[1]


@pytest.mark.parametrize("sf, toxic", [("sf0.001", 0.5), ("sf0.01", 0.2), ("sf0.1", 0.05)])
def test_rated_documents_are_told_apart(spark, sf, toxic):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text")
    ratings = queries.ratings(spark.read.parquet(f"/root/testdata/{sf}/labels.parquet"))
    got = quality.grade(docs, quality.train(docs, ratings)).join(ratings, "doc_id").select("grade", "kept").collect()
    kept = {g: np.mean([r["kept"] for r in got if r["grade"] == g]) for g in (0, 1, 2)}
    assert kept[2] > 0.98 and kept[0] < toxic and kept[1] < 0.1


def test_edge_rows(frame):
    docs = frame([(1, "good text here", 1), (2, None, 1), (3, "", 1), (3, "", 1), (None, "x" * 50000, 1)], "doc_id long, text string, kept int")
    ratings = frame([(1, 2), (1, 1), (2, 0), (None, 2), (9, None)], "doc_id long, grade int")
    out = quality.grade(docs, quality.train(docs, ratings))
    assert out.columns == ["doc_id", "text", "expected_grade", "tail_probability", "kept"] and out.count() == 5
    free = quality.grade(docs, quality.train(docs, ratings.where("false"))).collect()
    assert all(r["kept"] for r in free)
    assert quality.grade(docs.where("false"), quality.train(docs.where("false"), ratings)).count() == 0


def test_equal_texts_get_equal_grades(frame):
    docs = frame([(i, f"some text {i % 2}") for i in range(20)], "doc_id long, text string")
    ratings = frame([(i, i % 2) for i in range(20)], "doc_id long, grade int")
    out = quality.grade(docs, quality.train(docs, ratings)).collect()
    assert len({(r["text"], r["expected_grade"], r["kept"]) for r in out}) == 2
    tied = quality.grade(docs, quality.train(docs, frame([(i, i % 2) for i in range(4)] + [(i, 1 - i % 2) for i in range(4, 8)], "doc_id long, grade int"))).collect()
    assert len({r["tail_probability"] for r in tied}) <= 2
