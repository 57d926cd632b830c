"""Splits, features, metrics and models on literal and generated rows."""

import math

import pytest
from pyspark.sql import functions as F

from reviewmill.classifier import features, metrics, split, training
from reviewmill.schemas import LABELS

# Sizes of a known labelled set and of its published split and folds.
SIZES = {"negative": 15640, "neutral": 10913, "positive": 73150}
PARTS = {"train": (12512, 8730, 58520), "validation": (1564, 1091, 7315), "test": (1564, 1092, 7315)}


@pytest.fixture(scope="module")
def labelled(spark):
    low, middle = SIZES["negative"], SIZES["negative"] + SIZES["neutral"]
    label = F.when(F.col("id") < low, "negative").when(F.col("id") < middle, "neutral").otherwise("positive")
    return spark.range(sum(SIZES.values())).select(F.col("id").cast("string").alias("review_key"), label.alias("rating_label"))


def test_split_has_the_known_sizes(labelled):
    parts = split.stratified_split(labelled)
    got = {(r.split, r.rating_label): r["count"] for r in parts.groupBy("split", "rating_label").count().collect()}
    assert got == {(part, label): n for part, sizes in PARTS.items() for label, n in zip(LABELS, sizes)}


def test_folds_have_the_known_sizes(labelled):
    folds = split.stratified_folds(labelled)
    assert sorted((r["count"] for r in folds.groupBy("fold").count().collect()), reverse=True) == [19941, 19941, 19941, 19940, 19940]


def test_split_does_not_depend_on_partitions(labelled):
    one, other = split.stratified_split(labelled), split.stratified_split(labelled.repartition(5, "rating_label"))
    assert one.exceptAll(other).count() == 0


def test_metrics_of_a_published_confusion_matrix(spark):
    matrix = {"negative": (1416, 35, 113), "neutral": (575, 130, 387), "positive": (464, 117, 6734)}
    rows = [(a, p, n) for a, counts in matrix.items() for p, n in zip(LABELS, counts)]
    cells = spark.createDataFrame(rows, "rating_label string, pred_label string, n int")
    scored = cells.select("rating_label", "pred_label", F.explode(F.sequence(F.lit(1), "n")))
    row = metrics.classification_metrics(scored).first()
    got = [row.accuracy, row.macro_precision, row.macro_recall, row.macro_f1, row.weighted_f1]
    assert [round(v, 6) for v in got] == [0.830408, 0.656219, 0.648331, 0.606527, 0.810371]
    classes = {r.label: r for r in metrics.class_metrics(scored).collect()}
    assert round(classes["neutral"].recall, 6) == 0.119048 and classes["negative"].support == 1564


def test_fold_text():
    accented, plain = features._accents()
    assert len(accented) == len(plain) and plain[accented.index("é")] == "e"


def test_features_by_hand(spark):
    texts = ["Café café good", "good bad", "good bad cafe", "other Bad x"]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "review_key int, t string")
    model = features.fit_features(table, "t", features.FeatureSettings(max_document_share=1.0))
    terms = model.counter.vocabulary
    assert sorted(terms) == ["bad", "cafe", "good", "good bad"]
    row = model.transform(table, "t").filter("review_key = 0").first().features
    idf = {"cafe": math.log(5 / 3) + 1, "good": math.log(5 / 4) + 1}
    raw = {"cafe": (1 + math.log(2)) * idf["cafe"], "good": idf["good"]}
    norm = math.sqrt(sum(v * v for v in raw.values()))
    assert {terms[i]: round(row[int(i)], 9) for i in row.indices} == {k: round(v / norm, 9) for k, v in raw.items()}


@pytest.fixture(scope="module")
def reviews(spark):
    words = {"negative": "awful broken refund", "neutral": "okay average fine", "positive": "lovely great perfect"}
    rows = [(f"{label}{i}", f"{words[label].split()[i % 3]} thing {words[label].split()[(i + 1) % 3]} n{i % 7}", label)
            for label in LABELS for i in range(40)]
    return spark.createDataFrame(rows, "review_key string, review_text_clean string, rating_label string").repartition(4)


def test_balanced_weights(spark):
    rows = spark.createDataFrame([("positive",)] * 6 + [("negative",)] * 2, "rating_label string")
    weights = {r.rating_label: r.weight for r in training.with_balanced_weights(rows, "rating_label").distinct().collect()}
    assert weights == {"positive": 8 / 12, "negative": 2.0}


def test_out_of_fold_covers_every_key_once(reviews):
    scored = training.oof_predictions(reviews, folds=3, max_iterations=15).collect()
    assert len({r.review_key for r in scored}) == len(scored) == 120
    assert sum(r.pred_label == r.rating_label for r in scored) > 110
    for r in scored:
        parts = [r.negative_score, r.neutral_score, r.positive_score]
        assert abs(sum(parts) - 1) < 1e-9 and r.pred_score == max(parts) == parts[LABELS.index(r.pred_label)]


def test_folds_by_subtraction_equal_separate_fits(reviews):
    """One table of terms by fold and one of counts, against a vocabulary and a fit of its own for every fold."""
    found = {r.review_key: r for r in training.oof_predictions(reviews, folds=3, max_iterations=60).collect()}
    folded = split.stratified_folds(reviews, 3)
    assert len(found) == 120
    for fold in range(3):
        model = training.fit(folded.filter(F.col("fold") != fold), max_iterations=60)
        for r in model.score(folded.filter(F.col("fold") == fold)).collect():
            assert all(abs(r[f"{x}_score"] - found[r.review_key][f"{x}_score"]) < 1e-3 for x in LABELS) and r.pred_label == found[r.review_key].pred_label


def test_vocabularies_without_each_fold(spark):
    rows = [(i % 3, f"w{i % 5} w{i % 7} only{i % 3} w{i % 5}") for i in range(60)]
    table = features.with_terms(spark.createDataFrame(rows, "fold int, t string"), "t").select("fold", "terms")
    limits = features.FeatureSettings(max_terms=15, max_document_share=0.9)
    for fold, model in enumerate(features.learn_without_each(table, "fold", 3, limits)):
        own = features.learn_from_terms(table.filter(F.col("fold") != fold).select("terms"), limits)
        found = {t: w for t, w in zip(model.counter.vocabulary, model.weights) if w}
        assert found.keys() == set(own.counter.vocabulary) and f"only{fold}" not in found
        assert all(abs(found[t] - w) < 1e-12 for t, w in zip(own.counter.vocabulary, own.weights))


def test_fit_is_the_minimum_of_the_plain_objective(spark):
    """The gradient of the weighted, ridged log-loss, written out with NumPy, vanishes at the fitted coefficients."""
    import numpy as np

    rng = np.random.default_rng(5)
    rows = [(f"k{i}", " ".join(rng.choice(["good", "bad", "soft", "hard", "dull", "warm"], 4)), LABELS[int(rng.choice(3, p=(0.5, 0.2, 0.3)))]) for i in range(90)]
    table = spark.createDataFrame(rows, "review_key string, review_text_clean string, rating_label string")
    model = training.fit(table, c=0.5, max_iterations=500)
    ready = training.with_balanced_weights(model.features.transform(table, "review_text_clean"), "rating_label").collect()
    x, y = np.array([r.features.toArray() for r in ready]), np.eye(3)[[LABELS.index(r.rating_label) for r in ready]]
    w = np.array([r.weight for r in ready])
    coefficients, intercept = model.regression.coefficientMatrix.toArray(), model.regression.interceptVector.toArray()
    scores = np.exp(x @ coefficients.T + intercept)
    wrong = (scores / scores.sum(axis=1, keepdims=True) - y) * w[:, None] / w.sum()
    slope = wrong.T @ x + coefficients / (0.5 * w.sum())
    assert np.abs(slope).max() < 2e-3 and np.abs(wrong.sum(axis=0)).max() < 2e-3 and np.abs(coefficients).max() > 0.1


def test_selection_and_saved_model(spark, reviews, tmp_path):
    found = training.select_c(reviews, grid=(0.5, 2.0), max_iterations=10)
    assert found.c in (0.5, 2.0) and found.test["row_count"] == 12 and len(found.validation) == 2
    found.model.save(str(tmp_path / "model"))
    loaded = training.SentimentModel.load(spark, str(tmp_path / "model"))
    one, two = (sorted((r.review_key, r.pred_label, round(r.pred_score, 12)) for r in m.score(reviews).collect()) for m in (found.model, loaded))
    assert one == two


def test_stream_scoring(spark, reviews, tmp_path):
    from reviewmill.streaming.ingest import score_stream, write_available

    reviews.select("review_key", "review_text_clean").write.parquet(str(tmp_path / "in"))
    model = training.fit(reviews, max_iterations=10)
    stream = spark.readStream.schema("review_key string, review_text_clean string").parquet(str(tmp_path / "in"))
    write_available(score_stream(model, stream, "v1"), str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).select("review_key").distinct().count() == 120


def test_counts_of_a_table_pass_no_python(spark):
    table = spark.createDataFrame([("aa bb aa",), ("aa cc",), ("zz",)], "t string")
    terms = features.with_terms(table, "t")
    model = features.FeatureModel(features._counter(["aa", "bb"]), features.DenseVector([1.0, 1.0]))
    counted = model.count(terms)
    assert "Python" not in counted._jdf.queryExecution().executedPlan().toString()
    got = {r.t: dict(zip(r._tf.indices.tolist(), r._tf.values.tolist())) for r in counted.collect()}
    assert got["zz"] == {} and got["aa cc"] == {0: 1.0}
    assert got["aa bb aa"] == pytest.approx({0: 1 + math.log(2), 1: 1.0})


def test_selection_cuts_the_text_for_one_table_of_terms(spark, monkeypatch):
    word = {"negative": "bad", "neutral": "middling", "positive": "good"}
    rows = [(f"k{i}", f"{word[label]} thing{i % 7} {word[label]}", label) for i in range(60) for label in [LABELS[i % 3]]]
    table = spark.createDataFrame(rows, "review_key string, review_text_clean string, rating_label string")
    calls, counts = [], features.term_statistics
    monkeypatch.setattr(features, "term_statistics", lambda *a: calls.append(a) or counts(*a))
    found = training.select_c(table, max_iterations=5)
    assert len(calls) == 1 and [r["row_count"] for r in found.validation] == [6, 6, 6]
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_words_of_any_script_are_those_of_the_column_expression(spark):
    """Every character whose kind is that of an older Unicode version, and so the same to Java and Python, inside a word and at its ends; and odd texts."""
    import sys
    import unicodedata

    known = [c for c in map(chr, range(1, sys.maxunicode + 1)) if unicodedata.category(c) not in ("Cn", "Cs", "Co")
             and unicodedata.ucd_3_2_0.category(c) == unicodedata.category(c)]
    texts = [" ".join(f"x{c}y {c}{c}" for c in known[i:i + 100]) for i in range(0, len(known), 100)]
    texts += ["", " ", "a b", "ΟΔΟΣ ΣΑΣ", "İstanbul ß ﬁn", "été á", "½ x² y_ __ 12", "हिन्दी में", "東京 都", "a‍b", "x\x1cy zz\x85ww"]
    table = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    cut = table.select("t", F.regexp_extract_all(features.fold_text("t"), F.lit(r"(?U)(\w\w+)"), F.lit(1)).alias("words"))
    rows = features.with_terms(cut, "t").collect()
    assert len(rows) == len(texts) and all(r.terms == " ".join(r.words) for r in rows)


def test_terms_are_counted_as_numbers(spark):
    """Statistics and counts against plain counters, over several runs; no row is made for each use of a term."""
    from collections import Counter

    texts = [" ".join(f"w{i * k % 13}{'x' * (i % 3)}" for k in range(i % 9)) for i in range(9000)] + [None, "", "solo"]
    plain = [Counter(w := (t or "").split()) + Counter(map(" ".join, zip(w, w[1:]))) for t in texts]
    table = spark.createDataFrame([(i % 3, t) for i, t in enumerate(texts)], "part int, terms string").coalesce(1)
    uses, documents = Counter(), Counter()
    for i, counts in enumerate(plain):
        uses.update({(i % 3, t): n for t, n in counts.items()})
        documents.update((i % 3, t) for t in counts)
    found = features.term_statistics(table, "part")
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    rows = found.collect()
    assert {(r.part, r.term): (r.uses, r.documents) for r in rows} == {t: (n, documents[t]) for t, n in uses.items()} and len(rows) == len(uses)
    vocabulary = sorted({t for _, t in uses})[::2] + ["not there", "there"]
    known = set(vocabulary)
    model = features.FeatureModel(features._counter(vocabulary), features.DenseVector([1.0] * len(vocabulary)))
    for r in model.count(table.withColumn("t", F.col("terms"))).collect():
        own = Counter(w := (r.t or "").split()) + Counter(map(" ".join, zip(w, w[1:])))
        got = {vocabulary[i]: v for i, v in zip(r._tf.indices.tolist(), r._tf.values.tolist())}
        assert got == pytest.approx({t: 1 + math.log(n) for t, n in own.items() if t in known}) and r._tf.indices.tolist() == sorted(r._tf.indices.tolist())


def test_folds_are_fitted_in_common_passes_and_nothing_is_kept_in_memory(spark, reviews, monkeypatch):
    """five fits kept a copy each of their rows in the executors' memory; now rows stream, once for all fits."""
    import threading

    from reviewmill.classifier import fitting

    kept, done, passes, valued = [], threading.Event(), [], fitting._values
    monkeypatch.setattr(fitting, "_values", lambda table, asked, *a: passes.append(len(asked)) or valued(table, asked, *a))

    def look():
        while not done.wait(0.02):
            kept.append(spark.sparkContext._jsc.getPersistentRDDs().size())

    watch = threading.Thread(target=look)
    watch.start()
    try:
        assert training.oof_predictions(reviews, folds=3, max_iterations=15).count() == 120
    finally:
        done.set()
        watch.join()
    assert max(kept) == 0 and passes[0] == 3 and len(passes) < 40


def test_fit_equals_that_of_the_library(spark):
    """F2, F4, F5: the same minimum as Spark's own regression, followed further, by the scores of all rows."""
    import numpy as np
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import vector_to_array

    rng = np.random.default_rng(7)
    rows = [(f"k{i}", " ".join(rng.choice(["good", "bad", "soft", "hard", "dull", "warm"], int(rng.integers(0, 9)))), LABELS[int(rng.choice(3, p=(0.5, 0.2, 0.3)))])
            for i in range(90)] + [("null", None, "positive"), ("other", "good bad", "unknown")]
    table = spark.createDataFrame(rows, "review_key string, review_text_clean string, rating_label string")
    model = training.fit(table, c=2.0)
    known = training.with_balanced_weights(model.features.transform(table, "review_text_clean"), "rating_label").filter("weight is not null")
    ready = known.withColumn("y", F.array_position(F.array(*map(F.lit, LABELS)), F.col("rating_label")).cast("double") - 1)
    total = ready.agg(F.sum("weight")).first()[0]
    own = LogisticRegression(family="multinomial", labelCol="y", weightCol="weight", maxIter=2000, tol=1e-12, regParam=1 / (2.0 * total), standardization=False).fit(ready)
    expected = {r.review_key: r.p for r in own.transform(ready).select("review_key", vector_to_array("probability").alias("p")).collect()}
    found = {r.review_key: [r[f"{x}_score"] for x in LABELS] for r in model.score(table).collect()}
    assert len(found) == 92 and len(expected) == 91
    assert all(found[k] == pytest.approx(p, abs=2e-3) for k, p in expected.items())


def test_packed_counts_are_whole(spark):
    """rows of many texts hold every count, whatever its size, empty and missing texts too, and columns in their order."""
    import numpy as np

    from reviewmill.classifier import packed

    texts = [" ".join(["aa"] * n + ["bb", "cc"] * (n % 3)) for n in (0, 1, 2, 300, 300_000)] + [None, "zz"] + ["bb aa"] * 700
    table = spark.createDataFrame([(f"k{i}", t, i % 5) for i, t in enumerate(texts)], "key string, terms string, n int").coalesce(1)
    weights = {"aa": 1.0, "bb": 2.0, "cc": 0.0, "aa bb": 0.5, "bb cc": 3.0}
    model = features.FeatureModel(features._counter(list(weights)), features.DenseVector(list(weights.values())))
    stored = packed.packed(table, [model, model], ("n",), ("key",))
    found = [x for r in packed.rows_of(stored.toArrow().to_batches()) for x in zip(r[0]["key"].as_py(), packed.integers(r[0], "n"), r[1].sums(np.ones(5)), r[2][1])]
    assert [(k, n) for k, n, _, _ in found] == [(f"k{i}", i % 5) for i in range(len(texts))] and stored.count() > 1
    plain = {r.key: r.tf for r in model.count(table.withColumn("t", F.col("terms"))).select("key", F.col("_tf").alias("tf")).collect()}
    for key, _, total, length in found:
        values = plain[key].toArray()
        weighted = values * list(weights.values())
        assert total == pytest.approx(values.sum()) and length == pytest.approx(np.sqrt((weighted ** 2).sum()) or 1.0)


def test_a_selection_fits_all_of_its_grid_in_common_passes(spark, reviews, monkeypatch):
    """every iteration of every C was a pass of its own over the rows."""
    from reviewmill.classifier import fitting

    passes, valued = [], fitting._values
    monkeypatch.setattr(fitting, "_values", lambda table, asked, *a: passes.append(len(asked)) or valued(table, asked, *a))
    found = training.select_c(reviews, grid=(0.5, 1.0, 2.0), max_iterations=10)
    assert [r["c"] for r in found.validation] == [0.5, 1.0, 2.0] and passes[0] == 3 and 1 in passes and len(passes) < 50


def test_a_fit_of_one_label_predicts_it(spark):
    table = spark.createDataFrame([(f"k{i}", f"good thing{i % 3}", "neutral") for i in range(6)], "review_key string, review_text_clean string, rating_label string")
    assert {(r.pred_label, r.pred_score) for r in training.fit(table).score(table).collect()} == {("neutral", 1.0)}
