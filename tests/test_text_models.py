import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from agorascope import fixed
from agorascope.operators import classifier, enrichment, evaluation, features, sentiment, tokens, topics, trends

LEXICON = [("good", 1.9), ("bad", -2.5), ("no", -1.2), ("great", 3.1), ("like", 1.5)]


def lexicon(spark):
    return spark.createDataFrame(LEXICON, "token string, valence double")


def scored(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    rows = sentiment.compound_scores(docs, lexicon(spark), **options).collect()
    got = {r["id"]: r["compound"] for r in rows}
    return [got.get(i, "absent") for i in range(len(texts))]


CASES = {
    "good": 0.4404,
    "very good": 0.4927,
    "not good": -0.3412,
    "good!": 0.4926,
    "good??": 0.5040,
    "GOOD day": 0.5622,
    "GOOD": 0.4404,
    "good but bad": -0.5859,
    "never so good": 0.5777,
    "kind of good": 0.4404,
    "no good": -0.3412,
    "least good": -0.3412,
    "at least good": 0.4404,
    "without doubt good": 0.4404,
    "isn't really good": None,
    "nothing here": 0.0,
    "": None,
    "   ": None,
    "(good), \"bad\".": None,
}


def test_compound_rules(spark):
    got = dict(zip(CASES, scored(spark, list(CASES)), strict=True))
    want = dict(CASES)
    v = (1.9 + 0.293) * -0.74
    want["isn't really good"] = round(v / math.sqrt(v * v + 15), 4)
    want['(good), "bad".'] = round(-0.6 / math.sqrt(0.36 + 15), 4)
    assert got == want


def plain_sum(text, valences, rules, idioms):
    """The rules word by word, one text at a time."""
    own = [w if len(w.strip(fixed.PUNCTUATION)) <= 2 else w.strip(fixed.PUNCTUATION) for w in text.split()]
    words = [w.lower() for w in own]
    loud = [w.isupper() for w in own] if any(w.isupper() for w in own) and not all(w.isupper() for w in own) else [False] * len(own)
    get = lambda i: words[i] if 0 <= i < len(words) else ""
    boost = {**dict.fromkeys(rules.weakeners, -fixed.BOOST), **dict.fromkeys(rules.strengtheners, fixed.BOOST)}
    turn = words.index(rules.contrast) if rules.contrast in words else None
    total = 0.0
    for i, w in enumerate(words):
        if w not in valences:
            continue
        v = valences[w]
        if "no" in (get(i - 1), get(i - 2)) or (get(i - 3) == "no" and get(i - 1) in ("or", "nor")):
            v *= -0.74
        elif w == "no" and get(i + 1) in valences:
            v = 0.0
        v += (0.733 if v > 0 else -0.733) if loud[i] else 0
        for k in (1, 2, 3):
            if i < k or words[i - k] in valences:
                continue
            if words[i - k] in boost:
                step = boost[words[i - k]] * (-1 if v < 0 else 1)
                step += (0.733 if v > 0 else -0.733) if loud[i - k] else 0
                v += step * (1, 0.95, 0.9)[k - 1]
            between = words[i - k + 1 : i]
            if k > 1 and words[i - k] == "never" and {"so", "this"} & set(between):
                v *= 1.25
            elif k > 1 and words[i - k] == "without" and "doubt" in between:
                pass
            elif words[i - k] in rules.negators or "n't" in words[i - k]:
                v *= -0.74
            if k == 3:
                spans = [(i - 1, i), (i - 2, i), (i - 3, i), (i - 2, i - 1), (i - 3, i - 1), (i - 3, i - 2)]
                before = [" ".join(words[a : b + 1]) for a, b in spans]
                ahead = [" ".join(words[i : i + n]) for n in (4, 3, 2)]
                v = next((idioms[p] for p in ahead + before if p in idioms), v)
                v += sum(boost.get(" ".join(words[a : b + 1]), 0) for a, b in ((i - 3, i - 1), (i - 3, i - 2), (i - 2, i - 1)))
        if get(i - 1) == "least" and get(i - 2) not in ("at", "very"):
            v *= -0.74
        if w in boost or (w == "kind" and get(i + 1) == "of"):
            v = 0.0
        total += v * (1.0 if turn is None or i == turn else 0.5 if i < turn else 1.5)
    return total


IDIOMS = {"bad good": 1.5, "like bad good": -2.0, "is great like": 0.7, "kiss of like great": 2.2, "great day": 3.0, "great day of good": -1.0}


def test_batches_equal_plain_scoring(spark):
    r = random.Random(11)
    pool = [w for w, _ in LEXICON] + "very so this never without doubt not isn't least at kind of but or nor day is kiss just enough x GOOD Bad VERY".split()
    texts = [" ".join(r.choices(pool, k=r.randint(0, 14))) for _ in range(1500)] + ["", " ", "bad good", "is the x bad good", "(good)... great! day"]
    rules = sentiment.Rules(
        strengtheners=(*fixed.STRENGTHENERS, "without doubt"), weakeners=(*fixed.WEAKENERS, "kind of", "just enough", "of is kiss")
    )
    plain = sentiment.Rules()
    tables = {"idioms": spark.createDataFrame(list(IDIOMS.items()), "phrase string, valence double"), "rules": rules}
    for options, own, phrases in (({}, plain, {}), (tables, rules, IDIOMS)):
        got = scored(spark, texts, **options)
        for text, value in zip(texts, got, strict=True):
            s = plain_sum(text, dict(LEXICON), own, phrases)
            s += np.sign(s) * min(text.count("!"), 4) * 0.292
            want = round(s / math.sqrt(s * s + 15), 4) if text.strip() else None
            assert value == pytest.approx(want, abs=1e-4), text


def test_idioms_replace_the_value_of_a_word(spark):
    idioms = spark.createDataFrame([("a bad good", 3.0), ("bad good", 1.5), ("good day out", -2.0), ("bad", 9.0)], "phrase string, valence double")
    value = lambda s: round(s / math.sqrt(s * s + 15), 4)
    texts = ["it was x bad good", "it was a bad good", "bad good", "x y z good day out", "x y z good day", "x bad good y z good"]
    got = scored(spark, texts, idioms=idioms)
    # In the first two both words are in the idiom; the third has too few words before; in the last the idiom lies too far back.
    assert got == [value(1.5 + 1.5), value(1.5 + 1.5), value(-0.6), value(-2.0), value(1.9), value(-2.5 + 1.9 + 1.9)]
    with pytest.raises(ValueError):
        scored(spark, ["x"], idioms=spark.createDataFrame([("a b c d e", 1.0)], "phrase string, valence double"))


def test_emoji_and_emoticons(spark):
    emoji = spark.createDataFrame([("😀", "good face"), ("💔", "bad heart"), ("❤️", "never read"), ("x", None)], "emoji string, words string")
    lex = spark.createDataFrame([*LEXICON, (":)", 2.0), ("</3", -3.0)], "token string, valence double")
    texts = ["😀", "day😀", "day 😀😀", "💔!", "a :) b", "a </3 :)", "❤️", None, "😀good"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    score = sentiment.compound(lex, emoji=emoji)
    got = [r[1] for r in sorted(docs.select("id", score(F.col("text"))).collect())]
    value = lambda s: round(s / math.sqrt(s * s + 15), 4)
    assert got == [value(1.9), value(1.9), value(3.8), value(-2.5 - 0.292), value(2.0), value(-1.0), 0.0, None, value(1.9)]


def test_compound_of_absent_text(spark):
    assert scored(spark, [*CASES, None])[-1] == "absent"


def test_too_large_a_lexicon_is_refused(spark, monkeypatch):
    monkeypatch.setattr(sentiment, "fits_broadcast", lambda df, *a: False)
    with pytest.raises(ValueError):
        scored(spark, ["good"])


def test_rows_are_scored_each_for_itself(spark):
    rows = [("p", "good"), ("p", "bad"), ("q", "good day"), ("q", "good day"), (None, "good"), ("r", None), ("s", "")]
    table = sentiment.score_table(spark.createDataFrame(rows, "id string, text string"), lexicon(spark))
    got = sorted((str(r.id), r.text, r.sentiment_compound) for r in table.collect())
    bad = round(-2.5 / math.sqrt(2.5**2 + 15), 4)
    assert got == [("None", "good", 0.4404), ("p", "bad", bad), ("p", "good", 0.4404), ("q", "good day", 0.4404), ("q", "good day", 0.4404)]
    assert "Exchange" not in table._jdf.queryExecution().executedPlan().toString()


def test_mean_polarity_and_weak_labels(spark):
    docs = spark.createDataFrame([(1, "Good, bad!"), (2, "none"), (3, None), (4, "great")], "id int, text string")
    got = {r["id"]: r["polarity"] for r in sentiment.mean_polarity(docs, lexicon(spark)).collect()}
    assert got == pytest.approx({1: -0.3, 2: 0.0, 3: 0.0, 4: 3.1})
    weak = {r["id"]: (r["compound_label"], r["polarity_label"]) for r in sentiment.weak_labels(docs, lexicon(spark)).collect()}
    assert weak == {1: ("neg", "neg"), 2: ("neu", "neu"), 3: ("neu", "neu"), 4: ("pos", "pos")}


def test_score_table_keeps_only_text(spark):
    docs = spark.createDataFrame([(1, "good"), (2, ""), (3, None), (4, " ")], "id int, text string")
    got = {r["id"]: (r["sentiment_label"], r["scored_at"] is not None) for r in sentiment.score_table(docs, lexicon(spark)).collect()}
    assert got == {1: ("positive", True), 4: (None, True)}


MATRICES = {
    "a": ([[34, 1, 0], [5, 21, 2], [7, 0, 30]], 0.85, (0.8771, 0.8441, 0.8497), (0.8728, 0.85, 0.8508)),
    "b": ([[8, 15, 12], [3, 18, 7], [12, 7, 18]], 0.44, (0.4281, 0.4526, 0.4306), (0.4277, 0.44, 0.4248)),
    "c": ([[48, 1, 3], [21, 3, 6], [34, 0, 9]], 0.48, (0.5720, 0.4108, 0.3636), (0.5459, 0.48, 0.4015)),
}


def test_reports_of_published_matrices(spark):
    names = ["neg", "neu", "pos"]
    rows = [
        (m, names[i], names[j])
        for m, (cells, *_) in MATRICES.items() for i in range(3) for j in range(3) for _ in range(cells[i][j])
    ]
    pairs = spark.createDataFrame(rows, "model string, true_label string, predicted string")
    matrix = {(r["model"], r["true_label"]): [r[n] for n in names] for r in evaluation.confusion_matrix(pairs).collect()}
    report = {(r["model"], r["label"]): r for r in evaluation.classification_report(pairs).collect()}
    for m, (cells, accuracy, macro, weighted) in MATRICES.items():
        assert [matrix[m, n] for n in names] == cells
        assert round(report[m, "accuracy"]["f1"], 4) == accuracy
        for name, want in (("macro avg", macro), ("weighted avg", weighted)):
            assert tuple(round(report[m, name][c], 4) for c in ("precision", "recall", "f1")) == want
    assert report["c", "neg"]["support"] == 52


def test_report_without_a_label(spark):
    pairs = spark.createDataFrame([("m", "pos", "pos")], "model string, true_label string, predicted string")
    report = {r["label"]: r for r in evaluation.classification_report(pairs).collect()}
    assert report["neg"]["precision"] == report["neg"]["recall"] == report["neg"]["f1"] == 0.0
    assert report["accuracy"]["f1"] == 1.0


DOCS = [
    (0, "the cat sat on the mat cat"), (1, "the dog sat on the log"), (2, "cats and dogs"), (3, ""), (4, None),
    (5, "dog dog dog log"),
]


def plain_tfidf(texts, stop, top, min_df):
    """The same weights by dictionaries."""
    import collections
    import re

    bags = []
    for t in texts:
        ws = [w for w in re.findall(r"\w{2,}", (t or "").lower()) if w not in stop]
        bags.append(collections.Counter(ws + [f"{a} {b}" for a, b in zip(ws, ws[1:], strict=False)]))
    df = collections.Counter(t for b in bags for t in b)
    cf = collections.Counter()
    for b in bags:
        cf.update(b)
    kept = sorted((t for t in df if df[t] >= min_df), key=lambda t: (-cf[t], t))[:top]
    out = []
    for b in bags:
        w = {t: b[t] * (math.log((1 + len(texts)) / (1 + df[t])) + 1) for t in b if t in kept}
        norm = math.sqrt(sum(x * x for x in w.values())) or 1
        out.append({t: x / norm for t, x in w.items()})
    return out


@pytest.mark.parametrize("top, min_df", [(100, 1), (5, 1), (100, 2)])
def test_tfidf_equals_plain_code(spark, top, min_df):
    docs = spark.createDataFrame(DOCS, "id int, text string")
    vectors, vocab = features.tfidf(docs, "id", "text", ["the", "on"], top, min_df)
    want = plain_tfidf([t for _, t in DOCS], {"the", "on"}, top, min_df)
    got = {r["id"]: {x["term"]: x["weight"] for x in r["features"]} for r in vectors.collect()}
    assert sorted(got) == list(range(len(want)))
    for i, weights in enumerate(want):
        assert got[i] == pytest.approx(weights)
    terms = [r["term"] for r in vocab.orderBy("term_id").collect()]
    assert terms == sorted(terms) and len(terms) <= top


def test_rows_of_one_id_have_vectors_of_their_own(spark):
    rows = [(1, "sun sky"), (1, "goal ball"), (None, "sun ball"), (None, None), (2, "sun sky")]
    docs = spark.createDataFrame(rows, "id int, text string")
    vectors, _ = features.tfidf(docs, "id", "text", (), 50, 1, 1)
    got = sorted((str(r["id"]), tuple(x["term"] for x in r["features"])) for r in vectors.collect())
    assert got == [("1", ("ball", "goal")), ("1", ("sky", "sun")), ("2", ("sky", "sun")), ("None", ()), ("None", ("ball", "sun"))]
    assert "Exchange" not in vectors._jdf.queryExecution().executedPlan().toString()


def themed(spark, n=60):
    words = [["sun", "sky", "cloud", "rain"], ["goal", "team", "match", "ball"], ["code", "data", "query", "table"]]
    dice = np.random.default_rng(1)
    rows = [(i, " ".join(dice.choice(words[i % 3], 12)), "abc"[i % 3]) for i in range(n)]
    return spark.createDataFrame(rows, "id long, text string, label string")


def test_nmf_recovers_themes(spark):
    docs = themed(spark)
    fitted = topics.factorise(docs, "id", "text", k=3, rounds=15)
    losses = np.array(fitted.losses)
    assert (np.diff(losses) <= 1e-9).all() and (fitted.weights >= 0).all()
    best = {r["id"]: r["topic_id"] for r in trends.dominant_topic(topics.document_topics(fitted, "id"), "id").collect()}
    assert len({(i % 3, best[i]) for i in best}) == 3 and len(best) == 60
    again = topics.factorise(docs.repartition(5), "id", "text", k=3, rounds=15)
    assert np.allclose(again.weights, fitted.weights)
    report = topics.topic_report(fitted, docs, "id", "text", 4, 2).collect()
    assert all(len(r["keywords"]) == 4 and len(r["examples"]) == 2 for r in report) and len(report) == 3


def test_singular_vectors(spark):
    docs = themed(spark)
    matrix = topics.factorise(docs, "id", "text", k=2, rounds=1).matrix
    rows = matrix.collect()
    dense = np.zeros((len(rows), 1 + max(max(r.term_ids) for r in rows)))
    for i, r in enumerate(rows):
        dense[i, r.term_ids] = r.weights
    values, vectors = topics.singular_vectors(matrix, dense.shape[1], 3)
    _, want, vt = np.linalg.svd(dense)
    assert values == pytest.approx(want[:3], rel=1e-4)
    assert np.abs(np.sum(vectors * vt[:3].T, axis=0)) == pytest.approx(np.ones(3), rel=1e-2)


def test_start_from_singular_vectors_is_as_good_as_the_best_of_five(spark):
    docs = themed(spark, 90)
    fitted = topics.factorise(docs, "id", "text", k=4, rounds=20)
    best = min(topics.factorise(docs, "id", "text", k=4, rounds=20, seed=i, start="random").losses[-1] for i in range(5))
    assert fitted.losses[-1] <= best * (1 + 1e-3)


def test_loss_and_top_terms_from_the_model_in_sql(spark):
    import duckdb

    docs = themed(spark)
    fitted = topics.factorise(docs, "id", "text", k=3, rounds=8)
    con = duckdb.connect()
    tables = {
        "x": fitted.matrix.select("id", F.explode(F.arrays_zip("term_ids", "weights")).alias("e")).select("id", F.col("e.term_ids").alias("t"), F.col("e.weights").alias("v")),
        "w": topics.document_topics(fitted, "id"),
        "v": fitted.vocabulary.select("term_id", "term"),
    }
    for name, table in tables.items():
        con.register(name, table.toArrow())
    con.register("h", pa.table({"k": np.repeat(np.arange(3), fitted.weights.shape[1]), "t": np.tile(np.arange(fitted.weights.shape[1]), 3), "h": fitted.weights.ravel()}))
    loss = con.execute("""
        SELECT sum((coalesce(v, 0) - coalesce(f, 0)) ** 2) FROM x FULL JOIN (
          SELECT id, t, sum(weight * h) AS f FROM w JOIN h ON h.k = w.topic_id GROUP BY id, t) p USING (id, t)""").fetchone()[0]
    assert loss <= fitted.losses[-1] + 1e-9 and loss == pytest.approx(fitted.losses[-1], rel=1e-2)
    want = con.execute("SELECT k, term FROM h JOIN v ON term_id = t QUALIFY row_number() OVER (PARTITION BY k ORDER BY h DESC, term) <= 4 ORDER BY k, h DESC, term").fetchall()
    assert [(r.topic_id, r.term) for r in topics.topic_terms(fitted, 4).orderBy("topic_id", "rank").collect()] == want


def test_classifier(spark, tmp_path):
    docs = themed(spark)
    model = classifier.train(docs, "text", "label", max_features=50)
    classifier.save(model, str(tmp_path / "model"))
    model = classifier.load(str(tmp_path / "model"))
    assert classifier.class_labels(model) == ["a", "b", "c"]
    more = docs.unionByName(spark.createDataFrame([(99, "  ", "a"), (98, None, "a")], docs.schema))
    rows = {r["id"]: r["sentiment"] for r in classifier.predict(more, model, "v9").collect()}
    assert all(rows[i]["label"] == "abc"[i % 3] for i in range(60))
    assert sum(rows[0]["proba"].values()) == pytest.approx(1.0)
    assert rows[0]["confidence"] == max(rows[0]["proba"].values())
    assert rows[0]["text_len"] > 0 and rows[0]["note"] is None and rows[0]["model_version"] == "v9"
    for empty in (99, 98):
        assert (rows[empty]["label"], rows[empty]["note"], rows[empty]["proba"]) == ("neu", "empty_text", None)


def test_probabilities_from_the_coefficients_in_sql(spark):
    """Softmax of the returned coefficients over features that DuckDB builds from the texts."""
    import duckdb

    docs = themed(spark)
    model = classifier.train(docs, "text", "label", max_features=60, max_iter=30)
    got = {(r["id"], k): p for r in classifier.predict(docs, model).collect() for k, p in r["sentiment"]["proba"].items()}
    by_kind = {type(stage).__name__: stage for stage in model.stages}
    terms, idf = by_kind["CountVectorizerModel"].vocabulary, by_kind["ElementwiseProduct"].getScalingVec().toArray()
    fitted = by_kind["LogisticRegressionModel"]
    labels = classifier.class_labels(model)
    con = duckdb.connect()
    con.register("docs", docs.toArrow())
    con.register("vocab", pa.table({"term": terms, "idf": idf}))
    weights = fitted.coefficientMatrix.toArray()
    con.register("coef", pa.table({"label": np.repeat(labels, len(terms)), "term": list(terms) * len(labels), "b": weights.ravel()}))
    con.register("base", pa.table({"label": labels, "b0": fitted.interceptVector.toArray()}))
    want = con.execute(f"""
        WITH ws AS (SELECT id, regexp_extract_all(lower(text), '{fixed.TOKEN_PATTERN}') AS w FROM docs),
        found AS (SELECT id, unnest(w) AS term FROM ws UNION ALL
                  SELECT id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM ws),
        tf AS (SELECT id, term, count(*) * any_value(idf) AS x FROM found JOIN vocab USING (term) GROUP BY id, term),
        unit AS (SELECT id, term, x / sqrt(sum(x * x) OVER (PARTITION BY id)) AS x FROM tf),
        raw AS (SELECT id, label, any_value(b0) + sum(x * b) AS z FROM unit JOIN coef USING (term) JOIN base USING (label) GROUP BY id, label)
        SELECT id, label, exp(z) / sum(exp(z)) OVER (PARTITION BY id) FROM raw""").fetchall()
    assert len(want) == len(got) == 180
    for i, label, p in want:
        assert got[i, label] == pytest.approx(p, abs=1e-9)


def test_three_models_in_one_report(spark):
    docs = themed(spark).withColumn("true_label", F.when(F.col("label") == "a", "pos").when(F.col("label") == "b", "neg").otherwise("neu"))
    lex = spark.createDataFrame([("sun", 2.0), ("goal", -2.0)], "token string, valence double")
    model = classifier.train(docs, "text", "true_label", max_features=60)
    judged = classifier.predict(docs, model).withColumn("tfidf_logreg", F.col("sentiment.label"))
    weak = sentiment.weak_labels(docs, lex, id_col="id").select("id", F.col("compound_label").alias("compound"), F.col("polarity_label").alias("polarity"))
    pairs = evaluation.stack_predictions(judged.join(weak, "id"), "true_label", ["compound", "polarity", "tfidf_logreg"])
    report = {(r["model"], r["label"]): r for r in evaluation.classification_report(pairs).collect()}
    assert {m for m, _ in report} == {"compound", "polarity", "tfidf_logreg"}
    assert report["tfidf_logreg", "accuracy"]["f1"] == 1.0 and report["compound", "accuracy"]["f1"] > 0.8


def test_classifier_features_equal_the_long_form(spark):
    docs = themed(spark, 12)
    model = classifier.train(docs, "text", "label", max_features=20, max_iter=5)
    named = docs.withColumn(classifier.INPUT, F.col("text"))
    from pyspark.ml import PipelineModel

    made = PipelineModel(model.stages[:-2]).transform(named).select("id", "features").collect()
    vectors, _ = features.tfidf(docs, "id", "text", (), 20, 1)
    want = {r["id"]: {x["term_id"]: x["weight"] for x in r["features"]} for r in vectors.collect()}
    for r in made:
        got = dict(zip(map(int, r["features"].indices), r["features"].values, strict=True))
        assert got == pytest.approx(want[r["id"]])


def test_first_score_wins(spark):
    done = spark.createDataFrame([("a", "pos")], "id string, label string")
    fresh = spark.createDataFrame([("a", "neg"), ("b", "neu")], "id string, label string")
    got = sorted(tuple(r) for r in enrichment.keep_first(done, fresh).collect())
    assert got == [("a", "pos"), ("b", "neu")]


def test_scores_are_the_same_however_a_batch_is_cut(spark):
    """A task gets whole texts, not lists of their words, and holds the words of a few at a time."""
    texts = ["good", None, "", " 　", "x " * 400 + "Good", "ÉGOOD bad", "no good_ good-bad ГОД like", "GOOD İ bad!", "\x1cgreat great"] * 3
    words = {w: v for w, v in LEXICON}
    sums = []
    for size in (1, 40, 1 << 20):
        blocks = list(tokens.blocks(pa.array(texts), size))
        assert [t for b in blocks for t in b.to_pylist()] == texts
        assert size > 40 or len(blocks) > 5
        scorer = sentiment.Scorer(words, sentiment.Rules(), {})
        sums.append(np.concatenate([scorer.scores(b)[0] for b in blocks]).tolist())
    assert sums[0] == sums[1] == sums[2]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = dict(map(tuple, sentiment.mean_polarity(docs, lexicon(spark)).collect()))
    assert [got[i] for i in range(9)] == pytest.approx([1.9, 0, 0, 0, 1.9, -2.5, (-1.2 + 1.9 - 2.5 + 1.5) / 4, (1.9 - 2.5) / 2, 3.1])


def test_terms_are_counted_in_blocks_not_row_by_row(spark, monkeypatch):
    """a term of several rows of a block leaves its task once, with its row and word counts."""
    texts = pa.array(["a1 b2 the a1 b2", "b2 é_x a1", "", None, "x the a1-b2"])
    stop = pa.array(["the"], pa.string())
    got = {r["term"]: (r["df"], r["cf"]) for r in features._block_totals(texts, stop, 2).to_pylist()}
    want = {"a1": (3, 4), "b2": (3, 4), "é_x": (1, 1), "a1 b2": (2, 3), "b2 a1": (1, 1), "b2 é_x": (1, 1), "é_x a1": (1, 1)}
    assert got == want
    docs = spark.createDataFrame([(t,) for t in texts.to_pylist()], "text string").coalesce(1)
    for size in (1, 1 << 20):
        monkeypatch.setattr(features, "BLOCK", size)
        totals = features.term_totals(docs, "text", ["the"])
        assert {r.term: (r.df, r.cf) for r in totals.collect()} == want
