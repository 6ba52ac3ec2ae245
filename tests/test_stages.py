"""The stages over a small planted table in the hospital layout, and model invariants."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge import constants as K
from tabforge.operators import experiments as X
from tabforge.operators import neighbors
from tabforge.operators.learners import LEARNERS
from tabforge.plans import stages


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(400):
        r = {c: "No" for c in K.RAW_COLUMNS}
        stay = int(rng.integers(1, 15))
        r |= {
            "encounter_id": i, "patient_nbr": i // 2 if i < 100 else i, "race": rng.choice(["Caucasian", "Other", "?"]),
            "gender": "Unknown/Invalid" if i == 7 else rng.choice(["Male", "Female"]), "age": rng.choice(K.AGE_BANDS), "weight": "?",
            "admission_type_id": int(rng.integers(1, 9)), "discharge_disposition_id": 11 if i in (0, 20) else int(rng.integers(1, 8)),
            "admission_source_id": int(rng.integers(1, 26)), "time_in_hospital": stay, "payer_code": "?", "medical_specialty": "?",
            "num_lab_procedures": int(rng.integers(1, 90)), "num_procedures": int(rng.integers(0, 7)), "num_medications": stay * 2 + int(rng.integers(0, 5)),
            "number_outpatient": int(rng.integers(0, 3)), "number_emergency": int(rng.integers(0, 3)), "number_inpatient": int(rng.integers(0, 3)),
            "number_diagnoses": int(rng.integers(1, 10)), "diag_1": rng.choice(["250.1", "V45", "?", "410"]), "diag_2": "486", "diag_3": rng.choice(["E880", "780"]),
            "max_glu_serum": "None", "A1Cresult": "None", "insulin": rng.choice(["No", "Up", "Steady"]), "metformin": "Up" if i % 70 == 0 else "No",
            "change": rng.choice(["Ch", "No"]), "diabetesMed": rng.choice(["Yes", "No"]), "readmitted": rng.choice(["<30", ">30", "NO"], p=[0.2, 0.4, 0.4]),
        }
        rows.append(r)
    path = tmp_path_factory.mktemp("raw") / "raw.csv"
    path.write_text(",".join(K.RAW_COLUMNS) + "\n" + "\n".join(",".join(str(r[c]) for c in K.RAW_COLUMNS) for r in rows) + "\n")
    return stages.read_raw(spark, str(path))


@pytest.fixture(scope="module")
def encoded(raw):
    from tabforge.session import materialize

    return materialize(stages.preprocess(raw), "encoded")


def test_explore_tables(raw):
    out = stages.explore(raw)
    summary = {r.column: r for r in out["column_summary"].collect()}
    assert summary["weight"].n_missing == 400 and summary["max_glu_serum"].n_missing == 400 and summary["encounter_id"].n_unique == 400
    assert out["repeat_persons"].first().n_multi == 50
    assert out["excluded"].first().n_excluded == 2
    found = {(r.rule, r.column) for r in out["quality"].collect()}
    assert {("high_missing", "weight"), ("near_constant", "examide"), ("identifier", "patient_nbr"), ("invalid_rows", "gender")} <= found
    assert sum(r.n for r in out["diagnoses"].filter("column = 'diag_1'").collect()) == 400


def test_preprocess_keeps_first_surviving_row_and_is_numeric(encoded):
    ids = {r.encounter_id for r in encoded.select("encounter_id").collect()}
    # 0 and 20 are excluded, so their persons keep 1 and 21; 7 is invalid, its person keeps 6
    assert {1, 21, 6, 2} <= ids and not {0, 20, 7, 3} & ids and len(ids) == 350
    assert all(t in ("int", "bigint", "double") for _, t in encoded.dtypes)
    assert "insulin" in encoded.columns and "metformin" not in encoded.columns and "examide" not in encoded.columns
    assert {"diag_1_cat_Diabetes", "diag_1_cat_Unknown", "race_Unknown", "admission_source_Unknown", "lab_per_day"} <= set(encoded.columns)
    assert encoded.filter(F.col("early_readmit").isNull()).count() == 0


def test_mining_stage(encoded):
    flags = stages.transactions(encoded)
    assert "early_readmit" in flags.columns and "num_medications_high" in flags.columns and "diag_2_cat_Respiratory" not in flags.columns
    out = stages.mine(flags, min_support=0.2)
    top = out["association_rules_top50"].first()
    assert top.lift >= 1 and top.confidence >= 0.5
    assert [r.n_itemsets for r in out["sensitivity"].orderBy("min_support").collect()] == sorted((r.n_itemsets for r in out["sensitivity"].collect()), reverse=True)


def test_classify_and_regress_stages(encoded):
    fast = [e for e in X.CLASSIFIERS if e.name in ("naive_bayes", "tree_depth5")]
    out = stages.classify(encoded, fast, trees=5)
    assert {r.published for r in out["classification_results"].collect()} == {"EXP03_NaiveBayes_GaussianNB", "EXP04_DecisionTree_depth5"} and out["significance"].first().n <= 5
    lines = [e for e in X.REGRESSORS if e.name in ("least_squares_all", "ridge_1_all")]
    out = stages.regress(encoded, lines, trees=5)
    best = out["regression_results"].first()
    assert best.mae < 1.0 and best.r2 > 0.8  # the stay is planted in num_medications


def test_smote_balances_and_stays_inside_the_box(spark):
    rng = np.random.default_rng(7)
    rows = [(i, float(a), float(b), int(i < 8)) for i, (a, b) in enumerate(rng.normal(size=(40, 2)))]
    df = spark.createDataFrame(rows, "id long, a double, b double, y int")
    made = neighbors.smote(df, "id", ["a", "b"], "y", 5).collect()
    small = np.array([r[1:3] for r in rows if r[3] == 1])
    assert len(made) == 24 and {r.y for r in made} == {1}
    assert all(small[:, 0].min() <= r.a <= small[:, 0].max() and small[:, 1].min() <= r.b <= small[:, 1].max() for r in made)


def test_linear_penalties_match_their_closed_forms(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(200, 2))
    x = (x - x.mean(axis=0)) / x.std(axis=0)
    y = 3 + x @ [2.0, -1.0] + rng.normal(size=200)
    df = spark.createDataFrame([(i, float(t), float(a), float(b)) for i, (t, (a, b)) in enumerate(zip(y, x))], "id long, y double, a double, b double")
    for alpha in (0.0, 10.0):
        beta = np.linalg.solve(x.T @ x + alpha * np.eye(2), x.T @ (y - y.mean()))
        got = {r.id: r.pred for r in LEARNERS["ridge"](df, df, ["a", "b"], {"alpha": alpha}).collect()}
        assert [got[i] for i in range(200)] == pytest.approx(list(y.mean() + x @ beta), abs=1e-6)


def test_balanced_forest_perceptron_and_boosting_run(spark):
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(i, float(v), float(w), int(v > 0.8)) for i, (v, w) in enumerate(rng.normal(size=(120, 2)))], "id long, a double, b double, y int")
    small = [
        X.Experiment("forest", "forest", {"trees": 5, "depth": 4}, "all", "weights"),
        X.Experiment("boosted", "boosted", {"trees": 3, "rate": 0.1, "depth": 2, "rows": 0.8, "columns": 0.8}, "all", "scale"),
        X.Experiment("nearest", "nearest", {"k": 3}, "all", "smote"),
        X.Experiment("svm", "calibrated_svm", {"c": 1.0, "iterations": 5}, "all", "smote"),
    ]
    predictions, counts = X.cross_validate(df, "id", "y", ["a", "b"], small, classify=True, folds=2)
    assert predictions.count() == 4 * 120
    table = {r.experiment: r for r in X.classification_summary(X.classification_folds(predictions), counts).collect()}
    assert table["forest"].roc_auc > 0.9 and table["nearest"].roc_auc > 0.8 and table["svm"].roc_auc > 0.8
