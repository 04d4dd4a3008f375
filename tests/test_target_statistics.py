import hashlib
import random

import pytest
from pyspark.sql import functions as F

from leakwatch.operators import metrics
from leakwatch.operators.model import BoostParams, load_model, predict, save_model
from leakwatch.operators.target_statistics import fit_target_encoder, ordered_statistics
from leakwatch.plans import training

COLUMNS = ["c", "d"]


def rows_of(n=400, seed=4):
    r = random.Random(seed)
    # Value "hot" holds a third of all rows; ids repeat, also with other values; nulls in every column.
    rows = [(i, r.choice(["hot", None, *(f"v{k}" for k in range(20))]) if r.random() > 0.33 else "hot", r.choice(["x", "y", None]), r.choice([0, 1])) for i in range(n)]
    rows += [(5, "hot", "x", 1), (5, "hot", "x", 1), (6, "v1", "x", 0), (None, "hot", "x", 1), (7000, "v2", "y", None)]
    return rows


def brute_force(rows, prior=0.5, weight=1.0, seed=42):
    place = lambda i: hashlib.md5(f"{seed}/{i}".encode()).hexdigest()
    known = [r for r in rows if r[0] is not None and r[3] is not None]
    out = []
    for i, c, d, y in rows:
        codes = []
        for k, v in ((1, c), (2, d)):
            same = [r for r in known if r[k] == v and (i is None or y is None or place(r[0]) < place(i))]
            codes.append((sum(r[3] for r in same) + weight * prior) / (len(same) + weight))
        out.append((i, c, d, y, *codes))
    return sorted(out, key=str)


def rounded(rows):
    return sorted(((*r[:4], *(round(x, 12) for x in r[4:])) for r in rows), key=str)


@pytest.mark.parametrize("rows_per_range", [1_000_000, 50])
def test_equals_brute_force(spark, rows_per_range):
    rows = rows_of()
    df = spark.createDataFrame([(*r, 9.0) for r in rows], "Action_ID long, c string, d string, Risk_Label long, c_code double").repartition(3)
    encoder = fit_target_encoder(df, COLUMNS)
    got = ordered_statistics(df, encoder, rows_per_range=rows_per_range).select("Action_ID", "c", "d", "Risk_Label", "c_code", "d_code")
    assert rounded(map(tuple, got.collect())) == rounded(brute_force(rows))


def test_no_code_uses_the_rows_own_label(spark):
    rows = [r for r in rows_of(120) if r[3] is not None and r[0] is not None]
    schema = "Action_ID long, c string, d string, Risk_Label long"

    def codes(data):
        df = spark.createDataFrame(data, schema)
        return {r.Action_ID: (r.c_code, r.d_code) for r in ordered_statistics(df, fit_target_encoder(df, COLUMNS)).collect()}

    before = codes(rows)
    for k in (3, 40, 77):
        changed = [(i, c, d, 1 - y if i == rows[k][0] else y) for i, c, d, y in rows]
        assert codes(changed)[rows[k][0]] == before[rows[k][0]]


def test_unseen_values_and_empty_training(spark):
    schema = "Action_ID long, c string, d string, Risk_Label long"
    df = spark.createDataFrame([(1, "a", None, 1), (2, "a", "x", 1)], schema)
    encoder = fit_target_encoder(df, COLUMNS)
    got = {r.c: (r.c_code, r.d_code) for r in encoder.encode(spark.createDataFrame([(3, "a", None, None), (4, "new", "new", None)], schema)).collect()}
    assert got == {"a": (2.5 / 3, 0.75), "new": (0.5, 0.5)}
    empty = spark.createDataFrame([], schema)
    nothing = fit_target_encoder(empty, COLUMNS)
    assert {tuple(r)[-2:] for r in nothing.encode(df).collect()} == {(0.5, 0.5)}
    assert ordered_statistics(empty, nothing).count() == 0


def test_many_values_beat_ordinal_codes_and_survive_saving(spark, tmp_path):
    """A column of 300 values, each with a risk of its own: order by name says nothing."""
    r = random.Random(1)
    risk = {f"user{r.random()}": r.random() for _ in range(300)}
    rows = []
    for i in range(6000):
        user = r.choice(list(risk))
        rows.append((i, user, int(r.random() < risk[user]), r.random(), ("train", "train", "train", "test")[i % 4]))
    df = spark.createDataFrame(rows, "Action_ID long, who string, Risk_Label long, noise double, split string").repartition(4).checkpoint()
    auc = {}
    for codes in ("ordinal", "statistics"):
        rows_ = df.where("split = 'train'")
        coded = training.training_codes(rows_, codes, ["who"])
        model = training.fit_classifier(rows_, BoostParams(max_iter=10), numeric=["noise"], **coded)
        pred = predict(model, df.where("split = 'test'"))
        auc[codes] = metrics.auc_roc(pred.select(F.col("Risk_Label").cast("int").alias("label"), F.col("raw_prob").alias("score"))).first()[0]
    assert auc["statistics"] > 0.75 > auc["ordinal"] + 0.05, auc
    save_model(model, str(tmp_path / "m"))
    again = predict(load_model(str(tmp_path / "m")), df).agg(F.sum("raw_prob")).first()[0]
    assert again == pytest.approx(predict(model, df).agg(F.sum("raw_prob")).first()[0])
