import random

from pyspark.sql import functions as F

from pulsegrid.operators import grading
from pulsegrid.sources import tables


def diets(n=100):
    """Rows in the shape of the labelled diet file: five grades along the calorie balance."""
    rng = random.Random(4)
    rows = []
    for i in range(n):
        grade = 1 + i % 5
        rows.append((-900 + 400 * grade + rng.randint(-80, 80), rng.randint(100, 300),
                     rng.randint(30, 90), rng.randint(80, 240), round(rng.random(), 2),
                     round(rng.random() * 2, 2), round(rng.random() * 30, 2), grade))
    return rows


COLUMNS = [*grading.FEATURES, "GRADE"]


def test_train_save_predict(spark, tmp_path):
    csv = tmp_path / "graded.csv"
    lines = [",".join(COLUMNS)] + [",".join(map(str, r)) for r in diets()]
    csv.write_bytes("\r\n".join(lines).encode() + b"\r\n")
    graded = tables.read_graded_csv(spark, str(csv))
    assert graded.columns == COLUMNS and graded.count() == 100
    assert graded.filter("GRADE is null").count() == 0

    model = grading.train_grader(graded, max_iterations=100)
    scored = grading.predict_grade(model, graded.withColumn("GIVEN", F.col("GRADE")))
    right = scored.filter("GRADE = GIVEN").count()
    assert right >= 85 and scored.count() == 100

    again = grading.train_grader(graded, max_iterations=100)
    assert grading.predict_grade(again, graded).collect() == grading.predict_grade(
        model, graded).collect()

    path = grading.register_model(spark, model, str(tmp_path / "models"), "NEUTRAL")
    grading.register_model(spark, model, str(tmp_path / "models"), "SECOND")
    assert path.endswith("NEUTRAL")
    names = spark.read.parquet(str(tmp_path / "models" / "model_list"))
    assert sorted(r.MODEL_NAME for r in names.collect()) == ["NEUTRAL", "SECOND"]
    loaded = grading.load_model(str(tmp_path / "models"), "NEUTRAL")
    one = spark.createDataFrame([(1500.0, 1900.0, 200.0, 10.0, 1.0, 1.0, 1.0, 1.0)],
                                ["EATEN", "BURNED", *grading.FEATURES[1:]])
    one = grading.with_calorie_difference(one, F.col("EATEN"), F.col("BURNED"))
    assert grading.predict_grade(loaded, one).first().GRADE in (1, 2)


def test_only_the_named_diet_is_used_and_grades_may_have_gaps(spark):
    rows = [(*r[:7], 1 if r[0] < 300 else 4, "X") for r in diets(40)]
    rows += [(*r[:7], 5, "Y") for r in diets(10)]
    graded = spark.createDataFrame(rows, [*COLUMNS, "DIET_NAME"])
    model = grading.train_grader(graded, "X", max_iterations=30)
    grades = {r.GRADE for r in grading.predict_grade(model, graded).collect()}
    assert grades <= {1, 4}
    gap = graded.limit(1).withColumn("SUGAR", F.lit(None).cast("double"))
    assert [r.GRADE for r in grading.predict_grade(model, gap).collect()] == [None]
