"""The studied programs as plans, on hand-made rows (FIXTURES 1-5)."""

import random

from pyspark.sql import functions as F

from quarry.plans import programs as pg
from tests.test_sources import CARS, CARS_HEADER


def lines(spark, xs, parts=2):
    return spark.createDataFrame([(x,) for x in xs], "value string").repartition(parts)


def test_cars_metrics_and_cleanse(spark):
    df = lines(spark, [CARS_HEADER, *CARS, CARS_HEADER])  # a second header copy (another file)
    m = pg.cars_metrics(df, CARS_HEADER)
    assert m["lines"].first().n == 7 and m["data_lines"].first().n == 5
    assert tuple(m["body_counts"].first()) == (3, 1)
    assert m["avg_mpg_city"].first().avg == (31 + 36 + 15 + 24 + 18) // 5
    assert {r.make: r.avg for r in m["avg_hp_by_make"].collect()} == {"toyota": 77, "belmont": 141, "corvin": 162}
    assert sorted(r.make for r in m["makes"].collect()) == ["belmont", "corvin", "toyota"]
    assert m["toyota_lines"].first().n == 2 and m["toyota_words"].first().n == 24
    shortest = min(CARS, key=lambda s: (len(s), s))
    assert m["shortest"].first().shortest == shortest
    clean = sorted(r.value for r in pg.cars_cleansed(df, CARS_HEADER).collect())
    assert clean[0].split(",")[3] in ("2", "4") and all(r.split(",")[5].isupper() for r in clean)
    assert "toyota,gas,std,4,sedan,FWD,four,90,4150,31,37,9120" in clean
    assert "toyota,gas,std,2,hatchback,FWD,four,64,4700,36,41,5610" in clean
    tabs = pg.cars_tab_separated(df).first().value
    assert "," not in tabs and "\t" in tabs


def test_cars_clustering(spark):
    rnd = random.Random(4)
    rows = [CARS_HEADER]
    for i in range(80):
        big = i % 2
        rows.append(f"m{i},gas,std,{'four' if big else 'two'},{'sedan' if big else 'hatchback'},fwd,four,"
                    f"{150 + rnd.randint(0, 9) if big else 60 + rnd.randint(0, 9)},5000,"
                    f"{18 if big else 35},25,9000")
    cars = pg.cars_for_clustering(lines(spark, rows))
    assert cars.count() == 80
    out = pg.cluster(cars, ["DOORS", "BODY", "HP", "RPM", "MPG"], k=4, seed=1)
    sizes = out["sizes"].collect()
    assert sum(r["count"] for r in sizes) == 80 and len(sizes) <= 4


def test_fuel_regression_with_imputed_hp(spark):
    rnd = random.Random(5)
    rows = ["MPG,CYLINDERS,DISPLACEMENT,HORSEPOWER,WEIGHT,ACCELERATION,MODELYEAR,NAME"]
    for i in range(120):
        cyl, acc, year = rnd.choice([4, 6, 8]), rnd.uniform(8, 20), rnd.randint(70, 82)
        hp_text = "?" if i % 20 == 0 else str(rnd.randint(60, 200))
        hp = 80.0 if hp_text == "?" else float(hp_text)
        mpg = 50 - 2 * cyl - 0.1 * hp + 0.5 * acc + 0.2 * (year - 70)
        rows.append(f"{mpg},{cyl},100,{hp_text},3000,{acc},{year},car {i}")
    fuel = pg.fuel_frame(lines(spark, rows))
    assert fuel.where(F.col("HP") == 80.0).count() >= 6  # the '?' rows
    corr, model, r2 = pg.fuel_regression(fuel)
    assert abs(model.coefficients[1] + 0.1) < 1e-6 and abs(model.coefficients[0] + 2) < 1e-6
    assert r2.first().r2 > 0.999999
    assert {r.field for r in corr.collect()} == {"CYLINDERS", "HP", "ACCELERATION", "MODELYEAR", "MPG"}


def test_iris_tree_ties_alphabetical(spark):
    rnd = random.Random(6)
    rows = ["Sepal.Length,Sepal.Width,Petal.Length,Petal.Width,Species"]
    for sp, petal in [("setosa", 1.5), ("versicolor", 4.5), ("virginica", 6.0)]:
        for _ in range(50):
            rows.append(f"{5 + rnd.random():.2f},{3 + rnd.random():.2f},{petal + rnd.random() / 5:.2f},"
                        f"{petal / 3 + rnd.random() / 10:.2f},{sp}")
    out = pg.iris_tree(pg.iris_frame(lines(spark, rows)))
    index = {r.SPECIES: r.INDEXED for r in out["index"].collect()}
    assert index == {"setosa": 0.0, "versicolor": 1.0, "virginica": 2.0}  # all tie at 50
    assert out["accuracy"].first().accuracy > 0.95
    assert out["model"].depth <= 2


def test_bank_indicators_exact_and_forest(spark):
    rnd = random.Random(7)
    header = '"age";"job";"marital";"education";"default";"balance";"housing";"loan";"contact";"day";' \
             '"month";"duration";"campaign";"pdays";"previous";"poutcome";"y"'
    rows = [header]
    for i in range(200):
        marital = rnd.choice(["single", "married", "divorced"])
        edu = rnd.choice(["primary", "secondary", "tertiary", "unknown"])
        y = "yes" if marital == "single" and edu == "tertiary" else "no"
        rows.append(f'{20 + i % 50};"job";"{marital}";"{edu}";"no";{rnd.randint(-100, 5000)};"yes";'
                    f'"{rnd.choice(["yes", "no"])}";"cell";5;"may";100;1;-1;0;"unknown";"{y}"')
    bank = pg.bank_frame(lines(spark, rows), header)
    assert bank.count() == 200
    unknown = bank.where("PRIMARY + SECONDARY + TERTIARY = 0").count()
    assert unknown == sum(1 for r in rows[1:] if '"unknown";"no";' in r.split('"job";')[1][:40])
    # polarity: OUTCOME is 1.0 for "no" by default
    assert bank.agg(F.sum("OUTCOME")).first()[0] == sum(1 for r in rows[1:] if r.endswith('"no"'))
    out = pg.bank_forest(bank)
    assert out["accuracy"].first().accuracy > 0.7
    assert out["correlations"].count() == len(pg.BANK_FEATURES)


def test_messages_with_commas(spark):
    rnd = random.Random(8)
    rows = ["type,text"]
    for i in range(200):
        spam = i % 2 == 0
        words = ["win", "cash", "prize", "now"] if spam else ["see", "you", "at", "lunch"]
        rows.append(("spam," if spam else "ham,") + ", ".join(rnd.choice(words) for _ in range(6)))
    msgs = pg.message_frame(lines(spark, rows))
    first = msgs.where("LABEL = 1.0").first().MESSAGE
    assert first.count(",") == 5  # the whole message, commas included
    out = pg.message_bayes(msgs)
    assert out["accuracy"].first().accuracy == 1.0


def test_ratings_duplicates_and_cold_start(spark):
    rows = [f"{u},{i},{(u * i) % 10 + 1}" for u in range(1, 7) for i in range(1, 14) if (u + i) % 3]
    rows += ["1,1,2", "1,1,4", "x,1,3"]  # a repeated pair and a bad row
    ratings = pg.ratings_frame(lines(spark, rows))
    assert abs(ratings.where("user = 1 AND item = 1").first().rating - 8 / 3) < 1e-12  # rated 2, 2, 4
    assert ratings.where("user IS NULL").count() == 0
    model, pred = pg.ratings_als(ratings, rank=3, max_iter=5)
    assert pred.where(F.isnan("prediction")).count() == 0
