"""Sources and sinks on files the tests write themselves (FIXTURES 1-2)."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from quarry import sources
from quarry.operators import aggregates as agg
from quarry.operators import filters as flt

CARS_HEADER = "MAKE,FUELTYPE,ASPIRE,DOORS,BODY,DRIVE,CYLINDERS,HP,RPM,MPG-CITY,MPG-HWY,PRICE"
CARS = [
    "toyota,gas,std,four,sedan,fwd,four,90,4150,31,37,9120",
    "toyota,gas,std,two,hatchback,fwd,four,64,4700,36,41,5610",
    "belmont,gas,std,four,sedan,rwd,six,180,5300,15,23,40250",
    "belmont,gas,std,two,sedan,rwd,four,102,5900,24,28,16990",
    "corvin,gas,turbo,four,wagon,rwd,four,162,5250,18,21,19300",
]
CAR_SCHEMA = StructType(
    [StructField(n, StringType()) for n in ["MAKE", "FUELTYPE", "ASPIRE", "DOORS", "BODY", "DRIVE",
                                            "CYLINDERS"]]
    + [StructField(n, IntegerType()) for n in ["HP", "RPM", "MPG_CITY", "MPG_HWY", "PRICE"]])


def write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_text_lines_header_in_every_file(spark, tmp_out):
    write(f"{tmp_out}/cars/a.csv", [CARS_HEADER, *CARS[:3]])
    write(f"{tmp_out}/cars/b.csv", [CARS_HEADER, *CARS[3:]])
    lines = sources.read_lines(spark, f"{tmp_out}/cars")
    assert lines.count() == 7
    data = flt.drop_header(lines, "value", CARS_HEADER)
    assert data.count() == 5  # both header copies removed (P6)
    assert flt.where_contains(data, "value", "toyota").count() == 2  # P5
    assert flt.where_not_contains(lines, "value", "FUELTYPE").count() == 5  # P7


def test_csv_header_typed_with_rejects(spark, tmp_out):
    bad = "doric,gas,std,two,wagon,fwd,six,?,5150,21,27,14400"
    write(f"{tmp_out}/cars.csv", [CARS_HEADER, *CARS, bad])
    df = sources.read_delimited(spark, f"{tmp_out}/cars.csv", CAR_SCHEMA, header=True)
    good = sources.valid_rows(df)
    rejects = sources.reject_rows(df)
    assert good.count() == 5 and rejects.count() == 1
    assert rejects.first()._reject == "bad HP"
    # A6 on the typed frame: integer average HP per make
    avg = {r.MAKE: r.avg for r in agg.int_avg_by_key(good, "MAKE", F.col("HP")).collect()}
    assert avg == {"toyota": 77, "belmont": 141, "corvin": 162}
    # P2/S12 via SQL with a bound parameter
    sources.register_view(good, "cars_t")
    assert sources.run_sql(spark, "SELECT * FROM cars_t WHERE HP > :hp", {"hp": 150}).count() == 2


def test_semicolon_and_headerless(spark, tmp_out):
    write(f"{tmp_out}/bank.csv", ["age;marital;balance", "30;married;1787", "33;single;x"])
    schema = StructType([StructField("age", IntegerType()), StructField("marital", StringType()),
                         StructField("balance", DoubleType())])
    df = sources.read_delimited(spark, f"{tmp_out}/bank.csv", schema, sep=";", header=True)
    assert sources.valid_rows(df).count() == 1 and sources.reject_rows(df).count() == 1
    write(f"{tmp_out}/ratings.txt", ["1001,1,4", "1001,2,9", "1002,1,x"])
    rs = StructType([StructField("user", IntegerType()), StructField("item", IntegerType()),
                     StructField("rating", DoubleType())])
    r = sources.read_delimited(spark, f"{tmp_out}/ratings.txt", rs)
    assert sources.valid_rows(r).count() == 2


def test_json_lines_and_json_strings(spark, tmp_out):
    write(f"{tmp_out}/staff.json", [
        '{"name": "a", "gender": "male", "deptid": "100", "age": "40", "salary": "3000"}',
        '{"name": "b", "gender": "female", "deptid": "200", "age": "30", "salary": "5500"}',
        "not json"])
    schema = "name string, gender string, deptid string, age string, salary string"
    staff = sources.read_json_lines(spark, f"{tmp_out}/staff.json",
                                    StructType.fromJson(spark.createDataFrame([], schema).schema.jsonValue()))
    assert sources.reject_rows(staff).count() == 1
    ok = sources.valid_rows(staff)
    assert flt.where_equals(ok, "age", 40, cast="int").count() == 1  # P3, text against a number
    depts = spark.createDataFrame([("{'name': 'Harbour', 'id': '31'}",), ("{'id':'47',  'name':'Orchard'}",)], "j string")
    parsed = sources.parse_json_column(depts, "j", "name string, id string").select("j.*")
    assert sorted(r.id for r in parsed.collect()) == ["31", "47"]


def test_typed_projection_keeps_rejects(spark):
    df = spark.createDataFrame([("1", "2.5"), ("x", "3"), (None, "4")], "a string, b string")
    out = sources.typed_projection(df, {"a": (F.col("a"), "int"), "b": (F.col("b"), "double")})
    assert sources.valid_rows(out).count() == 2  # null input is not a reject
    assert [r._reject for r in sources.reject_rows(out).collect()] == ["bad a"]


def test_text_sink_fails_if_exists_and_round_trips(spark, tmp_out):
    lines = spark.createDataFrame([(x,) for x in CARS], "value string").repartition(2)
    out = f"{tmp_out}/written"
    sources.write_text(lines, out)
    with pytest.raises(AnalysisException):
        sources.write_text(lines, out)
    back = sources.read_lines(spark, out)
    assert sorted(r.value for r in back.collect()) == sorted(CARS)


def test_partitioned_table_sink_prunes(spark, tmp_out):
    df = spark.createDataFrame([(m, i) for i, m in enumerate(["a", "b", "a"])], "make string, i int")
    sources.write_table(df, f"{tmp_out}/t", partition_by=["make"])
    back = spark.read.parquet(f"{tmp_out}/t").where("make = 'a'")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(make" in plan and back.count() == 2


def test_jdbc_embedded_derby(spark, tmp_out):
    """S9 through an in-memory Derby database inside this JVM (no port)."""
    url = "jdbc:derby:memory:quarrydb;create=true"
    jvm = spark._jvm
    conn = jvm.java.sql.DriverManager.getConnection(url)
    st = conn.createStatement()
    st.executeUpdate("CREATE TABLE demotable (id INT, name VARCHAR(20))")
    for i in range(10):
        st.executeUpdate(f"INSERT INTO demotable VALUES ({i}, 'n{i}')")
    conn.close()
    df = sources.read_jdbc(spark, url, "demotable", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"},
                           partition_column="ID", lower_bound=0, upper_bound=10, num_partitions=3)
    assert df.rdd.getNumPartitions() == 3
    assert df.count() == 10 and df.agg(F.sum("ID")).first()[0] == 45


def test_csv_round_trip_loses_nothing(spark, tmp_out):
    rows = [(1, " pad "), (2, ""), (3, None), (4, 'say "so", twice'), (5, "back\\slash\\"), (6, "a;b,c|d"), (7, "\ttab\t"), (8, "#x"), (9, '"')]
    df = spark.createDataFrame(rows, "i int, s string")
    for sep in (",", ";"):
        for header in (True, False):
            path = f"{tmp_out}/t{ord(sep)}{header}"
            sources.write_delimited(df, path, sep=sep, header=header)
            back = sources.read_delimited(spark, path, df.schema, sep=sep, header=header)
            assert sorted(tuple(r) for r in sources.valid_rows(back).collect()) == rows
            assert sources.reject_rows(back).count() == 0
    with pytest.raises(Exception, match="line break"):
        sources.write_delimited(spark.createDataFrame([(1, "a\nb")], "i int, s string"), f"{tmp_out}/broken")
