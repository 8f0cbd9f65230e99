"""Contracts, validation, readers, writers, ingestion, splits and encodings."""

import pytest
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.sql import functions as F

from lendframe.operators import contracts as K
from lendframe.operators import encode as E
from lendframe.operators import metrics as M
from lendframe.operators import models as X
from lendframe.operators import profile as P
from lendframe.operators import splits as S
from lendframe.sources import ingest as I
from lendframe.sources import tables as T


def checks(df):
    return {(r["column"], r["check"]) for r in df.collect()}


def test_nullability_excludes_null_rate(spark):
    df = spark.range(100).select(F.nullif("id", F.lit(5)).alias("a"))
    contract = spark.createDataFrame([("t", "a", "bigint", False, 0.0, 0.001, False, None, None, None)], K.COLUMN_CONTRACT)
    assert checks(K.column_checks(df, "t", contract)) == {("a", "nullability")}


@pytest.mark.parametrize("n,bad", [(98, False), (97, True)])
def test_row_count_band(spark, n, bad):
    sizes = spark.createDataFrame([("t", None, 100, 0.02)], K.TABLE_CONTRACT)
    assert bool(K.row_count_check(spark.range(n), "t", sizes).count()) is bad


def test_orphan_rate_counts_keys_not_rows(spark):
    child = spark.createDataFrame([(1,), (2,), (3,), (3,)], "k int")
    parent = spark.createDataFrame([(1,), (2,)], "p int")
    row = P.join_stats(child, parent, "k", "p").first()
    assert row["orphan_rate"] == round(1 / 3, 6) and row["child_rows"] == 4


def test_range_tolerance_and_uniqueness(spark):
    df = spark.createDataFrame([(1, 10.2), (1, 0.0)], "k int, v double")
    contract = spark.createDataFrame(
        [("t", "v", "double", True, 0.0, 0.02, False, None, 0.0, 10.0), ("t", "k", "int", True, 0.0, 0.02, True, None, None, None)], K.COLUMN_CONTRACT
    )
    sizes = spark.createDataFrame([("t", "k", 2, 0.02)], K.TABLE_CONTRACT)
    assert checks(K.validate({"t": df}, contract, sizes)[0]) == {("k", "uniqueness")}
    wide = df.withColumn("v", F.col("v") + 0.01)
    assert ("v", "value_range") in checks(K.validate({"t": wide}, contract, sizes)[0])


def test_missing_table_and_unresolvable_join(spark):
    sizes = spark.createDataFrame([("a", None, 1, 0.02), ("b", None, 1, 0.02)], K.TABLE_CONTRACT)
    columns = spark.createDataFrame([("a", "id", "bigint", True, 0.0, 0.02, False, None, None, None)], K.COLUMN_CONTRACT)
    joins = spark.createDataFrame([("a", "id", "zzz", "id", 0.0, 0.02), ("a", "id", "b", "id", 0.0, 0.02)], K.JOIN_CONTRACT)
    violations, count = K.validate({"a": spark.range(1)}, columns, sizes, joins)
    assert {(r["table"], r["check"]) for r in violations.collect()} == {("b", "file_exists"), ("a", "join_tables_resolvable")}
    assert count == 2 and not K.verdict(violations, count).first()["passed"]


def test_contract_from_profile_accepts_its_own_table(spark):
    df = spark.createDataFrame([(i, float(i % 3), "x" if i % 2 else None) for i in range(90)], "SK_ID_BUREAU bigint, v double, s string")
    columns, sizes = K.derive_contracts({"bureau": df, "sample_submission": df})
    rows = {r["feature"]: r for r in columns.collect()}
    assert rows["SK_ID_BUREAU"]["is_unique"] and rows["SK_ID_BUREAU"]["allowed_values"] is None
    assert rows["v"]["allowed_values"] == ["0.0", "1.0", "2.0"] and rows["s"]["nullable"] and rows["s"]["null_rate_reference"] == 0.5
    violations, _ = K.validate({"bureau": df}, columns, sizes)
    assert violations.count() == 0


def test_allowed_numbers_compare_as_numbers(spark):
    """A set frozen from whole numbers accepts them as doubles and the reverse; texts stay texts."""
    whole = spark.createDataFrame([(i, i % 3, str(i % 2)) for i in range(60)], "SK_ID_BUREAU bigint, v bigint, s string")
    contract = K.derive_contracts({"bureau": whole})
    same = whole.withColumn("v", F.col("v").cast("double"))
    assert K.validate({"bureau": same}, *contract)[0].count() == 0
    assert K.validate({"bureau": whole}, *K.derive_contracts({"bureau": same}))[0].count() == 0
    other = same.withColumns({"v": F.when(F.col("v") == 2, 2.5).otherwise(F.col("v")), "s": F.when(F.col("s") == "1", "1.0").otherwise(F.col("s"))})
    assert {(r["check"], r["column"], r["observed"]) for r in K.validate({"bureau": other}, *contract)[0].where("check = 'allowed_values'").collect()} == {("allowed_values", "v", "2.5"), ("allowed_values", "s", "1.0")}


@pytest.mark.parametrize("encoding,text", [("utf-8", "Zoë €"), ("cp1252", "Zoë €"), ("latin-1", "Zo\xeb \x81")])
def test_csv_encodings(spark, tmp_path, encoding, text):
    path = tmp_path / "t.csv"
    path.write_bytes(f"id,name\n1,{text}\n".encode(encoding))
    schema = T.contract_schema([{"feature": "id", "dtype": "bigint", "nullable": False}, {"feature": "name", "dtype": "string", "nullable": True}])
    df, used = T.read_csv(spark, str(path), schema)
    assert used == encoding and df.first()["name"] == text
    assert T.read_columns(spark, str(path), ["id"], schema).columns == ["id"]


def _loans_csv(path, rows, encoding="utf-8"):
    path.mkdir(parents=True, exist_ok=True)
    (path / "part.csv").write_bytes(("v,SK_ID_BUREAU,name\n" + "".join(f"{v},{i},{name}\n" for i, v, name in rows)).encode(encoding))
    return str(path)


@pytest.fixture
def loans(spark):
    df = spark.createDataFrame([(i, float(i % 3), "Zoë" if i % 2 else None) for i in range(50)], "SK_ID_BUREAU bigint, v double, name string")
    return df, K.derive_contracts({"bureau": df}), [(i, float(i % 3), "Zoë" if i % 2 else "") for i in range(50)]


def test_ingestion_publishes_and_records(spark, tmp_path, loans):
    df, contract, rows = loans
    raw = _loans_csv(tmp_path / "raw", rows)
    out = tmp_path / "out"
    recorded = I.fingerprint_table({"bureau": df.select("v", "SK_ID_BUREAU", "name")})
    for run in (False, True):
        m = I.ingest(spark, {"bureau": raw}, str(out), *contract, recorded=recorded).first()
        assert m["rows"] == 50 and m["cols"] == 3 and m["encoding"] == "utf-8" and m["malformed"] == 0 and m["overwrote"] is run
        assert m["input_fingerprint"] == m["output_fingerprint"] == recorded.first()["fingerprint"]
        assert m["size_bytes"] == sum(f.stat().st_size for f in (out / "bureau").glob("part-*"))
        assert m["input_bytes"] == (tmp_path / "raw" / "part.csv").stat().st_size
    published = spark.read.parquet(str(out / "bureau"))
    assert published.dtypes == [("v", "double"), ("SK_ID_BUREAU", "bigint"), ("name", "string")]
    assert sorted(r["SK_ID_BUREAU"] for r in published.where("name = 'Zoë'").collect()) == list(range(1, 50, 2))
    assert [p.name for p in tmp_path.iterdir() if "staging" in p.name or "replaced" in p.name] == []


@pytest.mark.parametrize("encoding,jobs", [("utf-8", 1), ("cp1252", 2)])
def test_ingestion_parses_a_file_once(spark, tmp_path, loans, encoding, jobs, monkeypatch):
    """A second parse only for a file that is not UTF-8."""
    parsed = []
    monkeypatch.setattr(T, "parse_csv", lambda *a, real=T.parse_csv: parsed.append(a) or real(*a))
    _, contract, rows = loans
    m = I.ingest(spark, {"bureau": _loans_csv(tmp_path / "raw", rows, encoding)}, str(tmp_path / "out"), *contract).first()
    assert m["encoding"] == encoding and len(parsed) == jobs
    assert spark.read.parquet(m["path"]).where("name = 'Zoë'").count() == 25
    plan = T.in_encoding(real := T.parse_csv(*parsed[0]), "utf-8").select("v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and real.columns[-1] == I.CORRUPT


def test_ingestion_gates_leave_the_target_alone(spark, tmp_path, loans):
    df, contract, rows = loans
    raw, out = _loans_csv(tmp_path / "raw", rows), str(tmp_path / "out")
    stale = I.fingerprint_table({"bureau": df}).withColumn("fingerprint", F.lit("0"))
    with pytest.raises(I.GateError, match="changed"):
        I.ingest(spark, {"bureau": raw}, out, *contract, recorded=stale)
    assert not (tmp_path / "out").exists()
    I.ingest(spark, {"bureau": raw}, out, *contract)
    before = T.content_fingerprint(spark.read.parquet(f"{out}/bureau")).first()
    for bad, check in ((rows[:10], "row_count"), ([(1, 1.0, "")] * 50, "uniqueness"), ([(i, "x" if i == 7 else v, n) for i, v, n in rows], "row_format")):
        with pytest.raises(I.GateError, match="validation"):
            I.ingest(spark, {"bureau": _loans_csv(tmp_path / f"raw-{check}", bad)}, out, *contract)
        assert check in {r["check"] for r in T.read_violations(spark, f"{out}-violations").collect()}
        assert T.content_fingerprint(spark.read.parquet(f"{out}/bureau")).first() == before


def test_sinks_and_models_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("b", 2.0), ("a", 1.0)], "feature string, gain double")
    assert T.read_parquet(spark, T.write_parquet(df, str(tmp_path / "p")), ["gain"]).columns == ["gain"]
    assert spark.read.json(T.write_json(df, str(tmp_path / "j"))).count() == 2
    T.write_csv(df.coalesce(1), str(tmp_path / "c"), ["feature"])
    assert [r["feature"] for r in spark.read.option("header", True).csv(str(tmp_path / "c")).collect()] == ["a", "b"]
    rows = X.vectors(spark.createDataFrame([(1, 0.0, 0), (2, 1.0, 1), (3, None, 1)], "SK_ID_CURR int, x double, TARGET int"), ["x"])
    model = LogisticRegression(maxIter=2).fit(rows)
    T.save_model(model, str(tmp_path / "m"), {"version": "0.1.0"})
    loaded, meta = T.load_model(spark, str(tmp_path / "m"), LogisticRegressionModel)
    assert meta == {"version": "0.1.0"} and loaded.coefficients == model.coefficients
    hashes = T.file_fingerprints(spark.read.schema("feature string, gain double").json(str(tmp_path / "j"))).collect()
    assert sum(r["rows"] for r in hashes) == 2 and len({r["path"] for r in hashes}) == len(hashes)


def test_fingerprint_sees_where_a_null_is(spark):
    prints = [T.content_fingerprint(spark.createDataFrame(rows, "a int, b int")).first()["fingerprint"] for rows in ([(None, 1), (2, None)], [(1, None), (None, 2)], [(2, None), (None, 1)])]
    assert prints[0] != prints[1] and prints[0] == prints[2]


def test_null_target_is_a_class_of_its_own(spark):
    df = spark.range(400).select(F.col("id").alias("SK_ID_CURR"), F.when(F.col("id") % 10 > 0, (F.col("id") % 4 == 0).cast("int")).alias("TARGET"))
    out = S.stratified_split(df).join(df, "SK_ID_CURR")
    assert out.count() == 400
    assert {(r["split"], r["n"]) for r in out.where("TARGET is null").groupBy("split").agg(F.count("*").alias("n")).collect()} == {("dev", 28), ("val", 6), ("test", 6)}


def test_null_groups_and_scores_are_kept_apart(spark):
    rows = [("a", 0.2, 0), ("a", 0.8, 1), (None, 0.3, 0), (None, 0.6, 1), (None, None, 1), ("a", 0.5, 0)]
    df = spark.createDataFrame(rows, "g string, p double, y int")
    for out in (M.discrimination(df, ["g"], "p", "y"), M.metrics_cube(df, ["g"], "p", "y"), M.reliability(df, ["g"], "p", "y"), M.cost_optimal(df, ["g"], "p", "y")):
        assert {r["g"] for r in out.collect()} == {"a", None}
    costs = M.threshold_costs(df, ["g"], "p", "y").where("g is null and threshold = 0.99").first()
    assert (costs["n"], costs["false_negatives"]) == (2, 1)


def test_split_quotas_and_determinism(spark):
    df = spark.range(20).select(F.col("id").alias("SK_ID_CURR"), (F.col("id") < 2).cast("int").alias("TARGET"))
    split = S.stratified_split(df)
    sizes = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert sizes == {"dev": 14, "val": 3, "test": 3}
    again = S.stratified_split(df.repartition(7))
    assert split.exceptAll(again).count() == 0
    S.check_split_total(df, split)
    with pytest.raises(ValueError):
        S.check_fractions({"dev": 0.7, "val": 0.2})
    bad = S.split_checks(df, split.where("SK_ID_CURR <> 3").unionByName(spark.createDataFrame([(4, "val"), (99, "dev")], "SK_ID_CURR bigint, split string")))
    row = bad.first()
    assert row["missing_keys"] == 1 and row["extra_keys"] == 1 and row["overlapping_keys"] in (0, 1)


@pytest.mark.parametrize("rows", [[(1, 0), (1, 1)], [(1, None)], [(1, 2)]])
def test_target_preconditions_raise(spark, rows):
    with pytest.raises(ValueError):
        S.require_target(spark.createDataFrame(rows, "SK_ID_CURR int, TARGET int"))


def test_category_codes_unseen_and_null(spark):
    train = spark.createDataFrame([(1, "b", 0), (2, "a", 1), (3, None, 0)], "SK_ID_CURR int, c string, TARGET int")
    val = spark.createDataFrame([(4, "c", 0), (5, "a", 1)], "SK_ID_CURR int, c string, TARGET int")
    out = [{r["SK_ID_CURR"]: r["c"] for r in df.collect()} for df in E.encode_splits(train, val)]
    assert out == [{1: 1, 2: 0, 3: -1}, {4: -1, 5: 0}]


def test_encoded_checks(spark):
    df = spark.createDataFrame([(1, None, 1, -1, 0), (2, 3.0, 1, 2, 1)], "SK_ID_CURR int, x double, x_is_null int, c int, TARGET int")
    row = P.encoded_checks(df, "TARGET", {"x_is_null": "x"}, ["c"]).first()
    assert (row["rows"], row["target_mean"], row["x_is_null_mismatches"], row["c_unseen"]) == (2, 0.5, 1, 1)
    assert P.same_columns(df, df) and not P.same_columns(df, df.drop("c"))


def test_value_preview(spark):
    row = {r["feature"]: r["sample_values"] for r in P.value_preview(spark.range(30).select("id", (F.col("id") % 2).alias("b"))).collect()}
    assert len(row["id"]) == 5 and set(row["b"]) == {"0", "1"}
