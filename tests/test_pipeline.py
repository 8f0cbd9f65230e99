"""All stages on the driver tables in the roles of the lending tables."""

from pyspark.sql import functions as F

from lendframe.operators import calibrate as G
from lendframe.operators import contracts as K
from lendframe.plans import pipeline
from lendframe.sources import ingest as I
from lendframe.sources import tables as T
from verification import roles


def test_end_to_end(spark, sf_dir, tmp_path):
    cards = roles.credit_card(spark, sf_dir)
    previous = roles.previous_application(spark, sf_dir)
    loans = previous.unionByName(roles.card_loans(spark, sf_dir).withColumn("SK_ID_PREV", -F.col("SK_ID_PREV") - 1), allowMissingColumns=True)
    base = roles.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("SK_ID_CURR"),
        F.when(F.pmod(F.xxhash64("o_orderkey"), F.lit(10)) < F.col("o_totalprice") / 100000, 1).otherwise(0).alias("TARGET"),
        F.floor("o_totalprice").cast("double").alias("AMT_CREDIT"),
        F.col("o_orderpriority").alias("NAME_EDUCATION_TYPE"),
    )
    tables = {
        "application_train": base,
        "application_test": base.drop("TARGET"),
        "bureau": roles.bureau(spark, sf_dir),
        "bureau_balance": roles.bureau_balance(spark, sf_dir),
        "previous_application": loans,
        "pos_cash_balance": roles.pos_cash(spark, sf_dir),
        "installments_payments": roles.installments(spark, sf_dir),
        "credit_card_balance": cards.withColumn("SK_ID_PREV", -F.col("SK_ID_PREV") - 1),
    }
    paths = {n: T.write_csv(df, f"{tmp_path}/raw/{n}") for n, df in tables.items()}
    contract = pipeline.Contract(*K.derive_contracts(tables), K.derive_joins(tables), I.fingerprint_table(tables))
    out = pipeline.run(
        spark,
        paths,
        str(tmp_path),
        {"min_events": 10},
        {"c_grid": (1.0,), "l1_grid": (0.0,), "max_iter": 5},
        {"trials": 1, "max_rounds": 2, "space": lambda seed, t: {"maxDepth": 2}},
        contract,
    )
    manifest = {r["table"]: r for r in out["manifest"].collect()}
    assert set(manifest) == set(tables) and all(r["input_fingerprint"] == r["output_fingerprint"] and not r["malformed"] for r in manifest.values())
    assert out["train"].count() == base.count()
    # later stages read folders by split, and never the split table
    plan = out["by_split"].where("split = 'dev'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan and "Join" not in plan
    assert {(r["model"], r["measure"], r["passed"]) for r in out["cross_checks"].collect()} == {("champion", "val_auc", True), ("challenger", "val_auc", True), ("challenger", "holdout_brier", True)}
    lists = {r["reason"]: r for r in spark.read.json(f"{tmp_path}/champion_selection").collect()}
    assert sum(r["features"] for r in lists.values()) == out["selection"].count() and all(len(r["names"]) == r["features"] for r in lists.values())
    saved = G.restored(spark.read.json(f"{tmp_path}/models/calibrator"))
    again = saved.add(out["predictions"].where("model = 'challenger'"), "raw_pd", "again")
    assert again.where("abs(again - calibrated_pd) > 1e-12").count() == 0
    assert out["train"].count() == base.count() and out["test"].columns == [c for c in out["train"].columns if c != "TARGET"]
    assert out["catalogue"].count() == len(out["train"].columns) - 2
    n = {r["split"]: r["count"] for r in out["splits"].groupBy("split").count().collect()}
    assert sum(n.values()) == base.count()
    assert out["predictions"].count() == 2 * base.count()
    assert {r["model"] for r in out["metrics"].collect()} == {"champion", "challenger"}
    assert out["cost_sweep"].count() == 5 and out["recommendation"].count() == 1
    assert out["drift"].count() == 237 + 2 + 5 and out["notes"].count() >= 1
    assert out["decisions"].count() == 2 * n["test"]
    notices = out["notices"].collect()
    assert len(notices) == n["test"] and all(r["notice_text"].startswith("Applicant") or "Decision: " in r["notice_text"] for r in notices)
    # every feature of the champion is explained, however many there are
    names = set(spark.read.parquet(f"{tmp_path}/champion_dev").columns) - {"SK_ID_CURR", "TARGET"}
    assert set(out["weights"]) == names == {r["feature"] for r in out["importance"].collect()}
    assert out["coefficients"].count() == min(20, len(names))
