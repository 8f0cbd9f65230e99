"""End-to-end jobs over the lending tables, stage by stage.

Each stage reads written tables and writes its own, so the lineage of a later
stage never reaches back to the raw data, and a lost executor costs one stage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendframe.operators import assemble as A
from lendframe.operators import binning as B
from lendframe.operators import calibrate as G
from lendframe.operators import decide as D
from lendframe.operators import drift as W
from lendframe.operators import encode as E
from lendframe.operators import explain as Z
from lendframe.operators import metrics as M
from lendframe.operators import models as X
from lendframe.operators import rollups as R
from lendframe.operators import splits as S
from lendframe.sources import ingest as I
from lendframe.sources import tables as T

KEY, TARGET = "SK_ID_CURR", "TARGET"
HOLDOUT = "test"


def _store(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    T.write_parquet(df, path, partition_by)
    return df.sparkSession.read.parquet(path)


@dataclass(frozen=True)
class Contract:
    """What raw files are held against: column, table and join contracts, and the fingerprints recorded when they were profiled."""

    columns: DataFrame
    sizes: DataFrame
    joins: DataFrame | None = None
    recorded: DataFrame | None = None


def ingest_raw(spark: SparkSession, paths: Mapping[str, str], contract: Contract, out: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """CSV files to published tables behind the gates, and their manifest."""
    manifest = I.ingest(spark, paths, f"{out}/interim", contract.columns, contract.sizes, contract.joins, contract.recorded)
    manifest = _store(manifest, f"{out}/manifest")
    return {r["table"]: T.read_parquet(spark, r["path"]) for r in manifest.select("table", "path").collect()}, manifest


def build_rollups(tables: Mapping[str, DataFrame], out: str) -> dict[str, DataFrame]:
    """The five roll-ups, each written once because train and test both read them."""
    previous = tables["previous_application"]
    plans = {
        "bureau": R.rollup_bureau(tables["bureau"], tables["bureau_balance"]),
        "previous_application": R.rollup_previous(previous),
        "pos_cash": R.rollup_pos_cash(tables["pos_cash_balance"], previous),
        "installments": R.rollup_installments(tables["installments_payments"], previous),
        "credit_card": R.rollup_credit_card(tables["credit_card_balance"], previous),
    }
    return {name: _store(df, f"{out}/{name}_aggregated") for name, df in plans.items()}


def build_features(tables: Mapping[str, DataFrame], out: str) -> dict[str, DataFrame]:
    """Wide train and test matrices, catalogue and splits.

    The split is a column of the pass that assembles the train matrix and lays out its files, so later stages read the folders of the
    split they want and never meet the split table again.
    """
    base = tables["application_train"]
    S.require_target(base, KEY, TARGET)
    splits = _store(S.stratified_split(base.select(KEY, TARGET)), f"{out}/splits")
    S.require_splits(base, splits, KEY, TARGET)
    families = build_rollups(tables, out)
    wide = A.assemble(S.apply_splits(base, splits, KEY), families, check=True)
    laid_out = _store(wide, f"{out}/application_train_features", ["split"])
    train = laid_out.drop("split")
    done = {"train": train, "by_split": laid_out, "splits": splits, "catalogue": _store(A.catalogue(train, families), f"{out}/catalogue")}
    if "application_test" in tables:
        done["test"] = _store(A.assemble(tables["application_test"], families, train=False), f"{out}/application_test_features")
    return done


def encode_champion(laid_out: DataFrame, out: str, **rules) -> tuple[dict[str, DataFrame], B.Binning, DataFrame]:
    """WoE matrices of the three splits with the selected features, the fit, and the decision on every feature."""
    parts = S.split_parts(laid_out)
    fit = B.fit_binning(parts["dev"], **rules)
    decisions = B.iv_selection(fit.values(laid_out.sparkSession))
    kept = [r["feature"] for r in decisions.where("kept").collect()]
    encoded = fit.transform(parts["dev"], [KEY], kept)
    decisions = _store(B.prune_correlated(decisions, encoded), f"{out}/champion_decisions")
    T.write_json(fit.table(laid_out.sparkSession), f"{out}/champion_binning")
    T.write_json(B.selection_lists(decisions), f"{out}/champion_selection")
    T.write_json(B.top_by_iv(decisions), f"{out}/champion_top_features")
    return {n: _store(B.encoded_matrix(fit, p, decisions), f"{out}/champion_{n}") for n, p in parts.items()}, fit, decisions


def encode_challenger(laid_out: DataFrame, out: str) -> dict[str, DataFrame]:
    """Coded matrices of the three splits with all features."""
    parts = S.split_parts(laid_out)
    coded = E.encode_splits(parts["dev"], parts["val"], parts[HOLDOUT])
    return {n: _store(df, f"{out}/challenger_{n}") for n, df in zip(("dev", "val", HOLDOUT), coded)}


def _scored(search: X.Search, parts: Mapping[str, DataFrame], name: str) -> DataFrame:
    frames = [X.score(search.model, df.withColumn("split", F.lit(n)), search.features, name) for n, df in parts.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def train_and_compare(
    champion: Mapping[str, DataFrame], challenger: Mapping[str, DataFrame], out: str, champion_options: Mapping = {}, challenger_options: Mapping = {}
) -> dict[str, DataFrame]:
    """Both searches, calibration, one long prediction table, and the comparison on the holdout."""
    simple = X.champion_search(champion["dev"], champion["val"], **champion_options)
    trees = X.challenger_search(challenger["dev"], challenger["val"], **challenger_options)
    T.save_model(simple.model, f"{out}/models/champion", {"features": ",".join(simple.features), **simple.params})
    T.save_model(trees.model, f"{out}/models/challenger", {"features": ",".join(trees.features)})
    raw = _store(_scored(simple, champion, "champion").unionByName(_scored(trees, challenger, "challenger")), f"{out}/raw_predictions")
    tree_rows = raw.where("model = 'challenger'")
    calibrator, report = G.select_calibrator(tree_rows.where("split = 'val'"), tree_rows.where(F.col("split") == HOLDOUT), "raw_pd", TARGET)
    combined = G.combine_predictions(raw.where("model = 'champion'"), tree_rows, calibrator)
    T.write_parquet(combined, f"{out}/predictions", ["model", "split"])
    predictions = raw.sparkSession.read.parquet(f"{out}/predictions")
    T.write_json(G.saved(raw.sparkSession, calibrator), f"{out}/models/calibrator")
    holdout = predictions.where(F.col("split") == HOLDOUT)
    checks = _store(stored_against_recomputed(predictions, simple, trees, report), f"{out}/cross_checks")
    failed = checks.where("NOT passed").count()
    cube = _store(M.metrics_cube(holdout, ["model"], "calibrated_pd", TARGET), f"{out}/metrics")
    sweep = _store(M.cost_sweep(holdout, "model", "calibrated_pd", TARGET), f"{out}/cost_sweep")
    return {
        "predictions": predictions,
        "calibration": report,
        "metrics": cube,
        "cost_sweep": sweep,
        "cross_checks": checks,
        "recommendation": M.recommendation(cube, sweep, failed),
        "importance": X.tree_importance(trees),
        "coefficients": X.coefficient_importance(simple),
        "weights": X.coefficient_weights(simple),
    }


def stored_against_recomputed(predictions: DataFrame, simple: X.Search, trees: X.Search, report: DataFrame) -> DataFrame:
    """What the searches and the calibration reported, against the same measures of the written predictions."""
    spark = predictions.sparkSession
    aucs = [(name, "val_auc", search.trials.agg(F.max("val_auc")).first()[0]) for name, search in (("champion", simple), ("challenger", trees))]
    row = report.first()
    stored = [*aucs, ("challenger", "holdout_brier", row[f"{row['selected_method']}_brier"])]
    val, holdout = predictions.where("split = 'val'"), predictions.where((F.col("split") == HOLDOUT) & (F.col("model") == "challenger"))
    again = M.discrimination(val, ["model"], "raw_pd", TARGET).select("model", F.lit("val_auc").alias("measure"), F.col("auc").alias("value"))
    again = again.unionByName(M.brier(holdout, ["model"], "calibrated_pd", TARGET).select("model", F.lit("holdout_brier").alias("measure"), F.col("brier").alias("value")))
    return M.cross_checks(spark.createDataFrame(stored, "model string, measure string, value double"), again, ["model", "measure"])


def monitor(challenger: Mapping[str, DataFrame], predictions: DataFrame, out: str) -> dict[str, DataFrame]:
    """Feature, prediction and calibration drift from val to holdout, with notes."""
    features = X.feature_columns(challenger["val"])
    drift = _store(W.feature_drift(challenger["val"], challenger[HOLDOUT], features), f"{out}/feature_drift")
    rows = predictions.where("model = 'challenger'")
    sides = rows.where("split = 'val'"), rows.where(F.col("split") == HOLDOUT)
    prediction = _store(W.prediction_drift(*sides, "calibrated_pd"), f"{out}/prediction_drift")
    calibration = _store(W.calibration_drift(*sides, "calibrated_pd", TARGET), f"{out}/calibration_drift")
    return {"drift": drift, "top": W.top_drifted(drift), "prediction": prediction, "calibration": calibration, "notes": W.alert_notes(drift, prediction, calibration)}


def decide_holdout(predictions: DataFrame, out: str, policy: D.Policy | None = None) -> dict[str, DataFrame]:
    """Decisions of both models on the holdout, their mix, and the threshold gap."""
    rows = predictions.where(F.col("split") == HOLDOUT).withColumn("source_model", F.col("model"))
    decided = D.decide(rows, policy, applicant=KEY, pd="calibrated_pd", keep=["source_model", TARGET])
    outcomes = _store(decided, f"{out}/decisions")
    return {
        "decisions": outcomes,
        "distribution": D.decision_distribution(outcomes, ["source_model"], TARGET),
        "threshold_gap": D.threshold_gap(rows, ["source_model"], "calibrated_pd", TARGET, policy),
    }


def explain_champion(matrix: DataFrame, weights: Mapping[str, float], decisions: DataFrame, out: str) -> dict[str, DataFrame]:
    """Exact contributions of the linear model, their ranking over all rows, and notices matched by applicant.

    The whole matrix goes in, so a feature without a weight is an error and not a silent gap.
    """
    features = list(weights)
    parts = Z.linear_contributions(matrix.drop(TARGET), weights)
    ranking = Z.global_importance(parts, features)
    wide = parts.withColumn("applicant_id", F.col(KEY).cast("string")).drop(KEY)
    notices = Z.reason_codes(decisions, wide, features)
    text = Z.notice_text(*[F.col(c) for c in ("applicant_id", "decision", "primary_reasons", "additional_reasons")])
    return {"importance": ranking, "notices": _store(notices.withColumn("notice_text", text), f"{out}/notices")}


def run(
    spark: SparkSession,
    tables: Mapping[str, DataFrame | str],
    out: str,
    binning_rules: Mapping = {},
    champion_options: Mapping = {},
    challenger_options: Mapping = {},
    contract: Contract | None = None,
) -> dict:
    """All stages to decisions and monitoring. With a contract, `tables` are paths of CSV files, and ingestion behind its gates comes first."""
    done = {}
    if contract is not None:
        tables, done["manifest"] = ingest_raw(spark, tables, contract, out)
    built = build_features(tables, out)
    champion, _, decisions = encode_champion(built["by_split"], out, **binning_rules)
    challenger = encode_challenger(built["by_split"], out)
    compared = train_and_compare(champion, challenger, out, champion_options, challenger_options)
    watched = monitor(challenger, compared["predictions"], out)
    decided = decide_holdout(compared["predictions"], out)
    chosen = decided["decisions"].where("source_model = 'champion'")
    explained = explain_champion(champion[HOLDOUT], compared["weights"], chosen, out)
    return {**done, **built, "selection": decisions, **compared, **watched, **decided, **explained}
