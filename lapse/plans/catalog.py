"""Query catalogue: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..models import attribution, train
from ..streaming import scoring
from . import cleaning, dataset, features, labels, metrics, roundtrip

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        **{f.__name__: f for f in (
            roundtrip.scan_delimited, roundtrip.scan_comma, roundtrip.rewrite_by_year, roundtrip.rewrite_by_account,
            roundtrip.sink_roundtrip,
            roundtrip.runs_roundtrip, roundtrip.best_of_two, roundtrip.isotonic_scores, roundtrip.isotonic_gain)},
        "window_split_counts": labels.window_split_counts,
        "eligible_accounts": labels.eligible_accounts,
        "ratio_threshold": labels.ratio_threshold,
        "churn_label": labels.churn_label,
        "label_inactive": labels.label_inactive,
        "label_count_drop": labels.label_count_drop,
        "label_count_drop_lastyear": labels.label_count_drop_lastyear,
        "label_balance_drop": labels.label_balance_drop,
        "label_rule_rates": labels.label_rule_rates,
        "label_distribution": labels.label_distribution,
        "last_activity_year": labels.last_activity_year,
        # features
        "tx_features": features.tx_features,
        "balance_last": features.balance_last,
        "tenure_days": features.tenure_days,
        "tx_rate": features.tx_rate,
        "semi_members": features.semi_members_query,
        "standing_orders": features.standing_orders,
        "bridge_holders": features.bridge_holders,
        "product_flags": features.product_flags,
        "product_flags_asof": features.product_flags_asof,
        "product_flags_asof_row": features.product_flags_asof_row,
        "join_key_audit": features.join_key_audit,
        "dimension_enrich": features.dimension_enrich,
        "feature_table": features.feature_table,
        "product_flag_rates": features.product_flag_rates,
        # sources, cleaning, audits
        "scan_reject_nonnumeric": cleaning.scan_reject_nonnumeric,
        "json_record_parse": cleaning.json_record_parse,
        "json_sample_row": cleaning.json_sample_row,
        "reject_incomplete": cleaning.reject_incomplete,
        "parse_yymmdd": cleaning.parse_yymmdd_q,
        "decode_birth_number": cleaning.decode_birth_number,
        "numeric_profile": cleaning.numeric_profile,
        "null_census": cleaning.null_census,
        "sentinel_census": cleaning.sentinel_census,
        "table_shapes": cleaning.table_shapes,
        "date_range_audit": cleaning.date_range_audit,
        # dataset
        "align_features": dataset.align_features,
        "coerce_numeric": dataset.coerce_numeric_q,
        "median_impute": dataset.median_impute,
        "one_hot": dataset.one_hot,
        "one_hot_drop_first": dataset.one_hot_drop_first,
        "standard_scale": dataset.standard_scale_q,
        "design_matrix": dataset.design_matrix,
        "design_matrix_all_dates": dataset.design_matrix_all_dates,
        "stratified_split": dataset.stratified_split_q,
        "stratified_split3": dataset.stratified_split3_q,
        "split_audit": dataset.split_audit,
        "class_weight": dataset.class_weight,
        # scoring and metrics
        "baseline_majority": metrics.baseline_majority,
        "risk_tiers": metrics.risk_tiers,
        "tier_summary": metrics.tier_summary,
        "threshold_sweep": metrics.threshold_sweep,
        "roc_auc": metrics.roc_auc,
        "average_precision": metrics.average_precision,
        "brier": metrics.brier,
        "roc_points": metrics.roc_points,
        "roc_points_reduced": metrics.roc_points_reduced,
        "pr_points": metrics.pr_points,
        "confusion_matrix": metrics.confusion_matrix,
        "classification_report": metrics.classification_report,
        "calibration_bins": metrics.calibration_bins,
        "topk_accounts": metrics.topk_accounts,
        "linear_attribution": metrics.linear_attribution,
        # Spark ML (rows-only checks)
        "model_logreg": train.model_logreg,
        "model_logreg_scaled": train.model_logreg_scaled,
        "model_threshold_sweep": train.model_threshold_sweep,
        "model_calibration_bins": train.model_calibration_bins,
        "model_forest": train.model_forest,
        "model_gbt": train.model_gbt,
        "ablation": train.ablation,
        "calibrated_scores": train.calibrated_scores,
        "calibration_gain": train.calibration_gain,
        "feature_importance": train.feature_importance,
        "permutation_importance": train.permutation_importance,
        "tree_attribution": attribution.tree_attribution,
        "tree_attribution_rows": attribution.tree_attribution_rows,
        "score_batch": train.score_batch,
        "score_raw": train.score_raw,
        "run_metrics": train.run_metrics,
        "best_run": train.best_run,
        # Structured Streaming
        "score_stream": scoring.score_stream,
    }
    return q
