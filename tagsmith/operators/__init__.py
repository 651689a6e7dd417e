"""Tagging operators: DataFrame -> DataFrame functions."""

from tagsmith.operators.joins import has_at_most, join_small, range_join
from tagsmith.operators.match import distinct_rules, match_tag, match_tags, unmatched_values
from tagsmith.operators.bands import (
    age_band_tag, band_tag, consume_cycle_tag, cycle_and_age_tags, last_activity, order_span, range_rules,
)
from tagsmith.operators.stats import favourite_value, pay_type_tag, top_n_per_group, value_counts
from tagsmith.operators.rfx import (
    lifecycle_tag, malformed_amounts, order_facts, rfe_metrics, rfe_scores, rfm_metrics, rfm_scores, score, value_per_cluster, value_ranks, weighted_score,
)
from tagsmith.operators.segment import (
    assemble, center_ranks, center_tag_table, cluster_profile, fit_kmeans, nearest_center, rank_centers,
    score_histogram, segment_by_kmeans, segment_model, segment_report, update_centers, vector_tags, wssse,
)
from tagsmith.operators.shopper import (
    encode_dims, fit_gender_tree, gender_votes, recent_orders, seed_labels, train_gender_tree,
    training_histogram, tree_holdout_metrics, usg_tag, vote_class, vote_tag,
)
from tagsmith.operators.evaluate import (
    classification_metrics, classify, confusion_metrics, evaluate_predictions, hash_split, l2_normalize,
    label_index, minmax_scale, prepare_features, train_classifier, tune_classifier,
)
from tagsmith.operators.lineage import cut_lineage
from tagsmith.operators.profile import profile_upsert, profile_wide
