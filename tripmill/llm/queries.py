"""The named queries of this subpackage and, where SQL can state them, their SQL."""

from __future__ import annotations

from tripmill.llm import (
    op1_token_counts,
    op2_context_trees,
    op3_surrogates,
    op4_discriminant,
    op5_training_order,
    op6_classifier_chain,
    op7_term_at_a_time,
    op8_templates,
    op9_merge_replay,
    op10_signature_trees,
    op11_importance,
    op12_spelling,
    op13_chat_layouts,
)

QUERIES = {
    "op1_length_histogram": op1_token_counts.query,
    "op2_context_trees": op2_context_trees.query,
    "op3_surrogates": op3_surrogates.query,
    "op4_discriminant": op4_discriminant.query,
    "op5_training_order": op5_training_order.query,
    "op6_classifier_chain": op6_classifier_chain.query,
    "op7_term_at_a_time": op7_term_at_a_time.query,
    "op8_templates": op8_templates.query,
    "op9_merge_replay": op9_merge_replay.query,
    "op10_signature_trees": op10_signature_trees.query,
    "op11_importance": op11_importance.query,
    "op12_spelling": op12_spelling.query,
    "op13_chat_layouts": op13_chat_layouts.query,
}

ORACLES = {"op7_term_at_a_time": op7_term_at_a_time.SQL, "op13_chat_layouts": op13_chat_layouts.SQL}
