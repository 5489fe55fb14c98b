"""The registered queries of this subpackage and the SQL that some of them are checked against."""

from . import (
    ball_tree,
    conversation_repair,
    dart_minhash,
    packing,
    positional_index,
    quality_ftrl,
    quality_rules,
    repeated_windows,
    term_pipeline,
    token_counts,
    token_records,
    toxicity,
    warc_revisits,
)

QUERIES = {
    "op1_warc_revisits": warc_revisits.op1_warc_revisits,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_token_records": token_records.op3_token_records,
    "op4_dart_minhash": dart_minhash.op4_dart_minhash,
    "op5_positional_index": positional_index.op5_positional_index,
    "op6_repeated_windows": repeated_windows.op6_repeated_windows,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op8_packing": packing.op8_packing,
    "op9_quality_ftrl": quality_ftrl.op9_quality_ftrl,
    "op10_token_counts": token_counts.op10_token_counts,
    "op11_conversation_repair": conversation_repair.op11_conversation_repair,
    "op12_ball_tree": ball_tree.op12_ball_tree,
    "op13_term_pipeline": term_pipeline.op13_term_pipeline,
}
SQL = {
    "op1_warc_revisits": warc_revisits.ORACLE_SQL,
    "op5_positional_index": positional_index.ORACLE_SQL,
    "op6_repeated_windows": repeated_windows.ORACLE_SQL,
    "op7_quality_rules": quality_rules.ORACLE_SQL,
    "op11_conversation_repair": conversation_repair.ORACLE_SQL,
    "op12_ball_tree": ball_tree.ORACLE_SQL,
    "op13_term_pipeline": term_pipeline.ORACLE_SQL,
}
