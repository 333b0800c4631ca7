"""The registered queries of this package and the SQL that must give the same rows."""

from . import (
    ball_tree, chat_format, chosen_path, cuckoo_dedup, dim_scan, filter_audit, line_spread, merkle_manifest, mixing, packing,
    quality_mil, url_lm, warc_bundle)

QUERIES = {
    "op8_dim_scan": dim_scan.op8_dim_scan,
    "op9_ball_tree": ball_tree.op9_ball_tree,
    "op5_chosen_path": chosen_path.op5_chosen_path,
    "op2_quality": quality_mil.op2_quality,
    "op4_warc_bundles": warc_bundle.op4_warc_bundles,
    "op1_chat_format": chat_format.op1_chat_format,
    "op10_packing": packing.op10_packing,
    "op3_url_filter": url_lm.op3_url_filter,
    "op6_mixing": mixing.op6_mixing,
    "op7_line_spread": line_spread.op7_line_spread,
    "op11_cuckoo_dedup": cuckoo_dedup.op11_cuckoo_dedup,
    "op12_filter_audit": filter_audit.op12_filter_audit,
    "op13_merkle_manifest": merkle_manifest.op13_merkle_manifest,
}

ORACLES = {
    "op9_ball_tree": ball_tree.OP9_SQL,
    "op4_warc_bundles": warc_bundle.OP4_SQL,
    "op3_url_filter": url_lm.OP3_SQL,
    "op6_mixing": mixing.OP6_SQL,
    "op7_line_spread": line_spread.OP7_SQL,
    "op11_cuckoo_dedup": cuckoo_dedup.OP11_SQL,
    "op12_filter_audit": filter_audit.OP12_SQL,
    "op13_merkle_manifest": merkle_manifest.OP13_SQL,
}
