"""Queries of this subpackage and their DuckDB SQL, by name."""

from tripaudit.llm.conversations import ORACLE_OP13, op13_weighted_repair
from tripaudit.llm.decontam import ORACLE_OP6, op6_wu_manber
from tripaudit.llm.htmltext import op1_html_blocks
from tripaudit.llm.jaccard import op9_grouped_prefix_join
from tripaudit.llm.langid import op2_crf_language
from tripaudit.llm.licenses import op4_license_sentences, oracle_op4
from tripaudit.llm.packing import op8_dominance_packing
from tripaudit.llm.perplexity import op10_kneser_ney
from tripaudit.llm.pii import op3_pii_anchors
from tripaudit.llm.resample import ORACLE_OP11, op11_length_bucketed_resample
from tripaudit.llm.sharding import op5_ring_shards
from tripaudit.llm.tokencount import op12_resync_token_counts
from tripaudit.llm.warc import ORACLE_OP7, op7_warc_revisits

QUERIES = {
    "op1_html_blocks": op1_html_blocks,
    "op2_crf_language": op2_crf_language,
    "op3_pii_anchors": op3_pii_anchors,
    "op4_license_sentences": op4_license_sentences,
    "op5_ring_shards": op5_ring_shards,
    "op6_wu_manber": op6_wu_manber,
    "op7_warc_revisits": op7_warc_revisits,
    "op8_dominance_packing": op8_dominance_packing,
    "op9_grouped_prefix_join": op9_grouped_prefix_join,
    "op10_kneser_ney": op10_kneser_ney,
    "op11_length_bucketed_resample": op11_length_bucketed_resample,
    "op12_resync_token_counts": op12_resync_token_counts,
    "op13_weighted_repair": op13_weighted_repair,
}
ORACLE_SQL = {
    "op4_license_sentences": oracle_op4(),
    "op6_wu_manber": ORACLE_OP6,
    "op7_warc_revisits": ORACLE_OP7,
    "op11_length_bucketed_resample": ORACLE_OP11,
    "op13_weighted_repair": ORACLE_OP13,
}
