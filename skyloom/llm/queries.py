"""Queries of this subpackage, and the SQL for those that SQL can express."""

from skyloom.llm import lexical, warc
from skyloom.llm.jaccard import op3_jaccard
from skyloom.llm.lexical import op11_lexical
from skyloom.llm.media import op2_media
from skyloom.llm.mixing import op10_mixing
from skyloom.llm.multi_index import op9_multi_index
from skyloom.llm.packing import op5_packing
from skyloom.llm.periodic import op12_periodic
from skyloom.llm.quality import op4_quality
from skyloom.llm.suffix_dedup import op7_suffix_dedup
from skyloom.llm.token_counts import op6_token_counts
from skyloom.llm.toxicity import op8_toxicity
from skyloom.llm.url_graph import op1_url_graph
from skyloom.llm.warc import op13_warc

QUERIES = {
    "op1_url_graph": op1_url_graph,
    "op2_media": op2_media,
    "op3_jaccard": op3_jaccard,
    "op4_quality": op4_quality,
    "op5_packing": op5_packing,
    "op6_token_counts": op6_token_counts,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_multi_index": op9_multi_index,
    "op10_mixing": op10_mixing,
    "op11_lexical": op11_lexical,
    "op12_periodic": op12_periodic,
    "op13_warc": op13_warc,
}

ORACLE_SQL: dict[str, str] = {"op11_lexical": lexical.ORACLE_SQL, "op13_warc": warc.ORACLE_SQL}
