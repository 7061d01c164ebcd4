"""The registered queries of the subpackage; their SQL is in ``oracle``."""

from __future__ import annotations

from listmill.llm.alignment import op11_align
from listmill.llm.decontamination import op9_decontaminate
from listmill.llm.mixing import op1_mix
from listmill.llm.neighbours import op7_neighbours
from listmill.llm.packing import op12_pack
from listmill.llm.repeats import op4_repeats
from listmill.llm.secrets import op2_secrets
from listmill.llm.sharding import op8_shard
from listmill.llm.simhash import op10_simhash
from listmill.llm.spelling import op13_spelling
from listmill.llm.toxicity import op5_toxicity
from listmill.llm.url_filter import op6_urls
from listmill.llm.warc import op3_warc

QUERIES = {
    query.__name__: query
    for query in (
        op1_mix,
        op2_secrets,
        op3_warc,
        op4_repeats,
        op5_toxicity,
        op6_urls,
        op7_neighbours,
        op8_shard,
        op9_decontaminate,
        op10_simhash,
        op11_align,
        op12_pack,
        op13_spelling,
    )
}
