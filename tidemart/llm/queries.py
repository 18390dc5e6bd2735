"""The registered queries of this subpackage, and DuckDB SQL where SQL can express one."""

from __future__ import annotations

import corpus_pipeline
from tidemart.llm.bpe import op4_bpe_replay
from tidemart.llm.centroids import OP12_SQL, op12_centroids
from tidemart.llm.langid import op9_langid
from tidemart.llm.linerules import OP1_SQL, op1_line_rules
from tidemart.llm.mtree import OP10_SQL, op10_mtree
from tidemart.llm.packing import op2_packing
from tidemart.llm.repair import op13_repair
from tidemart.llm.resampling import op3_importance_resampling
from tidemart.llm.setsketch import op11_setsketch
from tidemart.llm.simhash import op6_simhash
from tidemart.llm.toxicity import op5_toxicity_fm
from tidemart.llm.urlfilter import OP8_SQL, op8_url_lists
from tidemart.llm.warc import OP7_SQL, op7_warc

QUERIES = {f.__name__: f for f in (op1_line_rules, op2_packing, op3_importance_resampling, op4_bpe_replay,
                                 op5_toxicity_fm, op6_simhash, op7_warc, op8_url_lists,
                                 op9_langid, op10_mtree, op11_setsketch, op12_centroids, op13_repair)}
QUERIES["pipeline"] = corpus_pipeline.run

ORACLES = {"op1_line_rules": OP1_SQL, "op7_warc": OP7_SQL, "op8_url_lists": OP8_SQL,
           "op10_mtree": OP10_SQL, "op12_centroids": OP12_SQL}
