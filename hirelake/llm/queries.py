"""Registered queries of the training-data operators, and their SQL where SQL can express them."""
from __future__ import annotations

from hirelake.llm.alignment import op12_alignment
from hirelake.llm.cuckoo import OP3_SQL, op3_cuckoo_dedup
from hirelake.llm.kneser_ney import op7_kneser_ney
from hirelake.llm.language import op4_language_id
from hirelake.llm.lattice import OP13_SQL, op13_lattice
from hirelake.llm.mixing import op1_mixing
from hirelake.llm.order_minhash import op6_order_minhash
from hirelake.llm.packing import op5_packing
from hirelake.llm.phrases import OP11_SQL, op11_phrases
from hirelake.llm.ppm_scoring import op8_ppm_scoring
from hirelake.llm.simhash import op10_simhash
from hirelake.llm.toxicity import op9_toxicity
from hirelake.llm.url_graph import op2_url_graph

QUERIES = {f.__name__: f for f in (op1_mixing, op2_url_graph, op3_cuckoo_dedup, op4_language_id, op5_packing, op6_order_minhash,
                                   op7_kneser_ney, op8_ppm_scoring, op9_toxicity, op10_simhash, op11_phrases, op12_alignment, op13_lattice)}
ORACLES = {"op3_cuckoo_dedup": OP3_SQL, "op11_phrases": OP11_SQL, "op13_lattice": OP13_SQL}
