"""The registered queries of this package and the SQL for those that SQL can express."""

import corpus_pipeline
from flightlens.llm.collocations import OP11_SQL, op11_phrase_collocations
from flightlens.llm.exact_dedup import OP6_SQL, op6_exact_dedup
from flightlens.llm.fingerprints import op8_paragraph_fingerprints
from flightlens.llm.language_id import op9_language_id
from flightlens.llm.mixing import OP7_SQL, op7_source_mixing
from flightlens.llm.packing import op3_best_fit_packing
from flightlens.llm.periodic_runs import op12_periodic_runs
from flightlens.llm.rank_bpe import op13_bpe_round_trip
from flightlens.llm.secret_scan import OP10_SQL, op10_secret_scan
from flightlens.llm.simhash import op5_simhash_near_dedup
from flightlens.llm.suffix_dedup import op1_suffix_dedup
from flightlens.llm.token_files import op2_token_planes
from flightlens.llm.toxicity import op4_toxicity

QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_token_planes, op3_best_fit_packing, op4_toxicity, op5_simhash_near_dedup, op6_exact_dedup,
    op7_source_mixing, op8_paragraph_fingerprints, op9_language_id, op10_secret_scan,
    op11_phrase_collocations, op12_periodic_runs, op13_bpe_round_trip,
)} | {"pipeline": corpus_pipeline.run}
ORACLES = {"op6_exact_dedup": OP6_SQL, "op7_source_mixing": OP7_SQL, "op10_secret_scan": OP10_SQL, "op11_phrase_collocations": OP11_SQL}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
