"""The queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from eventide.llm import collocations, lexical_search, line_dedup, substring_dedup
from eventide.llm.byte_bpe import op10_byte_bpe
from eventide.llm.collocations import op11_collocations
from eventide.llm.fingerprints import op7_fingerprints
from eventide.llm.language_id import op6_language_id
from eventide.llm.lexical_search import op13_lexical_search
from eventide.llm.line_dedup import op1_line_dedup
from eventide.llm.packing import op5_packing
from eventide.llm.quality import op8_quality
from eventide.llm.simhash import op9_simhash
from eventide.llm.substring_dedup import op2_substring_dedup
from eventide.llm.token_output import op3_token_output
from eventide.llm.toxicity import op4_toxicity
from eventide.llm.vector_forest import op12_neighbours

QUERIES = {
    f.__name__: f
    for f in (op1_line_dedup, op2_substring_dedup, op3_token_output, op4_toxicity, op5_packing, op6_language_id, op7_fingerprints, op8_quality, op9_simhash, op10_byte_bpe, op11_collocations, op12_neighbours, op13_lexical_search)
}

SQL = {"op1_line_dedup": line_dedup.SQL, "op2_substring_dedup": substring_dedup.SQL, "op11_collocations": collocations.SQL, "op13_lexical_search": lexical_search.SQL}
