"""The registered queries of the subpackage (name -> callable) and their DuckDB SQL."""

from __future__ import annotations

from . import (conversation_sql, op1_secrets, op2_ngram_join, op3_suffix_dedup, op4_packing, op5_mixing, op6_toxicity, op7_rans,
               op8_lattice, op9_html, op10_lz, op11_pii, op12_repair, op13_trie)

QUERIES = {
    "op1_secrets": op1_secrets.op1_secrets,
    "op2_ngram_join": op2_ngram_join.op2_ngram_join,
    "op3_suffix_dedup": op3_suffix_dedup.op3_suffix_dedup,
    "op4_packing": op4_packing.op4_packing,
    "op5_mixing": op5_mixing.op5_mixing,
    "op6_toxicity": op6_toxicity.op6_toxicity,
    "op7_rans": op7_rans.op7_rans,
    "op8_lattice": op8_lattice.op8_lattice,
    "op9_html": op9_html.op9_html,
    "op10_lz": op10_lz.op10_lz,
    "op11_pii": op11_pii.op11_pii,
    "op12_repair": op12_repair.op12_repair,
    "op13_trie": op13_trie.op13_trie,
}

ORACLE_SQL = {
    "op5_mixing": op5_mixing.SQL,
    "op12_repair": conversation_sql.REPAIR,
    "op13_trie": conversation_sql.TRIE,
}
