"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from stratakit.llm.alignment import op12_lockstep_alignment
from stratakit.llm.divergence import SQL as DIVERGENCE_SQL
from stratakit.llm.divergence import op11_source_divergence
from stratakit.llm.language_id import op8_ppm_language
from stratakit.llm.lm_scoring import op1_suffix_tree_scores
from stratakit.llm.media import op4_lossless_webp
from stratakit.llm.mixing import op7_sainte_lague_mix
from stratakit.llm.near_dedup import op2_similarity_sketch_dedup
from stratakit.llm.nearest import op10_pruned_graph_neighbours
from stratakit.llm.packing import op6_drr_packing
from stratakit.llm.pii import op9_surrogate_pii
from stratakit.llm.quality import op3_kneser_ney_quality
from stratakit.llm.sharding import op5_fixed_virtual_slots
from stratakit.llm.url_filter import SQL as URL_SQL
from stratakit.llm.url_filter import op13_link_graph_url_filter

QUERIES = {
    "op1_suffix_tree_scores": op1_suffix_tree_scores,
    "op2_similarity_sketch_dedup": op2_similarity_sketch_dedup,
    "op3_kneser_ney_quality": op3_kneser_ney_quality,
    "op4_lossless_webp": op4_lossless_webp,
    "op5_fixed_virtual_slots": op5_fixed_virtual_slots,
    "op6_drr_packing": op6_drr_packing,
    "op7_sainte_lague_mix": op7_sainte_lague_mix,
    "op8_ppm_language": op8_ppm_language,
    "op9_surrogate_pii": op9_surrogate_pii,
    "op10_pruned_graph_neighbours": op10_pruned_graph_neighbours,
    "op11_source_divergence": op11_source_divergence,
    "op12_lockstep_alignment": op12_lockstep_alignment,
    "op13_link_graph_url_filter": op13_link_graph_url_filter,
}

#: SQL where it can express the whole result.  The other operators rest on
#: models, tokenizers, image files, seeded hashes or a search that SQL doesn't
#: have; tests/llm compares them with brute force.
ORACLE_SQL: dict[str, str] = {
    "op2_similarity_sketch_dedup": r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents),
sets as (select doc_id, case when len(w) = 0 then [] when len(w) = 1 then [w[1]] else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end s from words),
sized as (select doc_id, s, len(s) n from sets),
items as (select doc_id, n, unnest(s) item from sized),
links as (select a.doc_id x, b.doc_id y from items a join items b on a.item = b.item and a.doc_id <> b.doc_id and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach as (select doc_id, doc_id c from sized union select y, c from reach join links on doc_id = x),
least_id as (select doc_id, min(c) component_id from reach group by doc_id)
select doc_id, n::bigint n_shingles, component_id, doc_id = component_id kept from sized join least_id using (doc_id)""",
    "op11_source_divergence": DIVERGENCE_SQL,
    "op13_link_graph_url_filter": URL_SQL,
}
