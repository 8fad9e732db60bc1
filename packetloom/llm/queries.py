"""Queries of this folder's operators."""

from packetloom.llm import conversation_trie, filter_audit
from packetloom.llm.classifier import op3_quality_classifier
from packetloom.llm.conversation_trie import op12_conversation_trie
from packetloom.llm.filter_audit import op13_filter_audit
from packetloom.llm.jaccard import op8_jaccard
from packetloom.llm.language_id import op11_language_id
from packetloom.llm.licenses import op7_licenses
from packetloom.llm.mixing import op9_mixing
from packetloom.llm.neighbours import op4_nearest_neighbours
from packetloom.llm.quality_rules import op1_quality_rules
from packetloom.llm.secrets import op5_secrets
from packetloom.llm.sentencepiece import op2_sentencepiece
from packetloom.llm.sharding import op6_sharding
from packetloom.llm.substrings import op10_substrings

REGISTRY = {
    "op1_quality_rules": op1_quality_rules,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_secrets": op5_secrets,
    "op6_sharding": op6_sharding,
    "op7_licenses": op7_licenses,
    "op8_jaccard": op8_jaccard,
    "op9_mixing": op9_mixing,
    "op10_substrings": op10_substrings,
    "op11_language_id": op11_language_id,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_filter_audit": op13_filter_audit,
}
ORACLES: dict[str, str] = {
    "op12_conversation_trie": conversation_trie.ORACLE,
    "op13_filter_audit": filter_audit.ORACLE,
}
