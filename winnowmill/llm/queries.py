"""All queries of this subpackage."""

from . import queries_chat, queries_decontaminate, queries_lm, queries_mixing, queries_near, queries_ngram_join, queries_phrases, queries_quality, queries_repair, queries_sharding, queries_tokens, queries_urls, queries_warc  # noqa: F401
from .registry import ORACLE_SQL, QUERIES  # noqa: F401
