"""All queries of the subpackage and their SQL."""

from loadcast.llm import queries_corpus, queries_pages, queries_text, queries_vectors  # noqa: F401
from loadcast.llm.common import ORACLE, QUERIES  # noqa: F401
