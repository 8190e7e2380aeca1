"""Operators on text corpora for training data, and their registered queries."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code, so that the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from starmill.llm import (  # noqa: E402
    alignment, chat, decontaminate, exact_search, fingerprint, hard_negatives, html_text, language, line_dedup,
    near_dedup, packing, pii, toxicity)

_MODULES = (pii, language, html_text, fingerprint, packing, toxicity, line_dedup, chat, near_dedup, decontaminate,
            alignment, exact_search, hard_negatives)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
