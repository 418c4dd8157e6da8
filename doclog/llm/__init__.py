"""Operators that training-data pipelines need, each with a registered query."""

import sys

from pyspark import cloudpickle

from . import (  # noqa: F401
    alignment,
    credentials,
    decontaminate,
    fingerprint,
    language,
    lm,
    ngram_join,
    packing,
    pii,
    repeats,
    spelling,
    toxicity,
    warc,
)
from .registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]

# Functions that run in tasks carry their code along, so executors need no copy
# of this folder.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
