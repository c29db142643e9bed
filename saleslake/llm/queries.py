"""All registered queries of this subpackage."""

import corpus_pipeline  # noqa: F401  (register)
from saleslake.llm import (  # noqa: F401  (register)
    decontaminate,
    fingerprint,
    language,
    licences,
    negatives,
    personal,
    pieces,
    repetition,
    shuffle_shards,
    simhash,
    spelling,
    toxicity,
    urls,
)
from saleslake.llm.common import ORACLES, QUERIES  # noqa: F401
