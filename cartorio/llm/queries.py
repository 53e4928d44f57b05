"""All queries of this package: importing it fills the registry."""

from cartorio.llm import (  # noqa: F401  (they register)
    conversations,
    decontaminate,
    embeddings,
    language_model,
    languages,
    licenses,
    mixing,
    negatives,
    pii,
    sentences,
    simhash,
    tokens,
    toxicity,
)
from cartorio.llm.common import ORACLES, QUERIES  # noqa: F401
