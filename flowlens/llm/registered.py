"""Imports every module that registers queries."""

from flowlens.llm import (  # noqa: F401
    align,
    bpe,
    chat,
    decontaminate,
    language,
    licenses,
    lm,
    merkle,
    neighbours,
    pii,
    simhash,
    syncmers,
    urls,
)
from flowlens.llm.queries import ORACLES, QUERIES  # noqa: F401
