"""Every query of this subpackage."""

from millrace.llm import (  # noqa: F401
    chat,
    collocations,
    decontaminate,
    kneser_ney,
    langid,
    minhash,
    mixing,
    packing,
    periods,
    quality,
    topk,
    toxicity,
    warc,
)
from millrace.llm.common import QUERIES, SQL  # noqa: F401
