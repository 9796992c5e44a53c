"""Reusable Column expressions; every helper returns a ``pyspark.sql.Column``."""

from tidepool.functions.text import (  # noqa: F401
    WS_CLASS, collapse_ws, sentence_split, strip_ws, tokenize,
)
from tidepool.functions.numeric import exact_avg_round, money_sum  # noqa: F401
from tidepool.functions.ids import chunk_id, uuid5  # noqa: F401
from tidepool.functions.embed import dot, with_hashed_embedding  # noqa: F401
