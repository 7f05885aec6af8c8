"""The counts of ``text_stats`` as a column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from trendlake.llm._frames import parts
from trendlake.llm._text_stats import NAMES, text_stats


def stats(text: Column) -> Column:
    """Struct of the counts of whole texts (``bigint``); null texts have zero of everything."""

    @F.arrow_udf("struct<" + ", ".join(f"{name}: bigint" for name in NAMES) + ">")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [text_stats(part) for part in parts(batch)]
            columns = [np.concatenate([np.empty(0, np.int64), *(f[name] for f in found)]) for name in NAMES]
            yield pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], NAMES)

    return of(text)
