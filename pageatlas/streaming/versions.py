"""A streaming form of the version islands: an extension beside the batch operators."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageatlas.operators.fetchlog import usable

OUT = "url string, content_hash string, first_seen string, last_seen string"
STATE = "content_hash string, first_seen string, last_seen string"


def stream_versions(fetches: DataFrame) -> DataFrame:
    """(url, content_hash, first_seen, last_seen) whenever a url's version opens or is extended.

    State is one version per url. Within a micro-batch fetches are taken in order of time; those not
    later than last_seen are dropped, as the batch rule drops them.
    """

    def fold(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        cur = list(state.get) if state.exists else None
        rows = sorted(((r.fetched_at, r.status, r.content_hash) for b in batches for r in b.itertuples(index=False)))
        for at, status, h in rows:
            if cur is not None and at <= cur[2]:
                continue
            if cur is not None and (status == 304 or h == cur[0]):
                cur[2] = at
            else:
                cur = [h, at, at]
        if cur is not None:
            state.update(tuple(cur))
            yield pd.DataFrame([(key[0], *cur)], columns=["url", "content_hash", "first_seen", "last_seen"])

    rows = usable(fetches).select("url", "fetched_at", F.col("status").cast("long").alias("status"), "content_hash")
    return rows.groupBy("url").applyInPandasWithState(fold, OUT, STATE, "update", "NoTimeout")
