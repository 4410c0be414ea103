"""Text pieces of the rank report (T4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The report layouts of the reference's console output. The
# item report's ruler has 36 characters, the URL report's 35.
ITEM_RULER = "===================================="
URL_RULER = "==================================="
TIME_LABEL = "时间: "
ITEM_LABEL = " 商品ID="
ITEM_COUNT_LABEL = " 浏览量="
URL_LABEL = " URL="
URL_COUNT_LABEL = " 流量="


def rank_line(rank: Column, key: Column, cnt: Column,
              key_label: str = ITEM_LABEL, count_label: str = ITEM_COUNT_LABEL) -> Column:
    """``No<rank>: <key_label><key><count_label><cnt>``."""
    return F.concat(F.lit("No"), rank.cast("string"), F.lit(":"), F.lit(key_label),
                    key.cast("string"), F.lit(count_label), cnt.cast("string"))
