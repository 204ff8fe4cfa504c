"""``documents`` under two tokenizers."""

from __future__ import annotations

from barlake.llm.alignment import alignment_totals
from barlake.llm.common import table


def op11_alignment(spark, sf_dir):
    return alignment_totals(spark, table(spark, sf_dir, "documents"))


#: Tokenisers have no SQL.
ALL = {"op11_alignment": (op11_alignment, None)}
