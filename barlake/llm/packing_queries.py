"""``documents`` packed into sequences."""

from __future__ import annotations

from barlake.llm.common import table
from barlake.llm.packing import pack

COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def op12_packing(spark, sf_dir):
    return pack(spark, table(spark, sf_dir, "documents")).select(*COLUMNS)


#: Tokenisers and search have no SQL.
ALL = {"op12_packing": (op12_packing, None)}
